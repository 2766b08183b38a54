"""Streams: rate limits over event time, and incremental ingestion of new files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import shared_dir
from ..operators.index import Snapshots
from ..plans import ingest
from ..sources import files


def hourly_counts(events: DataFrame, limit: int, late: str | None = None) -> DataFrame:
    """(user_id, hour, n): users above ``limit`` events in a tumbling hour; the same plan serves batch and stream."""
    if late:  # a watermark needs a time with a zone; it is taken back below
        events = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return (
        events.groupBy("user_id", F.window("ts", "1 hour")).agg(F.count("*").alias("n")).where(F.col("n") > limit)
        .select("user_id", F.col("window.start").cast("timestamp_ntz").alias("hour"), "n")
    )


def _finish(writer) -> None:
    run = writer.trigger(availableNow=True).start()
    run.awaitTermination()
    if run.exception():
        raise RuntimeError(str(run.exception()))


def rate_limit_stream(spark: SparkSession, path: str, limit: int = 2, late: str = "2 hours") -> DataFrame:
    """Run the hourly rate limit as a stream over the files of ``path`` until they are read, and return what it wrote.

    State is dropped once the watermark has passed an hour.  Every batch
    appends the hours that changed; the last batch to mention an hour counts.
    """
    schema = spark.read.parquet(path).schema
    folder, glob = (path.rsplit("/", 1)[0], path.rsplit("/", 1)[1])
    out = shared_dir(spark, "rate")
    source = spark.readStream.schema(schema)
    stream = source.option("pathGlobFilter", "*.parquet").parquet(path) if _is_folder(spark, path) else source.option("pathGlobFilter", glob).parquet(folder)

    def keep(batch: DataFrame, number: int) -> None:
        # A batch that runs again writes the same folder again.
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    _finish(hourly_counts(stream, limit, late).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", shared_dir(spark, "state")))
    changes = spark.read.schema("user_id long, hour timestamp_ntz, n long, batch long").parquet(f"{out}/*")
    return changes.groupBy("user_id", "hour").agg(F.max_by("n", "batch").alias("n"))


def ingest_stream(spark: SparkSession, folder: str, target: Snapshots, settings: ingest.Settings, checkpoint: str, glob: str = "*") -> list[dict]:
    """Index the files that are new in ``folder`` since the last call with this checkpoint; return a report per batch.

    Each micro-batch runs the batch plan, so a file that comes again unchanged
    is skipped and one that changed replaces its chunks.
    """
    schema = "path string, modificationTime timestamp, length long, content binary"
    stream = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
    reports: list[dict] = []

    def one(batch: DataFrame, number: int) -> None:
        reports.append(ingest.run(batch.where(files.wanted(F.col("path"))).select("path", "content"), target, settings).report().first().asDict())

    _finish(stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint))
    return reports


def _is_folder(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hadoop).isDirectory()
