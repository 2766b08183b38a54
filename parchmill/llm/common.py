"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.paths import materialize, remove, shared_dir  # noqa: F401  (the operators take them from here)

#: The 26 letters that the contracts fold; other letters keep their case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc32_of_id(doc_id) -> F.Column:
    """crc32 of the id written as decimal text (null ids count as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def text_or_empty(column: str = "text") -> F.Column:
    return F.coalesce(F.col(column), F.lit(""))


def split_hot(rows: DataFrame, keys: list[str], spread_by: str, size: int) -> DataFrame:
    """Add ``tile``: groups of ``keys`` above ``size`` rows are cut by a hash.

    The counts are pre-aggregated before their shuffle, and only groups that
    are too large come back to the rows, so the joined side has at most
    ``rows / size`` entries.
    """
    hot = (
        rows.groupBy(*keys).count().where(F.col("count") > size)
        .select(*keys, F.ceil(F.col("count") / F.lit(size)).cast("int").alias("tiles"))
    )
    return rows.join(hot, keys, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1))).withColumn(
        "tile", F.pmod(F.xxhash64(F.lit("tile"), F.col(spread_by)), F.col("tiles").cast("long")).cast("int")
    )


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have, one for each of ``names``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


#: A key is hot if it holds more than this share of the rows, so there are at most 1 / HOT hot keys.
HOT = 1 / 1000


def join_classes(rows: DataFrame, classes: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``rows`` with the columns of their class, by an inner join on ``key``.

    classes: one row per key with its number of rows in ``size``.  The hot
    keys' classes, at most 1 / HOT of them, are sent to every task, so that no
    task gets all rows of a hot key; the others meet their rows by a shuffle.
    """
    hot = classes.where(F.col(size) > total * HOT)
    told = rows.join(F.broadcast(hot.withColumn("hot_", F.lit(True))), key, "left")
    cold = told.where("hot_ is null").select(*rows.columns).join(classes.where(F.col(size) <= total * HOT), key)
    return told.where("hot_").drop("hot_").unionByName(cold)


def running_totals(counts: DataFrame, key: str, value: str, name: str, group: int = 1024) -> DataFrame:
    """``counts`` with the sum of ``value`` over all lower keys; keys are whole numbers, once each.

    Keys are summed up in groups first, so the one ordered pass over everything has a row per ``group`` keys.
    """
    part = F.floor(F.col(key) / group)
    sums = counts.groupBy(part.alias("part_")).agg(F.sum(value).alias("sum_"))
    ahead = sums.select("part_", (F.sum("sum_").over(Window.orderBy("part_")) - F.col("sum_")).alias("ahead_"))
    inside = F.sum(value).over(Window.partitionBy("part_").orderBy(key)) - F.col(value)
    return counts.withColumn("part_", part).withColumn("inside_", inside).join(ahead, "part_").withColumn(name, F.col("ahead_") + F.col("inside_")).drop("part_", "inside_", "ahead_")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_bounds(docs: DataFrame, key: str) -> tuple[list[int], int]:
    """Bounds that cut the ids into about as many equal ranges as there are shuffle partitions.

    Only the id column is read.  Bucket 0 is for null ids; bucket b > 0 holds
    ids from bounds[b - 2] on.  Second: the number of buckets.
    """
    n = partitions(docs.sparkSession)
    bounds = docs.select(F.col(key).cast("long").alias("k")).where("k is not null").approxQuantile("k", [i / n for i in range(1, n)], 0.2 / n) if n > 1 else []
    bounds = sorted({int(b) for b in bounds})
    return bounds, len(bounds) + 2


def by_bucket(df: DataFrame, bucket: str, n: int) -> DataFrame:
    """One partition per bucket where Spark can place rows by number, else hashed."""
    if hasattr(df, "repartitionById"):
        return df.repartitionById(n, F.col(bucket).cast("int"))
    return df.repartition(n, bucket)


def packed_texts(docs: DataFrame, bounds: list[int]) -> DataFrame:
    """(bucket, doc_id, body): texts compressed for their one shuffle; bucket by doc_id as in id_bounds."""

    def run(batches):
        edges, pack = np.array(bounds, np.int64), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            ids = batch.column(0)
            bucket = np.searchsorted(edges, np.asarray(ids.fill_null(0), np.int64), side="right") + 1
            bucket[np.asarray(ids.is_null())] = 0
            bodies = [pack.compress((t.as_py() or "").encode("utf-8", "surrogatepass")) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), ids, pa.array(bodies, pa.binary())], ["bucket", "doc_id", "body"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "bucket int, doc_id long, body binary")


def unpack(body: bytes) -> str:
    return zstandard.ZstdDecompressor().decompress(body).decode("utf-8", "surrogatepass")
