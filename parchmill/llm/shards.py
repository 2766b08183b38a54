"""Operator 6: two-pass external shuffle into shards.

Pass 1 scatters records uniformly over buckets that fit in memory, by a seeded
hash.  Pass 2 takes each bucket, puts it in canonical order, shuffles it with a
seeded Fisher-Yates and writes it.  The buckets one after the other are a
uniformly shuffled order of all records, which is cut into shards whose row
counts are at most one apart.

Copies of one row hash alike.  So that a row with very many copies doesn't fill
one bucket, copies are numbered and every RUN of them has a hash of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import by_bucket, fresh, materialize, partitions, running_totals, shared_dir

#: What pass 2 holds at once at most, in bytes of text; a record adds RECORD_BYTES; copies that stay together.
BUCKET_BYTES, RECORD_BYTES, RUN = 16 << 20, 16, 64


def fisher_yates(n: int, seed: int) -> np.ndarray:
    """A uniform permutation; numpy's shuffle is a Fisher-Yates."""
    order = np.arange(n)
    np.random.Generator(np.random.PCG64(seed)).shuffle(order)
    return order


def numbered(rows: DataFrame, tie: str, nth: str, part: str) -> DataFrame:
    """``rows`` with ``nth``: the number of a row among its copies, from 0, where there are more than RUN of them, else 0.

    Copies are counted per input partition and these counts added up, so a row
    that is a third of the input is numbered by as many tasks as read it.
    """
    many = materialize(rows.groupBy(tie).count().where(F.col("count") > RUN).select(tie), "copied")
    if many.isEmpty():
        return rows.withColumn(nth, F.lit(0).cast("long"))
    hot = materialize(rows.join(many, tie, "left_semi").withColumn(part, F.spark_partition_id()), "copies")
    w = Window.partitionBy(tie).orderBy(part)
    ahead = hot.groupBy(tie, part).count().select(tie, part, (F.sum("count").over(w) - F.col("count")).alias(nth))
    (place,) = fresh(hot, "place")
    inside = F.row_number().over(Window.partitionBy(tie, part).orderBy(part)) - 1
    told = hot.withColumn(place, inside).join(ahead, [tie, part]).withColumn(nth, F.col(nth) + F.col(place)).drop(place, part)
    return rows.join(many, tie, "left_anti").withColumn(nth, F.lit(0).cast("long")).unionByName(told)


def write_shards(docs: DataFrame, shards: int, seed: int = 17, path: str | None = None, bucket_bytes: int = BUCKET_BYTES) -> str:
    """Write all rows of ``docs`` in shuffled order below ``path`` (a new shared folder if None); return it.

    The table has the columns of ``docs`` and shard (int), slot (long, gapless
    from 0 in each shard), which replace columns of these names.  Law 'rows':
    shard sizes are at most one row apart.  The order depends on the rows, the
    seed and the number of buckets alone, not on how the input is split (which
    of several rows that agree in doc_id and text comes first isn't set).  Null
    texts and ids are kept.  An empty table gives an empty table.
    """
    spark, docs = docs.sparkSession, docs.drop("shard", "slot")
    columns = docs.columns
    tie, nth, part, bucket, kind, first = fresh(docs, "tie", "nth", "part", "bucket", "kind", "first")
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + RECORD_BYTES
    n = max(partitions(spark), -(-(docs.agg(F.sum(size)).first()[0] or 0) // bucket_bytes))
    rows = numbered(docs.withColumn(tie, F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), "text")), tie, nth, part)
    rows = rows.withColumn(bucket, F.pmod(F.xxhash64(F.lit(seed), tie, F.floor(F.col(nth) / RUN)), F.lit(n)).cast("int")).drop(nth)
    counts = materialize(rows.groupBy(bucket).agg(F.count("*").alias("rows")), "buckets")
    everything = counts.agg(F.sum("rows")).first()[0] or 0
    # A bucket begins with a row that says how many rows come before it, so nothing has to be sent to every task.
    heads = running_totals(counts, bucket, "rows", first).select(bucket, first, F.lit(0).alias(kind))
    both = rows.withColumn(kind, F.lit(1)).unionByName(heads, allowMissingColumns=True)
    placed = by_bucket(both, bucket, n).sortWithinPartitions(bucket, kind, tie)

    def second_pass(batches):
        held, number, before = [], None, 0

        def out():
            rows = pa.Table.from_batches(held).select(columns)
            order = fisher_yates(rows.num_rows, (seed << 32) + number)
            at = before + np.arange(rows.num_rows)
            low, more = divmod(everything, shards)
            cut = more * (low + 1)  # the first shards have one row more
            shard = np.where(at < cut, at // (low + 1), more + (at - cut) // max(low, 1))
            begin = np.where(shard < more, shard * (low + 1), cut + (shard - more) * low)
            done = rows.take(pa.array(order)).append_column("shard", pa.array(shard.astype(np.int32))).append_column("slot", pa.array(at - begin))
            return done.combine_chunks().to_batches()

        for batch in batches:
            is_head = np.asarray(batch.column(kind)) == 0
            cuts = [0, *np.flatnonzero(is_head).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a < b and is_head[a]:
                    if held:
                        yield from out()
                    held, number, before = [], batch.column(bucket)[a].as_py(), batch.column(first)[a].as_py()
                    a += 1
                if a < b:
                    held.append(batch.slice(a, b - a))
        if held:
            yield from out()

    schema = StructType([*docs.schema.fields, StructField("shard", IntegerType()), StructField("slot", LongType())])
    path = path or shared_dir(spark, "shards")
    placed.mapInArrow(second_pass, schema).write.parquet(path)
    return path


def shard_report(docs: DataFrame, shards: int = 40, seed: int = 17) -> DataFrame:
    """The written shards as doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    path = write_shards(docs.select("doc_id", "text"), shards, seed)
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.sparkSession.read.parquet(path).select(
        "doc_id", (F.octet_length(text) + RECORD_BYTES).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
