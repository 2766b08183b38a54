"""Approximate vector search: an inverted-list index in a folder, with filters inside the search and an exact way beside it.

Vectors are put on the list of their nearest centroid.  A query looks through
the lists whose centroids are nearest to it; how many of them it takes for the
wanted recall is measured when the index is made.  All of a query's lists are an
exact search.  Only the centroids and the number of lists to probe are fitted on
a sample (of SAMPLE rows and SAMPLE_NUMBERS numbers at most); every vector is indexed.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .changes import ChangedTable
from .retrieve import SENT, top

#: What the centroids are fitted on at most; lists at most; rounds of the fit; queries that the recall is measured with.
SAMPLE, SAMPLE_NUMBERS, LISTS, ROUNDS, PROBED = 16_384, 16 << 20, 4096, 12, 256
#: Rows of a block where queries and vectors meet by a shuffle.
BLOCK = 1024
#: Rows that bound the scores at first, roughly; scores that a task holds before it sorts them out.
BOUND, HELD = 4096, 1 << 20


def usable(vector: Column) -> Column:
    """Vectors with a direction: no missing or infinite numbers, not all zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~odd & F.exists(vector, lambda x: x != 0)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def matrix(vectors) -> np.ndarray:
    """An Arrow list column as unit rows of doubles."""
    return unit(np.asarray(vectors.flatten(), np.float64).reshape(len(vectors), -1))


def rounded(score: np.ndarray) -> np.ndarray:
    """To 6 decimals, halves away from zero, as in SQL."""
    return np.copysign(np.floor(np.abs(score) * 1e6 + 0.5), score) / 1e6


def fit(sample: np.ndarray, lists: int, recall: float, k: int = 10, seed: int = 7) -> tuple[np.ndarray, int]:
    """Centroids of unit vectors by spherical k-means, and how many lists reach ``recall`` of the k nearest within the sample."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.choice(len(sample), lists, replace=False)]
    for _ in range(ROUNDS):
        near = (sample @ centroids.T).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, sample)
        size = np.sqrt((sums * sums).sum(1))
        centroids = np.where(size[:, None] > 1e-12, sums / np.maximum(size, 1e-12)[:, None], centroids)
    near = (sample @ centroids.T).argmax(1)
    asked = rng.choice(len(sample), min(PROBED, len(sample)), replace=False)
    score = sample[asked] @ sample.T
    score[np.arange(len(asked)), asked] = -np.inf
    k = min(k, len(sample) - 1)
    if not k:
        return centroids, lists
    best = np.argpartition(-score, k - 1, axis=1)[:, :k]
    order = np.argsort(-(sample[asked] @ centroids.T), axis=1)
    place = np.argsort(order, axis=1)  # how near a list is to each query
    needed = np.sort(place[np.arange(len(asked))[:, None], near[best]].ravel())
    return centroids, int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1


class VectorIndex(ChangedTable):
    """Vectors below ``root`` by list; ``extra`` are columns (DDL) that filters can use.

    Changes are commits of the table: a vector that is given again replaces the
    old one.  Vectors without a direction are not indexed.
    """

    def __init__(self, spark: SparkSession, root: str, extra: str = "", compact_after: int = 32):
        self.extra = [c.strip().split(" ")[0] for c in extra.split(",") if c.strip()]
        super().__init__(spark, root, ", ".join(x for x in ("vec_id long, list int, embedding array<float>", extra) if x), "vec_id", compact_after)

    # -- the fit

    def fit(self, vectors: DataFrame, recall: float = 0.95, lists: int | None = None) -> None:
        """Fit centroids and probes on a sample in hash order, and write them once."""
        good = vectors.where(usable(F.col("embedding")))
        n, numbers = good.agg(F.count("*"), F.max(F.size("embedding"))).first()
        if not n:
            raise ValueError("no vector with a direction to fit on")
        most = max(1, min(SAMPLE, SAMPLE_NUMBERS // numbers))
        sample = good.select("embedding").orderBy(F.xxhash64("vec_id"), "vec_id").limit(most).toArrow().column("embedding").combine_chunks()
        rows = matrix(sample)
        lists = min(lists or max(1, int(n**0.5)), LISTS, len(rows))
        centroids, probes = fit(rows, lists, recall)
        path, fs = self._path("fit.json")
        stream = fs.create(path, True)
        stream.write(bytearray(json.dumps({"probes": probes, "recall": recall, "centroids": centroids.astype(np.float32).tolist()}).encode()))
        stream.close()

    def fitted(self) -> tuple[np.ndarray, int]:
        """Centroids (LISTS at most) and probes."""
        told = json.loads(self.spark.read.text(f"{self.root}/fit.json", wholetext=True).first()[0])
        return np.array(told["centroids"], np.float64), told["probes"]

    # -- changes

    def listed(self, vectors: DataFrame) -> DataFrame:
        """``vectors`` (vec_id, embedding and the extra columns) with their list."""
        centroids, names = self.fitted()[0], [f.split(" ")[0] for f in self.ddl.split(", ")]

        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    near = (matrix(batch.column("embedding")) @ centroids.T).argmax(1)
                    yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(near.astype(np.int32)), *batch.columns[1:]], names)

        good = vectors.where(usable(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"), *self.extra)
        return good.mapInArrow(run, self.ddl)

    def put(self, vectors: DataFrame, deleted: DataFrame | None = None, since: int | None = None) -> int:
        """Add or replace vectors, and delete those named in ``deleted`` (vec_id); return the version."""
        if deleted is None:
            deleted = self.spark.createDataFrame([], "vec_id long")
        return self.commit(self.listed(vectors), vectors.select("vec_id").union(deleted.select("vec_id")), since)

    def _write(self, rows: DataFrame, folder: str) -> None:
        # Rows of a list lie together, so a scan for some lists skips the other row groups.
        rows.sortWithinPartitions("list").write.option("parquet.block.size", 8 << 20).parquet(f"{self.root}/data/folder={folder}")

    # -- search

    def probes(self, queries: DataFrame, probes: int) -> DataFrame:
        """(query_id, list, q): each query with its nearest lists."""
        centroids, _ = self.fitted()
        probes = min(probes, len(centroids))

        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    near = np.argsort(-(matrix(batch.column("embedding")) @ centroids.T), axis=1, kind="stable")[:, :probes]
                    rows = pa.array(np.repeat(np.arange(batch.num_rows), probes))
                    yield pa.RecordBatch.from_arrays([batch.column("query_id").take(rows), pa.array(near.ravel().astype(np.int32)), batch.column("embedding").take(rows)], ["query_id", "list", "q"])

        good = queries.where(usable(F.col("embedding"))).select(F.col("query_id").cast("long").alias("query_id"), F.col("embedding").cast("array<float>").alias("embedding"))
        return good.mapInArrow(run, "query_id long, list int, q array<float>")

    def search(self, queries: DataFrame, k: int = 10, probes: int | None = None, where: Column | None = None, exact: bool = False, version: int | None = None) -> DataFrame:
        """(query_id, vec_id, score, rank): the k nearest vectors in each query's lists, by cosine rounded to 6 decimals, ties to the smallest id.

        ``where`` is a condition on the index's columns; rows that don't meet it
        are left out before any score, so a filtered result is that of a search
        among the filtered rows.  ``exact`` looks through all lists.  A vector
        isn't its own neighbour; queries without a direction find nothing.
        """
        centroids, fitted = self.fitted()
        many = len(centroids) if exact else min(probes or fitted, len(centroids))
        rows = self.read(version)
        rows = (rows if where is None else rows.where(where)).select("vec_id", "list", "embedding")
        n, numbers = queries.agg(F.count("*"), F.coalesce(F.sum(F.size("embedding")), F.lit(0))).first()
        asked = self.probes(queries, many)
        found = self._sent(rows, asked, k) if 8 * numbers + 4 * n * many <= SENT else self._shuffled(rows, asked, k)
        return top(found, "score", "query_id", "vec_id", k)

    def _sent(self, rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
        """Queries of SENT bytes at most go to every task; the vectors are scored where they are read, and a task gives k rows a query at most."""
        table = asked.groupBy("query_id").agg(F.first("q").alias("q"), F.collect_set("list").alias("lists")).toArrow().combine_chunks()
        if not table.num_rows:
            return self.spark.createDataFrame([], "query_id long, vec_id long, score double")
        ids, q = table.column("query_id").to_numpy(), matrix(table.column("q").combine_chunks())
        looks = np.zeros((len(ids), len(self.fitted()[0])), bool)
        for i, lists in enumerate(table.column("lists").to_pylist()):
            looks[i, lists] = True
        # The k-th score among some of the rows is one that a neighbour has to reach.
        step = max(1, rows.count() // BOUND)
        some = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(step)) == 0).limit(4 * BOUND).select("vec_id", "embedding").toArrow().combine_chunks()
        least = np.full(len(ids), -np.inf)
        if some.num_rows:
            for at in range(0, len(ids), BLOCK):
                part = slice(at, at + BLOCK)
                found = np.concatenate([rounded(q[part] @ matrix(some.column("embedding").combine_chunks()).T), np.full((len(ids[part]), k), -np.inf)], axis=1)
                found[:, : some.num_rows][ids[part][:, None] == some.column("vec_id").to_numpy()[None, :]] = -np.inf
                least[part] = np.partition(found, -k, axis=1)[:, -k]
        held = self.spark.sparkContext.broadcast((ids, q, looks, least))
        wanted = [int(x) for x in np.flatnonzero(looks.any(0))]

        def run(batches):
            ids, q, looks, least = held.value
            least, kept, size = least.copy(), [], 0

            def best():
                """The k best so far of each query; the k-th is what others have to reach from now on."""
                who, vec, score = (np.concatenate(x) for x in zip(*kept))
                order = np.lexsort((vec, -score, who))
                who, vec, score = who[order], vec[order], score[order]
                nth = np.arange(len(who)) - np.searchsorted(who, who)
                full = nth == k - 1
                least[who[full]] = np.maximum(least[who[full]], score[full])
                return [(who[nth < k], vec[nth < k], score[nth < k])]

            for batch in batches:
                lists = np.asarray(batch.column("list"))
                vec, unit_rows = np.asarray(batch.column("vec_id")), matrix(batch.column("embedding")) if batch.num_rows else None
                for one in np.unique(lists):
                    at, who = np.flatnonzero(lists == one), np.flatnonzero(looks[:, one])
                    score = rounded(q[who] @ unit_rows[at].T)
                    score[ids[who][:, None] == vec[at][None, :]] = -np.inf
                    i, j = np.nonzero((score >= least[who][:, None]) & np.isfinite(score))
                    kept.append((who[i], vec[at[j]], score[i, j]))
                    size += len(i)
                    if size > HELD:
                        kept = best()
                        size = len(kept[0][0])
            if kept:
                who, vec, score = best()[0]
                yield pa.RecordBatch.from_arrays([pa.array(ids[who]), pa.array(vec), pa.array(score)], ["query_id", "vec_id", "score"])

        if len(wanted) < looks.shape[1] <= LISTS:
            rows = rows.where(F.col("list").isin(wanted))  # reaches the scan
        return rows.mapInArrow(run, "query_id long, vec_id long, score double")

    def _shuffled(self, rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
        """Queries and vectors meet by list, in blocks of BLOCK rows, so a long list is many tasks."""
        sizes = rows.groupBy("list").count().select("list", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
        dealt = rows.join(sizes, "list").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks").cast("long")).cast("int"))
        sent = dealt.groupBy("list", "block").agg(F.collect_list(F.struct(F.col("vec_id").alias("id"), "embedding")).alias("v"))
        many = asked.groupBy("list").count().select("list", F.ceil(F.col("count") / BLOCK).cast("int").alias("parts"))
        grouped = asked.join(many, "list").withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("parts").cast("long")).cast("int")).groupBy("list", "part").agg(
            F.collect_list(F.struct(F.col("query_id").alias("id"), F.col("q").alias("embedding"))).alias("q")
        )
        every = grouped.join(sizes, "list").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

        def run(batches):
            for batch in batches:
                for one, two in zip(batch.column("q"), batch.column("v")):
                    yield from _best(np.asarray(one.values.field("id")), matrix(one.values.field("embedding")), np.asarray(two.values.field("id")), matrix(two.values.field("embedding")), k)

        return every.join(sent, ["list", "block"]).select("q", "v").mapInArrow(run, "query_id long, vec_id long, score double")


def _best(ids: np.ndarray, q: np.ndarray, vec_ids: np.ndarray, vectors: np.ndarray, k: int):
    """The k best of some vectors for each query, as a batch."""
    order = np.argsort(vec_ids, kind="stable")
    vec_ids = vec_ids[order]
    score = rounded(q @ vectors[order].T)
    score[ids[:, None] == vec_ids[None, :]] = -np.inf
    best = np.argsort(-score, axis=1, kind="stable")[:, :k]
    rows = np.repeat(np.arange(len(ids)), best.shape[1])
    s = score[rows, best.ravel()]
    ok = np.isfinite(s)
    yield pa.RecordBatch.from_arrays([pa.array(ids[rows][ok]), pa.array(vec_ids[best.ravel()][ok]), pa.array(s[ok])], ["query_id", "vec_id", "score"])

