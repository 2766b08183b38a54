"""Keyword search over a stored index: compressed posting blocks with bounds, and MaxScore over slices of documents.

Documents are dealt into slices.  A posting block holds a word's documents in
one slice, with the largest frequency and the smallest size in it, so the best
score that a slice can hold for a query is known without reading the block.  A
query is first answered in its most promising slice; the k-th score found there
rules out slices and, inside a slice, documents.  Scores are summed in arrays,
so no row per query and document is ever made.

Documents that are given again or deleted leave their old postings behind; the
table of live documents says which postings count.  Frequencies of words are
those of the live documents.
"""

from __future__ import annotations

import uuid
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.paths import materialize
from .changes import ChangedTable
from .retrieve import K1, B, question_terms, terms, top

#: Documents and words of a slice at most, roughly; queries that are answered together; words that are sent to the scan as a list.
SLICE_DOCS, SLICE_WORDS, QUERIES, LISTED = 4096, 2_000_000, 512, 2000
#: What rounding to 6 decimals can add to a score.
SLACK = 1e-6

POSTINGS = "term string, slice long, df int, max_tf double, min_size double, places binary, tfs binary"


#: Lists of fewer bytes are kept as they are; posting blocks that leave a task at once.
PLAIN, ROWS = 256, 20_000


@cache
def _engines() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _packed(values: np.ndarray) -> bytes:
    raw = values.tobytes()
    return b"\0" + raw if len(raw) < PLAIN else b"\1" + _engines()[0].compress(raw)


def _unpacked(packed: bytes, kind) -> np.ndarray:
    return np.frombuffer(packed[1:] if packed[:1] == b"\0" else _engines()[1].decompress(packed[1:]), kind)


def _places(packed: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(packed, np.int32))


def _tfs(packed: bytes) -> np.ndarray:
    return _unpacked(packed, np.float64)


def weight(tf, size, mean):
    """What a word adds to a score for each unit of its rarity; it grows with tf and falls with size."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / mean))


class KeywordIndex:
    """Postings and live documents below ``root``.

    fields: weights of the text columns; extra: columns (DDL) that filters can use.
    """

    def __init__(self, spark: SparkSession, root: str, fields: dict[str, float] | None = None, extra: str = "", compact_after: int = 32):
        self.spark, self.root, self.fields = spark, root.rstrip("/"), fields or {"text": 1.0}
        self.extra = [c.strip().split(" ")[0] for c in extra.split(",") if c.strip()]
        self.live = ChangedTable(spark, f"{self.root}/documents", ", ".join(x for x in ("doc_id long, slice long, place int, size double", extra) if x), "doc_id", compact_after)

    # -- changes

    def put(self, documents: DataFrame, deleted: DataFrame | None = None, since: int | None = None) -> int:
        """Add or replace documents (doc_id and the fields), and delete those named in ``deleted`` (doc_id); return the version.

        Null fields are empty; documents without words count with size 0.  Of
        rows with one doc_id, one is taken; rows without an id are left out.
        """
        counted = [F.coalesce(F.col(c), F.lit("")) for c in self.fields]
        size = sum((F.size(terms(c)) * F.lit(w) for c, w in zip(counted, self.fields.values())), F.lit(0.0))
        rows = documents.where("doc_id is not null").withColumns({"doc_id": F.col("doc_id").cast("long"), "mark": F.xxhash64(*counted)})
        n, words = rows.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0.0))).first()
        slices = max(1, -(-n // SLICE_DOCS), int(words // SLICE_WORDS) + 1)
        base = (uuid.uuid4().int & (2**30 - 1)) << 32
        dealt = rows.withColumn("slice", F.lit(base) + F.pmod(F.xxhash64("doc_id"), F.lit(slices)))
        # Texts are shuffled once, with the slice they go to; places follow from the ids alone, here and there.
        one = dealt.select("doc_id", "slice", F.struct("mark", size.alias("size"), *self.extra).alias("told")).groupBy("doc_id", "slice").agg(F.min_by("told", "told.mark").alias("told"))
        place = (F.row_number().over(Window.partitionBy("slice").orderBy("doc_id")) - 1).cast("int")
        placed = materialize(one.select("doc_id", "slice", place.alias("place"), "told.size", *[f"told.{c}" for c in self.extra]), "placed")
        folder = f"{self.root}/postings/{uuid.uuid4().hex}"
        weights = list(self.fields.values())
        texts = [F.coalesce(F.col(c), F.lit("")).alias(f"f{k}") for k, c in enumerate(self.fields)]
        sent = dealt.select("slice", "doc_id", "mark", *texts).repartition("slice").sortWithinPartitions("slice", "doc_id", "mark")
        listed = sent.select("slice", "doc_id", *[terms(F.col(f"f{k}")).alias(f"f{k}") for k in range(len(self.fields))])

        def run(batches):
            held, now = [], None
            for batch in batches:
                numbers = np.asarray(batch.column("slice"))
                for at, end in zip(cuts := [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist()], [*cuts[1:], len(numbers)]):
                    if at == end:
                        continue
                    if held and numbers[at] != now:
                        yield from _blocks(now, pa.Table.from_batches(held), weights)
                        held = []
                    held.append(batch.slice(at, end - at))
                    now = int(numbers[at])
            if held:
                yield from _blocks(now, pa.Table.from_batches(held), weights)

        blocks = listed.mapInArrow(run, POSTINGS)
        blocks.sortWithinPartitions("term").write.option("parquet.block.size", 16 << 20).parquet(folder)
        gone = deleted.select(F.col("doc_id").cast("long").alias("doc_id")) if deleted is not None else self.spark.createDataFrame([], "doc_id long")
        return self.live.commit(placed.select("doc_id", "slice", "place", "size", *self.extra), placed.select("doc_id").union(gone), since)

    def _postings(self, asked: DataFrame) -> DataFrame:
        """Blocks of the asked words."""
        path, fs = self.live._path("../postings")
        folders = [str(s.getPath()) for s in fs.listStatus(path)] if fs.exists(path) else []
        if not folders:
            return self.spark.createDataFrame([], POSTINGS)
        rows = self.spark.read.schema(POSTINGS).parquet(*folders)
        words = [r[0] for r in asked.select("term").distinct().limit(LISTED + 1).collect()]
        if len(words) <= LISTED:
            return rows.where(F.col("term").isin(words))  # reaches the scan
        return rows.join(asked.select("term").distinct(), "term", "left_semi")

    # -- search

    def search(self, queries: DataFrame, k: int = 10, where: Column | None = None, version: int | None = None) -> DataFrame:
        """(query_id, doc_id, score, rank): the k best documents by BM25 per query, ties to the smallest doc_id.

        ``where`` is a condition on doc_id and the extra columns; documents that
        don't meet it are left out before any score.  Rarity and mean size are
        those of all live documents, so a filtered score is that of the whole search.
        """
        live = self.live.read(version)
        total = live.agg(F.count("*").alias("n"), F.avg("size").alias("mean")).first()
        asked = materialize(question_terms(queries), "asked")
        nothing = self.spark.createDataFrame([], "query_id long, doc_id long, score double, rank int")
        if not total["n"]:
            return nothing
        n, mean = total["n"], total["mean"] or 1.0
        blocks = self._postings(asked)
        alive = live.groupBy("slice").agg(F.collect_list("place").alias("alive"))
        heads = blocks.join(alive.select("slice"), "slice", "left_semi").select("term", "slice", "df", "max_tf", "min_size")
        df = self._frequencies(blocks, alive, live)
        rarity = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
        told = materialize(asked.join(df, "term").select("query_id", "term", rarity.alias("idf")), "rarity")
        bound = F.col("idf") * weight(F.col("max_tf"), F.col("min_size"), mean)
        bounds = told.join(heads.select("term", "slice", "max_tf", "min_size"), "term").groupBy("query_id", "slice").agg(F.sum(bound).alias("bound"))
        bounds = materialize(bounds, "bounds")
        chosen = live if where is None else live.where(where)
        documents = materialize(chosen.groupBy("slice").agg(F.collect_list(F.struct("place", "doc_id", "size")).alias("documents")), "documents")
        first = bounds.join(documents.select("slice"), "slice", "left_semi").groupBy("query_id").agg(F.max_by("slice", F.struct("bound", "slice")).alias("slice")).withColumn("least", F.lit(0.0))
        one = materialize(self._answered(first, told, blocks, documents, k, mean), "first")
        least = one.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).otherwise(0.0).alias("least"))
        rest = bounds.join(least, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(0.0))).where(F.col("bound") + SLACK >= F.col("least"))
        rest = rest.join(first.select("query_id", "slice"), ["query_id", "slice"], "left_anti").select("query_id", "slice", "least")
        return top(one.union(self._answered(rest, told, blocks, documents, k, mean)), "score", "query_id", "doc_id", k)

    def _frequencies(self, blocks: DataFrame, alive: DataFrame, live: DataFrame) -> DataFrame:
        """(term, df) over live documents: whole blocks count by their head, blocks with dead documents by their places."""
        ever = self._slices()
        worn = alive.join(ever, "slice").where(F.size("alive") < F.col("docs")).select("slice", "alive")
        whole = alive.join(ever, "slice").where(F.size("alive") == F.col("docs")).select("slice")

        def run(batches):
            for batch in batches:
                out = [int(np.isin(_places(p), a).sum()) for p, a in zip(batch.column("places").to_pylist(), batch.column("alive").to_pylist())]
                yield pa.RecordBatch.from_arrays([batch.column("term"), pa.array(out, pa.int32())], ["term", "df"])

        counted = blocks.join(worn, "slice").select("term", "places", "alive").mapInArrow(run, "term string, df int")
        return blocks.join(whole, "slice", "left_semi").select("term", "df").union(counted).groupBy("term").agg(F.sum("df").alias("df")).where("df > 0")

    def _slices(self) -> DataFrame:
        """(slice, docs): how many documents each slice was made of."""
        states = {f for v in self.live.versions() for f in [self.live.state(v).get("folder")] if f}
        rows = self.live._folders("data", [[f, 0] for f in sorted(states)], self.live.ddl)
        return rows.groupBy("slice").agg(F.count("*").alias("docs"))

    def _answered(self, pairs: DataFrame, told: DataFrame, blocks: DataFrame, documents: DataFrame, k: int, mean: float) -> DataFrame:
        """(query_id, doc_id, score): the k best of each pair of query and slice that reach ``least``."""
        asked = pairs.join(told, "query_id").join(blocks.select("term", "slice"), ["term", "slice"], "left_semi")
        needed = asked.select("term", "slice").distinct()
        part = F.floor(F.dense_rank().over(Window.partitionBy("slice").orderBy("query_id")) / QUERIES)
        grouped = asked.withColumn("part", part).groupBy("slice", "part").agg(F.collect_list(F.struct("query_id", "term", "idf", "least")).alias("asked"))
        held = blocks.join(needed, ["term", "slice"], "left_semi").groupBy("slice").agg(F.collect_list(F.struct("term", "places", "tfs")).alias("blocks"))
        rows = grouped.join(held, "slice").join(documents, "slice").select("asked", "blocks", "documents")

        def run(batches):
            for batch in batches:
                for row in zip(*batch.columns):
                    yield from _scored(*(x.as_py() for x in row), k, mean)

        return rows.mapInArrow(run, "query_id long, doc_id long, score double")


def _blocks(number: int, rows: pa.Table, weights: list[float]):
    """Posting blocks of one slice: how often each word stands in each document, from the lists of words."""
    ids = np.asarray(rows.column("doc_id"))
    rows = rows.take(pa.array(np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))))  # the first of each id
    place, size, words, at, often = np.arange(rows.num_rows), np.zeros(rows.num_rows), [], [], []
    for k, w in enumerate(weights):
        column = rows.column(f"f{k}").combine_chunks()
        lengths = np.diff(np.asarray(column.offsets))
        words.append(column.flatten())
        at.append(np.repeat(np.arange(len(place)), lengths))
        often.append(np.full(int(lengths.sum()), w))
        size = size + w * lengths
    coded = pa.concat_arrays(words).dictionary_encode()
    if not len(coded):
        return
    code, at, often = np.asarray(coded.indices).astype(np.int64), np.concatenate(at), np.concatenate(often)
    key, where = np.unique(code * len(place) + at, return_inverse=True)
    tf = np.bincount(where, weights=often)
    code, at = key // len(place), key % len(place)
    cuts = np.append(np.flatnonzero(np.diff(code, prepend=-1)), len(code))
    terms_, out = coded.dictionary.to_pylist(), []
    types = [pa.string(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.binary(), pa.binary()]
    names = ["term", "slice", "df", "max_tf", "min_size", "places", "tfs"]
    for a, b in zip(cuts, cuts[1:]):
        places = place[at[a:b]]
        out.append((terms_[code[a]], number, b - a, tf[a:b].max(), size[at[a:b]].min(), _packed(np.diff(places, prepend=0).astype(np.int32)), _packed(tf[a:b])))
        if len(out) == ROWS or b == len(code):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
            out = []


def _scored(asked: list[dict], blocks: list[dict], documents: list[dict], k: int, mean: float):
    """MaxScore inside a slice: words of most weight first, over arrays of its documents."""
    width = 1 + max(d["place"] for d in documents)
    ids, sizes, here = np.zeros(width, np.int64), np.ones(width), np.zeros(width, bool)
    for d in documents:
        ids[d["place"]], sizes[d["place"]], here[d["place"]] = d["doc_id"], d["size"], True
    weights = {}
    for b in blocks:
        places, tf = _places(b["places"]), _tfs(b["tfs"])
        known = places < width
        places, tf = places[known], tf[known]
        ok = here[places]
        places = places[ok]
        weights[b["term"]] = places, weight(tf[ok], sizes[places], mean)
    queries: dict[int, list[dict]] = {}
    for a in asked:
        queries.setdefault(a["query_id"], []).append(a)
    out = []
    for query, words in queries.items():
        lists = sorted(((w["idf"] * weights[w["term"]][1].max(initial=0.0), w["idf"], *weights[w["term"]]) for w in words if w["term"] in weights), key=lambda x: -x[0])
        ahead, least = sum(x[0] for x in lists), words[0]["least"] - SLACK
        score, seen, some = np.zeros(width), np.zeros(width, bool), None
        for best, idf, places, weigh in lists:
            if some is None and ahead < least:
                some = np.flatnonzero(seen)  # no new document can reach the k-th score any more
            if some is not None:
                some = some[score[some] + ahead >= least]
                if not len(places):
                    continue
                at = np.minimum(np.searchsorted(places, some), len(places) - 1)
                hit = places[at] == some
                score[some[hit]] += idf * weigh[at[hit]]
            else:
                score[places] += idf * weigh
                seen[places] = True
            ahead -= best
        found = np.flatnonzero(seen) if some is None else some
        found = found[score[found] >= least]
        total = np.floor(score[found] * 1e6 + 0.5) / 1e6
        order = np.lexsort((ids[found], -total))[:k]
        out += zip([query] * len(order), ids[found][order].tolist(), total[order].tolist())
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.float64()))], ["query_id", "doc_id", "score"])
