"""Keyword and vector retrieval, fusion, and context assembly."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import materialize
from ..functions.text import words

# Parameters of the published BM25 and reciprocal-rank formulas.
K1, B, RRF_K = 1.2, 0.75, 60
#: Bytes of queries that are sent to every task.
SENT = 64 << 20
#: Different words of all queries that are tested inside a document's row; more of them meet the words by a join.
LISTED = 10_000
#: Fields of the index that keyword search reads, with their weights.
FIELDS = {"document_name": 2.0, "section": 1.5, "section_path": 1.0, "content": 1.0}


def top(rows: DataFrame, by: str, group: str | list[str], tie: str, k: int, rank: str = "rank") -> DataFrame:
    w = Window.partitionBy(group).orderBy(F.desc(by), tie)
    return rows.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def terms(text: Column) -> Column:
    return words(F.lower(text))


def question_terms(queries: DataFrame) -> DataFrame:
    return queries.select("query_id", F.explode(F.array_distinct(terms(F.col("text")))).alias("term"))


def postings(documents: DataFrame, queries: DataFrame, tie: str = "doc_id", fields: dict[str, float] | None = None) -> tuple[DataFrame, DataFrame]:
    """(doc_id, size, term, tf) for the words that some query has, counted once and written, and (n, mean).

    With ``fields``, a word counts with the weight of the field it stands in.
    The documents are read once; their words are counted per document before
    any shuffle, and only the queries' words leave the scan.
    """
    weighted = fields or {"text": 1.0}
    asked = question_terms(queries).select("term").distinct()
    listed_words = [r[0] for r in asked.limit(LISTED + 1).collect()]
    size = sum((F.size(terms(F.coalesce(F.col(c), F.lit("")))) * F.lit(w) for c, w in weighted.items()), F.lit(0.0))
    weigh = lambda w: lambda t: F.struct(t.alias("term"), F.lit(w).alias("w"))
    listed = F.flatten(F.array(*[F.transform(terms(F.coalesce(F.col(c), F.lit(""))), weigh(w)) for c, w in weighted.items()]))
    if len(listed_words) <= LISTED:  # few enough to be tested inside the row, before a row is made of each word
        listed = F.filter(listed, lambda x: x["term"].isin(listed_words))
    sized = documents.select(F.col(tie).alias("doc_id"), size.alias("size"), listed.alias("listed"))
    # A row per document rides along with its words, so that the totals need no second scan.
    exploded = sized.select("doc_id", "size", F.explode(F.concat(F.array(F.struct(F.lit(None).cast("string").alias("term"), F.lit(1.0).alias("w"))), "listed")).alias("x"))
    kept = exploded.select("doc_id", "size", "x.term", "x.w")
    if len(listed_words) > LISTED:
        kept = kept.join(asked.withColumn("asked", F.lit(True)), "term", "left").where("asked or term is null")
    counted = materialize(kept.groupBy("doc_id", "size", "term").agg(F.sum("w").alias("tf"), F.count("*").alias("rows")), "postings")
    total = counted.where("term is null").agg(F.sum("rows").alias("n"), (F.sum(F.col("size") * F.col("rows")) / F.sum("rows")).alias("mean"))
    return counted.where("term is not null"), total


def bm25_scores(counted: DataFrame, total: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, doc_id, score): the words' rarity goes to the small query side before it meets the postings."""
    frequency = counted.groupBy("term").agg(F.count("*").alias("df"))
    asked = question_terms(queries).join(frequency, "term").crossJoin(F.broadcast(total))  # one row
    asked = asked.select("query_id", "term", F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"), "mean")
    weight = F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("size") / F.col("mean")))
    return counted.join(asked, "term").groupBy("query_id", "doc_id").agg(F.round(F.sum(weight), 6).alias("score"))


def bm25(documents: DataFrame, queries: DataFrame, k: int = 10, fields: dict[str, float] | None = None, tie: str = "doc_id") -> DataFrame:
    """(query_id, doc_id, score, rank) of the k best documents by BM25 per query.

    documents: doc_id, text (or the named ``fields``); queries: query_id, text.
    """
    counted, total = postings(documents, queries, tie, fields)
    return top(bm25_scores(counted, total, queries), "score", "query_id", "doc_id", k)


def overlap(counted: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, doc_id, score, rank) by the number of different words that query and document share.

    It stands in for a cross-encoder, which needs a model: any scorer that
    returns these columns can take its place.
    """
    shared = counted.select("doc_id", "term").distinct().join(question_terms(queries), "term").groupBy("query_id", "doc_id").agg(F.count("*").alias("score"))
    return top(shared, "score", "query_id", "doc_id", k)


def cosine_top(vectors: DataFrame, queries: DataFrame, k: int = 10, block: int = 1024) -> DataFrame:
    """(query_id, vec_id, score, rank): the k nearest of all vectors per query, by exact cosine.

    Queries and vectors are dealt into blocks, and every pair of blocks is one
    matrix product that leaves k rows per query.  Queries of SENT bytes or less
    are sent to every task; more of them meet the vectors by a shuffle on the
    pair of block numbers.  Scores are rounded to 6 decimals (halves away from
    zero, as in SQL) before any are left out, and ties go to the smallest
    vec_id.  A vector isn't its own neighbour; vectors without a cosine are
    left out.
    """
    def blocks(frame: DataFrame, key: str, side: str) -> tuple[DataFrame, int, int]:
        usable = frame.where("embedding is not null and size(embedding) > 0").where(F.exists("embedding", lambda x: x != 0) & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x)))
        rows, numbers = usable.agg(F.count("*"), F.coalesce(F.sum(F.size("embedding")), F.lit(0))).first()
        n = max(1, -(-rows // block))
        dealt = usable.groupBy(F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias(f"{side}_block")).agg(F.collect_list(F.struct(F.col(key).cast("long").alias("id"), "embedding")).alias(side))
        return dealt, n, 8 * numbers

    def run(batches):
        for batch in batches:
            for one, two in zip(batch.column("q"), batch.column("v")):
                ids, unit = [], []
                for side in (one.values, two.values):
                    m = np.asarray(side.field("embedding").flatten(), np.float64).reshape(len(side), -1)
                    ids.append(np.asarray(side.field("id")))
                    unit.append(m / np.sqrt((m * m).sum(1, keepdims=True)))
                score = unit[0] @ unit[1].T
                score = np.copysign(np.floor(np.abs(score) * 1e6 + 0.5), score) / 1e6
                score[ids[0][:, None] == ids[1][None, :]] = -np.inf
                by_id = np.argsort(ids[1], kind="stable")
                score, ids[1] = score[:, by_id], ids[1][by_id]
                best = np.argsort(-score, axis=1, kind="stable")[:, :k]
                rows = np.repeat(np.arange(len(ids[0])), best.shape[1])
                s = score[rows, best.ravel()]
                ok = np.isfinite(s)
                yield pa.RecordBatch.from_arrays([pa.array(ids[0][rows][ok]), pa.array(ids[1][best.ravel()][ok]), pa.array(s[ok])], ["query_id", "vec_id", "score"])

    asked, n_q, size = blocks(queries, "query_id", "q")
    sent, n_v, _ = blocks(vectors, "vec_id", "v")
    if size <= SENT:
        pairs = sent.crossJoin(F.broadcast(asked))
    else:
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        pairs = asked.withColumn("v_block", every(n_v)).join(sent.withColumn("q_block", every(n_q)), ["q_block", "v_block"])
    found = pairs.select("q", "v").mapInArrow(run, "query_id long, vec_id long, score double")
    return top(found, "score", "query_id", "vec_id", k)


def fuse(rankings: list[DataFrame], k: int = 10) -> DataFrame:
    """Reciprocal rank fusion of rankings (query_id, doc_id, rank)."""
    parts = rankings[0].select("query_id", "doc_id", "rank")
    for r in rankings[1:]:
        parts = parts.unionByName(r.select("query_id", "doc_id", "rank"))
    summed = parts.groupBy("query_id", "doc_id").agg(F.round(F.sum(1 / (F.lit(RRF_K) + F.col("rank"))), 9).alias("score"))
    return top(summed, "score", "query_id", "doc_id", k)


def union_queries(rankings: list[DataFrame], k: int = 30) -> DataFrame:
    """Results of several wordings of one question: each document once, with its best score."""
    parts = rankings[0].select("query_id", "doc_id", "score")
    for r in rankings[1:]:
        parts = parts.unionByName(r.select("query_id", "doc_id", "score"))
    return top(parts.groupBy("query_id", "doc_id").agg(F.max("score").alias("score")), "score", "query_id", "doc_id", k)


def trimmed(index: DataFrame, groups: list[str], filters: dict[str, str] | None = None) -> DataFrame:
    """Rows that a caller in ``groups`` may see (rows without an access list are open), with equal metadata filters."""
    open_to = F.col("allowed").isNull() | F.arrays_overlap("allowed", F.array(*map(F.lit, groups)).cast("array<string>"))
    for column, value in (filters or {}).items():
        index = index.where(F.col(column) == value)
    return index.where(open_to)


def assemble(candidates: DataFrame, threshold: float, per_group: int = 2, size: int = 6) -> DataFrame:
    """Context of each query: above the threshold, the best of each (group, path), at most ``per_group`` of a group, the best ``size``, best last.

    candidates: query_id, doc_id, group, score, and maybe path (without it
    nothing counts as a repeated path).  position counts from 1 and ascends with the score.
    """
    rows = candidates.where(F.col("score") >= threshold)
    if "path" in candidates.columns:
        w = Window.partitionBy("query_id", "group", "path").orderBy(F.desc("score"), "doc_id")
        rows = rows.withColumn("__in_path", F.row_number().over(w)).where("__in_path = 1")
    w = Window.partitionBy("query_id", "group").orderBy(F.desc("score"), "doc_id")
    rows = rows.withColumn("__in_group", F.row_number().over(w)).where(F.col("__in_group") <= per_group)
    best = top(rows, "score", "query_id", "doc_id", size, "__best")
    back = Window.partitionBy("query_id").orderBy(F.desc("__best"))
    kept = [c for c in candidates.columns if c not in ("query_id", "doc_id", "group", "score")]
    return best.withColumn("position", F.row_number().over(back)).select("query_id", "doc_id", "group", "score", *kept, "position", F.format_string("[C%d]", "position").alias("marker"))
