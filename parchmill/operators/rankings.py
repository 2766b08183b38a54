"""Documents ranked for a set of questions by BM25 and by shared words, without a row per question and document.

Words are counted inside a document's row, documents with all their counts are
written once, and blocks of documents meet blocks of questions as matrix
products that leave k rows per question and task.  Scores of all pairs would be
questions times documents in the shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import materialize
from .retrieve import B, K1, bm25_scores, overlap, postings, question_terms, top

#: Questions' words that are sent to every task at most; more of them meet the documents by a shuffle.
ASKED = 1_000_000
#: Questions of a block, documents that are split into words at once, and cells of a block's matrix of documents and words.
BLOCK, SPLIT, CELLS = 256, 512, 1 << 21


def _count(words: list[str]):
    """Texts (id, text in lower case) to (id, size, terms, tf): the words that some question has, by their numbers."""
    known = pa.array(words, pa.string())

    def run(batches):
        for part in _parts(batches):
            split = pc.ascii_split_whitespace(part.column(1))
            word, row = split.flatten(), np.repeat(np.arange(len(part)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
            size = np.bincount(row[pc.not_equal(word, "").to_numpy(zero_copy_only=False)], minlength=len(part)).astype(np.float64)
            number = pc.fill_null(pc.index_in(word, known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            cell, tf = np.unique(row[number >= 0] * len(words) + number[number >= 0], return_counts=True)
            offsets = pa.array(np.searchsorted(cell, np.arange(len(part) + 1) * len(words)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (cell % max(1, len(words)), tf)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(size), *lists], ["doc_id", "size", "terms", "tf"])

    return run


def _parts(batches):
    for batch in batches:
        yield from (batch.slice(at, SPLIT) for at in range(0, len(batch), SPLIT))


def _postings(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """(row, size, term, tf) of a batch of documents in order of rows; rows of one document with equal sizes are one."""
    held = batch.column(1)
    size, terms, tf = held.flatten().flatten()
    entry = np.repeat(np.arange(len(batch)), pc.list_value_length(held).to_numpy(zero_copy_only=False))
    each = pc.list_value_length(terms).to_numpy(zero_copy_only=False)
    row, size = np.repeat(entry, each), np.repeat(size.to_numpy(zero_copy_only=False), each)
    term, tf = terms.flatten().to_numpy(zero_copy_only=False), tf.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(entry) > len(batch):
        order = np.lexsort((term, size, row))
        row, size, term, tf = row[order], size[order], term[order], tf[order]
        first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (size[1:] != size[:-1]) | (term[1:] != term[:-1])][: len(row)])
        row, size, term, tf = row[first], size[first], term[first], np.add.reduceat(tf, first) if len(first) else tf
    return row, size, term, tf


def _frequencies(n_words: int):
    """Documents to (term, df), a row per word and task."""

    def run(batches):
        df = np.zeros(n_words, np.int64)
        for part in _parts(batches):
            df += np.bincount(_postings(part)[2], minlength=n_words)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(df)), pa.array(df[df > 0])], ["term", "df"])

    return run


class _Best:
    """The k best documents so far for each question of a block; equal scores go to the smallest id."""

    def __init__(self, k: int, questions: int, ids: pa.DataType):
        self.k, self.least = k, np.full(questions, -np.inf)
        self.question, self.score, self.ids = np.empty(0, np.int64), np.empty(0), pa.array([], ids)

    def add(self, score: np.ndarray, found: np.ndarray, ids: pa.Array) -> None:
        row, question = np.nonzero(found & (score >= self.least))
        if not len(row):
            return
        self.question, self.score = np.r_[self.question, question], np.r_[self.score, score[row, question]]
        self.ids = pa.concat_arrays([self.ids, ids.take(pa.array(row))])
        if len(self.question) > 4 * self.k * len(self.least):
            self.cut()

    def cut(self) -> None:
        place = pc.rank(self.ids, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy()
        order = np.lexsort((place, -self.score, self.question))
        question = self.question[order]
        start = np.searchsorted(question, np.arange(len(self.least)))
        kept = order[np.arange(len(order)) - start[question] < self.k]
        self.question, self.score, self.ids = self.question[kept], self.score[kept], self.ids.take(pa.array(kept))
        full = np.bincount(self.question, minlength=len(self.least)) >= self.k
        last = np.full(len(self.least), np.inf)
        np.minimum.at(last, self.question, self.score)
        self.least[full] = last[full]


def _rank(asked: tuple[np.ndarray, np.ndarray], questions: pa.Array, idf: np.ndarray, mean: float, k: int):
    """Documents to (query_id, doc_id, ranking, score): the k best of the task for each question, 0 by BM25 and 1 by shared words.

    asked: numbers of questions, in order, and of their words.
    """

    def run(batches):
        blocks, best = [], []
        for at in range(0, len(questions), BLOCK):
            mine = slice(*np.searchsorted(asked[0], [at, at + BLOCK]))
            words, column = np.unique(asked[1][mine], return_inverse=True)
            held = np.zeros((len(words), min(BLOCK, len(questions) - at)))
            held[column, asked[0][mine] - at] = 1
            place = np.full(len(idf), -1)
            place[words] = np.arange(len(words))
            blocks.append((place, held, held.astype(np.float32)))
        for batch in _parts(batches):
            best = best or [[_Best(k, held.shape[1], batch.column(0).type) for _ in range(2)] for _, held, _ in blocks]
            row, size, term, tf = _postings(batch)
            weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / mean))
            for (place, held, exact), mine in zip(blocks, best):
                step = max(1, CELLS // max(1, len(held)))
                for at in range(0, len(batch), step):
                    part, ids = slice(*np.searchsorted(row, [at, at + step])), batch.column(0).slice(at, step)
                    there = place[term[part]]
                    cell = (row[part] - at)[there >= 0] * len(held) + there[there >= 0]
                    cells = np.bincount(cell, weight[part][there >= 0], len(ids) * len(held)).reshape(len(ids), len(held))
                    shared = (cells > 0).astype(np.float32) @ exact
                    mine[0].add(np.floor(cells @ held * 1e6 + 0.5) / 1e6, shared > 0, ids)
                    mine[1].add(shared, shared > 0, ids)
        for n, pair in enumerate(best):
            for ranking, b in enumerate(pair):
                b.cut()
                names = questions.take(pa.array(b.question + n * BLOCK))
                yield pa.RecordBatch.from_arrays([names, b.ids, pa.array(np.full(len(b.ids), ranking, np.int32)), pa.array(b.score.astype(np.float64))], ["query_id", "doc_id", "ranking", "score"])

    return run


def rankings(documents: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, doc_id, ranking, score, rank): the k best documents per query by BM25 (ranking 0) and by shared words (ranking 1).

    documents: doc_id, text; queries: query_id, text.
    """
    asked = question_terms(queries).distinct()
    listed = asked.limit(ASKED + 1).collect()
    if len(listed) > ASKED:
        counted, total = postings(documents, queries)
        ranked = top(bm25_scores(counted, total, queries), "score", "query_id", "doc_id", k).withColumn("ranking", F.lit(0))
        return ranked.unionByName(overlap(counted, queries, k).withColumn("score", F.col("score").cast("double")).withColumn("ranking", F.lit(1)))
    words = sorted({r["term"] for r in listed})
    number = {w: n for n, w in enumerate(words)}
    names = sorted({r["query_id"] for r in listed}, key=lambda q: (q is None, q))
    place = {q: n for n, q in enumerate(names)}
    pairs = np.array(sorted((place[r["query_id"]], number[r["term"]]) for r in listed), np.int64).reshape(-1, 2)
    key, asker = documents.schema["doc_id"].dataType.simpleString(), queries.schema["query_id"].dataType.simpleString()
    counted = documents.select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("text")).mapInArrow(_count(words), f"doc_id {key}, size double, terms array<int>, tf array<int>")
    held = materialize(counted.groupBy("doc_id").agg(F.collect_list(F.struct("size", "terms", "tf")).alias("held")), "postings")
    total = held.select(F.explode("held.size").alias("size")).agg(F.count("*"), F.avg("size")).first()
    df = np.zeros(len(words))
    for r in held.mapInArrow(_frequencies(len(words)), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    idf = np.log(1 + (total[0] - df + 0.5) / (df + 0.5))
    kind = {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64()}.get(asker)
    found = held.mapInArrow(_rank((pairs[:, 0], pairs[:, 1]), pa.array(names, kind), idf, total[1] or 1.0, k), f"query_id {asker}, doc_id {key}, ranking int, score double")
    return top(found, "score", ["query_id", "ranking"], "doc_id", k)
