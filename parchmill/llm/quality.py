"""Operator 3: quality classifier, naive Bayes support vectors.

Following Wang and Manning, "Baselines and Bigrams" (2012): n-gram indicators
are scaled by their class log-count ratios, then a linear hinge-loss model is
fitted by dual coordinate descent (Hsieh et al., 2008).  The n-grams are byte
3-grams of the whole text and 4-grams of a repetition mark per word (same as
the word before, same as the one before that, or neither), hashed to SPACE
indicators.

The log-count ratios count every labelled training row, in Spark.  Only the
linear fit sees a bounded sample, FIT_ROWS rows in hash order.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc32_of_id, materialize

#: Hashed indicators; the sample that the linear model is fitted on; rows of it that calibrate.
SPACE, FIT_ROWS, CALIBRATE = 1 << 16, 4000, 0.3
THRESHOLD = 0.3
#: Slots of the bitmap of labelled ids, as a logarithm.
LABEL_BITS = 22


def indicators(text: str | None) -> np.ndarray:
    """Sorted distinct hashed n-grams of a whole text."""
    text = text or ""
    present = np.zeros(SPACE, bool)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    for at in range(0, max(0, len(data) - 2), 1 << 20):
        part = data[at : at + (1 << 20) + 2].astype(np.uint32)
        code = part[:-2] | part[1:-1] << 8 | part[2:] << 16
        present[(code * np.uint32(2654435761)) >> 16] = True
    words = text.split()
    if len(words) >= 4:
        once = np.fromiter(map(str.__eq__, words, words[1:]), bool, len(words) - 1)
        twice = np.fromiter(map(str.__eq__, words, words[2:]), bool, len(words) - 2)
        mark = np.zeros(len(words), np.uint32)
        mark[2:][twice] = 2
        mark[1:][once] = 1
        code = mark[:-3] + 3 * mark[1:-2] + 9 * mark[2:-1] + 27 * mark[3:] + (1 << 24)
        present[(np.unique(code).astype(np.uint32) * np.uint32(2654435761)) >> 16] = True
    return np.flatnonzero(present).astype(np.uint16)


@dataclass
class Model:
    """Weight of every indicator (its ratio included), intercept, and the two numbers of the logistic calibration."""

    weights: np.ndarray
    intercept: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, ratio: np.ndarray, at: np.ndarray) -> float:
        norm = math.sqrt(float((ratio[at] ** 2).sum())) or 1.0
        return float(self.weights[at].sum()) / norm + self.intercept


def dual_coordinate_descent(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float = 1.0, epochs: int = 12, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and intercept of the L1-loss linear SVM on unit-length ratio-scaled indicators.

    Rows are weighted so that both classes count alike.
    """
    w, b = np.zeros(SPACE), 0.0
    norms = [math.sqrt(float((ratio[r] ** 2).sum())) or 1.0 for r in rows]
    scaled = [ratio[r] / n for r, n in zip(rows, norms)]
    share = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    alpha, order, rng = np.zeros(len(rows)), np.arange(len(rows)), np.random.default_rng(seed)
    for _ in range(epochs):
        rng.shuffle(order)
        moved = 0.0
        for i in order:
            r, x = rows[i], scaled[i]
            gradient = y[i] * (float(w[r] @ x) + b) - 1
            new = min(max(alpha[i] - gradient / (float(x @ x) + 1), 0.0), cost * share[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[r] += step * x
                b += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w, b


def calibrate(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through margins, by Newton steps with a weak prior."""
    a, c = 1.0, 0.0
    t = (y > 0).astype(float)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + c, -30, 30)))
        g = np.array([((p - t) * margins).sum() + 1e-2 * a, (p - t).sum() + 1e-2 * c])
        v = p * (1 - p)
        h = np.array([[(v * margins**2).sum() + 1e-2, (v * margins).sum()], [(v * margins).sum(), v.sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        a, c = a - step[0], c - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(c)


def _pack(at: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.diff(at, prepend=np.uint16(0)).tobytes())


def _unpack(body: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint16), dtype=np.uint16)


def _slot(ids: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - LABEL_BITS)).astype(np.int64)


def labelled_slots(known: DataFrame) -> np.ndarray:
    """A bitmap of 2 ** LABEL_BITS slots with the labelled ids' slots set, of one size whatever the labels are."""

    def run(batches):
        bits = np.zeros(1 << LABEL_BITS, np.uint8)
        for batch in batches:
            bits[_slot(np.asarray(batch.column(0)))] = 1
        words = np.packbits(bits).view(np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at])], ["word", "bits"])

    got = known.select("doc_id").where("doc_id is not null").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    words = np.zeros((1 << LABEL_BITS) // 64, np.int64)
    words[got["word"]] = got["bits"]
    return np.unpackbits(words.view(np.uint8)).astype(bool)


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, quality, body): packed indicators of labelled rows that aren't held out.

    Rows whose id can't be labelled are left out before their texts are read,
    by a bitmap of bounded size; the join then is exact.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("quality in (0, 1)")
    shared = docs.sparkSession.sparkContext.broadcast(labelled_slots(known))

    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.array(shared.value[_slot(np.asarray(batch.column(0)))]))
            bodies = [_pack(indicators(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bodies, pa.binary())], ["doc_id", "body"])

    train = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null").where(crc32_of_id(F.col("doc_id")) % 5 != 0)
    return train.mapInArrow(run, "doc_id long, body binary").join(known, "doc_id").select("doc_id", "quality", "body")


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, Model]:
    """Log-count ratios over all training rows, and the model fitted on ``fit_rows`` of them.

    Without training rows of both classes every text scores the share of label
    1 among the labels there are (a half if there are none).
    """
    train = materialize(training_rows(docs, labels), "training")

    def count(batches):
        counts, rows = np.zeros((2, SPACE), np.int64), [0, 0]
        for batch in batches:
            for quality, body in zip(batch.column("quality").to_pylist(), batch.column("body")):
                counts[quality, _unpack(body.as_py())] += 1
                rows[quality] += 1
        at = np.flatnonzero(counts.any(0))
        columns = [np.append(at, -1), np.append(counts[0, at], rows[0]), np.append(counts[1, at], rows[1])]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["gram", "low", "high"])

    # At most SPACE + 1 rows come back, whatever the corpus.
    got = train.mapInArrow(count, "gram long, low long, high long").groupBy("gram").agg(F.sum("low").alias("low"), F.sum("high").alias("high")).toPandas()
    low, high = np.zeros(SPACE), np.zeros(SPACE)
    rows = got[got.gram < 0]
    n_low, n_high = (int(rows[c].sum()) for c in ("low", "high"))
    got = got[got.gram >= 0]
    low[got.gram], high[got.gram] = got.low, got.high
    p, q = high + 1, low + 1
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    if not (n_low and n_high):
        share = (n_high + 0.5) / (n_low + n_high + 1)
        return ratio, Model(np.zeros(SPACE), 0.0, 0.0, math.log(share / (1 - share)))
    # A top-n sends each task's n best rows to the driver, so rows beyond the likely bound on the hash go first.
    place, share = F.xxhash64("doc_id"), (fit_rows + 8 * math.sqrt(fit_rows)) / (n_low + n_high)
    near = train if share >= 1 else train.where(place < int(share * 2**64) - 2**63)
    sample = near.orderBy(place, "doc_id", "quality", "body").limit(fit_rows).collect()
    features, y = [_unpack(r["body"]) for r in sample], np.array([1 if r["quality"] else -1 for r in sample])
    cut = int(len(sample) * (1 - CALIBRATE))
    if len(set(y[:cut])) == 2 and len(set(y[cut:])) == 2:
        part = Model(*_fold(features[:cut], y[:cut], ratio))
        slope, shift = calibrate(np.array([part.margin(ratio, f) for f in features[cut:]]), y[cut:])
    else:
        slope, shift = 2.0, 0.0
    return ratio, Model(*_fold(features, y, ratio), slope, shift)


def _fold(features: list[np.ndarray], y: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    w, b = dual_coordinate_descent(features, y, ratio)
    return w * ratio, b


def score(docs: DataFrame, ratio: np.ndarray, model: Model) -> DataFrame:
    """(doc_id, score) in row order; null and empty texts have no n-grams and get the intercept's score."""
    shared = docs.sparkSession.sparkContext.broadcast((ratio, model))

    def run(batches):
        ratio, model = shared.value
        for batch in batches:
            m = np.array([model.margin(ratio, indicators(t.as_py())) for t in batch.column(1)])
            s = 1 / (1 + np.exp(-np.clip(model.slope * m + model.shift, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def with_score(docs: DataFrame, ratio: np.ndarray, model: Model, out: str = "score") -> DataFrame:
    """``docs`` with one more column for the score, in one pass and without a join."""
    shared = docs.sparkSession.sparkContext.broadcast((ratio, model))

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        ratio, model = shared.value
        m = np.array([model.margin(ratio, indicators(t.as_py())) for t in texts])
        return pa.array(1 / (1 + np.exp(-np.clip(model.slope * m + model.shift, -30, 30))), pa.float64())

    return docs.withColumn(out, scored(F.col("text")))


def quality_report(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row.

    Held-out rows (crc32 of the id as text divisible by 5) never train.  Rows
    of ``labels`` without a quality of 0 or 1, or for unknown documents, are
    left out; a document labelled twice counts twice.  Repeated rows each get a
    row; an empty table gives none; further columns are ignored.
    """
    ratio, model = fit(docs, labels)
    return score(docs, ratio, model).select(
        "doc_id", (crc32_of_id(F.col("doc_id")) % 5 == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
