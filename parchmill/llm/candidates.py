"""Pairs that a SimHash radius misses: candidates by bands of min-wise hashes, confirmed on whole shingle sets.

A fingerprint estimates the likeness of two texts, and the estimate scatters:
many pairs at a likeness of 0.8 lie beyond any radius with few cells.  Min-wise
hashes of the same shingles bring such pairs together, and their shingle sets
decide.  Members of a band meet the least of them only, so a band with very many
members gives one pair for each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from .common import materialize
from .simhash import majority, shingle_hashes

#: Bands, and hashes of a band: a pair of likeness 0.8 shares one with a chance of 0.99, one of 0.5 with 0.3.
BANDS, ROWS, LIKENESS = 12, 5, 0.8
_RNG = np.random.default_rng(2024)
_TIMES = _RNG.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RNG.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
_FOLD = _RNG.integers(0, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def bands(hashes: np.ndarray) -> np.ndarray:
    """One number per band of a set of shingle hashes; none for an empty set."""
    if not len(hashes):
        return np.empty(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    with np.errstate(over="ignore"):
        for at in range(0, len(hashes), 4096):  # whole text, bounded memory
            least = np.minimum(least, (hashes[at : at + 4096, None] * _TIMES + _PLUS).min(0))
        return ((least.reshape(BANDS, ROWS) * _FOLD).sum(1) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def with_signature(docs: DataFrame, names: list[str], band: str, words: int, seed: int = 42) -> DataFrame:
    """``docs`` with its fingerprint (64 bits a name) and its bands, from one pass over the text."""
    columns = docs.columns

    def run(batches):
        for batch in batches:
            prints, held = [], []
            for text in batch.column("text"):
                hashes = shingle_hashes(text.as_py(), words, seed)
                prints.append(majority(hashes, len(names)))
                held.append(bands(hashes))
            fps = np.array(prints, np.uint64).reshape(-1, len(names)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(fps[:, k].copy()) for k in range(len(names))), pa.array(held, pa.list_(pa.int64()))], [*columns, *names, band])

    return docs.mapInArrow(run, StructType([*docs.schema, *(StructField(n, LongType()) for n in names), StructField(band, ArrayType(LongType()))]))


def pairs(nodes: DataFrame, band: str = "bands") -> DataFrame:
    """(a, b): each node of ``nodes`` (node, bands) with the least node of each of its bands."""
    held = nodes.select("node", F.explode(band).alias("band"))
    least = held.groupBy("band").agg(F.min("node").alias("low"), F.count("*").alias("n")).where("n > 1").select("band", "low")
    return held.join(least, "band").where("node != low").select(F.col("node").alias("a"), F.col("low").alias("b")).distinct()


def confirmed(found: DataFrame, texts: DataFrame, words: int, likeness: float = LIKENESS, seed: int = 42) -> DataFrame:
    """The pairs (a, b) of ``found`` whose shingle sets have a Jaccard similarity of ``likeness`` or more; texts: (node, text), a row per node.

    Sets are sorted 32-bit hashes; only those of nodes in a pair are made.
    """
    found = materialize(found, "pairs")
    wanted = found.select(F.col("a").alias("node")).union(found.select("b")).distinct()

    def sets(batches):
        for batch in batches:
            held = [np.unique(shingle_hashes(text.as_py(), words, seed).astype(np.uint32)).tobytes() for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(held, pa.binary())], ["node", "held"])

    made = materialize(texts.join(wanted, "node", "left_semi").select("node", "text").mapInArrow(sets, StructType([StructField("node", LongType()), StructField("held", BinaryType())])), "sets")
    both = found.join(made.select(F.col("node").alias("a"), F.col("held").alias("one")), "a").join(made.select(F.col("node").alias("b"), F.col("held").alias("two")), "b")

    def alike(batches):
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("one").to_pylist(), batch.column("two").to_pylist()):
                x, y = np.frombuffer(one, np.uint32), np.frombuffer(two, np.uint32)
                # Sets of very unequal size can't be alike.
                near = min(len(x), len(y)) >= likeness * max(len(x), len(y))
                common = len(np.intersect1d(x, y, assume_unique=True)) if near else 0
                keep.append(bool(common) and common >= likeness * (len(x) + len(y) - common))
            at = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], ["a", "b"])

    return both.select("a", "b", "one", "two").mapInArrow(alike, "a long, b long")
