"""Embeddings: a seam for any service that is called in batches, and offline vectors that depend on the text alone."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StringType, StructField, StructType

from ..errors import EmbeddingError
from ..functions import text as T
from ..functions.tokens import truncate_tokens

# Default dimensions and the longest input in tokens.
DIMENSIONS, LONGEST = 3072, 8191


def embed(text: Column, dimensions: int = DIMENSIONS) -> Column:
    """Unit vectors from digests of the text and a counter, eight numbers each.

    Digest bytes are read as integers and scaled into [-1, 1], so every number
    is finite; equal texts have equal vectors.  Null texts have none.
    """

    @F.arrow_udf("array<float>")
    def run(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            if t is None:
                out.append(None)
                continue
            raw = b"".join(hashlib.sha256(f"{t}|{k}".encode("utf-8", "surrogatepass")).digest() for k in range(-(-dimensions // 8)))
            v = np.frombuffer(raw, "<i4")[:dimensions] / 2.0**31
            out.append((v / (np.sqrt((v * v).sum()) or 1.0)).astype(np.float32))
        return pa.array(out, pa.list_(pa.float32()))

    return run(text)


def fitted(text: Column, longest: int = LONGEST, vocabulary: str | None = None) -> Column:
    """The text, or as much of its beginning as the model takes: tokens of the vocabulary, or words by the estimate."""
    if vocabulary:
        return truncate_tokens(text, longest, vocabulary)
    return F.when(T.token_estimate(text) > longest, T.truncate_tokens(text, longest)).otherwise(text)


def embed_chunks(chunks: DataFrame, dimensions: int = DIMENSIONS, vocabulary: str | None = None) -> DataFrame:
    """``chunks`` with ``embedding`` of the fitted embedding text; one vector per chunk, on the chunk's own row."""
    return chunks.withColumn("embedding", embed(fitted(F.col("embedding_text"), vocabulary=vocabulary), dimensions))


@dataclass(frozen=True)
class Embedder:
    """An embedding service as a function, and how it is called.

    call: texts to (index, vector) pairs in any order.  It gets ``batch`` texts
    at a time, and again after ``delay`` seconds, doubled each time, until it has
    been tried ``attempts`` times.  It runs in the tasks, so it has to be picklable.
    """

    call: Callable[[list[str]], list[tuple[int, list[float]]]]
    dimensions: int
    batch: int = 16
    attempts: int = 4
    delay: float = 1.5

    def vectors(self, texts: list[str]) -> list[list[float]]:
        """One vector for each text, in order; EmbeddingError if the service fails or answers amiss."""
        for attempt in range(self.attempts):
            try:
                answer = dict(self.call(texts))
                break
            except Exception as e:  # the service's errors are not ours to name
                if attempt + 1 == self.attempts:
                    raise EmbeddingError(f"embedding failed {self.attempts} times: {type(e).__name__}: {e}") from e
                time.sleep(self.delay * 2**attempt)
        if sorted(answer) != list(range(len(texts))):
            raise EmbeddingError(f"{len(answer)} vectors for {len(texts)} texts")
        ordered = [answer[k] for k in range(len(texts))]
        if any(v is None or len(v) != self.dimensions or not np.isfinite(np.asarray(v, float)).all() for v in ordered):
            raise EmbeddingError(f"a vector isn't {self.dimensions} finite numbers")
        return ordered


def embed_with(chunks: DataFrame, embedder: Embedder, vocabulary: str | None = None) -> DataFrame:
    """``chunks`` with ``embedding`` and ``embedding_error``: texts go to the service in fixed batches inside each task.

    A batch that fails leaves its rows without a vector and says why; the others
    keep theirs.  Rows without text have neither.
    """
    told = chunks.withColumn("fitted", fitted(F.col("embedding_text"), vocabulary=vocabulary))
    schema = StructType([*chunks.schema, StructField("embedding", ArrayType(FloatType())), StructField("embedding_error", StringType())])
    names = [f.name for f in schema]

    def run(batches):
        for batch in batches:
            texts = batch.column("fitted").to_pylist()
            vectors, errors = [None] * len(texts), [None] * len(texts)
            real = [k for k, t in enumerate(texts) if t is not None]
            for at in range(0, len(real), embedder.batch):
                part = real[at : at + embedder.batch]
                try:
                    for k, v in zip(part, embedder.vectors([texts[k] for k in part])):
                        vectors[k] = np.asarray(v, np.float32)
                except EmbeddingError as e:
                    for k in part:
                        errors[k] = str(e)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(vectors, pa.list_(pa.float32())), pa.array(errors, pa.string())], names)

    return told.mapInArrow(run, schema)


def raise_errors(embedded: DataFrame) -> DataFrame:
    """``embedded`` without ``embedding_error``; EmbeddingError if there is one."""
    bad = embedded.where("embedding_error is not null").select("embedding_error").take(1)
    if bad:
        raise EmbeddingError(bad[0][0])
    return embedded.drop("embedding_error")


def check_vectors(chunks: DataFrame, dimensions: int) -> DataFrame:
    """Documents with a chunk whose vector is missing, has another length, or holds a number that is null or not finite: (document_id, n_bad)."""
    bad = F.coalesce(F.size("embedding") != dimensions, F.lit(True)) | F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return chunks.where(bad | F.col("embedding").isNull()).groupBy("document_id").agg(F.count("*").alias("n_bad"))
