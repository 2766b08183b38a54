"""Exact token counts by a byte-pair vocabulary on disk (its path is a parameter; every machine has the file)."""

from __future__ import annotations

import base64
from functools import cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how the published vocabularies of this kind cut a text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Counts of short texts that a worker remembers.
REMEMBERED, SHORT = 200_000, 200


class Tokens:
    """Counts and cuts by a ranks file (a token in base64 and its rank per line)."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.encoding, self.held = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), {}

    def count(self, text: str) -> int:
        if len(text) > SHORT:
            return len(self._ids(text))
        if text not in self.held:
            if len(self.held) >= REMEMBERED:
                self.held.clear()
            self.held[text] = len(self._ids(text))
        return self.held[text]

    def _ids(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text.encode("utf-8", "replace").decode("utf-8", "replace"))

    def truncate(self, text: str, limit: int) -> str:
        """The longest beginning that the first ``limit`` tokens spell; a sign cut in two is left out."""
        ids = self._ids(text)
        return text if len(ids) <= limit else self.encoding.decode_bytes(ids[:limit]).decode("utf-8", "ignore")


@cache
def tokens(path: str) -> Tokens:
    """This worker's counter for a vocabulary."""
    return Tokens(path)


def count_tokens(text: Column, path: str) -> Column:
    """Number of tokens; null for null."""

    @F.arrow_udf("int")
    def run(texts: pa.Array) -> pa.Array:
        held = tokens(path)
        return pa.array([None if t is None else held.count(t) for t in texts.to_pylist()], pa.int32())

    return run(text)


def truncate_tokens(text: Column, limit: int, path: str) -> Column:
    """The first ``limit`` tokens of a text as text."""

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        held = tokens(path)
        return pa.array([None if t is None else held.truncate(t, limit) for t in texts.to_pylist()], pa.string())

    return run(text)
