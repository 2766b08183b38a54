"""Text expressions; everything but Unicode compatibility folding stays in the JVM."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Line breaks and white space as the text model counts them.
BREAKS = r"\n\r\x0B\x0C\x1C-\x1E\x85\x{2028}\x{2029}"
WITHIN_LINE = rf"(?U)[\s\x1F&&[^{BREAKS}]]+"
WHITE = r"(?U)[\s\x1C-\x1F]+"
TOKENS_PER_WORD = 1.35


@F.arrow_udf(StringType())
def _nfkc(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else unicodedata.normalize("NFKC", t) for t in texts.to_pylist()], pa.string())


def nfkc(text: Column) -> Column:
    """NFKC; only rows with a character outside ASCII go to Python."""
    other = text.rlike(r"[^\x00-\x7F]")
    return F.coalesce(_nfkc(F.when(other, text)), text)


def collapse(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, WHITE, " "))


def clean_text(text: Column) -> Column:
    """NFKC without soft hyphens, white space collapsed per line, empty lines dropped; two passes over the text."""
    level = F.regexp_replace(F.replace(nfkc(text), F.lit("\u00ad"), F.lit("")), WITHIN_LINE, " ")
    return F.btrim(F.regexp_replace(level, rf" ?(?:[{BREAKS}] ?)+", "\n"), F.lit(" \n"))


def clean_value(text: Column) -> Column:
    """A metadata value without emphasis and trailing signs; empty becomes null."""
    plain = collapse(F.replace(text, F.lit("*"), F.lit("")))
    return F.nullif(F.regexp_replace(plain, r"^[ .;,]+|[ .;,]+$", ""), F.lit(""))


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def token_estimate(text: Column) -> Column:
    """Tokens by the word rule: 0 for no words, else at least 1."""
    n = F.size(words(text))
    return F.when(n == 0, 0).otherwise(F.greatest(F.lit(1), F.floor(n * F.lit(TOKENS_PER_WORD)))).cast("int")


def truncate_tokens(text: Column, limit: int) -> Column:
    """The first words that stay within ``limit`` estimated tokens."""
    return F.array_join(F.slice(words(text), 1, max(1, int(limit / TOKENS_PER_WORD))), " ")


def sentences(text: Column) -> Column:
    return F.split(text, r"(?<=[.!?;])\s+")


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def chunk_id(document_id: Column, ordinal: Column) -> Column:
    """Safe document id and a four-digit ordinal."""
    return F.format_string("%s-%04d", F.regexp_replace(document_id, r"[^A-Za-z0-9_\-=]", "_"), ordinal.cast("int"))


def breadcrumb(name: Column, path: Column, maximum: int) -> Column:
    """Document name and path parts that differ from it, cut at half of ``maximum`` tokens."""
    line = F.array_join(F.concat(F.array(name), F.filter(path, lambda p: F.lower(p) != F.lower(name))), " > ")
    most = max(1, maximum // 2)
    return F.when(token_estimate(line) <= most, line).otherwise(truncate_tokens(line, most))
