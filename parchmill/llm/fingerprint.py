"""Operator 5: canonical exact digests of documents.

A text is made canonical (Unicode NFKC, case folding, white space folding) and
digested with 128-bit xxhash.  Documents are grouped by the digest, and inside
a bucket of equal digests the canonical texts themselves are compared, so two
documents share a fingerprint only if their canonical bytes are equal.
"""

from __future__ import annotations

import hashlib
import unicodedata

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import by_bucket, id_bounds, join_classes, materialize, packed_texts, unpack


def canonical(text: str | None) -> bytes:
    """NFKC, case folding, NFKC again (folding can undo it), runs of white space as one space."""
    text = text or ""
    if text.isascii():
        return " ".join(text.lower().split()).encode()
    folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(folded.split()).encode("utf-8", "surrogatepass")


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n/2) code points replaced by the first as many of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_ROWS = pa.schema([
    ("bucket", pa.int32()), ("flag", pa.string()), ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("digest", pa.string()),
    ("edited_digest", pa.string()), ("same_edited", pa.bool_()), ("next_id", pa.int64()), ("next_digest", pa.string()), ("body", pa.binary()),
])
_ROWS_DDL = "bucket int, flag string, doc_id long, n_chars long, edited_sha256 string, digest string, edited_digest string, same_edited boolean, next_id long, next_digest string, body binary"


def _row(bucket, one, two, hasher):
    """A finished row for a document and its successor, each (doc_id, text, canonical, digest, packed text)."""
    changed = edited(one[1], two[1])
    plain = canonical(changed)
    sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return (bucket, "row", one[0], len(one[1]), sha, one[3], hasher(plain), plain == one[2], two[0], two[3], None)


def _batch(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [()] * len(_ROWS), _ROWS)], schema=_ROWS)


def _load(doc_id, body, hasher):
    text = unpack(body)
    plain = canonical(text)
    return (doc_id, text, plain, hasher(plain), body)


def _successors(batches, hasher):
    """Rows sorted by bucket and descending id: each with its successor in the bucket.

    A bucket also leaves its first and last document, to be joined across buckets.
    """
    bucket, held = None, None

    def end(b, flag, doc):
        return (b, flag, doc[0], None, None, None, None, None, None, None, doc[4])

    for batch in batches:
        rows = []
        for b, doc_id, body in zip(batch.column("bucket").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("body")):
            doc = _load(doc_id, body.as_py(), hasher)
            if b != bucket:
                if held is not None:
                    rows.append(end(bucket, "last", held))
                rows.append(end(b, "first", doc))
            else:
                rows.append(_row(b, held, doc, hasher))
            bucket, held = b, doc
        yield _batch(rows)
    if held is not None:
        yield _batch([end(bucket, "last", held)])


def _unlike(docs: DataFrame, rows: DataFrame, hasher) -> dict[bytes, str]:
    """Names for canonical texts that share their digest with another text: all but the first in byte order.

    Only documents of buckets with two rows or more are read again.  A bucket
    is compared by its least and greatest canonical text, which combine before
    the shuffle: a bucket with a third of all rows sends two texts per task.
    What is returned are texts of buckets that really hold unlike ones; with a
    wide digest there are none.
    """
    counts = rows.groupBy("digest").count().where("count > 1")
    ids = materialize(join_classes(rows.select("doc_id", "digest"), counts, "digest", "count", rows.count()).select("doc_id").distinct(), "shared")

    def run(batches):
        for batch in batches:
            plain = [canonical(unpack(b.as_py())) for b in batch.column("body")]
            yield pa.RecordBatch.from_arrays([pa.array([hasher(t) for t in plain], pa.string()), pa.array(plain, pa.binary())], ["digest", "plain"])

    packed = packed_texts(docs, []).select("doc_id", "body")
    again = packed.join(ids.withColumnRenamed("doc_id", "shared_id"), F.col("doc_id").eqNullSafe(F.col("shared_id")), "left_semi").mapInArrow(run, "digest string, plain binary")
    unlike = again.groupBy("digest").agg(F.min("plain").alias("low"), F.max("plain").alias("high")).where("low != high").select("digest")
    unlike = materialize(unlike, "unlike")
    if unlike.isEmpty():
        return {}
    rank = F.row_number().over(Window.partitionBy("digest").orderBy("plain")) - 1
    named = again.join(unlike, "digest", "left_semi").select("digest", "plain").distinct().withColumn("k", rank).where("k > 0")
    return {bytes(r["plain"]): f"{r['digest']}-{r['k']}" for r in named.collect()}


def edit_report(docs: DataFrame, hasher=xxhash.xxh3_128_hexdigest, compare: bool = True) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.  A text's edited form takes its second half from
    the next document in descending doc_id order (null ids last, ties in no
    set order); after the last comes the first, and a single document follows
    itself.  Likeness of exact digests is 1.0 for equal canonical texts, else
    0.0.  Should unlike texts share a digest, those after the first (in byte
    order) carry a version suffix.  Null texts count as empty.  Repeated rows
    each get a row; an empty table gives none; further columns are ignored.
    """
    bounds, n = id_bounds(docs, "doc_id")
    placed = by_bucket(packed_texts(docs, bounds), "bucket", n).sortWithinPartitions("bucket", F.desc_nulls_last("doc_id"))
    rows = materialize(placed.mapInArrow(lambda it: _successors(it, hasher), _ROWS_DDL), "digests")

    # Across buckets: the last document of each goes with the first of the next lower one, at the end with the very first.
    firsts = rows.where("flag = 'first'").select("bucket", F.col("doc_id").alias("next_doc"), F.col("body").alias("next_body"))
    order = Window.orderBy(F.desc("bucket"))  # two rows a bucket, whatever the input's size
    follow = rows.where("flag = 'first'").select("bucket", F.lead("bucket").over(order).alias("after")).withColumn("top", F.max("bucket").over(Window.partitionBy(F.lit(1))))
    tails = (
        rows.where("flag = 'last'").select("bucket", "doc_id", "body")
        .join(follow.select("bucket", F.coalesce("after", "top").alias("after")), "bucket")
        .join(firsts.withColumnRenamed("bucket", "after"), "after").select("bucket", "doc_id", "body", "next_doc", "next_body")
    )

    def finish(batches):
        for batch in batches:
            yield _batch([_row(b, _load(i, x, hasher), _load(j, y, hasher), hasher) for b, i, x, j, y in zip(*(batch.column(c).to_pylist() for c in ("bucket", "doc_id", "body", "next_doc", "next_body")))])

    done = rows.where("flag = 'row'").drop("body").union(tails.mapInArrow(finish, _ROWS_DDL).drop("body"))
    done = materialize(done.drop("bucket", "flag"), "rows")
    if compare and (names := _unlike(docs, done, hasher)):
        # The rare case: digest once more, with names that tell the unlike texts apart.
        return edit_report(docs, lambda plain: names.get(plain) or hasher(plain), compare=False)
    return done.select(
        "doc_id", "n_chars", "edited_sha256", F.col("digest").alias("fingerprint"),
        F.when(F.col("same_edited") | (F.col("edited_digest") != F.col("digest")), F.col("edited_digest")).otherwise(F.concat("edited_digest", F.lit("-edited"))).alias("edited_fingerprint"),
        F.col("same_edited").cast("double").alias("near_edited"), (F.col("digest") == F.col("next_digest")).cast("double").alias("near_next"),
    )
