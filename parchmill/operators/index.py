"""Chunk index as tables: hash gate, upsert, prune, report, and an index that changes by commits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import IndexingError
from ..functions.text import chunk_id
from .changes import ChangedTable, Rejected

#: Columns of the index; chunk_id is the key, and the rule column says what each is for.
SCHEMA = {
    "chunk_id": ("string", "key"), "document_id": ("string", "filter, facet"), "document_name": ("string", "search"), "document_type": ("string", "filter, facet"),
    "section": ("string", "search"), "section_path": ("string", "search"), "page_number": ("int", "filter"), "page_end": ("int", ""), "source_uri": ("string", ""),
    "ordinal": ("int", "filter, sort"), "token_count": ("int", ""), "content_hash": ("string", "filter"), "content": ("string", "search"), "content_vector": ("array<float>", "vector"),
}
DDL = ", ".join(f"{name} {kind}" for name, (kind, _) in SCHEMA.items())


def gate(documents: DataFrame, known: DataFrame, force: bool = False) -> DataFrame:
    """``documents`` with ``outcome``: skipped_unchanged if the known hash is equal, else indexed.

    Documents without an id or text fail and don't stop the others.
    """
    old = known.groupBy("document_id").agg(F.max("content_hash").alias("known_hash"))
    same = F.lit(False) if force else F.coalesce(F.col("content_hash") == F.col("known_hash"), F.lit(False))
    return documents.join(old, "document_id", "left").withColumn(
        "outcome", F.when(F.col("content_hash").isNull() | F.col("document_id").isNull(), "failed").when(same, "skipped_unchanged").otherwise("indexed")
    ).drop("known_hash")


def upsert(current: DataFrame, new: DataFrame, key: str = "chunk_id", order: str = "version") -> DataFrame:
    """The latest row of every key; rows of ``new`` win over equal versions."""
    both = current.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    w = Window.partitionBy(key).orderBy(F.desc(order), F.desc("__new"))
    return both.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank", "__new")


def stale(current: DataFrame, new: DataFrame, key: str = "chunk_id", document: str = "document_id") -> DataFrame:
    """Rows of ``current`` whose document was processed anew but whose key is gone."""
    return current.join(new.select(document).distinct(), document, "left_semi").join(new.select(key), key, "left_anti")


def report(results: DataFrame) -> DataFrame:
    """One row: counts by outcome, sums, and whether any document failed."""
    n = lambda o: F.count_if(F.col("outcome") == o)
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("chunks_written", "chunks_deleted", "embedding_tokens")]
    return results.agg(
        F.count("*").alias("docs_total"), n("indexed").alias("docs_indexed"), n("skipped_unchanged").alias("docs_skipped"), n("failed").alias("docs_failed"), *sums
    ).withColumn("status", F.when(F.col("docs_failed") > 0, "failed").otherwise("succeeded"))


def summary(report_row: DataFrame) -> Column:
    """The report as one JSON line."""
    return F.to_json(F.struct("status", *[c for c in report_row.columns if c != "status"]))


def search_documents(chunks: DataFrame) -> DataFrame:
    """Chunks with their document's metadata as rows of the index."""
    vector = F.col("embedding") if "embedding" in chunks.columns else F.lit(None).cast("array<float>")
    return chunks.select(
        chunk_id(F.col("document_id"), F.col("ordinal")).alias("chunk_id"), "document_id", "document_name", "document_type", "section",
        F.array_join("section_path", " > ").alias("section_path"), "page_number", "page_end", "source_uri", "ordinal", "token_count", "content_hash",
        F.col("text").alias("content"), vector.alias("content_vector"),
    )


def known_hashes(index: DataFrame) -> DataFrame:
    """(document_id, content_hash) of every indexed document, from its first chunk."""
    return index.where("ordinal = 0").groupBy("document_id").agg(F.max("content_hash").alias("content_hash"))


def chunk_counts(index: DataFrame) -> DataFrame:
    return index.groupBy("document_id").agg(F.count("*").alias("chunk_count"), F.min("page_number").alias("page_number"), F.max("page_end").alias("page_end"))


def facets(index: DataFrame, column: str) -> DataFrame:
    return index.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).select(F.lit(column).alias("facet"), "value", "n")


def coverage(manifest: DataFrame, index: DataFrame) -> DataFrame:
    """(format, n_expected, n_found, missing): the corpus list against the indexed documents; missing ids in order, as text."""
    found = index.select("document_id").distinct().withColumn("found", F.lit(True))
    told = manifest.join(found, "document_id", "left")
    lost = F.array_join(F.array_sort(F.collect_list(F.when(F.col("found").isNull(), F.col("document_id")))), ",")
    return told.groupBy(F.lower("format").alias("format")).agg(F.count("*").alias("n_expected"), F.count("found").alias("n_found"), lost.alias("missing"))


class Snapshots(ChangedTable):
    """The chunk index below ``root``: chunks of a document are replaced as a whole, by delta files and deletion marks.

    A commit with a chunk that has no key or no text, or with a vector that
    isn't all finite numbers or of another length than the first one's, is
    rejected as a whole with IndexingError; so is one with a repeated key.
    """

    def __init__(self, spark: SparkSession, root: str, compact_after: int = 32):
        super().__init__(spark, root, DDL, "document_id", compact_after)

    def fault(self) -> Column:
        vector = F.col("content_vector")
        odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        return F.coalesce(super().fault(), F.when(F.col("chunk_id").isNull(), "no chunk_id").when(F.col("content").isNull(), "no content").when(F.coalesce(odd, F.lit(False)), "vector with a number that isn't finite"))

    def reject(self, rows: DataFrame) -> None:
        try:
            super().reject(rows)
        except Rejected as e:
            raise IndexingError(str(e)) from e
        twice = rows.groupBy("chunk_id").count().where("count > 1").select("chunk_id").take(5)
        if twice:
            raise IndexingError("keys given twice: " + ", ".join(r[0] for r in twice))
        sizes = rows.where("content_vector is not null").agg(F.min(F.size("content_vector")), F.max(F.size("content_vector"))).first()
        if sizes[0] != sizes[1]:
            raise IndexingError(f"vectors of {sizes[0]} to {sizes[1]} numbers in one commit")
