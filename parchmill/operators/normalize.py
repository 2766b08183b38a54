"""Metadata of documents: labelled values lifted from the head, repeated titles, ids and names.

Blocks are rows (document_id, pos, kind, text, level); level is set for headings alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

# The labels, how many leading blocks may hold them, the share they must cover, and ids in file names.
LABELS = [
    "Document Title", "Document ID", "Department", "Policy Category", "Effective Date", "Last Updated", "Approval Authority",
    "Confidentiality", "Effective", "Version", "Owner", "Status", "Format", "Title",
]
HEAD, COVERED = 20, 0.9
FILE_ID = r"(?i)^[a-z]{2,4}-[a-z]{2,4}-[0-9]{2,4}"
_LABEL = "|".join(sorted(LABELS, key=len, reverse=True))


def labelled(text: Column) -> Column:
    """Struct of ``pairs`` (array of lower-case key and value, in order) and ``covered`` (characters they take up)."""
    keys = F.regexp_extract_all(text, F.lit(rf"(?i)({_LABEL})\s*:"), F.lit(1))
    parts = F.split(text, rf"(?i)\s*(?:{_LABEL})\s*:\s*", -1)
    pairs = F.zip_with(keys, F.slice(parts, 2, F.size(keys)), lambda k, v: F.struct(F.lower(T.collapse(k)).alias("key"), v.alias("value")))
    tight = F.regexp_replace(text, rf"(?i)\s*((?:{_LABEL})\s*:)", "$1")
    return F.struct(pairs.alias("pairs"), (F.length(tight) - F.length(parts[0])).alias("covered"))


def lift_front_matter(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(document_id, fields) and the blocks that stay.

    Among a document's first HEAD blocks, those that are neither heading nor
    table and consist almost only of labelled values are taken out.  fields
    maps each label to its first value; documents without any have no row.
    Null texts hold no values.
    """
    place = F.row_number().over(Window.partitionBy("document_id").orderBy("pos"))
    found = blocks.withColumn("__at", place).withColumn(
        "__found", F.when((F.col("__at") <= HEAD) & ~F.col("kind").isin("heading", "table"), labelled(F.col("text")))
    )
    lifted = F.coalesce((F.size("__found.pairs") > 0) & (F.col("__found.covered") >= F.lit(COVERED) * F.length(F.trim("text"))), F.lit(False))
    found = found.withColumn("__lifted", lifted)
    pairs = found.where("__lifted").select("document_id", "__at", F.posexplode("__found.pairs").alias("i", "pair"))
    first = pairs.groupBy("document_id", "pair.key").agg(F.min_by("pair.value", F.struct("__at", "i")).alias("value"))
    fields = first.groupBy("document_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("fields"))
    return fields, found.where("not __lifted").select(*blocks.columns)


def drop_repeated_title(blocks: DataFrame) -> DataFrame:
    """``blocks`` without a document's first top heading if the next one says the same and only headings lie between."""
    w = Window.partitionBy("document_id").orderBy("pos")
    later = w.rowsBetween(1, Window.unboundedFollowing)
    top = F.coalesce(F.col("level") == 1, F.lit(False))
    looked = blocks.withColumns({
        "__nth": F.sum(top.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "__next": F.min(F.when(top, F.struct("pos", "text"))).over(later),
        "__body": F.min(F.when(F.col("kind") != "heading", F.col("pos"))).over(later),
    })
    repeated = top & (F.col("__nth") == 1) & (F.lower("text") == F.lower("__next.text")) & (F.col("__body").isNull() | (F.col("__body") > F.col("__next.pos")))
    return looked.where(~F.coalesce(repeated, F.lit(False))).select(*blocks.columns)


def document_id(fields: Column, stem: Column) -> Column:
    """The labelled id, else the id that the file name starts with, else the file name; in capitals."""
    return F.upper(F.coalesce(T.clean_value(fields["document id"]), F.nullif(F.regexp_extract(stem, FILE_ID, 0), F.lit("")), stem))


def document_name(fields: Column, title_hint: Column, first_heading: Column, stem: Column) -> Column:
    """The labelled title, else the loader's, else the first top heading, else the file name in words."""
    return F.coalesce(T.clean_value(fields["document title"]), T.clean_value(fields["title"]), title_hint, first_heading, F.initcap(F.replace(stem, F.lit("_"), F.lit(" "))))


def metadata(fields: Column, stem: Column, title_hint: Column, first_heading: Column) -> list[Column]:
    """Columns of the document's metadata."""
    date = F.coalesce(F.nullif(fields["effective date"], F.lit("")), fields["effective"])
    return [
        document_id(fields, stem).alias("document_id"), document_name(fields, title_hint, first_heading, stem).alias("document_name"),
        *[T.clean_value(fields[label]).alias(name) for label, name in (("department", "department"), ("policy category", "category"), ("version", "version"))],
        T.clean_value(date).alias("effective_date"), T.clean_value(fields["status"]).alias("status"),
    ]


def clean_blocks(blocks: DataFrame) -> DataFrame:
    """``blocks`` with cleaned texts; empty ones go, and a heading without a level has level 2."""
    cleaned = blocks.withColumn("text", T.clean_text(F.col("text"))).where(F.col("text") != "")
    return cleaned.withColumn("level", F.coalesce("level", F.when(F.col("kind") == "heading", 2)).cast("int"))


def document_hash(identity: Column, blocks: Column) -> Column:
    """Digest of the id and of every block's kind, level and text; where a document comes from doesn't count."""
    line = lambda b: F.concat(b["kind"], F.lit(":"), F.coalesce(b["level"], F.lit(0)).cast("string"), F.lit(":"), b["text"])
    return F.sha2(F.array_join(F.concat(F.array(identity), F.transform(blocks, line)), "\n"), 256)


def source_uri(path: Column, base: str = "") -> Column:
    """Where a citation points: the file's name below ``base``, else the file itself."""
    return F.concat(F.lit(base.rstrip("/") + "/"), F.element_at(F.split(path, "/"), -1)) if base else F.when(path.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), path).otherwise(F.concat(F.lit("file://"), path))


def documents(loaded: DataFrame, base: str = "") -> DataFrame:
    """One row per loaded file that has blocks: its metadata, its blocks with section paths, and its digest.

    ``loaded`` holds path, document_type, title_hint and blocks.  Files whose
    blocks are all empty or lifted as labelled values have an empty array.
    """
    from .chunk import section_path

    rows = loaded.select(F.col("path").alias("document_id"), F.posexplode("blocks").alias("pos", "b")).select(
        "document_id", "pos", "b.kind", "b.text", "b.level", "b.page_number"
    )
    fields, kept = lift_front_matter(clean_blocks(rows))
    kept = section_path(drop_repeated_title(kept))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "kind", "text", "level", "page_number", "section_path")))
    bodies = kept.groupBy("document_id").agg(ordered.alias("blocks"), F.min_by("text", F.when(F.col("level") == 1, F.col("pos"))).alias("first_heading"))
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"(?<=.)\.[^.]*$", "")
    named = (
        loaded.where(F.size("blocks") > 0).select("path", "document_type", "title_hint")
        .join(fields.withColumnRenamed("document_id", "path"), "path", "left").join(bodies.withColumnRenamed("document_id", "path"), "path", "left")
        .select("path", "document_type", *metadata(F.col("fields"), stem, F.col("title_hint"), F.col("first_heading")), source_uri(F.col("path"), base).alias("source_uri"),
                F.coalesce("blocks", F.array().cast(ordered_type(bodies))).alias("blocks"))
    )
    return named.withColumn("content_hash", document_hash(F.col("document_id"), F.col("blocks")))


def ordered_type(bodies: DataFrame) -> str:
    return bodies.schema["blocks"].dataType.simpleString()
