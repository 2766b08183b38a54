"""Blocks of paged documents from their printed lines, by windows over each document's lines.

Lines are rows (document_id, pos, page_number, text, size, bold, top, bottom) in
reading order; a PDF reader of any kind can supply them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import collapse

# How headings, paragraph gaps and list items are told.
HEADING_RATIO, HEADING_CHARS, BOLD_CHARS, GAP_RATIO, BULLETS = 1.15, 120, 80, 0.45, "•●▪◦-–*"


def body_size(lines: DataFrame) -> DataFrame:
    """(document_id, body_size): the font size with most characters; among equal ones the first to appear."""
    sizes = lines.groupBy("document_id", "size").agg(F.sum(F.length("text")).alias("n"), F.min("pos").alias("first"))
    return sizes.groupBy("document_id").agg(F.max_by("size", F.struct("n", -F.col("first"))).alias("body_size"))


def is_heading(body: Column, outlined: Column) -> Column:
    """Short lines that the outline names, that are printed larger than the body, or that are bold and no sentence."""
    text = F.col("text")
    bold = F.col("bold") & (F.length(text) <= BOLD_CHARS) & ~F.rtrim(text).rlike(r"[.,]$")
    return (F.length(text) <= HEADING_CHARS) & (outlined | (F.col("size") >= F.lit(HEADING_RATIO) * body) & (body > 0) | bold)


def heading_levels(headings: DataFrame) -> DataFrame:
    """(document_id, size, level): distinct heading sizes ranked from the largest, 6 at most."""
    rank = F.dense_rank().over(Window.partitionBy("document_id").orderBy(F.desc("size")))
    return headings.select("document_id", "size").distinct().withColumn("level", F.least(rank, F.lit(6)).cast("int"))


def line_blocks(lines: DataFrame, outline: DataFrame | None = None) -> DataFrame:
    """(document_id, pos, kind, text, level, page_number) of the lines' blocks; outline: (document_id, text).

    A heading is a block of its own; a sign of BULLETS begins a list item, and a
    new page or a gap a paragraph; other lines go on with the one before.
    Lines without text are left out.
    """
    text = F.col("text")
    lines = lines.withColumn("text", collapse(text)).where(text != "")
    known = lines.join(outline.select("document_id", "text").distinct().withColumn("outlined", F.lit(True)), ["document_id", "text"], "left") if outline is not None else lines.withColumn("outlined", F.lit(False))
    told = known.join(body_size(lines), "document_id").withColumn("heading", is_heading(F.col("body_size"), F.coalesce("outlined", F.lit(False))))
    told = told.join(heading_levels(told.where("heading")), ["document_id", "size"], "left")
    w = Window.partitionBy("document_id").orderBy("pos")
    before = lambda c: F.lag(c).over(w)
    bullet = text.rlike(rf"^[{BULLETS}]".replace("-", r"\-"))
    gap = (before("page_number") != F.col("page_number")) | (F.col("top") - before("bottom") > F.greatest("size", F.lit(1.0)) * GAP_RATIO)
    starts = F.col("heading") | F.coalesce(before("heading"), F.lit(True)) | bullet | F.coalesce(gap, F.lit(False))
    placed = told.withColumns({"bullet": bullet & ~F.col("heading"), "starts": starts}).withColumn("block", F.sum(F.col("starts").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    words = F.when(F.col("bullet"), F.trim(F.regexp_replace("text", rf"^[{BULLETS}]+".replace("-", r"\-"), ""))).otherwise(text)
    merged = placed.groupBy("document_id", "block").agg(
        F.min("pos").alias("pos"), F.min_by(F.when(F.col("heading"), "heading").when(F.col("bullet"), "list_item").otherwise("paragraph"), "pos").alias("kind"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", words.alias("words")))), lambda x: x["words"]), " ").alias("text"),
        F.min_by(F.when(F.col("heading"), F.col("level")), "pos").alias("level"), F.min_by("page_number", "pos").alias("page_number"),
    )
    return merged.withColumn("text", collapse(F.col("text"))).where(text != "").drop("block")
