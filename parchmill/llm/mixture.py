"""Operator 13: mix sources to target weights by a low-discrepancy schedule, with DataFrame functions only.

The mixture is a line of 2^m slots.  Slot t stands at the van der Corput point
of t (its m bits reversed), which is mapped through the cumulative targets of
the sources, so every stretch of slots holds the sources in nearly their
shares.  The slots of a source are ranked in the order of the line, and the
slot of rank j gets block j of the source: the source's documents in seeded
order, one after the other, cut into blocks of equally many words, begun anew
at the end of the source.

Targets: sources in code point order, null last, take the weights in turn and
share the words of all documents.  A target stops at ``cap`` times its source's
size, and the excess is shared by weight among the others until none is above.

Nothing here is ever one task: documents are placed in their source by cells of
a hash, so a source with a third of all rows is many cells; copies of one row
are counted before they are shuffled and take one stretch together.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, partitions, running_totals, text_or_empty

#: Weights of the sources in turn; how often a source may be repeated; words of a block; seed of the documents' order.
WEIGHTS, CAP, BLOCK, SEED = (5, 2, 1), 3, 1024, 29
#: Rows of a cell on average; what one task makes of one row at most.
CELL, RUN = 2048, 4096
#: Words are runs of characters other than these.
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of the hash that orders documents.
BITS = 60


def _rows(docs: DataFrame, seed: int) -> DataFrame:
    """(name, doc_id, size, h, copies): equal rows once, with their number.  ``name`` sorts sources by code point, null last."""
    text = text_or_empty()
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"), F.md5(text.cast("binary"))).cast("binary"))
    return docs.select(
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("t")).alias("name"), F.col("doc_id"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), h.alias("h"),
    ).groupBy("name", "doc_id", "size", "h").agg(F.count("*").alias("copies"))


def _ranked(sums: DataFrame) -> DataFrame:
    """``sums`` with the rank of ``name``, from 0: ranks inside ranges of names, and the counts of the ranges before."""
    ranges = materialize(sums.repartitionByRange(partitions(sums.sparkSession), "name").withColumn("range", F.spark_partition_id()), "names")
    ahead = ranges.groupBy("range").count().select("range", (F.sum("count").over(Window.orderBy("range")) - F.col("count")).alias("ahead"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy("name")) - 1
    return ranges.withColumn("inside", inside).join(ahead, "range").select("name", "source_size", (F.col("inside") + F.col("ahead")).cast("long").alias("rank"))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(name, rank, source_size, target, quota) of each source; ``quota`` is the target in whole words.

    The level that uncapped sources reach per unit of weight is a fraction of
    whole numbers, found by raising it until no further source is capped.
    """
    sums = rows.groupBy("name").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    choice = F.array(*map(F.lit, weights))
    sources = materialize(_ranked(sums).withColumn("weight", F.element_at(choice, (F.col("rank") % len(weights) + 1).cast("int")).cast("long")), "sources")
    total, level, weight = sources.agg(F.sum("source_size"), F.sum("source_size"), F.sum("weight")).first()
    while weight:
        above = F.col("weight").cast("decimal(19,0)") * F.lit(Decimal(level)) > F.col("source_size").cast("decimal(19,0)") * F.lit(Decimal(cap * weight))
        capped, free = sources.agg(F.sum(F.when(above, F.col("source_size") * cap).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("weight")))).first()
        if (total - capped, free) == (level, weight):
            break
        level, weight = total - capped, free
    share = F.col("weight").cast("double") * float(level or 0) / float(weight or 1)
    most = F.col("source_size") * cap
    target = F.least(share, most.cast("double")) if weight else most.cast("double")
    return sources.select("name", "rank", "source_size", target.alias("target"), F.least(F.floor(target + 0.5), most).alias("quota"))


def _scheduled(sources: DataFrame, block: int) -> tuple[DataFrame, int]:
    """``sources`` with their interval of grid points: ``first`` and ``slots``; and m, for 2^m points.

    A source whose target is smaller than a point's share gets one slot at the
    point where its interval begins.  No source has more slots than words.
    """
    everything = sources.agg(F.sum("quota")).first()[0] or 0
    bits = max(1, (-(-everything // block) - 1).bit_length()) if everything else 1
    at = running_totals(sources, "rank", "quota", "before")
    cut = lambda x: f"cast((cast({x} as decimal(19,0)) * {2**bits} + {max(everything, 1) - 1}) div {max(everything, 1)} as long)"
    points = at.selectExpr("*", f"{cut('before')} as low", f"{cut('before + quota')} as high")
    return points.selectExpr(
        "name", "rank", "source_size", "target", "quota", f"least(low, {2**bits - 1}) as first", "least(quota, greatest(high - low, 1)) as slots",
    ), bits


def schedule(sources: DataFrame, bits: int) -> DataFrame:
    """(name, block, slot): the slots of the line, ranked per source in the line's order; the rank is the block's number."""
    runs = sources.where("slots > 0").select("name", "first", "slots", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(RUN).cast("long"))).alias("run"))
    points = runs.repartition("name", "run").select("name", F.explode(F.sequence(F.col("first") + F.col("run"), F.col("first") + F.least(F.col("run") + RUN, F.col("slots")) - 1)).alias("point"))
    slot = F.conv(F.reverse(F.lpad(F.bin("point"), bits, "0")), 2, 10).cast("long")
    slots = points.select("name", slot.alias("slot"), F.shiftright(slot, 12).alias("stretch"))
    inside = F.row_number().over(Window.partitionBy("name", "stretch").orderBy("slot")) - 1
    ahead = slots.groupBy("name", "stretch").count().select("name", "stretch", (F.sum("count").over(Window.partitionBy("name").orderBy("stretch")) - F.col("count")).alias("ahead"))
    # Spark sizes these tables by the sources before they are exploded: without hints it would send all slots to every task.
    return slots.withColumn("inside", inside).join(ahead.hint("merge"), ["name", "stretch"]).select("name", (F.col("inside") + F.col("ahead")).alias("block"), "slot")


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` one by one (``copy`` from 0), with ``start``: how many words of their source come before them."""
    count = rows.count()
    width = 2**BITS // max(1, count // CELL) + 1
    celled = rows.withColumn("cell", F.expr(f"cast(conv(substr(h, 1, {BITS // 4}), 16, 10) as long) div {width}")).withColumn("words", F.col("size") * F.col("copies"))
    ahead = celled.groupBy("name", "cell").agg(F.sum("words").alias("sum")).select("name", "cell", (F.sum("sum").over(Window.partitionBy("name").orderBy("cell")) - F.col("sum")).alias("ahead"))
    inside = F.sum("words").over(Window.partitionBy("name", "cell").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")
    placed = celled.withColumn("inside", inside).join(ahead, ["name", "cell"]).withColumn("start", F.col("inside") + F.col("ahead"))
    # Few copies are numbered where they are, many in runs that are dealt out first.
    few = placed.where(F.col("copies") <= RUN).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    runs = placed.where(F.col("copies") > RUN).withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(RUN).cast("long"))))
    many = runs.repartition("h", "run").withColumn("copy", F.explode(F.sequence("run", F.least(F.col("run") + RUN, "copies") - 1))).drop("run")
    return few.unionByName(many).select("name", "doc_id", "size", "h", "copy", (F.col("start") + F.col("copy") * F.col("size")).alias("start"))


def _pieces(placed: DataFrame, sources: DataFrame, cap: int) -> DataFrame:
    """(name, doc_id, h, copy, block, first, words): the part of each document in each block of its source's rounds.

    The first ``quota % slots`` blocks of a source have one word more than the others.
    """
    inside = placed.join(sources.select("name", "source_size", "quota", "slots"), "name").where("size > 0 and slots > 0").selectExpr(
        "*", "quota div slots as low", "quota % slots as more", f"explode(sequence(0, {cap - 1})) as turn",
    ).selectExpr("*", "start + turn * source_size as begin").selectExpr("*", "least(begin + size, quota) as stop").where("begin < stop")
    number = lambda x: f"if({x} < more * (low + 1), {x} div (low + 1), more + ({x} - more * (low + 1)) div low)"
    edge = lambda x: f"({x}) * low + least({x}, more)"
    each = inside.selectExpr("*", f"explode(sequence({number('begin')}, {number('(stop - 1)')})) as block")
    return each.selectExpr("*", f"greatest(begin, {edge('block')}) as lower", f"least(stop, {edge('block + 1')}) as upper").selectExpr(
        "name", "doc_id", "h", "copy", "block", "lower - begin as first", "upper - lower as words",
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, block: int = BLOCK, seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mixture of ``docs`` (doc_id, source, text): its pieces, its documents and its sources.

    pieces: (slot, name, block, doc_id, h, copy, first, words); the mixture is
    the words of the pieces by slot, then by name, and in a block by the
    documents' order.  A piece is ``words`` words of a document from word
    ``first`` on.  documents: (name, doc_id, h, copy, size), one row per row of
    ``docs``.  sources: (name, rank, source_size, target, quota, first, slots).

    Null texts count as empty and have no pieces; null sources are a source of
    their own, the last; null ids are allowed; repeated rows are mixed one by
    one; other columns are ignored.  An empty table, or one without words,
    gives no pieces.  The result depends on the rows and parameters alone.
    """
    rows = materialize(_rows(docs, seed), "sizes")
    sources, bits = _scheduled(targets(rows, weights, cap), block)
    sources = materialize(sources, "schedule")
    placed = materialize(_placed(rows), "placed")
    pieces = _pieces(placed, sources, cap).join(schedule(sources, bits).hint("merge"), ["name", "block"])
    return pieces, placed.select("name", "doc_id", "h", "copy", "size"), sources


def mixed_texts(docs: DataFrame, pieces: DataFrame, seed: int = SEED) -> DataFrame:
    """``pieces`` with their words joined by single spaces as ``text``."""
    text = text_or_empty()
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"), F.md5(text.cast("binary"))).cast("binary"))
    bodies = docs.select(h.alias("h"), text.alias("text")).dropDuplicates(["h"])
    words = F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), (F.col("first") + 1).cast("int"), F.col("words").cast("int"))
    return pieces.join(bodies, "h").withColumn("text", F.array_join(words, " "))


def mix_report(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, taken (the words of its pieces), slots (its pieces)."""
    pieces, placed, sources = mix(docs, weights, cap, block, seed)
    none = F.lit(None).cast("long")
    both = pieces.select("name", "doc_id", "h", "copy", none.alias("size"), "words", F.lit(1).alias("slots")).union(
        placed.select("name", "doc_id", "h", "copy", "size", F.lit(0).cast("long"), F.lit(0))
    )
    each = both.groupBy("name", "doc_id", "h", "copy").agg(F.max("size").alias("size"), F.sum("words").alias("taken"), F.sum("slots").alias("slots"))
    return each.join(sources.select("name", "source_size", "target"), "name").select("doc_id", "size", "source_size", "target", "taken", "slots")
