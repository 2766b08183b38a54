"""Corpus pipeline: quality filter, near-duplicate removal, masking of personal data, packing.

Counted as part of the subpackage ``parchmill.llm``.  Every stage takes
(spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's rows
as Parquet in the shared folder and reads them again as the next one's input.
All stages keep null and empty texts but where their decisions say otherwise,
treat repeated rows one by one, give an empty table for an empty table, and
pass on further columns whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parchmill.llm import candidates, packing, pii, quality, simhash
from parchmill.llm.common import fresh, materialize, table
from parchmill.llm.queries import tokenizer_file

#: Near-duplicates: shingles of WORDS words; fingerprints of 64 * LANES bits that differ in at most NEAR of the first 64
#: bits and WIDE bits in all.  Sets of equal size with similarity 0.8 have shares of 0.89 in common, so their
#: fingerprints differ in 15 of 100 bits: 10 of 64, 19 of 128.
WORDS, LANES, NEAR, WIDE, AGREE = 5, 2, 9, 20, 2


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the classifier's threshold; it learns from the labels of ``sf_dir``.

    Null and empty texts are scored like any other, as texts without marks.
    """
    ratio, model = quality.fit(docs, table(spark, sf_dir, "labels"))
    (score,) = fresh(docs, "score")
    return quality.with_score(docs, ratio, model, score).where(F.col(score) >= quality.THRESHOLD).select(*docs.columns)


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every near-duplicate group: the one with the smallest doc_id.

    Groups are what links of like fingerprints connect, and links of texts whose
    sets of five-word shingles have a Jaccard similarity of 0.8 or more.  Among rows that repeat
    that doc_id, and in groups without any doc_id, a hash of the text decides.
    Texts without words are one group.
    """
    row, order, band, *lanes = fresh(docs, "row", "order", "bands", *[f"fp{k}" for k in range(LANES)])
    rows = materialize(candidates.with_signature(docs, lanes, band, WORDS).withColumn(row, F.monotonically_increasing_id()), "rows")
    names = ["fp", *[f"fp{k}" for k in range(1, LANES)]]
    fps = rows.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(a).alias(b) for a, b in zip(lanes, names)], F.col(row).alias("row"), F.xxhash64("text").alias("order"), F.col(band).alias("bands"))
    distinct = simhash.distinct_fingerprints(fps, names, F.min_by("bands", "row").alias("bands"), F.min("row").alias("row"))
    near = simhash.link_edges(distinct.select(*names, F.col("node").alias("rep")), NEAR, agree=AGREE, wide=WIDE)
    # Pairs of the same likeness that lie beyond the radius: the fingerprint only estimates it.
    texts = rows.select(F.col(row).alias("row"), "text").join(distinct.select("row", "node").hint("merge"), "row").select("node", "text")
    beyond = candidates.confirmed(candidates.pairs(distinct), texts, WORDS)
    classes = simhash.linked_classes(distinct.select(*names, "least", "copies", "node"), names, near.union(beyond))
    # A class is named by one number from here on.
    key = F.sha2(F.concat_ws(",", *names), 256)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "order", "row")
    best = fps.groupBy(key.alias("key")).agg(F.min(rank).alias("best"))
    kept = best.join(classes.select(key.alias("key"), "part"), "key").groupBy("part").agg(F.min("best").alias("best")).select(F.col("best.row").alias(row))
    # As many ids as documents: the same plan at every size, and no broadcast.
    return rows.join(kept.hint("merge"), row, "left_semi").select(*docs.columns)


def personal_data_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with spans of personal data replaced by their kind; n_chars follows the text."""
    return pii.mask(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 2048 tokens.

    A null or empty text is one piece that holds the end id.
    """
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("quality classifier", quality_filter),
    ("simhash near-dedup", near_duplicate_removal),
    ("pii masking", personal_data_masking),
    ("best-fit packing", sequence_packing),
]

#: The classifier, SimHash and the tokenizer have no SQL form; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs, f"stage{number}")
    return docs
