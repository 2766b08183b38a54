"""Evaluation of a run over a question set: expected documents, refusals, one table of metrics with intervals by resampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Results that count; resamples; share of them below and above the interval.
TOP, ROUNDS, TAIL = 6, 200, 0.05
#: Chances that a Poisson variable of mean 1 is at most 0, 1, 2 ...
POISSON = (0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, 0.9994058151824183, 0.9999167588507119)


def expected_documents(questions: DataFrame) -> DataFrame:
    """(query_id, document_id) of a question set with its lists of source documents."""
    return questions.select(F.col("id").alias("query_id"), F.explode("source_documents").alias("document_id")).distinct()


def outcomes(asked: DataFrame, expected: DataFrame, ranked: DataFrame, finished: DataFrame, k: int = TOP) -> DataFrame:
    """(query_id, metric, value) of each question of ``asked`` (query_id) and each metric it counts for.

    expected: (query_id, document_id); ranked: (query_id, document_id, rank);
    finished: (query_id, finish_reason).  Questions with an expected document
    count for recall (one of the best k is expected), mrr (1 by the rank of the
    first such) and false_refusal; the others are probes and count for refusal.
    Without a finish_reason a question isn't refused.
    """
    hits = ranked.where(F.col("rank") <= k).join(expected, ["query_id", "document_id"]).groupBy("query_id").agg(F.min("rank").alias("first"))
    answerable = expected.select("query_id").distinct().withColumn("answerable", F.lit(True))
    refused = finished.groupBy("query_id").agg(F.max(F.col("finish_reason").startswith("refused").cast("double")).alias("refused"))
    told = asked.select("query_id").distinct().join(answerable, "query_id", "left").join(hits, "query_id", "left").join(refused, "query_id", "left")
    value = lambda name, v: F.struct(F.lit(name).alias("metric"), v.cast("double").alias("value"))
    said = F.coalesce("refused", F.lit(0.0))
    found = F.array(value("recall", F.col("first").isNotNull()), value("mrr", F.coalesce(1 / F.col("first"), F.lit(0.0))), value("false_refusal", said))
    each = F.explode(F.when(F.col("answerable"), found).otherwise(F.array(value("refusal", said))))
    return told.select("query_id", each.alias("m")).select("query_id", "m.*")


def drawn(query_id: Column, number: Column, seed: int) -> Column:
    """How often a question is in a resample: Poisson of mean 1, from a digest."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), query_id.cast("string"), number.cast("string")).cast("binary"))
    u = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(2.0**32)
    return sum((F.when(u >= p, 1).otherwise(0) for p in POISSON), F.lit(0))


def metrics(values: DataFrame, rounds: int = ROUNDS, tail: float = TAIL, seed: int = 1) -> DataFrame:
    """(metric, n, value, low, high): means over questions, and the ``tail`` and 1 - ``tail`` percentiles of their resampled means.

    Every question enters each of ``rounds`` resamples as often as a digest of
    its id says, so the interval doesn't depend on how the rows are spread, and
    all resamples are made in one aggregation.
    """
    plain = values.groupBy("metric").agg(F.count("*").alias("n"), F.avg("value").alias("value"))
    many = values.select("*", F.explode(F.sequence(F.lit(1), F.lit(rounds))).alias("number")).withColumn("times", drawn(F.col("query_id"), F.col("number"), seed))
    means = many.groupBy("metric", "number").agg((F.sum(F.col("times") * F.col("value")) / F.sum("times")).alias("mean"))
    bounds = means.where("mean is not null").groupBy("metric").agg(F.percentile("mean", tail).alias("low"), F.percentile("mean", 1 - tail).alias("high"))
    return plain.join(bounds, "metric", "left")
