"""Documents ranked for a question set: against plain sums, and how many rows leave a task."""

import math

import pytest

from parchmill.operators import rankings
from parchmill.plans import answer_queries

DOCUMENTS = [(i * 37 % 101, f"Word{i % 7} common\x0bWORD{i % 5}  tail{i % 3}\n" + "common " * (i % 4)) for i in range(60)] + [(500, "common word1"), (500, "common word1"), (500, "common word1 word2"), (7000, None), (7001, " \n")]
QUESTIONS = [(1, "common word1 tail2"), (2, "WORD2 word3 word3"), (3, "nowhere"), (4, ""), (5, None), (None, "word1")]


def plain(k):
    rows, out = [(i, [w for w in (t or "").lower().replace("\x0b", " ").split()]) for i, t in DOCUMENTS], []
    n, mean = len(rows), sum(len(w) for _, w in rows) / len(rows)
    tf = {}
    for i, words in rows:
        for w in words:
            tf[i, len(words), w] = tf.get((i, len(words), w), 0) + 1
    df = {}
    for _, _, w in tf:
        df[w] = df.get(w, 0) + 1
    for q, text in QUESTIONS:
        bm25, shared = {}, {}
        for (i, size, w), f in tf.items():
            if w in set((text or "").lower().split()):
                bm25[i] = bm25.get(i, 0) + math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * size / mean))
                shared.setdefault(i, set()).add(w)
        for ranking, scores in enumerate(({i: round(s, 6) for i, s in bm25.items()}, {i: float(len(s)) for i, s in shared.items()})):
            out += [(q, i, ranking, s, r) for r, (i, s) in enumerate(sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("limits", [{}, {"BLOCK": 2, "SPLIT": 3, "CELLS": 8}, {"ASKED": 2}])
def test_against_plain_sums(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(rankings, name, value)
    documents = spark.createDataFrame(DOCUMENTS, "doc_id long, text string").repartition(5)
    queries = spark.createDataFrame(QUESTIONS, "query_id int, text string")
    found = rankings.rankings(documents, queries, 4).select("query_id", "doc_id", "ranking", "score", "rank").collect()
    assert sorted((tuple(r[:3]) + (round(r["score"], 6), r["rank"]) for r in found), key=str) == plain(4)


def test_no_row_per_question_and_document_is_shuffled(spark, tmp_path):
    n, asked = 3000, 20
    spark.createDataFrame([(i, f"common word{i % 11} other{i % 13}", f"s{i % 3}", "en") for i in range(n)], "doc_id long, text string, source string, lang string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(q, f"common word{q % 11}") for q in range(asked)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = answer_queries.context_blocks(spark, str(tmp_path))
    assert len(frame.collect()) == asked

    def written(plan):
        name, inner = plan.getClass().getSimpleName(), []
        if name == "AdaptiveSparkPlanExec":
            inner = [plan.executedPlan()]
        elif "QueryStageExec" in name:
            inner = [plan.plan()]
        else:
            children = plan.children()
            inner = [children.apply(i) for i in range(children.size())]
        own = plan.metrics().apply("shuffleRecordsWritten").value() if name == "ShuffleExchangeExec" else 0
        return own + sum(map(written, inner))

    assert 0 < written(frame._jdf.queryExecution().executedPlan()) < n * asked / 2


def test_no_text_is_shuffled(spark, tmp_path):
    """The documents' texts meet the chosen ones without an exchange, but for the six of each question."""
    spark.createDataFrame([(i, f"common word{i % 11} " + "long " * 400 + str(i), f"s{i % 3}", "en") for i in range(2000)], "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(q, f"common word{q % 11}") for q in range(10)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if nothing were small
    try:
        plan = answer_queries.context_blocks(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
