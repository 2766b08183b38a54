"""The embedder seam, evaluation, and the rate limit per event."""

import datetime as dt
import hashlib
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from parchmill.errors import EmbeddingError
from parchmill.operators import embed, evaluate, index
from parchmill.plans import ingest
from parchmill.streaming import limits

# ---- embedder


def answering(texts):
    """A service that answers in another order than it was asked in."""
    if any("poison" in t for t in texts):
        raise ConnectionError("refused")
    return [(k, [float(len(texts[k])), float(len(texts))]) for k in reversed(range(len(texts)))]


def service(**options):
    return embed.Embedder(**{"call": answering, "dimensions": 2, "batch": 4, "attempts": 2, "delay": 0.0} | options)


def test_batches_and_order(spark):
    rows = [(k, "x" * k if k else None) for k in range(23)]
    frame = spark.createDataFrame(rows, "n int, embedding_text string").coalesce(1)
    got = {r["n"]: r for r in embed.embed_with(frame, service()).collect()}
    assert got[0]["embedding"] is None and got[0]["embedding_error"] is None
    assert all(got[k]["embedding"][0] == k and got[k]["embedding"][1] <= 4 for k in range(1, 23))
    assert sorted(r["embedding"][1] for r in got.values() if r["embedding"]) == [2.0] * 2 + [4.0] * 20  # 22 texts, four at a time
    assert embed.raise_errors(embed.embed_with(frame, service())).columns == ["n", "embedding_text", "embedding"]


def test_retries_and_wrong_answers(monkeypatch):
    slept = []
    monkeypatch.setattr(embed.time, "sleep", slept.append)
    calls = []

    def shaky(texts):
        calls.append(len(texts))
        if len(calls) < 4:
            raise TimeoutError
        return answering(texts)

    assert service(call=shaky, attempts=4, delay=1.5).vectors(["a", "bb"]) == [[1.0, 2.0], [2.0, 2.0]] and slept == [1.5, 3.0, 6.0]
    with pytest.raises(EmbeddingError, match="failed 2 times: ConnectionError"):
        service().vectors(["poison"])
    for answer in ([(0, [1.0, 2.0])], [(0, [1.0, 2.0]), (2, [1.0, 2.0])], [(0, [1.0]), (1, [1.0, 2.0])], [(0, [1.0, float("nan")]), (1, [1.0, 2.0])], [(0, None), (1, [1.0, 2.0])]):
        with pytest.raises(EmbeddingError):
            service(call=lambda texts: answer).vectors(["a", "b"])


def test_a_document_fails_alone(spark, tmp_path):
    source = spark.createDataFrame([("good.md", b"# Good\n\nfine text"), ("bad.md", b"# Bad\n\n## One\n\nfine\n\n## Two\n\npoison here"), ("last.md", b"# Last\n\nmore")], "path string, content binary")
    store, settings = index.Snapshots(spark, str(tmp_path / "index")), ingest.Settings(dimensions=2)
    done = ingest.run(source, store, settings, embedder=service(batch=1))
    got = {r["source_path"]: (r["outcome"], r["error_class"], r["chunks_written"]) for r in done.results.collect()}
    assert got == {"good.md": ("indexed", None, 1), "bad.md": ("failed", "EmbeddingError", 0), "last.md": ("indexed", None, 1)}
    assert {r["document_id"] for r in store.read().collect()} == {"GOOD", "LAST"} and done.report().first()["status"] == "failed"
    # A later run with a service that answers takes it up, and skips the others.
    again = ingest.run(source, store, settings, embedder=service(call=lambda texts: [(k, [1.0, 2.0]) for k in range(len(texts))]))
    assert {r["source_path"]: r["outcome"] for r in again.results.collect()} == {"good.md": "skipped_unchanged", "bad.md": "indexed", "last.md": "skipped_unchanged"}
    frame = spark.createDataFrame([("poison",)], "embedding_text string")
    with pytest.raises(EmbeddingError):
        embed.raise_errors(embed.embed_with(frame, service()))


# ---- evaluation


def test_outcomes_and_metrics_against_plain_version(spark):
    rng = np.random.default_rng(4)
    questions = spark.createDataFrame([(f"Q{k}", "q", [f"D{k % 7}", f"D{k % 5}"] if k % 4 else []) for k in range(40)], "id string, question string, source_documents array<string>")
    ranked = [(f"Q{k}", f"D{d}", r + 1) for k in range(40) if k % 6 for r, d in enumerate(rng.permutation(12)[:8].tolist())]
    finished = [(f"Q{k}", "refused_no_context" if k % 3 == 0 else "answered") for k in range(38)]
    values = evaluate.outcomes(
        questions.select(F.col("id").alias("query_id")), evaluate.expected_documents(questions), spark.createDataFrame(ranked, "query_id string, document_id string, rank int"),
        spark.createDataFrame(finished, "query_id string, finish_reason string"),
    )
    want = {}
    for k in range(40):
        refused = float(k % 3 == 0 and k < 38)
        if k % 4 == 0:
            want[f"Q{k}", "refusal"] = refused
            continue
        first = min((r for q, d, r in ranked if q == f"Q{k}" and r <= 6 and d in (f"D{k % 7}", f"D{k % 5}")), default=None)
        want |= {(f"Q{k}", "recall"): float(first is not None), (f"Q{k}", "mrr"): 1 / first if first else 0.0, (f"Q{k}", "false_refusal"): refused}
    got = {(r["query_id"], r["metric"]): r["value"] for r in values.collect()}
    assert got == pytest.approx(want)

    def times(query, number):
        u = int(hashlib.md5(f"1:{query}:{number}".encode()).hexdigest()[:8], 16) / 2**32
        return sum(u >= p for p in evaluate.POISSON)

    table = {r["metric"]: r for r in evaluate.metrics(values, rounds=30).collect()}
    for metric in ("recall", "mrr", "refusal", "false_refusal"):
        own = {q: v for (q, m), v in want.items() if m == metric}
        means = []
        for n in range(1, 31):
            w = {q: times(q, n) for q in own}
            means.append(sum(w[q] * own[q] for q in own) / sum(w.values()))
        r = table[metric]
        assert r["n"] == len(own) and r["value"] == pytest.approx(statistics.mean(own.values()))
        assert (r["low"], r["high"]) == pytest.approx((np.quantile(means, 0.05), np.quantile(means, 0.95)))
        assert r["low"] <= r["value"] <= r["high"] or metric == "refusal"
    assert evaluate.metrics(values.limit(0)).count() == 0


# ---- rate limit


def test_decisions_by_stream_and_table(spark, tmp_path):
    rng = np.random.default_rng(9)
    start = dt.datetime(2024, 1, 1)
    times = sorted(start + dt.timedelta(seconds=int(s)) for s in rng.integers(0, 12 * 3600, 400))
    rows = [(k, t, int(rng.integers(0, 4)) if k % 3 else 1) for k, t in enumerate(times)]  # one user has a third of all events
    folder = tmp_path / "events"
    for k in range(4):
        spark.createDataFrame(rows[k * 100 : (k + 1) * 100], "event_id long, ts timestamp, user_id long").coalesce(1).write.mode("append").parquet(str(folder))
        import time

        time.sleep(1.1)  # files are taken in the order of their times
    seen, want = {}, {}
    for e, t, u in rows:
        hour = t.replace(minute=0, second=0)
        seen[u, hour] = seen.get((u, hour), 0) + 1
        want[e] = (u, hour, seen[u, hour] <= 3)
    table = spark.read.parquet(str(folder))
    read = lambda df: {r["event_id"]: (r["user_id"], r["hour"], r["allowed"]) for r in df.collect()}
    assert read(limits.decided(table, 3)) == want
    assert read(limits.run_limited(spark, str(folder), 3)) == want
    # One file a batch: counts are kept from batch to batch, and dropped when the watermark has passed their hour.
    assert read(limits.run_limited(spark, str(folder), 3, late="10 minutes", files_per_batch=1)) == want
