"""Stored indexes: vectors by lists against brute force, keywords by posting blocks against plain BM25."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from parchmill.operators import keywords, retrieve, vectors


def clustered(n=900, d=16, groups=12, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, d))
    return (centres[rng.integers(groups, size=n)] + 0.3 * rng.normal(size=(n, d))).astype(np.float32)


def brute(held, asked, k, keep=lambda i: True):
    out = []
    for q, v in asked.items():
        scores = []
        for i, w in held.items():
            if i != q and keep(i) and np.isfinite(w).all() and np.any(w):
                c = float(np.dot(np.float64(v), np.float64(w)) / np.sqrt(np.dot(np.float64(v), np.float64(v)) * np.dot(np.float64(w), np.float64(w))))
                scores.append((-vectors.rounded(np.array([c]))[0], i))
        out += [(q, i, -s, r) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def frame(spark, held):
    return spark.createDataFrame([(i, [float(x) for x in v], i % 5, 0) for i, v in held.items()], "vec_id long, embedding array<float>, label long, list int")


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    held = dict(enumerate(clustered()))
    index = vectors.VectorIndex(spark, str(tmp_path_factory.mktemp("vectors")), "label long")
    index.fit(frame(spark, held))
    index.put(frame(spark, held))
    return index, held


def asked(spark, held, every=20):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in held.items() if i % every == 0], "query_id long, embedding array<float>")


def same(got, want):
    got = sorted(tuple(r) for r in got.collect())
    assert [(q, i, r) for q, i, _, r in got] == [(q, i, r) for q, i, _, r in want]
    assert np.allclose([s for _, _, s, _ in got], [s for _, _, s, _ in want], atol=2e-6)


@pytest.mark.parametrize("sent", [vectors.SENT, 0])
def test_exact_and_filtered_search(spark, made, sent, monkeypatch):
    monkeypatch.setattr(vectors, "SENT", sent)
    monkeypatch.setattr(vectors, "BLOCK", 64)
    index, held = made
    q, few = asked(spark, held), {i: v for i, v in held.items() if i % 20 == 0}
    same(index.search(q, 7, exact=True), brute(held, few, 7))
    same(index.search(q, 7, exact=True, where=F.col("label") == 3), brute(held, few, 7, lambda i: i % 5 == 3))
    assert index.search(q, 7, where=F.col("label") == 99).count() == 0


def test_recall_reaches_what_was_asked(spark, made):
    index, held = made
    centroids, probes = index.fitted()
    assert 1 <= probes < len(centroids) / 2  # clusters need few lists
    want = {(a, b) for a, b, _, _ in brute(held, {i: v for i, v in held.items() if i % 20 == 0}, 10)}
    got = {(r[0], r[1]) for r in index.search(asked(spark, held)).collect()}
    assert len(want & got) >= 0.9 * len(want)
    one = {(r[0], r[1]) for r in index.search(asked(spark, held), probes=1).collect()}
    assert 0 < len(want & one) <= len(want & got)


def test_commits_change_the_index(spark, tmp_path):
    held = dict(enumerate(clustered(200)))
    index = vectors.VectorIndex(spark, str(tmp_path / "v"), "label long")
    index.fit(frame(spark, held), lists=9)
    index.put(frame(spark, held))
    changed = {3: -held[3], 500: held[4] * 2, 501: np.zeros(16, np.float32), 502: np.full(16, np.nan, np.float32)}
    assert index.put(frame(spark, changed), spark.createDataFrame([(5,), (999,)], "vec_id long")) == 2
    held |= changed
    del held[5]
    few = {i: held[i] for i in (0, 3, 20, 500)}
    q = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in few.items()] + [(7000, None), (7001, [0.0] * 16)], "query_id long, embedding array<float>")
    same(index.search(q, 5, exact=True), brute(held, few, 5))
    index.compact(full=True)
    same(index.search(q, 5, exact=True), brute(held, few, 5))


def test_fit_of_few_vectors(spark, tmp_path):
    index = vectors.VectorIndex(spark, str(tmp_path / "v"))
    with pytest.raises(ValueError):
        index.fit(spark.createDataFrame([(1, [0.0])], "vec_id long, embedding array<float>"))
    one = spark.createDataFrame([(1, [1.0, 2.0])], "vec_id long, embedding array<float>")
    index.fit(one)
    index.put(one)
    asked = one.withColumnRenamed("vec_id", "query_id")
    assert index.search(asked).count() == 0 and index.search(asked.withColumn("query_id", F.lit(9).cast("long"))).first()["score"] == 1.0
    assert index.search(asked.limit(0)).count() == 0


# ---- keywords


WORDS = "the of and rate plan leave pay day office travel hotel train claim form limit audit".split()


def texts(n, seed=3):
    rng = np.random.default_rng(seed)
    share = 1 / np.arange(1, len(WORDS) + 1)
    return {int(i): " ".join(rng.choice(WORDS, rng.integers(0, 40), p=share / share.sum())) for i in range(n)}


def plain_bm25(held, asked, k, keep=lambda i: True, weights=(1.0,)):
    """held: texts, or tuples of them with their fields' weights."""
    fields = {i: t if isinstance(t, tuple) else (t,) for i, t in held.items()}
    tf, size = {}, {}
    for i, parts in fields.items():
        tf[i], size[i] = {}, 0.0
        for part, w in zip(parts, weights):
            for word in part.lower().split():
                tf[i][word] = tf[i].get(word, 0) + w
                size[i] += w
    mean, n, out = np.mean(list(size.values())), len(held), []
    for q, text in asked.items():
        scores = []
        for i in held:
            hits = [w for w in set((text or "").lower().split()) if w in tf[i]]
            s = sum(np.log(1 + (n - df + 0.5) / (df + 0.5)) * tf[i][w] * 2.2 / (tf[i][w] + 1.2 * (0.25 + 0.75 * size[i] / mean)) for w in hits for df in [sum(w in t for t in tf.values())])
            if hits and keep(i):
                scores.append((-np.floor(s * 1e6 + 0.5) / 1e6, i))
        out += [(q, i, -s, r) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def documents(spark, held):
    return spark.createDataFrame([(i, t, i % 3) for i, t in held.items()], "doc_id long, text string, kind int")


ASKED = {1: "the rate", 2: "travel hotel train claim form limit audit", 3: "of of OF the and plan", 4: "nowhere", 5: "", 6: None, 7: "audit unknown the"}


@pytest.mark.parametrize("slice_docs,listed", [(1 << 14, 2000), (40, 2000), (15, 0)])
def test_keyword_search_against_plain_bm25(spark, tmp_path, monkeypatch, slice_docs, listed):
    monkeypatch.setattr(keywords, "SLICE_DOCS", slice_docs)
    monkeypatch.setattr(keywords, "LISTED", listed)
    monkeypatch.setattr(keywords, "QUERIES", 2)
    held = texts(200)
    asked = spark.createDataFrame(list(ASKED.items()), "query_id long, text string")
    index = keywords.KeywordIndex(spark, str(tmp_path / "k"), extra="kind int")
    index.put(documents(spark, held))
    for k in (3, 1000):
        same(index.search(asked, k), plain_bm25(held, ASKED, k))
    same(index.search(asked, 5, where=F.col("kind") == 1), plain_bm25(held, ASKED, 5, lambda i: i % 3 == 1))
    changed = {3: "travel travel audit", 4: "", 900: "hotel audit the", 901: "new words only"}
    index.put(documents(spark, changed), spark.createDataFrame([(k,) for k in range(10, 60)], "doc_id long"))
    now = {i: t for i, t in held.items() if not 10 <= i < 60} | changed
    same(index.search(asked, 5), plain_bm25(now, ASKED, 5))
    same(index.search(asked, 5, where=F.col("kind") == 0), plain_bm25(now, ASKED, 5, lambda i: i % 3 == 0))
    same(index.search(asked, 5, version=1), plain_bm25(held, ASKED, 5))


def test_keyword_fields_and_odd_documents(spark, tmp_path):
    held = {1: ("Leave plan", "pay  day"), 2: ("", "leave leave"), 3: ("pay", ""), 4: ("ÉTÉ", "été\x0bplan")}
    rows = [(i, a, b) for i, (a, b) in held.items()] + [(5, None, None), (None, "pay", "pay")]
    index = keywords.KeywordIndex(spark, str(tmp_path / "k"), {"name": 2.0, "body": 0.5})
    asked = spark.createDataFrame([(1, "leave pay été")], "query_id long, text string")
    assert index.search(asked).count() == 0
    index.put(spark.createDataFrame(rows, "doc_id long, name string, body string"))
    same(index.search(asked, 9), plain_bm25(held | {5: ("", "")}, {1: "leave pay été"}, 9, weights=(2.0, 0.5)))
    assert index.search(asked.limit(0)).count() == 0


def test_maxscore_skips_slices_and_documents(spark, tmp_path, monkeypatch):
    """A rare word decides the best documents, so slices without it aren't answered, and few documents of the common word are."""
    monkeypatch.setattr(keywords, "SLICE_DOCS", 100)
    held = {i: "common " * (1 + i % 3) + "filler words" for i in range(1000)} | {i: "rare common" for i in (7, 8)}
    index = keywords.KeywordIndex(spark, str(tmp_path / "k"))
    index.put(documents(spark, held))
    answered = []
    own = index._answered
    monkeypatch.setattr(index, "_answered", lambda pairs, *a: (answered.append(pairs.count()), own(pairs, *a))[1])
    asked = {1: "rare common"}
    same(index.search(spark.createDataFrame(list(asked.items()), "query_id long, text string"), 1), plain_bm25(held, asked, 1))
    assert answered[0] == 1 and answered[1] <= 2


@pytest.mark.parametrize("listed", [10_000, 0])
def test_postings_test_words_inside_the_row_or_by_a_join(spark, monkeypatch, listed):
    monkeypatch.setattr(retrieve, "LISTED", listed)
    held = texts(60)
    asked = spark.createDataFrame([(q, t) for q, t in ASKED.items() if t], "query_id long, text string")
    got = retrieve.bm25(documents(spark, held), asked, 5)
    same(got.select("query_id", "doc_id", "score", "rank"), plain_bm25(held, {q: t for q, t in ASKED.items() if t}, 5))
