"""Every operator against a plain brute-force version, and on hard small tables."""

import hashlib
import math
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from parchmill.llm import embed_dedup, fingerprint, mixing, packing, pii, quality, queries, shards, simhash, tokenbin, unigram
from parchmill.llm.components import connected_components
from parchmill.llm.encoding import PieceEncoder

LONG = "word " * 30_000 + "a@b.co " + "x" * 50_000
ODD = [
    (1, "The cat sat. Mail me: jo.doe@mail.example.org or +1 (614) 555-8001 now"), (2, ""), (3, None), (4, "   \n "), (5, LONG), (6, "same text here"),
    (7, "same text here"), (7, "same text here"), (None, "no id at all"), (9, "ß ﬁne Ａ 日本 🎉 é"), (10, "ss fine a 日本 🎉 é"), (11, "4111 1111 1111 1111 and 10.0.0.256 and 10.0.0.25"),
]
SCHEMA = "doc_id long, text string, lang string, fp long, rep long, score double, bucket int, tile int, shard int, spans string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, repeats, a very long text, and extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, None, 1, 2, 0.5, 3, 4, 5, "x") for i, t in ODD], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}


def rows(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def groups(nodes, edges):
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


# -- components

def test_components_against_brute_force(spark):
    rng = np.random.default_rng(3)
    edges = [tuple(map(int, e)) for e in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2300)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [e for e in edges if e[0] != e[1]]
    want = groups({x for e in real for x in e}, real)
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- 1 embeddings

def brute_vectors(vectors, threshold=0.93):
    ok = {}
    for k, (_, label, v) in enumerate(vectors):
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v) and vectors[k][0] is not None:
            ok[k] = np.array(v, float)
    links = []
    keys = sorted(ok)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if vectors[a][1] == vectors[b][1] and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] / np.sqrt(ok[a] @ ok[a]) / np.sqrt(ok[b] @ ok[b]) >= threshold:
                links.append((a, b))
    n = Counter(x for e in links for x in e)
    low = groups(range(len(vectors)), links)
    least = defaultdict(lambda: None)
    for k, (i, _, _) in enumerate(vectors):
        if i is not None and (least[low[k]] is None or i < least[low[k]]):
            least[low[k]] = i
    return sorted(((v[0], n[k], least[low[k]]) for k, v in enumerate(vectors)), key=str)


@pytest.mark.parametrize("tile,replicas", [(1024, 3.0), (16, 1e9), (16, 0.0)])
def test_embedding_links(spark, tile, replicas):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8))
    vectors = [(i, int(rng.integers(0, 2)), [float(x) for x in centres[i % 12] + 0.12 * rng.normal(size=8)]) for i in range(240)]
    vectors += [(500 + i, 1, [1.0] * 8) for i in range(40)]  # copies
    vectors += [(600, None, [1.0] * 8), (601, 1, None), (602, 1, [0.0] * 8), (603, 1, [1.0, None] + [0.0] * 6), (604, 1, [float("nan")] * 8), (605, 1, [float("inf")] + [0.0] * 7), (606, 1, []), (607, 1, [1.0] * 4), (608, 1, [2.0] * 4), (None, 1, [5.0] * 8), (609, 1, [2.0] * 8)]
    vectors += [(610, 1, [1.0, *[0.0] * 7]), (610, 1, [0.0, 1.0, *[0.0] * 6]), (611, 1, [1.0, 0.01, *[0.0] * 6]), (612, 1, [0.01, 1.0, *[0.0] * 6])]  # two vectors with one id, each with its own link
    frame = spark.createDataFrame([(*v, "x") for v in vectors], "vec_id long, label int, embedding array<double>, rep string")
    out = embed_dedup.near_duplicates(frame, tile=tile, replicas=replicas).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in out), key=str) == brute_vectors(vectors)
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in out)
    assert embed_dedup.near_duplicates(frame.limit(0)).count() == 0


def test_embedding_pivots_follow_the_clusters(spark):
    """Clustered vectors get many cells; in many dimensions without clusters there are few; there are two at least."""
    rng = np.random.default_rng(6)
    radius = math.sqrt(2 - 2 * 0.93)

    def number(x):
        frame = spark.createDataFrame([(i.to_bytes(8, "big"), 2 if x.shape[1] == 2 else x.shape[1], [float(v) for v in row]) for i, row in enumerate(x)], "digest binary, dim int, embedding array<double>")
        return len(next(iter(embed_dedup.choose_pivots(frame, radius).values())))

    centres = rng.normal(size=(40, 16)) * 5
    assert number(centres[rng.integers(0, 40, 3000)] + 0.05 * rng.normal(size=(3000, 16))) >= 16
    assert number(rng.normal(size=(2000, 64))) <= 8 and number(rng.normal(size=(5, 64))) == 2


# -- 2 personal data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


TRICKY = [
    "a@b.com_x@y.com a@b.com@c.com %a@b.co .@-.-", "1.2.3.4.5.6.7.8 0000256.1.1.1 000255.1.1.1", "4111-1111-1111-1111 4111 1111 1111 1112 " + "4" * 40, "+1 (614) 555-8001. +1+22 333 444 555 666 +123-",
    "🎉🎉 a@b.co 🎉 10.0.0.1", "a.a.a.a@b" + ".c" * 3000 + " x", "1 " * 4000, "a" * 100_000, "iban DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432 or GB82WEST12345698765431", "ssn 123-45-6789 and 000-45-6789",
    "token = bed4d44cf2780ed3ef0cb916120773181bc8de67 or bed4d44cf2780ed3ef0cb916120773181bc8de68",
]


def test_pii_spans(spark, docs, texts, odd, empty):
    for frame, own in ((docs, texts), (spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string"), dict(enumerate(TRICKY)))):
        got = rows(pii.report(frame))
        for i, text in own.items():
            want = base_spans(text)
            assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), (i, want, got[i]["spans"])
            assert [got[i][f"n_{k}"] for k in BASE] == [sum(s.startswith(k + ":") for s in want) for k in BASE]
    assert "iban:5:32,iban:37:59" in got[8]["spans"] and got[8]["n_added"] == 2
    assert got[9]["spans"].endswith("ssn:4:15") and "secret:8:48" in got[10]["spans"]
    assert sorted(map(str, [r["doc_id"] for r in pii.report(odd).collect()])) == sorted(str(i) for i, _ in ODD)
    assert pii.report(empty).count() == 0


def test_pii_mask(spark, odd):
    got = {r["doc_id"]: r["text"] for r in pii.mask(odd).collect()}
    assert got[1] == "The cat sat. Mail me: [EMAIL] or [PHONE] now" and got[3] is None and got[2] == "" and got[6] == "same text here"
    assert got[11] == "[CARD] and 10.0.0.256 and [IP]"
    assert pii.mask(odd).columns == odd.columns and {r[0] for r in pii.mask(odd).select("spans").collect()} == {"x"}


# -- 3 quality

def test_quality_held_out(spark, sf_dir):
    sf = sf_dir.replace("sf0.001", "sf0.01")
    out = rows(queries.op3_quality_classifier(spark, sf))
    right = total = 0
    for r in spark.read.parquet(f"{sf}/labels.parquet").collect():
        if r["doc_id"] in out and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
            assert out[r["doc_id"]]["held_out"]
            total += 1
            right += out[r["doc_id"]]["predicted"] == r["quality"]
    assert total > 40 and right / total >= 0.93, (right, total)
    assert all(0 <= r["score"] <= 1 for r in out.values())


def test_quality_hard_tables(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (5, 0), (2, None), (99, 1), (6, 7), (7, 1)], "doc_id long, quality int")
    assert quality.quality_report(odd, labels).count() == len(ODD)
    assert quality.quality_report(odd, labels.limit(0)).where("score = 0.5").count() == len(ODD)
    assert quality.quality_report(empty, labels).count() == 0


def test_ratios_and_fit_against_plain_version(spark, docs, texts, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    known = {r["doc_id"]: r["quality"] for r in labels.collect() if r["doc_id"] in texts and zlib.crc32(str(r["doc_id"]).encode()) % 5}
    ratio, model = quality.fit(docs, labels)
    counts = np.zeros((2, quality.SPACE))
    for i, q in known.items():
        counts[q, list(set(quality.indicators(texts[i]).tolist()))] += 1
    p, q = counts[1] + 1, counts[0] + 1
    assert np.allclose(ratio, np.log((p / p.sum()) / (q / q.sum())))
    # The fit is the optimum: no plain subgradient step from the plain dual's best value gets lower.
    rows = [quality.indicators(texts[i]) for i in known]
    y = np.array([1 if v else -1 for v in known.values()])
    w, b = quality.dual_coordinate_descent(rows, y, ratio, epochs=400)
    x = np.zeros((len(rows), quality.SPACE + 1))
    for k, r in enumerate(rows):
        x[k, r] = ratio[r] / np.linalg.norm(ratio[r])
        x[k, -1] = 1.0
    share = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum()))
    value = lambda v: v @ v / 2 + (share * np.maximum(0, 1 - y * (x @ v))).sum()
    best = np.append(w, b)
    plain = np.zeros(len(best))
    for t in range(1, 3000):
        active = (1 - y * (x @ plain)) > 0
        plain -= (plain - ((share * y * active) @ x)) / (t + 10)
    assert value(best) <= value(plain) * 1.001
    out = {r["doc_id"]: r["score"] for r in quality.score(docs, ratio, model).collect()}
    for i, t in list(texts.items())[:40]:
        at = quality.indicators(t)
        m = model.weights[at].sum() / (np.linalg.norm(ratio[at]) or 1.0) + model.intercept
        assert out[i] == pytest.approx(1 / (1 + math.exp(-(model.slope * m + model.shift))), rel=1e-6)


def test_indicators_brute_force():
    text = "ab ab ab ab cd ab cd"
    data = text.encode()
    want = {(((data[i] | data[i + 1] << 8 | data[i + 2] << 16) * 2654435761) & 0xFFFFFFFF) >> 16 for i in range(len(data) - 2)}
    words, marks = text.split(), []
    for k, w in enumerate(words):
        marks.append(1 if k and w == words[k - 1] else 2 if k > 1 and w == words[k - 2] else 0)
    for k in range(len(marks) - 3):
        code = marks[k] + 3 * marks[k + 1] + 9 * marks[k + 2] + 27 * marks[k + 3] + (1 << 24)
        want.add(((code * 2654435761) & 0xFFFFFFFF) >> 16)
    assert quality.indicators(text).tolist() == sorted(want)


# -- 4 SentencePiece

@pytest.fixture(scope="module")
def sp_model():
    return queries.tokenizer_file("piece_bpe_32k.model")


def best_score(model, word):
    """Best total score over all cuts, by exhaustive recursion over character positions."""
    table = {p: s for p, s, k in model.pieces if k == "normal"}
    best = [0.0] + [-math.inf] * len(word)
    for j in range(1, len(word) + 1):
        for i in range(j):
            if word[i:j] in table:
                best[j] = max(best[j], best[i] + table[word[i:j]])
        if word[j - 1] not in table:
            best[j] = max(best[j], best[j - 1] + model.low)
    return best[-1]


def test_unigram_against_brute_force(spark, docs, sp_model, texts):
    model = unigram.Unigram(unigram.load_pieces(sp_model))
    seen = {w for t in list(texts.values())[:40] for w in t[:300].split()} | {"日本", "naïve🎉", "x\ny", ""}
    for word in seen:
        ids = model.segment(unigram.MARK + word)
        raw = b"".join(model.bytes_of[i] for i in ids).decode()
        assert raw == unigram.MARK + word
        if all(model.pieces[i][2] == "normal" for i in ids):
            assert sum(model.scores[i] for i in ids) == best_score(model, unigram.MARK + word)
    out = unigram.round_trip_report(docs, sp_model).collect()
    assert len(out) == len(texts) and all(r["round_trip"] for r in out)
    for r in [r for r in out if len(texts[r["doc_id"]]) < 3000][:60]:
        # A text is its words (a marker for every space, line feeds alone), each cut on its own by a plain search.
        ids = [i for w in re.findall(f"{unigram.MARK}+[^{unigram.MARK}\n]*|\n|[^{unigram.MARK}\n]+", unigram.MARK + texts[r["doc_id"]].replace(" ", unigram.MARK)) for i in model.segment(w)]
        assert (r["n_tokens"], r["n_bytes"]) == (len(ids), sum(model.pieces[i][2] == "byte" for i in ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes()) and r["score"] == pytest.approx(sum(model.scores[i] for i in ids))


def test_unigram_very_long_word(sp_model, monkeypatch):
    model, word = unigram.Unigram(unigram.load_pieces(sp_model)), unigram.MARK + "abcé日x" * 300
    plain = model.segment(word)
    monkeypatch.setattr(unigram, "LONG", 100)
    assert model.segment(word) == plain and b"".join(model.bytes_of[i] for i in plain).decode() == word


def test_unigram_hard_tables(odd, empty, sp_model):
    out = unigram.round_trip_report(odd, sp_model)
    assert out.count() == len(ODD) and out.where("round_trip").count() == len(ODD)
    assert unigram.round_trip_report(empty, sp_model).count() == 0
    back = unigram.decode(unigram.encode(odd, sp_model), sp_model).collect()
    assert sorted(r["text"] for r in back) == sorted(t or "" for _, t in ODD)


def test_double_array_finds_every_prefix():
    keys = {b"a": 1, b"ab": 2, b"abc": 3, b"b": 4, "é".encode(): 5, b"abd": 6}
    trie = unigram.DoubleArray(keys)
    assert list(trie.prefixes(b"abcd", 0)) == [(1, 1), (2, 2), (3, 3)] and list(trie.prefixes(b"xabd", 1)) == [(2, 1), (3, 2), (4, 6)]
    assert list(trie.prefixes("é".encode(), 0)) == [(2, 5)] and not list(trie.prefixes(b"zz", 0))


# -- 5 fingerprints

def plain(text):
    return " ".join(unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold()).split()).encode()


def test_fingerprints_against_brute_force(docs, texts, odd, empty):
    out = rows(fingerprint.edit_report(docs))
    order = sorted(texts, reverse=True)
    for i, following in zip(order, order[1:] + order[:1]):
        half = len(texts[i]) // 2
        changed = texts[i][: len(texts[i]) - half] + texts[following][:half]
        r = out[i]
        assert r["n_chars"] == len(texts[i]) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["fingerprint"] == xxhash.xxh3_128_hexdigest(plain(texts[i])) and r["edited_fingerprint"] == xxhash.xxh3_128_hexdigest(plain(changed))
        assert r["near_edited"] == float(plain(texts[i]) == plain(changed)) and r["near_next"] == float(plain(texts[i]) == plain(texts[following]))
    hard = fingerprint.edit_report(odd).collect()
    assert len(hard) == len(ODD)
    prints = defaultdict(set)
    for r in hard:
        prints[r["fingerprint"]].add(r["doc_id"])
    assert {6, 7} in prints.values() and {9, 10} in prints.values() and {2, 3, 4} in prints.values()
    assert fingerprint.edit_report(empty).count() == 0


def test_fingerprint_collisions_are_told_apart(spark):
    data = [(1, "aa"), (2, "ab"), (3, "AA"), (4, "b"), (5, "ac"), (7, "ad"), (7, "ae"), (None, "af")]
    weak = lambda body: body[:1].hex()
    found = fingerprint.edit_report(spark.createDataFrame(data, "doc_id long, text string"), hasher=weak).collect()
    assert len(found) == len(data) and len({r["fingerprint"] for r in found}) == 7  # all but AA, which is aa
    out = {r["doc_id"]: r for r in found}
    nulls = rows(fingerprint.edit_report(spark.createDataFrame([(1, "aa"), (None, "ab")], "doc_id long, text string"), hasher=weak))
    assert nulls[1]["fingerprint"] != nulls[None]["fingerprint"] and nulls[1]["near_next"] == nulls[None]["near_next"] == 0.0
    assert out[1]["fingerprint"] == out[3]["fingerprint"] != out[2]["fingerprint"] != out[5]["fingerprint"] and out[4]["fingerprint"] == "62"
    assert out[3]["near_next"] == 0.0


# -- 6 sharding

def test_shards(spark, docs, texts, odd, empty):
    out = queries.op6_sharding(spark, docs._jdf and docs.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")).collect()
    by = defaultdict(list)
    for r in out:
        by[r["shard"]].append(r["slot"])
        assert r["size"] == len(texts[r["doc_id"]].encode()) + 16 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
    assert sorted(by) == list(range(40)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1 and sorted(r["doc_id"] for r in out) == sorted(texts)
    assert [r["doc_id"] for r in sorted(out, key=lambda r: (r["shard"], r["slot"]))] != sorted(texts)
    hard = spark.read.parquet(shards.write_shards(odd, 4, bucket_bytes=2000))
    assert set(hard.columns) == {*odd.columns, "slot"} and hard.count() == len(ODD)
    assert shards.shard_report(empty, 4).count() == 0


def test_shards_depend_on_rows_and_seed_only(spark, docs):
    place = lambda d, s: {(r["doc_id"], r["shard"], r["slot"]) for r in shards.shard_report(d, 7, s).collect()}
    assert place(docs, 1) == place(docs.repartition(5), 1) != place(docs, 2)
    copies = spark.createDataFrame([(1, "copy" * 100)] * 400 + [(i, f"t{i}") for i in range(2, 50)], "doc_id long, text string")
    counted = lambda d: Counter((r["doc_id"], r["shard"]) for r in spark.read.parquet(shards.write_shards(d, 3, bucket_bytes=4000)).collect())
    split = [counted(copies.coalesce(1)), counted(copies.repartition(7))]
    assert split[0] == split[1] and min(split[0][1, k] for k in range(3)) > 20
    named = copies.limit(9).selectExpr("*", "'a' as tie", "1 as nth", "2 as part", "3 as bucket", "4 as kind", "5 as first", "6 as inside_")
    kept = spark.read.parquet(shards.write_shards(named, 3))
    assert {tuple(r) for r in kept.select("tie", "nth", "part", "bucket", "kind", "first", "inside_").collect()} == {("a", 1, 2, 3, 4, 5, 6)}
    out = spark.read.parquet(shards.write_shards(copies, 3, bucket_bytes=4000)).collect()
    assert Counter(r["shard"] for r in out) == {0: 150, 1: 149, 2: 149} and sum(r["doc_id"] == 1 for r in out) == 400


# -- 7 language model

def test_lm_base_score_and_held_out(spark, docs, texts, odd, empty):
    out = rows(mixing.score_report(docs))
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)), None] for i, t in texts.items()}
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 7 == 2}
    counts = Counter(w for i, ws in tokens.items() if i not in held for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in tokens.items():
        r = out[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i in held, len(ws), sum(counts[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), rel=1e-9)
        assert r["score"] < 0
    # Held-out texts take fewer bits than by the byte before alone, with the true shares of pairs in the training texts.
    pairs, firsts = Counter(), Counter()
    for i, t in texts.items():
        if i not in held:
            own = (b"\n" + t.encode().lower() + b"\n")
            pairs.update(zip(own, own[1:]))
            firsts.update(own[:-1])
    plain = sum(math.log10((pairs[p] + 1) / (firsts[p[0]] + 257)) for i in held for own in [b"\n" + texts[i].encode().lower() + b"\n"] for p in zip(own, own[1:]))
    assert sum(out[i]["score"] for i in held) > 0.85 * plain
    hard = mixing.score_report(odd).collect()
    assert len(hard) == len(ODD) and len({r["score"] for r in hard if r["doc_id"] in (6, 7)}) == 1
    assert mixing.score_report(empty).count() == 0


def small_model(texts):
    """A chunk of texts, its arrays, and a learner that has seen it."""
    chunk, pairs = mixing.Chunk(), np.zeros(mixing.SYMBOLS**2, np.int64)
    for i, t in enumerate(texts):
        chunk.add(i, False, t)
        mixing.count_pairs(t, pairs)
    row = next(chunk.rows(0, 2))
    words, sizes, *arrays = mixing.opened(*(mixing._unpacked(row[k]) for k in (7, 4, 5, 6)))
    learner = mixing.Learner(mixing.build_codes(pairs.reshape(mixing.SYMBOLS, -1)))
    return words, sizes, arrays, learner


def drawn_texts(n=60, size=400):
    draw = np.random.default_rng(5)
    words = [bytes(draw.integers(97, 123, int(k)).tolist()) for k in draw.integers(1, 9, 300)]
    return [b" ".join(words[i] for i in draw.zipf(1.3, size) % 300) for _ in range(n)] + [b"", b" ", b"a\n\n b ", "é 日".encode() + bytes(range(256))]


def test_lm_is_a_distribution():
    """Probabilities of all next symbols add up to one in any context, as do those of the known words."""
    words, sizes, arrays, learner = small_model(drawn_texts())
    learner.learn(words, *arrays)
    model = mixing.Model(learner.codes, {(k, b): v for k, b, v in learner.pieces()})
    every = np.arange(mixing.SYMBOLS)
    for prev, three, word in ((97, 5, 7), (256, 0, 0), (32, 1 << 40, 3), (255, 9, 9)):
        full = [np.full(mixing.SYMBOLS, x, np.uint64) for x in (three, word)]
        head, rest = model.logs(*mixing._slots(learner.codes, np.full(mixing.SYMBOLS, prev), every, *full))
        assert np.exp(head + rest).sum() == pytest.approx(1, abs=1e-6)
        ends = np.isin(every, [*mixing.SPACES, mixing.EDGE])
        assert np.exp(rest[ends]).sum() == pytest.approx(1, abs=1e-6) and np.exp(rest[~ends]).sum() == pytest.approx(1, abs=1e-6)
    counts = np.bincount(arrays[0], minlength=len(words))
    counts[:2] = 0
    model.known_share, model.n_words = 0.4, int(counts.sum())
    assert (counts / model.n_words).sum() == pytest.approx(1)


def plain_score(model, text, counts):
    """log of a text's probability, one decision after the other."""
    mask, seps = (1 << 64) - 1, [*mixing.SPACES]
    power = [int(x) for x in mixing._POWER]

    def total(word):
        return sum((b + 1) * power[k] for k, b in enumerate(word)) & mask

    def path(prev, sym, three, word):
        code, out = prev * mixing.SYMBOLS + sym, []
        for k in range(int(model.codes.start[code]), int(model.codes.start[code] + model.codes.size[code])):
            node, bit = int(model.codes.node[k]), int(model.codes.bit[k])
            slots = [node]
            for key, bits in ((three, mixing.BITS[0]), (word, mixing.BITS[1])):
                context = (key * int(mixing._HASH[0]) & mask) >> 32
                slots.append((((context ^ (node * int(mixing._HASH[2]) & 0xFFFFFFFF)) * int(mixing._HASH[1])) & 0xFFFFFFFF) >> (32 - bits))
            odds = [float(t[i]) for t, i in zip(model.odds, slots)]
            gate = int(min(abs(odds[2]) * 1.6, 7)) * 8 + int(min(abs(odds[1]) * 1.6, 7))
            x = sum(float(model.weights[k][gate]) * o for k, o in enumerate(odds))
            p = (1 / (1 + math.exp(-x)) + float(model.map[gate * mixing.MAP + int((min(max(x, -7.99), 7.99) + 8.25) * 2)])) / 2
            p = min(max(p, 1e-6), 1 - 1e-6)
            out.append(math.log(p if bit else 1 - p))
        return out

    out, before, before_end, at = 0.0, None, mixing.EDGE, 0
    for word in re.split(rb"[\x20\x09-\x0D]", text):
        at += len(word) + 1
        end = text[at - 1] if at <= len(text) else mixing.EDGE
        last = [before[-k] if before and len(before) >= k else mixing.EDGE for k in (1, 2)]
        hashed = 0 if before is None else total(before) * int(mixing._HASH[0]) & mask
        first = path(before_end, word[0] if word else end, before_end | last[0] << 9 | last[1] << 18 | 1 << 40, (hashed + before_end * 0x2545F4914F6CDD1D) & mask)
        if word:
            inside, after = sum(first[1:]), 0.0
            for k in range(1, len(word) + 1):
                seen = [word[k - j] if k >= j else mixing.EDGE for j in (1, 2, 3)]
                own = path(word[k - 1], word[k] if k < len(word) else end, seen[0] | seen[1] << 9 | seen[2] << 18, total(word[:k]))
                inside += own[0] if k == len(word) else sum(own)
                after = sum(own[1:])
            share = counts.get(word, 0) / max(1, model.n_words)
            out += first[0] + math.log(model.known_share * share + (1 - model.known_share) * math.exp(inside)) + after
        else:
            out += sum(first)
        before, before_end = word, end
    return out


def test_lm_score_against_plain_version():
    texts = drawn_texts(20, 60)
    words, sizes, arrays, learner = small_model(texts)
    learner.learn(words, *arrays)
    counts = np.bincount(arrays[0], minlength=len(words))
    counts[:2] = 0
    counts[5:40] = 0  # as if never seen in training
    model = mixing.Model(learner.codes, {(k, b): v for k, b, v in learner.pieces()}, 0.4, int(counts.sum()))
    got = np.add.reduceat(model.score(words, *arrays, counts), np.cumsum(sizes) - sizes)
    listed = bytes(words.data).split(b"\n")
    named = {listed[i]: int(n) for i, n in enumerate(counts) if n}
    for t, g in zip(texts, got):
        assert g == pytest.approx(plain_score(model, t, named), rel=2e-3, abs=2e-3)


def test_lm_mixer_and_map_take_every_decision():
    """Counts, weights and map equal a plain pass over all decisions, each weighted by how often its word occurs."""
    words, sizes, arrays, learner = small_model(drawn_texts())
    counts = [np.zeros((n, 2)) for n in mixing.table_sizes()]
    weights, scale, seen = np.full((mixing.GATES, 3), 1 / 3), np.ones((mixing.GATES, 3)), np.zeros((mixing.GATES, mixing.MAP, 2))
    total = 0
    for slots, bit, times in learned_blocks(learner.codes, words, arrays):
        odds = [np.log((c[k, 1] + mixing.PRIOR) / (c[k, 0] + mixing.PRIOR)).astype(np.float32) for c, k in zip(counts, slots)]
        gate = mixing._gate(odds)
        x = sum(weights[gate, k] * o for k, o in enumerate(odds))
        error = (bit - 1 / (1 + np.exp(-x))) * times
        for k, o in enumerate(odds):
            step = np.bincount(gate, error * o, mixing.GATES)
            scale[:, k] += step * step
            weights[:, k] += 0.3 * step / np.sqrt(scale[:, k])
        np.add.at(seen, (gate, mixing._bucket(x), bit), times)
        for c, k in zip(counts, slots):
            np.add.at(c, (k, bit), times)
        total += times.sum()
    learner.learn(words, *arrays)
    assert learner.seen == learner.map[:, 0].sum() == total
    assert all((own.reshape(-1, 2) == c).all() for own, c in zip(learner.counts, counts))
    assert np.allclose(learner.weights, weights, atol=1e-3)
    got = learner.map.reshape(mixing.GATES, mixing.MAP, 2)
    assert np.abs(got[..., 0] - seen.sum(-1)).sum() < total / 100  # rounding moves few decisions to the next bucket
    assert got[..., 1].sum() == seen[..., 1].sum()


def learned_blocks(codes, words, arrays):
    """Decisions of all words, in the order of the learner's slices: what occurs twice in a slice comes once with its number."""
    at, slices = 0, 0
    while at < len(arrays[0]):
        to = at + (1 << 12 + slices)
        ids, ends, before, before_end = (x[at:to] for x in arrays)
        seen = Counter((int(i), int(e)) for i, e in zip(ids, ends) if words.size[i])
        order = sorted(seen, key=lambda k: (k[0], int(mixing._NUMBER[k[1]])))
        times = np.array([seen[k] for k in order])
        for own, prev, sym, three, run, _ in mixing.word_blocks(words, *(np.array(x) for x in zip(*order))):
            slots, bit, first = mixing._slots(codes, prev, sym, three, run)
            yield slots, bit, np.repeat(times[own], np.diff(np.append(first, len(bit))))
        for k in range(0, len(ids), mixing.BLOCK_SYMBOLS):
            slots, bit, _ = mixing.word_starts(codes, words, *(x[k : k + mixing.BLOCK_SYMBOLS] for x in (ids, ends, before, before_end)))
            yield slots, bit, np.ones(len(bit))
        at, slices = to, slices + 1


def test_lm_one_very_long_word():
    """A word far above PART is evaluated in parts, and each of its symbols once."""
    words, sizes, arrays, learner = small_model([b"x" * 50_000 + b" y", b"ab" * 3000])
    n = sum(len(own) for own, *_ in mixing.word_blocks(words, arrays[0][words.size[arrays[0]] > 0], arrays[1][words.size[arrays[0]] > 0]))
    assert n == 50_000 + 1 + 6000
    learner.learn(words, *arrays)
    model = mixing.Model(learner.codes, {(k, b): v for k, b, v in learner.pieces()})
    assert (model.score(words, *arrays, np.zeros(len(words))) < 0).all()



def test_lm_equal_contexts_are_evaluated_once():
    """Learning evaluates what is equal inside a block once, with its number; scoring what is equal inside a chunk."""
    words, sizes, arrays, learner = small_model([b"one two two\none " * 3000, b"two one\n" * 3000, b"", b" "])
    lengths, step = [], learner._step
    learner._step = lambda slots, bit, times: (lengths.append(len(bit)), step(slots, bit, times))
    learner.learn(words, *arrays)
    assert learner.seen > 50_000 and sum(lengths) < 1000
    model = mixing.Model(learner.codes, {(k, b): v for k, b, v in learner.pieces()})
    symbols, logs = [], model.logs
    model.logs = lambda slots, bit, first: (symbols.append(len(first)), logs(slots, bit, first))[1]
    whole = model.score(words, *arrays, np.zeros(len(words)))
    assert sum(symbols) < 50
    at = int(sizes[0])  # the same scores as for a part of the words
    assert (model.score(words, *(x[at:] for x in arrays), np.zeros(len(words))) == whole[at:]).all()


def test_lm_chunk_against_plain_split():
    texts = [b"", b"a b a", b" lead", b"trail ", b"tab\tnew\n\x0b\x0c\r x", "\x00 é 日本 \x1c\x85\xa0".encode(), b"  ", b"a\n", b"", bytes(range(256)) * 3, b"\xff\xfe b"]
    chunk = mixing.Chunk()
    for i, t in enumerate(texts):
        chunk.add(i, i % 3 == 0, t)
    ids, ends, sizes, blob = chunk.encoded()
    named, want, after, n = {b" ": 0, b"": 1}, [], [], []
    for t in texts:
        parts = re.split(rb"[\t-\r ]", t)
        want += [named.setdefault(w, len(named)) for w in parts]
        after += [*re.findall(rb"[\t-\r ]", t), b"\0"]
        n.append(len(parts))
    assert ids.tolist() == want and ends.tobytes() == b"".join(after) and sizes.tolist() == n
    assert blob == b"".join(w + b"\n" for w in named)
    counts = Counter(w for i, t in enumerate(texts) if i % 3 for w in re.split(rb"[\t-\r ]", t))
    got = {}
    for _, r, _, _, body, own, times, _ in list(chunk.rows(0, 3))[1:]:
        listed = mixing._unpacked(body).split(b"\n")
        assert [named[w] for w in listed] == mixing._from_planes(mixing._unpacked(own), "<u4").tolist()
        got |= dict(zip(listed, mixing._from_planes(mixing._unpacked(times), "<u4").tolist()))
    assert got == {w: counts[w] for w in named if w not in (b" ", b"")} | {b" ": sum(1 for i in range(len(texts)) if i % 3)}


# -- 8 SimHash

def brute_simhash(text, size=3, lanes=1):
    """A fingerprint as one number; the lanes after the first come from the mixed hash."""
    ws = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
    grams = [b" ".join(ws[i : i + size]) for i in range(len(ws) - size + 1)] if len(ws) >= size else ([b" ".join(ws)] if ws else [])
    hs, out, mask = [xxhash.xxh64_intdigest(g, 42) for g in grams], 0, (1 << 64) - 1
    for lane in range(lanes):
        own = hs
        if lane:
            own = []
            for h in hs:
                z = h + lane * 0x9E3779B97F4A7C15 & mask
                z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 & mask
                z = (z ^ z >> 27) * 0x94D049BB133111EB & mask
                own.append(z ^ z >> 31)
        out |= sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in own) > len(own)) << (64 * lane)
    return out


@pytest.mark.parametrize("size,lanes", [(3, 1), (5, 4)])
def test_simhash_bits(size, lanes, texts):
    for text in [*list(texts.values())[:25], "", "one", "a b c d e", "x y " * 9000]:
        assert [int(x) for x in simhash.simhash(text, size, 42, lanes)] == [brute_simhash(text, size, lanes) >> 64 * k & (1 << 64) - 1 for k in range(lanes)]


@pytest.mark.parametrize("radius,agree,wide,tile", [(9, 2, 40, 2048), (9, 2, 40, 8), (4, 1, None, 16), (3, 2, 12, 64)])
def test_links_of_wide_fingerprints(spark, radius, agree, wide, tile):
    """Every pair within both distances is connected, and nothing else."""
    rng = np.random.default_rng(9)
    base = rng.integers(0, 2, (12, 256))
    rows = [b ^ (rng.random(256) < share) for b in base for share in (0, 0.02, 0.05, 0.09, 0.14, 0.2, 0.01)] + list(rng.integers(0, 2, (40, 256)))
    fps = [int("".join(map(str, r.astype(int))), 2) for r in rows]
    lanes = lambda f: [int(np.array(f >> 64 * k & (1 << 64) - 1, np.uint64).view(np.int64)) for k in range(4)]
    near = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= radius and (wide is None or (a ^ b).bit_count() <= wide)
    want = groups(range(len(fps)), [(a, b) for a in range(len(fps)) for b in range(a) if near(fps[a], fps[b])])
    frame = spark.createDataFrame([(*lanes(f), i) for i, f in enumerate(fps)], "fp long, fp1 long, fp2 long, fp3 long, rep long")
    got = {r["node"]: r["component"] for r in connected_components(simhash.link_edges(frame, radius, tile, agree, wide)).collect()}
    assert {i: got.get(i, i) for i in range(len(fps))} == want and len(set(want.values())) < len(fps) - 20


@pytest.mark.parametrize("tile", [2048, 4])
def test_simhash_against_brute_force(spark, docs, texts, tile):
    fps = {i: brute_simhash(t) for i, t in texts.items()}
    edges = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 3]
    low = groups(fps, edges)
    out = rows(simhash.near_duplicates(docs, tile=tile))
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in out.items()} == {i: (f"{fps[i]:016x}", low[i]) for i in fps}
    assert all(r["kept"] == (i == low[i]) for i, r in out.items())


def test_simhash_hard_tables(odd, empty):
    out = simhash.near_duplicates(odd).collect()
    assert len(out) == len(ODD)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in out}
    assert got[2] == got[3] == got[4] == ("0" * 16, 2) and got[7][1] == 6 and got[None][1] is None
    assert simhash.near_duplicates(empty).count() == 0


def near_texts():
    """Two texts whose fingerprints differ, but by 3 bits or fewer."""
    for n in range(300, 400):
        base = " ".join(f"w{i}" for i in range(n))
        if 1 <= (brute_simhash(base) ^ brute_simhash(base + " more")).bit_count() <= 3:
            return base, base + " more"
    raise AssertionError("none found")


def test_simhash_null_ids_link_and_bridge(spark):
    """Rows without an id get near links, and connect others that are too far from each other."""
    fps = [0, 7, 7 | 7 << 10]  # 3 bits, then 3 more
    classes = simhash.components(spark.createDataFrame([(4, fps[0]), (None, fps[1]), (9, fps[2]), (None, -1)], "doc_id long, fp long")).collect()
    assert {r["fp"]: r["component_id"] for r in classes} == {fps[0]: 4, fps[1]: 4, fps[2]: 4, -1: None}
    assert len({r["part"] for r in classes}) == 2
    one, near = near_texts()
    out = simhash.near_duplicates(spark.createDataFrame([(4, one), (None, near), (None, "all else")], "doc_id long, text string")).collect()
    assert sorted(str(r["component_id"]) for r in out) == ["4", "4", "None"]


def test_near_duplicate_stage_keeps_one_row_a_component(spark):
    import corpus_pipeline

    one, near = near_texts()
    frame = spark.createDataFrame([(4, one, 1), (4, one, 1), (None, one, 2), (None, near, 3), (None, "all else", 4), (None, "all else", 4), (8, "third text", 5), (8, "fourth one here", 6)], "doc_id long, text string, n_chars long")
    kept = corpus_pipeline.near_duplicate_removal(spark, frame, "")
    assert kept.columns == frame.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect()) == sorted([("4", one), ("None", "all else"), ("8", "third text"), ("8", "fourth one here")])


def test_simhash_dense_group(spark):
    """Fingerprints of one dense group over many tiles: one component, few edges."""
    rng = np.random.default_rng(1)
    base = int(rng.integers(0, 2**62))
    fps = sorted({base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 62, (600, 2))})
    frame = spark.createDataFrame([(f, i) for i, f in enumerate(fps)], "fp long, rep long")
    edges = simhash.link_edges(frame, tile=32)
    want = groups(range(len(fps)), [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3])
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert {i: got.get(i, i) for i in range(len(fps))} == want


# -- 9 packing and 10 token files

def reference_ids(name, texts, end):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_file(name))
    return {i: t.encode(x, add_special_tokens=False).ids + [end] for i, x in texts.items()}


def test_packing_against_reference(spark, docs, texts):
    ids = reference_ids("byte_bpe_50k.json", texts, 0)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in packing.pack_documents(docs, queries.tokenizer_file("byte_bpe_50k.json")).collect():
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    total = 0
    for i, own in ids.items():
        at, total = 0, total + len(own)
        pieces = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces))) and all(r["length"] == 2048 for r in pieces[1:])
        for r in pieces:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(np.array(own[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(own) and (len(pieces) == 1 or len(own) > 2048)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by_sequence) <= best_fit_decreasing(Counter(r["length"] for own in by_doc.values() for r in own))


def best_fit_decreasing(counts):
    free, bins = [], 0
    for length in sorted(counts.elements(), reverse=True):
        fits = [r for r in free if r >= length]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - length)
        else:
            bins += 1
            free.append(2048 - length)
    return bins


def test_packing_plans():
    rng = np.random.default_rng(2)
    for low, high, size in ((1, 2048, 4000), (600, 1100, 3000), (683, 690, 500), (1, 20, 900), (300, 1500, 300), (1000, 1100, 777), (2048, 2048, 5)):
        counts = Counter(rng.integers(low, high + 1, size).tolist())
        runs, n = packing.plan(dict(counts))
        rooms, seen = defaultdict(list), Counter()
        for length, rank, items, first, each, offset in runs:
            assert rank == seen[length]
            seen[length] += items
            for j in range(items):
                rooms[first + j // each].append((offset + j % each * length, length))
        assert seen == counts and sorted(rooms) == list(range(n))
        assert n <= best_fit_decreasing(counts)
        for parts in rooms.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 2048
    assert packing.plan({}) == ([], 0)


def test_packing_hard_tables(odd, empty):
    out = packing.pack_documents(odd, queries.tokenizer_file("byte_bpe_50k.json")).collect()
    assert sum(r["start"] == 0 for r in out) == len(ODD)
    assert packing.pack_documents(empty, queries.tokenizer_file("byte_bpe_50k.json")).count() == 0


def test_token_files_against_reference(spark, docs, texts, odd, empty):
    ids = reference_ids("word_bpe_49k.json", texts, 1)
    manifest = tokenbin.write_token_files(docs, queries.tokenizer_file("word_bpe_49k.json"), 1, length=64)
    out = rows(tokenbin.read_token_files(spark, manifest))
    at = 0
    for i in sorted(ids):
        r = out[i]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids[i]), zlib.crc32(np.array(ids[i], "<u4").tobytes()))
        at += len(ids[i])
    parts = [tokenbin.TokenFile(r["folder"], r["name"]) for r in manifest.orderBy("bucket").collect()]
    first = parts[0].sequence(0)
    assert first[0].tolist() == [x for i in sorted(ids) for x in ids[i]][:64] and first[1].all() and not first[0].flags.owndata
    hard = tokenbin.read_token_files(spark, tokenbin.write_token_files(odd, queries.tokenizer_file("word_bpe_49k.json"), 1))
    assert hard.count() == len(ODD)
    assert tokenbin.read_token_files(spark, tokenbin.write_token_files(empty, queries.tokenizer_file("word_bpe_49k.json"), 1)).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_piece_encoder_equals_the_library(name):
    from hypothesis import given, settings
    from hypothesis import strategies as st
    from tokenizers import Tokenizer

    path = queries.tokenizer_file(name)
    own, library = PieceEncoder(path, limit=20), Tokenizer.from_file(path)

    def same(text):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)

    for text in ["", " ", "  a", "a ", "a  b", "a \n b", "\n\na", "it's they'll 've", "é ́x", "ΑΣ ΑΣ. Σ", "a\x1c b\x85 c", "a\x00b \x00c", "x <|endoftext|> y", "a\xa0b c", "a_b,*** !!", "İI ı"]:
        same(text)
    settings(max_examples=150, deadline=None)(given(st.text(st.sampled_from(list("ab Éß.,!'s\n\t0日 \x00")), max_size=30))(same))()


# -- the pipeline

def test_pipeline_against_stages(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    first = corpus_pipeline.quality_filter(spark, docs, sf_dir)
    assert first.columns == docs.columns
    good = {r["doc_id"] for r in queries.op3_quality_classifier(spark, sf_dir).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in first.collect()} == good
    second = corpus_pipeline.near_duplicate_removal(spark, first, sf_dir)
    fps = {i: brute_simhash(texts[i], corpus_pipeline.WORDS, corpus_pipeline.LANES) for i in good}
    near = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= corpus_pipeline.NEAR and (a ^ b).bit_count() <= corpus_pipeline.WIDE
    sets = {i: set(simhash.shingle_hashes(texts[i], corpus_pipeline.WORDS).tolist()) for i in good}
    alike = lambda a, b: bool(sets[a]) and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    low = groups(fps, [(a, b) for a in fps for b in fps if a < b and (near(fps[a], fps[b]) or alike(a, b))])
    assert {r["doc_id"] for r in second.collect()} == set(low.values())
    third = corpus_pipeline.personal_data_masking(spark, second, sf_dir)
    assert third.columns == docs.columns
    for r in third.collect():
        assert not base_spans(r["text"]) and r["n_chars"] == len(r["text"])
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in out} == set(low.values())


def test_pipeline_stages_on_hard_tables(spark, odd, empty, sf_dir):
    import corpus_pipeline

    for frame in (odd, empty):
        frame = frame.withColumn("n_chars", frame["rep"]).selectExpr("*", "1 as row", "'k' as `order`", "2 as fp0", "3 as hot_")
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, sf_dir)
            out.count()
        for stage in (corpus_pipeline.quality_filter, corpus_pipeline.near_duplicate_removal, corpus_pipeline.personal_data_masking):
            kept = stage(spark, frame, sf_dir)
            assert kept.columns == frame.columns
            assert {tuple(r) for r in kept.select("score", "row", "order", "fp0", "hot_", "spans").collect()} <= {(0.5, 1, "k", 2, 3, "x")}
