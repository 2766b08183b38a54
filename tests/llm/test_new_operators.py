"""Phrases, conversation repair and source mixing against plain versions, and on hard small tables."""

import hashlib
import heapq
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from parchmill.llm import collocations, mixture, repair
from parchmill.llm.transducer import Transducer, sorted_sums, union

# ---- phrases


def plain_collocations(docs, least, longest, top):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f = defaultdict(Counter)
    for lang, text in docs:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(fold)):
            words = re.findall("[^ \t]+", piece)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f["und" if lang is None else lang][tuple(words[i : i + m])] += 1
    out = []
    for lang, counts in f.items():
        n = sum(c for p, c in counts.items() if len(p) == 1)
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = {g[i : i + m] for g, a in candidates.items() for m in range(2, len(g)) for i in range(len(g) - m + 1) if counts[g[i : i + m]] == a}
        best = []
        for p, a in candidates.items():
            if p not in inside:
                score, k = min((1000 * a * n // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]], n))
        for rank, (s, a, p, left, right, n) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


@pytest.mark.parametrize("least,longest,top,shard,words", [(3, 5, 50, 2000, 3000), (2, 4, 10**6, 1 << 20, 10**6), (5, 2, 30, 500, 500)])
def test_collocations_against_brute_force(spark, sf_dir, least, longest, top, shard, words):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 60")
    got = collocations.collocations(docs.repartition(3), least, longest, top, shard_bytes=shard, range_words=words).collect()
    assert sorted(map(tuple, got)) == plain_collocations([(r["lang"], r["text"]) for r in docs.collect()], least, longest, top)


def test_collocations_hard_tables(spark, monkeypatch):
    rows = [
        (None, "A b A b a b. a\tb, a b"), ("en", None), ("en", ""), ("en", "x " * 3000), ("en", "\x0bné né\nné né né né"), ("zz", "one"), ("de", ". ! ?"),
        ("en", "tie one tie two tie one tie two"), ("en", "the same row again"), ("en", "the same row again"), ("fr", "\x1cfoo bar foo \x00 foo \x00"), ("fr", "Éa Éa"),
    ]
    docs = spark.createDataFrame([(l, t, 1, 2) for l, t in rows], "lang string, text string, word long, label long")
    want = plain_collocations(rows, 2, 5, 2000)
    for shard in (1, 1 << 20):
        assert sorted(map(tuple, collocations.collocations(docs, 2, shard_bytes=shard, range_words=50).collect())) == want
    assert collocations.collocations(docs.limit(0)).collect() == []
    # Labels that collide are found, and other hashes are taken.
    first = collocations.xxhash.xxh64_intdigest

    class Weak:
        xxh64_intdigest = staticmethod(lambda w, seed=9: first(w, seed) % 4 if seed == 0 else first(w, seed))

    monkeypatch.setattr(collocations, "xxhash", Weak)
    labels = collocations.Shards(0, 100)._shard("en", [b"some words that share few labels"])[1]
    assert len(set(labels.tolist())) < 6


def test_transducers():
    rng = np.random.default_rng(5)
    parts, counts = [], Counter()
    for _ in range(4):
        rows = rng.integers(1, 6, (500, 4)).astype(np.uint64) << np.uint64(40)
        for r, m in zip(rows, rng.integers(1, 5, 500)):
            r[m:] = 0
        for r in rows.tolist():
            words = tuple(w for w in r if w)
            counts.update(words[:m] for m in range(1, len(words) + 1))
        distinct, sums = sorted_sums(rows, np.ones(500, np.int64))
        built = Transducer.build(distinct, sums)
        again = Transducer.unpack(built.pack())
        assert all((a == b).all() for a, b in zip(again.rows(), (distinct, sums)))
        parts.append(again)
    rows, sums = union(parts, at_most=100)
    whole = Transducer.build(rows, sums)
    assert {p: whole.weight(list(p)) for p in counts} == dict(counts) and whole.weight([3]) == 0
    assert sum(len(layer[1]) for layer in whole.layers) < len(counts)  # equal states are shared
    assert len(Transducer.build(rows[:0], sums[:0]).rows()[0]) == 0


# ---- conversation repair

START, AFTER_S, AFTER_U, AFTER_A = range(4)


def cheapest(rows):
    """(cost, letters, lines) by a uniform search over (row, state), rows being (role, text, fault)."""
    keep = {("s", START): AFTER_S, ("u", START): AFTER_U, ("u", AFTER_S): AFTER_U, ("u", AFTER_A): AFTER_U, ("a", AFTER_U): AFTER_A}
    write = {START: ("user", AFTER_U), AFTER_S: ("user", AFTER_U), AFTER_U: ("assistant", AFTER_A), AFTER_A: ("user", AFTER_U)}
    heap, seen = [(0, "", 0, START, ())], set()
    while heap:
        cost, letters, at, state, lines = heapq.heappop(heap)
        if at == len(rows) and state in (START, AFTER_A):
            return cost, letters, "\n".join(lines)
        if (at, state) in seen:
            continue
        seen.add((at, state))
        role, following = write[state]
        heapq.heappush(heap, (cost + 2, letters + "I", at, following, (*lines, f"{role}:")))
        if at < len(rows):
            own, text, fault = rows[at]
            heapq.heappush(heap, (cost + 3, letters + "D", at + 1, state, lines))
            if fault not in ("blank", "duplicate"):
                cut = fault == "truncated"
                heapq.heappush(heap, (cost + 2 + cut, letters + "R", at + 1, following, (*lines, f"{role}:{text}")))
                if (own[:1], state) in keep:
                    heapq.heappush(heap, (cost + cut, letters + "K", at + 1, keep[own[:1], state], (*lines, f"{own}:{text}")))


def plain_repair(table):
    by, out = defaultdict(list), {}
    for conv, turn, role, text in table:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        by[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    for conv, rows in by.items():
        digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()[:16]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r)))
        marked, seen = [], set()
        for _, role, text in rows:
            plain = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not plain else "duplicate" if (role, text) in seen else "" if plain[-1] in ".!?" else "truncated"
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [r[0] for r in rows if r[0] is not None]
        faults = Counter(m[2] for m in marked)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, letters, lines = cheapest(marked)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, letters, hashlib.sha256(lines.encode()).hexdigest())
    return out


def repaired(df):
    got = df.collect()
    assert len({r["conv_id"] for r in got}) == len(got)
    return {r["conv_id"]: tuple(r)[1:] for r in got}


def test_repair_against_brute_force(spark, sf_dir):
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert repaired(repair.repair_report(conversations)) == plain_repair([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in conversations.collect()])


@pytest.mark.parametrize("chunk", [3, 7, 4096])
def test_repair_hard_tables(spark, monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    rng = np.random.default_rng(chunk)
    texts = ["Fine.", "Why?", "cut off", "", " \n", None, "same.", "same.", "x. \t", "a!b"]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, "", "u", "admin"]
    table = [(1, int(t) if t % 9 else None, roles[rng.integers(10)], texts[rng.integers(10)] if t % 3 else f"text {t}.") for t in range(300)]  # one conversation holds most rows
    table += [(int(c), int(t) + 5, roles[rng.integers(10)], texts[rng.integers(10)]) for c in range(2, 40) for t in range(rng.integers(1, 9))]
    table += [(None, None, "user", None), (None, 3, "assistant", "Yes."), (77, None, "user", "a."), (77, None, "user", "a."), (78, 2**40, "user", "a.")] + [(90, 4, "user", "copy.")] * 50
    df = spark.createDataFrame([(*r, 1, 2) for r in table], "conv_id long, turn long, role string, text string, part int, no int").repartition(4)
    assert repaired(repair.repair_report(df)) == plain_repair(table)
    assert repair.repair_report(df.limit(0)).collect() == []
    dropped = next(c for c in range(10**6) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    alone = repair.repair_report(spark.createDataFrame([(dropped, 0, "user", "gone.")], "conv_id long, turn long, role string, text string"))
    assert repaired(alone) == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_block_tables_against_single_rows():
    t, rng = repair.tables(), np.random.default_rng(3)
    for n in (1, 3, 4, 5, 8, 31):
        symbols = rng.integers(0, repair.SYMBOLS, n)
        before, cost, lead = t.summary(symbols)
        for v in range(len(t.vectors)):
            now, total = v, 0
            for s in symbols[::-1]:
                total, now = total + t.added[now, s], t.one[now, s]
            assert (before[v], cost[v]) == (now, total)
            for q in range(4):
                steps = list(t.trace(symbols, v, q))
                assert len(steps) == n and steps[-1][2] == lead[v][q]


# ---- mixing sources


def plain_targets(sizes, weights, cap):
    """Targets of sources in order: raise the level until no target is above its cap."""
    weigh = {k: weights[i % len(weights)] for i, k in enumerate(sizes)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = sum(w for k, w in weigh.items() if k not in capped)
        level = Fraction(total - sum(cap * sizes[k] for k in capped), free) if free else Fraction(0)
        more = {k for k in sizes if k not in capped and level * weigh[k] > cap * sizes[k]}
        if not more:
            return {k: Fraction(cap * sizes[k]) if k in capped else level * weigh[k] for k in sizes}
        capped |= more


def plain_mix(rows, weights, cap, seed):
    """Taken words per row: every source's documents in hashed order, repeated until its target."""
    size = [len(re.findall("[^ \t-\r]+", t or "")) for _, _, t in rows]
    h = [hashlib.md5(":".join([str(seed), *([] if i is None else [str(i)]), hashlib.md5((t or "").encode()).hexdigest()]).encode()).hexdigest() for i, _, t in rows]
    names = sorted({s for _, s, _ in rows if s is not None}) + ([None] if any(s is None for _, s, _ in rows) else [])
    sizes = {s: sum(n for n, r in zip(size, rows) if r[1] == s) for s in names}
    want, out = plain_targets(sizes, weights, cap), []
    for s in names:
        quota, at = min(int(want[s] + Fraction(1, 2)), cap * sizes[s]), 0
        for k in sorted((k for k, r in enumerate(rows) if r[1] == s), key=lambda k: (h[k], rows[k][0] is not None, rows[k][0] or 0)):
            taken = sum(max(0, min(e * sizes[s] + at + size[k], quota) - e * sizes[s] - at) for e in range(cap))
            out.append((rows[k][0], size[k], sizes[s], round(float(want[s]), 6), taken))
            at += size[k]
    return sorted(out, key=str)


def mixed(df):
    return sorted(((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("weights,cap,block", [((5, 2, 1), 3, 64), ((1,), 1, 7), ((9, 1), 2, 100_000)])
def test_mix_against_plain_version(spark, sf_dir, weights, cap, block):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = plain_mix([(r["doc_id"], r["source"], r["text"]) for r in docs.collect()], weights, cap, mixture.SEED)
    assert mixed(mixture.mix_report(docs.repartition(5), weights, cap, block)) == want


def test_mix_hard_tables(spark, monkeypatch):
    monkeypatch.setattr(mixture, "RUN", 7)
    monkeypatch.setattr(mixture, "CELL", 3)
    rows = [(1, "b", "one two three"), (2, "b", ""), (3, None, None), (4, "a", "w " * 500), (5, "Z", "x"), (None, None, "no id"), (None, None, "no id"), (6, "é", "a b c d")]
    rows += [(7, "b", "copy of a row")] * 100 + [(k, "hot", f"text {k} " * (k % 5)) for k in range(10, 60)] + [(8, "none", " \n ")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, source string, text string, size long, slot long").repartition(4)
    for block in (5, 1024):
        assert mixed(mixture.mix_report(docs, block=block)) == plain_mix(rows, (5, 2, 1), 3, mixture.SEED)
    assert mixture.mix_report(docs.limit(0)).collect() == []
    assert [tuple(r) for r in mixture.mix_report(docs.where("doc_id in (2, 8)")).collect()] == [(2, 0, 0, 0.0, 0, 0), (8, 0, 0, 0.0, 0, 0)]


def test_mix_pieces_are_whole_and_well_spread(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces, _, sources = mixture.mix(docs, block=128)
    quota = {r["name"]: r["quota"] for r in sources.collect()}
    total, lines = sum(quota.values()), mixture.mixed_texts(docs, pieces).collect()
    assert all(len(r["text"].split(" ")) == r["words"] for r in lines)
    texts = {r["doc_id"]: re.findall("[^ \t-\r]+", r["text"] or "") for r in docs.collect()}
    assert all(r["text"] == " ".join(texts[r["doc_id"]][r["first"] : r["first"] + r["words"]]) for r in lines)
    slots = defaultdict(Counter)
    for r in lines:
        slots[r["slot"]][r["name"]] += r["words"]
    assert {n: sum(c[n] for c in slots.values()) for n in quota} == quota
    # A stretch of the line has each source's share, but for a few blocks.
    at = Counter()
    for k, slot in enumerate(sorted(slots), 1):
        at += slots[slot]
        assert all(abs(at[n] - sum(at.values()) * q / total) <= 6 * 128 for n, q in quota.items())
    # Blocks of a source are equal but for one word.
    blocks = Counter()
    for r in lines:
        blocks[r["name"], r["block"]] += r["words"]
    assert all(max(v) - min(v) <= 1 for v in [[w for (n, _), w in blocks.items() if n == name] for name in quota])


# ---- mended operators


def test_pii_context_and_masks_against_plain_version(spark):
    """Scores by the 40 characters on either side and masks of merged spans, on texts dense with matches of all kinds."""
    from parchmill.llm import pii

    rng = np.random.default_rng(11)
    bits = ["a@b.co", "jo.doe@mail.example.org", "10.1.2.3", "4111 1111 1111 1111", "+1 (614) 555-8001", "123-45-6789", "key", "Card", "héé", "日本", "mail", "call me", "12", "x" * 50, "GB82 WEST 1234 5698 7654 32", "a" * 32]
    texts = ["".join(bits[rng.integers(len(bits))] + [" ", ", ", "\n", " é ", "  "][rng.integers(5)] for _ in range(n)) for n in (1, 3, 10, 40, 400, 900)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    spans = {r["doc_id"]: r["s"] for r in pii.with_spans(docs, out="s").collect()}
    masked = {r["doc_id"]: r["text"] for r in pii.mask(docs).collect()}
    by = {k.name: k for k in pii.KINDS}
    for i, text in enumerate(texts):
        assert spans[i] == sorted(spans[i], key=lambda s: ([k.name for k in pii.KINDS].index(s["kind"]), s["start"]))
        for s in spans[i]:
            k = by[s["kind"]]
            near = (text[max(0, s["start"] - 40) : s["start"]] + " " + text[s["stop"] : s["stop"] + 40]).translate({c: c + 32 for c in range(65, 91)})
            assert s["score"] == pytest.approx(min(1.0, k.score + 0.15 * bool(re.search(rf"\b(?:{k.context})", near, re.ASCII))))
            assert re.fullmatch(k.pattern.replace(r"\G|", ""), text[s["start"] : s["stop"]])
        at, out = 0, ""
        for s in sorted(spans[i], key=lambda s: (s["start"], -s["stop"], s["kind"])):
            if s["start"] >= at:
                out += text[at : s["start"]] + f"[{s['kind'].upper()}]"
            at = max(at, s["stop"])
        assert masked[i] == out + text[at:]


def test_pii_is_linear_in_the_matches(spark):
    import time

    from parchmill.llm import pii

    docs = spark.createDataFrame([(1, " ".join(f"u{k}@b.co" for k in range(48_000)))], "doc_id long, text string")
    pii.mask(docs.limit(0)).collect()
    began = time.time()
    assert pii.report(docs).first()["n_email"] == 48_000
    assert pii.mask(docs).first()["text"] == " ".join(["[EMAIL]"] * 48_000)
    assert time.time() - began < 40  # a square of the matches took minutes


def test_shards_of_many_copies_with_clashing_names(spark):
    from parchmill.llm import shards

    rows = [(1, "copy", 5, 6, 7)] * 400 + [(k, f"text {k}", 1, 2, 3) for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, inside_ long, place long, nth long").repartition(4)
    got = spark.read.parquet(shards.write_shards(docs, 7)).collect()
    assert sorted((r["doc_id"], r["text"], r["inside_"], r["place"], r["nth"]) for r in got) == sorted(rows)
    sizes = Counter(r["shard"] for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and all(sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n)) for s, n in sizes.items())


def test_near_duplicates_of_the_pipeline_reach_the_likeness(spark):
    """Of the pairs with five-word Jaccard similarity of 0.8 or more, nine in ten and more are put in one group; others stay apart."""
    import itertools
    import random

    import corpus_pipeline
    from parchmill.llm.simhash import shingle_hashes

    rng = random.Random(8)
    words = [f"w{k}" for k in range(3000)]
    texts = []
    for _ in range(150):
        own = rng.choices(words, k=rng.randrange(30, 400))
        texts.append(own)
        for share in (0.0, 0.01, 0.02, 0.03, 0.08):  # edits of single words, up to a likeness well below 0.8
            texts.append([rng.choice(words) if rng.random() < share else w for w in own])
    docs = spark.createDataFrame([(k, " ".join(t), 1) for k, t in enumerate(texts)], "doc_id long, text string, bands int").repartition(3)
    sets = [set(shingle_hashes(" ".join(t), 5).tolist()) for t in texts]
    alike = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    near = [(a, b) for k in range(0, len(texts), 6) for a, b in itertools.combinations(range(k, k + 6), 2) if alike(a, b) >= 0.8]
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicate_removal(spark, docs, "").collect()}
    assert len(near) > 300 and sum(a in kept and b in kept for a, b in near) <= 0.1 * len(near)
    for k in set(range(len(texts))) - kept:  # what goes has a partner in its own family
        assert max(alike(k, j) for j in range(k - k % 6, k - k % 6 + 6) if j != k) > 0.5


def test_confirmed_pairs_against_brute_force(spark):
    from parchmill.llm import candidates
    from parchmill.llm.simhash import shingle_hashes

    rng = np.random.default_rng(6)
    texts = [" ".join(f"t{w}" for w in rng.integers(0, 9, rng.integers(0, 25))) for _ in range(60)] + [None, "", "one", "one"]
    sets = [set(shingle_hashes(t, 2).tolist()) for t in texts]
    found = [(a, b) for a in range(len(texts)) for b in range(a)]
    got = candidates.confirmed(spark.createDataFrame(found, "a long, b long"), spark.createDataFrame(list(enumerate(texts)), "node long, text string"), 2, 0.4)
    want = {(a, b) for a, b in found if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.4 * len(sets[a] | sets[b])}
    assert {tuple(r) for r in got.collect()} == want and want
    nodes = [(k, candidates.bands(np.unique(shingle_hashes(t, 2))).tolist()) for k, t in enumerate(texts)]
    pairs = {tuple(r) for r in candidates.pairs(spark.createDataFrame(nodes, "node long, bands array<long>")).collect()}
    low = {}
    for k, held in nodes:
        for x in held:
            low.setdefault(x, k)
    assert pairs == {(k, low[x]) for k, held in nodes for x in held if low[x] != k}
    assert candidates.bands(np.arange(20_000, dtype=np.uint64)).tolist() == candidates.bands(np.arange(20_000, dtype=np.uint64)[::-1]).tolist()


def test_confirmed_pairs_of_null_empty_and_other_scripts(spark):
    from parchmill.llm import candidates

    texts = spark.createDataFrame([(1, None), (2, ""), (3, "Zoë 好 a b"), (4, "Zoë 好 A  b"), (5, "zoë 好 a c")], "node long, text string")
    found = spark.createDataFrame([(2, 1), (3, 1), (4, 3), (5, 3), (5, 4)], "a long, b long")
    assert [tuple(r) for r in candidates.confirmed(found, texts, 2).collect()] == [(4, 3)]
