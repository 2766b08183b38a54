"""Exact token counts and chunks measured by them."""

import re

import pytest
from pyspark.sql import functions as F

from parchmill.functions import tokens as exact
from parchmill.operators import chunk, embed, exact_chunk
from parchmill.plans import ingest
from parchmill.plans.registry import tokenizer_file

PATH = tokenizer_file("byte_bpe_50k.tiktoken")


def block(kind, text, path=()):
    return {"kind": kind, "text": text, "section_path": list(path), "page_number": None}


def section(*path):
    return block("heading", path[-1], path)


def prose(n, tag=""):
    return block("paragraph", " ".join(f"Clause {tag}{k} says that it's owed to née-Müller's heirs." for k in range(n)))


ITEMS = [block("list_item", f"Case {k}: sign-off by the unit's head.") for k in range(60)]
SHAPES = {
    "sections": [section("Guide"), section("Guide", "Leave"), prose(30), section("Guide", "Safety"), prose(30, "b")],
    "one paragraph": [section("Accrual"), prose(200)],
    "small paragraphs": [section("Rules"), *[block("paragraph", f"Rule {k} holds.") for k in range(60)]],
    "list": [section("Who"), *ITEMS],
    "list after text": [section("Who"), prose(40), *ITEMS[:30], prose(3)],
    "no headings": [prose(40), prose(40, "b"), prose(4, "c")],
    "nested": [section("A"), section("A", "B"), prose(2), section("A", "B", "C"), prose(40), section("A", "B", "D"), prose(3), section("A", "E"), prose(1)],
    "long title": [section("An exceedingly wordy heading " * 12), prose(80)],
    "one long sentence": [section("S"), block("paragraph", "word and another " * 300 + "end")],
    "one long word": [section("W"), block("paragraph", "日本語テキスト" * 150 + "x" * 3000)],
    "table": [section("T"), block("table", "| a | b |\n" * 200), prose(2)],
    "odd": [block("paragraph", "."), section("empty"), section("S"), block("paragraph", "a ¶ 🎉 ﬁ ​ b"), block("paragraph", "Ends; here! Or? Not...")],
}
CONFIGS = [(100, 0, 120), (100, 40, 160), (200, 150, 400), (300, 120, 350), (800, 120, 1200), (50, 10, 60)]


def test_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    texts = ["", "a", "it's  two   spaces\n\n tab\t", "née Müller 日本語 🎉", "x" * 5000, "don't 12345 !!! \x00", *[b["text"] for s in SHAPES.values() for b in s]]
    frame = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").coalesce(1)
    got = [r[0] for r in frame.select(exact.count_tokens(F.col("t"), PATH)).collect()]
    assert got == [len(whole.encode(t, add_special_tokens=False).ids) for t in texts] + [None]
    held = exact.tokens(PATH)
    for t in texts:
        for n in (0, 1, 5, 50):
            cut = held.truncate(t, n)
            assert t.startswith(cut) and (cut == t or held.count(cut) <= n + 1)
    assert [r[0] for r in spark.createDataFrame([("a b c d",), (None,)], "t string").select(embed.fitted(F.col("t"), 2, PATH)).collect()] == ["a b", None]


@pytest.mark.parametrize("config", CONFIGS)
@pytest.mark.parametrize("shape", SHAPES)
def test_ceilings_hold_and_chunks_are_full(shape, config):
    target, overlap, maximum = config
    count, blocks = exact.tokens(PATH).count, SHAPES[shape]
    made = exact_chunk.chunk_bodies("Handbook", blocks, count, target, overlap, maximum)
    size = lambda path, body: count(f"{exact_chunk.breadcrumb('Handbook', path, maximum, count)}\n\n{body}")
    assert made
    for path, body, own in made:
        assert body.strip() and (size(path, body) <= maximum or any(b["kind"] == "table" for b in own))
    # What is put together could not have taken the next part too: whole sections within the target, cut ones up to it.
    plain = exact_chunk.chunk_bodies("Handbook", blocks, count, target, 0, maximum)
    for (p, a, own), (q, b, more) in zip(plain, plain[1:]):
        if p == q and a.endswith(chunk.BELOW):
            first = re.split(r"(?<=[.!?;])\s+|\n\n| ", b)[0]
            assert size(p, a) >= min(target, maximum) * 0.4 or count(first) > 1  # a chunk that ends early is followed by a larger part
    # Nothing is lost without overlap, and order is kept.
    squeeze = lambda t: re.sub(r"\s+", "", t.replace(chunk.BELOW, ""))
    texts = "".join(squeeze(b) for _, b, _ in plain)
    at = 0
    for b in blocks:
        if b["kind"] != "heading":
            at = texts.index(squeeze(b["text"]), at)


def plain_packed(sentences, size, target):
    """Sentences taken while the text with its marker stays within the target."""
    out, now = [], []
    for k, s in enumerate(sentences):
        end = k + 1 == len(sentences)
        if now and size(" ".join([*now, s]) + ("" if end else f"\n{chunk.BELOW}")) > target:
            out.append(now)
            now = []
        now.append(s)
    out.append(now)
    return [" ".join(g) + ("" if k + 1 == len(out) else f"\n{chunk.BELOW}") for k, g in enumerate(out)]


@pytest.mark.parametrize("config", CONFIGS)
def test_a_cut_paragraph_against_brute_force(config):
    target, _, maximum = config
    count, text = exact.tokens(PATH).count, prose(120)["text"]
    line = exact_chunk.breadcrumb("Handbook", ["Accrual"], maximum, count)
    size = lambda body: count(f"{line}\n\n{body}")
    made = exact_chunk.chunk_bodies("Handbook", [section("Accrual"), block("paragraph", text)], count, target, 0, maximum)
    assert [b for _, b, _ in made] == plain_packed(chunk.sentences(text), size, target)
    # With overlap: whole sentences of the chunk before, as many as both limits allow.
    led = exact_chunk.chunk_bodies("Handbook", [section("Accrual"), block("paragraph", text)], count, target, 40, maximum)
    for (_, before, _), (_, body, _), (_, own, _) in zip(led, led[1:], made[1:]):
        tail = chunk.sentences(before.removesuffix(chunk.BELOW).rstrip())
        lead = lambda n: f"{chunk.AGAIN} {' '.join(tail[-n:])}"
        fits = lambda n: count(lead(n)) <= 40 and size(f"{lead(n)}\n\n{own}") <= maximum
        n = next((k for k in range(1, len(tail) + 1) if not fits(k)), len(tail) + 1) - 1
        assert body == (f"{lead(n)}\n\n{own}" if n else own)


def test_runs_by_exact_counts(spark):
    settings = ingest.Settings.from_env({"TOKENIZER_FILE": PATH, "CHUNK_TARGET_TOKENS": "60", "CHUNK_OVERLAP_TOKENS": "10", "CHUNK_MAX_TOKENS": "80", "EMBEDDING_DIMENSIONS": "8"})
    source = spark.createDataFrame([("a.md", ("# Guide\n\n" + prose(40)["text"]).encode()), ("b.md", b"# Short\n\ntext")], "path string, content binary")
    done = ingest.plan(source, spark.createDataFrame([], ingest.index.DDL), settings)
    rows = done.chunks.collect()
    assert len(rows) > 5 and max(r["token_count"] for r in rows) <= 80
    assert {r["document_id"] for r in rows} == {"A", "B"}


def test_vectors_with_missing_numbers_are_bad(spark):
    rows = [("a", [1.0, None]), ("a", [1.0, float("inf")]), ("b", [1.0, 2.0]), ("c", None), ("c", [1.0])]
    got = embed.check_vectors(spark.createDataFrame(rows, "document_id string, embedding array<float>"), 2)
    assert {(r["document_id"], r["n_bad"]) for r in got.collect()} == {("a", 2), ("c", 2)}
