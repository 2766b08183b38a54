"""Files made to be slow: parsers stay linear, and deep nesting is bounded."""

import random
import time

import pytest

from parchmill.sources.html import parse_html
from parchmill.sources.markdown import _marks, parse_markdown, plain

HTML = {
    "open marks": "<i>" * 60_000 + "text", "nested divs": "<div>" * 40_000 + "text", "text in marks": "<i>a" * 50_000, "paragraph around": "<p><table><tr><td>" + "<div>" * 40_000,
    "headings": "<h1>a" * 40_000, "quotes": "<blockquote>a" * 15_000, "tables": "<table><tr><td>a" * 12_000, "cells": "<table><tr>" + "<td>a" * 40_000, "end tags": "<b></i>" * 28_000, "attributes": "<p a=" * 40_000,
}
MARKDOWN = {
    "stars": "a*" * 100_000, "mixed": "*_a" * 60_000, "openers": "*a " * 60_000, "closers": "a* " * 60_000, "runs": "".join("a" + "*" * (k % 7 + 1) for k in range(40_000)), "under": "_a" * 90_000,
    "quotes": ">" * 2000 + "a", "lists": "- " * 2000 + "a", "quoted lists": "> - " * 2000 + "a", "brackets": "[" * 60_000, "links": "[a](" * 40_000, "lines": "a\n" * 60_000,
}


@pytest.mark.parametrize("name", HTML)
def test_html_in_time(name):
    began = time.process_time()
    parse_html(HTML[name])
    assert time.process_time() - began < 4


@pytest.mark.parametrize("name", MARKDOWN)
def test_markdown_in_time(name):
    began = time.process_time()
    blocks = parse_markdown(MARKDOWN[name])[0]
    assert time.process_time() - began < 4 and (blocks or name == "lists")


def slow_marks(parts):
    """The rule for emphasis without shortcuts: every closer looks back over everything."""
    k = 0
    while k < len(parts):
        closer = parts[k]
        if isinstance(closer, list) and closer[3] and closer[1]:
            for j in range(k - 1, -1, -1):
                opener = parts[j]
                if not isinstance(opener, list) or opener[0] != closer[0] or not opener[2] or not opener[1]:
                    continue
                if (opener[3] or closer[2]) and (opener[4] + closer[4]) % 3 == 0 and (opener[4] % 3 or closer[4] % 3):
                    continue
                used = 2 if min(opener[1], closer[1]) > 1 else 1
                opener[1] -= used
                closer[1] -= used
                opener[5] = closer[5] = True
                for between in parts[j + 1 : k]:
                    if isinstance(between, list):
                        between[2] = False
                break
            else:
                k += 1
                continue
            if closer[1]:
                continue
        k += 1


def test_marks_against_the_slow_rule():
    rng = random.Random(5)
    for _ in range(4000):
        parts = [[rng.choice("*_"), n := rng.randrange(1, 5), rng.random() < 0.6, rng.random() < 0.6, n, False] if rng.random() < 0.7 else "t" for _ in range(rng.randrange(12))]
        one, two = ([list(p) if isinstance(p, list) else p for p in parts] for _ in range(2))
        slow_marks(one)
        _marks(two)
        assert [p[1::4] if isinstance(p, list) else p for p in one] == [p[1::4] if isinstance(p, list) else p for p in two]


def test_breaks_and_bounded_nesting():
    assert plain("a\\\nb") == "a b" and plain("a\\b") == "a\\b"
    assert [b["text"] for b in parse_markdown("> " * 50 + "deep")[0]] == ["deep"]
    assert parse_markdown(">" * 500 + "deeper")[0][0]["text"].endswith("deeper")
    inner = "<blockquote>" * 300 + "x"
    assert len(parse_html(inner)[0]) == 64
