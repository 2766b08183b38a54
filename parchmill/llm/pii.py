"""Operator 2: personal data, found with DataFrame functions only.

Regular expressions propose spans, checksum validators (Luhn for cards, mod-97
for bank accounts, octet and digit-count rules) confirm them, and words nearby
adjust each span's score.

Positions come without any user function: ``split`` gives the text between the
matches and ``regexp_extract_all`` the matches, so running lengths of the two
are the spans, in code points.

The patterns below match what the contract's do.  They only add guards for
long texts: possessive repeats, and a look-behind that keeps the engine from
trying every position inside one run of characters (``\\G`` lets a match start
right where the last one ended).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, LOWER, UPPER, text_or_empty

# Kinds, patterns, and the characters a text must hold for a kind to be possible.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])"
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
SECRET = r"(?:\G|(?<![0-9A-Za-z]))(?:[0-9a-f]{32,}+|AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{30,}+|sk-[0-9A-Za-z]{20,}+)(?![0-9A-Za-z])"
_OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
IP_VALID = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"


@dataclass(frozen=True)
class Kind:
    """A kind of span: its pattern, its confirmed base score, and words that raise the score when near."""

    name: str
    pattern: str
    base: bool
    score: float
    context: str
    threshold: float = 0.5


KINDS = [
    Kind("email", EMAIL, True, 0.9, r"mail|contact|write|courriel|correo"),
    Kind("ip", IP, True, 0.8, r"ip|address|host|server|client"),
    Kind("card", CARD, True, 0.85, r"card|visa|credit|payment|carte|tarjeta|karte"),
    Kind("phone", PHONE, True, 0.8, r"phone|call|tel|mobile|fax"),
    Kind("iban", IBAN, False, 0.9, r"iban|bank|account|konto|compte|cuenta"),
    Kind("ssn", SSN, False, 0.5, r"ssn|social|security|insurance"),
    Kind("secret", SECRET, False, 0.4, r"token|key|secret|password|auth|api"),
]
#: How many characters on either side are searched for context words, and what one adds.
CONTEXT_CHARS, CONTEXT_GAIN = 40, 0.15
#: A text is cut into blocks of so many characters to take parts of it from.
BLOCK_CHARS = 1024


def _possible(kind: Kind, text: Column) -> Column:
    """A cheap test that is true wherever the pattern can match."""
    digit = text.rlike("[0-9]")
    return {
        "email": text.contains("@"), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike("[0-9][ -]?[0-9]"),
        "phone": text.rlike(r"\+[0-9]"), "iban": text.rlike("[A-Z]{2}[0-9]{2}"), "ssn": text.rlike("[0-9]-[0-9]{2}-[0-9]"),
        "secret": text.rlike("[0-9a-f]{32}|AKIA|gh[pousr]_|sk-"),
    }.get(kind.name, digit)


def mod97(account: Column) -> Column:
    """Remainder of an account number by 97 after its first four characters move to the end and letters become numbers."""
    moved = F.concat(F.substring(account, 5, 1000), F.substring(account, 1, 4))
    digits = F.transform(F.split(moved, ""), lambda c: F.when(c.rlike("[0-9]"), c).otherwise((F.ascii(c) - 55).cast("string")))
    return F.aggregate(
        F.filter(F.split(F.array_join(digits, ""), ""), lambda c: c != ""), F.lit(0), lambda acc, d: (acc * 10 + d.cast("int")) % 97
    )


def _valid(kind: Kind, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind.name == "ip":
        return found.rlike(IP_VALID)
    if kind.name == "card":
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    if kind.name == "phone":
        return F.length(digits).between(9, 15)
    if kind.name == "iban":
        plain = F.replace(found, F.lit(" "), F.lit(""))
        return F.length(plain).between(15, 34) & (mod97(plain) == 1)
    if kind.name == "ssn":
        return ~found.rlike("^(000|666|9)|-00-|-0000$")
    return F.lit(True)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def scan(values: Column, op, zero: Column) -> Column:
    """Running results of an associative ``op`` over an array, by doubling: n log n steps for n values."""
    steps = F.filter(F.array(*[F.lit(2**k) for k in range(30)]), lambda s: s < F.size(values))
    return F.aggregate(steps, values, lambda acc, s: F.zip_with(F.concat(F.array_repeat(zero, s), F.slice(acc, 1, F.size(acc) - s)), acc, op))


def _left(text: Column) -> Column:
    return F.substring(text, 1, CONTEXT_CHARS)


def _right(text: Column) -> Column:
    return F.when(F.length(text) <= CONTEXT_CHARS, text).otherwise(F.substring(text, -CONTEXT_CHARS, CONTEXT_CHARS))


def _spans(kind: Kind, gaps: Column, found: Column) -> Column:
    """Array of (kind, start, end, score) for the confirmed matches of a kind.

    Words near a match are looked for in the gaps and matches around it, each
    cut to what can be near, so the work is linear in the text.
    """
    matches = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.struct(
        (F.length(g) + F.length(m)).alias("both"), F.length(m).alias("size"), m.alias("found"), _right(g).alias("near"),
    ))

    def placed(matches: Column, stops: Column, ahead: Column, behind: Column) -> Column:
        def scored(m: Column, i: Column) -> Column:
            # A match has a character at least, so as many neighbours as characters are enough.
            first = F.greatest(i - CONTEXT_CHARS, F.lit(0))
            before = _right(F.concat(F.array_join(F.slice(ahead, first + 1, i - first), ""), m["near"]))
            after = _left(F.array_join(F.slice(behind, i + 2, CONTEXT_CHARS), ""))
            near = F.translate(F.concat(before, F.lit(" "), after), UPPER, LOWER).rlike(rf"\b(?:{kind.context})")
            score = F.lit(kind.score) + F.when(near, F.lit(CONTEXT_GAIN)).otherwise(F.lit(0.0))
            stop = F.element_at(stops, i + 1)
            span = F.struct(F.lit(kind.name).alias("kind"), (stop - m["size"]).alias("start"), stop.alias("stop"), F.least(score, F.lit(1.0)).alias("score"))
            return F.when(_valid(kind, m["found"]), span)

        kept = F.filter(F.transform(matches, scored), lambda s: s.isNotNull())
        return kept if kind.base else F.filter(kept, lambda s: s["score"] >= kind.threshold)

    def with_neighbours(matches: Column) -> Column:
        stops = scan(F.transform(matches, lambda m: m["both"]), lambda a, b: a + b, F.lit(0))
        ahead = F.transform(matches, lambda m: F.concat(m["near"], _right(m["found"])))
        behind = F.transform(gaps, lambda g, i: F.concat(_left(g), F.when(i < F.size(found), _left(F.get(found, i))).otherwise("")))
        return let(F.struct(stops.alias("stops"), ahead.alias("ahead"), behind.alias("behind")), lambda n: placed(matches, n["stops"], n["ahead"], n["behind"]))

    return let(matches, with_neighbours)


SPANS = "array<struct<kind:string,start:int,stop:int,score:double>>"


def with_spans(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with one more column ``out``: spans by kind in the order of KINDS, then by start.

    Start and stop count code points, stop exclusive.  Matches of one kind
    don't overlap; those of different kinds may.  Base kinds (email, ip, card,
    phone) are reported whenever their validator confirms them, whatever words
    are near.  The kinds added here (iban, ssn, secret) need a score of their
    threshold, which for secrets means a context word.  Null and empty texts
    have an empty array.
    """
    clash = set(docs.columns)
    name = next(n for n in (f"_pii{'_' * i}" for i in range(100)) if not any(c.startswith(n) for c in clash))
    body = text_or_empty(text)
    matched = docs.select("*", *[
        F.when(_possible(k, body), F.struct(F.split(body, k.pattern, -1).alias("gaps"), F.regexp_extract_all(body, F.lit(k.pattern), F.lit(0)).alias("found"))).alias(f"{name}{k.name}")
        for k in KINDS
    ])
    each = [
        F.when(F.size(F.col(f"{name}{k.name}")["found"]) > 0, _spans(k, F.col(f"{name}{k.name}")["gaps"], F.col(f"{name}{k.name}")["found"])).otherwise(F.array().cast(SPANS))
        for k in KINDS
    ]
    return matched.withColumn(out, F.concat(*each)).drop(*[f"{name}{k.name}" for k in KINDS])


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of every kind in ``text`` replaced by its kind in brackets.

    Overlapping spans are masked as one, under the kind that starts first (the
    longer on a tie).  Texts without spans, null texts included, stay as they are.
    """
    (spans,) = fresh(docs, "spans")
    found = with_spans(docs, text, spans)
    body = F.col(text)
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["stop"]).alias("back"), s["kind"].alias("kind"))))

    def part(blocks: Column, start: Column, stop: Column) -> Column:
        """Characters from start to stop, from the blocks that hold them."""
        first = F.floor(start / BLOCK_CHARS).cast("int")
        inside = F.array_join(F.slice(blocks, first + 1, F.floor(stop / BLOCK_CHARS).cast("int") - first + 1), "")
        return F.when(stop <= start, "").otherwise(F.substring(inside, start - first * BLOCK_CHARS + 1, stop - start))

    def replaced(x: Column) -> Column:
        # Where the text is covered up to, before each span.
        covered = F.concat(F.array(F.lit(0)), scan(F.transform(x["ordered"], lambda s: -s["back"]), lambda a, b: F.greatest(a, b), F.lit(0)))
        def masked(c: Column) -> Column:
            pieces = F.transform(x["ordered"], lambda s, i: F.when(s["start"] >= F.get(c, i), F.concat(part(x["blocks"], F.get(c, i), s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))))
            return F.concat(F.array_join(pieces, ""), part(x["blocks"], F.element_at(c, -1), F.length(body)))
        return let(covered, masked)

    blocks = F.regexp_extract_all(body, F.lit(f"(?s).{{1,{BLOCK_CHARS}}}"), F.lit(0))
    done = let(F.struct(ordered.alias("ordered"), blocks.alias("blocks")), replaced)
    return found.withColumn(text, F.when(F.size(spans) > 0, done).otherwise(body)).drop(spans)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, max_score per document.

    ``spans`` joins kind:start:end of all spans with commas, base_sha256 is the
    digest of the same string over the base kinds (of the empty string if there
    are none).  Repeated rows each get a row; an empty table gives none.
    """
    found = with_spans(docs.select("doc_id", "text")).drop("text")
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    base = [k.name for k in KINDS if k.base]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in base],
        F.sha2(line(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        line(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["kind"].isin(base))).cast("long").alias("n_added"),
        F.array_max(F.transform("spans", lambda s: s["score"])).alias("max_score"),
    )
