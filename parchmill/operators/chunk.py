"""Sections and token-bounded chunks.

Section windows are native.  The greedy fold over a document's sections depends
on what it has assembled so far (overlap is taken from the chunk before), so it
runs in one Arrow pass per document; a document's blocks are its unit and no
other grouping is needed.  Sizes are estimated from words, and joined parts are
always separated by white space, so a joined text has the sum of its parts'
words and the fold works on word counts alone.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tokens import tokens as exact

# Defaults of the chunk settings and the markers of cut text.
TARGET, OVERLAP, MAXIMUM = 800, 120, 1200
BELOW, AGAIN = "(continued below)", "(continued)"
_SENTENCE = re.compile(r"(?<=[.!?;])\s+")


def section_path(blocks: DataFrame, document: str = "document_id", pos: str = "pos", level: str = "level", text: str = "text") -> DataFrame:
    """``blocks`` with ``section_path``: texts of the headings above, a heading's own included.

    A heading of level L is on the path while no later heading has its level
    or a higher one, so per level the last heading's position is compared with
    the greatest position among the levels above.
    """
    w = Window.partitionBy(document).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    at = [F.max(F.when(F.col(level) == n, F.col(pos))).over(w) for n in range(1, 7)]
    name = [F.last(F.when(F.col(level) == n, F.col(text)), True).over(w) for n in range(1, 7)]
    staged = blocks.withColumns({f"__at{n}": at[n] for n in range(6)} | {f"__name{n}": name[n] for n in range(6)})
    parts: list[Column] = []
    for n in range(6):
        above = F.greatest(*[F.coalesce(F.col(f"__at{k}"), F.lit(-1)) for k in range(n)], F.lit(-1)) if n else F.lit(-1)
        parts.append(F.when(F.col(f"__at{n}") > above, F.col(f"__name{n}")))
    return staged.withColumn("section_path", F.array_compact(F.array(*parts))).drop(*[c for n in range(6) for c in (f"__at{n}", f"__name{n}")])


def sectionize(blocks: DataFrame, document: str = "document_id", pos: str = "pos", level: str = "level") -> DataFrame:
    """``blocks`` with ``section``: a number that grows at each heading."""
    w = Window.partitionBy(document).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    return blocks.withColumn("section", F.sum(F.when(F.col(level).isNotNull(), 1).otherwise(0)).over(w))


def islands(rows: DataFrame, group: str, pos: str | list[str], value: Column) -> DataFrame:
    """``rows`` with ``island``: runs of equal ``value`` within a group, numbered from 1."""
    w = Window.partitionBy(group).orderBy(*([pos] if isinstance(pos, str) else pos))
    new = F.when(F.lag("__value").over(w).eqNullSafe(F.col("__value")), 0).otherwise(1)
    return rows.withColumn("__value", value).withColumn("__new", new).withColumn("island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__value", "__new")


def greedy_pack(rows: DataFrame, group: str, order: str, value: str, limit: int, name: str = "pack") -> DataFrame:
    """``rows`` with a group number: a group takes values in order while their sum stays within ``limit``.

    The rows of a key meet in one partition in order, and the fold carries only
    the running sum from row to row, so a key with many rows needs no memory.
    """
    columns = rows.columns

    def run(batches):
        key, total, number = run, 0, 0  # no key is equal to a function
        for batch in batches:
            out = []
            for k, v in zip(batch.column(group).to_pylist(), batch.column(value).to_pylist()):
                if k != key:
                    key, total, number = k, v, 0
                elif total + v <= limit:
                    total += v
                else:
                    total, number = v, number + 1
                out.append(number)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int32())], [*columns, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.repartition(group).sortWithinPartitions(group, order).mapInArrow(run, f"{schema}, {name} int")


def count(text: str) -> int:
    return len(text.split())


def tokens(words: int) -> int:
    return max(1, int(words * 1.35)) if words else 0


def estimate(text: str) -> int:
    return tokens(count(text))


def breadcrumb(name: str, path: list[str], maximum: int = MAXIMUM) -> str:
    """Document name and the headings that differ from it, cut at half the ceiling."""
    line = " > ".join([name, *(p for p in path if p.casefold() != name.casefold())])
    most = max(1, maximum // 2)
    return line if estimate(line) <= most else " ".join(line.split()[: max(1, int(most / 1.35))])


def shared_prefix(one: list[str], two: list[str]) -> list[str]:
    """The leading parts that both paths have."""
    n = next((i for i, (a, b) in enumerate(zip(one, two)) if a != b), min(len(one), len(two)))
    return one[:n]


def runs(sizes: list[int], limit: int) -> list[slice]:
    """Consecutive parts taken together while their words make at most ``limit`` tokens; a larger part stands alone."""
    out, begin, total = [], 0, 0
    for i, n in enumerate(sizes):
        if i > begin and tokens(total + n) > limit:
            out.append(slice(begin, i))
            begin, total = i, 0
        total += n
    return [*out, slice(begin, len(sizes))] if sizes else out


def sentences(text: str) -> list[str]:
    return [s for s in _SENTENCE.split(text) if s.strip()]


def _sections(blocks: list[dict]) -> list[tuple[list[str], list[dict]]]:
    """(path, blocks) per heading; what stands before the first heading has no path, and empty sections go."""
    out: list[tuple[list[str], list[dict]]] = [([], [])]
    for b in blocks:
        if b["kind"] == "heading":
            out.append((list(b["section_path"] or []), []))
        else:
            out[-1][1].append(b)
    return [s for s in out if s[1]]


def _pieces(blocks: list[dict], ceiling: int) -> list[tuple[str, bool, list[dict]]]:
    """(text, was cut, blocks): list runs and single blocks, and those above the ceiling in parts.

    A list run is cut between items, a text between sentences; a table never.
    """
    out, i = [], 0
    while i < len(blocks):
        j = i + 1
        while blocks[i]["kind"] == "list_item" and j < len(blocks) and blocks[j]["kind"] == "list_item":
            j += 1
        own, i = blocks[i:j], j
        texts = [b["text"] for b in own]
        if estimate(" ".join(texts)) <= ceiling or own[0]["kind"] == "table":
            out.append(("\n\n".join(texts), False, own))
        elif len(own) > 1:
            out += [("\n\n".join(texts[r]), True, own[r]) for r in runs([count(t) for t in texts], ceiling)]
        else:
            parts = sentences(texts[0]) or texts
            out += [(" ".join(parts[r]), True, own) for r in runs([count(p) for p in parts], ceiling)]
    return out


def _tail(body: str, most: int) -> str:
    """Whole sentences from the end of a chunk, marked, within ``most`` tokens."""
    taken: list[str] = []
    used = 0
    for s in reversed(sentences(body.removesuffix(BELOW).rstrip())):
        used += estimate(s)
        if used > most:
            break
        taken.append(s)
    return f"{AGAIN} {' '.join(reversed(taken))}" if taken else ""


def _cut(blocks: list[dict], target: int, overlap: int, ceiling: int) -> list[tuple[str, list[dict]]]:
    """Bodies of a section above the ceiling; sizes are those of the body alone."""
    mark = estimate(BELOW)
    pieces = _pieces(blocks, max(1, ceiling - mark))
    out: list[tuple[str, list[dict]]] = []
    for r in runs([count(p[0]) for p in pieces], max(1, target - mark)):
        own = pieces[r]
        body = "\n\n".join(p[0] for p in own) + (f"\n{BELOW}" if own[-1][1] else "")
        if out and overlap:
            lead = _tail(out[-1][0], min(overlap, ceiling - estimate(body)))
            if lead and estimate(f"{lead} {body}") <= ceiling:
                body = f"{lead}\n\n{body}"
        out.append((body, [b for p in own for b in p[2]]))
    return out


def chunk_bodies(name: str, blocks: list[dict], target: int = TARGET, overlap: int = OVERLAP, maximum: int = MAXIMUM) -> list[tuple[list[str], str, list[dict]]]:
    """(path, body, blocks) of a document's chunks.

    Whole sections are packed up to ``target`` while they share the beginning
    of their paths, which is then the chunk's path; each carries the rest of
    its own as a line.  A section above ``maximum`` is cut at blocks, list
    items or sentences, marked, and continued with up to ``overlap`` tokens of
    whole sentences from before.
    """
    groups: list[tuple[list[str], list, int]] = []
    for path, own in _sections(blocks):
        size = tokens(sum(count(b["text"]) for b in own))
        if groups and (common := shared_prefix(groups[-1][0], path)) and groups[-1][2] + size + estimate(breadcrumb(name, common, maximum)) <= target:
            groups[-1] = (common, [*groups[-1][1], (path, own)], groups[-1][2] + size)
        else:
            groups.append((path, [(path, own)], size))
    out: list[tuple[list[str], str, list[dict]]] = []
    for path, members, size in groups:
        overhead = estimate(breadcrumb(name, path, maximum))
        if size + overhead > maximum:
            out += [(path, body, own) for body, own in _cut(members[0][1], max(1, target - overhead), overlap, max(1, maximum - overhead))]
            continue
        texts = ["\n\n".join(b["text"] for b in own) for _, own in members]
        if len(members) > 1:
            heads = [" > ".join(p[len(path) :]) for p, _ in members]
            texts = [f"{h}\n{t}" if h else t for h, t in zip(heads, texts)]
        out.append((path, "\n\n".join(texts), [b for _, own in members for b in own]))
    return out


_CHUNK = pa.schema([
    ("document_id", pa.string()), ("ordinal", pa.int32()), ("section", pa.string()), ("section_path", pa.list_(pa.string())), ("text", pa.string()),
    ("embedding_text", pa.string()), ("token_count", pa.int32()), ("page_number", pa.int32()), ("page_end", pa.int32()),
])
CHUNKS = "document_id string, ordinal int, section string, section_path array<string>, text string, embedding_text string, token_count int, page_number int, page_end int"


def chunk_documents(documents: DataFrame, target: int = TARGET, overlap: int = OVERLAP, maximum: int = MAXIMUM, vocabulary: str | None = None) -> DataFrame:
    """Chunks of rows (document_id, document_name, blocks); blocks hold kind, text, section_path and maybe page_number in order.

    A document without headings is its own section.  Null names fall back to
    the id; documents without blocks have no chunks.  Sizes are estimated from
    words, or exact by the ``vocabulary`` file where one is named.
    """
    from . import exact_chunk  # it uses this module

    if not 0 <= overlap < target <= maximum:
        raise ValueError("overlap must be below target, and target at most the maximum")

    def run(batches):
        size = exact(vocabulary).count if vocabulary else estimate
        for batch in batches:
            rows = []
            for i, name, blocks in zip(*(batch.column(c).to_pylist() for c in ("document_id", "document_name", "blocks"))):
                name = name or i or ""
                made = exact_chunk.chunk_bodies(name, blocks or [], size, target, overlap, maximum) if vocabulary else chunk_bodies(name, blocks or [], target, overlap, maximum)
                for n, (path, body, own) in enumerate(made):
                    line = exact_chunk.breadcrumb(name, path, maximum, size) if vocabulary else breadcrumb(name, path, maximum)
                    full = f"{line}\n\n{body}" if line else body
                    pages = [b["page_number"] for b in own if b.get("page_number") is not None]
                    rows.append((i, n, path[-1] if path else name, path or [name], body, full, size(full), min(pages, default=None), max(pages, default=None)))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(list(zip(*rows)) or [()] * len(_CHUNK), _CHUNK)], schema=_CHUNK)

    return documents.select("document_id", "document_name", "blocks").mapInArrow(run, CHUNKS)
