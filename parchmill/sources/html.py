"""HTML pages as blocks, with the standard library's parser inside one Arrow pass."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

# Tags whose content is dropped, and tags that make a block.
DROPPED = {"script", "style", "nav", "footer", "noscript", "aside", "form"}
BLOCKS = {"h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "table", "pre", "blockquote"}
CLOSES_P = BLOCKS | {"div", "section", "article", "ul", "ol", "header", "main", "nav", "footer", "aside", "form"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
#: Open tags that a new tag ends, and the tags beyond which it doesn't look for them.
ENDS = {
    "li": (("li",), ("ul", "ol")), "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tr",), ("table",)), "tfoot": (("tr",), ("table",)), "body": (("head",), ()),
}

BLOCK_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("text", pa.string()), ("level", pa.int32()), ("page_number", pa.int32())]))
BLOCK_DDL = "array<struct<kind:string,text:string,level:int,page_number:int>>"


def block_array(rows: list[list[dict]]) -> pa.Array:
    """Lists of blocks as an array of BLOCK_TYPE, column by column."""
    offsets, flat = [0], []
    for r in rows:
        flat += r
        offsets.append(len(flat))
    fields = list(BLOCK_TYPE.value_type)
    parts = [pa.array([b.get(name) for b in flat], kind) for name, kind in [(f.name, f.type) for f in fields]]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(parts, fields=fields), type=BLOCK_TYPE)


#: Blocks, rows and cells that are open at once at most; what is nested deeper belongs to those around it.
NESTED = 64


@dataclass
class _Open:
    """An open tag and what its text goes to."""

    tag: str
    dropped: bool
    block: dict | None = None
    row: list | None = None
    cell: list | None = None


@dataclass
class _Page(HTMLParser):
    stack: list[_Open] = field(default_factory=list)
    holders: list[tuple[int, _Open]] = field(default_factory=list)  # the open tags that take text or rows, with their places
    places: dict[str, list[int]] = field(default_factory=dict)  # where each tag is open
    blocks: list[dict] = field(default_factory=list)
    hints: dict[str, str] = field(default_factory=dict)
    title: list[str] | None = None

    def __post_init__(self):
        super().__init__(convert_charrefs=True)

    def handle_starttag(self, tag, attrs):
        if tag == "meta":
            named = {k: v for k, v in attrs if v}
            if named.get("name") and named.get("content"):
                self.hints[named["name"].lower()] = named["content"]
        if tag in VOID:
            return
        if tag in CLOSES_P:
            self._close(("p",), ("table", "td", "th"))
        if tag in ENDS:
            self._close(*ENDS[tag])
        new = _Open(tag, tag in DROPPED or bool(self.stack) and self.stack[-1].dropped)
        if tag == "title" and self.title is None:
            self.title = []
        if not new.dropped and len(self.holders) < NESTED:
            if tag in BLOCKS and (tag == "table" or not (self.places.get("table") or self.places.get("li"))):
                heading = tag[0] == "h"
                kind = "heading" if heading else {"li": "list_item", "table": "table"}.get(tag, "paragraph")
                new.block = {"kind": kind, "level": int(tag[1]) if heading else None, "parts": [], "rows": []}
                self.blocks.append(new.block)
            elif tag == "tr":  # a row belongs to every table around it
                new.row = []
                for _, o in self.holders:
                    if o.block and o.tag == "table":
                        o.block["rows"].append(new.row)
            elif tag in ("td", "th"):
                new.cell = []
                for _, o in self.holders:
                    if o.row is not None:
                        o.row.append(new.cell)
        if new.block or new.row is not None or new.cell is not None:
            self.holders.append((len(self.stack), new))
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append(new)

    def handle_endtag(self, tag):
        self._close((tag,), ())

    def handle_data(self, data):
        text = data.strip()
        if not text or not self.stack:
            return
        if self.stack[-1].tag == "title" and self.title is not None:
            self.title.append(text)
        if self.stack[-1].dropped:
            return
        for _, o in self.holders:
            if o.cell is not None:
                o.cell.append(text)
            elif o.block and o.tag != "table":
                o.block["parts"].append(text)

    def parse_marked_section(self, i, report=1):
        """Marked sections hold nothing for a reader; they end at the next '>'."""
        return self.rawdata.find(">", i) + 1 or -1

    def _close(self, tags, stops):
        last = lambda names: max((p[-1] for n in names if (p := self.places.get(n))), default=-1)
        k = last(tags)
        if k <= last(stops):
            return
        for o in self.stack[k:]:
            self.places[o.tag].pop()
        del self.stack[k:]
        while self.holders and self.holders[-1][0] >= k:
            self.holders.pop()


def pipe_table(rows: list[list[str]]) -> str:
    """Rows as lines of equal width between pipes, with a rule after the first; rows of empty cells are left out."""
    rows = [r for r in rows if any(r)]
    width = max((len(r) for r in rows), default=0)
    lines = ["| " + " | ".join(r + [""] * (width - len(r))) + " |" for r in rows]
    return "\n".join([*lines[:1], "|" + "---|" * width, *lines[1:]]) if lines else ""


def parse_html(html: str | None, references: str | None = None) -> tuple[list[dict], str | None, dict[str, str]]:
    """Blocks, title hint (first h1, else <title>) and named meta values of a page; null gives none.

    Character references are read as HTML has it, also those that lack their
    semicolon.  With ``references``, a pattern of what follows an ampersand,
    only these are read, and the others stay as they are written.
    """
    page, html = _Page(), html or ""
    if references:
        html = re.sub(f"&(?!{references})", "&amp;", html)
    end = html.rfind(">") + 1
    if html.count("<", end) > NESTED:  # tags that never end are text; the parser would look for their end from each of them
        html = html[:end] + html[end:].replace("<", "&lt;")
    page.feed(html)
    page.close()
    blocks = []
    for b in page.blocks:
        text = pipe_table([[" ".join(" ".join(c).split()) for c in r] for r in b["rows"]]) if b["kind"] == "table" else " ".join(" ".join(b["parts"]).split())
        if text:
            blocks.append({"kind": b["kind"], "text": text, "level": b["level"]})
    first = next((b["text"] for b in blocks if b["level"] == 1), None)
    return blocks, first or " ".join(" ".join(page.title or []).split()) or None, page.hints


def html_blocks(pages: DataFrame, key: str, html: str = "html", references: str | None = None) -> DataFrame:
    """(key, title_hint, blocks, error): one row per page, one Python pass and no shuffle.

    A page that the parser can't read has no blocks and says why in ``error``;
    the others go on.  ``references``: see ``parse_html``.
    """

    def one(text):
        try:
            blocks, title, _ = parse_html(text, references)
            return title, blocks, None
        except Exception as e:  # the parser meets arbitrary bytes; the page fails, not the task
            return None, [], f"cannot read html: {e}"

    def run(batches):
        for batch in batches:
            parsed = [one(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p[0] for p in parsed], pa.string()), pa.array([p[1] for p in parsed], BLOCK_TYPE), pa.array([p[2] for p in parsed], pa.string())],
                [key, "title_hint", "blocks", "error"],
            )

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, html).mapInArrow(run, f"{key} {kind}, title_hint string, blocks {BLOCK_DDL}, error string")
