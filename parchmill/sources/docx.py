"""Word documents as blocks, read from the package's own XML in body order."""

from __future__ import annotations

import io
import re
import struct
import zipfile
import zlib
from collections.abc import Callable
from functools import lru_cache
from xml.etree import ElementTree

from .html import pipe_table

# XML namespaces of the format, and how styles and hand-made headings are told.
W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
DC = "{http://purl.org/dc/elements/1.1/}"
HEADING, LISTED = re.compile(r"heading\s*(\d)$", re.I), re.compile("list|bullet", re.I)
BOLD_CHARS, NOT_HEADING = 80, (".", ":", ";")
SIGNS = {W + "tab": "\t", W + "br": "\n", W + "cr": "\n"}
P, R, T, TABLE, ROW, CELL = (W + x for x in ("p", "r", "t", "tbl", "tr", "tc"))
STYLE_OF, STYLE, BOLD_OF, BOLD, VALUE, CELL_PROPERTIES = (W + x for x in ("pPr", "pStyle", "rPr", "b", "val", "tcPr"))
#: Bytes of a list of styles that is kept for the next file at most.
KEPT_STYLES = 1 << 16


def _text(paragraph) -> str:
    return "".join([e.text or "" if e.tag == T else SIGNS.get(e.tag, "") for e in paragraph.iter()])


def _within(element, outer: str, inner: str):
    """The first ``inner`` of the element's ``outer`` children (plain tags are found without a path)."""
    for o in element.findall(outer):
        if (found := o.find(inner)) is not None:
            return found
    return None


def _bold(run) -> bool:
    mark = _within(run, BOLD_OF, BOLD)
    return mark is not None and mark.get(VALUE, "1") not in ("0", "false", "off")


@lru_cache(1024)
def _styled(style: str) -> tuple[int | None, bool]:
    """A style's level, if it is a heading's, and whether it is a list's."""
    level = min(int(m[1]), 6) if (m := HEADING.match(style)) else {"title": 1, "subtitle": 2}.get(style.lower())
    return level, LISTED.search(style) is not None


def _hand_made(paragraph, text: str) -> bool:
    """A short line, all bold, that doesn't end like a sentence."""
    if len(text) > BOLD_CHARS or text.rstrip().endswith(NOT_HEADING):
        return False
    runs = paragraph.findall(R)
    return bool(runs) and all(_bold(r) or not _text(r).strip() for r in runs)


def _plain_rows(table) -> list[list[str]] | None:
    """Cell texts by row of a table that holds nothing but rows, cells and paragraphs of text, in one walk; else None."""
    rows, cell = [], None
    for e in table.iter():
        tag = e.tag
        if tag == R:
            continue
        if tag == T and cell is not None:
            cell.append(e.text or "")
        elif tag == P and cell is not None:
            cell.append(" ")
        elif tag == CELL and rows:
            cell = []
            rows[-1].append(cell)
        elif tag == ROW:
            rows.append([])
            cell = None
        elif e is not table:
            return None
    if len(rows) != len(table) or any(len(tr) != len(r) for tr, r in zip(table, rows)):
        return None
    return [[" ".join("".join(c).split()) for c in r] for r in rows]


def _rows(table) -> list[list[str]]:
    """Cell texts by row; a cell that spans columns or rows is repeated."""
    if (plain := _plain_rows(table)) is not None:
        return plain
    rows: list[list[str]] = []
    for tr in table.findall(ROW):
        row: list[str] = []
        for tc in tr.findall(CELL):
            text = " ".join(" ".join([_text(p) for p in tc.findall(P)]).split())
            if tc.find(CELL_PROPERTIES) is None:
                row.append(text)
                continue
            span, merged = _within(tc, CELL_PROPERTIES, W + "gridSpan"), _within(tc, CELL_PROPERTIES, W + "vMerge")
            if merged is not None and merged.get(W + "val", "continue") == "continue" and rows and len(row) < len(rows[-1]):
                text = rows[-1][len(row)]
            row += [text] * int(span.get(W + "val") if span is not None else 1)
        rows.append(row)
    return rows


def _plain_package(content: bytes) -> Callable[[str], bytes | None] | None:
    """A reader of a package's members by name, or None for a package that isn't of the plainest kind.

    The plainest kind has one directory right before its end, and members that
    are stored or deflated and whose sizes and checksums hold.  Anything else
    is left to the library, which also says what is wrong.
    """
    end, members, places = len(content) - 22, {}, []
    if end < 0 or content[end : end + 4] != b"PK\5\6":
        return None
    disk, first, here, n, size, at, comment = struct.unpack_from("<4H2IH", content, end + 4)
    if disk or first or here != n or comment or at + size != end:
        return None
    directory = at
    for _ in range(n):
        if at + 46 > end:
            return None
        signature, version, flags, method, crc, packed, plain, n_name, n_extra, n_comment, place = struct.unpack_from("<I2xBx2H4x3I3H8xI", content, at)
        name = content[at + 46 : at + 46 + n_name]
        if signature != 0x02014B50 or version > 20 or n_extra or flags & ~0x80E or method not in (0, 8) or not name.isascii() or b"\0" in name:
            return None
        members[name.decode()] = name, method, crc, packed, plain, place
        places.append(place)
        at += 46 + n_name + n_comment
    places.sort()
    room = dict(zip(places, [*places[1:], directory]))
    if at != end or len(room) != n:
        return None
    texts = {}
    for wanted in ("word/document.xml", "word/styles.xml", "docProps/core.xml"):
        if wanted in members:
            name, method, crc, packed, plain, place = members[wanted]
            if content[place : place + 4] != b"PK\3\4" or content[place + 30 : place + 30 + len(name)] != name:
                return None
            start = place + 30 + sum(struct.unpack_from("<2H", content, place + 26))
            if start + packed > room[place]:  # members that overlap
                return None
            data = content[start : start + packed]
            if method:
                try:
                    data = zlib.decompressobj(-15).decompress(data, plain + 1)
                except zlib.error:
                    return None
            if len(data) != plain or zlib.crc32(data) != crc:
                return None
            texts[wanted] = data
    return texts.get if "word/document.xml" in texts else None


def _any_package(content: bytes) -> Callable[[str], bytes | None]:
    with zipfile.ZipFile(io.BytesIO(content)) as package:
        names = set(package.namelist())
        texts = {n: package.read(n) for n in ("word/document.xml", "word/styles.xml", "docProps/core.xml") if n in names or n == "word/document.xml"}
    return texts.get


def _styles(xml: bytes) -> dict[str | None, str | None]:
    """Names of styles by their ids."""
    styles = {}
    for s in ElementTree.fromstring(xml).findall(W + "style"):
        name = s.find(W + "name")
        styles[s.get(W + "styleId")] = name.get(W + "val") if name is not None else ""
    return styles


_known_styles = lru_cache(64)(_styles)


def parse_docx(content: bytes) -> tuple[list[dict], str | None, dict[str, str]]:
    """Blocks, title hint (first heading of level 1, else the file's title) and the file's title and subject."""
    member = _plain_package(content) or _any_package(content)
    body = ElementTree.fromstring(member("word/document.xml")).find(W + "body")
    styles, hints = {}, {}
    default = "Normal"
    if (xml := member("word/styles.xml")) is not None:
        styles = (_known_styles if len(xml) <= KEPT_STYLES else _styles)(xml)
    if (xml := member("docProps/core.xml")) is not None:
        core = ElementTree.fromstring(xml)
        hints = {k: e.text for k in ("title", "subject") if (e := core.find(DC + k)) is not None and e.text}
    blocks = []
    for item in body if body is not None else ():
        if item.tag == TABLE:
            block = {"kind": "table", "text": pipe_table(_rows(item)), "level": None}
        elif item.tag == P:
            raw, named = _text(item), _within(item, STYLE_OF, STYLE)
            level, listed = _styled((styles.get(named.get(VALUE), default) if named is not None else default).strip())
            text = " ".join(raw.split())
            level = (level or (2 if _hand_made(item, raw) else None)) if text else None
            block = {"kind": "heading" if level else "list_item" if listed else "paragraph", "text": text, "level": level}
        else:
            continue
        if block["text"]:
            blocks.append(block)
    return blocks, next((b["text"] for b in blocks if b["level"] == 1), None) or hints.get("title"), hints
