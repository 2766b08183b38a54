"""Markdown files as blocks: headings, paragraphs, pipe tables and code, with inline marks taken off."""

from __future__ import annotations

import html
import re

# Tags that begin a block of raw HTML, which is left out.
HTML_BLOCKS = (
    "address article aside base basefont blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frame frameset h1 h2 h3 h4 h5 h6 head header hr html iframe legend li link main menu menuitem nav noframes ol optgroup option p param search section "
    "summary table tbody td tfoot th thead title tr track ul script pre style textarea"
).split()
#: How deep quotes and lists are read.
NESTED = 100
PUNCTUATION = r"""!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~"""
_RAW = re.compile(rf" {{0,3}}(?:</?(?:{'|'.join(HTML_BLOCKS)})(?:[\s/>]|$)|<!--|<\?|<![A-Za-z]|</?[A-Za-z][A-Za-z0-9-]*(?:\s[^<>]*)?/?>\s*$)", re.I)
_ATX = re.compile(r" {0,3}(#{1,6})(?:[ \t]+(.*?))?(?:[ \t]+#+)?[ \t]*$")
_RULE = re.compile(r" {0,3}(?:(?:\*[ \t]*){3,}|(?:-[ \t]*){3,}|(?:_[ \t]*){3,})$")
_FENCE = re.compile(r"( {0,3})(`{3,}(?=[^`]*$)|~{3,})")
_ITEM = re.compile(r"( {0,3})([-+*]|\d{1,9}[.)])( {1,4}(?! )| (?= {4})|(?=$))")
_TABLE_RULE = re.compile(r"^ {0,3}\|?[ \t]*:?-+:?[ \t]*(?:\|[ \t]*:?-+:?[ \t]*)*\|?[ \t]*$")
_DEFINITION = re.compile(r" {0,3}\[([^\[\]]+)\]:\s*\S+(?:\s+(?:\"[^\"]*\"|'[^']*'|\([^()]*\)))?\s*$")
_INLINE = re.compile(
    rf"(?P<escape>\\[{PUNCTUATION}])|(?P<code>(?<!`)(`+)(?!`)(?P<body>.+?)(?<!`)\3(?!`))|<(?P<auto>[A-Za-z][A-Za-z0-9+.-]{{1,31}}:[^\s<>]*|[\w.+-]+@[\w.-]+)>"
    r"|(?P<tag></?[A-Za-z][A-Za-z0-9-]*(?:\s[^<>]*)?/?>|<!--.*?-->)|(?P<entity>&(?:[A-Za-z][A-Za-z0-9]{1,31}|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});)"
    r"|(?P<image>!\[[^\[\]]*\]\((?:[^()\s]|\([^()]*\))*(?:\s+\"[^\"]*\")?\))|\[(?P<link>(?:[^\[\]]|\[[^\[\]]*\])*)\]\((?:[^()\s]|\([^()]*\))*(?:\s+\"[^\"]*\")?\)"
    r"|\[(?P<named>[^\[\]]+)\](?:\[(?P<label>[^\[\]]*)\])?|(?P<run>\*+|_+)|(?P<break>\\?\n)", re.S,
)


def _marks(parts: list) -> None:
    """Turn runs of emphasis signs that pair up into boundaries; parts are texts, None (boundary), or [sign, count, opens, closes, length, paired].

    ``bottom`` keeps up to where a closer of a kind has looked in vain, so no stretch is searched twice.
    """
    openers: list[int] = []
    bottom: dict[tuple, int] = {}
    for k, closer in enumerate(parts):
        if not isinstance(closer, list):
            continue
        kind = (closer[0], closer[2], closer[4] % 3)
        while closer[3] and closer[1]:
            for s in range(len(openers) - 1, -1, -1):
                if openers[s] <= bottom.get(kind, -1):
                    s = -1
                    break
                opener = parts[openers[s]]
                odd = (opener[3] or closer[2]) and (opener[4] + closer[4]) % 3 == 0 and (opener[4] % 3 or closer[4] % 3)
                if opener[0] == closer[0] and not odd:
                    break
            else:
                s = -1
            if s < 0:
                bottom[kind] = k - 1
                break
            used = 2 if min(opener[1], closer[1]) > 1 else 1
            opener[1] -= used
            closer[1] -= used
            opener[5] = closer[5] = True
            del openers[s + bool(opener[1]) :]
        if closer[2] and closer[1]:
            openers.append(k)


def plain(text: str, labels: frozenset[str] = frozenset()) -> str:
    """A line of inline Markdown as text: its pieces between marks, joined by single spaces."""
    parts: list = []
    at = 0

    def literal(s: str) -> None:
        if parts and isinstance(parts[-1], str):
            parts[-1] += s
        elif s:
            parts.append(s)

    for m in _INLINE.finditer(text):
        literal(text[at : m.start()])
        at = m.end()
        if m["escape"]:
            literal(m["escape"][1])
        elif m["entity"]:
            literal(html.unescape(m["entity"]))
        elif m["code"]:
            parts += [None, m["body"].replace("\n", " ").strip() or m["body"], None]
        elif m["auto"]:
            parts += [None, m["auto"], None]
        elif m["tag"] or m["break"] or m["image"]:
            parts.append(None)
        elif m["link"] is not None:
            parts += [None, plain(m["link"], labels), None]
        elif m["named"]:
            if (m["label"] or m["named"]).casefold() in labels:
                parts += [None, plain(m["named"], labels), None]
            else:
                literal(m[0])
        else:
            before, after = text[m.start() - 1 : m.start()] or " ", text[m.end() : m.end() + 1] or " "
            sign = re.compile(f"[{PUNCTUATION}]")
            left = not after.isspace() and (not sign.match(after) or before.isspace() or bool(sign.match(before)))
            right = not before.isspace() and (not sign.match(before) or after.isspace() or bool(sign.match(after)))
            if m["run"][0] == "_":
                left, right = left and (not right or bool(sign.match(before))), right and (not left or bool(sign.match(after)))
            parts.append([m["run"][0], len(m["run"]), left, right, len(m["run"]), False])
    literal(text[at:])
    _marks(parts)
    out = ""
    for p in parts:
        out += p if isinstance(p, str) else " " if p is None else " " + p[0] * p[1] + " " if p[5] and p[1] else " " if p[5] else p[0] * p[1]
    return " ".join(out.split())


def _cells(line: str) -> list[str]:
    line = line.strip()
    line = line[1:] if line.startswith("|") else line
    line = line[:-1] if line.endswith("|") and not line.endswith("\\|") else line
    return [c.replace("\\|", "|").strip() for c in re.split(r"(?<!\\)\|", line)]


class _Reader:
    """Blocks of one file, in order."""

    def __init__(self, list_items: bool):
        self.list_items, self.blocks, self.level, self.labels = list_items, [], None, set()

    def emit(self, kind: str, raw: str, level: int | None = None) -> None:
        self.level = level or self.level  # an empty heading leaves its level to what follows
        text = plain(raw, frozenset(self.labels))
        if text:
            self.blocks.append({"kind": kind, "text": text, "level": self.level})
            self.level = None

    def verbatim(self, lines: list[str]) -> None:
        content = "\n".join(lines)
        if content.strip():
            self.blocks.append({"kind": "paragraph", "text": f"```\n{content.rstrip()}\n```", "level": None})

    def table(self, head: list[str], rows: list[list[str]]) -> None:
        lines = ["| " + " | ".join(plain(c, frozenset(self.labels)) for c in (r + [""] * len(head))[: len(head)]) + " |" for r in [head, *rows]]
        rule = ["|" + "---|" * (lines[0].count("|") - 1)] if rows else []
        self.blocks.append({"kind": "table", "text": "\n".join([lines[0], *rule, *lines[1:]]), "level": None})

    def ends_paragraph(self, line: str) -> bool:
        item = _ITEM.match(line)
        return bool(
            not line.strip() or _ATX.match(line) or _RULE.match(line) or _FENCE.match(line) or line.lstrip(" ").startswith(">") and len(line) - len(line.lstrip(" ")) < 4
            or (item and line[item.end() :].strip() and (not item[2][0].isdigit() or item[2][:-1] == "1")) or (_RAW.match(line) and not line.rstrip().endswith(">") or re.match(r" {0,3}</?(?:div|table|p|ul|ol|pre|h[1-6]|script|style)[\s/>]", line, re.I))
        )

    def read(self, lines: list[str], item: bool = False, depth: int = 0) -> None:
        if depth > NESTED:  # what is nested deeper is text
            self.emit("paragraph", "\n".join(x.strip() for x in lines))
            return
        kind, k = "list_item" if item and self.list_items else "paragraph", 0
        while k < len(lines):
            line = lines[k]
            if not line.strip():
                k += 1
            elif line.startswith("    ") or line.startswith("\t"):
                end = k
                while end < len(lines) and (not lines[end].strip() or lines[end][:4].strip() == "" and len(lines[end]) >= 4 or lines[end].startswith("\t")):
                    end += 1
                self.verbatim([x[1:] if x.startswith("\t") else x[4:] for x in lines[k:end]])
                k = end
            elif m := _FENCE.match(line):
                end, close = k + 1, re.compile(rf" {{0,3}}{re.escape(m[2][0])}{{{len(m[2])},}}[ \t]*$")
                while end < len(lines) and not close.match(lines[end]):
                    end += 1
                self.verbatim([re.sub(f"^ {{0,{len(m[1])}}}", "", x) for x in lines[k + 1 : end]])
                k = end + 1
            elif m := _ATX.match(line):
                self.emit("heading", m[2] or "", len(m[1]))
                k += 1
            elif _RULE.match(line):
                k += 1
            elif line.lstrip(" ").startswith(">"):
                own, k = self.quoted(lines, k)
                self.read(own, depth=depth + 1)
            elif m := _ITEM.match(line):
                own, k = self.listed(lines, k, m)
                self.read(own, item=True, depth=depth + 1)
            elif _RAW.match(line):
                stop = "-->" if line.lstrip().startswith("<!--") else None
                while k < len(lines) and (lines[k].strip() if stop is None else stop not in lines[k]):
                    k += 1
                k += stop is not None
            elif k + 1 < len(lines) and "|" in line and _TABLE_RULE.match(lines[k + 1]) and len(_cells(line)) == len(_cells(lines[k + 1])):
                end = k + 2
                while end < len(lines) and lines[end].strip() and not (_ATX.match(lines[end]) or _FENCE.match(lines[end]) or _RULE.match(lines[end]) or _ITEM.match(lines[end])):
                    end += 1
                self.table(_cells(line), [_cells(x) for x in lines[k + 2 : end]])
                k = end
            elif m := _DEFINITION.match(line):
                self.labels.add(m[1].casefold())
                k += 1
            else:
                end, level = k + 1, None
                while end < len(lines):
                    if m := re.match(r" {0,3}(=+|-+)[ \t]*$", lines[end]):
                        level = 1 if m[1][0] == "=" else 2
                        break
                    if self.ends_paragraph(lines[end]):
                        break
                    end += 1
                raw = "\n".join(x.strip() for x in lines[k:end])
                self.emit("heading" if level else kind, raw, level)
                kind, k = "paragraph", end + (level is not None)

    def quoted(self, lines: list[str], k: int) -> tuple[list[str], int]:
        own = []
        while k < len(lines) and lines[k].strip():
            m = re.match(r" {0,3}> ?", lines[k])
            if not m and (self.ends_paragraph(lines[k]) or not own or not own[-1].strip()):
                break
            own.append(lines[k][m.end() :] if m else lines[k].strip())
            k += 1
        return own, k

    def listed(self, lines: list[str], k: int, m: re.Match) -> tuple[list[str], int]:
        """Lines of one list item without their indent."""
        indent = len(m[1]) + len(m[2]) + max(1, len(m[3]))
        own = [lines[k][m.end() :] if m[3] else ""]
        k += 1
        while k < len(lines):
            line = lines[k]
            if not line.strip():
                own.append("")
            elif line[:indent].strip() == "":
                own.append(line[indent:])
            elif own[-1].strip() and not self.ends_paragraph(line) and not _ITEM.match(line):
                own.append(line.strip())  # the paragraph goes on without its indent
            else:
                break
            k += 1
        return own, k


def parse_markdown(source: str, list_items: bool = False) -> tuple[list[dict], str | None, dict[str, str]]:
    """Blocks, title hint (the first heading of level 1) and no further hints.

    A list item's text is a paragraph unless ``list_items`` asks for list items.
    """
    reader = _Reader(list_items)
    lines = source.replace("\r\n", "\n").replace("\r", "\n").replace("\x00", "�").split("\n")
    for line in lines:
        if m := _DEFINITION.match(line):
            reader.labels.add(m[1].casefold())
    reader.read([x.expandtabs(4) if x[:1] in " \t" else x for x in lines])
    return reader.blocks, next((b["text"] for b in reader.blocks if b["kind"] == "heading" and b["level"] == 1), None), {}
