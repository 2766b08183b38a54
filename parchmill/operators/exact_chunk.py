"""Chunks by exact token counts: every size is that of the assembled text, so no chunk but a table is above the ceiling.

Tokens of joined texts aren't the sum of their parts' tokens (merges cross the
joints), so the fold measures what it would write, breadcrumb and markers included.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from .chunk import AGAIN, BELOW, _sections, sentences, shared_prefix

Count = Callable[[str], int]


def breadcrumb(name: str, path: list[str], maximum: int, count: Count) -> str:
    """Document name and the headings that differ from it, cut word by word to half the ceiling."""
    words = " > ".join([name, *(p for p in path if p.casefold() != name.casefold())]).split()
    most = max(1, maximum // 2)
    while len(words) > 1 and count(" ".join(words)) > most:
        words.pop()
    return _fit(" ".join(words), lambda t: count(t) <= most)


def _fit(text: str, fits: Callable[[str], bool]) -> str:
    """The longest beginning that fits, by halving; one sign at least where there is one."""
    if not text or fits(text):
        return text
    low, high = 1, len(text)
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if fits(text[:middle]) else (low, middle)
    return text[:low]


def _parts(block: dict, fits: Callable[[str], bool]) -> Iterator[str]:
    """A block's text if it fits, else its sentences; sentences that don't fit by words, and words by signs."""
    text = block["text"]
    if fits(text) or block["kind"] == "table":
        yield text
        return
    for sentence in sentences(text) or [text]:
        while sentence and not fits(sentence):
            words = sentence.split(" ")
            low, high = 1, len(words)
            while high - low > 1:
                middle = (low + high) // 2
                low, high = (middle, high) if fits(" ".join(words[:middle])) else (low, middle)
            head = _fit(" ".join(words[:low]), fits)
            yield head
            sentence = sentence[len(head) :].lstrip()
        if sentence:
            yield sentence


def _units(blocks: list[dict], fits: Callable[[str], bool]) -> list[tuple[str, str, bool, dict]]:
    """(joint before it, text, is part of something cut, block): list runs and blocks whole where they fit, else items, sentences, words."""
    out, i = [], 0
    while i < len(blocks):
        j = i + 1
        while blocks[i]["kind"] == "list_item" and j < len(blocks) and blocks[j]["kind"] == "list_item":
            j += 1
        own, i = blocks[i:j], j
        if len(own) > 1 and not fits("\n\n".join(b["text"] for b in own)):
            out += [("\n\n" if k == 0 else " ", t, True, b) for b in own for k, t in enumerate(_parts(b, fits))]
        else:
            for b in own:
                parts = list(_parts(b, fits))
                out += [("\n\n" if k == 0 else " ", t, len(parts) > 1, b) for k, t in enumerate(parts)]
    return out


def _body(units: list[tuple[str, str, bool, dict]], ends: bool) -> str:
    """Units joined; the mark says that what was cut goes on."""
    text = "".join((joint if k else "") + t for k, (joint, t, _, _) in enumerate(units))
    return f"{text}\n{BELOW}" if units[-1][2] and not ends else text


def _cut(blocks: list[dict], whole: Callable[[str], int], count: Count, target: int, overlap: int, maximum: int) -> list[tuple[str, list[dict]]]:
    """Bodies of a section above the ceiling; ``whole`` is the size of a body with its breadcrumb."""
    units = _units(blocks, lambda t: whole(f"{t}\n{BELOW}") <= maximum)
    last_of = [k + 1 == len(units) or units[k + 1][3] is not u[3] and not (units[k + 1][2] and u[2]) for k, u in enumerate(units)]
    groups: list[tuple[int, int]] = []
    begin = 0
    for k in range(1, len(units) + 1):
        if k == len(units) or whole(_body(units[begin : k + 1], last_of[k])) > target:
            groups.append((begin, k))
            begin = k
    out: list[tuple[str, list[dict]]] = []
    for begin, end in groups:
        body = _body(units[begin:end], last_of[end - 1])
        if out and overlap:
            body = _led(out[-1][0], body, whole, count, overlap, maximum)
        out.append((body, [u[3] for u in units[begin:end]]))
    return out


def _led(before: str, body: str, whole: Callable[[str], int], count: Count, overlap: int, maximum: int) -> str:
    """``body`` behind as many whole sentences from the end of the body before it as overlap and ceiling allow."""
    taken: list[str] = []
    for s in reversed(sentences(before.removesuffix(BELOW).rstrip())):
        lead = f"{AGAIN} {' '.join([s, *taken])}"
        if count(lead) > overlap or whole(f"{lead}\n\n{body}") > maximum:
            break
        taken.insert(0, s)
    return f"{AGAIN} {' '.join(taken)}\n\n{body}" if taken else body


def chunk_bodies(name: str, blocks: list[dict], count: Count, target: int, overlap: int, maximum: int) -> list[tuple[list[str], str, list[dict]]]:
    """(path, body, blocks) of a document's chunks, as ``chunk.chunk_bodies`` makes them but by ``count`` of whole texts.

    Packed sections count with their heading lines.  A sentence above the
    ceiling is cut between words, a word between signs; a table never.
    """
    def sized(path: list[str]) -> Callable[[str], int]:
        line = breadcrumb(name, path, maximum, count)
        return lambda body: count(f"{line}\n\n{body}" if line else body)

    def assembled(path: list[str], members: list) -> str:
        texts = ["\n\n".join(b["text"] for b in own) for _, own in members]
        if len(members) > 1:
            heads = [" > ".join(p[len(path) :]) for p, _ in members]
            texts = [f"{h}\n{t}" if h else t for h, t in zip(heads, texts)]
        return "\n\n".join(texts)

    groups: list[tuple[list[str], list]] = []
    for path, own in _sections(blocks):
        if groups and (common := shared_prefix(groups[-1][0], path)):
            members = [*groups[-1][1], (path, own)]
            if sized(common)(assembled(common, members)) <= target:
                groups[-1] = (common, members)
                continue
        groups.append((path, [(path, own)]))
    out: list[tuple[list[str], str, list[dict]]] = []
    for path, members in groups:
        body, whole = assembled(path, members), sized(path)
        if whole(body) <= maximum:
            out.append((path, body, [b for _, own in members for b in own]))
        else:
            out += [(path, b, own) for b, own in _cut(members[0][1], whole, count, target, overlap, maximum)]
    return out
