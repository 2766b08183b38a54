"""Operator 4: SentencePiece encoding and decoding.

Unigram segmentation: the best-scoring cut of a text into pieces by a Viterbi
pass over a double-array trie of the vocabulary's pieces with their scores.
Characters without a piece fall back to byte pieces.  Spaces become the marker
U+2581, one marker goes before the text, and decoding undoes both.

No piece runs past the start of a new marked word, so words are segmented one
by one and a worker does each different word once.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Bytes from which a word's tables are packed.
LONG = 1 << 16


class DoubleArray:
    """A trie over bytes in two arrays: child of state s by byte b is t = base[s] + b + 1 if check[t] == s.

    The end of a key is a child by "byte" -1, whose base holds the key's value.
    """

    def __init__(self, keys: dict[bytes, int]):
        tree: dict = {}
        for key, value in keys.items():
            node = tree
            for b in key:
                node = node.setdefault(b, {})
            node[-1] = value
        base, check, taken, low = [0], [-1], [True], 1
        stack = [(0, tree)]
        while stack:
            state, node = stack.pop()
            codes = sorted(c + 1 for c in node)
            while low < len(taken) and taken[low]:
                low += 1
            at = max(low - codes[0], 1)
            if len(codes) > 1:
                while any(at + c < len(taken) and taken[at + c] for c in codes):
                    at += 1
            else:
                while at + codes[0] < len(taken) and taken[at + codes[0]]:
                    at += 1
            grow = at + codes[-1] + 1 - len(taken)
            if grow > 0:
                base += [0] * grow
                check += [-1] * grow
                taken += [False] * grow
            base[state] = at
            for c in codes:
                taken[at + c] = True
                check[at + c] = state
                if c:
                    stack.append((at + c, node[c - 1]))
                else:
                    base[at] = node[-1]
        pad = max(base, default=0) + 1 - len(check)  # every base is then a valid place to look
        self.base, self.check = base + [0] * pad, check + [-1] * pad

    def prefixes(self, data: bytes, start: int):
        """(end, value) of every key that begins at ``start``, shortest first."""
        base, check, state, size = self.base, self.check, 0, len(self.check)
        for i in range(start, len(data)):
            to = base[state] + data[i] + 1
            if to >= size or check[to] != state:
                return
            state = to
            end = base[state]
            if end < size and check[end] == state:
                yield i + 1, base[end]


class Unigram:
    """Vocabulary, trie and this worker's known words."""

    def __init__(self, pieces: list[tuple[str, float, str]], limit: int = 400_000):
        """pieces: (piece, score, kind) by id; kind is normal, byte, control or unknown."""
        self.pieces = pieces
        self.bytes_of, self.ids_of_bytes = {}, [0] * 256
        keys = {}
        for i, (piece, _, kind) in enumerate(pieces):
            if kind == "byte":
                value = int(piece[3:5], 16)
                self.bytes_of[i], self.ids_of_bytes[value] = bytes([value]), i
            elif kind == "normal":
                keys[piece.encode()] = i
                self.bytes_of[i] = piece.encode()
        self.has_bytes = sum(kind == "byte" for _, _, kind in pieces) == 256
        self.unknown = next((i for i, p in enumerate(pieces) if p[2] == "unknown"), 0)
        self.scores = [p[1] for p in pieces]
        self.trie = DoubleArray(keys)
        self.low = min((self.scores[i] for i in keys.values()), default=0.0) - UNKNOWN_PENALTY
        #: Words can be cut off before a marker only if no piece holds one after another character.
        self.by_word = not any(MARK in p.lstrip(MARK) for p, _, k in pieces if k == "normal")
        self.words = _LINES if not any("\n" in p for p, _, k in pieces if k == "normal") else _WORDS
        self.limit, self.known, self.old = limit, {}, {}

    def segment(self, text: str) -> list[int]:
        """Ids of the best cut; among equal scores, the one whose last piece begins first."""
        data = text.encode("utf-8", "surrogatepass")
        n = len(data)
        # Lists are faster, arrays take 20 bytes for a byte of a very long word.
        best, back, piece = ([x] * (n + 1) if n < LONG else array(k, [x]) * (n + 1) for k, x in (("d", float("-inf")), ("q", 0), ("i", -1)))
        best[0], at = 0.0, 0
        base, check, scores, size = self.trie.base, self.trie.check, self.scores, len(self.trie.check)
        while at < n:
            first, here, single = data[at], best[at], False
            width = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
            state, end = 0, at
            # The walk of DoubleArray.prefixes, written out: this is the inner loop.
            while end < n:
                to = base[state] + data[end] + 1
                if to >= size or check[to] != state:
                    break
                state, end = to, end + 1
                leaf = base[to]
                if check[leaf] == to:
                    i = base[leaf]
                    score = here + scores[i]
                    if score > best[end]:
                        best[end], back[end], piece[end] = score, at, i
                    if end == at + width:
                        single = True
            at += width
            if not single and here + self.low > best[at]:
                best[at], back[at], piece[at] = here + self.low, at - width, -1
        out = []
        while n:
            start, i = back[n], piece[n]
            if i >= 0:
                out.append(i)
            elif self.has_bytes:
                out += [self.ids_of_bytes[b] for b in reversed(data[start:n])]
            else:
                out.append(self.unknown)
            n = start
        return out[::-1]

    def _word(self, word: str) -> bytes:
        ids = self.known.get(word) or self.old.get(word)
        if ids is None:
            ids = array("I", self.segment(word)).tobytes()
        if word not in self.known and len(word) <= 64:
            if len(self.known) >= self.limit:
                self.old, self.known = self.known, {}
            self.known[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; the empty text has none."""
        if not text:
            return b""
        marked = MARK + text.replace(" ", MARK)
        words = self.words.findall(marked) if self.by_word else [marked]
        known, word = self.known, self._word
        return b"".join([known.get(w) or word(w) for w in words])

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: bytes are joined, markers become spaces, and the one before the text goes."""
        table = self.bytes_of
        text = b"".join([table.get(i, b"") for i in ids.tolist()]).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text[:1] == " " else text


#: Words with their markers; where no piece holds a line feed, lines are cut as well.
_WORDS = re.compile(f"{MARK}+[^{MARK}]*")
_LINES = re.compile(f"{MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+")


def load_pieces(model_file: str) -> list[tuple[str, float, str]]:
    """(piece, score, kind) of every id in a SentencePiece model file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    kinds = defaultdict(lambda: "normal")
    for i in range(sp.get_piece_size()):
        kinds[i] = "unknown" if sp.is_unknown(i) else "control" if sp.is_control(i) or sp.is_unused(i) else "byte" if sp.is_byte(i) else "normal"
    return [(sp.id_to_piece(i), sp.get_score(i), kinds[i]) for i in range(sp.get_piece_size())]


_OWN: dict[str, Unigram] = {}


def _model(model_file: str) -> Unigram:
    """This worker's model for a file; it is built once per worker."""
    if model_file not in _OWN:
        _OWN[model_file] = Unigram(load_pieces(model_file))
    return _OWN[model_file]


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, ids) with ids as an array of int; null texts count as empty."""

    def run(batches):
        own = _model(model_file)
        for batch in batches:
            ids = [np.frombuffer(own.encode(t.as_py() or ""), "<u4").astype(np.int32) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give the empty text."""

    def run(batches):
        own = _model(model_file)
        for batch in batches:
            texts = [own.decode(np.array(x.as_py() or [], np.int64)) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip_report(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_tokens, n_bytes (byte pieces), ids_crc32, score, round_trip for every row.

    Every whole text is encoded and decoded again; round_trip is true if that
    gives the text back (with U+2581, the marker itself, read as a space).
    Null texts count as empty and have no ids.  Repeated rows each get a row;
    an empty table gives none; further columns are ignored.
    """
    names = ["doc_id", "n_tokens", "n_bytes", "ids_crc32", "score", "round_trip"]

    def run(batches):
        own = _model(model_file)
        scores = np.array(own.scores)
        byte = np.zeros(len(scores), bool)
        byte[[i for i, p in enumerate(own.pieces) if p[2] == "byte"]] = True
        for batch in batches:
            rows = []
            for t in batch.column(1):
                text = t.as_py() or ""
                body = own.encode(text)
                ids = np.frombuffer(body, "<u4")
                rows.append((len(ids), int(byte[ids].sum()), zlib.crc32(body), float(scores[ids].sum()), own.decode(ids) == text.replace(MARK, " ")))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, n_bytes long, ids_crc32 long, score double, round_trip boolean")
