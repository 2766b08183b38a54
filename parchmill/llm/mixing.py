"""Operator 7: language-model scoring by online logistic context mixing.

A text is predicted bit by bit.  Each byte is a path of binary decisions in a
code tree chosen by the byte before it; the first decision says whether a word
ends here.  For every decision, predictors with hashed contexts (the last byte,
the last three bytes, and the word so far, or at a word's start the word
before) give log odds; a mixer adds them with weights chosen by a gate (how sure
the two longer contexts are), and an adaptive probability map refines the sum.
A word's probability by these bits is mixed with its share in the training
text, whose weight is the chance of a known word, so what scoring gathers grows
with the corpus: every training word's count travels to the texts that hold it.

Inside a word the contexts don't look beyond its start.  So a task evaluates
each different word once per chunk of texts, with its number of occurrences as
weight while learning, and each different first letter after the same word and
separator once per block.

Learning is online inside each task: every block of decisions is predicted with
the counts gathered so far, which moves the mixer's weights and the map, and
then adds its own counts.  Counts and map add up over tasks and the weights are
averaged, so the merged bit model has a fixed size while everything it holds
comes from the whole training text.  Scoring uses it as it is, so equal texts
score alike.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from .common import by_bucket, crc32_of_id, materialize, partitions

#: Logarithms of the table sizes of the two hashed predictors (three bytes; the word).  The context of one byte needs no hash.
BITS = (20, 21)
#: The symbol that starts and ends a text.
EDGE, SYMBOLS = 256, 257
#: The bytes that separate words.
SPACES = bytes([9, 10, 11, 12, 13, 32])
#: Texts of about CHUNK_BYTES share a vocabulary; BLOCK_SYMBOLS are evaluated at once; a learning slice has at most SLICE words.
CHUNK_BYTES, BLOCK_SYMBOLS, SLICE = 16 << 20, 1 << 13, 1 << 19
#: The vocabulary is split into ranges of words, one for so many bytes of text or more.
RANGE_BYTES = 256 << 20
#: The context of the word so far starts afresh after so many bytes of one word.
PART = 1 << 12
GATES, MAP = 64, 33
#: Table entries in a row of the merged model.
BLOCK = 1 << 15
PRIOR = 0.4
#: No decision is ever surer than this, in either direction, so the two sides still add up to one.
FLOOR = np.float32(1e-6)
#: The first two words of every chunk's vocabulary: the end of a text as a token, and the empty word between two spaces.
END, EMPTY = b" ", b""

_HASH = (np.uint64(0x9E3779B97F4A7C15), np.uint32(0x85EBCA6B), np.uint32(0x9E3779B1))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
#: Separators by a number below 8, for pairs of a word and what comes after it.
_SEPARATOR = np.array([*SPACES, EDGE], np.uint16)
_NUMBER = np.zeros(SYMBOLS, np.int64)
_NUMBER[_SEPARATOR] = np.arange(len(_SEPARATOR))
_TO_SPACE = bytes(32 if _IS_SPACE[b] else b for b in range(256))
with np.errstate(over="ignore"):
    _POWER = np.cumprod(np.full(PART, 0xD6E8FEB86659FD93, np.uint64))


@dataclass
class Codes:
    """Paths of all (previous, symbol) pairs: where they begin, how long they are, and their decisions."""

    start: np.ndarray
    size: np.ndarray
    node: np.ndarray
    bit: np.ndarray


def build_codes(pairs: np.ndarray) -> Codes:
    """Per previous symbol, a decision between word end and letter, and a Huffman tree below each, from counts of pairs."""
    start, size, node, bit = np.zeros(SYMBOLS * SYMBOLS, np.int64), np.zeros(SYMBOLS * SYMBOLS, np.int64), [], []
    overall = pairs.sum(0)
    ends = [*SPACES, EDGE]
    letters = [s for s in range(256) if s not in SPACES]
    for prev in range(SYMBOLS):
        counts = pairs[prev] if pairs[prev].sum() else overall
        least = max(1, int(counts.sum()) >> 13)  # no path gets longer than about 20
        up, inner, roots = {}, SYMBOLS, []
        for side in (letters, ends):
            heap = [(max(int(counts[s]), least), s) for s in side]
            heapq.heapify(heap)
            while len(heap) > 1:
                a, b = heapq.heappop(heap), heapq.heappop(heap)
                up[a[1]], up[b[1]] = (inner, 0), (inner, 1)
                heapq.heappush(heap, (a[0] + b[0], inner))
                inner += 1
            roots.append(heap[0][1])
        up[roots[0]], up[roots[1]] = (inner, 0), (inner, 1)
        for s in range(SYMBOLS):
            path, at = [], s
            while at in up:
                path.append(up[at])
                at = up[at][0]
            start[prev * SYMBOLS + s], size[prev * SYMBOLS + s] = len(node), len(path)
            node += [prev * 256 + n - SYMBOLS for n, _ in reversed(path)]
            bit += [b for _, b in reversed(path)]
    return Codes(start, size, np.array(node, np.uint32), np.array(bit, np.uint8))


def count_pairs(text: bytes, pairs: np.ndarray) -> None:
    """Add a text's pairs of neighbouring symbols, its edges included."""
    s = np.empty(len(text) + 2, np.uint16)
    s[0] = s[-1] = EDGE
    s[1:-1] = np.frombuffer(text, np.uint8)
    for at in range(0, len(s) - 1, 1 << 20):
        x = s[at : at + (1 << 20) + 1].astype(np.int32)
        pairs += np.bincount(x[:-1] * SYMBOLS + x[1:], minlength=len(pairs))


class Words:
    """A chunk's vocabulary: the words by id as one buffer."""

    def __init__(self, blob: bytes):
        """blob: the words in order of their ids, each followed by a line feed."""
        self.data = np.frombuffer(blob, np.uint8)
        stops = np.flatnonzero(self.data == 10)
        self.start = np.concatenate([[0], stops[:-1] + 1]) if len(stops) else np.zeros(0, np.int64)
        self.size = stops - self.start
        at = np.arange(len(self.data)) - np.repeat(self.start, self.size + 1)
        with np.errstate(over="ignore"):
            self.hash = np.add.reduceat(np.where(self.data == 10, 0, self.data + np.uint64(1)) * _POWER[at % PART], self.start) * _HASH[0]
        # What comes after a word sees its last two bytes; the additional entry stands for the edge of a text.
        data, last = self.data.astype(np.uint16), stops - 1
        self.last = [np.append(np.where(self.size > k, data[np.maximum(last - k, 0)], EDGE).astype(np.uint16), np.uint16(EDGE)) for k in (0, 1)]
        self.first = np.where(self.size > 0, data[self.start], EDGE).astype(np.uint16)
        self.hash = np.append(self.hash, np.uint64(0))

    def __len__(self) -> int:
        return len(self.size)


def _slots(codes: Codes, prev: np.ndarray, sym: np.ndarray, three: np.ndarray, word: np.ndarray):
    """Slots per predictor, bits, and each symbol's first decision."""
    code = prev.astype(np.int64) * SYMBOLS + sym
    steps = codes.size[code]
    ends = np.cumsum(steps)
    first = ends - steps
    own = np.repeat(np.arange(len(code)), steps)
    path = (codes.start[code] - first)[own]
    path += np.arange(len(path))
    node, bit = codes.node[path], codes.bit[path]
    slots, mark = [node], node * _HASH[2]
    for key, bits in zip((three, word), BITS):
        slot = ((key * _HASH[0]) >> np.uint64(32)).astype(np.uint32)[own]
        slot ^= mark
        slot *= _HASH[1]
        slot >>= np.uint32(32 - bits)
        slots.append(slot)
    return slots, bit, first


def word_starts(codes: Codes, words: Words, ids: np.ndarray, ends: np.ndarray, before: np.ndarray, before_end: np.ndarray):
    """Decisions for the first symbols of words (or for the next separator, if the word is empty).

    ids, ends: a word and the separator after it; before, before_end: those
    that come before it (the additional entry and EDGE at a text's start).
    """
    return _starts(codes, words, start_keys(words, ids, ends, before, before_end))


def start_keys(words: Words, ids: np.ndarray, ends: np.ndarray, before: np.ndarray, before_end: np.ndarray) -> np.ndarray:
    """What the decisions for a first symbol depend on, as one number: the word and separator before it, and the symbol."""
    return (before << 3 | _NUMBER[before_end]) << 9 | np.where(words.size[ids] > 0, words.first[ids], ends)


def _starts(codes: Codes, words: Words, keys: np.ndarray):
    before, before_end, sym = keys >> 12, _SEPARATOR[keys >> 9 & 7], keys & 511
    with np.errstate(over="ignore"):
        three = before_end.astype(np.uint64) | words.last[0][before].astype(np.uint64) << np.uint64(9) | words.last[1][before].astype(np.uint64) << np.uint64(18) | np.uint64(1 << 40)
        return _slots(codes, before_end, sym, three, words.hash[before] + before_end * np.uint64(0x2545F4914F6CDD1D))


def word_blocks(words: Words, ids: np.ndarray, ends: np.ndarray):
    """Symbols after the first of (word, separator) pairs in blocks: unit, prev, sym, three, word context, is_end."""
    size = words.size[ids]
    parts = size // PART + 1
    unit = np.repeat(np.arange(len(ids)), parts)
    nth = np.arange(len(unit)) - np.repeat(np.cumsum(parts) - parts, parts)
    low, high = np.maximum(nth * PART, 1), np.minimum((nth + 1) * PART, size[unit] + 1)
    total = np.concatenate([[0], np.cumsum(high - low)])
    at = 0
    while at < len(unit):
        to = max(at + 1, int(np.searchsorted(total, total[at] + BLOCK_SYMBOLS, side="right")) - 1)
        n = high[at:to] - low[at:to]
        begin = total[at:to] - total[at]
        off = np.arange(int(n.sum())) + np.repeat(low[at:to] - begin, n)
        own = np.repeat(unit[at:to], n)
        place = words.start[ids[own]] + off
        end = off == size[own]
        prev = words.data[place - 1].astype(np.uint16)
        sym = np.where(end, ends[own], words.data[place])
        with np.errstate(over="ignore"):
            two = np.where(off > 1, words.data[np.maximum(place - 2, 0)], np.uint16(EDGE)).astype(np.uint64)
            three = np.where(off > 2, words.data[np.maximum(place - 3, 0)], np.uint16(EDGE)).astype(np.uint64)
            three = prev.astype(np.uint64) | two << np.uint64(9) | three << np.uint64(18)
            run = np.cumsum((prev.astype(np.uint64) + np.uint64(1)) * _POWER[(off - 1) % PART])
            run -= np.repeat(np.where(begin > 0, run[begin - 1], np.uint64(0)), n)
        yield own, prev, sym, three, run, end
        at = to


def table_sizes() -> list[int]:
    return [SYMBOLS * 256, *(1 << b for b in BITS)]


def log_odds(counts: np.ndarray) -> np.ndarray:
    """Log odds of a set bit from interleaved counts of clear and set bits."""
    counts = counts.astype(np.float32)
    counts += np.float32(PRIOR)
    odds = counts[1::2] / counts[::2]
    return np.log(odds, out=odds)


def _gate(odds: list[np.ndarray]) -> np.ndarray:
    top, mid = (np.minimum(np.abs(odds[k]) * np.float32(1.6), 7).astype(np.uint8) for k in (-1, -2))
    return (top * np.uint8(8) + mid).astype(np.intp)  # an index many times over


def _bucket(x: np.ndarray) -> np.ndarray:
    return ((np.clip(x, -7.99, 7.99) + np.float32(8.25)) * 2).astype(np.uint8)


class Learner:
    """Counts, mixer and map of one task."""

    def __init__(self, codes: Codes):
        self.codes = codes
        self.counts = [np.zeros(2 * n, np.uint32) for n in table_sizes()]
        self.weights = np.full((GATES, 1 + len(BITS)), 1.0 / (1 + len(BITS)))
        self.scale = np.full((GATES, 1 + len(BITS)), 1.0)
        self.map = np.zeros((GATES * MAP, 2))
        self.seen, self.slices = 0.0, 0

    def learn(self, words: Words, ids: np.ndarray, ends: np.ndarray, before: np.ndarray, before_end: np.ndarray) -> None:
        """Words and the separators after them, as arrays over all texts; slices grow from small ones."""
        at = 0
        while at < len(ids):
            to = min(len(ids), at + min(SLICE, 1 << (12 + min(self.slices, 20))))
            self._slice(words, *(x[at:to] for x in (ids, ends, before, before_end)))
            self.slices += 1
            at = to

    def _slice(self, words: Words, ids, ends, before, before_end) -> None:
        whole = words.size[ids] > 0
        key, times = np.unique(ids[whole] << 3 | _NUMBER[ends[whole]], return_counts=True)
        for own, prev, sym, three, run, _ in word_blocks(words, key >> 3, _SEPARATOR[key & 7]):
            slots, bit, first = _slots(self.codes, prev, sym, three, run)
            self._step(slots, bit, np.repeat(times[own], np.diff(np.append(first, len(bit)))))
        for at in range(0, len(ids), BLOCK_SYMBOLS):
            some = slice(at, at + BLOCK_SYMBOLS)
            keys, times = np.unique(start_keys(words, ids[some], ends[some], before[some], before_end[some]), return_counts=True)
            slots, bit, first = _starts(self.codes, words, keys)
            self._step(slots, bit, np.repeat(times, np.diff(np.append(first, len(bit)))))

    def _step(self, slots, bit, times) -> None:
        """Predict a block with the counts so far, move the mixer and the map, then add the block's counts."""
        slots = [s.astype(np.intp) for s in slots]
        odds = [log_odds(c.view(np.uint64)[s].view(np.uint32)) for c, s in zip(self.counts, slots)]
        gate = _gate(odds)
        x = _mixed(np.ascontiguousarray(self.weights.T, np.float32), gate, odds)
        error = bit - 1 / (1 + np.exp(-x))
        error *= times
        for k, o in enumerate(odds):  # steps scaled by past gradients
            step = np.bincount(gate, error * o, GATES)
            self.scale[:, k] += step * step
            self.weights[:, k] += 0.3 * step / np.sqrt(self.scale[:, k])
        seen = np.bincount((gate * MAP + _bucket(x)) * 2 + bit, times, minlength=2 * len(self.map)).reshape(-1, 2)
        self.map[:, 0] += seen.sum(1)
        self.map[:, 1] += seen[:, 1]
        self.seen += float(seen.sum())
        add = times.astype(np.uint32)
        for counts, slot in zip(self.counts, slots):
            np.add.at(counts, slot * 2 + bit, add)

    def pieces(self):
        """(kind, block, values) that add up over tasks; blocks of zeros are left out."""
        for kind, counts in enumerate(self.counts):
            for block in range(-(-len(counts) // (2 * BLOCK))):
                part = counts[block * 2 * BLOCK : (block + 1) * 2 * BLOCK]
                if part.any():
                    yield kind, block, part.astype(np.float64)
        yield -1, 0, np.append(self.weights.ravel() * self.seen, self.seen)
        yield -2, 0, self.map.ravel()


def _mixed(weights: np.ndarray, gate: np.ndarray, odds: list[np.ndarray]) -> np.ndarray:
    x = weights[0][gate] * odds[0]
    for k in range(1, len(odds)):
        x += weights[k][gate] * odds[k]
    return x


class Model:
    """The merged model, ready to score."""

    def __init__(self, codes: Codes, pieces: dict[tuple[int, int], np.ndarray], known_share: float = 0.0, n_words: int = 0):
        """known_share: the weight of a word's share among the ``n_words`` training words."""
        self.codes, self.known_share, self.n_words = codes, known_share, n_words
        counts = [np.zeros(2 * n) for n in table_sizes()]
        for (kind, block), part in pieces.items():
            if kind >= 0:
                counts[kind][block * 2 * BLOCK : block * 2 * BLOCK + len(part)] = part
        self.odds = [log_odds(c) for c in counts]
        shape = (GATES, 1 + len(BITS))
        mix = pieces.get((-1, 0), np.zeros(GATES * shape[1] + 1))
        weights = mix[:-1].reshape(shape) / mix[-1] if mix[-1] else np.full(shape, 1.0 / shape[1])
        self.weights = np.ascontiguousarray(weights.T, np.float32)
        table = pieces.get((-2, 0), np.zeros(GATES * MAP * 2)).reshape(-1, 2)
        centre = 1 / (1 + np.exp(-((np.arange(MAP) / 2) - 8)))
        trust = 32.0
        self.map = ((table[:, 1] + trust * np.tile(centre, GATES)) / (table[:, 0] + trust)).astype(np.float32)

    def logs(self, slots, bit, first) -> tuple[np.ndarray, np.ndarray]:
        """Natural logarithms of each symbol's first decision, and of its others."""
        odds = [t[s] for t, s in zip(self.odds, slots)]
        gate = _gate(odds)
        x = _mixed(self.weights, gate, odds)
        place = gate * MAP + _bucket(x)
        p = np.exp(-x)
        p += 1
        np.reciprocal(p, out=p)
        p += self.map[place]
        p *= np.float32(0.5)
        np.clip(p, FLOOR, 1 - FLOOR, out=p)
        p -= (1 - bit).astype(np.float32)
        log = np.log(np.abs(p, out=p), out=p)
        head = log[first].astype(np.float64)
        return head, np.add.reduceat(log, first, dtype=np.float64) - head

    def score(self, words: Words, ids: np.ndarray, ends: np.ndarray, before: np.ndarray, before_end: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of every word with the separator after it; counts: in training, by id."""
        # Every different (word, separator) is evaluated once.
        key = ids << 3 | _NUMBER[ends]
        there = np.zeros(len(words) << 3, bool)
        there[key] = True
        there.reshape(-1, 8)[words.size == 0] = False
        units = np.flatnonzero(there)
        inside, after = np.zeros(len(units) + 1), np.zeros(len(units) + 1)
        for own, prev, sym, three, run, end in word_blocks(words, units >> 3, _SEPARATOR[units & 7]):
            head, rest = self.logs(*_slots(self.codes, prev, sym, three, run))
            low, n = int(own[0]), int(own[-1] - own[0] + 1)
            inside[low : low + n] += np.bincount(own - low, np.where(end, head, head + rest), n)
            after[own[end]] = rest[end]
        unit = (np.cumsum(there, dtype=np.int32) - 1)[key]
        unit[words.size[ids] == 0] = len(units)
        out, share = np.empty(len(ids)), np.full(len(words), -np.inf)
        known = counts > 0
        with np.errstate(divide="ignore"):
            share[known] = np.log(self.known_share) + np.log(counts[known] / max(1, self.n_words))
            other = np.log1p(-self.known_share)
        # So is every different first symbol in its context, once in SLICE words.
        for low in range(0, len(ids), SLICE):
            part = slice(low, low + SLICE)
            key = start_keys(words, ids[part], ends[part], before[part], before_end[part])
            order = np.argsort(key)
            key = key[order]
            new = np.append(True, key[1:] != key[:-1])
            place = np.empty(len(key), np.int32)
            place[order] = np.cumsum(new, dtype=np.int32) - 1
            key = key[new]
            heads, rests = np.empty(len(key)), np.empty(len(key))
            for at in range(0, len(key), BLOCK_SYMBOLS):
                some = slice(at, at + BLOCK_SYMBOLS)
                heads[some], rests[some] = self.logs(*_starts(self.codes, words, key[some]))
            for at in range(0, len(place), BLOCK_SYMBOLS):
                own, some = place[at : at + BLOCK_SYMBOLS], slice(low + at, min(low + at + BLOCK_SYMBOLS, low + len(place)))
                rest, whole = rests[own], words.size[ids[some]] > 0
                mixed = np.logaddexp(share[ids[some]], other + rest + inside[unit[some]])
                out[some] = heads[own] + np.where(whole, mixed + after[unit[some]], rest)
        return out


def _packer():
    return zstandard.ZstdCompressor(level=1)


def _unpacked(body: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(body)


def _planes(values: np.ndarray, kind: str) -> bytes:
    """Numbers by byte planes, so that the upper zeros lie together."""
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(values, kind).view(np.uint8).reshape(-1, width).T.tobytes()


def _from_planes(body: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(body, np.uint8).reshape(width, -1).T).view(kind).ravel()


class Chunk:
    """Texts of about CHUNK_BYTES as ids of their common vocabulary."""

    def __init__(self):
        self.doc_ids, self.held, self.texts, self.bytes = [], [], [], 0

    def add(self, doc_id: int | None, held: bool, text: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.held.append(held)
        self.texts.append(text)
        self.bytes += len(text)

    def encoded(self):
        """Ids of all words, the separators after them (zero stands for the end), words per text, and the vocabulary with a line feed after each word."""
        # An empty text before the others makes EMPTY the first word; every word is taken with one space after it.
        flat = b" ".join([b"", *self.texts, b""])
        body = np.frombuffer(flat, np.uint8)
        stops = np.flatnonzero(_IS_SPACE[body])
        last = np.searchsorted(stops, np.cumsum([1, *(len(t) + 1 for t in self.texts)]) - 1)
        ends = body[stops]
        ends[last] = 0
        offsets = np.zeros(len(stops) + 1, np.int64)
        np.add(stops, 1, out=offsets[1:])
        flat = flat.translate(_TO_SPACE)
        del body, stops  # a chunk's memory counts once a worker
        coded = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(flat)]).dictionary_encode()
        words = coded.dictionary
        size = int(np.frombuffer(words.buffers()[1], np.int64, len(words) + 1)[-1])
        blob = END + b"\n" + words.buffers()[2][:size].to_pybytes().replace(b" ", b"\n")
        return coded.indices.to_numpy()[1:].astype(np.uint32) + np.uint32(1), ends[1:], np.diff(last), blob

    def rows(self, chunk: int, ranges: int):
        """(chunk, range, docs, held, a, b, c, d): the texts with range -1, and the vocabulary by ranges of words."""
        pack = _packer()
        ids, ends, sizes, blob = self.encoded()
        words = Words(blob)
        yield chunk, -1, self.doc_ids, self.held, *(pack.compress(x) for x in (sizes.astype("<u4").tobytes(), _planes(ids, "<u4"), ends.tobytes(), blob))
        train = np.repeat(~np.array(self.held), sizes)
        counts = np.bincount(ids[train], minlength=len(words))
        counts[0], counts[1] = len(self.held) - sum(self.held), 0
        place = (words.hash[:-1] >> np.uint64(20)) % np.uint64(ranges)
        order = np.argsort(place, kind="stable")
        order = order[order != 1]
        cuts = np.searchsorted(place[order], np.arange(ranges + 1))
        listed = pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(np.append(words.start, len(blob))), pa.py_buffer(blob)]).take(pa.array(order))
        stops = np.append(0, np.cumsum(words.size[order] + 1))
        for r in range(ranges):
            own = order[cuts[r] : cuts[r + 1]]
            if len(own):
                yield chunk, r, None, None, pack.compress(listed.buffers()[2][int(stops[cuts[r]]) : int(stops[cuts[r + 1]]) - 1].to_pybytes()), pack.compress(_planes(own, "<u4")), pack.compress(_planes(counts[own], "<u4")), None


_INGESTED = pa.schema([
    ("chunk", pa.int64()), ("range", pa.int32()), ("docs", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
    ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("d", pa.binary()), ("pairs", pa.binary()),
])


def ingest(docs: DataFrame, ranges: int) -> DataFrame:
    """One pass over the texts: chunks of texts, their words by range, and pairs of neighbouring bytes in training texts."""

    def run(batches):
        chunk, part, n = Chunk(), TaskContext.get().partitionId(), 0
        pairs, train, size = np.zeros(SYMBOLS * SYMBOLS, np.int64), [], 0

        def out():
            for row in chunk.rows(part << 24 | n, ranges):
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*row, None), _INGESTED)], schema=_INGESTED)

        for batch in batches:
            for doc_id, held, text in zip(batch.column("doc_id").to_pylist(), batch.column("held").to_pylist(), batch.column("text").cast(pa.large_binary())):
                text = (text.as_py() or b"").lower()
                chunk.add(doc_id, held, text)
                if not held:
                    count_pairs(text, pairs)
                if chunk.bytes >= CHUNK_BYTES:
                    yield from out()
                    chunk, n = Chunk(), n + 1
        if chunk.texts:
            yield from out()
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((None,) * 8 + (_packer().compress(pairs.tobytes()),), _INGESTED)], schema=_INGESTED)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc32_of_id(F.col("doc_id")) % 7 == 2).alias("held"), "text")
    return source.mapInArrow(run, "chunk long, range int, docs array<long>, held array<boolean>, a binary, b binary, c binary, d binary, pairs binary")


def vocabulary_totals(ranges: DataFrame, n: int) -> DataFrame:
    """Training counts of every chunk's words over all chunks: (chunk, pos, totals), and sums per range in stats.

    A range of words is one task; its size follows from RANGE_BYTES, and every
    chunk sends a word once however often it occurs, so no word is a hot key.
    """

    def run(batches):
        known: defaultdict[bytes, int] = defaultdict()
        known.default_factory = known.__len__
        asked, total, pack = [], np.zeros(1 << 16, np.int64), _packer()
        for batch in batches:
            for chunk, a, pos, c in zip(*(batch.column(k).to_pylist() for k in ("chunk", "a", "b", "c"))):
                words = _unpacked(a).split(b"\n")
                ids = np.fromiter(map(known.__getitem__, words), np.uint32, len(words))
                while len(known) > len(total):
                    total = np.concatenate([total, np.zeros_like(total)])
                total[ids] += _from_planes(_unpacked(c), "<u4")  # a word occurs once in a request
                asked.append((chunk, ids, pos))
        for chunk, ids, pos in asked:
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([pos], pa.binary()), pa.array([pack.compress(_planes(total[ids], "<u8"))], pa.binary()), pa.nulls(1, pa.list_(pa.int64()))], ["chunk", "pos", "totals", "stats"])
        if known:
            own, end = total[: len(known)], known.get(END)
            texts = int(own[end]) if end is not None else 0
            once = int((own == 1).sum()) - (texts == 1)
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.array([[int(own.sum()), int((own > 0).sum()), texts, once]], pa.list_(pa.int64()))], ["chunk", "pos", "totals", "stats"])

    return by_bucket(ranges, "range", n).select("chunk", "a", "b", "c").mapInArrow(run, "chunk long, pos binary, totals binary, stats array<long>")


def opened(words_blob: bytes, sizes: bytes, ids: bytes, ends: bytes):
    """A chunk's vocabulary, sizes of its texts, and per word: id, separator after it, and the word and separator before it."""
    words, sizes = Words(words_blob), np.frombuffer(sizes, "<u4").astype(np.int64)
    ids, ends = _from_planes(ids, "<u4").astype(np.int64), np.frombuffer(ends, np.uint8).astype(np.uint16)
    ends[ends == 0] = EDGE
    before, before_end = np.roll(ids, 1), np.roll(ends, 1)
    starts = np.cumsum(sizes) - sizes
    before[starts], before_end[starts] = len(words), EDGE
    return words, sizes, ids, ends, before, before_end


def _added(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Sum packed arrays of doubles by ``keys``."""

    def add(group: pa.Table) -> pa.Table:
        total = 0
        for body in group.column("body"):
            total = total + np.frombuffer(_unpacked(body.as_py()), np.float64)
        return pa.table([*(group.column(k)[:1] for k in keys), pa.array([_packer().compress(total.tobytes())], pa.binary())], names=[*keys, "body"])

    fields = {"kind": "int", "block": "int", "lane": "int"}
    return frame.groupBy(*keys).applyInArrow(add, ", ".join(f"{k} {fields[k]}" for k in keys) + ", body binary")


def train(chunks: DataFrame, pairs: DataFrame) -> tuple[Codes, dict]:
    """Code trees and merged tables from the training texts of ``chunks``; their size doesn't depend on the input's."""
    # A table of 257 by 257 counts per task, added up in two steps.
    def total(batches):
        out = np.zeros(SYMBOLS * SYMBOLS, np.int64)
        for batch in batches:
            for body in batch.column(0):
                out += np.frombuffer(_unpacked(body.as_py()), np.int64)
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(out[at])], ["pair", "n"])

    got = pairs.mapInArrow(total, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(SYMBOLS * SYMBOLS, np.int64)
    table[got["pair"]] = got["n"]
    codes = build_codes(table.reshape(SYMBOLS, SYMBOLS))
    shared = chunks.sparkSession.sparkContext.broadcast(codes)

    def learn(batches):
        learner, pack = Learner(shared.value), _packer()
        for batch in batches:
            for held, *bodies in zip(*(batch.column(k) for k in ("held", "d", "a", "b", "c"))):
                words, sizes, *arrays = opened(*(_unpacked(x.as_py()) for x in bodies))
                taught = np.repeat(~np.array(held.as_py(), bool), sizes)
                arrays = [x[taught] for x in arrays]
                learner.learn(words, *arrays)
                del words, arrays  # before the next chunk is opened
        if learner.slices:
            lane = TaskContext.get().partitionId() % 64
            for kind, block, values in learner.pieces():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind], pa.int32()), pa.array([block], pa.int32()), pa.array([lane], pa.int32()), pa.array([pack.compress(values.tobytes())], pa.binary())],
                    ["kind", "block", "lane", "body"],
                )

    learned = chunks.select("held", "a", "b", "c", "d").mapInArrow(learn, "kind int, block int, lane int, body binary")
    merged = _added(_added(learned, ["kind", "block", "lane"]), ["kind", "block"]).collect()  # of fixed size
    return codes, {(r["kind"], r["block"]): np.frombuffer(_unpacked(r["body"]), np.float64) for r in merged}


def known_share(once: int, n_words: int) -> float:
    """Weight of the corpus counts: half the chance that the next word is known, by the share of words that occur once (Good and Turing)."""
    return max(0.0, 1 - (once + 1) / (n_words + 1)) / 2


_REPORT = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
    ("base_score", pa.float64()), ("score", pa.float64()), ("bits_per_byte", pa.float64()),
])


def score_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte for every row.

    Texts are folded (A-Z) first.  base_score is the add-one unigram score over
    words and one end token; score is the mixing model's log10 probability of
    the folded text's bytes and its end.  Rows whose crc32(doc_id) mod 7 is 2
    are scored but never learned from.  Null texts count as empty, null ids as
    the empty text for that remainder.  Without any training rows all decisions
    are even.  A long text is scored in blocks, so it needs a small multiple of
    its size.  Repeated rows each get a row and count each time; an empty table
    gives none; further columns are ignored.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(partitions(spark), -(-size // RANGE_BYTES))
    rows = materialize(ingest(docs, ranges), "ingested")
    chunks = rows.where("range = -1").select("chunk", "docs", "held", "a", "b", "c", "d")
    totals = materialize(vocabulary_totals(rows.where("range >= 0"), ranges), "vocabulary")
    s = totals.where("stats is not null").agg(*[F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)) for i in range(4)]).first()
    n_train, n_distinct, n_words, once = int(s[0]), int(s[1]), int(s[0] - s[2]), int(s[3])
    codes, pieces = train(chunks, rows.where("pairs is not null").select("pairs"))
    model = spark.sparkContext.broadcast(Model(codes, pieces, known_share(once, n_words), n_words))

    def scored(batches):
        own: list[tuple[bytes, bytes]] = []
        for batch in batches:
            for kind, ids, held, *bodies in zip(*(batch.column(k) for k in ("kind", "docs", "held", "d", "a", "b", "c"))):
                bodies = [x.as_py() for x in bodies]
                if kind.as_py() == 0:  # counts of some of the next chunk's words
                    own.append((bodies[1], bodies[2]))
                    continue
                words, sizes, *arrays = opened(*map(_unpacked, bodies))
                counts = np.zeros(len(words), np.int64)
                for pos, total in own:
                    counts[_from_planes(_unpacked(pos), "<u4")] = _from_planes(_unpacked(total), "<u8")
                own = []
                starts, c, real = np.cumsum(sizes) - sizes, counts[arrays[0]], words.size[arrays[0]] > 0
                tokens = np.add.reduceat(real.astype(np.int64), starts) + 1
                base = np.add.reduceat(np.where(real, np.log10(c + 1.0), 0.0), starts) + np.log10(counts[0] + 1.0) - tokens * np.log10(n_train + n_distinct + 1)
                known = np.add.reduceat((real & (c > 0)).astype(np.int64), starts) + (counts[0] > 0)
                length = np.maximum(1, np.add.reduceat(words.size[arrays[0]], starts) + sizes - 1)
                del c, real
                score = np.add.reduceat(model.value.score(words, *arrays, counts), starts) / np.log(10)
                del words, arrays, counts  # before the next chunk is opened
                columns = (ids.values, held.values, tokens, known, np.full(len(sizes), n_train), base, score, -score / np.log10(2) / length)
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) if isinstance(x, np.ndarray) else x for x, f in zip(columns, _REPORT)], schema=_REPORT)

    # A chunk meets its counts in the task of the input partition that it came from.
    parts = int(rows.agg(F.max("chunk")).first()[0] or 0) >> 24
    answers = totals.where("stats is null").select("chunk", F.lit(0).alias("kind"), F.col("pos").alias("a"), F.col("totals").alias("b"))
    both = chunks.withColumn("kind", F.lit(1)).unionByName(answers, allowMissingColumns=True).withColumn("part", F.shiftrightunsigned("chunk", 24).cast("int"))
    together = by_bucket(both, "part", parts + 1).sortWithinPartitions("chunk", "kind")
    fields = ", ".join(f"{n} {t}" for n, t in zip(_REPORT.names, ("long", "boolean", "long", "long", "long", "double", "double", "double")))
    return together.select("kind", "docs", "held", "a", "b", "c", "d").mapInArrow(scored, fields)
