"""Weighted acyclic automata that count n-grams.

An arc's weight is how many occurrences pass through it, so the count of a
prefix is the weight of its last arc, which is the sum over the prefix's range.
States lie in layers (one per word); states with the same arcs are one state.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import zstandard

#: States with up to this many arcs are compared and shared; wider ones hardly ever agree.
SHARED = 4


def distinct(columns: list[np.ndarray]) -> np.ndarray:
    """Numbers from 0 for the different rows of non-negative whole columns."""
    key = np.zeros(len(columns[0]), np.int64)
    for column in columns:
        key = key * (int(column.max(initial=0)) + 1) + column
        key = np.unique(key, return_inverse=True)[1].reshape(-1).astype(np.int64)
    return key


def sorted_sums(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows in order, with the sums of their counts."""
    if not len(rows):
        return rows, counts
    order = np.lexsort(rows.T[::-1])
    rows, counts = rows[order], counts[order]
    new = np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])
    return rows[new], np.add.reduceat(counts, np.flatnonzero(new))


def prefixes(rows: np.ndarray, counts: np.ndarray):
    """Per depth of sorted different rows (0 fills up short ones): first row, last label, parent and weight of each prefix."""
    new, node, out = np.zeros(len(rows), bool), np.zeros(len(rows), np.int64), []
    if len(rows):
        new[0] = True
    for d in range(rows.shape[1]):
        new = new | np.concatenate([[False], rows[1:, d] != rows[:-1, d]]) if len(rows) else new
        at = np.flatnonzero(new)
        weight = np.add.reduceat(counts, at) if len(at) else counts[:0]
        real = rows[at, d] != 0
        out.append((at[real], rows[at[real], d], node[at[real]], weight[real]))
        # The number of a prefix is its place among the prefixes that don't end before.
        number = np.cumsum(real) - 1
        node = np.repeat(np.where(real, number, -1), np.diff(np.append(at, len(rows))))
    return out


@dataclass
class Transducer:
    """words: labels of the arcs by number, ascending.  Per layer: where each state's arcs start, and label, weight, target of the arcs.

    The last layer's targets are 0.
    """

    words: np.ndarray
    layers: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def build(cls, rows: np.ndarray, counts: np.ndarray) -> Transducer:
        """From sorted different n-grams (unsigned 64-bit labels; 0 fills up short ones)."""
        words, numbers = np.unique(rows, return_inverse=True)
        numbers = numbers.reshape(rows.shape)
        if len(words) and words[0] == 0:
            words = words[1:]
        else:
            numbers = numbers + 1
        levels, layers, target = prefixes(numbers, counts), [], None
        for d in range(rows.shape[1] - 1, -1, -1):
            _, label, parent, weight = levels[d]
            target = np.zeros(len(label), np.int64) if target is None else target
            states = len(levels[d - 1][1]) if d else 1
            begin = np.searchsorted(parent, np.arange(states + 1))
            arcs, same = np.diff(begin), np.arange(states) + states
            same[arcs == 0] = 0
            for k in range(1, SHARED + 1):
                alike = np.flatnonzero(arcs == k)
                if len(alike) > 1:
                    each = begin[alike][:, None] + np.arange(k)
                    number = distinct([x[each[:, j]] for j in range(k) for x in (label, weight, target)])
                    first = np.zeros(number.max() + 1, np.int64)
                    first[number[::-1]] = alike[::-1]
                    same[alike] = first[number] + states
            chosen, state = np.unique(same, return_inverse=True)
            source = np.where(chosen >= states, chosen - states, -1)
            size = np.where(source >= 0, arcs[source], 0)
            starts = np.concatenate([[0], np.cumsum(size)])
            take = np.arange(starts[-1]) - np.repeat(starts[:-1], size) + np.repeat(begin[source], size)
            layers.append((starts, label[take] - 1, weight[take], target[take]))
            target = state.reshape(-1)
        return cls(words, layers[::-1])

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        """The n-grams and their counts, in order; what an arc has beyond its target's arcs are n-grams that end there."""
        path, state, weight = np.zeros((1, len(self.layers)), np.uint64), np.zeros(1, np.int64), None
        out, sums = [], []
        for d, (starts, label, arc, target) in enumerate(self.layers):
            size = starts[state + 1] - starts[state]
            take = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(starts[state], size)
            if weight is not None:
                passed = np.zeros(len(state), np.int64)
                np.add.at(passed, np.repeat(np.arange(len(state)), size), arc[take])
                ends = weight > passed
                out.append(path[ends])
                sums.append((weight - passed)[ends])
            path = np.repeat(path, size, axis=0)
            path[:, d] = self.words[label[take]]
            state, weight = target[take], arc[take]
        out.append(path)
        sums.append(weight)
        return sorted_sums(np.concatenate(out), np.concatenate(sums))

    def weight(self, phrase: list[int]) -> int:
        """The count of a phrase: the weight of the last arc on its path, 0 if there is none."""
        state, found = 0, 0
        for label, (starts, labels, weights, targets) in zip(phrase, self.layers):
            number = int(np.searchsorted(self.words, np.uint64(label)))
            if number == len(self.words) or self.words[number] != label:
                return 0
            arcs = labels[starts[state] : starts[state + 1]]
            at = int(np.searchsorted(arcs, number))
            if at == len(arcs) or arcs[at] != number:
                return 0
            at += int(starts[state])
            state, found = int(targets[at]), int(weights[at])
        return found

    def pack(self) -> bytes:
        arrays = [self.words, *[a for layer in self.layers for a in layer]]
        small = [a if a.dtype == np.uint64 else a.astype(np.min_scalar_type(int(a.max(initial=0)))) for a in arrays]
        head = json.dumps([[a.dtype.str, len(a)] for a in small]).encode()
        return zstandard.ZstdCompressor(level=1).compress(len(head).to_bytes(4, "little") + head + b"".join(a.tobytes() for a in small))

    @classmethod
    def unpack(cls, packed: bytes) -> Transducer:
        body = zstandard.ZstdDecompressor().decompress(packed)
        at = 4 + int.from_bytes(body[:4], "little")
        arrays = []
        for kind, n in json.loads(body[4:at]):
            arrays.append(np.frombuffer(body, kind, n, at))
            at += arrays[-1].nbytes
        wide = [a.astype(np.int64) for a in arrays[1:]]
        return cls(arrays[0], [tuple(wide[i : i + 4]) for i in range(0, len(wide), 4)])


def union(parts: Iterable[Transducer], at_most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of all parts in order with the sums of their counts; sums are taken whenever ``at_most`` new rows have come together."""
    rows, counts, held = [], [], 0
    for part in parts:
        r, c = part.rows()
        rows.append(r)
        counts.append(c)
        held += len(r)
        if held > at_most:
            summed = sorted_sums(np.concatenate(rows), np.concatenate(counts))
            rows, counts, held = [summed[0]], [summed[1]], 0
    return sorted_sums(np.concatenate(rows), np.concatenate(counts))
