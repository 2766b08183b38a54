"""Operator 9: best-fit packing of token sequences by linear grouping.

Lengths are whole numbers up to the capacity, so a histogram of at most
``capacity`` counts describes any corpus.  The plan is made from it:

1. Large lengths, sorted, are cut into groups of equal cardinality and rounded
   up to the greatest length of their group (linear grouping).
2. The few sizes left are packed in whole configurations by the configuration
   linear program, solved by column generation and rounded down.
3. Actual lengths take the places of their group's size, but for each
   configuration's smallest place: rounding has left that one larger than its
   group needs, so it goes to the next step.
4. Everything else, above all the small ones, goes to the tightest room (best
   fit, longest first), and only then into new sequences.
5. A closing step empties the least-filled sequences, more of them each time,
   best-fits what they held, and keeps the outcome if it takes fewer sequences.

A plan is a list of runs: "items r to r+n of this length go to sequences from s
on, k in each, from this offset".  Spark ranks the pieces of each length in
parallel and looks each one's run up, so no task sees all pieces.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .encoding import encoder

CAPACITY, GROUPS = 2048, 96
#: Pieces of one length that are ranked in one go.
RANKED = 2000


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 600) -> list[tuple[np.ndarray, float]]:
    """Optimal fractional multiples of configurations (copies of each size that fit together).

    The configuration LP by column generation (Gilmore and Gomory, 1961); a
    column is priced by a knapsack over the number of items, few for large sizes.
    """
    k = len(sizes)
    columns = [np.eye(k, dtype=np.int64)[i] * (capacity // s) for i, s in enumerate(sizes)]
    inverse = np.diag([1.0 / (capacity // s) for s in sizes])
    x = inverse @ np.array(demand, float)
    most = capacity // min(sizes)
    for _ in range(rounds):
        price = inverse.sum(0)
        best = np.zeros((most + 1, capacity + 1))
        choice = np.full((most + 1, capacity + 1), -1)
        for t in range(1, most + 1):
            best[t] = best[t - 1]
            for i, s in enumerate(sizes):
                value = best[t - 1, : capacity + 1 - s] + price[i]
                better = value > best[t, s:] + 1e-12
                best[t, s:][better] = value[better]
                choice[t, s:][better] = i
        if best[most, capacity] <= 1 + 1e-7:
            break
        column, room = np.zeros(k, np.int64), capacity
        for t in range(most, 0, -1):
            if choice[t, room] >= 0:
                column[choice[t, room]] += 1
                room -= sizes[choice[t, room]]
        u = inverse @ column
        ratio = np.where(u > 1e-9, x / np.where(u > 1e-9, u, 1), np.inf)
        leave = int(ratio.argmin())
        step = ratio[leave]
        x = x - step * u
        x[leave] = step
        inverse[leave] /= u[leave]
        for i in range(k):
            if i != leave:
                inverse[i] -= u[i] * inverse[leave]
        columns[leave] = column
    return [(c, max(0.0, v)) for c, v in zip(columns, x)]


def best_fit(patterns: list[tuple[tuple[int, ...], int]], items: Counter, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Put items (length: how many), longest first, into the tightest room, else into new sequences.

    A pattern is what a sequence holds, with the number of sequences that hold it.
    """
    free: dict[int, list[list]] = defaultdict(list)
    for content, n in patterns:
        free[capacity - sum(content)].append([content, n])
    rooms = sorted(free)

    def add(content: tuple[int, ...], n: int) -> None:
        room = capacity - sum(content)
        if n:
            if not free[room]:
                k = bisect_left(rooms, room)
                if k == len(rooms) or rooms[k] != room:
                    rooms.insert(k, room)
            free[room].append([content, n])

    for length in sorted((n for n in items if items[n] > 0), reverse=True):
        left = items[length]
        while left:
            at = bisect_left(rooms, length)
            while at < len(rooms) and not free[rooms[at]]:
                rooms.pop(at)
            room = rooms[at] if at < len(rooms) else capacity
            content, n = free[room].pop() if at < len(rooms) else ((), left)
            each = room // length
            whole, rest = divmod(min(left, each * n), each)
            left -= whole * each + rest
            add(content + (length,) * each, whole)
            add(content + (length,) * rest, 1 if rest else 0)
            if content:
                add(content, n - whole - (1 if rest else 0))
    return [(content, n) for own in free.values() for content, n in own]


def grouped(counts: dict[int, int], capacity: int, groups: int) -> tuple[list[tuple[tuple[int, ...], int]], Counter]:
    """Patterns by linear grouping of the large lengths, and the items left over."""
    left = Counter({n: c for n, c in counts.items() if c > 0})
    patterns = [((capacity,), left.pop(capacity))] if left.get(capacity) else []
    large = sorted((n for n in left if n > capacity // 8), reverse=True)
    total = sum(left[n] for n in large)
    if not total:
        return patterns, left
    # Equal cardinalities; a length may lie in two groups.
    members, each, group, room = [[]], -(-total // groups), 0, -(-total // groups)
    for n in large:
        c = left[n]
        while c:
            if not room:
                members.append([])
                group, room = group + 1, each
            take = min(c, room)
            members[group].append([n, take])
            c, room = c - take, room - take
    sizes: list[int] = []
    merged: list[list[list[int]]] = []
    for m in members:
        if sizes and sizes[-1] == m[0][0]:
            merged[-1] += m
        else:
            sizes.append(m[0][0])
            merged.append(list(m))
    for column, value in configurations(sizes, [sum(c for _, c in m) for m in merged], capacity):
        stock = [sum(c for _, c in m) for m in merged]
        many = min([int(value + 1e-9), *(stock[i] // int(a) for i, a in enumerate(column) if a)])
        if many <= 0:
            continue
        parts: list[tuple[tuple[int, ...], int]] = [((), many)]
        kinds = np.repeat(np.arange(len(column)), column)  # sizes fall, so the smallest place comes last
        for i in kinds[: max(1, len(kinds) - 1)]:
            after = []
            for content, n in parts:
                while n:
                    length, there = merged[i][0]
                    take = min(n, there)
                    left[length] -= take
                    after.append((content + (length,), take))
                    n -= take
                    merged[i][0][1] -= take
                    if not merged[i][0][1]:
                        merged[i].pop(0)
            parts = after
        patterns += parts
    return patterns, left


def dissolved(patterns: list[tuple[tuple[int, ...], int]], most: int, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """``patterns`` after the ``most`` least-filled sequences were emptied and their items best-fitted again."""
    items, kept = Counter(), []
    for content, n in sorted(patterns, key=lambda p: (sum(p[0]), p[0])):
        take = min(n, most)
        most -= take
        for length in content:
            items[length] += take
        if n > take:
            kept.append((content, n - take))
    return best_fit(kept, items, capacity)


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Runs (length, rank, items, sequence, per_sequence, offset) and the number of sequences.

    Never more sequences than longest-first best fit needs: the closing step
    may go as far as emptying all of them.
    """
    patterns = best_fit(*grouped(counts, capacity, groups), capacity)
    size = lambda own: sum(n for _, n in own)
    least = -(-sum(n * c for n, c in counts.items()) // capacity)
    for share in (0.02, 0.05, 0.1, 0.2, 0.4, 0.7, 1.0):
        if size(patterns) <= least:
            break
        again = dissolved(patterns, math.ceil(share * size(patterns)), capacity)
        if size(again) < size(patterns):
            patterns = again
    used, runs, sequences = Counter(), [], 0
    for content, n in sorted(patterns):
        offset = 0
        for length, own in groupby(content):
            k = len(list(own))
            runs.append((length, used[length], n * k, sequences, k, offset))
            used[length] += n * k
            offset += length * k
        sequences += n
    return runs, sequences


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's ids with ``end_id`` after them.

    A document of more than ``capacity`` ids is cut into pieces of that length;
    the first takes the remainder.
    """

    def run(batches):
        own = encoder(tokenizer)
        last = int(end_id).to_bytes(4, "little")
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = own.encode(text.as_py() or "") + last
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                rows += [(doc_id, i, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ...) with sequence_id and offset."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    runs, _ = plan(counts, capacity, groups)
    runs.sort()
    table = spark.sparkContext.broadcast(np.array(runs, np.int64).reshape(-1, 6))
    # Ranks within a length: by hashed bucket first, then inside the bucket, so that one very common length isn't one task.
    buckets = spark.createDataFrame([(n, -(-c // RANKED)) for n, c in counts.items()], "length long, __buckets long")  # at most ``capacity`` rows
    rows = pieces.join(F.broadcast(buckets), "length").withColumn("__bucket", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), "__buckets").cast("int"))
    ahead = rows.groupBy("length", "__bucket").count().select(
        "length", "__bucket", (F.sum("count").over(Window.partitionBy("length").orderBy("__bucket")) - F.col("count")).alias("__ahead")
    )
    inside = F.row_number().over(Window.partitionBy("length", "__bucket").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = rows.withColumn("__inside", inside).join(ahead, ["length", "__bucket"]).withColumn("rank", F.col("__ahead") + F.col("__inside"))
    columns = pieces.columns

    def place(batches):
        runs = table.value
        key = runs[:, 0] << 44 | runs[:, 1] if len(runs) else np.empty(0, np.int64)
        for batch in batches:
            length, rank = np.asarray(batch.column("length")), np.asarray(batch.column("rank"))
            own = runs[np.searchsorted(key, length << 44 | rank, side="right") - 1]
            at = rank - own[:, 1]
            out = [batch.column(c) for c in columns] + [pa.array(own[:, 3] + at // own[:, 4]), pa.array(own[:, 5] + at % own[:, 4] * length)]
            yield pa.RecordBatch.from_arrays(out, [*columns, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.select(*columns, "rank").mapInArrow(place, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their places: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null texts count as empty, so they are one piece that holds ``end_id``.
    Repeated rows and null ids are packed like any others; an empty table gives
    an empty result; further columns are ignored.
    """
    return pack(materialize(token_pieces(docs, tokenizer, end_id, capacity), "pieces"), capacity)
