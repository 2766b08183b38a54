"""Operator 12: repair the turn structure of conversations by cheapest edits, with Four-Russians block tables.

A repaired conversation has the role initials ``(s?(ua)+)?``.  That is an
automaton of four states, and the cheapest way from a state to the end is a
vector of four costs.  Reading a row backward maps the vector after it to the
vector before it.  Less their least entry, these vectors are few (they are
enumerated below), so a block of BLOCK rows is one table entry per vector: the
vector before the block, the cost added, and which state each state leads to.
Conversations are read block by block from their end; to trace the edits, a
block is expanded backward into the vectors between its rows, and walked
forward taking the ASCII-least letter that is still cheapest.  A letter fixes
the next state, so this gives the least string.

Rows are ordered by range partitioning over (conversation, turn, role, text), so
a conversation with a third of all rows is many chunks in many tasks.  A chunk
of a divided conversation is summed up for every vector that may follow; one row
per CHUNK rows then tells each chunk its vector and its state, and all chunks
are traced in parallel.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from .common import materialize, partitions

#: Rows of a block of the tables; rows of a chunk.
BLOCK, CHUNK = 4, 4096
#: Costs of the edits; what a truncated row costs unless it's deleted.
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
#: States: nothing yet, after the system row, after a user row, after an assistant row.  Where a written or inserted role leads, and which it is.
FORWARD, ROLE = (2, 2, 3, 2), ("user", "user", "assistant", "user")
#: Where a kept row leads, by its initial (s, u, a, other).
KEEP = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})
#: Symbol 0: a row that must go.  Symbol 1 + 2 * initial + truncated: any other row.
SYMBOLS = 9
#: Costs to the end behind the last row.
END = (0, 4, 2, 0)
#: White space of the contract.
SPACE = " \t\n\x0b\x0c\r"


def _options(after: tuple, symbol: int, state: int) -> list[tuple[int, str, int]]:
    """(cost to the end, letter, next state) of the edits that use up a row."""
    out = [(DELETE + after[state], "D", state)]
    if symbol:
        initial, cut = divmod(symbol - 1, 2)
        if state in KEEP[initial]:
            out.append((cut * CUT + after[KEEP[initial][state]], "K", KEEP[initial][state]))
        out.append((REROLE + cut * CUT + after[FORWARD[state]], "R", FORWARD[state]))
    return out


def _before(after: tuple, symbol: int) -> tuple:
    """Costs to the end before a row, from those after it."""
    cost = [min(o[0] for o in _options(after, symbol, s)) for s in range(4)]
    for _ in range(4):
        cost = [min(cost[s], INSERT + cost[FORWARD[s]]) for s in range(4)]
    return tuple(cost)


class Tables:
    """vectors: the normalised vectors, END first.  one[v, symbol] and added[v, symbol]: vector before a row, and cost.

    block, cost, lead: the same for blocks of BLOCK symbols (the first is the highest digit), and the states that
    the four states lead to.  walk[v][symbol][state]: inserted rows, letter, next state of the least cheapest edits.
    """

    def __init__(self):
        self.vectors, ids, rows = [END], {END: 0}, []
        for vector in self.vectors:
            row = []
            for symbol in range(SYMBOLS):
                cost = _before(vector, symbol)
                low = min(cost)
                normal = tuple(c - low for c in cost)
                if normal not in ids:
                    ids[normal] = len(self.vectors)
                    self.vectors.append(normal)
                row.append((ids[normal], low))
            rows.append(row)
        m = len(self.vectors)
        self.one, self.added = np.array([[x[0] for x in r] for r in rows]), np.array([[x[1] for x in r] for r in rows])
        self.walk = [[[self._walk(self.vectors[v], rows[v][s], s, q) for q in range(4)] for s in range(SYMBOLS)] for v in range(m)]
        step = np.array([[[self.walk[v][s][q][2] for q in range(4)] for s in range(SYMBOLS)] for v in range(m)])
        blocks = np.arange(SYMBOLS**BLOCK)
        self.block = np.repeat(np.arange(m)[:, None], len(blocks), 1)
        self.cost = np.zeros_like(self.block)
        self.lead = np.broadcast_to(np.arange(4), (*self.block.shape, 4))
        for k in range(BLOCK):  # from the last symbol to the first
            symbol = blocks // SYMBOLS**k % SYMBOLS
            self.lead = np.take_along_axis(self.lead, step[self.block, symbol], 2)
            self.cost = self.cost + self.added[self.block, symbol]
            self.block = self.one[self.block, symbol]

    def _walk(self, after: tuple, before: tuple[int, int], symbol: int, state: int) -> tuple[int, str, int]:
        cost, inserted = [c + before[1] for c in self.vectors[before[0]]], 0
        while True:
            cheapest = [o for o in _options(after, symbol, state) if o[0] == cost[state]]
            if INSERT + cost[FORWARD[state]] == cost[state]:
                cheapest.append((cost[state], "I", FORWARD[state]))
            _, letter, following = min(cheapest, key=lambda o: o[1])
            if letter != "I":
                return inserted, letter, following
            inserted, state = inserted + 1, following

    def blocks(self, symbols: np.ndarray) -> np.ndarray:
        """Block numbers; the first block is filled up in front with rows that must go."""
        filled = np.concatenate([np.zeros(-len(symbols) % BLOCK, np.int64), symbols])
        return filled.reshape(-1, BLOCK) @ SYMBOLS ** np.arange(BLOCK - 1, -1, -1)

    def summary(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each vector after ``symbols``: the vector before them, the cost added, and where the four states lead."""
        now = np.arange(len(self.vectors))
        cost, lead = np.zeros(len(now), np.int64), np.broadcast_to(np.arange(4), (len(now), 4))
        for b in self.blocks(symbols)[::-1]:
            lead = np.take_along_axis(lead, self.lead[now, b], 1)
            cost = cost + self.cost[now, b]
            now = self.block[now, b]
        return now, cost - DELETE * (-len(symbols) % BLOCK), lead

    def trace(self, symbols: np.ndarray, after: int, state: int):
        """(inserted rows, letter, next state) per symbol: vectors by block from the end, then the steps inside each block."""
        blocks, behind = self.blocks(symbols), [after]
        for b in blocks[::-1]:
            behind.append(int(self.block[behind[-1], b]))
        skip, at = -len(symbols) % BLOCK, 0
        for k in range(len(blocks)):
            part = symbols[at : at + BLOCK - (skip if k == 0 else 0)].tolist()
            vectors = [behind[len(blocks) - 1 - k]]
            for s in part[:0:-1]:
                vectors.append(int(self.one[vectors[-1], s]))
            for s, v in zip(part, reversed(vectors)):
                step = self.walk[v][s][state]
                yield step
                state = step[2]
            at += len(part)


@cache
def tables() -> Tables:
    return Tables()


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies after the damage that crc32 of ``conv_id:turn`` sets; nulls are one space."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", or_space("conv_id"), or_space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(or_space("text"), "[.!?]", "")).otherwise(or_space("text"))
    return rows.select("conv_id", "turn", "role", "text").where(kind != 0).select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.when(kind == 4, "user").otherwise(or_space("role")).alias("role"),
        text.alias("text"), F.when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _digest() -> F.Column:
    """128 bits that name role and text."""
    return F.substring(F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)), 1, 16)


def _marked(rows: DataFrame) -> DataFrame:
    """Equal rows once, without texts: conv_id, turn, role's initial, digest, blank, cut, copies, first (no such row in an earlier turn)."""
    last = F.substring(F.rtrim(F.col("text"), F.lit(SPACE)), -1, 1)
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    small = rows.select("conv_id", "turn", "role", _digest().alias("digest"), code.alias("initial"), (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"), "copies")
    each = materialize(small.groupBy("conv_id", "turn", "role", "digest", "initial", "blank", "cut").agg(F.sum("copies").alias("copies")), "turns")
    # Struct order puts null turns first.
    first = each.groupBy("conv_id", "digest").agg(F.min(F.struct("turn")).alias("low")).select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), F.col("low.turn").alias("t"))
    same = each["conv_id"].eqNullSafe(first["c"]) & each["turn"].eqNullSafe(first["t"]) & (each["digest"] == first["d"])
    return each.join(first, same, "left").withColumn("first", F.col("d").isNotNull()).drop("c", "d", "t")


CHUNKS = (
    "part int, no int, divided boolean, symbols binary, extra array<long>, digests array<binary>, turns array<long>, blank long, duplicate long, truncated long, illegal long,"
    " head int, tail int, low long, high long, different long, deleted long, before array<int>, cost array<long>, lead array<int>"
)


def _chunks(marked: DataFrame) -> DataFrame:
    """Rows in order, as chunks of one conversation; a conversation that may go on in another chunk has summaries."""
    order = ["conv_id", "turn", "role", "digest"]
    schema = StructType([marked.schema["conv_id"], *_schema(marked, CHUNKS)])
    placed = marked.repartitionByRange(partitions(marked.sparkSession), *order).sortWithinPartitions(*order)

    def run(batches):
        part, no, held, started, ready = TaskContext.get().partitionId(), 0, [], False, []

        def chunk(rows: pa.Table, divided: bool):
            nonlocal no
            initial, blank, cut, first, copies = (rows.column(c).to_numpy() for c in ("initial", "blank", "cut", "first", "copies"))
            kept = first & ~blank
            symbols = np.where(kept, 1 + 2 * initial + cut, 0).astype(np.int64)
            turns = rows.column("turn").drop_null().to_numpy()
            pair = initial[:-1] * 4 + initial[1:]
            out = {
                "conv_id": rows.column("conv_id")[0].as_py(), "part": part, "no": no, "divided": divided, "symbols": symbols.astype(np.uint8).tobytes(), "extra": copies - 1,
                "digests": rows.column("digest").to_pylist(), "turns": rows.column("turn").to_pylist(), "blank": int(copies[blank].sum()),
                "duplicate": int(copies[~blank].sum() - kept.sum()), "truncated": int((kept & cut).sum()), "illegal": int((~np.isin(pair, [1, 6, 9])).sum() + (copies - 1).sum()),
                "head": int(initial[0]), "tail": int(initial[-1]), "low": int(turns[0]) if len(turns) else None, "high": int(turns[-1]) if len(turns) else None,
                "different": len(np.unique(turns)), "deleted": int((copies - 1).sum()),
            }
            if divided:
                out |= dict(zip(("before", "cost", "lead"), (x.reshape(-1) for x in tables().summary(symbols))))
            no += 1
            ready.append(out)

        def conversation(rows: list[pa.RecordBatch], whole: bool):
            table = pa.Table.from_batches(rows)
            for at in range(0, table.num_rows, CHUNK):
                chunk(table.slice(at, CHUNK), not whole or table.num_rows > CHUNK)

        def out():
            if ready:
                yield pa.RecordBatch.from_pylist(ready, schema=arrow)
                ready.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv_id")
            ends = [*(np.flatnonzero(_differs(conv)) + 1).tolist(), batch.num_rows]
            at = 0
            for end in ends:
                piece = batch.slice(at, end - at)
                if held and held[0].column("conv_id")[0].as_py() != piece.column("conv_id")[0].as_py():
                    conversation(held, whole=started)
                    held, started = [], True
                held.append(piece)
                # A very long conversation goes out as it comes, in whole chunks.
                if sum(h.num_rows for h in held) >= 4 * CHUNK:
                    table = pa.Table.from_batches(held)
                    for k in range(3):
                        chunk(table.slice(k * CHUNK, CHUNK), True)
                    yield from out()
                    held, started = table.slice(3 * CHUNK).to_batches(), False
                at = end
            yield from out()
        if held:
            conversation(held, whole=False)
        yield from out()

    arrow = to_arrow_schema(schema)
    return placed.mapInArrow(run, schema)


def _differs(values: pa.Array) -> np.ndarray:
    """Where a value differs from the one before it (nulls are equal)."""
    a, b = values.slice(1), values.slice(0, max(len(values) - 1, 0))
    one_null = pc.xor(pc.is_null(a), pc.is_null(b))
    return np.asarray(pc.or_(one_null, pc.fill_null(pc.not_equal(a, b), False)).to_numpy(zero_copy_only=False), bool)


def _schema(df: DataFrame, ddl: str) -> list[StructField]:
    return StructType.fromDDL(ddl).fields


FIXED = "part int, no int, state int, after int, last boolean, more_illegal long, shared long"


def _fixed(chunks: DataFrame) -> DataFrame:
    """For each chunk of a divided conversation: the state before it and the vector behind it; one row per CHUNK rows is all a task holds."""

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: (r["part"], r["no"]))
        after = [0]
        for r in rows[::-1]:
            after.append(r["before"][after[-1]])
        after, state, out, high = after[-2::-1], 0, [], None
        for k, r in enumerate(rows):
            pair = 4 * rows[k - 1]["tail"] + r["head"] if k else 1
            out.append((r["part"], r["no"], state, after[k], k == len(rows) - 1, int(pair not in (1, 6, 9)), int(r["low"] is not None and r["low"] == high)))
            state, high = r["lead"][4 * after[k] + state], r["high"] if r["high"] is not None else high
        return pa.table(dict(zip(("part", "no", "state", "after", "last", "more_illegal", "shared"), map(list, zip(*out)))), schema=arrow)

    arrow = to_arrow_schema(StructType.fromDDL(FIXED))
    small = chunks.where("divided").select("conv_id", "part", "no", "before", "lead", "head", "tail", "low", "high")
    return small.groupBy("conv_id").applyInArrow(run, FIXED)


TRACED = "part int, no int, at int, audit string, cost long, inserted array<string>, role string, turn long, digest binary"


def _traced(chunks: DataFrame) -> DataFrame:
    """Per chunk one row (at = -1) with its letters and cost, and a row for each row that stays, with the roles inserted before it.

    ``role`` is null where a row keeps its own; roles inserted at the end come with a row without digest.
    """
    columns = ["conv_id", "part", "no", "symbols", "extra", "digests", "turns", "state", "after", "last"]
    schema = StructType([chunks.schema["conv_id"], *_schema(chunks, TRACED)])

    def run(batches):
        t = tables()
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                symbols = np.frombuffer(r["symbols"], np.uint8).astype(np.int64)
                state, letters, cost, kept = r["state"], [], 0, []
                for k, (inserted, letter, following) in enumerate(t.trace(symbols, r["after"], state)):
                    roles = []
                    for _ in range(inserted):
                        roles.append(ROLE[state])
                        state = FORWARD[state]
                    letters.append("I" * inserted + letter + "D" * r["extra"][k])
                    cost += INSERT * inserted + DELETE * r["extra"][k]
                    if letter == "D":
                        cost += DELETE
                    else:
                        cost += (symbols[k] - 1) % 2 * CUT + (REROLE if letter == "R" else 0)
                        kept.append((k, roles, ROLE[state] if letter == "R" else None, r["turns"][k], r["digests"][k]))
                    state = following
                roles = []
                while r["last"] and END[state]:
                    roles.append(ROLE[state])
                    state = FORWARD[state]
                if roles:
                    kept.append((len(symbols), roles, None, None, None))
                letters.append("I" * len(roles))
                head = {"conv_id": r["conv_id"], "part": r["part"], "no": r["no"]}
                out.append(head | {"at": -1, "audit": "".join(letters), "cost": int(cost) + INSERT * len(roles)})
                out += [head | dict(zip(("at", "inserted", "role", "turn", "digest"), x)) for x in kept]
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    arrow = to_arrow_schema(schema)
    return chunks.select(*columns).mapInArrow(run, schema)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cheapest repair of the conversations in ``rows`` (conv_id, turn, role, text, copies): chunks and repaired rows.

    chunks: (conv_id, part, no, audit, cost, counts of faults), in order of
    (part, no).  repaired: (conv_id, part, no, at, inserted, role, text), in
    order of (part, no, at); ``inserted`` are roles of empty rows before the
    row, and role is null in rows that hold only such.

    Rows are taken by turn (null first), then role, then a digest of the text.
    Null ids are one conversation.  Repeated rows are duplicates of the first.
    Other columns are ignored.
    """
    chunks = materialize(_chunks(materialize(_marked(rows), "marked")), "chunks")
    fixed = chunks.join(_fixed(chunks), ["part", "no"], "left").fillna({"state": 0, "after": 0, "last": True, "more_illegal": 0, "shared": 0})
    traced = materialize(_traced(fixed), "traced")
    audits = traced.where("at = -1").select("part", "no", "audit", "cost")
    told = fixed.join(audits, ["part", "no"]).select(
        "conv_id", "part", "no", "audit", audits["cost"], "blank", "duplicate", "truncated", (F.col("illegal") + F.col("more_illegal")).alias("illegal"), "low", "high",
        (F.col("different") - F.col("shared")).alias("different"),
    )
    texts = rows.withColumn("d", _digest()).groupBy(F.col("conv_id").alias("c"), F.col("turn").alias("t"), "d").agg(F.first("role").alias("own"), F.first("text").alias("text"))
    kept = traced.where("at >= 0")
    same = kept["conv_id"].eqNullSafe(texts["c"]) & kept["turn"].eqNullSafe(texts["t"]) & (kept["digest"] == texts["d"])
    repaired = kept.join(texts, same, "left").select("conv_id", "part", "no", "at", "inserted", F.coalesce("role", "own").alias("role"), "text")
    return told, repaired


def _hashed(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): a digest of a conversation's lines has to read them one after the other; they stream, nothing is held."""
    schema = StructType([repaired.schema["conv_id"], StructField("repaired_sha256", StringType())])

    def run(batches):
        now, digest, lines = None, None, 0
        for batch in batches:
            done = []
            for r in batch.to_pylist():
                if digest is None or now != r["conv_id"]:
                    if digest is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest, lines = r["conv_id"], hashlib.sha256(), 0
                for line in [f"{x}:" for x in r["inserted"]] + ([f"{r['role']}:{r['text']}"] if r["role"] is not None else []):
                    digest.update((("\n" if lines else "") + line).encode("utf-8", "surrogatepass"))
                    lines += 1
            yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, x)) for x in done], schema=arrow)
        if digest is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, (now, digest.hexdigest())))], schema=arrow)

    arrow = to_arrow_schema(schema)
    return repaired.repartition("conv_id").sortWithinPartitions("conv_id", "part", "no", "at").mapInArrow(run, schema)


def repair_report(conversations: DataFrame) -> DataFrame:
    """One row per conv_id of ``conversations``: its damage by kind, and the cheapest repair's cost, letters and digest.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256.  A conversation that the damage leaves without rows has
    zeros, an empty audit and the digest of the empty string.  An empty table
    gives no rows.
    """
    told, repaired = repair(damaged(conversations))
    letters = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "no", "audit"))), lambda c: c["audit"]), "")
    sums = told.groupBy("conv_id").agg(
        F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("different"), F.lit(0)).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")], letters.alias("audit"),
    ).withColumnRenamed("conv_id", "c")
    hashes = _hashed(repaired).withColumnRenamed("conv_id", "h")
    every = conversations.select("conv_id").distinct()
    joined = every.join(sums, every["conv_id"].eqNullSafe(sums["c"]), "left").join(hashes, every["conv_id"].eqNullSafe(hashes["h"]), "left")
    zero = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return joined.fillna(zero | {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}).select("conv_id", *zero, "audit", "repaired_sha256")
