"""Operator 8: SimHash near-duplicates, compared exactly in tiles.

Fingerprints are compared with numpy exclusive-or and bit counts, tile against
tile, in order of their population counts; a pair of tiles whose counts differ
by more than the radius is skipped.  Which fingerprints meet in a tile is set by
an exact pigeonhole rule: two fingerprints at ``radius`` bits or fewer agree in
all but ``radius`` of any blocks of bits, so each choice of that many equal
blocks is a cell and only cells are tiled.  Without it every tile would meet
every other, which grows with the square of the corpus.

A fingerprint may be wider than 64 bits: then the first 64 bits say who meets,
and links must also hold over the whole width, which estimates the likeness of
two texts more closely.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import join_classes, materialize, split_hot
from .components import connected_components

#: Fingerprints in a tile that travels, and in the tiles compared at once inside it.
TILE, STRIP = 2048, 256
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def shingle_hashes(text: str | None, words: int = 3, seed: int = 42) -> np.ndarray:
    """XXH64 of the text's word shingles (ASCII case and white space folded)."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    size = min(words, len(parts))
    flat = b" ".join(parts)
    stops = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = [0, *(stops[:-1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(flat[i:j], seed) for i, j in zip(starts, stops[size - 1 :].tolist())), np.uint64, len(parts) - size + 1
    )


def _lanes(hashes: np.ndarray, lanes: int) -> np.ndarray:
    """64 further bits per lane from every hash; the first lane is the hash itself."""
    with np.errstate(over="ignore"):
        z = hashes[:, None] + np.arange(lanes, dtype=np.uint64) * _MIX[0]
        z = (z ^ (z >> np.uint64(30))) * _MIX[1]
        z = (z ^ (z >> np.uint64(27))) * _MIX[2]
        z ^= z >> np.uint64(31)
    z[:, 0] = hashes
    return z


def simhash(text: str | None, words: int = 3, seed: int = 42, lanes: int = 1) -> np.ndarray:
    """Fingerprint of ``lanes`` times 64 bits: a bit is set if it is set in over half the shingle hashes."""
    return majority(shingle_hashes(text, words, seed), lanes)


def majority(hashes: np.ndarray, lanes: int = 1) -> np.ndarray:
    """The fingerprint of shingle hashes."""
    n, ones = len(hashes), np.zeros(64 * lanes, np.int64)
    for at in range(0, n, 255 * 16):  # whole text, bounded memory
        part = _lanes(hashes[at : at + 255 * 16], lanes)
        bits = np.zeros((-(-len(part) // 255) * 255, 64 * lanes), np.uint8)
        bits[: len(part)] = np.unpackbits(part.astype(">u8").view(np.uint8), axis=1)
        # 255 bytes of 0 or 1 add up without a carry, eight columns in a word.
        ones += bits.view(np.uint64).reshape(-1, 255, 8 * lanes).sum(1).view(np.uint8).sum(0, dtype=np.int64)
    return np.packbits(ones * 2 > n).view(">u8").astype(np.uint64)


def with_fingerprint(docs: DataFrame, names: list[str], words: int = 3, seed: int = 42, texts: bool = True) -> DataFrame:
    """All columns (but the text unless ``texts``) and the fingerprint as signed longs, 64 bits a name.  Null texts count as empty: all 0."""
    keep = [c for c in docs.columns if texts or c != "text"]

    def run(batches):
        for batch in batches:
            fps = np.array([simhash(t.as_py(), words, seed, len(names)) for t in batch.column("text")], np.uint64).reshape(-1, len(names)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(fps[:, k].copy()) for k in range(len(names)))], [*keep, *names])

    return docs.mapInArrow(run, StructType([*(docs.schema[c] for c in keep), *(StructField(n, LongType()) for n in names)]))


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp)."""
    return with_fingerprint(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["fp"], words, seed, texts=False)


def star_edges(ids_a: np.ndarray, ids_b: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each linked id to the least id of its component inside this pair of tiles.

    At most one edge per id leaves a tile pair, however many links it holds.
    """
    low_a, low_b, none = ids_a.copy(), ids_b.copy(), np.iinfo(np.int64).max
    while True:
        new_b = np.minimum(low_b, np.where(linked, low_a[:, None], none).min(0, initial=none))
        new_a = np.minimum(low_a, np.where(linked, new_b[None, :], none).min(1, initial=none))
        if (new_a == low_a).all() and (new_b == low_b).all():
            break
        low_a, low_b = new_a, new_b
    ids, low = np.concatenate([ids_a, ids_b]), np.concatenate([low_a, low_b])
    keep = ids != low
    return ids[keep], low[keep]


def _strips(one, two):
    """Pairs of strips of two tiles in order of population counts, as index arrays with counts; without ``two``, of one tile with itself."""
    cut = lambda fp: [(k, np.bitwise_count(fp[k, 0])) for k in np.array_split(np.argsort(np.bitwise_count(fp[:, 0]), kind="stable"), -(-len(fp) // STRIP))]
    a = cut(one)
    b = a if two is None else cut(two)
    for i, (x, count_x) in enumerate(a):
        for y, count_y in b[i:] if two is None else b:
            yield x, y, int(count_x.min()), int(count_x.max()), int(count_y.min()), int(count_y.max())


def _edges_of(batches, lanes: list[str], radius: int, wide: int | None):
    """Compare pairs of tiles; a row without its own second tile is compared with itself."""
    for batch in batches:
        nodes, lows = [], []
        for one, two in zip(batch.column("one"), batch.column("two")):
            read = lambda t: (np.stack([np.asarray(t.values.field(k), np.int64).view(np.uint64) for k in lanes], 1), np.asarray(t.values.field("rep"), np.int64))
            a_fp, a_id = read(one)
            b_fp, b_id = read(two) if two.is_valid else (a_fp, a_id)
            for x, y, low_x, high_x, low_y, high_y in _strips(a_fp, b_fp if two.is_valid else None):
                if high_x + radius < low_y or high_y + radius < low_x:
                    continue
                linked = np.bitwise_count(a_fp[x, None, 0] ^ b_fp[None, y, 0]) <= radius
                if wide is not None and linked.any():
                    i, j = np.nonzero(linked)
                    linked[i, j] = np.bitwise_count(a_fp[x[i]] ^ b_fp[y[j]]).sum(1) <= wide
                if linked.any():
                    ids, low = star_edges(a_id[x], b_id[y], linked)
                    nodes.append(ids)
                    lows.append(low)
        if nodes:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes)), pa.array(np.concatenate(lows))], ["a", "b"])


def link_edges(distinct: DataFrame, radius: int = 3, tile: int = TILE, agree: int = 1, wide: int | None = None) -> DataFrame:
    """Edges that span every component of the link graph over distinct rows (fp, further lanes, rep).

    The bits of ``fp`` are cut into ``radius + agree`` blocks, of which two
    linked fingerprints share ``agree`` at least; more of them make cells
    smaller and more.  ``wide``: the distance that links must also keep over all lanes.
    """
    lanes = [c for c in distinct.columns if c != "rep"]
    count = radius + agree
    stops = [64 * i // count for i in range(count + 1)]
    value = lambda i: F.expr(f"shiftrightunsigned(fp, {stops[i]}) & {(1 << (stops[i + 1] - stops[i])) - 1}L")

    def cell(number: int, chosen: tuple[int, ...]):
        key, width = F.lit(0).cast("long"), 0
        for i in chosen:
            key = key + F.shiftleft(value(i), width)
            width += stops[i + 1] - stops[i]
        return F.shiftleft(F.lit(number).cast("long"), 48) + key

    cells = F.array(*[cell(n, chosen) for n, chosen in enumerate(combinations(range(count), agree))])
    rows = split_hot(distinct.select(*lanes, "rep", F.explode(cells).alias("cell")), ["cell"], "fp", tile)
    # Tiles of a hot cell follow the population count, so that whole pairs of tiles needn't travel.
    rows = rows.withColumn("level", F.when(F.col("tiles") > 1, F.bit_count("fp")).otherwise(-1))
    tiles = rows.groupBy("cell", "level", "tile").agg(F.collect_list(F.struct(*lanes, "rep")).alias("members"))
    cold = tiles.where("level < 0 and size(members) > 1").select(F.col("members").alias("one"), F.lit(None).cast(tiles.schema["members"].dataType).alias("two"))
    hot = materialize(tiles.where("level >= 0"), "tiles")
    keys = hot.select("cell", "level", "tile")
    near = (
        keys.withColumn("to", F.explode(F.sequence(F.col("level"), F.col("level") + radius)))
        .join(keys.select("cell", F.col("level").alias("to"), F.col("tile").alias("to_tile")), ["cell", "to"])
        .where("to > level or to_tile >= tile")
    )
    pairs = (
        near.join(hot.withColumnRenamed("members", "one"), ["cell", "level", "tile"])
        .join(hot.select("cell", F.col("level").alias("to"), F.col("tile").alias("to_tile"), F.col("members").alias("two")), ["cell", "to", "to_tile"])
        .select("one", "two")
    )
    run = lambda batches: _edges_of(batches, lanes, radius, wide)
    return cold.mapInArrow(run, "a long, b long").union(pairs.mapInArrow(run, "a long, b long"))


def distinct_fingerprints(fps: DataFrame, lanes: list[str], *more: F.Column) -> DataFrame:
    """(fingerprint lanes, least doc_id, copies, node): every fingerprint once, written; ``more`` are further aggregates."""
    return materialize(fps.groupBy(*lanes).agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"), *more).withColumn("node", F.monotonically_increasing_id()), "classes")


def components(fps: DataFrame, radius: int = 3, tile: int = TILE, agree: int = 1, wide: int | None = None) -> DataFrame:
    """(fp and further lanes, copies, part, component_id) for every distinct fingerprint of rows (doc_id, fp, further lanes).

    Fingerprints are linked by themselves, so rows without a doc_id link and
    bridge like any other.  part names the component; component_id is its
    smallest doc_id, null if it has none.
    """
    lanes = [c for c in fps.columns if c != "doc_id"]
    distinct = distinct_fingerprints(fps, lanes)
    return linked_classes(distinct, lanes, link_edges(distinct.select(*lanes, F.col("node").alias("rep")), radius, tile, agree, wide))


def linked_classes(distinct: DataFrame, lanes: list[str], edges: DataFrame) -> DataFrame:
    """Components of distinct fingerprints over edges (a, b) of their nodes."""
    parts = connected_components(edges).withColumnRenamed("component", "linked")
    classes = materialize(distinct.join(parts, "node", "left").select(*lanes, "least", "copies", F.coalesce("linked", "node").alias("part")), "parts")
    named = classes.groupBy("part").agg(F.min("least").alias("component_id"), F.count("*").alias("members"))
    return join_classes(classes, named, "part", "members", classes.count()).select(*lanes, "copies", "part", "component_id")


def near_duplicates(docs: DataFrame, radius: int = 3, words: int = 3, seed: int = 42, tile: int = TILE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, kept.

    component_id is the smallest doc_id that can be reached over links
    (fingerprints at ``radius`` bits or fewer), the document's own included;
    kept marks that document.  Texts without words have fingerprint zero and
    link like any other.  Equal fingerprints are one class and are compared
    once.  Null texts count as empty.  Rows that repeat a doc_id each get a
    row; rows whose doc_id is null get a component but can't name it, so they
    have component_id null if no document with an id is in it.  An empty table
    gives an empty result; further columns of ``docs`` are ignored.
    """
    fps = materialize(fingerprints(docs, words, seed), "simhash")
    return join_classes(fps, components(fps, radius, tile), "fp", "copies", fps.count()).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
