"""Operator 1: near-duplicate vectors by an exact metric range join.

On unit vectors, cosine >= t is Euclidean distance <= r = sqrt(2 - 2t).  Pivots
partition the vectors: each belongs to the cell of its nearest pivot.  By the
triangle inequality a partner of a vector x in the cell of pivot p can only lie
in the cell of q if d(x, q) - d(x, p) <= 2r, so x is copied into those cells
(only those numbered lower than its own, which finds every pair once) and each
cell is joined by itself.  Cells above a tile's size are cut into tiles and the
pairs of tiles are spread over tasks.

There are as many pivots as a sample shows to be worth it: the most for which
a vector goes to REPLICAS cells or fewer on average.  Vectors in clusters
get many small cells; without clusters, in many dimensions, a ball of radius r
reaches most cells whatever the pivots are, and few pivots are best.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_classes, materialize, split_hot
from .components import connected_components
from .simhash import star_edges

TILE = 1024
#: Cells per vector that more pivots may cost, and the bounds of what the driver sees to choose them: bytes of pivots, candidates, vectors in the sample.
REPLICAS, PIVOT_BYTES, CANDIDATES, SAMPLE = 3.0, 8 << 20, 4096, 1000
#: A square root of a difference near zero has an error of about 1e-8, so bounds are looser by more.
SLACK = 1e-6


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of one length as a matrix."""
    flat = column.flatten()
    return np.asarray(flat, np.float64).reshape(len(column), -1)


def _read(batches):
    """vec_id, label, embedding, dim, digest: the digest names equal vectors of a label, and is null for vectors without a cosine."""
    for batch in batches:
        ids, labels, vectors = batch.column("vec_id"), batch.column("label").to_pylist(), batch.column("embedding")
        digests, dims = [], []
        for k, label in enumerate(labels):
            v = vectors[k].values
            good = v is not None and len(v) > 0 and not v.null_count and label is not None and ids[k].is_valid
            if good:
                x = v.to_numpy(zero_copy_only=False).astype(np.float64)
                good = bool(np.isfinite(x).all() and x.any())
            digests.append(hashlib.blake2b(f"{label}|".encode() + x.tobytes(), digest_size=16).digest() if good else None)
            dims.append(len(v) if good else 0)
        yield pa.RecordBatch.from_arrays([ids, batch.column("label"), vectors, pa.array(dims, pa.int32()), pa.array(digests, pa.binary())], ["vec_id", "label", "embedding", "dim", "digest"])


def reached(x: np.ndarray, p: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of every unit vector, and the lower-numbered cells that can hold its partners."""
    d = np.sqrt(np.maximum(0, 2 - 2 * (x @ p.T)))
    own = d.argmin(1)
    nearest = d[np.arange(len(x)), own]
    # The plane halfway between two pivots bounds more tightly than the triangle inequality alone.
    apart = np.sqrt(np.maximum(0, 2 - 2 * (p @ p.T)))[own]
    plane = (d * d - (nearest * nearest)[:, None]) / np.maximum(2 * apart, 1e-300)
    reach = (d - nearest[:, None] <= 2 * radius + SLACK) & ((plane <= radius + SLACK) | (apart < 1e-3))
    return own, reach & (np.arange(len(p))[None, :] < own[:, None])


def _cells(batches, pivots: dict[int, np.ndarray], radius: float):
    """Rows (node, copies, embedding, label, dim, cell, home)."""
    for batch in batches:
        dims = np.asarray(batch.column("dim"))
        for dim in np.unique(dims):
            part = batch.filter(pa.array(dims == dim))
            n = part.num_rows
            where, cell, home = np.arange(n), np.zeros(n, np.int64), np.ones(n, bool)
            if int(dim) in pivots:
                own, reach = reached(_unit(_matrix(part.column("embedding"))), pivots[int(dim)], radius)
                i, j = np.nonzero(reach)
                where, cell = np.concatenate([where, i]), np.concatenate([own, j])
                home = np.concatenate([home, np.zeros(len(i), bool)])
            take = part.take(pa.array(where))
            yield pa.RecordBatch.from_arrays(
                [*(take.column(c) for c in ("node", "copies", "embedding", "label", "dim")), pa.array(cell), pa.array(home)],
                ["node", "copies", "embedding", "label", "dim", "cell", "home"],
            )


def _compare(batches, threshold: float):
    """Rows (node, links, root) for pairs of tiles: what each vector gains here."""
    for batch in batches:
        out = []
        for one, two in zip(batch.column("one"), batch.column("two")):
            same = not two.is_valid
            a = one.values
            b = a if same else two.values
            x = _unit(_matrix(a.field("embedding")))
            y = x if same else _unit(_matrix(b.field("embedding")))
            linked = x @ y.T >= threshold
            if same:
                np.fill_diagonal(linked, False)
            if not linked.any():
                continue
            ids_a, ids_b = np.asarray(a.field("node"), np.int64), np.asarray(b.field("node"), np.int64)
            gain_a = linked @ np.asarray(b.field("copies"), np.float64)
            ids, low = star_edges(ids_a, ids_b, linked)
            out.append((ids_a, gain_a.astype(np.int64), ids_a))
            if not same:
                gain_b = np.asarray(a.field("copies"), np.float64) @ linked
                out.append((ids_b, gain_b.astype(np.int64), ids_b))
            out.append((ids, np.zeros(len(ids), np.int64), low))
        if out:
            node, links, root = (np.concatenate(c) for c in zip(*out))
            keep = (links > 0) | (node != root)
            yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (node, links, root)], ["node", "links", "root"])


def choose_pivots(classes: DataFrame, radius: float, replicas: float = REPLICAS) -> dict[int, np.ndarray]:
    """Pivots for the commonest length: distinct vectors in hash order, two at least where there are two.

    Any choice gives the same links; the choice only sets how large cells are
    and how many copies they take.  Vectors of other lengths make one cell each.
    """
    dims = classes.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if dims is None:
        return {}
    dim = int(dims["dim"])
    most = max(2, min(CANDIDATES, PIVOT_BYTES // (8 * dim)))
    # One bounded read: candidates for pivots, then the sample that they are tried on.
    rows = classes.where(F.col("dim") == dim).orderBy(F.xxhash64("digest"), "digest").limit(most + SAMPLE).select("embedding").collect()
    x = _unit(np.array([r[0] for r in rows], np.float64))
    sample, candidates = x[-min(SAMPLE, len(x)) :], x[:most]
    # Pivots near each other would only share a cluster's vectors out, so later ones keep away from earlier ones.
    net = [0]
    for k in range(1, len(candidates)):
        if 2 - 2 * (candidates[net] @ candidates[k]).max() > (2 * radius) ** 2:
            net.append(k)
    net += [k for k in range(1, len(candidates)) if k not in set(net)][: max(0, 2 - len(net))]
    best, number = 2, 4
    while number <= min(len(net), max(2, dims["count"] // 64)):
        if 1 + reached(sample, candidates[net[:number]], radius)[1].sum() / len(sample) <= replicas:
            best = number
        number *= 2
    return {dim: candidates[net[:best]]}


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, tile: int = TILE, replicas: float = REPLICAS) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors link if their labels are equal and not null, their lengths are
    equal and their cosine in double precision is at least ``threshold``.
    n_links counts the other rows a row links with directly; component_id is
    the smallest vec_id reachable over links, its own included; kept marks that
    row.  Vectors that are null, empty or zero, or that hold null or non-finite
    components, and vectors whose label or vec_id is null, link with nothing.
    Equal vectors of a label are one class that is compared once, with its
    number of copies.  Repeated vec_ids are separate vectors with one id.  An
    empty table gives an empty result; further columns are ignored.
    """
    kinds = {f.name: f.dataType.simpleString() for f in vectors.select("label", "embedding").schema}
    if kinds["embedding"] not in ("array<float>", "array<double>"):
        vectors, kinds["embedding"] = vectors.withColumn("embedding", F.col("embedding").cast("array<double>")), "array<double>"
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding").mapInArrow(
        _read, f"vec_id long, label {kinds['label']}, embedding {kinds['embedding']}, dim int, digest binary"
    )
    classes = materialize(
        base.where("digest is not null").groupBy("digest").agg(
            F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.first("dim").alias("dim"), F.min("vec_id").alias("least"), F.count("*").alias("copies")
        ).withColumn("node", F.monotonically_increasing_id()), "vectors",
    )
    radius = math.sqrt(max(0.0, 2 - 2 * threshold))
    pivots = classes.sparkSession.sparkContext.broadcast(choose_pivots(classes, radius, replicas))
    cells = classes.select("node", "copies", "embedding", "label", "dim").mapInArrow(
        lambda it: _cells(it, pivots.value, radius),
        f"node long, copies long, embedding {kinds['embedding']}, label {kinds['label']}, dim int, cell long, home boolean",
    )
    cell = ["label", "dim", "cell"]
    tiles = materialize(
        split_hot(cells, [*cell, "home"], "node", tile).groupBy(*cell, "home", "tile")
        .agg(F.collect_list(F.struct("node", "copies", "embedding")).alias("members")), "tiles",
    )
    keys = tiles.select(*cell, "home", "tile")
    pairs = (
        keys.where("home").withColumnRenamed("tile", "tile_one").drop("home")
        .join(keys.select(*cell, F.col("home").alias("home_two"), F.col("tile").alias("tile_two")), cell)
        .where("not home_two or tile_two >= tile_one")
    )
    own = F.col("home_two") & (F.col("tile_one") == F.col("tile_two"))
    joined = pairs.join(
        tiles.where("home").select(*cell, F.col("tile").alias("tile_one"), F.col("members").alias("one")), [*cell, "tile_one"]
    ).join(
        tiles.select(*cell, F.col("home").alias("home_two"), F.col("tile").alias("tile_two"), F.col("members").alias("other")),
        [*cell, "home_two", "tile_two"],
    ).select("one", F.when(~own, F.col("other")).alias("two"))
    found = materialize(
        joined.mapInArrow(lambda it: _compare(it, threshold), "node long, links long, root long"), "links"
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select("node", "root"), "node", "root")
    told = materialize(
        classes.select("digest", "node", "least", "copies").join(links, "node", "left").join(parts, "node", "left").select(
            "digest", "copies", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("part")
        ), "parts",
    )
    n_classes, total = told.agg(F.count("*"), F.sum("copies")).first()
    named = told.groupBy("part").agg(F.min("least").alias("component_id"), F.count("*").alias("members"))
    named = join_classes(told, named, "part", "members", n_classes).select("digest", "copies", "n_links", "component_id")
    linked = join_classes(base.where("digest is not null").select("vec_id", "digest"), named, "digest", "copies", total or 0).select("vec_id", "n_links", "component_id")
    single = base.where("digest is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(single).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
