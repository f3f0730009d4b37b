"""Near-duplicate embeddings by an epsilon grid order join.

Vectors at cosine ``c`` or more are at most ``sqrt(2 - 2c)`` apart on the unit
sphere.  They are sorted by the cells, of that size, of a grid on their leading
principal dimensions, and cut into tiles of the sequence.  Pairs of intervals of
the sequence are joined from the whole downward: a pair whose boxes on the leading
dimensions are further apart than that distance is skipped with all it holds, any
other is split.  Above the tiles the intervals are rows of a table and a step is an
equi-join on the parent; inside a pair of tiles the same recursion runs in numpy
down to short runs, whose vectors are compared.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import vector_sum, written
from tidewell.llm.simhash import components
from tidewell.llm.whitening import is_finite
from tidewell.operators.numbering import numbered

#: Dimensions of the grid, bytes of a tile's vectors in float32, rows of a run,
#: children of an interval of tiles.
GRID_DIMS, TILE_BYTES, RUN_ROWS, FAN_OUT = 8, 1 << 21, 512, 16
#: Distances on the grid are rounded by less than this.
SLACK = 1e-6


def matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """The vectors as rows of doubles, short ones filled up with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(size), dim))
    if (size == dim).all():
        return flat.reshape(-1, dim)
    out[np.arange(dim) < size[:, None]] = flat
    return out


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two, exactly, so that their squares do not overflow."""
    _, e = np.frexp(np.abs(x).max(axis=1, initial=0))
    return np.ldexp(x, -e[:, None])


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.linalg.norm(x, axis=1)[:, None]


def _principal(reps: DataFrame, dim: int) -> tuple[np.ndarray, int]:
    """The leading principal dimensions of the unit vectors as columns, and the
    number of vectors; one pass that sums products of entries."""
    def of(batch):
        u = unit(matrix(batch.column(0), dim))
        yield np.concatenate([[len(u)], u.sum(axis=0), (u.T @ u).ravel()])

    t = vector_sum(reps.select("vec"), of)
    if t is None:
        return np.zeros((dim, 0)), 0
    n, mean = t[0], t[1:dim + 1] / t[0]
    _, w = np.linalg.eigh(t[dim + 1:].reshape(dim, dim) / n - np.outer(mean, mean))
    return w[:, ::-1][:, :GRID_DIMS].copy(), int(n)


def _tiles(reps: DataFrame, dim: int, w: np.ndarray, n: int, eps: float) -> DataFrame:
    """``tile`` (number in the sequence), its ``rids``, ``copies``, ``vecs``
    (doubles or floats as given) and its box ``lo``, ``hi`` on the grid's dimensions."""
    m = w.shape[1]
    rows = max(64, TILE_BYTES // (4 * dim))

    def celled(batches):
        for b in batches:
            p = unit(matrix(b.column(2), dim)) @ w
            # the grid, then a finer one that keeps what is close together within a cell
            cells = np.hstack([np.floor(p / eps), np.floor(p / (eps / 8))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2),
                 pa.ListArray.from_arrays(np.arange(0, cells.size + 1, 2 * m, dtype=np.int32), pa.array(cells.ravel()))],
                names=["rid", "copies", "vec", "cells"])

    vec_type = reps.schema["vec"].dataType.simpleString()
    keyed = reps.mapInArrow(celled, f"rid bigint, copies bigint, vec {vec_type}, cells array<int>")
    spread = max(1, min(int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / rows)))
    placed = numbered(keyed, ["cells"], name="place", partitions=spread).drop("cells") \
        .withColumn("tile", F.floor(F.col("place") / rows))

    def packed(table: pa.Table) -> pa.Table:
        t = table.sort_by("place")
        p = unit(matrix(t["vec"], dim)) @ w
        raw = matrix(t["vec"], dim)
        if "float" in vec_type:
            raw = raw.astype(np.float32)
        return pa.table({"tile": t["tile"].slice(0, 1), "rids": pa.array([t["rid"].to_numpy().tobytes()]),
                         "copies": pa.array([t["copies"].to_numpy().tobytes()]), "vecs": pa.array([raw.tobytes()]),
                         "lo": pa.array([p.min(axis=0).tolist()]), "hi": pa.array([p.max(axis=0).tolist()])})

    return written(placed.groupBy("tile").applyInArrow(
        packed, "tile bigint, rids binary, copies binary, vecs binary, lo array<double>, hi array<double>"), "ego-tiles")


def _tile_pairs(tiles: DataFrame, count: int, dims: int, eps: float) -> DataFrame:
    """Pairs a <= b of tiles that are not provably distant."""
    def nodes(level: int) -> DataFrame:
        box = [f(F.col(c)[k]).alias(f"{c}{k}") for k in range(dims) for f, c in ((F.min, "lo"), (F.max, "hi"))]
        return tiles.groupBy(F.floor(F.col("tile") / FAN_OUT ** level).alias("node")).agg(F.count("*").alias("tiles"), *box)

    level = 0
    while FAN_OUT ** level < count:
        level += 1
    pairs = written(nodes(level).select(F.col("node").alias("a"), F.col("node").alias("b")), "ego-pairs")
    while level:
        level -= 1
        here = written(nodes(level).withColumn("up", F.floor(F.col("node") / FAN_OUT)), "ego-nodes")
        x, y = here.alias("x"), here.alias("y")
        gap = sum((F.pow(F.greatest(F.lit(0.0), F.col(f"x.lo{k}") - F.col(f"y.hi{k}"), F.col(f"y.lo{k}") - F.col(f"x.hi{k}")), 2)
                   for k in range(dims)), F.lit(0.0))
        pairs = written(pairs.join(x, F.col("a") == F.col("x.up")).join(y, (F.col("b") == F.col("y.up")) & (F.col("x.node") <= F.col("y.node")))
                        .filter(gap <= eps * eps).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")), "ego-pairs")
    return pairs


class Side:
    """The vectors of a tile, with boxes of its runs."""

    def __init__(self, rids: bytes, copies: bytes, vecs: bytes, dtype, dim: int, w: np.ndarray):
        self.rids, self.copies = np.frombuffer(rids, np.int64), np.frombuffer(copies, np.int64)
        self.raw = scaled(np.frombuffer(vecs, dtype).reshape(-1, dim).astype(np.float64))
        self.norm = np.linalg.norm(self.raw, axis=1)
        u = self.raw / self.norm[:, None]
        self.unit = u.astype(np.float32)
        p, at = u @ w, np.arange(0, len(u), RUN_ROWS)
        self.lo, self.hi = np.minimum.reduceat(p, at, axis=0), np.maximum.reduceat(p, at, axis=0)


def join_tiles(a: Side, b: Side, same: bool, cosine: float, eps: float):
    """(links of each row of a, of each row of b, root of each in the links met):
    rows of b are numbered after those of a; copies count, a row's own do not."""
    na = len(a.rids)
    links = np.zeros(na + (0 if same else len(b.rids)), np.int64)
    shift = 0 if same else na
    root = np.arange(len(links))
    dim = a.raw.shape[1]
    margin = (dim + 8) * 1.2e-7  # of a product of unit vectors in float32

    def merge(i: np.ndarray, j: np.ndarray) -> None:
        while True:
            x, y = root[i], root[j]
            apart = x != y
            if not apart.any():
                return
            i, j, x, y = i[apart], j[apart], x[apart], y[apart]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (root[root] != root).any():
                root[:] = root[root]

    def compare(s: int, t: int) -> None:
        i0, j0 = s * RUN_ROWS, t * RUN_ROWS
        x, y = a.unit[i0:i0 + RUN_ROWS], b.unit[j0:j0 + RUN_ROWS]
        product = x @ y.T
        near = product >= cosine - margin
        if same and s == t:
            near &= np.tri(len(x), dtype=bool).T
            np.fill_diagonal(near, False)
        if not near.any():
            return
        i, j = np.nonzero(near)
        unsure = np.nonzero(product[i, j] < cosine + margin)[0]
        if len(unsure):
            p, q = i[unsure] + i0, j[unsure] + j0
            exact = np.einsum("ij,ij->i", a.raw[p], b.raw[q]) / (a.norm[p] * b.norm[q])
            far = unsure[exact < cosine]
            near[i[far], j[far]] = False
            i, j = np.nonzero(near)
        weight = near.astype(np.int64)
        links[i0:i0 + len(x)] += weight @ b.copies[j0:j0 + len(y)]
        links[shift + j0:shift + j0 + len(y)] += a.copies[i0:i0 + len(x)] @ weight
        merge(i + i0, j + j0 + shift)

    def recurse(s: range, t: range) -> None:
        """Runs ``s`` of a with runs ``t`` of b."""
        if same and t[-1] < s[0]:
            return
        gap = np.maximum(0, np.maximum(a.lo[s].min(axis=0) - b.hi[t].max(axis=0), b.lo[t].min(axis=0) - a.hi[s].max(axis=0)))
        if gap @ gap > eps * eps:
            return
        if len(s) == 1 and len(t) == 1:
            compare(s[0], t[0])
            return
        cut = lambda r: [r[:(len(r) + 1) // 2], r[(len(r) + 1) // 2:]] if len(r) > 1 else [r]
        for x in cut(s):
            for y in cut(t):
                recurse(x, y)

    if na and len(b.rids):
        recurse(range(len(a.lo)), range(len(b.lo)))
    return links, root


def _joined(tiles: DataFrame, pairs: DataFrame, dim: int, w: np.ndarray, dtype, cosine: float, eps: float) -> DataFrame:
    """(rid, links, root): a row for each vector that has links in a pair of
    tiles, with their number and the first vector of its group there."""
    numbers = pairs.withColumn("pair", F.struct("a", "b"))
    sides = numbers.select("pair", F.explode(F.array_distinct(F.array("a", "b"))).alias("tile"))
    both = sides.join(tiles.drop("lo", "hi"), "tile")

    def of(table: pa.Table) -> pa.Table:
        t = table.sort_by("tile")
        got = [Side(*(t[c][k].as_py() for c in ("rids", "copies", "vecs")), dtype, dim, w) for k in range(len(t))]
        same = len(got) == 1
        links, root = join_tiles(got[0], got[-1], same, cosine, eps)
        rids = got[0].rids if same else np.concatenate([x.rids for x in got])
        has = np.nonzero(links)[0]
        return pa.table({"rid": rids[has], "links": links[has], "root": rids[root[has]]})

    return both.groupBy("pair").applyInArrow(of, "rid bigint, links bigint, root bigint")


def classes(vectors: DataFrame, cosine: float = 0.9, vec_id: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """Per row of ``vectors``: ``vec_id``, ``n_links`` (other rows at ``cosine``
    or more), ``component_id`` (the smallest id reachable by links) and ``kept``.

    Vectors that are null, empty or zero or hold null or non-finite entries have no
    links.  Shorter vectors compare as if zeros followed.  Rows are told apart: equal rows
    link with each other, and a row's ``kept`` is whether its id is that of its component.
    Null ids come after all others; a component of null ids only has a null id and
    keeps its rows.  Other columns of ``vectors`` are not looked at."""
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(vec).alias("vec"))
    some = F.exists("vec", lambda x: x != 0)
    reps = rows.filter(is_finite(F.col("vec"))).filter(some).groupBy("vec") \
        .agg(F.min("id").alias("first"), F.count("*").alias("copies"))
    reps = written(reps.withColumn("rid", F.monotonically_increasing_id()), "ego-vectors")
    dim = reps.agg(F.max(F.size("vec"))).first()[0]
    found = reps.select("rid", "first", "vec", (F.col("copies") - 1).alias("n_links"), F.col("first").alias("component"))
    if dim:
        eps = math.sqrt(max(0.0, 2 - 2 * cosine)) + SLACK
        w, n = _principal(reps, dim)
        tiles = _tiles(reps.select("rid", "copies", "vec"), dim, w, n, eps)
        pairs = _tile_pairs(tiles, tiles.count(), w.shape[1], eps)
        dtype = np.float32 if "float" in reps.schema["vec"].dataType.simpleString() else np.float64
        met = written(_joined(tiles, pairs, dim, w, dtype, cosine, eps), "ego-links")
        links = met.groupBy("rid").agg(F.sum("links").alias("links")).withColumnRenamed("rid", "l_rid")
        groups = components(met.filter("rid <> root").select(F.least("rid", "root").alias("a"), F.greatest("rid", "root").alias("b")).distinct())
        named = groups.join(reps.select("rid", "first"), F.col("node") == F.col("rid")).select("node", "root", "first")
        least = named.groupBy("root").agg(F.min("first").alias("component"))
        member = named.join(least, "root").select("node", "component")
        found = reps.join(links, F.col("rid") == F.col("l_rid"), "left").join(member, F.col("rid") == F.col("node"), "left").select(
            "rid", "first", "vec", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "first").alias("component"))
    by = found.select(F.col("vec").alias("r_vec"), "n_links", "component", F.lit(True).alias("linked"))
    out = rows.join(by, F.col("vec") == F.col("r_vec"), "left")
    component = F.when(F.col("linked"), F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
