"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows X stay in packed blocks on the cluster.  A step multiplies
them by one right vector and the resulting left vector by the transpose, both
in the same pass: a task needs its own rows of the left vectors only, and makes
them again from the right vectors and the small coefficients of the steps
before, so that nothing of the length of the table is stored or sent.  The
driver holds vectors of the embeddings' dimension and matrices of the number of
steps.  Left and right vectors are orthogonalised against all earlier ones in
each step.  The singular values and vectors of the small bidiagonal matrix give
deviations and components.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import vector_sum, written

SCALE, SHIFT = 1024.0, 100_000
#: Scaled entries beyond +-2**40 count as that, so that integers stay exact.
ENTRY_LIMIT = float(2 ** 40)
BLOCK_BYTES = 1 << 21
#: A component with less than this share of the largest deviation is rounding.
RANK_SHARE = 1e-12
EPS = float(np.finfo(float).eps)


def is_finite(vec: Column) -> Column:
    """The vector is not null and holds no null and no non-finite entry."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(vec, fine), F.lit(False))


@dataclass
class Blocks:
    """Integer vectors of one dimension: ``table`` holds ``ids`` (list) and
    ``x`` (little-endian int64, row after row); ``sums`` per dimension."""
    table: DataFrame
    rows: int
    dim: int
    sums: list[int]


def pack(vectors: DataFrame, vec_id: str, vec: str) -> Blocks:
    spark = vectors.sparkSession
    fine = vectors.select(F.col(vec_id).alias("id"), F.col(vec).alias("vec")).filter(is_finite(F.col("vec")))
    common = fine.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dim = common["d"] if common else 0
    id_type = fine.schema["id"].dataType.simpleString()
    schema = f"ids array<{id_type}>, x binary, sums array<bigint>"
    if not dim:
        return Blocks(spark.createDataFrame([], schema).drop("sums"), 0, 0, [])
    step = max(1, BLOCK_BYTES // (8 * dim))

    def of(batches):
        for b in batches:
            for at in range(0, b.num_rows, step):
                part = b.slice(at, step)
                flat = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                x = np.clip(np.floor(flat * SCALE), -ENTRY_LIMIT, ENTRY_LIMIT).astype("<i8").reshape(-1, dim) + SHIFT
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), part.column(0)),
                     pa.array([x.tobytes()], pa.binary()),
                     pa.array([x.sum(axis=0).tolist()], pa.list_(pa.int64()))], names=["ids", "x", "sums"])

    table = written(fine.filter(F.size("vec") == dim).mapInArrow(of, schema), "whitening-blocks")
    sums = table.select(F.posexplode("sums").alias("k", "s")).groupBy("k") \
        .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    rows = table.agg(F.sum(F.size("ids"))).first()[0]
    return Blocks(table.drop("sums"), int(rows), dim, [int(r["s"]) for r in sorted(sums, key=lambda r: r["k"])])


def centred(x: bytes, dim: int, rows: int, sums: list[int]) -> np.ndarray:
    """``rows * x - sums``, exactly: int64 if that holds it, else Python integers."""
    x = np.frombuffer(x, "<i8").reshape(-1, dim)
    if rows * int(np.abs(x).max(initial=0)) + max(map(abs, sums)) < 2 ** 62:
        return x * rows - np.array(sums, np.int64)
    return x.astype(object) * rows - np.array(sums, object)


def total(blocks: Blocks, of_block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over the blocks of ``of_block(centred rows)``, a flat vector of a
    size that depends on the dimension only."""
    rows, dim, sums = blocks.rows, blocks.dim, blocks.sums

    def of(batch):
        for x in batch.column(0):
            yield of_block(centred(x.as_py(), dim, rows, sums).astype(np.float64) / rows)

    return vector_sum(blocks.table.select("x"), of)


def left_vectors(x: np.ndarray, v: np.ndarray, coef: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    """The rows' part of the left vectors of the first ``len(alpha)`` steps.
    Column after column, so that each pass makes the same bits."""
    u = np.zeros((len(x), len(alpha)))
    for j, a in enumerate(alpha):
        if a > 0:
            u[:, j] = (x @ v[:, j] - u[:, :j] @ coef[:j, j]) / a
    return u


def leading(product, dim: int, want: int, norm: float, locked: np.ndarray, tol: float, rng) -> tuple[np.ndarray, np.ndarray, bool]:
    """The ``want`` largest singular values of X and their right vectors,
    orthogonal to the columns of ``locked``; True if the whole remaining space
    was searched.  ``product(v, coef, alpha)`` gives, for the newest right
    vector v[:, -1] less its known coefficients, (U'p, p'p, X'p)."""
    room = dim - locked.shape[1]
    v, coef, back = np.zeros((dim, 0)), np.zeros((0, 0)), np.zeros((dim, 0))
    alpha, beta = np.zeros(0), np.zeros(0)

    def orthogonal(q: np.ndarray) -> np.ndarray:
        for _ in range(2):
            q = q - locked @ (locked.T @ q)
            q = q - v @ (v.T @ q)
        return q

    def fresh() -> np.ndarray:
        q = orthogonal(rng.standard_normal(dim))
        return q / np.linalg.norm(q)

    nothing = norm * dim * EPS
    new, link = fresh(), 0.0
    while True:
        k = len(alpha)
        v = np.column_stack([v, new])
        known = np.zeros(k)
        if k:
            known[-1] = link
        c, pp, xp = product(v, coef, alpha, known)
        known = known + c
        a2 = pp - c @ c
        a = math.sqrt(a2) if a2 > nothing ** 2 else 0.0
        xu = (xp - back @ c) / a if a else np.zeros(dim)
        coef = np.pad(coef, ((0, 1), (0, 1)))
        coef[:k, k] = known
        alpha, back = np.append(alpha, a), np.column_stack([back, xu])
        q = orthogonal(xu)
        link = float(np.linalg.norm(q))
        if link <= nothing:
            link = 0.0
        bidiagonal = np.diag(alpha) + (np.diag(beta, 1) if k else 0)
        left, s, right = np.linalg.svd(bidiagonal)
        done = k + 1 == room
        if done or k + 1 >= want and link and (link * np.abs(left[-1, :want]) <= tol * max(s[0], nothing)).all():
            found = v @ right[:want].T
            return s[:want], found / np.linalg.norm(found, axis=0), done
        beta = np.append(beta, link)
        new = q / link if link else fresh()


def principal(blocks: Blocks, components: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, float]:
    """(deviations, components as columns, trace of the covariance).  Where the
    search ends before it has met the whole space, searches orthogonal to what
    it found follow until none is larger: a repeated value has one copy in a
    search."""
    dim, n = blocks.dim, blocks.rows
    want = min(components, dim)
    squares = total(blocks, lambda x: np.array([(x * x).sum()]))[0] if n else 0.0
    norm = math.sqrt(squares)
    if not norm:
        return np.zeros(0), np.zeros((dim, 0)), 0.0

    def product(v, coef, alpha, known):
        k = len(alpha)

        def of_block(x):
            u = left_vectors(x, v[:, :k], coef, alpha)
            p = x @ v[:, k] - u @ known
            return np.concatenate([u.T @ p, [p @ p], x.T @ p])

        t = total(blocks, of_block)
        return t[:k], t[k], t[k + 1:]

    rng = np.random.default_rng(seed)
    tight = 4 * EPS
    s, w, done = leading(product, dim, want, norm, np.zeros((dim, 0)), tight, rng)
    while not done and w.shape[1] < dim:
        more, _, done_more = leading(product, dim, 1, norm, w, 1e-6, rng)
        if more[0] <= s[-1] * (1 + 1e-9):
            break
        more, x, done = leading(product, dim, min(want, dim - w.shape[1]), norm, w, tight, rng)
        s, w = np.append(s, more), np.column_stack([w, x])
        order = np.argsort(-s, kind="stable")[:want]
        s, w = s[order], w[:, order]
    keep = s > max(s[0] * RANK_SHARE, norm * dim * EPS)
    s, w = s[keep], w[:, keep]
    w = w * np.where(w[np.abs(w).argmax(axis=0), np.arange(w.shape[1])] < 0, -1.0, 1.0)
    return s / math.sqrt(n), w, squares / n


def whiten(vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", components: int = 8) -> DataFrame:
    """Per vector and component (numbered from 1 by falling deviation): ``id``,
    ``component``, ``n``, ``deviation`` (decimal: the sum of ``(n*x - S)^2``),
    ``whitened``, ``explained``, ``identity_error``.

    Vectors that are null or hold null or non-finite entries are left out, and
    those that have not the most frequent length (of equally frequent ones the
    longer).  An entry is floor(1024 c) + 100000, floor(1024 c) cut at 2**40.  Repeated
    rows and null ids are rows like others; other columns of ``vectors`` are not
    looked at.  Directions in which no vector differs are no components: equal
    vectors, a single one or none give no rows."""
    spark = vectors.sparkSession
    id_type = vectors.schema[vec_id].dataType.simpleString()
    schema = (f"id {id_type}, component int, n bigint, deviation decimal(38,0), whitened double, "
              "explained double, identity_error double")
    blocks = pack(vectors, vec_id, vec)
    n, dim, sums = blocks.rows, blocks.dim, blocks.sums
    dev, w, trace = principal(blocks, components) if n and dim else (np.zeros(0), np.zeros((dim, 0)), 0.0)
    m = len(dev)
    if not m:
        return spark.createDataFrame([], schema)
    project = w / dev

    def moments(x):
        z = x @ project
        return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

    got = total(blocks, moments) / n
    covariance = got[m:].reshape(m, m) - np.outer(got[:m], got[:m])
    error = float(np.abs(covariance - np.eye(m)).max())
    explained = dev ** 2 / trace

    def of(batches):
        for b in batches:
            for ids, x in zip(b.column(0), b.column(1)):
                y = centred(x.as_py(), dim, n, sums)
                if y.dtype != object and int(np.abs(y).max(initial=0)) ** 2 * dim < 2 ** 63:
                    d = pa.array((y * y).sum(axis=1)).cast(pa.decimal128(38, 0))
                else:
                    y = y.astype(object)
                    d = pa.array([int(v) for v in (y * y).sum(axis=1)], pa.decimal128(38, 0))
                z = (y.astype(np.float64) / n) @ project
                at = pa.array(np.repeat(np.arange(len(z)), m))
                size = len(z) * m
                yield pa.RecordBatch.from_arrays(
                    [ids.values.take(at), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(z))),
                     pa.array(np.full(size, n, np.int64)), d.take(at), pa.array(z.ravel()),
                     pa.array(np.tile(explained, len(z))), pa.array(np.full(size, error))],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return blocks.table.mapInArrow(of, schema)
