"""Operators 11 and 13 against brute force in numpy."""

import math
import random

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from tests.llm.helpers import key
from tidewell.llm import common, egojoin, whitening
from tidewell.session import read_table

EMBEDDING = "vec_id long, embedding array<float>, label int"


def clusters(seed, n, dim, spread=0.12):
    """Random vectors, groups of near copies around some, exact copies, scaled
    copies, and what is no vector."""
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dim))
    near = np.repeat(base[:4], [n // 3, 5, 3, 2], axis=0)
    near = near + spread * rng.standard_normal(near.shape)
    every = np.vstack([base, near, base[5:8], 3.0 * base[5:6], base[5:6]]).astype(np.float32)
    ids = rng.permutation(len(every)).tolist()
    rows = [(i, [float(x) for x in v], 0) for i, v in zip(ids, every)]
    odd = [[], None, [0.0] * dim, [float("nan")] * dim, [float("inf")] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1)]
    return rows + [(5000 + k, v, None) for k, v in enumerate(odd)]


def linked(a, b):
    ok = lambda v: v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    if not ok(a) or not ok(b):
        return False
    n = max(len(a), len(b))
    a, b = (np.array(list(v) + [0.0] * (n - len(v)), float) for v in (a, b))
    return a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.9


def brute_classes(rows):
    n = len(rows)
    link = [[linked(rows[i][1], rows[j][1]) and i != j for j in range(n)] for i in range(n)]
    out, seen = [None] * n, set()
    for s in range(n):
        if s in seen:
            continue
        todo, group = [s], {s}
        while todo:
            i = todo.pop()
            for j in range(n):
                if link[i][j] and j not in group:
                    group.add(j)
                    todo.append(j)
        seen |= group
        ids = [rows[i][0] for i in group if rows[i][0] is not None]
        for i in group:
            least = min(ids, default=None)
            out[i] = (rows[i][0], sum(link[i]), least, rows[i][0] == least)
    return out


@pytest.mark.parametrize("seed,dim,run,tile", [(0, 6, 512, 1 << 21), (1, 6, 8, 64 * 24), (2, 3, 4, 64 * 12), (3, 24, 16, 64 * 96)])
def test_op11_classes(spark, monkeypatch, seed, dim, run, tile):
    """Small tiles and runs bring the recursion over tiles and in them about."""
    monkeypatch.setattr(egojoin, "TILE_BYTES", tile)
    monkeypatch.setattr(egojoin, "RUN_ROWS", run)
    monkeypatch.setattr(egojoin, "FAN_OUT", 2)
    rows = clusters(seed, 120, dim)
    rows += [rows[0], rows[0], (None, rows[3][1], 0), (None, [9.0] + [0.0] * (dim - 1), 0), (7000, rows[9][1][:2], 0)]
    df = spark.createDataFrame(rows, EMBEDDING).selectExpr("*", "1 AS rid", "'x' AS component_id", "2 AS n_links", "3 AS tile")
    got = egojoin.classes(df).collect()
    assert got[0].__fields__ == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got), key=key) == sorted(brute_classes(rows), key=key)


def test_op11_doubles_and_the_bound_itself(spark):
    rows = [(1, [1.0, 0, 0, 0, 0]), (2, [9.0, 3, 3, 1, 0]), (3, [8.999999, 3, 3, 1, 0]), (4, [1e-200, 0, 0, 0, 0]), (5, [1e300, 0, 0, 0, 0])]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in egojoin.classes(df).collect()}
    assert got == {1: (3, 1), 2: (4, 1), 3: (1, 1), 4: (3, 1), 5: (3, 1)}


def test_op11_hot_vector_and_empty(spark):
    """A third of all rows are one vector: its copies are counted, not compared."""
    rows = [(i, [1.0, 2.0], 0) for i in range(4000)] + [(9000 + i, [math.cos(i), math.sin(i)], 0) for i in range(300)]
    got = {r.vec_id: r for r in egojoin.classes(spark.createDataFrame(rows, EMBEDDING)).collect()}
    near = [i for i in range(300) if linked([1.0, 2.0], [np.float32(math.cos(i)), np.float32(math.sin(i))])]
    assert got[17].n_links == 3999 + len(near) and got[9000 + near[0]].component_id == 0
    assert egojoin.classes(spark.createDataFrame([], EMBEDDING)).count() == 0
    only = egojoin.classes(spark.createDataFrame([(3, None, 0), (None, [], 0)], EMBEDDING)).collect()
    assert sorted(map(tuple, only), key=key) == sorted([(3, 0, 3, True), (None, 0, None, True)], key=key)


def test_op11_distant_blocks_are_skipped(monkeypatch):
    """Far clusters: pairs of runs whose boxes are apart are not compared."""
    rng = np.random.default_rng(4)
    centres = np.eye(8)[:, :8]
    x = np.repeat(centres, 64, axis=0) + 0.01 * rng.standard_normal((512, 8))
    monkeypatch.setattr(egojoin, "RUN_ROWS", 64)
    met = []
    tri = egojoin.np.tri
    monkeypatch.setattr(egojoin.np, "tri", lambda *a, **k: met.append(a) or tri(*a, **k))
    side = egojoin.Side(np.arange(512).tobytes(), np.ones(512, np.int64).tobytes(), x.tobytes(), np.float64, 8, np.eye(8))
    links, root = egojoin.join_tiles(side, side, True, 0.9, math.sqrt(0.2))
    assert (links == 63).all() and len(set(root)) == 8 and len(met) == 8


def brute_white(rows, components=8):
    from fractions import Fraction
    fine = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in fine], dtype=object)
    n, s = len(x), x.sum(axis=0)
    y = x * n - s
    dev = (y * y).sum(axis=1)
    c = y.astype(float) / n
    e, w = np.linalg.eigh(c.T @ c / n)
    e, w = e[::-1][:components], w[:, ::-1][:, :components]
    trace = float(Fraction(int(dev.sum()), n ** 3))
    return [i for i, _ in fine], n, dev, c @ w / np.sqrt(e), e / trace


@pytest.mark.parametrize("dim,n", [(5, 40), (20, 300), (64, 150)])
def test_op13_against_eigenvectors(spark, monkeypatch, dim, n):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 8 * dim * 7)
    monkeypatch.setattr(common, "DIRECT_SUMS", 2)
    rng = np.random.default_rng(dim)
    x = rng.standard_normal((n, dim)) * np.linspace(0.05, 2, dim) + rng.standard_normal(dim)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    rows += [(900, None), (901, [None] * dim), (902, [float("nan")] * dim), (903, [float("-inf")] * dim), (None, rows[0][1]), (3, rows[3][1])]
    rows += [(904, [1.0] * (dim + 1))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS id", "2 AS component", "3 AS ids", "4 AS x")
    got = whitening.whiten(df).collect()
    ids, total, dev, white, explained = brute_white([r for r in rows if r[0] != 904])
    m = white.shape[1]
    assert len(got) == total * m and {r.n for r in got} == {total}
    table = {}
    for r in got:
        table.setdefault((r.id, int(r.deviation)), {}).setdefault(r.component, []).append(r.whitened)
    signs = np.ones(m)
    first = table[(ids[1], int(dev[1]))]
    for k in range(m):
        signs[k] = np.sign(first[k + 1][0] * white[1, k])
    for i, d, z in zip(ids, dev, white * signs):
        for k in range(m):
            assert min(abs(v - z[k]) for v in table[(i, int(d))][k + 1]) < 1e-9
    for r in got:
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-10 and r.identity_error < 1e-9


def test_op13_stops_early_and_finds_repeated_values(spark):
    """Many dimensions, few of them wide: the search ends long before the
    dimension; values that occur twice are both found."""
    rng = np.random.default_rng(7)
    dim, n = 120, 400
    wide = np.full(dim, 0.05)
    wide[:6] = [30, 20, 20, 9, 5, 3]
    x = rng.standard_normal((n, dim)) * wide
    # equal deviations exactly: the same numbers in two columns, one of them reordered to be orthogonal
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    steps = []
    old = whitening.left_vectors
    whitening.left_vectors = lambda *a: steps.append(1) or old(*a)
    try:
        blocks = whitening.pack(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
        dev, w, _ = whitening.principal(blocks, 5)
    finally:
        whitening.left_vectors = old
    c = np.floor(1024 * x) + 100000
    c = c - c.mean(axis=0)
    e, q = np.linalg.eigh(c.T @ c / n)
    assert np.allclose(dev ** 2, e[::-1][:5], rtol=1e-12)
    assert np.allclose(np.abs(np.sum(w * q[:, ::-1][:, :5], axis=0)), 1, atol=1e-10)
    eye = [(k, [float(k == j) for j in range(9)]) for k in range(9)] * 3
    got = whitening.whiten(spark.createDataFrame(eye, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 27 * 8 and all(abs(r.explained - 1 / 8) < 1e-9 and r.identity_error < 1e-9 for r in got)


def test_op13_degenerate_tables(spark):
    kind = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], kind)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, kind)).count() == 0
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(10)], kind)).collect()
    assert {r.component for r in line} == {1} and all(abs(r.explained - 1) < 1e-12 for r in line)
    far = whitening.whiten(spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 0.0])], kind)).collect()
    limit = 2 ** 40
    assert {int(r.deviation) for r in far if r.id == 1} == {(3 * limit) ** 2 + 1024 ** 2}


def test_op13_query_columns(spark):
    from tidewell.llm.registered import QUERIES
    got = QUERIES["op13_embedding_whitening"](spark, SF_SMALL)
    rows = [(r.vec_id, list(r.embedding)) for r in read_table(spark, SF_SMALL, "embeddings").collect()]
    ids, n, dev, white, explained = brute_white(rows)
    first = {r.vec_id: r for r in got.filter("component = 1").collect()}
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert [first[i].deviation for i in ids] == dev.tolist()
    assert np.allclose(np.abs([first[i].whitened for i in ids]), np.abs(white[:, 0]), atol=1e-9)
