"""Epsilon grid join against all cosines."""

from __future__ import annotations

import numpy as np
import pytest

from visitflow.llm import epsilon_grid
from visitflow.llm.components import roots

SCHEMA = "vec_id long, embedding array<double>, h1 string, c int, n_links string"


def brute(rows, threshold=0.95):
    """vec_id, n_links, component_id, kept of (id, vector) rows; ids None count as the lowest."""
    good = [
        i for i, (_, v) in enumerate(rows)
        if v is not None and len(v) == 3 and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    x = np.array([rows[i][1] for i in good], float).reshape(-1, 3)
    # Scaled first, so that squares neither overflow nor vanish.
    u = x / np.abs(x).max(axis=1, keepdims=True, initial=1e-300)
    u = u / np.sqrt((u * u).sum(axis=1, keepdims=True))
    links = u @ u.T >= threshold
    np.fill_diagonal(links, False)
    name = [-(2**63) if i is None else i for i, _ in rows]
    count, comp = [0] * len(rows), list(name)
    for k, i in enumerate(good):
        count[i] = int(links[k].sum())
    for _ in rows:
        for k, i in enumerate(good):
            comp[i] = min([comp[i]] + [comp[good[j]] for j in np.flatnonzero(links[k])])
    shown = lambda n: None if n == -(2**63) else n
    return sorted(((shown(n), c, shown(k), n == k) for n, c, k in zip(name, count, comp)), key=str)


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "h", 1, "n") for i, v in rows], SCHEMA)
    return sorted(map(tuple, epsilon_grid.near_duplicates(df, **options).collect()), key=str)


ODD = [(1, [1.0, 0.0, 0.0]), (2, [2.0, 0.1, 0.0]), (3, [1.0, 0.0, 0.0]), (3, [1.0, 0.0, 0.0]), (4, None), (5, [0.0, 0.0, 0.0]), (6, [None, 1.0, 0.0])]
ODD += [(7, [float("nan"), 1.0, 0.0]), (8, [float("inf"), 0.0, 0.0]), (9, [1.0, 0.0]), (None, [0.0, 1.0, 0.0]), (10, [0.0, 1e-200, 0.0]), (11, [0.0, 1e200, 1e199])]
ODD += [(12, [-1.0, 0.0, 0.0]), (13, []), (None, None)]


def test_odd_rows(spark):
    assert found(spark, ODD) == brute(ODD)


def test_empty(spark):
    assert found(spark, ODD[:0]) == [] and found(spark, [(1, None), (2, [0.0, 0.0, 0.0])]) == brute([(1, None), (2, [0.0, 0.0, 0.0])])


@pytest.mark.parametrize("unit_rows", [5, 300])
def test_groups_and_chains(spark, unit_rows):
    """A third of all rows in one tight group, chains of links, copies: many levels and whole intervals."""
    rng = np.random.default_rng(8)
    around = rng.normal(0, 0.01, (120, 3)) + [0.2, 0.5, -0.8]
    ring = [[np.cos(t), np.sin(t), 0.0] for t in np.arange(0, 3, 0.2)]
    rest = rng.normal(0, 1, (150, 3))
    x = np.concatenate([around, ring, rest, around[:40]])
    rows = list(zip(rng.permutation(len(x)).tolist(), x.tolist()))
    assert found(spark, rows, unit_rows=unit_rows) == brute(rows)


def test_threshold_is_met_exactly(spark):
    """3-4-5 triangles: a cosine of exactly 0.8 links at 0.8."""
    rows = [(1, [1.0, 0.0, 0.0]), (2, [4.0, 3.0, 0.0]), (3, [4.0, 3.0000001, 0.0])]
    assert [r[1] for r in found(spark, rows, threshold=0.8)] == [1, 2, 1]


def test_roots():
    rng = np.random.default_rng(1)
    for size in [30] * 50 + [200] * 5:
        a, b = rng.integers(0, size, (2, rng.integers(1, size)))
        node, root = roots(a, b)
        low = {int(n): int(n) for n in node}
        for _ in node:
            for p, q in zip(a.tolist(), b.tolist()):
                low[p] = low[q] = min(low[p], low[q])
        assert dict(zip(node.tolist(), root.tolist())) == low


def test_components_of_many_chunks(spark, monkeypatch):
    from visitflow.llm import components
    from visitflow.llm.common import Scratch

    monkeypatch.setattr(components, "CHUNK_EDGES", 20)
    rng = np.random.default_rng(2)
    a = np.concatenate([rng.permutation(np.arange(400)), np.arange(1000, 1200)])
    b = np.concatenate([np.roll(a[:400], 1) // 2 * 2, np.full(200, 1000)])
    edges = spark.createDataFrame(list(zip(a.tolist(), b.tolist())), "a long, b long").repartition(7)
    scratch = Scratch(spark)
    got = {r["node"]: r["root"] for r in components.connected(edges, scratch).collect()}
    scratch.drop()
    keep = a != b
    node, root = roots(a[keep], b[keep])
    assert got == dict(zip(node.tolist(), root.tolist()))
