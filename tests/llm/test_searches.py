"""Both vector searches against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from visitflow.llm import ann_tree, topk_histogram
from visitflow.llm.common import table
from visitflow.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, rank string, score string, id int, v string"


def vectors(spark, rows):
    """Rows (vec_id, vector) with extra columns that clash with the operators' own names."""
    return spark.createDataFrame([(i, v, "r", "s", 0, "v") for i, v in rows], SCHEMA)


def usable(rows, zero_ok=True):
    out = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or len(v) != 3:
            continue
        if zero_ok or any(v):
            out.append((i, np.float32(v).astype(float)))
    return out


ODD = [
    (0, [1.0, 0.0, 0.5]),
    (1, [1.0, 0.0, 0.5]),
    (2, [2.0, 0.0, 1.0]),
    (3, None),
    (4, [None, 1.0, 2.0]),
    (5, [float("nan"), 1.0, 2.0]),
    (6, [float("inf"), 1.0, 2.0]),
    (7, [0.0, 0.0, 0.0]),
    (8, [1.0, 2.0]),
    (None, [1.0, 1.0, 1.0]),
    (20, [-0.3, 0.2, 0.9]),
    (21, [-0.3, 0.2, 0.9]),
    (40, [0.1, 0.2, -0.9]),
    (50, [0.1, 0.2, -0.9]),
    (60, []),
]


def brute_top(rows, k, queries):
    cut = [(i, np.floor(64 * v).astype(int)) for i, v in usable(rows)]
    out = []
    for qi, q in cut:
        if queries(qi):
            best = sorted((-int(q @ v), i) for i, v in cut if i != qi)[:k]
            out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("k", [1, 3, 20])
def test_top_k_with_odd_rows(spark, k):
    rows = vectors(spark, ODD)
    got = topk_histogram.top_k(rows.where("vec_id % 20 = 0"), rows, k)
    assert sorted(map(tuple, got.collect())) == brute_top(ODD, k, lambda i: i % 20 == 0)


def test_top_k_large_components_and_repeats(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in rng.normal(0, 300, 3).astype(np.float32)]) for i in range(60)]
    rows += [(61, rows[5][1]), (62, rows[5][1]), (61, rows[7][1])]
    df = vectors(spark, rows)
    got = topk_histogram.top_k(df.where("vec_id % 20 = 0"), df, 4)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 4, lambda i: i % 20 == 0)


def test_searches_on_empty_tables(spark):
    none = vectors(spark, [])
    some = vectors(spark, ODD)
    for q, c in ((none, none), (none, some), (some, none)):
        assert topk_histogram.top_k(q, c, 5).count() == 0
        assert ann_tree.search(q, c, 5).count() == 0


def test_nearest_with_odd_rows(spark):
    rows = vectors(spark, ODD)
    got = sorted(map(tuple, ann_tree.search(rows.where("vec_id % 50 = 0"), rows, 5).collect()))
    good = usable(ODD, zero_ok=False)
    want = []
    for qi, q in good:
        if qi % 50 == 0:
            cos = sorted((-round(q @ v / np.sqrt(q @ q) / np.sqrt(v @ v), 9), i) for i, v in good if i != qi)[:5]
            want += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(cos)]
    assert [(a, b, c, round(d, 9) + 0.0) for a, b, c, d in got] == sorted(want)


def test_recall_on_the_table(spark):
    rows = table(spark, MEDIUM, "embeddings")
    got = QUERIES["op1_ann_tree"](spark, MEDIUM).toPandas()
    all_rows = rows.where("embedding is not null").toPandas()
    x = np.stack(all_rows["embedding"]).astype(float)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    ids = all_rows["vec_id"].to_numpy()
    found = wanted = 0
    for q in ids[ids % 50 == 0]:
        score = x @ x[ids == q][0]
        score[ids == q] = -2
        best = set(ids[np.lexsort((ids, -score))[:5]])
        mine = got[got["query_id"] == q]
        assert list(mine.sort_values("rank")["rank"]) == list(range(1, 6))
        found += len(best & set(mine["vec_id"]))
        wanted += len(best)
        for row in mine.itertuples():
            assert abs(score[ids == row.vec_id][0] - row.score) < 1e-12
    assert found >= 0.9 * wanted


def test_tree_widens_until_recall():
    rng = np.random.default_rng(2)
    x = ann_tree.unit(rng.normal(size=(3000, 16)))
    tree = ann_tree.fit_tree(x)
    assert set(tree.descend(x)) == set(range(tree.leaves))
    few, many = (ann_tree.calibrate(tree, x, 5, target, 100) for target in (0.5, 0.97))
    assert 1 <= few <= many <= tree.leaves
    assert sorted(tree.visit(x[0], tree.leaves)) == list(range(tree.leaves))


def test_equal_vectors_of_a_third_of_the_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 300)]
    rows += [(i, [float(x) for x in rng.normal(size=3).astype(np.float32)]) for i in range(300, 900)]
    df = vectors(spark, rows)
    got = ann_tree.search(df.where(F.col("vec_id") == 50), df, 5).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [0, 1, 2, 3, 4]


def test_calibration_queries_are_held_out(monkeypatch, spark):
    fitted, asked = [], []
    fit, calibrate = ann_tree.fit_tree, ann_tree.calibrate
    monkeypatch.setattr(ann_tree, "CALIBRATION_QUERIES", 20)
    monkeypatch.setattr(ann_tree, "fit_tree", lambda x, **more: fitted.append(x) or fit(x, **more))
    monkeypatch.setattr(ann_tree, "calibrate", lambda *a: asked.extend(a[5:]) or calibrate(*a))
    x = np.random.default_rng(6).normal(size=(300, 4))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    assert ann_tree.search(rows.limit(5), rows, k=3).count() == 15
    assert len(asked) == 1 and 20 <= len(asked[0]) <= 21 and len(asked[0]) + len(fitted[0]) == 300
    assert not {tuple(v) for v in asked[0]} & {tuple(v) for v in fitted[0]}


def test_length_is_the_candidates(spark):
    """Queries of another common length than the candidates': only those of the candidates' length are asked."""
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(1, 30)]
    rows += [(100, [1.0, 2.0]), (150, [2.0, 1.0]), (50, [0.3, -0.2, 0.9])]
    frame = vectors(spark, rows)
    asked = frame.where("vec_id % 50 = 0")
    near = ann_tree.search(asked, frame, k=3).collect()
    assert {r["query_id"] for r in near} == {50} and len(near) == 3
    top = sorted(map(tuple, topk_histogram.top_k(asked, frame, k=4).collect()))
    assert top == brute_top(rows, 4, lambda i: i % 50 == 0)


def test_nearest_broadcasts_nothing(monkeypatch, spark):
    """Spark sizes exploded rows and arrays too low: a join that it plans as a broadcast fills the driver."""
    plans, stored = [], ann_tree.stored

    def seen(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, label)

    monkeypatch.setattr(ann_tree, "stored", seen)
    x = np.random.default_rng(7).normal(size=(40, 4))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann_tree.search(rows.limit(5), rows, k=3)
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    assert got.count() == 15
    assert len(plans) == 5 and not [p for p in plans if "Broadcast" in p]


def shuffled_rows(plan):
    """Mean bytes of a row in each shuffle of an executed plan."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return shuffled_rows(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled_rows(plan.plan())
    got = [x for i in range(plan.children().size()) for x in shuffled_rows(plan.children().apply(i))]
    if kind == "ShuffleExchangeExec":
        size, rows = (plan.metrics().apply(x).value() for x in ("dataSize", "shuffleRecordsWritten"))
        got.append(size / max(1, rows))
    return got


def test_no_row_holds_many_vectors(monkeypatch, spark):
    """Blocks of many vectors in a row, thousands of rows an Arrow batch, fill an executor's memory."""
    wide, stored = [], ann_tree.stored

    def seen(df, label):
        df.count()
        if label == "ann-best":
            df.collect()
            wide.extend(shuffled_rows(df._jdf.queryExecution().executedPlan()))
        return stored(df, label)

    monkeypatch.setattr(ann_tree, "stored", seen)
    x = np.random.default_rng(8).normal(size=(3000, 8))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    assert ann_tree.search(rows.where("vec_id < 400"), rows, k=3).count() == 1200
    assert len(wide) >= 2 and max(wide) < 10 * 8 * 8


def test_cells_cover_the_leaves():
    x = ann_tree.unit(np.random.default_rng(9).normal(size=(900, 8)))
    tree = ann_tree.fit_tree(np.concatenate([x, np.repeat(x[:1], 500, axis=0)]))
    sample = np.concatenate([x, np.repeat(x[:1], 500, axis=0)])
    cells = ann_tree.dealt_cells(tree, sample, 14000, 1500)
    size = np.bincount(tree.descend(sample), minlength=tree.leaves) * 10
    load = np.zeros(cells[-1][-1] + 1)
    for own, n in zip(cells, size):
        load[list(own)] += n / len(own)
    assert load.min() > 0 and load.max() <= 1500
    assert sorted({i for own in cells for i in own}) == list(range(len(load)))
    assert max(len(own) for own in cells) == -(-size.max() // 1500)
    assert ann_tree.dealt_cells(tree, sample, 14000, 10**6) == [range(0, 1)] * tree.leaves


def test_search_in_many_cells(monkeypatch, spark):
    """Cells of a few vectors, also parts of a leaf that can't be split, give what one cell gives."""
    rng = np.random.default_rng(10)
    x = [v.tolist() for v in rng.normal(size=(300, 4))] + [[float(i), 0.0, -float(i), 0.0] for i in range(1, 200)]
    rows = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    one, many = [], []
    for size, out in ((1 << 20, one), (700, many)):
        monkeypatch.setattr(ann_tree, "CELL_BYTES", size)
        out += sorted(map(tuple, ann_tree.search(rows.where("vec_id % 20 = 0"), rows, k=5).collect()))
    assert len(one) == 25 * 5 and one == many


@pytest.mark.parametrize("kind", ["f4", "f8"])
def test_best_of_a_cell(monkeypatch, kind):
    monkeypatch.setattr(ann_tree, "BLOCK", 16)
    monkeypatch.setattr(ann_tree, "PAIR_BYTES", 400)
    rng = np.random.default_rng(11)
    x = rng.normal(size=(150, 5)).astype(kind)
    x[50:90] = x[50]  # more equal scores than are kept
    x[90:110] = x[50] * 2

    def block(numbers):
        raw = x[numbers]
        return ann_tree.Block(np.asarray(numbers), raw, ann_tree.unit(raw.astype(float)).astype(np.float32))

    order = rng.permutation(150)
    stocks = {0: [block(order[:3])], 1: [block(order[3:60]), block(order[60:100])], 2: [block(order[100:])]}
    visited = rng.random((40, 3)) < 0.7
    visited[0] = False
    best = ann_tree.best_of(block(np.arange(30, 70)), visited, {leaf: list(p) for leaf, p in stocks.items()}, 6)
    for i, q in enumerate(range(30, 70)):
        there = [c for leaf in range(3) if visited[i, leaf] for p in stocks[leaf] for c in p.number.tolist()]
        score = ann_tree.cosine(np.repeat(x[q : q + 1], len(there), axis=0).astype(float), x[there].astype(float))
        want = sorted(zip((-score).tolist(), there))[:6]
        got = [(-s, c) for s, c in zip(best.score[i].tolist(), best.number[i].tolist()) if s > -np.inf]
        assert got == want
