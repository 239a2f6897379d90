"""Boosting on binned rows against plain versions; principal components of many blocks against one at a time."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import boosting as BO
from cohortlens.operators import features as FE
from cohortlens.operators import models as MO


def sample(n=600, seed=3):
    rnd, rows = random.Random(seed), []
    for i in range(n):
        a, b, c = rnd.random(), rnd.random(), rnd.choice("xyzw")
        y = int(a + 0.5 * b + (0.4 if c == "x" else 0) + rnd.gauss(0, 0.2) > 1.0)
        miss = rnd.random() < (0.4 if y else 0.1)                    # missing tells of the label
        rows.append((i, "train" if i < n * 2 // 3 else "validation", y, None if miss else a, b, c if rnd.random() < 0.9 else None))
    return rows


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(sample(), "rid long, split string, label int, a double, b double, c string").checkpoint()


@pytest.fixture(scope="module")
def binned(spark, table):
    bins = BO.find_bins(table.filter("split = 'train'"), ["a", "b"], ["c"], max_bins=16)
    return bins, BO.binned(table, bins, ["rid", "split", "label"]).checkpoint()


def plain_best(grid, g, h, bins, params):
    """The best gain of any split of these rows: every threshold, every set of levels, both sides for missing."""
    def score(m):
        return g[m].sum() ** 2 / (h[m].sum() + params.reg_lambda) if m.any() and h[m].sum() + params.reg_lambda > 0 else 0.0
    best, whole = 0.0, np.ones(len(grid), bool)
    for c, b in enumerate(bins):
        x = grid[:, c]
        sets = [set(range(1, t + 1)) for t in range(1, b.count + 1)] if b.levels is None else \
            [{v + 1 for v in range(b.count) if mask >> v & 1} for mask in range(1, 1 << b.count)]
        for s in sets:
            for missing in (True, False):
                left = np.isin(x, list(s | ({0} if missing else set())))
                if min(left.sum(), (~left).sum()) >= max(params.min_rows, 1) \
                        and min(h[left].sum(), h[~left].sum()) >= params.min_hessian:
                    best = max(best, score(left) + score(~left) - score(whole))
    return best


@pytest.mark.parametrize("params", [BO.BoostParams(1, 0.1, 4), BO.BoostParams(1, 0.1, 3, reg_lambda=1.0, min_rows=15)])
def test_every_split_is_the_best_one(spark, binned, params):
    bins, tab = binned
    model = BO.fit_boosted(tab.filter("split = 'train'"), bins, [BO.Job(params, [0, 1, 2], 1)], ["rid"])[0]
    rows = tab.filter("split = 'train'").collect()
    grid = np.frombuffer(b"".join(r["__bins"] for r in rows), np.uint8).reshape(-1, 3)
    y = np.array([r.label for r in rows])
    p = np.full(len(y), y.mean())
    g, h = p - y, p * (1 - p)
    tree = model.trees[0]

    def check(i, here, depth):
        n = tree[i]
        assert n.cover == pytest.approx(h[here].sum()) and n.value == pytest.approx(
            -params.rate * g[here].sum() / (h[here].sum() + params.reg_lambda))
        best = plain_best(grid[here], g[here], h[here], bins, params) if depth < params.max_depth else 0.0
        assert n.gain == pytest.approx(best, abs=1e-9)
        if n.feature >= 0:
            left = np.frombuffer(n.left_bins, np.bool_)[grid[:, n.feature]]
            check(n.left, here & left, depth + 1)
            check(n.right, here & ~left, depth + 1)
    check(0, np.ones(len(y), bool), 0)
    assert any(n.feature >= 0 for n in tree)


def test_leaf_cap_takes_the_best_splits_first(spark, binned):
    bins, tab = binned
    train = tab.filter("split = 'train'")
    full, capped = BO.fit_boosted(train, bins, [BO.Job(BO.BoostParams(1, 0.1, 5), [0, 1, 2], 1),
                                                BO.Job(BO.BoostParams(1, 0.1, 5, max_leaves=6), [0, 1, 2], 1)], ["rid"])
    leaves = [n for n in capped.trees[0] if n.feature < 0]
    assert len(leaves) == 6 < sum(n.feature < 0 for n in full.trees[0])
    # Node by node: of the open nodes the one with the largest gain is split next.
    tree, heap, took = full.trees[0], [0], []
    while len(took) < 5:
        i = max((k for k in heap if tree[k].feature >= 0), key=lambda k: tree[k].gain)
        heap.remove(i)
        heap += [tree[i].left, tree[i].right]
        took.append(round(tree[i].gain, 9))
    assert sorted(took) == sorted(round(n.gain, 9) for n in capped.trees[0] if n.feature >= 0)


def test_many_models_in_one_pass_equal_each_alone(spark, binned, monkeypatch):
    bins, tab = binned
    monkeypatch.setattr(BO, "REWRITE", 2)                          # margins are written on the way
    train = tab.filter("split = 'train'")
    jobs = [BO.Job(BO.BoostParams(5, 0.3, 3, row_share=0.5, col_share=0.5), [0, 1, 2], 7),
            BO.Job(BO.BoostParams(3, 0.3, 2, max_leaves=3), [1, 2], 8)]
    both = BO.fit_boosted(train, bins, jobs, ["rid"])
    monkeypatch.setattr(BO, "TASK_ROWS", 100)                      # several tasks, whose sums meet
    alone = [BO.fit_boosted(train.repartition(7), bins, [j], ["rid"])[0] for j in jobs]     # other partitions, too
    for m, n in zip(both, alone):
        assert len(m.trees) == m.params.rounds
        for s, t in zip(m.trees, n.trees):
            assert [(x.feature, x.left_bins, x.left) for x in s] == [(x.feature, x.left_bins, x.left) for x in t]
            assert [x.value for x in s] == pytest.approx([x.value for x in t])
    assert {n.feature for t in both[1].trees for n in t} <= {-1, 1, 2}


def test_missing_values_have_a_direction_and_a_score(spark, table):
    fm = MO.fit_model("LGBM", table, ["a", "b"], ["c"], ["rid"], grid=[{"maxIter": 8, "stepSize": 0.3}])
    nodes = MO.tree_table(fm).collect()
    inner = [n for n in nodes if n.feature is not None]
    assert inner and all(n.missing in (n.yes, n.no) for n in inner)
    assert all((n.threshold is None) != (n.categories is None) for n in inner)
    assert all(sum(n.leaf is not None for n in nodes if n.tree_id == t) <= 10 for t in range(8))
    root = [n for n in inner if n.feature == "a"]
    assert root                                                     # its gaps tell of the label
    nulls = spark.createDataFrame([(1, "test", 1, None, None, None)], table.schema)
    assert 0 < fm.score(nulls, ["rid"]).first().prob < 1
    assert sum(MO.importance(fm, table)[k][0] for k in ("a", "b", "c")) == pytest.approx(1)


def test_auc_is_near_sparks_own_trees(spark, table):
    filled = table.fillna({"a": -1.0, "c": "none"})
    own = MO.fit_model("LGBM", filled, ["a", "b"], ["c"], ["rid"], grid=[{"maxIter": 10, "stepSize": 0.2}])
    spark_own = MO.fit_model("GBT_B", filled, ["a", "b"], ["c"], ["rid"], grid=[{"maxIter": 10, "stepSize": 0.2}])
    assert own.grid_log[0]["AUC"] > spark_own.grid_log[0]["AUC"] - 0.03


def test_one_class_raises(spark, binned):
    bins, tab = binned
    with pytest.raises(ValueError, match="both classes"):
        BO.fit_boosted(tab.filter("label = 1"), bins, [BO.Job(BO.BoostParams(1), [0], 1)], ["rid"])


def test_too_many_levels_raise(spark):
    with pytest.raises(ValueError, match="levels"):
        BO.find_bins(spark.range(300).select(F.col("id").cast("string").alias("c")), [], ["c"])


def test_network_keeps_the_round_of_least_validation_loss(spark, table):
    rows = table.fillna({"a": 0.0, "c": "none"})
    fm = MO.fit_model("ANN", rows, ["a", "b"], ["c"], ["rid"], grid=[{"maxIter": 40}, {"maxIter": 5}])
    assert all(e["iterations"] <= e["maxIter"] for e in fm.grid_log)
    assert fm.params["iterations"] == max(fm.grid_log, key=lambda e: e["AUC"])["iterations"]


def test_blocks_of_one_matrix_equal_single_blocks(spark):
    rnd, rows = random.Random(2), []
    for i in range(200):
        a, b = rnd.gauss(5, 2), rnd.gauss(0, 1e-3)
        rows.append((i, a, a * 2 + rnd.gauss(0, 0.1), b, rnd.random() * 1e4, 7.0))
    df = spark.createDataFrame(rows, "rid long, p double, q double, r double, s double, flat double")
    blocks = {"one": ["p", "q", "r"], "two": ["r", "s", "flat"], "all": ["p", "q", "r", "s", "flat"], "none": ["flat"]}
    many = FE.PCABlocks(blocks).fit(df)
    got = {r.rid: r for r in many.transform(df).collect()}
    for name in ("one", "two", "all"):
        single = FE.PCABlock(blocks[name], name).fit(df)
        assert single.output_columns() == many.output_columns(name)
        for r in single.transform(df).collect():
            for c in single.output_columns():
                assert got[r.rid][c] == pytest.approx(r[c], abs=1e-9)
    with pytest.raises(ValueError, match="gaps"):
        FE.PCABlocks({"x": ["p"]}).fit(df.union(spark.createDataFrame([(9, None, 1.0, 1.0, 1.0, 1.0)], df.schema)))
    assert math.isfinite(got[0]["all_pca_1"])


def test_tasks_grow_with_models():
    """Many models on few rows are spread over tasks; one model on few rows stays in one."""
    assert BO.task_count(40_000, 1) == 1
    assert BO.task_count(40_000, 30) > 5
    assert BO.task_count(100, 30) == 1


def test_binned_places_values_in_the_jvm_as_the_edges_say(spark):
    """Numbers by upper edge, levels by text, null, NaN and unseen as missing."""
    rows = spark.createDataFrame([(1, 2.0, "b"), (2, 2.5, "a"), (3, None, None), (4, float("nan"), "z"), (5, 9.0, "b")],
                                 "id int, x double, c string")
    bins = [BO.Bins("x", edges=[2.0, 3.0]), BO.Bins("c", levels=["a", "b"]), BO.Bins("c", levels=[])]
    found = {r["id"]: list(r["__bins"]) for r in BO.binned(rows, bins, ["id"]).collect()}
    assert found == {1: [1, 2, 0], 2: [2, 1, 0], 3: [0, 0, 0], 4: [0, 0, 0], 5: [3, 2, 0]}
