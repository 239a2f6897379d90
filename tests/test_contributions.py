"""Tree contributions: local accuracy and agreement with brute-force Shapley."""

import math
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import contributions as CO
from cohortlens.operators import models as MO


@pytest.fixture(scope="module")
def fitted(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(400):
        a, b, c = rnd.random(), rnd.random(), rnd.choice(["x", "y", "z"])
        y = int(a + 0.5 * b + (0.4 if c == "x" else 0) + rnd.gauss(0, 0.2) > 1.0)
        rows.append((i, "train" if i < 300 else "validation", y, a, b, c))
    df = spark.createDataFrame(rows, "rid long, split string, label int, a double, b double, c string")
    fm = MO.fit_model("GBT_A", df, ["a", "b"], ["c"], ["rid"])
    return fm, df


def _margins(fm, df):
    n = fm.n_trees or len(fm.model.trees)
    m = MO.prefix_margins(fm.model, fm.prep.transform(df), n)
    return {r.rid: r.m for r in m.select("rid", F.element_at("__margins", -1).alias("m")).collect()}


def test_local_accuracy(spark, fitted):
    fm, df = fitted
    _, bias = CO.model_leaves(fm)
    contrib = CO.contributions(fm, df, ["rid"])
    sums = {r.rid: r.s for r in contrib.groupBy("rid").agg(F.sum("contribution").alias("s")).collect()}
    margins = _margins(fm, df)
    for rid, m in margins.items():
        assert sums.get(rid, 0.0) + bias == pytest.approx(m, abs=1e-9)


def _brute(fm, x_row):
    """Shapley values of v(S) = cover-weighted expected margin with S fixed, by enumeration."""
    rows = CO.node_rows(fm)
    weights = fm.model.treeWeights
    limit = fm.n_trees or len(weights)
    trees = {}
    for r in rows:
        trees.setdefault(r.tree, {})[r.id] = r
    feats = sorted({r.fi for r in rows if r.left >= 0})

    def value(S):
        total = 0.0
        for t, nodes in trees.items():
            if t >= limit:
                continue

            def go(i):
                n = nodes[i]
                if n.left < 0:
                    return n.value
                if n.fi in S:
                    x = x_row[n.fi]
                    left = x <= n.lct[0] if n.ncat < 0 else x in n.lct
                    return go(n.left if left else n.right)
                return (nodes[n.left].cover * go(n.left) + nodes[n.right].cover * go(n.right)) / n.cover
            total += weights[t] * go(0)
        return total

    m = len(feats)
    out = {}
    for f in feats:
        others = [g for g in feats if g != f]
        tot = 0.0
        for s in range(m):
            for S in combinations(others, s):
                w = math.factorial(s) * math.factorial(m - s - 1) / math.factorial(m)
                tot += w * (value(set(S) | {f}) - value(set(S)))
        out[f] = tot
    return out


def test_matches_brute_force(spark, fitted):
    fm, df = fitted
    sample = df.filter("rid in (3, 310)")
    x = {r.rid: r.x for r in fm.prep.transform(sample).select(
        "rid", MO.vector_to_array("features").alias("x")).collect()}
    got = {}
    for r in CO.contributions(fm, sample, ["rid"]).collect():
        got[(r.rid, r.feature)] = r.contribution
    for rid, xr in x.items():
        want = _brute(fm, xr)
        for fi, v in want.items():
            assert got.get((rid, fm.feature_names[fi]), 0.0) == pytest.approx(v, abs=1e-9)


def test_summary_has_every_row_and_feature(spark, fitted):
    fm, df = fitted
    contrib = CO.contributions(fm, df, ["rid"])
    assert contrib.count() == df.count() * len(fm.feature_names)
    top = CO.contribution_summary(contrib).orderBy("rank").collect()
    assert [r["rank"] for r in top] == list(range(1, len(fm.feature_names) + 1))
    assert [r.mean_abs for r in top] == sorted((r.mean_abs for r in top), reverse=True)


# --- boosted presets and long paths -------------------------------------------------

def brute_leaves(leaves, x, passes):
    """Shapley values of the sum of the leaves' games by enumeration."""
    feats = sorted({f for leaf in leaves for f in leaf.features})

    def value(S):
        total = 0.0
        for leaf in leaves:
            v = leaf.value
            for f, tests, r in zip(leaf.features, leaf.tests, leaf.ratios):
                v *= float(all(passes(x[f], t) for t in tests)) if f in S else r
            total += v
        return total
    out = {}
    for f in feats:
        others = [g for g in feats if g != f]
        out[f] = sum(math.factorial(s) * math.factorial(len(feats) - s - 1) / math.factorial(len(feats))
                     * (value(set(S) | {f}) - value(set(S))) for s in range(len(feats)) for S in combinations(others, s))
    return out


def test_paths_of_14_features_equal_brute_force():
    rnd = random.Random(7)
    leaves = []
    for _ in range(3):
        steps = [(f, (True, rnd.random(), None, rnd.random() < 0.5), rnd.choice([0.0, 1.0, rnd.random()])) for f in range(14)]
        steps += [(rnd.randrange(14), (True, rnd.random(), None, True), rnd.random()) for _ in range(3)]
        leaves.append(CO.Leaf.of(rnd.gauss(0, 1), steps))
    assert all(len(leaf.features) == 14 for leaf in leaves)
    x = [rnd.random() for _ in range(14)]
    got = [0.0] * 14
    import numpy as np
    for leaf in leaves:
        met = np.array([[all(CO._passes(np.array(x[f]), t) for t in tests) for f, tests in zip(leaf.features, leaf.tests)]])
        for f, v in zip(leaf.features, CO.leaf_values(met, leaf.ratios, leaf.value)[0]):
            got[f] += v
    for f, v in brute_leaves(leaves, x, lambda v, t: bool(CO._passes(np.array(v), t))).items():
        assert got[f] == pytest.approx(v, abs=1e-9)


def test_boosted_presets_local_accuracy_and_brute_force(spark, fitted):
    import numpy as np
    _, df = fitted
    df = df.withColumn("a", F.when(F.col("rid") % 7 != 0, F.col("a")))            # missing values
    fm = MO.fit_model("LGBM", df, ["a", "b"], ["c"], ["rid"], grid=[{"maxIter": 6, "stepSize": 0.3}])
    leaves, bias = CO.model_leaves(fm)
    sums = {r.rid: r.contributions for r in CO.row_contributions(fm, df, ["rid"]).collect()}
    probs = {r.rid: r.prob for r in fm.score(df, ["rid"]).collect()}
    assert len(sums) == len(probs) == 400
    for rid, p in probs.items():
        assert sum(sums[rid]) + bias == pytest.approx(math.log(p / (1 - p)), abs=1e-9)
    from cohortlens.operators import boosting as BO
    for r in BO.binned(df.filter("rid in (3, 7, 310)"), fm.model.bins, ["rid"]).collect():
        x = np.frombuffer(r["__bins"], np.uint8)
        for f, v in brute_leaves(leaves, x, lambda v, t: bool(t[v])).items():
            assert sums[r.rid][f] == pytest.approx(v, abs=1e-9)
