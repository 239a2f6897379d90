"""Metrics against brute-force Python on small fixtures (ties included)."""

import random

import pytest

from cohortlens import presets as P
from cohortlens.operators import metrics as ME


def _fixture(seed=7, n=300, levels=13):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = rnd.random() < 0.35
        p = round(min(1.0, max(0.0, rnd.gauss(0.55 if y else 0.4, 0.2))) * levels) / levels
        rows.append((i, rnd.choice(["validation", "test"]), rnd.choice(["a", "b"]), int(y), p))
    return rows


def _df(spark, rows):
    return spark.createDataFrame(rows, "row_id long, split string, model string, label int, prob double")


def brute_auc(pairs):
    pos = [p for y, p in pairs if y == 1]
    neg = [p for y, p in pairs if y == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def brute_roc(pairs):
    scores = sorted({p for _, p in pairs}, reverse=True)
    tps = [sum(1 for y, p in pairs if y == 1 and p >= s) for s in scores]
    fps = [sum(1 for y, p in pairs if y == 0 and p >= s) for s in scores]
    keep = [0] + [i for i in range(1, len(scores) - 1)
                  if (tps[i + 1] - 2 * tps[i] + tps[i - 1]) or (fps[i + 1] - 2 * fps[i] + fps[i - 1])]
    keep += [len(scores) - 1] if len(scores) > 1 else []
    P_, N_ = tps[-1], fps[-1]
    return [(float("inf"), 0.0, 0.0)] + [(scores[i], fps[i] / N_, tps[i] / P_) for i in keep]


def brute_cutoff(val, test):
    grid = [P.CUTOFF_START + i * P.CUTOFF_STEP for i in range(P.CUTOFF_COUNT)]

    def counts(pairs, c):
        tp = sum(1 for y, p in pairs if y == 1 and p >= c)
        fp = sum(1 for y, p in pairs if y == 0 and p >= c)
        P_ = sum(y for y, _ in pairs)
        return tp, fp, P_ - tp, len(pairs) - P_ - fp

    def f1(tp, fp, fn):
        return 0.0 if 2 * tp + fp + fn == 0 else 2.0 * tp / (2 * tp + fp + fn)

    best, best_c = -1.0, 0.5
    for c in grid:
        v = f1(*counts(val, c)[:3])
        if v > best:
            best, best_c = v, c
    tp, fp, fn, tn = counts(test, best_c)
    prec = 0.0 if tp + fp == 0 else tp / (tp + fp)
    rec = 0.0 if tp + fn == 0 else tp / (tp + fn)
    return best_c, prec, rec, f1(tp, fp, fn), (tp + tn) / len(test)


def _groups(rows):
    g = {}
    for _, split, model, y, p in rows:
        g.setdefault((model, split), []).append((y, p))
    return g


def test_auc_matches_pairwise(spark):
    rows = _fixture()
    got = {(r.model, r.split): r.auc for r in ME.roc_auc(_df(spark, rows)).collect()}
    for k, pairs in _groups(rows).items():
        assert got[k] == pytest.approx(brute_auc(pairs), abs=1e-12)


def test_auc_invariant_under_repartition(spark):
    df = _df(spark, _fixture(3))
    a = sorted(tuple(r) for r in ME.roc_auc(df).collect())
    b = sorted(tuple(r) for r in ME.roc_auc(df.repartition(7, "row_id")).collect())
    assert a == b


def test_auc_single_class_raises(spark):
    df = _df(spark, [(1, "test", "a", 1, 0.3), (2, "test", "a", 1, 0.6)])
    with pytest.raises(Exception, match="both classes"):
        ME.roc_auc(df).collect()


def test_roc_points_match_sklearn_rule(spark):
    rows = _fixture(11)
    got = {}
    for r in ME.roc_points(_df(spark, rows)).collect():
        got.setdefault((r.model, r.split), []).append((r.threshold, r.fpr, r.tpr))
    for k, pairs in _groups(rows).items():
        want = [tuple(round(x, 12) for x in t) for t in brute_roc(pairs)]
        have = [tuple(round(x, 12) for x in t) for t in sorted(got[k], key=lambda t: -t[0])]
        assert have == want


def test_best_cutoff_matches_loop(spark):
    rows = _fixture(5, levels=97)
    got = {r.model: r for r in ME.best_cutoff(_df(spark, rows)).collect()}
    g = _groups(rows)
    for m in ("a", "b"):
        want = brute_cutoff(g[(m, "validation")], g[(m, "test")])
        r = got[m]
        assert (r.cutoff, r.precision, r.recall, r.f1, r.accuracy) == pytest.approx(want)


def test_best_cutoff_all_zero_f1(spark):
    rows = [(1, "validation", "a", 1, 0.001), (2, "validation", "a", 0, 0.5),
            (3, "test", "a", 1, 0.2), (4, "test", "a", 0, 0.0)]
    r = ME.best_cutoff(_df(spark, rows)).first()
    assert r.cutoff == 0.01 and r.validation_f1 == 0.0


def test_grid_position_exact(spark):
    probs = [P.CUTOFF_START + i * P.CUTOFF_STEP for i in range(P.CUTOFF_COUNT)] + [0.0, 0.0099, 1.0, 0.995]
    df = spark.createDataFrame([(p,) for p in probs], "prob double")
    got = [r.k for r in df.select(ME.grid_position(df.prob).alias("k")).collect()]
    grid = [P.CUTOFF_START + i * P.CUTOFF_STEP for i in range(P.CUTOFF_COUNT)]
    assert got == [sum(1 for c in grid if c <= p) for p in probs]


def test_confusion(spark):
    rows = [(1, "test", "a", 1, 0.5), (2, "test", "a", 0, 0.7), (3, "test", "a", 1, 0.1),
            (4, "test", "a", 0, 0.2)]
    r = ME.confusion_at_cutoff(_df(spark, rows), 0.5).first()
    assert (r.tp, r.fp, r.fn, r.tn) == (1, 1, 1, 1)
    assert (r.precision, r.recall, r.f1, r.accuracy) == (0.5, 0.5, 0.5, 0.5)


def test_ensemble_mean_and_missing(spark):
    rows = [(1, "test", "a", 1, 0.2), (1, "test", "b", 1, 0.4), (2, "test", "a", 0, 0.6), (2, "test", "b", 0, 0.8)]
    got = {r.row_id: r.prob for r in ME.ensemble_mean(_df(spark, rows), ["a", "b"]).collect()}
    assert got == pytest.approx({1: 0.3, 2: 0.7})
    with pytest.raises(Exception, match="one prediction"):
        ME.ensemble_mean(_df(spark, rows[:3]), ["a", "b"]).collect()


def test_ensemble_counts_models_not_rows(spark):
    rows = [(1, "test", "a", 1, 0.2), (1, "test", "a", 1, 0.4)]
    with pytest.raises(Exception, match="one prediction"):
        ME.ensemble_mean(_df(spark, rows), ["a", "b"]).collect()


def test_missing_scores_raise(spark):
    for bad in (None, float("nan")):
        df = _df(spark, [(1, "test", "a", 1, 0.3), (2, "test", "a", 0, 0.2), (3, "test", "a", 0, bad)])
        for f in (ME.roc_auc, ME.roc_points, ME.confusion_at_cutoff):
            with pytest.raises(Exception, match="not a number"):
                f(df).collect()
        both = df.unionByName(_df(spark, [(4, "validation", "a", 1, 0.3), (5, "validation", "a", 0, 0.2)]))
        with pytest.raises(Exception, match="not a number"):
            ME.best_cutoff(both).collect()


def test_auc_of_billions(spark):
    cum = spark.createDataFrame([("m", 0.1, 0, 4_000_000_000, 0, 0), ("m", 0.9, 4_000_000_000, 0, 0, 4_000_000_000)],
                                "model string, score double, pos long, neg long, pos_below long, neg_below long")
    assert ME.auc_of(cum, ["model"]).first().auc == 1.0


def test_margins_fill_many_buckets(spark):
    rows = [(i, "test", "a", i % 2, -5.0 + i / 1000) for i in range(2000)]
    keys = ["model", "split"]
    cum = ME.cumulative_below(ME.score_counts(_df(spark, rows), keys), keys)
    assert cum.select("bucket").distinct().count() > 200
    want = brute_auc([(y, p) for _, _, _, y, p in rows[:400]])
    assert ME.roc_auc(_df(spark, rows[:400])).first().auc == pytest.approx(want)


def test_feature_stats(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    r = ME.feature_stats(df, ["x"]).first()
    assert (r.mean, r.var_pop) == (2.5, 1.25)
