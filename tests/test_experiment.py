"""Experiment sweep on a small hand-made interval table."""

import json
import random

import pytest

from cohortlens import presets as P
from cohortlens.operators import models as MO
from cohortlens.plans import catalog
from cohortlens.plans import experiment as EX


def test_grid_keys_must_be_known():
    for name in MO.REGISTRY:
        with pytest.raises(KeyError):
            MO.get_preset(name).build({"columns": 0.5}, 1, 10, 3)


def test_registered_sweep_is_whole(monkeypatch):
    seen = []
    monkeypatch.setattr(catalog, "training_rows", lambda spark, sf: None)
    monkeypatch.setattr(EX, "run_experiment", lambda spark, df, cfg: seen.append(cfg))
    catalog.MODEL_QUERIES["experiment"](None, "")
    assert (seen[0].feature_sets, seen[0].pca_modes, seen[0].models) == (P.FEATURE_SETS, P.PCA_MODES, P.MODEL_NAMES)
    assert seen[0].ensemble and set(P.FEATURE_SETS) <= set(seen[0].set_drops) & set(seen[0].set_pca_blocks)
    assert all(seen[0].blocks[b] for drops in seen[0].set_drops.values() for b in drops)
    assert {c for b in seen[0].blocks.values() for c in b} == {c for b in catalog.EVENT_BLOCKS.values() for c in b}


def test_sweep_metrics_and_json(spark, tmp_path):
    rnd = random.Random(1)
    rows = []
    for rid in range(120):
        for visit in range(1, 4):
            a, b = rnd.random(), rnd.random()
            y = int(a + rnd.gauss(0, 0.3) > 0.8)
            rows.append((rid, visit, y, a, a - 0.5, b, b * 2, float(rnd.randint(0, 1))))
    df = spark.createDataFrame(rows, "rid long, visit int, label int, x double, x_diff double, "
                                     "z double, z_diff double, as1_sex double")
    cfg = EX.ExperimentConfig(
        feature_sets=("all", "xonly"), pca_modes=("plus",), models=("LR", "XGB"),
        blocks={"xb": ("x", "x_diff"), "zb": ("z", "z_diff")},
        set_drops={"all": (), "xonly": ("zb",)},
        set_pca_blocks={"all": ("xb", "zb"), "xonly": ("xb",)},
        categorical=("as1_sex",), sampling="over",
        targets={"train": 500, "validation": 150, "test": 150}, output=str(tmp_path / "sweep"))
    metrics = EX.run_experiment(spark, df, cfg)
    got = metrics.collect()
    assert len(got) == 2 * 3
    assert {r.model for r in got} == {"LR", "XGB", "Ensemble"}
    for r in got:
        assert 0.0 <= r.auc_test <= 1.0 and 0.0 <= r.auc_validation <= 1.0
        assert 0.01 <= r.cutoff <= 0.99
    lr = [r for r in got if r.model == "LR"][0]
    assert all(len(v) == 2 for v in lr.importance.values())        # coefficient + p-value
    nested = json.loads(EX.metrics_json(metrics).first().json)
    assert set(nested) == {"all", "xonly"} and set(nested["all"]) == {"plus"}
    assert EX.best_row(metrics).first().auc_test == max(r.auc_test for r in got)
    tied = spark.createDataFrame([("b", 0.5, 1), ("a", 0.5, 0), ("c", 0.4, 2)], "model string, auc_test double, position int")
    assert EX.best_row(tied).first().model == "a"
    one = tmp_path / "sweep" / "all" / "plus"
    assert spark.read.parquet(str(one / "XGB" / "grid_log")).count() == 1
    assert spark.read.parquet(str(one / "XGB" / "trees")).count() > 10
    trees = spark.read.parquet(str(one / "XGB" / "trees")).filter("tree_id = 3")         # one folder a tree
    assert "PartitionFilters: [isnotnull(tree_id" in trees._jdf.queryExecution().toString() and trees.count() > 0
    assert {r.model for r in spark.read.parquet(str(one / "roc_points")).select("model").distinct().collect()} \
        == {"LR", "XGB", "Ensemble"}
    rows = EX.prepare_combo(df, "all", "plus", cfg)
    preds, fitted = EX.combo_predictions(rows, cfg)
    keys, test = ["rid", "visit", "copy"], rows.filter("split = 'test'")
    for name in ("LR", "XGB"):
        MO.save_model(fitted[name], str(tmp_path / name))
        again = MO.load_model(spark, str(tmp_path / name))
        a = sorted(map(tuple, again.score(test, keys).collect()))
        b = sorted(map(tuple, fitted[name].score(test, keys).collect()))
        assert a == b and again.n_trees == fitted[name].n_trees
    # The sweep's own files hold the model of the one combination fitted alone.
    swept = {tuple(r[:3]): r.prob for r in MO.load_model(spark, str(one / "LR" / "fitted")).score(test, keys).collect()}
    for r in fitted["LR"].score(test, keys).collect():
        assert swept[tuple(r[:3])] == pytest.approx(r.prob, abs=1e-6)
    assert json.loads((spark.read.text(str(tmp_path / "sweep" / "results_json")).first().value))["all"]
    ranked = EX.auc_summary(metrics).collect()
    assert ranked[0].auc_test == max(r.auc_test for r in got)


def test_interval_folders_are_pruned_and_replaced_by_type(spark, tmp_path):
    from cohortlens.operators.features import load_training_data
    from cohortlens.plans.preprocess import write_intervals
    both = spark.createDataFrame([(1, 0, 1.0, "diag"), (2, 1, 2.0, "diag"), (3, 1, 3.0, "drug")],
                                 "rid long, label int, x double, data_type string")
    path = str(tmp_path / "intervals")
    write_intervals(both, path)
    write_intervals(both.filter("rid = 3").withColumn("x", both.x + 1), path)            # the other type stays
    diag, drug = (load_training_data(spark, path, data_type=t) for t in ("diag", "drug"))
    assert sorted(map(tuple, diag.collect())) == [(1, 0, 1.0), (2, 1, 2.0)] and [r.x for r in drug.collect()] == [4.0]
    plan = diag._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(data_type" in plan
