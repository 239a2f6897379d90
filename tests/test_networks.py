"""Networks trained together against Spark's own, one at a time."""

import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cohortlens.operators import metrics as ME
from cohortlens.operators import models as MO
from cohortlens.operators import networks as NE
from cohortlens.plans import experiment as EX


@pytest.fixture(scope="module")
def rows(spark):
    rnd, out = random.Random(5), []
    for i in range(901):                         # partitions end within a block
        x = [rnd.gauss(0, 1) for _ in range(5)]
        y = int(x[0] + 0.5 * x[1] * x[2] + rnd.gauss(0, 0.4) > 0.8)
        out.append(("train" if rnd.random() < 0.7 else "validation" if rnd.random() < 0.9 else "test", y, Vectors.dense(x)))
    return spark.createDataFrame(out, ["split", "label", "__scaled"]).repartition(3).checkpoint()


@pytest.mark.parametrize("added_up_by_tasks", [False, True])
def test_networks_together_equal_sparks_own(spark, rows, monkeypatch, added_up_by_tasks):
    """Some columns each, other sizes and steps; in one task and in many."""
    monkeypatch.setattr(NE, "task_count", lambda n, models: 3 if added_up_by_tasks else 1)
    monkeypatch.setattr(NE, "SUMS_BYTES", 1 if added_up_by_tasks else NE.SUMS_BYTES)
    monkeypatch.setattr(NE, "CHUNK", 100)
    wide = rows.select("split", "label", vector_to_array("__scaled").alias("v"))
    cases = [("ANN", {"maxIter": 12}, [0, 1, 2, 3, 4]), ("RNN", {"maxIter": 10}, [3, 1])]
    estimators = [MO.get_preset(m).build(p, 123, 0, len(c)) for m, p, c in cases]
    jobs = [NE.NetworkJob(c, e.getLayers(), MO.network_of(spark, e).weights.toArray(), e.getMaxIter(), 3, 5, e.getTol())
            for (_, _, c), e in zip(cases, estimators)]
    found = NE.fit_networks(NE.packed(wide, F.col("v"), [0.0] * 5, [1.0] * 5, 32), 5, jobs)
    for (_, _, columns), e, (weights, steps) in zip(cases, estimators, found):
        own = rows.rdd.map(lambda r, c=columns: (r.split, r.label, Vectors.dense([r["__scaled"][i] for i in c]))) \
            .toDF(["split", "label", "__scaled"])
        model, rounds = MO.fit_network(e, own.filter("split = 'train'"), own.filter("split = 'validation'"), 3)
        assert rounds == steps
        assert weights == pytest.approx(model.weights.toArray(), abs=1e-7)
        assert MO.network_of(spark, e, weights).weights.toArray().tolist() == weights.tolist()


def test_inputs_of_networks_are_scaled_and_finite(spark):
    df = spark.createDataFrame([("train", 1, [3.0, 5.0]), ("test", 0, [0.0, 0.0]), ("validation", 0, [1.0, float("nan")])],
                               "split string, label int, v array<double>").coalesce(1)
    got = {(r.label, r.weight): np.frombuffer(bytes(r.x)).tolist() for r in NE.packed(df, F.col("v"), [1.0, 1.0], [0.5, 0.0], 4).collect()}
    assert got[1, 1.0] == [1.0, 0.0] and got[0, 0.0][0] == 0.0 and len(got) == 2
    bad = df.withColumn("split", F.lit("train"))
    with pytest.raises(Exception, match="finite"):
        NE.packed(bad, F.col("v"), [0.0, 0.0], [1.0, 1.0], 4).collect()


def test_sweep_trains_its_networks_together(spark, monkeypatch):
    """One training for all combinations, as each alone; its one grid entry has the AUC that the sweep reports."""
    rnd, out = random.Random(1), []
    for rid in range(100):
        for visit in range(1, 4):
            a, b = rnd.random(), rnd.random()
            out.append((rid, visit, int(a + rnd.gauss(0, 0.3) > 0.7), a, a - 0.5, b, b * 2, float(rnd.randint(0, 1))))
    df = spark.createDataFrame(out, "rid long, visit int, label int, x double, x_diff double, z double, z_diff double, as1_sex double")
    cfg = EX.ExperimentConfig(
        feature_sets=("all", "xonly"), pca_modes=("none",), models=("RNN",), blocks={"xb": ("x", "x_diff"), "zb": ("z", "z_diff")},
        set_drops={"all": (), "xonly": ("zb",)}, set_pca_blocks={"all": ("xb", "zb"), "xonly": ("xb",)}, categorical=("as1_sex",))
    alone, _ = EX.combo_predictions(EX.prepare_combo(df, "xonly", "none", cfg), cfg)
    auc = {r.split: r.auc for r in ME.roc_auc(alone, keys=["split"]).collect()}
    trained, logs, fit, single = [], [], MO.fit_network_models, MO.fit_network

    def seen(spark, packed, width, requests, n_train):
        trained.append([r.key for r in requests])
        logs.append(fit(spark, packed, width, requests, n_train))
        return logs[-1]

    monkeypatch.setattr(MO, "fit_network_models", seen)
    monkeypatch.setattr(MO, "fit_network", lambda *a: pytest.fail("a network was fitted alone"))
    got = {r.feature_set: r for r in EX.run_experiment(spark, df, cfg).collect()}
    assert trained == [[(("all", "none"), "RNN"), (("xonly", "none"), "RNN")]] and single is not MO.fit_network
    assert (got["xonly"].auc_validation, got["xonly"].auc_test) == (pytest.approx(auc["validation"]), pytest.approx(auc["test"]))
    for ((fs, _), _), fm in logs[0].items():
        assert [e["AUC"] for e in fm.grid_log] == [got[fs].auc_validation]
