"""Registered queries: one per operator, each reading the driver's tables.

Each entry is ``(spark, sf_dir) -> DataFrame``. Queries whose values come
from floating sums or means round their double columns (``ROUND_DIGITS``)
so a check against another engine does not hinge on summation order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import impute as IM
from ..operators.intervals import (build_intervals, build_intervals_long, drop_missing_baseline,
                                   transition_table)
from ..operators.panel import (carry_forward_long, clean_measurements, lowercase_columns, merge_panels, panel_to_long,
                               scale_income_columns)
from ..operators.ranking import seeded_sample
from ..plans.preprocess import prepared_panel, preprocess, write_intervals
from ..session import ensure_checkpoint_dir
from ..sources.standins import EVENT_SPEC, customer_measurements, event_cohort

ROUND_DIGITS = 6
SAMPLE_SEED = 123


def rounded(df: DataFrame, digits: int = ROUND_DIGITS) -> DataFrame:
    return df.withColumns({f.name: F.round(F.col(f.name), digits) for f in df.schema.fields
                           if isinstance(f.dataType, (T.DoubleType, T.FloatType))})


def _event_inputs(spark, sf):
    return event_cohort(spark, sf), customer_measurements(spark, sf)


def _panel(spark, sf):
    coh, meas = _event_inputs(spark, sf)
    return prepared_panel(coh, meas, EVENT_SPEC)


# --- panel preparation ------------------------------------------------------

def q_panel_join(spark: SparkSession, sf: str) -> DataFrame:
    coh, meas = _event_inputs(spark, sf)
    return lowercase_columns(merge_panels(coh, clean_measurements(meas)))


def q_income_scale(spark: SparkSession, sf: str) -> DataFrame:
    coh = scale_income_columns(event_cohort(spark, sf), EVENT_SPEC)
    return rounded(coh.select("RID", *[f"V{k}_INCOME" for k in EVENT_SPEC.visits()]), 9)


def q_clean_missing(spark: SparkSession, sf: str) -> DataFrame:
    return clean_measurements(customer_measurements(spark, sf))


def q_carry_forward(spark: SparkSession, sf: str) -> DataFrame:
    return _panel(spark, sf)


def q_transition_codes(spark: SparkSession, sf: str) -> DataFrame:
    return transition_table(_panel(spark, sf), EVENT_SPEC)


def q_intervals_diag(spark: SparkSession, sf: str) -> DataFrame:
    return build_intervals(_panel(spark, sf), EVENT_SPEC, outcomes=("diag",))


def q_intervals_drug(spark: SparkSession, sf: str) -> DataFrame:
    return build_intervals(_panel(spark, sf), EVENT_SPEC, outcomes=("drug",))


def _raw_intervals(spark, sf):
    rows = build_intervals(_panel(spark, sf), EVENT_SPEC)
    return drop_missing_baseline(rows, EVENT_SPEC)


def q_sentinel_to_null(spark: SparkSession, sf: str) -> DataFrame:
    return IM.sentinel_to_null(_raw_intervals(spark, sf), EVENT_SPEC.threshold)


def _stats(spark, sf, kind):
    clean = IM.sentinel_to_null(_raw_intervals(spark, sf), EVENT_SPEC.threshold)
    return rounded(IM.imputation_stats(clean, EVENT_SPEC.categorical_columns, kind=kind))


def q_impute_mode(spark: SparkSession, sf: str) -> DataFrame:
    return _stats(spark, sf, "mode")


def q_impute_mean(spark: SparkSession, sf: str) -> DataFrame:
    return _stats(spark, sf, "mean")


def q_preprocess_union(spark: SparkSession, sf: str) -> DataFrame:
    coh, meas = _event_inputs(spark, sf)
    return rounded(preprocess(coh, meas, EVENT_SPEC, scale_income=True))


def q_intervals_long(spark: SparkSession, sf: str) -> DataFrame:
    """Interval examples of both outcomes from the long panel: carry-forward and next visit by windows."""
    coh, meas = _event_inputs(spark, sf)
    panel = prepared_panel(coh, meas, EVENT_SPEC)
    people = panel.select(EVENT_SPEC.id_col, *EVENT_SPEC.status_columns, *EVENT_SPEC.base_columns)
    long = carry_forward_long(panel_to_long(panel, EVENT_SPEC), id_col=EVENT_SPEC.id_col)
    return build_intervals_long(long, people, EVENT_SPEC)


def q_training_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Interval rows written by row type and read back for one type: only its folder is read."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/intervals-{uuid.uuid4().hex}"
    write_intervals(q_preprocess_union(spark, sf), path)
    return FE.load_training_data(spark, path, data_type="diag")


def q_seeded_sample(spark: SparkSession, sf: str) -> DataFrame:
    """1,000 rows of the line items by seeded hash (W8's sample)."""
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return seeded_sample(rows, 1000, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], SAMPLE_SEED)


def q_preprocess_raw(spark: SparkSession, sf: str) -> DataFrame:
    coh, meas = _event_inputs(spark, sf)
    return rounded(preprocess(coh, meas, EVENT_SPEC, scale_income=True, impute_missing=False))


PREPROCESS_QUERIES = {
    "panel_join": q_panel_join,
    "income_scale": q_income_scale,
    "clean_missing": q_clean_missing,
    "carry_forward": q_carry_forward,
    "transition_codes": q_transition_codes,
    "intervals_diag": q_intervals_diag,
    "intervals_drug": q_intervals_drug,
    "sentinel_to_null": q_sentinel_to_null,
    "impute_mode": q_impute_mode,
    "impute_mean": q_impute_mean,
    "preprocess_union": q_preprocess_union,
    "preprocess_raw": q_preprocess_raw,
    "intervals_long": q_intervals_long,
    "training_round_trip": q_training_round_trip,
    "seeded_sample": q_seeded_sample,
}




# --- evaluation -----------------------------------------------------------------

from ..operators import metrics as ME  # noqa: E402
from ..sources.predictions import (ROW_KEYS, SCORE_MODELS, long_predictions,  # noqa: E402
                                   wide_predictions)


def q_roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return ME.roc_auc(long_predictions(spark, sf))


def q_roc_points(spark: SparkSession, sf: str) -> DataFrame:
    return ME.roc_points(long_predictions(spark, sf))


def q_confusion_at_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    return ME.confusion_at_cutoff(long_predictions(spark, sf), 0.5)


def q_best_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    return ME.best_cutoff(long_predictions(spark, sf))


def q_ensemble_mean(spark: SparkSession, sf: str) -> DataFrame:
    ens = ME.ensemble_mean(long_predictions(spark, sf), list(SCORE_MODELS), (*ROW_KEYS, "split"))
    return ens.withColumn("prob", F.round("prob", 9))


def q_auc_ranking(spark: SparkSession, sf: str) -> DataFrame:
    """Validation and test AUC for every score and their average, ranked by
    test AUC (the ensemble averages the per-row scores of the same rows)."""
    w = ME.ensemble_mean_wide(wide_predictions(spark, sf), list(SCORE_MODELS), "Ensemble")
    models = list(SCORE_MODELS) + ["Ensemble"]
    long = w.unpivot([*ROW_KEYS, "split", "label"], models, "model", "prob")
    return ME.auc_summary(ME.roc_auc(long))


def q_feature_stats(spark: SparkSession, sf: str) -> DataFrame:
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    return rounded(ME.feature_stats(li, ["l_quantity", "l_discount", "l_tax"]))


METRIC_QUERIES = {
    "roc_auc": q_roc_auc,
    "roc_points": q_roc_points,
    "confusion_at_cutoff": q_confusion_at_cutoff,
    "best_cutoff": q_best_cutoff,
    "ensemble_mean": q_ensemble_mean,
    "auc_ranking": q_auc_ranking,
    "feature_stats": q_feature_stats,
}


# --- splitting ------------------------------------------------------------------

from ..operators import split as SP  # noqa: E402


def order_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Split stand-in: participant = customer, one row per order, label = status F."""
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return o.select(F.col("o_custkey").alias("rid"), "o_orderkey",
                    (F.col("o_orderstatus") == "F").cast("int").alias("label"))


def q_rid_strata(spark: SparkSession, sf: str) -> DataFrame:
    return SP.participant_summary(order_rows(spark, sf))


def q_strata_counts(spark: SparkSession, sf: str) -> DataFrame:
    return SP.strata_counts(SP.participant_summary(order_rows(spark, sf)))


def q_rid_split(spark: SparkSession, sf: str) -> DataFrame:
    return SP.split_participants(SP.participant_summary(order_rows(spark, sf)))


def q_split_sizes(spark: SparkSession, sf: str) -> DataFrame:
    rows = SP.data_split(order_rows(spark, sf))
    return rows.groupBy("split").agg(F.count_distinct("rid").alias("n_rids"))


def q_oversample(spark: SparkSession, sf: str) -> DataFrame:
    return SP.data_split(order_rows(spark, sf), "over", row_keys=["o_orderkey"])


def q_oversample_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return q_oversample(spark, sf).groupBy("split", "label").agg(F.count(F.lit(1)).alias("n_rows"))


SPLIT_QUERIES = {
    "rid_strata": q_rid_strata,
    "strata_counts": q_strata_counts,
    "rid_split": q_rid_split,
    "split_sizes": q_split_sizes,
    "oversample": q_oversample,
    "oversample_sizes": q_oversample_sizes,
}


# --- features and models --------------------------------------------------------

from ..operators import contributions as CO  # noqa: E402
from ..operators import features as FE  # noqa: E402
from ..operators import models as MO  # noqa: E402
from ..plans import experiment as EX  # noqa: E402
from ..presets import FEATURE_SET_DROPS, FEATURE_SET_PCA_BLOCKS  # noqa: E402
from ..sources.standins import EVENT_BLOCKS, EVENT_SET_DROPS, EVENT_SET_PCA, EVENT_STUDY_BLOCKS  # noqa: E402

CATEGORICAL = EVENT_SPEC.categorical_columns


def training_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Diagnosis rows of the imputed event intervals (the study's default input)."""
    coh, meas = _event_inputs(spark, sf)
    return FE.training_table(preprocess(coh, meas, EVENT_SPEC, scale_income=True), "diag")


def experiment_config(**kw) -> EX.ExperimentConfig:
    base = dict(blocks=EVENT_BLOCKS, set_drops=EVENT_SET_DROPS, set_pca_blocks=EVENT_SET_PCA,
                categorical=CATEGORICAL, row_keys=("rid", "visit"))
    base.update(kw)
    return EX.ExperimentConfig(**base)


def q_nominal_strings(spark: SparkSession, sf: str) -> DataFrame:
    coh, meas = _event_inputs(spark, sf)
    pre = preprocess(coh, meas, EVENT_SPEC, scale_income=True)
    return FE.nominal_strings(pre, CATEGORICAL).select("rid", "visit", "data_type", *CATEGORICAL)


def q_one_hot(spark: SparkSession, sf: str) -> DataFrame:
    coh, meas = _event_inputs(spark, sf)
    pre = FE.nominal_strings(preprocess(coh, meas, EVENT_SPEC, scale_income=True), CATEGORICAL)
    out = FE.one_hot_positions(pre, CATEGORICAL)
    return out.select("rid", "visit", "data_type", *[f"{c}_hot" for c in CATEGORICAL])


def q_one_hot_slots(spark: SparkSession, sf: str) -> DataFrame:
    coh, meas = _event_inputs(spark, sf)
    pre = FE.nominal_strings(preprocess(coh, meas, EVENT_SPEC, scale_income=True), CATEGORICAL)
    return FE.one_hot_slots(pre, CATEGORICAL)


def q_pca_block(spark: SparkSession, sf: str) -> DataFrame:
    rows = training_rows(spark, sf)
    out = FE.pca_features(rows, "only", "all", EVENT_BLOCKS, EVENT_SET_PCA)
    return out.select("rid", "visit", *[c for c in out.columns if "_pca_" in c])


def q_block_correlations(spark: SparkSession, sf: str) -> DataFrame:
    """The matrix that all PCA blocks of the sweep come from: (first, second, correlation) of the block columns."""
    rows = FE.training_table(q_preprocess_union(spark, sf), "diag")
    blocks = FE.PCABlocks({n: FE.existing(rows, c) for n, c in EVENT_BLOCKS.items()}).fit(rows)
    cells = [(a, b, round(float(blocks.matrix[i, j]), ROUND_DIGITS)) for i, a in enumerate(blocks.columns)
             for j, b in enumerate(blocks.columns) if i < j]
    return spark.createDataFrame(cells, "first string, second string, correlation double")


def _prepared(spark, sf, sampling=None):
    cfg = experiment_config(sampling=sampling)
    rows = training_rows(spark, sf).checkpoint(eager=True)
    return EX.prepare_combo(rows, "all", "none", cfg), cfg


def _fit_query(name):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        rows, cfg = _prepared(spark, sf)
        cfg.models = (name,)
        preds, _ = EX.combo_predictions(rows, cfg)
        return preds
    q.__name__ = f"q_fit_{name.lower()}"
    q.__doc__ = f"Fit the {name} preset on train, tune on validation, score validation and test."
    return q


# The presets' shipped values, and beside each the alternative its grid names.
TWO_ENTRY_GRIDS = {
    "LR": [{"C": 1.0, "penalty": "l1"}, {"C": 0.1, "penalty": "l1"}],
    "RF": [{"numTrees": 50, "maxDepth": 5}, {"numTrees": 50, "maxDepth": 8}],
    "XGB": [{"maxIter": 10, "maxDepth": 5, "stepSize": r} for r in (0.01, 0.1)],
    "LGBM": [{"maxIter": 50, "maxDepth": 5, "stepSize": r} for r in (0.01, 0.1)],
    "ANN": [{"maxIter": 50}, {"maxIter": 20}],
    "RNN": [{"maxIter": 30}, {"maxIter": 15}],
}


def q_grid_search(spark: SparkSession, sf: str) -> DataFrame:
    """Validation-set grid search (M7) of all six presets, two entries each; log, best AUC first.

    The boosted presets are fitted in one pass a level; the others share one table and run as concurrent jobs."""
    rows, cfg = _prepared(spark, sf)
    keys = [*cfg.row_keys, "copy"]
    cat = FE.existing(rows, CATEGORICAL)
    num = [c for c in FE.feature_columns(rows, FE.ID_LIKE + tuple(keys)) if c not in cat]
    boosted = [MO.BoostRequest(n, n, num, cat, TWO_ENTRY_GRIDS[n], cfg.seed) for n in ("XGB", "LGBM")]
    fitted = MO.fit_boosted_models(rows, boosted, keys)[0]
    for name in ("LR", "RF", "ANN", "RNN"):
        fitted[name] = MO.fit_model(name, rows, num, cat, keys, cfg.seed, TWO_ENTRY_GRIDS[name])
    logs = [MO.grid_log_frame(spark, fm) for fm in fitted.values()]
    out = logs[0]
    for log in logs[1:]:
        out = out.unionByName(log)
    return out.orderBy(F.desc("auc"), "model", "params")


def q_coef_table(spark: SparkSession, sf: str) -> DataFrame:
    rows, cfg = _prepared(spark, sf)
    cat = FE.existing(rows, CATEGORICAL)
    keys = ["rid", "visit", "copy"]
    num = [c for c in FE.feature_columns(rows, FE.ID_LIKE + tuple(keys)) if c not in cat]
    fm = MO.fit_model("LR", rows, num, cat, keys)
    table = MO.coefficient_table(fm, rows)
    data = [(k, v[0], v[1]) for k, v in table.items()]
    return spark.createDataFrame(data, "feature string, coef double, p_value double")


def _boosted(spark, sf, name="XGB", grid=None):
    rows, cfg = _prepared(spark, sf)
    cat = FE.existing(rows, CATEGORICAL)
    keys = ["rid", "visit", "copy"]
    num = [c for c in FE.feature_columns(rows, FE.ID_LIKE + tuple(keys)) if c not in cat]
    return MO.fit_model(name, rows, num, cat, keys, grid=grid)


def q_tree_table(spark: SparkSession, sf: str) -> DataFrame:
    return MO.tree_table(_boosted(spark, sf))


def q_split_importance(spark: SparkSession, sf: str) -> DataFrame:
    return MO.split_importance(MO.tree_table(_boosted(spark, sf)))


def _test_contributions(spark, sf, name="XGB"):
    rows, cfg = _prepared(spark, sf)
    fm = _fit_on(rows, name)
    keys = ["rid", "visit", "copy"]
    return CO.contributions(fm, rows.filter(F.col("split") == "test"), keys)


def _fit_on(rows, name, grid=None):
    cat = FE.existing(rows, CATEGORICAL)
    keys = ["rid", "visit", "copy"]
    num = [c for c in FE.feature_columns(rows, FE.ID_LIKE + tuple(keys)) if c not in cat]
    return MO.fit_model(name, rows, num, cat, keys, grid=grid)


def q_contributions(spark: SparkSession, sf: str) -> DataFrame:
    """Per-feature contributions (class-1 margin) of the boosted preset A for all test rows."""
    return _test_contributions(spark, sf)


def q_contributions_b(spark: SparkSession, sf: str) -> DataFrame:
    """The same of the boosted preset B."""
    return _test_contributions(spark, sf, "LGBM")


def q_contribution_summary(spark: SparkSession, sf: str) -> DataFrame:
    return CO.contribution_summary(_test_contributions(spark, sf))


def q_experiment(spark: SparkSession, sf: str) -> DataFrame:
    """The whole sweep: the study's feature sets, every PCA mode and model, and the ensemble over all models."""
    cfg = experiment_config(blocks=EVENT_STUDY_BLOCKS, set_drops=FEATURE_SET_DROPS,
                            set_pca_blocks=FEATURE_SET_PCA_BLOCKS)
    return EX.run_experiment(spark, training_rows(spark, sf), cfg)


MODEL_QUERIES = {
    "nominal_strings": q_nominal_strings,
    "one_hot": q_one_hot,
    "one_hot_slots": q_one_hot_slots,
    "pca_block": q_pca_block,
    "block_correlations": q_block_correlations,
    **{f"fit_{m.lower()}": _fit_query(m) for m in ("LR", "RF", "XGB", "LGBM", "ANN", "RNN")},
    "grid_search": q_grid_search,
    "coef_table": q_coef_table,
    "tree_table": q_tree_table,
    "split_importance": q_split_importance,
    "contributions": q_contributions,
    "contributions_b": q_contributions_b,
    "contribution_summary": q_contribution_summary,
    "experiment": q_experiment,
}


def all_queries() -> dict:
    out = {}
    out.update(PREPROCESS_QUERIES)
    out.update(METRIC_QUERIES)
    out.update(SPLIT_QUERIES)
    out.update(MODEL_QUERIES)
    return out
