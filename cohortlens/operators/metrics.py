"""Evaluation operators over a long prediction table.

Input: one row per (row, model, split) with a 0/1 ``label`` and a ``prob``
score; ``keys`` names the grouping columns (e.g. ``model``, ``split``), so
many models are scored in one job.

Running sums over scores use a two-level scheme instead of one window per
group (a window keyed by model alone would put a whole model's rows in one
task): rows are first collapsed to distinct scores (partial aggregation, so
a score held by a third of all rows costs one row), quantile boundaries of
each group's distinct scores cut them into ordered buckets of about equal
size whatever the scale (probabilities, margins), a small window over bucket
totals gives each bucket's offset, and a window partitioned by (group, bucket)
finishes the sum. Everything is lazy; the branches share the exchange of the
distinct scores. Null and NaN scores or labels raise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import presets as P

BUCKETS = 256


def checked_score(score: str, label: str):
    """The score as double and the label as long; null or NaN raises."""
    x = F.col(score).cast("double")
    bad = x.isNull() | F.isnan(x) | F.col(label).isNull()
    return (F.when(bad, F.raise_error(F.lit(f"{score} or {label} is missing or not a number"))).otherwise(x),
            F.col(label).cast("long"))


def score_counts(preds: DataFrame, keys, score: str = "prob", label: str = "label") -> DataFrame:
    """Rows collapsed to (keys, score, pos, neg)."""
    x, y = checked_score(score, label)
    return (preds.select(*keys, x.alias("score"), y.alias("__y"))
            .groupBy(*keys, "score")
            .agg(F.sum("__y").alias("pos"), F.sum(1 - F.col("__y")).alias("neg")))


def cumulative_below(counts: DataFrame, keys, buckets: int = BUCKETS) -> DataFrame:
    """Add ``pos_below`` / ``neg_below``: counts at strictly lower scores in the
    group, plus the (pos, neg) of the next lower distinct score (``prev_pos``,
    ``prev_neg``; null for the lowest)."""
    keys = list(keys)
    shares = F.array(*[F.lit((k + 1) / buckets) for k in range(buckets - 1)])
    bounds = counts.groupBy(*keys).agg(F.percentile_approx("score", shares, 20 * buckets).alias("__bounds"))
    counts = counts.join(bounds, keys).withColumn(
        "bucket", F.size(F.filter("__bounds", lambda b: b < F.col("score")))).drop("__bounds")
    bw = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bucket_tot = (counts.groupBy(*keys, "bucket")
                  .agg(F.sum("pos").alias("bpos"), F.sum("neg").alias("bneg"),
                       F.max_by(F.struct("pos", "neg"), "score").alias("top")))
    lag_w = Window.partitionBy(*keys).orderBy("bucket")
    offsets = bucket_tot.select(
        *keys, "bucket",
        F.coalesce(F.sum("bpos").over(bw), F.lit(0)).alias("pos_off"),
        F.coalesce(F.sum("bneg").over(bw), F.lit(0)).alias("neg_off"),
        F.lag("top").over(lag_w).alias("prev_top"))
    inner = Window.partitionBy(*keys, "bucket").orderBy("score")
    inner_before = inner.rowsBetween(Window.unboundedPreceding, -1)
    j = counts.join(offsets, [*keys, "bucket"])
    first_in_bucket = F.lag("pos").over(inner).isNull()
    return j.select(
        *keys, "bucket", "score", "pos", "neg",
        (F.col("pos_off") + F.coalesce(F.sum("pos").over(inner_before), F.lit(0))).alias("pos_below"),
        (F.col("neg_off") + F.coalesce(F.sum("neg").over(inner_before), F.lit(0))).alias("neg_below"),
        F.when(first_in_bucket, F.col("prev_top.pos")).otherwise(F.lag("pos").over(inner)).alias("prev_pos"),
        F.when(first_in_bucket, F.col("prev_top.neg")).otherwise(F.lag("neg").over(inner)).alias("prev_neg"))


def roc_auc(preds: DataFrame, keys=("model", "split"), score: str = "prob", label: str = "label",
            check_classes: bool = True) -> DataFrame:
    """Exact ROC AUC per group, ties counted half:
    sum(pos * (2 * neg_below + neg)) / (2 * P * N), in decimals of 38 digits.
    A group with one class raises (the evaluator would return 1.0)."""
    keys = list(keys)
    return auc_of(cumulative_below(score_counts(preds, keys, score, label), keys), keys, check_classes)


def auc_of(cum: DataFrame, keys, check_classes: bool = True) -> DataFrame:
    """AUC per group from ``cumulative_below``."""
    wide = "decimal(18,0)"
    area = F.col("pos").cast(wide) * (2 * F.col("neg_below") + F.col("neg")).cast("decimal(19,0)")
    g = cum.groupBy(*keys).agg(F.sum(area.cast("decimal(38,0)")).alias("__num"),
                               F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    auc = F.col("__num").cast("double") / (2.0 * F.col("n_pos") * F.col("n_neg"))
    if check_classes:
        auc = F.when((F.col("n_pos") == 0) | (F.col("n_neg") == 0),
                     F.raise_error(F.lit("AUC needs rows of both classes"))).otherwise(auc)
    return g.select(*keys, auc.cast("double").alias("auc"), "n_pos", "n_neg")


def roc_points(preds: DataFrame, keys=("model", "split"), score: str = "prob", label: str = "label") -> DataFrame:
    """ROC curve (threshold, fpr, tpr) per group: one point per distinct score
    from the highest down, collinear interior points dropped, plus the
    starting point (inf, 0, 0)."""
    keys = list(keys)
    cum = cumulative_below(score_counts(preds, keys, score, label), keys)
    tot = cum.groupBy(*keys).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"),
                                 F.max("score").alias("top_score"))
    j = cum.join(tot, keys)
    tp = F.col("P") - F.col("pos_below")
    fp = F.col("N") - F.col("neg_below")
    lowest = F.col("prev_pos").isNull()
    highest = F.col("score") == F.col("top_score")
    changed = (F.col("prev_pos") != F.col("pos")) | (F.col("prev_neg") != F.col("neg"))
    pts = j.filter(lowest | highest | changed).select(
        *keys, F.col("score").alias("threshold"),
        (fp / F.col("N")).alias("fpr"), (tp / F.col("P")).alias("tpr"))
    start = tot.select(*keys, F.lit(float("inf")).alias("threshold"),
                       F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(start)


def _cutoff(j):
    """Grid value j (1-based): start + (j - 1) * step, in double as the grid is built."""
    return F.lit(P.CUTOFF_START) + (j - 1).cast("double") * F.lit(P.CUTOFF_STEP)


def grid_position(prob, count: int = P.CUTOFF_COUNT):
    """Number of grid cutoffs <= prob (0..count), exact against the grid values."""
    k0 = F.least(F.greatest(F.floor(prob * 100), F.lit(0)), F.lit(count)).cast("int")
    down = F.when((k0 >= 1) & (_cutoff(k0) > prob), 1).otherwise(0)
    up = F.when((k0 < count) & (_cutoff(k0 + 1) <= prob), 1).otherwise(0)
    return k0 - down + up


def cutoff_histogram(preds: DataFrame, keys, score: str = "prob", label: str = "label") -> DataFrame:
    """(keys, k, pos, neg): rows counted by how many grid cutoffs they pass."""
    x, y = checked_score(score, label)
    return (preds.groupBy(*keys, grid_position(x).alias("k"))
            .agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")))


def _rates(tp, fp, P_, N_):
    fn = P_ - tp
    tn = N_ - fp
    precision = F.coalesce(F.try_divide(tp.cast("double"), tp + fp), F.lit(0.0))
    recall = F.coalesce(F.try_divide(tp.cast("double"), P_), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2.0 * tp, 2 * tp + fp + fn), F.lit(0.0))
    accuracy = F.try_divide((tp + tn).cast("double"), P_ + N_)
    return precision, recall, f1, accuracy


def best_cutoff(preds: DataFrame, keys=("model",), split_col: str = "split",
                select_on: str = "validation", apply_to: str = "test",
                score: str = "prob", label: str = "label") -> DataFrame:
    """Validation-chosen cutoff from the grid 0.01..0.99 (best F1, ties to the
    smallest cutoff, 0.01 when every F1 is 0), then precision / recall / F1 /
    accuracy on the other split at that cutoff (predicted positive when
    ``prob >= cutoff``). Works on a per-group histogram of at most 100 rows,
    never on the cross product of rows and cutoffs."""
    keys = list(keys)
    h = cutoff_histogram(preds, keys + [split_col], score, label)
    tot = h.groupBy(*keys, split_col).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    val = h.filter(F.col(split_col) == select_on)
    per_j = (val.filter(F.col("k") >= 1)
             .select(*keys, "pos", "neg", F.explode(F.sequence(F.lit(1), F.col("k"))).alias("j"))
             .groupBy(*keys, "j").agg(F.sum("pos").alias("tp"), F.sum("neg").alias("fp")))
    vt = tot.filter(F.col(split_col) == select_on).drop(split_col)
    scored = per_j.join(vt, keys)
    f1 = _rates(F.col("tp"), F.col("fp"), F.col("P"), F.col("N"))[2]
    best = (scored.groupBy(*keys)
            .agg(F.max_by("j", F.struct(f1, -F.col("j"))).alias("__j"), F.max(f1).alias("__f1")))
    chosen = (vt.select(*keys).join(best, keys, "left")
              .select(*keys, F.when(F.col("__f1") > 0, F.col("__j")).otherwise(F.lit(1)).alias("j"),
                      F.coalesce(F.col("__f1"), F.lit(0.0)).alias("validation_f1")))
    test = h.filter(F.col(split_col) == apply_to).drop(split_col)
    tt = tot.filter(F.col(split_col) == apply_to).drop(split_col)
    at = (test.join(chosen, keys)
          .groupBy(*keys, "j", "validation_f1")
          .agg(F.sum(F.when(F.col("k") >= F.col("j"), F.col("pos")).otherwise(0)).alias("tp"),
               F.sum(F.when(F.col("k") >= F.col("j"), F.col("neg")).otherwise(0)).alias("fp"))
          .join(tt, keys))
    precision, recall, f1t, acc = _rates(F.col("tp"), F.col("fp"), F.col("P"), F.col("N"))
    return at.select(*keys, _cutoff(F.col("j")).alias("cutoff"), precision.alias("precision"),
                     recall.alias("recall"), f1t.alias("f1"), acc.alias("accuracy"),
                     F.col("validation_f1"))


def confusion_at_cutoff(preds: DataFrame, cutoff: float = 0.5, keys=("model", "split"),
                        score: str = "prob", label: str = "label") -> DataFrame:
    """Confusion counts and rates at one cutoff (positive when prob >= cutoff)."""
    keys = list(keys)
    x, y = checked_score(score, label)
    hit = (x >= F.lit(float(cutoff))).cast("long")
    g = preds.groupBy(*keys).agg(F.sum(hit * y).alias("tp"), F.sum(hit * (1 - y)).alias("fp"),
                                 F.sum(y).alias("P"), F.sum(1 - y).alias("N"))
    precision, recall, f1, acc = _rates(F.col("tp"), F.col("fp"), F.col("P"), F.col("N"))
    return g.select(*keys, "tp", "fp", (F.col("P") - F.col("tp")).alias("fn"),
                    (F.col("N") - F.col("fp")).alias("tn"), precision.alias("precision"),
                    recall.alias("recall"), f1.alias("f1"), acc.alias("accuracy"))


def ensemble_mean(preds: DataFrame, models, row_keys=("row_id", "split"),
                  model_col: str = "model", name: str = "Ensemble") -> DataFrame:
    """Unweighted mean of the listed models' probabilities per row (long input).

    Raises unless every row has exactly one prediction from each listed model
    (a bit per model and the row count). One shuffle on the row key; see
    ``ensemble_mean_wide`` for the shuffle-free form."""
    models = list(models)
    number = F.array_position(F.array(*[F.lit(m) for m in models]), F.col(model_col)) - 1
    g = (preds.filter(F.col(model_col).isin(models)).withColumn("__m", number.cast("int"))
         .groupBy(*row_keys)
         .agg(F.avg("prob").alias("prob"), F.count(F.lit(1)).alias("__n"),
              F.expr("bit_or(shiftleft(1L, __m))").alias("__seen"), F.max("label").alias("label")))
    ok = (F.col("__n") == len(models)) & (F.col("__seen") == (1 << len(models)) - 1)
    return g.select(*row_keys, F.lit(name).alias(model_col), "label",
                    F.when(ok, F.col("prob")).otherwise(F.raise_error(
                        F.lit(f"a row does not have one prediction from each of {models}"))).alias("prob"))


def ensemble_mean_wide(df: DataFrame, prob_cols, out: str = "prob_ensemble") -> DataFrame:
    """Mean of per-model probability columns on the same rows: a projection."""
    total = None
    for c in prob_cols:
        total = F.col(c) if total is None else total + F.col(c)
    return df.withColumn(out, total / len(prob_cols))


def feature_stats(df: DataFrame, columns) -> DataFrame:
    """(feature, mean, var_pop, sd) for each column in one aggregate pass."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"m__{c}"), F.var_pop(c).alias(f"v__{c}")]
    row = df.agg(*aggs)
    stacked = row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"m__{c}").alias("mean"), F.col(f"v__{c}").alias("var_pop"))
        for c in columns])).alias("s")).select("s.*")
    return stacked.withColumn("sd", F.sqrt("var_pop"))


def auc_summary(aucs: DataFrame, model_col: str = "model", split_col: str = "split",
                select_on: str = "validation", report: str = "test") -> DataFrame:
    """One row per model with both AUCs, ranked by the reported AUC (best
    first, ties by name). The table has one row per model, so the unkeyed
    ranking window is over a handful of rows."""
    g = aucs.groupBy(model_col).agg(
        F.max(F.when(F.col(split_col) == select_on, F.col("auc"))).alias(f"auc_{select_on}"),
        F.max(F.when(F.col(split_col) == report, F.col("auc"))).alias(f"auc_{report}"))
    w = Window.orderBy(F.desc(f"auc_{report}"), F.col(model_col))
    return g.withColumn("rank", F.row_number().over(w))
