"""Sentinel -> null and mode / mean imputation, fitted per group.

``fit_imputer`` is one grouped aggregate (partial aggregation, so every
partition sends at most one row per group); ``ImputeModel.transform`` joins
that table null-safely on the group key and fills nulls. Both are lazy, so
fitting and filling are one plan, and the join's strategy is the optimizer's.
Fitting on a train split alone gives leak-free imputation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import presets as P
from ..spec import STUDY, PanelSpec

_NUMERIC = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType, T.ByteType,
            T.DecimalType)


def numeric_columns(df: DataFrame, exclude=()) -> list:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, _NUMERIC) and f.name not in exclude]


def sentinel_to_null(df: DataFrame, threshold: float = P.SENTINEL_THRESHOLD,
                     exclude=(P.ID_COL,)) -> DataFrame:
    """Every numeric column except the id: |value| > threshold -> null.
    NaN orders above every number in Spark, so it turns null too."""
    cols = set(numeric_columns(df, exclude))
    t = float(threshold)
    return df.selectExpr(*[
        f"CASE WHEN `{c}` > {t}D OR `{c}` < -{t}D THEN NULL ELSE `{c}` END AS `{c}`" if c in cols
        else f"`{c}`" for c in df.columns])


@dataclass
class ImputeModel:
    by: tuple
    stats: DataFrame     # one row per group: the group columns, then one statistic per column
    columns: list
    few_groups: bool = False     # the groups are few by their meaning (row types): their row goes to every task

    def transform(self, df: DataFrame) -> DataFrame:
        """Fill nulls with the group's statistic; groups without one stay as they are."""
        if not self.columns:
            return df
        names = [f"`{b}` AS `__by_{b}`" for b in self.by] + [f"`{c}` AS `__fill_{c}`" for c in self.columns]
        side = self.stats.selectExpr(*names, "1 AS __one")
        if self.few_groups:          # joined by shuffle, all rows of a group would meet in one task
            side = F.broadcast(side)
        rows = df.withColumn("__here", F.lit(1))
        on = rows["__here"] == side["__one"]
        for b in self.by:
            on = on & rows[b].eqNullSafe(side[f"__by_{b}"])
        filled = set(self.columns)
        return rows.join(side, on, "left").selectExpr(*[
            f"coalesce(`{c}`, CAST(`__fill_{c}` AS {df.schema[c].dataType.simpleString()})) AS `{c}`" if c in filled
            else f"`{c}`" for c in df.columns])


def _stat_columns(df, categorical, by, exclude):
    cat = [c for c in categorical if c in df.columns]
    num = [c for c in numeric_columns(df, set(exclude) | set(cat) | set(by))]
    return cat, num


def _grouped_stats(df, cat, num, by):
    aggs = [F.mode(F.col(c), True).cast("double").alias(f"m__{c}") for c in cat]
    aggs += [F.avg(F.col(c)).alias(f"a__{c}") for c in num]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def imputation_stats(df: DataFrame, categorical, by=("data_type",),
                     exclude=(P.ID_COL, "label", "visit"), kind: str = "both") -> DataFrame:
    """Lazy statistics table ``(by..., column, value)``: modes (``kind='mode'``),
    means (``'mean'``) or both. One grouped aggregate, then an unpivot of the
    one row per group."""
    cat, num = _stat_columns(df, categorical, by, exclude)
    g = _grouped_stats(df, cat, num, by)
    names = {"mode": [f"m__{c}" for c in cat], "mean": [f"a__{c}" for c in num]}
    cols = names["mode"] + names["mean"] if kind == "both" else names[kind]
    long = g.unpivot(list(by), cols, "column", "value")
    return long.withColumn("column", F.regexp_replace("column", "^[ma]__", ""))


def fit_imputer(df: DataFrame, categorical, by=("data_type",),
                exclude=(P.ID_COL, "label", "visit")) -> ImputeModel:
    """Mode (smallest of the most frequent) for ``categorical``; mean for the
    other numeric columns. All-null columns get no statistic and stay null."""
    cat, num = _stat_columns(df, categorical, by, exclude)
    grouped = _grouped_stats(df, cat, num, by)
    stats = grouped.selectExpr(*[f"`{b}`" for b in by], *[f"`m__{c}` AS `{c}`" for c in cat],
                               *[f"`a__{c}` AS `{c}`" for c in num])
    return ImputeModel(tuple(by), stats, cat + num)


def impute_intervals(df: DataFrame, spec: PanelSpec = STUDY, by=("data_type",)) -> DataFrame:
    """Sentinel -> null, then mode / mean per group (statistics over all rows
    of each group, as the reference computes them before any split)."""
    clean = sentinel_to_null(df, spec.threshold, exclude=(spec.id_col,))
    model = fit_imputer(clean, spec.categorical_columns, by=by,
                        exclude=(spec.id_col, "label", "visit"))
    model.few_groups = tuple(by) in ((), ("data_type",))
    return model.transform(clean)
