"""Entry 1: raw cohort + measurement table -> interval examples.

One lazy plan: scan -> join -> normalise -> carry forward -> explode both
outcomes -> drop -> impute. The only shuffles are the participant join and
the imputation statistics (a grouped aggregate with two groups, pre-combined
in every partition); the rest is narrow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import presets as P
from ..operators.impute import impute_intervals
from ..operators.intervals import build_intervals, drop_missing_baseline
from ..operators.panel import (carry_forward, clean_measurements, lowercase_columns,
                               merge_panels, prepare_panel, scale_income_columns)
from ..sources.readers import load_cohort_data, load_measurements
from ..spec import STUDY, PanelSpec


def prepared_panel(cohort: DataFrame, measurements: DataFrame | None, spec: PanelSpec = STUDY,
                   *, scale_income: bool = False, key: str = P.RAW_ID_COL,
                   validate_measurements: bool = True) -> DataFrame:
    """Steps up to carry-forward: the wide panel the interval builder reads.
    Inputs are DataFrames or paths (.csv / .parquet)."""
    if not isinstance(cohort, DataFrame) or (measurements is not None
                                             and not isinstance(measurements, DataFrame)):
        spark = SparkSession.getActiveSession()
        cohort = load_cohort_data(spark, cohort)
        if measurements is not None:
            measurements = load_measurements(spark, measurements)
    if scale_income:
        cohort = scale_income_columns(cohort, spec)
    if measurements is not None:
        meas = clean_measurements(measurements, spec.sentinel, validate=validate_measurements)
        cohort = merge_panels(cohort, meas, key)
    panel = prepare_panel(lowercase_columns(cohort), spec)
    return carry_forward(panel, spec)


def preprocess(cohort: DataFrame, measurements: DataFrame | None, spec: PanelSpec = STUDY, *,
               scale_income: bool = False, impute_missing: bool = True,
               drop_drug_missing_baseline: bool = True, key: str = P.RAW_ID_COL,
               validate_measurements: bool = True) -> DataFrame:
    """Interval examples for both outcomes, tagged ``data_type`` = drug / diag.

    ``impute_missing=False`` also keeps the sentinel (and the huge changes it
    produces), as the reference does; run ``sentinel_to_null`` and a
    train-only ``fit_imputer`` afterwards for leak-free imputation.
    """
    panel = prepared_panel(cohort, measurements, spec, scale_income=scale_income, key=key,
                           validate_measurements=validate_measurements)
    rows = build_intervals(panel, spec)
    if drop_drug_missing_baseline:
        rows = drop_missing_baseline(rows, spec)
    if impute_missing:
        rows = impute_intervals(rows, spec)
    return rows


def write_intervals(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Sink: partitioned by ``data_type`` so a later row-type filter prunes directories.

    Writing over a folder replaces the row types that ``df`` has and leaves the others."""
    w = df.write.mode(mode).partitionBy("data_type").option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
