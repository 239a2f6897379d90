"""Sources: the cohort panel and the measurement table, from a path or a DataFrame.

CSV is read with a header and without type inference (every cell arrives as
text and the panel operators coerce with ``try_cast``), so one malformed cell
never changes a whole column's type. Parquet keeps its schema. Other suffixes
are rejected; Excel and SAS7BDAT are single-machine formats and are expected
converted to CSV or Parquet upstream.
"""

from __future__ import annotations

from pathlib import PurePath

from pyspark.sql import DataFrame, SparkSession

SUPPORTED = (".csv", ".parquet")


def read_path(spark: SparkSession, path: str) -> DataFrame:
    suffix = PurePath(path.rstrip("/")).suffix.lower()
    if suffix == ".csv":
        return spark.read.option("header", True).option("inferSchema", False).csv(path)
    if suffix == ".parquet":
        return spark.read.parquet(path)
    raise ValueError(f"can't read {suffix or 'a path without a suffix'}; known are {' and '.join(SUPPORTED)}")


def load_input(spark: SparkSession, data) -> DataFrame:
    """A DataFrame passes through; a path is read by its suffix."""
    if isinstance(data, DataFrame):
        return data
    return read_path(spark, str(data))


def load_cohort_data(spark: SparkSession, data) -> DataFrame:
    return load_input(spark, data)


def load_measurements(spark: SparkSession, data) -> DataFrame:
    return load_input(spark, data)
