"""Stand-in prediction table from ``lineitem`` (long form, F4 schema).

Row key = (order, line number, part, supplier), unique in ``lineitem``; split = ``validation`` for closed
lines (status F), ``test`` otherwise; label = returned (flag R). The
"models" are fixed score columns in [0, 1] with heavy ties (discount and tax
take about ten values each), which is what the metrics must handle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .standins import read_table

ROW_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

# fixed values: the stand-in score columns
SCORE_MODELS = {
    "disc": "l_discount * 10",
    "tax": "l_tax * 12.5",
    "qty": "l_quantity / 50",
    "mix": "(l_discount * 10 + l_quantity / 50) / 2",
}


def wide_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        *ROW_KEYS,
        F.when(F.col("l_linestatus") == "F", "validation").otherwise("test").alias("split"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        *[F.expr(e).cast("double").alias(m) for m, e in SCORE_MODELS.items()])


def long_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = wide_predictions(spark, sf_dir)
    return w.unpivot([*ROW_KEYS, "split", "label"], list(SCORE_MODELS), "model", "prob")
