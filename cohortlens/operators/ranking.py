"""Exact, repeatable ranks inside large groups without a one-task window.

``hash_rank`` orders rows of each group by the MD5 of ``seed:key`` (a hash that
any SQL engine has). Its first three hex digits split every group into 4096
balanced buckets whatever the key distribution: bucket sizes are counted
(partial aggregation), a window over the small (group, bucket) table gives
each bucket's offset, and ``row_number`` runs per (group, bucket). Ranks are
1..n without gaps and identical on every run if the keys are unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DIGITS = 3


def seeded_hash(key_cols, seed: int) -> Column:
    """MD5 (hex) of the seed and the keys as text, joined by colons; null counts as empty."""
    return F.md5(F.concat_ws(":", F.lit(str(int(seed))),
                             *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols]))


def hash_number(hexed: Column) -> Column:
    """The first 15 hex digits as a long."""
    return F.conv(F.substring(hexed, 1, 15), 16, 10).cast("long")


def hash_rank(df: DataFrame, group_cols, key_cols, seed: int, rank_col: str = "rank") -> DataFrame:
    """Add ``rank_col``: position of the row in its group by (md5(seed:key), key)."""
    group_cols, key_cols = list(group_cols), list(key_cols)
    tagged = df.withColumn("__h", seeded_hash(key_cols, seed)) \
        .withColumn("__b", F.substring("__h", 1, BUCKET_DIGITS))
    counts = tagged.groupBy(*group_cols, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group_cols).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group_cols, "__b",
                            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    inner = Window.partitionBy(*group_cols, "__b").orderBy("__h", *key_cols)
    ranked = tagged.withColumn("__k", F.row_number().over(inner)).join(offsets, [*group_cols, "__b"]) \
        .withColumn(rank_col, F.col("__off") + F.col("__k"))
    return ranked.drop("__h", "__b", "__off", "__k")


def seeded_sample(df: DataFrame, k: int, key_cols, seed: int) -> DataFrame:
    """``k`` rows (all, if there are fewer), those with the least MD5 of ``seed:key``.

    Each task keeps its own first ``k`` and those meet (``TakeOrderedAndProject``): nothing is sorted as a whole, and
    the same rows come whatever the partitions, if the keys are unique. ``k`` is the feature: a report's sample.
    """
    hashed = df.withColumn("__h", seeded_hash(key_cols, seed))
    return hashed.orderBy("__h", *key_cols).limit(k).drop("__h")
