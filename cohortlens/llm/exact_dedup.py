"""Exact document dedup: group by a 128-bit content hash, compare bytes inside groups, keep one stable id.

DataFrame functions only. The hash groups first; inside a group texts are
compared byte for byte (they are grouping keys themselves), so two different
texts with one hash never merge. A hot group of copies shrinks to one row per
map task before the shuffle.

Defined cases: null text counts as empty and all empty texts are equal; a
null id never wins over a real one; an empty table gives an empty result. In
``exact_groups`` rows that repeat an id and text share one decision, and a
group without any id keeps all its rows (its ``keep_id`` is null); other
columns are not read. ``exact_dedup`` keeps exactly one row of every text,
with or without an id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import saved, table, whole_text


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max",
                 hash_of=content_hash) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    ``keep``: "max" or "min" id of equal texts stays. ``hash_of`` maps the text
    column to the grouping hash (tests pass a weak one to force collisions).
    """
    best = {"max": F.max, "min": F.min}[keep]
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    rows = rows.withColumn("h", hash_of(F.col("text")))
    by_text = rows.groupBy("h", "text").agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # Groups without their texts are small; a hash with more than one text is a collision.
    groups = saved(by_text.groupBy("h").agg(F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"),
                                            F.max("group_size").alias("group_size")), "exact-groups")
    if groups.filter("texts > 1").isEmpty():
        out = rows.withColumn("text_sha256", F.sha2("text", 256)).drop("text") \
            .join(groups.drop("texts"), "h")
    else:  # some hash holds several texts: those rows find their group by the bytes
        hit = groups.filter("texts > 1").select("h")
        keyed = rows.withColumn("text_sha256", F.sha2("text", 256))
        clear = keyed.drop("text").join(groups.filter("texts = 1").drop("texts"), "h")
        mixed = keyed.join(by_text.join(hit, "h", "left_semi"), ["h", "text"]).select(*clear.columns)
        out = clear.unionByName(mixed)
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      "text_sha256")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max",
                hash_of=content_hash) -> DataFrame:
    """One document of each text, with all its columns: that of the best id, as in ``exact_groups``.

    The row itself is carried through the grouping, so a text that only
    documents without an id have stays too, once. Of rows that share text and
    id, the one with the largest hash of its columns stays.
    """
    best = {"max": F.max_by, "min": F.min_by}[keep]
    others = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    unnamed = F.col(id_col).isNull()
    order = F.struct(~unnamed if keep == "max" else unnamed, F.col(id_col), F.xxhash64(*others))
    row = F.struct(*[F.col(c) for c in docs.columns])
    kept = docs.select(row.alias("_row"), order.alias("_order"), whole_text(text_col).alias("_body")) \
        .withColumn("_hash", hash_of(F.col("_body"))).groupBy("_hash", "_body").agg(best("_row", "_order").alias("_row"))
    return kept.select("_row.*")


def op7_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


OP7_SQL = """
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(body) AS text_sha256
FROM (SELECT doc_id, body, max(doc_id) OVER (PARTITION BY body) AS keep_id,
             count(*) OVER (PARTITION BY body) AS group_size
      FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents))
"""
