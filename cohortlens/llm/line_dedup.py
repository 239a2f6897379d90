"""Line dedup by deletion neighbourhoods: a line goes if an earlier line is within one edit of it.

An occurrence (document, line number) stays if it is the first of its text
and no earlier distinct line is within edit distance 1 (insertion, deletion
or substitution of one character); "earlier" is by (doc_id, line number).
Blank lines always stay; lines under ``min_chars`` characters match exactly
only. Whole lines of any length take part.

A pair of lines within one edit shares a variant: the string left when one
character is deleted at one place. Emitting every variant of every line is
wasteful, as most lines have no partner, so places are narrowed down first,
without loss: for the longer length m of a pair, cut at a window [q, q + w)
that holds the edit, the text before the window and the text after it are the
same in both lines. Windows of half a line come first (four hashed keys a
line), then sixteenths of the windows that met a partner, then the single
characters of those. At single characters all lines that share a key are
pairwise within one edit, so the earliest of each key's group is all that a
line needs: no pairs are emitted, whatever the size of a group. The edit
distance to that earliest line is verified. DataFrame functions only.

Defined cases: null text has no lines; repeated rows keep equal decisions (they
share their place in the order), and so do lines of one number in documents
without an id, which come before all others; of equal lines the smallest (id,
number) stays; empty tables give no rows; other columns are not read.
``dedup_lines`` keeps them, whatever they are called, and leaves the texts of
documents without an id as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import maybe_in, saved, table

MIN_CHARS = 16


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line: doc_id, line_no (from 0), line."""
    return docs.select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(F.col(text_col), "\n", -1))
                       .alias("line_no", "line"))


def _keyed(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Add the key of (m, q, w): what the line has before and after the window, hashed."""
    after = "greatest(0, m - q - w)"
    return rows.select(*keep, "m", "q", "w", F.expr(
        f"xxhash64(m, q, w, left(line, q), IF({after} = 0, '', right(line, {after})))").alias("key"))


def _shared(keyed: DataFrame) -> DataFrame:
    """Keys that two distinct lines have (lines told apart by a 64-bit hash)."""
    ids = keyed.select("key", F.xxhash64("lid").alias("x"))
    return saved(ids.groupBy("key").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).filter("lo != hi")
                 .select("key"), "line-keys")


def _met(keyed: DataFrame) -> DataFrame:
    """Windows whose key another line has, of each distinct line; few rows pass the bitmap into the join."""
    keys = _shared(keyed)
    # Inner joins: a semi join would be moved below the bitmap's join.
    return maybe_in(keyed, "key", keys).join(keys, "key").select("lid", "m", "q", "w").distinct()


def earliest_neighbours(lines: DataFrame) -> DataFrame:
    """lid, near (place of the earliest earlier line within one edit) of distinct lines that have one.

    ``lines``: rows lid (128-bit hash), line, with place = struct(doc_id, line_no) of each occurrence.
    """
    m = "explode(array(char_length(line), char_length(line) + 1))"
    first = lines.select("lid", "line", F.expr(f"{m} AS m"))
    first = first.select("lid", "line", "m", F.expr("CAST(ceil(m / 2) AS INT) AS w"))
    first = first.select("lid", "line", "m", "w", F.expr("explode(array(0, w)) AS q"))
    keyed = _keyed(first, ["lid"])
    met = saved(_met(keyed), "line-windows")
    texts = maybe_in(lines.select("lid", "line", "place"), "lid", met.select("lid")) \
        .join(met.select("lid").distinct(), "lid") \
        .groupBy("lid", "line").agg(F.min("place").alias("place"))
    texts = saved(texts, "line-texts")
    level2 = met.join(texts.select("lid", "line"), "lid").select(
        "lid", "line", "m", F.expr("CAST(ceil(w / 16) AS INT) AS w"),
        F.expr("explode(sequence(q, least(q + w, m) - 1, CAST(ceil(w / 16) AS INT))) AS q"))
    level3 = saved(_met(_keyed(level2, ["lid"])), "line-places").join(texts, "lid").select(
        "lid", "line", "place", "m", F.lit(1).alias("w"), F.expr("explode(sequence(q, least(q + w, m) - 1)) AS q"))
    keyed3 = _keyed(level3, ["lid", "place"]).select("lid", "place", "key")
    groups = keyed3.groupBy("key").agg(F.min("place").alias("near"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    near = keyed3.join(groups.select("key", "near"), "key").filter("near < place") \
        .groupBy("lid").agg(F.min("near").alias("near"))
    # The keys are hashes: verify against the text of that neighbour.
    pairs = near.join(texts.select("lid", "line"), "lid") \
        .join(texts.select(F.col("place").alias("near"), F.col("line").alias("other")), "near")
    return pairs.filter(F.expr("levenshtein(line, other, 1) BETWEEN 0 AND 1")).select("lid", "near")


def line_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line: doc_id, line_no, n_chars, kept, same_doc_id and same_line_no (the earlier line, if dropped)."""
    lines = lines_of(docs, id_col, text_col)
    real = lines.filter(F.trim("line") != "").withColumn("lid", F.unhex(F.md5("line"))) \
        .withColumn("place", F.struct("doc_id", "line_no"))
    firsts = real.groupBy("lid").agg(F.min("place").alias("first"))
    near = earliest_neighbours(real.filter(F.char_length("line") >= min_chars))
    verdict = saved(firsts.join(near, "lid", "left"), "line-verdicts")
    hit = real.select("doc_id", "line_no", F.char_length("line").alias("n_chars"), "lid", "place").join(verdict, "lid")
    same = F.coalesce(F.col("near"), F.when(F.col("first") != F.col("place"), F.col("first")))
    hit = hit.withColumn("same", same).select(
        "doc_id", "line_no", "n_chars", F.col("same").isNull().alias("kept"),
        F.col("same.doc_id").alias("same_doc_id"), F.col("same.line_no").alias("same_line_no"))
    blank = lines.filter(F.trim("line") == "").select(
        "doc_id", "line_no", F.char_length("line").alias("n_chars"), F.lit(True).alias("kept"),
        F.lit(None).cast(dict(hit.dtypes)["same_doc_id"]).alias("same_doc_id"),
        F.lit(None).cast("int").alias("same_line_no"))
    return hit.unionByName(blank)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents with dropped lines removed from their texts; ids must be unique."""
    lines, key = (name + "_" * sum(map(len, docs.columns)) for name in ("gone_lines", "gone_id"))    # longer than any column
    gone = line_decisions(docs, id_col, text_col, min_chars).filter("NOT kept").groupBy("doc_id") \
        .agg(F.collect_set("line_no").alias(lines)).withColumnRenamed("doc_id", key)
    out = docs.join(gone, F.col(id_col) == F.col(key), "left")
    kept = F.filter(F.transform(F.split(F.col(text_col), "\n", -1), lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
                    lambda s: ~F.array_contains(lines, s["i"]))
    new = F.when(F.col(lines).isNull(), F.col(text_col)).otherwise(
        F.array_join(F.transform(kept, lambda s: s["x"]), "\n"))
    return out.withColumn(text_col, new).select(*docs.columns)


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    return line_decisions(table(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH parts AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
occ AS (SELECT doc_id, unnest(range(len(ls)))::INT AS line_no, unnest(ls) AS line FROM parts),
dist AS (SELECT line, min((doc_id, line_no)) AS first FROM occ WHERE trim(line, ' ') <> '' GROUP BY line),
long AS (SELECT line, first, length(line) AS n FROM dist WHERE length(line) >= 16),
roles AS (SELECT *, unnest([n, n + 1]) AS m FROM long),
halves AS (SELECT line, first, n, m, 0 AS side, left(line, ceil(m / 2)::INT) AS k FROM roles
           UNION ALL
           SELECT line, first, n, m, 1, right(line, (m - ceil(m / 2))::INT) FROM roles),
pairs AS (SELECT DISTINCT a.line, a.first, a.n, b.line AS other, b.first AS ofirst, b.n AS bn
          FROM halves a JOIN halves b ON a.m = b.m AND a.side = b.side AND a.k = b.k AND b.first < a.first),
near AS (SELECT line, min(ofirst) AS near FROM pairs
         WHERE CASE WHEN n = bn THEN len(list_filter(range(n), lambda p: left(line, p) || substr(line, p + 2)
                                                                  = left(other, p) || substr(other, p + 2))) > 0
                    WHEN n = bn + 1 THEN len(list_filter(range(n), lambda p: left(line, p) || substr(line, p + 2) = other)) > 0
                    WHEN bn = n + 1 THEN len(list_filter(range(bn), lambda p: left(other, p) || substr(other, p + 2) = line)) > 0
                    ELSE false END
         GROUP BY line)
SELECT o.doc_id, o.line_no, length(o.line)::INT AS n_chars, s.same IS NULL AS kept,
       s.same[1] AS same_doc_id, s.same[2] AS same_line_no
FROM occ o LEFT JOIN LATERAL (
  SELECT coalesce(x.near, CASE WHEN d.first <> (o.doc_id, o.line_no) THEN d.first END) AS same
  FROM dist d LEFT JOIN near x ON x.line = d.line WHERE d.line = o.line) s ON true
"""
