"""Small hostile tables for the operators' tests."""

from pyspark.sql import types as T

#: Names that the operators use inside; documents carry them as extra columns.
CLASH = ["h", "key", "node", "root", "part", "topic", "chunk", "words", "size", "rank", "line", "shard", "feature", "score"]

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())] + [T.StructField(c, T.StringType()) for c in CLASH])


def documents(spark, rows):
    """``rows``: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(r[0], r[1], *(r[2:] or ("en", "s0")), len(r[1] or ""), *["x"] * len(CLASH)) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed, n, words=400):
    """``n`` invented words, deterministic."""
    import random
    r = random.Random(seed)
    return " ".join("".join(r.choice(["an", "th", "er", "on", "es", "ti", "re", "in", "ou"]) for _ in range(r.randint(1, 3)))
                    + str(r.randint(0, words)) * 0 for _ in range(n))


#: Null, empty, blank, long and repeated texts, a null id and a repeated row.
EDGE = [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "one two"), (6, prose(1, 60)), (7, prose(1, 60)),
        (8, prose(2, 30_000)), (9, prose(3, 50)), (9, prose(3, 50)), (None, prose(4, 40)), (10, "x" * 50_000),
        (11, "Line of text that repeats\nLine of text that repeats\nline of text that repeats")]
