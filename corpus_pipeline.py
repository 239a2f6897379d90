"""From raw documents to token ids: five stages, each on all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents. All but the
last return the columns of ``documents``. A stage that removes documents goes
by their ids. For it a document with a null id goes by a hash of its text,
language and source (2 ** 62 and above), so it is judged like any other, and
has its null id again afterwards.

SQL can't express the pipeline (restoration, hashing, tiling and coding), so
its parts are tested against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import decontaminate, minhash_dedup, mixing, token_output, toxicity
from cohortlens.llm.common import saved, table, whole_text

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def named(docs: DataFrame) -> DataFrame:
    """The documents with ids for those that have none, marked ``unnamed``."""
    own = F.xxhash64(whole_text("text"), "lang", "source").bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    return docs.select(*COLUMNS).withColumn("unnamed", F.col("doc_id").isNull()) \
        .withColumn("doc_id", F.coalesce(F.col("doc_id").cast("long"), own))


def unnamed(docs: DataFrame) -> DataFrame:
    """The columns of ``documents``, null ids as they were."""
    return docs.withColumn("doc_id", F.when(~F.col("unnamed"), F.col("doc_id"))).select(*COLUMNS)


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold."""
    docs = named(docs)
    scores = toxicity.toxicity_scores(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out())
    gone = scores.filter(F.col("score") >= toxicity.THRESHOLD).select("doc_id").distinct()
    return unnamed(docs.join(gone, "doc_id", "left_anti"))


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group linked by 0.8 similar sets of five-word shingles."""
    return unnamed(minhash_dedup.near_dedup(named(docs), size=5, percent=80))


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is covered to 80 percent by shared tiles."""
    return unnamed(decontaminate.decontaminate(named(docs), table(spark, sf_dir, "benchmark")))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by probabilities raked to the source, language and topic targets."""
    docs = named(docs)
    taken = mixing.mix(docs).filter("sampled").select("doc_id").distinct()
    return unnamed(docs.join(taken, "doc_id", "left_semi"))


def to_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Range-coded token ids of the documents, written, read back and indexed."""
    return token_output.token_output(spark, docs)


STAGES = [("toxicity", toxic_out), ("near_dedup", near_copies_out), ("decontamination", benchmark_out),
          ("mixing", mixed), ("token_output", to_token_ids)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
