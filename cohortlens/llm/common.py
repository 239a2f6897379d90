"""Shared by the operators of this package: inputs, written intermediates, word streams.

Intermediate tables are written below ``spark.checkpoint.dir`` (the shared
folder the cluster names), so a lost executor costs its tasks only.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.session import ensure_checkpoint_dir

#: Bytes of text that one Python step holds at a time.
PIECE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: one evaluation, short lineage."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(text: str | Column) -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def maybe_in(rows: DataFrame, col: str, keys: DataFrame, bits: int = 24) -> DataFrame:
    """The ``rows`` whose 64-bit ``col`` may be among ``keys`` (one column of that name): a bitmap of 2**bits bits.

    The bitmap is broadcast as at most 2**(bits - 6) words, whatever the number of keys; rows it lets through by
    chance are for an exact join that follows. DataFrame functions only.
    """
    def spot(c):
        return F.pmod(F.xxhash64(c), F.lit(1 << bits))
    words = keys.select(spot(col).alias("_b")).groupBy(F.shiftright("_b", 6).alias("_w")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(_b & 63 AS INT)))").alias("_bits"))
    marked = rows.withColumn("_b", spot(col)).withColumn("_w", F.shiftright("_b", 6))
    return marked.join(F.broadcast(words), "_w").filter("(shiftright(_bits, CAST(_b & 63 AS INT)) & 1) = 1") \
        .drop("_w", "_b", "_bits")


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``limit`` bytes each (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
        release()


def release() -> None:
    """Give back the memory that Arrow's pools and (by the system pool's trim) numpy have freed."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


def coded_words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text: codes of all words in order, offsets by text, the distinct words.

    ``lower`` folds A-Z only.
    """
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    empty = pc.index(coded.dictionary, "").as_py()
    if empty >= 0:  # leading or trailing white space
        real = codes != empty
        offsets = np.concatenate([[0], np.cumsum(real)])[offsets]
        codes = codes[real]
    return codes, offsets, coded.dictionary


def split_words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """``coded_words`` with the distinct words as Python strings."""
    codes, offsets, words = coded_words(texts, lower)
    return codes, offsets, strings(words)


def strings(words: pa.Array) -> list[str]:
    """Python strings of an array without nulls (by way of numpy, several times as fast as one by one)."""
    return words.to_numpy(zero_copy_only=False).tolist()


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... (count of them) for each pair, one after the other."""
    ends = np.cumsum(counts)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    out = np.repeat(starts - (ends - counts), counts)
    out += np.arange(len(out))
    return out
