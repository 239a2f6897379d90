"""Sequence packing by reciprocal classes: documents -> token ids -> sequences of at most ``capacity`` ids on disk.

A piece of length s belongs to class k = capacity // s, and a bin of class k
takes exactly k pieces, whatever they are; no bin is searched for room, so
every worker fills its own bins from its own documents and nothing is
shuffled. A document is cut so that its pieces nearly fill their share of a
bin: whole capacities first; then the rest stays whole if k of its size leave
at most ``WASTE`` of a bin empty, else the largest capacity // k that it holds
is cut off and the remainder goes on alike (three or four pieces in all).

A worker's unfinished bins, at most one a class, are handed on: the bins of
``FAN_IN`` workers meet in one task that goes on filling, and so on until one
task is left, which joins what remains across classes, cuts it at the
capacity and its last part into powers of two. Such a task reads at most
FAN_IN bins a class, however large the input.

The files are Parquet tables, one folder a level and one row a sequence:
worker, number (in the worker), done, n_ids, width (bytes an id), ids, and per
piece doc_ids, starts, lengths, doc_tokens. A sequence is padded to the capacity when it is used
(``padded``), unless its length is a power of two. Parquet's commit makes a
lost executor's tasks be written again as a whole.

Defined cases: null text counts as empty (the end id alone); null ids stay
null; documents that share an id, and repeated rows, are packed each; a text
of any length is cut; an empty table makes no sequence; other columns are not
read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.llm.common import pieces, table, whole_text, work_dir
from cohortlens.llm.token_output import tokenizer_path, word_ids

CAPACITY, END_ID = 4096, 2
#: Share of a bin that may stay empty.
WASTE = 1 / 128
#: Workers whose unfinished bins meet in one task.
FAN_IN = 8
PIECE_BYTES = 4 << 20
#: Ids in one Arrow batch of sequences.
BATCH_IDS = 1 << 20

SEQUENCE_SCHEMA = ("worker int, number long, done boolean, n_ids int, width int, ids binary, doc_ids array<long>, "
                   "starts array<long>, lengths array<int>, doc_tokens array<long>")
_ARROW = pa.schema([("worker", pa.int32()), ("number", pa.int64()), ("done", pa.bool_()), ("n_ids", pa.int32()),
                    ("width", pa.int32()), ("ids", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
                    ("starts", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())),
                    ("doc_tokens", pa.list_(pa.int64()))])


@lru_cache(maxsize=8)
def rest_cuts(capacity: int = CAPACITY, waste: float = WASTE) -> list[tuple[int, ...]]:
    """For every length below the capacity, the lengths it is cut into."""
    cuts: list[tuple[int, ...]] = [()]
    for rest in range(1, capacity):
        k = capacity // rest
        if capacity - k * rest <= waste * capacity:
            cuts.append((rest,))
        else:
            share = capacity // (k + 1)
            cuts.append((share, *cuts[rest - share]))
    return cuts


class Bins:
    """The open bins of one worker; finished ones become rows."""

    def __init__(self, worker: int, width: int, capacity: int):
        self.worker, self.width, self.capacity = worker, width, capacity
        self.open: dict[int, list] = {}         # class -> [(doc id, start, ids, doc tokens)]
        self.rows: list[dict] = []
        self.held = self.number = 0

    def put(self, piece: tuple) -> None:
        k = self.capacity // len(piece[2])
        bin_ = self.open.setdefault(k, [])
        bin_.append(piece)
        if len(bin_) == k:
            self.emit(self.open.pop(k))

    def add(self, doc_id, ids: np.ndarray, cuts: list[tuple[int, ...]]) -> None:
        """Cut one document and put its pieces."""
        at, n, c = 0, len(ids), self.capacity
        while n - at >= c:
            self.emit([(doc_id, at, ids[at:at + c], n)])
            at += c
        for size in cuts[n - at]:
            self.put((doc_id, at, ids[at:at + size], n))
            at += size

    def emit(self, bin_: list, done: bool = True) -> None:
        ids = np.concatenate([p[2] for p in bin_])
        self.rows.append({"worker": self.worker, "number": self.number, "done": done, "n_ids": len(ids),
                          "width": self.width, "ids": ids.tobytes(), "doc_ids": [p[0] for p in bin_],
                          "starts": [p[1] for p in bin_], "lengths": [len(p[2]) for p in bin_],
                          "doc_tokens": [p[3] for p in bin_]})
        self.held += len(ids)
        self.number += done

    def taken(self) -> pa.RecordBatch:
        rows, self.rows, self.held = self.rows, [], 0
        return pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    def close(self) -> None:
        """Hand the open bins on, unfinished."""
        for k in sorted(self.open):
            self.emit(self.open[k], done=False)

    def join_rest(self) -> None:
        """Finish with what is open: one run of pieces cut at the capacity, its end into powers of two."""
        run = [p for k in sorted(self.open) for p in self.open[k]]
        left = sum(len(p[2]) for p in run)
        while left:
            room = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
            left -= room
            bin_ = []
            while room:
                doc_id, start, ids, n = run.pop(0)
                if len(ids) > room:
                    run.insert(0, (doc_id, start + room, ids[room:], n))
                    ids = ids[:room]
                bin_.append((doc_id, start, ids, n))
                room -= len(ids)
            self.emit(bin_)


def _id_type(width: int) -> str:
    return f"<u{width}"


def _fill(tokenizer: str, end_id: int, capacity: int, waste: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, cuts, bins = word_ids(tokenizer), rest_cuts(capacity, waste), None
        width = 2 if coder.vocab <= 1 << 16 else 4
        for batch in pieces(batches, "text", PIECE_BYTES):
            bins = bins or Bins(batch.column("worker")[0].as_py(), width, capacity)
            ids, counts = coder.encode(batch.column("text"))
            ids, ends = ids.astype(_id_type(width)), np.cumsum(counts)
            end = np.array([end_id], ids.dtype)
            for doc_id, a, z in zip(batch.column("doc_id").to_pylist(), (ends - counts).tolist(), ends.tolist()):
                bins.add(doc_id, np.concatenate([ids[a:z], end]), cuts)
                if bins.held >= BATCH_IDS:
                    yield bins.taken()
        if bins:
            bins.close()
            yield bins.taken()
    return run


def _refill(capacity: int, last: bool):
    """Go on with the unfinished bins of the workers of each group (rows come group by group)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = None

        def closed(bins):
            bins.join_rest() if last else bins.close()
            return bins.taken()
        for batch in batches:
            for row in batch.to_pylist():
                if bins and bins.worker != row["team"]:
                    yield closed(bins)
                    bins = None
                bins = bins or Bins(row["team"], row["width"], capacity)
                ids, at = np.frombuffer(row["ids"], _id_type(row["width"])), 0
                for doc_id, start, n, tokens in zip(row["doc_ids"], row["starts"], row["lengths"], row["doc_tokens"]):
                    bins.put((doc_id, start, ids[at:at + n], tokens))
                    at += n
                if bins.held >= BATCH_IDS:
                    yield bins.taken()
        if bins:
            yield closed(bins)
    return run


def pack(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id",
         text_col: str = "text", capacity: int = CAPACITY, waste: float = WASTE) -> str:
    """Write the sequences below ``path``; returns it."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"),
                       F.spark_partition_id().alias("worker"))
    rows.mapInArrow(_fill(tokenizer, end_id, capacity, waste), SEQUENCE_SCHEMA).write.parquet(f"{path}/level=0")
    level, last = 0, False
    while not last:
        here = spark.read.schema(SEQUENCE_SCHEMA).parquet(f"{path}/level={level}")
        workers = here.agg(F.max("worker")).first()[0]
        teams = ((workers or 0) // FAN_IN) + 1
        last, level = teams == 1, level + 1
        teamed = here.filter("NOT done").withColumn("team", F.expr(f"worker div {FAN_IN}").cast("int")) \
            .repartition(teams, "team").sortWithinPartitions("team", "worker", "number", F.element_at("lengths", 1))
        teamed.mapInArrow(_refill(capacity, last), SEQUENCE_SCHEMA).write.parquet(f"{path}/level={level}")
    return path


def sequences(spark: SparkSession, path: str) -> DataFrame:
    """The finished sequences with their ``sequence_id``, numbered from 0 by level, worker and number."""
    rows = spark.read.schema(SEQUENCE_SCHEMA + ", level int").parquet(path).filter("done")
    # Sequences before a worker's, in two steps: by blocks of a thousand workers, then inside.
    counts = rows.groupBy("level", "worker").agg(F.count(F.lit(1)).alias("n")).withColumn("block", F.expr("worker div 1000"))
    blocks = counts.groupBy("level", "block").agg(F.sum("n").alias("n"))
    before = blocks.select("level", "block", (F.sum("n").over(W.orderBy("level", "block")) - F.col("n")).alias("before"))
    first = counts.join(before, ["level", "block"]).select("level", "worker", (F.col("before") - F.col("n") + F.sum("n").over(
        W.partitionBy("level", "block").orderBy("worker"))).alias("first"))
    return rows.join(first, ["level", "worker"]).withColumn("sequence_id", F.col("first") + F.col("number")) \
        .drop("first", "done", "level", "worker", "number")


def padded(ids: np.ndarray, capacity: int = CAPACITY, pad: int = 0) -> np.ndarray:
    """A sequence as it is used: padded to the capacity, unless its length is a power of two."""
    n = len(ids)
    return ids if n & (n - 1) == 0 else np.concatenate([ids, np.full(capacity - n, pad, ids.dtype)])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = batch.column("lengths").value_lengths().to_numpy(zero_copy_only=False)
        lengths = batch.column("lengths").flatten().to_numpy().astype(np.int64)
        whose = np.repeat(np.arange(batch.num_rows), counts)
        before = np.cumsum(lengths) - lengths
        offset = before - before[np.repeat(np.cumsum(counts) - counts, counts)]
        crcs, nxt = [], 0
        for row, width in enumerate(batch.column("width").to_pylist()):
            raw = np.frombuffer(batch.column("ids")[row].as_buffer(), _id_type(width)).astype("<u4").tobytes()
            at, nxt = nxt, nxt + int(counts[row])
            crcs += [zlib.crc32(raw[4 * o:4 * (o + n)]) for o, n in zip(offset[at:nxt].tolist(), lengths[at:nxt].tolist())]
        ids = np.asarray(batch.column("sequence_id").to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_ids").flatten(), batch.column("starts").flatten(), pa.array(lengths),
             pa.array(crcs, pa.int64()), batch.column("doc_tokens").flatten(), pa.array(ids[whose]), pa.array(offset)],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])


def packed_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Per piece of the files: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return sequences(spark, path).select("sequence_id", "width", "ids", "doc_ids", "starts", "lengths", "doc_tokens") \
        .mapInArrow(_pieces, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
                             "offset long")


def op12_packing(spark, sf_dir: str) -> DataFrame:
    path = pack(table(spark, sf_dir, "documents"), work_dir(spark, "packed"), tokenizer_path())
    return packed_pieces(spark, path)
