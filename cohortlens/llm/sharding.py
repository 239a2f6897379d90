"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Rows are placed on a ring of ``ring_slots`` slots by the hash of their text
(so equal texts meet), every shard owns the arcs before its virtual nodes, and
no shard takes more than its bound: what overflows a full shard continues
clockwise to the next virtual node of a shard with room. With ``slack=0`` the
bounds add up to the row count, so shard sizes are at most one apart (law
``rows``).

Only counts decide the placement. Rows are counted by slot first, and a slot
with many rows gets one salt for every ``salt_rows`` of them; the salt comes
from the id, so a text that a third of all rows share is spread over as many
groups as its count asks for. Rows are then counted by (slot, salt). The arcs' totals (shards x vnodes numbers, bounded by the
parameters) give intervals of ranks per arc and shard; each row then finds
its rank by a prefix count and its shard by those intervals. DataFrame
functions only.

Defined cases: null text counts as empty (16 bytes); null ids are placed like
others (rows of one text without an id share a salt); repeated rows each take a place; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.llm.common import table, whole_text

ROW_OVERHEAD = 16
RING_SLOTS = 1 << 16
VNODES = 64
SALT_ROWS = 20_000


def ring_arcs(shards: int, vnodes: int = VNODES, ring_slots: int = RING_SLOTS) -> list[tuple[int, int]]:
    """(last slot, shard) of each arc, clockwise; depends on the parameters alone."""
    nodes = {}
    for s in range(shards):
        for r in range(vnodes):
            at = int(hashlib.md5(f"{s}:{r}".encode()).hexdigest()[:15], 16) % ring_slots
            nodes.setdefault(at, s)   # of nodes on one slot the smallest shard holds it
    return sorted(nodes.items())


def place_arcs(counts: dict[int, int], arcs: list[tuple[int, int]], shards: int,
               slack: float = 0.0) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot in the shard) for arcs with ``counts`` rows.

    Shards keep their own arcs' rows first, in ring order; the overflow of
    each arc then goes clockwise to shards with room.
    """
    total = sum(counts.values())
    if slack:
        bound = [int((1 + slack) * total / shards) + 1] * shards
    else:
        bound = [total // shards + (s < total % shards) for s in range(shards)]
    used, out, over = [0] * shards, [], []
    for a, (_, s) in enumerate(arcs):
        n = counts.get(a, 0)
        take = min(n, bound[s] - used[s])
        if take:
            out.append((a, 0, take, s, used[s]))
            used[s] += take
        if take < n:
            over.append((a, take, n))
    for a, done, n in over:
        k = a
        while done < n:
            k = (k + 1) % len(arcs)
            s = arcs[k][1]
            take = min(n - done, bound[s] - used[s])
            if take:
                out.append((a, done, done + take, s, used[s]))
                used[s] += take
                done += take
            elif k == a:  # every owner on the ring is full: only a shard without an arc of its own has room
                s = min(x for x in range(shards) if used[x] < bound[x])
                take = min(n - done, bound[s] - used[s])
                out.append((a, done, done + take, s, used[s]))
                used[s] += take
                done += take
    return out


def shard_rows(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", vnodes: int = VNODES,
               slack: float = 0.0, ring_slots: int = RING_SLOTS, salt_rows: int = SALT_ROWS) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, shard, slot."""
    spark = docs.sparkSession
    arcs = ring_arcs(shards, vnodes, ring_slots)
    ends = [e for e, _ in arcs]
    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.md5(text).alias("h"))
    ring = F.conv(F.substring("h", 1, 15), 16, 10).cast("long") % ring_slots
    slot = rows.select(ring.cast("int").alias("ring")).groupBy("ring").agg(
        (1 + F.floor(F.count(F.lit(1)) / salt_rows)).alias("salts"))
    # At most a row a slot, fixed by the parameters.
    rows = rows.withColumn("ring", ring.cast("int")).join(F.broadcast(slot), "ring").select(
        "doc_id", "size", "text_crc32", "h", "ring", F.pmod(F.xxhash64("doc_id"), F.col("salts")).alias("salt"))
    # Slot -> arc: ring_slots rows, fixed by the parameters, hence safe to broadcast.
    arc_of = spark.createDataFrame([(x, bisect.bisect_left(ends, x) % len(arcs)) for x in range(ring_slots)],
                                   "ring int, arc int")
    cells = rows.groupBy("ring", "salt").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(arc_of), "ring")
    # Ranks run through an arc's slots, then salts (ring_slots / arcs slots on average).
    before = W.partitionBy("arc").orderBy("ring", "salt").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    counts = {r["arc"]: r["n"] for r in cells.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    placed = place_arcs(counts, arcs, shards, slack)
    # At most arcs + overflow pieces, fixed by the parameters.
    pieces = spark.createDataFrame(placed, "arc int, first long, end long, shard int, base long")
    inner = W.partitionBy("ring", "salt").orderBy("h", "doc_id")
    ranked = rows.withColumn("k", F.row_number().over(inner)).join(cells.drop("n"), ["ring", "salt"]) \
        .withColumn("rank", F.col("before") + F.col("k") - 1)
    p = pieces.withColumnRenamed("arc", "at")
    out = ranked.join(F.broadcast(p), (F.col("arc") == F.col("at")) & (F.col("rank") >= F.col("first"))
                      & (F.col("rank") < F.col("end")))
    return out.select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - F.col("first"))
                      .alias("slot"))


def op10_sharding(spark, sf_dir: str) -> DataFrame:
    out = shard_rows(table(spark, sf_dir, "documents"), 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
