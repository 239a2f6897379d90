"""Near-duplicate documents: MinHash banding, signature check, exact check, alternating-star components.

1. Each document's distinct word shingles are hashed to 64 bits; ``bands`` x
   ``rows`` universal hash minima make its band keys and a signature of one
   byte a minimum. Documents with equal sets (all copies) are one node.
2. Every band bucket hangs its nodes on its smallest one; the components of
   these candidate edges hold every pair that shares a band. The rows of a
   band follow from the threshold: a pair at the threshold shares none of the
   48 bands with a probability under 1e-6 (8 rows at 0.85, 6 at 0.8).
3. Inside a candidate component nodes are dealt to tasks of ``TILE`` nodes,
   each with a few common hubs. A task links its nodes: pairs whose signatures
   allow the threshold (5 standard deviations of slack) are confirmed on the
   full sets, and pairs already connected are skipped, so a task writes a
   forest of links, not its pairs.
4. Where a candidate component needed several tasks, the nodes outside its
   largest linked part are then compared with all its other nodes, tile by
   tile. So no link between two parts is lost; what is connected is never
   compared again.
5. Alternating large-star / small-star joins the confirmed links.

Defined cases: null and empty texts have no shingles, are alone and kept;
fewer words than a shingle count as one shingle; repeated rows of an id are
one node; a null id is kept alone, with a null component; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.llm.common import pieces, saved, split_words, table, whole_text
from cohortlens.llm.components import connected_components

BANDS, MISS = 48, 1e-6
TILE, HUBS = 512, 8
SLACK = 5.0
_SEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: a bijection of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and their offsets by text."""
    codes, offsets, words = split_words(texts)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    stream = hashes[codes] if len(words) else np.zeros(0, np.uint64)
    counts = np.diff(offsets)
    n = np.where(counts >= size, counts - size + 1, 0)
    rolled = np.zeros(max(0, len(stream) - size + 1), np.uint64)
    for j in range(size):
        rolled = _mix(rolled * np.uint64(3) + stream[j:j + len(rolled)] + _SEP)
    doc = np.repeat(np.arange(len(counts)), n)
    starts = np.repeat(offsets[:-1] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    shingles = rolled[starts]
    short = np.flatnonzero((counts > 0) & (counts < size))     # the whole sequence is the one shingle
    if len(short):
        ones = []
        for d in short:
            x = np.zeros(1, np.uint64)
            for h in stream[offsets[d]:offsets[d + 1]]:
                x = _mix(x * np.uint64(5) + h + _SEP)
            ones.append(x[0])
        doc = np.concatenate([doc, short])
        shingles = np.concatenate([shingles, np.array(ones, np.uint64)])
    order = np.lexsort((shingles, doc))
    doc, shingles = doc[order], shingles[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (shingles[1:] != shingles[:-1])
    doc, shingles = doc[new], shingles[new]
    return shingles, np.searchsorted(doc, np.arange(len(counts) + 1))


def hash_family(count: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and shifts of multiply-shift universal hashing to 32 bits."""
    rng = np.random.default_rng(seed)
    top = np.iinfo(np.uint64).max
    return (rng.integers(0, top, count, np.uint64) | np.uint64(1)), rng.integers(0, top, count, np.uint64)


def rows_for(percent: int, bands: int = BANDS) -> int:
    """The most rows of a band at which a pair at the threshold is still found with probability 1 - MISS."""
    rows = 1
    while rows < 16 and (1 - (percent / 100) ** (rows + 1)) ** bands <= MISS:
        rows += 1
    return rows


def minima_of(x: np.ndarray, offsets: np.ndarray, mul: np.ndarray, add: np.ndarray,
              step: int = 1 << 16) -> np.ndarray:
    """Documents x hashes: the top 32 bits of the least hash of each document's (never empty) set."""
    docs = len(offsets) - 1
    out = np.empty((docs, len(mul)), np.uint32)
    a = 0
    while a < docs:
        z = max(a + 1, int(np.searchsorted(offsets, offsets[a] + step, side="right")) - 1)
        part, at = x[offsets[a]:offsets[z]], offsets[a:z] - offsets[a]
        h = np.empty_like(part)
        for k in range(len(mul)):
            np.multiply(part, mul[k], out=h)
            np.add(h, add[k], out=h)
            out[a:z, k] = np.minimum.reduceat(h, at) >> np.uint64(32)
        a = z
    return out


def _signatures(size: int, bands: int, rows: int):
    mul, add = hash_family(bands * rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 4 << 20):
            x, offsets = shingle_sets(batch.column("text"), size)
            n = np.diff(offsets)
            some = np.flatnonzero(n)
            minima = minima_of(x, np.append(offsets[some], offsets[-1]), mul, add)
            h = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(some), 1))
            for r in range(rows):
                h = _mix(h * np.uint64(3) + minima[:, r::rows] + _SEP)
            keys = h.view(np.int64)
            low = (minima & 0xFF).astype(np.uint8)
            key: list = [None] * len(n)
            band: list = [None] * len(n)
            sig: list = [None] * len(n)
            for j, d in enumerate(some):
                key[d] = xxhash.xxh3_128_digest(x[offsets[d]:offsets[d + 1]].tobytes())
                band[d], sig[d] = keys[j], low[j].tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(key, pa.binary()),
                 pa.array(band, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                names=["doc_id", "n_shingles", "set_key", "bands", "sig"])
    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 4 << 20):
            x, offsets = shingle_sets(batch.column("text"), size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([x[a:z].tobytes() for a, z in zip(offsets[:-1], offsets[1:])],
                                                  pa.binary())], names=["doc_id", "shingles"])
    return run


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, a: int) -> int:
        while self.up[a] != a:
            self.up[a] = self.up[self.up[a]]
            a = self.up[a]
        return a

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def link_tile(nodes: list[int], parts: list[int], sides: list[int], sigs: list[bytes], sets: list[bytes],
              percent: int) -> list[tuple[int, int]]:
    """Confirmed links that connect what is not connected yet.

    Compared are side 0 with side 0, side 0 with side 1 (hubs) and side 2 with
    side 3; nodes of equal ``parts`` (>= 0) count as connected.
    """
    n = len(nodes)
    sig = np.frombuffer(b"".join(sigs), np.uint8).reshape(n, -1)
    full = [np.frombuffer(s, np.uint64) for s in sets]
    size = np.array([len(s) for s in full], np.int64)
    side, part = np.array(sides), np.array(parts)
    forest, first = _Forest(n), {}
    for i, p in enumerate(parts):
        if p >= 0:
            forest.join(first.setdefault(p, i), i)
    width = sig.shape[1]
    s = percent / 100
    # One-byte minima agree by chance once in 256.
    need = s + (1 - s) / 256 - SLACK * np.sqrt(s * (1 - s) / width)
    wanted = []
    for i in range(n):
        if side[i] == 0:
            js = np.flatnonzero(((side == 0) & (np.arange(n) > i)) | (side == 1))
        elif side[i] == 2:
            js = np.flatnonzero(side == 3)
        else:
            continue
        js = js[(100 * np.minimum(size[js], size[i]) >= percent * np.maximum(size[js], size[i]))
                & ((part[js] != part[i]) | (part[i] < 0))]
        if len(js):
            same = (sig[js] == sig[i]).mean(1)
            wanted += [(-e, i, j) for j, e in zip(js[same >= need].tolist(), same[same >= need].tolist())]
    links = []
    for _, i, j in sorted(wanted):     # likeliest first: the rest is mostly connected by then
        if nodes[i] == nodes[j] or forest.root(i) == forest.root(j):
            continue
        both = len(np.intersect1d(full[i], full[j], assume_unique=True))
        if 100 * both >= percent * (size[i] + size[j] - both):
            links.append((nodes[i], nodes[j]))
            forest.join(i, j)
    return links


def _link(percent: int):
    def run(key, group):
        cols = group.to_pydict()
        links = link_tile(cols["node"], cols["part"], cols["side"], cols["sig"], cols["shingles"], percent)
        return pa.table({"u": pa.array([u for u, _ in links], pa.int64()),
                         "v": pa.array([v for _, v in links], pa.int64())})
    return run


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                    percent: int = 80, bands: int = BANDS, tile: int = TILE) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (null without shingles or id: alone)."""
    rows = rows_for(percent, bands)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    signed = saved(texts.mapInArrow(_signatures(size, bands, rows),
                                    "doc_id long, n_shingles long, set_key binary, bands array<long>, sig binary"),
                   "near-signatures")
    real = signed.filter("set_key IS NOT NULL AND doc_id IS NOT NULL")
    reps = real.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    # An id with several texts (repeated ids) stands for all of them.
    nodes = real.join(reps, (real["set_key"] == reps["set_key"]) & (F.col("doc_id") == F.col("rep"))) \
        .select(F.col("rep").alias("node"), "bands", "sig")
    keyed = nodes.select("node", F.explode("bands").alias("band"))
    hubs = keyed.groupBy("band").agg(F.min("node").alias("v"), F.max("node").alias("hi")).filter("v != hi")
    edges = keyed.join(hubs.select("band", "v"), "band").filter("node != v").select(F.col("node").alias("u"), "v")
    near = saved(connected_components(edges), "near-candidates")         # node, root
    candidate_sets = texts.join(near.select(F.col("node").alias("doc_id")), "doc_id", "left_semi") \
        .mapInArrow(_sets(size), "doc_id long, shingles binary")
    members = saved(nodes.select("node", "sig").dropDuplicates(["node"]).join(near, "node").join(
        candidate_sets.withColumnRenamed("doc_id", "node").dropDuplicates(["node"]), "node"), "near-members")
    sizes = near.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    tiles = sizes.select("root", F.expr(f"CAST(ceil(members / {tile}) AS INT)").alias("tiles"))
    dealt = members.join(tiles, "root").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    hub = _few_hubs(dealt.filter("tiles > 1"))
    cols = ["root", "tile", "node", "part", "side", "sig", "shingles"]
    first = dealt.select("root", "tile", "node", F.lit(-1).cast("long").alias("part"), F.lit(0).alias("side"), "sig",
                         "shingles").unionByName(
        hub.withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
            "root", "tile", "node", F.lit(-1).cast("long").alias("part"), F.lit(1).alias("side"), "sig", "shingles"))
    links = saved(first.select(cols).groupBy("root", "tile").applyInArrow(_link(percent), "u long, v long"),
                  "near-links")
    linked = saved(connected_components(links), "near-linked")
    # What is outside the largest linked part of a candidate component of several tiles meets all other tiles.
    big = dealt.filter("tiles > 1").join(linked.withColumnRenamed("root", "comp"), "node", "left") \
        .withColumn("part", F.coalesce("comp", "node")).drop("comp")
    parts = big.groupBy("root", "part").agg(F.count(F.lit(1)).alias("n"))
    main = parts.groupBy("root").agg(F.max(F.struct("n", "part")).alias("top"), F.count(F.lit(1)).alias("parts")) \
        .filter("parts > 1").select("root", F.col("top.part").alias("main"))
    minor = big.join(main, "root").filter("part != main")
    batches = minor.groupBy("root").agg(F.count(F.lit(1)).alias("minors")).select(
        "root", F.expr(f"CAST(ceil(minors / {tile}) AS INT)").alias("batches"))
    left = big.join(batches, "root").withColumn("batch", F.explode(F.sequence(F.lit(0), F.col("batches") - 1)))
    right = minor.drop("main").join(batches, "root").withColumn(
        "batch", F.pmod(F.xxhash64("node", F.lit(1)), F.col("batches")).cast("int")) \
        .drop("tile").withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    second = left.select("root", "tile", "batch", "node", "part", F.lit(2).alias("side"), "sig", "shingles").unionByName(
        right.select("root", "tile", "batch", "node", "part", F.lit(3).alias("side"), "sig", "shingles"))
    more = second.groupBy("root", "tile", "batch").applyInArrow(
        _link(percent), "u long, v long")
    more = saved(more, "near-links")
    if not more.isEmpty():
        linked = saved(connected_components(linked.select(F.col("node").alias("u"), F.col("root").alias("v"))
                                            .union(more)), "near-linked")
    by_set = reps.join(linked.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("set_key", F.coalesce("root", "rep").alias("component_id"))
    return signed.select("doc_id", "n_shingles", "set_key").join(by_set, "set_key", "left") \
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _few_hubs(members: DataFrame) -> DataFrame:
    """The HUBS nodes of the smallest hashes of each component, found in two steps (never all in one task)."""
    h = F.xxhash64("node", F.lit(3))
    local = W.partitionBy("root", "salt").orderBy("h", "node")
    top = members.select("root", "node", "sig", "shingles", "tiles", h.alias("h")) \
        .withColumn("salt", F.pmod(F.xxhash64("node"), F.col("tiles"))) \
        .withColumn("k", F.row_number().over(local)).filter(F.col("k") <= HUBS)
    return top.withColumn("k", F.row_number().over(W.partitionBy("root").orderBy("h", "node"))) \
        .filter(F.col("k") <= HUBS).drop("k", "h", "salt")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
               percent: int = 80) -> DataFrame:
    """The documents that stay (smallest id of each component), with all their columns."""
    gone = near_components(docs, id_col, text_col, size, percent).filter("doc_id != component_id") \
        .select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(gone, id_col, "left_anti")


def op8_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    out = near_components(table(spark, sf_dir, "documents"), size=3, percent=85)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
