"""Benchmark decontamination by greedy string tiling with running Karp-Rabin matching.

1. Words (letters and digits of white-space tokens, lower case) are hashed;
   every ``seed`` words in a row make a seed. A Bloom bitmap of the test
   items' seeds (its size is fixed by ``bloom_bits``) passes the few document
   seeds that can match.
2. Document seeds join item seeds on the hash. A tiling that covers the wanted
   part of an item has a least number of its seeds, so an item's most frequent
   seeds, fewer than that number, need not be joined: phrases that many items
   share create no candidates, and none is lost (prefix filter).
3. For each candidate pair the tiling repeatedly marks the longest matches that
   do not overlap what is marked, found by running Karp-Rabin hashes with a
   falling search length. Reordered passages are found as several tiles.
4. A document is contaminated by an item if tiles of at least ``seed`` words
   cover ``percent`` of the item's words. Items with fewer words than a seed
   hold no tile and match nothing.

Defined cases: null and empty texts and items match nothing; ties of longest
matches go to the first in the item, then the document; repeated rows give
one result; ids may be null (such rows are reported under null); empty tables
give no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import pieces, ragged, saved, split_words, table, whole_text

SEED = 5
PERCENT = 80
BLOOM_BITS = 24
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SIGNS = re.compile(r"[\W_]+")
_MOD = (1 << 61) - 1


def bare(word: str) -> str:
    """Letters and digits of a word in lower case."""
    low = word.lower()
    return low if low.isalnum() else _SIGNS.sub("", low)


def word_stream(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """63-bit hashes of the bare words of all texts in order (empty ones left out), and offsets by text."""
    codes, offsets, words = split_words(texts)
    forms = [bare(w) for w in words]
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(f) >> 1 for f in forms), np.uint64, len(forms))
    empty = np.fromiter((not f for f in forms), bool, len(forms))
    real = ~empty[codes] if len(words) else np.zeros(0, bool)
    offsets = np.concatenate([[0], np.cumsum(real)])[offsets]
    return hashes[codes[real]] if len(words) else np.zeros(0, np.uint64), offsets


def seeds_of(stream: np.ndarray, offsets: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, position, hash) of every seed."""
    counts = np.diff(offsets)
    n = np.where(counts >= seed, counts - seed + 1, 0)
    rolled = np.zeros(max(0, len(stream) - seed + 1), np.uint64)
    for j in range(seed):
        rolled = rolled * _BASE + stream[j:j + len(rolled)]
    at = ragged(offsets[:-1], n)
    text = np.repeat(np.arange(len(counts)), n)
    h = rolled[at]
    h ^= h >> np.uint64(32)
    return text, at - offsets[text], (h * _BASE) >> np.uint64(1)


def _bits(h: np.ndarray, bits: int) -> list[np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    return [(h & mask).astype(np.int64), ((h >> np.uint64(bits)) & mask).astype(np.int64)]


def _item_seeds(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            stream, offsets = word_stream(batch.column("text"))
            text, _, h = seeds_of(stream, offsets, seed)
            cut = np.searchsorted(text, np.arange(len(offsets)))
            words = [stream[a:z].tobytes() for a, z in zip(offsets[:-1], offsets[1:])]
            ids = batch.column("item_id")
            keys = [xxhash.xxh3_128_digest(repr(i).encode() + w) for i, w in zip(ids.to_pylist(), words)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), ids, pa.array(np.diff(offsets)), pa.array(words, pa.binary()),
                 pa.array([h[a:z].view(np.int64) for a, z in zip(cut[:-1], cut[1:])], pa.list_(pa.int64()))],
                names=["item", "item_id", "n_words", "item_words", "seeds"])
    return run


def _document_seeds(seed: int, bits: int, bitmap: bytes):
    seen = np.frombuffer(bitmap, np.uint64)

    def has(h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for b in _bits(h, bits):
            out &= (seen[b >> 6] >> (b & 63).astype(np.uint64)) & np.uint64(1) == 1
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            stream, offsets = word_stream(batch.column("text"))
            text, _, h = seeds_of(stream, offsets, seed)
            hit = np.flatnonzero(has(h))
            if not len(hit):
                continue
            text, h = text[hit], h[hit]
            docs = np.unique(text)
            ids = batch.column("doc_id").to_pylist()
            start, stop = np.searchsorted(text, docs), np.searchsorted(text, docs, side="right")
            words = [stream[offsets[d]:offsets[d + 1]].tobytes() for d in docs]
            # The key tells documents apart by id and words, so repeated rows are one.
            yield pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh3_128_digest(repr(ids[d]).encode() + w) for d, w in zip(docs, words)], pa.binary()),
                 pa.array([ids[d] for d in docs], pa.int64()), pa.array(words, pa.binary()),
                 pa.array([np.unique(h[a:z]).view(np.int64) for a, z in zip(start, stop)], pa.list_(pa.int64()))],
                names=["key", "doc_id", "words", "seeds"])
    return run


def _windows(words: list[int], marked: list[bool], s: int) -> Iterator[tuple[int, int]]:
    """(hash, position) of each stretch of ``s`` unmarked words, by a running hash."""
    h, run, top = 0, 0, pow(1_000_003, s, _MOD)
    for k, w in enumerate(words):
        if marked[k]:
            h = run = 0
            continue
        h = (h * 1_000_003 + w) % _MOD
        run += 1
        if run > s:
            h = (h - words[k - s] * top) % _MOD
        if run >= s:
            yield h, k - s + 1


def tile(item: list[int], doc: list[int], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (item position, document position, length) of tiles of ``least`` words or more."""
    im, dm = [False] * len(item), [False] * len(doc)
    tiles: list[tuple[int, int, int]] = []
    s = max(least, len(item))
    while True:
        table: dict[int, list[int]] = {}
        for h, p in _windows(item, im, s):
            table.setdefault(h, []).append(p)
        found: list[tuple[int, int, int]] = []
        longest = 0
        if table:
            for h, d in _windows(doc, dm, s):
                for p in table.get(h, ()):
                    if item[p:p + s] != doc[d:d + s]:
                        continue
                    n = s
                    while p + n < len(item) and d + n < len(doc) and not im[p + n] and not dm[d + n] \
                            and item[p + n] == doc[d + n]:
                        n += 1
                    longest = max(longest, n)
                    found.append((n, p, d))
        if longest > 2 * s:      # much longer ones exist: look for those first
            s = longest
            continue
        # Longest first; what a longer tile has cut leaves stretches that wait their turn at their own length.
        queue = [(-n, p, d) for n, p, d in found]
        heapq.heapify(queue)
        while queue:
            n, p, d = heapq.heappop(queue)
            n = -n
            free = [not (im[p + k] or dm[d + k]) for k in range(n)]
            if all(free):
                tiles.append((p, d, n))
                im[p:p + n] = dm[d:d + n] = [True] * n
                continue
            k = 0
            while k < n:
                z = k
                while z < n and free[z]:
                    z += 1
                if z - k >= s:
                    heapq.heappush(queue, (k - z, p + k, d + k))
                k = z + 1
        if s <= least:
            return tiles
        s = max(least, s // 2)


def _tiled(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "words"):
            cols = batch.to_pydict()
            covered, count = [], []
            for raw_item, raw_doc in zip(cols["item_words"], cols["words"]):
                item = np.frombuffer(raw_item, np.uint64)
                doc = np.frombuffer(raw_doc, np.uint64)
                # Only words in a shared stretch of ``seed`` words can be in a tile; others become gaps.
                near = np.isin(doc, item)
                ends = np.flatnonzero(np.convolve(near, np.ones(seed, np.int64), "valid") == seed)
                use = np.zeros(len(doc), bool)
                use[(ends[:, None] + np.arange(seed)).ravel()] = True
                edge = use | np.concatenate([[False], use[:-1]])
                short = np.where(use, doc, np.uint64(0))[edge].tolist()   # 0: a gap, no word hashes to an item's 0
                tiles = tile([w or -1 for w in item.tolist()], short, seed)
                covered.append(sum(n for _, _, n in tiles))
                count.append(len(tiles))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("item_id"), pa.array([len(w) // 8 for w in cols["item_words"]],
                                                                          pa.int64()),
                 pa.array(covered, pa.int64()), pa.array(count, pa.int64())],
                names=["doc_id", "item_id", "n_words", "covered", "tiles"])
    return run


def contaminations(docs: DataFrame, items: DataFrame, seed: int = SEED, percent: int = PERCENT,
                   bloom_bits: int = BLOOM_BITS) -> DataFrame:
    """doc_id, item_id, n_words (the item's), covered (words), tiles of every pair at or above the threshold."""
    tests = items.select(F.col("item_id").cast("long").alias("item_id"), whole_text("text").alias("text"))
    tested = saved(tests.mapInArrow(_item_seeds(seed), "item binary, item_id long, n_words long, item_words binary, "
                                    "seeds array<long>").dropDuplicates(["item"]), "tile-items")
    seeds = tested.select("item", "n_words", F.explode("seeds").alias("h"))
    # The bitmap: 2**bloom_bits bits, whatever the number of items.
    mask = (1 << bloom_bits) - 1
    spots = seeds.select(F.explode(F.array(F.col("h").bitwiseAND(mask),
                                           F.shiftright("h", bloom_bits).bitwiseAND(mask))).alias("b"))
    filled = spots.groupBy(F.shiftright("b", 6).alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(b & 63 AS INT)))").alias("bits")).collect()
    bitmap = np.zeros(1 << (bloom_bits - 6), np.int64)
    for r in filled:
        bitmap[r["w"]] = r["bits"]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text("text").alias("text"))
    hits = saved(texts.mapInArrow(_document_seeds(seed, bloom_bits, bitmap.tobytes()),
                                  "key binary, doc_id long, words binary, seeds array<long>"), "tile-hits")
    # Prefix filter: tiles that cover the wanted words hold at least ``need`` of an item's seeds, so its need - 1 most
    # frequent ones can be left out of the join.
    often = seeds.groupBy("h").agg(F.count_distinct("item").alias("items"))
    need = F.ceil(F.col("n_words") * percent / (100 * seed))
    rare = seeds.join(often, "h").groupBy("item", "n_words").agg(
        F.sort_array(F.collect_list(F.struct("items", "h"))).alias("hs")).withColumn("need", need) \
        .select("item", F.explode(F.expr("slice(hs.h, 1, CAST(greatest(1, size(hs) - need + 1) AS INT))")).alias("h")) \
        .distinct()
    pairs = hits.select("key", F.explode("seeds").alias("h")).join(rare, "h").select("key", "item").distinct()
    full = pairs.join(hits.select("key", "doc_id", "words").dropDuplicates(["key"]), "key") \
        .join(tested.select("item", "item_id", "item_words"), "item")
    tiled = full.select("doc_id", "item_id", "item_words", "words").mapInArrow(
        _tiled(seed), "doc_id long, item_id long, n_words long, covered long, tiles long")
    return tiled.filter(F.col("covered") * 100 >= F.col("n_words") * percent).filter("n_words > 0") \
        .groupBy("doc_id", "item_id").agg(F.max("n_words").alias("n_words"), F.max("covered").alias("covered"),
                                          F.max("tiles").alias("tiles"))


def decontaminate(docs: DataFrame, items: DataFrame, seed: int = SEED, percent: int = PERCENT) -> DataFrame:
    """The documents that no item contaminates, with all their columns.

    Documents go by their ids (all that share one go, if one is hit); a
    document without an id goes by a hash of its text, 2 ** 62 and above.
    """
    own = F.xxhash64(whole_text("text")).bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    named = docs.withColumn("_named", F.coalesce(F.col("doc_id").cast("long"), own))
    found = contaminations(named.select(F.col("_named").alias("doc_id"), "text"), items, seed, percent)
    hit = saved(found.select(F.col("doc_id").alias("_named")).distinct(), "tile-docs")
    return named.join(hit, "_named", "left_anti").select(*docs.columns)


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
