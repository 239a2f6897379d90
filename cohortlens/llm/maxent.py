"""Hashed maximum-entropy language model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class, history), each factor
softmaxes over hashed features of the two words before (n-gram: the last word,
and in the class factor the last two together; skip: the one before the last).
A word of a context is its own hash, whatever its frequency.

Classes: the most frequent training tokens form classes of ``SLOTS`` words
each, by frequency rank; every other word is in one of ``TAILS`` classes by a
hash of its last two letters (a final full stop or comma aside). In a head
class the word is a second softmax. A tail class is cut by the bits of the
word's hash, ``SLOTS`` ways a level, each level a softmax of the history, down
to leaves of about ``SLOTS`` words; in its leaf a word has the smoothed share
(c + 0.5) / (N + 0.5 (V + 1)) of the leaf's training tokens, where unknown
words of the leaf share one event, so all events of a step sum to 1.

The head, the feature rows and the levels grow with the distinct training
tokens V: 34 V^(1/4) head words (each class costs every token a number), 8 sqrt(V)
rows a class feature (four times as many a word feature), V / SLOTS leaves, and
the floors below.

The weights start at the training shares. Training is distributed: each task runs AdaGrad steps over minibatches of its
documents, starting from the common weights; the tasks' weights are averaged
row by row, weighted by how often a task used the row. ``ROUNDS`` rounds see
disjoint parts that together are all training documents. Tasks return the
changes of their rows, in 255 steps of a row's largest one.

Scoring joins exact training counts without shipping the vocabulary to
everyone: documents are dealt to chunks, each chunk's distinct words meet the
count table in one join, and chunk and counts are cogrouped.

Defined cases: null and empty texts are one end token; repeated rows are
counted and scored each; without training rows the model is uniform; a null id
is trained on like any id whose remainder is not the held-out one; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import pieces, saved, split_words, table, whole_text

HEAD, SLOTS, TAILS, LEAST_BITS = 1024, 32, 32, 12
CLASSES = HEAD // SLOTS + TAILS
START = 0                                   # the context symbol of the text's start
ROUNDS = 2
RATE = 0.25
BATCH = 8192
SEGMENTS = 64
AT_ONCE = 24
FEW = 64
LEAST_TASKS = 8
TEXT_A_WEIGHT = 1.5
CHUNK_BYTES = 24 << 20
PIECE = 4 << 20
END = -1                                    # the end token: hashes of words are never negative

#: Rows of the two weight tables, at least: bias, last word, skip word, last two words; bias and both words by class.
ROWS1 = 1 + (3 << LEAST_BITS)
ROWS2 = HEAD // SLOTS + (2 << LEAST_BITS + 2)


@dataclass
class Shape:
    """What the weights refer to: head words by rank and statistics of the tail classes and their leaves."""
    head: dict[int, int]        # hash -> rank
    head_n: np.ndarray          # training tokens of each head word
    tail_n: np.ndarray          # training tokens of each tail class
    tail_v: np.ndarray          # distinct training tokens of each tail class
    bits: int = 0               # bits of the word's hash that cut a tail class into leaves
    leaf_n: np.ndarray | None = None    # the statistics by leaf, if there are bits
    leaf_v: np.ndarray | None = None
    row_bits: int = LEAST_BITS  # 2 ** row_bits rows a class feature

    @property
    def heads(self) -> int:
        return len(self.head_n) // SLOTS

    @property
    def classes(self) -> int:
        return self.heads + TAILS

    def mass(self) -> np.ndarray:
        """Smoothed training tokens of each leaf."""
        n, v = (self.leaf_n, self.leaf_v) if self.bits else (self.tail_n, self.tail_v)
        return n + 0.5 * (v + 1)

    def levels(self) -> list[tuple[int, int]]:
        """First bit and number of bits of each level."""
        width = SLOTS.bit_length() - 1
        return [(k, min(width, self.bits - k)) for k in range(0, self.bits, width)]

    def offsets(self) -> list[np.ndarray]:
        """By level: log of the training mass of each node's children (missing ones can't be met)."""
        out = []
        for first, bits in self.levels():
            sums = self.mass().reshape(TAILS << first, 1 << bits, -1).sum(2)
            table = np.full((len(sums), SLOTS), -1e4, np.float32)
            table[:, :1 << bits] = np.log(sums / sums.sum(1, keepdims=True))
            out.append(table)
        return out

    def paths(self, h: np.ndarray, cls: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """Of words of tail classes: node and child at each level, and the leaf."""
        at, out = np.maximum(cls - self.heads, 0), []
        for first, bits in self.levels():
            child = h >> first & (1 << bits) - 1
            out.append((at, child))
            at = at << bits | child
        return out, at


def suffix(word: str) -> str:
    return word.rstrip(".,")[-2:]


def suffix_hash(word: str, _known: dict[str, int] = {}) -> int:
    """Hash of the last two letters; the table of suffixes is emptied when it has a million."""
    s = suffix(word)
    h = _known.get(s)
    if h is None:
        if len(_known) > 1 << 20:
            _known.clear()
        h = _known[s] = xxhash.xxh3_64_intdigest(s)
    return h


def hash_words(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) >> 1 for w in words), np.int64, len(words))


def _stream(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Codes of all tokens with each text's end token (code: number of words), and offsets."""
    codes, offsets, words = split_words(texts)
    docs = len(offsets) - 1
    out = np.full(len(codes) + docs, len(words), np.int64)
    out[np.arange(len(codes)) + np.repeat(np.arange(docs), np.diff(offsets))] = codes
    return out, offsets + np.arange(docs + 1), words


def count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """h, tail class, n of the tokens of each piece."""
    for batch in pieces(batches, "text", PIECE):
        codes, _, words = _stream(batch.column("text"))
        n = np.bincount(codes, minlength=len(words) + 1)
        h = np.append(hash_words(words), END)
        tail = np.fromiter(((suffix_hash(w) & 0xFFFFFF) % TAILS for w in words), np.int64, len(words))
        real = n > 0
        yield pa.RecordBatch.from_arrays([pa.array(h[real]), pa.array(np.append(tail, 0).astype(np.int32)[real]),
                                          pa.array(n[real])], names=["h", "tail", "n"])


def _events(texts: pa.Array, shape: Shape):
    """Per token: class, slot in a head class (-1 in a tail class), hashes of the context words; and the words' hashes."""
    codes, offsets, words = _stream(texts)
    h = np.append(hash_words(words), END)
    rank = np.fromiter((shape.head.get(x, -1) for x in h.tolist()), np.int64, len(h))
    ends = np.fromiter((suffix_hash(w) & 0xFFFFFF for w in words), np.int64, len(words))
    ends = np.append(ends, 0)
    tail = rank < 0
    cls = np.where(tail, shape.heads + ends % TAILS, rank // SLOTS)
    slot = np.where(tail, -1, rank % SLOTS)
    start = np.zeros(len(codes), bool)
    start[offsets[:-1]] = True
    symbols = h[codes]
    u1 = np.concatenate([[START], symbols[:-1]])
    u1[start] = START
    u2 = np.concatenate([[START], u1[:-1]])
    u2[start] = START
    return codes, offsets, h, cls, slot, u1, u2


def _row(x: np.ndarray, bits: int) -> np.ndarray:
    """A row of 2 ** bits by hash."""
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return (x >> np.uint64(64 - bits)).astype(np.int64)


def _features1(u1: np.ndarray, u2: np.ndarray, bits: int = LEAST_BITS) -> list[np.ndarray]:
    a, b = u1.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), u2.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return [1 + _row(a, bits), 1 + (1 << bits) + _row(b, bits), 1 + (2 << bits) + _row(a + b, bits)]


def _features2(cls: np.ndarray, u1: np.ndarray, u2: np.ndarray, heads: int = HEAD // SLOTS,
               bits: int = LEAST_BITS) -> list[np.ndarray]:
    """Rows of the class's bias and of both words by class; nodes of the tail have numbers from ``heads`` on, no bias."""
    c = (cls.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95)
    a, b = u1.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), u2.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return [cls, heads + _row(a ^ c, bits + 2), heads + (4 << bits) + _row(b ^ c, bits + 2)]


def _word_steps(shape: Shape, paths, offsets, codes, cls, slot, u1, u2):
    """The word factor of a minibatch, softmax by softmax: tokens, rows, the child met, fixed offsets."""
    of_token = slot[codes]
    head = np.flatnonzero(of_token >= 0)
    if len(head):
        yield head, _features2(cls[codes[head]], u1[head], u2[head], shape.heads, shape.row_bits), of_token[head], None
    tail = np.flatnonzero(of_token < 0)
    first = shape.heads
    for (node, child), table in zip(paths, offsets):
        if len(tail):
            at = node[codes[tail]]
            yield (tail, _features2(first + at, u1[tail], u2[tail], shape.heads, shape.row_bits)[1:],
                   child[codes[tail]], table.take(at, axis=0))
        first += len(table)


def _contexts(u1: np.ndarray, u2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens sorted by their two words before (in order of a hash), and where each distinct context starts, and the end."""
    key = u1.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + u2.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    order = np.argsort(key ^ key >> np.uint64(29))
    a, b = u1[order], u2[order]
    new = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
    return order, np.concatenate([[0], new, [len(order)]]) if len(order) else np.zeros(1, np.int64)


def _by_context(u1: np.ndarray, u2: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Minibatches of ``BATCH`` distinct contexts: tokens, the context of each, and a token of each context."""
    order, starts = _contexts(u1, u2)
    for k in range(0, len(starts) - 1, BATCH):
        at = starts[k:k + BATCH + 1]
        yield order[at[0]:at[-1]], np.repeat(np.arange(len(at) - 1), np.diff(at)), order[at[:-1]]


def _met(offset: np.ndarray | None) -> int:
    """Children that a softmax can meet: all slots of a head class, of a level those that its bits number."""
    return SLOTS if offset is None else int((offset[0] > -1e3).sum())


def _narrowed(weights: np.ndarray, rows: list[np.ndarray], width: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The first ``width`` numbers of the rows, as rows of a view (widths are powers of two)."""
    times = weights.shape[1] // width
    return (weights, rows) if times == 1 else (weights.reshape(-1, width), [r * times for r in rows])


def _logits(weights: np.ndarray, rows: list[np.ndarray], bias: np.ndarray | None = None) -> np.ndarray:
    z = weights.take(rows[0], axis=0)
    for r in rows[1:]:
        z += weights.take(r, axis=0)
    if bias is not None:
        z += bias
    z -= z.max(1, keepdims=True)
    return z


def _summed(z: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows, how often each comes, and the sums of their ``z``: the n-th ones of all rows are added at once.

    Row numbers that fit 16 bits sort by radix.
    """
    low = rows - rows.min()
    order = np.argsort(low.astype(np.uint16) if low.max() < 1 << 16 else low, kind="stable")
    sorted_rows = rows[order]
    at = np.flatnonzero(np.concatenate([[True], sorted_rows[1:] != sorted_rows[:-1]]))
    n = np.diff(at, append=len(rows))
    most = np.argsort(-n, kind="stable")
    at, n = at[most], n[most]
    g = z.take(order[at], axis=0)
    many = int(np.searchsorted(-n, -AT_ONCE))       # rows that come more often
    for k in range(many):
        z.take(order[at[k]:at[k] + n[k]], axis=0).sum(0, out=g[k])
    for j in range(1, AT_ONCE):
        stop = int(np.searchsorted(-n, -j))
        if stop <= many:
            break
        g[many:stop] += z.take(order[at[many:stop] + j], axis=0)
    return sorted_rows[at], n, g


def _step(weights: np.ndarray, seen: np.ndarray, used: np.ndarray, rows: list[np.ndarray], target: np.ndarray,
          bias_row: int | None = None, offset: np.ndarray | None = None) -> None:
    """One AdaGrad step of a softmax on a minibatch."""
    full = weights.shape[1]
    width = full if bias_row is not None else _met(offset)
    seen = seen.reshape(-1, width)
    weights, rows = _narrowed(weights, rows, width)
    z = _logits(weights, rows, weights[bias_row] if bias_row is not None else None if offset is None else offset[:, :width])
    np.exp(z, out=z)
    z /= z.sum(1, keepdims=True)
    z[np.arange(len(target)), target] -= 1
    for r in rows:
        k, times, g = _summed(z, r)
        n = seen.take(k, axis=0)
        n += g * g
        seen[k] = n
        np.sqrt(n, out=n)
        g *= RATE
        g /= n
        weights[k] -= g
        used[k // (full // width)] += times
    if bias_row is not None:
        g = z.sum(0)
        seen[bias_row] += g * g
        weights[bias_row] -= RATE * g / np.sqrt(seen[bias_row])
        used[bias_row] += len(target)


def _half(weights: np.ndarray) -> np.ndarray:
    """The float32 numbers rounded to their upper halves."""
    return (weights.astype(np.float32).view(np.uint32) + np.uint32(0x8000) & np.uint32(0xFFFF0000)).view(np.float32)


def _packed(change: np.ndarray) -> bytes:
    """Changes of rows in 255 steps of each row's largest, deflated."""
    top = np.maximum(np.abs(change).max(1), 1e-30).astype(np.float32)
    steps = np.rint(change * (127 / top)[:, None]).astype(np.int8)
    return top.tobytes() + pa.compress(steps.tobytes(), "zstd", asbytes=True)


def _unpacked(raw: bytes, rows: int, width: int) -> np.ndarray:
    top = np.frombuffer(raw, np.float32, rows)
    steps = np.frombuffer(pa.decompress(memoryview(raw)[4 * rows:], rows * width, "zstd"), np.int8)
    return steps.reshape(rows, width) * (top / np.float32(127))[:, None]


def _part(segment: int, rows: np.ndarray, used: np.ndarray, change: np.ndarray) -> list[pa.Array]:
    """Columns of ``_PART``: one segment's used rows, how often they were used, and their changes."""
    return [pa.array([segment], pa.int32()), pa.array([rows.astype(np.int32).tobytes()], pa.binary()),
            pa.array([used.astype(np.float32).tobytes()], pa.binary()), pa.array([_packed(change)], pa.binary())]


def _shipped(weights: np.ndarray) -> tuple[tuple[int, ...], bytes]:
    """Weights for the tasks: deflated byte by byte of the numbers, without loss (every executor keeps them on disk)."""
    return weights.shape, zlib.compress(np.ascontiguousarray(weights.view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _landed(shape: tuple[int, ...], raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.float32).reshape(shape)


def _train(shape: Shape, w1: np.ndarray, w2: np.ndarray):
    sent = _shipped(w1), _shipped(w2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = (_landed(*x) for x in sent)
        seen1, seen2 = np.full(a.shape, 1.0, np.float32), np.full(b.shape, 1.0, np.float32)
        used1, used2 = np.zeros(len(a)), np.zeros(len(b))
        offsets = shape.offsets()
        for batch in pieces(batches, "text", PIECE):
            codes, _, h, cls, slot, u1, u2 = _events(batch.column("text"), shape)
            paths, _ = shape.paths(h, cls)
            for k in range(0, len(codes), BATCH):
                s = slice(k, k + BATCH)
                _step(a, seen1, used1, _features1(u1[s], u2[s], shape.row_bits), cls[codes[s]], 0)
                for _, rows, met, offset in _word_steps(shape, paths, offsets, codes[s], cls, slot, u1[s], u2[s]):
                    _step(b, seen2, used2, rows, met, None, offset)
        del seen1, seen2
        for t, (w, used, x) in enumerate(((a, used1, sent[0]), (b, used2, sent[1]))):
            before = _landed(*x)
            for seg, rows in enumerate(np.array_split(np.arange(len(w)), SEGMENTS)):
                hit = rows[used[rows] > 0]
                if len(hit):
                    yield pa.RecordBatch.from_arrays(_part(t * SEGMENTS + seg, hit, used[hit], w[hit] - before[hit]),
                                                     names=_PART_NAMES)
    return run


def _average(classes: int):
    """Weighted mean of the rows' changes of one segment over tasks."""
    def run(key, group):
        cols = group.to_pydict()
        width = classes if cols["seg"][0] < SEGMENTS else SLOTS
        rows = [np.frombuffer(r, np.int32) for r in cols["rows"]]
        ids = np.unique(np.concatenate(rows))
        n, out = np.zeros(len(ids)), np.zeros((len(ids), width), np.float32)
        for r, u, w in zip(rows, cols["used"], cols["weights"]):
            at, used = np.searchsorted(ids, r), np.frombuffer(u, np.float32)
            n[at] += used                           # a part has each row once
            out[at] += _unpacked(w, len(r), width) * used[:, None]
        out /= n[:, None].astype(np.float32)
        return pa.table(_part(cols["seg"][0], ids, n, out), names=_PART_NAMES)
    return run


_PART = "seg int, rows binary, used binary, weights binary"
_PART_NAMES = ["seg", "rows", "used", "weights"]


def count_table(train: DataFrame) -> DataFrame:
    """h, tail, n of every training token (``train``: column text)."""
    return saved(train.select("text").mapInArrow(count_tokens, "h long, tail int, n long").groupBy("h").agg(
        F.min("tail").alias("tail"), F.sum("n").alias("n")), "lm-counts")


def shape_of(counts: DataFrame, kinds: int) -> Shape:
    """The model's sizes follow ``kinds``, the distinct training tokens."""
    size = SLOTS * max(HEAD // SLOTS, math.ceil(34 * kinds ** 0.25 / SLOTS))
    top = counts.orderBy(F.desc("n"), "h").limit(size).collect()
    head = {r["h"]: k for k, r in enumerate(top)}
    head_n = np.zeros(size)
    head_n[:len(top)] = [r["n"] for r in top]
    bits = max(SLOTS.bit_length() - 1, math.ceil(math.log2(max(1, kinds) / (TAILS * SLOTS))))
    row_bits = max(LEAST_BITS, math.ceil(math.log2(8 * math.sqrt(max(1, kinds)))))
    leaves = TAILS << bits
    shape = Shape(head, head_n, np.zeros(TAILS), np.zeros(TAILS), bits, np.zeros(leaves), np.zeros(leaves), row_bits)
    leaf = F.col("tail").cast("long")
    for first, width in shape.levels():
        leaf = leaf * (1 << width) + F.shiftright("h", first).bitwiseAND(F.lit((1 << width) - 1))
    listed = counts.sparkSession.createDataFrame([(h,) for h in head], "h long")
    for r in counts.join(F.broadcast(listed), "h", "left_anti").groupBy(leaf.alias("leaf")).agg(
            F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        shape.leaf_n[r["leaf"]], shape.leaf_v[r["leaf"]] = r["n"], r["v"]
    shape.tail_n = shape.leaf_n.reshape(TAILS, -1).sum(1)
    shape.tail_v = shape.leaf_v.reshape(TAILS, -1).sum(1)
    return shape


def first_weights(shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Weights under which both factors are the training shares, whatever the history."""
    w1 = np.zeros((1 + (3 << shape.row_bits), shape.classes), np.float32)
    w2 = np.zeros((shape.heads + (2 << shape.row_bits + 2), SLOTS), np.float32)
    words = shape.head_n.reshape(-1, SLOTS)
    mass = np.concatenate([words.sum(1), shape.mass().reshape(TAILS, -1).sum(1)])
    w1[0] = np.log(np.maximum(mass, 1e-3) / mass.sum())
    w2[:len(words)] = np.log(np.maximum(words, 1e-3) / np.maximum(words.sum(1, keepdims=True), 1e-3))
    return w1, w2


def train_model(train: DataFrame, shape: Shape, text_bytes: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the class and the word softmax; ``text_bytes``: of all training texts, if known.

    A task returns up to the whole model's changes, so it gets ``TEXT_A_WEIGHT`` bytes of text for each weight
    (and there are ``LEAST_TASKS`` at least): what the tasks return goes with the texts.
    """
    w1, w2 = first_weights(shape)
    if text_bytes is None:
        text_bytes = train.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(LEAST_TASKS, int(text_bytes / (TEXT_A_WEIGHT * (w1.size + w2.size))))
    for part in range(ROUNDS):
        docs = train.filter(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == part).select("text").coalesce(tasks)
        got = docs.mapInArrow(_train(shape, w1, w2), _PART)
        if tasks > FEW:         # two levels, so that no group holds the weights of all tasks
            got = got.withColumn("few", (F.spark_partition_id() / F.lit(FEW)).cast("int")).groupBy("seg", "few") \
                .applyInArrow(_average(shape.classes), _PART)
        for r in got.groupBy("seg").applyInArrow(_average(shape.classes), _PART).collect():
            rows = np.frombuffer(r["rows"], np.int32)
            w = w1 if r["seg"] < SEGMENTS else w2
            w[rows] = _half(w[rows] + _unpacked(r["weights"], len(rows), w.shape[1]))
    return w1, w2


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """chunk, h: the distinct words of each chunk in each batch, and the end token."""
    for batch in pieces(batches, "text", PIECE):
        chunk = batch.column("chunk")
        for c in pc.unique(chunk).to_pylist():
            texts = batch.column("text").filter(pc.equal(chunk, c))
            words = split_words(texts)[2]
            h = np.append(hash_words(words), END)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), c, np.int64)), pa.array(h)], names=["chunk", "h"])


def _score(shape: Shape, w1: np.ndarray, w2: np.ndarray, total: int, kinds: int):
    floor = np.log10(total + 0.5 * (kinds + 1))
    sent = _shipped(w1), _shipped(w2)
    held: list[np.ndarray] = []          # in the task: unpacked once, for all its chunks

    def run(docs, found):
        if not held:
            held.extend((*(_landed(*x) for x in sent), np.log10(shape.mass()), *shape.offsets()))
        w1, w2, leaf_log, *offsets = held
        h_known = found.column("h").combine_chunks().to_numpy(zero_copy_only=False) if found.num_rows else np.zeros(0, np.int64)
        n_known = found.column("n").combine_chunks().to_numpy(zero_copy_only=False) if found.num_rows else np.zeros(0, np.int64)
        order = np.argsort(h_known, kind="stable")
        h_known, n_known = h_known[order], n_known[order]
        parts = []
        for batch in pieces(iter(docs.combine_chunks().to_batches()), "text", PIECE):
            codes, starts, h, cls, slot, u1, u2 = _events(batch.column("text"), shape)
            at = np.searchsorted(h_known, h)
            at[at == len(h_known)] = 0
            c = np.where(h_known[at] == h, n_known[at], 0) if len(h_known) else np.zeros(len(h), np.int64)
            base = np.log10(c + 0.5) - floor
            paths, leaf = shape.paths(h, cls)
            inside = np.where(slot < 0, np.log10(c + 0.5) - leaf_log[leaf], 0.0)
            logp = inside[codes]
            for s, owner, one in _by_context(u1, u2):
                z = _logits(w1, _features1(u1[one], u2[one], shape.row_bits), w1[0])
                at_met = z[owner, cls[codes[s]]]
                np.exp(z, out=z)
                logp[s] += (at_met - np.log(z.sum(1))[owner]) / np.log(10)
                for at, rows, met, offset in _word_steps(shape, paths, offsets, codes[s], cls, slot, u1[s], u2[s]):
                    width = _met(offset)
                    z = _logits(*_narrowed(w2, rows, width), None if offset is None else offset[:, :width])
                    at_met = z[np.arange(len(at)), met]
                    np.exp(z, out=z)
                    logp[s[at]] += (at_met - np.log(z.sum(1))) / np.log(10)
            first = starts[:-1]
            parts.append(pa.table({
                "doc_id": batch.column("doc_id"), "n_tokens": pa.array(np.diff(starts)),
                "n_known": pa.array(np.add.reduceat((c > 0).astype(np.int64)[codes], first)),
                "base_score": pa.array(np.add.reduceat(base[codes], first)),
                "score": pa.array(np.add.reduceat(logp, first))}))
        return pa.concat_tables(parts) if parts else pa.table(
            {"doc_id": pa.array([], pa.int64()), "n_tokens": pa.array([], pa.int64()),
             "n_known": pa.array([], pa.int64()), "base_score": pa.array([], pa.float64()),
             "score": pa.array([], pa.float64())})
    return run


def lm_scores(docs: DataFrame, learn_from, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row; ``learn_from``: condition on doc_id."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    train = texts.filter(learn_from)
    counts = count_table(train)
    sums = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    total, kinds = int(sums[0] or 0), int(sums[1])
    shape = shape_of(counts, kinds)
    w1, w2 = train_model(train, shape)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-int(size) // CHUNK_BYTES))
    dealt = texts.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks))) \
        .repartition(max(chunks, 1), "chunk")
    found = dealt.mapInArrow(_distinct, "chunk long, h long").join(counts.select("h", "n"), "h") \
        .select("chunk", "h", "n")
    scored = dealt.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(
        _score(shape, w1, w2, total, kinds), "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return scored.withColumn("train_tokens", F.lit(total).cast("long"))


def held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 1, F.lit(False))


def op3_lm_scoring(spark, sf_dir: str) -> DataFrame:
    out = lm_scores(table(spark, sf_dir, "documents"), ~held_out())
    return out.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
