"""Mixing sources to target weights: iterative proportional fitting, then sampling by calibrated probabilities.

Documents are counted into cells (source, language, topic) with their tokens
(white-space words). Raking multiplies the cells' token weights in turn to the
target share of every source, language and topic until all marginals agree or
it is proven that no weights meet all targets (empty cells can keep them from
it): a warning then gives the largest error left. The proof is Farkas' lemma
with the logarithms of a round's factors: weights that met the targets would
bring the targets' mean of them to at most the largest sum in any cell.
Targets that can be met only with cells of no weight get close without end:
raking gives up after ``LOOKS`` looks, also with a warning.
A document's weight is its cell's raked weight over its cell's tokens; the
sampling probability is min(1, scale * weight) with the one scale that makes
the expected tokens the wanted part of all tokens. A document is taken if a
uniform number made from a hash of its id is below its probability.

The targets are the observed token shares to the power ``temper`` (1: as they
are, 0: uniform), brought to sum 1; or tables given by the caller.

The topic of a document, where the caller has no topic column, comes from its
words by spherical k-means: words are hashed to ``BUCKETS`` buckets, weighed by
(1 + ln count) * idf with document counts over all rows, and folded by a signed
hash to ``WIDTH`` small integers. The first ``TOPICS`` distinct vectors by MD5 start
the centroids, ``TOPIC_ROUNDS`` rounds move them; every row is read in every round.
Sums and products are whole numbers, so topics depend on the rows alone, not
on how they are dealt. What is collected has a size fixed by these parameters.

Cells are few beside documents, however uneven the sources are; they are
handled as a table all the same, and only sums come to the driver.

Defined cases: null text counts as empty (0 tokens, weight kept, the empty
string as topic, as for all texts without words); equal distances go to the
smaller topic; with fewer distinct vectors there are fewer topics; null source, language or topic counts as the empty string;
repeated rows count each and share one decision, and so do all documents
without an id (one random number for an id); an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.llm.common import pieces, saved, split_words, table, whole_text

DIMS = ("source", "lang", "topic")
TOPICS = 8
BUCKETS = 1 << 14
WIDTH = 64
LENGTH = 127            # of a topic vector, whose components are rounded to whole numbers
SCALE = 1 << 15         # length of a centroid, rounded too
TOPIC_ROUNDS = 8
TEMPER = 0.7
KEEP = 0.6
ROUNDS = 4          # raking rounds between two looks at the marginals
LOOKS = 250
TOLERANCE = 1e-6


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds tokens and bag in place of the text: pairs of 16 bits, bucket and 16 * (1 + ln count)."""
    for batch in pieces(batches, "text"):
        codes, offsets, words = split_words(batch.column("text"))
        bucket = np.fromiter((xxhash.xxh3_64_intdigest(w) % BUCKETS for w in words), np.int64, len(words))
        tokens = np.diff(offsets)
        key, n = np.unique(np.repeat(np.arange(len(tokens)) * BUCKETS, tokens) + bucket[codes], return_counts=True)
        pairs = np.stack([key % BUCKETS, np.rint(16 + 16 * np.log(n))], 1).astype(np.uint16)
        ends = np.concatenate([[0], np.cumsum(np.bincount(key // BUCKETS, minlength=len(tokens)))]).astype(np.int32)
        bag = pa.Array.from_buffers(pa.binary(), len(tokens), [None, pa.py_buffer(4 * ends), pa.py_buffer(pairs.tobytes())])
        kept = [batch.column(c) for c in ("doc_id", "source", "lang")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(tokens), bag], names=["doc_id", "source", "lang", "tokens", "bag"])


def _pairs(bags: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and weight of all pairs."""
    pairs = np.frombuffer(b"".join(bags.to_pylist()), np.uint16).reshape(-1, 2)
    row = np.repeat(np.arange(len(bags)), pc.binary_length(bags).to_numpy(zero_copy_only=False) // 4)
    return row, pairs[:, 0], pairs[:, 1]


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros(BUCKETS, np.int64)
    for batch in pieces(batches, "bag"):
        n += np.bincount(_pairs(batch.column("bag"))[1], minlength=BUCKETS)
    met = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(n[met])], names=["bucket", "n"])


def _vectors(idf: np.ndarray):
    """Adds vec in place of the bag: WIDTH signed bytes."""
    mixed = np.arange(BUCKETS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
    spot, sign = (mixed % np.uint64(WIDTH)).astype(np.int64), 1.0 - 2.0 * ((mixed >> np.uint64(16)) & np.uint64(1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "bag"):
            row, bucket, weight = _pairs(batch.column("bag"))
            v = np.bincount(row * WIDTH + spot[bucket], weight * (idf * sign)[bucket], batch.num_rows * WIDTH)
            v = v.reshape(-1, WIDTH).astype(np.float64)      # whole numbers if there are no pairs
            v *= LENGTH / np.maximum(np.sqrt((v * v).sum(1, keepdims=True)), 1e-9)
            raw = np.rint(v).astype(np.int8).tobytes()
            vec = pa.Array.from_buffers(pa.binary(), len(v), [
                None, pa.py_buffer(np.arange(0, len(raw) + 1, WIDTH, dtype=np.int32)), pa.py_buffer(raw)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], vec], names=["doc_id", "source", "lang", "tokens", "vec"])
    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int8).reshape(-1, WIDTH)


def _first(topics: int):
    """The task's first distinct vectors by MD5; those of texts without words aside."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[bytes, bytes] = {}
        for batch in batches:
            for v in pc.unique(batch.column("vec")).to_pylist():
                if any(v):
                    best[hashlib.md5(v).digest()] = v
            best = dict(sorted(best.items())[:topics])
        yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.binary()), pa.array(list(best.values()), pa.binary())],
                                         names=["h", "vec"])
    return run


def _nearest(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Products of whole numbers below 2 ** 53: exact in any order."""
    return np.argmax(vectors.astype(np.float64) @ centroids.T, axis=1)


def _topic_sums(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(centroids.shape, np.int64)
        for batch in batches:
            v = _matrix(batch.column("vec"))
            at = _nearest(v, centroids)
            for k in range(len(centroids)):
                sums[k] += v[at == k].sum(0, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(sums.size)), pa.array(sums.ravel())], names=["at", "n"])
    return run


def topic_centroids(vectors: DataFrame, topics: int = TOPICS) -> np.ndarray:
    """Spherical k-means over the column ``vec``: topics x WIDTH whole numbers (fewer rows if there are fewer vectors)."""
    vec = vectors.select("vec")
    seeds = vec.mapInArrow(_first(topics), "h binary, vec binary").distinct().orderBy("h").limit(topics).collect()
    centroids = np.array([np.frombuffer(r["vec"], np.int8) for r in seeds], np.float64).reshape(-1, WIDTH)
    for _ in range(TOPIC_ROUNDS if len(centroids) else 0):
        sums = np.zeros(centroids.size)
        for r in vec.mapInArrow(_topic_sums(centroids), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
            sums[r["at"]] = r["n"]
        sums = sums.reshape(centroids.shape)
        length = np.sqrt((sums * sums).sum(1, keepdims=True))
        new = np.where(length > 0, np.rint(SCALE * sums / np.maximum(length, 1e-9)), centroids)
        if (new == centroids).all():
            break
        centroids = new
    return centroids


def _named_topics(centroids: np.ndarray):
    names = np.array([f"t{k}" for k in range(len(centroids))] + [""], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("vec"))
            at = np.where(v.any(1), _nearest(v, centroids), len(centroids)) if len(centroids) else np.zeros(len(v), int)
            topic = pa.array(names[at], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], topic, batch.column("tokens")],
                                             names=["doc_id", "source", "lang", "topic", "tokens"])
    return run


def word_topics(docs: DataFrame, topics: int = TOPICS) -> DataFrame:
    """doc_id, source, lang, topic, tokens of every row of doc_id, source, lang, text; written once."""
    kept = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in ("doc_id", "source", "lang"))
    bags = saved(docs.mapInArrow(_bags, f"{kept}, tokens long, bag binary"), "mix-bags")
    counted = bags.select("bag").mapInArrow(_document_counts, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    n = np.zeros(BUCKETS)
    for r in counted.collect():
        n[r["bucket"]] = r["n"]
    idf = np.log((bags.count() + 1) / (n + 0.5))
    vectors = saved(bags.mapInArrow(_vectors(idf), f"{kept}, tokens long, vec binary"), "mix-vectors")
    named = vectors.mapInArrow(_named_topics(topic_centroids(vectors, topics)), f"{kept}, topic string, tokens long")
    return saved(named, "mix-features")


def features(docs: DataFrame, topic_col: str | None = None) -> DataFrame:
    """doc_id, source, lang, topic, tokens per document, written once."""
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), F.coalesce("lang", F.lit("")).alias("lang"),
                       whole_text("text").alias("text"),
                       *([F.coalesce(F.col(topic_col).cast("string"), F.lit("")).alias("topic")] if topic_col else []))
    if not topic_col:
        return word_topics(rows)
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    return saved(rows.select("doc_id", "source", "lang", "topic", F.size(words).cast("long").alias("tokens")), "mix-features")


def tempered(cells: DataFrame, dim: str, temper: float) -> DataFrame:
    """Targets of one dimension: value, target (shares that sum to 1)."""
    sums = cells.groupBy(F.col(dim).alias("value")).agg(F.sum("tokens").alias("tokens")).filter("tokens > 0")
    raised = sums.select("value", F.pow(F.col("tokens").cast("double"), F.lit(temper)).alias("p"))
    total = raised.agg(F.sum("p")).first()[0] or 1.0
    return raised.select("value", (F.col("p") / F.lit(total)).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """Cells with column ``share``: token shares that meet every target marginal (a warning says if they can't).

    ``targets``: by dimension a table value, target; values that no cell has
    count for nothing, values without a target get none.
    """
    start = cells
    for d, t in targets.items():
        start = start.join(t.select(F.col("value").alias(d), F.col("target").alias(f"target_{d}")), d, "left")
    start = start.withColumn("share", F.when(F.col("tokens") > 0, F.col("tokens").cast("double")).otherwise(0.0))
    cur = saved(start.fillna(0.0, [f"target_{d}" for d in targets]), "mix-cells")
    for look in itertools.count(1):
        step = cur
        for _ in range(ROUNDS):
            for d in targets:
                step = step.withColumn("_sum", F.sum("share").over(W.partitionBy(d))) \
                    .withColumn(f"factor_{d}", F.when(F.col("_sum") > 0, F.col(f"target_{d}") / F.col("_sum"))) \
                    .withColumn("share", F.coalesce(F.col("share") * F.col(f"factor_{d}"), F.lit(0.0))).drop("_sum")
        cur = saved(step, "mix-cells")
        off = max((cur.groupBy(d).agg(F.abs(F.sum("share") - F.first(f"target_{d}")).alias("off"))
                   .agg(F.max("off")).first()[0] or 0.0) for d in targets)
        if off < TOLERANCE:
            break
        if out_of_reach(cur, list(targets)):
            warnings.warn(f"the mixing targets can't be met together: a share is off by {off:.3g}", stacklevel=2)
            break
        if look >= LOOKS:
            warnings.warn(f"the mixing targets are not met after {look * ROUNDS} rounds: a share is off by {off:.3g}",
                          stacklevel=2)
            break
    return cur.drop(*[f"factor_{d}" for d in targets])


def out_of_reach(cells: DataFrame, dims: list[str]) -> bool:
    """Whether the factors of the last round (``factor_`` columns) prove that no weights of the cells meet the targets."""
    mean, totals = 0.0, []
    for d in dims:
        values = cells.groupBy(d).agg(F.first(f"target_{d}").alias("t"), F.first(f"factor_{d}").alias("x")).filter("t > 0")
        r = values.agg(F.sum("t"), F.sum(F.col("t") * F.log("x")), F.count_if(F.col("x").isNull())).first()
        if r[2]:        # a value with a target whose cells can have no weight
            return True
        mean, totals = mean + (r[1] or 0.0), [*totals, r[0] or 0.0]
    live = cells.filter(F.col("tokens") > 0)
    for d in dims:
        live = live.filter(F.col(f"target_{d}") > 0)
    most = live.agg(F.max(sum(F.log(f"factor_{d}") for d in dims))).first()[0]
    return most is not None and mean > most * (max(totals) if most > 0 else min(totals)) + 1e-9


def scale_for(cells: DataFrame, want: float) -> float:
    """The scale at which sum of tokens * min(1, scale * weight) is ``want``, by narrowing grids of 64 scales."""
    real = cells.filter("weight > 0")
    least = real.agg(F.min("weight"), F.sum("tokens")).first()
    if least[0] is None or want <= 0:
        return 0.0
    if want >= least[1]:
        return 1.0 / least[0]
    lo, hi = 0.0, 1.0 / least[0]
    for _ in range(9):
        grid = [lo + (hi - lo) * (k + 1) / 64 for k in range(64)]
        got = real.agg(*[F.sum(F.col("tokens") * F.least(F.lit(1.0), F.lit(x) * F.col("weight"))).alias(f"g{k}")
                         for k, x in enumerate(grid)]).first()
        k = next((k for k in range(64) if got[k] >= want), 63)
        lo, hi = (grid[k - 1] if k else lo), grid[k]
        if hi - lo <= 1e-12 * hi:
            break
    return hi


def uniform(id_col: Column) -> Column:
    """A number in [0, 1) from the MD5 of the id as text; documents without an id share one number."""
    return F.conv(F.substring(F.md5(F.coalesce(id_col.cast("string"), F.lit(""))), 1, 13), 16, 10).cast("double") \
        / float(1 << 52)


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, keep: float = KEEP, temper: float = TEMPER,
        topic_col: str | None = None) -> DataFrame:
    """doc_id, source, lang, topic, tokens, weight, probability, sampled of every document."""
    rows = features(docs, topic_col)
    cells = saved(rows.groupBy(*DIMS).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")), "mix-cells")
    targets = targets or {d: tempered(cells, d, temper) for d in DIMS}
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    raked = saved(rake(cells, targets).select(
        *DIMS, "tokens", F.when(F.col("tokens") > 0, F.col("share") * F.lit(float(total)) / F.col("tokens"))
        .otherwise(1.0).alias("weight")), "mix-weights")
    scale = scale_for(raked, keep * total)
    raked = raked.select(*DIMS, "weight", F.least(F.lit(1.0), F.lit(scale) * F.col("weight")).alias("probability"))
    out = rows.join(raked, list(DIMS))
    return out.select("doc_id", *DIMS, "tokens", "weight", "probability",
                      (uniform(F.col("doc_id")) < F.col("probability")).alias("sampled"))


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
