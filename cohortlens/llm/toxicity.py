"""Toxicity of documents: restore disguised words by a noisy channel, then score the restored text.

1. A character model (trigrams with backoff) is counted over the words of all documents.
2. Tokens that hold a letter or a leet sign and are not plain (letters only,
   a number, one sign repeated), with and without edge marks that can stand for
   a letter, and runs of three or more single-letter tokens, are decoded by
   Viterbi over a character lattice of leetspeak, separators and repeats under
   that model.
3. Word features (whole word and its first 4, 5 and 6 letters) are counted
   over labelled documents. A feature is evidence if it is tied to toxic
   labels more than chance allows over all features tried; copies of a
   document count once or little, by distinct document sketches (their number
   is exact; the training sample bounds it).
4. A document's score is 1 - (1 - base) * product of (1 - risk) over its
   distinct evidence words, in plain or restored form.

Labels are learnt from at most about ``train_rows`` labelled rows (a uniform
sample by hash, never held-out rows); the character model and the scores
cover all rows and whole texts.

Defined cases: null and empty texts get the base score; repeated rows get
equal scores; without labels of both kinds all get the base score; labels
without a document are ignored; an empty table gives no rows; a null id is
scored like any other; other columns are not read. A run of single-letter
tokens costs a fixed number of steps a letter, however long it is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import deobfuscate as D
from cohortlens.llm.common import pieces, saved, split_words, table, whole_text

TRAIN_ROWS = 20_000
PREFIXES = (4, 5, 6)
SKETCHES = 4
LEAST_SUPPORT = 3
THRESHOLD = 0.7


def _char_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(D.SIZE ** 3)
    for batch in pieces(batches, "text"):
        codes, _, words = split_words(batch.column("text"))
        if words:
            total += D.trigram_counts([D.plain(w.lower()) for w in words], np.bincount(codes, minlength=len(words)))
    ids = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids].astype(np.int64))], names=["id", "n"])


def character_model(texts: DataFrame) -> np.ndarray:
    """log P of the trigram model over all texts; at most (letters)^3 counts come to the driver."""
    rows = texts.select("text").mapInArrow(_char_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(D.SIZE ** 3)
    for r in rows.collect():
        counts[r["id"]] = r["n"]
    return D.log_model(counts)


def restorer(log_p: np.ndarray):
    """``D.restore`` that keeps its results; the table is emptied when it has 2 ** 17."""
    known: dict[str, str] = {}

    def restored(word: str) -> str:
        out = known.get(word)
        if out is None:
            if len(known) >= 1 << 17:
                known.clear()
            out = known[word] = D.restore(word, log_p)
        return out
    return restored


def forms(word: str, restored) -> list[str]:
    """Plain and restored forms of a token, the latter also with the edge marks that can stand for a letter."""
    word = word.lower()
    core, whole = D.plain(word), D.signed(word)
    out = [core] if core else []
    out += [restored(x) for x in ((core, whole) if whole != core else (core,)) if D.disguised(x)]
    return out


def features_of(form: str) -> list[str]:
    """The form, and its beginnings marked as such."""
    return [form] + [f"{form[:k]}~" for k in PREFIXES if len(form) > k]


def spaced_runs(codes: np.ndarray, offsets: np.ndarray, single: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(document, codes) of runs of three or more single-letter tokens."""
    if not len(codes):
        return []
    one = single[codes]
    begin = one.copy()
    begin[1:] &= ~one[:-1]
    doc_start = offsets[:-1][offsets[:-1] < len(codes)]
    begin[doc_start] = one[doc_start]
    starts = np.flatnonzero(begin)
    stops = np.flatnonzero(~one)
    nexts = np.concatenate([starts[1:], [len(codes)]])
    ends = np.concatenate([stops, [len(codes)]])[np.searchsorted(stops, starts)]
    ends = np.minimum(ends, nexts)
    docs = np.searchsorted(offsets, starts, side="right") - 1
    return [(int(d), codes[a:z]) for d, a, z in zip(docs, starts, ends) if z - a >= 3]


_MANY = re.compile(r"(.)\1{3,}")


def run_forms(letters: str, log_p: np.ndarray, longest: int) -> Iterator[str]:
    """What single letters in a row can spell: every stretch of three or more, restored.

    A stretch goes on to ``longest`` letters and leet signs, other signs not counted: no more are in any word that is
    looked for. More than three equal characters in a row count as three.
    """
    letters = _MANY.sub(r"\1\1\1", letters)
    solid = np.flatnonzero([c.isalpha() or c in D.LEET for c in letters])
    for k, a in enumerate(solid.tolist()):
        part = letters[a:int(solid[k + longest]) if k + longest < len(solid) else len(letters)]
        if D.disguised(part):
            ends = D.viterbi_ends(D.lattice(part), log_p)
            yield from (ends[z - 1] if D.disguised(part[:z]) else part[:z] for z in range(3, len(part) + 1))
        else:
            yield from (part[:z] for z in range(3, len(part) + 1))


def _counts(log_p: np.ndarray):
    """Per piece: feature, toxic and clean documents that have it, the toxic ones' sketches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restored = restorer(log_p)
        for batch in pieces(batches, "text"):
            codes, offsets, words = split_words(batch.column("text"))
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
            owner = np.repeat(np.arange(len(toxic)), np.diff(offsets))
            width = max(1, len(words))
            pair = np.unique(owner * width + codes)
            doc, code = pair // width, pair % width
            # Sketches of the documents' word sets: the word of the least hash, for several hashes.
            base = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
            sketch = np.zeros((SKETCHES, len(toxic)), np.uint64)
            first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else doc
            for s in range(SKETCHES if len(doc) else 0):
                h = base * np.uint64(2 * s + 0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
                sketch[s, doc[first]] = np.minimum.reduceat(h[code], first)
            feats = [[f for form in forms(w, restored) for f in features_of(form)] for w in words]
            sizes = np.fromiter(map(len, feats), np.int64, len(feats))
            number: dict[str, int] = {}
            flat = np.fromiter((number.setdefault(f, len(number)) for fs in feats for f in fs), np.int64,
                               int(sizes.sum()))
            names = pa.array(list(number), pa.string())
            starts = np.cumsum(sizes) - sizes
            n = sizes[code]
            f = flat[np.repeat(starts[code] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))] if len(code) else flat
            d = np.repeat(doc, n)
            order = np.lexsort((d, f))
            f, d = f[order], d[order]
            new = np.ones(len(f), bool)
            new[1:] = (f[1:] != f[:-1]) | (d[1:] != d[:-1])
            f, d = f[new], d[new]
            at = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]])) if len(f) else np.zeros(0, np.int64)
            if not len(at):
                continue
            hot = toxic[d]
            t = np.add.reduceat(hot.astype(np.int64), at)
            c = np.add.reduceat((~hot).astype(np.int64), at)
            ends = pa.array(np.concatenate([[0], np.cumsum(t)]), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(sketch[s, d[hot]].view(np.int64))) for s in range(SKETCHES)]
            yield pa.RecordBatch.from_arrays([names.take(pa.array(f[at])), pa.array(t), pa.array(c), *lists],
                                             names=["feature", "t", "c", *[f"b{s}" for s in range(SKETCHES)]])
    return run


def learn(train: DataFrame, log_p: np.ndarray) -> tuple[dict[str, float], float]:
    """Risk by feature, and the base score. ``train``: text, toxic (0/1).

    The table is bounded by the training sample: every entry needs several documents of it.
    """
    sums = train.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    toxic, rows = int(sums[0] or 0), int(sums[1])
    if not toxic or toxic == rows:
        return {}, 0.5 if not rows else min(0.65, toxic / rows)
    rate = toxic / rows
    sketches = [f"b{s}" for s in range(SKETCHES)]
    counts = train.select("text", "toxic").mapInArrow(
        _counts(log_p), "feature string, t long, c long, " + ", ".join(f"{m} array<long>" for m in sketches)) \
        .groupBy("feature").agg(F.sum("t").alias("t"), F.sum("c").alias("c"),
                                *[F.size(F.array_distinct(F.flatten(F.collect_list(m)))).alias(m) for m in sketches])
    # Distinct sketches, a number for each toxic document of the sample; the least of several, as edits may move one.
    support = F.least(*sketches).cast("double")
    counted = saved(counts.withColumn("s", support).filter(F.col("s") >= LEAST_SUPPORT)
                    .select("feature", "s", "c"), "toxic-counts")
    tried = counted.count()
    n = F.col("s") + F.col("c")
    p = F.col("s") / n
    gain = F.col("s") * F.log(p / rate) + F.when(F.col("c") > 0, F.col("c") * F.log((1 - p) / (1 - rate))).otherwise(0.0)
    good = counted.filter((p > rate) & (gain > float(np.log(max(2, tried)) + 1))) \
        .select("feature", ((F.col("s") + rate) / (n + 1)).alias("risk")).filter("risk > 0.5")
    risk = {r["feature"]: r["risk"] for r in good.collect()}
    return risk, min(0.05, rate / 2)


def _scores(log_p: np.ndarray, risk: dict[str, float], base: float):
    get = risk.get
    # No stretch of letters can be evidence by more than this many of them.
    longest = max([PREFIXES[-1] + 1, *(len(f) for f in risk if not f.endswith("~"))])

    def of_form(form: str) -> float:
        return max([get(f, 0.0) for f in features_of(form)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restored = restorer(log_p)

        def of_word(word: str) -> float:
            return max([of_form(x) for x in forms(word, restored)], default=0.0)

        for batch in pieces(batches, "text"):
            codes, offsets, words = split_words(batch.column("text"))
            risks = np.fromiter(map(of_word, words), np.float64, len(words))
            docs = len(offsets) - 1
            clear = np.zeros(docs)
            owner = np.repeat(np.arange(docs), np.diff(offsets))
            hit = np.flatnonzero(risks[codes] > 0) if len(words) else np.zeros(0, np.int64)
            pair = np.unique(owner[hit] * max(1, len(words)) + codes[hit])
            np.add.at(clear, pair // max(1, len(words)), np.log1p(-risks[pair % max(1, len(words))]))
            cores = [D.plain(w.lower()) or w for w in words]
            single = np.fromiter((len(x) == 1 for x in cores), bool, len(words))
            for d, run_codes in spaced_runs(codes, offsets, single):
                letters = "".join(cores[c] for c in run_codes)
                spelled = max((of_form(x) for x in run_forms(letters, log_p, longest)), default=0.0) if risk else 0.0
                if spelled:
                    clear[d] += np.log1p(-spelled)
            score = 1 - (1 - base) * np.exp(clear)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])
    return run


def held_out(id_col: str = "doc_id"):
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(3)) == 1


def toxicity_scores(docs: DataFrame, labels: DataFrame, learn_from=None, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, score per document. ``labels``: doc_id, toxic; ``learn_from``: condition on doc_id (default: all)."""
    texts = docs.select(F.col("doc_id"), whole_text("text").alias("text"))
    log_p = character_model(texts)
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("toxic IS NOT NULL")
    if learn_from is not None:
        known = known.filter(learn_from)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    part = min(1.0, train_rows / max(1, known.count()))
    known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(part * (1 << 30)))
    risk, base = learn(texts.join(known, "doc_id").select("text", "toxic"), log_p)
    return texts.mapInArrow(_scores(log_p, risk, base), "doc_id long, score double")


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    out = toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out())
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
