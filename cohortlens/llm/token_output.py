"""Token-ID output: whole documents -> ids -> range-coded blocks on disk -> ids again.

Documents are dealt by ranges of the id (about ``docs_per_shard`` rows each),
sorted, tokenized and coded; every shard's blocks are independent of each
other. The file format is a Parquet table, one row per block:

    shard, block, first (ids of the shard before it), n_ids, payload (see
    idcodec), and per document that has ids in the block: doc_ids, doc_nos (the
    document's number in the shard), counts (its ids here), after (its ids in
    later blocks).

Parquet's commit makes a lost executor's shard be written again as a whole.
A task holds at most ``GROUP`` blocks of ids and the model's tables for them,
however long a document is.

Words are tokenized once per worker: the tokenizer's pieces never cross white
space, and the marks that follow a letter up to a word's end are a piece of
their own, so a word's ids do not depend on its neighbours.

Defined cases: null text counts as empty (the end id alone); documents with
one id keep their order by a hash of the text, repeated rows are written each;
an empty table writes an empty file; other columns are not read.
"""

from __future__ import annotations

import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.llm import idcodec
from cohortlens.llm.common import coded_words, pieces, ragged, strings, table, whole_text, work_dir

END_ID = 1
DOCS_PER_SHARD = 8192
GROUP = 32
CACHED_WORDS = 1 << 19
PIECE = 4 << 20

BLOCK_SCHEMA = ("shard int, block int, first long, n_ids int, payload binary, doc_ids array<long>, "
                "doc_nos array<long>, counts array<int>, after array<long>")


#: Lower-case Latin letters that stay as they are under NFC and lower-casing.
SIMPLE = frozenset(c for c in map(chr, [*range(97, 123), *range(0xDF, 0x180)])
                   if c.isalpha() and c.lower() == c and unicodedata.normalize("NFKD", c)[0].isalpha()
                   and unicodedata.normalize("NFC", c) == c)
_SIMPLE_WORD = f"^[{''.join(sorted(SIMPLE))}]+$"
#: Words whose last marks are a piece of their own (other letters and marks would do as well, but aren't needed).
_MARKS = ".,!?;:%&$#*"
_TAILED = f"[A-Za-zÀ-ÖØ-öø-ɏ][{_MARKS}]+$"


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for the letters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in plain else next(rest)) for b in range(256)}


class WordIds:
    """Ids of words by the tokenizers library, remembered for the words of a worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        self.vocab = self.tok.get_vocab_size(with_added_tokens=True)
        self.letters = _byte_letters()
        # The same model on words that need no normalizing: white space alone tells them apart.
        self.bare = Tokenizer(self.tok.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        suffix = self.tok.model.end_of_word_suffix or "\0"
        self.last = np.zeros(self.vocab, bool)
        for piece, i in self.tok.get_vocab(with_added_tokens=False).items():
            self.last[i] = piece.endswith(suffix)
        self.clear()
        # Used only if it gives what the whole tokenizer gives.
        probe = ["".join(sorted(SIMPLE)), *sorted(SIMPLE), "the", "thth", "straße", "naïveté"]
        ids, counts = self._direct(probe)
        self.direct = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == self._whole(probe)

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.counts, self.flat = array("I"), array("H")

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _direct(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of simple letters, one after the other, and their number by word."""
        words = [w if w.isascii() else w.encode().decode("latin-1").translate(self.letters) for w in words]
        lines = [" ".join(words[k:k + 500]) for k in range(0, len(words), 500)]
        ids = [np.array(e.ids, np.int64) for e in self.bare.encode_batch_fast(lines, add_special_tokens=False)]
        ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        return ids, np.diff(np.flatnonzero(self.last[ids]), prepend=-1)

    def _learn(self, cores: pa.Array) -> np.ndarray:
        """Add the ids of distinct new words; returns their places."""
        simple_word = pc.match_substring_regex(cores, _SIMPLE_WORD) if self.direct else pa.array([False] * len(cores))
        simple, rest, capital = strings(cores.filter(simple_word)), [], []
        first, places, easy = len(self.counts), np.empty(len(cores), np.int64), simple_word.to_numpy(zero_copy_only=False)
        places[easy] = first + np.arange(len(simple))
        for c in strings(cores.filter(pc.invert(simple_word))):
            low = c.lower()         # other capitals of the same letters
            if self.direct and c and len(low) == len(c) and SIMPLE.issuperset(low):
                capital.append((c, low))
            else:
                rest.append(c)
        if capital:
            simple = list(dict.fromkeys(simple + [low for _, low in capital if low not in self.place]))
        ids, counts = self._direct(simple)
        others = self._whole(rest)
        self.place.update(zip(simple + rest, range(len(self.counts), len(self.counts) + len(simple) + len(rest))))
        self.place.update((c, self.place[low]) for c, low in capital)
        self.counts.frombytes(counts.astype(np.uint32).tobytes())
        self.flat.frombytes(ids.astype(np.uint16).tobytes())
        self.counts.extend(map(len, others))
        for x in others:
            self.flat.extend(x)
        others = strings(cores.filter(pc.invert(simple_word)))
        places[~easy] = np.fromiter(map(self.place.__getitem__, others), np.int64, len(others))
        return places

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after the other, and their number by word."""
        # The regular expression is matched only where a mark ends the word.
        marked = np.flatnonzero(pc.is_in(pc.utf8_slice_codeunits(words, -1), pa.array(list(_MARKS)))
                                .to_numpy(zero_copy_only=False))
        ends_so = words.take(pa.array(marked))
        marked = marked[pc.match_substring_regex(ends_so, _TAILED).to_numpy(zero_copy_only=False)]
        ends_so = words.take(pa.array(marked))
        core = pc.utf8_rtrim(ends_so, _MARKS)
        tails = pa.array([w[n:] for w, n in zip(strings(ends_so), pc.utf8_length(core).to_pylist())], pa.string())
        is_marked = np.zeros(len(words), bool)
        is_marked[marked] = True
        plain = pc.replace_with_mask(words, pa.array(is_marked), core)
        coded = pa.chunked_array([plain, tails]).dictionary_encode().combine_chunks()
        cores = strings(coded.dictionary)
        if len(self.place) > CACHED_WORDS:
            self.clear()
        k = np.fromiter(map(self.place.get, cores, repeat(-1)), np.int64, len(cores))
        new = np.flatnonzero(k < 0)
        if len(new):
            k[new] = self._learn(coded.dictionary.take(pa.array(new)))
        k = k[coded.indices.to_numpy(zero_copy_only=False)]
        # Cores and tails in the words' order.
        after = np.arange(len(words)) + np.cumsum(is_marked) - is_marked
        order = np.empty(len(k), np.int64)
        order[after] = k[:len(words)]
        order[after[marked] + 1] = k[len(words):]
        counts = np.frombuffer(self.counts, np.uint32).astype(np.int64)
        starts = np.cumsum(counts) - counts
        n = counts[order]
        out = np.frombuffer(self.flat, np.uint16)[ragged(starts[order], n)] if n.sum() else np.zeros(0, np.uint16)
        total = n[after]
        total[marked] += n[after[marked] + 1]
        return out, total

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and the number of ids of each text (without an end id)."""
        # Letters A-Z are lower-cased by the tokenizer; only marks of special tokens are told apart before that.
        special = bool(pc.any(pc.match_substring(pc.fill_null(texts, ""), "<|")).as_py())
        codes, offsets, words = coded_words(texts, lower=not special)
        if not len(codes):
            return np.zeros(0, np.uint16), np.diff(offsets)
        ids, counts = self.words(words)
        starts = np.cumsum(counts) - counts
        n = counts[codes]
        per_doc = np.concatenate([[0], np.cumsum(n)])[offsets]
        return ids[ragged(starts[codes], n)], np.diff(per_doc)


_WORKER: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _WORKER:
        _WORKER[path] = WordIds(path)
    return _WORKER[path]


class _Writer:
    """Blocks of one shard, from its documents' ids in order."""

    def __init__(self, vocab: int, block: int):
        self.vocab, self.block = vocab, block
        self.ids: list[np.ndarray] = []
        self.held = self.first = self.number = self.docs = 0
        self.segs: list[tuple] = []        # (doc id, doc number, ids left to write)

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.held += len(ids)
        self.segs.append((doc_id, self.docs, len(ids)))
        self.docs += 1

    def cut(self, last: bool) -> list[dict]:
        """Rows of the full groups of blocks held; of all ids held if ``last``."""
        flat = np.concatenate(self.ids) if self.ids else np.zeros(0, np.uint16)
        full = self.held // self.block
        if not last:
            full -= full % GROUP        # small groups cost more a block
        groups = [flat[a * self.block:min(a + GROUP, full) * self.block].reshape(-1, self.block)
                  for a in range(0, full, GROUP)]
        rest = flat[full * self.block:]
        if last and len(rest):
            groups.append(rest.reshape(1, -1))
            rest = rest[:0]
        self.ids, self.held = ([rest] if len(rest) else []), len(rest)
        rows = []
        for g in groups:
            for data in idcodec.encode_blocks(g, self.vocab):
                rows.append(self._row(data, g.shape[1]))
        return rows

    def _row(self, data: bytes, n: int) -> dict:
        row = {"block": self.number, "first": self.first, "n_ids": n, "payload": data, "doc_ids": [], "doc_nos": [],
               "counts": [], "after": []}
        need, used = n, 0
        for doc_id, no, left in self.segs:
            if not need:
                break
            take = min(need, left)
            row["doc_ids"].append(doc_id)
            row["doc_nos"].append(no)
            row["counts"].append(take)
            row["after"].append(left - take)
            need -= take
            used += 1
        if row["after"][-1]:
            used -= 1
            doc_id, no, _ = self.segs[used]
            self.segs[used] = (doc_id, no, row["after"][-1])
        self.segs = self.segs[used:]
        self.number += 1
        self.first += n
        return row


def _encode_partitions(path: str, end_id: int, block: int):
    schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()),
                        ("payload", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("doc_nos", pa.list_(pa.int64())),
                        ("counts", pa.list_(pa.int32())), ("after", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, writer, shard = word_ids(path), None, None

        def rows_of(rows):
            return pa.RecordBatch.from_pylist([{"shard": shard, **r} for r in rows], schema=schema)

        for batch in pieces(batches, "text", PIECE):
            shard = batch.column("shard")[0].as_py()     # a partition is one shard
            writer = writer or _Writer(coder.vocab, block)
            ids, counts = coder.encode(batch.column("text"))
            ends = np.cumsum(counts)
            for doc_id, a, z in zip(batch.column("doc_id").to_pylist(), ends - counts, ends):
                writer.add(doc_id, np.append(ids[a:z], np.uint16(end_id)))
            if writer.held >= GROUP * block:
                yield rows_of(writer.cut(False))
        if writer:
            yield rows_of(writer.cut(True))
    return run


def write_token_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id",
                    text_col: str = "text", docs_per_shard: int = DOCS_PER_SHARD,
                    block: int = idcodec.BLOCK) -> str:
    """Write the documents in ascending id order; returns ``path``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    shards = max(1, -(-rows.count() // docs_per_shard))
    tie = F.xxhash64("text")
    dealt = rows.repartitionByRange(shards, "doc_id", tie).sortWithinPartitions("doc_id", tie) \
        .select("doc_id", "text", F.spark_partition_id().alias("shard"))
    dealt.mapInArrow(_encode_partitions(tokenizer, end_id, block), BLOCK_SCHEMA).write.parquet(path)
    return path


def _zeros_matrix() -> list[int]:
    """Columns of the matrix that one zero byte applies to a CRC-32 state."""
    cols = []
    for bit in range(32):
        c = 1 << bit
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        cols.append(c)
    return cols


def _times(matrix: list[int], vector: int) -> int:
    out = 0
    for col in matrix:
        if vector & 1:
            out ^= col
        vector >>= 1
    return out


def crc_shift(crc: int, zeros: int, _powers: list = []) -> int:
    """The CRC-32 part of a piece with ``zeros`` more bytes after it; the parts of a text XOR to its CRC-32."""
    if not _powers:
        _powers.append(_zeros_matrix())
    k = 0
    while zeros:
        if k == len(_powers):
            _powers.append([_times(_powers[-1], c) for c in _powers[-1]])
        if zeros & 1:
            crc = _times(_powers[k], crc)
        zeros >>= 1
        k += 1
    return crc


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, np.ndarray]]:
    """Block rows with their ids; up to GROUP blocks of one length are decoded together."""
    for batch in batches:
        for a in range(0, batch.num_rows, GROUP):
            rows = batch.slice(a, GROUP).to_pylist()
            by_length: dict[int, list[dict]] = {}
            for r in rows:
                by_length.setdefault(r["n_ids"], []).append(r)
            for same in by_length.values():
                vocab = same[0]["vocab"]
                for r, ids in zip(same, idcodec.decode_blocks([r["payload"] for r in same], vocab)):
                    yield r, ids


def _decode_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("shard", pa.int32()), ("doc_no", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()),
                        ("n", pa.int64()), ("crc", pa.int64())])
    for row, ids in _decoded(batches):
        raw = ids.astype("<u4").tobytes()
        ends = np.cumsum(row["counts"])
        parts = []
        for z, n, after in zip(ends.tolist(), row["counts"], row["after"]):
            crc = zlib.crc32(raw[4 * (z - n):4 * z])
            parts.append(crc_shift(crc, 4 * after) if after else crc)
        yield pa.RecordBatch.from_arrays(
            [pa.array([row["shard"]] * len(ends), pa.int32()), pa.array(row["doc_nos"], pa.int64()),
             pa.array(row["doc_ids"], pa.int64()), pa.array((row["first"] + ends - row["counts"]).tolist(), pa.int64()),
             pa.array(row["counts"], pa.int64()), pa.array(parts, pa.int64())], schema=schema)


def _decode_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row, ids in _decoded(batches):
        ends = np.cumsum(row["counts"])
        yield pa.RecordBatch.from_arrays(
            [pa.array([row["shard"]] * len(ends), pa.int32()), pa.array(row["doc_nos"], pa.int64()),
             pa.array(row["doc_ids"], pa.int64()), pa.array((row["first"] + ends - row["counts"]).tolist(), pa.int64()),
             pa.array([ids[z - n:z].tolist() for z, n in zip(ends, row["counts"])], pa.list_(pa.int32()))],
            names=["shard", "doc_no", "doc_id", "at", "ids"])


def _blocks(spark: SparkSession, path: str, vocab: int) -> DataFrame:
    return spark.read.schema(BLOCK_SCHEMA).parquet(path).withColumn("vocab", F.lit(vocab))


def read_token_ids(spark: SparkSession, path: str, vocab: int) -> DataFrame:
    """doc_id, shard, doc_no, at, ids per document part; the parts of a document are in order of ``at``."""
    return _blocks(spark, path, vocab).mapInArrow(
        _decode_ids, "shard int, doc_no long, doc_id long, at long, ids array<int>")


def token_index(spark: SparkSession, path: str, vocab: int) -> DataFrame:
    """Decode the files: per document doc_id, start, n_tokens, ids_crc32."""
    parts = _blocks(spark, path, vocab).mapInArrow(
        _decode_parts, "shard int, doc_no long, doc_id long, at long, n long, crc long")
    docs = parts.groupBy("shard", "doc_no").agg(
        F.max("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n_tokens"),
        F.expr("bit_xor(crc)").alias("ids_crc32"))
    # Ids of all shards before, in two levels: by thousands of shards, then inside.
    sizes = spark.read.schema(BLOCK_SCHEMA).parquet(path).groupBy("shard").agg(F.sum("n_ids").alias("ids")) \
        .withColumn("big", F.expr("shard div 1000"))
    big = sizes.groupBy("big").agg(F.sum("ids").alias("ids"))
    big = big.select("big", (F.sum("ids").over(W.orderBy("big")) - F.col("ids")).alias("before_big"))
    starts = sizes.join(big, "big").select("shard", (
        F.col("before_big") + F.sum("ids").over(W.partitionBy("big").orderBy("shard")) - F.col("ids")).alias("before"))
    return docs.join(starts, "shard").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens",
                                             "ids_crc32")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def token_output(spark: SparkSession, docs: DataFrame, path: str | None = None, tokenizer: str | None = None,
                 end_id: int = END_ID) -> DataFrame:
    """Write the documents' ids to ``path`` (default: a new shared folder) and index what is read back."""
    tokenizer = tokenizer or tokenizer_path()
    path = write_token_ids(docs, path or work_dir(spark, "token-ids"), tokenizer, end_id)
    return token_index(spark, path, word_ids(tokenizer).vocab)


def op1_token_output(spark, sf_dir: str) -> DataFrame:
    return token_output(spark, table(spark, sf_dir, "documents"))
