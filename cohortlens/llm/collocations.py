"""Phrase collocation mining over occurrence relations (SETM): extend, count, keep the frequent, extend again.

The relation of length k has a row for every place where a frequent phrase of
k words occurs: (piece, position, phrase). It is written sorted by piece and
position, a block of text (one language, about ``BLOCK_BYTES``) a Parquet row:
``codes`` holds the phrase at every position, -1 at piece ends and where none
is frequent, and ``ids`` the phrases behind a block's codes. All of a piece
lies in one block, so the merge join of the relation with itself on (piece,
position + 1) walks one sorted array beside itself, shifted by one: two
phrases that overlap in k - 1 words make one of k + 1. Blocks count their own
pairs and deal them out by phrase with the place they come from (a pair that
is everywhere is one row a block); sorted by phrase, the counts add up, and
the frequent phrases' places go back to their blocks, packed by block, which is the
semi-join before the next length. A phrase's id is its first place.

Scores go by decimals of 38 digits and are exact up to counts of 10 ** 16.

Defined cases: null text counts as empty, a null language as ``und``; empty
texts have no words; repeated rows count each; a text of any length is one
block at least; equal scores go by count, then by the phrase's bytes; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.common import pieces, release, saved, table, whole_text, work_dir

MAX_WORDS, MIN_COUNT, TOP = 3, 10, 2000
#: A phrase inside a longer one goes if 100 * f(longer) >= CONTAINED * f.
CONTAINED = 50
SCORE_SCALE = 1_000_000
BLOCK_BYTES = 8 << 20
#: Bytes of text whose words a task holds, as codes, for blocks of several languages; and bytes coded at a time.
HELD_BYTES, CODED_BYTES = 16 << 20, 1 << 20
#: Parts in which a language's ranking is cut before the last step.
RANK_PARTS = 64
#: A place is a task's number, its block's and the phrase's spot in the block's list: bits of the last two (21 are left).
BLOCK_BITS, SPOT_BITS = 14, 28
#: Frequent places go back to their blocks packed by block; a task packs so many at a time.
PACKED = ["block", "spots", "ids"]
PACKED_PLACES = 1 << 20

PIECE_END = r"[.,;:!?\x0A-\x0D]"
RAW = "block long, lang string, codes binary, words array<string>, counts array<long>"
RELATION = "block long, lang string, codes binary, ids binary"


def word_codes(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Codes of all words in order, -1 at the ends of pieces and texts, and the distinct words.

    A mark that no word can hold stands for every piece end.
    """
    marked = pc.replace_substring_regex(pc.ascii_lower(texts), PIECE_END, " . ")
    coded = pc.ascii_split_whitespace(pc.binary_join_element_wise(marked, ".", " ")).flatten().dictionary_encode()
    words = coded.dictionary
    mark, none = (pc.equal(words, v).to_numpy(zero_copy_only=False) for v in (".", ""))
    place = (np.cumsum(~mark & ~none) - 1).astype(np.int32)
    place[mark], place[none] = -1, -2
    codes = place[coded.indices.to_numpy(zero_copy_only=False)]
    return codes[codes > -2], words.filter(pa.array(~mark & ~none))


def _block(lang: str, held: list[tuple[np.ndarray, pa.Array]], block: int) -> pa.RecordBatch | None:
    """One block of the parts ``held``, each coded by its own words."""
    coded = pa.concat_arrays([w for _, w in held]).dictionary_encode()
    words, place, at, parts = coded.dictionary, coded.indices.to_numpy(), 0, []
    if not len(words):
        return None
    for codes, own in held:
        parts.append(np.append(place[at:at + len(own)], np.int32(-1))[codes])    # the last place is for -1 itself
        at += len(own)
    codes, all_of_them = np.concatenate(parts), pa.array([0, len(words)], pa.int32())
    counts = np.bincount(codes + 1, minlength=len(words) + 1)[1:]
    return pa.RecordBatch.from_arrays(
        [pa.array([block]), pa.array([lang]), pa.array([codes.tobytes()], pa.binary()),
         pa.ListArray.from_arrays(all_of_them, words), pa.ListArray.from_arrays(all_of_them, pa.array(counts, pa.int64()))],
        names=["block", "lang", "codes", "words", "counts"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[tuple[np.ndarray, pa.Array]]] = {}
    sizes: dict[str, int] = {}
    number = task = 0

    def cut(lang):
        nonlocal number
        sizes.pop(lang)
        number += 1
        if number >> BLOCK_BITS or task >> 63 - BLOCK_BITS - SPOT_BITS:
            raise ValueError(f"more than {1 << BLOCK_BITS} blocks in a task, or too many tasks")
        return _block(lang, held.pop(lang), (task << BLOCK_BITS) + number)
    for batch in pieces(batches, "text", CODED_BYTES):
        langs, task = batch.column("lang"), batch.column("task")[0].as_py()
        for lang in pc.unique(langs).to_pylist():
            texts = batch.column("text").filter(pc.equal(langs, lang))
            held.setdefault(lang, []).append(word_codes(texts))
            sizes[lang] = sizes.get(lang, 0) + pc.sum(pc.binary_length(texts)).as_py()
            if sizes[lang] >= BLOCK_BYTES:
                yield cut(lang)
                release()
        while sum(sizes.values()) > HELD_BYTES:
            yield cut(max(sizes, key=sizes.get))
            release()
    for lang in list(held):
        yield cut(lang)


def _full(blocks):
    def run(batches):
        return (b for b in blocks(batches) if b is not None)
    return run


def dealt(relation: DataFrame, names: list | None = None) -> DataFrame:
    """Write a relation to the shared folder in buckets by block, so that the joins by block read it where it lies.

    Its rows are long, so it goes by zstd, which streams; snappy keeps native buffers as long as a page.
    ``names`` gets the table's name, for whoever drops it.
    """
    spark = relation.sparkSession
    name = f"phrase_places_{uuid.uuid4().hex}"
    if names is not None:
        names.append(name)
    relation.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").sortBy("block") \
        .option("compression", "zstd").option("path", work_dir(spark, "phrase-places")).saveAsTable(name)
    return spark.table(name)


def occurrences(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", names: list | None = None) -> DataFrame:
    """The word relation of all texts, before any word is dropped; written."""
    rows = docs.select(whole_text(text_col).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.spark_partition_id().alias("task"))
    return dealt(rows.mapInArrow(_full(_blocks), RAW), names)


def extended(codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge join of a sorted relation with itself at the next position.

    Returns the positions where both phrases stand, the distinct pairs (first * n + second), each position's pair,
    and the count of each pair.
    """
    at = np.flatnonzero((codes[:-1] >= 0) & (codes[1:] >= 0))
    coded = pa.array(codes[at].astype(np.int64) * n + codes[at + 1]).dictionary_encode()
    which = coded.indices.to_numpy()
    return at, coded.dictionary.to_numpy(), which, np.bincount(which, minlength=len(coded.dictionary))


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            codes = np.frombuffer(batch.column("codes")[row].as_buffer(), np.int32)
            ids = np.frombuffer(batch.column("ids")[row].as_buffer(), np.int64)
            _, keys, _, counts = extended(codes, max(len(ids), 1))
            first = batch.column("block")[row].as_py() << SPOT_BITS
            for a in range(0, len(keys), 1 << 16):
                part = keys[a:a + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[part // len(ids)]), pa.array(ids[part % len(ids)]),
                     pa.array(first + np.arange(a, a + len(part))), pa.array(counts[a:a + (1 << 16)])],
                    names=["left", "right", "place", "n"])
            release()


def pairs(relation: DataFrame) -> DataFrame:
    """(left, right, place, n): the phrases of the next length that each block holds, where, and how often."""
    return relation.select("block", "codes", "ids").mapInArrow(_pairs, "left long, right long, place long, n long")


def _squeezed(numbers: np.ndarray) -> bytes:
    """Deflated byte by byte of the numbers, without loss."""
    return zlib.compress(np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, numbers.itemsize).T).tobytes(), 1)


def _unsqueezed(raw: bytes, kind) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1).T) \
        .view(kind).ravel()


def _packed(place: np.ndarray, ids: np.ndarray, named: list[pa.Field]) -> pa.RecordBatch:
    """A row for each block that the places lie in: its spots (as steps) in order, and their ids."""
    order = np.argsort(place)
    place, ids = place[order], ids[order]
    block = place >> SPOT_BITS
    cuts = np.flatnonzero(np.diff(block, prepend=-1))
    spots, numbers = [], []
    for a, z in zip(cuts.tolist(), [*cuts[1:].tolist(), len(place)]):
        spot = (place[a:z] & (1 << SPOT_BITS) - 1).astype(np.int32)
        spots.append(_squeezed(np.diff(spot, prepend=np.int32(0))))
        numbers.append(_squeezed(ids[a:z]))
    return pa.RecordBatch.from_arrays(
        [pa.array(block[cuts]), pa.array(spots, pa.binary()), pa.array(numbers, pa.binary()),
         *(pa.nulls(len(cuts), f.type) for f in named)], names=[*PACKED, *(f.name for f in named)])


def _met(keys: list[str], types: list[str], min_count: int):
    """From rows sorted by ``keys``: the places of the frequent ones by block, and a row (id, f, keys) for each of them."""
    kinds = {"long": pa.int64(), "string": pa.string()}
    named = [pa.field("id", pa.int64()), pa.field("f", pa.int64()), *(pa.field(k, kinds[t]) for k, t in zip(keys, types))]

    def groups(table: pa.Table, last: bool) -> tuple[np.ndarray, np.ndarray, pa.RecordBatch, pa.Table]:
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for k in keys:
            column = table.column(k)
            new[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy()
        starts = np.flatnonzero(new)
        end = table.num_rows if last else int(starts[-1])          # the last group may go on
        rest, table, starts = table.slice(end), table.slice(0, end), starts[:None if last else -1]
        place = table.column("place").to_numpy()
        if not len(starts):
            total = ids = which = np.zeros(0, np.int64)
        else:
            total = np.add.reduceat(table.column("n").to_numpy(), starts)
            ids = np.minimum.reduceat(place, starts)
            which = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, end)))
        rows = np.flatnonzero(total[which] >= min_count)
        own = rows[place[rows] == ids[which[rows]]]         # the row that gives a phrase its id
        out = [pa.array(place[own]), pa.array(total[which[own]]),
               *(table.column(k).take(pa.array(own)).combine_chunks() for k in keys)]
        none = [pa.nulls(len(own), t) for t in (pa.int64(), pa.binary(), pa.binary())]
        return place[rows], ids[which[rows]], pa.RecordBatch.from_arrays(
            [*none, *out], names=[*PACKED, *(f.name for f in named)]), rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, held, n = None, [], 0

        def found(table: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal rest, n
            place, ids, out, rest = groups(table, last)
            yield out
            held.append((place, ids))
            n += len(place)
            if n >= PACKED_PLACES or last and n:
                yield _packed(*(np.concatenate(x) for x in zip(*held)), named)
                held.clear()
                n = 0
        for batch in batches:
            if batch.num_rows:
                both = pa.Table.from_batches([batch])
                yield from found(both if rest is None else pa.concat_tables([rest, both]).combine_chunks(), False)
        if rest is not None:
            yield from found(rest, True)
    return run


def frequent(offered: DataFrame, keys: list[str], min_count: int, name: str) -> DataFrame:
    """Rows (block, spots, ids) with the places of all frequent groups, and rows (id, f, keys) of the groups. Written."""
    types = [dict(offered.dtypes)[k].replace("bigint", "long") for k in keys]
    dealt_out = offered.select(*keys, "place", "n").repartition(*keys).sortWithinPartitions(*keys)
    schema = "block long, spots binary, ids binary, id long, f long, " + ", ".join(f"{k} {t}" for k, t in zip(keys, types))
    return saved(dealt_out.mapInArrow(_met(keys, types, min_count), schema), name)


def _kept_words(left: pa.Table, right: pa.Table) -> pa.Table:
    return _relation(left, right, lambda codes, ids: codes, lambda row: np.zeros(0, np.int64))


def _kept_pairs(left: pa.Table, right: pa.Table) -> pa.Table:
    def spread(codes, ids):
        at, _, which, _ = extended(codes, max(len(ids), 1))
        out = np.full(len(codes), -1, np.int32)
        out[at] = which
        return out
    return _relation(left, right, spread, lambda row: np.frombuffer(row, np.int64))


def _relation(left: pa.Table, right: pa.Table, spread, read_ids) -> pa.Table:
    """One block's relation, of the phrases that ``right`` (spots, ids) names."""
    spots = np.concatenate([np.zeros(0, np.int32), *(np.cumsum(_unsqueezed(x, np.int32)) for x in right.column("spots").to_pylist())]) \
        .astype(np.int32)
    ids = np.concatenate([np.zeros(0, np.int64), *(_unsqueezed(x, np.int64) for x in right.column("ids").to_pylist())])
    rows = []
    for k in range(left.num_rows):
        codes = np.frombuffer(left.column("codes")[k].as_buffer(), np.int32)
        codes = spread(codes, read_ids(left.column("ids")[k].as_buffer() if "ids" in left.column_names else None))
        new = np.full(max(int(codes.max(initial=-1)), int(spots.max(initial=-1))) + 2, -1, np.int32)
        new[spots] = np.arange(len(spots))      # the last place stays -1, for -1 itself
        rows.append({"block": left.column("block")[k].as_py(), "lang": left.column("lang")[k].as_py(),
                     "codes": new[codes].tobytes(), "ids": ids.astype(np.int64).tobytes()})
    release()
    return pa.Table.from_pylist(rows, schema=pa.schema([("block", pa.int64()), ("lang", pa.string()), ("codes", pa.binary()),
                                                        ("ids", pa.binary())]))


def semi_joined(relation: DataFrame, met: DataFrame, apply, names: list | None = None) -> DataFrame:
    """The relation with the frequent phrases only, whose places ``met`` has."""
    spots = met.filter("block IS NOT NULL").select(F.col("block").alias("held_by"), "spots", "ids")
    return dealt(relation.groupBy("block").cogroup(spots.groupBy("held_by")).applyInArrow(apply, RELATION), names)


def word_phrases(met: DataFrame) -> DataFrame:
    """(id, lang, phrase, last, f, heads, tails) of the frequent words."""
    none = F.array().cast("array<long>")
    return met.filter("f IS NOT NULL").select("id", "lang", "phrase", F.col("phrase").alias("last"), "f", none.alias("heads"),
                                              none.alias("tails"))


def longer_phrases(counts: DataFrame, shorter: DataFrame, words: int) -> DataFrame:
    """The same of phrases one word longer, from (id, left, right, f): ``left`` and ``right`` are what they overlap in.

    ``heads`` are the counts of a phrase's first 1, 2, ... words, ``tails`` of its last 1, 2, ... words.
    """
    first = shorter.select(F.col("id").alias("left"), "lang", F.col("phrase").alias("start"),
                           F.concat("heads", F.array("f")).alias("heads"))
    second = shorter.select(F.col("id").alias("right"), "last", F.concat("tails", F.array("f")).alias("tails"))
    found = counts.join(first, "left").join(second, "right")
    return saved(found.select("id", "lang", F.concat_ws(" ", "start", "last").alias("phrase"), "last", "f", "heads", "tails",
                              "left", "right"), f"phrases-{words}")


def scored(phrases: DataFrame, words: int) -> DataFrame:
    """Adds l, r and score of the lowest-scoring cut; equal scores go to the earlier cut."""
    def big(c):
        return c.cast(T.DecimalType(16, 0)).cast(T.DecimalType(38, 0))
    a = big(F.col("f"))
    cuts = []
    for k in range(1, words):
        left, right = F.col("heads")[k - 1], F.col("tails")[words - k - 1]
        product = (big(left) * big(right)).cast(T.DecimalType(38, 0))
        top = (F.lit(SCORE_SCALE).cast(T.DecimalType(7, 0)) * a.cast(T.DecimalType(16, 0))).cast(T.DecimalType(22, 0)) \
            * a.cast(T.DecimalType(16, 0))
        cuts.append((top.cast(T.DecimalType(38, 0)), product, left, right))
    row = phrases
    for k, (top, product, _, _) in enumerate(cuts):
        row = row.withColumns({f"_top{k}": top, f"_by{k}": product})
    each = [F.struct(F.expr(f"_top{k} div _by{k}").alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))
            for k, (_, _, left, right) in enumerate(cuts)]
    best = F.array_min(F.array(*each))
    return row.withColumn("_best", best).select("id", "lang", "phrase", "f", F.col("_best.l").alias("l"),
                                                F.col("_best.r").alias("r"), F.col("_best.score").alias("score"))


def uncontained(phrases: DataFrame, longer: DataFrame, share: int = CONTAINED) -> DataFrame:
    """Phrases that no candidate one word longer nearly equals in count (longer ones still are no more frequent)."""
    around = longer.select(F.explode(F.array("left", "right")).alias("id"), F.col("f").alias("_longer")) \
        .groupBy("id").agg(F.max("_longer").alias("_longer"))
    return phrases.join(around, "id", "left").filter(F.col("_longer").isNull() | (100 * F.col("_longer") < share * F.col("f"))) \
        .drop("_longer")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS,
                 min_count: int = MIN_COUNT, share: int = CONTAINED, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    names: list[str] = []
    raw = occurrences(docs, text_col, lang_col, names)
    totals = raw.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, c: s + c)).alias("n"))
    totals = saved(totals, "phrase-totals")
    spot = F.col("block") * F.lit(1 << SPOT_BITS)
    held = raw.select("lang", spot.alias("first"), F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w")) \
        .select("lang", F.col("w.words").alias("phrase"), (F.col("first") + F.col("at")).alias("place"), F.col("w.counts").alias("n"))
    met = frequent(held, ["lang", "phrase"], min_count, "phrases-1")
    levels = [word_phrases(met)]
    relation = semi_joined(raw.select("block", "lang", "codes"), met, _kept_words, names)
    for words in range(2, max_words):
        met = frequent(pairs(relation), ["left", "right"], min_count, f"phrase-counts-{words}")
        levels.append(longer_phrases(met.filter("f IS NOT NULL"), levels[-1], words))
        relation = semi_joined(relation, met, _kept_pairs, names)
    counts = pairs(relation).groupBy("left", "right").agg(F.sum("n").alias("f")).filter(F.col("f") >= min_count)
    levels.append(longer_phrases(counts.withColumn("id", F.monotonically_increasing_id()), levels[-1], max_words))
    for name in names:      # all that is read from here on is in the tables of phrases
        docs.sparkSession.sql(f"DROP TABLE {name}")
    found = None
    for words in range(2, max_words + 1):
        rows = scored(levels[words - 1], words)
        if words < max_words:
            rows = uncontained(rows, levels[words], share)
        found = rows if found is None else found.unionByName(rows)
    order = [F.desc("score"), F.desc("f"), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    some = found.withColumn("_at", F.row_number().over(W.partitionBy("lang", part).orderBy(*order))).filter(F.col("_at") <= top)
    ranked = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("f").alias("a"),
                                              "l", "r", "n", "score")


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH piece AS (
  SELECT row_number() OVER () AS p, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS body
  FROM documents),
words AS MATERIALIZED (SELECT lang, list_filter(regexp_split_to_array(body, '[ \t]+'), lambda w: w <> '') AS w FROM piece),
total AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
f AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS f FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM words, (VALUES (1), (2), (3)) AS size(k) WHERE len(w) >= k)
  GROUP BY lang, k, phrase HAVING count(*) >= 10),
cut AS (
  SELECT c.lang, c.k, c.phrase, c.f AS a, j, l.f AS l, r.f AS r,
         CAST((1000000::HUGEINT * c.f * c.f) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j, string_split(phrase, ' ') AS w FROM f WHERE k > 1) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:j], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j + 1:c.k], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
gone AS (
  SELECT DISTINCT b.lang, b.phrase FROM f t, (VALUES (1), (2)) AS s(j), best b
  WHERE t.k = 3 AND b.k = 2 AND b.lang = t.lang AND b.phrase = array_to_string(list_slice(string_split(t.phrase, ' '), s.j, s.j + 1), ' ')
    AND 100 * t.f >= 50 * b.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best ANTI JOIN gone USING (lang, phrase))
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
