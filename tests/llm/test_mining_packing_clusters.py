"""Collocations, packing and centroid clustering against plain versions."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from cohortlens.llm import centroids, collocations, packing
from cohortlens.llm.common import work_dir
from cohortlens.llm.token_output import tokenizer_path
from tests.llm.fixtures import CLASH, EDGE, documents, prose


# --- collocations ---------------------------------------------------------------

def plain_collocations(rows, max_words=3, min_count=10, share=50, top=2000):
    counts, totals = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = tuple(w for w in re.split("[ \t]", piece) if w)
            totals[lang] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, words[i:i + k]] += 1
    found = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= min_count}
    gone = set()
    for (lang, words), a in found.items():
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1):
                inner = words[i:j]
                if 1 < len(inner) < len(words) and 100 * a >= share * found[lang, inner]:
                    gone.add((lang, inner))
    out = []
    for lang in totals:
        ranked = []
        for (its, words), a in found.items():
            if its == lang and (its, words) not in gone:
                cuts = [(10**6 * a * a // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
                score, k = min(cuts)
                ranked.append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def phrase_rows():
    rnd, rows = random.Random(5), []
    for k in range(60):
        parts = []
        for _ in range(30):
            w = [rnd.choice(["Alpha", "beta", "gamma", "Émile", "x", "of", "the"]) for _ in range(rnd.randint(1, 7))]
            if rnd.random() < 0.3:
                w += ["New", "York", "City"]
            if rnd.random() < 0.2:
                w += ["ha", "ha", "ha", "ha"]
            parts.append(rnd.choice([" ", "  ", "\t"]).join(w) + rnd.choice([".", ",", "!?", "\n", "; ", " "]))
        rows.append((k, "".join(parts), rnd.choice(["en", "de", None, "und"]), "s"))
    return rows + [(*r, "en", "s") for r in EDGE if len(r[1] or "") < 9000] + [(77, "a" * 50_000 + " b " * 2000, "xx", "s")]


@pytest.mark.parametrize("words", [2, 3, 5])
def test_collocations_equal_plain(spark, words, monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 3000)
    rows = phrase_rows()
    got = collocations.collocations(documents(spark, rows).repartition(3), max_words=words, top=40)
    assert sorted(map(tuple, got.collect())) == plain_collocations([(r[1], r[2]) for r in rows], words, top=40)


def test_groups_may_span_batches():
    import pyarrow as pa
    rnd = random.Random(4)
    rows = sorted((rnd.randint(0, 3), rnd.randint(0, 2), place, rnd.randint(1, 3)) for place in (x << 20 for x in rnd.sample(range(1000), 90)))
    counts, first = collections.Counter(), {}
    for left, right, place, n in rows:
        counts[left, right] += n
        first[left, right] = min(first.get((left, right), place), place)
    want = {(place, first[left, right]) for left, right, place, _ in rows if counts[left, right] >= 16}
    for size in (1, 2, 7, 90):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[a:a + size])],
                                              names=["left", "right", "place", "n"]) for a in range(0, 90, size)]
        got = [r for b in collocations._met(["left", "right"], ["long", "long"], 16)(iter(batches)) for r in b.to_pylist()]
        places = [((r["block"] << collocations.SPOT_BITS) + int(spot), int(i)) for r in got if r["block"] is not None
                  for spot, i in zip(np.cumsum(collocations._unsqueezed(r["spots"], np.int32)),
                                     collocations._unsqueezed(r["ids"], np.int64), strict=True)]
        assert set(places) == want and len(places) == len(want)
        named = [r for r in got if r["block"] is None]
        assert {(r["left"], r["right"], r["id"], r["f"]) for r in named} == {
            (*k, first[k], n) for k, n in counts.items() if n >= 16} and len(named) == len({r["id"] for r in named})
        assert all(r["f"] is None and r["left"] is None for r in got if r["block"] is not None)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(documents(spark, [(1, "a")]).limit(0)).count() == 0
    assert collocations.collocations(documents(spark, [(1, None), (None, " \n"), (2, "one two")])).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 3_037_000_501_123, 4_611_686_018_427, 9_007_199_254_740_993
    rows = spark.createDataFrame([(1, "en", "x y", a, [left], [right])],
                                 "id long, lang string, phrase string, f long, heads array<long>, tails array<long>")
    assert collocations.scored(rows, 2).first().score == 10**6 * a * a // (left * right)


def test_equal_cuts_go_to_the_first(spark):
    rows = spark.createDataFrame([(1, "en", "x y z", 10, [20, 40], [20, 40])],
                                 "id long, lang string, phrase string, f long, heads array<long>, tails array<long>")
    r = collocations.scored(rows, 3).first()
    assert (r.l, r.r, r.score) == (20, 40, 125_000)


# --- packing ----------------------------------------------------------------------

@pytest.mark.parametrize("capacity", [4096, 64, 100])
def test_rest_cuts(capacity):
    for n, sizes in enumerate(packing.rest_cuts(capacity)):
        assert sum(sizes) == n and all(sizes)
        for s in sizes:
            assert capacity - (capacity // s) * s <= max(capacity // 128, math.isqrt(capacity))


def check_packed(spark, rows, capacity=4096, partitions=5):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    docs = documents(spark, rows).repartition(partitions)
    path = packing.pack(docs, work_dir(spark, "test-packed"), tokenizer_path(), capacity=capacity)
    got = packing.packed_pieces(spark, path).collect()
    want = collections.Counter()
    for r in rows:
        ids = np.array(tok.encode(r[1] or "", add_special_tokens=False).ids + [packing.END_ID], "<u4")
        want[r[0], len(ids), zlib.crc32(ids.tobytes())] += 1
    # The pieces, in order of their starts, are the documents again (ids by document from the sequences).
    seqs = {r.sequence_id: np.frombuffer(r.ids, f"<u{r.width}") for r in packing.sequences(spark, path).collect()}
    fill, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for p in got:
        part = seqs[p.sequence_id][p.offset:p.offset + p.length].astype("<u4")
        assert len(part) == p.length and zlib.crc32(part.tobytes()) == p.ids_crc32
        fill[p.sequence_id].append((p.offset, p.length))
        by_doc[p.doc_id, p.doc_tokens].append((p.start, part))
    for s, spans in fill.items():
        end = 0
        for offset, n in sorted(spans):
            assert offset == end
            end += n
        assert end == len(seqs[s]) <= capacity
        assert len(packing.padded(seqs[s], capacity)) in (capacity, end)
    assert sorted(seqs) == list(range(len(seqs))) and set(fill) == set(seqs)
    found = collections.Counter()
    for (doc_id, n), parts in by_doc.items():
        starts = collections.defaultdict(list)
        for start, part in parts:
            starts[start].append(part)
        for _ in range(len(starts[0])):      # equal documents may be cut at different places
            whole, at = [], 0
            while at < n:
                whole.append(starts[at].pop())
                at += len(whole[-1])
            found[doc_id, n, zlib.crc32(np.concatenate(whole).tobytes())] += 1
        assert not any(starts.values())
    assert found == want
    total = sum(map(len, seqs.values()))
    return sum(len(packing.padded(x, capacity)) - len(x) for x in seqs.values()) / total


def test_packing_edge_documents(spark):
    check_packed(spark, EDGE)


def test_packing_small_capacity_many_workers(spark):
    rows = [(i, prose(i, i % 37 + 1)) for i in range(300)] + [(1000, prose(9, 4000))]
    assert check_packed(spark, rows, capacity=64, partitions=70) < 0.1     # three levels of hand-over


def test_packing_pads_little(spark):
    rows = [(i, prose(i, 40 + 13 * (i % 50))) for i in range(200)]
    assert check_packed(spark, rows) < 0.01


def test_packing_of_nothing(spark):
    path = packing.pack(documents(spark, EDGE).limit(0), work_dir(spark, "test-packed"), tokenizer_path())
    assert packing.packed_pieces(spark, path).count() == 0


# --- centroids --------------------------------------------------------------------

def plain_clusters(rows, dim, k, rounds, scale=1024):
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), i, v) for i, v in kept if i is not None)
    cents = [v for _, _, v in named[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents)) for _, v in kept]
    for _ in range(rounds):
        who = assign()
        for n in range(len(cents)):
            own = [v for (_, v), (_, m) in zip(kept, who) if m == n]
            if own:
                cents[n] = [sum(col) // len(own) for col in zip(*own)]
    who = assign()
    inertia = collections.Counter()
    for d, n in who:
        inertia[n] += d
    total = sum(inertia.values())
    return sorted(((i, n, d, inertia[n], total, hashlib.sha256(",".join(map(str, cents[n])).encode()).hexdigest())
                   for (i, _), (d, n) in zip(kept, who)), key=repr)


def vector_table(spark, rows):
    return spark.createDataFrame([(i, v, *["x"] * len(CLASH)) for i, v in rows],
                                 "vec_id long, embedding array<double>, " + ", ".join(f"{c} string" for c in CLASH))


def hostile_vectors(dim, n=300):
    rnd = random.Random(3)
    centres = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(5)]
    rows = [(i, [c + rnd.gauss(0, 0.3) for c in rnd.choice(centres)]) for i in range(n)]
    rows += [(n, [0.0] * dim), (n, [0.0] * dim), (n + 1, [-1e-9] * dim), (n + 2, [100_000.0] * dim), (None, [0.5] * dim)]
    return rows + [(n + 3, None), (n + 4, []), (n + 5, [0.1] * (dim + 1)), (n + 6, [None] + [0.1] * (dim - 1)),
                   (n + 7, [float("nan")] + [0.1] * (dim - 1)), (n + 8, [float("inf")] * dim), (n + 9, [float("-inf")] * dim)]


@pytest.mark.parametrize("dim,lead,k", [(64, 12, 8), (64, 1, 8), (3, 12, 20)])
def test_clusters_equal_plain(spark, dim, lead, k):
    rows = hostile_vectors(dim)
    log = []
    got = centroids.centroid_clusters(vector_table(spark, rows).repartition(5), dim=dim, k=k, rounds=4, lead=lead, log=log)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_clusters(rows, dim, k, 4)
    assert all(measured < rows * k for measured, rows in log)           # the bound passes centroids by


def test_clusters_of_few_and_none(spark):
    rows = [(5, [1.0, 2.0]), (6, [1.0, 2.0]), (None, [3.0, 4.0])]
    got = centroids.centroid_clusters(vector_table(spark, rows), dim=2)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_clusters(rows, 2, 8, 10)
    assert centroids.centroid_clusters(vector_table(spark, rows), dim=3).count() == 0
    assert centroids.centroid_clusters(vector_table(spark, rows).limit(0), dim=2).count() == 0


def test_too_large_a_component_raises(spark):
    with pytest.raises(Exception, match="beyond"):
        centroids.centroid_clusters(vector_table(spark, [(1, [1e6, 0.0])]), dim=2).collect()


def test_bound_never_passes_the_nearest_by():
    rnd = np.random.default_rng(1)
    x = rnd.integers(-2**27, 2**27, (500, 16))
    x[250:] = x[0] + rnd.integers(-2, 3, (250, 16))                      # near ties at large sizes
    axes, _ = np.linalg.qr(rnd.normal(size=(16, 16)))
    mean, cents = x.mean(0), x[[0, 260, 270, 280, 1, 2]]
    lead, rest = centroids._rotated(x.astype(float), mean, axes[:, :5])
    clead, crest = centroids._rotated(cents.astype(float), mean, axes[:, :5])
    who, dist, measured = centroids.nearest(x, lead, rest, cents, clead, crest)
    plain = ((x[:, None] - cents) ** 2).sum(2)
    assert (dist == plain.min(1)).all() and (who == plain.argmin(1)).all() and measured < plain.size
