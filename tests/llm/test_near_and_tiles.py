"""Operators 2 and 8 against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from cohortlens.llm import decontaminate as DC
from cohortlens.llm import minhash_dedup as MH
from cohortlens.llm.components import connected_components
from tests.llm.fixtures import EDGE, documents, prose


def shingles(text, size):
    w = "".join(c.lower() if c.isascii() else c for c in (text or "")).split()
    return frozenset(tuple(w[k:k + size]) for k in range(len(w) - size + 1)) if len(w) >= size \
        else frozenset([tuple(w)] if w else [])


def brute_components(rows, size, percent):
    ids = sorted({i for i, _ in rows if i is not None})
    sets = {i: shingles(t, size) for i, t in rows}
    up = {i: i for i in ids}

    def root(a):
        while up[a] != a:
            a = up[a]
        return a
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}, sets


def edited(words, edits, r):
    w = list(words)
    for k in r.sample(range(len(w)), edits):
        w[k] = "q" + w[k]
    return " ".join(w)


@pytest.mark.parametrize("tile", [512, 6])
def test_near_components(spark, tile):
    r = random.Random(3)
    base = prose(50, 120).split()
    rows = EDGE + [(100 + k, edited(base, r.randint(0, 7), r)) for k in range(60)]
    rows += [(300 + k, prose(300 + k, 40)) for k in range(30)] + [(400, rows[20][1].upper())]
    want, sets = brute_components(rows, 3, 85)
    got = {x.doc_id: x for x in MH.near_components(documents(spark, rows), size=3, percent=85, tile=tile).collect()}
    assert {i: got[i].component_id for i in want} == want
    assert all(got[i].n_shingles == len(sets[i]) for i in want)
    assert got[None].component_id is None
    kept = {x.doc_id for x in MH.near_dedup(documents(spark, rows), size=3, percent=85).collect()}
    assert kept == {i for i, c in want.items() if i == c} | {None}
    assert MH.near_components(documents(spark, []), size=3).count() == 0


def test_components(spark):
    r = random.Random(1)
    pairs = [(r.randrange(400), r.randrange(400)) for _ in range(260)] + [(1000, k) for k in range(1001, 1200)] + [(5, 5)]
    up = {}

    def root(a):
        up.setdefault(a, a)
        while up[a] != a:
            a = up[a]
        return a
    for a, b in pairs:
        if a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    got = connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()
    assert {x.node: x.root for x in got} == {n: root(n) for n in up} and len(got) == len(up)
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_rows_of_bands():
    assert [MH.rows_for(p) for p in (80, 85)] == [6, 8]


def tiles_by_force(item, doc, least):
    """Longest unmarked common stretch, first in the item, then the document, until none is long enough."""
    im, dm, out = [False] * len(item), [False] * len(doc), []
    while True:
        best = (least - 1, 0, 0)
        for p in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while p + n < len(item) and d + n < len(doc) and item[p + n] == doc[d + n] and not im[p + n] and not dm[d + n]:
                    n += 1
                if n > best[0]:
                    best = (n, p, d)
        n, p, d = best
        if n < least:
            return out
        out.append((p, d, n))
        im[p:p + n] = dm[d:d + n] = [True] * n


def test_tiles_cover_as_much_as_brute_force():
    r = random.Random(2)
    for _ in range(150):
        item = [r.randrange(1, 6) for _ in range(r.randint(1, 30))]
        doc = [r.randrange(1, 6) for _ in range(r.randint(1, 30))] + item[:r.randint(0, 30)]
        assert sorted(DC.tile(item, doc, 3)) == sorted(tiles_by_force(item, doc, 3))


def test_contaminations(spark):
    items = [(k, prose(700 + k, 20 + 3 * k)) for k in range(6)] + [(6, None), (7, ""), (8, "too short"), (9, prose(700, 20)),
                                                                   (9, prose(700, 20))]
    a, b = items[3][1].split(), items[5][1].split()
    rows = EDGE + [
        (100, "before " + items[3][1].upper() + " after"),
        (101, " ".join(a[14:] + ["gap"] + a[:14])),                       # reordered
        (102, " ".join(a[:10])),                                          # a part only
        (103, ", ".join(b) + "!"), (104, prose(8, 30_000) + " " + items[5][1]), (104, prose(8, 30_000) + " " + items[5][1]),
        (105, " ".join(w for x in zip(a, a) for w in x))]
    got = {(x.doc_id, x.item_id): (x.n_words, x.covered, x.tiles) for x in DC.contaminations(
        documents(spark, rows), spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, h string")).collect()}
    tok = lambda t: [x for x in map(DC.bare, (t or "").split()) if x]
    want = {}
    for i, t in rows:
        for k, u in items:
            w = tok(u)
            tiles = DC.tile([hash(x) for x in w], [hash(x) for x in tok(t)], 5) if len(tok(t)) < 5000 or "e" in t else []
            if w and sum(n for _, _, n in tiles) * 100 >= 80 * len(w):
                want[(i, k)] = (len(w), sum(n for _, _, n in tiles), len(tiles))
    assert got == want and {(100, 3), (101, 3), (103, 5), (104, 5)} <= set(got) and not any(i in (102, 105) for i, _ in got)
    assert DC.decontaminate(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")) \
        .filter("doc_id IN (100, 101, 103, 104)").count() == 0
    empty = spark.createDataFrame([], "item_id long, text string")
    assert DC.contaminations(documents(spark, rows), empty).count() == 0
    assert DC.contaminations(documents(spark, []), empty).count() == 0


def test_shingle_sets_equal_plain_sets():
    texts = [t for _, t in EDGE]
    x, offsets = MH.shingle_sets(pa.array(texts), 3)
    assert np.diff(offsets).tolist() == [len(shingles(t, 3)) for t in texts]


def test_decontaminate_judges_documents_without_an_id(spark):
    leak = prose(71, 40)
    items = spark.createDataFrame([(1, leak)], "item_id long, text string")
    rows = [(1, leak), (None, prose(72, 30) + " " + leak), (None, prose(73, 60)), (2, prose(74, 60)), (None, None)]
    got = sorted(((r.doc_id, r.text) for r in DC.decontaminate(documents(spark, rows), items).collect()), key=repr)
    assert got == sorted(rows[2:], key=repr)
