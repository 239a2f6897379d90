"""Operators 3, 5 and 6: exact counts, a proper distribution, held-out quality, marginals."""

import collections
import math
import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import deobfuscate as D
from cohortlens.llm import maxent as ME
from cohortlens.llm import mixing as MX
from cohortlens.llm import toxicity as TX
from tests.llm.fixtures import EDGE, documents, prose


def tokens(text):
    return "".join(c.lower() if c.isascii() else c for c in (text or "")).split() + ["\x00end"]


def test_lm_base_and_gain(spark):
    langs = {"a": ["ka", "lo", "mi"], "b": ["zur", "wex", "quo"]}
    r = random.Random(4)
    rows = EDGE + [(k, " ".join("".join(r.choice(langs["ab"[k % 2]]) for _ in range(r.randint(1, 2))) for _ in range(60)))
                   for k in range(100, 300)]
    got = ME.lm_scores(documents(spark, rows), ~ME.held_out()).collect()
    assert len(got) == len(rows)
    count = collections.Counter()
    for i, t in rows:
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            count.update(tokens(t))
    n, v = sum(count.values()), len(count)
    by = {x.doc_id: x for x in got}
    for i, t in rows:
        x, w = by[i], tokens(t)
        assert (x.n_tokens, x.n_known, x.train_tokens) == (len(w), sum(count[u] > 0 for u in w), n)
        assert x.base_score == pytest.approx(sum(math.log10((count[u] + .5) / (n + .5 * (v + 1))) for u in w))
    held = [x for x in got if x.doc_id and x.doc_id >= 100 and zlib.crc32(str(x.doc_id).encode()) % 5 == 1]
    assert held and sum(x.score for x in held) > sum(x.base_score for x in held)
    assert ME.lm_scores(documents(spark, []), ~ME.held_out()).count() == 0
    untrained = ME.lm_scores(documents(spark, EDGE), F.lit(False)).collect()
    assert len(untrained) == len(EDGE) and all(x.train_tokens == 0 and x.score < 0 for x in untrained)


def test_lm_end_token_is_no_word(spark):
    """A word that is spelled as the tests write the end is counted as a word."""
    rows = [(k, "\x00end a") for k in range(20)]
    got = ME.lm_scores(documents(spark, rows), F.lit(True)).collect()
    want = 3 * math.log10(20.5 / (60 + 0.5 * 4))
    assert all(x.n_tokens == 3 and x.train_tokens == 60 and x.base_score == pytest.approx(want) for x in got)
    assert (ME.hash_words(["\x00end", "a", ""]) >= 0).all() and ME.END < 0


def test_lm_events_sum_to_one():
    """Over all known words and one unknown event per tail class, at one history, with random weights."""
    words = [f"w{k:04d}" for k in range(1200)]
    counts = {w: 1200 - k for k, w in enumerate(words)}
    hashes = dict(zip(words, ME.hash_words(words).tolist()))
    head = {hashes[w]: k for k, w in enumerate(words[:ME.HEAD])}
    n, v = np.zeros(ME.TAILS), np.zeros(ME.TAILS)
    for w in words[ME.HEAD:]:
        k = (ME.suffix_hash(w) & 0xFFFFFF) % ME.TAILS
        n[k] += counts[w]
        v[k] += 1
    shape = ME.Shape(head, np.array([counts[w] for w in words[:ME.HEAD]], float), n, v)
    r = np.random.default_rng(0)
    w1 = r.normal(size=(ME.ROWS1, ME.CLASSES)).astype(np.float32)
    w2 = r.normal(size=(ME.ROWS2, ME.SLOTS)).astype(np.float32)
    run = ME._score(shape, w1, w2, sum(counts.values()), len(words))
    suffixes = {}
    for k in range(676):
        w = f"?{k:04d}{chr(97 + k // 26)}{chr(97 + k % 26)}"
        suffixes.setdefault((ME.suffix_hash(w) & 0xFFFFFF) % ME.TAILS, w)
    unknown = [suffixes[k] for k in range(ME.TAILS)]
    docs = pa.table({"doc_id": list(range(len(words) + ME.TAILS + 1)), "text": [f"w0003 w0700 {w}" for w in words + unknown]
                     + ["w0003 w0700"], "chunk": [0] * (len(words) + ME.TAILS + 1)})
    found = pa.table({"chunk": [0] * len(words), "h": [hashes[w] for w in words], "n": [counts[w] for w in words]})
    score = run(docs, found).column("score").to_numpy()
    # Take away the shared prefix and the end: here by the model's own log P of each token.
    codes, offsets, h, cls, slot, u1, u2 = ME._events(pa.array(docs.column("text").to_pylist()), shape)
    third = offsets[:-1] + 2
    z = ME._logits(w1, ME._features1(u1[third], u2[third]), w1[0])
    p_cls = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    total = 0.0
    for k, w in enumerate(words + unknown):
        c = cls[codes[third[k]]]
        if slot[codes[third[k]]] >= 0:
            zz = ME._logits(w2, ME._features2(np.array([c]), u1[third[k]:third[k] + 1], u2[third[k]:third[k] + 1]))
            inside = (np.exp(zz) / np.exp(zz).sum())[0, slot[codes[third[k]]]]
        else:
            t = c - ME.HEAD // ME.SLOTS
            inside = (counts.get(w, 0) + .5) / (n[t] + .5 * (v[t] + 1))
        total += p_cls[k, c] * inside
    assert total == pytest.approx(1, abs=1e-4) and np.isfinite(score).all()


def test_lm_class_factor_sees_word_pairs():
    """One feature tells the 400 pairs of 20 and 20 words apart (hashed: nearly all of them)."""
    u1, u2 = np.repeat(np.arange(20), 20), np.tile(np.arange(20), 20)
    rows = ME._features1(u1, u2)
    assert max(len(np.unique(r)) for r in rows) > 360 and max(int(r.max()) for r in rows) < ME.ROWS1


def test_lm_tail_words_have_history(spark):
    """Rare words: each follows one other rare word, in a vocabulary beyond the floor of the head."""
    r = random.Random(9)
    names = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(4000)]
    after = dict(zip(names, r.sample(names, len(names))))
    rows = []
    for k in range(1500):
        w = [u for first in r.sample(names, 12) for u in (first, after[first])]
        rows.append((k, " ".join(w)))
    texts = documents(spark, rows).select("text")
    counts = ME.count_table(texts)
    kinds = counts.count()
    shape = ME.shape_of(counts, kinds)
    assert shape.bits >= 5 and shape.leaf_n.sum() + shape.head_n.sum() == sum(len(t.split()) + 1 for _, t in rows)
    assert len(ME.shape_of(counts, 10 ** 6).head_n) > ME.HEAD and ME.shape_of(counts, 10 ** 6).row_bits > ME.LEAST_BITS
    tail = [u for u, h in zip(names, ME.hash_words(names).tolist()) if h not in shape.head]
    # Two tail words, alike in their last letters, are two contexts.
    _, _, _, _, _, u1, _ = ME._events(pa.array(["abcxyzq x", "defxyzq x"]), shape)
    assert u1[1] != u1[4]
    w1, w2 = ME.train_model(texts, shape)
    codes, starts, h, cls, slot, u1, u2 = ME._events(pa.array([f"{names[5]} {w}" for w in tail]), shape)
    paths, leaf = shape.paths(h, cls)
    at = starts[:-1] + 1
    gained = 0.0
    for tokens_, rows_, met, offset in ME._word_steps(shape, paths, shape.offsets(), codes[at], cls, slot, u1[at], u2[at]):
        z = ME._logits(w2, rows_, offset)
        p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
        assert p.sum(1) == pytest.approx(1, abs=1e-4)
        flat = np.exp(offset)
        gained = max(gained, float(np.abs(p - flat / flat.sum(1, keepdims=True)).max()))
    assert gained > 0.01
    # All known words and one unknown event a leaf, at one history: the events sum to 1.
    n = {r["h"]: r["n"] for r in counts.collect()}
    words = names + ["\x00end"]
    hs = np.append(ME.hash_words(names), ME.END)
    seen = np.array([n.get(x, 0) for x in hs.tolist()])
    real = seen > 0
    one = np.zeros(1, np.int64) + 77
    z = ME._logits(w1, ME._features1(one, one, shape.row_bits), w1[0])[0]
    p_class = np.exp(z) / np.exp(z).sum()
    p_leaf = p_class[shape.heads:].copy()
    first = shape.heads
    for table in shape.offsets():
        node = np.arange(len(table))
        rows_ = ME._features2(first + node, np.repeat(one, len(node)), np.repeat(one, len(node)), shape.heads, shape.row_bits)[1:]
        z = ME._logits(w2, rows_, table)
        p_leaf = (p_leaf[:, None] * np.exp(z) / np.exp(z).sum(1, keepdims=True))[:, table[0] > -1e3].ravel()
        first += len(table)
    in_leaf = (shape.leaf_n + 0.5 * shape.leaf_v + 0.5) / shape.mass()
    assert p_class[:shape.heads].sum() + (p_leaf * in_leaf).sum() == pytest.approx(1, abs=1e-4)
    assert len(words) == len(hs) and real.all()


def test_lm_step_is_the_plain_step():
    """Rows met once, often and very often, in a full softmax with a bias row and in a narrow level."""
    r = np.random.default_rng(3)
    rows = [np.concatenate([np.zeros(60, int), r.integers(1, 9, 80), np.arange(9, 49)]) + k * 50 for k in range(2)]
    for width, bias, offset in ((ME.SLOTS, 0, None), (4, None, np.where(np.arange(ME.SLOTS) < 4, 0.1, -1e4)[None].repeat(180, 0)
                                                      .astype(np.float32))):
        w = r.normal(size=(101, ME.SLOTS)).astype(np.float32)
        target = r.integers(0, width, 180)
        got, seen, used = w.copy(), np.ones_like(w), np.zeros(101)
        ME._step(got, seen, used, rows, target, bias, offset)
        z = sum(w[x].astype(float) for x in rows) + (w[0] if bias == 0 else offset)
        g = np.exp(z - z.max(1, keepdims=True))
        g /= g.sum(1, keepdims=True)
        g[np.arange(180), target] -= 1
        want, n, times = w.astype(float), np.ones(w.shape), np.zeros(101)
        for x in rows:
            total = np.zeros(w.shape)
            np.add.at(total, x, g)
            n += total ** 2
            want -= ME.RATE * total / np.sqrt(n)
            times += np.bincount(x, minlength=101)
        if bias == 0:
            n[0] += g.sum(0) ** 2
            want[0] -= ME.RATE * g.sum(0) / np.sqrt(n[0])
            times[0] += 180
        assert got == pytest.approx(want, abs=1e-4) and seen == pytest.approx(n, rel=1e-4) and (used == times).all()


def test_lm_contexts_are_scored_once():
    """Every token is in one minibatch, with a token of its own context."""
    r = np.random.default_rng(5)
    u1, u2 = r.integers(0, 200, 30_000), r.integers(0, 200, 30_000)
    met = []
    for tokens_, owner, one in ME._by_context(u1, u2):
        assert (u1[one][owner] == u1[tokens_]).all() and (u2[one][owner] == u2[tokens_]).all() and len(one) <= ME.BATCH
        assert len(set(zip(u1[one], u2[one]))) == len(one)
        met.append(tokens_)
    assert sorted(np.concatenate(met).tolist()) == list(range(30_000))


def test_lm_changes_are_small(spark):
    """What a task returns: a byte a weight at most, and tasks by the texts' bytes, not by the table's partitions."""
    change = np.random.default_rng(2).normal(size=(500, 68)).astype(np.float32)
    raw = ME._packed(change)
    assert len(raw) < 1.1 * change.size + 4 * len(change)
    assert np.abs(ME._unpacked(raw, 500, 68) - change).max() <= np.abs(change).max() / 253
    texts = documents(spark, [(k, prose(k, 20)) for k in range(300)]).select("text").repartition(40)
    counts = ME.count_table(texts)
    shape = ME.shape_of(counts, counts.count())
    seen = []
    before = type(texts).mapInArrow
    try:
        type(texts).mapInArrow = lambda self, *a, **k: seen.append(self.rdd.getNumPartitions()) or before(self, *a, **k)
        ME.train_model(texts, shape)
    finally:
        type(texts).mapInArrow = before
    assert seen and max(seen) <= ME.LEAST_TASKS


TOXIC = ["moron", "stupid", "pathetic"]


def toxic_rows(n=900):
    r = random.Random(6)
    rows, labels = [], {}
    for k in range(n):
        w = prose(2000 + k, r.randint(20, 80)).split()
        labels[k] = int(k % 6 == 0)
        if labels[k]:
            w.insert(r.randrange(len(w)), r.choice(TOXIC))
        rows.append((k, " ".join(w)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = toxic_rows()
    # One toxic document in many copies must not make its ordinary words evidence.
    rows += [(5000 + k, prose(1, 40) + " moron") for k in range(40)]
    labels.update({5000 + k: 1 for k in range(40)})
    hidden = {6000: "m0r0n", 6001: "stuuupid!", 6002: "p@thet1c,", 6003: "s.t.u.p.i.d", 6004: "M O R O N", 6005: "st*pid", 6006: "$tup1d"}
    rows += [(i, f"{prose(i, 30)} {w} {prose(i + 50, 30)}") for i, w in hidden.items()]
    rows += [(7000 + k, prose(7000 + k, 50)) for k in range(60)] + [(7100, prose(1, 40)), (7101, None), (7102, ""), (None, "moron")]
    table = spark.createDataFrame([(i, 1, t) for i, t in labels.items()] + [(99_999, 1, 1), (3, 1, None)],
                                  "doc_id long, quality int, toxic int")
    got = {x.doc_id: x.score for x in TX.toxicity_scores(documents(spark, rows), table, ~TX.held_out()).collect()}
    assert len(got) == len(rows) and all(0 <= s <= 1 for s in got.values())
    for i, t in labels.items():
        assert (got[i] >= TX.THRESHOLD) == bool(t), i
    assert all(got[i] >= TX.THRESHOLD for i in hidden) and got[None] >= TX.THRESHOLD
    assert all(got[i] < TX.THRESHOLD for i in [*range(7000, 7060), 7100, 7101, 7102])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {x.score for x in TX.toxicity_scores(documents(spark, EDGE), none).collect()} == {0.5}
    assert TX.toxicity_scores(documents(spark, []), table).count() == 0


def test_toxicity_restores_words_of_mostly_signs(spark):
    evidence = ["moron", "stupid", "idiot", "clown"]
    rows, labels = [], {}
    for k in range(900):
        labels[k] = int(k % 6 == 0)
        rows.append((k, prose(2000 + k, 30) + (" " + evidence[k // 6 % 4] if labels[k] else "")))
    hidden = ["1d10t", "$+up1d", "m..o..r..o..n", "i..d..i..o..t", "(lown", '"(lown".']
    rows += [(6000 + k, f"{prose(k, 30)} {w} {prose(k + 50, 30)}") for k, w in enumerate(hidden)]
    rows += [(7000 + k, f"{prose(k, 30)} {w}") for k, w in enumerate(["1010", "+10.10", "$100", "(see", "!!!", "***", "(", "5:10"])]
    table = spark.createDataFrame([(i, t) for i, t in labels.items()], "doc_id long, toxic int")
    got = {x.doc_id: x.score for x in TX.toxicity_scores(documents(spark, rows), table, ~TX.held_out()).collect()}
    assert [w for k, w in enumerate(hidden) if got[6000 + k] < TX.THRESHOLD] == []
    assert all(got[7000 + k] < TX.THRESHOLD for k in range(8))


def test_restoring_is_linear():
    """A token of 200,000 characters, alike or not, takes seconds."""
    log_p = D.log_model(D.trigram_counts(["moron", "the"], np.full(2, 50)))
    r = random.Random(2)
    began = time.time()
    assert len(D.restore("x" * 200_000, log_p)) < 200_000
    assert len(D.restore("".join(r.choice("abcde13") for _ in range(200_000)), log_p)) > 100_000
    assert time.time() - began < 60


def test_spelled_runs_of_any_length(spark):
    """Words of more than 24 spaced letters; long runs; every stretch as restored alone."""
    long = "incontrovertiblemoronishness"
    log_p = D.log_model(D.trigram_counts(["moron", "the", long], np.full(3, 50)))
    assert long in set(TX.run_forms(f"xy{long}z", log_p, len(long)))
    assert "moron" in set(TX.run_forms("the" + "m0r0n" + "xy", log_p, 7))
    assert "moron" in set(TX.run_forms("m-" + "." * 50 + "o-ron", log_p, 7))
    letters = "".join(random.Random(1).choice("abcde") for _ in range(50_000))
    assert sum(1 for _ in TX.run_forms(letters, log_p, 9)) <= 7 * len(letters)
    rows, labels = toxic_rows()
    rows = [(i, t + (f" {long}" if labels[i] else "")) for i, t in rows] + [(6000, f"{prose(1, 30)} {' '.join(long)} {prose(2, 30)}")]
    rows += [(6001, f"{prose(1, 30)} {' '.join('a1' * 400)}"), (6002, " ".join("." * 2000 + "x" * 2000))]
    table = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    got = {x.doc_id: x.score for x in TX.toxicity_scores(documents(spark, rows), table).collect()}
    assert got[6000] >= TX.THRESHOLD > max(got[6001], got[6002])


def test_viterbi_finds_the_best_path():
    words = ["moron", "stupid", "idiot", "clown", "the", "and", "letter", "hello"]
    log_p = D.log_model(D.trigram_counts(words, np.full(len(words), 50)))

    def force(steps):
        best = ("", -math.inf)
        stack = [(0, "", 0.0)]
        while stack:
            k, out, cost = stack.pop()
            if k == len(steps):
                s, a, b = -cost, D.EDGE, D.EDGE
                for c in [*(D.CODE.get(x, D.OTHER) for x in out), D.EDGE]:
                    s += float(log_p[a, b, c])
                    a, b = b, c
                best = max(best, (out, s), key=lambda x: x[1])
            else:
                stack += [(k + 1, out + x, cost + c) for x, c in steps[k]]
        return best
    for w in ("m0r0n", "1d10t", "stuuupid", "c.l.0.w.n", "h3ll0o0", "l3tterrr", "$tup!d"):
        got, want = D.viterbi(D.lattice(w), log_p), force(D.lattice(w))
        assert got[1] == pytest.approx(want[1]) and got[0] == want[0]
        assert D.viterbi_ends(D.lattice(w), log_p)[-1] == want[0]
    assert [D.restore(w, log_p) for w in ("m0r0n", "1d10t", "stuuupid", "cl0wn", "l3tter")] == ["moron", "idiot", "stupid", "clown", "letter"]


def test_mixing_tells_of_targets_that_disagree(spark):
    """Source a alone holds language x, but is to have less than x."""
    cells = spark.createDataFrame([("a", "x", "t", 10), ("b", "y", "t", 10)], "source string, lang string, topic string, tokens long")
    def shares(**of):
        return spark.createDataFrame(list(of.items()), "value string, target double")
    with pytest.warns(UserWarning, match="off by 0.4"):
        MX.rake(cells, {"source": shares(a=0.1, b=0.9), "lang": shares(x=0.5, y=0.5), "topic": shares(t=1.0)})


def test_mixing_goes_on_to_the_targets(spark, recwarn):
    """Targets that are met slowly (cells near the diagonal), and a value whose cells are all empty."""
    cells = spark.createDataFrame([("a", "x", "t", 480), ("a", "y", "t", 20), ("b", "x", "t", 20), ("b", "y", "t", 480)],
                                  "source string, lang string, topic string, tokens long")
    def shares(**of):
        return spark.createDataFrame(list(of.items()), "value string, target double")
    targets = {"source": shares(a=0.55, b=0.45), "lang": shares(x=0.48, y=0.52), "topic": shares(t=1.0)}
    got = MX.rake(cells, targets).collect()
    assert not [w for w in recwarn if "mixing targets" in str(w.message)]
    assert sum(r.share for r in got if r.source == "a") == pytest.approx(0.55, abs=1e-5)
    assert sum(r.share for r in got if r.lang == "x") == pytest.approx(0.48, abs=1e-5)
    empty = cells.union(spark.createDataFrame([("c", "x", "t", 0)], cells.schema))
    with pytest.warns(UserWarning, match="can't be met together"):
        MX.rake(empty, {**targets, "source": shares(a=0.5, b=0.4, c=0.1)})


def test_mixing(spark):
    r = random.Random(8)
    rows = [(k, prose(k, r.randint(1, 40)), r.choice(["en", "de"]), "big" if k % 3 else r.choice("xyz")) for k in range(400)]
    rows += [(500, None, None, None), (501, "", "en", "x"), (399, rows[399][1], rows[399][2], rows[399][3])]
    docs = documents(spark, rows)
    got = MX.mix(docs, keep=0.5).collect()
    assert len(got) == len(rows)
    total = sum(x.tokens for x in got)
    for d in MX.DIMS:
        seen, raked = collections.Counter(), collections.Counter()
        for x in got:
            seen[x[d]] += x.tokens
            raked[x[d]] += x.tokens * x.weight / total
        power = {k: n ** MX.TEMPER for k, n in seen.items() if n}
        for k in power:
            assert raked[k] == pytest.approx(power[k] / sum(power.values()), abs=1e-5)
    assert sum(x.tokens * x.probability for x in got) == pytest.approx(0.5 * total, rel=1e-6)
    scale = max(x.probability / x.weight for x in got)
    assert all(x.probability == pytest.approx(min(1.0, scale * x.weight)) for x in got if x.tokens)
    import hashlib
    for x in got:
        u = int(hashlib.md5(str("" if x.doc_id is None else x.doc_id).encode()).hexdigest()[:13], 16) / 2**52
        assert x.sampled == (u < x.probability)
    given = {"source": spark.createDataFrame([("big", 0.9), ("x", 0.1), ("none", 0.5)], "value string, target double")}
    some = MX.mix(docs, given).collect()
    assert sum(x.tokens * x.weight for x in some if x.source == "big") == pytest.approx(0.9 * total, rel=1e-4)
    assert all(x.weight == 0 for x in some if x.source in "yz" and x.source and x.tokens)
    assert MX.mix(documents(spark, [])).count() == 0


def _topics_plainly(texts):
    """Topic of each text: every step of the definition, one text after the other."""
    import hashlib
    import xxhash
    bags = []
    for t in texts:
        n = collections.Counter(xxhash.xxh3_64_intdigest(w) % MX.BUCKETS
                                for w in (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split())
        bags.append({b: round(16 + 16 * math.log(c)) for b, c in n.items()})
    held = collections.Counter(b for bag in bags for b in bag)
    vectors = []
    for bag in bags:
        v = [0.0] * MX.WIDTH
        for b in sorted(bag):
            mixed = (b * 0x9E3779B97F4A7C15 % 2 ** 64) >> 40
            v[mixed % MX.WIDTH] += bag[b] * math.log((len(texts) + 1) / (held[b] + 0.5)) * (-1 if mixed >> 16 & 1 else 1)
        length = math.sqrt(sum(x * x for x in v))
        vectors.append([round(x * MX.LENGTH / length) if length else 0 for x in v])
    distinct = {bytes(x % 256 for x in v): v for v in vectors if any(v)}
    centroids = [distinct[k] for k in sorted(distinct, key=lambda k: hashlib.md5(k).digest())[:MX.TOPICS]]

    def nearest(v):
        return max(range(len(centroids)), key=lambda k: (sum(a * b for a, b in zip(v, centroids[k])), -k))
    for _ in range(MX.TOPIC_ROUNDS):
        sums = [[0] * MX.WIDTH for _ in centroids]
        for v in vectors:
            if any(v):
                k = nearest(v)
                sums[k] = [a + b for a, b in zip(sums[k], v)]
        centroids = [[round(MX.SCALE * x / math.sqrt(sum(y * y for y in s))) for x in s] if any(s) else c
                     for s, c in zip(sums, centroids)]
    return [f"t{nearest(v)}" if any(v) else "" for v in vectors]


def test_topics_come_from_the_words(spark):
    r = random.Random(3)
    pools = [[f"{name}{k}" for k in range(40)] for name in ("ship", "tax", "gene")]
    texts = [" ".join(r.choices(pools[k % 3], k=60)) for k in range(240)]
    rows = [(k, t, "en", "s") for k, t in enumerate(texts)] + [
        (900, None, None, None), (901, " \t\n", "en", "s"), (902, texts[0], "en", "s"), (None, texts[1], "en", "s"),
        (903, texts[2].upper(), "en", "s"), (904, " ".join(texts * 5), "en", "s"), (904, texts[0], "en", "s")]
    got = {(x.doc_id, x.tokens, x.topic) for x in MX.features(documents(spark, rows)).collect()}
    other = {(x.doc_id, x.tokens, x.topic) for x in MX.features(documents(spark, rows[::-1]).repartition(7)).collect()}
    want = _topics_plainly([x[1] for x in rows])
    assert got == other == {(x[0], len((x[1] or "").split()), t) for x, t in zip(rows, want)}
    by_pool = collections.defaultdict(collections.Counter)
    for k in range(240):
        by_pool[want[k]][k % 3] += 1
    assert all(len(c) == 1 for c in by_pool.values())          # no topic holds texts of two vocabularies
    empty = MX.features(documents(spark, [(1, None), (2, "")])).collect()
    assert {x.topic for x in empty} == {""} and len(empty) == 2
    assert {x.topic for x in MX.features(documents(spark, rows), "topic").collect()} == {"x"}
