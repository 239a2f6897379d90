"""Operators 4, 7, 9 and 10 against brute force on hostile rows."""

import collections
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from cohortlens.llm import chat_format as CF
from cohortlens.llm import exact_dedup as ED
from cohortlens.llm import line_dedup as LD
from cohortlens.llm import sharding as SH
from tests.llm.fixtures import EDGE, documents, prose


def test_exact_groups(spark):
    got = ED.exact_groups(documents(spark, EDGE)).collect()
    groups = collections.defaultdict(list)
    for i, t in EDGE:
        groups[t or ""].append(i)
    want = sorted(((i, max((x for x in groups[t or ""] if x is not None), default=None), len(groups[t or ""]),
                    hashlib.sha256((t or "").encode()).hexdigest()) for i, t in EDGE), key=repr)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_exact_groups_tell_collisions_apart(spark):
    docs = documents(spark, [(k, f"text {k % 7}") for k in range(40)])
    weak = ED.exact_groups(docs, hash_of=lambda t: F.substring(F.md5(t), 1, 1))
    plain = ED.exact_groups(docs)
    assert sorted(map(tuple, weak.collect())) == sorted(map(tuple, plain.collect()))
    assert ED.exact_dedup(docs).count() == 7
    assert ED.exact_groups(documents(spark, [])).count() == 0


CHATS = [(1, 0, "user", "hi <turn x> \\l \\\\ </turn>"), (1, 1, "user", None), (1, 2, "assistant", "a<part>b"),
         (1, 3, "assistant", ""), (1, 3, "assistant", ""), (2, 0, "as>s<i\\stant", "\\"), (2, 5, None, "é\U0001f600 <"),
         (3, 0, "assistant", "\\"), (None, 0, "user", "x"), (4, None, "assistant", "\\### Assistant: </turn> ok")]


def test_chats_round_trip(spark):
    turns = spark.createDataFrame([(*c, "x", "y") for c in CHATS],
                                  "conv_id long, turn long, role string, text string, blocks string, merged string")
    out = CF.format_chats(turns)
    back = {r.conv_id: r for r in CF.parse_chats(out).collect()}
    by = collections.defaultdict(list)
    for c, t, role, text in CHATS:
        by[c].append((t if t is not None else -1, role or "", text or ""))
    assert set(back) == set(by)
    for c, ts in by.items():
        ts.sort()
        assert [(t.role, t.text) for t in back[c].turns] == [(r, x) for _, r, x in ts]
        assert back[c].loss_texts == [x for _, r, x in ts if r == "assistant"]
        runs = sum(k == 0 or ts[k][1] != ts[k - 1][1] for k in range(len(ts)))
        assert back[c].n_merged == runs == back[c].formatted.count("</turn>")
    digests = {r.conv_id: r for r in CF.digest_chats(out).collect()}
    for c, ts in by.items():
        said = "".join(f"{r}\n{x}\n" for _, r, x in sorted(ts))
        loss = "".join(x for _, r, x in sorted(ts) if r == "assistant")
        d = digests[c]
        assert (d.n_turns, d.turns_sha256) == (len(ts), hashlib.sha256(said.encode()).hexdigest())
        assert (d.loss_chars, d.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert CF.digest_chats(CF.format_chats(turns.limit(0))).count() == 0


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return a[k + 1:] == b[k + 1:] or a[k:] == b[k + 1:] or a[k + 1:] == b[k:]


def brute_lines(rows, least=16):
    occ = sorted({(i, k, x) for i, t in rows if t is not None for k, x in enumerate(t.split("\n"))},
                 key=lambda o: (o[0] is not None, o[0] or 0, o[1]))
    first, order, out = {}, [], {}
    for i, k, x in occ:
        if x.strip(" ") and x not in first:
            first[x] = (i, k)
            order.append(x)
    near = {}
    for n, x in enumerate(order):
        if len(x) >= least:
            near[x] = next((first[y] for y in order[:n] if len(y) >= least and within_one(x, y)), None)
    for i, k, x in occ:
        same = (near.get(x) or (first[x] if first[x] != (i, k) else None)) if x.strip(" ") else None
        out[(i, k)] = same
    return out


def test_line_decisions(spark):
    base = "the quick brown fox jumps over the lazy dog"
    rows = EDGE + [(20, base + "\n" + base[1:] + "\n" + base[:-1] + "\nshort\nshort"), (21, base.replace("quick", "quack")),
                   (22, "é" + base), (23, base[:20] + "é" + base[20:]), (24, base.upper()), (25, base[:10] + base[12:]),
                   (26, "\n".join(f"page number {k} of the book" for k in range(12))),
                   (27, prose(9, 900) + "\n" + prose(9, 900)[:-1] + "q"), (28, prose(9, 900)[:2000] + "é" + prose(9, 900)[2000:])]
    got = {(r.doc_id, r.line_no): (r.same_doc_id, r.same_line_no) if not r.kept else None
           for r in LD.line_decisions(documents(spark, rows)).collect()}
    assert got == brute_lines(rows)
    assert LD.line_decisions(documents(spark, [])).count() == 0


def test_dedup_lines_keeps_columns(spark):
    docs = documents(spark, [(1, "a line that is long enough\nother words in this one"), (2, "a line that is long enough\nnew"),
                             (3, "a line that is long enouhg")])
    out = LD.dedup_lines(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {
        1: "a line that is long enough\nother words in this one", 2: "new", 3: "a line that is long enouhg"}


def test_shards(spark):
    rows = EDGE + [(k, f"text {k}" if k % 3 else "the one hot text") for k in range(100, 1000)]
    got = SH.shard_rows(documents(spark, rows), 7).collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert set(by) == set(range(7)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    want = collections.Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert SH.shard_rows(documents(spark, []), 7).count() == 0
    # A hot slot is cut into as many groups as its count asks for, and the law holds as before.
    cut = SH.shard_rows(documents(spark, rows), 7, salt_rows=10).collect()
    slots = collections.Counter((r.shard, r.slot) for r in cut)
    assert len(cut) == len(rows) == len(slots)
    sizes = collections.Counter(r.shard for r in cut)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in cut) == want


@pytest.mark.parametrize("slack", [0.0, 0.2])
def test_bounded_loads_move_little(slack):
    import random
    r = random.Random(5)
    arcs = SH.ring_arcs(20)
    counts = {a: r.randint(0, 30) for a in range(len(arcs))}
    counts[17] += 5_000                                   # a hot arc
    placed = SH.place_arcs(counts, arcs, 20, slack)
    total = sum(counts.values())
    load, seen = collections.Counter(), collections.defaultdict(list)
    for a, lo, hi, s, base in placed:
        assert base == load[s]
        load[s] += hi - lo
        seen[a].append((lo, hi))
    assert sum(load.values()) == total
    for a, n in counts.items():
        at = 0
        for lo, hi in sorted(seen[a]):
            assert lo == at
            at = hi
        assert at == n
    bound = total // 20 + 1 if not slack else int(1.2 * total / 20) + 1
    assert max(load.values()) <= bound
    # A shard gives away no more than what is over its bound.
    own = collections.Counter()
    for a, n in counts.items():
        own[arcs[a][1]] += n
    stay = collections.Counter()
    for a, lo, hi, s, _ in placed:
        if s == arcs[a][1] and lo == 0:
            stay[s] += hi
    exact = [total // 20 + (s < total % 20) if not slack else bound for s in range(20)]
    assert all(stay[s] == min(own[s], exact[s]) for s in range(20))


def test_ring_gives_new_shards_only():
    old, new = dict(SH.ring_arcs(10)), dict(SH.ring_arcs(11))
    assert all(new[at] == s for at, s in old.items() if at in new)
    assert set(new.values()) - set(old.values()) == {10}


def test_exact_dedup_keeps_one_row_of_every_text(spark):
    rows = [(1, "a"), (2, "a"), (2, "a"), (None, "a"), (None, "lonely"), (None, "lonely"), (None, "b"), (3, None), (4, ""), (None, "")]
    for keep, a, empty in (("max", 2, 4), ("min", 1, 3)):
        got = sorted(((r.text or "", r.doc_id) for r in ED.exact_dedup(documents(spark, rows), keep=keep).collect()), key=repr)
        assert got == sorted([("a", a), ("lonely", None), ("b", None), ("", empty)], key=repr)
    weak = ED.exact_dedup(documents(spark, rows), hash_of=lambda t: F.lit("same"))           # collisions stay apart
    assert weak.count() == 4 and weak.columns == documents(spark, rows).columns


def test_dedup_lines_keeps_columns_of_any_name_and_texts_without_an_id(spark):
    one = "a line of more than sixteen characters"
    rows = [(1, one, "p", "q"), (2, f"{one}\nother", "p", "q"), (None, f"{one}\nmore", "p", "q"), (None, "x", "p", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone_lines string, gone_id string")
    from cohortlens.llm.line_dedup import dedup_lines
    got = sorted((str(r.doc_id), r.text, r.gone_lines, r.gone_id) for r in dedup_lines(docs).collect())
    # A null id comes first in the order, so the other two copies go; its own documents stay as they are.
    assert got == [("1", "", "p", "q"), ("2", "other", "p", "q"), ("None", f"{one}\nmore", "p", "q"), ("None", "x", "p", "q")]
