"""Operator 1: exact round trips of the coder and of whole documents."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortlens.llm import idcodec as C
from cohortlens.llm import token_output as TO
from tests.llm.fixtures import EDGE, documents, prose


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 3), st.integers(1, 700), st.integers(1, 60_000), st.integers(0, 2**32 - 1))
def test_blocks_round_trip(blocks, n, spread, seed):
    r = np.random.default_rng(seed)
    ids = np.minimum(r.zipf(1.4, (blocks, n)), spread) % 65_535
    assert (C.decode_blocks(C.encode_blocks(ids, 65_535), 65_535) == ids).all()


def test_model_beats_plain_ids():
    r = np.random.default_rng(0)
    ids = np.tile(r.zipf(1.3, 5000) % 49_408, 4)[None]
    assert len(C.encode_blocks(ids, 49_408)[0]) < 0.5 * 2 * ids.size


def test_damage_is_found():
    ids = np.arange(5000)[None] % 700
    data = bytearray(C.encode_blocks(ids, 49_408)[0])
    data[len(data) // 2] ^= 4
    with pytest.raises(ValueError):
        C.decode_blocks([bytes(data)], 49_408)
    with pytest.raises(ValueError):
        C.block_length(b"nope" + bytes(data[4:]))
    with pytest.raises(ValueError):
        C.encode_blocks(np.array([[70_000]]), 49_408)


def test_crc_parts():
    data = bytes(range(256)) * 9
    for cut in (0, 4, 1000, len(data)):
        a, b = data[:cut], data[cut:]
        assert TO.crc_shift(zlib.crc32(a), len(b)) ^ zlib.crc32(b) == zlib.crc32(data)


def whole(text):
    tok = TO.word_ids(TO.tokenizer_path()).tok
    return tok.encode(text or "", add_special_tokens=False).ids


def test_word_cache_equals_whole_texts():
    texts = ["It's the dog's, isn't it? we'LL", "a.b. c,, d., e. f, .g ,", "Ünïcode É, é. ﬁ ß. ΣΑΣ. ΣΑΣ,", "x y z.",
             "<|endoftext|> and <|startoftext|>, <|endoftext|>.", "日本語、テスト。 123,456. 7.", "́ ́a", "", " \n ", "a\x0bb\x0cc\x1cd"]
    ids, counts = TO.word_ids(TO.tokenizer_path()).encode(pa.array(texts))
    cuts = np.concatenate([[0], np.cumsum(counts)])
    for t, a, z in zip(texts, cuts[:-1], cuts[1:]):
        assert ids[a:z].tolist() == whole(t), t


def test_marks_are_coded_apart():
    """Runs of marks at a word's end are words of their own, so the letters before them are met in one form."""
    texts = ["enheitlich### Einungä%%%, rarrga,%%% the!! the?! the", "It's!! x'?. a.'s.. 12%% é%%, <|endoftext|>!! b<|endoftext|>b!!",
             "!! ,.;: *", "Ü.,!?;:%&$#* ΣΑΣ!! x\u0301!! \ufb01?", "a!b! c?d", ""]
    coder = TO.word_ids(TO.tokenizer_path())
    coder.clear()
    for repeat in range(2):     # new words, then known ones
        ids, counts = coder.encode(pa.array(texts))
        cuts = np.concatenate([[0], np.cumsum(counts)])
        for t, a, z in zip(texts, cuts[:-1], cuts[1:]):
            assert ids[a:z].tolist() == whole(t), t
    assert {"enheitlich", "###", "the", "!!", "?!"} <= set(coder.place) and "the!!" not in coder.place


@pytest.mark.parametrize("block,shard", [(C.BLOCK, 8192), (100, 3)])
def test_documents_round_trip(spark, tmp_path, block, shard):
    rows = EDGE + [(k, prose(k, k % 50)) for k in range(100, 160)]
    docs = documents(spark, rows)
    path, tok = str(tmp_path / "ids"), TO.tokenizer_path()
    TO.write_token_ids(docs, path, tok, docs_per_shard=shard, block=block)
    vocab = TO.word_ids(tok).vocab
    got = sorted(map(tuple, TO.token_index(spark, path, vocab).collect()), key=lambda r: r[1])
    want = sorted(((i, whole(t) + [1]) for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    for (i, ids), g in zip(want, got, strict=True):
        assert g == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    parts = TO.read_token_ids(spark, path, vocab).orderBy("shard", "at").collect()
    assert [x for p in parts for x in p.ids] == [x for _, ids in want for x in ids]


def test_no_documents(spark):
    assert TO.token_output(spark, documents(spark, [])).count() == 0
