"""Adaptive context-mixing range coder for token ids, in lock step over many numpy lanes.

A block of up to ``BLOCK`` ids is cut into ``LANES`` runs of consecutive ids
that are coded side by side with one shared model, reset for every block. At
each step the model has, for every lane, an order-2 prediction (the id that
last followed these two ids), an order-1 prediction (that last followed this
id) and the block's adaptive order-0 distribution over all ids seen, with an
escape to a plain 16-bit id. The three are mixed into one distribution with
weights that adapt to how often each was right at this confidence; the range
coder codes the id with it. All lanes update the shared tables in lane order,
so the decoder repeats the same steps.

The coder keeps a 63-bit window and emits 32-bit words; carries are settled
at the end of a block.

Block bytes: magic ``TKB1``, uint32 ids, uint32 crc32 of the ids as
little-endian uint32, uint32 crc32 of what follows the header, uint16 lanes,
uint16 zero; then lanes x uint32 word counts and the words lane by lane, all
little-endian.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 1 << 16
LANES = 64
MAX_ID = (1 << 16) - 2
MAGIC = b"TKB1"
HEAD = struct.Struct("<4sIIIHH")

_BITS = 14                        # bits of the order-1 and of the order-2 table
_MIX = 64                         # mixing weights are 1/64ths
_UNIT = 16                        # order-0 frequencies add up to 2**16
_TOTAL = 22                       # bits of the whole scale: 64 * 2**16
_LOW = np.uint64(1 << 31)         # the range is kept at or above this
_MASK31 = np.uint64((1 << 31) - 1)
# Steps that rebuild the order-0 distribution: the first ones early, then evenly to a block's end.
_REFRESH = {4, 32, *range(128, BLOCK // LANES, 128)}
_CONTEXTS = 32
_LEARN = 32                       # steps between two updates of the mixing weights


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


class _Model:
    """Predictions and their mixing weights for ``blocks`` blocks of one length.

    ``rows``: steps x lanes, the ids coded so far (the decoder fills it as it goes).
    """

    def __init__(self, blocks: int, vocab: int, rows: np.ndarray, decode: bool):
        g = np.repeat(np.arange(blocks), LANES)
        lanes = len(g)
        self.vocab, self.width, self.rows = vocab, vocab + 1, rows      # the last symbol is the escape
        # Both tables in one array, so that one numpy call serves both: row 0 is order 1, row 1 order 2.
        self.table = np.zeros(2 * blocks << _BITS, np.int32)
        self.base = np.stack([2 * g, 2 * g + 1]) << _BITS
        self.bc = (g * _CONTEXTS).astype(np.int32)
        self.b0, self.bv = g * self.width, (g * vocab).astype(np.int32)
        self.share = np.zeros(blocks * self.width, np.uint32)           # frequency << 16 | cumulated before it
        self.share[vocab::self.width] = 0xFFFF << _UNIT
        self.slot = np.full(blocks << _UNIT, vocab, np.uint16) if decode else None
        self.bs = g << _UNIT
        self.counts = np.zeros(blocks * vocab, np.int32)
        self.tally = np.tile(np.array([6.0, 1.0, 1.0]), (blocks * _CONTEXTS, 1))   # literal, order 2, order 1
        self.seen = np.zeros((_LEARN, lanes), np.int32)
        self.blocks, self.step, self.counted = blocks, 0, 0
        self.p1 = self.p2 = np.zeros(lanes, np.int64)
        self.key = np.empty((2, lanes), np.int64)
        self._weights()

    def _weights(self) -> None:
        share = self.tally / self.tally.sum(1, keepdims=True)
        k = np.maximum(1, (share[:, 1:] * (_MIX - 2)).astype(np.int64))
        self.k = k[:, 0] << 8 | k[:, 1]

    def predict(self) -> None:
        key = self.key
        np.multiply(self.p1, 2654435761, out=key[0])
        np.multiply(self.p2, 2656934313, out=key[1])
        key[1] ^= key[0]
        key >>= 12
        key &= (1 << _BITS) - 1
        key += self.base
        e = self.table.take(key, mode="clip")
        self.c = e & 0xFFFF
        e >>= 16
        self.n = e
        ctx = e[1] << 2
        ctx += e[0]
        ctx += (self.c[0] == self.c[1]).view(np.int8) << 4
        ctx += self.bc
        self.ctx = ctx
        k = self.k.take(ctx, mode="clip")
        self.w2, self.w1 = k >> 8, k & 0xFF
        self.over = self.w2 + self.w1
        self.wl = _MIX - self.over
        self.over <<= _UNIT

    def update(self, ids: np.ndarray, hit: np.ndarray) -> None:
        """``hit``: where the ids equal the predictions; tables keep the last id and a confidence of 0 to 3."""
        n = self.n
        n += 1
        np.minimum(n, 3, out=n)
        n *= hit
        n <<= 16
        n += ids.astype(np.int32)
        self.table[self.key] = n
        seen = self.seen[self.step % _LEARN]
        np.multiply(self.ctx, 3, out=seen)
        seen += hit[1]
        seen += (hit[0] > hit[1]).view(np.int8) << 1
        self.p2, self.p1 = self.p1, ids
        self.step += 1
        if self.step % _LEARN == 0:
            self.tally += np.bincount(self.seen.ravel(), minlength=self.tally.size).reshape(self.tally.shape)
            self._weights()
        if self.step in _REFRESH:
            self._order0()

    def _order0(self) -> None:
        new = (self.rows[self.counted:self.step] + self.bv).ravel()
        self.counts += np.bincount(new, minlength=self.counts.size).astype(np.int32)
        self.counted = self.step
        n = self.step * LANES
        for b in range(self.blocks):
            counts = self.counts[b * self.vocab:(b + 1) * self.vocab]
            ids = counts.nonzero()[0]
            c = counts[ids].astype(np.int64)
            room = (1 << _UNIT) - len(ids)
            escape = min(max((int((c == 1).sum()) + 1 << _UNIT) // (n + 2), 16), room // 2)
            f = 1 + c * (room - escape) // n
            ends = np.cumsum(f)
            at = b * self.width
            self.share[at + ids] = f << _UNIT | ends - f
            self.share[at + self.vocab] = (1 << _UNIT) - int(ends[-1]) << _UNIT | int(ends[-1])
            if self.slot is not None:
                s = self.slot[b << _UNIT:(b + 1) << _UNIT]
                s[:ends[-1]] = np.repeat(ids, f)
                s[ends[-1]:] = self.vocab


def _laid(ids: np.ndarray) -> np.ndarray:
    """Blocks x ids -> steps x lanes, padded with id 0."""
    blocks, n = ids.shape
    steps = -(-n // LANES)
    full = np.zeros((blocks, steps * LANES), np.int64)
    full[:, :n] = ids
    return np.ascontiguousarray(full.reshape(blocks * LANES, steps).T)


def encode_blocks(ids: np.ndarray, vocab: int) -> list[bytes]:
    """Bytes of each row of ``ids`` (blocks x n, one length, n >= 1); ids are below ``vocab``."""
    if ids.size and (int(ids.max()) >= vocab or vocab > MAX_ID + 1):
        raise ValueError("ids must be below the vocabulary's size, and that at most 65535")
    blocks, n = ids.shape
    rows = _laid(ids)
    m = _Model(blocks, vocab, rows, False)
    lanes = blocks * LANES
    low, rng = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 63) - 1, np.uint64)
    who: list[np.ndarray] = []
    word: list[np.ndarray] = []

    def settle(at):
        who.append(at)
        lo = low[at]
        word.append(lo >> np.uint64(31))
        low[at] = (lo & _MASK31) << np.uint64(32)
        rng[at] <<= np.uint64(32)

    for x in rows:
        m.predict()
        hit = m.c == x.astype(np.int32)
        k = m.b0 + x
        share = m.share.take(k, mode="clip")
        new = (share == 0).nonzero()[0]
        if len(new):
            share[new] = m.share[m.b0[new] + vocab]
        freq = (share >> _UNIT).astype(np.int64)
        cum = (share & 0xFFFF).astype(np.int64)
        freq *= m.wl
        cum *= m.wl
        cum += m.over
        at = hit[0].nonzero()[0]
        freq[at] = m.w1[at] << _UNIT
        cum[at] = m.w2[at] << _UNIT
        at = hit[1].nonzero()[0]
        freq[at] = m.w2[at] << _UNIT
        cum[at] = 0
        r = rng >> np.uint64(_TOTAL)
        low += r * cum.view(np.uint64)
        rng = r * freq.view(np.uint64)
        at = (rng < _LOW).nonzero()[0]
        if len(at):
            settle(at)
        esc = new[~(hit[0, new] | hit[1, new])]
        if len(esc):
            r = rng[esc] >> np.uint64(_UNIT)
            low[esc] += r * x[esc].astype(np.uint64)
            rng[esc] = r
            at = esc[r < _LOW]
            if len(at):
                settle(at)
        m.update(x, hit)
    everyone = np.arange(lanes)
    who += [everyone, everyone]
    word += [low >> np.uint64(31), (low & _MASK31) << np.uint64(1)]
    lane = np.concatenate(who)
    order = np.argsort(lane, kind="stable")
    words = np.concatenate(word)[order]
    sizes = np.bincount(lane, minlength=lanes)
    ends = np.cumsum(sizes)
    while True:  # carries move to the word before, which is of the same lane
        high = (words >> np.uint64(32)).nonzero()[0]
        if not len(high):
            break
        words[high] &= np.uint64(0xFFFFFFFF)
        words[high - 1] += np.uint64(1)
    words = words.astype("<u4")
    out = []
    for b in range(blocks):
        a, z = b * LANES, (b + 1) * LANES
        first = ends[a] - sizes[a]
        body = sizes[a:z].astype("<u4").tobytes() + words[first:ends[z - 1]].tobytes()
        out.append(HEAD.pack(MAGIC, n, crc_of(ids[b]), zlib.crc32(body), LANES, 0) + body)
    return out


def block_length(data: bytes) -> int:
    magic, n, _, crc, lanes, _ = HEAD.unpack_from(data)
    if magic != MAGIC or lanes != LANES:
        raise ValueError("not a token block")
    if zlib.crc32(memoryview(data)[HEAD.size:]) != crc:
        raise ValueError("the checksum of a token block is wrong")
    return n


def decode_blocks(data: list[bytes], vocab: int) -> np.ndarray:
    """The ids (blocks x n) of blocks that hold the same number of ids; raises on a wrong checksum."""
    blocks, n = len(data), {block_length(d) for d in data}
    if len(n) != 1:
        raise ValueError("blocks that are decoded together must hold the same number of ids")
    n = n.pop()
    steps, lanes = -(-n // LANES), blocks * LANES
    size = np.concatenate([np.frombuffer(d, "<u4", LANES, HEAD.size) for d in data]).astype(np.int64)
    words = np.concatenate([np.frombuffer(d, "<u4", offset=HEAD.size + 4 * LANES) for d in data]
                           + [np.zeros(2, np.uint32)]).astype(np.uint64)
    if int(size.sum()) + 2 != len(words):
        raise ValueError("a token block is cut short")
    pos = np.cumsum(size) - size
    val = (words[pos] << np.uint64(31)) | (words[pos + 1] >> np.uint64(1))
    # The window is 63 bits, so the 32 bits that follow start one bit before a word.
    after = ((words[:-1] & np.uint64(1)) << np.uint64(31)) | (words[1:] >> np.uint64(1))
    pos += 1
    rng = np.full(lanes, (1 << 63) - 1, np.uint64)
    out = np.empty((steps, lanes), np.int64)
    m = _Model(blocks, vocab, out, True)
    top = np.uint64((1 << _TOTAL) - 1)

    def settle(at):
        p = pos[at]
        val[at] = (val[at] << np.uint64(32)) | after[np.minimum(p, len(after) - 1)]
        rng[at] <<= np.uint64(32)
        pos[at] = p + 1

    for t in range(steps):
        m.predict()
        r = rng >> np.uint64(_TOTAL)
        v = np.minimum(val // r, top).view(np.int64)
        hit1 = v < m.over
        v -= m.over
        # Both are small whole numbers, so the quotient's floor is exact.
        u = np.maximum(v / m.wl, 0).astype(np.int64)
        u += m.bs
        x = m.slot.take(u, mode="clip").astype(np.int64)
        share = m.share.take(m.b0 + x, mode="clip")
        freq = (share >> _UNIT).astype(np.int64)
        cum = (share & 0xFFFF).astype(np.int64)
        freq *= m.wl
        cum *= m.wl
        cum += m.over
        at = hit1.nonzero()[0]
        w2, w1 = m.w2[at], m.w1[at]
        two = v[at] + (w1 << _UNIT) < 0          # below the order-2 share
        freq[at] = np.where(two, w2, w1) << _UNIT
        cum[at] = np.where(two, 0, w2) << _UNIT
        val -= r * cum.view(np.uint64)
        rng = r * freq.view(np.uint64)
        x[at] = np.where(two, m.c[1, at], m.c[0, at])
        esc = (x == vocab).nonzero()[0]
        at = (rng < _LOW).nonzero()[0]
        if len(at):
            settle(at)
        if len(esc):
            r = rng[esc] >> np.uint64(_UNIT)
            plain = val[esc] // r
            x[esc] = plain.astype(np.int64)
            val[esc] -= r * plain
            rng[esc] = r
            at = esc[r < _LOW]
            if len(at):
                settle(at)
        if int(x.max()) >= vocab:
            raise ValueError("a token block is damaged")
        out[t] = x
        m.update(x, m.c == x.astype(np.int32))
    ids = np.ascontiguousarray(out.T).reshape(blocks, steps * LANES)[:, :n]
    for b in range(blocks):
        if crc_of(ids[b]) != HEAD.unpack_from(data[b])[2]:
            raise ValueError("the checksum of a token block is wrong")
    return ids
