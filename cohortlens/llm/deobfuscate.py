"""Noisy-channel restoration of disguised words: Viterbi over character lattices under a character model."""

from __future__ import annotations

import re

import numpy as np

# The letters that digits and signs stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "(": "c", "<": "c", "*": "aeiou", "#": "h", "€": "e", "£": "l",
}
SEPARATORS = "._-~*'`^/\\,:=·•"
# The letters the character model tells apart; all others count as one.
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœß"

EDGE, OTHER = 0, len(LETTERS) + 1
SIZE = OTHER + 1
CODE = {c: i + 1 for i, c in enumerate(LETTERS)}
_TABLE = np.full(0x180, OTHER, np.int64)
for _c, _i in CODE.items():
    _TABLE[ord(_c)] = _i

# Costs (nats) of a swapped sign, of a dropped separator, of any other dropped sign, of one that means itself.
SWAP, DROP, LOST, LITERAL = 1.0, 1.5, 7.0, 9.0
REPEAT = 1.0                            # cost of each repeat that stays, in a run of three or more letters
EDGE_MARKS = ".,;:?\"'()[]{}«»“”…"
_MUTE_MARKS = "".join(c for c in EDGE_MARKS if c not in LEET)


def trigram_counts(words: list[str], times: np.ndarray) -> np.ndarray:
    """Counts of (before, before, letter) over the words with their boundaries, each word ``times`` often."""
    line = "".join(f"  {w} " for w in words)
    codes = np.frombuffer(line.encode("utf-32-le"), np.uint32).astype(np.int64)
    space = codes == 32
    codes = np.where(codes < len(_TABLE), _TABLE[np.minimum(codes, len(_TABLE) - 1)], OTHER)
    codes[space] = EDGE
    lengths = np.fromiter((len(w) + 3 for w in words), np.int64, len(words))
    weight = np.repeat(times, lengths)
    ids = (codes[:-2] * SIZE + codes[1:-1]) * SIZE + codes[2:]
    # A trigram belongs to the word of its last letter; those that end in a word's leading blanks say nothing.
    keep = ~(space[2:] & space[1:-1])
    return np.bincount(ids[keep], weight[2:][keep], minlength=SIZE ** 3)


def log_model(counts: np.ndarray) -> np.ndarray:
    """log P(letter | two before), trigrams backed by bigrams backed by letters."""
    tri = counts.reshape(SIZE, SIZE, SIZE).astype(float)
    bi, uni = tri.sum(0), tri.sum((0, 1))
    p1 = (uni + 1) / (uni.sum() + SIZE)
    p2 = (bi + 5 * p1) / (bi.sum(1, keepdims=True) + 5)
    p3 = (tri + 5 * p2[None]) / (tri.sum(2, keepdims=True) + 5)
    return np.log(p3)


_RUN = re.compile(r"(.)\1*", re.DOTALL)


def lattice(text: str) -> list[list[tuple[str, float]]]:
    """For each character the letters it can stand for, with costs; '' where it can be left out."""
    steps: list[list[tuple[str, float]]] = []
    run = ahead = 0         # equal characters up to here, and from here on
    for k, c in enumerate(text):
        if k and text[k - 1] == c:
            run, ahead = run + 1, ahead - 1
        else:
            run, ahead = 1, _RUN.match(text, k).end() - k
        if c in LEET:
            options = [(x, SWAP) for x in LEET[c]] + [("", DROP if c in SEPARATORS else LOST)]
        elif not c.isalpha():
            options = [("", DROP if c in SEPARATORS else LOST), (c, LITERAL)]
        else:
            options = [(c, 0.0)]
            if run > 1:
                options = [(c, REPEAT if run + ahead > 3 else 0.0), ("", 0.0 if run + ahead > 3 else REPEAT)]
        steps.append(options)
    return steps


def viterbi(steps: list[list[tuple[str, float]]], log_p: np.ndarray) -> tuple[str, float]:
    """The likeliest letters of a lattice, and their log probability less the channel's costs."""
    states = _START
    for options in steps:
        states = _after(states, options, log_p)
    return _best(states, log_p)


def viterbi_ends(steps: list[list[tuple[str, float]]], log_p: np.ndarray) -> list[str]:
    """The likeliest letters of a lattice if it ended after its first step, its second, and so on: one walk for all."""
    states, out = _START, []
    for options in steps:
        states = _after(states, options, log_p)
        out.append(_best(states, log_p)[0])
    return out


#: Letters so far are a chain (those before, the last one), so that a step costs the same however long the text is.
_START: dict[tuple[int, int], tuple[float, tuple]] = {(EDGE, EDGE): (0.0, ())}


def _after(states: dict, options: list[tuple[str, float]], log_p: np.ndarray) -> dict:
    """The best way into every pair of last letters, one character on."""
    after: dict[tuple[int, int], tuple[float, tuple]] = {}
    for (a, b), (score, out) in states.items():
        for letter, cost in options:
            if letter:
                c = CODE.get(letter, OTHER)
                key, value = (b, c), score + float(log_p[a, b, c]) - cost
            else:
                key, value = (a, b), score - cost
            if key not in after or value > after[key][0]:
                after[key] = (value, (out, letter) if letter else out)
    return after


def _best(states: dict, log_p: np.ndarray) -> tuple[str, float]:
    out, score = max(((out, s + float(log_p[a, b, EDGE])) for (a, b), (s, out) in states.items()), key=lambda x: x[1])
    letters = []
    while out:
        out, letter = out
        letters.append(letter)
    return "".join(reversed(letters)), score


_THRICE = re.compile(r"(.)\1\1")
# A number, with the signs that belong to one; digits alone could stand for any word.
_NUMBER = re.compile(r"[+\-#$€£]*[0-9][0-9.,:/\-]*[%$€£+]*")
_SIGNS = frozenset(LEET)


def disguised(word: str) -> bool:
    """Whether a lower-case token has something to restore: it holds a letter or a leet sign and is not plain.

    Plain are words of letters without one three times in a row, numbers, and one sign however often.
    """
    if word.isalpha():
        return bool(_THRICE.search(word))
    if any(map(str.isalpha, word)):
        return True
    return len(_SIGNS.intersection(word)) > 1 and not _NUMBER.fullmatch(word)


def restore(word: str, log_p: np.ndarray) -> str:
    """The word behind a lower-case token."""
    return viterbi(lattice(word), log_p)[0]


def plain(word: str) -> str:
    return word.strip(EDGE_MARKS)


def signed(word: str) -> str:
    """The token with those edge marks that can stand for a letter."""
    return word.strip(_MUTE_MARKS)

