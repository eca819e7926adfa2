"""Vectorised word and character features of byte slices (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np

from tendersift.llm.texts import kept

BASE = 0x9E3779B97F4A7C15 | 1          # odd, so it has an inverse modulo 2**64
MASK = (1 << 64) - 1
SPACES = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i <= n, kept between calls and grown by doubling."""
    size = 1 << max(16, int(n + 1).bit_length())

    def make() -> tuple[np.ndarray, np.ndarray]:
        up, down = np.full(size, BASE, np.uint64), np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)
    return kept(("powers", size), make)


def mixed(h: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def spans(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of maximal runs of `inside` bytes that never cross a row's edge."""
    n = len(inside)
    first = np.zeros(n + 1, bool)      # a row begins here
    first[off] = True
    before = np.empty(n, bool)
    if n:
        before[0] = False
        before[1:] = inside[:-1]
        before &= ~first[:n]
    start = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    if n:
        after[-1] = False
        after[:-1] = inside[1:]
        after &= ~first[1:]
    end = np.flatnonzero(inside & ~after) + 1
    row = np.searchsorted(off, start, "right") - 1
    return start, end, row


class Hashes:
    """Hashes of any byte range of one slice, in constant time each."""

    def __init__(self, data: np.ndarray):
        self.up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the `length` bytes from `a` and from `b` are the same, eight at a time."""
    words = np.ndarray((len(data) + 1,), "<u8", buffer=data.tobytes() + bytes(8), strides=(1,))
    out, left = np.ones(len(a), bool), np.flatnonzero((length > 0) & (a != b))
    at = 0
    while len(left):
        rest = np.minimum(length[left] - at, 8).astype(np.uint64)
        odd = (words[a[left] + at] ^ words[b[left] + at]) << (np.uint64(64) - np.uint64(8) * rest)
        out[left[odd != 0]] = False
        at += 8
        left = left[(odd == 0) & (length[left] > at)]
    return out


def distinct(data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: Hashes | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(one place of each different byte range, for every range the number of its like)."""
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = (hashes or Hashes(data))(start, end)
    order = np.argsort(h)
    s = h[order]
    new = np.empty(len(h), bool)
    new[0], new[1:] = True, s[1:] != s[:-1]
    group = np.cumsum(new) - 1
    back = np.empty(len(h), np.int64)
    back[order] = group
    at = order[new]
    size = end - start
    if (size == size[at][back]).all() and same_bytes(data, start, start[at][back], size).all():
        return at, back
    raw, first = data.tobytes(), {}   # different ranges with one hash: told apart by their bytes
    back = np.array([first.setdefault(raw[i:j], len(first)) for i, j in zip(start.tolist(), end.tolist())], np.int64)
    at = np.zeros(len(first), np.int64)
    at[back[::-1]] = np.arange(len(back))[::-1]
    return at, back


def code_table() -> np.ndarray:
    """Byte -> one of 16 kinds of character."""
    t = np.full(256, 15, np.uint8)
    t[[32, 9, 11, 12, 13]] = 0
    t[10] = 1
    t[97:123], t[65:91], t[48:58], t[128:] = 2, 3, 4, 5
    for code, chars in enumerate((".,;:", "!?", "'\"-()", "#", "*", "$", "%", "&", "|<>"), 6):
        t[[ord(c) for c in chars]] = code
    return t


CODES = code_table()
LEVELS = np.array([1 / 512, 1 / 128, 1 / 32, 1 / 8], np.float32)   # shares of a text from which an indicator is set
GRAMS = 4096                         # three characters of 16 kinds
SHAPES = GRAMS + 256 + 16 + 2        # and two, and one, and the two repetition rates
FIXED = SHAPES * len(LEVELS)
WORD_BITS = 18
WIDTH = FIXED + (1 << WORD_BITS)     # all indicators of a text


def shape_rates(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Rows x SHAPES: share of each kind n-gram in a text, of words equal to the one before, of repeated lines."""
    n = len(off) - 1
    code = CODES[data].astype(np.int32)
    row = np.repeat(np.arange(n, dtype=np.int64), np.diff(off))
    out = np.zeros((n, SHAPES), np.float32)
    if len(code) > 2:
        tri = (code[:-2] << 8) | (code[1:-1] << 4) | code[2:]
        same = row[:-2] == row[2:]
        out[:, :GRAMS] = np.bincount((row[:-2] * GRAMS + tri)[same], minlength=n * GRAMS).reshape(n, GRAMS)
    if len(code) > 1:
        two = (code[:-1] << 4) | code[1:]
        same = row[:-1] == row[1:]
        out[:, GRAMS:GRAMS + 256] = np.bincount((row[:-1] * 256 + two)[same], minlength=n * 256).reshape(n, 256)
    if len(code):
        out[:, GRAMS + 256:GRAMS + 272] = np.bincount(row * 16 + code, minlength=n * 16).reshape(n, 16)
    out[:, :GRAMS + 272] /= np.maximum(np.diff(off), 1)[:, None]
    words, lines = repetition(data, off)
    out[:, -2], out[:, -1] = words, lines
    return out


def repeated_lines(data: np.ndarray, off: np.ndarray, h: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Per text: lines with a word, and those of them equal to an earlier line of the text."""
    n = len(off) - 1
    s, e, row = spans(data != 10, off)
    if len(s):
        has = np.concatenate(([0], np.cumsum(~SPACES[data])))
        with_word = has[e] > has[s]
        s, e, row = s[with_word], e[with_word], row[with_word]
    at, back = distinct(data, s, e, h)
    _, first = np.unique(row * max(len(at), 1) + back, return_index=True)
    repeated = np.ones(len(s), bool)
    repeated[first] = False
    return np.bincount(row, minlength=n), np.bincount(row[repeated], minlength=n)


def repetition(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Share of words equal to the word before, and share of lines with a word that came before in the text."""
    n = len(off) - 1
    h = Hashes(data)
    s, e, row = spans(~SPACES[data], off)
    w = h(s, e)
    again = np.zeros(len(w), bool)
    again[1:] = (w[1:] == w[:-1]) & (row[1:] == row[:-1])
    lines, repeated = repeated_lines(data, off, h)
    return (np.bincount(row[again], minlength=n) / np.maximum(np.bincount(row, minlength=n), 1),
            repeated / np.maximum(lines, 1))


def word_indicators(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, index) of the distinct hashed words and word pairs of each text; ASCII case is ignored."""
    low = LOWER[data]
    s, e, row = spans(~SPACES[data], off)
    w = Hashes(low)(s, e)
    pair = mixed(w[:-1] * np.uint64(3) + w[1:])[row[:-1] == row[1:]] if len(w) > 1 else w[:0]
    at = np.concatenate((row, row[:-1][row[:-1] == row[1:]] if len(w) > 1 else row[:0])).astype(np.uint64)
    key = np.unique((at << np.uint64(WORD_BITS)) | (np.concatenate((w, pair)) >> np.uint64(64 - WORD_BITS)))
    return (key >> np.uint64(WORD_BITS)).astype(np.int64), (key & np.uint64((1 << WORD_BITS) - 1)).astype(np.int64) + FIXED


def indicators(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """Per text the sorted indices of its indicators, below WIDTH."""
    rates = shape_rates(data, off)
    wrow, widx = word_indicators(data, off)
    cut = np.searchsorted(wrow, np.arange(len(off)))
    out = []
    for i, r in enumerate(rates):
        at = np.flatnonzero(r >= LEVELS[0])
        level, gram = np.nonzero(r[at] >= LEVELS[:, None])
        out.append(np.concatenate((level * SHAPES + at[gram], widx[cut[i]:cut[i + 1]])).astype(np.int32))
    return out


def linear_scores(data: np.ndarray, off: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum of the weights of each text's indicators, as `indicators` has them."""
    rates = shape_rates(data, off)
    out = np.zeros(len(rates))
    for k, level in enumerate(LEVELS):
        out += (rates >= level).astype(np.float32) @ weights[k * SHAPES:(k + 1) * SHAPES]
    wrow, widx = word_indicators(data, off)
    return out + np.bincount(wrow, weights[widx], minlength=len(out))


def several_scores(data: np.ndarray, off: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """`linear_scores` for each row of `weights`, with the indicators found once."""
    rates = shape_rates(data, off)
    out = np.zeros((len(weights), len(rates)))
    for k, level in enumerate(LEVELS):
        out += weights[:, k * SHAPES:(k + 1) * SHAPES] @ (rates >= level).astype(weights.dtype).T
    wrow, widx = word_indicators(data, off)
    for o, w in zip(out, weights):
        o += np.bincount(wrow, w[widx], minlength=len(o))
    return out
