"""Hashes over words and bytes of many texts at once, and the cut of texts into stretches by what they say.

A window is a fixed number of units: words or bytes. Of the short runs of units (grams) within a window the one of least
hash is its anchor. Neighbouring windows mostly have the same anchor; a maximal run of windows with one anchor is a
stretch. Equal windows have equal anchors wherever they are, so all that could repeat a window lies in stretches whose
anchor has the same hash: what is needed to find repeats is one short row for each stretch, not one for each window.

Everything here is arithmetic on arrays, modulo 2 ** 64: hash(a, b) = (P[b] - P[a]) * B ** -a for sums P of unit * B ** i.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BASE, _WORD_BASE = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
#: Bits of an anchor's place in a slice of texts; the others of the 64 order the anchors.
_PLACE = np.uint64(30)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1); kept, and made longer when needed."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, 1 << 16), base, np.uint64)
        out[0] = 1
        np.multiply.accumulate(out, out=out)
        have = _powers[base] = out
    return have[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes; in place on a copy."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sums:
    """Prefix sums for the hashes of any run of the units."""

    def __init__(self, units: np.ndarray, base: int):
        self.base, self.n = base, len(units)
        self.sums = np.zeros(len(units) + 1, np.uint64)
        np.cumsum(units * powers(base, len(units)), out=self.sums[1:])

    def hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.sums[b] - self.sums[a]) * powers(inverse(self.base), self.n + 1)[a] + (b - a).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        m = max(0, self.n - k + 1)
        return mix((self.sums[k : k + m] - self.sums[:m]) * powers(inverse(self.base), self.n + 1)[:m])


@dataclass
class Bytes:
    """The bytes of texts one after another; text d is data[offsets[d] : offsets[d + 1]]."""

    data: np.ndarray
    offsets: np.ndarray


def bytes_of(texts: pa.Array) -> Bytes:
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return Bytes(data, offsets - offsets[0])


@dataclass
class Words:
    """The words of texts: begin and end in the bytes, hash, and for each text the number of its first word."""

    begin: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    offsets: np.ndarray


def words_of(texts: Bytes, lower: bool = False) -> Words:
    """The runs of bytes that are no white space. lower: A-Z count as a-z."""
    data, n = texts.data, len(texts.data)
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    inside = ~_SPACES[data]
    edges = texts.offsets[(texts.offsets > 0) & (texts.offsets < n)]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[edges] = inside[edges]
    ends[:-1] &= ~inside[1:]
    ends[edges - 1] = inside[edges - 1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    sums = Sums(data.astype(np.uint64) + np.uint64(1), _BASE)
    return Words(begin, end, sums.hash(begin, end), np.searchsorted(begin, texts.offsets))


def least_in_windows(values: np.ndarray, w: int) -> np.ndarray:
    """The least of each w neighbouring values."""
    width, out = 1, values
    while 2 * width <= w:
        out = np.minimum(out[: len(out) - width], out[width:])
        width *= 2
    return np.minimum(out[: len(values) - w + 1], out[w - width : w - width + len(values) - w + 1]) if width < w else out


@dataclass
class Stretches:
    """For each stretch: the text, its first window's place in it, how many windows, the anchor's hash and that of all its units."""

    text: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray
    content: np.ndarray


def stretches(units: np.ndarray, offsets: np.ndarray, length: int, gram: int, base: int, wide: int = 0) -> Stretches:
    """The stretches of texts over units; text d has units[offsets[d] : offsets[d + 1]]. A text shorter than a window has none.

    The content of a stretch reaches to the end of its last window, or of the last of `wide` units if the text goes on so far.
    """
    none = Stretches(*(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64)))
    n, w = len(units), length - gram + 1
    if n < length:
        return none
    sums = Sums(units, base)
    grams = sums.grams(gram)
    keyed = (grams >> _PLACE << _PLACE) | np.arange(len(grams), dtype=np.uint64)
    place = (least_in_windows(keyed, w) & ((np.uint64(1) << _PLACE) - np.uint64(1))).astype(np.int64)
    # Windows that reach into the next text are none.
    valid = np.zeros(n - length + 1, bool)
    for lo, hi in zip(offsets[:-1], offsets[1:], strict=True):
        if hi - lo >= length:
            valid[lo : hi - length + 1] = True
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (place[1:] != place[:-1])
    heads = np.flatnonzero(first)
    first_of_text = offsets[:-1][np.diff(offsets) >= length]
    heads = np.union1d(heads, first_of_text)  # texts without a gap between their windows cannot share a stretch
    if not len(heads):
        return none
    last = np.append(heads[1:], len(valid))
    count = np.add.reduceat(valid.astype(np.int64), heads)
    text = np.searchsorted(offsets, heads, "right") - 1
    del last
    ends = np.minimum(heads + count + max(length, wide) - 1, offsets[text + 1])
    return Stretches(text, heads - offsets[text], count, grams[place[heads]], sums.hash(heads, ends))


def word_stretches(words: Words, length: int, gram: int, wide: int = 0) -> Stretches:
    return stretches(words.hash, words.offsets, length, gram, _WORD_BASE, wide)


def byte_stretches(texts: Bytes, length: int, gram: int, wide: int = 0) -> Stretches:
    return stretches(texts.data.astype(np.uint64) + np.uint64(1), texts.offsets, length, gram, _BASE, wide)
