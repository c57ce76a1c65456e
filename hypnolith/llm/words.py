"""Words of whole texts as flat arrays: one numpy pass over a batch's bytes, no loop over rows.

A word is a maximal run of bytes other than space and \\x09-\\x0D (in UTF-8 those
bytes occur only as themselves). Words never cross a row. Hashes are 64-bit and
depend on the bytes alone, so every task, executor and rerun gives the same ones.
Sequences of any length are hashed by chains and trees of a scrambling step, which no
pattern of the input cancels out (a polynomial modulo 2 ** 64 gives equal values for
Thue-Morse patterns); only windows of fixed, small size use a polynomial over scrambled
word hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text handled in one numpy step; temporary arrays take some 40 times this.
STEP_BYTES = 1 << 21

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
#: Everything in ASCII but digits and lower-case letters separates.
NOT_ALNUM = np.arange(256) < 128
NOT_ALNUM[[*range(48, 58), *range(97, 123)]] = False
_ASCII_LOWER = np.arange(256, dtype=np.uint8)
_ASCII_LOWER[65:91] += 32
_SEEDS = (np.uint64(0x2545F4914F6CDD1D), np.uint64(0xA0761D6478BD642F))
# Words of more bytes are hashed one by one: the chain below would take a step per 8 bytes.
_LONG_WORD = 512

_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_FACTOR64 = np.uint64(_FACTOR)
_STEP = np.uint64(0x9FB21C651E98DF25)
_CHUNK_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """base ** 0 .. base ** (count - 1) modulo 2 ** 64; tables of usual length are kept."""
    have = _powers.get(base)
    if have is None or len(have) < count:
        table = np.full(max(count, 1 << 16), base, np.uint64)
        table[0] = 1
        np.cumprod(table, out=table)
        if len(table) > 4 * STEP_BYTES:
            return table
        have = _powers[base] = table
    return have[:count]


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    h = hashes ^ (hashes >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of the bytes of every span: a scrambled chain over its 8-byte chunks."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    chunks = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    size = ends - starts
    left = size.copy()
    value = mixed(size.astype(np.uint64) + _SEEDS[seed])
    open_, at = np.flatnonzero(size <= _LONG_WORD), starts.copy()
    if len(open_) == len(size):
        open_ = slice(None)
    while True:
        here = left[open_]
        chunk = chunks[at[open_]] & _CHUNK_MASK[np.minimum(here, 8)]
        value[open_] = mixed((value[open_] ^ chunk) * _STEP + _SEEDS[1 - seed])
        left[open_] = here - 8
        open_ = np.flatnonzero(left > 0) if isinstance(open_, slice) else open_[here > 8]
        open_ = open_[size[open_] <= _LONG_WORD]
        if not len(open_):
            break
        at[open_] += 8
    for k in np.flatnonzero(size > _LONG_WORD):
        digest = hashlib.blake2b(data[starts[k] : ends[k]].tobytes(), digest_size=8, salt=bytes([seed]))
        value[k] = int.from_bytes(digest.digest(), "little")
    return value


class Words:
    """The words of some texts: byte spans and, per text, the range of its words."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, separators: np.ndarray = _SPACE):
        """data: UTF-8 bytes; bounds: where each text starts, and the end of the last.

        ``separators`` flags the bytes that are in no word.
        """
        self.data = data
        self.bounds = bounds
        self.texts = len(bounds) - 1
        inside = ~separators[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        #: words of text i are first[i] .. first[i + 1] - 1
        self.first = np.searchsorted(self.starts, bounds)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.texts), self.counts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """64-bit hash of every word; those of seeds 0 and 1 are independent of each other."""
        return span_hashes(self.data, self.starts, self.ends, seed)

    def spans(self, size: int) -> np.ndarray:
        """First word of every run of ``size`` consecutive words of one text."""
        n = len(self.starts)
        if n < size:
            return np.zeros(0, np.int64)
        last = np.repeat(self.first[1:], self.counts)
        at = np.arange(n - size + 1)
        return at[at + size <= last[: n - size + 1]]


def run_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` consecutive word hashes, for each start that has as many after it."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers(_FACTOR, n), out=total[1:])
    return mixed((total[size:] - total[: n + 1 - size]) * powers(_INVERSE, n)[: n + 1 - size])


def whole_hashes(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of each text's whole word sequence (0 words: of the empty sequence).

    Neighbours are combined level by level until one value is left, a tree whose shape
    depends on the number of words alone.
    """
    size = np.diff(first)
    out = mixed(size.astype(np.uint64) + _SEEDS[0])
    texts = np.flatnonzero(size)
    begin, count, level = first[:-1][texts], size[texts], hashes
    while len(texts):
        done = count == 1
        out[texts[done]] = mixed(out[texts[done]] ^ level[begin[done]] * _STEP)
        texts, begin, count = texts[~done], begin[~done], count[~done]
        if not len(texts):
            break
        half = count >> 1
        nodes = half + (count & 1)
        new = np.cumsum(nodes) - nodes
        owner = np.repeat(np.arange(len(texts)), nodes)
        k = np.arange(int(nodes.sum())) - new[owner]
        left = begin[owner] + 2 * k
        paired = k < half[owner]
        right = np.where(paired, level[np.where(paired, left + 1, left)], np.uint64(0))
        level = mixed((level[left] * _FACTOR64) ^ mixed(right + _SEEDS[1]))
        begin, count = new, nodes
    return out


PRIME = (1 << 61) - 1
_BASES = (0x1B873593CC9E2D51 % PRIME, 0x0F4A5C3D27D4EB4F % PRIME)
_P, _LOW31, _LOW30 = np.uint64(PRIME), np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_S30, _S31, _S61, _TWO = np.uint64(30), np.uint64(31), np.uint64(61), np.uint64(2)


def reduced(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values modulo 2^61 - 1."""
    values = (values & _P) + (values >> _S61)
    return np.where(values >= _P, values - _P, values)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo 2^61 - 1, both below it."""
    ah, al, bh, bl = a >> _S31, a & _LOW31, b >> _S31, b & _LOW31
    middle = al * bh + ah * bl
    return reduced(ah * bh * _TWO + (middle >> _S30) + ((middle & _LOW30) << _S31) + reduced(al * bl))


class ModularSums:
    """Digests of word ranges of any length, and of a range without one of its words.

    Polynomials of the word hashes modulo the prime 2^61 - 1. Unlike those modulo a power
    of two they give no input pattern an equal value at every base.
    """

    _powers: dict[int, np.ndarray] = {}

    def __init__(self, hashes: np.ndarray, which: int):
        self.base = _BASES[which]
        terms = product(reduced(hashes), self._power(self.base, len(hashes))[: len(hashes)])
        total = np.zeros((2, len(hashes) + 1), np.uint64)
        np.cumsum(terms >> _S31, out=total[0, 1:])
        np.cumsum(terms & _LOW31, out=total[1, 1:])
        high = reduced(total[0])
        self.total = reduced(product(high, np.full(len(high), 1 << 31, np.uint64)) + reduced(total[1]))

    def _power(self, base: int, count: int) -> np.ndarray:
        table = self._powers.get(base, np.ones(1, np.uint64))
        while len(table) < count:
            step = np.uint64(pow(base, len(table), PRIME))
            table = np.concatenate([table, product(table, np.full(len(table), step))])
        if len(table) <= 4 * STEP_BYTES:
            self._powers[base] = table
        return table

    def _range(self, begin: np.ndarray, end: np.ndarray, shift: np.ndarray) -> np.ndarray:
        """Terms of words begin .. end - 1, moved ``shift`` places forward."""
        back = self._power(pow(self.base, -1, PRIME), len(self.total))
        return product(reduced(self.total[end] + (_P - self.total[begin])), back[shift])

    def digest(self, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Digest of words begin .. begin + size - 1."""
        return mixed(self._range(begin, begin + size, begin) + mixed(size.astype(np.uint64)))

    def without(self, first: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Digest of size words without word ``at``: the same as that of those words in a row."""
        head = self._range(first, first + at, first)
        tail = self._range(first + at + 1, first + size, first + 1)
        return mixed(reduced(head + tail) + mixed((size - 1).astype(np.uint64)))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of a string column; null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if not len(column) or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    bounds = bounds.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def steps(
    column: pa.Array, lower: bool = False, separators: np.ndarray = _SPACE, step_bytes: int = STEP_BYTES
) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) of pieces of a column with some ``step_bytes`` each.

    A longer text makes a piece of its own. ``lower`` turns A-Z into a-z.
    """
    data, bounds = text_bytes(column)
    row, rows = 0, len(bounds) - 1
    while row < rows:
        end = int(np.searchsorted(bounds, bounds[row] + step_bytes, "right")) - 1
        end = min(rows, max(row + 1, end))
        piece = data[bounds[row] : bounds[end]]
        if lower:
            piece = _ASCII_LOWER[piece]
        yield row, end, Words(piece, bounds[row : end + 1] - bounds[row], separators)
        row = end


def signed(hashes: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit hashes as Spark longs."""
    return hashes.view(np.int64)
