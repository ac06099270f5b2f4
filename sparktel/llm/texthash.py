"""Vectorised word hashing over Arrow string buffers.

Words are maximal runs of bytes outside a separator set.  Every hash is a polynomial over random 64-bit symbols
modulo 2**64 followed by a SplitMix64 finaliser, so that all positions of a block are hashed by a few NumPy passes
without a Python object per word.  Symbols, bases and finaliser are fixed: hashes agree between workers and runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
#: Bytes of text hashed at once; a single longer text is handled alone.
BLOCK_BYTES = 1 << 19


def splitmix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser, elementwise, as a new array."""
    x = x + _U(0x9E3779B97F4A7C15)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_SYMBOLS = splitmix(np.arange(1, 257, dtype=_U) * _U(0x2545F4914F6CDD1D))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = _U(base), _U(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = -(-n // (1 << 16)) << 16
            for name, b in (("up", self.base), ("down", self.inverse)):
                p = np.full(size, b, _U)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self.up[:n], self.down[:n]


_BYTES, _WORDS, _OTHER = Powers(0xD1342543DE82EF95), Powers(0xAF251AF3B0F025B5), Powers(0x9FB21C651E98DF25)


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """Boolean table by byte: True within one of the inclusive ranges."""
    table = np.zeros(256, bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = True
    return table


#: The words of the dedup contracts: runs outside blank and U+0009..U+000D.
WHITE = separators((0x20, 0x20), (0x09, 0x0D))
#: A-Z to a-z, everything else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty string."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if offsets is not None and len(column) else np.zeros(len(column) + 1, np.int64)
    if column.null_count:
        # A null slot may cover bytes: rebuild without them.
        column = column.fill_null("")
        return string_buffers(column)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offs


def blocks(offs: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have `most` bytes together at most, or one row."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + most, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


class Words:
    """Words of consecutive texts: byte spans, row of each, first word of each row, and 64-bit word hashes."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, sep: np.ndarray = WHITE, fold: np.ndarray | None = None):
        base, end = int(offs[0]), int(offs[-1])
        self.bytes = text = data[base:end]
        offs = offs - base
        if fold is not None:
            text = fold[text]
        inside = ~sep[text]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cuts = offs[:-1][offs[:-1] < len(text)]
        first[cuts] = inside[cuts]
        cuts = cuts[cuts > 0] - 1
        last[cuts] = inside[cuts]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.start, offs)
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(len(offs) - 1), self.count)
        up, down = _BYTES.upto(len(text) + 1)
        sums = np.zeros(len(text) + 1, _U)
        np.cumsum(_SYMBOLS[text] * up[:-1], out=sums[1:])
        self.hash = splitmix((sums[self.end] - sums[self.start]) * down[self.start] + (self.end - self.start).astype(_U))

    def spans(self, n: int) -> np.ndarray:
        """True at each word at which n words of the same text begin."""
        ok = np.zeros(len(self.row), bool)
        if len(self.row) >= n:
            ok[: len(self.row) - n + 1] = self.row[: len(self.row) - n + 1] == self.row[n - 1 :]
        return ok

    def grams(self, n: int, other: bool = False) -> np.ndarray:
        """Hash of the n words from each word on; only meaningful where spans(n).  other: an independent function."""
        powers, w = (_OTHER, splitmix(self.hash ^ _U(0xA5A5F00D12345677))) if other else (_WORDS, self.hash)
        k = len(w)
        out = np.zeros(k, _U)
        if k >= n:
            up, down = powers.upto(k + 1)
            sums = np.zeros(k + 1, _U)
            np.cumsum(w * up[:-1], out=sums[1:])
            out[: k - n + 1] = splitmix((sums[n:] - sums[: k - n + 1]) * down[: k - n + 1] + _U(n))
        return out


def sliding(values: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """op over values[i : i + width] for each i with a whole window."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = op(out[: len(out) - step], out[step:])
        have += step
    return out


def winnow(hashes: np.ndarray, ok: np.ndarray, width: int) -> np.ndarray:
    """Positions holding the minimum of some window of `width` consecutive hashes; ok marks the windows that count.

    Ties within a window are all kept, so equal windows keep equal hashes whatever stands around them.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least = sliding(hashes, width, np.minimum)
    least = np.where(ok[:n], least, _U(0))
    pad = np.zeros(width - 1, _U)
    most = sliding(np.concatenate([pad, least, pad]), width, np.maximum)
    return np.flatnonzero((most == hashes) & (most > 0))


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Boolean of length n: within `width` of one of the starts."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + width, n), -1)
    return np.cumsum(edge[:-1]) > 0


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
