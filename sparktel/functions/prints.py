"""hashing.fingerprints of span tags on Arrow batches: the same sets, with a few array operations for a whole batch."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute

from sparktel.functions.hashing import EXACT_FIELDS, EXISTS, TRIGRAM_FIELDS

_INVERSE = pow(31, -1, 1 << 64)
#: Cells of the table in which rows are sorted, as a multiple of the fingerprints: beyond it, one long sort.
_LOOSE = 4


@lru_cache(maxsize=1 << 14)
def poly31(raw: bytes) -> int:
    """h = 31 h + byte, from 0, modulo 2**64."""
    h = 0
    for b in raw:
        h = (31 * h + b) % (1 << 64)
    return h


def _powers(x: int, n: int) -> np.ndarray:
    out = np.full(n, x, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _places(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each, as many as count."""
    return np.arange(count.sum()) + np.repeat(start - np.cumsum(count) + count, count)


def of_values(field: str, values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """How many fingerprints each non-empty text has as a value of an indexed field, repeats included, and all of them."""
    raw = values.cast(pa.large_binary())
    edge = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    low, high = edge[:-1] - edge[0], edge[1:] - edge[0]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[edge[0] : edge[-1]].astype(np.uint64)
    power, head = _powers(31, len(data) + 1), np.uint64(poly31(f"{field}:".encode()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data * _powers(_INVERSE, len(data)), dtype=np.uint64)])
    exact = (sums[high] - sums[low]) * power[high - 1] + head * power[high - low]
    if field not in TRIGRAM_FIELDS:
        return np.ones(len(raw), np.int64), exact
    # Three code points are from `first` on up to `end`; bytes 10xxxxxx go on with one.
    begins = np.flatnonzero((data & np.uint64(0xC0)) != 0x80)
    a = np.searchsorted(begins, low)
    count = np.maximum(np.searchsorted(begins, high) - a - 2, 0)
    at = _places(a, count)
    first, end = begins[at], np.append(begins, len(data))[at + 3]
    grams = (sums[end] - sums[first]) * power[end - 1] + head * power[end - first]
    n, own = count + 1, np.cumsum(count + 1) - count - 1
    out = np.empty(n.sum(), np.uint64)
    out[own] = exact
    out[_places(own + 1, count)] = grams
    return n, out


def _pieces(field: str, rows: np.ndarray, values: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row, fingerprint) of a field that these rows have with these non-empty texts, rows in order."""
    if not len(rows):
        return []
    out = [(rows, np.full(len(rows), poly31(f"{field}:{EXISTS}".encode()), np.uint64))]
    if field in (*TRIGRAM_FIELDS, *EXACT_FIELDS):
        coded = values.dictionary_encode()
        n, prints = of_values(field, coded.dictionary)
        code = coded.indices.to_numpy()
        out.append((np.repeat(rows, n[code]), prints[_places((np.cumsum(n) - n)[code], n[code])]))
    return out


def of_batch(fixed: dict[str, pa.Array], maps: dict[str, pa.Array]) -> pa.Array:
    """Sorted distinct fingerprints of each row, array<bigint>: of texts by field, and of maps by the prefix of their names."""
    columns, size = [(field, np.arange(len(x)), x) for field, x in fixed.items()], len(next(iter(fixed.values())))
    for prefix, m in maps.items() if size else ():
        edge = np.frombuffer(m.buffers()[1], np.int32)[m.offset : m.offset + len(m) + 1]
        rows, coded = np.repeat(np.arange(len(m)), np.diff(edge)), m.keys.slice(edge[0], edge[-1] - edge[0]).dictionary_encode()
        items, code = m.items.slice(edge[0], edge[-1] - edge[0]), coded.indices.to_numpy()
        for i, name in enumerate(coded.dictionary.to_pylist()):
            at = np.flatnonzero(code == i)
            columns.append((prefix + name, rows[at], items.take(pa.array(at))))
    pieces = []
    for field, rows, values in columns:
        there = np.flatnonzero(pa.compute.not_equal(values, "").fill_null(False).to_numpy(zero_copy_only=False))
        pieces += _pieces(field, rows[there], values.take(pa.array(there)))
    return _sorted_sets(pieces, size)


def _sorted_sets(pieces: list[tuple[np.ndarray, np.ndarray]], rows: int) -> pa.Array:
    counts = [np.bincount(r, minlength=rows) for r, _ in pieces]
    total = sum(counts, np.zeros(rows, np.int64))
    widest, size = int(total.max(initial=0)), int(total.sum())
    if rows * widest <= _LOOSE * size:
        table, filled = np.full((rows, widest), np.iinfo(np.int64).max), np.zeros(rows, np.int64)
        for (_, x), n in zip(pieces, counts, strict=True):
            table.reshape(-1)[_places(np.arange(rows) * widest + filled, n)] = x.view(np.int64)
            filled += n
        table.sort(axis=1)  # what fills a row up comes last
        keep = np.arange(widest) < total[:, None]
        keep[:, 1:] &= table[:, 1:] != table[:, :-1]
        row_sizes, values = keep.sum(axis=1), table[keep]
    else:
        row, x = (np.concatenate([p[k] for p in pieces]) for k in (0, 1))
        order = np.lexsort((x.view(np.int64), row))
        row, x = row[order], x.view(np.int64)[order]
        keep = np.ones(size, bool)
        keep[1:] = (row[1:] != row[:-1]) | (x[1:] != x[:-1])
        row_sizes, values = np.bincount(row[keep], minlength=rows), x[keep]
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(row_sizes)).astype(np.int32)), pa.array(values))
