"""Whole-column text primitives over Arrow buffers: words, hashes and shingles of many texts at a time.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D. All functions take texts as one byte array with
offsets, so that their cost is per byte and not per Python object."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        tables = []
        for base in (_MULTIPLIER, _INVERSE):
            table = np.full(size, base, U64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        if size > 2 * PIECE:  # for a long text alone; a worker that lives on doesn't keep its tables
            return tables[0][:n], tables[1][:n]
        _powers[:] = tables
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column; nulls count as empty."""
    column = column.fill_null("") if column.null_count else column
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


#: Bytes of text worked on at a time: arrays over a piece take up to some hundred times as much.
PIECE = 1 << 18


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that the texts of each piece have about most_bytes at most; one longer text is a piece."""
    at = 0
    for part in pieces(batch.column(column), most_bytes):
        yield batch.slice(at, len(part))
        at += len(part)


def pieces(column: pa.Array, most_bytes: int = PIECE) -> Iterator[pa.Array]:
    """The same for a column alone."""
    if not len(column):
        return
    _, offs = string_buffers(column)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + most_bytes, "right")) - 1)
        yield column.slice(at, end - at)
        at = end


class Words:
    """The words of a piece: their 64-bit hashes, the row of each, where they start and end in the bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool):
        data = _LOWER[data] if lower else data
        n = len(data)
        inside = ~_SPACE[data]
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        cuts = offsets[(offsets > 0) & (offsets < n)]
        before[cuts] = False
        after[cuts - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.row = np.searchsorted(offsets, self.start, "right") - 1
        power, inverse = _power_tables(n + 1)
        total = np.zeros(n + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * power[:n], out=total[1:])
        size = (self.end - self.start).astype(U64)
        self.hash = mix((total[self.end] - total[self.start]) * inverse[self.start] + size * U64(0xD6E8FEB86659FD93))
        self.bounds = np.searchsorted(self.row, np.arange(len(offsets)))
        self.data = data

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the runs of width words within a row, and the index of the first word of each."""
        n = len(self.hash)
        if n < width:
            return np.empty(0, U64), np.empty(0, np.int64)
        first = np.flatnonzero(self.row[: n - width + 1] == self.row[width - 1 :])
        total = np.zeros(len(first), U64)
        for k in range(width):
            total = total * U64(0xA0761D6478BD642F) + self.hash[first + k]
            total ^= total >> U64(29)
        return mix(total), first


def shingle_sets(words: Words, rows: int, width: int) -> Iterator[np.ndarray]:
    """Per row the sorted distinct shingles; the whole sequence as one if it has fewer words; empty without words."""
    hashes, first = words.shingles(width)
    at = np.searchsorted(words.row[first], np.arange(rows + 1)) if len(first) else np.zeros(rows + 1, np.int64)
    for k in range(rows):
        if at[k + 1] > at[k]:
            yield np.unique(hashes[at[k] : at[k + 1]])
        else:
            few = words.hash[words.bounds[k] : words.bounds[k + 1]]
            if len(few):
                total = U64(len(few))
                with np.errstate(over="ignore"):
                    for h in few:
                        total = (total * U64(0xE7037ED1A0B428DB)) ^ h
                yield mix(np.array([total], U64))
            else:
                yield np.empty(0, U64)
