"""Numpy kernels over the byte buffers of Arrow string columns.

Everything here works on a *block*: the concatenated UTF-8 bytes of some rows
(``data``) and the row boundaries (``off``, one more entry than rows). Null
texts are empty rows. Blocks hold whole rows and aim at ``BLOCK_BYTES``, so that
the eight-byte arrays derived from them stay in the processor's caches; a row
longer than that is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 18
U64 = np.uint64

#: Bytes that end a word: space and \t \n \v \f \r.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Maps A-Z to a-z and leaves other bytes alone.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Character classes for word shapes: upper, lower (and non-ASCII), digit, else itself.
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[65:91] = 65
SHAPE[97:123] = 97
SHAPE[48:58] = 48
SHAPE[128:] = 97

_BASE = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2**64
_powers: dict[int, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the hash base (or of its inverse) modulo 2**64."""
    base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(BLOCK_BYTES * 2, 1 << (n - 1).bit_length())
        have = np.full(size, base, U64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= BLOCK_BYTES * 4:  # larger ones are not kept
            _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalises 64-bit hashes so that each output bit depends on every input bit."""
    h = h ^ (h >> U64(33))
    h *= U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(29)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(32)
    return h


def prefix_hash(data: np.ndarray) -> np.ndarray:
    out = np.empty(len(data) + 1, U64)
    out[0] = 0
    np.cumsum((data.astype(U64) + U64(1)) * powers(len(data)), out=out[1:])
    return out


def slice_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit content hashes of the byte slices [start, end); not an identity for slices of 1024 bytes and more."""
    return mix((prefix[end] - prefix[start]) * powers(len(prefix), True)[start])


def _span_table() -> np.ndarray:
    return mix(np.arange(1, (1 << 16) + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))


_SPAN = _span_table()


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit content hashes of disjoint byte spans [start, end) in order, none of them empty.

    Each (place, byte) has a random number of its own, and each 256-byte stretch a
    random odd factor; a span's hash is their sum. Unlike ``slice_hash``, a polynomial modulo
    2**64, it has no families of long spans that always collide.
    """
    if not len(start):
        return np.zeros(0, U64)
    size = end - start
    stop = np.cumsum(size)
    first = stop - size
    step = np.ones(stop[-1], np.int32)  # running sums of steps: where each byte is, and its place in its span modulo 256
    step[0] = start[0]
    step[first[1:]] = start[1:] - end[:-1] + 1
    turn = np.ones(stop[-1], np.uint8)
    turn[0] = 0
    turn[first[1:]] = (1 - size[:-1]).astype(np.uint8)
    key = np.cumsum(turn, dtype=np.uint8).astype(np.uint16)
    key <<= 8
    key |= data[np.cumsum(step, dtype=np.int32)]
    value = _SPAN[key]
    for k in np.flatnonzero(size > 256).tolist():
        far = value[first[k] + 256 : stop[k]]
        far *= mix(np.arange(256, size[k]).astype(U64) >> U64(8)) | U64(1)
    return mix(np.add.reduceat(value, stop - size) + size.astype(U64) * U64(0xA0761D6478BD642F))


def column_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and row offsets of a string (or binary) column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, body = column.buffers()
    off = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if where is not None and where.size else np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(body, np.uint8)[off[0] : off[-1]] if body is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return data, off - off[0]


def blocks(data: np.ndarray, off: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cuts rows into runs of about ``limit`` bytes: (first row, end row, bytes, offsets)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        j = min(j, n, i + 20_000)
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def spans(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True that do not cross a row boundary."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < len(inside))]
    start[cut] = inside[cut]
    end[cut - 1] = inside[cut - 1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return spans(~IS_SPACE[data], off)


def lines(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of all lines: a row with k newlines has k + 1 lines."""
    at = np.flatnonzero(data == 10)
    row_of = np.searchsorted(off, at, "right") - 1
    start = np.concatenate([off[:-1], at + 1])
    row = np.concatenate([np.arange(len(off) - 1), row_of])
    order = np.lexsort((start, row))
    start, row = start[order], row[order]
    end = np.empty_like(start)
    end[:-1] = start[1:] - 1
    last = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)
    end[last] = off[row[last] + 1]
    return start, end, row


def per_row(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of values between consecutive positions of ``at``."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The integers of all ranges [start, start + length), one range after another."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(length)
    return np.arange(total) + np.repeat(start - (ends - length), length)


def ngram_features(data: np.ndarray, off: np.ndarray, bits: int, *, chars: bool = False, shapes: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashed feature numbers (with repeats) of every row, and their row offsets.

    Features are word 1- and 2-grams of ASCII-lower-cased words and of word
    shapes (runs of one character class collapse), a mark for each word of a
    repeated 5-word window, and byte 3- and 4-grams if ``chars``.
    """
    low = LOWER[data]
    start, end = words(data, off)
    bound = np.searchsorted(start, off)  # first word of each row
    row = np.repeat(np.arange(len(off) - 1), np.diff(bound))
    found, rows = [], []

    def grams(unit: np.ndarray, salt: int) -> None:
        found.append(mix(unit + U64(salt)))
        rows.append(row)
        if len(unit) > 1:
            same = row[1:] == row[:-1]
            found.append(mix(unit[:-1] * U64(0x9FB21C651E98DF25) + unit[1:] + U64(salt + 1))[same])
            rows.append(row[1:][same])

    unit = span_hash(low, start, end)
    grams(unit, 11)
    if shapes:
        kind = SHAPE[data]
        change = np.ones(len(kind), bool)
        change[1:] = kind[1:] != kind[:-1]
        change[start] = True
        place = np.concatenate([[0], np.cumsum(change)])
        grams(span_hash(kind[change], place[start], place[end]), 23)
        covered = repeated_windows(unit, row)
        found.append(np.full(int(covered.sum()), mix(np.array([37], U64))[0], U64))
        rows.append(row[covered])
    if chars and len(data) > 4:
        owner = np.repeat(np.arange(len(off) - 1), np.diff(off))
        x = low.astype(np.uint64)
        three = x[:-2] | (x[1:-1] << U64(8)) | (x[2:] << U64(16))
        whole = owner[2:] == owner[:-2]
        found.append(mix(three + U64(0x3000000000))[whole])
        rows.append(owner[2:][whole])
        four = three[:-1] | (x[3:] << U64(24))
        whole = owner[3:] == owner[:-3]
        found.append(mix(four + U64(0x4000000000))[whole])
        rows.append(owner[3:][whole])
    all_rows = np.concatenate(rows)
    order = np.argsort(all_rows, kind="stable")
    index = (np.concatenate(found) >> U64(64 - bits)).astype(np.int32)[order]
    return index, np.concatenate([[0], np.cumsum(np.bincount(all_rows, minlength=len(off) - 1))])


def repeated_windows(unit: np.ndarray, row: np.ndarray, width: int = 5) -> np.ndarray:
    """Which words lie in a ``width``-word window that its row holds twice or more."""
    covered = np.zeros(len(unit), bool)
    n = len(unit) - width + 1
    if n <= 1:
        return covered
    key = np.zeros(n, U64)
    for k in range(width):
        key = key * U64(0x9FB21C651E98DF25) + unit[k : k + n]
    key = mix(mix(key) + row[:n].astype(U64) * U64(0xD6E8FEB86659FD93))
    at = np.flatnonzero(row[:n] == row[width - 1 :])
    key = key[at]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    at = at[again]
    for k in range(width):
        covered[at + k] = True
    return covered
