"""Benchmark decontamination by spaced-seed hashing.

Tokens are lower-cased runs of letters, digits and non-ASCII characters. A
document is contaminated by an item when some aligned window of ``WINDOW`` tokens
of the item (of all its tokens, if fewer) occurs in it with at most a fifth of
the tokens substituted. Fixed masks ignore selected token positions; they are
derived by a greedy cover, so that *every* such window, wherever its
substitutions are, is hit by a mask - candidate search loses nothing. Hits are
verified token by token along their diagonal.

The test items are taken in blocks of about ``ITEMS_PER_BLOCK`` items and
``BYTES_PER_BLOCK`` bytes; the seeds of a block are the bounded side of the join, which is
broadcast, and each block meets every document. Of several blocks, each is finished
before the next is built, so that the driver holds one at a time. Hits are kept as
diagonals; seeds that are frequent on both sides give them by convolution.

Defined results. Null and empty texts, on either side, match nothing. Items of
fewer than ``MIN_TOKENS`` tokens are too short to tell and are skipped. Null ids
pass through as null. Repeated items and documents each give their own rows. An empty table gives no rows. Only
``doc_id``/``item_id`` and ``text`` are read; ``keep_rows`` passes all columns on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, partial, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .runtime import prepare, stored

WINDOW = 13
MIN_TOKENS = 5
ITEMS_PER_BLOCK = 20_000
BYTES_PER_BLOCK = 16 << 20
#: More pairs of places than that, of one seed in a row and its items, are reduced to diagonals without being listed.
HOT_PAIRS = 1 << 14
_TABLE_BITS = 22

_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True


@lru_cache
def masks(window: int) -> tuple[int, tuple[tuple[int, ...], ...]]:
    """Allowed substitutions in a window, and masks (kept offsets) that hit it however they fall.

    Starts from the heaviest weight whose greedy cover needs at most four masks.
    """
    errors = window // 5
    patterns = [set(range(window)) - set(x) for k in range(errors + 1) for x in combinations(range(window), k)]
    for weight in range(min(6, window - errors), 1, -1):
        span = min(window - 1, weight + 4)
        shapes = [(0, *x) for x in combinations(range(1, span), weight - 1)]
        covers = {s: {k for k, p in enumerate(patterns) if any(all(i + o in p for o in s) for i in range(window - s[-1]))} for s in shapes}
        left, chosen = set(range(len(patterns))), []
        while left and len(chosen) < 4:
            best = max(shapes, key=lambda s: (len(covers[s] & left), -s[-1], s))
            if not covers[best] & left:
                break
            chosen.append(best)
            left -= covers[best]
        if not left:
            return errors, tuple(chosen)
    return errors, ((0,),)


def tokens(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of rows: (first row, end row, token hashes, token bounds of the rows)."""
    column = pc.utf8_lower(column)
    for i, j, d, o in A.blocks(*A.column_bytes(column)):
        start, end = A.spans(_IN_WORD[d], o)
        yield i, j, A.span_hash(d, start, end), np.searchsorted(start, o)


def _seeds(token: np.ndarray, mask: tuple[int, ...], salt: int) -> np.ndarray:
    n = len(token) - mask[-1]
    h = np.full(max(n, 0), np.uint64(salt))
    for o in mask:
        h = h * np.uint64(0x9FB21C651E98DF25) + token[o : o + len(h)]
    return h ^ (h >> np.uint64(31))


def _one(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return column


@dataclass
class SeedIndex:
    """The seeds of one block of items, sorted, with a bit table in front."""

    items: list[np.ndarray]
    flat: np.ndarray  # all items' tokens; where each item starts, and its size
    first: np.ndarray
    size: np.ndarray
    errors: np.ndarray  # allowed substitutions by width of window
    ids: pa.Array
    masks: list[tuple[int, ...]]
    seed: np.ndarray
    item: np.ndarray
    place: np.ndarray
    table: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table) -> SeedIndex:
        items, ids = [], []
        for i, _, h, bound in tokens(_one(rows.column("text"))):
            for k in range(len(bound) - 1):
                if bound[k + 1] - bound[k] >= MIN_TOKENS:
                    items.append(h[bound[k] : bound[k + 1]])
                    ids.append(i + k)
        by_mask: dict[tuple[int, ...], list] = {}
        for n, item in enumerate(items):
            for m in masks(min(WINDOW, len(item)))[1]:
                by_mask.setdefault(m, []).append(n)
        seed, owner, place = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k, (m, owners) in enumerate(by_mask.items()):
            for n in owners:
                s = _seeds(items[n], m, k + 1)
                seed.append(s)
                owner.append(np.full(len(s), n))
                place.append(np.arange(len(s)))
        seed, owner, place = np.concatenate(seed), np.concatenate(owner), np.concatenate(place)
        order = np.lexsort((place, owner, seed))
        table = np.zeros(1 << _TABLE_BITS, bool)
        table[seed >> np.uint64(64 - _TABLE_BITS)] = True
        size = np.array([len(x) for x in items], np.int64)
        flat = np.concatenate([*items, np.zeros(0, np.uint64)])
        return cls(items, flat, np.cumsum(size) - size, size, np.array([w // 5 for w in range(WINDOW + 1)]), _one(rows.column("item_id")).take(pa.array(ids, pa.int64())), list(by_mask), seed[order], owner[order], place[order], table)

    def hits(self, token: np.ndarray, bound: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(row, item number, tokens of the row before the window, matched tokens) of each contaminated row and item."""
        row = np.repeat(np.arange(len(bound) - 1), np.diff(bound))
        found = [np.zeros((0, 3), np.int64)]
        for k, m in enumerate(self.masks):
            s = _seeds(token, m, k + 1)
            at = np.flatnonzero(self.table[s >> np.uint64(64 - _TABLE_BITS)])
            at = at[row[at] == row[at + m[-1]]]
            low = np.searchsorted(self.seed, s[at], "left")
            count = np.searchsorted(self.seed, s[at], "right") - low
            at, low, count = (x[count > 0] for x in (at, low, count))
            # a seed that is frequent in row and items meets on far fewer diagonals than it has pairs
            kind = np.stack([row[at], low], 1)
            kinds, which, times = np.unique(kind, axis=0, return_inverse=True, return_counts=True) if len(at) else (kind, at, at)
            hot = np.flatnonzero(times * count[np.unique(which, return_index=True)[1]] > HOT_PAIRS) if len(at) else at
            order = np.argsort(which, kind="stable") if len(hot) else at
            ends = np.cumsum(times)
            for h in hot.tolist():
                mine = order[ends[h] - times[h] : ends[h]]
                some = slice(int(kinds[h, 1]), int(kinds[h, 1] + count[mine[0]]))
                for n, places in _grouped(self.item[some], self.place[some]):
                    start = _diagonals(at[mine], places)
                    found.append(np.stack([np.full(len(start), kinds[h, 0]), np.full(len(start), n), start], 1))
            cold = ~np.isin(which, hot)
            at, low, count = at[cold], low[cold], count[cold]
            for part in _volumes(count):
                entry = A.ranges(low[part], count[part])
                each = np.repeat(at[part], count[part])
                found.append(np.unique(np.stack([row[each], self.item[entry], each - self.place[entry]], 1), axis=0))
        return self._verified(token, bound, np.unique(np.concatenate(found), axis=0))

    def _verified(self, token: np.ndarray, bound: np.ndarray, found: np.ndarray) -> list[tuple[int, int, int, int]]:
        """The best window of each row and item on the given diagonals: most matches, then the first; full matches end the search."""
        best: dict[tuple[int, int], tuple[int, int]] = {}
        row, item, start = found.T
        low, high = np.maximum(start, bound[row]), np.minimum(start + self.size[item], bound[row + 1])
        width = np.minimum(WINDOW, self.size[item])
        some = np.flatnonzero(high - low >= width)
        pair = row[some] * len(self.items) + item[some]
        for part in _volumes((high - low)[some]):
            done = np.array([r * len(self.items) + n for (r, n), (_, same) in best.items() if same == min(WINDOW, self.size[n])], np.int64)
            now = some[part][~np.isin(pair[part], done)]
            if not len(now):
                continue
            size, w = (high - low)[now], width[now]
            place = A.ranges(low[now], size)
            same = token[place] == self.flat[place - np.repeat(start[now] - self.first[item[now]], size)]
            total = np.concatenate([[0], np.cumsum(same)])
            begin = np.cumsum(size) - size
            windows = size - w + 1
            left = A.ranges(begin, windows)
            inside = total[left + np.repeat(w, windows)] - total[left]
            at = np.cumsum(windows) - windows
            most = np.maximum.reduceat(inside, at)
            first = np.minimum.reduceat(np.where(inside == np.repeat(most, windows), left, len(same)), at) - begin
            for k in np.flatnonzero(most >= w - self.errors[w]).tolist():
                r, n = int(row[now[k]]), int(item[now[k]])
                if most[k] > best.get((r, n), (0, 0))[1]:
                    best[r, n] = (int(low[now[k]] + first[k] - bound[r]), int(most[k]))
        return [(r, n, *x) for (r, n), x in sorted(best.items())]


def _grouped(key: np.ndarray, value: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The values of each of the sorted keys."""
    cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
    for k, part in zip(key[np.append(0, cuts)].tolist(), np.split(value, cuts), strict=True):
        yield k, part


def _volumes(count: np.ndarray, limit: int = 1 << 20) -> Iterator[slice]:
    """Runs of entries whose counts add up to about ``limit``."""
    total, a = np.cumsum(count), 0
    while a < len(count):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + limit, "right")))
        yield slice(a, b)
        a = b


def _diagonals(at: np.ndarray, places: np.ndarray) -> np.ndarray:
    """All distinct differences of the two sorted position lists, by convolution where they are many."""
    if len(at) * len(places) <= HOT_PAIRS:
        return np.unique(at[:, None] - places[None, :])
    a, b = at - at[0], places[-1] - places
    size = 1 << int(a[-1] + b[0] + 1).bit_length()
    x, y = np.zeros(size), np.zeros(size)
    x[a] = y[b] = 1.0
    return np.flatnonzero(np.fft.irfft(np.fft.rfft(x) * np.fft.rfft(y), size) > 0.5) + at[0] - places[-1]


def indexes(benchmark: DataFrame) -> tuple[int, Iterator[SeedIndex]]:
    """The number of blocks, and the seed index of each, one at a time."""
    rows = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    count, volume = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-count // ITEMS_PER_BLOCK), -(-volume // BYTES_PER_BLOCK))

    def each() -> Iterator[SeedIndex]:
        for b in range(blocks):
            block = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
            yield SeedIndex.of(block.toArrow())

    return blocks, each()


def _by_block(source: Callable[[DataFrame | None], DataFrame], benchmark: DataFrame, task: Callable, schema) -> Iterator[DataFrame]:
    """``mapInArrow`` with each block's index over what ``source`` makes of the part before; of several, each is done and dropped before the next is built."""
    blocks, found = indexes(benchmark)
    part = None
    for index in found:
        shared = benchmark.sparkSession.sparkContext.broadcast(index)
        part = source(part).mapInArrow(partial(task, shared), schema)
        if blocks > 1:
            part = stored(part)
            shared.destroy()
        yield part


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item that contaminates it: doc_id, item_id, token_offset, matched_tokens."""
    prepare(docs.sparkSession)
    source = docs.select("doc_id", "text")
    names = ["doc_id", "item_id", "token_offset", "matched_tokens"]
    schema = f"doc_id {source.schema['doc_id'].dataType.simpleString()}, item_id {benchmark.schema['item_id'].dataType.simpleString()}, token_offset long, matched_tokens int"

    def rows(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, _, token, bound in tokens(batch.column(1)):
                if got := shared.value.hits(token, bound):
                    r, n, offset, matched = zip(*got, strict=True)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([i + k for k in r])), _one(shared.value.ids).take(pa.array(n)), pa.array(offset, pa.int64()), pa.array(matched, pa.int32())], names)

    return reduce(DataFrame.unionByName, _by_block(lambda _: source, benchmark, rows, schema))


def keep_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that no item contaminates."""
    prepare(docs.sparkSession)
    at = docs.columns.index("text")

    def rows(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            for i, _, token, bound in tokens(batch.column(at)):
                clean[[i + r for r, *_ in shared.value.hits(token, bound)]] = False
            yield batch.filter(pa.array(clean))

    return reduce(lambda _, part: part, _by_block(lambda part: docs if part is None else part, benchmark, rows, docs.schema))
