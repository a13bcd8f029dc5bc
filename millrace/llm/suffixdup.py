"""Suffix-array dedup: removes every byte of a 200-byte string that also starts anywhere else.

Suffixes are first dealt out so that equal 200-byte strings meet: each string
has a minimiser, the least hash of its 32-byte substrings, and neighbouring
strings with one minimiser form a *segment*. Segments with a minimiser of their
own hold no repeat. Equal segments are counted, not gathered. Where a minimiser
has several different segments, one of each is sent to a task, and there a suffix
array is built in two stages: suffixes smaller than their successors are sorted
directly (to the depth that counts), all others are induced from them by bucket
scans from the least byte to the greatest, and the common prefixes of neighbours
tell which strings repeat. Only suffixes that start a string, and the chain that
induces them, are sorted.

A minimiser with more than ``MAX_GROUP`` different segments is not gathered: its
strings are dealt out once more by their own 128-bit hashes, the finest buckets
there are, in which counting replaces sorting.

Segments are equal if their 128-bit hashes are; rows are referred to by two 64-bit
hashes of doc_id and text. Defined results. Null
texts are empty; texts of under 200 bytes lose nothing; repeated rows repeat each
other, so all of theirs from 200 bytes on goes. An empty table gives an empty
result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .runtime import arrow_map, batches_of, cut, prepare, row_key, stored

LENGTH = 200
GRAM = 32
MAX_GROUP = 8192
#: Bytes of segments in one suffix array, but for a larger group.
ARRAY_BYTES = 1 << 20
PIECE = 1 << 22
_M = np.uint64(0xC4CEB9FE1A85EC53)


def segments(data: np.ndarray, off: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Minimiser, 128-bit content hash (segments x 2), row, start in the row, number of strings and tie mark of each segment of a block.

    The place of a minimiser, modulo 256, breaks ties of its hash; windows are
    shorter than that, so a change of the minimum marks a new segment. A segment
    is marked if the least and the greatest place differ in one of its windows:
    only then can it hold one string twice.
    """
    window = length - GRAM + 1
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros((0, 2), np.int64), *(np.zeros(0, np.int64),) * 4
    prefix = A.prefix_hash(data)
    low = (prefix[GRAM:] - prefix[:-GRAM]) * A.powers(len(prefix) - GRAM, True)
    low ^= low >> np.uint64(32)
    low *= _M
    low &= np.uint64(0xFFFFFFFFFFFFFF00)
    low |= np.arange(len(low), dtype=np.uint64) & np.uint64(255)

    def least(x: np.ndarray) -> np.ndarray:
        size = 1
        while 2 * size <= window:
            x = np.minimum(x[:-size], x[size:])
            size *= 2
        return np.minimum(x[: size - window], x[window - size :]) if size < window else x

    tied = np.concatenate([[0], np.cumsum(least(low ^ np.uint64(255)) != least(low) ^ np.uint64(255))])
    low = least(low)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))[:n]
    whole = np.arange(n) + length <= off[row + 1]
    new = np.ones(n, bool)
    new[1:] = (low[1:] != low[:-1]) | ~whole[:-1] | (row[1:] != row[:-1])
    start = np.flatnonzero(new & whole)
    limit = np.append(np.flatnonzero(new | ~whole), n)
    end = limit[np.searchsorted(limit, start, "right")]
    raw, digest = data.tobytes(), xxhash.xxh3_128_digest
    content = np.frombuffer(b"".join([digest(raw[s:e]) for s, e in zip(start.tolist(), (end + length - 1).tolist(), strict=True)]), np.int64).reshape(-1, 2)
    return low[start] >> np.uint64(8), content, row[start], start - off[row[start]], end - start, (tied[end] > tied[start]).astype(np.int64)


def _pieces(data: np.ndarray, off: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks as (first row, base in that row, bytes, offsets); very long rows come in overlapping pieces."""
    for i, j, d, o in A.blocks(data, off):
        if j - i > 1 or len(d) <= PIECE:
            yield i, 0, d, o
        else:
            for base in range(0, len(d) - length + 1, PIECE):
                part = d[base : base + PIECE + length - 1]
                yield i, base, part, np.array([0, len(part)])


def suffix_order(text: np.ndarray, wanted: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Suffix array of the wanted suffixes of ``text``, right to ``depth`` bytes, by two-stage sorting.

    ``wanted`` marks suffix starts. The result holds them and the suffixes that induce them.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    # types: True where the suffix is smaller than its successor; the last one counts as that
    differ = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)
    run_end = differ[np.searchsorted(differ, np.arange(n))]
    rising = np.append(text[:-1] < text[1:], True)[run_end]
    # close the wanted set under "successor" up to the next directly sorted suffix
    base = np.flatnonzero(rising)
    at = np.flatnonzero(wanted)
    used = np.zeros(n + 1, np.int32)
    np.add.at(used, at, 1)
    np.add.at(used, base[np.searchsorted(base, at)] + 1, -1)
    used = np.cumsum(used[:-1]) > 0

    padded = np.concatenate([text, np.zeros(depth + 16, np.uint8)])
    word = np.zeros(n + depth + 8, np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | padded[k : k + len(word)]

    # first stage: direct sort, eight bytes at a time, of ties only
    order = np.flatnonzero(rising & used)
    order = order[np.argsort(word[order], kind="stable")]
    group = np.concatenate([[0], np.cumsum(word[order][1:] != word[order][:-1])]) if len(order) else order
    place, done = np.arange(len(order)), 8
    while done < depth and len(place):
        tied = np.zeros(len(place), bool)
        same = group[1:] == group[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        place, group = place[tied], group[tied]
        if not len(place):
            break
        suffix = order[place]
        head = np.append(True, group[1:] != group[:-1])
        key = word[suffix + done]
        while (head[1:] | (key[1:] == key[:-1])).all():  # a common stretch of all ties is passed over
            done += 8
            if done >= depth:
                break
            key = word[suffix + done]
        else:
            moved = np.lexsort((key, group))
            suffix, key = suffix[moved], key[moved]
            order[place] = suffix
            group = np.cumsum(np.append(True, (group[1:] != group[:-1]) | (key[1:] != key[:-1])))
            done += 8

    # second stage: scan the buckets upwards; each suffix puts its larger predecessor into that one's bucket
    first = text[order]
    bound = np.searchsorted(first, np.arange(257))
    larger = used & ~rising
    arrived: list[list[np.ndarray]] = [[] for _ in range(256)]
    out: list[np.ndarray] = []

    def induce(found: np.ndarray, own: int) -> np.ndarray:
        """Sends the predecessors on; returns those of the scanned bucket itself."""
        before = found[found > 0] - 1
        before = before[larger[before]]
        byte = text[before]
        mine = before[byte == own]
        before, byte = before[byte != own], byte[byte != own]
        if len(before):
            split = np.argsort(byte, kind="stable")
            before, byte = before[split], byte[split]
            cuts = np.flatnonzero(byte[1:] != byte[:-1]) + 1
            for b, part in zip(byte[np.append(0, cuts)].tolist(), np.split(before, cuts), strict=True):
                arrived[b].append(part)
        return mine

    for b in range(256):
        now = np.concatenate(arrived[b]) if arrived[b] else np.zeros(0, np.int64)
        arrived[b] = []
        while len(now):
            out.append(now)
            now = induce(now, b)
        direct = order[bound[b] : bound[b + 1]]
        if len(direct):
            out.append(direct)
            induce(direct, b)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def repeated_starts(text: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which of the marked starts begin a ``length``-byte string that another one begins, too."""
    order = suffix_order(text, starts, length)
    order = order[starts[order]]
    found = np.zeros(len(text), bool)
    if len(order) < 2:
        return found
    a, b = order[:-1], order[1:]
    padded = np.concatenate([text, np.zeros(16, np.uint8)])
    word = np.zeros(len(text) + 8, np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | padded[k : k + len(word)]
    done = 0
    while done < length and len(a):  # common prefixes of neighbours, word by word
        at = min(done, length - 8)
        same = word[a + at] == word[b + at]
        a, b = a[same], b[same]
        done += 8
    found[a] = found[b] = True
    return found


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    start = np.flatnonzero(edge == 1)
    return start, np.flatnonzero(edge == -1) - start


def _arrays(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Suffix arrays over runs of whole groups; rows come sorted by minimiser."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        size = np.array([len(r[3]) + 1 for r in rows])
        begin = np.cumsum(size) - size
        text = np.frombuffer(b"\0".join([r[3] for r in rows]) + b"\0", np.uint8)
        starts = np.zeros(len(text), bool)
        starts[A.ranges(begin, size - length)] = True
        found = repeated_starts(text, starts, length)
        out = []
        for (mh, s1, s2, _), b, n in zip(rows, begin.tolist(), (size - length).tolist(), strict=True):
            if found[b : b + n].any():
                out.append((mh, s1, s2, *(x.astype(np.int32).tobytes() for x in _runs(found[b : b + n]))))
        columns = list(zip(*out, strict=True)) or [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(),) * 3 + (pa.binary(),) * 2, strict=True)], ["mh", "s1", "s2", "at", "run"])

    held: list[tuple] = []
    volume = 0
    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            if volume >= ARRAY_BYTES and row[0] != held[-1][0]:
                yield solve(held)
                held, volume = [], 0
            held.append(row)
            volume += len(row[3])
    if held:
        yield solve(held)


_SEGMENT = ["mh", "s1", "s2"]


def _keyed(docs: DataFrame) -> DataFrame:
    k1, k2 = row_key(docs)
    return docs.select("doc_id", k1.alias("k1"), k2.alias("k2"), "text")


def removed_runs(docs: DataFrame, *, length: int = LENGTH, max_group: int = MAX_GROUP) -> DataFrame:
    """(k1, k2, start, n): string starts whose strings repeat, as runs; k1 and k2 stand for the row."""
    spark = prepare(docs.sparkSession)
    keyed = _keyed(docs)

    def cutting(batch: pa.RecordBatch) -> dict:
        data, off = A.column_bytes(batch.column("text"))
        keys = [batch.column(k).to_numpy() for k in ("k1", "k2")]
        parts = []
        for i, base, d, o in _pieces(data, off, length):
            mh, content, row, start, n, tie = segments(d, o, length)
            parts.append((mh.view(np.int64), content[:, 0], content[:, 1], *(k[i + row] for k in keys), (start + base) << 9 | tie << 8 | n))
        return dict(zip((*_SEGMENT, "k1", "k2", "pos"), (np.concatenate(x) for x in zip(*parts, strict=True)), strict=True))

    every = stored(arrow_map(keyed.select("k1", "k2", "text"), cutting, "mh long, s1 long, s2 long, k1 long, k2 long, pos long"))
    twice = F.sum(F.expr("1 + (shiftright(pos, 8) & 1)"))  # a tied segment may repeat itself
    shared = cut(every.groupBy("mh").agg(twice.alias("c")).where("c > 1").select("mh"))  # a plain side, so that a hot key's partition can be split
    every = stored(every.join(shared, "mh"))
    least = [F.min_by(c, "k1").alias(c) for c in ("k2", "pos")]  # of the same place, as they are compared alike
    distinct = cut(every.groupBy(*_SEGMENT).agg(F.count(F.lit(1)).alias("n"), F.min("k1").alias("k1"), *least))
    kinds = cut(distinct.groupBy("mh").agg(twice.alias("kinds")).where("kinds > 1"))

    # one copy of each segment that shares its minimiser with different ones
    mixed = distinct.join(kinds, "mh")
    by_row = mixed.groupBy("k1", "k2").agg(F.collect_list(F.struct(*_SEGMENT, "kinds", "pos")).alias("parts"))  # at most the row's segments

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = A.column_bytes(batch.column(0))
            lists = batch.column(1)
            parts = lists.flatten()
            sizes = np.diff(lists.offsets.to_numpy())
            pos = parts.field("pos").to_numpy()
            at = np.repeat(off[:-1], sizes) + (pos >> 9)
            raw = data.tobytes()
            cuts = [raw[s : s + m] for s, m in zip(at.tolist(), ((pos & 255) + length - 1).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(parts.field(c) for c in _SEGMENT), parts.field("kinds"), pa.array(cuts, pa.binary())], [*_SEGMENT, "kinds", "body"])

    bodies = stored(keyed.select("k1", "k2", "text").join(by_row, ["k1", "k2"]).select("text", "parts").mapInArrow(texts, "mh long, s1 long, s2 long, kinds long, body binary"))
    # repeated rows give their segments more than once
    gathered = bodies.where(F.col("kinds") <= max_group).select(*_SEGMENT, "body").repartition("mh").sortWithinPartitions(*_SEGMENT)
    with batches_of(spark, 5_000):
        found = stored(gathered.mapInArrow(lambda batches: _arrays(batches, length), "mh long, s1 long, s2 long, at binary, run binary").unionByName(_hot(bodies.where(F.col("kinds") > max_group), length)))

    # all strings of a segment that occurs again repeat; of others, those that the arrays found
    whole = distinct.where("n > 1").select(*_SEGMENT)
    marks = every.join(whole, _SEGMENT).select("k1", "k2", F.shiftright("pos", 9).cast("long").alias("start"), F.expr("pos & 255").alias("n"))
    once = distinct.where("n = 1").select(*_SEGMENT, "k1", "k2", "pos")

    def spread(batch: pa.RecordBatch) -> dict:
        at, run = (A.column_bytes(batch.column(k)) for k in ("at", "run"))
        each = np.diff(at[1]) // 4
        pos = batch.column("pos").to_numpy()
        rows = {k: np.repeat(batch.column(k).to_numpy(), each) for k in ("k1", "k2")}
        return rows | {"start": np.repeat(pos >> 9, each) + np.frombuffer(at[0].tobytes(), np.int32), "n": np.frombuffer(run[0].tobytes(), np.int32).astype(np.int64)}

    return marks.union(arrow_map(once.join(found, _SEGMENT).select("k1", "k2", "pos", "at", "run"), spread, "k1 long, k2 long, start long, n long"))


def _hot(bodies: DataFrame, length: int) -> DataFrame:
    """Repeated strings of the segments of very common minimisers, by 128-bit hashes of whole strings."""

    def strings(batch: pa.RecordBatch) -> dict:
        place, a, b = [], [], []
        for body in batch.column("body").to_pylist():
            n = len(body) - length + 1
            got = np.frombuffer(b"".join([xxhash.xxh3_128_digest(body[k : k + length]) for k in range(n)]), np.int64).reshape(-1, 2)
            place.append(np.arange(n, dtype=np.int32))
            a.append(got[:, 0])
            b.append(got[:, 1])
        size = [len(x) for x in place]
        rest = {k: np.concatenate(v) for k, v in zip(("place", "a", "b"), (place, a, b), strict=True)}
        return {k: np.repeat(batch.column(k).to_numpy(), size) for k in _SEGMENT} | rest

    each = arrow_map(bodies.select(*_SEGMENT, "body").dropDuplicates(_SEGMENT), strings, "mh long, s1 long, s2 long, place int, a long, b long")
    again = each.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("a", "b")
    hit = each.join(again, ["a", "b"]).groupBy(*_SEGMENT).agg(F.sort_array(F.collect_set("place")).alias("places"))

    def pack(batch: pa.RecordBatch) -> dict:
        at = [np.array(x, np.int32) for x in batch.column("places").to_pylist()]
        return {k: batch.column(k) for k in _SEGMENT} | {"at": pa.array([x.tobytes() for x in at], pa.binary()), "run": pa.array([np.ones_like(x).tobytes() for x in at], pa.binary())}

    return arrow_map(hit, pack, "mh long, s1 long, s2 long, at binary, run binary")


def dedup(docs: DataFrame, *, length: int = LENGTH, max_group: int = MAX_GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes) and spans of every row."""
    marks = removed_runs(docs, length=length, max_group=max_group)
    marks = marks.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "n")).alias("runs"))  # at most the row's segments, however often it occurs
    joined = _keyed(docs).join(cut(marks), ["k1", "k2"], "left").select("doc_id", "text", "runs")

    def rows(batch: pa.RecordBatch) -> dict:
        data, off = A.column_bytes(batch.column("text"))
        raw = data.tobytes()
        removed, spans, kept = [], [], []
        runs = batch.column("runs")
        bound = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(runs), 0).to_numpy())])
        start, count = (runs.flatten().field(k).to_numpy() for k in ("start", "n"))
        for k in range(len(runs)):
            body = raw[off[k] : off[k + 1]]
            if bound[k + 1] > bound[k]:
                s, n = start[bound[k] : bound[k + 1]], count[bound[k] : bound[k + 1]]
                edge = np.zeros(len(body) + 1, np.int32)
                np.add.at(edge, s, 1)
                np.add.at(edge, s + n + length - 1, -1)
                gone = np.cumsum(edge[:-1]) > 0
                at, size = _runs(gone)
                body = np.frombuffer(body, np.uint8)[~gone].tobytes()
                spans.append([{"start": int(a), "end": int(a + b)} for a, b in zip(at, size, strict=True)])
                removed.append(int(gone.sum()))
            else:
                spans.append([])
                removed.append(0)
            kept.append(body)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return {"doc_id": batch.column("doc_id"), "n_bytes": np.diff(off), "n_removed": pa.array(removed, pa.int64()), "kept": pa.array(kept, pa.binary()), "spans": pa.array(spans, kind)}

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, kept binary, spans array<struct<start: bigint, end: bigint>>"
    names = ["doc_id", "n_bytes", "n_removed", "kept", "spans"]

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = rows(batch)
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in (out[n] for n in names)], names)

    return joined.mapInArrow(over, schema)
