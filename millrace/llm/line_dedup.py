"""Fuzzy line dedup by MinHash.

A line is what newlines part; its key is the lower-cased (A-Z) line, and lines of
white space are left alone. Lines are near-duplicates from a Jaccard similarity
of ``SIMILARITY`` of their sets of ``SHINGLE``-character strings (a shorter line
is its own only shingle). Of each connected component of such lines the first
occurrence stays, by (doc_id, line number); all others are removed.

* Signatures: ``BANDS`` bands of ``ROWS`` MinHash values, each over all shingles, so that
  a value agrees with probability J at any length. A pair at 0.8 misses all 16 bands
  with probability 2e-4.
* Banding: (key, line) entries go to reducers as packed arrays. A task first
  combines its own: of each key one line goes on as a *head*, the others as
  *members*. A reducer finds each key's least head, then streams the members past
  it; no bucket is gathered. This gives a star of candidates for each bucket.
* Verification: exact Jaccard of both lines, then distributed union-find. Where a
  bucket still spans components, all its pairs across components are verified
  too, in blocks inside tasks.

Lines are equal if their 128-bit hashes are. Links join nodes, the first halves; should two
lines share a node, one of them may lose its links, but no line goes for the other.
Rows are referred to by two 64-bit hashes of doc_id and text. Defined results. Null and
empty texts have no lines to remove and stay as they are. Rows equal in doc_id and
text count as one row, and lose the same lines. Null ids come last in order. All
columns pass through; ``n_chars``, if there is one, follows the new text. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .graph import connected
from .runtime import batches_of, cut, fresh, give_back, prepare, row_key, stored

SIMILARITY = 0.8
SHINGLE = 7
ROWS = 4
BANDS = 16
#: A bucket is verified in blocks of so many lines and pairs of such blocks.
BLOCK = 512
_FLUSH = 1_500_000
#: A flip and an odd factor for each MinHash function.
_FUNCTIONS = A.mix(np.arange(1, 2 * ROWS * BANDS + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB)).astype(np.uint32).reshape(-1, 2)
_FUNCTIONS[:, 1] |= np.uint32(1)
_SPACES = np.array([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D], np.uint32)


def lines_of(texts: list[str]) -> tuple[np.ndarray, ...]:
    """Prefix hashes of the lower-cased code points of all texts; and start, end, row and number of each line that is not blank."""
    code = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.cumsum(size + 1) - size - 1
    newline = np.flatnonzero(code == 10)
    start = np.concatenate([[0], newline + 1])
    end = np.append(newline, len(code))
    row = np.searchsorted(begin, start, "right") - 1
    number = np.arange(len(start)) - np.searchsorted(start, begin)[row]
    full = end > start
    full[full] = np.maximum.reduceat(code, start[full]) > 32
    for k in np.flatnonzero(~full & (end > start)).tolist():  # no character above the space: a control character may still be text
        full[k] = not np.isin(code[start[k] : end[k]], _SPACES).all()
    prefix = np.empty(len(code) + 1, np.uint64)
    prefix[0] = 0
    value = code.astype(np.uint64)
    value += np.where(code - np.uint32(65) < 26, np.uint64(33), np.uint64(1))
    value *= A.powers(len(code))
    np.cumsum(value, out=prefix[1:])
    return prefix, start[full], end[full], row[full], number[full]


def _hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return A.slice_hash(prefix, start, end) if len(start) else np.zeros(0, np.uint64)


def identities(lines: list[bytes]) -> np.ndarray:
    """128-bit hashes of lower-cased lines (lines x 2); the first half is a line's node."""
    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([digest(x) for x in lines]), np.int64).reshape(-1, 2)


def _low(texts: list[str]) -> bytes:
    return "\n".join(texts).encode("utf-8", "surrogatepass").lower()  # of bytes: A-Z only


def signatures(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Band keys (lines x bands) of the lines, none of them empty."""
    count = np.maximum(end - start - SHINGLE + 1, 0)
    if (count > 0).any():
        h = (prefix[SHINGLE:] - prefix[:-SHINGLE]) * A.powers(len(prefix) - SHINGLE, True)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xA0761D6478BD642F)
        h = (h >> np.uint64(32)).astype(np.uint32)
    else:
        h = np.zeros(0, np.uint32)
    short = np.flatnonzero(count == 0)
    h = np.append(h, (_hashes(prefix, start[short], end[short]) >> np.uint64(32)).astype(np.uint32))
    at, size = start.copy(), np.maximum(count, 1)
    at[short] = len(h) - len(short) + np.arange(len(short))
    h = h[A.ranges(at, size)]  # the lines' shingles, one line after another
    first = np.cumsum(size) - size
    key, value = np.zeros((BANDS, len(start)), np.uint64), np.empty_like(h)
    for band in range(BANDS):
        for flip, factor in _FUNCTIONS[band * ROWS : (band + 1) * ROWS]:
            np.bitwise_xor(h, flip, out=value)
            np.multiply(value, factor, out=value)
            key[band] = key[band] * np.uint64(0x9FB21C651E98DF25) + np.minimum.reduceat(value, first)
    return A.mix(key.T * np.uint64(0xD6E8FEB86659FD93) + np.arange(BANDS, dtype=np.uint64)[None, :])


def _runs(column: pa.Array, limit: int = 1 << 16) -> Iterator[tuple[int, list[str]]]:
    texts = [t or "" for t in column.to_pylist()]
    first, size = 0, 0
    for k, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield first, texts[first:k]
            first, size = k, 0
        size += len(t)
    if first < len(texts):
        yield first, texts[first:]


def _by_key(key: np.ndarray) -> np.ndarray:
    """The order of keys, with equal keys together: a sort of their high bits with the place below, exact unless two keys share these."""
    bits = np.uint64(max(len(key), 2).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    order = (np.sort(key & ~low | np.arange(len(key), dtype=np.uint64)) & low).astype(np.int64)
    sorted_ = key[order]
    return order if (sorted_[1:] >= sorted_[:-1]).all() else np.argsort(key, kind="stable")


def keyed_rows(docs: DataFrame) -> DataFrame:
    """(k1, k2, doc_id, text); k1 and k2 together stand for the row."""
    k1, k2 = row_key(docs)
    return docs.select(k1.alias("k1"), k2.alias("k2"), "doc_id", "text")


def occurrences(keyed: DataFrame) -> DataFrame:
    """(node, twin, k1, k2, doc_id, line) of every line that is not blank; node and twin are the 128-bit hash of the lower-cased line."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _runs(batch.column(3)):
                lines = _low(texts).split(b"\n")
                size = np.array([t.count("\n") + 1 for t in texts])
                full = np.array([x != b"" and not x.isspace() for x in lines], bool)
                row = np.repeat(np.arange(len(texts)), size)[full]
                number = A.ranges(np.zeros(len(texts), np.int64), size)[full]
                both = identities([x for x, keep in zip(lines, full.tolist(), strict=True) if keep])
                at = pa.array(row + first)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), *(batch.column(k).take(at) for k in range(3)), pa.array(number.astype(np.int32))], ["node", "twin", "k1", "k2", "doc_id", "line"])

    return keyed.mapInArrow(rows, f"node long, twin long, k1 long, k2 long, doc_id {keyed.schema['doc_id'].dataType.simpleString()}, line int")


def _line_bands(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for _, texts in _runs(column):
        prefix, start, end, _, _ = lines_of(texts)
        if len(start):
            node = identities([x for x in _low(texts).split(b"\n") if x and not x.isspace()])[:, 0].view(np.uint64)
            first = np.sort(np.unique(node, return_index=True)[1])
            yield signatures(prefix, start[first], end[first]), node[first]


def candidates(keyed: DataFrame, banded: Callable[[pa.Array], Iterator[tuple[np.ndarray, np.ndarray]]] = _line_bands) -> DataFrame:
    """(a, b, key): each bucket as a star; b is its least node. ``banded`` gives band keys (nodes x bands) and nodes of a text column."""
    spark = keyed.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def banding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        volume = 0

        def flush() -> pa.RecordBatch:
            key, node = (np.concatenate(x) for x in zip(*held, strict=True))
            order = _by_key(key)
            key, node = key[order], node[order]
            member = np.append(False, key[1:] == key[:-1])
            part = ((key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
            out = []
            for kind in (0, 1):
                some = np.flatnonzero(member == bool(kind))
                cuts = np.searchsorted(part[some], np.arange(parts + 1))  # keys are sorted, so parts are
                for p in np.flatnonzero(np.diff(cuts)).tolist():
                    at = some[cuts[p] : cuts[p + 1]]
                    out.append((p, kind, np.concatenate([key[at], node[at]]).tobytes()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.binary()), strict=True)], ["part", "kind", "body"])

        for batch in batches:
            for keys, node in banded(batch.column(0)):
                held.append((keys.ravel(), np.repeat(node, keys.shape[1])))
                volume += keys.size
            if volume >= _FLUSH:
                yield flush()
                held, volume = [], 0
        if held:
            yield flush()
        held = []
        give_back()

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads: list[np.ndarray] = []
        key = least = None

        def edges(a: np.ndarray, b: np.ndarray, k: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b, k)], ["a", "b", "key"])

        def settle() -> pa.RecordBatch:
            nonlocal key, least
            both = np.concatenate(heads, 1)
            k, node = both[:, _by_key(both[0])]
            new = np.append(True, k[1:] != k[:-1])
            key, least = k[new], np.minimum.reduceat(node, np.flatnonzero(new))
            low = least[np.cumsum(new) - 1]
            other = node != low
            return edges(node[other], low[other], k[other])

        for batch in batches:
            for kind, body in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                body = np.frombuffer(body, np.uint64).reshape(2, -1)
                if kind == 0:
                    heads.append(body)
                    continue
                if key is None:
                    yield settle()
                low = least[np.searchsorted(key, body[0])]
                other = body[1] != low
                yield edges(body[1][other], low[other], body[0][other])
        if key is None and heads:
            yield settle()

    bands = keyed.select("text").mapInArrow(banding, "part int, kind int, body binary")
    return bands.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "kind").mapInArrow(_by_part(stars), "a long, b long, key long")


def _by_part(function):
    """Starts ``function`` anew for each part of a sorted partition."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (batch.slice(k, 1) for batch in batches for k in range(batch.num_rows))
        row = next(rows, None)
        while row is not None:
            part, after = row.column(0)[0].as_py(), []

            def same(row=row, part=part, after=after) -> Iterator[pa.RecordBatch]:
                while row is not None and row.column(0)[0].as_py() == part:
                    yield row
                    row = next(rows, None)
                after.append(row)

            yield from function(same())
            row = after[0]

    return over


Shingles = Callable[[list[str]], list[np.ndarray]]


def _shingle_hashes(bodies: list[str]) -> list[np.ndarray]:
    """64-bit hashes of each line's shingles, with repeats."""
    prefix, start, end, _, _ = lines_of(bodies)
    count = np.maximum(end - start - SHINGLE + 1, 0)
    h = A.mix((prefix[SHINGLE:] - prefix[:-SHINGLE]) * A.powers(len(prefix) - SHINGLE, True)) if len(prefix) > SHINGLE else np.zeros(0, np.uint64)
    whole = _hashes(prefix, start, end)
    return [h[s : s + c] if c else whole[k : k + 1] for k, (s, c) in enumerate(zip(start.tolist(), count.tolist(), strict=True))]


def similar(left: list[np.ndarray], right: list[np.ndarray], of: np.ndarray) -> np.ndarray:
    """Whether each of up to 128 lists of shingle hashes reaches the similarity with its right one (number ``of``), all pairs at once.

    A shingle is told by 57 bits of its hash beside the pair's number: two different ones of a pair of 300 are taken as one with probability 1e-12.
    """

    def distinct(lists: list[np.ndarray]) -> np.ndarray:
        pair = np.repeat(np.arange(len(lists), dtype=np.uint64) << np.uint64(57), [len(x) for x in lists])
        return sorted_set(np.concatenate(lists) >> np.uint64(7) | pair)

    def sorted_set(key: np.ndarray) -> np.ndarray:
        key.sort()
        return key[np.append(True, key[1:] != key[:-1])] if len(key) else key

    def count(key: np.ndarray) -> np.ndarray:
        return np.bincount((key >> np.uint64(57)).astype(np.int64), minlength=len(left))

    a, b = distinct(left), distinct([right[k] for k in of.tolist()])
    both = np.concatenate([a, b])
    both.sort()
    common = count(both[1:][both[1:] == both[:-1]])
    return common >= SIMILARITY * (count(a) + count(b) - common)


def verified(pairs: DataFrame, lines: DataFrame, shingles: Shingles = _shingle_hashes) -> DataFrame:
    """(a, b, same): whether the exact similarity of each pair of nodes reaches the threshold."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = []
            for first in range(0, batch.num_rows, 100):
                part = batch.slice(first, 100)
                other = part.column(1).to_numpy()
                new = np.append(True, other[1:] != other[:-1])  # pairs come in order of b: each b is hashed once in a run
                found = shingles(part.column(2).to_pylist() + part.column(3).filter(pa.array(new)).to_pylist())
                same.append(similar(found[: len(other)], found[len(other) :], np.cumsum(new) - 1))
            if same:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(same))], ["a", "b", "same"])
        give_back()

    first = lines.select(F.col("node").alias("a"), F.col("body").alias("x"))
    second = lines.select(F.col("node").alias("b"), F.col("body").alias("y"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y").mapInArrow(rows, "a long, b long, same boolean")


def once(bodies: DataFrame, nodes: DataFrame) -> DataFrame:
    """Stored rows, one of each of the distinct nodes; only repeated rows of the input give more than one, and only then are bodies dealt out to find them."""
    out = stored(bodies)
    return out if out.count() == nodes.count() else stored(out.dropDuplicates(["node"]))


def _bodies(keyed: DataFrame, per_node: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, twin, body) of the wanted nodes, from one occurrence of each."""
    place = per_node.join(nodes, "node")
    place = place.groupBy("k1", "k2").agg(F.collect_list(F.struct("node", "twin", "line")).alias("wanted"))  # at most the row's lines

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, twin, body = [], [], []
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts = text.split("\n")
                node += [w["node"] for w in wanted]
                twin += [w["twin"] for w in wanted]
                body += [parts[w["line"]] for w in wanted]
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(twin, pa.int64()), pa.array(body, pa.string())], ["node", "twin", "body"])

    found = keyed.select("k1", "k2", "text").join(place, ["k1", "k2"]).select("text", "wanted").mapInArrow(rows, "node long, twin long, body string")
    return once(found, nodes)


def components(keyed: DataFrame, per_node: DataFrame) -> DataFrame:
    """(node, twin, root) of all lines that have a near-duplicate."""
    with batches_of(keyed.sparkSession, 16):
        edges = stored(candidates(keyed))
    found, lines = linked(edges, lambda nodes: _bodies(keyed, per_node, nodes))
    return found.join(lines.select("node", "twin"), "node")


def linked(edges: DataFrame, bodies: Callable[[DataFrame], DataFrame], shingles: Shingles = _shingle_hashes, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(node, root) of all nodes with a near-duplicate among the candidates (a, b, key), and what ``bodies`` gives: (node, body) of wanted nodes."""
    pairs = cut(edges.select("a", "b").distinct())
    lines = bodies(cut(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()))
    tested = stored(verified(pairs, lines, shingles))
    found = connected(tested.where("same").select("a", "b"))

    # buckets that still span components: there each pair across them is verified, inside the bucket's tasks
    def rooted(rows: DataFrame, name: str) -> DataFrame:
        of = found.select(F.col("node").alias(name), F.col("root").alias(f"r{name}"))
        return rows.join(of, name, "left").withColumn(f"r{name}", F.coalesce(f"r{name}", name))

    apart = rooted(rooted(tested.where("NOT same"), "a"), "b").where("ra <> rb").select("a", "b")
    keys = edges.join(apart, ["a", "b"]).select("key").distinct()
    held = cut(edges.join(keys, "key").select("key", F.explode(F.array("a", "b")).alias("a")).distinct())
    # bands of one family often have the same members: one of them will do
    sets = held.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a")).alias("x"), F.bit_xor(F.xxhash64("a", F.lit(1))).alias("y"))
    sets = sets.where("n > 2").groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("n") / block).cast("int").alias("parts"))
    members = rooted(held.join(sets, "key"), "a")
    mine = F.pmod(F.xxhash64("a"), F.col("parts")).cast("int")
    members = members.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    members = members.select("key", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"), F.col("a").alias("node"), F.col("ra").alias("root"))
    with batches_of(edges.sparkSession, 2_000):
        more = cut(_across(members.join(lines.select("node", "body"), "node"), shingles))
    if not more.isEmpty():
        found = connected(found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))
    return found, lines


def _links(node: np.ndarray, root: np.ndarray, hashes: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that join components (roots) of the lines with these shingles, all pairs compared.

    A line is a row of bits, one for each shingle of the group: a pair costs an ``and`` and a bit count.
    """
    size = np.array([len(x) for x in hashes])
    _, number = np.unique(np.concatenate(hashes), return_inverse=True)
    flags = np.zeros((len(hashes), (int(number.max()) + 64) & ~63), bool)
    flags[np.repeat(np.arange(len(hashes)), size), number] = True
    bits = np.packbits(flags, axis=1).view(np.uint64)
    size = flags.sum(1)
    order = np.argsort(size, kind="stable")
    node, root, bits, size = node[order], root[order].copy(), bits[order], size[order]
    out = []
    step = max(1, (1 << 20) // bits.size)
    for i in range(0, len(size), step):
        j = min(i + step, len(size))
        end = int(np.searchsorted(size, size[j - 1] / SIMILARITY, "right"))  # longer ones cannot reach it
        differ = root[i:j, None] != root[None, i:end]
        if not differ.any():
            continue
        common = np.bitwise_count(bits[i:j, None, :] & bits[None, i:end, :]).sum(2, dtype=np.int64)
        near = differ & (common >= SIMILARITY * (size[i:j, None] + size[None, i:end] - common))
        for x, y in zip(*(k.tolist() for k in np.nonzero(near)), strict=True):
            if root[i + x] != root[i + y]:
                root[root == root[i + y]] = root[i + x]
                out.append((int(node[i + x]), int(node[i + y])))
    return out


def _across(members: DataFrame, shingles: Shingles = _shingle_hashes) -> DataFrame:
    """Links (a, b) that join components inside the groups (key, p, q) of bounded size."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group = None, []

        def done() -> pa.RecordBatch:
            node, root = (np.array([r[k] for r in group]) for k in (0, 1))
            hashes = [x for k in range(0, len(group), 100) for x in shingles([body for *_, body in group[k : k + 100]])] if (root != root[0]).any() else None
            pairs = _links(node, root, hashes) if hashes else []
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != now and group:
                    yield done()
                    group = []
                now = row[:3]
                group.append(row[3:])
        if group:
            yield done()
        group = []
        give_back()

    source = members.select("key", "p", "q", "node", "root", "body").repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")
    return source.mapInArrow(rows, "a long, b long")


def removed_lines(docs: DataFrame) -> DataFrame:
    """(k1, k2, lines): the numbers of the lines that go, for every row that loses some."""
    prepare(docs.sparkSession)
    keyed = keyed_rows(docs)
    every = stored(occurrences(keyed))
    # an occurrence of each node, and their number: plain minima, which need no sort
    least = [F.min_by(c, "k1").alias(c) for c in ("twin", "k2", "line")]  # all of the same row, as they are compared alike
    per_node = stored(every.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("k1").alias("k1"), *least))
    found = components(keyed, per_node).select("node", F.col("twin").alias("linked"), "root")
    # from here on only lines that occur again or have a near-duplicate
    several = per_node.select("node", "n").join(found, "node", "left").where("root IS NOT NULL OR n > 1").select("node", "linked", "root")
    near = F.col("root").isNotNull() & (F.col("twin") == F.col("linked"))  # else a line that shares the node of another
    group = [F.coalesce(near, F.lit(False)).alias("near"), F.when(near, F.col("root")).otherwise(F.col("node")).alias("g1"), F.when(near, F.lit(0)).otherwise(F.col("twin")).alias("g2")]
    again = stored(every.join(several, "node").select("k1", "k2", "doc_id", "line", *group))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k1", "k2", "line")
    heads = again.groupBy("near", "g1", "g2").agg(F.min(place).alias("first")).select("near", "g1", "g2", F.col("first.k1").alias("f1"), F.col("first.k2").alias("f2"), F.col("first.line").alias("number"))
    gone = again.drop("doc_id").join(heads, ["near", "g1", "g2"]).where("k1 <> f1 OR k2 <> f2 OR line <> number")
    return cut(gone.groupBy("k1", "k2").agg(F.sort_array(F.collect_set("line")).alias("lines")))


def dedup(docs: DataFrame, count_column: str | None = "n_removed_lines") -> DataFrame:
    """docs with the near-duplicate lines removed and, unless it is None, a column with their number, last; it replaces one of that name."""
    docs = docs.drop(count_column) if count_column is not None else docs
    names, at = docs.columns, docs.columns.index("text")
    k1, k2, gone = (fresh(x, names) for x in ("k1", "k2", "gone"))
    keys = row_key(docs)
    removed = removed_lines(docs).withColumnsRenamed({"k1": k1, "k2": k2, "lines": gone})
    joined = docs.withColumns({k1: keys[0], k2: keys[1]}).join(removed, [k1, k2], "left").select(*(F.col(f"`{c}`") for c in names), gone)
    count = names.index("n_chars") if "n_chars" in names else None

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts, removed = [], []
            for text, lines in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist(), strict=True):
                removed.append(len(lines or ()))
                if lines:
                    out = set(lines)
                    text = "\n".join([x for k, x in enumerate(text.split("\n")) if k not in out])
                texts.append(text)
            columns = [batch.column(k) for k in range(len(names))]
            columns[at] = pa.array(texts, columns[at].type)
            if count is not None and pa.types.is_integer(columns[count].type):
                columns[count] = pa.array([None if t is None else len(t) for t in texts], columns[count].type)
            if count_column is not None:
                columns.append(pa.array(removed, pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, [*names, *[count_column][: count_column is not None]])

    return joined.mapInArrow(rows, docs.withColumn(count_column, F.lit(0)).schema if count_column is not None else docs.schema)
