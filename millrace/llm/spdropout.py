"""SentencePiece BPE encoding with seeded merge-dropout, and lossless decoding.

The vocabulary of a public SentencePiece BPE model is read; nothing is trained.
Encoding works through an agenda of candidate merges, best score first and
leftmost among equals. A candidate is skipped when a keyed hash of (seed, doc_id,
the chunk's place in the text, candidate's start, middle and end) falls below the
dropout rate; a skipped candidate never comes back, but a later merge beside it makes
a new one. The key holds no random state, so any task, retry or cluster size gives the
same pieces. Every occurrence of a chunk has its own draws.

No piece holds a word mark after another character, so a text is cut before its
spaces and at newlines without changing any merge. A worker remembers agendas, not
draws: a *node* is a chunk with the set of candidates skipped so far, and holds the
pieces and the candidates that this agenda met for the first time. An occurrence starts
at its chunk's node without skips and draws for the node's candidates; it goes on to the
node that skips those drawn too, until a node's draws skip nothing: from there its own
agenda would be the same. A node is made when it is wanted again. Short chunks run the agenda in numpy, all rows at a
time; chunks over ``LONG`` characters use a heap, for each occurrence. With dropout 0 the
pieces are those of the library. A literal word mark (U+2581) is written in byte pieces, which the
library does not do, so that it is not read back as a space.

Defined results. Null and empty texts have no pieces and decode to the empty
text. Characters outside the vocabulary become byte pieces. Repeated rows of one
doc_id are segmented alike. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame

from . import arrays as A
from .runtime import arrow_map, give_back, prepare

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
LONG = 64
#: Chunks, and transitions between nodes, that a worker remembers before it starts afresh.
REMEMBERED = 400_000
#: A node with more new candidates is not remembered: its occurrences run their own agendas.
_MASK_BITS = 40
#: Instead of a node: never met, and met once, when its occurrence ran its own agenda.
_NEW, _ONCE = -1, -2
MARK = "▁"
_CHUNK = re.compile(r" *[^ \n]+|\n| +")
_NONE = np.int32(1 << 30)
_K1, _K2, _K3, _K4 = (np.uint64(x) for x in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))


class Vocabulary:
    """Pieces, their bytes, and a hash table of mergeable pairs."""

    def __init__(self, proto: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        self.size = n
        self.byte_id = np.zeros(256, np.int32)
        raw: list[bytes] = []
        plain: dict[str, int] = {}
        for i, p in enumerate(names):
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
                raw.append(bytes([int(p[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                raw.append(b"")
            else:
                plain[p] = i
                raw.append(p.replace(MARK, " ").encode())
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_length = np.array([len(x) for x in raw])
        self.raw_start = np.cumsum(self.raw_length) - self.raw_length
        order = sorted(plain, key=lambda p: (-sp.get_score(plain[p]), plain[p]))
        rank = {p: k for k, p in enumerate(order)}
        self.symbol = dict(plain)
        for p in plain:
            for c in p:
                self.symbol.setdefault(c, len(self.symbol) + n)
        pairs = {}
        self.span = 2 * n + len(self.symbol)
        for p, i in plain.items():
            for k in range(1, len(p)):
                a, b = self.symbol.get(p[:k]), self.symbol.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * self.span + b] = (i, rank[p])
        self.mask = (1 << 20) - 1
        while self.mask < 4 * len(pairs):
            self.mask = self.mask * 2 + 1
        self.key = np.full(self.mask + 1, -1, np.int64)
        self.value = np.zeros((self.mask + 1, 2), np.int32)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        for k, h in zip(keys.tolist(), self._slot(keys).tolist(), strict=True):
            while self.key[h] != -1:
                h = (h + 1) & self.mask
            self.key[h] = k
            self.value[h] = pairs[k]
        known = [c for c in self.symbol if len(c) == 1 and c != MARK]
        self.char = {c: self.symbol[c] for c in known} | {" ": self.symbol.get(MARK, -1)}
        self.char.pop(MARK, None)
        self.code = np.full(max(map(ord, self.char)) + 2, -1, np.int32)  # by code point; the last place stands for all others
        self.code[[ord(c) for c in self.char]] = list(self.char.values())

    def symbols_of(self, text: str) -> np.ndarray:
        """The symbols of a text's characters, -1 for unknown ones."""
        return self.code[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), len(self.code) - 1)]

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * _K1) >> np.uint64(40)).astype(np.int64) & self.mask

    def merge(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged piece and rank of adjacent symbols; rank ``_NONE`` where they do not merge."""
        key = left.astype(np.int64) * self.span + right
        bad = (left < 0) | (right < 0)
        at = self._slot(key)
        seen = self.key[at]
        todo = np.flatnonzero((seen != key) & (seen != -1) & ~bad)
        while len(todo):
            at[todo] = (at[todo] + 1) & self.mask
            seen[todo] = self.key[at[todo]]
            todo = todo[(seen[todo] != key[todo]) & (seen[todo] != -1)]
        got = self.value[at]
        ok = (seen == key) & ~bad
        return np.where(ok, got[:, 0], -1).astype(np.int32), np.where(ok, got[:, 1], _NONE)


@lru_cache(maxsize=2)
def vocabulary(proto: bytes) -> Vocabulary:
    return Vocabulary(proto)


def _skipped(key: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, below: int) -> np.ndarray:
    """The keyed hash of candidates against the dropout rate."""
    return A.mix(key + start.astype(np.uint64) * _K2 + middle.astype(np.uint64) * _K3 + end.astype(np.uint64) * _K4) < np.uint64(below)


def _among(codes: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which codes are in the sorted array ``of``."""
    if not len(of):
        return np.zeros(len(codes), bool)
    return of[np.minimum(np.searchsorted(of, codes), len(of) - 1)] == codes


def _agenda(v: Vocabulary, symbols: list[int], key: int, below: int) -> tuple[list[int], list[int]]:
    """Heap form of the agenda for one chunk: its symbols and their starts."""
    n = len(symbols)
    ids, ends, before, after = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1)), [*range(1, n), -1]
    heap: list[tuple[int, int, int, int, int]] = []

    def push(lefts: list[int]) -> None:
        if lefts:
            a = np.array(lefts)
            b = np.array([after[i] for i in lefts])
            merged, rank = v.merge(np.array([ids[i] for i in lefts], np.int32), np.array([ids[i] for i in b], np.int32))
            end = np.array([ends[i] for i in b])
            ok = rank != _NONE
            if below:
                ok &= ~_skipped(np.uint64(key), a, b, end, below)
            for k in np.flatnonzero(ok):
                heapq.heappush(heap, (int(rank[k]), int(a[k]), int(b[k]), int(end[k]), int(merged[k])))

    push(list(range(n - 1)))
    while heap:
        _, a, b, end, merged = heapq.heappop(heap)
        if ids[a] is None or after[a] != b or ids[b] is None or ends[b] != end:
            continue
        ids[a], ends[a], ids[b], after[a] = merged, end, None, after[b]
        if after[a] >= 0:
            before[after[a]] = a
        push(([before[a]] if before[a] >= 0 else []) + ([a] if after[a] >= 0 else []))
    keep = [i for i in range(n) if ids[i] is not None]
    return [ids[i] for i in keep], keep


def _agenda_rows(v: Vocabulary, ids: np.ndarray, length: np.ndarray, key: np.ndarray, below: int, skips: np.ndarray | None = None, met: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The agenda of many short chunks at once: symbols and starts (rows x columns), and counts.

    Unused columns hold -1. Each turn pops the best candidate of every row. With
    ``skips``, the candidates in it (sorted codes) are skipped instead of drawn ones,
    and ``met`` takes the codes of all candidates.
    """
    rows, width = ids.shape
    if width < 2:
        return ids.copy(), np.zeros((rows, width), np.int32), length.copy()
    column = np.arange(width, dtype=np.int32)
    before = np.tile(column - np.int32(1), rows)
    after = np.tile(column + np.int32(1), rows)  # where the next symbol starts, hence this one's end
    sym, stays = ids.ravel().copy(), (column[None, :] < length[:, None]).ravel()
    table, merged = np.full((rows, width), _NONE, np.int32), np.zeros(rows * width, np.int32)
    rank = table.ravel()  # a view

    def candidates(r: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
        """Notes what the symbols at places i and j of the rows r, neighbours, merge to."""
        new, order = v.merge(sym[i], sym[j])
        some = np.flatnonzero(order != _NONE)
        if len(some) and (skips is not None or below):
            row, base = r[some], r[some] * width
            start, middle, end = i[some] - base, j[some] - base, after[j[some]]
            if skips is not None:
                code = row << 21 | start << 14 | middle << 7 | end
                met.append(code)
                order[some[_among(code, skips)]] = _NONE
            else:
                order[some[_skipped(key[row], start, middle, end, below)]] = _NONE
        merged[i], rank[i] = new, order

    r, k = np.nonzero(column[None, :] < (length - 1)[:, None])
    candidates(r, r * width + k, r * width + k + 1)
    live = np.arange(rows)
    while len(live):
        i = live * width + table[live].argmin(1)
        more = rank[i] != _NONE
        live, i = live[more], i[more]
        if not len(live):
            break
        base = live * width
        j = base + after[i]
        end = after[j]
        sym[i], after[i], rank[i], rank[j], stays[j] = merged[i], end, _NONE, _NONE, False
        right = np.flatnonzero(end < length[live])
        after_i = base[right] + end[right]
        before[after_i] = i[right] - base[right]
        left = np.flatnonzero(before[i] >= 0)
        before_i = base[left] + before[i[left]]
        candidates(np.concatenate([live[left], live[right]]), np.concatenate([before_i, i[right]]), np.concatenate([i[left], after_i]))
    stays = stays.reshape(rows, width)
    count = stays.sum(1)
    packed = column[None, :] < count[:, None]
    out, begin = np.full((rows, width), -1, np.int32), np.zeros((rows, width), np.int32)
    out[packed] = sym.reshape(rows, width)[stays]
    begin[packed] = np.broadcast_to(column, (rows, width))[stays]
    return out, begin, count


class _Numbers(dict):
    """Numbers chunks in the order in which they are first asked for, and lists them."""

    def __init__(self):
        self.order: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self.order.append(chunk)
        number = self[chunk] = len(self)
        return number


class Encoder:
    """Encodes texts in one worker, remembering nodes. ``variants`` has no effect any more."""

    def __init__(self, v: Vocabulary, seed: int, dropout: float, variants: int | None = None):
        self.v, self.seed = v, A.mix(np.array([seed % (1 << 64)], np.uint64))[0]
        self.below = min(int(dropout * 2.0**64), (1 << 64) - 1)
        self.forget()

    def forget(self) -> None:
        """Drops all remembered chunks and nodes; pieces do not depend on them."""
        self.index = _Numbers()
        self.chunks = self.index.order
        none = np.zeros(0, np.int64)
        self.symbols, self.first, self.size = np.zeros(0, np.int32), none, none  # of each chunk
        self.root = none
        self.child: dict[int, int] = {}
        # of each node: chunk, parent, what it skips of the parent's candidates, its candidates and its pieces
        self.chunk, self.parent, self.skip = none, none, none
        self.cand, self.cand_start, self.cand_n = none, none, none
        self.salt = np.zeros(0, np.uint64)
        self.flat, self.start, self.length = np.zeros(0, np.int32), none, none

    def _finish(self, chunk: str, symbols: list[int], starts: list[int]) -> list[int]:
        """Writes symbols outside the vocabulary as byte pieces."""
        out: list[int] = []
        for s, b in zip(symbols, starts, strict=True):
            if 0 <= s < self.v.size:
                out.append(s)
            else:
                out += self.v.byte_id[np.frombuffer(chunk[b].encode(), np.uint8)].tolist()
        return out

    def _solve(self, chunk: np.ndarray, key: np.ndarray | None, parent: np.ndarray | None = None, skip: np.ndarray | None = None) -> tuple:
        """Pieces (flat) and their numbers for chunks: with ``key`` by own draws, else as nodes; then also new candidates (flat) and their numbers."""
        length = self.size[chunk]
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # chunks' places, sizes, pieces
        cands: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for n in np.flatnonzero(length > LONG).tolist():
            c = int(chunk[n])
            symbols = self.symbols[self.first[c] : self.first[c] + self.size[c]].tolist()
            got = self._finish(self.chunks[c], *_agenda(self.v, symbols, int(key[n]) if key is not None else 0, self.below if key is not None else 0))
            done.append((np.array([n]), np.array([len(got)]), np.array(got, np.int32)))
        width = 0
        for top in (4, 6, 8, 10, 12, 16, 24, 40, LONG):
            group = np.flatnonzero((length > width) & (length <= top))
            width = top
            for at in range(0, len(group), 1 << 14):
                part = group[at : at + (1 << 14)]
                size = length[part]
                ids = np.full((len(part), top), -1, np.int32)
                ids[np.arange(top)[None, :] < size[:, None]] = self.symbols[A.ranges(self.first[chunk[part]], size)]
                if key is not None:
                    ids, begin, count = _agenda_rows(self.v, ids, size, key[part], self.below)
                else:
                    drawn, skips = self._chain(parent[part], skip[part])
                    met = [np.zeros(0, np.int64)]
                    ids, begin, count = _agenda_rows(self.v, ids, size, np.zeros(0, np.uint64), 0, skips, met)
                    code = np.unique(np.concatenate(met))
                    code = code[~_among(code, drawn)]
                    cands.append((part, np.bincount(code >> 21, minlength=len(part)), code & ((1 << 21) - 1)))
                valid = np.arange(top)[None, :] < count[:, None]
                odd = np.flatnonzero((((ids < 0) | (ids >= self.v.size)) & valid).any(1))
                if len(odd):
                    plain = np.ones(len(part), bool)
                    plain[odd] = False
                    done.append((part[plain], count[plain], ids[valid & plain[:, None]]))
                    lists = [self._finish(self.chunks[chunk[part[r]]], ids[r, : count[r]].tolist(), begin[r, : count[r]].tolist()) for r in odd.tolist()]
                    done.append((part[odd], np.array([len(x) for x in lists]), np.array([x for y in lists for x in y], np.int32)))
                else:
                    done.append((part, count, ids[valid]))
        return (*_in_order(len(chunk), done, np.int32), *_in_order(len(chunk), cands, np.int64))

    def _chain(self, parent: np.ndarray, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted codes of the candidates that the ancestors of new nodes met, and of the skipped ones."""
        row = np.arange(len(parent))
        drawn, skipped = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while True:
            some = parent >= 0
            row, parent, skip = row[some], parent[some], skip[some]
            if not len(row):
                return np.sort(np.concatenate(drawn)), np.sort(np.concatenate(skipped))
            n = self.cand_n[parent]
            code = np.repeat(row, n) << 21 | self.cand[A.ranges(self.cand_start[parent], n)]
            drawn.append(code)
            skipped.append(code[np.repeat(skip, n) >> A.ranges(np.zeros(len(n), np.int64), n) & 1 == 1])
            parent, skip = self.parent[parent], self.skip[parent]

    def _add(self, chunk: np.ndarray, parent: np.ndarray, skip: np.ndarray) -> np.ndarray:
        """Makes nodes and gives their numbers."""
        flat, size, cand, n = self._solve(chunk, None, parent, skip)
        base = len(self.chunk)
        for name, new in (("chunk", chunk), ("parent", parent), ("skip", skip), ("cand_start", len(self.cand) + np.cumsum(n) - n), ("start", len(self.flat) + np.cumsum(size) - size), ("length", size), ("cand", cand), ("flat", flat)):
            setattr(self, name, np.concatenate([getattr(self, name), new]))
        own = (n > _MASK_BITS) | (self.size[chunk] > LONG)
        self.cand_n = np.concatenate([self.cand_n, np.where(own, -1, n)])
        start, middle, end = (x.astype(np.uint64) for x in (cand >> 14, cand >> 7 & 127, cand & 127))
        self.salt = np.concatenate([self.salt, start * _K2 + middle * _K3 + end * _K4])
        return base + np.arange(len(chunk))

    def _draw(self, node: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Moves each occurrence from its chunk's first node to its last one; gives the occurrences that need an agenda of their own."""
        own, live = [np.flatnonzero(node < 0)], np.flatnonzero(node >= 0)
        while len(live):
            n = self.cand_n[node[live]]
            own.append(live[n < 0])
            live, n = live[n > 0], n[n > 0]
            at = A.ranges(self.cand_start[node[live]], n)
            hit = np.flatnonzero(A.mix(np.repeat(key[live], n) + self.salt[at]) < np.uint64(self.below))
            ends = np.cumsum(n)
            row = np.searchsorted(ends, hit, "right")
            mask = np.zeros(len(live), np.int64)
            np.bitwise_or.at(mask, row, np.int64(1) << (hit - (ends - n)[row]))
            live, mask = live[mask > 0], mask[mask > 0]
            want, back, times = np.unique(node[live].astype(np.uint64) << np.uint64(_MASK_BITS) | mask.astype(np.uint64), return_inverse=True, return_counts=True)
            get = self.child.get
            found = np.array([get(x, _NEW) for x in want.tolist()], np.int64)
            once = (found == _NEW) & (times == 1)
            self.child.update(dict.fromkeys(want[once].tolist(), _ONCE))
            own.append(live[once[back]])
            live, back = live[~once[back]], back[~once[back]]
            new = np.flatnonzero((found < 0) & ~once)
            if len(new):
                parent = (want[new] >> np.uint64(_MASK_BITS)).astype(np.int64)
                found[new] = self._add(self.chunk[parent], parent, (want[new] & np.uint64((1 << _MASK_BITS) - 1)).astype(np.int64))
                self.child.update(zip(want[new].tolist(), found[new].tolist(), strict=True))
            node[live] = found[back]
        return np.sort(np.concatenate(own))

    def encode(self, texts: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts and the texts' bounds; ``keys`` stand for the documents' ids."""
        if max(len(self.index), len(self.child)) > REMEMBERED:
            self.forget()
        index, got, counts, known = self.index, [], [], len(self.chunks)
        for t in texts:
            found = _CHUNK.findall(" " + t) if t else []
            counts.append(len(found))
            got.extend(map(index.__getitem__, found))
        if len(self.chunks) > known:
            fresh = self.chunks[known:]
            size = np.array([len(c) for c in fresh], np.int64)
            self.first = np.concatenate([self.first, len(self.symbols) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.symbols = np.concatenate([self.symbols, self.v.symbols_of("".join(fresh))])
            self.root = np.concatenate([self.root, np.full(len(fresh), _NEW)])
        counts_ = np.array(counts, np.int64)
        ordinal = A.ranges(np.zeros(len(texts), np.int64), counts_)
        key = A.mix(np.repeat(keys, counts_) + ordinal.astype(np.uint64) * _K2)
        key = A.mix(key ^ self.seed)
        chunk = np.array(got, np.int64)
        times = np.bincount(chunk, minlength=len(self.chunks))
        new = np.flatnonzero((times > 0) & (self.root < 0) & ((times > 1) | (self.root == _ONCE) | (self.below == 0)))
        self.root[(times > 0) & (self.root < 0)] = _ONCE
        none = np.full(len(new), -1)
        self.root[new] = self._add(new, none, none)
        node = self.root[chunk]
        own = self._draw(node, key) if self.below else np.zeros(0, np.int64)
        size = np.zeros(len(node), np.int64)
        size[node >= 0] = self.length[node[node >= 0]]
        flat, size[own], *_ = self._solve(chunk[own], key[own]) if len(own) else (self.flat[:0], size[own])
        bound = np.concatenate([[0], np.cumsum(size)])
        if len(own):
            ids = np.empty(bound[-1], np.int32)
            ids[A.ranges(bound[own], size[own])] = flat
            shared = np.ones(len(node), bool)
            shared[own] = False
            ids[A.ranges(bound[:-1][shared], size[shared])] = self.flat[A.ranges(self.start[node[shared]], size[shared])]
        else:
            ids = self.flat[A.ranges(self.start[node], size)]
        return ids, bound[np.concatenate([[0], np.cumsum(counts_)])]


def _in_order(n: int, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Lists of n places, given in parts of (places, sizes, flat values), as one flat array and the sizes."""
    size = np.zeros(n, np.int64)
    for place, sizes, _ in parts:
        size[place] = sizes
    out, start = np.empty(int(size.sum()), kind), np.cumsum(size) - size
    for place, sizes, values in parts:
        out[A.ranges(start[place], np.asarray(sizes))] = values
    return out, size


def decode_ids(v: Vocabulary, ids: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the rows' pieces, without each row's first space, and their bounds."""
    size = v.raw_length[ids]
    start = v.raw_start[ids].copy()
    first = bound[:-1][np.diff(bound) > 0]
    lead = first[(size[first] > 0) & (v.raw[np.minimum(start[first], len(v.raw) - 1)] == 32)]
    start[lead] += 1
    size = size.copy()
    size[lead] -= 1
    total = np.concatenate([[0], np.cumsum(size)])
    return v.raw[A.ranges(start, size)], total[bound]


@lru_cache(maxsize=2)
def _encoder(proto: bytes, seed: int, dropout: float) -> Encoder:
    return Encoder(vocabulary(proto), seed, dropout)


def encode(docs: DataFrame, *, model_path: str = MODEL_PATH, seed: int = 13, dropout: float = DROPOUT) -> DataFrame:
    """doc_id, ids (array of piece ids), n_pieces and lossless (whether they decode to the text) of every row."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())
    source = docs.select("doc_id", "text")

    def rows(batch: pa.RecordBatch) -> dict:
        encoder = _encoder(shared.value, seed, dropout)
        texts = [t or "" for t in batch.column("text").to_pylist()]
        keys = np.array([xxhash.xxh64_intdigest(str(k), seed) for k in batch.column("doc_id").to_pylist()], np.uint64)
        ids, bound = encoder.encode(texts, keys)
        raw, at = decode_ids(encoder.v, ids, bound)
        data, off = A.column_bytes(batch.column("text"))
        differs = np.diff(at) != np.diff(off)
        if not differs.any():
            differs = A.per_row((raw != data).astype(np.int64), off) > 0
        else:
            differs = np.array([bytes(raw[at[k] : at[k + 1]]) != bytes(data[off[k] : off[k + 1]]) for k in range(len(texts))])
        lists = pa.ListArray.from_arrays(pa.array(bound.astype(np.int32)), pa.array(ids))
        return {"doc_id": batch.column("doc_id"), "ids": lists, "n_pieces": np.diff(bound), "lossless": ~differs}

    def forget() -> None:
        _encoder(shared.value, seed, dropout).forget()  # workers serve later stages too
        give_back()

    return arrow_map(source, rows, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids array<int>, n_pieces long, lossless boolean", forget)


def decode(encoded: DataFrame, *, model_path: str = MODEL_PATH) -> DataFrame:
    """doc_id and text of rows of doc_id and ids."""
    prepare(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())
    source = encoded.select("doc_id", "ids")

    def rows(batch: pa.RecordBatch) -> dict:
        column = batch.column("ids")
        sizes = np.array([len(x) if x is not None else 0 for x in column.to_pylist()], np.int64)
        raw, at = decode_ids(vocabulary(shared.value), column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)]))
        return {"doc_id": batch.column("doc_id"), "text": pa.array([bytes(raw[at[k] : at[k + 1]]).decode() for k in range(len(sizes))], pa.string())}

    return arrow_map(source, rows, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, text string")
