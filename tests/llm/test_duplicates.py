"""SimHash, line dedup, decontamination, suffix arrays, union-find: each against brute force."""

import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

import corpus_pipeline
from millrace.llm import decontam, graph, line_dedup, runtime, simhash, suffixdup, worddup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def prose(rng, n, words=None):
    words = words or ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.mark.parametrize("seed", [1, 2])
def test_union_find(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(55)] + [(k, k + 1) for k in range(200, 260)] + [(300, k) for k in range(301, 360)]
    edges = spark.createDataFrame(links, "a long, b long")
    nodes = {x for a, b in links if a != b for x in (a, b)}
    want = {n: r for n, r in roots({x for p in links for x in p}, links).items() if n in nodes}
    assert {r.node: r.root for r in graph.connected(edges).collect()} == want
    assert graph.connected(edges.where("false")).isEmpty()
    node, root = graph.local_roots(*np.array(links).T)
    assert dict(zip(node.tolist(), root.tolist())) == {n: r for n, r in want.items() if n != r}


def brute_fingerprint(text):
    w = WORD.findall(lower(text or ""))
    shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near_rows(seed=5):
    rng = random.Random(seed)
    rows = []
    for k in range(60):
        t = prose(rng, rng.randint(60, 200))
        rows.append(t)
        for _ in range(k % 4):
            w = t.split(" ")
            w[rng.randrange(len(w))] = "new"
            rows.append(" ".join(w))
    rows += [None, "", "  \n", "A b", "a B", "one", rows[0], "x " * 5000]
    return list(enumerate(rows))


def test_masks_cover_every_difference():
    masks = simhash.covering_masks()
    rng = random.Random(0)
    for _ in range(3000):
        differ = sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
        assert any(not m & differ for m in masks)
    for outer in masks[:3]:
        inner = simhash.covering_masks(outer)
        free = [b for b in range(64) if not outer >> b & 1]
        for _ in range(300):
            differ = sum(1 << b for b in rng.sample(free, 3))
            assert any(not m & differ for m in inner)


@pytest.mark.parametrize("bucket", [512, 2])
def test_simhash(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "MAX_BUCKET", bucket)
    rows = near_rows()
    prints = {k: brute_fingerprint(t) for k, t in rows}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    want = roots(prints, links)
    docs = spark.createDataFrame([(*r, "e") for r in rows], DOCS + ", simhash string")
    got = {r.doc_id: (r.simhash % 2**64, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {k: (prints[k], want[k]) for k in prints}
    if bucket == 512:
        kept = simhash.keep_one(docs)
        assert kept.schema == docs.schema
        assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_simhash_links_hold_when_a_join_turns_into_a_broadcast(spark):
    """Buckets stay together and in order though the join of their sizes is small enough to be broadcast at run time."""
    rng = np.random.default_rng(6)
    centre = rng.integers(0, 2**64, 3000, np.uint64)
    near = [centre ^ sum(np.uint64(1) << b for b in rng.permuted(np.tile(np.arange(64, dtype=np.uint64), (3000, 1)), axis=1)[:, :3].T) for _ in range(2)]
    fps = np.sort(np.concatenate([centre, *near]))
    simhash.prepare(spark)
    nodes = spark.createDataFrame([(x,) for x in fps.view(np.int64).tolist()], "fp long").repartition(5)
    plan = simhash._stars(simhash._keyed(nodes.selectExpr("0L AS mask", "fp")).join(spark.createDataFrame([], "mask long, key long"), ["mask", "key"]))
    assert "REPARTITION_BY_COL" in plan._jdf.queryExecution().executedPlan().toString()
    root = {r.node: r.root for r in graph.connected(simhash.link_edges(nodes)).collect()}
    assert all(root.get(a) is not None and root[a] == root.get(b) for x in near for a, b in zip(centre.view(np.int64).tolist(), x.view(np.int64).tolist(), strict=True))


def test_simhash_on_nulls_repeats_and_nothing(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (1, "other words here now"), (None, "a b c d"), (None, "lonely text by itself"), (7, None)]
    docs = spark.createDataFrame(rows, DOCS)
    out = [(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(out, key=str) == sorted([(1, 1), (1, 1), (1, 1), (None, 1), (None, None), (7, 7)], key=str)
    kept = sorted(((r.doc_id, r.text) for r in simhash.keep_one(docs).collect()), key=str)
    assert kept == sorted([(1, "a b c d"), (1, "other words here now"), (None, "lonely text by itself"), (7, None)], key=str)
    assert simhash.near_duplicates(docs.where("false")).isEmpty()
    assert simhash.keep_one(docs.where("false")).isEmpty()


def word_sets(rows, width=5):
    out = {}
    for k, t in rows:
        w = WORD.findall(lower(t or ""))
        out[k] = {" ".join(w[i : i + width]) for i in range(len(w) - width + 1)} or ({" ".join(w)} if w else set())
    return out


def test_near_dedup_stage_links_by_jaccard(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(60):
        t = prose(rng, rng.choice([3, 6, 14, 40, 90, 150]))
        rows.append(t)
        for _ in range(rng.randint(0, 3)):
            w = t.split(" ")
            if rng.random() < 0.7:
                w = w + ["end", "mark", "x"][: rng.randint(1, 3)]
            else:
                w[rng.randrange(len(w))] = "New"
            rows.append(" ".join(w))
            if rng.random() < 0.4:
                t = rows[-1]  # chains
    rows = list(enumerate([*rows, None, "", " \n", "A  b", "a B", "y " * 3000]))
    sets = word_sets(rows)
    links = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    prints = {k: brute_fingerprint(t) for k, t in rows}
    assert sum((prints[a] ^ prints[b]).bit_count() > 3 for a, b in links) > 20  # beyond op1's radius
    docs = spark.createDataFrame([(*r, "e") for r in rows], DOCS + ", root string")
    kept = corpus_pipeline.apply_near_dedup(spark, docs, "")
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(roots(sets, links).values()))


def test_near_dedup_stage_searches_by_simhash_and_checks_exactly(spark, monkeypatch):
    """With MinHash shut off, what SimHash links is still found; equal fingerprints of unlike shingle sets remove nothing."""
    monkeypatch.setattr(worddup, "candidates", lambda *_: spark.createDataFrame([], "a long, b long, key long"))
    rng = random.Random(12)
    rows = []
    for _ in range(12):
        t = prose(rng, 400)
        rows += [t, t + " end", t.replace(" ", "  ").upper() + " End mark"]
    refrain = "this refrain comes back again " * 60  # five shingles: no bit is near a tie
    unlike = [refrain + prose(rng, 12), refrain + prose(rng, 12)]
    rows = list(enumerate([*rows, *unlike, "", None]))
    docs = spark.createDataFrame(rows, DOCS)
    every = worddup.prints(worddup.keyed_rows(docs)).collect()
    fps = {r.doc_id: r.fp % 2**64 for r in every}
    assert (fps[36] ^ fps[37]).bit_count() <= 3
    sets = word_sets(rows)
    near = [(a, b) for a in sets for b in sets if a < b and (fps[a] ^ fps[b]).bit_count() <= 3]
    links = [(a, b) for a, b in near if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert len(links) >= 12 and (36, 37) in near and (36, 37) not in links
    kept = sorted(r.doc_id for r in corpus_pipeline.apply_near_dedup(spark, docs, "").collect())
    assert kept == sorted(set(roots(sets, links).values()))


def test_workers_give_memory_back_at_the_end_of_a_task():
    class Frame:
        def mapInArrow(self, function, schema):
            return list(function(iter([pa.RecordBatch.from_arrays([pa.array([1, 2])], ["x"])])))

    ended = []
    out = runtime.arrow_map(Frame(), lambda batch: {"x": batch.column(0)}, "x long", lambda: ended.append(True))
    assert out[0].column(0).to_pylist() == [1, 2] and ended == [True]
    runtime.give_back()


def test_near_dedup_stage_on_nulls_repeats_and_nothing(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (1, "other words here now"), (None, "a b c d"), (None, "lonely text"), (None, "lonely text"), (7, None)], DOCS)
    kept = sorted(((r.doc_id, r.text) for r in worddup.keep_one(docs).collect()), key=str)
    assert kept == sorted([(1, "a b c d"), (1, "other words here now"), (None, "lonely text"), (7, None)], key=str)
    assert worddup.keep_one(docs.where("false")).isEmpty()


def test_near_dedup_stage_verifies_hot_buckets(spark, monkeypatch):
    monkeypatch.setattr(worddup, "BLOCK", 8)
    rng = random.Random(4)
    base = prose(rng, 60).split(" ")
    rows = []
    for k in range(70):
        w = list(base)
        for _ in range(rng.randint(1, 2)):
            w[rng.randrange(60)] = f"new{k}"
        rows.append((k, " ".join(w)))
    sets = word_sets(rows)
    links = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    got = sorted(r.doc_id for r in worddup.keep_one(spark.createDataFrame(rows, DOCS)).collect())
    assert got == sorted(set(roots(sets, links).values()))


def brute_lines(rows):
    occurrences = [(lower(x), k, n) for k, t in rows for n, x in enumerate((t or "").split("\n")) if x.strip(" \t\n\v\f\r")]
    keys = sorted({o[0] for o in occurrences})
    sets = {x: {x[i : i + 7] for i in range(max(len(x) - 6, 1))} for x in keys}
    links = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root = roots(keys, links)
    first, gone = {}, defaultdict(set)
    for key, k, n in sorted(occurrences, key=lambda o: (o[1], o[2])):
        if first.setdefault(root[key], (k, n)) != (k, n):
            gone[k].add(n)
    return {k: (t if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[k])) for k, t in rows}


@pytest.mark.parametrize("common, more", [(4, 1), (8, 2), (40, 10)])
def test_line_signatures_find_short_pairs(common, more):
    rng = np.random.default_rng(5)
    body = rng.integers(97, 123, (5000, common + 6 + more)).astype(np.uint8)
    texts = [x for r in body for x in (r[: common + 6].tobytes().decode(), r.tobytes().decode())]
    keys = line_dedup.signatures(*line_dedup.lines_of(["\n".join(texts)])[:3])
    assert (~(keys[::2] == keys[1::2]).any(1)).sum() <= 5  # 2e-4 of 5000 is 1


def test_line_dedup(spark):
    rng = random.Random(6)
    shared = [prose(rng, 25) for _ in range(8)]
    rows = []
    for k in range(60):
        lines = [prose(rng, rng.randint(1, 30)) for _ in range(rng.randint(0, 4))]
        for _ in range(rng.randint(0, 3)):
            w = rng.choice(shared).split(" ")
            if rng.random() < 0.6:
                w[rng.randrange(len(w))] = rng.choice(["zz", "Q", "w"])
            lines.insert(rng.randint(0, len(lines)), " ".join(w))
        rows.append((k, "\n".join(lines)))
    rows += [(60, None), (61, ""), (62, "\n \n"), (63, "Tie\ntie\nTIE"), (64, "ab"), (65, "AB"), (66, "y" * 30000)]
    docs = spark.createDataFrame([(k, t, 5, "n") for k, t in rows], DOCS + ", n_chars int, node string")
    out = line_dedup.dedup(docs, None)
    assert out.schema == docs.schema
    got = {r.doc_id: r for r in out.collect()}
    want = brute_lines(rows)
    assert {k: r.text for k, r in got.items()} == want
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.values())
    assert line_dedup.dedup(docs.where("false")).isEmpty()
    counted = line_dedup.dedup(docs, "node")  # a column of that name is replaced
    assert counted.columns == ["doc_id", "text", "n_chars", "node"]
    assert {r.doc_id: r.node for r in counted.collect()} == {k: (t or "").count("\n") - (want[k] or "").count("\n") + ((t or "") != "" and want[k] == "") for k, t in rows if k != 62} | {62: 0}


def test_line_dedup_of_repeated_rows_and_null_ids(spark):
    rows = [(1, "same line here"), (1, "same line here"), (None, "same line here"), (0, "other\nsame line here")]
    got = sorted(((r.doc_id, r.text, r.n_removed_lines) for r in line_dedup.dedup(spark.createDataFrame(rows, DOCS)).collect()), key=str)
    assert got == sorted([(1, "", 1), (1, "", 1), (None, "", 1), (0, "other\nsame line here", 0)], key=str)


def test_similar_pairs_by_sorted_hashes_equal_sets():
    rng = np.random.default_rng(8)
    right = [rng.integers(0, 2**64, n, np.uint64) for n in (1, 4, 10, 40, 0, 300)]
    of, left = rng.integers(0, len(right), 128), []
    for k in of.tolist():
        mine = rng.permutation(right[k])[: max(0, len(right[k]) - int(rng.integers(0, 4)))]
        left.append(np.concatenate([mine, mine[:2], rng.integers(0, 2**64, int(rng.integers(0, 3)), np.uint64)]))
    sets = [(set(x.tolist()), set(right[k].tolist())) for x, k in zip(left, of.tolist(), strict=True)]
    want = [len(a & b) >= 0.8 * len(a | b) for a, b in sets]
    assert line_dedup.similar(left, right, of).tolist() == want
    assert 10 < sum(want) < 118


def test_bodies_are_dealt_out_only_where_nodes_repeat(spark):
    plain = spark.createDataFrame([(k, f"line {k}") for k in range(20)], "node long, body string")
    line_dedup.prepare(spark)
    assert "Exchange" not in line_dedup.once(plain, plain.select("node"))._jdf.queryExecution().toString()
    assert sorted(tuple(r) for r in line_dedup.once(plain.union(plain), plain.select("node")).collect()) == sorted(tuple(r) for r in plain.collect())


def thue_morse(n=1024):
    """A word and its complement, equal under any polynomial hash modulo 2**64 with an odd base."""
    a = "".join("ab"[bin(k).count("1") & 1] for k in range(n))
    return a, a.translate(str.maketrans("ab", "ba"))


def test_line_dedup_of_clashing_columns_null_keys_and_lines_that_weak_hashes_confuse(spark):
    a, b = thue_morse()
    rows = [(None, "same"), ("same", None), ("x", f"{a} 0123456789"), ("y", f"{b} abcdefghij"), ("z", f"{a} 0123456789")]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id string, text string, __loc int, k1 int, gone int")
    got = sorted((tuple(r) for r in line_dedup.dedup(docs, None).collect()), key=str)
    assert got == sorted([(k, "" if k == "z" else t, 1, 2, 3) for k, t in rows], key=str)
    assert (line_dedup.identities([a.encode()]) != line_dedup.identities([b.encode()])).all()


def test_near_dedup_stage_on_clashing_columns_and_null_keys(spark):
    a, b = thue_morse()
    docs = spark.createDataFrame([(*r, 1, 2) for r in [(None, "t"), ("t", None), ("u", a), ("v", b), ("w", a), ("w", a)]], "doc_id string, text string, k1 int, node int")
    kept = worddup.keep_one(docs)
    assert kept.schema == docs.schema
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id) == [("t", None), ("u", a), ("v", b)]


def test_suffix_dedup_of_null_keys_and_segments_that_weak_hashes_confuse(spark):
    a, b = thue_morse()
    rows = [(None, a), (a, None), ("b", b), ("c", b[:700] + "zz"), ("c", b[:700] + "zz")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id string, text string, k1 int")
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in suffixdup.dedup(docs).collect()), key=str)
    assert got == brute_suffix(rows)


def test_simhash_keeps_one_of_repeats_beside_clashing_columns(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (1, "other words here now"), (None, "a b c d"), (None, "lonely text by itself")]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], DOCS + ", simhash int, __id int, rows int")
    kept = simhash.keep_one(docs)
    assert kept.schema == docs.schema
    assert sorted((r.text for r in kept.collect())) == ["a b c d", "lonely text by itself", "other words here now"]


def brute_contaminated(rows, items):
    token = re.compile(r"[A-Za-z0-9\u0080-\U0010ffff]+")
    out = set()
    for k, t in rows:
        d = token.findall((t or "").lower())
        for i, u in items:
            q = token.findall((u or "").lower())
            w = min(13, len(q))
            if len(q) < 5:
                continue
            if any(sum(a == b for a, b in zip(d[x : x + w], q[y : y + w])) >= w - w // 5 for x in range(len(d) - w + 1) for y in range(len(q) - w + 1)):
                out.add((k, i))
    return out


def test_decontamination(spark):
    rng = random.Random(7)
    words = [f"w{k}" for k in range(60)]
    items = [(k, prose(rng, n, words)) for k, n in enumerate([5, 7, 9, 11, 12, 13, 20, 40, 40, 3])] + [(90, None), (91, ""), (None, prose(rng, 15, words))]
    rows = []
    for k in range(150):
        d = prose(rng, rng.randint(0, 60), words).split(" ")
        q = rng.choice(items)[1]
        if q and rng.random() < 0.7:
            q = q.split(" ")
            a = rng.randint(0, max(0, len(q) - 13))
            q = q[a : a + rng.randint(11, 25)]
            for _ in range(rng.randint(0, 4)):
                q[rng.randrange(len(q))] = "sub"
            d[3:3] = q
        rows.append((k, " ".join(d).upper() if k % 9 == 0 else " , ".join(d)))
    rows += [(200, None), (201, ""), (None, items[7][1])]
    docs = spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_contaminated(rows, items)
    assert len(want) > 40
    assert {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect()} == want
    kept = decontam.keep_rows(docs, bench)
    assert kept.schema == docs.schema
    bad = {k for k, _ in want}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((k for k, _ in rows if k not in bad), key=str)
    assert decontam.contaminated(docs, bench.where("false")).isEmpty()
    assert decontam.contaminated(docs.where("false"), bench).isEmpty()


def test_frequent_tokens_on_both_sides():
    def found(doc, item):
        index = decontam.SeedIndex.of(pa.table({"item_id": [1], "text": [item]}))
        return [x for _, _, token, bound in decontam.tokens(pa.array([doc])) for x in index.hits(token, bound)]

    began = time.perf_counter()
    assert found("x " * 20_000, "x " * 20_000) == [(0, 0, 0, 13)]
    assert found("x y " * 5_000, "x z " * 5_000) == []
    assert time.perf_counter() - began < 10
    rng = random.Random(3)
    for _ in range(30):  # few words: seeds are frequent; the convolution and the list of pairs must agree
        a, b = (" ".join(rng.choice("xy") * rng.randint(1, 2) for _ in range(rng.randint(5, 60))) for _ in "ab")
        plain = found(a, b)
        most, decontam.HOT_PAIRS = decontam.HOT_PAIRS, 1
        try:
            assert found(a, b) == plain
        finally:
            decontam.HOT_PAIRS = most
        assert bool(plain) == bool(brute_contaminated([(0, a)], [(0, b)]))


def test_decontamination_of_repeated_and_long_rows(spark):
    item = " ".join(f"w{k}" for k in range(30))
    long = " ".join(f"v{k % 977}" for k in range(60_000))
    docs = spark.createDataFrame([(1, item), (1, item), (2, long), (3, long + " " + item)], DOCS)
    bench = spark.createDataFrame([(7, item), (7, item)], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.token_offset, r.matched_tokens) for r in decontam.contaminated(docs, bench).collect())
    assert got == sorted([(1, 7, 0, 13)] * 4 + [(3, 7, 60_000, 13)] * 2)
    assert [r.doc_id for r in decontam.keep_rows(docs, bench).collect()] == [2]


def test_item_blocks_change_nothing(spark, monkeypatch):
    rng = random.Random(8)
    items = [(k, prose(rng, 20)) for k in range(12)]
    docs = spark.createDataFrame([(k, items[k % 12][1] + " tail") for k in range(30)], DOCS)
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = {tuple(r) for r in decontam.contaminated(docs, bench).collect()}
    monkeypatch.setattr(decontam, "ITEMS_PER_BLOCK", 5)
    assert {tuple(r) for r in decontam.contaminated(docs, bench).collect()} == whole
    assert decontam.keep_rows(docs, bench).isEmpty()


@pytest.mark.parametrize("window", range(5, 14))
def test_every_substitution_is_hit(window):
    from itertools import combinations

    errors, masks = decontam.masks(window)
    for gone in combinations(range(window), errors):
        assert any(all(i + o not in gone for o in m) for m in masks for i in range(window - m[-1]))


def brute_suffix(rows, length=200):
    body = [(t or "").encode() for _, t in rows]
    count = Counter(b[i : i + length] for b in body for i in range(len(b) - length + 1))
    out = []
    for (k, _), b in zip(rows, body):
        gone, end = bytearray(len(b)), 0
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                for j in range(max(i, end), i + length):
                    gone[j] = 1
                end = i + length
        spans = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((k, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def suffix_rows():
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randint(2, 6))) for _ in range(60)]
    passages = [prose(rng, 60, words) for _ in range(4)]
    rows = []
    for k in range(60):
        t = prose(rng, rng.randint(0, 120), words)
        for _ in range(rng.randint(0, 2)):
            p, i = rng.choice(passages), rng.randint(0, 80)
            t += p[i : i + rng.randint(100, 330)] + rng.choice(words)
        rows.append((k, t))
    return [*rows, (60, None), (61, ""), (62, "a" * 450), (63, "b" * 215), (64, "ab" * 150), (65, rows[3][1]), (3, rows[3][1]), (None, rows[5][1]), (70, "x" * 199), (71, "c" * 200), (72, ("foo bar " * 5 + "baz") * 40), (3, rows[3][1])]


@pytest.mark.parametrize("most", [8192, 2])
def test_suffix_dedup(spark, most):
    rows = suffix_rows()
    docs = spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", loc int")
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in suffixdup.dedup(docs, max_group=most).collect()), key=str)
    assert got == brute_suffix(rows)


def test_suffix_dedup_of_pieces_and_nothing(spark, monkeypatch):
    docs = spark.createDataFrame([], DOCS)
    assert suffixdup.dedup(docs).isEmpty()
    rng = np.random.default_rng(1)
    body = rng.integers(97, 123, 3000).astype(np.uint8)
    body[2000:2400] = body[500:900]
    monkeypatch.setattr(suffixdup, "PIECE", 700)
    starts = []
    for _, base, d, o in suffixdup._pieces(body, np.array([0, len(body)]), 200):
        *_, start, n, _ = suffixdup.segments(d, o)
        starts += [base + s + k for s, m in zip(start, n) for k in range(m)]
    assert sorted(starts) == list(range(len(body) - 199))


def test_suffix_order():
    rng = random.Random(3)
    for _ in range(60):
        length = rng.choice([40, 64])
        alphabet = rng.choice([b"ab", b"abcdefgh", b"\x00\xff a", b"a"])
        base = bytes(rng.choice(alphabet) for _ in range(rng.randint(50, 300)))
        text = b"".join(base[(i := rng.randrange(len(base))) : i + rng.randint(1, 150)] + bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(4))
        if len(text) < length:
            continue
        a = np.frombuffer(text, np.uint8)
        starts = np.zeros(len(a), bool)
        starts[: len(a) - length + 1] = [rng.random() < 0.6 for _ in range(len(a) - length + 1)]
        keys = [text[i : i + length] for i in suffixdup.suffix_order(a, starts, length)]
        assert keys == sorted(keys)
        count = Counter(text[i : i + length] for i in np.flatnonzero(starts))
        assert suffixdup.repeated_starts(a, starts, length).tolist() == [bool(starts[i]) and count[text[i : i + length]] > 1 for i in range(len(a))]
