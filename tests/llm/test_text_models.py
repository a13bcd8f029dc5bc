"""Classifiers, language identification, quality rules, toxicity: base figures by brute force, models by held-out accuracy."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import arrays as A
from millrace.llm import langid, linear, quality_lr, quality_rules, queries, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string"
AWKWARD = [None, "", "   \n\t", "a", "é" * 3, "x\x85y z", "a\n\na\n \n", "w " * 3000, "tie\ntie", "dup", "dup"]


def corpus(seed=1, n=240):
    rng = random.Random(seed)
    good = ["the", "house", "river", "walks", "slowly", "under", "green", "tree", "and", "sings"]
    rows = []
    for k in range(n):
        words = [rng.choice(good) for _ in range(rng.randint(20, 60))]
        junk = k % 4 == 0
        toxic = k % 5 == 0
        if junk:
            words = [w.upper() + "!!" for w in words]
        if toxic:
            words[3] = rng.choice(["idiot", "moronly", "moronic"])
        rows.append((k, " ".join(words), int(not junk), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = corpus()
    docs = spark.createDataFrame([(k, t, "score", 1) for k, t, *_ in rows], DOCS + ", score string, extra int")
    labels = spark.createDataFrame([(k, q, x) for k, _, q, x in rows], "doc_id long, quality int, toxic int")
    return docs, labels, rows


def awkward(spark):
    return spark.createDataFrame([(k if k else None, t) for k, t in enumerate(AWKWARD)], DOCS)


def test_word_and_line_kernels():
    texts = [t or "" for t in AWKWARD]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    start, end = A.words(data, off)
    assert [bytes(data[s:e]).decode() for s, e in zip(start, end)] == [w for t in texts for w in WORD.findall(t)]
    s, e, row = A.lines(data, off)
    assert [(r, bytes(data[a:b]).decode()) for a, b, r in zip(s, e, row)] == [(k, x) for k, t in enumerate(texts) for x in t.split("\n")]
    blocks = list(A.blocks(data, off, 5))
    assert [b[0] for b in blocks][0] == 0 and blocks[-1][1] == len(texts)
    assert sum(len(b[2]) for b in blocks) == len(data)


def brute_base(text):
    text = text or ""
    words, lines = WORD.findall(text), text.split("\n")
    seen, dup = set(), 0
    for x in lines:
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    count = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {k + j for k in range(len(words) - 4) if count[tuple(words[k : k + 5])] > 1 for j in range(5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed)


def test_base_figures_match_brute_force(spark):
    rng = random.Random(2)
    texts = AWKWARD + [rng.choice([" ", "\n", "  "]).join(rng.choice(["a", "b", "ç#", "d|", "\x85"]) for _ in range(rng.randint(0, 80))) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    model = quality_rules.RuleModel(linear.Linear(np.zeros(1 << 8, np.float32)), 1.0, 0.0)
    got = {r.doc_id: tuple(r)[1:7] for r in quality_rules.judge(docs, model).collect()}
    assert got == {k: brute_base(t) for k, t in enumerate(texts)}


def test_quality_rules_keep_good_rows_and_all_columns(spark, tables):
    docs, labels, rows = tables
    model = quality_rules.train(docs, labels)
    out = {r.doc_id: r.kept for r in quality_rules.judge(docs, model).collect()}
    want = {k: bool(q) and not brute_base(t)[5] for k, t, q, _ in rows}
    assert sum(out[k] == want[k] for k in out) >= 0.97 * len(out)
    kept = quality_rules.keep_rows(docs, model)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {k for k, x in out.items() if x}


def test_quality_classifier_on_held_out_rows(spark, tables):
    docs, labels, rows = tables
    remainder = F.crc32(F.col("doc_id").cast("string")) % 5
    model = quality_lr.train(docs, labels, remainder != 0)
    got = {r.doc_id: r.quality_score for r in quality_lr.score(docs, model).collect()}
    held = [(k, q) for k, _, q, _ in rows if zlib.crc32(str(k).encode()) % 5 == 0]
    assert len(held) > 20
    assert sum((got[k] >= quality_lr.THRESHOLD) == bool(q) for k, q in held) >= 0.95 * len(held)
    assert all(0 <= s <= 1 for s in got.values())


def test_models_without_labels_and_awkward_rows(spark, tables):
    docs = awkward(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scored = quality_lr.score(docs, quality_lr.train(docs, none)).collect()
    assert len(scored) == len(AWKWARD) and {r.quality_score for r in scored} == {0.5}
    judged = quality_rules.judge(docs, quality_rules.train(docs, none))
    assert judged.count() == len(AWKWARD)
    tox = toxicity.score(docs, toxicity.train(docs, none)).collect()
    assert len(tox) == len(AWKWARD) and all(r.toxic_score < 0.01 and r.toxic == 0 for r in tox)
    empty = docs.where("false")
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    assert quality_lr.score(empty, quality_lr.train(empty, labels)).isEmpty()
    assert quality_rules.keep_rows(empty, quality_rules.train(empty, labels)).isEmpty()
    assert toxicity.score(docs, toxicity.train(docs, labels)).count() == len(AWKWARD)


def test_ftrl_separates():
    rng = np.random.default_rng(3)
    rows = []
    for k in range(300):
        y = k % 2
        index = np.unique(np.append(rng.integers(10, 60, 6), y))
        rows.append((index, np.ones(len(index)), y))
    model = linear.fit_ftrl(rows, 64)
    assert all((model.bias + model.weights[i] @ v > 0) == bool(y) for i, v, y in rows)
    slope, offset = linear.platt(np.array([-2.0, -1.5] * 20 + [1.0, 2.0] * 20), np.array([0.0] * 40 + [1.0] * 40))
    assert slope > 0 and abs(offset) < 5


def test_toxicity_chain(spark, tables):
    docs, labels, rows = tables
    chain = toxicity.train(docs, labels)
    assert len(chain.models) >= 2
    base = 1 << chain.bits
    assert any(m.weights[base : base + k].any() for k, m in enumerate(chain.models) if k)  # later models use earlier probabilities
    got = {r.doc_id: r for r in toxicity.score(docs, chain).collect()}
    assert all(len(r.category_scores) == len(chain.models) - 1 for r in got.values())
    assert sum(got[k].toxic == x for k, _, _, x in rows) >= 0.97 * len(rows)


def test_language_identification(spark):
    rng = random.Random(4)
    voices = {"en": "the and of to in is that it was for".split(), "de": "der die und in den von zu das mit sich".split(), "fr": "le la et les des en un du une que".split()}
    rows = [(k, " ".join(rng.choice(voices[x]) for _ in range(12)), x) for k, x in enumerate(rng.choice(list(voices)) for _ in range(300))]
    docs = spark.createDataFrame([*rows, (900, None, "en"), (901, "123 !!", "en"), (902, "", None), (903, "Ω", None), (904, rows[0][1], None)], DOCS + ", lang string")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 4
    model = langid.train(docs, remainder != 2, limit=60)
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert [got[k].lang_pred for k in (900, 901, 902)] == ["und"] * 3
    assert got[903].lang_pred in model.languages
    assert got[904].lang_pred == got[0].lang_pred
    held = [(k, x) for k, _, x in rows if zlib.crc32(str(k).encode()) % 4 == 2]
    assert sum(got[k].lang_pred == x for k, x in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())
    nothing = langid.train(docs.where("false"))
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}


def test_language_scores_match_brute_force(spark):
    docs = spark.createDataFrame([(1, "ab ab", "x"), (2, "ba", "y"), (3, "aé", "y")], DOCS + ", lang string")
    model = langid.train(docs, bits=10)
    counts = {x: Counter() for x in "xy"}
    for t, x in (("ab ab", "x"), ("ba", "y"), ("aé", "y")):
        for part in langid.grams([t], 10)[0]:
            counts[x].update(part.tolist())
    text = "abé"
    found = [b for part in langid.grams([text], 10)[0] for b in part.tolist()]
    prior = {"x": 1 / 3, "y": 2 / 3}  # shares of the training rows
    score = {x: np.log(prior[x]) + sum(np.log((counts[x][b] + 0.5) / (sum(counts[x].values()) + 0.5 * 1024)) for b in found) for x in "xy"}
    said, share = model.predict([text])
    assert said[0] == max(score, key=score.get)
    assert abs(share[0] - 1 / (1 + np.exp(-abs(score["x"] - score["y"])))) < 1e-4


def test_queries_follow_their_contracts(spark):
    d = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{d}/documents.parquet").count()
    for name, columns in (("op5_quality_classifier", {"doc_id", "held_out", "score", "predicted"}), ("op6_language_id", {"doc_id", "held_out", "lang_pred", "score"}), ("op9_toxicity", {"doc_id", "toxic"}), ("op10_quality_rules", {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"})):
        df = queries.QUERIES[name](spark, d)
        assert columns <= set(df.columns)
        assert df.count() == n


def thue_morse(n=1024):
    """A word and its complement, equal under any polynomial hash modulo 2**64 with an odd base."""
    a = "".join("ab"[bin(k).count("1") & 1] for k in range(n))
    return a, a.translate(str.maketrans("ab", "ba"))


def test_figures_of_words_and_lines_that_weak_hashes_confuse():
    a, b = thue_morse()
    texts = [f"{a}\n{b}", f"{a}\n{b}\n{a}", " ".join([a, "b", "c", "d", "e", "q", b, "b", "c", "d", "e"]), " ".join([a, "b", "c", "d", "e"] * 2)]
    x = quality_rules.base_figures(*A.column_bytes(pa.array(texts)))
    assert x["n_dup_lines"].tolist() == [0, 1, 0, 0]
    assert x["n_repeat_words"].tolist() == [0, 0, 0, 10]


def test_spans_hash_alike_wherever_they_stand():
    rng = np.random.default_rng(2)
    body = rng.integers(97, 100, 900).astype(np.uint8)
    data = np.concatenate([body, [32], body, [32, 97, 32], body[:300], [32], body[:301]]).astype(np.uint8)
    h = A.span_hash(data, *A.words(data, np.array([0, len(data)])))
    assert h[0] == h[1] and len(set(h.tolist())) == 4


def test_only_letters_make_a_language(spark):
    docs = spark.createDataFrame([(1, "abc abd", "x"), (2, "cde", "y"), (3, "½ ² Ⅷ 12 _", "y"), (4, "½ª", None)], DOCS + ", lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, langid.train(docs, bits=10)).collect()}
    assert got[3] == (langid.UNDETERMINED, 0.0)
    assert got[4][0] in "xy"


def test_repeated_rows_of_a_language_count_as_often_as_they_occur(spark):
    docs = spark.createDataFrame([(1, "w " * 4000, "x"), (1, "w " * 4000, "x"), (2, "é", "y"), (None, "é", "z"), (3, None, "y")], DOCS + ", lang string")
    model = langid.train(docs)
    assert model.languages == ["x", "y"]
    assert np.allclose(np.exp(model.prior), [0.5, 0.5])
    got = langid.identify(docs, model).select("doc_id", "lang_pred").collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted([(1, "x"), (1, "x"), (2, "y"), (None, "y"), (3, "und")], key=str)


def brute_features(text, bits):
    """Word 1- and 2-grams, the same of word shapes, and a mark for each word of a repeated 5-word window, one at a time."""

    def hashed(raw):
        return int(A.span_hash(np.frombuffer(raw, np.uint8), np.array([0]), np.array([len(raw)]))[0])

    def mix(x):
        return int(A.mix(np.array([x % 2**64], np.uint64))[0])

    words = [w.encode() for w in WORD.findall(text or "")]
    out = []
    for salt, units in ((11, [hashed(w.lower()) for w in words]), (23, [hashed(re.sub(rb"(.)\1+", rb"\1", bytes(A.SHAPE[np.frombuffer(w, np.uint8)]), flags=re.S)) for w in words])):
        out += [mix(u + salt) for u in units]
        out += [mix(a * 0x9FB21C651E98DF25 + b + salt + 1) for a, b in zip(units, units[1:])]
    low = [w.lower() for w in words]
    windows = Counter(tuple(low[k : k + 5]) for k in range(len(low) - 4))
    marked = {k + j for k in range(len(low) - 4) if windows[tuple(low[k : k + 5])] > 1 for j in range(5)}
    return [x >> (64 - bits) for x in out + [mix(37)] * len(marked)]


def test_quality_scores_match_brute_force(spark):
    texts = [*AWKWARD, "Aa bb CC 12 aA", "one two three four five six one two three four five", "x" * 700 + " y" * 600, "tie tie", "tie tie"]
    rng = np.random.default_rng(3)
    model = linear.Linear(rng.normal(size=1 << 10).astype(np.float32), -0.25)
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    got = {r.doc_id: r.quality_score for r in quality_lr.score(docs, model).collect()}
    for k, t in enumerate(texts):
        f = brute_features(t, 10)
        z = model.bias + sum(float(model.weights[i]) for i in f) / np.sqrt(max(len(f), 1))
        assert abs(got[k] - 1 / (1 + np.exp(-z))) < 1e-6, t[:30] if t else t
    assert got[len(texts) - 1] == got[len(texts) - 2]
