"""Secret scans against regular expressions; encoding against the library and round trips; the pipeline and the registry."""

import hashlib
import random
import re

import numpy as np
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__
import corpus_pipeline
from millrace.llm import queries, secret_scan, spdropout

DOCS = "doc_id long, text string"
RULES = {
    "assign": re.compile(r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def brute_secrets(text):
    spans, counts = [], []
    for order, (kind, rule) in enumerate(RULES.items()):
        found = [m for m in rule.finditer(text or "") if (len(m[2]) >= 8 if kind == "assign" else len(m[0]) >= (16 if kind == "access" else 32))]
        counts.append(len(found))
        spans += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in found]
    return (*counts, hashlib.sha256(",".join(s[2] for s in sorted(spans)).encode()).hexdigest())


def secret_rows():
    rng = random.Random(1)
    parts = ["password=", "Token: ", "API_KEY='", "apikey = ", "secret=abc", "token=secret:abcdefgh12", "AKIA", "ABCDEFGH0123", "é", "ж🎉", " ", "\n", "0123456789abcdef", "deadbeef" * 4, "x", '"', "hunter2hunter2", "ſecret=12345678", "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a" * 36]
    rows = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(300)]
    return list(enumerate([*rows, None, "", "a" * 100_000 + " token=abcdefgh1", rows[0]]))


def test_secret_scan(spark, tmp_path):
    rows = secret_rows()
    spark.createDataFrame([(*r, "z") for r in rows], DOCS + ", blob string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.op7_secret_scan(spark, str(tmp_path)).collect()}
    assert {k: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for k, r in got.items()} == {k: brute_secrets(t) for k, t in rows}
    assert any("private_key:" in r.spans for r in got.values())
    assert any("github:" in r.spans for r in got.values())


def test_ledger_scans_only_what_is_new(spark):
    one = spark.createDataFrame([("a", 1, "token=abcdefgh1"), ("b", 1, "clean"), ("c", 1, "token=abcdefgh1"), ("d", 1, None)], "path string, version int, text string")
    ledger = spark.createDataFrame(secret_scan.scan(one).collect(), secret_scan.empty_ledger(one).schema)
    assert ledger.select("blob").distinct().count() == 3
    assert secret_scan.scan(one, ledger).isEmpty()
    two = one.union(spark.createDataFrame([("a", 2, "token=zzzzzzzz9 token=yyyyyyyy8")], one.schema))
    new = secret_scan.scan(two, ledger)
    assert new.select("blob").distinct().count() == 1
    newer = (secret_scan.Rule("assign", secret_scan.BASE_RULES[0].pattern, 4, 2, version=2), *secret_scan.RULES[1:])
    redo = secret_scan.scan(one, ledger, newer)
    assert {(r.rule, r.version) for r in redo.collect()} == {("assign", 2)}
    assert redo.count() == 3
    back = secret_scan.join_back(two, ledger.union(new))
    assert {(r.path, r.version): len(r.findings) for r in back.collect()} == {("a", 1): 1, ("b", 1): 0, ("c", 1): 1, ("d", 1): 0, ("a", 2): 2}
    assert set(two.columns) <= set(back.columns)
    assert secret_scan.scan(one.where("false")).isEmpty()


def test_stored_ledger_and_clashing_columns(spark, tmp_path):
    docs = spark.createDataFrame([(1, "token=abcdefgh1", "b", 5), (2, None, "b", 6)], DOCS + ", blob string, findings int")
    path = str(tmp_path / "ledger")
    first = secret_scan.update(docs, path)
    assert first.count() == 2 * len(secret_scan.RULES)  # clean pairs, too
    assert secret_scan.scan(docs, secret_scan.read_ledger(spark, path)).isEmpty()
    assert secret_scan.update(docs, path).count() == 2 * len(secret_scan.RULES)
    back = {r.doc_id: r for r in secret_scan.join_back(docs, secret_scan.read_ledger(spark, path)).collect()}
    assert [len(back[k].findings) for k in (1, 2)] == [1, 0]
    assert back[1].blob == "b"
    assert secret_scan.scan_all(docs.where("false")).isEmpty()


def test_secret_scan_is_native(spark):
    docs = spark.createDataFrame(secret_rows()[:3], DOCS)
    plan = secret_scan.scan(docs.select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


TEXTS = ["Hello  wörld\n\n x\t y ", "", " ", "  lead", "trail  ", "日本語テキスト" * 30, "a" * 300, "x́ 🎉🎉 ok", "\n\n \n", "mark ▁ here▁", "12345 6 7", "\r\n\t\x00", "<s></s><unk>"]


def encoder(dropout, variants=4, seed=13):
    return spdropout.Encoder(spdropout.vocabulary(open(spdropout.MODEL_PATH, "rb").read()), seed, dropout, variants)


def pieces(e, texts):
    ids, bound = e.encode(texts, np.arange(len(texts)).astype(np.uint64))
    return [ids[bound[k] : bound[k + 1]].tolist() for k in range(len(texts))], ids, bound


def test_without_dropout_pieces_are_the_librarys():
    library = sentencepiece.SentencePieceProcessor(model_file=spdropout.MODEL_PATH)
    plain = [t for t in TEXTS if "▁" not in t]
    assert pieces(encoder(0.0), plain)[0] == [library.encode(t) for t in plain]


@given(st.lists(st.text(max_size=60), min_size=1, max_size=5))
@settings(max_examples=60, deadline=None)
def test_round_trip_of_any_text(texts):
    e = encoder(0.3)
    texts = [t.encode("utf-8", "ignore").decode() for t in [*texts, *TEXTS]]
    _, ids, bound = pieces(e, texts)
    raw, at = spdropout.decode_ids(e.v, ids, bound)
    assert [bytes(raw[at[k] : at[k + 1]]).decode() for k in range(len(texts))] == texts


def brute_dropout(library, text, doc_key, seed, dropout):
    """Merges the best pair that the keyed hash lets pass, looking at all pairs every time."""
    full = (1 << 64) - 1
    k2, k3, k4 = (int(x) for x in (spdropout._K2, spdropout._K3, spdropout._K4))

    def mix(x):
        return int(spdropout.A.mix(np.array([x & full], np.uint64))[0])

    out = []
    for place, chunk in enumerate(spdropout._CHUNK.findall(" " + text) if text else []):
        key = mix(mix(doc_key + place * k2) ^ mix(seed))
        marked = ["▁" if c == " " else "" if c == "▁" else c for c in chunk]
        parts = [(k, k + 1) for k in range(len(chunk))]
        while True:
            best = None
            for n, ((a, b), (_, c)) in enumerate(zip(parts, parts[1:])):
                piece = "".join(marked[a:c]) if all(marked[a:c]) else None
                if piece is None or library.id_to_piece(library.piece_to_id(piece)) != piece or library.is_byte(library.piece_to_id(piece)):
                    continue
                if mix(key + a * k2 + b * k3 + c * k4) < int(dropout * 2.0**64):
                    continue
                rank = (-library.get_score(library.piece_to_id(piece)), library.piece_to_id(piece), n)
                best = min(best, (rank, n)) if best else (rank, n)
            if best is None:
                break
            n = best[1]
            parts[n : n + 2] = [(parts[n][0], parts[n + 1][1])]
        for a, b in parts:
            piece = "".join(marked[a:b])
            known = piece and library.id_to_piece(library.piece_to_id(piece)) == piece
            out += [library.piece_to_id(piece)] if known else [library.piece_to_id(f"<0x{x:02X}>") for x in chunk[a:b].encode()]
    return out


def test_dropout_matches_brute_force():
    library = sentencepiece.SentencePieceProcessor(model_file=spdropout.MODEL_PATH)
    rng = random.Random(4)
    texts = [*TEXTS[:6], TEXTS[8], TEXTS[10], "the the the the wonder wonder", " ".join(rng.choice("international under standing the a of wörld 12".split()) for _ in range(60)), "x" * 80 + " and more"]
    e = encoder(0.3)
    for _ in range(3):  # remembered nodes must give the same
        assert pieces(e, texts)[0] == [brute_dropout(library, t, k, 13, 0.3) for k, t in enumerate(texts)]


def test_dropout_is_keyed_and_varied():
    texts = ["the conversation about international understanding " * 20]
    a, b = pieces(encoder(0.3), texts)[0], pieces(encoder(0.3), texts)[0]
    assert a == b
    assert a != pieces(encoder(0.3, seed=14), texts)[0]
    library = sentencepiece.SentencePieceProcessor(model_file=spdropout.MODEL_PATH)
    assert len(a[0]) > len(library.encode(texts[0]))
    split = {tuple(x) for x in _by_word(a[0], library) if "".join(x) == "▁international"}
    assert len(split) > 1


def _by_word(ids, library):
    out = []
    for p in map(library.id_to_piece, ids):
        if p.startswith("▁") or not out:
            out.append([])
        out[-1].append(p)
    return out


def test_heap_and_rows_agree():
    v, rng = encoder(0.2).v, random.Random(1)
    for _ in range(150):
        chunk = " " + "".join(rng.choice("theandriongs é") for _ in range(rng.randint(1, 40)))
        symbols, key, below = [v.char.get(c, -1) for c in chunk], rng.getrandbits(64), int(0.2 * 2**64)
        ids, starts = spdropout._agenda(v, symbols, key, below)
        rows, begin, count = spdropout._agenda_rows(v, np.array([symbols], np.int32), np.array([len(symbols)]), np.array([key], np.uint64), below)
        assert ids == rows[0, : count[0]].tolist()
        assert starts == begin[0, : count[0]].tolist()


def test_every_occurrence_has_its_own_draw():
    texts, e = ["the conversation about international understanding ", " ".join(["the"] * 20_000)], encoder(0.1)
    by_word = _by_word(pieces(e, [texts[0] * 1500])[0][0], sentencepiece.SentencePieceProcessor(model_file=spdropout.MODEL_PATH))
    assert len({tuple(x) for x in by_word if "".join(x) == "▁international"}) > 4
    # "the" is three merges or two, each candidate skipped with rate 0.1
    whole = e.v.symbol["▁the"]
    ids = pieces(e, [texts[1]])[0][0]
    symbols = [e.v.char[c] for c in " the"]
    keys = spdropout.A.mix(np.arange(20_000).astype(np.uint64))
    rows, _, count = spdropout._agenda_rows(e.v, np.tile(np.array(symbols, np.int32), (20_000, 1)), np.full(20_000, 4), keys, e.below)
    assert abs(ids.count(whole) - int((rows[:, 0] == whole).sum())) < 400


def test_agenda_looks_up_both_sides_of_a_merge_at_once(monkeypatch):
    """A turn of the agenda costs one lookup for all rows, not one for each side."""
    v = encoder(0.1).v
    turns, merge = [], v.merge
    monkeypatch.setattr(v, "merge", lambda a, b: turns.append(len(a)) or merge(a, b))
    symbols = v.symbols_of(" international")
    assert symbols.tolist() == [v.char[c] for c in " international"]
    assert v.symbols_of("\U0010ffff\ud800").tolist() == [-1, -1]
    rows, begin, count = spdropout._agenda_rows(v, np.tile(symbols, (3, 1)), np.full(3, len(symbols)), np.zeros(3, np.uint64), 0)
    assert len(turns) == 1 + len(symbols) - count[0]
    ids, starts = spdropout._agenda(v, symbols.tolist(), 0, 0)
    assert rows[0, : count[0]].tolist() == ids and begin[0, : count[0]].tolist() == starts


def test_remembered_agendas_are_each_occurrences_own(monkeypatch):
    rng = random.Random(2)
    words = ["the", "international", "understanding", "né", "日本語テキ", "a" * 50, "ab" * 40, "x▁y", "12345"]
    text = " ".join(rng.choice(words) + rng.choice(["", "s", "ing"]) for _ in range(1500))
    for dropout in (0.1, 0.5, 1.0):
        shared = encoder(dropout)
        got = pieces(shared, [text])[0]
        monkeypatch.setattr(spdropout, "REMEMBERED", 0)
        assert pieces(shared, [text])[0] == got
        e = encoder(dropout)
        monkeypatch.setattr(spdropout.Encoder, "_draw", lambda self, node, key: np.arange(len(node)))
        assert pieces(e, [text])[0] == got
        monkeypatch.undo()


def test_encode_and_decode_frames(spark):
    rows = list(enumerate([*TEXTS, None, "word " * 20_000, TEXTS[0]]))
    docs = spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", ids int")
    encoded = spdropout.encode(docs)
    assert all(r.lossless for r in encoded.collect())
    assert {r.doc_id: r.text for r in spdropout.decode(encoded).collect()} == {k: t or "" for k, t in rows}
    assert spdropout.encode(docs.where("false")).isEmpty()


def test_pipeline(spark, tmp_path):
    rng = random.Random(3)
    words = "the house river walks slowly under green tree and sings softly while many birds wander over quiet hills".split()
    fresh = lambda n: " ".join(rng.choice(words) + rng.choice(["", "er", "ly"]) for _ in range(n))
    item = fresh(20)
    base = fresh(60)
    texts = [base, base + " end", fresh(50), fresh(30) + " " + item + " " + fresh(30), "short text", fresh(40) + "\n" + fresh(25), None, " ".join(fresh(40).upper().split()) + " !!"]
    texts += [fresh(45) for _ in range(40)]
    rows = [(k, t, "en", "s", None if t is None else len(t)) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS + ", lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(k, 1, 0) for k in range(8, 48)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    now = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, str(tmp_path))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert now.columns == docs.columns
        now = spark.createDataFrame(now.collect(), now.schema)
    got = {r.doc_id for r in now.collect()}
    assert {2, 5} <= got and not {3, 4, 6} & got and set(range(8, 48)) <= got
    assert all(r.lossless for r in now.collect())
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == got


def test_registry():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names if n.startswith("op")) == list(range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= set(names)
