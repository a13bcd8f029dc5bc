"""Sources, sinks, stages and streams."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.plans import queries, registry, stages
from millrace.schema import AUTHOR, CONTENT, CRAWLED, CRITERIA, POSTED, PRODUCT, PRODUCT_NAME, PRODUCT_ORD, RAW_COLUMNS, RAW_SCHEMA, ROW, SOURCE_ROW
from millrace.sources import lexicons, tables
from millrace.streaming import reviews


def raw(spark, contents):
    rows = [(f"u{k}", "2025-01-02 03:04", "L", "Pin: tốt", c, 5.0, "http://x", "2026-08-22T13:40:30.954Z") for k, c in enumerate(contents)]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def test_lexicons(spark, tmp_path):
    files = {
        "abbreviations": "k\tv\tc\tf\nKo\tkhông\t1\tsafe\nnc\tnước\tngâm, ướt\tambiguous\nnc\tnói chung\tchung\tambiguous\nbad line\n",
        "suspect_terms": "\nkp\n",
        "spelling_errors": "Sai\tDung\nxog\txong\n",
        "whitelist": "Tu\nbox\n",
        "emoji": "Emoji|Nghia|Sentiment\n😍|rất_thích|pos\n",
        "syllables": "2\nhoà\ntốt\n",
        "norms": "input,output\n\"['ko','x']\",\"['không','x']\"\n\"['a']\",\"['b','c']\"\n",
        "english": "a\ngood\n",
    }
    paths = {}
    for name, text in files.items():
        p = tmp_path / f"{name}.txt"
        p.write_text(text, encoding="utf-8")
        paths[name] = str(p)
    lexicon = lexicons.read_lexicon(spark, **paths)
    assert lexicon.abbreviations == {"ko": [("không", None)], "nc": [("nước", ["ngâm", "ướt"]), ("nói chung", ["chung"])]}
    assert lexicon.ambiguous_terms == {"nc"}
    assert (lexicon.suspect_terms, lexicon.spelling_errors, lexicon.whitelist) == ({"kp"}, {"xog": "xong"}, {"box"})
    assert (lexicon.emoji, lexicon.syllables, lexicon.norms, lexicon.english) == ({"😍": ("rất_thích", "pos")}, {"hòa", "tốt"}, {"ko": "không"}, {"good"})
    assert lexicons.read_lexicon(spark) == lexicons.Lexicon()


def test_csv_products_and_markdown(spark, tmp_path):
    raw(spark, ["a\nb", "c | d", None]).coalesce(1).write.csv(str(tmp_path / "p.csv"), header=True, quoteAll=False, escape='"')
    products = tables.Products(str(tmp_path), {"p": "p.csv"})
    df = tables.read_products(spark, products)
    assert [r[0] for r in df.orderBy(ROW).select(CONTENT).collect()] == ["a\nb", "c | d", None]
    assert [r[0] for r in df.orderBy(ROW).select(ROW).collect()] == [0, 1, 2]
    with pytest.raises(KeyError, match="unknown product"):
        products.path("q")
    tables.write_markdown(df.select(AUTHOR, CONTENT, ROW), str(tmp_path / "m"), ROW)
    lines = [r[0] for r in spark.read.text(str(tmp_path / "m")).collect()]
    assert lines[0] == f"| {AUTHOR} | {CONTENT} |"
    assert "| u1 | c \\| d |" in lines
    back = tables.read_markdown(spark, str(tmp_path / "m"))
    assert {r[CONTENT] for r in back.collect()} == {"a b", "c | d", None}


def test_checkpoints_suspects_and_cache(spark, tmp_path, capsys):
    df = spark.createDataFrame([("p", 0, 0, "x")], f"{PRODUCT} string, {PRODUCT_ORD} int, {ROW} long, t string").withColumn("at", F.to_timestamp(F.lit("2025-01-01 00:00:00")))
    assert tables.write_checkpoint(df, str(tmp_path), "v1", "s").count() == 1
    assert tables.write_checkpoint(df, str(tmp_path), "v1", "s").count() == 1
    assert tables.read_checkpoint(spark, str(tmp_path), "v1", "none") is None
    assert "no checkpoint" in capsys.readouterr().out
    tables.write_suspects(df.withColumn("l", F.array(F.lit(1))), str(tmp_path), "s")
    assert spark.read.csv(str(tmp_path / "suspect_csv/s"), header=True).first()["l"] == "[1]"
    assert dict(tables.without_zone(df).dtypes)["at"] == "timestamp_ntz"
    (tmp_path / "c.jsonl").write_text("\n".join(json.dumps(x) for x in ({"in": "a", "out": "b"}, {"in": "a", "out": "c"})))
    assert [tuple(r) for r in tables.read_model_cache(spark, str(tmp_path / "c.jsonl")).collect()] == [("a", "c")]
    checked = spark.createDataFrame([("q", 2)], f"`{PRODUCT_NAME}` string, `{SOURCE_ROW}` long")
    checked.write.parquet(str(tmp_path / "k.parquet"))
    with pytest.raises(ValueError, match="unknown products"):
        tables.read_checked(spark, str(tmp_path / "k.parquet"), ["p"])
    assert tables.read_checked(spark, str(tmp_path / "k.parquet"), ["q"]).count() == 1


def test_all_stages(spark, tmp_path):
    texts = ["Hàng rất đẹp 😍 giao nhanh lắm", "Hàng rất đẹp 😍 giao nhanh lắm", "!!!", "ok", "Gọi 0987654321 để mua hàng nhé", "great quality very good product", "Sản phẩm tốt, đóng gói cẩn thận, rất hài lòng"]
    raw(spark, texts).coalesce(1).write.parquet(str(tmp_path / "raw/p.parquet"))
    products = tables.Products(str(tmp_path / "raw"), {"p": "p.parquet"})
    lexicon = lexicons.Lexicon(emoji={"😍": ("rất_thích", "pos")})
    out = stages.run_until(spark, 7, products, str(tmp_path / "out"), lexicon, stages.Settings(least_criterion_rows=1))
    kept = {r[CONTENT] for r in out.collect()}
    assert "Sản phẩm tốt, đóng gói cẩn thận, rất hài lòng" in kept
    assert not any("0987" in t for t in kept)
    assert spark.read.parquet(str(tmp_path / "out/suspect/v3_filtered_advertising")).count() == 1
    assert stages.run_stage(spark, 3, products, str(tmp_path / "empty"), lexicon) is None
    stages.main(["coverage-report"])


def test_lexical_stage_by_the_command_line(spark, tmp_path):
    rows = [("p", 0, k, t, "ko êm") for k, t in enumerate(["Ko tốt lắm shop ơi", "hàng tốt", "ok"])]
    df = spark.createDataFrame(rows, f"{PRODUCT} string, {PRODUCT_ORD} int, {ROW} long, `{CONTENT}` string, Size string")
    tables.write_checkpoint(df, str(tmp_path / "out"), "v4_char_cleaned", "all")
    (tmp_path / "lexicon").mkdir()
    (tmp_path / "lexicon/abbreviations.tsv").write_text("k\tv\tc\tf\nko\tkhông\t1\t1\n")
    (tmp_path / "lexicon/norms.csv").write_text('input,output\n"[\'ko\']","[\'không\']"\n')
    checked = spark.createDataFrame([("p", 4, "ổn nha bạn ơi")], f"`{PRODUCT_NAME}` string, `Dòng Excel gốc` long, `{CONTENT}` string")
    checked.write.parquet(str(tmp_path / "short.parquet"))
    common = ["--root", str(tmp_path), "--out", str(tmp_path / "out"), "--products", "p=none", "--lexicon", str(tmp_path / "lexicon")]
    stages.main(["run-step", "5", *common, "--most-short-words", "1", "--checked", f"short={tmp_path / 'short.parquet'}"])
    stages.main(["run-step", "6", *common])
    out = tables.read_checkpoint(spark, str(tmp_path / "out"), "v6_lexical", "all")
    got = {r[ROW]: (r[CONTENT], r["Nội dung chuẩn hoá"], r["Size (chuẩn hoá)"]) for r in out.collect()}
    assert got[0] == ("Ko tốt lắm shop ơi", "Không tốt lắm shop ơi", "không êm")
    assert got[2][0] == "ổn nha bạn ơi"
    changes = spark.read.parquet(str(tmp_path / "out/suspect/v6_lexical_changes"))
    assert {tuple(r) for r in changes.collect()} == {("ko -> không", 1), ("ko -> không (tiêu chí)", 1)}
    assert spark.read.parquet(str(tmp_path / "out/suspect/v6_lexical_token_frequencies")).count() > 0


def test_registry_and_report(spark, tmp_path):
    r = registry.StepRegistry()

    @r.step("9", 2, "x")
    def f(df):
        return df.where("k <> 1").withColumn("t", F.when(F.col("k") == 2, "B").otherwise(F.col("t")))

    assert r.get("9") is f
    assert [m.name for m in r.by_tier(2)] == ["x"]
    assert r.coverage(["9", "8"]) == {"9": True, "8": False}
    with pytest.raises(ValueError, match="already"):
        r.step("9", 2, "y")(f)
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, t string")
    _, report = registry.reported("x", f, df, ["k"], "t")
    assert (report.rows_before, report.rows_after, report.rows_changed, report.rows_dropped) == (3, 2, 1, 1)
    assert report.examples == [{"k": 2, "before": "b", "after": "B"}]
    report.save(str(tmp_path / "r.json"))
    assert json.loads((tmp_path / "r.json").read_text())["step"] == "x"
    assert report.summary_line().startswith("x: 3 -> 2 rows")


def test_streams(spark, tmp_path):
    rows = [("u", " a  b ", "2025-01-01 00:00:00"), ("u", "a b", "2025-01-01 00:01:00"), ("v", "!!", "2025-01-01 00:02:00"), (None, "a b", "2025-01-01 00:03:00"), (None, "a b", "2025-01-01 00:04:00")]
    schema = f"`{AUTHOR}` string, `{CONTENT}` string, at timestamp"
    df = spark.createDataFrame(rows, f"`{AUTHOR}` string, `{CONTENT}` string, at string").withColumn("at", F.to_timestamp("at"))
    df.write.parquet(str(tmp_path / "in"))
    stream = reviews.dedup_stream(reviews.clean_stream(reviews.read_stream(spark, str(tmp_path / "in"), schema)), "at")
    reviews.write_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r[0] or "", r[1]) for r in got.select(AUTHOR, CONTENT).collect()) == [("", "a b"), ("", "a b"), ("u", "a b")]
    counts = reviews.windowed_counts(reviews.read_stream(spark, str(tmp_path / "in"), schema), "at", [AUTHOR])
    q = counts.writeStream.outputMode("complete").format("memory").queryName("counts").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("counts").agg(F.sum("n")).first()[0] == 5


def test_queries_are_registered():
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
    assert {POSTED, CRAWLED, CRITERIA} <= set(RAW_COLUMNS)
