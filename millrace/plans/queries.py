"""Registered queries of the review operators, each over its whole table, with equal SQL where there is one.

The tables hold no Vietnamese reviews. ``documents`` stands in: its language is the product, its
source the author, its text the content. Where a rule would meet nothing in these texts, the input
is derived from the columns inside the query, and likewise in the SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import batched
from ..functions import text as X
from ..operators import coarse, context_models, lexical, neardup, normalize, structure
from ..operators.diff import diff_rows
from ..operators.review import apply_spelling_review, merge_checked_rows
from ..schema import AUTHOR, CONTENT, CORRECTED, CRAWLED, CRITERIA, EMOJI_SENTIMENT, EMOJIS, MOVED, POSTED, PRODUCT, PRODUCT_NAME, PRODUCT_ORD, REVIEW_ID, ROW, SOURCE_ROW, TEXT_NORM
from ..sources.lexicons import Lexicon

LANGUAGES = ["de", "en", "es", "fr"]
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def note(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLE_SQL[function.__name__] = sql
        return function

    return note


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = batched.short_batches(spark).read.parquet(f"{sf_dir}/documents.parquet")
    ordinal = F.array_position(F.array(*map(F.lit, LANGUAGES)), F.col("lang")).cast("int") - 1
    return docs.select(F.col("lang").alias(PRODUCT), ordinal.alias(PRODUCT_ORD), F.col("doc_id").alias(ROW), F.col("source").alias(AUTHOR), F.col("text").alias(CONTENT))


def plain(df: DataFrame, **columns: str) -> DataFrame:
    """ASCII names for the result."""
    return df.select(*(F.col(f"`{c}`").alias(n) for n, c in columns.items()))


# SQL has no Unicode white space class; this one lists what the tables can hold. Likewise word characters.
_TRIM = r"regexp_replace({0}, '^[\s\x0b\x{{85}}\p{{Z}}]+|[\s\x0b\x{{85}}\p{{Z}}]+$', '', 'g')"


def _trim(x: str) -> str:
    return _TRIM.format(x)


def _words(x: str) -> str:
    return f"CASE WHEN {_trim(x)} = '' THEN 0 ELSE len(regexp_split_to_array({_trim(x)}, '[\\s\\x0b\\x{{85}}\\p{{Z}}]+')) END".replace("{{", "{").replace("}}", "}")


_PHONE = r"regexp_matches(text, '(^|[^\p{Nd}])(\+84|0)([\s\x0b\p{Z}.\-]?\p{Nd}){8,10}([^\p{Nd}]|$)')"
_URL = r"(regexp_matches(text, '(?i)https?://[^\s\p{Z}]|www\.[^\s\p{Z}]') OR regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])[a-z0-9]([a-z0-9-]*[a-z0-9])?\.(com|net|org|vn|store|info|biz|io)(\.[\p{L}\p{N}_]{2,3})?([^\p{L}\p{N}_]|$)'))"


@query("SELECT lang AS product, doc_id AS row FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, text ORDER BY doc_id) AS k FROM documents) WHERE k = 1")
def exact_dedup_keep_first(spark, sf_dir):
    return plain(coarse.drop_exact_duplicates(reviews(spark, sf_dir)), product=PRODUCT, row=ROW)


@query("SELECT lang AS product, doc_id AS row FROM (SELECT *, row_number() OVER (PARTITION BY source, lower(text) ORDER BY lang, doc_id) AS k FROM documents) WHERE k = 1")
def exact_dedup_across_products(spark, sf_dir):
    return plain(coarse.drop_exact_duplicates_across(normalize.add_text_norm(reviews(spark, sf_dir))), product=PRODUCT, row=ROW)


@query(
    "WITH d AS (SELECT doc_id, text, 'shop' || doc_id % 3 AS author FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY author, text ORDER BY doc_id) AS k, count(*) OVER (PARTITION BY author, text) AS n FROM d), "
    "g AS (SELECT *, dense_rank() OVER (ORDER BY author, text) AS g FROM r WHERE n > 1) SELECT 'all' AS source, doc_id AS orig_row, CASE WHEN k = 1 THEN 'keep' ELSE 'remove' END AS action, g::INT AS dup_group, doc_id + 2 AS excel_row FROM g"
)
def duplicate_evidence(spark, sf_dir):
    rows = reviews(spark, sf_dir).withColumns({PRODUCT: F.lit("all"), AUTHOR: F.concat(F.lit("shop"), F.col(ROW) % 3)})
    return coarse.duplicate_evidence(rows)


@query("SELECT lang || '_' || CASE WHEN k < 100000 THEN lpad(k::VARCHAR, 5, '0') ELSE k::VARCHAR END AS review_id, doc_id AS row, text AS raw FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS k FROM documents)")
def assign_review_id(spark, sf_dir):
    return plain(structure.assign_review_id(reviews(spark, sf_dir)), review_id=REVIEW_ID, row=ROW, raw="review_raw")


@query(
    "SELECT doc_id AS row, CASE WHEN doc_id % 4 = 0 THEN 'ẩn danh' ELSE source END AS author, "
    "CASE WHEN doc_id % 8 = 0 THEN 'rất tốt' WHEN doc_id % 4 = 0 THEN 'rất tốt' || chr(10) || " + _trim("text") + " ELSE text END AS content FROM documents"
)
def field_misalignment(spark, sf_dir):
    rows = reviews(spark, sf_dir).withColumns({AUTHOR: F.when(F.col(ROW) % 4 == 0, " rất tốt ").otherwise(F.col(AUTHOR)), CONTENT: F.when(F.col(ROW) % 8 == 0, "  ").otherwise(F.col(CONTENT))})
    return plain(structure.fix_field_misalignment(rows), row=ROW, author=AUTHOR, content=CONTENT)


@query("SELECT doc_id AS row, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE text END AS content, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 'a: b' END AS criteria FROM documents WHERE doc_id % 15 <> 0")
def drop_empty_rows(spark, sf_dir):
    rows = reviews(spark, sf_dir).withColumns({CONTENT: F.when(F.col(ROW) % 3 == 0, " \n\t").otherwise(F.col(CONTENT)), CRITERIA: F.when(F.col(ROW) % 5 == 0, " ").otherwise("a: b")})
    return plain(structure.drop_empty_rows(rows), row=ROW, content=CONTENT, criteria=CRITERIA)


@query("SELECT event_id AS row, date_trunc('minute', ts)::TIMESTAMP AS posted, date_trunc('second', ts)::TIMESTAMP AS crawled FROM events")
def fix_data_types(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    raw = events.select(F.col("event_id").alias(ROW), F.date_format("ts", "yyyy-MM-dd HH:mm").alias(POSTED), F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".0Z")).alias(CRAWLED))
    typed = structure.fix_data_types(raw)
    return typed.select(F.col(ROW).alias("row"), F.col(POSTED).alias("posted"), F.col(CRAWLED).cast("timestamp_ntz").alias("crawled"))


@query(
    "SELECT doc_id AS row, source AS size, lang || '; ' || lang AS colour, CASE WHEN doc_id = 5 THEN " + _trim("text") + " || chr(10) || 'Pin: http://x:1' ELSE text END AS content, CASE WHEN doc_id = 5 THEN 'Pin' END AS moved FROM documents"
)
def criteria_split(spark, sf_dir):
    blob = F.concat(F.lit("Size : "), F.col(AUTHOR), F.lit("\nno key\nColour: "), F.col(PRODUCT), F.lit("\nColour:"), F.col(PRODUCT), F.when(F.col(ROW) == 5, "\nPin: http://x:1").otherwise(""))
    rows = reviews(spark, sf_dir).withColumn(CRITERIA, blob)
    out = structure.split_merged_fields(rows)
    return plain(out, row=ROW, size="Size", colour="Colour", content=CONTENT, moved=MOVED)


@query("SELECT lang AS product, k, count(*) AS n FROM (SELECT lang, unnest(['Size', 'Colour']) AS k FROM documents) GROUP BY ALL")
def criteria_key_counts(spark, sf_dir):
    rows = reviews(spark, sf_dir).withColumn(CRITERIA, F.concat(F.lit("Size: "), F.col(AUTHOR), F.lit("\nColour: "), F.col(PRODUCT)))
    return structure.criteria_keys(rows).select(F.col(PRODUCT).alias("product"), "k", "n")


@query(
    r"SELECT page_id AS row, nullif(t, '') AS content FROM (SELECT page_id, replace(replace(replace(replace(nfc_normalize(regexp_replace(regexp_replace(html, '(?i)<br\s*/?>', chr(10), 'g'), '</?[a-zA-Z][^<>]*>', '', 'g')), '&middot;', '·'), '&copy;', '©'), '&quot;', '\"'), '&amp;', '&') AS t FROM pages)".replace('\\"', '"')
)
def normalize_unicode_and_html(spark, sf_dir):
    pages = batched.short_batches(spark).read.parquet(f"{sf_dir}/pages.parquet").select(F.col("page_id").alias(ROW), F.col("html").alias(CONTENT))
    return plain(normalize.normalize_unicode_and_html(pages), row=ROW, content=CONTENT)


@query(r"SELECT page_id AS row, nullif(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '\r\n?', chr(10), 'g'), '[ \t\x0b\f\x{85}\p{Z}]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'), '\n{2,}', chr(10), 'g'), chr(10) || ' '), '') AS content FROM pages")
def squeeze_whitespace(spark, sf_dir):
    pages = batched.short_batches(spark).read.parquet(f"{sf_dir}/pages.parquet").select(F.col("page_id").alias(ROW), F.col("html").alias(CONTENT))
    return plain(normalize.strip_extra_whitespace(pages), row=ROW, content=CONTENT)


@query("SELECT doc_id AS row, lower(text) AS text_norm FROM documents")
def add_text_norm(spark, sf_dir):
    return plain(normalize.add_text_norm(reviews(spark, sf_dir)), row=ROW, text_norm=TEXT_NORM)


@query(f"SELECT doc_id AS row, {_URL} AS url, {_PHONE} AS phone FROM documents")
def url_and_phone(spark, sf_dir):
    return reviews(spark, sf_dir).select(F.col(ROW).alias("row"), X.contains_url(F.col(CONTENT)).alias("url"), X.contains_phone(F.col(CONTENT)).alias("phone"))


@query(f"SELECT doc_id AS row FROM documents WHERE {_URL} OR {_PHONE}")
def split_advertising(spark, sf_dir):
    return plain(coarse.split_advertising(reviews(spark, sf_dir)).suspect, row=ROW)


_LISTS = ["[" + ", ".join(f"'{w}'" for w in words) + "]" for words in (X.PLAIN_VIETNAMESE, X.COMMON_ENGLISH)]


@query(
    rf"WITH t AS (SELECT doc_id, text, regexp_extract_all(lower(text), '[\p{{L}}\p{{Nl}}\p{{No}}]+') AS w FROM documents) SELECT doc_id AS row, CASE WHEN regexp_matches(lower(text), '[{X.ACCENTED}]') THEN 'vi' WHEN NOT regexp_matches(text, '\p{{L}}') THEN 'vi' "
    rf"WHEN list_has_any(w, {_LISTS[0]}) THEN 'vi' WHEN len([x for x in w if list_contains({_LISTS[1]}, x)]) = 0 THEN 'vi' WHEN len(w) >= 3 AND len([x for x in w if list_contains({_LISTS[1]}, x)]) / len(w) >= 0.2 THEN 'drop' ELSE 'suspect' END AS label FROM t"
)
def language_filter(spark, sf_dir):
    return reviews(spark, sf_dir).select(F.col(ROW).alias("row"), X.language(F.col(CONTENT), 0.2).alias("label"))


@query("SELECT doc_id AS row FROM documents WHERE doc_id % 6 <> 0 OR doc_id % 12 = 0")
def drop_symbol_only(spark, sf_dir):
    rows = reviews(spark, sf_dir).withColumns({CONTENT: F.when(F.col(ROW) % 6 == 0, "!!! 😍 ~~").otherwise(F.col(CONTENT)), CRITERIA: F.when(F.col(ROW) % 12 == 0, "a: b")})
    return plain(coarse.drop_symbol_only(rows), row=ROW)


@query(f"SELECT doc_id AS row, source AS author FROM documents WHERE {_words('text')} BETWEEN 1 AND 8")
def split_short(spark, sf_dir):
    return plain(coarse.split_short(reviews(spark, sf_dir), most_words=8).suspect, row=ROW, author=AUTHOR)


@query(r"SELECT doc_id AS row FROM documents WHERE regexp_matches(lower(text), '(^|[^\p{L}\p{N}_])(worthless|pathetic|und so)([^\p{L}\p{N}_]|$)')")
def split_terms(spark, sf_dir):
    return plain(coarse.split_terms(reviews(spark, sf_dir), {"worthless", "pathetic", "und so"}).suspect, row=ROW)


_CLASS = r"""[^\p{L}\p{N}\s\x0b\x{85}\p{Z}.,!?:;''"()\-/%+&@#$=*…\p{Sc}\p{Mn}\p{Mc}\p{Me}\x01]"""


@query(
    r"SELECT doc_id AS row, nullif(replace(regexp_replace(replace(regexp_replace(regexp_replace(text || ' ~a_b_c _ ^', '([\p{L}\p{N}])_([\p{L}\p{N}])', '\1' || chr(1) || '\2', 'g'), '([\p{L}\p{N}])_([\p{L}\p{N}])', '\1' || chr(1) || '\2', 'g'), '_', ' '), '" + _CLASS + "', ' ', 'g'), chr(1), '_'), '') AS content FROM documents"
)
def remove_special_chars(spark, sf_dir):
    rows = reviews(spark, sf_dir).withColumn(CONTENT, F.concat(F.col(CONTENT), F.lit(" ~a_b_c _ ^")))
    return plain(normalize.remove_meaningless_special_chars(rows), row=ROW, content=CONTENT)


# Backreferences are not in SQL's patterns: one replacement for each letter and each mark.
_COLLAPSED = "text"
for _c in "abcdefghijklmnopqrstuvwxyzàáâäãçèéêëìíîïñòóôöõùúûüß":
    _both = _c + _c.upper() if _c != "ß" else _c
    _COLLAPSED = f"regexp_replace({_COLLAPSED}, '([{_both}])[{_both}]{{2,}}', '\\1', 'g')"
for _c in "!?,:;-*=+/":
    _COLLAPSED = f"regexp_replace({_COLLAPSED}, '[{_c}]{{2,}}', '{_c}', 'g')"
_COLLAPSED = rf"regexp_replace({_COLLAPSED}, '\.{{3,}}', '...', 'g')"


@query(f"SELECT doc_id AS row, {_COLLAPSED} || ' đẹp quá! good ...' AS content FROM documents")
def collapse_repeats(spark, sf_dir):
    rows = reviews(spark, sf_dir).withColumn(CONTENT, F.concat(F.col(CONTENT), F.lit(" đẹppppp quááá!!!!! gooood .....")))
    return plain(normalize.normalize_repeated_characters(rows), row=ROW, content=CONTENT)


_EMOJI = {"😍": ("rất_thích", "pos"), "👍": ("ưng_ý", "pos"), "😡": ("tức_giận", "neg")}


@query(
    "SELECT doc_id AS row, CASE doc_id % 3 WHEN 0 THEN text || ' rất_thích ưng_ý x' WHEN 1 THEN text || ' tức_giận x' ELSE text || ' x' END AS content, CASE doc_id % 3 WHEN 0 THEN '😍😍👍' WHEN 1 THEN '😡' ELSE '🚀' END AS emojis, CASE doc_id % 3 WHEN 0 THEN 'pos' WHEN 1 THEN 'neg' END AS sentiment FROM documents"
)
def inline_emoji(spark, sf_dir):
    run = F.when(F.col(ROW) % 3 == 0, "😍😍👍").when(F.col(ROW) % 3 == 1, "😡").otherwise("🚀")
    rows = reviews(spark, sf_dir).withColumn(CONTENT, F.concat(F.col(CONTENT), run, F.lit("x")))
    return plain(normalize.handle_inline_emoji(rows, _EMOJI), row=ROW, content=CONTENT, emojis=EMOJIS, sentiment=EMOJI_SENTIMENT)


@query("SELECT CASE doc_id % 3 WHEN 0 THEN '🚀' ELSE '🥸' END AS emoji, count(*) AS n FROM documents GROUP BY 1")
def unknown_emojis(spark, sf_dir):
    rows = reviews(spark, sf_dir).withColumn(CONTENT, F.concat(F.col(CONTENT), F.lit(" 😍"), F.when(F.col(ROW) % 3 == 0, "🚀").otherwise("🥸")))
    return normalize.unknown_emojis(rows, _EMOJI)


@query(r"SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS token FROM documents) WHERE NOT regexp_matches(token, '^\p{N}+$') GROUP BY token")
def token_counts(spark, sf_dir):
    return lexical.token_counts(reviews(spark, sf_dir)).select("token", "n")


@query(r"SELECT doc_id AS row, regexp_replace(regexp_replace(text, '(^|[^\p{L}\p{N}_])(?i:erat)($|[^\p{L}\p{N}_])', '\1không\3', 'g'), '(^|[^\p{L}\p{N}_])(?i:erat)($|[^\p{L}\p{N}_])', '\1không\3', 'g') AS content FROM documents".replace(r"\3", r"\2"))
def expand_abbreviations(spark, sf_dir):
    return plain(lexical.normalize_abbreviations(reviews(spark, sf_dir), Lexicon(abbreviations={"erat": [("không", None)]})), row=ROW, content=CONTENT)


_LEXICON = Lexicon(abbreviations={"ko": [("không", None)]}, spelling_errors={"xog": "xong"}, whitelist=frozenset({"box"}), syllables=frozenset("không hàng đẹp tốt giao nhanh của là the and en de".split()), norms={"ko": "không"})


@query()
def nonstandard_tokens(spark, sf_dir):
    rows = reviews(spark, sf_dir).withColumn(CONTENT, F.concat(F.col(CONTENT), F.lit(" Ko xog box hang đẹp hàng hàng hàng")))
    return lexical.nonstandard_tokens(lexical.token_stats(rows, _LEXICON), _LEXICON)


@query()
def spelling_corrections(spark, sf_dir):
    rows = reviews(spark, sf_dir).withColumn(CONTENT, F.concat(F.col(CONTENT), F.lit(" Hangf xog, hàng hàng")))
    return plain(lexical.split_spelling_errors(rows, _LEXICON).suspect, row=ROW, content=CORRECTED)


def _with_ko(spark, sf_dir) -> DataFrame:
    return reviews(spark, sf_dir).withColumns({CONTENT: F.concat_ws(" ", F.lit("Ko tốt"), F.col(CONTENT)), "Size": F.concat(F.lit("ko "), F.col(AUTHOR))})


@query("SELECT doc_id AS row, 'Không tốt ' || text AS content, 'ko -> không' AS replaced FROM documents")
def vote_and_replace(spark, sf_dir):
    """Of the suggestions for all non-standard tokens, only that for ``ko`` has two sources."""
    rows = _with_ko(spark, sf_dir)
    found = lexical.suspect_rows(rows, lexical.agreed_tokens(lexical.nonstandard_tokens(lexical.token_stats(rows, _LEXICON), _LEXICON)))
    return plain(lexical.apply_corrections(rows, found, _LEXICON), row=ROW, content=lexical.NORMALISED, replaced=lexical.REPLACED)


@query("SELECT lang AS product, 'Size' AS criterion, 'ko ' || source AS value, count(*) AS n, 'không ' || source AS normal, 'ko -> không' AS replaced FROM documents GROUP BY lang, source")
def criterion_values_corrected(spark, sf_dir):
    rows = _with_ko(spark, sf_dir)
    values = lexical.corrected_values(lexical.suspect_values(rows, lexical.nonstandard_tokens(lexical.token_stats(rows, _LEXICON), _LEXICON)))
    return plain(values, product=PRODUCT, criterion="criterion", value="value", n="n", normal=lexical.NORMALISED, replaced=lexical.REPLACED)


@query("SELECT doc_id AS row, 'không ' || source AS size FROM documents")
def criterion_columns_normalised(spark, sf_dir):
    rows = _with_ko(spark, sf_dir)
    values = lexical.corrected_values(lexical.suspect_values(rows, lexical.agreed_tokens(lexical.nonstandard_tokens(lexical.token_stats(rows, _LEXICON), _LEXICON))))
    return plain(lexical.apply_value_corrections(rows, values), row=ROW, size="Size (chuẩn hoá)")


@query("SELECT 'ko -> không' AS change, count(*) AS n FROM documents UNION ALL SELECT 'ko -> không (tiêu chí)', count(DISTINCT (lang, source)) FROM documents")
def change_counts(spark, sf_dir):
    rows = _with_ko(spark, sf_dir)
    nonstandard = lexical.agreed_tokens(lexical.nonstandard_tokens(lexical.token_stats(rows, _LEXICON), _LEXICON))
    values = lexical.corrected_values(lexical.suspect_values(rows, nonstandard))
    return lexical.change_counts(lexical.apply_corrections(rows, lexical.suspect_rows(rows, nonstandard), _LEXICON), values)


#: A list of odd tokens of known kinds, so that what follows from it can be said in SQL.
_ODD = [("worthless", "a", "poor", ""), ("und", "b", "", "u"), ("the", "b", "", "")]
_ODD_SQL = (
    "WITH o AS (SELECT * FROM (VALUES ('worthless', 'a', 'worthless -> poor [a]', 'poor', 1), ('und', 'b', 'und [b]', 'u', 1), ('the', 'b', 'the [b]', '', 0)) x(token, kind, detail, best, votes)), "
    r"t AS (SELECT doc_id, lang, unnest(w) AS token, unnest(range(len(w))) AS pos FROM (SELECT doc_id, lang, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents)), "
    "h AS (SELECT doc_id, lang, token, min(pos) AS pos, count(*) AS n FROM t GROUP BY ALL), f AS (SELECT * FROM h JOIN o USING (token)) "
)


def _odd(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = reviews(spark, sf_dir)
    nonstandard = spark.createDataFrame(_ODD, "token string, kind string, suggestion string, norm string")
    return rows, nonstandard, lexical.suspect_rows(rows, nonstandard)


@query(_ODD_SQL + "SELECT doc_id AS row, doc_id + 2 AS source_row, string_agg(token, ', ' ORDER BY pos) AS tokens, string_agg(detail, '; ' ORDER BY pos) AS detail FROM f GROUP BY doc_id")
def list_nonstandard(spark, sf_dir):
    rows, nonstandard, _ = _odd(spark, sf_dir)
    return plain(lexical.list_nonstandard(rows, nonstandard), row=ROW, source_row=SOURCE_ROW, tokens=lexical.SUSPECT_TOKENS, detail=lexical.TOKEN_DETAIL)


@query(_ODD_SQL + "SELECT doc_id AS row, string_agg(CASE token WHEN 'worthless' THEN 'worthless -> poor [a] (1/1: luật=poor)' WHEN 'und' THEN 'und -> u [b] (1/1: ViLexNorm=u)' ELSE 'the [b]' END, ' | ' ORDER BY pos) AS detail FROM f GROUP BY doc_id")
def annotated_suggestions(spark, sf_dir):
    return plain(lexical.annotate_suggestions(_odd(spark, sf_dir)[2], Lexicon()), row=ROW, detail=lexical.TOKEN_DETAIL)


@query(
    _ODD_SQL + "SELECT token, any_value(kind) AS kind, any_value(best) AS consensus, any_value(votes)::INT AS votes, sum(n)::BIGINT AS occurrences, count(*) AS rows, (SELECT string_agg(l, ', ' ORDER BY l) FROM (SELECT DISTINCT lang AS l FROM f g WHERE g.token = f.token)) AS products FROM f GROUP BY token"
)
def frequency_table(spark, sf_dir):
    rows, _, suspects = _odd(spark, sf_dir)
    stats = lexical.TokenStats(lexical.token_counts(rows), {}, {})
    table = lexical.frequency_table(suspects, stats, Lexicon())
    return table.select("token", "kind", "consensus", F.col("votes").cast("int").alias("votes"), "occurrences", "rows", "products")


@query(_ODD_SQL + "SELECT kind, count(DISTINCT token) AS tokens, count(*)::BIGINT AS rows FROM f GROUP BY kind")
def kind_summary(spark, sf_dir):
    rows, _, suspects = _odd(spark, sf_dir)
    return lexical.kind_summary(lexical.frequency_table(suspects, lexical.TokenStats(lexical.token_counts(rows), {}, {}), Lexicon()))


@query("SELECT doc_id AS row, source, lang AS product FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, text ORDER BY doc_id) AS k FROM documents) WHERE k > 1")
def removed_rows(spark, sf_dir):
    rows = reviews(spark, sf_dir)
    return plain(coarse.removed_rows(rows, coarse.drop_exact_duplicates(rows), PRODUCT, ROW), row=ROW, source=AUTHOR, product=PRODUCT)


@query(r"SELECT DISTINCT text AS before, regexp_replace(regexp_replace(text, '(^|[^\p{L}\p{N}])worthless($|[^\p{L}\p{N}])', '\1useless\2', 'g'), '(^|[^\p{L}\p{N}])Worthless($|[^\p{L}\p{N}])', '\1Useless\2', 'g') AS after FROM documents")
def model_outputs(spark, sf_dir):
    """Each distinct text once through a model, in batches."""
    texts = reviews(spark, sf_dir).select(F.col(CONTENT).alias("in"))
    return plain(context_models.run_model(texts, lambda: context_models.DictionaryModel({"worthless": "useless"})), before="in", after="out")


@query(
    r"WITH w AS (SELECT doc_id, regexp_extract_all(text, '[^\s\x0b\x{85}\p{Z}]+') AS w FROM documents), e AS (SELECT doc_id, len(w) AS n, unnest(w) AS x, unnest(range(len(w))) AS k FROM w), "
    r"h AS (SELECT * FROM e WHERE regexp_matches(lower(x), '(^|[^\p{L}\p{N}])worthless($|[^\p{L}\p{N}])')), "
    "c AS (SELECT DISTINCT doc_id, unnest(range(greatest(k - 5, 0), least(k + 6, n))) AS k FROM h), "
    "r AS (SELECT *, k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS g FROM c) "
    "SELECT doc_id AS row, count(DISTINCT g) AS windows, count(*) AS words FROM r GROUP BY doc_id"
)
def model_windows(spark, sf_dir):
    suspects = _odd(spark, sf_dir)[2]
    found = context_models.windows(suspects, F.filter("tokens", lambda t: t["token"] == "worthless"))
    words = F.aggregate("windows", F.lit(0).cast("long"), lambda n, w: n + X.word_count(w))
    return found.select(F.col(ROW).alias("row"), F.size("windows").cast("long").alias("windows"), words.alias("words"))


@query()
def near_duplicates_by_author(spark, sf_dir):
    """Over all products at once, by author, as the product rule does within one."""
    marked = neardup.mark_similar(reviews(spark, sf_dir), CONTENT, AUTHOR)
    return plain(marked.where("__similar"), row=ROW, product=PRODUCT)


@query()
def near_duplicates_across_products(spark, sf_dir):
    """Products are dealt by id, as texts of different languages do not resemble each other."""
    rows = reviews(spark, sf_dir).withColumns({PRODUCT: F.concat(F.lit("p"), F.col(ROW) % 3), PRODUCT_ORD: (F.col(ROW) % 3).cast("int")})
    return plain(neardup.split_cross_file_near_duplicates(normalize.add_text_norm(rows)).suspect, row=ROW, product=PRODUCT)


@query(
    "WITH t AS (SELECT lower(" + _trim("text") + ") AS txt, min(source) AS g0, max(source) AS g1, min(doc_id) AS id FROM documents GROUP BY 1), s AS (SELECT *, length(txt) AS n FROM t WHERE txt <> '') "
    "SELECT a.id AS a_row, b.id AS b_row FROM s a JOIN s b ON (a.n, a.id) < (b.n, b.id) AND b.n <= a.n * (2 / 0.9 - 1) AND (a.g0 <> b.g0 OR a.g1 <> b.g1 OR a.g0 <> a.g1) "
)
def near_duplicate_length_band(spark, sf_dir):
    """Candidate pairs under the length bound alone: the join without its histogram."""
    rows = reviews(spark, sf_dir).withColumn(PRODUCT_ORD, F.lit(0))
    pairs = neardup.length_band(neardup.keys_of(rows, CONTENT, AUTHOR), 0.9, F.col(f"place.{ROW}"))
    return plain(pairs, a_row="a", b_row="b")


@query(
    f"WITH s AS (SELECT *, {_words('text')} BETWEEN 1 AND 20 AS short FROM documents) SELECT lang AS product, doc_id AS row, CASE WHEN short THEN 'ok ' || text ELSE text END AS content FROM s WHERE NOT short OR doc_id % 2 = 0"
)
def merge_checked_rows_back(spark, sf_dir):
    kept, suspect = coarse.split_short(reviews(spark, sf_dir), most_words=20)
    checked = suspect.where(F.col(ROW) % 2 == 0).select(F.col(PRODUCT).alias(PRODUCT_NAME), (F.col(ROW) + 2).alias(SOURCE_ROW), AUTHOR, F.concat(F.lit("ok "), F.col(CONTENT)).alias(CONTENT))
    return plain(merge_checked_rows(kept, suspect, checked, LANGUAGES), product=PRODUCT, row=ROW, content=CONTENT)


@query(f"WITH s AS (SELECT *, {_words('text')} BETWEEN 1 AND 20 AS short FROM documents) SELECT doc_id AS row, CASE WHEN short AND doc_id % 2 = 0 THEN 'reviewed' ELSE text END AS content FROM s")
def spelling_review(spark, sf_dir):
    kept, suspect = coarse.split_short(reviews(spark, sf_dir), most_words=20)
    checked = suspect.select(F.col(PRODUCT).alias(PRODUCT_NAME), (F.col(ROW) + 2).alias(SOURCE_ROW), F.when(F.col(ROW) % 2 == 0, "reviewed").otherwise(" ").alias(CORRECTED))
    return plain(apply_spelling_review(kept, suspect, checked, LANGUAGES), row=ROW, content=CONTENT)


@query(
    "SELECT lang AS product, doc_id AS row, CASE WHEN doc_id % 5 = 0 THEN 'removed' ELSE 'changed' END AS status, CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'Nội dung tự do' END AS columns FROM documents WHERE doc_id % 5 = 0 OR doc_id % 7 = 0 "
    "UNION ALL SELECT lang, -1 - doc_id, 'added', '' FROM documents WHERE doc_id % 5 = 0"
)
def row_diff(spark, sf_dir):
    before = reviews(spark, sf_dir)
    after = before.withColumns({ROW: F.when(F.col(ROW) % 5 == 0, -1 - F.col(ROW)).otherwise(F.col(ROW)), CONTENT: F.when(F.col(ROW) % 7 == 0, F.concat(F.col(CONTENT), F.lit("!"))).otherwise(F.col(CONTENT))})
    return diff_rows(before, after).select(F.col(PRODUCT).alias("product"), F.col(ROW).alias("row"), "status", F.array_join("columns", ",").alias("columns"))


@query("SELECT doc_id AS row, text AS before, replace(text, 'the', 'THE') AS after FROM documents WHERE text LIKE '%the%'")
def changed_rows(spark, sf_dir):
    rows = reviews(spark, sf_dir).withColumn("new", F.replace(F.col(CONTENT), F.lit("the"), F.lit("THE")))
    return plain(normalize.changed_rows(rows, CONTENT, "new"), row=ROW, before=CONTENT, after="Nội dung đã làm sạch")


@query(rf"SELECT doc_id AS row, {_trim(r"regexp_replace(replace(text, '|', '\|'), '[\s\x0b\x{85}\p{Z}]+', ' ', 'g')")} AS cell FROM documents".replace("{{", "{").replace("}}", "}"))
def markdown_cells(spark, sf_dir):
    return reviews(spark, sf_dir).select(F.col(ROW).alias("row"), X.markdown_cell(F.col(CONTENT)).alias("cell"))


@query(f"SELECT doc_id AS row, translate(text, '{X._MARKED + X._MARKED.upper()}', '{X._BASE + X._BASE.upper()}') AS plain, regexp_matches(lower(text), '[aeiouy{X.ACCENTED.replace('đ', '')}]') AS vowel, {_words('text')}::INT AS words FROM documents")
def scalar_functions(spark, sf_dir):
    c = F.col(CONTENT)
    return reviews(spark, sf_dir).select(F.col(ROW).alias("row"), X.strip_accents(c).alias("plain"), X.has_vowel(c).alias("vowel"), X.word_count(c).alias("words"))


@query(
    r"WITH p AS (SELECT doc_id, [{'c': [x], 'w': len(regexp_extract_all(x, '[^\s\x0b\x{85}\p{Z}]+'))} for x in regexp_extract_all(text, '(?s).*?(?:[.!?][\s\x0b\x{85}\p{Z}]+|\n+)|(?s).+')] AS l FROM documents) "
    "SELECT doc_id AS row, array_to_string(CASE WHEN len(l) = 0 THEN [] ELSE list_reduce(l, lambda x, y: CASE WHEN x.w + y.w <= 50 THEN {'c': list_append(x.c[:-2], x.c[-1] || y.c[1]), 'w': x.w + y.w} ELSE {'c': list_concat(x.c, y.c), 'w': y.w} END).c END, chr(31)) AS chunks FROM p"
)
def split_chunks(spark, sf_dir):
    return reviews(spark, sf_dir).select(F.col(ROW).alias("row"), F.array_join(batched.split_chunks(F.col(CONTENT)), "\x1f").alias("chunks"))


@query("SELECT 'Size' AS criterion, source AS value, lang AS product, count(*) AS n FROM documents GROUP BY ALL")
def criteria_value_counts(spark, sf_dir):
    rows = reviews(spark, sf_dir).withColumn("Size", F.col(AUTHOR))
    return lexical.criteria_values(rows).select("criterion", "value", F.col(PRODUCT).alias("product"), "n")


_SQUEEZED = r"nullif(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '\r\n?', chr(10), 'g'), '[ \t\x0b\f\x{{85}}\p{{Z}}]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'), '\n{{2,}}', chr(10), 'g'), chr(10) || ' '), '')"


@query(f"SELECT doc_id AS row, CASE WHEN doc_id % 9 <> 0 THEN {_SQUEEZED.format('text')} END AS content, CASE WHEN doc_id % 9 <> 0 THEN lower({_SQUEEZED.format('text')}) END AS text_norm FROM documents")
def final_check(spark, sf_dir):
    silent = (F.col(ROW) % 9 == 0) | X.blank(F.col(CONTENT))  # the check refuses rows that say nothing at all
    rows = reviews(spark, sf_dir).withColumns({CONTENT: F.when(F.col(ROW) % 9 != 0, F.concat(F.lit(" \n"), F.col(CONTENT))), CRITERIA: F.when(silent, "a: b")})
    return plain(coarse.final_check(rows, rows.count()), row=ROW, content=CONTENT, text_norm=TEXT_NORM)
