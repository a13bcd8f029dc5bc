"""Repair of table structure: ids, misplaced fields, empty rows, types, criteria blobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank, has_accent, none_if_blank, trim_all, word_count
from ..schema import ANONYMOUS, AUTHOR, BOOKKEEPING, CONTENT, CRAWLED, CRITERIA, CRITERION_SUFFIX, MOVED, POSTED, PRODUCT, PRODUCT_ORD, REVIEW_ID, REVIEW_RAW, ROW, column_or_null

BLOCK_BITS = 10  # 1024 row numbers a block
TIME_FORMAT = "yyyy-MM-dd HH:mm"
CRAWL_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]X"


def with_position(df: DataFrame, product: str, ordinal: int, *order: str) -> DataFrame:
    """Adds the bookkeeping columns to one product's table, rows numbered by ``order``, or as the files have them.

    File order needs no sort: a row's number in its partition is added to the sizes of the
    partitions before, one number each. Numbering by ``order`` sorts in one task.
    """
    names = [F.lit(product).alias(PRODUCT), F.lit(ordinal).alias(PRODUCT_ORD)]
    if order:
        return df.select("*", *names, (F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order)) - 1).cast("long").alias(ROW))
    place = F.monotonically_increasing_id()  # partition number in the upper bits
    sizes = df.select(F.shiftright(place, 33).alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    before, shift = 0, []
    for r in sizes:
        shift += [F.lit(r.part), F.lit(before)]
        before += r.n
    first = F.element_at(F.create_map(*shift), F.shiftright("__at", 33)) if shift else F.lit(0)
    return df.withColumn("__at", place).select(*(f"`{c}`" for c in df.columns), *names, (first + F.col("__at").bitwiseAND((1 << 33) - 1)).cast("long").alias(ROW))


def assign_review_id(df: DataFrame, content: str = CONTENT) -> DataFrame:
    """Puts ``review_id`` (product and 1-based position) and a copy of the content in front."""
    if REVIEW_ID in df.columns:
        raise ValueError(f"the table has a column {REVIEW_ID} already")
    names = [PRODUCT, "__block"]
    blocks = df.select(PRODUCT, ROW).withColumn("__block", _block()).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(PRODUCT).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col(PRODUCT).alias("__p"), F.col("__block").alias("__b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    placed = df.withColumn("__block", _block()).withColumn("__k", F.row_number().over(Window.partitionBy(*names).orderBy(ROW)))
    placed = placed.join(blocks, F.col(PRODUCT).eqNullSafe(F.col("__p")) & F.col("__block").eqNullSafe(F.col("__b")), "left")
    place = F.col("__before") + F.col("__k")
    return placed.select(F.format_string("%s_%05d", F.col(PRODUCT), place).alias(REVIEW_ID), column_or_null(df, content).alias(REVIEW_RAW), *(f"`{c}`" for c in df.columns))


def _block() -> Column:
    """Rows are numbered within blocks of neighbouring keys; blocks, a few bytes each, within their product."""
    return F.shiftright(F.col(ROW), BLOCK_BITS)


def fix_field_misalignment(df: DataFrame, author: str = AUTHOR, content: str = CONTENT, anonymous: str = ANONYMOUS, least_words: int = 2) -> DataFrame:
    """Moves a review that stands in the author's field to the content, before what is there."""
    if not {author, content} <= set(df.columns):
        return df
    said = trim_all(F.col(author))
    is_review = F.coalesce((word_count(said) >= least_words) | has_accent(said), F.lit(False)) & F.col(author).isNotNull()
    moved = F.when(blank(F.col(content)), said).otherwise(F.concat(said, F.lit("\n"), trim_all(F.col(content))))
    return df.withColumns({content: F.when(is_review, moved).otherwise(F.col(content)), author: F.when(is_review, F.lit(anonymous)).otherwise(F.col(author))})


def drop_empty_rows(df: DataFrame, content: str = CONTENT, criteria: str = CRITERIA) -> DataFrame:
    """Blank content and criteria become null; rows without either, or without anything, go."""
    out = df.withColumns({c: none_if_blank(F.col(c)) for c in (content, criteria) if c in df.columns})
    data = [c for c in df.columns if c not in BOOKKEEPING]
    nothing = reduce(lambda a, b: a & b, [blank(F.col(f"`{c}`")) for c in data], F.lit(True))
    return out.where(~(nothing | (blank(column_or_null(out, content)) & blank(column_or_null(out, criteria)))))


validate_required_columns = drop_empty_rows


def fix_data_types(df: DataFrame, posted: str = POSTED, crawled: str = CRAWLED) -> DataFrame:
    """Strict times: local minutes and UTC instants; anything else raises when the plan runs."""
    out = {}
    if posted in df.columns:
        out[posted] = F.to_timestamp_ntz(F.col(posted), F.lit(TIME_FORMAT))
    if crawled in df.columns:
        out[crawled] = F.to_timestamp(F.col(crawled), CRAWL_FORMAT)
    return df.withColumns(out) if out else df


def criteria_pairs(c: Column) -> Column:
    """``key: value`` lines as an array of (k, v); lines without a key are left out, values of a repeated key join by ``; ``."""
    lines = F.filter(F.transform(F.split(c, "\n"), trim_all), lambda x: F.instr(x, ":") > 1)

    def cut(line: Column) -> Column:
        at = F.instr(line, ":")
        return F.struct(trim_all(F.substring(line, F.lit(1), at - 1)).alias("k"), trim_all(F.substring(line, at + 1, F.length(line))).alias("v"))

    pairs = F.filter(F.transform(lines, cut), lambda p: p["k"] != "")
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    joined = F.transform(keys, lambda k: F.struct(k.alias("k"), F.array_join(F.transform(F.filter(pairs, lambda p: p["k"] == k), lambda p: p["v"]), "; ").alias("v")))
    return F.when(blank(c), F.array().cast("array<struct<k:string,v:string>>")).otherwise(joined)


def criteria_keys(df: DataFrame, criteria: str = CRITERIA) -> DataFrame:
    """(k, n, first): each key's number of rows and first place (row, position), by product."""
    parts = df.select(PRODUCT, ROW, F.posexplode(criteria_pairs(F.col(criteria))).alias("pos", "p"))
    return parts.groupBy(PRODUCT, F.col("p.k").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(ROW, "pos")).alias("first"))


def split_merged_fields(df: DataFrame, criteria: str = CRITERIA, content: str = CONTENT, moved: str = MOVED, least_rows: int = 3) -> DataFrame:
    """One column for each key of at least ``least_rows`` rows of a product; rarer keys go to the end of the content.

    The keys, not the rows, come to the driver: they are the new schema. A key that is
    frequent in one product and rare in another is a column for the one and content for the other.
    """
    if criteria not in df.columns:
        return df
    keys = criteria_keys(df, criteria).join(df.groupBy(PRODUCT).agg(F.min(PRODUCT_ORD).alias("ord")), PRODUCT)
    known = keys.withColumn("often", F.col("n") >= least_rows).orderBy("ord", "first").collect()
    frequent: dict[str, list[str]] = {}
    for r in known:
        if r.often:
            frequent.setdefault(r.k, []).append(r[PRODUCT])
    pairs = criteria_pairs(F.col(criteria))
    by_key = F.map_from_entries(pairs)
    out = df.withColumn("__pairs", pairs).withColumn("__map", by_key)
    columns = {}
    for k, products in frequent.items():
        name = k + CRITERION_SUFFIX if k in df.columns else k
        columns[name] = F.when(F.col(PRODUCT).isin(products), F.try_element_at(F.col("__map"), F.lit(k)))
    if any(not r.often for r in known):
        kept = {p: [k for k, ps in frequent.items() if p in ps] for p in {r[PRODUCT] for r in known}}
        table = [x for p, ks in sorted(kept.items()) for x in (F.lit(p), F.array(*map(F.lit, ks)).cast("array<string>"))]
        mine = F.coalesce(F.try_element_at(F.create_map(*table), F.col(PRODUCT)), F.array().cast("array<string>"))
        rare = F.filter("__pairs", lambda p: ~F.array_contains(mine, p["k"]))
        text = F.array_join(F.transform(rare, lambda p: F.concat(p["k"], F.lit(": "), p["v"])), "\n")
        base = column_or_null(df, content)
        joined = F.when(blank(base), text).otherwise(F.concat(trim_all(base), F.lit("\n"), text))
        columns[content] = F.when(F.size(rare) > 0, joined).otherwise(base)
        columns[moved] = F.when(F.size(rare) > 0, F.array_join(F.transform(rare, lambda p: p["k"]), "; "))
    return out.withColumns(columns).drop("__pairs", "__map")


def keys_are_unique(df: DataFrame, key: str = REVIEW_ID) -> bool:
    total, different = df.agg(F.count(F.lit(1)), F.countDistinct(key)).first()
    return total == different


