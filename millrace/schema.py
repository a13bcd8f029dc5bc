"""Columns of the review tables and the rules that every operator shares.

One DataFrame holds the reviews of all products. ``product`` and ``product_ord`` say
which table a row comes from and in which order the tables come, ``_row`` is the row's
position in its table, from 0. These three are the only source of order. *Blank* is null
or white space; a missing column counts as blank on every row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRODUCT, PRODUCT_ORD, ROW = "product", "product_ord", "_row"

# Column names of the raw tables and of the stages' results.
AUTHOR = "Tác giả"
POSTED = "Thời gian"
VARIANT = "Loại hàng (phân loại)"
CRITERIA = "Tiêu chí đánh giá"
CONTENT = "Nội dung tự do"
STARS = "Số sao"
URL = "URL sản phẩm"
CRAWLED = "Thời điểm cào"
REVIEW_ID, REVIEW_RAW = "review_id", "review_raw"
MOVED = "Tiêu chí chuyển sang tự do"
TEXT_NORM = "text_norm"
EMOJIS, EMOJI_SENTIMENT = "emojis", "emoji_sentiment"
CLEANED = "Nội dung đã làm sạch"
CORRECTED, CORRECTION_DETAIL = "Nội dung sau xử lý", "Chi tiết sửa"
SOURCE_ROW, SUSPECT_TOKENS, TOKEN_DETAIL = "Dòng Excel gốc", "Token nghi vấn", "Chi tiết token"
NORMALISED, REPLACED = "Nội dung chuẩn hoá", "Token đã thay"
NORMALISED_SUFFIX = " (chuẩn hoá)"
CRITERION_SUFFIX = " (tiêu chí)"
SOURCE_FILE, INPUT_ROW = "Nguồn file", "Dòng Excel đầu vào"
PRODUCT_NAME = "Sản phẩm"
ANONYMOUS = "ẩn danh"

RAW_SCHEMA = T.StructType(
    [
        T.StructField(AUTHOR, T.StringType()),
        T.StructField(POSTED, T.StringType()),
        T.StructField(VARIANT, T.StringType()),
        T.StructField(CRITERIA, T.StringType()),
        T.StructField(CONTENT, T.StringType()),
        T.StructField(STARS, T.DoubleType()),
        T.StructField(URL, T.StringType()),
        T.StructField(CRAWLED, T.StringType()),
    ]
)
RAW_COLUMNS = RAW_SCHEMA.fieldNames()
BOOKKEEPING = (PRODUCT, PRODUCT_ORD, ROW)


def column_or_null(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def place_after(df: DataFrame, anchor: str, **new: Column) -> DataFrame:
    """df with the new columns right after ``anchor``; columns of those names are replaced."""
    out = []
    for c in df.columns:
        if c not in new:
            out.append(F.col(f"`{c}`"))
        if c == anchor:
            out += [e.alias(n) for n, e in new.items()]
    return df.select(*out)


def text_columns(df: DataFrame, content: str = CONTENT) -> list[str]:
    """The columns that hold review text: the content, the criteria and any column of no other role."""
    other = {*RAW_COLUMNS, REVIEW_ID, REVIEW_RAW, MOVED, TEXT_NORM, *BOOKKEEPING} - {content, CRITERIA}
    return [c for c in df.columns if c == content or c not in other]


def criteria_columns(df: DataFrame, content: str = CONTENT) -> list[str]:
    """The criterion columns that have been split off."""
    return [c for c in text_columns(df, content) if c not in (content, CRITERIA, EMOJIS, EMOJI_SENTIMENT)]
