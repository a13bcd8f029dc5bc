"""Human review: approved rows come back by key, and corrected texts replace their originals."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import none_if_blank
from ..schema import CONTENT, CORRECTED, PRODUCT, PRODUCT_NAME, PRODUCT_ORD, ROW, SOURCE_ROW

_log = logging.getLogger(__name__)


def _validated(suspect: DataFrame, checked: DataFrame, products: list[str], label: str) -> DataFrame:
    """The checked rows with product and row keys; raises on unknown products, repeated keys and rows never set aside."""
    keyed = checked.withColumns({PRODUCT: F.col(f"`{PRODUCT_NAME}`"), ROW: F.col(f"`{SOURCE_ROW}`").cast("long") - 2})
    # keys only, in one job: what is wrong with each, the gravest first
    keys = keyed.groupBy(PRODUCT, ROW).agg(F.count(F.lit(1)).alias("n")).join(suspect.select(PRODUCT, ROW, F.lit(True).alias("aside")), [PRODUCT, ROW], "left")
    fault = F.when(~F.coalesce(F.col(PRODUCT).isin(products), F.lit(False)), 0).when(F.col("n") > 1, 1).when(F.col("aside").isNull(), 2)
    wrong = keys.select(fault.alias("fault"), PRODUCT, ROW).where("fault IS NOT NULL").orderBy("fault", PRODUCT, ROW).limit(5).collect()
    if wrong:
        what = ("unknown products", "rows checked more than once:", "rows that were not set aside:")[wrong[0].fault]
        raise ValueError(f"{label}: {what} {[tuple(r)[1:] for r in wrong if r.fault == wrong[0].fault]}")
    return keyed.drop(PRODUCT_NAME, SOURCE_ROW)


def merge_checked_rows(kept: DataFrame, suspect: DataFrame, checked: DataFrame | None, products: list[str], label: str = "review") -> DataFrame:
    """Kept and approved rows; a suspect row that the reviewer has left out is rejected. Without a review the result is provisional."""
    if checked is None:
        _log.warning("%s: no checked file; the result leaves out all rows set aside", label)
        return kept
    approved = _validated(suspect, checked, products, label)
    ordinals = suspect.select(PRODUCT, ROW, PRODUCT_ORD)
    approved = approved.drop(PRODUCT_ORD).join(ordinals, [PRODUCT, ROW])
    return kept.unionByName(approved.select(*(F.col(f"`{c}`") for c in approved.columns if c in kept.columns)), allowMissingColumns=True)


def apply_spelling_review(kept: DataFrame, suspect: DataFrame, checked: DataFrame | None, products: list[str], content: str = CONTENT, label: str = "spelling") -> DataFrame:
    """All rows; the reviewed text replaces the content where it is not blank."""
    names = kept.columns
    if checked is None:
        _log.warning("%s: no checked file; texts stay as they are", label)
        return kept.unionByName(suspect.select(*(f"`{c}`" for c in names)))
    reviewed = _validated(suspect, checked, products, label).select(PRODUCT, ROW, none_if_blank(F.col(f"`{CORRECTED}`")).alias("__text"))
    out = suspect.join(reviewed, [PRODUCT, ROW], "left").withColumn(content, F.coalesce("__text", F.col(f"`{content}`")))
    return kept.unionByName(out.select(*(f"`{c}`" for c in names)))


def in_order(df: DataFrame) -> DataFrame:
    return df.orderBy(PRODUCT_ORD, ROW)
