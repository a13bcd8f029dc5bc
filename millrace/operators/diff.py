"""Row differences of two tables by key, nulls equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import PRODUCT, ROW


def diff_rows(before: DataFrame, after: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """keys, status (added, removed, changed) and the names of changed common columns; equal rows are left out."""
    keys = keys or [PRODUCT, ROW]
    common = [c for c in before.columns if c in after.columns and c not in keys]
    old = before.select(*keys, F.struct(*(f"`{c}`" for c in common), F.lit(1).alias("__x")).alias("o"))
    new = after.select(*keys, F.struct(*(f"`{c}`" for c in common), F.lit(1).alias("__x")).alias("n"))
    changed = F.array_compact(F.array(*(F.when(~F.col("o").getField(c).eqNullSafe(F.col("n").getField(c)), F.lit(c)) for c in common)).cast("array<string>"))
    status = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").when(F.size(changed) > 0, "changed")
    columns = F.when(F.col("o").isNotNull() & F.col("n").isNotNull(), changed).otherwise(F.array().cast("array<string>"))
    return old.join(new, keys, "full").select(*keys, status.alias("status"), columns.alias("columns")).where("status IS NOT NULL")


def column_changes(before: DataFrame, after: DataFrame) -> tuple[list[str], list[str]]:
    """Added and removed columns."""
    return [c for c in after.columns if c not in before.columns], [c for c in before.columns if c not in after.columns]


def compact(numbers: list[int]) -> str:
    """``1-3, 7`` for [1, 2, 3, 7]."""
    runs: list[list[int]] = []
    for n in sorted(numbers):
        if runs and n == runs[-1][1] + 1:
            runs[-1][1] = n
        else:
            runs.append([n, n])
    return ", ".join(str(a) if a == b else f"{a}-{b}" for a, b in runs)


def print_diff(label: str, before: DataFrame, after: DataFrame, *, keys: list[str] | None = None, offset: int = 2, most: int = 20, say: Callable[[str], None] = print) -> dict[str, int]:
    """Prints counts, columns and at most ``most`` rows of each kind; returns the counts. Only these rows come to the driver."""
    changes = diff_rows(before, after, keys).cache()
    counts = {r.status: r.n for r in changes.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}
    added, removed = column_changes(before, after)
    say(f"[{label}] " + ", ".join(f"{counts.get(k, 0)} {k}" for k in ("added", "removed", "changed")))
    if added or removed:
        say(f"  columns: +{added} -{removed}")
    for kind in ("added", "removed", "changed"):
        rows = changes.where(F.col("status") == kind).orderBy(*(keys or [PRODUCT, ROW])).limit(most).collect()
        if rows:
            key = (keys or [PRODUCT, ROW])[-1]
            say(f"  {kind}: rows {compact([r[key] + offset for r in rows])}" + (f" of {counts[kind]}" if counts[kind] > most else ""))
    changes.unpersist()
    return counts
