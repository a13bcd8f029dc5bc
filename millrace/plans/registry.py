"""Step registry, reports and the declarative list of stages."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class StepMeta:
    taxonomy_id: str
    tier: int
    name: str
    description: str = ""
    severity: str = "medium"


@dataclass
class CleaningReport:
    """What one step did to the table."""

    step: str
    rows_before: int = 0
    rows_after: int = 0
    rows_changed: int = 0
    rows_dropped: int = 0
    seconds: float = 0.0
    examples: list[dict] = field(default_factory=list)
    extra: dict = field(default_factory=dict)

    def to_dict(self) -> dict:
        return asdict(self)

    def save(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as f:
            json.dump(self.to_dict(), f, ensure_ascii=False, indent=2)

    def summary_line(self) -> str:
        return f"{self.step}: {self.rows_before} -> {self.rows_after} rows, {self.rows_changed} changed, {self.rows_dropped} dropped, {self.seconds:.1f} s"


class StepRegistry:
    def __init__(self) -> None:
        self._steps: dict[str, tuple[StepMeta, Callable]] = {}

    def register(self, meta: StepMeta, function: Callable) -> None:
        if meta.taxonomy_id in self._steps:
            raise ValueError(f"step {meta.taxonomy_id} is registered already")
        self._steps[meta.taxonomy_id] = (meta, function)

    def step(self, taxonomy_id: str, tier: int, name: str, description: str = "", severity: str = "medium"):
        """Decorator that registers a function from DataFrame to DataFrame or to a split."""

        def note(function: Callable) -> Callable:
            self.register(StepMeta(taxonomy_id, tier, name, description, severity), function)
            return function

        return note

    def get(self, taxonomy_id: str) -> Callable:
        return self._steps[taxonomy_id][1]

    def by_tier(self, tier: int) -> list[StepMeta]:
        return [m for m, _ in self._steps.values() if m.tier == tier]

    def coverage(self, wanted: Iterable[str]) -> dict[str, bool]:
        return {k: k in self._steps for k in wanted}


def reported(step: str, function: Callable[[DataFrame], DataFrame], df: DataFrame, keys: list[str], text: str, examples: int = 3) -> tuple[DataFrame, CleaningReport]:
    """Applies a step and measures it with one aggregate over the full outer join by key."""
    began = time.time()
    out = function(df)
    a = df.select(*keys, F.col(f"`{text}`").alias("__a"), F.lit(1).alias("__in"))
    b = out.select(*keys, F.col(f"`{text}`").alias("__b"), F.lit(1).alias("__out"))
    both = a.join(b, keys, "full")
    changed = F.col("__in").isNotNull() & F.col("__out").isNotNull() & ~F.col("__a").eqNullSafe(F.col("__b"))
    r = both.agg(F.count("__in").alias("n"), F.count("__out").alias("m"), F.count(F.when(changed, 1)).alias("c"), F.count(F.when(F.col("__out").isNull(), 1)).alias("d")).first()
    shown = [x.asDict() for x in both.where(changed).orderBy(*keys).limit(examples).select(*keys, F.col("__a").alias("before"), F.col("__b").alias("after")).collect()]
    return out, CleaningReport(step, r.n, r.m, r.c, r.d, time.time() - began, shown)
