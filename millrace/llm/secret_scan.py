"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Each historical version of a path is addressed by the SHA-256 of its content (a
*blob*). A ledger keeps which (blob, rule, rule version) has been scanned, and what was
found. A scan takes only pairs that the ledger lacks, so equal contents are read
once, and a new rule version re-reads old blobs for that rule alone. Findings are joined
back to all paths and versions that hold the blob.

A rule is a regular expression with the least length of a match, or of its value
group; matches are leftmost and non-overlapping for each rule, and those that are
too short are dropped afterwards. Spans are in code points, end exclusive. Offsets
follow from cutting a text at the matches: pieces and matches alternate.

Defined results. Null content is the empty text, without findings. Repeated rows and
copies share a blob and all get its findings. An empty table gives an empty result.
Other columns pass through ``join_back`` untouched, but for one named ``findings``, which is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .runtime import fresh, shared_path


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int
    group: int = 0  # the group whose length counts
    version: int = 1


#: Base rules, in the order in which kinds sort at one start, then the added ones. Fixed values.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]{32,}", 32),
)
ADDED_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 27),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 15),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}", 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 24),
)
RULES = BASE_RULES + ADDED_RULES
FINDING = "array<struct<kind:string,start:long,end:long>>"


def _matches(text: Column, rule: Rule) -> Column:
    """The rule's findings in a text as an array of (kind, start, end)."""
    pattern = F.lit(rule.pattern)
    pieces = F.transform(F.split(text, rule.pattern, -1), lambda x: F.length(x).cast("long"))
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda x: F.length(x).cast("long"))
    value = whole if rule.group == 0 else F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda x: F.length(x).cast("long"))
    steps = F.zip_with(F.slice(pieces, 1, F.size(whole)), F.arrays_zip(whole.alias("whole"), value.alias("value")), lambda p, m: F.struct(p.alias("gap"), m["whole"].alias("whole"), m["value"].alias("value")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(FINDING).alias("found"))

    def step(state: Column, m: Column) -> Column:
        begin = state["at"] + m["gap"]
        end = begin + m["whole"]
        one = F.array(F.struct(F.lit(rule.kind).alias("kind"), begin.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(m["value"] >= rule.least, F.concat(state["found"], one)).otherwise(state["found"]).alias("found"))

    found = F.aggregate(steps, start, step, lambda s: s["found"])
    return F.when(F.regexp_like(text, pattern), found).otherwise(F.array().cast(FINDING))


_LEDGER = f"blob string, rule string, version int, found {FINDING}"


def _blob(content: str) -> Column:
    """The address of the content."""
    return F.sha2(F.coalesce(F.col(f"`{content}`"), F.lit("")).cast("binary"), 256)


def empty_ledger(versions: DataFrame) -> DataFrame:
    return versions.sparkSession.createDataFrame([], _LEDGER)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at a path in a shared file system; without one, an empty ledger."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    return spark.read.schema(_LEDGER).parquet(path) if there else spark.createDataFrame([], _LEDGER)


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, content: str = "text") -> DataFrame:
    """Ledger entries (blob, rule, version, found) of the (blob, rule version) pairs that the ledger lacks.

    Append the result to the ledger; ``found`` is empty for a clean pair, so that it
    is not scanned again.
    """
    once = versions.select(_blob(content).alias("blob"), F.coalesce(F.col(f"`{content}`"), F.lit("")).alias("__text")).dropDuplicates(["blob"])
    wanted = F.array(*(F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version")) for r in rules))
    if ledger is None:
        todo = once.withColumn("__todo", wanted)
    else:
        seen = ledger.groupBy("blob").agg(F.collect_set(F.struct("rule", "version")).alias("__seen"))
        todo = once.join(seen, "blob", "left").withColumn("__todo", F.array_except(wanted, F.coalesce("__seen", F.array().cast("array<struct<rule:string,version:int>>"))))
        todo = todo.where(F.size("__todo") > 0)
    entries = F.array(
        *(
            F.struct(
                F.lit(r.kind).alias("rule"),
                F.lit(r.version).alias("version"),
                F.when(F.array_contains("__todo", F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"))), _matches(F.col("__text"), r)).alias("found"),
            )
            for r in rules
        )
    )
    return todo.select("blob", F.explode(F.filter(entries, lambda e: e["found"].isNotNull())).alias("e")).select("blob", "e.*")


def join_back(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, content: str = "text") -> DataFrame:
    """All versions with ``findings``: spans of the given rule versions, by start, then rule order. A column of that name is replaced."""
    order = F.create_map(*(x for k, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(k))))
    current = F.create_map(*(x for r in rules for x in (F.lit(r.kind), F.lit(r.version))))
    found = ledger.where((F.size("found") > 0) & (current[F.col("rule")] == F.col("version")))
    sortable = F.transform("found", lambda f: F.struct(f["start"].alias("start"), order[f["kind"]].alias("rank"), f["end"].alias("end"), f["kind"].alias("kind")))
    key, spans = (fresh(x, versions.columns) for x in ("blob_address", "blob_spans"))
    per_blob = found.groupBy(F.col("blob").alias(key)).agg(F.sort_array(F.flatten(F.collect_list(sortable))).alias(spans))
    joined = versions.withColumn(key, _blob(content)).join(per_blob, key, "left")
    plain = F.transform(spans, lambda f: F.struct(f["kind"].alias("kind"), f["start"].alias("start"), f["end"].alias("end")))
    return joined.withColumn("findings", F.coalesce(plain, F.array().cast(FINDING))).drop(key, spans)


def digest(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")


def update(versions: DataFrame, path: str, rules: tuple[Rule, ...] = RULES, content: str = "text") -> DataFrame:
    """Scans what the ledger at ``path`` lacks, appends the entries, clean pairs included, and gives the whole ledger."""
    spark = versions.sparkSession
    scan(versions, read_ledger(spark, path), rules, content).write.mode("append").option("compression", "zstd").parquet(path)
    return read_ledger(spark, path)


def scan_all(versions: DataFrame, rules: tuple[Rule, ...] = RULES, content: str = "text", path: str | None = None) -> DataFrame:
    """Brings the ledger at ``path`` up to date and joins its findings back to every version; without a path, a new ledger in the checkpoint folder."""
    slim = versions.select("doc_id", content)
    path = path or shared_path(versions.sparkSession, "ledger-")
    return join_back(slim, update(slim, path, rules, content), rules, content)
