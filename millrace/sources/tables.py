"""Sources and sinks: review tables, checkpoints, reviewed rows, model caches, reports."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions.text import markdown_cell
from ..operators.structure import with_position
from ..schema import PRODUCT, PRODUCT_NAME, PRODUCT_ORD, RAW_SCHEMA, ROW, SOURCE_ROW


@dataclass
class Products:
    """Product names in their order, and where their tables are."""

    root: str
    files: dict[str, str] = field(default_factory=dict)

    def path(self, product: str) -> str:
        if product not in self.files:
            raise KeyError(f"unknown product {product!r}; there are {', '.join(self.files)}")
        return f"{self.root}/{self.files[product]}"

    def names(self) -> list[str]:
        return list(self.files)


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """One product's raw table from CSV (header, quoted newlines), Parquet, ORC or JSON, by its ending."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind == "csv":
        return spark.read.schema(RAW_SCHEMA).csv(path, header=True, multiLine=True, quote='"', escape='"', enforceSchema=False)
    if kind == "json":
        return spark.read.schema(RAW_SCHEMA).json(path, multiLine=False)
    if kind in ("xlsx", "xls"):
        return read_spreadsheet(spark, path)
    return spark.read.format("orc" if kind == "orc" else "parquet").load(path)


def read_spreadsheet(spark: SparkSession, path: str) -> DataFrame:
    """First sheet of a workbook, where a reader for them is installed; one file of bounded size."""
    import pandas as pd

    try:
        sheet = pd.read_excel(path)
    except ImportError as e:
        raise RuntimeError("workbooks need openpyxl, which is not installed; save the sheet as CSV") from e
    for c in sheet.columns:
        if c not in RAW_SCHEMA.fieldNames() or RAW_SCHEMA[c].dataType == T.StringType():
            sheet[c] = sheet[c].astype("string")
    return spark.createDataFrame(sheet)


def read_products(spark: SparkSession, products: Products, order: list[str] | None = None) -> DataFrame:
    """All products as one table with bookkeeping columns; rows keep their place by ``order`` or as the file has them."""
    out = None
    for k, name in enumerate(products.names()):
        df = read_reviews(spark, products.path(name))
        if ROW not in df.columns:
            df = with_position(df, name, k, *(order or []))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """A pipe table; ``\\|`` stands for a bar in a cell, empty cells are null."""
    lines = spark.read.text(path).where(F.col("value").startswith("|")).withColumn("__at", F.monotonically_increasing_id())
    header = [c.strip() for c in re.split(r"(?<!\\)\|", lines.orderBy("__at").first()[0].strip())[1:-1]]
    body = lines.where(F.col("__at") > 0).where(~F.regexp_like("value", F.lit(r"^\|(?: ?-{3,} ?\|)+\s*$")))
    cells = F.split(F.regexp_extract(F.trim("value"), r"^\|(.*)\|$", 1), r"(?<!\\)\|", -1)
    pick = [F.nullif(F.trim(F.replace(F.get(cells, F.lit(k)), F.lit("\\|"), F.lit("|"))), F.lit("")).alias(c) for k, c in enumerate(header)]
    return body.select(*pick, F.col("__at").alias(ROW))


def write_markdown(df: DataFrame, path: str, *order: str) -> None:
    """A pipe table in one file: meant for reports of bounded size."""
    names = [c for c in df.columns if c not in order or c not in (PRODUCT_ORD, ROW)]
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *(markdown_cell(F.col(f"`{c}`")) for c in names)), F.lit(" |"))
    head = [(k, "| " + " | ".join(cells) + " |") for k, cells in enumerate((names, ["---"] * len(names)))]
    place = F.struct(*(f"`{c}`" for c in order)) if order else F.struct(F.monotonically_increasing_id().alias("at"))
    lines = df.select(F.lit(len(head)).alias("part"), row.alias("value"), place.alias("place"))
    first = df.sparkSession.createDataFrame(head, "part int, value string")
    whole = first.unionByName(lines, allowMissingColumns=True).repartition(1).sortWithinPartitions("part", "place")
    whole.select("value").write.mode("overwrite").text(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def checkpoint_path(root: str, version: str, step: str) -> str:
    return f"{root}/{version}/{step}"


def write_checkpoint(df: DataFrame, root: str, version: str, step: str) -> DataFrame:
    """Writes a step's rows by product and reads them back; a rerun replaces its own output only."""
    path = checkpoint_path(root, version, step)
    df.write.mode("overwrite").partitionBy(PRODUCT).parquet(path)
    return read_checkpoint(df.sparkSession, root, version, step)


def read_checkpoint(spark: SparkSession, root: str, version: str, step: str) -> DataFrame | None:
    """A step's rows, or None with a message if it has not run; a product without rows is just absent."""
    try:
        return spark.read.parquet(checkpoint_path(root, version, step))
    except AnalysisException:
        print(f"no checkpoint {version}/{step}")
        return None


def write_suspects(df: DataFrame, root: str, step: str) -> None:
    """Rows set aside, and reports, as Parquet (by product where they have one) and as CSV for people."""
    out = df.write.mode("overwrite")
    (out.partitionBy(PRODUCT) if PRODUCT in df.columns else out).parquet(f"{root}/suspect/{step}")
    plain = df.select(*(F.to_json(f"`{c}`").alias(c) if kind.startswith(("array", "map", "struct")) else F.col(f"`{c}`") for c, kind in df.dtypes))
    without_zone(plain).write.mode("overwrite").csv(f"{root}/suspect_csv/{step}", header=True, quoteAll=True, escape='"')


def without_zone(df: DataFrame) -> DataFrame:
    """Zoned times as plain ones, for sheets that cannot hold zones (the session zone is UTC)."""
    return df.withColumns({f.name: F.col(f"`{f.name}`").cast("timestamp_ntz") for f in df.schema.fields if f.dataType == T.TimestampType()})


def read_checked(spark: SparkSession, path: str, products: list[str]) -> DataFrame:
    """A reviewed table; raises if a product is unknown or the key columns are missing."""
    df = read_reviews(spark, path) if not path.endswith(".csv") else spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')
    if missing := {PRODUCT_NAME, SOURCE_ROW} - set(df.columns):
        raise ValueError(f"{path} lacks {sorted(missing)}")
    unknown = df.select(PRODUCT_NAME).distinct().where(~F.col(f"`{PRODUCT_NAME}`").isin(products)).limit(5).collect()
    if unknown:
        raise ValueError(f"{path} names unknown products {[r[0] for r in unknown]}")
    return df


def read_model_cache(spark: SparkSession, path: str) -> DataFrame:
    """(in, out) of earlier model runs; later lines win."""
    lines = spark.read.schema("`in` string, `out` string").json(path).withColumn("__at", F.monotonically_increasing_id())
    return lines.groupBy("in").agg(F.max_by("out", "__at").alias("out"))
