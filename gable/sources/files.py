"""Readers and writers at the edges (inventory A1-A12, A16).

CSV is read without schema inference (inference is an extra full pass over
the file and types drift between runs); callers pass a schema or coerce the
columns they need with ``try_cast``-based helpers. Stage outputs are
Parquet.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gable.functions import text
from gable.plans import presets as P


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, sep: str = ",",
             order_col: str | None = None) -> DataFrame:
    """Header CSV, quoted fields, BOM stripped by the reader. With
    ``order_col`` a monotonically increasing id keeps file order (the
    first-occurrence rule of keep-first dedups needs it)."""
    reader = spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"') \
        .option("multiLine", False).option("encoding", "UTF-8")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    if order_col:
        df = df.withColumn(order_col, F.monotonically_increasing_id())
    return df


def coerce_numeric(df: DataFrame, cols) -> DataFrame:
    """String columns among ``cols`` -> double (malformed -> NULL)."""
    types = dict(df.dtypes)
    live = {c: text.to_number(c) for c in cols if types.get(c) == "string"}
    return df.withColumns(live) if live else df


def read_listings(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A1: the raw listings CSV; numeric raw columns coerced to double."""
    return coerce_numeric(read_csv(spark, path, schema), P.RAW_NUMERIC_COLS)


def read_income(spark: SparkSession, path: str) -> DataFrame:
    """A2: income per municipality (two name variants), value as double.
    The unnamed third header column arrives as ``_c2``."""
    df = read_csv(spark, path, order_col="__file_order")
    return df.withColumn("median_income", text.to_number("median_income"))


def read_geo(spark: SparkSession, path: str) -> DataFrame:
    """A3: the 7 geography columns, distinct."""
    df = read_csv(spark, path).select(*P.GEO_COLUMNS_KEPT).distinct()
    return df.withColumn("CD_REFNIS", F.col("CD_REFNIS").cast("string"))


def read_postal(spark: SparkSession, path: str) -> DataFrame:
    """A4: ';'-separated postal -> municipality code pairs, distinct, key as
    canonical integer string."""
    df = read_csv(spark, path, sep=";")
    df = df.select(*[F.col(f"`{old}`").alias(new) for old, new in P.POSTAL_RENAMES.items()]).distinct()
    return df.withColumns({"postal_code": text.int_key_string("postal_code"),
                           "municipality_code": F.col("municipality_code").cast("string")})


def read_address(spark: SparkSession, path: str) -> DataFrame:
    """A5: addresses by listing id, ``url`` dropped when present."""
    return read_csv(spark, path).drop("url")


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: list[str] | None = None) -> None:
    """Write a stage output or a result table."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", infer: bool = False) -> DataFrame:
    """Re-scan a written stage. Parquet keeps its stored schema (no
    re-inference, so ``postal_code`` keeps its type between stages); CSV is
    read with its header, as text unless ``infer`` asks for the extra
    inference pass the source relied on."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", infer)
    return reader.load(path)


def stage_audit(stages: Mapping[str, DataFrame]) -> DataFrame:
    """(stage, n_rows, n_cols) for each named stage, as one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("stage"), "n_rows", F.lit(len(df.columns)).alias("n_cols")) for name, df in stages.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
