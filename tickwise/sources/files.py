"""File sources and sinks.

Readers take explicit schemas wherever the layout is known (one pass, no
inference job); writers are distributed DataFrame writes (nothing goes through
the driver).  Paths for intermediate tables come from the session's shared
checkpoint folder, never from a machine-local temp dir.
"""

from __future__ import annotations

import uuid
from typing import Optional, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.schema import (FEATURES, HISTORY_DOCUMENT, PRICE_COLUMNS, PROFILE_FIELDS, PROFILE_SOURCE,
                             PROFILE_SOURCE_KEYS, OHLCV_CSV_SCHEMA)
from tickwise.session import scratch_path

# ---------------------------------------------------------------------------
# Readers


def read_libsvm(spark: SparkSession, path: str, num_features: Optional[int] = None) -> DataFrame:
    """(label DOUBLE, features VECTOR).  Passing ``num_features`` skips the
    extra pass Spark otherwise runs to find the vector width."""
    r = spark.read.format("libsvm")
    if num_features is not None:
        r = r.option("numFeatures", int(num_features))
    return r.load(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """S3: header + inferred types (two passes over the file; prefer S4 at scale)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema=OHLCV_CSV_SCHEMA, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """CSV with an explicit schema (one pass)."""
    return spark.read.schema(schema).option("header", True).option("dateFormat", date_format).csv(path)


def parse_history(docs: DataFrame, json_col: str = "json") -> DataFrame:
    """S5 core: JSON documents ``{"symbol", "historical": [...]}`` -> one row per day.

    ``inline`` flattens the array inside each task; the source ``label`` field
    (a string) is dropped because it clashes with the ML label.
    """
    parsed = docs.select(F.from_json(F.col(json_col), HISTORY_DOCUMENT).alias("d"))
    return _flatten_history(parsed.select("d.symbol", "d.historical"))


def read_history_json(spark: SparkSession, path: str) -> DataFrame:
    """Read price-history JSON documents (one per file, multi-line) with a fixed schema."""
    raw = spark.read.schema(HISTORY_DOCUMENT).option("multiLine", True).json(path)
    return _flatten_history(raw)


def _flatten_history(raw: DataFrame) -> DataFrame:
    rows = raw.select(F.col("symbol").alias("company"), F.inline("historical"))
    return rows.select(
        "company",
        F.to_date("date").alias("date"),
        *[F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c) for c in PRICE_COLUMNS],
    )


def profile_record(docs: DataFrame, json_col: str = "json") -> DataFrame:
    """Profile JSON object -> the 9-field company record."""
    p = docs.select(F.from_json(F.col(json_col), PROFILE_SOURCE).alias("p"))
    return p.select(*[F.col(f"p.{src}").alias(dst) for src, dst in zip(PROFILE_SOURCE_KEYS, PROFILE_FIELDS)])


def read_partitioned_json(spark: SparkSession, path: str, schema) -> DataFrame:
    """Multi-company load in ONE read; ``company`` comes from the partition folder."""
    return spark.read.schema(schema).json(path)


# ---------------------------------------------------------------------------
# Writers


def history_documents(prices: DataFrame) -> DataFrame:
    """Build one price-history JSON document per company (company, json).

    The document of a company holds its whole daily series (bounded by the
    calendar); ``array_sort`` on (date, ...) structs keeps it in date order.
    """
    elem = F.struct(
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        *[F.col(c) for c in ("open", "high", "low", "close", "adjClose", "volume", "unadjustedVolume",
                             "change", "changePercent", "vwap")],
        F.lit(None).cast("string").alias("label"),
        F.col("changeOverTime"),
    )
    docs = prices.groupBy("company").agg(F.array_sort(F.collect_list(elem)).alias("historical"))
    return docs.select("company", F.to_json(F.struct(F.col("company").alias("symbol"), "historical")).alias("json"))


def write_history_documents(prices: DataFrame, path: str) -> None:
    """Raw JSON archive, one document per company (folder ``company=<name>``)."""
    history_documents(prices).select("company", "json").write.mode("overwrite").partitionBy("company").text(path)


def by_folder(df: DataFrame, by: str = "company", date: str = "date") -> DataFrame:
    """Rows of one folder and year meet in one task, so a folder gets a file a year and not a file a task."""
    return df.repartition(F.col(by), *([F.year(date)] if date in df.columns else []))


def write_partitioned_json(df: DataFrame, path: str, by: str = "company") -> None:
    """S12 (row form): JSON lines partitioned by company (read back with S13)."""
    by_folder(df, by).write.mode("overwrite").partitionBy(by).json(path)


def assemble(df: DataFrame, features: Sequence[str], output: str = "features", handle_invalid: str = "skip") -> DataFrame:
    """M1: feature vector from named columns (rows with NULL/NaN skipped by default)."""
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid=handle_invalid).transform(df)


def write_libsvm(df: DataFrame, path: str, label: str = "close", features: Sequence[str] = FEATURES,
                 alphabetical: bool = False) -> None:
    """Rows -> libsvm (1-based indices, zeros stored sparsely).

    Default feature order is the fixed ``FEATURES`` tuple; ``alphabetical=True``
    gives the sorted order of the other writer.  Every row is written: a missing
    label or feature is NaN.
    """
    cols = sorted(features) if alphabetical else list(features)
    target = F.coalesce(F.col(label).cast("double"), F.lit(float("nan"))).alias("label")
    data = assemble(df.select(target, *cols), cols, handle_invalid="keep")
    data.select("label", "features").write.mode("overwrite").format("libsvm").save(path)



def write_ml_csv(df: DataFrame, path: str, label: str = "close", features: Sequence[str] = FEATURES) -> None:
    """``label`` + the ten features, with header."""
    df.select(F.col(label).alias("label"), *features).write.mode("overwrite").option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Any frame to CSV with a header taken from the column names."""
    df.write.mode("overwrite").option("header", True).csv(path)


def libsvm_columns(df: DataFrame, n: int, features: str = "features", prefix: str = "f") -> DataFrame:
    """Vector column -> n plain double columns f1..fn (for comparisons)."""
    arr = vector_to_array(F.col(features))
    return df.select("label", *[arr[i].alias(f"{prefix}{i + 1}") for i in range(n)])


def scratch(spark: SparkSession, what: str) -> str:
    """Fresh folder under the shared checkpoint directory."""
    return scratch_path(spark, f"{what}-{uuid.uuid4().hex}")
