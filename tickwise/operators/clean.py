"""Cleaning (C1-C6).

All operators return new frames (nothing is mutated or silently discarded).
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.operators.stats import is_missing, row_counts


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def nan_to_null(df: DataFrame, columns: Optional[Sequence[str]] = None) -> DataFrame:
    """Normalise NaN to NULL at ingest so NULL tests and drops agree."""
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.select(*[
        F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)).alias(c) if c in cols else F.col(c)
        for c in df.columns
    ])


def drop_incomplete(df: DataFrame, subset: Optional[Sequence[str]] = None) -> DataFrame:
    """Drop rows with any NULL/NaN (in ``subset`` when given)."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def dedupe(df: DataFrame, keys: Optional[Sequence[str]] = None) -> DataFrame:
    """Drop duplicate rows; with ``keys`` keep one (the smallest) row per key.

    The keyed variant aggregates with ``min(struct(...))`` so the surviving row
    is deterministic (``dropDuplicates`` keeps an arbitrary one).
    """
    if not keys:
        return df.distinct()
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    kept = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return kept.select(*keys, "_row.*").select(*df.columns)


def impute_mean(df: DataFrame, columns: Optional[Sequence[str]] = None,
                by: Optional[Sequence[str]] = None, observed: Optional[DataFrame] = None) -> DataFrame:
    """Fill NULLs of numeric columns with the column mean.

    Global (``by=None``): Spark ML ``Imputer`` - one aggregate pass, the means
    (one value per column) are the only thing that reaches the driver.
    Per group: means per group joined back on the group key (one row per group).
    ``observed`` names the rows that hold the values where ``df`` only adds empty
    rows to them (a calendar): means ignore NULLs, so they are the same.
    NaN is missing, as in the other cleaning steps.
    """
    cols = list(columns or numeric_columns(df, exclude=by or ()))
    if not by:
        from pyspark.ml.feature import Imputer

        cast = df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])
        imp = Imputer(strategy="mean", inputCols=cols, outputCols=[f"_{c}_imp" for c in cols])
        out = imp.fit(cast).transform(cast)
        return out.select(*[F.col(f"_{c}_imp").alias(c) if c in cols else F.col(c) for c in df.columns])
    known = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    means = (df if observed is None else observed).groupBy(*by).agg(*[F.avg(known(c)).alias(f"_{c}_mean") for c in cols])
    joined = df.join(means, list(by), "left")
    return joined.select(*[
        F.coalesce(known(c), F.col(f"_{c}_mean")).alias(c) if c in cols else F.col(c)
        for c in df.columns
    ])


def null_report(df: DataFrame, columns: Optional[Sequence[str]] = None) -> DataFrame:
    """C4: count of NULL or NaN per column (one aggregate) as (field, nulls, any_null)."""
    cols = list(columns or df.columns)
    wide = df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in cols])
    stack = F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("nulls")) for c in cols]))
    return wide.select(stack).withColumn("any_null", F.col("nulls") > 0)


def cleaning_report(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and complete rows in one job."""
    return row_counts(df)


def schema_table(df: DataFrame) -> DataFrame:
    """The schema as a small DataFrame (position, column, type, nullable)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "position INT, column STRING, type STRING, nullable BOOLEAN")


def calendar(df: DataFrame, by: str = "company", date: str = "date") -> DataFrame:
    """Every calendar day between each group's first and last date, left-joined
    with the observations: days without data carry NULLs (gap detection and a
    natural source of missing values for C1/C3/C4)."""
    span = df.groupBy(by).agg(F.min(date).alias("_lo"), F.max(date).alias("_hi"))
    days = span.select(by, F.explode(F.sequence("_lo", "_hi")).alias(date))
    return days.join(df, [by, date], "left")
