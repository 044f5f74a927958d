"""Ordered scans of series of any length: slice, then carry.

A window over one key puts all its rows into one task.  Here rows are range
partitioned by (key, order) instead, so a long series is cut into slices that
are tasks of their own; a window runs inside a slice, and what earlier slices
of the key hand on comes from a table with one row per (key, slice).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.sources.files import scratch

SLICE = "_slice"


def sliced(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """``df`` range partitioned by key and order, written once, with the slice number in ``_slice``.

    The border a row falls behind is drawn from a sample; writing fixes it, so
    every later read and a repeated task see the same slices.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *[F.col(k).asc_nulls_first() for k in keys], *order).withColumn(SLICE, F.spark_partition_id())
    path = scratch(spark, name)
    ranged.write.parquet(path)
    return spark.read.schema(ranged.schema).parquet(path)


def inside(keys: Sequence[str], order: Sequence[Column], *frame: int) -> Window:
    """The window over a key's rows of one slice."""
    w = Window.partitionBy(SLICE, *keys).orderBy(*order)
    return w.rowsBetween(*frame) if frame else w


def carried(scan: DataFrame, keys: Sequence[str], value: Column, combine, name: str) -> DataFrame:
    """(keys, _slice, name): ``value`` (an aggregate) of each key's slices before a slice, put together by the window function ``combine``.

    Null where nothing came before.  One row per key and slice.
    """
    per = scan.groupBy(*keys, SLICE).agg(value.alias(name))
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return per.select(*keys, SLICE, combine(F.col(name)).over(before).alias(name))


def with_carry(scan: DataFrame, keys: Sequence[str], carry: DataFrame, name: str) -> DataFrame:
    """``scan`` with column ``name`` of ``carry``; keys match null to null."""
    renamed = carry.select(*[F.col(k).alias(f"_c{i}") for i, k in enumerate(keys)], F.col(SLICE).alias("_cs"), name)
    same = F.col(SLICE) == F.col("_cs")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_c{i}"))
    return scan.join(renamed, same, "left").drop("_cs", *[f"_c{i}" for i in range(len(keys))])


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """The scan of ``df`` with ``_n``, the row's number in its key from 0."""
    scan = sliced(df, keys, order, name)
    carry = carried(scan, keys, F.count(F.lit(1)), F.sum, "_before")
    n = F.row_number().over(inside(keys, order)) - 1 + F.coalesce("_before", F.lit(0))
    return with_carry(scan, keys, carry, "_before").withColumn("_n", n).drop("_before")
