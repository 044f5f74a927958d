"""Rows by rank over data of any size: exact quantiles (A1, A2, A5) and pages (T4).

Equal rows are first counted together (combined map-side, so a value that a
third of all rows hold is one row), then range partitioned in their order and
written once.  Each range has a row count; running counts of the ranges say
which range holds a wanted rank, and only such ranges are read again.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.operators.slices import SLICE, carried, inside, sliced, with_carry
from tickwise.sources.files import scratch


def quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """(by..., q0, q1, ...): exact quantiles with linear interpolation, as ``percentile`` gives them.

    No task holds a group: the distinct values of a group lie in ranges of
    their own.  NULL values do not count; NaN sorts above all numbers; a group
    without values has no row; without ``by`` there is always one (NULLs for an
    empty table, as in any aggregate).
    """
    keys = [f"_k{i}" for i in range(len(by))]
    named = df.select(*[F.col(c).alias(k) for c, k in zip(by, keys)], F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL")
    counts = named.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    scan = sliced(counts, keys, [F.col("_v")], "rank-values")
    before = carried(scan, keys, F.sum("_n"), F.sum, "_before")
    held = scan.groupBy(*keys, SLICE).agg(F.sum("_n").alias("_held"))
    ranges = with_carry(held, keys, before, "_before").withColumn("_before", F.coalesce("_before", F.lit(0)))
    sizes = ranges.groupBy(*keys).agg(F.sum("_held").alias("_size"))

    spot = [(F.col("_size") - 1) * F.lit(float(p)) for p in probs]
    asked = sizes.select(*keys, F.explode(F.array_distinct(F.flatten(F.array(*[F.array(F.floor(s), F.ceil(s)) for s in spot])))).alias("_rank"))
    in_range = (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_held"))
    wanted = ranges.join(_keyed(asked, keys, ["_rank"]), _same(keys) & in_range).groupBy(*keys, SLICE).agg(
        F.first("_before").alias("_before"), F.collect_set("_rank").alias("_ranks"))  # two ranks a probability at most

    rows = with_carry(scan, keys, wanted, "_ranks").where("_ranks IS NOT NULL")
    rows = with_carry(rows, keys, wanted.drop("_ranks"), "_before")
    first = F.col("_before") + F.sum("_n").over(inside(keys, [F.col("_v")], Window.unboundedPreceding, 0)) - F.col("_n")
    hit = rows.withColumn("_first", first).withColumn(
        "_mine", F.filter("_ranks", lambda r: (r >= F.col("_first")) & (r < F.col("_first") + F.col("_n")))).where(F.size("_mine") > 0)
    found = hit.groupBy(*keys).agg(F.map_from_entries(F.flatten(F.collect_list(F.transform("_mine", lambda r: F.struct(r, "_v"))))).alias("_at"))
    out = sizes.join(_keyed(found, keys, ["_at"]), _same(keys))

    def interpolated(s: Column) -> Column:
        lo, hi = F.floor(s), F.ceil(s)
        return F.when(lo == hi, F.col("_at")[lo]).otherwise((hi - s) * F.col("_at")[lo] + (s - lo) * F.col("_at")[hi])

    return out.select(*[F.col(k).alias(c) for c, k in zip(by, keys)], *[interpolated(s).alias(f"q{i}") for i, s in enumerate(spot)])


def _keyed(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_r{k}") for k in keys], *columns)


def _same(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r{k}")) for k in keys], F.lit(True))


@dataclass(frozen=True)
class PageIndex:
    """A sorted table with its ranges: ``starts`` holds (slice, rows before it, rows in it)."""

    rows: DataFrame
    columns: tuple[str, ...]
    order: tuple[Column, ...]
    starts: tuple[tuple[int, int, int], ...]

    @property
    def size(self) -> int:
        return self.starts[-1][1] + self.starts[-1][2] if self.starts else 0

    def page(self, offset: int, limit: int) -> DataFrame:
        """``limit`` rows from ``offset``, in order: reads only the ranges that hold them.

        Equal rows are kept as one with their count, which the page unfolds
        for the ranks it shows.  An offset past the end gives no rows.
        """
        hit = [(s, b) for s, b, n in self.starts if b < offset + limit and b + n > offset]
        before = F.coalesce(*[F.when(F.col(SLICE) == s, F.lit(b)) for s, b in hit]) if hit else F.lit(0)
        rows = self.rows.where(F.col(SLICE).isin([s for s, _ in hit]))
        here = Window.partitionBy(SLICE).orderBy(*self.order)
        end = before + F.sum("_copies").over(here.rowsBetween(Window.unboundedPreceding, 0))
        ranked = rows.withColumn("_end", end).withColumn("_from", F.greatest(F.col("_end") - F.col("_copies"), F.lit(offset))).withColumn(
            "_to", F.least("_end", F.lit(offset + limit))).where("_from < _to")
        unfolded = ranked.withColumn("_rank", F.explode(F.sequence("_from", F.col("_to") - 1)))
        return unfolded.orderBy("_rank").select(*[F.col("_row").getField(c).alias(c) for c in self.columns])


def page_index(df: DataFrame, order: Sequence[str], ascending: bool = True) -> PageIndex:
    """An index of ``df`` for pages at any depth.

    Missing values come first (last with ``ascending=False``).  Ties of ``order`` are settled by the whole row, so pages never overlap and
    reruns agree.  The ranges are folders, so a page reads only its own; their
    counts, one row a shuffle partition, are all that comes to the driver.
    """
    spark = df.sparkSession
    folded = df.select(F.struct("*").alias("_row")).groupBy("_row").agg(F.count(F.lit(1)).alias("_copies"))
    parts = [F.col("_row").getField(c) for c in order] + [F.col("_row")]
    by = tuple(c.asc() if ascending else c.desc() for c in parts)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = folded.repartitionByRange(n, *by).withColumn(SLICE, F.spark_partition_id()).sortWithinPartitions(SLICE, *by)
    path = scratch(spark, "pages")
    ranged.write.partitionBy(SLICE).parquet(path)
    rows = spark.read.schema(ranged.schema).parquet(path)
    starts, total = [], 0
    for r in rows.groupBy(SLICE).agg(F.sum("_copies").alias("n")).orderBy(SLICE).collect():
        starts.append((r[SLICE], total, r["n"]))
        total += r["n"]
    return PageIndex(rows, tuple(df.columns), by, tuple(starts))
