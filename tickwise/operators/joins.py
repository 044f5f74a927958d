"""Joins (J1-J5).

Equi-joins are left to Catalyst + AQE: a side is broadcast only when Spark's
measured size (``autoBroadcastJoinThreshold``, runtime shuffle statistics under
AQE) is below the limit; otherwise sort-merge.  The two non-equi joins (as-of
and "all later actions") are rewritten as union + ordered window so they
never emit pairs.
"""

from __future__ import annotations

from typing import Callable, Optional, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.operators.slices import SLICE, inside, sliced, with_carry


def enrich(prices: DataFrame, profile: DataFrame, key: str = "company", profile_key: str = "ticker",
           how: str = "left") -> DataFrame:
    """Attach the company profile (a dimension) to each price row; Spark picks the join by bytes."""
    dim = profile.withColumnRenamed(profile_key, key)
    return prices.join(dim, key, how)


def asof(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_time: str, right_time: str,
         values: Sequence[str], bucket: Optional[Callable[[Column], Column]] = None) -> DataFrame:
    """For each left row, the latest right row with right_time <= left_time.

    Union both sides tagged with their origin, order by (key, time, origin) so a
    right row sorts before a left row of the same time, and carry the last right
    row forward as a struct: its values come as they are, NULLs included, and
    right rows of one time are ordered by their values.  One sort, no pairs.

    ``bucket`` (e.g. ``lambda t: F.date_trunc("month", t)``) bounds the window
    partitions for long series: the window runs per (key, bucket); a left row
    with no right row earlier in its own bucket takes the value carried from
    previous buckets, found by the same as-of over a small per-bucket summary
    (one row per key and bucket).
    """
    vals = list(values)
    if bucket is None:
        return _asof_window(left, right, left_key, right_key, left_time, right_time, vals, [])
    lb = left.withColumn("_b", bucket(F.col(left_time)))
    rb = right.withColumn("_b", bucket(F.col(right_time)))
    inner = _asof_window(lb, rb, left_key, right_key, left_time, right_time, vals, ["_b"])
    # last right row of every (key, bucket): tiny, one row per key and bucket
    last = F.max(F.struct(F.col(right_time).alias("_rt"), *[F.col(v) for v in vals])).alias("_last")
    summary = rb.where(F.col(right_time).isNotNull()).groupBy(F.col(right_key).alias("_k"), "_b").agg(last)
    # distinct (key, bucket) of the left side; carried value = as-of over buckets (strictly earlier)
    marks = lb.select(F.col(left_key).alias("_k"), "_b").distinct()
    w = (Window.partitionBy("_k").orderBy("_b", "_side")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    u = (marks.select("_k", "_b", F.lit(0).alias("_side"), F.lit(None).cast(summary.schema["_last"].dataType).alias("_last"))
         .unionByName(summary.select("_k", "_b", F.lit(1).alias("_side"), "_last")))
    carried = u.select("_k", "_b", "_side", F.last("_last", ignorenulls=True).over(w).alias("_c")).where("_side = 0").drop("_side")
    out = inner.join(carried, (inner[left_key] == carried["_k"]) & (inner["_b"] == carried["_b"]), "left")
    asof_time = f"{right_time}_asof"
    fill = [F.col(c) for c in left.columns]
    fill += [F.when(F.col(asof_time).isNull(), F.col("_c")[v]).otherwise(F.col(v)).alias(v) for v in vals]
    fill += [F.coalesce(F.col(asof_time), F.col("_c")["_rt"]).alias(asof_time)]
    return out.select(*fill)


def _both_sides(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_time: str, right_time: str,
                vals: list, extra: list) -> DataFrame:
    """Rows of both sides under (_k, _t, _side): right rows (0) carry ``_v``, left rows (1) their columns packed in ``_l``."""
    own = F.struct(*[F.col(c) for c in left.columns if c not in extra])
    # a right row without a time is never the latest
    known = right.where(F.col(right_time).isNotNull())
    value = F.struct(F.col(right_time).alias("_rt"), *[F.col(v) for v in vals])
    l = left.select(*extra, F.col(left_key).alias("_k"), F.col(left_time).alias("_t"), F.lit(1).alias("_side"), own.alias("_l"))
    r = known.select(*extra, F.col(right_key).alias("_k"), F.col(right_time).alias("_t"), F.lit(0).alias("_side"), value.alias("_v"))
    return l.unionByName(r, allowMissingColumns=True)


def _asof_window(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_time: str,
                 right_time: str, vals: list, extra: list) -> DataFrame:
    w = (Window.partitionBy("_k", *extra).orderBy("_t", "_side", "_v")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    u = _both_sides(left, right, left_key, right_key, left_time, right_time, vals, extra)
    met = u.withColumn("_c", F.last("_v", ignorenulls=True).over(w)).where("_side = 1")
    return _found(met, left, right_time, vals, extra)


def _found(met: DataFrame, left: DataFrame, right_time: str, vals: list, extra: list) -> DataFrame:
    """The left rows with the values and the time of the right row found for each."""
    # a key that is null matches nothing
    hit = lambda c: F.when(F.col("_k").isNotNull(), F.col("_c")[c])
    return met.select(*[F.col("_l")[c].alias(c) for c in left.columns if c not in extra], *extra,
                      *[hit(v).alias(v) for v in vals], hit("_rt").alias(f"{right_time}_asof"))


def asof_sliced(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_time: str, right_time: str,
                values: Sequence[str]) -> DataFrame:
    """J2 for a key of any length, on both sides: the same rows as ``asof`` without buckets.

    The union is cut into range slices of (key, time), so a hot symbol is many
    tasks; the last right row of a key's earlier slices enters through a table
    with one row per key and slice.
    """
    vals = list(values)
    u = _both_sides(left, right, left_key, right_key, left_time, right_time, vals, [])
    order = [F.col("_t").asc_nulls_first(), F.col("_side").asc()]
    scan = sliced(u, ["_k"], order, "asof")
    last = F.max(F.struct("_t", "_v")).getField("_v")
    # slices with left rows only get the carry of the last slice with a right row before them
    marks = scan.select("_k", SLICE).distinct()
    per = scan.where("_side = 0").groupBy("_k", SLICE).agg(last.alias("_last"))
    every = marks.withColumn("_last", F.lit(None).cast(per.schema["_last"].dataType)).unionByName(per).groupBy("_k", SLICE).agg(F.max("_last").alias("_last"))
    before = Window.partitionBy("_k").orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = every.select("_k", SLICE, F.last("_last", ignorenulls=True).over(before).alias("_carry"))
    w = inside(["_k"], [*order, F.col("_v").asc_nulls_first()], Window.unboundedPreceding, Window.currentRow)
    met = with_carry(scan.withColumn("_c", F.last("_v", ignorenulls=True).over(w)).where("_side = 1"), ["_k"], carry, "_carry")
    met = met.withColumn("_c", F.coalesce("_c", "_carry"))
    return _found(met, left, right_time, vals, [])


def adjust_for_actions(prices: DataFrame, actions: DataFrame, by: str = "company", date: str = "date",
                       value: str = "close", name: str = "adjClose",
                       bucket: Optional[Callable[[Column], Column]] = None) -> DataFrame:
    """Value x product of the factors of all actions strictly after the row's date.

    Factor: split -> 1/ratio, dividend -> ratio.  Implemented as a reverse
    running sum of ln(factor) over the union of both sides (no range join).
    ``bucket`` (e.g. yearly) bounds the window partitions to (company, bucket);
    the actions of all later buckets enter through a small per-bucket table.
    """
    factor = F.when(F.col("kind") == "split", F.lit(1.0) / F.col("ratio")).otherwise(F.col("ratio"))
    act = actions.groupBy(by, date).agg(F.sum(F.ln(factor)).alias("_lnf"))
    extra = []
    if bucket is not None:
        act = act.withColumn("_b", bucket(F.col(date)))
        prices = prices.withColumn("_b", bucket(F.col(date)))
        extra = ["_b"]
    act = act.select(by, date, *extra, F.lit(1).alias("_side"), "_lnf")
    px = prices.select(by, date, *extra, F.lit(0).alias("_side"), F.lit(None).cast("double").alias("_lnf"),
                       *[c for c in prices.columns if c not in (by, date, *extra)])
    # Descending date; on equal dates the price row comes first, so only
    # strictly later actions are summed into it.
    w = (Window.partitionBy(by, *extra).orderBy(F.col(date).desc(), F.col("_side"))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    u = px.unionByName(act, allowMissingColumns=True)
    out = u.withColumn("_cum", F.coalesce(F.sum("_lnf").over(w), F.lit(0.0)))
    out = out.filter(F.col("_side") == 0)
    if bucket is not None:
        # sum of ln factors of every later bucket: over (company, bucket) totals only
        tot = (act.groupBy(by, "_b").agg(F.sum("_lnf").alias("_t"))
               .unionByName(prices.select(by, "_b").distinct().withColumn("_t", F.lit(0.0)))
               .groupBy(by, "_b").agg(F.sum("_t").alias("_t")))
        later = Window.partitionBy(by).orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
        tot = tot.withColumn("_later", F.coalesce(F.sum("_t").over(later), F.lit(0.0))).select(by, "_b", "_later")
        tot = tot.select(F.col(by).alias("_tk"), F.col("_b").alias("_tb"), "_later")
        out = out.join(tot, out[by].eqNullSafe(tot["_tk"]) & out["_b"].eqNullSafe(tot["_tb"]), "left")
        out = out.withColumn("_cum", F.col("_cum") + F.coalesce("_later", F.lit(0.0))).drop("_b", "_tk", "_tb", "_later")
    return out.withColumn(name, F.col(value) * F.exp("_cum")).drop("_side", "_lnf", "_cum")


def actual_vs_forecast(forecast: DataFrame, actual: DataFrame, by: str = "company", ds: str = "ds",
                       value: str = "y") -> DataFrame:
    """Left outer equi-join of forecast rows with observed values; residual = y - yhat."""
    joined = forecast.join(actual.select(by, ds, value), [by, ds], "left")
    return joined.withColumn("residual", F.col(value) - F.col("yhat"))


def restrict(df: DataFrame, keys: DataFrame, key: str = "company", exclude: bool = False) -> DataFrame:
    """Keep (semi) or drop (anti) rows whose key is in ``keys``."""
    k = keys.select(F.col(keys.columns[0]).alias(key)).distinct()
    return df.join(k, key, "left_anti" if exclude else "left_semi")
