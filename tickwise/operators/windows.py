"""Window operators (W1-W5) and set operations.

Windows are always partitioned by a series key (company / symbol) and ordered
by time.  A company's daily series is bounded by the calendar, so a window
partition never grows with data volume; tick-level work (W3) aggregates by
(symbol, time bucket) instead and never windows over a whole symbol.
"""

from __future__ import annotations

from functools import reduce
from math import gcd
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.functions.columns import decision_label, ratio
from tickwise.schema import BAR_SIZES


def series_window(by: Sequence[str] = ("company",), order: str = "ds") -> Window:
    return Window.partitionBy(*by).orderBy(F.col(order))




def label_series(df: DataFrame, value: str = "yhat", by: Sequence[str] = ("company",), order: str = "ds",
                 keep_last: bool = False) -> DataFrame:
    """W1 + W2 + P12: id, next value and BUY/SELL/WAIT label per series.

    By default the last row of each series (label WAIT, next NULL) is dropped,
    as the reference's ``dropna`` does; ``keep_last=True`` keeps it.
    """
    w = series_window(by, order)
    out = (df.withColumn("id", F.row_number().over(w).cast("long"))
             .withColumn(f"{value}_next", F.lead(value).over(w)))
    out = out.withColumn("label", decision_label(value, f"{value}_next"))
    if not keep_last:
        out = out.filter(F.col(f"{value}_next").isNotNull())
    return out


def bars(ticks: DataFrame, size: str = "5min", symbol: str = "symbol", ts: str = "ts",
         price: str = "price") -> DataFrame:
    """OHLCV bars per (symbol, tumbling window).  Pure aggregation: partial
    per partition, then a shuffle on (symbol, window) - hot symbols spread over
    many windows.  Ticks of one time are ordered by ``event_id`` where there is one."""
    width = BAR_SIZES.get(size, size)
    t = _tick_order(ticks, ts, _width_micros(width))
    return (
        ticks.groupBy(symbol, F.window(F.col(ts), width).alias("w"))
        .agg(
            F.min_by(price, t).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, t).alias("close"),
            F.count(F.lit(1)).alias("volume"),
            F.sum(price).alias("turnover"),
        )
        .select(symbol, F.col("w.start").cast("timestamp_ntz").alias("start"),
                "open", "high", "low", "close", "volume", "turnover")
    )


def multi_bars(ticks: DataFrame, sizes=("1min", "5min", "15min", "30min", "1hour", "4hour"),
               symbol: str = "symbol", ts: str = "ts", price: str = "price") -> DataFrame:
    """W3 at several resolutions in one scan of the ticks.

    Ticks are first reduced (map-side) to bars of the widest unit that divides
    every size; these carry their first and last event time and are then merged
    into the epoch-aligned buckets of each size (the alignment of ``window()``).
    """
    widths = {s: _width_micros(BAR_SIZES.get(s, s)) for s in sizes}
    unit = gcd(*widths.values())
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    t = F.col(ts).cast("timestamp_ntz")
    us = ticks.select(symbol, F.col(price).alias("_p"), F.timestamp_diff("MICROSECOND", epoch, t).alias("_us"),
                      _tick_order(ticks.withColumn(ts, t), ts, unit).alias("_at"))
    base = us.groupBy(symbol, (F.col("_us") - F.pmod("_us", F.lit(unit))).alias("_us")).agg(
        F.min_by("_p", "_at").alias("open"), F.max("_p").alias("high"), F.min("_p").alias("low"), F.max_by("_p", "_at").alias("close"),
        F.count(F.lit(1)).alias("volume"), F.sum("_p").alias("turnover"))
    cells = F.array(*[F.struct(F.lit(name).alias("size"), F.lit(w).alias("w")) for name, w in widths.items()])
    start = F.timestamp_add("MICROSECOND", F.col("_us") - F.pmod(F.col("_us"), F.col("c.w")), epoch)
    return (base.withColumn("c", F.explode(cells)).groupBy(symbol, F.col("c.size").alias("size"), start.alias("start"))
            .agg(F.min_by("open", "_us").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
                 F.max_by("close", "_us").alias("close"), F.sum("volume").alias("volume"), F.sum("turnover").alias("turnover")))


def _tick_order(ticks: DataFrame, ts: str, width: int) -> Column:
    """A number that orders the ticks of one window: time since its start, then ``event_id``.

    One long, so that the aggregate stays a hash aggregate.  The bits that the
    time leaves hold the id's low bits: ticks of one microsecond are told apart
    unless their ids agree in all of these (some 2 ** 28 for a four-hour bar).
    """
    plain = dict(ticks.dtypes)[ts] == "timestamp"
    micros = F.unix_micros(ts) if plain else F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts).cast("timestamp_ntz"))
    into = F.pmod(micros, F.lit(width))
    if "event_id" not in ticks.columns:
        return into
    room = 1 << (62 - width.bit_length())
    return into * room + F.coalesce(F.pmod(F.col("event_id").cast("long"), F.lit(room)), F.lit(0))


def _width_micros(width: str) -> int:
    n, unit = width.split()
    return int(n) * {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600, "day": 86400, "days": 86400}[unit] * 1_000_000


def period_growth(df: DataFrame, value: str, by: Sequence[str] = ("company",), period: str = "period") -> DataFrame:
    """X / lag(x) - 1 over consecutive periods of each series."""
    prev = F.lag(value).over(Window.partitionBy(*by).orderBy(period))
    return df.withColumn(f"{value}_growth", ratio(F.col(value), prev) - F.lit(1.0))


def monthly(df: DataFrame, value: str = "volume", by: Sequence[str] = ("company",), date: str = "date") -> DataFrame:
    """Aggregate a daily series to (company, month) sums."""
    return df.groupBy(*by, F.date_trunc("month", F.col(date)).cast("date").alias("period")).agg(
        F.sum(value).alias(value))


def union_histories(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union of per-company histories by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def future_frame(df: DataFrame, periods: int, by: str = "company", ds: str = "ds") -> DataFrame:
    """Each series' distinct history dates plus ``periods`` daily future dates."""
    hist = df.select(by, ds).distinct()
    last = df.groupBy(by).agg(F.max(ds).alias("_last"))
    fut = last.select(by, F.explode(F.sequence(F.date_add("_last", 1), F.date_add("_last", int(periods)))).alias(ds))
    return hist.unionByName(fut)
