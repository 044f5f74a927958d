"""Technical indicators (W6-W13) over each company's daily series.

* Fixed-length indicators (SMA, WMA, Williams %R, rolling std) are window
  functions over a bounded frame of the last n rows - the indicator's own
  definition, evaluated JVM-side.
* Recursive ones (EMA and what is built on it: DEMA, TEMA, Wilder's RSI and
  ADX) need a sequential scan; it runs once per company in ``applyInPandas``
  (one group = one company's daily series, bounded by the calendar) and is
  O(n).  Recursions are seeded with the first observation.
* ``ema_long`` and ``rsi_long`` are the same recursions for series of any
  length (ticks), as columns: the affine maps y -> a y + b of a block of rows
  compose to one window sum, and a block starts from the end of the one before.
"""

from __future__ import annotations

import math
from typing import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.operators.slices import carried, inside, sliced, with_carry
from tickwise.session import ship_package
from tickwise.sources.files import scratch


def _frame(n: int, by: Sequence[str], order: str) -> Window:
    return Window.partitionBy(*by).orderBy(order).rowsBetween(-(n - 1), Window.currentRow)


def _full(n: int, by: Sequence[str], order: str):
    """True once the frame holds n rows (indicator is NULL before that)."""
    return F.count(F.lit(1)).over(_frame(n, by, order)) >= n


def sma(df: DataFrame, n: int = 10, value: str = "close", by=("company",), order: str = "date",
        name: str | None = None) -> DataFrame:
    """Simple moving average of the last n rows."""
    return df.withColumn(name or f"sma{n}", F.when(_full(n, by, order), F.avg(value).over(_frame(n, by, order))))


def wma(df: DataFrame, n: int = 10, value: str = "close", by=("company",), order: str = "date",
        name: str | None = None) -> DataFrame:
    """Linearly weighted moving average: sum_k (n - k) x_{t-k} / (n (n + 1) / 2)."""
    w = Window.partitionBy(*by).orderBy(order)
    num = F.lit(float(n)) * F.col(value)
    for k in range(1, n):
        num = num + F.lit(float(n - k)) * F.lag(value, k).over(w)
    return df.withColumn(name or f"wma{n}", num / F.lit(n * (n + 1) / 2.0))


def williams_r(df: DataFrame, n: int = 14, by=("company",), order: str = "date", name: str | None = None
               ) -> DataFrame:
    """-100 * (highest high - close) / (highest high - lowest low) over n rows."""
    fr = _frame(n, by, order)
    hh, ll = F.max("high").over(fr), F.min("low").over(fr)
    val = F.lit(-100.0) * F.try_divide(hh - F.col("close"), hh - ll)
    return df.withColumn(name or f"williams_r{n}", F.when(_full(n, by, order), val))


def rolling_std(df: DataFrame, n: int = 20, value: str = "close", by=("company",), order: str = "date",
                name: str | None = None) -> DataFrame:
    """Population standard deviation of the last n rows."""
    return df.withColumn(name or f"std{n}",
                         F.when(_full(n, by, order), F.stddev_pop(value).over(_frame(n, by, order))))


# ---------------------------------------------------------------------------
# Recursive indicators


def ema_values(x: np.ndarray, alpha: float) -> np.ndarray:
    """E_0 = x_0, E_t = alpha x_t + (1 - alpha) E_{t-1}; NaN inputs carry the previous value."""
    return pd.Series(x).ewm(alpha=alpha, adjust=False, ignore_na=True).mean().to_numpy()


def _rsi(close: np.ndarray, n: int) -> np.ndarray:
    delta = np.diff(close, prepend=np.nan)
    gain = np.where(delta > 0, delta, 0.0)
    loss = np.where(delta < 0, -delta, 0.0)
    gain[0] = loss[0] = np.nan
    ag, al = ema_values(gain, 1.0 / n), ema_values(loss, 1.0 / n)
    with np.errstate(divide="ignore", invalid="ignore"):
        rsi = np.where(al == 0, 100.0, 100.0 - 100.0 / (1.0 + ag / al))
    rsi[np.isnan(ag)] = np.nan
    return rsi


def _adx(high: np.ndarray, low: np.ndarray, close: np.ndarray, n: int) -> np.ndarray:
    pc, ph, pl = (np.roll(a, 1) for a in (close, high, low))
    tr = np.maximum.reduce([high - low, np.abs(high - pc), np.abs(low - pc)])
    up, down = high - ph, pl - low
    pdm = np.where((up > down) & (up > 0), up, 0.0)
    mdm = np.where((down > up) & (down > 0), down, 0.0)
    for a in (tr, pdm, mdm):
        a[0] = np.nan
    a = 1.0 / n
    atr, sp, sm = ema_values(tr, a), ema_values(pdm, a), ema_values(mdm, a)
    with np.errstate(divide="ignore", invalid="ignore"):
        pdi, mdi = 100.0 * sp / atr, 100.0 * sm / atr
        dx = np.where(pdi + mdi == 0, 0.0, 100.0 * np.abs(pdi - mdi) / (pdi + mdi))
    dx[np.isnan(atr)] = np.nan
    return ema_values(dx, a)


def recursive_indicators(df: DataFrame, n_ema: int = 10, n_rsi: int = 14, n_adx: int = 14, by: str = "company",
                         order: str = "date", wanted: Sequence[str] = ("ema", "dema", "tema", "rsi", "adx")) -> DataFrame:
    """W7, W9, W11, W12 in one per-company scan: the wanted ones of ema, dema, tema, rsi, adx."""
    ae = 2.0 / (n_ema + 1)
    periods = {"ema": n_ema, "dema": n_ema, "tema": n_ema, "rsi": n_rsi, "adx": n_adx}
    names = [f"{w}{periods[w]}" for w in wanted]
    inputs = ["high", "low", "close"] if "adx" in wanted else ["close"]

    def value(pdf: pd.DataFrame, which: str) -> np.ndarray:
        c = pdf["close"].to_numpy(float)
        if which == "rsi":
            return _rsi(c, n_rsi)
        if which == "adx":
            return _adx(pdf["high"].to_numpy(float), pdf["low"].to_numpy(float), c, n_adx)
        e1 = ema_values(c, ae)
        if which == "ema":
            return e1
        e2 = ema_values(e1, ae)
        return 2 * e1 - e2 if which == "dema" else 3 * e1 - 3 * e2 + ema_values(e2, ae)

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        return pdf[[by, order]].assign(**{n: value(pdf, w) for n, w in zip(names, wanted)})

    key_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = f"{by} {key_types[by]}, {order} {key_types[order]}, " + ", ".join(f"{n} double" for n in names)
    ship_package(df.sparkSession)
    out = df.select(by, order, *inputs).groupBy(by).applyInPandas(scan, schema)
    # undefined values (first rows) as NULL, not NaN
    return out.select(by, order, *[F.nanvl(F.col(n), F.lit(None).cast("double")).alias(n) for n in names])


def ema(df: DataFrame, n: int = 10, by: str = "company", order: str = "date") -> DataFrame:
    """W7 alone (exponential moving average of close, alpha = 2 / (n + 1))."""
    return recursive_indicators(df, n_ema=n, by=by, order=order, wanted=("ema",))


# ---------------------------------------------------------------------------
# The same recursions over series of any length

#: A block is so long that what a start value adds past two blocks is below double precision: a ** rows = exp(-FADE).
FADE = 40.0


def _ordered(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


def smoothed(scan: DataFrame, keys: Sequence[str], order: Sequence[str], inputs: Mapping[str, str], alpha: float) -> DataFrame:
    """``scan`` (of ``slices.sliced``) with E_0 = x_0, E_t = alpha x_t + (1 - alpha) E_{t-1} of each input column (output -> input).

    A missing input keeps the value before it.  Rows are numbered by slices and
    carries, then dealt in blocks of a fixed number of rows, so no task holds a
    series.  Inside a block the recursion is a running sum of x_j / a ** j.
    """
    out, a = scan, 1.0 - alpha
    rows = max(2, math.ceil(FADE / -math.log(a)))
    for name, x in inputs.items():
        v = F.nanvl(F.col(x).cast("double"), F.lit(None).cast("double"))
        known = out.withColumn("_x", v)
        carry = carried(known, keys, F.count("_x"), F.sum, "_seen")
        n = F.count("_x").over(inside(keys, _ordered(order), Window.unboundedPreceding, Window.currentRow)) + F.coalesce("_seen", F.lit(0)) - 1
        at = with_carry(known, keys, carry, "_seen").withColumn("_n", n).drop("_seen")
        at = at.withColumn("_block", F.floor(F.col("_n") / rows)).withColumn("_k", F.col("_n") % rows)
        term = F.col("_x") * F.when(F.col("_n") == 0, 1.0).otherwise(alpha) * F.pow(F.lit(a), -F.col("_k"))
        at = at.withColumn("_term", F.coalesce(term, F.lit(0.0)))
        path = scratch(scan.sparkSession, "smoothed")
        at.write.parquet(path)
        at = scan.sparkSession.read.schema(at.schema).parquet(path)
        # the value at the end of a block that starts from 0; only full blocks are ever followed
        ends = at.where("_n >= 0").groupBy(*keys, "_block").agg((F.sum("_term") * (a ** (rows - 1))).alias("_end"))
        names = [f"_e{i}" for i in range(len(keys))]
        before = lambda gap, as_: ends.select(*[F.col(k).alias(e) for k, e in zip(keys, names)], (F.col("_block") + gap).alias("_eb"), F.col("_end").alias(as_))
        for gap, as_ in ((1, "_one"), (2, "_two")):
            same = F.col("_block") == F.col("_eb")
            for k, e in zip(keys, names):
                same = same & F.col(k).eqNullSafe(F.col(e))
            at = at.join(before(gap, as_), same, "left").drop("_eb", *names)
        start = F.coalesce("_one", F.lit(0.0)) + F.coalesce("_two", F.lit(0.0)) * (a ** rows)
        w = Window.partitionBy(*keys, "_block").orderBy(*_ordered(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        value = F.pow(F.lit(a), F.col("_k")) * (F.sum("_term").over(w) + a * start)
        out = at.withColumn(name, F.when(F.col("_n") >= 0, value)).drop("_x", "_n", "_block", "_k", "_term", "_one", "_two")
    return out


def ema_long(df: DataFrame, n: int = 10, value: str = "price", by: Sequence[str] = ("symbol",), order: Sequence[str] = ("ts", "event_id"),
             name: str | None = None) -> DataFrame:
    """W7 over series of any length; ``order`` must order a series' rows fully."""
    scan = sliced(df, by, _ordered(order), "ema")
    return smoothed(scan, by, order, {name or f"ema{n}": value}, 2.0 / (n + 1)).select(*df.columns, name or f"ema{n}")


def rsi_long(df: DataFrame, n: int = 14, value: str = "price", by: Sequence[str] = ("symbol",), order: Sequence[str] = ("ts", "event_id"),
             name: str | None = None) -> DataFrame:
    """W12 (Wilder's RSI) over series of any length; NULL on a series' first row."""
    keys, sort, x = list(by), _ordered(order), F.col(value).cast("double")
    scan = sliced(df, keys, sort, "rsi")
    last = F.max(F.struct(*[F.col(c) for c in order], x.alias("_v")))
    carry = carried(scan, keys, last, lambda c: F.last(c, ignorenulls=True), "_last")
    lag = F.coalesce(F.lag(x).over(inside(keys, sort)), F.col("_last")["_v"])
    moved = with_carry(scan, keys, carry, "_last").withColumn("_d", x - lag).drop("_last")
    moved = moved.withColumn("_gain", F.when(F.col("_d").isNotNull(), F.greatest("_d", F.lit(0.0)))).withColumn(
        "_loss", F.when(F.col("_d").isNotNull(), F.greatest(-F.col("_d"), F.lit(0.0))))
    both = smoothed(moved, keys, order, {"_up": "_gain", "_down": "_loss"}, 1.0 / n)
    rsi = F.when(F.col("_up").isNotNull(), F.when(F.col("_down") == 0, 100.0).otherwise(
        100.0 - 100.0 / (1.0 + F.try_divide(F.col("_up"), F.col("_down")))))
    return both.select(*df.columns, rsi.alias(name or f"rsi{n}"))
