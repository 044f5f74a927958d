"""Column expressions (JVM-side, codegen-friendly).

Everything here returns ``Column`` objects built from ``pyspark.sql.functions``;
no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.schema import BUY, SELL, WAIT


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den, NULL when den is 0 or NULL (safe under ANSI mode)."""
    return F.try_divide(_c(num), _c(den))


def change(close="close", open_="open") -> Column:
    return _c(close) - _c(open_)


def change_percent(close="close", open_="open") -> Column:
    return ratio(F.lit(100.0) * change(close, open_), open_)


def change_over_time(close="close", open_="open") -> Column:
    return ratio(change(close, open_), open_)


def typical_price(high="high", low="low", close="close") -> Column:
    """Per-day vwap proxy: (high + low + close) / 3."""
    return (_c(high) + _c(low) + _c(close)) / F.lit(3.0)


def with_day_fields(df: DataFrame) -> DataFrame:
    """Add the per-day fields a price service serves next to OHLCV.

    adjClose defaults to close (no corporate actions known) and
    unadjustedVolume to volume; ``adjust_for_actions`` refines adjClose.
    One projection (a single analysis pass, one codegen'd Project).
    """
    return df.select(
        *[F.col(c) for c in df.columns],
        F.col("close").alias("adjClose"),
        F.col("volume").alias("unadjustedVolume"),
        change().alias("change"),
        change_percent().alias("changePercent"),
        typical_price().alias("vwap"),
        change_over_time().alias("changeOverTime"),
    )


def decision_label(current: Column | str, following: Column | str) -> Column:
    """3-way label: NULL next -> WAIT, current < next -> BUY, otherwise SELL (ties SELL)."""
    cur, nxt = _c(current), _c(following)
    return (
        F.when((cur - nxt).isNull(), F.lit(WAIT))
        .when(cur < nxt, F.lit(BUY))
        .otherwise(F.lit(SELL))
    )


def r4(col: Column | str, digits: int = 4) -> Column:
    """Round a double to ``digits`` decimals through the binary product x * 10^d.

    ``round(x, d)`` rounds the decimal string of x, other engines round the
    binary product; rounding the product itself gives the same double
    everywhere (ties can no longer fall on different sides).
    """
    scale = float(10 ** digits)
    return F.round(_c(col) * F.lit(scale)) / F.lit(scale)


def libsvm_line(label: Column | str, features: list[str], fmt: str | None = None) -> Column:
    """Text form of a libsvm record: ``label 1:f1 2:f2 ...`` (1-based).

    ``fmt`` (a printf pattern such as ``%.4f``) fixes the number format;
    without it Spark's default double-to-string cast is used.
    """
    def txt(c):
        return F.format_string(fmt, _c(c)) if fmt else _c(c).cast("string")

    parts = [txt(label)]
    parts += [F.concat(F.lit(f"{i}:"), txt(f)) for i, f in enumerate(features, start=1)]
    return F.concat_ws(" ", *parts)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x
