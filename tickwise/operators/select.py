"""Projections, filters, predicates, sorts and limits."""

from __future__ import annotations

from datetime import date
from typing import Iterable, Optional, Sequence, Union

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.functions.columns import ratio
from tickwise.schema import check_value

DateLike = Union[str, date, Column, None]


def as_of_date(as_of: DateLike) -> Column:
    """A run date: ``current_date()`` by default, or a fixed date for reproducible runs."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def forecast_input(df: DataFrame, value: str = "close") -> DataFrame:
    """(ds DATE, y DOUBLE, company STRING) with a run-time value column."""
    check_value(value)
    return df.select(
        F.col("date").cast("date").alias("ds"),
        F.col(value).cast("double").alias("y"),
        F.col("company").cast("string").alias("company"),
    )


def with_company(df: DataFrame, company: str) -> DataFrame:
    """Attach a constant company key."""
    return df.withColumn("company", F.lit(company))


def stamp_run_date(df: DataFrame, as_of: DateLike = None, name: str = "training_date") -> DataFrame:
    """Stamp the run date (``current_date`` unless ``as_of`` is given)."""
    return df.withColumn(name, as_of_date(as_of))


def history(df: DataFrame, ticker: Optional[str], start: DateLike, end: DateLike) -> DataFrame:
    """P5: inclusive date range (optionally for one ticker); pushed into the scan."""
    cond = F.col("date").between(as_of_date(start), as_of_date(end))
    if ticker is not None:
        cond = cond & (F.col("company") == F.lit(ticker))
    return df.filter(cond)


def last_days(df: DataFrame, days: int, as_of: DateLike = None, ticker: Optional[str] = None) -> DataFrame:
    """The last ``days`` calendar days up to ``as_of`` (inclusive both ends)."""
    end = as_of_date(as_of)
    return history(df, ticker, F.date_sub(end, int(days)), end)


def last_n(df: DataFrame, n: int, by: Sequence[str] = ("company",), order: str = "date") -> DataFrame:
    """Last ``n`` observations per group (Spark plans a per-partition top-k first)."""
    w = Window.partitionBy(*by).orderBy(F.col(order).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def symbol_set(df: DataFrame, symbols: Union[Iterable[str], DataFrame], key: str = "company") -> DataFrame:
    """Restrict to a set of symbols: literal ``isin`` or a semi-join for a table."""
    if isinstance(symbols, DataFrame):
        return df.join(symbols.select(F.col(symbols.columns[0]).alias(key)), key, "left_semi")
    return df.filter(F.col(key).isin(list(symbols)))


def line_series(df: DataFrame, value: str = "close") -> DataFrame:
    """(company, date, value) line series."""
    return df.select("company", "date", F.col(value))


def symbol_search(profiles: DataFrame, query: str, exchange: Optional[str] = None, limit: int = 10) -> DataFrame:
    """P10: case-insensitive text match on ticker or name, optional exchange/sector, top ``limit``."""
    q = F.lit(query.lower())
    cond = F.contains(F.lower("ticker"), q) | F.contains(F.lower("name"), q)
    if exchange is not None:
        cond = cond & (F.col("sector") == F.lit(exchange))
    return profiles.filter(cond).orderBy("ticker").limit(limit)


def intraday_move(df: DataFrame) -> DataFrame:
    """Close - open and close / open (NULL on a zero open)."""
    return df.withColumn("close_minus_open", F.col("close") - F.col("open")).withColumn(
        "close_over_open", ratio("close", "open"))



def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P13."""
    return df.drop(*columns)


def preview(df: DataFrame, k: int = 20, columns: Sequence[str] = ("prediction", "label", "features")) -> DataFrame:
    """First ``k`` rows of a prediction frame (vectors as arrays)."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import VectorUDT

    cols = []
    for c in columns:
        if isinstance(df.schema[c].dataType, VectorUDT):
            cols.append(vector_to_array(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols).limit(k)


def tail(df: DataFrame, k: int = 5, order: Sequence[str] = ("date",)) -> DataFrame:
    """Last ``k`` rows by ``order`` (planned as a top-k, not a full sort)."""
    cols = [order] if isinstance(order, str) else list(order)
    return df.orderBy(*[F.col(c).desc() for c in cols]).limit(k)


def top_movers(df: DataFrame, k: int = 3, metric: str = "changePercent", by: str = "date",
               ascending: bool = False) -> DataFrame:
    """Top ``k`` companies per day by a metric (gainers/losers/actives)."""
    order = F.col(metric).asc_nulls_last() if ascending else F.col(metric).desc_nulls_last()
    w = Window.partitionBy(by).orderBy(order, F.col("company"))
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def page(df: DataFrame, order: Sequence[str], offset: int, limit: int) -> DataFrame:
    """T4: one page of a sorted result."""
    return df.orderBy(*order).offset(offset).limit(limit)
