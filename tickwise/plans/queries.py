"""Registered queries: one per operator of the inventory, over the driver's tables.

Every query reads whole tables (or views Spark derives from them).  Doubles are
rounded at the very end so an independent engine can compare values exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.functions.columns import libsvm_line, r4
from tickwise.operators import clean, select, stats, windows
from tickwise.plans import views as V
from tickwise.plans.catalog import register
from tickwise.schema import FEATURES, PRICE_COLUMNS
from tickwise.session import cut_lineage
from tickwise.sources.tables import Tables

AS_OF = "2001-08-01"   # last day of the order history: fixed run date for look-backs
STUDY_DAYS = 1825      # look-back of the regression study


# Interpolated quantiles of 4-decimal data have at most 6 decimals (fractions
# .25/.5/.75) and 1.5 x IQR fences at most 7; rounding them at 8 decimals never
# meets a decimal tie, whatever the engine's interpolation formula.
QUANTILE_DIGITS = 8


def rounded(df: DataFrame, digits: int = 4, **per_column: int) -> DataFrame:
    """Round every floating column (stable value hashes across engines).

    ``per_column`` overrides the number of digits for named columns.
    """
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(r4(F.col(f"`{f.name}`"), per_column.get(f.name, digits)).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def company_names(px: DataFrame) -> list[str]:
    """The companies of a price table (a per-company call of a service needs their names)."""
    return [r.company for r in px.select("company").distinct().orderBy("company").toLocalIterator()]


def _unpivot_sql(table: str, columns, by="company") -> str:
    return f"(UNPIVOT {table} ON {', '.join(columns)} INTO NAME metric VALUE value)"


_PRICE_COLS_SQL = ", ".join(PRICE_COLUMNS)


# ---------------------------------------------------------------------------
# A1/A2 + P6: descriptive summary of the last 1825 days per company (flagship)

@register("a1_describe_lookback", views=("prices",), bench=True, sql=f"""
WITH recent AS (
  SELECT company, {_PRICE_COLS_SQL} FROM prices
  WHERE date BETWEEN DATE '{AS_OF}' - {STUDY_DAYS} AND DATE '{AS_OF}')
SELECT company, metric, count(value) AS count, round(avg(value), 4) AS mean,
       round(stddev_samp(value), 4) AS std, round(min(value), 4) AS min,
       round(quantile_cont(value, 0.25), 8) AS q25, round(median(value), 8) AS median,
       round(quantile_cont(value, 0.75), 8) AS q75, round(max(value), 4) AS max
FROM {_unpivot_sql('recent', PRICE_COLUMNS)}
GROUP BY company, metric
""")
def a1_describe_lookback(t: Tables) -> DataFrame:
    recent = select.last_days(V.prices(t), STUDY_DAYS, as_of=AS_OF)
    q = QUANTILE_DIGITS
    return rounded(stats.describe(recent, PRICE_COLUMNS), q25=q, median=q, q75=q)


def _r(cols, digits: int = 4, prefix: str = "") -> str:
    """SQL select list rounding each column (oracle side)."""
    return ", ".join(f"round({prefix}{c}, {digits}) AS {c}" for c in cols)


_PX_ROUND_SQL = _r(PRICE_COLUMNS)
_PX_SELECT_SQL = f"company, date, {_PX_ROUND_SQL}"
#: Columns of the median table's SQL twin; the operator takes the values of the data.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
CORR_COLUMNS = ("close",) + tuple(c for c in FEATURES)


def _px(t: Tables) -> DataFrame:
    return V.prices(t)


def once(df: DataFrame) -> DataFrame:
    """Materialise a small derived table (e.g. companies x days) that a plan reads
    several times: one reliable checkpoint in the shared folder instead of
    re-scanning and re-aggregating the source tables per use."""
    return cut_lineage(df)


# ---------------------------------------------------------------------------
# Projections / filters (P*)

@register("p1_forecast_input", views=("prices",), sql=f"""
SELECT date AS ds, round(open, 4) AS y, company, DATE '{AS_OF}' AS training_date FROM prices
""")
def p1_forecast_input(t):
    return rounded(select.stamp_run_date(select.forecast_input(_px(t), "open"), as_of=AS_OF))


@register("p5_history_range", views=("prices",), sql=f"""
SELECT {_PX_SELECT_SQL} FROM prices
WHERE company = 'BUILDING' AND date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'
""")
def p5_history_range(t):
    return rounded(select.history(_px(t), "BUILDING", "1998-01-01", "1998-12-31"))


@register("p6_last_seven_days", views=("prices",), sql=f"""
SELECT {_PX_SELECT_SQL} FROM prices
WHERE company = 'MACHINERY' AND date BETWEEN DATE '{AS_OF}' - 7 AND DATE '{AS_OF}'
""")
def p6_last_seven_days(t):
    return rounded(select.last_days(_px(t), 7, as_of=AS_OF, ticker="MACHINERY"))


@register("p7_last_n_per_company", views=("prices",), sql=f"""
SELECT {_PX_SELECT_SQL} FROM prices
QUALIFY row_number() OVER (PARTITION BY company ORDER BY date DESC) <= 5
""")
def p7_last_n_per_company(t):
    return rounded(select.last_n(_px(t), 5))


@register("p8_symbol_set", views=("prices",), sql=f"""
SELECT {_PX_SELECT_SQL} FROM prices WHERE company IN ('BUILDING', 'MACHINERY')
""")
def p8_symbol_set(t):
    return rounded(select.symbol_set(_px(t), ["BUILDING", "MACHINERY"]))


@register("p9_line_series", views=("prices",), sql="""
SELECT company, date, round(close, 4) AS close FROM prices
""")
def p9_line_series(t):
    return rounded(select.line_series(_px(t), "close"))


@register("p10_symbol_search", views=("profile",), sql="""
SELECT ticker, name, sector, round(price, 4) AS price, country, state, city, address, website
FROM profile
WHERE (contains(lower(ticker), '1') OR contains(lower(name), '1')) AND sector = 'AMERICA'
ORDER BY ticker LIMIT 10
""")
def p10_symbol_search(t):
    return rounded(select.symbol_search(V.profile(t), "1", exchange="AMERICA", limit=10))


@register("p11_intraday_move", views=("prices",), sql="""
SELECT company, date, round(close - open, 4) AS close_minus_open,
       round(close / NULLIF(open, 0), 4) AS close_over_open FROM prices
""")
def p11_intraday_move(t):
    return rounded(select.intraday_move(_px(t)).select("company", "date", "close_minus_open", "close_over_open"))


@register("p12_w1_w2_decision_labels", views=("prices",), sql="""
SELECT company, date, round(close, 4) AS close,
       CAST(row_number() OVER w AS BIGINT) AS id,
       round(lead(close) OVER w, 4) AS close_next,
       CASE WHEN close - lead(close) OVER w IS NULL THEN 0
            WHEN close < lead(close) OVER w THEN 1 ELSE 2 END AS label
FROM prices
WINDOW w AS (PARTITION BY company ORDER BY date)
""")
def p12_w1_w2_decision_labels(t):
    px = _px(t).select("company", "date", "close")
    return rounded(windows.label_series(px, "close", order="date", keep_last=True))


@register("p12_labels_dropna", views=("prices",), sql="""
SELECT label, count(*) AS n FROM (
  SELECT CASE WHEN close - lead(close) OVER w IS NULL THEN 0
              WHEN close < lead(close) OVER w THEN 1 ELSE 2 END AS label,
         lead(close) OVER w AS close_next
  FROM prices WINDOW w AS (PARTITION BY company ORDER BY date))
WHERE close_next IS NOT NULL GROUP BY label
""")
def p12_labels_dropna(t):
    px = _px(t).select("company", "date", "close")
    lab = windows.label_series(px, "close", order="date")
    return lab.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# Cleaning (C*) - the calendar left join supplies real gaps (NULL days)

_CAL_SQL = f"""
cal AS (
  SELECT s.company, CAST(d.date AS DATE) AS date
  FROM (SELECT company, min(date) AS lo, max(date) AS hi FROM prices GROUP BY company) s,
       LATERAL (SELECT unnest(generate_series(s.lo, s.hi, INTERVAL 1 DAY)) AS date) d),
calp AS (
  SELECT cal.company, cal.date, {', '.join('p.' + c for c in PRICE_COLUMNS)}
  FROM cal LEFT JOIN prices p ON cal.company = p.company AND cal.date = p.date)
"""


def _calendar(t):
    return clean.calendar(once(_px(t)))


@register("c1_drop_incomplete", views=("prices",), sql=f"""
WITH {_CAL_SQL}
SELECT company, date, {_PX_ROUND_SQL} FROM calp
WHERE {' AND '.join(c + ' IS NOT NULL' for c in PRICE_COLUMNS)}
""")
def c1_drop_incomplete(t):
    return rounded(clean.drop_incomplete(_calendar(t)))


@register("c2_dedupe_overlapping_windows", views=("prices",), sql=f"""
SELECT DISTINCT {_PX_SELECT_SQL} FROM (
  SELECT * FROM prices WHERE date BETWEEN DATE '1998-01-01' AND DATE '1999-12-31'
  UNION ALL
  SELECT * FROM prices WHERE date BETWEEN DATE '{AS_OF}' - {STUDY_DAYS} AND DATE '{AS_OF}')
""")
def c2_dedupe_overlapping_windows(t):
    px = once(_px(t))
    both = windows.union_histories([select.history(px, None, "1998-01-01", "1999-12-31"),
                                    select.last_days(px, STUDY_DAYS, as_of=AS_OF)])
    return rounded(clean.dedupe(both))


_IMPUTE_COLS = ("open", "high", "low", "close", "volume")


@register("c3_impute_mean_per_company", views=("prices",), sql=f"""
WITH {_CAL_SQL}
SELECT company, date,
       {', '.join(f'round(coalesce({c}, avg({c}) OVER (PARTITION BY company)), 4) AS {c}' for c in _IMPUTE_COLS)}
FROM calp
""")
def c3_impute_mean_per_company(t):
    cal = _calendar(t).select("company", "date", *_IMPUTE_COLS)
    return rounded(clean.impute_mean(cal, _IMPUTE_COLS, by=["company"], observed=_px(t)))


@register("c3_impute_mean_global", views=("prices",), sql=f"""
WITH {_CAL_SQL}
SELECT company, date,
       {', '.join(f'round(coalesce({c}, avg({c}) OVER ()), 4) AS {c}' for c in _IMPUTE_COLS)}
FROM calp
""")
def c3_impute_mean_global(t):
    cal = _calendar(t).select("company", "date", *_IMPUTE_COLS)
    return rounded(clean.impute_mean(cal, _IMPUTE_COLS))


@register("c6_schema_table", sql="""
SELECT CAST(row_number() OVER (ORDER BY ordinal_position) - 1 AS INTEGER) AS position, column_name AS "column"
FROM information_schema.columns WHERE table_name = 'events'
""")
def c6_schema_table(t):
    return clean.schema_table(t.events).select("position", "column")


_CAL_COLS = ("company", "date") + PRICE_COLUMNS


@register("c4_null_report", views=("prices",), sql=f"""
WITH {_CAL_SQL}
SELECT field, nulls, nulls > 0 AS any_null FROM (
  {' UNION ALL '.join(f"SELECT '{c}' AS field, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls FROM calp"
                      for c in _CAL_COLS)})
""")
def c4_null_report(t):
    return clean.null_report(_calendar(t))


@register("c5_cleaning_report", views=("prices",), sql=f"""
WITH {_CAL_SQL}, u AS (
  SELECT * FROM calp UNION ALL
  SELECT company, date, {', '.join(PRICE_COLUMNS)} FROM prices WHERE year(date) = 1998)
SELECT CAST(count(*) AS BIGINT) AS rows,
       (SELECT CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT * FROM u)) AS distinct_rows,
       CAST(count(*) FILTER (WHERE {' AND '.join(c + ' IS NOT NULL' for c in PRICE_COLUMNS)}) AS BIGINT)
         AS complete_rows
FROM u
""")
def c5_cleaning_report(t):
    px = once(_px(t))
    u = clean.calendar(px).unionByName(px.filter(F.year("date") == 1998).select(*_CAL_COLS))
    return clean.cleaning_report(u)


# ---------------------------------------------------------------------------
# Sorts / limits (T*) and set operations (U*)

@register("t1_tail", views=("prices",), sql=f"""
SELECT {_PX_SELECT_SQL} FROM prices ORDER BY date DESC, company DESC LIMIT 5
""")
def t1_tail(t):
    return rounded(select.tail(_px(t), 5, order=("date", "company")))


@register("t2_top_gainers_per_day", views=("prices25",), sql="""
SELECT company, date, round(changePercent, 4) AS changePercent, rank FROM (
  SELECT company, date, changePercent,
         CAST(row_number() OVER (PARTITION BY date ORDER BY changePercent DESC NULLS LAST, company) AS INTEGER) AS rank
  FROM prices25) WHERE rank <= 3
""")
def t2_top_gainers_per_day(t):
    top = select.top_movers(V.prices25(t).select("company", "date", "changePercent"), 3, "changePercent")
    return rounded(top)


@register("t2_most_active_per_day", views=("prices25",), sql="""
SELECT company, date, round(volume, 4) AS volume, rank FROM (
  SELECT company, date, volume,
         CAST(row_number() OVER (PARTITION BY date ORDER BY volume DESC NULLS LAST, company) AS INTEGER) AS rank
  FROM prices25) WHERE rank <= 3
""")
def t2_most_active_per_day(t):
    return rounded(select.top_movers(V.prices25(t).select("company", "date", "volume"), 3, "volume"))


@register("t2_top_losers_per_day", views=("prices25",), sql="""
SELECT company, date, round(changePercent, 4) AS changePercent, rank FROM (
  SELECT company, date, changePercent,
         CAST(row_number() OVER (PARTITION BY date ORDER BY changePercent ASC NULLS LAST, company) AS INTEGER) AS rank
  FROM prices25) WHERE rank <= 3
""")
def t2_top_losers_per_day(t):
    losers = select.top_movers(V.prices25(t).select("company", "date", "changePercent"), 3, "changePercent",
                               ascending=True)
    return rounded(losers)


@register("t4_page", views=("prices",), sql=f"""
SELECT {_PX_SELECT_SQL} FROM prices ORDER BY company, date LIMIT 5 OFFSET 10
""")
def t4_page(t):
    return rounded(select.page(_px(t), ["company", "date"], 10, 5))


@register("u1_union_histories", views=("prices", "prices25"), sql=f"""
SELECT {_PX_SELECT_SQL} FROM prices UNION ALL SELECT {_PX_SELECT_SQL} FROM prices25
""")
def u1_union_histories(t):
    return rounded(windows.union_histories([_px(t), V.prices25(t)]))


@register("u2_future_frame", views=("prices",), sql="""
SELECT DISTINCT company, date AS ds FROM prices
UNION ALL
SELECT company, CAST(unnest(generate_series(last + 1, last + 90, INTERVAL 1 DAY)) AS DATE) AS ds
FROM (SELECT company, max(date) AS last FROM prices GROUP BY company)
""")
def u2_future_frame(t):
    return windows.future_frame(once(select.forecast_input(_px(t))), 90)


# ---------------------------------------------------------------------------
# Scalar functions (F*)

@register("f1_f4_f6_scalar_functions", views=("prices",), sql=f"""
SELECT company, date, date - 7 AS week_ago, strftime(date, '%Y-%m-%d') AS date_text,
       round(abs(change), 4) AS abs_change,
       printf('%.4f', close) || ' ' || {" || ' ' || ".join(f"'{i}:' || printf('%.4f', {c})" for i, c in enumerate(FEATURES, 1))} AS libsvm
FROM prices
""")
def f1_f4_f6_scalar_functions(t):
    px = _px(t)
    return rounded(px.select(
        "company", "date",
        F.date_sub("date", 7).alias("week_ago"),
        F.date_format("date", "yyyy-MM-dd").alias("date_text"),
        F.abs("change").alias("abs_change"),
        libsvm_line("close", list(FEATURES), fmt="%.4f").alias("libsvm"),
    ))


@register("f5_json_props", views=("ticks",), sql="""
SELECT symbol, CAST(count(*) AS BIGINT) AS n,
       CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS sum_k,
       max(CAST(json_extract(props, '$.k') AS INTEGER)) AS max_k
FROM ticks GROUP BY symbol
""")
def f5_json_props(t):
    tk = V.ticks(t)
    parsed = tk.select(
        "symbol",
        F.get_json_object("props", "$.k").cast("int").alias("k_path"),
        F.from_json("props", "k INT").alias("p"),
    )
    return parsed.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("k_path").cast("long").alias("sum_k"),
        F.max("p.k").alias("max_k"),
    )


@register("p3_p13_u1_per_company_append", views=("prices",), sql=f"""
SELECT company, date, {', '.join(f'round({c}, 4) AS {c}' for c in ('open', 'high', 'low', 'close', 'volume'))}
FROM prices
""")
def p3_p13_u1_per_company_append(t):
    """Per-company frames without a key (as a price service returns them), tagged
    with a constant company column and appended by name; the API-only fields are
    dropped."""
    px = once(_px(t))
    frames = [select.with_company(select.drop_columns(px.filter(F.col("company") == c), ["company"]), c)
              for c in company_names(px)]
    dropped = ["adjClose", "unadjustedVolume", "change", "changePercent", "vwap", "changeOverTime"]
    return rounded(select.drop_columns(windows.union_histories(frames), dropped))
