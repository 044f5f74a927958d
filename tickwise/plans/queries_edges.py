"""Registered queries on missing values, ties, hot keys and long series (each with an oracle)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwise.functions.special import two_sided_normal_p_sql
from tickwise.operators import clean, compare, indicators, isotonic, joins, stats, windows
from tickwise.plans import views as V
from tickwise.plans.catalog import register
from tickwise.plans.queries import once, rounded

# ---------------------------------------------------------------------------
# Missing values

_GAPPY = ("open", "close", "volume")
_GAPS = "date, nullif(open, high) AS open, nullif(close, low) AS close, volume"


def _gappy(t):
    null_if = lambda c, other: F.when(F.col(c) != F.col(other), F.col(c)).alias(c)
    return V.prices(t).select("company", "date", null_if("open", "high"), null_if("close", "low"), "volume")


def _pairwise_sql() -> str:
    parts = []
    for a in _GAPPY:
        for b in _GAPPY:
            if a == b:
                parts.append(f"SELECT company, '{a}' AS feature_a, '{a}' AS feature_b, CASE WHEN min({a}) < max({a}) THEN CAST(1.0 AS DOUBLE) END AS r FROM g GROUP BY company")
                continue
            mid = lambda c: (f"rank() OVER (PARTITION BY company ORDER BY {c}) + (count(*) OVER (PARTITION BY company, {c}) - 1) / 2.0::DOUBLE")
            parts.append(f"SELECT company, '{a}' AS feature_a, '{b}' AS feature_b, round(corr(x, y), 4) AS r FROM (SELECT company, {mid(a)} AS x, {mid(b)} AS y "
                         f"FROM g WHERE {a} IS NOT NULL AND {b} IS NOT NULL) GROUP BY company")
    return f"WITH g AS (SELECT company, {_GAPS} FROM prices) SELECT *, 'spearman' AS method FROM ({' UNION ALL '.join(parts)})"


@register("a7_spearman_missing_values", views=("prices",), sql=_pairwise_sql())
def a7_spearman_missing_values(t):
    """Ranks are taken pair by pair over the rows that have both values."""
    return rounded(stats.correlation(_gappy(t), _GAPPY, method="spearman"))


@register("a6_pearson_constant_column", views=("prices",), sql="""
WITH g AS (SELECT company, open, close, 7.0::DOUBLE AS flat FROM prices)
SELECT company, 'open' AS feature_a, 'close' AS feature_b, round(corr(open, close), 4) AS r, 'pearson' AS method FROM g GROUP BY company
UNION ALL SELECT company, 'close', 'open', round(corr(close, open), 4), 'pearson' FROM g GROUP BY company
UNION ALL SELECT DISTINCT company, unnest(['open', 'close', 'flat', 'flat', 'open', 'flat', 'close']), unnest(['open', 'close', 'flat', 'open', 'flat', 'close', 'flat']),
  unnest([1.0, 1.0, NULL, NULL, NULL, NULL, NULL])::DOUBLE, 'pearson' FROM g
""")
def a6_pearson_constant_column(t):
    """A constant column correlates with nothing, itself included."""
    return rounded(stats.correlation(V.prices(t).withColumn("flat", F.lit(7.0)), ("open", "close", "flat")))


@register("c3_impute_mean_nan", views=("prices",), sql=f"""
WITH g AS (SELECT company, {_GAPS} FROM prices)
SELECT company, date, round(coalesce(open, avg(open) OVER c), 4) AS open, round(coalesce(close, avg(close) OVER c), 4) AS close, round(volume, 4) AS volume
FROM g WINDOW c AS (PARTITION BY company)
""")
def c3_impute_mean_nan(t):
    """NaN (open) and NULL (close) are both missing."""
    gappy = _gappy(t).withColumn("open", F.coalesce("open", F.lit(float("nan"))))
    return rounded(clean.impute_mean(gappy, _GAPPY, by=["company"]))


@register("x2_rank_sums_missing_samples", views=("rmse_samples",), sql=f"""
WITH s AS (SELECT company, algo, rmse FROM rmse_samples WHERE run % 5 <> 0),
pooled AS (SELECT a.company, a.algo AS algo_a, b.algo AS algo_b, s.algo = a.algo AS in_a, s.rmse
  FROM (SELECT DISTINCT company, algo FROM s) a JOIN (SELECT DISTINCT company, algo FROM s) b ON a.company = b.company AND a.algo < b.algo
  JOIN s ON s.company = a.company AND (s.algo = a.algo OR s.algo = b.algo)),
ranked AS (SELECT *, rank() OVER (PARTITION BY company, algo_a, algo_b ORDER BY rmse)
             + (count(*) OVER (PARTITION BY company, algo_a, algo_b, rmse) - 1) / 2.0::DOUBLE AS r FROM pooled),
agg AS (SELECT company, algo_a, algo_b, sum(r) FILTER (WHERE in_a) AS w, count(*) FILTER (WHERE in_a) AS n_a, count(*) FILTER (WHERE NOT in_a) AS n_b
  FROM ranked GROUP BY company, algo_a, algo_b),
zz AS (SELECT *, (w - n_a::DOUBLE * (n_a + n_b + 1) / 2) / sqrt(n_a::DOUBLE * n_b * (n_a + n_b + 1) / 12) AS z FROM agg)
SELECT company, algo_a, algo_b, round(w, 4) AS w, n_a, n_b, round(z, 4) AS z, round({two_sided_normal_p_sql("z")}, 4) AS p_value FROM zz
""")
def x2_rank_sums_missing_samples(t):
    """Samples without a value (NULL or NaN) are neither ranked nor counted."""
    lost = F.when(F.col("run") % 10 == 0, F.lit(None).cast("double")).when(F.col("run") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("rmse"))
    return rounded(compare.rank_sums(once(V.rmse_samples(t)).withColumn("rmse", lost)))


# ---------------------------------------------------------------------------
# Ties


_MINUTE_SQL = """
WITH m AS (SELECT symbol, date_trunc('minute', ts) - (minute(ts) % 7) * INTERVAL 1 MINUTE AS ts, price, event_id FROM ticks)
"""


def _minute_ticks(t):
    """Ticks whose times meet at full minutes, so that many share one."""
    whole = F.date_trunc("minute", "ts") - F.make_dt_interval(mins=F.minute("ts") % 7)
    return V.ticks(t).select("symbol", whole.cast("timestamp_ntz").alias("ts"), "price", "event_id")


@register("w3_bars_of_tied_ticks", views=("ticks",), sql=_MINUTE_SQL + """
SELECT symbol, time_bucket(INTERVAL 4 HOUR, ts, TIMESTAMP '1970-01-01') AS start, round(first(price ORDER BY ts, event_id), 4) AS open, round(max(price), 4) AS high,
  round(min(price), 4) AS low, round(last(price ORDER BY ts, event_id), 4) AS close, CAST(count(*) AS BIGINT) AS volume, round(sum(price), 4) AS turnover
FROM m GROUP BY 1, 2
""")
def w3_bars_of_tied_ticks(t):
    """Open and close among ticks of one time go by event_id."""
    return rounded(windows.bars(_minute_ticks(t), "4hour"))


@register("k2_latest_quote_of_tied_ticks", views=("ticks",), sql=_MINUTE_SQL + """
SELECT symbol, round(last(price ORDER BY ts, event_id), 4) AS price, max(ts) AS ts, CAST(count(*) AS BIGINT) AS ticks FROM m GROUP BY symbol
""")
def k2_latest_quote_of_tied_ticks(t):
    from tickwise.streaming import ticks as tk

    return rounded(tk.latest_quote(_minute_ticks(t)))


# ---------------------------------------------------------------------------
# Hot keys and long series

_HOT = "CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE symbol END"


@register("j2_asof_hot_symbol", views=("ticks",), sql=f"""
WITH h AS (SELECT event_id, {_HOT} AS symbol, ts, price FROM ticks),
rates AS (SELECT symbol, ts, CASE WHEN event_id % 4 = 0 THEN NULL ELSE price END AS rate FROM h WHERE event_id % 17 = 0)
SELECT h.event_id, h.symbol, h.ts, round(rate, 4) AS rate, r.ts AS ts_asof FROM h ASOF LEFT JOIN rates r ON h.symbol = r.symbol AND h.ts >= r.ts
""")
def j2_asof_hot_symbol(t):
    """Every tick with the last rate of its symbol, NULL rates included; a third of the ticks are of one symbol."""
    hot = once(V.ticks(t).select("event_id", F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col("symbol")).alias("symbol"), "ts", "price"))
    rates = hot.where("event_id % 17 = 0").select("symbol", "ts", F.when(F.col("event_id") % 4 != 0, F.col("price")).alias("rate"))
    return rounded(joins.asof_sliced(hot.drop("price"), rates, "symbol", "symbol", "ts", "ts", ["rate"]))




@register("w7_ema_of_ticks", views=("ticks",), sql=f"""
WITH RECURSIVE h AS (SELECT event_id, {_HOT} AS symbol, ts, price FROM ticks),
s AS (SELECT event_id, symbol, price, row_number() OVER (PARTITION BY symbol ORDER BY ts, event_id) AS rn FROM h),
e AS (SELECT event_id, symbol, rn, price AS ema, CAST(NULL AS DOUBLE) AS up, CAST(NULL AS DOUBLE) AS down, price FROM s WHERE rn = 1
  UNION ALL
  SELECT s.event_id, s.symbol, s.rn, CAST('{2 / 11!r}' AS DOUBLE) * s.price + CAST('{1 - 2 / 11!r}' AS DOUBLE) * e.ema,
    CASE WHEN e.up IS NULL THEN greatest(s.price - e.price, 0) ELSE CAST('{1 / 14!r}' AS DOUBLE) * greatest(s.price - e.price, 0) + CAST('{1 - 1 / 14!r}' AS DOUBLE) * e.up END,
    CASE WHEN e.down IS NULL THEN greatest(e.price - s.price, 0) ELSE CAST('{1 / 14!r}' AS DOUBLE) * greatest(e.price - s.price, 0) + CAST('{1 - 1 / 14!r}' AS DOUBLE) * e.down END,
    s.price
  FROM e JOIN s ON s.symbol = e.symbol AND s.rn = e.rn + 1)
SELECT event_id, symbol, round(ema, 4) AS ema10, round(CASE WHEN up IS NULL THEN NULL WHEN down = 0 THEN 100 ELSE 100 - 100 / (1 + up / down) END, 4) AS rsi14 FROM e
""")
def w7_ema_of_ticks(t):
    """EMA and RSI over every tick of a symbol, a third of the ticks being of one symbol."""
    hot = once(V.ticks(t).select("event_id", F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col("symbol")).alias("symbol"), "ts", "price"))
    both = indicators.rsi_long(indicators.ema_long(hot, 10), 14)
    return rounded(both.select("event_id", "symbol", "ema10", "rsi14"))


@register("m6_isotonic_price", views=("ml",), sql="""
WITH g AS (SELECT p_size AS x, l_returnflag_ AS grp, sum(label) AS s, count(*)::DOUBLE AS n FROM (SELECT *, CAST(quantity AS INTEGER) % 3 AS l_returnflag_ FROM ml) GROUP BY 1, 2),
c AS (SELECT grp, x, sum(s) OVER w AS s, sum(n) OVER w AS n, sum(s) OVER w - g.s AS s0, sum(n) OVER w - g.n AS n0 FROM g WINDOW w AS (PARTITION BY grp ORDER BY x)),
m AS (SELECT a.grp, a.x AS lo, b.x AS hi, (b.s - a.s0) / (b.n - a.n0) AS mean FROM c a JOIN c b ON a.grp = b.grp AND a.x <= b.x),
t AS (SELECT grp, lo, hi, min(mean) OVER (PARTITION BY grp, lo ORDER BY hi DESC) AS low FROM m)
SELECT grp, CAST(hi AS DOUBLE) AS x, round(max(low), 2) AS value FROM t GROUP BY grp, hi
""")
def m6_isotonic_price(t):
    """The pooled curves of three groups at every value of the feature, from slices of few blocks."""
    rows = once(V.ml(t).select((F.col("quantity").cast("int") % 3).alias("grp"), F.col("p_size").cast("double").alias("x"), "label"))
    curve = isotonic.fit(rows, "grp", "x", "label", slice_blocks=16)
    at = rows.select("grp", "x").distinct()
    return rounded(isotonic.predict(at, curve, "grp", "x", "value"), value=2)
