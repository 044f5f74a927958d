"""Registered queries: bars, growth, statistics, joins, significance tests, metrics."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickwise.functions.special import two_sided_normal_p_sql
from tickwise.operators import compare, indicators, joins, metrics, select, stats, windows
from tickwise.plans import views as V
from tickwise.plans.catalog import register
from tickwise.plans.queries import CORR_COLUMNS, PRIORITIES, QUANTILE_DIGITS, once, rounded
from tickwise.schema import PRICE_COLUMNS

# ---------------------------------------------------------------------------
# Bars, day fields, growth


def _bars_sql(width: str) -> str:
    return f"""
SELECT symbol, time_bucket(INTERVAL {width}, ts) AS start,
       round(arg_min(price, ts), 4) AS open, round(max(price), 4) AS high,
       round(min(price), 4) AS low, round(arg_max(price, ts), 4) AS close,
       CAST(count(*) AS BIGINT) AS volume, round(sum(price), 4) AS turnover
FROM ticks GROUP BY symbol, start
"""


@register("w3_bars_5min", views=("ticks",), bench=True, sql=_bars_sql("5 MINUTE"))
def w3_bars_5min(t):
    return rounded(windows.bars(V.ticks(t), "5min"))


@register("w3_bars_4hour", views=("ticks",), sql=_bars_sql("4 HOUR"))
def w3_bars_4hour(t):
    return rounded(windows.bars(V.ticks(t), "4hour"))


_SIZES = (("1min", "1 MINUTE"), ("5min", "5 MINUTE"), ("15min", "15 MINUTE"), ("30min", "30 MINUTE"),
          ("1hour", "1 HOUR"), ("4hour", "4 HOUR"))


@register("w3_bars_all_sizes", views=("ticks",), sql=" UNION ALL ".join(f"""
SELECT symbol, '{name}' AS size, time_bucket(INTERVAL {width}, ts) AS start,
       round(arg_min(price, ts), 4) AS open, round(max(price), 4) AS high,
       round(min(price), 4) AS low, round(arg_max(price, ts), 4) AS close,
       CAST(count(*) AS BIGINT) AS volume, round(sum(price), 4) AS turnover
FROM ticks GROUP BY symbol, start""" for name, width in _SIZES))
def w3_bars_all_sizes(t):
    return rounded(windows.multi_bars(V.ticks(t), [n for n, _ in _SIZES]))


@register("w4_day_fields", views=("prices",), sql="""
SELECT company, date, round(change, 4) AS change, round(changePercent, 4) AS changePercent,
       round(vwap, 4) AS vwap, round(changeOverTime, 4) AS changeOverTime FROM prices
""")
def w4_day_fields(t):
    return rounded(V.prices(t).select("company", "date", "change", "changePercent", "vwap", "changeOverTime"))


@register("w5_monthly_volume_growth", views=("prices",), sql="""
SELECT company, period, round(volume, 4) AS volume,
       round(volume / NULLIF(lag(volume) OVER (PARTITION BY company ORDER BY period), 0) - 1, 4) AS volume_growth
FROM (SELECT company, CAST(date_trunc('month', date) AS DATE) AS period, sum(volume) AS volume
      FROM prices GROUP BY 1, 2)
""")
def w5_monthly_volume_growth(t):
    return rounded(windows.period_growth(windows.monthly(V.prices(t), "volume"), "volume"))


# ---------------------------------------------------------------------------
# A3-A13


@register("a3_mean_rmse", views=("rmse_samples",), sql="""
SELECT company, algo, round(avg(rmse), 4) AS mean_rmse, count(rmse) AS n FROM rmse_samples GROUP BY 1, 2
""")
def a3_mean_rmse(t):
    return rounded(stats.mean_by(V.rmse_samples(t), "rmse", ["company", "algo"]))


@register("a4_histogram_close", views=("prices",), sql="""
WITH r AS (SELECT company, min(close) AS lo, max(close) AS hi FROM prices GROUP BY company),
b AS (SELECT p.company, r.lo, r.hi,
             CASE WHEN r.hi = r.lo THEN 0
                  ELSE least(CAST(floor((p.close - r.lo) / ((r.hi - r.lo) / CAST(10.0 AS DOUBLE))) AS INTEGER), 9)
             END AS bin
      FROM prices p JOIN r ON p.company = r.company)
SELECT company, bin, round(lo + bin * (hi - lo) / CAST(10.0 AS DOUBLE), 4) AS bin_lo,
       round(lo + (bin + 1) * (hi - lo) / CAST(10.0 AS DOUBLE), 4) AS bin_hi, count(*) AS n
FROM b GROUP BY company, bin, lo, hi
""")
def a4_histogram_close(t):
    return rounded(stats.histogram(once(V.prices(t)), "close", 10))


_BOX_Q = dict(q1=QUANTILE_DIGITS + 2, median=QUANTILE_DIGITS + 2, q3=QUANTILE_DIGITS + 2,
              iqr=QUANTILE_DIGITS + 2, lo_fence=QUANTILE_DIGITS + 2, hi_fence=QUANTILE_DIGITS + 2)


def _box_sql(src: str, cols, by: str) -> str:
    QD = QUANTILE_DIGITS + 2
    return f"""
WITH lf AS (UNPIVOT (SELECT {by}, {', '.join(cols)} FROM {src}) ON {', '.join(cols)} INTO NAME metric VALUE value),
q AS (SELECT {by}, metric, quantile_cont(value, 0.25) AS q1, median(value) AS median,
             quantile_cont(value, 0.75) AS q3 FROM lf GROUP BY {by}, metric),
f AS (SELECT *, q3 - q1 AS iqr, q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AS lo_fence,
             q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS hi_fence FROM q)
SELECT {', '.join('f.' + b.strip() for b in by.split(','))}, f.metric, round(q1, {QD}) AS q1,
       round(median, {QD}) AS median, round(q3, {QD}) AS q3, round(iqr, {QD}) AS iqr,
       round(lo_fence, {QD}) AS lo_fence, round(hi_fence, {QD}) AS hi_fence,
       round(min(value) FILTER (WHERE value BETWEEN lo_fence AND hi_fence), 4) AS whisker_lo,
       round(max(value) FILTER (WHERE value BETWEEN lo_fence AND hi_fence), 4) AS whisker_hi,
       CAST(count(*) FILTER (WHERE NOT (value BETWEEN lo_fence AND hi_fence)) AS BIGINT) AS outliers,
       count(value) AS n
FROM f JOIN lf USING ({by}, metric)
GROUP BY {', '.join('f.' + b.strip() for b in by.split(','))}, f.metric, q1, median, q3, iqr, lo_fence, hi_fence
"""


@register("a5_box_stats", views=("prices",), sql=_box_sql("prices", ["close", "volume"], "company"))
def a5_box_stats(t):
    return rounded(stats.box_stats(once(V.prices(t)), ["close", "volume"]), **_BOX_Q)


@register("a5_outlier_rows", views=("prices",), sql=f"""
WITH f AS (SELECT company, quantile_cont(volume, 0.25) AS q1, quantile_cont(volume, 0.75) AS q3
           FROM prices GROUP BY company)
SELECT p.company, p.date, {', '.join(f'round(p.{c}, 4) AS {c}' for c in PRICE_COLUMNS)}
FROM prices p JOIN f ON p.company = f.company
WHERE p.volume < f.q1 - CAST(1.5 AS DOUBLE) * (f.q3 - f.q1) OR p.volume > f.q3 + CAST(1.5 AS DOUBLE) * (f.q3 - f.q1)
""")
def a5_outlier_rows(t):
    return rounded(stats.outlier_rows(once(V.prices(t)), "volume"))


def _corr_sql(src: str, method: str) -> str:
    cols = list(CORR_COLUMNS)
    pairs = list(combinations(cols, 2))
    aggs = ", ".join(f'corr({a}, {b}) AS "{a}|{b}"' for a, b in pairs)
    parts = []
    for a, b in pairs:
        parts.append(f"""SELECT company, '{a}' AS feature_a, '{b}' AS feature_b, round("{a}|{b}", 4) AS r FROM w""")
        parts.append(f"""SELECT company, '{b}' AS feature_a, '{a}' AS feature_b, round("{a}|{b}", 4) AS r FROM w""")
    for c in cols:
        parts.append(f"SELECT company, '{c}' AS feature_a, '{c}' AS feature_b, CAST(1.0 AS DOUBLE) AS r FROM w")
    if method == "spearman":
        ranks = ", ".join(
            f"CAST(rank() OVER (PARTITION BY company ORDER BY {c}) AS DOUBLE) + "
            f"CAST(count(*) OVER (PARTITION BY company, {c}) - 1 AS DOUBLE) / CAST(2.0 AS DOUBLE) AS {c}"
            for c in cols)
        src = f"(SELECT company, {ranks} FROM {src})"
    return f"""WITH w AS (SELECT company, {aggs} FROM {src} GROUP BY company)
SELECT company, feature_a, feature_b, r, '{method}' AS method FROM ({' UNION ALL '.join(parts)})"""


@register("a6_pearson_matrix", views=("prices",), sql=_corr_sql("prices", "pearson"))
def a6_pearson_matrix(t):
    return rounded(stats.correlation(V.prices(t), CORR_COLUMNS))


@register("a7_spearman_matrix", views=("prices",), sql=_corr_sql("prices", "spearman"))
def a7_spearman_matrix(t):
    return rounded(stats.correlation(V.prices(t), CORR_COLUMNS, method="spearman"))


def _ml_corr_sql(method: str) -> str:
    cols = list(V.ML_FEATURES)
    src = "ml"
    if method == "spearman":
        ranks = ", ".join(
            f"CAST(rank() OVER (ORDER BY {c}) AS DOUBLE) + "
            f"CAST(count(*) OVER (PARTITION BY {c}) - 1 AS DOUBLE) / CAST(2.0 AS DOUBLE) AS {c}" for c in cols)
        src = f"(SELECT {ranks} FROM ml)"
    parts = []
    for a in cols:
        for b in cols:
            if a == b:
                parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, CAST(1.0 AS DOUBLE) AS r")
            else:
                parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 4) AS r FROM {src}")
    return f"SELECT feature_a, feature_b, r, '{method}' AS method FROM ({' UNION ALL '.join(parts)})"


@register("a6_m1_vector_pearson_ml", views=("ml",), sql=_ml_corr_sql("pearson"))
def a6_m1_vector_pearson_ml(t):
    return rounded(stats.vector_correlation(V.ml(t), list(V.ML_FEATURES), "pearson"))


@register("a7_m1_vector_spearman_ml", views=("ml",), sql=_ml_corr_sql("spearman"))
def a7_m1_vector_spearman_ml(t):
    return rounded(stats.vector_correlation(V.ml(t), list(V.ML_FEATURES), "spearman"))


@register("a8_p14_redundant_pairs", views=("prices",), sql=f"""
WITH m AS ({_corr_sql("prices", "pearson").replace("round(", "(").replace(", 4) AS r", ") AS r")})
SELECT company, feature_a, feature_b, round(r, 4) AS r, method FROM m
WHERE abs(r) > 0.8 AND feature_a < feature_b
""")
def a8_p14_redundant_pairs(t):
    return rounded(stats.redundant_pairs(stats.correlation(V.prices(t), CORR_COLUMNS), 0.8))


_LABELS_SQL = """
l AS (SELECT company, date,
             CASE WHEN close - lead(close) OVER w IS NULL THEN 0
                  WHEN close < lead(close) OVER w THEN 1 ELSE 2 END AS label,
             lead(close) OVER w AS nxt
      FROM prices WINDOW w AS (PARTITION BY company ORDER BY date)),
p AS (SELECT company, date, label, lag(label) OVER (PARTITION BY company ORDER BY date) AS prediction
      FROM l WHERE nxt IS NOT NULL)
"""


def _persistence(t):
    """Labels from the close series and a persistence prediction (yesterday's label)."""
    lab = windows.label_series(V.prices(t).select("company", "date", "close"), "close", order="date")
    w = Window.partitionBy("company").orderBy("date")
    return lab.withColumn("prediction", F.lag("label").over(w)).filter(F.col("prediction").isNotNull())


@register("a9_match_counts", views=("prices",), sql=f"""
WITH {_LABELS_SQL}
SELECT prediction = label AS correct, count(*) AS n FROM p WHERE prediction IS NOT NULL GROUP BY 1
""")
def a9_match_counts(t):
    return stats.match_counts(_persistence(t))


@register("a10_x4_median_table", views=("rmse_samples",), sql=f"""
SELECT company, {', '.join(f"round(median(rmse) FILTER (WHERE algo = '{a}'), {QUANTILE_DIGITS}) AS \"{a}\"" for a in PRIORITIES)}
FROM rmse_samples GROUP BY company
""")
def a10_x4_median_table(t):
    return rounded(stats.median_table(V.rmse_samples(t), "rmse", "company", "algo"), QUANTILE_DIGITS)


_ML_COLS = ("label", "quantity", "discount", "tax", "p_size", "p_retailprice")


@register("a11_row_counts", views=("ml",), sql=f"""
WITH m AS (SELECT {', '.join(_ML_COLS)} FROM ml)
SELECT CAST(count(*) AS BIGINT) AS rows,
       (SELECT CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT * FROM m)) AS distinct_rows,
       CAST(count(*) FILTER (WHERE {' AND '.join(c + ' IS NOT NULL' for c in _ML_COLS)}) AS BIGINT) AS complete_rows
FROM m
""")
def a11_row_counts(t):
    return stats.row_counts(V.ml(t).select(*_ML_COLS))


@register("a13_rollup_sector_year", views=("prices25", "profile"), sql="""
SELECT f.sector, CAST(year(p.date) AS INTEGER) AS year, round(sum(p.volume), 4) AS total, count(*) AS n,
       CAST(GROUPING(f.sector, year) AS INTEGER) AS level
FROM prices25 p JOIN profile f ON p.company = f.ticker
GROUP BY ROLLUP (f.sector, year)
""")
def a13_rollup_sector_year(t):
    df = joins.enrich(V.prices25(t), once(V.profile(t)), how="inner").withColumn("year", F.year("date"))
    out = stats.grid_rollup(df, "sector", "year", "volume")
    return rounded(out.withColumn("level", F.col("level").cast("int")))


_YEARS = tuple(range(1995, 2002))  # columns of the SQL twin; the operator takes the years of the data


@register("a13_pivot_sector_by_year", views=("prices25", "profile"), sql=f"""
SELECT f.sector, {', '.join(f'round(sum(p.volume) FILTER (WHERE year(p.date) = {y}), 4) AS "{y}"' for y in _YEARS)}
FROM prices25 p JOIN profile f ON p.company = f.ticker
GROUP BY f.sector
""")
def a13_pivot_sector_by_year(t):
    df = joins.enrich(V.prices25(t), once(V.profile(t)), how="inner").withColumn("year", F.year("date"))
    return rounded(stats.grid_pivot(df, "sector", "year", "volume"))


# ---------------------------------------------------------------------------
# J1-J5


@register("j1_enrich_profile", views=("prices25", "profile"), sql="""
SELECT p.company, p.date, round(p.close, 4) AS close, f.sector, f.name, round(f.price, 4) AS price
FROM prices25 p LEFT JOIN profile f ON p.company = f.ticker
""")
def j1_enrich_profile(t):
    px = V.prices25(t).select("company", "date", "close")
    return rounded(joins.enrich(px, once(V.profile(t).select("ticker", "sector", "name", "price"))))


@register("j2_asof_fx", views=("prices25", "fx"), sql="""
SELECT p.company, p.date, round(p.close, 4) AS close, round(f.rate, 4) AS rate, f.date AS date_asof,
       round(p.close * f.rate, 4) AS close_fx
FROM prices25 p ASOF LEFT JOIN fx f ON p.company = f.pair AND p.date >= f.date
""")
def j2_asof_fx(t):
    # both inputs are read twice by the bucketed plan: materialise them once
    px = once(V.prices25(t).select("company", "date", "close"))
    # monthly buckets keep every window partition to one company-month
    out = joins.asof(px, once(V.fx(t)), "company", "pair", "date", "date", ["rate"],
                     bucket=lambda d: F.trunc(d, "month"))
    return rounded(out.withColumn("close_fx", F.col("close") * F.col("rate")))


@register("j3_adjusted_close", views=("prices", "actions"), sql="""
WITH a AS (SELECT company, date,
                  sum(ln(CASE WHEN kind = 'split' THEN CAST(1.0 AS DOUBLE) / ratio ELSE ratio END)) AS lnf
           FROM actions GROUP BY 1, 2)
SELECT p.company, p.date, round(p.close, 4) AS close,
       round(p.close * exp(coalesce((SELECT sum(lnf) FROM a WHERE a.company = p.company AND a.date > p.date),
                                    CAST(0.0 AS DOUBLE))), 4) AS adjClose
FROM prices p
""")
def j3_adjusted_close(t):
    # yearly buckets bound the window partitions; both inputs are read twice
    px = once(V.prices(t).select("company", "date", "close"))
    out = joins.adjust_for_actions(px, once(V.actions(t)), bucket=lambda d: F.trunc(d, "year"))
    return rounded(out)


@register("j4_r2_actual_vs_trend", views=("prices",), sql="""
WITH fi AS (SELECT date AS ds, close AS y, company FROM prices),
fit AS (SELECT company, regr_slope(y, CAST(ds - DATE '1970-01-01' AS DOUBLE)) AS slope,
               regr_intercept(y, CAST(ds - DATE '1970-01-01' AS DOUBLE)) AS intercept FROM fi GROUP BY company),
frame AS (SELECT DISTINCT company, ds FROM fi
          UNION ALL
          SELECT company, CAST(unnest(generate_series(last + 1, last + 30, INTERVAL 1 DAY)) AS DATE) AS ds
          FROM (SELECT company, max(ds) AS last FROM fi GROUP BY company))
SELECT f.company, f.ds, round(fit.intercept + fit.slope * CAST(f.ds - DATE '1970-01-01' AS DOUBLE), 4) AS yhat,
       round(fi.y, 4) AS y,
       round(fi.y - (fit.intercept + fit.slope * CAST(f.ds - DATE '1970-01-01' AS DOUBLE)), 4) AS residual
FROM frame f JOIN fit ON f.company = fit.company
LEFT JOIN fi ON f.company = fi.company AND f.ds = fi.ds
""")
def j4_r2_actual_vs_trend(t):
    fi = once(select.forecast_input(V.prices(t), "close"))
    x = F.unix_date("ds").cast("double")
    fit = fi.groupBy("company").agg(F.regr_slope("y", x).alias("slope"), F.regr_intercept("y", x).alias("intercept"))
    frame = windows.future_frame(fi, 30).join(fit, "company")
    fc = frame.select("company", "ds", (F.col("intercept") + F.col("slope") * x).alias("yhat"))
    return rounded(joins.actual_vs_forecast(fc, fi))


_WATCH_SQL = "(SELECT ticker FROM profile WHERE sector = 'ASIA')"


@register("j5_semi_watchlist", views=("prices25", "profile"), sql=f"""
SELECT company, date, round(close, 4) AS close FROM prices25 WHERE company IN {_WATCH_SQL}
""")
def j5_semi_watchlist(t):
    watch = V.profile(t).filter(F.col("sector") == "ASIA").select("ticker")
    return rounded(joins.restrict(V.prices25(t).select("company", "date", "close"), watch))


@register("j5_anti_excluded", views=("prices25", "profile"), sql=f"""
SELECT company, date, round(close, 4) AS close FROM prices25 WHERE company NOT IN {_WATCH_SQL}
""")
def j5_anti_excluded(t):
    watch = V.profile(t).filter(F.col("sector") == "ASIA").select("ticker")
    return rounded(joins.restrict(V.prices25(t).select("company", "date", "close"), watch, exclude=True))


# ---------------------------------------------------------------------------
# X1-X4 on the experiment-sample table


def _k2_sql() -> str:
    """D'Agostino-Pearson K^2 from n, population skewness b1 and kurtosis b2 (SQL twin of compare.py)."""
    n = "CAST(n AS DOUBLE)"
    y = f"(b1 * sqrt((({n} + 1) * ({n} + 3)) / (6.0 * ({n} - 2))))"
    beta2 = f"((3.0 * ({n} * {n} + 27 * {n} - 70) * ({n} + 1) * ({n} + 3)) / (({n} - 2) * ({n} + 5) * ({n} + 7) * ({n} + 9)))"
    w2 = f"(-1.0 + sqrt(2.0 * ({beta2} - 1)))"
    delta = f"(1.0 / sqrt(0.5 * ln({w2})))"
    alpha = f"sqrt(2.0 / ({w2} - 1))"
    yy = f"(CASE WHEN {y} = 0 THEN 1.0 ELSE {y} END)"
    zs = f"({delta} * ln({yy} / {alpha} + sqrt(({yy} / {alpha}) * ({yy} / {alpha}) + 1)))"
    e = f"(3.0 * ({n} - 1) / ({n} + 1))"
    varb2 = f"(24.0 * {n} * ({n} - 2) * ({n} - 3) / (({n} + 1) * ({n} + 1) * ({n} + 3) * ({n} + 5)))"
    x = f"((b2 - {e}) / sqrt({varb2}))"
    sb1 = (f"(6.0 * ({n} * {n} - 5 * {n} + 2) / (({n} + 7) * ({n} + 9)) * "
           f"sqrt((6.0 * ({n} + 3) * ({n} + 5)) / ({n} * ({n} - 2) * ({n} - 3))))")
    a = f"(6.0 + 8.0 / {sb1} * (2.0 / {sb1} + sqrt(1.0 + 4.0 / ({sb1} * {sb1}))))"
    term1 = f"(1.0 - 2.0 / (9.0 * {a}))"
    denom = f"(1.0 + {x} * sqrt(2.0 / ({a} - 4)))"
    term2 = (f"(CASE WHEN {denom} = 0 THEN NULL ELSE sign({denom}) * "
             f"pow((1.0 - 2.0 / {a}) / abs({denom}), 1.0 / 3.0) END)")
    zk = f"(({term1} - {term2}) / sqrt(2.0 / (9.0 * {a})))"
    return f"(CASE WHEN n >= 8 THEN {zs} * {zs} + {zk} * {zk} END)"


@register("x1_normality", views=("rmse_samples",), sql=f"""
WITH m AS (SELECT company, algo, count(rmse) AS n, avg(rmse) AS mu FROM rmse_samples GROUP BY 1, 2),
c AS (SELECT s.company, s.algo, m.n, avg(pow(s.rmse - m.mu, 2)) AS m2, avg(pow(s.rmse - m.mu, 3)) AS m3,
             avg(pow(s.rmse - m.mu, 4)) AS m4
      FROM rmse_samples s JOIN m ON s.company = m.company AND s.algo = m.algo GROUP BY 1, 2, 3),
g AS (SELECT company, algo, n, m3 / pow(m2, 1.5) AS b1, m4 / (m2 * m2) AS b2 FROM c),
k AS (SELECT company, algo, n, {_k2_sql()} AS k2 FROM g)
SELECT company, algo, n, round(k2, 4) AS k2, round(exp(-k2 / 2), 4) AS p_value, exp(-k2 / 2) >= 0.05 AS normal FROM k
""")
def x1_normality(t):
    return rounded(compare.normality(V.rmse_samples(t)))


@register("x2_x3_rank_sums", views=("rmse_samples",), sql=f"""
WITH pairs AS (SELECT DISTINCT a.company, a.algo AS algo_a, b.algo AS algo_b
               FROM rmse_samples a JOIN rmse_samples b ON a.company = b.company AND a.algo < b.algo),
pooled AS (SELECT p.company, p.algo_a, p.algo_b, s.algo = p.algo_a AS in_a, s.rmse
           FROM pairs p JOIN rmse_samples s ON s.company = p.company AND (s.algo = p.algo_a OR s.algo = p.algo_b)),
ranked AS (SELECT *, CAST(rank() OVER (PARTITION BY company, algo_a, algo_b ORDER BY rmse) AS DOUBLE)
                     + CAST(count(*) OVER (PARTITION BY company, algo_a, algo_b, rmse) - 1 AS DOUBLE) / 2.0 AS r
           FROM pooled),
agg AS (SELECT company, algo_a, algo_b, sum(r) FILTER (WHERE in_a) AS w,
               CAST(count(*) FILTER (WHERE in_a) AS BIGINT) AS n_a,
               CAST(count(*) FILTER (WHERE NOT in_a) AS BIGINT) AS n_b
        FROM ranked GROUP BY 1, 2, 3),
zz AS (SELECT *, (w - CAST(n_a AS DOUBLE) * (CAST(n_a AS DOUBLE) + CAST(n_b AS DOUBLE) + 1) / 2)
                 / sqrt(CAST(n_a AS DOUBLE) * CAST(n_b AS DOUBLE) * (CAST(n_a AS DOUBLE) + CAST(n_b AS DOUBLE) + 1) / 12) AS z
       FROM agg),
pp AS (SELECT *, {two_sided_normal_p_sql("z")} AS p FROM zz)
SELECT company, algo_a, algo_b, round(w, 4) AS w, n_a, n_b, round(z, 4) AS z, round(p, 4) AS p_value,
       CASE WHEN p > 0.05 THEN 'not significant' WHEN z < 0 THEN algo_a || ' lower' ELSE algo_b || ' lower' END
         AS verdict
FROM pp
""")
def x2_x3_rank_sums(t):
    return rounded(compare.verdict(compare.rank_sums(once(V.rmse_samples(t)))))


@register("x4_box_samples", views=("rmse_samples",), sql=_box_sql("rmse_samples", ["rmse"], "company, algo"))
def x4_box_samples(t):
    return rounded(stats.box_stats(once(V.rmse_samples(t)), ["rmse"], by=("company", "algo")), **_BOX_Q)


# ---------------------------------------------------------------------------
# M3 (closed-form single-feature OLS), M10, M13 residuals, M20 on given predictions


def _ols(t):
    m = V.ml(t)
    fit = m.groupBy("p_type").agg(
        F.regr_slope("label", "quantity").alias("slope"),
        F.regr_intercept("label", "quantity").alias("intercept"),
        F.regr_r2("label", "quantity").alias("r2"),
        F.regr_count("label", "quantity").alias("n"),
    )
    return m, fit


_OLS_SQL = """
fit AS (SELECT p_type, regr_slope(label, quantity) AS slope, regr_intercept(label, quantity) AS intercept,
               regr_r2(label, quantity) AS r2, CAST(regr_count(label, quantity) AS BIGINT) AS n
        FROM ml GROUP BY p_type),
pred AS (SELECT m.p_type, m.label, fit.intercept + fit.slope * m.quantity AS prediction
         FROM ml m JOIN fit ON m.p_type = fit.p_type)
"""


@register("m3_ols_single_feature", views=("ml",), sql=f"""
WITH {_OLS_SQL}
SELECT p_type, round(slope, 4) AS slope, round(intercept, 4) AS intercept, round(r2, 4) AS r2, n FROM fit
""")
def m3_ols_single_feature(t):
    return rounded(_ols(t)[1])


@register("m10_m13_regression_metrics", views=("ml",), sql=f"""
WITH {_OLS_SQL}
SELECT p_type, count(*) AS n, round(sqrt(sum((prediction - label) * (prediction - label)) / count(*)), 4) AS rmse,
       round(sum(abs(prediction - label)) / count(*), 4) AS mae,
       round(1.0 - sum((prediction - label) * (prediction - label))
             / (sum(label * label) - sum(label) * sum(label) / count(*)), 4) AS r2
FROM pred GROUP BY p_type
""")
def m10_m13_regression_metrics(t):
    m, fit = _ols(t)
    pred = m.join(fit.select("p_type", "slope", "intercept"), "p_type").withColumn(
        "prediction", F.col("intercept") + F.col("slope") * F.col("quantity"))
    return rounded(metrics.regression_metrics(pred, by=["p_type"]))


@register("m20_confusion_counts", views=("prices",), sql=f"""
WITH {_LABELS_SQL}
SELECT label, prediction, count(*) AS n FROM p WHERE prediction IS NOT NULL GROUP BY 1, 2
""")
def m20_confusion_counts(t):
    return metrics.confusion_counts(_persistence(t))


@register("m20_classification_report", views=("prices",), sql=f"""
WITH {_LABELS_SQL},
cm AS (SELECT label, prediction, count(*) AS n FROM p WHERE prediction IS NOT NULL GROUP BY 1, 2),
ex AS (SELECT c.class, cm.* FROM (VALUES (0), (1), (2)) c(class), cm),
rep AS (SELECT class,
               CAST(coalesce(sum(n) FILTER (WHERE label = class AND prediction = class), 0) AS BIGINT) AS tp,
               CAST(coalesce(sum(n) FILTER (WHERE label <> class AND prediction = class), 0) AS BIGINT) AS fp,
               CAST(coalesce(sum(n) FILTER (WHERE label = class AND prediction <> class), 0) AS BIGINT) AS fn,
               CAST(sum(n) FILTER (WHERE label = prediction) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS accuracy
        FROM ex GROUP BY class),
pr AS (SELECT *, tp + fn AS support,
              CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fp AS DOUBLE), 0) AS precision,
              CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fn AS DOUBLE), 0) AS recall FROM rep)
SELECT class, tp, fp, fn, round(accuracy, 4) AS accuracy, support, round(precision, 4) AS precision,
       round(recall, 4) AS recall,
       round(2.0 * precision * recall / NULLIF(precision + recall, 0), 4) AS f1
FROM pr
""")
def m20_classification_report(t):
    return rounded(metrics.classification_report(_persistence(t), [0, 1, 2]))


# ---------------------------------------------------------------------------
# W6-W13 technical indicators



@register("w6_w8_w10_w13_rolling_indicators", views=("prices",), sql=f"""
SELECT company, date,
       round(CASE WHEN count(*) OVER f10 >= 10 THEN avg(close) OVER f10 END, 4) AS sma10,
       round(({' + '.join(['10.0 * close'] + [f'{10 - k}.0 * lag(close, {k}) OVER w' for k in range(1, 10)])}) / 55.0, 4)
         AS wma10,
       round(CASE WHEN count(*) OVER f14 >= 14 THEN
             -100.0 * (max(high) OVER f14 - close) / NULLIF(max(high) OVER f14 - min(low) OVER f14, 0) END, 4)
         AS williams_r14,
       round(CASE WHEN count(*) OVER f20 >= 20 THEN stddev_pop(close) OVER f20 END, 4) AS std20
FROM prices
WINDOW w AS (PARTITION BY company ORDER BY date),
       f10 AS (PARTITION BY company ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW),
       f14 AS (PARTITION BY company ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW),
       f20 AS (PARTITION BY company ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)
""")
def w6_w8_w10_w13_rolling_indicators(t):
    px = V.prices(t).select("company", "date", "high", "low", "close")
    out = indicators.rolling_std(indicators.williams_r(indicators.wma(indicators.sma(px, 10), 10), 14), 20)
    return rounded(out.select("company", "date", "sma10", "wma10", "williams_r14", "std20"))


_EMA_A = 2.0 / 11.0


@register("w7_ema", views=("prices",), sql=f"""
WITH RECURSIVE s AS (SELECT company, date, close, row_number() OVER (PARTITION BY company ORDER BY date) AS rn
                     FROM prices),
e AS (SELECT company, rn, date, close AS ema FROM s WHERE rn = 1
      UNION ALL
      SELECT s.company, s.rn, s.date,
             CAST('{_EMA_A!r}' AS DOUBLE) * s.close + CAST('{1.0 - _EMA_A!r}' AS DOUBLE) * e.ema
      FROM e JOIN s ON s.company = e.company AND s.rn = e.rn + 1)
SELECT company, date, round(ema, 4) AS ema10 FROM e
""")
def w7_ema(t):
    return rounded(indicators.ema(V.prices(t), 10))


_AN = 1.0 / 14.0


def _c(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


_WILDER_SQL = f"""
WITH RECURSIVE s AS (
  SELECT company, date, close, high, low, row_number() OVER (PARTITION BY company ORDER BY date) AS rn FROM prices),
r AS (
  SELECT company, rn, date, close, high, low, close AS e1, close AS e2, close AS e3,
         CAST(NULL AS DOUBLE) AS ag, CAST(NULL AS DOUBLE) AS al, CAST(NULL AS DOUBLE) AS atr,
         CAST(NULL AS DOUBLE) AS sp, CAST(NULL AS DOUBLE) AS sm, CAST(NULL AS DOUBLE) AS adx
  FROM s WHERE rn = 1
  UNION ALL
  SELECT company, rn, date, close, high, low, e1, e2, {_c(_EMA_A)} * e2 + {_c(1.0 - _EMA_A)} * pe3 AS e3,
         ag, al, atr, sp, sm,
         CASE WHEN padx IS NULL THEN dx ELSE {_c(_AN)} * dx + {_c(1.0 - _AN)} * padx END AS adx
  FROM (
    SELECT *, {_c(_EMA_A)} * e1 + {_c(1.0 - _EMA_A)} * pe2 AS e2,
           CASE WHEN pdi + mdi = 0 THEN CAST(0.0 AS DOUBLE)
                ELSE CAST(100.0 AS DOUBLE) * abs(pdi - mdi) / (pdi + mdi) END AS dx
    FROM (
      SELECT *, CAST(100.0 AS DOUBLE) * sp / atr AS pdi, CAST(100.0 AS DOUBLE) * sm / atr AS mdi
      FROM (
        SELECT company, rn, date, close, high, low, e1, pe2, pe3, padx,
               CASE WHEN pag IS NULL THEN gain ELSE {_c(_AN)} * gain + {_c(1.0 - _AN)} * pag END AS ag,
               CASE WHEN pal IS NULL THEN loss ELSE {_c(_AN)} * loss + {_c(1.0 - _AN)} * pal END AS al,
               CASE WHEN patr IS NULL THEN tr ELSE {_c(_AN)} * tr + {_c(1.0 - _AN)} * patr END AS atr,
               CASE WHEN psp IS NULL THEN pdm ELSE {_c(_AN)} * pdm + {_c(1.0 - _AN)} * psp END AS sp,
               CASE WHEN psm IS NULL THEN mdm ELSE {_c(_AN)} * mdm + {_c(1.0 - _AN)} * psm END AS sm
        FROM (
          SELECT s.company, s.rn, s.date, s.close, s.high, s.low,
                 {_c(_EMA_A)} * s.close + {_c(1.0 - _EMA_A)} * r.e1 AS e1,
                 r.e2 AS pe2, r.e3 AS pe3, r.adx AS padx, r.ag AS pag, r.al AS pal, r.atr AS patr,
                 r.sp AS psp, r.sm AS psm,
                 CASE WHEN s.close - r.close > 0 THEN s.close - r.close ELSE CAST(0.0 AS DOUBLE) END AS gain,
                 CASE WHEN s.close - r.close < 0 THEN -(s.close - r.close) ELSE CAST(0.0 AS DOUBLE) END AS loss,
                 greatest(s.high - s.low, abs(s.high - r.close), abs(s.low - r.close)) AS tr,
                 CASE WHEN s.high - r.high > r.low - s.low AND s.high - r.high > 0 THEN s.high - r.high
                      ELSE CAST(0.0 AS DOUBLE) END AS pdm,
                 CASE WHEN r.low - s.low > s.high - r.high AND r.low - s.low > 0 THEN r.low - s.low
                      ELSE CAST(0.0 AS DOUBLE) END AS mdm
          FROM r JOIN s ON s.company = r.company AND s.rn = r.rn + 1)))))
SELECT company, date, round(e1, 4) AS ema10, round(2 * e1 - e2, 4) AS dema10,
       round(3 * e1 - 3 * e2 + e3, 4) AS tema10,
       round(CASE WHEN al = 0 THEN CAST(100.0 AS DOUBLE)
                  ELSE CAST(100.0 AS DOUBLE) - CAST(100.0 AS DOUBLE) / (CAST(1.0 AS DOUBLE) + ag / al) END, 4) AS rsi14,
       round(adx, 4) AS adx14
FROM r
"""


@register("w9_w11_w12_wilder_indicators", views=("prices",), sql=_WILDER_SQL)
def w9_w11_w12_wilder_indicators(t):
    return rounded(indicators.recursive_indicators(V.prices(t)))
