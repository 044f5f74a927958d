import datetime as dt
import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tickwise.operators import forecast as FC
from tickwise.operators import indicators


def _series(spark, n=730, slope=0.05, weekly=3.0, noise=0.5, companies=("A", "B")):
    rng = np.random.default_rng(0)
    rows = []
    start = dt.date(2019, 1, 1)
    for j, c in enumerate(companies):
        for i in range(n):
            d = start + dt.timedelta(days=i)
            day = (d - dt.date(1970, 1, 1)).days
            y = 100 + 20 * j + slope * i + weekly * math.sin(2 * math.pi * day / 7.0) + rng.normal(0, noise)
            rows.append((d, float(y), c))
    return spark.createDataFrame(rows, "ds date, y double, company string")


def test_forecast_recovers_trend_and_weekly(spark):
    hist = _series(spark)
    spec = FC.ForecastSpec(periods=30, n_changepoints=5, yearly_order=2, ridge_changepoints=1.0)
    out = FC.forecast(hist, spec).toPandas()
    assert set(out.columns) >= {"ds", "yhat", "trend", "weekly", "yearly", "additive_terms", "company"}
    assert len(out) == 2 * (730 + 30)
    np.testing.assert_allclose(out.yhat, out.trend + out.additive_terms, atol=1e-9)
    np.testing.assert_allclose(out.additive_terms, out.weekly + out.yearly + out.daily, atol=1e-9)
    assert (out.yhat_lower <= out.yhat).all() and (out.yhat <= out.yhat_upper).all()
    assert (out.multiplicative_terms == 0).all() and (out.daily == 0).all()
    a = out[out.company == "A"].sort_values("ds")
    slope = (a.trend.iloc[700] - a.trend.iloc[100]) / 600
    assert abs(slope - 0.05) < 0.01
    assert 2.0 < a.weekly.abs().max() < 4.5           # weekly amplitude ~ 3
    fut = a[a.ds > dt.date(2020, 12, 30)]
    width = (fut.yhat_upper - fut.yhat_lower).to_numpy()
    assert np.all(np.diff(width) >= -1e-9)          # uncertainty does not shrink with horizon
    hist_rows = a[a.ds <= dt.date(2020, 12, 30)]
    np.testing.assert_allclose(hist_rows.trend_lower, hist_rows.trend, atol=1e-9)


def test_trend_only_equals_ols(spark):
    hist = _series(spark, n=200, weekly=0.0)
    spec = FC.ForecastSpec(periods=5, n_changepoints=0, weekly_order=0, yearly_order=0)
    out = FC.forecast(hist, spec).filter(F.col("company") == "A").toPandas().sort_values("ds")
    pdf = hist.filter(F.col("company") == "A").toPandas().sort_values("ds")
    x = np.array([(d - dt.date(1970, 1, 1)).days for d in pdf.ds], float)
    b1, b0 = np.polyfit(x, pdf.y, 1)
    xf = np.array([(d - dt.date(1970, 1, 1)).days for d in out.ds], float)
    np.testing.assert_allclose(out.yhat, b0 + b1 * xf, rtol=1e-9)


def test_forecast_handles_tiny_company(spark):
    rows = [(dt.date(2020, 1, 1), 5.0, "one")]
    hist = spark.createDataFrame(rows, "ds date, y double, company string")
    out = FC.forecast(hist, FC.ForecastSpec(periods=3)).toPandas()
    assert len(out) == 4 and np.isfinite(out.yhat).all()


def test_ema_matches_pandas_and_rsi_bounds(spark):
    rng = np.random.default_rng(1)
    close = 100 + np.cumsum(rng.normal(0, 1, 300))
    rows = [("A", dt.date(2020, 1, 1) + dt.timedelta(days=i), float(c + 1), float(c - 1), float(c))
            for i, c in enumerate(close)]
    df = spark.createDataFrame(rows, "company string, date date, high double, low double, close double")
    out = indicators.recursive_indicators(df).toPandas().sort_values("date")
    ref = pd.Series(close).ewm(span=10, adjust=False).mean().to_numpy()
    np.testing.assert_allclose(out.ema10.to_numpy(), ref, rtol=1e-12)
    e2 = pd.Series(ref).ewm(span=10, adjust=False).mean().to_numpy()
    np.testing.assert_allclose(out.dema10.to_numpy(), 2 * ref - e2, rtol=1e-10)
    rsi = out.rsi14.dropna()
    assert ((rsi >= 0) & (rsi <= 100)).all()
    adx = out.adx14.dropna()
    assert ((adx >= 0) & (adx <= 100)).all()
    sma = indicators.sma(df, 10).toPandas().sort_values("date").sma10.to_numpy()
    np.testing.assert_allclose(sma[9:], pd.Series(close).rolling(10).mean().to_numpy()[9:], rtol=1e-12)
    assert np.isnan(sma[:9].astype(float)).all()
    std = indicators.rolling_std(df, 20).toPandas().sort_values("date").std20.to_numpy()
    np.testing.assert_allclose(std[19:].astype(float), pd.Series(close).rolling(20).std(ddof=0).to_numpy()[19:],
                               rtol=1e-9)


def test_decide_output_schema(spark, tables):
    from tickwise.operators import decide
    from tickwise.plans import views as V

    out = decide.decide(V.prices(tables), "close", FC.ForecastSpec(periods=10),
                        decide.DecideSpec(classifier="dt"), as_of="2001-08-01")
    assert out.columns == decide.OUTPUT_COLUMNS and len(out.columns) == 31
    rows = out.collect()
    assert rows and {r.label for r in rows} <= {1, 2}
    assert all(len(r.features) == 21 and len(r.probability) == 3 for r in rows)
    assert {r.training_date for r in rows} == {dt.date(2001, 8, 1)}


def test_decide_many_companies_in_batches(spark):
    """Every company and row comes back once; the result plan does not grow with the companies; ids split exactly."""
    from tickwise.operators import decide

    spec = FC.ForecastSpec(periods=4, n_changepoints=0, weekly_order=0, yearly_order=0)
    plans = []
    for n in (3, 200):
        px = spark.range(n * 8).select(
            F.when(F.col("id") % n == 1, F.lit("")).otherwise(F.concat(F.lit("00/"), F.col("id") % n)).alias("company"),
            F.date_add(F.lit("2020-01-01").cast("date"), F.floor(F.col("id") / n).cast("int")).alias("date"),
            (F.col("id") * 7 % 11 + F.col("id")).cast("double").alias("close"))
        out = decide.decide(px, "close", spec, decide.DecideSpec(classifier="dt", max_depth=2, batch=50, threads=8), as_of="2020-02-01")
        rows = out.collect()
        assert len({r.company for r in rows}) == n and len(rows) == 2 * n and all(r.id % 5 == 0 for r in rows)
        assert all(r.prediction == r.label for r in rows)  # one trend, one label per company
        plans.append(len(out._jdf.queryExecution().optimizedPlan().toString()))
    assert plans[0] == plans[1]


def test_decide_keeps_rows_without_a_prediction(spark):
    """A company with nothing to learn from stays, undecided."""
    from tickwise.operators import decide

    spec = FC.ForecastSpec(periods=1, n_changepoints=0, weekly_order=0, yearly_order=0)
    px = spark.createDataFrame([("A", dt.date(2020, 1, d), float(d)) for d in range(1, 5)], "company string, date date, close double")
    args = ("close", spec, decide.DecideSpec(classifier="dt", val_split=1.0, score_all=True))
    rows = decide.decide(px, *args, as_of="2020-02-01").collect()
    assert len(rows) == 4 and all(r.prediction is None and r.label == 1 for r in rows)


def test_decide_with_no_data_keeps_schema(spark, tables):
    from tickwise.operators import decide
    from tickwise.plans import views as V

    full = decide.decide(V.prices(tables), "close", FC.ForecastSpec(periods=5),
                         decide.DecideSpec(classifier="dt"), as_of="2001-08-01")
    none = decide.decide(V.prices(tables), "close", FC.ForecastSpec(periods=5),
                         decide.DecideSpec(classifier="dt"), last=30, as_of="2030-01-01")
    shape = lambda df: [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    assert none.count() == 0 and shape(none) == shape(full)


def test_forecast_fit_is_partition_invariant(spark):
    hist = _series(spark, n=400, companies=("HOT", "B"))
    hot_heavy = hist.unionByName(hist.filter(F.col("company") == "B").limit(0))
    spec = FC.ForecastSpec(periods=3, n_changepoints=5, yearly_order=2)
    a = FC.fit(hot_heavy.repartition(1), spec).orderBy("company").collect()
    b = FC.fit(hot_heavy.repartition(16), spec).orderBy("company").collect()
    for ra, rb in zip(a, b):
        assert ra.company == rb.company
        np.testing.assert_allclose(ra.beta, rb.beta, rtol=1e-9, atol=1e-12)
        assert math.isclose(ra.sigma, rb.sigma, rel_tol=1e-9)


def test_laplace_prior_gives_sparse_changepoints(spark):
    rows = []
    start = dt.date(2019, 1, 1)
    rng = np.random.default_rng(5)
    for i in range(600):
        y = 100 + 0.05 * i + (0.25 * (i - 300) if i > 300 else 0.0) + rng.normal(0, 0.3)
        rows.append((start + dt.timedelta(days=i), float(y), "K"))
    hist = spark.createDataFrame(rows, "ds date, y double, company string")
    spec = FC.ForecastSpec(periods=10, n_changepoints=20, weekly_order=0, yearly_order=0)
    beta = np.array(FC.fit(hist, spec).first().beta)
    hinge = np.abs(beta[2:22])
    assert hinge.argmax() in (11, 12)  # break at t=0.50; change points at 0.04 * (k + 1): 0.48 (k=11), 0.52 (k=12)
    assert (hinge > 0.05 * hinge.max()).sum() <= 4   # sparse: few active change points
    out = FC.forecast(hist, spec).toPandas().sort_values("ds")
    late = out[out.ds > dt.date(2020, 6, 1)]
    slope = np.polyfit(np.arange(len(late)), late.trend.to_numpy(), 1)[0]
    assert abs(slope - 0.30) < 0.02


def test_changepoints_at_row_quantiles(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in list(range(0, 100)) + list(range(300, 400))]
    hist = spark.createDataFrame([(d, float(i), "G") for i, d in enumerate(days)], "ds date, y double, company string")
    spec = FC.ForecastSpec(n_changepoints=7)
    got = FC._scales(hist, spec).first()
    n = len(days)
    h = int(np.floor(n * 0.8))
    idx = np.round(np.linspace(0, h - 1, 7 + 1)).astype(int)[1:]
    d = np.array([(x - dt.date(1970, 1, 1)).days for x in days], float)
    expected = (d[idx] - d[0]) / (d[-1] - d[0])
    np.testing.assert_allclose(got._cps, expected, rtol=1e-12)
