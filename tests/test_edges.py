"""Missing values, ties, hot keys and long series: small cases beside the registered queries."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickwise.operators import clean, compare, indicators, isotonic, joins, slices, stats, windows

DAY = dt.date(2024, 1, 1)


def day(n: int) -> dt.date:
    return DAY + dt.timedelta(days=n)


# correlation


def test_spearman_ranks_pairs_on_complete_rows(spark):
    a, b, c = [1.0, 2.0, 3.0, 4.0, 5.0], [10.0, None, 30.0, 20.0, 5.0], [float("nan"), 1.0, 1.0, 2.0, 9.0]
    df = spark.createDataFrame(list(zip(["x"] * 5, a, b, c)), "company string, a double, b double, c double")
    got = {(r["feature_a"], r["feature_b"]): r["r"] for r in stats.correlation(df, ["a", "b", "c"], method="spearman").collect()}
    want = pd.DataFrame({"a": a, "b": b, "c": c}).astype(float)
    for p in "abc":
        for q in "abc":
            both = want[[p, q]].dropna() if p != q else None
            # ranks of the complete rows, ties averaged
            r = 1.0 if p == q else float(np.corrcoef(both[p].rank(), both[q].rank())[0, 1])
            assert got[(p, q)] == pytest.approx(r)


def test_constant_columns_have_no_correlation(spark):
    df = spark.createDataFrame([("x", 1.0, 7.0), ("x", 2.0, 7.0), ("y", 1.0, None)], "company string, a double, b double")
    for method in ("pearson", "spearman"):
        got = {tuple(r)[:3]: r["r"] for r in stats.correlation(df, ["a", "b"], method=method).collect()}
        assert got[("x", "a", "a")] == 1.0 and got[("x", "b", "b")] is None and got[("x", "a", "b")] is None
        assert got[("y", "a", "a")] is None and len(got) == 8


# samples and means


def test_rank_sums_leave_out_missing_samples(spark):
    rows = [("c", "a", x) for x in (1.0, 2.0, None, None)] + [("c", "b", x) for x in (3.0, 4.0, float("nan"))]
    got = compare.rank_sums(spark.createDataFrame(rows, "company string, algo string, rmse double")).first()
    assert (got["n_a"], got["n_b"], got["w"]) == (2, 2, 3.0)


def test_impute_mean_takes_nan_as_missing_in_both_forms(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", float("nan")), ("x", None)], "company string, v double")
    assert [r["v"] for r in clean.impute_mean(df, ["v"], by=["company"]).collect()] == [1.0] * 3
    assert [r["v"] for r in clean.impute_mean(df, ["v"]).collect()] == [1.0] * 3


# as-of and actions


def test_asof_forms_agree_on_missing_rates_keys_and_times(spark):
    rates = [("p", day(4), 1.1), ("p", day(19), None), ("p", day(40), None), ("q", day(1), 2.0), (None, day(1), 3.0), ("p", None, 9.0)]
    left = [("p", day(n)) for n in (0, 4, 10, 33, 50)] + [("q", day(60)), (None, day(5)), ("z", day(5)), ("p", None)]
    lf = spark.createDataFrame(left, "k string, t date")
    rt = spark.createDataFrame(rates, "pair string, d date, rate double")
    args = (lf, rt, "k", "pair", "t", "d", ["rate"])
    want = {("p", day(0)): (None, None), ("p", day(4)): (1.1, day(4)), ("p", day(10)): (1.1, day(4)), ("p", day(33)): (None, day(19)), ("p", day(50)): (None, day(40)),
            ("q", day(60)): (2.0, day(1)), (None, day(5)): (None, None), ("z", day(5)): (None, None), ("p", None): (None, None)}
    for out in (joins.asof(*args), joins.asof(*args, bucket=lambda d: F.trunc(d, "month")), joins.asof_sliced(*args)):
        assert out.columns == ["k", "t", "rate", "d_asof"]
        assert {(r["k"], r["t"]): (r["rate"], r["d_asof"]) for r in out.collect()} == want


def test_sliced_asof_cuts_a_hot_key(spark):
    n = 4000
    left = spark.range(n).select(F.lit("hot").alias("k"), F.col("id").alias("t"))
    right = spark.range(0, n, 977).select(F.lit("hot").alias("k"), F.col("id").alias("t"), (F.col("id") * 2).alias("v"))
    out = joins.asof_sliced(left, right, "k", "k", "t", "t", ["v"])
    assert {r["t"]: r["v"] for r in out.collect()} == {t: t // 977 * 977 * 2 for t in range(n)}
    scan = slices.sliced(left, ["k"], [F.col("t").asc()], "hot")
    assert max(r["count"] for r in scan.groupBy(slices.SLICE).count().collect()) < n / 4


def test_price_of_a_null_company_stays(spark):
    px = spark.createDataFrame([(None, day(1), 10.0), ("a", day(1), 20.0)], "company string, date date, close double")
    act = spark.createDataFrame([("a", day(500), "split", 2.0)], "company string, date date, kind string, ratio double")
    for bucket in (None, lambda d: F.trunc(d, "year")):
        got = {r["company"]: r["adjClose"] for r in joins.adjust_for_actions(px, act, bucket=bucket).collect()}
        assert got[None] == 10.0 and got["a"] == pytest.approx(10.0)


# ties


def test_tied_ticks_do_not_depend_on_order(spark):
    at = dt.datetime(2024, 1, 1, 9, 30)
    rows = [("s", at, float(p), e) for e, p in enumerate([5, 1, 9, 3, 7, 2])]
    seen = set()
    for parts, order in ((1, 1), (3, -1), (6, 1)):
        df = spark.createDataFrame(rows[::order], "symbol string, ts timestamp_ntz, price double, event_id long").repartition(parts)
        for bars in (windows.bars(df, "5min"), windows.multi_bars(df, ("5min",))):
            r = bars.first()
            seen.add((r["open"], r["close"]))
    assert seen == {(5.0, 2.0)}


# isotonic


def pav(x, y, w):
    order = np.lexsort([x])
    blocks = []
    for v in np.unique(x[order]):
        m = x == v
        blocks.append([v, v, float((y[m] * w[m]).sum()), float(w[m].sum())])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][3] > blocks[-1][2] / blocks[-1][3]:
            b = blocks.pop()
            blocks[-1] = [blocks[-1][0], b[1], blocks[-1][2] + b[2], blocks[-1][3] + b[3]]
    return blocks


@pytest.mark.parametrize("shape", ["noisy", "falling", "steps"])
def test_isotonic_in_slices_equals_one_pass(spark, shape):
    rng = np.random.RandomState(3)
    x = rng.randint(0, 900, 1500).astype(float)
    y = {"noisy": x / 50 + rng.randn(1500) * 4, "falling": -x, "steps": np.floor(x / 100) * (-1) ** (x // 300)}[shape]
    w = rng.randint(1, 4, 1500).astype(float)
    rows = [("a", *map(float, r)) for r in zip(x, y, w)] + [(None, 1.0, 5.0, 1.0), (None, 2.0, 3.0, 1.0), ("a", None, 1.0, 1.0), ("a", 1.0, float("nan"), 1.0), ("a", 1.0, 1e9, 0.0)]
    df = spark.createDataFrame(rows, "company string, x double, y double, w double")
    model = isotonic.fit(df, "company", "x", "y", "w", slice_blocks=40)
    got = sorted(tuple(r)[1:] for r in model.where("g = 'a'").collect())
    want = pav(x, y, w)
    assert [(b[0], b[1]) for b in got] == [(b[0], b[1]) for b in want]
    assert [b[2] for b in got] == pytest.approx([b[2] / b[3] for b in want])
    assert [tuple(r)[1:4] for r in model.where("g IS NULL").collect()] == [(1.0, 2.0, 4.0)]


def test_isotonic_predicts_like_spark_ml(spark):
    from pyspark.ml.regression import IsotonicRegression

    rng = np.random.RandomState(5)
    data = [(float(x), float(x / 9 + rng.randn() * 2)) for x in rng.randint(0, 200, 300) * 2]
    df = spark.createDataFrame(data, "x double, y double")
    at = spark.createDataFrame([(float(x),) for x in range(-3, 405)] + [(None,)], "x double")
    for rising in (True, False):
        ours = {r["x"]: r["prediction"] for r in isotonic.predict(at, isotonic.fit(df, None, "x", "y", isotonic=rising, slice_blocks=30), None, "x").collect()}
        ml = IsotonicRegression(featuresCol="x", labelCol="y", isotonic=rising).fit(df)
        theirs = {r["x"]: r["prediction"] for r in ml.transform(at.na.drop()).collect()}
        assert ours.pop(None) is None and ours.keys() == theirs.keys()
        assert all(ours[k] == pytest.approx(theirs[k], abs=1e-9) for k in ours)


def test_isotonic_of_nothing(spark):
    none = spark.createDataFrame([], "company string, x double, y double")
    model = isotonic.fit(none, "company", "x", "y")
    assert model.count() == 0
    some = spark.createDataFrame([("a", 1.0)], "company string, x double")
    assert isotonic.predict(some, model, "company", "x").first()["prediction"] is None


# long recursions


def test_long_recursions_equal_the_daily_ones(spark):
    rng = np.random.RandomState(7)
    n = 1500
    price = np.round(100 + rng.randn(n).cumsum(), 2)
    rows = [("hot", day(i), i, float(p)) for i, p in enumerate(price)] + [("b", day(0), 0, 1.0), ("b", day(1), 1, 2.0), (None, day(0), 0, 3.0)]
    df = spark.createDataFrame(rows, "company string, date date, event_id int, close double")
    daily = {(r["company"], r["date"]): r for r in indicators.recursive_indicators(df.where("company IS NOT NULL"), wanted=("ema", "rsi")).collect()}
    order = ("date", "event_id")
    both = indicators.rsi_long(indicators.ema_long(df, 10, "close", ("company",), order), 14, "close", ("company",), order)
    got = {(r["company"], r["date"]): r for r in both.collect()}
    for k, r in daily.items():
        assert got[k]["ema10"] == pytest.approx(r["ema10"], rel=1e-12)
        assert got[k]["rsi14"] == (None if r["rsi14"] is None else pytest.approx(r["rsi14"], rel=1e-9))
    assert got[(None, day(0))]["ema10"] == 3.0 and got[(None, day(0))]["rsi14"] is None


def test_long_ema_keeps_its_value_over_missing_ones(spark):
    rows = [("a", i, v) for i, v in enumerate([None, 4.0, float("nan"), 8.0, None])]
    got = indicators.ema_long(spark.createDataFrame(rows, "symbol string, ts int, price double"), 3, order=("ts",)).orderBy("ts").collect()
    assert [r["ema3"] for r in got] == [None, 4.0, 4.0, 6.0, 6.0]
