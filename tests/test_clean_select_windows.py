import datetime as dt
import math

from pyspark.sql import functions as F

from tickwise.operators import clean, select, stats, windows

D = dt.date


def test_nan_and_null_are_both_dropped_after_normalising(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", None)], "company string, close double")
    assert clean.drop_incomplete(df).count() == 1  # Spark na.drop removes NaN and NULL
    norm = clean.nan_to_null(df)
    assert norm.filter(F.col("close").isNull()).count() == 2


def test_keyed_dedupe_is_deterministic(spark):
    df = spark.createDataFrame([("a", D(2020, 1, 1), 3.0), ("a", D(2020, 1, 1), 1.0), ("b", D(2020, 1, 1), 2.0)],
                               "company string, date date, close double")
    out = {(r.company, r.close) for r in clean.dedupe(df, ["company", "date"]).collect()}
    assert out == {("a", 1.0), ("b", 2.0)}


def test_impute_mean_global_and_per_company(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", 10.0), ("b", None)],
                               "company string, x double")
    per = sorted((r.company, r.x) for r in clean.impute_mean(df, ["x"], by=["company"]).collect())
    assert per == [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 10.0), ("b", 10.0)]
    glob = sorted(r.x for r in clean.impute_mean(df, ["x"]).collect())
    assert glob == sorted([1.0, 3.0, 10.0, 14.0 / 3, 14.0 / 3])


def test_null_report_and_schema(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b double")
    rep = {r.field: (r.nulls, r.any_null) for r in clean.null_report(df).collect()}
    assert rep == {"a": (1, True), "b": (2, True)}
    sch = clean.schema_table(df).collect()
    assert [(r.column, r.type) for r in sch] == [("a", "int"), ("b", "double")]


def test_calendar_fills_gaps_with_nulls(spark):
    df = spark.createDataFrame([("a", D(2020, 1, 1), 1.0), ("a", D(2020, 1, 4), 2.0)],
                               "company string, date date, close double")
    cal = clean.calendar(df).orderBy("date").collect()
    assert [r.close for r in cal] == [1.0, None, None, 2.0]


def test_label_rule_ties_sell_last_wait(spark):
    df = spark.createDataFrame([("a", D(2020, 1, i), v) for i, v in [(1, 1.0), (2, 2.0), (3, 2.0), (4, 1.0)]],
                               "company string, ds date, yhat double")
    kept = windows.label_series(df, "yhat", keep_last=True).orderBy("ds").collect()
    assert [r.label for r in kept] == [1, 2, 2, 0]  # up -> BUY, tie -> SELL, down -> SELL, last -> WAIT
    assert [r.id for r in kept] == [1, 2, 3, 4]
    dropped = windows.label_series(df, "yhat").collect()
    assert len(dropped) == 3 and all(r.label != 0 for r in dropped)


def test_one_row_company_and_empty_input(spark):
    df = spark.createDataFrame([("solo", D(2020, 1, 1), 5.0)], "company string, ds date, yhat double")
    assert windows.label_series(df, "yhat").count() == 0
    assert windows.label_series(df, "yhat", keep_last=True).first().label == 0
    empty = df.limit(0)
    assert stats.describe(empty.withColumnRenamed("yhat", "close"), ["close"]).count() == 0


def test_zero_open_gives_null_ratios(spark):
    from tickwise.functions.columns import with_day_fields

    df = spark.createDataFrame([("a", 0.0, 2.0, 0.0, 1.0, 1.0)],
                               "company string, open double, high double, low double, close double, volume double")
    r = with_day_fields(df).first()
    assert r.change == 1.0 and r.changePercent is None and r.changeOverTime is None
    assert select.intraday_move(df).first().close_over_open is None


def test_future_frame_and_lookback(spark):
    df = spark.createDataFrame([("a", D(2020, 1, 1), 1.0), ("a", D(2020, 1, 3), 1.0)],
                               "company string, ds date, y double")
    ff = windows.future_frame(df, 5).orderBy("ds").collect()
    assert len(ff) == 7 and ff[-1].ds == D(2020, 1, 8)
    px = spark.createDataFrame([("a", D(2020, 1, d)) for d in range(1, 11)], "company string, date date")
    assert select.last_days(px, 7, as_of="2020-01-10").count() == 8  # inclusive both ends


def test_top_movers_and_page(spark):
    df = spark.createDataFrame([("a", D(2020, 1, 1), 3.0), ("b", D(2020, 1, 1), 5.0), ("c", D(2020, 1, 1), 4.0)],
                               "company string, date date, changePercent double")
    top = select.top_movers(df, 2).orderBy("rank").collect()
    assert [r.company for r in top] == ["b", "c"]
    assert [r.company for r in select.page(df, ["company"], 1, 1).collect()] == ["b"]


def test_histogram_edges(spark):
    df = spark.createDataFrame([("a", float(v)) for v in range(11)] + [("c", 7.0)], "company string, close double")
    h = {(r.company, r.bin): r.n for r in stats.histogram(df, "close", 10).collect()}
    assert h[("a", 9)] == 2 and sum(v for (c, _), v in h.items() if c == "a") == 11  # max in last bin
    assert h[("c", 0)] == 1  # constant group -> bin 0


def test_box_stats_and_spearman_ties(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("a", v) for v in vals], "company string, x double")
    b = stats.box_stats(df, ["x"]).first()
    assert (b.q1, b.median, b.q3, b.outliers, b.whisker_hi) == (2.0, 3.0, 4.0, 1, 4.0)
    tied = spark.createDataFrame([("a", 1.0, 1.0), ("a", 1.0, 2.0), ("a", 2.0, 3.0)], "company string, u double, v double")
    ranks = sorted(r.u for r in stats.average_ranks(tied, ["u"], ["company"]).collect())
    assert ranks == [1.5, 1.5, 3.0]
    r = {(x.feature_a, x.feature_b): x.r for x in stats.correlation(tied, ["u", "v"], method="spearman").collect()}
    assert math.isclose(r[("u", "v")], 0.8660254037844387) and r[("u", "u")] == 1.0


def test_approximate_quantiles_close_to_exact(spark):
    df = spark.range(0, 20001).selectExpr("'a' AS company", "CAST(id AS DOUBLE) AS close")
    ex = stats.describe(df, ["close"]).first()
    ap = stats.describe(df, ["close"], exact=False).first()
    assert ex.median == 10000.0
    assert abs(ap.median - ex.median) <= 20001 / 10000 + 1
    assert abs(ap.q25 - ex.q25) <= 20001 / 10000 + 1
