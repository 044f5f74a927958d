"""A hot key (one company with a third of all rows) must be reduced map-side:
the aggregations below plan a partial aggregate before their shuffle, and the
results stay exact."""

import datetime as dt

from pyspark.sql import functions as F

from tickwise.operators import stats, windows


def _hot_ticks(spark):
    n = 30000
    return (spark.range(n)
            .withColumn("symbol", F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("S"), (F.col("id") % 97).cast("string"))))
            .withColumn("ts", F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 7).cast("timestamp_ntz"))
            .withColumn("price", (F.col("id") % 1000).cast("double") / 10.0))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bars_partial_aggregate_before_shuffle(spark):
    ticks = _hot_ticks(spark)
    b = windows.bars(ticks, "5min")
    plan = _plan(b)
    assert "partial_min_by" in plan and "Exchange" in plan
    assert plan.index("partial_min_by") > plan.index("Exchange")  # partial step sits below the exchange
    hot = b.filter(F.col("symbol") == "HOT").agg(F.sum("volume")).first()[0]
    assert hot == 10000


def test_correlation_partial_aggregate(spark):
    df = _hot_ticks(spark).withColumn("company", F.col("symbol")).withColumn("x2", F.col("price") * 2 + 1)
    out = stats.correlation(df, ["price", "x2"])
    plan = _plan(out)
    assert "partial_corr" in plan or "partial_covar_pop" in plan  # the latter in ANSI mode
    r = {(x.company, x.feature_a, x.feature_b): x.r for x in out.filter(F.col("company") == "HOT").collect()}
    assert abs(r[("HOT", "price", "x2")] - 1.0) < 1e-12


def test_summary_of_hot_group_is_exact(spark):
    df = _hot_ticks(spark).withColumn("company", F.col("symbol")).withColumn("close", F.col("price"))
    d = stats.describe(df, ["close"]).filter(F.col("company") == "HOT").first()
    assert d["count"] == 10000
    assert "partial_" in _plan(stats.describe(df, ["close"], exact=False))


def test_bucketed_average_ranks_equal_window_ranks(spark):
    import random

    rng = random.Random(11)
    rows = [("HOT" if i % 3 == 0 else f"g{i % 5}", float(rng.randint(0, 40)), float(rng.random())) for i in range(3000)]
    df = spark.createDataFrame(rows, "company string, u double, v double")
    a = stats.average_ranks(df, ["u", "v"], ["company"])
    b = stats.average_ranks(df, ["u", "v"], ["company"], buckets=8)
    key = lambda r: (r.company, r.u, r.v)
    assert sorted(a.collect(), key=key) == sorted(b.collect(), key=key)
    ra = {(r.feature_a, r.feature_b, r.company): r.r for r in stats.correlation(df, ["u", "v"], method="spearman").collect()}
    rb = {(r.feature_a, r.feature_b, r.company): r.r
          for r in stats.correlation(df, ["u", "v"], method="spearman", rank_buckets=8).collect()}
    assert ra.keys() == rb.keys() and all(abs(ra[k] - rb[k]) < 1e-12 for k in ra)
