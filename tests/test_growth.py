"""Work that must not grow faster than the rows: passes of a cross-validation, candidates of a search, sorts of a rank correlation."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.stat import Correlation
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from tickwise.operators import regress, search, stats
from tickwise.sources.files import assemble

# cross-validation of linear models


def _lines(spark, n=400):
    rng = np.random.RandomState(5)
    x = rng.normal(size=(n, 3)) * (1, 1e4, 0.01) + (0, 1e6, 0.05)
    y = x @ (3, 0.002, 50) + rng.normal(size=n)
    return spark.createDataFrame([(float(t), *map(float, r), 0.5) for t, r in zip(y, x)], "label double, a double, b double, c double, same double")


def test_linear_cross_validation_equals_the_one_on_rows(spark, monkeypatch):
    monkeypatch.setitem(regress.GRIDS, "few", {"lr": {"maxIter": [5, 30], "regParam": [0.1, 0.9], "elasticNetParam": [0.0, 0.6]}})
    data = assemble(_lines(spark), ["a", "b", "c", "same"]).cache()
    cv = regress.cross_validate(data, "lr", preset="few", seed=7, parallelism=4)
    est = regress.estimator("lr")
    grid = regress.param_grid(est, "lr", "few")
    want = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=regress.evaluator("rmse"), numFolds=3, seed=7).fit(data)
    np.testing.assert_allclose(cv.avgMetrics, want.avgMetrics, rtol=1e-6)  # Spark ends its descent at a tolerance of 1e-6
    best = regress.best_params(cv.bestModel)
    point = grid[int(np.argmin(want.avgMetrics))]
    assert {p.name: str(v) for p, v in point.items()}.items() <= best.items()
    on_rows = est.copy(point).fit(data)
    np.testing.assert_allclose(cv.bestModel.coefficients.toArray(), on_rows.coefficients.toArray(), rtol=1e-5, atol=1e-9)
    np.testing.assert_allclose(cv.bestModel.summary.rootMeanSquaredError, on_rows.summary.rootMeanSquaredError, rtol=1e-6)
    assert set(best) == set(regress.best_params(on_rows))
    data.unpersist()


def test_linear_cross_validation_reads_its_rows_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(v):
        read.add(1)
        return v

    rows = _lines(spark).withColumn("a", F.udf(seen, "double").asNondeterministic()("a"))
    regress.cross_validate(assemble(rows, ["a", "b", "c"], handle_invalid="keep"), "lr", preset="small")
    assert read.value == 400


def test_cross_validation_of_rows_that_cannot_be_condensed(spark):
    data = assemble(_lines(spark, 30), ["a", "b", "c"])
    assert regress.condensed(data.limit(1), "features", "label", 3, 1) is None
    assert regress.condensed(data.limit(0), "features", "label", 3, 1) is None
    assert regress.condensed(data.withColumn("label", F.when(F.col("a") > 0, F.col("label"))), "features", "label", 3, 1) is None
    assert regress.condensed(data.withColumn("label", F.lit(float("inf"))), "features", "label", 3, 1) is None


# symbol search


def _listed(spark, n):
    return spark.range(n).select(F.concat(F.lit("P"), F.col("id").cast("string")).alias("ticker"), F.lit("large ring").alias("name"), F.lit("x").alias("sector"))


def test_candidates_of_ticker_searches_grow_with_the_tickers(spark):
    """No search of a ticker meets a fixed share of all: 8 times the tickers, not 64 times the candidates."""
    few, many = (_candidates(spark, n) for n in (1000, 8000))
    assert many < 16 * few


def _candidates(spark, n):
    listed = _listed(spark, n)
    return search.symbol_index(listed).candidates(listed.select(F.col("ticker").alias("query"))).count()


def test_a_profile_hit_by_ticker_and_name_is_one(spark):
    rows = [("ring", "ring", 1), ("ring", "ring", 1), ("a", "ring", 2), ("ringer", "RING two", 3), ("b", None, 4), (None, "ring", 5)]
    df = spark.createDataFrame(rows, "ticker string, name string, k int")
    queries = spark.createDataFrame([("ring",), ("Ring T",)], "query string")
    for limit in (2, 4, 10):
        found = search.symbol_index(df.withColumn("sector", F.lit(""))).search(queries, limit).where("query = 'ring'").orderBy("rank").collect()
        want = [(None, "ring"), ("a", "ring"), ("ring", "ring"), ("ring", "ring"), ("ringer", "RING two")][:limit]
        assert [(r["ticker"], r["name"]) for r in found] == want


# rank correlation


def _ties(spark, n):
    rng = np.random.RandomState(9)
    nan, none = float("nan"), None
    rows = [(float(rng.randint(4)), float(rng.normal()), int(rng.randint(50)), float(i % 3) - 1) for i in range(n)]
    rows += [(nan, 1.0, 1, 0.0), (1.0, none, 2, 0.0), (1.0, 2.0, none, 0.0), (2.0, float("inf"), 7, -0.0)]
    return spark.createDataFrame(rows, "a double, b double, c int, d double")


@pytest.mark.parametrize("broadcast", [0, 200_000])
def test_spearman_by_counted_values_equals_spark_ml(spark, monkeypatch, broadcast):
    monkeypatch.setattr(stats, "BROADCAST_VALUES", broadcast)
    df = _ties(spark, 500)
    got = {(r["feature_a"], r["feature_b"]): r["r"] for r in stats.vector_correlation(df, df.columns, "spearman").collect()}
    want = Correlation.corr(assemble(df, df.columns).select("features"), "features", "spearman").head()[0].toArray()
    for i, a in enumerate(df.columns):
        np.testing.assert_allclose([got[a, b] for b in df.columns], want[i], atol=1e-12)


def test_spearman_orders_different_values_only(spark, monkeypatch):
    ordered, sliced = [], stats.sliced

    def seen(df, *args):
        ordered.append(df.count())
        return sliced(df, *args)

    monkeypatch.setattr(stats, "sliced", seen)
    df = spark.range(6000).select((F.col("id") % 7).alias("a"), (F.col("id") % 50).alias("b"))
    assert stats.vector_correlation(df, ["a", "b"], "spearman").count() == 4
    assert ordered == [57]
