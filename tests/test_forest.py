"""The forest on long tables against Spark ML's, and what it reads and keeps."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from tickwise.operators import forest, regress
from tickwise.sources.files import assemble


def _rows(spark, n=2048, seed=3):
    """Few-valued features and whole labels, so that sums are exact in any order."""
    rng = np.random.RandomState(seed)
    a, b, c = rng.randint(0, 20, n), rng.randint(0, 7, n), rng.normal(size=n).round(1)
    y = 5 * a + 30 * (b > 3) + (10 * c).astype(int) + rng.randint(0, 9, n)
    rows = [(i, float(t), *map(float, x)) for i, (t, *x) in enumerate(zip(y, a, b, c))]
    return spark.createDataFrame(rows, "id long, label double, a double, b double, c double")


def _predicted(model, data):
    return [r[0] for r in model.transform(data).orderBy("id").select("prediction").collect()]


@pytest.mark.parametrize("depth, least", [(1, 1), (4, 1), (8, 1), (6, 20)])
def test_tree_without_draws_is_spark_mls(spark, depth, least):
    data = assemble(_rows(spark), ["a", "b", "c"]).cache()
    own = dict(numTrees=1, maxDepth=depth, maxBins=128, minInstancesPerNode=least, bootstrap=False)
    model = forest.Forest(**own).fit(data)
    want = RandomForestRegressor(**own).fit(data)
    np.testing.assert_allclose(_predicted(model, data), _predicted(want, data), rtol=1e-12)
    np.testing.assert_allclose(model.featureImportances.toArray(), want.featureImportances.toArray(), rtol=1e-9)
    data.unpersist()


def test_forest_is_as_good_as_spark_mls(spark):
    rows = _rows(spark, 6000)
    train, test = rows.where("id % 3 > 0"), rows.where("id % 3 = 0")
    own = regress.pipeline(["a", "b", "c"], "rf").fit(train)
    theirs = regress.estimator("rf").fit(assemble(train, ["a", "b", "c"]))
    rmse = regress.evaluator("rmse")
    ours, want = rmse.evaluate(own.transform(test)), rmse.evaluate(theirs.transform(assemble(test, ["a", "b", "c"])))
    assert ours < 1.1 * want
    np.testing.assert_allclose(own.stages[-1].featureImportances.toArray(), theirs.featureImportances.toArray(), atol=0.12)


def test_forest_reads_its_rows_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(v):
        read.add(1)
        return v

    rows = _rows(spark, 400).withColumn("a", F.udf(seen, "double").asNondeterministic()("a"))
    regress.pipeline(["a", "b", "c"], "rf").fit(rows)
    assert read.value == 400


def test_forest_does_not_depend_on_partitions_or_passes(spark, monkeypatch):
    data = assemble(_rows(spark), ["a", "b", "c"])
    fit = forest.Forest(numTrees=3, maxDepth=7)
    whole = fit.fit(data.repartition(1))
    parts = fit.fit(data.repartition(7, "c"))
    monkeypatch.setattr(forest, "SUMS", 1)  # a pass per block of open nodes
    passes = fit.fit(data.repartition(2))
    for other in (parts, passes):
        assert _predicted(other, data) == _predicted(whole, data)
        assert other.featureImportances == whole.featureImportances
    assert len({tuple(np.round(whole.nodes.value[whole.nodes.tree == t], 9)) for t in range(3)}) == 3  # trees differ


def test_draws_are_poisson_counts():
    h = np.random.RandomState(1).randint(0, 2**62, 200_000).astype(np.uint64)
    counts = np.stack(list(forest.draws(h, 5))).astype(int)
    np.testing.assert_allclose(counts.mean(axis=1), 1, atol=0.02)
    np.testing.assert_allclose(counts.var(axis=1), 1, atol=0.03)
    assert np.abs(np.corrcoef(counts) - np.eye(5)).max() < 0.02
    np.testing.assert_allclose((counts == 0).mean(axis=1), np.exp(-1), atol=0.01)


def test_cuts_of_many_values_are_quantiles_of_all_rows(spark):
    rows = spark.range(20_000).select(F.col("id").cast("double").alias("x0"), (F.col("id") % 3).cast("double").alias("x1"), F.lit(1.0).alias("y"))
    (many, few), mean, n = forest.value_cuts(rows, ["x0", "x1"], 32)
    np.testing.assert_allclose(many, np.arange(1, 32) * 625, atol=20)
    assert few.tolist() == [0.5, 1.5] and mean == 1 and n == 20_000


def test_forest_of_odd_rows(spark):
    def data(*rows):
        return assemble(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, label double, a double, b double"), ["a", "b"])

    inf = float("inf")
    one = forest.Forest(numTrees=1, bootstrap=False)
    assert _predicted(one.fit(data((4.0, 1.0, 2.0))), data((0.0, 5.0, 5.0))) == [4.0]
    assert _predicted(forest.Forest(numTrees=3).fit(data((4.0, 1.0, 2.0))), data((0.0, 5.0, 5.0))) == [4.0]  # also trees that drew nothing
    same = data(*[(0.1, float(i), 1.0) for i in range(9)])
    assert _predicted(one.fit(same), same) == pytest.approx([0.1] * 9)
    ends = data((1.0, -inf, 0.0), (2.0, 0.0, 0.0), (3.0, inf, 0.0))
    assert _predicted(one.fit(ends), ends) == pytest.approx([1.0, 2.0, 3.0])
    flat = forest.Forest(numTrees=1, bootstrap=False, maxDepth=0).fit(ends)
    assert _predicted(flat, ends) == pytest.approx([2.0] * 3) and not flat.featureImportances.toArray().any()
    with pytest.raises(ValueError):
        one.fit(ends.limit(0))
    with pytest.raises(Exception, match="labels must not be null"):
        one.fit(data((1.0, 1.0, 1.0), (None, 2.0, 1.0)))
    with pytest.raises(ValueError):
        forest.Forest(maxBins=1)
