"""Studies from sufficient statistics against row-by-row fits and Spark ML."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tickwise.operators import regress, study

COLS = ["x0", "x1", "x2", "x3"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.RandomState(1)
    rows = []
    for name, level in (("a", 0.0), ("b", 1e6), (None, 5.0)):
        x = rng.randn(90, 4) * [1, 30, 0.1, 1] + level
        x[:, 3] = 7.0  # constant
        y = 3 * x[:, 0] - 0.2 * x[:, 1] + rng.randn(90) + level
        rows += [(name, i, *map(float, x[i]), float(y[i])) for i in range(90)]
    rows += [("a", 90, None, 1.0, 1.0, 1.0, 1.0), ("a", 91, 1.0, 1.0, 1.0, 1.0, float("nan")), ("lonely", 0, 1.0, 2.0, 3.0, 7.0, 5.0)]
    return spark.createDataFrame(rows, "company string, id int, x0 double, x1 double, x2 double, x3 double, y double")


SPEC = study.StudySpec(runs=3, axes={"maxIter": [1, 400], "regParam": [0.05, 0.6], "elasticNetParam": [0.0, 0.5, 1.0]})
def PART(run):
    return F.pmod(F.col("id") + run, F.lit(4)).cast("int") - 1



def by_rows(x, y, reg, alpha, sweeps):
    """Coordinate descent on the rows themselves, with Spark ML's scaling."""
    sx, sy = x.std(axis=0), y.std()
    keep = sx > 1e-9
    z, v = (x - x.mean(axis=0))[:, keep] / sx[keep], (y - y.mean()) / sy
    b, n = np.zeros(keep.sum()), len(y)
    for _ in range(sweeps):
        for j in range(len(b)):
            r = z[:, j] @ (v - z @ b + z[:, j] * b[j]) / n
            b[j] = np.sign(r) * max(abs(r) - reg / sy * alpha, 0) / (z[:, j] @ z[:, j] / n + reg / sy * (1 - alpha))
    w = np.zeros(x.shape[1])
    w[keep] = b * sy / sx[keep]
    return w, y.mean() - w @ x.mean(axis=0)


def test_study_equals_fits_on_rows(frame):
    got = {(r["company"], r["run"]): r for r in study.elastic_net_study(frame, "company", COLS, "y", SPEC, PART).collect()}
    data = [r for r in frame.collect() if None not in r[1:] and r["y"] == r["y"]]
    for name in ("a", "b", None):
        own = [r for r in data if r["company"] == name]
        x, y, i = np.array([[r[c] for c in COLS] for r in own]), np.array([r["y"] for r in own]), np.array([r["id"] for r in own])
        for run in range(SPEC.runs):
            part = (i + run) % 4 - 1
            error = lambda m, w, b: float(np.sqrt(np.mean((y[m] - x[m] @ w - b) ** 2)))
            cv = [np.mean([error(part == f, *by_rows(x[(part != f) & (part >= 0)], y[(part != f) & (part >= 0)], r, a, m)) for f in range(3)])
                  for m, r, a in SPEC.points]
            k = next(j for j, c in enumerate(cv) if c <= min(cv) * (1 + 1e-7))
            w, b = by_rows(x[part >= 0], y[part >= 0], SPEC.points[k][1], SPEC.points[k][2], SPEC.points[k][0])
            r = got[(name, run)]
            assert [float(r["params"][p]) for p in study.AXES] == list(SPEC.points[k])
            assert r["cv_rmse"] == pytest.approx(cv[k], rel=1e-5) and r["rmse"] == pytest.approx(error(part < 0, w, b), rel=1e-5)
            assert r["coefficients"] == pytest.approx(w.tolist(), abs=1e-5) and r["intercept"] == pytest.approx(b, rel=1e-4, abs=1e-4)
            assert (r["n_train"], r["n_test"]) == (int((part >= 0).sum()), int((part < 0).sum()))
    assert all(got[("lonely", run)]["coefficients"] == [0.0] * 4 for run in range(3))


def test_solver_equals_spark_ml(frame):
    own = frame.where("company = 'a'").na.drop().where("NOT isnan(y)")
    x = np.array([[r[c] for c in COLS[:3]] for r in own.collect()])
    y = np.array([r["y"] for r in own.collect()])
    z = np.column_stack([np.ones(len(y)), x - x.mean(axis=0), y - y.mean()])
    vectors = VectorAssembler(inputCols=COLS[:3], outputCol="features").transform(own)
    for reg, alpha in ((0.3, 0.8), (0.9, 0.0), (0.1, 1.0)):
        (_, w, _), = study.Problems((z.T @ z)[None]).solve(np.array([(reg, alpha)]), [500])
        model = LinearRegression(labelCol="y", maxIter=500, tol=1e-12, regParam=reg, elasticNetParam=alpha).fit(vectors)
        assert w[0, 0].tolist() == pytest.approx(model.coefficients.toArray().tolist(), abs=1e-4)


def test_hashed_parts_hold_out_the_rows_of_hash_split(frame):
    spec = study.StudySpec(runs=2, seed0=77)
    cols = ["y", "x0"]
    part = study.hashed_part([F.col(c) for c in cols], spec)
    for run in range(2):
        _, test = regress.hash_split(frame, cols, spec.test_fraction, 77 + run)
        held = frame.where(part(F.lit(run)) == study.TEST)
        assert sorted(map(tuple, held.select("company", "id").collect()), key=str) == sorted(map(tuple, test.select("company", "id").collect()), key=str)
        folds = {r[0]: r[1] for r in frame.groupBy(part(F.lit(run)).alias("p")).count().collect()}
        assert set(folds) == {-1, 0, 1, 2} and min(folds.values()) > 20


def test_grid_has_the_study_size_and_experiment_uses_it(frame):
    assert len(study.StudySpec().points) == 120 and len(study.StudySpec(axes=study.axes_of("notebook")).points) == 144
    out = regress.experiment(frame.na.drop(), ["a", "b"], ["lr"], 4, COLS[:2], "y", "small").collect()
    assert sorted((r["company"], r["run"]) for r in out) == [(c, r) for c in "ab" for r in range(4)] and all(0 < r["rmse"] < 3 for r in out)
