"""Regression with Spark ML.

Models are Spark ML estimators over distributed DataFrames.  Per-company
experiments (M14/M15) are launched from a bounded driver thread pool: each
job is a normal distributed Spark job; only scalar results (RMSE, chosen
parameters) come back to the driver.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce
from itertools import product
from operator import add
from typing import Callable, Optional, Sequence

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.regression import GBTRegressor, IsotonicRegression, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.operators.forest import Forest
from tickwise.session import cut_lineage
from tickwise.sources.files import assemble, scratch

ALGOS = ("lr", "gbr", "ir", "rf")


# ---------------------------------------------------------------------------
# M2: splits


def random_split(df: DataFrame, test_fraction: float = 0.3, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Seeded ``randomSplit([1 - v, v])``."""
    train, test = df.randomSplit([1.0 - test_fraction, test_fraction], seed=seed)
    return train, test


def hash_split(df: DataFrame, keys: Sequence[str], test_fraction: float = 0.3, seed: int = 42
               ) -> tuple[DataFrame, DataFrame]:
    """Deterministic split on a hash of the row keys: stable under repartitioning
    and executor loss (a retried task puts every row on the same side)."""
    bucket = F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), F.lit(10000))
    cut = int(round((1.0 - test_fraction) * 10000))
    return df.filter(bucket < cut), df.filter(bucket >= cut)


def modulo_split(df: DataFrame, key: str, test_fraction: float = 0.3) -> tuple[DataFrame, DataFrame]:
    """Deterministic split on an integer key: a row is held out if key mod 100 is below the test percentage."""
    percent = int(round(test_fraction * 100))
    test = F.pmod(F.col(key), F.lit(100)) < percent
    return df.filter(~test), df.filter(test)


def time_split(df: DataFrame, test_fraction: float = 0.2, by: Sequence[str] = ("company",), order: str = "date"
               ) -> tuple[DataFrame, DataFrame]:
    """Last ``test_fraction`` of each series (by time) is the test set.

    Windows over one company's daily series (bounded by the calendar).
    """
    pr = F.percent_rank().over(Window.partitionBy(*by).orderBy(order))
    tagged = df.withColumn("_pr", pr)
    cut = 1.0 - test_fraction
    return (tagged.filter(F.col("_pr") < cut).drop("_pr"), tagged.filter(F.col("_pr") >= cut).drop("_pr"))


def lagged_features(prices: DataFrame, features: Sequence[str], lag: int = 1, by: Sequence[str] = ("company",),
                    order: str = "date", prefix: str = "prev_") -> tuple[DataFrame, list[str]]:
    """Leakage-free feature set: the features of ``lag`` rows earlier in the same series.

    Same-day high/low/open/vwap "predict" the same day's close (the parity
    feature set); these lagged columns only use information known the day
    before.  Window per company over its daily series.
    """
    w = Window.partitionBy(*by).orderBy(order)
    names = [f"{prefix}{f}" for f in features]
    out = prices.select("*", *[F.lag(f, lag).over(w).alias(n) for f, n in zip(features, names)])
    return out.filter(F.col(names[0]).isNotNull()), names


# ---------------------------------------------------------------------------
# M3-M6 estimators and M8 grids

FOREST = dict(numTrees=15, impurity="variance", maxDepth=10, maxBins=64)


def estimator(algo: str, features: str = "features", label: str = "label", seed: int = 42, **params):
    """Estimator with the reference's fixed defaults (overridable)."""
    if algo == "lr":
        base = dict(maxIter=10, regParam=0.3, elasticNetParam=0.8)
        return LinearRegression(featuresCol=features, labelCol=label, **{**base, **params})
    if algo == "gbr":
        return GBTRegressor(featuresCol=features, labelCol=label, seed=seed, **{**dict(maxIter=10), **params})
    if algo == "rf":
        return RandomForestRegressor(featuresCol=features, labelCol=label, seed=seed, **{**FOREST, **params})
    if algo == "ir":
        return IsotonicRegression(featuresCol=features, labelCol=label, **params)
    raise ValueError(algo)


# The study's parameter grids (evenly spaced floats as start, stop, count).
GRIDS = {
    "full": {
        "lr": {"maxIter": [5, 16, 27, 38, 50], "regParam": (0.1, 0.9, 4), "elasticNetParam": (0.01, 1.0, 6)},
        "gbr": {"maxIter": [5, 10, 30], "maxDepth": [10], "maxBins": [32]},
        "rf": {"numTrees": [10, 30, 50], "maxDepth": [5, 15, 25]},
        "ir": {"isotonic": [True, False]},
    },
    "notebook": {
        "lr": {"maxIter": [5, 10, 15, 20, 25, 30], "regParam": (0.1, 0.9, 4), "elasticNetParam": (0.01, 1.0, 6)},
        "gbr": {"maxIter": [5], "maxDepth": [3]},
        "rf": {"numTrees": [10, 30, 50], "maxDepth": [5, 15, 25]},
        "ir": {"isotonic": [True, False]},
    },
    "small": {
        "lr": {"regParam": [0.1, 0.9]},
        "gbr": {"maxIter": [5], "maxDepth": [3]},
        "rf": {"numTrees": [10], "maxDepth": [5]},
        "ir": {"isotonic": [True, False]},
    },
}
GRIDS["study"] = GRIDS["full"]


def param_grid(est, algo: str, preset: str = "full") -> list[dict]:
    """M8: every combination of an algorithm's values in ``GRIDS``."""
    axes = {name: np.linspace(*v).tolist() if isinstance(v, tuple) else v for name, v in GRIDS[preset][algo].items()}
    return [{est.getParam(name): value for name, value in zip(axes, point)} for point in product(*axes.values())]


def pipeline(features: Sequence[str], algo: str, label: str = "label", seed: int = 42, **params) -> Pipeline:
    """M7: assemble + model.  The forest is ``forest.Forest``, which Spark ML's equals but for its draws."""
    from pyspark.ml.feature import VectorAssembler

    model = Forest(label=label, seed=seed, **{**FOREST, **params}) if algo == "rf" else estimator(algo, label=label, seed=seed, **params)
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip"),
        model,
    ])


def evaluator(metric: str = "rmse", label: str = "label") -> RegressionEvaluator:
    """M10 (Spark ML form)."""
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)


def cross_validate(train: DataFrame, algo: str, preset: str = "full", seed: int = 42, folds: int = 3,
                   parallelism: int = 2, features: str = "features", label: str = "label"):
    """M9: k-fold CV on RMSE over the preset grid (input should be cached by the caller, but for ``lr``).

    Linear fits see their rows only through ``condensed`` ones, so ``lr`` reads ``train`` once for all points and folds.
    The best model's summary is weighted: its errors are those of all rows, its instances the condensed ones.
    """
    est, score = estimator(algo, features=features, label=label, seed=seed), evaluator("rmse", label)
    own = dict(estimatorParamMaps=param_grid(est, algo, preset), numFolds=folds, seed=seed, parallelism=parallelism)
    few = condensed(train, features, label, folds, seed) if algo == "lr" else None
    if few is not None:
        return CrossValidator(estimator=est.setWeightCol("weight"), evaluator=score.setWeightCol("weight"), foldCol="fold", **own).fit(few)
    return CrossValidator(estimator=est, evaluator=score, **own).fit(train)


def condensed(rows: DataFrame, features: str, label: str, folds: int, seed: int) -> Optional[DataFrame]:
    """(fold, weight, features, label): two weighted rows per column and fold, with the weight, means and covariances of the fold's rows.

    Squared errors of linear models depend on nothing else, so fits and RMSEs on any union of folds are those on its rows.
    One aggregate over the rows; folds are drawn as ``CrossValidator`` draws them.  None if a fold is empty or a value is missing or not finite.
    """
    k = rows.schema[features].metadata.get("ml_attr", {}).get("num_attrs")
    if k is None:
        first = rows.select(features).first()
        k = len(first[0]) if first and first[0] is not None else 0
    if not k:
        return None
    draw = F.col("_draw")
    fold = reduce(add, [(draw >= i * (1.0 / folds)).cast("int") for i in range(1, folds)], F.lit(0))
    nan = F.lit(float("nan"))
    cols = [f"v{i}" for i in range(k + 1)]
    drawn = rows.select("*", F.rand(seed).alias("_draw")).select(
        fold.alias("fold"), vector_to_array(F.col(features)).alias("_v"), F.coalesce(F.col(label).cast("double"), nan).alias(cols[-1]))
    flat = drawn.select("fold", *[F.coalesce(F.col("_v")[i], nan).alias(c) for i, c in enumerate(cols[:-1])], cols[-1])
    # the mean of a constant column is its value, without rounding
    means = [F.when(F.var_pop(c) == 0, F.min(c)).otherwise(F.avg(c)) for c in cols]
    covs = [F.covar_pop(a, b) if a != b else F.var_pop(a) for i, a in enumerate(cols) for b in cols[i:]]
    sums = flat.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.array(*means).alias("mean"), F.array(*covs).alias("cov")).orderBy("fold").collect()
    if len(sums) < folds or not all(np.isfinite([*r["mean"], *r["cov"]]).all() for r in sums):
        return None
    few = []
    for r in sums:
        cov, m = np.zeros((k + 1, k + 1)), np.array(r["mean"])
        cov[np.triu_indices(k + 1)] = r["cov"]
        sd = np.sqrt(np.diag(cov))
        per = np.divide(1, sd, out=np.zeros_like(sd), where=sd > 0)
        values, axes = np.linalg.eigh((cov + np.triu(cov, 1).T) * per[:, None] * per, UPLO="U")
        steps = sd[:, None] * axes * np.sqrt((k + 1) * np.maximum(values, 0))
        few += [(r["fold"], r["n"] / (2 * k + 2), Vectors.dense(z[:-1]), float(z[-1])) for s in steps.T for z in (m + s, m - s)]
    schema = T.StructType([T.StructField("fold", T.IntegerType()), T.StructField("weight", T.DoubleType()),
                           T.StructField(features, VectorUDT()), T.StructField(label, T.DoubleType())])
    return rows.sparkSession.createDataFrame(few, schema).coalesce(1)


# ---------------------------------------------------------------------------
# Model introspection as DataFrames


def best_params(model) -> dict[str, str]:
    """The explicitly set parameters of a fitted model as strings."""
    return {p.name: str(v) for p, v in model.extractParamMap().items()
            if p.name not in ("featuresCol", "labelCol", "predictionCol", "weightCol")}


def params_frame(spark, model) -> DataFrame:
    rows = sorted(best_params(model).items())
    return spark.createDataFrame(rows, "param STRING, value STRING")


def coefficients_frame(spark, model, feature_names: Sequence[str]) -> DataFrame:
    """(feature, coefficient) rows plus the intercept."""
    rows = [(n, float(c)) for n, c in zip(feature_names, model.coefficients.toArray())]
    rows.append(("(intercept)", float(model.intercept)))
    return spark.createDataFrame(rows, "feature STRING, coefficient DOUBLE")


def summary_frame(spark, model) -> DataFrame:
    """Iterations, objective history, RMSE and R^2 of the training summary."""
    s = model.summary
    rows = [("iterations", float(s.totalIterations)), ("rmse", float(s.rootMeanSquaredError)),
            ("r2", float(s.r2))]
    rows += [(f"objective_{i}", float(v)) for i, v in enumerate(s.objectiveHistory)]
    return spark.createDataFrame(rows, "metric STRING, value DOUBLE")


def importances_frame(spark, model, feature_names: Sequence[str]) -> DataFrame:
    """Feature importances by name, most important first."""
    imp = model.featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(feature_names, imp)]
    return spark.createDataFrame(rows, "feature STRING, importance DOUBLE").orderBy(F.desc("importance"), "feature")


def predicted_vs_actual(pred: DataFrame, keys: Sequence[str], label: str = "label") -> DataFrame:
    """The data behind a predicted-vs-actual plot (keys, label, prediction)."""
    return pred.select(*keys, F.col(label).alias("label"), "prediction")


# ---------------------------------------------------------------------------
# Per-company best regressor, repeated experiments


@dataclass(frozen=True)
class FitResult:
    company: str
    algo: str
    run: int
    rmse: float
    params: dict
    model: object = None  # the fitted best model


def fit_best(df: DataFrame, algo: str, features: Sequence[str], label: str = "close", preset: str = "full",
             seed: int = 42, test_fraction: float = 0.3, company: str = "", run: int = 0,
             feature_index: Optional[int] = None, isotonic_feature: Optional[str] = None, parallelism: int = 2):
    """Split -> grid -> CV -> best model -> test RMSE.  Returns (FitResult with the model, predictions).

    The split hashes the row's own values, so a recomputed source puts every row on the same side.

    Isotonic regression uses one feature: ``isotonic_feature`` names it
    (default: the first feature, as Spark's ``featureIndex=0``).
    """
    if isotonic_feature is not None:
        feature_index = list(features).index(isotonic_feature)
    data = assemble(df.select(F.col(label).cast("double").alias("label"), *features), list(features))
    train, test = hash_split(data, ["label", *features], test_fraction, seed)
    train = train.cache()
    try:
        est = estimator(algo, seed=seed)
        if algo == "ir" and feature_index is not None:
            est = est.setFeatureIndex(int(feature_index))
        cv = CrossValidator(estimator=est, estimatorParamMaps=param_grid(est, algo, preset),
                            evaluator=evaluator("rmse"), numFolds=3, seed=seed, parallelism=parallelism)
        model = cv.fit(train)
        pred = model.transform(test)
        rmse = float(evaluator("rmse").evaluate(pred))
        return FitResult(company, algo, run, rmse, best_params(model.bestModel), model.bestModel), pred
    finally:
        train.unpersist()


def per_company(prices: DataFrame, columns: Sequence[str]) -> Callable[[str], DataFrame]:
    """Company -> its rows, from one copy of the needed columns with a folder per company: a fit reads its own folder only."""
    folder = scratch(prices.sparkSession, "company-rows")
    rows = prices.select("company", *columns).withColumn("_folder", F.xxhash64("company"))
    rows.repartition("_folder").write.partitionBy("_folder").parquet(folder)
    stored = prices.sparkSession.read.schema(rows.schema).parquet(folder)
    return lambda c: stored.where((F.col("_folder") == F.xxhash64(F.lit(c))) & (F.col("company") == c)).drop("_folder")


def experiment(prices: DataFrame, companies: Sequence[str], algos: Sequence[str], runs: int,
               features: Sequence[str], label: str = "close", preset: str = "full", threads: int = 4,
               seed0: int = 1000, on_result: Optional[Callable[[FitResult], None]] = None) -> DataFrame:
    """Repeat M14 ``runs`` times per company and algorithm (distinct seeds).

    ``lr`` is one plan for all companies and runs (``study``).  Of the others
    each (company, algo, run) is an independent distributed job over its
    company's folder; a bounded thread pool keeps a few in flight.  Output: (company, algo, run, rmse).
    """
    spark = prices.sparkSession
    linear = None
    if "lr" in algos:
        from tickwise.operators import study

        spec = study.StudySpec(runs=runs, seed0=seed0, axes=study.axes_of(preset))
        won = cut_lineage(study.elastic_net_study(prices.where(F.col("company").isin(list(companies))), "company", features, label, spec))
        linear = won.select("company", F.lit("lr").alias("algo"), "run", "rmse")
        if on_result:
            for r in won.toLocalIterator():
                on_result(FitResult(r["company"], "lr", r["run"], r["rmse"], r["params"]))
    tasks = [(c, a, r) for c in companies for a in algos for r in range(runs) if a != "lr"]
    if not tasks and linear is not None:
        return linear
    rows = per_company(prices, list(dict.fromkeys([label, *features])))

    def one(task):
        c, a, r = task
        res, _ = fit_best(rows(c), a, features, label, preset,
                          seed=seed0 + r, company=c, run=r)
        if on_result:
            on_result(res)
        return replace(res, model=None)

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        results = list(pool.map(one, tasks))
    schema = T.StructType([T.StructField("company", T.StringType()), T.StructField("algo", T.StringType()),
                           T.StructField("run", T.IntegerType()), T.StructField("rmse", T.DoubleType())])
    others = spark.createDataFrame([(r.company, r.algo, r.run, r.rmse) for r in results], schema)
    return others if linear is None else linear.unionByName(others)
