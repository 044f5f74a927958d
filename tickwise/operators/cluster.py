"""Company clustering (M22): per-company features -> StandardScaler -> KMeans.

The feature table is one aggregate over the price history (one row per
company); clustering runs on that small table with Spark ML.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.session import cut_lineage, ship_package

FEATURE_COLUMNS = ("mean_return", "volatility", "avg_volume", "mean_close")


def company_features(prices: DataFrame) -> DataFrame:
    """Mean and std of the daily relative change, average volume and close per company."""
    r = F.col("changeOverTime")
    return prices.groupBy("company").agg(
        F.avg(r).alias("mean_return"),
        F.stddev_samp(r).alias("volatility"),
        F.avg("volume").alias("avg_volume"),
        F.avg("close").alias("mean_close"),
    )


def mean_correlation(prices: DataFrame) -> DataFrame:
    """(company, mean_correlation): mean correlation of a company's daily changes with those of every other company.

    With standardised changes z the correlations of a company with all others
    add up to the sum over its days of z * (market - z), where market is the
    day's sum of all companies: two aggregates and no pairs of companies.  A
    day that another company lacks counts as its mean, so histories of unequal
    days distort it (``pairwise_correlation`` has no such fault, at the price of
    a product per pair).  NULL for a constant company and for the only one.
    """
    r = F.col("changeOverTime")
    moments = prices.groupBy("company").agg(F.avg(r).alias("_mean"), F.stddev_pop(r).alias("_std"), F.count(r).alias("_days"))
    varied = moments.where("_std > 0")
    others = varied.count() - 1  # one number
    z = prices.where(r.isNotNull()).join(varied, "company").select("company", "date", "_days", ((r - F.col("_mean")) / F.col("_std")).alias("_z"))
    market = z.groupBy("date").agg(F.sum("_z").alias("_market"))
    shared = z.join(market, "date").groupBy("company").agg(
        F.try_divide(F.sum(F.col("_z") * (F.col("_market") - F.col("_z"))), F.first("_days") * F.lit(others)).alias("mean_correlation"))
    return moments.select("company").join(shared, "company", "left")


#: Companies of one block in the pairwise correlations.
BLOCK = 256


def pairwise_correlation(prices: DataFrame, block: int = BLOCK) -> DataFrame:
    """(company, partners, mean_correlation): the mean of a company's correlations with every other, each over the days both have.

    Always within -1 and 1, whatever days the histories hold.  Companies are
    dealt into blocks; every pair of blocks is one task with two matrices of
    block x days, whose products give the moments of all its pairs, and only
    sums per company leave it.  A correlation needs two shared days and two
    changing histories on them; ``partners`` counts those that have one, and
    the mean is NULL without any.  NaN counts as missing; the last row by
    value stands for repeated days of a company; no company has no row.
    """
    ship_package(prices.sparkSession)
    days = prices.where("company IS NOT NULL AND date IS NOT NULL").groupBy("company", "date").agg(
        F.max(F.nanvl("changeOverTime", F.lit(None).cast("double"))).alias("r"))
    days = cut_lineage(days)
    series = days.where("r IS NOT NULL").groupBy("company").agg(  # a company's calendar: bounded by its days
        F.collect_list(F.unix_date(F.col("date").cast("date"))).alias("day"), F.collect_list("r").alias("r"))
    numbered = cut_lineage(series)
    blocks = max(1, -(-numbered.count() // block))
    dealt = numbered.withColumn("block", F.pmod(F.xxhash64("company"), F.lit(blocks)).cast("int"))
    # a block meets every other once: as the first of the pair for higher numbers, as the second for lower ones
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pairs = met.select(F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block", "company", "day", "r")
    sums = pairs.groupBy("a", "b").applyInPandas(_block_sums, "company string, n long, total double")
    mean = sums.groupBy("company").agg(F.sum("n").alias("partners"), F.sum("total").alias("_total"))
    return days.select("company").distinct().join(mean, "company", "left").select(
        "company", F.coalesce("partners", F.lit(0)).alias("partners"), F.try_divide("_total", F.col("partners")).alias("mean_correlation"))


def _matrix(rows: pd.DataFrame, days: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values (centred on each company's own mean, 0 where missing) and presence, companies x days."""
    x, have = np.zeros((len(rows), len(days))), np.zeros((len(rows), len(days)))
    for i, (day, r) in enumerate(zip(rows["day"], rows["r"])):
        at = np.searchsorted(days, np.asarray(day))
        r = np.asarray(r, np.float64)
        x[i, at] = r - r.mean()
        have[i, at] = 1.0
    return x, have


def correlations(left: pd.DataFrame, right: pd.DataFrame) -> np.ndarray:
    """Pearson correlations of all rows of ``left`` with those of ``right`` on shared days; NaN where undefined."""
    days = np.unique(np.concatenate([np.asarray(d) for d in (*left["day"], *right["day"])]))
    (x, hx), (y, hy) = _matrix(left, days), _matrix(right, days)
    n, sx, sy = hx @ hy.T, x @ hy.T, hx @ y.T
    sxx, syy = (x * x) @ hy.T, hx @ (y * y).T
    with np.errstate(divide="ignore", invalid="ignore"):
        vx, vy = sxx - sx * sx / n, syy - sy * sy / n
        r = (x @ y.T - sx * sy / n) / np.sqrt(vx * vy)
    still = (n < 2) | (vx <= 1e-12 * np.maximum(sxx, 1e-300)) | (vy <= 1e-12 * np.maximum(syy, 1e-300))
    return np.where(still, np.nan, np.clip(r, -1.0, 1.0))


def _block_sums(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    a, b = key
    pdf = pdf.sort_values("company")
    left, right = pdf[pdf["block"] == a], pdf[pdf["block"] == b]
    if not len(left) or not len(right):
        return pd.DataFrame({"company": [], "n": [], "total": []}).astype({"company": str, "n": "int64", "total": float})
    r = correlations(left, right)
    if a == b:
        np.fill_diagonal(r, np.nan)
    has = ~np.isnan(r)
    parts = [(left, has.sum(axis=1), np.nansum(r, axis=1))] + ([] if a == b else [(right, has.sum(axis=0), np.nansum(r, axis=0))])
    return pd.concat([pd.DataFrame({"company": side["company"].to_numpy(), "n": n.astype("int64"), "total": t}) for side, n, t in parts])


def cluster(features: DataFrame, k: int = 3, seed: int = 42, method: str = "kmeans",
            columns: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """(company, cluster) with standardised features; NULL for a company with an undefined feature."""
    algo = (KMeans(k=k, seed=seed, featuresCol="scaled", predictionCol="cluster") if method == "kmeans"
            else BisectingKMeans(k=k, seed=seed, featuresCol="scaled", predictionCol="cluster"))
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=list(columns), outputCol="raw", handleInvalid="skip"),
        StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True),
        algo,
    ])
    model = pipe.fit(features)
    return features.select("company").join(model.transform(features).select("company", "cluster"), "company", "left")


def silhouette_by_k(features: DataFrame, ks: Sequence[int] = (2, 3, 4, 5), seed: int = 42,
                    columns: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Silhouette score for each k (choose k)."""
    prep = Pipeline(stages=[
        VectorAssembler(inputCols=list(columns), outputCol="raw", handleInvalid="skip"),
        StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True),
    ]).fit(features).transform(features).cache()
    ev = ClusteringEvaluator(featuresCol="scaled", predictionCol="cluster")
    rows = []
    for k in ks:
        m = KMeans(k=k, seed=seed, featuresCol="scaled", predictionCol="cluster").fit(prep)
        rows.append((int(k), float(ev.evaluate(m.transform(prep)))))
    prep.unpersist()
    return features.sparkSession.createDataFrame(rows, "k INT, silhouette DOUBLE")
