"""User-level entry points (the reference's public surface, E1-E10), DataFrame in/out.

Nothing here fetches data over a network: price history is a DataFrame (see
``tickwise.sources.files`` for readers) with the canonical schema
(company, date, open, high, low, close, adjClose, volume, ...).
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.operators import compare, decide, forecast, metrics, regress, select, stats
from tickwise.operators.select import DateLike
from tickwise.schema import FEATURES, PRICE_COLUMNS, PROFILE_FIELDS


def predict(prices: DataFrame, value: str = "close", periods: int = 90, interval_width: float = 0.95,
            last_days: Optional[int] = 2200, as_of: DateLike = None) -> DataFrame:
    """Forecast ``value`` of every company ``periods`` days ahead (23 columns + training_date)."""
    spec = forecast.ForecastSpec(periods=periods, interval_width=interval_width)
    return decide.predict_values(prices, value, spec, last_days, as_of)


def should_i_buy(prices: DataFrame, classifier: str = "mlp", value: str = "close", periods: int = 90,
                 interval_width: float = 0.95, last_days: Optional[int] = 2200, as_of: DateLike = None,
                 **decide_params) -> DataFrame:
    """BUY(1) / SELL(2) / WAIT(0) predictions per company and day (31 columns)."""
    spec = forecast.ForecastSpec(periods=periods, interval_width=interval_width)
    return decide.decide(prices, value, spec, decide.DecideSpec(classifier=classifier, **decide_params),
                         last_days, as_of)


def company_info(profiles: DataFrame, ticker: str) -> DataFrame:
    """The 9-field profile record of one ticker."""
    return profiles.filter(F.col("ticker") == F.lit(ticker)).select(*PROFILE_FIELDS)


def company_history(prices: DataFrame, ticker: str, start: DateLike, end: DateLike) -> DataFrame:
    """History of one ticker between two dates (inclusive)."""
    return select.history(prices, ticker, start, end)


def last_seven_days(prices: DataFrame, ticker: str, as_of: DateLike = None) -> DataFrame:
    """E5."""
    return select.last_days(prices, 7, as_of, ticker)


def get_company(prices: DataFrame, ticker: str, number_of_days: int = 1825, as_of: DateLike = None) -> DataFrame:
    """Last ``number_of_days`` days of one ticker (empty frame with the schema if none)."""
    return select.last_days(prices, number_of_days, as_of, ticker)


def visualize(prices: DataFrame, columns: Sequence[str] = PRICE_COLUMNS, bins: int = 10) -> dict[str, DataFrame]:
    """The data behind tail / describe / histograms / box plots / correlation heat map."""
    return {
        "tail": select.last_n(prices, 5),
        "describe": stats.describe(prices, columns),
        "histogram": stats.histogram(prices.select("company", *[F.col(c).cast("double").alias(c) for c in columns])
                                     .unpivot(["company"], list(columns), "column", "value"), "value", bins, by=("company", "column")),
        "boxplot": stats.box_stats(prices, list(columns)),
        "correlation": stats.correlation(prices, list(columns)),
    }


def regression_cli(prices: DataFrame, company: str, algo: str = "lr", preset: str = "study", seed: int = 42):
    """One company's best regressor (split -> grid -> 3-fold CV -> test RMSE)."""
    return regress.fit_best(prices.filter(F.col("company") == company), algo, FEATURES, "close", preset,
                            seed=seed, company=company)


def compare_models(prices: DataFrame, companies: Sequence[str], algos: Sequence[str] = ("lr", "gbr", "ir"),
                   runs: int = 25, preset: str = "study", threads: int = 4) -> dict[str, DataFrame]:
    """Repeated experiments (M15) and their statistical comparison."""
    samples = regress.experiment(prices, companies, algos, runs, FEATURES, "close", preset, threads)
    return {
        "samples": samples,
        "normality": compare.normality(samples),
        "rank_sums": compare.verdict(compare.rank_sums(samples)),
        "medians": stats.median_table(samples, "rmse", "company", "algo", list(algos)),
        "means": samples.groupBy("company", "algo").agg(F.avg("rmse").alias("mean_rmse"), F.count("rmse").alias("runs")),
        "boxplot": stats.box_stats(samples, ["rmse"], by=("company", "algo")),
    }


def regression_report(data: DataFrame, features: Sequence[str], label: str = "label", seed: int = 42
                      ) -> dict[str, DataFrame]:
    """Linear regression + GBT on one data set: predictions, metrics, coefficients, summary."""
    train, test = regress.random_split(data, 0.3, seed)
    spark = data.sparkSession
    lr = regress.pipeline(features, "lr", label=label).fit(train)
    gbt = regress.pipeline(features, "gbr", label=label, seed=seed).fit(train)
    lr_pred, gbt_pred = lr.transform(test), gbt.transform(test)
    return {
        "lr_predictions": lr_pred.select(label, "prediction"),
        "gbt_predictions": gbt_pred.select(label, "prediction"),
        "lr_metrics": metrics.regression_metrics(lr_pred, label),
        "gbt_metrics": metrics.regression_metrics(gbt_pred, label),
        "lr_coefficients": regress.coefficients_frame(spark, lr.stages[-1], features),
        "lr_summary": regress.summary_frame(spark, lr.stages[-1]),
    }
