"""Per-company additive forecasting (R1-R6, U2) fitted from distributed sufficient statistics.

Model (the decomposition of Taylor & Letham, "Forecasting at Scale", 2018):

    y(t) = trend(t) + weekly(t) + yearly(t) + daily(t) + e
    trend(t) = b0 + b1 t + sum_j d_j (t - s_j)+        (linear growth, change points s_j)
    weekly / yearly = Fourier series of order K_w / K_y  (daily = 0 on daily data)

Fitting: MAP with a Laplace prior on the change-point rates and a normal prior
on seasonal terms, reached by iteratively reweighted ridge solves on the
per-company Gram matrix (no extra pass over the data); a plain ridge mode is
available.  Same columns and meaning as the reference's output, not the same
numbers (different optimiser, closed-form intervals).

Plan
----
1. one tiny aggregate: per company first/last day and max |y| (scales);
2. the design row is built with Spark column expressions (an array column);
3. ``mapInPandas``: each task reduces its rows to X'X (upper triangle), X'y,
   n and y'y per company - a fixed-size partial per (task, company), so a hot
   company costs no more than any other;
4. ``groupBy(company, cell).sum`` (partial + final aggregation);
5. ``groupBy(company).applyInPandas``: one small linear solve per company;
6. scoring: the coefficient table (one row per company, size checked before
   broadcast) joins the history+future frame; components are dot products of
   array slices evaluated JVM-side.
Intervals: closed form.  Observation noise sigma from the fit; trend
uncertainty from future change points arriving at the fitted rate with
Laplace magnitudes of the fitted mean |d_j|: var = 2 K b^2 h^3 / 3 (h = time
past the history end, in history units).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from statistics import NormalDist
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.operators.windows import future_frame
from tickwise.schema import FORECAST_COMPONENTS
from tickwise.session import cut_lineage, ship_package


@dataclass(frozen=True)
class ForecastSpec:
    periods: int = 90
    interval_width: float = 0.95
    n_changepoints: int = 25
    changepoint_range: float = 0.8
    weekly_order: int = 3
    yearly_order: int = 10
    ridge_changepoints: float = 10.0
    ridge_seasonal: float = 0.01
    # "laplace": sparse change points (MAP with a Laplace prior of scale
    # changepoint_prior_scale, normal prior of scale seasonality_prior_scale on
    # seasonal terms, both relative to the residual variance) reached by
    # iteratively reweighted ridge solves on the same Gram matrix;
    # "ridge": the fixed ridge weights above.
    changepoint_prior: str = "laplace"
    # "rows": change points at row quantiles of the first changepoint_range of
    # each history (as in the published method); "time": uniform in time
    changepoint_placement: str = "rows"
    changepoint_prior_scale: float = 0.05
    seasonality_prior_scale: float = 10.0
    irls_iterations: int = 25
    include_history: bool = True

    @property
    def n_trend(self) -> int:
        return 2 + self.n_changepoints

    @property
    def n_features(self) -> int:
        return self.n_trend + 2 * self.weekly_order + 2 * self.yearly_order

    def changepoints(self) -> list[float]:
        k = self.n_changepoints
        return [self.changepoint_range * j / k for j in range(1, k + 1)]

    def penalties(self) -> np.ndarray:
        p = np.zeros(self.n_features)
        p[2:self.n_trend] = self.ridge_changepoints
        p[self.n_trend:] = self.ridge_seasonal
        return p


def _design(spec: ForecastSpec) -> Column:
    """Design row as an array<double>: [1, t, hinges..., weekly sin/cos..., yearly sin/cos...]
    over the columns ``_t`` (scaled time), ``_d`` (day number) and, for row-quantile
    placement, ``_cps`` (the company's scaled change points).

    Emitted as one SQL expression: a single JVM call instead of hundreds.
    """
    head = ["CAST(1.0 AS DOUBLE)", "_t"]
    seasonal = []
    for period, order in ((7.0, spec.weekly_order), (365.25, spec.yearly_order)):
        for k in range(1, order + 1):
            w = repr(2.0 * math.pi * k / period)
            seasonal += [f"sin(CAST({w} AS DOUBLE) * _d)", f"cos(CAST({w} AS DOUBLE) * _d)"]
    if spec.n_changepoints and spec.changepoint_placement == "rows":
        parts = [f"array({', '.join(head)})",
                 "transform(_cps, s -> greatest(_t - s, CAST(0.0 AS DOUBLE)))"]
        if seasonal:
            parts.append(f"array({', '.join(seasonal)})")
        return F.expr(f"concat({', '.join(parts)})")
    hinges = [f"greatest(_t - CAST({c!r} AS DOUBLE), CAST(0.0 AS DOUBLE))" for c in spec.changepoints()]
    return F.expr(f"array({', '.join(head + hinges + seasonal)})")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda acc, v: acc + v)


def _scales(df: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Per company: first/last day (as day numbers), the y scale and, for
    row-quantile placement, the change-point days ``_cps`` (scaled to [0, 1]).

    Change point j (1..K) is the day at row round(j (h - 1) / K) of the
    company's history, h = floor(changepoint_range * n), looked up in the
    sorted days of the company (bounded by the calendar) in the same aggregate.
    """
    k = spec.n_changepoints
    by_rows = bool(k) and spec.changepoint_placement == "rows"
    days = [F.array_sort(F.collect_list(F.unix_date("ds"))).alias("_days")] if by_rows else []
    out = df.groupBy("company").agg(
        F.min(F.unix_date("ds")).alias("d0"),
        F.max(F.unix_date("ds")).alias("d1"),
        F.max(F.abs("y")).alias("yscale"),
        *days,
    ).withColumn("yscale", F.when(F.col("yscale") > 0, F.col("yscale")).otherwise(F.lit(1.0)))
    if not by_rows:
        return out
    h = F.greatest(F.floor(F.size("_days") * F.lit(spec.changepoint_range)), F.lit(1))
    span = F.greatest(F.col("d1") - F.col("d0"), F.lit(1)).cast("double")

    def point(j: Column) -> Column:
        row = F.bround(j * (h - 1) / F.lit(float(k))).cast("int")
        return (F.element_at("_days", row + 1) - F.col("d0")).cast("double") / span

    return out.withColumn("_cps", F.transform(F.sequence(F.lit(1), F.lit(k)), point)).drop("_days")


def _scaled_time(day: Column) -> Column:
    span = F.greatest(F.col("d1") - F.col("d0"), F.lit(1)).cast("double")
    return (day - F.col("d0")).cast("double") / span


#: Companies whose partial sums one task holds at a time.
MAX_PARTIALS = 4096


#: Values of magnitude about 1 are split at this grid: products of the upper parts are whole multiples of GRID ** 2,
#: so their sums are exact in doubles over thousands of rows, and the lower parts' rounding is far below a double's.
GRID = 2.0 ** -20


def _gram_partials(p: int):
    """Row moments (X'X, X'y, n, y'y) per company, as an upper and a lower part that add up in any order to one result."""
    iu = np.triu_indices(p)
    ncell = len(iu[0])

    def cells(m: np.ndarray, n: int) -> list[np.ndarray]:
        return [m[:p, :p][iu], m[:p, p], np.array([n, m[p, p]])]

    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc: dict[str, list] = {}

        def flushed() -> Iterator[pd.DataFrame]:
            for company, (vec,) in acc.items():
                yield pd.DataFrame({"company": company, "cell": np.arange(len(vec), dtype=np.int32), "value": vec})
            acc.clear()

        for pdf in batches:
            for company, g in pdf.groupby("company", sort=False):
                z = np.column_stack([np.vstack(g["x"].to_numpy()).astype(float), g["y"].to_numpy(dtype=float)])
                upper = np.round(z / GRID) * GRID
                lower = z - upper
                mixed = upper.T @ lower
                part = np.concatenate(cells(upper.T @ upper, len(z)) + cells(mixed + mixed.T + lower.T @ lower, 0))
                if company in acc:
                    acc[company][0] += part
                else:
                    acc[company] = [part]
                if len(acc) >= MAX_PARTIALS:  # partial sums add up, so they may leave early
                    yield from flushed()
        yield from flushed()

    return fn, ncell


def _solver(spec: ForecastSpec):
    p = spec.n_features
    iu = np.triu_indices(p)
    ncell = len(iu[0])
    pen = spec.penalties()

    def ridge(g, b, weights):
        try:
            return np.linalg.solve(g + np.diag(weights), b)
        except np.linalg.LinAlgError:  # too few rows for the unpenalised columns
            return np.linalg.lstsq(g + np.diag(weights), b, rcond=None)[0]

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.zeros(2 * (ncell + p + 2))
        v[pdf["cell"].to_numpy()] = pdf["value"].to_numpy()
        v = v[:ncell + p + 2] + v[ncell + p + 2:]
        g = np.zeros((p, p))
        g[iu] = v[:ncell]
        g = g + np.triu(g, 1).T
        b = v[ncell:ncell + p]
        n, yy = v[ncell + p], v[ncell + p + 1]
        weights = pen.copy()
        beta = ridge(g, b, weights)
        if spec.changepoint_prior == "laplace":
            # residual variance of the first fit sets the prior weights
            s2 = max(yy - 2.0 * b @ beta + beta @ g @ beta, 0.0) / max(n - p, 1.0)
            s2 = max(s2, 1e-12)
            weights[spec.n_trend:] = s2 / spec.seasonality_prior_scale ** 2
            lam = 2.0 * s2 / spec.changepoint_prior_scale  # L1 weight of the Laplace prior
            for _ in range(spec.irls_iterations):
                d = np.abs(beta[2:spec.n_trend])
                weights[2:spec.n_trend] = lam / (2.0 * np.maximum(d, 1e-8))
                beta = ridge(g, b, weights)
        a = g + np.diag(weights)
        sse = max(yy - 2.0 * b @ beta + beta @ g @ beta, 0.0)
        dof_model = float(np.trace(np.linalg.pinv(a) @ g))
        sigma = math.sqrt(sse / max(n - dof_model, 1.0))
        hinge = beta[2:spec.n_trend]
        rate_b = float(np.mean(np.abs(hinge))) if len(hinge) else 0.0
        return pd.DataFrame({"company": [pdf["company"].iloc[0]], "beta": [beta.tolist()],
                             "sigma": [sigma], "n": [int(n)], "delta_scale": [rate_b]})

    return solve


def fit(history: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Fit every company at once.  Input (ds DATE, y DOUBLE, company STRING).

    Returns one row per company: d0, d1, yscale, beta array, sigma, n, delta_scale.
    """
    ship_package(history.sparkSession)  # the steps in Python import this module
    clean = history.filter(F.col("y").isNotNull() & ~F.isnan("y") & F.col("ds").isNotNull())
    # one row per company, read three times below: materialise it once
    scales = cut_lineage(_scales(clean, spec))
    carry = ["_cps"] if "_cps" in scales.columns else []
    rows = clean.join(scales, "company").select(
        "company",
        _scaled_time(F.unix_date("ds")).alias("_t"),
        F.unix_date("ds").cast("double").alias("_d"),
        (F.col("y") / F.col("yscale")).alias("y"),
        *carry,
    ).select("company", _design(spec).alias("x"), "y")
    partial_fn, _ = _gram_partials(spec.n_features)
    cells = rows.mapInPandas(partial_fn, "company string, cell int, value double")
    summed = cells.groupBy("company", "cell").agg(F.sum("value").alias("value"))
    coef = summed.groupBy("company").applyInPandas(
        _solver(spec), "company string, beta array<double>, sigma double, n long, delta_scale double")
    return coef.join(scales, "company")


def predict(model: DataFrame, history: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Score history (optional) + ``periods`` future days: the 21 forecast components."""
    frame = future_frame(history, spec.periods)
    if not spec.include_history:
        last = history.groupBy("company").agg(F.max("ds").alias("_last"))
        frame = frame.join(last, "company").filter(F.col("ds") > F.col("_last")).drop("_last")
    m = model
    day = F.unix_date("ds")
    t = _scaled_time(day)
    nt, nw = spec.n_trend, 2 * spec.weekly_order
    ny = 2 * spec.yearly_order
    beta = F.col("beta")
    ys = F.col("yscale")

    def part(start: int, length: int) -> Column:
        if length == 0:
            return F.lit(0.0)
        return _dot(F.slice(F.col("x"), start + 1, length), F.slice(beta, start + 1, length)) * ys

    z = NormalDist().inv_cdf(0.5 + spec.interval_width / 2.0)
    h = F.greatest(F.col("t") - F.lit(1.0), F.lit(0.0))
    trend_sd = F.sqrt(F.lit(2.0 * spec.n_changepoints / 3.0) * F.pow(F.col("delta_scale"), 2) * F.pow(h, 3)) * ys
    noise_sd = F.col("sigma") * ys
    scored = (frame.join(m, "company")
              .withColumn("t", t).withColumn("_t", t).withColumn("_d", day.cast("double"))
              .withColumn("x", _design(spec))
              .withColumn("trend", part(0, nt))
              .withColumn("weekly", part(nt, nw))
              .withColumn("yearly", part(nt + nw, ny))
              .withColumn("daily", F.lit(0.0))
              .withColumn("_tsd", trend_sd)
              .withColumn("_ysd", F.sqrt(noise_sd * noise_sd + F.col("_tsd") * F.col("_tsd"))))
    add = F.col("weekly") + F.col("yearly") + F.col("daily")
    scored = scored.withColumn("additive_terms", add).withColumn("yhat", F.col("trend") + add)
    zc = F.lit(z)
    out = {
        "yhat_lower": F.col("yhat") - zc * F.col("_ysd"),
        "yhat_upper": F.col("yhat") + zc * F.col("_ysd"),
        "trend_lower": F.col("trend") - zc * F.col("_tsd"),
        "trend_upper": F.col("trend") + zc * F.col("_tsd"),
        "multiplicative_terms": F.lit(0.0),
        "multiplicative_terms_lower": F.lit(0.0),
        "multiplicative_terms_upper": F.lit(0.0),
    }
    for comp in ("daily", "weekly", "yearly", "additive_terms"):
        out[f"{comp}_lower"] = F.col(comp)
        out[f"{comp}_upper"] = F.col(comp)
    cols = [F.col("ds")] + [(out[c] if c in out else F.col(c)).alias(c) for c in FORECAST_COMPONENTS]  # noqa: E501
    return scored.select(*cols, F.col("company"))


def forecast(history: DataFrame, spec: ForecastSpec = ForecastSpec(), materialize: bool = True) -> DataFrame:
    """Fit + predict for every company of ``history`` (ds, y, company).

    The history (companies x days) and the model (one row per company) are
    each read several times by the plan; with ``materialize`` both are
    written once to the shared checkpoint folder, so the source scan and the
    Gram job run exactly once and a lost executor does not recompute them.
    """
    hist = history.select("ds", "y", "company")
    if materialize:
        hist = cut_lineage(hist)
    model = fit(hist, spec)
    if materialize:
        model = cut_lineage(model)
    return predict(model, hist, spec)
