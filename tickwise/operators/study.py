"""Cross-validated elastic-net studies of every group from sufficient statistics.

A least-squares fit with an L1 and an L2 penalty reads its rows only through
their Gram matrix.  So one aggregate gives the matrix of every (group, run,
part), a part being a fold or the held-out rows; matrices add, so a fold's
training set is the other folds' sum.  The whole grid of all runs is then
solved per group by coordinate descent on small matrices: no pass over the
rows per grid point, and one plan for all groups, runs and points.

The problem is Spark ML's ``LinearRegression`` (normal solver): features and
label scaled by their population deviations, ``regParam`` and ``elasticNetParam`` as there, an
unpenalised intercept.  ``maxIter`` counts sweeps over the coefficients.

Columns are centred per group before the sums, so a large level (volume) does
not cost digits.  Rows with a null or NaN in a feature or the label are left
out; a null group is a group; a fold without rows has no say; equal scores go
to the first grid point.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import product
from typing import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.operators.regress import GRIDS
from tickwise.session import ship_package

#: Part number of held-out rows; folds count from 0.
TEST = -1
AXES = ("maxIter", "regParam", "elasticNetParam")
#: Scores this close (relatively) are equal.
EQUAL = 1e-9


def axes_of(preset: str) -> dict[str, list[float]]:
    """The values of a preset's ``lr`` grid; an axis that it leaves out has Spark ML's fixed value of ``regress.estimator``."""
    grid = GRIDS[preset]["lr"]
    values = {name: np.linspace(*v).tolist() if isinstance(v, tuple) else list(v) for name, v in grid.items()}
    return {"maxIter": [10], "regParam": [0.3], "elasticNetParam": [0.8], **values}


@dataclass(frozen=True)
class StudySpec:
    runs: int = 25
    folds: int = 3
    test_fraction: float = 0.3
    seed0: int = 1000
    axes: Mapping[str, Sequence[float]] = field(default_factory=lambda: axes_of("full"))

    @property
    def points(self) -> list[tuple[int, float, float]]:
        return [(int(m), float(r), float(a)) for m, r, a in product(*(self.axes[x] for x in AXES))]


def hashed_part(columns: Sequence[Column], spec: StudySpec) -> Callable[[Column], Column]:
    """Run -> part, by hashes of the row's values; the held-out rows are those of ``regress.hash_split`` with seed0 + run."""
    def part(run: Column) -> Column:
        seed = F.lit(spec.seed0) + run
        test = F.pmod(F.xxhash64(seed, *columns), F.lit(10000)) >= int(round((1.0 - spec.test_fraction) * 10000))
        return F.when(test, TEST).otherwise(F.pmod(F.xxhash64(F.lit("fold"), seed, *columns), F.lit(spec.folds))).cast("int")
    return part


def gram(rows: DataFrame, group: str, features: Sequence[str], label: str, part: Callable[[Column], Column], runs: int) -> DataFrame:
    """(g, run, part, n, center, s): s is the upper triangle, by rows, of the sums of products of (1, features, label), centred."""
    names = [*features, label]
    v = {f"v{i}": F.col(c).cast("double") for i, c in enumerate(names)}
    complete = ~F.exists(F.array(*v.values()), lambda x: x.isNull() | F.isnan(x))
    parts = F.transform(F.sequence(F.lit(0), F.lit(runs - 1)), lambda r: F.struct(r.alias("run"), part(r).alias("part")))
    base = rows.where(complete).select(F.col(group).alias("g"), *[c.alias(k) for k, c in v.items()], parts.alias("parts"))
    centers = base.groupBy(F.col("g").alias("_g")).agg(F.array(*[F.avg(k) for k in v]).alias("center"))
    met = base.join(centers, F.col("g").eqNullSafe(F.col("_g")))
    z = [F.lit(1.0), *[F.col(k) - F.col("center")[i] for i, k in enumerate(v)]]
    dealt = met.select("g", "center", F.array(*z).alias("z"), F.inline("parts"))
    cells = [F.sum(F.col("z")[i] * F.col("z")[j]) for i in range(len(z)) for j in range(i, len(z))]
    return dealt.groupBy("g", "run", "part").agg(F.first("center").alias("center"), F.array(*cells).alias("s"))


# ---------------------------------------------------------------------------
# Solving, per group, on numpy arrays whose first axes are problems


class Problems:
    """Training matrices as scaled problems: 1/2 b'Ab - c'b."""

    def __init__(self, s: np.ndarray) -> None:
        self.n = s[:, 0, 0]
        n = np.maximum(self.n, 1.0)
        self.mean = s[:, 0, 1:] / n[:, None]
        cov = s[:, 1:, 1:] / n[:, None, None] - self.mean[:, :, None] * self.mean[:, None, :]
        sd = np.sqrt(np.maximum(np.einsum("tii->ti", cov), 0))
        # what rounding leaves of a constant column's variance is none
        sd[sd <= 1e-7 * np.sqrt(np.abs(np.einsum("tii->ti", s[:, 1:, 1:])) / n[:, None])] = 0
        self.sd_x, self.sd_y = sd[:, :-1], sd[:, -1]
        per_x = np.divide(1, self.sd_x, out=np.zeros_like(self.sd_x), where=self.sd_x > 0)
        per_y = np.divide(1, self.sd_y, out=np.zeros_like(self.sd_y), where=self.sd_y > 0)
        self.per_y, self.back = per_y, per_x * self.sd_y[:, None]
        self.a = cov[:, :-1, :-1] * per_x[:, :, None] * per_x[:, None, :]
        self.c = cov[:, :-1, -1] * per_x * per_y[:, None]

    def solve(self, penalties: np.ndarray, sweeps: Sequence[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(sweeps, coefficients [problem, penalty, feature], intercepts) after each of ``sweeps``; a penalty is (regParam, elasticNetParam)."""
        reg = penalties[None, :, 0] * self.per_y[:, None]
        l1, l2 = reg * penalties[None, :, 1], reg * (1 - penalties[None, :, 1])
        b = np.zeros((len(self.n), len(penalties), self.c.shape[1]))
        for sweep in range(1, max(sweeps) + 1):
            for j in range(b.shape[2]):
                own = self.a[:, j, j][:, None]
                rest = self.c[:, j][:, None] - np.einsum("tk,tgk->tg", self.a[:, j], b) + own * b[:, :, j]
                b[:, :, j] = np.divide(np.sign(rest) * np.maximum(np.abs(rest) - l1, 0), own + l2, out=np.zeros_like(rest), where=own > 0)
            if sweep in sweeps:
                w = b * self.back[:, None, :]
                yield sweep, w, self.mean[:, None, -1] - np.einsum("tgk,tk->tg", w, self.mean[:, :-1])


def rmse_of(s: np.ndarray, w: np.ndarray, a: np.ndarray) -> np.ndarray:
    """RMSE of coefficients [problem, penalty, feature] on the matrices of the same problems; NaN without rows."""
    e = np.concatenate([-a[:, :, None], -w, np.ones_like(a)[:, :, None]], axis=2)
    sse = np.einsum("tgi,tij,tgj->tg", e, s, e)
    n = s[:, 0, 0][:, None]
    return np.sqrt(np.divide(np.maximum(sse, 0), n, out=np.full_like(sse, np.nan), where=n > 0))


def square(s: np.ndarray) -> np.ndarray:
    """Upper triangles -> symmetric matrices."""
    q = int(round((np.sqrt(8 * s.shape[1] + 1) - 1) / 2))
    out = np.zeros((len(s), q, q))
    out[:, *np.triu_indices(q)] = s
    return out + np.triu(out, 1).transpose(0, 2, 1)


def study_group(stats: np.ndarray, spec: StudySpec) -> list[tuple]:
    """(run, point, cv, rmse, coefficients, intercept) of every run's winner; stats [run, part (last: held out), q, q]."""
    points = spec.points
    penalties = list(dict.fromkeys((r, a) for _, r, a in points))
    sweeps = sorted({m for m, _, _ in points})
    runs, q = stats.shape[0], stats.shape[2]
    folds = stats[:, :spec.folds]
    train = folds.sum(axis=1, keepdims=True)
    scores = {}
    with np.errstate(invalid="ignore"):
        for sweep, w, a in Problems((train - folds).reshape(-1, q, q)).solve(np.array(penalties), sweeps):
            each = rmse_of(folds.reshape(-1, q, q), w, a).reshape(runs, spec.folds, -1)
            seen = np.isfinite(each)
            scores[sweep] = np.where(seen, each, 0).sum(axis=1) / np.maximum(seen.sum(axis=1), 1)
        cv = np.stack([scores[m][:, penalties.index((r, a))] for m, r, a in points], axis=1)
        won = (cv <= cv.min(axis=1, keepdims=True) * (1 + EQUAL)).argmax(axis=1)
        final = {sweep: (w, a, rmse_of(stats[:, -1], w, a)) for sweep, w, a in Problems(train[:, 0]).solve(np.array(penalties), sweeps)}
    out = []
    for run, k in enumerate(won.tolist()):
        m, r, a = points[k]
        w, b, rmse = (x[run, penalties.index((r, a))] for x in final[m])
        out.append((run, k, float(cv[run, k]), float(rmse), w.tolist(), float(b)))
    return out


RESULT = ("run int, rmse double, cv_rmse double, params map<string,string>, coefficients array<double>, intercept double, "
          "n_train long, n_test long")


def elastic_net_study(rows: DataFrame, group: str, features: Sequence[str], label: str, spec: StudySpec = StudySpec(),
                      part: Callable[[Column], Column] | None = None) -> DataFrame:
    """The winner of every group and run: (group, run, rmse on held-out rows, cv_rmse, params, coefficients, intercept, n_train, n_test).

    ``part`` gives a row's part in a run; by default ``hashed_part`` of label and features.
    """
    ship_package(rows.sparkSession)
    part = part or hashed_part([F.col(label).cast("double"), *[F.col(c) for c in features]], spec)
    sums = gram(rows, group, features, label, part, spec.runs)
    kind = rows.schema[group].dataType.simpleString()

    def solve(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        triangles = square(np.stack(cells["s"].to_numpy()))
        stats = np.zeros((spec.runs, spec.folds + 1, *triangles.shape[1:]))
        stats[cells["run"].to_numpy(), cells["part"].to_numpy()] = triangles  # TEST is the last place
        center = np.array(cells["center"].iloc[0])
        won = study_group(stats, spec)
        named = [{k: str(v) for k, v in zip(AXES, spec.points[p])} for _, p, *_ in won]
        level = [b + center[-1] - float(np.dot(w, center[:-1])) for *_, w, b in won]
        return pd.DataFrame({"g": [key[0]] * len(won), "run": [x[0] for x in won], "rmse": [x[3] for x in won], "cv_rmse": [x[2] for x in won],
                             "params": named, "coefficients": [x[4] for x in won], "intercept": level,
                             "n_train": stats[:, :-1, 0, 0].sum(axis=1).round().astype(int), "n_test": stats[:, -1, 0, 0].round().astype(int)})
    return sums.groupBy("g").applyInPandas(solve, f"g {kind}, {RESULT}").withColumnRenamed("g", group)
