"""Random forest regression on one table of any length.

The algorithm and parameters are those of Spark ML's ``RandomForestRegressor``:
Poisson(1) counts of every row per tree, a random subset of the features per
node, cuts between bins of the values, the largest drop of variance, the mean
of the trees.  Spark ML keeps some 200 bytes of objects a row and visits each
row, tree and level in a loop of its own; here a level of all trees is

* one pass over runs of rows: their bins, labels and hashes, packed once and
  cached, are taken down the trees as arrays and (count, sum, sum of squares)
  added up per open node, offered feature and bin;
* one shuffle of these sums by blocks of open nodes, whose best cuts are all
  that reaches the driver.

Sums of a pass are bounded by ``SUMS`` bytes a task; more open nodes take more
passes.  What grows with the rows is read, never collected.

Rules.  A feature with at most ``maxBins`` different values is cut midway
between neighbours, any other at its approximate quantiles over all rows (Spark
ML takes those of a sample), which may vary with the partitions.  ``x <= cut`` goes left.  Ties go to the smaller feature
number, then the smaller cut.  Draws come from a hash of the seed and the row's
columns, so these depend neither on partitions nor on repeated tasks; rows alike
in every column are drawn alike.  Missing labels are an error, as in Spark ML.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.session import ship_package

#: Rows of a run, taken down the trees at once.
CHUNK = 1 << 17
#: Rows of a task of a pass, at most about.
ROWS = 1 << 22
#: Open nodes of a block: sums of one block meet in one task.
BLOCK = 16
#: Bytes of sums a task holds in one pass.
SUMS = 64 << 20
#: Drops of variance below this share of the square sum are rounding.
ROUNDING = 1e-13

#: Thresholds of a 32-bit draw: the number of those reached is a Poisson(1) count.
_POISSON = [np.uint32(c * 2**32) for c in accumulate(math.exp(-1) / math.factorial(k) for k in range(20)) if c < 1 - 2**-32]


@dataclass(frozen=True)
class ForestSpec:
    """Parameters by Spark ML's names and defaults."""
    numTrees: int = 20
    maxDepth: int = 5
    maxBins: int = 32
    impurity: str = "variance"
    bootstrap: bool = True
    featureSubsetStrategy: str = "auto"
    minInstancesPerNode: int = 1
    minInfoGain: float = 0.0
    seed: int = 42

    def __post_init__(self):
        if self.impurity != "variance" or self.featureSubsetStrategy not in ("auto", "all", "onethird"):
            raise ValueError(f"{self.impurity}, {self.featureSubsetStrategy}")
        if self.numTrees < 1 or self.maxDepth < 0 or not 2 <= self.maxBins < 1 << 15:
            raise ValueError(f"numTrees {self.numTrees}, maxDepth {self.maxDepth}, maxBins {self.maxBins}")

    def offered(self, k: int) -> int:
        """Features offered to a node."""
        strategy = self.featureSubsetStrategy
        return k if strategy == "all" or (strategy == "auto" and self.numTrees == 1) else math.ceil(k / 3)


class Nodes:
    """Nodes of all trees by number, roots first.  One without a cut leads to itself."""

    def __init__(self, trees: int):
        self.trees = self.size = trees
        self.feature, self.bin, self.left = np.zeros(trees, np.int64), np.full(trees, 1 << 15), np.arange(trees)
        self.tree, self.value, self.gain = np.arange(trees), np.zeros(trees), np.zeros(trees)

    def split(self, node: np.ndarray, feature, bin, gain, left_value, right_value) -> np.ndarray:
        """Gives each of ``node`` two children; returns the numbers of the left ones."""
        left = self.size + 2 * np.arange(len(node))
        self.size += 2 * len(node)
        both = np.arange(self.size - 2 * len(node), self.size)
        self.feature[node], self.bin[node], self.left[node], self.gain[node] = feature, bin, left, gain
        more = {"feature": np.zeros(len(both), np.int64), "bin": np.full(len(both), 1 << 15), "left": both, "tree": np.repeat(self.tree[node], 2),
                "value": np.column_stack([left_value, right_value]).reshape(-1), "gain": np.zeros(len(both))}
        for name, values in more.items():
            setattr(self, name, np.concatenate([getattr(self, name), values]))
        return left


def _mixed(h: np.ndarray, step: int) -> np.ndarray:
    """Two 32-bit draws a row from its hash (splitmix64)."""
    z = h + np.uint64(step * 0x9E3779B97F4A7C15 % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))).view(np.uint32).reshape(-1, 2)


def draws(h: np.ndarray, trees: int):
    """Per tree how often it holds each row: Poisson(1) counts."""
    for tree in range(trees):
        if tree % 2 == 0:
            pair = _mixed(h, tree // 2 + 1)
        lane, n = np.ascontiguousarray(pair[:, tree % 2]), np.zeros(len(h), np.int8)
        for t in _POISSON:
            n += lane >= t
        yield n


def _bin_type(cuts: list):
    return np.uint8 if max(map(len, cuts)) < 256 else np.uint16


def _packed(cuts: list, mean: float):
    """Task: rows (features, label, hash) as runs of about ``CHUNK``, each the bytes of its bins, centred labels and hashes."""
    def run(held):
        *x, y, h = [np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in range(held[0].num_columns)]
        bins = np.empty((len(y), len(x)), _bin_type(cuts))
        for i, c in enumerate(cuts):
            bins[:, i] = np.searchsorted(c, x[i])
        return pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in (bins, y - mean, h)], ["bins", "y", "h"])

    def task(batches):
        held, n = [], 0
        for b in batches:
            held, n = [*held, b], n + b.num_rows
            if n >= CHUNK:
                yield run(held)
                held, n = [], 0
        if n:
            yield run(held)

    return task


def _runs(batches, cuts: list):
    """The arrays of each packed run."""
    for b in batches:
        for run in zip(*[b.column(c) for c in ("bins", "y", "h")]):
            yield [np.frombuffer(v.as_buffer(), t) for v, t in zip(run, (_bin_type(cuts), np.float64, np.uint64))]


def _sums(cuts: list, nodes: Nodes, depth: int, opened: np.ndarray, offered: np.ndarray, spec: ForestSpec):
    """Task of a pass: (count, sum, sum of squares) x offered x open node x bin, in blocks of open nodes.

    ``opened``: node numbers ascending by tree; ``offered``: their features.
    """
    k, m, width = len(cuts), offered.shape[1], max(map(len, cuts)) + 1
    place = np.full(nodes.size, -1)
    place[opened] = np.arange(len(opened))
    ends = np.searchsorted(nodes.tree[opened], np.arange(nodes.trees + 1))
    ended = np.bincount(nodes.tree[(nodes.left == np.arange(nodes.size)) & (place < 0)], minlength=nodes.trees) > 0  # trees with leaves not asked for
    feature, bin, left, of = nodes.feature, nodes.bin.astype(np.uint16), nodes.left, np.ascontiguousarray(offered.T)

    def task(batches):
        total = np.zeros((3, m, len(opened), width))
        for bins, y, h in _runs(batches, cuts):
            every = np.arange(len(y)) * k
            counts = draws(h, nodes.trees) if spec.bootstrap else (None for _ in range(nodes.trees))
            for tree, count in enumerate(counts):
                lo, hi = ends[tree], ends[tree + 1]
                if lo == hi:
                    continue
                if count is None:
                    at, v, w = every, y, np.ones(len(y))
                else:
                    rows = np.flatnonzero(count > 0)
                    at, v, w = rows * k, y[rows], count[rows].astype(np.float64)
                node = np.full(len(at), tree)
                for _ in range(depth):
                    node = left[node] + (bins[at + feature[node]] > bin[node])
                o = place[node]
                if ended[tree]:
                    kept = np.flatnonzero(o >= 0)
                    at, v, w, o = at[kept], v[kept], w[kept], o[kept]
                wv = w * v
                moments, first = (w, wv, wv * v), (o - lo) * width
                for j in range(m):
                    cell = first + bins[at + of[j][o]]
                    for s, moment in enumerate(moments):
                        total[s, j, lo:hi] += np.bincount(cell, moment, (hi - lo) * width).reshape(hi - lo, width)
        blocks = [b for b in range(0, len(opened), BLOCK) if total[0, 0, b:b + BLOCK].any()]
        for b in blocks:
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([total[:, :, b:b + BLOCK].tobytes()], pa.binary())], ["block", "sums"])

    return task


_BEST = ("node long, feature long, bin long, gain double, n double, s double, q double, nl double, sl double, ql double")


def _best(m: int, width: int, spec: ForestSpec):
    """Task of a block: the best cut of each open node; feature -1 without one."""
    def task(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b, np.float64) for b in sorted(pdf["sums"])).reshape(3, m, -1, width)
        upto = total.cumsum(axis=-1)
        (nl, sl, ql), (n, s, q) = upto[..., :-1], upto[:, 0, :, -1]
        nr, sr = n[:, None] - nl, s[:, None] - sl
        with np.errstate(divide="ignore", invalid="ignore"):
            drop = sl * sl / nl + sr * sr / nr - (s * s / n)[:, None]
            fair = (nl >= max(1, spec.minInstancesPerNode)) & (nr >= max(1, spec.minInstancesPerNode))
            fair &= (drop > ROUNDING * q[:, None]) & (drop >= spec.minInfoGain * n[:, None])
        drop = np.where(fair, drop, -np.inf).transpose(1, 0, 2).reshape(len(n), -1)  # offered features, then cuts
        node, best = np.arange(len(n)), drop.argmax(axis=1) if drop.shape[1] else np.zeros(len(n), int)
        if not drop.shape[1]:
            drop, nl, sl, ql = np.full((len(n), 1), -np.inf), *[np.zeros((m, len(n), 1))] * 3
        j, bin = np.divmod(best, max(1, width - 1))
        gain = drop[node, best]
        return pd.DataFrame({"node": key[0] + node, "feature": np.where(np.isfinite(gain), j, -1), "bin": bin, "gain": gain, "n": n, "s": s, "q": q,
                             "nl": nl[j, node, bin], "sl": sl[j, node, bin], "ql": ql[j, node, bin]})

    return task


def value_cuts(rows: DataFrame, names: list[str], max_bins: int) -> tuple[list[np.ndarray], float, int]:
    """(ascending cuts per feature, mean label, number of rows), from all rows."""
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean"), F.array(*[F.approx_count_distinct(c) for c in names]).alias("different")).first()
    if not found["n"]:
        raise ValueError("a forest needs rows")

    def cuts_of(want: list[int], few: list[int]) -> dict[int, np.ndarray]:
        at = [i / max_bins for i in range(1, max_bins)]
        asked = [F.collect_set(c).alias(c) if i in few else F.percentile_approx(c, at, 10_000).alias(c) for i, c in enumerate(names) if i in want]
        return {i: np.unique(np.array(v, np.float64)) for i, v in zip(want, rows.agg(*asked).first())} if want else {}

    few = [i for i, d in enumerate(found["different"]) if d <= 2 * max_bins]  # the estimate is off by 5 %
    cuts = cuts_of(list(range(len(names))), few)
    for i in few:
        v = cuts[i]
        if len(v) <= max_bins:
            with np.errstate(invalid="ignore"):
                mid = (v[:-1] + v[1:]) / 2
            cuts[i] = np.where(np.isfinite(mid), mid, v[:-1])
    cuts.update(cuts_of([i for i in few if len(cuts[i]) > max_bins], []))
    return [cuts[i] for i in range(len(names))], found["mean"], found["n"]


class Forest(Estimator):
    """``RandomForestRegressor`` for long tables; a stage of a pipeline."""

    def __init__(self, features: str = "features", label: str = "label", **params):
        super().__init__()
        self.features, self.label, self.spec = features, label, ForestSpec(**params)

    def _fit(self, dataset: DataFrame) -> ForestModel:
        ship_package(dataset.sparkSession)
        spec = self.spec
        k = dataset.schema[self.features].metadata.get("ml_attr", {}).get("num_attrs")
        if k is None:
            first = dataset.select(self.features).first()
            if first is None:
                raise ValueError("a forest needs rows")
            k = len(first[0])
        names = [f"x{i}" for i in range(k)]
        y = F.col(self.label).cast("double")
        y = F.when(y.isNull() | F.isnan(y), F.raise_error(F.lit("labels must not be null or NaN"))).otherwise(y)
        same = [F.col(f"`{c}`") for c, t in dataset.dtypes if t != "vector" and "map<" not in t and "variant" not in t]
        read = dataset.select(vector_to_array(F.col(self.features)).alias("_x"), y.alias("y"), F.xxhash64(F.lit(spec.seed), *same).alias("_h"))
        rows = read.select(*[F.col("_x")[i].alias(c) for i, c in enumerate(names)], "y", F.xxhash64("_h", "_x").alias("h"))
        rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            cuts, mean, n = value_cuts(rows, names, spec.maxBins)
            parts = max(2 * dataset.sparkSession.sparkContext.defaultParallelism, -(-n // ROWS))  # each task of a pass sends sums of its own
            runs = rows.coalesce(parts).mapInArrow(_packed(cuts, mean), "bins binary, y binary, h binary").persist(StorageLevel.MEMORY_AND_DISK)
            try:
                runs.count()
                rows.unpersist()
                nodes = self._grown(runs, cuts)
            finally:
                runs.unpersist()
        finally:
            rows.unpersist()
        nodes.value += mean
        return ForestModel(self.features, nodes, cuts)

    def _grown(self, runs: DataFrame, cuts: list[np.ndarray]) -> Nodes:
        spec, k = self.spec, len(cuts)
        m, width = spec.offered(k), max(map(len, cuts)) + 1
        nodes, opened = Nodes(spec.numTrees), np.arange(spec.numTrees)
        step = max(BLOCK, SUMS // (24 * m * width))
        for depth in range(max(1, spec.maxDepth)):
            rng = np.random.default_rng([spec.seed % 2**63, depth])
            offered = np.sort(rng.random((len(opened), k)).argsort(axis=1)[:, :m], axis=1)
            found = []
            for i in range(0, len(opened), step):
                task = _sums(cuts, nodes, depth, opened[i:i + step], offered[i:i + step], spec)
                best = runs.mapInArrow(task, "block long, sums binary").groupBy("block").applyInPandas(_best(m, width, spec), _BEST).toPandas()
                found.append(best.assign(node=best["node"] + i))
            best = pd.concat(found).sort_values("node")
            at = best["node"].to_numpy()
            if not depth:
                nodes.value[opened[at]] = best["s"] / best["n"].clip(lower=1)  # a tree without rows: the mean of all
            best = best[(best["feature"] >= 0) & (spec.maxDepth > 0)]
            at, c = best["node"].to_numpy(), {name: best[name].to_numpy() for name in best}
            nr, sr, qr = c["n"] - c["nl"], c["s"] - c["sl"], c["q"] - c["ql"]
            left = nodes.split(opened[at], offered[at, c["feature"]], c["bin"], c["gain"], c["sl"] / c["nl"], sr / nr)
            child, n, s, q = np.stack([[left, c["nl"], c["sl"], c["ql"]], [left + 1, nr, sr, qr]]).transpose(1, 2, 0).reshape(4, -1)
            opened = child[(n >= 2 * max(1, spec.minInstancesPerNode)) & (q - s * s / np.maximum(n, 1) > ROUNDING * q)].astype(np.int64)
            opened = opened[np.argsort(nodes.tree[opened], kind="stable")]
            if not len(opened):
                break
        return nodes


class ForestModel(Model):
    """Trees as arrays; ``transform`` adds ``prediction``, the mean of the trees."""

    def __init__(self, features: str, nodes: Nodes, cuts: list[np.ndarray]):
        super().__init__()
        self.features, self.nodes, self.k = features, nodes, len(cuts)
        self.inner = nodes.left != np.arange(nodes.size)
        self.threshold = np.full(nodes.size, np.inf)
        self.threshold[self.inner] = [cuts[f][b] for f, b in zip(nodes.feature[self.inner], nodes.bin[self.inner])]

    @property
    def featureImportances(self) -> DenseVector:
        """Drops of variance by weight and feature, each tree's summing to 1, then their mean."""
        nodes, per = self.nodes, np.zeros((self.nodes.trees, self.k))
        np.add.at(per, (nodes.tree[self.inner], nodes.feature[self.inner]), nodes.gain[self.inner])
        sums = per.sum(axis=1, keepdims=True)
        total = np.divide(per, sums, out=np.zeros_like(per), where=sums > 0).sum(axis=0)
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship_package(dataset.sparkSession)
        x = vector_to_array(F.col(self.features))
        score = F.pandas_udf(_scores(self.nodes, self.threshold, self.k), "double")
        return dataset.withColumn("prediction", score(*[x[i] for i in range(self.k)]))


def _scores(nodes: Nodes, threshold: np.ndarray, k: int):
    trees, feature, left, value = nodes.trees, nodes.feature, nodes.left, nodes.value

    def task(*x: pd.Series) -> pd.Series:
        flat = np.column_stack([c.to_numpy(np.float64) for c in x]).reshape(-1)
        at, total = np.arange(len(x[0])) * k, np.zeros(len(x[0]))
        for tree in range(trees):
            node, last = np.full(len(at), tree), None
            while last is None or not np.array_equal(node, last):
                node, last = left[node] + (flat[at + feature[node]] > threshold[node]), node
            total += value[node]
        return pd.Series(total / trees)

    return task
