"""Classification trees for every group in one plan.

A group is a company, but any column does.  Trees of all groups grow together,
level by level:

* a group's features are cut at quantiles (at most ``max_bins`` bins), found by
  mergeable sketches;
* a level is one aggregate: class counts keyed by (group, tree, node, feature,
  bin), combined before the shuffle, so a group with a third of all rows is
  only counts by then;
* the best cut of every open node is picked from its counts (Gini), and the
  cuts so far, one row per group, are joined back to the rows.

So the number of jobs depends on the depth, not on the groups, and neither
rows nor models pass through the driver.

Rules.  A cut ``x <= t`` lies at a value of the data.  A node is split where
that lowers the Gini impurity and leaves ``min_instances`` (by weight) on both
sides; ties go to the smaller feature number, then the smaller cut.  A forest
weighs each row per tree by a Poisson(1) draw and offers each node a subset of
about the root of the number of features; both come from hashes of the seed
and the row's id, so a repeated task decides alike.

Defined results: rows without label or with a missing feature are not learned
from; scoring such rows, or rows of a group without a tree, gives null; a null
group is a group.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.sources.files import scratch


@dataclass(frozen=True)
class TreeSpec:
    n_classes: int = 3
    num_trees: int = 1
    max_depth: int = 5
    max_bins: int = 10
    min_instances: float = 1
    seed: int = 1234

    @property
    def forest(self) -> bool:
        return self.num_trees > 1

    @property
    def slots(self) -> int:
        """Places of a tree's inner nodes; place 0 holds the root's counts."""
        return 1 << self.max_depth


#: Cumulative probabilities of a Poisson(1) count.
_POISSON = list(accumulate(math.exp(-1) / math.factorial(k) for k in range(8)))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body).getItem(0)


def bag_weight(group: Column, tree: Column, row_id: Column, seed: int) -> Column:
    """How often a row is in a tree's sample: Poisson(1) by a hash."""
    u = F.pmod(F.xxhash64(F.lit(seed), F.lit("bag"), group, tree, row_id), F.lit(1 << 30)) / float(1 << 30)
    return _let(u, lambda v: reduce(lambda a, p: a + (v >= p).cast("double"), _POISSON, F.lit(0.0)))


def node_features(group: Column, tree: Column, node: Column, n: int, seed: int) -> Column:
    """The features offered to a node of a forest, as an array: the ceil(sqrt(n)) of least hash."""
    ranked = F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                         lambda f: F.struct(F.xxhash64(F.lit(seed), F.lit("node"), group, tree, node, f).alias("h"), f.alias("f")))
    return F.transform(F.slice(F.array_sort(ranked), 1, math.ceil(math.sqrt(n))), lambda s: s["f"])


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _of_group(rows: DataFrame, side: DataFrame, how: str = "inner") -> DataFrame:
    """Join on the group, null equal to null; which side moves is left to the optimizer."""
    s = side.withColumnRenamed("g", "_g")
    return rows.join(s, F.col("g").eqNullSafe(F.col("_g")), how).drop("_g")


def quantile_cuts(rows: DataFrame, max_bins: int) -> DataFrame:
    """(g, cuts): per feature the values at the ranks n/max_bins, 2n/max_bins, ..., ascending and distinct."""
    at = [k / max_bins for k in range(1, max_bins)]
    cells = rows.select("g", F.posexplode("x").alias("feature", "v"))
    found = cells.groupBy("g", "feature").agg(F.array_sort(F.array_distinct(F.percentile_approx("v", at, 10_000))).alias("cut"))
    listed = found.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("feature", "cut"))).alias("c"))
    return listed.select("g", F.transform("c", lambda s: s["cut"]).alias("cuts"))


def _bins(x: Column, cuts: Column) -> Column:
    """The bin of each feature: the number of cuts below the value."""
    return F.zip_with(x, cuts, lambda v, cut: F.size(F.filter(cut, lambda t: t < v)))


def _by_group(splits: DataFrame, spec: TreeSpec, *held: str) -> DataFrame:
    """(g, nodes): a group's cuts in one array, place tree * slots + node; ``held`` names what a cut holds besides feature and bin."""
    place = F.col("tree") * spec.slots + F.col("node")
    listed = splits.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct(
        place.alias("at"), F.struct("feature", "bin", *held).alias("s")))).alias("m"))
    every = F.sequence(F.lit(0), F.lit(spec.num_trees * spec.slots - 1))
    return listed.select("g", F.transform(every, lambda i: F.try_element_at(F.col("m"), i)).alias("nodes"))


def _descend(start: Column, tree: Column, spec: TreeSpec, levels: int, keep) -> Column:
    """A state with field ``node`` after ``levels`` cuts; ``keep(cut, right)`` gives its other fields."""
    def step(s: Column, _: Column) -> Column:
        def past(cut: Column) -> Column:
            right = F.get("bins", cut["feature"]) > cut["bin"]
            return F.when(cut.isNull(), s).otherwise(F.struct((s["node"] * 2 + right.cast("int")).alias("node"), *keep(cut, right)))
        return F.when(s["node"] >= spec.slots, s).otherwise(_let(F.get("nodes", tree * spec.slots + s["node"]), past))
    return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), start, step) if levels else start


def _node(tree: Column, spec: TreeSpec, levels: int) -> Column:
    """The node that a row reaches in a tree; reads ``bins`` and ``nodes``."""
    return _descend(F.struct(F.lit(1).alias("node")), tree, spec, levels, lambda cut, right: ())["node"]


def _leaf(tree: Column, spec: TreeSpec) -> Column:
    """The class counts of the leaf that a row reaches in a tree."""
    start = F.struct(F.lit(1).alias("node"), F.get("nodes", tree * spec.slots)["left"].alias("counts"))
    beside = lambda cut, right: [F.when(right, cut["right"]).otherwise(cut["left"]).alias("counts")]
    return _descend(start, tree, spec, spec.max_depth, beside)["counts"]


def _square_sum(counts: list[Column]) -> Column:
    return reduce(lambda a, c: a + c * c, counts[1:], counts[0] * counts[0])


def _best_cuts(cells: DataFrame, spec: TreeSpec) -> DataFrame:
    """(g, tree, node, feature, bin, left, right) of the nodes worth splitting, from class counts per bin."""
    classes = range(spec.n_classes)
    key = Window.partitionBy("g", "tree", "node", "feature")
    upto = key.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    both = cells.select("g", "tree", "node", "feature", "bin", *[F.sum(f"c{c}").over(upto).alias(f"l{c}") for c in classes],
                        *[F.sum(f"c{c}").over(key).alias(f"t{c}") for c in classes])
    left, total = [F.col(f"l{c}") for c in classes], [F.col(f"t{c}") for c in classes]
    right = [t - x for t, x in zip(total, left)]
    n_left, n = reduce(Column.__add__, left), reduce(Column.__add__, total)
    n_right = n - n_left
    score = F.when((n_left >= spec.min_instances) & (n_right >= spec.min_instances) & (n_left > 0) & (n_right > 0),
                   _square_sum(left) / n_left + _square_sum(right) / n_right)
    worth = both.withColumn("score", score).where(F.col("score") > _square_sum(total) / n + 1e-9 * n)
    best = worth.groupBy("g", "tree", "node").agg(F.max(F.struct(
        "score", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), F.array(*left).alias("left"), F.array(*right).alias("right"))).alias("s"))
    return best.select("g", "tree", "node", (-F.col("s.f")).alias("feature"), (-F.col("s.b")).alias("bin"), "s.left", "s.right")


def fit(rows: DataFrame, group: str, features: Column, label: str, row_id: str, spec: TreeSpec = TreeSpec()) -> DataFrame:
    """One row per group: g, cuts (per feature), nodes (cuts of its trees by place).

    ``features`` is an array<double>; ``label`` counts from 0; ``row_id`` names a row in the draws of a forest.
    """
    complete = ~F.exists("x", lambda v: v.isNull() | F.isnan(v))
    base = rows.select(F.col(group).alias("g"), features.cast("array<double>").alias("x"), F.col(label).cast("int").alias("y"),
                       F.col(row_id).alias("id")).where(complete & F.col("y").isNotNull())
    n = base.select(F.max(F.size("x"))).first()[0] or 0
    cuts = _stored(quantile_cuts(base, spec.max_bins), "tree-cuts")
    dealt = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # small rows, much work: a share for every task
    binned = _stored(_of_group(base, cuts).select("g", "id", "y", _bins(F.col("x"), F.col("cuts")).alias("bins")).repartition(dealt, "g", "id"), "tree-rows")
    trees = F.sequence(F.lit(0), F.lit(spec.num_trees - 1))
    weight = lambda t: bag_weight(F.col("g"), t, F.col("id"), spec.seed) if spec.forest else F.lit(1.0)

    def in_trees(at: DataFrame, level: int) -> DataFrame:
        """A row per tree that samples it and in which it reached an open node."""
        state = F.transform(trees, lambda t: F.struct(t.alias("tree"), weight(t).alias("w"), (
            _node(t, spec, level) if level else F.lit(1)).alias("node")))
        return at.select("g", "y", "bins", F.inline(F.filter(state, lambda s: (s["w"] > 0) & (s["node"] >= 1 << level))))
    count = lambda c: F.sum(F.when(F.col("y") == c, F.col("w")).otherwise(0.0))
    counts = [count(c).alias(f"c{c}") for c in range(spec.n_classes)]

    roots = in_trees(binned, 0).groupBy("g", "tree").agg(F.array(*[count(c) for c in range(spec.n_classes)]).alias("left"))
    none = F.lit(None).cast("array<double>")
    known = _stored(roots.select("g", "tree", F.lit(0).alias("node"), F.lit(-1).alias("feature"), F.lit(-1).alias("bin"), "left", none.alias("right")), "tree-splits")
    for level in range(spec.max_depth):
        open_ = in_trees(_of_group(binned, _by_group(known, spec)), level)
        offered = (node_features(F.col("g"), F.col("tree"), F.col("node"), n, spec.seed) if spec.forest and n
                   else F.sequence(F.lit(0), F.lit(max(n - 1, 0))))
        cells = open_.select("g", "tree", "node", "y", "w", "bins", F.explode(offered).alias("feature")).withColumn("bin", F.get("bins", F.col("feature")))
        new = _stored(_best_cuts(cells.groupBy("g", "tree", "node", "feature", "bin").agg(*counts), spec).select(*known.columns), "tree-splits")
        if not new.limit(1).count():
            break
        known = known.unionByName(new)
    return _stored(_of_group(_by_group(known, spec, "left", "right"), cuts), "tree-models")


def score(rows: DataFrame, model: DataFrame, group: str, features: Column, spec: TreeSpec = TreeSpec()) -> DataFrame:
    """``rows`` with rawPrediction, probability (arrays) and prediction.

    A tree's raw prediction is its leaf's class counts; a forest's is the sum of its trees' class shares.
    """
    packed = rows.select(F.struct("*").alias("_d"), F.col(group).alias("g"), features.cast("array<double>").alias("x"))
    met = _of_group(packed, model, "left")
    usable = F.col("nodes").isNotNull() & ~F.exists("x", lambda v: v.isNull() | F.isnan(v))
    share = lambda c: F.transform(c, lambda v: v / F.aggregate(c, F.lit(0.0), lambda a, b: a + b))
    zeros = F.array_repeat(F.lit(0.0), spec.n_classes)
    add = lambda a, b: F.zip_with(a, b, lambda u, v: u + v)
    leaf = lambda t: _leaf(t, spec)
    trees = F.sequence(F.lit(0), F.lit(spec.num_trees - 1))
    # a tree whose sample of a small group is empty has no say
    raw = (F.aggregate(F.filter(F.transform(trees, leaf), lambda c: c.isNotNull()), zeros, lambda a, c: add(a, share(c)))
           if spec.forest else leaf(F.lit(0)))
    scored = met.withColumn("bins", F.when(usable, _bins(F.col("x"), F.col("cuts")))).withColumn("raw", F.when(usable, raw))
    best = F.array_position("raw", F.array_max("raw")) - 1  # the first of equals
    out = scored.withColumn("prob", share(F.col("raw"))).withColumn("best", best.cast("double"))
    kept = [F.col("_d")[c].alias(c) for c in rows.columns if c not in ("rawPrediction", "probability", "prediction")]
    return out.select(*kept, F.col("raw").alias("rawPrediction"), F.col("prob").alias("probability"), F.col("best").alias("prediction"))
