"""Trees of all groups in one plan against a brute-force version, and their plan's size."""

from __future__ import annotations

import math
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickwise.operators import decide, trees
from tickwise.operators import forecast as FC

ROW = "company string, id long, x array<double>, label int"


def rows_of(n_groups: int, n: int, seed: int = 0):
    rng = np.random.RandomState(seed)
    out = []
    for g in range(n_groups):
        name = None if g == 0 else f"c{g}"
        for i in range(n if g else 2 * n):
            x = [float(rng.randint(0, 40)), round(float(rng.rand()), 2), float(rng.randint(0, 2)), 7.0]
            y = int(x[0] > 20) + int(x[1] > 0.5 and x[2] == 1) if g % 3 else int(rng.randint(0, 3))
            out.append((name, i, x, y))
    return out


def cuts_of(xs: np.ndarray, bins: int) -> list[list[float]]:
    return [sorted({float(np.sort(col)[math.ceil(k / bins * len(col)) - 1]) for k in range(1, bins)}) for col in xs.T]


def grow(xs, ys, ws, cuts, spec, offered):
    """{node: (feature, cut, left counts, right counts)} and the root's counts, by trying every cut."""
    counts = lambda m: [float(ws[m & (ys == c)].sum()) for c in range(spec.n_classes)]
    gini = lambda c: sum(v * v for v in c) / sum(c)
    nodes, todo = {}, [(1, np.ones(len(ys), bool))]
    root = counts(todo[0][1])
    while todo:
        node, mask = todo.pop()
        if node >= 1 << spec.max_depth:
            continue
        best = None
        for f in offered(node):
            for t in cuts[f]:
                left, right = counts(mask & (xs[:, f] <= t)), counts(mask & (xs[:, f] > t))
                if min(sum(left), sum(right)) < max(spec.min_instances, 1e-12):
                    continue
                total = [a + b for a, b in zip(left, right)]
                s = gini(left) + gini(right)
                if s > gini(total) + 1e-9 * sum(total) and (best is None or (s, -f, -t) > best[0]):
                    best = (s, -f, -t), (f, t, left, right)
        if best:
            f, t, *_ = nodes[node] = best[1]
            todo += [(2 * node, mask & (xs[:, f] <= t)), (2 * node + 1, mask & (xs[:, f] > t))]
    return nodes, root


def leaf(nodes, root, x):
    node, c = 1, root
    while node in nodes:
        f, t, left, right = nodes[node]
        node, c = (2 * node, left) if x[f] <= t else (2 * node + 1, right)
    return c


@pytest.mark.parametrize("spec", [trees.TreeSpec(max_depth=3, max_bins=8), trees.TreeSpec(max_depth=2, max_bins=4, min_instances=9),
                                  trees.TreeSpec(num_trees=4, max_depth=3, max_bins=8, seed=5)])
def test_trees_equal_brute_force(spark, spec):
    data = rows_of(4, 60)
    frame = spark.createDataFrame(data, ROW)
    model = trees.fit(frame, "company", F.col("x"), "label", "id", spec)
    got = {(r["company"], r["id"]): r for r in trees.score(frame, model, "company", F.col("x"), spec).collect()}
    assert len(got) == len(data)
    for g in {r[0] for r in data}:
        own = [r for r in data if r[0] == g]
        xs, ys = np.array([r[2] for r in own]), np.array([r[3] for r in own])
        cuts, grown = cuts_of(xs, spec.max_bins), []
        for tree in range(spec.num_trees):
            if spec.forest:
                picked = spark.createDataFrame([(g, tree, i) for _, i, _, _ in own], "g string, tree int, id long")
                ws = np.array([r["w"] for r in picked.select("id", trees.bag_weight(F.col("g"), F.col("tree"), F.col("id"), spec.seed).alias("w")).orderBy("id").collect()])
                asked = spark.createDataFrame([(g, tree, node) for node in range(1, 1 << spec.max_depth)], "g string, tree int, node int")
                subset = {r["node"]: r["fs"] for r in asked.select("node", trees.node_features(F.col("g"), F.col("tree"), F.col("node"), 4, spec.seed).alias("fs")).collect()}
                assert ws.sum() > 0.5 * len(ws)
            else:
                ws, subset = np.ones(len(own)), {n: range(4) for n in range(1, 1 << spec.max_depth)}
            grown.append(grow(xs, ys, ws, cuts, spec, subset.__getitem__))
        for _, i, x, _ in own:
            counts = [leaf(*t, x) for t in grown]
            raw = [sum(c[k] / sum(c) for c in counts) for k in range(3)] if spec.forest else counts[0]
            r = got[(g, i)]
            assert r["rawPrediction"] == pytest.approx(raw) and r["probability"] == pytest.approx([v / sum(raw) for v in raw])
            if sorted(raw)[-1] - sorted(raw)[-2] > 1e-9:
                assert r["prediction"] == raw.index(max(raw))


def test_rows_that_cannot_be_learned_from(spark):
    data = [("a", i, [float(i), 1.0], int(i > 3)) for i in range(8)] + [("a", 8, [None, 1.0], 1), ("a", 9, [float("nan"), 1.0], 0), ("a", 10, [1.0, 2.0], None)]
    one_class = [("b", i, [float(i), 0.0], 2) for i in range(4)]
    frame = spark.createDataFrame(data + one_class, ROW)
    model = trees.fit(frame, "company", F.col("x"), "label", "id")
    more = frame.unionByName(spark.createDataFrame([("new", 1, [1.0, 1.0], 0)], ROW)).withColumn("prediction", F.lit("clash"))
    got = {(r["company"], r["id"]): r["prediction"] for r in trees.score(more, model, "company", F.col("x")).collect()}
    assert got[("a", 8)] is None and got[("a", 9)] is None and got[("new", 1)] is None and got[("a", 10)] is not None
    assert all(got[("b", i)] == 2 for i in range(4)) and all(got[("a", i)] == int(i > 3) for i in range(8))
    none = trees.fit(frame.limit(0), "company", F.col("x"), "label", "id")
    assert none.count() == 0 and trees.score(frame, none, "company", F.col("x")).where("prediction IS NOT NULL").count() == 0


def _jobs(spark, run) -> int:
    """Jobs that ``run`` starts."""
    sc, name = spark.sparkContext, f"count-{uuid.uuid4().hex}"
    sc.setJobGroup(name, name)
    try:
        run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(name))


def test_jobs_do_not_grow_with_groups(spark):
    spec, counts = trees.TreeSpec(max_depth=2, max_bins=4), []
    for n in (25, 200):
        frame = spark.createDataFrame([r for r in rows_of(n, 12, 3) if r[0]], ROW)
        counts.append(_jobs(spark, lambda: trees.fit(frame, "company", F.col("x"), "label", "id", spec)))
    assert counts[0] == counts[1] > 0


def test_decision_trees_learn_the_trend(spark):
    """Rising and falling companies: every complete held-out row gets its company's label."""
    data = [(c, f"2020-{m:02d}-{d:02d}", 100.0 + s * (m * 28 + d)) for c, s in (("up", 1.0), ("down", -0.5)) for m in (1, 2, 3) for d in range(1, 28)]
    px = spark.createDataFrame(data, "company string, date string, close double").withColumn("date", F.to_date("date"))
    for kind in ("dt", "rf"):
        out = decide.decide(px, "close", FC.ForecastSpec(periods=5, n_changepoints=0, weekly_order=0, yearly_order=0),
                            decide.DecideSpec(classifier=kind, num_trees=5), as_of="2020-04-01").collect()
        assert {(r["company"], r["prediction"]) for r in out} == {("up", 1.0), ("down", 2.0)}
        assert all(sum(r["probability"]) == pytest.approx(1) for r in out)
