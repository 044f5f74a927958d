import datetime as dt
import math
import random

import numpy as np
from pyspark.sql import functions as F

from tickwise.operators import compare, joins

D = dt.date


def test_asof_takes_latest_rate_at_or_before(spark):
    px = spark.createDataFrame([("X", D(2020, 1, d), 10.0) for d in (1, 3, 5, 7)],
                               "company string, date date, close double")
    fx = spark.createDataFrame([("X", D(2020, 1, 3), 2.0), ("X", D(2020, 1, 6), 3.0), ("Y", D(2020, 1, 1), 9.0)],
                               "pair string, date date, rate double")
    out = {r.date.day: (r.rate, r.date_asof) for r in
           joins.asof(px, fx, "company", "pair", "date", "date", ["rate"]).collect()}
    assert out[1] == (None, None)          # nothing before
    assert out[3] == (2.0, D(2020, 1, 3))  # same day included
    assert out[5] == (2.0, D(2020, 1, 3))
    assert out[7] == (3.0, D(2020, 1, 6))


def test_adjust_for_actions_only_later_actions(spark):
    px = spark.createDataFrame([("X", D(2020, 1, d), 100.0) for d in (1, 2, 3)], "company string, date date, close double")
    act = spark.createDataFrame([("X", D(2020, 1, 2), "split", 2.0), ("X", D(2020, 1, 3), "dividend", 0.9)],
                                "company string, date date, kind string, ratio double")
    out = {r.date.day: r.adjClose for r in joins.adjust_for_actions(px, act).collect()}
    assert math.isclose(out[1], 100.0 * 0.5 * 0.9)
    assert math.isclose(out[2], 100.0 * 0.9)   # the split on day 2 does not adjust day 2
    assert math.isclose(out[3], 100.0)


def test_semi_anti(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "company string")
    keys = spark.createDataFrame([("a",), ("a",), ("c",)], "ticker string")
    assert sorted(r.company for r in joins.restrict(df, keys).collect()) == ["a", "c"]
    assert [r.company for r in joins.restrict(df, keys, exclude=True).collect()] == ["b"]


def _skew_kurt_reference(x):
    """Brute-force D'Agostino-Pearson K^2 (textbook formulas, numpy)."""
    x = np.asarray(x, float)
    n = len(x)
    m = x.mean()
    m2, m3, m4 = (((x - m) ** k).mean() for k in (2, 3, 4))
    b1, b2 = m3 / m2 ** 1.5, m4 / m2 ** 2
    y = b1 * math.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    beta2 = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9))
    w2 = -1 + math.sqrt(2 * (beta2 - 1))
    delta = 1 / math.sqrt(0.5 * math.log(w2))
    alpha = math.sqrt(2.0 / (w2 - 1))
    zs = delta * math.asinh(y / alpha)
    e = 3.0 * (n - 1) / (n + 1)
    var = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))
    xx = (b2 - e) / math.sqrt(var)
    sb1 = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * math.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6.0 + 8.0 / sb1 * (2.0 / sb1 + math.sqrt(1 + 4.0 / sb1 ** 2))
    den = 1 + xx * math.sqrt(2 / (a - 4.0))
    t2 = math.copysign(abs((1 - 2.0 / a) / den) ** (1 / 3.0), den)
    zk = (1 - 2 / (9.0 * a) - t2) / math.sqrt(2 / (9.0 * a))
    k2 = zs * zs + zk * zk
    return k2, math.exp(-k2 / 2)


def test_normality_matches_brute_force(spark):
    rng = random.Random(3)
    samples = {("c", "lr"): [rng.gauss(0, 1) for _ in range(25)],
               ("c", "ir"): [rng.expovariate(1.0) for _ in range(40)],
               ("c", "tiny"): [1.0, 2.0, 3.0]}
    rows = [(c, a, i, v) for (c, a), vs in samples.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "company string, algo string, run int, rmse double")
    out = {r.algo: r for r in compare.normality(df).collect()}
    for algo in ("lr", "ir"):
        k2, p = _skew_kurt_reference(samples[("c", algo)])
        assert math.isclose(out[algo].k2, k2, rel_tol=1e-9)
        assert math.isclose(out[algo].p_value, p, rel_tol=1e-9, abs_tol=1e-15)
    assert out["tiny"].k2 is None


def test_rank_sums_match_brute_force(spark):
    rng = random.Random(5)
    a = [round(rng.uniform(0, 10), 1) for _ in range(25)]
    b = [round(rng.uniform(1, 11), 1) for _ in range(25)]
    rows = [("c", "a", i, v) for i, v in enumerate(a)] + [("c", "b", i, v) for i, v in enumerate(b)]
    df = spark.createDataFrame(rows, "company string, algo string, run int, rmse double")
    r = compare.verdict(compare.rank_sums(df)).first()
    pooled = sorted(a + b)
    rank = {v: (pooled.index(v) + 1 + len(pooled) - pooled[::-1].index(v)) / 2 for v in pooled}  # mid-ranks
    w = sum(rank[v] for v in a)
    n1, n2 = len(a), len(b)
    z = (w - n1 * (n1 + n2 + 1) / 2) / math.sqrt(n1 * n2 * (n1 + n2 + 1) / 12)
    assert math.isclose(r.w, w) and math.isclose(r.z, z)
    assert abs(r.p_value - math.erfc(abs(z) / math.sqrt(2))) < 2e-7
    assert r.verdict in ("not significant", "a lower", "b lower")
    if r.p_value <= 0.05:
        assert r.verdict == ("a lower" if z < 0 else "b lower")


def test_bucketed_asof_equals_unbucketed(spark):
    from pyspark.sql import functions as F

    rng = random.Random(7)
    px = spark.createDataFrame([(k, D(2020, 1, 1) + dt.timedelta(days=d), 1.0)
                                for k in ("X", "Y") for d in range(0, 200, 3)], "company string, date date, close double")
    fx = spark.createDataFrame([(k, D(2020, 1, 1) + dt.timedelta(days=d), rng.random())
                                for k in ("X", "Y") for d in sorted(rng.sample(range(-20, 200), 15))],
                               "pair string, date date, rate double")
    a = joins.asof(px, fx, "company", "pair", "date", "date", ["rate"])
    b = joins.asof(px, fx, "company", "pair", "date", "date", ["rate"], bucket=lambda c: F.trunc(c, "month"))
    key = lambda r: (r.company, r.date)
    ra, rb = sorted(a.collect(), key=key), sorted(b.collect(), key=key)
    assert [(r.company, r.date, r.rate, r.date_asof) for r in ra] == [(r.company, r.date, r.rate, r.date_asof) for r in rb]
    assert any(r.rate is None for r in ra) and any(r.rate is not None for r in ra)


def test_bucketed_action_adjustment_equals_unbucketed(spark):
    from pyspark.sql import functions as F

    rng = random.Random(9)
    px = spark.createDataFrame([(k, D(2018, 1, 1) + dt.timedelta(days=d), 100.0 + d)
                                for k in ("X", "Y") for d in range(0, 1200, 5)], "company string, date date, close double")
    act = spark.createDataFrame([(k, D(2018, 1, 1) + dt.timedelta(days=rng.randrange(0, 1300)),
                                  rng.choice(["split", "dividend"]), rng.uniform(0.9, 2.0))
                                 for k in ("X", "Y") for _ in range(12)], "company string, date date, kind string, ratio double")
    a = {(r.company, r.date): r.adjClose for r in joins.adjust_for_actions(px, act).collect()}
    b = {(r.company, r.date): r.adjClose
         for r in joins.adjust_for_actions(px, act, bucket=lambda c: F.trunc(c, "year")).collect()}
    assert a.keys() == b.keys() and all(math.isclose(a[k], b[k], rel_tol=1e-12) for k in a)


def test_normal_tail_against_published_values(spark):
    from tickwise.functions.special import two_sided_normal_p

    published = {1.0: 0.31731051, 1.96: 0.04999579, 2.5758293: 0.01, 3.0: 0.00269980}
    rows = spark.createDataFrame([(z,) for z in published], "z double").select("z", two_sided_normal_p(F.col("z")).alias("p")).collect()
    assert all(abs(r.p - published[r.z]) < 2e-7 for r in rows)
