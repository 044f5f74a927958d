"""Statistical comparison of experiment samples.

Input: a long table (company, algo, run, rmse).  Every test is a grouped
aggregate or a window over one (company, algorithm pair) - groups are bounded
by the number of runs, never by the whole data set.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.functions.special import two_sided_normal_p


def _sqrt(x: Column) -> Column:
    return F.sqrt(x)


def skew_z(b2: Column, n: Column) -> Column:
    """D'Agostino skewness test statistic from population skewness ``b2``."""
    n = n.cast("double")
    y = b2 * _sqrt(((n + 1) * (n + 3)) / (F.lit(6.0) * (n - 2)))
    beta2 = (F.lit(3.0) * (n * n + 27 * n - 70) * (n + 1) * (n + 3)) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.lit(-1.0) + _sqrt(F.lit(2.0) * (beta2 - 1))
    delta = F.lit(1.0) / _sqrt(F.lit(0.5) * F.ln(w2))
    alpha = _sqrt(F.lit(2.0) / (w2 - 1))
    y = F.when(y == 0, F.lit(1.0)).otherwise(y)
    return delta * F.ln(y / alpha + _sqrt((y / alpha) * (y / alpha) + 1))


def kurtosis_z(b2: Column, n: Column) -> Column:
    """Anscombe-Glynn kurtosis test statistic from population (non-excess) kurtosis."""
    n = n.cast("double")
    e = F.lit(3.0) * (n - 1) / (n + 1)
    varb2 = F.lit(24.0) * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (b2 - e) / _sqrt(varb2)
    sb1 = (F.lit(6.0) * (n * n - 5 * n + 2) / ((n + 7) * (n + 9))
           * _sqrt((F.lit(6.0) * (n + 3) * (n + 5)) / (n * (n - 2) * (n - 3))))
    a = F.lit(6.0) + F.lit(8.0) / sb1 * (F.lit(2.0) / sb1 + _sqrt(F.lit(1.0) + F.lit(4.0) / (sb1 * sb1)))
    term1 = F.lit(1.0) - F.lit(2.0) / (F.lit(9.0) * a)
    denom = F.lit(1.0) + x * _sqrt(F.lit(2.0) / (a - 4))
    term2 = F.when(denom == 0, F.lit(None).cast("double")).otherwise(
        F.signum(denom) * F.pow((F.lit(1.0) - F.lit(2.0) / a) / F.abs(denom), F.lit(1.0 / 3.0)))
    return (term1 - term2) / _sqrt(F.lit(2.0) / (F.lit(9.0) * a))


def normality(samples: DataFrame, value: str = "rmse", by: Sequence[str] = ("company", "algo"),
              alpha: float = 0.05) -> DataFrame:
    """D'Agostino-Pearson K^2 test per group; p from chi-square(2) = exp(-K^2/2).

    Population skewness/kurtosis come from one partial aggregate per group.
    Groups with fewer than 8 samples get NULL statistics.
    """
    mom = samples.groupBy(*by).agg(
        F.count(value).alias("n"),
        F.skewness(value).alias("skew"),
        (F.kurtosis(value) + F.lit(3.0)).alias("kurt"),
    )
    zs = skew_z(F.col("skew"), F.col("n"))
    zk = kurtosis_z(F.col("kurt"), F.col("n"))
    ok = F.col("n") >= 8
    out = mom.select(
        *by, "n",
        F.when(ok, zs).alias("z_skew"),
        F.when(ok, zk).alias("z_kurt"),
    ).withColumn("k2", F.col("z_skew") * F.col("z_skew") + F.col("z_kurt") * F.col("z_kurt"))
    out = out.withColumn("p_value", F.exp(-F.col("k2") / 2))
    return out.withColumn("normal", F.col("p_value") >= F.lit(alpha)).drop("z_skew", "z_kurt")


def rank_sums(samples: DataFrame, value: str = "rmse", by: str = "company", algo: str = "algo") -> DataFrame:
    """Wilcoxon rank-sum test for every algorithm pair within a company.

    Each pair's pooled sample is ranked with mid-ranks for ties; W is the rank
    sum of ``algo_a``; z = (W - n_a (n + 1) / 2) / sqrt(n_a n_b (n + 1) / 12)
    (no tie correction, as the classic large-sample form).  NULL and NaN are no samples.
    """
    samples = samples.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    # each sample joins its company's few algorithm names once and spreads to the pairs it belongs to
    names = samples.groupBy(by).agg(F.collect_set(algo).alias("_algos"))
    others = F.filter("_algos", lambda x: x != F.col(algo))
    spread = F.transform(others, lambda x: F.struct(F.least(F.col(algo), x).alias("algo_a"), F.greatest(F.col(algo), x).alias("algo_b"),
                                                    (F.col(algo) < x).alias("in_a")))
    pooled = samples.select(by, algo, value).join(names, by).select(by, value, F.inline(spread))
    key = [by, "algo_a", "algo_b"]
    w = Window.partitionBy(*key).orderBy(value)
    # mid-rank: (first rank of the tie group + last rank of it) / 2, one ordered window
    ranked = pooled.withColumn("r", (F.rank().over(w) + F.count(F.lit(1)).over(w)) / 2.0)
    agg = ranked.groupBy(*key).agg(
        F.sum(F.when(F.col("in_a"), F.col("r"))).alias("w"),
        F.count_if(F.col("in_a")).alias("n_a"),
        F.count_if(~F.col("in_a")).alias("n_b"),
    )
    na, nb = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    z = (F.col("w") - na * (na + nb + 1) / 2) / F.sqrt(na * nb * (na + nb + 1) / 12)
    return agg.withColumn("z", z).withColumn("p_value", two_sided_normal_p(F.col("z")))


def verdict(tests: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Significance verdict with direction from the sign of z."""
    return tests.withColumn(
        "verdict",
        F.when(F.col("p_value") > F.lit(alpha), F.lit("not significant"))
        .when(F.col("z") < 0, F.concat(F.col("algo_a"), F.lit(" lower")))
        .otherwise(F.concat(F.col("algo_b"), F.lit(" lower"))),
    )
