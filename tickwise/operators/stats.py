"""Aggregations and statistics.

All operators keep a ``by`` grouping (company by default) so one job profiles
every company at once; aggregates are partial (map-side) except exact
percentiles, whose groups are one company's daily series (bounded by the
calendar, not by data volume).
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.operators.ranks import quantiles
from tickwise.operators.slices import carried, inside, sliced, with_carry
from tickwise.schema import PRICE_COLUMNS
from tickwise.sources.files import scratch


def long_form(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ("company",),
              name: str = "metric", value: str = "value") -> DataFrame:
    """Unpivot numeric columns to (by..., metric, value) rows (no shuffle)."""
    return df.unpivot(list(by), [F.col(c).cast("double").alias(c) for c in columns], name, value)


def quantile(v, q: float, exact: bool = True, accuracy: int = 10000):
    """Exact (linear interpolation) or sketch-based quantile.

    Exact quantiles buffer a group's values in one task: use them for groups
    bounded by design (one company's daily series).  ``exact=False`` uses
    ``percentile_approx`` - a mergeable sketch of fixed size, partial-aggregated,
    safe for groups of any size (relative rank error ~ 1/accuracy).
    """
    if exact:
        return F.median(v) if q == 0.5 else F.percentile(v, q)
    return F.percentile_approx(v, q, accuracy).cast("double")


def describe(df: DataFrame, columns: Sequence[str] = PRICE_COLUMNS, by: Sequence[str] = ("company",),
             exact: bool = True, ranges: bool = False) -> DataFrame:
    """A1/A2: count, mean, sample std, min, quartiles, max per column.

    Unlike ``DataFrame.summary`` the quantiles are exact by default (linear
    interpolation) and the output is typed and keeps the grouping.  With
    ``ranges`` they are exact for groups of any size (``ranks.quantiles``).
    """
    v = F.col("value")
    if ranges:
        lf, keys = long_form(df, columns, by), [*by, "metric"]
        plain = lf.groupBy(*keys).agg(F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"))
        return _with_quartiles(plain, lf, keys, ("q25", "median", "q75")).select(*keys, "count", "mean", "std", "min", "q25", "median", "q75", "max")
    return (
        long_form(df, columns, by)
        .groupBy(*by, "metric")
        .agg(
            F.count(v).alias("count"),
            F.avg(v).alias("mean"),
            F.stddev_samp(v).alias("std"),
            F.min(v).alias("min"),
            quantile(v, 0.25, exact).alias("q25"),
            quantile(v, 0.5, exact).alias("median"),
            quantile(v, 0.75, exact).alias("q75"),
            F.max(v).alias("max"),
        )
    )


def _with_quartiles(groups: DataFrame, rows: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``groups`` (one row per key) with the exact quartiles of ``rows.value``; NULL for a group without values."""
    q = quantiles(rows, keys, "value", (0.25, 0.5, 0.75)).select(*[F.col(k).alias(f"_q{i}") for i, k in enumerate(keys)], *[F.col(f"q{i}").alias(n) for i, n in enumerate(names)])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_q{i}")) for i, k in enumerate(keys)])
    return groups.join(q, same, "left").drop(*[f"_q{i}" for i in range(len(keys))])


def histogram(df: DataFrame, column: str, bins: int = 10, by: Sequence[str] = ("company",)) -> DataFrame:
    """A4: equal-width histogram per group (bins over each group's own range).

    One min/max aggregate (tiny, one row per group) is joined back; Catalyst
    broadcasts it when its measured size allows.  The maximum falls in the
    last bin, as in the usual plotting convention.
    """
    x = F.col(column)
    rng = df.groupBy(*by).agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    raw = F.floor(F.try_divide(x - F.col("lo"), width)).cast("int")
    bucket = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1)))
    return (
        df.select(*by, column).join(rng, list(by))
        .withColumn("bin", bucket)
        .groupBy(*by, "bin", "lo", "hi")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*by, "bin",
                (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / F.lit(float(bins))).alias("bin_lo"),
                (F.col("lo") + (F.col("bin") + 1) * (F.col("hi") - F.col("lo")) / F.lit(float(bins))).alias("bin_hi"),
                "n")
    )


def box_stats(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ("company",), k: float = 1.5,
              exact: bool = True, ranges: bool = False) -> DataFrame:
    """A5: quartiles, IQR, whiskers and outlier count per (group, column).

    With ``ranges`` the quartiles are exact for groups of any size.

    Quartiles come from one aggregate (one row per group x column, joined
    back - broadcast by size); the whisker/outlier aggregate carries them as
    grouping keys, so no further join is needed.
    """
    lf = long_form(df, columns, by)
    v = F.col("value")
    if ranges:
        q = quantiles(lf, [*by, "metric"], "value", (0.25, 0.5, 0.75)).toDF(*by, "metric", "q1", "median", "q3")
    else:
        q = lf.groupBy(*by, "metric").agg(
            quantile(v, 0.25, exact).alias("q1"),
            quantile(v, 0.5, exact).alias("median"),
            quantile(v, 0.75, exact).alias("q3"),
        )
    q = (q.withColumn("iqr", F.col("q3") - F.col("q1"))
          .withColumn("lo_fence", F.col("q1") - F.lit(k) * F.col("iqr"))
          .withColumn("hi_fence", F.col("q3") + F.lit(k) * F.col("iqr")))
    inside = v.between(F.col("lo_fence"), F.col("hi_fence"))
    keys = list(by) + ["metric", "q1", "median", "q3", "iqr", "lo_fence", "hi_fence"]
    return lf.join(q, list(by) + ["metric"]).groupBy(*keys).agg(
        F.min(F.when(inside, v)).alias("whisker_lo"),
        F.max(F.when(inside, v)).alias("whisker_hi"),
        F.count_if(~inside).alias("outliers"),
        F.count(v).alias("n"),
    )


def outlier_rows(df: DataFrame, column: str, by: Sequence[str] = ("company",), k: float = 1.5,
                 exact: bool = True) -> DataFrame:
    """Rows of ``df`` whose ``column`` lies outside the 1.5*IQR fences of its group."""
    v = F.col(column)
    fences = df.groupBy(*by).agg(
        quantile(v, 0.25, exact).alias("_q1"), quantile(v, 0.75, exact).alias("_q3"))
    iqr = F.col("_q3") - F.col("_q1")
    return (df.join(fences, list(by))
            .filter((v < F.col("_q1") - F.lit(k) * iqr) | (v > F.col("_q3") + F.lit(k) * iqr))
            .drop("_q1", "_q3"))


def correlation(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ("company",),
                method: str = "pearson", rank_buckets: int | None = None) -> DataFrame:
    """Long correlation matrix (by..., feature_a, feature_b, r, method).

    Long form: each row is expanded to one (x, y) cell per column pair and a
    single ``corr`` runs grouped by (group, pair).  The partial aggregate sits
    right after the expansion in the same stage, so only one small buffer per
    (group, pair) and task reaches the shuffle.  For Spearman the values are
    first replaced by average ranks within the group; where a value is missing,
    ranks are taken pair by pair over the rows that have both.  A pair with a
    constant column, its diagonal included, has no correlation (NULL).
    """
    cols = list(columns)
    src = df.select(*by, *cols)
    if method == "spearman":
        missing = [F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in cols]
        if src.where(reduce(Column.__or__, missing)).limit(1).count():
            return _pairwise_spearman(src, cols, by, rank_buckets)
        src = average_ranks(src, cols, by, rank_buckets)
    elif method != "pearson":
        raise ValueError(method)
    pairs = list(combinations(cols, 2))
    # Built as SQL expression text: one JVM call instead of hundreds of tiny ones.
    cells = ", ".join(f"named_struct('x', CAST(`{a}` AS DOUBLE), 'y', CAST(`{b}` AS DOUBLE))" for a, b in pairs)
    long = src.select(*by, F.expr(f"posexplode(array({cells}))").alias("p", "xy"))
    x, y = F.col("xy.x"), F.col("xy.y")
    r = long.groupBy(*by, "p").agg(_pearson(x, y, _ansi(df)).alias("r"), *_varies())
    return _matrix(r, cols, by).withColumn("method", F.lit(method))


def _pearson(x: Column, y: Column, ansi: bool) -> Column:
    """Pearson's r over the rows that have both, NULL where one is constant (in ANSI mode ``corr`` fails there)."""
    if not ansi:
        return F.corr(x, y)
    both = F.var_pop(F.when(y.isNotNull(), x)) * F.var_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), F.sqrt(both))


def _ansi(df: DataFrame) -> bool:
    return df.sparkSession.conf.get("spark.sql.ansi.enabled") == "true"


def _varies() -> list[Column]:
    """Whether the columns of a pair have two different values."""
    return [(F.min(f"xy.{v}") < F.max(f"xy.{v}")).alias(f"varies_{v}") for v in "xy"]


def _matrix(r: DataFrame, cols: list, by: Sequence[str]) -> DataFrame:
    """(by..., feature_a, feature_b, r) of all ordered pairs from one row per (by, pair number p)."""
    pairs = list(combinations(cols, 2))
    names_a = ", ".join(f"'{a}'" for a, _ in pairs)
    names_b = ", ".join(f"'{b}'" for _, b in pairs)
    na, nb = f"element_at(array({names_a}), p + 1)", f"element_at(array({names_b}), p + 1)"
    cell = lambda a, b, v: f"named_struct('feature_a', {a}, 'feature_b', {b}, 'r', {v})"
    one = lambda v: f"CASE WHEN varies_{v} THEN CAST(1.0 AS DOUBLE) END"
    both = f"{cell(na, nb, 'r')}, {cell(nb, na, 'r')}"
    # the pairs of the first column give the diagonal: its partners', and with the first pair its own
    out = F.expr(f"inline(CASE WHEN p = 0 THEN array({both}, {cell(nb, nb, one('y'))}, {cell(na, na, one('x'))}) "
                 f"WHEN p < {len(cols) - 1} THEN array({both}, {cell(nb, nb, one('y'))}) ELSE array({both}) END)")
    return r.select(*by, out)


def _pairwise_spearman(src: DataFrame, cols: list, by: Sequence[str], buckets: int | None) -> DataFrame:
    """Spearman on the rows that have both values of a pair (ranks per pair)."""
    known = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    cells = F.array(*[F.struct(known(a).alias("x"), known(b).alias("y")) for a, b in combinations(cols, 2)])
    long = src.select(*by, F.posexplode(cells).alias("p", "xy"))
    varies = long.groupBy(*by, "p").agg(*_varies())
    full = long.where("xy.x IS NOT NULL AND xy.y IS NOT NULL").select(*by, "p", "xy.x", "xy.y")
    ranks = average_ranks(full, ["x", "y"], [*by, "p"], buckets)
    r = ranks.groupBy(*by, "p").agg(_pearson(F.col("x"), F.col("y"), _ansi(src)).alias("r"))
    keys = [*by, "p"]
    named = r.select(*[F.col(k).alias(f"_{k}") for k in keys], "r")
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return _matrix(varies.join(named, same, "left").drop(*[f"_{k}" for k in keys]), cols, by).withColumn("method", F.lit("spearman"))


def vector_correlation(df: DataFrame, features: Sequence[str], method: str = "pearson") -> DataFrame:
    """A6/A7 on an assembled ML vector (``pyspark.ml.stat.Correlation``), long form.

    Global over the whole frame; Spark computes it distributedly.  Spearman is
    Pearson on the rows' ranks (``ranked_values``; ML's own form sorts every
    value of every row).  Only the k x k matrix reaches the driver.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    if method not in ("pearson", "spearman"):
        raise ValueError(method)
    rows = ranked_values(df, features) if method == "spearman" else df.select(*features)
    vec = VectorAssembler(inputCols=rows.columns, outputCol="_v", handleInvalid="skip").transform(rows).select("_v")
    m = Correlation.corr(vec, "_v", "pearson").head()[0].toArray()
    rows = [(a, b, float(m[i][j])) for i, a in enumerate(features) for j, b in enumerate(features)]
    out = df.sparkSession.createDataFrame(rows, "feature_a STRING, feature_b STRING, r DOUBLE")
    return out.withColumn("method", F.lit(method))


#: A column's ranks are broadcast up to this many different values (16 bytes each).
BROADCAST_VALUES = 200_000


def ranked_values(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(r0, r1, ...): each feature's average rank (1-based, ties averaged) over all rows without a missing value or NaN.

    Equal values of a feature are counted together before any shuffle and only
    the different ones are ordered, in ranges of their own; the rows then get
    the ranks by a join on the value.
    """
    k = range(len(features))
    rows = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(features)]).na.drop()
    counts = rows.select(F.posexplode(F.array(*rows.columns)).alias("i", "v")).groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    scan = sliced(counts, ["i"], [F.col("v")], "rank-values")
    carry = carried(scan, ["i"], F.sum("n"), F.sum, "_before")
    upto = F.coalesce("_before", F.lit(0)) + F.sum("n").over(inside(["i"], [F.col("v")], Window.unboundedPreceding, 0))
    ranked = with_carry(scan, ["i"], carry, "_before").select("i", "v", (upto - (F.col("n") - 1) / 2).cast("double").alias("rank"))
    path = scratch(df.sparkSession, "value-ranks")
    ranked.write.parquet(path)
    stored = df.sparkSession.read.schema(ranked.schema).parquet(path)
    different = {r["i"]: r["count"] for r in stored.groupBy("i").count().collect()}  # one row a feature
    for i in k:
        of = stored.where(F.col("i") == i).select(F.col("v").alias(f"_k{i}"), F.col("rank").alias(f"r{i}"))
        rows = rows.join(F.broadcast(of) if different.get(i, 0) <= BROADCAST_VALUES else of, F.col(f"v{i}") == F.col(f"_k{i}"))
    return rows.select(*[f"r{i}" for i in k])


def average_ranks(df: DataFrame, columns: Sequence[str], by: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Replace each column by its average rank (1-based, ties averaged) within ``by``.

    Default: (rank() + rows up to and including the ties) / 2 over one ordered
    window per column - one task per group, right for groups bounded by the
    calendar.  ``buckets=K`` is the distributed form for groups of any size:
    see ``_bucketed_average_ranks``.
    """
    if buckets:
        out = df
        for c in columns:
            out = _bucketed_average_ranks(out, c, list(by), buckets)
        return out
    ranked = []
    for c in df.columns:
        if c in columns:
            # NULLs are ranked apart and keep NULL
            w = Window.partitionBy(*by, F.col(c).isNull()).orderBy(F.col(c))
            rank = ((F.rank().over(w) + F.count(F.lit(1)).over(w)) / 2.0).cast("double")
            ranked.append(F.when(F.col(c).isNotNull(), rank).alias(c))
        else:
            ranked.append(F.col(c))
    return df.select(*ranked)


def _bucketed_average_ranks(df: DataFrame, c: str, by: list, k: int) -> DataFrame:
    """Average ranks without a whole group in one task.

    1. collapse ties: (group, value, n) - a partial aggregate, so a hot value is one row;
    2. split each group's distinct values into ~k ranges (sketch boundaries);
    3. rows before each range = prefix sum over the small (group, range) totals;
    4. rank inside (group, range) only; average rank = before + earlier-in-range + (n + 1) / 2;
    5. join the rank back on (group, value).
    NULL values keep NULL, as in the window form.
    """
    v = F.col(c)
    d = df.filter(v.isNotNull()).groupBy(*by, c).agg(F.count(F.lit(1)).alias("_n"))
    probs = [i / k for i in range(1, k)]
    bounds = d.groupBy(*by).agg(F.percentile_approx(c, probs, 10000).alias("_bounds"))
    d = d.join(bounds, by).withColumn("_r", F.size(F.filter("_bounds", lambda b: b < v))).drop("_bounds")
    totals = d.groupBy(*by, "_r").agg(F.sum("_n").alias("_tot"))
    before = Window.partitionBy(*by).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_off", F.coalesce(F.sum("_tot").over(before), F.lit(0)))
    inside = Window.partitionBy(*by, "_r").orderBy(c).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (d.join(totals.select(*by, "_r", "_off"), by + ["_r"])
             .withColumn("_rank", (F.col("_off") + F.coalesce(F.sum("_n").over(inside), F.lit(0))).cast("double")
                         + (F.col("_n") + 1) / 2.0)
             .select(*by, c, "_rank"))
    out = df.join(ranks, by + [c], "left")
    return out.select(*[F.col("_rank").alias(x) if x == c else F.col(x) for x in df.columns])


def redundant_pairs(corr_long: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Off-diagonal pairs with |r| above the threshold (each pair once)."""
    return corr_long.filter(
        (F.abs(F.col("r")) > F.lit(threshold)) & (F.col("feature_a") < F.col("feature_b")))


def mean_by(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """A3: mean of ``value`` per group."""
    return df.groupBy(*by).agg(F.avg(value).alias(f"mean_{value}"), F.count(value).alias("n"))


def median_table(df: DataFrame, value: str, row: str, column: str,
                 column_values: Optional[Sequence[str]] = None, exact: bool = True) -> DataFrame:
    """A10: median of ``value`` as a row x column table; every column value of the data unless some are given."""
    return df.groupBy(row).pivot(column, column_values and list(column_values)).agg(quantile(F.col(value), 0.5, exact))


def match_counts(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """How many predictions equal the label."""
    return df.groupBy((F.col(prediction) == F.col(label)).alias("correct")).agg(F.count(F.lit(1)).alias("n"))


def is_missing(df: DataFrame, column: str) -> Column:
    """NULL, or NaN in a floating-point column: what dropping incomplete rows drops."""
    missing = F.col(column).isNull()
    return missing | F.isnan(column) if df.schema[column].dataType.typeName() in ("double", "float") else missing


def row_counts(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and complete (no NULL, no NaN) rows in one job."""
    cols = df.columns
    complete = F.lit(True)
    for c in cols:
        complete = complete & ~is_missing(df, c)
    # Two-level aggregate: collapse identical rows (partial aggregation absorbs a
    # hot row value), then one global sum over the distinct rows.
    per_row = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_k"))
    return per_row.agg(
        F.sum("_k").alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.when(complete, F.col("_k"))), F.lit(0)).cast("long").alias("complete_rows"),
    )


def grid_pivot(df: DataFrame, rows: str, cols: str, value: str,
               col_values: Optional[Sequence] = None) -> DataFrame:
    """Rows x columns grid of sums; every column value of the data unless some are given."""
    return df.groupBy(rows).pivot(cols, col_values and list(col_values)).agg(F.sum(value))


def grid_rollup(df: DataFrame, rows: str, cols: str, value: str) -> DataFrame:
    """Indicator x country grid with rollup totals (NULL marks a total)."""
    return (df.rollup(rows, cols)
            .agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n"),
                 F.grouping_id().alias("level")))
