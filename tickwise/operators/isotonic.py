"""Isotonic regression of every group, distributed (M6).

Pool-adjacent-violators may pool its violating neighbours in any order.  So
points are first summed per distinct feature value, cut into range slices and
pooled inside each slice; then neighbouring slices are pooled in pairs, the
pairing moved by one slice from round to round, until no border between two
slices is violated.  Whenever half of the blocks are gone the rest is sliced
anew.  A task holds at most two slices, and no feature values reach the driver.

Predictions follow Spark ML: a block's mean between its first and last value,
linear in the gap between two blocks, the end blocks' means outside.

Defined results: rows with a null or NaN feature, label or weight, or a weight
of 0 or less, are not learned from; a null group is a group; a group without
a model predicts null.
"""

from __future__ import annotations

from typing import Optional

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.operators.joins import asof_sliced
from tickwise.session import ship_package
from tickwise.sources.files import scratch

#: Blocks of a slice.
SLICE_BLOCKS = 1 << 16

BLOCKS = "lo double, hi double, s double, w double"


def pool(s: np.ndarray, w: np.ndarray) -> np.ndarray:
    """First positions of the pooled blocks of one group's blocks in order (sums and weights)."""
    first, sums, weights = [], [], []
    for i in range(len(s)):
        at, a, b = i, float(s[i]), float(w[i])
        while sums and sums[-1] * b > a * weights[-1]:
            at, a, b = first.pop(), a + sums.pop(), b + weights.pop()
        first.append(at)
        sums.append(a)
        weights.append(b)
    return np.array(first, np.int64)


def _pool_frame(pdf: pd.DataFrame) -> pd.DataFrame:
    """Blocks of a task, group by group."""
    pdf = pdf.sort_values(["gk", "lo"], kind="stable").reset_index(drop=True)
    keys = pdf["gk"].to_numpy()
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, int)
    s, w, hi = (pdf[c].to_numpy(float) for c in ("s", "w", "hi"))
    first = np.concatenate([a + pool(s[a:b], w[a:b]) for a, b in zip(starts, [*starts[1:], len(keys)])]) if len(keys) else starts
    out = pdf.iloc[first].copy()
    if len(first):
        out["s"], out["w"] = np.add.reduceat(s, first), np.add.reduceat(w, first)
        out["hi"] = hi[np.append(first[1:], len(hi)) - 1]
    return out


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _violated(blocks: DataFrame) -> bool:
    """Whether a slice begins with a block below the last one of its group; one row per slice is looked at."""
    end = F.struct("gk", "lo", "s", "w")
    ends = blocks.groupBy("slice").agg(F.min(end).alias("a"), F.max(end).alias("b"))
    previous = F.lag("b").over(Window.orderBy("slice"))
    # the very comparison of ``pool``, so that rounding cannot tell the two apart
    return bool(ends.select("a", previous.alias("p")).where("a.gk = p.gk AND p.s * a.w > a.s * p.w").limit(1).count())


def fit(rows: DataFrame, group: Optional[str], feature: str, label: str, weight: Optional[str] = None, isotonic: bool = True,
        slice_blocks: int = SLICE_BLOCKS) -> DataFrame:
    """(g, lo, hi, value, weight): the blocks of every group; ``isotonic`` False fits a falling curve."""
    ship_package(rows.sparkSession)
    x, y, w = F.col(feature).cast("double"), F.col(label).cast("double"), (F.col(weight) if weight else F.lit(1.0)).cast("double")
    sign = 1.0 if isotonic else -1.0
    usable = ~F.exists(F.array(x, y, w), lambda v: v.isNull() | F.isnan(v)) & (w > 0)
    g = F.col(group) if group else F.lit("")
    points = rows.where(usable).groupBy(g.alias("g"), x.alias("lo")).agg(F.sum(y * w * sign).alias("s"), F.sum(w).alias("w"))
    # a text key orders groups, null first
    blocks = _stored(points.select("g", F.coalesce(F.concat(F.lit("="), F.col("g").cast("string")), F.lit("")).alias("gk"),
                                   "lo", F.col("lo").alias("hi"), "s", "w"), "isotonic-points")
    kind = f"g {blocks.schema['g'].dataType.simpleString()}, gk string, {BLOCKS}"
    n, turn = blocks.count(), 0
    while n:
        slices = -(-n // slice_blocks)
        cut = blocks.select("g", "gk", "lo", "hi", "s", "w").repartitionByRange(slices, "gk", "lo") if slices > 1 else blocks.coalesce(1)
        blocks, size = _stored(cut.withColumn("slice", F.spark_partition_id()), "isotonic-slices"), n
        while True:
            # slices that pooling has emptied are skipped, so neighbours meet in one of two rounds; one row per slice
            place = blocks.select("slice").distinct().withColumn("_at", F.row_number().over(Window.orderBy("slice")) - 1)
            task = F.floor((F.col("_at") + turn % 2) / 2) if turn else F.col("_at").cast("long")
            pooled = blocks.join(F.broadcast(place), "slice").select("g", "gk", "lo", "hi", "s", "w", "slice", task.alias("task")).groupBy("task").applyInPandas(
                _pool_frame, f"{kind}, slice int, task long")
            blocks, turn = _stored(pooled.drop("task"), "isotonic-pooled"), turn + 1
            n = blocks.count()
            done = not _violated(blocks)
            if done or 2 * n <= size:
                break
        if done:
            break
    return blocks.select("g", "lo", "hi", (F.col("s") / F.col("w") * sign).alias("value"), F.col("w").alias("weight"))


def predict(rows: DataFrame, model: DataFrame, group: Optional[str], feature: str, name: str = "prediction") -> DataFrame:
    """``rows`` with the curve's value at ``feature``: the nearest blocks on both sides come from sliced as-of joins."""
    at = rows.select(F.struct("*").alias("_d"), (F.col(group) if group else F.lit("")).alias("_g"), F.col(feature).cast("double").alias("_x"))
    low = model.select("g", "lo", F.struct("hi", "value").alias("below"))
    high = model.select("g", (-F.col("lo")).alias("nlo"), F.struct("lo", "value").alias("above"))
    seen = asof_sliced(at, low, "_g", "g", "_x", "lo", ["below"]).drop("lo_asof").withColumn("_nx", -F.col("_x"))
    seen = asof_sliced(seen, high, "_g", "g", "_nx", "nlo", ["above"])
    a, b, v = F.col("below"), F.col("above"), F.col("_x")
    between = a["value"] + (b["value"] - a["value"]) * (v - a["hi"]) / (b["lo"] - a["hi"])
    value = (F.when(v.isNull() | F.isnan(v), F.lit(None).cast("double")).when(a.isNull(), b["value"])
             .when((v <= a["hi"]) | b.isNull(), a["value"]).otherwise(between))
    return seen.withColumn("_p", value).select(*[F.col("_d")[c].alias(c) for c in rows.columns if c != name], F.col("_p").alias(name))
