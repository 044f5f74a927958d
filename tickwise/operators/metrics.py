"""Model-quality metrics as plain aggregates (M10, M13 residuals, M20).

Computed from a predictions frame with one partial aggregate, so they can be
grouped (per company, per model) and checked by any SQL engine.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                       by: Sequence[str] = ()) -> DataFrame:
    """N, RMSE, MAE and R^2 per group in ONE aggregate (no second pass for the mean).

    SST = var_pop(label) * n: Spark merges central moments, so large labels do not cancel.
    """
    l, p = F.col(label), F.col(prediction)
    err = p - l
    agg = pred.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(err * err).alias("_sse"),
        F.sum(F.abs(err)).alias("_sae"),
        F.var_pop(l).alias("_var"),
    )
    n = F.col("n").cast("double")
    sst = F.col("_var") * n
    return agg.select(
        *by, "n",
        F.sqrt(F.col("_sse") / n).alias("rmse"),
        (F.col("_sae") / n).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.col("_sse"), sst)).alias("r2"),
    )


def residuals(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """residual = label - prediction per row."""
    return pred.withColumn("residual", F.col(label) - F.col(prediction))


def confusion_counts(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n) - at most classes^2 rows."""
    return pred.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def classification_report(pred: DataFrame, classes: Sequence[int], label: str = "label",
                          prediction: str = "prediction") -> DataFrame:
    """Per-class tp/fp/fn/support, precision, recall, F1 and overall accuracy.

    Aggregates the tiny confusion table; every class row sees all cells (the
    class list is exploded per cell, no join).
    """
    cm = confusion_counts(pred, label, prediction)
    ex = cm.select(F.explode(F.array(*[F.lit(int(c)) for c in classes])).alias("class"), "label", "prediction", "n")
    c, lab, pr, n = F.col("class"), F.col("label"), F.col("prediction"), F.col("n")
    rep = ex.groupBy("class").agg(
        F.coalesce(F.sum(F.when((lab == c) & (pr == c), n)), F.lit(0)).cast("long").alias("tp"),
        F.coalesce(F.sum(F.when((lab != c) & (pr == c), n)), F.lit(0)).cast("long").alias("fp"),
        F.coalesce(F.sum(F.when((lab == c) & (pr != c), n)), F.lit(0)).cast("long").alias("fn"),
        (F.sum(F.when(lab == pr, n)) / F.sum(n)).alias("accuracy"),
    )
    prec = F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double"))
    rec = F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double"))
    rep = rep.withColumn("support", F.col("tp") + F.col("fn")).withColumn("precision", prec).withColumn("recall", rec)
    return rep.withColumn("f1", F.try_divide(F.lit(2.0) * F.col("precision") * F.col("recall"),
                                             F.col("precision") + F.col("recall")))
