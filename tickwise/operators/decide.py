"""BUY / SELL / WAIT decisions from forecasts (R7, the ``should I buy`` flow).

forecast (R1) -> next-day label per company (W1/W2/P12, one partitioned
window) -> 21-component feature vector (M1) -> per-company split (M2) ->
classifier (M16-M18) -> scored held-out rows (M19).

The labelled forecast is written to the shared folder once (a lost executor
does not recompute it).  Trees and forests of all companies grow in one plan
(``trees``).  The perceptron is a Spark ML fit per company: rows get a folder
per company, fits read only their own and run in bounded batches, and scores
are appended to a result table.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from itertools import islice
from typing import Optional, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.operators import trees
from tickwise.operators.clean import drop_incomplete
from tickwise.operators.classify import classification_pipeline, scored_arrays
from tickwise.operators.forecast import ForecastSpec, forecast
from tickwise.operators.select import DateLike, as_of_date, forecast_input, last_days
from tickwise.operators.windows import label_series
from tickwise.schema import DECISION_FEATURES, FORECAST_COMPONENTS
from tickwise.sources.files import scratch


@dataclass(frozen=True)
class DecideSpec:
    classifier: str = "mlp"
    max_iter: int = 1
    hidden_layers: Sequence[int] = field(default=(10, 5))
    block_size: int = 128
    seed: int = 1234
    val_split: float = 0.2
    max_depth: int = 5
    max_bins: int = 10
    min_instances_per_node: int = 1
    num_trees: int = 20
    scale: bool = False
    keep_last: bool = False
    score_all: bool = False
    threads: int = 4
    batch: int = 16


OUTPUT_COLUMNS = (["ds"] + list(FORECAST_COMPONENTS) + ["company", "training_date", "label", "id", "yhat_next",
                                                       "features", "rawPrediction", "probability", "prediction"])


def predict_values(prices: DataFrame, value: str = "close", spec: ForecastSpec = ForecastSpec(),
                   last: Optional[int] = None, as_of: DateLike = None) -> DataFrame:
    """E1 ``predict``: forecast ``value`` of every company, stamped with the run date."""
    px = last_days(prices, last, as_of) if last else prices
    hist = forecast_input(drop_incomplete(px), value)
    return forecast(hist, spec).withColumn("training_date", as_of_date(as_of))


def labeled_features(fc: DataFrame, keep_last: bool = False) -> DataFrame:
    """Next-day label of yhat per company + the assembled feature vector (every row stays; a missing component is NaN)."""
    lab = label_series(fc, "yhat", order="ds", keep_last=keep_last)
    return VectorAssembler(inputCols=list(DECISION_FEATURES), outputCol="features",
                           handleInvalid="keep").transform(lab)


def held_out(val_split: float, id_column: str = "id") -> Column:
    """Per-company split on the running row number: ``val_split`` 0.2 holds out every fifth row.

    Exact in integers (``id * percent mod 100 < percent``), so a retried task
    and any SQL engine put a row on the same side.
    """
    percent = int(round(val_split * 100))
    return F.pmod(F.col(id_column) * percent, F.lit(100)) < percent


def decide(prices: DataFrame, value: str = "close", fspec: ForecastSpec = ForecastSpec(),
           dspec: DecideSpec = DecideSpec(), last: Optional[int] = None, as_of: DateLike = None) -> DataFrame:
    """E2 ``should_I_buy``: scored held-out rows (all rows with ``score_all``) of every company.

    Trees and forests (``dt``, ``rf``) of all companies are one plan, whose jobs
    depend on the depth.  For ``mlp`` the labelled rows are written with a folder
    per company, so a fit reads only its own company.  Companies are streamed to the driver in batches of
    ``dspec.batch``; a batch's models are fitted side by side and its scores
    appended to the result table.  Plans and driver memory depend on the batch
    size, not on the number of companies.  Rows with a missing component, and
    companies without training rows, stay in the result without a prediction.
    """
    fc = predict_values(prices, value, fspec, last, as_of)
    spark = fc.sparkSession
    complete = F.lit(True)
    for c in DECISION_FEATURES:
        complete = complete & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    tagged = labeled_features(fc, dspec.keep_last).select(
        "*", complete.alias("_complete"), held_out(dspec.val_split).alias("_held_out"),
        F.xxhash64("company").alias("_folder"))
    if dspec.classifier in ("dt", "rf"):
        return _decide_by_trees(tagged, dspec)
    folder, result = scratch(spark, "decide-rows"), scratch(spark, "decide-scores")
    tagged.repartition("_folder").write.partitionBy("_folder").parquet(folder)
    data = spark.read.schema(tagged.schema).parquet(folder)
    empty = unscored(data.limit(0)).select(*OUTPUT_COLUMNS)
    empty.write.parquet(result)

    params = dict(max_iter=dspec.max_iter, hidden_layers=dspec.hidden_layers, block_size=dspec.block_size,
                  seed=dspec.seed, max_depth=dspec.max_depth, max_bins=dspec.max_bins,
                  min_instances_per_node=dspec.min_instances_per_node, num_trees=dspec.num_trees,
                  n_features=len(DECISION_FEATURES), n_classes=3)

    def one(company) -> DataFrame:
        rows = data.where((F.col("_folder") == company["_folder"]) & F.col("company").eqNullSafe(F.lit(company["company"])))
        wanted = rows if dspec.score_all else rows.where("_held_out")
        if not company["n_train"]:  # nothing to learn from: the rows stay, undecided
            return unscored(wanted).select(*OUTPUT_COLUMNS)
        model = classification_pipeline(dspec.classifier, dspec.scale, **params).fit(rows.where("_complete AND NOT _held_out"))
        scored = scored_arrays(model.transform(wanted.where("_complete"))).select(*OUTPUT_COLUMNS)
        if not company["n_incomplete"]:
            return scored
        return scored.unionByName(unscored(wanted.where("NOT _complete")).select(*OUTPUT_COLUMNS))

    companies = data.groupBy("_folder", "company").agg(
        F.count_if(F.col("_complete") & ~F.col("_held_out")).alias("n_train"),
        F.count_if(~F.col("_complete")).alias("n_incomplete")).toLocalIterator()
    with ThreadPoolExecutor(max_workers=max(1, dspec.threads)) as pool:
        while batch := list(islice(companies, dspec.batch)):
            scores = reduce(DataFrame.unionByName, pool.map(one, batch))
            scores.coalesce(max(1, dspec.threads)).write.mode("append").parquet(result)
    return spark.read.schema(empty.schema).parquet(result)


def tree_spec(dspec: DecideSpec) -> trees.TreeSpec:
    return trees.TreeSpec(n_classes=3, num_trees=dspec.num_trees if dspec.classifier == "rf" else 1, max_depth=dspec.max_depth,
                          max_bins=dspec.max_bins, min_instances=dspec.min_instances_per_node, seed=dspec.seed)


def _decide_by_trees(tagged: DataFrame, dspec: DecideSpec) -> DataFrame:
    """Fit the trees of every company together and score its rows; cuts are by order, so scaling changes nothing."""
    folder = scratch(tagged.sparkSession, "decide-rows")
    tagged.write.parquet(folder)
    rows = tagged.sparkSession.read.schema(tagged.schema).parquet(folder)
    values, spec = F.array(*[F.col(c).cast("double") for c in DECISION_FEATURES]), tree_spec(dspec)
    model = trees.fit(rows.where("_complete AND NOT _held_out"), "company", values, "label", "id", spec)
    wanted = rows if dspec.score_all else rows.where("_held_out")
    scored = trees.score(wanted, model, "company", values, spec)
    return scored.withColumn("features", vector_to_array("features")).select(*OUTPUT_COLUMNS)


def unscored(rows: DataFrame) -> DataFrame:
    """Rows in the shape of a scored frame, without a prediction."""
    return (scored_arrays(rows).withColumn("rawPrediction", F.lit(None).cast("array<double>"))
            .withColumn("probability", F.lit(None).cast("array<double>"))
            .withColumn("prediction", F.lit(None).cast("double")))
