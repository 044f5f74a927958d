"""Classifiers on forecast features."""

from __future__ import annotations

from typing import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def classifier(kind: str = "mlp", n_features: int = 21, n_classes: int = 3, max_iter: int = 1,
               hidden_layers: Sequence[int] = (10, 5), block_size: int = 128, seed: int = 1234,
               max_depth: int = 5, max_bins: int = 10, min_instances_per_node: int = 1, num_trees: int = 20,
               features: str = "features", label: str = "label"):
    """M16 MLP (layers [n_features, hidden..., n_classes]), M17 random forest, M18 decision tree."""
    if kind == "rf":
        return RandomForestClassifier(featuresCol=features, labelCol=label, maxDepth=max_depth, maxBins=max_bins,
                                      seed=seed, minInstancesPerNode=min_instances_per_node, numTrees=num_trees)
    if kind == "dt":
        return DecisionTreeClassifier(featuresCol=features, labelCol=label, maxDepth=max_depth, maxBins=max_bins,
                                      minInstancesPerNode=min_instances_per_node, seed=seed)
    if kind == "mlp":
        layers = [int(n_features), *[int(h) for h in hidden_layers], int(n_classes)]
        return MultilayerPerceptronClassifier(featuresCol=features, labelCol=label, maxIter=max_iter,
                                              layers=layers, blockSize=block_size, seed=seed)
    raise ValueError(kind)


def classification_pipeline(kind: str = "mlp", scale: bool = False, **params) -> Pipeline:
    """Optional standardisation (on a copy of the features) + classifier."""
    if not scale:
        return Pipeline(stages=[classifier(kind, **params)])
    return Pipeline(stages=[
        StandardScaler(inputCol="features", outputCol="_scaled", withMean=True, withStd=True),
        classifier(kind, features="_scaled", **params),
    ])


def scored_arrays(pred: DataFrame) -> DataFrame:
    """Vectors of a scored frame as arrays (features, rawPrediction, probability)."""
    out = pred
    for c in ("features", "rawPrediction", "probability"):
        if c in pred.columns:
            out = out.withColumn(c, vector_to_array(F.col(c)))
    return out.drop("_scaled")
