"""Access to the driver's parquet tables.

Only the path is resolved here; column pruning and predicate pushdown are left
to Catalyst, which pushes them into the parquet scan of each query.
"""

from __future__ import annotations

import os
from typing import Optional

from pyspark.sql import DataFrame, SparkSession

from tickwise.session import ship_package

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


class Tables:
    """Lazy handle on the parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str = DEFAULT_SF_DIR,
                 overrides: Optional[dict[str, DataFrame]] = None):
        self.spark = spark
        self.sf_dir = sf_dir
        ship_package(spark)  # UDF code must be importable on the executors
        # overrides: tables served from another layout (e.g. bucketed copies)
        self._frames: dict[str, DataFrame] = dict(overrides or {})

    def path(self, name: str) -> str:
        if name not in TABLES:
            raise KeyError(name)
        return os.path.join(self.sf_dir, f"{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            # one lazy reader per table and handle (file listing done once per query build)
            if name not in self._frames:
                self._frames[name] = self.spark.read.parquet(self.path(name))
            return self._frames[name]
        raise AttributeError(name)

    def __getitem__(self, name: str) -> DataFrame:
        return self.__getattr__(name)
