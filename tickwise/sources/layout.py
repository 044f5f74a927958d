"""Storage layout for co-located joins.

The one data-sized join of the price views is orders x customer on the
customer key.  Writing both tables bucketed (and sorted) by that key with the
same bucket count lets Spark run the sort-merge join without shuffling either
side; later jobs reuse the layout for free.  Tables are written as external
tables under the shared checkpoint folder (never a machine-local path).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickwise.session import scratch_path
from tickwise.sources.tables import Tables


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` as an external table bucketed and sorted by ``key``; return a reader."""
    spark = df.sparkSession
    path = scratch_path(spark, f"bucketed/{name}")
    (df.write.mode("overwrite").format("parquet").option("path", path)
       .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return spark.table(name)


def co_located(t: Tables, buckets: int = 64, prefix: str = "tw") -> Tables:
    """A ``Tables`` handle whose orders and customer are bucketed by customer key."""
    orders = write_bucketed(t.orders, f"{prefix}_orders_by_cust", "o_custkey", buckets)
    customer = write_bucketed(t.customer, f"{prefix}_customer_by_cust", "c_custkey", buckets)
    return Tables(t.spark, t.sf_dir, overrides={"orders": orders, "customer": customer})
