"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwise.session import ensure_checkpoint_dir

#: White space of the word rule: space and the control characters 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"

#: A relation is broadcast only when its counted rows times its row width stay below this.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and return the table.

    Cuts the lineage like ``checkpoint()`` and keeps columns prunable; a lost
    executor costs nothing because every reader sees the shared files.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted size is within BROADCAST_BYTES, else unchanged (shuffle join)."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it inside lambdas."""
    return F.transform(F.array(value), body).getItem(0)


def words(text: Column) -> Column:
    """Words of a text as an array; null and blank texts give an empty array."""
    return let(F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS)),
               lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE)))


def packed(docs: DataFrame) -> DataFrame:
    """Whole rows in one column ``_d``, so that no column of the input can clash with a helper column."""
    return docs.select(F.struct("*").alias("_d"))


def field(name: str) -> Column:
    return F.col("_d").getField(name)


def held_out(doc_id: Column) -> Column:
    """Rows never used for learning: crc32(doc_id as text) mod 5 is 0, or no id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def range_scan(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Range-partition rows by ``keys`` then ``order`` and freeze the partition number in ``_pid``.

    A key with very many rows spreads over several partitions, so running
    values need one task per slice and an offset per (key, slice), never one
    task per key.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *[F.col(k) for k in keys], *order)
    return stage(ranged.withColumn("_pid", F.spark_partition_id()), name)


def slice_offsets(scan: DataFrame, keys: list[str], aggregates: dict[str, Column], combine: dict[str, Column]) -> DataFrame:
    """For each (key, slice) after a key's first slice: the value of all earlier slices of that key.

    ``aggregates`` gives the value of one slice, ``combine`` the running form
    over slices.  Only a key cut by a partition border has a later slice, so
    the result has fewer rows than partitions and may be broadcast.
    """
    per_slice = scan.groupBy(*keys, "_pid").agg(*[c.alias(k) for k, c in aggregates.items()])
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    first = F.row_number().over(Window.partitionBy(*keys).orderBy("_pid"))
    offsets = per_slice.select(*keys, "_pid", first.alias("_nth"), *[c.over(before).alias(k) for k, c in combine.items()])
    return F.broadcast(offsets.where("_nth > 1").drop("_nth"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of an undirected graph given as columns ``a``, ``b``; component = smallest node.

    Alternating large-star and small-star rounds: every node hands its
    neighbours its smallest neighbour.  All steps are grouped minima and joins
    on node ids, so hubs are combined map-side; the minima are staged, so both
    sides of a join are plain shuffles and Spark can split a hub's rows;
    nothing is collected but one fingerprint per round.
    """
    e = stage(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    mark = _mark(e)
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        low = stage(low, "cc-low")
        large = both.join(low, both["a"] == low["u"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stage(large.where("a != b"), "cc-large")
        low = stage(large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u"), "cc-low")
        moved = large.join(low, large["a"] == low["u"]).where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = moved.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()
        e = stage(small, "cc-small")
        now = _mark(e)
        if now == mark:
            break
        mark = now
    roots = e.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    return roots.unionByName(roots.select(F.col("component").alias("node"), "component").distinct())


def _mark(e: DataFrame) -> tuple:
    """Order-free fingerprint of an edge table: count and the xor of two hashes."""
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())
