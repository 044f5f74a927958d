"""Structured Streaming over the tick feed (K1-K7).

Source: a file stream over the ``events`` parquet (the re-aimed subscribe
feed), projected to ticks (symbol, ts TIMESTAMP, price, user_id, props).
Every query keeps its state and sink checkpoints in the shared checkpoint
folder, so a restarted driver or lost executor resumes exactly-once.
Sinks are files (append) or ``foreachBatch`` overwrites (complete mode) -
results never sit in driver memory.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.operators.windows import bars
from tickwise.schema import BAR_SIZES
from tickwise.sources.files import scratch

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

PROPS_SCHEMA = "k INT"


def stream_session(spark: SparkSession, state_partitions: Optional[int] = None) -> SparkSession:
    """A session of the same application for streams, with its own number of state-store partitions.

    A stream fixes its stateful partition count when it starts (Spark keeps it
    in the checkpoint for restarts); size it to the cluster's cores rather than
    the batch shuffle default.  Queries of ``spark`` keep their own setting.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions or spark.sparkContext.defaultParallelism))
    return own


def tick_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: Optional[int] = None,
                state_partitions: Optional[int] = None) -> DataFrame:
    """K1 source: streaming ticks from the events table, one file or a folder of part files."""
    r = stream_session(spark, state_partitions).readStream.schema(EVENTS_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    ev = r.parquet(f"{sf_dir}/events.parquet*")
    return ticks_from_events(ev)


def ticks_from_events(ev: DataFrame) -> DataFrame:
    """Events -> ticks; event time cast to TIMESTAMP (watermarks need it)."""
    return ev.select(
        "event_id",
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("price"),
        "user_id",
        "props",
    )


def subscribe(ticks: DataFrame, symbol: str) -> DataFrame:
    """K1: messages of one symbol with the JSON payload parsed."""
    return ticks.filter(F.col("symbol") == F.lit(symbol)).select(
        "symbol", "ts", "price", F.from_json("props", PROPS_SCHEMA).alias("payload"))


def latest_quote(ticks: DataFrame) -> DataFrame:
    """K2: last price per symbol (by event time, then event) and tick count."""
    order = F.struct("ts", "event_id") if "event_id" in ticks.columns else F.struct("ts", "price")
    return ticks.groupBy("symbol").agg(
        F.max_by("price", order).alias("price"),
        F.max("ts").alias("ts"),
        F.count(F.lit(1)).alias("ticks"),
    )


def streaming_bars(ticks: DataFrame, size: str = "5min", watermark: str = "10 minutes") -> DataFrame:
    """K3: OHLCV bars with a watermark (late ticks beyond it are dropped in append mode)."""
    return bars(ticks.withWatermark("ts", watermark), size)


def sliding_stats(ticks: DataFrame, size: str = "1 hour", slide: str = "15 minutes",
                  watermark: Optional[str] = None) -> DataFrame:
    """K4: mean / max / min / std of price per symbol over sliding windows."""
    src = ticks.withWatermark("ts", watermark) if watermark else ticks
    return (src.groupBy("symbol", F.window("ts", size, slide).alias("w"))
            .agg(F.avg("price").alias("mean"), F.max("price").alias("max"), F.min("price").alias("min"),
                 F.stddev("price").alias("std"), F.count(F.lit(1)).alias("n"))
            .select("symbol", F.col("w.start").cast("timestamp_ntz").alias("start"),
                    "mean", "max", "min", "std", "n"))


def dedupe_ticks(ticks: DataFrame, watermark: str = "10 minutes", keys=("event_id",)) -> DataFrame:
    """K5: drop re-delivered ticks (same event) within the watermark; different ticks at one time all stay."""
    return ticks.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(list(keys))


def enrich_stream(ticks: DataFrame, static: DataFrame, key: str = "symbol") -> DataFrame:
    """K7: stream-static join; Spark broadcasts the static side when its bytes allow it."""
    return ticks.join(static, key, "left")


# ---------------------------------------------------------------------------
# Running a stream to completion (availableNow) into durable sinks


@dataclass
class StreamRun:
    output: str
    checkpoint: str
    batch: int = 0  # the last one


def run_append(spark: SparkSession, df: DataFrame, what: str, fmt: str = "parquet",
               run: Optional[StreamRun] = None) -> StreamRun:
    """Append-mode file sink; processes everything available, then stops.  ``run`` resumes an earlier run."""
    run = run or StreamRun(scratch(spark, f"{what}-out"), scratch(spark, f"{what}-ckpt"))
    out, ck = run.output, run.checkpoint
    q = (df.writeStream.outputMode("append").format(fmt).option("path", out)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    _raise(q)
    return run


def run_complete(spark: SparkSession, df: DataFrame, what: str,
                 transform: Optional[Callable[[DataFrame], DataFrame]] = None) -> StreamRun:
    """Complete-mode aggregate; each micro-batch overwrites the parquet result table."""
    out, ck = scratch(spark, f"{what}-out"), scratch(spark, f"{what}-ckpt")

    def sink(batch: DataFrame, _epoch: int) -> None:
        (transform(batch) if transform else batch).write.mode("overwrite").parquet(out)

    q = (df.writeStream.outputMode("complete").foreachBatch(sink)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    _raise(q)
    return StreamRun(out, ck)


QUOTES_SCHEMA = "symbol STRING, price DOUBLE, ts TIMESTAMP, event_id LONG, ticks LONG, batch LONG"
#: Batches after which a version of the quote table holds every symbol, so that no reader opens more versions than this.
FULL_EVERY = 32


def merge_quotes(rows: DataFrame) -> DataFrame:
    """One quote per symbol from partial quotes (symbol, price, ts, event_id, ticks): the last by time, then event."""
    last = F.struct("ts", "event_id")
    return rows.groupBy("symbol").agg(F.max_by("price", last).alias("price"), F.max("ts").alias("ts"),
                                      F.max_by("event_id", last).alias("event_id"), F.sum("ticks").alias("ticks"))


def quotes_at(spark: SparkSession, path: str, batch: int, full_every: int = FULL_EVERY) -> DataFrame:
    """The quote table as it was after ``batch``: every symbol's row of its newest version."""
    first = batch - batch % full_every
    rows = spark.read.schema(QUOTES_SCHEMA).parquet(*[f"{path}/{n}" for n in range(first, batch + 1)])
    newest = F.max_by(F.struct("price", "ts", "event_id", "ticks", "batch"), F.col("batch")).alias("q")
    return rows.groupBy("symbol").agg(newest).select("symbol", "q.*")


def upsert_quotes(ticks: DataFrame, batch: int, path: str, full_every: int = FULL_EVERY) -> None:
    """K2 sink: version ``batch`` of the quote table: the symbols that ticked in it, with their counts so far.

    A batch reads earlier versions only and replaces its own, so one that is
    replayed after a lost driver writes the same rows again.  Ticks of a symbol
    are combined map-side.  The table itself is the state: idle symbols take no
    memory and are read only when a full version is due.
    """
    spark = ticks.sparkSession
    now = merge_quotes(ticks.select("symbol", "price", "ts", "event_id", F.lit(1).cast("long").alias("ticks")))
    if batch:
        before = quotes_at(spark, path, batch - 1, full_every).drop("batch")
        if batch % full_every:
            changed = now.select(F.col("symbol").alias("_s"))
            before = before.join(changed, F.col("symbol").eqNullSafe(F.col("_s")), "left_semi")
        now = merge_quotes(now.unionByName(before))
    now.withColumn("batch", F.lit(batch).cast("long")).write.mode("overwrite").parquet(f"{path}/{batch}")


def maintain_quotes(spark: SparkSession, ticks: DataFrame, run: Optional[StreamRun] = None, full_every: int = FULL_EVERY) -> StreamRun:
    """K2: keep a table of latest quotes; processes everything available, then stops.  ``run`` resumes an earlier run."""
    run = run or StreamRun(scratch(spark, "quotes-out"), scratch(spark, "quotes-ckpt"))
    q = (ticks.writeStream.foreachBatch(lambda rows, batch: upsert_quotes(rows, batch, run.output, full_every))
         .option("checkpointLocation", run.checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    _raise(q)
    if q.lastProgress is not None:
        run.batch = q.lastProgress["batchId"]
    return run


def _raise(q) -> None:
    exc = q.exception()
    if exc is not None:
        raise RuntimeError(str(exc))


def bar_width(size: str) -> str:
    return BAR_SIZES.get(size, size)


def read_result(spark: SparkSession, run: StreamRun) -> DataFrame:
    return spark.read.parquet(run.output)
