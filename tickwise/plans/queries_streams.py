"""Registered streaming queries: each runs a Structured Streaming job over the
events feed with ``availableNow`` into a durable sink and returns the result
table; the oracle is the equivalent batch SQL."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tickwise.plans import views as V
from tickwise.plans.catalog import register
from tickwise.plans.queries import once, rounded
from tickwise.sources.files import scratch
from tickwise.streaming import ticks as S


def _ntz(df, col="ts"):
    return df.withColumn(col, F.col(col).cast("timestamp_ntz"))


@register("k1_subscribe_symbol", views=("ticks",), sql="""
SELECT symbol, ts, round(price, 4) AS price, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM ticks WHERE symbol = 'click'
""")
def k1_subscribe_symbol(t):
    s = S.subscribe(S.tick_stream(t.spark, t.sf_dir), "click")
    run = S.run_append(t.spark, _ntz(s.select("symbol", "ts", "price", F.col("payload.k").alias("k"))), "k1")
    return rounded(S.read_result(t.spark, run))


@register("k2_latest_quote", views=("ticks",), sql="""
SELECT symbol, round(arg_max(price, ts), 4) AS price, max(ts) AS ts, count(*) AS ticks FROM ticks GROUP BY symbol
""")
def k2_latest_quote(t):
    run = S.run_complete(t.spark, S.latest_quote(S.tick_stream(t.spark, t.sf_dir)), "k2", transform=_ntz)
    return rounded(S.read_result(t.spark, run))


@register("k2_quote_table", views=("ticks",), sql="""
SELECT symbol, round(last(price ORDER BY ts, event_id), 4) AS price, max(ts) AS ts, last(event_id ORDER BY ts, event_id) AS event_id, CAST(count(*) AS BIGINT) AS ticks
FROM ticks GROUP BY symbol
""")
def k2_quote_table(t):
    """The feed in seven deliveries; each writes the symbols that ticked, every third one all."""
    feed = scratch(t.spark, "k2-feed")
    t.events.repartition(7, "event_id").write.parquet(feed)
    stream = S.stream_session(t.spark).readStream.schema(S.EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(feed)
    run = S.maintain_quotes(t.spark, S.ticks_from_events(stream), full_every=3)
    return rounded(_ntz(S.quotes_at(t.spark, run.output, run.batch, full_every=3)).drop("batch"))


@register("k3_streaming_bars_watermark", views=("ticks",), sql="""
WITH b AS (
  SELECT symbol, time_bucket(INTERVAL 5 MINUTE, ts) AS start,
         round(arg_min(price, ts), 4) AS open, round(max(price), 4) AS high, round(min(price), 4) AS low,
         round(arg_max(price, ts), 4) AS close, CAST(count(*) AS BIGINT) AS volume,
         round(sum(price), 4) AS turnover
  FROM ticks GROUP BY symbol, start)
SELECT b.* FROM b WHERE b.start + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM ticks) - INTERVAL 10 MINUTE
""")
def k3_streaming_bars_watermark(t):
    """Append mode: a bar is final once the watermark (max event time - 10 min) passes its end."""
    s = S.streaming_bars(S.tick_stream(t.spark, t.sf_dir), "5min", "10 minutes")
    run = S.run_append(t.spark, s, "k3")
    return rounded(S.read_result(t.spark, run))


@register("k4_sliding_window_stats", views=("ticks",), sql="""
WITH x AS (
  SELECT symbol, price,
         time_bucket(INTERVAL 15 MINUTE, ts) - k * INTERVAL 15 MINUTE AS start
  FROM ticks, (SELECT unnest(range(4)) AS k) o)
SELECT symbol, start, round(avg(price), 4) AS mean, round(max(price), 4) AS max, round(min(price), 4) AS min,
       round(stddev_samp(price), 4) AS std, count(*) AS n
FROM x GROUP BY symbol, start HAVING start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM ticks) - INTERVAL 10 MINUTE
""")
def k4_sliding_window_stats(t):
    """Append mode: a window leaves the state once the watermark passes its end."""
    s = S.sliding_stats(S.tick_stream(t.spark, t.sf_dir), "1 hour", "15 minutes", "10 minutes")
    run = S.run_append(t.spark, s, "k4")
    return rounded(S.read_result(t.spark, run))


@register("k5_dedupe_replayed_feed", sql="""
SELECT DISTINCT event_id, event_type AS symbol, CAST(ts AS TIMESTAMP) AS ts, round(value, 4) AS price, user_id FROM events
""")
def k5_dedupe_replayed_feed(t):
    """The feed is delivered twice (two sources); duplicates vanish within the watermark."""
    a = S.tick_stream(t.spark, t.sf_dir)
    b = S.tick_stream(t.spark, t.sf_dir)
    d = S.dedupe_ticks(a.unionByName(b), "10 minutes").select("event_id", "symbol", "ts", "price", "user_id")
    run = S.run_append(t.spark, _ntz(d), "k5")
    return rounded(S.read_result(t.spark, run))


@register("k7_stream_static_join_scoring")
def k7_stream_static_join_scoring(t):
    """Stream joined with per-symbol history (batch), then scored by a saved pipeline."""
    hist = V.ticks(t)
    # the static side is joined in every micro-batch: materialise it once
    static = once(hist.groupBy("symbol").agg(F.avg("price").alias("avg_price"),
                                             F.stddev("price").alias("std_price")))
    feats = lambda df: df.withColumn("hour", F.hour("ts").cast("double")).withColumn(
        "uid", F.col("user_id").cast("double"))
    model = Pipeline(stages=[VectorAssembler(inputCols=["uid", "hour"], outputCol="features"),
                             LinearRegression(labelCol="price", maxIter=10)]).fit(feats(hist))
    path = scratch(t.spark, "k7-model")
    model.write().overwrite().save(path)
    from pyspark.ml import PipelineModel

    loaded = PipelineModel.load(path)
    stream = S.enrich_stream(S.tick_stream(t.spark, t.sf_dir), static)
    scored = loaded.transform(feats(stream)).select(
        "symbol", "ts", "price", "avg_price",
        ((F.col("price") - F.col("avg_price")) / F.col("std_price")).alias("zscore"), "prediction")
    run = S.run_append(t.spark, _ntz(scored), "k7")
    return rounded(S.read_result(t.spark, run))


@register("k6_late_ticks_dropped", views=("ticks",), sql="""
WITH r AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM ticks),
on_time AS (SELECT t.* FROM ticks t, r WHERE epoch_us(t.ts) >= r.lo + (r.hi - r.lo) // 2),
b AS (
  SELECT symbol, time_bucket(INTERVAL 5 MINUTE, ts) AS start,
         round(arg_min(price, ts), 4) AS open, round(max(price), 4) AS high, round(min(price), 4) AS low,
         round(arg_max(price, ts), 4) AS close, CAST(count(*) AS BIGINT) AS volume,
         round(sum(price), 4) AS turnover
  FROM on_time GROUP BY symbol, start)
SELECT b.* FROM b WHERE b.start + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM ticks) - INTERVAL 10 MINUTE
""")
def k6_late_ticks_dropped(t):
    """The feed arrives out of order: the later half first (two deliveries), the earlier
    half last.  Once the watermark has passed them, the old ticks are dropped:
    only bars of the on-time half are emitted."""
    ev = t.events
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()  # two scalars
    mid = lo + (hi - lo) // 2
    q3 = lo + 3 * (hi - lo) // 4
    feed, run = scratch(t.spark, "k6-feed"), None
    arrivals = [(F.col("ts") >= F.lit(mid)) & (F.col("ts") < F.lit(q3)),
                F.col("ts") >= F.lit(q3),
                F.col("ts") < F.lit(mid)]
    for arrived in arrivals:  # the stream stops and resumes between deliveries, so their order is certain
        ev.filter(arrived).write.mode("append").parquet(feed)
        bars = S.streaming_bars(S.ticks_from_events(S.stream_session(t.spark).readStream.schema(S.EVENTS_SCHEMA).parquet(feed)), "5min", "10 minutes")
        run = S.run_append(t.spark, bars, "k6", run=run)
    return rounded(S.read_result(t.spark, run))
