import datetime as dt
import os
import tempfile
import time

import numpy as np
from pyspark.sql import functions as F

from tickwise.operators import regress
from tickwise.sources import files
from tickwise.streaming import ticks as S


def test_libsvm_roundtrip_keeps_sparse_zeros(spark):
    df = spark.createDataFrame([(1.5, 0.0, 2.0), (2.5, 3.0, 0.0)], "close double, a double, b double")
    path = files.scratch(spark, "t-libsvm")
    files.write_libsvm(df, path, features=["a", "b"])
    back = files.libsvm_columns(files.read_libsvm(spark, path, 2), 2).orderBy("label").collect()
    assert [(r.label, r.f1, r.f2) for r in back] == [(1.5, 0.0, 2.0), (2.5, 3.0, 0.0)]
    alpha = files.scratch(spark, "t-libsvm-a")
    files.write_libsvm(df, alpha, features=["b", "a"], alphabetical=True)
    back = files.libsvm_columns(files.read_libsvm(spark, alpha, 2), 2).orderBy("label").first()
    assert (back.f1, back.f2) == (0.0, 2.0)  # sorted -> a, b


def test_libsvm_text_line(spark):
    from tickwise.functions.columns import libsvm_line

    df = spark.createDataFrame([(18.0, 8.0, 307.0)], "close double, a double, b double")
    assert df.select(libsvm_line("close", ["a", "b"]).alias("l")).first().l == "18.0 1:8.0 2:307.0"


def test_history_json_file_read(spark):
    d = tempfile.mkdtemp(prefix="tw-json-")
    with open(os.path.join(d, "aapl.json"), "w") as fh:
        fh.write('{"symbol": "AAPL", "historical": [\n'
                 ' {"date": "2020-11-10", "open": 1.0, "high": 2.0, "low": 0.5, "close": 1.5, "label": "x"},\n'
                 ' {"date": "2020-11-09", "open": 1.5, "high": 2.5, "low": 1.0, "close": 2.0}]}\n')
    rows = files.read_history_json(spark, d).orderBy("date").collect()
    assert [(r.company, r.date, r.close) for r in rows] == [("AAPL", dt.date(2020, 11, 9), 2.0),
                                                           ("AAPL", dt.date(2020, 11, 10), 1.5)]
    assert "label" not in rows[0].asDict()


def test_late_ticks_dropped_after_watermark(spark):
    src = tempfile.mkdtemp(prefix="tw-stream-")
    schema = S.EVENTS_SCHEMA
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    # batch 0 moves the watermark to 10:30; batch 1 evicts (emits) the 10:00 bar;
    # the 10:01 tick arrives in batch 2, after its bar was final -> dropped.
    batches = [
        [(1, t0, 1, "x", 1.0, "{}"), (2, t0 + dt.timedelta(minutes=40), 1, "x", 2.0, "{}")],
        [(4, t0 + dt.timedelta(minutes=41), 1, "x", 3.0, "{}")],
        [(3, t0 + dt.timedelta(minutes=1), 1, "x", 100.0, "{}"),
         (5, t0 + dt.timedelta(hours=2), 1, "x", 4.0, "{}")],
    ]
    for i, b in enumerate(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.parquet(os.path.join(src, f"b{i}"))
        time.sleep(1.1)  # distinct modification times: files are taken oldest first
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", True).parquet(src))
    bars = S.streaming_bars(S.ticks_from_events(stream), "5min", "10 minutes")
    run = S.run_append(spark, bars, "t-late")
    out = {r.start: (r.open, r.volume) for r in S.read_result(spark, run).collect()}
    assert out[t0] == (1.0, 1)  # the late 100.0 tick never joined the 10:00 bar


def test_dedupe_within_watermark(spark):
    src = tempfile.mkdtemp(prefix="tw-dup-")
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    rows = [(1, t0, 1, "x", 1.0, "{}"), (1, t0, 1, "x", 1.0, "{}"), (2, t0 + dt.timedelta(seconds=5), 1, "x", 2.0, "{}")]
    spark.createDataFrame(rows, S.EVENTS_SCHEMA).write.parquet(os.path.join(src, "b0"))
    stream = spark.readStream.schema(S.EVENTS_SCHEMA).option("recursiveFileLookup", True).parquet(src)
    run = S.run_append(spark, S.dedupe_ticks(S.ticks_from_events(stream)), "t-dup")
    assert S.read_result(spark, run).count() == 2


def test_stream_reads_tables_of_many_files_and_keeps_ticks_of_one_time(spark):
    src = tempfile.mkdtemp(prefix="tw-parts-")
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    rows = [(i, t0, 1, "x", float(i), "{}") for i in range(40)]
    spark.createDataFrame(rows, S.EVENTS_SCHEMA).repartition(4).write.parquet(os.path.join(src, "events.parquet"))
    run = S.run_append(spark, S.dedupe_ticks(S.tick_stream(spark, src)), "t-parts")
    assert S.read_result(spark, run).count() == 40


def test_sinks_clusters_and_reports_keep_every_row(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 1.0), (2.0, None), (nan, 3.0), (None, 4.0)], "close double, high double")
    out = tempfile.mkdtemp(prefix="tw-svm-") + "/x"
    files.write_libsvm(df, out, features=["high"])
    assert spark.read.format("libsvm").option("numFeatures", 1).load(out).count() == 4
    from tickwise.operators import clean, cluster, metrics, stats
    assert clean.cleaning_report(df).first()["complete_rows"] == 1
    assert {r["field"]: r["nulls"] for r in clean.null_report(df).collect()} == {"close": 2, "high": 1}
    feats = spark.createDataFrame([("a", 1.0), ("b", 9.0), ("c", None), ("d", 1.1)], "company string, volatility double")
    got = {r["company"]: r["cluster"] for r in cluster.cluster(feats, k=2, columns=["volatility"]).collect()}
    assert got["c"] is None and got["a"] == got["d"] != got["b"]
    far = spark.createDataFrame([(1e9 + i, 1e9 + i + (-1) ** i * 0.1) for i in range(100)], "label double, prediction double")
    sse, sst = 100 * 0.01, sum((i - 49.5) ** 2 for i in range(100))
    assert abs(metrics.regression_metrics(far).first()["r2"] - (1 - sse / sst)) < 1e-6
    pairs = spark.createDataFrame([("k", 1.0, 3.0), ("k", 2.0, 2.0), ("k", 3.0, 1.0), ("k", None, 9.0)], "company string, a double, b double")
    for buckets in (None, 2):
        ranks = stats.average_ranks(pairs, ["a"], ["company"], buckets).collect()
        assert sorted((r["a"] or 0) for r in ranks) == [0, 1, 2, 3]


def test_grid_sizes_and_hash_split(spark):
    sizes = {}
    for algo, preset in [("lr", "full"), ("lr", "notebook"), ("gbr", "full"), ("rf", "full"), ("ir", "full")]:
        sizes[(algo, preset)] = len(regress.param_grid(regress.estimator(algo), algo, preset))
    assert sizes == {("lr", "full"): 120, ("lr", "notebook"): 144, ("gbr", "full"): 3, ("rf", "full"): 9,
                     ("ir", "full"): 2}
    df = spark.range(2000).withColumn("k2", F.col("id") % 7)
    tr, te = regress.hash_split(df, ["id", "k2"], 0.3)
    a, b = {r.id for r in tr.collect()}, {r.id for r in te.collect()}
    assert not (a & b) and len(a | b) == 2000 and 450 < len(b) < 750
    tr2, _ = regress.hash_split(df.repartition(7), ["id", "k2"], 0.3)
    assert {r.id for r in tr2.collect()} == a


def test_isotonic_output_is_monotone(spark):
    rng = np.random.default_rng(2)
    rows = [(float(x + rng.normal(0, 3)), float(x)) for x in range(200)]
    df = spark.createDataFrame(rows, "label double, x double")
    model = regress.pipeline(["x"], "ir").fit(df)
    pred = model.transform(df).orderBy("x").toPandas().prediction.to_numpy()
    assert np.all(np.diff(pred) >= -1e-12)


def test_regression_metrics_match_numpy(spark):
    from tickwise.operators import metrics

    rng = np.random.default_rng(4)
    l = rng.normal(10, 2, 500)
    p = l + rng.normal(0, 1, 500)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(l, p)], "label double, prediction double")
    r = metrics.regression_metrics(df).first()
    assert np.isclose(r.rmse, np.sqrt(np.mean((p - l) ** 2)))
    assert np.isclose(r.r2, 1 - np.sum((l - p) ** 2) / np.sum((l - l.mean()) ** 2))
    mean_rmse = float(np.sqrt(np.mean((l - l.mean()) ** 2)))
    assert r.rmse < mean_rmse  # better than the mean predictor


def test_co_located_join_needs_no_shuffle(spark, tables):
    from tickwise.plans import views as V
    from tickwise.sources.layout import co_located

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t2 = co_located(tables, buckets=4, prefix="test")
        o, c = t2.orders, t2.customer
        j = o.join(c, o.o_custkey == c.c_custkey)
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert V.prices(t2).count() == V.prices(tables).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_lagged_features_use_previous_day(spark):
    rows = [("a", dt.date(2020, 1, d), float(d), float(10 * d)) for d in range(1, 6)]
    df = spark.createDataFrame(rows, "company string, date date, close double, high double")
    out, names = regress.lagged_features(df, ["high"])
    got = sorted((r.date.day, r.prev_high) for r in out.collect())
    assert names == ["prev_high"] and got == [(2, 10.0), (3, 20.0), (4, 30.0), (5, 40.0)]


def test_isotonic_feature_by_name(spark):
    rng = np.random.default_rng(3)
    rows = [("a", float(i), float(rng.normal()), float(i) + float(rng.normal(0, 0.1))) for i in range(60)]
    df = spark.createDataFrame(rows, "company string, x double, noise double, close double")
    res, pred = regress.fit_best(df, "ir", ["noise", "x"], "close", isotonic_feature="x")
    assert res.rmse < 1.0 and res.params.get("featureIndex") == "1"


def test_best_regressor_returns_its_model(spark):
    from tickwise.operators import regress

    df = spark.range(300).select((F.col("id") * 2.0 + 1).alias("close"), F.col("id").cast("double").alias("x"))
    res, pred = regress.fit_best(df, "lr", ["x"], "close", preset="small", seed=3)
    again = res.model.transform(pred.drop("prediction")).select("prediction").collect()
    assert sorted(r.prediction for r in again) == sorted(r.prediction for r in pred.collect())
    assert res.model.coefficients[0] > 1


def test_streams_leave_the_batch_setting_alone(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    own = S.stream_session(spark, 3)
    assert own.conf.get("spark.sql.shuffle.partitions") == "3" and spark.conf.get("spark.sql.shuffle.partitions") == before
    assert own.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")


def test_experiment_reads_each_company_from_its_folder(spark):
    df = spark.createDataFrame([(c, float(i), 2.0 * i + k) for k, c in enumerate(("A", "B/1")) for i in range(40)], "company string, x double, close double")
    rows = regress.per_company(df, ["close", "x"])
    assert sorted(r.close for r in rows("B/1").collect()) == [2.0 * i + 1 for i in range(40)] and rows("C").count() == 0
    out = regress.experiment(df, ["A", "B/1"], ["ir"], 1, ["x"], preset="small").collect()
    assert sorted(r.company for r in out) == ["A", "B/1"] and all(r.rmse >= 0 for r in out)


def test_mean_correlation_equals_pairs_and_leaves_constant_companies_null(spark):

    from tickwise.operators import cluster

    x = np.random.RandomState(2).normal(size=(4, 30))
    data = [(f"c{i}", d, float(v)) for i, row in enumerate(x) for d, v in enumerate(row)] + [("flat", d, 1.0) for d in range(30)]
    got = {r.company: r.mean_correlation for r in cluster.mean_correlation(spark.createDataFrame(data, "company string, date int, changeOverTime double")).collect()}
    c = np.corrcoef(x)
    assert got["flat"] is None and all(abs(got[f"c{i}"] - (c[i].sum() - 1) / 3) < 1e-9 for i in range(4))
