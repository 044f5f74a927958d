import __spark_entry__ as E


def test_entry_runs_and_has_rows(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"company", "metric", "count", "mean", "median"} <= set(df.columns)


def test_registry_shapes():
    q, s = E.queries(), E.oracle_sql()
    assert len(q) >= 90
    assert set(s) <= set(q)
    for name in E.catalog.spark_callables():  # opN_ names are those of the training-data operators
        assert not name.startswith("op"), name


def test_views_are_consistent(tables):
    from pyspark.sql import functions as F

    from tickwise.plans import views as V

    px = V.prices(tables)
    bad = px.filter((F.col("high") < F.col("low")) | (F.col("open") > F.col("high")) |
                    (F.col("close") < F.col("low")) | (F.col("volume") < 1)).count()
    assert bad == 0
    assert px.select("company").distinct().count() == 5
    assert px.groupBy("company", "date").count().filter("count > 1").count() == 0


def test_scale_conf_sizes_partitions():
    from tickwise.session import scale_conf

    c = scale_conf(100 * 1024 ** 4, 8000)
    parts = int(c["spark.sql.shuffle.partitions"])
    assert parts % 8000 == 0 and 100 * 1024 ** 4 / parts <= 256 * 1024 ** 2
    small = scale_conf(10 * 1024 ** 2, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_checkpoint_dir_comes_from_the_session(spark):
    from tickwise.session import ensure_checkpoint_dir, scratch_path

    d = ensure_checkpoint_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x").startswith(d)
