import datetime as dt

from tickwise import api
from tickwise.plans import views as V


def test_api_surface(spark, tables):
    px = V.prices(tables)
    fc = api.predict(px, periods=5, last_days=None, as_of="2001-08-01")
    assert "training_date" in fc.columns and fc.count() > 0
    info = api.company_info(V.profile(tables), "NATION_3").collect()
    assert len(info) == 1 and info[0].sector == "EUROPE"
    assert api.last_seven_days(px, "BUILDING", as_of="2001-08-01").count() <= 8
    hist = api.company_history(px, "BUILDING", "2000-01-01", "2000-12-31").collect()
    assert all(dt.date(2000, 1, 1) <= r.date <= dt.date(2000, 12, 31) for r in hist)
    assert api.get_company(px, "NOPE", 30, as_of="2001-08-01").count() == 0  # empty, not an error
    views = api.visualize(px)
    assert set(views) == {"tail", "describe", "histogram", "boxplot", "correlation"}
    assert views["describe"].count() == 5 * 11
    res, pred = api.regression_cli(px, "BUILDING", "ir", preset="small")
    assert res.rmse > 0 and pred.count() > 0
    rep = api.regression_report(V.ml(tables), list(V.ML_FEATURES))
    assert rep["lr_metrics"].first().n > 0 and rep["lr_coefficients"].count() == 6


def test_visualize_bins_every_column(spark):
    from tickwise import api
    from tickwise.schema import PRICE_COLUMNS
    from pyspark.sql import functions as F

    px = spark.range(30).select(F.lit("A").alias("company"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
                                *[(F.col("id") + i).cast("double").alias(c) for i, c in enumerate(PRICE_COLUMNS)])
    h = api.visualize(px)["histogram"].groupBy("column").agg(F.sum("n").alias("n")).collect()
    assert {r["column"]: r.n for r in h} == {c: 30 for c in PRICE_COLUMNS}
