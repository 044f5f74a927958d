"""Registered queries for sources and sinks: every one is a real write/read
round trip through the shared checkpoint folder (or an in-memory JSON parse),
checked against the view it started from."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.plans import views as V
from tickwise.plans.catalog import register
from tickwise.plans.queries import _PX_SELECT_SQL, rounded
from tickwise.schema import FEATURES, PRICE_COLUMNS, PROFILE_FIELDS, PROFILE_SOURCE_KEYS
from tickwise.sources import files


def _features_sql(order) -> str:
    return ", ".join(f"round({c}, 4) AS f{i}" for i, c in enumerate(order, 1))


@register("s5_history_json_parse", views=("prices",), sql=f"SELECT {_PX_SELECT_SQL} FROM prices")
def s5_history_json_parse(t):
    docs = files.history_documents(V.prices(t))
    return rounded(files.parse_history(docs))


@register("s12_s5_history_archive_roundtrip", views=("prices",), sql=f"SELECT {_PX_SELECT_SQL} FROM prices")
def s12_s5_history_archive_roundtrip(t):
    path = files.scratch(t.spark, "history-archive")
    files.write_history_documents(V.prices(t), path)
    return rounded(files.read_history_json(t.spark, path))


@register("s6_profile_json_record", views=("profile",), sql=f"""
SELECT {', '.join('round(price, 4) AS price' if f == 'price' else f for f in PROFILE_FIELDS)} FROM profile
""")
def s6_profile_json_record(t):
    prof = V.profile(t)
    src = F.struct(*[F.col(dst).alias(src) for src, dst in zip(PROFILE_SOURCE_KEYS, PROFILE_FIELDS)])
    return rounded(files.profile_record(prof.select(F.to_json(src).alias("json"))))


@register("s7_s1_libsvm_roundtrip", views=("prices",), sql=f"""
SELECT round(close, 4) AS label, {_features_sql(FEATURES)} FROM prices
""")
def s7_s1_libsvm_roundtrip(t):
    path = files.scratch(t.spark, "libsvm")
    files.write_libsvm(V.prices(t), path)
    back = files.read_libsvm(t.spark, path, num_features=len(FEATURES))
    return rounded(files.libsvm_columns(back, len(FEATURES)))


@register("s1_libsvm_inferred_width", views=("prices",), sql=f"""
SELECT round(close, 4) AS label, {_features_sql(FEATURES)} FROM prices
""")
def s1_libsvm_inferred_width(t):
    """The scan finds the vector width itself."""
    path = files.scratch(t.spark, "libsvm-width")
    files.write_libsvm(V.prices(t), path)
    return rounded(files.libsvm_columns(files.read_libsvm(t.spark, path), len(FEATURES)))


@register("s8_s2_libsvm_alphabetical", views=("prices",), sql=f"""
SELECT round(close, 4) AS label, {_features_sql(sorted(FEATURES))} FROM prices
""")
def s8_s2_libsvm_alphabetical(t):
    path = files.scratch(t.spark, "libsvm-alpha")
    files.write_libsvm(V.prices(t), path, alphabetical=True)
    back = files.read_libsvm(t.spark, path, num_features=len(FEATURES))
    return rounded(files.libsvm_columns(back, len(FEATURES)))


@register("s9_s3_ml_csv_roundtrip", views=("prices",), sql=f"""
SELECT round(close, 4) AS label, {', '.join(f'round({c}, 4) AS {c}' for c in FEATURES)} FROM prices
""")
def s9_s3_ml_csv_roundtrip(t):
    path = files.scratch(t.spark, "ml-csv")
    files.write_ml_csv(V.prices(t), path)
    back = files.read_csv_inferred(t.spark, path)
    return rounded(back.select(*[F.col(c).cast("double").alias(c) for c in back.columns]))


@register("s4_ohlcv_csv_schema", views=("prices",), sql="""
SELECT company, date AS "Date", round(open, 4) AS "Open", round(high, 4) AS "High", round(low, 4) AS "Low",
       round(close, 4) AS "Close", round(adjClose, 4) AS "Adj Close", CAST(volume AS BIGINT) AS "Volume"
FROM prices
""")
def s4_ohlcv_csv_schema(t):
    """Daily OHLCV CSV files (no company column inside; one folder per company),
    read back in ONE pass with the explicit schema; the company comes from the folder."""
    px = V.prices(t)
    out = px.select("company", F.col("date").alias("Date"), F.col("open").alias("Open"),
                    F.col("high").alias("High"), F.col("low").alias("Low"), F.col("close").alias("Close"),
                    F.col("adjClose").alias("Adj Close"), F.col("volume").cast("long").alias("Volume"))
    path = files.scratch(t.spark, "ohlcv-csv")
    files.by_folder(out, date="Date").write.mode("overwrite").partitionBy("company").option("header", True).csv(path)
    return rounded(files.read_csv(t.spark, path))


@register("s10_s11_result_csv", views=("prices",), sql="""
SELECT company, round(close - open, 4) AS close_minus_open, round(close / NULLIF(open, 0), 4) AS close_over_open
FROM prices
""")
def s10_s11_result_csv(t):
    px = V.prices(t)
    res = px.select("company", (F.col("close") - F.col("open")).alias("close_minus_open"),
                    F.try_divide(F.col("close"), F.col("open")).alias("close_over_open"))
    path = files.scratch(t.spark, "result-csv")
    files.write_csv(res, path)
    schema = T.StructType([T.StructField("company", T.StringType()),
                           T.StructField("close_minus_open", T.DoubleType()),
                           T.StructField("close_over_open", T.DoubleType())])
    return rounded(files.read_csv(t.spark, path, schema=schema))


@register("s13_multi_company_load", views=("prices25",), sql=f"SELECT {_PX_SELECT_SQL} FROM prices25")
def s13_multi_company_load(t):
    path = files.scratch(t.spark, "multi-company")
    files.write_partitioned_json(V.prices25(t), path)
    schema = T.StructType([T.StructField("date", T.DateType())]
                          + [T.StructField(c, T.DoubleType()) for c in PRICE_COLUMNS])
    back = files.read_partitioned_json(t.spark, path, schema)
    return rounded(back.select("company", "date", *PRICE_COLUMNS))
