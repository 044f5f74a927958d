"""Schemas and fixed names shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for compatible files and outputs).
# Feature order of the libsvm / ML CSV writers, label = close:
FEATURES = (
    "high", "low", "open", "adjClose", "volume", "unadjustedVolume",
    "change", "changePercent", "vwap", "changeOverTime",
)
# Header of the ML CSV file:
ML_CSV_HEADER = ("label",) + FEATURES
# Values that may be forecast (adjClose is not among them):
FORECASTABLE = (
    "open", "close", "high", "low", "volume", "unadjustedVolume",
    "change", "changePercent", "vwap", "changeOverTime",
)
# Company profile fields (record keys in output order) and their source keys:
PROFILE_FIELDS = ("ticker", "name", "sector", "price", "country", "state", "city", "address", "website")
PROFILE_SOURCE_KEYS = ("symbol", "companyName", "sector", "price", "country", "state", "city", "address", "website")
# Decision labels:
WAIT, BUY, SELL = 0, 1, 2
# Forecast component columns fed to the classifier, in the reference's order:
DECISION_FEATURES = (
    "yhat", "trend", "yhat_lower", "yhat_upper",
    "trend_lower", "trend_upper", "multiplicative_terms",
    "multiplicative_terms_upper", "multiplicative_terms_lower",
    "daily", "daily_lower", "daily_upper", "weekly",
    "weekly_lower", "weekly_upper", "yearly", "yearly_lower", "yearly_upper",
    "additive_terms", "additive_terms_lower", "additive_terms_upper",
)
# Intraday bar sizes:
BAR_SIZES = {"1min": "1 minute", "5min": "5 minutes", "15min": "15 minutes",
             "30min": "30 minutes", "1hour": "1 hour", "4hour": "4 hours"}
# ---------------------------------------------------------------------------

PRICE_COLUMNS = ("open", "high", "low", "close", "adjClose", "volume", "unadjustedVolume",
                 "change", "changePercent", "vwap", "changeOverTime")

_D = T.DoubleType()

# One trading day of one company (canonical, flattened).
PRICE_SCHEMA = T.StructType(
    [T.StructField("company", T.StringType()), T.StructField("date", T.DateType())]
    + [T.StructField(c, _D) for c in PRICE_COLUMNS]
)

# One element of the ``historical`` array of a price-history JSON document.
HISTORICAL_ELEMENT = T.StructType(
    [T.StructField("date", T.StringType())]
    + [T.StructField(c, _D) for c in ("open", "high", "low", "close", "adjClose", "volume",
                                       "unadjustedVolume", "change", "changePercent", "vwap")]
    + [T.StructField("label", T.StringType()), T.StructField("changeOverTime", _D)]
)

HISTORY_DOCUMENT = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("historical", T.ArrayType(HISTORICAL_ELEMENT)),
])

PROFILE_SOURCE = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("companyName", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("price", _D),
    T.StructField("country", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("website", T.StringType()),
])

OHLCV_CSV_SCHEMA = T.StructType([
    T.StructField("Date", T.DateType()),
    T.StructField("Open", _D), T.StructField("High", _D), T.StructField("Low", _D),
    T.StructField("Close", _D), T.StructField("Adj Close", _D),
    T.StructField("Volume", T.LongType()),
])

FORECAST_COMPONENTS = (
    "yhat", "trend", "yhat_lower", "yhat_upper", "trend_lower", "trend_upper",
    "multiplicative_terms", "multiplicative_terms_lower", "multiplicative_terms_upper",
    "daily", "daily_lower", "daily_upper", "weekly", "weekly_lower", "weekly_upper",
    "yearly", "yearly_lower", "yearly_upper",
    "additive_terms", "additive_terms_lower", "additive_terms_upper",
)

FORECAST_SCHEMA = T.StructType(
    [T.StructField("ds", T.DateType())]
    + [T.StructField(c, _D) for c in FORECAST_COMPONENTS]
    + [T.StructField("company", T.StringType())]
)

TICK_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("price", _D),
    T.StructField("user_id", T.LongType()),
    T.StructField("props", T.StringType()),
])


def check_value(value: str) -> str:
    if value not in FORECASTABLE:
        raise ValueError(f"value must be one of {FORECASTABLE}, got {value!r}")
    return value
