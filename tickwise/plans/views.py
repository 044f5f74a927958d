"""Domain views over the driver's tables.

No stock data is shipped, so every domain table is a projection/aggregation of
the TPC-H-like tables.  Each view exists twice: as a DataFrame builder (the
real implementation) and as a DuckDB CTE used only by the independent oracle.

Scale notes
-----------
* ``prices`` aggregates *all* orders into one row per (company, day).  The join
  orders->customer is a plain equi-join left to Catalyst/AQE (broadcast when the
  customer side is measured small, sort-merge otherwise); the aggregation is
  partial (map-side) so a company holding a third of all orders costs no more
  than any other.  The result is bounded by companies x calendar days.
* ``ticks`` is a pure projection of ``events``; downstream operators aggregate
  it by (symbol, time bucket), never by symbol alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.functions.columns import r4, with_day_fields
from tickwise.sources.tables import Tables

# Fixed scale that turns order totals into index-level prices (4 decimals at most,
# so a final round(x, 4) never meets a decimal tie).
PRICE_SCALE = 100.0


def _daily_bars(orders: DataFrame, keyed: DataFrame) -> DataFrame:
    """OHLCV per (company, day) from order rows carrying a ``company`` column."""
    px = F.col("o_totalprice") / F.lit(PRICE_SCALE)
    return (
        keyed.groupBy("company", F.to_date("o_orderdate").alias("date"))
        .agg(
            F.min_by(px, F.col("o_orderkey")).alias("open"),
            F.max(px).alias("high"),
            F.min(px).alias("low"),
            F.max_by(px, F.col("o_orderkey")).alias("close"),
            F.count(F.lit(1)).cast("double").alias("volume"),
        )
    )


def prices(t: Tables) -> DataFrame:
    """Daily price history, company = market segment (5 companies)."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = t.customer.select("c_custkey", F.col("c_mktsegment").alias("company"))
    keyed = o.join(c, o.o_custkey == c.c_custkey)
    return with_day_fields(_daily_bars(o, keyed))


def prices25(t: Tables) -> DataFrame:
    """Daily price history, company = nation of the customer (25 companies)."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = t.customer.select("c_custkey", "c_nationkey")
    n = t.nation.select("n_nationkey", F.col("n_name").alias("company"))
    keyed = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return with_day_fields(_daily_bars(o, keyed))


def profile(t: Tables) -> DataFrame:
    """Company profile for the ``prices25`` companies (one row per nation)."""
    n = t.nation.alias("n")
    r = t.region.alias("r")
    c = t.customer.groupBy("c_nationkey").agg(F.max("c_acctbal").alias("price"))
    return (
        n.join(r, F.col("n.n_regionkey") == F.col("r.r_regionkey"))
        .join(c, F.col("n.n_nationkey") == F.col("c_nationkey"), "left")
        .select(
            F.col("n.n_name").alias("ticker"),
            F.concat(F.col("n.n_name"), F.lit(" HOLDINGS")).alias("name"),
            F.col("r.r_name").alias("sector"),
            F.col("price"),
            F.col("n.n_name").alias("country"),
            F.lit(None).cast("string").alias("state"),
            F.col("r.r_name").alias("city"),
            F.concat(F.lit("Nation "), F.col("n.n_nationkey").cast("string")).alias("address"),
            F.concat(F.lit("www."), F.lower(F.regexp_replace("n.n_name", " ", "-")), F.lit(".example")).alias("website"),
        )
    )


def ticks(t: Tables) -> DataFrame:
    """Tick stream as a batch table: symbol = event type, price = value.

    Event time stays TIMESTAMP_NTZ in batch (window boundaries do not depend on
    the session time zone); the streaming source casts to TIMESTAMP because
    watermarks require it.
    """
    return t.events.select(
        F.col("event_type").alias("symbol"),
        F.col("ts"),
        F.col("value").alias("price"),
        "user_id",
        "props",
        "event_id",
    )


def ml(t: Tables) -> DataFrame:
    """Regression data set: label = extended price, five numeric features."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                           "l_discount", "l_tax", "l_extendedprice")
    p = t.part.select("p_partkey", "p_size", "p_retailprice", "p_type")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        "l_orderkey", "l_linenumber", "p_type",
        F.col("l_extendedprice").alias("label"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("p_size").cast("double").alias("p_size"),
        F.col("p_retailprice"),
    )


ML_FEATURES = ("quantity", "discount", "tax", "p_size", "p_retailprice")


def fx(t: Tables) -> DataFrame:
    """Sparse FX fixings per nation: only days with an urgent order have a rate."""
    o = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(
        "o_custkey", "o_totalprice", "o_orderdate")
    c = t.customer.select("c_custkey", "c_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("pair"), F.to_date("o_orderdate").alias("date"))
        .agg((F.min("o_totalprice") / F.lit(100000.0)).alias("rate"))
    )


def actions(t: Tables) -> DataFrame:
    """Corporate actions per company (segment), sparse: pending urgent orders at the
    top of the price range become splits (ratio 1.0-1.1), at the bottom dividends
    (price multiplier 0.99-0.999)."""
    px = F.col("o_totalprice")
    o = t.orders.filter(
        (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
        & ((px > F.lit(490000.0)) | (px < F.lit(10000.0)))
    ).select("o_custkey", "o_totalprice", "o_orderdate")
    c = t.customer.select("c_custkey", F.col("c_mktsegment").alias("company"))
    is_split = px > F.lit(490000.0)
    return o.join(c, o.o_custkey == c.c_custkey).select(
        "company",
        F.to_date("o_orderdate").alias("date"),
        F.when(is_split, F.lit("split")).otherwise(F.lit("dividend")).alias("kind"),
        F.when(is_split, F.lit(1.0) + (px - F.lit(490000.0)) / F.lit(100000.0))
        .otherwise(F.lit(1.0) - px / F.lit(1.0e6)).alias("ratio"),
    )


def rmse_samples(t: Tables) -> DataFrame:
    """Experiment-sample table (company, algo, run, rmse).

    One sample per (segment, order priority, month): the spread of order
    totals, rounded so both engines agree to the last digit.
    """
    o = t.orders.select("o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = t.customer.select("c_custkey", F.col("c_mktsegment").alias("company"))
    d = F.col("o_orderdate")
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .groupBy(
            "company",
            F.col("o_orderpriority").alias("algo"),
            (F.year(d) * 100 + F.month(d)).alias("run"),
        )
        .agg(r4(F.stddev_pop(F.col("o_totalprice") / F.lit(PRICE_SCALE)), 6).alias("rmse"))
    )


VIEWS = {
    "prices": prices, "prices25": prices25, "profile": profile, "ticks": ticks, "ml": ml,
    "fx": fx, "actions": actions, "rmse_samples": rmse_samples,
}


def view(t: Tables, name: str) -> DataFrame:
    return VIEWS[name](t)


# ---------------------------------------------------------------------------
# DuckDB twins (oracle only).
_DAY_FIELDS_SQL = """
  SELECT company, date, open, high, low, close, close AS adjClose, volume,
         volume AS unadjustedVolume, close - open AS change,
         (CAST(100.0 AS DOUBLE) * (close - open)) / NULLIF(open, 0) AS changePercent,
         (high + low + close) / CAST(3.0 AS DOUBLE) AS vwap,
         (close - open) / NULLIF(open, 0) AS changeOverTime
  FROM ({bars}) b"""

_BARS_SQL = """
    SELECT {key} AS company, CAST(o.o_orderdate AS DATE) AS date,
           min_by(o.o_totalprice / CAST(100.0 AS DOUBLE), o.o_orderkey) AS open,
           max(o.o_totalprice / CAST(100.0 AS DOUBLE)) AS high,
           min(o.o_totalprice / CAST(100.0 AS DOUBLE)) AS low,
           max_by(o.o_totalprice / CAST(100.0 AS DOUBLE), o.o_orderkey) AS close,
           CAST(count(*) AS DOUBLE) AS volume
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey {extra}
    GROUP BY 1, 2"""

VIEW_SQL = {
    "prices": _DAY_FIELDS_SQL.format(bars=_BARS_SQL.format(key="c.c_mktsegment", extra="")),
    "prices25": _DAY_FIELDS_SQL.format(bars=_BARS_SQL.format(
        key="n.n_name", extra="JOIN nation n ON c.c_nationkey = n.n_nationkey")),
    "profile": """
  SELECT n.n_name AS ticker, n.n_name || ' HOLDINGS' AS name, r.r_name AS sector, c.price,
         n.n_name AS country, CAST(NULL AS VARCHAR) AS state, r.r_name AS city,
         'Nation ' || CAST(n.n_nationkey AS VARCHAR) AS address,
         'www.' || lower(replace(n.n_name, ' ', '-')) || '.example' AS website
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT c_nationkey, max(c_acctbal) AS price FROM customer GROUP BY 1) c
    ON n.n_nationkey = c.c_nationkey""",
    "ticks": "SELECT event_type AS symbol, ts, value AS price, user_id, props, event_id FROM events",
    "ml": """
  SELECT l.l_orderkey, l.l_linenumber, p.p_type, l.l_extendedprice AS label,
         l.l_quantity AS quantity, l.l_discount AS discount, l.l_tax AS tax,
         CAST(p.p_size AS DOUBLE) AS p_size, p.p_retailprice
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "fx": """
  SELECT n.n_name AS pair, CAST(o.o_orderdate AS DATE) AS date,
         min(o.o_totalprice) / CAST(100000.0 AS DOUBLE) AS rate
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE o.o_orderpriority = '1-URGENT'
  GROUP BY 1, 2""",
    "actions": """
  SELECT c.c_mktsegment AS company, CAST(o.o_orderdate AS DATE) AS date,
         CASE WHEN o.o_totalprice > 490000.0 THEN 'split' ELSE 'dividend' END AS kind,
         CASE WHEN o.o_totalprice > 490000.0
              THEN CAST(1.0 AS DOUBLE) + (o.o_totalprice - CAST(490000.0 AS DOUBLE)) / CAST(100000.0 AS DOUBLE)
              ELSE CAST(1.0 AS DOUBLE) - o.o_totalprice / CAST(1.0e6 AS DOUBLE) END AS ratio
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE o.o_orderstatus = 'P' AND o.o_orderpriority = '1-URGENT'
    AND (o.o_totalprice > 490000.0 OR o.o_totalprice < 10000.0)""",
    "rmse_samples": """
  SELECT c.c_mktsegment AS company, o.o_orderpriority AS algo,
         CAST(year(o.o_orderdate) * 100 + month(o.o_orderdate) AS INTEGER) AS run,
         round(stddev_pop(o.o_totalprice / CAST(100.0 AS DOUBLE)), 6) AS rmse
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2, 3""",
}


def with_views(sql: str, *names: str) -> str:
    """Prefix an oracle query with the CTEs of the views it uses."""
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in names)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
