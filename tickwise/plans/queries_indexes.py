"""Registered queries through indexes: ranks in groups of any size, deep pages, symbol search, companies by pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickwise.operators import cluster, ranks, search, stats
from tickwise.plans import views as V
from tickwise.plans.catalog import register
from tickwise.plans.queries import QUANTILE_DIGITS, _unpivot_sql, once, rounded
from tickwise.plans.queries_analytics import _BOX_Q, _box_sql

_HOT_TICKS = "SELECT CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE symbol END AS symbol, price FROM ticks"


def _hot_ticks(t):
    """Ticks, a third of which are of one symbol."""
    return V.ticks(t).select(F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col("symbol")).alias("symbol"), "price")


@register("a1_describe_line_items", sql=f"""
WITH l AS (SELECT l_returnflag, l_quantity, l_extendedprice, l_discount FROM lineitem)
SELECT l_returnflag, metric, count(value) AS count, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, round(min(value), 4) AS min,
  round(quantile_cont(value, 0.25), {QUANTILE_DIGITS}) AS q25, round(median(value), {QUANTILE_DIGITS}) AS median,
  round(quantile_cont(value, 0.75), {QUANTILE_DIGITS}) AS q75, round(max(value), 4) AS max
FROM {_unpivot_sql('l', ('l_quantity', 'l_extendedprice', 'l_discount'))} GROUP BY l_returnflag, metric
""")
def a1_describe_line_items(t):
    """Exact quartiles of every line item, groups of a third of the table and more: by rank, no group in one task."""
    q = QUANTILE_DIGITS
    summary = stats.describe(t.lineitem, ("l_quantity", "l_extendedprice", "l_discount"), by=("l_returnflag",), ranges=True)
    return rounded(summary, q25=q, median=q, q75=q)


@register("a5_box_stats_of_ticks", views=("ticks",), sql=_box_sql(f"({_HOT_TICKS})", ["price"], "symbol"))
def a5_box_stats_of_ticks(t):
    return rounded(stats.box_stats(_hot_ticks(t), ["price"], by=("symbol",), ranges=True), **_BOX_Q)


@register("t4_page_index", sql="""
WITH n AS (SELECT count(*) AS n FROM lineitem),
r AS (SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity) - 1 AS rn FROM lineitem)
SELECT l_orderkey, l_linenumber, l_shipdate, round(l_quantity, 4) AS l_quantity FROM r, n WHERE rn < 10 OR (rn >= n // 2 AND rn < n // 2 + 10) OR rn >= n - 10
""")
def t4_page_index(t):
    """The first page, one in the middle and the last, each read from its own range."""
    index = ranks.page_index(t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity"), ["l_shipdate", "l_orderkey", "l_linenumber"])
    first, middle, last = (index.page(at, 10) for at in (0, index.size // 2, max(index.size - 10, 0)))
    return rounded(first.unionByName(middle).unionByName(last))


@register("p10_symbol_index", sql="""
WITH p AS (SELECT 'P' || p_partkey AS ticker, p_name || ' ' || p_brand AS name, p_type AS sector FROM part),
q AS (SELECT DISTINCT unnest([substr(p_name, 1, 1), substr(p_name, 2, 2), substr(p_name, 3, 5), upper(p_name), p_brand, 'P' || p_partkey, p_name || 'x']) AS query FROM part)
SELECT query, CAST(row_number() OVER (PARTITION BY query ORDER BY ticker) AS INTEGER) AS rank, ticker, name, sector
FROM q JOIN p ON contains(lower(ticker), lower(query)) OR contains(lower(name), lower(query)) WHERE query <> '' QUALIFY rank <= 10
""")
def p10_symbol_index(t):
    """Searches of one letter to whole names over all parts, in one plan through the postings."""
    listed = t.part.select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("ticker"), F.concat_ws(" ", "p_name", "p_brand").alias("name"), F.col("p_type").alias("sector"))
    name = F.col("p_name")
    asked = F.array(F.substring(name, 1, 1), F.substring(name, 2, 2), F.substring(name, 3, 5), F.upper(name), F.col("p_brand"),
                    F.concat(F.lit("P"), F.col("p_partkey").cast("string")), F.concat(name, F.lit("x")))
    queries = t.part.select(F.explode(asked).alias("query")).distinct()
    return search.symbol_index(listed).search(queries, limit=10)


@register("m22_mean_pairwise_correlation", views=("prices25",), sql="""
WITH c AS (SELECT a.company, corr(a.changeOverTime, b.changeOverTime) AS r FROM prices25 a JOIN prices25 b ON a.date = b.date AND a.company <> b.company
  WHERE a.changeOverTime IS NOT NULL AND b.changeOverTime IS NOT NULL GROUP BY a.company, b.company)
SELECT company, count(r) AS partners, round(avg(r), 4) AS mean_correlation FROM (SELECT DISTINCT company FROM prices25) LEFT JOIN c USING (company) GROUP BY company
""")
def m22_mean_pairwise_correlation(t):
    """Correlations over the days each pair shares, blocks of seven companies."""
    return rounded(cluster.pairwise_correlation(once(V.prices25(t).select("company", "date", "changeOverTime")), block=7))
