"""Ranks in groups of any size, deep pages, symbol search, correlations by pairs and the quote table."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickwise.operators import cluster, ranks, search, select, stats
from tickwise.streaming import ticks as S

# quantiles


def test_quantiles_equal_percentile(spark):
    rng = np.random.RandomState(3)
    rows = [(k, float(v)) for k, n in (("a", 997), ("b", 2), ("c", 1)) for v in rng.randint(0, 50, n)]
    rows += [("a", None), ("d", None), (None, 4.0), (None, 9.0), ("e", float("nan")), ("e", 1.0), ("e", 3.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)
    got = {r["k"]: tuple(r)[1:] for r in ranks.quantiles(df, ["k"], "v", probs).collect()}
    want = {r["k"]: tuple(r["q"]) for r in df.groupBy("k").agg(F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("q")).collect() if r["q"]}
    assert set(got) == {"a", "b", "c", None, "e"} and set(want) == set(got)
    for k in got:
        np.testing.assert_allclose(got[k], want[k])


def test_quantiles_of_one_group_are_read_by_range(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df = spark.range(20000).select(F.lit(1).alias("k"), (F.col("id") % 5000).cast("double").alias("v"))
        q = ranks.quantiles(df, ["k"], "v", (0.5,))
        scan = ranks.sliced(df.groupBy("k", "v").count(), ["k"], [F.col("v")], "test")
        largest = scan.groupBy(ranks.SLICE).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert q.first()["q0"] == 2499.5
    assert largest < 5000 / 16 * 2


def test_quantiles_without_keys_and_of_an_empty_table(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "v double")
    assert [tuple(r) for r in ranks.quantiles(df, [], "v", (0.5, 0.75)).collect()] == [(2.0, 3.0)]
    assert ranks.quantiles(df.where("v > 9"), [], "v", (0.5,)).first()["q0"] is None
    assert ranks.quantiles(df.where("v > 9").withColumn("k", F.lit(1)), ["k"], "v", (0.5,)).collect() == []
    clash = df.withColumnRenamed("v", "_v").withColumn("_n", F.lit("x")).withColumn("_slice", F.lit("y"))
    assert [tuple(r) for r in ranks.quantiles(clash, ["_n", "_slice"], "_v", (0.5,)).collect()] == [("x", "y", 2.0)]


def test_describe_and_box_stats_by_ranges(spark):
    rows = [("x", 1.0, 5.0), ("x", 2.0, None), ("x", 9.0, None), ("y", None, 1.0), (None, 3.0, 2.0)]
    df = spark.createDataFrame(rows, "company string, a double, b double")
    same = lambda d: sorted(map(str, d.collect()))
    assert same(stats.describe(df, ["a", "b"], ranges=True)) == same(stats.describe(df, ["a", "b"]))
    full = df.where("company IS NOT NULL").na.drop()
    assert same(stats.box_stats(full, ["a", "b"], ranges=True)) == same(stats.box_stats(full, ["a", "b"]))


# pages


def test_pages_equal_the_sorted_table(spark):
    rows = [(i % 7 if i % 5 else None, f"n{i % 3}", i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, _row string, _copies int")
    index = ranks.page_index(df, ["k", "_row"])
    assert index.size == 300
    low = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    want = sorted(rows, key=low)
    for offset, limit in ((0, 10), (55, 20), (290, 25), (123, 1), (0, 300), (300, 5), (7, 0)):
        assert [tuple(r) for r in index.page(offset, limit).collect()] == want[offset:offset + limit]
    top = ranks.page_index(df, ["k"], ascending=False)
    assert top.page(0, 1).first()["k"] == 6 and top.page(299, 1).first()["k"] is None


def test_a_page_reads_its_ranges_only(spark):
    df = spark.range(8000).select((F.col("id") % 4000).alias("k"))
    index = ranks.page_index(df, ["k"])
    assert len(index.starts) == 8 and max(n for _, _, n in index.starts) < 2000
    page = index.page(index.size - 4, 4)
    assert [r["k"] for r in page.collect()] == [3998, 3998, 3999, 3999]
    assert len(page.select(F.input_file_name()).distinct().collect()) == 1
    assert f"(_slice#" in page._jdf.queryExecution().toString() and "PartitionFilters" in page._jdf.queryExecution().toString()


def test_pages_of_an_empty_table(spark):
    index = ranks.page_index(spark.createDataFrame([], "k int"), ["k"])
    assert index.size == 0 and index.page(0, 5).collect() == []


# search

PROFILES = [("AAPL", "Apple Inc.", "Tech"), ("APLE", "Apple Hospitality", "Estate"), ("A", "Agilent", "Health"), ("MSFT", "Microsoft", "Tech"),
            ("NUL", None, "Tech"), (None, "Nameless apple", "Tech"), ("AAPL", "Apple Inc.", "Tech"), ("", "", None), ("É", "École Ⅻ", "Tech")]


@pytest.mark.parametrize("limit", [2, 20])
def test_search_by_postings_equals_the_scan(spark, limit):
    df = spark.createDataFrame(PROFILES, "ticker string, name string, sector string").withColumn("_q", F.lit(1)).withColumn("run", F.lit("r"))
    asked = ["a", "ap", "app", "apple", "APPLE I", "micro", "zzz", "applex", "é", "l", "xii", "école ⅻ", "ap", " "]
    queries = spark.createDataFrame([(q,) for q in asked] + [(None,), ("",)], "query string")
    found = search.symbol_index(df).search(queries, limit).collect()
    for q in set(asked):
        got = sorted(str((r["ticker"], r["name"])) for r in found if r["query"] == q)
        want = sorted(str((r["ticker"], r["name"])) for r in select.symbol_search(df, q, limit=limit).collect())
        assert got == want, q
    assert {r["query"] for r in found} <= set(asked)


def test_search_in_a_sector_reads_postings_not_texts(spark):
    df = spark.createDataFrame(PROFILES, "ticker string, name string, sector string")
    index = search.symbol_index(df, "Estate")
    queries = spark.createDataFrame([("app",)], "query string")
    assert [r["ticker"] for r in index.search(queries).collect()] == ["APLE"]
    assert index.search(queries.where("query = 'b'")).collect() == []
    assert search.symbol_index(df.limit(0)).search(queries).collect() == []


# correlations


def history(rows):
    return [(c, dt.date(2024, 1, 1) + dt.timedelta(days=d), x) for c, d, x in rows]


@pytest.mark.parametrize("block", [2, 3, 100])
def test_mean_pairwise_correlation_on_unequal_histories(spark, block):
    rng = np.random.RandomState(5)
    base = rng.normal(size=100).tolist()
    rows = [("A", d, base[d]) for d in range(100)] + [("B", d, base[d]) for d in range(90, 100)]  # the last ten days of A
    rows += [(c, int(d), float(rng.normal() + base[d])) for c in "CDE" for d in rng.choice(120, 60, replace=False) % 100]
    rows += [("flat", d, 1.0) for d in range(50)] + [("one", 3, 2.0), ("F", 1, None), ("F", 2, float("nan"))]
    rows = list({(c, d): (c, d, x) for c, d, x in rows}.values())
    df = spark.createDataFrame(history(rows), "company string, date date, changeOverTime double")
    got = {r["company"]: r for r in cluster.pairwise_correlation(df, block).collect()}
    wide = pd.DataFrame(rows, columns=["c", "d", "x"]).pivot(index="d", columns="c", values="x").astype(float)
    assert set(got) == {r[0] for r in rows}
    for c in got:
        rs = []
        for o in wide.columns.drop(c):
            both = wide[[c, o]].dropna()
            if len(both) >= 2 and both[c].std() > 1e-9 and both[o].std() > 1e-9:
                rs.append(np.corrcoef(both[c], both[o])[0, 1])
        assert got[c]["partners"] == len(rs)
        assert got[c]["mean_correlation"] == (pytest.approx(np.mean(rs)) if rs else None)
        assert not rs or -1 <= got[c]["mean_correlation"] <= 1


def test_two_companies_of_one_course_correlate_fully(spark):
    rng = np.random.RandomState(1)
    x = rng.normal(size=100)
    df = spark.createDataFrame(history([("A", d, float(x[d])) for d in range(100)] + [("B", d, float(x[d])) for d in range(90, 100)]),
                               "company string, date date, changeOverTime double")
    assert [r["mean_correlation"] for r in cluster.pairwise_correlation(df).collect()] == [pytest.approx(1.0)] * 2


def test_pairwise_correlation_of_nothing(spark):
    assert cluster.pairwise_correlation(spark.createDataFrame([], "company string, date date, changeOverTime double")).collect() == []


# quotes


def test_quote_table_writes_what_changed_and_survives_replays(spark, tmp_path):
    at = lambda m: dt.datetime(2024, 1, 1, 9, m)
    batches = [[(1, at(1), "a", 1.0), (2, at(1), "a", 2.0), (3, at(2), "b", 3.0)],
               [(4, at(0), "a", 9.0), (5, at(5), None, 5.0)],  # a late tick of a; no symbol
               [(6, at(2), "b", 6.0)], [(7, at(9), "c", 7.0)], []]
    schema = "event_id long, ts timestamp, symbol string, price double"
    out = str(tmp_path / "quotes")
    for n, rows in enumerate(batches):
        df = spark.createDataFrame(rows, schema)
        for _ in range(2):  # each batch is delivered twice
            S.upsert_quotes(df, n, out, full_every=3)
    rows = lambda b: {r["symbol"]: (r["price"], r["ticks"]) for r in S.quotes_at(spark, out, b, full_every=3).collect()}
    assert rows(0) == {"a": (2.0, 2), "b": (3.0, 1)}
    assert rows(1) == {"a": (2.0, 3), "b": (3.0, 1), None: (5.0, 1)}
    assert rows(2) == {"a": (2.0, 3), "b": (6.0, 2), None: (5.0, 1)}
    assert rows(4) == {**rows(2), "c": (7.0, 1)}
    version = lambda n: {r["symbol"] for r in spark.read.parquet(f"{out}/{n}").collect()}
    assert [version(n) for n in range(5)] == [{"a", "b"}, {"a", None}, {"b"}, {"a", "b", None, "c"}, set()]


def test_quote_table_of_a_stream_resumes(spark, tmp_path):
    feed = str(tmp_path / "feed")
    schema = "event_id long, ts timestamp, symbol string, price double"
    row = lambda i: (i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), "ab"[i % 2], float(i))
    run = None
    for part in (range(0, 5), range(5, 9)):
        spark.createDataFrame([row(i) for i in part], schema).coalesce(1).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(feed)
        run = S.maintain_quotes(spark, stream, run, full_every=2)
    got = {r["symbol"]: (r["price"], r["ticks"]) for r in S.quotes_at(spark, run.output, run.batch, full_every=2).collect()}
    assert run.batch == 1 and got == {"a": (8.0, 5), "b": (7.0, 4)}
