"""P10: symbol search by a posting table of letter runs.

Every different text (ticker or name, lower-cased) is posted once under its runs
of the lengths in ``LENGTHS``.  A search is looked up by one run, the rarest of
the greatest length that fits it, and candidates are verified on the text, so
results equal a scan.  Runs as long as that keep a search among many alike (all
tickers of a long list) from meeting a fixed share of all texts.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Optional

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.sources.files import scratch

LENGTHS = (1, 2, 3, 4, 6, 8, 12)


def runs(text: Column, n: int) -> Column:
    """Distinct runs of ``n`` letters of a text, lower-cased; an empty array for a shorter or missing one."""
    low = F.lower(text)
    each = F.transform(F.sequence(F.lit(1), F.length(low) - (n - 1)), lambda i: F.substring(low, i, F.lit(n)))
    return F.coalesce(F.when(F.length(low) >= n, F.array_distinct(each)), F.array().cast("array<string>"))


@dataclass(frozen=True)
class SymbolIndex:
    """Profiles, the postings (run, text) of their texts and the number of postings of each run."""

    profiles: DataFrame
    postings: DataFrame
    counts: DataFrame

    def search(self, queries: DataFrame, limit: int = 10) -> DataFrame:
        """(query, rank, and the profile's columns): the first ``limit`` profiles by ticker of every ``queries.query``.

        All searches are one plan.  A null search finds nothing, an empty one nothing either (there is no run to look up);
        profiles of one ticker are ordered by their other columns.
        """
        hits = self.candidates(queries).where(F.contains("text", F.lower("_q")))
        p = F.struct("*").alias("_p")
        by_text = self.profiles.select(F.lower("ticker").alias("_text"), F.lit(False).alias("_by_name"), p).unionByName(
            self.profiles.select(F.lower("name").alias("_text"), F.lit(True).alias("_by_name"), p)).where("_text <> ''")
        # Spark keeps the first ``limit`` rows of a text, and of a search, in every task before the shuffle
        order = F.col("_p.ticker"), F.col("_p")
        w = Window.partitionBy("_text", "_by_name").orderBy(*order)
        first = by_text.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= limit).drop("_n")
        found = hits.join(first, F.col("text") == F.col("_text"))
        # a profile whose ticker is hit is not counted again by its name
        once = found.where(~F.col("_by_name") | ~F.coalesce(F.contains(F.lower("_p.ticker"), F.lower("_q")), F.lit(False)))
        best = once.withColumn("rank", F.row_number().over(Window.partitionBy("_q").orderBy(*order))).where(F.col("rank") <= limit)
        return best.select(F.col("_q").alias("query"), "rank", "_p.*")

    def candidates(self, queries: DataFrame) -> DataFrame:
        """(_q, text): the texts that have the search's rarest run; all its hits are among them."""
        asked = queries.select(F.col("query").alias("_q")).where("_q <> ''").distinct()
        of = F.coalesce(*[F.when(F.length(F.lower("_q")) >= n, runs(F.col("_q"), n)) for n in reversed(LENGTHS)])
        looked = asked.select("_q", F.explode(of).alias("run")).join(self.counts, "run", "left")
        # a run without postings is the rarest: its search has no result
        rarest = looked.groupBy("_q").agg(F.min_by("run", F.struct(F.coalesce("n", F.lit(0)), "run")).alias("run"))
        return rarest.join(self.postings, "run").select("_q", "text")


def symbol_index(profiles: DataFrame, exchange: Optional[str] = None) -> SymbolIndex:
    """Postings of ``profiles`` (ticker, name, ...), written once in the shared folder; of one sector with ``exchange``."""
    spark = profiles.sparkSession
    kept = profiles if exchange is None else profiles.where(F.col("sector") == exchange)
    texts = kept.select(F.lower("ticker").alias("text")).unionByName(kept.select(F.lower("name").alias("text"))).where("text <> ''").distinct()
    posted = texts.select(F.explode(F.concat(*[runs(F.col("text"), n) for n in LENGTHS])).alias("run"), "text")
    path = scratch(spark, "postings")
    posted.repartitionByRange("run", "text").sortWithinPartitions("run", "text").write.parquet(path)
    postings = spark.read.schema(posted.schema).parquet(path)
    counted = postings.groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    count_path = scratch(spark, "posting-counts")
    counted.write.parquet(count_path)
    return SymbolIndex(kept, postings, spark.read.schema(counted.schema).parquet(count_path))
