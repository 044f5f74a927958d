r"""Target-distribution importance resampling with segment deduplication.

Documents are drawn without replacement so that the draw looks like a target
corpus: hashed n-gram features, a log-ratio gain per bucket, a document's
weight as the sum of its features' gains, and Gumbel noise from a hash of its
id, of which the highest scores are the draw.

Newlines separate words, so a text is the row of its lines (segments):

* equal lines are counted first; a distinct line's features are computed once
  and counted as often as the line occurs;
* a distinct line's gains are summed once and handed to every document that
  has the line;
* n-grams that reach over a line's end belong to no line; they are listed per
  document and added separately (none for single words).

Only the gains, one integer per bucket, pass through the driver.

Defined results: a null or empty text has no features, weight 0 and no rank; a
null doc_id draws noise as an empty id and comes first in ties; rows that
agree in score, id and features are interchangeable; an empty table or target
gives gains of what is left (every count is smoothed by one); other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwise.llm.common import let, range_scan, stage

# Fixed values of the feature rule and the draw.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NGRAM = 1
BUCKETS = 10_000
SEED = 2024
MIN_WORDS = 20
#: Share of the eligible documents that is drawn, as a fraction.
SHARE = (10, 100)


def segments(text: Column) -> Column:
    """The lines of a text; a null text has none."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def words(line: Column) -> Column:
    return F.regexp_extract_all(F.translate(line, UPPER, LOWER), F.lit(WORD), F.lit(0))


def key(line: Column) -> Column:
    """128 bits that stand for a line."""
    return F.unhex(F.md5(line))


def bucket(feature: Column, buckets: int) -> Column:
    return (F.crc32(feature) % buckets).cast("int")


def features(w: Column, n: int, buckets: int) -> Column:
    """Buckets of all runs of 1 to n words."""
    def runs(k: int) -> Column:
        if k == 1:
            return F.transform(w, lambda x: bucket(x, buckets))
        starts = F.when(F.size(w) >= k, F.sequence(F.lit(1), F.size(w) - k + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: bucket(F.array_join(F.slice(w, i, k), " "), buckets))
    return F.concat(*[runs(k) for k in range(1, n + 1)])


def crossing(text: Column, n: int, buckets: int) -> Column:
    """Buckets of the runs of 2 to n words that reach over a line's end."""
    if n == 1:
        return F.array().cast("array<int>")
    def of(lines: Column) -> Column:
        flat = F.flatten(lines)
        line = F.flatten(F.transform(lines, lambda w, i: F.array_repeat(i, F.size(w))))
        def both(e: Column) -> Column:
            size = F.size(e["w"])
            def runs(k: int) -> Column:
                starts = F.when(size >= k, F.sequence(F.lit(1), size - k + 1)).otherwise(F.array().cast("array<int>"))
                over = F.filter(starts, lambda i: F.get(e["l"], i - 1) != F.get(e["l"], i + k - 2))
                return F.transform(over, lambda i: bucket(F.array_join(F.slice(e["w"], i, k), " "), buckets))
            return F.concat(*[runs(k) for k in range(2, n + 1)])
        return let(F.struct(flat.alias("w"), line.alias("l")), both)
    return let(F.transform(segments(text), words), of)


def distinct_segments(texts: DataFrame, n: int, buckets: int) -> DataFrame:
    """(key, times, n_words, hits): the distinct lines that hold a word, how often each occurs, and its features' buckets."""
    lines = texts.select(F.explode(segments(F.col("text"))).alias("line")).where("line != ''")
    counted = lines.groupBy("line").agg(F.count("*").alias("times"))
    w = counted.select(key(F.col("line")).alias("key"), "times", words(F.col("line")).alias("w")).where(F.size("w") > 0)
    return w.select("key", "times", F.size("w").cast("long").alias("n_words"), features(F.col("w"), n, buckets).alias("hits"))


def bucket_counts(segs: DataFrame, texts: DataFrame, n: int, buckets: int) -> DataFrame:
    """(bucket, c): occurrences of each bucket over all texts."""
    inside = segs.select(F.explode("hits").alias("bucket"), "times")
    if n > 1:
        over = texts.select(F.explode(crossing(F.col("text"), n, buckets)).alias("bucket"), F.lit(1).cast("long").alias("times"))
        inside = inside.unionByName(over)
    return inside.groupBy("bucket").agg(F.sum("times").alias("c"))


def gains(spark: SparkSession, source: DataFrame, target: DataFrame, buckets: int) -> list[int]:
    """floor(1000 ln of the smoothed ratio of target to source) of every bucket; ``buckets`` integers."""
    s, t = (c.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0] for c in (source, target))
    every = spark.range(buckets).withColumnRenamed("id", "bucket")
    both = every.join(source.withColumnRenamed("c", "s"), "bucket", "left").join(target.withColumnRenamed("c", "t"), "bucket", "left").fillna(0, ["s", "t"])
    d = lambda c: c.cast("double")
    ratio = (d(F.col("t") + 1) * F.lit(float(s + buckets))) / (d(F.col("s") + 1) * F.lit(float(t + buckets)))
    rows = both.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain")).collect()
    return [r["gain"] for r in sorted(rows)]


def noise(doc_id: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)) with u from the first 8 hex digits of sha256(``seed:doc_id``)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def weigh(docs: DataFrame, target: DataFrame, n: int = NGRAM, buckets: int = BUCKETS) -> DataFrame:
    """One row per document: _row, doc_id, n_words, n_features, weight; ``_row`` tells equal rows apart."""
    spark = docs.sparkSession
    rows = stage(docs.select(
        F.monotonically_increasing_id().alias("_row"), "doc_id",
        F.transform(F.filter(segments(F.col("text")), lambda x: x != ""), key).alias("lines"),
        crossing(F.col("text"), n, buckets).alias("over")), "importance-rows")
    segs = stage(distinct_segments(docs, n, buckets), "importance-segments")
    ours = stage(bucket_counts(segs, docs, n, buckets), "importance-counts")
    wanted = distinct_segments(target, n, buckets)
    table = F.split(F.lit(",".join(map(str, gains(spark, ours, bucket_counts(wanted, target, n, buckets), buckets)))), ",").cast("array<bigint>")
    zero = F.lit(0).cast("long")
    total = lambda hits: F.aggregate(hits, zero, lambda a, b: a + F.get(table, b))
    worth = stage(segs.select("key", "n_words", F.size("hits").cast("long").alias("k"), total(F.col("hits")).alias("gain")), "importance-worth")
    # both sides are plain shuffles by line, so Spark can split a line that very many documents have
    met = rows.select("_row", F.explode("lines").alias("key")).join(worth, "key")
    sums = met.groupBy("_row").agg(F.sum("n_words").alias("w"), F.sum("k").alias("k"), F.sum("gain").alias("g"))
    own = rows.select("_row", "doc_id", F.size("over").cast("long").alias("_k"), total(F.col("over")).alias("_g"))
    part = lambda c: F.coalesce(F.col(c), zero)
    return own.join(sums, "_row", "left").select("_row", "doc_id", part("w").alias("n_words"), (part("k") + F.col("_k")).alias("n_features"),
                                                 (part("g") + F.col("_g")).alias("weight"))


def resample(docs: DataFrame, target: DataFrame, n: int = NGRAM, buckets: int = BUCKETS, seed: int = SEED,
             min_words: int = MIN_WORDS, share: tuple[int, int] = SHARE) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (null where not drawn), n_words."""
    scored = stage(weigh(docs, target, n, buckets).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "importance-scores")
    eligible = scored.where(F.col("n_words") >= min_words)
    drawn = eligible.count() * share[0] // share[1]
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("n_features").asc(), F.col("_row").asc()]
    scan = range_scan(eligible, [], order, "importance-order")
    ahead = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    starts = F.broadcast(scan.groupBy("_pid").agg(F.count("*").alias("_m")).select("_pid", F.coalesce(F.sum("_m").over(ahead), F.lit(0)).alias("_first")))
    place = F.row_number().over(Window.partitionBy("_pid").orderBy(*order)) + F.col("_first")
    out = ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    ranked = scan.join(starts, "_pid").withColumn("_place", place).withColumn("rank", F.when(F.col("_place") <= drawn, F.col("_place")).cast("long"))
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(out).unionByName(rest.select(out))


IMPORTANCE_SQL = r"""
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS x FROM documents),
v AS (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS x FROM benchmark),
b AS (SELECT x, xor(list_reduce(range(strlen(x)), lambda a, i:
      list_reduce(range(8), lambda c, k: xor(c >> 1, (c & 1) * 3988292384), xor(a, ('0x' || substr(hex(x), 2 * i + 1, 2))::BIGINT)),
    4294967295::BIGINT), 4294967295) % 10000 AS bucket FROM (SELECT x FROM w UNION SELECT x FROM v)),
s AS (SELECT bucket, count(*) AS s FROM w JOIN b USING (x) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM v JOIN b USING (x) GROUP BY bucket),
g AS (SELECT k.bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM w) + 10000)::DOUBLE)
      / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM v) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM (SELECT range AS bucket FROM range(10000)) k LEFT JOIN s ON s.bucket = k.bucket LEFT JOIN t ON t.bucket = k.bucket),
f AS (SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS weight FROM w JOIN b USING (x) JOIN g USING (bucket) GROUP BY doc_id),
d AS (SELECT d.doc_id, coalesce(f.n, 0) AS n_features, coalesce(f.weight, 0) AS weight, coalesce(f.weight, 0) + floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM documents d LEFT JOIN f USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM d WHERE n_features >= 20)
SELECT d.*, d.n_features AS n_words, CASE WHEN r.place <= r.n * 10 // 100 THEN r.place END AS rank FROM d LEFT JOIN r USING (doc_id)"""
