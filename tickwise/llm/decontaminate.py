"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are short, documents long, so the sketch is kept on the items.
Items are partitioned by size (powers of two of their shingle count).  In the
partition with at most u shingles per item every item is represented by its
k = u - ceil(0.8 u) + 1 smallest shingle hashes.  A text that holds 80 % of an
item's shingles misses at most u - ceil(0.8 u) of them, so it holds at least
one of the k minima: the candidates are complete, whatever the document's
length.  A partition also skips documents with fewer shingles than its items
need.  Candidates are verified by exact containment on the shingle texts.

Words are split at white space and lower-cased; shingles have five words, and
an item of fewer words is one shingle of all its words.

Defined results: null, blank texts and items without words match nothing;
items with equal shingles are one class, reported under its smallest item_id
with ``n_items`` (``item_members`` names the others); rows that share a doc_id are searched one by one and the best
is reported; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import field, let, packed, small_side, stage, words

WIDTH = 5
CONTAINMENT = (4, 5)  # 0.8 as a fraction, compared in integers


def shingles(text: Column, widths: list[int], make) -> Column:
    """Distinct ``make(width, words)`` over all runs of each width; an empty array for shorter texts."""
    def of(ws: Column, k: int) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.size(ws) - (k - 1)), lambda i: make(F.lit(k), F.slice(ws, i, k)))
        return F.when(F.size(ws) >= k, runs)
    return let(words(F.lower(text)), lambda ws: F.array_distinct(
        F.flatten(F.filter(F.array(*[of(ws, k) for k in widths]), lambda a: a.isNotNull()))))


def _hash(width: Column, run: Column) -> Column:
    return F.xxhash64(width, run)


def _text(width: Column, run: Column) -> Column:
    return F.concat_ws(" ", run)


def _items(benchmark: DataFrame) -> DataFrame:
    """(item_id, s: width and sorted distinct shingles) of the items with words."""
    def own(ws: Column) -> Column:
        k = F.least(F.size(ws), F.lit(WIDTH))
        return F.when(F.size(ws) > 0, F.struct(k.alias("width"), F.array_sort(F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.size(ws) - k + 1), lambda i: F.concat_ws(" ", F.slice(ws, i, k))))).alias("shingles")))
    return benchmark.select("item_id", let(words(F.lower("text")), own).alias("s")).where("s IS NOT NULL")


def item_members(benchmark: DataFrame) -> DataFrame:
    """(item_id, class_id): the smallest item_id with the same shingles, under which an item is reported; one row per item row with words.

    With it, ``matches`` and ``contaminated`` name every member of a class without a pair for each.
    """
    items = _items(benchmark)
    classes = items.groupBy("s").agg(F.min("item_id").alias("class_id"))
    return items.join(classes, "s").select("item_id", "class_id")


def item_classes(benchmark: DataFrame) -> DataFrame:
    """Items with equal shingle sets as one row: item_id (smallest), n_items, width, shingles, n."""
    return (_items(benchmark).groupBy("s.width", "s.shingles").agg(F.min("item_id").alias("item_id"), F.count("*").alias("n_items"))
            .withColumn("n", F.size("shingles")))


def need(n: Column) -> Column:
    """Shingles that must be shared: the ceiling of 0.8 n."""
    return F.floor((n * CONTAINMENT[0] + (CONTAINMENT[1] - 1)) / CONTAINMENT[1])


def item_sketches(items: DataFrame) -> DataFrame:
    """(h, item_id, need): the minima of each item, as many as its size partition asks for."""
    upper = F.pow(F.lit(2), F.floor(F.log2("n")) + 1).cast("long") - 1
    hashed = F.array_sort(F.transform("shingles", lambda s: F.xxhash64(F.col("width"), F.split(s, " "))))
    k = (upper - need(upper) + 1).cast("int")
    return items.select("item_id", need(F.col("n")).alias("need"), F.explode(F.slice(hashed, 1, k)).alias("h"))


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, row, item_id, n_items, n_item_shingles, n_common) for containment of 0.8 or more; ``row`` is a hash of the text."""
    items = stage(item_classes(benchmark), "decon-items")
    widths = sorted(r["width"] for r in items.select("width").distinct().collect()) or [WIDTH]  # at most WIDTH values
    sketch = stage(item_sketches(items), "decon-sketch")
    rows = docs.select("doc_id", F.xxhash64("text").alias("row"), "text")

    hashed = rows.select("doc_id", "row", shingles(F.col("text"), widths, _hash).alias("hs"))
    probes = hashed.select("doc_id", "row", F.size("hs").alias("n_doc"), F.explode("hs").alias("h"))
    found = probes.join(small_side(sketch, 40), "h").where("n_doc >= need")
    candidates = stage(found.select("doc_id", "row", "item_id").distinct(), "decon-candidates")

    keys = candidates.select(F.col("doc_id").alias("_doc"), F.col("row").alias("_row")).distinct()
    suspects = rows.join(small_side(keys, 32), F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("row") == F.col("_row")), "left_semi")
    texts = suspects.dropDuplicates(["doc_id", "row"]).select("doc_id", "row", F.explode(shingles(F.col("text"), widths, _text)).alias("s"))
    wanted = items.select("item_id", F.explode("shingles").alias("s"))
    shared = texts.join(small_side(wanted, 120), "s").groupBy("doc_id", "row", "item_id").agg(F.count("*").alias("n_common"))
    c = candidates.select(F.col("doc_id").alias("_doc"), F.col("row").alias("_row"), F.col("item_id").alias("_item"))
    verified = shared.join(c, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("row") == F.col("_row")) & (F.col("item_id") == F.col("_item")), "left_semi")
    out = verified.join(items.select("item_id", "n_items", F.col("n").cast("long").alias("n_item_shingles")), "item_id")
    return (out.where(F.col("n_common") * CONTAINMENT[1] >= F.col("n_item_shingles") * CONTAINMENT[0])
            .select("doc_id", "row", "item_id", "n_items", "n_item_shingles", "n_common"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_items, n_item_shingles, n_common, containment): the best match of each document and item."""
    best = matches(docs, benchmark).groupBy("doc_id", "item_id", "n_items", "n_item_shingles").agg(F.max("n_common").alias("n_common"))
    return best.select("doc_id", "item_id", "n_items", "n_item_shingles", "n_common",
                       (F.col("n_common") / F.col("n_item_shingles")).alias("containment"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; a clean row stays even if it shares its doc_id."""
    bad = stage(matches(docs, benchmark).select(F.col("doc_id").alias("_bad"), F.col("row").alias("_row")).distinct(), "decon-bad")
    same = field("doc_id").eqNullSafe(F.col("_bad")) & (F.xxhash64(field("text")) == F.col("_row"))
    return packed(docs).join(small_side(bad, 32), same, "left_anti").select("_d.*")


DECON_SQL = r"""
WITH b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM benchmark WHERE text IS NOT NULL),
bs AS (SELECT item_id, least(5, len(ws)) AS k, list_sort(list_distinct(list_transform(range(1, len(ws) - least(5, len(ws)) + 2), lambda i: array_to_string(ws[i : i + least(5, len(ws)) - 1], ' ')))) AS sh
  FROM b WHERE len(ws) > 0),
items AS (SELECT min(item_id) AS item_id, count(*) AS n_items, k, sh, len(sh) AS n FROM bs GROUP BY k, sh),
d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents WHERE text IS NOT NULL),
ds AS (SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i : i + k - 1], ' '))) AS s FROM d, (SELECT DISTINCT k FROM items) WHERE len(ws) >= k),
hit AS (SELECT ds.doc_id, i.item_id, count(*) AS n_common FROM ds JOIN (SELECT item_id, k, unnest(sh) AS s FROM items) i ON ds.s = i.s AND ds.k = i.k GROUP BY ALL)
SELECT doc_id, hit.item_id, n_items::BIGINT AS n_items, n::BIGINT AS n_item_shingles, n_common::BIGINT AS n_common, n_common / n AS containment
FROM hit JOIN items USING (item_id) WHERE n_common * 5 >= n * 4"""
