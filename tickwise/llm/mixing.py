"""Mixing sources to target weights by systematic sampling.

Sources, in code-point order with null last, weigh 3, 1, 2, repeating, and
share a budget of 150 % of all words.  A target stops at twice its source's
size and the excess is shared again by weight among the others.  Within a
source every document expects target / size copies; the documents are put in
order of size, the expected copies are prefix-summed, one random offset is
added and a copy is emitted for each integer boundary crossed.

The shares of a source are equal, so the prefix sum of the first i documents
is i times the share: running integer positions, which do not drift.  The
positions come from a range-partitioned scan (``range_scan``), so a source
with a third of all rows is spread over many tasks.

Defined results: null or blank text has size 0 and takes 0 words; a null
source is a source of its own; rows with equal id, source and size are
interchangeable; an empty table gives an empty result; columns named like the
output ones are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.common import field, packed, range_scan, slice_offsets, stage

WEIGHTS = (3, 1, 2)
#: Words of the mix per word of the input, as a fraction.
BUDGET = (3, 2)
MAX_COPIES = 2


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: tuple[int, int] = BUDGET,
                   max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target) from rows of (source, size)."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    scan = range_scan(per.withColumn("_last", F.col("source").isNull()), [], [F.col("_last"), F.col("source")], "mix-sources")
    offsets = _slice_starts(scan)
    rank = F.row_number().over(Window.partitionBy("_pid").orderBy("_last", "source")) - 1
    ranked = scan.withColumn("_i", rank).join(offsets, "_pid").withColumn("_i", F.col("_i") + F.col("_start"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_i") % len(weights) + 1).cast("int"))
    ranked = stage(ranked.select("source", "source_size", weight.cast("long").alias("weight"),
                                 (F.col("source_size") * max_copies).alias("cap")), "mix-weights")
    total, w = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    goal = (total or 0) * budget[0] / budget[1]
    level, capped_size, capped_weight = goal / w if w else 0.0, 0, 0
    while True:
        over = F.col("weight") * F.lit(float(level)) > F.col("cap")
        size, weight_sum = ranked.where(over).agg(F.coalesce(F.sum("cap"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
        if (size, weight_sum) == (capped_size, capped_weight):
            break
        capped_size, capped_weight = size, weight_sum
        level = (goal - size) / (w - weight_sum) if w > weight_sum else level
    target = F.when(over, F.col("cap").cast("double")).otherwise(F.col("weight") * F.lit(float(level)))
    return ranked.select("source", "source_size", target.cast("double").alias("target"))


def _slice_starts(scan: DataFrame) -> DataFrame:
    """(_pid, _start): rows before each slice; one row per partition, so it may be broadcast."""
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    counts = scan.groupBy("_pid").agg(F.count("*").alias("_n"))
    return F.broadcast(counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))


def offset(source: Column, seed: int) -> Column:
    """The source's random offset in [0, 1), the same in every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: tuple[int, int] = BUDGET,
        max_copies: int = MAX_COPIES, seed: int = 0) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    sizes = stage(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "mix-sizes")
    targets = source_targets(sizes, weights, budget, max_copies)
    order = [F.col("size").desc(), F.col("doc_id").asc()]
    scan = range_scan(sizes, ["source"], order, "mix-scan")
    position = F.row_number().over(Window.partitionBy("_pid", "source").orderBy(*order))
    earlier = slice_offsets(scan, ["source"], {"_n": F.count("*")}, {"_before": F.sum("_n")})
    scan = scan.withColumn("_i", position)
    placed = scan.join(earlier, scan["source"].eqNullSafe(earlier["source"]) & (scan["_pid"] == earlier["_pid"]), "left")
    placed = placed.select(scan["doc_id"], scan["source"], scan["size"], (F.col("_i") + F.coalesce("_before", F.lit(0))).alias("_i"))
    t = targets.withColumnRenamed("source", "_source")
    rows = placed.join(t, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    u = offset(F.col("source"), seed)
    crossed = F.floor(F.col("_i") * share + u) - F.floor((F.col("_i") - 1) * share + u)
    # the cap only guards the last bit of the two products
    copies = F.when(share >= max_copies, F.lit(max_copies)).otherwise(F.least(crossed, F.lit(max_copies))).cast("long")
    return rows.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def emit(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The mixed corpus: every document as often as ``plan`` says, with ``copy_no`` from 1.

    Rows with equal id, source and size share their copies as evenly as can be,
    by the order of their texts; only such rows are ranked, in slices.
    """
    unit = ["doc_id", "source", "size"]
    units = stage(plan.groupBy(*unit).agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows")), "mix-units")
    u = units.where("_copies > 0").select(*[F.col(c).alias(f"_{c}") for c in unit], "_copies", "_rows")
    d = packed(docs).withColumn("_n", n_words(field("text")))
    same = field("doc_id").eqNullSafe(F.col("_doc_id")) & field("source").eqNullSafe(F.col("_source")) & (F.col("_n") == F.col("_size"))
    dealt = d.join(u.where("_rows = 1"), same).select("_d", F.col("_copies").alias("_k"))
    if units.where("_rows > 1").limit(1).count():
        rows = d.join(u.where("_rows > 1"), same).withColumn("_order", F.xxhash64(field("text")))
        keys = ["_doc_id", "_source", "_size"]
        scan = range_scan(rows, keys, [F.col("_order")], "mix-repeated")
        earlier = slice_offsets(scan, keys, {"_m": F.count("*")}, {"_before": F.sum("_m")}).select(
            *[F.col(c).alias(f"_e{c}") for c in ["_pid", *keys]], "_before")
        nth = F.row_number().over(Window.partitionBy("_pid", *keys).orderBy("_order"))
        found = F.lit(True)
        for c in ["_pid", *keys]:
            found = found & F.col(c).eqNullSafe(F.col(f"_e{c}"))
        placed = scan.withColumn("_nth", nth).join(earlier, found, "left")
        each, rest = F.floor(F.col("_copies") / F.col("_rows")), F.col("_copies") % F.col("_rows")
        k = each + (F.col("_nth") + F.coalesce("_before", F.lit(0)) <= rest).cast("long")
        dealt = dealt.unionByName(placed.select("_d", k.alias("_k")))
    copy_no = "copy_no" if "copy_no" not in docs.columns else "mix_copy_no"
    return dealt.where("_k > 0").select("_d.*", F.explode(F.sequence(F.lit(1), F.col("_k").cast("int"))).alias(copy_no))


MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
        CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w
      FROM d GROUP BY source),
r AS (SELECT *, 2 * source_size AS cap,
        coalesce(sum(2 * source_size) OVER o, 0) AS caps_before, sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS w_left,
        sum(source_size) OVER () * 3 / 2.0::DOUBLE AS goal
      FROM s WINDOW o AS (ORDER BY 2.0 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT min(CASE WHEN cap >= w * ((goal - caps_before) / w_left) THEN (goal - caps_before)::DOUBLE / w_left END) AS lo,
        arg_min((goal - caps_before)::DOUBLE / w_left, cap::DOUBLE / w) FILTER (WHERE cap >= w * ((goal - caps_before)::DOUBLE / w_left)) AS level FROM r),
t AS (SELECT source, source_size, CASE WHEN w * level > cap THEN cap::DOUBLE ELSE w * level END AS target FROM r, l),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS share,
        row_number() OVER (PARTITION BY d.source ORDER BY d.size DESC, d.doc_id) AS i,
        ('0x' || substr(md5('0:' || coalesce(d.source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (CASE WHEN share >= 2 THEN 2 ELSE least(2, floor(i * share + u) - floor((i - 1) * share + u)) END)::BIGINT * size AS taken
FROM p"""
