"""Chat formatting with cumulative-snapshot collapse.

Chat logs often store a conversation again after every reply.  A conversation
that is a strict prefix of a longer one is dropped, equal conversations leave
the smallest conv_id, and what is left is rendered.

The prefix hash of the first k turns is the running xor of 64-bit hashes of
(position, role, text), in two independent lanes.  Xor needs no fixed shape of
the scan, so a conversation of any length is hashed in slices
(``range_scan``): positions and hashes run within a slice and get the value of
the earlier slices added.  The full hash of every conversation is looked up
among the strict prefixes of all others by an anti-join on (k, hash), after
equal conversations and equal prefixes are each combined into one row.

Turns are ordered by turn (null first), then role, then text hash.  Rendering
is ``<|im_start|>role\ntext<|im_end|>\n`` per turn; a conversation has one row
for each SEGMENT turns, so no unbounded group is gathered.

Defined results: a null role is rendered as ``unknown`` and a null text as
empty, but both differ from such values in comparisons; rows without conv_id
are one conversation; repeated turns stay; an empty table gives no rows;
extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.common import range_scan, slice_offsets, stage

#: Turns in one output row.
SEGMENT = 256


def _after_earlier(placed: DataFrame, earlier: DataFrame) -> DataFrame:
    e = earlier.withColumnRenamed("conv_id", "_conv").withColumnRenamed("_pid", "_slice")
    return placed.join(e, placed["conv_id"].eqNullSafe(e["_conv"]) & (placed["_pid"] == e["_slice"]), "left").drop("_conv", "_slice")


def prefixes(conversations: DataFrame) -> DataFrame:
    """Every turn with its 1-based position ``k`` and the hash lanes ``h1``, ``h2`` of the first k turns."""
    tie = F.xxhash64(F.col("text").isNull(), "text")
    rows = conversations.select("conv_id", "turn", "role", "text", tie.alias("_tie"))
    order = [F.col("turn").asc(), F.col("role").asc(), F.col("_tie").asc()]
    scan = range_scan(rows, ["conv_id"], order, "chat-scan")
    within = Window.partitionBy("_pid", "conv_id").orderBy(*order)
    earlier = slice_offsets(scan, ["conv_id"], {"_n": F.count("*")}, {"_n": F.sum("_n")})
    placed = _after_earlier(scan.withColumn("k", F.row_number().over(within)), earlier).withColumn("k", F.col("k") + F.coalesce("_n", F.lit(0)))
    fields = [F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    placed = stage(placed.select("conv_id", "_pid", "k", "role", "text", F.xxhash64("k", *fields).alias("t1"), F.xxhash64(F.lit("lane"), *fields, "k").alias("t2")),
                   "chat-turns")
    run = Window.partitionBy("_pid", "conv_id").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    earlier = slice_offsets(placed, ["conv_id"], {"_x1": F.bit_xor("t1"), "_x2": F.bit_xor("t2")}, {"_x1": F.bit_xor("_x1"), "_x2": F.bit_xor("_x2")})
    local = placed.withColumn("h1", F.bit_xor("t1").over(run)).withColumn("h2", F.bit_xor("t2").over(run))
    merged = _after_earlier(local, earlier)
    return merged.select("conv_id", "k", "role", "text", *[F.col(h).bitwiseXOR(F.coalesce(x, F.lit(0).cast("long"))).alias(h)
                                                           for h, x in (("h1", "_x1"), ("h2", "_x2"))])


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies) of the conversations that are no strict prefix of another."""
    ends = turns.groupBy("conv_id").agg(F.max(F.struct("k", "h1", "h2")).alias("end"))
    classes = ends.groupBy("end").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    e = ends.select(F.col("conv_id").alias("_conv"), F.col("end.k").alias("_n"))
    inner = turns.select("conv_id", "k", "h1", "h2").join(e, F.col("conv_id").eqNullSafe(F.col("_conv"))).where("k < _n")
    inner = inner.groupBy("k", "h1", "h2").agg(F.lit(1).alias("_any"))
    kept = classes.select("conv_id", "n_copies", F.col("end.k").alias("k"), F.col("end.h1").alias("h1"), F.col("end.h2").alias("h2"))
    return kept.join(inner, ["k", "h1", "h2"], "left_anti").select("conv_id", F.col("k").cast("long").alias("n_turns"), "n_copies")


def render(conversations: DataFrame) -> DataFrame:
    """Maximal conversations as text: conv_id, segment, n_turns, n_copies, text, n_chars."""
    turns = stage(prefixes(conversations), "chat-prefixes")
    kept = stage(maximal(turns), "chat-maximal")
    k = kept.withColumnRenamed("conv_id", "_conv")
    line = F.concat(F.lit("<|im_start|>"), F.coalesce("role", F.lit("unknown")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit("<|im_end|>\n"))
    rows = turns.join(k, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "conv_id", "n_turns", "n_copies", F.floor((F.col("k") - 1) / SEGMENT).alias("segment"), "k", line.alias("line"))
    grouped = rows.groupBy("conv_id", "segment", "n_turns", "n_copies").agg(F.array_sort(F.collect_list(F.struct("k", "line"))).alias("_lines"))
    text = F.array_join(F.transform("_lines", lambda x: x["line"]), "")
    return grouped.select("conv_id", "segment", "n_turns", "n_copies", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


CHAT_SQL = r"""
WITH c AS (SELECT conv_id, list(coalesce(role, 'unknown') || chr(10) || coalesce(text, '') ORDER BY turn, role) AS l FROM conversations GROUP BY conv_id),
u AS (SELECT min(conv_id) AS conv_id, count(*) AS n_copies, l, len(l) AS n FROM c GROUP BY l),
p AS (SELECT DISTINCT a.conv_id FROM u a JOIN u b ON a.l[1] = b.l[1] AND b.n > a.n AND b.l[1:a.n] = a.l),
k AS (SELECT conv_id, n, n_copies, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM u WHERE conv_id NOT IN (SELECT conv_id FROM p))
SELECT conv_id, ((i - 1) // 256)::BIGINT AS segment, n::BIGINT AS n_turns, n_copies::BIGINT AS n_copies,
  string_agg('<|im_start|>' || line || '<|im_end|>' || chr(10), '' ORDER BY i) AS text,
  length(string_agg('<|im_start|>' || line || '<|im_end|>' || chr(10), '' ORDER BY i))::BIGINT AS n_chars
FROM k GROUP BY ALL"""
