r"""Merkle dataset manifest with bitmap-rank indexing.

Every document is a leaf, every source has a tree over its leaves in order of
doc_id, and the sources' subroots form the last tree.  Three consecutive nodes
become their parent; a run at the end may hold fewer.

Places in a tree come from rank queries, not from sorting documents:

* a source's doc_ids are merged into compressed bitmaps: only the 64-bit words
  that hold an id are kept, one row each, combined map-side by ``bit_or``;
* a two-level popcount directory counts the ids before each chunk of 512 words
  and before each word;
* a document's rank is its word's count plus the bits below its own.

Ranks are then keys of slot arrays: BLOCK consecutive nodes meet in one array,
which reduces LEVELS levels at once, and the blocks' nodes are the next round's
leaves.  Proofs are put together top-down, a block's path joined to the block,
so a document's siblings never leave its array.

Defined results: a null column counts as ``-``; a null doc_id counts as the
least id; rows with equal source and id are ordered by leaf (equal leaves are
interchangeable); a null source is a source of its own and comes first; empty
texts are hashed as such; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.common import range_scan, slice_offsets, small_side, stage

FAN = 3
LEVELS = 6
#: Nodes of one slot array.
BLOCK = FAN**LEVELS

LEAST = -(1 << 63)


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field_text(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    v = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, g, id, leaf, tampered): g orders sources null first; tampered is null where tampering changes nothing."""
    head = F.concat(*[field_text(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")])
    text = F.col("text")
    hit = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & text.contains("\n")
    return docs.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("g"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("id"),
        F.unhex(digest(head, field_text(text))).alias("leaf"),
        F.unhex(F.when(hit, digest(head, field_text(F.replace(text, F.lit("\n"), F.lit("")))))).alias("tampered"))


def directory(rows: DataFrame) -> DataFrame:
    """(g, word, bits, copies, start, n): one row per non-empty bitmap word with the rows of ``g`` before it and in all.

    ``copies`` lists (bit, rows beyond the first) of ids that occur more than once.
    """
    bit = F.expr("shiftleft(1L, cast(id & 63 as int))")
    words = stage(rows.groupBy("g", F.shiftright("id", 6).alias("word")).agg(
        F.bit_or(bit).alias("bits"), F.count("*").alias("m")), "merkle-words")
    chunk = F.shiftright("word", 9)
    scan = range_scan(words.groupBy("g", chunk.alias("chunk")).agg(F.sum("m").alias("m")), ["g"], [F.col("chunk")], "merkle-chunks")
    before = Window.partitionBy("_pid", "g").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    earlier = slice_offsets(scan, ["g"], {"_m": F.sum("m")}, {"_before": F.sum("_m")})
    counted = scan.withColumn("_own", F.coalesce(F.sum("m").over(before), F.lit(0))).join(earlier, ["g", "_pid"], "left")
    sizes = scan.groupBy("g").agg(F.sum("m").alias("n"))
    chunks = stage(counted.select("g", "chunk", (F.col("_own") + F.coalesce("_before", F.lit(0))).alias("first")).join(sizes, "g"), "merkle-starts")
    inside = Window.partitionBy("g", "chunk").orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
    placed = words.withColumn("chunk", chunk).join(chunks, ["g", "chunk"]).withColumn(
        "start", F.col("first") + F.coalesce(F.sum("m").over(inside), F.lit(0)))
    none = F.array().cast("array<struct<bit:int,more:bigint>>")
    if not words.where(F.bit_count("bits") < F.col("m")).limit(1).count():
        return placed.select("g", "word", "bits", none.alias("copies"), "start", "n")
    crowded = words.where(F.bit_count("bits") < F.col("m")).select("g", "word")
    often = (rows.withColumn("word", F.shiftright("id", 6)).join(crowded, ["g", "word"], "left_semi")
             .groupBy("g", "word", "id").agg((F.count("*") - 1).alias("more")).where("more > 0"))
    lists = often.groupBy("g", "word").agg(F.collect_list(F.struct(F.expr("cast(id & 63 as int)").alias("bit"), "more")).alias("copies"))
    return placed.join(lists, ["g", "word"], "left").select("g", "word", "bits", F.coalesce("copies", none).alias("copies"), "start", "n")


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with their place ``rank`` in their source's tree and its size ``n``."""
    index = stage(directory(rows), "merkle-directory")
    at = F.expr("cast(id & 63 as int)")
    met = rows.withColumn("word", F.shiftright("id", 6)).join(index, ["g", "word"]).withColumn("_bit", at)
    below = F.bit_count(F.expr("bits & ~shiftleft(-1L, _bit)")).cast("long")
    more = F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + F.when(c["bit"] < F.col("_bit"), c["more"]).otherwise(0))
    again = F.exists("copies", lambda c: c["bit"] == F.col("_bit"))
    found = met.select("doc_id", "g", "id", "leaf", "tampered", "n", (F.col("start") + below + more).alias("rank"), again.alias("_again"))
    if not index.where(F.size("copies") > 0).limit(1).count():
        return found.drop("_again", "id")
    # rows that share an id: the nth by leaf, counted in slices, so that one id may hold any number of rows
    scan = range_scan(found.where("_again"), ["g", "id"], [F.col("leaf")], "merkle-copies")
    nth = F.row_number().over(Window.partitionBy("_pid", "g", "id").orderBy("leaf")) - 1
    earlier = slice_offsets(scan, ["g", "id"], {"_m": F.count("*")}, {"_before": F.sum("_m")})
    placed = scan.withColumn("_nth", nth).join(earlier, ["g", "id", "_pid"], "left").withColumn(
        "rank", F.col("rank") + F.col("_nth") + F.coalesce("_before", F.lit(0)))
    cols = ["doc_id", "g", "leaf", "tampered", "n", "rank"]
    return found.where("not _again").select(cols).unionByName(placed.select(cols))


def _reduced(slots: Column, alone: Column) -> Column:
    """(node, levels): a slot array reduced LEVELS times, or to one node where it is the only array of its tree."""
    up = lambda a: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(a) - 1) / FAN).cast("int")),
        lambda i: F.sha2(F.array_join(F.slice(a, i * FAN + 1, FAN), ""), 256))
    start = F.struct(slots.alias("nodes"), F.array().cast("array<array<string>>").alias("levels"))
    step = lambda s, _: F.when(~alone | (F.size(s["nodes"]) > 1), F.struct(
        up(s["nodes"]).alias("nodes"), F.concat(s["levels"], F.array(s["nodes"])).alias("levels"))).otherwise(s)
    return F.aggregate(F.sequence(F.lit(1), F.lit(LEVELS)), start, step, lambda s: F.struct(s["nodes"][0].alias("node"), s["levels"].alias("levels")))


def _path(levels: Column, slot: Column) -> Column:
    """The siblings left and right of a slot's ancestors, level by level."""
    def siblings(level: Column, k: Column) -> Column:
        at = F.floor(slot / F.pow(F.lit(FAN), k)).cast("int")
        run = at - at % FAN
        join = lambda first, size: F.array_join(F.slice(level, first, size), "")
        return F.struct(join(run + 1, at - run).alias("left"), join(at + 2, run + FAN - 1 - at).alias("right"))
    return F.transform(levels, siblings)


PATH = "array<struct<left:string,right:string>>"


def _blocks(nodes: DataFrame, slot: list[str], name: str) -> DataFrame:
    """One row per slot array: g, block, n, entries (by slot), node, levels; ``slot`` names what an entry holds, its hash first."""
    grouped = nodes.groupBy("g", F.expr(f"rank div {BLOCK}").alias("block")).agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct((F.col("rank") % BLOCK).cast("int").alias("slot"), *slot))).alias("entries"))
    text = lambda e: F.lower(F.hex(e[slot[0]])) if slot[0] == "leaf" else e[slot[0]]
    made = grouped.withColumn("_r", _reduced(F.transform("entries", text), F.col("n") <= BLOCK))
    return stage(made.select("g", "block", "n", "entries", "_r.node", "_r.levels"), name)


def _climb(nodes: DataFrame, slot: list[str], largest: int, name: str) -> tuple[DataFrame, DataFrame]:
    """The first round's blocks with the path above each of them, and (g, root) of every tree.

    ``nodes`` has g, rank, n (nodes of g) and the ``slot`` columns; ``largest`` is the largest n.
    """
    rounds = [_blocks(nodes, slot, f"{name}-blocks")]
    while largest > BLOCK:
        largest = -(-largest // BLOCK)
        up = rounds[-1].select("g", F.col("block").alias("rank"), F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), "node")
        rounds.append(_blocks(up, ["node"], f"{name}-blocks"))
    # a tree that ends in an earlier round is passed on as a single node, whose path is empty
    above = rounds[-1].withColumn("above", F.array().cast(PATH))
    roots = above.select("g", F.col("node").alias("root"))
    for lower in reversed(rounds[:-1]):
        own = F.transform(F.sequence(F.lit(0), F.size("entries") - 1), lambda s: F.struct(
            (F.col("block") * BLOCK + s).alias("block"), F.concat(_path(F.col("levels"), s), F.col("above")).alias("above")))
        paths = stage(above.select("g", F.inline(own)), f"{name}-paths")
        above = lower.join(paths, ["g", "block"])
    return above, roots


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, and its source."""
    rows = stage(leaves(docs), "merkle-leaves")
    nodes = ranked(rows)
    largest = rows.groupBy("g").count().agg(F.max("count")).first()[0] or 0
    blocks, subroots = _climb(nodes, ["leaf", "doc_id", "tampered"], largest, "merkle")

    order = range_scan(subroots, [], [F.col("g")], "merkle-sources")
    ahead = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    starts = F.broadcast(order.groupBy("_pid").agg(F.count("*").alias("_m")).select("_pid", F.coalesce(F.sum("_m").over(ahead), F.lit(0)).alias("_first")))
    count = order.count()
    sources = order.withColumn("_i", F.row_number().over(Window.partitionBy("_pid").orderBy("g")) - 1).join(starts, "_pid").select(
        F.lit("").alias("g"), (F.col("_first") + F.col("_i")).alias("rank"), F.lit(count).cast("long").alias("n"),
        F.col("root").alias("node"), F.col("g").alias("of"))
    top, roots = _climb(sources, ["node", "of"], count, "merkle-top")
    entry = F.transform("entries", lambda e, s: F.struct(e["of"].alias("g"), e["node"].alias("subroot"),
                                                         F.concat(_path(F.col("levels"), s), F.col("above")).alias("rest")))
    whole = roots.select("root").withColumn("_one", F.lit(1))  # one row: every source is in the one last tree
    tops = stage(top.select(F.inline(entry), F.lit(1).alias("_one")).join(F.broadcast(whole), "_one").drop("_one"), "merkle-tops")

    path = lambda s: F.concat(_path(F.col("levels"), s), F.col("above"), F.col("rest"))
    def proof(e: Column, s: Column) -> Column:
        leaf = F.lower(F.hex(e["leaf"]))
        fold = F.aggregate(path(s), F.coalesce(F.lower(F.hex(e["tampered"])), leaf),
                           lambda h, p: F.sha2(F.concat(p["left"], h, p["right"]), 256))
        siblings = F.array_join(F.transform(path(s), lambda p: F.concat(p["left"], p["right"])), "")
        return F.struct(e["doc_id"].alias("doc_id"), leaf.alias("leaf"), F.sha2(siblings, 256).alias("proof_sha256"), fold.alias("folded_root"))
    done = blocks.join(small_side(tops, 8192), "g").select("g", "subroot", "root", F.inline(F.transform("entries", proof)))
    return done.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
                       F.when(F.col("g") != "", F.expr("substring(g, 2)")).alias("source"))


MERKLE_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT DISTINCT doc_id, list_reduce(range(1, len(doc_id::VARCHAR) + 1), lambda a, i:
      list_reduce(range(8), lambda c, k: xor(c >> 1, (c & 1) * 3988292384), xor(a, ord(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
    4294967295::BIGINT) & 1 AS low FROM documents),
enc AS (SELECT d.*, coalesce(strlen(d.doc_id::VARCHAR) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    replace(text, chr(10), '') AS cut, coalesce(b.low = 1, false) AS hit FROM documents d LEFT JOIN bits b ON b.doc_id = d.doc_id),
l AS (SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN hit THEN sha256(head || coalesce(strlen(cut) || ':' || cut, '-')) ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS seen FROM enc),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM l),
lv AS (
  SELECT source, 0 AS lev, i, leaf AS h FROM r
  UNION ALL
  SELECT source, lev + 1, i // 3, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY source) AS c FROM lv) WHERE c > 1 GROUP BY source, lev, i // 3),
top AS (SELECT source, lev AS height, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place
  FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY lev DESC) AS k FROM lv) WHERE k = 1),
tv AS (
  SELECT 0 AS lev, place AS i, subroot AS h FROM top
  UNION ALL
  SELECT lev + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, count(*) OVER () AS c FROM tv) WHERE c > 1 GROUP BY lev, i // 3),
apex AS (SELECT max(lev) AS height, arg_max(h, lev) AS root FROM tv),
sib AS (SELECT source, lev, i,
    coalesce(string_agg(h, '') OVER (PARTITION BY source, lev, i // 3 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
    coalesce(string_agg(h, '') OVER (PARTITION BY source, lev, i // 3 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt FROM lv),
tsib AS (SELECT lev, i,
    coalesce(string_agg(h, '') OVER (PARTITION BY lev, i // 3 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
    coalesce(string_agg(h, '') OVER (PARTITION BY lev, i // 3 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt FROM tv),
steps AS (
  SELECT r.source, r.i, s.lev, s.lft, s.rgt FROM r JOIN top t ON t.source IS NOT DISTINCT FROM r.source
    JOIN sib s ON s.source IS NOT DISTINCT FROM r.source AND s.lev < t.height AND s.i = r.i // (3 ** s.lev)::BIGINT
  UNION ALL
  SELECT r.source, r.i, t.height + s.lev, s.lft, s.rgt FROM r JOIN top t ON t.source IS NOT DISTINCT FROM r.source CROSS JOIN apex a
    JOIN tsib s ON s.lev < a.height AND s.i = t.place // (3 ** s.lev)::BIGINT),
paths AS (SELECT source, i, list(lft || '|' || rgt ORDER BY lev) AS p, string_agg(lft || rgt, '' ORDER BY lev) AS flat FROM steps GROUP BY source, i),
f AS (SELECT r.doc_id, r.leaf, t.subroot, a.root, sha256(coalesce(p.flat, '')) AS proof_sha256, r.source,
    list_reduce(coalesce(p.p, []), lambda h, x: sha256(split_part(x, '|', 1) || h || split_part(x, '|', 2)), r.seen) AS folded_root
  FROM r JOIN top t ON t.source IS NOT DISTINCT FROM r.source CROSS JOIN apex a
    LEFT JOIN paths p ON p.source IS NOT DISTINCT FROM r.source AND p.i = r.i)
SELECT *, folded_root = root AS verified FROM f"""
