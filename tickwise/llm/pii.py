r"""PII by bootstrapped contextual extraction.

1. Seed entities: the four base kinds, found by fixed patterns with checks
   (IP parts, Luhn, digit counts).
2. Occurrences: the seeds and every identifier-shaped token (a white-space run
   with a digit or an @; a ``name:`` or ``name=`` in front is context) are
   instances in a context: the one and two words before and after, lower-cased,
   digits masked.
3. Patterns are (side and width, context words, coarse class of the instance:
   with an @ or with digits only); the shape of an instance takes no part, so a
   context carries trust to identifiers unlike any seed.  Spark scores the graph
   of patterns and instances in rounds until no new instance is trusted: a
   pattern's confidence is the share of its distinct instances that are trusted,
   weighted by how far they are trusted, and it needs MIN_SUPPORT trusted
   instances; an instance is trusted by 1 - prod(1 - confidence) over its
   patterns if at least OWN_SHARE of its occurrences stand in such patterns on
   one side, seeds by 1.  Trust only grows, so the rounds end.
4. Tokens of trusted instances that overlap no base span are added as kind
   ``id``.

Edges are distinct (pattern, instance) pairs, counted before every join, so
a context word that occurs everywhere is combined map-side.  All is DataFrame
work; no text leaves its row.

Defined results: null and empty texts have no spans; equal rows get equal
spans; base spans never change; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import field, let, packed, stage
from tickwise.llm.spans import SPAN, digest, joined, spans

# The four base patterns.  Runs are entered only at their start
# (or where the last match ended), which finds the same spans in linear time.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
IP_OK = rf"^{_PART}(?:\.{_PART}){{3}}$"

#: The confidence a pattern or instance needs, the trusted instances a pattern needs, and the share of an instance's occurrences in such patterns.
CONFIDENCE = 0.8
MIN_SUPPORT = 5
OWN_SHARE = 0.5


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of a string pass the Luhn check."""
    def total(ds: Column) -> Column:
        def weigh(c: Column, i: Column) -> Column:
            d = c.cast("int")
            twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
            return F.when((F.size(ds) - i) % 2 == 0, twice).otherwise(d)
        return F.aggregate(F.transform(ds, weigh), F.lit(0), lambda a, x: a + x)
    return let(F.split(_digits(value), ""), total) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """Per kind the checked spans (start, end, value) of a text."""
    n = lambda v: F.length(_digits(v))
    return {
        "email": F.when(text.contains("@"), spans(text, EMAIL)),
        "ip": spans(text, IP, lambda v: v.rlike(IP_OK)),
        "card": spans(text, CARD, lambda v: F.when(n(v).between(13, 19), luhn(v)).otherwise(False)),
        "phone": F.when(text.contains("+"), spans(text, PHONE, lambda v: n(v).between(9, 15))),
    }


ENTRY = "array<struct<start:int,end:int,kind:string,value:string>>"
MARK = "array<struct<start:int,end:int,kind:string,value:string,before:array<string>,after:array<string>>>"
#: An identifier-shaped token.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
#: What is not part of an identifier at a token's start and end, and of a context word.
LEAD = r"^(?:[^0-9@]*[:=])?[^\p{L}\p{N}+(@]*"
TAIL = r"[^\p{L}\p{N})]+$"
EDGE = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"
#: Characters on each side in which context words are looked for, and the sides and widths of patterns.
REACH = 64
SIDES = [(side, n) for side in ("before", "after") for n in (1, 2)]


def _entries(found: Column, kind: str) -> Column:
    return F.transform(F.coalesce(found, F.array().cast(SPAN)), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["value"].alias("value")))


def occurrences(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, row (hash of the text), marks: base entries and (kind id) other tokens, with their contexts."""
    text = F.col("text")
    entries = F.concat(*[_entries(c, k) for k, c in base_spans(text).items()]).cast(ENTRY)

    def core(s: Column) -> Column:
        lead = F.length(s["value"]) - F.length(F.regexp_replace(s["value"], LEAD, ""))
        value = F.regexp_replace(F.regexp_replace(s["value"], LEAD, ""), TAIL, "")
        return F.struct((s["start"] + lead).alias("start"), (s["start"] + lead + F.length(value)).alias("end"), F.lit("id").alias("kind"), value.alias("value"))

    def words(piece: Column) -> Column:
        return F.filter(F.transform(F.split(piece, r"[\x20\x09-\x0D]+"), lambda w: F.lower(
            F.regexp_replace(F.regexp_replace(w, EDGE, ""), "[0-9]", "9"))), lambda w: w != "")

    def context(s: Column) -> Column:
        # a character more tells whether the last word is cut; a cut word would differ from case to case and is no context
        left = F.substring(text, F.greatest(s["start"] - REACH - 1, F.lit(0)) + 1, F.least(s["start"], F.lit(REACH + 1)))
        right = F.substring(text, s["end"] + 1, F.lit(REACH + 1))
        before = words(F.when(s["start"] > REACH, F.regexp_replace(left, r"^[^\x20\x09-\x0D]++", "")).otherwise(left))
        after = words(F.when(F.length(right) > REACH, F.regexp_replace(right, r"[^\x20\x09-\x0D]++$", "")).otherwise(right))
        return F.struct(*[s[c].alias(c) for c in ("start", "end", "kind", "value")],
                        F.slice(F.reverse(before), 1, 2).alias("before"), F.slice(after, 1, 2).alias("after"))

    def marks(base: Column) -> Column:
        free = F.filter(spans(text, TOKEN), lambda t: ~F.exists(base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
        tokens = F.filter(F.transform(free, core), lambda t: F.length(t["value"]) > 0)
        return F.transform(F.concat(base, tokens.cast(ENTRY)), context)
    return docs.select("doc_id", F.xxhash64("text").alias("row"), let(entries, marks).cast(MARK).alias("marks"))


def trusted_instances(occ: DataFrame) -> DataFrame:
    """(value) of identifier tokens that are not seeds and that high-confidence patterns vouch for."""
    flat = occ.select(F.explode("marks").alias("m")).select("m.value", (F.col("m.kind") != "id").alias("seed"), "m.before", "m.after")
    sort = F.when(F.col("value").contains("@"), "@").otherwise("9")
    contexts = F.array(*[F.when(F.size(side) >= n, F.struct(
        F.lit(f"{side}{n}").alias("side"), F.concat_ws("\t", F.lit(f"{side}{n}"), sort, F.slice(side, 1, n)).alias("pattern"))) for side, n in SIDES])
    edges = flat.select("value", "seed", F.explode(F.filter(contexts, lambda c: c.isNotNull())).alias("c")).select("value", "seed", "c.side", "c.pattern")
    edges = stage(edges.groupBy("pattern", "side", "value").agg(F.max("seed").alias("seed"), F.count("*").alias("n")), "pii-graph")

    trust = stage(edges.groupBy("value").agg(F.max("seed").alias("seed")).select("value", F.col("seed").cast("double").alias("trust"), "seed"), "pii-seeds")
    known = 0
    while True:
        scored = edges.select("pattern", "value").join(trust.select("value", "trust"), "value").groupBy("pattern").agg(
            F.avg("trust").alias("confidence"), F.sum("trust").alias("support"))
        good = stage(scored.where((F.col("confidence") >= CONFIDENCE) & (F.col("support") >= MIN_SUPPORT)).select("pattern", "confidence"), "pii-patterns")
        # the logarithm keeps the product a sum; a pattern never counts as certain
        share = F.greatest(*[F.sum(F.when((F.col("side") == f"{s}{n}") & F.col("confidence").isNotNull(), F.col("n")))
                             / F.sum(F.when(F.col("side") == f"{s}{n}", F.col("n"))) for s, n in SIDES])
        vouched = edges.join(good, "pattern", "left").groupBy("value").agg(
            F.max("seed").alias("seed"), (1 - F.exp(F.sum(F.log(1 - F.least("confidence", F.lit(0.99)))))).alias("vouched"), share.alias("share"))
        trust = stage(vouched.select("value", F.when(F.col("seed"), 1.0).when(F.col("share") >= OWN_SHARE, F.col("vouched")).otherwise(0.0).alias("trust"),
                                     "seed"), "pii-trust")
        found = trust.where(~F.col("seed") & (F.col("trust") >= CONFIDENCE)).select("value")
        now = found.count()
        if now == known:
            return found
        known = now


def find(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, row, base and found (arrays of start, end, kind, value)."""
    occ = stage(occurrences(docs), "pii-occurrences")
    known = trusted_instances(occ).withColumnRenamed("value", "_value")
    tok = occ.select("doc_id", "row", F.explode(F.filter("marks", lambda m: m["kind"] == "id")).alias("t"))
    extra = tok.join(known, F.col("t.value") == F.col("_value"), "left_semi").groupBy("doc_id", "row").agg(
        F.array_sort(F.collect_set(F.struct(F.col("t.start").alias("start"), F.col("t.end").alias("end"), F.lit("id").alias("kind"), F.col("t.value").alias("value")))).alias("found"))
    e = extra.select(F.col("doc_id").alias("_doc"), F.col("row").alias("_row"), "found")
    base = F.transform(F.filter("marks", lambda m: m["kind"] != "id"), lambda m: F.struct(*[m[c].alias(c) for c in ("start", "end", "kind", "value")]))
    return (occ.select("doc_id", "row", base.alias("base")).join(e, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("row") == F.col("_row")), "left")
            .select("doc_id", "row", "base", F.coalesce("found", F.array().cast(ENTRY)).alias("found")))


def report(docs: DataFrame) -> DataFrame:
    """Counts and digests of the spans per document."""
    found = find(docs)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in KINDS], digest(joined(F.col("base"))).alias("base_sha256"),
                        joined(F.concat("base", "found")).alias("spans"), F.size("found").cast("long").alias("n_id"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by [KIND] and ``n_chars`` recomputed; overlapping spans are merged, first kind wins."""
    found = find(docs).where(F.size("base") + F.size("found") > 0).dropDuplicates(["doc_id", "row"])
    f = found.select(F.col("doc_id").alias("_doc"), F.col("row").alias("_row"), F.array_sort(F.concat("base", "found")).alias("_all"))
    d = packed(docs).withColumn("_hash", F.xxhash64(field("text")))
    rows = d.join(f, field("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_hash") == F.col("_row")), "left").withColumn("_text", field("text"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    def step(acc: Column, s: Column) -> Column:  # noqa: E306
        fresh = s["start"] >= acc["at"]
        piece = F.concat(acc["out"], F.substring(F.col("_text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(s["end"], acc["at"]).alias("at"), F.when(fresh, piece).otherwise(acc["out"]).alias("out"))
    merged = F.aggregate("_all", start, step, lambda acc: F.concat(acc["out"], F.substring(F.col("_text"), acc["at"] + 1, F.length("_text"))))
    text = F.when(F.col("_all").isNull(), F.col("_text")).otherwise(merged)
    out = rows.withColumn("_text", text)

    def column(c: str) -> Column:
        if c == "text":
            return F.col("_text")
        if c == "n_chars":
            return F.when(F.col("_all").isNull(), field(c)).otherwise(F.length("_text").cast(docs.schema[c].dataType))
        return field(c)
    return out.select(*[column(c).alias(c) for c in docs.columns])
