r"""Secret scan with multipart credential linking.

Base spans (assignments, access keys, long hex runs) are reported as they are.
Parts that prove nothing alone, the weak candidates, are

* identifiers: ``client_id = ...``, ``user: ...``, short access-key prefixes;
* secrets: unassigned tokens of 16 or more characters with an upper-case
  letter, a lower-case letter and a digit;
* endpoints: connection URLs and ``host = ...``.

Parts are joined by interval: two parts are in one scope when they are in the
same row and start at most SCOPE code points apart.  A weak secret is reported
when an identifier or endpoint is in its scope, a weak identifier when a secret
is, and an endpoint when an identifier and a secret are.  Base access keys
count as identifiers, base assignments and hex runs as secrets.

The join is by bins of SCOPE code points: a part can only meet parts of its
own bin (always in scope) and of the two neighbours, of which the nearest is
the largest start before or the smallest after.  So each bin needs only the
first and last start per part type, combined map-side, and no pairs are built.

Defined results: null and empty texts have no spans; equal rows get equal
spans; base spans never change; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import stage
from tickwise.llm.spans import SPAN, digest, joined, spans

# The three base patterns.  A hex run of 24 or more and an
# access key of 20 or more are what is left of all runs after the length rule.
ASSIGN_HEAD = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ASSIGN = ASSIGN_HEAD + r"[A-Za-z0-9+/_.=-]+"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?:\G|(?<![0-9a-f]))[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex")

WEAK_ID = (r"""(?i:\b(?:access|account|client|user|login)[_-]?(?:key[_-]?)?(?:id|name)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{4,}"""
           r"|\bA(?:KIA|SIA)[A-Z0-9]{4,15}\b")
WEAK_SECRET = (r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[a-z0-9+/_-]*+[A-Z])"
               r"(?=[A-Z0-9+/_-]*+[a-z])[A-Za-z0-9+/_-]{16,}")
ENDPOINT = (r"""(?i:https?|s3|postgres(?:ql)?|mysql|mongodb|redis|amqps?)://[^\x20\x09-\x0D"'<>]+"""
            r"""|(?i:\b(?:host|endpoint|server))["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{4,}(?::[0-9]+)?""")

#: Largest distance in code points between the starts of parts of one credential.
SCOPE = 256

ENTRY = "array<struct<start:int,rank:int,end:int,kind:string>>"


def _entries(found: Column, kind: str, rank: int) -> Column:
    return F.transform(F.coalesce(found, F.array().cast(SPAN)), lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def parts(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, row, base entries and weak entries outside them."""
    text = F.col("text")
    value = lambda v: F.length(F.regexp_replace(v, "^" + ASSIGN_HEAD, "")) >= 6
    base = F.concat(_entries(spans(text, ASSIGN, value), "assign", 0),
                    _entries(F.when(text.contains("AKIA"), spans(text, ACCESS)), "access", 1),
                    _entries(spans(text, HEX), "hex", 2))
    weak = F.concat(_entries(spans(text, WEAK_ID), "weak_id", 3), _entries(spans(text, WEAK_SECRET), "weak_secret", 4),
                    _entries(spans(text, ENDPOINT), "endpoint", 5))
    both = docs.select("doc_id", F.xxhash64("text").alias("row"), F.array_sort(base.cast(ENTRY)).alias("base"), weak.cast(ENTRY).alias("weak"))
    outside = F.filter("weak", lambda w: ~F.exists("base", lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))
    return both.withColumn("weak", outside)


def _type(kind: Column) -> Column:
    return (F.when(kind.isin("access", "weak_id"), "id").when(kind == "endpoint", "endpoint").otherwise("secret"))


def linked(occ: DataFrame) -> DataFrame:
    """(doc_id, row, found): the weak entries whose complementary parts are in scope."""
    bin_of = lambda s: F.floor(s / SCOPE)
    points = occ.where(F.size("weak") > 0).select("doc_id", "row", F.explode(F.concat("base", "weak")).alias("p"))
    bins = points.groupBy("doc_id", "row", bin_of(F.col("p.start")).alias("bin"), _type(F.col("p.kind")).alias("type")).agg(
        F.min("p.start").alias("lo"), F.max("p.start").alias("hi"))
    near = bins.select("doc_id", "row", "type", F.inline(F.array(
        F.struct((F.col("bin") + 1).alias("bin"), F.col("hi").alias("before"), F.lit(False).alias("own"), F.lit(None).cast("int").alias("after")),
        F.struct(F.col("bin").alias("bin"), F.lit(None).cast("int").alias("before"), F.lit(True).alias("own"), F.lit(None).cast("int").alias("after")),
        F.struct((F.col("bin") - 1).alias("bin"), F.lit(None).cast("int").alias("before"), F.lit(False).alias("own"), F.col("lo").alias("after")))))
    types = ("id", "secret", "endpoint")
    reach = near.groupBy("doc_id", "row", "bin").agg(*[
        f(F.when(F.col("type") == t, F.col(c))).alias(f"{t}_{c}") for t in types for c, f in (("before", F.max), ("own", F.max), ("after", F.min))])
    r = reach.select(F.col("doc_id").alias("_doc"), F.col("row").alias("_row"), F.col("bin").alias("_bin"), *[c for c in reach.columns if c not in ("doc_id", "row", "bin")])
    cand = occ.select("doc_id", "row", F.explode("weak").alias("w")).withColumn("bin", bin_of(F.col("w.start")))
    met = cand.join(r, cand["doc_id"].eqNullSafe(r["_doc"]) & (cand["row"] == r["_row"]) & (cand["bin"] == r["_bin"]))
    has = {}
    for t in types:  # null distances must not hide a true part
        has[t] = (F.coalesce(F.col(f"{t}_own"), F.lit(False)) | F.coalesce(F.col("w.start") - F.col(f"{t}_before") <= SCOPE, F.lit(False))
                  | F.coalesce(F.col(f"{t}_after") - F.col("w.start") <= SCOPE, F.lit(False)))
    kind = F.col("w.kind")
    ok = (F.when(kind == "weak_secret", has["id"] | has["endpoint"]).when(kind == "weak_id", has["secret"]).otherwise(has["id"] & has["secret"]))
    return met.where(ok).groupBy("doc_id", "row").agg(F.collect_set("w").alias("found"))


def find(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, base and found entries (start, rank, end, kind), each in order."""
    occ = stage(parts(docs), "secret-parts")
    f = linked(occ).select(F.col("doc_id").alias("_doc"), F.col("row").alias("_row"), "found")
    return (occ.join(f, occ["doc_id"].eqNullSafe(f["_doc"]) & (occ["row"] == f["_row"]), "left")
            .select("doc_id", "base", F.coalesce("found", F.array().cast(ENTRY)).alias("found")))


def report(docs: DataFrame) -> DataFrame:
    """Counts and digests of the spans per document."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return find(docs).select("doc_id", *[count(k) for k in KINDS], digest(joined(F.col("base"))).alias("base_sha256"),
                             joined(F.array_sort(F.concat("base", "found"))).alias("spans"), F.size("found").cast("long").alias("n_linked"))
