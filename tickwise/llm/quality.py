r"""Quality classifier: a sparse rule ensemble.

1. Statistics of the whole text, as native columns.
2. A random forest of shallow trees on labelled rows; every path from a root
   to a node is a conjunctive rule ``statistic <= t AND ...``.
3. Lasso logistic regression over the rules (0/1) and the statistics clipped
   to their 1 % and 99 % points: most weights become zero.
4. The rest is compiled into one Spark column expression, which scores every
   document without a model object or a Python function.

Learning uses labelled documents whose crc32(doc_id as text) mod 5 is not 0,
at most about MAX_TRAIN rows drawn by a hash of doc_id (the fit is the only
bounded step).  doc_id, lang, source and the labels are no inputs of a score.

Defined results: null and blank texts have statistics 0 and get the score of
such a text; a document with several labels counts each; without labels of
both kinds the score is the share of good labels (1 if there are none); extra
columns are not read.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import field, held_out, let, packed, small_side, stage, words

MAX_TRAIN = 40_000
TREES = 24
DEPTH = 3
LASSO = 0.002
THRESHOLD = 0.3
SEED = 5

#: Statistic -> (pattern counted, what the count is divided by).
COUNTED = {
    "upper": (r"\p{Lu}", "n_chars"),
    "digits": (r"\p{N}", "n_chars"),
    "symbols": (r"[^\p{L}\p{N}\x20\x09-\x0D]", "n_chars"),
    "symbol_runs": (r"[^\p{L}\p{N}\x20\x09-\x0D]{2,}", "n_words"),
    "bare_symbols": (r"(?<![^\x20\x09-\x0D])[^\p{L}\p{N}\x20\x09-\x0D]+(?![^\x20\x09-\x0D])", "n_words"),
    "sentence_ends": (r"[.?!](?![^\x20\x09-\x0D])", "n_words"),
}
STATISTICS = ["log_chars", "log_words", "word_length", "distinct", "repeats", "line_words", "distinct_lines", *COUNTED]


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, row (hash of the text) and the statistics of every whole text."""
    text = F.coalesce("text", F.lit(""))

    def of_words(ws: Column) -> Column:
        same = F.aggregate(F.zip_with(ws, F.slice(ws, F.lit(2), F.size(ws)), lambda a, b: F.coalesce(a == b, F.lit(False)).cast("int")), F.lit(0), lambda s, x: s + x)
        return F.struct(F.size(ws).alias("n"), F.size(F.array_distinct(ws)).alias("distinct"), F.when(F.size(ws) > 1, same).otherwise(0).alias("same"))

    lines = let(F.filter(F.split(text, "\n"), lambda x: x != ""), lambda ls: F.struct(F.size(ls).alias("n"), F.size(F.array_distinct(ls)).alias("distinct")))
    counts = [F.regexp_count(text, F.lit(p)).alias(k) for k, (p, _) in COUNTED.items()]
    raw = docs.select("doc_id", F.xxhash64("text").alias("row"), F.length(text).alias("n_chars"), let(words(text), of_words).alias("w"), lines.alias("l"), *counts)
    by = {"n_chars": F.col("n_chars"), "n_words": F.col("w.n")}
    return raw.select(
        "doc_id", "row", F.log1p("n_chars").alias("log_chars"), F.log1p("w.n").alias("log_words"), _ratio(F.col("n_chars"), F.col("w.n")).alias("word_length"),
        _ratio(F.col("w.distinct"), F.col("w.n")).alias("distinct"), _ratio(F.col("w.same"), F.col("w.n")).alias("repeats"),
        _ratio(F.col("w.n"), F.col("l.n")).alias("line_words"), _ratio(F.col("l.distinct"), F.col("l.n")).alias("distinct_lines"),
        *[_ratio(F.col(k), by[b]).alias(k) for k, (_, b) in COUNTED.items()])


def tree_rules(forest) -> list[tuple[tuple[int, str, float], ...]]:
    """Distinct root-to-node paths of all trees, each a sorted tuple of (statistic, comparison, threshold)."""
    rules, branch = set(), re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)")
    for tree in forest.trees:
        path: list = []
        for line in tree.toDebugString.splitlines():
            if m := branch.match(line):
                path = [p for p in path if p[0] < len(m[1])] + [(len(m[1]), int(m[2]), m[3], float(m[4]))]
                tight: dict = {}
                for _, f, op, t in path:  # several bounds on one statistic: the tightest
                    old = tight.get((f, op))
                    tight[f, op] = t if old is None else min(old, t) if op == "<=" else max(old, t)
                rules.add(tuple(sorted((f, op, t) for (f, op), t in tight.items())))
    return sorted(rules)


def rule_column(rule: tuple[tuple[int, str, float], ...]) -> Column:
    cond = F.lit(True)
    for f, op, t in rule:
        cond = cond & (F.col(STATISTICS[f]) <= t if op == "<=" else F.col(STATISTICS[f]) > t)
    return cond.cast("double")


def training_rows(stats: DataFrame, labels: DataFrame, max_train: int) -> DataFrame:
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("_id"), F.col("quality").cast("double").alias("label"))
    share = min(1.0, max_train / max(1, known.count()))
    draw = F.pmod(F.xxhash64(F.lit("learn"), "_id"), F.lit(1 << 20)) / float(1 << 20)
    return stats.join(small_side(known.where(draw < share), 24), F.col("doc_id") == F.col("_id")).select("label", *STATISTICS)


def fit(stats: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Column:
    """The score as a column over the statistics."""
    rows = stage(training_rows(stats, labels, max_train), "quality-train")
    n, good = rows.agg(F.count("*"), F.sum("label")).first()
    if not n or good in (0, n):
        return F.lit(float(good / n) if n else 1.0)
    vectors = VectorAssembler(inputCols=STATISTICS, outputCol="x").transform(rows)
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="onethird",
                                    minInstancesPerNode=5, subsamplingRate=0.7, seed=SEED).fit(vectors)
    rules = tree_rules(forest)
    bounds = rows.approxQuantile(STATISTICS, [0.01, 0.99], 0.002)
    linear = [F.least(F.greatest(F.col(s), F.lit(lo)), F.lit(hi)) for s, (lo, hi) in zip(STATISTICS, bounds)]
    terms = [rule_column(r) for r in rules] + linear
    design = stage(rows.select("label", F.array(*terms).alias("terms")), "quality-design").select("label", array_to_vector("terms").alias("z"))
    lasso = LogisticRegression(featuresCol="z", labelCol="label", elasticNetParam=1.0, regParam=LASSO, maxIter=60, tol=1e-5).fit(design)
    score = F.lit(float(lasso.intercept))
    for w, term in zip(lasso.coefficients.toArray().tolist(), terms):
        if w:
            score = score + F.lit(w) * term
    return 1 / (1 + F.exp(-score))


def verdicts(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, row, held_out, score, predicted."""
    stats = stage(statistics(docs), "quality-stats")
    score = fit(stats, labels, max_train)
    scored = stats.select("doc_id", "row", held_out(F.col("doc_id")).alias("held_out"), score.cast("double").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    return verdicts(docs, labels, max_train, threshold).drop("row")


def accept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the classifier rejects, each by its own text, also where rows share a doc_id."""
    rejected = verdicts(docs, labels).where("predicted = 0").select(F.col("doc_id").alias("_out"), F.col("row").alias("_row")).distinct()
    out = stage(rejected, "quality-rejected")
    same = field("doc_id").eqNullSafe(F.col("_out")) & (F.xxhash64(field("text")) == F.col("_row"))
    return packed(docs).join(small_side(out, 32), same, "left_anti").select("_d.*")
