"""Language identification with hyperdimensional profiles.

Every letter of any script (and the word border) has a random vector of DIM
signs, drawn by a seeded hash of its code point.  A
letter trigram is bound into one vector: the first letter's vector rotated
twice, the second's rotated once and the third's, multiplied.  A text is the
bundle (sum) of its trigram vectors; a language's prototype is the bundle of
its learning texts.  The prediction is the prototype with the largest cosine.

Counts commute with bundling, so tasks count the distinct trigrams of a batch
and multiply the counts with the trigram vectors; prototypes come from trigram
counts summed by Spark (one row per language and distinct trigram).

Learning uses documents with a language whose crc32(doc_id as text) mod 5 is
not 0, at most about PER_LANGUAGE of each language, taken by a hash of doc_id
(the fit is the only bounded step; every document is predicted from its whole
text).  doc_id, lang and source are no inputs of a prediction.

Defined results: a null text or one without a letter is ``und`` with score 0;
so is every text when no document could be learned from; ties go to the first
language by name; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import held_out, stage
from tickwise.session import ship_package

DIM = 1024
PER_LANGUAGE = 5000
#: A letter's code is its code point, the word border's is 0; a trigram's code is three of them in 63 bits.
BITS = 21
SEED = 11
#: Characters, and texts, handled at once.
CHUNK = 2_000_000
CHUNK_TEXTS = 1_000
UNKNOWN = "und"


def letter_vectors(letters: np.ndarray) -> np.ndarray:
    """DIM signs (rows) of each letter: the bits of a seeded hash of its code point."""
    with np.errstate(over="ignore"):
        x = letters.astype(np.uint64)[:, None] * np.uint64(DIM // 64) + np.arange(DIM // 64, dtype=np.uint64)
        x = (x + np.uint64(SEED)) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    return np.unpackbits(x.astype("<u8").view(np.uint8), axis=1).astype(np.int8) * 2 - 1


def trigram_vectors(codes: np.ndarray) -> np.ndarray:
    """Bound vectors (rows) of trigram codes."""
    mask = (1 << BITS) - 1
    letters, at = np.unique(np.concatenate([codes >> 2 * BITS, codes >> BITS & mask, codes & mask]), return_inverse=True)
    v, (a, b, c) = letter_vectors(letters), at.reshape(3, -1)
    return (np.roll(v, 2, axis=1)[a] * np.roll(v, 1, axis=1)[b] * v[c]).astype(np.float32)


class LetterCodes:
    """Code point -> letter code; 0 for anything that is no letter."""

    def __init__(self) -> None:
        self.letter = np.fromiter((chr(cp).isalpha() for cp in range(0x110000)), bool, 0x110000)

    def of(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Letter codes of lower-cased texts, one border after each text, with the index of each code's text."""
        parts = [np.frombuffer(((t or "").lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
        cp, owner = np.concatenate(parts), np.repeat(np.arange(len(texts)), [len(p) for p in parts])
        code = np.where(self.letter[cp], cp, 0)
        border = code == 0
        keep = ~(border & np.concatenate([[True], border[:-1]]))  # runs of borders become one
        return code[keep], owner[keep]


def trigram_counts(texts: list, letters: LetterCodes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct trigram codes, then per text and trigram: text index, place in the codes, count); no trigram
    spans a border, but it may start or end there."""
    code, owner = letters.of(texts)
    code, owner = np.concatenate([[0], code]).astype(np.int64), np.concatenate([[0], owner])
    if len(code) < 3:
        return (np.empty(0, np.int64),) * 4
    inner = code[1:-1] != 0
    codes, at = np.unique((code[:-2] << 2 * BITS | code[1:-1] << BITS | code[2:])[inner], return_inverse=True)
    width = max(1, len(codes))
    key, n = np.unique(owner[1:-1][inner] * width + at, return_counts=True)
    return codes, key // width, key % width, n


def _chunks(texts: list) -> Iterator[tuple[int, list]]:
    first, total = 0, 0
    for i, t in enumerate(texts):
        total += len(t or "")
        if total >= CHUNK or i + 1 - first >= CHUNK_TEXTS:
            yield first, texts[first:i + 1]
            first, total = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters = LetterCodes()
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for first, texts in _chunks(batch.column("text").to_pylist()):
            names = sorted(set(langs[first:first + len(texts)]))
            which = np.array([names.index(x) for x in langs[first:first + len(texts)]], np.int64)
            codes, owner, at, n = trigram_counts(texts, letters)
            width = max(1, len(codes))
            key, back = np.unique(which[owner] * width + at, return_inverse=True)
            total = np.bincount(back, weights=n, minlength=len(key)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(names).take(pa.array(key // width)), pa.array(codes[key % width]), pa.array(total)],
                                             names=["lang", "code", "n"])


def _bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial prototypes of a task's trigram counts: one vector per language."""
    sums = {}
    for batch in batches:
        langs, code = np.array(batch.column("lang").to_pylist(), object), batch.column("code").to_numpy()
        n = batch.column("n").to_numpy().astype(np.float64)
        for lang in set(langs.tolist()):
            at = np.flatnonzero(langs == lang)
            for lo in range(0, len(at), 4096):
                part = at[lo:lo + 4096]
                sums[lang] = sums.get(lang, 0) + n[part] @ trigram_vectors(code[part])
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], names=["lang", "v"])


def prototypes(docs: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages by name and their unit prototypes (rows)."""
    ship_package(docs.sparkSession)
    learn = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    share = F.lit(float(per_language)) / F.count("*")
    shares = F.broadcast(learn.groupBy("lang").agg(share.alias("share")))  # one row a language
    draw = F.pmod(F.xxhash64(F.lit("learn"), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    sample = learn.join(shares, "lang").where(draw < F.col("share")).select("lang", "text")
    counts = stage(sample.mapInArrow(_count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")), "lang-counts")
    partial = counts.mapInArrow(_bundle, "lang string, v array<double>").select("lang", F.posexplode("v").alias("i", "x"))
    rows = partial.groupBy("lang", "i").agg(F.sum("x").alias("x")).groupBy("lang").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda e: e["x"]).alias("v")).orderBy("lang").collect()
    names = [r["lang"] for r in rows]
    p = np.array([r["v"] for r in rows], np.float64).reshape(len(rows), DIM)
    return names, p / np.maximum(np.linalg.norm(p, axis=1, keepdims=True), 1e-12)


def text_vectors(texts: list, letters: LetterCodes) -> np.ndarray:
    """The bundle of each text (rows); zero for a text without letters."""
    codes, owner, at, n = trigram_counts(texts, letters)
    out = np.zeros((len(texts), DIM), np.float32)
    for lo in range(0, len(codes), 8192):
        part = (at >= lo) & (at < lo + 8192)
        width = min(8192, len(codes) - lo)
        dense = np.zeros((len(texts), width), np.float32)
        dense[owner[part], at[part] - lo] = n[part]
        out += dense @ trigram_vectors(codes[lo:lo + width])
    return out


def predict(docs: DataFrame, names: list[str], protos: np.ndarray) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""
    model = protos.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = LetterCodes()
        for batch in batches:
            ids = batch.column("doc_id")
            for first, texts in _chunks(batch.column("text").to_pylist()):
                v = text_vectors(texts, letters)
                size = np.linalg.norm(v, axis=1)
                cosine = (v @ model.T) / np.maximum(size, 1e-12)[:, None] if names else np.zeros((len(texts), 1))
                best = cosine.argmax(axis=1)
                known = np.array([bool(names) and s > 0 for s in size])
                score = np.where(known, np.clip(cosine.max(axis=1), 0, 1), 0.0).astype(np.float64)
                lang = [names[b] if k else UNKNOWN for b, k in zip(best, known)]
                yield pa.RecordBatch.from_arrays([ids.slice(first, len(texts)), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def identify(docs: DataFrame) -> DataFrame:
    """Fit the prototypes and predict every document."""
    return predict(docs, *prototypes(docs))
