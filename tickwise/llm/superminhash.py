"""Near-duplicates on word shingles by SuperMinHash.

A document's set is its distinct three-word shingles (A-Z lower-cased, words
split at white space; fewer words make one shingle of all of them).  Documents
with Jaccard similarity of 0.85 or more are linked; components get one keeper.

1. Sets and signatures, in one pass over the texts.  SuperMinHash visits the
   shingles of a set round by round: in round j every shingle draws a value in
   [j, j+1) for the j-th place of its own random permutation of the SLOTS
   positions, and each position keeps its minimum.  A set stops at the first
   round after which all positions are filled, since later rounds only bring
   larger values.  Equal positions estimate the similarity with less variance
   than independent hashes.
2. Equal sets are combined into classes (map-side) before anything else, so a
   group of copies of any size is one node.
3. Banding: classes that share a band of ROWS positions are joined to the
   smallest class of that bucket (a star, linear in the bucket) and connected
   components over those stars give candidate groups.  A pair with similarity
   0.85 shares none of the 21 bands with probability 5e-5 at most.
4. Verification: the full sets of each candidate group meet in one task (an
   inverted index counts intersections), which returns a spanning forest of
   the true links.  Groups over BLOCK shingles are split into blocks and every
   pair of blocks is one task, so memory stays bounded and no link is lost.
5. The forests are joined by connected components and each document gets the
   smallest doc_id of its component.

64-bit shingle hashes stand for shingles and 128-bit fingerprints for sets.

Defined results: null and blank texts have an empty set and are linked with
nothing; null ids never become a component's name unless all its ids are
null; rows sharing a doc_id but not a text are separate nodes; extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import connected_components, field, packed, small_side, stage
from tickwise.session import ship_package

WIDTH = 3
SLOTS = 126
ROWS = 6
#: Similarity of 0.85 as a fraction, compared in integers.
LINK = (85, 100)
#: Shingles of one verification block (16 MB of hashes).
BLOCK = 2_000_000
#: Shingles handled at once while signing, and words remembered with their hash.
CHUNK = 1_000_000
REMEMBER = 1_000_000

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_ODD = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]
_MASK = 0xFFFFFFFFFFFFFFFF
_EMPTY = np.uint64(_MASK)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Hash of each word, remembered."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingle_set(text: str | None, known: WordHashes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; bytes.lower() and bytes.split() are the word rule."""
    ws = (text or "").encode().lower().split()
    if not ws:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws))
    k = min(width, len(h))
    x = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        x += h[i:len(h) - k + 1 + i] * _ODD[i]
    return np.unique(mixed(x))


def superminhash(flat: np.ndarray, sizes: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Signatures (sets x slots) of the sets laid end to end in ``flat``; empty sets keep the empty mark."""
    n = len(sizes)
    sig = np.full(n * slots, _EMPTY, np.uint64)
    owner = np.repeat(np.arange(n), sizes)
    elems, perm = flat, None
    for j in range(slots):
        r = mixed(elems + np.uint64(int(_GOLD) * (j + 1) & _MASK))
        low = r & np.uint64(0xFFFFFFFF)
        place = j + ((low * np.uint64(slots - j)) >> np.uint64(32)).astype(np.int64)
        if perm is None:
            pos = place
        else:
            rows = np.arange(len(elems))
            pos = perm[rows, place].astype(np.int64)
            perm[rows, place] = perm[:, j]
        np.minimum.at(sig, owner * slots + pos, (np.uint64(j) << np.uint64(32)) | (r >> np.uint64(32)))
        open_sets = (sig.reshape(n, slots) == _EMPTY).any(axis=1)
        active = open_sets[owner]
        if not active.any():
            break
        if perm is None:
            # round 0 swapped place 0 with `place`; later rounds need the permutation of the sets still open
            elems, owner, place = elems[active], owner[active], place[active]
            perm = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.int32), (len(elems), 1))
            perm[np.arange(len(elems)), place] = 0
        elif not active.all():
            elems, owner, perm = elems[active], owner[active], perm[active]
    return sig.reshape(n, slots)


def band_keys(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band, different bands in different ranges of hashes."""
    n, slots = sig.shape
    parts = sig[:, :slots // rows * rows].reshape(n, slots // rows, rows)
    x = np.tile(np.arange(1, slots // rows + 1, dtype=np.uint64), (n, 1))
    for i in range(rows):
        x = mixed(x * _GOLD + parts[:, :, i])
    return x


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, whatever its order."""
    if not len(s):
        return 0, 0
    a, b = mixed(s + _ODD[3]), mixed(s ^ _ODD[4])
    low = (int(np.bitwise_xor.reduce(b)) + len(s) * int(_GOLD)) & _MASK
    return int(a.sum(dtype=np.uint64).view(np.int64)), int(np.uint64(low).view(np.int64))


def _chunks(texts: list, known: WordHashes, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Sets of consecutive texts, at most about CHUNK shingles at a time, with the index of the first."""
    first, sets, total = 0, [], 0
    for i, t in enumerate(texts):
        sets.append(shingle_set(t, known, width))
        total += len(sets[-1])
        if total >= CHUNK:
            yield first, sets
            first, sets, total = i + 1, [], 0
    if sets:
        yield first, sets


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _sign(batches: Iterator[pa.RecordBatch], width: int, band_rows: int) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    for batch in batches:
        ids = batch.column("doc_id")
        for first, sets in _chunks(batch.column("text").to_pylist(), known, width):
            sizes = np.array([len(s) for s in sets], np.int64)
            keys = band_keys(superminhash(np.concatenate(sets), sizes), band_rows)
            prints = np.array([fingerprint(s) for s in sets], np.int64)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(first, len(sets)), pa.array(sizes), pa.array(prints[:, 0]), pa.array(prints[:, 1]),
                 _lists(keys.ravel(), np.full(len(sets), keys.shape[1]))], names=["doc_id", "n_shingles", "fa", "fb", "bands"])
        if len(known) > REMEMBER:
            known.clear()


def _id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def sign(docs: DataFrame, width: int = WIDTH, band_rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, set fingerprint (fa, fb) and band keys of every document."""
    ship_package(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: _sign(batches, width, band_rows), f"doc_id {_id_type(docs)}, n_shingles long, fa long, fb long, bands array<long>")


def _full_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    for batch in batches:
        fa, fb = batch.column("fa").to_pylist(), batch.column("fb").to_pylist()
        for first, sets in _chunks(batch.column("text").to_pylist(), known, width):
            keep = [i for i, s in enumerate(sets) if fingerprint(s) == (fa[first + i], fb[first + i])]
            if keep:
                taken = batch.take(pa.array([first + i for i in keep]))
                own = [sets[i] for i in keep]
                yield pa.RecordBatch.from_arrays([taken.column(c) for c in ("ca", "cb", "blocks", "fa", "fb")] + [
                    _lists(np.concatenate(own), np.array([len(s) for s in own]))], names=["ca", "cb", "blocks", "fa", "fb", "shingles"])
        if len(known) > REMEMBER:
            known.clear()


def spanning_roots(sets: list[np.ndarray], link: tuple[int, int] = LINK) -> np.ndarray:
    """For each set the smallest index of its component of true links, by exact intersections.

    The most central set goes first; sets in its component need no turn of
    their own, as every other set looks for links to all.
    """
    m = len(sets)
    root = np.arange(m)
    sizes = np.array([len(s) for s in sets], np.int64)
    values, vid = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(m), sizes)
    order = np.argsort(vid, kind="stable")
    posting, counts = owner[order], np.bincount(vid, minlength=len(values))
    starts = np.cumsum(counts) - counts
    begin = np.cumsum(sizes) - sizes

    def links(i: int) -> np.ndarray:
        v = vid[begin[i]:begin[i] + sizes[i]]
        c = counts[v]
        at = np.repeat(starts[v] - (np.cumsum(c) - c), c) + np.arange(c.sum())
        inter = np.bincount(posting[at], minlength=m)
        return np.flatnonzero(link[1] * inter >= link[0] * (sizes[i] + sizes - inter))

    def unite(i: int) -> None:
        old = np.unique(root[links(i)])
        root[np.isin(root, old)] = old.min()

    centre = int(np.argmax(np.add.reduceat(counts[vid], begin) / sizes))
    unite(centre)
    for i in range(m):
        if root[i] != root[centre]:
            unite(i)
    return root


def _forest(batches: Iterator[pa.RecordBatch], link: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Spanning forests of groups that arrive as runs of equal (ca, cb, p, q)."""
    def solved(rows: dict) -> pa.RecordBatch | None:
        nodes, sets = list(rows), list(rows.values())
        if len(sets) < 2:
            return None
        root = spanning_roots(sets, link)
        out = [(*nodes[i], *nodes[r]) for i, r in enumerate(root) if i != r]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["fa", "fb", "ra", "rb"]) if out else None

    key, rows = None, {}
    for batch in batches:
        ks = list(zip(*[batch.column(c).to_pylist() for c in ("ca", "cb", "p", "q")]))
        nodes = list(zip(batch.column("fa").to_pylist(), batch.column("fb").to_pylist()))
        shingles = batch.column("shingles")
        flat, off = shingles.values.to_numpy().view(np.uint64), shingles.offsets.to_numpy()
        for i, k in enumerate(ks):
            if k != key:
                if (done := solved(rows)) is not None:
                    yield done
                key, rows = k, {}
            rows[nodes[i]] = flat[off[i]:off[i + 1]].copy()
    if (done := solved(rows)) is not None:
        yield done


def candidate_groups(classes: DataFrame) -> DataFrame:
    """(node, component) over the stars of shared bands."""
    members = classes.select(F.struct("fa", "fb").alias("node"), F.explode("bands").alias("key"))
    heads = stage(members.groupBy("key").agg(F.min("node").alias("head"), F.count("*").alias("c")).where("c > 1").select("key", "head"), "smh-heads")
    stars = members.join(heads, "key").where("node != head")
    return connected_components(stars.select(F.col("node").alias("a"), F.col("head").alias("b")))


def verified_forest(docs: DataFrame, classes: DataFrame, width: int = WIDTH, link: tuple[int, int] = LINK) -> DataFrame:
    """(fa, fb, ra, rb): each class of a component of true links with another class of it."""
    spark = docs.sparkSession
    groups = stage(candidate_groups(classes), "smh-groups")
    known = classes.select(F.struct("fa", "fb").alias("node"), "rep", "n_shingles")
    sized = groups.join(known, "node")
    blocks = stage(sized.groupBy("component").agg(F.ceil(F.sum("n_shingles") / BLOCK).cast("int").alias("blocks")), "smh-blocks")
    wanted = stage(sized.join(blocks, "component").select(
        "rep", F.col("component.fa").alias("ca"), F.col("component.fb").alias("cb"), "blocks", F.col("node.fa").alias("fa"), F.col("node.fb").alias("fb")),
        "smh-wanted")
    picked = docs.select("doc_id", "text").join(small_side(wanted, 64), F.col("doc_id").eqNullSafe(F.col("rep")))
    sets = picked.select("text", "ca", "cb", "blocks", "fa", "fb").mapInArrow(
        lambda batches: _full_sets(batches, width), "ca long, cb long, blocks int, fa long, fb long, shingles array<long>")
    own = F.pmod(F.xxhash64("fa", "fb"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least(x, own).alias("p"), F.greatest(x, own).alias("q")))
    dealt = sets.select("ca", "cb", F.inline(pairs), "fa", "fb", "shingles")
    runs = dealt.repartition("ca", "cb", "p", "q").sortWithinPartitions("ca", "cb", "p", "q")
    forest = stage(runs.mapInArrow(lambda batches: _forest(batches, link), "fa long, fb long, ra long, rb long"), "smh-forest")
    if wanted.where("blocks > 1").limit(1).count() == 0:
        return forest  # every group was one block: its forest is final
    edges = forest.select(F.struct("fa", "fb").alias("a"), F.struct(F.col("ra").alias("fa"), F.col("rb").alias("fb")).alias("b"))
    cc = connected_components(edges)
    return cc.select("node.fa", "node.fb", F.col("component.fa").alias("ra"), F.col("component.fb").alias("rb"))


def duplicates(docs: DataFrame, width: int = WIDTH, link: tuple[int, int] = LINK, band_rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept; ``width`` words a shingle, ``link`` the least similarity."""
    signed = stage(sign(docs, width, band_rows), "smh-signed")
    classes = stage(signed.where("n_shingles > 0").groupBy("fa", "fb").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands")), "smh-classes")
    forest = verified_forest(docs, classes, width, link)
    f = forest.select(F.col("fa").alias("_a"), F.col("fb").alias("_b"), "ra", "rb")
    rooted = classes.join(f, (F.col("fa") == F.col("_a")) & (F.col("fb") == F.col("_b")), "left").select(
        "fa", "fb", "rep", F.coalesce("ra", "fa").alias("ra"), F.coalesce("rb", "fb").alias("rb"))
    rooted = stage(rooted, "smh-rooted")
    named = stage(rooted.groupBy("ra", "rb").agg(F.min("rep").alias("component_id")), "smh-named")
    of_class = rooted.join(named, ["ra", "rb"]).select(F.col("fa").alias("_a"), F.col("fb").alias("_b"), "component_id")
    rows = signed.select("doc_id", "n_shingles", "fa", "fb").join(
        of_class, (F.col("fa") == F.col("_a")) & (F.col("fb") == F.col("_b")) & (F.col("n_shingles") > 0), "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, width: int = WIDTH, link: tuple[int, int] = LINK, band_rows: int = ROWS) -> DataFrame:
    """``docs`` with one row of each component, the least by (doc_id, text hash), null ids last.

    Rows that share an id are judged by their own text; rows of equal id and text leave one.
    """
    name = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("row"))
    marks = stage(duplicates(docs.select(name.alias("doc_id"), "text"), width, link, band_rows).select("doc_id.id", "doc_id.row", "kept"), "smh-marks")
    own = {"_id": field("doc_id"), "_row": F.xxhash64(field("text"))}

    def rows(of: DataFrame, known: DataFrame, how: str) -> DataFrame:
        k = known.select(F.col("id").alias("_gone"), F.col("row").alias("_gone_row"))
        return of.join(small_side(k, 24), F.col("_id").eqNullSafe(F.col("_gone")) & (F.col("_row") == F.col("_gone_row")), how)
    left = rows(packed(docs).withColumns(own), marks.where("NOT kept").select("id", "row").distinct(), "left_anti")
    repeated = stage(marks.where("kept").groupBy("id", "row").agg(F.count("*").alias("c")).where("c > 1").select("id", "row"), "smh-again")
    if repeated.limit(1).count() == 0:
        return left.select("_d.*")
    return rows(left, repeated, "left_anti").unionByName(rows(left, repeated, "left_semi").dropDuplicates(["_id", "_row"])).select("_d.*")


NEAR_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i : i + 2], ' ')))) END AS sh FROM w),
x AS (SELECT min(doc_id) AS rep, sh, len(sh) AS n FROM s WHERE len(sh) > 0 GROUP BY sh),
e AS (SELECT rep, n, unnest(sh) AS t FROM x),
l AS (SELECT a.rep AS u, b.rep AS v FROM e a JOIN e b ON a.t = b.t AND a.rep < b.rep GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
both_ways AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
reach AS (SELECT rep AS u, rep AS v FROM x UNION SELECT r.u, b.v FROM reach r JOIN both_ways b ON r.v = b.u),
c AS (SELECT u AS rep, min(v) AS component_id FROM reach GROUP BY u)
SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, coalesce(c.component_id, s.doc_id) AS component_id, s.doc_id = coalesce(c.component_id, s.doc_id) AS kept
FROM s LEFT JOIN x ON len(s.sh) > 0 AND s.sh = x.sh LEFT JOIN c ON c.rep = x.rep"""
