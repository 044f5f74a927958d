"""Embedding near-duplicates by hierarchical navigable small-world graphs.

Vectors are compared when their labels are equal and not null (and their
lengths agree), by cosine in double precision; pairs of 0.98 or more are links.

1. Equal vectors of a label are combined into one class (map-side), so copies
   of any number are one graph node with a weight.
2. The classes of a label are dealt by hash into shards of at most about
   SHARD; every shard's graph is built in one task and written as one row.
3. Every shard is audited with the queries it will get: rows of the label's
   other shards and its own members (never counting a member as its own link),
   each against brute force.  Where these have fewer than TRUE_LINKS true links,
   members turned to a similarity within the link threshold are searched too.
   The beam is doubled until the recall of every kind reaches RECALL; a beam as
   wide as the shard compares with all of it.
4. Every pair of shards of a label is one task: each searches the other's
   graph with the audited beam.  A search keeps walking through everything
   within the link threshold, so large groups are found whole whatever the
   beam.  Each candidate is verified in double precision.
5. A task returns one row per node (its links, counted with the weights, and
   its root in a spanning forest), never pairs; connected components join the
   forests.

Defined results: a vector that is null, empty, zero or holds a null or
non-finite component, or has no label, links with nothing and is its own
component; repeated rows are other vectors; null ids never name a component
unless all its ids are null; extra columns are not read.
"""

from __future__ import annotations

import heapq
import io

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import connected_components, small_side, stage
from tickwise.session import ship_package

LINK = 0.98
SHARD = 4096
#: Neighbours per node on upper layers (twice that on layer 0), and beams while building and, at first, searching.
NEIGHBOURS = 12
BUILD_BEAM = 48
SEARCH_BEAM = 24
AUDIT = 128
RECALL = 0.99
#: Share of a shard within the link threshold of a query at which its search compares with the whole shard.
DENSE_SHARE = 1 / 8
#: Rows of a label (about) that its shards are compared with to find audit queries, and the true links an audit needs.
POOL = 1024
TRUE_LINKS = 64


class Graph:
    """A navigable small-world graph over unit vectors (rows of ``x``)."""

    def __init__(self, x: np.ndarray, adjacency: list | None = None, levels: np.ndarray | None = None, entry: int = -1):
        self.x = x
        self.seen = np.zeros(len(x), np.int64)
        self.tick = 0
        if adjacency is not None:
            self.adj, self.levels, self.entry = adjacency, levels, entry
            return
        rng = np.random.RandomState(7)
        self.levels = np.minimum((-np.log(rng.uniform(1e-12, 1, len(x))) / np.log(NEIGHBOURS)).astype(np.int64), 8)
        self.adj = [{} for _ in range(int(self.levels.max(initial=0)) + 1)]
        self.entry = -1
        for i in range(len(x)):
            self._insert(i)

    def _layer(self, q: np.ndarray, starts: list, beam: int, level: int, reach: float = 2.0) -> list:
        """Best ``beam`` nodes (similarity, node) by best-first walk; also all met with similarity >= ``reach``.

        A walk that meets more than DENSE_SHARE of the nodes within ``reach`` ends by comparing with all nodes.
        """
        self.tick += 1
        seen, tick, adj, x = self.seen, self.tick, self.adj[level], self.x
        sims = x[starts] @ q
        seen[starts] = tick
        frontier = [(-s, n) for s, n in zip(sims.tolist(), starts)]
        heapq.heapify(frontier)
        best = [(-s, n) for s, n in frontier]
        heapq.heapify(best)
        near = [(s, n) for s, n in best if s >= reach]
        while len(best) > beam:
            heapq.heappop(best)
        dense = max(beam, int(len(x) * DENSE_SHARE))
        while frontier:
            if len(near) > dense:
                sims = x @ q
                return [(float(sims[n]), int(n)) for n in np.flatnonzero(sims >= reach)]
            s, n = heapq.heappop(frontier)
            if -s < best[0][0] and len(best) >= beam and -s < reach:
                break
            nb = adj[n]
            nb = nb[seen[nb] != tick]
            if not len(nb):
                continue
            seen[nb] = tick
            sims = x[nb] @ q
            floor = min(best[0][0], reach) if len(best) >= beam else -2.0
            for j in np.flatnonzero(sims > floor):
                v, m = float(sims[j]), int(nb[j])
                heapq.heappush(frontier, (-v, m))
                if v >= reach:
                    near.append((v, m))
                heapq.heappush(best, (v, m))
                if len(best) > beam:
                    heapq.heappop(best)
        return near if reach <= 1 else best

    def _descend(self, q: np.ndarray, down_to: int) -> int:
        at = self.entry
        for level in range(int(self.levels[self.entry]), down_to, -1):
            here = float(self.x[at] @ q)
            while True:
                nb = self.adj[level][at]
                if not len(nb):
                    break
                sims = self.x[nb] @ q
                j = int(np.argmax(sims))
                if sims[j] <= here:
                    break
                at, here = int(nb[j]), float(sims[j])
        return at

    def _choose(self, q: np.ndarray, found: np.ndarray, room: int) -> np.ndarray:
        """Neighbours that are nearer to ``q`` than to a chosen one; the nearest of the rest fill up."""
        sims = self.x[found] @ q
        found = found[np.argsort(-sims, kind="stable")]
        if len(found) <= room:
            return found
        pts = self.x[found]
        gram, to_q = pts @ pts.T, pts @ q
        chosen, rest, top = [], [], np.full(len(found), -2.0)
        for i in range(len(found)):
            if len(chosen) < room and top[i] < to_q[i]:
                chosen.append(i)
                np.maximum(top, gram[i], out=top)
            else:
                rest.append(i)
        return found[(chosen + rest)[:room]]

    def _insert(self, i: int) -> None:
        q, level = self.x[i], int(self.levels[i])
        for lv in range(level + 1):
            self.adj[lv][i] = np.empty(0, np.int64)
        if self.entry < 0:
            self.entry = i
            return
        top = int(self.levels[self.entry])
        starts = [self._descend(q, min(level, top))]
        for lv in range(min(level, top), -1, -1):
            room = NEIGHBOURS * (2 if lv == 0 else 1)
            found = np.array([n for _, n in self._layer(q, starts, BUILD_BEAM, lv)], np.int64)
            mine = self._choose(q, found, NEIGHBOURS)
            self.adj[lv][i] = mine
            for n in mine.tolist():
                back = np.append(self.adj[lv][n], i)
                self.adj[lv][n] = self._choose(self.x[n], back, room) if len(back) > room else back
            starts = found.tolist()
        if level > top:
            self.entry = i

    def within(self, q: np.ndarray, beam: int, reach: float) -> np.ndarray:
        """Nodes found with similarity >= ``reach`` to ``q``."""
        if self.entry < 0:
            return np.empty(0, np.int64)
        if beam >= len(self.x):
            return np.flatnonzero(self.x @ q >= reach)
        found = self._layer(q, [self._descend(q, 0)], beam, 0, reach)
        return np.array(sorted(n for _, n in found), np.int64)

    def dump(self) -> bytes:
        out, arrays = io.BytesIO(), {"x": self.x, "levels": self.levels, "entry": np.array(self.entry), "layers": np.array(len(self.adj))}
        for lv, adj in enumerate(self.adj):
            nodes = np.array(sorted(adj), np.int64)
            arrays[f"n{lv}"] = nodes.astype(np.int32)
            arrays[f"s{lv}"] = np.array([len(adj[n]) for n in nodes.tolist()], np.int32)
            arrays[f"e{lv}"] = np.concatenate([adj[n] for n in nodes.tolist()] or [np.empty(0, np.int64)]).astype(np.int32)
        np.savez(out, **arrays)
        return out.getvalue()

    @staticmethod
    def load(blob: bytes) -> Graph:
        f = np.load(io.BytesIO(blob), allow_pickle=False)
        adj = []
        for lv in range(int(f["layers"])):
            ends = np.cumsum(f[f"s{lv}"])[:-1]
            adj.append(dict(zip(f[f"n{lv}"].tolist(), np.split(f[f"e{lv}"].astype(np.int64), ends))))
        return Graph(f["x"], adj, f["levels"], int(f["entry"]))


def unit_rows(vectors) -> np.ndarray:
    x = np.vstack([np.asarray(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow of the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def audit_queries(graph: Graph, others: np.ndarray) -> list[tuple[np.ndarray, list]]:
    """Per kind (other shards' rows, own members, planted) the queries that have true links, AUDIT at most, and those links."""
    n, dim = graph.x.shape

    def linked(rows: np.ndarray, own: bool) -> tuple[np.ndarray, list]:
        queries, truth = [], []
        for at in range(0, len(rows), 512):
            near = rows[at:at + 512] @ graph.x.T >= LINK
            if own:
                near[np.arange(len(near)), np.arange(at, at + len(near))] = False
            for i in np.flatnonzero(near.any(axis=1)):
                queries.append(rows[at + i])
                truth.append(np.flatnonzero(near[i]))
        pick = np.unique(np.linspace(0, len(truth) - 1, min(AUDIT, len(truth))).astype(np.int64))
        return np.array([queries[i] for i in pick]).reshape(-1, dim), [truth[i] for i in pick]

    kinds = [linked(others, False), linked(graph.x, True)]
    if sum(len(t) for _, truth in kinds for t in truth) < TRUE_LINKS:
        x = graph.x[np.unique(np.linspace(0, n - 1, min(AUDIT, n)).astype(np.int64))]
        side = np.random.RandomState(11).normal(size=x.shape)
        side -= (side * x).sum(axis=1, keepdims=True) * x
        size = np.linalg.norm(side, axis=1, keepdims=True)
        c = (1 + LINK) / 2
        kinds.append(linked(np.where(size > 1e-9, c * x + (1 - c * c) ** 0.5 * side / np.maximum(size, 1e-9), x), False))
    return kinds


def audited_beam(graph: Graph, others: np.ndarray) -> tuple[int, int, int, float]:
    """The first beam (doubled each time) whose recall of every kind reaches RECALL; true links, those found, the lowest recall."""
    kinds = audit_queries(graph, others)
    links = [sum(map(len, truth)) for _, truth in kinds]
    beam = SEARCH_BEAM
    while True:
        found = [sum(len(np.intersect1d(t, graph.within(q, beam, LINK), assume_unique=True)) for q, t in zip(queries, truth)) for queries, truth in kinds]
        recall = min((f / k for f, k in zip(found, links) if k), default=1.0)
        if recall >= RECALL or beam >= len(graph.x):
            return beam, sum(links), sum(found), recall
        beam *= 2


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["fa", "fb"])
    graph = Graph(unit_rows(pdf["v"]))
    return pd.DataFrame({"label": [pdf["label"].iloc[0]], "dim": [pdf["dim"].iloc[0]], "shard": [pdf["shard"].iloc[0]],
                         "fa": [pdf["fa"].tolist()], "fb": [pdf["fb"].tolist()], "weight": [pdf["weight"].tolist()], "graph": [graph.dump()]})


def _audit(pdf: pd.DataFrame) -> pd.DataFrame:
    r = pdf.iloc[0]
    graph = Graph.load(r["graph"])
    others = [p["v"] for p in (r["pool"] if r["pool"] is not None else []) if p["shard"] != r["shard"]]
    beam, links, found, recall = audited_beam(graph, unit_rows(others) if others else np.empty((0, graph.x.shape[1])))
    return pd.DataFrame({"label": [r["label"]], "dim": [r["dim"]], "shard": [r["shard"]], "beam": [beam],
                         "true_links": [links], "found_links": [found], "recall": [recall]})


def roots(hits: np.ndarray, own: bool) -> np.ndarray:
    """The smallest node of each node's component; columns are the rows again (``own``) or nodes numbered after them."""
    na, nb = hits.shape
    n = na if own else na + nb
    root = np.full(n, -1, np.int64)
    for start in range(n):
        if root[start] >= 0:
            continue
        root[start], todo = start, [start]
        while todo:  # every node's row is read once
            i = todo.pop()
            near = np.flatnonzero(hits[i]) + (0 if own else na) if i < na else np.flatnonzero(hits[:, i - na])
            near = near[root[near] < 0]
            root[near] = start
            todo += near.tolist()
    return root


def _search(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links between two shards (or within one): per node its weighted links and its root."""
    r = pdf.iloc[0]
    own = r["shard"] == r["shard2"]
    a = Graph.load(r["graph"])
    b = a if own else Graph.load(r["graph2"])
    na, nb = len(a.x), len(b.x)
    hits = np.zeros((na, nb), bool)  # one byte a pair of nodes, whatever the number of links
    for i in range(na):
        hits[i, b.within(a.x[i], int(r["beam"] if own else r["beam2"]), LINK)] = True
    if own:
        np.fill_diagonal(hits, False)
        hits |= hits.T
    else:
        for j in range(nb):
            hits[a.within(b.x[j], int(r["beam"]), LINK), j] = True
    wa = np.array(r["weight"], np.int64)
    wb = wa if own else np.array(r["weight2"], np.int64)
    links = np.array([wb[row].sum() for row in hits], np.int64)
    if not own:
        links = np.concatenate([links, [wa[col].sum() for col in hits.T]]).astype(np.int64)
    root = roots(hits, own)
    fa, fb = list(r["fa"]) + ([] if own else list(r["fa2"])), list(r["fb"]) + ([] if own else list(r["fb2"]))
    hit = np.flatnonzero(links).tolist()
    tops = root[hit].tolist()
    return pd.DataFrame({"fa": [fa[i] for i in hit], "fb": [fb[i] for i in hit], "links": links[hit],
                         "ra": [fa[i] for i in tops], "rb": [fb[i] for i in tops]}).astype("int64")


def can_link() -> Column:
    """Whether a row has a label and a finite vector other than zero."""
    e = F.col("embedding")
    finite = F.forall(e, lambda v: v.isNotNull() & F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(e, lambda v: F.coalesce(v != 0, F.lit(False))), F.lit(False))


def shard_graphs(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The shards' graphs (label, dim, shard, fa, fb, weight, graph) and their audits (label, dim, shard, beam, true_links, found_links, recall)."""
    label = classes.schema["label"].dataType.simpleString()
    shards = classes.groupBy("label", "dim").agg(F.count("*").alias("size"), F.ceil(F.count("*") / SHARD).cast("int").alias("n_shards"))
    dealt = classes.join(shards, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("fa"), F.col("n_shards")).cast("int"))
    graphs = stage(dealt.select("label", "dim", "shard", "fa", "fb", "weight", "v").groupBy("label", "dim", "shard").applyInPandas(
        _build, f"label {label}, dim int, shard int, fa array<long>, fb array<long>, weight array<long>, graph binary"), "hnsw-graphs")
    pool = dealt.where((F.col("n_shards") > 1) & (F.pmod(F.xxhash64("fb", "fa"), F.col("size")) < POOL)).groupBy("label", "dim").agg(
        F.collect_list(F.struct("shard", "v")).alias("pool"))
    asked = graphs.select("label", "dim", "shard", "graph").join(pool, ["label", "dim"], "left")
    audits = stage(asked.groupBy("label", "dim", "shard").applyInPandas(
        _audit, f"label {label}, dim int, shard int, beam int, true_links long, found_links long, recall double"), "hnsw-audits")
    return graphs, audits


def vector_classes(embeddings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that can link (vec_id, label, dim, fa, fb, embedding) and their classes of equal vectors."""
    ship_package(embeddings.sparkSession)
    key = [F.xxhash64("label", "embedding").alias("fa"), F.xxhash64("embedding", F.lit("lane"), "label").alias("fb")]
    rows = stage(embeddings.where(can_link()).select("vec_id", "label", F.size("embedding").alias("dim"), *key, "embedding"), "hnsw-rows")
    classes = stage(rows.groupBy("label", "dim", "fa", "fb").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.first("embedding").alias("v")),
                    "hnsw-classes")
    return rows, classes


def audit_report(embeddings: DataFrame) -> DataFrame:
    """One row per label and vector length: shards, widest beam, audited true links, those found, recall."""
    _, audits = shard_graphs(vector_classes(embeddings)[1])
    return audits.groupBy("label", "dim").agg(F.count("*").alias("shards"), F.max("beam").alias("beam"), F.sum("true_links").alias("true_links"),
                                              F.sum("found_links").alias("found_links")).withColumn("recall", F.try_divide("found_links", "true_links"))


def shard_pairs(shards: DataFrame) -> DataFrame:
    """(label, dim, shard, shard2) for every pair of shards of a label, shard <= shard2: numbers only, unfolded shard by shard."""
    last = shards.groupBy("label", "dim").agg(F.max("shard").alias("_last"))
    both = shards.join(last, ["label", "dim"]).withColumn("shard2", F.explode(F.sequence("shard", "_last")))
    return both.select("label", "dim", "shard", "shard2")


def near_duplicates(embeddings: DataFrame) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows, classes = vector_classes(embeddings)
    graphs, audits = shard_graphs(classes)
    graphs = graphs.join(small_side(audits.select("label", "dim", "shard", "beam"), 32), ["label", "dim", "shard"])
    pairs = shard_pairs(graphs.select("label", "dim", "shard"))
    left = graphs.select("label", "dim", "shard", "beam", "fa", "fb", "weight", "graph")
    right = graphs.select("label", "dim", *[F.col(c).alias(f"{c}2") for c in ("shard", "beam", "fa", "fb", "weight", "graph")])
    # graphs are fetched by their own number, so the pairs of a label spread over its shards; a shard with itself needs no second graph
    own = pairs.where("shard = shard2").join(left, ["label", "dim", "shard"]).select(
        "*", F.col("beam").alias("beam2"), *[F.lit(None).cast("array<long>").alias(f"{c}2") for c in ("fa", "fb", "weight")], F.lit(None).cast("binary").alias("graph2"))
    two = pairs.where("shard < shard2").join(left, ["label", "dim", "shard"]).join(right, ["label", "dim", "shard2"])
    pairs = own.unionByName(two.select(own.columns))
    found = stage(pairs.groupBy("label", "dim", "shard", "shard2").applyInPandas(_search, "fa long, fb long, links long, ra long, rb long"), "hnsw-links")
    edges = found.select(F.struct("fa", "fb").alias("a"), F.struct(F.col("ra").alias("fa"), F.col("rb").alias("fb")).alias("b"))
    cc = connected_components(edges).select(F.col("node.fa").alias("_a"), F.col("node.fb").alias("_b"), F.col("component").alias("root"))
    links = found.groupBy("fa", "fb").agg(F.sum("links").alias("links"))
    node = classes.select("fa", "fb", "rep", "weight").join(links, ["fa", "fb"], "left")
    node = node.join(cc, (F.col("fa") == F.col("_a")) & (F.col("fb") == F.col("_b")), "left").select(
        "fa", "fb", "rep", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", F.struct("fa", "fb")).alias("root"))
    node = stage(node, "hnsw-nodes")
    named = stage(node.groupBy("root").agg(F.min("rep").alias("component_id")), "hnsw-named")
    of_class = node.join(named, "root").select("fa", "fb", "n_links", "component_id")
    linked = rows.select("vec_id", "fa", "fb").join(of_class, ["fa", "fb"]).select("vec_id", "n_links", "component_id")
    alone = embeddings.where(~can_link()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


EMBED_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
l AS (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
reach AS (SELECT u, u AS v FROM l UNION SELECT r.u, l.v FROM reach r JOIN l ON r.v = l.u),
c AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u),
n AS (SELECT u, count(*) AS n_links FROM l GROUP BY u)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id, vec_id = coalesce(component_id, vec_id) AS kept
FROM embeddings LEFT JOIN n ON n.u = vec_id LEFT JOIN c ON c.u = vec_id"""
