"""Cases that the training-data operators once lost, and their brute-force versions."""

from __future__ import annotations

import time
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickwise.llm import decontaminate, hnsw, html_template, langid, pii, secrets, superminhash

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, data):
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in data], DOC)


def made_up(rng, letters: list[str], n: int) -> str:
    """Words of a toy language: syllables drawn from its own list."""
    return " ".join("".join(letters[k] for k in rng.randint(0, len(letters), rng.randint(2, 5))) for _ in range(n))


def test_languages_of_one_script_are_told_apart(spark):
    rng = np.random.RandomState(4)
    base = ["".join(chr(0x430 + int(c)) for c in rng.randint(0, 24, 2)) for _ in range(12)]
    tongues = {"one": base, "two": [s.translate({0x430 + k: 0x430 + k + 7 for k in range(25)}) for s in base],
               "three": ["".join(chr(0x4E00 + int(c)) for c in rng.randint(0, 900, 2)) for _ in range(12)]}
    data = [(i, made_up(rng, tongues[t], 25), t) for i, t in enumerate(list(tongues) * 120)]
    got = {r["doc_id"]: r for r in langid.identify(docs(spark, data)).collect()}
    held = [i for i, _, _ in data if got[i]["held_out"]]
    assert len(held) > 40 and all(got[i]["lang_pred"] == data[i][2] for i in held)


def test_prediction_equals_vectors_in_plain_python(spark):
    rng = np.random.RandomState(2)
    a, b = ["ka", "lo", "mi", "é"], ["sch", "zu", "ort", "ö"]
    data = [(i, made_up(rng, (a, b)[i % 2], 6), ("aa", "bb")[i % 2]) for i in range(40)] + [(40, "", None), (41, "12 !", None), (42, "Ka-LO", None)]
    frame = docs(spark, data)
    names, protos = langid.prototypes(frame)
    sign = lambda cp: [int(x) for x in langid.letter_vectors(np.array([cp]))[0]]

    def vector(text: str) -> list[int]:
        letters = [0] + [ord(c) if c.isalpha() else 0 for c in text.lower() + " "]
        letters = [c for i, c in enumerate(letters) if c or i == 0 or letters[i - 1]]
        out = [0] * langid.DIM
        for x, y, z in zip(letters, letters[1:], letters[2:]):
            if y:
                p, q, r = sign(x), sign(y), sign(z)
                for d in range(langid.DIM):
                    out[d] += p[d - 2] * q[d - 1] * r[d]
        return out
    learn: dict = {}
    got = {r["doc_id"]: r for r in langid.predict(frame, names, protos).collect()}
    for i, t, lang in data:
        if lang and not got[i]["held_out"]:
            learn[lang] = np.array(learn.get(lang, 0)) + np.array(vector(t))
    unit = {k: v / np.linalg.norm(v) for k, v in learn.items()}
    for i, t, _ in data:
        v = np.array(vector(t), float)
        if not v.any():
            assert got[i]["lang_pred"] == "und" and got[i]["score"] == 0
            continue
        cos = {k: float(v @ u / np.linalg.norm(v)) for k, u in unit.items()}
        best = max(sorted(cos), key=cos.get)
        assert got[i]["lang_pred"] == best and abs(got[i]["score"] - max(0.0, cos[best])) < 1e-4


def test_keep_one_judges_rows_of_one_id_by_their_text(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(40)) for x in "ab")
    data = [(1, a, "en"), (2, a, "en"), (2, b, "en"), (3, b, "en"), (None, b, "en"), (4, None, "en"), (4, None, "en"), (5, "", "en"), (5, "x", "en")]
    got = superminhash.keep_one(docs(spark, data)).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, a), (2, b), (4, None), (5, ""), (5, "x")], key=str)


def test_long_tokens_are_weak_secrets_too(spark):
    texts = [f"client_id = abc99 then {'g' * n}B1" for n in (20, 70, 5000)] + ["client_id = abc99 then " + "g" * 30, "client_id = abc99 then " + "G1" * 20_000]
    out = secrets.report(docs(spark, [(i, t, "en") for i, t in enumerate(texts)])).orderBy("doc_id").collect()
    assert [r["n_linked"] for r in out] == [2, 2, 2, 0, 0]


def extracted(spark, pages):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    return [r["text"] for r in html_template.extract(df).orderBy("page_id").collect()]


def test_copies_of_one_page_keep_their_text(spark):
    copy = "<body><div class='story'><p>Once upon</p><p>a time</p></div><div class='links'><a href='/x'>More of this</a></div>"
    assert extracted(spark, [("http://m.example/", copy)] * 6) == ["Once upon\n\na time"] * 6


@pytest.mark.parametrize("name", ["comments-area", "site-menu", "user-comments", "entry-header", "left_sidebar", "newsletter-box", "x comments"])
def test_compound_names_of_chrome_inside_main(spark, name):
    page = "<main><p>Text {0}</p><div class='{1}'><p>Chrome {0}</p></div><p>End {0}</p></main>"
    assert extracted(spark, [(f"http://h{i}.example/", page.format(i, name)) for i in range(2)]) == [f"Text {i}\n\nEnd {i}" for i in range(2)]


@pytest.mark.parametrize("name", ["with-sidebar", "commentary", "menus-of-rome", "story-and-comments", "header-fixed"])
def test_names_that_are_no_chrome_keep_their_text(spark, name):
    assert extracted(spark, [("http://h.example/", f"<main><div class='{name}'><p>Text</p></div></main>")]) == ["Text"]


def test_deep_markup_costs_no_more_than_flat():
    page = "<div>" * 20_000 + "deep" + "</div>" * 10_000
    tracemalloc.start()
    start = time.perf_counter()
    tokens, regions = html_template.parse(page)
    spent, peak = time.perf_counter() - start, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(tokens) == 30_000 and [r.blocks for r in regions if r.blocks] == [["deep"]]
    assert peak < 50 << 20 and spent < 10


def test_every_pair_of_shards_once_and_spread_over_tasks(spark):
    shards = spark.createDataFrame([(7, 16, s) for s in range(30)] + [(8, 16, 0), (8, 16, 2)], "label int, dim int, shard int")
    pairs = [tuple(r) for r in hnsw.shard_pairs(shards).where("label = 7").collect()]
    assert sorted(pairs) == [(7, 16, a, b) for a in range(30) for b in range(a, 30)]
    per = hnsw.shard_pairs(shards).where("label = 7").groupBy("shard").count().agg(F.max("count")).first()[0]
    assert per == 30  # rows unfolded from one row, not the square


def test_dense_shard_links_equal_brute_force():
    rng = np.random.RandomState(3)
    x = hnsw.unit_rows(np.concatenate([rng.normal(size=24) + rng.normal(size=(500, 24)) * 0.02, rng.normal(size=(200, 24))]))
    import pandas as pd

    def shard(at, n):
        return {"label": 0, "dim": 24, "shard": n, "beam": 64, "fa": list(at), "fb": [0] * len(at), "weight": [1 + int(i) % 3 for i in at], "graph": hnsw.Graph(x[at]).dump()}
    a, b = shard(range(0, 700, 2), 0), shard(range(1, 700, 2), 1)
    near = x @ x.T >= hnsw.LINK
    np.fill_diagonal(near, False)
    weight = np.array([1 + (i % 3) for i in range(700)])
    total = np.zeros(700, int)
    for one, two in ((a, a), (a, b), (b, b)):
        row = {**one, **{f"{k}2": (two[k] if two is not one else None) for k in ("fa", "fb", "weight", "graph")}, "shard2": two["shard"], "beam2": two["beam"]}
        out = hnsw._search(pd.DataFrame([row]))
        for i, n, top in zip(out["fa"], out["links"], out["ra"]):
            total[i] += n
            assert near[:500, :500].any() and (i < 500) == (top < 500)
    assert total.tolist() == (near @ weight).tolist()


def test_roots_are_the_smallest_of_each_component():
    rng = np.random.RandomState(9)
    for own in (True, False):
        hits = rng.uniform(size=(40, 40 if own else 30)) < 0.02
        hits = hits | hits.T if own else hits
        n = 40 if own else 70
        full = np.eye(n, dtype=bool)
        full[:40, n - hits.shape[1]:] |= hits
        full |= full.T
        reach = np.linalg.matrix_power(full.astype(float), n) > 0
        assert hnsw.roots(hits, own).tolist() == reach.argmax(axis=1).tolist()


def test_items_of_equal_words_are_named(spark):
    items = [(9, "one two three four five six"), (5, "One two  three four five six"), (6, "other words stand here in this item"), (7, None), (8, " "), (3, "ab"), (4, "AB"), (4, "ab")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(tuple(r) for r in decontaminate.item_members(bench).collect())
    assert got == [(3, 3), (4, 3), (4, 3), (5, 5), (6, 6), (9, 5)]
    found = decontaminate.contaminated(docs(spark, [(1, "so one two three four five six then", "en")]), bench)
    named = found.withColumnRenamed("item_id", "class_id").join(decontaminate.item_members(bench), "class_id")
    assert sorted((r["doc_id"], r["item_id"]) for r in named.collect()) == [(1, 5), (1, 9)]
    assert decontaminate.item_members(bench.limit(0)).collect() == []


def test_context_words_are_whole(spark):
    url = "http://example.org/" + "a" * 60
    text = f"{url} x1y {url} and 192.168.0.1, {url[:50]} no"
    marks = {m["value"]: (m["before"], m["after"]) for m in pii.occurrences(docs(spark, [(1, text, "en")])).first()["marks"]}
    assert marks["x1y"] == ([], [])  # the neighbours are longer than the reach
    assert marks["192.168.0.1"][0] == ["and"] and len(marks["192.168.0.1"][1]) == 2
    short = {m["value"]: (m["before"], m["after"]) for m in pii.occurrences(docs(spark, [(1, "call me at x1y or so", "en")])).first()["marks"]}
    assert short["x1y"] == (["at", "me"], ["or", "so"])
