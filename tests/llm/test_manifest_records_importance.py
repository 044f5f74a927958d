"""Merkle manifest, token records and importance resampling against brute force and defined edge cases."""

from __future__ import annotations

import hashlib
import math
import os
import re
import struct
import zlib

import pyarrow as pa
import pytest

from tickwise.llm import importance, merkle, queries, token_records

DOC = "doc_id long, text string, lang string, source string, n_chars long"
tokens = pytest.importorskip("public_tokenizers")
VOCABULARY = tokens.path("byte_bpe_50k.json")


def table(spark, data, schema=DOC):
    return spark.createDataFrame(data, schema)


# Merkle manifest


def H(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(doc, text, lang, source, n) -> str:
    return H(enc(doc), enc(source), enc(lang), enc(n), enc(text))


def tree(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def brute_manifest(data) -> list[tuple]:
    by: dict = {}
    for r in data:
        by.setdefault(r[3], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by[s].sort(key=lambda r: (-(1 << 63) if r[0] is None else r[0], leaf_of(*r)))
        trees[s] = tree([leaf_of(*r) for r in by[s]])
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for j, s in enumerate(names):
        for i, r in enumerate(by[s]):
            doc, text, *rest = r
            if doc is not None and text is not None and zlib.crc32(str(doc).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded, siblings = leaf_of(doc, text, *rest), []
            for levels, at in ((trees[s], i), (top, j)):
                for nodes in levels[:-1]:
                    run = at // 3 * 3
                    left, right = nodes[run:at], nodes[at + 1:run + 3]
                    siblings += left + right
                    folded, at = H(*left, folded, *right), at // 3
            out.append((doc, trees[s][0][i], trees[s][-1][0], top[-1][0], H(*siblings), folded, folded == top[-1][0], s))
    return out


ODD_ROWS = [
    (None, "no id", "en", "a", 5), (None, None, None, "a", None), (7, "", "en", None, 0), (7, "", "en", None, 0), (7, "x\ny", None, None, 3),
    (-5, "minus\n", "de", "a", 6), (1 << 40, "far\naway", "de", "é", 8), (3, "long " * 40_000, "en", "é", None), (4, "\n\n", "en", "", 2),
]


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest_equals_brute_force(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 3**levels)
    data = ODD_ROWS + [(i * 37 % 5000, f"text\n{i % 11}", "en", f"s{i % 3 if i % 7 else 9}", i) for i in range(400)]
    data += [(11, f"copy {i % 4}\n", "en", "s0", 5) for i in range(60)]
    got = [tuple(r) for r in merkle.manifest(table(spark, data)).collect()]
    assert sorted(got, key=str) == sorted(brute_manifest(data), key=str)


def test_manifest_of_few_rows(spark):
    assert merkle.manifest(table(spark, [])).count() == 0
    one = [(1, "a\nb", "en", "s", 3)]
    assert [tuple(r) for r in merkle.manifest(table(spark, one)).collect()] == brute_manifest(one)


def test_manifest_reads_no_other_column(spark):
    data = [(i, "a\nb", "en", "s", 3, "x", 1, "y") for i in range(5)]
    df = table(spark, data, DOC + ", g string, rank int, leaf string")
    assert sorted(map(tuple, merkle.manifest(df).collect()), key=str) == sorted(brute_manifest([r[:5] for r in data]), key=str)


# Token records

TRICKY = [None, "", " ", "\n", "two  spaces", "line\n\nline", " lead", "trail ", "don't they'll", "a\x01b \x01c", "  wide　 space", "<|endoftext|> as text",
          "\U0001F600 smile", "x" * 3000, "w. w, w. \n.", "tab\t x\r\n y", "zero​width", "\x1c sep \x85 next", "word " * 60_000]


def plain_ids(texts) -> list[list[int]]:
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_pieces_encode_like_whole_texts():
    from hypothesis import given, settings
    from hypothesis import strategies as st
    with open(VOCABULARY, encoding="utf-8") as f:
        encoder = token_records.Encoder(f.read())

    def check(texts):
        ids, sizes = encoder.encode(pa.array(texts, pa.string()))
        want, lo = plain_ids(texts), 0
        for size, w in zip(sizes.tolist(), want):
            assert ids[lo:lo + size].tolist() == w
            lo += size
    check(TRICKY)
    part = st.sampled_from(list("aB1 .,'\n\t") + ["  ", "\n\n", "'s", " ", " ", "\x01", "\x1c", "é", "Ж", "漢", " word", "<|endoftext|>"])
    settings(max_examples=60, deadline=None)(given(st.lists(st.lists(part, max_size=12).map("".join), min_size=1, max_size=8))(check))()


def test_encoder_without_cuts_and_with_forgetting(monkeypatch):
    monkeypatch.setattr(token_records, "REMEMBER", 3)
    with open(VOCABULARY, encoding="utf-8") as f:
        encoder = token_records.Encoder(f.read())
    for cuts in (True, False, True):
        encoder.cuts = cuts
        ids, sizes = encoder.encode(pa.array(TRICKY[:-1]))
        assert ids.tolist() == [i for w in plain_ids(TRICKY[:-1]) for i in w]


def test_records_round_trip(spark):
    data = [(i * 7 % 23 if i != 3 else None, t, "en", "s", 1, "clash") for i, t in enumerate(TRICKY)] + [(5, "same", "en", "s", 1, "")] * 40
    docs = table(spark, data, DOC + ", ids string")
    folder = token_records.write(docs, VOCABULARY)
    got = sorted(token_records.read(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in data), key=lambda d: (d is not None, d))
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        at += r["n_tokens"]
    want = sorted(((d, [*w, 0]) for (d, *_), w in zip(data, plain_ids([r[1] for r in data]))), key=str)
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=str) == want
    digests = {(r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_records.digests(spark, folder).collect()}
    assert digests == {(r["start"], r["n_tokens"], zlib.crc32(struct.pack(f"<{len(r['ids'])}I", *r["ids"]))) for r in got}
    # shuffled reads through the index: all records, in another order, the same for the same seed
    one, again, other = (token_records.shuffled(spark, folder, s).collect() for s in (1, 1, 2))
    assert [r["place"] for r in one] == [r["place"] for r in again] != [r["place"] for r in other]
    assert sorted(((r["doc_id"], r["ids"]) for r in one), key=str) == want


def test_damaged_records_are_found(spark):
    folder = token_records.write(table(spark, [(i, f"text {i}", "en", "s", 1) for i in range(3)]), VOCABULARY)
    shard = token_records.manifest(spark, folder).orderBy("shard").first()
    path = f"{folder}/{shard['records']}".removeprefix("file:").replace("//", "/")
    with open(path, "rb") as f:
        good = f.read()
    bad = bytearray(good)
    bad[-6] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        list(token_records._records(pa.BufferReader(bytes(bad))))
    with pytest.raises(ValueError, match="ends inside"):
        list(token_records._records(pa.BufferReader(good[:-1])))
    assert len(list(token_records._records(pa.BufferReader(good)))) == shard["n_records"]


def test_records_of_an_empty_table(spark):
    folder = token_records.write(table(spark, []), VOCABULARY)
    assert token_records.read(spark, folder).count() == 0 and token_records.shuffled(spark, folder, 0).count() == 0


def test_token_records_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    data = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    at, want = 0, []
    for (doc, _), w in zip(data, plain_ids([t for _, t in data])):
        ids = [*w, 0]
        want.append((doc, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    assert sorted(map(tuple, queries.QUERIES["op12_token_records"](spark, sf).collect())) == want


# Importance resampling

A_Z = str.maketrans(importance.UPPER, importance.LOWER)


def brute_resample(docs, target, n, buckets=10_000, seed=2024, min_words=20, share=(10, 100)):
    def feats(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(A_Z))
        return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1)]
    ours, theirs = [feats(t) for _, t in docs], [feats(t) for t in target]
    s, t = [0] * buckets, [0] * buckets
    for count, all_ in ((s, ours), (t, theirs)):
        for _, f in all_:
            for b in f:
                count[b] += 1
    S, T = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    rows = []
    for (doc, _), (n_words, f) in zip(docs, ours):
        weight = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n_words])
    able = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], -1 << 70 if r[0] is None else r[0], r[1]))
    for i, r in enumerate(able[:len(able) * share[0] // share[1]]):
        r[4] = i + 1
    return sorted(map(tuple, rows), key=str)


LINES = ["The same Line here", "", "é ÀB c1 c2", "one", "...", "word again, and again", "\r", "Ünï cödé", "a b c d e f g h i j k l m n o p q r s t u v"]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_resampling_equals_brute_force(spark, n):
    docs = [(i, "\n".join(LINES[(i * k) % len(LINES)] for k in range(1, 2 + i % 9))) for i in range(60)]
    docs += [(None, "a b " * 20), (61, None), (62, ""), (63, "\n\n"), (5, docs[5][1]), (5, docs[6][1]), (70, "big " * 50_000 + "\n" + "Line here " * 30)]
    target = ["The same\nline here", None, "c1 c2 one one", ""]
    got = importance.resample(table(spark, [(d, t, "x", "y") for d, t in docs], "doc_id long, text string, weight string, key string"),
                              table(spark, [(t,) for t in target], "text string"), n=n, share=(30, 100))
    assert sorted(map(tuple, got.collect()), key=str) == brute_resample(docs, target, n, share=(30, 100))


def test_resampling_of_empty_tables(spark):
    none, some = table(spark, [], "doc_id long, text string"), table(spark, [(1, "a b"), (2, None)], "doc_id long, text string")
    assert importance.resample(none, some).count() == 0
    got = importance.resample(some, none)
    assert sorted(map(tuple, got.collect()), key=str) == brute_resample([(1, "a b"), (2, None)], [], 1)
