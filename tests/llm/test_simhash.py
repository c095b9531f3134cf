from __future__ import annotations

import random

import numpy as np
import xxhash

from factloom.llm import simhash
from factloom.llm.components import components


def plain(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def reachable(ids, fps):
    """Component of each row by comparing all pairs."""
    low = {f: min(i for i, g in zip(ids, fps, strict=True) if g == f) for f in fps}
    moved = True
    while moved:
        moved = False
        for a in low:
            for b in low:
                if (a ^ b).bit_count() <= 2 and low[b] < low[a]:
                    low[a], moved = low[b], True
    return [low[f] for f in fps]


def test_fingerprints():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choices(["A", "b", " ", "\t", "\x0b", "É", "z ", "\n", "\x1c", "long word "], k=rng.randint(0, 30)))
        assert simhash.fingerprint(text) == plain(text)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def test_trie_pairs():
    rng = random.Random(2)
    for n in (1, 2, 40, 700):
        seeds = [rng.getrandbits(64) for _ in range(max(1, n // 6))]
        x = np.unique(np.array([rng.choice(seeds) ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(4))}) for _ in range(n)], np.uint64))
        found = {p for i, j in simhash.trie_pairs(x, np.array([[0, len(x), 0, len(x)]]), small=4, slice_size=256) for p in zip(i.tolist(), j.tolist(), strict=True)}
        assert found == {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if int(x[i] ^ x[j]).bit_count() <= 2}


def test_links_with_hot_cells(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 8)
    rng = random.Random(4)
    base = rng.getrandbits(64)
    fps = sorted({base ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(0, 3))}) for _ in range(150)} | {rng.getrandbits(64) for _ in range(40)})
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in fps]
    reps = spark.createDataFrame([(f, i) for i, f in enumerate(signed)], "fp long, rep long")
    got = {r.node: r.component for r in components(simhash.links(reps)).collect()}
    want = reachable(range(len(fps)), fps)
    assert [got.get(i, i) for i in range(len(fps))] == want


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (5, 5), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_rows(spark):
    rng = random.Random(6)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta"]
    texts = [" ".join(rng.choices(words, k=60)) for _ in range(25)]
    texts += [t + " x" for t in texts[:10]] + texts[:5] + [None, "", " "]
    ids = list(range(3, 3 + len(texts)))
    rows = [(i, t, "c") for i, t in zip(ids, texts, strict=True)]
    docs = spark.createDataFrame([*rows, rows[0], (None, texts[0], "c")], "doc_id long, text string, fp string").repartition(3)
    got = simhash.near_duplicates(docs).collect()
    fps = [plain(t) for t in texts]
    want = dict(zip(ids, reachable(ids, fps), strict=True))
    assert len(got) == len(rows) + 2
    for r in got:
        assert r.component_id == (want[r.doc_id] if r.doc_id is not None else None)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(set(want.values()))
    assert kept.where("doc_id is null").count() == 1
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_ids_that_repeat_do_not_merge_classes(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT_SHARE", 4)
    rng = random.Random(9)
    a, b, c = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(50)) for _ in range(3))
    rows = [(5, a), (5, b), (7, a), (8, b), (9, c), (9, c), (9, c), (4, c), (6, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "doc_id as fp", "text as class")
    got = sorted((r.doc_id, r.component_id, r.fp) for r in simhash.near_duplicates(docs).collect())
    sign = lambda f: f - (1 << 64) if f >= 1 << 63 else f
    low = {a: 5, b: 5, c: 4, None: 3, "": 3}
    assert got == sorted((i, low[t], sign(plain(t))) for i, t in rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(5, a), (5, b), (4, c), (3, "")])
