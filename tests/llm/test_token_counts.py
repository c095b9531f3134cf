from __future__ import annotations

import random

import public_tokenizers as P

from factloom.llm import token_counts as tc

PATH = P.path("piece_bpe_32k.model")


def test_shared_trie_gives_what_each_word_gives_alone():
    pieces = tc.Pieces.load(PATH)
    trie, rng = tc.Trie(pieces), random.Random(2)
    words = ["", "the", "there", "thereby", "therewith", "naïve", "日本語", "😀x", "a" * 47, "a" * 120, "Ünïcödé"]
    words += ["".join(rng.choices("theraniosé日1-", k=rng.randint(1, 60))) for _ in range(400)]
    for w in words:
        assert trie.insert(tc.MARK + w) == tc.plain_count(tc.MARK + w, pieces), w
    before = len(trie.best)
    trie.insert(tc.MARK + "therewit")
    assert len(trie.best) == before  # a prefix of a known pre-token makes no node


def test_reset_keeps_counts(monkeypatch):
    monkeypatch.setattr(tc, "MAX_NODES", 20)
    pieces = tc.Pieces.load(PATH)
    trie = tc.Trie(pieces)
    for w in ["alphabet", "betamax", "gammas", "alphabet", "deltas"]:
        assert trie.insert(w) == tc.plain_count(w, pieces)


def test_rows(spark):
    pieces = tc.Pieces.load(PATH)
    rows = [(1, None), (2, ""), (3, "the cat  sat\nthe cat"), (3, "the cat  sat\nthe cat"), (None, "x"), (4, "y" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_tokens")
    got = {r.doc_id: r for r in tc.counts(docs, PATH).collect()}
    for i, t in rows:
        assert got[i].n_tokens == sum(tc.plain_count(tc.MARK + w, pieces) for w in (t or "").split())
        assert got[i].n_words == len((t or "").split())
    assert tc.counts(docs, PATH).count() == 6 and tc.counts(docs.limit(0), PATH).count() == 0


def test_long_words_share_their_prefix(monkeypatch):
    monkeypatch.setattr(tc, "DEPTH", 30)
    pieces, rng = tc.Pieces.load(PATH), random.Random(5)
    trie = tc.Trie(pieces)
    start = "日本語の文章は空白を置かない" * 3
    for _ in range(60):
        word = start[: rng.randint(0, len(start))] + "".join(rng.choices("日本語thera", k=rng.randint(0, 60)))
        assert trie.insert(word) == tc.plain_count(word, pieces)
    before = len(trie.best)
    assert trie.insert(start + "theretherethere") == tc.plain_count(start + "theretherethere", pieces)
    assert len(trie.best) - before <= 30 and len(trie.best) <= 1 + 62 * 30


def test_runs_part_words_as_python_does():
    pieces = tc.Pieces.load(PATH)
    trie, rng = tc.Trie(pieces), random.Random(9)
    spaces = [" ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1f", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000", "\u200b", "  "]
    texts = ["".join(rng.choice(spaces if rng.random() < 0.4 else ["the", "é", "日", "x1", "\ufeff"]) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    words, tokens = tc.count_run(texts, trie)
    assert words.tolist() == [len(t.split()) for t in texts]
    assert tokens.tolist() == [sum(tc.plain_count(tc.MARK + w, pieces) for w in t.split()) for t in texts]
