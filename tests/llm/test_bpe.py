from __future__ import annotations

import hashlib

import public_tokenizers as P
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from factloom.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")
OWN = bpe.ByteBPE.load(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=OWN.ranks, special_tokens={})
CHARS = st.text(alphabet="  \n\t\r'strvelmdxSé9٣½.,!-  　\x85\x1c日😀", max_size=40)


@settings(max_examples=600, deadline=None)
@given(CHARS)
def test_encodes_as_the_library(text):
    ids = OWN.encode(text)
    assert ids == LIBRARY.encode_ordinary(text)
    assert OWN.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.lists(CHARS, max_size=6))
def test_boundaries_of_many_texts(texts):
    for text, starts in zip(texts, bpe.boundaries(texts), strict=True):
        assert starts.tolist() == [m.start() for m in regex.finditer(P.PATTERN, text)]


@settings(max_examples=300, deadline=None)
@given(st.lists(CHARS, max_size=6))
def test_runs_of_texts(texts):
    run = OWN.encode_run(texts) if texts else None
    if run is None:
        return
    ids, at = run.all_ids()
    want = [LIBRARY.encode_ordinary(t) for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == want
    assert [bytes(w) for w in run.written()] == [",".join(map(str, i)).encode() for i in want]
    assert [bytes(d) for d in OWN.decode_run(run)] == [t.encode() for t in texts]
    if len(run.number):
        run.at[-2] += 1
        with pytest.raises(ValueError):
            OWN.decode_run(run)


def test_composition_table():
    of_class, table, image = bpe.monoid()
    assert len(image) < 300
    for a in range(len(image)):
        for b in range(0, len(image), 3):
            c = of_class[5]
            assert table[table[a, b], c] == table[a, table[b, c]]


def test_long_runs_and_offsets():
    for text in ("a" * 30_000, " " * 5000 + "x", "ab'll'll" * 3000, "é" * 500):
        assert OWN.encode(text) == LIBRARY.encode_ordinary(text)
    text = "Zwei Wörter, 日本 it's"
    ids, starts, counts, decoded = next(iter(OWN.encode_batch([text])))
    assert decoded == text.encode()
    data, ends = text.encode(), [*starts.tolist()[1:], len(text.encode())]
    for k, (a, b) in enumerate(zip(starts.tolist(), ends, strict=True)):
        assert OWN.decode_piece(ids, counts, k) == data[a:b]


def test_rows(spark):
    rows = [(1, None), (2, ""), (3, "it's here  "), (3, "it's here  "), (None, "x"), (4, "word " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "text as ids", "1 as found")
    got = bpe.digest(docs, PATH).collect()
    assert len(got) == len(rows)
    of = {r.doc_id: r for r in got}
    for i, text in rows:
        ids = LIBRARY.encode_ordinary(text or "")
        assert of[i].n_tokens == len(ids)
        assert of[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert of[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    whole = {r.doc_id: r for r in bpe.encode(docs, PATH).collect()}
    assert bytes(whole[3].decoded) == b"it's here  " and sum(whole[3].piece_ids) == len(whole[3].ids)
    assert bpe.digest(docs.limit(0), PATH).count() == 0
