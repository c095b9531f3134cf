from __future__ import annotations

import io
import struct
import zlib

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from factloom.llm import frames

PATH = P.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = frames.WordEncoder(PATH)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aAéÀſǅ½²'s1 \t\n\x1c\x85 　̈́ΣσS<|endoftext|>日.-", max_size=30))
def test_words_encode_as_whole_texts(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert OWN.encode([text])[0] == struct.pack(f"<{len(ids)}I", *ids)


def test_every_code_point_encodes_as_the_library_does():
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i <= 0xDFFF]
    texts = [f"{c} a{c}b" for c in points]
    for at in range(0, len(texts), 20_000):
        some = texts[at : at + 20_000]
        own, library = OWN.encode(some), LIBRARY.encode_batch(some, add_special_tokens=False)
        assert not [t for t, a, b in zip(some, own, library, strict=True) if a != struct.pack(f"<{len(b.ids)}I", *b.ids)]


def test_reader_takes_only_what_is_asked_for():
    out = io.BytesIO()
    writer = frames.FrameWriter(out)
    data = {i: struct.pack(f"<{i}I", *range(i)) for i in range(50)} | {33: struct.pack("<2I", 1, 70_000)}
    for i, ids in data.items():
        writer.add(i, ids)
    writer.finish()
    reader = frames.FrameReader(out)
    assert reader.documents({7, 33, 99}) == {7: data[7], 33: data[33]}
    broken = bytearray(out.getvalue())
    broken[reader.entries[9][1] + 6] ^= 1
    reader = frames.FrameReader(io.BytesIO(bytes(broken)))
    assert reader.frame(8) == data[8]
    with pytest.raises(Exception):
        reader.frame(9)
    broken[-frames.FOOTER.size - 3] ^= 1
    with pytest.raises(ValueError):
        frames.FrameReader(io.BytesIO(bytes(broken)))


def test_round_trip(spark, tmp_path):
    rows = [(5, "one two three"), (1, None), (9, ""), (3, "Ünï " * 20_000), (7, "x"), (7, "x"), (2, "<|endoftext|> a")] + [(100 + i, f"text number {i} with words") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as start", "2 as frame").repartition(5)
    files = frames.write(docs, PATH, str(tmp_path / "ids"), file_bytes=2000)
    assert files.count() > 2
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in frames.read(files).collect())
    at, want = 0, []
    for i, t in sorted(rows, key=lambda x: x[0]):
        ids = [*LIBRARY.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    assert got == want
    assert not [p for p in (tmp_path / "ids").iterdir() if p.name.startswith(".")]
    assert frames.round_trip(docs.limit(0), PATH).count() == 0
    nulls = spark.createDataFrame([(None, "a"), (1, "b")], "doc_id long, text string")
    assert {(r.doc_id, r.start) for r in frames.round_trip(nulls, PATH).collect()} == {(None, 0), (1, 2)}
