"""Token-ID files of independent zstandard frames with a trailing seek table.

A file holds one frame for each document: its ids as little-endian unsigned integers of 16 bits, or of 32 where an id
needs them. The table at the end has an entry of (document id, offset and size of the frame, number of ids, crc32 of the
ids as 32-bit integers, whether the id is null, bytes an id) for each, in file order, and then a footer with the number
of entries, the table's crc32 and a magic number. A reader takes the footer and the
table, and decompresses only the frames of the documents asked for; each is checked against its crc32 and zstandard's
own content checksum.

Files are dealt by ranges of the document id and are in ascending order within and among themselves. A file is written
under a temporary name and renamed, so a task that is run again replaces its own work. The folder is one that pyarrow
reaches as well as Spark: a shared mount, hdfs, s3 or gs.

Cases: a null text counts as empty (the end id alone); rows with a null id come first; rows that share an id follow
each other by number and crc32 of their ids, and may fill several files; an empty table writes no file; other columns
are ignored.
"""

from __future__ import annotations

import gc
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm.common import in_runs, materialise, qualified, release, shared_path, spread

ENTRY, FOOTER, MAGIC = struct.Struct("<qqqqIBB2x"), struct.Struct("<QII"), 0x4C4F4F4D
LEVEL = 1
#: Words kept with their ids, and the longest that is kept.
CACHE_ENTRIES, CACHED_LENGTH = 600_000, 64
#: Characters of the texts that are encoded together.
RUN_CHARS = 4 << 20
#: Characters up to U+024F, of those that have a lower case beyond only that, and common punctuation beyond. What is
#: looked at is in lower case already, so a letter whose lower case is beyond shows by that.
COMMON = [c for c in map(chr, range(0x250)) if c == c.lower()] + [chr(c) for c in (*range(0x2010, 0x2028), 0x20AC)]
#: With a word of other characters, or with the start of a special token, a text goes to the library whole.
UNCOMMON = re.compile(rf"[^{re.escape(''.join(COMMON))}]|<\|")
#: The vocabulary's pre-tokens over lower-cased common characters.
LETTERS, NUMBERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
PRE_TOKEN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\t-\r\x20\x85\xa0{LETTERS}{NUMBERS}]+")
#: Compressed bytes that a file should have.
FILE_BYTES = 32 << 20


def narrowed(ids: bytes) -> tuple[bytes, int]:
    """(the ids in the fewest bytes, bytes an id)."""
    wide = np.frombuffer(ids, "<u4")
    return (wide.astype("<u2").tobytes(), 2) if not len(wide) or wide.max() < 1 << 16 else (ids, 4)


class FrameWriter:
    """Writes frames to a binary file object; finish() adds the table."""

    def __init__(self, out):
        import zstandard

        self.out, self.at, self.entries = out, 0, []
        self.zstd = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        data, width = narrowed(ids)
        self.add_frame(doc_id, self.zstd.compress(data), len(ids) // 4, zlib.crc32(ids), width)

    def add_frame(self, doc_id: int | None, frame: bytes, n: int, crc: int, width: int) -> None:
        self.out.write(frame)
        self.entries.append(ENTRY.pack(doc_id or 0, self.at, len(frame), n, crc, doc_id is None, width))
        self.at += len(frame)

    def finish(self) -> None:
        table = b"".join(self.entries)
        self.out.write(table + FOOTER.pack(len(self.entries), zlib.crc32(table), MAGIC))


class FrameReader:
    """Random access over a seekable binary file object."""

    def __init__(self, file):
        import zstandard

        self.file, self.zstd = file, zstandard.ZstdDecompressor()
        file.seek(0, 2)
        size = file.tell()
        file.seek(size - FOOTER.size)
        n, crc, magic = FOOTER.unpack(file.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a frame file")
        file.seek(size - FOOTER.size - n * ENTRY.size)
        table = file.read(n * ENTRY.size)
        if zlib.crc32(table) != crc:
            raise ValueError("the seek table is damaged")
        self.entries = [(None if x[5] else x[0], *x[1:5], x[6]) for x in ENTRY.iter_unpack(table)]

    def frame(self, k: int) -> bytes:
        """The ids of entry k as 32-bit integers, checked."""
        _, at, size, n, crc, width = self.entries[k]
        self.file.seek(at)
        ids = np.frombuffer(self.zstd.decompress(self.file.read(size)), f"<u{width}").astype("<u4").tobytes()
        if len(ids) != 4 * n or zlib.crc32(ids) != crc:
            raise ValueError(f"frame {k} is damaged")
        return ids

    def documents(self, wanted: set[int]) -> dict[int, bytes]:
        """The ids of the wanted documents; no other frame is read."""
        return {x[0]: self.frame(k) for k, x in enumerate(self.entries) if x[0] in wanted}


def opened(path: str):
    """(file system, path in it) of a URI as Hadoop writes it."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + (f"//{rest}" if scheme == "file" and not rest.startswith("//") else rest))


class WordEncoder:
    """The tokenizers library, asked once for each distinct pre-token.

    In a text of common characters the vocabulary's normaliser only lower-cases and turns white space into spaces, and
    its pre-tokens are the matches of PRE_TOKEN, which hold no white space. So the ids of a text are those of its words,
    and a word's those of its pre-tokens. Arrow cuts the texts of a run into words and numbers the distinct ones, so
    Python meets each of them once a run, and the ids are put together from arrays. A text with a word of other
    characters goes to the library as it is."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.cache = Tokenizer.from_file(path), {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        gc.disable()  # nothing here has cycles, and looking for some grows with the words
        try:
            return list(chain.from_iterable(map(self._run, in_runs(texts, RUN_CHARS))))
        finally:
            gc.enable()

    def _run(self, texts: list[str]) -> list[bytes]:
        words = pc.ascii_split_whitespace(pa.array([t.lower() for t in texts], pa.large_string()))
        numbered = words.values.dictionary_encode()
        known = self._known(numbered.dictionary.to_pylist())
        bad = np.fromiter((ids is None for ids in known), bool, len(known))
        width = np.fromiter((len(ids) // 4 if ids else 0 for ids in known), np.int64, len(known))
        flat = np.frombuffer(b"".join(filter(None, known)), "<u4")
        number = numbered.indices.to_numpy()
        ids, ends = spread(flat, width, number)
        edges = words.offsets.to_numpy()
        at = np.append(0, ends)[edges].tolist()
        out = [ids[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)]
        if bad.any():
            before = np.append(0, np.cumsum(bad[number]))[edges]
            for k in np.flatnonzero(before[1:] > before[:-1]).tolist():
                out[k] = self._whole(texts[k])
        return out

    def _known(self, words: list[str]) -> list[bytes | None]:
        """The ids of each of some distinct words, None for one of uncommon characters."""
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        cache = self.cache
        known = list(map(cache.get, words))
        if None not in known:
            return known
        fresh = [k for k, ids in enumerate(known) if ids is None and not UNCOMMON.search(words[k])]
        # A word of letters is a pre-token; the others are cut.
        parts = {k: PRE_TOKEN.findall(words[k]) for k in fresh if not words[k].isalpha() or len(words[k]) > CACHED_LENGTH}
        pieces = {words[k] for k in fresh if k not in parts}
        pieces.update(p for of in parts.values() for p in of if p not in cache and len(p) <= CACHED_LENGTH)
        self._learn_pieces(list(pieces))
        for k in fresh:
            if (of := parts.get(k)) is None:
                known[k] = cache[words[k]]
            else:
                known[k] = b"".join([cache[p] if len(p) <= CACHED_LENGTH else self._whole(p) for p in of])
                if len(words[k]) <= CACHED_LENGTH:
                    cache[words[k]] = known[k]
        return known

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def _learn_pieces(self, words: list[str]) -> None:
        """Adds distinct pre-tokens to the cache; the library gets many in one call."""
        for at in range(0, len(words), 1000):
            some = words[at : at + 1000]
            found = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            self.cache.update((w, struct.pack(f"<{len(ids)}I", *ids)) for w, ids in zip(some, [e.ids for e in found], strict=True))


@lru_cache(2)
def encoder(path: str) -> WordEncoder:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return WordEncoder(path)


def encoded(docs: DataFrame, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, crc, width, frame): each document's ids with the end id, compressed."""

    @F.pandas_udf("n long, crc long, width int, frame binary")
    def run(texts: pd.Series) -> pd.DataFrame:
        import zstandard

        zstd = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        own, rows, end = encoder(path), [], struct.pack("<I", end_id)
        for run in in_runs([t or "" for t in texts], RUN_CHARS):
            for ids in own.encode(run):
                ids += end
                data, width = narrowed(ids)
                rows.append((len(ids) // 4, zlib.crc32(ids), width, zstd.compress(data)))
        return pd.DataFrame(rows, columns=["n", "crc", "width", "frame"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), run(F.col(text_col)).alias("f")).select("doc_id", "f.*")


def write(docs: DataFrame, path: str, folder: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the files to a folder that all executors share; returns (bucket, file, n_docs, n_ids), one row a file."""
    frames = materialise(encoded(docs, path, end_id, id_col, text_col), "frames")
    size = frames.agg(F.sum(F.length("frame"))).first()[0] or 0
    folder = qualified(docs.sparkSession, folder)
    # A bucket is a range of ids; the last key parts a range of one id, whose rows are in no order that matters.
    order = [F.col("doc_id").asc_nulls_first(), F.col("n"), F.col("crc"), F.col("row")]
    dealt = frames.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(max(1, -(-size // file_bytes)), *order).sortWithinPartitions(*order).withColumn("bucket", F.spark_partition_id())

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = opened(folder)
        fs.create_dir(base, recursive=True)
        now, writer, out, temporary, total = None, None, None, "", 0

        def close() -> pd.DataFrame:
            writer.finish()
            out.close()
            fs.move(temporary, f"{base}/{now:08d}.ids")
            return pd.DataFrame({"bucket": [now], "file": [f"{folder}/{now:08d}.ids"], "n_docs": [len(writer.entries)], "n_ids": [total]})

        for pdf in batches:
            for b, doc, n_ids, crc, width, frame in zip(pdf["bucket"], pdf["doc_id"], pdf["n"], pdf["crc"], pdf["width"], pdf["frame"], strict=True):
                if b != now:
                    if now is not None:
                        yield close()
                    now, total = b, 0
                    temporary = f"{base}/.{b}-{uuid.uuid4().hex}"
                    out = fs.open_output_stream(temporary)
                    writer = FrameWriter(out)
                writer.add_frame(None if pd.isna(doc) else int(doc), frame, int(n_ids), int(crc), int(width))
                total += int(n_ids)
        if now is not None:
            yield close()

    files = materialise(dealt.select("bucket", "doc_id", "n", "crc", "width", "frame").mapInPandas(put, "bucket int, file string, n_docs long, n_ids long"), "frame-files")
    release(frames)
    return files


def read(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone; start counts the ids of all
    documents before it."""
    # One row a file; the running total is over files, not documents.
    before = files.withColumn("before", F.coalesce(F.sum("n_ids").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    n = max(1, files.count())

    def get(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, at in zip(pdf["file"], pdf["before"], strict=True):
                fs, name = opened(path)
                with fs.open_input_file(name) as file:
                    reader, rows = FrameReader(file), []
                    for k, (doc, *_) in enumerate(reader.entries):
                        ids = reader.frame(k)
                        rows.append((doc, at, len(ids) // 4, zlib.crc32(ids)))
                        at += len(ids) // 4
                        if len(rows) == 20_000:
                            yield _read_rows(rows)
                            rows = []
                    yield _read_rows(rows)

    return before.select("bucket", "file", "before").repartition(n, "bucket").mapInPandas(get, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _read_rows(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
    return out.astype({"doc_id": "Int64"})


def round_trip(docs: DataFrame, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes, writes files to the shared folder, and reads them back."""
    return read(write(docs, path, shared_path(docs.sparkSession, "ids"), end_id, id_col, text_col))
