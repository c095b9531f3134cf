"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Boundaries of pre-tokens are found without a regular expression: every code point maps to a character class by an
array, every class is a transition function over the states of a small automaton, and an associative scan composes
those functions over the text (each distinct composition is one entry of a finite table, so composing is one array
look-up). The slices between boundaries, as byte offsets into the texts of a run, are numbered by what they hold; each
distinct one goes through a cache of merged pairs, and the ids of the run are put together from arrays. The offsets are
kept: decoding puts the bytes of each pre-token's ids at its offset, and finds that they meet there.

Cases: a null text counts as empty and gives no ids; texts of any length are taken whole; repeated rows each get
their own result; a null id is kept; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import math
import struct
import sys
import unicodedata
from dataclasses import dataclass
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import Recent, in_runs, settle, spread

# Character classes. Letters that may end or go on with a contraction have classes of their own; BREAK parts texts.
LETTER, ENDING, R, V, L, E, NUMBER, SPACE, BLANK, QUOTE, OTHER, BREAK = range(12)
# States: what the last character read belongs to. Q: a quote that starts a pre-token; QR, QV, QL: with its next
# letter; DONE: a whole contraction.
S_LETTER, S_NUMBER, S_OTHER, S_SPACE, S_BLANK, S_Q, S_QR, S_QV, S_QL, S_DONE = range(10)
#: White space of the pattern's \s.
BLANKS = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
CACHE_ENTRIES = 100_000
CACHED_LENGTH = 64
#: Characters of the texts that are encoded together.
RUN_CHARS = 1 << 20


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of each code point."""
    out = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for i in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(i))[0]
        if kind == "L":
            out[i] = LETTER
        elif kind == "N":
            out[i] = NUMBER
    out[list(BLANKS)] = BLANK
    out[0x20], out[ord("'")] = SPACE, QUOTE
    for c in "stmd":
        out[ord(c)] = ENDING
    for c, kind in zip("rvle", (R, V, L, E), strict=True):
        out[ord(c)] = kind
    return out


def _step(state: int, kind: int) -> int:
    """The automaton's transition."""
    if kind <= E:
        if state == S_Q:
            return {ENDING: S_DONE, R: S_QR, V: S_QV, L: S_QL}.get(kind, S_LETTER)
        if (state in (S_QR, S_QV) and kind == E) or (state == S_QL and kind == L):
            return S_DONE
        return S_LETTER
    if kind == QUOTE:
        return S_OTHER if state in (S_SPACE, S_OTHER, S_Q) else S_Q
    return {NUMBER: S_NUMBER, SPACE: S_SPACE, BLANK: S_BLANK, OTHER: S_OTHER, BREAK: S_DONE}[kind]


@lru_cache(1)
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(function number of each class, number of each composition of two, image of the first state under each)."""
    first = [tuple(_step(s, k) for s in range(10)) for k in range(12)]
    number: dict[tuple, int] = {}
    for f in first:
        number.setdefault(f, len(number))
    todo = list(number)
    while todo:
        f = todo.pop()
        for g in first:
            h = tuple(g[s] for s in f)
            if h not in number:
                number[h] = len(number)
                todo.append(h)
    all_of = list(number)
    table = np.array([[number[tuple(g[s] for s in f)] for g in all_of] for f in all_of], np.uint16)
    return np.array([number[f] for f in first], np.uint16), table, np.array([f[S_DONE] for f in all_of], np.uint8)


def _scan(functions: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Inclusive scan of the functions under composition: within blocks, over the blocks' totals, then both together."""
    n = len(functions)
    if n <= 64:
        out = functions.copy()
        for i in range(1, n):
            out[i] = table[out[i - 1], functions[i]]
        return out
    width = max(8, math.isqrt(n) // 4)
    rows = -(-n // width)
    padded = np.concatenate([functions, np.zeros(rows * width - n, functions.dtype)]).reshape(rows, width).T.copy()
    for i in range(1, width):
        padded[i] = table[padded[i - 1], padded[i]]
    before = _scan(padded[-1], table)
    padded[:, 1:] = table[before[:-1], padded[:, 1:]]
    return padded.T.reshape(-1)[:n]


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def _cut(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points of the texts, each text with a separator behind it; which of them start a pre-token; where each text
    ends, its separator included). One scan runs over all texts."""
    of_class, table, image = monoid()
    code = codes("\0".join([*texts, ""]))
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    kind = classes()[code]
    kind[ends - 1] = BREAK
    state = image[_scan(of_class[kind], table)]
    before = np.concatenate([[S_DONE], state[:-1]])
    after = np.concatenate([state[1:], [S_DONE]])
    letter, blank = kind <= E, (kind == SPACE) | (kind == BLANK)
    contracted = (state == S_DONE) | (((state == S_QR) | (state == S_QV) | (state == S_QL)) & (after == S_DONE) & (np.append(kind[1:], BREAK) != BREAK))
    run_of_letters = (before == S_LETTER) | (before == S_QR) | (before == S_QV) | (before == S_QL)
    start = np.ones(len(kind), bool)
    start[letter & (run_of_letters | (before == S_SPACE) | contracted)] = False
    start[(kind == NUMBER) & ((before == S_NUMBER) | (before == S_SPACE))] = False
    start[((kind == QUOTE) | (kind == OTHER)) & ((before == S_OTHER) | (before == S_Q) | (before == S_SPACE))] = False
    followed = np.append(~blank[1:] & (kind[1:] != BREAK), False)
    start[blank & ((before == S_SPACE) | (before == S_BLANK)) & ~followed] = False
    start[ends - 1] = False
    return code, start, ends


def boundaries(texts: list[str]) -> list[np.ndarray]:
    """For each text the code-point offsets at which its pre-tokens start."""
    if not texts:
        return []
    _, start, ends = _cut(texts)
    at = np.flatnonzero(start)
    firsts = np.append(0, ends[:-1])
    return [x - f for x, f in zip(np.split(at, np.searchsorted(at, ends[:-1])), firsts.tolist(), strict=True)]


@dataclass
class Encoded:
    """The pre-tokens of a run of texts. at: byte offset at which each starts in the texts one after another, and where
    the last ends; edges: the number of each text's first pre-token, and of all; number: which distinct pre-token each
    is; ids, decimal, decoded: ids of each distinct one, these written out with a comma behind each, and their bytes."""

    at: np.ndarray
    edges: np.ndarray
    number: np.ndarray
    ids: list[bytes]
    decimal: list[bytes]
    decoded: list[bytes]

    def all_ids(self) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of the run, where those of each text begin and the last ends)."""
        width = np.fromiter(map(len, self.ids), np.int64, len(self.ids)) // 4
        ids, ends = spread(np.frombuffer(b"".join(self.ids), "<u4"), width, self.number)
        return ids, np.append(0, ends)[self.edges]

    def counts(self) -> np.ndarray:
        """The number of ids of each pre-token."""
        return (np.fromiter(map(len, self.ids), np.int64, len(self.ids)) // 4)[self.number]

    def written(self) -> list[memoryview]:
        """The ids of each text as decimal numbers, comma-joined."""
        data, ends = _taken(self.decimal, self.number)
        at = ends[self.edges].tolist()
        return [data[a : max(a, b - 1)] for a, b in zip(at, at[1:], strict=False)]


def _taken(values: list[bytes], number: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """(values one after another, by their numbers; where each begins and the last ends)."""
    found = pa.array(values, pa.large_binary()).take(pa.array(number))
    offsets = np.frombuffer(found.buffers()[1], np.int64)[: len(found) + 1]
    return memoryview(found.buffers()[2] or b""), offsets


class ByteBPE:
    """Ranks with an encoder, a decoder and a cache of merged pre-tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.bytes_of = ranks, {i: b for b, i in ranks.items()}
        self.cache = Recent(CACHE_ENTRIES)

    @classmethod
    def load(cls, path: str) -> ByteBPE:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())})

    def merge(self, piece: bytes) -> list[int]:
        """Lowest rank first, leftmost on ties; long pieces take a heap over linked parts and stay near linear."""
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return [whole]
        if len(piece) <= CACHED_LENGTH:
            get, none = ranks.get, len(ranks) + 1
            parts = [piece[i : i + 1] for i in range(len(piece))]
            pairs = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
            while pairs and (low := min(pairs)) < none:
                i = pairs.index(low)
                parts[i] += parts.pop(i + 1)
                del pairs[i]
                if i:
                    pairs[i - 1] = get(parts[i - 1] + parts[i], none)
                if i < len(pairs):
                    pairs[i] = get(parts[i] + parts[i + 1], none)
            return [ranks[p] for p in parts]
        n = len(piece)
        end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not alive[i] or j >= n or end[j] != stop or not alive[j]:
                continue
            alive[j], end[i] = False, stop
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := before[i]) >= 0 and (r := ranks.get(piece[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]

    def _learn(self, piece: bytes) -> tuple[bytes, bytes, bytes]:
        """(ids as little-endian 32-bit integers, ids written out with a comma behind each, bytes decoded from the ids)."""
        ids = self.merge(piece)
        decoded = self.decode(ids)
        found = struct.pack(f"<{len(ids)}I", *ids), b"".join([b"%d," % i for i in ids]), piece if decoded == piece else decoded
        if len(piece) <= CACHED_LENGTH:
            self.cache.put(piece, found)
        return found

    def encode_run(self, texts: list[str]) -> Encoded:
        """The pre-tokens of some texts, encoded together."""
        code, start, ends = _cut(texts)
        data = "".join(texts).encode("utf-8", "replace")
        if len(data) == len(code) - len(texts):
            wide = np.ones(len(code), np.int8)
        else:
            wide = 1 + (code >= 0x80).astype(np.int8) + (code >= 0x800) + (code >= 0x10000)
            wide[(code >= 0xD800) & (code < 0xE000)] = 1  # a lone surrogate is written as a question mark
        wide[ends - 1] = 0
        starts = np.flatnonzero(start)
        at = np.append((np.cumsum(wide, dtype=np.int64) - wide)[starts], len(data))
        slices = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)])
        numbered = slices.dictionary_encode()
        distinct = numbered.dictionary.to_pylist()
        known = self.cache.find(distinct)
        if None in known:
            known = [self._learn(piece) if found is None else found for piece, found in zip(distinct, known, strict=True)]
        edges = np.append(0, np.searchsorted(starts, ends))
        ids, decimal, decoded = map(list, zip(*known, strict=True)) if known else ([], [], [])
        return Encoded(at, edges, numbered.indices.to_numpy().astype(np.int64), ids, decimal, decoded)

    @staticmethod
    def decode_run(run: Encoded) -> list[memoryview]:
        """The bytes of each text, from the ids of its pre-tokens put at their kept offsets."""
        data, ends = _taken(run.decoded, run.number)
        if not np.array_equal(ends, run.at):
            raise ValueError("the bytes of the pre-tokens do not meet at their offsets")
        at = run.at[run.edges].tolist()
        return [data[a:b] for a, b in zip(at, at[1:], strict=False)]

    def encode_batch(self, texts: list[str]):
        """For each text (ids, byte offset at which each pre-token starts, number of ids of each pre-token, the bytes
        decoded by these)."""
        for some in in_runs(texts):
            run = self.encode_run(some)
            ids, at = run.all_ids()
            counts, decoded = run.counts(), self.decode_run(run)
            for k in range(len(some)):
                first, last = run.edges[k], run.edges[k + 1]
                yield ids[at[k] : at[k + 1]].tolist(), run.at[first:last] - run.at[first], counts[first:last], bytes(decoded[k])

    def encode(self, text: str) -> list[int]:
        return self.encode_run([text]).all_ids()[0].tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode_piece(self, ids: list[int], counts: np.ndarray, k: int) -> bytes:
        """The bytes of pre-token k alone, by the kept counts."""
        first = int(counts[:k].sum())
        return self.decode(ids[first : first + int(counts[k])])


@lru_cache(4)
def loaded(path: str) -> ByteBPE:
    return ByteBPE.load(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ids, byte offset and number of ids of each pre-token, and the bytes decoded back."""

    @F.pandas_udf("ids array<int>, piece_start array<long>, piece_ids array<long>, decoded binary")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(list(loaded(path).encode_batch([t or "" for t in texts])), columns=["ids", "piece_start", "piece_ids", "decoded"])

    return docs.select(F.col(id_col), run(F.col(text_col)).alias("found")).select(id_col, "found.*")


def digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per input row: id, n_tokens, digests of the ids and of the bytes decoded from them; with_ids adds ids.

    What comes of a run of texts is handed on before the next is encoded, so a task never holds the ids of a whole batch."""
    kinds = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"} | ({"ids": "array<int>"} if with_ids else {})
    given = docs.select(F.col(id_col), F.col(text_col).alias(f"{id_col}_text"))
    schema = f"`{id_col}` {given.schema[0].dataType.simpleString()}, " + ", ".join(f"{name} {kind}" for name, kind in kinds.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            settle()
            first = 0
            for some in in_runs([t or "" for t in batch.column(1).to_pylist()], RUN_CHARS):
                found = bpe.encode_run(some)
                ids, at = found.all_ids()
                digests = [pa.array([hashlib.sha256(x).hexdigest() for x in of], pa.string()) for of in (found.written(), bpe.decode_run(found))]
                lists = [pa.ListArray.from_arrays(pa.array(np.asarray(at, np.int32)), pa.array(ids.astype(np.int32)))] if with_ids else []
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(some)), pa.array(np.diff(at).astype(np.int64)), *digests, *lists], names=[id_col, *kinds])
                first += len(some)

    return given.mapInArrow(run, schema)
