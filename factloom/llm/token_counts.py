"""Token counts under a unigram model, with forward scores shared in a trie.

The distinct pre-tokens of a batch go into a trie. A node's forward score is the best score of any segmentation of its
prefix into pieces: the maximum over pieces that end there of the score of the node where the piece starts plus the
piece's own. It is computed once, when the node is made, however many pre-tokens share the prefix, together with the
number of pieces of that segmentation; the node where a pre-token ends stores its count. Nodes are made down to DEPTH
characters; a longer pre-token shares its prefix down to there, and the recurrence goes on from that node without nodes.

Pieces are those of a public sentencepiece vocabulary, which is never trained here; a piece's log-probability follows
Zipf's law over its rank in that vocabulary, log(1 / (rank + 1)) - log(H_n), in whole millionths so that sums are exact.
A character that is no piece costs as many byte pieces as it has bytes. Of segmentations with equal scores the one with
fewer pieces counts.

Cases: a null or empty text has no pre-token and the count 0; a pre-token of any length is taken whole; repeated rows
each get their own result; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import gc
import math
import re
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import Recent, in_runs, settle

#: Pre-tokens are runs without white space, each led by the vocabulary's word mark. White space beyond these six ASCII
#: characters is made a space first.
FURTHER_SPACE = re.compile(r"[^\S\t-\r\x20]")
MARK = "▁"
#: Trie nodes kept between batches; the depth down to which nodes are made; the longest pre-token whose count is kept.
MAX_NODES, DEPTH, CACHED_LENGTH = 400_000, 2048, 48
#: Counts kept, beyond the nodes that they came from; characters of the texts that are counted together.
MAX_COUNTS, RUN_CHARS = 300_000, 2 << 20
#: Scores are whole numbers of this part of a nat.
UNIT = 1_000_000
#: Below any score.
NEVER = -(1 << 62)


class Pieces:
    """Scores by piece, the longest piece, and the score of a byte piece."""

    def __init__(self, pieces: list[str], byte_ranks: list[int]):
        total = math.log(sum(1 / (r + 1) for r in range(len(pieces) + len(byte_ranks))))
        score = lambda rank: round(UNIT * (-math.log(rank + 1) - total))
        self.score = {p: score(r) for r, p in enumerate(pieces) if p}
        self.longest = max(map(len, self.score), default=1)
        self.byte = score(byte_ranks[-1] if byte_ranks else len(pieces))

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        names = ["" if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) else sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        return cls(names, [i for i in range(sp.get_piece_size()) if sp.is_byte(i)])


class Trie:
    """Nodes with children, forward score, pieces of the best segmentation; terminal counts by pre-token.

    A node also holds the pieces under way at it: (state in the trie of pieces, score and count where the piece starts),
    so that a child looks at those only."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.step: dict[int, int] = {}
        self.value: list[int | None] = [None]
        for piece, score in pieces.score.items():
            state = 0
            for c in piece:
                key = state << 21 | ord(c)
                if key not in self.step:
                    self.step[key] = len(self.value)
                    self.value.append(None)
                state = self.step[key]
            self.value[state] = score
        self.terminal = Recent(MAX_COUNTS)
        self.reset()

    def reset(self) -> None:
        """Drops the nodes; the counts of pre-tokens stay."""
        self.child: dict[int, int] = {}
        self.best: list[int] = [0]
        self.count: list[int] = [0]
        self.under: list[list[tuple[int, int, int]]] = [[]]

    def insert(self, text: str) -> int:
        """The token count of a pre-token, by the nodes of its prefix that are there and new ones below them."""
        if len(self.best) > MAX_NODES:
            self.reset()
        child, at, done = self.child, 0, 0
        for c in text:
            node = child.get(at << 21 | ord(c))
            if node is None:
                break
            at = node
            done += 1
        count = self._grow(at, text[done:], DEPTH - done) if done < len(text) else self.count[at]
        if len(text) <= CACHED_LENGTH:
            self.terminal.put(text, count)
        return count

    def _grow(self, at: int, rest: str, nodes: int) -> int:
        """Makes up to so many nodes below `at`, each with its forward score from the pieces that end at it, and goes on
        without nodes from there; returns the count at the end."""
        step, value, single, byte = self.step.get, self.value, self.pieces.score, self.pieces.byte
        child, bests, counts, unders = self.child, self.best, self.count, self.under
        best, count, under = bests[at], counts[at], unders[at]
        for c in rest:
            code, top, least, now = ord(c), NEVER, 0, []
            for state, score, n in (*under, (0, best, count)):
                state = step(state << 21 | code)
                if state is None:
                    continue
                now.append((state, score, n))
                own = value[state]
                if own is not None:
                    own += score
                    if own > top or (own == top and n + 1 < least):
                        top, least = own, n + 1
            if c not in single:
                width = len(c.encode("utf-8", "replace"))
                own = best + width * byte
                if own > top or (own == top and count + width < least):
                    top, least = own, count + width
            if nodes > 0:
                nodes -= 1
                node = child[at << 21 | code] = len(bests)
                bests.append(top)
                counts.append(least)
                unders.append(now)
                at = node
            best, count, under = top, least, now
        return count


def plain_count(text: str, pieces: Pieces) -> int:
    """The recurrence for one pre-token without any sharing, for tests."""
    best = [(0, 0)]
    for i in range(1, len(text) + 1):
        own = [(best[j][0] + pieces.score[text[j:i]], best[j][1] - 1) for j in range(i) if text[j:i] in pieces.score]
        if text[i - 1] not in pieces.score:
            width = len(text[i - 1].encode("utf-8", "replace"))
            own.append((best[i - 1][0] + width * pieces.byte, best[i - 1][1] - width))
        best.append(max(own))
    return -best[-1][1]


@lru_cache(2)
def shared_trie(path: str) -> Trie:
    return Trie(Pieces.load(path))


def count_run(texts: list[str], trie: Trie) -> tuple[np.ndarray, np.ndarray]:
    """(pre-tokens, tokens) of each text. Arrow cuts the texts into words and numbers the distinct ones, so that the
    trie meets each of them once a run."""
    plain = [t if t.isascii() and not FURTHER_SPACE.search(t) else FURTHER_SPACE.sub(" ", t) for t in texts]
    words = pc.ascii_split_whitespace(pa.array(plain, pa.large_string()))
    numbered = words.values.dictionary_encode()
    distinct = numbered.dictionary.to_pylist()
    marked = [MARK + w if w else "" for w in distinct]
    known = trie.terminal.find(marked)
    found = np.fromiter((trie.insert(w) if n is None else n for w, n in zip(marked, known, strict=True)), np.int64, len(distinct))
    number, edges = numbered.indices.to_numpy(), words.offsets.to_numpy()
    total = lambda x: np.diff(np.append(0, np.cumsum(x[number]))[edges])
    return total(np.fromiter(map(bool, distinct), np.int64, len(distinct))), total(found)


def counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words (pre-tokens), n_tokens."""

    @F.pandas_udf("n_words long, n_tokens long")
    def run(texts: pd.Series) -> pd.DataFrame:
        settle()
        trie, rows = shared_trie(path), []
        gc.disable()  # the trie has no cycles, and looking for some grows with it
        try:
            for some in in_runs([t or "" for t in texts], RUN_CHARS):
                rows += zip(*map(np.ndarray.tolist, count_run(some, trie)), strict=True)
        finally:
            gc.enable()
        return pd.DataFrame(rows, columns=["n_words", "n_tokens"])

    return docs.select(F.col(id_col), run(F.col(text_col)).alias("found")).select(id_col, "found.*")
