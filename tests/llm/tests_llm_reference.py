"""The pipeline's result by plain loops over a small table."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib

import public_tokenizers as P
import tiktoken
from test_decontaminate import brute as contaminated
from test_secrets import brute as spans
from test_secrets import plain_spans
from test_simhash import plain, reachable


def features(text):
    """Hashes of the words and of their first letters."""
    out = set()
    for w in re.findall(r"[^\W\d_]+", (text or "").lower()):
        out |= {zlib.crc32(n.encode("utf-8", "replace")) % (1 << 18) for n in [f"={w}", *(f"^{w[:k]}" for k in (4, 5, 6) if len(w) > k)]}
    return out


def redacted(text):
    """Base spans by the contract's patterns, others by plain counts; spans that touch are one mark."""
    base = [(int(s), int(e), k) for k, s, e in (x.split(":") for x in spans(text).split(",") if x)]
    out, at = "", 0
    for s, e in sorted((s, e) for s, e, _ in base + plain_spans(text, base)):
        if e > at:
            out, at = out + (text[at:s] + "[SECRET]" if s >= at else ""), e
    return out + text[at:]


def brute_pipeline(docs, bench, model):
    weight = dict(zip(model.index.tolist(), model.weight.tolist(), strict=True))
    z = lambda t: max(-30.0, min(30.0, model.bias + sum(weight.get(f, 0.0) for f in features(t))))
    docs = [d for d in docs if 1 / (1 + math.exp(-z(d["text"]))) < 0.7]
    fps = [plain(d["text"]) for d in docs]
    low = reachable([d["doc_id"] for d in docs], fps)
    docs = [d for d, c in zip(docs, low, strict=True) if d["doc_id"] == c]
    items = [(b["item_id"], b["text"]) for b in bench]
    docs = [d for d in docs if not contaminated(d["text"], items)[1]]
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}, special_tokens={})
    out = {}
    for d in docs:
        text = redacted(d["text"] or "")
        assert not re.search(r"[0-9a-f]{24}", text)
        ids = library.encode_ordinary(text)
        out[d["doc_id"]] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    return out
