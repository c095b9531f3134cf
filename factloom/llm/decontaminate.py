"""Benchmark decontamination by a broadcast hash set of normalised test n-grams, on DataFrame functions only.

Texts are lower-cased over A-Z and cut into words. A window is `size` consecutive words of an item, or all words of a
shorter item. A gram is GRAM consecutive words of a window (all of a shorter one). Any occurrence of a window of n words
covers exactly one gram that starts at a multiple of n - GRAM + 1, so training texts are scanned at those positions
alone; the set holds the hashes of all grams of the windows and is broadcast. Around each position that meets the set,
the windows that cover it are cut out and verified by their words, which leaves no occurrence out and adds none.

The set is counted before it is broadcast. Up to SET_GRAMS hashes go at once; a larger set goes in blocks of so many,
each scanned for by itself, so the search is the same at every size.

What is found belongs to a text and travels under two 64-bit hashes of it, so copies of a text are verified once, and
whole texts are neither shuffled nor grouped by. Rows take their result from there by those hashes.

Cases: a null text has no words; rows that are equal, or share an id, each get their own result; a null id is kept; an
item whose text is null or has no words has no window; an item with a null id counts as hit and is left out of the
items alone; an empty benchmark leaves all documents clean; other columns are ignored by `contamination` and kept by
`remove_documents` and `remove_spans`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import materialise

SIZE, GRAM = 10, 5
#: Hashes of grams that are broadcast at once: some 100 MB as a hash table.
SET_GRAMS = 2_000_000
#: Texts with hits up to which their results are broadcast to the rows.
BROADCAST_HITS, BROADCAST_BYTES = 500_000, 64 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Between words, after lower-casing.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word, or what stands between words, in a text as it is.
PIECES = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """A-Z lower-cased; pure ASCII takes the faster built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words_of(text: Column) -> Column:
    return F.filter(F.split(lowered(F.coalesce(text, F.lit(""))), BETWEEN), lambda w: w != "")


def keys_of(text: Column) -> list[Column]:
    """Two independent hashes that stand for a text."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def windows(benchmark: DataFrame, size: int = SIZE, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, length, hash, words): the distinct windows of each item."""
    words = benchmark.select(F.col(id_col).alias("item"), words_of(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    cut = words.withColumn("length", F.least(F.lit(size), F.size("w")))
    every = F.transform(F.sequence(F.lit(0), F.size("w") - F.col("length")), lambda i: _part("w", i, i + F.col("length")))
    at = cut.select("item", "length", F.explode(every).alias("window"))
    return at.select("item", "length", F.xxhash64("window").alias("hash"), F.array_join("window", " ").alias("words")).distinct()


def _part(words: Column | str, start: Column, end: Column) -> Column:
    """The words from start up to end, each taken by its place: `slice` would copy all words of a text for each call."""
    return F.transform(F.sequence(start, end - 1), lambda i: F.get(words, i))


def _grams(benched: DataFrame) -> DataFrame:
    """(length, gram): the distinct hashes of the grams of all windows of a length."""
    width = F.least(F.lit(GRAM), F.col("length"))
    cut = benched.select("length", F.split("words", " ").alias("w")).withColumn("width", width)
    hashes = F.transform(F.sequence(F.lit(0), F.col("length") - F.col("width")), lambda i: F.xxhash64(F.slice("w", i + 1, F.col("width"))))
    return cut.select("length", F.explode(hashes).alias("gram")).distinct()


def _positions(words: Column, length: int) -> Column:
    """(length, at, gram, first, near) at every position of a text that a window of that length cannot pass by; near: the
    words from `first` on that windows around the position can hold."""
    width = min(GRAM, length)
    n = F.size(words)
    starts = F.when(n >= length, F.sequence(F.lit(0), n - width, F.lit(length - width + 1))).otherwise(F.array().cast("array<int>"))

    def at(i: Column) -> Column:
        first = F.greatest(F.lit(0), i + width - length)
        gram = F.xxhash64(F.array(*[F.get(words, i + k) for k in range(width)]))
        return F.struct(F.lit(length).alias("length"), i.alias("at"), gram.alias("gram"), first.alias("first"), _part(words, first, F.least(n, i + length)).alias("near"))

    return F.transform(starts, at)


def _met(texts: DataFrame, lengths: list[int], grams: DataFrame) -> DataFrame:
    """(k1, k2, length, at, hash, words): windows of the texts that cover a gram of the set, each once a text. A position
    carries the words around it, not its text, so the work is linear in a text's length."""
    cut = texts.select(*keys_of(F.col("text")), words_of(F.col("text")).alias("w"))
    at = cut.select("k1", "k2", F.explode(F.concat(*[_positions(F.col("w"), n) for n in lengths])).alias("x")).select("k1", "k2", "x.*")
    met = at.join(F.broadcast(grams), ["length", "gram"], "left_semi")
    last = F.least(F.col("at"), F.col("first") + F.size("near") - F.col("length"))
    windows_near = F.transform(F.sequence(F.col("first"), last), lambda i: F.struct(i.alias("at"), F.slice("near", i - F.col("first") + 1, F.col("length")).alias("window")))
    spread = met.where(last >= F.col("first")).select("k1", "k2", "length", F.explode(windows_near).alias("x"))
    return spread.select("k1", "k2", "length", "x.at", F.xxhash64("x.window").alias("hash"), F.array_join("x.window", " ").alias("words")).distinct()


def hits_of_texts(texts: DataFrame, benchmark: DataFrame, size: int = SIZE, item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(k1, k2, hits, items), materialised: for each distinct text with a window of the benchmark the verified windows
    as (at, length), ascending, and the items that hold them, as sorted strings. texts: one column, text."""
    benched = materialise(windows(benchmark, size, item_col, item_text), "windows")
    grams = materialise(_grams(benched), "grams")
    counts = {r["length"]: r["n"] for r in grams.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `size` rows
    blocks = max(1, -(-sum(counts.values()) // SET_GRAMS))
    known = benched.select("length", "hash", "words").distinct()
    found = []
    for block in range(blocks):
        # By the hash each block has an equal part of the set; a tenth above it at the most is nothing to a broadcast.
        part = grams if blocks == 1 else grams.where(F.pmod(F.xxhash64("gram"), F.lit(blocks)) == block)
        met = _met(texts.where(F.col("text").isNotNull()), sorted(counts), part) if counts else None
        if met is not None:
            found.append(materialise(met.join(known, ["length", "hash", "words"], "left_semi"), "met"))
    if not found:
        none = texts.select(*keys_of(F.col("text"))).limit(0)
        return none.select("k1", "k2", F.array().cast("array<struct<at:int,length:int>>").alias("hits"), F.array().cast("array<string>").alias("items"))
    spots = reduce(DataFrame.unionByName, found)
    if blocks > 1:
        spots = spots.distinct()
    items = benched.where(F.col("item").isNotNull()).select("length", "hash", "words", F.col("item").cast("string").alias("item"))
    named = spots.join(items, ["length", "hash", "words"], "left")
    grouped = named.groupBy("k1", "k2").agg(F.sort_array(F.collect_set(F.struct("at", "length"))).alias("hits"), F.sort_array(F.collect_set("item")).alias("items"))
    return materialise(grouped, "hits")


def _handed(hits: DataFrame, *columns: str) -> DataFrame:
    """Some columns of the hits, broadcast where their number and size are small, which is counted first."""
    own = hits.select("k1", "k2", *columns)
    bytes_of = {"hits": F.size("hits") * 16, "items": F.length(F.array_join("items", ",")) + F.size("items") * 16}
    n, size = own.agg(F.count("*"), F.sum(sum([bytes_of[c] for c in columns], F.lit(16)))).first()
    return F.broadcast(own) if n <= BROADCAST_HITS and (size or 0) <= BROADCAST_BYTES else own


def covered(hits: Column) -> Column:
    """The number of words inside ascending (at, length) windows."""
    return F.aggregate(
        hits, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["at"] + x["length"] - F.greatest(a["end"], x["at"].cast("long")))).alias("n"), F.greatest(a["end"], (x["at"] + x["length"]).cast("long")).alias("end")),
        lambda a: a["n"],
    )


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per input row: id, n_words, n_hit, items (sorted strings), hits (distinct (at, length) of verified
    windows, ascending)."""
    text = F.col(text_col)
    hits = hits_of_texts(docs.select(text.alias("text")), benchmark, size, item_col, item_text)
    rows = docs.select(F.col(id_col).alias("id"), F.size(words_of(text)).cast("long").alias("n_words"), *keys_of(text))
    out = rows.join(_handed(hits, "hits", "items"), ["k1", "k2"], "left")
    spots = F.coalesce("hits", F.array().cast("array<struct<at:int,length:int>>"))
    return out.select(F.col("id").alias(id_col), "n_words", covered(spots).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), spots.alias("hits"))


def _keyed(docs: DataFrame, text_col: str) -> tuple[DataFrame, list[str]]:
    """docs with the two hashes of the text, under names that docs has not."""
    end = "_" * max(map(len, docs.columns))
    names = [f"k1{end}", f"k2{end}"]
    return docs.withColumns(dict(zip(names, keys_of(F.col(text_col)), strict=True))), names


def remove_documents(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of docs that hold no window of the benchmark, all columns."""
    hits = _handed(hits_of_texts(docs.select(F.col(text_col).alias("text")), benchmark, size, item_col, item_text))
    rows, names = _keyed(docs, text_col)
    return rows.join(hits, reduce(lambda a, b: a & b, [rows[n] == hits[k] for n, k in zip(names, ("k1", "k2"), strict=True)]), "left_anti").drop(*names)


def remove_spans(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """All rows of docs with the words of hit windows cut out of the text, all columns; what stands between them stays."""
    found = _handed(hits_of_texts(docs.select(F.col(text_col).alias("text")), benchmark, size, item_col, item_text), "hits")
    rows, names = _keyed(docs, text_col)
    spots = f"hits{names[0][2:]}"
    hits = found.select(F.col("k1").alias(f"other_{names[0]}"), F.col("k2").alias(f"other_{names[1]}"), F.col("hits").alias(spots))
    met = rows.join(hits, reduce(lambda a, b: a & b, [rows[n] == hits[f"other_{n}"] for n in names]), "left")
    text = F.col(text_col)
    pieces = F.regexp_extract_all(text, F.lit(PIECES), F.lit(0))
    first = F.when(text.rlike(r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"), 1).otherwise(0)
    hit = F.flatten(F.transform(spots, lambda x: F.transform(F.sequence(x["at"], x["at"] + x["length"] - 1), lambda i: first + 2 * i)))
    kept = F.array_except(F.sequence(F.lit(0), F.size(pieces) - 1), hit)
    cut = F.when(F.col(spots).isNotNull(), F.array_join(F.transform(kept, lambda i: F.get(pieces, i)), "")).otherwise(text)
    return met.select(*[cut.alias(c) if c == text_col else F.col(c) for c in docs.columns])
