"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are partitioned by the size of their shingle sets. In a partition whose largest size is u, a document that holds
the share t of an item misses at most u - ceil(t u) of its shingles, so of the item's u - ceil(t u) + 1 smallest hashes
(its MinHash sketch in that partition) it must hold at least one: the search loses nothing. An item of fewer words than a
shingle is one shingle of its own length, which documents are searched for too, so that it is found inside a long document.

Sketches are a table (hash, item). Documents stream through once, past a filter of the sketches' hashes (`FILTER_BYTES` at most,
sent to every task); what may be in it is joined to the sketches by hash, and pairs found so are verified on the words
themselves. The filter only saves rows: a fuller one lets more of them through to the join. Texts of documents without a
hash in the filter never move.
"""

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.llm.common import blocks_of_texts, bounded_batches, lent, stored, unused

SHINGLE_WORDS = 5
MIN_CONTAINMENT = 0.8
#: The filter has BITS_PER_HASH bits a hash, up to FILTER_BYTES; CHUNK bytes of it are filled together.
FILTER_BYTES, BITS_PER_HASH, CHUNK = 16 << 20, 64, 1 << 17

_BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_BASE = 0x9E3779B97F4A7C15
_ODD = tuple(np.uint64(x) for x in (0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0xA24BAED4963EE407))
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(32))


class WordHashes:
    """Hashes of all words of a buffer from one running sum: sum of b[i] B^i, divided by B^start, modulo 2^64."""

    def __init__(self):
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self.powers):
            n = max(n, 1 << 18)
            for name, base in (("powers", _BASE), ("inverses", pow(_BASE, -1, 1 << 64))):
                factors = np.full(n, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))

    def __call__(self, buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Start of each word and its hash, in order."""
        data = np.frombuffer(buffer, np.uint8)
        self._grow(len(data) + 1)
        word = np.zeros(len(data) + 2, bool)
        word[1:-1] = ~_BLANK[data]
        edges = np.flatnonzero(word[1:] != word[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=sums[1:])
        return starts, _mixed((sums[ends] - sums[starts]) * self.inverses[starts])


def _factors(words: int) -> np.ndarray:
    return np.multiply.accumulate(np.full(words + 1, 0xBF58476D1CE4E5B9, np.uint64))[:words]


def gram_hashes(texts: list[bytes], sizes: list[int], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, hash) of each sequence of so many words, for each of the sizes."""
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    starts, h = hashes(b"\n".join(texts))
    text = np.searchsorted(np.cumsum(lengths), starts, side="right")
    found, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for size in sizes:
        n, factors = len(h) - size + 1, _factors(size)
        if n > 0:
            inside = np.flatnonzero(text[:n] == text[size - 1 :])
            found.append(_mixed(sum((h[inside + j] * factors[j] for j in range(size)), np.full(len(inside), size, np.uint64))))
            owners.append(text[inside])
    return np.concatenate(owners), np.concatenate(found)


def shingle_set(text: bytes, size: int) -> set[bytes]:
    words = text.split()
    return {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}


def _size(text: bytes, words: int) -> int:
    """Words of a shingle of an item: its own number of words, if it has fewer."""
    return min(words, len(text.split(None, words)))


def _normal(text: str | None) -> bytes:
    return text.encode().lower() if text else b""  # bytes.lower() changes A-Z only


def _sketched(batches: Iterator[pd.DataFrame], words: int, least: float) -> Iterator[pd.DataFrame]:
    """(hash, size, item) of the smallest hashes of each item's shingles."""
    hashes, share = WordHashes(), Fraction(str(least))
    for batch in batches:
        rows: list[pd.DataFrame] = []
        for item, text in zip(batch["item"], batch["text"], strict=True):
            text = _normal(text)
            size = _size(text, words)
            if size:
                n = len(shingle_set(text, size))
                upper = 1 << (n - 1).bit_length()  # the partition of sizes up to the next power of two
                kept = np.unique(gram_hashes([text], [size], hashes)[1])[: upper - math.ceil(share * upper) + 1]
                rows.append(pd.DataFrame({"hash": kept.view(np.int64), "size": size, "item": item}))
        if rows:
            yield pd.concat(rows, ignore_index=True)


def _filled(rows: pd.DataFrame) -> pd.DataFrame:
    """The bytes of one chunk of the filter."""
    bits = np.zeros(CHUNK, np.uint8)
    at = rows["place"].to_numpy() % (8 * CHUNK)
    np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return pd.DataFrame({"chunk": rows["chunk"].iloc[:1], "bits": [bits.tobytes()]})


def _place(hashes: np.ndarray, size: int, k: int) -> np.ndarray:
    return ((hashes * _ODD[k]) >> np.uint64(64 - 3 - (size.bit_length() - 1))).astype(np.int64)


def _places(hashes: np.ndarray, size: int) -> list[np.ndarray]:
    """The bits of each hash in a filter of so many bytes, a power of two."""
    return [_place(hashes, size, k) for k in range(len(_ODD))]


def _maybe(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which of the hashes the filter may hold, by their numbers."""
    near = np.arange(len(hashes))
    for k in range(len(_ODD)):
        at = _place(hashes[near], len(bits), k)
        near = near[((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)]
    return near


def hash_filter(hashes: DataFrame) -> np.ndarray:
    """The filter of the column `hash`, at most `FILTER_BYTES`."""
    n = hashes.count()
    size = min(FILTER_BYTES, max(CHUNK, 1 << max(0, n * BITS_PER_HASH // 8 - 1).bit_length()))

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            place = np.unique(np.concatenate(_places(batch["hash"].to_numpy(np.int64).view(np.uint64), size)))
            yield pd.DataFrame({"chunk": place // (8 * CHUNK), "place": place})

    rows = hashes.mapInPandas(placed, "chunk long, place long").distinct()
    bits = np.zeros(size, np.uint8)
    for row in rows.groupBy("chunk").applyInPandas(_filled, "chunk long, bits binary").toLocalIterator():
        bits[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["bits"], np.uint8)
    return bits


def _hits(bits: np.ndarray, sizes: list[int]):
    """A function of a text column: the hashes of its shingles that the filter may hold, each once."""

    @F.pandas_udf("array<long>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = WordHashes()
        for texts in lent(batches):
            texts, out = [_normal(t) for t in texts], []
            for a, b in blocks_of_texts(texts, 1 << 18):
                owner, h = gram_hashes(texts[a:b], sizes, hashes)
                near = _maybe(h, bits)
                owner, h = owner[near], h[near].view(np.int64)
                order = np.argsort(owner, kind="stable")
                ends = np.cumsum(np.bincount(owner, minlength=b - a))[:-1]
                out += [np.unique(x) if len(x) else None for x in np.split(h[order], ends)]
            yield pd.Series(out, dtype=object)

    return found


def _shared(words: int):
    """A function of document and item texts: (shingles of the item, those the document holds)."""

    @F.pandas_udf("struct<n_shingles:long,n_shared:long>")
    def counted(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, items in lent(batches):
            rows, last, held = [], None, {}
            for text, item in zip(texts, items, strict=True):
                if text is not last and text != last:  # rows of one document stand together
                    last, held = text, {}
                item = _normal(item)
                size = _size(item, words)
                if size not in held:
                    held[size] = shingle_set(_normal(text), size)
                own = shingle_set(item, size)
                rows.append((len(own), len(own & held[size])))
            yield pd.DataFrame(rows, columns=["n_shingles", "n_shared"])

    return counted


def _texts(items: DataFrame, item_text: str) -> DataFrame:
    """(item, text): the distinct texts of the items, named by 128 bits of hash."""
    text = F.col(item_text)
    name = F.concat_ws(":", F.xxhash64(text), F.xxhash64(F.lit(1), text))
    return items.where(text.isNotNull()).select(name.alias("item"), text.alias("text")).dropDuplicates(["item"])


def _held(rows: DataFrame, items: DataFrame, words: int, least: float) -> DataFrame:
    """(doc, item, n_shingles, n_shared) of the rows (doc, text) that hold an item (item, text) to the share `least`."""
    spark = rows.sparkSession
    sketched = items.mapInPandas(lambda b: _sketched(b, words, least), "hash long, size int, item string")
    sketches = stored(spark, sketched)
    sizes = sorted(r["size"] for r in sketches.select("size").distinct().collect())  # at most `words` of them
    hits = _hits(hash_filter(sketches.select("hash").distinct()), sizes)
    near = rows.withColumn("hits", hits("text")).where(F.size("hits") > 0)
    near = stored(spark, near.withColumn("row", F.monotonically_increasing_id()))
    pairs = near.select("row", F.explode("hits").alias("hash")).join(sketches.select("hash", "item"), "hash")
    pairs = stored(spark, pairs.select("row", "item").distinct())
    both = near.select("row", "doc", "text").join(pairs, "row").join(items.withColumnRenamed("text", "own"), "item")
    both = both.sortWithinPartitions("row").withColumn("n", _shared(words)("text", "own")).select("doc", "item", "n.*")
    share = Fraction(str(least))
    return both.where(F.col("n_shared") * share.denominator >= F.col("n_shingles") * share.numerator)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    words: int = SHINGLE_WORDS,
    least: float = MIN_CONTAINMENT,
) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment) for each document row that holds at least the share `least` of
    the distinct shingles of an item row.

    Words are runs of anything but ASCII white space, with A-Z lower-cased; a shingle is `words` of them in sequence, and
    an item of fewer words is one shingle of all its words, held by every document in which they stand in sequence. Texts
    that are null or have no word hold nothing and are held by nothing. Null ids pass through, repeated rows give repeated
    results, other columns are ignored, and an empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    text = F.col(item_text)
    name = F.concat_ws(":", F.xxhash64(text), F.xxhash64(F.lit(1), text)).alias("item")
    rows = docs.select(F.col(doc_id).alias("doc"), F.col(doc_text).alias("text"))
    held = _held(rows, stored(spark, _texts(items, item_text)), words, least)
    found = held.join(items.select(name, F.col(item_id).alias("item_id")), "item")
    share = (F.col("n_shared") / F.col("n_shingles")).alias("containment")
    return found.select(F.col("doc").alias("doc_id"), "item_id", "n_shingles", "n_shared", share)


def decontaminate(
    docs: DataFrame, items: DataFrame, doc_text: str = "text", item_text: str = "text",
    words: int = SHINGLE_WORDS, least: float = MIN_CONTAINMENT,
) -> DataFrame:
    """The rows of `docs`, with all their columns, that hold no item; see `contaminated` for the terms.

    Only the hashes of the texts that hold an item are joined back.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.struct(F.xxhash64(doc_text).alias("a"), F.xxhash64(F.lit(1), doc_text).alias("b")).alias("doc"), F.col(doc_text).alias("text"))
    held = _held(rows, stored(spark, _texts(items, item_text)), words, least)
    a, b = unused(docs, "__a", "__b")
    held = stored(spark, held.select(F.col("doc.a").alias(a), F.col("doc.b").alias(b)).distinct())
    same = (F.xxhash64(docs[doc_text]) == held[a]) & (F.xxhash64(F.lit(1), docs[doc_text]) == held[b])
    return docs.join(held, same, "left_anti")
