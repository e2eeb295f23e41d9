"""Spelling variants by Bloom-guided neighbourhoods.

Every word generates its edits of one code point. An edit is looked up in a blocked Bloom filter of the vocabulary, sharded by
word length and sent to all tasks; only what the filter may hold is shuffled, to an exact join with the vocabulary, which
removes the false positives. Being near is mutual, so a word generates its deletions, and replacements by later characters:
the insertions and the other replacements are generated from the other side.

Hashes of edits are not computed from their texts: a word's hash combines one number per place and character, so that an edit
costs one or two operations. A filter is filled in ranges of blocks, and as many ranges as `FILTER_BYTES` allows are sent at a
time; a larger vocabulary takes more passes, each over the lengths it is about.
"""

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.llm.common import stored
from ringledger.llm.line_dedup import LOWER, UPPER

RUN = "[A-Za-zÀ-ÿ]+"
MIN_CHARS, MIN_COUNT, TIMES = 5, 3, 2
DIVISOR = 97
#: What a pass sends to every task, bits of the filter per word and bits set for a word.
FILTER_BYTES = 16 << 20
BITS_PER_WORD, BITS_SET = 24, 5
#: Blocks (of 64 bits) that are filled together; words of this many code points or more share a shard.
CHUNK_BITS, LONG = 12, 64
#: Edits that are held at a time.
EDITS = 1 << 20

_LOW = np.uint64(0xFFFFFFFF)


def runs(text: Column) -> Column:
    """Maximal runs of letters; none in a null text."""
    return F.regexp_extract_all(text, F.lit(RUN), F.lit(0))


def _lowered(run: Column) -> Column:
    """A-Z lower-cased; on ASCII, `lower` is the same as the slower `translate`."""
    return F.when(F.octet_length(run) == F.char_length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))


def damaged(run: Column, doc_id: Column) -> Column:
    """The run, without one code point where 97 divides the crc32 of `<doc_id>:<run>`; a null id is empty text."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    cut = F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.char_length(run)))
    return F.when(h % DIVISOR == 0, cut).otherwise(run)


def vocabulary(words: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of a table of words (`word`), one row per occurrence."""
    counted = words.where(F.char_length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= min_count)


# -- hashes


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit number for each number."""
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _parts(places: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The number of a character at a place."""
    return _mixed((places.astype(np.uint64) << np.uint64(8)) + codes + np.uint64(1))


def _of_length(length: int) -> np.uint64:
    return _mixed(np.array([(1 << 62) + length], dtype=np.uint64))[0]


def _codes(words: list[str]) -> np.ndarray:
    """Words of one length as rows of code points, which are all below 256."""
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), -1)


def _by_length(words: pd.Series) -> Iterator[tuple[int, np.ndarray, list[str]]]:
    """(length, places in the series, words) of the words of each length, no more together than `EDITS` characters."""
    lengths = words.str.len().to_numpy()
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        step = max(1, EDITS // int(length))
        for k in range(0, len(at), step):
            part = at[k : k + step]
            yield int(length), part, words.iloc[part].tolist()


def _hashes(codes: np.ndarray) -> np.ndarray:
    length = codes.shape[1]
    return np.bitwise_xor.reduce(_parts(np.arange(length), codes), axis=1) ^ _of_length(length)


def _block(hashes: np.ndarray, blocks: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)


def _bit(hashes: np.ndarray, k: int) -> np.ndarray:
    return ((hashes & _LOW) >> np.uint64(6 * k)) & np.uint64(63)


def _masks(hashes: np.ndarray) -> np.ndarray:
    masks = np.zeros(len(hashes), dtype=np.uint64)
    for k in range(BITS_SET):
        masks |= np.uint64(1) << _bit(hashes, k)
    return masks


# -- filters


def _shard(length: int) -> int:
    return min(length, LONG)


def _marks(batches: Iterator[pd.DataFrame], blocks: dict[int, int], chunk_bits: int) -> Iterator[pd.DataFrame]:
    """(shard, chunk, block, mask) of each word."""
    for batch in batches:
        for length, _, words in _by_length(batch["word"]):
            hashes = _hashes(_codes(words))
            at = _block(hashes, blocks[_shard(length)]).astype(np.int64)
            columns = {"shard": _shard(length), "chunk": at >> chunk_bits, "block": at, "mask": _masks(hashes).view(np.int64)}
            yield pd.DataFrame(columns)


def _filled(rows: pd.DataFrame) -> pd.DataFrame:
    """The bits of one chunk of blocks, from the first block with a word to the last."""
    at = rows["block"].to_numpy()
    start = int(at.min())
    at = at - start
    bits = np.zeros(int(at.max()) + 1, dtype=np.uint64)
    np.bitwise_or.at(bits, at, rows["mask"].to_numpy().view(np.uint64))
    ends = {c: rows[c].iloc[:1] for c in ("shard", "chunk")}
    return pd.DataFrame({**ends, "start": start, "bits": [bits.tobytes()]})


def _chunks(blocks: int) -> int:
    return -(-blocks >> CHUNK_BITS)


def _passes(blocks: dict[int, int]) -> list[list[tuple[int, int, int]]]:
    """Ranges of chunks (shard, from, to) in groups that `FILTER_BYTES` holds."""
    most = max(1, FILTER_BYTES >> (CHUNK_BITS + 3))
    passes, room = [], 0
    for shard, n in sorted(blocks.items()):
        at, end = 0, _chunks(n)
        while at < end:
            if not room:
                passes.append([])
                room = most
            to = min(end, at + room)
            passes[-1].append((shard, at, to))
            room -= to - at
            at = to
    return passes


def _read(filters: DataFrame, ranges: list[tuple[int, int, int]]) -> dict[int, tuple[int, np.ndarray]]:
    """First block and bits of each shard in a pass, at most `FILTER_BYTES` together."""
    wanted = F.lit(False)
    for shard, at, to in ranges:
        wanted = wanted | ((F.col("shard") == shard) & (F.col("chunk") >= at) & (F.col("chunk") < to))
    out = {s: (at << CHUNK_BITS, np.zeros((to - at) << CHUNK_BITS, dtype=np.uint64)) for s, at, to in ranges}
    for row in filters.where(wanted).toLocalIterator():
        first, bits = out[row["shard"]]
        filled = np.frombuffer(row["bits"], dtype=np.uint64)
        bits[row["start"] - first : row["start"] - first + len(filled)] = filled
    return out


def _maybe(hashes: np.ndarray, blocks: int, first: int, bits: np.ndarray) -> np.ndarray:
    """Places in `hashes` (flat) of what the filter may hold; hashes of other ranges are not there."""
    at = _block(hashes, blocks).astype(np.int64) - first
    if first or len(bits) < blocks:
        here = np.flatnonzero((at >= 0) & (at < len(bits)))
        at, hashes = at[here], hashes[here]
    else:
        here = None
    held = bits[at]
    passed = np.flatnonzero((held >> _bit(hashes, 0)) & np.uint64(1))
    for k in range(1, BITS_SET):
        passed = passed[((held[passed] >> _bit(hashes[passed], k)) & np.uint64(1)).astype(bool)]
    return passed if here is None else here[passed]


# -- edits


def _deletions(codes: np.ndarray, probe) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(rows, edits): the words without one character, as far as the filter may hold them. Of equal neighbours the first goes."""
    count, length = codes.shape
    places = np.arange(length)
    left = np.zeros((count, length + 1), dtype=np.uint64)
    right = np.zeros((count, length + 1), dtype=np.uint64)
    left[:, 1:] = np.bitwise_xor.accumulate(_parts(places, codes), axis=1)
    # characters behind the gap stand one place further left
    right[:, 1:length] = np.bitwise_xor.accumulate(_parts(places[:-1], codes[:, 1:])[:, ::-1], axis=1)
    hashes = left[:, :-1] ^ right[:, :length][:, ::-1] ^ _of_length(length - 1)
    found = probe(hashes.ravel())
    row, gap = np.divmod(found, length)
    own = (gap == 0) | (codes[row, gap] != codes[row, np.maximum(gap - 1, 0)])
    row, gap = row[own], gap[own]
    step = max(1, EDITS // length)
    for k in range(0, len(row), step):
        rows, gaps = row[k : k + step], gap[k : k + step]
        keep = np.arange(length) != gaps[:, None]
        text = codes[rows][keep].tobytes().decode("latin-1")
        yield rows, [text[i : i + length - 1] for i in range(0, len(text), length - 1)]


def _replacements(codes: np.ndarray, alphabet: np.ndarray, probe) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(rows, edits): the words with one character replaced by a later one, as far as the filter may hold them."""
    count, length = codes.shape
    whole, n = _hashes(codes), len(alphabet)
    step = max(1, EDITS // (length * n))  # words at a time
    wide = max(1, EDITS // (step * n))  # places at a time, all of them unless a word is very long
    for a in range(0, count, step):
        some = codes[a : a + step]
        for p in range(0, length, wide):
            places = np.arange(p, min(p + wide, length))
            now = some[:, p : p + wide]
            without = whole[a : a + step, None] ^ _parts(places, now)
            hashes = without[:, :, None] ^ _parts(places[:, None], alphabet)[None]
            found = probe(hashes.ravel())
            pair, letter = np.divmod(found, n)
            row, place = np.divmod(pair, len(places))
            later = alphabet[letter] > now[row, place]
            row, place, letter = row[later], place[later] + p, alphabet[letter[later]]
            most = max(1, EDITS // length)
            for k in range(0, len(row), most):
                part = slice(k, k + most)
                edits = some[row[part]]
                edits[np.arange(len(edits)), place[part]] = letter[part]
                text = edits.tobytes().decode("latin-1")
                yield a + row[part], [text[i : i + length] for i in range(0, len(text), length)]


def _probed(batches, blocks: dict[int, int], filters: dict, alphabet: np.ndarray, min_chars: int) -> Iterator[pd.DataFrame]:
    """(word, n, edit) of the edits of each word that the filters of this pass may hold."""

    def probe_of(length: int):
        shard = _shard(length)
        if length < min_chars or shard not in filters:
            return None
        return partial(_maybe, blocks=blocks[shard], first=filters[shard][0], bits=filters[shard][1])

    for batch in batches:
        counts = batch["n"].to_numpy()
        for length, at, words in _by_length(batch["word"]):
            codes, found = _codes(words), []
            if (probe := probe_of(length)) is not None:
                found.append(_replacements(codes, alphabet, probe))
            if (probe := probe_of(length - 1)) is not None:
                found.append(_deletions(codes, probe))
            for edits in found:
                for rows, texts in edits:
                    if texts:
                        yield pd.DataFrame({"word": [words[r] for r in rows], "n": counts[at[rows]], "edit": texts})


def near_words(words: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(word, n, near, near_n): every pair of words (word, n) one edit apart, in both directions. `words` is a stored table."""
    spark = words.sparkSession
    lengths = words.groupBy(F.least(F.char_length("word"), F.lit(LONG)).alias("shard")).agg(F.count("*").alias("n"))
    # at most LONG rows, and at most as many characters as a run may hold
    blocks = {r["shard"]: max(1, r["n"] * BITS_PER_WORD // 64) for r in lengths.collect()}
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct().collect()
    alphabet = np.array(sorted(ord(r["c"]) for r in letters if r["c"]), dtype=np.uint8)
    kind = "shard int, chunk long, block long, mask long"
    marks = words.select("word").mapInPandas(partial(_marks, blocks=blocks, chunk_bits=CHUNK_BITS), kind)
    filters = marks.groupBy("shard", "chunk").applyInPandas(_filled, "shard int, chunk long, start long, bits binary")
    filters = stored(spark, filters)
    edits = None
    for ranges in _passes(blocks):
        held = _read(filters, ranges)
        about = {s + more for s in held for more in (0, 1)}
        size = F.least(F.char_length("word"), F.lit(LONG))
        probe = partial(_probed, blocks=blocks, filters=held, alphabet=alphabet, min_chars=min_chars)
        found = words.where(size.isin(*about)).mapInPandas(probe, "word string, n long, edit string")
        found = stored(spark, found)
        edits = found if edits is None else edits.union(found)
    known = words.select(F.col("word").alias("edit"), F.col("n").alias("near_n"))
    edits = words.select("word", "n", F.lit("").alias("edit")).where("false") if edits is None else edits
    pairs = edits.join(known, "edit").select("word", "n", F.col("edit").alias("near"), "near_n")
    turned = pairs.select(F.explode(F.array(
        F.struct("word", "n", "near", "near_n"),
        F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")),
    )).alias("p"))
    return turned.select("p.*")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of a stored table (word, form) without nulls: the end of each word's chain of forms.

    A form has at least twice the count of its word, so chains are short; each round doubles the steps taken.
    """
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = stored(forms.sparkSession, moved)
        now = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return now


def variants(words: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, times: float = TIMES) -> DataFrame:
    """One row per word of the vocabulary: word, n, n_near, form, form_n, root.

    `words` has one row per occurrence (`word`, of characters below U+0100); those of at least `min_chars` code points that
    occur `min_count` times are the vocabulary. Words are near if they differ by one inserted, deleted or replaced code
    point. The form of a word is its near word of the largest count, the least by code point of several, if it occurs `times`
    as often; the root is where the chain of forms ends. An empty table gives an empty one; nulls are no words.
    """
    spark = words.sparkSession
    known = stored(spark, vocabulary(words, min_chars, min_count))
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form")))
    close = near_words(known, min_chars).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    often = -F.col("best.minus") >= times * F.col("n")
    judged = known.join(close, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(often, F.col("best.form")).alias("form"),
        F.when(often, -F.col("best.minus")).alias("form_n"),
    )
    judged = stored(spark, judged)
    ends = roots(judged.where("form IS NOT NULL"))
    return judged.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def words_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", errors: bool = False) -> DataFrame:
    """One row per run of letters of the texts, A-Z lower-cased; `errors` deletes a code point of one run in 97."""
    each = docs.select(F.col(id_col).alias("id"), F.explode(runs(F.col(text_col))).alias("run"))
    each = each.select("id", _lowered(F.col("run")).alias("run"))
    return each.select((damaged(F.col("run"), F.col("id")) if errors else F.col("run")).alias("word"))
