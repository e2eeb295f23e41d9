"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the last bytes cuts a text into chunks at places that depend on the content alone, so passages that
documents share give equal chunks. A worker encodes a chunk once and keeps the result. What stands around a cut is encoded
again, in a span that grows until its tokens agree exactly with those of the chunks on both sides.

Agreement is looked for where white space begins behind a character that is none: the ids before and after such a place do not
depend on each other as long as no pattern of the tokenizer goes on from such a character to white space. Where a tokenizer
drops white space altogether (see `drops_blanks`), what is on both sides of it agrees by itself: the span is then the word
around the cut, chunks are words with white space around, and a match of the tokenizer's pattern is looked up before it is encoded.

Chunks are reused by the worker that holds them, over all its tasks. Reuse over the whole cluster would shuffle every text
and its ids (about four bytes a token) to save what the words' reuse already saves. What a worker keeps is bounded: when a
table is full, the one before it is given up, and entries that are used again move on to the new one.
"""

import json
import re
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from ringledger.llm.common import blocks_of_texts, bounded_batches, lent

CHUNK_CHARS = 512
WINDOW = 16
KEPT_CHUNKS = 1_000
KEPT_WORDS = 100_000
#: Ids of the words in a table, so that long words fill it too.
KEPT_IDS = 8 * KEPT_WORDS
#: Characters of texts that are cut into words at a time.
AT_A_TIME = 1 << 18
#: Longer words and chunks are encoded each time, so that what is kept is bounded in bytes too.
KEPT_WORD_CHARS, KEPT_CHUNK_CHARS = 64, 8 * CHUNK_CHARS
#: Characters on either side of a cut that are encoded again at first, and tokens that have to agree.
REACH, AGREE = 48, 2
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_BLANKS = " \t\n\r"
_SPLIT = re.compile(f"[{_BLANKS}]+")
_WORD_END = "</w>"
#: Byte-level vocabularies write a byte that is no printable Latin-1 character as the next free character from 256 on.
_PLAIN = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
_BYTES = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PLAIN)}
#: How a Latin-1 character is written in such a vocabulary, for those that are not written as they are.
_WRITTEN = {chr(c): "".join(chr(_BYTES.get(b, b)) for b in chr(c).encode()) for c in range(256) if not 32 <= c < 127}
_TO_WRITE = re.compile("[^ -~]")
_NOT_LATIN = re.compile("[^\0-ÿ]")

#: Settings under which white space is dropped: the normaliser turns it into a blank and composes nothing across it, and the
#: patterns, of which only the matches are kept, match none. Fixed values of the tokenizer's file.
_BLANK_FREE = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}

# the pattern of these settings over lower-case Latin-1, which the normaliser leaves as it is
_LETTER, _DIGIT, _SPACE = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", "\\t-\\r \x85\xa0"
_matches = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^{_SPACE}{_LETTER}{_DIGIT}]+").findall


def drops_blanks(settings: dict) -> bool:
    """Whether the tokenizer drops white space and ends each word with a token of its own, so that words can be encoded apart."""
    model = settings["model"]
    plain = all(settings.get(k) == v for k, v in _BLANK_FREE.items())
    bytes_known = model.get("end_of_word_suffix") == _WORD_END and all(
        chr(_BYTES.get(b, b)) + end in model["vocab"] for b in range(256) for end in ("", _WORD_END)
    )
    marks = all(not re.search(r"\s", t["content"]) and not t["lstrip"] and not t["rstrip"] for t in settings["added_tokens"])
    return plain and bytes_known and marks and not model.get("dropout")


def cuts(text: str, mean: int = CHUNK_CHARS) -> list[int]:
    """Places after which to cut: where the hash of the last `WINDOW` characters falls on 1 of `mean` values."""
    if len(text) <= WINDOW:
        return []
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    width, h = 1, (points + np.uint64(1)) * _FACTOR
    while width < WINDOW:  # hashes of twice the width, until they span the window
        h = (h[:-width] ^ (h[:-width] >> np.uint64(29))) * _FACTOR + h[width:]
        width *= 2
    h ^= h >> np.uint64(32)
    return (np.flatnonzero(h % np.uint64(mean) == 0) + WINDOW).tolist()


def _halves(chunk: str) -> tuple[str, str, str | None]:
    """The chunk cut at white space: its first piece, the whole words, its last piece; the outer ones may be empty. A chunk
    within one word has no last piece."""
    blank = _SPLIT.search(chunk)
    if blank is None:
        return chunk, "", None
    last = max(map(chunk.rfind, _BLANKS))
    return chunk[: blank.start()], chunk[blank.start() : last], chunk[last + 1 :]


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all items of ranges, one range after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Kept(dict):
    """A table of bounded size: a full one becomes the old one, whose entries come back when they are used."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.old = most, {}

    def make_room(self) -> None:
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()

    def holds(self, key: str) -> bool:
        if key in self:
            return True
        if key in self.old:
            self[key] = self.old[key]
            return True
        return False


class Words(dict):
    """Numbers of words, given when a word is first asked for; `learn` adds the ids of the new ones, all in one array. Words of
    the table before this one are taken from there."""

    def __init__(self, old: "Words | None" = None):
        super().__init__()
        self.old, self.new, self.count = old, [], 0
        self.starts, self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def __missing__(self, word: str) -> int:
        number = self[word] = self.count
        self.count += 1
        self.new.append(word)
        return number

    def next(self) -> "Words":
        """This table, or if it is full a new one that takes over what is used again."""
        if len(self) <= KEPT_WORDS and len(self.ids) <= KEPT_IDS:
            return self
        self.old = None
        return Words(self)

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one word after the other, and how many each has."""
        sizes = self.sizes[numbers]
        return self.ids[_ragged(self.starts[numbers], sizes)], sizes

    def learn(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> list[str]:
        """Add the ids of the new words: `encode` gives those of words that the table before does not have."""
        new, self.new = self.new, []
        if not new:
            return new
        was = np.array([-1 if self.old is None else self.old.get(w, -1) for w in new])
        sizes = np.zeros(len(new), np.int64)
        unknown = np.flatnonzero(was < 0)
        ids, sizes[unknown] = encode([new[k] for k in unknown.tolist()])
        known = np.flatnonzero(was >= 0)
        if len(known):
            moved, sizes[known] = self.old.of(was[known])
            ids = np.concatenate([ids, moved])
        order = np.concatenate([unknown, known])
        starts = np.zeros(len(new), np.int64)
        starts[order] = len(self.ids) + np.cumsum(sizes[order]) - sizes[order]
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, ids])
        return new


Encoded = tuple[bytes, str]


class Codec:
    """One tokenizer with what it has already encoded: ids as packed 32-bit numbers."""

    def __init__(self, path: str, mean: int = CHUNK_CHARS, by_words: bool | None = None):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.mean = mean
        self.chunks = Kept(KEPT_CHUNKS)
        self.by_words = words_apart(path) if by_words is None else by_words
        # without a decoder the library joins tokens by spaces; otherwise it decodes itself
        self.names = None
        if self.tokenizer.decoder is None:
            self.names = {i: s for s, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        if self.by_words:
            self.words = Words()
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
            self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.ends[[i for s, i in vocabulary.items() if s.endswith(_WORD_END)]] = True
            self.marks = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
            # the merge table alone, for words that need no normaliser and no patterns
            self.merges = Tokenizer(self.tokenizer.model)
            self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        if self.names is not None:
            self.token_names = pa.array([self.names.get(i, "") for i in range(max(self.names) + 1)], pa.string())

    def parts(self, text: str) -> list[str]:
        edges = [0, *cuts(text, self.mean), len(text)]
        return [text[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def decode(self, ids: list[int]) -> str:
        if self.names is not None:
            return " ".join([self.names[i] for i in ids if i in self.names])
        return self.tokenizer.decode(ids, skip_special_tokens=False)

    def encode(self, texts: list[str | None]) -> list[Encoded]:
        """Ids and decoded text of each text, as the library gives them for the whole text."""
        ids = self.ids_of(texts)
        return list(zip(ids, self.texts_of(ids).to_pylist(), strict=True))

    def ids_of(self, texts: list[str | None]) -> list[bytes]:
        self.chunks.make_room()
        return self._from_words(texts) if self.by_words else [self._from_spans(t or "") for t in texts]

    def texts_of(self, packed: list[bytes]) -> pa.Array:
        """The texts decoded from ids."""
        if self.names is None:
            return pa.array([self.decode(np.frombuffer(p, np.int32).tolist()) for p in packed], pa.string())
        ids, offsets = _flat(packed)
        return pc.binary_join(pa.ListArray.from_arrays(offsets, self.token_names.take(ids)), " ")

    # -- words apart

    def _is_plain(self, text: str, lower: str) -> bool:
        """Whether the text has Latin-1 characters only and no token of its own, so that the pattern can be used alone."""
        if not text.isascii() and _NOT_LATIN.search(text):
            return False
        for mark in self.marks:
            if mark in lower:
                return False
        return True

    def _words_in(self, text: str) -> list[str]:
        """The matches of the pattern; a word with other characters or with a token of its own is left whole."""
        lower = text.lower()
        if self._is_plain(text, lower):
            return _matches(lower)
        found = []
        for word in _SPLIT.split(text):
            if word:
                lower = word.lower()
                found += _matches(lower) if self._is_plain(word, lower) else [word]
        return found

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one after the other, and how many each has."""
        sizes, parts = np.zeros(len(words), np.int64), []
        joined = " ".join(words)
        if self._is_plain(joined, joined):
            plain = np.ones(len(words), dtype=bool)
        else:
            plain = np.array([self._is_plain(w, w.lower()) for w in words], dtype=bool)
        places = {True: np.flatnonzero(plain), False: np.flatnonzero(~plain)}
        for matched, at in places.items():
            for k in range(0, len(at), 4096):
                own = at[k : k + 4096]
                part = [words[i] for i in own.tolist()]
                ids, sizes[own] = self._merged(part) if matched else self._tokenized(part)
                parts.append(ids)
        ids = np.concatenate([np.zeros(0, np.int32), *parts])
        order = np.concatenate([places[True], places[False]])
        starts = np.zeros(len(words), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        return ids[_ragged(starts, sizes)], sizes

    def _merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Matches of the pattern through the merge table in one call."""
        joined = _TO_WRITE.sub(lambda c: _WRITTEN[c[0]], " ".join(words))
        ids = np.array(self.merges.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int32)
        return ids, np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)

    def _tokenized(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([i for ids in encoded for i in ids], np.int32), np.array([len(ids) for ids in encoded], np.int64)

    def _pieces(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that begin and end with whole words."""
        self.words = self.words.next()
        number, numbers, upto = self.words.__getitem__, [], [0]
        for text in texts:
            numbers += map(number, self._words_in(text))
            upto.append(len(numbers))
        learned = self.words.learn(self._encode_words)
        ids, sizes = self.words.of(np.array(numbers, np.int64))
        ends = (4 * np.concatenate(([0], np.cumsum(sizes)))[upto]).tolist()
        for word in learned:
            if len(word) > KEPT_WORD_CHARS:
                del self.words[word]
        packed = ids.tobytes()
        return [packed[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def _from_words(self, texts: list[str | None]) -> list[bytes]:
        pieces = [self.parts(t) if t else [] for t in texts]
        # a chunk is its first piece, whole words, and its last piece
        split = {c: _halves(c) for parts in pieces for c in parts if not self.chunks.holds(c)}
        joins, upto = [], [0]
        for parts in pieces:
            held = []
            for c in parts:
                first, last = split[c][::2] if c in split else self.chunks[c][0]
                held.append(first)
                if last is not None:
                    joins.append("".join(held))
                    held = [last]
            joins.append("".join(held))
            upto.append(len(joins))
        ids = self._pieces([*joins, *[inner for _, inner, _ in split.values()]])
        inner = dict(zip(split, ids[len(joins) :], strict=True))
        out = []
        for parts, a in zip(pieces, upto[:-1], strict=True):
            found = [ids[a]]
            for c in parts:
                if c in split:
                    last, own = split[c][2], inner[c]
                else:
                    (_, last), own = self.chunks[c]
                if last is not None:
                    a += 1
                    found += (own, ids[a])
            out.append(b"".join(found))
        self.chunks.update([(c, (split[c][::2], own)) for c, own in inner.items() if len(c) <= KEPT_CHUNK_CHARS])
        return out

    # -- spans around cuts

    def _tokens(self, text: str) -> tuple[list[int], list[int]]:
        """Ids and the places where they begin."""
        e = self.tokenizer.encode(text, add_special_tokens=False)
        return e.ids, [a for a, _ in e.offsets]

    def _from_spans(self, text: str) -> bytes:
        ids, starts, cut = [], [], 0
        for chunk in self.parts(text):
            if self.chunks.holds(chunk):
                own, own_starts = self.chunks[chunk]
            else:
                own, own_starts = self._tokens(chunk)
                if len(chunk) <= KEPT_CHUNK_CHARS:
                    self.chunks[chunk] = own, own_starts
            own_starts = [cut + s for s in own_starts]
            if cut:
                ids, starts = self._repaired(text, cut, (ids, starts), (own, own_starts), cut + len(chunk))
            else:
                ids, starts = list(own), own_starts
            cut += len(chunk)
        return np.array(ids, np.int32).tobytes()

    def _repaired(self, text, cut, left, right, end):
        """The tokens up to `end` of what is left of a cut, and of the chunk right of it."""
        reach = REACH
        while True:
            a, b = max(0, cut - reach), min(end, cut + reach)
            while a and not (text[a].isspace() and not text[a - 1].isspace()):
                a -= 1
            ids, starts = self._tokens(text[a:b])
            span = ids, [a + s for s in starts]
            first = _place(left[1], a)
            begins = not a or _agree((left[0], left[1]), first, span, 0, cut)
            whole = b == end
            for k, s in enumerate(span[1]):
                j = _place(right[1], s) if s > cut and text[s].isspace() and not text[s - 1].isspace() else None
                if begins and first is not None and j is not None and _agree(span, k, right, j, b):
                    return [*left[0][:first], *span[0][:k], *right[0][j:]], [*left[1][:first], *span[1][:k], *right[1][j:]]
            if whole and begins and first is not None:
                return [*left[0][:first], *span[0]], [*left[1][:first], *span[1]]
            reach *= 2


def _flat(packed: list[bytes]) -> tuple[pa.Array, pa.Array]:
    """All ids, and where those of each text begin and end."""
    offsets = np.concatenate(([0], np.cumsum([len(p) // 4 for p in packed]))).astype(np.int32)
    return pa.array(np.frombuffer(b"".join(packed), np.int32)), pa.array(offsets)


def _place(starts: list[int], at: int) -> int | None:
    """Number of the first token that begins at `at`."""
    k = int(np.searchsorted(starts, at))
    return k if k < len(starts) and starts[k] == at else (0 if at == 0 else None)


def _agree(one: tuple[list[int], list[int]], i: int | None, other: tuple[list[int], list[int]], j: int, before: int) -> bool:
    """Whether the next tokens are the same in both, and all begin before a place (a span may cut off the last)."""
    if i is None:
        return False
    here, there = slice(i, i + AGREE + 1), slice(j, j + AGREE + 1)
    if len(one[0][here]) <= AGREE or len(other[0][there]) <= AGREE:
        return False
    same = one[0][here][:AGREE] == other[0][there][:AGREE] and one[1][here] == other[1][there]
    return same and one[1][i + AGREE] < before


@cache
def words_apart(path: str) -> bool:
    """Whether the tokenizer in a file lets words be encoded apart; reading the whole file takes more memory than its model, so
    this is done by the driver."""
    with open(path, encoding="utf-8") as f:
        return drops_blanks(json.load(f))


@cache
def codec(path: str, by_words: bool) -> Codec:
    """One for each worker and tokenizer, so that what it has encoded serves all tasks of the worker."""
    return Codec(path, by_words=by_words)


def tokens(path: str) -> Column:
    """A function of a text column: struct of `ids` and the text `decoded` from these ids."""
    by_words = words_apart(path)

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(path, by_words)
        for batch in lent(batches):
            texts, ids, decoded = batch.to_pylist(), [], [pa.array([], pa.string())]
            for a, b in blocks_of_texts(texts, AT_A_TIME):
                packed = own.ids_of(texts[a:b])
                ids += packed
                decoded.append(own.texts_of(packed))
            flat, offsets = _flat(ids)
            yield pa.StructArray.from_arrays([pa.ListArray.from_arrays(offsets, flat), pa.concat_arrays(decoded)], ["ids", "decoded"])

    return coded


def decoded(path: str) -> Column:
    """A function of a column of ids: the text the library decodes from them, with special tokens; null ids give null."""

    by_words = words_apart(path)

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(path, by_words)
        for batch in batches:
            yield batch.map(lambda ids: None if ids is None else own.decode([int(i) for i in ids]))

    return decode


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) of each row: the ids of the whole text without added special tokens, truncation or padding,
    and the text decoded from them with special tokens.

    A null or empty text has no ids and decodes to the empty text. Ids may be null or repeated; each row is encoded. Other
    columns are ignored; an empty table gives an empty result. `path` must name the same file on every machine.
    """
    bounded_batches(docs.sparkSession)
    coded = tokens(path)(F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(F.col(id_col).alias("doc_id"), coded.alias("coded")).select("doc_id", "coded.ids", "coded.decoded")
