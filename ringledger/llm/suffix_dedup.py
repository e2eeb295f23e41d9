"""Removal of repeated byte strings by a sparse enhanced suffix array.

Suffixes start at anchors: a position is an anchor if the hash of its `ANCHOR` bytes is the least (ties included) in some
window as long as the sought repeat. Anchors depend on content alone, so two equal strings of that length have an anchor at
the same place, and a suffix array over anchors finds every repeat that one over all positions would.

Anchors whose bytes occur once are dropped. The others are told apart by their whole context, the bytes that any window over
the anchor can reach; equal contexts are one class from then on. One context of each class, where an anchor has several, is
sorted by Spark behind its anchor: the suffix array. Neighbours' common prefixes make it an enhanced one, and a scan with a
stack yields its common-prefix intervals. In an interval the members are ordered by the bytes before the anchor, and a second
scan finds those whose left extensions agree far enough; a set that lies in one child of the interval would extend to the
right and is left to that child. What remains are the maximal repeats with all their occurrences.

An anchor with more than `GROUP` contexts is not gathered in one task: its windows are hashed and counted by Spark.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringledger.llm.common import bounded_batches, stored

LENGTH = 200
ANCHOR = 48
GROUP = 50_000
REMEMBERED = 50_000
PIECE = 1 << 19
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left ^ (left >> np.uint64(31))) * _B + right


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` bytes from each position on, built from hashes of halves."""
    h, width, out, done = (data.astype(np.uint64) + np.uint64(1)) * _A, 1, None, 0
    while True:
        if size & width:  # the parts of the binary expansion, one behind the other
            out, done = (h, width) if out is None else (_joined(h[: len(h) - done], out[width:]), done + width)
            if done == size:
                h = out
                return h ^ (h >> np.uint64(32))
        h = _joined(h[:-width], h[width:])
        width *= 2


def _sliding(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Least or greatest of each `width` values in sequence."""
    reach = 1
    while reach * 2 <= width:
        x = pick(x[:-reach], x[reach:])
        reach *= 2
    return pick(x[: len(x) - (width - reach)], x[width - reach :]) if width > reach else x


def anchors(pieces: list[bytes], length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, position in it, hash) of the anchors of all windows of `length` bytes inside the pieces."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none
    width = length - gram + 1
    h = gram_hashes(data, gram)
    order = (h >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    least = _sliding(order, width, np.minimum)
    ends = np.cumsum(sizes)
    for a, b in zip((ends - np.minimum(sizes, length - 1)).tolist(), ends.tolist(), strict=True):
        least[a:b] = 0  # windows that would cross into the next piece
    reached = np.concatenate([np.zeros(width - 1, np.uint32), least, np.zeros(width - 1, np.uint32)])
    at = np.flatnonzero(_sliding(reached, width, np.maximum)[: len(order)] == order)
    piece = np.searchsorted(ends, at, side="right")
    return piece, at - (ends - sizes)[piece], h[at].view(np.int64)


def text_anchors(texts: list[bytes], length: int, gram: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the text, positions, hashes); long texts are taken in overlapping pieces of bounded size."""

    def flush(held):
        piece, at, h = anchors([texts[i][a:b] for i, a, b in held], length, gram)
        cuts = np.searchsorted(piece, np.arange(len(held) + 1))
        for k, (i, a, _) in enumerate(held):
            yield i, at[cuts[k] : cuts[k + 1]] + a, h[cuts[k] : cuts[k + 1]]

    def pieces():
        held, size = [], 0
        for i, text in enumerate(texts):
            for a in range(0, max(0, len(text) - length + 1), PIECE):
                b = min(len(text), a + PIECE + length - 1)
                held.append((i, a, b))
                size += b - a
                if size >= PIECE:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    last, at, h = None, [], []
    for i, x, y in pieces():
        if i != last and at:
            yield last, *_unique(at, h)
            at, h = [], []
        last = i
        at.append(x)
        h.append(y)
    if at:
        yield last, *_unique(at, h)


def _unique(at: list[np.ndarray], h: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if len(at) == 1:
        return at[0], h[0]
    places, first = np.unique(np.concatenate(at), return_index=True)
    return places, np.concatenate(h)[first]


def intervals(common: list[int]) -> Iterator[tuple[int, int, int]]:
    """(value, first, last) of the intervals of a list of common prefix lengths, common[i] between i - 1 and i, children
    before parents; members of an interval share exactly `value`."""
    stack: list[tuple[int, int]] = []
    for i in range(1, len(common) + 1):
        here = common[i] if i < len(common) else -1
        first = i - 1
        while stack and stack[-1][0] > here:
            value, first = stack.pop()
            yield value, first, i - 1
        if here >= 0 and (not stack or stack[-1][0] < here):
            stack.append((here, first))


def _common(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Common prefix lengths of neighbouring rows; 0 for the first."""
    differs = rows[1:] != rows[:-1]
    some = differs.any(axis=1)
    n = np.where(some, differs.argmax(axis=1), rows.shape[1])
    return np.concatenate(([0], np.minimum(n, np.minimum(sizes[1:], sizes[:-1]))))


def _rows(values: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(v.ljust(width, b"\0") for v in values), np.uint8).reshape(-1, width)


def maximal_repeats(lefts: list[bytes], rights: list[bytes], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """(bytes before, bytes from the anchor on, members) of each maximal repeat of `length` bytes or more that covers the
    anchor. `rights` are the contexts from the anchor on, sorted; `lefts` the bytes before it, last byte first."""
    left, right = _rows(lefts, max(1, max(map(len, lefts)))), _rows(rights, max(map(len, rights)))
    common = _common(right, np.array([len(x) for x in rights]))
    return _repeats(left, np.array([len(x) for x in lefts]), common, length)


def _repeats(left: np.ndarray, left_size: np.ndarray, common: np.ndarray, length: int) -> Iterator[tuple[int, int, list[int]]]:
    """As `maximal_repeats`, from the rows of left bytes and the common prefix lengths of the sorted right contexts."""
    width, rank = left.shape[1], None
    for depth, first, last in intervals(common.tolist()):
        need = length - depth
        if need > width:
            continue
        if last == first + 1:
            before = int(_common(left[first : last + 1], left_size[first : last + 1])[1])
            if before >= need:
                yield before, depth, [first, last]
            continue
        if rank is None:
            rank = np.empty(len(left), np.int64)
            rank[np.argsort(np.ascontiguousarray(left).view(f"S{width}").ravel(), kind="stable")] = np.arange(len(left))
        members = first + np.argsort(rank[first : last + 1], kind="stable")
        agree = _common(left[members], left_size[members])
        if agree.max() < need:
            continue
        child = np.cumsum(np.concatenate(([0], common[first + 1 : last + 1] == depth)))[members - first]
        for before, a, b in intervals(agree.tolist()):
            if before >= need and (child[a : b + 1] != child[a]).any():
                yield before, depth, members[a : b + 1].tolist()


def _covered(grams: np.ndarray, lefts: list[bytes], rights: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """How far maximal repeats reach before and behind the anchor of each context; contexts of one anchor stand together,
    sorted by their right sides."""
    n = len(grams)
    before, after = np.zeros(n, np.int32), np.zeros(n, np.int32)
    left, left_size = _rows(lefts, max(1, max(map(len, lefts)))), np.array([len(x) for x in lefts])
    common = _common(_rows(rights, max(map(len, rights))), np.array([len(x) for x in rights]))
    edges = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1], [True])))
    starts, sizes = edges[:-1], np.diff(edges)
    common[starts] = 0
    # anchors of two contexts, the most of all, at once: their common prefix and common left bytes are the only repeat
    two = starts[sizes == 2]
    agree = _common(left, left_size)[two + 1]
    found = agree + common[two + 1] >= length
    for k in (0, 1):
        before[two[found] + k], after[two[found] + k] = agree[found], common[two[found] + 1]
    for a, b in zip(starts[sizes > 2].tolist(), edges[1:][sizes > 2].tolist(), strict=True):
        for x, y, members in _repeats(left[a:b], left_size[a:b], common[a:b], length):
            members = np.array(members) + a
            before[members] = np.maximum(before[members], x)
            after[members] = np.maximum(after[members], y)
    return before, after


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("version"), text.cast("binary").alias("text"))


def _same(a: DataFrame, b: DataFrame):
    return a["id"].eqNullSafe(b["id"]) & (a["version"] == b["version"])


def _occurrences(texts: DataFrame, length: int, gram: int, counted: bool) -> DataFrame:
    """(gram[, context, id, version, pos]) of each anchor."""
    id_kind = texts.schema["id"].dataType.simpleString()
    reach = length - gram

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = xxhash.xxh3_64_intdigest
        for batch in batches:
            data = batch["text"].to_pylist()
            take, places, grams, contexts = [], [], [], []
            for i, at, h in text_anchors(data, length, gram):
                grams.append(h)
                if counted:
                    text = data[i]
                    take.append(np.full(len(at), i))
                    places.append(at)
                    # the number of bytes before the anchor is the seed: contexts cut off by an end are their own classes
                    contexts += [hashed(text[max(0, p - reach) : p + length], min(p, reach)) for p in at.tolist()]
            if not grams:
                continue
            cells = {"gram": np.concatenate(grams)}
            if counted:
                take = pa.array(np.concatenate(take))
                cells |= {"context": np.array(contexts, np.uint64).view(np.int64), "id": batch["id"].take(take)}
                cells |= {"version": batch["version"].take(take), "pos": np.concatenate(places).astype(np.int32)}
            yield pa.RecordBatch.from_pydict({k: pa.array(v) if isinstance(v, np.ndarray) else v for k, v in cells.items()})

    kind = f"gram long, context long, id {id_kind}, version long, pos int" if counted else "gram long"
    return texts.mapInArrow(found, kind)


def _contexts(texts: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """(gram, context, alone, left, right): the bytes around the anchors in `wanted` (id, version, anchors)."""
    reach = length - gram

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in batches:
            rows: list[tuple] = []
            for text, listed, of, version in zip(*(batch[c] for c in ("text", "anchors", "id", "version")), strict=True):
                # rows with one id and text have the same contexts: a task brings them once, as long as it remembers
                key = of.as_py(), version.as_py()
                if key in seen:
                    continue
                if len(seen) == REMEMBERED:
                    seen.clear()
                seen.add(key)
                text = text.as_py()
                for a in listed.as_py():
                    p = a["pos"]
                    # NUL stands for the end of a context in comparisons; the byte 255 is in no UTF-8 text
                    left = text[max(0, p - reach) : p][::-1].replace(b"\0", b"\xff")
                    rows.append((a["gram"], a["context"], a["alone"], left, text[p : p + length].replace(b"\0", b"\xff")))
                    if len(rows) == 10_000:
                        yield table(rows)
                        rows = []
            if rows:
                yield table(rows)

    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary()]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        cells = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(cells, names=["gram", "context", "alone", "left", "right"])

    joined = texts.join(wanted, _same(texts, wanted)).select(texts["id"], texts["version"], "text", "anchors")
    return joined.mapInArrow(cut, "gram long, context long, alone boolean, left binary, right binary")


def _scanned(contexts: DataFrame, length: int) -> DataFrame:
    """(gram, context, before, after): how far maximal repeats reach around the anchor of each context that occurs once."""
    ordered = contexts.repartition("gram").sortWithinPartitions("gram", "right", "context")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def done(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.drop_duplicates(["gram", "context"], ignore_index=True)  # rows of one text bring a context each
            before, after = _covered(rows["gram"].to_numpy(), rows["left"].tolist(), rows["right"].tolist(), length)
            return rows[["gram", "context"]].assign(before=before, after=after)[rows["alone"] & (after > 0)]

        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            last = batch["gram"].iloc[-1]
            same = (batch["gram"] != last).to_numpy()
            start = int(np.flatnonzero(same)[-1]) + 1 if same.any() else 0
            if start or (held and held[0]["gram"].iloc[0] != last):
                yield done(pd.concat([*held, batch.iloc[:start]], ignore_index=True))
                held = []
            held.append(batch.iloc[start:])
        if held:
            yield done(pd.concat(held, ignore_index=True))

    return ordered.mapInPandas(scan, "gram long, context long, before int, after int")


def _counted(contexts: DataFrame, length: int) -> DataFrame:
    """The same for anchors of very many contexts: equal windows at the same distance from the anchor, by hash."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["gram", "context", "start", "w1", "w2"]
        for batch in batches:
            for gram, context, left, right in zip(*(batch[c].to_pylist() for c in ("gram", "context", "left", "right")), strict=True):
                text = left[::-1] + right
                n = len(text) - length + 1
                if n < 1:
                    continue
                both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(text[i : i + length]) for i in range(n)), "<i8").reshape(-1, 2)
                start = np.arange(n, dtype=np.int32) - np.int32(len(left))
                cells = [np.full(n, gram, np.int64), np.full(n, context, np.int64), start, both[:, 0].copy(), both[:, 1].copy()]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names=names)

    rows = contexts.select("gram", "context", "left", "right").mapInArrow(
        windows, "gram long, context long, start int, w1 long, w2 long"
    )
    keys = ["gram", "start", "w1", "w2"]
    several = rows.groupBy(*keys).agg(F.min("context").alias("a"), F.max("context").alias("b")).where("a < b")
    found = rows.join(several.drop("a", "b"), keys).groupBy("gram", "context")
    return found.agg((-F.min("start")).alias("before"), (F.max("start") + length).alias("after"))


def _stripped(length: int):
    """A function of (text, spans): bytes left, bytes removed and the removed runs."""

    @F.arrow_udf("struct<kept:binary,starts:array<int>,ends:array<int>>")
    def strip(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in batches:
            kept, starts, ends = [], [], []
            for text, listed in zip(texts, spans, strict=True):
                text, cuts = text.as_py(), []
                if listed.is_valid:
                    packed = np.sort(np.asarray(listed.values))
                    a, b = packed >> 31, np.minimum(packed & (2**31 - 1), len(text))
                    whole = b - a >= length
                    a, b = a[whole], np.maximum.accumulate(b[whole]) if whole.any() else b[whole]
                    if len(a):
                        new = np.flatnonzero(a[1:] > b[:-1]) + 1
                        cuts = list(zip(a[np.r_[0, new]].tolist(), b[np.r_[new - 1, len(b) - 1]].tolist(), strict=True))
                edges = [0, *[x for cut in cuts for x in cut], len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                starts.append([a for a, _ in cuts])
                ends.append([b for _, b in cuts])
            number = pa.list_(pa.int32())
            cells = [pa.array(kept, pa.binary()), pa.array(starts, number), pa.array(ends, number)]
            yield pa.StructArray.from_arrays(cells, ["kept", "starts", "ends"])

    return strip


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = ANCHOR,
    group: int = GROUP,
) -> DataFrame:
    """(doc_id, n_bytes, kept, starts, ends) of each row: the UTF-8 bytes that no repeated string of `length` bytes covers,
    and the maximal removed runs as byte positions [start, end).

    A string is repeated if it also starts anywhere else, in the same row or another, overlaps included; strings never
    cross rows and are judged on the input. Null texts are empty; texts shorter than `length` stay whole. Every row is a
    text of its own: a repeated row repeats all its strings. Ids may be null; other columns are ignored; an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = _documents(docs, id_col, text_col)
    # small tables of keys are stored before they are joined: with nothing but an exchange on either side, Spark splits the
    # rows of a string that very many texts share
    several = _occurrences(texts, length, gram, False).groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
    several = stored(spark, several.select("gram"))
    found = stored(spark, _occurrences(texts, length, gram, True).join(several, "gram"))
    place = F.struct("id", "version", "pos")
    classes = found.groupBy("gram", "context").agg(F.count("*").alias("n"), F.min(place).alias("place"))
    classes = stored(spark, classes)
    groups = stored(spark, classes.groupBy("gram").agg(F.count("*").alias("contexts")).where("contexts > 1"))
    one = classes.join(groups, "gram").select("place.*", "gram", "context", "contexts", (F.col("n") == 1).alias("alone"))
    anchors_of = F.collect_list(F.struct("gram", "context", "pos", "alone")).alias("anchors")
    few = one.where(F.col("contexts") <= group).groupBy("id", "version").agg(anchors_of)
    many = one.where(F.col("contexts") > group).groupBy("id", "version").agg(anchors_of)
    # the texts are dealt by (id, version) here and below: one exchange, which Spark uses again
    reached = _scanned(_contexts(texts, few, length, gram), length)
    reached = reached.unionByName(_counted(_contexts(texts, many, length, gram), length))
    equal = classes.where("n > 1").select(
        "gram", "context", F.lit(length - gram).alias("before"), F.lit(length).alias("after")
    )
    reached = reached.unionByName(equal)
    start, end = F.greatest(F.col("pos") - F.col("before"), F.lit(0)), F.col("pos") + F.col("after")
    spans = (
        found.join(reached, ["gram", "context"])
        .select("id", "version", (start.cast("long") * (1 << 31) + end).alias("span"))
        .groupBy("id", "version")
        .agg(F.collect_set("span").alias("spans"))
    )
    rows = texts.join(spans, _same(texts, spans), "left").select(texts["id"], texts["text"], "spans")
    rows = rows.select(F.col("id").alias("doc_id"), F.octet_length("text").cast("long").alias("n_bytes"), _stripped(length)("text", "spans").alias("x"))
    return rows.select("doc_id", "n_bytes", "x.*")
