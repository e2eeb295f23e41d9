"""SimHash near-dedup by tiled exact comparison.

Equal fingerprints are one row from the start. Two fingerprints that differ in at most r bits agree in at least one of
r + 1 segments of their bits, so fingerprints meet in blocks (segment, value). Inside a block they are sorted by
population count and cut into tiles; numpy compares tile against tile by exclusive-or and bit count, and a pair of tiles
whose population counts differ by more than r is skipped. A block hands on links that span its groups, not all pairs, and
components are then joined over all blocks.

A block of more rows than `BLOCK_ROWS` is dealt out by population count and salt: tile (p, a) meets tile (q, b) in a task of
its own if |p - q| <= r, so no task gets a hot block whole.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringledger.llm.common import blocks_of_texts, bounded_batches, lent, stored, unused, whole_row
from ringledger.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
BITS = 64
TILE_ROWS = 1_024
BLOCK_ROWS = 8_192
_SEED = 42


def _shingles(text: bytes, size: int) -> list[bytes]:
    """Shingles as slices of the words joined by single spaces."""
    words = text.split()
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - size + 1].tolist()
    return [joined[a:b] for a, b in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)]


def fingerprints_of(texts: list[str | None], size: int = SHINGLE_WORDS) -> np.ndarray:
    """The 64-bit fingerprint of each text; 0 for a text without words."""
    out = np.zeros(len(texts), np.uint64)
    hashed = xxhash.xxh64_intdigest
    for a, b in blocks_of_texts(texts, 1 << 19):
        hashes: list[int] = []
        counts = np.zeros(b - a, np.int64)
        for i in range(a, b):
            # bytes.lower() and bytes.split() know A-Z and ASCII white space only, as the definition asks
            shingles = _shingles(texts[i].encode().lower(), size) if texts[i] else []
            hashes += [hashed(s, _SEED) for s in shingles]
            counts[i - a] = len(shingles)
        some = np.flatnonzero(counts)
        if not len(some):
            continue
        votes = np.zeros((len(some), BITS), np.int64)
        h = np.array(hashes, np.uint64)
        owner = np.repeat(np.arange(len(some)), counts[some])
        for k in range(0, len(h), 1 << 16):  # a very long text is counted in pieces
            bits = np.unpackbits(h[k : k + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            part = owner[k : k + (1 << 16)]
            first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            votes[part[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        set_bits = votes * 2 > counts[some][:, None]
        out[a + some] = np.packbits(set_bits, axis=1).view(">u8").ravel().astype(np.uint64)
    return out


def fingerprint_column(size: int = SHINGLE_WORDS):
    @F.pandas_udf("long")
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in lent(batches):
            yield pd.Series(fingerprints_of([t or None for t in texts], size).view(np.int64))

    return fingerprint


def spanning(prints: np.ndarray, bits: int) -> np.ndarray:
    """For each of the (distinct) fingerprints the place of its group's smallest member, links being `bits` or fewer.

    Tiles are ranges of the order by population count; a pair of tiles is compared only if their counts are near enough.
    """
    counts = np.bitwise_count(prints)
    order = np.argsort(counts, kind="stable")
    prints, counts = prints[order], counts[order].astype(np.int64)
    root = np.arange(len(prints))
    tiles = range(0, len(prints), TILE_ROWS)
    for a in tiles:
        left = prints[a : a + TILE_ROWS]
        for b in tiles:
            if b < a:
                continue
            if counts[b] - counts[min(a + TILE_ROWS, len(prints)) - 1] > bits:
                break
            x, y = np.nonzero(np.bitwise_count(left[:, None] ^ prints[None, b : b + TILE_ROWS]) <= bits)
            x, y = x + a, y + b
            keep = x < y
            x, y = x[keep], y[keep]
            while len(x):  # smaller roots win until the pairs of these tiles agree
                low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
                differs = low != high
                if not differs.any():
                    break
                x, y = x[differs], y[differs]
                np.minimum.at(root, high[differs], low[differs])
                while True:
                    up = root[root]
                    if (up == root).all():
                        break
                    root = up
    while (root[root] != root).any():
        root = root[root]
    smallest = np.full(len(prints), np.iinfo(np.int64).max)
    np.minimum.at(smallest, root, order)
    out = np.empty(len(prints), np.int64)
    out[order] = smallest[root]
    return out


def _segment_bits(bits: int) -> list[tuple[int, int]]:
    edges = [round(BITS * k / (bits + 1)) for k in range(bits + 2)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def links(prints: DataFrame, bits: int = MAX_BITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b): links among the distinct fingerprints in column `fp` (long) that span every group joined by links of
    `bits` or fewer differing bits within its blocks; all links together span the groups of the whole."""
    fp, pops = F.col("fp"), F.bit_count("fp").cast("int")
    parts = [
        F.struct(
            F.lit(k).alias("segment"),
            F.shiftrightunsigned(F.shiftleft(fp, BITS - end), BITS - (end - start)).alias("value"),
        )
        for k, (start, end) in enumerate(_segment_bits(bits))
    ]
    rows = prints.select("fp", pops.alias("pop"), F.explode(F.array(*parts)).alias("block"))
    rows = rows.select("fp", "pop", "block.segment", "block.value")
    sizes = rows.groupBy("segment", "value", "pop").agg(F.count("*").alias("n"))
    hot = sizes.groupBy("segment", "value").agg(
        F.sum("n").alias("all"), F.map_from_entries(F.collect_list(F.struct("pop", "n"))).alias("by_pop")
    )
    hot = hot.where(F.col("all") > block_rows).drop("all")  # by_pop has 65 entries at most
    dealt = rows.join(hot, ["segment", "value"], "left")
    half = max(1, block_rows // 2)
    salts = lambda pop: F.ceil(F.coalesce(F.col("by_pop")[pop], F.lit(0)) / half).cast("int")
    own = F.pmod(F.xxhash64("fp"), salts(F.col("pop"))).cast("int")
    reach = F.transform(
        F.sequence(F.lit(-bits), F.lit(bits)),
        lambda d: F.transform(
            F.filter(F.sequence(F.lit(0), salts(F.col("pop") + d)), lambda b: b < salts(F.col("pop") + d)),
            lambda b: F.when(
                (d > 0) | ((d == 0) & (b >= own)),
                F.concat_ws(":", F.col("pop"), own, F.col("pop") + d, b),
            ).otherwise(F.concat_ws(":", F.col("pop") + d, b, F.col("pop"), own)),
        ),
    )
    tiles = F.when(F.col("by_pop").isNull(), F.array(F.lit(""))).otherwise(F.array_distinct(F.flatten(reach)))
    dealt = dealt.select("fp", "segment", "value", F.explode(tiles).alias("tile"))
    ordered = dealt.repartition("segment", "value", "tile").sortWithinPartitions("segment", "value", "tile", "fp")

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def linked(fps: np.ndarray) -> pd.DataFrame:
            head = spanning(fps.view(np.uint64), bits)
            tail = np.flatnonzero(head != np.arange(len(fps)))
            return pd.DataFrame({"a": fps[head[tail]], "b": fps[tail]})

        rest = None  # the last block, which the next batch may go on with
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if not len(rows):
                continue
            names, fps = rows[["segment", "value", "tile"]], rows["fp"].to_numpy(np.int64)
            new = np.flatnonzero((names != names.shift()).to_numpy().any(axis=1))
            ends = new[1:]
            for k in np.flatnonzero(ends - new[:-1] > 1):
                yield linked(fps[new[k] : ends[k]])
            rest = rows.iloc[new[-1] :]
        if rest is not None and len(rest) > 1:
            yield linked(rest["fp"].to_numpy(np.int64))

    return ordered.mapInPandas(compared, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE_WORDS, bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row of `docs`.

    Words are runs of anything but ASCII white space, A-Z lower-cased; fewer words than a shingle are one shingle; a null
    text, or one without words, has the fingerprint zero, which links like any other. `component_id` is the smallest id
    reachable over links of `bits` or fewer bits. A row with a null id gets its fingerprint and a null component, and
    links nothing. Repeated rows give repeated results; other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    prints = docs.select(F.col(id_col).alias("doc_id"), fingerprint_column(size)(F.col(text_col)).alias("fp"))
    prints = stored(spark, prints)
    smallest = prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    pairs = stored(spark, links(smallest.select("fp"), bits))
    groups = stored(spark, components(pairs, smallest, "fp", "first_id"))  # (fp, component_id)
    return prints.join(groups, "fp", "left").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of `docs`, with all their columns, that stay: the smallest id of each group, once if its row is repeated
    (of different texts under one id the one with the smallest hash). Rows with a null id stay."""
    gone, copies = unused(docs, "__gone", "__copies")
    found = near_duplicates(docs, id_col, text_col, **settings).where("doc_id is not null").groupBy("doc_id")
    # what goes, and what stays once, is less than what stays: a join with it can leave the texts where they are
    of = found.agg(F.min("component_id").alias("head"), F.count("*").alias(copies)).withColumnRenamed("doc_id", gone)
    of = stored(docs.sparkSession, of.where(f"{gone} <> head or {copies} > 1"))
    once = docs.join(of.select(gone), docs[id_col] == F.col(gone), "left_anti")
    many = docs.join(of.where(f"{gone} = head").select(gone), docs[id_col] == F.col(gone), "left_semi")
    order = F.struct(F.xxhash64(text_col), F.xxhash64(F.to_json(whole_row(docs))))
    one = many.groupBy(many[id_col].alias(gone)).agg(F.min_by(whole_row(docs), order).alias(copies))
    return once.unionByName(one.select(f"{copies}.*"))
