"""Approximate nearest neighbours by inner product: a forest of random-projection trees and exact reranking.

A tree halves its vectors by their projection on a random direction, down to leaves. A query walks all trees together: one
priority queue holds the branches not taken of every tree, ordered by how near the query came to the split, and leaves are
taken from it until they cover the wanted share of the vectors. Every vector of these leaves is scored exactly, in double
precision, and the best are kept.

Inner product is reduced to angles by one more component that brings all vectors to the same length (queries have 0 there).
The splits are fitted on `SAMPLE` vectors, chosen by the hash of the id; every vector is put into a leaf of every tree.
Equal vectors are one vector with its ids from the start, so a vector that a third of all rows share is scored once; of its
ids, only as many as can be in a result are kept, the smallest. A leaf of many vectors or queries is dealt out in blocks.

How many of the vectors the leaves of a query have to hold is measured on the sample: the share at which `RECALL` of the true
neighbours of sampled queries have been met. Clustered vectors take a small share; vectors without any structure, where near
and far differ little, more than half. Of a larger table the nearest are nearer than those of its sample, so that recall
over all vectors is rather higher.
"""

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringledger.llm.common import bounded_batches, first_by_hash, stored

NEIGHBOURS = 20
SAMPLE = 8_192
TREES = 12
LEAF_SAMPLE = 64
#: Share of the sampled neighbours that the search has to find, and how many sampled queries tell what it takes.
RECALL, TUNING = 0.92, 256
BLOCK_VECTORS = 8_192
BLOCK_QUERIES = 2_048


class Tree:
    """Splits of one tree, level by level: node k has the children 2k + 1 and 2k + 2."""

    def __init__(self, points: np.ndarray, depth: int, rng: np.random.Generator):
        self.depth = depth
        inner = (1 << depth) - 1
        self.directions = rng.normal(size=(inner, points.shape[1]))
        self.directions /= np.linalg.norm(self.directions, axis=1, keepdims=True)
        self.cuts = np.zeros(inner)
        at = np.zeros(len(points), np.int64)
        for node in range(inner):
            here = np.flatnonzero(at == node)
            projected = points[here] @ self.directions[node]
            self.cuts[node] = np.median(projected) if len(here) else 0.0
            at[here] = 2 * node + 1 + (projected > self.cuts[node])
        self.sampled = at - inner

    def leaves(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            right = np.einsum("ij,ij->i", points, self.directions[at]) > self.cuts[at]
            at = 2 * at + 1 + right
        return at - len(self.cuts)


class Forest:
    def __init__(self, sample: np.ndarray, longest: float, trees: int, leaf_sample: int, share: float | None, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.longest = longest
        self._bits = -(-len(sample) // 8) * 8
        depth = max(0, int(np.log2(max(1, len(sample) / leaf_sample))))
        points = self.lifted(sample)
        self.trees = [Tree(points, depth, rng) for _ in range(trees)]
        #: which sampled vectors each leaf holds, as a number whose bits they are
        self.held = [[0] * (1 << depth) for _ in self.trees]
        for tree, held in zip(self.trees, self.held, strict=True):
            for leaf in range(1 << depth):
                bits = np.zeros(len(sample), np.uint8)
                bits[tree.sampled == leaf] = 1
                held[leaf] = int.from_bytes(np.packbits(bits).tobytes(), "big")
        self.wanted = len(sample) if share is None else share * len(sample)
        if share is None:
            self.wanted = self._tuned(sample)

    def _tuned(self, sample: np.ndarray, neighbours: int = NEIGHBOURS) -> float:
        """How many sampled vectors the leaves of a query hold when `RECALL` of all true neighbours have been met."""
        asked = sample[:TUNING]
        needed: list[int] = []
        for i, (scores, probes) in enumerate(zip(asked @ sample.T, self.probes(asked), strict=True)):
            scores[i] = -np.inf
            near = np.argsort(-scores)[: min(neighbours, len(sample) - 1)]
            missing, seen = {int(j): 1 << (self._bits - 1 - int(j)) for j in near}, 0
            for t, leaf in probes:
                seen |= self.held[t][leaf]
                met = [j for j, bit in missing.items() if seen & bit]
                if met:
                    needed += [seen.bit_count()] * len(met)
                    for j in met:
                        del missing[j]
                    if not missing:
                        break
        return float(np.quantile(needed, RECALL)) if needed else float(len(sample))

    def scored(self, queries: np.ndarray) -> np.ndarray:
        """How many sampled vectors are scored for each query, a vector in several leaves as often."""
        sizes = [np.bincount(t.sampled, minlength=len(h)) for t, h in zip(self.trees, self.held, strict=True)]
        return np.array([sum(int(sizes[t][leaf]) for t, leaf in p) for p in self.probes(queries)])

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """With the component that brings every vector to the length of the longest."""
        rest = np.maximum(0.0, self.longest**2 - (vectors**2).sum(axis=1))
        return np.concatenate([vectors, np.sqrt(rest)[:, None]], axis=1) / self.longest

    def probes(self, queries: np.ndarray) -> list[list[tuple[int, int]]]:
        """The leaves (tree, leaf) each query looks into."""
        points = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)
        points /= np.linalg.norm(points, axis=1, keepdims=True)
        margins = [points @ t.directions.T - t.cuts for t in self.trees]
        return [self._search([m[i].tolist() for m in margins]) for i in range(len(queries))]

    def _search(self, margins: list[list[float]]) -> list[tuple[int, int]]:
        queue = [(0.0, t, 0) for t in range(len(margins))]  # distance over the nearest split on the way, tree, node
        taken, seen = [], 0
        while queue:
            distance, t, node = heapq.heappop(queue)
            margin = margins[t]
            inner = len(margin)
            while node < inner:
                m = margin[node]
                right = m > 0
                heapq.heappush(queue, (max(distance, abs(m)), t, 2 * node + 2 - right))
                node = 2 * node + 1 + right
            leaf = node - inner
            taken.append((t, leaf))
            seen |= self.held[t][leaf]
            if seen.bit_count() >= self.wanted:
                break
        return taken


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).astype(np.float64).reshape(-1, size)


def _best(scores: np.ndarray, queries: np.ndarray, vectors: np.ndarray, reps: np.ndarray, most: int):
    """Places and scores of each query's best vectors; equal scores go to the smaller id."""
    for i, row in enumerate(scores):
        if len(row) > most:
            edge = np.partition(row, len(row) - most)[len(row) - most]
            near = np.flatnonzero(row >= edge - 1e-9 * max(1.0, abs(edge)))
        else:
            near = np.arange(len(row))
        # summed from the first component to the last, so that a pair has the same score wherever it is met
        exact = np.cumsum(vectors[near] * queries[i], axis=1)[:, -1]
        order = np.lexsort((reps[near], -exact))[:most]
        yield near[order], exact[order]


def nearest(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 20,
    neighbours: int = NEIGHBOURS,
    trees: int = TREES,
    sample: int = SAMPLE,
    leaf_sample: int = LEAF_SAMPLE,
    share: float | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each id divisible by `every` its `neighbours` nearest found by inner product,
    itself left out, nearest first and ties to the smaller id; all others, if there are fewer.

    Vectors that are null, empty or zero, or hold a null or non-finite component, take no part, nor do rows with a null id
    or vectors of another length than the most frequent one (of equally frequent lengths the smallest). Repeated rows
    count once; of several vectors under one id the one with the smallest hash counts. Other columns are ignored. An empty
    table gives an empty result.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull()).where(~bad & F.exists(v, lambda x: x != 0.0))
    rows = rows.select("vec_id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"))
    common = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    size = common["size"] if common else 1
    rows = rows.where(F.size("v") == size).groupBy("vec_id").agg(F.min_by(F.struct("v", "h1", "h2"), F.struct("h1", "h2")).alias("x"))
    rows = stored(spark, rows.select("vec_id", "x.*"))

    # as many ids of one vector as one result can hold, besides the query's own
    place = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    members = rows.select("h1", "h2", "vec_id").withColumn("place", place).where(f"place <= {neighbours + 1}")
    heads = rows.groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"))
    queries = rows.where(F.col("vec_id") % every == 0).select("h1", "h2", F.col("vec_id").alias("query_id"))
    asked = queries.select("h1", "h2").distinct().withColumn("asked", F.lit(True))
    heads = heads.join(asked, ["h1", "h2"], "left").select("h1", "h2", "rep", F.coalesce("asked", F.lit(False)).alias("asked"))
    distinct = stored(spark, heads.join(rows.select(F.col("vec_id").alias("rep"), "v"), "rep"))

    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    longest = distinct.agg(F.max(norm)).first()[0] or 1.0
    got = first_by_hash(distinct.select(F.col("rep").alias("id"), "v"), sample).toArrow()
    forest = Forest(_matrix(got["v"], size), longest, trees, leaf_sample, share)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = forest.lifted(_matrix(batch["v"], size))
            for t, tree in enumerate(forest.trees):
                leaves = tree.leaves(points).astype(np.int32)
                names = pa.array(np.full(len(leaves), t, np.int32))
                yield pa.RecordBatch.from_arrays([names, pa.array(leaves), batch["rep"], batch["v"]], names=fields)

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            probes = forest.probes(_matrix(batch["v"], size))
            take = np.repeat(np.arange(len(probes)), [len(p) for p in probes])
            pairs = np.array([x for p in probes for x in p], np.int32).reshape(-1, 2)
            cells = [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), batch["rep"].take(pa.array(take)), batch["v"].take(pa.array(take))]
            yield pa.RecordBatch.from_arrays(cells, names=fields)

    fields = ["tree", "leaf", "rep", "v"]
    kind = "tree int, leaf int, rep long, v array<double>"
    base = distinct.select("rep", "v")
    index = base.mapInArrow(placed, kind)
    wanted = distinct.where("asked").select("rep", "v").mapInArrow(probed, kind)
    # blocks by leaf: a table with a row for each leaf of the forest, at most trees * sample / leaf_sample
    in_leaf = index.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / BLOCK_VECTORS).cast("int").alias("blocks"))
    by_leaf = wanted.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("parts"))
    deal = F.broadcast(stored(spark, in_leaf.join(by_leaf, ["tree", "leaf"])))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    part = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    keys = ["tree", "leaf", "block", "part"]
    index = index.join(deal, ["tree", "leaf"]).withColumn("block", part("blocks")).withColumn("part", each("parts"))
    wanted = wanted.join(deal, ["tree", "leaf"]).withColumn("part", part("parts")).withColumn("block", each("blocks"))
    most = neighbours + 2

    def reranked(left: pa.Table, right: pa.Table) -> pa.Table:
        reps, asked_by = np.asarray(right["rep"].combine_chunks()), np.asarray(left["rep"].combine_chunks())
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(reps) and len(asked_by):
            q, x = _matrix(left["v"], size), _matrix(right["v"], size)
            for k in range(0, len(q), 256):
                for i, (at, score) in enumerate(_best(q[k : k + 256] @ x.T, q[k : k + 256], x, reps, most)):
                    out.append((np.full(len(at), asked_by[k + i]), reps[at], score))
        cells = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        return pa.table({"asker": pa.array(cells[0], pa.int64()), "rep": pa.array(cells[1], pa.int64()), "score": cells[2]})

    found = (
        wanted.select(*keys, "rep", "v")
        .groupBy(*keys)
        .cogroup(index.select(*keys, "rep", "v").groupBy(*keys))
        .applyInArrow(reranked, "asker long, rep long, score double")
    )
    found = found.groupBy("asker", "rep").agg(F.max("score").alias("score"))
    order = Window.partitionBy("asker").orderBy(F.desc("score"), "rep")
    found = found.withColumn("n", F.row_number().over(order)).where(f"n <= {most}").drop("n")
    names = distinct.select("rep", "h1", "h2")
    listed = found.join(names, "rep").join(members, ["h1", "h2"]).select("asker", "vec_id", "score")
    order = Window.partitionBy("asker").orderBy(F.desc("score"), "vec_id")
    listed = listed.withColumn("n", F.row_number().over(order)).where(f"n <= {neighbours + 1}").drop("n")
    askers = queries.join(names, ["h1", "h2"]).select("query_id", F.col("rep").alias("asker"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    result = askers.join(listed, "asker").where("vec_id <> query_id").withColumn("rank", F.row_number().over(order))
    return result.where(f"rank <= {neighbours}").select("query_id", "rank", "vec_id", "score")
