import numpy as np
import pytest

from ringledger.llm import ann
from tests.llm import plain


def brute(rows, every, k):
    out = {}
    for q, v in rows:
        if q % every == 0:
            scores = [(-float(np.cumsum(np.array(v) * np.array(w))[-1]), i) for i, w in rows if i != q]
            out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def listed(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("folder", [plain.SMALL, "/root/testdata/sf0.1"])
def test_recall(spark, folder):
    df = plain.table(spark, "embeddings", folder)
    want = brute([(r["vec_id"], np.array(r["embedding"], float)) for r in df.collect()], 20, 20)
    got = listed(ann.nearest(df))
    assert set(got) == set(want)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9


def clusters(n, size=64, seed=1):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(60, size))[rng.integers(0, 60, n)] * 3 + rng.normal(size=(n, size))


@pytest.mark.parametrize("kind", ["clusters", "no structure"])
def test_fewer_scores_than_an_exhaustive_search(spark, kind):
    """Recall, and scored candidates a query against all vectors, on vectors with and without structure."""
    n, rng = 8_192, np.random.default_rng(4)
    x = clusters(n) if kind == "clusters" else rng.normal(size=(n, 64))
    forest = ann.Forest(x, float(np.sqrt((x**2).sum(axis=1).max())), ann.TREES, ann.LEAF_SAMPLE, None)
    asked = x[500:620]
    scored, probes, hits = forest.scored(asked).mean() / n, forest.probes(asked), []
    for i, p in enumerate(probes):
        met = np.zeros(n, bool)
        for t, leaf in p:
            met |= forest.trees[t].sampled == leaf
        hits.append(met[np.argsort(-(x @ asked[i]))[1:21]].mean())
    print(f"{kind}: recall {np.mean(hits):.3f}, candidates a query {scored:.2f} x vectors")
    assert np.mean(hits) >= 0.9 and scored < (0.4 if kind == "clusters" else 1.0)


def test_all_leaves_give_the_exact_answer(spark, monkeypatch):
    """With a share of 1 every leaf is looked into; equal vectors, ties and blocks of hot leaves are exact."""
    monkeypatch.setattr(ann, "BLOCK_VECTORS", 16)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 4)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(150)]
    rows += [(i, [1.0, 2.0, 0.0, 1.0]) for i in range(150, 260)]
    rows = [(i, v) for i, v in rows if any(v)]
    got = listed(ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=5, neighbours=7, share=1.0, leaf_sample=20))
    assert got == brute(rows, 5, 7)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0])]
    rows += [(7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (20, [2.0, 0.0]), (21, [0.5, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 rep", "2 v", "3 h1", "4 score")
    assert listed(ann.nearest(df)) == {0: [(20, 2.0), (21, 0.5)], 20: [(0, 2.0), (21, 1.0)]}
    assert ann.nearest(df.where("false")).collect() == []
    assert ann.nearest(df.where("vec_id = 20")).collect() == []
    assert ann.nearest(df.where("vec_id in (3, 4)")).collect() == []
