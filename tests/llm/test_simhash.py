import numpy as np
import pytest
from pyspark.sql import functions as F

from ringledger.llm import simhash
from ringledger.llm.components import components
from tests.llm import plain


def expected(rows):
    prints = {}
    for i, t in rows:
        prints.setdefault(i, set()).add(plain.fingerprint(t))
    nodes = {(i, p): p for i, ps in prints.items() for p in ps if i is not None}
    by_print = {}
    for (i, p) in nodes:
        by_print[p] = min(i, by_print.get(p, i))
    head = plain.groups({p: p for p in by_print})
    first = {}
    for p, h in head.items():
        first[h] = min(first.get(h, by_print[p]), by_print[p])
    out = []
    for i, t in rows:
        p = plain.fingerprint(t)
        out.append((i, format(p, "016x"), None if i is None else first[head[p]]))
    return sorted(out, key=repr)


def test_small_table_and_odd_rows(spark):
    rows = [*plain.texts(spark), *[(i if i is None else i + 10_000, t) for i, t in plain.ODD]]
    assert plain.rows(simhash.near_duplicates(plain.documents(spark, rows))) == expected(rows)


def test_empty(spark):
    assert simhash.near_duplicates(plain.documents(spark, [])).collect() == []


def near_prints(count, seed=1):
    """Distinct fingerprints in chains of near neighbours and scattered ones."""
    rng = np.random.default_rng(seed)
    out = {int(x) for x in rng.integers(0, 2**63, count)}
    for start in list(out)[: count // 8]:
        for _ in range(12):
            start ^= (1 << int(rng.integers(64))) | (1 << int(rng.integers(64)))
            out.add(start)
    return sorted(out)


@pytest.mark.parametrize("block_rows", [8_192, 6])
def test_links_span_all_groups(spark, block_rows):
    prints = near_prints(120)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    pairs = simhash.links(df, 2, block_rows)
    nodes = df.withColumn("first", F.col("fp"))
    got = {r[0]: r[1] for r in components(pairs, nodes, "fp", "first").collect()}
    want = plain.groups({p: p & (2**64 - 1) for p in signed})
    assert got == {p: min(q for q in want if want[q] == want[p]) for p in signed}


def test_tiles(monkeypatch):
    monkeypatch.setattr(simhash, "TILE_ROWS", 7)
    prints = near_prints(60, 4)
    want = plain.groups({k: p for k, p in enumerate(prints)})
    assert simhash.spanning(np.array(prints, np.uint64), 2).tolist() == [want[k] for k in range(len(prints))]


def test_long_chain(spark):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    nodes = spark.createDataFrame([(i, 1000 - i) for i in [*range(61), 100, 101, 200]], "k long, v long")
    got = {r[0]: r[1] for r in components(pairs, nodes, "k", "v").collect()}
    assert {got[i] for i in range(61)} == {940} and got[100] == got[101] == 899 and got[200] == 800


def test_one_of_each(spark):
    kept = simhash.one_of_each(plain.documents(spark)).select("doc_id", "text", "label").collect()
    ids = [r["doc_id"] for r in kept]
    # ids 1 to 3 have no words and one fingerprint; repeated ids stay once; the row without an id stays
    assert sorted(ids, key=str) == sorted([None, 1, 4, 5, 6, 7, 8, 9], key=str)
    assert {r["label"] for r in kept} == {"clash"}
