import numpy as np
import pytest
from pyspark.sql import functions as F

from ringledger.llm import decontam as D
from tests.llm import plain

ITEMS = [(1, None), (2, ""), (3, "one text of an id"), (4, "X"), (5, "one text of an id"), (None, "word5 and word6 and word7 and")]
ITEMS += [(7, "Word8  and"), (8, "same ROW twice,"), (9, "row without an id"), (10, "without a"), (11, "id\n"), (12, "a a a a a a a")]


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("doc_id", F.lit(0))


@pytest.mark.parametrize("most", [16 << 20, 1])
def test_against_plain(spark, monkeypatch, most):
    if most == 1:  # a filter that lets every hash through only costs rows
        monkeypatch.setattr(D, "hash_filter", lambda hashes: np.full(1 << 10, 255, np.uint8))
    bench = [tuple(r) for r in plain.table(spark, "benchmark").collect()]
    rows = [*plain.texts(spark), *plain.ODD]
    for k, (_, text) in enumerate(bench[:12]):  # cut, changed and embedded passages around the threshold
        words = text.split()
        rows.append((5_000 + k, "before " * k + " ".join(words[k % 7 :]) + " after"))
        rows.append((6_000 + k, " ".join(w if j != 6 else "changed" for j, w in enumerate(words)).upper()))
    got = D.contaminated(plain.documents(spark, rows), items(spark, [*bench, *ITEMS]))
    assert plain.rows(got.drop("containment")) == plain.contained(rows, [*bench, *ITEMS])


def test_clean_documents_stay(spark):
    bench = [tuple(r) for r in plain.table(spark, "benchmark").collect()]
    docs = plain.table(spark, "documents")
    held = {r[0] for r in plain.contained(plain.texts(spark), bench)}
    left = {r["doc_id"] for r in D.decontaminate(docs, plain.table(spark, "benchmark")).collect()}
    assert held and left == {i for i, _ in plain.texts(spark)} - held
    assert D.decontaminate(plain.documents(spark), items(spark, ITEMS)).columns == plain.documents(spark).columns


def test_short_items_are_found_inside_long_documents(spark):
    docs = plain.documents(spark, [(1, plain.LONG), (2, "word976 and"), (3, "and word976"), (4, None), (2, "x word976 AND y")])
    got = D.contaminated(docs, items(spark, [(1, "word976 and"), (2, "and word976 and word0 and word1"), (3, "word976")]))
    assert plain.rows(got.select("doc_id", "item_id")) == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 1), (2, 3), (2, 3), (3, 3)]


def test_empty_tables(spark):
    docs = plain.documents(spark)
    none = D.contaminated(docs, items(spark, []))
    assert none.collect() == [] and none.columns == ["doc_id", "item_id", "n_shingles", "n_shared", "containment"]
    assert D.contaminated(docs.where("false"), items(spark, ITEMS)).collect() == []
    assert D.decontaminate(docs, items(spark, [])).count() == len(plain.ODD)


def test_word_hashes_do_not_depend_on_the_place():
    hashes = D.WordHashes()
    _, a = hashes(b"alpha beta gamma")
    _, b = hashes(b"  x " * 500 + b"\tbeta\n\ngamma alpha")
    assert (a[1], a[2], a[0]) == tuple(b[-3:]) and len(set(a.tolist())) == 3
