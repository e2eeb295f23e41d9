import pytest

from ringledger.llm import line_dedup
from tests.llm import plain

ROWS = [
    (5, "A shared line of text\nown line of five\n  a SHARED line of text\t"),
    (3, "\x0ba shared line of text\nshort\nshort"),
    (9, "short\nÉcole est finie ici\n\n"),
    (4, "école est finie ici\nÉcole est finie ici\r"),
    (4, "École est finie ici"),
]


@pytest.mark.parametrize("threshold", [2, 3])
def test_against_plain(spark, threshold):
    rows = [*plain.ODD, *ROWS, *plain.texts(spark)]
    got = line_dedup.dedup_lines(plain.documents(spark, rows), threshold=threshold)
    assert "__id" not in line_dedup.dropped_positions(plain.documents(spark, rows), "doc_id", "text").columns
    assert plain.rows(got.select("doc_id", "n_lines", "n_dropped", "text")) == plain.line_dedup(rows, threshold=threshold)


def test_other_columns_stay(spark):
    got = line_dedup.dedup_lines(plain.documents(spark, ROWS))
    assert {r["label"] for r in got.collect()} == {"clash"}


def test_empty(spark):
    assert line_dedup.dedup_lines(plain.documents(spark, [])).collect() == []


def test_plan_is_native(spark):
    plan = line_dedup.dedup_lines(plain.table(spark, "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
