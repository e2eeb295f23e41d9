from collections.abc import Iterator

import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from ringledger.llm import quality
from ringledger.llm.common import lent, remainder
from tests.llm import plain

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd(spark):
    return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t)) for i, t in plain.ODD], SCHEMA)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


@pytest.mark.parametrize("kind", ["table", "odd", "empty"])
def test_stages_against_plain_versions(spark, kind):
    docs = {"table": plain.table(spark, "documents"), "odd": odd(spark), "empty": odd(spark).where("false")}[kind]
    columns, folder = docs.columns, plain.SMALL
    steps = dict(P.STAGES)

    good = steps["quality"](spark, docs, folder)
    field = quality.fit_quality(docs, plain.table(spark, "labels"), remainder("doc_id", 5) != 0)
    rows = pairs(docs)
    want = [r for r, s in zip(rows, field.scores([t for _, t in rows]), strict=True) if s >= 0.3]
    assert sorted(pairs(good), key=repr) == sorted(want, key=repr) and good.columns == columns

    lines = steps["line_dedup"](spark, good, folder)
    assert sorted(pairs(lines), key=repr) == sorted([(i, t) for i, _, _, t in plain.line_dedup(want)], key=repr)
    assert lines.columns == columns and lines.where(F.col("n_chars") != F.char_length("text")).count() == 0

    once = steps["simhash"](spark, lines, folder)
    if kind == "table":
        rows = dict(pairs(lines))
        head = plain.groups({i: plain.fingerprint(t) for i, t in rows.items()})
        assert {i for i, _ in pairs(once)} == {i for i in rows if head[i] == i}
    assert once.columns == columns

    clean = steps["decontamination"](spark, once, folder)
    bench = [tuple(r) for r in plain.table(spark, "benchmark").collect()]
    held = {r[0] for r in plain.contained(pairs(once), bench)}
    assert sorted(pairs(clean), key=repr) == sorted([r for r in pairs(once) if r[0] not in held], key=repr)

    coded = steps["bpe"](spark, clean, folder)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, t in pairs(clean):
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), plain.sha(" ".join(map(str, ids))), plain.sha(back)))
    assert plain.rows(coded) == sorted(want, key=repr)


def test_run(spark):
    docs = plain.table(spark, "documents")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, plain.SMALL)
    assert plain.rows(P.run(spark, plain.SMALL)) == plain.rows(docs)


def test_workers_keep_no_pool_of_freed_memory(spark):
    docs = odd(spark)

    @F.pandas_udf("string")
    def pool(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in lent(batches):
            yield batch.map(lambda _: pa.default_memory_pool().backend_name)

    assert {r[0] for r in docs.select(pool(F.lit("x"))).collect()} == {"system"}
