import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ringledger.llm import suffix_dedup as S
from tests.llm import plain


def result(df):
    return sorted(
        ((r["doc_id"], r["n_bytes"], bytes(r["kept"]), tuple(zip(r["starts"], r["ends"], strict=True))) for r in df.collect()),
        key=repr,
    )


def test_small_table(spark):
    rows = plain.texts(spark)
    assert result(S.remove_repeats(plain.table(spark, "documents"))) == plain.repeats(rows, S.LENGTH)


def made(seed):
    """Texts of few letters with planted copies, runs, ends cut off and NUL bytes."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab\x00é") for _ in range(rng.randint(0, 90))) for _ in range(25)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(25, 60):
        a, b = rng.choice(base), rng.choice(base)
        rows.append((i, a[rng.randint(0, 20) :] + "".join(rng.choice("xyz") for _ in range(rng.randint(0, 4))) + b[: rng.randint(0, 60)]))
    return [*rows, (60, "ab" * 40), (61, "a" * 50), (61, "a" * 50), (None, base[0]), (62, None), (63, "")]


@pytest.mark.parametrize(("seed", "group"), [(1, 50_000), (2, 50_000), (1, 2), (3, 1)])
def test_made_texts(spark, seed, group):
    rows = made(seed)
    got = S.remove_repeats(plain.documents(spark, rows), length=12, gram=5, group=group)
    assert result(got) == plain.repeats(rows, 12)


def test_odd_and_empty(spark):
    got = result(S.remove_repeats(plain.documents(spark)))
    assert [(r[0], r[1]) for r in got] == [(r[0], r[1]) for r in plain.repeats(plain.ODD, S.LENGTH)]
    assert next(r for r in got if r[0] == 8)[2] != plain.LONG.encode()  # its words repeat in cycles
    assert S.remove_repeats(plain.documents(spark, [])).collect() == []


def test_repeated_rows_repeat_everything(spark):
    text = "".join(chr(97 + (i * i) % 26) for i in range(150)) + "".join(chr(65 + (i * 7 + i * i) % 26) for i in range(150))
    rows = [(1, text), (1, text)]
    assert result(S.remove_repeats(plain.documents(spark, rows))) == plain.repeats(rows, 200)


def test_pieces_of_a_long_text(monkeypatch):
    rng = np.random.default_rng(5)
    text = bytes(rng.integers(97, 123, 5_000, dtype=np.uint8))
    (_, at, h), = S.text_anchors([text], 200, 48)
    monkeypatch.setattr(S, "PIECE", 300)
    (_, at2, h2), = S.text_anchors([text], 200, 48)
    assert at.tolist() == at2.tolist() and h.tolist() == h2.tolist()
    assert np.diff(at).max() <= 200 - 48 + 1


def test_maximal_repeats():
    rng = random.Random(3)
    for _ in range(200):
        size = rng.randint(2, 12)
        contexts = {("".join(rng.choice("ab") for _ in range(rng.randint(0, 5))), "".join(rng.choice("ab") for _ in range(rng.randint(1, 6)))) for _ in range(size)}
        contexts = sorted(((a.encode(), b"##" + b.encode()) for a, b in contexts), key=lambda c: (c[1], c[0]))
        lefts, rights = [c[0] for c in contexts], [c[1] for c in contexts]
        want = set()
        common = lambda x, y: next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
        for i in range(len(contexts)):
            for j in range(i):
                before, after = common(lefts[i], lefts[j]), common(rights[i], rights[j])
                if before + after >= 5:
                    a, b = lefts[i][:before], rights[i][:after]
                    members = tuple(k for k in range(len(contexts)) if lefts[k].startswith(a) and rights[k].startswith(b))
                    want.add((before, after, members))
        got = {(x, y, tuple(sorted(m))) for x, y, m in S.maximal_repeats(lefts, rights, 5)}
        assert got == want


def test_sums(spark):
    got = S.remove_repeats(plain.table(spark, "documents")).select("n_bytes", F.octet_length("kept").alias("k"), "starts", "ends")
    for r in got.collect():
        assert r["n_bytes"] - r["k"] == sum(b - a for a, b in zip(r["starts"], r["ends"], strict=True))
