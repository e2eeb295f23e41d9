import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ringledger.llm import spelling
from tests.llm import plain


def damaged(doc_id, run):
    run = run.translate({i: i + 32 for i in range(65, 91)})
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    at = h % len(run)
    return run[:at] + run[at + 1 :] if h % 97 == 0 else run


def near(a, b):
    """Whether two words differ by one inserted, deleted or replaced character, by trying them all."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def by_hand(counts):
    """(word, n, n_near, form, form_n, root) from the counts of all words, every word compared with every other."""
    known = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    forms, out = {}, []
    close = {w: [v for v in known if near(w, v)] for w in known}
    for w, n in known.items():
        best = min(close[w], key=lambda v: (-known[v], v), default=None)
        forms[w] = best if best and known[best] >= 2 * n else None
    for w, n in known.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, n, len(close[w]), forms[w], known.get(forms[w]), root))
    return sorted(out, key=repr)


COLUMNS = ["word", "n", "n_near", "form", "form_n", "root"]


def found(words):
    return plain.rows(spelling.variants(words).select(COLUMNS))


def word_table(spark, counts):
    df = spark.createDataFrame(list(counts.items()), "word string, times int")
    return df.select("word", F.explode(F.sequence(F.lit(1), "times"))).select("word")


def family(seed, size):
    """Counts of words made from a few stems by random edits, with runs of equal letters and chains of forms."""
    dice, letters = random.Random(seed), "abÉçÿ×"
    words = ["aaaaaa", "abababab", "ÉÉÉÉÉ", "zzzzz", "a" * 63, "b" * 64, "c" * 65, "d" * 300]
    while len(words) < size:
        w = list(dice.choice(words))
        at, kind = dice.randrange(len(w)), dice.randrange(3 if len(w) > 3 else 2)
        w[at : at + (kind > 0)] = [dice.choice(letters)] if kind < 2 else []
        words.append("".join(w))
    return {w: dice.choice([1, 3, 3, 4, 6, 12, 24, 50, 100]) for w in words}


@pytest.mark.parametrize("seed", [1, 2])
def test_against_every_pair(spark, seed):
    counts = family(seed, 400)
    got = found(word_table(spark, counts))
    assert got == by_hand(counts)
    assert any(r[5] not in (r[0], r[3]) for r in got)  # chains of several steps


def test_passes_and_full_filters_change_nothing(spark, monkeypatch):
    counts = family(3, 300)
    words = word_table(spark, counts)
    first = found(words)
    monkeypatch.setattr(spelling, "FILTER_BYTES", 64)
    monkeypatch.setattr(spelling, "CHUNK_BITS", 3)
    assert len(spelling._passes({5: 40, 6: 9})) > 3
    assert found(words) == first
    monkeypatch.setattr(spelling, "BITS_PER_WORD", 1)  # nearly everything is a false positive
    assert found(words) == first == by_hand(counts)


def test_hashes_of_edits_are_those_of_the_words():
    codes = spelling._codes(["aabcÿ", "zyxwv"])
    for rows, texts in spelling._deletions(codes, lambda h: np.arange(len(h))):
        assert set(zip(rows.tolist(), texts, strict=True)) == {
            (0, "abcÿ"), (0, "aacÿ"), (0, "aabÿ"), (0, "aabc"), (1, "yxwv"), (1, "zxwv"), (1, "zywv"), (1, "zyxv"), (1, "zyxw"),
        }
    held = []
    for _ in spelling._deletions(codes, lambda h: held.append(h) or np.arange(0)):
        pass
    shorter = spelling._hashes(spelling._codes(["abcÿ", "abcÿ", "aacÿ", "aabÿ", "aabc", "yxwv", "zxwv", "zywv", "zyxv", "zyxw"]))
    assert held[0].tolist() == shorter.tolist()


def test_edits_in_small_parts_are_the_same(monkeypatch):
    codes, alphabet = spelling._codes(["abcabc", "éabcab", "zzabcz"]), np.array([97, 99, 122, 233], dtype=np.uint8)

    def all_edits():
        keep = lambda h: np.arange(len(h))
        both = [*spelling._replacements(codes, alphabet, keep), *spelling._deletions(codes, keep)]
        return sorted((int(r), t) for rows, texts in both for r, t in zip(rows, texts, strict=True))

    first = all_edits()
    assert (0, "zbcabc") in first and (1, "zabcab") not in first and (2, "zabcz") in first
    monkeypatch.setattr(spelling, "EDITS", 7)
    assert all_edits() == first
    words = ["abcab", "a", "bb", "cc", "abcde"]
    parts = [(n, at.tolist(), w) for n, at, w in spelling._by_length(pd.Series(words))]
    assert [w for _, _, own in parts for w in own] == ["a", "bb", "cc", "abcab", "abcde"] and len(parts) == 4


def test_given_and_odd_documents(spark):
    rows = [*plain.ODD, *plain.texts(spark)][:120] + [(10, "Straße ÉCOLE École naïve×naïve " * 9), (None, "Hello wörld " * 3)]
    counts = Counter(damaged(i, run) for i, t in rows for run in re.findall(spelling.RUN, t or ""))
    docs = plain.documents(spark, rows).withColumns({c: F.lit("clash") for c in ("word", "run", "n", "form", "root", "shard")})
    assert found(spelling.words_of(docs, errors=True)) == by_hand(counts)


def test_empty(spark):
    assert found(spelling.words_of(plain.documents(spark, []))) == []
    assert found(spelling.words_of(plain.documents(spark, [(1, None), (2, "a b c"), (3, "hello")]))) == []


def test_no_product_in_the_plan(spark):
    words = spelling.words_of(plain.table(spark, "documents"))
    plan = spelling.variants(words)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
