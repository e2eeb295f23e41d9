"""Small tables and plain versions that the operators are held against."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LONG = " ".join(f"word{i % 977} and" for i in range(40_000))

#: ids and texts of every odd kind: nulls, empties, blanks, repeated rows, two texts of one id, a very long text.
ODD = [
    (None, "a row without an id"),
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "!!! 123 ???"),
    (5, "x"),
    (6, "The same row twice, word for word."),
    (6, "The same row twice, word for word."),
    (7, "one text of an id"),
    (7, "another text of this id"),
    (8, LONG),
    (9, "Ünïcode   and nul \x00 and é"),
]


def documents(spark, rows=None):
    """Documents with further columns whose names clash with what operators use inside."""
    df = spark.createDataFrame(ODD if rows is None else rows, "doc_id long, text string")
    clash = ["id", "version", "label", "fp", "n", "pos", "key", "hit", "rep", "score", "item_id", "gram", "__id", "n_lines"]
    clash += ["__version", "__dropped", "__lines", "__kept", "__KEPT_", "__copies", "__gone", "head", "row", "a.b"]
    return df.select("*", *[F.lit("clash").alias(c) for c in clash], F.create_map(F.lit("k"), F.lit("clash")).alias("map"))


def table(spark, name, folder=SMALL):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark, folder=SMALL):
    return [tuple(r) for r in table(spark, "documents", folder).select("doc_id", "text").collect()]


def line_dedup(rows, min_chars=10, threshold=2):
    """Sorted (id, lines, dropped, text left) of rows with ids."""
    upper = {i: i + 32 for i in range(65, 91)}
    holders = defaultdict(set)
    parts = [(i, [(x, x.strip(" \t\n\x0b\x0c\r").translate(upper)) for x in (t or "").split("\n")]) for i, t in rows]
    for i, lines in parts:
        for _, key in lines:
            if i is not None and len(key) >= min_chars:
                holders[key].add(i)
    out = []
    for i, lines in parts:
        kept = [x for x, k in lines if i is None or len(holders.get(k, ())) < threshold or i == min(holders[k])]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def repeats(rows, length):
    """Sorted (id, bytes, bytes left, spans) after removing what equal strings of `length` bytes cover."""
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + length] for _, b in data for k in range(len(b) - length + 1))
    out = []
    for i, b in data:
        spans = []
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                if spans and spans[-1][1] >= k:
                    spans[-1][1] = k + length
                else:
                    spans.append([k, k + length])
        edges = [0, *[x for s in spans for x in s], len(b)]
        kept = b"".join(b[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True))
        out.append((i, len(b), kept, tuple(map(tuple, spans))))
    return sorted(out, key=repr)


def fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    votes = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, seed=42)
        votes.update(k for k in range(64) if h >> k & 1)
    return sum(1 << k for k in range(64) if votes[k] * 2 > len(shingles))


def groups(prints, bits=2):
    """{id: smallest id reachable} of {id: fingerprint}."""
    left, out = set(prints), {}
    for start in sorted(prints):
        if start in left:
            left.discard(start)
            todo = [start]
            while todo:
                x = todo.pop()
                out[x] = start
                near = [y for y in left if (prints[x] ^ prints[y]).bit_count() <= bits]
                left.difference_update(near)
                todo += near
    return out


def words(text):
    return [w for w in re.split("[ \t\n\x0b\x0c\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def shingles(own, size):
    return {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}


def contained(docs, items):
    """Sorted (doc id, item id, shingles, shared) of items held to 0.8 and more; items under five words in one piece."""
    out, asked = [], [(i, words(q)) for i, q in items]
    for d, t in docs:
        own = words(t)
        has = {k: shingles(own, k) for k in range(1, 6)}
        for i, q in asked:
            k = min(5, len(q))
            want = shingles(q, k) if k else set()
            if want and len(want & has[k]) * 5 >= len(want) * 4:
                out.append((d, i, len(want), len(want & has[k])))
    return sorted(out, key=repr)


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
