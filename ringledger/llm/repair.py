"""Conversation structure repair by lightest derivations.

A repaired conversation has role initials `(s?(ua)+)?`. The grammar has four states: nothing yet, after `s`, after `u`, after
`a`. An item [i, q] says that the first i rows can be edited so that the grammar is in state q; a deduction adds one edit to
it. Items leave an agenda in the order of (cost, audit), the audit being the edits' initials; each deduction adds to the
cost and appends to the audit, so its result is never less than the item it started from, and an item is final when it
leaves the agenda (Knuth's condition). The search ends when the goal item is final.

A long conversation is cut into blocks of rows. Every block is an item [i, k, p, q] of its own, derived in its own task for
each pair of states; blocks are joined two by two, [i, j, p, r] and [j, k, r, q] to [i, k, p, q]. The least audit of a whole
consists of least audits of its parts: of two audits of one block with one cost neither begins the other, since a further
insert would cost more.
"""

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ringledger.llm.common import bounded_batches, stored

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
ROLES = {"u": "user", "a": "assistant"}
#: Grammar: state and role initial to the next state; a conversation may end in a state of ENDS.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
STATES, ENDS = range(4), (0, 3)
#: Rows of a block: places are cut after this many bits.
BLOCK_BITS = 8
#: Longest code that is kept for the next conversation of the same shape.
CACHED = 24

# One character tells of a row what the search needs: its initial, in capitals if truncated, a digit if it must go.
_INITIALS = "suao"
_CODE = {c: (c, False, 0) for c in _INITIALS}
_CODE |= {c.upper(): (c, False, TRUNCATED_COST) for c in _INITIALS}
_CODE |= {str(i): (c, True, 0) for i, c in enumerate(_INITIALS)}
_LEGAL = {"su", "ua", "au"}
_NOT_BLANK = r"[^\x20\x09-\x0D]"

Item = tuple[int, int]
Weighted = tuple[int, str]


def _deductions(code: str, item: Item) -> Iterator[tuple[Item, int, str]]:
    """What follows from an item: the next item, the cost and the initial of the edit."""
    at, state = item
    steps = [(role, STEP[state, role]) for role in ROLES if (state, role) in STEP]
    for _, after in steps:
        yield (at, after), COST[INSERT], INSERT
    if at == len(code):
        return
    initial, must_go, extra = _CODE[code[at]]
    yield (at + 1, state), COST[DELETE], DELETE
    if must_go:
        return
    if (state, initial) in STEP:
        yield (at + 1, STEP[state, initial]), COST[KEEP] + extra, KEEP
    for _, after in steps:
        yield (at + 1, after), COST[REROLE] + extra, REROLE


def lightest(code: str, start: int, goals: set[int]) -> dict[int, Weighted]:
    """Least (cost, audit) with which the rows of `code` lead from state `start` to each of the states `goals`."""
    agenda: list[tuple[int, str, Item]] = [(0, "", (0, start))]
    final: dict[Item, Weighted] = {}
    open_goals, end = set(goals), len(code)
    while agenda and open_goals:
        cost, audit, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = cost, audit
        if item[0] == end:
            open_goals.discard(item[1])
        for after, more, edit in _deductions(code, item):
            if after not in final:
                heapq.heappush(agenda, (cost + more, audit + edit, after))
    return {q: final[end, q] for q in goals if (end, q) in final}


def _best_end(code: str) -> Weighted:
    return min(lightest(code, 0, set(ENDS)).values())


_cached_end = lru_cache(100_000)(_best_end)


def block_table(code: str) -> list[tuple[int, int, int, str]]:
    """(p, q, cost, audit) of a block for every pair of states."""
    return [(p, q, *w) for p in STATES for q, w in lightest(code, p, set(STATES)).items()]


def joined_tables(left: list, right: list) -> list:
    """The table of two neighbouring blocks together."""
    best: dict[tuple[int, int], Weighted] = {}
    for p, r, cost, audit in left:
        for r2, q, more, rest in right:
            if r == r2:
                both = cost + more, audit + rest
                if (p, q) not in best or both < best[p, q]:
                    best[p, q] = both
    return [(p, q, *w) for (p, q), w in best.items()]


def _of_blocks(tables: list) -> Weighted:
    while len(tables) > 1:
        pairs = [joined_tables(*tables[i : i + 2]) for i in range(0, len(tables) - 1, 2)]
        tables = pairs + tables[len(tables) // 2 * 2 :]
    return min((cost, audit) for p, q, cost, audit in tables[0] if p == 0 and q in ENDS)


class Editor:
    """Applies an audit to rows, one after the other; keeps no more than the state of the grammar."""

    def __init__(self):
        self.state = 0

    def _next_role(self) -> str:
        role = "a" if self.state == 2 else "u"
        self.state = STEP[self.state, role]
        return ROLES[role]

    def insert(self) -> tuple[str, str]:
        return self._next_role(), ""

    def edit(self, letter: str, role: str, text: str) -> tuple[str, str] | None:
        if letter == DELETE:
            return None
        if letter == REROLE:
            return self._next_role(), text
        self.state = STEP[self.state, role[0]]
        return role, text


def _slices(audit: str, sizes: list[int]) -> list[str]:
    """The audit cut by blocks: the edits of a block's rows with the inserts before them; the last takes the rest."""
    out, at = [], 0
    for size in sizes:
        start = at
        while size:
            size -= audit[at] != INSERT
            at += 1
        out.append(audit[start:at])
    out[-1] += audit[at:]
    return out


_TABLE = "array<struct<p int, q int, cost bigint, audit string>>"
_FOUND = "struct<cost bigint, audit string, illegal bigint, gaps bigint, cuts array<string>>"


def _tables(codes: pd.Series) -> pd.Series:
    return codes.map(lambda c: [dict(zip(("p", "q", "cost", "audit"), row, strict=True)) for row in block_table(c)])


def _found(blocks: list[dict]) -> dict:
    """What is found for a conversation from its blocks in order."""
    code = "".join(b["code"] for b in blocks)
    if len(blocks) == 1:
        cost, audit = (_cached_end if len(code) <= CACHED else _best_end)(code)
    else:
        rows = [[(t["p"], t["q"], t["cost"], t["audit"]) for t in b["table"]] for b in blocks]
        cost, audit = _of_blocks(rows)
    initials = [_CODE[c][0] for c in code]
    illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:], strict=False))
    turned = [b for b in blocks if b["turns"]]
    gaps = 0
    if turned:
        distinct = sum(b["turns"] for b in turned)
        distinct -= sum(a["last"] == b["first"] for a, b in zip(turned, turned[1:], strict=False))
        gaps = turned[-1]["last"] - turned[0]["first"] + 1 - distinct
    cuts = _slices(audit, [len(b["code"]) for b in blocks])
    return {"cost": cost, "audit": audit, "illegal": illegal, "gaps": gaps, "cuts": cuts}


def _solved(blocks: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_found(list(b)) for b in blocks])


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, live): rows damaged by crc32(`conv_id:turn`) % 20, null cells read as one space.

    0 drops a row (`live` is false), 1 empties its text, 2 takes its `.`, `!` and `?`, 3 repeats it, 4 makes it a user's.
    """
    blank = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        text.alias("text"),
        (kind != 0).alias("live"),
        copies.alias("copies"),
    )
    return rows.select("*", F.explode("copies").alias("copy")).drop("copies", "copy")


def _ordered(rows: DataFrame) -> DataFrame:
    """The rows with `place`, which rises in the order of conversations and turns, and a digest of role and text."""
    # the beginning of a text is enough to deal out rows; whole texts in the bounds would go through the driver
    near = [F.col("conv_id"), F.col("turn"), F.col("role"), F.substring("text", 1, 32)]
    said = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    placed = rows.repartitionByRange(*near).sortWithinPartitions("conv_id", "turn", "role", "text")
    return stored(rows.sparkSession, placed.select("*", said.alias("said"), F.monotonically_increasing_id().alias("place")))


def _coded(ordered: DataFrame) -> DataFrame:
    """(conv_id, place, turn, live, code, fault) of each row."""
    live = ordered.where("live")
    firsts = live.groupBy("conv_id", "said").agg(F.min("place").alias("first")).select("first")
    blank = ~F.col("text").rlike(_NOT_BLANK)
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    narrow = ordered.select(
        "conv_id", "place", "turn", "live", F.substring("role", 1, 1).alias("initial"), blank.alias("blank"), cut.alias("cut")
    )
    fault = (
        F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated").otherwise("")
    )
    kind = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    code = (
        F.when(F.col("fault").isin("blank", "duplicate"), F.translate(kind, _INITIALS, "0123"))
        .when(F.col("fault") == "truncated", F.upper(kind))
        .otherwise(kind)
    )
    # joined by place, which no two rows share, however often one text is repeated
    judged = narrow.join(firsts, F.col("place") == F.col("first"), "left").withColumn("fault", fault)
    return judged.select("conv_id", "place", "turn", "live", code.alias("code"), "fault")


def _blocks(coded: DataFrame) -> DataFrame:
    """One row per conversation and block of places, with at most 256 rows gathered."""
    row = F.when(F.col("live"), F.struct("place", "code", "turn"))
    gathered = coded.groupBy("conv_id", F.shiftright("place", BLOCK_BITS).alias("block")).agg(
        F.sort_array(F.collect_list(row)).alias("rows"),
        *[F.count(F.when(F.col("live") & (F.col("fault") == f), 1)).alias(f) for f in ("blank", "duplicate", "truncated")],
    )
    turns = F.filter(F.col("rows.turn"), lambda t: t.isNotNull())
    return gathered.select(
        "conv_id",
        "block",
        F.array_join("rows.code", "").alias("code"),
        F.array_min(turns).alias("first"),
        F.array_max(turns).alias("last"),
        F.size(F.array_distinct(turns)).alias("turns"),
        "blank",
        "duplicate",
        "truncated",
    )


def audits(ordered: DataFrame) -> DataFrame:
    """One row per conversation: counts of faults, gaps, illegal neighbours, cost, audit, and `parts` by block."""
    tables = F.pandas_udf(_tables, _TABLE)
    solved = F.pandas_udf(_solved, _FOUND)
    blocks = _blocks(_coded(ordered)).withColumn("table", tables("code"))
    per = F.sort_array(F.collect_list(F.struct("block", "code", "first", "last", "turns", "table"))).alias("blocks")
    found = blocks.groupBy("conv_id").agg(per, *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    return found.withColumn("found", solved("blocks")).select(
        "conv_id",
        "found.gaps",
        "blank",
        "duplicate",
        "truncated",
        "found.illegal",
        "found.cost",
        "found.audit",
        F.arrays_zip(F.col("blocks.block").alias("block"), F.col("found.cuts").alias("cut")).alias("parts"),
    )


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(head, number, edit, role, text) of the repaired rows, conversation by conversation; a head alone opens each."""
    head, editor, left, number = None, Editor(), "", 0
    conversation = fresh = object()

    def inserts():
        nonlocal left, number
        while left[:1] == INSERT:
            left, number = left[1:], number + 1
            yield head, number, INSERT, *editor.insert()

    for batch in batches:
        for row in batch.to_pylist():
            if row["cut"] is not None:  # the head of a block comes before its rows
                yield from inserts()
                if conversation is fresh or row["conv_id"] != conversation:
                    conversation, head, editor, number = row["conv_id"], row, Editor(), 0
                    yield head, None, None, None, None
                left = row["cut"]
                continue
            yield from inserts()
            edit, left = left[0], left[1:]
            kept = editor.edit(edit, row["role"], row["text"])
            if kept:
                number += 1
                yield head, number, edit, *kept
    yield from inserts()


def _rows_out(kind: T.StructType):
    """Repaired rows as batches."""

    def run(batches):
        rows = []
        for head, number, edit, role, text in _turns(batches):
            if number is not None:
                rows.append((head["conv_id"], number, edit, role, text))
            if len(rows) >= 1_000:
                yield _batch(rows, kind)
                rows = []
        yield _batch(rows, kind)

    return run


def _reports_out(kind: T.StructType):
    """A line per conversation; the hash is carried on, so that a conversation of any length needs no more memory."""

    def run(batches):
        rows, digest, last = [], None, None
        for head, number, _, role, text in _turns(batches):
            if number is None:
                if last is not None:
                    rows.append(_line(last, digest))
                last, digest = head, hashlib.sha256()
            else:
                digest.update(("\n" if number > 1 else "").encode() + f"{role}:{text}".encode())
            if len(rows) >= 1_000:
                yield _batch(rows, kind)
                rows = []
        if last is not None:
            rows.append(_line(last, digest))
        yield _batch(rows, kind)

    return run


def _line(head: dict, digest) -> tuple:
    return head["conv_id"], *[head[c] for c in _COUNTS], head["audit"], digest.hexdigest()


def _batch(rows: list[tuple], kind: T.StructType) -> pa.RecordBatch:
    schema = to_arrow_schema(kind)
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _streamed(rows: DataFrame, out, extra: list[T.StructField]) -> DataFrame:
    """Runs `out` over heads and rows, sorted by conversation and place."""
    bounded_batches(rows.sparkSession)
    ordered = _ordered(rows.select("conv_id", "turn", "role", "text", "live"))
    heads = audits(ordered).select("*", F.posexplode("parts").alias("_at", "_part")).select(
        "conv_id",
        F.col("_part.block").alias("block"),
        F.lit(-1).cast("bigint").alias("place"),
        F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("text"),
        F.col("_part.cut").alias("cut"),
        # counts and the audit go with the first block only
        *[F.when(F.col("_at") == 0, F.col(c)).alias(c) for c in (*_COUNTS, "audit")],
    )
    none = F.lit(None)
    lines = ordered.where("live").select(
        "conv_id",
        F.shiftright("place", BLOCK_BITS).alias("block"),
        "place",
        "role",
        "text",
        none.cast("string").alias("cut"),
        *[none.cast("bigint").alias(c) for c in _COUNTS],
        none.cast("string").alias("audit"),
    )
    order = ["conv_id", "block", "place"]
    both = heads.unionByName(lines).repartition("conv_id").sortWithinPartitions(*order)
    schema = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), *extra])
    return both.mapInArrow(out(schema), schema)


def reports(rows: DataFrame) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    `rows` has conv_id, turn, role, text without nulls in the last two, and `live`: a row that is not live only makes its
    conversation appear. The rows of a conversation stand by turn (nulls first), then role, then text, so that equal turns
    have one order; repeated rows stay repeated. A null conv_id is a conversation like any other. One without live rows has
    zeros, an empty audit and the hash of the empty text. Other columns are ignored. An empty table gives an empty one.

    Rows are dealt out by range, at most 256 are gathered at a time, and texts are read as a sorted stream; a conversation
    of any length is cut into blocks for the search. What its last step holds in one task is its audit, which the result has
    in one cell, and the digest of its text is necessarily computed in the order of its rows.
    """
    extra = [*[(c, T.LongType()) for c in _COUNTS], ("audit", T.StringType()), ("repaired_sha256", T.StringType())]
    return _streamed(rows, _reports_out, [T.StructField(*f) for f in extra])


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, number, edit, role, text): the repaired rows, numbered from 1; input as for `reports`."""
    extra = [("number", T.LongType()), ("edit", T.StringType()), ("role", T.StringType()), ("text", T.StringType())]
    return _streamed(rows, _rows_out, [T.StructField(*f) for f in extra])


def live(conversations: DataFrame) -> DataFrame:
    """Conversations as they are, in the form that `reports` and `repaired` take; null cells are one space."""
    blank: Column = F.lit(" ")
    texts = [F.coalesce(F.col(c), blank).alias(c) for c in ("role", "text")]
    return conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), *texts, F.lit(True).alias("live"))
