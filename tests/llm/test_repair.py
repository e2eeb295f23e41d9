import hashlib
import itertools
import re
import zlib

import pytest

from ringledger.llm import repair
from tests.llm import plain

SHAPE = re.compile(r"(s?(ua)+)?\Z")
DDL = "conv_id long, turn long, role string, text string"


def every_audit(code, most_inserts=2):
    """Least (cost, audit) by trying all edits of all rows with up to some inserts anywhere."""
    best = None
    slots = ["", *["I" * n for n in range(1, most_inserts + 1)]]
    for edits in itertools.product("KRD", repeat=len(code)):
        for gaps in itertools.product(slots, repeat=len(code) + 1):
            audit = gaps[0] + "".join(e + g for e, g in zip(edits, gaps[1:], strict=True))
            if sum(e == "I" for e in audit) > most_inserts:
                continue
            done = applied(code, audit)
            if done is not None and (best is None or (done, audit) < best):
                best = done, audit
    return best


def applied(code, audit):
    """Cost of an audit, None if no choice of new roles gives a well-formed conversation."""
    cost, fixed, at = 0, [], 0
    for edit in audit:
        if edit == "I":
            cost += 2
            fixed.append("ua")
            continue
        initial, must_go, late = repair._CODE[code[at]]
        at += 1
        if edit == "D":
            cost += 3
        elif must_go:
            return None
        else:
            cost += late + (2 if edit == "R" else 0)
            fixed.append("ua" if edit == "R" else initial)
    return cost if any(SHAPE.match("".join(r)) for r in itertools.product(*fixed)) else None


@pytest.mark.parametrize("size", [0, 1, 2, 3])
def test_least_audit_of_every_short_code(size):
    alphabet = "suaoSUA02" if size < 3 else "suaU1"
    for code in map("".join, itertools.product(alphabet, repeat=size)):
        assert repair._best_end(code) == every_audit(code), code


def test_blocks_give_what_the_whole_gives():
    code = "".join("suaoSUAO0123uauauaua"[zlib.crc32(b"%d" % i) % 20] for i in range(300))
    for cut in (1, 7, 64):
        tables = [repair.block_table(code[i : i + cut]) for i in range(0, len(code), cut)]
        assert repair._of_blocks(tables) == repair._best_end(code)


def by_hand(rows):
    """Reports by one pass over each conversation in memory; rows are (conv_id, turn, role, text)."""
    out = []
    for conv in {r[0] for r in rows}:
        own = [(t, r, x) for c, t, r, x in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        code, faults, seen = "", [], set()
        for _, role, text in own:
            k = "sua".find(role[0]) if role else -1
            said = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "" if said[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append(fault)
            code += "0123"[k] if fault in ("blank", "duplicate") else "SUAO"[k] if fault else "suao"[k]
        cost, audit = repair._best_end(code)
        lines, at, last = [], 0, ""
        for edit in audit:
            role, text = ("", "") if edit == "I" else own[at][1:]
            at += edit != "I"
            if edit == "D":
                continue
            role = role if edit == "K" else "assistant" if last == "u" else "user"
            last = role[0]
            lines.append(f"{role}:{text}")
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        heads = [r[:1] for _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:], strict=False))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *counts, illegal, cost, audit, digest))
    return sorted(out, key=repr)


ODD = [
    (1, 0, "system", "Be brief."),
    (1, 1, "user", "Why?"),
    (1, 3, "assistant", "Because \n"),
    (1, 3, "assistant", "Because \n"),
    (2, None, " ", " "),
    (2, None, "tool", "x."),
    (2, 5, "", "no role."),
    (None, 1, "assistant", "A conversation without a number!"),
    (None, 2, "user", ""),
    (3, 1, "user", plain.LONG + "."),
    (4, 9, "system", "alone."),
    (5, 1, "usher", "Kept as it is."),
    (5, 2, "user", "Said twice."),
    (5, 2, "user", "Said twice."),
    (5, 2, "assistant", "End, no stop"),
]
LONG_ONE = [(9, i % 700, "user" if zlib.crc32(b"%d" % i) % 3 else "assistant", f"turn {i % 900}.") for i in range(1_500)]


def reported(spark, rows):
    return repair.reports(repair.live(spark.createDataFrame(rows, DDL)))


def test_reports_against_one_pass(spark):
    got = reported(spark, [*ODD, *LONG_ONE])
    assert plain.rows(got) == by_hand([*ODD, *LONG_ONE])


def test_given_conversations(spark):
    rows = [tuple(r) for r in repair.damaged(plain.table(spark, "conversations")).where("live").drop("live").collect()]
    found = {r[0]: r for r in plain.rows(repair.reports(repair.damaged(plain.table(spark, "conversations"))))}
    for line in by_hand(rows):
        assert found[line[0]] == line


def test_repaired_rows_are_well_formed(spark):
    got = repair.repaired(repair.live(spark.createDataFrame([*ODD, *LONG_ONE], DDL))).collect()
    lines = {}
    for r in sorted(got, key=lambda r: (str(r["conv_id"]), r["number"])):
        lines.setdefault(r["conv_id"], []).append(r)
    digests = {r["conv_id"]: r["repaired_sha256"] for r in reported(spark, [*ODD, *LONG_ONE]).collect()}
    for conv, own in lines.items():
        assert SHAPE.match("".join(r["role"][0] for r in own))
        assert [r["number"] for r in own] == list(range(1, len(own) + 1))
        text = "\n".join(f"{r['role']}:{r['text']}" for r in own)
        assert hashlib.sha256(text.encode()).hexdigest() == digests[conv]


def test_nulls_clashes_and_dropped_conversations(spark):
    rows = [(c, t, None if t == 1 else "user", None if t == 2 else "Yes.") for c in (None, 1, 2, 3) for t in (None, 1, 2, 3)]
    df = spark.createDataFrame(rows, DDL).selectExpr("*", "1 AS place", "2 AS live", "3 AS code", "4 AS block", "5 AS cut", "6 AS kind")
    got = {r["conv_id"]: r for r in repair.reports(repair.damaged(df)).collect()}
    assert set(got) == {None, 1, 2, 3}
    gone = repair.reports(repair.damaged(df).selectExpr("conv_id", "turn", "role", "text", "false AS live"))
    empty = hashlib.sha256(b"").hexdigest()
    assert {tuple(r)[1:] for r in gone.collect()} == {(0, 0, 0, 0, 0, 0, "", empty)}


def test_empty(spark):
    assert reported(spark, []).collect() == []
    assert repair.repaired(repair.live(spark.createDataFrame([], DDL))).collect() == []
