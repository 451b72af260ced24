import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest

from tallyveil.llm.conversation import LAST, audited, matrices, op11_sql, ranked, repair_audit, repaired, solve, undamaged
from tallyveil.llm.queries import op11_conversation_repair

from ..conftest import SF

ROW = "conv_id long, turn long, role string, text string, code string"
LEGAL = re.compile(r"(s?(ua)+)?")


def test_query_against_sql(spark, same_as_sql):
    same_as_sql(op11_conversation_repair(spark, SF), op11_sql())


def faults(rows):
    """(initial, must go, truncated) of rows (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        blank, copy = not bare, (role, text) in seen
        seen.add((role, text))
        out.append((role[:1] if role[:1] in ("s", "u", "a") else "x", blank, not blank and copy, not blank and not copy and bare[-1] not in ".!?"))
    return out


def every_repair(marks):
    """The cheapest repair by trying all: cost, audit, kept (row or None, role)."""
    best = None
    some = ["", "u", "a", "ua", "au"]
    for edits in itertools.product("DKua", repeat=len(marks)):
        if any(e != "D" and (m[1] or m[2]) for e, m in zip(edits, marks)):
            continue
        for put in itertools.product(some, repeat=len(marks) + 1):
            roles, audit, cost, kept = put[0], "I" * len(put[0]), 2 * len("".join(put)), [(None, r) for r in put[0]]
            for i, (e, m) in enumerate(zip(edits, marks)):
                audit += e if e in "DK" else "R"
                cost += {"D": 3, "K": 0}.get(e, 2) + (m[3] if e != "D" else 0)
                if e != "D":
                    roles += m[0] if e == "K" else e
                    kept.append((i, None if e == "K" else e))
                roles += put[i + 1]
                audit += "I" * len(put[i + 1])
                kept += [(None, r) for r in put[i + 1]]
            if LEGAL.fullmatch(roles) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, kept)
    return best


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    marks = faults([r[1:] for r in rows])
    cost, audit, kept = every_repair(marks) if rows else (0, "", [])
    names = {"u": "user", "a": "assistant"}
    text = "\n".join(f"{names.get(role) or rows[i][1]}:{rows[i][2] if i is not None else ''}" for i, role in kept)
    turns = {r[0] for r in rows if r[0] is not None}
    pairs = [a[0] + b[0] for a, b in zip(marks, marks[1:])]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, sum(m[1] for m in marks), sum(m[2] for m in marks), sum(m[3] for m in marks),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest(),
    )


def made(rng, n, conv):
    roles, texts = ["user", "assistant", "system", "tool", "", None], ["Yes.", "No", "Why?", "", " \n", None, "Ho! ", "yes"]
    return [(conv, None if rng.random() < 0.1 else int(rng.integers(0, 6)), roles[rng.choice(6, p=[0.3, 0.3, 0.2, 0.1, 0.05, 0.05])], texts[rng.integers(0, 8)], "x") for _ in range(n)]


@pytest.mark.parametrize("block", [1, 2, 3, 1000])
def test_repairs_against_all_edits(spark, block):
    rng = np.random.default_rng(block)
    rows = [r for c in range(24) for r in made(rng, int(rng.integers(0, 4)) or 3, c or None)]
    df = spark.createDataFrame(rows, ROW).repartition(3)
    got = {r[0]: tuple(r[1:]) for r in audited(undamaged(df), df, block=block).collect()}
    by = {}
    for c, turn, role, text, _ in rows:
        by.setdefault(c, []).append((turn, " " if role is None else role, " " if text is None else text))
    assert got == {c: expected(r) for c, r in by.items()}


def test_damage(spark):
    rng = np.random.default_rng(9)
    rows = [r for c in range(60) for r in made(rng, 2, c or None)] + [(7, 1, "user", "Hm.", "x")] * 2
    dropped = next(c for c in range(100, 999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "Hm.", "x"))
    by = {r[0]: [] for r in rows}
    for c, turn, role, text, _ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        harm = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        by[c] += [(turn, "user" if harm == 4 else role, text)] * {0: 0, 3: 2}.get(harm, 1)
    got = {r[0]: tuple(r[1:]) for r in repair_audit(spark.createDataFrame(rows, ROW)).collect()}
    few = {c: r for c, r in by.items() if len(r) < 5}
    assert len(few) > 50 and {c: got[c] for c in few} == {c: expected(r) for c, r in few.items()} and set(got) == set(by)
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair_audit(spark.createDataFrame([], ROW)).collect() == []


def test_blocks_give_what_one_block_gives(spark):
    rng = np.random.default_rng(2)
    rows = [(1, i, ("user", "assistant", "system", "tool")[rng.choice(4, p=[0.4, 0.4, 0.1, 0.1])], f"{i // 2 % 37} w{'.' if rng.random() < 0.7 else ''}", "") for i in range(300)]
    df = spark.createDataFrame(rows + [(2, 1, "user", "a.", ""), (2, 2, "assistant", "b.", "")], ROW)
    one, many = (sorted(map(tuple, audited(undamaged(df), df, block=b).collect())) for b in (10_000, 7))
    assert one == many and one[1][1:] == (0, 0, 0, 0, 0, 0, "KK", hashlib.sha256(b"user:a.\nassistant:b.").hexdigest())


def test_repaired_rows_are_what_was_digested(spark):
    rng = np.random.default_rng(4)
    rows = [r for c in range(30) for r in made(rng, int(rng.integers(1, 7)), c)]
    df = spark.createDataFrame(rows, ROW)
    digests = {r.conv_id: r.repaired_sha256 for r in audited(undamaged(df), df).collect()}
    by = {c: [] for c in digests}
    for r in sorted(repaired(df, block=2).collect(), key=lambda r: (r.conv_id, r.place, r.sub)):
        by[r.conv_id].append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(t).encode()).hexdigest() for c, t in by.items()} == digests


def test_ranks_compare_ever_longer_audits():
    # 0 -D-> 1 -I-> 3, 2 -D-> 4 -K-> 3; 3 ends; 5 has both D to 0 and R to 2
    to = np.array([[1, 0, 0, 0], [0, 3, 0, 0], [4, 0, 0, 0], [0, 0, 0, 0], [0, 0, 3, 0], [0, 0, 0, 2]])
    there = np.array([[1, 0, 0, 0], [0, 1, 0, 0], [1, 0, 0, 0], [0, 0, 0, 0], [0, 0, 1, 0], [1, 0, 0, 1]], dtype=bool)
    go, arc = ranked(to, there, 8)
    assert go.tolist() == [1, 3, 4, 3, 3, 0] and arc.tolist() == [0, 1, 0, -1, 2, 0]


def test_matrices_hold_the_cost():
    codes = ["BFJ", "EI", "GAMP", "E"]
    whole = solve(codes, np.array([LAST] * 4), np.ones(4, dtype=bool), np.zeros(4, dtype=np.int64))[0]
    assert [min(m[q] + LAST[q] for q in range(4)) for m in matrices(codes)] == whole.tolist()
