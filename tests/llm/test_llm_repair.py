from __future__ import annotations

import hashlib
import random
import zlib
from functools import lru_cache

import duckdb
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trendloom.llm import repair
from trendloom.llm.oracle import ORACLE

SCHEMA = "conv_id long, turn long, role string, text string, kind string, audit string"
WHITE = " \t\n\x0b\f\r"
CODES = st.text(st.sampled_from("suaxSUAXd"), max_size=7)


def least(codes):
    """Every repair of the rest, from each state of the grammar; two inserts in a row are enough."""
    ends = {"start", "pair"}
    moves = {("start", "s"): "led", ("start", "u"): "open", ("led", "u"): "open", ("open", "a"): "pair", ("pair", "u"): "open"}

    @lru_cache(None)
    def rest(i, state, inserts):
        found = []
        if i == len(codes):
            if state in ends:
                found.append((0, ""))
        else:
            code = codes[i]
            found.append(add(4, "D", rest(i + 1, state, 0)))
            if code != "d":
                late = 3 * code.isupper()
                kept = moves.get((state, code.lower()))
                if kept:
                    found.append(add(late, "K", rest(i + 1, kept, 0)))
                for role in "ua":
                    if (state, role) in moves:
                        found.append(add(late + 3, "R", rest(i + 1, moves[state, role], 0)))
        for role in "ua" if inserts < 2 else "":
            if (state, role) in moves:
                found.append(add(3, "I", rest(i, moves[state, role], inserts + 1)))
        return min((f for f in found if f), default=None)

    def add(cost, letter, after):
        return after and (after[0] + cost, letter + after[1])
    return rest(0, "start", 0)


@settings(max_examples=400, deadline=None)
@given(CODES)
def test_least_audit_of_all(codes):
    assert repair.aligned(codes) == repair.folded(codes) == least(codes)


@pytest.mark.parametrize("seed", range(6))
def test_long_conversations_both_ways(seed):
    draw = random.Random(seed)
    codes = "".join(draw.choice("sxSUAXd" + "ua" * (8 * seed)) for _ in range(150))
    assert repair.aligned(codes) == repair.folded(codes) == least(codes)


def test_very_long_conversation_folds(monkeypatch):
    codes = "".join(random.Random(3).choice("uauauasxUAd") for _ in range(120_000))
    monkeypatch.setattr(repair, "aligned", None)
    cost, audit = repair.plan(codes)
    assert len(audit.replace("I", "")) == len(codes) and cost > 0


def expected(rows, damage):
    """The contract, conversation by conversation."""
    by_conv = {}
    for conv, turn, role, text in rows:
        mine = by_conv.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        what = zlib.crc32(key.encode()) % 20 if damage else 9
        if what == 4:
            role = "user"
        if what == 1:
            text = ""
        if what == 2:
            text = "".join(c for c in text if c not in ".!?")
        mine += [(turn, role, text)] * {0: 0, 3: 2}.get(what, 1)
    out = []
    for conv, mine in by_conv.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        seen, codes, faults = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in mine:
            bare = text.strip(WHITE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else \
                "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            kind = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes += "d" if fault in ("blank", "duplicate") else kind.upper() if fault else kind
        initials = [r[1][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns = {r[0] for r in mine if r[0] is not None}
        cost, audit = least(codes)
        lines, left, due = [], list(mine), "u"
        for letter in audit:
            _, role, text = left.pop(0) if letter != "I" else (None, None, "")
            if letter == "D":
                continue
            if letter == "K" and role[:1] == "s":
                lines.append(f"{role}:{text}")
                continue
            lines.append(f"{role if letter == 'K' else 'user' if due == 'u' else 'assistant'}:{text}")
            due = "a" if due == "u" else "u"
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
                    lines))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "own", "own") for r in rows], SCHEMA)


def audited(spark, rows, damage=True):
    turns = frame(spark, rows)
    if damage:
        out = repair.conversation_audits(repair.damaged(turns), dropped=F.col("dropped"))
    else:
        out = repair.conversation_audits(turns)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted(map(tuple, out.collect()), key=repr)


def many(n, seed):
    draw = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \t ", "a\nb.", "ünïcode.", "Twice. ", "x" * 50, "\x0b"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "uncle", "User"]
    rows = []
    for conv in range(n):
        for turn in range(draw.randrange(1, 9)):
            rows.append((conv, turn if draw.random() < 0.9 else draw.choice([None, 3, turn - 1]),
                         draw.choice(roles[2:] if draw.random() < 0.2 else roles[:2]), draw.choice(texts) + draw.choice(["", str(turn) + "."])))
    return rows


ODD = [(None, None, None, None), (None, 1, "user", "Hi."), (None, 1, "user", "Hi."), (7, None, "assistant", "A."),
       (7, None, "user", "U."), (8, 5, "system", "S."), (9, 1, None, "Hm."), (9, 2, "user", None), (9, 9, "assistant", "End."),
       (10, 3, "user", "Long. " * 20_000), (10, 4, "assistant", "x" * 100_000), (-4, -2, "user", "Neg."), (-4, 5, "assistant", "Pos.")]


def test_as_brute_force(spark):
    rows = many(120, 1) + ODD
    for damage in (True, False):
        wanted = [r[:-1] for r in expected(rows, damage)]
        assert audited(spark, rows, damage) == wanted
    assert sum(r[6] > 0 for r in wanted) > 50


def test_dropped_conversation_stays(spark):
    gone = next(i for i in range(10_000) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    out = audited(spark, [(gone, 1, "user", "Hi.")])
    assert out == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_no_rows(spark):
    assert audited(spark, []) == []
    assert repair.repaired_turns(frame(spark, [])).collect() == []


def test_copies_of_one_row_are_counted_not_gathered(spark):
    rows = [(1, 1, "user", "Hi.")] * 300 + [(1, 2, "assistant", "Yes.")] * 2
    assert audited(spark, rows, False) == [r[:-1] for r in expected(rows, False)]


def test_repaired_turns_are_the_hashed_lines(spark):
    rows = many(30, 5) + ODD
    got = {}
    for r in repair.repaired_turns(frame(spark, rows).repartition(5)).orderBy("place").collect():
        mine = got.setdefault(r["conv_id"], [])
        assert r["place"] == len(mine) and (r["turn"] is None or r["edit"] in "KR")
        mine.append(f"{r['role']}:{r['text']}")
    assert got == {r[0]: r[-1] for r in expected(rows, False) if r[-1]}


def test_sql(spark):
    rows = many(150, 9) + ODD
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame({n: pd.array([r[i] for r in rows], dtype=t) for i, (n, t) in enumerate(
        [("conv_id", "Int64"), ("turn", "Int64"), ("role", "string"), ("text", "string")])}))
    out = con.execute(ORACLE["op12_conversation_repair"]).fetchall()
    assert sorted(out, key=repr) == [r[:-1] for r in expected(rows, True)]
