"""Conversation structure repair by alignment with an alternating grammar.

A conversation should be empty or an optional system turn and then pairs of user and assistant turns. Its rows,
in the order of their turns, are aligned with the grammar's strings by Wagner and Fischer's edit distance: keep
a row (0), change its role (3), delete it (4), insert a turn (3); rows cut off in mid-sentence cost 3 more unless
deleted, blank and duplicate rows must be deleted. All strings of the grammar end alike, so one matrix over
(row, symbols still to come), filled from the end, serves every length; a leading system turn, which only a kept
row can give, is tried at every row that could be it. A quick repair gives the first cost, and Ukkonen's band
around the diagonal leaves out all cells that cannot be part of anything as cheap. The audits of all
lengths that reach the least cost are traced and the ASCII-least one counts.

A conversation whose matrix would exceed ``CELLS`` is repaired by the same recurrences with the lengths folded by
parity, on which alone costs depend: the same cost and audit in three bytes a row.

On Spark, faults are column expressions, and copies are counted before narrow rows (no text) meet by
conversation, where a stream of sorted rows becomes one audit. The audit then goes ahead of the conversation's
full rows in a second sorted stream, so a conversation of any length is repaired and hashed
row by row, with one byte a row in memory. A conversation's rows are in the order of turn (null first), role, MD5 of
the text. What repeats a row's role and text later is a duplicate; rows that tie in everything are alike, so their
order does not matter. Null roles and texts are one space; rows with a null conversation id are one
conversation. No rows at all give no conversation, and a conversation whose rows are all dropped an empty audit.
Other columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from trendloom.session import materialize

# Costs of the edits, and the first letters of the roles.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LEGAL = ("su", "ua", "au")
CELLS = 4_000_000
_INF = 1 << 40
_WHITE = " \t\n\x0b\f\r"
_SHORT = 64                  # rows up to which a worker remembers a plan


def quick_cost(codes: str) -> int:
    """The cheaper of three plain repairs: delete all rows; change roles; or insert what is missing."""
    undeleted = [c for c in codes if c != "d"]
    forced = DELETE * (len(codes) - len(undeleted))
    changed = inserted = forced
    for insert in (False, True):
        cost, due, begun, led = forced, "u", False, False
        for c in undeleted:
            kind = c.lower()
            if kind == "s" and not begun and not led:
                led = True
            elif insert and kind not in "ua":
                cost += DELETE
                continue
            elif insert:
                cost += INSERT * (kind != due)
                due, begun = "a" if kind == "u" else "u", True
            else:
                cost += REROLE * (kind != due)
                due, begun = "a" if due == "u" else "u", True
            cost += TRUNCATED * c.isupper()
        cost += INSERT * (due == "a") + 2 * INSERT * (led and not begun)
        if insert:
            inserted = cost
        else:
            changed = cost
    return min(DELETE * len(codes), changed, inserted)


def band(codes: str) -> tuple[int, int]:
    """How many symbols fewer and more than undeleted rows a cell may have to come, to be on a path as cheap as
    the quick repair: a row more to delete costs 1 if cut off, else 4, a turn more to insert 3."""
    cut = sum(c.isupper() for c in codes)
    spare = quick_cost(codes) - DELETE * codes.count("d") - TRUNCATED * cut
    return min(cut, spare) + max(0, spare - cut) // DELETE, spare // INSERT


def aligned(codes: str) -> tuple[int, str]:
    """Least cost and least audit. A row's code is its role's first letter (``x``: none of the grammar's), in upper
    case if the text is cut off, or ``d`` if the row must go."""
    n = len(codes)
    down, up = band(codes)
    at = np.arange(down + up + 1)
    low = -down                                          # symbols to come at the band's first cell
    cost = np.where(low + at >= 0, INSERT * (low + at), _INF)
    rows, lows = [cost], [low]
    for c in reversed(codes):
        if c == "d":
            cost = cost + DELETE
        else:
            low += 1
            due = np.where((low + at) % 2 == 0, "u", "a")
            step = np.where(due == c.lower(), 0, REROLE) + TRUNCATED * c.isupper()
            gone = np.append(cost[1:], _INF) + DELETE
            cost = np.minimum(np.minimum(cost + step, gone), _INF)
            cost = np.minimum(np.minimum.accumulate(cost - INSERT * at) + INSERT * at, _INF)
        rows.append(cost)
        lows.append(low)
    rows, lows = rows[::-1], lows[::-1]

    def cell(i: int, left: int) -> int:
        k = left - lows[i]
        return int(rows[i][k]) if 0 <= k < len(at) else _INF

    def trace(i: int, left: int) -> str:
        letters = []
        while i < n or left:
            now = cell(i, left)
            if i < n and cell(i + 1, left) + DELETE == now:
                letters.append("D")
                i += 1
            elif left and cell(i, left - 1) + INSERT == now:
                letters.append("I")
                left -= 1
            else:
                letters.append("K" if codes[i].lower() == "au"[left % 2 == 0] else "R")
                i, left = i + 1, left - 1
        return "".join(letters)
    ends = [(int(rows[0][k]), 0, int(lows[0] + k)) for k in at if lows[0] + k >= 0 and (lows[0] + k) % 2 == 0]
    for i, c in enumerate(codes):
        if c in "sS":
            ends += [(DELETE * i + TRUNCATED * c.isupper() + int(rows[i + 1][k]), i + 1, int(lows[i + 1] + k))
                     for k in at if lows[i + 1] + k > 0 and (lows[i + 1] + k) % 2 == 0]
    least = min(e[0] for e in ends)
    return least, min("D" * (i - 1) + "K" * (i > 0) + trace(i, left) for found, i, left in ends if found == least)


def folded(codes: str) -> tuple[int, str]:
    """The same for any number of rows: even, odd, and even but not none symbols to come."""
    n = len(codes)
    even, odd, more = 0, INSERT, 2 * INSERT
    letters = [bytearray(n + 1) for _ in range(3)]
    letters[1][n] = letters[2][n] = ord("I")
    lead = (_INF, 0)
    for i in range(n - 1, -1, -1):
        c = codes[i]
        kind, late = c.lower(), TRUNCATED * c.isupper()
        if kind == "s" and DELETE * i + late + more < lead[0]:
            lead = (DELETE * i + late + more, i)
        as_user = as_assistant = _INF
        if c != "d":
            as_user = odd + late + REROLE * (kind != "u")
            as_assistant = even + late + REROLE * (kind != "a")
        gone = (even + DELETE, odd + DELETE, more + DELETE)
        even, odd = min(gone[0], as_user), min(gone[1], as_assistant)
        even, odd = min(even, odd + INSERT), min(odd, even + INSERT)
        more = min(gone[2], as_user, odd + INSERT)
        for state, (now, before, after) in enumerate(((even, gone[0], odd), (odd, gone[1], even), (more, gone[2], odd))):
            letters[state][i] = ord("D" if before == now else "I" if after + INSERT == now
                                    else "K" if kind == "ua"[state == 1] else "R")

    def trace(i: int, state: int) -> str:
        out = bytearray()
        while letter := letters[state][i]:
            out.append(letter)
            if letter != ord("D"):
                state = 0 if state == 1 else 1
            i += letter != ord("I")
        return out.decode()
    least = min(even, lead[0])
    audits = [trace(0, 0)] if even == least else []
    if lead[0] == least:
        audits.append("D" * lead[1] + "K" + trace(lead[1] + 1, 2))
    return least, min(audits)


def plan(codes: str) -> tuple[int, str]:
    """Cost and audit of the best repair."""
    return _short_plan(codes) if len(codes) <= _SHORT else _plan(codes)


def _plan(codes: str) -> tuple[int, str]:
    return aligned(codes) if (len(codes) + 1) * (sum(band(codes)) + 1) <= CELLS else folded(codes)


_short_plan = lru_cache(maxsize=50_000)(_plan)


def marked(turns: DataFrame, conv: str, turn: str, role: str, text: str, dropped: Column | None) -> DataFrame:
    """``conv, turn, role, text, dropped`` and per row the digest of the text, the role's ``kind`` and the first fault
    of the row alone."""
    spoken, said = F.coalesce(F.col(role), F.lit(" ")), F.coalesce(F.col(text), F.lit(" "))
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), spoken.alias("role"),
                        said.alias("text"), F.lit(False).alias("dropped") if dropped is None else dropped.alias("dropped"))
    initial, bare = F.substring("role", 1, 1), F.rtrim("text", F.lit(_WHITE))
    return rows.select("*", F.md5("text").alias("digest"), F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("kind"),
                       F.when(bare == "", "blank")
                       .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated").alias("fault"))


_ORDER = ("turn", "role", "digest")        # ascending, null first
_AUDIT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class _Conversation:
    """What the audit of one conversation needs, row by row."""

    def __init__(self) -> None:
        self.codes, self.faults = bytearray(), {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.before = 0, None
        self.first = self.last = None
        self.turns = 0

    def add(self, turn: int | None, kind: str, fault: str | None, n: int, again: bool) -> None:
        """``n`` equal rows, all duplicates if ``again``, else all but the first."""
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        copies = n if again else n - 1
        if fault == "blank":
            self.faults["blank"] += n
            self.codes += b"d" * n
        else:
            if not again:
                if fault:
                    self.faults["truncated"] += 1
                self.codes += (kind.upper() if fault else kind).encode()
            self.faults["duplicate"] += copies
            self.codes += b"d" * copies
        if self.before is not None:
            self.illegal += self.before + kind not in LEGAL
        self.illegal += n - 1
        self.before = kind

    def result(self) -> tuple:
        cost, audit = plan(self.codes.decode())
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (gaps, *self.faults.values(), self.illegal, cost, audit)


def _streamed(kind: pa.DataType) -> Callable:
    names = [f.split()[0] for f in _AUDIT.split(", ")]
    types = [pa.int64()] * 6 + [pa.string()]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, done = None, None, []

        def given() -> pa.RecordBatch:
            columns = list(zip(*done)) if done else [()] * 8
            arrays = [pa.array(columns[0], kind)] + [pa.array(c, t) for c, t in zip(columns[1:], types)]
            done.clear()
            return pa.RecordBatch.from_arrays(arrays, ["conv", *names])
        for batch in batches:
            for conv, dropped, turn, role, fault, n, again in zip(*(c.to_pylist() for c in batch.columns)):
                if held is None or conv != now:
                    if held is not None:
                        done.append((now, *held.result()))
                    now, held = conv, _Conversation()
                if not dropped:
                    held.add(turn, role, fault, n, again)
            if len(done) >= 2000:
                yield given()
        if held is not None:
            done.append((now, *held.result()))
        yield given()
    return stream


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    return to_arrow_type(df.schema[column].dataType)


def audits(rows: DataFrame) -> DataFrame:
    """``conv`` and the audit columns of every conversation of ``marked`` rows."""
    narrow = rows.groupBy("conv", "dropped", "turn", "role", "digest", "kind", "fault").agg(F.count(F.lit(1)).alias("n"))
    seen = Window.partitionBy("conv", "dropped", "role", "digest").orderBy(F.asc_nulls_first("turn"))
    counted = narrow.withColumn("again", F.row_number().over(seen) > 1)
    ordered = counted.repartition("conv").sortWithinPartitions("conv", *_ORDER) \
        .select("conv", "dropped", "turn", "kind", "fault", "n", "again")
    conv = rows.schema["conv"]
    schema = f"conv {conv.dataType.simpleString()}, {_AUDIT}"
    return ordered.mapInArrow(_streamed(_arrow_type(rows, "conv")), schema)


def _with_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Every conversation's audit, then its rows in order, in one partition."""
    head = found.select("conv", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                        F.lit("").alias("digest"), F.lit("").alias("kind"), F.col("audit").alias("text"))
    body = rows.where("not dropped").select("conv", F.lit(1).alias("part"), "turn", "role", "digest", "kind", "text")
    return head.unionByName(body).repartition("conv").sortWithinPartitions("conv", "part", *_ORDER) \
        .select("conv", "part", "turn", "role", "kind", "text")


def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(conv, edit, turn, role, text)`` of every edit, and ``(conv, None, ...)`` where a conversation begins."""
    conv, audit, at, due = None, "", 0, "u"

    def inserted() -> Iterator[tuple]:
        nonlocal at, due
        while at < len(audit) and audit[at] == "I":
            yield conv, "I", None, "user" if due == "u" else "assistant", ""
            at, due = at + 1, "a" if due == "u" else "u"
    for batch in batches:
        for key, part, turn, role, kind, text in zip(*(c.to_pylist() for c in batch.columns)):
            if part == 0:
                yield from inserted()
                conv, audit, at, due = key, text, 0, "u"
                yield conv, None, None, None, None
                continue
            yield from inserted()
            edit = audit[at]
            at += 1
            if edit == "R":
                role = "user" if due == "u" else "assistant"
            yield conv, edit, turn, role, text
            if edit != "D" and not (edit == "K" and kind == "s"):
                due = "a" if due == "u" else "u"
    yield from inserted()


def repaired_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                   dropped: Column | None = None) -> DataFrame:
    """The repaired conversations: ``conv`` column, ``place`` (from 0), ``edit``, the row's ``turn`` (null if inserted),
    ``role, text``; deleted rows are not listed."""
    rows = marked(turns, conv, turn, role, text, dropped)
    kind = _arrow_type(rows, "conv")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, out, size = 0, [], 0
        types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]

        def given() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [()] * 6
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                              ["conv", "place", "edit", "turn", "role", "text"])
        for key, edit, number, spoken, said in repaired(batches):
            if edit is None:
                place = 0
            elif edit != "D":
                out.append((key, place, edit, number, spoken, said))
                place, size = place + 1, size + len(said)
                if len(out) >= 2000 or size > 1 << 20:
                    yield given()
                    size = 0
        yield given()
    schema = f"conv {rows.schema['conv'].dataType.simpleString()}, place long, edit string, turn long, role string, text string"
    return _with_audits(rows, audits(rows)).mapInArrow(listed, schema).withColumnRenamed("conv", conv)


def conversation_audits(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                        text: str = "text", dropped: Column | None = None) -> DataFrame:
    """One row per conversation: gaps in its turns, faults, illegal neighbours, cost and audit of the repair, and the
    SHA-256 of the repaired ``role:text`` lines. Rows where ``dropped`` holds only name their conversation."""
    rows = marked(turns, conv, turn, role, text, dropped)
    kind = _arrow_type(rows, "conv")
    found = materialize(audits(rows), "audits")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, digests, running, begun = [], [], None, False
        for key, edit, _, spoken, said in repaired(batches):
            if edit is None:
                if running is not None:
                    digests.append(running.hexdigest())
                if len(digests) >= 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(digests)], ["conv", "repaired_sha256"])
                    keys, digests = [], []
                keys.append(key)
                running, begun = hashlib.sha256(), False
            elif edit != "D":
                running.update(f"{chr(10) if begun else ''}{spoken}:{said}".encode())
                begun = True
        if running is not None:
            digests.append(running.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(digests, pa.string())], ["conv", "repaired_sha256"])
    schema = f"conv {rows.schema['conv'].dataType.simpleString()}, repaired_sha256 string"
    digests = _with_audits(rows, found).mapInArrow(hashed, schema)
    both = found.join(digests, found["conv"].eqNullSafe(digests["conv"])).drop(digests["conv"])
    return both.withColumnRenamed("conv", conv)


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows with seeded faults, and ``dropped``: by the CRC-32 of ``conv:turn`` modulo 20, a row is dropped (0), loses
    its text (1) or its sentence ends (2), is repeated (3) or gets the role user (4)."""
    name = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in (conv, None, turn)])
    what = F.col("__what")
    spoken, said = F.coalesce(F.col(role), F.lit(" ")), F.coalesce(F.col(text), F.lit(" "))
    rows = turns.select(F.col(conv), F.col(turn), spoken.alias(role), said.alias(text),
                        (F.crc32(F.encode(name, "UTF-8")) % 20).alias("__what"))
    twice = rows.withColumn("__copy", F.explode(F.when(what == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return twice.select(
        F.col(conv), F.col(turn), F.when(what == 4, "user").otherwise(F.col(role)).alias(role),
        F.when(what == 1, "").when(what == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(F.col(text)).alias(text),
        (what == 0).alias("dropped"))
