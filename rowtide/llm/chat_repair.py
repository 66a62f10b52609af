r"""Repair of conversation structure: the cheapest edits that give a legal order of roles.

Legal role initials are ``(s?(ua)+)?``. Reading rows from the left, four states
tell what has been written: nothing, the system row, a user row, an assistant
row. Per row an edit keeps, reroles or deletes it, and empty rows may be inserted
before it. The cheapest edits are found by Hirschberg's divide and conquer: cost
vectors over the four states come from both ends and meet in the middle, the
optimal crossing with the least audit is chosen, and both halves are solved alike,
so that memory stays linear in the rows.

The same division runs across tasks. A conversation is cut into pieces of bounded
size; each piece gives a matrix of costs from every entry state to every exit
state. Per conversation the matrices (one for ``PIECE`` rows) are solved for the
states between pieces, then the pieces are solved independently of each other.

Rows travel as digests and one-byte codes until the edits are known; texts are
moved once to build the output. Equal rows of one turn travel as one row with a
number of copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import land

SPACES = " \t\n\x0b\x0c\r"
# Distinct rows of a conversation that are solved together.
PIECE = 4096

INITIALS = "sua-"  # the last stands for any other role
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
# Inserts that lead from the state after the last row to a legal end, with their cost.
ENDINGS = {EMPTY: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
MANY = 1 << 60

Step = list[list[tuple[int, int, object]]]  # from each state: (state, cost, order among equal costs)


def _after(state: int) -> int:
    """The state a written user or assistant row leads to; which of them is written follows from ``state``."""
    return ASSISTANT if state == USER else USER


def row_step(initial: int, fault: int) -> Step:
    """The edits of one row from each state, with inserts before it; per target state the cheapest, least text."""
    table: Step = []
    for start in STATES:
        best: dict[int, tuple[int, str]] = {}
        state, before = start, ""
        for _ in range(3):
            paid, late = INSERT * len(before), int(fault == TRUNCATED)
            options = [(state, DELETE, "D")]
            if fault not in (BLANK, DUPLICATE):
                options.append((_after(state), REROLE + late, "R"))
                if initial == 0 and state == EMPTY:
                    options.append((SYSTEM, KEEP + late, "K"))
                if initial == (2 if state == USER else 1):
                    options.append((_after(state), KEEP + late, "K"))
            for target, cost, edit in options:
                best[target] = min(best.get(target, (MANY, "")), (paid + cost, before + edit))
            state, before = _after(state), before + "I"
        table.append([(target, cost, text) for target, (cost, text) in best.items()])
    return table


ROW_STEPS = {4 * i + f: row_step(i, f) for i, f in product(range(4), range(4))}


def forward(steps: list[Step], low: int, high: int, start: int) -> tuple[list[int], list[int]]:
    """Per state after ``steps[low:high]``: the least cost from ``start``, and the rank of its least audit.

    Audits that end in different states differ within the text of the shorter
    one, so their order never changes by what follows: a rank per state is enough.
    """
    cost, rank = [MANY] * 4, [0] * 4
    cost[start] = 0
    for step in steps[low:high]:
        best: list = [(MANY,)] * 4
        for state in STATES:
            if cost[state] < MANY:
                for target, paid, order in step[state]:
                    found = (cost[state] + paid, rank[state], order)
                    if found < best[target]:
                        best[target] = found
        cost = [b[0] for b in best]
        reached = sorted((s for s in STATES if cost[s] < MANY), key=lambda s: best[s][1:])
        rank = [reached.index(s) if s in reached else 0 for s in STATES]
    return cost, rank


def backward(steps: list[Step], low: int, high: int, cost: list[int]) -> list[int]:
    """Per state before ``steps[low:high]``: the least cost to the end, given the costs after it."""
    for step in reversed(steps[low:high]):
        cost = [min([paid + cost[target] for target, paid, _ in step[state]], default=MANY) for state in STATES]
    return cost


def crossings(steps: list[Step], start: int, end: int) -> list[int]:
    """The state after each step on the cheapest way from ``start`` to ``end`` with the least audit."""
    states = [end] * len(steps)
    work = [(0, len(steps), start, end)]
    while work:
        low, high, first, last = work.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        cost, rank = forward(steps, low, middle, first)
        rest = backward(steps, middle, high, [0 if s == last else MANY for s in STATES])
        meet = min(STATES, key=lambda s: (cost[s] + rest[s], rank[s]))
        states[middle - 1] = meet
        work += [(low, middle, first, meet), (middle, high, meet, last)]
    return states


def end_state(cost: list[int], rank: list[int]) -> int:
    return min(STATES, key=lambda s: (cost[s] + INSERT * len(ENDINGS[s]), rank[s]))


def edits_of(codes: list[int], counts: list[int], start: int, end: int | None) -> list[str]:
    """The edits of each row; ``end`` None: the conversation ends here, with the inserts it needs."""
    steps = [ROW_STEPS[c] for c in codes]
    last = end_state(*forward(steps, 0, len(steps), start)) if end is None else end
    out, state = [], start
    for step, target, n in zip(steps, crossings(steps, start, last), counts):
        out.append(next(text for t, _, text in step[state] if t == target) + "D" * (n - 1))
        state = target
    if end is None:
        out[-1] += ENDINGS[last]
    return out


def matrix_of(codes: list[int], counts: list[int]) -> list[int]:
    """Costs and ranks of a piece from each entry to each exit state, as 32 numbers."""
    steps, more = [ROW_STEPS[c] for c in codes], DELETE * (sum(counts) - len(counts))
    out: list[int] = []
    for start in STATES:
        cost, rank = forward(steps, 0, len(steps), start)
        out += [min(MANY, c + more) for c in cost] + rank
    return out


def _matrix_step(numbers: np.ndarray) -> Step:
    table = np.asarray(numbers, dtype=np.int64).reshape(4, 2, 4)
    return [[(t, int(table[s, 0, t]), int(table[s, 1, t])) for t in STATES if table[s, 0, t] < MANY] for s in STATES]


def damage(chats: DataFrame) -> DataFrame:
    """Rows ``id, turn, role, text, copies`` after the damage their key's checksum names (nulls: one space)."""
    blank = F.lit(" ")
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    key = F.concat(F.coalesce("id", blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = chats.select("id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("harm"))
    harm = F.col("harm")
    return rows.where(harm != 0).select(
        "id", "turn", F.when(harm == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(harm == 1, "").when(harm == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(harm == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _digest(*parts: Column) -> Column:
    """128 bits of a hash over texts, each with its length in front; null differs from every text."""
    told = [F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("~")) for p in parts]
    return F.substring(F.unhex(F.sha2(F.concat(*told), 256)), 1, 16)


def _coded(rows: DataFrame) -> DataFrame:
    """Distinct rows: id, turn, key (of the whole row), same (of id, role, text), copies, code."""
    role, text = F.col("role"), F.rtrim("text", F.lit(SPACES))
    initial = F.substring(role, 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3) * 4
    end = F.right(text, F.lit(1))
    fault = F.when(text == "", BLANK).when(end.isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    ident, place = F.col("id"), F.col("turn").cast("string")
    told = rows.select(
        "id", "turn", "role", "copies", (code + fault).alias("code"),
        _digest(ident, place, role, F.col("text")).alias("key"), _digest(ident, role, F.col("text")).alias("same"),
    )
    # one row for equal rows, before the shuffle
    return told.groupBy("id", "turn", "role", "key", "same").agg(F.sum("copies").alias("copies"), F.max("code").alias("code"))


def _with_duplicates(rows: DataFrame) -> DataFrame:
    """Rows whose role and text an earlier turn had get the fault ``DUPLICATE``, unless they are blank."""
    earlier = rows.groupBy("same").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("turns"))
    earlier = earlier.where("turns > 1").select("same", "first")
    seen = F.col("first").isNotNull() & ~F.struct("turn").eqNullSafe(F.col("first")) & (F.col("code") % 4 != BLANK)
    code = F.when(seen, F.col("code") - F.col("code") % 4 + DUPLICATE).otherwise(F.col("code"))
    return rows.join(earlier, "same", "left").select("id", "turn", "role", "key", "copies", code.alias("code"))


PIECES = "at long, whole boolean, keys array<binary>, codes array<int>, counts array<long>, matrix array<long>"


def _pieces(rows: DataFrame, piece: int) -> DataFrame:
    """Runs of at most ``piece`` sorted rows of one conversation; ``whole`` if all of it for certain."""
    order = ["id", "turn", "role", "key"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "key", "code", "copies")
    names = ["id", *(c.split()[0] for c in PIECES.split(", "))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = TaskContext.get().partitionId() << 33
        held: list[tuple] = []
        current, cut = None, True  # the first and the last conversation of a task may go on in another one

        def made(whole: bool):
            keys, codes, counts = [h[0] for h in held], [h[1] for h in held], [h[2] for h in held]
            return current, at - len(held), whole, keys, codes, counts, None if whole else matrix_of(codes, counts)

        for batch in batches:
            out = []
            for ident, key, code, copies in batch.itertuples(index=False):
                if held and ident != current:
                    out.append(made(not cut))
                    held, cut = [], False
                elif len(held) == piece:
                    out.append(made(False))
                    held, cut = [], True
                current = ident
                held.append((key, int(code), int(copies)))
                at += 1
            if out:
                yield pd.DataFrame(out, columns=names, dtype=object)
        if held:
            yield pd.DataFrame([made(False)], columns=names, dtype=object)

    return land(placed.mapInPandas(run, f"id string, {PIECES}"), "pieces")


def _entries(pieces: DataFrame) -> DataFrame:
    """(at, start, end) of the pieces of conversations that have several; ``end`` null at the last one."""
    rows = pieces.where("not whole").select("id", "at", "matrix").repartition("id").sortWithinPartitions("id", "at")

    def solved(ats: list[int], steps: list[Step]) -> list[tuple]:
        last = end_state(*forward(steps, 0, len(steps), EMPTY))
        exits = crossings(steps, EMPTY, last)
        return [(a, s, e) for a, s, e in zip(ats, [EMPTY, *exits], [*exits[:-1], None])]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, ats, steps = None, [], []
        for batch in batches:
            out = []
            for ident, at, matrix in batch.itertuples(index=False):
                if ats and ident != current:
                    out += solved(ats, steps)
                    ats, steps = [], []
                current = ident
                ats.append(int(at))
                steps.append(_matrix_step(matrix))
            if out:
                yield pd.DataFrame(out, columns=["at", "start", "end"], dtype=object)
        if ats:
            yield pd.DataFrame(solved(ats, steps), columns=["at", "start", "end"], dtype=object)

    return rows.mapInPandas(run, "at long, start int, end int")


def _edits(pieces: DataFrame) -> DataFrame:
    """One row per distinct row: key, at (its place), copies, code, edits."""
    columns = ["at", "keys", "codes", "counts"]
    lone = pieces.where("whole").selectExpr(*columns, f"{EMPTY} AS start", "CAST(NULL AS int) AS end")
    several = pieces.where("not whole").select(*columns).join(_entries(pieces), "at")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for at, keys, codes, counts, start, end in batch.astype(object).itertuples(index=False):
                codes, counts = [int(c) for c in codes], [int(c) for c in counts]
                edits = edits_of(codes, counts, int(start), None if pd.isna(end) else int(end))
                out += zip(range(at, at + len(codes)), keys, counts, codes, edits)
            if out:
                yield pd.DataFrame(out, columns=["at", "key", "copies", "code", "edits"])

    return lone.unionByName(several).mapInPandas(run, "at long, key binary, copies long, code int, edits string")


def edit_rows(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """The rows ``id, turn, role, text, copies`` with place, code and edits: ``id, at, turn, role, text, copies, code, edits``.

    Edits are read from the left: I inserts an empty row, K keeps, R reroles, D deletes one row.
    """
    pieces = _pieces(_with_duplicates(_coded(rows)), piece)
    place = F.col("turn").cast("string")
    texts = rows.select("id", "turn", "role", "text", _digest(F.col("id"), place, F.col("role"), F.col("text")).alias("key"))
    texts = texts.groupBy("key").agg(*[F.first(c).alias(c) for c in ("id", "turn", "role", "text")])
    return texts.join(_edits(pieces), "key").select("id", "at", "turn", "role", "text", "copies", "code", "edits")


REPORT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


class _Report:
    """Gathers the row of one conversation while its rows pass in order."""

    def __init__(self):
        self.faults = [0, 0, 0, 0]
        self.illegal, self.cost, self.state, self.initial = 0, 0, EMPTY, None
        self.turns, self.low, self.high = 0, None, None
        self.audit, self.digest, self.written = [], hashlib.sha256(), False

    def _write(self, role: str, text: str) -> None:
        self.digest.update((f"\n{role}:{text}" if self.written else f"{role}:{text}").encode())
        self.written = True

    def add(self, turn, role: str, text: str, copies: int, code: int, edits: str) -> None:
        initial, fault = INITIALS[code // 4], code % 4
        self.faults[fault] += copies if fault in (BLANK, DUPLICATE) else 1
        self.faults[DUPLICATE] += copies - 1 if fault in (FINE, TRUNCATED) else 0
        self.illegal += (self.initial is not None and self.initial + initial not in ("su", "ua", "au")) + copies - 1
        self.initial = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        self.audit.append(edits)
        for edit in edits:
            if edit == "D":
                self.cost += DELETE
                continue
            expected = "assistant" if self.state == USER else "user"
            system = edit == "K" and initial == "s"
            self.state = SYSTEM if system else _after(self.state)
            if edit == "I":
                self.cost += INSERT
                self._write(expected, "")
            else:
                self.cost += (KEEP if edit == "K" else REROLE) + (fault == TRUNCATED)
                self._write(role if edit == "K" else expected, text)

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        _, blank, duplicate, truncated = self.faults
        return gaps, blank, duplicate, truncated, self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest()


def repair_report(edited: DataFrame) -> DataFrame:
    """One row per conversation of ``edit_rows``: id and ``REPORT``; rows stream by, none are gathered."""
    rows = edited.repartition("id").sortWithinPartitions("id", "at").select(
        "id", F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)), "role", "text", "copies", "code", "edits"
    )
    names = ["id", *(c.split()[0] for c in REPORT.split(", "))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, report = None, None
        for batch in batches:
            out = []
            for ident, placed, turn, role, text, copies, code, edits in batch.itertuples(index=False):
                if report is None or ident != current:
                    if report is not None:
                        out.append((current, *report.row()))
                    current, report = ident, _Report()
                report.add(int(turn) if placed else None, role, text, int(copies), int(code), edits)
            if out:
                yield pd.DataFrame(out, columns=names, dtype=object)
        if report is not None:
            yield pd.DataFrame([(current, *report.row())], columns=names, dtype=object)

    return rows.mapInPandas(run, f"id string, {REPORT}")


def repair_conversations(
    chats: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    harm: bool = True,
    piece: int = PIECE,
) -> DataFrame:
    """One row per conversation of ``chats``: ``id_col`` and ``REPORT``.

    With ``harm`` the rows are damaged first (``damage``). Rows count in the order
    of their turn, null first; rows of one turn by role and then in any fixed
    order, equal ones next to each other. A null role or text counts as one space;
    a role that starts with none of s, u, a (the empty one too) is never legal.
    Rows with a null conversation are one conversation. A conversation without
    rows after the damage gets zeros, an empty audit and the hash of the empty
    text. An empty table gives no rows. Other columns are not read.
    """
    rows = chats.select(
        F.col(id_col).cast("string").alias("id"), F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"),
    )
    blank = F.lit(" ")
    sound = rows.select(
        "id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
        F.lit(1).cast("long").alias("copies"),
    )
    report = repair_report(edit_rows(damage(rows) if harm else sound, piece))
    everyone = chats.select(F.col(id_col).alias("conv")).distinct()
    found = everyone.join(report, F.col("conv").cast("string").eqNullSafe(F.col("id")), "left")
    nothing = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    columns = [c.split()[0] for c in REPORT.split(", ")]
    return found.select(
        F.col("conv").alias(id_col), *[F.coalesce(F.col(c), nothing.get(c, F.lit(0))).alias(c) for c in columns]
    )
