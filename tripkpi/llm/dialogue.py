"""Repair of conversations by the cheapest edits, and of these the ones whose audit sorts first.

A conversation's rows are read by an automaton: nothing yet, after a system row, after a user row,
after an assistant row. Its nodes are (row, state); edits are arcs between them, with a letter each.
A cost table, filled from the last row backwards, tells which arcs lie on a cheapest way to the end.

Among the cheapest ways the least audit is found by ranking those arcs as strings are ranked in prefix
doubling: by their own letter first, then by twice as many letters with each round, from the rank of
an arc and that of the arc as many letters further on. An arc points to the least of the arcs that
leave its end; pointers are doubled along with the ranks. The arc of least rank that leaves the start
is the first of the least way, and the pointers, from the longest to the shortest, give the rest.

Costs of the four states differ by little, so there are few different rows of the table but for a
constant; each is worked out once. A long conversation is ranked in blocks of rows. Audits are then
compared up to the block's end only, which decides alike: the arcs that leave a node have different
letters.
"""

from __future__ import annotations

import hashlib
from array import array
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tripkpi.llm.common import schema_of, slices, written

# Rows that are ranked together.
BLOCK = 1 << 15

SPACES = " \t\n\v\f\r"
# Faults of a row, the first that it has.
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
# Initials of roles.
S, U, A, OTHER = range(4)
INITIALS = {"s": S, "u": U, "a": A}
LEGAL = {(S, U), (U, A), (A, U)}

# States: the row that was last let through.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
ACCEPTED = (START, AFTER_A)
# The state after one more user or assistant row, whichever is due.
DUE = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
ROLE_DUE = ("user", "user", "assistant", "user")
KEEPS = {S: {START: AFTER_S}, U: {START: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}, A: {AFTER_U: AFTER_A}, OTHER: {}}

LETTERS = b"DIKR"
DELETE, INSERT, KEEP, REROLE = range(4)
COSTS = (2, 5, 0, 1)
CUT = 5  # a truncated row that is not deleted
NEVER = 1 << 40


class Table:
    """The different rows of cost tables, with their arcs.

    ``arcs[k][state, letter]`` is where an arc on a cheapest way leads: 4 + state for a state of the
    next row, the state alone for one of the same row, -1 if there is no such arc.
    """

    def __init__(self):
        self.costs: list[tuple[int, ...]] = []
        self.shifts: list[int] = []
        self.arcs: list[np.ndarray] = []
        self.known: dict[tuple[int, int], int] = {}
        self.rows: dict[tuple, int] = {}
        self.end = self._add([0 if q in ACCEPTED else NEVER for q in range(4)], [{} for _ in range(4)])

    def _add(self, best: list[int], ways: list[dict[int, tuple[int, int]]]) -> int:
        """A row from the least costs by edits that use up a row, and these edits."""
        costs = list(best)
        for q in (AFTER_U, AFTER_A, START, AFTER_S, AFTER_U):  # each after what it may insert to
            costs[q] = min(costs[q], COSTS[INSERT] + costs[DUE[q]])
        arcs = np.full((4, 4), -1, np.int8)
        for q in range(4):
            for letter, (cost, to) in ways[q].items():
                if cost == costs[q]:
                    arcs[q, letter] = 4 + to
            if costs[q] == COSTS[INSERT] + costs[DUE[q]]:
                arcs[q, INSERT] = DUE[q]
        least = min(costs)
        row = (tuple(c - least for c in costs), least, arcs.tobytes())
        if row not in self.rows:
            self.rows[row] = len(self.costs)
            self.costs.append(row[0])
            self.shifts.append(least)
            self.arcs.append(arcs)
        return self.rows[row]

    def before(self, after: int, kind: int) -> int:
        """The table's row for a conversation's row of a kind (initial and fault) and the row after."""
        found = self.known.get((after, kind))
        if found is None:
            initial, fault = divmod(kind, 4)
            costs, best, ways = self.costs[after], [], []
            for q in range(4):
                way = {DELETE: (COSTS[DELETE] + costs[q], q)}
                if fault not in (BLANK, DUPLICATE):
                    cut = CUT if fault == TRUNCATED else 0
                    if q in KEEPS[initial]:
                        to = KEEPS[initial][q]
                        way[KEEP] = (COSTS[KEEP] + cut + costs[to], to)
                    way[REROLE] = (COSTS[REROLE] + cut + costs[DUE[q]], DUE[q])
                ways.append(way)
                best.append(min(cost for cost, _ in way.values()))
            found = self.known[after, kind] = self._add(best, ways)
        return found

    def of(self, kinds: bytes) -> tuple[int, np.ndarray]:
        """Least cost of a conversation's repair, and the table's row for each of its rows and its end."""
        row, cost = self.end, self.shifts[self.end]
        steps = array("i", [row])
        known, shifts, before = self.known, self.shifts, self.before
        for kind in reversed(kinds):
            row = known.get((row, kind))
            if row is None:
                row = before(steps[-1], kind)
            steps.append(row)
            cost += shifts[row]
        return cost + self.costs[row][START], np.array(steps, np.int32)[::-1]


def _ranks(numbers: np.ndarray) -> np.ndarray:
    return np.unique(numbers, return_inverse=True)[1].astype(np.int64)


def least_way(arcs: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """Letters of the least audit from a state of the first row on, and the state that it ends in.

    ``arcs`` has those of each row, (rows, 4, 4) as in ``Table``. The way ends where no arc leaves.
    """
    n = len(arcs)
    row, q, letter = np.nonzero(arcs >= 0)
    to = arcs[row, q, letter].astype(np.int64)
    ends = row * 4 + to  # 4 and more are states of the next row
    starts = row * 4 + q
    rank = _ranks(np.concatenate([letter, [-1]]))  # and a last arc, which stands for the end
    last = len(letter)

    def least(nodes: np.ndarray) -> np.ndarray:
        """For each node the arc of least rank that leaves it, or the last arc."""
        order = np.lexsort((rank[:last], starts))
        first = np.searchsorted(starts[order], nodes)
        found = np.append(order, last)[first]
        return np.where(np.append(starts, -1)[found] == nodes, found, last)

    pointers = [np.append(least(ends), last)]
    while (pointers[-1] != last).any():  # twice the letters in each round
        after = pointers[-1]
        rank = _ranks(rank * (last + 2) + rank[after])
        pointers.append(after[after])
    way = least(np.array([state]))
    for after in reversed(pointers):  # every second of the arcs from here, the others in the next rounds
        way = np.stack([way, after[way]], axis=1).reshape(-1)
    way = way[way != last]
    return letter[way], int(ends[way[-1]] % 4) if len(way) else state


def least_audit(kinds: bytes, table: Table) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of rows of these kinds."""
    cost, steps = table.of(kinds)
    used = np.unique(steps)
    arcs = np.array([table.arcs[k] for k in used])[np.searchsorted(used, steps)]
    letters, state = [], START
    for at in range(0, len(arcs), BLOCK):
        found, state = least_way(arcs[at : at + BLOCK], state)
        letters.append(found)
    return cost, bytes(np.frombuffer(LETTERS, np.uint8)[np.concatenate(letters)]).decode()


class Repair:
    """Applies an audit to a conversation's rows, which come one by one."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _insert(self) -> list[tuple[str, str]]:
        added = []
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            added.append((ROLE_DUE[self.state], ""))
            self.state = DUE[self.state]
            self.at += 1
        return added

    def row(self, role: str, text: str) -> list[tuple[str, str]]:
        """What takes the row's place, after what is inserted before it."""
        out = self._insert()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            out.append((role, text))
            self.state = KEEPS[INITIALS[role[0]]][self.state]
        elif letter == "R":
            out.append((ROLE_DUE[self.state], text))
            self.state = DUE[self.state]
        return out

    def rest(self) -> list[tuple[str, str]]:
        return self._insert()


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text after the damage that each row's id calls for."""
    ids = [f"coalesce(CAST({c} AS STRING), ' ')" for c in ("conv_id", "turn")]
    rows = conversations.selectExpr(
        "conv_id", "turn", "coalesce(role, ' ') AS role", "coalesce(text, ' ') AS text",
        f"crc32(CAST({ids[0]} || ':' || {ids[1]} AS BINARY)) % 20 AS damage",
    )
    return rows.where("damage <> 0").selectExpr(
        "conv_id",
        "turn",
        "IF(damage = 4, 'user', role) AS role",
        "CASE damage WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text",
        "explode(IF(damage = 3, array(1, 2), array(1))) AS copy",
    ).drop("copy")


def _digested(rows: DataFrame) -> DataFrame:
    return rows.selectExpr("*", "md5(CAST(length(role) || ':' || role || text AS BINARY)) AS digest")


_FIGURES = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_COUNTS = ", ".join([*[f"{c} long" for c in _FIGURES], "audit string"])


def _wrapped(number: int) -> int:
    """As a 64-bit integer, which the span of two turns may go beyond."""
    return (number + 2**63) % 2**64 - 2**63


class _Conversation:
    """What is kept of a conversation while its rows come in order: a byte a row, and counts."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.kinds, self.before = conv_id, bytearray(), None
        self.least = self.turn = None
        self.turns = self.illegal = 0

    def add(self, turn, initial, fault, later, digest) -> None:
        if turn is not None and turn != self.turn:
            self.least = turn if self.least is None else self.least
            self.turn, self.turns = turn, self.turns + 1
        # Equal rows of one turn stand side by side.
        if fault != BLANK and (later or (turn, digest) == self.before):
            fault = DUPLICATE
        if self.kinds and (self.kinds[-1] // 4, initial) not in LEGAL:
            self.illegal += 1
        self.kinds.append(initial * 4 + fault)
        self.before = (turn, digest)

    def result(self, table: Table) -> tuple:
        gaps = 0 if self.turn is None else _wrapped(self.turn - self.least + 1 - self.turns)
        faults = np.bincount(np.frombuffer(bytes(self.kinds), np.uint8) % 4, minlength=4).tolist()
        cost, audit = least_audit(bytes(self.kinds), table)
        return (self.conv_id, gaps, *faults[1:], self.illegal, cost, audit)


def _emit(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow
    )


def _in_order(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def _emitted(results, arrow: pa.Schema, least_chars: int = 1 << 22):
    """Results in batches of bounded size."""
    rows, size = [], 0
    for result in results:
        rows.append(result)
        size += 200 + len(result[7])
        if size > least_chars:
            yield _emit(rows, arrow)
            rows, size = [], 0
    if rows:
        yield _emit(rows, arrow)


def audits(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of every conversation.

    Texts stay behind: what is dealt out by conversation are a few bytes and a digest of each row.
    """
    rows = _digested(damaged(conversations))
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    initials = " ".join(f"WHEN '{c}' THEN {i}" for c, i in INITIALS.items())
    marked = rows.select(
        "conv_id", "turn", "role", "digest",
        F.expr(f"CASE left(role, 1) {initials} ELSE {OTHER} END").alias("initial"),
        F.when(trimmed == "", BLANK)
        .when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), TRUNCATED)
        .otherwise(FINE)
        .alias("fault"),
    )
    again = (
        marked.groupBy("conv_id", "digest")
        .agg(F.count("*").alias("n"), F.min("turn").alias("first"), F.max(F.expr("turn IS NULL")).alias("none"))
        .where("n > 1")
        .select(F.col("conv_id").alias("again_id"), F.col("digest").alias("again_digest"), "first", "none")
    )
    again = written(again, "repeated-rows")
    flagged = marked.join(
        again,
        marked.conv_id.eqNullSafe(again.again_id) & (marked.digest == again.again_digest),
        "left",
    ).selectExpr(
        "conv_id", "true AS has_row", "turn", "role", "digest", "initial", "fault",
        "coalesce(turn IS NOT NULL AND (none OR turn > first), false) AS later",
    )
    # One row for each conversation, before its others: all its rows may have been dropped.
    ids = conversations.groupBy("conv_id").agg(F.lit(False).alias("has_row"))
    both = ids.unionByName(flagged, allowMissingColumns=True)
    arrow = to_arrow_schema(schema_of(_COUNTS))

    def run(batches):
        def each():
            names = ("conv_id", "has_row", "turn", "initial", "fault", "later", "digest")
            for batch in batches:
                for part in slices(batch):
                    yield from zip(*[part.column(c).to_pylist() for c in names], strict=True)

        def results():
            table = Table()
            for conv_id, own in groupby(each(), key=lambda row: row[0]):
                one = _Conversation(conv_id)
                for row in own:
                    if row[1]:
                        one.add(*row[2:])
                yield one.result(table)

        yield from _emitted(results(), arrow)

    ordered = _in_order(both, "has_row", "turn", "role", "digest")
    return ordered.mapInArrow(run, schema_of(_COUNTS))


def _with_audits(conversations: DataFrame) -> DataFrame:
    """Audits with the damaged rows of their conversations behind them, dealt out by conversation."""
    found = written(audits(conversations), "audits")
    rows = _digested(damaged(conversations)).selectExpr("*", "true AS has_row")
    both = found.selectExpr("*", "false AS has_row").unionByName(rows, allowMissingColumns=True)
    return _in_order(both, "has_row", "turn", "role", "digest")


def _repaired_rows(batches):
    """(audit's columns, None) once for each conversation, then (None, [(role, text), ..]) for its rows."""
    repair = None
    for batch in batches:
        for part in slices(batch, "text"):
            columns = {c: part.column(c).to_pylist() for c in ("has_row", "role", "text")}
            for i, (has_row, role, text) in enumerate(zip(*columns.values(), strict=True)):
                if has_row:
                    yield None, repair.row(role, text)
                else:
                    if repair is not None:
                        yield None, repair.rest()
                    figures = tuple(part.column(c)[i].as_py() for c in (*_FIGURES, "audit"))
                    repair = Repair(figures[-1])
                    yield figures, None
    if repair is not None:
        yield None, repair.rest()


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text of the repaired conversations, turns counted from 0.

    Rows that are inserted have an empty text. See ``digests`` for rows of all kinds.
    """
    ddl = "conv_id long, turn long, role string, text string"
    arrow = to_arrow_schema(schema_of(ddl))

    def run(batches):
        rows, size, conv_id, turn = [], 0, None, 0
        for figures, own in _repaired_rows(batches):
            if figures is not None:
                conv_id, turn = figures[0], 0
                continue
            for role, text in own:
                rows.append((conv_id, turn, role, text))
                turn, size = turn + 1, size + 100 + len(text)
            if size > 1 << 22:
                yield _emit(rows, arrow)
                rows, size = [], 0
        if rows:
            yield _emit(rows, arrow)

    return _with_audits(conversations).mapInArrow(run, schema_of(ddl))


def digests(conversations: DataFrame) -> DataFrame:
    """The columns of ``audits`` and repaired_sha256 of every conversation.

    Null ids and turns count as one space where a row's damage is drawn, null roles and texts are one
    space. Rows with a null conv_id are a conversation of their own. Rows of one turn are taken by
    role, then by a digest of their text; equal rows follow each other. A conversation of which no row
    is left has zeros, an empty audit and the hash of nothing. Further columns change nothing; an empty
    table gives an empty result. Of a conversation a task holds a few bytes for each row, as its audit,
    one value of the result, takes one; texts pass by one at a time on their way into the hash.
    """
    ddl = f"{_COUNTS}, repaired_sha256 string"
    arrow = to_arrow_schema(schema_of(ddl))

    def run(batches):
        def results():
            figures, sha, any_row = None, None, False
            for found, own in _repaired_rows(batches):
                if found is not None:
                    if figures is not None:
                        yield (*figures, sha.hexdigest())
                    figures, sha, any_row = found, hashlib.sha256(), False
                    continue
                for role, text in own:
                    sha.update(("\n" if any_row else "").encode() + f"{role}:{text}".encode())
                    any_row = True
            if figures is not None:
                yield (*figures, sha.hexdigest())

        yield from _emitted(results(), arrow)

    return _with_audits(conversations).mapInArrow(run, schema_of(ddl))
