"""Repair of conversation structure by a cheapest edit script, found with a bidirectional Dijkstra search over the edit lattice.

A conversation's rows, in the order of (turn, role, text), are kept (K, cost 0), given another role (R, 2), deleted (D, 3) or joined by inserted empty turns
(I, 2) until the initials of the roles read ``(s?(ua)+)?``. Blank rows and repetitions of an earlier row's role and text must go; a row that stays without a closing
``.``, ``!`` or ``?`` costs 1 more. A node of the lattice is (rows consumed, state of the grammar). Heaps from both ends settle nodes until
their least keys together pass the best crossing, so all crossings of equal cost are known; the least concatenated script wins. Scripts are chains of parents, one
letter for each node, so memory grows with a conversation's rows and not with their square.

Two scripts of equal cost to one node are never one the other's prefix (what is longer has insertions more, which cost), so the least
script to a node is always part of the least script through it.

Edges: a null role or text counts as one space; turns that are null come first; rows with a null conversation id make up one conversation; equal rows are
repetitions like any other. An empty table gives an empty result; further columns are not read. A conversation is repaired in one task, as its script
depends on all of its rows in order; the others are spread by their id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

KEEP, REROLE, DELETE, INSERT = ("K", 0), ("R", 2), ("D", 3), ("I", 2)
UNFINISHED = 1
SPACES = " \t\n\v\f\r"
#: States of the grammar: nothing yet, after a system turn, after a user's, after an assistant's. The next user or assistant turn leads on to AFTER.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = (USER, USER, ASSISTANT, USER)
BEFORE = ((), (), (START, SYSTEM, ASSISTANT), (USER,))
ENDS = (START, ASSISTANT)
TURN = "struct<turn:bigint,role:string,text:string>"
RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, turns array<struct<role:string,text:string>>"


def kept_state(state: int, initial: str) -> int | None:
    """Where a row with this role's initial leads when it's kept."""
    if initial == "ua"[state == USER]:
        return AFTER[state]
    return SYSTEM if state == START and initial == "s" else None


class Lattice:
    """Edges of the lattice of rows (initial, must it go, cost of keeping it)."""

    def __init__(self, rows: list[tuple[str, bool, int]]):
        self.rows = rows

    def onward(self, node: tuple[int, int]) -> Iterator[tuple[str, int, tuple[int, int]]]:
        i, state = node
        if i < len(self.rows):
            initial, must_go, extra = self.rows[i]
            if not must_go:
                if (to := kept_state(state, initial)) is not None:
                    yield KEEP[0], KEEP[1] + extra, (i + 1, to)
                yield REROLE[0], REROLE[1] + extra, (i + 1, AFTER[state])
            yield DELETE[0], DELETE[1], (i + 1, state)
        yield INSERT[0], INSERT[1], (i, AFTER[state])

    def back(self, node: tuple[int, int]) -> Iterator[tuple[str, int, tuple[int, int]]]:
        i, state = node
        if i:
            initial, must_go, extra = self.rows[i - 1]
            if not must_go:
                for was in range(4):
                    if kept_state(was, initial) == state:
                        yield KEEP[0], KEEP[1] + extra, (i - 1, was)
                for was in BEFORE[state]:
                    yield REROLE[0], REROLE[1] + extra, (i - 1, was)
            yield DELETE[0], DELETE[1], (i - 1, state)
        for was in BEFORE[state]:
            yield INSERT[0], INSERT[1], (i, was)


class Side:
    """One of the two searches: labels (cost, neighbour towards its origin, letter, length of the script), and which nodes are settled."""

    def __init__(self, origins: list[tuple[int, int]], sign: int):
        self.sign, self.label, self.settled = sign, {o: (0, None, "", 0) for o in origins}, set()
        self.heap = [(0, sign * o[0], o) for o in origins]

    def least(self) -> float:
        while self.heap and self.heap[0][2] in self.settled:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else float("inf")

    def settle(self) -> tuple[int, int]:
        """Edges of cost 0 lead one row on, so among equal costs the rows are taken in the search's direction."""
        node = heapq.heappop(self.heap)[2]
        self.settled.add(node)
        return node

    def relax(self, node: tuple[int, int], letter: str, cost: int, to: tuple[int, int]) -> None:
        if to in self.settled:
            return
        total, old = self.label[node][0] + cost, self.label.get(to)
        if old is None or total < old[0] or (total == old[0] and self.precedes((letter, node), (old[2], old[1]))):
            self.label[to] = (total, node, letter, self.label[node][3] + 1)
            heapq.heappush(self.heap, (total, self.sign * to[0], to))

    def precedes(self, a: tuple, b: tuple) -> bool:
        """Whether script a comes before script b; each is its outermost letter and the node before that."""
        (x, u), (y, v) = a, b
        if self.sign < 0:  # read from this side outwards: the outermost letter is the first
            while x == y and u != v and u is not None and v is not None:
                (_, u, x, _), (_, v, y, _) = self.label[u], self.label[v]
            return x < y
        left, right = [x], [y]
        while u != v:
            if self.label[u][3] >= self.label[v][3]:
                left.append(self.label[u][2])
                u = self.label[u][1]
            else:
                right.append(self.label[v][2])
                v = self.label[v][1]
        return left[::-1] < right[::-1]

    def script(self, node: tuple[int, int] | None) -> str:
        letters = []
        while node is not None:
            _, node, letter, _ = self.label[node]
            letters.append(letter)
        return "".join(letters if self.sign < 0 else letters[::-1])


def cheapest(rows: list[tuple[str, bool, int]]) -> tuple[int, str]:
    """Cost and script of the cheapest edits of rows (initial of the role, must it go, cost of keeping it), the least script of equal ones."""
    lattice, ends = Lattice(rows), [(len(rows), state) for state in ENDS]
    ahead, behind = Side([(0, START)], 1), Side(ends, -1)
    best = float("inf")

    def step(side: Side, other: Side, edges) -> None:
        nonlocal best
        node = side.settle()
        cost = side.label[node][0]
        if node in other.settled:
            best = min(best, cost + other.label[node][0])
        for letter, more, to in edges(node):
            side.relax(node, letter, more, to)
            if to in other.settled:
                best = min(best, cost + more + other.label[to][0])

    for _ in ends:
        step(behind, ahead, lattice.back)
    while ahead.least() + behind.least() <= best and (ahead.heap or behind.heap):
        if ahead.least() <= behind.least():
            step(ahead, behind, lattice.onward)
        else:
            step(behind, ahead, lattice.back)
    # every cheapest script has a last node that was settled from the front, and what follows was settled from the back
    scripts = [ahead.script(e) for e in ends if e in ahead.settled and ahead.label[e][0] == best]
    for node in ahead.settled:
        for letter, more, to in lattice.onward(node):
            if to not in ahead.settled and to in behind.settled and ahead.label[node][0] + more + behind.label[to][0] == best:
                scripts.append(ahead.script(node) + letter + behind.script(to))
    return int(best), min(scripts)


def edited(rows: list[tuple[str, str]], script: str) -> list[tuple[str, str]]:
    """The turns (role, text) that a script makes of rows."""
    out, state, left = [], START, iter(rows)
    for letter in script:
        role, text = (None, "") if letter == INSERT[0] else next(left)
        if letter == DELETE[0]:
            continue
        if letter == KEEP[0]:
            state = kept_state(state, role[:1])
        else:
            state = AFTER[state]
            role = "assistant" if state == ASSISTANT else "user"
        out.append((role, text))
    return out


def repaired(turns: list[int | None], roles: list[str | None], texts: list[str | None]) -> tuple:
    """The result's columns for one conversation."""
    rows = [(" " if r is None else r, " " if t is None else t) for r, t in zip(roles, texts, strict=True)]
    counts, lattice, seen = {"blank": 0, "duplicate": 0, "truncated": 0}, [], set()
    for role, text in rows:
        end = text.rstrip(SPACES)[-1:]
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        lattice.append((role[:1], fault in ("blank", "duplicate"), UNFINISHED if fault == "truncated" else 0))
    known = {t for t in turns if t is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(lattice, lattice[1:], strict=False))
    cost, script = cheapest(lattice)
    return (min(gaps, (1 << 63) - 1), *counts.values(), illegal, cost, script, [{"role": r, "text": t} for r, t in edited(rows, script)])


def repair(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: Column | None = None) -> DataFrame:
    """One row for each conversation: its id, gaps in its turns, faults, illegal neighbours, the cost and script of its repair, and the repaired turns.

    present: rows that don't meet it name their conversation, but are none of its rows.
    """
    one = F.struct(F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    gathered = rows.groupBy(F.col(conversation).alias("conversation_")).agg(F.sort_array(F.collect_list(one if present is None else F.when(present, one))).alias("rows_"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("rows_")
            flat, bounds = lists.flatten(), [0, *pa.compute.cumulative_sum(pa.compute.list_value_length(lists)).to_pylist()]
            turns, roles, texts = (flat.field(i).to_pylist() for i in range(3))
            found = [repaired(turns[a:b], roles[a:b], texts[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
            columns = list(zip(*found, strict=True)) or [()] * 8
            kinds = [pa.int64()] * 6 + [pa.string(), pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))]
            yield pa.RecordBatch.from_arrays([batch.column("conversation_"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], [conversation, *NAMES])

    kind = rows.schema[conversation].dataType.simpleString()
    return gathered.mapInArrow(each, f"`{conversation}` {kind}, {RESULT}")


NAMES = [c.split()[0] for c in RESULT.split(", ")]


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id and row (turn, role, text), by crc32 of 'conv_id:turn' modulo 20: 0 a null row, 1 without text, 2 without closing marks, 3 twice, 4 a user's. Null: one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    row = F.struct(F.col("turn").cast("long").alias("turn"), F.when(fate == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"))
    return conversations.select("conv_id", F.explode_outer(F.array_repeat(row, F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1))).alias("row"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations"))
    found = repair(rows.select("conv_id", F.col("row").isNotNull().alias("present"), "row.*"), present=F.col("present"))
    digest = F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n").cast("binary"), 256)
    return found.withColumn("repaired_sha256", digest).drop("turns")
