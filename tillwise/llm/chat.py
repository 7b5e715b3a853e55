"""Chat formatting by minimum-cost role repair.

A conversation is legal if it has at most one system turn, at the start, and then user and
assistant turns by turns, the assistant last. Dynamic programming over that automaton chooses, for
every turn, to keep it, to merge it into the turn before, to give it another role, or to insert
empty turns before it, at the least total cost; the repaired sequence is then rendered.

A long conversation is cut into pieces. The cost of a piece from each state to each is a small
(min, +) matrix, so pieces are solved apart: matrices first, then the states between pieces, then
the turns within each piece.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import land

ROLES = ("system", "user", "assistant")
#: States of the automaton: nothing yet, or the role of the open turn.
START, STATES = 0, 4
MERGE, RELABEL, RELABEL_UNKNOWN, INSERT = 1, 2, 1, 3
#: Roles that may open after a state.
OPENS = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
FINAL = 3
INFINITE = 1 << 40
#: Turns of a conversation that are solved together: a piece has 2^PIECE_BITS turns at most.
PIECE_BITS = 12
HEAD, BETWEEN, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
_MARKED, _ESCAPED = re.compile(r"<\|( *)im_"), re.compile(r"<\| ( *)im_")
_NULL_KEY = -(2**63)


def role_class(role: str | None) -> int:
    """1 to 3 for the known roles (case and outer blanks ignored), 0 for any other or none."""
    name = (role or "").strip().lower()
    return ROLES.index(name) + 1 if name in ROLES else 0


def openings(state: int) -> dict[int, tuple[int, ...]]:
    """Role that can open after ``state`` -> the roles of the empty turns inserted before it."""
    found: dict[int, tuple[int, ...]] = {}
    frontier = [(state, ())]
    while frontier:
        later = []
        for at, path in frontier:
            for role in OPENS[at]:
                if role not in found:
                    found[role] = path
                    later.append((role, (*path, role)))
        frontier = later
    return found


def choices(cls: int) -> dict[tuple[int, int], tuple[int, str, tuple[int, ...]]]:
    """(state, next state) -> the cheapest (cost, action, inserted roles) for a turn of class ``cls``."""
    relabel = RELABEL if cls else RELABEL_UNKNOWN
    best: dict[tuple[int, int], tuple[int, str, tuple[int, ...]]] = {}
    for state in range(STATES):
        options = []
        if state != START:
            options.append((state, MERGE + (0 if cls == state else relabel), "merge", ()))
        for role, path in openings(state).items():
            kept = role == cls
            cost = INSERT * len(path) + (0 if kept else relabel)
            options.append((role, cost, "keep" if kept else "relabel", path))
        for to, cost, action, path in options:
            if (state, to) not in best or (cost, action) < best[state, to][:2]:
                best[state, to] = (cost, action, path)
    return best


CHOICES = [choices(cls) for cls in range(4)]
MATRICES = np.full((4, STATES, STATES), INFINITE, dtype=np.int64)
for _cls, _best in enumerate(CHOICES):
    for (_a, _b), (_cost, _, _) in _best.items():
        MATRICES[_cls, _a, _b] = _cost
#: Roles of the empty turns that close a conversation in each state.
ENDINGS = {s: (() if s == FINAL else (*openings(s)[FINAL], FINAL)) for s in range(STATES)}
END_COST = np.array([INSERT * len(ENDINGS[s]) for s in range(STATES)], dtype=np.int64)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(min, +) product."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), INFINITE)


def best_states(matrices: list[np.ndarray], entry: int, exit_state: int | None) -> list[int]:
    """The cheapest states after each matrix, from ``entry`` to ``exit_state`` (None: the cheapest
    end); among equal costs the smallest state."""
    cost = np.full(STATES, INFINITE, dtype=np.int64)
    cost[entry] = 0
    came = []
    for matrix in matrices:
        total = cost[:, None] + matrix
        came.append(total.argmin(axis=0))
        cost = np.minimum(total.min(axis=0), INFINITE)
    at = int((cost + END_COST).argmin()) if exit_state is None else exit_state
    states = []
    for step in reversed(came):
        states.append(at)
        at = int(step[at])
    return states[::-1]


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows with equal first ``keys`` columns of sorted input, also across batches."""
    last, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        changed = np.zeros(batch.num_rows - 1, dtype=bool)
        for column in columns:
            changed |= column[1:] != column[:-1]
        bounds = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
        for s, e in zip(bounds, bounds[1:], strict=False):
            key = tuple(c[s] for c in columns)
            if parts and key != last:
                yield pa.Table.from_batches(parts)
                parts = []
            last = key
            parts.append(batch.slice(s, e - s))
    if parts:
        yield pa.Table.from_batches(parts)


def repair(conversations: DataFrame) -> DataFrame:
    """One row per turn of ``conversations`` (conv_id, turn, role, text), repaired and rendered.

    Columns: conv_id, turn, role; new_role; action ("keep", "merge" or "relabel"); inserted (roles
    of the empty turns put before it); appended (roles of those put after the last turn of a
    conversation); cost; and segment, the turn's share of the rendered conversation: the segments
    in order of turn are the rendering.

    Turns go by number, then role, then hash of the text; null numbers come first, repeated turns
    are all kept. Null conv_ids are one conversation. Null texts are empty, unknown and null roles
    are relabelled or merged. Markers inside a text are broken up. An empty table gives no rows;
    other columns are ignored.
    """
    cls = F.create_map(*[F.lit(x) for i, r in enumerate(ROLES) for x in (r, i + 1)])
    turns = conversations.select(
        F.coalesce("conv_id", F.lit(_NULL_KEY)).alias("key"),
        "conv_id",
        "turn",
        "role",
        "text",
        F.coalesce(F.element_at(cls, F.lower(F.btrim(F.coalesce("role", F.lit(""))))), F.lit(0)).alias("cls"),
        F.xxhash64("text").alias("h"),
        F.monotonically_increasing_id().alias("seen"),  # tells repeated turns apart, so that they can be dealt out
    )
    order = ["key", "turn", "role", "h", "seen"]
    dealt = turns.repartitionByRange(*order).sortWithinPartitions(*order).drop("h", "seen")
    numbered = land(dealt.mapInArrow(_number, "key bigint, conv_id bigint, turn bigint, role string, text string, cls int, ord bigint"))
    pieced = numbered.withColumn("piece", F.shiftright("ord", PIECE_BITS))
    costs = (
        pieced.select("key", "piece", "ord", "cls")
        .repartition("key", "piece")
        .sortWithinPartitions("key", "piece", "ord")
        .mapInArrow(_piece_costs, "key bigint, piece bigint, costs array<bigint>")
    )
    ends = (
        costs.repartition("key")
        .sortWithinPartitions("key", "piece")
        .mapInArrow(_piece_ends, "key bigint, piece bigint, entry int, exit int, last boolean")
    )
    return (
        pieced.join(ends, ["key", "piece"])
        .select("key", "piece", "ord", "conv_id", "turn", "role", "text", "cls", "entry", "exit", "last")
        .repartition("key", "piece")
        .sortWithinPartitions("key", "piece", "ord")
        .mapInArrow(
            _solve,
            "conv_id bigint, turn bigint, role string, new_role string, action string, inserted array<string>, "
            "appended array<string>, cost bigint, segment string",
        )
    )


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ord, ascending over the whole table: the number of the range, then of the row in it."""
    base = TaskContext.get().partitionId() << 40
    for batch in batches:
        numbers = pa.array(np.arange(base, base + batch.num_rows, dtype=np.int64))
        base += batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, numbers], names=[*batch.schema.names, "ord"])


def _piece_costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in groups(batches, 2):
        total = None
        for cls in group.column("cls").to_pylist():
            total = MATRICES[cls] if total is None else product(total, MATRICES[cls])
        yield pa.RecordBatch.from_arrays(
            [
                group.column("key").combine_chunks()[:1],
                group.column("piece").combine_chunks()[:1],
                pa.array([total.ravel().tolist()], type=pa.list_(pa.int64())),
            ],
            names=["key", "piece", "costs"],
        )


def _piece_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in groups(batches, 1):
        matrices = [np.array(c, dtype=np.int64).reshape(STATES, STATES) for c in group.column("costs").to_pylist()]
        states = best_states(matrices, START, None)
        yield pa.RecordBatch.from_arrays(
            [
                group.column("key").combine_chunks(),
                group.column("piece").combine_chunks(),
                pa.array([START, *states[:-1]], type=pa.int32()),
                pa.array(states, type=pa.int32()),
                pa.array([False] * (len(states) - 1) + [True]),
            ],
            names=["key", "piece", "entry", "exit", "last"],
        )


def name_of(state: int) -> str:
    return ROLES[state - 1]


def escape(text: str) -> str:
    """``text`` with one blank more in whatever could be read as a mark of a turn, or as such a mark
    escaped; so no two texts render alike."""
    return _MARKED.sub("<| \\1im_", text)


def unescape(text: str) -> str:
    """The text that ``escape`` was given."""
    return _ESCAPED.sub("<|\\1im_", text)


def opening(state: int, text: str = "") -> str:
    """The head of a turn and its text, not yet closed."""
    return f"{HEAD}{name_of(state)}{BETWEEN}{text}"


def solve(classes: list[int], texts: list[str | None], entry: int, exit_state: int | None, last: bool) -> list[tuple]:
    """(new_role, action, inserted, appended, cost, segment) of each turn of one piece."""
    states = best_states([MATRICES[c] for c in classes], entry, exit_state)
    rows, at = [], entry
    for i, (cls, to, text) in enumerate(zip(classes, states, texts, strict=True)):
        cost, action, path = CHOICES[cls][at, to]
        text = escape(text or "")
        if action == "merge":
            segment = BETWEEN + text
        else:
            segment = CLOSE if at != START else ""
            segment += "".join(opening(r) + CLOSE for r in path) + opening(to, text)
        ending: tuple[int, ...] = ()
        if last and i == len(classes) - 1:
            ending = ENDINGS[to]
            cost += INSERT * len(ending)
            segment += CLOSE + "".join(opening(r) + CLOSE for r in ending)
        rows.append((name_of(to), action, [name_of(r) for r in path], [name_of(r) for r in ending], cost, segment))
        at = to
    return rows


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = pa.list_(pa.string())
    kinds = [pa.string(), pa.string(), names, names, pa.int64(), pa.string()]
    for group in groups(batches, 2):
        first = group.slice(0, 1).to_pylist()[0]
        rows = solve(
            group.column("cls").to_pylist(), group.column("text").to_pylist(), first["entry"], first["exit"], first["last"]
        )
        yield pa.RecordBatch.from_arrays(
            [group.column(c).combine_chunks() for c in ("conv_id", "turn", "role")]
            + [pa.array(list(x), type=t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)],
            names=["conv_id", "turn", "role", "new_role", "action", "inserted", "appended", "cost", "segment"],
        )
