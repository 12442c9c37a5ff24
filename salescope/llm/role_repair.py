"""Minimum-cost repair of conversation roles, and rendering of the repaired turns.

A legal conversation is a path of an automaton over roles. Each given turn may keep its
role, take another one, or be merged into the turn before it, and empty turns may be
inserted before it; the cheapest way is a shortest path. One turn is a matrix of costs
from the role before to the role after, and a stretch of turns is the (min, +) product of
its matrices, so a conversation of any length is cut: turns are range-partitioned by
(conversation, turn) and each task streams over its rows. A conversation that begins and
ends inside a task is solved on the spot. The first and the last one of a task may go on
in another: their rows are written as they are, with the product of the stretch; one
short scan over a conversation's stretches (one per partition at most) fixes the roles at
their ends, and each stretch is then solved on its own, streamed again. What a task holds
at a time is one conversation's rows of one partition, as Arrow batches. Costs carry the
number of turns in their low bits, so among equally cheap repairs the one with the fewest
turns wins and every stretch knows where its output numbers start.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.session import materialize

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("system", "user", "assistant")
#: Which role may follow which state.
FOLLOWS = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
ENDS = (USER, ASSISTANT)
#: Costs: another role for a known or an unknown one, a merge, an inserted empty turn.
RELABEL, RELABEL_UNKNOWN, MERGE, INSERT = 2, 1, 1, 3
COST = 1 << 40
NEVER = 1 << 62
MAX_INSERTS = 2


def role_number(role: str | None) -> int:
    """1 to 3, or 0 for a missing or unknown role."""
    name = (role or "").strip().lower()
    return ROLES.index(name) + 1 if name in ROLES else 0


def inserts(state: int, goal: int, left: int = MAX_INSERTS) -> list[int] | None:
    """The shortest list of empty turns after which ``goal`` may follow ``state``."""
    if goal in FOLLOWS[state]:
        return []
    if not left:
        return None
    ways = [[s, *rest] for s in FOLLOWS[state] if (rest := inserts(s, goal, left - 1)) is not None]
    return min(ways, key=len, default=None)


def _steps(role: int) -> dict[tuple[int, int], tuple[int, str, list[int]]]:
    """(state, next state) -> (cost, action, inserted roles) for a turn with this role."""
    out: dict[tuple[int, int], tuple[int, str, list[int]]] = {}
    for s in FOLLOWS:
        for t in (SYSTEM, USER, ASSISTANT):
            change = 0 if t == role else RELABEL if role else RELABEL_UNKNOWN
            options = []
            if s == t:
                options.append(((change + MERGE) * COST, "merge", []))
            if (empty := inserts(s, t)) is not None:
                name = "relabel" if change else "keep"
                options.append(((change + INSERT * len(empty)) * COST + 1 + len(empty), name, empty))
            if options:
                out[s, t] = min(options, key=lambda x: x[0])
    return out


STEPS = [_steps(r) for r in range(4)]
UNIT = tuple(0 if i == j else NEVER for i in range(4) for j in range(4))


def times(m: tuple[int, ...], role: int) -> tuple[int, ...]:
    """The (min, +) product of a stretch with one more turn."""
    out = [NEVER] * 16
    for (s, t), (cost, _, _) in STEPS[role].items():
        for i in range(4):
            got = m[4 * i + s] + cost
            if got < out[4 * i + t]:
                out[4 * i + t] = got
    return tuple(out)


def solve(roles: Sequence[int], entry: int, leave: int | None = None) -> list[tuple[int, int]]:
    """(state before, state after) of each turn on the cheapest way from ``entry`` to ``leave``, or to any legal end."""
    best, back = {entry: 0}, []
    for role in roles:
        new: dict[int, tuple[int, int]] = {}
        for (s, t), (cost, _, _) in STEPS[role].items():
            if s in best and best[s] + cost < new.get(t, (NEVER, 0))[0]:
                new[t] = (best[s] + cost, s)
        best = {t: c for t, (c, _) in new.items()}
        back.append({t: s for t, (_, s) in new.items()})
    path, t = [], min(ENDS, key=lambda x: best.get(x, NEVER)) if leave is None else leave
    for step in reversed(back):
        path.append((step[t], t))
        t = step[t]
    return path[::-1]


#: The ways of short stretches are remembered, as most conversations are alike.
remembered = lru_cache(4096)(solve)

#: A finished row has an action; one without waits for the ends of its stretch, its text in ``rendered``.
WORK = pa.schema([
    ("conv_id", pa.int64()), ("turn", pa.int64()), ("place", pa.int64()), ("out_turn", pa.int64()), ("role", pa.string()),
    ("action", pa.string()), ("rendered", pa.string()), ("pid", pa.int32()), ("seq", pa.int64()), ("product", pa.list_(pa.int64()))])
DONE = pa.schema(list(WORK)[:7])


def _render(conv, rows: list[tuple], pid: int, enter: int, leave: int | None, first: int, last: bool) -> list[list]:
    """Repaired and rendered turns of a stretch of rows (turn, role, text, seq)."""
    out, number = [], first - 1
    roles = tuple(role_number(r[1]) for r in rows)
    plan = (remembered if len(roles) <= 64 else solve)(roles, enter, leave)
    for (turn, _, text, seq), role, (s, t) in zip(rows, roles, plan):
        _, action, empty = STEPS[role][s, t]
        place = (pid << 40) + (seq << 2)
        for e in empty:
            number += 1
            out.append([conv, None, place, number, ROLES[e - 1], "insert", f"{'<|end|>' if number else ''}<|{ROLES[e - 1]}|>\n"])
            place += 1
        if action == "merge":
            out.append([conv, turn, place, number, ROLES[t - 1], action, f"\n{text or ''}"])
        else:
            number += 1
            out.append([conv, turn, place, number, ROLES[t - 1], action, f"{'<|end|>' if number else ''}<|{ROLES[t - 1]}|>\n{text or ''}"])
    if last:
        out[-1][-1] += "<|end|>"
    return out


def _batches(rows: list[list], schema: pa.Schema, size: int = 1024) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), size):
        part = rows[at : at + size]
        columns = [*map(list, zip(*part))] + [[None] * len(part)] * (len(schema) - len(part[0]))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[pa.RecordBatch]]:
    """The rows of each run of equal keys in a sorted stream, as slices of its batches."""
    run, before = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = list(zip(*(batch.column(k).to_pylist() for k in keys)))
        start = 0
        for i, key in enumerate(values):
            if key != before and (run or i > start):
                if i > start:
                    run.append(batch.slice(start, i - start))
                yield run
                run, start = [], i
            before = key
        run.append(batch.slice(start))
    if run:
        yield run


def _waiting(run: list[pa.RecordBatch], pid: int, seq: int) -> Iterator[pa.RecordBatch]:
    """The rows of a stretch as they are; the last one carries the product."""
    product = UNIT
    for n, batch in enumerate(run):
        for r in batch.column("role").to_pylist():
            product = times(product, role_number(r))
        rows, last = batch.num_rows, n == len(run) - 1
        none = pa.nulls(rows, pa.int64())
        products = pa.array([None] * (rows - 1) + [list(product) if last else None], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([
            batch.column("conv_id"), batch.column("turn"), none, none, batch.column("role").cast(pa.string()), pa.nulls(rows, pa.string()),
            batch.column("text").cast(pa.string()), pa.array([pid] * rows, pa.int32()), pa.array(range(seq, seq + rows), pa.int64()), products],
            schema=WORK)
        seq += rows


def _inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Solves every conversation of a sorted partition but the first and the last, whose rows it passes on."""
    pid, seq, done = TaskContext.get().partitionId(), 0, []
    runs = _runs(batches, ["conv_id"])
    run, first = next(runs, None), True
    while run is not None:
        following = next(runs, None)
        if first or following is None:
            yield from _batches(done, WORK)
            done, first = [], False
            yield from _waiting(run, pid, seq)
            seq += sum(b.num_rows for b in run)
        else:
            rows = [r for b in run for r in zip(*(b.column(c).to_pylist() for c in ("turn", "role", "text")))]
            conv = run[0].column("conv_id")[0].as_py()
            done += _render(conv, [(*r, seq + i) for i, r in enumerate(rows)], pid, START, None, 0, True)
            seq += len(rows)
            if len(done) >= 1024:
                yield from _batches(done, WORK)
                done = []
        run = following


def _at_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Solves stretches whose ends are known, in a stream sorted by task and number."""
    for run in _runs(batches, ["pid", "conv_id"]):
        at = {c: run[0].column(c)[0].as_py() for c in ("conv_id", "pid", "enter", "leave", "first", "last")}
        rows = [r for b in run for r in zip(*(b.column(c).to_pylist() for c in ("turn", "role", "rendered", "seq")))]
        yield from _batches(_render(at["conv_id"], rows, at["pid"], at["enter"], at["leave"], at["first"], at["last"]), DONE)


def _scan(pdf: pd.DataFrame) -> pd.DataFrame:
    """Entry, exit and first output number of each stretch of one conversation."""
    pdf = pdf.sort_values("pid")
    best, back = [0, NEVER, NEVER, NEVER], []
    for m in pdf["product"]:
        new, came = [NEVER] * 4, [0] * 4
        for s in range(4):
            for t in range(4):
                if best[s] < NEVER and m[4 * s + t] < NEVER and best[s] + m[4 * s + t] < new[t]:
                    new[t], came[t] = best[s] + int(m[4 * s + t]), s
        best, _ = new, back.append((came, new))
    leave, rows = min(ENDS, key=lambda t: best[t]), []
    for i in range(len(back) - 1, -1, -1):
        came, _ = back[i]
        enter = came[leave]
        before = back[i - 1][1][enter] % COST if i else 0
        rows.append((pdf["conv_id"].iloc[0], pdf["pid"].iloc[i], enter, leave, before, i == len(back) - 1))
        leave = enter
    return pd.DataFrame(rows, columns=["conv_id", "pid", "enter", "leave", "first", "last"])


def repair_roles(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per given or inserted turn: (conv_id, turn, place, out_turn, role, action, rendered).

    The pieces ``rendered`` of a conversation, put together by ``place``, are its rendered
    form; ``out_turn`` numbers the repaired turns from 0 and merged pieces share one. Turns
    are taken in order of ``turn``, a null turn first, ties by a hash of role and text. Roles
    are matched without case and outer blanks; a null or unknown one may become any role. Null
    texts render as empty, repeated rows are turns of their own, rows with a null
    conversation form one conversation, an empty table has no rows, texts may be of any
    length, and other columns are ignored. ``conv_id`` and ``turn`` are taken as long
    numbers; a text that is none is an error under ANSI rules.
    """
    t = turns.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    # rows alike in all of it may swap places, so the number that deals them out need not be stable
    t = t.withColumn("tie", F.xxhash64("role", "text")).withColumn("deal", F.monotonically_increasing_id() % 1024)
    order = ["conv_id", "turn", "tie", "deal"]
    parts = max(1, int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    t = t.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text")
    done = "conv_id long, turn long, place long, out_turn long, role string, action string, rendered string"
    t = materialize(t.mapInArrow(_inside, f"{done}, pid int, seq long, product array<long>"), "turns")
    ends = t.filter("product is not null").select("conv_id", "pid", "product")  # two rows a partition
    states = "conv_id long, pid int, enter int, leave int, first long, last boolean"
    ends = materialize(ends.groupBy("conv_id").applyInPandas(_scan, states), "states")
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("pid") == F.col("_p"))
    open_rows = t.filter("action is null").drop("product").join(ends.withColumnsRenamed({"conv_id": "_c", "pid": "_p"}), same).drop("_c", "_p")
    open_rows = open_rows.repartitionByRange(parts, "pid").sortWithinPartitions("pid", "seq")
    return t.filter("action is not null").select(*DONE.names).unionByName(open_rows.mapInArrow(_at_edges, done))
