"""Chat formatting by minimum-cost role repair.

A conversation is legal if an optional system turn is followed by user and assistant turns in
alternation, a user first and an assistant last. Dynamic programming over that automaton's states
chooses for each turn to keep it, merge it into the open turn, give it another role, or put an empty
turn before it, so that the sum of costs is least. The least costs of a run of turns between any two
states form a small matrix, and matrices of consecutive runs multiply (in min and plus): a very long
conversation is cut into blocks, the blocks' matrices fix the states at the cuts, and each block is
repaired by itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.operators.indexing import with_row_index
from assaylake.session import materialize

BLOCK = 4_096
START, SYSTEM, USER, ASSISTANT = range(4)  # the open turn
ROLES = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
NAMES = ("", "system", "user", "assistant")
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
RELABEL, MERGE_SAME, MERGE_OTHER, INSERT = 3.0, 1.0, 4.0, 2.0
END_COST = (0.0, 2 * INSERT, INSERT, 0.0)  # empty turns that close the conversation
OPEN, CLOSE = "<|im_start|>{}\n", "<|im_end|>\n"


def _steps(role: int) -> list[tuple[int, int, float, str, int]]:
    """(from, to, cost, action, inserted role) of a turn of this role (0: none that is known), in order of preference."""
    out = []
    for state in range(4):
        for to in NEXT[state]:
            out.append((state, to, 0.0 if to == role else RELABEL, "keep" if to == role else "relabel", 0))
            if role and to != role and role in NEXT[to]:
                out.append((state, role, INSERT, "insert", to))
        if state != START:
            out.append((state, state, MERGE_SAME if state == role else MERGE_OTHER, "merge", 0))
    return sorted(out, key=lambda s: (s[2], ("keep", "merge", "insert", "relabel").index(s[3]), s[1], s[4]))


STEPS = {role: _steps(role) for role in range(4)}


def role_number(role: str | None) -> int:
    return ROLES.get((role or "").strip().lower(), 0)


def block_costs(roles: list[int]) -> np.ndarray:
    """Least cost from each state before the turns to each state behind them."""
    matrix = {r: np.full((4, 4), np.inf) for r in STEPS}
    for r, steps in STEPS.items():
        for a, b, cost, _, _ in steps:
            matrix[r][a, b] = min(matrix[r][a, b], cost)
    total = np.where(np.eye(4, dtype=bool), 0.0, np.inf)
    for r in roles:
        total = (total[:, :, None] + matrix[r][None]).min(axis=1)
    return total


def repair(roles: list[int], enter: int, leave: int | None) -> list[tuple[int, int, str, int]]:
    """(state before, state behind, action, inserted role) of each turn on a cheapest way; ``leave`` None ends the conversation."""
    best = [np.inf] * 4
    best[enter] = 0.0
    trail = []
    for r in roles:
        new, how = [np.inf] * 4, [None] * 4
        for step in STEPS[r]:
            if best[step[0]] + step[2] < new[step[1]]:
                new[step[1]], how[step[1]] = best[step[0]] + step[2], step
        best = new
        trail.append(how)
    state = int(np.argmin(np.array(best) + END_COST)) if leave is None else leave
    out = []
    for how in reversed(trail):
        step = how[state]
        out.append((step[0], step[1], step[3], step[4]))
        state = step[0]
    return out[::-1]


def _piece(before: int, to: int, action: str, inserted: int, text: str, last: bool) -> str:
    text = text.replace("<|", "< |")  # no text may open or close a turn
    if action == "merge":
        out = "\n\n" + text
    else:
        out = CLOSE if before != START else ""
        if inserted:
            out += OPEN.format(NAMES[inserted]) + CLOSE
        out += OPEN.format(NAMES[to]) + text
    if last:
        out += CLOSE
        for role in {SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,)}.get(to, ()):
            out += OPEN.format(NAMES[role]) + CLOSE
    return out


def _runs(table: pa.Table) -> tuple[dict, list[tuple[int, int]]]:
    """Columns as lists, sorted by conversation and position, and the runs of rows of one block."""
    cols = {c: table.column(c).to_pylist() for c in table.column_names}
    order = sorted(range(table.num_rows), key=lambda i: (cols["conv"][i] is not None, cols["conv"][i], cols["pos"][i]))
    cols = {c: [v[i] for i in order] for c, v in cols.items()}
    cuts = [i for i in range(table.num_rows) if not i or (cols["conv"][i], cols["block"][i]) != (cols["conv"][i - 1], cols["block"][i - 1])]
    return cols, list(zip(cuts, [*cuts[1:], table.num_rows], strict=True))


def _matrices(table: pa.Table) -> pa.Table:
    cols, runs = _runs(table)
    rows = [(cols["conv"][a], cols["block"][a], block_costs([role_number(r) for r in cols["role"][a:b]]).ravel().tolist()) for a, b in runs]
    return pa.table({"conv": pa.array([r[0] for r in rows], table.schema.field("conv").type), "block": pa.array([r[1] for r in rows], pa.int64()),
                     "costs": pa.array([r[2] for r in rows], pa.list_(pa.float64()))})


def _states(table: pa.Table) -> pa.Table:
    """The states at the cuts of one long conversation, from its blocks' matrices."""
    order = np.argsort(np.asarray(table.column("block")))
    mats = [np.array(table.column("costs")[int(i)].as_py()).reshape(4, 4) for i in order]
    best, forward = np.where(np.arange(4) == START, 0.0, np.inf), []
    for m in mats:
        forward.append(best)
        best = (best[:, None] + m).min(axis=0)
    state, enter, leave = int(np.argmin(best + END_COST)), [], []
    for m, before in zip(reversed(mats), reversed(forward), strict=True):
        leave.append(state)
        state = int(np.argmin(before + m[:, state]))
        enter.append(state)
    return pa.table({"conv": table.column("conv").take(pa.array(order)), "block": table.column("block").take(pa.array(order)),
                     "enter": pa.array(enter[::-1], pa.int32()), "leave": pa.array(leave[::-1], pa.int32())})


def _render(table: pa.Table) -> pa.Table:
    cols, runs = _runs(table)
    out: dict[str, list] = {"role": [], "action": [], "inserted": [], "rendered": []}
    for a, b in runs:
        enter, leave = cols["enter"][a], cols["leave"][a]
        ends = cols["pos"][b - 1] == cols["n"][a] - 1
        ways = repair([role_number(r) for r in cols["role"][a:b]], START if enter is None else enter, None if leave is None else leave)
        for i, (before, to, action, inserted) in zip(range(a, b), ways, strict=True):
            out["role"].append(NAMES[to])
            out["action"].append(action)
            out["inserted"].append(NAMES[inserted])
            out["rendered"].append(_piece(before, to, action, inserted, cols["text"][i] or "", ends and i == b - 1))
    schema = table.schema
    return pa.table({"conv": pa.array(cols["conv"], schema.field("conv").type), "turn": pa.array(cols["turn"], schema.field("turn").type),
                     "pos": pa.array(cols["pos"], pa.int64()), **{c: pa.array(v, pa.string()) for c, v in out.items()}})


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, pos, role, action, inserted, rendered): one row per turn, in the order of ``pos`` from 0.

    ``rendered`` of a conversation's rows, joined in order, is the repaired conversation in ChatML;
    ``role`` is the turn that the row's text ends up in, ``inserted`` the empty turn put before it.
    Turns are ordered by number, then role and text, so ties and repeated rows have a defined place.
    A text's ``<|`` becomes ``< |``, so that no text opens or closes a turn. A null text is an empty one; a null or unknown role must be merged or relabelled; a null
    conversation is a conversation. Role names are compared in lower case. An empty table gives no rows.
    Rows meet in groups of about ``BLOCK``, whatever a conversation's length.
    """
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    placed = materialize(with_row_index(rows, [F.col("turn"), F.col("role"), F.col("text")], ["conv"], "pos")
                         .withColumn("block", F.floor(F.col("pos") / BLOCK)), "turns")
    size = placed.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).select(F.col("conv").alias("_conv"), "n")
    placed = materialize(placed.join(size, F.col("conv").eqNullSafe(F.col("_conv"))).drop("_conv"), "sized")
    parts = max(1, placed.count() // BLOCK)
    dealt = placed.withColumn("part", F.pmod(F.xxhash64("conv", "block"), F.lit(parts)))
    kind, turn_kind = rows.schema["conv"].dataType.simpleString(), rows.schema["turn"].dataType.simpleString()
    long = dealt.filter(F.col("n") > BLOCK)
    matrices = long.select("part", "conv", "pos", "block", "role").groupBy("part").applyInArrow(
        _matrices, f"conv {kind}, block bigint, costs array<double>")
    states = matrices.groupBy("conv").applyInArrow(_states, f"conv {kind}, block bigint, enter int, leave int")
    states = materialize(states.select(F.col("conv").alias("_conv"), F.col("block").alias("_block"), "enter", "leave"), "states")
    ready = dealt.join(states, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block")), "left").drop("_conv", "_block")
    return ready.groupBy("part").applyInArrow(
        _render, f"conv {kind}, turn {turn_kind}, pos bigint, role string, action string, inserted string, rendered string")
