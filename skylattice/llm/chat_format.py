"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant in
turns, ending with the assistant. Each message is given a role and either
starts a turn, with empty turns put in before it where the automaton asks for
them, or is merged into the turn before. Dynamic programming over the states
of the automaton (the role of the last turn) finds the cheapest repair; the
repaired sequence is then rendered.

Conversations are worked on in segments of ``SEGMENT`` messages. Costs of a
segment form a matrix from state to state, so the segments of a long
conversation are worked on by different tasks: their matrices are combined,
and each is then repaired between the states that were found.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, number_rows

ROLES = ("system", "user", "assistant")
#: States: before any turn, then the role of the last turn.
START, SYSTEM, USER, ASSISTANT = range(4)
MERGE, INSERT, RELABEL, NAME = 1, 2, 3, 1
SEGMENT = 10_000
JOINT = "\n"
#: Empty turns to put in so that a turn of a role may follow a state; none where it may never.
FILL = {
    (START, SYSTEM): (), (START, USER): (), (START, ASSISTANT): (USER,),
    (SYSTEM, USER): (), (SYSTEM, ASSISTANT): (USER,),
    (USER, ASSISTANT): (), (USER, USER): (ASSISTANT,),
    (ASSISTANT, USER): (), (ASSISTANT, ASSISTANT): (USER,),
}
#: Empty turns that end a conversation from each state.
CLOSE = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
ENDS = np.array([INSERT * len(CLOSE[s]) for s in range(4)], dtype=float)


def moves(role: str | None) -> list[tuple[int, int, int, bool]]:
    """(from, to, cost, merged) for one message; of equal costs the first is taken."""
    found = []
    for to in (SYSTEM, USER, ASSISTANT):
        name = ROLES[to - 1]
        # a role that is none of the three is named at less than a change of role
        change = 0 if role == name else RELABEL if role in ROLES else NAME
        for state in range(4):
            if (state, to) in FILL:
                found.append((state, to, change + INSERT * len(FILL[state, to]), False))
            if state == to:
                found.append((state, to, change + MERGE, True))
    return found


_MOVES = {r: sorted(moves(r), key=itemgetter(2)) for r in (*ROLES, None)}


def moves_of(role: str | None) -> list[tuple[int, int, int, bool]]:
    return _MOVES[role if role in ROLES else None]


def step_matrix(role: str | None) -> np.ndarray:
    m = np.full((4, 4), np.inf)
    for state, to, cost, _ in moves_of(role):
        m[state, to] = min(m[state, to], cost)
    return m


def segment_matrix(roles: list[str | None]) -> np.ndarray:
    """Least cost from each state before the messages to each one after."""
    total = np.where(np.eye(4, dtype=bool), 0.0, np.inf)
    for role in roles:
        total = (total[:, :, None] + step_matrix(role)[None]).min(axis=1)
    return total


def best_path(roles: list[str | None], entry: int, leave: int) -> list[tuple[int, int, int, bool]]:
    """The cheapest moves from one state to another; ties go to the lower state."""
    costs, picks = [np.inf] * 4, []
    costs[entry] = 0.0
    for role in roles:
        after, pick = [np.inf] * 4, [None] * 4
        for move in moves_of(role):
            state, to, cost, _ = move
            total = costs[state] + cost
            if total < after[to] or (total == after[to] and pick[to] is not None and state < pick[to][0]):
                after[to], pick[to] = total, move
        costs = after
        picks.append(pick)
    path, state = [], leave
    for pick in reversed(picks):
        path.append(pick[state])
        state = pick[state][0]
    return path[::-1]


def chain_states(matrices: list[np.ndarray]) -> list[int]:
    """States at the borders of segments, first to last, at least total cost."""
    reach = [np.where(np.arange(4) == START, 0.0, np.inf)]
    for m in matrices:
        reach.append((reach[-1][:, None] + m).min(axis=0))
    state = int((reach[-1] + ENDS).argmin())
    states = [state]
    for before, m in zip(reach[-2::-1], matrices[::-1]):
        state = int((before + m[:, state]).argmin())
        states.append(state)
    return states[::-1]


def rendered(text: str | None) -> str:
    """Message text; marks of the template in it are parted by a blank."""
    return (text or "").replace("<|", "< |")


def repair(roles: list[str | None], texts: list[str | None], entry: int, leave: int, last: bool) -> dict:
    """One segment, rendered, with what was done to it. A turn that goes on in
    the next segment is closed there."""
    parts, n = [], {"n_turns": 0, "n_merged": 0, "n_relabelled": 0, "n_inserted": 0, "cost": 0}

    def open_turn(state: int, before: int) -> None:
        parts.append(("" if before == START else "<|end|>\n") + f"<|{ROLES[state - 1]}|>\n")
        n["n_turns"] += 1

    for role, text, (state, to, cost, merged) in zip(roles, texts, best_path(roles, entry, leave)):
        n["cost"] += cost
        n["n_relabelled"] += role != ROLES[to - 1]
        n["n_merged"] += merged
        if merged:
            parts.append(JOINT)
        else:
            for empty in (*FILL[state, to], to):
                open_turn(empty, state)
                state = empty
        parts.append(rendered(text))
    if last:
        state = leave
        for empty in CLOSE[leave]:
            open_turn(empty, state)
            state = empty
        n["cost"] += INSERT * len(CLOSE[leave])
        if state != START:
            parts.append("<|end|>\n")
    n["n_inserted"] = n["n_turns"] - (len(roles) - n["n_merged"])
    return n | {"rendered": "".join(parts)}


COUNTS = ("n_turns", "n_merged", "n_relabelled", "n_inserted", "cost")


def _runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows with equal keys, which come one after the other; over batches too."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            batch = batch.astype(object).where(batch.notna(), None)
            yield from zip(*[batch[c] for c in batch.columns])

    yield from ((k, list(g)) for k, g in groupby(rows(), key=itemgetter(*range(len(keys)))))


def format_chats(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment: int = SEGMENT) -> DataFrame:
    """One row per conversation and segment: ``rendered`` and what was done
    (``n_messages``, ``n_turns``, ``n_merged``, ``n_relabelled``,
    ``n_inserted``, ``cost``).

    Messages are in the order of turn (null first), role and text; repeated
    rows stay. A null text is an empty message, a role that is null or none of
    the three gets the cheapest one. Rows with a null conversation make one
    conversation. A conversation of more than ``segment`` messages has several
    rows, whose texts joined in order are the whole. Other columns are not
    used; an empty table gives no rows.
    """
    kind = df.schema[conversation].dataType.simpleString()
    rows = df.select(F.col(conversation).alias("c"), F.col(turn).alias("t"), F.col(role).cast("string").alias("role"), F.col(text).alias("text"))
    sizes = rows.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    long = cut(sizes.where(F.col("n") > segment).withColumnRenamed("c", "lc"))
    match = F.col("c").eqNullSafe(F.col("lc"))
    schema = f"c {kind}, segment long, n_messages long, " + ", ".join(f"{k} long" for k in COUNTS) + ", rendered string"
    names = ["c", "segment", "n_messages", *COUNTS, "rendered"]

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        for (_, c), group in _runs(batches, ["absent", "c"]):
            roles, texts = [g[2] for g in group], [g[3] for g in group]
            entry, leave = chain_states([segment_matrix(roles)])
            done = repair(roles, texts, entry, leave, True)
            out.append((c, 0, len(group), *[done[k] for k in COUNTS], done["rendered"]))
            if len(out) >= 1000:
                yield pd.DataFrame(out, columns=names)
                out = []
        if out:
            yield pd.DataFrame(out, columns=names)

    short = rows.join(long, match, "left_anti").repartition("c").sortWithinPartitions("c", "t", "role", "text")
    short = short.select(F.col("c").isNull().alias("absent"), "c", "role", "text").mapInPandas(whole, schema)
    # messages of long conversations are numbered, and cut at equal lengths
    many = rows.join(long.select("lc"), match, "left_semi")
    numbered = number_rows(many, [F.col("c"), F.col("t"), F.col("role"), F.col("text")], "at")
    firsts = numbered.groupBy("c").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).withColumnRenamed("c", "fc")
    placed = numbered.join(firsts, F.col("c").eqNullSafe(F.col("fc"))).withColumn("at", F.col("at") - F.col("first"))
    placed = placed.withColumns({"segment": F.floor(F.col("at") / segment), "final": F.floor((F.col("n") - 1) / segment)})
    placed = cut(placed.select("c", "segment", "final", "at", "role", "text"))

    def matrices(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("at")
        m = segment_matrix([r if isinstance(r, str) else None for r in group["role"]])
        return pd.DataFrame({"c": group["c"][:1], "segment": group["segment"][:1], "m": [m.ravel().tolist()]})

    def borders(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("segment")
        states = chain_states([np.array(m, dtype=float).reshape(4, 4) for m in group["m"]])
        return pd.DataFrame({"c": group["c"], "segment": group["segment"], "entry": states[:-1], "leave": states[1:]})

    costs = placed.select("c", "segment", "at", "role").groupBy("c", "segment").applyInPandas(matrices, f"c {kind}, segment long, m array<double>")
    # one row per segment of a conversation
    states = cut(costs.groupBy("c").applyInPandas(borders, f"c {kind}, segment long, entry int, leave int"))
    states = states.withColumnsRenamed({"c": "sc", "segment": "ss"})

    def piece(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("at")
        head = group.iloc[0]
        roles, texts = ([v if isinstance(v, str) else None for v in group[k]] for k in ("role", "text"))
        done = repair(roles, texts, int(head["entry"]), int(head["leave"]), head["segment"] == head["final"])
        return pd.DataFrame([(head["c"], head["segment"], len(group), *[done[k] for k in COUNTS], done["rendered"])], columns=names)

    joined = placed.join(states, F.col("c").eqNullSafe(F.col("sc")) & (F.col("segment") == F.col("ss"))).drop("sc", "ss")
    pieces = joined.groupBy("c", "segment").applyInPandas(piece, schema)
    return short.unionByName(pieces).withColumnRenamed("c", conversation)
