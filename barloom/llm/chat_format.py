"""Chat formatting: minimum-cost repair of turn roles, and rendering of the repaired sequence.

A legal conversation is an optional system turn, then user and assistant in turn, ending with the
assistant. Every given turn opens a turn of the repaired sequence, under its own role or another
one, or is merged into the turn before; empty turns can be inserted anywhere. Each deviation has a
cost, and dynamic programming over the automaton of legal sequences finds a cheapest repair.

Turns are sorted by conversation across the cluster. The effect of any stretch of turns on the
automaton is a small min-plus matrix, so a conversation that lies in several partitions is stitched
together: each partition sums up its first and last conversation in one pass, a scan over those two
rows a partition fixes the state at every boundary, and a second pass repairs each stretch between
its fixed ends. No conversation has to fit in one task, and none is rendered into one string: the
result has a piece of text for each turn, to be joined in order.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import shuffle_partitions
from barloom.session import shared_folder

#: States are the role of the last turn; 0 is the beginning.
ROLES = ("", "system", "user", "assistant")
SYSTEM, USER, ASSISTANT = 1, 2, 3
LEGAL = ((0, SYSTEM), (0, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))
END = ASSISTANT
#: Other names of the roles.
ALIASES = {"human": USER, "ai": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT, "gpt": ASSISTANT}
NEVER = 1 << 40
#: Turns that are repaired together, about.
PART_TURNS = 50_000


@dataclass(frozen=True)
class Settings:
    merge: int = 1
    insert: int = 2
    relabel: int = 3
    open_turn: str = "<|im_start|>{role}\n"
    close_turn: str = "<|im_end|>\n"
    joint: str = "\n"


SETTINGS = Settings()


def role_number(role: str | None) -> int:
    """1 to 3, or 0 for a role that isn't known."""
    name = (role or "").strip().lower()
    return ROLES.index(name) if name in ROLES else ALIASES.get(name, 0)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product: cheapest cost over all states between."""
    return (a[..., :, :, None] + b[..., None, :, :]).min(axis=-2)


def insertions(settings: Settings) -> tuple[np.ndarray, list[list[list[int]]]]:
    """Cost and roles of the empty turns that lead from one state to another."""
    cost = np.full((4, 4), NEVER)
    path: list[list[list[int]]] = [[[] for _ in range(4)] for _ in range(4)]
    for start in range(4):
        cost[start, start], at = 0, [start]
        while at:
            s = at.pop(0)
            for a, b in LEGAL:
                if a == s and cost[start, s] + settings.insert < cost[start, b]:
                    cost[start, b] = cost[start, s] + settings.insert
                    path[start][b] = [*path[start][s], b]
                    at.append(b)
    return cost, path


class Automaton:
    """Cost of one given turn of each role from state to state, and what is done at that cost.

    `via` has the state that insertions lead to first; the turn is merged if it stays there, and
    else opens a turn. Of equally cheap ways the one with fewest insertions is taken, then merging.
    """

    def __init__(self, settings: Settings) -> None:
        self.inserted, self.path = insertions(settings)
        self.cost = np.full((4, 4, 4), NEVER)  # role, from, to
        self.via = np.zeros((4, 4, 4), np.int8)
        for role in range(4):
            for start in range(4):
                ways = []
                for mid in range(4):
                    before = int(self.inserted[start, mid])
                    wrong = [settings.relabel * (role != r) for r in range(4)]
                    if mid:
                        ways.append((before + settings.merge + wrong[mid], before, 0, mid, mid))
                    ways += [(before + wrong[b], before, 1, mid, b) for a, b in LEGAL if a == mid]
                for total, _, _, mid, to in sorted(ways, reverse=True):
                    if total < NEVER and total <= self.cost[role, start, to]:
                        self.cost[role, start, to] = total
                        self.via[role, start, to] = mid
        self.end = self.inserted[:, END]

    def span(self, roles: np.ndarray) -> np.ndarray:
        """The matrix of a stretch of turns, by pairwise products."""
        m = self.cost[roles]
        while len(m) > 1:
            odd = m[-1:] if len(m) % 2 else m[:0]
            m = np.concatenate((product(m[:len(m) // 2 * 2:2], m[1::2]), odd))
            m = np.minimum(m, NEVER)
        return m[0]

    def repair(
        self, roles: np.ndarray, starts: np.ndarray, entry: np.ndarray, leave: np.ndarray,
    ) -> tuple[np.ndarray, np.ndarray]:
        """State before and after each turn of many stretches, all advanced in step.

        `entry` is the state each stretch begins in; `leave` the one it ends in, -1 for whichever is
        cheapest with what has to be inserted at the end.
        """
        n = np.diff(starts)
        order = np.argsort(-n, kind="stable")
        longest = n[order]
        value = np.full((len(n), 4), NEVER)
        value[np.arange(len(n)), entry[order]] = 0
        came = np.zeros((len(roles), 4), np.int8)
        for t in range(int(longest[0]) if len(n) else 0):
            live = int(np.searchsorted(-longest, -t, side="left"))
            at = starts[order[:live]] + t
            total = value[:live, :, None] + self.cost[roles[at]]
            came[at] = total.argmin(axis=1)
            value[:live] = np.minimum(total.min(axis=1), NEVER)
        value += self.end
        last = np.where(leave[order] >= 0, leave[order], value.argmin(axis=1))
        before, after = np.empty(len(roles), np.int8), np.empty(len(roles), np.int8)
        state = last.astype(np.int64)
        for t in range(int(longest[0]) - 1 if len(n) else -1, -1, -1):
            live = int(np.searchsorted(-longest, -t, side="left"))
            at = starts[order[:live]] + t
            after[at] = state[:live]
            state[:live] = came[at, state[:live]]
            before[at] = state[:live]
        return before, after


OUTPUT = ("conv_id string, position long, turn long, role string, new_role string, action string, "
          "inserted int, cost long, piece string")


def _runs(ids: list) -> np.ndarray:
    """Where each run of equal ids begins, and the end."""
    change = [i for i in range(1, len(ids)) if ids[i] != ids[i - 1]]
    return np.array([0, *change, len(ids)] if ids else [0])


def _ends(settings: Settings):
    """Pass 1: a partition's first and last conversation, as (part, place, conv, turns, matrix)."""
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, part, ends = Automaton(settings), 0, []

        def add(conv: str | None, roles: np.ndarray) -> None:
            matrix = automaton.span(roles)
            if ends and ends[-1][0] == conv:
                grown = np.minimum(product(ends[-1][2], matrix), NEVER)
                ends[-1] = (conv, ends[-1][1] + len(roles), grown)
            else:
                ends[1:] = [(conv, len(roles), matrix)] if ends else []
                if not ends:
                    ends.append((conv, len(roles), matrix))

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            ids = batch.column("conv_id").to_pylist()
            roles = np.array([role_number(r) for r in batch.column("role").to_pylist()])
            at = _runs(ids)
            for i in sorted({0, len(at) - 2}):
                add(ids[at[i]], roles[at[i]:at[i + 1]])
        rows = [(part, i, *end) for i, end in enumerate(ends)]
        yield pa.RecordBatch.from_pylist(
            [{"part": p, "place": i, "conv": c, "turns": n, "matrix": m.tobytes()}
             for p, i, c, n, m in rows],
            pa.schema([("part", pa.int32()), ("place", pa.int32()), ("conv", pa.string()),
                       ("turns", pa.int64()), ("matrix", pa.binary())]))

    return task


@dataclass(frozen=True)
class Stretch:
    """What a partition must know of a conversation that goes on beyond it."""

    entry: int
    leave: int  # -1: it ends here
    position: int
    cost: int


def stitched(rows: list[tuple], settings: Settings) -> dict[tuple[int, int], Stretch]:
    """Fixed states for the conversations that lie in several partitions, by (part, place).

    `rows` are pass 1's, two a partition at most: a prefix scan forward gives the costs at every
    boundary, one backward the states of a cheapest repair.
    """
    automaton = Automaton(settings)
    rows = sorted(rows, key=lambda r: r[:2])
    chains: list[list[tuple]] = []
    for row in rows:
        # A conversation goes on where the partition before ends with it.
        if chains and chains[-1][-1][2] == row[2] and chains[-1][-1][0] != row[0]:
            chains[-1].append(row)
        else:
            chains.append([row])
    out = {}
    for chain in chains:
        if len(chain) == 1:
            continue
        matrices = [np.frombuffer(r[4], np.int64).reshape(4, 4) for r in chain]
        value = [np.array([0, NEVER, NEVER, NEVER])]
        for m in matrices:
            value.append(np.minimum((value[-1][:, None] + m).min(axis=0), NEVER))
        state = int((value[-1] + automaton.end).argmin())
        total = int((value[-1] + automaton.end).min())
        position = sum(r[3] for r in chain)
        for i in range(len(chain) - 1, -1, -1):
            entry = int((value[i] + matrices[i][:, state]).argmin())
            position -= chain[i][3]
            leave = state if i < len(chain) - 1 else -1
            # The state at the end is the cheapest one either way; it is fixed for agreement.
            out[chain[i][:2]] = Stretch(entry, leave, position, total)
            state = entry
    return out


def _render(settings: Settings, known: dict[tuple[int, int], Stretch]):
    """Pass 2: the repaired turns of a partition."""
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        automaton, table = Automaton(settings), pa.Table.from_batches(held)
        part = table.column("part")[0].as_py()
        ids = table.column("conv_id").to_pylist()
        given = table.column("role").to_pylist()
        texts = table.column("text").to_pylist()
        turns = table.column("turn").to_pylist()
        roles = np.array([role_number(r) for r in given])
        starts = _runs(ids)
        n = len(starts) - 1
        spans = [Stretch(0, -1, 0, -1)] * n
        for place, i in ((0, 0), (1, n - 1)):
            if i >= place:
                spans[i] = known.get((part, place), spans[i])
        entry = np.array([s.entry for s in spans])
        leave = np.array([s.leave for s in spans])
        before, after = automaton.repair(roles, starts, entry, leave)
        cost = automaton.cost[roles, before, after]

        columns: dict[str, list] = {name.split()[0]: [] for name in OUTPUT.split(", ")}
        empty = {r: settings.open_turn.format(role=ROLES[r]) + settings.close_turn for r in (1, 2, 3)}
        for c in range(n):
            a, b = int(starts[c]), int(starts[c + 1])
            span = spans[c]
            total = span.cost if span.cost >= 0 else int(
                cost[a:b].sum() + (automaton.end[after[b - 1]]))
            for i in range(a, b):
                s, t, role = int(before[i]), int(after[i]), int(roles[i])
                mid = int(automaton.via[role, s, t])
                added = automaton.path[s][mid]
                merged = mid == t
                piece = "" if merged and not added else settings.close_turn if s else ""
                if added:
                    # The last of them stays open for a turn that is merged into it.
                    piece += "".join(empty[r] for r in added)
                    if merged:
                        piece = piece[:-len(settings.close_turn)]
                if merged:
                    piece += settings.joint if not added else ""
                else:
                    piece += settings.open_turn.format(role=ROLES[t])
                piece += texts[i] or ""
                n_added = len(added)
                if span.leave < 0 and i == b - 1:
                    tail = automaton.path[t][END]
                    piece += settings.close_turn + "".join(empty[r] for r in tail)
                    n_added += len(tail)
                action = ("merge" if merged else "keep") if role == t else (
                    "merge and relabel" if merged else "relabel")
                row = (ids[i], span.position + i - a, turns[i], given[i], ROLES[t], action, n_added,
                       total, piece)
                for column, value in zip(columns.values(), row, strict=True):
                    column.append(value)
        arrays = {
            name: pa.array(values, {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind])
            for (name, kind), values in zip(
                (f.split() for f in OUTPUT.split(", ")), columns.values(), strict=True)}
        yield pa.RecordBatch.from_pydict(arrays)

    return task


def format_chats(conversations: DataFrame, settings: Settings = SETTINGS) -> DataFrame:
    """One row for each row of `conversations` (conv_id, turn, role, text), in any order.

    position is the turn's place in its conversation, by turn, role and text (null turns first);
    new_role the role of the repaired turn it is in; action keep, relabel, merge or merge and
    relabel; inserted the empty turns that come with it; cost the conversation's whole cost; piece
    the text it adds. The pieces of a conversation, joined by position, are the rendered repaired
    sequence. Null conv_ids are one conversation; null texts are empty; null and unknown roles have
    to be relabelled. Rows alike in everything follow each other. An empty table gives an empty
    result; other columns are left out.
    """
    spark = conversations.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    kind = conversations.schema["conv_id"].dataType
    rows = conversations.select(
        F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    parts = max(shuffle_partitions(spark), -(-rows.count() // PART_TURNS))
    order = ["conv_id", "turn", "role", F.xxhash64("text"), "tie"]
    placed = (
        rows.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("tie")
        .withColumn("part", F.spark_partition_id())
        # Both passes must see the same partitions, also after an executor is lost.
        .checkpoint()
    )
    ends = placed.select("part", "conv_id", "role").mapInArrow(
        _ends(settings), "part int, place int, conv string, turns long, matrix binary")
    known = stitched([tuple(r) for r in ends.collect()], settings)  # two rows a partition
    repaired = placed.mapInArrow(_render(settings, known), OUTPUT)
    return repaired.withColumn("conv_id", F.col("conv_id").cast(kind))
