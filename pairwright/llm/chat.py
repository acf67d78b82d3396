"""Chat formatting with minimum-cost role repair.

A legal conversation is a path of an automaton: perhaps one system message, then user
and assistant in turn, the assistant last. Each given turn may open a message in
its own role, open one in another role (relabel), or go on the message before
(merge); empty messages may be inserted anywhere. Dynamic programming finds the
choices of least total cost.

Turns of a conversation are cut into pieces of bounded size. The costs of a piece
from each state to each state are a small matrix, and matrices add up along a
conversation, so that even one that holds most turns of a table is repaired in
parallel: first the matrices, then the states between pieces, then the turns.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

ROLES = ["start", "system", "user", "assistant"]  # states: role of the last message
NEXT = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
ALIASES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
PIECE_BITS = 12  # turns of one piece lie within 4,096 turn numbers
PIECE_ROWS = 1 << PIECE_BITS
FAR = 1 << 40
LAST = 1 << 62  # stands for a null turn number


@dataclass(frozen=True)
class Costs:
    merge: int = 2
    relabel: int = 3
    insert: int = 3


@dataclass(frozen=True)
class Template:
    """How messages are written; ``broken`` stands for ``mark`` where a text holds it."""

    head: str = "<|im_start|>{role}\n"
    tail: str = "<|im_end|>\n"
    between: str = "\n\n"  # texts merged into one message
    mark: str = "<|im_"
    broken: str = "<| im_"


@dataclass(frozen=True)
class Step:
    cost: int
    action: str
    inserted: tuple[int, ...]  # roles of the empty messages before the turn


def insertions(q: int) -> dict[int, tuple[int, ...]]:
    """The shortest run of empty messages from state q to each state it can reach."""
    found: dict[int, tuple[int, ...]] = {q: ()}
    todo = deque([q])
    while todo:
        at = todo.popleft()
        for role in NEXT[at]:
            if role not in found:
                found[role] = (*found[at], role)
                todo.append(role)
    return found


def steps(costs: Costs) -> dict[tuple[int, int, int], Step]:
    """The best step for (given role, state before, state after); role 0 is unknown."""
    table: dict[tuple[int, int, int], Step] = {}
    for role in range(4):
        for q in range(4):
            choices = []
            if q:  # go on the message before
                other = role != q
                choices.append((q, Step(costs.merge + costs.relabel * other, "relabel+merge" if other else "merge", ())))
            for p, between in insertions(q).items():
                for new in NEXT[p]:
                    other = role != new
                    choices.append((new, Step(costs.insert * len(between) + costs.relabel * other,
                                              "relabel" if other else "keep", between)))
            for new, step in choices:
                old = table.get((role, q, new))
                if old is None or (step.cost, len(step.inserted)) < (old.cost, len(old.inserted)):
                    table[role, q, new] = step
    return table


def ending(costs: Costs) -> list[tuple[int, tuple[int, ...]]]:
    """Cost and empty messages that end a conversation in each state; none is needed at the start."""
    return [(0, ())] + [(costs.insert * len(insertions(q)[3]), insertions(q)[3]) for q in (1, 2, 3)]


class Repair:
    def __init__(self, costs: Costs):
        self.table = steps(costs)
        self.end = ending(costs)
        self.matrices = np.full((4, 4, 4), FAR, np.int64)
        for (role, q, new), step in self.table.items():
            self.matrices[role, q, new] = step.cost

    def matrix(self, roles: list[int]) -> np.ndarray:
        """Least costs of a piece from each state to each state."""
        total = np.where(np.eye(4, dtype=bool), 0, FAR)
        for role in roles:
            total = np.minimum((total[:, :, None] + self.matrices[role][None]).min(1), FAR)
        return total

    def borders(self, matrices: list[np.ndarray]) -> list[tuple[int, int]]:
        """States before and after each piece on a cheapest way; ties go to the smaller state."""
        onward = [np.array([c for c, _ in self.end])]
        for m in reversed(matrices):
            onward.append((m + onward[-1][None]).min(1))
        state, out = 0, []
        for m, rest in zip(matrices, reversed(onward[:-1])):
            after = int((m[state] + rest).argmin())
            out.append((state, after))
            state = after
        return out

    def path(self, roles: list[int], first: int, last: int) -> list[tuple[int, Step]]:
        """States and steps of a piece between given states."""
        onward = [np.where(np.arange(4) == last, 0, FAR)]
        for role in reversed(roles):
            onward.append((self.matrices[role] + onward[-1][None]).min(1))
        state, out = first, []
        for role, rest in zip(roles, reversed(onward[:-1])):
            after = int((self.matrices[role][state] + rest).argmin())
            out.append((after, self.table[role, state, after]))
            state = after
        return out


def role_code(role: str | None) -> int:
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return ROLES.index(name) if name in ROLES[1:] else 0


def runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[dict[str, list]]:
    """Columns of neighbouring rows with equal keys, across the borders of batches."""
    held: dict[str, list] = {}
    known = None
    for batch in batches:
        columns = {c: batch[c].tolist() for c in batch.columns}
        tuples = list(zip(*(columns[k] for k in keys)))
        edges = [i for i in range(1, len(tuples)) if tuples[i] != tuples[i - 1]]
        for a, b in zip([0, *edges], [*edges, len(tuples)]):
            if a == b:
                continue
            part = {c: values[a:b] for c, values in columns.items()}
            if tuples[a] == known:
                for c, values in part.items():
                    held[c] += values
                continue
            if known is not None:
                yield held
            held, known = part, tuples[a]
    if known is not None:
        yield held


PIECE = ["cid", "bucket", "part"]
ORDER = ["turn_order", "content", "salt"]


def piece_matrices(costs: Costs):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        repair, out = Repair(costs), []
        for piece in runs(batches, PIECE):
            matrix = repair.matrix([role_code(r) for r in piece["role"]])
            out.append((*(piece[k][0] for k in PIECE), matrix.ravel().tolist()))
            if len(out) >= 2048:
                yield pd.DataFrame(out, columns=[*PIECE, "matrix"])
                out = []
        yield pd.DataFrame(out, columns=[*PIECE, "matrix"])

    return run


def piece_borders(costs: Costs):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        repair, out = Repair(costs), []
        for whole in runs(batches, ["cid"]):
            states = repair.borders([np.array(m, np.int64).reshape(4, 4) for m in whole["matrix"]])
            last = len(states) - 1
            for i, (key, (a, b)) in enumerate(zip(zip(*(whole[k] for k in PIECE)), states)):
                out.append((*key, a, b, i == last))
            if len(out) >= 2048:
                yield pd.DataFrame(out, columns=[*PIECE, "first", "last", "ends"])
                out = []
        yield pd.DataFrame(out, columns=[*PIECE, "first", "last", "ends"])

    return run


def render_pieces(costs: Costs, template: Template, columns: list[str]):
    head = {i: template.head.format(role=r) for i, r in enumerate(ROLES)}

    def empty(roles: tuple[int, ...]) -> str:
        return "".join(head[r] + template.tail for r in roles)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        repair, out = Repair(costs), []
        for piece in runs(batches, PIECE):
            # the border sorts before the turns
            state, last, ends = int(piece["first"][0]), int(piece["last"][0]), piece["ends"][0]
            turns = {c: piece[c][1:] for c in ("cid", "turn_order", "role", "text")}
            roles = [role_code(r) for r in turns["role"]]
            steps_ = repair.path(roles, state, last)
            rows = zip(*turns.values(), steps_)
            for i, (conv, turn, role, text, (after, step)) in enumerate(rows):
                text = (text or "").replace(template.mark, template.broken)
                if "merge" in step.action:
                    segment = template.between + text
                else:  # the message before is closed only here, as turns may go on it until then
                    segment = template.tail * (state > 0) + empty(step.inserted) + head[after] + text
                closing: tuple[int, ...] = ()
                if ends and i == len(roles) - 1:
                    closing = repair.end[after][1]
                    segment += template.tail + empty(closing)
                cost = step.cost + costs.insert * len(closing)
                out.append((conv, turn, role, ROLES[after], step.action, len(step.inserted), len(closing), cost, segment))
                state = after
            if len(out) >= 2048:
                yield pd.DataFrame(out, columns=columns)
                out = []
        yield pd.DataFrame(out, columns=columns)

    return run


def format_chats(
    turns: DataFrame, costs: Costs = Costs(), template: Template = Template(),
    conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """One row per given turn: conv_id, turn, role, new_role, action, inserted_before,
    inserted_after, cost and segment.

    The segments of a conversation, put together in the order of its turns, are the
    rendered conversation; costs add up to its least repair cost. Turns go by
    number, null ones last; equal numbers by a digest of role and text, and rows
    equal in all of these are turns of their own that read alike. Roles are compared
    without case and by ALIASES; null and other names are unknown and cost a
    relabel. A null text is empty. Rows with a null conv_id are one conversation.
    Other columns are not looked at. An empty table gives an empty result.
    """
    kinds = dict(turns.dtypes)
    number = F.coalesce(F.col(turn).cast("long"), F.lit(LAST))
    rows = turns.select(
        F.concat(F.when(F.col(conv_id).isNull(), "n").otherwise("v"),
                 F.coalesce(F.col(conv_id).cast("string"), F.lit(""))).alias("cid"),
        F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"), number.alias("turn_order"),
        F.xxhash64(F.col(role), F.col(text)).alias("content"),
        F.shiftright(number, PIECE_BITS).alias("bucket"), F.monotonically_increasing_id().alias("rid"),
    )
    rows = stage(rows.withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(1 << 16))).drop("rid"), "turns")
    # only repeated turn numbers can make a bucket larger than a piece
    large = stage(
        rows.groupBy("cid", "bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > PIECE_ROWS), "large"
    )
    if large.isEmpty():
        rows = rows.withColumn("part", F.lit("").cast("string"))
    else:  # then pieces are cut within a number, by the further keys of the order
        within = F.concat(
            F.lpad(F.hex(F.col("turn_order")), 16, "0"),
            F.substring(F.lpad(F.hex(F.col("content").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"), 1, 4),
            F.lpad(F.hex(F.shiftright("salt", 10)), 2, "0"),
        )
        rows = rows.join(large, ["cid", "bucket"], "left").withColumn(
            "part", F.when(F.col("n").isNull(), "").otherwise(within)).drop("n")
        rows = stage(rows, "cut_turns")

    together = [F.col(c) for c in PIECE]
    piece_schema = "cid string, bucket long, part string, matrix array<long>"
    matrices = stage(
        rows.select(*PIECE, *ORDER, "role").repartition(*together).sortWithinPartitions(*PIECE, *ORDER)
        .mapInPandas(piece_matrices(costs), piece_schema),
        "matrices",
    )
    borders = matrices.repartition("cid").sortWithinPartitions(*PIECE).mapInPandas(
        piece_borders(costs), "cid string, bucket long, part string, first int, last int, ends boolean"
    )
    both = rows.withColumn("kind", F.lit(1)).unionByName(
        borders.withColumn("kind", F.lit(0)).withColumn("turn_order", F.lit(-1).cast("long")), allowMissingColumns=True
    )
    names = ["cid", "turn_order", "role", "new_role", "action", "inserted_before", "inserted_after", "cost", "segment"]
    schema = (
        "cid string, turn_order long, role string, new_role string, action string, "
        "inserted_before int, inserted_after int, cost long, segment string"
    )
    done = both.repartition(*together).sortWithinPartitions(*PIECE, "kind", *ORDER).mapInPandas(
        render_pieces(costs, template, names), schema
    )
    # ids travel as text and numbers without nulls: pandas would make floats of them
    return done.select(
        F.when(F.col("cid").startswith("v"), F.expr("substring(cid, 2)").cast(kinds[conv_id])).alias("conv_id"),
        F.when(F.col("turn_order") != LAST, F.col("turn_order")).cast(kinds[turn]).alias("turn"),
        *names[2:],
    )
