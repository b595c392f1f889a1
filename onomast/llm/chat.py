"""Roles and turns of transcripts by a hidden Markov model, and their canonical form.

The states are a speaker's first line and his further lines, for each role. A line is seen through its speaker marker,
its length, its last mark and whether it begins a row of the table. Counts of labelled rows give the emissions of the
latter features and the transitions; markers are a fixed table. Viterbi's recursion is a product of max-plus matrices, so
a conversation of any length is cut into ranges: each range is first reduced to one matrix, the matrices of a
conversation are chained, and each range is then decoded between its known ends.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import stage
from .common import ship

ship(__name__)

# The roles that every model has, and the words that mark them.
ROLES = ("system", "user", "assistant")
SPEAKERS = {
    "system": "system sys instructions context developer",
    "user": "user human customer client question q prompter visitor you me",
    "assistant": "assistant ai bot agent answer a model support helper chatbot gpt response",
}
MARKER = re.compile(
    r"^\s*(?:<\|(?:im_start\|>)?\s*([a-z]+)\s*(?:\|>)?|\[\s*([a-z]+)\s*\]|#{2,}\s*([a-z]+)\s*:?(?=\s|$)|\**([a-z]+)\**\s*(?:\([^)]{0,40}\))?\s*[:>]\**(?=\s|$))", re.I
)
ENDING = re.compile(r"<\|(?:im_end|endoftext|eot_id)\|>\s*$")
WORDS = {word: role for role, words in SPEAKERS.items() for word in words.split()}
SHAPES = 36
#: Characters of a range, which one task decodes; a longer row is a range by itself.
RANGE_CHARS = 16 << 20
#: How much likelier a state is to show its own marker than another's; a marker begins a turn.
MARKED, OTHER = -0.05, -9.0


def markers_of(roles: tuple[str, ...]) -> dict[str, int]:
    """Number of the role that a marker's word names: the fixed words, and the names of all other roles."""
    return {role.lower(): i for i, role in enumerate(roles)} | {word: roles.index(role) for word, role in WORDS.items()}


def marked_role(line: str, markers: dict[str, int] | None = None) -> tuple[int | None, str]:
    """Number of the role that a line's marker names, and the line without the marker."""
    found = MARKER.match(line)
    if found:
        role = (MARKERS if markers is None else markers).get(next(g for g in found.groups() if g).lower())
        if role is not None:
            return role, line[found.end() :].lstrip()
    return None, line


MARKERS = markers_of(ROLES)


def shape(line: str) -> int:
    """Length class, question, and list or code of a line, as one number below 36."""
    size = min(5, len(line).bit_length() // 2)
    last = line.rstrip()[-1:]
    return size * 6 + (2 if last == "?" else 1 if last in ".!:" else 0) * 2 + int(bool(re.match(r"\s*(?:[-*+]\s|\d+[.)]\s|```)", line)))


def row_size(text: str) -> int:
    return min(5, len(text).bit_length() // 2)


class Speakers:
    """Log probabilities of the model; ``sizes`` and ``shapes`` are counts of rows and lines, ``steps`` of roles that follow each other."""

    def __init__(self, sizes: np.ndarray, shapes: np.ndarray, steps: np.ndarray, first: np.ndarray, roles: tuple[str, ...] = ROLES):
        self.roles, self.states, self.markers = roles, 2 * len(roles), markers_of(roles)
        norm = lambda x: np.log((x + 0.5) / (x + 0.5).sum(axis=-1, keepdims=True))
        self.sizes, self.shapes, self.steps, self.first = norm(sizes), norm(shapes), norm(steps), norm(first)

    def moves(self, begins_row: bool) -> np.ndarray:
        """Log probabilities from state to state: 2r is the first line of a turn of role r, 2r + 1 a further line of it."""
        out = np.full((self.states, self.states), -np.inf)
        turn, stay = (0.0, -np.inf) if begins_row else (-4.6, -0.01)
        for r in range(len(self.roles)):
            for s in range(len(self.roles)):
                out[2 * r : 2 * r + 2, 2 * s] = turn + self.steps[r, s]
            out[2 * r : 2 * r + 2, 2 * r + 1] = stay
        return out

    def seen(self, line: str, text: str, begins_row: bool) -> np.ndarray:
        """Log probabilities of a line in each state; a row's length counts once, with its first line."""
        role, rest = marked_role(line, self.markers)
        out = np.repeat(self.shapes[:, shape(rest)], 2)
        if begins_row:
            out = out + np.repeat(self.sizes[:, row_size(text)], 2)
        if role is not None:
            out = out + OTHER
            out[2 * role] += MARKED - OTHER + 4.6
        return out

    def lines(self, text: str) -> list[tuple[str, np.ndarray]]:
        """Lines of a row and the matrix with which each of them moves the scores."""
        parts = text.split("\n")
        return [(line, self.moves(i == 0) + self.seen(line, text, i == 0)[None, :]) for i, line in enumerate(parts)]


def chained(matrices: list[np.ndarray]) -> np.ndarray:
    out = matrices[0]
    for m in matrices[1:]:
        out = (out[:, :, None] + m[None, :, :]).max(axis=1)
    return out


def opening(model: Speakers, matrix: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Matrix of the first line of a conversation: whatever stood before, the first turn's role has its own probability."""
    out = np.full_like(matrix, -np.inf)
    out[:, 0::2] = (model.first + seen[0::2])[None, :]
    return out


def row_matrices(model: Speakers, text: str, opens: bool) -> list[np.ndarray]:
    found = model.lines(text)
    matrices = [m for _, m in found]
    if opens:
        matrices[0] = opening(model, matrices[0], model.seen(found[0][0], text, True))
    return matrices


def decode(matrices: list[np.ndarray], entry: np.ndarray, last: int | None) -> list[int]:
    """States of the lines on the best path from the scores ``entry`` to the state ``last``, or to the best one; ties go to the lower state."""
    scores, back = entry, []
    for m in matrices:
        reached = scores[:, None] + m
        back.append(reached.argmax(axis=0))
        scores = reached.max(axis=0)
    path = [int(scores.argmax()) if last is None else last]
    for choice in reversed(back[1:]):
        path.append(int(choice[path[-1]]))
    return path[::-1]


def learn(rows: DataFrame) -> Speakers:
    """The model from all rows (conv, turn, role, text) with a role, by sums of counts. Its roles are ``ROLES`` and all others in the table."""
    known = rows.where("trim(role) <> ''")
    found = sorted(r["role"] for r in known.select("role").distinct().collect())
    roles = (*ROLES, *[r for r in found if r not in ROLES])
    numbers, markers = {role: i for i, role in enumerate(roles)}, markers_of(roles)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[str, int, int], int] = {}
        for batch in batches:
            for role, text in zip(batch["role"], batch["text"]):
                r, text = numbers[role], text or ""
                for kind, value in [("size", row_size(text)), *[("shape", shape(marked_role(x, markers)[1])) for x in text.split("\n")]]:
                    sums[kind, r, value] = sums.get((kind, r, value), 0) + 1
        yield pd.DataFrame([(k, r, v, n) for (k, r, v), n in sums.items()], columns=["kind", "role", "value", "n"])

    counts = known.select("role", "text").mapInPandas(count, "kind string, role int, value int, n long")
    # A row is followed by the next turn's row, found by its number: no conversation is gathered for it.
    here = known.where("conv is not null").select("conv", "turn", "role")
    after = here.select("conv", (F.col("turn") - 1).alias("turn"), F.col("role").alias("next"))
    number = lambda c: F.array_position(F.array(*[F.lit(r) for r in roles]), F.col(c)).cast("int") - 1
    once = here.groupBy("conv", "turn").agg(F.min("role").alias("role")).join(after.groupBy("conv", "turn").agg(F.min("next").alias("next")), ["conv", "turn"])
    steps = once.groupBy(F.lit("step").alias("kind"), number("role").alias("role"), number("next").alias("value")).agg(F.count("*").alias("n"))
    first = here.groupBy("conv").agg(F.min_by("role", F.struct("turn", "role")).alias("role"))
    first = first.groupBy(F.lit("first").alias("kind"), F.lit(0).alias("role"), number("role").alias("value")).agg(F.count("*").alias("n"))
    sums = counts.unionByName(steps).unionByName(first).groupBy("kind", "role", "value").agg(F.sum("n").alias("n")).collect()
    sizes, shapes = np.zeros((len(roles), 6)), np.zeros((len(roles), SHAPES))
    following, opened = np.zeros((len(roles), len(roles))), np.zeros(len(roles))
    for kind, role, value, n in sums:
        if kind == "first":
            opened[value] = n
        else:
            {"size": sizes, "shape": shapes, "step": following}[kind][role, value] = n
    return Speakers(sizes, shapes, following, opened, roles)


def recover_turns(rows: DataFrame, model: Speakers, conv: str = "conv_id", turn: str = "turn", text: str = "text", carried: list[str] | None = None) -> DataFrame:
    """Each row with the role of every turn found in it and the rows' canonical text.

    Columns: conv, turn, the ``carried`` ones, ``role`` (of the row's first line), ``n_turns`` (that begin in the row) and
    ``rendered``: each turn as ``<|role|>``, a line feed, its text without marker, ``<|end|>``. Rows are in order of turn, null first, then
    of text. A null text is empty; rows without a conversation form one for each different (turn, text); rows equal in all of
    these are decoded as often as they stand. An empty table gives an empty one. Every row gets one of the
    model's roles, so that work grows with the square of their number. The rows are sorted into ranges of about ``RANGE_CHARS`` characters, or as many as the session shuffles to, if more.
    """
    carried = carried or []
    names = {f"_c{i}": c for i, c in enumerate([conv, turn, *carried])}
    chosen = rows.select(
        *[F.col(c).alias(a) for a, c in names.items()],
        F.coalesce(F.concat(F.lit("c"), F.col(conv).cast("string")), F.concat(F.lit("r"), F.xxhash64(turn, text).cast("string"))).alias("_conv"),
        F.col(turn).alias("_turn"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
        # Tells copies of a row apart, so that ranges can part them; which copy is which does not show in the result.
        F.monotonically_increasing_id().alias("_copy"),
    )
    order = ["_conv", F.asc_nulls_first("_turn"), "_text", *[F.col(a) for a in list(names)[2:]], "_copy"]
    wanted = math.ceil((chosen.agg(F.sum(F.length("_text") + 64)).first()[0] or 0) / RANGE_CHARS)
    more = wanted > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (chosen.repartitionByRange(wanted, *order) if more else chosen.repartitionByRange(*order)).sortWithinPartitions(*order)
    # Written once: the limits of ranges differ from run to run.
    ranged = stage(ranged.drop("_copy").withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "turns")
    # Only the first and the last conversation of a range can stand in another range too. One row for each range.
    ends_of = ranged.groupBy("_part").agg(F.min_by("_conv", "_at").alias("_first"), F.max_by("_conv", "_at").alias("_last"))
    line = Window.orderBy("_part")
    goes_on = F.coalesce(F.col("_last") == F.lead("_first").over(line), F.lit(False))
    follows = F.coalesce(F.col("_first") == F.lag("_last").over(line), F.lit(False))
    edges = stage(ends_of.select("_part", "_first", "_last", follows.alias("_follows"), goes_on.alias("_goes_on")), "edges")
    fields = ", ".join(f"{a} {ranged.schema[a].dataType.simpleString()}" for a in names)

    def opened(frame: pd.DataFrame) -> pd.DataFrame:
        """Rows in order, with whether each is the first of its conversation."""
        frame = frame.sort_values("_at")
        first = ~frame["_conv"].duplicated()
        return frame.assign(_opens=first & ~(frame["_follows"] & (frame["_conv"] == frame["_first"])))

    def reduce(frame: pd.DataFrame) -> pd.DataFrame:
        """Matrices of the conversations that a range shares with others."""
        frame, found = opened(frame), []
        for conv, shared in {frame["_first"].iloc[0]: frame["_follows"].iloc[0], frame["_last"].iloc[0]: frame["_goes_on"].iloc[0]}.items():
            one = frame["_first"].iloc[0] == frame["_last"].iloc[0]
            if shared or one and frame["_follows"].iloc[0]:
                some = frame[frame["_conv"] == conv]
                whole = chained([chained(row_matrices(model, t, o)) for t, o in zip(some["_text"], some["_opens"])])
                found.append((conv, frame["_part"].iloc[0], whole.ravel().tolist()))
        return pd.DataFrame(found, columns=["_conv", "_part", "_matrix"])

    def ends(frame: pd.DataFrame) -> pd.DataFrame:
        """Scores at the entry and the state at the exit of each range of a conversation."""
        frame = frame.sort_values("_part")
        matrices = [np.array(m, float).reshape(model.states, -1) for m in frame["_matrix"]]
        entries = [np.zeros(model.states)]
        for m in matrices:
            entries.append((entries[-1][:, None] + m).max(axis=0))
        exits = [int(entries[-1].argmax())]
        for m, entry in zip(reversed(matrices[1:]), reversed(entries[1:-1])):
            exits.append(int((entry + m[:, exits[-1]]).argmax()))
        return pd.DataFrame({"_conv": frame["_conv"], "_part": frame["_part"], "_entry": [e.tolist() for e in entries[:-1]], "_exit": exits[::-1]})

    def render(frame: pd.DataFrame, limits: pd.DataFrame) -> pd.DataFrame:
        frame = opened(frame).reset_index(drop=True)
        known = {c: (np.array(e, float), int(x)) for c, e, x in zip(limits["_conv"], limits["_entry"], limits["_exit"])}
        roles, turns, rendered = [None] * len(frame), [0] * len(frame), [[] for _ in range(len(frame))]
        for conv, some in frame.groupby("_conv", sort=False):
            lines = [(row, text, m) for row, t, o in zip(some.index, some["_text"], some["_opens"]) for text, m in zip(t.split("\n"), row_matrices(model, t, o))]
            entry, last = known.get(conv, (np.zeros(model.states), None))
            for (row, text, _), state in zip(lines, decode([m for *_, m in lines], entry, last)):
                role, plain = model.roles[state // 2], ENDING.sub("", marked_role(text, model.markers)[1])
                if state % 2 == 0 or not rendered[row]:
                    rendered[row].append(("<|end|>\n" if rendered[row] else "") + f"<|{role}|>\n{plain}")
                    turns[row] += state % 2 == 0
                else:
                    rendered[row].append("\n" + plain)
                roles[row] = roles[row] or role
        return frame[list(names)].assign(role=roles, n_turns=turns, rendered=["".join(r).rstrip() + "<|end|>\n" for r in rendered])

    # A group is one range of the sort, whose size was chosen above, whatever the length of a conversation or the number of copies of a row.
    within = ranged.join(F.broadcast(edges), "_part")
    merged = within.groupBy("_part").applyInPandas(reduce, "_conv string, _part int, _matrix array<double>")
    limits = stage(merged.groupBy("_conv").applyInPandas(ends, "_conv string, _part int, _entry array<double>, _exit int"), "ends")
    found = within.groupBy("_part").cogroup(limits.groupBy("_part")).applyInPandas(render, f"{fields}, role string, n_turns long, rendered string")
    return found.select(*[F.col(a).alias(c) for a, c in names.items()], F.col("role").alias("role_found"), "n_turns", "rendered")
