"""Chat formatting: who speaks each line of a transcript, and the turns in one canonical form.

A hidden Markov model runs over the lines of a conversation. Its states are the roles; what it
sees of a line is the speaker marker at its beginning, if any, its length, shape and ending, and
on the first line of a stored turn the turn's length and its role column. Rates are counted from
all turns with a known role. Viterbi then gives the roles of all lines, so a turn without a role,
or several speakers in one stored turn, come out right; each turn is rendered the same way.

Conversations are cut into chunks of lines. A chunk is summed to one small matrix of best scores
between its first and last state; the matrices of a conversation give the states at the borders,
and each chunk is then decoded alone. So no conversation has to fit in one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from loomframe.llm.common import in_batches, slices, text_of
from loomframe.session import ship_package, stage

ROLES = ("system", "user", "assistant", "tool")

#: Names a speaker goes by. Fixed values.
NAMES = {
    "system": 0, "instructions": 0, "user": 1, "human": 1, "question": 1, "customer": 1, "me": 1, "q": 1,
    "assistant": 2, "ai": 2, "bot": 2, "gpt": 2, "chatgpt": 2, "model": 2, "answer": 2, "agent": 2, "a": 2,
    "tool": 3, "function": 3,
}
_WEAK = ("q", "a", "me", "question", "answer", "model", "agent", "customer", "instructions")
_MARKER = re.compile(
    r"\s*(?:<\|(?:im_start\|>)?(?P<tag>\w+)(?:\|>)?[ \t]*|[\[(](?P<box>\w+)[\])]:?[ \t]*|(?:\*\*|#+[ \t]*)?(?P<name>\w+)(?:\*\*)?[ \t]*[:>](?:\*\*)?(?:[ \t]+|$))",
    re.IGNORECASE,
)
#: Lines in a chunk; a longer stored turn is one chunk by itself.
CHUNK = 2048

# what is seen of a line: feature -> number of values
SEEN = {"length": 12, "end": 4, "shape": 5, "turn_length": 16}


def marker(line: str) -> tuple[int, bool, int]:
    """(role, strong, characters) of the marker at the beginning of a line; role -1 for none."""
    found = _MARKER.match(line)
    name = found and (found["tag"] or found["box"] or found["name"]).lower()
    if not found or name not in NAMES or (found["box"] and name in _WEAK):
        return -1, False, 0
    return NAMES[name], name not in _WEAK, found.end()


def look(text: str) -> list[list[int]]:
    """For each line: marker (0 none, else 1 + 2 * role + strong), length, end, shape, turn length."""
    out = []
    for i, line in enumerate(text.split("\n")):
        role, strong, size = marker(line)
        body = line[size:].strip()
        last, first = body[-1:], body[:1]
        out.append(
            [
                0 if role < 0 else 1 + 2 * role + strong,
                min(len(body).bit_length(), 11),
                0 if last == "?" else 1 if last in ".!" else 2 if last else 3,
                0 if first in "-*#>|`" and first else 1 if first.isdigit() else 2 if first.islower()
                else 3 if first else 4,
                min(len(text).bit_length(), 14) if i == 0 else 15,
            ]
        )
    return out


def _role_number(role: Column) -> Column:
    known = F.lit(-1)
    for name, number in NAMES.items():
        if name not in _WEAK:
            known = F.when(F.lower(F.trim(role)) == name, number).otherwise(known)
    return known.cast("int")


# --- the model --------------------------------------------------------------------------------

class Model:
    """Log rates of the first role, of changes between turns and of what is seen."""

    def __init__(self, first: np.ndarray, change: np.ndarray, seen: dict[str, np.ndarray]):
        k = len(ROLES)
        smooth = lambda counts: np.log((counts + 0.5) / (counts + 0.5).sum(-1, keepdims=True))
        self.first, self.change = smooth(first), smooth(change)
        self.seen = {name: smooth(counts) for name, counts in seen.items()}
        stay = 0.998
        self.keep = np.log(np.where(np.eye(k, dtype=bool), stay, (1 - stay) / (k - 1)))
        # a marker names its speaker nearly always when it is strong
        self.marked = np.zeros((1 + 2 * k, k))
        for role in range(k):
            for strong in (0, 1):
                right = 0.99 if strong else 0.7
                self.marked[1 + 2 * role + strong] = np.log(
                    np.where(np.arange(k) == role, right, (1 - right) / (k - 1))
                )
        self.given = np.log(np.where(np.eye(k, dtype=bool), 0.999, 0.001 / (k - 1)))

    def steps(self, starts: np.ndarray, given: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores per line: of each state by what is seen, and of each change into it.

        ``starts``: 2 first line of the conversation, 1 of a turn, 0 other; ``given``: role of
        the turn on its first line, else -1.
        """
        score = self.marked[seen[:, 0]].copy()
        for column, name in enumerate(SEEN, 1):
            score += self.seen[name][:, seen[:, column]].T
        told = given >= 0
        score[told] += self.given[given[told]]
        named = (seen[:, 0] > 0) & (starts == 0)
        change = np.where((starts == 1)[:, None, None], self.change, self.keep)
        change[named] = np.logaddexp(self.change, self.keep) - np.log(2)
        change[starts == 2] = self.first[None, :]
        return score, change


def count_rates(turns: DataFrame) -> Model:
    """Rates from all turns whose role is known; sums only are collected, a few hundred."""
    known = turns.where("given >= 0")
    width = {name: n for name, n in SEEN.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {name: np.zeros((len(ROLES), n), np.int64) for name, n in width.items()}
        for batch in batches:
            for part in slices(batch, 0):
                for text, role in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    lines = np.array(look(text))
                    for column, name in enumerate(width, 1):
                        total[name][role] += np.bincount(lines[:, column], minlength=width[name])
        rows = [
            (name, r, v, int(n)) for name, table in total.items() for (r, v), n in np.ndenumerate(table) if n
        ]
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])],
            names=["name", "role", "value", "n"],
        )

    sums = known.select("text", "given").mapInArrow(run, "name string, role long, value long, n long")
    seen = {name: np.zeros((len(ROLES), n)) for name, n in width.items()}
    for r in sums.groupBy("name", "role", "value").agg(F.sum("n").alias("n")).collect():
        seen[r["name"]][r["role"], r["value"]] = r["n"]
    # one role per (conversation, turn), so that repeated rows make no products
    one = known.groupBy("conv_id", "turn").agg(F.min("given").alias("given"))
    after = one.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("given").alias("next"))
    first, change = np.zeros(len(ROLES)), np.zeros((len(ROLES), len(ROLES)))
    for r in one.join(after, ["conv_id", "turn"]).groupBy("given", "next").count().collect():
        change[r["given"], r["next"]] = r["count"]
    lowest = one.groupBy("conv_id").agg(F.min(F.struct("turn", "given")).alias("f"))
    for r in lowest.groupBy("f.given").count().collect():
        first[r["given"]] = r["count"]
    return Model(first, change, seen)


# --- decoding ---------------------------------------------------------------------------------

def _unpack(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines of the turns of a chunk: starts, given, seen and the row of each."""
    group = group.sort_values("n", kind="stable")
    parts = [np.asarray(s, np.int64).reshape(-1, 1 + len(SEEN)) for s in group["seen"]]
    size = np.array([len(p) for p in parts])
    first = np.cumsum(size) - size
    starts, given = np.zeros(size.sum(), np.int64), np.full(size.sum(), -1)
    starts[first] = np.where(group["opens"].to_numpy(), 2, 1)
    given[first] = group["given"].to_numpy()
    return starts, given, np.concatenate(parts), np.repeat(group["n"].to_numpy(), size)


def _span(score: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Best scores from the state before the chunk to the state on its last line."""
    best = np.where(np.eye(score.shape[1], dtype=bool), 0.0, -np.inf)
    for s, c in zip(score, change):
        best = (best[:, :, None] + c[None]).max(1) + s
    return best


def _decode(score: np.ndarray, change: np.ndarray, before: int, last: int) -> np.ndarray:
    """Best states of a chunk between the state before it and that on its last line."""
    best = np.full(score.shape[1], -np.inf)
    best[before] = 0
    back = []
    for s, c in zip(score, change):
        ways = best[:, None] + c
        back.append(ways.argmax(0))
        best = ways.max(0) + s
    out = np.empty(len(score), np.int64)
    for i in range(len(score) - 1, -1, -1):
        out[i] = last
        last = back[i][last]
    return out


def _borders(group: pd.DataFrame) -> pd.DataFrame:
    """State before each chunk of a conversation, and on its last line."""
    group = group.sort_values(["part", "chunk"], kind="stable")
    spans = [np.asarray(s).reshape(len(ROLES), len(ROLES)) for s in group["span"]]
    best, back = np.zeros(len(ROLES)), []
    for i, span in enumerate(spans):
        ways = best[:, None] + span
        back.append(ways.argmax(0))
        best = ways.max(0)
        best = best - best.max()
    last, befores, lasts = int(best.argmax()), [], []
    for step in reversed(back):
        lasts.append(last)
        last = int(step[last])
        befores.append(last)
    return pd.DataFrame(
        {"part": group["part"], "chunk": group["chunk"], "before": befores[::-1], "last": lasts[::-1]}
    )


def _chunks(turns: DataFrame) -> DataFrame:
    """Turns in order with what is seen of their lines, cut into chunks (part, chunk)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, chunk, lines, current = TaskContext.get().partitionId(), 0, -1, 0, object()
        for batch in batches:
            for some in slices(batch, 2):
                seen, chunks, numbers = [], [], []
                for conv, text in zip(some.column(0).to_pylist(), some.column(2).to_pylist()):
                    own = look(text)
                    if conv != current or lines + len(own) > CHUNK:
                        chunk, lines, current = chunk + 1, 0, conv
                    lines += len(own)
                    seen.append([v for line in own for v in line])
                    chunks.append(chunk)
                    numbers.append(n)
                    n += 1
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array([part] * len(seen), pa.int64()), pa.array(chunks, pa.int64()),
                     pa.array(numbers, pa.int64()), pa.array(seen, pa.list_(pa.int32()))],
                    names=["conv_id", "turn", "text", "given", "part", "chunk", "n", "seen"],
                )

    return (
        turns.repartitionByRange("conv_id", "turn", F.xxhash64("text"))
        .sortWithinPartitions("conv_id", "turn", "given", "text")
        .select("conv_id", "turn", "text", "given")
        .mapInArrow(
            run,
            "conv_id long, turn long, text string, given int, part long, chunk long, n long, seen array<int>",
        )
    )


def parse(conversations: DataFrame) -> DataFrame:
    """The turns of all conversations with recovered roles.

    Columns: conv_id, turn and piece (a stored turn with several speakers has several pieces),
    role, given (the role column named it), text (without its marker) and rendered. Rows without
    conv_id or turn come first in their order; null text is empty and still a turn; a null or
    unknown role is recovered; repeated rows are turns of their own. An empty table gives no
    rows. Other columns are not read. A turn keeps its order by (conv_id, turn, role, text).
    """
    spark = conversations.sparkSession
    ship_package(spark)
    turns = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), text_of().alias("text"),
        _role_number(F.col("role")).alias("given"),
    )
    model = count_rates(turns)
    stored = stage(_chunks(turns), "turns")
    # where a conversation begins: its first (part, n)
    opening = stored.groupBy("conv_id").agg(F.min(F.struct("part", "n")).alias("o"))
    lines = stored.select("conv_id", "part", "chunk", "n", "given", "seen").join(
        opening.select(F.col("o.part").alias("part"), F.col("o.n").alias("n"), F.lit(True).alias("opens")),
        ["part", "n"],
        "left",
    )
    lines = stage(lines.withColumn("opens", F.coalesce("opens", F.lit(False))), "lines")

    def span(group: pd.DataFrame) -> pd.DataFrame:
        starts, given, seen, _ = _unpack(group)
        return pd.DataFrame(
            {"conv_id": group["conv_id"][:1], "part": group["part"][:1], "chunk": group["chunk"][:1],
             "span": [_span(*model.steps(starts, given, seen)).ravel().tolist()]}
        )

    spans = lines.groupBy("part", "chunk").applyInPandas(
        span, "conv_id long, part long, chunk long, span array<double>"
    )
    borders = spans.groupBy("conv_id").applyInPandas(_borders, "part long, chunk long, before int, last int")

    def decode(group: pd.DataFrame, border: pd.DataFrame) -> pd.DataFrame:
        starts, given, seen, owner = _unpack(group)
        roles = _decode(*model.steps(starts, given, seen), int(border["before"].iloc[0]), int(border["last"].iloc[0]))
        cuts = np.flatnonzero(np.diff(owner, prepend=-1))
        return pd.DataFrame(
            {"part": group["part"].iloc[0], "n": owner[cuts], "roles": [r.tolist() for r in np.split(roles, cuts[1:])]}
        )

    roles = lines.groupBy("part", "chunk").cogroup(borders.groupBy("part", "chunk")).applyInPandas(
        decode, "part long, n long, roles array<int>"
    )
    told = stored.select("conv_id", "turn", "text", "given", "part", "n").join(roles, ["part", "n"])
    return in_batches(
        told.select("conv_id", "turn", "text", "given", "roles"), _pieces,
        "conv_id long, turn long, piece long, role string, given boolean, text string, rendered string", 2,
    )


def _pieces(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Each stored turn cut where the speaker changes."""
    rows = []
    for row in batch.to_pylist():
        parts: list[tuple[int, list[str]]] = []
        for line, role in zip(row["text"].split("\n"), row["roles"]):
            named, _, size = marker(line)
            if named == role:
                line = line[size:]
            if not parts or parts[-1][0] != role or (named == role and parts[-1][1] != [""]):
                parts.append((role, [line]))
            else:
                parts[-1][1].append(line)
        for piece, (role, lines) in enumerate(parts):
            text = "\n".join(lines)
            rows.append(
                (row["conv_id"], row["turn"], piece, ROLES[role], row["given"] == role, text, render(ROLES[role], text))
            )
    columns = list(zip(*rows)) if rows else [[]] * 7
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.string()]
    names = ["conv_id", "turn", "piece", "role", "given", "text", "rendered"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def render(role: str, text: str) -> str:
    """One turn in canonical form: lines without trailing blanks, no blank lines around them."""
    body = "\n".join(line.rstrip() for line in text.split("\n")).strip("\n")
    return f"<|{role}|>\n{body.replace('<|', '< |')}\n<|end|>\n"
