"""Conversation structure repair: the cheapest edits after which the turns alternate as they should.

Roles, by their initials, have to read ``(s?(ua)+)?``. Every turn is kept, given another role or
deleted, and empty turns may be inserted; a dynamic program over the four states of that pattern
finds the cheapest way. Of equally cheap ways the one counts whose audit, the initials of its
edits in order, is least.

Audits are never written out while they grow. They share their prefixes as linked nodes
(:class:`Trails`); a node knows its ancestors 1, 2, 4, ... steps up and a rolling hash of what leads
to it, so that a tie is settled by a search for the longest common prefix. Prefixes that are equal
by hash are compared node by node.

A conversation may be longer than a task can hold. Turns lie in global order; each stretch of a
conversation inside one partition is summed to one small table from the state before it to the
state after it, with the cost and the rank of its best audit. The tables of a conversation that
spans partitions are joined by the same program, and each stretch is then decoded alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import cmp_to_key

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from loomframe.session import ship_package, stage

#: Turns of a conversation that are solved at once.
CHUNK = 1024

BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
_INITIALS = "sua"
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
_ROLE = {"u": "user", "a": "assistant"}

# states: 0 nothing yet, 1 after system, 2 after user, 3 after assistant
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_STATES = range(4)
#: What a state inserts, and what ends a conversation in it: letters and cost.
_INSERT = {0: "u", 1: "u", 2: "a", 3: "u"}
_ENDS = {0: ("", 0), 1: ("II", 4), 2: ("I", 2), 3: ("", 0)}
#: Edits of one turn with the insertions before it, by their order; none begins with another.
LABELS = sorted("I" * n + edit for n in range(3) for edit in "DKR")

Arc = tuple[int, int, int, int]  # from state, to state, cost, label


def _arcs(code: int) -> list[Arc]:
    """All ways past a turn, the best for each pair of states; code is 4 * initial + fault."""
    initial, fault = "sua?"[code >> 2], code & 3
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for before in _STATES:
        state, spent, letters = before, 0, ""
        for _ in range(3):
            ways = [("D", state, 3)]
            if fault not in (BLANK, DUPLICATE):
                more = 1 if fault == TRUNCATED else 0
                ways += [("K", _NEXT.get((state, initial)), more)]
                ways += [("R", _NEXT.get((state, role)), 2 + more) for role in "ua"]
            for edit, after, cost in ways:
                if after is not None:
                    way = (spent + cost, LABELS.index(letters + edit))
                    best[before, after] = min(way, best.get((before, after), way))
            state, spent, letters = _NEXT[state, _INSERT[state]], spent + 2, letters + "I"
    return [(q, p, cost, label) for (q, p), (cost, label) in sorted(best.items())]


ARCS = [_arcs(code) for code in range(16)]


class Trails:
    """Label sequences that share their prefixes. Node 0 is the empty sequence."""

    MOD, BASE = (1 << 61) - 1, 0x1D872B41B9F2C3

    def __init__(self):
        self.label, self.hash, self.up = [-1], [0], [()]

    def add(self, parent: int, label: int) -> int:
        up, up_of, j = [parent], self.up, 0
        while len(up_of[up[j]]) > j:
            up.append(up_of[up[j]][j])
            j += 1
        self.label.append(label)
        self.hash.append((self.hash[parent] * self.BASE + label + 1) % self.MOD)
        up_of.append(tuple(up))
        return len(up_of) - 1

    def labels(self, node: int) -> list[int]:
        out = []
        while node:
            out.append(self.label[node])
            node = self.up[node][0]
        return out[::-1]

    def _same(self, a: int, b: int) -> bool:
        """Whether two sequences of one length are equal, node by node."""
        while a != b:
            if self.label[a] != self.label[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def compare(self, a: int, b: int) -> int:
        """Order of two sequences of one length: -1, 0 or 1."""
        if a == b:
            return 0
        first, second = a, b
        if self.hash[a] != self.hash[b]:
            for j in range(len(self.up[a]) - 1, -1, -1):
                if j < len(self.up[a]) and self.hash[self.up[a][j]] != self.hash[self.up[b][j]]:
                    a, b = self.up[a][j], self.up[b][j]
            # what leads to a and b is the longest common prefix, if the hashes are right
            if self.label[a] != self.label[b] and self._same(self.up[a][0], self.up[b][0]):
                return -1 if self.label[a] < self.label[b] else 1
        elif self._same(a, b):
            return 0
        one, other = self.labels(first), self.labels(second)
        return (one > other) - (one < other)


Best = dict[int, tuple[int, int]]  # state -> cost, node


def extend(trails: Trails, best: Best, arcs: Sequence[Arc]) -> Best:
    """The best trail into each state after one more step."""
    out: Best = {}
    for q, p, cost, label in arcs:
        if q in best:
            total = best[q][0] + cost
            if p not in out or total < out[p][0]:
                out[p] = (total, q, label)
            elif total == out[p][0]:
                _, was, had = out[p]
                order = trails.compare(best[q][1], best[was][1])
                if order < 0 or (order == 0 and label < had):
                    out[p] = (total, q, label)
    return {p: (cost, trails.add(best[q][1], label)) for p, (cost, q, label) in out.items()}


def _ending(trails: Trails, best: Best) -> tuple[int, int]:
    """Cost of the whole and the state before the last insertions, which are still to be made."""
    found = None
    for q, (cost, node) in best.items():
        total = cost + _ENDS[q][1]
        if found is None or total < found[0] or (total == found[0] and trails.compare(node, best[found[1]][1]) < 0):
            found = (total, q)
    return found


def span(steps: Sequence[Sequence[Arc]], entries: Sequence[int]) -> list[Arc]:
    """Several steps as one: for each entry and exit the cost and the rank of the best trail."""
    trails, ends = Trails(), []
    for entry in entries:
        best: Best = {entry: (0, 0)}
        for arcs in steps:
            best = extend(trails, best, arcs)
        ends += [(entry, p, cost, node) for p, (cost, node) in best.items()]
    nodes = sorted((e[3] for e in ends), key=cmp_to_key(trails.compare))
    rank = {}
    for i, node in enumerate(nodes):
        rank[node] = rank[nodes[i - 1]] if i and trails.compare(nodes[i - 1], node) == 0 else i
    return [(q, p, cost, rank[node]) for q, p, cost, node in ends]


def walk(steps: Sequence[Sequence[Arc]], entry: int, leave: int | None) -> tuple[int, list[tuple[int, int, int]]]:
    """Cost, and (state before, state after, label) of each step, up to ``leave`` or the end."""
    trails, best = Trails(), {entry: (0, 0)}
    for arcs in steps:
        best = extend(trails, best, arcs)
    cost, last = _ending(trails, best) if leave is None else (best[leave][0], leave)
    out, state = [], entry
    for arcs, label in zip(steps, trails.labels(best[last][1])):
        # the letters of an audit fix all states, so a label leads one way only
        after = next(p for q, p, _, has in arcs if q == state and has == label)
        out.append((state, after, label))
        state = after
    return cost, out


def solve(codes: bytes, entry: int, leave: int | None) -> tuple[int, list[tuple[int, int, int]]]:
    """Cost and steps of a stretch of turns between two states; in chunks if it is long."""
    if len(codes) <= CHUNK:
        return walk([ARCS[c] for c in codes], entry, leave)
    parts = [codes[i : i + CHUNK] for i in range(0, len(codes), CHUNK)]
    spans = [span([ARCS[c] for c in part], _STATES) for part in parts]
    cost, route = walk(spans, entry, leave)
    out = []
    for part, (before, after, _) in zip(parts, route):
        out += walk([ARCS[c] for c in part], before, after)[1]
    return cost, out


def total(codes: bytes) -> list[Arc]:
    """A stretch of turns as one step."""
    parts = [span([ARCS[c] for c in codes[i : i + CHUNK]], _STATES) for i in range(0, len(codes), CHUNK)]
    return span(parts, _STATES)


def edits(steps: list[tuple[int, int, int]], last: bool) -> Iterator[tuple[str, list[str], str | None, list[str]]]:
    """edit, roles inserted before, role given, roles inserted after; for each turn."""
    for i, (state, after, label) in enumerate(steps):
        letters, before, given = LABELS[label], [], None
        for _ in letters[:-1]:
            before.append(_ROLE[_INSERT[state]])
            state = _NEXT[state, _INSERT[state]]
        if letters[-1] == "R":
            given = _ROLE[next(r for r in "ua" if _NEXT.get((state, r)) == after)]
        behind = []
        if last and i == len(steps) - 1:
            for _ in _ENDS[after][0]:
                behind.append(_ROLE[_INSERT[after]])
                after = _NEXT[after, _INSERT[after]]
        yield letters[-1], before, given, behind


# --- turns in order, their faults and stretches --------------------------------------------------

_SOLID = r"[^\x20\x09-\x0D]"


def _space(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """The turns with faults put in by crc32 of ``conv_id:turn``, modulo 20.

    0 drops the turn, 1 empties its text, 2 removes ``.``, ``!`` and ``?``, 3 repeats it, 4 sets
    the role user; others stay. Nulls count as one space, but for conv_id and turn themselves.
    """
    draw = F.crc32(F.concat_ws(":", _space("conv_id"), _space("turn")).cast("binary")) % 20
    text = F.when(draw == 1, "").when(draw == 2, F.regexp_replace(_space("text"), "[.!?]", "")).otherwise(_space("text"))
    return (
        conversations.where(draw != 0)
        .withColumn("_copy", F.explode(F.when(draw == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select(
            F.col("conv_id").cast("long"), F.col("turn").cast("long"),
            F.when(draw == 4, "user").otherwise(_space("role")).alias("role"), text.alias("text"),
        )
    )


def in_order(turns: DataFrame) -> DataFrame:
    """Stored turns with their place ``n`` in the order conv_id, turn, role, text (nulls first).

    ``n`` holds the partition in its upper bits, and grows by one inside a partition.
    """
    rows = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), _space("role").alias("role"), _space("text").alias("text")
    )
    return stage(
        rows.orderBy("conv_id", "turn", "role", "text").withColumn("n", F.monotonically_increasing_id()), "turns"
    )


def faults(ordered: DataFrame) -> DataFrame:
    """conv_id, n and code of each turn: 4 * place of the role's initial in ``sua?`` + first fault.

    A text without a visible character is blank; a role and text met earlier in the conversation
    a duplicate (texts are equal by SHA-256); a last visible character other than ``.!?`` makes a
    text truncated.
    """
    # the first turn of each role and text, found by sums; the join back is on unique places
    first = (
        ordered.groupBy("conv_id", "role", F.sha2("text", 256).alias("text")).agg(F.min("n").alias("n"))
        .select("n", F.lit(True).alias("first"))
    )
    last = F.regexp_extract("text", rf"({_SOLID})[\x20\x09-\x0D]*\z", 1)
    looked = ordered.select(
        "conv_id", "n", F.substring("role", 1, 1).alias("initial"), last.alias("last")
    ).join(first, "n", "left")
    fault = (
        F.when(F.col("last") == "", BLANK).when(F.col("first").isNull(), DUPLICATE)
        .when(~F.col("last").isin(".", "!", "?"), TRUNCATED).otherwise(0)
    )
    initial = F.lit(3)
    for i, letter in enumerate(_INITIALS):
        initial = F.when(F.col("initial") == letter, i).otherwise(initial)
    return looked.select("conv_id", "n", (initial * 4 + fault).cast("int").alias("code"))


def _illegal(codes: np.ndarray) -> int:
    initials = codes >> 2
    legal = np.zeros((4, 4), bool)
    for one, other in _LEGAL:
        legal[_INITIALS.index(one), _INITIALS.index(other)] = True
    return int((~legal[initials[:-1], initials[1:]]).sum())


_STRETCH = pa.schema(
    [("conv_id", pa.int64()), ("first", pa.int64()), ("codes", pa.binary()), ("edge", pa.bool_()),
     ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64())]
)


def stretches(coded: DataFrame) -> DataFrame:
    """One row per conversation and partition of the order: the codes of its turns, and counts.

    ``edge`` marks the first and last stretch of a partition, the only ones whose conversation may
    go on elsewhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        start, key, opening, ready = 0, None, True, []

        def row(edge: bool) -> tuple:
            codes = np.concatenate(held)
            kinds = np.bincount(codes & 3, minlength=4)
            return (key[1], start, codes.tobytes(), edge, *map(int, kinds[1:]), _illegal(codes))

        for batch in batches:
            conv, n = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            missing = conv.is_null().to_numpy(zero_copy_only=False)
            ids = conv.fill_null(0).to_numpy(zero_copy_only=False)
            codes, part = batch.column(2).to_numpy(zero_copy_only=False).astype(np.uint8), n >> 33
            changes = (np.diff(ids) != 0) | (np.diff(missing.astype(np.int8)) != 0) | (np.diff(part) != 0)
            borders = [0, *(np.flatnonzero(changes) + 1).tolist(), len(n)]
            for a, b in zip(borders, borders[1:]):
                if a == b:
                    continue
                own = (int(part[a]), None if missing[a] else int(ids[a]))
                if key is not None and own != key:
                    ends = own[0] != key[0]
                    ready.append(row(opening or ends))
                    held, opening = [], ends
                if not held:
                    start = int(n[a])
                key = own
                held.append(codes[a:b])
            if ready:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*ready), _STRETCH)], schema=_STRETCH)
                ready = []
        if held:
            ready = [row(True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*ready), _STRETCH)], schema=_STRETCH)

    return (
        coded.withColumn("part", F.shiftright("n", 33)).repartition("part").sortWithinPartitions("n")
        .select("conv_id", "n", "code")
        .mapInArrow(
            run,
            "conv_id long, first long, codes binary, edge boolean, blank long, duplicate long, truncated long, illegal long",
        )
    )


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        arcs = [total(codes) for codes in frame["codes"]]
        yield pd.DataFrame(
            {"conv_id": frame["conv_id"], "first": frame["first"], "arcs": [[list(a) for a in some] for some in arcs],
             "opens": [c[0] >> 2 for c in frame["codes"]], "closes": [c[-1] >> 2 for c in frame["codes"]]}
        )


def _routes(group: pd.DataFrame) -> pd.DataFrame:
    """States around each stretch of a conversation, its cost (with the first), illegal borders."""
    group = group.sort_values("first")
    steps = [[tuple(map(int, arc)) for arc in arcs] for arcs in group["arcs"]]
    cost, route = walk(steps, 0, None)
    opens, closes = group["opens"].to_numpy(), group["closes"].to_numpy()
    border = [0, *(_illegal(np.array([one << 2, other << 2])) for one, other in zip(closes, opens[1:]))]
    return pd.DataFrame(
        {"first": group["first"].to_numpy(), "entry": [r[0] for r in route], "leave": [r[1] for r in route],
         "last": [False] * (len(route) - 1) + [True], "cost": [cost] + [0] * (len(route) - 1), "border": border}
    )


_EDITS = pa.schema(
    [("n", pa.int64()), ("edit", pa.string()), ("before", pa.list_(pa.string())), ("given", pa.string()),
     ("after", pa.list_(pa.string())), ("cost", pa.int64())]
)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of the turns of each stretch; the cost stands with its first turn."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            alone, codes = row["entry"] is None, row["codes"]
            cost, steps = solve(codes, 0 if alone else row["entry"], None if alone else row["leave"])
            found = list(edits(steps, alone or row["last"]))
            columns = list(zip(*found))
            costs = [cost if alone else row["cost"]] + [0] * (len(found) - 1)
            numbers = np.arange(row["first"], row["first"] + len(found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip([numbers, *columns, costs], _EDITS)], schema=_EDITS
            )


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns with their edits, and one row per conversation.

    The first table has a row per turn: conv_id, turn, role, text, n (its place in order), edit
    (K kept, R given another role, D deleted), before and after (roles of the empty turns inserted
    there) and given (the new role, of R). The second has conv_id, blank, duplicate, truncated
    (turns by their first fault), illegal (neighbours whose initials are not su, ua or au), gaps
    (turn numbers missing between the least and the greatest) and cost: 2 for a new role or an
    insertion, 3 for a deletion, 1 for a truncated turn that stays. Blank and duplicate turns are
    always deleted.

    Null roles and texts count as one space; rows without conv_id are one conversation, and a null
    turn comes first. Turns that tie come by role and text, and repeated rows are duplicates. An
    empty table gives none. Other columns are not read.
    """
    ship_package(turns.sparkSession)
    ordered = in_order(turns)
    parts = stage(stretches(faults(ordered)), "stretches")
    at_edges = parts.where("edge").select("conv_id", "first", "codes")
    # at most two rows for each partition
    arcs = at_edges.mapInPandas(_sums, "conv_id long, first long, arcs array<array<int>>, opens int, closes int")
    routes = arcs.groupBy("conv_id").applyInPandas(
        _routes, "first long, entry int, leave int, last boolean, cost long, border long"
    )
    routes = stage(routes, "routes")
    ways = parts.select("first", "codes").join(routes.drop("border"), "first", "left")
    decoded = stage(
        ways.select("first", "codes", "entry", "leave", "last", "cost").mapInArrow(
            _decode, "n long, edit string, before array<string>, given string, after array<string>, cost long"
        ),
        "edits",
    )
    costs = decoded.where("cost > 0").select("n", "cost")
    by_part = parts.drop("codes", "edge").join(costs.withColumnRenamed("n", "first"), "first", "left").join(
        routes.select("first", "border"), "first", "left"
    )
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    illegal = F.sum(F.col("illegal") + F.coalesce("border", F.lit(0))).alias("illegal")
    summed = by_part.groupBy("conv_id").agg(count("blank"), count("duplicate"), count("truncated"), illegal, count("cost"))
    width = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    gaps = ordered.groupBy(F.col("conv_id").alias("id")).agg(F.coalesce(width, F.lit(0)).alias("gaps"))
    summary = summed.join(gaps, F.col("conv_id").eqNullSafe(F.col("id"))).drop("id")
    return ordered.join(decoded.drop("cost"), "n"), summary


def digests(edited: DataFrame) -> DataFrame:
    """conv_id, audit and repaired_sha256 of each conversation, from the turns of :func:`repair`.

    The hash of a text is sequential by nature: the turns of a conversation pass through one task
    in order, as a stream that is not held; only the audit grows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, letters, digest, empty = (), [], None, True

        def result() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([current[0]], pa.int64()), pa.array(["".join(letters)]), pa.array([digest.hexdigest()])],
                names=["conv_id", "audit", "repaired_sha256"],
            )

        for batch in batches:
            for conv, role, text, edit, before, given, after in zip(*(c.to_pylist() for c in batch.columns)):
                if current != (conv,):
                    if current:
                        yield result()
                    current, letters, digest, empty = (conv,), [], hashlib.sha256(), True
                kept = [] if edit == "D" else [f"{role if edit == 'K' else given}:{text}"]
                for line in [*(f"{r}:" for r in before), *kept, *(f"{r}:" for r in after)]:
                    digest.update(line.encode() if empty else b"\n" + line.encode())
                    empty = False
                letters.append("I" * len(before) + edit + "I" * len(after))
        if current:
            yield result()

    return (
        edited.repartition("conv_id").sortWithinPartitions("conv_id", "n")
        .select("conv_id", "role", "text", "edit", "before", "given", "after")
        .mapInArrow(run, "conv_id long, audit string, repaired_sha256 string")
    )


def report(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per conv_id of ``conversations``, with what :func:`repair` finds in ``turns``.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 (of the
    repaired ``role:text``, joined by line breaks). Without turns: zeros, and nothing as text.
    """
    edited, summary = repair(turns)
    found = digests(edited).join(
        summary.withColumnRenamed("conv_id", "id"), F.col("conv_id").eqNullSafe(F.col("id"))
    ).drop("id").withColumnRenamed("conv_id", "id")
    all_ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    joined = all_ids.join(found, F.col("conv_id").eqNullSafe(F.col("id")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    nothing = hashlib.sha256(b"").hexdigest()
    return joined.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
