"""Exact k nearest neighbours, for classification and for filling gaps.

A classifier keeps its labelled rows as one matrix, cut into small leaves with their bounding boxes: a
query meets the rows of its own leaf, and then of those whose box is nearer than what it found there.
More labelled rows than such a matrix may hold are cut into shards with boxes, each held by the tasks
whose queries need it: a query meets the nearest shard, and then all that are not farther than what it
found there. To fill gaps, where any row can be a donor:

Donor rows are cut into blocks of nearby rows, each with its bounding box. The boxes alone tell
a query row how far its k-th neighbour can be at most, and so which blocks cannot hold any
neighbour. Queries meet only the remaining blocks, one block per task, and each meeting returns
its k best pairs. With many blocks a query first meets its closest one, and the distances found
there rule out most of the others. Nothing is approximated: a block is skipped only if its box proves it useless.

Boxes prune well in a few dimensions. In many dimensions without structure most blocks remain,
and the work approaches queries times donors, as for any exact method.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from loomframe.operators.joins import salted_join
from loomframe.session import ship_package, spread, stage

BLOCK_ROWS = 4_096      # donors per block, unless there would be more than MAX_CELLS blocks
MAX_CELLS = 16_384      # bounds the table of boxes that every task receives
MAX_PATTERNS = 64       # patterns of gaps with boxes of their own; rarer ones share blocks
QUERY_ROWS = 20_000     # queries that meet one block in one task
DONOR_ROWS = 50_000     # donors of one block in one task
AXES = 3                # leading features by which rows count as nearby
FEW_BLOCKS = 32         # up to here one round of meetings is cheaper than two
LABELLED_ROWS, LABELLED_BYTES = 200_000, 256_000_000  # labelled rows that every task receives, at most
SHARD_BYTES = 64_000_000  # labelled rows, or queries, that meet in one task where there are more
CUT_ROWS = 32           # labelled rows that say where to cut, for each shard
LEAF_ROWS = 256         # labelled rows under one box
TOGETHER = 16           # neighbouring queries that look through the same leaves
AT_ONCE = 4_096         # queries per round, each with its distances to all boxes
VOTER_ROWS = 2_000      # test rows worth a task of their own
ANY = -1                # target of a query that takes any donor


def feature_array(cols: Sequence[str]) -> Column:
    """Numeric columns as one array; NULL marks a gap."""
    return F.array(*[F.col(c).cast("double") for c in cols])


def _axis(i: int) -> Column:
    return F.get("x", F.lit(i))


def _edges(df: DataFrame, n_axes: int, cells: int) -> list[list[float]]:
    """Cut points per axis that give about this many cells of equal weight."""
    bins = int(np.ceil(cells ** (1 / n_axes)))
    if bins == 1:
        return [[] for _ in range(n_axes)]
    axes = df.select(*[_axis(i).alias(f"a{i}") for i in range(n_axes)])
    cuts = axes.approxQuantile(axes.columns, [i / bins for i in range(1, bins)], 0.005)
    return [sorted(set(c)) for c in cuts]


def _bins(edges: list[list[float]]) -> Column:
    bins = []
    for i, cuts in enumerate(edges):
        rank = reduce(lambda a, b: a + b, [(_axis(i) > c).cast("int") for c in cuts], F.lit(0))
        bins.append(F.coalesce(rank, F.lit(-1)).cast("string"))
    return F.concat_ws(":", *bins)


def _blocks(donors: DataFrame, n_features: int, n_rows: int) -> DataFrame:
    """Donors with their block: a cell, or an equal part of a crowded one.

    Rows of a block miss the same features. Rows with a rare pattern of gaps go to mixed blocks,
    which have no box and are never skipped.
    """
    gaps = F.array_join(F.transform("x", lambda v: F.when(v.isNull(), "-").otherwise("+")), "")
    patterned = donors.withColumn("__gaps", gaps)
    common = [
        row["__gaps"]
        for row in patterned.groupBy("__gaps")
        .count()
        .orderBy(F.desc("count"), "__gaps")
        .limit(MAX_PATTERNS)
        .collect()
    ]
    mixed = ~F.col("__gaps").isin(*common)
    cells = min(max(n_rows // BLOCK_ROWS, 1), MAX_CELLS // max(len(common), 1))
    edges = _edges(donors, min(AXES, n_features), cells)
    cell = F.concat_ws(":", F.when(mixed, "mixed").otherwise(F.col("__gaps")), _bins(edges))
    placed = patterned.withColumns({"__cell": cell, "mixed": mixed}).drop("__gaps")
    block_rows = max(BLOCK_ROWS, -(-n_rows // MAX_CELLS))
    crowd = placed.groupBy("__cell").agg(F.count("*").alias("__crowd"))
    part = F.pmod(F.xxhash64("donor"), F.ceil(F.col("__crowd") / block_rows))
    split = salted_join(placed, crowd, ["__cell"], "__crowd", F.col("donor"))
    return split.withColumn("block", F.concat_ws("/", "__cell", part)).drop("__cell", "__crowd")


def _without_spare_copies(donors: DataFrame, k: int) -> DataFrame:
    """Donors without the copies that cannot be among the k nearest, stored for several scans.

    Equal donors are equally far from everything, and ties go to the smaller id, so the ``k``
    smallest of each group of copies are enough. The rank is cut before the shuffle as well.
    """
    rank = F.row_number().over(W.partitionBy("x").orderBy("donor"))
    ranked = donors.select("donor", "x").withColumn("__rank", rank)
    return stage(ranked.where(F.col("__rank") <= k).drop("__rank"), "donors")


def _matrix(arrays: pd.Series) -> np.ndarray:
    return np.array([np.asarray(a, dtype=float) for a in arrays])


def _box_table(blocks: DataFrame) -> DataFrame:
    """Size and bounds of each block, folded on the map side feature by feature."""
    values = blocks.select("block", "mixed", F.posexplode("x").alias("pos", "v"))
    sides = values.groupBy("block", "mixed", "pos").agg(
        F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    # one entry per feature
    bounds = F.array_sort(F.collect_list(F.struct("pos", "low", "high"))).alias("b")
    boxes = sides.groupBy("block", "mixed", "n").agg(bounds)
    return boxes.select("block", "mixed", "n", F.col("b.low").alias("low"), F.col("b.high").alias("high"))


class _Boxes:
    """Bounding boxes of all blocks; MAX_CELLS bounds their number up to a small factor."""

    def __init__(self, blocks: DataFrame, n_features: int):
        table = _box_table(blocks).orderBy("block").toPandas()
        self.names = table["block"].to_numpy()
        self.mixed = table["mixed"].to_numpy(dtype=bool)
        self.counts = table["n"].to_numpy()
        self.low = _matrix(table["low"]).reshape(-1, n_features)
        self.high = _matrix(table["high"]).reshape(-1, n_features)

    def _bounds(self, x: np.ndarray, target: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per block whether it can serve ``x``, and the least and greatest distance in it."""
        shared = ~np.isnan(x) & ~np.isnan(self.low)
        n_shared = shared.sum(axis=1)
        scale = len(x) / np.maximum(n_shared, 1)
        inner = np.where(shared, np.maximum(np.maximum(self.low - x, x - self.high), 0.0), 0.0)
        outer = np.where(shared, np.maximum(np.abs(x - self.low), np.abs(x - self.high)), 0.0)
        usable = n_shared > 0
        if target != ANY:
            usable &= ~np.isnan(self.low[:, target])
        usable |= self.mixed
        # a hair of slack keeps rounding from excluding a block that touches the limit
        nearest = np.where(usable, (inner**2).sum(axis=1) * scale * (1 - 1e-9), np.inf)
        farthest = np.where(usable, (outer**2).sum(axis=1) * scale * (1 + 1e-9), np.inf)
        nearest[self.mixed], farthest[self.mixed] = 0.0, np.inf
        return usable, nearest, farthest

    def candidates(
        self, x: np.ndarray, k: int, target: int = ANY, limit: float = np.inf
    ) -> np.ndarray:
        """Blocks that can hold one of the k nearest donors of ``x`` (NaN marks a gap).

        With a ``target`` only donors that have this feature count. ``limit`` is a distance
        within which k donors are known already.
        """
        if not len(self.names):
            return self.names
        usable, nearest, farthest = self._bounds(x, target)
        order = np.argsort(farthest, kind="stable")
        enough = np.searchsorted(np.cumsum(self.counts[order]), k)
        limit = min(limit, farthest[order[min(enough, len(order) - 1)]])
        return self.names[usable & (nearest <= limit)]

    def home(self, x: np.ndarray, target: int = ANY) -> np.ndarray:
        """The block closest to ``x``, if any can serve it."""
        usable, nearest, farthest = self._bounds(x, target)
        best = np.lexsort((farthest, nearest))[:1]
        return self.names[best[usable[best]]]


_PAIRS = "query bigint, target int, donor bigint, distance double, value double"


def _best_pairs(q: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query and donor positions of the k nearest pairs of each query, with their distances."""
    known_x, known_q = ~np.isnan(x), ~np.isnan(q)
    complete = known_x.all() and known_q.all()
    square = np.zeros((len(q), len(x)))
    for j in range(x.shape[1]):
        gap = q[:, j, None] - x[None, :, j]
        gap *= gap
        if not complete:
            gap[~known_q[:, j]] = 0.0
            gap[:, ~known_x[:, j]] = 0.0
        square += gap
    if not complete:
        shared = known_q.astype(float) @ known_x.T.astype(float)
        with np.errstate(divide="ignore", invalid="ignore"):
            square = np.where(shared > 0, square * (x.shape[1] / shared), np.inf)
    best = min(k, len(x))
    limit = np.partition(square, best - 1, axis=1)[:, best - 1, None]
    nearer, level = square < limit, square == limit
    # of the donors level with the k-th, the first ones fill the places that are left
    left = best - nearer.sum(axis=1, keepdims=True)
    level &= np.cumsum(level, axis=1) <= left
    rows, cols = np.nonzero((nearer | level) & np.isfinite(square))
    return rows, cols, square[rows, cols]


def _meet(queries: pd.DataFrame, donors: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best pairs of each query within one block."""
    found = [pd.DataFrame({"query": [], "target": [], "donor": [], "distance": [], "value": []})]
    donors = donors.sort_values("donor", ignore_index=True)
    every = _matrix(donors["x"])
    for target, group in queries.groupby("target"):
        has = np.ones(len(donors), dtype=bool) if target == ANY else ~np.isnan(every[:, target])
        x, donor_ids = every[has], donors["donor"].to_numpy()[has]
        if not len(x):
            continue
        q, ids = _matrix(group["x"]), group["query"].to_numpy()
        for start in range(0, len(q), 256):
            rows, cols, distance = _best_pairs(q[start : start + 256], x, k)
            value = np.full(len(cols), np.nan) if target == ANY else x[cols, target]
            found.append(
                pd.DataFrame(
                    {
                        "query": ids[start + rows], "target": target, "donor": donor_ids[cols],
                        "distance": distance, "value": value,
                    }
                )
            )
    return pd.concat(found[1:] or found, ignore_index=True)


def nearest(queries: DataFrame, donors: DataFrame, n_features: int, k: int) -> DataFrame:
    """The ``k`` nearest donors of each query: ``query, target, donor, distance, value, place``.

    ``queries`` has columns ``query`` (a bigint id), ``x`` (an array of doubles) and ``target``,
    ``donors`` has ``donor`` and ``x``. NULL elements are left out of a distance, which is scaled
    up to the full number of features. ``target`` is the position of a feature that a donor must
    have, and then ``value`` is the donor's, or ANY. Distances are squared; ties go to the
    smaller donor.
    """
    spark = queries.sparkSession
    ship_package(spark)
    donors = _without_spare_copies(donors, k)
    blocks = _blocks(donors, n_features, donors.count())
    table = _Boxes(blocks, n_features)
    boxes = spark.sparkContext.broadcast(table)
    asked = queries.select("query", "x", "target")

    if len(table.names) <= FEW_BLOCKS:
        every = _assign(asked, lambda x, target: boxes.value.candidates(x, k, target))
        pairs = _meetings(every, blocks, k, table)
    else:
        # the closest block first: the distances found there rule out most of the others
        home = _assign(asked, lambda x, target: boxes.value.home(x, target))
        first = stage(_meetings(home, blocks, k, table), "pairs")
        found = first.groupBy("query", "target").agg(
            F.when(F.count("*") >= k, F.max("distance")).alias("limit")
        )
        bounded = asked.join(found, ["query", "target"], "left").join(
            home.select("query", "target", F.col("block").alias("home")), ["query", "target"], "left"
        )
        rest = _assign(
            bounded.fillna(float("inf"), ["limit"]).fillna("", ["home"]),
            lambda x, target, limit, home: [
                b for b in boxes.value.candidates(x, k, target, limit) if b != home
            ],
            "limit", "home",
        )
        pairs = first.unionByName(_meetings(rest, blocks, k, table))
    place = F.row_number().over(W.partitionBy("query", "target").orderBy("distance", "donor"))
    return pairs.withColumn("place", place).where(F.col("place") <= k)


def _assign(queries: DataFrame, choose: Callable, *extra: str) -> DataFrame:
    """Queries once per block that ``choose`` picks from their features, target and extras."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            facts = [batch[c] for c in ("target", *extra)]
            hits = [choose(row, *rest) for row, *rest in zip(_matrix(batch["x"]), *facts)]
            repeat = np.repeat(np.arange(len(batch)), [len(h) for h in hits])
            out = batch.iloc[repeat][["query", "x", "target"]].reset_index(drop=True)
            yield out.assign(block=pd.Series([b for h in hits for b in h], dtype=object))

    schema = "query bigint, x array<double>, target int, block string"
    return stage(queries.mapInPandas(run, schema), "candidates")


def _meetings(chosen: DataFrame, blocks: DataFrame, k: int, boxes: _Boxes) -> DataFrame:
    """Bring queries and their blocks together.

    A crowd of queries is split over several tasks, and so are the donors of large blocks, which
    every query of the block then meets part by part.
    """
    load = chosen.groupBy("block").agg(F.ceil(F.count("*") / QUERY_ROWS).alias("tasks"))
    parts = np.maximum(-(-boxes.counts // DONOR_ROWS), 1).astype(int)
    sizes = chosen.sparkSession.createDataFrame(
        [(str(name), int(n)) for name, n in zip(boxes.names, parts)], "block string, parts int"
    )
    # as many rows as there are blocks, bounded like the table of boxes
    load = F.broadcast(load.join(F.broadcast(sizes), "block"))
    left = chosen.join(load, "block").withColumns(
        {
            "task": F.pmod(F.xxhash64("query"), "tasks"),
            "part": F.explode(F.sequence(F.lit(0), F.col("parts") - 1)),
        }
    )
    right = blocks.drop("mixed").join(load, "block").withColumns(
        {
            "task": F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tasks") - 1)),
            "part": F.pmod(F.xxhash64("donor"), F.col("parts")).cast("int"),
        }
    )
    # a meeting is heavy for its size in bytes: spread blocks instead of merging small partitions
    n_tasks = max(int(parts.sum()), 1)
    keys = ("block", "task", "part")
    sides = [s.drop("tasks", "parts").repartition(n_tasks, *keys).groupBy(*keys) for s in (left, right)]
    return sides[0].cogroup(sides[1]).applyInPandas(lambda a, b: _meet(a, b, k), _PAIRS)


def _nearest_rows(q: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Row numbers in ``x`` of the ``k`` nearest rows for each row of ``q``; ties to the smaller.

    NaN is left out of a distance, which is scaled up to the full number of features. Matrix
    products find the candidates, with a margin; their exact distances decide.
    """
    k = min(k, len(x))
    known_q, known_x = ~np.isnan(q), ~np.isnan(x)
    q0, x0 = np.where(known_q, q, 0.0), np.where(known_x, x, 0.0)
    if known_q.all() and known_x.all():
        far = (q0**2).sum(1, keepdims=True) + (x0**2).sum(1) - 2 * q0 @ x0.T
    else:
        shared = known_q.astype(float) @ known_x.T
        far = (q0**2) @ known_x.T + known_q @ (x0**2).T - 2 * q0 @ x0.T
        far = np.where(shared > 0, far * q.shape[1] / np.maximum(shared, 1), np.inf)
    bar = np.partition(far, k - 1, axis=1)[:, k - 1 : k]
    scale = (q0**2).sum(1, keepdims=True) + (x0**2).sum(1).max(initial=0.0)
    row, col = np.nonzero(far <= bar + 1e-9 * scale + 1e-12)
    both = known_q[row] & known_x[col]
    gap = np.where(both, q0[row] - x0[col], 0.0)
    n = both.sum(1)
    exact = np.where(n > 0, (gap * gap).sum(1) * q.shape[1] / np.maximum(n, 1), np.inf)
    order = np.lexsort((col, exact, row))
    row, col = row[order], col[order]
    first = np.searchsorted(row, np.arange(len(q)))
    return col[first[:, None] + np.arange(k)]


def _apart(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each query to each box."""
    out = np.zeros((len(q), len(low)))
    for j in range(q.shape[1]):
        v = q[:, j, None]
        gap = np.maximum(np.maximum(low[:, j] - v, v - high[:, j]), 0.0)
        out += gap * gap
    return out


class _Leaves:
    """Rows cut at medians into leaves of neighbouring rows, each with its bounding box."""

    def __init__(self, x: np.ndarray):
        self.x = x
        #: boxes rule nothing out where values are missing or not finite
        self.whole = len(x) > LEAF_ROWS and bool(np.isfinite(x).all())
        if not self.whole:
            return
        order, open_, spans = np.arange(len(x)), [(0, len(x))], []
        while open_:
            a, b = open_.pop()
            part = x[order[a:b]]
            wide = part.max(0) - part.min(0)
            if b - a <= LEAF_ROWS or not wide.any():
                spans.append((a, b))
                continue
            axis, m = int(np.where(wide > 0, part.var(0), -1.0).argmax()), (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(part[:, axis], m)]
            open_ += [(a, a + m), (a + m, b)]
        starts, ends = zip(*sorted(spans))
        self.rows = [np.sort(order[a:b]) for a, b in zip(starts, ends)]
        self.low, self.high = (f.reduceat(x[order], starts) for f in (np.minimum, np.maximum))

    def nearest(self, q: np.ndarray, k: int) -> np.ndarray:
        """What :func:`_nearest_rows` finds among all rows."""
        if not self.whole or not np.isfinite(q).all():
            step = max(1, 4_000_000 // len(self.x))
            return np.concatenate([_nearest_rows(q[i : i + step], self.x, k) for i in range(0, len(q), step)])
        k = min(k, len(self.x))
        out = np.empty((len(q), k), dtype=np.int64)
        for start in range(0, len(q), AT_ONCE):
            some = q[start : start + AT_ONCE]
            apart = _apart(some, self.low, self.high)
            home = apart.argmin(1)
            order = np.argsort(home, kind="stable")
            for i in range(0, len(order), TOGETHER):
                at = order[i : i + TOGETHER]
                near = np.concatenate([self.rows[h] for h in np.unique(home[at])])
                gap = some[at][:, None] - self.x[near]
                square = (gap * gap).sum(2)
                limit = np.partition(square, k - 1, axis=1)[:, k - 1 : k] if len(near) >= k else np.inf
                # a hair of slack keeps rounding from excluding a box that touches the limit
                leaves = np.flatnonzero((apart[at] * (1 - 1e-9) <= limit).any(0))
                rows = np.sort(np.concatenate([self.rows[leaf] for leaf in leaves]))
                out[start + at] = rows[_nearest_rows(some[at], self.x[rows], k)]
        return out


class _Cuts:
    """Cuts at medians, each of the most crowded cell, until there are ``cells`` of them or nothing to cut."""

    def __init__(self, x: np.ndarray, cells: int):
        axis, cut, child, members = [-1], [0.0], [(0, 0)], {0: np.arange(len(x))}
        crowds = [(-len(x), 0)]
        while crowds and len(members) < cells:
            _, node = heappop(crowds)
            part = x[members[node]]
            wide = part.max(0) - part.min(0) if len(part) else np.zeros(1)
            if not wide.any():
                continue
            j = int(np.where(wide > 0, part.var(0), -1.0).argmax())
            v, middle = part[:, j], np.median(part[:, j])
            middle = v[v < v.max()].max() if middle >= v.max() else middle
            axis[node], cut[node], child[node] = j, middle, (len(axis), len(axis) + 1)
            rows = members.pop(node)
            for side in (rows[v <= middle], rows[v > middle]):
                members[len(axis)] = side
                heappush(crowds, (-len(side), len(axis)))
                axis.append(-1), cut.append(0.0), child.append((0, 0))
        self.axis, self.cut, self.child = np.array(axis), np.array(cut), np.array(child)

    def cell(self, x: np.ndarray) -> np.ndarray:
        """The number of each row's cell; -1 for rows with gaps."""
        whole = np.isfinite(x).all(1)
        at, open_ = np.zeros(len(x), dtype=np.int64), np.flatnonzero(whole)
        while len(open_ := open_[self.axis[at[open_]] >= 0]):
            node = at[open_]
            above = x[open_, self.axis[node]] > self.cut[node]
            at[open_] = self.child[node, above.astype(int)]
        return np.where(whole, at, -1)


def _shards(train: DataFrame, n_features: int, k: int) -> tuple[DataFrame, _Boxes]:
    """Labelled rows in blocks that one task can hold, and the boxes of these.

    The cuts between them follow some of the rows; all rows are in one of them. Rows with gaps are
    in blocks that nothing rules out.
    """
    # equal rows are equally far from everything, and ties go to the smaller id
    rank = F.row_number().over(W.partitionBy("x").orderBy("donor", "prediction"))
    kept = stage(train.withColumn("__rank", rank).where(F.col("__rank") <= k).drop("__rank"), "labelled")
    wide = 8 * max(n_features, 1)
    rows = max(1, min(DONOR_ROWS, SHARD_BYTES // wide))
    cells = min(-(-2 * kept.count() // rows), MAX_CELLS)
    whole = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    some = kept.where(whole).select("x").orderBy(F.xxhash64("x"), "x")
    some = some.limit(max(1, min(CUT_ROWS * cells, SHARD_BYTES // wide))).toPandas()
    cuts = kept.sparkSession.sparkContext.broadcast(_Cuts(_matrix(some["x"]), cells))

    @F.pandas_udf("int")
    def cell(x: pd.Series) -> pd.Series:
        return pd.Series(cuts.value.cell(_matrix(x)) if len(x) else [], dtype="int32")

    placed = stage(kept.withColumn("cell", cell("x")), "placed")
    # one row per cell
    crowd = F.broadcast(placed.groupBy("cell").agg(F.ceil(F.count("*") / rows).alias("parts")))
    part = F.pmod(F.xxhash64("donor", "x"), F.col("parts"))
    blocks = placed.join(crowd, "cell").select(
        "donor", "x", "prediction", (F.col("cell") < 0).alias("mixed"), F.concat_ws("/", "cell", part).alias("block")
    )
    boxes = _Boxes(blocks, n_features)
    boxes.low[boxes.mixed], boxes.high[boxes.mixed] = -np.inf, np.inf
    return blocks, boxes


_ASKED = "query bigint, key bigint, x array<double>, block string, limit double"
_FOUND = f"{_ASKED}, distance array<double>, donor array<bigint>, prediction array<string>"


def _reached(queries: DataFrame, boxes, home: bool) -> DataFrame:
    """Queries with the shard nearest to them, or with all others that are within their ``limit``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        low, high, names = boxes.value.low, boxes.value.high, boxes.value.names
        number = {name: i for i, name in enumerate(names)}
        step = max(1, 4_000_000 // len(names))
        for batch in batches:
            for start in range(0, len(batch), step):
                some = batch.iloc[start : start + step]
                q = _matrix(some["x"])
                # a query with gaps meets every shard
                whole = np.isfinite(q).all(1)[:, None]
                apart = np.where(whole, _apart(np.where(whole, q, 0.0), low, high), 0.0)
                if home:
                    row, at = np.arange(len(q)), apart.argmin(1)
                else:
                    # a hair of slack keeps rounding from excluding a box that touches the limit
                    near = apart * (1 - 1e-9) <= some["limit"].to_numpy()[:, None]
                    near[np.arange(len(q)), some["block"].map(number)] = False
                    row, at = np.nonzero(near)
                limit = np.inf if home else some["limit"].to_numpy()[row]
                yield some.iloc[row][["query", "key", "x"]].assign(block=names[at], limit=limit)

    return stage(queries.mapInPandas(run, _ASKED), "reached")


def _near_in_shard(queries: pd.DataFrame, labelled: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` nearest rows of a shard for each query, up to its limit."""
    if queries.empty or labelled.empty:
        return pd.DataFrame(columns=[column.split()[0] for column in _FOUND.split(", ")])
    labelled = labelled.sort_values(["donor", "prediction"], ignore_index=True)
    q, x = _matrix(queries["x"]), _matrix(labelled["x"])
    near = _Leaves(x).nearest(q, k)
    distance = np.concatenate([_distances(q[i : i + 256], x[near[i : i + 256]]) for i in range(0, len(q), 256)])
    within = (distance <= queries["limit"].to_numpy()[:, None]).sum(1)
    donor, label = labelled["donor"].to_numpy()[near], labelled["prediction"].to_numpy()[near]
    columns = ("query", "key", "x", "block", "limit")
    found = queries[[*columns]].assign(
        distance=[d[:n] for d, n in zip(distance, within)], donor=[d[:n] for d, n in zip(donor, within)],
        prediction=[p[:n] for p, n in zip(label, within)],
    )
    return found[within > 0]


def _distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Squared distance of each query to each of its rows, as :func:`_nearest_rows` takes it."""
    both = ~np.isnan(q[:, None]) & ~np.isnan(x)
    gap = np.where(both, q[:, None] - x, 0.0)
    n = both.sum(2)
    return np.where(n > 0, (gap * gap).sum(2) * q.shape[1] / np.maximum(n, 1), np.inf)


def _near_in_shards(chosen: DataFrame, blocks: DataFrame, n_features: int, k: int) -> DataFrame | None:
    """What the chosen queries find in their shards, a crowd of them in several tasks; None if there are none."""
    rows = max(1, min(QUERY_ROWS, SHARD_BYTES // (8 * max(n_features, 1))))
    # one row per shard
    load = [(r["block"], -(-r["count"] // rows)) for r in chosen.groupBy("block").count().collect()]
    if not load:
        return None
    tasks = F.broadcast(chosen.sparkSession.createDataFrame(load, "block string, tasks bigint"))
    left = chosen.join(tasks, "block").withColumn("task", F.pmod(F.xxhash64("query"), "tasks"))
    right = blocks.join(tasks, "block").withColumn(
        "task", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tasks") - 1))
    )
    # a meeting is heavy for its size in bytes: spread shards instead of merging small partitions
    n_tasks = sum(n for _, n in load)
    sides = [s.drop("tasks").repartition(n_tasks, "block", "task").groupBy("block", "task") for s in (left, right)]
    return sides[0].cogroup(sides[1]).applyInPandas(lambda a, b: _near_in_shard(a, b, k), _FOUND)


def _sharded_votes(train: DataFrame, test: DataFrame, n_features: int, k: int) -> DataFrame:
    """``key, prediction, votes`` of the test rows ``key, x``, whatever the number of training rows."""
    blocks, table = _shards(train, n_features, k)
    boxes = train.sparkSession.sparkContext.broadcast(table)
    asked = spread(test.where("key IS NOT NULL"), VOTER_ROWS)
    asked = asked.withColumn("query", F.monotonically_increasing_id())
    first = _near_in_shards(_reached(asked, boxes, True), blocks, n_features, k)
    if first is None:
        return asked.select("key", F.lit(None).cast("string").alias("prediction"), F.lit(0).cast("bigint").alias("votes"))
    found = stage(first, "near")
    # the distances found in the nearest shard rule out most of the others
    enough = F.when(F.size("distance") >= k, F.array_max("distance")).otherwise(F.lit(float("inf")))
    others = _reached(found.select("query", "key", "x", "block", enough.alias("limit")), boxes, False)
    rest = _near_in_shards(others, blocks, n_features, k)
    every = found if rest is None else found.unionByName(rest)
    pairs = every.select("query", "key", F.explode(F.arrays_zip("distance", "donor", "prediction")).alias("p"))
    place = F.row_number().over(W.partitionBy("query").orderBy("p.distance", "p.donor", "p.prediction"))
    nearest_ = pairs.withColumn("place", place).where(F.col("place") <= k)
    votes = nearest_.groupBy("query", "key", F.col("p.prediction").alias("prediction")).agg(F.count("*").alias("votes"))
    return votes.where("prediction IS NOT NULL").drop("query")


def knn_votes(
    train: DataFrame, test: DataFrame, key: str, x: Column, n_features: int, label: str, k: int = 5,
    max_rows: int = LABELLED_ROWS,
) -> DataFrame:
    """Votes per test row and label among its ``k`` nearest training rows.

    ``x`` is the array of features, and ``key`` a bigint that identifies a row. Up to ``max_rows``
    training rows, if they fit in LABELLED_BYTES, are one matrix that every task receives. Test rows
    then pass once; where few tasks hold many of them they are dealt out first, for their bytes say
    little of the work. More training rows are cut into shards. All of them take part either way.
    """
    spark = train.sparkSession
    ship_package(spark)
    rows = max(1, min(max_rows, LABELLED_BYTES // (8 * max(n_features, 1))))
    kept = train.select(F.col(key).alias("donor"), x.alias("x"), F.col(label).alias("prediction"))
    kind = train.schema[label].dataType.simpleString()
    if kept.count() > rows:
        text = F.col("prediction").cast("string")
        text = F.when(~F.isnan("prediction"), text) if kind in ("float", "double") else text
        # rows without a key come last
        donor = F.coalesce(F.col("donor").cast("bigint"), F.lit(2**63 - 1))
        labelled = kept.select(donor.alias("donor"), "x", text.alias("prediction"))
        asked = test.select(F.col(key).cast("bigint").alias("key"), x.alias("x"))
        votes = _sharded_votes(labelled, asked, n_features, k)
        return votes.select(F.col("key").alias(key), F.col("prediction").cast(kind).alias("prediction"), "votes")
    kept = kept.orderBy(F.xxhash64("donor"), "donor").toPandas().sort_values("donor")
    schema = f"`{key}` bigint, prediction {kind}, votes bigint"
    if kept.empty:
        return spark.createDataFrame([], schema)
    held = spark.sparkContext.broadcast((_Leaves(_matrix(kept["x"])), kept["prediction"].to_numpy()))

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        leaves, labels = held.value
        for batch in batches:
            if batch.empty:
                continue
            near = leaves.nearest(_matrix(batch["x"]), k)
            pairs = pd.DataFrame(
                {key: np.repeat(batch[key].to_numpy(), near.shape[1]), "prediction": labels[near.ravel()]}
            )
            yield pairs.groupby([key, "prediction"], sort=False).size().rename("votes").reset_index()

    asked = test.select(F.col(key).cast("bigint"), x.alias("x"))
    return spread(asked, VOTER_ROWS).mapInPandas(vote, schema)


def knn_classify(
    train: DataFrame, test: DataFrame, key: str, x: Column, n_features: int, label: str, k: int = 5
) -> DataFrame:
    """Most frequent label among the ``k`` nearest training rows; ties go to the smaller label."""
    votes = knn_votes(train, test, key, x, n_features, label, k)
    # all votes of a row come from one batch, but grouping keeps repeated rows together
    top = F.min(F.struct((-F.col("votes")).alias("neg"), F.col("prediction"))).alias("top")
    return votes.groupBy(key).agg(top).select(key, F.col("top.prediction").alias("prediction"))


def knn_impute(df: DataFrame, key: str, features: Sequence[str], k: int = 5) -> DataFrame:
    """Fill gaps with the mean of the ``k`` nearest rows that have the value.

    Distances use the features both rows have. A row that shares none with any donor gets the
    mean of the column. ``key`` is a bigint that identifies a row.
    """
    rows = df.select(key, feature_array(features).alias("x"))
    gaps = F.filter(F.sequence(F.lit(0), F.lit(len(features) - 1)), lambda i: F.get("x", i).isNull())
    queries = rows.select(F.col(key).alias("query"), "x", F.explode(gaps).alias("target"))
    donors = rows.select(F.col(key).alias("donor"), "x")
    pairs = nearest(queries, donors, len(features), k)
    fills = pairs.groupBy("query", "target").agg(F.avg("value").alias("fill"))
    wide = fills.groupBy(F.col("query").alias("__key")).agg(
        *[F.max(F.when(F.col("target") == i, F.col("fill"))).alias(f"__{c}") for i, c in enumerate(features)]
    )
    means = df.select(F.struct(*[F.avg(c).alias(c) for c in features])).scalar()
    filled = {
        c: F.coalesce(F.col(c).cast("double"), F.col(f"__{c}"), means[c]) for c in features
    }
    joined = df.join(wide, F.col(key) == F.col("__key"), "left")
    return joined.withColumns(filled).select(*df.columns)
