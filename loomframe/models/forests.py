"""Decision trees of any depth, all trees of a run grown level by level in the same scans.

Features are cut into bins once. A scan sends every row down all trees and counts, for each node of
the last level, rows by feature, bin and class; the counts of a node meet in a shuffle, where its
best split is chosen. Only splits come back to the driver. A run of many trees, folds or settings
takes as many scans as its deepest tree has levels.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol, HasProbabilityCol
from pyspark.sql import DataFrame, functions as F

from loomframe.models.many import poisson_copies
from loomframe.session import ship_package, stage

#: Cells of counts a task holds before it passes them on.
CELLS = 4_000_000


@dataclass
class Tree:
    """Nodes by number: the feature and last left bin of a split (-1 in a leaf), children, class counts."""

    fold: int | None = None
    bag: int | None = None
    impurity: str = "gini"
    feature: list[int] = field(default_factory=lambda: [-1])
    last: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    counts: list[np.ndarray | None] = field(default_factory=lambda: [None])
    level: list[int] = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, last: int, left: np.ndarray, right: np.ndarray) -> list[int]:
        """Give a leaf two children, and return their numbers."""
        children = [len(self.feature), len(self.feature) + 1]
        self.feature[node], self.last[node] = feature, last
        self.left[node], self.right[node] = children
        for counts in (left, right):
            self.feature.append(-1)
            self.last.append(0)
            self.left.append(0)
            self.right.append(0)
            self.counts.append(counts)
            self.level.append(self.level[node] + 1)
        return children

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        feature, last, left, right = (np.array(a) for a in (self.feature, self.last, self.left, self.right))
        at = np.zeros(len(bins), np.int64)
        moving = np.flatnonzero(feature[at] >= 0)
        while len(moving):
            node = at[moving]
            goes = bins[moving, feature[node]] <= last[node]
            at[moving] = np.where(goes, left[node], right[node])
            moving = moving[feature[at[moving]] >= 0]
        return at


def impurity(kind: str, counts: np.ndarray) -> np.ndarray:
    """Impurity of counts by class (last axis), times their number."""
    n = counts.sum(-1, keepdims=True)
    share = counts / np.maximum(n, 1e-300)
    if kind == "gini":
        return n[..., 0] * (1 - (share * share).sum(-1))
    return -n[..., 0] * (share * np.log2(np.maximum(share, 1e-300))).sum(-1)


def best_split(
    counts: np.ndarray, kind: str, allowed: Sequence[int], least: float
) -> tuple[int, int, np.ndarray, np.ndarray] | None:
    """feature, last left bin and class counts on both sides, from counts by feature, bin and class.

    The largest gain; of equal ones the first feature, then the first bin. None if no split has
    ``least`` rows on both sides and a gain.
    """
    whole, best, gain = counts[0].sum(0), None, 1e-12
    for f in allowed:
        left = counts[f].cumsum(0)[:-1]
        right = whole - left
        gains = impurity(kind, whole) - impurity(kind, left) - impurity(kind, right)
        gains[(left.sum(1) < least) | (right.sum(1) < least)] = -1
        b = int(gains.argmax()) if len(gains) else 0
        if len(gains) and gains[b] > gain * (1 + 1e-9):
            best, gain = (f, b, left[b], right[b]), gains[b]
    return best


def cut_points(df: DataFrame, column: str, max_bins: int) -> list[list[float]]:
    """Ascending upper ends of all bins but the last, per feature: from quantiles, or all values if few."""
    x = df.select(vector_to_array(column).alias("x"))
    first = x.first()
    if first is None:
        raise ValueError("no rows to fit on")
    shares = [i / max_bins for i in range(1, max_bins + 1)]
    found = x.agg(*[F.percentile_approx(F.col("x")[i], shares, 100_000).alias(f"q{i}") for i in range(len(first["x"]))]).first()
    return [sorted(set(q))[:-1] for q in found]


def binned(
    df: DataFrame, column: str, label: str, cuts: list[list[float]], classes: Sequence[float], keep: Sequence[str] = (),
    fold: object = None, key: str | None = None, bags: Sequence[int] = (), frac: float = 1.0,
) -> DataFrame:
    """Stored rows: ``place`` of the class, ``fold``, ``copies`` per seed in ``bags``, ``bins`` as bytes."""
    ship_package(df.sparkSession)
    edges = [np.array(c) for c in cuts]

    @F.pandas_udf("binary")
    def to_bins(values: pd.Series) -> pd.Series:
        if values.empty:
            return pd.Series([], dtype=object)
        x = np.stack(values.to_numpy())
        out = np.stack([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(edges)], axis=1).astype(np.uint8)
        return pd.Series([row.tobytes() for row in out])

    place = F.array_position(F.array(*[F.lit(float(c)) for c in classes]), F.col(label).cast("double")) - 1
    copies = poisson_copies(key, frac, bags) if len(bags) else F.array().cast("array<tinyint>")
    return stage(
        df.select(
            *keep, place.cast("int").alias("place"), (F.lit(-1) if fold is None else fold).cast("int").alias("fold"),
            copies.alias("copies"), to_bins(vector_to_array(column)).alias("bins"),
        ),
        "binned",
    )


def grow(
    rows: DataFrame, trees: list[Tree], widths: Sequence[int], n_classes: int, max_depth: int | None = None,
    per_split: int | None = None, least: float = 1, seed: int = 0,
) -> list[Tree]:
    """Grow all trees to the end. ``widths`` are the bins of each feature, ``per_split`` the number of
    features drawn for each node; no ``max_depth`` is no limit. ``rows`` come from :func:`binned`."""
    d, most = len(widths), max(widths)
    frontier = {t: [0] for t in range(len(trees))}
    while any(frontier.values()):
        wanted = {t: nodes for t, nodes in frontier.items() if nodes}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[tuple[int, int], np.ndarray] = defaultdict(lambda: np.zeros((d, most, n_classes)))

            def out() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in total], pa.int32()), pa.array([k[1] for k in total], pa.int64()),
                     pa.array([v.tobytes() for v in total.values()], pa.binary())],
                    names=["tree", "node", "v"],
                )

            for batch in batches:
                n = batch.num_rows
                if not n:
                    continue
                place, fold = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                copies = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                bins = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(n, d)
                for t, nodes in wanted.items():
                    tree = trees[t]
                    weight = np.ones(n) if tree.fold is None else (fold != tree.fold).astype(float)
                    weight = weight if tree.bag is None else weight * copies[:, tree.bag]
                    used = np.flatnonzero(weight > 0)
                    leaf, order = tree.leaves(bins[used]), np.array(nodes)
                    at = np.minimum(np.searchsorted(order, leaf), len(order) - 1)
                    here = order[at] == leaf
                    used, at = used[here], at[here]
                    present, local = np.unique(at, return_inverse=True)
                    cells = np.zeros((len(present), d, most, n_classes))
                    for f in range(d):
                        flat = (local * most + bins[used, f]) * n_classes + place[used]
                        sums = np.bincount(flat, weight[used], minlength=len(present) * most * n_classes)
                        cells[:, f] = sums.reshape(len(present), most, n_classes)
                    for i, p in enumerate(present):
                        total[t, int(order[p])] += cells[i]
                    if len(total) * d * most * n_classes > CELLS:
                        yield out()
                        total.clear()
            yield out()

        def choose(group: pa.Table) -> pa.Table:
            t, node = group["tree"][0].as_py(), group["node"][0].as_py()
            counts = sum(np.frombuffer(v.as_buffer()) for v in group["v"]).reshape(d, most, n_classes)
            allowed: Sequence[int] = range(d)
            if per_split is not None and per_split < d:
                allowed = sorted(np.random.default_rng([seed, t, node]).permutation(d)[:per_split])
            found = best_split(counts, trees[t].impurity, allowed, least)
            f, b, left, right = found or (-1, 0, counts[0].sum(0), np.zeros(n_classes))
            return pa.table(
                {"tree": pa.array([t], pa.int32()), "node": pa.array([node], pa.int64()), "f": pa.array([f], pa.int32()),
                 "b": pa.array([b], pa.int32()), "l": pa.array([list(map(float, left))]), "r": pa.array([list(map(float, right))])}
            )

        counted = rows.select("place", "fold", "copies", "bins").mapInArrow(run, "tree int, node long, v binary")
        splits = counted.groupBy("tree", "node").applyInArrow(
            choose, "tree int, node long, f int, b int, l array<double>, r array<double>"
        ).toArrow().to_pylist()  # one row per node of this level
        frontier = {t: [] for t in wanted}
        for s in sorted(splits, key=lambda s: (s["tree"], s["node"])):
            tree, left, right = trees[s["tree"]], np.array(s["l"]), np.array(s["r"])
            tree.counts[s["node"]] = left + right
            if s["f"] < 0:
                continue
            children = tree.split(s["node"], s["f"], s["b"], left, right)
            if max_depth is None or tree.level[children[0]] < max_depth:
                frontier[s["tree"]] += [c for c in children if np.count_nonzero(tree.counts[c]) > 1]
    return trees


class Forest(Estimator, HasLabelCol):
    """Trees of any depth, each on Poisson draws of the rows, with a draw of features at each split.

    ``n`` 1 with ``frac`` None is a single tree on all rows and features. Probabilities are the mean
    of the trees' leaf shares; a tie goes to the first class.
    """

    def __init__(
        self, key: str, n: int = 100, max_depth: int | None = None, subset: str | None = "sqrt", impurity: str = "gini",
        max_bins: int = 32, frac: float | None = 1.0, column: str = "raw", label: str = "label", seed: int = 0,
    ):
        super().__init__()
        if not 2 <= max_bins <= 256:
            raise ValueError("max_bins is to be between 2 and 256")
        self.key, self.n, self.max_depth, self.subset, self.impurity = key, n, max_depth, subset, impurity
        self.max_bins, self.frac, self.column, self.label, self.seed = max_bins, frac, column, label, seed

    def _fit(self, df: DataFrame) -> "ForestModel":
        cuts = cut_points(df, self.column, self.max_bins)
        classes = sorted(r[0] for r in df.select(F.col(self.label).cast("double")).distinct().collect())
        bags = [] if self.frac is None else range(self.seed, self.seed + self.n)
        rows = binned(
            df, self.column, self.label, cuts, classes, key=self.key, bags=bags, frac=self.frac or 1.0
        )
        trees = [Tree(bag=None if self.frac is None else i, impurity=self.impurity) for i in range(self.n)]
        d = len(cuts)
        per_split = {"sqrt": int(d**0.5), "log2": int(np.log2(d))}.get(self.subset or "", d)
        grow(rows, trees, [len(c) + 1 for c in cuts], len(classes), self.max_depth, max(per_split, 1), seed=self.seed)
        return ForestModel(trees, cuts, classes, self.column)


class ForestModel(Model, HasPredictionCol, HasProbabilityCol):
    def __init__(self, trees: list[Tree], cuts: list[list[float]], classes: list[float], column: str):
        super().__init__()
        self.trees, self.cuts, self.classes, self.column = trees, cuts, classes, column

    @property
    def depth(self) -> int:
        return max(max(t.level) for t in self.trees)

    def shares(self, x: np.ndarray) -> np.ndarray:
        bins = np.stack([np.searchsorted(np.array(c), x[:, i], "left") for i, c in enumerate(self.cuts)], axis=1)
        total = np.zeros((len(x), len(self.classes)))
        for tree in self.trees:
            counts = np.array([np.zeros(len(self.classes)) if c is None else c for c in tree.counts])
            total += (counts / np.maximum(counts.sum(1, keepdims=True), 1))[tree.leaves(bins)]
        return total / len(self.trees)

    def _transform(self, df: DataFrame) -> DataFrame:
        ship_package(df.sparkSession)

        @F.pandas_udf("array<double>")
        def shares(values: pd.Series) -> pd.Series:
            return values if values.empty else pd.Series(list(self.shares(np.stack(values.to_numpy()))))

        scored = df.withColumn("__shares", shares(vector_to_array(self.column)))
        best = F.array_position("__shares", F.array_max("__shares")).cast("int") - 1
        return scored.withColumns(
            {"probability": array_to_vector("__shares"),
             "prediction": F.get(F.array(*[F.lit(c) for c in self.classes]), best)}
        ).drop("__shares")
