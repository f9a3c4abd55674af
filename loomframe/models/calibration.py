"""Class probabilities from margins: Platt's two parameters by Newton's method on summed rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from loomframe.session import ship_package

#: Rounds, the slope at which the search ends, and what keeps the matrix of curvatures regular.
ROUNDS, TOLERANCE, RIDGE = 100, 1e-5, 1e-12


def platt_probability(margin: np.ndarray, a: float, b: float) -> np.ndarray:
    """``1 / (1 + exp(a * margin + b))``."""
    return 1 / (1 + np.exp(np.clip(a * margin + b, -700, 700)))


def probability(score: Column, a: float | Column, b: float | Column) -> Column:
    a, b = (F.lit(v) if isinstance(v, (int, float)) else v for v in (a, b))
    return 1 / (1 + F.exp(F.least(a * score + b, F.lit(700.0))))


def _sums(rows: DataFrame, points: dict[object, tuple[float, float, float, float]]) -> DataFrame:
    """``g, v``: loss, its two slopes and three curvatures of each group, at its ``a`` and ``b``.

    The last two of a point are the targets of label 1 and of all others. Numbers that change with
    every round stay out of the plan, whose code Spark would compile anew.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[object, np.ndarray] = {}
        for batch in batches:
            groups = batch.column(0).dictionary_encode()
            which = groups.indices.to_numpy(zero_copy_only=False)
            s, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            for i, g in enumerate(groups.dictionary.to_pylist()):
                if g not in points:
                    continue
                a, b, one, other = points[g]
                x, t = s[which == i], np.where(y[which == i] == 1, one, other)
                z = a * x + b
                soft = np.logaddexp(0, z)
                off, bend = t - np.exp(-soft), np.exp(z - 2 * soft)
                sums = [(t * soft - (1 - t) * (z - soft)).sum(), x @ off, off.sum(), x * x @ bend, x @ bend, bend.sum()]
                total[g] = total.get(g, 0) + np.array(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))],
            names=["g", "v"],
        )

    parts = rows.mapInArrow(run, "g string, v array<double>")
    return parts.groupBy("g").agg(Summarizer.sum(array_to_vector("v")).alias("v"))


def platt(scored: DataFrame, score: str, label: str, by: str | None = None) -> list[tuple[object, float, float]]:
    """``(value of by as text, a, b)`` per group: the parameters of :func:`probability` of label 1.

    Labels are 0 and 1; targets are drawn in from them by one row of each class, so that separable
    scores do not run away. Every round is one aggregate over all groups; the driver holds six sums
    per group. Rows without a score or a label are left out.
    """
    ship_package(scored.sparkSession)
    group = F.col(by).cast("string") if by else F.lit("")
    rows = scored.select(group.alias("g"), F.col(score).cast("double").alias("s"), F.col(label).cast("double").alias("y"))
    rows = rows.where(F.col("s").isNotNull() & F.col("y").isNotNull())
    counts = rows.groupBy("g").agg(F.count_if(F.col("y") == 1).alias("p"), F.count_if(F.col("y") != 1).alias("n")).collect()
    size = {r["g"]: (r["p"], r["n"]) for r in counts}
    state = {g: np.array([0.0, np.log((n + 1) / (p + 1))]) for g, (p, n) in size.items()}
    target = {g: ((p + 1) / (p + 2), 1 / (n + 2)) for g, (p, n) in size.items()}
    tried, best, step, running = dict(state), {}, {g: None for g in state}, set(state)
    for _ in range(ROUNDS):
        if not running:
            break
        for r in _sums(rows, {g: (*map(float, tried[g]), *target[g]) for g in running}).collect():
            g, v = r["g"], r["v"].toArray()
            if g in best and v[0] > best[g] + 1e-4 * step[g][1] * step[g][2] + 1e-9 * abs(best[g]):
                size_ = step[g][1] / 2
                if size_ < 1e-10:
                    running.discard(g)
                    continue
                step[g] = (step[g][0], size_, step[g][2])
                tried[g] = state[g] + size_ * step[g][0]
                continue
            state[g], best[g] = tried[g], v[0]
            slope = np.array([v[1], v[2]])
            if np.abs(slope).max() < TOLERANCE:
                running.discard(g)
                continue
            bend = np.array([[v[3] + RIDGE, v[4]], [v[4], v[5] + RIDGE]])
            way = -np.linalg.solve(bend, slope)
            step[g] = (way, 1.0, float(slope @ way))
            tried[g] = state[g] + way
    return [(g, float(a), float(b)) for g, (a, b) in sorted(state.items(), key=lambda item: str(item[0]))]
