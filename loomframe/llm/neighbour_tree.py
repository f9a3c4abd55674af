"""Approximate nearest neighbours by a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample; every row is then indexed under the leaf it descends to.
A query keeps the nodes it has met in a priority queue and always opens the nearest, so it meets
leaves in order of promise. How many leaves it opens is calibrated: the number is widened until
queries from the sample find the wanted share of their true neighbours.

Leaves and queries meet in blocks of bounded size. Of equal vectors only as many are kept as a
result can name, so a vector that half of all rows share costs no more than another.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from loomframe.session import ship_package, stage

#: Rows the tree is fitted on, at most; children of a node; levels below the root.
SAMPLE, BRANCH, LEVELS = 20_000, 16, 2
#: Neighbours asked for, share of them to be found in calibration, queries used for it.
NEAREST, RECALL, TRIALS = 5, 0.98, 500
#: Rows and queries that meet in one task.
ROW_BLOCK, QUERY_BLOCK = 8192, 8192


# --- the tree ---------------------------------------------------------------------------------

@dataclass(frozen=True)
class Tree:
    """Centres of the children of every inner node: node -> (children, dimensions)."""

    centres: dict[int, np.ndarray]
    branch: int
    levels: int

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each unit vector, by descending to the nearest child."""
        node = np.zeros(len(x), np.int64)
        for _ in range(self.levels):
            below = np.empty(len(x), np.int64)
            for parent in np.unique(node):
                rows = np.flatnonzero(node == parent)
                below[rows] = (x[rows] @ self.centres[parent].T).argmax(1)
            node = node * self.branch + 1 + below
        return node

    def leaves(self, q: np.ndarray, counts: dict[int, int], want: int, least: int) -> list[int]:
        """Leaves in the order a query opens them: ``want`` of them, more while they hold fewer
        than ``least`` rows. Leaves without rows are not counted."""
        queue, found, rows = [(-1.0, 0, 0)], [], 0
        while queue and (len(found) < want or rows < least):
            _, depth, node = heapq.heappop(queue)
            if depth == self.levels:
                if counts.get(node, 0):
                    found.append(node)
                    rows += counts[node]
                continue
            for child, near in enumerate((self.centres[node] @ q).tolist()):
                heapq.heappush(queue, (-near, depth + 1, node * self.branch + 1 + child))
        return found


def _k_means(x: np.ndarray, k: int, draw: np.random.Generator) -> np.ndarray:
    """Unit centres of unit vectors; k distant beginnings, then ten rounds."""
    if not len(x):
        return np.zeros((1, x.shape[1]))
    chosen = [int(draw.integers(len(x)))]
    near = x @ x[chosen[0]]
    for _ in range(min(k, len(x)) - 1):
        weight = np.maximum(1 - near, 0) + 1e-12
        chosen.append(int(draw.choice(len(x), p=weight / weight.sum())))
        near = np.maximum(near, x @ x[chosen[-1]])
    centres = x[chosen]
    for _ in range(10):
        own = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 1e-12, sums / np.maximum(size, 1e-12), centres)
    return centres


def build(sample: np.ndarray, branch: int = BRANCH, levels: int = LEVELS, seed: int = 0) -> Tree:
    """The tree of a sample of unit vectors."""
    draw, centres = np.random.default_rng(seed), {}
    parts = {0: np.arange(len(sample))}
    for _ in range(levels):
        below = {}
        for node, rows in parts.items():
            centres[node] = _k_means(sample[rows], branch, draw)
            own = (sample[rows] @ centres[node].T).argmax(1)
            for child in range(len(centres[node])):
                below[node * branch + 1 + child] = rows[own == child]
        parts = below
    return Tree(centres, branch, levels)


def calibrate(tree: Tree, sample: np.ndarray, recall: float = RECALL, nearest: int = NEAREST) -> int:
    """The number of leaves after which queries from the sample have found their neighbours."""
    leaf = tree.leaf_of(sample)
    counts = dict(zip(*(v.tolist() for v in np.unique(leaf, return_counts=True))))
    ranks = []
    for i in range(0, len(sample), max(1, len(sample) // TRIALS)):
        near = sample @ sample[i]
        near[i] = -2
        best = np.argpartition(-near, min(nearest, len(near) - 1))[:nearest]
        order = {n: k for k, n in enumerate(tree.leaves(sample[i], counts, len(counts), 0), 1)}
        ranks += [order[n] for n in leaf[best[best != i]].tolist()]
    if not ranks:
        return len(counts)
    return int(np.quantile(ranks, recall, method="higher"))


# --- the search -------------------------------------------------------------------------------

def usable(vector: Column) -> Column:
    """Not null, finite throughout and not zero."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def _matrix(column: pd.Series | pa.Array) -> np.ndarray:
    return np.array([np.asarray(v, float) for v in column]).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def search(rows: DataFrame, is_query: Column, nearest: int = NEAREST, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id and score of the nearest found rows of each query.

    ``rows``: vec_id and embedding; ``is_query`` chooses the queries among them. Score is the
    cosine in double precision; ties go to the smaller vec_id. A query's own vec_id is never its
    candidate. Vectors that are null, zero or hold null or non-finite numbers take no part, nor do
    rows without vec_id or of another dimension than most of the sample; a repeated row counts
    once, and a query with several vectors asks with the smallest. If there are fewer candidates than asked, all of them are returned; an empty table gives
    no rows. Other columns are not read.
    """
    spark = rows.sparkSession
    ship_package(spark)
    clean = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    clean = clean.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    drawn = clean.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toPandas()["v"]
    if not len(drawn):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = int(drawn.map(len).mode()[0])
    sample = _unit(_matrix(drawn[drawn.map(len) == width]))
    tree = build(np.unique(sample, axis=0))
    want = calibrate(tree, sample, recall, nearest)

    def descend(batch: pa.RecordBatch) -> pa.RecordBatch:
        leaf = tree.leaf_of(_unit(_matrix(batch.column(1).to_pylist()))) if batch.num_rows else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["vec_id", "v", "leaf"])

    indexed = clean.where(F.size("v") == width).select("vec_id", "v")
    # of equal vectors the smallest ids alone can be named: one more than asked, for the query itself
    first = Window.partitionBy("v").orderBy("vec_id")
    kept = indexed.withColumn("k", F.dense_rank().over(first)).where(F.col("k") <= nearest + 1)
    kept = kept.dropDuplicates(["vec_id", "v"]).select("vec_id", "v")
    index = stage(_in_rows(kept, descend, "vec_id long, v array<double>, leaf long"), "index")
    counts = {r["leaf"]: r["count"] for r in index.groupBy("leaf").count().collect()}  # one row a leaf

    def routes(batch: pa.RecordBatch) -> pa.RecordBatch:
        units = _unit(_matrix(batch.column(1).to_pylist())) if batch.num_rows else []
        opened = [tree.leaves(q, counts, want, 4 * nearest) for q in units]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(opened, pa.list_(pa.int64()))], names=["query_id", "v", "leaves"]
        )

    asked = indexed.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    asked = _in_rows(asked, routes, "query_id long, v array<double>, leaves array<long>")
    asked = stage(asked.select("query_id", "v", F.explode("leaves").alias("leaf")), "queries")
    meant = {r["leaf"]: r["count"] for r in asked.groupBy("leaf").count().collect()}
    parts = lambda sizes, block: F.create_map(
        *[F.lit(x) for n, c in sorted(sizes.items()) for x in (n, -(-c // block))]
    )
    if not meant:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    row_parts, query_parts = parts(counts, ROW_BLOCK), parts(meant, QUERY_BLOCK)
    leaf = F.col("leaf")
    own = lambda key, many: F.pmod(F.xxhash64(key), many[leaf]).cast("int")
    every = lambda many: F.explode(F.sequence(F.lit(0), (many[leaf] - 1).cast("int")))
    left = asked.select("query_id", "v", "leaf", own("query_id", query_parts).alias("qb"), every(row_parts).alias("rb"))
    right = (
        index.where(leaf.isin(sorted(meant)))
        .select("vec_id", "v", "leaf", own("vec_id", row_parts).alias("rb"), every(query_parts).alias("qb"))
    )

    def meet(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(members):
            members = members.sort_values("vec_id")
            x, ids = _matrix(members["v"]), members["vec_id"].to_numpy()
            size = np.sqrt((x * x).sum(1))
            unit = x / size[:, None]
            q, q_ids = _matrix(queries["v"]), queries["query_id"].to_numpy()
            q_size = np.sqrt((q * q).sum(1))
            for at in range(0, len(q), 256):
                near = (q[at : at + 256] / q_size[at : at + 256, None]) @ unit.T
                # a margin, as products round differently; the exact measure decides
                top = min(2 * nearest + 4, len(ids))
                bar = -np.partition(-near, top - 1, axis=1)[:, top - 1]
                a, b = np.nonzero(near >= bar[:, None] - 1e-9)
                a += at
                score = (q[a] * x[b]).sum(1) / (q_size[a] * size[b])
                fine = q_ids[a] != ids[b]
                out.append(pd.DataFrame({"query_id": q_ids[a], "vec_id": ids[b], "score": score})[fine])
        found = pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        found = found.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        return found.groupby("query_id").head(nearest).astype({"query_id": "int64", "vec_id": "int64"})

    found = left.groupBy("leaf", "rb", "qb").cogroup(right.groupBy("leaf", "rb", "qb")).applyInPandas(
        meet, "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _in_rows(df: DataFrame, function, schema: str) -> DataFrame:
    """:func:`in_batches` by rows alone."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                yield function(batch.slice(at, 4096))

    return df.mapInArrow(run, schema)
