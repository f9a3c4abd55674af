"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded from its bytes and words; gated
attention weighs the passages, and the weighted representation is scored. Only documents carry
labels; the attention learns which passages decide.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomframe.llm.common import in_batches, remainder, text_of
from loomframe.llm.features import labelled_sample, find_words

#: Words in a passage, in texts of any length, and passages that are in memory at once.
PASSAGE, PART = 48, 4096
#: Labelled documents the model is fitted on, and passages drawn from each for the fit, at most.
TRAIN_ROWS, TRAIN_PASSAGES = 6000, 64
THRESHOLD = 0.7
HIDDEN, GATES, ROUNDS, BATCH = 24, 12, 30, 64


# --- passages ---------------------------------------------------------------------------------

def _classes() -> np.ndarray:
    table = np.full(256, 9, np.int64)  # control characters and the rest
    for kind, members in enumerate(
        [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n",
         b".,;:", b"'\"()-", b"!?", b"#$%&*+/<=>@[\\]^_`{|}~"]
    ):
        table[list(members)] = kind
    table[128:] = 10
    return table


_CLASS = _classes()
KINDS = 11
SIZE = KINDS + 8


def _share_repeated(group: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each value whether the same value stands earlier in its group."""
    order = np.lexsort((np.arange(len(values)), values, group))
    g, v = group[order], values[order]
    again = np.zeros(len(values), bool)
    again[order[1:]] = (g[1:] == g[:-1]) & (v[1:] == v[:-1])
    return again


def passage_parts(texts: list[str], part: int = PART) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, text number) of all passages in order, at most ``part`` at a time.

    A text without words has one passage of zeros. Of the features only the share of repeated
    word sequences looks beyond the passage, at what stands earlier in the text.
    """
    words = find_words(texts)
    h, count = words.hashes, np.bincount(words.text, minlength=len(texts))
    bags = np.maximum(1, -(-count // PASSAGE))
    first_passage = np.cumsum(bags) - bags
    nth = np.arange(len(words.text)) - (np.cumsum(count) - count)[words.text]
    owner = first_passage[words.text] + nth // PASSAGE
    text = np.repeat(np.arange(len(texts)), bags)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (words.text[1:] == words.text[:-1])
    grams = h.copy()
    for k in range(1, 4):
        grams[:-k] = grams[:-k] * np.uint64(0x9E3779B97F4A7C15) + h[k:]
    again = _share_repeated(words.text, grams)
    end = np.append(words.start[1:], len(words.joined))
    for first in range(0, len(text), part):
        total = min(part, len(text) - first)
        a, b = np.searchsorted(owner, [first, first + total])
        passage, start, length = owner[a:b] - first, words.start[a:b], words.size[a:b]
        n = np.bincount(passage, minlength=total)
        per_word = np.maximum(n, 1)

        def mean(values: np.ndarray) -> np.ndarray:
            return np.bincount(passage, values, total) / per_word

        # bytes belong to the passage of the word before them
        place = np.repeat(passage, end[a:b] - start)
        body = words.joined[start[0] : end[b - 1]] if b > a else words.joined[:0]
        kinds = np.bincount(place * KINDS + _CLASS[body], minlength=total * KINDS).reshape(total, KINDS)
        size = np.minimum(length, 40).astype(float)
        mean_size = mean(size)
        features = np.column_stack(
            [
                kinds / np.maximum(kinds.sum(1, keepdims=True), 1),
                mean_size / 8,
                np.sqrt(np.maximum(mean(size**2) - mean_size**2, 0)) / 8,
                mean(same[a:b]),
                mean(_share_repeated(passage, h[a:b])),
                mean(again[a:b]),
                mean(_CLASS[words.joined[start + length - 1]] == 8),
                mean(_CLASS[words.joined[start]] == 1),
                np.log1p(n) / 4,
            ]
        )
        yield features.astype(np.float32), text[first : first + total]


def passages_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(features, text number) of all passages; a text without words has one of zeros."""
    parts = list(passage_parts(texts))
    if not parts:
        return np.zeros((0, SIZE), np.float32), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in parts]), np.concatenate([t for _, t in parts])


def draw_passages(key: int, n: int, most: int = TRAIN_PASSAGES) -> np.ndarray:
    """Places, in order, of at most ``most`` of ``n`` passages; equal for equal keys."""
    if n <= most:
        return np.arange(n)
    return np.sort(np.random.default_rng(key % (1 << 63)).choice(n, most, replace=False))


# --- the model --------------------------------------------------------------------------------

class GatedAttention:
    """Passage encoder, gated attention and the document's logit, with their gradients."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 0):
        draw = np.random.default_rng(seed)
        start = lambda a, b: draw.normal(0, 1 / np.sqrt(a), (a, b))
        self.mean, self.scale = mean, scale
        self.weights = {
            "encode": start(len(mean), HIDDEN), "encode0": np.zeros(HIDDEN),
            "tanh": start(HIDDEN, GATES), "gate": start(HIDDEN, GATES),
            "attend": start(GATES, 1)[:, 0], "score": start(HIDDEN, 1)[:, 0], "score0": np.zeros(1),
        }

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """Scaled features, representations, the gates' two factors and the attention of passages."""
        w = self.weights
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        h = np.tanh(x @ w["encode"] + w["encode0"])
        v, u = np.tanh(h @ w["tanh"]), 1 / (1 + np.exp(-(h @ w["gate"])))
        return x, h, v, u, (v * u) @ w["attend"]

    def forward(self, x: np.ndarray, bag: np.ndarray, bags: int) -> dict[str, np.ndarray]:
        w = self.weights
        x, h, v, u, s = self.encode(x)
        top = np.full(bags, -np.inf)
        np.maximum.at(top, bag, s)
        e = np.exp(s - top[bag])
        a = e / np.bincount(bag, e, bags)[bag]
        z = np.zeros((bags, h.shape[1]))
        np.add.at(z, bag, a[:, None] * h)
        return {"x": x, "h": h, "v": v, "u": u, "a": a, "z": z, "logit": z @ w["score"] + w["score0"]}

    def gradient(self, x: np.ndarray, bag: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        w, bags = self.weights, len(label)
        f = self.forward(x, bag, bags)
        error = (1 / (1 + np.exp(-f["logit"])) - label) / bags
        dz = error[:, None] * w["score"]
        da = (f["h"] * dz[bag]).sum(1)
        ds = f["a"] * (da - np.bincount(bag, f["a"] * da, bags)[bag])
        vu = ds[:, None] * w["attend"]
        dv, du = vu * f["u"] * (1 - f["v"] ** 2), vu * f["v"] * f["u"] * (1 - f["u"])
        dh = f["a"][:, None] * dz[bag] + dv @ w["tanh"].T + du @ w["gate"].T
        dx = dh * (1 - f["h"] ** 2)
        return {
            "encode": f["x"].T @ dx, "encode0": dx.sum(0), "tanh": f["h"].T @ dv, "gate": f["h"].T @ du,
            "attend": (f["v"] * f["u"]).T @ ds, "score": f["z"].T @ error, "score0": error.sum(keepdims=True),
        }

    def score(self, parts: Iterable[tuple[np.ndarray, np.ndarray]], bags: int) -> np.ndarray:
        """Scores of bags whose passages come in parts: sums of attention relative to the largest yet."""
        w = self.weights
        top, below, above = np.full(bags, -1e300), np.zeros(bags), np.zeros(bags)
        for x, bag in parts:
            _, h, _, _, s = self.encode(x)
            new = top.copy()
            np.maximum.at(new, bag, s)
            shrink, e = np.exp(top - new), np.exp(s - new[bag])
            below = below * shrink + np.bincount(bag, e, bags)
            above = above * shrink + np.bincount(bag, e * (h @ w["score"]), bags)
            top = new
        logit = above / np.where(below > 0, below, 1) + w["score0"]
        return 1 / (1 + np.exp(-logit))


def fit(x: np.ndarray, bag: np.ndarray, label: np.ndarray) -> GatedAttention:
    """Adam over batches of whole bags; ``bag`` counts up from 0."""
    scale = x.std(0)
    model = GatedAttention(x.mean(0), np.where(scale > 1e-6, scale, 1.0))
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    cuts = np.searchsorted(bag, np.arange(len(label) + 1))
    draw, step = np.random.default_rng(1), 0
    for _ in range(ROUNDS):
        order = draw.permutation(len(label))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            rows = np.concatenate([np.arange(cuts[b], cuts[b + 1]) for b in some])
            own = np.repeat(np.arange(len(some)), cuts[some + 1] - cuts[some])
            step += 1
            for k, g in model.gradient(x[rows], own, label[some]).items():
                g = g + 1e-4 * model.weights[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                rate = 0.005 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                model.weights[k] -= rate * first[k] / (np.sqrt(second[k]) + 1e-8)
    return model


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> GatedAttention | None:
    """The model of ``labels.quality`` from at most ``rows`` documents; None without both labels.

    Labels of the held-out remainder are not read. The features of these documents, at most
    TRAIN_PASSAGES times SIZE numbers each, are fitted on the driver. A longer document takes
    part with a random draw of its passages, which depends on its id and length only.
    """
    sample = labelled_sample(docs, labels, "quality", remainder("doc_id", 4) != 2, rows)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, text = passages_of(batch.column(1).to_pylist())
        cuts = np.searchsorted(text, np.arange(batch.num_rows + 1))
        ids = batch.column(0).to_pylist()
        flat = [x[a + draw_passages(i, b - a)].ravel().tolist() for i, a, b in zip(ids, cuts[:-1], cuts[1:])]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(flat, pa.list_(pa.float32()))],
            names=["doc_id", "label", "x"],
        )

    bags = in_batches(
        sample.select("doc_id", "text", "label"), run, "doc_id long, label double, x array<float>", 1
    ).toPandas()
    if bags["label"].nunique() < 2:
        return None
    bags = bags.sort_values("doc_id", kind="stable")
    parts = [np.asarray(v, np.float32).reshape(-1, SIZE) for v in bags["x"]]
    bag = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return fit(np.concatenate(parts).astype(float), bag, (bags["label"].to_numpy() > 0).astype(float))


def score_texts(model: GatedAttention | None, texts: list[str]) -> np.ndarray:
    """Scores between 0 and 1; 0.5 each without a model."""
    if model is None or not texts:
        return np.full(len(texts), 0.5)
    return model.score(passage_parts(texts), len(texts))


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Null text counts as empty and gets a score like any other. Rows without doc_id are scored;
    repeated rows get equal scores; an empty table gives no rows. If the labels that may be
    learned hold one class only, every score is 0.5. Only doc_id and text of ``docs`` are read.
    """
    model = train(docs, labels)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(score_texts(model, batch.column(1).to_pylist()))],
            names=["doc_id", "score"],
        )

    scored = in_batches(
        docs.select(F.col("doc_id").cast("long"), text_of().alias("text")), run, "doc_id long, score double", 1
    )
    return scored.select(
        "doc_id",
        (remainder("doc_id", 4) == 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows whose score reaches the threshold, with all their columns; one pass, no shuffle."""
    model, at = train(docs, labels), docs.columns.index("text")
    if model is None:
        return docs
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column(at).to_pylist()]
        return batch.filter(pa.array(score_texts(model, texts) >= THRESHOLD))

    return in_batches(docs, run, schema, at)
