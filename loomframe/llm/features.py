"""Vectorised words and bytes of many texts at once, and bounded samples of labelled documents."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from loomframe.llm.words import hash_words

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


@dataclass(frozen=True)
class Words:
    """Words of several texts: text number, place in the joined bytes and length."""

    joined: np.ndarray
    text: np.ndarray
    start: np.ndarray
    size: np.ndarray

    @cached_property
    def hashes(self) -> np.ndarray:
        return hash_words(self.joined, self.start, self.size)


def find_words(texts: list[str], table: bytes | None = None) -> Words:
    """All words, after translating the bytes by ``table``; ASCII white space separates them."""
    raw = [t.encode() for t in texts]
    whole = b"\n".join(raw) + b"\n"
    joined = np.frombuffer(whole.translate(table) if table else whole, np.uint8)
    blank = _BLANK[joined]
    before = np.concatenate([[True], blank[:-1]])
    start = np.flatnonzero(before & ~blank)
    end = np.flatnonzero(blank & ~before)
    first_byte = np.cumsum([0, *(len(r) + 1 for r in raw)])[:-1]
    return Words(joined, np.searchsorted(first_byte, start, "right") - 1, start, end - start)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, trains: Column, rows: int) -> DataFrame:
    """doc_id, text and label of at most ``rows`` documents whose label may be learned.

    The sample is drawn by a hash of the id, so it is the same on any partitioning. Rows without
    an id or a label do not take part; of several labels of one document the largest counts.
    """
    drawn = (
        labels.where(trains & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # at most `rows` ids and labels are broadcast
    return found.join(F.broadcast(drawn), "doc_id").limit(rows)
