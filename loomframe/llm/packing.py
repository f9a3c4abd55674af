"""Packing into sequences of fixed length by shortest-pack-first over the length histogram.

Documents are tokenised and cut into pieces of at most one sequence. The counts per length, at
most one per possible length, decide the packing alone: lengths are placed longest first, each
into the pack with the most room, as packing patterns with counts. Every piece then finds its
sequence and offset from its rank among the pieces of its length.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from loomframe.llm.common import slices, text_of
from loomframe.llm.features import Words, find_words
from loomframe.llm.words import WordMemory, per_text
from loomframe.session import ship_package, stage

SEQUENCE = 2048
END_ID = 1


# --- the plan: lengths and counts only ---------------------------------------------------------

def pack_histogram(counts: np.ndarray, room: int = SEQUENCE) -> list[tuple[int, list[int]]]:
    """Patterns (how many sequences, lengths in order) that hold ``counts[n]`` pieces of length n.

    Shortest-pack-first: each length, longest first, joins the pack with the most room left.
    The number of patterns is bounded by the number of lengths, not by the number of pieces.
    """
    free: list[list[tuple[int, list[int]]]] = [[] for _ in range(room + 1)]
    for length in range(room, 0, -1):
        left, widest = int(counts[length]), room
        while left:
            while widest >= length and not free[widest]:
                widest -= 1
            if widest < length:
                free[room - length].append((left, [length]))
                break
            many, pattern = free[widest].pop()
            used = min(many, left)
            if many > used:
                free[widest].append((many - used, pattern))
            free[widest - length].append((used, [*pattern, length]))
            left -= used
    return [entry for packs in free for entry in packs]


def places(patterns: list[tuple[int, list[int]]]) -> pd.DataFrame:
    """Runs of ranks per length: the ranks from ``first`` on take ``offset`` in the sequences from ``sequence`` on."""
    taken, rows, sequence = {}, [], 0
    for many, pattern in patterns:
        offset = 0
        for length in pattern:
            first = taken.get(length, 0)
            rows.append((length, first, sequence, offset, sum(pattern)))
            taken[length] = first + many
            offset += length
        sequence += many
    return pd.DataFrame(rows, columns=["length", "first", "sequence", "offset", "filled"]).astype("int64")


# --- tokens ------------------------------------------------------------------------------------

@lru_cache(2)
def _memory(path: str) -> WordMemory:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    ids = lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    mark = ids([_MARK])[0]
    assert len(mark) == 1, "the mark between words must be one id"

    def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Words in one text, a mark after each; words that hold the mark go one by one."""
        texts = [w.decode() for w in words]
        odd = [i for i, w in enumerate(texts) if _MARK in w]
        plain = [w for w in texts if _MARK not in w] if odd else texts
        flat = np.array(ids([f" {_MARK} ".join([*plain, ""])])[0] if plain else [], np.int32)
        ends = np.flatnonzero(flat == mark[0])
        parts = flat[flat != mark[0]]
        size = np.diff(ends, prepend=-1) - 1
        if not odd:
            return parts, size
        pieces = np.split(parts, np.cumsum(size)[:-1]) if plain else []
        for i, own in zip(odd, ids([texts[i] for i in odd])):
            pieces.insert(i, np.array(own, np.int32))
        return np.concatenate(pieces), np.array([len(p) for p in pieces])

    return WordMemory(encode)


def encode_texts(texts: list[str], path: str) -> list[np.ndarray]:
    """Ids of each text.

    The tokenizer drops white space and no piece reaches across it, so the ids of a text are
    those of its parts between ASCII white space, one after the other. It also lowers the text,
    letter by letter; that is done first where all letters are Latin-1, to meet fewer words.
    """
    if not texts:
        return []
    words = find_words([t if _WIDE.search(t) else t.lower() for t in texts])
    text, start, size = _without_stops(words)
    ids, ends = _memory(path).encode(words.joined.tobytes(), start, size)
    return per_text(ids, ends, np.bincount(text, minlength=len(texts)))


def _without_stops(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with a last full stop or comma after an ASCII letter as a word of its own.

    The tokenizer splits letters from signs anyway; fewer different words are left.
    """
    last = words.start + words.size - 1
    before = words.joined[np.maximum(last - 1, 0)]
    stop = (words.size > 1) & np.isin(words.joined[last], (44, 46)) & (before >= 97) & (before <= 122)
    many = 1 + stop.astype(np.int64)
    text, start, size = (np.repeat(v, many) for v in (words.text, words.start, words.size))
    second = np.cumsum(many)[stop] - 1
    size[second - 1] -= 1
    start[second], size[second] = last[stop], 1
    return text, start, size


_WIDE = re.compile("[^\x00-\xff]")
_MARK = "\x01"

PIECES = (
    "doc_id long, start long, length long, ids array<int>, ids_crc32 long, doc_tokens long, "
    "part int, nth long"
)


def tokenise(docs: DataFrame, path: str, room: int = SEQUENCE) -> DataFrame:
    """Pieces of at most ``room`` ids; ``nth`` numbers the pieces of one length within a task."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, part = np.zeros(room + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            for some in slices(batch, 1):
                yield _pieces(some, path, room, seen, part)

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, PIECES)


def _pieces(batch: pa.RecordBatch, path: str, room: int, seen: np.ndarray, part: int) -> pa.RecordBatch:
    doc, start, length, flat, crc, total, nth = [], [], [], [], [], [], []
    encoded = encode_texts(batch.column(1).to_pylist(), path)
    for doc_id, ids in zip(batch.column(0).to_pylist(), encoded, strict=True):
        ids = np.append(ids, np.int32(END_ID))
        for at in range(0, len(ids), room):
            piece = ids[at : at + room]
            doc.append(doc_id)
            start.append(at)
            length.append(len(piece))
            flat.append(piece)
            crc.append(zlib.crc32(piece.astype("<u4").tobytes()))
            total.append(len(ids))
            nth.append(seen[len(piece)])
            seen[len(piece)] += 1
    ends = np.cumsum([0, *length]).astype(np.int32)
    ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *flat])))
    whole = lambda values: pa.array(values, pa.int64())
    return pa.RecordBatch.from_arrays(
        [whole(doc), whole(start), whole(length), ids, whole(crc), whole(total),
         pa.array([part] * len(doc), pa.int32()), whole(nth)],
        names=["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "part", "nth"],
    )


def pack(docs: DataFrame, path: str, room: int = SEQUENCE) -> DataFrame:
    """Every piece with its ids, sequence_id and offset.

    ``path``: the tokenizer's file. Returns doc_id, start, length, ids, ids_crc32, doc_tokens,
    sequence_id, offset, sequence_tokens (the ids in the whole sequence) and padding (to ``room``,
    none at a power of two). Offsets have no gaps. Null text counts as empty: such a document is
    the end id alone. Repeated rows are packed once each, an empty table gives no rows, and only
    doc_id and text are read.
    """
    pieces = stage(tokenise(docs, path, room), "pieces")
    per_task = stage(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = np.zeros(room + 1, np.int64)
    for length, n in per_task.groupBy("length").agg(F.sum("n")).collect():  # at most `room` rows
        counts[length] = n
    plan = places(pack_histogram(counts, room))
    runs = {int(n): g.drop(columns="length").to_numpy() for n, g in plan.groupby("length")}
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))

    def find(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(ranks), 3), np.int64)
        n, rank = lengths.to_numpy(), ranks.to_numpy()
        order = np.argsort(n, kind="stable")
        values, firsts = np.unique(n[order], return_index=True)
        for value, rows in zip(values, np.split(order, firsts[1:])):
            first, sequence, offset, filled = runs[int(value)].T
            k = np.searchsorted(first, rank[rows], "right") - 1
            out[rows] = np.stack([sequence[k] + rank[rows] - first[k], offset[k], filled[k]], 1)
        return pd.DataFrame(out, columns=["sequence_id", "offset", "sequence_tokens"])

    place = F.pandas_udf(find, "sequence_id long, offset long, sequence_tokens long")
    filled = F.col("place.sequence_tokens")
    power = F.bit_count(filled) == 1
    return (
        pieces.join(base, ["part", "length"])
        .withColumn("place", place("length", F.col("base") + F.col("nth")))
        .select(
            "doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "place.*",
            F.when(power, 0).otherwise(room - filled).cast("long").alias("padding"),
        )
    )
