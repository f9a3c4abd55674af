"""Exact dedup against immutable snapshots, screened by binary-fuse filters.

A snapshot holds one row per distinct text: digest, smallest doc_id, rows. It never changes, so
one static filter per bucket of digests stands for it. Incoming texts are grouped among
themselves by digest first; a new digest that its bucket's filter denies is new for certain.
Digests that pass meet the exact bucket, and there the texts themselves are compared.

Texts are equal when they are identical after each run of ASCII white space became one space.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from loomframe.llm.common import one_per_key, text_of, whole_row
from loomframe.session import ship_package, stage

#: Distinct digests that one filter holds on average; buckets grow in number, not in size.
BUCKET_ROWS = 200_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def digests(docs: DataFrame) -> DataFrame:
    """One row per (doc_id, text): the text's SHA-256 and how often the row is repeated."""
    digest = F.unhex(F.sha2(normalised(text_of()).cast("binary"), 256))
    return docs.select("doc_id", digest.alias("digest")).groupBy("doc_id", "digest").agg(
        F.count(F.lit(1)).alias("copies")
    )


# --- the filter -------------------------------------------------------------------------------

def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    x = keys ^ np.uint64(seed)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _slots(mixed: np.ndarray, segments: int, size: int) -> np.ndarray:
    """Three slots per key, in three neighbouring segments."""
    first = ((mixed >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    base = first * np.uint64(size)
    mask = np.uint64(size - 1)
    return np.stack(
        [
            base + (mixed & mask),
            base + np.uint64(size) + ((mixed >> np.uint64(11)) & mask),
            base + np.uint64(2 * size) + ((mixed >> np.uint64(22)) & mask),
        ]
    ).astype(np.int64)


def _prints(mixed: np.ndarray) -> np.ndarray:
    return (mixed ^ (mixed >> np.uint64(17))).astype(np.uint16)


def build_filter(keys: np.ndarray) -> bytes:
    """A 3-wise binary-fuse filter with 16-bit fingerprints over distinct 64-bit keys.

    Keys are peeled in rounds: a round takes all keys that are alone in some slot, and the slots
    are filled in the reverse order of the rounds.
    """
    keys = np.unique(keys.astype(np.uint64))
    n = len(keys)
    size = 1 << max(2, min(18, int(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
    segments = max(1, -(-int(n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))) // size))
    for seed in range(1, 200):
        if seed % 20 == 0:
            segments += 1 + segments // 10
        slots = _slots(mixed := _mix(keys, seed), segments, size)
        width = (segments + 2) * size
        count = np.bincount(slots.ravel(), minlength=width)
        owner = np.zeros(width, np.int64)  # xor of the keys' numbers in a slot
        for row in slots:
            np.bitwise_xor.at(owner, row, np.arange(n))
        rounds, left = [], n
        while left:
            alone = np.flatnonzero(count == 1)
            if not len(alone):
                break
            peeled, where = np.unique(owner[alone], return_index=True)
            rounds.append((peeled, alone[where]))
            for row in slots[:, peeled]:
                np.subtract.at(count, row, 1)
                np.bitwise_xor.at(owner, row, peeled)
            left -= len(peeled)
        if left:
            continue
        table, prints = np.zeros(width, np.uint16), _prints(mixed)
        for peeled, where in reversed(rounds):
            a, b, c = slots[:, peeled]
            table[where] = 0
            table[where] = prints[peeled] ^ table[a] ^ table[b] ^ table[c]
        return np.array([seed, segments, size], "<i8").tobytes() + table.astype("<u2").tobytes()
    raise ValueError("the filter cannot be built")  # not seen: each seed succeeds nearly always


def in_filter(blob: bytes, keys: np.ndarray) -> np.ndarray:
    """False: certainly not among the filter's keys."""
    seed, segments, size = np.frombuffer(blob[:24], "<i8").tolist()
    table = np.frombuffer(blob[24:], "<u2")
    mixed = _mix(keys.astype(np.uint64), seed)
    a, b, c = _slots(mixed, segments, size)
    return (table[a] ^ table[b] ^ table[c]) == _prints(mixed)


def _keys(values: pd.Series) -> np.ndarray:
    """The digest's second eight bytes; the bucket is taken from the first ones."""
    return np.frombuffer(b"".join(v[8:16] for v in values), "<u8")


# --- snapshots --------------------------------------------------------------------------------

@dataclass(frozen=True)
class Snapshot:
    """``members``: doc_id, digest, copies; ``rows``: digest, keep_id, group_size; ``filters``:
    bucket, filter; ``docs``: the texts."""

    members: DataFrame
    rows: DataFrame
    filters: DataFrame
    buckets: int
    docs: DataFrame


def _bucket(buckets: int) -> Column:
    # hash() is free of the digest bytes that the filter's keys use
    return F.pmod(F.hash(F.substring("digest", 1, 8)), F.lit(buckets))


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(
        F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")
    )


def freeze(docs: DataFrame) -> Snapshot:
    """An immutable snapshot of ``docs``."""
    ship_package(docs.sparkSession)
    members = stage(digests(docs), "members")
    held = stage(_groups(members), "snapshot")
    buckets = max(1, -(-held.count() // BUCKET_ROWS))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bucket": group["bucket"][:1], "filter": [build_filter(_keys(group["digest"]))]})

    filters = (
        held.select(_bucket(buckets).alias("bucket"), "digest")
        .groupBy("bucket")
        .applyInPandas(build, "bucket int, filter binary")
    )
    return Snapshot(members, held, stage(filters, "filters"), buckets, docs)


def screen(incoming: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The digests of ``incoming`` (one row each) that the snapshot may hold."""
    ship_package(incoming.sparkSession)

    def keep(group: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        if group.empty or filters.empty:
            return group[["digest", "keep_id"]][:0]
        return group.loc[in_filter(filters["filter"].iloc[0], _keys(group["digest"])), ["digest", "keep_id"]]

    keyed = incoming.select(_bucket(snapshot.buckets).alias("bucket"), "digest", "keep_id")
    return (
        keyed.groupBy("bucket")
        .cogroup(snapshot.filters.groupBy("bucket"))
        .applyInPandas(keep, "digest binary, keep_id long")
    )


def confirm(maybe: DataFrame, incoming_docs: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Of the screened digests, those whose text equals the snapshot's text byte for byte."""
    pairs = maybe.withColumnRenamed("keep_id", "new_id").join(
        snapshot.rows.select("digest", F.col("keep_id").alias("old_id")), "digest"
    )

    def texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
        """The normalised text of each asked id that has the asked digest."""
        keyed = docs.select(F.col("doc_id").alias("id"), normalised(text_of()).cast("binary").alias("body"))
        wanted = ids.select("id", "digest")
        return (
            wanted.join(keyed, wanted.id.eqNullSafe(keyed.id))
            .where(F.unhex(F.sha2("body", 256)) == F.col("digest"))
            .select("digest", "body")
        )

    new = texts(incoming_docs, pairs.select(F.col("new_id").alias("id"), "digest"))
    old = texts(snapshot.docs, pairs.select(F.col("old_id").alias("id"), "digest"))
    both = new.select("digest", F.col("body").alias("left")).join(old, "digest")
    return both.where("left = body").select("digest").distinct()


def exact_dedup(incoming: DataFrame, snapshots: list[Snapshot]) -> DataFrame:
    """Groups of equal texts over the snapshots and the incoming documents.

    Snapshots share no text with each other: each was new to the earlier ones. Returns one row
    per row of any of them: doc_id, keep_id (the smallest doc_id of the group, nulls last),
    group_size, kept, text_sha256. Of rows repeated with one doc_id, one is kept. Null text
    counts as empty. An empty table gives no rows. Only doc_id and text are read, so other
    columns may have any name.
    """
    rows = stage(digests(incoming), "digests")
    groups = stage(_groups(rows), "groups")
    found = [confirm(screen(groups, s), incoming, s) for s in snapshots]
    if not found:
        return _label(rows, groups)
    known = stage(reduce(DataFrame.unionByName, found), "known")
    everyone = reduce(DataFrame.unionByName, [groups, *(s.rows for s in snapshots)])
    together = everyone.join(known, "digest", "left_semi").groupBy("digest").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )
    alone = everyone.join(known, "digest", "left_anti")
    members = reduce(DataFrame.unionByName, [rows, *(s.members for s in snapshots)])
    return _label(members, together.unionByName(alone))


def _label(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Each (doc_id, digest) with its group, repeated as often as its row was."""
    copy = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    first = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return (
        rows.join(groups, "digest")
        .select("doc_id", "keep_id", "group_size", copy, "digest")
        .select(
            "doc_id", "keep_id", "group_size", first.alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )


def dedup_table(docs: DataFrame) -> DataFrame:
    """Exact dedup inside one table: its lower half by doc_id is the snapshot, the rest arrives.

    Both halves are whole; the cut only says which texts stand behind a filter. Rows without a
    doc_id arrive.
    """
    cut = docs.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    low = F.coalesce(F.col("doc_id") <= F.lit(cut).cast("long"), F.lit(False))
    return exact_dedup(docs.where(~low), [freeze(docs.where(low))])


def keep_first(docs: DataFrame) -> DataFrame:
    """One whole row per distinct text: that of the smallest doc_id; columns as they are.

    Null text counts as empty, and rows without a doc_id come last. Of rows that share doc_id and
    text the one with the smallest hash of all its columns stays. Other columns may have any name;
    an empty table gives none.
    """
    key = lambda digest: F.concat_ws(":", F.col("doc_id").cast("string"), digest)
    kept = dedup_table(docs.select("doc_id", "text")).where("kept").select(
        key(F.col("text_sha256")).alias("key")
    )
    marked = docs.select(
        whole_row(docs).alias("row"), key(F.sha2(normalised(text_of()).cast("binary"), 256)).alias("key")
    )
    return one_per_key(marked, kept)
