"""Near duplicates by SimHash: fingerprints that differ in few bits are linked.

Candidates come from anchor points. The anchors are the words of a covering code: every
fingerprint lies within the covering radius of one, its home. A fingerprint within the threshold
of another lies within radius plus threshold of that one's home. So each distinct fingerprint
goes to every anchor in that range, and each anchor compares its residents with all its
visitors. No link is lost.

The code is the perfect Golay code on 23 bits (radius 3, 4,096 words), on one or more blocks of
bits; bits outside the blocks do not choose anchors, which only keeps more pairs together.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, combinations, product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from loomframe.llm.common import in_batches, one_per_key, text_of, unused, whole_row
from loomframe.llm.components import components
from loomframe.session import ship_package, stage

SHINGLE, BITS = 3, 3  # words in a shingle, bits that linked fingerprints may differ in
SEED = 42

# The generator polynomial of the Golay code, and its size and radius.
GENERATOR, LENGTH, CHECKS, RADIUS = 0b101011100011, 23, 11, 3


# --- fingerprints -----------------------------------------------------------------------------

def fingerprint(text: str, words: int = SHINGLE) -> int:
    """Majority bits of the XXH64 of all shingles, repeats included; 0 for a text without words."""
    parts = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = list(accumulate(map(len, parts), lambda a, b: a + 1 + b))
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    digest = xxhash.xxh64_intdigest
    starts = [0, *(e + 1 for e in ends[: -words])]
    hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends[words - 1 :])], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long), one row per row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [fingerprint(t, words) for t in batch.column(1).to_pylist()]
        signed = np.array(values, np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], names=["doc_id", "fp"])

    return in_batches(
        docs.select(F.col("doc_id").cast("long"), text_of().alias("text")), run, "doc_id long, fp long", 1
    )


# --- anchors ----------------------------------------------------------------------------------

def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words modulo the generator."""
    left = words.astype(np.int64)
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        left = np.where((left >> bit) & 1, left ^ (GENERATOR << (bit - CHECKS)), left)
    return left


@lru_cache(1)
def _leaders() -> np.ndarray:
    """The lightest error for each syndrome; perfect: all errors of up to three bits, once each."""
    errors = np.array(
        [sum(1 << b for b in some) for n in range(RADIUS + 1) for some in combinations(range(LENGTH), n)]
    )
    table = np.zeros(1 << CHECKS, np.int64)
    table[_syndromes(errors)] = errors
    return table


@lru_cache(4)
def _steps(bits: int) -> list[list[np.ndarray]]:
    """For each syndrome and n up to ``bits``: the code words, relative to the home, that n flipped
    bits reach as another home and fewer do not."""
    leaders = _leaders()
    flips = [
        np.array([sum(1 << b for b in some) for some in combinations(range(LENGTH), n)])
        for n in range(bits + 1)
    ]
    out = []
    for leader in leaders:
        met, by_cost = np.zeros(0, np.int64), []
        for some in flips:
            word = leader ^ some
            homes = np.unique(word ^ leaders[_syndromes(word)])
            by_cost.append(np.setdiff1d(homes, met))
            met = np.union1d(met, homes)
        out.append(by_cost)
    return out


def anchors_of(fps: np.ndarray, blocks: int, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(rows, anchor of each, whether it is the home) for all anchors in range."""
    steps, leaders = _steps(bits), _leaders()
    mask = np.uint64((1 << LENGTH) - 1)
    words = [((fps >> np.uint64(b * LENGTH)) & mask).astype(np.int64) for b in range(blocks)]
    syndromes = [_syndromes(w) for w in words]
    homes = [w ^ leaders[s] for w, s in zip(words, syndromes)]
    kind = sum(s << (CHECKS * b) for b, s in enumerate(syndromes))
    base = sum(h >> CHECKS << (12 * b) for b, h in enumerate(homes))
    order = np.argsort(kind, kind="stable")
    firsts = np.flatnonzero(np.diff(kind[order], prepend=-1))
    for rows in np.split(order, firsts[1:]) if len(order) else []:
        offsets: set[int] = set()
        for costs in product(range(bits + 1), repeat=blocks):
            if sum(costs) <= bits:
                parts = [
                    steps[int(syndromes[b][rows[0]])][c] >> CHECKS << (12 * b) for b, c in enumerate(costs)
                ]
                offsets.update(sum(some) for some in product(*(p.tolist() for p in parts)))
        moves = np.array(sorted(offsets))
        to = base[rows][:, None] ^ moves[None, :]
        yield np.repeat(rows, len(moves)), to.ravel(), np.tile(moves == 0, len(rows))


def _close(fps: np.ndarray, home: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between residents and all members of one anchor, as stars: (member, root).

    Two fingerprints within ``bits`` agree on one of bits + 1 bands, so only members with an
    equal band are compared, in blocks of bounded size.
    """
    residents, n = np.flatnonzero(home), len(fps)
    label = np.arange(n)
    width = 64 // (bits + 1)
    for band in range(bits + 1):
        top = 64 if band == bits else (band + 1) * width
        key = (fps << np.uint64(64 - top)) >> np.uint64(64 - top + band * width)
        order = np.argsort(key, kind="stable")
        low = np.searchsorted(key[order], key[residents], "left")
        many = np.searchsorted(key[order], key[residents], "right") - low
        ends = np.cumsum(many)
        at = 0
        while at < len(residents):
            start = ends[at] - many[at]
            stop = max(at + 1, int(np.searchsorted(ends, start + 2_000_000, "right")))
            count = many[at:stop]
            a = np.repeat(residents[at:stop], count)
            shift = np.repeat(low[at:stop] - (ends[at:stop] - count), count)
            b = order[shift + np.arange(start, ends[stop - 1])]
            near = np.bitwise_count(fps[a] ^ fps[b]) <= bits
            label = _join(label, a[near], b[near])
            at = stop
    moved = np.flatnonzero(label != np.arange(n))
    return fps[moved], fps[label[moved]]


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining a and b: each component takes its smallest label."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        low, high = np.minimum(x, y)[apart], np.maximum(x, y)[apart]
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]


def links(distinct: DataFrame, blocks: int = 1, bits: int = BITS) -> DataFrame:
    """Links (u, v) that join all fingerprints within ``bits`` of each other, from distinct ``fp``.

    With one block a fingerprint goes to at most 70 of 4,096 anchors, so an anchor sees one
    fingerprint in 58; each further block of the three that fit multiplies the anchors by 4,096
    and the copies by about five.
    """
    ship_package(distinct.sparkSession)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(fps), 16384):
                some = fps[at : at + 16384]
                found = list(anchors_of(some, blocks, bits))
                rows, anchor, home = (np.concatenate(part) for part in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(some[rows].view(np.int64)), pa.array(home)],
                    names=["anchor", "fp", "home"],
                )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        fps = group["fp"].to_numpy().view(np.uint64)
        u, v = _close(fps, group["home"].to_numpy(), bits)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    spreaded = distinct.select("fp").mapInArrow(spread, "anchor long, fp long, home boolean")
    return spreaded.groupBy("anchor").applyInPandas(compare, "u long, v long")


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE, bits: int = BITS, blocks: int = 1
) -> DataFrame:
    """doc_id, fp, fingerprint (16 hexadecimal digits), component_id and root, one row per row.

    component_id is the smallest doc_id that links lead to, the document itself included; root
    is the component's smallest fingerprint. Texts without words (null, empty, white space) have
    the fingerprint zero and are linked like any other; of shorter texts the whole is the one
    shingle. Rows without doc_id take part; a component of such rows alone has no id. Repeated
    rows and equal texts share a fingerprint, which is compared once.
    """
    own = stage(fingerprints(docs, words), "fingerprints")
    stars = components(links(own.select("fp").distinct(), blocks, bits))
    rooted = own.join(stars.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(least, "root").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root"
    )


def keep_one(docs: DataFrame, words: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """One document of each component, that with the smallest doc_id; columns as they are.

    A component of rows without doc_id keeps the row with its smallest fingerprint. Of rows that
    share doc_id and fingerprint the one with the smallest hash of all its columns stays. Texts
    without words are one component. Other columns may have any name; an empty table gives none.
    """
    found = near_duplicates(docs.select("doc_id", "text"), words, bits)
    key = lambda fp: F.concat_ws(":", F.col("doc_id").cast("string"), fp.cast("string"))
    # a component without ids keeps the row with its smallest fingerprint
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    kept = (
        found.where(first).groupBy("doc_id", "root").agg(F.min("fp").alias("fp"))
        .select(key(F.col("fp")).alias("key"))
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    at, added = docs.columns.index("text"), unused(docs.columns, "_fp")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [fingerprint(t or "", words) for t in batch.column(at).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.array(values, np.uint64).view(np.int64))],
            names=[*batch.schema.names, added],
        )

    marked = in_batches(docs, run, f"{schema}, {added} long", at)
    return one_per_key(marked.select(whole_row(docs).alias("row"), key(F.col(added)).alias("key")), kept)
