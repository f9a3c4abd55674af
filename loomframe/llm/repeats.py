"""Repeated passages by prefix-free parsing: every byte that lies in a long string seen twice.

A rolling hash over a few bytes marks triggers; the text between triggers is a phrase. (A stretch
without a trigger is cut at the smallest hash in reach, so that each window of SPAN bytes contains
a cut that depends on its own bytes alone.) Equal strings are parsed alike, so the windows that
begin in one phrase are known by the phrase and the parse that follows it.

Phrases whose trigger occurs once in the corpus cannot hold a repeat and go no further. The others
meet by trigger. There the distinct phrases are sorted by their ends, read backwards (the suffix
array of the dictionary), and by what follows them (the suffix array of the parse), each with the
lengths of common beginnings between neighbours. A window that begins t bytes before the trigger
is then named by two numbers, its phrase suffix and its parse prefix, and these pairs, put in
order, are the corpus order of all windows at t: equal neighbours are repeats.

Triggers of very many phrases (a common line) do not meet in one task: their windows are compared
by digest with sums before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomframe.llm.common import slices, text_of
from loomframe.llm.words import spread
from loomframe.session import discard, ship_package, stage

#: Bytes in a repeat; bytes under the rolling hash; one trigger in so many places.
SPAN, TRIGGER, EVERY = 200, 32, 128
#: Phrases with one trigger that still meet in one task.
HOT = 20_000
#: Phrases sorted at once.
BATCH = 20_000
REACH = SPAN - TRIGGER  # how far before a window's end its cut may begin

_draw = np.random.Generator(np.random.PCG64(11))
_BYTES = _draw.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEPS = tuple((1 << k, _draw.integers(0, 1 << 63, dtype=np.uint64) | np.uint64(1)) for k in range(5))


# --- parsing ----------------------------------------------------------------------------------

def rolling(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the TRIGGER bytes from each place on."""
    h = _BYTES[data]
    for step, factor in _STEPS:  # of 1, 2, 4, 8 and 16 bytes, twice as many each time
        h = h[:-step] * factor + h[step:]
        h ^= h >> np.uint64(31)
    return h


def cuts(lengths: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Phrases of several texts, joined in ``data``: text, trigger hash, cut, and the first and last
    window that belong to the cut, as distances before it. Only places with a whole window count."""
    offset = np.cumsum(lengths) - lengths
    windows = np.maximum(lengths - SPAN + 1, 0)
    at = spread(offset, windows)
    if not len(at):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    h = rolling(data)
    n = len(h)
    place = np.arange(n)
    following = np.where((h >> np.uint64(40)) % np.uint64(EVERY) == 0, place, n + SPAN)
    following = np.minimum.accumulate(following[::-1])[::-1]
    # where no trigger is in reach: the leftmost smallest hash
    ranked = (h >> np.uint64(32) << np.uint64(32)) | place.astype(np.uint64)
    width = REACH + 1
    padded = np.full(-(-n // width) * width + width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = ranked
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    smallest = (np.minimum(behind[:n], ahead[REACH : REACH + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cut = np.where(following - place <= REACH, following, smallest)[at]
    text = np.repeat(np.arange(len(lengths)), windows)
    new = np.ones(len(at), bool)
    new[1:] = (cut[1:] != cut[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    cut, text = cut[first], text[first]
    return text, h[cut].view(np.int64), cut - offset[text], cut - at[first], cut - at[last]


def _bytes_of(column: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    texts = column.to_pylist()
    lengths = np.array([len(t) for t in texts], np.int64)
    return texts, lengths, np.frombuffer(b"".join(texts), np.uint8)


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows by (id, own): the id, and a hash of the text for rows that share an id."""
    body = text_of().cast("binary")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("id"),
        F.xxhash64(body).alias("own"),
        body.alias("body"),
    )


def phrases(keyed: DataFrame) -> DataFrame:
    """id, own, trigger and spot of every phrase; spot holds the cut and its windows' distances."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                _, lengths, data = _bytes_of(part.column(2))
                text, trigger, cut, far, near = cuts(lengths, data)
                spot = (cut << 16) | (far << 8) | near
                take = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take), pa.array(trigger), pa.array(spot)],
                    names=["id", "own", "trigger", "spot"],
                )

    return keyed.select("id", "own", "body").mapInArrow(run, "id long, own long, trigger long, spot long")


# --- phrases that share a trigger -------------------------------------------------------------

FOUND = (
    "kind int, trigger long, id long, own long, cut long, far long, near long, body binary, "
    "digest binary"
)
#: Kinds of row: a phrase to be compared; a removed stretch (cut to far); a window of a phrase
#: with a very common trigger (cut: its distance, far: times seen); such a phrase's place.
PHRASE, STRETCH, WINDOW, PLACE = range(4)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 9
    whole, raw = pa.int64(), pa.binary()
    kinds = [pa.int32(), whole, whole, whole, whole, whole, whole, raw, raw]
    names = ["kind", "trigger", "id", "own", "cut", "far", "near", "body", "digest"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _extract(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The bytes of the phrases in ``spots`` with all that their windows reach."""
    rows, common = [], {}
    digest = lambda data: hashlib.blake2b(data, digest_size=16).digest()
    for id_, own, body, spots in zip(*(c.to_pylist() for c in batch.columns)):
        for spot in spots:
            hot, spot = spot & 1, spot >> 1
            cut, far, near = spot >> 16, spot >> 8 & 255, spot & 255
            piece = body[cut - far : cut - near + SPAN]
            trigger = int.from_bytes(digest(body[cut : cut + TRIGGER])[:8], "little", signed=True)
            if not hot:
                rows.append((PHRASE, trigger, id_, own, cut, far, near, piece, None))
                continue
            name = digest(bytes([far, near]) + piece)
            rows.append((PLACE, trigger, id_, own, cut, 0, 0, None, name))
            common.setdefault(name, [0, trigger, far, near, piece])[0] += 1
    for name, (times, trigger, far, near, piece) in common.items():
        for t in range(near, far + 1):
            window = digest(piece[far - t : far - t + SPAN])
            rows.append((WINDOW, trigger, 0, 0, t, times, 0, window, name))
    return _rows(rows)


def _order(rows: list[bytes], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted within their groups, and how many bytes each shares with the one before it."""
    named = [g + r for g, r in zip((int(g).to_bytes(8, "big") for g in group), rows)]
    order = np.array(sorted(range(len(named)), key=named.__getitem__))
    size = np.array([len(r) for r in rows])[order]
    width = int(size.max(initial=0)) + 1
    table = np.frombuffer(b"".join(rows[i].ljust(width, b"\0") for i in order), np.uint8).reshape(-1, width)
    shared = np.full(len(order), -1)
    differs = table[1:] != table[:-1]
    differs[:, -1] = True
    shared[1:] = np.minimum(differs.argmax(1), np.minimum(size[1:], size[:-1]))
    apart = group[order]
    shared[1:][apart[1:] != apart[:-1]] = -1
    return order, shared


def repeated(trigger: np.ndarray, far: np.ndarray, near: np.ndarray, pieces: list[bytes]) -> np.ndarray:
    """For each phrase (a row) and distance t (a column): whether its window at t occurs elsewhere.

    All phrases of a trigger must be there. Exact: bytes are compared, not hashes.
    """
    out = np.zeros((len(pieces), REACH + 1), bool)
    number: dict[tuple, int] = {}
    which = np.array(
        [number.setdefault(key, len(number)) for key in zip(trigger.tolist(), far.tolist(), near.tolist(), pieces)]
    )
    times = np.bincount(which)
    one = [*number]
    group = np.unique(np.array([k[0] for k in one]), return_inverse=True)[1]
    f, n = np.array([k[1] for k in one]), np.array([k[2] for k in one])
    t = np.arange(REACH + 1)
    inside = (t >= n[:, None]) & (t <= f[:, None])
    found = inside & (times > 1)[:, None]  # the same phrase and parse again
    several = np.flatnonzero(np.bincount(group)[group] > 1)
    if len(several):
        f, n, group, inside = f[several], n[several], group[several], inside[several]
        weight = times[several]
        heads = [one[i][3][: one[i][1]][::-1] for i in several]
        tails = [one[i][3][one[i][1] :] for i in several]
        head_order, head_shared = _order(heads, group)
        tail_order, tail_shared = _order(tails, group)
        head, tail = np.empty(len(several), np.int64), np.empty(len(several), np.int64)
        for k in range(REACH + 1):
            rows = np.flatnonzero(inside[:, k])
            if len(rows) < 2:
                continue
            head[head_order] = np.cumsum(head_shared < k)
            tail[tail_order] = np.cumsum(tail_shared < SPAN - k)
            key = head[rows] * (len(several) + 1) + tail[rows]
            order = np.argsort(key, kind="stable")
            start = np.flatnonzero(np.diff(key[order], prepend=-1))
            total = np.add.reduceat(weight[rows][order], start)
            many = np.repeat(total > 1, np.diff(start, append=len(order)))
            found[several[rows[order[many]]], k] = True
    out[:] = found[which]
    return out


def _stretches(found: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phrase, begin, end) of the bytes under the found windows."""
    edge = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, low = np.nonzero(edge == 1)
    _, high = np.nonzero(edge == -1)  # both are in row order
    return row, cut[row] - (high - 1), cut[row] - low + SPAN


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases, sorted by trigger, to stretches; other rows pass."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def flush(table: pa.Table) -> pa.RecordBatch:
        trigger, cut, far, near = (table.column(c).to_numpy() for c in ("trigger", "cut", "far", "near"))
        found = repeated(trigger, far, near, table.column("body").to_pylist())
        row, begin, end = _stretches(found, cut)
        take, none = pa.array(row), pa.nulls(len(row), pa.binary())
        zero = pa.array(np.zeros(len(row), np.int64))
        ids = [table.column(c).combine_chunks().take(take) for c in ("id", "own")]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(row), STRETCH, np.int32)), zero, *ids, pa.array(begin), pa.array(end), zero, none, none],
            names=table.schema.names,
        )

    for batch in batches:
        kind = batch.column(0).to_numpy()
        if (kind != PHRASE).any():
            yield batch.filter(pa.array(kind != PHRASE))
            batch = batch.filter(pa.array(kind == PHRASE))
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows >= BATCH:
            table = pa.Table.from_batches(held)
            trigger = table.column("trigger").to_numpy()
            whole = int(np.flatnonzero(trigger == trigger[-1])[0])  # the last trigger may go on
            if whole:
                yield flush(table.slice(0, whole))
                held = table.slice(whole).to_batches()
                rows -= whole
    if held:
        yield flush(pa.Table.from_batches(held))


# --- the whole --------------------------------------------------------------------------------

def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, spans (removed stretches: start, end) and kept (the bytes that remain).

    Every byte covered by a string of SPAN bytes that begins anywhere else as well, in another
    document or at another place of the same one, is removed; strings do not cross documents.
    Texts are UTF-8 bytes, null is empty. Texts shorter than SPAN stay whole, and an empty table
    gives no rows. Repeated rows are documents of their own, so their texts repeat. Rows without
    doc_id take part. Only doc_id and text are read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    keyed = _keyed(docs)
    parsed = stage(phrases(keyed), "phrases")
    shared = parsed.groupBy("trigger").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    spot = F.shiftleft("spot", 1).bitwiseOR((F.col("n") > hot).cast("long"))
    spots = stage(
        parsed.join(shared, "trigger").select("id", "own", spot.alias("spot"))
        .groupBy("id", "own").agg(F.collect_set("spot").alias("spots")),
        "spots",
    )
    discard(parsed)  # before the texts are shuffled

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                yield _extract(part)

    pieces = keyed.select("id", "own", "body").join(spots, ["id", "own"]).mapInArrow(extract, FOUND)
    # phrases meet by trigger; the rows of very common triggers are spread evenly
    meet = F.when(F.col("kind") == PHRASE, F.col("trigger")).otherwise(F.xxhash64("id", "cut", "body", "digest"))
    found = stage(
        pieces.withColumn("meet", meet).repartition("meet").sortWithinPartitions("trigger")
        .drop("meet").mapInArrow(_compare, FOUND),
        "found",
    )
    discard(spots)
    stretches = found.where(F.col("kind") == STRETCH).select("id", "own", F.col("cut").alias("s"), F.col("far").alias("e"))
    stretches = stretches.unionByName(_common(found))
    spans = stretches.groupBy("id", "own").agg(
        F.collect_set(F.shiftleft("s", 32).bitwiseOR(F.col("e"))).alias("spans")
    )

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                yield _cut_out(part)

    return keyed.join(spans, ["id", "own"], "left").select("doc_id", "body", "spans").mapInArrow(
        cut_out, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    )


def _common(found: DataFrame) -> DataFrame:
    """Stretches of the phrases with very common triggers, from the digests of their windows."""
    windows = found.where(F.col("kind") == WINDOW).select("digest", F.col("cut").alias("t"), "body", F.col("far").alias("n"))
    twice = windows.groupBy("body").agg(F.sum("n").alias("n")).where("n > 1").select("body")
    named = windows.join(twice, "body", "left_semi").select("digest", "t").distinct()
    places = found.where(F.col("kind") == PLACE).select("id", "own", "cut", "digest")
    begin = F.col("cut") - F.col("t")
    return places.join(named, "digest").select("id", "own", begin.alias("s"), (begin + SPAN).alias("e"))


def _cut_out(batch: pa.RecordBatch) -> pa.RecordBatch:
    sizes, spans, kept = [], [], []
    for body, packed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
        sizes.append(len(body))
        if not packed:
            spans.append([])
            kept.append(body)
            continue
        both = np.sort(np.array(packed, np.int64))
        start, end = both >> 32, np.maximum.accumulate(both & 0xFFFFFFFF)
        first = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
        start, end = start[first].tolist(), end[np.append(first[1:], len(end)) - 1].tolist()
        spans.append([{"start": s, "end": e} for s, e in zip(start, end)])
        kept.append(b"".join(body[a:b] for a, b in zip([0, *end], [*start, len(body)])))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
        names=["doc_id", "n_bytes", "spans", "kept"],
    )


def repeat_report(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """Counts and the digest of what remains, one row per row."""
    return remove_repeats(docs, hot).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
