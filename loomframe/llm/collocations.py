"""Phrase collocations by set-oriented mining of sorted occurrence relations.

Texts are cut into pieces and those into words. The relation of length k holds one row per
occurrence of a frequent phrase of k words: where it begins, and which phrase it is. To extend it,
the sorted relation is merge-joined with itself by piece and adjacent position; the pairs are
counted in groups over the whole corpus; occurrences whose group is not frequent are semi-joined
away; and what is left is stored, sorted, as the relation of length k + 1.

Relations are stored in blocks of :data:`BLOCK` words, each sorted by position, pieces a gap apart.
So the merge-join never leaves a block: a text that is cut carries its next few words along, which
take part in joins and are not counted. Groups, words as well as pairs, cross the network in packed
lists, once per :data:`MERGED` groups (:data:`WORDS` words) of a task and part, never once per
occurrence, and a phrase is known by the numbers of its two overlapping shorter phrases, which is
exact. A bitmap of a fixed size drops most infrequent groups before the semi-join, which decides
alone. Groups go to the semi-join as one packed question per block and part of the frequent groups,
and come back as one packed answer.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from loomframe.llm.common import slices, text_of
from loomframe.session import discard, ship_package, stage, sweep

#: Words a block holds (a fifth as many distinct ones), and bytes after which a text is cut (at the
#: next separator).
BLOCK, CUT = 2_000_000, 2_000_000

#: Bits of the map of frequent groups; at most 2 MB, whatever the number of groups.
BITS = 1 << 24

#: Frequent pairs a part of the semi-join holds in memory, and the least number of parts.
HELD, LEAST_PARTS = 100_000, 32

#: Groups a task gathers before it packs their counts, and occurrences of a part of the counting.
MERGED, COUNTED = 1_000_000, 4_000_000

#: Words a task gathers before it packs their counts, and words of all blocks to a part of them.
WORDS, LISTED = 300_000, 1_000_000

#: Parts in which the best phrases of a language are chosen before they meet.
PARTS = 256

_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + _SEPARATORS, b"abcdefghijklmnopqrstuvwxyz " + b"\n" * len(_SEPARATORS)
)
_END = re.compile(rb"[ \n]")
_WORD = re.compile(rb" *[^ \n]+")


# --- the relation of single words ---------------------------------------------------------------

def _planes(values: np.ndarray, width: int) -> np.ndarray:
    return np.ascontiguousarray(values, f"<i{width}").view(np.uint8).reshape(-1, width).T


def _pack(values: np.ndarray, width: int = 4) -> bytes:
    """Whole numbers of ``width`` bytes: how many, and the planes of their bytes, each compressed by itself.

    A plane of zeros takes no room.
    """
    packer = zstandard.ZstdCompressor(level=1)
    planes = [packer.compress(plane.tobytes()) if plane.any() else b"" for plane in _planes(values, width)]
    return np.array([len(values), *map(len, planes)], "<u4").tobytes() + b"".join(planes)


def _numbers(packed: bytes, width: int = 4) -> np.ndarray:
    n, *sizes = np.frombuffer(packed, "<u4", 1 + width).tolist()
    out, at, unpacker = np.zeros((n, width), np.uint8), 4 * (1 + width), zstandard.ZstdDecompressor()
    for k, size in enumerate(sizes):
        if size:
            out[:, k] = np.frombuffer(unpacker.decompress(packed[at : at + size]), np.uint8)
        at += size
    return out.view(f"<i{width}").ravel()


def _key(lang: str, word: bytes) -> bytes:
    """A word and its language as one; the word has no space."""
    return lang.encode() + b" " + word


def _pack_keys(keys: list[bytes]) -> bytes:
    """Keys as their packed sizes and their bytes, compressed."""
    sizes = _pack(np.fromiter(map(len, keys), np.int64, len(keys)))
    return np.array([len(sizes)], "<u4").tobytes() + sizes + zstandard.ZstdCompressor(level=3).compress(b"".join(keys))


def _keys(packed: bytes) -> list[bytes]:
    upto = 4 + int(np.frombuffer(packed, "<u4", 1)[0])
    raw = zstandard.ZstdDecompressor().decompress(packed[upto:])
    ends = np.cumsum(_numbers(packed[4:upto]), dtype=np.int64).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def _cuts(raw: bytes, tail: int, cut: int) -> Iterator[tuple[bytes, bytes]]:
    """A normalised text in parts of about ``cut`` bytes, each with the next ``tail`` words."""
    at = 0
    while len(raw) - at > cut:
        end = _END.search(raw, at + cut)
        if end is None:
            break
        after = upto = end.start()
        for _ in range(tail):
            word = _WORD.match(raw, after)
            if word is None:
                break
            after = word.end()
        yield raw[at:upto], raw[upto:after]
        at = upto
    yield raw[at:], b""


class _Block:
    """Words of consecutive texts as numbers of their own, in order; -1 between pieces."""

    def __init__(self):
        self._next = count()
        self.words: dict[str, defaultdict] = {}
        self.codes: list[np.ndarray] = []
        self.own: list[np.ndarray] = []
        self.sizes: defaultdict = defaultdict(int)
        self.n = 0

    def add(self, lang: str, part: bytes, tail: bytes) -> None:
        number = self.words.get(lang)
        if number is None:
            number = self.words[lang] = defaultdict(self._next.__next__)
        for text, counted in ((part, True), (tail + b"\n", False)):
            tokens = text.replace(b"\n", b" \n ").split(b" ")
            codes = np.fromiter(map(number.__getitem__, tokens), np.int32, len(tokens))
            codes = codes[codes != number[b""]]
            codes[codes == number[b"\n"]] = -1
            self.codes.append(codes)
            self.own.append(np.full(len(codes), counted))
            self.n += len(codes)
            if counted:
                self.sizes[lang] += int((codes >= 0).sum())

    def full(self, size: int) -> bool:
        return self.n >= size or 5 * sum(map(len, self.words.values())) >= size

    def row(self, block: int) -> tuple:
        """block, at, code, own, keys, counts, numbers (all by key), how many keys, sizes by language."""
        codes, own = np.concatenate(self.codes), np.concatenate(self.own)
        at = np.flatnonzero(codes >= 0)
        code, own = codes[at], own[at]
        seen = np.bincount(code[own], minlength=next(self._next))
        # numbered by how often they occur, words pack better
        rank = np.empty(len(seen), np.int64)
        rank[np.argsort(-seen, kind="stable")] = np.arange(len(seen))
        listed = sorted(
            (_key(lang, word), i)
            for lang, number in self.words.items() for word, i in number.items() if word not in (b"", b"\n")
        )
        numbers = np.fromiter((i for _, i in listed), np.int64, len(listed))
        return (
            block, _pack(np.diff(at, prepend=0)), _pack(rank[code]), np.packbits(own).tobytes(),
            _pack_keys([key for key, _ in listed]), _pack(seen[numbers], 8), _pack(rank[numbers]), len(listed),
            list(self.sizes), list(self.sizes.values()),
        )


_BLOCKS = pa.schema(
    [("block", pa.int64()), ("at", pa.binary()), ("code", pa.binary()), ("own", pa.binary()),
     ("keys", pa.binary()), ("counts", pa.binary()), ("numbers", pa.binary()), ("listed", pa.int64()),
     ("sized", pa.list_(pa.string())), ("sizes", pa.list_(pa.int64()))]
)
_BLOCKS_SQL = (
    "block long, at binary, code binary, own binary, keys binary, counts binary, numbers binary, "
    "listed long, sized array<string>, sizes array<long>"
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _blocks(docs: DataFrame, longest: int, size: int, cut: int) -> DataFrame:
    """Blocks of the words of all texts, as :meth:`_Block.row` lists them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << 33, _Block()
        for batch in batches:
            for some in slices(batch, 1):
                for lang, text in zip(some.column(0).to_pylist(), some.column(1)):
                    for part, tail in _cuts(text.as_buffer().to_pybytes().translate(_TABLE), longest - 1, cut):
                        block.add(lang, part, tail)
                        if block.full(size):
                            yield _batch([block.row(number)], _BLOCKS)
                            number, block = number + 1, _Block()
        if block.n:
            yield _batch([block.row(number)], _BLOCKS)

    return docs.mapInArrow(run, _BLOCKS_SQL)


# --- frequent groups and the semi-join ----------------------------------------------------------

def _bitmap(groups: DataFrame, bit: Column) -> np.ndarray:
    """The bits from 1 to :data:`BITS` of all groups, packed; at most 2 MB cross the driver."""
    on = groups.select(bit.alias("bit"))
    maps = on.groupBy(F.bitmap_bucket_number("bit").alias("n")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("map")
    )
    bits = np.zeros(BITS + 32768, bool)
    for r in maps.collect():
        # buckets hold 32768 values each and are numbered from 1; value v > 0 is bit (v - 1) of its bucket
        part = np.unpackbits(np.frombuffer(r["map"], np.uint8), bitorder="little")
        at = (r["n"] - 1) * 32768
        bits[at + 1 : at + 1 + len(part)] = part[: len(bits) - at - 1]
    return np.packbits(bits)


def _set(bitmap: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return (bitmap[bit >> 3] >> (7 - (bit & 7))) & 1 > 0


def _pair_bit(head, tail):
    """A bit from 1 to :data:`BITS` for a pair of group numbers; products stay below 2**51."""
    return (head % 1_000_000_007 * 1_000_003 + tail % 1_000_000_007) % BITS + 1


def _pairs(at: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge-join by adjacent position: place, code of the head and of the tail of each pair."""
    meet = np.flatnonzero(np.diff(at) == 1)
    return meet, code[meet], code[meet + 1]


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at, code = np.cumsum(_numbers(row["at"]), dtype=np.int64), _numbers(row["code"])
    return at, code, np.unpackbits(np.frombuffer(row["own"], np.uint8), count=len(at)).astype(bool)


def _groups(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """place of each pair, number of its group; of each group the head, tail and counted pairs."""
    at, code, own = _unpack(row)
    ids = _numbers(row["ids"], 8)
    meet, head, tail = _pairs(at, code)
    keys, which = np.unique(head.astype(np.int64) * (len(ids) + 1) + tail, return_inverse=True)
    counted = np.bincount(which[own[meet]], minlength=len(keys))
    head, tail = np.divmod(keys, len(ids) + 1)
    return meet, which, ids[head], ids[tail], counted


_RELATION = pa.schema(
    [("block", pa.int64()), ("at", pa.binary()), ("code", pa.binary()), ("own", pa.binary()), ("ids", pa.binary())]
)
_RELATION_SQL = "block long, at binary, code binary, own binary, ids binary"


def _kept(block: int, numbers: np.ndarray, ids: np.ndarray, at: np.ndarray, code: np.ndarray, own: np.ndarray) -> tuple:
    """Rows of a block whose group is frequent; those groups come by local and global number."""
    order = np.argsort(numbers)
    numbers, ids = numbers[order], ids[order]
    place = np.minimum(np.searchsorted(numbers, code), len(numbers) - 1)
    stays = numbers[place] == code
    return (
        block, _pack(np.diff(at[stays], prepend=0)), _pack(place[stays]),
        np.packbits(own[stays]).tobytes(), _pack(ids, 8),
    )


def _restrict(stored: DataFrame, found: DataFrame, words: bool) -> DataFrame:
    """Semi-join: the occurrences of ``stored`` (words, or pairs of them) with a frequent group.

    ``found`` has the frequent groups of a block in packed lists, by local and global number. A
    block bounds how many it has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                at, code, own = _unpack(row)
                numbers = np.concatenate([np.cumsum(_numbers(g["number"])) for g in row["g"]])
                ids = np.concatenate([np.cumsum(_numbers(g["gid"], 8)) for g in row["g"]])
                if not words:
                    meet, code, *_ = _groups(row)
                    at, own = at[meet], own[meet]
                yield _batch([_kept(row["block"], numbers, ids, at, code, own)], _RELATION)

    columns = ["block", "at", "code", "own", *([] if words else ["ids"])]
    per_block = found.groupBy("block").agg(F.collect_list(F.struct("number", "gid")).alias("g"))
    return stored.select(*columns).join(per_block, "block").mapInArrow(run, _RELATION_SQL)


_MESSAGE = pa.schema(
    [("part", pa.int64()), ("block", pa.int64()), ("number", pa.binary()), ("head", pa.binary()), ("tail", pa.binary())]
)
_MESSAGE_SQL = "part long, block long, number binary, head binary, tail binary"
_ANSWER = pa.schema([("block", pa.int64()), ("number", pa.binary()), ("gid", pa.binary())])


def _by_part(head: np.ndarray, tail: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of the pairs of each part, in order."""
    yield from _each_part((head % 1_000_000_007 * 998_244_353 + tail % 1_000_000_007) % parts)


def _each_part(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(part, kind="stable")
    there, first = np.unique(part[order], return_index=True)
    yield from zip(there.tolist(), np.split(order, first[1:]))


class _Held:
    """The frequent pairs of one part, looked up many at once; all come packed."""

    def __init__(self, lists: list[tuple[bytes, bytes, bytes]]):
        gid, head, tail = map(np.concatenate, zip(*map(self._unpacked, lists)))
        self.heads, h = np.unique(head, return_inverse=True)
        self.tails, t = np.unique(tail, return_inverse=True)
        keys = h * len(self.tails) + t
        order = np.argsort(keys)
        self.keys, self.gid = keys[order], gid[order]

    @staticmethod
    def _unpacked(row: tuple[bytes, bytes, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        gid, head, tail = (_numbers(c, 8) for c in row)
        return np.cumsum(gid), np.cumsum(head), tail

    def find(self, head: bytes, tail: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs are held, and the numbers of those."""
        head, tail = np.cumsum(_numbers(head, 8)), _numbers(tail, 8)
        h = np.minimum(np.searchsorted(self.heads, head), len(self.heads) - 1)
        t = np.minimum(np.searchsorted(self.tails, tail), len(self.tails) - 1)
        key = h * len(self.tails) + t
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        held = (self.keys[place] == key) & (self.heads[h] == head) & (self.tails[t] == tail)
        return held, self.gid[place[held]]


class _HeldWords:
    """The frequent words of one part by their keys (heads; tails are empty)."""

    def __init__(self, lists: list[tuple[bytes, bytes, bytes]]):
        self.gid: dict[bytes, int] = {}
        for gid, keys, _ in lists:
            self.gid.update(zip(_keys(keys), np.cumsum(_numbers(gid, 8)).tolist()))

    def find(self, head: bytes, tail: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Which words are held, and the numbers of those."""
        keys = _keys(head)
        gid = np.fromiter((self.gid.get(key, -1) for key in keys), np.int64, len(keys))
        return gid >= 0, gid[gid >= 0]


def _pair_lists(batch: pa.RecordBatch, parts: int) -> pa.RecordBatch:
    """Frequent pairs (gid, head, tail) as one list for each part."""
    gid, head, tail = (c.to_numpy() for c in batch.columns)
    lists = []
    for part, some in _by_part(head, tail, parts):
        some = some[np.lexsort((tail[some], head[some]))]
        gids, heads = (_pack(np.diff(c[some], prepend=0), 8) for c in (gid, head))
        lists.append((part, -1, gids, heads, _pack(tail[some], 8)))
    return _batch(lists, _MESSAGE)


def _word_lists(batch: pa.RecordBatch, parts: int) -> pa.RecordBatch:
    """Frequent words (gid, lang, word) as one list for each part."""
    gid, langs, words = batch.columns
    gid = gid.to_numpy()
    keys = [_key(lang, word) for lang, word in zip(langs.to_pylist(), words.cast(pa.binary()).to_pylist())]
    return _batch(
        [
            (part, -1, _pack(np.diff(gid[some], prepend=0), 8), _pack_keys([keys[i] for i in some.tolist()]), b"")
            for part, some in _each_part(_crcs(keys) % parts)
        ],
        _MESSAGE,
    )


def _crcs(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, keys), np.int64, len(keys))


def _answers(asks: DataFrame, frequent: DataFrame, parts: int, lists_of, held_by) -> DataFrame:
    """Packed questions meet the frequent groups of their part, which come first (block -1)."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield lists_of(batch, parts)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, lists, held = None, [], None
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                part, block, number, head, tail = (c[i].as_py() for c in batch.columns)
                if part != here:
                    here, lists, held = part, [], None
                if block < 0:
                    lists.append((number, head, tail))
                elif lists:
                    held = held or held_by(lists)
                    yes, gid = held.find(head, tail)
                    if len(gid):
                        numbers = np.cumsum(_numbers(number))[yes]
                        out.append((block, _pack(np.diff(numbers, prepend=0)), _pack(np.diff(gid, prepend=0), 8)))
            yield _batch(out, _ANSWER)

    table = frequent.mapInArrow(listed, _MESSAGE_SQL)
    met = table.unionByName(asks).repartition(parts, "part").sortWithinPartitions("part", "block")
    return met.mapInArrow(answer, "block long, number binary, gid binary")


def _each_block(stored: DataFrame, function, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield function(batch.slice(i, 1).to_pylist()[0])

    return stored.mapInArrow(run, schema)


_COUNTS = pa.schema([("part", pa.int64()), ("head", pa.binary()), ("tail", pa.binary()), ("n", pa.binary())])
_COUNTS_SQL = "part long, head binary, tail binary, n binary"


def _sums(lists: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each pair once, in order, with the sum of its counts."""
    head, tail, n = map(np.concatenate, zip(*lists))
    order = np.lexsort((tail, head))
    head, tail, n = head[order], tail[order], n[order]
    new = (np.diff(head, prepend=-1) != 0) | (np.diff(tail, prepend=-1) != 0)
    first = np.flatnonzero(new)
    return head[first], tail[first], np.add.reduceat(n, first) if len(first) else n


def _totals(stored: DataFrame, parts: int, least: int) -> DataFrame:
    """head, tail and counted occurrences ``a`` of the pairs of adjacent rows found ``least`` times in all blocks.

    A task adds up the pairs of its blocks and sends them as one packed list per part; a part adds
    up what all tasks send it.
    """

    def packed(lists: list[tuple]) -> pa.RecordBatch:
        head, tail, n = _sums(lists)
        return _batch(
            [
                (part, _pack(np.diff(head[some], prepend=0), 8), _pack(tail[some], 8), _pack(n[some], 8))
                for part, some in _by_part(head, tail, parts)
            ],
            _COUNTS,
        )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, held = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                *_, head, tail, n = _groups(batch.slice(i, 1).to_pylist()[0])
                some = n > 0
                lists.append((head[some], tail[some], n[some]))
                held += int(some.sum())
                if held >= MERGED:
                    yield packed(lists)
                    lists, held = [], 0
        if lists:
            yield packed(lists)

    def frequent(lists: list[tuple]) -> pa.RecordBatch:
        head, tail, n = _sums(lists)
        often = n >= least
        return pa.RecordBatch.from_arrays(
            [pa.array(c[often], pa.int64()) for c in (head, tail, n)], names=["head", "tail", "a"]
        )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, lists = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                part, head, tail, n = (c[i].as_py() for c in batch.columns)
                if part != here and lists:
                    yield frequent(lists)
                    lists = []
                here = part
                lists.append((np.cumsum(_numbers(head, 8)), _numbers(tail, 8), _numbers(n, 8)))
        if lists:
            yield frequent(lists)

    met = stored.mapInArrow(counted, _COUNTS_SQL).repartition(parts, "part").sortWithinPartitions("part")
    return met.mapInArrow(added, "head long, tail long, a long")


_WORD_COUNTS = pa.schema([("part", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def _word_totals(blocks: DataFrame, parts: int, least: int) -> DataFrame:
    """lang, word and occurrences ``a`` of the words found ``least`` times in all blocks.

    As :func:`_totals` does for pairs; the words of a part come sorted.
    """

    def packed(sums: dict[bytes, int]) -> pa.RecordBatch:
        keys = sorted(sums)
        return _batch(
            [
                (part, _pack_keys(chosen := [keys[i] for i in some.tolist()]),
                 _pack(np.fromiter(map(sums.__getitem__, chosen), np.int64, len(chosen)), 8))
                for part, some in _each_part(_crcs(keys) % parts)
            ],
            _WORD_COUNTS,
        )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = defaultdict(int)
        for batch in batches:
            for keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                for key, n in zip(_keys(keys), _numbers(counts, 8).tolist()):
                    sums[key] += n
                if len(sums) >= WORDS:
                    yield packed(sums)
                    sums = defaultdict(int)
        if sums:
            yield packed(sums)

    def frequent(sums: dict[bytes, int]) -> pa.RecordBatch:
        often = sorted(key for key, n in sums.items() if n >= least)
        langs, words = zip(*(key.rsplit(b" ", 1) for key in often)) if often else ((), ())
        counts = pa.array([sums[key] for key in often], pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(words, pa.string()), counts], names=["lang", "word", "a"]
        )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, sums = None, defaultdict(int)
        for batch in batches:
            for part, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if part != here and sums:
                    yield frequent(sums)
                    sums = defaultdict(int)
                here = part
                for key, n in zip(_keys(keys), _numbers(counts, 8).tolist()):
                    sums[key] += n
        if sums:
            yield frequent(sums)

    lists = blocks.select("keys", "counts").mapInArrow(counted, "part long, keys binary, counts binary")
    met = lists.repartition(parts, "part").sortWithinPartitions("part")
    return met.mapInArrow(added, "lang string, word string, a long")


def _found_words(blocks: DataFrame, groups: DataFrame, parts: int) -> DataFrame:
    """The frequent words of each block, as packed lists of their numbers in it and in ``groups``."""
    key = F.concat(F.col("lang").cast("binary"), F.lit(b" "), F.col("word").cast("binary"))
    bitmap = _bitmap(groups, F.crc32(key) % BITS + 1)

    def asked(row: dict) -> pa.RecordBatch:
        keys, numbers = _keys(row["keys"]), _numbers(row["numbers"])
        crcs = _crcs(keys)
        ask = np.flatnonzero(_set(bitmap, crcs % BITS + 1))
        return _batch(
            [
                (part, row["block"], _pack(np.diff(numbers[ask[some]], prepend=0)),
                 _pack_keys([keys[i] for i in ask[some].tolist()]), b"")
                for part, some in _each_part(crcs[ask] % parts)
            ],
            _MESSAGE,
        )

    asks = _each_block(blocks.select("block", "keys", "numbers"), asked, _MESSAGE_SQL)
    return _answers(asks, groups.select("gid", "lang", "word"), parts, _word_lists, _HeldWords)


def _first_level(blocks: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Frequent words with a number each, and the sorted relation of their occurrences."""

    parts = max(LEAST_PARTS, (blocks.agg(F.sum("listed")).first()[0] or 0) // LISTED + 1)
    groups = stage(
        _word_totals(blocks, parts, least).withColumn("gid", F.monotonically_increasing_id()), "words"
    )
    sweep(blocks.sparkSession)
    found = _found_words(blocks, groups, parts)
    return groups, stage(_restrict(blocks, found, words=True), "occurrences")


def _next_level(
    stored: DataFrame, groups: DataFrame, least: int, last: bool, block: int
) -> tuple[DataFrame, DataFrame | None]:
    """Frequent phrases one word longer, and their occurrences unless this is the last length."""

    frequent = _totals(stored, max(LEAST_PARTS, stored.count() * block // COUNTED + 1), least)
    frequent = stage(frequent.withColumn("gid", F.monotonically_increasing_id()), "pairs")
    left = groups.select(F.col("gid").alias("head"), "lang", F.col("words").alias("w"), F.col("heads").alias("h"))
    right = groups.select(F.col("gid").alias("tail"), F.col("words").alias("v"), F.col("tails").alias("t"))
    longer = stage(
        frequent.join(left, "head").join(right, "tail").select(
            "gid", "head", "tail", "lang", "a",
            F.concat("w", F.slice("v", -1, 1)).alias("words"),
            F.concat("h", F.array("a")).alias("heads"), F.concat("t", F.array("a")).alias("tails"),
        ),
        "phrases",
    )
    if last:
        return longer, None
    sweep(stored.sparkSession)
    bitmap = _bitmap(frequent, _pair_bit(F.col("head"), F.col("tail")))

    parts = max(LEAST_PARTS, frequent.count() // HELD + 1)

    def asked(row: dict) -> pa.RecordBatch:
        *_, head, tail, _ = _groups(row)
        ask = np.flatnonzero(_set(bitmap, _pair_bit(head, tail)))
        head, tail = head[ask], tail[ask]
        return _batch(
            [
                (part, row["block"], _pack(np.diff(ask[some], prepend=0)),
                 _pack(np.diff(head[some], prepend=0), 8), _pack(tail[some], 8))
                for part, some in _by_part(head, tail, parts)
            ],
            _MESSAGE,
        )

    answers = _answers(
        _each_block(stored, asked, _MESSAGE_SQL), frequent.select("gid", "head", "tail"), parts, _pair_lists, _Held
    )
    return longer, stage(_restrict(stored, answers, words=False), "occurrences")


# --- phrases and scores -------------------------------------------------------------------------

def mine(
    docs: DataFrame, least: int = 100, longest: int = 5, block: int = BLOCK, cut: int = CUT
) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases, and the number of words per language.

    The first table has one row per language and phrase of 2 to ``longest`` words that occurs at
    least ``least`` times: lang, words, a (occurrences), heads and tails (occurrences
    of its first and last 1, 2, ... words, itself last) and inside (it stands inside a longer one
    as frequent). The second has lang and n.

    A null text is empty and a null language ``und``; texts without words, and an empty table, add
    nothing. Repeated rows count each. Other columns are not read. A text of any length is cut at
    separators; only a single word stays whole. ``block`` and ``cut`` change no result.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_of().alias("text"))
    blocks = stage(_blocks(docs, longest, block, cut), "blocks")
    sizes = stage(
        blocks.select(F.inline(F.arrays_zip("sized", "sizes"))).groupBy(F.col("sized").alias("lang"))
        .agg(F.sum("sizes").alias("n")),
        "sizes",
    )
    words, stored = _first_level(blocks, least)
    discard(blocks)
    groups = words.select(
        "gid", "lang", "a", F.array("word").alias("words"), F.array("a").alias("heads"), F.array("a").alias("tails")
    )
    levels = []
    for length in range(2, longest + 1):
        before = stored
        groups, stored = _next_level(before, groups, least, length == longest, block)
        discard(before)
        levels.append(groups)
    out = None
    for shorter, longer in zip(levels, [*levels[1:], None]):
        if longer is None:
            part = shorter.withColumn("inside", F.lit(False))
        else:
            # a phrase inside an equally frequent longer one is inside one that is a word longer
            around = longer.select(F.explode(F.array("head", "tail")).alias("gid"), "a").groupBy("gid").agg(
                F.max("a").alias("around")
            )
            part = shorter.join(around, "gid", "left").withColumn(
                "inside", F.coalesce(F.col("around") >= F.col("a"), F.lit(False))
            )
        part = part.select("lang", "words", "a", "heads", "tails", "inside")
        out = part if out is None else out.unionByName(part)
    return out, sizes


def _scored(phrases: DataFrame, sizes: DataFrame, longest: int) -> DataFrame:
    """Lowest-scoring cut of each phrase: l, r and score; products are exact decimals."""
    wide = lambda c: c.cast("decimal(15,0)")
    rated = phrases.join(sizes, "lang")
    cuts = []
    for k in range(1, longest):
        first, rest = F.get("heads", F.lit(k - 1)), F.get("tails", F.size("words") - F.lit(k + 1))
        # a * n below 10**30, the product with 1000 below 10**34: 38 digits hold both
        top = (wide(F.col("a")) * wide(F.col("n"))).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")
        score = F.call_function("div", top, wide(first) * wide(rest))
        cut = F.struct(score.alias("score"), F.lit(k).alias("k"), first.alias("l"), rest.alias("r"))
        cuts.append(F.when(F.size("words") > k, cut))
    return rated.withColumn("cut", F.array_min(F.array(*cuts))).select(
        "lang", "words", "a", "n", "cut.l", "cut.r", "cut.score"
    )


def collocations(
    docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, block: int = BLOCK, cut: int = CUT
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Phrases inside an equally frequent longer one are left out. Score, from the words of the
    language and the parts of the lowest-scoring cut, is floor(1000 * a * n / (l * r)); ties go to
    the more frequent, then to the smaller phrase by bytes. Rows as in :func:`mine`.
    """
    phrases, sizes = mine(docs, least, longest, block, cut)
    scored = _scored(phrases.where("not inside"), sizes, longest).withColumn("phrase", F.array_join("words", " "))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each part first, so that no task sorts all phrases of a language
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    first = scored.withColumn("part", part).withColumn(
        "place", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))
    )
    best = first.where(F.col("place") <= top).withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)))
    return best.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
