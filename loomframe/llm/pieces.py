"""Encoding and decoding with a SentencePiece model by batched numpy Viterbi.

The model merges pairs by rank, so a segmentation is valid only if every two neighbouring pieces
would survive the merging. For each prefix of a word exactly one last piece can follow a valid
segmentation of the rest. The Viterbi score of a piece ending at a position is its length where
that transition is allowed and minus infinity elsewhere; the maxima are the backpointers, and
following them gives the model's own ids, not those of a different objective. Words of equal
length advance together: substring hashes probe the sorted hashes of all pieces.

Words begin at a space mark; longer runs of spaces are merged last in this kind of model, and are
cut by a rule. Characters that no piece holds become byte pieces.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomframe.llm.common import in_batches, text_of
from loomframe.llm.words import WordMemory, per_text

SPACE = "▁"
#: Bytes of text and new words that go through the search together: more rows, fewer numpy calls.
TEXT, WORDS = 4_000_000, 200_000
_PRIME, _SEED = np.uint64(0x100000001B3), np.uint64(0xCBF29CE484222325)


class Table:
    """Numbers by 64-bit keys, open-addressed; -1 (or ``missing``) for keys that are not there."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: float = -1):
        slots = 1 << int(4 * len(keys) + 4).bit_length()
        self._mask = np.uint64(slots - 1)
        self._keys = np.zeros(slots, np.uint64)
        self._values = np.full(slots, missing, values.dtype)
        self._held = np.zeros(slots, bool)
        for key, value in zip(keys.tolist(), values.tolist()):
            at = key & (slots - 1)
            while self._held[at]:
                at = (at + 1) & (slots - 1)
            self._keys[at], self._values[at], self._held[at] = key, value, True

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        at = keys & self._mask
        out = self._values[at]
        left = np.flatnonzero(self._held[at] & (self._keys[at] != keys))
        at = at[left]
        while len(left):
            at = (at + np.uint64(1)) & self._mask
            out[left] = self._values[at]
            on = self._held[at] & (self._keys[at] != keys[left])
            left, at = left[on], at[on]
        return out


@dataclass(frozen=True)
class Model:
    """Tables of one model: pieces by hash, ranks, and how pieces split and join."""

    pieces: Table
    pairs: Table  # keys of pairs of pieces -> rank of the piece they form, infinite for none
    rank: np.ndarray  # by id; single characters come first
    left: np.ndarray  # by id: the two pieces of the last merge, or -1
    right: np.ndarray
    longest: int
    byte_ids: np.ndarray
    bytes_of: list[bytes]
    runs: dict[int, int]  # length of a run of spaces -> id


def _grown(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hashes of substrings that are one code point longer."""
    value = (hashes ^ codes) * _PRIME
    return value ^ (value >> np.uint64(29))


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    return flat.astype(np.uint64).reshape(len(words), -1)


@lru_cache(2)
def load(path: str) -> Model:
    from sentencepiece import SentencePieceProcessor

    source = SentencePieceProcessor(model_file=path)
    total = source.get_piece_size()
    names = [source.id_to_piece(i) for i in range(total)]
    plain = [
        i for i in range(total)
        if not (source.is_control(i) or source.is_unknown(i) or source.is_byte(i) or source.is_unused(i))
    ]
    byte_ids = np.zeros(256, np.int32)
    bytes_of = [b""] * total
    for i in range(total):
        if source.is_byte(i):
            byte_ids[int(names[i][3:-1], 16)] = i
            bytes_of[i] = bytes([int(names[i][3:-1], 16)])
        elif source.is_unknown(i):
            bytes_of[i] = " ⁇ ".encode()
        elif not source.is_control(i):
            bytes_of[i] = names[i].replace(SPACE, " ").encode()
    runs = {len(names[i]): i for i in plain if set(names[i]) == {SPACE}}
    vocabulary = {names[i]: i for i in plain if set(names[i]) != {SPACE} or len(names[i]) == 1}
    merge_rank = {names[i]: -source.get_score(i) for i in plain if names[i] in vocabulary}
    rank = np.full(total + 1, np.inf)
    left, right = np.full(total + 1, -1, np.int32), np.full(total + 1, -1, np.int32)
    for name, i in vocabulary.items():
        rank[i] = merge_rank[name] if len(name) > 1 else -np.inf
        if len(name) > 1:
            left[i], right[i] = (vocabulary[part] for part in _last_merge(name, merge_rank))
    hashes = []
    for name in vocabulary:
        value = np.full(1, _SEED)
        for code in _codes([name])[0]:
            value = _grown(value, code)
        hashes.append(value[0])
    pairs = {
        vocabulary[name[:k]] * (total + 1) + vocabulary[name[k:]]: rank[i]
        for name, i in vocabulary.items()
        for k in range(1, len(name))
        if name[:k] in vocabulary and name[k:] in vocabulary
    }
    keys = _mix(np.array([*pairs], np.uint64))
    return Model(
        Table(np.array(hashes, np.uint64), np.array([*vocabulary.values()], np.int32)),
        Table(keys, np.array([*pairs.values()]), np.inf),
        rank, left, right, max(map(len, vocabulary)), byte_ids, bytes_of, runs,
    )


def _mix(keys: np.ndarray) -> np.ndarray:
    """One to one; spreads keys over a table."""
    value = keys * np.uint64(0x9E3779B97F4A7C15)
    return value ^ (value >> np.uint64(32))


def _last_merge(name: str, rank: dict[str, float]) -> tuple[str, str]:
    """The two parts that the model joins last to make the piece ``name``."""
    parts = list(name)
    while len(parts) > 2:
        k = min(range(len(parts) - 1), key=lambda j: (rank.get(parts[j] + parts[j + 1], np.inf), j))
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    return parts[0], parts[1]


def _stands(model: Model, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether merging the text of piece a and piece b gives just a, b.

    The border is undone step by step: of the two pieces at the border, that whose last merge is
    later comes apart first. The pair fails when a merge across the border would have come
    before the merge that closed it; at equal rank the pair further left goes first.
    """
    good = np.ones(len(a), bool)
    left, x, y = np.arange(len(a)), a, b
    limit = np.full(len(a), np.inf)
    right = np.zeros(len(a), bool)  # whether the limiting merge lies right of the border
    many = np.uint64(len(model.rank))
    while len(left):
        joined = model.pairs[_mix(x.astype(np.uint64) * many + y.astype(np.uint64))]
        bad = (joined < limit) | ((joined == limit) & right & np.isfinite(joined))
        good[left[bad]] = False
        rank_x, rank_y = model.rank[x], model.rank[y]
        right = rank_x <= rank_y  # the piece right of the border comes apart
        limit = np.where(right, rank_y, rank_x)
        on = ~bad & (limit > -np.inf)
        left, right, limit = left[on], right[on], limit[on]
        x, y = np.where(right, x[on], model.right[x[on]]), np.where(right, model.left[y[on]], y[on])
    return good


def _viterbi(model: Model, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Last pieces and their lengths for all prefixes of words of one length, which advance together."""
    codes = _codes(words)
    count, size = codes.shape
    longest = min(model.longest, size)
    piece = np.full((longest, size, count), -1, np.int32)  # by length - 1 and beginning
    hashes = np.full(codes.shape, _SEED)
    for k in range(1, longest + 1):
        hashes = _grown(hashes[:, : size - k + 1], codes[:, k - 1 :])
        piece[k - 1, : size - k + 1] = model.pieces[hashes.ravel()].reshape(hashes.shape).T
    last = np.full((size + 1, count), -1, np.int32)  # the backpointers: last piece of a prefix
    back = np.ones((size + 1, count), np.int32)  # and its length
    for end in range(1, size + 1):
        lengths = np.arange(1, min(longest, end) + 1)
        these = piece[lengths - 1, end - lengths]
        k, row = np.nonzero(these >= 0)
        these, k = these[k, row], k + 1
        before = last[end - k, row]
        # an unknown character (-1) or the beginning: anything may follow
        fine = before < 0
        check = np.flatnonzero(~fine)
        fine[check] = _stands(model, before[check], these[check])
        # the maximum: allowed pieces score their length, all others minus infinity
        best = np.zeros(count, np.int64)
        np.maximum.at(best, row[fine], k[fine])
        won = fine & (k == best[row])
        last[end, row[won]] = these[won]
        back[end] = np.maximum(best, 1)
    return last, back


def _trace(model: Model, words: list[str], last: np.ndarray, back: np.ndarray) -> list[list[int]]:
    """Follow the backpointers of all words at once; unknown characters become byte pieces."""
    rows = np.arange(len(words))
    place = np.full(len(words), len(last) - 1)
    out: list[list[int]] = [[] for _ in words]
    found, owners = [], []
    unknown: dict[int, list[tuple[int, int]]] = {}
    step = 0
    while len(rows):
        number = last[place, rows]
        for row in rows[number < 0].tolist():
            unknown.setdefault(row, []).append((step, int(place[rows == row][0])))
        found.append(number)
        owners.append(rows)
        place = place - back[place, rows]
        on = place > 0
        rows, place, step = rows[on], place[on], step + 1
    ids, owner = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    size = np.bincount(owner, minlength=len(words))
    flat = ids[order].tolist()
    at = 0
    for row, n in enumerate(size.tolist()):
        own = flat[at : at + n]
        at += n
        if row in unknown:
            ends = dict(unknown[row])
            own = [
                i for k, number in enumerate(own)
                for i in (
                    [number] if k not in ends
                    else model.byte_ids[list(words[row][ends[k] - 1].encode("utf-8", "replace"))].tolist()[::-1]
                )
            ]
        out[row] = own[::-1]
    return out


def _spaces(model: Model, count: int) -> list[int]:
    """A run of spaces: merged from the left for as long as the model has a longer run."""
    parts: list[int] = []
    longest = max(model.runs)
    parts += [longest] * (count // longest)
    left = count % longest
    while left:
        size = max(n for n in model.runs if n <= left)
        parts.append(size)
        left -= size
    return [model.runs[n] for n in parts]


def encode_words(words: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words, each with the spaces before it; those of equal length are one batch."""
    model = load(path)
    out: list[list[int]] = [[] for _ in words]
    groups: dict[int, list[tuple[int, int, str]]] = {}
    for i, word in enumerate(words):
        body = word.lstrip(b" ").decode()
        spaces = len(word) - len(word.lstrip(b" "))
        if body:
            groups.setdefault(len(body) + 1, []).append((i, spaces, SPACE + body))
        else:
            out[i] = _spaces(model, spaces)
    for size, members in groups.items():
        step = max(1, 200_000 // size)  # bounds the tables of one batch
        for at in range(0, len(members), step):
            some = members[at : at + step]
            bodies = [body for *_, body in some]
            for (i, spaces, _), ids in zip(some, _trace(model, bodies, *_viterbi(model, bodies))):
                if spaces > 1:  # the last space of the run may have joined the word, or not
                    alone = ids[0] == model.runs[1]
                    ids = _spaces(model, spaces - 1 + alone) + ids[alone:]
                out[i] = ids
    return np.array([n for ids in out for n in ids], np.int32), np.array([*map(len, out)], np.int64)


@lru_cache(2)
def _memory(path: str) -> WordMemory:
    return WordMemory(lambda words: encode_words(words, path), WORDS)


def encode_texts(texts: list[str], path: str) -> list[np.ndarray]:
    """Ids of each text; the new words of all of them are encoded together.

    The model puts one space before a text and shows spaces as marks. No piece has a mark after
    another character, so a word with the spaces before it is encoded by itself.
    """
    full = [t for t in texts if t]
    if not full:
        return [np.zeros(0, np.int32) for _ in texts]
    raw = [b" " + t.replace(SPACE, " ").encode() for t in full]
    joined = b"".join(raw)
    size = np.array([len(r) for r in raw])
    first = np.cumsum(size) - size
    space = np.frombuffer(joined, np.uint8) == 32
    begins = space & ~np.concatenate([[False], space[:-1]])
    begins[first] = True
    start = np.flatnonzero(begins)
    ids, ends = _memory(path).encode(joined, start, np.diff(start, append=len(joined)))
    words = np.bincount(np.searchsorted(first, start, "right") - 1, minlength=len(full))
    found = iter(per_text(ids, ends, words))
    return [next(found) if t else np.zeros(0, np.int32) for t in texts]


def decode_ids(ids: np.ndarray, path: str) -> str:
    """The text of ids; broken UTF-8 shows as U+FFFD."""
    text = b"".join(map(load(path).bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")
    return text.removeprefix(" ")


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, n_ids, decoded (the text of the ids) and round_trip (it equals the text).

    One pass without a shuffle. Null and empty text: no ids. Repeated rows are encoded once each;
    only doc_id and text are read. A text that holds the space mark itself decodes to a space
    there, as the model cannot tell them apart; ``round_trip`` is then false.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        encoded = encode_texts(texts, path)
        decoded = [decode_ids(ids, path) for ids in encoded]
        ends = np.cumsum([0, *map(len, encoded)]).astype(np.int32)
        flat = np.concatenate([np.zeros(0, np.int32), *encoded])
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                pa.array(np.diff(ends).astype(np.int64)),
                pa.array(decoded, pa.string()),
                pa.array([a == b for a, b in zip(texts, decoded)], pa.bool_()),
            ],
            names=["doc_id", "ids", "n_ids", "decoded", "round_trip"],
        )

    return in_batches(
        docs.select(F.col("doc_id").cast("long"), text_of().alias("text")),
        run,
        "doc_id long, ids array<int>, n_ids long, decoded string, round_trip boolean",
        1,
        TEXT,
    )


def encoding_report(docs: DataFrame, path: str) -> DataFrame:
    """The ids of every document with digests instead of the decoded text."""
    return encode(docs, path).select(
        "doc_id", "ids", "n_ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        "round_trip",
    )
