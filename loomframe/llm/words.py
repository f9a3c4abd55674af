"""Encode texts word by word with a memory of the words met, all in numpy.

Words are known by 128-bit hashes in an open-addressed table, so that a million of them take
some tens of megabytes and a batch is looked up at once.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Words remembered per task; beyond it the memory starts anew. Longer words are not remembered.
MEMORY, LONGEST = 1_500_000, 255

#: New words that are encoded in one call, if the encoder does not say otherwise.
STEP = 50_000

#: Distinct words -> their ids one after the other, and how many each word has.
Encoder = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]

_draw = np.random.Generator(np.random.PCG64(7))
_BYTES, _PLACES = (
    [_draw.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2)]
    for _ in range(2)
)


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of all runs, one after the other."""
    end = np.cumsum(size, dtype=np.int64)
    return np.repeat(start - (end - size), size) + np.arange(end[-1] if len(end) else 0)


def hash_words(joined: np.ndarray, start: np.ndarray, size: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of bytes; ``which`` chooses one of two independent ones.

    Bytes beyond the first :data:`LONGEST` share their multiplier.
    """
    if not len(start):
        return np.zeros(0, np.uint64)
    first = np.cumsum(size, dtype=np.int64) - size
    letters = joined[spread(start, size)]
    place = np.minimum(spread(np.zeros_like(first), size), LONGEST)
    mixed = _BYTES[which][letters] * _PLACES[which][place]
    mixed ^= mixed >> np.uint64(31)
    hashes = np.add.reduceat(mixed, first)
    hashes ^= hashes >> np.uint64(29)
    return hashes * np.uint64(0xBF58476D1CE4E5B9)


class WordMemory:
    """The ids of words met so far; all new words of a batch are encoded in one call."""

    def __init__(self, encode: Encoder, step: int = STEP):
        self._encode, self._step = encode, step
        self._forget()

    def _forget(self) -> None:
        self._slots = np.full(1 << 16, -1, np.int32)  # number of the word in a slot
        self._low, self._high = (np.zeros(1 << 15, np.uint64) for _ in range(2))
        self._start, self._size = np.zeros(1 << 15, np.uint32), np.zeros(1 << 15, np.uint16)
        self._flat, self._used, self._known = np.zeros(1 << 17, np.int32), 0, 0

    def _find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Numbers of words by their hashes, -1 for new ones."""
        mask = np.uint64(len(self._slots) - 1)
        out = np.full(len(low), -1, np.int64)
        left, at = np.arange(len(low)), (low & mask).astype(np.int64)
        while len(left):
            number = self._slots[at]
            held = number >= 0
            hit = held & (self._low[number] == low[left]) & (self._high[number] == high[left])
            out[left[hit]] = number[hit]
            on = held & ~hit
            left, at = left[on], (at[on] + 1) & int(mask)
        return out

    def _place(self, first: int) -> None:
        """Put the words from number ``first`` on into free slots."""
        mask = len(self._slots) - 1
        left = np.arange(first, self._known)
        at = (self._low[left] & np.uint64(mask)).astype(np.int64)
        while len(left):
            free = self._slots[at] < 0
            self._slots[at[free]] = left[free]  # of several for one slot the last stays
            on = self._slots[at] != left
            left, at = left[on], (at[on] + 1) & mask

    def _learn(self, low: np.ndarray, high: np.ndarray, words: list[bytes]) -> None:
        # some words at a time, as encoders hold much beside the ids
        parts = [self._encode(words[at : at + self._step]) for at in range(0, len(words), self._step)]
        flat, size = (np.concatenate(some) for some in zip(*parts))
        known, total = self._known, self._known + len(words)
        for name in ("_low", "_high", "_start", "_size"):
            setattr(self, name, _room(getattr(self, name), total))
        self._flat = _room(self._flat, self._used + len(flat))
        self._flat[self._used : self._used + len(flat)] = flat
        self._low[known:total], self._high[known:total] = low, high
        self._size[known:total] = size
        self._start[known:total] = self._used + np.cumsum(size) - size
        self._used += len(flat)
        self._known = total
        if 2 * total > len(self._slots):
            self._slots = np.full(1 << int(3 * total).bit_length(), -1, np.int32)
            known = 0
        self._place(known)

    def encode(self, joined: bytes, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words at these places, one after the other, and where each word's end."""
        held = np.frombuffer(joined, np.uint8)
        short = np.flatnonzero(size <= LONGEST)
        low, high = (hash_words(held, start[short], size[short], k) for k in range(2))
        number = self._find(low, high)
        new = np.flatnonzero(number < 0)
        if len(new):
            if self._known + len(new) > MEMORY:
                self._forget()
                new = np.arange(len(low))
            # several numbers of one word would do no harm, but take room
            order = np.lexsort((high[new], low[new]))
            a, b = low[new][order], high[new][order]
            once = new[order[np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])]]
            places = zip(start[short[once]].tolist(), size[short[once]].tolist())
            self._learn(low[once], high[once], [joined[s : s + n] for s, n in places])
            number[new] = self._find(low[new], high[new])
        own_start, own_size = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        own_start[short], own_size[short] = self._start[number], self._size[number]
        flat = self._flat[: self._used]
        long = np.flatnonzero(size > LONGEST)
        if len(long):
            more, count = self._encode([joined[start[i] : start[i] + size[i]] for i in long])
            own_start[long], own_size[long] = len(flat) + np.cumsum(count) - count, count
            flat = np.concatenate([flat, more])
        return flat[spread(own_start, own_size)], np.cumsum(own_size)


def _room(values: np.ndarray, needed: int) -> np.ndarray:
    """``values`` with room for ``needed`` of them."""
    if needed <= len(values):
        return values
    more = max(needed, len(values) * 5 // 4) - len(values)
    return np.concatenate([values, np.zeros(more, values.dtype)])


def per_text(ids: np.ndarray, ends: np.ndarray, words: np.ndarray) -> list[np.ndarray]:
    """The ids of each text, given how many words it has."""
    cuts = np.concatenate([[0], ends])[np.cumsum([0, *words])].tolist()
    return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
