"""Both encoders against their libraries, round trips, and packing against its rules."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from loomframe.llm import packing, pieces, words
from loomframe.llm.queries import PIECE_MODEL, WORD_MODEL

PARTS = [
    "a", "b", "the", "ing", " ", "  ", "   ", " " * 15, " " * 17, "\n", "\t", "é", "ß", "▁", "\xa0", "1",
    "23", ".", "!!", "和", "日", "𝔘", "\x00", "\x01", "\x1c", "<s>", "aaaa", "==", "----", "'s", "İ", "Σς",
    "<|endoftext|>", "é", "H̱",
]


@pytest.fixture(scope="module")
def samples():
    draw = random.Random(3)
    mixed = ["".join(draw.choices(PARTS, k=draw.randint(0, 50))) for _ in range(1500)]
    plain = ["".join(draw.choices("etaoin shrdlu", k=draw.randint(0, 90))) for _ in range(1500)]
    return [*mixed, *plain, "x" * 3000, "w " * 5000, *(" " * n for n in range(40))]


def test_pieces_equal_the_library(samples):
    library = SentencePieceProcessor(model_file=PIECE_MODEL)
    got = pieces.encode_texts(samples, PIECE_MODEL)
    assert [g.tolist() for g in got] == [library.encode(t) for t in samples]
    assert [pieces.decode_ids(g, PIECE_MODEL) for g in got] == [library.decode(library.encode(t)) for t in samples]


def test_words_equal_the_library(samples):
    library = Tokenizer.from_file(WORD_MODEL)
    got = packing.encode_texts(samples, WORD_MODEL)
    assert [g.tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in samples]


def test_a_full_memory_starts_anew(samples, monkeypatch):
    monkeypatch.setattr(words, "MEMORY", 50)
    test_words_equal_the_library(samples[:300])
    test_pieces_equal_the_library(samples[:300])


def test_round_trip_of_a_table(spark):
    texts = ["Hello  world", None, "", "a▁b", "née\n\tx ", "y" * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pieces.encode(docs, PIECE_MODEL).collect()}
    assert all(got[i].round_trip for i in (0, 1, 2, 4, 5)) and not got[3].round_trip
    assert got[3].decoded == "a b" and got[1].n_ids == 0
    assert pieces.encode(docs.limit(0), PIECE_MODEL).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_patterns_hold_each_piece_once(lengths):
    counts = np.bincount(lengths, minlength=65)
    patterns = packing.pack_histogram(counts, 64)
    held = np.zeros(65, int)
    for many, pattern in patterns:
        assert sum(pattern) <= 64
        np.add.at(held, pattern, many)
    assert (held[1:] == counts[1:]).all()


def test_packed_table(spark):
    draw = random.Random(5)
    texts = [" ".join(draw.choices(["cat", "dog", "Straße", "x1"], k=draw.randint(0, 300))) for _ in range(150)]
    texts += [None, "", "word " * 1000]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(None, "null id", 1), (0, texts[0], 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset int").repartition(4)
    got = packing.pack(docs, WORD_MODEL, 128).collect()
    library = Tokenizer.from_file(WORD_MODEL)
    want = sorted((-1 if i is None else i, [*library.encode(t or "", add_special_tokens=False).ids, 1]) for i, t, _ in rows)
    by_start = defaultdict(list)
    for r in got:
        by_start[-1 if r.doc_id is None else r.doc_id].append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids)
    for key, ids in want:
        mine = [p for p in by_start[key] if p.doc_tokens == len(ids)]
        flat = {p.start: p.ids for p in mine}
        assert [t for s in sorted(flat) for t in flat[s]] == ids
    assert sum(r.length for r in got) == sum(len(ids) for _, ids in want)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 128
    assert len(sequences) <= 1.2 * sum(r.length for r in got) / 128 + 1
    assert packing.pack(docs.limit(0), WORD_MODEL).count() == 0
