from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from loomframe.llm import collocations
from loomframe.session import ship_package

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "lang string, text string, n long, rank int, phrase string"


def plain(rows, least, longest, top):
    """The result as its definition reads, on tuples of language and text."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = set()
    for lang, counts in f.items():
        frequent = [p for p, a in counts.items() if len(p) > 1 and a >= least]
        inside = {
            d[i : i + k] for d in frequent for k in range(2, len(d)) for i in range(len(d) - k + 1)
            if counts[d] >= counts[d[i : i + k]]
        }
        scored = []
        for p in set(frequent) - inside:
            a = counts[p]
            cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return out


ROWS = [
    ("en", "The cat sat on the mat. The cat sat, the cat ran!"), ("en", "the CAT sat on the mat\nthe cat\tsat"),
    ("de", "die die die die katze; die die katze"), (None, "a b a b a b a b"), ("und", "a b c a b c"), ("en", None),
    ("en", ""), ("en", " \t.,;\n"), ("fr", "été   été été ÉTÉ été"), ("fr", "été ÉTÉ"), ("de", "die katze\x0bdie katze"),
    ("xx", "one two three four five six seven " * 20), ("xx", "a.b.c"), ("en", "The cat sat on the mat. The cat sat, the cat ran!"),
]


@pytest.mark.parametrize("least, longest, top", [(2, 5, 2000), (3, 5, 4), (1, 3, 50), (2, 2, 3)])
def test_equals_its_definition(spark, least, longest, top):
    df = spark.createDataFrame([(*r, 7, 7, "x") for r in ROWS], SCHEMA).repartition(5)
    got = collocations.collocations(df, least, longest, top)
    assert {tuple(r) for r in got.collect()} == plain(ROWS, least, longest, top)


def test_cuts_of_long_texts_and_small_blocks_change_nothing(spark):
    want = plain(ROWS, 2, 5, 2000)
    df = spark.createDataFrame([(*r, 7, 7, "x") for r in ROWS], SCHEMA)
    assert {tuple(r) for r in collocations.collocations(df, 2, 5, 2000, block=12, cut=9).collect()} == want


def test_bitmap_holds_all_groups_and_little_else(spark):
    groups = spark.range(1, 40_000, 7).selectExpr("id * 8589934592 as head", "id as tail")
    bitmap = collocations._bitmap(groups, collocations._pair_bit(groups["head"], groups["tail"]))
    head, tail = (groups.toPandas()[c].to_numpy() for c in ("head", "tail"))
    assert collocations._set(bitmap, collocations._pair_bit(head, tail)).all()
    assert collocations._set(bitmap, collocations._pair_bit(head + 3, tail + 1)).mean() < 0.01


def test_products_beyond_64_bits(spark):
    phrases = spark.createDataFrame(
        [("en", ["a", "b"], 3 * 10**14, [4 * 10**14, 3 * 10**14], [5 * 10**14, 3 * 10**14])],
        "lang string, words array<string>, a long, heads array<long>, tails array<long>",
    )
    sizes = spark.createDataFrame([("en", 9 * 10**14)], "lang string, n long")
    (row,) = collocations._scored(phrases, sizes, 5).collect()
    assert row.score == 1000 * (3 * 10**14) * (9 * 10**14) // (4 * 10**14 * 5 * 10**14)


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_counts_cross_the_network_in_packed_lists(spark, monkeypatch):
    """Pairs of many blocks and tasks: sums as by brute force, from few messages."""
    ship_package(spark)
    rng = np.random.default_rng(0)
    blocks = []
    for i in range(12):
        code = rng.integers(0, 40, 500)
        ids = (np.arange(40) % 7 << 33) + np.arange(40)
        at, own = np.arange(500), np.ones(500, bool)
        packed = collocations._pack(np.diff(at, prepend=0)), collocations._pack(code), np.packbits(own).tobytes()
        blocks.append((i, *packed, collocations._pack(ids, 8), code, ids))
    stored = spark.createDataFrame([b[:5] for b in blocks], collocations._RELATION_SQL).repartition(3)
    want = Counter((int(ids[x]), int(ids[y])) for *_, code, ids in blocks for x, y in zip(code, code[1:]))
    for merged in (300, 1_000_000):
        monkeypatch.setattr(collocations, "MERGED", merged)
        got = {(r.head, r.tail): r.a for r in collocations._totals(stored, 32, 4).collect()}
        assert got == {pair: n for pair, n in want.items() if n >= 4}
    assert collocations._totals(stored.limit(0), 32, 1).count() == 0


def test_words_cross_the_network_in_packed_lists(spark, monkeypatch):
    """Words of many blocks and tasks: sums and numbers as by brute force, from few messages."""
    ship_package(spark)
    rng = np.random.default_rng(1)
    langs = ["en", "e n", "", "x\0\ny"]
    rows = [
        (langs[i % 4], " ".join(f"w{k}" if k else "été" for k in rng.integers(0, 30, 50)) + " once" + str(i))
        for i in range(40)
    ] + [("en", ".,;"), ("en", "")]
    blocks = collocations._blocks(spark.createDataFrame(rows, "lang string, text string").repartition(3), 2, 200, 1000)
    blocks = spark.createDataFrame(blocks.collect(), blocks.schema).repartition(3)
    want = Counter((lang, word) for lang, text in rows for word in re.findall("[^ .,;]+", text))
    for words in (5, 1_000_000):
        monkeypatch.setattr(collocations, "WORDS", words)
        totals = collocations._word_totals(blocks, 7, 2)
        assert {(r.lang, r.word): r.a for r in totals.collect()} == {k: n for k, n in want.items() if n >= 2}
    ids = {key: i << 33 for i, key in enumerate(sorted(k for k, n in want.items() if n >= 2))}
    groups = spark.createDataFrame([(*k, i) for k, i in ids.items()], "lang string, word string, gid long")
    got, messages = defaultdict(dict), Counter()
    for r in collocations._found_words(blocks, groups, 7).collect():
        messages[r.block] += 1
        got[r.block].update(
            zip(np.cumsum(collocations._numbers(r.number)).tolist(), np.cumsum(collocations._numbers(r.gid, 8)).tolist())
        )
    assert max(messages.values()) <= 7
    for r in blocks.collect():
        keys = [k.decode().rsplit(" ", 1) for k in collocations._keys(r["keys"])]
        numbers = collocations._numbers(r.numbers).tolist()
        assert got[r.block] == {n: ids[tuple(k)] for n, k in zip(numbers, keys) if tuple(k) in ids}
    assert collocations._word_totals(blocks.limit(0), 32, 1).count() == 0


def test_no_join_or_count_deals_rows_by_word(spark, monkeypatch):
    """One row for each word of a block grows faster than the input as more words become frequent."""
    plans, stage = {}, collocations.stage

    def kept(df, label):
        plans.setdefault(label, df._jdf.queryExecution().analyzed().toString())
        return stage(df, label)

    monkeypatch.setattr(collocations, "stage", kept)
    collocations.collocations(spark.createDataFrame([(*r, 7, 7, "x") for r in ROWS], SCHEMA), 2)
    assert not re.search(r"Join .*word|Aggregate \[.*word", plans["words"] + plans["occurrences"])


@pytest.mark.parametrize("width, values", [(4, []), (4, [0, 0]), (4, [5, -1, 2**31 - 1]), (8, [-(2**62), 3, 1 << 40])])
def test_numbers_and_keys_pack_without_loss(width, values):
    packed = collocations._pack(np.array(values, np.int64), width)
    assert collocations._numbers(packed, width).tolist() == values
    keys = [str(v).encode() * (i + 1) for i, v in enumerate(values)]
    assert collocations._keys(collocations._pack_keys(keys)) == keys
