from __future__ import annotations

import itertools

import numpy as np
import pytest

from conftest import SF_DIR
from loomframe.llm import languages as lg

FOLDER = SF_DIR.replace("sf0.001", "sf0.01")
SCHEMA = "doc_id long, text string, lang string, score int, lang_pred string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return lg.train(docs, lg.may_learn())


def plain_path(score):
    """Best path by trying all of them; of equal ones any."""
    n, k = score.shape
    value = lambda p: sum(score[i, s] for i, s in enumerate(p)) - lg.SWITCH * sum(a != b for a, b in zip(p, p[1:]))
    return max(value(p) for p in itertools.product(range(k), repeat=n)), value


def test_viterbi_against_all_paths():
    draw = np.random.default_rng(1)
    score = -draw.integers(0, 24, (12, 3)).astype(float)
    lengths = np.array([5, 0, 1, 7, 3])
    words = draw.integers(0, 12, lengths.sum())
    start = np.cumsum(lengths) - lengths
    path = lg.viterbi(score, words, start, lengths)
    for a, n in zip(start, lengths):
        best, value = plain_path(score[words[a : a + n]])
        assert value(path[a : a + n].tolist()) == best


def test_letter_sequences_against_plain_slices():
    """Words get equal buckets for equal sequences, and as many as their slices."""
    words = ["the", "then", "a", "né", "THE"]
    found = lg.Lexicon.of(words)
    own = [sorted(found.bucket[found.owner == i]) for i in range(len(words))]
    sequences = [
        [f"\2{w.lower()}\2"[i : i + n] for n in lg.LENGTHS for i in range(len(w) + 3 - n)] for w in words
    ]
    assert [len(s) for s in sequences] == [len(o) for o in own] and own[0] == own[4]
    number = {}
    for seqs, i in zip(sequences, range(len(words))):
        for s in seqs:
            number.setdefault(s, set()).update(own[i] if not number.get(s) else number[s] & set(own[i]))
    assert all(number.values())


def test_scores_of_words_against_plain_sums():
    rates = np.random.default_rng(0).normal(size=(lg.BUCKETS, 2))
    own = np.zeros((len(lg._NAMES), 2), bool)
    own[lg._NAMES.index("Latin")] = True
    own[lg._NAMES.index("Greek"), 1] = True
    words = lg.Lexicon.of(["abc", "λόγος", "слово", "x"])
    score, mine = lg.Model(["aa", "bb"], rates, own).emissions(words)
    for i in (0, 3):
        sums = rates[words.bucket[words.owner == i]].sum(0)
        assert np.allclose(score[i], np.maximum(sums - sums.max(), -lg.CLIP))
    assert score[1].tolist() == [-lg.FOREIGN, 0] and score[2].tolist() == [0, 0]
    assert mine.tolist() == [[True, True], [False, True], [False, False], [True, True]]


def test_held_out_documents(docs, model):
    got = lg.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(~lg.may_learn())
    assert got.count() > 200
    assert got.where("lang_pred = lang").count() >= 0.99 * got.where("lang is not null").count()
    assert got.where("score < 0 or score > 1").count() == 0


def test_mixed_text_has_spans(docs, model):
    texts = {r.lang: " ".join(r.text.split()[:40]) for r in docs.where("length(text) > 2000").orderBy("doc_id").collect()}
    mixed = "\n\n".join(texts[lang] for lang in ("en", "de", "fr"))
    spans = lg.find_spans(model, mixed)
    assert [s[2] for s in spans] == ["en", "de", "fr"]
    for (start, end, lang), text in zip(spans, (texts[k] for k in ("en", "de", "fr"))):
        assert abs((end - start) - len(text)) < 0.15 * len(text)
    names, score = lg.predict(model, [mixed, texts["en"]])
    assert names[1] == "en" and score[1] > 0.95 and 0.2 < score[0] < 0.7


def test_odd_rows(spark, docs, model):
    text = docs.where("lang = 'de'").orderBy("doc_id").first().text
    rows = [
        (1, None), (2, ""), (3, "12 ² ½ _ --- 3.5"), (4, text), (4, text), (None, text), (5, "λόγος и слово"),
        (6, (text + " ") * 300), (7, "x" * 1_000_000),
    ]
    df = spark.createDataFrame([(i, t, "zz", 3, "q") for i, t in rows], SCHEMA)
    got = lg.identify(df, model).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1, 2, 3))
    assert by_id[4].lang_pred == by_id[None].lang_pred == by_id[6].lang_pred == "de"
    assert by_id[5].lang_pred in model.languages and by_id[5].score == 0 and by_id[7].lang_pred in model.languages
    spans = lg.label_spans(df, model).collect()
    assert {r.doc_id for r in spans} == {4, 5, 6, 7, None}
    assert all(0 <= r.start < r.end for r in spans)


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "some text", None, 0, ""), (2, None, "en", 0, "")], SCHEMA)
    assert {r.lang_pred for r in lg.report(df).collect()} == {"und"}
    assert lg.report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_draw_is_bounded_and_the_same_on_any_partitioning(spark):
    rows = [(i % 400, f"text {i}", "en" if i % 3 else "de", 0, "") for i in range(1200)] * 2
    df = spark.createDataFrame(rows, SCHEMA)
    one, other = (lg.draw(d, df["doc_id"] >= 0, 30) for d in (df.repartition(1), df.repartition(9)))
    assert sorted(one.collect()) == sorted(other.collect())
    assert {r["lang"]: r["count"] for r in one.groupBy("lang").count().collect()} == {"en": 30, "de": 30}
