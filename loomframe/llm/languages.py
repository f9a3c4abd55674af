"""Language identification: spans of one language in texts that may mix several.

A word's script narrows the languages it may belong to; the letter sequences of the word give each
of these a score; and Viterbi over the words of a text, with a penalty for every change of
language, labels its spans. A text has the language that holds most of its letters.

Rates are counted on a bounded draw of documents of each language. The texts of a batch are
decoded side by side, word by word, so Python runs once per place and not once per word.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from loomframe.llm.common import in_batches, remainder, slices, text_of
from loomframe.session import ship_package

#: Documents of each language that the rates are counted on.
TRAIN_ROWS = 1000

#: Table of letter sequences per language, and lengths of the sequences (word borders included).
BUCKETS, LENGTHS = 1 << 16, (2, 3, 4)

#: The most a word can speak against a language, the cost of a change, and of a foreign script.
CLIP, SWITCH, FOREIGN = 12.0, 8.0, 24.0

#: Share of a language's letters from which a script counts as its own.
OWN_SCRIPT = 0.01

#: First code points of runs of letters in one script, and the script. Fixed values.
SCRIPTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Syriac"), (0x0750, "Arabic"), (0x0780, "Thaana"), (0x07C0, "Nko"),
    (0x08A0, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"),
    (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"),
    (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Cherokee"), (0x1780, "Khmer"),
    (0x1800, "Mongolian"), (0x1C80, "Cyrillic"), (0x1C90, "Georgian"), (0x1D00, "Latin"), (0x1F00, "Greek"),
    (0x2000, "Latin"), (0x2DE0, "Cyrillic"), (0x2E80, "Han"), (0x3040, "Kana"), (0x3100, "Bopomofo"),
    (0x3130, "Hangul"), (0x31F0, "Kana"), (0x3200, "Han"), (0xA000, "Yi"), (0xA640, "Cyrillic"),
    (0xA720, "Latin"), (0xA960, "Hangul"), (0xAA00, "other"), (0xAB30, "Latin"), (0xAC00, "Hangul"),
    (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFF00, "Latin"),
    (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0x10000, "other"), (0x20000, "Han"),
]
_NAMES = sorted({name for _, name in SCRIPTS})
_STARTS = np.array([start for start, _ in SCRIPTS])
_SCRIPT = np.array([_NAMES.index(name) for _, name in SCRIPTS])

_RUN = re.compile(r"[^\W\d_]+")
_EDGE = "\x02"
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


# --- words and letter sequences -----------------------------------------------------------------

@dataclass(frozen=True)
class Lexicon:
    """Distinct words: lower-cased letters, scripts, and the letter sequences of each."""

    sizes: np.ndarray
    script: np.ndarray
    owner: np.ndarray
    bucket: np.ndarray

    @classmethod
    def of(cls, words: Sequence[str]) -> Lexicon:
        low = [w.lower() for w in words]
        points = np.frombuffer((_EDGE + _EDGE.join([*low, ""])).encode("utf-32-le", "surrogatepass"), np.uint32)
        edge = points == ord(_EDGE)
        word = np.cumsum(edge) - 1
        first = np.flatnonzero(edge)[:-1] + 1 if len(low) else np.zeros(0, np.int64)
        owners, buckets = [], []
        for n in LENGTHS:
            if len(points) < n:
                continue
            mixed = np.full(len(points) - n + 1, n, np.uint64) * _ODD[0]
            inner = np.zeros(len(mixed), bool)
            for i in range(n):
                mixed = (mixed ^ points[i : i + len(mixed)].astype(np.uint64)) * _ODD[i]
                mixed ^= mixed >> np.uint64(29)
                if 0 < i < n - 1:
                    inner |= edge[i : i + len(mixed)]
            at = np.flatnonzero(~inner & (word[: len(mixed)] < len(low)))
            owners.append(word[at])
            buckets.append((mixed[at] % np.uint64(BUCKETS)).astype(np.int64))
        letters = _SCRIPT[np.searchsorted(_STARTS, points[first], "right") - 1]
        none = [np.zeros(0, np.int64)]
        return cls(
            np.array([len(w) for w in words], np.int64), letters, np.concatenate(owners or none), np.concatenate(buckets or none)
        )


class Texts:
    """The words of several texts as numbers of distinct words, one text after the other."""

    def __init__(self, texts: Sequence[str]):
        number = defaultdict(count().__next__)
        codes = [np.fromiter(map(number.__getitem__, found), np.int64, len(found)) for found in map(_RUN.findall, texts)]
        # what counts as alphanumeric may still be without a letter
        real = np.array([any(map(str.isalpha, w)) for w in number], bool)
        if not real.all():
            codes = [c[real[c]] for c in codes]
        self.length = np.array([len(c) for c in codes], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.words = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        self.lexicon = Lexicon.of(list(number))


# --- the model ----------------------------------------------------------------------------------

@dataclass(frozen=True)
class Model:
    languages: list[str]
    #: log rates of letter sequences: bucket, language
    rates: np.ndarray
    #: whether a script is one of a language's own: script, language
    own: np.ndarray

    def emissions(self, words: Lexicon) -> tuple[np.ndarray, np.ndarray]:
        """Score of each word in each language, at most 0; and whether the word's script is its own."""
        n, k = len(words.sizes), len(self.languages)
        score = np.empty((n, k))
        for j in range(k):
            score[:, j] = np.bincount(words.owner, self.rates[words.bucket, j], minlength=n)
        own = self.own[words.script]
        # a script that no language has says nothing
        score[~own.any(1)] = 0
        candidates = np.where(own, score, -np.inf)
        best = np.where(own.any(1), candidates.max(1), 0)
        return np.where(own | ~own.any(1)[:, None], np.maximum(score - best[:, None], -CLIP), -FOREIGN), own


def viterbi(score: np.ndarray, words: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Language of each word on the best path of its text; a tie stays, then takes the first.

    ``score``: by distinct word and language; ``words``: of all texts; texts by start and length.
    Texts are decoded side by side, the longest first.
    """
    k = score.shape[1]
    order = np.argsort(-length, kind="stable")
    start, length = start[order], length[order]
    alive = np.searchsorted(-length, -np.arange(1, length[0] + 1), "right") if len(length) else []
    back = np.empty((len(words), k), np.int16)
    best = np.zeros((len(length), k))
    own = np.arange(k, dtype=np.int16)
    for t, m in enumerate(alive):
        at = start[:m] + t
        now = best[:m]
        if t:
            top = now.argmax(1)
            change = now[np.arange(m), top] - SWITCH
            moves = now < change[:, None]
            back[at] = np.where(moves, top[:, None], own)
            now = np.where(moves, change[:, None], now)
        best[:m] = now + score[words[at]]
    out = np.empty(len(words), np.int16)
    state = best.argmax(1)
    for t in range(len(alive) - 1, -1, -1):
        at = start[: alive[t]] + t
        out[at] = state[: alive[t]]
        if t:
            state[: alive[t]] = back[at, state[: alive[t]]]
    return out


def predict(model: Model | None, texts: Sequence[str]) -> tuple[list[str], np.ndarray]:
    """Language of each text, and the share of its letters in it (and in a script of it)."""
    found = Texts(texts)
    if model is None:
        return ["und"] * len(texts), np.zeros(len(texts))
    score, own = model.emissions(found.lexicon)
    path = viterbi(score, found.words, found.start, found.length)
    k, text = len(model.languages), np.repeat(np.arange(len(texts)), found.length)
    letters = found.lexicon.sizes[found.words].astype(float)
    held = np.bincount(text * k + path, letters, minlength=len(texts) * k).reshape(-1, k)
    best = held.argmax(1)
    sure = np.bincount(
        text, letters * (own[found.words, path] & (path == best[text])), minlength=len(texts)
    )
    total = np.maximum(held.sum(1), 1)
    names = [model.languages[b] if n else "und" for b, n in zip(best, found.length)]
    return names, np.where(found.length > 0, sure / total, 0.0)


def find_spans(model: Model | None, text: str) -> list[tuple[int, int, str]]:
    """(start, end, language) of each stretch of words in one language; code points."""
    found = [m.span() for m in _RUN.finditer(text) if any(map(str.isalpha, m.group()))]
    if model is None or not found:
        return []
    one = Texts([text])
    path = viterbi(model.emissions(one.lexicon)[0], one.words, one.start, one.length)
    cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
    return [(found[a][0], found[b - 1][1], model.languages[path[a]]) for a, b in zip(cuts, cuts[1:])]


# --- learning and labelling -----------------------------------------------------------------------

def draw(docs: DataFrame, trains: Column, rows: int = TRAIN_ROWS) -> DataFrame:
    """lang and text of at most ``rows`` documents of each language.

    Documents are drawn by a hash of their id, so the draw is the same on any partitioning; of rows
    that share an id one is drawn, by its text's hash. Rows without an id, a language or a text do
    not take part.
    """
    known = docs.where(trains & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    ids = known.groupBy(F.col("lang").cast("string").alias("lang"), "doc_id").agg(F.min(F.xxhash64("text")).alias("text_hash"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    some = ids.withColumn("part", F.pmod(F.xxhash64("doc_id", "lang"), F.lit(64)))
    for keys in (["lang", "part"], ["lang"]):
        some = some.withColumn("place", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("place") <= rows)
    drawn = some.select("lang", "doc_id", "text_hash")
    texts = docs.select(F.col("lang").cast("string").alias("lang"), "doc_id", "text", F.xxhash64("text").alias("text_hash"))
    # at most `rows` ids for each language
    found = texts.join(F.broadcast(drawn), ["lang", "doc_id", "text_hash"])
    return found.dropDuplicates(["lang", "doc_id", "text_hash"]).select("lang", "text")


def train(docs: DataFrame, trains: Column, rows: int = TRAIN_ROWS) -> Model | None:
    """Rates of letter sequences and scripts by language; None without a language to learn.

    The model holds :data:`BUCKETS` rates per language, and is all that reaches the driver.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, 1):
                by_lang = defaultdict(list)
                for lang, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    by_lang[lang].append(text)
                for lang, texts in by_lang.items():
                    found = Texts(texts)
                    words = found.lexicon
                    times = np.bincount(found.words, minlength=len(words.sizes))
                    sums = np.bincount(words.bucket, times[words.owner], minlength=BUCKETS)
                    scripts = np.bincount(words.script, times * words.sizes, minlength=len(_NAMES))
                    both = np.concatenate([sums, scripts])
                    key = np.flatnonzero(both)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(key), pa.string()), pa.array(key, pa.int32()), pa.array(both[key].astype(np.int64))],
                        names=["lang", "key", "n"],
                    )

    sums = draw(docs, trains, rows).mapInArrow(run, "lang string, key int, n long")
    table = sums.groupBy("lang", "key").agg(F.sum("n").alias("n")).toPandas()
    if not len(table):
        return None
    languages = sorted(table["lang"].unique())
    counts = np.zeros((BUCKETS + len(_NAMES), len(languages)))
    counts[table["key"], np.searchsorted(languages, table["lang"].to_numpy().astype(str))] = table["n"]
    grams, letters = counts[:BUCKETS], counts[BUCKETS:]
    rates = np.log((grams + 0.5) / (grams.sum(0) + 0.5 * BUCKETS)) / len(LENGTHS)
    return Model(languages, rates, letters >= OWN_SCRIPT * np.maximum(letters.sum(0), 1))


def may_learn() -> Column:
    """Rows that are not held out."""
    return remainder("doc_id", 3) != 1


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred and score of every row.

    ``und`` with score 0 if the text is null, empty or without a letter, or if no language could
    be learned. Ties go to the language that sorts first. Repeated rows get equal results, rows
    without doc_id are labelled too; an empty table gives no rows. Other columns are not read.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, score = predict(model, batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"]
        )

    return in_batches(
        docs.select(F.col("doc_id").cast("long"), text_of().alias("text")), run,
        "doc_id long, lang_pred string, score double", 1, 8_000_000,
    )


def label_spans(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, start, end, lang: a row per span, code points, end exclusive; none without letters."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [
            (doc_id, *span)
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for span in find_spans(model, text)
        ]
        columns = list(zip(*rows)) if rows else [[]] * 4
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "start", "end", "lang"]
        )

    return in_batches(
        docs.select(F.col("doc_id").cast("long"), text_of().alias("text")), run,
        "doc_id long, start long, end long, lang string", 1,
    )


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; the model learns from the rows that are not held out."""
    named = identify(docs, train(docs, may_learn()))
    return named.select("doc_id", (~may_learn()).alias("held_out"), "lang_pred", "score")
