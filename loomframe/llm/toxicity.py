"""Toxicity by weak supervision.

Many weak voters look at every document: one per word or word stem found in the labelled training
rows, patterns of style, and the given labels themselves as one more fallible voter that speaks
on few documents. A generative model of a hidden class estimates from their agreements how often
each fires on either class, and which of them depend on each other; dependent voters share one
vote. Its posterior labels train a linear classifier over hashed words and stems of all rows that
may be learned, and that classifier alone scores the documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomframe.llm.common import in_batches, remainder, slices, text_of
from loomframe.llm.features import Words, find_words, labelled_sample
from loomframe.llm.words import hash_words
from loomframe.session import discard, ship_package, stage

#: Labelled documents the lexicon comes from, at most.
TRAIN_ROWS = 12_000
#: Voters from the lexicon, items considered for it, and the least share of toxic families of one.
LEXICON, CANDIDATES, LEAST_SHARE = 56, 160, 0.02
#: The least log-likelihood gain of an item, and the share with a stronger one that rules it out.
LEAST_GAIN, CONTAINED = 15.0, 0.75
#: A bucket gets a weight where the errors of its rows sum to more than one row, and to more than
#: this times the root of their number.
DOUBT = 0.25
#: Buckets that join the fit at a time; four passes for each time, if all join, and for each of PASSES.
JOINING, PASSES = 48, 60
#: A stem is a word's first bytes, of these lengths; it counts where this share of words has it.
STEMS, STEM_SHARE = (4, 6, 8, 10), 0.01
THRESHOLD = 0.7
BUCKETS = 1 << 18
#: Numbers of a summed vector that travel together.
CHUNK = 4096

#: Bytes: A-Z lowered, other ASCII signs and digits blank.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

#: Style patterns, with the least value that fires: shares of bytes or of words. Fixed values.
PATTERNS = (
    ("shouting", 0.02), ("capitals", 0.4), ("second_person", 0.02), ("repeats", 0.2),
    ("stretched", 0.005), ("symbols", 0.05),
)
_YOU = ("you", "your", "u", "du", "dich", "tu", "toi", "vous", "usted")


# --- voters -----------------------------------------------------------------------------------

def _hashes(words: tuple[str, ...]) -> np.ndarray:
    return np.unique(find_words([" ".join(words)], FOLD).hashes)


def _styles(texts: list[str], words: Words) -> np.ndarray:
    """Which style patterns fire on each text."""
    n = len(texts)
    size = np.array([max(1, len(t.encode())) for t in texts])
    count = np.maximum(np.bincount(words.text, minlength=n), 1)
    first = np.cumsum([0, *(len(t.encode()) + 1 for t in texts)])[:-1]
    raw = np.frombuffer("\n".join(texts).encode() + b"\n", np.uint8)

    def share(hit: np.ndarray) -> np.ndarray:
        return np.add.reduceat(hit.astype(np.int64), first) / size if n else np.zeros(0)

    same = np.zeros(len(words.hashes), bool)
    same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (words.text[1:] == words.text[:-1])
    you = np.isin(words.hashes, _hashes(_YOU))
    triple = np.zeros(len(raw), bool)
    triple[2:] = (raw[2:] == raw[1:-1]) & (raw[2:] == raw[:-2]) & (raw[2:] >= 97) & (raw[2:] <= 122)
    values = {
        "shouting": share(raw == 33),
        "capitals": share((raw >= 65) & (raw <= 90)),
        "second_person": np.bincount(words.text[you], minlength=n) / count,
        "repeats": np.bincount(words.text[same], minlength=n) / count,
        "stretched": share(triple),
        "symbols": share(np.isin(raw, np.frombuffer(b"#$%&*@^|~", np.uint8))),
    }
    return np.column_stack([values[name] >= least for name, least in PATTERNS])


def _bucket(item: np.ndarray) -> np.ndarray:
    return (item % np.uint64(BUCKETS)).astype(np.int64)


def _distinct(text: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, item) pairs and how often each stands there."""
    order = np.lexsort((item, text))
    text, item = text[order], item[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1])
    first = np.flatnonzero(new)
    return text[first], item[first], np.diff(first, append=len(text))


def items(words: Words, texts: int, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, item) pairs: the words of a text, and stems that are frequent in it.

    ``wanted``: which buckets of items to look for; all by default.
    """
    count = np.bincount(words.text, minlength=texts)
    found = []
    for size in (0, *STEMS):
        if size:
            some = np.flatnonzero(words.size > size)
            item = hash_words(words.joined, words.start[some], np.full(len(some), size)) + np.uint64(size)
        else:
            some, item = np.arange(len(words.size)), words.hashes
        text = words.text[some]
        if wanted is not None:
            asked = wanted[_bucket(item)]
            text, item = text[asked], item[asked]
        text, item, times = _distinct(text, item)
        often = times >= STEM_SHARE * count[text] if size else slice(None)
        found.append((text[often], item[often]))
    return np.concatenate([t for t, _ in found]), np.concatenate([i for _, i in found])


def votes(texts: list[str], lexicon: np.ndarray) -> np.ndarray:
    """A row per text, a column per voter: whether it fires. ``lexicon``: sorted item hashes."""
    words = find_words(texts, FOLD)
    fired = np.zeros((len(texts), len(lexicon) + len(PATTERNS)), bool)
    if len(lexicon):
        wanted = np.zeros(BUCKETS, bool)
        wanted[_bucket(lexicon)] = True
        text, item = items(words, len(texts), wanted)
        at = np.minimum(np.searchsorted(lexicon, item), len(lexicon) - 1)
        hit = lexicon[at] == item
        fired[text[hit], at[hit]] = True
    if texts:
        fired[:, len(lexicon) :] = _styles(texts, words)
    return fired


@dataclass(frozen=True)
class Lexicon:
    """Sorted item hashes; the share of rows labelled toxic, and how often a voter fires on them."""

    items: np.ndarray
    labelled: int
    toxic: int
    fired: np.ndarray
    fired_toxic: np.ndarray


def mine_lexicon(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Lexicon | None:
    """The items that mark toxic rows among the labelled training rows; None without both labels.

    Items are counted once per family of documents, told apart by the smallest word hash, so
    that copies of one text do not make its words look toxic. An item that hardly
    occurs without a stronger one, as words do whose stem marks them, does not become a voter.
    """
    sample = stage(labelled_sample(docs, labels, "toxic", remainder("doc_id", 3) != 1, rows), "labelled")
    by_label = {r["toxic"]: r["n"] for r in sample.groupBy((F.col("label") > 0).alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(by_label) < 2:
        return None

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = find_words(batch.column(1).to_pylist(), FOLD)
        least = np.full(batch.num_rows, np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(least, words.text, words.hashes)
        text, item = items(words, batch.num_rows)
        label = (batch.column(2).to_numpy(zero_copy_only=False) > 0).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(item.view(np.int64)), pa.array(least[text].view(np.int64)), pa.array(label[text])],
            names=["item", "family", "label"],
        )

    pairs = in_batches(sample.select("doc_id", "text", "label"), run, "item long, family long, label long", 1)
    # a family is toxic if any of its members is
    families = stage(pairs.groupBy("item", "family").agg(F.max("label").alias("label")), "families")
    total = families.groupBy("family").agg(F.max("label").alias("label")).groupBy("label").count()
    total = {r["label"]: r["count"] for r in total.collect()}
    toxic, clean = total.get(1, 0), total.get(0, 0)
    own, rest = F.col("toxic") + 0.5, F.col("n") - F.col("toxic") + 0.5
    odds = F.log(own / (toxic + 1.0)) - F.log(rest / (clean + 1.0))
    share = (toxic + 1.0) / (toxic + clean + 2.0)
    # log-likelihood ratio of the item against no difference between the classes
    gain = 2 * (own * F.log(own / ((own + rest) * share)) + rest * F.log(rest / ((own + rest) * (1 - share))))
    best = (
        families.groupBy("item").agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n"))
        .where(F.col("toxic") >= F.lit(max(3.0, LEAST_SHARE * toxic)))
        .withColumn("gain", gain)
        .where((F.col("gain") > LEAST_GAIN) & (odds > 2))
        .orderBy(F.desc("gain"), "item")
        .limit(CANDIDATES)
        .collect()
    )
    discard(families)
    found = np.array([r["item"] for r in best], np.int64).view(np.uint64)
    order = np.argsort(found)
    rank = np.empty(len(found), np.int64)
    rank[order] = np.arange(len(found))
    _, together = count_votes(sample, found[order])
    together = together[np.ix_(rank, rank)]  # strongest first again
    alone = np.diag(together)
    chosen: list[int] = []
    for i in range(len(found)):
        if not any(together[i, j] > CONTAINED * alone[i] for j in chosen):
            chosen.append(i)
    lexicon = np.sort(found[chosen[:LEXICON]])
    _, fired = count_votes(sample, lexicon)
    _, toxic_fired = count_votes(sample.where("label > 0"), lexicon)
    discard(sample)
    return Lexicon(lexicon, sum(by_label.values()), by_label[True], np.diag(fired), np.diag(toxic_fired))


# --- the label model --------------------------------------------------------------------------

@dataclass(frozen=True)
class LabelModel:
    """How often each voter fires on toxic and on clean documents, and its share of a vote."""

    prior: float
    toxic: np.ndarray
    clean: np.ndarray
    weight: np.ndarray

    def posterior(self, fired: np.ndarray) -> np.ndarray:
        """Probability of toxic. A voter that does not fire abstains, as those for words of other
        languages do on every text; only the silence of all of them is evidence as well."""
        yes = (np.log(self.toxic) - np.log(self.clean)) * self.weight
        no = ((np.log1p(-self.toxic) - np.log1p(-self.clean)) * self.weight).sum()
        against = (yes > 0) & (self.toxic > 5 * self.clean)  # voters that speak up for toxic
        silent = ~fired[:, against].any(1)
        odds = np.log(self.prior / (1 - self.prior)) + fired @ yes + np.where(silent, no, 0)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def label_model(n: int, together: np.ndarray, mined: Lexicon) -> LabelModel:
    """Rates of all voters from their agreements over ``n`` documents and with the labels.

    Under a hidden class, two voters that are independent given the class fire together with
    probability p a_j a_k + (1 - p) b_j b_k. The labels are one such voter, with unknown rates
    (a, b). For given (a, b) its agreements fix the rates of every other voter, and (a, b) is
    the pair that explains best how often the others fire together. Pairs far off that fit are
    dependent: they are left out of a second fit, and voters that fire together too often share
    one vote.
    """
    k = len(together)
    share = np.clip(mined.toxic / mined.labelled, 1e-4, 0.9)
    alone = (np.pad(mined.fired, (0, k - len(mined.fired))) + 0.5) / (mined.labelled + 1)
    with_label = (np.pad(mined.fired_toxic, (0, k - len(mined.fired_toxic))) + 0.25) / (mined.labelled + 1)
    both, overall = together / max(n, 1), (np.diag(together) + 0.5) / (n + 1)
    # of the counts over all documents, and of the fewer labelled ones behind the rates
    few = 1 / (mined.labelled * with_label + 1)
    noise = np.sqrt(np.maximum(np.outer(overall, overall), both) / max(n, 1)) + 1e-6
    noise = np.sqrt(noise**2 + both**2 * (few[:, None] + few[None, :]))

    def rates(a: float, b: float) -> tuple[float, np.ndarray, np.ndarray]:
        prior = np.clip((share - b) / (a - b), 1e-4, 0.9)
        toxic = (with_label - b * alone) / (prior * (a - b))
        clean = (a * alone - with_label) / ((1 - prior) * (a - b))
        return prior, np.clip(toxic, 1e-5, 0.99), np.clip(clean, 1e-5, 0.99)

    def excess(a: float, b: float) -> np.ndarray:
        prior, x, y = rates(a, b)
        return (both - prior * np.outer(x, x) - (1 - prior) * np.outer(y, y)) / noise

    tied, free = np.zeros((k, k), bool), ~np.eye(k, dtype=bool)
    for _ in range(2):
        choices = [(a, share * b) for a in np.linspace(0.6, 0.99, 40) for b in np.linspace(0, 0.5, 26)]
        a, b = min(choices, key=lambda c: (np.minimum(excess(*c) ** 2, 36) * free).sum())
        off = excess(a, b)
        free = ~np.eye(k, dtype=bool) & (np.abs(off) < 6)
        close = both > 0.5 * (overall[:, None] + overall[None, :] - both)
        tied = (off > 6) & close & ~np.eye(k, dtype=bool)
    prior, toxic, clean = rates(a, b)
    return LabelModel(float(prior), toxic, clean, 1 / (1 + tied.sum(1)))


def count_votes(docs: DataFrame, lexicon: np.ndarray) -> tuple[int, np.ndarray]:
    """Documents, and how often each pair of voters fires together, over all of them."""
    width = len(lexicon) + len(PATTERNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((width, width), np.int64), 0
        for batch in batches:
            for part in slices(batch, 0):
                fired = votes(part.column(0).to_pylist(), lexicon).astype(np.float64)
                total += (fired.T @ fired).astype(np.int64)
                n += part.num_rows
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *cells.tolist()], pa.int64()), pa.array([n, *total.ravel()[cells].tolist()], pa.int64())],
            names=["cell", "n"],
        )

    sums = docs.select(text_of().alias("text")).mapInArrow(run, "cell long, n long")
    found = {r["cell"]: r["n"] for r in sums.groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    together = np.array([found.get(i, 0) for i in range(width * width)], float).reshape(width, width)
    return found.get(-1, 0), together


# --- the classifier ---------------------------------------------------------------------------

@dataclass
class Sums:
    """Over all rows at some weights: loss, errors per bucket, and the curvature of active ones."""

    loss: float
    errors: np.ndarray
    bias_error: float
    curvature: np.ndarray


def _chunks(whole: np.ndarray) -> pa.RecordBatch:
    """The parts of a vector that are not all zero, with their numbers."""
    parts = np.pad(whole, (0, -len(whole) % CHUNK)).reshape(-1, CHUNK)
    some = np.flatnonzero(parts.any(1))
    return pa.RecordBatch.from_arrays(
        [pa.array(some), pa.array([parts[i].tobytes() for i in some], pa.binary())], names=["chunk", "part"]
    )


def _read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, bucket) pairs and labels of slices of staged rows."""
    for batch in batches:
        for some in slices(batch, 1):
            lists = some.column(1).to_pylist()
            row = np.repeat(np.arange(len(lists)), [len(x) // 4 for x in lists])
            yield row, np.frombuffer(b"".join(lists), "<i4"), some.column(0).to_numpy(zero_copy_only=False)


def _add_up(
    rows: DataFrame, function: Callable[..., np.ndarray], size: int, tables: Callable[[], tuple] = tuple
) -> np.ndarray:
    """Sum over all rows of vectors made by ``function``; tasks and the driver hold one vector each.

    ``tables`` makes the first arguments of ``function``, once a task.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first = np.zeros(size), tables()
        for row, bucket, label in _read_rows(batches):
            total += function(*first, row, bucket, label)
        yield _chunks(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[i] = sums.get(i, 0) + np.frombuffer(part)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
            names=["chunk", "part"],
        )

    ship_package(rows.sparkSession)
    # few long tasks, as each of them sends a vector
    parts = rows.coalesce(max(1, rows.sparkSession.sparkContext.defaultParallelism)).mapInArrow(each, "chunk long, part binary")
    whole = np.zeros(size + CHUNK)
    for found in parts.repartition("chunk").mapInArrow(add, "chunk long, part binary").collect():
        at = found["chunk"] * CHUNK
        whole[at : at + CHUNK] = np.frombuffer(found["part"])
    return whole[:size]


def sums_at(rows: DataFrame, weights: np.ndarray, bias: float, active: np.ndarray, full: bool = True) -> Sums:
    """The sums behind a Newton step, in one pass over ``rows`` (label, buckets as int32 bytes).

    The errors of buckets that are not active are summed in ``full`` passes only.
    """
    k, m = len(active), BUCKETS if full else len(active)
    used = np.flatnonzero(weights)
    values = weights[used]  # whole tables would go to the tasks as a file each pass

    def tables() -> tuple[np.ndarray, np.ndarray]:
        weight, place = np.zeros(BUCKETS), np.full(BUCKETS, -1)
        weight[used], place[active] = values, np.arange(k)
        return weight, place

    def one(weight: np.ndarray, place: np.ndarray, row: np.ndarray, bucket: np.ndarray, label: np.ndarray) -> np.ndarray:
        n = len(label)
        odds = np.clip(bias + np.bincount(row, weight[bucket], n), -30, 30)
        p = 1 / (1 + np.exp(-odds))
        loss = np.logaddexp(0, odds).sum() - (label * odds).sum()
        spread = p * (1 - p)
        curvature = np.zeros((k + 1, k + 1))
        curvature[k, k] = spread.sum()
        hit = np.flatnonzero(place[bucket] >= 0)
        seen = slice(None) if full else hit
        errors = np.bincount((bucket if full else place[bucket])[seen], (p - label)[row[seen]], m)
        if len(hit):
            some, own = np.unique(row[hit], return_inverse=True)
            carries = np.zeros((len(some), k + 1))
            carries[own, place[bucket[hit]]] = 1
            carries[:, k] = 1
            inner = carries.T @ (carries * spread[some, None])
            inner[k, k] = curvature[k, k]
            curvature = inner
        return np.concatenate([errors, [loss, (p - label).sum()], curvature.ravel()])

    whole = _add_up(rows, one, m + 2 + (k + 1) ** 2, tables)
    errors = np.zeros(BUCKETS)
    errors[slice(None) if full else active] = whole[:m]
    return Sums(whole[m], errors, whole[m + 1], whole[m + 2 :].reshape(k + 1, k + 1))


def _newton(value: np.ndarray, error: np.ndarray, curvature: np.ndarray, penalty: np.ndarray, ridge: float) -> np.ndarray:
    """The weights that minimise the quadratic model with an L1 ``penalty`` each, by coordinates."""
    inner = curvature + np.diag(np.full(len(value), ridge + 1e-9))
    new, slope = value.copy(), error + ridge * value
    for _ in range(200):
        largest = 0.0
        for j in range(len(value)):
            at = new[j] - slope[j] / inner[j, j]
            best = np.sign(at) * max(abs(at) - penalty[j] / inner[j, j], 0.0)
            step = np.clip(best, value[j] - 4, value[j] + 4) - new[j]
            if step:
                new[j] += step
                slope += step * inner[:, j]
                largest = max(largest, abs(step))
        if largest < 1e-5:
            break
    return new


def fit_linear(rows: DataFrame) -> tuple[np.ndarray, float]:
    """Logistic regression with soft labels over all ``rows`` (label, buckets as int32 bytes).

    An L1 penalty chooses buckets, which are then fitted again with hardly any penalty, as the
    first fit makes all weights too small. Newton steps, a pass over all rows each, move the active
    buckets until the loss stands still; others join while their errors exceed the penalty, so
    that at the end no bucket is left out that the penalty would let in.
    """
    n, share = rows.agg(F.count("label"), F.avg("label")).first()
    weights = np.zeros(BUCKETS)
    if not n:
        return weights, 0.0
    bias = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    count = _add_up(rows, lambda row, bucket, label: np.bincount(bucket, minlength=BUCKETS).astype(float), BUCKETS)
    penalty = np.maximum(1.0, DOUBT * np.sqrt(count))
    weights, bias = _fit_active(rows, weights, bias, penalty, 0.0)
    chosen = np.flatnonzero(weights)
    return _fit_active(rows, weights, bias, np.where(weights != 0, 0.0, np.inf), 1e-2) if len(chosen) else (weights, bias)


def _fit_active(rows: DataFrame, weights: np.ndarray, bias: float, penalty: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """Newton steps until the loss stands still and no bucket has errors beyond its penalty."""
    active = np.flatnonzero(weights)
    kept, before = (weights, bias), np.inf
    full = may_join = bool(np.isfinite(np.delete(penalty, active)).any())
    for nth in range(4 * (PASSES + BUCKETS // JOINING)):
        sums = sums_at(rows, weights, bias, active, full)
        w = weights[active]
        loss = sums.loss + (penalty[active] * np.abs(w)).sum() + ridge / 2 * (w**2).sum()
        if loss > before + 1e-6 * abs(before):  # too far: half the way back
            weights, bias = (weights + kept[0]) / 2, (bias + kept[1]) / 2
            active = np.union1d(active, np.flatnonzero(weights))
            continue
        over = np.abs(sums.errors) - 1.02 * penalty
        over[active] = 0  # as are, in a pass that is not full, all errors of others
        joining = np.flatnonzero(over > 0)
        joining = joining[np.argsort(-over[joining] / penalty[joining], kind="stable")][:JOINING]
        still = before - loss < 1e-6 * abs(loss) + 1e-3
        if still and full == may_join and not len(joining):
            break
        full = may_join and not full and (still or nth % 3 == 0)
        kept, before = (weights, bias), loss
        new = _newton(
            np.append(w, bias), np.append(sums.errors[active], sums.bias_error), sums.curvature,
            np.append(penalty[active], 0.0), ridge,
        )
        weights, bias = np.zeros(BUCKETS), float(new[-1])
        weights[active] = new[:-1]
        active = np.union1d(active[new[:-1] != 0], joining)
    return weights, bias


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float] | None:
    """Weights of the word buckets and bias; None where the labels hold one class or none."""
    mined = mine_lexicon(docs, labels)
    if mined is None:
        return None
    lexicon = mined.items
    n, together = count_votes(docs, lexicon)
    model = label_model(n, together, mined)
    sample = docs.where(F.col("doc_id").isNotNull() & (remainder("doc_id", 3) != 1)).select(text_of().alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(0).to_pylist()
        text, item = items(find_words(texts, FOLD), len(texts))
        # two items of a text may share a bucket
        both = np.unique(text * BUCKETS + _bucket(item))
        text, bucket = both // BUCKETS, (both % BUCKETS).astype("<i4")
        cuts = np.searchsorted(text, np.arange(batch.num_rows + 1))
        lists = [bucket[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
        return pa.RecordBatch.from_arrays(
            [pa.array(model.posterior(votes(texts, lexicon))), pa.array(lists, pa.binary())],
            names=["label", "buckets"],
        )

    rows = stage(in_batches(sample, run, "label double, buckets binary", 0), "posteriors")
    fitted = fit_linear(rows)
    discard(rows)
    return fitted


def score_texts(model: tuple[np.ndarray, float] | None, texts: list[str]) -> np.ndarray:
    """Scores between 0 and 1; 0 each without a model."""
    if model is None or not texts:
        return np.zeros(len(texts))
    weights, bias = model
    text, item = items(find_words(texts, FOLD), len(texts), weights != 0)
    # once per bucket, as in the fit
    both = np.unique(text * BUCKETS + _bucket(item))
    odds = bias + np.bincount(both // BUCKETS, weights[both % BUCKETS], len(texts))
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Null text counts as empty and gets a score like any other. Rows without doc_id are scored;
    repeated rows get equal scores; an empty table gives no rows. If the labels that may be
    learned hold one class only, every score is 0. Only doc_id and text of ``docs`` are read.
    """
    model = train(docs, labels)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(score_texts(model, batch.column(1).to_pylist()))],
            names=["doc_id", "score"],
        )

    scored = in_batches(
        docs.select(F.col("doc_id").cast("long"), text_of().alias("text")), run, "doc_id long, score double", 1
    )
    return scored.select(
        "doc_id",
        (remainder("doc_id", 3) == 1).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
