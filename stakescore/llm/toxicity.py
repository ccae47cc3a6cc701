"""Toxicity by a convolutional text classifier in numpy.

A word is the sum of three hashed embeddings: two of the whole word under different hashes, so that a rare
word seldom shares both with a telling one, and one of its first letters. Filters over one, two and three
words run over a whole text, the largest answer of each filter counts, and a logistic layer weighs them.
Each language has its own threshold, and a text's language is found from the text by compression
(:mod:`stakescore.llm.language`). The fewer calibration texts a language has, the more those of the others count for it.

The model learns from every labelled text that is not held out, and from all its words: three quarters of the texts (by hashed
id) train it and the rest set the thresholds. Their words, as rows of the tables, are staged once. The embeddings begin from counts over
all training texts. In a pass each task goes through its share of them from the same model, and the tasks' models are averaged, an
embedding over the tasks that changed it. Thresholds come from counts of all other texts by language, label and answer. What reaches
the driver and is broadcast is the model, of fixed size, and those counts. Every text is scored whole, where it lies: no shuffle.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from stakescore import staging
from stakescore.llm import language
from stakescore.llm.batches import batches_of
from stakescore.llm.kept import released
from stakescore.llm.split import held_out
from stakescore.llm.texts import added

#: Rows of an embedding table, and columns.
BUCKETS, DIM = 1 << 15, 8
PREFIX = 4
WIDTHS, FILTERS = (1, 2, 3), 8
#: Passes over few texts, and over many; there are as many as make ``VISITS`` of texts.
EPOCHS, PASSES, VISITS = 6, 2, 60_000
DOCS_PER_STEP, RATE = 32, 0.02
#: Texts that a task learns from, about, and words that it holds at once.
TEXTS_PER_TASK, HELD = 2_048, 1 << 20
#: Characters whose words are found at once; a longer text alone.
LONGEST = 1 << 20
#: Steps of an answer that thresholds tell apart.
GRAIN = 1 << 10
#: Calibration texts of each kind from which a language's own outweigh the others'.
ENOUGH = 12
#: Words worked on at once.
STRETCH = 1 << 15
#: Words whose rows a task keeps at hand; more hardly save time.
REMEMBERED = 100_000
#: Rows of a model sent at once.
SENT = 1 << 13

WORDS = re.compile(r"\w+").findall


def hashed(word: str) -> tuple[int, int, int]:
    """The rows of a word in the three tables, numbered through; row 0 of none."""
    whole = xxhash.xxh64_intdigest(word, 1)
    begin = xxhash.xxh64_intdigest(word[:PREFIX], 2)
    return whole % BUCKETS, BUCKETS + (whole >> 32) % BUCKETS, 2 * BUCKETS + begin % BUCKETS


class Vocabulary(dict):
    """Numbers of the words met, and their rows by number; emptied between texts when full."""

    def __init__(self):
        super().__init__()
        self.rows = np.empty((1024, 3), np.int32)

    def __missing__(self, word: str) -> int:
        number = len(self)
        if number == len(self.rows):
            self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
        self.rows[number] = hashed(word)
        self[word] = number
        return number


def word_rows(texts: list[str | None], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Rows of all words of all texts, one after the other, and each text's number of words."""
    if len(vocabulary) > REMEMBERED:
        vocabulary.clear()
    numbers = [list(map(vocabulary.__getitem__, WORDS(t.lower()))) if t else [] for t in texts]
    counts = np.fromiter(map(len, numbers), np.int64, len(numbers))
    return vocabulary.rows[np.fromiter(chain.from_iterable(numbers), np.int64, int(counts.sum()))], counts


def training_rows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """:func:`word_rows` of many texts, without keeping their words."""
    parts = [word_rows(texts[i : i + 256], Vocabulary()) for i in range(0, max(len(texts), 1), 256)]
    return tuple(map(np.concatenate, zip(*parts)))


@dataclass
class Model:
    table: np.ndarray  # embeddings, 3 * BUCKETS + 1 rows of 3 * DIM used in thirds; the last row is padding
    filters: dict[int, np.ndarray]  # by width: (width * 3 * DIM, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    base: float
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.0

    def stretches(self, rows: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """All answers (filters by windows), in stretches of bounded size.

        Yields the texts in a stretch, where their windows begin and end in it, the answers, and by text
        what to add to a place in the stretch to get the number of the word there. Two padding words behind each text keep the texts apart.
        """
        gap = max(WIDTHS) - 1
        ends = np.cumsum(counts + gap) - gap
        begins = ends - counts
        padded = np.full((int((counts + gap).sum()), 3), len(self.table) - 1, np.int32)
        padded[np.arange(len(rows)) + np.repeat(np.arange(len(counts)) * gap, counts)] = rows
        kernels = np.concatenate([self.filters[w].reshape(w, 3 * DIM, FILTERS).transpose(0, 2, 1).reshape(-1, 3 * DIM) for w in WIDTHS])
        for at in range(0, len(padded), STRETCH):
            stop = min(at + STRETCH, len(padded))
            seen = np.zeros((stop - at + gap, 3 * DIM), np.float32)
            own = padded[at : stop + gap]
            seen[: len(own)] = self.table[own].reshape(len(own), 3 * DIM)
            parts = kernels @ seen.T
            answer = np.empty((len(self.bias), stop - at), np.float32)
            first = 0
            for i, width in enumerate(WIDTHS):
                out = answer[i * FILTERS : (i + 1) * FILTERS]
                out[:] = self.bias[i * FILTERS : (i + 1) * FILTERS, None]
                for k in range(width):
                    out += parts[first : first + FILTERS, k : k + stop - at]
                    first += FILTERS
            some = slice(int(np.searchsorted(ends, at, "right")), int(np.searchsorted(begins, stop, "left")))
            low, high = np.maximum(begins[some], at) - at, np.minimum(ends[some], stop) - at
            full = high > low
            if full.any():
                texts = np.arange(some.start, some.stop)[full]
                yield texts, low[full], high[full], answer, at - texts * gap

    def strengths(self, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Per text the largest answer of each filter, at least 0."""
        best = np.zeros((len(counts), len(self.bias)), np.float32)
        for texts, low, high, answer, _ in self.stretches(rows, counts):
            bounds = np.stack([low, high], axis=1).reshape(-1)
            largest = np.maximum.reduceat(answer, bounds[:-1] if high[-1] == answer.shape[1] else bounds, axis=1)[:, ::2]
            best[texts] = np.maximum(best[texts], largest.T)
        return best

    def windows(self, rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`strengths`, and the word with which the window of each begins; -1 where no answer is above 0."""
        best = np.zeros((len(counts), len(self.bias)), np.float32)
        where = np.full(best.shape, -1, np.int64)
        for texts, low, high, answer, words in self.stretches(rows, counts):
            for text, a, b, word in zip(texts, low, high, words):
                at = answer[:, a:b].argmax(axis=1)
                largest = answer[np.arange(len(at)), a + at]
                better = largest > best[text]
                where[text, better] = word + a + at[better]
                best[text, better] = largest[better]
        return best, where

    def logits(self, best: np.ndarray) -> np.ndarray:
        return best.astype(np.float64) @ self.out + self.base


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def seen_in(rows: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """How many toxic texts (first) and others each bucket occurs in."""
    seen = np.zeros((2, 3 * BUCKETS + 1))
    ends = np.cumsum(counts)
    for end, count, label in zip(ends, counts, labels):
        seen[0 if label > 0 else 1, np.unique(rows[end - count : end])] += 1
    return seen


def begun(seen: np.ndarray, positive: float, negative: float) -> Model:
    """Embeddings begin as the log odds of their bucket among the training texts, beside small noise."""
    noise = np.random.default_rng(7)
    table = noise.normal(0, 0.02, (3 * BUCKETS + 1, DIM)).astype(np.float32)
    share = [(n + 1.0) / (max(total, 1) + 2.0) for n, total in zip(seen, (positive, negative))]
    table[:, 0] = np.where(seen[0] + seen[1] >= 3, np.log(share[0] / share[1]), 0) / 4
    table[-1] = 0
    filters = {}
    for size in WIDTHS:
        kernel = noise.normal(0, 0.05, (size * 3 * DIM, FILTERS)).astype(np.float32)
        kernel[: 3 * DIM : DIM] += 0.5
        filters[size] = kernel
    count = len(WIDTHS) * FILTERS
    return Model(table, filters, np.full(count, -0.3, np.float32), np.full(count, 0.2), -1.0)


def _start(rows: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> Model:
    return begun(seen_in(rows, counts, labels), labels.sum(), (1 - labels).sum())


#: The parts of a model that every step changes.
DENSE = [*(("filters", s) for s in WIDTHS), ("bias", None), ("out", None), ("base", None)]


class Training:
    """A model that learns, with Adam's moments of its dense parts and Adagrad's squares of its embeddings."""

    def __init__(self, model: Model, share: float):
        """``share``: that of the toxic among all training texts."""
        self.model, self.steps = model, 0
        self.weights = 0.5 / max(1 - share, 1e-9), 0.5 / max(share, 1e-9)
        self.moments = {n: [np.zeros(np.shape(self.part(*n)))] * 2 for n in DENSE}
        self.squares = np.zeros(model.table.shape, np.float32)

    def part(self, name: str, key: int | None):
        value = getattr(self.model, name)
        return value[key] if key else value

    def put(self, name: str, key: int | None, value) -> None:
        if key:
            self.model.filters[key] = value.astype(np.float32)
        else:
            setattr(self.model, name, value.astype(np.float32) if name == "bias" else value)

    def dense(self) -> np.ndarray:
        """All dense numbers with their two moments, in rows."""
        return np.concatenate([
            np.stack([np.asarray(x, np.float64).reshape(-1) for x in (self.part(*n), *self.moments[n])], axis=1) for n in DENSE
        ])

    def take(self, dense: np.ndarray) -> None:
        at = 0
        for n in DENSE:
            shape = np.shape(self.part(*n))
            size = int(np.prod(shape))
            value, *moments = (dense[at : at + size, i].reshape(shape) for i in range(3))
            self.put(*n, value if shape else float(value))
            self.moments[n] = moments
            at += size

    def learn(self, rows: np.ndarray, counts: np.ndarray, labels: np.ndarray, order: np.random.Generator) -> None:
        """One pass over texts; the gradient of a text flows to the windows of its largest answers only."""
        begins = np.cumsum(counts) - counts
        weight = np.where(labels > 0, self.weights[1], self.weights[0])
        for some in np.array_split(order.permutation(len(counts)), -(-len(counts) // DOCS_PER_STEP)):
            own = np.concatenate([rows[begins[i] : begins[i] + counts[i]] for i in some])
            self.step(own, counts[some], labels[some], weight[some])

    def step(self, own: np.ndarray, counts: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> None:
        model = self.model
        self.steps += 1
        best, where = model.windows(own, counts)
        wrong = (_sigmoid(model.logits(best)) - labels) * weight / len(counts)
        gradient = {("out", None): best.T @ wrong + 1e-4 * model.out, ("base", None): wrong.sum()}
        into = (wrong[:, None] * model.out * (where >= 0)).astype(np.float32)
        gradient["bias", None] = into.sum(axis=0)
        ends = np.cumsum(counts)
        touched, changes = [], []
        for w, size in enumerate(WIDTHS):
            part = slice(w * FILTERS, (w + 1) * FILTERS)
            text, which = np.nonzero(into[:, part])
            start, push = where[:, part][text, which], into[:, part][text, which]
            kernel = model.filters[size].reshape(size, 3 * DIM, FILTERS)
            change = np.zeros_like(kernel)
            for k in range(size):
                inside = start + k < ends[text]
                at = own[start[inside] + k]
                seen = model.table[at].reshape(len(at), 3 * DIM)
                np.add.at(change[k].T, which[inside], seen * push[inside, None])
                back = kernel[k].T[which[inside]] * push[inside, None]
                touched.append(at.reshape(-1))
                changes.append(back.reshape(-1, DIM))
            gradient["filters", size] = change.reshape(-1, FILTERS) + 1e-4 * model.filters[size]
        for n in DENSE:
            g, (first, second) = gradient[n], self.moments[n]
            first = 0.9 * first + 0.1 * g
            second = 0.999 * second + 0.001 * np.square(g)
            move = RATE * (first / (1 - 0.9**self.steps)) / (np.sqrt(second / (1 - 0.999**self.steps)) + 1e-8)
            self.moments[n] = [first, second]
            self.put(*n, self.part(*n) - move)
        if touched and sum(map(len, touched)):
            at, inverse = np.unique(np.concatenate(touched), return_inverse=True)
            change = np.zeros((len(at), DIM), np.float32)
            np.add.at(change, inverse, np.concatenate(changes))
            self.squares[at] += change**2
            model.table[at] -= RATE * change / (np.sqrt(self.squares[at]) + 1e-6)
            model.table[-1] = 0


def train(texts: list[str], labels: np.ndarray) -> Model:
    """Fit the model to texts at hand."""
    labels = np.asarray(labels, np.float64)
    rows, counts = training_rows(texts)
    training, order = Training(_start(rows, counts, labels), labels.mean()), np.random.default_rng(11)
    for _ in range(EPOCHS):
        training.learn(rows, counts, labels, order)
    return training.model


def threshold(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """Where the weighted F1 is largest: in the middle of the widest gap there."""
    order = np.argsort(-logits, kind="stable")
    logits, positive, mass = logits[order], labels[order] > 0, weights[order]
    hit = np.cumsum(mass * positive)
    false = np.cumsum(mass * ~positive)
    score = 2 * hit / (hit + false + (mass * positive).sum())
    last = np.concatenate([logits[1:] < logits[:-1], [True]])
    score = np.where(last, score, -1)
    best = np.flatnonzero(score >= score.max() - 1e-12)
    below = np.append(logits, logits[-1] - 2.0)
    widest = best[np.argmax(below[best] - below[best + 1])]
    return float((below[widest] + below[widest + 1]) / 2)


def limit(model: Model, logits: np.ndarray, labels: np.ndarray, names: np.ndarray, counts: np.ndarray, prior: float) -> None:
    """Set the thresholds from answers that occur ``counts`` times each. ``prior``: the positives' true share."""
    share = (labels * counts).sum() / counts.sum()
    weights = counts * np.where(labels > 0, prior / max(share, 1e-9), (1 - prior) / max(1 - share, 1e-9))
    model.threshold = threshold(logits, labels, weights)
    for name in sorted(set(names)):
        of = names == name
        own = min((labels * counts)[of].sum(), ((1 - labels) * counts)[of].sum())
        model.thresholds[name] = threshold(logits, labels, weights * np.where(of, 1, ENOUGH / (ENOUGH + own)))


def fit(texts: list[str], labels: np.ndarray, languages: list[str], prior: float) -> Model:
    """:func:`learn` for texts at hand: train on three quarters and set the thresholds on the rest."""
    labels = np.asarray(labels, np.float64)
    calibrate = np.zeros(len(texts), bool)
    for label in (0, 1):
        calibrate[np.flatnonzero(labels == label)[3::4]] = True
    if not calibrate.any() or len(set(labels[calibrate])) < 2 or len(set(labels[~calibrate])) < 2:
        calibrate[:] = True
        model = train(texts, labels)
    else:
        model = train([t for t, c in zip(texts, calibrate) if not c], labels[~calibrate])
    chosen = np.flatnonzero(calibrate)
    rows, counts = training_rows([texts[i] for i in chosen])
    logits = model.logits(model.strengths(rows, counts))
    limit(model, logits, labels[chosen], np.array([languages[i] for i in chosen]), np.ones(len(chosen)), prior)
    return model


def packed(rows: np.ndarray) -> np.ndarray:
    """The three rows of a word in one number."""
    return rows.astype(np.int64) @ np.array([1, BUCKETS, BUCKETS**2]) - BUCKETS**2 - 2 * BUCKETS**3


def unpacked(words: np.ndarray) -> np.ndarray:
    rows = np.empty((len(words), 3), np.int32)
    rows[:, 0] = words % BUCKETS
    rows[:, 1] = BUCKETS + words // BUCKETS % BUCKETS
    rows[:, 2] = 2 * BUCKETS + words // BUCKETS**2
    return rows


def worded(texts: DataFrame, content: dict[str, bytes]) -> DataFrame:
    """(toxic, calibrate, language, words) of rows (id, toxic, text, calibrate): all words of the whole text, packed; the language
    of those that calibrate.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        released()
        vocabulary, classifier = Vocabulary(), language.Classifier(content)
        for batch in batches_of(batches, 256):
            rows, at = batch.to_pylist(), 0
            while at < len(rows):
                stop, held = at + 1, len(rows[at]["text"])
                while stop < len(rows) and held + len(rows[stop]["text"]) <= LONGEST:
                    held += len(rows[stop]["text"])
                    stop += 1
                some = rows[at:stop]
                found, counts = word_rows([r["text"] for r in some], vocabulary)
                words, ends = packed(found).astype("<i8"), np.cumsum(counts)
                yield pa.record_batch({
                    "toxic": pa.array([r["toxic"] for r in some], pa.int32()), "calibrate": pa.array([r["calibrate"] for r in some], pa.bool_()),
                    "language": pa.array([classifier.predict(r["text"])[0] if r["calibrate"] else None for r in some], pa.string()),
                    "words": pa.array([words[e - n : e].tobytes() for e, n in zip(ends, counts)], pa.binary()),
                })
                at = stop

    return texts.mapInArrow(run, "toxic int, calibrate boolean, language string, words binary")


def held(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list]]:
    """Rows, counts, labels and languages of the texts of a task, about ``HELD`` words at once."""

    def whole(some: list[dict]):
        words = [np.frombuffer(r["words"], "<i8") for r in some]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        return unpacked(np.concatenate(words)), counts, np.array([r["toxic"] for r in some], np.float64), [r["language"] for r in some]

    released()
    some, size = [], 0
    for batch in batches_of(batches, 256):
        for row in batch.to_pylist():
            some.append(row)
            size += len(row["words"]) // 8
            if size >= HELD:
                yield whole(some)
                some, size = [], 0
    if some:
        yield whole(some)


def _seen(texts: DataFrame) -> np.ndarray:
    """:func:`seen_in` of all texts."""

    def run(batches):
        seen = sum((seen_in(rows, counts, labels) for rows, counts, labels, _ in held(batches)), np.zeros((2, 3 * BUCKETS + 1)))
        kind, at = np.nonzero(seen)
        yield pa.record_batch({"kind": pa.array(kind, pa.int32()), "at": pa.array(at, pa.int32()), "n": pa.array(seen[kind, at].astype(np.int64))})

    found = texts.mapInArrow(run, "kind int, at int, n long").groupBy("kind", "at").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros((2, 3 * BUCKETS + 1))
    seen[found["kind"].to_numpy(), found["at"].to_numpy()] = found["n"].to_numpy()
    return seen


def _passed(texts: DataFrame, training: Training, turn: int) -> None:
    """One pass: every task learns from its texts, and ``training`` takes the averages."""
    context = texts.sparkSession.sparkContext
    shared = context.broadcast(pickle.dumps(training))

    def sent(at: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch({"at": pa.array(at, pa.int32())} | {f"v{i}": pa.array(values[:, i]) for i in range(2 * DIM)})

    def run(batches):
        own, order, steps = pickle.loads(shared.value), np.random.default_rng([11, turn]), None
        before = own.model.table.copy()
        for rows, counts, labels, _ in held(batches):
            steps = own.learn(rows, counts, labels, order) or own.steps
        if steps:
            changed = np.flatnonzero((own.model.table != before).any(axis=1))
            del before
            for some in np.split(changed, range(SENT, len(changed), SENT)):
                yield sent(some, np.concatenate([own.model.table[some], own.squares[some]], axis=1).astype(np.float64))
            dense = np.zeros((len(own.dense()), 2 * DIM))
            dense[:, :3], dense[:, 3] = own.dense(), steps
            yield sent(-1 - np.arange(len(dense)), dense)

    names = [f"v{i}" for i in range(2 * DIM)]
    found = texts.mapInArrow(run, "at int, " + ", ".join(f"{n} double" for n in names)).groupBy("at").agg(
        *[F.avg(n).alias(n) for n in names]).toArrow()
    at, values = found["at"].to_numpy(), np.stack([found[n].to_numpy() for n in names], axis=1)
    training.model.table[at[at >= 0]], training.squares[at[at >= 0]] = values[at >= 0, :DIM], values[at >= 0, DIM:]
    dense = np.zeros(((at < 0).sum(), 2 * DIM))
    dense[-1 - at[at < 0]] = values[at < 0]
    training.take(dense[:, :3])
    training.steps = max(1, round(dense[0, 3]))
    shared.destroy()


def _limited(texts: DataFrame, model: Model, prior: float) -> None:
    """Set the thresholds from all ``texts``, counted by language, label and answer."""
    shared = texts.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def run(batches):
        own = pickle.loads(shared.value)
        for rows, counts, labels, names in held(batches):
            logits = np.clip(own.logits(own.strengths(rows, counts)), -1e5, 1e5)
            yield pa.record_batch({
                "language": pa.array(names, pa.string()), "toxic": pa.array(labels.astype(np.int32)), "answer": pa.array(np.rint(logits * GRAIN).astype(np.int64)),
            })

    found = texts.mapInArrow(run, "language string, toxic int, answer long").groupBy("language", "toxic", "answer").agg(
        F.count("*").alias("n")).orderBy("language", "toxic", "answer").toArrow()
    limit(
        model, found["answer"].to_numpy() / GRAIN, found["toxic"].to_numpy().astype(np.float64),
        np.array(found["language"].to_pylist()), found["n"].to_numpy().astype(np.float64), prior,
    )
    shared.destroy()


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> tuple[Model | None, dict[str, bytes]]:
    """A model and language dictionaries from the rows that are not held out; no model without both labels. Rows of equal id teach each."""
    content = language.dictionaries(docs, doc_id, text, lang)
    marked = labels.select(F.col("doc_id").cast("bigint").alias("id"), F.col("toxic").cast("int").alias("toxic")).filter(
        ~held_out("id") & F.col("id").isNotNull() & F.col("toxic").isin(0, 1)
    ).groupBy("id").agg(F.max("toxic").alias("toxic"))
    shares = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    if len(shares) < 2:
        return None, content
    prior, number = shares[1] / (shares[0] + shares[1]), shares[0] + shares[1]
    # The labels grow with the documents, so they are never broadcast.
    texts = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).filter(
        ~held_out("id")).join(marked.hint("merge"), "id").coalesce(max(1, number // TEXTS_PER_TASK))
    for calibrates in (F.pmod(F.xxhash64("id"), F.lit(4)) == 3, F.lit(True)):
        words = staging.written(worded(texts.withColumn("calibrate", calibrates), content), "words", "zstd")
        sizes = {(r["calibrate"], r["toxic"]): r["count"] for r in words.groupBy("calibrate", "toxic").count().collect()}
        if len(sizes) == 4:  # both labels on both sides
            break
    else:
        if len(sizes) < 2:
            return None, content
    apart = len(sizes) == 4
    own = words.filter(~F.col("calibrate")) if apart else words
    negative, positive = (sizes[not apart, kind] for kind in (0, 1))
    training = Training(begun(_seen(own), positive, negative), positive / (positive + negative))
    for turn in range(max(PASSES, min(EPOCHS, VISITS // (positive + negative)))):
        _passed(own, training, turn)
    _limited(words.filter("calibrate"), training.model, prior)
    return training.model, content


def score(
    docs: DataFrame, model: Model | None, content: dict[str, bytes], doc_id: str = "doc_id", text: str = "text", carry: bool = False,
) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 from a score of 0.5 on), the language found and,
    with ``carry``, its row as ``doc``.

    Other columns, whatever their names, are not read, or come inside ``doc``. A null text is an empty one; a text without words has the score of no answers. Without a model (no
    label of one kind) all scores are 0. Rows of equal id are scored each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model, vocabulary, classifier = shared.value, Vocabulary(), language.Classifier(content)

        def columns(texts: list) -> dict[str, pa.Array]:
            names = [classifier.predict(t)[0] for t in texts]
            scores = np.zeros(len(texts))
            for at in range(0, len(texts) if model else 0, 256):
                some = texts[at : at + 256]
                limits = np.array([model.thresholds.get(n, model.threshold) for n in names[at : at + 256]])
                scores[at : at + 256] = _sigmoid(model.logits(model.strengths(*word_rows(some, vocabulary))) - limits)
            return {
                "score": pa.array(scores), "predicted": pa.array((scores >= 0.5).astype(np.int32)),
                "language": pa.array(names, pa.string()),
            }

        return columns

    scored = added(docs, doc_id, text, make, "score double, predicted int, language string", carry)
    return scored.withColumn("held_out", held_out())


def toxicity(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", carry: bool = False,
) -> DataFrame:
    """:func:`score` by a model learned from the documents that ``labels`` (doc_id, toxic) marks."""
    return score(docs, *learn(docs, labels, doc_id, text, lang), doc_id, text, carry)
