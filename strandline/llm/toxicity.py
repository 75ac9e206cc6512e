"""Toxicity scores by a convolutional text classifier trained in numpy.

Kim, "Convolutional neural networks for sentence classification", 2014. A word
is the sum of hashed embeddings of the whole word and of its first bytes (so
that inflected forms of a stem meet). Filters of widths one to three run over
the whole text; each filter's largest activation is kept; a logistic layer
makes the score. Training backpropagates through the places of the maxima.
First embedding coordinates start from the lower confidence bound of a bucket's
log odds in the training sample; everything is then learnt together by Adam.

Scores use the text alone. Thresholds for rejecting are calibrated by language
on the part of the sample that is kept from training; languages with too few
examples use the common threshold of 0.5.

Defined results: a null or empty text is scored like a text without words.
Without labels of both classes every score is the share of label 1 (0 without
labels). Of rows with one labelled doc_id the smallest text is learnt from; of an id
that is labelled both ways, label 1. An empty table gives an empty result. Equal
texts have equal scores. Extra columns are ignored or passed through. Texts are
scored in slices; memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.frames import at_workers, fresh, held_out, read
from strandline.llm.labelled import platt, sample, sigmoid
from strandline.llm.shingles import buffers, parts, word_hashes

PREFIXES = (4, 5, 6)
FEATURES = 2 + len(PREFIXES)
BUCKETS = 1 << 16
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 4
#: Labelled documents of each class in the training sample.
PER_CLASS = 2500
EPOCHS = 5
#: Buckets in fewer training documents say nothing: their embeddings stay zero.
LEAST_DOCUMENTS = 3

APART = np.ones(256, bool)  # bytes that part words: all of ASCII but letters and digits
APART[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def buckets_of(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For slices of rows: the bucket of every word by feature (words x FEATURES) and where rows begin."""
    all_offsets, all_data = buffers(texts)
    for a, b in parts(all_offsets):
        offsets = all_offsets[a : b + 1]
        whole, bounds, *heads = word_hashes(offsets - offsets[0], all_data[offsets[0] : offsets[-1]], APART, PREFIXES)
        columns = [whole, whole >> np.uint64(24), *heads]
        yield np.stack([(c & np.uint64(BUCKETS - 1)).astype(np.uint16) for c in columns], axis=1), bounds


def features(texts: pa.Array) -> Iterator[bytes]:
    for words, bounds in buckets_of(texts):
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield words[a:b].tobytes()


@dataclass
class Model:
    """Embeddings (feature, bucket, dim), filters by width, their biases, and the output layer."""

    embedding: np.ndarray
    filters: list[np.ndarray]  # (width, dim, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    shift: float = 0.0
    slope: float = 1.0
    base: float | None = None  # a constant score, where nothing could be learnt
    thresholds: dict[str, float] = field(default_factory=dict)

    def embedded(self, words: np.ndarray) -> np.ndarray:
        e = self.embedding[0][words[:, 0]]
        for f in range(1, FEATURES):
            e += self.embedding[f][words[:, f]]
        return e

    def pooled(self, words: np.ndarray, bounds: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Each row's largest activation of every filter (0 at least); with ``places``, where it is (-1: none)."""
        n, rows = len(words), len(bounds) - 1
        e = self.embedded(words)
        top = np.zeros((rows, len(WIDTHS) * FILTERS), np.float32)
        at = np.full(top.shape, -1, np.int64) if places else None
        sizes = np.diff(bounds)
        for w, (width, weight) in enumerate(zip(WIDTHS, self.filters)):
            own = slice(w * FILTERS, (w + 1) * FILTERS)
            long = np.flatnonzero(sizes >= width)
            if not len(long):
                continue
            m = n - width + 1
            a = e[:m] @ weight[0]
            for j in range(1, width):
                a += e[j : j + m] @ weight[j]
            a += self.bias[own]
            # windows that cross into the next row don't count
            row_end = np.repeat(bounds[1:], sizes)[:m]
            if width > 1:
                a[np.arange(m) + width > row_end] = -np.inf
            best = np.maximum.reduceat(a, bounds[:-1][long], axis=0)
            top[long, own] = np.maximum(best, 0)
            if places:
                for i, row in enumerate(long):
                    block = a[bounds[row] : bounds[row + 1] - width + 1]
                    at[row, own] = np.where(best[i] > 0, bounds[row] + block.argmax(0), -1)
        return top, at

    def logits(self, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return self.pooled(words, bounds)[0] @ self.out[:-1] + self.out[-1]

    def score(self, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        if self.base is not None:
            return np.full(len(bounds) - 1, self.base)
        return sigmoid(self.slope * self.logits(words, bounds).astype(np.float64) + self.shift)


def _joined(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
    return (np.concatenate(docs) if docs else np.zeros((0, FEATURES), np.uint16)), bounds


class Adam:
    def __init__(self, value: np.ndarray, rate: float):
        self.value, self.rate, self.m, self.v, self.t = value, rate, np.zeros_like(value), np.zeros_like(value), 0

    def step(self, g: np.ndarray, at: np.ndarray | None = None) -> None:
        """One step of all of ``value``, or of its rows ``at``."""
        self.t += 1
        at = slice(None) if at is None else at
        self.m[at] += 0.1 * (g - self.m[at])
        self.v[at] += 0.01 * (g * g - self.v[at])
        self.value[at] -= self.rate * (self.m[at] / (1 - 0.9**self.t)) / (np.sqrt(self.v[at] / (1 - 0.99**self.t)) + 1e-7)


def train(docs: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, batch: int = 128, seed: int = 7) -> Model:
    random = np.random.default_rng(seed)
    n1, n0 = int(labels.sum()), int((1 - labels).sum())
    embedding = random.normal(0, 0.02, (FEATURES, BUCKETS, DIM)).astype(np.float32)
    common = np.zeros((FEATURES, BUCKETS), bool)
    for f in range(FEATURES):  # how much likelier a bucket is in documents of label 1, at least
        held = np.zeros((2, BUCKETS))
        for words, y in zip(docs, labels):
            held[y, np.unique(words[:, f])] += 1
        odds = np.log((held[1] + 0.5) / (n1 + 1)) - np.log((held[0] + 0.5) / (n0 + 1)) - 2.5 * np.sqrt(1 / (held[1] + 0.5) + 1 / (held[0] + 1))
        embedding[f, :, 0] = np.clip(odds, -1, 6) / FEATURES
        common[f] = held.sum(0) >= LEAST_DOCUMENTS
    embedding[~common] = 0
    filters = [random.normal(0, 0.1, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for weight in filters:
        weight[:, 0, :] = np.abs(weight[:, 0, :]) + 0.5
    model = Model(embedding, filters, np.full(len(WIDTHS) * FILTERS, -0.3, np.float32), np.concatenate([np.full(len(WIDTHS) * FILTERS, 0.3), [-1.5]]).astype(np.float32))
    flat = model.embedding.reshape(FEATURES * BUCKETS, DIM)
    steps = {"e": Adam(flat, 0.01), "b": Adam(model.bias, 0.01), "o": Adam(model.out, 0.03)} | {w: Adam(x, 0.01) for w, x in zip(WIDTHS, filters)}
    weight_of = np.where(labels == 1, 0.5 * len(labels) / max(n1, 1), 0.5 * len(labels) / max(n0, 1))
    for _ in range(epochs):
        order = random.permutation(len(docs))
        for start in range(0, len(docs), batch):
            rows = order[start : start + batch]
            words, bounds = _joined([docs[i] for i in rows])
            if not len(words):
                continue
            top, at = model.pooled(words, bounds, places=True)
            p = sigmoid(top @ model.out[:-1] + model.out[-1])
            g = ((p - labels[rows]) * weight_of[rows] / len(rows)).astype(np.float32)
            back = g[:, None] * model.out[:-1] * (at >= 0)  # by row and filter
            buckets, grads = [], []
            for w, (width, weight) in enumerate(zip(WIDTHS, model.filters)):
                own = slice(w * FILTERS, (w + 1) * FILTERS)
                row, k = np.nonzero(at[:, own] >= 0)
                place, gk = at[:, own][row, k], back[:, own][row, k]
                gw = np.zeros_like(weight)
                for j in range(width):
                    e = model.embedded(words[place + j])
                    for f in range(FILTERS):
                        gw[j, :, f] = (gk[k == f, None] * e[k == f]).sum(0)
                    ge = gk[:, None] * weight[j][:, k].T
                    for f in range(FEATURES):
                        buckets.append(f * BUCKETS + words[place + j, f].astype(np.int64))
                        grads.append(ge)
                steps[width].step(gw + 1e-4 * weight)
            steps["b"].step(back.sum(0))
            steps["o"].step(np.concatenate([(g[:, None] * top).sum(0), [g.sum()]]).astype(np.float32))
            if buckets:
                rows_of, grad = np.concatenate(buckets), np.concatenate(grads)
                learnt = common.ravel()[rows_of]
                touched, inverse = np.unique(rows_of[learnt], return_inverse=True)
                total = np.zeros((len(touched), DIM), np.float32)
                np.add.at(total, inverse, grad[learnt])
                steps["e"].step(total, touched)
    return model


def calibrate(model: Model, docs: list[np.ndarray], labels: np.ndarray, langs: list[str], least: int = 20) -> None:
    """Make 0.5 the border of scores, and find each language's own threshold where it has ``least`` of either label."""
    logits = model.logits(*_joined(docs)).astype(np.float64)
    n1, n0 = max(int(labels.sum()), 1), max(int((1 - labels).sum()), 1)
    model.slope, model.shift = platt(logits, labels, np.where(labels == 1, 0.5 * len(labels) / n1, 0.5 * len(labels) / n0))
    scores = sigmoid(model.slope * logits + model.shift)
    for lang in sorted(set(langs)):
        own = np.array([x == lang for x in langs])
        y, s = labels[own], scores[own]
        if min(y.sum(), (1 - y).sum()) < least:
            continue
        # the border with the fewest mistakes, in the middle of its gap; near 0.5 among equals
        cuts = np.unique(np.concatenate([[0.0], s, [1.0]]))
        middles = (cuts[1:] + cuts[:-1]) / 2
        wrong = [((s >= c) != (y == 1)).sum() for c in middles]
        best = [c for c, w in zip(middles, wrong) if w == min(wrong)]
        model.thresholds[lang] = float(min(max(min(best, key=lambda c: abs(c - 0.5)), 0.2), 0.8))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> Model:
    """The classifier of at most ``per_class`` labelled documents of each class; a fifth of them calibrates."""
    found = sample(docs, labels, label, features, per_class, id_col, text_col, lang_col)
    sets = [np.frombuffer(x, np.uint16).reshape(-1, FEATURES) for x, _, _ in found]
    y = np.array([v for _, v, _ in found], np.int64)
    if len(set(y.tolist())) < 2:
        return Model(np.zeros((FEATURES, 1, DIM), np.float32), [], np.zeros(0), np.zeros(1), base=float(y.mean()) if len(y) else 0.0)
    later = np.arange(len(y)) % 5 == 0
    if min(y[later].sum(), (1 - y[later]).sum()) < 10:
        later = np.ones(len(y), bool)  # too few to set aside: calibrated on all
        model = train(sets, y)
    else:
        model = train([s for s, x in zip(sets, later) if not x], y[~later])
    at = np.flatnonzero(later)
    calibrate(model, [sets[i] for i in at], y[at], [found[i][2] for i in at])
    return model


def scorer(spark: SparkSession, model: Model):
    """The model as a function of a text column."""
    at_workers(spark)
    shared = spark.sparkContext.broadcast(model)  # its size is fixed by BUCKETS and DIM

    @F.arrow_udf("double")
    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for texts in columns:
            found = [own.score(words, bounds) for words, bounds in buckets_of(texts)]
            yield pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())

    return score


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, score, predicted, rejected (the score reaches the threshold of the row's language) of every row."""
    score = scorer(docs.sparkSession, model)
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("")) if lang_col in docs.columns else F.lit("")
    rows = docs.select(F.col(id_col).alias("doc_id"), lang.alias("lang"), score(F.col(text_col).cast("string")).alias("score"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), (F.col("score") >= threshold(model, F.col("lang"))).alias("rejected"))


def threshold(model: Model, lang: Column) -> Column:
    own = F.lit(0.5)
    for name, value in sorted(model.thresholds.items()):
        own = F.when(lang == name, F.lit(value)).otherwise(own)
    return own


def clean(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below the threshold of their language."""
    name = fresh(docs, "score")[0]
    score = scorer(docs.sparkSession, model)
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("")) if lang_col in docs.columns else F.lit("")
    return docs.withColumn(name, score(F.col(text_col).cast("string"))).where(F.col(name) < threshold(model, lang)).drop(name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return scored(docs, fit(docs, read(spark, sf_dir, "labels")))
