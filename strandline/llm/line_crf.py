"""Document quality from a linear-chain conditional random field over lines.

Lafferty, McCallum and Pereira, "Conditional random fields", 2001. Every line
that isn't blank is labelled good or bad. A line's features are shares of kinds
of bytes and of repeated words, word and line lengths, and whether the line
occurs again in its document, cut at fixed thresholds; the features of the line
before and after it count too. Training maximises the conditional likelihood,
each line of a labelled document carrying the document's label. Forward-backward
marginals, weighted by line length, add up to the document's share of good text,
which a logistic calibration turns into the score.

Defined results: a text without lines (null, empty or blank) has a share of 0.
Without labels of both classes every score is the share of label 1 (0 without
labels). Of rows with one labelled doc_id the smallest text is learnt from; of an id
that is labelled both ways, label 1. An empty table gives an empty result. Equal
texts have equal scores. Extra columns are ignored or passed through. Memory
follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.frames import at_workers, fresh, held_out, read
from strandline.llm.labelled import platt, sample, sigmoid
from strandline.llm.shingles import buffers, mixed, parts, word_hashes

#: Labelled documents of each class in the training sample.
PER_CLASS = 1500
#: Score from which a document counts as good.
BORDER = 0.3


def _kind(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


UPPER = _kind("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LETTER = UPPER | _kind("abcdefghijklmnopqrstuvwxyz") | (np.arange(256) >= 128)
KINDS = {
    "symbol": _kind("#$%&*@^~+=<>{}[]\\/_"),
    "shout": _kind("!?"),
    "bar": _kind("|\t"),
    "digit": _kind("0123456789"),
    "stop": _kind(".,;:'\"()-"),
    "foreign": np.arange(256) >= 128,
}
CUTS = {
    "upper": (0.1, 0.25, 0.5, 0.8),
    "symbol": (0.005, 0.03, 0.1, 0.25),
    "shout": (0.005, 0.03, 0.1),
    "bar": (0.005, 0.03, 0.1),
    "digit": (0.02, 0.1, 0.3),
    "stop": (0.005, 0.03, 0.08),
    "foreign": (0.02, 0.1, 0.3),
    "repeat": (0.2, 0.4, 0.6, 0.8),
    "next": (0.05, 0.2, 0.5),
    "word": (3.5, 6.0, 8.0, 12.0),
    "length": (20, 80, 300, 1000),
    "again": (0.5,),
}
WIDTH = 1 + sum(map(len, CUTS.values()))


def line_features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For slices of rows: feature bits (lines x WIDTH), line lengths in bytes, and where rows' lines begin."""
    all_offsets, all_data = buffers(texts)
    for a, b in parts(all_offsets):
        offsets = all_offsets[a : b + 1] - all_offsets[a]
        data = all_data[all_offsets[a] : all_offsets[b]]
        hashes, words_at = word_hashes(offsets, data)
        feed = np.flatnonzero(data == 10)
        starts = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], feed + 1]))
        starts = starts[starts < len(data)]
        # words by line: lines are rows of the same bytes
        _, word_bounds = word_hashes(np.concatenate([starts, [len(data)]]), data) if len(starts) else (None, np.zeros(1, np.int64))
        counts = np.diff(word_bounds)
        ends = np.concatenate([starts[1:], [len(data)]]) if len(starts) else starts
        full = counts > 0
        own, n_words = starts[full], counts[full]
        size = np.maximum((ends - starts)[full], 1)
        row_bounds = np.searchsorted(own, offsets)
        if not len(own):
            yield np.zeros((0, WIDTH), bool), size, row_bounds
            continue
        # every byte from one full line's start to the next belongs to it; blank lines add white space only
        total = lambda kind: np.add.reduceat(kind[data].astype(np.uint8), own, dtype=np.int64)
        letters = np.maximum(total(LETTER), 1)
        value = {"upper": total(UPPER) / letters} | {name: total(kind) / size for name, kind in KINDS.items()}
        line = np.repeat(np.arange(len(own)), n_words)
        packed = np.sort((line.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
        new = np.ones(len(packed), bool)
        new[1:] = packed[1:] != packed[:-1]
        value["repeat"] = 1 - np.bincount((packed[new] >> np.uint64(40)).astype(np.int64), minlength=len(own)) / n_words
        same = np.zeros(len(hashes), np.int64)
        same[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
        first = np.cumsum(n_words) - n_words
        value["next"] = np.add.reduceat(same, first) / n_words
        value["word"] = size / n_words
        value["length"] = size
        whole = np.add.reduceat(hashes * (np.arange(len(hashes), dtype=np.uint64) - np.repeat(first, n_words).astype(np.uint64) + np.uint64(1)), first)
        row = np.searchsorted(row_bounds, np.arange(len(own)), "right")
        key = mixed(whole + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
        value["again"] = (times[inverse] > 1).astype(float)
        bits = [np.ones((len(own), 1), bool)] + [value[name][:, None] >= np.array(cuts) for name, cuts in CUTS.items()]
        yield np.concatenate(bits, axis=1), size, row_bounds


def features(texts: pa.Array) -> Iterator[bytes]:
    for bits, size, bounds in line_features(texts):
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield (b - a).astype(np.int64).tobytes() + size[a:b].astype(np.int64).tobytes() + np.packbits(bits[a:b], axis=1).tobytes()


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    size = np.frombuffer(blob, np.int64, n, 8)
    bits = np.unpackbits(np.frombuffer(blob, np.uint8, offset=8 + 8 * n).reshape(n, -1), axis=1)[:, :WIDTH] if n else np.zeros((0, WIDTH), np.uint8)
    return bits.astype(bool), size


def with_neighbours(bits: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and those of the line after, zero at a document's ends."""
    before, after = np.zeros_like(bits), np.zeros_like(bits)
    before[1:], after[:-1] = bits[:-1], bits[1:]
    inner = bounds[(bounds > 0) & (bounds < len(bits))]
    before[inner] = False
    after[inner - 1] = False
    return np.concatenate([bits, before, after], axis=1)


def messages(s: np.ndarray, bounds: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of forward (own line included) and backward messages of every line.

    ``s``: log odds of the lines alone; ``t[i, j]``: weight of label j after i.
    Documents advance together, one line a step, the longest first.
    """
    forward, backward = s.copy(), np.zeros_like(s)
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    start, sizes = bounds[:-1][order], sizes[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest + 1), "left")  # documents of more than k lines
    for k in range(1, longest):
        at = start[: active[k]] + k
        a = forward[at - 1]
        forward[at] += np.logaddexp(a + t[1, 1], t[0, 1]) - np.logaddexp(a + t[1, 0], t[0, 0])
    stop = start + sizes
    for k in range(1, longest):
        at = stop[: active[k]] - 1 - k
        m = s[at + 1] + backward[at + 1]
        backward[at] = np.logaddexp(m + t[1, 1], t[1, 0]) - np.logaddexp(m + t[0, 1], t[0, 0])
    return forward, backward


@dataclass
class Model:
    weights: np.ndarray
    transitions: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    base: float | None = None

    def shares(self, bits: np.ndarray, size: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Every document's length-weighted mean marginal of good lines."""
        out = np.zeros(len(bounds) - 1)
        if not len(bits):
            return out
        good = self.marginals(bits, bounds)
        sums = np.concatenate([[0.0], np.cumsum(good * size)])
        lengths = np.concatenate([[0], np.cumsum(size)])
        total = lengths[bounds[1:]] - lengths[bounds[:-1]]
        return (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(total, 1)

    def marginals(self, bits: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        k = bits.shape[1]
        own = bits.astype(np.float32) @ self.weights.reshape(3, k).T.astype(np.float32)
        s = own[:, 0].astype(np.float64)
        inner = np.ones(len(bits), bool)
        inner[bounds[bounds < len(bits)]] = False  # a document's first lines have none before them
        s[inner] += own[np.flatnonzero(inner) - 1, 1]
        last = np.flatnonzero(inner) - 1
        s[last] += own[last + 1, 2]
        forward, backward = messages(s, bounds, self.transitions)
        return sigmoid(forward + backward)

    def score(self, bits: np.ndarray, size: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        if self.base is not None:
            return np.full(len(bounds) - 1, self.base)
        return sigmoid(self.slope * _logit(self.shares(bits, size, bounds)) + self.shift)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _joined(docs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bounds = np.concatenate([[0], np.cumsum([len(s) for _, s in docs])]).astype(np.int64)
    return np.concatenate([b for b, _ in docs]), np.concatenate([s for _, s in docs]), bounds


def train(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, steps: int = 150, ridge: float = 2.0) -> Model:
    """Conditional maximum likelihood by full-batch Adam; each class weighs the same, each document by its lines' mean."""
    bits, _, bounds = _joined(docs)
    x = with_neighbours(bits, bounds).astype(np.float32)
    sizes = np.diff(bounds)
    y = np.repeat(labels, sizes).astype(np.float64)
    weight = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1)) / np.maximum(sizes, 1)
    w = np.repeat(weight, sizes)
    pair = np.ones(max(len(bits) - 1, 0), bool)  # lines k, k + 1 of one document
    pair[bounds[(bounds > 0) & (bounds < len(bits))] - 1] = False
    k = np.flatnonzero(pair)
    p, t = np.zeros(x.shape[1]), np.zeros((2, 2))
    mean, square = np.zeros(len(p) + 4), np.zeros(len(p) + 4)
    for step in range(1, steps + 1):
        s = (x @ p.astype(np.float32)).astype(np.float64)
        forward, backward = messages(s, bounds, t)
        good = sigmoid(forward + backward)
        gp = x.T @ (w * (y - good)).astype(np.float32) - ridge * p / max(len(docs), 1) * 0.1
        gt = np.zeros((2, 2))
        if len(k):
            m = s[k + 1] + backward[k + 1]
            joint = np.stack([np.full(len(k), t[0, 0]), t[0, 1] + m, forward[k] + t[1, 0], forward[k] + t[1, 1] + m])
            joint = np.exp(joint - joint.max(0))
            joint /= joint.sum(0)
            seen = (2 * y[k] + y[k + 1]).astype(np.int64)
            gt = (np.bincount(seen, w[k], 4) - (joint * w[k]).sum(1)).reshape(2, 2) - ridge * t / max(len(docs), 1)
        g = np.concatenate([gp, gt.ravel()])
        mean += 0.1 * (g - mean)
        square += 0.01 * (g * g - square)
        move = 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        p, t = p + move[:-4], np.clip(t + move[-4:].reshape(2, 2), -4, 4)
    return Model(p, t)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The field of at most ``per_class`` labelled documents of each class; a fifth of them calibrates."""
    found = sample(docs, labels, label, features, per_class, id_col, text_col, None)
    sets = [unpacked(x) for x, _, _ in found]
    y = np.array([v for _, v, _ in found], np.int64)
    if len(set(y.tolist())) < 2 or not sum(len(s) for _, s in sets):
        return Model(np.zeros(3 * WIDTH), np.zeros((2, 2)), base=float(y.mean()) if len(y) else 0.0)
    later = np.arange(len(y)) % 5 == 0
    if min(y[later].sum(), (1 - y[later]).sum()) < 10:
        later, earlier = np.ones(len(y), bool), np.ones(len(y), bool)  # too few to set aside
    else:
        earlier = ~later
    model = train([s for s, x in zip(sets, earlier) if x], y[earlier])
    shares = model.shares(*_joined([s for s, x in zip(sets, later) if x]))
    own = y[later]
    n1, n0 = max(int(own.sum()), 1), max(int((1 - own).sum()), 1)
    model.slope, model.shift = platt(_logit(shares), own, np.where(own == 1, 0.5 * len(own) / n1, 0.5 * len(own) / n0))
    return model


def scorer(spark: SparkSession, model: Model):
    """The model as a function of a text column."""
    at_workers(spark)
    shared = spark.sparkContext.broadcast(model)  # a few hundred weights

    @F.arrow_udf("double")
    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for texts in columns:
            found = [own.score(*x) for x in line_features(texts)]
            yield pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())

    return score


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    score = scorer(docs.sparkSession, model)
    rows = docs.select(F.col(id_col).alias("doc_id"), score(F.col(text_col).cast("string")).alias("score"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= BORDER).cast("int").alias("predicted"))


def good(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that score at least BORDER."""
    name = fresh(docs, "score")[0]
    return docs.withColumn(name, scorer(docs.sparkSession, model)(F.col(text_col).cast("string"))).where(F.col(name) >= BORDER).drop(name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return scored(docs, fit(docs, read(spark, sf_dir, "labels")))
