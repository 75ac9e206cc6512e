"""Bounded samples of labelled documents for training, and calibration of scores."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.frames import at_workers, held_out


def sample(docs: DataFrame, labels: DataFrame, label: str, features: Callable[[pa.Array], Iterator[bytes]], per_class: int, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> list[tuple[bytes, int, str]]:
    """(features, label, language) of at most ``per_class`` documents of each label.

    Only rows that are not held out are taken; which ones, a hash of the id
    decides, so the sample doesn't depend on the order of the table. The
    language is for thresholds, never for scores.
    """
    at_workers(docs.sparkSession)
    known = (
        labels.select(F.col("doc_id").cast("long").alias("sample_id"), F.col(label).cast("int").alias("sample_label"))
        .where(F.col("sample_id").isNotNull() & F.col("sample_label").isin(0, 1) & ~held_out(F.col("sample_id")))
        .groupBy("sample_id")
        .agg(F.max("sample_label").alias("sample_label"))
    )
    pick = F.xxhash64("sample_id", F.lit(label))
    chosen = [known.where(F.col("sample_label") == v).orderBy(pick, "sample_id").limit(per_class) for v in (0, 1)]
    few = chosen[0].unionByName(chosen[1])
    lang = F.lit("") if lang_col is None or lang_col not in docs.columns else F.coalesce(F.col(lang_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("sample_id"), lang.alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # at most 2 x per_class ids are sent to every task
    own = rows.join(F.broadcast(few), "sample_id").groupBy("sample_id").agg(F.min(F.struct("text", "lang", "sample_label")).alias("own")).select("sample_id", "own.sample_label", "own.lang", "own.text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = list(features(batch.column(3)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(blobs, pa.binary())], names=["sample_id", "sample_label", "lang", "features"])

    found = own.mapInArrow(extract, "sample_id long, sample_label int, lang string, features binary").collect()
    found.sort(key=lambda r: (r["sample_id"] * 2654435761 % 2**32, r["sample_id"]))
    return [(bytes(r["features"]), r["sample_label"], r["lang"]) for r in found]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def platt(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope (positive) and shift that make ``sigmoid(slope * logit + shift)`` a probability."""
    n1, n0 = (weights * labels).sum(), (weights * (1 - labels)).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = max(float(np.std(logits)), 1e-6)
    x, a, b = logits / scale, 1.0, 0.0
    for _ in range(steps):  # Newton's method with a ridge
        p = sigmoid(a * x + b)
        g, w = weights * (p - target), weights * np.maximum(p * (1 - p), 1e-6)
        ga, gb = (g * x).sum() + 1e-3 * a, g.sum()
        haa, hab, hbb = (w * x * x).sum() + 1e-3, (w * x).sum(), w.sum() + 1e-9
        det = haa * hbb - hab * hab
        if det <= 0:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        size = max(1.0, abs(da), abs(db))
        a, b = a - da / size, b - db / size
        if abs(da) + abs(db) < 1e-7:
            break
    return max(a, 1e-3) / scale, b
