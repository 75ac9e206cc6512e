"""Corpus pipeline: documents without toxic, poor and repeated ones, packed into sequences.

Every stage takes what the one before kept, is written as Parquet to the shared
folder and read again, so a lost executor costs at most the stage at hand. All
stages but the last return the columns of ``documents``.

Defined results: no rows give no rows in every stage. A null text counts as empty.
The classifiers score an empty text like one without words or lines, so it stays or
goes with all others of its kind; the dedup of equal texts keeps one empty text, that
of near duplicates all of them, for they link with nothing. Of rows that tie, the one
with the smallest doc_id stays, a null doc_id only where no other has one, and one row of
those that agree in id and text. Texts of any length are read whole. Other columns are
passed through, whatever their names; packing ignores them. Without labels of both
classes the classifiers give every row the share of label 1 (0 without labels).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandline.llm import exact_dedup, line_crf, ngram_join, packing, toxicity
from strandline.llm.frames import at_workers, read, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold of their language; the classifier learns from their labels."""
    return toxicity.clean(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality reaches the border; the field learns from the labels of those at hand."""
    return line_crf.good(docs, line_crf.fit(docs, read(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the smallest id."""
    at_workers(spark)
    return exact_dedup.first_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates, the one with the smallest id."""
    at_workers(spark)
    return ngram_join.first_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    import public_tokenizers

    at_workers(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("packing", pack),
]

#: No SQL can express the classifiers, the encoder and the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
