"""Exact deduplication against immutable snapshots, screened by binary-fuse filters.

Texts are equal when identical after each run of ASCII white space is replaced
by one space. A snapshot is a written table with one row per distinct text
(its SHA-256, byte length, first row and count) and, for every bucket of
digests, one static binary-fuse filter. A batch is first grouped on its own, so
that thousands of copies become one row before anything else happens. Its
distinct digests are screened bucket by bucket by the filters: what a filter
rejects is new for certain; what it passes is joined to the snapshot's exact
bucket. Of each match the texts of both sides' first rows are then compared
byte by byte. Only those texts are moved between tasks, otherwise digests.

Texts are read and digested once. The groups that hold more than a
SHARE-th of all rows, at most SHARE of them, go to the rows by a broadcast, the
others by a join, so no task gathers the copies of a hot text.

Defined results: a null text counts as empty. Rows with equal doc_id are rows
of their own; of equal texts the row with the smallest doc_id stays (a null
doc_id counts as greatest), of equal doc_ids one of them. An empty table gives
an empty result. Very long texts are digested as they are, one at a time. Two
different texts with one SHA-256 and length would be an error. Extra columns
are ignored or passed through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import fuse
from strandline.llm.frames import UNKNOWN, at_workers, label_of, read, rows_of, text_key, written

#: Digests in a bucket, which has one filter, at about the most.
BUCKET = 500_000
#: A group of more than one in SHARE rows is sent to all tasks; there are at most SHARE of them.
SHARE = 10_000
#: First rows of matched groups (about 100 bytes each) that may be sent to all tasks; beyond it they are joined by a shuffle.
BROADCAST_ROWS = 100_000


@dataclass
class Snapshot:
    """Distinct texts kept so far: groups(bucket, sha, bytes, first, n) and filters(bucket, filter)."""

    groups: DataFrame
    filters: DataFrame


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """label, key, sha, bytes of every row, written to the shared folder; label and key say which row it is."""
    at_workers(docs.sparkSession)
    text = F.col(text_col).cast("string")
    rows = docs.select(label_of(F.col(id_col)).alias("label"), text_key(text).alias("key"), normalised(text).alias("text"))
    return written(rows.select("label", "key", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha"), F.octet_length("text").cast("long").alias("bytes")), "digests")


def grouped(rows: DataFrame, buckets: int) -> DataFrame:
    """One row per distinct digest; copies meet in a map-side partial aggregate first."""
    return (
        rows.groupBy("sha", "bytes")
        .agg(F.min(F.struct("label", "key")).alias("first"), F.count("*").alias("n"))
        .select(F.pmod(F.xxhash64("sha"), F.lit(buckets)).cast("int").alias("bucket"), "sha", "bytes", "first", "n")
    )


def _keys(sha: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(x[:8] for x in sha), np.uint64)


def _filter_of(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"bucket": pdf["bucket"].iloc[:1], "filter": [fuse.build(_keys(pdf["sha"]))]})


def snapshot(groups: DataFrame, name: str = "snapshot") -> Snapshot:
    """``groups`` frozen in the shared folder together with the filters of their buckets."""
    groups = written(groups, f"{name}-groups")
    filters = groups.select("bucket", "sha").groupBy("bucket").applyInPandas(_filter_of, "bucket int, filter binary")
    return Snapshot(groups, written(filters, f"{name}-filters"))


def _screen(incoming: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    seen = np.zeros(len(incoming), bool)
    for blob in filters["filter"]:
        seen |= fuse.contains(blob, _keys(incoming["sha"]))
    return pd.DataFrame({"sha": incoming["sha"], "bytes": incoming["bytes"], "seen": seen})


def absorb(incoming: DataFrame, known: Snapshot, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of a batch and of the snapshot together, (sha, bytes, first, n) for each distinct text of either.

    ``docs`` has the texts of both, for the byte check.
    """
    incoming = written(incoming, "incoming")
    # a bucket's digests and its filter meet in one task; a bucket holds distinct digests only
    screened = incoming.select("bucket", "sha", "bytes").groupBy("bucket").cogroup(known.filters.groupBy("bucket")).applyInPandas(_screen, "sha binary, bytes bigint, seen boolean")
    passed = screened.where("seen").select("sha", "bytes")
    maybe = incoming.select("bucket", "sha", "bytes", F.col("first").alias("own"), F.col("n").alias("own_n")).join(passed, ["sha", "bytes"])
    # what the filters reject is new without a look at the snapshot; what they pass meets its exact bucket
    met = written(known.groups.join(maybe.drop("bucket"), ["sha", "bytes"]), "matched")
    compared(met, docs, id_col, text_col)
    both = met.select("sha", "bytes", F.least("first", "own").alias("first"), (F.col("n") + F.col("own_n")).alias("n"))
    alone = [x.select("sha", "bytes", "first", "n").join(met.select("sha", "bytes"), ["sha", "bytes"], "left_anti") for x in (known.groups, incoming)]
    return written(both.unionByName(alone[0]).unionByName(alone[1]), "groups")


def compared(met: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
    """An error unless the normalised texts of ``first`` and ``own`` of every match are equal byte by byte."""
    ends = met.select("sha", "bytes", F.explode(F.array("first", "own")).alias("end")).select("sha", "bytes", "end.label", "end.key")
    few = F.broadcast(ends) if 2 * met.count() <= BROADCAST_ROWS else ends
    text = F.col(text_col).cast("string")
    texts = docs.select(label_of(F.col(id_col)).alias("label"), text_key(text).alias("key"), text.alias("text")).join(few, ["label", "key"])
    pairs = texts.groupBy("sha", "bytes").agg(F.min(normalised(F.col("text"))).alias("low"), F.max(normalised(F.col("text"))).alias("high"))
    if not pairs.where("low <> high").isEmpty():
        raise ValueError("different texts with one SHA-256")


def equal_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The digests of all rows of ``docs`` and the groups of equal texts.

    The lower half of the id range is taken as the batch that came first and
    becomes the snapshot; the rest comes in against it.
    """
    rows = digests(docs, id_col, text_col)
    known = F.when(F.col("label") != UNKNOWN, F.col("label"))
    low, high, n = rows.agg(F.min(known), F.max(known), F.count("*")).head()
    middle = 0 if low is None else (low + high) // 2
    buckets = max(16, math.ceil(n / BUCKET))
    frozen = snapshot(grouped(rows.where(F.col("label") <= middle), buckets))
    return rows, absorb(grouped(rows.where(F.col("label") > middle), buckets), frozen, docs, id_col, text_col)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    rows, groups = equal_texts(docs, id_col, text_col)
    n = rows.count()
    large = F.col("n") * SHARE > n
    # rows that agree in id and text are one here, told as often as they occur; one of them stays
    own = rows.groupBy("sha", "bytes", "label", "key").agg(F.count("*").alias("times"))
    hot = groups.where(large).select("sha", "bytes", F.col("first").alias("hot_first"), F.col("n").alias("hot_n"))  # fewer than SHARE rows
    told = own.join(F.broadcast(hot), ["sha", "bytes"], "left")
    rest = told.where("hot_n is null").drop("hot_first", "hot_n").join(groups.where(~large).select("sha", "bytes", "first", "n"), ["sha", "bytes"])
    every = told.where("hot_n is not null").withColumnsRenamed({"hot_first": "first", "hot_n": "n"}).unionByName(rest)
    # two steps, so that no array is long
    each = every.withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / 4096)))).withColumn("i", F.explode(F.sequence(F.col("step") * 4096, F.least(F.col("times"), (F.col("step") + 1) * 4096) - 1)))
    known = lambda c: F.when(c != UNKNOWN, c)
    kept = (F.col("i") == 0) & (F.col("label") == F.col("first.label")) & (F.col("key") == F.col("first.key"))
    return each.select(known(F.col("label")).alias("doc_id"), known(F.col("first.label")).alias("keep_id"), F.col("n").alias("group_size"), kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def first_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs``, all columns, for each distinct text."""
    return rows_of(docs, equal_texts(docs, id_col, text_col)[1].select("first.label", "first.key"), id_col, text_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(read(spark, sf_dir, "documents"))


ORACLE = r"""
with t as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents)
select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size,
       doc_id = min(doc_id) over g as kept, text_sha256
from t window g as (partition by text_sha256)
"""
