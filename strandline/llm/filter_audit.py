"""What filters of a corpus remove together: an audit of every order in which they may be applied.

Method. Every document is told the set of filters that it fails, as a bit mask,
and masks are counted within a part, for all documents and for those of either
label. That table (parts x 2^filters counts at most) is all that is left of the
corpus. The subset-zeta transform turns the counts of a part into the number of
documents whose mask lies within a set, one addition for every set and filter;
the survivors of a set of filters are the documents whose mask lies within the
others. A step of an order is the difference between two sets that differ in
one filter, so no document is looked at again, whatever the number of orders.

Equal texts: a document fails the last filter if a row of a smaller doc_id has
the same text, anywhere in the table. Digests (SHA-256) and not texts are moved:
the smallest id of a digest is a partial aggregate, and the rows that pass are
those that a join by (digest, id) finds again, so the copies of a hot text are
spread over the tasks. Rows that agree in id, digest and part are counted before
they are moved.

Defined results: a null text counts as empty, and an empty text has no words (it
fails the length filter alone, unless it repeats). A null doc_id counts as greater
than all others and has no labels; rows with equal doc_id are no copies of each
other. Of repeated labels of a doc_id the greatest counts. A null source is the
part of the empty string. Repeated rows count each. Very long texts are read
whole, one row at a time. An empty table has no parts and gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.frames import UNKNOWN, at_workers, label_of, read, written

SPACES = r"[\x20\x09-\x0D]+"
#: The most filters of an audit: their orders are the factorial of their number.
FILTERS = 7
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def words_of(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")


#: Name and failure condition of the filters that look at a text alone.
TEXT_FILTERS = {
    "A": lambda text, words: F.size(words) < 50,
    "B": lambda text, words: 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
    "C": lambda text, words: 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 5 * F.length(text),
    "D": lambda text, words: text.rlike(r"[#$%&*|]"),
}


def failures(docs: DataFrame, filters: dict = TEXT_FILTERS, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """label, digest, part, mask and times: how often a row of that id, text and part occurs.

    Bit i of the mask is set if the text fails the i-th of ``filters``.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(label_of(F.col(id_col)).alias("label"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"), words_of(text).alias("words"))
    bits = [F.when(fails(F.col("text"), F.col("words")), 1 << i).otherwise(0) for i, fails in enumerate(filters.values())]
    mask = sum(bits[1:], bits[0]) if bits else F.lit(0)
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    return rows.select("label", digest.alias("digest"), "part", mask.cast("int").alias("mask")).groupBy("label", "digest", "part", "mask").agg(F.count("*").alias("times"))


def masks(docs: DataFrame, labels: DataFrame, filters: dict = TEXT_FILTERS, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """part, mask, n, good, toxic: documents of every mask, the bit after those of ``filters`` for repeated texts."""
    at_workers(docs.sparkSession)
    own = written(failures(docs, filters, id_col, text_col, part_col), "failures")
    told = (
        labels.select(F.col("doc_id").cast("long").alias("label"), F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0)).alias("good"), F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0)).alias("toxic"))
        .where("label is not null")
        .groupBy("label")
        .agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
        .where("good = 1 or toxic = 1")
    )
    firsts = own.groupBy("digest").agg(F.min("label").alias("label"))
    # what passes the last filter, and all rows of either label, are found by joins on ids; the rest is arithmetic
    passing = own.join(firsts, ["digest", "label"], "left_semi")
    known = F.col("label") != UNKNOWN
    labelled = own.where(known).select("label", "digest", "part", "mask", "times").join(told, "label")
    repeated = labelled.join(firsts.withColumn("first", F.lit(True)), ["digest", "label"], "left")
    last = 1 << len(filters)
    every = own.groupBy("part", "mask").agg(F.sum("times").alias("n_all"))
    fresh = passing.groupBy("part", "mask").agg(F.sum("times").alias("n_first"))
    counts = every.join(fresh, ["part", "mask"], "left").select("part", "mask", "n_all", F.coalesce("n_first", F.lit(0)).alias("n_first"))
    nothing = F.lit(0).cast("long")
    split = counts.select("part", F.inline(F.array(
        F.struct(F.col("mask").alias("mask"), F.col("n_first").alias("n"), nothing.alias("good"), nothing.alias("toxic")),
        F.struct((F.col("mask") + last).alias("mask"), (F.col("n_all") - F.col("n_first")).alias("n"), nothing.alias("good"), nothing.alias("toxic")),
    )))
    marked = repeated.select("part", (F.col("mask") + F.when(F.col("first"), 0).otherwise(last)).alias("mask"), nothing.alias("n"), (F.col("good") * F.col("times")).alias("good"), (F.col("toxic") * F.col("times")).alias("toxic"))
    return split.unionByName(marked).groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic")))


def zeta(counts: np.ndarray, n: int) -> np.ndarray:
    """Sums over subsets along the last axis, of 2^n masks: out[s] is the sum of counts[m] over all m within s."""
    cube = counts.reshape(*counts.shape[:-1], *[2] * n).copy()
    for axis in range(cube.ndim - n, cube.ndim):
        low, high = np.moveaxis(cube, axis, 0)
        high += low
    return cube.reshape(counts.shape)


def steps_of(names: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Every order of the filters with, for each of its steps, the filter and the set of those before it."""
    orders = list(permutations(range(len(names))))
    which = np.array(orders, np.int64).reshape(len(orders), len(names))
    bit = 1 << which
    return ["".join(names[i] for i in o) for o in orders], which, np.cumsum(bit, axis=1) - bit


def audited(counts: np.ndarray, names: str) -> dict[str, np.ndarray]:
    """COUNTS, each of shape (parts, orders, steps), from counts of shape (parts, 3, 2^filters): all, good and toxic."""
    n = len(names)
    everything = (1 << n) - 1
    _, which, before = steps_of(names)
    after = before | (1 << which)
    # survivors[s]: documents whose mask has nothing of s in it
    survivors = zeta(counts, n)[..., everything - np.arange(1 << n)]
    lost = survivors[..., before] - survivors[..., after]
    bits = 1 << np.arange(n)
    failing = survivors[:, 0, :1] - survivors[:, 0, bits]
    alone = survivors[:, 0, everything - bits] - survivors[:, 0, everything : everything + 1]
    removed = lost[:, 0]
    shapley = np.stack([np.where(which == f, removed, 0).sum(axis=(1, 2)) for f in range(n)], axis=1)
    return {
        "kept": survivors[:, 0][:, after],
        "removed": removed,
        "redundant": failing[:, which] - removed,
        "unique_fails": alone[:, which],
        "good_lost": lost[:, 1],
        "toxic_lost": lost[:, 2],
        "shapley": shapley[:, which],
    }


def audit(counted: DataFrame, names: str) -> DataFrame:
    """One row for every part, order of the filters ``names`` and step, from a table of ``masks``."""
    n = len(names)
    if not 1 <= n <= FILTERS or len(set(names)) != n:
        raise ValueError(f"an audit takes 1 to {FILTERS} filters of different one-letter names")
    orders, which, _ = steps_of(names)
    size = len(orders) * n
    order_column = pa.array([o for o in orders for _ in range(n)])
    step_column = pa.array(np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders)))
    filter_column = pa.array([names[f] for f in which.ravel()])

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, cells in zip(batch.column(0), batch.column(1).to_pylist()):
                counts = np.zeros((1, 3, 1 << n), np.int64)
                for cell in cells:
                    counts[0, :, cell["mask"]] += (cell["n"], cell["good"], cell["toxic"])
                found = audited(counts, names)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(part, size), order_column, step_column, *(pa.array(found[c].ravel()) for c in COUNTS), filter_column],
                    names=["part", "filter_order", "step", *COUNTS, "filter"],
                )

    # a part has at most 2^n masks, whatever the number of its documents
    cells = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return cells.mapInArrow(tell, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS) + ", filter string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = masks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return audit(written(counted, "masks"), "ABCDE")


ORACLE = r"""
with told as (
  select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels where doc_id is not null group by doc_id),
texts as (
  select coalesce(doc_id, 9223372036854775807) as id, coalesce(source, '') as part, coalesce(text, '') as t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents),
failed as (
  select part, id,
         (len(w) < 50)::int
         + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::int
         + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::int
         + 8 * regexp_matches(t, '[#$%&*|]')::int
         + 16 * (id > min(id) over (partition by t))::int as mask
  from texts),
counted as (
  select part, mask, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
  from failed left join told on id = doc_id group by part, mask),
letters(l, b) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders as (
  select a.l || b.l || c.l || d.l || e.l as filter_order, [a.b, b.b, c.b, d.b, e.b] as bits
  from letters a join letters b on b.l <> a.l join letters c on c.l not in (a.l, b.l)
  join letters d on d.l not in (a.l, b.l, c.l) join letters e on e.l not in (a.l, b.l, c.l, d.l)),
steps as (
  select filter_order, step, bits[step] as bit, coalesce(list_sum(bits[1:step - 1]), 0)::int as earlier
  from orders, unnest(range(1, 6)) as s(step)),
told_steps as (
  select part, filter_order, step, bit,
         sum(case when mask & (earlier | bit) = 0 then n else 0 end) as kept,
         sum(case when mask & earlier = 0 and mask & bit <> 0 then n else 0 end) as removed,
         sum(case when mask & earlier <> 0 and mask & bit <> 0 then n else 0 end) as redundant,
         sum(case when mask = bit then n else 0 end) as unique_fails,
         sum(case when mask & earlier = 0 and mask & bit <> 0 then good else 0 end) as good_lost,
         sum(case when mask & earlier = 0 and mask & bit <> 0 then toxic else 0 end) as toxic_lost
  from counted cross join steps group by part, filter_order, step, bit)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
       unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
       (sum(removed) over (partition by part, bit))::bigint as shapley, filter_order[step] as filter
from told_steps
"""
