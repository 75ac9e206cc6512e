"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Rows with equal text form a group that stays together (law ``bytes``). Every
partial partition starts as one item against empty shards; again and again the
two partial partitions with the largest spread are combined, the heaviest shard
of one with the lightest of the other, until one partition is left.

At any scale the driver sees a bounded list of items: groups that weigh more
than 1 / HEAVY of all bytes stand alone (there are fewer than HEAVY of them),
the others are bundled by a hash of their text into at most BUNDLES items.
Rows get their slots by two-level numbering, so no shard is sorted in one task.

Defined results: a null text counts as empty; it and an empty text are equal
and weigh ``overhead`` bytes. Repeated rows each get a slot. Null doc_ids are
placed like any row. Equal items are taken in the order of their hashes. Very
long texts are hashed as they are. An empty table gives an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.frames import numbered, read, written

BUNDLES = 8192
HEAVY = 4096
#: A text of more than one in SHARE rows is sent to all tasks; there are at most SHARE of them.
SHARE = 10_000


def differencing(weights: np.ndarray, shards: int) -> np.ndarray:
    """The shard of every item, by differencing into ``shards`` parts."""
    n = len(weights)
    if n == 0:
        return np.zeros(0, np.int64)
    # node i < n is item i; a later node joins (left, right), right's shard of rank r going to left's of rank shards - 1 - r
    loads = {i: np.concatenate([np.zeros(shards - 1), [float(w)]]) for i, w in enumerate(weights)}  # ascending
    heap = [(-(x[-1] - x[0]), i) for i, x in loads.items()]
    heapq.heapify(heap)
    joined: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        total = loads.pop(a) + loads.pop(b)[::-1]
        order = np.argsort(total, kind="stable")
        node = n + len(joined)
        joined.append((a, b, order))
        loads[node] = total = total[order]
        heapq.heappush(heap, (-(total[-1] - total[0]), node))
    # walk down: places[node][rank] is the final shard of the node's shard of that rank
    places = {heap[0][1]: np.arange(shards)}
    out = np.zeros(n, np.int64)
    for node in range(n + len(joined) - 1, -1, -1):
        place = places.pop(node)
        if node < n:
            out[node] = place[-1]
            continue
        a, b, order = joined[node - n]
        before = np.empty(shards, np.int64)
        before[order] = place
        places[a], places[b] = before, before[::-1]
    return out


def shard(docs: DataFrame, shards: int = 40, overhead: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.md5(text).alias("text_md5"), (F.octet_length(text) + overhead).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = written(rows, "sizes")  # texts are read once
    groups = written(rows.groupBy("text_md5").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "equal-texts")
    sums = groups.agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).head()
    total, n = sums["bytes"] or 0, sums["n"] or 0
    bundle = F.when(F.col("bytes") * HEAVY > total, F.col("text_md5")).otherwise(F.concat(F.lit("bundle"), F.pmod(F.xxhash64("text_md5"), F.lit(BUNDLES)).cast("string")))
    items = groups.withColumn("item", bundle).groupBy("item").agg(F.sum("bytes").alias("bytes")).collect()  # at most BUNDLES + HEAVY rows
    items.sort(key=lambda r: (-r["bytes"], r["item"]))
    placed = differencing(np.array([r["bytes"] for r in items]), shards)
    plan = spark.createDataFrame([(r["item"], int(s)) for r, s in zip(items, placed)], "item string, shard int")
    of_group = groups.withColumn("item", bundle).join(F.broadcast(plan), "item")
    # texts that more than one row in SHARE has, fewer than SHARE of them, meet their rows by a broadcast
    large = F.col("n") * SHARE > n
    told = rows.join(F.broadcast(of_group.where(large).select("text_md5", F.col("shard").alias("hot"))), "text_md5", "left")
    rest = told.where("hot is null").drop("hot").join(of_group.where(~large).select("text_md5", "shard"), "text_md5")
    placed = written(told.where("hot is not null").withColumnRenamed("hot", "shard").unionByName(rest).drop("text_md5"), "placed")
    out = numbered(placed, "shard", ["doc_id", "text_crc32"], "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents"))
