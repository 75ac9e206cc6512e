"""Exact top-k inner-product search over a vector-approximation file.

Weber, Schek and Blott, "A quantitative analysis and performance study for
similarity-search methods in high-dimensional spaces", 1998.

Two tables are written. The vectors have one row each, with a number that stays.
The approximation has one row per block of at most BLOCK vectors: their numbers
and one byte a component (the cell that the component falls in, of 256 between
the block's extremes); it is a small part of the vectors' size. A search

1.  scans the cells only: every query block meets every approximation block once,
    and for each query leaves the vectors whose upper bound reaches the k-th
    largest lower bound, first over all blocks that one task meets, then over all
    tasks. Query blocks are sent to as many slots as there are shuffle partitions,
    however many approximation blocks a slot has;
2.  reads the exact vectors of each query's FIRST * k highest upper bounds, whose
    k-th best score is a floor;
3.  reads those of the others whose upper bound reaches the floor. Then the k-th
    result is certain.

Of equal vectors in a block only the k + 1 with the smallest ids can be among the
k best of a query, so the others have no bounds; a vector that a third of all
rows repeat costs at most k + 1 bounds a block and query.

Defined results: a vector that is null, empty, or holds a null or non-finite
component takes no part, nor does one whose id is null. Rows with equal ids are
rows of their own: a query row leaves out only itself. Vectors of different
length never meet. Equal scores are ranked by the smaller id. With fewer than
k candidates all are returned. An empty table gives an empty result. Scores are
exact; a score, or a component times the scale, that 64 bits can't hold is an
error. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm.frames import at_workers, read, written

BLOCK = 16_384
QUERY_BLOCK = 2048
CELLS = 256
#: Query blocks whose survivors a task holds, and survivors of all of them, at most.
QUERY_BLOCKS, HELD = 512, 4_000_000
#: Times k: the candidates of a query that are read first.
FIRST = 2

VECTORS_DDL = "uid long, vec_id long, dim int, exact binary"
FILE = pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("n", pa.int32()), ("uids", pa.binary()), ("open", pa.binary()), ("low", pa.binary()), ("step", pa.binary()), ("cells", pa.binary())])
FILE_DDL = "block long, dim int, n int, uids binary, open binary, low binary, step binary, cells binary"
QUERIES = pa.schema([("dim", pa.int32()), ("q_uids", pa.binary()), ("q_exact", pa.binary())])
QUERIES_DDL = "dim int, q_uids binary, q_exact binary"
BOUNDS_DDL = "query_uid long, uid long, lower double, upper double"


def integers(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 1024.0) -> DataFrame:
    """vec_id and floor(scale * x) of every component, of the rows that take part."""
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    fits = F.forall("v", lambda x: F.abs(F.lit(scale) * x) < F.lit(2.0**63))
    scaled = F.when(fits, F.transform("v", lambda x: F.floor(F.lit(scale) * x))).otherwise(F.raise_error(F.lit("a scaled component doesn't fit 64 bits")).cast("array<bigint>"))
    return (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
        .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
        .where(whole)
        .select("vec_id", scaled.alias("v"))
    )


def _vector_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at = TaskContext.get().partitionId() << 33
    for batch in batches:
        lists, n = batch.column(1), batch.num_rows
        sizes = np.diff(lists.offsets.to_numpy())
        ends = np.cumsum(sizes)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        blobs = [flat[e - s : e].tobytes() for s, e in zip(sizes, ends)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + n)), batch.column(0), pa.array(sizes, pa.int32()), pa.array(blobs, pa.binary())], names=["uid", "vec_id", "dim", "exact"])
        at += n


def _open(exact: np.ndarray, ids: np.ndarray, uids: np.ndarray, most: int) -> np.ndarray:
    """Whether fewer than ``most`` equal vectors of the block have smaller ids."""
    _, group = np.unique(exact, axis=0, return_inverse=True)
    order = np.lexsort((uids, ids, group.ravel()))
    own = group.ravel()[order]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    place = np.arange(len(own)) - np.repeat(first, np.diff(np.concatenate([first, [len(own)]])))
    out = np.empty(len(own), bool)
    out[order] = place < most
    return out


def _file_rows(k: int):
    def packed(uids: np.ndarray, ids: np.ndarray, exact: np.ndarray) -> pa.RecordBatch:
        low, high = exact.min(0).astype(np.float64), exact.max(0).astype(np.float64)
        step = np.maximum((high - low + 1) / CELLS, 1e-9)
        cells = np.clip((exact.astype(np.float64) - low) / step, 0, CELLS - 1).astype(np.uint8)
        row = (int(uids[0]), exact.shape[1], len(uids), uids.tobytes(), _open(exact, ids, uids, k + 1).tobytes(), low.tobytes(), step.tobytes(), cells.tobytes())
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, FILE.types)], schema=FILE)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            for uid, vec_id, dim, blob in zip(*(batch.column(c).to_pylist() for c in range(4))):
                some = held.setdefault(dim, [])
                some.append((uid, vec_id, blob))
                if len(some) == BLOCK:
                    yield packed(*_columns(held.pop(dim), dim))
        for dim, some in held.items():
            yield packed(*_columns(some, dim))

    return rows


def _columns(some: list[tuple], dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    uids, ids, blobs = zip(*some)
    return np.array(uids, np.int64), np.array(ids, np.int64), np.frombuffer(b"".join(blobs), np.int64).reshape(len(uids), dim)


def build(vectors: DataFrame, k: int = 10) -> tuple[DataFrame, DataFrame]:
    """The vectors of ``integers(...)`` rows and their approximation for searches of up to ``k``, written to the shared folder. No shuffle."""
    at_workers(vectors.sparkSession)
    exact = written(vectors.mapInArrow(_vector_rows, VECTORS_DDL), "vectors")
    return exact, written(exact.mapInArrow(_file_rows(k), FILE_DDL), "va-file")


def _query_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list[tuple]] = {}
    row = lambda dim, some: pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((dim, np.array([u for u, _ in some], np.int64).tobytes(), b"".join(b for _, b in some)), QUERIES.types)], schema=QUERIES)
    for batch in batches:
        for uid, dim, blob in zip(*(batch.column(c).to_pylist() for c in range(3))):
            some = held.setdefault(dim, [])
            some.append((uid, blob))
            if len(some) == QUERY_BLOCK:
                yield row(dim, held.pop(dim))
    for dim, some in held.items():
        yield row(dim, some)


def bounds(query: np.ndarray, low: np.ndarray, step: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, float]:
    """Upper bounds of a query's scores with a block's vectors, and by how much lower bounds are below them."""
    q = query.astype(np.float64)
    slack = 1e-9 * (np.abs(q) * (np.abs(low) + step * CELLS)).sum() + 1
    return cells @ (q * step) + (q @ low + (np.maximum(q, 0) * step).sum() + slack), float((np.abs(q) * step).sum() + 2 * slack)


class Survivors:
    """What one task still holds of the vectors near each query of a block, over all approximation blocks it has met.

    ``lowest`` keeps the k largest lower bounds of every query; a vector whose
    upper bound is below the smallest of them is let go.
    """

    def __init__(self, uids: np.ndarray, k: int) -> None:
        self.uids, self.lowest = uids, np.full((len(uids), k), -np.inf)
        self.held: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = [[] for _ in uids]
        self.n = 0

    def meet(self, i: int, near: np.ndarray, upper: np.ndarray, width: float) -> None:
        k = self.lowest.shape[1]
        best = np.partition(upper, -k)[-k:] if len(upper) > k else upper
        best = np.concatenate([self.lowest[i], best - width])
        self.lowest[i] = np.partition(best, -k)[-k:]
        left = np.flatnonzero((upper >= self.lowest[i].min()) & (upper > -np.inf))
        if len(left):
            self.held[i].append((near[left], upper[left] - width, upper[left]))
            self.n += len(left)

    def rows(self) -> pa.RecordBatch | None:
        """(query_uid, uid, lower, upper) of what is left; nothing is held afterwards, the lower bounds stay."""
        out = []
        for i, parts in enumerate(self.held):
            if parts:
                uids, lower, upper = (np.concatenate(c) for c in zip(*parts))
                left = upper >= self.lowest[i].min()
                out.append((np.full(int(left.sum()), self.uids[i]), uids[left], lower[left], upper[left]))
        self.held, self.n = [[] for _ in self.uids], 0
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["query_uid", "uid", "lower", "upper"]) if out else None


def _meet(k: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[bytes, Survivors] = {}
        for batch in batches:
            names = batch.schema.names
            for at in range(batch.num_rows):  # one at a time: a row holds a block of either side
                r = dict(zip(names, (batch.column(c)[at].as_py() for c in range(len(names)))))
                dim, own = r["dim"], np.frombuffer(r["open"], bool)
                uids = np.frombuffer(r["uids"], np.int64)[own]
                low, step = np.frombuffer(r["low"], np.float64), np.frombuffer(r["step"], np.float64)
                cells = np.frombuffer(r["cells"], np.uint8).reshape(-1, dim)[own].astype(np.float64)
                key = r["q_uids"][:8]  # its first query tells a block of queries
                found = blocks.pop(key, None) or Survivors(np.frombuffer(r["q_uids"], np.int64), k)
                blocks[key] = found  # last among those at hand
                for i, query in enumerate(np.frombuffer(r["q_exact"], np.int64).reshape(-1, dim)):
                    upper, width = bounds(query, low, step, cells)
                    upper[uids == found.uids[i]] = -np.inf
                    found.meet(i, uids, upper, width)
                # what doesn't fit is told as it is; the search takes the floor over all tasks anyway
                while len(blocks) > QUERY_BLOCKS or sum(b.n for b in blocks.values()) > HELD:
                    told = blocks.pop(next(iter(blocks))).rows()
                    if told is not None:
                        yield told
        for found in blocks.values():
            told = found.rows()
            if told is not None:
                yield told

    return rows


def products(x: list[bytes], y: list[bytes]) -> list[int]:
    """Inner products of pairs of integer vectors, exact whatever their size."""
    out = []
    for a, b in zip(x, y):
        a, b = np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)
        if np.abs(a.astype(np.float64)) @ np.abs(b.astype(np.float64)) < 2.0**62:
            out.append(int(a @ b))
            continue
        score = sum(p * q for p, q in zip(a.tolist(), b.tolist()))
        if not -(1 << 63) <= score < 1 << 63:
            raise ValueError("a score doesn't fit 64 bits")
        out.append(score)
    return out


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = products(batch.column(3).to_pylist(), batch.column(4).to_pylist())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(3)), pa.array(scores, pa.int64())], names=["query_uid", "query_id", "vec_id", "score"])


def exactly(pairs: DataFrame, exact: DataFrame) -> DataFrame:
    """query_uid, query_id, vec_id, score of pairs (query_uid, uid)."""
    ends = pairs.join(exact.select("uid", "vec_id", F.col("exact").alias("y")), "uid").join(exact.select(F.col("uid").alias("query_uid"), F.col("vec_id").alias("query_id"), F.col("exact").alias("x")), "query_uid")
    return ends.select("query_uid", "query_id", "vec_id", "x", "y").mapInArrow(_scored, "query_uid long, query_id long, vec_id long, score long")


def search(exact: DataFrame, file: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """The k best of all other rows for every row whose id is divisible by ``every``."""
    n = file.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    spark = exact.sparkSession
    slots = max(1, min(math.ceil(n / BLOCK), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    queries = exact.where(F.col("vec_id") % every == 0).select("uid", "dim", "exact").mapInArrow(_query_rows, QUERIES_DDL)
    # each query block is sent to every slot of file blocks: the stated query set against all rows, in blocks;
    # a slot is about a task, so copies of queries follow the tasks and not the vectors
    sent = queries.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    met = file.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots)).cast("int")).join(sent, ["slot", "dim"])
    found = met.select("dim", "uids", "open", "low", "step", "cells", "q_uids", "q_exact").mapInArrow(_meet(k), BOUNDS_DDL)
    # over all blocks a vector must reach the k-th largest lower bound
    lower = Window.partitionBy("query_uid").orderBy(F.desc("lower"), "uid")
    of_query = Window.partitionBy("query_uid")
    floored = found.withColumn("place", F.row_number().over(lower)).withColumn("floor", F.max(F.when(F.col("place") == k, F.col("lower"))).over(of_query))
    near = written(
        floored.where("floor is null or upper >= floor").withColumn("turn", F.row_number().over(Window.partitionBy("query_uid").orderBy(F.desc("upper"), "uid"))).select("query_uid", "uid", "upper", "turn"), "candidates"
    )
    first = written(exactly(near.where(F.col("turn") <= FIRST * k), exact), "first-scores")
    by_score = Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id")
    floors = first.withColumn("place", F.row_number().over(by_score)).where(F.col("place") == k).select("query_uid", F.col("score").alias("floor"))
    # a bound carries a slack of its own, so comparing it with a score as a double loses nothing
    later = near.where(F.col("turn") > FIRST * k).join(floors, "query_uid").where(F.col("upper") >= F.col("floor").cast("double"))
    hits = first.unionByName(exactly(later.select("query_uid", "uid"), exact))
    return hits.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(*build(integers(read(spark, sf_dir, "embeddings"))))


ORACLE = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v, row_number() over () as r
  from embeddings
  where embedding is not null and vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, q.r, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on q.r <> c.r and len(q.v) = len(c.v)
  where q.vec_id % 100 = 0)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by r order by score desc, vec_id) as rank from scored)
where rank <= 10
"""
