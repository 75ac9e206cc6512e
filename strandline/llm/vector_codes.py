"""Product codes of vectors: integer k-means of every part position, by a tree reduction of numpy tensors.

Method. Components are scaled to integers, vectors are cut into equal parts, and a
part position has a codebook of its own. Vectors are packed once into columnar
blocks (one row a block: ids, labels and the components column by column, as
bytes) and written to the shared folder. A round is one ``treeAggregate`` over the
RDD of blocks: a task assigns the parts of its blocks, with distances that grow
dimension by dimension over a whole block, adds them into int64 tensors of sums
and counts with ``np.add.at``, and the tensors of tasks merge through a tree, so
that the driver receives few of them, each of parts x entries x (width + 1) numbers
whatever the table's size. The new codebooks go out by a broadcast. Codes and
errors are made from the same blocks in the last pass.

Everything is integer arithmetic, so results don't depend on how rows are dealt,
on the order of merging or on tasks that ran twice. Blocks whose components exceed
LARGE are worked in Python's integers instead of 64 bits.

Defined results: vectors null, empty, or holding null or non-finite components take
no part and have no row. The length of the vector of the smallest kept id is that of
the table; a vector of another length, or of one that the parts don't divide, is an
error. The smallest ids (ties by the vector; a null id counts as greatest) begin the
codebooks; with fewer vectors than entries, codebooks have as many entries as there
are vectors. Ties in distance go to the lower entry, and an unused entry stays as it
is. Repeated rows count each and give a row each. The label error of a null label is
the sum over all null labels. An error sum beyond 64 bits is an error. An empty
table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.frames import read, written

#: Vectors of a block at most; distances of a block and a part take BLOCK x entries x 8 bytes.
BLOCK = 1024
#: Components beyond it are worked in Python's integers: squares and their sums over 512 dimensions fit 64 bits below.
LARGE = 1 << 26
#: A label of more than one in SHARE rows meets its rows by a broadcast; there are at most SHARE of them.
SHARE = 10_000


def usable(vector: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, bad)


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as int64 or, for what may not fit, as Python's integers."""
    scaled = np.floor(values * scale)
    if len(scaled) == 0 or np.abs(scaled).max() < 2.0**62:
        return scaled.astype(np.int64)
    if not np.isfinite(scaled).all():
        raise ValueError("a component is beyond the range of scaled numbers")
    return np.array([int(x) for x in scaled], object)


def blocks_of(vectors: DataFrame, scale: int, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """n, ids, known, labels, labelled, width and columns of blocks of vectors, written to the shared folder.

    ``columns`` holds the components as little-endian int64, all of the first
    dimension first; ``exact`` instead holds them as decimal text if some don't fit.
    """
    kept = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("vector")).where(usable(F.col("vector")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                lengths = set(part.column(2).value_lengths().to_pylist())
                if len(lengths) > 1:
                    raise ValueError(f"vectors of different lengths: {sorted(lengths)}")
                ids, labels = part.column(0), part.column(1)
                values = integers(np.asarray(part.column(2).flatten(), np.float64), scale).reshape(part.num_rows, -1).T
                small = values.dtype != object
                cells = {
                    "n": part.num_rows,
                    "width": lengths.pop(),
                    "ids": np.asarray(ids.fill_null(0), np.int64).tobytes(),
                    "known": np.asarray(ids.is_valid(), np.bool_).tobytes(),
                    "labels": np.asarray(labels.fill_null(0), np.int64).tobytes(),
                    "labelled": np.asarray(labels.is_valid(), np.bool_).tobytes(),
                    "columns": np.ascontiguousarray(values).tobytes() if small else None,
                    "exact": None if small else " ".join(str(x) for x in values.ravel()),
                }
                yield pa.RecordBatch.from_pylist([cells], schema=SCHEMA)

    return written(kept.mapInArrow(pack, "n int, width int, ids binary, known binary, labels binary, labelled binary, columns binary, exact string"), "vector-blocks")


SCHEMA = pa.schema([("n", pa.int32()), ("width", pa.int32()), *((c, pa.binary()) for c in ("ids", "known", "labels", "labelled", "columns")), ("exact", pa.string())])


def columns_of(n: int, width: int, columns: bytes | None, exact: str | None) -> np.ndarray:
    """A block's components, one row a dimension."""
    if exact is not None:
        return np.array([int(x) for x in exact.split()], object).reshape(width, n)
    found = np.frombuffer(columns, np.int64).reshape(width, n)
    return found if np.abs(found).max() < LARGE else found.astype(object)


def assigned(values: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and squared distance of every part of a block; ``books`` is (parts, entries, width of a part)."""
    parts, entries, width = books.shape
    wide = values.dtype == object or books.dtype == object
    codes, errors = np.zeros((parts, values.shape[1]), np.int64), np.zeros((parts, values.shape[1]), object if wide else np.int64)
    for p in range(parts):
        distance = np.zeros((values.shape[1], entries), object if wide else np.int64)
        for d in range(width):
            apart = values[p * width + d][:, None] - books[p, :, d][None, :]
            distance += apart * apart
        codes[p] = distance.argmin(axis=1)  # the first of equal ones
        errors[p] = np.take_along_axis(distance, codes[p][:, None], 1)[:, 0]
    return codes, errors


def add_block(total: tuple | None, block: tuple, books: np.ndarray) -> tuple:
    """Sums and counts of the parts that are assigned to each entry, with those of a block added."""
    values = columns_of(*block)
    parts, entries, width = books.shape
    sums, counts = total or (np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64))
    if values.dtype == object and sums.dtype != object:
        sums = sums.astype(object)
    codes, _ = assigned(values, books)
    for p in range(parts):
        np.add.at(sums[p], codes[p], values[p * width : (p + 1) * width].T)
        np.add.at(counts[p], codes[p], 1)
    return sums, counts


def merge(a: tuple | None, b: tuple | None) -> tuple | None:
    if a is None or b is None:
        return a or b
    return a[0] + b[0], a[1] + b[1]


def first_books(vectors: DataFrame, scale: int, parts: int, entries: int, id_col: str = "vec_id", vector_col: str = "embedding") -> np.ndarray | None:
    """(parts, entries, width) of the vectors of the smallest ids; None if there is no vector."""
    kept = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).where(usable(F.col("vector")))
    rows = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()  # at most ``entries`` vectors
    if not rows:
        return None
    width = len(rows[0]["vector"])
    if width % parts or any(len(r["vector"]) != width for r in rows):
        raise ValueError(f"vectors have to be of one length that {parts} divides")
    values = integers(np.array([x for r in rows for x in r["vector"]]), scale)
    if values.dtype != object and np.abs(values).max() >= LARGE:
        values = values.astype(object)
    return values.reshape(len(rows), parts, width // parts).transpose(1, 0, 2)


def trained(blocks: DataFrame, books: np.ndarray, rounds: int, depth: int = 2) -> np.ndarray:
    """``books`` after so many rounds of assignment and replacement by floored means."""
    context = blocks.sparkSession.sparkContext
    whole = books.shape[0] * books.shape[2]
    for _ in range(rounds):
        sent = context.broadcast(books)

        def step(total: tuple | None, row, sent=sent) -> tuple:
            if row["width"] != whole:
                raise ValueError(f"a vector of {row['width']} components among vectors of {whole}")
            return add_block(total, (row["n"], row["width"], row["columns"], row["exact"]), sent.value)

        total = blocks.select("n", "width", "columns", "exact").rdd.treeAggregate(None, step, merge, depth)
        sent.destroy()
        if total is None:
            return books
        sums, counts = total
        used = (counts > 0)[:, :, None]
        books = np.where(used, sums // np.maximum(counts, 1)[:, :, None], books)
    return books


def told(books: np.ndarray) -> str:
    """SHA-256 of all entries' components as decimal numbers, by part, entry and position."""
    return hashlib.sha256(",".join(str(int(x)) for x in books.ravel()).encode()).hexdigest()


def coded(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code and error of every vector."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # a row of the table is a block
                cells = batch.slice(i, 1).to_pylist()[0]
                codes, errors = assigned(columns_of(cells["n"], cells["width"], cells["columns"], cells["exact"]), books)
                error = errors.sum(axis=0)
                if error.dtype == object and max(error) >= 2**63:
                    raise ValueError("a vector's squared distance is beyond 64 bits")
                mask = lambda c: ~np.frombuffer(cells[c], np.bool_)
                text = [row.tobytes().hex() for row in codes.T.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(cells["ids"], np.int64), mask=mask("known")), pa.array(np.frombuffer(cells["labels"], np.int64), mask=mask("labelled")), pa.array(text), pa.array(error.astype(np.int64))],
                    names=["vec_id", "label", "code", "error"],
                )

    return blocks.mapInArrow(tell, "vec_id long, label long, code string, error long")


def with_label_error(rows: DataFrame) -> DataFrame:
    """``rows`` with the sum of ``error`` over all rows of the same label; sums are made before rows are moved.

    Frequent labels, SHARE at most, meet their rows by a broadcast, so that no task
    gathers the rows of one label; the others by a join.
    """
    rows = written(rows, "vector-codes")
    sums = written(rows.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("times")), "label-errors")
    n = sums.agg(F.sum("times")).head()[0] or 0
    frequent = F.col("times") * SHARE > n
    own = lambda t, c: t.select(F.col("label").alias("own_label"), F.col("label_error").alias(c))
    same = F.col("label").eqNullSafe(F.col("own_label"))
    hot = rows.join(F.broadcast(own(sums.where(frequent), "label_error")), same, "left").drop("own_label")
    rest = hot.where("label_error is null").drop("label_error").join(own(sums.where(~frequent), "label_error"), same).drop("own_label")
    return hot.where("label_error is not null").unionByName(rest)


def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every vector that takes part."""
    if parts < 1 or rounds < 0 or scale < 1 or not 1 <= entries <= 256:
        raise ValueError("a code has at least one part and 1 to 256 entries, rounds and scale aren't negative")
    books = first_books(vectors, scale, parts, entries, id_col, vector_col)
    if books is None:
        return vectors.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    blocks = blocks_of(vectors, scale, id_col, vector_col, label_col)
    books = trained(blocks, books, rounds)
    return with_label_error(coded(blocks, books)).select("vec_id", "code", "error", "label_error", F.lit(told(books)).alias("codebooks_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(read(spark, sf_dir, "embeddings"))


def _round(n: int) -> str:
    """The SQL of one round: assignment by the books of round n - 1, and the books of round n."""
    comps = ("a", "b", "c", "d")
    distance = " + ".join(f"(p.{x} - k.{x}) * (p.{x} - k.{x})" for x in comps)
    means = ", ".join(f"case when count(s.part) = 0 then any_value(k.{x}) else floor(sum(s.{x}) / count(s.part))::bigint end as {x}" for x in comps)
    return f"""
near{n} as materialized (
  select vec_id, label, part, a, b, c, d, best // 64 as distance, best % 64 as entry
  from (select p.vec_id, p.label, p.part, p.a, p.b, p.c, p.d, min(({distance}) * 64 + k.entry) as best
        from parts p join book{n - 1} k on p.part = k.part group by all)),
book{n} as materialized (
  select k.part, k.entry, {means}
  from book{n - 1} k left join near{n} s on s.part = k.part and s.entry = k.entry group by k.part, k.entry)"""


ORACLE = f"""
with kept as materialized (
  select vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as materialized (
  select vec_id, label, part, v[4 * part + 1] as a, v[4 * part + 2] as b, v[4 * part + 3] as c, v[4 * part + 4] as d
  from kept, unnest(range(16)) as n(part)),
book0 as materialized (
  select part, row_number() over (partition by part order by vec_id) - 1 as entry, a, b, c, d
  from parts where vec_id in (select vec_id from kept order by vec_id limit 64)),
{_round(1)},{_round(2)},{_round(3)},
told as (select sha256(string_agg(concat_ws(',', a, b, c, d), ',' order by part, entry)) as codebooks_sha256 from book2),
codes as (
  select vec_id, any_value(label) as label, string_agg(lpad(lower(hex(entry)), 2, '0'), '' order by part) as code, sum(distance)::bigint as error
  from near3 group by vec_id)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from codes cross join told
"""
