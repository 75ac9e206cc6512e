"""Helpers shared by the corpus operators: tables, shared folder, numbering."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the data folder; also tells Python workers where this package is."""
    at_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def at_workers(spark: SparkSession) -> None:
    """Put the folder that holds this package on the Python path of the workers.

    On a cluster the package is installed on every node or shipped with
    ``--py-files``; this line only serves sessions started elsewhere on the
    same machine.
    """
    here = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if here not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (here, env.get("PYTHONPATH", "")) if x)


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only in a local session that doesn't set it."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = Path(tempfile.mkdtemp(prefix="strandline-")).as_uri()
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: its lineage ends here."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that nothing reads any more."""
    for table in tables:
        jvm = table.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(table._written_to)
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files and broadcasts of plans that are done with.

    Spark frees them when the driver's garbage is collected, which in a short
    run of many small jobs may be never; so they would pile up on the disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: The largest long stands for an id that isn't known: it comes after all others.
UNKNOWN = 2**63 - 1


def label_of(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(UNKNOWN))


def text_key(text: Column) -> Column:
    """Sixteen bytes that tell texts of one doc_id apart; a null text counts as empty."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def rows_of(docs: DataFrame, keys: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that ``keys`` (label, key; no pair twice) names by id and text.

    A row is known by what it holds, not by its place, so that any number of
    tasks may read the table anew. Of rows that agree in both, one is returned.
    """
    label, key, place = fresh(docs, "label", "key", "place")
    tagged = docs.withColumn(label, label_of(F.col(id_col))).withColumn(key, text_key(F.col(text_col)))
    found = tagged.join(keys.select(F.col("label").alias(label), F.col("key").alias(key)), [label, key], "left_semi")
    # rows of a pair are in one partition already, in order
    return found.withColumn(place, F.row_number().over(Window.partitionBy(label, key).orderBy(label))).where(F.col(place) == 1).drop(label, key, place)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have yet, one for each of ``names``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves no remainder by 5; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def numbered(df: DataFrame, key: str, order: list[str], number: str, weight: str | None = None, parts: int | None = None) -> DataFrame:
    """Gapless positions from 0 within ``key``, or running starts of ``weight``, without one task per key.

    Rows of a key are dealt over ``parts`` sub-groups by a hash of ``order``
    (the number of shuffle partitions, 64 at least, unless given). Each sub-group is numbered alone; the offsets of the sub-groups come from
    one small table of at most (keys x parts) sums. A key that holds a third
    of all rows is spread over ``parts`` tasks. Ties in ``order`` are numbered
    in any order among themselves.
    """
    sub, add, base = fresh(df, "sub", "add", "base")
    parts = parts or max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    amount = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    dealt = df.withColumn(sub, F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int")).withColumn(add, amount)
    inside = Window.partitionBy(key, sub).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy(key, sub).agg(F.sum(add).alias(add))
    before = Window.partitionBy(key).orderBy(sub).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col(key).alias(f"{base}_key"), F.col(sub).alias(f"{base}_sub"), F.coalesce(F.sum(add).over(before), F.lit(0)).cast("long").alias(base))
    return (
        dealt.withColumn(number, F.coalesce(F.sum(add).over(inside), F.lit(0)).cast("long"))
        .join(offsets, (F.col(key) == F.col(f"{base}_key")) & (F.col(sub) == F.col(f"{base}_sub")))
        .withColumn(number, F.col(number) + F.col(base))
        .drop(sub, add, base, f"{base}_key", f"{base}_sub")
    )
