"""Gapless ranks and evenly spread rows, without sorting a table, a stratum or a run of equal values in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.sources import files


def placed(df: DataFrame, strata: list[str], order: list[str], parts: int | None = None) -> DataFrame:
    """Rows with rank_at, their place from 0 within their stratum in ``order``, and rank_length, the rows of the stratum.

    The table is cut into ``parts`` ranges of (strata, order), as many as there are
    shuffle partitions unless given, and written with the number of the range. Ranks
    are taken within (stratum, range) and shifted by the counts of the stratum's
    ranges before: a row for each stratum and for each cut within one. Rows that agree in
    everything are told apart by a number of their own, so they may lie in many ranges.
    Null strata are a stratum, nulls come first in the order, and rows that tie are in
    any order among themselves. An empty table gives an empty result.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tied = df.withColumn("rank_tie", F.monotonically_increasing_id())
    held = files.written(tied.repartitionByRange(parts, *strata, *order, "rank_tie").withColumn("rank_part", F.spark_partition_id()), "ranges")
    counts = held.groupBy(*strata, "rank_part").agg(F.count("*").alias("rank_n"))
    along = Window.partitionBy(*strata)
    before = along.orderBy("rank_part").rowsBetween(Window.unboundedPreceding, -1)
    names = {c: f"rank_of_{c}" for c in (*strata, "rank_part")}
    shifts = counts.select(*(F.col(c).alias(n) for c, n in names.items()), F.coalesce(F.sum("rank_n").over(before), F.lit(0)).alias("rank_shift"), F.sum("rank_n").over(along).alias("rank_length"))
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
    inside = F.row_number().over(Window.partitionBy(*strata, "rank_part").orderBy(*order, "rank_tie")) - 1
    found = held.withColumn("rank_in", inside).join(shifts, same)
    return found.select(*df.columns, (F.col("rank_in") + F.col("rank_shift")).cast("long").alias("rank_at"), F.col("rank_length").cast("long").alias("rank_length"))


def global_rank(df: DataFrame, by: str, order: list[str], name: str = "rank", bins: int | None = None) -> DataFrame:
    """Rows with their place from 0 in (by, *order); ``bins`` ranges are ranked apart."""
    return placed(df, [], [by, *order], bins).drop("rank_length").withColumnRenamed("rank_at", name)


def spread_indexes(length: Column, count: int) -> Column:
    """Indexes of ``count`` rows spread evenly over ``length``: all if there are no more, the middle one if one is asked for.

    i * (length - 1) / (count - 1) is rounded half to even.
    """
    if count < 1:
        raise ValueError(f"{count} rows can't be spread")
    if count == 1:
        some = F.array(F.floor((length - 1) / 2).cast("long"))
    else:
        some = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.bround(i * (length - 1) / F.lit(count - 1), 0).cast("long")))
    every = F.sequence(F.lit(0).cast("long"), (length - 1).cast("long"))
    return F.when(length < 1, F.array().cast("array<bigint>")).when(length <= count, every).otherwise(some)


def spread_kept(index: Column, length: Column, count: int) -> Column:
    """Whether the row at ``index`` of ``length`` is one of ``count`` evenly spread ones, without an array per row."""
    if count < 1:
        raise ValueError(f"{count} rows can't be spread")
    if count == 1:
        return F.when(length <= 1, F.lit(True)).otherwise(index == F.floor((length - 1) / 2))
    step = (length - 1) / F.lit(count - 1)
    near = F.floor(index / step)
    hit = lambda i: (i >= 0) & (i <= count - 1) & (F.bround(i * (length - 1) / F.lit(count - 1), 0) == index)
    return (length <= count) | hit(near) | hit(near + 1) | hit(near - 1)


def stratified(df: DataFrame, strata: list[str], order: list[str], count: int, parts: int | None = None) -> DataFrame:
    """``count`` rows of every stratum, evenly spread over its order. Adds index and length."""
    ranked = placed(df, strata, order, parts).withColumnsRenamed({"rank_at": "index", "rank_length": "length"})
    return ranked.where(spread_kept(F.col("index"), F.col("length"), count))


def evenly(df: DataFrame, by: str, order: list[str], count: int) -> DataFrame:
    """``count`` rows evenly spread over the whole order of a table. Adds rank."""
    ranked = placed(df, [], [by, *order])
    return ranked.where(spread_kept(F.col("rank_at"), F.col("rank_length"), count)).drop("rank_length").withColumnRenamed("rank_at", "rank")
