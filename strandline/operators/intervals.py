"""Half-open intervals by contig: union, capacity tiles, stabbing, nearest boundary.

Contigs are few and long, so nothing here orders a whole contig's raw rows in
one task: work is done in bins of positions first, and only what bins leave
(islands, extremes, counts) is put in order by contig.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.sources import files

#: Positions in a bin of a first pass.
BIN = 1 << 16


def _islands(rows: DataFrame, *by: str) -> DataFrame:
    """Touching or overlapping intervals of each group as one."""
    order = Window.partitionBy(*by).orderBy("start", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = rows.withColumn("opens", F.when(F.col("start") <= reach, 0).otherwise(1))
    numbered = marked.withColumn("island", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*by, "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("island")


def union(intervals: DataFrame, bin_size: int = BIN) -> DataFrame:
    """(contig, start, stop) of the islands of ``intervals``.

    Islands are made within bins of starts, which hold no more distinct starts than
    positions. A bin tells how far it reaches and where its last island begins; along
    the bins of a contig, the reach of those before says which islands go on with an
    earlier one, and the last of those that don't is where that one begins. So the
    only order of a whole contig is that of one row a bin.
    """
    valid = intervals.select("contig", F.col("start").cast("long"), F.col("stop").cast("long")).where("start >= 0 and stop > start").groupBy("contig", "start").agg(F.max("stop").alias("stop"))
    local = files.written(_islands(valid.withColumn("bin", F.floor(F.col("start") / bin_size)), "contig", "bin"), "bin-islands")
    before = Window.partitionBy("contig").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = local.groupBy("contig", "bin").agg(F.max("stop").alias("far"), F.max("start").alias("final")).withColumn("reach", F.max("far").over(before))
    # the last island of a bin begins a new one if any of the bin does
    begun = bins.withColumn("begun", F.when(F.col("reach").isNull() | (F.col("final") > F.col("reach")), F.col("final")))
    known = begun.select("contig", "bin", "reach", F.last("begun", True).over(before).alias("earlier"))
    inside = Window.partitionBy("contig", "bin").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    opens = F.when(F.col("reach").isNull() | (F.col("start") > F.col("reach")), F.col("start"))
    named = local.join(known, ["contig", "bin"]).withColumn("first", F.coalesce(F.last(opens, True).over(inside), F.col("earlier")))
    return named.groupBy("contig", "first").agg(F.max("stop").alias("stop")).select("contig", F.col("first").alias("start"), "stop")


def tiles(islands: DataFrame, capacity: int, bin_size: int = BIN) -> DataFrame:
    """(contig, tile, start, stop): islands cut so that each tile of a contig holds ``capacity`` bases, the last what is left.

    Bases before an island are those of the bins of starts before its own, one row a
    bin, and those before it in its bin.
    """
    size = F.col("stop") - F.col("start")
    binned = files.written(islands.withColumn("bin", F.floor(F.col("start") / bin_size)), "islands")
    before = Window.partitionBy("contig").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = binned.groupBy("contig", "bin").agg(F.sum(size).alias("bases")).select("contig", "bin", F.coalesce(F.sum("bases").over(before), F.lit(0)).alias("earlier"))
    inside = Window.partitionBy("contig", "bin").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    laid = binned.join(sums, ["contig", "bin"]).withColumn("at", (F.col("earlier") + F.coalesce(F.sum(size).over(inside), F.lit(0))).cast("long"))
    first, last = F.floor(F.col("at") / capacity), F.floor((F.col("at") + size - 1) / capacity)
    cut = laid.withColumn("tile", F.explode(F.sequence(first, last)))
    a = F.greatest(F.col("at"), F.col("tile") * capacity)
    b = F.least(F.col("at") + size, (F.col("tile") + 1) * capacity)
    return cut.select("contig", F.col("tile").cast("long").alias("tile"), (F.col("start") + a - F.col("at")).cast("long").alias("start"), (F.col("start") + b - F.col("at")).cast("long").alias("stop"))


def stab(points: DataFrame, intervals: DataFrame, bin_size: int = 1 << 12) -> DataFrame:
    """``points`` (contig, pos, ...) with every interval (contig, start, stop, ...) where start < pos <= stop.

    An equi-join on (contig, bin): an interval is copied to each bin it covers.
    """
    spread = intervals.withColumn("bin", F.explode(F.sequence(F.floor((F.col("start") + 1) / bin_size), F.floor(F.col("stop") / bin_size))))
    keyed = points.withColumn("bin", F.floor(F.col("pos") / bin_size))
    return keyed.join(spread, ["contig", "bin"]).where("start < pos and pos <= stop").drop("bin")


def overlapping(records: DataFrame, spans: DataFrame, bin_size: int = 1 << 12) -> DataFrame:
    """Records (contig, pos, ref, ...) whose bases meet a span (contig, start, stop, ...), half-open and 0-based.

    Records reach over length(ref) bases, so a deletion from before the span is found as well.
    """
    ends = F.col("pos") - 1 + F.greatest(F.length("ref"), F.lit(1))
    held = records.withColumn("rec_stop", ends).withColumn("bin", F.explode(F.sequence(F.floor((F.col("pos") - 1) / bin_size), F.floor((ends - 1) / bin_size))))
    spread = spans.where("stop > start").withColumn("bin", F.explode(F.sequence(F.floor(F.col("start") / bin_size), F.floor((F.col("stop") - 1) / bin_size))))
    # a pair that shares several bins is taken in the first of them
    first = F.greatest(F.floor((F.col("pos") - 1) / bin_size), F.floor(F.col("start") / bin_size))
    return held.join(spread, ["contig", "bin"]).where((F.col("pos") - 1 < F.col("stop")) & (F.col("rec_stop") > F.col("start")) & (F.col("bin") == first)).drop("bin", "rec_stop")


def nearest(points: DataFrame, boundaries: DataFrame, bin_size: int = BIN) -> DataFrame:
    """(contig, pos, boundary, distance) of distinct points: the nearest boundary, the smaller of two, as boundary - pos.

    Neighbours come from the point's own bin, or from the extremes of the bins
    around it; contigs without boundaries give nulls.
    """
    bin_of = lambda c: F.floor(F.col(c) / bin_size)
    marks = boundaries.select("contig", F.col("boundary").cast("long").alias("boundary")).distinct()
    spots = points.select("contig", F.col("pos").cast("long").alias("pos")).distinct()
    both = spots.select("contig", "pos", F.lit(None).cast("long").alias("boundary")).unionByName(marks.select("contig", F.col("boundary").alias("pos"), "boundary")).withColumn("bin", bin_of("pos"))
    inside = Window.partitionBy("contig", "bin").orderBy("pos")
    seen = both.withColumn("below", F.last("boundary", True).over(inside.rangeBetween(Window.unboundedPreceding, 0))).withColumn("above", F.first("boundary", True).over(inside.rangeBetween(0, Window.unboundedFollowing))).where("boundary is null")
    bins = both.groupBy("contig", "bin").agg(F.min("boundary").alias("low"), F.max("boundary").alias("high"))
    along = Window.partitionBy("contig").orderBy("bin")
    around = bins.select(
        "contig", "bin",
        F.last("high", True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"),
        F.first("low", True).over(along.rowsBetween(1, Window.unboundedFollowing)).alias("later"),
    )
    found = seen.join(around, ["contig", "bin"]).withColumn("below", F.coalesce("below", "earlier")).withColumn("above", F.coalesce("above", "later"))
    best = F.when(F.col("below").isNull(), F.col("above")).when(F.col("above").isNull() | (F.col("pos") - F.col("below") <= F.col("above") - F.col("pos")), F.col("below")).otherwise(F.col("above"))
    return found.select("contig", "pos", best.alias("boundary"), (best - F.col("pos")).alias("distance"))


def nearest_of(boundaries: Column, pos: Column) -> Column:
    """The signed distance to the nearest of a short array of boundaries, the smaller coordinate of two."""
    return F.array_min(F.transform(boundaries, lambda b: F.struct(F.abs(b - pos).alias("far"), b.alias("at"))))["at"] - pos


def resolve_contigs(names: DataFrame, references: DataFrame) -> DataFrame:
    """(contig, matches, reference): the only reference contig that a name may mean; null unless there is exactly one."""
    from strandline.functions.alleles import contig_candidates

    wanted = names.select("contig").distinct().withColumn("reference", F.explode(contig_candidates(F.col("contig"))))
    hits = wanted.join(references.select("reference").distinct(), "reference", "left_semi").groupBy("contig").agg(F.count("*").alias("matches"), F.first("reference").alias("reference"))
    return names.select("contig").distinct().join(hits, "contig", "left").select("contig", F.coalesce("matches", F.lit(0)).cast("long").alias("matches"), F.when(F.col("matches") == 1, F.col("reference")).alias("reference"))
