"""All small variants over reference bases: substitutions, one-base insertions, deletions of one to four bases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions.alleles import BASES

#: Records that one unambiguous base stands for.
RECORDS_PER_BASE = {"snv": 3, "indel": 8}
LONGEST_DELETION = 4


#: Bases in the pieces that a sequence is cut into, coarse first: reading a place in a string costs its distance from the start.
PIECES = (4096, 64)


def anchors(sequences: DataFrame) -> DataFrame:
    """One row per unambiguous base of ``sequences`` (contig, start, stop, sequence).

    ``sequence`` begins at ``start`` and may go on past ``stop``, so that
    deletions at the end can be spelt; anchors lie within [start, stop) only.
    Yields contig, pos (1-based), anchor and the bases after it, "." for what is
    none of the four.
    """
    inside = F.least(F.length("sequence"), (F.col("stop") - F.col("start")).cast("int"))
    rows = sequences.select("contig", F.col("start").cast("long").alias("start"), F.regexp_replace(F.upper("sequence"), "[^ACGT]", ".").alias("bases"), inside.alias("inside")).where("inside > 0")
    for size in PIECES:
        # a base becomes up to eight rows: pieces of long sequences, and of few files, are dealt over all tasks before
        rows = rows if size == PIECES[0] else rows.repartition("contig", "start")
        cut = rows.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("inside") - 1, F.lit(size))))
        rows = cut.select("contig", (F.col("start") + F.col("at")).alias("start"), F.substring("bases", F.col("at") + 1, F.lit(size + LONGEST_DELETION)).alias("bases"), F.least(F.col("inside") - F.col("at"), F.lit(size)).alias("inside"))
    spread = rows.select("contig", "start", "bases", F.posexplode(F.split(F.substring("bases", F.lit(1), F.col("inside")), "")).alias("i", "anchor"))
    return spread.where(F.col("anchor").isin(*BASES)).select("contig", (F.col("start") + F.col("i") + 1).cast("long").alias("pos"), "anchor", F.substring("bases", F.col("i") + 2, F.lit(LONGEST_DELETION)).alias("after"))


def substitutions(found: DataFrame) -> DataFrame:
    """contig, pos, ord, ref, alt: the three other bases in alphabetical order."""
    other = F.coalesce(*(F.when(F.col("anchor") == b, F.array(*(F.lit(x) for x in BASES if x != b))) for b in BASES))
    return found.select("contig", "pos", F.col("anchor").alias("ref"), F.posexplode(other).alias("ord", "alt")).select("contig", "pos", "ord", "ref", "alt")


def insertions(found: DataFrame) -> DataFrame:
    """contig, pos, ord, ref, alt: one base put in after the anchor, in alphabetical order."""
    return found.select("contig", "pos", F.col("anchor").alias("ref"), F.posexplode(F.array(*map(F.lit, BASES))).alias("ord", "base")).select("contig", "pos", "ord", "ref", F.concat("ref", "base").alias("alt"))


def deletions(found: DataFrame) -> DataFrame:
    """contig, pos, ord, ref, alt: one to four bases after the anchor taken out, where all of them are known."""
    unknown = F.instr("after", ".")
    known = F.when(unknown > 0, unknown - 1).otherwise(F.length("after"))
    return (
        found.select("contig", "pos", "anchor", F.concat("anchor", "after").alias("spelt"), known.alias("known"))
        .where("known > 0")
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("known"))))
        .select("contig", "pos", (F.col("k") + len(BASES) - 1).alias("ord"), F.substring("spelt", F.lit(1), F.col("k") + 1).alias("ref"), F.col("anchor").alias("alt"))
    )


def records(sequences: DataFrame, kind: str) -> DataFrame:
    """contig, pos, ord, ref, alt of all records of a kind; (contig, pos, ord) is the order of emission."""
    if kind not in RECORDS_PER_BASE:
        raise ValueError(f"unknown kind {kind!r}")
    found = anchors(sequences)
    return substitutions(found) if kind == "snv" else insertions(found).unionByName(deletions(found))
