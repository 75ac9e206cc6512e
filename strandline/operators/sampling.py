"""Stratified sample of variant records around transcript boundaries, with a quota per gene."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.alleles import PRIMARY_CONTIGS
from strandline.operators.intervals import overlapping
from strandline.operators.ranking import evenly, stratified


def anchor_positions(start: Column, stop: Column, exon_starts: Column, exon_stops: Column) -> Column:
    """Both ends of a transcript with the first, middle and last of its distinct inner exon boundaries, ascending."""
    starts = F.slice(exon_starts, F.lit(2), F.greatest(F.size(exon_starts) - 1, F.lit(0)))
    stops = F.slice(exon_stops, F.lit(1), F.greatest(F.size(exon_stops) - 1, F.lit(0)))
    inner = F.array_sort(F.array_distinct(F.concat(starts, stops)))
    some = F.when(F.size(inner) > 0, F.array(inner[0], inner[F.floor(F.size(inner) / 2).cast("int")], inner[F.size(inner) - 1])).otherwise(F.array().cast("array<bigint>"))
    return F.array_sort(F.array_distinct(F.concat(F.array(start, stop), some)))


def selected_transcripts(annotations: DataFrame, per_stratum: int) -> DataFrame:
    """Evenly spread transcripts of each (contig, strand) of the primary contigs, with their place in the fixed order.

    ``annotations``: name, contig, strand, start, stop, exon_starts, exon_stops.
    """
    known = annotations.where(F.col("contig").isin(*PRIMARY_CONTIGS) & F.col("strand").isin("+", "-"))
    picked = stratified(known, ["contig", "strand"], ["start", "name"], per_stratum)
    place = F.array_position(F.array(*map(F.lit, PRIMARY_CONTIGS)), F.col("contig"))
    # at most 24 contigs x 2 strands x per_stratum rows
    order = Window.orderBy(place, F.when(F.col("strand") == "+", 0).otherwise(1), "index")
    return picked.withColumn("place", F.row_number().over(order))


def greedy(rows: list[tuple], quota: int) -> Iterator[tuple]:
    """Keys taken from candidates (place, gene, first_anchor, anchor, contig, pos, ref, alts), in order.

    A gene's anchors are gone through in turn; a record seen before counts for
    nobody. The quota is looked at after a record is taken and after an anchor's
    window, so a transcript whose gene is full already may still take one record
    of its first window. Genes of one name share their count.
    """
    seen: set[tuple] = set()
    counts: dict[str, int] = {}
    place_now, full_at_start, ended = None, False, False
    for place, gene, first_anchor, anchor, *key in rows:
        if place != place_now:
            place_now, full_at_start, ended = place, counts.get(gene, 0) >= quota, False
        key = tuple(key)
        if ended or key in seen or (full_at_start and anchor != first_anchor):
            continue
        seen.add(key)
        counts[gene] = counts.get(gene, 0) + 1
        ended = counts[gene] >= quota
        yield gene, *key


def components(spans: list[tuple]) -> dict[int, int]:
    """place -> the smallest place of its component, of windows (place, gene, contig, start, stop).

    What a transcript may take depends only on transcripts of its gene name and on
    those whose windows meet its own, so components are sampled apart.
    """
    root = {s[0]: s[0] for s in spans}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def join(a: int, b: int) -> None:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)

    first: dict[str, int] = {}
    for place, gene, *_ in spans:
        join(place, first.setdefault(gene, place))
    far: tuple[str, int, int] | None = None
    for place, _, contig, start, stop in sorted(spans, key=lambda s: s[2:]):
        if far is not None and far[0] == contig and start < far[1]:
            join(place, far[2])
            stop = max(stop, far[1])
        far = (contig, stop, place)
    return {x: find(x) for x in root}


def sample(records: DataFrame, annotations: DataFrame, target: int = 25_000, per_stratum: int = 12, window: int = 750) -> DataFrame:
    """contig, pos, ref, alts, gene of the sample.

    ``records``: contig, pos, ref, alts, and line_no if there is one. A record may
    reach into a window from before it by the length of its reference allele, so
    windows that lie as near as the longest one are of one component. The greedy pass
    of a component runs in one task over the candidates of its transcripts; there are
    at most 24 x 2 x ``per_stratum`` transcripts with five windows each, which is what
    the driver sees.
    """
    if target < 1 or per_stratum < 1:
        raise ValueError("target and per_stratum must be at least 1")
    chosen = selected_transcripts(annotations, per_stratum)
    n = chosen.count()
    if not n:
        raise ValueError("no annotations selected")
    quota = max(1, math.ceil(target / n))
    anchors = anchor_positions(F.col("start"), F.col("stop"), F.col("exon_starts"), F.col("exon_stops"))
    spans = chosen.withColumn("anchors", anchors).select("contig", "place", "name", F.array_min("anchors").alias("first_anchor"), F.explode("anchors").alias("anchor"))
    spans = spans.withColumn("start", F.greatest(F.col("anchor") - window, F.lit(0))).withColumn("stop", F.col("anchor") + window + 1)
    longest = records.agg(F.max(F.length("ref"))).head()[0] or 1
    own = components([(r["place"], r["name"], r["contig"], r["start"] - longest, r["stop"]) for r in spans.collect()])
    grouped = records.sparkSession.createDataFrame(sorted(own.items()), "place int, component int")
    line = F.col("line_no").cast("long") if "line_no" in records.columns else F.lit(0).cast("long")
    found = overlapping(records.select("contig", "pos", "ref", "alts", line.alias("line")), spans)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values(["place", "anchor", "pos", "line", "ref", "alts"])[["place", "gene", "first_anchor", "anchor", "contig", "pos", "ref", "alts"]]
        return pd.DataFrame(greedy(list(rows.itertuples(index=False, name=None)), quota), columns=["gene", "contig", "pos", "ref", "alts"])

    candidates = found.join(F.broadcast(grouped), "place").select("component", "place", F.col("name").alias("gene"), "first_anchor", "anchor", "contig", "pos", "line", "ref", "alts")
    taken = candidates.groupBy("component").applyInPandas(run, "gene string, contig string, pos long, ref string, alts string").select("contig", "pos", "ref", "alts", "gene")
    return taken if taken.count() <= target else evenly_by_contig(taken, target)


def evenly_by_contig(taken: DataFrame, target: int) -> DataFrame:
    """``target`` rows evenly spread over (contig order, pos, ref, alts)."""
    place = F.array_position(F.array(*map(F.lit, PRIMARY_CONTIGS)), F.col("contig")).cast("double") * F.lit(1e12) + F.col("pos")
    return evenly(taken.withColumn("sort_place", place), "sort_place", ["ref", "alts"], target).drop("sort_place", "rank")
