"""Transcript annotations from GTF rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import alleles


def assemble(transcripts: DataFrame, exons: DataFrame, order: list[str]) -> DataFrame:
    """``transcripts`` (transcript_id, start, stop, ...) with their distinct exons, sorted, as two arrays.

    Of several rows of one transcript_id the last in ``order`` stays. A
    transcript without exons, or with one outside it, is an error.
    """
    kept = [c for c in transcripts.columns if c not in ("transcript_id", *order)]
    last = transcripts.groupBy("transcript_id").agg(F.max_by(F.struct(*kept), F.struct(*order)).alias("t")).select("transcript_id", "t.*")
    # a transcript has a bounded number of exons; distinct ones are taken before they are gathered
    parts = exons.select("transcript_id", F.col("start").alias("s"), F.col("stop").alias("e")).distinct().groupBy("transcript_id").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("exons"))
    joined = last.join(parts, "transcript_id", "left")
    wrong = F.when(F.col("exons").isNull(), F.lit("has no exons")).when(F.exists("exons", lambda x: (x["s"] < F.col("start")) | (x["e"] > F.col("stop"))), F.lit("has an exon outside it"))
    checked: Column = F.when(wrong.isNotNull(), F.raise_error(F.concat(F.lit("transcript "), F.col("transcript_id"), F.lit(" "), wrong)).cast("array<struct<s:bigint,e:bigint>>")).otherwise(F.col("exons"))
    return joined.withColumn("exons", checked).select("transcript_id", *kept, F.transform("exons", lambda x: x["s"]).alias("exon_starts"), F.transform("exons", lambda x: x["e"]).alias("exon_stops"))


def converted(gtf: DataFrame, tag: str = "MANE_Select", include_nonprimary: bool = False) -> DataFrame:
    """name, contig, strand, start, stop, exon_starts, exon_stops of the tagged transcripts of GTF rows.

    1-based closed coordinates become 0-based half-open ones; contigs lose their
    ``chr``; only transcripts need the tag. A tagged transcript without a gene_name
    is an error.
    """
    one = lambda key: F.get(alleles.attribute_values(F.col("attributes"), key), F.lit(0))
    rows = gtf.select("line_no", "feature", alleles.plain_contig(F.col("contig")).alias("contig"), "strand", (F.col("start") - 1).alias("start"), "stop", "attributes", one("transcript_id").alias("transcript_id"), one("gene_name").alias("gene_name"))
    if not include_nonprimary:
        rows = rows.where(alleles.is_primary(F.col("contig")))
    named = F.when(F.col("gene_name").isNull(), F.raise_error(F.concat(F.lit("transcript without a gene_name: "), F.coalesce("transcript_id", F.lit("?")))).cast("string")).otherwise(F.col("gene_name"))
    tagged = rows.where((F.col("feature") == "transcript") & F.array_contains(alleles.attribute_values(F.col("attributes"), "tag"), tag))
    built = assemble(tagged.select("transcript_id", "line_no", named.alias("name"), "contig", "strand", "start", "stop"), rows.where("feature = 'exon'").select("transcript_id", "start", "stop"), ["line_no"])
    return built.select("name", "contig", "strand", "start", "stop", "exon_starts", "exon_stops")


def summary(annotations: DataFrame) -> DataFrame:
    """One row: transcripts, genes, contigs, exons."""
    return annotations.agg(F.count("*").alias("transcripts"), F.countDistinct("name").alias("genes"), F.countDistinct("contig").alias("contigs"), F.coalesce(F.sum(F.size("exon_starts")), F.lit(0)).cast("long").alias("exons"))
