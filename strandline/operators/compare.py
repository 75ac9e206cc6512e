"""Differences of annotated records: by position in the file, by entry, and against outside responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.alleles import entry_map, variant_key
from strandline.functions.scores import compared_fields

#: Largest score difference that a gate lets pass, and the score above which a moved position counts.
TOLERANCE = 0.011
TRIVIAL = 0.01
IDENTITY = ("chrom", "pos", "id", "ref", "alt")


def paired_entries(left: Column, right: Column) -> Column:
    """(left entry, right entry) of keys that both sides have."""
    return F.filter(F.transform(left, lambda e: F.struct(e.alias("a"), F.filter(right, lambda o: (o[0] == e[0]) & (o[1] == e[1])).alias("b"))), lambda p: F.size(p["b"]) > 0)


def record_differences(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """One row per record whose identity or annotation differs, paired by line_no.

    Inputs: line_no, chrom, pos, id, ref, alt, annotation. Equal rows leave
    before any annotation is parsed.
    """
    a = baseline.select("line_no", F.struct(*IDENTITY).alias("id_a"), F.col("annotation").alias("text_a"))
    b = candidate.select("line_no", F.struct(*IDENTITY).alias("id_b"), F.col("annotation").alias("text_b"))
    both = a.join(b, "line_no").where((F.col("id_a") != F.col("id_b")) | (F.col("text_a") != F.col("text_b")))
    left, right = F.col("entries_a"), F.col("entries_b")
    pairs = F.col("pairs")
    fields = lambda lo, hi: F.flatten(F.transform(pairs, lambda p: F.transform(F.sequence(F.lit(lo), F.lit(hi)), lambda i: F.struct(F.get(p["a"], i).alias("x"), F.get(p["b"][0], i).alias("y"), F.get(p["a"], i - 4).alias("sx"), F.get(p["b"][0], i - 4).alias("sy")))))
    scores, places = fields(2, 5), fields(6, 9)
    differing = F.filter(scores, lambda f: f["x"] != f["y"])
    moved = F.filter(places, lambda f: f["x"] != f["y"])
    weighty = F.filter(moved, lambda f: (f["sx"] != ".") & (f["sy"] != ".") & (F.greatest(f["sx"].try_cast("double"), f["sy"].try_cast("double")) > TRIVIAL))
    gaps = F.transform(F.filter(differing, lambda f: (f["x"] != ".") & (f["y"] != ".")), lambda f: F.abs(f["x"].try_cast("double") - f["y"].try_cast("double")))
    return (
        both.withColumn("entries_a", entry_map(F.col("text_a")))
        .withColumn("entries_b", entry_map(F.col("text_b")))
        .withColumn("pairs", paired_entries(left, right))
        .select(
            "line_no", "id_a", "id_b", "text_a", "text_b",
            (F.col("id_a") != F.col("id_b")).cast("long").alias("identity_different"),
            (F.col("text_a") != F.col("text_b")).cast("long").alias("annotations_different"),
            (F.size(left) + F.size(right) - 2 * F.size(pairs)).cast("long").alias("entries_missing"),
            F.size(differing).cast("long").alias("score_fields_different"),
            F.coalesce(F.array_max(gaps), F.lit(0.0)).alias("max_score_difference"),
            F.size(moved).cast("long").alias("position_fields_different"),
            F.size(weighty).cast("long").alias("nontrivial_position_fields_different"),
        )
    )


COUNTERS = ("identity_different", "annotations_different", "entries_missing", "score_fields_different", "position_fields_different", "nontrivial_position_fields_different")


def comparison(baseline: DataFrame, candidate: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """One row of counters and whether the gate passes. With different record counts only the identity counter, their gap, is told."""
    sizes = baseline.agg(F.count("*").alias("n_a")).crossJoin(candidate.agg(F.count("*").alias("n_b")))  # one row with one row
    sums = record_differences(baseline, candidate).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS), F.coalesce(F.max("max_score_difference"), F.lit(0.0)).alias("max_score_difference"))
    gap = F.abs(F.col("n_a") - F.col("n_b"))
    told = sizes.crossJoin(sums).select(
        F.col("n_a").alias("records"),
        *(F.when(gap > 0, gap if c == "identity_different" else F.lit(0)).otherwise(F.col(c)).cast("long").alias(c) for c in COUNTERS),
        F.when(gap > 0, F.lit(0.0)).otherwise(F.col("max_score_difference")).alias("max_score_difference"),
    )
    return told.withColumn("passed", (F.col("identity_different") == 0) & (F.col("entries_missing") == 0) & (F.col("max_score_difference") <= tolerance) & (F.col("nontrivial_position_fields_different") == 0))


def entry_differences(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """(line_no, alt, gene, side): entry keys that only one side has."""
    keys = lambda df: df.select("line_no", F.explode(entry_map(F.col("annotation"))).alias("e")).select("line_no", F.col("e")[0].alias("alt"), F.col("e")[1].alias("gene"))
    a, b = keys(baseline).withColumn("in_a", F.lit(1)), keys(candidate).withColumn("in_b", F.lit(1))
    on = ["line_no", "alt", "gene"]
    return a.join(b, on, "full").where("in_a is null or in_b is null").select(*on, F.when(F.col("in_a").isNull(), "candidate").otherwise("baseline").alias("side"))


def local_index(records: DataFrame) -> DataFrame:
    """(variant, gene, entry) of every alternative of every record, entries of ten fields that are about it.

    With ``line_no``, a later record of a variant takes the place of an earlier
    one, genes and all, and of a gene's entries in a record the last stays.
    """
    from strandline.functions.alleles import entries

    spread = records.withColumn("one", F.explode(F.split("alt", ","))).withColumn("variant", variant_key(F.col("chrom"), F.col("pos"), F.col("ref"), F.col("one")))
    ordered = "line_no" in records.columns
    if ordered:
        spread = spread.groupBy("variant").agg(F.max_by(F.struct("one", "annotation"), "line_no").alias("r")).select("variant", "r.*")
    told = spread.select("variant", "one", F.posexplode(entries(F.col("annotation"))).alias("place", "entry")).where(F.col("entry")[0] == F.col("one")).select("variant", F.col("entry")[1].alias("gene"), "place", "entry")
    return told.groupBy("variant", "gene").agg(F.max_by("entry", "place").alias("entry")) if ordered else told.drop("place")


def outside_check(manifest: DataFrame, local: DataFrame, responses: DataFrame, distance: int = 500, mask: int = 1, priority: str = "MS", build: str = "38") -> DataFrame:
    """One row per manifest query (variant, gene): what was found on either side and how its fields differ.

    ``responses``: variant, hg, distance, mask, scores (array of g_name, t_priority,
    DS_* and DP_* as strings). A response matches if exactly one of its scores
    has the gene and the priority.
    """
    fits = F.filter("scores", lambda s: (s["g_name"] == F.col("gene")) & (s["t_priority"] == priority))
    remote = responses.select(F.col("variant").alias("r_variant"), F.col("variant").alias("said"), "hg", "distance", "mask", "scores", F.col("query").alias("asked"))
    own = local.groupBy("variant", "gene").agg(F.max("entry").alias("entry"))
    joined = manifest.join(own, ["variant", "gene"], "left").join(remote, F.col("asked") == F.col("variant"), "left").withColumn("hits", fits)
    hit = F.when(F.size("hits") == 1, F.get("hits", F.lit(0)))
    scores = F.array(*(F.col("hit")[f"DS_{x}"].cast("string") for x in ("AG", "AL", "DG", "DL")))
    places = F.array(*(F.col("hit")[f"DP_{x}"].cast("string") for x in ("AG", "AL", "DG", "DL")))
    same = (F.col("said") == F.col("variant")) & (F.col("hg").cast("string") == build) & (F.col("distance").try_cast("int") == distance) & (F.col("mask").try_cast("int") == mask)
    told = joined.withColumn("hit", hit).withColumn("matched", F.col("hit").isNotNull()).withColumn("parameters", F.coalesce(same, F.lit(False)))
    return told.withColumn("fields", F.when(F.col("entry").isNotNull() & F.col("matched"), compared_fields(F.col("entry"), scores, places))).select(
        "variant", "gene", F.col("entry").isNotNull().alias("local"), "matched", "parameters",
        F.coalesce(F.col("fields.unscored"), F.lit(False)).alias("unscored"),
        (F.col("fields").isNotNull() & ~F.col("fields.unscored")).alias("compared"),
        F.col("fields.score_differences").alias("score_differences"), F.col("fields.place_differences").alias("place_differences"), F.col("fields.largest").alias("largest"),
    )


def outside_summary(checked: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """One row of counters, the reasons why the gate fails, and whether it passes. It fails closed."""
    count = lambda c: F.count(F.when(c, 1))
    told = checked.agg(
        F.count("*").alias("queries"), count(F.coalesce("compared", F.lit(False))).alias("compared"), count(F.col("matched")).alias("matched"), count(F.col("parameters")).alias("parameters"), count(F.col("unscored")).alias("unscored"),
        F.coalesce(F.sum("score_differences"), F.lit(0)).cast("long").alias("score_differences"), F.coalesce(F.sum("place_differences"), F.lit(0)).cast("long").alias("place_differences"), F.coalesce(F.max("largest"), F.lit(0.0)).alias("largest"),
    )
    reasons = F.array_compact(
        F.array(
            F.when(F.col("queries") == 0, "no queries"),
            F.when(F.col("compared") != F.col("queries"), "not all compared"),
            F.when(F.col("matched") != F.col("queries"), "not all matched"),
            F.when(F.col("parameters") != F.col("queries"), "parameters differ"),
            F.when(F.col("largest") > tolerance, "score difference"),
        )
    )
    return told.withColumn("reasons", reasons).withColumn("passed", F.size("reasons") == 0)
