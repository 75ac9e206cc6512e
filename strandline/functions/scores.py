"""Column functions on prediction arrays: alignment, differences, masking, formatting.

Arrays of one channel (acceptor or donor) are ARRAY<FLOAT>, one element a
position of the covered window of ``cov`` positions, the variant in the middle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def oriented(values: Column, reverse: Column) -> Column:
    """Values in genome order: those of the minus strand are turned round."""
    return F.when(reverse, F.reverse(values)).otherwise(values)


def align_deletion(alt: Column, cov: int, ref_len: Column, alt_len: Column) -> Column:
    """Zeros where the deleted bases were, in double precision."""
    keep = F.lit(cov // 2) + alt_len
    wide = alt.cast("array<double>")
    gap = F.greatest(ref_len - alt_len, F.lit(0)).cast("int")
    return F.concat(F.slice(wide, F.lit(1), keep.cast("int")), F.array_repeat(F.lit(0.0), gap), F.slice(wide, (keep + 1).cast("int"), F.greatest(F.size(wide) - keep, F.lit(0)).cast("int")))


def align_insertion(alt: Column, cov: int, alt_len: Column) -> Column:
    """The inserted positions as one, their largest value; single precision stays."""
    half = cov // 2
    after = F.lit(half) + alt_len
    return F.concat(
        F.slice(alt, F.lit(1), F.lit(half)),
        F.array(F.array_max(F.slice(alt, F.lit(half + 1), alt_len.cast("int")))),
        F.slice(alt, (after + 1).cast("int"), F.greatest(F.size(alt) - after, F.lit(0)).cast("int")),
    )


def difference(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def peak(values: Column) -> Column:
    """(at, value): the first place of the largest value, counted from 0."""
    top = F.array_max(values)
    return F.struct((F.array_position(values, top) - 1).cast("int").alias("at"), top.cast("double").alias("value"))


def two_decimals(value: Column) -> Column:
    """Half-even on the exact binary value, with the sign of a negative zero."""
    return F.format_number(value, 2)


def channel_scores(ref: Column, alt: Column, cov: int, ref_len: Column, alt_len: Column) -> tuple[Column, Column]:
    """Peaks of gain (alt - ref) and loss (ref - alt) of one channel, after the alignment that the lengths ask for.

    Differences are taken in each branch's own precision and widened after that.
    """
    deletion, insertion = (ref_len > 1) & (alt_len == 1), (ref_len == 1) & (alt_len > 1)

    def of(gain: bool) -> Column:
        way = (lambda r, a: difference(a, r)) if gain else difference
        return (
            F.when(deletion, peak(way(ref.cast("array<double>"), align_deletion(alt, cov, ref_len, alt_len))))
            .when(insertion, peak(way(ref, align_insertion(alt, cov, alt_len))))
            .otherwise(peak(way(ref, alt)))
        )

    return of(True), of(False)


def score_entry(alt: Column, gene: Column, acceptor: tuple[Column, Column], donor: tuple[Column, Column], cov: int, exon: Column, mask: bool) -> Column:
    """The ten-field entry of one allele and transcript.

    ``acceptor`` and ``donor``: peaks of gain and loss. With ``mask``, a gain at
    a known boundary and a loss anywhere else count as zero; positions stay.
    """
    values, places = [], []
    for gain, loss in (acceptor, donor):
        for one, is_gain in ((gain, True), (loss, False)):
            at = one["at"] - cov // 2
            hidden = (at == exon) if is_gain else (at != exon)
            value = F.when(hidden, one["value"] * 0).otherwise(one["value"]) if mask else one["value"]
            values.append(two_decimals(value))
            places.append(at.cast("string"))
    return F.concat_ws("|", alt, gene, *values, *places)


def compared_fields(local: Column, remote_scores: Column, remote_places: Column) -> Column:
    """(unscored, score_differences, place_differences, largest) of a ten-field entry against four scores and four places."""
    scores, places = F.slice(local, 3, 4), F.slice(local, 7, 4)
    unscored = F.exists(F.concat(scores, places), lambda x: x == ".")
    gaps = F.zip_with(scores, remote_scores, lambda a, b: F.abs(a.try_cast("double") - b.try_cast("double")))
    moved = F.size(F.filter(F.zip_with(places, remote_places, lambda a, b: a.try_cast("int") != b.try_cast("int")), lambda x: x))
    return F.struct(
        unscored.alias("unscored"),
        F.when(~unscored, F.size(F.filter(gaps, lambda g: g > 0))).alias("score_differences"),
        F.when(~unscored, moved).alias("place_differences"),
        F.when(~unscored, F.array_max(gaps)).alias("largest"),
    )
