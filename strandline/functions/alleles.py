"""Column functions on contigs, alleles, sequences and annotation strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data model.
BASES = ("A", "C", "G", "T")
PRIMARY_CONTIGS = (*map(str, range(1, 23)), "X", "Y")
FIELDS = ("ALLELE", "SYMBOL", "DS_AG", "DS_AL", "DS_DG", "DS_DL", "DP_AG", "DP_AL", "DP_DG", "DP_DL")
GTF_ATTRIBUTE = r'(\S+)\s+"([^"]*)"'


def attribute_map(text: Column, pattern: str = GTF_ATTRIBUTE) -> Column:
    """map<key, array of its values in order>: a key that is repeated keeps all its values."""
    keys = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
    pairs = F.arrays_zip(keys.alias("k"), values.alias("v"))
    named = F.array_distinct(keys)
    return F.map_from_arrays(named, F.transform(named, lambda key: F.transform(F.filter(pairs, lambda p: p["k"] == key), lambda p: p["v"])))


def attribute_values(text: Column, key: str) -> Column:
    """All values of one attribute in order; empty if it is missing."""
    return F.regexp_extract_all(text, F.lit(rf'(?:^|\s){key}\s+"([^"]*)"'), F.lit(1))


def plain_contig(contig: Column) -> Column:
    return F.regexp_replace(contig, "^chr", "")


def is_primary(contig: Column) -> Column:
    return contig.isin(*PRIMARY_CONTIGS)


def contig_rank(contig: Column) -> Column:
    """1 to 22, X 23, Y 24, M and MT 25, any other 10000."""
    return (
        F.when(contig.rlike("^(?:[1-9]|1[0-9]|2[0-2])$"), F.coalesce(contig.try_cast("int"), F.lit(0)))
        .when(contig == "X", 23)
        .when(contig == "Y", 24)
        .when(contig.isin("M", "MT"), 25)
        .otherwise(10000)
        .cast("int")
    )


def contig_candidates(contig: Column) -> Column:
    """Names that a reference may give an annotation contig: as it is, with or without ``chr``, mitochondrial aliases."""
    other = F.when(contig.startswith("chr"), F.substring(contig, F.lit(4), F.length(contig))).otherwise(F.concat(F.lit("chr"), contig))
    alias = F.when(contig == "MT", F.array(F.lit("M"), F.lit("chrM"))).when(contig.isin("M", "chrM"), F.array(F.lit("MT"), F.lit("chrMT"))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.array(contig, other), alias))


def info_value(info: Column, key: str) -> Column:
    """The first value of an INFO key; empty if it is missing."""
    return F.regexp_extract(info, rf"(?:^|;){key}=([^;]*)", 1)


def without_info(info: Column, key: str) -> Column:
    """INFO without a key and without empty items; ``.`` if nothing is left."""
    left = F.filter(F.split(info, ";"), lambda x: (x != "") & ~x.startswith(f"{key}="))
    return F.when(F.size(left) == 0, F.lit(".")).otherwise(F.array_join(left, ";"))


def with_info(info: Column, key: str, value: Column) -> Column:
    """INFO with a key set; nothing changes where the value is null."""
    bare = without_info(info, key)
    new = F.concat(F.lit(f"{key}="), value)
    return F.when(value.isNull(), info).when(bare == ".", new).otherwise(F.concat_ws(";", bare, new))


def entries(value: Column) -> Column:
    """Annotation entries of exactly ten fields, as arrays of strings, in order."""
    return F.filter(F.transform(F.split(F.coalesce(value, F.lit("")), ","), lambda x: F.split(x, r"\|")), lambda x: F.size(x) == len(FIELDS))


def entry_map(value: Column) -> Column:
    """Entries without repeated (allele, symbol): of equal keys the last one stays, at the place of the first."""
    every = entries(value)
    key = lambda e: F.struct(e[0].alias("alt"), e[1].alias("gene"))
    keys = F.array_distinct(F.transform(every, key))
    return F.transform(keys, lambda k: F.element_at(F.filter(every, lambda e: key(e) == k), -1))


def is_symbolic(alt: Column) -> Column:
    return alt.rlike(r"[.*<>\-]")


def is_block_substitution(ref: Column, alt: Column) -> Column:
    return (F.length(ref) > 1) & (F.length(alt) > 1)


def unscored_entry(alt: Column, gene: Column) -> Column:
    """The entry of a record that has several bases on both sides."""
    return F.concat_ws("|", alt, gene, *([F.lit(".")] * (len(FIELDS) - 2)))


NO_ALTERNATIVE, NO_TRANSCRIPT = "no alternative", "outside transcripts"
UNREADABLE, OTHER_REFERENCE, NEAR_END, LONG_REFERENCE = "unreadable sequence", "another reference base", "context past the contig", "long reference allele"


def skip_reason(has_alts: Column, n_transcripts: Column, window: Column, ref: Column, distance: int, context: int = 10_000) -> Column:
    """Why a record isn't scored, the first reason that applies; null if it is.

    ``window`` is the reference around the position, null if it can't be read.
    """
    width = context + 2 * distance + 1
    return (
        F.when(~has_alts, NO_ALTERNATIVE)
        .when(n_transcripts == 0, NO_TRANSCRIPT)
        .when(window.isNull(), UNREADABLE)
        .when(F.upper(F.substring(window, F.lit(width // 2 + 1), F.length(ref))) != ref, OTHER_REFERENCE)
        .when(F.length(window) != width, NEAR_END)
        .when(F.length(ref) > 2 * distance, LONG_REFERENCE)
    )


def padded_window(window: Column, width: Column, to_start: Column, to_end: Column) -> Column:
    """The window with everything outside the transcript as N.

    ``to_start`` and ``to_end`` are the transcript's first and last base minus
    the position, which is in the middle of the window.
    """
    half = F.floor(width / 2).cast("int")
    left = F.greatest(half + to_start.cast("int"), F.lit(0))
    right = F.greatest(half - to_end.cast("int"), F.lit(0))
    kept = F.greatest(F.length(window) - left - right, F.lit(0))
    return F.concat(F.repeat(F.lit("N"), left), F.substring(window, left + 1, kept), F.repeat(F.lit("N"), right))


def substituted(window: Column, width: Column, ref: Column, alt: Column) -> Column:
    """The window with the reference allele at its middle replaced by the alternative."""
    half = F.floor(width / 2).cast("int")
    return F.concat(F.substring(window, F.lit(1), half), alt, F.substring(window, half + F.length(ref) + 1, F.length(window)))


def reverse_complement(sequence: Column) -> Column:
    return F.reverse(F.translate(sequence, "ACGT", "TGCA"))


def variant_key(chrom: Column, pos: Column, ref: Column, alt: Column) -> Column:
    return F.concat_ws("-", F.concat(F.lit("chr"), plain_contig(chrom)), pos.cast("string"), ref, alt)


def sha256_hex(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def lines_digest(lines: Column) -> Column:
    """sha256 of an array of lines, each closed by a line feed."""
    return F.sha2(F.concat(F.array_join(lines, "\n"), F.lit("\n")).cast("binary"), 256)


def summary_line(**values: Column) -> Column:
    """``name=value`` items parted by spaces."""
    return F.concat_ws(" ", *(F.concat(F.lit(f"{k}="), v.cast("string")) for k, v in values.items()))


REGION = "array<struct<contig:string,reference:string,start:bigint,stop:bigint>>"


def regions_json(regions: Column) -> Column:
    """Regions as a JSON list of lists without spaces."""
    one = lambda r: F.concat(F.lit("["), F.to_json(F.array(r["contig"], r["reference"])).substr(F.lit(2), F.length(F.to_json(F.array(r["contig"], r["reference"]))) - 2), F.lit(","), r["start"].cast("string"), F.lit(","), r["stop"].cast("string"), F.lit("]"))
    return F.concat(F.lit("["), F.array_join(F.transform(regions, one), ","), F.lit("]"))


def parsed_regions(text: Column) -> Column:
    """Regions from JSON; null if the text isn't a list of [name, name, start, stop] with 0 <= start < stop, names being strings."""
    raw = F.from_json(text, "array<array<string>>")
    # a number in a name's place would be read as text: as many items as there are must begin with two quoted ones
    quoted = r'\[\s*"(?:[^"\\]|\\.)*"\s*,\s*"(?:[^"\\]|\\.)*"\s*,'
    good = (F.size(raw) > 0) & (F.size(F.regexp_extract_all(text, F.lit(f"({quoted})"), 1)) == F.size(raw)) & F.forall(raw, lambda r: (F.size(r) == 4) & r[2].rlike(r"^\d{1,18}$") & r[3].rlike(r"^\d{1,18}$"))
    out = F.transform(raw, lambda r: F.struct(r[0].alias("contig"), r[1].alias("reference"), r[2].try_cast("bigint").alias("start"), r[3].try_cast("bigint").alias("stop")))
    return F.when(good & F.forall(out, lambda r: r["start"] < r["stop"]), out)
