"""Writers of annotation tables, variant files, plans, manifests and reports.

Tables of any size are written by Spark: one file of ordered lines is put together
from the parts of a sorted table by tasks. Files get their name when they are
complete.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import alleles
from strandline.operators import ranking
from strandline.sources import bgzf, files


def atomically(path: str, chunks: Iterable[bytes]) -> str:
    """Write chunks of a small file under a temporary name, flush to disk, rename; returns the sha256. An old file stays if anything fails."""
    digest = hashlib.sha256()

    def told() -> Iterable[bytes]:
        for chunk in chunks:
            digest.update(chunk)
            yield chunk

    files.write_bytes(path, told())
    return digest.hexdigest()


def write_lines(lines: DataFrame, order: Sequence[str], path: str, header: Iterable[str] = (), span: tuple[Column, Column, Column] | None = None) -> bgzf.Written:
    """The column ``line`` in order as one text file, in compressed blocks if its name ends in .gz; with ``span``, an index beside it."""
    return bgzf.write(lines, order, path, list(header), span)


def record_span() -> tuple[Column, Column, Column]:
    """Contig, start and stop, from 0 and half-open, of the bases of a record (chrom, pos, ref)."""
    start = F.col("pos").cast("long") - 1
    return F.col("chrom"), start, start + F.greatest(F.length("ref"), F.lit(1))


def vcf_line(info: Column | None = None) -> Column:
    """The eight columns of a record as a line."""
    return F.concat_ws("\t", "chrom", F.col("pos").cast("string"), "id", "ref", "alt", "qual", "filter", F.col("info") if info is None else info)


def write_vcf(records: DataFrame, path: str, header: list[str], info_key: str | None = None, description: str = "variant annotation", indexed: bool = False) -> bgzf.Written:
    """Records in the order of line_no, with an index if they are ``indexed`` (in order of contig and position); with ``info_key``, the annotation column (where not null) goes into INFO and its header line is added if it is missing."""
    lines = list(header)
    info = None
    if info_key is not None:
        info = alleles.with_info(F.col("info"), info_key, F.col("annotation"))
        if not any(h.startswith(f"##INFO=<ID={info_key},") for h in lines):
            lines.insert(max(len(lines) - 1, 0), f'##INFO=<ID={info_key},Number=.,Type=String,Description="{description}. Format: {"|".join(alleles.FIELDS)}">')
    return write_lines(records.select("line_no", "chrom", "pos", "ref", vcf_line(info).alias("line")), ["line_no"], path, lines, record_span() if indexed else None)


def write_sample(records: DataFrame, order: list[str], path: str, header: list[str], info_key: str) -> bgzf.Written:
    """Sampled records without an INFO key, nor its header line."""
    kept = [h for h in header if not h.startswith(f"##INFO=<ID={info_key},")]
    return write_lines(records.select(*order, vcf_line(alleles.without_info(F.col("info"), info_key)).alias("line")), order, path, kept)


ANNOTATION_HEADER = "#NAME\tCHROM\tSTRAND\tTX_START\tTX_END\tEXON_START\tEXON_END"


def annotation_line() -> Column:
    """Seven columns; exon lists end in a comma."""
    listed = lambda c: F.concat(F.array_join(F.transform(c, lambda x: x.cast("string")), ","), F.lit(","))
    return F.concat_ws("\t", "name", "contig", "strand", F.col("start").cast("string"), F.col("stop").cast("string"), listed("exon_starts"), listed("exon_stops"))


def write_annotations(annotations: DataFrame, path: str) -> bgzf.Written:
    order = [alleles.contig_rank(F.col("contig")).alias("contig_rank"), "contig", "start", "name"]
    return write_lines(annotations.select(*order, annotation_line().alias("line")), ["contig_rank", "contig", "start", "name"], path, [ANNOTATION_HEADER])


def universe_header(metadata: dict[str, str], kind: str, definition: str, contigs: list[tuple[str, int]]) -> list[str]:
    """Header of a variant universe: where it comes from and how long its contigs are; no score key."""
    told = {"source": "strandline-universe", "reference": metadata["reference"], "universe_kind": kind, "universe_definition": definition} | {k: metadata[k] for k in ("reference_sha256", "annotation_release", "annotation_sha256")}
    lines = ["##fileformat=VCFv4.2", *(f"##{k}={v}" for k, v in told.items()), *(f"##contig=<ID={c},length={n}>" for c, n in contigs)]
    return [*lines, "#" + "\t".join(("CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO"))]


def write_details(differences: DataFrame, path: str) -> None:
    """One tab-separated line per differing record."""
    both = [F.col(f"{side}.{c}").alias(f"{c.upper()}_{name}") for side, name in (("id_a", "BASELINE"), ("id_b", "CANDIDATE")) for c in ("chrom", "pos", "id", "ref", "alt")]
    differences.select("line_no", *both, F.col("text_a").alias("BASELINE"), F.col("text_b").alias("CANDIDATE")).write.mode("overwrite").csv(path, sep="\t", header=True)


def write_report(rows: DataFrame, path: str) -> str:
    """A JSON list of the rows of a small summary table."""
    found = [json.loads(r["line"]) for r in rows.select(F.to_json(F.struct("*")).alias("line")).collect()]
    return atomically(path, [json.dumps(found, indent=2, sort_keys=True).encode() + b"\n"])


def write_results(rows: DataFrame, order: list[str], path: str) -> bgzf.Written:
    """A JSON list of a table of any size, one row a line in ``order``; no row passes the driver.

    Keys are sorted and null fields left out, as in ``write_report``. Without rows the list is empty.
    """
    told = rows.select(*order, F.to_json(F.struct(*sorted(rows.columns))).alias("line"))
    ranked = ranking.placed(told, [], order)
    body = ranked.select(F.lit(0).alias("closing"), "rank_at", F.concat(F.when(F.col("rank_at") == 0, " ").otherwise(","), F.col("line")).alias("line"))
    end = rows.sparkSession.range(1).select(F.lit(1).alias("closing"), F.lit(0).cast("long").alias("rank_at"), F.lit("]").alias("line"))
    return write_lines(body.unionByName(end), ["closing", "rank_at"], path, ["["])


def write_shards(records: DataFrame, path: str, shard: str = "shard_id") -> None:
    """Records of any number as Parquet, a folder for each shard."""
    records.repartition(shard).sortWithinPartitions(shard, "contig", "pos", "ord").write.mode("overwrite").partitionBy(shard).parquet(path)


def metadata_lines(values: dict[str, object]) -> bytes:
    """``key=value`` lines."""
    return "".join(f"{k}={v}\n" for k, v in values.items()).encode()
