"""Command lines: score, run, compare, check, sample, convert, runtime, plan, generate, finalize."""

from __future__ import annotations

import argparse
import importlib
import json
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline import __version__
from strandline.operators import compare, environment, sampling, scoring, transcripts
from strandline.plans import runner, shards
from strandline.sources import bgzf, readers, writers

INFO_KEY = "DELTA"


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="strandline")
    top.add_argument("--version", action="version", version=__version__)
    sub = top.add_subparsers(dest="command", required=True)

    def add(name: str, *flags: tuple[tuple[str, ...], dict]) -> None:
        one = sub.add_parser(name)
        one.add_argument("--info-key", default=INFO_KEY, help="INFO key of annotations")
        for names, options in flags:
            one.add_argument(*names, **options)

    need = {"required": True}
    add("score", (("-I", "--input"), need), (("-O", "--output"), need), (("-R", "--reference"), need), (("-A", "--annotation"), need), (("-D", "--distance"), {"type": int, "default": 50}), (("-M", "--mask"), {"type": int, "choices": (0, 1), "default": 0}), (("--batch-size",), {"type": int, "default": 16}), (("--chunk-records",), {"type": int, "default": 2048, "help": "records of an Arrow batch"}), (("--models",), {"default": "strandline.plans.demo:models", "help": "module:function that loads the models"}))
    add("compare", (("baseline",), {}), (("candidates",), {"nargs": "+"}), (("--json",), {}), (("--details-dir",), {}), (("--max-score-difference",), {"type": float, "default": compare.TOLERANCE}))
    add("check", (("--vcf",), need), (("--manifest",), need), (("--responses",), need | {"help": "folder of cached responses"}), (("--output-dir",), need), (("--distance",), {"type": int, "default": 500}), (("--mask",), {"type": int, "default": 1}))
    add("sample", (("--input",), need), (("--annotation",), need), (("--output",), need), (("--target-records",), {"type": int, "default": 25_000}), (("--genes-per-stratum",), {"type": int, "default": 12}), (("--window",), {"type": int, "default": 750}))
    add("convert", (("--input",), need), (("--output",), need), (("--include-nonprimary",), {"action": "store_true"}))
    add("runtime", (("--output",), {}), (("--resources",), {"nargs": "*", "default": []}), (("--workers",), {"action": "store_true", "help": "refuse workers that differ from the driver"}))
    add("plan", (("--annotation",), need), (("--reference",), need), (("--output",), need), (("--target-records",), {"type": int, "default": 1_000_000}), (("--kind",), {"choices": ("snv", "indel", "both"), "default": "both"}), (("--annotation-release",), {"default": "unknown"}), (("--annotation-sha256",), {}), (("--reference-sha256",), {}))
    add("generate", (("--plan",), need), (("--task-id",), need | {"type": int}), (("--last-task-id",), {"type": int, "help": "go on to this task"}), (("--output-dir",), need), (("--reference",), {}), (("--reference-sha256",), {}), (("--concurrency",), {"type": int, "default": 1, "help": "shards made at a time"}), (("--threads",), {"type": int, "help": "tasks that compress a shard"}))
    add("run", (("--manifest",), need), (("--output-dir",), need), (("--reference",), need), (("--annotation",), need), (("--distance",), {"type": int, "default": 500}), (("--mask",), {"type": int, "choices": (0, 1), "default": 1}), (("--batch-size",), {"type": int, "default": 256}), (("--chunk-records",), {"type": int, "default": 4096}), (("--models",), {"default": "strandline.plans.demo:models"}), (("--first-task",), {"type": int, "default": 1}), (("--last-task",), {"type": int}), (("--concurrency",), {"type": int, "default": 1, "help": "shards scored at a time"}))
    add("finalize", (("--plan",), need), (("--input-dir",), need), (("--output",), need), (("--verify-checksums",), {"action": "store_true"}))
    return top


def header_of(spark: SparkSession, path: str) -> list[str]:
    return [r["value"] for r in readers.vcf_header(spark, path).orderBy("line_no").collect()]


def score(spark: SparkSession, a: argparse.Namespace) -> int:
    if a.chunk_records < 1:
        raise ValueError("chunk-records must be positive")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(a.chunk_records))
    module, _, name = a.models.partition(":")
    began = time.monotonic()
    wrote = scored_file(spark, a.input, a.output, a.reference, a.annotation, getattr(importlib.import_module(module), name), a.distance, bool(a.mask), a.batch_size, a.info_key)
    took = time.monotonic() - began
    print(f"processed={wrote.lines} elapsed_seconds={took:.1f} variants_per_second={wrote.lines / took:.2f}")
    return 0


def scored_file(spark: SparkSession, source: str, target: str, reference: str, annotation: str, load, distance: int, mask: bool, batch_size: int, info_key: str = INFO_KEY, indexed: bool = False) -> bgzf.Written:
    """The records of a file with their annotations, in the order of the file."""
    records = readers.vcf(spark, source, info_key)
    tx = scoring.numbered_transcripts(readers.annotations(spark, annotation))
    blocks = readers.fasta(spark, reference)
    # one name for each contig: that of the reference
    names = records.select(F.col("chrom").alias("contig")).union(tx.select("contig")).distinct()
    from strandline.operators.intervals import resolve_contigs

    known = resolve_contigs(names, readers.contigs(blocks).select(F.col("contig").alias("reference"))).select("contig", "reference")
    called = lambda df: df.join(F.broadcast(known), "contig", "left").withColumn("contig", F.coalesce("reference", "contig")).drop("reference")  # noqa: E731  contigs are few
    own = called(records.select("line_no", F.col("chrom").alias("contig"), F.col("pos").cast("long").alias("pos"), "ref", F.when(F.col("alt") != ".", F.split("alt", ",")).otherwise(F.array().cast("array<string>")).alias("alts")))
    told = scoring.annotate(own, called(tx), blocks, load, distance, mask, batch_size)
    out = records.drop("annotation").join(told.select("line_no", "annotation"), "line_no", "left")
    return writers.write_vcf(out, target, header_of(spark, source), info_key, indexed=indexed)


def run(spark: SparkSession, a: argparse.Namespace) -> int:
    settings = runner.Settings(a.reference, a.annotation, a.distance, bool(a.mask), a.batch_size, a.chunk_records, a.models, a.info_key)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(a.chunk_records))
    module, _, name = a.models.partition(":")
    load = getattr(importlib.import_module(module), name)
    environment.agree(spark)
    scored = lambda source, target: scored_file(spark, source, target, a.reference, a.annotation, load, a.distance, bool(a.mask), a.batch_size, a.info_key, indexed=True).lines
    print(runner.run(spark, a.manifest, a.output_dir, settings, scored, a.first_task, a.last_task, a.concurrency))
    return 0


def differ(spark: SparkSession, a: argparse.Namespace) -> int:
    reports: DataFrame | None = None
    base = readers.vcf(spark, a.baseline, a.info_key)
    for path in a.candidates:
        other = readers.vcf(spark, path, a.info_key)
        one = compare.comparison(base, other, a.max_score_difference).withColumn("candidate", F.lit(path))
        reports = one if reports is None else reports.unionByName(one)
        if a.details_dir and base.count() == other.count():  # rows of unequal files don't pair
            writers.write_details(compare.record_differences(base, other), str(Path(a.details_dir) / Path(path).name))
    rows = reports.collect()
    for r in rows:
        print(" ".join(f"{k}={v}" for k, v in r.asDict().items()))
    if a.json:
        writers.write_report(reports, a.json)
    return int(not all(r["passed"] for r in rows))


def check(spark: SparkSession, a: argparse.Namespace) -> int:
    local = compare.local_index(readers.vcf(spark, a.vcf, a.info_key))
    told = compare.outside_check(readers.manifest(spark, a.manifest).select("variant", "gene"), local, readers.responses(spark, a.responses), a.distance, a.mask)
    summary = compare.outside_summary(told)
    writers.write_results(told, ["variant", "gene"], str(Path(a.output_dir) / "results.json"))
    writers.write_report(summary, str(Path(a.output_dir) / "summary.json"))
    return int(not summary.head()["passed"])


def sample(spark: SparkSession, a: argparse.Namespace) -> int:
    records = readers.vcf(spark, a.input, a.info_key)
    own = records.select("line_no", F.col("chrom").alias("contig"), F.col("pos").cast("long").alias("pos"), "ref", F.col("alt").alias("alts"))
    taken = sampling.sample(own, readers.annotations(spark, a.annotation), a.target_records, a.genes_per_stratum, a.window)
    first = records.withColumn("pos", F.col("pos").cast("long")).groupBy("chrom", "pos", "ref", "alt").agg(F.min_by(F.struct("id", "qual", "filter", "info"), "line_no").alias("r"))
    full = taken.select(F.col("contig").alias("chrom"), "pos", "ref", F.col("alts").alias("alt")).join(first, ["chrom", "pos", "ref", "alt"]).select("chrom", "pos", "ref", "alt", "r.*")
    header = header_of(spark, a.input)
    order = [h.split("ID=")[1].split(",")[0].rstrip(">") for h in header if h.startswith("##contig=<ID=")]
    placed = full.withColumn("place", F.array_position(F.array(*map(F.lit, order)).cast("array<string>"), F.col("chrom")))
    writers.write_sample(placed, ["place", "pos", "ref", "alt"], a.output, header, a.info_key)
    print(" ".join(f"{k}={v}" for k, v in full.agg(F.count("*").alias("records"), F.countDistinct("chrom").alias("contigs")).head().asDict().items()))
    return 0


def convert(spark: SparkSession, a: argparse.Namespace) -> int:
    found = transcripts.converted(readers.gtf(spark, a.input), include_nonprimary=a.include_nonprimary)
    writers.write_annotations(found, a.output)
    print(" ".join(f"{k}={v}" for k, v in transcripts.summary(found).head().asDict().items()))
    return 0


def runtime(spark: SparkSession, a: argparse.Namespace) -> int:
    files = [r.asDict() for p in a.resources for r in readers.resources(spark, p).orderBy("path").collect()]
    told = environment.manifest(spark, files, a.workers)
    if a.output:
        writers.atomically(a.output, [json.dumps(told, indent=2, sort_keys=True).encode() + b"\n"])
    else:
        print(json.dumps(told, indent=2, sort_keys=True))
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("strandline").getOrCreate()
    if a.command == "plan":
        kinds = ("snv", "indel") if a.kind == "both" else (a.kind,)
        print(shards.write_plan(spark, a.annotation, a.reference, a.output, a.target_records, kinds, a.annotation_release, a.annotation_sha256, a.reference_sha256))
        return 0
    if a.command == "generate":
        for told in shards.generate_range(spark, a.plan, a.task_id, a.last_task_id or a.task_id, a.output_dir, a.reference, a.reference_sha256, a.concurrency, a.threads):
            print(told)
        return 0
    if a.command == "finalize":
        print(shards.finalize(spark, a.plan, a.input_dir, a.output, a.verify_checksums))
        return 0
    return {"score": score, "run": run, "compare": differ, "check": check, "sample": sample, "convert": convert, "runtime": runtime}[a.command](spark, a)


if __name__ == "__main__":
    sys.exit(main())
