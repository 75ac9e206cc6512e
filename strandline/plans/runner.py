"""Scoring of the shards of a manifest, restartable at any point.

A shard is claimed if no marker tells that it is complete with the fingerprint of
this run; its file and index are written under other names and renamed; its
records are compared with those of its input; its metadata is written, and its
marker last. Whatever stops a run, the next one finds shards complete or does them
again; none is lost and none that is complete is scored twice.
"""

from __future__ import annotations

import datetime
import hashlib
import platform
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import strandline
from strandline.operators import scoring
from strandline.plans import jobs, shards
from strandline.sources import files, readers, writers

FORMAT = 3


@dataclass(frozen=True)
class Settings:
    reference: str
    annotation: str
    distance: int = 50
    mask: bool = False
    batch_size: int = 16
    chunk_records: int = 2048
    models: str = "strandline.plans.demo:models"
    info_key: str = "DELTA"

    def __post_init__(self):
        if not 0 <= self.distance < scoring.CONTEXT // 2:
            raise ValueError(f"distance must lie in 0..{scoring.CONTEXT // 2 - 1}")
        if self.batch_size < 1 or self.chunk_records < 1:
            raise ValueError("batch size and chunk records must be positive")


def code_digest() -> str:
    """sha256 over the digests of this package's files, by path."""
    root = Path(strandline.__file__).parent
    own = sorted(p.relative_to(root).as_posix() for p in root.rglob("*.py") if p.relative_to(root).parts[0] != "llm")
    lines = "".join(f"{files.sha256_of(str(root / p))}  ./{p}\n" for p in own)
    return hashlib.sha256(lines.encode()).hexdigest()


def tasks_of(spark: SparkSession, manifest: str, first: int = 1, last: int | None = None) -> DataFrame:
    """task, shard_id, input_vcf and the given input_sha256 (null if the manifest has none) of a range of a manifest."""
    c = F.split("value", "\t")
    rows = readers.task_range(spark, manifest, first, last)
    named = F.when((F.size(c) >= 2) & (F.trim(c[0]) != "") & (F.trim(F.get(c, F.lit(1))) != ""), c).otherwise(F.raise_error(F.concat(F.lit(f"{manifest}: task "), F.col("task").cast("string"), F.lit(" needs a shard id and an input"))).cast("array<string>"))
    return rows.withColumn("c", named).select("task", F.col("c")[0].alias("shard_id"), F.col("c")[1].alias("input_vcf"), F.nullif(F.trim(F.get("c", F.lit(2))), F.lit("")).alias("input_sha256"))


def claimed(spark: SparkSession, tasks: DataFrame, out_dir: str, values: dict[str, object]) -> tuple[list[dict], list[dict]]:
    """(pending, complete) tasks, each with the digest of its input and its fingerprint.

    A given digest of an input that isn't the file's is an error. A shard is
    complete if its marker has its name and fingerprint, and file and index are
    there with the marker's digest.
    """
    rows = [r.asDict() for r in tasks.orderBy("task").collect()]  # one row a shard
    if len({r["shard_id"] for r in rows}) < len(rows):
        raise ValueError("a shard is listed twice")
    markers: dict[str, list[str]] = {}
    for r in rows:
        path = f"{out_dir}/{r['shard_id']}"
        if files.size_of(f"{path}.complete") and files.size_of(f"{path}.vcf.gz") and files.size_of(f"{path}.vcf.gz.tbi"):
            markers[r["shard_id"]] = files.read_text(f"{path}.complete").rstrip("\n").split("\t")
    paths = {r["input_vcf"] for r in rows} | {f"{out_dir}/{s}.vcf.gz" for s in markers}
    digests = {p: sha for p, (_, sha) in files.digests_of(spark, list(paths)).items()}
    pending, complete = [], []
    for r in rows:
        found = digests[r["input_vcf"]]
        if found is None:
            raise ValueError(f"{r['input_vcf']}: no such file")
        if r["input_sha256"] is not None and r["input_sha256"].lower() != found:
            raise ValueError(f"checksum of {r['input_vcf']} is {found} and should be {r['input_sha256'].lower()}")
        r["input_sha256"] = found
        r["fingerprint"] = shards.run_fingerprint({"format_version": FORMAT, "shard_id": r["shard_id"], "input_sha256": found} | values)
        marker = markers.get(r["shard_id"], [])
        fine = len(marker) == 5 and marker[0] == r["shard_id"] and marker[2].isdigit() and marker[3] == digests[f"{out_dir}/{r['shard_id']}.vcf.gz"] and marker[4] == r["fingerprint"]
        (complete if fine else pending).append(r | ({"records": int(marker[2])} if fine else {}))
    return pending, complete


def run(spark: SparkSession, manifest: str, out_dir: str, settings: Settings, score: Callable[[str, str], int], first: int = 1, last: int | None = None, concurrency: int = 1) -> dict[str, int]:
    """Score the shards ``first`` to ``last`` of a manifest that aren't complete, at most ``concurrency`` at a time; returns counts.

    ``score`` (input, output) writes a file with its index and returns its records.
    """
    assets = shards.checked(spark, {settings.reference: None, settings.annotation: None})
    values = {"reference_sha256": assets[settings.reference], "annotation_sha256": assets[settings.annotation], "code_sha256": code_digest(), "spark": spark.version, "models": settings.models, "distance": settings.distance, "mask": int(settings.mask), "batch_size": settings.batch_size, "chunk_records": settings.chunk_records}
    pending, complete = claimed(spark, tasks_of(spark, manifest, first, last), out_dir, values)
    found = jobs.bounded(spark, [lambda t=t: one(spark, t, out_dir, settings, values, score) for t in pending], concurrency)
    return {"shards": len(pending) + len(complete), "scored": len(pending), "skipped": len(complete), "records": sum(found) + sum(t["records"] for t in complete)}


def one(spark: SparkSession, task: dict, out_dir: str, settings: Settings, values: dict[str, object], score: Callable[[str, str], int]) -> int:
    """Score a shard, compare counts, publish metadata and marker; returns its records."""
    job, began = uuid.uuid4().hex, now()
    base = f"{out_dir}/{task['shard_id']}"
    files.remove(f"{base}.complete")  # it tells of another run, or of a file that isn't there
    wrote = score(task["input_vcf"], f"{base}.vcf.gz")
    read = readers.vcf(spark, task["input_vcf"], settings.info_key).count()
    if read != wrote:
        files.remove(f"{base}.vcf.gz")
        raise ValueError(f"shard {task['shard_id']}: {wrote} records written of {read} read")
    digest = shards.checked(spark, {f"{base}.vcf.gz": None})[f"{base}.vcf.gz"]
    told = {
        "job_id": job, "node": platform.node(), "shard_id": task["shard_id"], "distance": settings.distance, "mask": int(settings.mask), "batch_size": settings.batch_size, "chunk_records": settings.chunk_records,
        "engine_version": strandline.__version__, "spark_version": spark.version, "spark_application": spark.sparkContext.applicationId, "python_version": platform.python_version(),
        "executor_slots": spark.sparkContext.defaultParallelism, "models": settings.models, "code_sha256": values["code_sha256"],
        "reference": files.absolute(settings.reference), "reference_sha256": values["reference_sha256"], "annotation": files.absolute(settings.annotation), "annotation_sha256": values["annotation_sha256"],
        "input": files.absolute(task["input_vcf"]), "input_sha256": task["input_sha256"], "run_fingerprint": task["fingerprint"], "started_at": began,
        "input_records": read, "output_records": wrote, "output_sha256": digest, "finished_at": now(),
    }
    files.write_bytes(f"{base}.{job}.metadata.txt", [writers.metadata_lines(told)])
    files.write_bytes(f"{base}.complete", ["\t".join((task["shard_id"], job, str(wrote), digest, task["fingerprint"])).encode() + b"\n"])
    return wrote


def now() -> str:
    return datetime.datetime.now(datetime.timezone.utc).isoformat(timespec="seconds")


def metadata_table(spark: SparkSession, out_dir: str) -> DataFrame:
    """One row a run of a shard, (file, values as a map), of all metadata files of a folder."""
    lines = spark.read.text(f"{out_dir}/*.metadata.txt").select(F.input_file_name().alias("file"), F.split("value", "=", 2).alias("kv"))
    return lines.groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct(F.col("kv")[0], F.col("kv")[1]))).alias("values"))

