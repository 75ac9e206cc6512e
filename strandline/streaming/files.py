"""An extension: the stateless record transforms over files as they arrive.

Structured Streaming reads new variant files from a folder and runs the same
column expressions as the batch readers. There is no event time and no state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strandline.functions import alleles


def arriving(spark: SparkSession, folder: str, info_key: str, files_per_trigger: int = 16) -> DataFrame:
    """chrom, pos, id, ref, alt, info, annotation of the records of new files."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)
    rows = lines.where(~F.col("value").startswith("#")).withColumn("c", F.split("value", "\t")).where(F.size("c") >= 8)
    read = rows.select(*(F.col("c")[i].alias(n) for i, n in ((0, "chrom"), (1, "pos"), (2, "id"), (3, "ref"), (4, "alt"), (7, "info"))))
    return read.withColumn("annotation", alleles.info_value(F.col("info"), info_key))


def parsed(records: DataFrame) -> DataFrame:
    """One row per annotation entry of arriving records."""
    return records.select("chrom", "pos", "ref", F.explode(alleles.entries(F.col("annotation"))).alias("e")).select("chrom", "pos", "ref", *(F.col("e")[i].alias(n.lower()) for i, n in enumerate(alleles.FIELDS)))


def drain(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write what is there and stop."""
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
