"""Readers of variant, sequence, annotation, plan and response files as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions import alleles
from strandline.operators import intervals
from strandline.sources import bgzf, files
from strandline.sources import fasta as by_offset

COMPRESSED = (".gz", ".bgz", ".bz2", ".zst")
RESPONSE = T.StructType(
    [T.StructField("variant", T.StringType()), *(T.StructField(c, T.StringType()) for c in ("hg", "distance", "mask"))]
    + [T.StructField("scores", T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("g_name", "t_id", "t_priority", *alleles.FIELDS[2:])])))]
)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_no, value) of one or more text files, plain or compressed; numbers count from 1 within a file.

    Files are split as usual: a line's number is its place in its block plus the
    lines of the file's blocks before it, so no file is read by one task alone. One
    block-compressed file is split between its blocks; other compression can't be
    split.
    """
    if path.endswith((".gz", ".bgz")) and "*" not in path and bgzf.is_blocks(path):
        return bgzf.numbered(spark, path)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block_at"), F.monotonically_increasing_id().alias("row_at"))
    blocks = lines.groupBy("path", "block_at").agg(F.min("row_at").alias("first_at"), F.count("*").alias("n"))
    before = Window.partitionBy("path").orderBy("block_at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("path", "block_at", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first_at") + 1).alias("shift"))
    return lines.join(offsets, ["path", "block_at"]).select("path", (F.col("row_at") + F.col("shift")).alias("line_no"), "value")


def at_line(message: str) -> Column:
    return F.raise_error(F.concat(F.col("path"), F.lit(":"), F.col("line_no").cast("string"), F.lit(f": {message}")))


def vcf(spark: SparkSession, path: str, info_key: str) -> DataFrame:
    """line_no, chrom, pos, id, ref, alt, qual, filter, info, annotation of every record.

    ``annotation`` is the first value of ``info_key``, empty if there is none.
    A record of fewer than eight columns is an error that names file and line.
    """
    return vcf_records(numbered_lines(spark, path), info_key)


def vcf_range(spark: SparkSession, path: str, regions: DataFrame, info_key: str) -> DataFrame:
    """Records of an indexed block-compressed file that meet ``regions`` (contig, start, stop, ...), with the regions' columns.

    Only the blocks that the index names are read. ``line_no`` is the record's
    virtual offset, which grows with its line. A record of several regions is told
    for each.
    """
    found = bgzf.scan(spark, path, regions.select("contig", "start", "stop"))
    rows = found.select(F.lit(path).alias("path"), (F.col("block_at") * 65536 + F.col("within")).alias("line_no"), "value")
    read = vcf_records(rows, info_key).withColumn("pos", F.col("pos").cast("long")).withColumnRenamed("chrom", "contig")
    return intervals.overlapping(read, regions)


def vcf_records(lines: DataFrame, info_key: str) -> DataFrame:
    rows = lines.where(~F.col("value").startswith("#") & (F.length("value") > 0)).withColumn("c", F.split("value", "\t"))
    columns = F.when(F.size("c") < 8, at_line("expected at least 8 tab-separated columns").cast("array<string>")).otherwise(F.col("c"))
    names = ("chrom", "pos", "id", "ref", "alt", "qual", "filter", "info")
    read = rows.withColumn("c", columns).select("line_no", *(F.col("c")[i].alias(n) for i, n in enumerate(names)))
    return read.withColumn("annotation", alleles.info_value(F.col("info"), info_key))


def vcf_header(spark: SparkSession, path: str) -> DataFrame:
    return numbered_lines(spark, path).where(F.col("value").startswith("#")).select("line_no", "value")


#: Lines of a sequence file that are put in order together.
CHUNK = 1 << 14


def fasta(spark: SparkSession, path: str, block_size: int = 1 << 16) -> DataFrame:
    """(contig, ordinal, block, start, sequence): upper-case blocks of ``block_size`` bases, contigs in file order.

    Blocks are read by their bytes; a compressed file, or one whose lines differ within a contig, is read as lines.
    """
    if path.endswith(COMPRESSED):
        return fasta_lines(spark, path, block_size)
    try:
        known = by_offset.index(spark, path)
    except by_offset.Irregular:
        return fasta_lines(spark, path, block_size)
    return by_offset.blocks(spark, path, block_size, known)


def fasta_lines(spark: SparkSession, path: str, block_size: int = 1 << 16) -> DataFrame:
    """``fasta`` of any file of sequence lines, without an index.

    The file is read as lines, so it is split like any text. A line's place in
    its contig is the bases before it in its chunk of lines and those of the
    chunks before, back to the contig's name line.
    """
    lines = numbered_lines(spark, path).withColumn("chunk", F.floor((F.col("line_no") - 1) / CHUNK)).withColumn("bases", F.upper(F.regexp_replace("value", r"\s", "")))
    named = F.col("value").startswith(">")
    inside = Window.partitionBy("path", "chunk").orderBy("line_no")
    marked = lines.withColumn("size", F.when(named, F.lit(0)).otherwise(F.length("bases")).cast("long")).withColumn("own", F.last(F.when(named, F.col("line_no")), True).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    since = Window.partitionBy("path", "chunk", "own").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    placed = marked.withColumn("at", F.coalesce(F.sum("size").over(since), F.lit(0)))
    # a row for each chunk: the last name line in it, and the bases after that (or all)
    chunks = marked.groupBy("path", "chunk").agg(F.max("own").alias("last"), F.sum("size").alias("every"))
    tails = marked.groupBy("path", "chunk", "own").agg(F.sum("size").alias("tail"))
    chunks = chunks.select("path", "chunk", "last", "every").join(tails.select("path", "chunk", F.col("own").alias("last"), "tail"), ["path", "chunk", "last"], "left").withColumn("tail", F.coalesce("tail", "every"))
    along = Window.partitionBy("path").orderBy("chunk")
    chunks = chunks.withColumn("part", F.count("last").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    before = chunks.withColumn("upto", F.sum("tail").over(Window.partitionBy("path", "part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0))).select(
        "path", "chunk", F.last("last", True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"), F.lag("upto").over(along).alias("carried")
    )
    known = placed.join(before, ["path", "chunk"])
    own = known.where(~named & (F.col("size") > 0)).select("path", F.coalesce("own", "earlier").alias("head"), F.when(F.col("own").isNull(), F.col("at") + F.coalesce("carried", F.lit(0))).otherwise(F.col("at")).alias("at"), "size", "bases").where("head is not null")
    spread = own.withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / block_size), F.floor((F.col("at") + F.col("size") - 1) / block_size))))
    low = F.greatest(F.col("block") * block_size - F.col("at"), F.lit(0))
    high = F.least((F.col("block") + 1) * block_size - F.col("at"), F.col("size"))
    pieces = spread.select("path", "head", "block", "at", F.substring("bases", (low + 1).cast("int"), (high - low).cast("int")).alias("piece"))
    blocks = pieces.groupBy("path", "head", "block").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda x: x["piece"]), "").alias("sequence"))
    # one row for each contig
    heads = lines.where(named).select("path", F.col("line_no").alias("head"), F.regexp_extract("value", r"^>\s*(\S+)", 1).alias("contig"), (F.row_number().over(Window.partitionBy("path").orderBy("line_no")) - 1).alias("ordinal"))
    return heads.join(blocks, ["path", "head"], "left").select("contig", "ordinal", F.coalesce("block", F.lit(0)).cast("long").alias("block"), (F.coalesce("block", F.lit(0)) * block_size).cast("long").alias("start"), F.coalesce("sequence", F.lit("")).alias("sequence"))


def contigs(blocks: DataFrame) -> DataFrame:
    """(contig, ordinal, length)."""
    return blocks.groupBy("contig").agg(F.min("ordinal").alias("ordinal"), F.sum(F.length("sequence")).cast("long").alias("length"))


def slices(blocks: DataFrame, regions: DataFrame, extra: int = 0, block_size: int = 1 << 16) -> DataFrame:
    """Regions (contig, start, stop, ...) with their bases, ``extra`` more after the end where the contig has them."""
    named = regions.withColumn("region_no", F.monotonically_increasing_id())
    spread = named.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block_size), F.floor((F.col("stop") + extra - 1) / block_size))))
    joined = spread.join(blocks.select("contig", "block", F.col("start").alias("at"), F.col("sequence").alias("part")), ["contig", "block"])
    a = F.greatest(F.col("start") - F.col("at"), F.lit(0))
    b = F.least(F.col("stop") + extra - F.col("at"), F.length("part").cast("long"))
    cut = joined.withColumn("piece", F.substring("part", (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int")))
    keys = [c for c in named.columns]
    return cut.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "piece"))), lambda x: x["piece"]), "").alias("sequence")).drop("region_no")


def _positions(text: Column) -> Column:
    return F.transform(F.filter(F.split(text, ","), lambda x: x != ""), lambda x: x.cast("bigint"))


def annotations(spark: SparkSession, path: str) -> DataFrame:
    """name, contig, strand, start, stop, exon_starts, exon_stops, line_no of a seven-column annotation table.

    Rows that don't have seven columns, whole coordinates and 0 <= start < stop
    are errors that name file and line; so is a table without rows.
    """
    rows = numbered_lines(spark, path).where((F.trim("value") != "") & ~F.col("value").startswith("#")).withColumn("c", F.split("value", "\t"))
    if rows.isEmpty():
        raise ValueError(f"no transcript intervals found in {path}")
    start, stop = F.col("c")[3].try_cast("bigint"), F.col("c")[4].try_cast("bigint")
    checked = (
        F.when(F.size("c") != 7, at_line("expected 7 annotation columns").cast("array<string>"))
        .when(F.get("c", F.lit(3)).try_cast("bigint").isNull() | F.get("c", F.lit(4)).try_cast("bigint").isNull(), at_line("invalid transcript coordinates").cast("array<string>"))
        .when((start < 0) | (stop <= start), at_line("invalid half-open interval").cast("array<string>"))
        .otherwise(F.col("c"))
    )
    return rows.withColumn("c", checked).select(F.col("c")[0].alias("name"), F.col("c")[1].alias("contig"), F.col("c")[2].alias("strand"), start.alias("start"), stop.alias("stop"), _positions(F.col("c")[5]).alias("exon_starts"), _positions(F.col("c")[6]).alias("exon_stops"), "line_no")


def gtf(spark: SparkSession, path: str) -> DataFrame:
    """line_no, contig, feature, start, stop, strand, attributes of transcript and exon rows; coordinates as in the file."""
    rows = numbered_lines(spark, path).where(~F.col("value").startswith("#")).withColumn("c", F.split("value", "\t")).where(F.size("c") == 9)
    return rows.where(F.col("c")[2].isin("transcript", "exon")).select(
        "line_no", F.col("c")[0].alias("contig"), F.col("c")[2].alias("feature"), F.col("c")[3].cast("bigint").alias("start"), F.col("c")[4].cast("bigint").alias("stop"), F.col("c")[6].alias("strand"), F.col("c")[8].alias("attributes")
    )


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated table with a header."""
    return spark.read.csv(path, sep="\t", header=True)


def nth_task(spark: SparkSession, path: str, number: int) -> str:
    """The ``number``-th line, from 1, that is neither empty nor a comment."""
    if number < 1:
        raise ValueError("task number must be positive")
    found = numbered_lines(spark, path).where((F.trim("value") != "") & ~F.col("value").startswith("#")).orderBy("line_no").limit(number).collect()
    if len(found) < number:
        raise ValueError(f"{path} has no task {number}")
    return found[-1]["value"]


def task_range(spark: SparkSession, path: str, first: int = 1, last: int | None = None) -> DataFrame:
    """task, value: the tasks ``first`` to ``last`` (the last one by default) of a task list, numbered from 1 as ``nth_task`` does.

    An empty list and a range that doesn't lie within it are errors.
    """
    listed = numbered_lines(spark, path).where((F.trim("value") != "") & ~F.col("value").startswith("#"))
    tasks = listed.count()
    if not tasks:
        raise ValueError(f"{path} has no tasks")
    last = tasks if last is None else last
    if not 1 <= first <= last <= tasks:
        raise ValueError(f"tasks {first} to {last} don't lie in 1..{tasks}")
    number = F.row_number().over(Window.orderBy("line_no"))  # one row a task
    return listed.select(number.alias("task"), "value").where(F.col("task").between(first, last))


def responses(spark: SparkSession, directory: str) -> DataFrame:
    """Cached responses of an outside service: one JSON object a file, the file's name telling the query."""
    read = spark.read.schema(RESPONSE).option("primitivesAsString", True).json(directory, multiLine=True)
    return read.withColumn("query", F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1))


def resources(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256) of files, each streamed by one task; files may be of any size."""
    listed = spark.read.format("binaryFile").load(path).select("path")
    return files.digests(listed)
