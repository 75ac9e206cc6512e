"""Sequence files by byte offset: an index of line geometry, and reads of the bytes that a block or region needs.

The index has one row a contig, (contig, ordinal, length, offset, line_bases,
line_bytes), as ``.fai`` files do: a base's place in the file is arithmetic. It is
made from ranges of the file's bytes, each of which tells runs of equally long
lines and name lines, and kept beside the file. Files whose lines differ within a
contig have no index; ``readers.fasta_lines`` reads them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.sources import files

#: Bytes of the file that one task looks at.
RANGE = 32 << 20
INDEX = "contig string, ordinal long, length long, offset long, line_bases long, line_bytes long"
EVENTS = pa.schema([("at", pa.int64()), ("kind", pa.int32()), ("bytes", pa.int64()), ("count", pa.int64()), ("name", pa.string())])
#: Kinds of events, in their order at one place: a name line begins, a line of an earlier range ends, equally long lines, what is counted.
NAMED, ENDS, LINES, COUNTED = range(4)


class Irregular(ValueError):
    """The lines of a contig aren't equally long."""


def name_of(line: bytes) -> str:
    return (line[1:].split() or [b""])[0].decode()


def events_of(data: bytes, start: int, before: bytes, goes_on: bool, rest: bytes) -> Iterator[tuple[int, int, int, int, str | None]]:
    """(at, kind, bytes, count, name) of a range.

    ``before`` is the byte before it, ``goes_on`` tells whether it begins within a
    name line, and ``rest`` completes a name line that ends after it.
    """
    begins_line = before == b"\n"
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(raw == 10)
    starts = np.concatenate([[0] if begins_line else np.zeros(0, np.int64), ends + 1]).astype(np.int64)
    starts = starts[starts < len(raw)]
    heads = starts[raw[starts] == ord(">")]
    for h in heads:
        after = ends[np.searchsorted(ends, h) :]
        line = data[h : after[0]] if len(after) else data[h:] + rest
        yield start + int(h), NAMED, 0, 0, name_of(line)
    strange = np.flatnonzero((raw <= 32) & (raw != 10) & (raw != 13))
    own_line = np.searchsorted(starts, strange, "right") - 1
    named = (own_line < 0) & goes_on
    named[own_line >= 0] = np.isin(starts[own_line[own_line >= 0]], heads)
    returns = int((raw[ends[ends > 0] - 1] == 13).sum()) + int(len(ends) > 0 and ends[0] == 0 and before == b"\r")
    yield start, COUNTED, int((~named).sum()), len(ends), str(returns)
    if len(ends):
        yield start, ENDS, start + int(ends[0]) + 1, 0, None
        sizes, named = np.diff(ends), np.isin(ends[:-1] + 1, heads)
        if len(sizes):
            opens = np.flatnonzero(np.concatenate([[True], (sizes[1:] != sizes[:-1]) | named[1:] | named[:-1]]))
            for i, j in zip(opens, [*opens[1:], len(sizes)]):
                yield start + int(ends[i]) + 1, LINES, int(sizes[i]), int(j - i), None


#: The longest name line that a range may begin in.
NAME_LINE = 1 << 16


def range_events(file: pa.NativeFile, start: int, stop: int) -> Iterator[tuple[int, int, int, int, str | None]]:
    back = min(start, NAME_LINE)
    file.seek(start - back)
    data = file.read(stop - start + back)
    lead, data = data[:back], data[back:]
    before = lead[-1:] or b"\n"
    goes_on = before != b"\n" and lead[lead.rfind(b"\n") + 1 :].startswith(b">")
    rest = b""
    if b">" in data and not data.endswith(b"\n"):
        while b"\n" not in rest and (more := file.read(1 << 12)):
            rest += more
        rest = rest.partition(b"\n")[0]
    yield from events_of(data, start, before, goes_on, rest)


def geometry(events: Iterable[tuple[int, int, int, int, str | None]], size: int) -> list[tuple[str, int, int, int, int, int]]:
    """The index from events in order of place and kind; lines that aren't regular are an error."""
    contigs: list[dict] = []
    begun = ended = returned = 0
    for at, kind, n, count, name in events:
        if kind == COUNTED:
            ended, returned = ended + count, returned + int(name)
            if n:
                raise Irregular("white space within sequence lines")
        elif kind == NAMED:
            contigs.append({"name": name, "head": at, "offset": None, "runs": []})
        else:
            first, length, times = (begun, n - begun, 1) if kind == ENDS else (at, n, count)
            if contigs and first == contigs[-1]["head"]:
                contigs[-1]["offset"] = first + length
            elif contigs:
                contigs[-1]["runs"].append([length, times])
            begun = first + length * times
    if returned not in (0, ended):
        raise Irregular("line ends of two kinds")
    gap = 2 if returned else 1
    if begun < size and contigs:
        if begun == contigs[-1]["head"]:
            contigs[-1]["offset"] = size
        else:
            contigs[-1]["runs"].append([size - begun + gap, 1])  # a last line without an end
    out = []
    for i, c in enumerate(contigs):
        runs: list[list[int]] = []
        for length, times in c["runs"]:
            if runs and runs[-1][0] == length:
                runs[-1][1] += times
            else:
                runs.append([length, times])
        while runs and runs[-1][0] == gap:
            runs.pop()
        if len(runs) > 2 or (len(runs) == 2 and (runs[1][1] > 1 or runs[1][0] > runs[0][0])):
            raise Irregular(f"lines of different lengths in {c['name']}")
        bases = sum((length - gap) * times for length, times in runs)
        whole = runs[0][0] if runs else gap
        out.append((c["name"], i, bases, c["offset"], whole - gap, whole))
    return out


def made_index(spark: SparkSession, path: str) -> list[tuple[str, int, int, int, int, int]]:
    """The index of a file, one row a contig, from its ranges."""
    files.ship(spark)
    size = files.size_of(path)
    if size is None:
        raise ValueError(f"{path}: no such file")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with files.opened(path) as file:
            for batch in batches:
                for start in batch.column(0).to_pylist():
                    rows = list(range_events(file, start, min(start + RANGE, size)))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), EVENTS.types)], schema=EVENTS)

    parts = -(-size // RANGE)
    if not parts:
        return []
    found = spark.range(0, parts * RANGE, RANGE, numPartitions=parts).mapInArrow(look, "at long, kind int, bytes long, count long, name string")
    return geometry((tuple(r) for r in found.orderBy("at", "kind").toLocalIterator()), size)  # a few rows a contig and range


def index(spark: SparkSession, path: str) -> DataFrame:
    """contig, ordinal, length, offset, line_bases, line_bytes; read from the index beside the file, or made, if that one is missing or older, and kept there if the folder can be written."""
    own = f"{path}.fai"
    if files.size_of(own) is not None and not files.is_older(own, path):
        rows = [(c[0], i, *map(int, c[1:5])) for i, c in enumerate(line.split("\t") for line in files.read_text(own).splitlines() if line)]
    else:
        rows = made_index(spark, path)
        try:
            files.write_bytes(own, ["".join("\t".join(map(str, (r[0], *r[2:]))) + "\n" for r in rows).encode()])
        except OSError:
            pass  # a folder that isn't ours: the index is made anew each time
    return spark.createDataFrame(rows, INDEX)


def byte_of(base: Column) -> Column:
    """Place in the file of a base (from 0) of an index row."""
    line = F.greatest(F.col("line_bases"), F.lit(1))
    return (F.col("offset") + F.floor(base / line) * F.col("line_bytes") + base % line).cast("long")


def with_bases(spans: DataFrame, path: str, parts: int) -> DataFrame:
    """``spans`` with ``sequence``, the upper-case bases of the bytes [from, to) of the file, whose line ends are left out."""
    files.ship(spans.sparkSession)
    kept = [c for c in spans.columns if c not in ("from", "to")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with files.opened(path) as file:
            for batch in batches:
                found: list[str] = []
                held = first = 0
                for i, (start, stop) in enumerate(zip(batch.column("from").to_pylist(), batch.column("to").to_pylist())):
                    file.seek(start)
                    found.append(file.read(stop - start).translate(None, b"\r\n").upper().decode("latin-1"))
                    held += stop - start
                    if held >= files.CHUNK or i + 1 == batch.num_rows:
                        own = batch.slice(first, len(found))
                        yield pa.RecordBatch.from_arrays([*(own.column(c) for c in kept), pa.array(found, pa.string())], names=[*kept, "sequence"])
                        first, found, held = i + 1, [], 0

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spans.schema.fields if f.name in kept)
    return spans.repartition(parts).mapInArrow(read, f"{schema}, sequence string")


def tasks_of(spark: SparkSession, path: str) -> int:
    return max(spark.sparkContext.defaultParallelism, -(-(files.size_of(path) or 0) // RANGE))


def blocks(spark: SparkSession, path: str, block_size: int = 1 << 16, known: DataFrame | None = None) -> DataFrame:
    """contig, ordinal, block, start, sequence: every block read by its own bytes; an empty contig has one empty block."""
    known = index(spark, path) if known is None else known
    start = F.col("block") * block_size
    spans = known.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.floor((F.col("length") - 1) / block_size), F.lit(0)).cast("long"))))
    stop = F.least(start + block_size, F.col("length"))
    spread = spans.select("contig", "ordinal", "block", start.cast("long").alias("start"), byte_of(start).alias("from"), F.when(stop > start, byte_of(stop - 1) + 1).otherwise(byte_of(start)).alias("to"))
    return with_bases(spread, path, tasks_of(spark, path))


def slices(spark: SparkSession, path: str, regions: DataFrame, extra: int = 0, known: DataFrame | None = None) -> DataFrame:
    """``regions`` (contig, start, stop, ...) with their bases and ``extra`` more after the end, as far as the contig goes; only their bytes are read."""
    known = index(spark, path) if known is None else known
    own = known.select(F.col("contig").alias("own_contig"), F.struct("length", "offset", "line_bases", "line_bytes").alias("geometry"))
    placed = regions.join(own, F.col("contig") == F.col("own_contig")).drop("own_contig").select(*regions.columns, "geometry.*")
    stop = F.least(F.col("stop") + extra, F.col("length"))
    spans = placed.where(F.col("start") < F.col("length")).select(*regions.columns, byte_of(F.col("start")).alias("from"), F.greatest(byte_of(F.col("start")), byte_of(stop - 1) + 1).alias("to"))
    return with_bases(spans, path, spark.sparkContext.defaultParallelism)
