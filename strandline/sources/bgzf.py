"""Block-compressed text: split reading, ordered distributed writing, and an index for scans of a range.

A block-compressed file is a row of gzip members of at most 64 KiB, each with its
size in its header, so that reading can begin at any of them. A line's virtual
offset is its block's offset and its place in the block's text.

* Reading: a task takes a range of the file's bytes, finds the first block in it by
  its header, and reads the lines that begin there; a line over a seam is the
  earlier range's.
* Writing: lines are ordered by a range-partitioned sort; each task compresses its
  own range into blocks of a part file and tells its size and index. Parts are then
  copied to their place in the file by tasks. No line passes the driver, whose work
  grows with the number of tasks and of index entries.
* Index: bins of six levels and a linear table over virtual offsets, in the layout
  of ``.tbi`` files. A scan joins its regions with the bins and reads the runs of
  blocks that it finds, nothing else.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from strandline.sources import files

#: Fixed values of the format: the head of a block, the largest text of one, levels of bins, the window of the linear table.
HEAD = b"\x1f\x8b\x08\x04"
TEXT = 0xFF00
LEVELS = 6
FIRST_SHIFT = 29
WINDOW = 14
#: Bytes of a range of the file that one task reads.
RANGE = 32 << 20
#: Lines of an Arrow batch.
BATCH = 8192


# blocks ----------------------------------------------------------------------


def packed(text: bytes, level: int = 6) -> bytes:
    """One block."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(text) + deflate.flush()
    head = HEAD + struct.pack("<IBBHBBHH", 0, 0, 255, 6, 66, 67, 2, len(body) + 25)
    return head + body + struct.pack("<II", zlib.crc32(text), len(text))


#: The empty block that ends every complete file.
END = packed(b"")


def block_bytes(head: bytes) -> int | None:
    """Size of the block that begins with ``head``; None if none does."""
    if len(head) < 18 or head[:4] != HEAD:
        return None
    extra = struct.unpack_from("<H", head, 10)[0]
    at = 12
    while at + 4 <= min(12 + extra, len(head)):
        name, n = head[at : at + 2], struct.unpack_from("<H", head, at + 2)[0]
        if name == b"BC" and n == 2 and at + 6 <= len(head):
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + n
    return None


def unpacked(raw: bytes) -> bytes:
    """The text of a whole block; damage is an error."""
    extra = struct.unpack_from("<H", raw, 10)[0]
    crc, size = struct.unpack_from("<II", raw, len(raw) - 8)
    text = zlib.decompress(raw[12 + extra : -8], -15)
    if len(text) != size or zlib.crc32(text) != crc:
        raise ValueError("checksum of a block differs")
    return text


def is_blocks(path: str) -> bool:
    """Whether the file begins with a block."""
    if not files.size_of(path):
        return False
    with files.opened(path) as file:
        return block_bytes(file.read(64)) is not None


def block_at(file: pa.NativeFile, offset: int, path: str) -> tuple[bytes, int]:
    """Text of the block at ``offset`` and the offset after it."""
    file.seek(offset)
    raw = file.read(1 << 16)
    size = block_bytes(raw)
    if size is None or len(raw) < size:
        raise ValueError(f"{path}: cut or damaged block at byte {offset}")
    try:
        return unpacked(raw[:size]), offset + size
    except (zlib.error, struct.error, ValueError) as error:
        raise ValueError(f"{path}: cut or damaged block at byte {offset}: {error}") from None


def walk(file: pa.NativeFile, offset: int, size: int, path: str) -> Iterator[tuple[int, bytes]]:
    """Offset and text of every block from ``offset`` on."""
    while offset < size:
        text, after = block_at(file, offset, path)
        yield offset, text
        offset = after


def first_block(file: pa.NativeFile, start: int, size: int, path: str) -> int | None:
    """Offset of the first block that begins at ``start`` or later: one whose header, text and checksum agree."""
    if start == 0:
        return 0
    file.seek(start)
    near = file.read(1 << 17)
    at = near.find(HEAD)
    while 0 <= at < 1 << 16:
        if block_bytes(near[at : at + 64]) is not None:
            try:
                block_at(file, start + at, path)
                return start + at
            except ValueError:
                pass
        at = near.find(HEAD, at + 1)
    if start + len(near) < size or len(near) > 1 << 16:
        raise ValueError(f"{path}: no block within 64 KiB after byte {start}")
    return None


def lines_between(file: pa.NativeFile, start: int, stop: int, size: int, path: str) -> Iterator[tuple[int, int, bytes]]:
    """(block, place in its text, line) of the lines of a range of bytes.

    A range that doesn't begin the file skips to its first line end; a range ends
    with the first line end at or after its last block. So each line is in one range.
    """
    first = first_block(file, start, size, path)
    if first is None or first >= stop:
        return
    skipping = start > 0
    held: list[bytes] = []
    begun: tuple[int, int] | None = None
    for offset, text in walk(file, first, size, path):
        beyond = offset >= stop
        if beyond and skipping:
            return
        at = 0
        while at < len(text):
            end = text.find(b"\n", at)
            if not skipping and begun is None:
                begun = (offset, at)
            if end < 0:
                if not skipping:
                    held.append(text[at:])
                break
            if skipping:
                skipping = False
            else:
                yield *begun, b"".join([*held, text[at:end]])
                held, begun = [], None
                if beyond:
                    return
            at = end + 1
    if begun is not None:
        yield *begun, b"".join(held)


def checked_end(path: str, size: int) -> None:
    """An error unless the file ends with the empty block."""
    with files.opened(path) as file:
        file.seek(max(0, size - len(END)))
        if file.read(len(END)) != END:
            raise ValueError(f"{path}: the file is cut: it has no end block")


# reading ---------------------------------------------------------------------

LINES = pa.schema([("range_at", pa.int64()), ("line_at", pa.int64()), ("block_at", pa.int64()), ("within", pa.int32()), ("value", pa.string())])
LINES_DDL = "range_at long, line_at long, block_at long, within int, value string"


def decoded(lines: list[bytes]) -> pa.Array:
    stripped = [x[:-1] if x.endswith(b"\r") else x for x in lines]
    try:
        return pa.array(stripped, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([x.decode("utf-8", "replace") for x in stripped])


def batches_of(found: Iterator[tuple[int, int, bytes]], range_at: int, first: int = 0) -> Iterator[pa.RecordBatch]:
    rows: list[tuple[int, int, bytes]] = []
    held = 0

    def batch() -> pa.RecordBatch:
        n = len(rows)
        columns = [pa.array([range_at] * n, pa.int64()), pa.array(range(first, first + n), pa.int64()), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), decoded([r[2] for r in rows])]
        return pa.RecordBatch.from_arrays(columns, schema=LINES)

    for row in found:
        rows.append(row)
        held += len(row[2])
        if len(rows) >= BATCH or held >= files.CHUNK:
            yield batch()
            first += len(rows)
            rows, held = [], 0
    if rows:
        yield batch()


class ByteRange(InputPartition):
    def __init__(self, start: int, stop: int):
        super().__init__((start, stop))


class BlockLines(DataSource):
    """``spark.read.format("block_lines").option("path", p)``: the lines of one block-compressed file, a task for each ``range_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "block_lines"

    def schema(self) -> str:
        return LINES_DDL

    def reader(self, schema) -> DataSourceReader:
        return RangeReader(self.options["path"], int(self.options.get("range_bytes", RANGE)))


class RangeReader(DataSourceReader):
    def __init__(self, path: str, step: int):
        self.path, self.step = path, step

    def partitions(self) -> list[ByteRange]:
        size = files.size_of(self.path)
        if size is None:
            raise ValueError(f"{self.path}: no such file")
        checked_end(self.path, size)
        return [ByteRange(a, min(a + self.step, size)) for a in range(0, size, self.step)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        start, stop = partition.value
        with files.opened(self.path) as file:
            yield from batches_of(lines_between(file, start, stop, files.size_of(self.path), self.path), start)


def lines(spark: SparkSession, path: str, range_bytes: int = RANGE) -> DataFrame:
    """range_at, line_at (place among the range's lines), block_at, within, value of every line."""
    files.ship(spark)
    spark.dataSource.register(BlockLines)
    return spark.read.format("block_lines").option("path", path).option("range_bytes", range_bytes).load()


def numbered(spark: SparkSession, path: str, range_bytes: int = RANGE) -> DataFrame:
    """path, line_no (from 1), value: a line's number is its place in its range plus the lines of the ranges before."""
    rows = lines(spark, path, range_bytes)
    counts = rows.groupBy("range_at").agg(F.count("*").alias("n"))  # one row a range
    before = Window.orderBy("range_at").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(F.col("range_at").alias("own"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    return rows.join(shifts, F.col("range_at") == F.col("own")).select(F.lit(path).alias("path"), (F.col("line_at") + F.col("shift") + 1).alias("line_no"), "value")


# index -----------------------------------------------------------------------


def first_of_level(level: int) -> int:
    return ((1 << 3 * level) - 1) // 7


def bin_of(start: int, stop: int) -> int:
    """The smallest bin that holds the half-open span."""
    for level in range(LEVELS - 1, 0, -1):
        shift = FIRST_SHIFT - 3 * level
        if start >> shift == (stop - 1) >> shift:
            return first_of_level(level) + (start >> shift)
    return 0


def bins_over(start: Column, stop: Column) -> Column:
    """All bins, of every level, that meet the half-open span."""
    levels = []
    for level in range(LEVELS):
        shift, first = FIRST_SHIFT - 3 * level, first_of_level(level)
        levels.append(F.sequence(F.shiftright(start, shift) + first, F.shiftright(stop - 1, shift) + first))
    return F.concat(*levels)


@dataclass
class Spans:
    """Index entries of records in order: runs of records of one bin, and the first offset of every window.

    ``runs``: contig -> [bin, from, to]; ``windows``: contig -> {window: offset}.
    """

    runs: dict[str, list[list[int]]] = field(default_factory=dict)
    windows: dict[str, dict[int, int]] = field(default_factory=dict)
    ends: dict[str, list[int]] = field(default_factory=dict)

    def add(self, contig: str, start: int, stop: int, at: int, after: int) -> None:
        if not 0 <= start < stop <= 1 << FIRST_SHIFT:
            raise ValueError(f"span {contig}:{start}-{stop} doesn't fit the index")
        if contig not in self.runs:
            self.runs[contig], self.windows[contig], self.ends[contig] = [], {}, [start, start]
        elif next(reversed(self.runs)) != contig or start < self.ends[contig][1]:
            raise ValueError(f"records are not in the order of contig and position at {contig}:{start}")
        self.ends[contig][1] = start
        own, runs = bin_of(start, stop), self.runs[contig]
        if runs and runs[-1][0] == own and runs[-1][2] == at:
            runs[-1][2] = after
        else:
            runs.append([own, at, after])
        for w in range(start >> WINDOW, (stop - 1 >> WINDOW) + 1):
            self.windows[contig].setdefault(w, at)

    def join(self, later: Spans, shift: int) -> None:
        """Put the entries of the part behind, whose offsets begin at ``shift``."""
        for i, (contig, runs) in enumerate(later.runs.items()):
            moved = [[b, f + shift, t + shift] for b, f, t in runs]
            if contig not in self.runs:
                self.runs[contig], self.windows[contig], self.ends[contig] = [], {}, list(later.ends[contig])
            elif i or next(reversed(self.runs)) != contig or later.ends[contig][0] < self.ends[contig][1]:
                raise ValueError(f"records are not in the order of contig and position at {contig}")
            self.runs[contig] += moved
            self.ends[contig][1] = later.ends[contig][1]
            for w, at in later.windows[contig].items():
                self.windows[contig].setdefault(w, at + shift)


def index_bytes(spans: Spans) -> Iterator[bytes]:
    """The index as blocks: header of column numbers, names, and for every contig bins with runs and the linear table."""
    names = b"".join(c.encode() + b"\0" for c in spans.runs)
    out = [b"TBI\1", struct.pack("<8i", len(spans.runs), 2, 1, 2, 0, ord("#"), 0, len(names)), names]
    for contig, runs in spans.runs.items():
        bins: dict[int, list[list[int]]] = {}
        for b, at, after in runs:
            bins.setdefault(b, []).append([at, after])
        out.append(struct.pack("<i", len(bins)))
        for b, own in bins.items():
            out.append(struct.pack("<Ii", b, len(own)) + b"".join(struct.pack("<QQ", *x) for x in own))
        windows = spans.windows[contig]
        table, last = [], 0
        for w in range(max(windows) + 1):
            last = windows.get(w, last)
            table.append(last)
        out.append(struct.pack("<i", len(table)) + struct.pack(f"<{len(table)}Q", *table))
    whole = b"".join(out)
    for at in range(0, len(whole), TEXT):
        yield packed(whole[at : at + TEXT])
    yield END


def index_entries(path: str) -> Iterator[tuple[str, int | None, int | None, int, int | None]]:
    """(contig, bin, null, from, to) of every run and (contig, null, window, from, null) of the linear table of an index file."""
    with files.opened(path) as file:
        text = b"".join(t for _, t in walk(file, 0, files.size_of(path), path))
    if text[:4] != b"TBI\1":
        raise ValueError(f"{path}: not an index")
    n, *_, length = struct.unpack_from("<8i", text, 4)
    names = text[36 : 36 + length].split(b"\0")[:n]
    at = 36 + length
    for name in names:
        contig = name.decode()
        (bins,) = struct.unpack_from("<i", text, at)
        at += 4
        for _ in range(bins):
            number, runs = struct.unpack_from("<Ii", text, at)
            at += 8
            for k in range(runs):
                if number < first_of_level(LEVELS):  # a higher number is for statistics
                    yield contig, number, None, *struct.unpack_from("<QQ", text, at + 16 * k)
            at += 16 * runs
        (windows,) = struct.unpack_from("<i", text, at)
        for w, offset in enumerate(struct.unpack_from(f"<{windows}Q", text, at + 4)):
            yield contig, None, w, offset, None
        at += 4 + 8 * windows


ENTRIES = pa.schema([("contig", pa.string()), ("bin", pa.int64()), ("window", pa.int64()), ("from", pa.int64()), ("to", pa.int64())])


def index_table(spark: SparkSession, path: str) -> DataFrame:
    """contig, bin, window, from, to of the index of a block-compressed file, read by one task."""
    files.ship(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in batch.column(0).to_pylist():
                rows: list[tuple] = []
                for entry in index_entries(own):
                    rows.append(entry)
                    if len(rows) == BATCH:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), ENTRIES.types)], schema=ENTRIES)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), ENTRIES.types)], schema=ENTRIES)

    return spark.range(1).select(F.lit(f"{path}.tbi").alias("path")).mapInArrow(read, "contig string, bin long, window long, from long, to long")


def runs_over(index: DataFrame, regions: DataFrame) -> DataFrame:
    """from, to of the runs of blocks that may hold records of ``regions`` (contig, start, stop); no two overlap."""
    clipped = regions.select("contig", F.greatest("start", F.lit(0)).cast("long").alias("start"), F.least("stop", F.lit(1 << FIRST_SHIFT)).cast("long").alias("stop")).where("start < stop").distinct()
    linear = index.where("window is not null")
    ends = linear.groupBy("contig").agg(F.max("window").alias("last"))  # contigs of an index are few
    # the first offset of a record that reaches the window of the region's start
    known = clipped.join(F.broadcast(ends), "contig").withColumn("window", F.least(F.shiftright("start", WINDOW), F.col("last"))).join(linear.select("contig", "window", F.col("from").alias("least")), ["contig", "window"])
    wanted = known.select("contig", "least", F.explode(bins_over(F.col("start"), F.col("stop"))).alias("bin")).groupBy("contig", "bin").agg(F.min("least").alias("least"))
    found = index.where("bin is not null").select("contig", "bin", "from", "to").join(wanted, ["contig", "bin"]).where(F.col("to") > F.col("least")).select("contig", F.greatest("from", "least").alias("from"), "to")
    # runs of an index made elsewhere may overlap; each offset is read once
    before = Window.partitionBy("contig").orderBy("from", "to").rowsBetween(Window.unboundedPreceding, -1)
    return found.select(F.greatest("from", F.coalesce(F.max("to").over(before), F.lit(0))).alias("from"), "to").where(F.col("from") < F.col("to"))


def scan(spark: SparkSession, path: str, regions: DataFrame) -> DataFrame:
    """Lines of the blocks that the index names for ``regions``: all records of the regions, and those around them in the same runs."""
    files.ship(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with files.opened(path) as file:
            size = files.size_of(path)
            for batch in batches:
                for start, stop in zip(*(batch.column(i).to_pylist() for i in range(2))):
                    yield from batches_of(lines_of_run(file, start, stop, size, path), start)

    runs = runs_over(index_table(spark, path), regions)
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return runs.repartition(tasks, "from").mapInArrow(read, LINES_DDL)


def lines_of_run(file: pa.NativeFile, start: int, stop: int, size: int, path: str) -> Iterator[tuple[int, int, bytes]]:
    """Lines whose virtual offset lies in [start, stop); ``start`` is one of a line."""
    held: list[bytes] = []
    begun: tuple[int, int] | None = None
    for offset, text in walk(file, start >> 16, size, path):
        at = start & 0xFFFF if offset == start >> 16 else 0
        while at < len(text):
            if begun is None:
                if offset << 16 | at >= stop:
                    return
                begun = (offset, at)
            end = text.find(b"\n", at)
            if end < 0:
                held.append(text[at:])
                break
            yield *begun, b"".join([*held, text[at:end]])
            held, begun, at = [], None, end + 1
        if begun is None and (offset + 1) << 16 > stop:
            return
    if begun is not None:
        yield *begun, b"".join(held)


# writing ---------------------------------------------------------------------


@dataclass
class Part(WriterCommitMessage):
    number: int
    name: str
    bytes: int
    lines: int
    spans: Spans | None


class BlockParts(DataSource):
    """``df.write.format("block_parts")``: every task's lines as a part file, and ``parts.json``, which lists them in order."""

    @classmethod
    def name(cls) -> str:
        return "block_parts"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return PartWriter(self.options["path"], self.options["kind"] == "blocks", [f.name for f in schema.fields])


class Blocks:
    """Text cut into blocks; a line that fits a block is whole in one."""

    def __init__(self, out: pa.NativeFile, compressed: bool):
        self.out, self.compressed = out, compressed
        self.done, self.text = 0, bytearray()

    def _flush(self, n: int) -> None:
        raw = packed(bytes(self.text[:n])) if self.compressed else bytes(self.text[:n])
        self.out.write(raw)
        self.done += len(raw)
        del self.text[:n]

    def line(self, line: bytes) -> tuple[int, int]:
        """Virtual offsets of the line and of what follows it."""
        if self.text and len(self.text) + len(line) > TEXT:
            self._flush(len(self.text))
        at = self.done << 16 | len(self.text)
        self.text += line
        while len(self.text) >= TEXT:
            self._flush(TEXT)
        return at, self.done << 16 | len(self.text)

    def end(self) -> int:
        if self.text:
            self._flush(len(self.text))
        return self.done


class PartWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, compressed: bool, columns: list[str]):
        self.folder, self.compressed, self.columns = folder, compressed, columns

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        number = TaskContext.get().partitionId()
        name = f"part-{number:06d}-{uuid.uuid4().hex}"  # another attempt has another name
        spans = Spans() if "contig" in self.columns else None
        total = 0
        system, path = files.located(f"{self.folder}/{name}")
        with system.open_output_stream(path) as out:
            blocks = Blocks(out, self.compressed)
            for batch in iterator:
                columns = [batch.column(self.columns.index("line")).cast(pa.binary()).to_pylist()]
                if spans is not None:
                    columns += [batch.column(self.columns.index(c)).to_pylist() for c in ("contig", "start", "stop")]
                for line, *span in zip(*columns):
                    at, after = blocks.line(line + b"\n")
                    if spans is not None:
                        spans.add(*span, at, after)
                total += batch.num_rows
            size = blocks.end()
        return Part(number, name, size, total, spans)

    def commit(self, messages: list[Part | None]) -> None:
        found = sorted((m for m in messages if m is not None), key=lambda m: m.number)
        told = [{"name": m.name, "bytes": m.bytes, "lines": m.lines} for m in found]
        spans = None
        if any(m.spans is not None for m in found):
            spans, at = Spans(), 0
            for m in found:
                spans.join(m.spans, at << 16)
                at += m.bytes
        text = json.dumps({"parts": told, "runs": spans and spans.runs, "windows": spans and {c: list(w.items()) for c, w in spans.windows.items()}})
        files.write_bytes(f"{self.folder}/parts.json", [text.encode()])

    def abort(self, messages: list[Part | None]) -> None:
        files.remove(self.folder)


@dataclass
class Written:
    """What ``write`` wrote: bytes and lines of the file (without its header)."""

    bytes: int
    lines: int


def write(rows: DataFrame, order: Sequence[str | Column], path: str, header: Sequence[str] = (), span: tuple[Column, Column, Column] | None = None) -> Written:
    """The column ``line`` of ``rows`` in order as one file, in blocks if its name ends in .gz.

    With ``span`` (contig, start, stop of a record) an index goes beside it. The
    file gets its name, after its index, when all is written; an old one stays if
    anything fails.
    """
    spark = rows.sparkSession
    files.ship(spark)
    spark.dataSource.register(BlockParts)
    compressed = path.endswith((".gz", ".bgz"))
    if span is not None and not compressed:
        raise ValueError("an index is for block-compressed files")
    files.make_folder(files.parent(path))
    folder, temporary = files.beside(path), files.beside(path)
    files.make_folder(folder)
    try:
        extra = [] if span is None else [c.alias(n) for n, c in zip(("contig", "start", "stop"), span)]
        sorted_rows = rows.orderBy(*order).select(F.col("line").cast("string").alias("line"), *extra)
        sorted_rows.write.format("block_parts").option("path", folder).option("kind", "blocks" if compressed else "text").mode("append").save()
        told = json.loads(files.read_text(f"{folder}/parts.json"))
        head = "".join(f"{h}\n" for h in header).encode()
        first = b"".join(packed(head[i : i + TEXT]) for i in range(0, len(head), TEXT)) if compressed else head
        size = joined(spark, folder, told["parts"], temporary, first, END if compressed else b"")
        if span is not None:
            spans, shift = Spans(), len(first) << 16
            for contig, runs in (told["runs"] or {}).items():
                spans.runs[contig] = [[b, f + shift, t + shift] for b, f, t in runs]
                spans.windows[contig] = {w: at + shift for w, at in told["windows"][contig]}
            files.write_bytes(f"{path}.tbi", index_bytes(spans))
        files.rename(temporary, path)
        return Written(size, sum(p["lines"] for p in told["parts"]))
    finally:
        files.remove(temporary)
        files.remove(folder)


def joined(spark: SparkSession, folder: str, parts: list[dict], target: str, first: bytes, last: bytes) -> int:
    """Header, parts and end as one file. On a shared disk every part is copied to its place by a task of its own; on other stores one task appends them, chunk by chunk."""
    places, at = [], len(first)
    for part in parts:
        places.append((part["name"], at))
        at += part["bytes"]
    size = at + len(last)
    local = files.is_local(target)
    if local:
        with open(files.located(target)[1], "wb") as out:
            out.write(first)
            out.truncate(size)
            out.seek(at)
            out.write(last)

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copied = 0
        for batch in batches:
            numbers = batch.column(0).to_pylist()
            if local:
                out = os.open(files.located(target)[1], os.O_WRONLY)
                try:
                    for name, where in (places[i] for i in numbers):  # the same bytes at the same place, whichever attempt writes them
                        for chunk in files.chunks_of(f"{folder}/{name}"):
                            os.pwrite(out, chunk, where)
                            where += len(chunk)
                            copied += len(chunk)
                    os.fsync(out)
                finally:
                    os.close(out)
            elif numbers:
                system, path = files.located(target)
                with system.open_output_stream(path) as stream:
                    stream.write(first)
                    for name, _ in places:
                        for chunk in files.chunks_of(f"{folder}/{name}"):
                            stream.write(chunk)
                            copied += len(chunk)
                    stream.write(last)
        yield pa.RecordBatch.from_pylist([{"copied": copied}], schema=pa.schema([("copied", pa.int64())]))

    if places or not local:
        n = len(places) if local else 1
        copied = spark.range(0, n, 1, min(n, 4 * spark.sparkContext.defaultParallelism)).mapInArrow(copy, "copied long").agg(F.sum("copied")).head()[0]
        if copied != sum(p["bytes"] for p in parts):
            raise OSError(f"{target}: {copied} of {sum(p['bytes'] for p in parts)} bytes were copied")
    return size
