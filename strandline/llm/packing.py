"""Packing of documents into training sequences by cutting-stock patterns.

A document is its token ids and a closing id. What fills whole sequences is cut
off its front. The rests (shorter than a sequence) form a histogram of at most
``length - 1`` counts; the cutting-stock program over it gives patterns that
fill a sequence exactly, with whole multiplicities. Rests are ranked within
their length, and each rank finds its pattern, sequence and offset in a table
whose size is bounded by the sequence length. The rests that rounding leaves
over follow one another and are cut wherever a sequence is full; the last,
incomplete sequence is cut into powers of two. No sequence needs padding.

Tokens are encoded once; checksums of whole sequences and rests are taken then,
and only rests that are cut read their ids again.

Defined results: a null text counts as empty; its document is the closing id
alone. Repeated rows are packed as rows of their own. An empty table gives an
empty result. Extra columns are ignored. Memory follows the longest text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import cutting_stock
from strandline.llm.bpe import encoder, slices
from strandline.llm.frames import at_workers, numbered, read, written

ENCODED = "uid long, doc_id long, doc_tokens long, full array<long>, rest int, rest_crc32 long, rest_ids binary"


def _encoded(path: str, closing: int, length: int):
    end, step = closing.to_bytes(4, "little"), 4 * length

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, library=True)
        for batch in batches:
            at = 0
            for texts in slices(batch.column(2)):
                out = []
                for blob in own.encode(texts):
                    blob += end
                    whole = len(blob) // step * step
                    view = memoryview(blob)
                    out.append((len(blob) // 4, [zlib.crc32(view[i : i + step]) for i in range(0, whole, step)], (len(blob) - whole) // 4, zlib.crc32(view[whole:]), blob[whole:]))
                types = (pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int64(), pa.binary())
                columns = [batch.column(c).slice(at, len(texts)) for c in (0, 1)] + [pa.array(c, t) for c, t in zip(zip(*out), types)]
                yield pa.RecordBatch.from_arrays(columns, names=["uid", "doc_id", "doc_tokens", "full", "rest", "rest_crc32", "rest_ids"])
                at += len(texts)
        own.forget()

    return rows


def encoded(docs: DataFrame, path: str, closing: int = 0, length: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token counts, checksums and the ids of the rest of every document, written to the shared folder."""
    at_workers(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return written(rows.mapInArrow(_encoded(path, closing, length), ENCODED), "encoded")


def slot_table(patterns: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, rank after the last, sequence of the first, offset) of every place in the patterns."""
    taken: dict[int, int] = {}
    out, sequence = [], 0
    for times, lengths in patterns:
        offset = 0
        for x in lengths:
            rank = taken.get(x, 0)
            out.append((x, rank, rank + times, sequence, offset))
            taken[x] = rank + times
            offset += x
        sequence += times
    return out


def powers(rest: int) -> list[int]:
    """Starts of the powers of two that ``rest`` is cut into, largest first."""
    out, at = [], 0
    for bit in reversed(range(rest.bit_length())):
        if rest >> bit & 1:
            out.append(at)
            at += 1 << bit
    return out


def pack(docs: DataFrame, path: str, length: int = 1024, closing: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    spark = docs.sparkSession
    known = encoded(docs, path, closing, length, id_col, text_col)
    narrow = known.select("uid", "doc_id", "doc_tokens", "rest", "rest_crc32", F.lit(0).alias("all"))
    counts = {r["rest"]: r["n"] for r in narrow.where("rest > 0").groupBy("rest").agg(F.count("*").alias("n")).collect()}  # fewer than `length` rows
    whole = known.agg(F.coalesce(F.sum(F.floor(F.col("doc_tokens") / length)), F.lit(0)).cast("long")).head()[0]
    patterns = cutting_stock.rounded(counts, length)
    slots = slot_table(patterns)
    after = whole + sum(times for times, _ in patterns)
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    full = numbered(known.where(F.size("full") > 0).select("uid", "doc_id", "doc_tokens", "full", F.size("full").alias("sequences"), F.lit(0).alias("all")), "all", ["uid"], "first", weight="sequences")
    full = full.select("doc_id", "doc_tokens", "first", F.posexplode("full").alias("i", "ids_crc32")).select(
        "doc_id", (F.col("i") * F.lit(length)).cast("long").alias("start"), F.lit(length).cast("long").alias("length"), "ids_crc32", "doc_tokens", (F.col("first") + F.col("i")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )

    ranked = numbered(narrow.where("rest > 0"), "rest", ["uid"], "rank")
    # each rank finds its place once, and the pieces below read it from there
    table = spark.createDataFrame(slots, "slot_length int, low long, high long, sequence long, slot_offset long")
    # at most length^2 / 2 places, however many documents there are
    placed = written(ranked.join(F.broadcast(table), (F.col("rest") == F.col("slot_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")), "left"), "placed")
    fitted = placed.where("sequence is not null").select(
        "doc_id", (F.col("doc_tokens") - F.col("rest")).alias("start"), F.col("rest").cast("long").alias("length"), F.col("rest_crc32").alias("ids_crc32"), "doc_tokens", (F.lit(whole) + F.col("sequence") + F.col("rank") - F.col("low")).alias("sequence_id"), F.col("slot_offset").alias("offset")
    )

    covered: dict[int, int] = {}
    for x, _, high, _, _ in slots:
        covered[x] = max(high, covered.get(x, 0))
    left = sum(x * (n - covered.get(x, 0)) for x, n in counts.items())
    tail = left - left % length
    starts = [tail + p for p in powers(left % length)]  # at most log2(length) of them
    over = numbered(placed.where("sequence is null").select("uid", "doc_id", "doc_tokens", "rest", "rest_crc32", "all"), "all", ["uid"], "at", weight="rest")
    end = F.col("at") + F.col("rest")
    inner = F.filter(F.transform(F.sequence(F.floor(F.col("at") / length), F.floor(end / length)), lambda x: x * length), lambda x: (x > F.col("at")) & (x < end))
    tails = F.filter(F.array(*(F.lit(s).cast("long") for s in starts)).cast("array<long>"), lambda x: (x > F.col("at")) & (x < end))
    cuts = over.withColumn("cuts", F.array_sort(F.array_distinct(F.concat(F.array("at", end), inner, tails))))
    pieces = cuts.withColumn("i", F.explode(F.sequence(F.lit(1), F.size("cuts") - 1))).select("uid", "doc_id", "doc_tokens", "rest", "rest_crc32", "at", F.col("cuts")[F.col("i") - 1].alias("a"), F.col("cuts")[F.col("i")].alias("b"))
    # the start of the sequence that position a lies in, and how many sequences lie before it
    before = F.size(F.filter(F.array(*(F.lit(s).cast("long") for s in starts)).cast("array<long>"), lambda x: x <= F.col("a"))) - 1
    in_tail = F.col("a") >= tail
    opens = F.when(in_tail, F.array_max(F.filter(F.array(*(F.lit(s).cast("long") for s in starts)).cast("array<long>"), lambda x: x <= F.col("a")))).otherwise(F.col("a") - F.col("a") % length)
    number = F.when(in_tail, F.lit(tail // length) + before).otherwise(F.floor(F.col("a") / length))
    laid = pieces.select(
        "uid", "doc_id", (F.col("doc_tokens") - F.col("rest") + F.col("a") - F.col("at")).alias("start"), (F.col("b") - F.col("a")).alias("length"), "rest", "rest_crc32", (F.col("a") - F.col("at")).cast("int").alias("skip"),
        "doc_tokens", (F.lit(after) + number).cast("long").alias("sequence_id"), (F.col("a") - opens).cast("long").alias("offset"),
    )
    intact = laid.where(F.col("length") == F.col("rest")).withColumn("ids_crc32", F.col("rest_crc32"))
    cut = laid.where(F.col("length") < F.col("rest")).join(known.select("uid", "rest_ids"), "uid").withColumn("ids_crc32", F.crc32(F.expr("substring(rest_ids, 4 * skip + 1, cast(4 * length as int))")))
    return full.select(out).unionByName(fitted.select(out)).unionByName(intact.select(out)).unionByName(cut.select(out))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
