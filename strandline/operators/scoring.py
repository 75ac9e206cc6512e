"""Scoring of variant records by a pluggable batched model.

Records meet transcripts by a stabbing join; every distinct input, with the
reference allele or an alternative, is scored once and joined back by its key.
A place's window of bases is gathered once, in the one stage that also judges
records and runs the models, and goes to Python once, with all alleles and
transcripts it is asked for; inputs are spelt out there, a few at a time. They
wait in a buffer for each length until a batch is full, whatever Arrow batch they
came in. Formatting is done by column expressions.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import alleles, scores
from strandline.operators import environment
from strandline.operators.intervals import nearest_of, stab
from strandline.sources import files

CONTEXT = 10_000
#: Bases that may wait in a task for a full batch.
HELD = 1 << 28
#: Bases of inputs that are spelt out at once.
FRAME = 1 << 22
#: Bytes of places in an Arrow batch. A task has a few such batches outside the heap at once, so Spark's own 64 MB is too much beside it.
BATCH = 8 << 20
BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
#: What ``predicted`` tells: the verdict of a reference allele at a place (without transcript), or the arrays of an input (without ``alt`` those of the reference).
TOLD = pa.schema([("contig", pa.string()), ("pos", pa.int64()), ("transcript", pa.int64()), ("ref", pa.string()), ("alt", pa.string()), ("skip_reason", pa.string()), ("acceptor", pa.list_(pa.float32())), ("donor", pa.list_(pa.float32()))])
TOLD_DDL = "contig string, pos long, transcript long, ref string, alt string, skip_reason string, acceptor array<float>, donor array<float>"
#: By byte: the four bytes of its one-hot code as one number, and the base on the other strand.
CODES, OTHER_STRAND = np.zeros((256, 4), np.uint8), np.zeros(256, np.uint8)
for _i, _base in enumerate(alleles.BASES):
    for _x, _y in ((_base, alleles.BASES[3 - _i]), (_base.lower(), alleles.BASES[3 - _i])):
        CODES[ord(_x), _i], OTHER_STRAND[ord(_x)] = 1, ord(_y)
CODES = CODES.view(np.uint32)[:, 0]


class Scorer(Protocol):
    """``predict([n, length, 4] uint8, batch_size, verbose) -> float32[n, length - CONTEXT, 3]``."""

    def predict(self, inputs: np.ndarray, batch_size: int, verbose: int) -> np.ndarray: ...


class StubScorer:
    """A deterministic stand-in for a model: bases have values; acceptor is the mean value within ``reach``, donor the value itself."""

    def __init__(self, weight: float = 1.0, reach: int = 3, context: int = CONTEXT):
        self.weight, self.reach, self.context = weight, reach, context

    def predict(self, inputs: np.ndarray, batch_size: int, verbose: int) -> np.ndarray:
        half, cov, reach = self.context // 2, inputs.shape[1] - self.context, self.reach
        near = inputs[:, half - reach : half + cov + reach].astype(np.float32) @ np.array([0.11, 0.23, 0.37, 0.05], np.float32)
        own = near[:, reach : reach + cov]
        mean = own
        for k in range(1, reach + 1):  # in pairs, so that both strands add alike
            mean = mean + (near[:, reach - k : reach - k + cov] + near[:, reach + k : reach + k + cov])
        acceptor = np.clip(mean / np.float32(2 * reach + 1) * np.float32(self.weight), 0, 1)
        return np.stack([1 - acceptor, acceptor, np.clip(own * np.float32(self.weight), 0, 1)], axis=2).astype(np.float32)


def one_hot(sequences: list[str], minus: np.ndarray | None = None) -> np.ndarray:
    """uint8[n, length, 4] of equally long sequences; anything but A, C, G, T is all zeros. Where ``minus`` is true, of the reverse complement."""
    spelt = np.frombuffer("".join(sequences).encode("latin-1", "replace"), np.uint8).reshape(len(sequences), -1)
    if minus is not None and minus.any():
        spelt = spelt.copy()
        spelt[minus] = OTHER_STRAND[spelt[minus][:, ::-1]]
    return CODES[spelt].view(np.uint8).reshape(*spelt.shape, 4)


def ensemble(models: list[Scorer], inputs: np.ndarray, batch_size: int) -> np.ndarray:
    """The models' mean prediction, summed in single precision in their order; counts and shapes must agree."""
    total = None
    for number, model in enumerate(models, 1):
        found = np.asarray(model.predict(inputs, batch_size=batch_size, verbose=0))
        if found.ndim == 0 or len(found) != len(inputs):
            raise RuntimeError(f"model {number} returned {0 if found.ndim == 0 else len(found)} predictions for {len(inputs)} inputs")
        if total is not None and found.shape != total.shape:
            raise RuntimeError(f"model {number} returned shape {found.shape}; expected {total.shape}")
        total = found.astype(np.float32) if total is None else total + found.astype(np.float32)
    if total is None:
        raise RuntimeError("no models")
    return total / np.float32(len(models))


def length_batches(frames: Iterator[pd.DataFrame], batch_size: int, bound: int = HELD) -> Iterator[pd.DataFrame]:
    """Rows of ``frames`` in batches of one length of ``sequence``, all of ``batch_size`` but the last of each length.

    Rows wait for their batch over any number of frames. Beyond ``bound`` bases that
    wait, which takes very many different lengths, the length that holds most is let go.
    """
    waiting: dict[int, list[pd.DataFrame]] = {}
    counts: dict[int, int] = {}
    for frame in frames:
        # neither groupby nor .str, whose cycles keep frames until the collector comes by
        lengths = np.array([len(x) for x in frame["sequence"]])
        for length in np.unique(lengths).tolist():
            some = frame[lengths == length]
            waiting.setdefault(length, []).append(some)
            counts[length] = counts.get(length, 0) + len(some)
            if counts[length] >= batch_size:
                every = pd.concat(waiting[length])
                full = len(every) - len(every) % batch_size
                # copies, for a slice would keep all of ``every``
                waiting[length], counts[length] = [every.iloc[full:].copy()], len(every) - full
                for at in range(0, full, batch_size):
                    yield every.iloc[at : at + batch_size].copy()
                del every
        while sum(n * c for n, c in counts.items()) > bound:
            most = max(counts, key=lambda n: n * counts[n])
            yield pd.concat(waiting.pop(most))
            del counts[most]
    for length in sorted(waiting):
        if counts[length]:
            yield pd.concat(waiting[length])


_bounding, _bounded = threading.Lock(), {}


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of ``BATCH`` bytes while any thread is within; then the session's own setting again."""
    with _bounding:
        inside, own = _bounded.get(spark, (0, None))
        if not inside:
            own = spark.conf.get(BATCH_KEY, None)
            spark.conf.set(BATCH_KEY, str(BATCH))
        _bounded[spark] = (inside + 1, own)
    try:
        yield
    finally:
        with _bounding:
            inside, own = _bounded.pop(spark)
            if inside > 1:
                _bounded[spark] = (inside - 1, own)
            elif own is None:
                spark.conf.unset(BATCH_KEY)
            else:
                spark.conf.set(BATCH_KEY, own)


def asked_of(places: pa.RecordBatch, half: int, bound: int = FRAME) -> Iterator[pd.DataFrame]:
    """What models are asked at ``places``, in frames of ``bound`` bases or one row more.

    A row for each transcript of a place where some reference allele fits, without
    ``alt``, and one for each of its alternatives to those that do. Bases outside the
    transcript are N.
    """
    columns = ["contig", "pos", "transcript", "ref", "alt", "minus", "sequence"]
    rows: list[tuple] = []
    bases = 0
    for i in range(places.num_rows):
        contig, pos, verdicts, items = (places.column(c)[i].as_py() for c in ("contig", "pos", "verdicts", "items"))
        fit = {v["ref"] for v in verdicts if v["skip_reason"] is None and v["ref"] is not None}
        changes: dict[tuple, list[tuple[str | None, str | None]]] = {}
        for x in items:
            if x["ref"] in fit:
                changes.setdefault((x["transcript"], x["strand"], x["start"], x["stop"]), [(None, None)]).append((x["ref"], x["alt"]))
        window = places.column("window")[i].as_py() if changes else ""
        for (transcript, strand, start, stop), wanted in changes.items():
            left, right = max(half + start + 1 - pos, 0), max(half + pos - stop, 0)
            padded = "N" * left + window[left : max(len(window) - right, 0)] + "N" * right
            for ref, alt in wanted:
                sequence = padded if alt is None else padded[:half] + alt + padded[half + len(ref) :]
                rows.append((contig, pos, transcript, ref, alt, strand == "-", sequence))
                bases += len(sequence)
                if bases >= bound:
                    yield pd.DataFrame(rows, columns=columns, dtype=object)
                    rows, bases = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=columns, dtype=object)


def predicted(places: DataFrame, load: Callable[[], list[Scorer]], batch_size: int, half: int) -> DataFrame:
    """Rows of ``TOLD`` for ``places``; models are loaded once a task. On the minus strand a model sees the reverse complement.

    ``places``: contig, pos, verdicts (array of ref, skip_reason), items (array of
    transcript, strand, start, stop, ref, alt) and window, with ``half`` bases before pos.
    """
    files.ship(places.sparkSession)

    def batch_of(columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n)).cast(f.type) for f in TOLD], schema=TOLD)

    def verdicts_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        every, at = batch.column("verdicts").flatten(), pc.list_parent_indices(batch.column("verdicts"))
        return batch_of({c: batch.column(c).take(at) for c in ("contig", "pos")} | {c: every.field(c) for c in ("ref", "skip_reason")}, len(every))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models: list[Scorer] = []
        passed: list[pa.RecordBatch] = []

        def frames() -> Iterator[pd.DataFrame]:
            for batch in batches:
                passed.append(verdicts_of(batch))
                yield from asked_of(batch, half)

        for part in length_batches(frames(), batch_size):
            if not models:
                environment.prepare()
                models = load()
            found = ensemble(models, one_hot(part["sequence"].tolist(), part["minus"].to_numpy(bool)), batch_size)
            ends = pa.array(np.arange(len(found) + 1) * found.shape[1], pa.int32())
            arrays = {name: pa.ListArray.from_arrays(ends, pa.array(found[:, :, k].ravel(), pa.float32())) for k, name in ((1, "acceptor"), (2, "donor"))}
            yield batch_of({f.name: pa.array(part[f.name].tolist(), f.type) for f in TOLD if f.name in part} | arrays, len(part))
            while passed:
                yield passed.pop()
        yield from passed

    return places.mapInArrow(run, TOLD_DDL)


def by_length(sequences: DataFrame, column: str = "sequence") -> DataFrame:
    """(length, n): how many inputs of each length a model would see."""
    return sequences.groupBy(F.length(column).cast("long").alias("length")).agg(F.count("*").alias("n"))


def computed_once(rows: DataFrame, key: list[str], compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rows`` joined with ``compute`` of their distinct keys."""
    return rows.join(compute(rows.select(*key).distinct()), key)


def windows(points: DataFrame, blocks: DataFrame, half: int, block_size: int) -> DataFrame:
    """``points`` (contig, pos and other columns, a row a place) with window: the bases from pos - half to pos + half, clipped at the contig's end; null if it begins before the contig.

    ``blocks``: contig, block, sequence of ``block_size`` bases each.
    """
    others = [c for c in points.columns if c not in ("contig", "pos")]
    first = F.col("pos") - 1 - half
    wanted = F.when(first >= 0, F.sequence(F.floor(first / block_size), F.floor((F.col("pos") - 1 + half) / block_size)))
    spread = points.withColumn("block", F.explode_outer(wanted))
    # each block is cut to what the window needs of it before anything is gathered
    low = F.greatest(first - F.col("block") * block_size, F.lit(0))
    high = F.least(first + 2 * half + 1 - F.col("block") * block_size, F.lit(block_size))
    cut = F.substring("sequence", (low + 1).cast("int"), (high - low).cast("int"))
    pieces = spread.join(blocks.select("contig", "block", "sequence"), ["contig", "block"], "left").select("contig", "pos", *others, F.when(F.col("sequence").isNotNull(), F.struct("block", cut.alias("bases"))).alias("piece"))
    gathered = pieces.groupBy("contig", "pos").agg(*(F.first(c).alias(c) for c in others), F.collect_list("piece").alias("pieces"))
    whole = F.array_join(F.transform(F.array_sort("pieces"), lambda x: x["bases"]), "")
    return gathered.select("contig", "pos", *others, F.when(first >= 0, whole).alias("window"))


def annotate(records: DataFrame, transcripts: DataFrame, blocks: DataFrame, load: Callable[[], list[Scorer]], distance: int = 50, mask: bool = False, batch_size: int = 16, block_size: int = 1 << 16, context: int = CONTEXT) -> DataFrame:
    """(line_no, skip_reason, annotation): entries of every record, by alternative and then transcript; null if nothing was scored.

    ``records``: line_no, contig, pos, ref, alts (array). ``transcripts``:
    transcript (number in file order), gene, contig, strand, start, stop,
    exon_starts, exon_stops. Contig names must agree.
    """
    if not 0 <= distance < context // 2:
        raise ValueError(f"distance must be between 0 and {context // 2 - 1}")
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    cov, width = 2 * distance + 1, context + 2 * distance + 1
    half = width // 2
    bounds = F.array_union(F.transform("exon_starts", lambda b: b + 1), F.col("exon_stops"))
    # a row for each record, alternative and transcript, without bases
    met = stab(records, transcripts).withColumn("exon", nearest_of(bounds, F.col("pos")).cast("int"))
    tasks = files.written(met.select("line_no", "contig", "pos", "ref", "transcript", "gene", "strand", "start", "stop", "exon", F.posexplode("alts").alias("alt_no", "alt")), "scoring-tasks")
    scorable = ~alleles.is_symbolic(F.col("alt")) & ~alleles.is_block_substitution(F.col("ref"), F.col("alt"))
    item = F.struct(F.col("transcript").cast("long").alias("transcript"), "strand", F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"), "ref", "alt")
    # a row a place: its reference alleles, which have a verdict each, and what the models are asked
    places = tasks.groupBy("contig", "pos").agg(F.collect_set(F.struct("ref")).alias("refs"), F.collect_set(F.when(scorable, item)).alias("items"))
    why = lambda ref: alleles.skip_reason(F.lit(True), F.lit(1), F.col("window"), ref, distance, context)
    judged = F.transform("refs", lambda r: F.struct(r["ref"].alias("ref"), why(r["ref"]).alias("skip_reason")))
    seen = windows(places, blocks, half, block_size).select("contig", "pos", judged.alias("verdicts"), "items", "window")
    with bounded_batches(records.sparkSession):
        told = files.written(predicted(seen, load, batch_size, half), "scoring-predictions")
    verdicts = told.where("transcript is null").select("contig", "pos", "ref", F.lit(True).alias("met"), F.col("skip_reason").alias("window_reason"))
    key = ["contig", "pos", "transcript"]
    fine = tasks.join(verdicts.where("window_reason is null").select("contig", "pos", "ref"), ["contig", "pos", "ref"])
    of_ref = told.where("transcript is not null and alt is null").select(*key, F.col("acceptor").alias("ref_acceptor"), F.col("donor").alias("ref_donor"))
    of_alt = told.where("transcript is not null and alt is not null").select(*key, "ref", "alt", F.col("acceptor").alias("alt_acceptor"), F.col("donor").alias("alt_donor"))
    # what models were asked has passed its verdict
    both = tasks.join(of_alt, [*key, "ref", "alt"]).join(of_ref, key)
    minus = F.col("strand") == "-"
    channel = lambda name: scores.channel_scores(scores.oriented(F.col(f"ref_{name}"), minus), scores.oriented(F.col(f"alt_{name}"), minus), cov, F.length("ref"), F.length("alt"))
    peaks = dict(zip(("ag", "al", "dg", "dl"), (*channel("acceptor"), *channel("donor"))))
    # peaks are columns first, so that no array is gone through twice
    found = both.select("line_no", "alt_no", "transcript", "alt", "gene", "exon", *(c.alias(name) for name, c in peaks.items()))
    scored = found.withColumn("entry", scores.score_entry(F.col("alt"), F.col("gene"), (F.col("ag"), F.col("al")), (F.col("dg"), F.col("dl")), cov, F.col("exon"), mask))
    passed = fine.where(~alleles.is_symbolic(F.col("alt")) & alleles.is_block_substitution(F.col("ref"), F.col("alt"))).withColumn("entry", alleles.unscored_entry(F.col("alt"), F.col("gene")))
    every = scored.select("line_no", "alt_no", "transcript", "entry").unionByName(passed.select("line_no", "alt_no", "transcript", "entry"))
    entries = every.groupBy("line_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("alt_no", "transcript", "entry"))), lambda x: x["entry"]), ",").alias("annotation"))
    judged_at = verdicts.withColumnsRenamed({"contig": "its_contig", "pos": "its_pos", "ref": "its_ref"})
    known = records.join(judged_at, (F.col("contig") == F.col("its_contig")) & (F.col("pos") == F.col("its_pos")) & F.col("ref").eqNullSafe(F.col("its_ref")), "left")
    skipped = F.when(~F.coalesce(F.size("alts") > 0, F.lit(False)), alleles.NO_ALTERNATIVE).when(F.col("met").isNull(), alleles.NO_TRANSCRIPT).otherwise(F.col("window_reason"))
    return known.select("line_no", skipped.alias("skip_reason")).join(entries, "line_no", "left")


def numbered_transcripts(annotations: DataFrame) -> DataFrame:
    """Annotations with ``transcript``: their line in the file, which orders a record's entries."""
    return annotations.withColumnsRenamed({"line_no": "transcript", "name": "gene"})
