"""Exact n-gram Jaccard self-join: size-banded tiles, bitmap bounds, exact intersections.

Two documents link when 100 |x & y| >= 75 |x | y| over their sets of distinct
five-word shingles. The join returns connected components and, for every row,
the exact number of other rows that it links with.

1.  Screening. Of a set of n shingles sorted by hash, a linked partner shares at
    least ``ceil(0.75 n)``. So among the first ``n - ceil(0.75 n) + l`` shingles
    at least about ``l`` occur in some other document. All documents send that
    part of their sets, as packed 32-bit keys, to shards of the hash space, whose
    number grows with the table; shards answer which keys occur more than once.
    Documents with too few are proven to have no partner and leave; no text or
    full set has been moved.
2.  Classes. Documents with equal sets become one class.
3.  Prefixes. Shingles are put in one order for all sets: by hash, but very common
    ones last, by the load of the counter (of a table of bounded size) that the
    shingle's hash falls on. A linked pair can't miss each other in the first
    quarter of both sets, so shingles that a large part of the corpus has (a
    licence line) hardly ever bring classes together.
4.  Anchors. Classes that share the smallest hash of those of their prefix shingles that
    occur elsewhere meet in buckets of bounded size and are linked by exact intersections, so that thousands of near copies
    become a few components at about one comparison each.
5.  Tiles. Classes meet in tiles of (shingle of the prefix, size band); a pair
    shares a prefix shingle if it links, and its sizes lie in one band or two
    that adjoin. Tiles whose classes are all of one component are dropped.
    In a tile the bit counts of hashed bitmaps bound a pair's overlap from
    above; only pairs that pass are intersected exactly. In the first rounds
    each component gets its most promising pair alone, so their rows follow the
    number of components and not that of their pairs; in the last,
    over what is still apart, every pair gets its test. Tiles of more than
    TILE classes are split into pairs of parts.
6.  Links. No link leaves a component, so all classes of a component meet in
    blocks of at most PART classes of one size band (or two that adjoin) and
    are intersected exactly. Only the number of links of a class leaves a block,
    weighted by the rows of the other classes.

Defined results: a null or empty text (or white space alone) has no shingles and
links with nothing. A text of fewer than five words is one shingle of all its
words. Equal texts are linked whatever their doc_ids; repeated rows each give a
row. A null doc_id is never the smallest of a component with other ids. Very long
texts are hashed alone. An empty table gives an empty result. Extra columns are
ignored or passed through. Rows are known by doc_id and text, never by their place.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.components import components
from strandline.llm.frames import UNKNOWN, at_workers, discard, label_of, read, release, rows_of, text_key, written
from strandline.llm.shingles import shingle_sets

#: Share of a set, beyond the prefix, that is screened as well; it changes what survives, never the links.
EXTRA = 0.15
#: Classes that one task compares with each other at most.
TILE = 2000
#: Classes in an anchor bucket at most.
BUCKET = 1000
#: Classes in an anchor bucket have about so many shingles at most.
BUCKET_TOKENS = 4_000_000
#: Rows whose ids may be broadcast (about 100 bytes each); beyond it a shuffle join is used.
BROADCAST_ROWS = 100_000
#: Documents and screened keys that a task packs together at most.
PACK, PACK_KEYS = 65_536, 8_000_000
#: Classes of one side of a block in which links are counted, and shingles of all of them, at about the most.
PART = 1000
PART_TOKENS = 4_000_000


def least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that a set of n shares with any partner at least."""
    return -(-percent * n // 100)


def needed(n: np.ndarray, percent: int) -> np.ndarray:
    return np.maximum(1, np.ceil(least_overlap(n, percent) * EXTRA)).astype(np.int64)


def screened(n: np.ndarray, percent: int) -> np.ndarray:
    return np.minimum(n, n - least_overlap(n, percent) + np.maximum(1, np.ceil(n * EXTRA)).astype(np.int64))


SCREEN = "shard int, batch long, docs binary, keys binary, labels binary, ids binary, sizes binary, digests binary"


def _dealt(shards: int, width: int, percent: int):
    """Packed keys by shard, and one row with the documents packed."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId() << 33, 0
        prefixes, sizes, digests, labels, ids, held = [], [], [], [], [], 0

        def packed() -> pa.RecordBatch:
            keys = np.concatenate(prefixes)
            docs = np.repeat(np.arange(len(prefixes), dtype=np.uint16), [len(p) for p in prefixes])
            shard = ((keys >> np.uint64(32)) & np.uint64(0xFFFFFFF)).astype(np.int64) % shards
            order = np.argsort(shard, kind="stable")
            ends = np.cumsum(np.bincount(shard, minlength=shards))
            keys, docs = keys.astype(np.uint32)[order], docs[order]
            out = {"shard": [], "batch": [], "docs": [], "keys": [], "labels": [], "ids": [], "sizes": [], "digests": []}

            def put(**own: object) -> None:
                for c in out:
                    out[c].append(own.get(c))

            put(shard=(part + count) % shards, batch=part + count, labels=np.array(labels, np.int64).tobytes(), ids=b"".join(ids), sizes=np.array(sizes, np.int64).tobytes(), digests=b"".join(digests))
            for s in np.unique(shard):
                a, b = (ends[s - 1] if s else 0), ends[s]
                put(shard=int(s), batch=part + count, docs=docs[a:b].tobytes(), keys=keys[a:b].tobytes())
            return pa.RecordBatch.from_arrays([pa.array(out[c], t) for c, t in zip(out, (pa.int32(), pa.int64(), *[pa.binary()] * 6))], names=list(out))

        for batch in batches:
            for label, key, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), shingle_sets(batch.column(2), width)):
                prefix = own[: int(screened(np.int64(len(own)), percent))]
                if prefixes and (len(prefixes) == PACK or held + len(prefix) > PACK_KEYS):
                    yield packed()
                    count += 1
                    prefixes, sizes, digests, labels, ids, held = [], [], [], [], [], 0
                prefixes.append(prefix.copy())
                sizes.append(len(own))
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                labels.append(label)
                ids.append(key)
                held += len(prefix)
        if prefixes:
            yield packed()

    return rows


def _answered(pdf: pd.DataFrame) -> pd.DataFrame:
    """For one shard: which documents hold keys that occur more than once, a document once for each key."""
    held = pdf["keys"].notna().to_numpy()
    blobs = pdf[held]
    keys = np.frombuffer(b"".join(blobs["keys"]), np.uint32)
    order = np.argsort(keys, kind="stable")
    run = keys[order]
    twice = np.zeros(len(run), bool)
    same = run[1:] == run[:-1]
    twice[1:] |= same
    twice[:-1] |= same
    shared = np.zeros(len(run), bool)
    shared[order] = twice
    at, docs = 0, []
    for blob in blobs["docs"]:
        own = np.frombuffer(blob, np.uint16)
        docs.append(own[shared[at : at + len(own)]].tobytes())
        at += len(own)
    return pd.concat([blobs.assign(docs=docs, keys=None), pdf[~held]])[["batch", "docs", "labels", "ids", "sizes", "digests"]]


def _judged(percent: int):
    def rows(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf[pdf["labels"].notna()].iloc[0]
        sizes = np.frombuffer(own["sizes"], np.int64)
        docs = np.frombuffer(b"".join(pdf["docs"].dropna()), np.uint16)
        shared = np.bincount(docs, minlength=len(sizes))
        split = lambda blob: [blob[16 * i : 16 * i + 16] for i in range(len(sizes))]
        return pd.DataFrame(
            {
                "label": np.frombuffer(own["labels"], np.int64), "key": split(own["ids"]), "n": sizes,
                "digest": split(own["digests"]), "near": (sizes > 0) & (shared >= needed(sizes, percent)),
            }
        )

    return rows


def screen(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """label, key (which row it is), n, digest of the set, near (may have a partner) of all rows."""
    # a shard holds the keys of about half a split of the table
    shards = max(32, 2 * docs.rdd.getNumPartitions())
    dealt = docs.select("label", "key", "text").mapInArrow(_dealt(shards, width, percent), SCREEN)
    answered = dealt.groupBy("shard").applyInPandas(_answered, "batch long, docs binary, labels binary, ids binary, sizes binary, digests binary")
    judged = answered.groupBy("batch").applyInPandas(_judged(percent), "label long, key binary, n long, digest binary, near boolean")
    return written(judged, "screened")


#: Counters of the table that orders shingles, as a power of two, at least and at most (one byte each when sent to tasks).
LEAST_BITS, MOST_BITS = 12, 22
#: Shingles whose counters bear so many times the average load come last; all others are in the order of their hashes.
HOT = 16


def loads(sets: DataFrame) -> np.ndarray:
    """For each of 2^k hash values, how many times the load of HOT average ones it bears, as a binary logarithm; 0 for all that bear less.

    k follows the number of shingles up to MOST_BITS, so a few megabytes at most
    are gathered and sent out. Any table gives right results; it sets an order.
    """
    total = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    bits = min(MOST_BITS, max(LEAST_BITS, int(total // 64).bit_length()))
    part = 1 << (bits - 6)
    common = HOT * max(1.0, total / (1 << bits))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            for blob in batch.column(0):
                np.add.at(table, np.frombuffer(blob.as_buffer(), np.uint64) & np.uint64((1 << bits) - 1), 1)
        held = np.flatnonzero(table)
        ends = np.searchsorted(held, np.arange(0, (1 << bits) + 1, part))
        for k in range(64):
            own = held[ends[k] : ends[k + 1]]
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([(own - k * part).astype(np.uint32).tobytes()], pa.binary()), pa.array([table[own].tobytes()], pa.binary())], names=["part", "at", "n"])

    def summed(pdf: pd.DataFrame) -> pd.DataFrame:
        table = np.zeros(part, np.int64)
        for at, n in zip(pdf["at"], pdf["n"]):
            table[np.frombuffer(at, np.uint32)] += np.frombuffer(n, np.uint32)
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "load": [np.ceil(np.log2(np.maximum(table / common, 1))).astype(np.uint8).tobytes()]})

    found = sets.select("tokens").mapInArrow(counted, "part int, at binary, n binary").groupBy("part").applyInPandas(summed, "part int, load binary").collect()  # 2^MOST_BITS bytes at most
    out = np.zeros(1 << bits, np.uint8)
    for r in found:
        out[r["part"] * part : (r["part"] + 1) * part] = np.frombuffer(r["load"], np.uint8)
    return out


def _sets(width: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                sets = list(shingle_sets(some.column(1), width))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "n", "tokens"]
                )

    return rows


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct values."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def links(a: int, b: int, shared: int, percent: int) -> bool:
    return 100 * shared >= percent * (a + b - shared)


def bitmap(tokens: np.ndarray, width: int) -> np.ndarray:
    bits = np.zeros(width, bool)
    bits[(tokens & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits)


def pivoted(sets: list[np.ndarray], percent: int, idle: int = 64) -> np.ndarray:
    """For each set, the smallest position it is linked with through pivots.

    Sets are pivots in turn, those whose shingles are most common first, for
    that is what the original of many near copies looks like; a pivot is
    intersected with all sets at once. It ends after ``idle`` pivots in a row
    that merge nothing. Every link is exact; what is missed, tiles find.
    """
    sizes = np.array([len(s) for s in sets])
    values, inverse, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    starts = np.cumsum(sizes) - sizes
    common = np.add.reduceat(times[inverse], starts) / sizes
    root, unused = np.arange(len(sets)), 0
    for k in np.argsort(-common, kind="stable"):
        mark = np.zeros(len(values), np.int64)
        mark[inverse[starts[k] : starts[k] + sizes[k]]] = 1
        shared = np.add.reduceat(mark[inverse], starts)
        near = np.unique(root[100 * shared >= percent * (sizes + sizes[k] - shared)])
        if len(near) > 1:
            root[np.isin(root, near)] = near[0]
            unused = 0
        else:
            unused += 1
            if unused == idle:
                break
    return root


def _bucket(percent: int):
    """Links classes of one bucket into components."""

    def rows(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        nodes = pdf["node"].to_numpy()
        root = pivoted([np.frombuffer(b, np.uint64) for b in pdf["tokens"]], percent) if len(nodes) > 1 else np.zeros(len(nodes), np.int64)
        return pd.DataFrame({"node": nodes, "root": nodes[root]})

    return rows


def anchored(sets: DataFrame, percent: int) -> DataFrame:
    """(node, root): components among classes whose smallest shingle that others have as well is the same.

    Buckets of more than BUCKET classes or BUCKET_TOKENS shingles are dealt into parts; what is left of
    them meets again as long as a tenth of it merges. The sets are sent once to
    their bucket, and again only for such buckets.
    """
    roots, left = None, sets.select("node", "anchor", "n", "tokens")
    while True:
        parts = F.greatest(F.ceil(F.count("*") / BUCKET), F.ceil(F.sum("n") / BUCKET_TOKENS))
        counts = written(left.groupBy("anchor").agg(F.count("*").alias("m"), parts.alias("parts")).where("m > 1" if roots is None else "parts > 1"), "buckets")
        rows = counts.agg(F.coalesce(F.sum("m"), F.lit(0))).head()[0]
        if not rows:
            break
        dealt = left.join(counts, "anchor").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
        found = written(dealt.groupBy("anchor", "part").applyInPandas(_bucket(percent), "node long, root long").where("node <> root"), "anchored")
        again = found.select(F.col("node").alias("root"), F.col("root").alias("top"))
        roots = found if roots is None else written(roots.join(again, "root", "left").select("node", F.coalesce("top", "root").alias("root")).unionByName(found), "roots")
        if found.count() * 10 < rows:
            break
        left = left.join(found.select("node"), "node", "left_anti")
    return roots if roots is not None else sets.select("node", F.col("node").alias("root")).limit(0)


def _band(n: np.ndarray, percent: int) -> np.ndarray:
    """Number of the size band: a partner's sizes are at most 100 / percent apart, so in the same band or the next."""
    return np.floor(np.log(np.maximum(n, 1)) / np.log(100 / percent) + 1e-9).astype(np.int32)


def _width(band: int, percent: int) -> int:
    """Bits of the signatures in a band: about twice its largest size, so that half of them stay clear."""
    return 1 << int(np.ceil(np.log2(max(64, 2 * (100 / percent) ** (band + 1)))))


def _postings(percent: int, table: Broadcast):
    """A row for every prefix shingle of every class. The prefix, very common shingles last, is what a linked pair can't miss."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load = table.value
        mask = np.uint64(len(load) - 1)
        for batch in batches:
            nodes, sizes = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            for at in range(0, len(nodes), 512):
                prefixes, orders = [], []
                for blob in batch.column(2)[at : at + 512]:
                    tokens = np.frombuffer(blob.as_buffer(), np.uint64)
                    own = load[tokens & mask]
                    order = np.argsort(own, kind="stable")[: len(tokens) - int(least_overlap(np.int64(len(tokens)), percent)) + 1]  # tokens are sorted by hash
                    prefixes.append(tokens[order].view(np.int64))
                    orders.append(own[order].astype(np.int16))
                some = slice(at, at + len(prefixes))
                k = [len(p) for p in prefixes]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(prefixes)), pa.array(np.concatenate(orders)), pa.array(np.repeat(nodes[some], k)), pa.array(np.repeat(sizes[some], k)), pa.array(np.repeat(_band(sizes[some], percent), k)), pa.array(np.concatenate([np.arange(m, dtype=np.int32) for m in k]))],
                    names=["token", "load", "node", "n", "band", "pos"],
                )

    return rows


def _signatures(percent: int):
    """Hashed bitmaps of every class, for the tiles of its own band and of the next."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            bands = _band(batch.column(1).to_numpy(zero_copy_only=False), percent)
            for node, blob, band in zip(batch.column(0).to_pylist(), batch.column(2), bands):
                tokens = np.frombuffer(blob.as_buffer(), np.uint64)
                out += [(node, int(t), bitmap(tokens, _width(t, percent)).tobytes()) for t in (band, band + 1)]
            for at in range(0, len(out), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[at : at + 4096]), (pa.int64(), pa.int32(), pa.binary()))], names=["node", "tile_band", "bits"])

    return rows


def mixed_only(rows: DataFrame) -> DataFrame:
    """Postings of shingles that classes of several components have: the others can link nothing new.

    Components are compared by a map-side aggregate, so a common shingle costs one row a task.
    """
    several = rows.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("token")
    return rows.join(several, "token", "left_semi")


#: From a tile: the pair (a, b) of the highest bound for a component, or a class with all those it may be linked with.
PAIRS_DDL = "a long, b long, comp_a long, comp_b long, bound long"
LISTS_DDL = "a long, others array<bigint>"


def _pairs_of(starts: np.ndarray, ends: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs (k, j), k < j, of rows of the same tile, in pieces of about ``most``."""
    row_end = np.repeat(ends, ends - starts)
    row = np.concatenate([np.arange(a, b) for a, b in zip(starts, ends)]) if len(starts) else np.zeros(0, np.int64)
    count = row_end - row - 1
    total = np.cumsum(count)
    at = 0
    while at < len(row):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
        n = count[at:stop]
        k = np.repeat(row[at:stop], n)
        j = k + 1 + np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)
        yield k, j
        at = stop


def once(pairs: np.ndarray, x: int, y: int) -> np.ndarray:
    """The first column of each run of equal values in rows ``x`` and ``y``."""
    first = np.ones(pairs.shape[1], bool)
    first[1:] = (pairs[x, 1:] != pairs[x, :-1]) | (pairs[y, 1:] != pairs[y, :-1])
    return pairs[:, first]


def best_of(pairs: np.ndarray) -> np.ndarray:
    """Of the pairs (a, b, comp_a, comp_b, bound) those that are the one of the highest bound for either component: at most one a component."""
    comp, at = np.concatenate([pairs[2], pairs[3]]), np.tile(np.arange(pairs.shape[1]), 2)
    order = np.lexsort((pairs[1, at], pairs[0, at], -pairs[4, at], comp))
    first = np.unique(comp[order], return_index=True)[1]
    return pairs[:, np.unique(at[order[first]])]


#: Rounds of one pair a component go on as long as more than one in AGAIN pairs links; it changes what is left to the last round, never the links.
AGAIN = 5
#: Pairs that a task holds before it tells the best ones.
HELD = 1_000_000


def _tiles(percent: int, single: bool):
    """Candidate pairs of tiles. Rows come sorted by tile; a tile may go over several batches."""
    key = ["token", "tile_band", "i", "j"]

    def done(frame: pa.Table) -> Iterator[np.ndarray | pa.RecordBatch]:
        own, side, nodes, comps, sizes, pos, band, left, right = (frame.column(c).to_numpy() for c in ("own", "side", "node", "comp", "n", "pos", "tile_band", "i", "j"))
        rest = sizes - pos
        keys = np.stack([frame.column(c).to_numpy().astype(np.int64) for c in key])
        starts = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(0)]))
        ends = np.concatenate([starts[1:], [len(nodes)]])
        several = ends - starts > 1
        starts, ends = starts[several], ends[several]
        blobs = frame.column("bits").combine_chunks()
        for width in np.unique(band[starts]):
            of = band[starts] == width
            # rows of these tiles hold bitmaps of one width
            rows = np.concatenate([np.arange(a, b) for a, b in zip(starts[of], ends[of])])
            words = np.frombuffer(b"".join(blobs.take(pa.array(rows)).to_pylist()), np.uint64).reshape(len(rows), -1)
            place = np.zeros(len(nodes), np.int64)
            place[rows] = np.arange(len(rows))
            out = []
            for k, j in _pairs_of(starts[of], ends[of]):
                fits = (comps[k] != comps[j]) & (own[k] | own[j]) & (percent * sizes[k] <= 100 * sizes[j]) & (percent * sizes[j] <= 100 * sizes[k]) & ((left[k] == right[k]) | (side[k] != side[j]))
                # a linked pair passes at its first common shingle: from there on both sets must have enough left
                fits &= (100 + percent) * np.minimum(rest[k], rest[j]) >= percent * (sizes[k] + sizes[j])
                k, j = k[fits], j[fits]
                for at in range(0, len(k), 1 << 16):
                    x, y = k[at : at + (1 << 16)], j[at : at + (1 << 16)]
                    total = sizes[x] + sizes[y]
                    bound = (total - np.bitwise_count(words[place[x]] ^ words[place[y]]).sum(1, dtype=np.int64)) // 2
                    good = 100 * bound >= percent * (total - bound)
                    if good.any():
                        x, y, bound = x[good], y[good], bound[good]
                        swap = comps[y] < comps[x]
                        a, b = np.where(swap, y, x), np.where(swap, x, y)
                        out.append(np.stack([nodes[a], nodes[b], comps[a], comps[b], bound]))
            if out:
                pairs = np.concatenate(out, axis=1)
                pairs = best_of(pairs) if single else once(pairs[:, np.lexsort((pairs[1], pairs[0]))], 0, 1)
                if single:
                    yield pairs
                else:
                    heads, at = np.unique(pairs[0], return_index=True)
                    lists = pa.ListArray.from_arrays(pa.array([*at, pairs.shape[1]], pa.int32()), pa.array(pairs[1]))
                    yield pa.RecordBatch.from_arrays([pa.array(heads), lists], names=["a", "others"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: pa.Table | None = None
        for batch in batches:
            frame = pa.Table.from_batches([batch])
            if held is not None:
                frame = pa.concat_tables([held, frame])
            last = np.ones(len(frame), bool)
            for c in key:
                values = frame.column(c).to_numpy()
                last &= values == values[-1]
            at = int(last.argmax())
            held = frame.slice(at)
            if at:
                yield frame.slice(0, at)
        if held is not None and len(held):
            yield held

    def told(pairs: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in pairs], names=["a", "b", "comp_a", "comp_b", "bound"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not single:
            for frame in cut(batches):
                yield from done(frame)
            return
        # tiles of a task tell of the same components again and again
        some, n = [], 0
        for frame in cut(batches):
            for pairs in done(frame):
                some.append(pairs)
                n += pairs.shape[1]
            if n > HELD:
                some = [best_of(np.concatenate(some, axis=1))]
                n = some[0].shape[1]
                if n > HELD // 2:
                    yield told(some[0])
                    some, n = [], 0
        if n:
            yield told(best_of(np.concatenate(some, axis=1)))

    return rows


def candidates(kept: DataFrame, signatures: DataFrame, percent: int, single: bool) -> DataFrame:
    """Pairs of classes of different components that tiles and bitmaps can't rule out.

    ``kept``: token, node, n, band, pos, comp of shingles in several components. With
    ``single``, each component has its pair of the highest bound alone, so that a group
    of many components gives no more pairs than it has components.
    """
    spread = kept.withColumn("own", F.explode(F.array(F.lit(True), F.lit(False)))).withColumn("tile_band", F.col("band") + F.when(F.col("own"), 0).otherwise(1))
    tile = ["token", "tile_band"]
    counts = spread.groupBy(*tile).agg(F.count("*").alias("m"), F.max("own").alias("owned"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("owned and low < high")
    parts = counts.select(*tile, F.ceil(F.col("m") / TILE).cast("int").alias("parts"))
    side = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    rows = (
        spread.join(parts, tile)
        .withColumn("side", side)
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .join(signatures, ["node", "tile_band"])
        .select(*tile, F.least("side", "k").alias("i"), F.greatest("side", "k").alias("j"), "side", "own", "node", "comp", "n", "pos", "bits")
    )
    key = [*tile, "i", "j"]
    tiles = rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(_tiles(percent, single), PAIRS_DDL if single else LISTS_DDL)
    if single:
        ends = tiles.select(F.explode(F.array("comp_a", "comp_b")).alias("comp"), F.struct("bound", "a", "b").alias("pair"))
        return ends.groupBy("comp").agg(F.max("pair").alias("best")).select("best.a", "best.b").distinct()
    # tiles that share a pair tell it again and again: lists of a class are joined before pairs are spelt out
    return tiles.groupBy("a").agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("others")).select("a", F.explode("others").alias("b"))


def _verified(percent: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                keep.append(links(len(x), len(y), overlap(x, y), percent))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return rows


def verified(pairs: DataFrame, sets: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) between the components of pairs whose sorted arrays intersect enough."""
    tokens = sets.select("node", "tokens")
    own = pairs.join(tokens.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a").join(tokens.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
    linked = own.select("a", "b", "x", "y").mapInArrow(_verified(percent), "a long, b long")
    for end in ("a", "b"):
        top = comps.select(F.col("node").alias(end), F.col("root").alias("top"))
        linked = linked.join(top, end, "left").withColumn(end, F.coalesce("top", end)).drop("top")
    return written(linked.select("a", "b").where("a <> b").distinct(), "edges")


def merged(comps: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root) after ``edges`` between roots are taken in."""
    tops = components(edges).select(F.col("node").alias("root"), F.col("root").alias("top"))
    old = comps.join(tops, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    # a root that was merged away is itself a node with a new root
    new = tops.where(F.col("root") != F.col("top")).select(F.col("root").alias("node"), F.col("top").alias("root"))
    return written(old.unionByName(new), "comps")


def linked_rows(sets: list[np.ndarray], weights: np.ndarray, sides: np.ndarray, across: bool, percent: int) -> np.ndarray:
    """For each set, the weights of the other sets it links with; with ``across``, of those on another side."""
    sizes = np.array([len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row, common = np.repeat(np.arange(len(sets)), sizes), times[column] > 1
    row, column = row[common], (np.cumsum(times > 1) - 1)[column[common]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)  # whole numbers up to 2^24 are exact
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, (low, low + 4096))
        held = np.zeros((len(sets), min(4096, int(column[b - 1]) + 1 - low)), np.float32)
        held[row[a:b], column[a:b] - low] = 1
        shared += held @ held.T
    shared = shared.astype(np.int64)
    met = 100 * shared >= percent * (sizes[:, None] + sizes - shared)
    if across:
        met &= sides[:, None] != sides
    np.fill_diagonal(met, False)
    return met.astype(np.int64) @ weights


def _block(percent: int):
    """Counts the links in one block, which holds a part or two of a large component, or whole small ones."""

    def rows(pdf: pd.DataFrame) -> pd.DataFrame:
        across = bool((pdf["step"] > 0).iloc[0] or (pdf["i"] != pdf["j"]).iloc[0])
        found = []
        for _, own in pdf.groupby("root"):
            if len(own) > 1:
                others = linked_rows([np.frombuffer(b, np.uint64) for b in own["tokens"]], own["rows"].to_numpy(), own["side"].to_numpy(), across, percent)
                found.append(pd.DataFrame({"node": own["node"].to_numpy(), "others": others}))
        return pd.concat(found) if found else pd.DataFrame({"node": np.zeros(0, np.int64), "others": np.zeros(0, np.int64)})

    return rows


def link_counts(sets: DataFrame, comps: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(node, others): rows of other classes that a class links with, for the classes of components of several."""
    rooted = sets.select("node", "n").join(comps, "node", "left").select("node", "n", F.coalesce("root", "node").alias("root")).join(classes.select("node", "rows"), "node")
    groups = rooted.groupBy("root").agg(F.count("*").alias("m"), F.sum("n").alias("total")).where("m > 1")
    large = (F.col("m") > PART) | (F.col("total") > PART_TOKENS)
    band = F.floor(F.log(F.greatest("n", F.lit(1)).cast("double")) / math.log(100 / percent) + 1e-9).cast("int")
    own = written(rooted.join(groups, "root").withColumn("large", large).withColumn("band", band).drop("m", "total"), "members")
    parts = F.greatest(F.ceil(F.count("*") / PART), F.ceil(F.sum("n") / PART_TOKENS)).cast("int")
    units = own.where("large").groupBy("root", "band").agg(parts.alias("parts"))
    after = units.select("root", (F.col("band") - 1).alias("band"), F.col("parts").alias("parts_after"))
    before = units.select("root", (F.col("band") + 1).alias("band"), F.col("parts").alias("parts_before"))
    placed = own.where("large").join(units, ["root", "band"]).join(after, ["root", "band"], "left").join(before, ["root", "band"], "left").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))

    def at(key, lower, step, i, j, side):
        return F.struct(key.cast("long").alias("key"), lower.cast("int").alias("lower"), F.lit(step).alias("step"), i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("side"))

    def each(count, block):
        return F.when(F.col(count) > 0, F.transform(F.sequence(F.lit(0), F.col(count) - 1), block)).otherwise(F.array().cast("array<struct<key:bigint,lower:int,step:int,i:int,j:int,side:int>>"))

    root, low, part = F.col("root"), F.col("band"), F.col("part")
    same = each("parts", lambda k: at(root, low, 0, F.least(part, k), F.greatest(part, k), part))
    up = each("parts_after", lambda k: at(root, low, 1, part, k, F.lit(0)))
    down = each("parts_before", lambda k: at(root, low - 1, 1, k, part, F.lit(1)))
    small = own.where("not large").agg(F.count("*").alias("m"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).head()
    bundles = max(1, small["m"] // PART, small["total"] // PART_TOKENS)
    nothing = F.lit(0)
    few = own.where("not large").withColumn("block", at(F.pmod(F.xxhash64("root"), F.lit(bundles)), F.lit(-1), 0, nothing, nothing, nothing))
    dealt = placed.withColumn("block", F.explode(F.concat(same, up, down))).select("node", "root", "rows", "block.*").unionByName(few.select("node", "root", "rows", "block.*"))
    blocks = dealt.join(sets.select("node", "tokens"), "node")
    found = blocks.groupBy("key", "lower", "step", "i", "j").applyInPandas(_block(percent), "node long, others long")
    return written(found.groupBy("node").agg(F.sum("others").alias("others")), "link-counts")


def grouped(docs: DataFrame, width: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text", counted: bool = True) -> tuple[DataFrame, DataFrame]:
    """All rows of ``docs`` (label, key, n, digest) and the classes of equal sets (digest, first, root, head, n_links).

    ``first`` is the class's first row (label, key) and ``head`` that of its
    component; ``n_links`` counts the other rows that a row of the class links
    with, and is null unless ``counted``.
    """
    spark = docs.sparkSession
    at_workers(spark)
    text = F.col(text_col).cast("string")
    rows = docs.select(label_of(F.col(id_col)).alias("label"), text_key(text).alias("key"), text.alias("text"))
    known = screen(rows, width, percent)
    classes = known.where("n > 0").groupBy("digest").agg(F.min(F.struct("label", "key")).alias("first"), F.max("near").alias("near"), F.count("*").alias("rows"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")  # numbers that stay, for they are written
    chosen = classes.where("near").select("first.label", "first.key", "node")
    # the ids of the classes that are left: sent to every task only if they are few, joined by a shuffle otherwise
    few = F.broadcast(chosen) if chosen.count() <= BROADCAST_ROWS else chosen
    own = rows.join(few, ["label", "key"]).dropDuplicates(["label", "key"]).select("node", "text")
    sets = written(own.mapInArrow(_sets(width), "node long, n long, tokens binary"), "sets")
    release(spark)
    table = spark.sparkContext.broadcast(loads(sets))
    posted = written(sets.select("node", "n", "tokens").mapInArrow(_postings(percent, table), "token long, load short, node long, n long, band int, pos int"), "postings")
    table.destroy()
    signatures = sets.select("node", "n", "tokens").mapInArrow(_signatures(percent), "node long, tile_band int, bits binary")
    kept = written(mixed_only(posted.withColumn("comp", F.col("node"))).drop("comp"), "kept")
    discard(posted)
    anchors = kept.groupBy("node").agg(F.min("token").alias("anchor"))  # by hash alone: near copies agree in it most likely
    comps = anchored(sets.join(anchors, "node"), percent)
    single = True
    while True:
        labelled = kept.join(comps, "node", "left").select("token", "node", "n", "band", "pos", F.coalesce("root", "node").alias("comp"))
        left = written(mixed_only(labelled), "kept")  # a round needs no more than what the one before it keeps
        discard(kept)
        pairs = written(candidates(left, signatures, percent, single), "pairs")
        edges = verified(pairs, sets, comps, percent)
        kept, found = left, edges.count()
        if found:
            comps = merged(comps, edges)
        last, single = not single, AGAIN * found > pairs.count()
        discard(pairs)
        release(spark)
        if last:
            break
    others = link_counts(sets, comps, classes, percent) if counted else None
    links_of = F.lit(None).cast("long") if others is None else F.coalesce("others", F.lit(0)) + F.col("rows") - 1
    rooted = classes.join(comps, "node", "left")
    rooted = (rooted if others is None else rooted.join(others, "node", "left")).select("digest", "first", F.coalesce("root", "node").alias("root"), "rows", links_of.alias("n_links"))
    heads = rooted.groupBy("root").agg(F.min("first").alias("head"))
    found = written(rooted.join(heads, "root"), "components")
    discard(kept, sets, classes)
    release(spark)
    return known, found


#: A class of more than one in SHARE rows is sent to all tasks; there are at most SHARE of them.
SHARE = 10_000


def by_row(known: DataFrame, classes: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links of every row."""
    large = F.col("rows") * SHARE > known.count()
    columns = ("digest", "head", "n_links")
    hot = classes.where(large).select(F.col("digest"), F.col("head").alias("hot_head"), F.col("n_links").alias("hot_links"))  # fewer than SHARE rows
    told = known.join(F.broadcast(hot), "digest", "left")
    rest = told.where("hot_head is null").drop("hot_head", "hot_links").join(classes.where(~large).select(*columns), "digest", "left")
    every = told.where("hot_head is not null").withColumnsRenamed({"hot_head": "head", "hot_links": "n_links"}).unionByName(rest)
    label = lambda c: F.when(c != UNKNOWN, c)
    # without shingles there is no class, and the row is its own component
    return every.select(label(F.col("label")).alias("doc_id"), F.col("n").alias("n_shingles"), label(F.coalesce("head.label", "label")).alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, n_links (other rows it links with) of every row."""
    return by_row(*grouped(docs, width, percent, id_col, text_col))


def first_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs``, all columns, for each component of near duplicates; all rows without words."""
    heads = grouped(docs, id_col=id_col, text_col=text_col, counted=False)[1].where(F.col("first") == F.col("head")).select("first.label", "first.key")
    worded = F.coalesce(F.col(text_col).cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return rows_of(docs.where(worded), heads, id_col, text_col).unionByName(docs.where(~worded))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


#: By definition: shared shingles of all pairs of rows, links, and what each row reaches through them.
ORACLE = r"""
with recursive words as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
sets as materialized (
  select r, doc_id,
    case when len(w) >= 5 then list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
         when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s
  from words),
shingles as materialized (select r, len(s) as n, unnest(s) as g from sets),
shared as (
  select a.r as x, b.r as y, a.n as nx, b.n as ny, count(*) as c
  from shingles a join shingles b on a.g = b.g and a.r < b.r
  group by all),
linked as materialized (select x, y from shared where 100 * c >= 75 * (nx + ny - c)),
links as materialized (select x, y from linked union all select y, x from linked),
reached(r, y) as (
  select r, r from sets
  union
  select reached.r, links.y from reached join links on reached.y = links.x),
heads as (select reached.r, min(sets.doc_id) as component_id from reached join sets on sets.r = reached.y group by reached.r),
counts as (select x as r, count(*) as n_links from links group by x)
select cast(doc_id as bigint) as doc_id, cast(len(s) as bigint) as n_shingles, cast(component_id as bigint) as component_id, cast(coalesce(n_links, 0) as bigint) as n_links
from sets join heads using (r) left join counts using (r)
"""
