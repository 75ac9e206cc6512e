"""Block-compressed files, sequence files by offset, shards and runs, on small files."""

import gzip
import json
import random
import struct
import threading
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline import cli
from strandline.operators import scoring
from strandline.plans import jobs, runner, shards
from strandline.sources import bgzf, fasta, files, readers, writers

HEAD = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n"


def blocks_file(path, text: bytes, rnd, most=400):
    """A file of blocks of random sizes, some of them empty."""
    at, out = 0, []
    while at < len(text):
        n = rnd.choice([0, 1, rnd.randint(1, most)])
        out.append(bgzf.packed(text[at : at + n]))
        at += n
    Path(path).write_bytes(b"".join(out) + bgzf.END)


@pytest.mark.parametrize("seed", range(40))
def test_lines_of_every_range(tmp_path, seed):
    rnd = random.Random(seed)
    lines = [bytes(rnd.choice(b"abc") for _ in range(rnd.choice([0, 0, 3, 90, 700]))) for _ in range(rnd.randint(0, 60))]
    text = b"\n".join(lines) + (b"\n" if rnd.random() < 0.7 else b"")
    path = str(tmp_path / "x.gz")
    blocks_file(path, text, rnd)
    size = files.size_of(path)
    assert gzip.open(path).read() == text
    want = text.split(b"\n")
    want = want[:-1] if want[-1] == b"" else want
    with files.opened(path) as file:
        whole = list(bgzf.lines_between(file, 0, size, size, path))
        assert [x[2] for x in whole] == want
        for step in (1, 37, 500, size):
            assert [x for a in range(0, size, step) for x in bgzf.lines_between(file, a, min(a + step, size), size, path)] == whole
        for a, b in [sorted(rnd.sample(range(len(whole)), 2)) for _ in range(10) if len(whole) > 2]:
            span = [o << 16 | w for o, w, _ in (whole[a], whole[b])]
            assert list(bgzf.lines_of_run(file, *span, size, path)) == whole[a:b]


def test_blocks_are_read_in_parallel_with_line_numbers(spark, tmp_path, monkeypatch):
    lines = [f"line {i}" * (i % 4) for i in range(3000)]
    path = str(tmp_path / "x.vcf.gz")
    blocks_file(path, ("\r\n".join(lines) + "\r\n").encode(), random.Random(1), 3000)
    rows = bgzf.numbered(spark, path, 1 << 10)
    assert bgzf.lines(spark, path, 1 << 10).rdd.getNumPartitions() == -(-files.size_of(path) // 1024) > 3
    assert [r["value"] for r in rows.orderBy("line_no").collect()] == lines
    assert sorted(r["line_no"] for r in readers.numbered_lines(spark, path).collect()) == list(range(1, 3001))
    with gzip.open(tmp_path / "one.gz", "wt") as out:  # one member: not blocks
        out.write("a\nb\n")
    assert [r["value"] for r in readers.numbered_lines(spark, str(tmp_path / "one.gz")).orderBy("line_no").collect()] == ["a", "b"]


def test_cut_and_damaged_files_are_errors(spark, tmp_path):
    path = tmp_path / "x.vcf.gz"
    blocks_file(path, b"some text\n" * 4000, random.Random(2), 3000)
    whole = path.read_bytes()
    for cut in (whole[:-28], whole[:-40], whole[: len(whole) // 2]):
        path.write_bytes(cut)
        with pytest.raises(Exception, match="cut|damaged"):
            bgzf.numbered(spark, str(path), 1 << 10).count()
    path.write_bytes(whole[:200] + bytes([whole[200] ^ 255]) + whole[201:])
    with pytest.raises(Exception, match="cut|damaged|no block"):
        bgzf.numbered(spark, str(path), 1 << 10).count()


def records_of(rnd, n):
    rows = sorted((rnd.choice(["1", "2", "X"]), rnd.randint(1, 400_000), "A" * rnd.choice([1, 1, 1, 5, 30_000])) for _ in range(n))
    return [(i, c, p, ref) for i, (c, p, ref) in enumerate(rows)]


def write_records(spark, rows, path, indexed=True):
    df = spark.createDataFrame(rows, "line_no long, chrom string, pos long, ref string").repartition(7)
    full = df.select("*", F.col("line_no").cast("string").alias("id"), *(F.lit(".").alias(c) for c in ("alt", "qual", "filter", "info")))
    return writers.write_vcf(full, path, HEAD.splitlines(), indexed=indexed)


def test_one_file_in_order_without_the_driver(spark, tmp_path):
    rows = records_of(random.Random(3), 500)
    text = HEAD + "".join(f"{c}\t{p}\t{i}\t{ref}\t.\t.\t.\t.\n" for i, c, p, ref in rows)
    for name, read in (("a.vcf", lambda p: p.read_text()), ("b.vcf.gz", lambda p: gzip.decompress(p.read_bytes()).decode())):
        wrote = write_records(spark, rows, str(tmp_path / name), name.endswith("gz"))
        assert read(tmp_path / name) == text and wrote.lines == 500 and wrote.bytes == (tmp_path / name).stat().st_size
    write_records(spark, [], str(tmp_path / "none.vcf.gz"))
    assert gzip.decompress((tmp_path / "none.vcf.gz").read_bytes()).decode() == HEAD
    assert not [p for p in tmp_path.iterdir() if p.name.startswith(".")]
    before = (tmp_path / "b.vcf.gz").read_bytes()
    broken = spark.createDataFrame(rows, "line_no long, chrom string, pos long, ref string").select("line_no", F.when(F.col("line_no") == 499, F.raise_error(F.lit("stop"))).otherwise("x").cast("string").alias("line"))
    with pytest.raises(Exception, match="stop"):
        writers.write_lines(broken, ["line_no"], str(tmp_path / "b.vcf.gz"))
    assert (tmp_path / "b.vcf.gz").read_bytes() == before
    assert not [p for p in tmp_path.iterdir() if p.name.startswith(".")]


def test_the_index_names_the_blocks_of_a_range(spark, tmp_path):
    rnd = random.Random(4)
    rows = records_of(rnd, 3000)
    path = str(tmp_path / "x.vcf.gz")
    write_records(spark, rows, path)
    spans = [("1", 100_000, 100_400), ("2", 0, 16_384), ("X", 399_000, 500_000), ("X", 262_143, 262_145), ("9", 0, 10), ("1", 5, 5)]
    spans += [(rnd.choice("12X"), a := rnd.randint(0, 400_000), a + rnd.randint(1, 3000)) for _ in range(20)]
    for some in (spans[:1], spans):
        regions = spark.createDataFrame(some, "contig string, start long, stop long")
        got = sorted((int(r["id"]), r["start"], r["stop"]) for r in readers.vcf_range(spark, path, regions, "DELTA").collect())
        assert got == sorted((i, a, b) for i, c, p, ref in rows for k, a, b in some if k == c and p - 1 < b and p - 1 + len(ref) > a)
    seen = bgzf.scan(spark, path, spark.createDataFrame(spans[:1], "contig string, start long, stop long")).select("block_at").distinct().count()
    every = bgzf.lines(spark, path).select("block_at").distinct().count()
    assert seen < every / 4
    # the layout of the index: names and the number of bins
    raw = gzip.decompress(Path(f"{path}.tbi").read_bytes())
    assert raw[:4] == b"TBI\1" and struct.unpack_from("<8i", raw, 4)[:7] == (3, 2, 1, 2, 0, 35, 0) and raw[36:42] == b"1\x002\0X\0"
    with pytest.raises(Exception, match="order"):
        write_records(spark, [(0, "1", 9, "A"), (1, "2", 1, "A"), (2, "1", 10, "A")], path)
    with pytest.raises(Exception, match="order"):
        write_records(spark, [(0, "1", 9, "A"), (1, "1", 8, "A")], path)


def test_bins():
    rnd = random.Random(5)
    for _ in range(2000):
        a = rnd.randrange(1 << 29)
        b = min(1 << 29, a + rnd.choice([1, 10, 20_000, 1 << 22]))
        own = bgzf.bin_of(a, b)
        level = max(k for k in range(6) if bgzf.first_of_level(k) <= own)
        width = 1 << 29 - 3 * level
        start = (own - bgzf.first_of_level(level)) * width
        assert start <= a and b <= start + width
        assert level == 5 or a // (width // 8) != (b - 1) // (width // 8)


# sequence files ----------------------------------------------------------------


def test_geometry_of_any_range(tmp_path):
    rnd = random.Random(6)
    for _ in range(150):
        sep, text = rnd.choice(["\n", "\n", "\r\n"]), ""
        for i in range(rnd.randint(0, 6)):
            n, w = rnd.choice([0, 1, 7, 14, 20, 57]), rnd.choice([7, 1000, 3])
            v = "".join(rnd.choice("ACGTNacgt") for _ in range(n))
            text += f">c{i} more words{sep}" + "".join(v[a : a + w] + sep for a in range(0, n, w)) + sep * rnd.choice([0, 0, 1])
        raw = (text[: -len(sep)] if text and rnd.random() < 0.3 else text).encode()
        (tmp_path / "x.fa").write_bytes(raw)
        want = []
        for line in raw.decode().splitlines():
            want += [[line[1:].split()[0], ""]] if line.startswith(">") else []
            if want and not line.startswith(">"):
                want[-1][1] += line
        for step in (1, 3, 8, 1000):
            with files.opened(str(tmp_path / "x.fa")) as file:
                events = sorted((e for a in range(0, len(raw), step) for e in fasta.range_events(file, a, min(a + step, len(raw)))), key=lambda e: e[:2])
            found = []
            for name, _, n, offset, bases, size in fasta.geometry(events, len(raw)):
                at = lambda k: offset + k // max(bases, 1) * size + k % max(bases, 1)  # noqa: E731, B023
                found.append([name, raw[at(0) : at(n - 1) + 1].translate(None, b"\r\n").decode() if n else ""])
            assert found == want


@pytest.mark.parametrize("text", [">a\nACG\nAC\nACG\n", ">a\nAC\nACG\n", ">a\nAC\n\nAC\n", ">a\nA C\n", ">a\nAC\r\nAC\n"])
def test_irregular_sequence_files_are_read_as_lines(spark, tmp_path, text):
    (tmp_path / "x.fa").write_bytes(text.encode())
    with pytest.raises(fasta.Irregular):
        fasta.index(spark, str(tmp_path / "x.fa"))
    assert not (tmp_path / "x.fa.fai").exists()
    assert [r["sequence"] for r in readers.fasta(spark, str(tmp_path / "x.fa")).collect()] == ["".join(text.split("\n", 1)[1].split())]


def test_only_the_bytes_of_a_region_are_read(spark, tmp_path, monkeypatch):
    rnd = random.Random(7)
    bases = {"a": "".join(rnd.choices("ACGTacgtN", k=400_000)), "b": "", "c": "".join(rnd.choices("ACGT", k=70_001))}
    for width in (60, 10**9):
        path = tmp_path / f"{width}.fa"
        path.write_text("".join(f">{k} x\n" + "".join(v[i : i + width] + "\n" for i in range(0, len(v), width)) for k, v in bases.items()))
        monkeypatch.setattr(fasta, "RANGE", 1 << 15)
        known = fasta.index(spark, str(path))
        assert [tuple(r)[:3] for r in known.orderBy("ordinal").collect()] == [(k, i, len(v)) for i, (k, v) in enumerate(bases.items())]
        regions = spark.createDataFrame([("a", 10, 200, 1), ("a", 399_990, 400_100, 2), ("c", 0, 70_001, 3), ("a", 59, 61, 4)], "contig string, start long, stop long, id int")
        found = fasta.slices(spark, str(path), regions, 5).collect()
        assert len(found) == 4 and all(r["sequence"] == bases[r["contig"]].upper()[r["start"] : r["stop"] + 5] for r in found)
        spans = fasta.byte_of(F.lit(1000))
        assert known.where("contig = 'a'").select(spans).head()[0] == path.read_text().index("\n") + 1 + 1000 + (1000 // 60 if width == 60 else 0)
        got = {}
        for r in readers.fasta(spark, str(path)).orderBy("ordinal", "block").collect():
            assert r["start"] == len(got.get(r["contig"], ""))
            got[r["contig"]] = got.get(r["contig"], "") + r["sequence"]
        assert got == {k: v.upper() for k, v in bases.items()}
    # a changed file makes its index anew
    time.sleep(0.02)
    path.write_text(">z\nACGT\n")
    assert [r["contig"] for r in fasta.index(spark, str(path)).collect()] == ["z"]


# shards ------------------------------------------------------------------------


def planned(spark, tmp_path, target=8):
    (tmp_path / "r.fa").write_text(">chr1\nACGTACGTNACGT\n>chr2\nGGGGCCCC\n")
    (tmp_path / "a.tsv").write_text(writers.ANNOTATION_HEADER + "\nG1\t1\t+\t0\t9\t0,\t9,\nG2\t2\t-\t2\t8\t2,\t8,\n")
    plan = str(tmp_path / "plan.tsv")
    shards.write_plan(spark, str(tmp_path / "a.tsv"), str(tmp_path / "r.fa"), plan, target)
    return plan


def test_a_range_of_shards_at_once(spark, tmp_path):
    plan, out = planned(spark, tmp_path, 40), str(tmp_path / "out")
    n = shards.read_plan(spark, plan)[1].count()
    told = shards.generate_range(spark, plan, 1, n, out, concurrency=2, threads=2)
    assert [t["shard_id"] for t in told] == [r["shard_id"] for r in shards.read_plan(spark, plan)[1].orderBy("line_no").collect()]
    for t in told:
        lines = [x.split("\t") for x in gzip.decompress(Path(t["output"]).read_bytes()).decode().splitlines() if x[0] != "#"]
        assert len(lines) == t["records"] <= t["estimated_records"] and Path(t["output"] + ".tbi").exists()
        assert t["output_sha256"] == files.sha256_of(t["output"]) and t["compression_threads"] == 2
        assert [int(x[1]) for x in lines] == sorted(int(x[1]) for x in lines)
    times = {p: p.stat().st_mtime_ns for p in Path(out).iterdir()}
    assert shards.generate_range(spark, plan, 1, n, out, threads=2) == told
    assert times == {p: p.stat().st_mtime_ns for p in Path(out).iterdir()}
    Path(told[0]["output"] + ".tbi").unlink()  # a shard without its index is made again
    assert shards.complete(spark, out, [t["shard_id"] for t in told], {}) == {t["shard_id"]: t for t in told[1:]}
    with pytest.raises(ValueError, match="incomplete"):
        shards.finalize(spark, plan, out, str(tmp_path / "m.tsv"), verify=True)
    assert shards.generate_range(spark, plan, 1, n, out, threads=2) == told
    assert shards.finalize(spark, plan, out, str(tmp_path / "m.tsv"), verify=True)["records"] == sum(t["records"] for t in told)
    Path(told[1]["output"]).write_bytes(b"x")
    with pytest.raises(ValueError, match="checksums"):
        shards.finalize(spark, plan, out, str(tmp_path / "m.tsv"), verify=True)


@pytest.mark.parametrize("change, message", [
    (lambda x: x.replace("##target_records=8", "##target_records"), "metadata"),
    (lambda x: x.replace("##target_records=8", "##=8"), "metadata"),
    (lambda x: x.replace("#shard_id\t", "#shard\t"), "columns of a plan"),
    (lambda x: "\n".join(sorted(x.splitlines(), key=lambda y: y.startswith("#shard"))), "before the columns"),
    (lambda x: x.replace('["1",', "[1,"), "two names"),
    (lambda x: x.replace('["1",', '["1","2",'), "two names"),
    (lambda x: x.replace("##format_version=2", "##format_version=1"), "version"),
    (lambda x: "\n".join(y for y in x.splitlines() if y.startswith("#")), "without shards"),
    (lambda x: x.rstrip("\n") + "x\n", "whole number"),
])
def test_what_is_not_a_plan(spark, tmp_path, change, message):
    plan = Path(planned(spark, tmp_path))
    plan.write_text(change(plan.read_text()))
    with pytest.raises(Exception, match=message):
        shards.read_plan(spark, str(plan))[1].collect()


def test_names_in_regions_may_hold_anything(spark):
    rows = [('[["a,\\"b","c]",1,5],["d","e",2,3]]', 2), ('[["a","b",5,5]]', None), ('[["a",1,2,5]]', None), ("[]", None), ("{", None), ('[["a","b",1,"5"]]', 1)]
    from strandline.functions import alleles

    for text, n in rows:
        assert (spark.range(1).select(F.size(alleles.parsed_regions(F.lit(text))).alias("n")).head()["n"] or None) in (n, -1 if n is None else n), text


def test_bounded_jobs(spark):
    running, most, lock = [], [], threading.Lock()

    def task(i):
        def run():
            with lock:
                running.append(i)
                most.append(len(running))
            n = spark.range(1000).repartition(3).count() + i
            with lock:
                running.remove(i)
            return n

        return run

    assert jobs.bounded(spark, [task(i) for i in range(7)], 3) == [1000 + i for i in range(7)]
    assert max(most) <= 3
    began, slow = time.time(), []

    def fails():
        time.sleep(1)
        raise KeyError("first")

    def long():
        slow.append(1)
        spark.range(4).repartition(4).foreach(lambda _: time.sleep(120))

    with pytest.raises(KeyError, match="first"):
        jobs.bounded(spark, [fails, long, long, long], 2)
    assert time.time() - began < 60 and len(slow) == 1
    assert jobs.bounded(spark, [], 1) == []
    with pytest.raises(ValueError):
        jobs.bounded(spark, [], 0)


# runs ----------------------------------------------------------------------------


def run_inputs(spark, tmp_path, n=3):
    (tmp_path / "r.fa").write_text(">1\n" + "ACGT" * 30 + "\n")
    (tmp_path / "a.tsv").write_text(writers.ANNOTATION_HEADER + "\nG1\t1\t+\t0\t9\t0,\t9,\n")
    lines = ["#shard_id\tinput_vcf\tinput_sha256"]
    for i in range(n):
        path = tmp_path / f"in{i}.vcf"
        path.write_text(HEAD + "".join(f"1\t{p}\t.\tA\tC\t.\t.\t.\n" for p in range(1, 5 + i)))
        lines.append(f"s{i}\t{path}" + (f"\t{files.sha256_of(str(path)).upper()}" if i else ""))
    (tmp_path / "m.tsv").write_text("\n".join(lines) + "\n")
    return str(tmp_path / "m.tsv"), runner.Settings(str(tmp_path / "r.fa"), str(tmp_path / "a.tsv"), 20)


class Stopped(Exception):
    pass


def test_a_run_that_is_stopped_goes_on(spark, tmp_path, monkeypatch):
    manifest, settings = run_inputs(spark, tmp_path)
    out, calls = str(tmp_path / "out"), []

    def score(source, target):
        calls.append(target)
        return cli.scored_file(spark, source, target, settings.reference, settings.annotation, lambda: [], settings.distance, False, 4, indexed=True).lines

    real, left = files.write_bytes, [0]

    def stopping(path, chunks):
        left[0] -= 1
        if left[0] == 0:
            raise Stopped(path)
        real(path, chunks)

    fasta.index(spark, settings.reference)
    for step in (1, 2, 3):  # before the index, the metadata and the marker
        left[0] = step
        with monkeypatch.context() as m:
            m.setattr(files, "write_bytes", stopping)
            with pytest.raises(Stopped):
                runner.run(spark, manifest, out, settings, score, 1, 1)
        assert not (Path(out) / "s0.complete").exists()
    monkeypatch.undo()
    assert runner.run(spark, manifest, out, settings, score, 1, 1) == {"shards": 1, "scored": 1, "skipped": 0, "records": 4}
    n = len(calls)
    assert runner.run(spark, manifest, out, settings, score, concurrency=2) == {"shards": 3, "scored": 2, "skipped": 1, "records": 15}
    assert len(calls) == n + 2
    assert runner.run(spark, manifest, out, settings, score)["skipped"] == 3 and len(calls) == n + 2
    marker = (Path(out) / "s1.complete").read_text().rstrip("\n").split("\t")
    assert marker[0] == "s1" and marker[2] == "5" and marker[3] == files.sha256_of(f"{out}/s1.vcf.gz")
    told = {r["values"]["shard_id"]: r["values"] for r in runner.metadata_table(spark, out).collect()}
    assert told["s2"]["input_records"] == told["s2"]["output_records"] == "6" and told["s1"]["run_fingerprint"] == marker[4]
    # another setting, a changed file or a missing index is scored again
    assert runner.run(spark, manifest, out, runner.Settings(settings.reference, settings.annotation, 21), score, 1, 1)["scored"] == 1
    (Path(out) / "s1.vcf.gz").write_bytes(b"x")
    (Path(out) / "s2.vcf.gz.tbi").unlink()
    assert runner.run(spark, manifest, out, settings, score)["scored"] == 3


def test_a_run_refuses_lost_records_and_other_inputs(spark, tmp_path):
    manifest, settings = run_inputs(spark, tmp_path, 2)
    out = str(tmp_path / "out")
    with pytest.raises(ValueError, match="3 records written of 4"):
        runner.run(spark, manifest, out, settings, lambda source, target: (files.write_bytes(target, [b"x"]), 3)[1], 1, 1)
    assert not list(Path(out).glob("*.complete")) and not (Path(out) / "s0.vcf.gz").exists()
    (tmp_path / "in1.vcf").write_text(HEAD)
    with pytest.raises(ValueError, match="checksum"):
        runner.run(spark, manifest, out, settings, lambda *_: 0)
    (tmp_path / "m.tsv").write_text("s0\n")
    with pytest.raises(Exception, match="task 1 needs"):
        runner.run(spark, manifest, out, settings, lambda *_: 0)
    with pytest.raises(ValueError, match="distance"):
        runner.Settings("r", "a", 5000)


def test_run_and_score_command_lines(spark, tmp_path, capsys):
    manifest, settings = run_inputs(spark, tmp_path, 1)
    out = tmp_path / "out"
    args = ["run", "--manifest", manifest, "--output-dir", str(out), "--reference", settings.reference, "--annotation", settings.annotation, "--distance", "20"]
    assert cli.main(args, spark) == 0 and "'scored': 1" in capsys.readouterr().out
    told = json.loads(json.dumps(dict(x.split("=", 1) for x in next(out.glob("*.metadata.txt")).read_text().splitlines())))
    assert told["output_records"] == "4" and told["distance"] == "20"
    assert cli.main(["score", "-I", str(tmp_path / "in0.vcf"), "-O", str(tmp_path / "o.vcf.gz"), "-R", settings.reference, "-A", settings.annotation], spark) == 0
    assert "processed=4 " in capsys.readouterr().out
    assert gzip.decompress((tmp_path / "o.vcf.gz").read_bytes()) == gzip.decompress((out / "s0.vcf.gz").read_bytes())


# batches ---------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(5))
def test_all_batches_but_the_last_of_a_length_are_full(seed):
    import pandas as pd

    rnd = random.Random(seed)
    rows = [(i, "A" * rnd.choice([3, 3, 3, 5, 8])) for i in range(200)]
    frames = [pd.DataFrame(rows[a : a + 7], columns=["key", "sequence"]) for a in range(0, 200, 7)]
    found = list(scoring.length_batches(iter(frames), 16))
    assert sorted(k for f in found for k in f["key"]) == list(range(200))
    by = {}
    for f in found:
        assert f["sequence"].str.len().nunique() == 1
        by.setdefault(len(f["sequence"].iloc[0]), []).append(len(f))
    assert all(set(sizes[:-1]) <= {16} and sizes[-1] <= 16 for sizes in by.values())
    held = list(scoring.length_batches(iter(frames), 1000, bound=100))  # very many bases that wait are let go
    assert sorted(k for f in held for k in f["key"]) == list(range(200)) and len(held) > 3


def test_only_rows_that_wait_are_held():
    import gc
    import weakref

    import pandas as pd

    class Text(str):  # can be referred to weakly
        pass

    held = []

    def frames():
        for n in (101, 2, 2, 101, 2, 2):
            texts = [Text("ACGTA"[: 3 + 2 * (i % 2)]) for i in range(n)]
            marks = [weakref.ref(t) for t in texts]
            frame = pd.DataFrame({"key": range(n), "sequence": texts}, dtype=object)
            del texts
            yield frame
            del frame
            held.append(marks)
            gc.collect()
            # of frames before the last, the batch that was told last and what waits for one of either length
            assert sum(m() is not None for marks in held[:-1] for m in marks) <= 16 + 2 * 15

    assert sum(len(f) for f in scoring.length_batches(frames(), 16)) == 210 and len(held) == 6


def test_inputs_are_spelt_out_a_few_at_a_time():
    import pyarrow as pa

    item = {"transcript": 1, "strand": "-", "start": 0, "stop": 100, "ref": "A"}
    places = [{"contig": "1", "pos": 50 + i, "verdicts": [{"ref": "A", "skip_reason": None if i % 2 else "another"}], "items": [item | {"alt": a} for a in ("C", "AG")], "window": "ACGTA" * 5} for i in range(40)]
    frames = list(scoring.asked_of(pa.RecordBatch.from_pylist(places), 12, 200))
    assert sum(len(f) for f in frames) == 20 * 3 and all(f["sequence"].str.len().sum() < 200 + 26 for f in frames)
    first = frames[0].iloc[:3]
    assert first["sequence"].tolist() == ["ACGTA" * 5, "ACGTA" * 2 + "ACCTA" + "ACGTA" * 2, "ACGTA" * 2 + "ACAGTA" + "ACGTA" * 2] and first["alt"].tolist() == [None, "C", "AG"]
    turned = scoring.one_hot(["ACGTN", "AACCn"], np.array([True, False]))
    assert (turned == scoring.one_hot(["NACGT", "AACCN"])).all()


def test_results_of_any_number_are_one_list(spark, tmp_path):
    rows = [(f"v{i % 40}", "g" if i % 3 else None, i * 0.5, None) for i in range(200)] + [("v1", "g", 0.5, None)] * 2
    table = spark.createDataFrame(rows, "variant string, gene string, largest double, line string").repartition(5)
    path = tmp_path / "results.json"
    writers.write_results(table, ["variant", "gene"], str(path))
    found = json.loads(path.read_text())
    key = lambda r: (r["variant"], r.get("gene") is not None)
    assert len(found) == 202 and found == sorted(found, key=key)
    assert sorted((r["variant"], r.get("gene") or "", r["largest"]) for r in found) == sorted((v, g or "", x) for v, g, x, _ in rows)
    assert all(list(r) == sorted(r) for r in found)
    writers.write_results(table.limit(0), ["variant", "gene"], str(tmp_path / "none.json"))
    assert json.loads((tmp_path / "none.json").read_text()) == []
