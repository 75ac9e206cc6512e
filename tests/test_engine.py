"""Operators and file formats of the engine on small fixtures."""

import gzip
import json
import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline import cli
from strandline.functions import alleles, scores
from strandline.operators import compare, intervals, ranking, sampling, scoring, transcripts, universe
from strandline.plans import shards
from strandline.sources import files, readers, writers
from strandline.streaming import files as stream_files


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], [*values]) if values else spark.range(1)
    return row.select(column).head()[0]


def test_union_and_tiles(spark):
    raw = spark.createDataFrame([("1", 5, 8), ("1", 1, 3), ("1", 3, 5), ("1", 10, 12), ("2", 0, 4)], "contig string, start long, stop long")
    for size in (1, 3, 1 << 16):
        got = sorted(map(tuple, intervals.union(raw, size).collect()))
        assert got == [("1", 1, 8), ("1", 10, 12), ("2", 0, 4)]
    tiles = sorted(map(tuple, intervals.tiles(intervals.union(raw), 5).collect()))
    assert tiles == [("1", 0, 1, 6), ("1", 1, 6, 8), ("1", 1, 10, 12), ("2", 0, 0, 4)]


def test_intervals_against_loops(spark):
    rnd = random.Random(2)
    raw = [(str(rnd.randint(1, 3)), s := rnd.randint(0, 300), s + rnd.randint(1, 25)) for _ in range(120)]
    pts = [(str(rnd.randint(1, 4)), rnd.randint(1, 330)) for _ in range(150)]
    table, points = spark.createDataFrame(raw, "contig string, start long, stop long"), spark.createDataFrame(pts, "contig string, pos long")
    got = sorted((r["contig"], r["pos"], r["start"], r["stop"]) for r in intervals.stab(points, table, 16).collect())
    assert got == sorted((c, p, s, e) for c, p in pts for k, s, e in raw if c == k and s < p <= e)
    marks = table.select("contig", F.explode(F.array("start", "stop")).alias("boundary"))
    for r in intervals.nearest(points, marks, 32).collect():
        own = sorted({b for c, s, e in raw if c == r["contig"] for b in (s, e)}, key=lambda b: (abs(b - r["pos"]), b))
        assert (r["boundary"], r["distance"]) == ((own[0], own[0] - r["pos"]) if own else (None, None))
    recs = spark.createDataFrame([(c, p, "A" * rnd.randint(1, 5), i) for i, (c, p) in enumerate(pts)], "contig string, pos long, ref string, i long")
    got = sorted((r["i"], r["start"], r["stop"]) for r in intervals.overlapping(recs, table, 8).collect())
    assert got == sorted((r["i"], s, e) for r in recs.collect() for c, s, e in raw if c == r["contig"] and r["pos"] - 1 < e and r["pos"] - 1 + len(r["ref"]) > s)


@pytest.mark.parametrize("seed", range(6))
def test_islands_and_tiles_over_bins(spark, seed):
    rnd = random.Random(seed)
    length = rnd.choice([3, 20, 90])
    raw = [(rnd.choice("ab"), s := rnd.randint(0, 400), s + rnd.randint(1, length)) for _ in range(rnd.choice([1, 40, 150]))]
    raw += [raw[0]] * 30 + [("a", 5, 5), ("a", -3, 2), ("c", 7, 500), ("c", 9, 11), ("c", 480, 490), ("c", 500, 501), ("c", 502, 503)]
    want = []
    for c, s, e in sorted(x for x in raw if 0 <= x[1] < x[2]):
        if want and want[-1][0] == c and s <= want[-1][2]:
            want[-1] = (c, want[-1][1], max(e, want[-1][2]))
        else:
            want.append((c, s, e))
    table = spark.createDataFrame(raw, "contig string, start long, stop long")
    size = rnd.choice([1, 7, 64, 1 << 16])
    found = intervals.union(table, size)
    assert sorted(map(tuple, found.collect())) == want
    capacity, cut = rnd.choice([1, 5, 33]), []
    for contig in sorted({w[0] for w in want}):
        at = 0
        for _, s, e in (w for w in want if w[0] == contig):
            while s < e:
                stop = min(e, s + capacity - at % capacity)
                cut.append((contig, at // capacity, s, stop))
                at, s = at + stop - s, stop
    assert sorted(map(tuple, intervals.tiles(found, capacity, size).collect())) == sorted(cut)


def test_range_scan_takes_every_line(spark, tmp_path):
    from strandline.plans import catalogue

    rnd = random.Random(4)
    orders = [(k, rnd.randint(0, 200)) for k in range(150)]
    lines = [(rnd.randrange(150), rnd.randint(0, 60), rnd.randint(1, 7)) for _ in range(400)]
    lines += lines[:20]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_linenumber int").write.parquet(str(tmp_path / "lineitem.parquet"))

    def meeting(chosen):
        return sorted((c % 50, k, start, name) for k, c in orders for start, name in {x[:2] for x in chosen} if c % 50 == name % 50 and k - 1 < start + 2 and k + k % 4 > start)

    found = sorted(map(tuple, catalogue.queries()["range_scan_all"](spark, str(tmp_path)).collect()))
    assert found == meeting(lines) and len(found) > len(meeting([x for x in lines if x[2] == 1])) > 0
    assert sorted(map(tuple, catalogue.queries()["range_scan"](spark, str(tmp_path)).collect())) == meeting([x for x in lines if x[2] == 1])


def test_universe(spark):
    def of(sequence, stop, kind):
        table = spark.createDataFrame([("1", 0, stop, sequence)], "contig string, start long, stop long, sequence string")
        return [tuple(r)[1:] for r in universe.records(table, kind).orderBy("pos", "ord").collect()]

    assert [(p, r, a) for p, _, r, a in of("acgt", 4, "snv")[:3]] == [(1, "A", "C"), (1, "A", "G"), (1, "A", "T")]
    assert len(of("ACGT", 4, "snv")) == 12 and len(of("ACGTACGT", 4, "indel")) == 32 and len(of("ACNT", 4, "snv")) == 9
    assert [(p, r, a) for p, _, r, a in of("ACGTACGT", 4, "indel")[:8]] == [(1, "A", "A" + b) for b in "ACGT"] + [(1, "ACGTA"[: k + 1], "A") for k in range(1, 5)]
    rnd = random.Random(1)
    text = "".join(rnd.choice("ACGTN") for _ in range(9000))
    wanted = [(i + 1, text[i : i + k + 1], text[i]) for i in range(9000) if text[i] != "N" for k in range(1, 5) if i + k < 9000 and "N" not in text[i : i + k + 1]]
    assert [(p, r, a) for p, o, r, a in of(text, 9000, "indel") if o > 3] == wanted


def test_alleles(spark):
    assert one(spark, alleles.attribute_map(F.lit('tag "a"; id "x y"; tag "b";'))) == {"tag": ["a", "b"], "id": ["x y"]}
    assert one(spark, alleles.without_info(F.lit("A=1;DELTA=x;;B"), "DELTA")) == "A=1;B"
    assert one(spark, alleles.without_info(F.lit("DELTA=x"), "DELTA")) == "."
    assert one(spark, alleles.info_value(F.lit("XDELTA=0;DELTA=1;DELTA=2"), "DELTA")) == "1"
    a, b, c = "C|G|1|2|3|4|5|6|7|8", "C|G|9|2|3|4|5|6|7|8", "T|G|1"
    assert one(spark, alleles.entry_map(F.lit(f"{a},{c},{b}"))) == [b.split("|")]
    assert [one(spark, alleles.contig_rank(F.lit(x))) for x in ("1", "22", "23", "X", "Y", "M", "MT", "GL1", "01")] == [1, 22, 10000, 23, 24, 25, 25, 10000, 10000]
    assert one(spark, alleles.reverse_complement(F.lit("ACGTN"))) == "NACGT"
    assert one(spark, alleles.padded_window(F.lit("abcdefg"), F.lit(7), F.lit(-1), F.lit(2))) == "NNcdefN"
    assert one(spark, alleles.substituted(F.lit("abcdefg"), F.lit(7), F.lit("DE"), F.lit("xyz"))) == "abcxyzfg"
    text = '[["1","chr1",0,5],["1","chr1",7,9]]'
    assert one(spark, alleles.regions_json(alleles.parsed_regions(F.lit(text)))) == text
    for bad in ("[]", "{}", '[["1","c",5,5]]', '[["1","c",-1,5]]', '[["1","c",1]]', "x"):
        assert one(spark, alleles.parsed_regions(F.lit(bad))) is None
    names = spark.createDataFrame([("1",), ("chr2",), ("MT",), ("9",), ("3",)], "contig string")
    refs = spark.createDataFrame([("chr1",), ("chr2",), ("chrM",), ("3",), ("chr3",)], "reference string")
    assert {r["contig"]: r["reference"] for r in intervals.resolve_contigs(names, refs).collect()} == {"1": "chr1", "chr2": "chr2", "MT": "chrM", "9": None, "3": None}


def numpy_entry(ref, alt, ref_len, alt_len, exon, mask):
    cov = len(ref)
    if ref_len > 1 and alt_len == 1:
        alt = np.concatenate([alt[: cov // 2 + 1], np.zeros((ref_len - 1, 2)), alt[cov // 2 + 1 :]])
    elif alt_len > 1:
        alt = np.concatenate([alt[: cov // 2], alt[cov // 2 : cov // 2 + alt_len].max(0)[None], alt[cov // 2 + alt_len :]])
    values, places = [], []
    for c in (0, 1):
        for gain in (True, False):
            d = alt[:, c] - ref[:, c] if gain else ref[:, c] - alt[:, c]
            at = int(d.argmax())
            place = at - cov // 2
            hide = mask and ((place == exon) if gain else (place != exon))
            values.append(f"{d[at] * (1 - bool(hide)):.2f}")
            places.append(str(place))
    return "|".join(["A", "G", *values, *places])


def test_score_entries(spark):
    rnd = np.random.default_rng(3)
    cov = 11
    for ref_len, alt_len, mask in [(1, 1, 0), (1, 1, 1), (3, 1, 1), (3, 1, 0), (1, 4, 1), (1, 2, 0)]:
        n = cov - (ref_len - 1) + (alt_len - 1)
        rows = [(rnd.random((cov, 2)).astype(np.float32), rnd.random((n, 2)).astype(np.float32), int(rnd.integers(-3, 4))) for _ in range(25)]
        table = spark.createDataFrame([(i, *(x[:, c].tolist() for x in (r, a) for c in (0, 1)), e) for i, (r, a, e) in enumerate(rows)], "i int, ra array<float>, rd array<float>, aa array<float>, ad array<float>, exon int")
        own = [scores.channel_scores(F.col(f"r{c}"), F.col(f"a{c}"), cov, F.lit(ref_len), F.lit(alt_len)) for c in "ad"]
        got = table.select("i", scores.score_entry(F.lit("A"), F.lit("G"), *own, cov, F.col("exon"), bool(mask)).alias("e")).collect()
        for r in got:
            assert r["e"] == numpy_entry(*rows[r["i"]][:2], ref_len, alt_len, rows[r["i"]][2], mask)


def test_double_precision_of_deletions(spark):
    zero = [0.0] * 5
    ref, alt = [0.0, 0.11566238403320312, 0.0, 0.0, 0.0], [0.0, 0.5006623864173889, 0.0, 0.0]
    table = spark.createDataFrame([(ref, zero, alt, zero[:4])], "ra array<float>, rd array<float>, aa array<float>, ad array<float>")
    own = [scores.channel_scores(F.col(f"r{c}"), F.col(f"a{c}"), 5, F.lit(2), F.lit(1)) for c in "ad"]
    entry = table.select(scores.score_entry(F.lit("A"), F.lit("G"), *own, 5, F.lit(9), False)).head()[0]
    assert entry.split("|")[2] == f"{np.float64(np.float32(alt[1])) - np.float64(np.float32(ref[1])):.2f}"


@pytest.mark.parametrize("count", [1, 2, 3, 5, 6, 7])
def test_even_spread(spark, count):
    for n in (0, 1, 2, 5, 6, 7, 50):
        wanted = [] if n < 1 else list(range(n)) if count >= n else [(n - 1) // 2] if count == 1 else sorted({round(i * (n - 1) / (count - 1)) for i in range(count)})
        assert sorted(one(spark, ranking.spread_indexes(F.lit(n), count))) == wanted
        kept = [r[0] for r in spark.range(n).where(ranking.spread_kept(F.col("id"), F.lit(n), count)).orderBy("id").collect()]
        assert kept == wanted
    rows = spark.createDataFrame([(float(i % 7), i) for i in range(100)], "v double, k long")
    ranked = ranking.global_rank(rows, "v", ["k"], bins=5).orderBy("rank").collect()
    assert [(r["v"], r["k"]) for r in ranked] == sorted((float(i % 7), i) for i in range(100)) and [r["rank"] for r in ranked] == list(range(100))
    with pytest.raises(ValueError):
        ranking.spread_kept(F.lit(1), F.lit(1), 0)


def test_ranks_of_a_hot_stratum_over_ranges(spark):
    rnd = random.Random(4)
    rows = [("hot" if i % 3 else rnd.choice(["a", "b", None]), rnd.choice([1.5, 2.5, None]) if i % 2 else 7.0, i // 2) for i in range(400)] + [("hot", 7.0, 0)] * 60
    table = spark.createDataFrame(rows, "s string, v double, k long").repartition(3)
    ranked = ranking.placed(table, ["s"], ["v", "k"], 7).collect()
    null_first = lambda r: (r[1] is not None, r[1] or 0, r[2])
    for s in ("hot", "a", "b", None):
        own = sorted((r for r in ranked if r["s"] == s), key=lambda r: r["rank_at"])
        wanted = sorted((r for r in rows if r[0] == s), key=null_first)
        assert [r["rank_at"] for r in own] == list(range(len(wanted))) and {r["rank_length"] for r in own} == {len(wanted)}
        assert [(r["s"], r["v"], r["k"]) for r in own] == wanted
    kept = ranking.stratified(table, ["s"], ["v", "k"], 5).groupBy("s").count().collect()
    assert {r["s"]: r["count"] for r in kept} == dict.fromkeys(("hot", "a", "b", None), 5)
    assert {r["rank"] for r in ranking.evenly(table, "v", ["k"], 4).collect()} == {0, 153, 306, 459}
    assert ranking.stratified(table.limit(0), ["s"], ["v"], 5).count() == 0 and ranking.global_rank(table.limit(0), "v", ["k"]).count() == 0


def greedy_loop(selected, records, quota, window):
    """The plain double loop: transcripts, anchors, records in order."""
    seen, counts = [], {}
    for contig, gene, anchors in selected:
        for anchor in anchors:
            for r in records:
                if r[0] == contig and r[1] - 1 < anchor + window + 1 and r[1] - 1 + len(r[2]) > max(0, anchor - window):
                    if r in seen:
                        continue
                    seen.append(r)
                    counts[gene] = counts.get(gene, 0) + 1
                    if counts[gene] >= quota:
                        break
            if counts.get(gene, 0) >= quota:
                break
    return seen


@pytest.mark.parametrize("seed", range(4))
def test_greedy_sample(spark, seed):
    rnd = random.Random(seed)
    genes = []
    for i in range(14):
        start = rnd.randint(0, 900)
        exons = sorted(rnd.sample(range(start, start + 200), 6))
        genes.append((f"G{rnd.randint(0, 5)}", str(rnd.randint(1, 2)), rnd.choice("+-"), start, start + 200, exons[::2], exons[1::2]))
    annotations = spark.createDataFrame(genes, "name string, contig string, strand string, start long, stop long, exon_starts array<long>, exon_stops array<long>")
    records = sorted({(str(rnd.randint(1, 2)), rnd.randint(1, 1200), rnd.choice(["A", "AC"]), "T") for _ in range(70)})
    table = spark.createDataFrame(records, "contig string, pos long, ref string, alts string")
    chosen = sampling.selected_transcripts(annotations, 3).withColumn("anchors", sampling.anchor_positions(*map(F.col, ("start", "stop", "exon_starts", "exon_stops")))).orderBy("place").collect()
    target = 12
    quota = max(1, -(-target // len(chosen)))
    wanted = greedy_loop([(r["contig"], r["name"], r["anchors"]) for r in chosen], records, quota, 30)
    got = sorted((r["contig"], r["pos"], r["ref"], r["alts"]) for r in sampling.sample(table, annotations, target=target, per_stratum=3, window=30).collect())
    assert set(got) <= set(wanted) and len(got) == min(target, len(wanted))
    assert sorted(got) == sorted(wanted) or len(wanted) > target


def vcf_text(rows, key="DELTA"):
    return "##fileformat=VCFv4.2\n##contig=<ID=1,length=50>\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n" + "".join(f"1\t{p}\t.\tA\tC\t.\t.\t{i if '=' in i or i == '.' else f'{key}={i}'}\n" for p, i in rows)


def test_compare(spark, tmp_path):
    def gate(a, b):
        for name, rows in (("a", a), ("b", b)):
            (tmp_path / f"{name}.vcf").write_text(vcf_text(rows))
        return compare.comparison(*(readers.vcf(spark, str(tmp_path / f"{n}.vcf"), "DELTA") for n in "ab")).head()

    e = "C|G|{}|0.00|0.00|0.00|{}|2|3|4".format
    r = gate([(1, e("0.10", 1)), (2, e("0.00", 1)), (3, ".")], [(1, e("0.11", 5)), (2, e("0.00", 1)), (3, ".")])
    assert (r["records"], r["annotations_different"], r["score_fields_different"], r["position_fields_different"], r["nontrivial_position_fields_different"], r["passed"]) == (3, 1, 1, 1, 1, False)
    assert abs(r["max_score_difference"] - 0.01) < 1e-9
    r = gate([(1, e("0.00", 1))], [(1, e("0.00", 5))])
    assert (r["position_fields_different"], r["nontrivial_position_fields_different"], r["passed"]) == (1, 0, True)
    r = gate([(1, e("0.00", 1) + "," + e("0.00", 1).replace("|G|", "|H|"))], [(1, e("0.00", 1))])
    assert (r["entries_missing"], r["passed"]) == (1, False)
    assert gate([(1, "."), (2, ".")], [(1, ".")])["identity_different"] == 1
    assert gate([(1, ".")], [(2, ".")])["identity_different"] == 1
    (tmp_path / "bad.vcf").write_text("#h\n1\t2\t.\tA\tC\n")
    with pytest.raises(Exception, match=r"bad\.vcf:2"):
        readers.vcf(spark, str(tmp_path / "bad.vcf"), "DELTA").collect()


def test_line_numbers_over_blocks(spark, tmp_path):
    lines = [f"line {i}" if i % 5 else "" for i in range(1, 4001)]
    (tmp_path / "t.txt").write_text("\n".join(lines) + "\n")
    with gzip.open(tmp_path / "u.txt.gz", "wt") as out:
        out.write("\n".join(lines[:50]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = readers.numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    by = {}
    for r in got:
        by.setdefault(r["path"][-2:], {})[r["line_no"]] = r["value"]
    assert by["xt"] == dict(enumerate(lines, 1)) and by["gz"] == dict(enumerate(lines[:50], 1))


GTF = """#c
chr2\tH\ttranscript\t101\t400\t.\t-\t.\tgene_name "GENE"; transcript_id "T1"; tag "basic"; tag "MANE_Select";
chr2\tH\texon\t301\t400\t.\t-\t.\ttranscript_id "T1";
chr2\tH\texon\t101\t200\t.\t-\t.\ttranscript_id "T1";
chr2\tH\texon\t101\t200\t.\t-\t.\ttranscript_id "T1";
chr1_KN\tH\ttranscript\t1\t9\t.\t+\t.\tgene_name "FIX"; transcript_id "T2"; tag "MANE_Select";
chr1_KN\tH\texon\t1\t9\t.\t+\t.\ttranscript_id "T2";
chr3\tH\ttranscript\t1\t9\t.\t+\t.\tgene_name "NO"; transcript_id "T3"; tag "basic";
"""


def test_convert(spark, tmp_path, capsys):
    (tmp_path / "x.gtf").write_text(GTF)
    assert cli.main(["convert", "--input", str(tmp_path / "x.gtf"), "--output", str(tmp_path / "x.tsv")], spark) == 0
    assert (tmp_path / "x.tsv").read_text() == writers.ANNOTATION_HEADER + "\nGENE\t2\t-\t100\t400\t100,300,\t200,400,\n"
    assert "transcripts=1 genes=1 contigs=1 exons=2" in capsys.readouterr().out
    assert transcripts.converted(readers.gtf(spark, str(tmp_path / "x.gtf")), include_nonprimary=True).count() == 2
    (tmp_path / "y.gtf").write_text(GTF.replace("\t301\t400", "\t301\t500"))
    with pytest.raises(Exception, match="outside"):
        transcripts.converted(readers.gtf(spark, str(tmp_path / "y.gtf"))).collect()


def universe_files(tmp_path, fasta=">chr1\nACGTACGT\n"):
    (tmp_path / "r.fa").write_text(fasta)
    (tmp_path / "a.tsv").write_text(writers.ANNOTATION_HEADER + "\nGENE1\t1\t+\t0\t3\t0,\t3,\nGENE2\t1\t-\t2\t4\t2,\t4,\n")
    return [str(tmp_path / n) for n in ("a.tsv", "r.fa", "plan.tsv")]


def test_plan_generate_finalize(spark, tmp_path):
    annotation, reference, plan = universe_files(tmp_path)
    told = shards.write_plan(spark, annotation, reference, plan, 100)
    assert told == {"merged_transcript_bases": 4, "snv_tasks": 1, "snv_estimated_records": 12, "indel_tasks": 1, "indel_estimated_records": 32, "tasks": 2}
    metadata, rows = shards.read_plan(spark, plan)
    assert metadata["format_version"] == "2" and [r["shard_id"] for r in rows.orderBy("line_no").collect()] == ["snv-000001", "indel-000001"]
    out = tmp_path / "out"
    with pytest.raises(ValueError, match="incomplete"):
        (out).mkdir()
        (out / "x.complete.json").write_text("{}")
        shards.finalize(spark, plan, str(out), str(tmp_path / "m.tsv"))
    assert not (tmp_path / "m.tsv").exists()
    for i, n in ((1, 12), (2, 32)):
        assert shards.generate(spark, plan, i, str(out))["records"] == n
    first = gzip.decompress((out / "snv-000001.vcf.gz").read_bytes()).decode().splitlines()
    assert [x.split("\t")[:5] for x in first if x[0] != "#"][:2] == [["1", "1", ".", "A", "C"], ["1", "1", ".", "A", "G"]] and "##contig=<ID=1,length=8>" in first
    before = (out / "snv-000001.complete.json").read_text()
    assert shards.generate(spark, plan, 1, str(out)) == json.loads(before)
    told = shards.finalize(spark, plan, str(out), str(tmp_path / "m.tsv"), verify=True)
    assert told == {"snv_shards": 1, "snv_records": 12, "indel_shards": 1, "indel_records": 32, "records": 44}
    assert (tmp_path / "m.tsv").read_text().splitlines()[0] == "#shard_id\tinput_vcf\tinput_sha256"
    assert readers.nth_task(spark, str(tmp_path / "m.tsv"), 2).startswith("indel-000001\t")
    with pytest.raises(ValueError, match="checksum"):
        shards.write_plan(spark, annotation, reference, plan, 100, reference_sha256="0" * 64)
    with pytest.raises(ValueError):
        shards.write_plan(spark, annotation, reference, plan, 7)
    assert shards.write_plan(spark, annotation, reference, plan, 8)["snv_tasks"] == 2
    (tmp_path / "a.tsv").write_text("GENE1\t7\t+\t0\t3\t0,\t3,\n")
    with pytest.raises(Exception, match="no unique reference contig"):
        shards.write_plan(spark, annotation, reference, plan, 100)


def test_score_command(spark, tmp_path):
    rnd = random.Random(0)
    bases = "".join(rnd.choice("ACGT") for _ in range(10_400))
    (tmp_path / "r.fa").write_text(">chr1\n" + "\n".join(bases[i : i + 60] for i in range(0, len(bases), 60)) + "\n")
    (tmp_path / "a.tsv").write_text(writers.ANNOTATION_HEADER + "\nG1\t1\t+\t5000\t5400\t5000,5300,\t5150,5400,\nG2\t1\t-\t5100\t5390\t5100,\t5390,\n")
    p = 5200
    ref = bases[p - 1]
    alt = next(b for b in "ACGT" if b != ref)
    head = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n"
    rows = [(p, ref, f"{alt},<DEL>"), (p, bases[p - 1 : p + 2], ref), (p, ref, ref + "GG"), (p, bases[p - 1 : p + 1], "TTT"), (9000, "A", "C"), (p, alt, ref)]
    (tmp_path / "i.vcf").write_text(head + "".join(f"1\t{q}\t.\t{r}\t{a}\t.\t.\tX=1\n" for q, r, a in rows))
    args = ["score", "-I", str(tmp_path / "i.vcf"), "-O", str(tmp_path / "o.vcf"), "-R", str(tmp_path / "r.fa"), "-A", str(tmp_path / "a.tsv"), "-D", "20", "-M", "0"]
    assert cli.main(args, spark) == 0
    out = [x.split("\t") for x in (tmp_path / "o.vcf").read_text().splitlines() if x[0] != "#"]
    info = [x[7] for x in out]
    assert [len(x.split(",")) if "DELTA" in x else 0 for x in info] == [2, 2, 2, 2, 0, 0] and info[4] == "X=1"
    assert info[3] == "X=1;DELTA=TTT|G1|.|.|.|.|.|.|.|.,TTT|G2|.|.|.|.|.|.|.|."
    # the same by hand, both strands
    models = [scoring.StubScorer(w) for w in (0.6, 0.8, 1.0, 1.2, 1.4)]
    half, cov = (scoring.CONTEXT + 41) // 2, 41
    window = bases[p - 1 - half : p + half]
    for entry, (a, b, minus) in zip(info[0].split("DELTA=")[1].split(","), ((5000, 5400, False), (5100, 5390, True))):
        left, right = max(half + a + 1 - p, 0), max(half - (b - p), 0)
        x = "N" * left + window[left : len(window) - right] + "N" * right
        y = x[:half] + alt + x[half + 1 :]
        turned = [s[::-1].translate(str.maketrans("ACGT", "TGCA")) if minus else s for s in (x, y)]
        r, q = (scoring.ensemble(models, scoring.one_hot([s]), 1)[0][:, 1:] for s in turned)
        r, q = (z[::-1] if minus else z for z in (r, q))
        assert entry.split("|")[2:] == numpy_entry(r, q, 1, 1, 0, False).split("|")[2:]
    assert cli.main(["compare", str(tmp_path / "o.vcf"), str(tmp_path / "o.vcf"), "--json", str(tmp_path / "c.json")], spark) == 0
    assert json.loads((tmp_path / "c.json").read_text())[0]["passed"] is True


def test_a_place_goes_to_the_models_once(spark, monkeypatch):
    distance, context, size = 2, 20, 16
    half, cov = 12, 5
    rnd = random.Random(5)
    bases = "".join(rnd.choice("ACGTacgtn") for _ in range(39)) + "acgta" + "".join(rnd.choice("ACGTacgt") for _ in range(56))
    blocks = spark.createDataFrame([("1", k, bases[size * k : size * k + size]) for k in range(7)], "contig string, block long, sequence string")
    table = [(1, "G1", "1", "+", 5, 90, [5], [90]), (2, "G2", "1", "-", 30, 48, [30], [48])]
    tx = spark.createDataFrame(table, "transcript long, gene string, contig string, strand string, start long, stop long, exon_starts array<long>, exon_stops array<long>")
    at = lambda p, n=1: bases[p - 1 : p - 1 + n].upper()
    rows = [(40, "A", ["C", "<DEL>"]), (40, "A", ["C"]), (40, "A", ["AGT", "G"]), (40, "ACG", ["A"]), (40, "AC", ["TT"]), (40, "G", ["A"]), (40, "ACGTA", ["A"]), (20, at(20), ["AT" if at(20) == "A" else "A"]), (10, at(10), ["T"]), (89, at(89), ["T"]), (95, at(95), ["T"]), (40, "A", [])]
    records = spark.createDataFrame([(i, "1", *r) for i, r in enumerate(rows)], "line_no long, contig string, pos long, ref string, alts array<string>")
    asked, real = [], scoring.predicted
    monkeypatch.setattr(scoring, "predicted", lambda inputs, *more: asked.append(inputs.count()) or real(inputs, *more))
    load = lambda: [scoring.StubScorer(w, 3, context) for w in (0.6, 1.0)]
    batches, write = {}, files.written
    monkeypatch.setattr(files, "written", lambda df, name, *more: batches.update({name: spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)}) or write(df, name, *more))
    got = {r["line_no"]: r for r in scoring.annotate(records, tx, blocks, load, distance, False, 3, size, context).collect()}
    assert batches == {"scoring-tasks": None, "scoring-predictions": str(8 << 20)} and spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None
    assert asked == [4]  # places that a transcript covers, whatever is asked for there
    reasons = {5: alleles.OTHER_REFERENCE, 6: alleles.LONG_REFERENCE, 8: alleles.UNREADABLE, 9: alleles.NEAR_END, 10: alleles.NO_TRANSCRIPT, 11: alleles.NO_ALTERNATIVE}
    assert {i: r["skip_reason"] for i, r in got.items()} == {i: reasons.get(i) for i in range(len(rows))}
    for i, (p, ref, alts) in enumerate(rows):
        wanted = []
        for alt in (a for a in alts if i not in reasons and a[0] != "<"):
            for _, gene, _, strand, a, b, *_ in table:
                if not a < p <= b:
                    continue
                if len(ref) > 1 and len(alt) > 1:
                    wanted.append("|".join([alt, gene, *"........"]))
                    continue
                x = "".join(c if a <= k < b else "N" for k, c in enumerate(bases))[p - 1 - half : p + half]
                y = x[:half] + alt + x[half + len(ref) :]
                if strand == "-":
                    x, y = (s[::-1].translate(str.maketrans("ACGTacgt", "TGCAtgca")) for s in (x, y))
                r, q = (scoring.ensemble(load(), scoring.one_hot([s]), 1)[0][:, 1:] for s in (x, y))
                r, q = (r[::-1], q[::-1]) if strand == "-" else (r, q)
                assert len(r) == cov
                wanted.append("|".join([alt, gene, *numpy_entry(r, q, len(ref), len(alt), 0, False).split("|")[2:]]))
        assert got[i]["annotation"] == (",".join(wanted) or None), i


def test_demo_scores_over_the_whole_context(spark, monkeypatch):
    from strandline.plans import demo

    widths = set()
    monkeypatch.setattr(scoring, "annotate", lambda *args, **more: widths.update([m.context for m in args[3]()] + [more.get("context", (*args, *[scoring.CONTEXT] * 9)[8])]))
    demo.scored(spark.createDataFrame([(1, "ACGT")], "doc_id long, sequence string"))
    assert widths == {10_000}


def test_ensemble_checks():
    class Wrong:
        def predict(self, inputs, batch_size, verbose):
            return np.zeros((len(inputs) + 1, 5, 3), np.float32)

    x = np.zeros((2, scoring.CONTEXT + 5, 4), np.uint8)
    with pytest.raises(RuntimeError, match="predictions"):
        scoring.ensemble([Wrong()], x, 1)
    assert scoring.ensemble([scoring.StubScorer()], x, 1).shape == (2, 5, 3)


def test_outside_check(spark, tmp_path):
    (tmp_path / "v.vcf").write_text(vcf_text([(7, "C|G|0.10|0.00|0.00|0.00|1|2|3|4")]))
    (tmp_path / "m.tsv").write_text("variant\tgene\nchr1-7-A-C\tG\n")
    folder = tmp_path / "responses"
    folder.mkdir()
    score = {"g_name": "G", "t_id": "t", "t_priority": "MS", "DS_AG": "0.1", "DS_AL": 0, "DS_DG": "0", "DS_DL": "0", "DP_AG": 1, "DP_AL": 2, "DP_DG": 3, "DP_DL": 4}
    answer = {"variant": "chr1-7-A-C", "hg": 38, "distance": 500, "mask": 1, "scores": [score, score | {"t_priority": "N"}]}

    def run(value):
        (folder / "chr1-7-A-C.json").write_text(json.dumps(value))
        spark.catalog.clearCache()
        return cli.main(["check", "--vcf", str(tmp_path / "v.vcf"), "--manifest", str(tmp_path / "m.tsv"), "--responses", str(folder), "--output-dir", str(tmp_path / "out")], spark), json.loads((tmp_path / "out" / "summary.json").read_text())[0]

    assert run(answer)[0] == 0
    code, told = run(answer | {"distance": 50})
    assert code == 1 and told["reasons"] == ["parameters differ"]
    code, told = run(answer | {"scores": [score, score]})
    assert code == 1 and "not all matched" in told["reasons"]
    code, told = run(answer | {"scores": [score | {"DS_AG": "0.2"}]})
    assert code == 1 and told["reasons"] == ["score difference"]


def test_sample_command(spark, tmp_path):
    (tmp_path / "i.vcf").write_text(vcf_text([(p, "DELTA=x;K=1") for p in range(1, 40)]))
    (tmp_path / "a.tsv").write_text(writers.ANNOTATION_HEADER + "\nG1\t1\t+\t2\t30\t2,\t30,\n")
    assert cli.main(["sample", "--input", str(tmp_path / "i.vcf"), "--annotation", str(tmp_path / "a.tsv"), "--output", str(tmp_path / "s.vcf"), "--target-records", "5", "--window", "3"], spark) == 0
    rows = [x.split("\t") for x in (tmp_path / "s.vcf").read_text().splitlines() if x[0] != "#"]
    assert [int(r[1]) for r in rows] == [1, 2, 3, 4, 5] and {r[7] for r in rows} == {"K=1"}


def test_provenance(spark, tmp_path):
    assert shards.run_fingerprint({"a": 1, "b": "x"}) == __import__("hashlib").sha256(b"a=1\nb=x\n").hexdigest()
    target = tmp_path / "f"
    target.write_text("old")
    with pytest.raises(RuntimeError):
        writers.atomically(str(target), (x for x in [b"new", None] if x or (_ for _ in ()).throw(RuntimeError)))
    assert target.read_text() == "old" and [p.name for p in tmp_path.iterdir()] == ["f"]
    assert readers.resources(spark, str(target)).head()["bytes"] == 3


def test_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.vcf").write_text(vcf_text([(1, "C|G|0.10|0.00|0.00|0.00|1|2|3|4"), (2, ".")]))
    stream_files.drain(stream_files.parsed(stream_files.arriving(spark, str(folder), "DELTA")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    assert [r["ds_ag"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["0.10"]


def test_registry_without_the_corpus_package():
    code = "import sys; sys.modules['strandline.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=str(__import__("pathlib").Path(__file__).parents[1]))


def test_a_tagged_transcript_needs_a_gene_name(spark, tmp_path):
    (tmp_path / "x.gtf").write_text(GTF.replace('gene_name "GENE"; ', ""))
    with pytest.raises(Exception, match="gene_name"):
        transcripts.converted(readers.gtf(spark, str(tmp_path / "x.gtf"))).collect()


def test_fasta_is_read_as_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "CHUNK", 3)
    rnd = random.Random(4)
    contigs = {f"c{i}": "".join(rnd.choice("ACGTNacgt") for _ in range(n)) for i, n in enumerate((1, 0, 57, 8, 130, 20))}
    text = "".join(f">{k} more words\n" + "".join(v[a : a + 7] + "\n" for a in range(0, len(v), 7)) + "\n" * (k == "c3") for k, v in contigs.items())
    (tmp_path / "x.fa").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        rows = sorted(readers.fasta(spark, str(tmp_path / "x.fa"), 10).collect(), key=lambda r: (r["ordinal"], r["block"]))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    found = {}
    for r in rows:
        assert r["start"] == 10 * r["block"] == len(found.get(r["contig"], ""))
        found[r["contig"]] = found.get(r["contig"], "") + r["sequence"]
    assert list(found) == list(contigs) and found == {k: v.upper() for k, v in contigs.items()}


def test_a_later_record_replaces_an_earlier_one(spark):
    entry = lambda alt, gene, score: f"{alt}|{gene}|{score}|0.00|0.00|0.00|1|2|3|4"
    rows = [
        (1, "1", "5", "A", "C,G", ",".join([entry("C", "X", "0.10"), entry("C", "Y", "0.20"), entry("G", "X", "0.30")])),
        (2, "1", "5", "A", "C", ",".join([entry("C", "X", "0.90"), entry("C", "X", "0.05")])),
    ]
    found = compare.local_index(spark.createDataFrame(rows, "line_no long, chrom string, pos string, ref string, alt string, annotation string")).collect()
    assert sorted((r["variant"], r["gene"], r["entry"][2]) for r in found) == [("chr1-5-A-C", "X", "0.05"), ("chr1-5-A-G", "X", "0.30")]


def test_shards_made_from_other_inputs_are_not_complete(spark, tmp_path):
    annotation, reference, plan = universe_files(tmp_path)
    shards.write_plan(spark, annotation, reference, plan, 100, ("snv",), "r1", None, None)
    out = str(tmp_path / "out")
    told = shards.generate(spark, plan, 1, out)
    assert shards.finalize(spark, plan, out, str(tmp_path / "m.tsv"))["records"] == told["records"]
    marker = next((tmp_path / "out").glob("*.complete.json"))
    kept = marker.read_text()
    for key in ("generator_sha256", "reference_sha256", "annotation_sha256"):
        marker.write_text(kept.replace(told[key], "0" * 64))
        with pytest.raises(ValueError, match="incomplete"):
            shards.finalize(spark, plan, out, str(tmp_path / "m.tsv"))
    marker.write_text(kept)
    Path(told["output"]).rename(tmp_path / "gone")
    with pytest.raises(ValueError, match="incomplete"):
        shards.finalize(spark, plan, out, str(tmp_path / "m.tsv"))


def test_ranges_of_tasks(spark, tmp_path):
    listed = tmp_path / "tasks.tsv"
    listed.write_text("#a\tb\nx\t1\n\ny\t2\n# more\nz\t3\n   \n")
    taken = lambda *span: [tuple(r) for r in readers.task_range(spark, str(listed), *span).orderBy("task").collect()]
    assert taken() == [(1, "x\t1"), (2, "y\t2"), (3, "z\t3")]
    assert taken(2) == taken(2, 3) == taken()[1:] and taken(2, 2) == taken()[1:2]
    assert all(readers.nth_task(spark, str(listed), n) == value for n, value in taken())
    for span in [(0,), (4,), (1, 4), (3, 2)]:
        with pytest.raises(ValueError, match="don't lie in 1..3"):
            taken(*span)
    (tmp_path / "none.tsv").write_text("# nothing\n\n")
    with pytest.raises(ValueError, match="no tasks"):
        readers.task_range(spark, str(tmp_path / "none.tsv"))


def test_generate_goes_through_a_range(spark, tmp_path, capsys):
    (tmp_path / "r.fa").write_text(">1\nACGTACGT\n")
    (tmp_path / "a.tsv").write_text(writers.ANNOTATION_HEADER + "\nG1\t1\t+\t0\t4\t0,\t4,\n")
    plan, out = str(tmp_path / "p.tsv"), tmp_path / "out"
    out.mkdir()
    shards.write_plan(spark, str(tmp_path / "a.tsv"), str(tmp_path / "r.fa"), plan, 100)
    args = ["generate", "--plan", plan, "--output-dir", str(out), "--task-id"]
    with pytest.raises(ValueError, match="don't lie in 1..2"):
        cli.main([*args, "1", "--last-task-id", "3"], spark)
    assert not list(out.iterdir())
    assert cli.main([*args, "2"], spark) == 0 and [p.name for p in out.glob("*.json")] == ["indel-000001.complete.json"]
    assert cli.main([*args, "1", "--last-task-id", "2"], spark) == 0
    assert sorted(p.name for p in out.glob("*.json")) == ["indel-000001.complete.json", "snv-000001.complete.json"]
    assert capsys.readouterr().out.count("records") >= 3
