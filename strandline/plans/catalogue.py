"""Catalogue of the engine's queries on the driver tables, each with its SQL twin where SQL can express it.

The tables hold no genomes, so stand-ins are used throughout:
intervals = lineitem [l_orderkey, l_orderkey + l_linenumber) on contig l_suppkey;
points = orders, contig o_custkey % suppliers, position o_orderkey;
sequences = documents with a-z mapped to ACGT in turn;
predictions = embeddings vec_id and vec_id + 1, 63 positions;
transcripts and exons = orders and lineitem; strata = customer.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import alleles, scores
from strandline.operators import compare, intervals, ranking, scoring, transcripts, universe
from strandline.plans import demo, shards
from strandline.sources import bgzf, files, readers, writers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return SQL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# stand-ins -----------------------------------------------------------------


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("contig"), F.col("l_orderkey").alias("start"), (F.col("l_orderkey") + F.col("l_linenumber")).alias("stop"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = table(spark, sf_dir, "lineitem").agg((F.max("l_suppkey") + 1).alias("contigs"))  # one row
    return table(spark, sf_dir, "orders").join(F.broadcast(size)).select((F.col("o_custkey") % F.col("contigs")).alias("contig"), F.col("o_orderkey").alias("pos"))


LETTERS, AS_BASES = "abcdefghijklmnopqrstuvwxyz", ("ACGT" * 7)[:26]


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", F.translate(text, LETTERS, AS_BASES).alias("sequence"))


def anchored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors of the sequences. Letters keep their case, so only A, C, G and T count as they stand."""
    whole = sequences(spark, sf_dir).select(F.col("doc_id").alias("contig"), F.lit(0).alias("start"), F.length("sequence").alias("stop"), F.regexp_replace("sequence", "[acgt]", "n").alias("sequence"))
    return universe.anchors(whole.withColumn("sequence", F.regexp_replace("sequence", "[^ACGT]", ".")))


ISLANDS = """
raw as (select l_suppkey as contig, l_orderkey as start, l_orderkey + l_linenumber as stop from lineitem),
marked as (select *, case when start <= max(stop) over (partition by contig order by start, stop rows between unbounded preceding and 1 preceding) then 0 else 1 end as opens from raw),
numbered as (select *, sum(opens) over (partition by contig order by start, stop rows unbounded preceding) as island from marked),
islands as (select contig, min(start) as start, max(stop) as stop from numbered group by contig, island)"""
POINTS = "points as (select o_custkey % (select max(l_suppkey) + 1 from lineitem) as contig, o_orderkey as pos from orders)"
SEQUENCES = f"sequences as (select doc_id, translate(coalesce(text, ''), '{LETTERS}', '{AS_BASES}') as sequence from documents)"
ANCHORS = f"""{SEQUENCES},
bases as (select doc_id, unnest(string_split(sequence, '')) as base, generate_subscripts(string_split(sequence, ''), 1) as pos from sequences where sequence <> ''),
spelt as (select doc_id, pos, base as anchor, coalesce(lead(base, 1) over w, '') || coalesce(lead(base, 2) over w, '') || coalesce(lead(base, 3) over w, '') || coalesce(lead(base, 4) over w, '') as after from bases window w as (partition by doc_id order by pos)),
anchors as (select * from spelt where anchor in ('A', 'C', 'G', 'T'))"""


# intervals -----------------------------------------------------------------


@query(f"with {ISLANDS} select contig, start, stop from islands")
def interval_union(spark, sf_dir):
    return intervals.union(spans(spark, sf_dir))


@query(f"with {ISLANDS} select contig, count(*) as islands, cast(sum(stop - start) as bigint) as bases from islands group by contig")
def interval_union_bases(spark, sf_dir):
    return interval_union(spark, sf_dir).groupBy("contig").agg(F.count("*").alias("islands"), F.sum(F.col("stop") - F.col("start")).alias("bases"))


TILES = """
laid as (select *, coalesce(sum(stop - start) over (partition by contig order by start rows between unbounded preceding and 1 preceding), 0) as offs from islands),
cut as (select *, unnest(range(cast(offs // {0} as bigint), cast((offs + stop - start - 1) // {0} as bigint) + 1)) as tile from laid),
tiles as (select contig, tile, cast(start + greatest(offs, tile * {0}) - offs as bigint) as start, cast(start + least(offs + stop - start, (tile + 1) * {0}) - offs as bigint) as stop from cut)"""


@query(f"with {ISLANDS}, {TILES.format(50)} select contig, tile, start, stop from tiles")
def capacity_tiles(spark, sf_dir):
    return intervals.tiles(interval_union(spark, sf_dir), 50)


def planned(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("contig"), F.concat(F.lit("chr"), F.col("s_suppkey").cast("string")).alias("reference"), F.col("s_suppkey").alias("ordinal"))
    bound = interval_union(spark, sf_dir).join(named, "contig").withColumn("contig", F.col("contig").cast("string"))
    return shards.plan(bound, 1200)


PLAN = f"""with {ISLANDS}, {TILES.format(400).replace('laid', 'laid_s').replace('cut', 'cut_s').replace('tiles', 'tiles_s')}, {TILES.format(150).replace('laid', 'laid_i').replace('cut', 'cut_i').replace('tiles', 'tiles_i')},
every as (select 'snv' as kind, 3 as per_base, * from tiles_s union all select 'indel', 8, * from tiles_i),
shards as (select kind, per_base, contig, tile, string_agg('["' || contig || '","chr' || contig || '",' || start || ',' || stop || ']', ',' order by start) as regions, sum(stop - start) as bases from every group by all),
planned as (select kind, row_number() over (partition by kind order by contig, tile) as number, '[' || regions || ']' as regions, cast(bases * per_base as bigint) as estimated_records from shards)"""


@query(f"{PLAN} select kind, kind || '-' || lpad(cast(number as varchar), 6, '0') as shard_id, number, regions, estimated_records from planned")
def shard_plan(spark, sf_dir):
    return planned(spark, sf_dir).withColumn("regions", alleles.regions_json(F.col("regions")))


@query(f"{PLAN} select kind, count(*) as tasks, cast(sum(estimated_records) as bigint) as estimated_records from planned group by kind")
def plan_totals(spark, sf_dir):
    return shards.totals(planned(spark, sf_dir))


@query(f"with {ISLANDS}, {POINTS} select p.contig, pos, start, stop from points p join islands i on p.contig = i.contig and start < pos and pos <= stop")
def stabbing_join(spark, sf_dir):
    return intervals.stab(points(spark, sf_dir), interval_union(spark, sf_dir)).select("contig", "pos", "start", "stop")


@query(f"with {ISLANDS}, {POINTS} select p.contig, count(*) as hits, count(distinct pos) as positions from points p join islands i on p.contig = i.contig and start < pos and pos <= stop group by p.contig")
def stabbing_count(spark, sf_dir):
    return stabbing_join(spark, sf_dir).groupBy("contig").agg(F.count("*").alias("hits"), F.countDistinct("pos").alias("positions"))


@query(f"""with {POINTS},
marks as (select distinct l_suppkey as contig, unnest([l_orderkey + 1, l_orderkey + l_linenumber]) as boundary from lineitem),
spots as (select distinct contig, pos from points),
below as (select p.contig, pos, max(b) as low from spots p asof left join (select contig as c, boundary as b from marks) m on p.contig = m.c and pos >= b group by p.contig, pos),
above as (select p.contig, pos, min(b) as high from spots p asof left join (select contig as c, boundary as b from marks) m on p.contig = m.c and pos <= b group by p.contig, pos),
near as (select contig, pos, case when low is null then high when high is null or pos - low <= high - pos then low else high end as boundary from below join above using (contig, pos))
select contig, pos, boundary, boundary - pos as distance from near""")
def nearest_boundary(spark, sf_dir):
    raw = spans(spark, sf_dir)
    return intervals.nearest(points(spark, sf_dir), raw.select("contig", F.explode(F.array(F.col("start") + 1, "stop")).alias("boundary")))


@query("""with names as (select distinct case n_nationkey % 4 when 0 then 'chr' || n_nationkey when 1 then '' || n_nationkey when 2 then 'MT' else 'chrM' end as contig from nation),
refs as (select distinct case when n_nationkey % 3 = 0 then 'chr' || n_nationkey else '' || n_nationkey end as reference from nation union select 'chrM' union select 'chr5' union select 'chr8'),
wanted as (select contig, contig as reference from names union select contig, case when starts_with(contig, 'chr') then contig[4:] else 'chr' || contig end from names
  union select contig, unnest(['M', 'chrM']) from names where contig = 'MT' union select contig, unnest(['MT', 'chrMT']) from names where contig in ('M', 'chrM')),
hits as (select contig, count(*) as n, min(w.reference) as reference from wanted w join refs r on w.reference = r.reference group by contig)
select n.contig, coalesce(h.n, 0) as matches, case when h.n = 1 then h.reference end as reference from names n left join hits h on n.contig = h.contig""")
def contig_resolution(spark, sf_dir):
    key = F.col("n_nationkey").cast("string")
    nation = table(spark, sf_dir, "nation")
    names = nation.select(F.when(F.col("n_nationkey") % 4 == 0, F.concat(F.lit("chr"), key)).when(F.col("n_nationkey") % 4 == 1, key).when(F.col("n_nationkey") % 4 == 2, "MT").otherwise("chrM").alias("contig"))
    own = nation.select(F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("chr"), key)).otherwise(key).alias("reference"))
    more = spark.range(1).select(F.explode(F.array(*map(F.lit, ("chrM", "chr5", "chr8")))).alias("reference"))
    return intervals.resolve_contigs(names, own.union(more))


@query("""with records as (select o_custkey % 50 as contig, o_orderkey as pos, repeat('A', cast(1 + o_orderkey % 4 as integer)) as ref from orders),
spans as (select distinct l_suppkey % 50 as contig, l_orderkey as start, l_orderkey + 2 as stop, l_suppkey as name from lineitem where l_linenumber = 1)
select r.contig, pos, start, name from records r join spans s on r.contig = s.contig and pos - 1 < stop and pos - 1 + length(ref) > start""")
def range_scan(spark, sf_dir):
    """The spans of first lines alone, as its SQL has it; range_scan_all takes every line."""
    return scanned(spark, sf_dir, table(spark, sf_dir, "lineitem").where("l_linenumber = 1"))


RECORDS = "records as (select o_custkey % 50 as contig, o_orderkey + {shift} as pos, repeat('A', cast(1 + o_orderkey % 4 as integer)) as ref from orders)"
SPANS = "spans as (select distinct l_suppkey % 50 as contig, l_orderkey as start, l_orderkey + 2 as stop, l_suppkey as name from lineitem)"
MEET = "select r.contig, pos, start, name from records r join spans s on r.contig = s.contig and pos - 1 < stop and pos - 1 + length(ref) > start"


@query(f"with {RECORDS.format(shift=0)}, {SPANS} {MEET}")
def range_scan_all(spark, sf_dir):
    return scanned(spark, sf_dir, table(spark, sf_dir, "lineitem"))


def order_file(spark: SparkSession, sf_dir: str) -> str:
    """Orders as records of a block-compressed file with an index, in the shared folder."""
    key = F.col("o_orderkey")
    records = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).cast("string").alias("chrom"), (key + 1).alias("pos"), F.concat(F.lit("o"), key.cast("string")).alias("id"), F.repeat(F.lit("A"), (key % 4 + 1).cast("int")).alias("ref"), *(F.lit(".").alias(c) for c in ("alt", "qual", "filter", "info")))
    path = f"{files.shared_dir(spark)}/orders-{uuid.uuid4().hex}.vcf.gz"
    lines = records.select("chrom", "pos", "id", "ref", writers.vcf_line().alias("line"))
    writers.write_lines(lines, ["chrom", "pos", "id"], path, ["##fileformat=VCFv4.2"], writers.record_span())
    return path


@query(f"with {RECORDS.format(shift=1)}, {SPANS} {MEET}")
def indexed_range_scan(spark, sf_dir):
    """The spans of all lines, read from the blocks that the file's index names."""
    wanted = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 50).cast("string").alias("contig"), F.col("l_orderkey").alias("start"), (F.col("l_orderkey") + 2).alias("stop"), F.col("l_suppkey").alias("name")).distinct()
    return readers.vcf_range(spark, order_file(spark, sf_dir), wanted, "DELTA").select(F.col("contig").cast("long").alias("contig"), "pos", "start", "name")


@query("select cast(1 + row_number() over (order by cast(o_custkey % 50 as varchar), o_orderkey) as bigint) as line_no, o_orderkey from orders")
def block_line_numbers(spark, sf_dir):
    """Lines of a block-compressed file, written by one sort and read by ranges of its bytes, with their numbers."""
    lines = bgzf.numbered(spark, order_file(spark, sf_dir), 1 << 16)
    return lines.where(~F.col("value").startswith("#")).select("line_no", F.substring(F.split("value", "\t")[2], 2, 20).cast("long").alias("o_orderkey"))


def scanned(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Records of orders that meet the spans of ``lines``."""
    records = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("contig"), F.col("o_orderkey").alias("pos"), F.repeat(F.lit("A"), (F.col("o_orderkey") % 4 + 1).cast("int")).alias("ref"))
    wanted = lines.select((F.col("l_suppkey") % 50).alias("contig"), F.col("l_orderkey").alias("start"), (F.col("l_orderkey") + 2).alias("stop"), F.col("l_suppkey").alias("name")).distinct()
    return intervals.overlapping(records, wanted).select("contig", "pos", "start", "name")


# variant universe ----------------------------------------------------------


def summed(records: DataFrame) -> DataFrame:
    """All records of a kind, added up by sequence and alleles; their number alone would fit no driver."""
    return records.groupBy(F.col("contig").alias("doc_id"), "ord", "ref", "alt").agg(F.count("*").alias("n"), F.sum("pos").alias("sum_pos"))


@query(f"""with {ANCHORS}, other as (select doc_id, pos, anchor as ref, unnest(list_filter(['A', 'C', 'G', 'T'], lambda b: b <> anchor)) as alt, unnest([0, 1, 2]) as ord from anchors)
select doc_id, ord, ref, alt, count(*) as n, cast(sum(pos) as bigint) as sum_pos from other group by all""")
def snv_universe(spark, sf_dir):
    return summed(universe.substitutions(anchored(spark, sf_dir)))


@query(f"""with {ANCHORS}, added as (select doc_id, pos, anchor as ref, anchor || unnest(['A', 'C', 'G', 'T']) as alt, unnest([0, 1, 2, 3]) as ord from anchors)
select doc_id, ord, ref, alt, count(*) as n, cast(sum(pos) as bigint) as sum_pos from added group by all""")
def insertion_universe(spark, sf_dir):
    return summed(universe.insertions(anchored(spark, sf_dir)))


@query(f"""with {ANCHORS}, known as (select *, length(regexp_extract(after, '^[ACGT]*')) as k from anchors),
gone as (select doc_id, pos, anchor, after, unnest(range(1, k + 1)) as k from known)
select doc_id, cast(k + 3 as integer) as ord, anchor || after[1:k] as ref, anchor as alt, count(*) as n, cast(sum(pos) as bigint) as sum_pos from gone group by all""")
def deletion_universe(spark, sf_dir):
    """Added up by the reference allele alone, which tells order and alternative."""
    added = universe.deletions(anchored(spark, sf_dir)).groupBy(F.col("contig").alias("doc_id"), "ref").agg(F.count("*").alias("n"), F.sum("pos").alias("sum_pos"))
    return added.select("doc_id", (F.length("ref") + len(alleles.BASES) - 2).alias("ord"), "ref", F.substring("ref", 1, 1).alias("alt"), "n", "sum_pos")


@query(f"""with {ANCHORS}, told as (select length(regexp_extract(after, '^[ACGT]*')) as k from anchors)
select unnest(['snv', 'indel']) as kind, unnest([count(*), count(*)]) as bases, unnest([3 * count(*), cast(4 * count(*) + sum(k) as bigint)]) as records from told""")
def universe_counts(spark, sf_dir):
    found = anchored(spark, sf_dir)
    known = F.length(F.regexp_extract("after", "^[ACGT]*", 0))
    told = found.agg(F.count("*").alias("bases"), F.sum(known).alias("deleted"))
    snv = F.struct(F.lit("snv").alias("kind"), F.col("bases"), (3 * F.col("bases")).alias("records"))
    indel = F.struct(F.lit("indel").alias("kind"), F.col("bases"), (4 * F.col("bases") + F.coalesce("deleted", F.lit(0))).alias("records"))
    return told.select(F.inline(F.array(snv, indel)))


# sequence windows ----------------------------------------------------------


def windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole sequences of odd length as windows, with made-up transcript ends."""
    odd = sequences(spark, sf_dir).select("doc_id", F.expr("substring(sequence, 1, length(sequence) - (length(sequence) + 1) % 2)").alias("window"))
    return odd.withColumn("width", F.length("window")).withColumn("to_start", -(F.col("doc_id") % 97)).withColumn("to_end", F.col("doc_id") % 61)


WINDOWS = f"{SEQUENCES}, w as (select doc_id, sequence[1:length(sequence) - (length(sequence) + 1) % 2] as win, length(sequence) - (length(sequence) + 1) % 2 as width from sequences)"


@query(f"""with {WINDOWS}, p as (select *, greatest(width // 2 - doc_id % 97, 0) as l, greatest(width // 2 - doc_id % 61, 0) as r from w)
select doc_id, repeat('N', l) || win[l + 1:width - r] || repeat('N', r) as padded from p where width > 0""")
def padded_window(spark, sf_dir):
    return windowed(spark, sf_dir).where("width > 0").select("doc_id", alleles.padded_window(F.col("window"), F.col("width"), F.col("to_start"), F.col("to_end")).alias("padded"))


@query(f"""with {WINDOWS} select doc_id, win[1:width // 2] || 'TTT' || win[width // 2 + 1 + 1 + doc_id % 3:] as substituted from w where width > 0""")
def alt_substitution(spark, sf_dir):
    ref = F.repeat(F.lit("A"), (F.col("doc_id") % 3 + 1).cast("int"))
    return windowed(spark, sf_dir).where("width > 0").select("doc_id", alleles.substituted(F.col("window"), F.col("width"), ref, F.lit("TTT")).alias("substituted"))


@query(f"with {SEQUENCES} select doc_id, reverse(translate(sequence, 'ACGT', 'TGCA')) as turned from sequences")
def revcomp(spark, sf_dir):
    return sequences(spark, sf_dir).select("doc_id", alleles.reverse_complement(F.col("sequence")).alias("turned"))


@query("""with v as (select p_partkey, p_name[1:1 + p_size % 3] as ref, p_brand[1:1 + p_size % 4] || case p_size % 7 when 0 then '.' when 1 then '<DEL>' when 2 then '*' when 3 then '-' else '' end as alt, p_type as gene from part)
select p_partkey, alt, regexp_matches(alt, '[.*<>-]') as symbolic, case when length(ref) > 1 and length(alt) > 1 then alt || '|' || gene || '|.|.|.|.|.|.|.|.' end as entry from v""")
def symbolic_allele_filter(spark, sf_dir):
    tail = F.when(F.col("p_size") % 7 == 0, ".").when(F.col("p_size") % 7 == 1, "<DEL>").when(F.col("p_size") % 7 == 2, "*").when(F.col("p_size") % 7 == 3, "-").otherwise("")
    made = table(spark, sf_dir, "part").select("p_partkey", F.expr("substring(p_name, 1, 1 + p_size % 3)").alias("ref"), F.concat(F.expr("substring(p_brand, 1, 1 + p_size % 4)"), tail).alias("alt"), F.col("p_type").alias("gene"))
    return made.select("p_partkey", "alt", alleles.is_symbolic(F.col("alt")).alias("symbolic"), F.when(alleles.is_block_substitution(F.col("ref"), F.col("alt")), alleles.unscored_entry(F.col("alt"), F.col("gene"))).alias("entry"))


@query("""with r as (select o_orderkey, o_orderkey % 11 <> 0 as has_alts, o_orderkey % 7 as n,
  case when o_orderkey % 13 = 0 then null else repeat('a', 5002) || case when o_orderkey % 5 = 0 then 'c' else 'g' end || repeat('t', cast(5002 - o_orderkey % 2 as integer)) end as win,
  case when o_orderkey % 3 = 0 then 'GTTTTT' else 'G' end as ref from orders)
select o_orderkey, case when not has_alts then 'no alternative' when n = 0 then 'outside transcripts' when win is null then 'unreadable sequence' when upper(win[5003:5002 + length(ref)]) <> ref then 'another reference base'
  when length(win) <> 10005 then 'context past the contig' when length(ref) > 4 then 'long reference allele' end as reason from r""")
def skip_reason(spark, sf_dir):
    key = F.col("o_orderkey")
    middle = F.when(key % 5 == 0, "c").otherwise("g")
    window = F.when(key % 13 != 0, F.concat(F.repeat(F.lit("a"), 5002), middle, F.repeat(F.lit("t"), (F.lit(5002) - key % 2).cast("int"))))
    ref = F.when(key % 3 == 0, "GTTTTT").otherwise("G")
    return table(spark, sf_dir, "orders").select("o_orderkey", alleles.skip_reason(key % 11 != 0, key % 7, window, ref, 2).alias("reason"))


# predictions ---------------------------------------------------------------

COV = 63


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    ref = rows.select("vec_id", F.slice("embedding", 1, COV).alias("ref"), F.slice("embedding", 2, COV).alias("ref2"))
    alt = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.slice("embedding", 1, COV).alias("alt"), F.slice("embedding", 2, COV).alias("alt2"), "label")
    return ref.join(alt, "vec_id")


PAIRS = "pairs as (select a.vec_id, a.embedding[1:63] as ref, a.embedding[2:64] as ref2, b.embedding[1:63] as alt, b.embedding[2:64] as alt2, b.label from embeddings a join embeddings b on b.vec_id = a.vec_id + 1)"


def delta_sql(x: str, y: str) -> str:
    return f"list_transform(list_zip({x}, {y}), lambda p: p[1] - p[2])"


@query(f"""with {PAIRS}, d as (select vec_id, {delta_sql('alt', 'ref')} as gain, {delta_sql('ref', 'alt')} as loss from pairs)
select vec_id, cast(list_position(gain, list_max(gain)) - 1 as integer) as gain_at, cast(list_max(gain) as double) as gain, cast(list_position(loss, list_max(loss)) - 1 as integer) as loss_at, cast(list_max(loss) as double) as loss from d""")
def delta_argmax(spark, sf_dir):
    one = F.lit(1)
    found = predictions(spark, sf_dir).select("vec_id", *(c.alias(n) for c, n in zip(scores.channel_scores(F.col("ref"), F.col("alt"), COV, one, one), ("g", "l"))))
    return found.select("vec_id", F.col("g.at").alias("gain_at"), F.col("g.value").alias("gain"), F.col("l.at").alias("loss_at"), F.col("l.value").alias("loss"))


@query(f"""with {PAIRS}, a as (select vec_id, ref, cast(alt[1:63 - (1 + vec_id % 4)] as double[]) as short, 1 + vec_id % 4 as gone from pairs),
l as (select vec_id, list_concat(list_concat(short[1:32], list_transform(range(gone), lambda i: 0.0::double)), short[33:]) as alt, cast(ref as double[]) as ref from a),
d as (select vec_id, {delta_sql('alt', 'ref')} as gain from l)
select vec_id, cast(list_position(gain, list_max(gain)) - 1 as integer) as gain_at, list_max(gain) as gain, cast(len(gain) as integer) as n from d""")
def deletion_align(spark, sf_dir):
    gone = (F.col("vec_id") % 4 + 1).cast("int")
    short = predictions(spark, sf_dir).withColumn("alt", F.slice("alt", F.lit(1), F.lit(COV) - gone)).withColumn("gone", gone)
    aligned = scores.align_deletion(F.col("alt"), COV, F.col("gone") + 1, F.lit(1))
    return short.select("vec_id", scores.peak(scores.difference(aligned, F.col("ref").cast("array<double>"))).alias("g"), F.size(aligned).alias("n")).select("vec_id", F.col("g.at").alias("gain_at"), F.col("g.value").alias("gain"), "n")


@query(f"""with {PAIRS}, l as (select vec_id, list_concat(list_append(alt[1:31], list_max(alt[32:32 + vec_id % 5 + 1])), list_concat(alt[32 + vec_id % 5 + 2:], ref[1:vec_id % 5 + 1])) as alt from pairs)
select vec_id, cast(len(alt) as integer) as n, cast(alt[32] as double) as middle, cast(list_max(alt) as double) as largest from l""")
def insertion_align(spark, sf_dir):
    # as many positions more as the allele has bases more than one
    more = (F.col("vec_id") % 5 + 1).cast("int")
    longer = predictions(spark, sf_dir).withColumn("alt", F.concat("alt", F.slice("ref", F.lit(1), more))).withColumn("more", more)
    aligned = scores.align_insertion(F.col("alt"), COV, F.col("more") + 1)
    return longer.select("vec_id", F.size(aligned).alias("n"), F.get(aligned, F.lit(31)).cast("double").alias("middle"), F.array_max(aligned).cast("double").alias("largest"))


def masked_sql() -> str:
    parts = []
    for name, x, y in (("ag", "alt", "ref"), ("al", "ref", "alt"), ("dg", "alt2", "ref2"), ("dl", "ref2", "alt2")):
        parts.append(f"{delta_sql(x, y)} as {name}")
    values = ", ".join(f"cast(list_max({n}) as double) as v_{n}, list_position({n}, list_max({n})) - 32 as p_{n}" for n in ("ag", "al", "dg", "dl"))
    shown = " || '|' || ".join(f"printf('%.2f', case when p_{n} {'=' if n[1] == 'g' else '<>'} label - 5 then v_{n} * 0 else v_{n} end)" for n in ("ag", "al", "dg", "dl"))
    places = " || '|' || ".join(f"p_{n}" for n in ("ag", "al", "dg", "dl"))
    return f"with {PAIRS}, d as (select vec_id, label, {', '.join(parts)} from pairs), v as (select vec_id, label, {values} from d) select vec_id, 'A|G' || label || '|' || {shown} || '|' || {places} as entry from v"


@query(masked_sql())
def masked_score_string(spark, sf_dir):
    one = F.lit(1)
    rows = predictions(spark, sf_dir)
    acceptor = scores.channel_scores(F.col("ref"), F.col("alt"), COV, one, one)
    donor = scores.channel_scores(F.col("ref2"), F.col("alt2"), COV, one, one)
    found = rows.select("vec_id", "label", *(c.alias(n) for n, c in zip(("ag", "al", "dg", "dl"), (*acceptor, *donor))))
    return found.select("vec_id", scores.score_entry(F.lit("A"), F.concat(F.lit("G"), F.col("label").cast("string")), (F.col("ag"), F.col("al")), (F.col("dg"), F.col("dl")), COV, F.col("label") - 5, True).alias("entry"))


@query("select vec_id, cast((case when label % 2 = 0 then list_reverse(embedding) else embedding end)[1] as double) as first, cast((case when label % 2 = 0 then list_reverse(embedding) else embedding end)[-1] as double) as last from embeddings")
def minus_strand_orientation(spark, sf_dir):
    turned = scores.oriented(F.col("embedding"), F.col("label") % 2 == 0)
    return table(spark, sf_dir, "embeddings").select("vec_id", F.element_at(turned, 1).cast("double").alias("first"), F.element_at(turned, -1).cast("double").alias("last"))


@query("""with models as (select vec_id // 5 as batch, count(*) as models, list(embedding order by vec_id) as found from embeddings group by 1),
summed as (select batch, models, list_reduce(found, lambda a, b: list_transform(list_zip(a, b), lambda x: x[1] + x[2])) as total from models)
select batch, cast(place as integer) as place, models, cast(cast(x as float) / cast(models as float) as double) as mean
from (select batch, models, unnest(total) as x, unnest(range(64)) as place from summed)""")
def ensemble_mean(spark, sf_dir):
    """The mean of five models, each of which predicts a vector, in single precision and in their order."""
    files.ship(spark)
    batches = table(spark, sf_dir, "embeddings").groupBy(F.floor(F.col("vec_id") / 5).alias("batch")).agg(F.array_sort(F.collect_list(F.struct("vec_id", "embedding"))).alias("found"))

    def run(frames):
        for frame in frames:
            for batch, found in zip(frame["batch"], frame["found"]):
                told = [demo.Told(np.asarray(f["embedding"], np.float32)) for f in found]
                mean = scoring.ensemble(told, np.zeros((1, 64, 4), np.uint8), 1)[0]
                yield pd.DataFrame({"batch": batch, "place": np.arange(len(mean), dtype=np.int32), "models": len(told), "mean": mean.astype(np.float64)})

    return batches.mapInPandas(run, "batch long, place int, models long, mean double")


@query(f"""with {POINTS}, keys as (select distinct contig, pos % 1000 as pos from points), done as (select contig, pos, (contig * 31 + pos * 17) % 101 as score from keys)
select p.contig, p.pos, d.score from points p join done d on p.contig = d.contig and p.pos % 1000 = d.pos""")
def compute_once_join_back(spark, sf_dir):
    rows = points(spark, sf_dir).withColumn("key", F.col("pos") % 1000)
    return scoring.computed_once(rows, ["contig", "key"], lambda keys: keys.withColumn("score", (F.col("contig") * 31 + F.col("key") * 17) % 101)).select("contig", "pos", "score")


@query("select length(coalesce(text, '')) as length, count(*) as n from documents group by 1")
def length_groups(spark, sf_dir):
    return scoring.by_length(sequences(spark, sf_dir))


# annotation strings --------------------------------------------------------


def entry_text(shift: Column | None = None) -> Column:
    """A made-up annotation entry of a lineitem row; one field short where the quantity is below 5."""
    moved = F.lit(0) if shift is None else shift
    fields = [F.col("l_returnflag"), F.concat(F.lit("G"), (F.col("l_suppkey") % 7).cast("string")), *(F.format_number(c, 2) for c in (F.col("l_discount"), F.col("l_tax"), F.col("l_discount") / 2)), F.lit("0.00"), F.col("l_linenumber").cast("string"), (F.col("l_linenumber") + moved).cast("string"), F.lit("-3")]
    return F.when(F.col("l_quantity") < 5, F.concat_ws("|", *fields)).otherwise(F.concat_ws("|", *fields, F.lit("4")))


ENTRY = "l_returnflag || '|G' || (l_suppkey % 7) || '|' || printf('%.2f', l_discount) || '|' || printf('%.2f', l_tax) || '|' || printf('%.2f', l_discount / 2) || '|0.00|' || l_linenumber || '|' || (l_linenumber + {0}) || '|-3' || case when l_quantity < 5 then '' else '|4' end"
ROW_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate", "l_returnflag")


@query(f"with t as (select string_split({ENTRY.format(0)}, '|') as f, l_orderkey from lineitem) select l_orderkey, f[1] as alt, f[2] as gene, cast(f[3] as double) as ds_ag, cast(f[7] as integer) as dp_ag from t where len(f) = 10")
def annotation_parse(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.explode(alleles.entries(entry_text())).alias("e"))
    return rows.select("l_orderkey", F.col("e")[0].alias("alt"), F.col("e")[1].alias("gene"), F.col("e")[2].cast("double").alias("ds_ag"), F.col("e")[6].cast("int").alias("dp_ag"))


def order_annotations(spark: SparkSession, sf_dir: str, shift: Column | None = None) -> DataFrame:
    """line_no and the entries of an order's lines, in an order that depends on values alone."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("line_no"), F.struct(*ROW_ORDER, entry_text(shift).alias("entry")).alias("r"))
    return rows.groupBy("line_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda x: x["entry"]), ",").alias("annotation"))


ORDERED = ", ".join(ROW_ORDER)
ENTRIES = "e{1} as (select l_orderkey as line_no, string_split({0}, '|') as f, row_number() over (partition by l_orderkey order by " + ORDERED + ") as r from lineitem), k{1} as (select line_no, f[1] as alt, f[2] as gene, arg_max(f, r) as f, min(r) as r from e{1} where len(f) = 10 group by all)"


@query(f"with {ENTRIES.format(ENTRY.format(0), '')} select line_no, alt, gene, f[3] as ds_ag, f[7] as dp_ag from k")
def last_wins_map(spark, sf_dir):
    rows = order_annotations(spark, sf_dir).select("line_no", F.explode(alleles.entry_map(F.col("annotation"))).alias("e"))
    return rows.select("line_no", F.col("e")[0].alias("alt"), F.col("e")[1].alias("gene"), F.col("e")[2].alias("ds_ag"), F.col("e")[6].alias("dp_ag"))


INFO_SQL = "case o_orderkey % 4 when 0 then 'DS=' || o_orderkey when 1 then 'A=' || o_orderstatus || ';DS=1;;B=2' when 2 then 'DS=;DS=3' else 'A=1;ADS=2' end"


@query(f"""with t as (select o_orderkey, {INFO_SQL} as info from orders), s as (select o_orderkey, info, list_filter(string_split(info, ';'), lambda x: x <> '' and not starts_with(x, 'DS=')) as kept from t)
select o_orderkey, regexp_extract(info, '(?:^|;)DS=([^;]*)', 1) as value, case when len(kept) = 0 then '.' else array_to_string(kept, ';') end as info from s""")
def strip_info_key(spark, sf_dir):
    key = F.col("o_orderkey")
    info = F.when(key % 4 == 0, F.concat(F.lit("DS="), key.cast("string"))).when(key % 4 == 1, F.concat(F.lit("A="), F.col("o_orderstatus"), F.lit(";DS=1;;B=2"))).when(key % 4 == 2, "DS=;DS=3").otherwise("A=1;ADS=2")
    return table(spark, sf_dir, "orders").select("o_orderkey", alleles.info_value(info, "DS").alias("value"), alleles.without_info(info, "DS").alias("info"))


def annotated_orders(spark: SparkSession, sf_dir: str, changed: bool) -> DataFrame:
    """Orders as records; in the changed copy some positions, alleles and entries differ."""
    shift = F.when(F.col("l_orderkey") % 5 == 0, 1).otherwise(0) if changed else None
    key = F.col("o_orderkey")
    alt = F.when(key % 97 == 0, "T").otherwise("C") if changed else F.lit("C")
    rows = table(spark, sf_dir, "orders").select(key.alias("line_no"), F.lit("1").alias("chrom"), key.alias("pos"), F.lit(".").alias("id"), F.lit("A").alias("ref"), alt.alias("alt"))
    told = order_annotations(spark, sf_dir, shift)
    if changed:
        told = told.withColumn("annotation", F.when(F.col("line_no") % 11 == 0, F.regexp_replace("annotation", r"\|0\.00\|", "|0.04|")).when(F.col("line_no") % 13 == 0, F.lit("")).otherwise(F.col("annotation")))
    return rows.join(told, "line_no", "left").withColumn("annotation", F.coalesce("annotation", F.lit("")))


CHANGED = "case when l_orderkey % 11 = 0 then replace({0}, '|0.00|', '|0.04|') else {0} end".format(ENTRY.format("case when l_orderkey % 5 = 0 then 1 else 0 end"))
DIFFS = f"""{ENTRIES.format(ENTRY.format(0), '_a')}, {ENTRIES.format(CHANGED, '_b')},
kb as (select * from k_b where line_no % 13 <> 0 or line_no % 11 = 0),
texts as (select l_orderkey as line_no, string_agg({ENTRY.format(0)}, ',' order by {ORDERED}) as a, case when l_orderkey % 13 = 0 and l_orderkey % 11 <> 0 then '' else string_agg({CHANGED}, ',' order by {ORDERED}) end as b from lineitem group by l_orderkey)"""


@query(f"""with {DIFFS},
fields as (select x.line_no, unnest(x.f[3:6]) as sa, unnest(y.f[3:6]) as sb, unnest(x.f[7:10]) as pa, unnest(y.f[7:10]) as pb from k_a x join kb y on x.line_no = y.line_no and x.alt = y.alt and x.gene = y.gene)
select (select count(*) from orders) as records, (select count(*) from orders where o_orderkey % 97 = 0) as identity_different,
  (select count(*) from orders join texts on o_orderkey = line_no where a <> b) as annotations_different,
  (select count(*) from k_a x full join kb y on x.line_no = y.line_no and x.alt = y.alt and x.gene = y.gene where (x.line_no is null or y.line_no is null) and coalesce(x.line_no, y.line_no) in (select o_orderkey from orders)) as entries_missing,
  count(*) filter (where sa <> sb) as score_fields_different, count(*) filter (where pa <> pb) as position_fields_different,
  count(*) filter (where pa <> pb and greatest(cast(sa as double), cast(sb as double)) > 0.01) as nontrivial_position_fields_different,
  coalesce(max(abs(cast(sa as double) - cast(sb as double))), 0.0) as max_score_difference, false as passed
from fields where line_no in (select o_orderkey from orders)""")
def positional_diff_summary(spark, sf_dir):
    return compare.comparison(annotated_orders(spark, sf_dir, False), annotated_orders(spark, sf_dir, True))


@query(f"""with {DIFFS} select coalesce(x.line_no, y.line_no) as line_no, coalesce(x.alt, y.alt) as alt, coalesce(x.gene, y.gene) as gene, case when x.line_no is null then 'candidate' else 'baseline' end as side
from k_a x full join kb y on x.line_no = y.line_no and x.alt = y.alt and x.gene = y.gene where (x.line_no is null or y.line_no is null) and coalesce(x.line_no, y.line_no) in (select o_orderkey from orders)""")
def entry_symmetric_difference(spark, sf_dir):
    return compare.entry_differences(annotated_orders(spark, sf_dir, False), annotated_orders(spark, sf_dir, True))


@query(f"with {ENTRIES.format(ENTRY.format(0), '')} select 'chr1-' || line_no || '-A-' || alt as variant, gene, array_to_string(f, '|') as entry from e, lateral (select f[1] as alt, f[2] as gene) where len(f) = 10 and alt in ('N', 'R')")
def local_annotation_index(spark, sf_dir):
    rows = order_annotations(spark, sf_dir).select(F.lit("chr1").alias("chrom"), F.col("line_no").alias("pos"), F.lit("A").alias("ref"), F.lit("N,R").alias("alt"), "annotation")
    return compare.local_index(rows).select("variant", "gene", F.array_join("entry", "|").alias("entry"))


# sampling ------------------------------------------------------------------


@query("""with r as (select c_custkey, c_nationkey, c_mktsegment, row_number() over w - 1 as index, count(*) over (partition by c_nationkey, c_mktsegment) as length from customer window w as (partition by c_nationkey, c_mktsegment order by c_acctbal, c_custkey))
select c_custkey, c_nationkey, c_mktsegment, index, length from r
where length <= 5 or index in (cast(round_even(0.0::double, 0) as bigint), cast(round_even((length - 1) / 4.0::double, 0) as bigint), cast(round_even(2 * (length - 1) / 4.0::double, 0) as bigint), cast(round_even(3 * (length - 1) / 4.0::double, 0) as bigint), length - 1)""")
def stratified_quantiles(spark, sf_dir):
    return ranking.stratified(table(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment"], ["c_acctbal", "c_custkey"], 5).select("c_custkey", "c_nationkey", "c_mktsegment", "index", "length")


@query("""with r as (select o_orderkey, row_number() over (order by o_totalprice, o_orderkey) - 1 as rank, count(*) over () as length from orders),
kept as (select distinct cast(round_even(i * (length - 1) / 999.0::double, 0) as bigint) as rank from (select max(length) as length from r), range(1000) t(i))
select o_orderkey, rank from r where length <= 1000 or rank in (select rank from kept)""")
def even_downsample(spark, sf_dir):
    return ranking.evenly(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", ["o_orderkey"], 1000).select("o_orderkey", "rank")


def exon_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("l_orderkey") * 100 + F.col("l_linenumber") * 7
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("transcript_id"), start.alias("start"), (start + F.col("l_partkey") % 7 + 1).alias("stop"))


def assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    exons = exon_rows(spark, sf_dir)
    named = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("transcript_id"), F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("name"), (F.col("o_custkey") % 24 + 1).cast("string").alias("contig"), F.lit("+").alias("strand"))
    ends = exons.groupBy("transcript_id").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return transcripts.assemble(named.join(ends, "transcript_id").withColumn("line_no", F.col("transcript_id")), exons, ["line_no"])


EXONS = """exons as (select distinct l_orderkey as id, l_orderkey * 100 + l_linenumber * 7 as s, l_orderkey * 100 + l_linenumber * 7 + l_partkey % 7 + 1 as e from lineitem),
built as (select id, list(s order by s, e) as ss, list(e order by s, e) as es, min(s) as start, max(e) as stop from exons where id in (select o_orderkey from orders) group by id)"""


@query(f"""with {EXONS} select 'T' || id as name, cast(o_custkey % 24 + 1 as varchar) as contig, '+' as strand, start, stop, array_to_string(ss, ',') || ',' as exon_starts, array_to_string(es, ',') || ',' as exon_stops
from built join orders on id = o_orderkey""")
def exon_assembly(spark, sf_dir):
    listed = lambda c: F.concat(F.array_join(F.transform(c, lambda x: x.cast("string")), ","), F.lit(","))
    return assembled(spark, sf_dir).select("name", "contig", "strand", "start", "stop", listed("exon_starts").alias("exon_starts"), listed("exon_stops").alias("exon_stops"))


@query(f"with {EXONS} select count(*) as transcripts, count(distinct id) as genes, count(distinct o_custkey % 24) as contigs, cast(sum(len(ss)) as bigint) as exons from built join orders on id = o_orderkey")
def annotation_summary(spark, sf_dir):
    return transcripts.summary(assembled(spark, sf_dir))


@query(f"""with {EXONS}, b as (select id, start, stop, list_sort(list_distinct(list_concat(ss[2:], es[:-2]))) as cuts from built)
select id as transcript_id, array_to_string(list_sort(list_distinct(list_concat([start, stop], case when len(cuts) > 0 then [cuts[1], cuts[len(cuts) // 2 + 1], cuts[len(cuts)]] else [] end))), ',') as anchors from b""")
def anchor_candidates(spark, sf_dir):
    from strandline.operators.sampling import anchor_positions

    found = anchor_positions(F.col("start"), F.col("stop"), F.col("exon_starts"), F.col("exon_stops"))
    return assembled(spark, sf_dir).select("transcript_id", F.array_join(F.transform(found, lambda x: x.cast("string")), ",").alias("anchors"))


@query()
def greedy_quota_sample(spark, sf_dir):
    from strandline.operators.sampling import sample

    made = assembled(spark, sf_dir).select(F.concat(F.lit("G"), (F.col("transcript_id") % 40).cast("string")).alias("name"), "contig", F.when(F.col("transcript_id") % 2 == 0, "+").otherwise("-").alias("strand"), "start", "stop", "exon_starts", "exon_stops")
    records = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 24 + 1).cast("string").alias("contig"), (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("pos"), F.lit("A").alias("ref"), F.col("l_returnflag").alias("alts")).distinct()
    return sample(records, made, target=500, per_stratum=12, window=750)


# attributes and outside responses -------------------------------------------


@query(r"""with k as (select page_id, unnest(regexp_extract_all(html, '(\w+)="([^"]*)"', 1)) as key, unnest(regexp_extract_all(html, '(\w+)="([^"]*)"', 2)) as value, generate_subscripts(regexp_extract_all(html, '(\w+)="([^"]*)"', 1), 1) as r from pages)
select page_id, key, string_agg(value, ',' order by r) as vals, count(*) as n from k group by page_id, key""")
def attribute_multimap(spark, sf_dir):
    found = table(spark, sf_dir, "pages").select("page_id", F.explode(alleles.attribute_map(F.col("html"), r'([a-zA-Z0-9_]+)="([^"]*)"')).alias("key", "v"))
    return found.select("page_id", "key", F.array_join("v", ",").alias("vals"), F.size("v").cast("long").alias("n"))


def outside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as queries with a local entry and an outside response each."""
    rows = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("chr1-"), F.col("event_id").cast("string"), F.lit("-A-C")).alias("variant"), F.concat(F.lit("G"), (F.col("user_id") % 9).cast("string")).alias("gene"), (F.get_json_object("props", "$.k").cast("int") % 100).alias("k"))
    manifest = rows.select("variant", "gene")
    text = F.format_number(F.col("k") / 100, 2)
    fields = F.when(F.col("event_id") % 17 == 0, F.array(F.lit("C"), F.col("gene"), *([F.lit(".")] * 8))).otherwise(F.array(F.lit("C"), F.col("gene"), text, F.lit("0.00"), F.lit("0.10"), text, *(F.lit(str(i)) for i in (1, 2, 3)), F.col("k").cast("string")))
    local = rows.where("event_id % 19 <> 0").select("variant", "gene", fields.alias("entry"))
    near = F.format_number((F.col("k") + F.col("event_id") % 2) / 100, 2)
    names = [f.name for f in readers_response_fields()]
    values = {"g_name": F.col("gene"), "t_id": F.lit("t"), "t_priority": F.when(F.col("event_id") % 23 == 0, "N").otherwise("MS"), "DS_AG": near, "DS_AL": F.lit("0.00"), "DS_DG": F.lit("0.1"), "DS_DL": text, "DP_AG": F.lit("1"), "DP_AL": F.lit("2"), "DP_DG": F.lit("3"), "DP_DL": (F.col("k") + F.when(F.col("event_id") % 3 == 0, 1).otherwise(0)).cast("string")}
    one = F.struct(*(values[n].alias(n) for n in names))
    responses = rows.select("variant", F.col("variant").alias("query"), F.lit("38").alias("hg"), F.when(F.col("event_id") % 29 == 0, "50").otherwise("500").alias("distance"), F.lit("1").alias("mask"), F.when(F.col("event_id") % 31 == 0, F.array(one, one)).otherwise(F.array(one)).alias("scores"))
    return compare.outside_check(manifest, local, responses)


def readers_response_fields():
    from strandline.sources.readers import RESPONSE

    return RESPONSE["scores"].dataType.elementType.fields


CHECKED = """with e as (select event_id, 'chr1-' || event_id || '-A-C' as variant, 'G' || (user_id % 9) as gene, cast(json_extract_string(props, '$.k') as integer) % 100 as k from events),
c as (select variant, gene, event_id % 19 <> 0 as local, event_id % 23 <> 0 and event_id % 31 <> 0 as matched, event_id % 29 <> 0 as parameters, event_id % 17 = 0 as dots, event_id, k,
  round(abs(cast(printf('%.2f', k / 100.0::double) as double) - cast(printf('%.2f', (k + event_id % 2) / 100.0::double) as double)), 6) as gap from e),
checked as (select variant, gene, local, matched, parameters, local and matched and dots as unscored, local and matched and not dots as compared,
  case when local and matched and not dots then case when event_id % 2 = 1 then 1 else 0 end end as score_differences,
  case when local and matched and not dots then case when event_id % 3 = 0 then 1 else 0 end end as place_differences,
  case when local and matched and not dots then gap end as largest from c)"""


@query(f"{CHECKED} select * from checked")
def api_field_compare(spark, sf_dir):
    return outside(spark, sf_dir).withColumn("largest", F.round("largest", 6))


@query(f"""{CHECKED}, t as (select count(*) as queries, count(*) filter (where compared) as compared, count(*) filter (where matched) as matched, count(*) filter (where parameters) as parameters, count(*) filter (where unscored) as unscored,
  cast(sum(score_differences) as bigint) as score_differences, cast(sum(place_differences) as bigint) as place_differences, round(max(largest), 6) as largest from checked)
select *, array_to_string(list_filter([case when queries = 0 then 'no queries' end, case when compared <> queries then 'not all compared' end, case when matched <> queries then 'not all matched' end, case when parameters <> queries then 'parameters differ' end, case when largest > 0.011 then 'score difference' end], lambda x: x is not null), ',') as reasons, false as passed from t""")
def api_gate(spark, sf_dir):
    return compare.outside_summary(outside(spark, sf_dir)).withColumn("reasons", F.array_join("reasons", ",")).withColumn("largest", F.round("largest", 6))


# provenance ----------------------------------------------------------------


@query("select o_custkey, sha256(string_agg('order=' || o_orderkey || chr(10), '' order by o_orderkey)) as sha256 from orders group by o_custkey")
def fingerprint(spark, sf_dir):
    lines = F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda k: F.concat(F.lit("order="), k.cast("string")))
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(alleles.lines_digest(lines).alias("sha256"))


@query("""with f as (select o_orderpriority as tree, o_orderkey % 50 as part, 'f' || lpad(cast(o_orderkey as varchar), 9, '0') as path, sha256(cast(o_orderkey as varchar)) as h from orders)
select tree || part as tree, sha256(string_agg(h || '  ./' || path || chr(10), '' order by path)) as sha256 from f group by tree, part""")
def tree_digest(spark, sf_dir):
    key = F.col("o_orderkey").cast("string")
    files = table(spark, sf_dir, "orders").select(F.concat("o_orderpriority", (F.col("o_orderkey") % 50).cast("string")).alias("tree"), F.concat(F.lit("f"), F.lpad(key, 9, "0")).alias("path"), alleles.sha256_hex(key).alias("sha256"))
    return shards.tree_digest(files)


MARKERS = "tasks as (select 'task-' || o_orderkey as shard_id, case when o_orderkey % 2 = 0 then 'snv' else 'indel' end as kind, o_orderkey as k, cast(floor(o_totalprice) as bigint) as records from orders)"


@query(f"""with {MARKERS} select shard_id, kind, case when k % 10 <> 0 then records end as records, case when k % 10 <> 0 then shard_id || '.vcf' end as output, case when k % 10 <> 0 then sha256(shard_id) end as output_sha256, k % 10 <> 0 and k % 15 <> 1 as complete from tasks""")
def manifest_join(spark, sf_dir):
    return shards.manifest(*marked(spark, sf_dir))


@query(f"""with {MARKERS} select kind, count(*) as shards, count(*) filter (where k % 10 <> 0 and k % 15 <> 1) as complete, cast(coalesce(sum(records) filter (where k % 10 <> 0), 0) as bigint) as records from tasks group by kind""")
def manifest_finalize(spark, sf_dir):
    told = shards.manifest(*marked(spark, sf_dir))
    return told.groupBy("kind").agg(F.count("*").alias("shards"), F.count(F.when(F.col("complete"), 1)).alias("complete"), F.coalesce(F.sum("records"), F.lit(0)).cast("long").alias("records"))


def marked(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    key = F.col("o_orderkey")
    kind = F.when(key % 2 == 0, "snv").otherwise("indel")
    tasks = table(spark, sf_dir, "orders").select(key.alias("k"), F.concat(F.lit("task-"), key.cast("string")).alias("shard_id"), kind.alias("kind"), F.floor("o_totalprice").cast("long").alias("records"))
    wrong = F.when(F.col("k") % 15 == 1, "other").otherwise(F.col("kind"))
    markers = tasks.where("k % 10 <> 0").select("shard_id", wrong.alias("kind"), "records", F.concat("shard_id", F.lit(".vcf")).alias("output"), alleles.sha256_hex(F.col("shard_id")).alias("output_sha256"))
    return tasks.select("shard_id", "kind"), markers


@query("""select 'task-' || o_orderkey as shard_id, sha256('' || o_orderkey) as input_sha256 from orders where not (o_orderkey % 3 = 0 and o_orderkey % 7 <> 0 and o_orderkey % 5 <> 0)""")
def pending_shards(spark, sf_dir):
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(key.alias("k"), F.concat(F.lit("task-"), key.cast("string")).alias("shard_id"), alleles.sha256_hex(key.cast("string")).alias("input_sha256"))
    done = rows.where("k % 3 = 0").select("shard_id", "input_sha256", F.lit(10).alias("records"), F.when(F.col("k") % 7 == 0, 9).otherwise(10).alias("input_records"), F.when(F.col("k") % 5 == 0, "old").otherwise("new").alias("fingerprint"))
    return shards.pending(rows.select("shard_id", "input_sha256"), done, "new")


def scored_sql() -> str:
    """The stub models' arithmetic in single precision, around the middle of every sequence."""
    value = {b: v for b, v in zip("ACGT", (0.11, 0.23, 0.37, 0.05))}
    plus, minus = (" ".join(f"when '{b}' then {value[c]}" for b, c in zip("ACGT", other)) for other in ("ACGT", "TGCA"))
    values = lambda x: f"list_transform(string_split({x}, ''), lambda b: cast(case when doc_id % 2 = 0 then case upper(b) {plus} else 0 end else case upper(b) {minus} else 0 end end as float))"
    places = lambda x, body: f"list_transform(range(4, len({x}) - 2), lambda k: cast({body} as float))"
    mean = lambda x: places(x, f"({x}[k] + ({x}[k - 1] + {x}[k + 1]) + ({x}[k - 2] + {x}[k + 2]) + ({x}[k - 3] + {x}[k + 3])) / 7::float")
    summed = " + ".join(f"m * {w}::float" for w in demo.WEIGHTS)
    told = lambda x: f"list_transform({x}, lambda m: cast(({summed}) / 5::float as float))"
    whole = lambda x: f"case when alt_no = 0 then {x} else list_concat(list_append({x}[1:10], list_max({x}[11:13])), {x}[14:]) end"
    names = (("ag", "alt_a", "ref_a"), ("al", "ref_a", "alt_a"), ("dg", "alt_d", "ref_d"), ("dl", "ref_d", "alt_d"))
    deltas = ", ".join(f"{delta_sql(x, y)} as {n}" for n, x, y in names)
    peaks = ", ".join(f"cast(list_max({n}) as double) as v_{n}, list_position({n}, list_max({n})) - 11 as p_{n}" for n, *_ in names)
    shown = " || '|' || ".join(f"printf('%.2f', case when p_{n} {'=' if n[1] == 'g' else '<>'} exon then v_{n} * 0 else v_{n} end)" for n, *_ in names)
    at = " || '|' || ".join(f"p_{n}" for n, *_ in names)
    return f"""with {SEQUENCES},
placed as (select doc_id, sequence as s, length(sequence) as n, length(sequence) // 2 + 1 as q from sequences),
judged as (select *, case when n = 0 then 'outside transcripts' when s[q:q] = 'ß' then 'another reference base' end as skip_reason, upper(s[q:q]) as ref,
  right(repeat('?', 13) || s[greatest(q - 13, 1):q - 1], 13) as before, left(s[q + 1:q + 13] || repeat('?', 13), 13) as behind from placed),
changed as (select doc_id, n, q, ref, before, behind, unnest([0, 1]) as alt_no, unnest([case when ref = 'A' then 'C' else 'A' end, ref || 'GT']) as alt from judged where skip_reason is null),
valued as (select doc_id, alt_no, alt, case when abs(1 - q) <= abs(n - q) then 1 - q else n - q end as exon, {values("before || ref || behind")} as r, {values("before || alt || behind")} as b from changed where not regexp_matches(alt, '[.*<>-]')),
means as (select *, {mean("r")} as r_a, {places("r", "r[k]")} as r_d, {mean("b")} as b_a, {places("b", "b[k]")} as b_d from valued),
predicted as (select doc_id, alt_no, alt, exon, {told("r_a")} as ref_a, {told("r_d")} as ref_d, {told("b_a")} as long_a, {told("b_d")} as long_d from means),
aligned as (select *, {whole("long_a")} as alt_a, {whole("long_d")} as alt_d from predicted),
deltas as (select doc_id, alt_no, alt, exon, {deltas} from aligned),
peaks as (select doc_id, alt_no, alt, exon, {peaks} from deltas),
entries as (select doc_id, string_agg(alt || '|G' || doc_id || '|' || {shown} || '|' || {at}, ',' order by alt_no) as annotation from peaks group by doc_id)
select doc_id as line_no, skip_reason, annotation from judged left join entries using (doc_id)"""


@query(scored_sql())
def scored_variants(spark, sf_dir):
    """Records at the middle of every sequence, scored end to end by the stub model over the whole context."""
    return demo.scored(sequences(spark, sf_dir))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of points in islands, by contig, next to the contig's islands and bases."""
    return interval_union_bases(spark, sf_dir).join(stabbing_count(spark, sf_dir), "contig", "left").select("contig", "islands", "bases", F.coalesce("hits", F.lit(0)).alias("hits"))
