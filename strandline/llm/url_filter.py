"""URL rules as prefix intervals, matched by a sort-merge sweep. DataFrame functions only.

A rule is a host with a path prefix. It fits a url whose host is the rule's
host or lies below it, and whose path starts with the rule's path. The longest
fitting rule wins: the longer host, then the longer path.

Method. A host is written as its labels from the right, each closed by a dot, so
what lies below a host starts with its key: a rule's host is the interval of all
keys that begin with its own, and any two intervals nest or are disjoint. Rules
and urls are sorted together by key. The sweep keeps, at every rule host, the
stack of the rules that are open there, its own and those of the hosts around it
(they depend on the rules alone, so they are made once from the rule table). A
url takes the stack of the last rule host at or before it, pops what does not
cover its key or whose path it does not begin with, and the longest that is left
wins. Every url is one row and is moved once.

Defined results: a null url, or one without ``://``, has an empty host and
path and gets the default verdict. A url without a path (``http://a.org?x``)
fits no rule, since every rule's path begins with ``/``. Repeated rows each give
a row. Very long urls are compared as they are. Of repeated rules (same host and
path) the block wins. Null or empty rule hosts are ignored; an empty rule table
leaves every url at the default. Extra columns of either input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rules_frame(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(verdict, 'host/path') pairs as a table of verdict, host, path."""
    rows = [F.struct(F.lit(v).alias("verdict"), F.lit(r.partition("/")[0]).alias("host"), F.lit("/" + r.partition("/")[2]).alias("path")) for v, r in rules]
    if not rows:
        return spark.range(0).select(*(F.lit("").alias(c) for c in ("verdict", "host", "path")))
    return spark.range(1).select(F.inline(F.array(*rows)))


def reversed_host(host: Column) -> Column:
    """Labels from the right, each closed by a dot: what lies below a host starts with its key."""
    return F.concat(F.concat_ws(".", F.reverse(F.split(host, r"\."))), F.lit("."))


def rule_stacks(rules: DataFrame) -> DataFrame:
    """key and the stack of open rules of every rule host: those of the hosts around it first, shorter paths before longer ones."""
    host = F.translate("host", UPPER, LOWER)
    own = (
        rules.where((F.col("host") != "") & F.col("path").startswith("/"))
        .select(reversed_host(host).alias("key"), "path", host.alias("host"), "verdict")
        .groupBy("key", "path", "host")
        .agg(F.max("verdict").alias("verdict"))  # block sorts after allow
    )
    rule = F.struct(F.length("host").alias("host_length"), F.length("path").alias("path_length"), F.col("key").alias("key"), "path", F.concat("host", "path").alias("rule"), "verdict")
    of_host = own.groupBy("key").agg(F.collect_list(rule).alias("rules"))
    # a host has at most as many hosts around it as it has labels
    labels = F.split("key", r"\.")
    around = of_host.select("key", F.explode(F.sequence(F.lit(1), F.size(labels) - 1)).alias("n"), labels.alias("labels")).select("key", F.concat(F.concat_ws(".", F.slice("labels", F.lit(1), F.col("n"))), F.lit(".")).alias("outer"))
    return around.join(of_host.select(F.col("key").alias("outer"), "rules"), "outer").groupBy("key").agg(F.array_sort(F.flatten(F.collect_list("rules"))).alias("stack"))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", salts: int | None = None) -> DataFrame:
    """Every row's id, host, path, winning rule (null if none) and verdict.

    Rows are dealt over ``salts`` sweeps (the shuffle partitions, unless given)
    whatever their host, so a host with a third of all urls is swept by all; the
    rules are copied to each.
    """
    salts = salts or max(8, int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    stacks = rule_stacks(rules)
    kind = stacks.schema["stack"].dataType
    rows = pages.select(F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    urls = rows.select(F.pmod(F.xxhash64("page_id", "host", "path"), F.lit(salts)).cast("int").alias("salt"), F.when(F.col("host") == "", "").otherwise(reversed_host(F.col("host"))).alias("key"), F.lit(1).alias("kind"), "page_id", "host", "path", F.lit(None).cast(kind).alias("stack"))
    nothing = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("page_id", "host", "path")]
    merged = urls.unionByName(stacks.select(F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "key", F.lit(0).alias("kind"), *nothing, "stack"))
    sweep = Window.partitionBy("salt").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    fits = F.filter("open", lambda r: F.col("key").startswith(r["key"]) & F.col("path").startswith(r["path"]))
    judged = merged.withColumn("open", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1").withColumn("top", F.try_element_at(fits, F.lit(-1)))
    return judged.select("page_id", "host", "path", F.col("top.rule").alias("rule"), F.coalesce("top.verdict", F.lit(default)).alias("verdict"))


#: The rules of the query.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandline.llm.frames import read

    return judge(read(spark, sf_dir, "pages"), rules_frame(spark, RULES))


ORACLE = r"""
with split as (
  select page_id,
         translate(regexp_extract(coalesce(url, ''), '^[\s\S]*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(url, ''), '^[\s\S]*?://[^/?#]*([^?#]*)', 1) as path
  from pages),
rules(verdict, h, p) as (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
pairs as (select distinct host, path from split),
fits as (
  select host, path, arg_max(h || p, length(h) * 100000 + length(p)) as rule, arg_max(verdict, length(h) * 100000 + length(p)) as verdict
  from pairs join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
  group by host, path)
select page_id, s.host, s.path, rule, coalesce(verdict, 'allow') as verdict
from split s left join fits f on s.host = f.host and s.path = f.path
"""
