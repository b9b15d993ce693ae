"""URL filters as a sort-merge range join: a sorted sweep over canonical keys, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import parallelism, stored
from .exact_dedup import LOWER, UPPER

#: Fixed values of the query: host, path, verdict.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
DEFAULT = "allow"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first `://` with A-Z lower-cased, path before `?` and `#`; both empty without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substring(rest, F.length(host) + 1, F.length(rest))
    return F.translate(host, UPPER, LOWER), F.regexp_extract(tail, r"^[^?#]*", 0)


def _reversed_host(labels: Column) -> Column:
    return F.array_join(F.reverse(labels), ".")


def _key(reversed_host: Column, path: Column) -> Column:
    return F.encode(F.concat(reversed_host, F.lit("\x01"), path), "utf-8")


def boundaries(rules: DataFrame) -> DataFrame:
    """(key, rule) at which the innermost active rule changes, from rules (host, path, verdict).

    A rule's keys are the interval [key, key + 0xFF). Rules of a host are swept in order of path with a stack of
    those still open; a rule's parent is then the top of the stack, and is what holds again after its end. Of
    equal rules `block` wins. Only one host's rules meet in an array, never urls.
    """
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    top = "named_struct('path', r.path, 'verdict', r.verdict)"
    fold = f"""aggregate(array_sort(collect_list(struct(path, verdict))),
        named_struct('stack', cast(array() as array<struct<path:string,verdict:string>>), 'done', cast(array() as array<struct<path:string,verdict:string,up:struct<path:string,verdict:string>>>)),
        (acc, r) -> named_struct(
            'stack', concat(filter(acc.stack, s -> startswith(r.path, s.path)), array({top})),
            'done', concat(acc.done, array(named_struct('path', r.path, 'verdict', r.verdict, 'up', try_element_at(filter(acc.stack, s -> startswith(r.path, s.path)), -1))))),
        acc -> acc.done)"""
    nested = rules.groupBy("host").agg(F.expr(fold).alias("r")).select("host", F.explode("r").alias("r"))
    key = _key(_reversed_host(F.split("host", r"\.")), F.col("r.path"))
    rule = lambda path, verdict: F.struct(F.length(F.concat("host", path)).alias("size"), F.length("host").alias("host_size"), F.concat("host", path).alias("rule"), verdict.alias("verdict"))
    opens = nested.select(key.alias("key"), rule(F.col("r.path"), F.col("r.verdict")).alias("rule"))
    closes = nested.select(F.concat(key, F.unhex(F.lit("FF"))).alias("key"), F.when(F.col("r.up").isNotNull(), rule(F.col("r.up.path"), F.col("r.up.verdict"))).alias("rule"))
    return opens.unionByName(closes)


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", page_id: str = "page_id", default: str = DEFAULT) -> DataFrame:
    """The verdict for each row of `pages`: page_id, host, path, rule, verdict.

    A rule fits its host and all subdomains if the path starts with the rule's; the longest rule (then the one of
    the longer host) decides, without one `default` does. Each distinct (host, path) gives a key for each suffix
    of its host that a rule could have, labels reversed. Keys and rule boundaries are range-partitioned together
    by key and then id, so equal keys of a hot host can part; within a partition, in key order, the last boundary
    holds; what holds at a partition's start comes from the last boundary of those before it.

    Null url or no `://`: host and path empty, default verdict unless a rule of the empty host fits. Rows with
    null or repeated ids each get their verdict. No rules: all default. Empty table: no rows.
    """
    spark = pages.sparkSession
    host, path = split_url(F.coalesce(F.col(url), F.lit("")))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    depth = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    edges = boundaries(rules).select("key", F.lit(0).alias("kind"), F.lit("").alias("host"), F.lit("").alias("path"), "rule")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(depth, 1)))), lambda k: _reversed_host(F.slice(labels, F.size(labels) - k + 1, k)))
    keys = rows.select("host", "path").distinct().select("host", "path", F.explode(suffixes).alias("reversed"))
    keys = keys.select(_key(F.col("reversed"), F.col("path")).alias("key"), F.lit(1).alias("kind"), "host", "path").withColumn("rule", F.lit(None).cast(edges.schema["rule"].dataType))
    dealt = edges.unionByName(keys).repartitionByRange(parallelism(spark), "key", "kind", "host")
    swept = stored(dealt.withColumn("part", F.spark_partition_id()))
    held = F.when(F.col("kind") == 0, F.struct("key", "rule"))
    last = swept.where("kind = 0").groupBy("part").agg(F.max_by("rule", "key").alias("rule"), F.max("key").alias("key"))
    parts = swept.select("part").distinct().join(last, "part", "left")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    carried = parts.select("part", F.last(F.when(F.col("key").isNotNull(), F.struct("rule")), True).over(before).alias("carried"))
    within = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    active = swept.withColumn("held", F.last(held, True).over(within)).where("kind = 1").join(carried, "part")
    rule = F.when(F.col("held").isNotNull(), F.col("held.rule")).otherwise(F.col("carried.rule"))
    best = active.groupBy("host", "path").agg(F.max(rule).alias("best"))
    return rows.join(best, ["host", "path"]).select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules (host, path, verdict) as a table of literals: no Python worker is asked for them."""
    literal = [F.struct(*[F.lit(v).alias(n) for n, v in zip(("host", "path", "verdict"), r, strict=True)]) for r in rules]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*literal)))


def query(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return filter_urls(pages, rule_table(spark, RULES))


ORACLE = r"""
WITH rules(host, path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
a AS (SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM a),
c AS (SELECT row_number() OVER () AS n, page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM b),
d AS (SELECT c.*, r.host || r.path AS rule, r.verdict, row_number() OVER (PARTITION BY n ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS k
  FROM c LEFT JOIN rules r ON (c.host = r.host OR ends_with(c.host, '.' || r.host)) AND starts_with(c.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM d WHERE k = 1
"""
