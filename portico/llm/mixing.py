"""Mixing sources to target weights by hash-threshold histograms, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, whole_rows
from .thresholds import hash_rank, thresholds

#: Fixed values of the query: weights of the sources in turn, share of all words, most copies of a source or document.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size): weights in code-point order, null last.

    A target stops at `most` times its source's size; the excess is dealt again by weight. With the sources in
    order of size per weight, the first ones are capped until the level left / weights left no longer reaches
    the next cap; all others get weight times that level. One row for each source passes through one task.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    picked = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("weight", picked.cast("long")).withColumn("cap", (F.col("source_size") * most).cast("long"))
    whole = Window.partitionBy()
    s = s.withColumn("budget", F.sum("source_size").over(whole) * F.lit(float(share))).withColumn("all_weight", F.sum("weight").over(whole))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("cap_before", F.coalesce(F.sum("cap").over(by_cap), F.lit(0))).withColumn("weight_before", F.coalesce(F.sum("weight").over(by_cap), F.lit(0)))
    s = s.withColumn("level", (F.col("budget") - F.col("cap_before")) / (F.col("all_weight") - F.col("weight_before")))
    s = s.withColumn("final", F.min(F.when(F.col("cap") > F.col("level") * F.col("weight"), F.struct((F.col("cap") / F.col("weight")).alias("r"), F.col("level").alias("v")))).over(whole)["v"])
    target = F.when(F.col("final").isNull() | (F.col("cap") <= F.col("final") * F.col("weight")), F.col("cap").cast("double")).otherwise(F.col("final") * F.col("weight"))
    return s.select("source", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """What the mix takes of each document: doc_id, source, size, source_size, target, copies, taken.

    A source's target is whole copies of all its documents (target // size) and, for the rest, those documents
    whose hashed id lies below the source's threshold; thresholds come from nested histograms of words by source
    and hash bucket. The document at the threshold is taken if that brings the words nearer to the target. The
    hash depends on the id alone: reruns agree, and a larger target takes a superset.

    Null or empty text: size 0, taken 0. Null sources form one source, last in order. Null ids hash as the empty
    text; rows that repeat an id are taken or left together. A source of size 0 has target 0. Empty table: no rows.
    """
    sized = _sized(docs, text, doc_id, source)
    plan = _plan(sized, weights, share, most)
    out = sized.join(plan, F.col("source").eqNullSafe(F.col("_s"))).withColumn("copies", _copies(F.col("rank"), most))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _sized(docs: DataFrame, text: str, doc_id: str, source: str) -> DataFrame:
    return stored(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), hash_rank(F.col(doc_id)).alias("rank")))


def _copies(rank: Column, most: int) -> Column:
    return F.when(F.col("whole") >= most, F.col("whole")).otherwise(F.col("whole") + F.when(rank < F.col("bound"), 1).otherwise(0))


def _plan(sized: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """For each source (_s) its size, target, whole copies of all its rows, and the bound below which hashes are taken once more."""
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    targets = stored(targets.withColumn("whole", whole).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")))
    bounds = thresholds(sized, "source", "rank", "size", targets)
    nearer = F.col("below") + F.col("at_bound") - F.col("budget") < F.col("budget") - F.col("below")
    return stored(targets.alias("t").join(bounds.alias("b"), F.col("t.source").eqNullSafe(F.col("b.source"))).select(F.col("t.source").alias("_s"), "source_size", "target", "whole", (F.col("bound") + F.when(nearer & (F.col("at_bound") > 0), 1).otherwise(0)).alias("bound")))


def mixed_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, all columns as they are.

    Each row goes by its own source's threshold, also where ids repeat or are null, so none is taken more than `most` times.
    The sources' plan (a row for each source) meets the documents where they are read.
    """
    plan = _plan(_sized(docs, text, doc_id, source), weights, share, most)
    rows = docs.select(whole_rows(docs).alias("row"), F.col(f"`{source}`").alias("own"), hash_rank(F.col(f"`{doc_id}`")).alias("rank"))
    met = rows.join(plan, F.col("own").eqNullSafe(F.col("_s"))).withColumn("copies", _copies(F.col("rank"), most)).where("copies > 0")
    return met.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS rank FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2 * source_size AS cap FROM s),
l AS (SELECT *, (1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) - CAST(coalesce(sum(cap) OVER o, 0) AS DOUBLE)) / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS DOUBLE) AS level
  FROM w WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT arg_min(level, CAST(cap AS DOUBLE) / weight) AS final FROM l WHERE cap > level * weight),
t AS (SELECT w.source, w.source_size, CASE WHEN f.final IS NULL OR w.cap <= f.final * w.weight THEN CAST(w.cap AS DOUBLE) ELSE f.final * w.weight END AS target FROM w, f),
b AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
g AS (SELECT *, target - whole * source_size AS budget FROM b),
r AS (SELECT d.source, d.rank, sum(d.size) AS wt FROM d GROUP BY d.source, d.rank),
c AS (SELECT r.source, r.rank, r.wt, CAST(sum(r.wt) OVER (PARTITION BY r.source ORDER BY r.rank) AS DOUBLE) AS cum FROM r),
e AS (SELECT g.*, (SELECT min(c.rank) FROM c WHERE c.source IS NOT DISTINCT FROM g.source AND c.cum > g.budget) AS edge FROM g),
h AS (SELECT e.*, c.cum, c.wt FROM e LEFT JOIN c ON c.source IS NOT DISTINCT FROM e.source AND c.rank = e.edge),
p AS (SELECT *, CASE WHEN edge IS NULL THEN 1152921504606846976 WHEN cum - budget < budget - (cum - wt) THEN edge + 1 ELSE edge END AS bound FROM h)
SELECT d.doc_id, d.size, p.source_size, p.target, (p.whole + CASE WHEN p.whole < 2 AND d.rank < p.bound THEN 1 ELSE 0 END) * d.size AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
"""
