"""Planned ingestion: coalesced ranges, range scans, normalised and de-duplicated events in one total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

IDENTITY = ("destination", "device_id", "event_id")


def coalesce_ranges(ranges: DataFrame, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Half-open ranges of a key that overlap or touch become one; empty ones go."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    seen = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = ranges.where(F.col(start) < F.col(end)).withColumn("_new", F.when(seen.isNull() | (F.col(start) > seen), 1).otherwise(0))
    return marked.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def scan_ranges(events: DataFrame, ranges: DataFrame, keys: list[str], time: str = "t") -> DataFrame:
    """Events with start <= time < end of a range of the same keys, with the range's other columns.

    The ranges' outer bounds become literals, which reach the scan as pushed filters. Ranges must be coalesced; an
    event in ranges of two sites is an error.
    """
    low, high = ranges.agg(F.min("start"), F.max("end")).first()
    extra = [c for c in ranges.columns if c not in (*keys, "start", "end")]
    if low is None:
        return events.join(ranges.select(*keys, *extra), keys).limit(0)
    near = events.where((F.col(time) >= F.lit(low)) & (F.col(time) < F.lit(high)))
    return near.join(ranges, keys).where((F.col(time) >= F.col("start")) & (F.col(time) < F.col("end"))).drop("start", "end")


def one_site_each(ranges: DataFrame) -> DataFrame:
    """The ranges, or an error if a destination's device belongs to two sites."""
    sites = F.size(F.collect_set("site_id").over(Window.partitionBy("destination", "device_id")))
    return ranges.withColumn("site_id", F.when(sites > 1, F.raise_error(F.lit("device belongs to more than one site"))).otherwise(F.col("site_id")))


def normalise(events: DataFrame) -> DataFrame:
    """Events with integer codes and whole seconds; codes out of their domain are an error."""
    bad = ~(F.col("event").isin(0, 1) & F.col("sex").isin(0, 1) & F.col("age_bucket").between(0, 5))
    checked = F.when(F.coalesce(bad, F.lit(True)), F.raise_error(F.concat(F.lit("event out of domain: "), F.coalesce(F.col("event_id").cast("string"), F.lit("null"))))).otherwise(F.col("event").cast("int"))
    return events.withColumn("event", checked).withColumn("sex", F.col("sex").cast("int")).withColumn("age_bucket", F.col("age_bucket").cast("int"))


def dedup_identity(events: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each identity; rows of an identity that differ are an error. Partial sums before the shuffle."""
    rest = [c for c in events.columns if c not in keys]
    body = F.struct(*rest)
    one = events.groupBy(*keys).agg(F.min(body).alias("_low"), F.max(body).alias("_high"))
    same = F.when(F.col("_low").eqNullSafe(F.col("_high")), F.col("_low")).otherwise(F.raise_error(F.lit("conflicting event identity")))
    return one.withColumn("_body", same).select(*keys, *[F.col(f"_body.{c}").alias(c) for c in rest])


def total_order() -> list[Column]:
    """Entries before exits of the same second, then by place and id."""
    return [F.col("t"), F.col("event").desc(), F.col("site_id"), F.col("device_id"), F.col("event_id")]


def half_open(events: DataFrame, devices: DataFrame, start: Column | None, end: Column | None) -> DataFrame:
    """Events of known devices from start to before end that lie before the device's horizon."""
    known = devices.select("device_id", F.coalesce("analyzed_until", "created_at").alias("_horizon"))
    kept = events.join(known, "device_id").where(F.col("t") < F.col("_horizon"))
    kept = kept if start is None else kept.where(F.col("t") >= start)
    return (kept if end is None else kept.where(F.col("t") < end)).drop("_horizon")
