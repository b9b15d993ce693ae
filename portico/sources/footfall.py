"""Footfall events, devices, sites and paths out of the plain `events` table, and fixed clocks for queries on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portico.functions.ids import age_bucket

#: 2024-01-30 12:07:30, 2024-01-01 and 2024-01-30 08:00, in seconds.
NOW, CREATED, FIRST_MARK = 1706616450, 1704067200, 1706601600
DEVICES, SITES = 8, 4


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _seconds() -> F.Column:
    return F.unix_timestamp(F.date_trunc("second", F.col("ts"))).cast("long")


def footfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, device_id, site_id, event (1 entry, 0 exit), t (whole seconds), sex, age_bucket."""
    k = F.get_json_object("props", "$.k").cast("int")
    device = F.pmod("user_id", F.lit(DEVICES))
    return (
        events_table(spark, sf_dir)
        .where(F.col("event_type") != "error")
        .select("event_id", device.alias("device_id"), F.pmod(device, F.lit(SITES)).alias("site_id"), F.when(F.col("event_type").isin("click", "signup"), 1).otherwise(0).alias("event"), _seconds().alias("t"), F.pmod("event_id", F.lit(2)).cast("int").alias("sex"), age_bucket(k).alias("age_bucket"))
    )


def devices(spark: SparkSession) -> DataFrame:
    """Eight devices, each with the time up to which its data is complete."""
    d = F.col("id")
    return spark.range(DEVICES).select(d.alias("device_id"), F.concat(F.lit("device "), d.cast("string")).alias("name"), F.pmod(d, F.lit(SITES)).alias("site_id"), F.lit("enabled").alias("status"), F.lit(CREATED).cast("long").alias("created_at"), (F.lit(FIRST_MARK) + d * 3600).alias("analyzed_until"))


def sites(spark: SparkSession) -> DataFrame:
    s = F.col("id")
    return spark.range(SITES).select(s.alias("site_id"), F.concat(F.lit("site "), s.cast("string")).alias("name"), F.lit(1).cast("long").alias("organisation_id"), (s + 10).alias("max_capacity"), F.lit("enabled").alias("status"), F.lit(CREATED).cast("long").alias("created_at"), F.lit("project.dataset.events").alias("destination"))


def path_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of one path for each user: track_id, pos (0-based in time order), t, x, y, event_id."""
    from pyspark.sql import Window

    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return events_table(spark, sf_dir).select(F.col("user_id").alias("track_id"), (F.row_number().over(order) - 1).alias("pos"), _seconds().alias("t"), F.col("value").alias("x"), F.get_json_object("props", "$.k").cast("double").alias("y"), "event_id")
