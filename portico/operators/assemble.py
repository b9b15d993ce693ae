"""Output event rows: crossings with demographics, absolute times and stable ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portico.functions.ids import age_bucket, event_payload, positive_hash
from portico.functions.times import milli_text


def absolute_time(start: Column, seconds: Column) -> Column:
    """start + seconds to the microsecond, as millisecond text that cuts the rest off."""
    return milli_text(F.timestamp_micros(F.unix_micros(start) + F.round(seconds * 1e6).cast("long")))


def with_occurrence(rows: DataFrame, identity: list[str], order: list[str]) -> DataFrame:
    """`occurrence`: 0, 1, ... among rows of an identity, null where it is alone."""
    w = Window.partitionBy(*identity)
    return rows.withColumn("occurrence", F.when(F.count("*").over(w) > 1, F.row_number().over(w.orderBy(*order)) - 1))


def assemble(events: DataFrame, demographics: DataFrame, start: Column, device_id: int) -> DataFrame:
    """device_id, event_id, event, timestamp, sex, age_bucket for crossings (track_id, timestamp, event_type, pos).

    A crossing without demographics is an error. The id is a hash of device, time, event, sex, bucket and track, and of the
    occurrence where these repeat, so that a second run gives the same ids.
    """
    people = demographics.select(F.col("track_id").alias("_track"), "age", F.col("sex").alias("_sex"))
    joined = events.join(people, events["track_id"].cast("string") == F.col("_track").cast("string"), "left")
    age = F.when(F.col("_track").isNull(), F.raise_error(F.concat(F.lit("no demographics for track "), F.col("track_id").cast("string"))).cast("int")).otherwise(F.col("age"))
    rows = joined.select(F.lit(device_id).cast("long").alias("device_id"), "track_id", "pos", F.col("event_type").alias("event"), absolute_time(start, F.col("timestamp")).alias("timestamp"), F.col("_sex").alias("sex"), age_bucket(age).alias("age_bucket"))
    rows = with_occurrence(rows, ["device_id", "timestamp", "event", "sex", "age_bucket", "track_id"], ["pos"])
    payload = event_payload(F.col("device_id"), F.col("timestamp"), F.col("event"), F.col("sex"), F.col("age_bucket"), F.col("track_id").cast("string"), F.col("occurrence"))
    return rows.select("device_id", positive_hash(payload).alias("event_id"), "event", "timestamp", "sex", "age_bucket", "pos")
