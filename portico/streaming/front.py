"""Structured Streaming front end: each micro-batch takes the same incremental path as a batch run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from portico.plans.snapshot import refresh
from portico.plans.store import SnapshotStore


def snapshot_stream(events: DataFrame, store_folder: str, sites: DataFrame, marks: Callable[[SparkSession], tuple[DataFrame, int]], checkpoint: str) -> StreamingQuery:
    """Feeds a stream of footfall events into a snapshot store.

    `marks(spark)` gives the sites' completeness marks (site_id, stable) and the present second for a batch: completeness
    comes from the sources, not from the newest event, so late rows wait instead of being dropped. A batch that is run
    again after a crash is harmless: events are told apart by identity and the store's commit is all or nothing.
    """

    def step(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        stable, now = marks(spark)
        refresh(SnapshotStore(spark, store_folder), batch, sites, stable, now)

    return events.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def quarter_counts(events: DataFrame, late: str = "4 hours") -> DataFrame:
    """Entrances and exits by site and quarter hour of a stream with time column `ts`; final once the watermark has passed."""
    return events.withWatermark("ts", late).groupBy("site_id", F.window("ts", "15 minutes").alias("w")).agg(F.sum("event").alias("entrances"), F.sum(1 - F.col("event")).alias("exits")).select("site_id", F.col("w.start").alias("q"), "entrances", "exits")
