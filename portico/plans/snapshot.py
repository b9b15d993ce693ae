"""Incremental snapshots: sealed partials up to the stable time, a replay of what is provisional on top."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portico.operators import ingest, rollups
from portico.operators.occupancy import quarter_cells, segments
from portico.operators.visits import matched_events, visits

from .lifecycle import split_events
from .store import Scratch, SnapshotStore, with_retries

IDENTITY = ["device_id", "event_id"]
MERGED = ("entrances", "exits", "area", "seconds", "dwell_sum", "dwell_count")


def merge_partials(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two sets of q15 partials as one; a cell may be in both."""
    least = F.min(F.when(F.col("min_pos") > 0, F.col("min_pos")))
    return a.unionByName(b).groupBy("site_id", "q").agg(*[F.sum(c).cast("long").alias(c) for c in MERGED], F.coalesce(least, F.lit(0)).cast("long").alias("min_pos"), F.max("max_occ").cast("long").alias("max_occ"))


def open_entries(events: DataFrame, stable: DataFrame) -> DataFrame:
    """Entries of final events that nobody has left for yet and that time out at the stable time or after."""
    matched = matched_events(events)
    gone = matched.where("kind = 1 and partner > 0").select("site_id", F.col("partner").alias("ordinal"))
    entries = matched.where("kind = 0").join(gone, ["site_id", "ordinal"], "left_anti").select("site_id", "event_id")
    return events.join(entries, ["site_id", "event_id"]).join(stable, "site_id").where(F.col("t") + 4 * 3600 >= F.col("stable")).drop("stable")


def delta_partials(carried: DataFrame, events: DataFrame, since: DataFrame, until: DataFrame, keep: Scratch) -> DataFrame:
    """Partials of [since, until) of each site, from the entries still open at `since` and the events after it.

    Visits are cut at both ends, so partials of successive intervals merge to those of the whole. They are written to
    the scratch folder once, as both the levels and the dwell times need them.
    """
    stays = keep(visits(carried.unionByName(events)).join(since, "site_id").join(until, "site_id"))
    cut = stays.where((F.col("leave") > F.col("since")) & (F.col("entry") < F.col("until"))).select("site_id", F.greatest("entry", "since").alias("entry"), F.least("leave", "until").alias("leave"))
    occupied = quarter_cells(segments(cut), ["site_id"])
    keys = ["site_id", "q"]
    out = rollups.q15_counts(events, ["site_id"]).join(occupied, keys, "full").join(rollups.q15_dwell(stays.where("exit_id is not null"), ["site_id"]), keys, "full")
    return out.select(*keys, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in (*MERGED, "min_pos", "max_occ")])


def refresh(store: SnapshotStore, events: DataFrame, sites: DataFrame, stable: DataFrame, now: int, rebuild: bool = False) -> int:
    """Brings the store to `now`: tables q15 (sealed), open, waiting (provisional and pending), view (q15 with provisional), marks.

    `events` (event_id, device_id, site_id, event, t, sex, age_bucket) are those newly fetched; with `rebuild`, all of them.
    `stable` (site_id, stable) is each site's completeness mark, which must not go back. An event before the last mark is
    dropped unless all is rebuilt.
    """
    columns = ["event_id", "device_id", "site_id", "event", "t", "sex", "age_bucket"]

    def attempt(version: int) -> dict[str, DataFrame]:
        fresh = rebuild or not version
        marks = sites.select("site_id", F.col("created_at").alias("since")) if fresh else store.read("marks", version).select("site_id", F.col("stable").alias("since"))
        until = keep(sites.select("site_id").join(stable.select("site_id", "stable"), "site_id", "left").select("site_id", F.least(F.coalesce("stable", F.lit(now)), F.lit(now)).cast("long").alias("until")))
        if marks.join(until, "site_id").where("until < since").count():
            raise ValueError("a completeness mark went back; rebuild instead")
        got = events.select(columns)
        known = got if fresh else got.unionByName(store.read("waiting", version).select(columns))
        known = ingest.dedup_identity(known, IDENTITY).select(columns).join(marks, "site_id").where("t >= since").drop("since")
        parts = keep(split_events(known, until.select("site_id", F.col("until").alias("stable")), F.lit(now)))
        carried = parts.select(columns).limit(0) if fresh else store.read("open", version).select(columns)
        final, provisional = (parts.where(F.col("part") == p).select(columns) for p in ("stable", "provisional"))
        sealed = delta_partials(carried, final, marks, until, keep)
        sealed = keep(sealed if fresh else merge_partials(store.read("q15", version), sealed))
        held = keep(open_entries(carried.unionByName(final), until.select("site_id", F.col("until").alias("stable"))).select(columns))
        ahead = delta_partials(held, provisional, until.select("site_id", F.col("until").alias("since")), sites.select("site_id", F.lit(now).cast("long").alias("until")), keep)
        return {"q15": sealed, "open": held, "waiting": parts.where("part <> 'stable'").select(columns), "view": merge_partials(sealed, ahead), "marks": until.select("site_id", F.col("until").alias("stable"))}

    with Scratch(store) as keep:
        return with_retries(store, attempt)
