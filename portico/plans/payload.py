"""A scope's whole answer as of now, as one nested row for each site or for the organisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portico.functions.times import day_of, quarter, week_of, year_of
from portico.operators import rollups
from portico.operators.occupancy import quarter_cells, segments
from portico.operators.visits import visits

MEASURES = ("entrances", "exits", "area", "seconds", "min_pos", "max_occ")


def scope_partials(events: DataFrame, now: int, organisation: bool = False) -> DataFrame:
    """q15 partials by site, or of all sites together: the level is then that of the united visits, not a sum of maxima."""
    if not organisation:
        return rollups.q15_partials(events.where(F.col("t") < now), F.lit(now))
    seen = events.where(F.col("t") < now)
    stays = visits(seen)
    occupied = quarter_cells(segments(stays, None, F.lit(now)), [])
    out = rollups.q15_counts(seen, []).join(occupied, "q", "full").join(rollups.q15_dwell(stays, []), "q", "full")
    filled = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("entrances", "exits", "area", "seconds", "min_pos", "max_occ", "dwell_sum", "dwell_count")]
    return out.select(F.lit(1).cast("long").alias("site_id"), "q", *filled)


def _cells(rows: DataFrame, name: str, n: int | None, first: int = 0) -> DataFrame:
    """Per scope an array of n cells of struct(entrances, occupancy, exits), zero where nothing was."""
    one = F.struct(F.col("entrances"), F.array(rollups.mean_occupancy(), F.col("min_pos").cast("double"), F.col("max_occ").cast("double")).alias("occupancy"), F.col("exits"))
    got = rows.groupBy("site_id").agg(F.map_from_entries(F.collect_list(F.struct("cell", one.alias("v")))).alias("m"), F.max("cell").alias("top"))
    last = F.col("top") if n is None else F.lit(first + n - 1)
    begin = F.array_min(F.map_keys("m")) if n is None else F.lit(first)
    zero = F.struct(F.lit(0).cast("long").alias("entrances"), F.array(*[F.lit(0.0)] * 3).alias("occupancy"), F.lit(0).cast("long").alias("exits"))
    return got.select("site_id", F.transform(F.sequence(begin, last), lambda k: F.coalesce(F.try_element_at("m", k), zero)).alias(name))


def demographics(entries: DataFrame, inside: Column) -> DataFrame:
    """age_pct[6], sex_pct[2] of the entries of a grain; all 0 without entries."""
    rows = entries.where(inside)
    count = lambda c, v: F.sum(F.when(F.col(c) == v, 1).otherwise(0))
    pct = lambda c, n: F.array(*[F.coalesce(count(c, v) * 100 / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)) for v in range(n)])
    return rows.groupBy("site_id").agg(pct("age_bucket", 6).alias("age_pct"), pct("sex", 2).alias("sex_pct"))


def payload(events: DataFrame, sites: DataFrame, axes: DataFrame, now: int, organisation: bool = False) -> DataFrame:
    """One row for each scope: last_24h (96 cells), today, yesterday, week, weeks_4, weeks_12, year, all_time.

    `events` are final and provisional ones; `axes` (axis_id, name) are the devices, or for an organisation the sites,
    that traffic is split by. today's cells end with the current hour. Scope 1 is the organisation.
    """
    axis = "site_id" if organisation else "device_id"
    q15 = scope_partials(events, now, organisation).transform(_stored_once)
    scopes = sites.select("site_id", "max_capacity") if not organisation else sites.agg(F.sum("max_capacity").alias("max_capacity")).select(F.lit(1).cast("long").alias("site_id"), "max_capacity")
    seen = events.where(F.col("t") < now)
    traffic = seen.select((F.lit(1).cast("long") if organisation else F.col("site_id")).alias("scope"), F.col(axis).alias("axis_id"), quarter(F.col("t")).alias("q")).groupBy("scope", "q", "axis_id").count()
    split = traffic.withColumn("pct", rollups.share(F.col("count"), "scope", "q")).groupBy(F.col("scope").alias("site_id"), "q").agg(F.array_sort(F.collect_list(F.struct("axis_id", "pct"))).alias("traffic"))
    spined = rollups.spine(events.sparkSession, scopes, now).join(q15, ["site_id", "q"], "left").join(split, ["site_id", "q"], "left").fillna(0, [*MEASURES, "dwell_sum", "dwell_count"])
    spined = rollups.rolling_peak(spined)
    dwell = F.when(F.col("dwell_count") > 0, F.col("dwell_sum") / F.col("dwell_count")).otherwise(F.lit(0.0))
    mean = rollups.mean_occupancy()
    cell = F.struct("cell", "entrances", "exits", (F.col("entrances") + F.col("exits")).alias("footfall"), mean.alias("occupancy"), dwell.alias("dwell_time"), F.array(mean * 100 / F.col("max_capacity"), F.col("rolling_peak") * 100 / F.col("max_capacity")).alias("capacity"), "traffic")
    out = spined.groupBy("site_id").agg(F.array_sort(F.collect_list(cell)).alias("last_24h"))
    entries = seen.where("event = 1").withColumn("site_id", F.lit(1).cast("long") if organisation else F.col("site_id"))
    t = F.col("t")
    this_week = (now // 86400 + 3) // 7
    hours = now % 86400 // 3600 + (1 if now % 3600 else 0)
    grains = {
        "today": (rollups.today(q15, now), max(hours, 1), 0, day_of(t) == now // 86400),
        "yesterday": (rollups.yesterday(q15, now), 24, 0, day_of(t) == now // 86400 - 1),
        "week": (rollups.week(q15, now), 7, 0, week_of(t) == this_week),
        "weeks_4": (rollups.trailing_weeks(q15, now, 4), 4, 0, week_of(t).between(this_week - 3, this_week)),
        "weeks_12": (rollups.trailing_weeks(q15, now, 12), 12, 0, week_of(t).between(this_week - 11, this_week)),
        "year": (rollups.year(q15, now), 12, 0, year_of(t) == F.year(F.timestamp_seconds(F.lit(now)))),
        "all_time": (rollups.all_time(q15), None, 0, F.lit(True)),
    }
    for name, (rows, n, first, inside) in grains.items():
        cells = _cells(rows, "cells", n, first).join(demographics(entries, inside), "site_id", "left")
        out = out.join(cells.select("site_id", F.struct("cells", "age_pct", "sex_pct").alias(name)), "site_id", "left")
    names = axes.agg(F.array_sort(F.collect_list(F.struct("axis_id", "name"))).alias("traffic_axes"))
    return out.crossJoin(F.broadcast(names))  # one row


def _stored_once(df: DataFrame) -> DataFrame:
    return df.persist()


