"""How a snapshot is kept current: horizons, change classes, ranges to read, the three-way split of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLASSES = ("REBUILD", "SOURCE_ACTIVATION", "SOURCE_RETIREMENT", "INCREMENTAL", "PROMOTE_ONLY", "METADATA_ONLY", "TIME_ONLY", "NO_OP")


def horizon() -> Column:
    return F.coalesce("analyzed_until", "created_at")


def site_horizons(sites: DataFrame, devices: DataFrame) -> DataFrame:
    """site_id, latest, stable: greatest and least horizon of the enabled devices of enabled sites; no row without any."""
    on = devices.where("status = 'enabled'").join(sites.where("status = 'enabled'").select("site_id"), "site_id")
    return on.groupBy("site_id").agg(F.max(horizon()).alias("latest"), F.min(horizon()).alias("stable"))


def organisation_stable(horizons: DataFrame, now: Column) -> DataFrame:
    """One row `stable`: the least of all sites, at most now; now without active sites."""
    return horizons.agg(F.least(F.coalesce(F.min("stable"), now), now).alias("stable"))


def split_events(events: DataFrame, stable: DataFrame, now: Column) -> DataFrame:
    """`part` of each event: final before its site's stable time, provisional up to now, then pending."""
    s = stable.select("site_id", F.least("stable", now).alias("_stable"))
    joined = events.join(s, "site_id", "left").withColumn("_stable", F.coalesce("_stable", now))
    return joined.withColumn("part", F.when(F.col("t") < F.col("_stable"), "stable").when(F.col("t") < now, "provisional").otherwise("pending")).drop("_stable")


def compare_devices(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new device rows of a site side by side with what changed: one row for each device of either.

    Inputs have site_id, device_id, name, status, created_at, analyzed_until, analysis_config.
    """
    fields = ("name", "status", "created_at", "analyzed_until", "analysis_config")
    side = lambda df, p: df.select("site_id", "device_id", *[F.col(f).alias(f"{p}_{f}") for f in fields], F.coalesce("analyzed_until", "created_at").alias(f"{p}_horizon"), F.lit(True).alias(f"in_{p}"))
    both = side(old, "old").join(side(new, "new"), ["site_id", "device_id"], "full")
    changed = lambda f: ~F.col(f"old_{f}").eqNullSafe(F.col(f"new_{f}"))
    paired = F.col("in_old").isNotNull() & F.col("in_new").isNotNull()
    back = F.col("old_analyzed_until").isNotNull() & (F.col("new_analyzed_until").isNull() | (F.col("new_analyzed_until") < F.col("old_analyzed_until")))
    return both.select(
        "site_id", "device_id", "old_horizon", "new_horizon",
        (~paired | changed("created_at") | changed("analysis_config") | back).alias("rebuild"),
        (paired & (F.col("old_status") == "enabled") & (F.col("new_status") == "disabled")).alias("retired"),
        (paired & (F.col("old_status") == "disabled") & (F.col("new_status") == "enabled")).alias("activated"),
        (paired & changed("horizon")).alias("moved"),
        (paired & (changed("name") | changed("status") | changed("analyzed_until"))).alias("described"),
    )


def classify_sites(state: DataFrame, sites: DataFrame, old_devices: DataFrame, new_devices: DataFrame, now: Column) -> DataFrame:
    """site_id, change: what has to be done for each site. First match wins, in the order of CLASSES.

    `state` has a row for each site with a usable snapshot: site_id, view_until, stable_until, status, destination,
    max_capacity, next_pending (time of the first pending event or null). Sites without one are rebuilt.
    A device whose horizon lay behind the stable time and has moved since forces a rebuild; here that comes before
    activation and retirement, so that late rows of one device are not lost when another one changes its status.
    Activating a device whose horizon moved while it was off, or one behind the stable time, is an error.
    """
    s = state.select("site_id", F.col("view_until").alias("_view"), F.col("stable_until").alias("_stable"), F.col("status").alias("_status"), F.col("destination").alias("_destination"), F.col("max_capacity").alias("_capacity"), F.col("next_pending").alias("_pending"))
    d = compare_devices(old_devices, new_devices).join(s.select("site_id", "_stable"), "site_id", "left")
    any_ = lambda c: F.coalesce(F.max(c), F.lit(False))
    flags = d.groupBy("site_id").agg(
        any_(F.col("rebuild")).alias("_rebuild"), any_(F.col("retired")).alias("_retired"), any_(F.col("activated")).alias("_activated"), any_(F.col("moved")).alias("_moved"), any_(F.col("described")).alias("_described"),
        any_(F.col("activated") & F.col("moved")).alias("_unsafe"), any_(F.col("moved") & (F.col("old_horizon") < F.col("_stable")) & (F.col("new_horizon") > F.col("old_horizon"))).alias("_late"),
    )
    all_ = sites.join(s, "site_id", "left").join(flags, "site_id", "left").join(site_horizons(sites, new_devices), "site_id", "left").fillna(False, ["_rebuild", "_retired", "_activated", "_moved", "_described", "_unsafe", "_late"])
    activated = F.col("_activated") | ((F.col("_status") == "disabled") & (F.col("status") == "enabled"))
    retired = F.col("_retired") | ((F.col("_status") == "enabled") & (F.col("status") == "disabled"))
    effective = F.least(F.coalesce("stable", now), now)
    error = F.raise_error(F.concat(F.lit("cannot activate a source of site "), F.col("site_id").cast("string"))).cast("string")
    change = (
        F.when(F.col("_stable").isNull() | F.col("_rebuild") | ~F.col("destination").eqNullSafe(F.col("_destination")) | (F.col("_late") & ~F.col("_unsafe")), "REBUILD")
        .when(activated, F.when(F.col("_unsafe") | (F.col("stable") < F.col("_stable")), error).otherwise("SOURCE_ACTIVATION"))
        .when(retired, "SOURCE_RETIREMENT")
        .when(F.col("_moved"), "INCREMENTAL")
        .when((effective > F.col("_stable")) | (F.col("_pending") < now), "PROMOTE_ONLY")
        .when(F.col("_described") | ~F.col("status").eqNullSafe(F.col("_status")) | ~F.col("max_capacity").eqNullSafe(F.col("_capacity")), "METADATA_ONLY")
        .when(F.col("_view") != now, "TIME_ONLY")
        .otherwise("NO_OP")
    )
    return all_.select("site_id", change.alias("change"))


def classify_organisation(site_changes: DataFrame, old_members: DataFrame, new_members: DataFrame) -> DataFrame:
    """One row `change`: rebuild when membership changed, else the most far-reaching change of its sites."""
    moved = old_members.select("site_id").exceptAll(new_members.select("site_id")).unionByName(new_members.select("site_id").exceptAll(old_members.select("site_id"))).agg((F.count("*") > 0).alias("_moved"))
    order = F.array(*[F.lit(c) for c in CLASSES])
    top = site_changes.agg(F.min(F.array_position(order, F.col("change"))).alias("_rank"))
    return top.join(moved).select(F.when(F.col("_moved") | F.col("_rank").isNull(), "REBUILD").otherwise(F.element_at(order, F.col("_rank").cast("int"))).alias("change"))


def plan_ranges(changes: DataFrame, sites: DataFrame, old_devices: DataFrame, new_devices: DataFrame, organisation_rebuild: bool = False) -> DataFrame:
    """destination, site_id, device_id, start, end to read: all since creation for a rebuild, else what each device gained.

    Devices just activated read nothing, nor do idle ones without a last gain.
    """
    old = old_devices.select("site_id", "device_id", horizon().alias("_from"), F.col("status").alias("_old"))
    d = new_devices.select("site_id", "device_id", "created_at", horizon().alias("end"), F.col("status").alias("_new"))
    s = sites.select("site_id", "destination", F.col("status").alias("_site"), F.col("created_at").alias("_site_created"))
    j = d.join(s, "site_id").join(changes, "site_id").join(old, ["site_id", "device_id"], "left")
    full = (F.col("change") == "REBUILD") | F.lit(organisation_rebuild)
    gains = F.col("change").isin("INCREMENTAL", "SOURCE_RETIREMENT", "SOURCE_ACTIVATION") & ~((F.col("_old") == "disabled") & (F.col("_new") == "enabled"))
    start = F.when(full, F.greatest("_site_created", "created_at")).otherwise(F.greatest(F.coalesce("_from", "created_at"), "created_at"))
    return j.where(full | gains).select("destination", "site_id", "device_id", start.alias("start"), "end").where("start < end")


def fingerprint(sites: DataFrame, devices: DataFrame) -> DataFrame:
    """One row: a hash of the configuration that a computation rests on; names and progress are left out."""
    conf = sites.select(F.to_json(F.struct("site_id", "status", "destination", "max_capacity", "created_at")).alias("j")).unionByName(devices.select(F.to_json(F.struct("device_id", "site_id", "status", "created_at")).alias("j")))
    return conf.agg(F.sha2(F.to_json(F.sort_array(F.collect_list("j"))), 256).alias("fingerprint"))
