"""Quarter-hour partials and what they roll up to: days, weeks, trailing weeks, months, years, shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portico.functions.times import QUARTER, day_of, hour_of, month_of, quarter, week_of, weekday, year_of

from .occupancy import quarter_cells, segments
from .visits import visits

CELLS = 96


def q15_counts(events: DataFrame, by: list[str]) -> DataFrame:
    q = quarter(F.col("t")).alias("q")
    return events.groupBy(*by, q).agg(F.sum("event").cast("long").alias("entrances"), F.sum(1 - F.col("event")).cast("long").alias("exits"))


def q15_dwell(stays: DataFrame, by: list[str]) -> DataFrame:
    """Dwell seconds and visits, in the quarter hour of the exit; timed-out visits have none."""
    done = stays.where("dwell is not null")
    return done.groupBy(*by, quarter(F.col("leave")).alias("q")).agg(F.sum("dwell").alias("dwell_sum"), F.count("*").alias("dwell_count"))


def q15_partials(events: DataFrame, until: Column | None = None) -> DataFrame:
    """One mergeable row for each site and quarter hour with any event or presence; nothing open past `until`."""
    stays = visits(events)
    keys = ["site_id", "q"]
    occupied = quarter_cells(segments(stays, "site_id", until), ["site_id"])
    out = q15_counts(events, ["site_id"]).join(occupied, keys, "full").join(q15_dwell(stays, ["site_id"]), keys, "full")
    return out.select(*keys, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("entrances", "exits", "area", "seconds", "min_pos", "max_occ", "dwell_sum", "dwell_count")])


def merged(q15: DataFrame, *cells: Column) -> DataFrame:
    """Partials summed over coarser cells; a least level of 0 means never occupied."""
    sums = [F.sum(c).cast("long").alias(c) for c in ("entrances", "exits", "area", "seconds")]
    return q15.groupBy(*cells).agg(*sums, F.coalesce(F.min(F.when(F.col("min_pos") > 0, F.col("min_pos"))), F.lit(0)).cast("long").alias("min_pos"), F.max("max_occ").cast("long").alias("max_occ"))


def mean_occupancy(area: str = "area", seconds: str = "seconds") -> Column:
    return F.when(F.col(seconds) > 0, F.col(area) / F.col(seconds)).otherwise(F.lit(0.0))


def share(value: Column, *partition: str) -> Column:
    """Percentage of the partition's total; 0 where that is 0."""
    total = F.sum(value).over(Window.partitionBy(*partition))
    return F.when(total == 0, F.lit(0.0)).otherwise(value * 100 / total)


def today(q15: DataFrame, now: int) -> DataFrame:
    return merged(q15.where(day_of(F.col("q")) == now // 86400), F.col("site_id"), hour_of(F.col("q")).alias("cell"))


def yesterday(q15: DataFrame, now: int) -> DataFrame:
    return merged(q15.where(day_of(F.col("q")) == now // 86400 - 1), F.col("site_id"), hour_of(F.col("q")).alias("cell"))


def week(q15: DataFrame, now: int) -> DataFrame:
    return trailing_weeks(q15, now, 1, weekday(F.col("q")))


def trailing_weeks(q15: DataFrame, now: int, weeks: int, cell: Column | None = None) -> DataFrame:
    """The current ISO week and those before it; the current one is cell weeks - 1."""
    first = (now // 86400 + 3) // 7 - weeks + 1
    index = week_of(F.col("q")) - first
    return merged(q15.where(index.between(0, weeks - 1)), F.col("site_id"), (index.cast("int") if cell is None else cell).alias("cell"))


def year(q15: DataFrame, now: int) -> DataFrame:
    this = F.year(F.timestamp_seconds(F.lit(now)))
    return merged(q15.where(year_of(F.col("q")) == this), F.col("site_id"), (month_of(F.col("q")) - 1).alias("cell"))


def all_time(q15: DataFrame) -> DataFrame:
    return merged(q15, F.col("site_id"), year_of(F.col("q")).alias("cell"))


def spine(spark: SparkSession, keys: DataFrame, now: int, cells: int = CELLS) -> DataFrame:
    """Each key with each of the last `cells` quarter hours; the last one holds `now`."""
    last = now // QUARTER * QUARTER
    return keys.withColumn("q", F.explode(F.sequence(F.lit(last - (cells - 1) * QUARTER).cast("long"), F.lit(last).cast("long"), F.lit(QUARTER).cast("long")))).withColumn("cell", ((F.col("q") - (last - (cells - 1) * QUARTER)) / QUARTER).cast("int"))


def rolling_peak(spined: DataFrame, by: str = "site_id") -> DataFrame:
    """The highest level up to each cell of the window."""
    w = Window.partitionBy(by).orderBy("q").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return spined.withColumn("rolling_peak", F.max("max_occ").over(w))
