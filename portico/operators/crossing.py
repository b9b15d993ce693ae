"""Line crossings of paths: sides of a line, stable runs, events; and picks of the best of each track."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Points so near to the line have no side; runs and paths of so many points count.
DEAD_BAND, STABLE_RUN, SHORTEST_PATH = 2.0, 3, 6


def signed_distance(x: Column, y: Column, a: tuple[float, float], b: tuple[float, float]) -> Column:
    """Distance to the line from a to b, positive on one side; an error if a and b are one point."""
    dx, dy = b[0] - a[0], b[1] - a[1]
    length = (dx * dx + dy * dy) ** 0.5
    if length <= 1e-6:
        return F.raise_error(F.lit("the line has no length")).cast("double")
    return (F.lit(dx) * (y - F.lit(a[1])) - F.lit(dy) * (x - F.lit(a[0]))) / F.lit(length)


def side(distance: Column) -> Column:
    return F.when(distance > DEAD_BAND, 1).when(distance < -DEAD_BAND, -1).otherwise(0)


def crossings(points: DataFrame, a: tuple[float, float], b: tuple[float, float]) -> DataFrame:
    """(track_id, t, event_type) of paths (track_id, pos, t, x, y): a stable run on the other side than the last stable one.

    Points on the line break no run. An event has the time of its run's first point; type 1 from -1 to 1, else 0.
    """
    n = F.count("*").over(Window.partitionBy("track_id"))
    long_enough = points.withColumn("_n", n).where(F.col("_n") >= SHORTEST_PATH)
    sided = long_enough.withColumn("side", side(signed_distance(F.col("x"), F.col("y"), a, b))).where("side <> 0")
    order = Window.partitionBy("track_id").orderBy("pos")
    new = F.when(F.lag("side").over(order).eqNullSafe(F.col("side")), 0).otherwise(1)
    runs = sided.withColumn("_new", new).withColumn("_run", F.sum("_new").over(order))
    stable = runs.groupBy("track_id", "_run").agg(F.first("side").alias("side"), F.count("*").alias("n"), F.min_by("t", "pos").alias("t")).where(F.col("n") >= STABLE_RUN)
    before = F.lag("side").over(Window.partitionBy("track_id").orderBy("_run"))
    return stable.withColumn("_before", before).where("_before is not null and _before <> side").select("track_id", "t", F.when(F.col("side") == 1, 1).otherwise(0).alias("event_type"))


def first_of(rows: DataFrame, by: str, *order: Column) -> DataFrame:
    """The first row of each key in the order given."""
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where("_k = 1").drop("_k")


def best_crop(points: DataFrame, confidence: str = "confidence") -> DataFrame:
    """Each track's point of highest confidence, the earliest among equals."""
    return first_of(points, "track_id", F.col(confidence).desc(), F.col("pos"))


#: Spans of time that frame times are dealt into; one row of each meets in one task.
SPANS = 4096


def frame_rate(times: DataFrame, time: str = "t") -> DataFrame:
    """One over the median positive difference of successive times; an error without any.

    Differences are taken within equal spans of the whole range; a span's first time looks back to the last one of the
    spans before it.
    """
    at = times.select(F.col(time).cast("double").alias("_t")).where("_t is not null").distinct()
    ends = at.agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"))
    dealt = at.crossJoin(F.broadcast(ends)).select("_t", F.floor(F.coalesce((F.col("_t") - F.col("_first")) / F.nullif(F.col("_last") - F.col("_first"), F.lit(0.0)), F.lit(0.0)) * SPANS).alias("_span"))
    within = F.col("_t") - F.lag("_t").over(Window.partitionBy("_span").orderBy("_t"))
    spans = dealt.groupBy("_span").agg(F.min("_t").alias("_low"), F.max("_t").alias("_high"))
    across = F.col("_low") - F.lag("_high").over(Window.orderBy("_span"))
    gaps = dealt.select(within.alias("_g")).unionByName(spans.select(across.alias("_g")))
    median = F.median("_g")
    return gaps.where("_g > 0").agg(F.when(median.isNull(), F.raise_error(F.lit("no two times differ")).cast("double")).otherwise(1 / median).alias("fps"))
