"""Detections after a model: clipping, rounding, ids, confidence classes; overlays; and the models' plug-in points."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Confidence, overlap and number that a detector is asked for; faces or bodies in one model call.
DETECTOR = {"confidence": 0.25, "iou": 0.70, "most": 300, "classes": (0,)}
MODEL_BATCH = 16


def post_project(raw: DataFrame) -> DataFrame:
    """Boxes (frame_id, idx, x1, y1, x2, y2, confidence, width, height) clipped to the image, as detections.

    Empty boxes go; coordinates are rounded to 32-bit floats before the centre is taken; ids count the kept boxes.
    """
    clip = lambda c, most: F.least(F.greatest(F.col(c), F.lit(0.0)), F.col(most).cast("double")).cast("float").cast("double")
    boxed = raw.select("frame_id", "idx", clip("x1", "width").alias("x1"), clip("y1", "height").alias("y1"), clip("x2", "width").alias("x2"), clip("y2", "height").alias("y2"), F.col("confidence").cast("float").cast("double").alias("confidence"))
    kept = boxed.where("x1 < x2 and y1 < y2")
    n = F.row_number().over(Window.partitionBy("frame_id").orderBy("idx")) - 1
    centre = lambda a, b: ((F.col(a) + F.col(b)) / 2).cast("float").cast("double")
    return kept.withColumn("detection_id", F.concat("frame_id", F.lit(":det:"), n.cast("string"))).withColumn("cx", centre("x1", "x2")).withColumn("cy", centre("y1", "y2"))


def confidence_class(confidence: Column) -> Column:
    return F.when(confidence >= 0.50, "high").when(confidence >= 0.25, "low")


def iou(a: list[Column], b: list[Column]) -> Column:
    """Intersection over union of two boxes (x1, y1, x2, y2); 0 where the union is empty."""
    w = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0))
    h = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0.0))
    area = lambda x: F.greatest(x[2] - x[0], F.lit(0.0)) * F.greatest(x[3] - x[1], F.lit(0.0))
    union = area(a) + area(b) - w * h
    return F.when(union > 0, w * h / union).otherwise(F.lit(0.0))


def overlay(detections: DataFrame, points: DataFrame, event_tracks: DataFrame) -> DataFrame:
    """Detections with their track and colour (green if the track has an event): joined on time and centre to 1e-6.

    Of several track points of one place the last (by track order) wins; detections without one are left out.
    """
    place = lambda x, y: [F.round(x, 6).alias("_x"), F.round(y, 6).alias("_y")]
    right = points.select("timestamp", *place(F.col("x"), F.col("y")), "track_id", "ordinal")
    last = right.groupBy("timestamp", "_x", "_y").agg(F.max_by("track_id", "ordinal").alias("track_id"))
    left = detections.withColumns({"_x": F.round("cx", 6), "_y": F.round("cy", 6)})
    marked = event_tracks.select("track_id").distinct().withColumn("_event", F.lit(True))
    joined = left.join(last, ["timestamp", "_x", "_y"]).join(marked, "track_id", "left")
    return joined.withColumn("colour", F.when(F.col("_event"), "green").otherwise("red")).drop("_x", "_y", "_event")


def link_candidates(fragments: DataFrame, gap: float) -> DataFrame:
    """Pairs of fragments (by, fragment, first, last) with last < first of the later <= last + gap.

    A band join by buckets as wide as the gap: each fragment meets the later ones of its bucket and the next.
    """
    bucket = lambda c: F.floor(F.col(c) / gap).cast("long")
    a = fragments.select("by", F.col("fragment").alias("earlier"), F.col("last"), F.explode(F.array(bucket("last"), bucket("last") + 1)).alias("_b"))
    b = fragments.select("by", F.col("fragment").alias("later"), F.col("first"), bucket("first").alias("_b"))
    return a.join(b, ["by", "_b"]).where((F.col("first") > F.col("last")) & (F.col("first") <= F.col("last") + gap)).drop("_b")


#: A model is made once for each worker and maps a batch of rows to a batch of rows.
Model = Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]
_models: dict[str, Callable[[pd.DataFrame], pd.DataFrame]] = {}


def apply_model(rows: DataFrame, name: str, make: Model, schema: str, batch: int = MODEL_BATCH) -> DataFrame:
    """`make()`'s model over the rows, `batch` at a time; the model stays loaded in its worker."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _models.get(name) or _models.setdefault(name, make())
        for part in parts:
            for k in range(0, len(part), batch):
                yield model(part.iloc[k : k + batch])

    return rows.mapInPandas(run, schema)


def decode_demographics(rows: DataFrame, low: float, high: float, mean: float) -> DataFrame:
    """track_id, age, sex from a model's three outputs: scores of male and female, and a scaled age."""
    age = F.floor(F.col("out2") * (high - low) + mean + 0.5).cast("int")
    return rows.select("track_id", age.alias("age"), F.when(F.col("out0") >= F.col("out1"), 1).otherwise(0).alias("sex"))
