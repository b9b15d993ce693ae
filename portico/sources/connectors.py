"""Where data comes from and goes to: frames, databases, warehouse events, append and file sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portico.functions.times import frame_time, strict_time

#: Start of a device that was never analysed.
FIRST_WINDOW = "2026-08-01T00:00:00.000Z"


def bucket_and_prefix(uri: Column) -> Column:
    """struct(bucket, prefix) of a `gs://bucket/prefix`; anything else is an error."""
    fits = uri.rlike(r"^gs://[^/]+")
    parts = F.struct(F.regexp_extract(uri, r"^gs://([^/]+)", 1).alias("bucket"), F.regexp_replace(F.regexp_extract(uri, r"^gs://[^/]+(/.*)?$", 1), "^/+", "").alias("prefix"))
    return F.when(fits, parts).otherwise(F.raise_error(F.concat(F.lit("not a bucket address: "), F.coalesce(uri, F.lit("null")))))


def list_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Every object below a folder: path, length, modificationTime, content (read only where it is used)."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)


def select_frames(objects: DataFrame, start: Column, end: Column, name: str = "path") -> DataFrame:
    """Objects whose name holds a time t with start <= t < end, with frame_id, captured_at and seconds since start.

    Names without a time are passed over. A selected object without content is an error when it is decoded.
    """
    at = frame_time(F.col(name))
    found = objects.withColumn("captured_at", at).where((F.col("captured_at") >= start) & (F.col("captured_at") < end))
    relative = (F.unix_micros("captured_at") - F.unix_micros(start)) / F.lit(1e6)
    return found.withColumn("frame_id", F.substring_index(name, "/", -1)).withColumn("timestamp", relative)


def decoded_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Decoded images of a folder (BGR bytes with height, width, channels). One that cannot be decoded is an error."""
    found = spark.read.format("image").option("recursiveFileLookup", "true").option("dropInvalid", "false").load(folder).select("image.*")
    broken = F.raise_error(F.concat(F.lit("not an image: "), F.coalesce("origin", F.lit("?")))).cast("int")
    return found.withColumn("height", F.when(F.col("height") > 0, F.col("height")).otherwise(broken))


def database(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A query of a database through JDBC; the filters of `query` run there."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def device_context(devices: DataFrame, sites: DataFrame, device_id: int, now: Column) -> DataFrame:
    """One device with its site's destination and its window from analyzed_until (or the first window) to now, in whole milliseconds."""
    one = devices.where(F.col("device_id") == device_id).join(sites.select("site_id", "destination"), "site_id")
    return one.withColumn("start", F.coalesce(F.col("analyzed_until"), strict_time(F.lit(FIRST_WINDOW)))).withColumn("end", F.timestamp_millis(F.unix_millis(now)))


def missing_rows(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    return wanted.select(key).join(present.select(key), key, "left_anti")


def parse_destination(value: Column, strict: bool = False) -> Column:
    """`project.dataset.table` from itself or from a console address whose `ws` names `1s..!2s..!3s..`; else null, or an error if `strict`.

    Fixed values: a project is of letters, digits, `_` and `-`; a dataset and a table of letters, digits and `_`.
    """
    project, name = r"[A-Za-z0-9_-]+", r"[A-Za-z0-9_]+"
    ws = F.try_url_decode(F.regexp_extract(value, r"[?&]ws=([^&#]*)", 1))
    path = rf"(?:^|!)1s({project})!2s({name})!3s({name})(?:!|$)"
    from_link = F.concat_ws(".", *[F.regexp_extract(ws, path, k) for k in (1, 2, 3)])
    wrong = F.raise_error(F.concat(F.lit("not a destination: "), F.coalesce(value, F.lit("null")))) if strict else F.lit(None).cast("string")
    return F.when(value.rlike(rf"^{project}\.{name}\.{name}$"), value).when(ws.rlike(path), from_link).otherwise(wrong)


def append_new(rows: DataFrame, path: str, key: str = "event_id") -> int:
    """Appends rows whose key the table does not hold yet, once each; returns how many. No rows: nothing is written."""
    spark = rows.sparkSession
    fresh = rows.dropDuplicates([key])
    try:
        fresh = fresh.join(spark.read.parquet(path).select(key), key, "left_anti")
    except Exception as error:  # first write: no table yet
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
    fresh = fresh.persist()
    n = fresh.count()
    if n:
        fresh.write.mode("append").parquet(path)
    fresh.unpersist()
    return n


def write_events_csv(rows: DataFrame, path: str) -> None:
    rows.select("device_id", "event_id", "event", "timestamp", "sex", "age_bucket").write.mode("overwrite").option("header", "true").csv(path)


def window_name(text: Column) -> Column:
    """A time's text as part of a folder name."""
    return F.translate(text, "-:.", "")
