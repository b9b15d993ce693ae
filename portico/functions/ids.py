"""Ids and small codes of output events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Last age of each bucket but the sixth.
AGE_LIMITS = (4, 13, 25, 45, 65)


def age_bucket(age: Column) -> Column:
    out = F.lit(len(AGE_LIMITS))
    for code in reversed(range(len(AGE_LIMITS))):
        out = F.when(age <= AGE_LIMITS[code], code).otherwise(out)
    return F.when(age.isNotNull(), out)


def positive_hash(text: Column) -> Column:
    """1 to 2^63 - 1: the first eight bytes of the SHA-256, big-endian, modulo 2^63 - 1, plus 1."""
    head = F.conv(F.substring(F.sha2(text, 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return (head % F.lit("9223372036854775807").cast("decimal(20,0)") + 1).cast("long")


def event_payload(device: Column, stamp: Column, event: Column, sex: Column, bucket: Column, track: Column, occurrence: Column) -> Column:
    """Compact JSON array of an event's identity; the occurrence joins it only where identities repeat (else null)."""
    quoted = lambda c: F.get(F.split(F.to_json(F.struct(c.alias("v"))), '"v":', 2), F.lit(1))
    text = lambda c: F.regexp_replace(quoted(c), r"\}$", "")
    parts = [device.cast("string"), text(stamp), event.cast("string"), sex.cast("string"), bucket.cast("string"), text(track)]
    return F.concat(F.lit("["), F.concat_ws(",", *parts, occurrence.cast("string")), F.lit("]"))
