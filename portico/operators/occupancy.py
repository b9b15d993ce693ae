"""Occupancy: levels between changes, and their integral over quarter hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portico.functions.times import QUARTER

#: Seconds of a chunk: the running level is summed within chunks and carried between them.
CHUNK = 86400


def segments(visits: DataFrame, by: str | None = "site_id", until: Column | None = None) -> DataFrame:
    """(`by`, start, end, occupancy) with occupancy above 0, from visits (entry, leave), up to `until` if given.

    Changes of one second become one. The level is a running sum within a chunk of time plus what earlier chunks left,
    so that a hot scope spreads over its chunks. Without `by` all visits are one scope.
    """
    scope = [F.col(by).alias("_scope")] if by else [F.lit(0).alias("_scope")]
    leave = F.col("leave") if until is None else F.least("leave", until)
    kept = visits if until is None else visits.where(F.col("entry") < until)
    moves = kept.select(*scope, F.explode(F.array(F.struct(F.col("entry").alias("t"), F.lit(1).alias("d")), F.struct(leave.alias("t"), F.lit(-1).alias("d")))).alias("m"))
    deltas = moves.groupBy("_scope", F.col("m.t").alias("t")).agg(F.sum("m.d").alias("d")).withColumn("chunk", F.floor(F.col("t") / CHUNK))
    chunks = deltas.groupBy("_scope", "chunk").agg(F.sum("d").alias("d"), F.min("t").alias("first"))
    over = Window.partitionBy("_scope").orderBy("chunk")
    chunks = chunks.select("_scope", "chunk", F.coalesce(F.sum("d").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"), F.lead("first").over(over).alias("next_chunk"))
    w = Window.partitionBy("_scope", "chunk").orderBy("t")
    levels = deltas.join(chunks, ["_scope", "chunk"]).select("_scope", F.col("t").alias("start"), F.coalesce(F.lead("t").over(w), F.col("next_chunk")).alias("end"), (F.col("base") + F.sum("d").over(w)).cast("long").alias("occupancy"))
    out = levels.where("occupancy > 0 and end is not null")
    return out.withColumnRenamed("_scope", by) if by else out.drop("_scope")


def quarter_cells(pieces: DataFrame, by: list[str]) -> DataFrame:
    """Integral of segments over quarter hours: `by`, q, area (person seconds), seconds, min_pos, max_occ.

    Only occupied time counts, so area / seconds is the mean while occupied. All four merge over cells.
    """
    begins = F.sequence(F.floor(F.col("start") / QUARTER) * QUARTER, F.floor((F.col("end") - 1) / QUARTER) * QUARTER, F.lit(QUARTER).cast("long"))
    cut = pieces.withColumn("q", F.explode(begins)).withColumn("sec", F.least("end", F.col("q") + QUARTER) - F.greatest("start", "q"))
    return cut.groupBy(*by, "q").agg(F.sum(F.col("occupancy") * F.col("sec")).alias("area"), F.sum("sec").alias("seconds"), F.min("occupancy").alias("min_pos"), F.max("occupancy").alias("max_occ"))
