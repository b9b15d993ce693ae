"""Budget thresholds on hashes by nested histograms: no sort, only the boundary bucket is looked at again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, stored

#: A rank is a whole number of 60 bits, read 12 bits at a time.
LEVEL_BITS, LEVELS = 12, 5


def hash_rank(key: Column) -> Column:
    """60 bits of the MD5 of a key's text; a null key counts as the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def thresholds(rows: DataFrame, group: str, rank: str, weight: str, budgets: DataFrame, budget: str = "budget") -> DataFrame:
    """For each group of `budgets` its bound: rows of rank below `bound` weigh `below`, at most the budget.

    Returns (group, bound, below, at_bound): `at_bound` is the weight of the rows whose rank is the bound itself,
    with which the budget would be passed. Where all rows fit, the bound is 2^60 and at_bound 0. Groups are
    matched null-safely; budgets below 0 count as 0. Each of the five levels sums the weights by group and 12
    bits (partial sums first) over the rows of the boundary bucket alone, and finds the next boundary in at most
    4096 sums of a group, so that no group is ever gathered or sorted. The state between levels is written.
    """
    state = budgets.select(F.col(group).alias("_g"), F.greatest(F.col(budget).cast("double"), F.lit(0.0)).alias("_left"), F.lit(0).cast("long").alias("_prefix"), F.lit(0).cast("long").alias("_below"), F.lit(False).alias("_done"))
    at = F.lit(0).cast("long")
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        open_ = state.where(~F.col("_done"))
        same = F.shiftright(F.col(rank), shift + LEVEL_BITS) == F.col("_prefix")
        sums = (
            rows.join(open_, rows[group].eqNullSafe(F.col("_g")) & same)
            .groupBy("_g", F.shiftright(F.col(rank), shift).alias("_b"))
            .agg(F.sum(weight).alias("_w"), F.first("_left").alias("_l"))
        )
        run = sums.withColumn("_cum", F.sum("_w").over(Window.partitionBy("_g").orderBy("_b")))
        over = F.col("_cum") > F.col("_l")
        hit = run.groupBy("_g").agg(F.min(F.when(over, F.struct("_b", "_w", (F.col("_cum") - F.col("_w")).alias("before")))).alias("_hit"), F.sum("_w").alias("_all"))
        at = F.col("_hit._w")
        old = state.alias("o")
        joined = old.join(hit.withColumnRenamed("_g", "_k"), F.col("_g").eqNullSafe(F.col("_k")), "left")
        found = F.col("_hit").isNotNull()
        state = joined.select(
            "_g",
            F.when(found, F.col("_left") - F.col("_hit.before")).otherwise(F.col("_left")).alias("_left"),
            F.when(found, F.col("_hit._b")).otherwise(F.col("_prefix")).alias("_prefix"),
            (F.col("_below") + F.when(found, F.col("_hit.before")).when(~F.col("_done"), F.coalesce("_all", F.lit(0))).otherwise(F.lit(0))).cast("long").alias("_below"),
            (F.col("_done") | ~found).alias("_done"),
            F.when(found, at).otherwise(F.lit(0)).cast("long").alias("_at"),
        )
        state = stored(state if level == LEVELS - 1 else state.drop("_at"))  # one row for each group; else each level would compute all earlier ones again
        if level:
            discard(last)
        last = state
    return state.select(F.col("_g").alias(group), F.when(F.col("_done"), F.lit(1 << 60)).otherwise(F.col("_prefix")).cast("long").alias("bound"), F.col("_below").alias("below"), F.col("_at").alias("at_bound"))
