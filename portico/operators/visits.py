"""Visits: entries and exits of a site matched first in, first out, with a timeout of four hours.

Number a site's exits j = 1, 2, ... With A the entries ordered before exit j, E those whose timeout has passed
and p the entries gone after an exit, f = max(p before, E); the exit matches entry f + 1 if f < A, and else stands
alone. In q = p - j that is q = min(A - j, max(E + 1 - j, q before)): a clamp. Clamps compose to clamps, so time
chunks fold alone, the chunks' clamps fold in turn, and each chunk then knows where it starts.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portico.functions.times import LONGEST_VISIT

#: Seconds of a chunk, the most that a task holds of one site.
CHUNK = 86400
NONE_LOW, NONE_HIGH = -(1 << 62), 1 << 62


def _stream(events: DataFrame, by: str, timeout: int) -> DataFrame:
    """Entries (kind 0), exits (1) and timeouts (2), each with its chunk; at one second in that order."""
    main = events.select(by, "t", F.when(F.col("event") == 1, 0).otherwise(1).alias("kind"), "device_id", "event_id")
    late = main.where("kind = 0").select(by, (F.col("t") + timeout).alias("t"), F.lit(2).alias("kind"), "device_id", "event_id")
    return main.unionByName(late).withColumn("chunk", F.floor(F.col("t") / CHUNK).cast("long"))


def _numbered(pdf: pd.DataFrame) -> tuple[pd.DataFrame, list[tuple[int, int, int]]]:
    """The chunk in order with ordinals, and for each exit (its row, lower bound, upper bound) of the clamp."""
    pdf = pdf.sort_values(["t", "kind", "device_id", "event_id"], kind="stable").reset_index(drop=True)
    entries = pdf["kind"].eq(0).cumsum() + pdf["entries_before"]
    exits = pdf["kind"].eq(1).cumsum() + pdf["exits_before"]
    gone = pdf["kind"].eq(2).cumsum() + pdf["gone_before"]
    pdf["ordinal"] = entries.where(pdf["kind"].eq(0), exits)
    at = pdf.index[pdf["kind"].eq(1)]
    return pdf, list(zip(at, (gone[at] + 1 - exits[at]).tolist(), (entries[at] - exits[at]).tolist(), strict=True))


def _fold(by: str):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        low, high = NONE_LOW, NONE_HIGH
        for _, a, b in _numbered(pdf)[1]:
            low, high = min(b, max(a, low)), min(b, max(a, high))
        return pd.DataFrame({by: [key[0]], "chunk": [key[1]], "low": [low], "high": [high]})

    return run


def _match(by: str):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, bounds = _numbered(pdf)
        q = int(pdf["q"].iloc[0])
        partner = pd.Series(0, index=pdf.index, dtype="int64")
        for row, a, b in bounds:
            before = max(a, q)
            q = min(b, before)
            if before <= b:
                partner[row] = q + int(pdf.at[row, "ordinal"])
        pdf["partner"] = partner
        return pdf.loc[pdf["kind"] < 2, [by, "t", "kind", "device_id", "event_id", "ordinal", "partner"]]

    return run


def matched_events(events: DataFrame, by: str = "site_id", timeout: int = LONGEST_VISIT) -> DataFrame:
    """Entries (kind 0) and exits (kind 1) of each site with their ordinal; exits with their entry's ordinal, 0 if none.

    Columns: `by`, t, kind, device_id, event_id, ordinal, partner. A task holds one chunk of one site.
    """
    stream = _stream(events, by, timeout)
    count = lambda k: F.sum(F.when(F.col("kind") == k, 1).otherwise(0))
    before = Window.partitionBy(by).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = stream.groupBy(by, "chunk").agg(count(0).alias("entries"), count(1).alias("exits"), count(2).alias("gone"))
    for c in ("entries", "exits", "gone"):
        chunks = chunks.withColumn(f"{c}_before", F.coalesce(F.sum(c).over(before), F.lit(0)))
    chunks = chunks.drop("entries", "exits", "gone")
    based = stream.join(chunks, [by, "chunk"])
    kind = dict(events.dtypes)
    folded = based.groupBy(by, "chunk").applyInPandas(_fold(by), f"`{by}` {kind[by]}, chunk long, low long, high long")
    # the clamps of the chunks before, in order, applied to 0: one short row for each chunk
    earlier = F.collect_list(F.struct("low", "high")).over(before)
    start = F.aggregate(earlier, F.lit(0).cast("long"), lambda q, c: F.least(c["high"], F.greatest(c["low"], q)))
    starts = folded.select(by, "chunk", start.alias("q"))
    return based.join(starts, [by, "chunk"]).groupBy(by, "chunk").applyInPandas(_match(by), f"`{by}` {kind[by]}, t long, kind int, device_id {kind['device_id']}, event_id {kind['event_id']}, ordinal long, partner long")


def visits(events: DataFrame, by: str = "site_id", timeout: int = LONGEST_VISIT) -> DataFrame:
    """One row for each entry: `by`, ordinal, entry_id, entry, leave, exit_id, dwell.

    `leave` is the matched exit or entry + timeout; exit_id and dwell are null where the visit timed out.
    """
    m = matched_events(events, by, timeout)
    entries = m.where("kind = 0").select(by, "ordinal", F.col("event_id").alias("entry_id"), F.col("t").alias("entry"))
    exits = m.where("kind = 1 and partner > 0").select(by, F.col("partner").alias("ordinal"), F.col("event_id").alias("exit_id"), F.col("t").alias("exit"))
    return entries.join(exits, [by, "ordinal"], "left").select(by, "ordinal", "entry_id", "entry", F.coalesce("exit", F.col("entry") + timeout).alias("leave"), "exit_id", (F.col("exit") - F.col("entry")).alias("dwell"))


def orphan_exits(events: DataFrame, by: str = "site_id", timeout: int = LONGEST_VISIT) -> DataFrame:
    """Exits that found nobody inside. They count as exits and traffic, not for occupancy or dwell."""
    return matched_events(events, by, timeout).where("kind = 1 and partner = 0").select(by, F.col("event_id").alias("exit_id"), "t")
