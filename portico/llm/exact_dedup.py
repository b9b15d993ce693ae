"""Exact de-duplication with a two-pass Bloom filter, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import page_bit, row_order, slot_pages, whole_rows
from .common import PAGE_BITS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Slots of the filter, 2 bits of hash each row. It is broadcast as a bitmap of FILTER_SLOTS / 8 = 4 MB at most.
FILTER_SLOTS = 1 << 25


def normalised(text: Column) -> Column:
    """A-Z lower-cased, all else as it is; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def _slots(text: Column) -> Column:
    one = F.xxhash64(text)
    return F.array(F.pmod(one, F.lit(FILTER_SLOTS)), F.pmod(F.xxhash64(one, F.lit(1)), F.lit(FILTER_SLOTS)))


def repeated_slots(docs: DataFrame, text: str = "text") -> DataFrame:
    """First pass: the slots that at least two rows fall into, as pages (page, bits) of 4 KB.

    Counts are combined before the shuffle. There are FILTER_SLOTS / 32768 pages at most.
    """
    slots = docs.select(F.explode(_slots(normalised(F.col(text)))).alias("slot")).groupBy("slot").count().where("count > 1")
    return slot_pages(slots, "slot")


def _marked(docs: DataFrame, text: str, rows: DataFrame) -> DataFrame:
    """`rows` (norm, and what else is to be carried) with `maybe`: whether both slots of the text repeat in `docs`."""
    pages = F.broadcast(repeated_slots(docs, text))  # at most 1024 pages of 4 KB
    rows = rows.withColumn("slots", _slots(F.col("norm")))
    for k in (0, 1):
        page = pages.select(F.col("page").alias(f"page{k}"), F.col("bits").alias(f"bits{k}"))
        slot = F.col("slots")[k]
        rows = rows.withColumn("at", F.floor(slot / PAGE_BITS).cast("int")).join(page, F.col("at") == F.col(f"page{k}"), "left")
        rows = rows.withColumn(f"hit{k}", page_bit(F.col(f"bits{k}"), slot)).drop("at", f"page{k}", f"bits{k}")
    return rows.withColumn("maybe", F.col("hit0") & F.col("hit1")).drop("hit0", "hit1", "slots")


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One verdict for each row: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are equal when their texts are, A-Z lower-cased and null as empty. Of equal texts the largest id stays.
    First pass: which hash slots repeat. Second pass: only rows whose two slots both repeat are shuffled by
    their SHA-256, counted with partial sums and joined back (a hot group is a join key, which AQE splits); all
    others pass straight through as groups of one. A false alarm of the filter costs a shuffled row, no more.

    Null ids: such a row stays only if all ids of its group are null. Rows that repeat an id and its text share
    one verdict and each count in group_size. Empty table: no rows. Other columns of `docs` are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), normalised(F.col(text)).alias("norm"))
    rows = _marked(docs, text, rows).select("doc_id", F.sha2("norm", 256).alias("text_sha256"), "maybe")
    alone = rows.where(~F.col("maybe")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    maybe = rows.where("maybe").select("doc_id", F.unhex("text_sha256").alias("key"))
    groups = maybe.groupBy("key").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    judged = maybe.join(groups, "key").select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("key")).alias("text_sha256"))
    return alone.unionByName(judged)


def kept_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Of equal texts one row, that of the largest id, all columns as they are.

    Each row follows its own text: an id that occurs with several texts stays with each of them that is not a copy. Of rows
    that repeat an id and its text (up to case) one stays: of the largest text by code point, then by a hash of the
    row. Null ids are the smallest. Rows whose hash does not repeat pass straight through; the others are
    reduced to one for each text within each task, then shuffled by SHA-256 and reduced again. Empty table: no rows.
    """
    rows = docs.select(whole_rows(docs).alias("row"), normalised(F.col(f"`{text}`")).alias("norm"))
    rows = _marked(docs, text, rows)
    alone = rows.where(~F.col("maybe")).select("row")
    order = row_order(docs, F.col("row").getField(doc_id), F.col("row").getField(text))
    best = rows.where("maybe").groupBy(F.sha2("norm", 256).alias("key")).agg(F.max_by("row", order).alias("row"))
    return alone.unionByName(best.select("row")).select("row.*")


ORACLE = r"""
WITH n AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY text_sha256)
SELECT n.doc_id, g.keep_id, g.group_size, coalesce(n.doc_id = g.keep_id, n.doc_id IS NULL AND g.keep_id IS NULL) AS kept, n.text_sha256
FROM n JOIN g ON n.text_sha256 = g.text_sha256
"""
