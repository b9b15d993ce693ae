"""Quality by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .common import bounded_batches, discard, lean, stored, whole_rows
from .hashing import blocks, text_buffer
from .thresholds import hash_rank, thresholds
from .tokens import style_grams

BUCKETS = 1 << 14
#: Labelled rows that the target model and the threshold are fitted on: those of smallest hashed id, at most so many.
LABELLED = 20_000
#: A document's importance weight is that of so many of its n-grams, whatever its length: else long texts would decide alone.
LENGTH = 500.0


def _grams(batch: pa.RecordBatch, buckets: int):
    data, offsets = text_buffer(batch["text"])
    for first, last, block, at in blocks(data, offsets):
        grams, row = style_grams(block, at, buckets)
        yield first, last, grams, row


def _counts(labels, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good = np.sort(np.array([k for k, v in labels.value.items() if v == 1], np.int64))
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            ids = batch["doc_id"].fill_null(-1).to_numpy(zero_copy_only=False)
            mine = np.isin(ids, good) & ~batch["doc_id"].is_null().to_numpy(zero_copy_only=False)
            for first, last, grams, row in _grams(batch, buckets):
                raw += np.bincount(grams, minlength=buckets)
                if mine[first:last].any():
                    target += np.bincount(grams[mine[first:last][row]], minlength=buckets)
        at = np.flatnonzero(raw)
        yield pa.record_batch([pa.array(at), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "raw", "target"])

    return run


def _scores(ratio, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ratio.value
        for batch in batches:
            total, n = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for first, last, grams, row in _grams(batch, buckets):
                total[first:last] = np.bincount(row, weights=table[grams], minlength=last - first)
                n[first:last] = np.bincount(row, minlength=last - first)
            mean = np.divide(total, n, out=np.zeros(len(n)), where=n > 0)
            carried = [c for c in batch.schema.names if c != "text"]
            yield pa.record_batch([*[batch[c] for c in carried], pa.array(total), pa.array(mean), pa.array(n)], names=[*carried, "log_ratio", "score", "n_grams"])

    return run


def best_cut(score: np.ndarray, good: np.ndarray) -> float:
    """The score from which on rows count as good, with the fewest errors; the middle of the gap; -inf without labels."""
    if not len(score) or good.all():
        return float("-inf")
    order = np.argsort(score, kind="stable")
    s, g = score[order], good[order].astype(np.int64)
    wrong = np.concatenate([[0], np.cumsum(g)]) + np.concatenate([np.cumsum((1 - g)[::-1])[::-1], [0]])
    ok = np.concatenate([[True], s[1:] > s[:-1], [True]])
    k = int(np.flatnonzero(ok)[np.argmin(wrong[ok])])
    return float("-inf") if k == 0 else float("inf") if k == len(s) else float((s[k - 1] + s[k]) / 2)


def quality_scores(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", buckets: int = BUCKETS, labelled: int = LABELLED, length: float = LENGTH) -> DataFrame:
    """One row for each document: doc_id, log_ratio, score, n_grams, kept.

    Two hashed n-gram models with add-one smoothing: target from the labelled good documents (quality 1; at most
    `labelled` labelled rows, of smallest hashed id, are used), raw from all documents. A document's log_ratio is
    its log weight under target over raw, `score` the mean for an n-gram. Its importance weight is exp(`length` x score):
    what `length` of its n-grams would weigh, so that texts of all lengths compete alike. Kept are the k documents of
    largest `length` x score plus Gumbel noise: a sample without replacement by importance weight. The noise hangs on the
    id alone, so reruns agree. k is the number of documents from the labelled rows' best cut on; the k-th key is found by
    histograms, not by a sort. Documents whose keys tie at the end are all kept.

    Null or empty text: no n-grams, score 0. Null ids: noise of the empty id. Without labelled rows, or
    without bad ones among them, all stay. Empty table: no rows.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    scored, _, last = _judged(rows, labels, buckets, labelled, length)
    return scored.withColumn("kept", F.col("rank") < F.lit(last)).select("doc_id", "log_ratio", "score", "n_grams", "kept")


def _judged(rows: DataFrame, labels: DataFrame, buckets: int, labelled: int, length: float) -> tuple[DataFrame, Callable, int]:
    """The rows (doc_id, text) scored and ranked, stored; what scores and ranks rows with more columns alike; the rank that kept rows are below."""
    spark = rows.sparkSession
    bounded_batches(spark)
    use = labels.where("doc_id is not null and quality is not null").select("doc_id", "quality").withColumn("r", hash_rank(F.col("doc_id"))).orderBy("r", "doc_id").limit(labelled)
    known = {r["doc_id"]: r["quality"] for r in use.collect()}
    told = spark.sparkContext.broadcast(known)
    found = rows.select("doc_id", "text").mapInArrow(lean(_counts(told, buckets)), "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.ones(buckets), np.ones(buckets)
    raw[found["bucket"]] += found["raw"]
    target[found["bucket"]] += found["target"]
    half = buckets // 2
    ratio = spark.sparkContext.broadcast(np.concatenate([np.log(target[s] / target[s].sum()) - np.log(raw[s] / raw[s].sum()) for s in (slice(0, half), slice(half, None))]))
    uniform = (hash_rank(F.concat(F.lit("gumbel"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))) + 0.5) / float(1 << 60)
    key = F.col("score") - F.log(-F.log(uniform)) / F.lit(length)
    rank = F.least(F.greatest(F.floor((F.lit(64.0) - key) * float(1 << 52)), F.lit(0)), F.lit((1 << 60) - 1)).cast("long")  # highest key first

    def ranked(rows: DataFrame) -> DataFrame:
        carried = [f for f in rows.schema.fields if f.name != "text"]
        schema = StructType([*carried, *[StructField(c, t) for c, t in (("log_ratio", DoubleType()), ("score", DoubleType()), ("n_grams", LongType()))]])
        return rows.mapInArrow(lean(_scores(ratio, buckets)), schema).withColumn("rank", rank)

    scored = stored(ranked(rows))
    sample = use.select(F.col("doc_id").alias("id"), "quality").join(scored, F.col("id") == F.col("doc_id")).select("score", "quality").toPandas()
    cut = best_cut(sample["score"].to_numpy(float), sample["quality"].to_numpy() == 1)
    k = scored.where(F.col("score") >= cut).count()
    narrow = scored.select(F.lit(1).alias("one"), F.lit(0).alias("all"), "rank")
    budget = spark.range(1).select(F.lit(0).alias("all"), F.lit(float(k)).alias("budget"))
    bound = thresholds(narrow, "all", "rank", "one", budget).first() if k else None
    last = bound["bound"] + int(bound["at_bound"] > 0 and bound["below"] < k) if bound else 0  # ties at the end stay, unless k are full before them
    return scored, ranked, last


def good_documents(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of `docs` that `quality_scores` keeps, all columns as they are.

    Each row follows its own verdict, also where ids repeat or are null. The rows are not shuffled, and only scores are written: for the
    bound first, and again, the same from the same text, where the rows are read.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"), whole_rows(docs).alias("row"))
    scored, ranked, last = _judged(rows.drop("row"), labels, BUCKETS, LABELLED, LENGTH)
    discard(scored)
    return ranked(rows).where(F.col("rank") < F.lit(last)).select("row.*")
