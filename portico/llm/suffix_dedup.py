"""Removal of repeated byte strings by prefix-free parsing over the whole corpus.

Rolling-hash triggers cut each text into overlapping phrases such that equal strings are cut alike. The
dictionary keeps each distinct phrase once, with its first place; all later places are repeats as a whole. Only
dictionary phrases that share a trigger string with another one can still hold equal strings at different places;
their suffixes are brought into corpus order (equal ones together, by place) and all but the first are repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOB_SCHEMA, FLUSH_BYTES, blob_batch, bounded_batches, bucketed_blobs, by_bucket, gather_blobs, id_filter, in_filter, parallelism, stored, with_slot
from .hashing import blocks, mix, span_hashes, text_buffer, window_hashes

WIDTH = 100
#: Bytes of a trigger string. Every WIDTH-byte string holds WIDTH - TRIGGER + 1 of them, of which the smallest rules.
TRIGGER = 32
#: trigger hash, phrase hash, document, first start, starts less one
PHRASE = ["<u8", "<u8", "<i8", "<i4", "<u1"]
#: string hash, document, start
STRING = ["<u8", "<i8", "<i4"]
RUN_SCHEMA = "kind int, doc_id long, lo int, hi int"


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` successive values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def phrases(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH, trigger: int = TRIGGER) -> tuple[np.ndarray, ...]:
    """(row, first start, last start, trigger hash, phrase hash) of the buffer's phrases; starts count from the row's begin.

    A string's trigger is the leftmost of its trigger strings with the smallest hash. Successive starts with the same trigger
    place make a phrase: all bytes of their strings. Rows below `width` bytes have none.
    """
    none = np.zeros(0, np.int64)
    starts = len(data) - width + 1
    if starts <= 0:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    own = window_hashes(data, trigger)
    low = np.uint64((1 << 32) - 1)
    ranked = (own & ~low) | np.arange(len(own), dtype=np.uint64)
    place = (sliding_min(ranked, width - trigger + 1) & low).astype(np.int64)
    fits = np.ones(len(data) + 1, np.int8)
    for end in offsets[1:].tolist():
        fits[max(end - width + 1, 0) : end] = 0
    fits = fits[:starts].astype(bool)
    new = np.ones(starts, bool)
    new[1:] = place[1:] != place[:-1]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    new |= edge[:starts]
    new[1:] |= ~fits[:-1]
    lo = np.flatnonzero(new & fits)
    last = np.ones(starts, bool)
    last[:-1] = new[1:] | ~fits[1:]
    hi = np.flatnonzero(last & fits)
    row = np.searchsorted(offsets, lo, side="right") - 1
    return row, lo - offsets[row], hi - offsets[row], own[place[lo]], span_hashes(data, lo, hi + width)


def _firsts(keys: list[np.ndarray], doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key and place; marks of each key's begin, and of records that lie after the key's first place."""
    order = np.lexsort((pos, doc, *keys[::-1]))
    begin = np.ones(len(doc), bool)
    begin[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    head = np.maximum.accumulate(np.where(begin, np.arange(len(doc)), 0))
    d, p = doc[order], pos[order]
    return order, begin, (d != d[head]) | (p != p[head])


def _runs(kind: int, doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(doc), 1 << 16):
        s = slice(k, k + (1 << 16))
        yield pa.record_batch([pa.array(np.full(len(doc[s]), kind, np.int32)), pa.array(doc[s].astype(np.int64)), pa.array(lo[s].astype(np.int32)), pa.array(hi[s].astype(np.int32))], names=["kind", "doc_id", "lo", "hi"])


def _joined(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of starts of a document that touch become one."""
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order], hi[order]
    begin = np.ones(len(doc), bool)
    begin[1:] = (doc[1:] != doc[:-1]) | (lo[1:] > hi[:-1] + 1)
    cut = np.flatnonzero(begin)
    return (doc[cut], lo[cut], np.maximum.reduceat(hi, cut)) if len(cut) else (doc, lo, hi)


def _phrase_blobs(width: int, trigger: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def packed():
            th, ph, doc, lo, more = (np.concatenate(x) for x in zip(*held, strict=True))
            order, begin, later = _firsts([th, ph], doc, lo)
            th, ph, doc, lo, more = (x[order] for x in (th, ph, doc, lo, more))
            d, a, b = _joined(doc[later], lo[later], lo[later].astype(np.int64) + more[later])
            out = bucketed_blobs(0, span_key(d), [d.astype("<i8"), a.astype("<i4"), b.astype("<i4")], buckets)
            cut = np.flatnonzero(begin)
            # a trigger's hash is the least of many: mixed, or most phrases would fall into the first buckets
            out += bucketed_blobs(1, mix(th[cut]), [th[cut], ph[cut], doc[cut].astype("<i8"), lo[cut].astype("<i4"), more[cut].astype("<u1")], buckets)
            return blob_batch(out)

        for batch in batches:
            ids = batch["doc_id"].to_numpy(zero_copy_only=False)
            data, offsets = text_buffer(batch["text"])
            for first, _, block, at in blocks(data, offsets):
                row, lo, hi, th, ph = phrases(block, at, width, trigger)
                if len(row):
                    held.append((th, ph, ids[first + row].astype(np.int64), lo.astype(np.int32), (hi - lo).astype(np.uint8)))
                    size += 29 * len(row)
                if size > FLUSH_BYTES:
                    yield packed()
                    held, size = [], 0
        if held:
            yield packed()

    return run


def span_key(doc: np.ndarray) -> np.ndarray:
    return doc.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def _dictionary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kind 0: runs of starts that are repeats. Kind 1: first places of phrases whose trigger other phrases share."""
    for found in gather_blobs(batches, {0: ["<i8", "<i4", "<i4"], 1: PHRASE}):
        yield from _runs(0, *found[0])
        th, ph, doc, lo, more = found[1]
        if not len(th):
            continue
        order, begin, later = _firsts([th, ph], doc, lo)
        th, doc, lo, hi = th[order], doc[order], lo[order], lo[order].astype(np.int64) + more[order]
        yield from _runs(0, *_joined(doc[later], lo[later], hi[later]))
        th, doc, lo, hi = th[begin], doc[begin], lo[begin], hi[begin]
        same = th[1:] == th[:-1]
        shared = np.zeros(len(th), bool)
        shared[1:] |= same
        shared[:-1] |= same
        yield from _runs(1, *_joined(doc[shared], lo[shared], hi[shared]))


def _string_blobs(bits, width: int, buckets: int):
    """Hashes of all strings that start in the runs of a row's document; repeats within the task are told at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def packed():
            h, doc, pos = (np.concatenate(x) for x in zip(*held, strict=True))
            order, begin, later = _firsts([h], doc, pos)
            h, doc, pos = h[order], doc[order], pos[order]
            d, a, b = _joined(doc[later], pos[later], pos[later])
            out = bucketed_blobs(0, span_key(d), [d.astype("<i8"), a.astype("<i4"), b.astype("<i4")], buckets)
            return blob_batch(out + bucketed_blobs(1, h[begin], [h[begin], doc[begin], pos[begin].astype("<i4")], buckets))

        for batch in batches:
            for doc, runs, text in zip(batch["doc_id"].to_pylist(), batch["runs"].to_pylist(), batch["text"].to_pylist(), strict=True):
                data = np.frombuffer(text.encode(), np.uint8)
                own = window_hashes(data, width)
                starts = np.unique(np.concatenate([np.arange(r["lo"], r["hi"] + 1) for r in runs]))
                held.append((own[starts], np.full(len(starts), doc, np.int64), starts.astype(np.int32)))
                size += 20 * len(starts)
                if size > FLUSH_BYTES:
                    yield packed()
                    held, size = [], 0
        if held:
            yield packed()

    return run


def _corpus_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for found in gather_blobs(batches, {0: ["<i8", "<i4", "<i4"], 1: STRING}):
        yield from _runs(0, *found[0])
        h, doc, pos = found[1]
        if len(h):
            order, _, later = _firsts([h], doc, pos)
            yield from _runs(0, *_joined(doc[order][later], pos[order][later], pos[order][later]))


def _filtered(bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.filter(pa.array(in_filter(bits.value, batch["slot"].to_numpy(zero_copy_only=False).astype(np.int64))))
            if rows.num_rows:
                yield rows.select(["doc_id", "text"])

    return run


def _cut(width: int):
    """Runs stay in flat arrays: a batch can hold very many of them."""

    def spans(lo, hi):
        order = np.argsort(lo, kind="stable")
        lo, hi = lo[order], np.maximum.accumulate(hi[order] + width)
        begin = np.flatnonzero(np.r_[True, lo[1:] > hi[:-1]]) if len(lo) else order
        return lo[begin], hi[np.r_[begin[1:], len(lo)] - 1] if len(lo) else hi

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch["text"])
            runs, none = batch["runs"], np.zeros(0, np.int64)
            told = not pa.types.is_null(runs.type)
            of = runs.offsets.to_numpy() if told else np.zeros(batch.num_rows + 1, np.int64)
            lo, hi = ((runs.values.field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("lo", "hi")) if told else (none, none))
            for first, last, block, at in blocks(data, offsets):
                size, gone, kept, starts, ends = [], [], [], [none], [none]
                for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True), first):
                    begin, end = spans(lo[of[k] : of[k + 1]], hi[of[k] : of[k + 1]])
                    digest, left = hashlib.sha256(), a
                    for x, y in zip((begin + a).tolist(), (end + a).tolist(), strict=True):
                        digest.update(block[left:x])
                        left = y
                    digest.update(block[left:b])
                    size.append(b - a)
                    gone.append(int((end - begin).sum()))
                    kept.append(digest.hexdigest())
                    starts.append(begin)
                    ends.append(end)
                places = pa.array(np.cumsum([len(x) for x in starts]), pa.int32())
                pairs = pa.StructArray.from_arrays([pa.array(np.concatenate(starts)), pa.array(np.concatenate(ends))], ["start", "end"])
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(first, last - first), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array([len(x) for x in starts[1:]], pa.int64()), pa.array(kept, pa.string()), pa.ListArray.from_arrays(places, pairs)], schema=CUT_SCHEMA)

    return run


CUT_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
CUT_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>"


def _by_document(runs: DataFrame) -> DataFrame:
    return runs.groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))


def repeated_runs(docs: DataFrame, width: int = WIDTH, trigger: int = TRIGGER) -> DataFrame:
    """(doc_id, lo, hi): runs of byte offsets at which a `width`-byte string starts that also starts earlier."""
    spark = docs.sparkSession
    bounded_batches(spark)
    n = parallelism(spark)
    blobs = docs.mapInArrow(_phrase_blobs(width, trigger, 4 * n), BLOB_SCHEMA)
    first = stored(by_bucket(blobs).mapInArrow(_dictionary, RUN_SCHEMA))
    shared = first.where("kind = 1").select("doc_id", "lo", "hi")
    bits = spark.sparkContext.broadcast(id_filter(shared, "doc_id"))
    texts = with_slot(docs, "doc_id", "slot").mapInArrow(_filtered(bits), "doc_id long, text string")
    strings = texts.join(_by_document(shared), "doc_id").select("doc_id", "text", "runs").mapInArrow(_string_blobs(bits, width, 4 * n), BLOB_SCHEMA)
    second = stored(by_bucket(strings).mapInArrow(_corpus_order, RUN_SCHEMA))
    return first.where("kind = 0").unionByName(second).select("doc_id", "lo", "hi")


def suffix_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH, trigger: int = TRIGGER) -> DataFrame:
    """One row for each document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start, end of removed bytes).

    Removed is each UTF-8 byte that a `width`-byte string covers which also starts earlier: in a document of a
    smaller id, or earlier in the same one. Strings are those of the input and never cross documents.

    Null text counts as empty; texts below `width` bytes lose nothing. Rows that repeat an id are documents of their
    own, in order of the SHA-256 of their texts; rows that repeat an id and its text count as one place and have the same result. Rows of null ids lose nothing and repeat nothing. A run of
    one byte is one phrase for each place of its trigger, all equal, and so a single dictionary entry. Empty
    table: no rows.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if rows.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        return _dedup(rows, width, trigger)
    # places of rows that repeat an id are numbered in order of id and text; equal rows share one
    own = rows.withColumn("hash", F.sha2("text", 256))
    places = stored(own.where("doc_id is not null").select("doc_id", "hash").distinct().orderBy("doc_id", "hash").withColumn("place", F.monotonically_increasing_id()))
    numbered = own.join(places, ["doc_id", "hash"], "left").select(F.col("place").alias("doc_id"), "text")
    found = _dedup(numbered, width, trigger).withColumnRenamed("doc_id", "place")
    return found.join(places.select("doc_id", "place"), "place", "left").select("doc_id", *[c for c in found.columns if c != "place"])


def _dedup(rows: DataFrame, width: int, trigger: int) -> DataFrame:
    runs = repeated_runs(rows.where(F.col("doc_id").isNotNull()), width, trigger)
    cut_ids = stored(runs.groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("runs")))
    bits = rows.sparkSession.sparkContext.broadcast(id_filter(cut_ids, "doc_id"))
    slotted = with_slot(rows.where(F.col("doc_id").isNotNull()), "doc_id", "slot")
    cut = slotted.mapInArrow(_filtered(bits), "doc_id long, text string").join(cut_ids, "doc_id", "left").select("doc_id", "text", "runs").mapInArrow(_cut(width), CUT_DDL)
    whole = with_slot(rows, "doc_id", "slot").mapInArrow(_untouched(bits), CUT_DDL)
    return cut.unionByName(whole)


def _untouched(bits):
    cut = _cut(WIDTH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"]
            slots = batch["slot"].fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            rows = batch.filter(pa.array(~in_filter(bits.value, slots) | ids.is_null().to_numpy(zero_copy_only=False)))
            if rows.num_rows:
                yield from cut(iter([pa.record_batch([rows["doc_id"], rows["text"], pa.nulls(rows.num_rows, pa.null())], names=["doc_id", "text", "runs"])]))

    return run
