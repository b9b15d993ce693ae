"""Shared parts of the training-data operators: materialisation, Bloom filters over ids, components."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Bytes of packed records that a task holds before it hands them on.
FLUSH_BYTES = 16 << 20
#: Bytes of an Arrow batch between Spark and its Python workers. Texts can be long, and either side holds a few batches.
BATCH_BYTES = 4 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only where the session names none and is local."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="portico-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """`df` written as Parquet in the shared folder and read again: its lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def whole_rows(df: DataFrame) -> Column:
    """A row as one struct: carried through an operator, its columns clash with none of the operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def row_order(df: DataFrame, *first: Column) -> Column:
    """An order of whole rows (named row) that depends on what they hold alone; maps do not count."""
    held = [F.col("row").getField(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.struct(*first, F.xxhash64(*held))


def counted(df: DataFrame, what: Column | None = None) -> tuple[DataFrame, int]:
    """`df` stored, and the number of its rows (or another sum over them), counted while it is written."""
    seen = Observation()
    out = stored(df.observe(seen, (F.count(F.lit(1)) if what is None else what).alias("n")))
    return out, int(seen.get.get("n") or 0)


def discard(*tables: DataFrame) -> None:
    """Removes the files of stored tables that nothing will read any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by bytes, unless it sets a bound of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":  # Spark's default
        spark.conf.set(name, str(BATCH_BYTES))


def give_back() -> None:
    """Returns this process's freed memory to the system: NumPy's by the C library, where it can, and Arrow's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable) -> Callable:
    """`run`, a function for mapInArrow, for workers that wait beside others after their task: they keep no freed memory."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parallelism(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


# -- packed records -----------------------------------------------------------------------------

BLOB_SCHEMA = "bucket int, kind int, blob binary"


def blob_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())],
        names=["bucket", "kind", "blob"],
    )


def columns_to_blob(columns: list[np.ndarray]) -> bytes:
    """Equally long columns one after the other: the shuffle's compression likes that better than rows."""
    return b"".join(np.ascontiguousarray(c).tobytes() for c in columns)


def blob_to_columns(blob: bytes, types: list[str]) -> list[np.ndarray]:
    width = sum(np.dtype(t).itemsize for t in types)
    n, at, out = len(blob) // width, 0, []
    for t in types:
        out.append(np.frombuffer(blob, dtype=t, count=n, offset=at))
        at += n * np.dtype(t).itemsize
    return out


def bucketed_blobs(kind: int, key: np.ndarray, columns: list[np.ndarray], buckets: int) -> list[tuple[int, int, bytes]]:
    """One blob for each bucket of the unsigned 64-bit keys that has records."""
    if not len(key):
        return []
    bucket = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [c[order] for c in columns]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    return [(int(bucket[a]), kind, columns_to_blob([c[a:b] for c in columns])) for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(bucket)], strict=True)]


def gather_blobs(batches: Iterator[pa.RecordBatch], types: dict[int, list[str]]) -> Iterator[dict[int, list[np.ndarray]]]:
    """The records of each kind, column by column, one bucket at a time; the partition is sorted by bucket."""
    found: dict[int, list[list[np.ndarray]]] = {k: [] for k in types}
    now = None

    def columns():
        return {k: [np.concatenate([f[i] for f in found[k]]) if found[k] else np.zeros(0, t) for i, t in enumerate(types[k])] for k in types}

    for batch in batches:
        for bucket, kind, blob in zip(batch["bucket"].to_pylist(), batch["kind"].to_pylist(), batch["blob"], strict=True):
            if bucket != now and any(found.values()):
                yield columns()
                found = {k: [] for k in types}
            now = bucket
            found[kind].append(blob_to_columns(blob.as_py(), types[kind]))
    if any(found.values()):
        yield columns()


def by_bucket(blobs: DataFrame) -> DataFrame:
    return blobs.repartition(parallelism(blobs.sparkSession), "bucket").sortWithinPartitions("bucket")


# -- Bloom filter over ids ----------------------------------------------------------------------

#: Slots of a filter: a broadcast of 1 MB at most, whatever the input's size. Full, it only lets more rows through.
FILTER_SLOTS = 1 << 23


def _slot(ids: Column) -> Column:
    return F.pmod(F.xxhash64(ids), F.lit(FILTER_SLOTS))


def id_filter(ids: DataFrame, column: str) -> np.ndarray:
    """A bit for each slot that an id of `ids` falls into, as at most 256 words of 4 KB on the driver."""
    return slot_filter(ids, _slot(F.col(column)), FILTER_SLOTS)


def slot_filter(rows: DataFrame, slot: Column, slots: int) -> np.ndarray:
    """A bit for each of `slots` slots that a row falls into: slots / 8 bytes on the driver, whatever the rows."""
    rows = rows.groupBy(F.bitmap_bucket_number(slot).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect()
    out = np.zeros(slots // 8 + 8192, dtype=np.uint8)
    for r in rows:
        start = (r["part"] - 1) * 4096 if r["part"] > 0 else slots // 8
        out[start : start + 4096] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


#: Bits of a page of a filter that is told as rows (page, bits).
PAGE_BITS = 32768


def slot_pages(slots: DataFrame, slot: str) -> DataFrame:
    """(page, bits): the slots that occur, as pages of 4 KB."""
    return slots.groupBy(F.floor(F.col(slot) / PAGE_BITS).cast("int").alias("page")).agg(F.bitmap_construct_agg(F.pmod(F.col(slot), F.lit(PAGE_BITS)).cast("long")).alias("bits"))


def page_bit(bits: Column, slot: Column) -> Column:
    """Whether the slot occurs, from the bits of its page (null: no such page)."""
    at = F.pmod(slot, F.lit(PAGE_BITS)).cast("int")
    byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0, F.lit(False))


def maybe_among(rows: DataFrame, column: str, ids: DataFrame, id_column: str) -> DataFrame:
    """Adds `maybe`: false only where the row's id is not in `ids`. FILTER_SLOTS bits (1 MB) are broadcast, whatever the ids."""
    pages = F.broadcast(slot_pages(ids.select(_slot(F.col(id_column)).alias("slot")).distinct(), "slot").withColumnRenamed("page", "_page"))
    slot = _slot(F.col(column))
    met = rows.join(pages, F.floor(slot / PAGE_BITS).cast("int") == F.col("_page"), "left")
    return met.withColumn("maybe", page_bit(F.col("bits"), slot)).drop("_page", "bits")


def with_slot(df: DataFrame, column: str, name: str = "_slot") -> DataFrame:
    """Adds where `id_filter` keeps the bit of this row's id."""
    slot = _slot(F.col(column))
    part = F.bitmap_bucket_number(slot)
    base = F.when(part > 0, (part - 1) * 32768).otherwise(F.lit(FILTER_SLOTS))
    return df.withColumn(name, (base + F.bitmap_bit_position(slot)).cast("long"))


def in_filter(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


# -- connected components -----------------------------------------------------------------------


#: Edges that a task holds at a time, and that one task may join alone.
FOREST_EDGES = 1 << 20


def _local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's edges as stars around each local component's smallest vertex; at most FOREST_EDGES meet at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def stars():
        a, b = (np.concatenate(x) for x in zip(*held, strict=True))
        names, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
        label = local_components(len(names), flat[: len(a)], flat[len(a) :])
        rest = np.flatnonzero(label != np.arange(len(names)))
        return names[rest], names[label[rest]]

    def told(src, dst):
        for k in range(0, len(src), 1 << 16):
            yield pa.record_batch([pa.array(src[k : k + (1 << 16)], pa.int64()), pa.array(dst[k : k + (1 << 16)], pa.int64())], names=["src", "dst"])

    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        if sum(len(h[0]) for h in held) > FOREST_EDGES:
            held = [stars()]
            if len(held[0][0]) > FOREST_EDGES // 2:
                yield from told(*held[0])
                held = []
    if held:
        yield from told(*stars())


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest vertex of each vertex's component among vertices 0..n-1 under the edges a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new
    return label


def components(edges: DataFrame, a: str, b: str, count: int | None = None) -> DataFrame:
    """(vertex, component) for each vertex that has an edge: the smallest vertex that it reaches.

    Large-star and small-star rounds until only stars are left; each round is written to the shared folder. Vertices
    are longs; null ends and loops are left out. No vertices: an empty table. Where the caller knows that there are
    FOREST_EDGES edges or less (`count`), one task joins them at once.
    """
    pairs = edges.select(F.col(a).cast("long").alias("src"), F.col(b).cast("long").alias("dst")).where("src <> dst")
    if count is not None and count <= FOREST_EDGES:
        pairs = pairs.coalesce(1)
    now = stored(pairs.mapInArrow(lean(_local_forest), "src long, dst long"))
    while True:
        # stars of their own: nothing that points anywhere is pointed at, or points twice
        ends = now.select(F.col("src").alias("v"), F.lit(1).alias("out"), F.lit(0).alias("in")).unionByName(now.select(F.col("dst").alias("v"), F.lit(0).alias("out"), F.lit(1).alias("in")))
        if ends.groupBy("v").agg(F.sum("out").alias("out"), F.max("in").alias("in")).where("out > 1 or (out = 1 and in = 1)").isEmpty():
            break
        both = now.unionByName(now.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low"))
        large = both.join(low, "src").where("dst > src and dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        large = large.unionByName(low.where("low <> src").select("src", F.col("low").alias("dst"))).distinct()
        least = large.groupBy("src").agg(F.min("dst").alias("low"))
        small = large.join(least, "src").where("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        last, now = now, stored(small.unionByName(least.select("src", F.col("low").alias("dst"))).where("src <> dst").distinct())
        discard(last)
    roots = now.select(F.col("dst").alias("vertex")).distinct().withColumn("component", F.col("vertex"))
    return now.select(F.col("src").alias("vertex"), F.col("dst").alias("component")).unionByName(roots)
