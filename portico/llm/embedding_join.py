"""Near-duplicate embeddings by int8 tile products with proven error bounds, exact in double precision."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, local_components, stored

THRESHOLD = 0.98
#: Vectors of a tile, on average. A pair of tiles is all that a task holds at a time.
TILE = 1024
#: Above this width an int8 dot product no longer fits a float32 exactly.
EXACT_WIDTH = (1 << 24) // (127 * 127)


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes of unit vectors, their scales, the norms of what the codes stand for, and of the errors."""
    scale = np.abs(x).max(axis=1) / 127.0
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    back = codes * scale[:, None]
    return codes, scale, np.linalg.norm(back, axis=1), np.linalg.norm(x - back, axis=1)


def possible(a: tuple, b: tuple, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose cosine may reach the threshold.

    With x = s q + e, the cosine of x and y differs from s t (q . r) by at most |s q| |f| + |e| |t r| + |e| |f|.
    """
    kind = np.float32 if a[0].shape[1] <= EXACT_WIDTH else np.float64
    dots = a[0].astype(kind) @ b[0].astype(kind).T
    near = dots * a[1][:, None] * b[1][None, :]
    slack = a[2][:, None] * b[3][None, :] + a[3][:, None] * (b[2] + b[3])[None, :]
    return np.nonzero(near + slack >= threshold - 1e-9)


def _tile(key: tuple, rows: pa.Table) -> pa.Table:
    ids, sizes = rows["node"].to_numpy(), rows["copies"].to_numpy()
    order = np.lexsort((ids,))
    vectors = np.stack([np.asarray(v, dtype=np.float64) for v in rows["embedding"].to_pylist()])[order]
    return pa.table({"label": [key[0].as_py()], "width": pa.array([key[1].as_py()], pa.int32()), "tile": pa.array([key[2].as_py()], pa.int32()), "n": pa.array([len(ids)], pa.int32()), "ids": [ids[order].tobytes()], "copies": [sizes[order].tobytes()], "vectors": [vectors.tobytes()]})


def _pairs(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                side = []
                for s in "ab":
                    ids, copies = np.frombuffer(row[f"ids_{s}"], np.int64), np.frombuffer(row[f"copies_{s}"], np.int64)
                    x = np.frombuffer(row[f"vectors_{s}"], np.float64).reshape(len(ids), -1)
                    x = x / np.abs(x).max(axis=1)[:, None]
                    side.append((ids, copies, x / np.linalg.norm(x, axis=1)[:, None]))
                (ids_a, copies_a, xa), (ids_b, copies_b, xb) = side
                i, j = possible(quantise(xa), quantise(xb), threshold)
                if row["tile_a"] == row["tile_b"]:
                    i, j = i[i < j], j[i < j]
                good = np.concatenate([np.zeros(0, bool), *[np.einsum("ij,ij->i", xa[i[k : k + 65536]], xb[j[k : k + 65536]]) >= threshold for k in range(0, len(i), 65536)]])
                i, j = i[good], j[good]
                if not len(i):
                    continue
                ids = np.concatenate([ids_a, ids_b])
                links = np.zeros(len(ids), np.int64)
                np.add.at(links, i, copies_b[j])
                np.add.at(links, j + len(ids_a), copies_a[i])
                names, flat = np.unique(ids, return_inverse=True)
                low = names[local_components(len(names), flat[i], flat[j + len(ids_a)])][flat]
                hit = np.flatnonzero(links)
                yield pa.record_batch([pa.array(ids[hit]), pa.array(links[hit]), pa.array(low[hit])], names=["node", "links", "low"])

    return run


def embedding_links(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """One row for each vector: vec_id, n_links, component_id, kept.

    Vectors link when their labels are equal and not null and their cosine in double precision is at least
    `threshold`. Equal vectors of a label become one with a number of copies, by partial sums. The rest is dealt
    into tiles of about `tile` vectors by hash; pairs of tiles of a label (and width) are products of int8 codes,
    and only pairs that the error bound cannot rule out are computed in double precision. A pair of tiles gives
    a count and the smallest linked id for each vector, not its pairs. The comparisons of a label are as many as
    its pairs of tiles, each of which is a row of its own, so a hot label spreads over all tasks.

    Vectors that are null, empty, zero, or hold null or non-finite parts link with nothing, nor do those of a null
    label or of different widths. Rows that repeat a vec_id count as vectors of their own, and each has its own links. Null ids: no links are
    found for their own row and they count for no other; component null, kept false. Empty table: no rows.
    """
    v = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"), F.col(label).cast("string").alias("label"))
    big = F.aggregate("embedding", F.lit(0.0), lambda acc, x: F.greatest(acc, F.coalesce(F.abs(x), F.lit(float("inf")))))
    fine = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & (big > 0) & (big < float("inf"))
    key = F.sha2(F.to_json(F.struct("label", F.transform("embedding", lambda x: x + 0.0).alias("e"))), 256)
    v = v.withColumn("key", F.when(F.coalesce(fine, F.lit(False)), key))
    # a number for each distinct vector of a label, fixed once written: the smallest vec_id may belong to several
    reps = stored(v.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("embedding").alias("embedding")).withColumn("node", F.monotonically_increasing_id()))
    reps = reps.withColumn("width", F.size("embedding"))
    counts = reps.groupBy("label", "width").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    tiles = stored(
        reps.join(counts, ["label", "width"]).withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int"))
        .select("label", "width", "tile", "node", "copies", "embedding").groupBy("label", "width", "tile")
        .applyInArrow(_tile, "label string, width int, tile int, n int, ids binary, copies binary, vectors binary")
    )
    names = tiles.select("label", "width", F.col("tile").alias("tile_b"))
    plan = names.join(counts, ["label", "width"]).withColumn("tile_a", F.explode(F.sequence(F.lit(0), F.col("tile_b"))))
    side = lambda s: tiles.select("label", "width", F.col("tile").alias(f"tile_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in ("ids", "copies", "vectors")])
    paired = plan.select("label", "width", "tile_a", "tile_b").join(side("a"), ["label", "width", "tile_a"]).join(side("b"), ["label", "width", "tile_b"])
    found = stored(paired.select("tile_a", "tile_b", *[f"{c}_{s}" for s in "ab" for c in ("ids", "copies", "vectors")]).mapInArrow(_pairs(threshold), "node long, links long, low long"))
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    comp = components(found, "node", "low").withColumnRenamed("vertex", "node").withColumnRenamed("component", "group")
    nodes = reps.select("key", "node", "rep", "copies").join(linked, "node", "left").join(comp, "node", "left").withColumn("group", F.coalesce("group", "node"))
    first = nodes.groupBy("group").agg(F.min("rep").alias("component"))  # nodes' numbers say nothing of ids
    out = v.join(nodes.join(first, "group"), "key", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce(F.col("copies") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


ORACLE = """
WITH v AS (SELECT row_number() OVER () AS n, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
f AS (SELECT n, vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.n AS a, b.n AS b, a.vec_id AS ia, b.vec_id AS ib FROM f a JOIN f b ON a.label = b.label AND a.n <> b.n AND len(a.e) = len(b.e) AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
"""
ORACLE = (
    ORACLE.replace("WITH v", "WITH RECURSIVE v", 1)
    + """r(a, low) AS (SELECT n, vec_id FROM v UNION SELECT l.b, r.low FROM r JOIN l ON l.a = r.a AND r.low < l.ib),
c AS (SELECT a, min(low) AS component_id FROM r GROUP BY a),
k AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT v.vec_id, coalesce(k.n_links, 0) AS n_links, c.component_id, coalesce(v.vec_id = c.component_id, false) AS kept FROM v JOIN c ON c.a = v.n LEFT JOIN k ON k.a = v.n
"""
)
