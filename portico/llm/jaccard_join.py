"""Exact Jaccard self-join of documents on word shingles, with set-relation skipping.

Prefix filtering on an order that puts frequent shingles last gives an index of short lists. Sets that turn out
highly similar to a list's leading set take over its answers. In lists that still hold different components, each
component asks for its nearest outside set only, and answers for all its sets at once; whole blocks of a list are skipped
by position. What is left after a few such rounds is answered pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import BLOB_SCHEMA, FLUSH_BYTES, FOREST_EDGES, blob_batch, bounded_batches, bucketed_blobs, by_bucket, components, counted, discard, gather_blobs, id_filter, in_filter, lean, local_components, maybe_among, parallelism, row_order, slot_filter, stored, whole_rows, with_slot
from .hashing import blocks, mix, shingle_sets, text_buffer

WORDS = 5
PERCENT = 75
#: Frequent shingles go last in the order, by tier of estimated frequency. Each tier is told to all tasks as a Bloom
#: filter of so many slots (4 MB), whatever the input; a false alarm only moves a shingle in the order, the same for all.
TIERS, TIER_SLOTS = (32, 256, 2048, 16384), 1 << 25
#: Frequencies are estimated from one in so many occurrences, chosen by hash of shingle and set: the same whatever the tasks.
SAMPLED = 16
#: Leaders of each list that its other sets are compared with first.
LEADERS = 4
#: Rounds at most in which each component asks for its nearest outside set; they end once fewer than one in WORTH of
#: the pairs link. The rest is answered pair by pair.
NEAREST, WORTH = 6, 4
#: Slots of the filter of pairs that were answered no: 1 MB. A false alarm only leaves a pair to the last round.
ANSWERED_SLOTS = 1 << 23
#: Entries of a list that one task compares with so many others.
LIST_BLOCK = 4096
#: Entries of a block of an index list that are skipped at once.
SKIP = 64
#: Lists of so many entries bring signatures of so many bits; shorter ones have few pairs an entry.
SIGNED, SIGN_BITS = 8, 2048
#: Pairs that are bounded at once.
SIGN_PAIRS = 1 << 15
#: Of sets of more shingles than LONG any two may differ in most of SIGN_BITS: they have a signature of so many bits
#: as well, an eighth of the set at most, that is looked at before whole sets are.
LONG, WIDE_BITS = 2048, 1 << 14
ENTRY = {0: ["<i8", "<i8", "<i4"], 1: ["<u8", "<i8", "<i4", "<i4"], 2: ["<i8", f"V{SIGN_BITS // 8}"], 3: ["<i8", f"V{WIDE_BITS // 8}"]}


def needed(a, b, percent: int):
    """Fewest shared shingles of linked sets of a and b shingles: 100 i >= p (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    """Linked sets share one of the first so many shingles of either, in any common order."""
    return n - -(-percent * n // 100) + 1


def set_hash(s: np.ndarray) -> int:
    """A set's name: 64 bits of its sorted shingles and their number."""
    if not len(s):
        return 0
    odd = np.arange(len(s), dtype=np.uint64) * np.uint64(2) + np.uint64(0x9E3779B97F4A7C15)
    return int(mix(np.array([(mix(s) * odd).sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64)).astype(np.int64)[0])


def signature(s: np.ndarray, bits: int = SIGN_BITS) -> np.ndarray:
    """For each slot the parity of the set's shingles in it: signatures differ in no more bits than their sets in shingles."""
    odd = np.bincount((mix(s) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def differing(signs: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """In how many bits the signatures of rows p and q differ."""
    out = np.zeros(len(p), np.int64)
    for k in range(0, len(p), SIGN_PAIRS):
        s = slice(k, k + SIGN_PAIRS)
        out[s] = np.bitwise_count(signs[p[s]] ^ signs[q[s]]).sum(axis=1, dtype=np.int64)
    return out


def _sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, np.ndarray]]:
    data, offsets = text_buffer(batch["text"])
    for first, _, block, at in blocks(data, offsets):
        for k, s in enumerate(shingle_sets(block, at, words)):
            yield first + k, s


def _sampled(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted():
            u, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch([pa.array(u.view(np.int64)), pa.array(c.astype(np.int64))], names=["shingle", "n"])

        for batch in batches:
            for _, s in _sets(batch, words):
                if len(s):
                    held.append(s[mix(s ^ np.int64(set_hash(s)).view(np.uint64)) % np.uint64(SAMPLED) == 0])
                    size += held[-1].nbytes + 100
                    if size > FLUSH_BYTES:
                        yield counted()
                        held, size = [], 0
        if held:
            yield counted()

    return run


def frequent_shingles(docs: DataFrame, words: int = WORDS) -> list[np.ndarray]:
    """The tiers' filters. They only shape the order: an estimate will do, but it is the same however the rows are dealt."""
    found = stored(docs.select("text").mapInArrow(lean(_sampled(words)), "shingle long, n long").groupBy("shingle").agg((F.sum("n") * SAMPLED).alias("n")).where(F.col("n") >= TIERS[0]))
    slot = F.col("shingle").bitwiseAND(F.lit(TIER_SLOTS - 1))
    filters = [slot_filter(found.where(F.col("n") >= least), slot, TIER_SLOTS) for least in TIERS]
    discard(found)
    return filters


def low_bits(keys: np.ndarray, slots: int) -> np.ndarray:
    """Where `slot_filter` keeps the bit of the low bits of these keys."""
    slot = (keys & keys.dtype.type(slots - 1)).astype(np.int64)
    return np.where(slot > 0, slot - 1, np.int64(slots))


def tiers_of(filters: list[np.ndarray], shingles: np.ndarray) -> np.ndarray:
    """The highest tier that a shingle seems to belong to, 0 for none."""
    at = low_bits(shingles, TIER_SLOTS)
    out = np.zeros(len(shingles), np.int8)
    for k, bits in enumerate(filters):
        out[in_filter(bits, at)] = k + 1
    return out


def _index_blobs(frequent, words: int, percent: int, buckets: int, long: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members: list[tuple[int, int, int]] = []
        held: list[tuple[np.ndarray, int, int]] = []
        signs: dict[int, list[tuple[int, np.ndarray]]] = {2: [], 3: []}
        seen: set[int] = set()
        size = 0

        def packed():
            out = []
            if members:
                doc, name, n = (np.array(x) for x in zip(*members, strict=True))
                out += bucketed_blobs(0, mix(name.astype(np.int64).view(np.uint64)), [doc.astype("<i8"), name.astype("<i8"), n.astype("<i4")], buckets)
            if held:
                key = np.concatenate([h[0] for h in held])
                length = np.array([len(h[0]) for h in held])
                at = np.arange(len(key)) - np.repeat(np.cumsum(length) - length, length)
                name, n = np.repeat([h[1] for h in held], length), np.repeat([h[2] for h in held], length)
                hot = tiers_of(frequent.value, key) > 0
                deal = np.where(hot, mix(key ^ name.astype(np.int64).view(np.uint64)), mix(key))  # frequent ones lie anywhere
                out += bucketed_blobs(1, deal, [key, name.astype("<i8"), n.astype("<i4"), at.astype("<i4")], buckets)
            for kind in (k for k in signs if signs[k]):
                name = np.array([s[0] for s in signs[kind]])
                out += bucketed_blobs(kind, mix(name.astype(np.int64).view(np.uint64)), [name.astype("<i8"), np.stack([s[1] for s in signs[kind]]).view(ENTRY[kind][1]).ravel()], buckets)
            return blob_batch(out)

        for batch in batches:
            ids = batch["doc_id"].to_numpy(zero_copy_only=False)
            for row, s in _sets(batch, words):
                name = set_hash(s)
                members.append((int(ids[row]), name, len(s)))
                size += 20
                if len(s) and name not in seen:
                    seen.add(name)
                    p = prefix_length(len(s), percent)
                    tier = tiers_of(frequent.value, s)
                    if tier.any():
                        s = s[np.argsort(tier, kind="stable")]
                    signs[2].append((name, signature(s)))
                    if len(s) > long:
                        signs[3].append((name, signature(s, WIDE_BITS)))
                        size += WIDE_BITS // 8
                    held.append((s[:p].copy(), name, len(s)))
                    size += 24 * p + SIGN_BITS // 8
                if size > FLUSH_BYTES:
                    yield packed()
                    members, held, signs, size, seen = [], [], {2: [], 3: []}, 0, set()
        if members:
            yield packed()

    return run


INDEX_SCHEMA = "kind int, doc_id long, name long, n int, shingle long, pos int, sign binary"


def _index_rows(frequent):
    def rows(kind: int, doc, name, n, shingle, pos, sign=None) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(name), 1 << 16):
            s = slice(k, k + (1 << 16))
            m = len(name[s])
            of = lambda x, t: pa.nulls(m, t) if x is None else pa.array(x[s], t)
            binary = pa.nulls(m, pa.binary()) if sign is None else pa.array([x.tobytes() for x in sign[s]], pa.binary())
            yield pa.record_batch([pa.array(np.full(m, kind, np.int32)), of(doc, pa.int64()), of(name, pa.int64()), of(n, pa.int32()), of(shingle, pa.int64()), of(pos, pa.int32()), binary], names=["kind", "doc_id", "name", "n", "shingle", "pos", "sign"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in gather_blobs(batches, ENTRY):
            doc, name, n = found[0]
            yield from rows(0, doc, name, n, None, None)
            for kind in (2, 3):
                name, sign = found[kind]
                _, own = np.unique(name, return_index=True)
                yield from rows(kind, None, name[own], None, None, None, sign[own])
            key, name, n, pos = found[1]
            if not len(key):
                continue
            order = np.lexsort((name, key))
            key, name, n, pos = key[order], name[order], n[order], pos[order]
            own = np.ones(len(key), bool)
            own[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
            key, name, n, pos = key[own], name[own], n[own], pos[own]
            same = key[1:] == key[:-1]
            keep = np.zeros(len(key), bool)
            keep[1:] |= same
            keep[:-1] |= same
            keep |= tiers_of(frequent.value, key) > 0
            yield from rows(1, None, name[keep], n[keep], key[keep].view(np.int64), pos[keep])

    return run


def _enough(percent: int):
    """Whether so many shared prefix shingles leave a pair possible: beyond the shorter-reaching prefix at most its set's rest is shared."""
    rest = lambda n: f"({n} - ({n} - cast(ceil({percent} * {n} / 100.0 - 1e-9) as int) + 1))"
    need = f"cast(ceil({percent} * (na + nb) / {100 + percent}.0 - 1e-9) as int)"
    return F.expr(f"least(na, nb) * 100 >= {percent} * greatest(na, nb) and shared + greatest({rest('na')}, {rest('nb')}) >= {need}")


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a.astype(np.int64).view(np.uint64)) + b.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Nearest:
    """For each component the nearest pair that leads out of it, of all pairs told so far."""

    def __init__(self):
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, comp_a, comp_b, apart, *pair) -> None:
        self.held.append((np.concatenate([comp_a, comp_b]), *(np.tile(x, 2) for x in (apart, *pair))))
        self.size += 96 * len(apart)
        if self.size > FLUSH_BYTES:
            best = self.best()
            self.held, self.size = [best], min(48 * len(best[0]), FLUSH_BYTES // 2)

    def best(self) -> tuple[np.ndarray, ...]:
        comp, apart, a, b, na, nb = (np.concatenate(x) for x in zip(*self.held, strict=True))
        order = np.lexsort((b, a, apart, comp))
        order = order[np.r_[True, comp[order][1:] != comp[order][:-1]]]
        return tuple(x[order] for x in (comp, apart, a, b, na, nb))


def _list_pairs(percent: int, refused=None):
    """Pairs of sets of different components that share a list and that no bound rules out.

    Of the pairs' shared shingles the first in the order brings them together, so places far from the begin are enough to
    rule a pair out in a list. With `refused` (a filter of pairs answered no) lists with signatures give for each component of
    this task its nearest pair alone that the filter does not know; without it, all pairs.
    """

    def lists(batches):
        parts = [[batch[c].to_numpy(zero_copy_only=False) for c in ("shingle", "left", "right", "own", "name", "n", "pos", "component")] + [batch["sign"].to_numpy(zero_copy_only=False)] for batch in batches if batch.num_rows]
        if not parts:
            return
        key, left, right, own, name, n, pos, comp, sign = (np.concatenate(x) for x in zip(*parts, strict=True))
        parts.clear()
        order = np.lexsort((pos, right, left, key))
        key, left, right, own, name, n, pos, comp, sign = (x[order] for x in (key, left, right, own, name, n, pos, comp, sign))
        new = (key[1:] != key[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])
        cuts = np.r_[0, np.flatnonzero(new) + 1, len(key)]
        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if j - i > 1:
                signs = None if sign[i] is None else np.frombuffer(b"".join(sign[i:j]), np.uint64).reshape(j - i, -1)
                yield left[i], right[i], own[i:j], name[i:j], n[i:j].astype(np.int64), pos[i:j].astype(np.int64), comp[i:j], signs

    def flushed(held):
        a, b, na, nb = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((b, a))
        a, b, na, nb = a[order], b[order], na[order], nb[order]
        cut = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        return pa.record_batch([pa.array(x[cut]) for x in (a, b, na, nb)], names=["a", "b", "na", "nb"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, nearest = [], 0, Nearest()
        for left, right, own, name, n, pos, comp, signs in lists(batches):
            longest = int(n.max())
            for i in range(0, len(name), SKIP):
                x = slice(i, i + SKIP)
                # a partner further on by more positions than either set may lack is out of reach
                reach = int(np.searchsorted(pos, pos[x][-1] + longest * (100 - percent) // 100 + 1, side="right"))
                y = slice(i, reach)
                na, nb = n[x][:, None], n[y][None, :]
                ok = comp[x][:, None] != comp[y][None, :]
                ok &= np.minimum(na - pos[x][:, None], nb - pos[y][None, :]) >= needed(na, nb, percent)
                ok &= np.arange(reach - i)[None, :] > np.arange(len(n[x]))[:, None]
                if left != right:
                    ok &= own[x][:, None] != own[y][None, :]
                p, q = np.nonzero(ok)
                p, q = p + i, q + i
                if signs is not None and len(p):
                    apart = differing(signs, p, q)
                    near = apart <= n[p] + n[q] - 2 * needed(n[p], n[q], percent)
                    p, q, apart = p[near], q[near], apart[near]
                if not len(p):
                    continue
                swap = name[p] > name[q]
                p, q = np.where(swap, q, p), np.where(swap, p, q)
                pair = (name[p], name[q], n[p], n[q])
                if signs is not None and refused is not None:
                    new = ~in_filter(refused.value, low_bits(pair_key(*pair[:2]), ANSWERED_SLOTS))
                    if new.any():
                        nearest.add(comp[p][new], comp[q][new], apart[new], *(x[new] for x in pair))
                else:
                    held.append(pair)
                    size += 32 * len(p)
                if size > FLUSH_BYTES:
                    yield flushed(held)
                    held, size = [], 0
        if nearest.held:
            held.append(nearest.best()[2:])
        if held:
            yield flushed(held)

    return run


def _doc_sets(bits, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch if bits is None else batch.filter(pa.array(in_filter(bits.value, batch["slot"].to_numpy(zero_copy_only=False).astype(np.int64))))
            ids = rows["doc_id"].to_pylist()
            out = [(ids[k], set_hash(s), s.tobytes()) for k, s in _sets(rows, words)]
            if out:
                yield pa.record_batch([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.binary())], names=["doc_id", "name", "shingles"])

    return run


def _near(percent: int):
    """The pairs whose signatures let them link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sign = [np.frombuffer(b"".join(batch[c].to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in ("sign_a", "sign_b")]
                na, nb = (batch[c].to_numpy().astype(np.int64) for c in ("na", "nb"))
                good = np.bitwise_count(sign[0] ^ sign[1]).sum(axis=1, dtype=np.int64) <= na + nb - 2 * needed(na, nb, percent)
                yield batch.filter(pa.array(good)).select(["a", "b", "na", "nb"])

    return run


#: Bytes of sets that are held at a time to answer pairs; two larger sets make a chunk of their own.
CHUNK_BYTES = 4 << 20


def _numbered(*columns: np.ndarray) -> Iterator[tuple[int, ...]]:
    """Each row's number and values, of few rows at a time: Python's numbers take five times the room."""
    for k in range(0, len(columns[0]), 1 << 13):
        s = slice(k, k + (1 << 13))
        yield from zip(range(k, k + len(columns[0][s])), *(c[s].tolist() for c in columns), strict=True)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Deals a task's pairs to chunks: pairs that sets connect meet in one, as far as CHUNK_BYTES go, so that a set is sent few times."""
    parts = [[batch[c].to_numpy().astype(np.int64) for c in ("a", "b", "na", "nb")] for batch in batches if batch.num_rows]
    if not parts:
        return
    a, b, na, nb = (np.concatenate(x) for x in zip(*parts, strict=True))
    names, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = local_components(len(names), flat[: len(a)], flat[len(a) :])[flat[: len(a)]]
    order = np.lexsort((b, a, label))
    a, b, na, nb, label = a[order], b[order], na[order], nb[order], label[order]
    new = np.r_[True, label[1:] != label[:-1]]
    held, size = set(), 0
    for k, x, y, nx, ny in _numbered(a, b, na, nb):
        more = 8 * (nx * (x not in held) + ny * (y not in held))
        if new[k] or size + more > CHUNK_BYTES:
            new[k], held, size, more = True, set(), 0, 8 * (nx + ny)
        held |= {x, y}
        size += more
    first = np.flatnonzero(new)
    chunk = pair_key(a[first], b[first]).view(np.int64)[np.cumsum(new) - 1]
    for k in range(0, len(a), 1 << 16):
        s = slice(k, k + (1 << 16))
        yield pa.record_batch([pa.array(x[s]) for x in (chunk, a, b, na, nb)], names=["chunk", "a", "b", "na", "nb"])


def _far(percent: int):
    """Which pairs of long sets the wide signatures rule out. Of a chunk come the signatures (b null), then the pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, signs = None, {}
        for batch in batches:
            told = []
            for chunk, a, b, na, nb, sign in zip(*(batch[c].to_pylist() for c in ("chunk", "a", "b", "na", "nb")), batch["sign"], strict=True):
                if chunk != now:
                    now, signs = chunk, {}
                if b is None:
                    signs[a] = np.frombuffer(sign.as_buffer(), np.uint64)
                    continue
                apart = int(np.bitwise_count(signs[a] ^ signs[b]).sum(dtype=np.int64))
                told.append((a, b, na, nb, apart > na + nb - 2 * needed(na, nb, percent)))
            if told:
                a, b, na, nb, far = (np.array(x) for x in zip(*told, strict=True))
                slot = (pair_key(a, b) & np.uint64(ANSWERED_SLOTS - 1)).astype(np.int64)
                yield pa.record_batch([pa.array(x) for x in (a, b, na, nb, slot, far)], names=["a", "b", "na", "nb", "slot", "far"])

    return run


def _verify(percent: int):
    """Each pair's answer from the whole sets, with the low bits of the pair's key. Of a chunk come the sets (b null), then the pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sets = None, {}
        for batch in batches:
            asked = []
            for chunk, a, b, shingles in zip(batch["chunk"].to_pylist(), batch["a"].to_pylist(), batch["b"].to_pylist(), batch["shingles"], strict=True):
                if chunk != now:
                    now, sets = chunk, {}
                if b is None:
                    sets[a] = np.frombuffer(shingles.as_buffer(), np.uint64)
                    continue
                both = np.concatenate([sets[a], sets[b]])
                both.sort(kind="stable")
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                asked.append((a, b, 100 * shared >= percent * (len(both) - shared)))
            if asked:
                a, b, good = (np.array(x) for x in zip(*asked, strict=True))
                key = pair_key(a, b) & np.uint64(ANSWERED_SLOTS - 1)
                yield pa.record_batch([pa.array(a), pa.array(b), pa.array(key.astype(np.int64)), pa.array(good)], names=["a", "b", "slot", "linked"])

    return run


#: Pairs, and so sets, that are told to all tasks as they are (with a signature 18 MB at most); more of them are shuffled.
FEW = 1 << 16


def told_all(rows: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(rows) if few else rows


class JaccardJoin:
    """The stages of the join over `docs` (doc_id, text); `links` grow as more of the candidates are answered."""

    def __init__(self, docs: DataFrame, words: int, percent: int):
        self.docs, self.words, self.percent, self.spark = docs, words, percent, docs.sparkSession
        bounded_batches(self.spark)
        buckets = 4 * parallelism(self.spark)
        frequent = self.spark.sparkContext.broadcast(frequent_shingles(docs, words))
        blobs = docs.select("doc_id", "text").mapInArrow(lean(_index_blobs(frequent, words, percent, buckets, LONG)), BLOB_SCHEMA)
        rows = stored(by_bucket(blobs).mapInArrow(lean(_index_rows(frequent)), INDEX_SCHEMA))
        frequent.unpersist()
        self.members = rows.where("kind = 0").select("doc_id", "name", "n")
        self.entries = rows.where("kind = 1").select("shingle", "name", "n", "pos")
        self.signs = rows.where("kind = 2").select("name", "sign")
        self.wide = rows.where("kind = 3").select("name", "sign")
        self.holders = stored(self.members.groupBy("name").agg(F.min("doc_id").alias("doc_id")))
        self.n_links = 0
        self.refused: list[DataFrame] = []
        self.links = self.components = self.open = None

    def sets(self, names: DataFrame, few: bool) -> tuple[DataFrame, DataFrame]:
        """(chunk, name, shingles) of the named sets (chunk, name), read again from one text of each, and the stored table it needs.

        A row that repeats an id counts by its own set; rows that repeat an id and its text repeat the set.
        """
        wanted = stored(told_all(names.distinct(), few).join(self.holders, "name"))
        texts = self.docs.select("doc_id", "text")
        if few:
            found = texts.join(F.broadcast(wanted.select("doc_id").distinct()), "doc_id", "left_semi").mapInArrow(lean(_doc_sets(None, self.words)), SETS_SCHEMA)
        else:
            bits = self.spark.sparkContext.broadcast(id_filter(wanted, "doc_id"))
            found = with_slot(texts, "doc_id", "slot").mapInArrow(lean(_doc_sets(bits, self.words)), SETS_SCHEMA)
        return found.join(told_all(wanted, few), ["doc_id", "name"]).select("chunk", "name", "shingles"), wanted

    def learn(self, pairs: DataFrame) -> tuple[int, int]:
        """Answers the pairs (a, b, na, nb) of set names that signatures leave, from the whole sets; how many, and how many of them link."""
        met, count = counted(pairs.groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb")))
        few, linked = count <= FEW, 0
        if count:
            sign = lambda s: self.signs.select(F.col("name").alias(s), F.col("sign").alias(f"sign_{s}"))
            signed = told_all(told_all(met, few).join(sign("a"), "a"), few).join(sign("b"), "b")
            near, count = counted(signed.select("a", "b", F.col("na").cast("long").alias("na"), F.col("nb").cast("long").alias("nb"), "sign_a", "sign_b").mapInArrow(lean(_near(self.percent)), "a long, b long, na long, nb long"))
        left = 0
        if count:
            kept, left, used = self.not_far(near, count)
        if left:
            pairs, names, few = self.dealt(kept, left)
            sets, wanted = self.sets(names, few)
            sets = sets.select("chunk", F.col("name").alias("a"), F.lit(None).cast("long").alias("b"), "shingles")
            both = self.by_chunk(sets, pairs.select("chunk", "a", "b", F.lit(None).cast("binary").alias("shingles")))
            told, linked = counted(both.mapInArrow(lean(_verify(self.percent)), "a long, b long, slot long, linked boolean"), F.sum(F.col("linked").cast("long")))
            discard(pairs, wanted)
            self.refused.append(told.where("not linked").select("a", "b", "slot"))
        if count:
            discard(*used)
        if linked:
            links = told.where("linked").select("a", "b")
            self.links = links if self.links is None else self.links.unionByName(links)
            self.n_links += linked
            self.components = components(self.links, "a", "b", self.n_links).withColumnRenamed("vertex", "name")
        discard(met)
        return count, linked

    def dealt(self, pairs: DataFrame, count: int) -> tuple[DataFrame, DataFrame, bool]:
        """The pairs (a, b, na, nb) with their chunks, stored; (chunk, name) of their sets; whether they are few."""
        pairs = stored((pairs.coalesce(1) if count <= FOREST_EDGES else pairs).mapInArrow(lean(_chunks), "chunk long, a long, b long, na long, nb long"))
        return pairs, pairs.select("chunk", F.col("a").alias("name")).union(pairs.select("chunk", "b")), count <= FEW

    def by_chunk(self, sets: DataFrame, pairs: DataFrame) -> DataFrame:
        """Each chunk's sets (b null), then its pairs."""
        return sets.unionByName(pairs).repartition(parallelism(self.spark), "chunk").sortWithinPartitions("chunk", F.col("b").asc_nulls_first())

    def not_far(self, near: DataFrame, count: int) -> tuple[DataFrame, int, list[DataFrame]]:
        """The pairs (a, b, na, nb) that are left, how many, and the stored tables they are read from: those of two long sets that wide signatures rule out are answered no."""
        long = F.least("na", "nb") > LONG
        asked = near.where(long).count()
        if not asked:
            return near, count, [near]
        pairs, names, few = self.dealt(near.where(long), asked)
        signs = self.wide.join(told_all(names.distinct(), few), "name")
        none = [F.lit(None).cast("long").alias(c) for c in ("b", "na", "nb")]
        both = self.by_chunk(signs.select("chunk", F.col("name").alias("a"), *none, "sign"), pairs.withColumn("sign", F.lit(None).cast("binary")))
        told, far = counted(both.mapInArrow(lean(_far(self.percent)), "a long, b long, na long, nb long, slot long, far boolean"), F.sum(F.col("far").cast("long")))
        discard(pairs)
        self.refused.append(told.where("far").select("a", "b", "slot"))
        return near.where(~long).unionByName(told.where("not far").select("a", "b", "na", "nb")), count - far, [near]

    def with_components(self) -> DataFrame:
        if self.components is None:
            return self.entries.withColumn("component", F.col("name"))
        # only entries that may have a component meet the components; at most a filter of 1 MB tells which
        e = maybe_among(self.entries, "name", self.components, "name")
        met = e.where("maybe").join(self.components, "name", "left").withColumn("component", F.coalesce("component", "name"))
        return e.where("not maybe").withColumn("component", F.col("name")).unionByName(met).drop("maybe")

    def leaders(self) -> None:
        """Each list's sets are compared with a few leaders, the same ones in lists of the same sets.

        Leaders are the first by several hashes of their names. Pairs are at most LEADERS times the entries.
        """
        e = self.with_components()
        lead = lambda k: F.min_by(F.struct("component", "name", "n"), F.xxhash64("name", F.lit(k)))
        leads = e.groupBy("shingle").agg(F.array_distinct(F.array(*[lead(k) for k in range(LEADERS)])).alias("leads"), F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("shingle", "leads")
        met = e.join(leads, "shingle").select("name", "n", "component", F.explode("leads").alias("lead")).where("component <> lead.component")
        low = F.col("name") < F.col("lead.name")
        side = lambda x, y: F.when(low, F.col(x)).otherwise(F.col(y))
        pairs = met.select(side("name", "lead.name").alias("a"), side("lead.name", "name").alias("b"), side("n", "lead.n").alias("na"), side("lead.n", "n").alias("nb"), side("name", "lead.name").eqNullSafe(F.col("name")).alias("way"))
        # a list in which both lead has the pair twice: each way is counted alone
        one = pairs.groupBy("a", "b", "way").agg(F.first("na").alias("na"), F.first("nb").alias("nb"), F.count("*").alias("shared"))
        self.learn(one.where(_enough(self.percent)))

    def lists(self, nearest: bool) -> tuple[int, int]:
        """Pairs from the lists that still hold more than one component: how many were asked, and how many link.

        `nearest`: from long lists the nearest pair out of each component alone, and all pairs from short lists, which have fewer
        than SIGNED / 2 of them an entry and are then done with. Else all pairs that are not yet answered. Lists
        of one component never hold another again, and are left out from here on.
        """
        e = self.with_components()
        size = e.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.ceil(F.count("*") / LIST_BLOCK).cast("int").alias("blocks"), (F.count("*") >= SIGNED).alias("long")).where("low <> high").select("shingle", "blocks", "long")
        e = stored(e.join(size, "shingle"))
        long = e.where("long").join(self.signs, "name")
        told = None
        if nearest:
            told = self.spark.sparkContext.broadcast(slot_filter(self.answered_no().select("slot"), F.col("slot"), ANSWERED_SLOTS))
            long = long.unionByName(e.where("not long").withColumn("sign", F.lit(None).cast("binary")))
        pairs = self.pairs_in(long, told)
        found = self.learn(pairs if nearest else pairs.join(self.answered_no(), ["a", "b"], "left_anti"))
        if self.open:
            discard(self.open)
        self.open, self.entries = e, e.where("long").select("shingle", "name", "n", "pos")
        return found

    def answered_no(self) -> DataFrame:
        out = self.spark.createDataFrame([], "a long, b long, slot long") if not self.refused else self.refused[0]
        for more in self.refused[1:]:
            out = out.unionByName(more)
        return out

    def pairs_in(self, e: DataFrame, refused=None) -> DataFrame:
        """Pairs from the lists of `e`, which hold sign (null: no signatures); long lists are looked at as pairs of blocks."""
        e = e.withColumn("own", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int"))
        e = e.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        e = e.select("shingle", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), "own", "name", "n", "pos", "component", "sign")
        return e.repartition(parallelism(self.spark), "shingle", "left", "right").mapInArrow(lean(_list_pairs(self.percent, refused)), "a long, b long, na long, nb long")


SETS_SCHEMA = "doc_id long, name long, shingles binary"


def jaccard_members(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, name, n, component, component_id) for each row of `docs` (doc_id, text) with an id; `name` stands for the row's set."""
    join = JaccardJoin(docs.where("doc_id is not null"), words, percent)
    join.leaders()
    for _ in range(NEAREST):
        asked, linked = join.lists(True)
        if WORTH * linked <= asked:
            break
    if asked:
        join.lists(False)
    empty = join.members.where("name = 0").select("doc_id", "name", "n", F.col("name").alias("component"), F.col("doc_id").alias("component_id"))
    real = join.members.where("name <> 0")
    sets = join.holders.withColumn("component", F.col("name")) if join.components is None else join.holders.join(join.components, "name", "left").withColumn("component", F.coalesce("component", "name"))
    first = sets.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = sets.join(first, "component").select("name", "component", "component_id")
    return real.join(named, "name").select("doc_id", "name", "n", "component", "component_id").unionByName(empty)


def jaccard_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id.

    Sets are the distinct shingles of `words` words, A-Z lower-cased; a text of fewer words has its whole
    sequence, one without words (or null) none and links with nothing. Sets link when their Jaccard similarity is
    at least `percent` / 100. component_id is the smallest id reachable by links, its own included.

    Equal sets are one set. First the pairs of each list with its leaders are answered; sets linked by then
    share their answers. Short lists are then answered pair by pair. In long ones each component asks, for a few
    rounds, for its nearest outside set by signature (Boruvka's way to join components), as all other pairs of two
    components are answered with the first one that links. The last round answers all pairs of
    different components that are left, so none is missed. Pairs are answered by the whole sets. Null ids: size only, component
    null, and they link nothing. Rows that repeat an id are repeated in the result. Empty table: no rows.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    judged = jaccard_members(rows, words, percent).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")
    lost = rows.where("doc_id is null").mapInArrow(lean(_sizes(words)), "n_shingles long").select(F.lit(None).cast("long").alias("doc_id"), "n_shingles", F.lit(None).cast("long").alias("component_id"))
    return judged.unionByName(lost)


def _sizes(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array([len(s) for _, s in _sets(batch, words)], pa.int64())], names=["n_shingles"])

    return run


def _named(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [set_hash(s) for _, s in _sets(batch, words)]
            yield pa.record_batch([batch["row"], batch["own"], pa.array(names, pa.int64())], names=["row", "own", "name"])

    return run


def first_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Of each component of `docs` one row, that of the smallest id, all columns as they are.

    Each row follows its own text's set, also where ids repeat. Of rows of the smallest id in a component (repeated
    rows) the one of the smallest text by code point, then by a hash of the row, stays. Rows without words and rows of null
    ids link with nothing and stay. Only rows whose id may be in a group of two or more (a filter of 1 MB tells) are named
    again, reduced to one for each component within each task, and shuffled; all others pass straight through.
    """
    members = jaccard_members(docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")), words, percent).where("name <> 0")
    members = stored(members.select("doc_id", "name", "component"))
    groups = members.groupBy("component").count().where("count > 1").select("component")
    grouped = stored(members.join(groups, "component").distinct())
    rows = docs.select(whole_rows(docs).alias("row"), F.col(f"`{doc_id}`").cast("long").alias("own"))
    rows = maybe_among(rows, "own", grouped, "doc_id")
    schema = StructType([StructField("row", rows.schema["row"].dataType), StructField("own", LongType()), StructField("name", LongType())])
    named = rows.where("maybe and own is not null").withColumn("text", F.col("row").getField(text)).select("row", "own", "text").mapInArrow(lean(_named(words)), schema)
    met = named.join(grouped.withColumnRenamed("doc_id", "own"), ["own", "name"], "left")
    best = met.where("component is not null").groupBy("component").agg(F.min_by("row", row_order(docs, F.col("own"), F.col("row").getField(text))).alias("row"))
    parts = [rows.where("own is null or not maybe"), met.where("component is null"), best]
    return parts[0].select("row").unionByName(parts[1].select("row")).unionByName(parts[2].select("row")).select("row.*")
