"""Packing token sequences into windows by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, lean

CAPACITY = 1024
END = 0
#: Windows that are balanced together, free tokens that each is to keep for the balance, longest piece of a document's rest.
WINDOWS, SLACK, PIECE = 64, 4, 384
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def tokenizer_path() -> str:
    """The public byte-level vocabulary of the queries; any other tokenizers file can be given instead."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_characters() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 as itself and the other bytes as code points from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Encoder:
    """Ids of a byte-level tokenizers file, without its special tokens.

    Merges run in tiktoken on the file's own vocabulary, five times as fast with the same ids; texts that hold an
    added token's text go through tokenizers itself, as do files that are not plain byte-level BPE.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.fast = None
        pre = spec.get("pre_tokenizer") or {}
        if spec["model"].get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer"):
            import tiktoken

            of = _byte_characters()
            added = set(self.added)
            ranks = {bytes(of[c] for c in token): n for token, n in spec["model"]["vocab"].items() if token not in added}
            pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            self.fast = tiktoken.Encoding("portico", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is None or any(a in text for a in self.added):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return self.fast.encode_to_numpy(text, disallowed_special=())


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Items dealt into `windows` lists of near-equal total: multiway differencing.

    Each item begins as a partial partition of its own. Again and again the two partitions of greatest spread
    merge, the fullest windows of one with the emptiest of the other, until one is left. A partition lists its
    windows in use, fullest first; those not listed are empty.
    """
    heap = [(-s, k, [s], [(k,)]) for k, s in enumerate(sizes)]
    heapq.heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        _, _, a, x = heapq.heappop(heap)
        _, _, b, y = heapq.heappop(heap)
        over = len(a) + len(b) - windows
        if over > 0:
            free = len(a) - over
            a, x = a[:free] + [p + q for p, q in zip(a[free:], reversed(b[-over:]), strict=True)] + b[: len(b) - over], x[:free] + [(p, q) for p, q in zip(x[free:], reversed(y[-over:]), strict=True)] + y[: len(y) - over]
        else:
            a, x = a + b, x + y
        order = sorted(range(len(a)), key=a.__getitem__, reverse=True)
        a, x = [a[k] for k in order], [x[k] for k in order]
        heapq.heappush(heap, (-(a[0] - (a[-1] if len(a) == windows else 0)), count, a, x))
        count += 1
    out: list[list[int]] = []
    for tree in heap[0][3] if heap else []:
        items, todo = [], [tree]
        while todo:
            t = todo.pop()
            if isinstance(t, int):
                items.append(t)
            else:
                todo.extend(t)
        out.append(items)
    return out


def balanced(sizes: list[int], capacity: int) -> list[list[int]]:
    """As few windows as differencing fills within the capacity: one more whenever a window would be too full."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        dealt = difference(sizes, windows)
        if all(sum(sizes[k] for k in w) <= capacity for w in dealt):
            return dealt
        windows += 1


class _Packer:
    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next, self.pool, self.held, self.rows = capacity, first_id, [], 0, []

    def emit(self, window: list[tuple]) -> None:
        at = 0
        for doc, start, ids, total in window:
            self.rows.append((doc, start, len(ids), ids.tobytes(), total, self.next, at))
            at += len(ids)
        self.next += 1

    def add(self, doc, ids: np.ndarray) -> None:
        full = len(ids) // self.capacity * self.capacity
        for k in range(0, full, self.capacity):
            self.emit([(doc, k, ids[k : k + self.capacity], len(ids))])
        most = WINDOWS * (self.capacity - SLACK)
        at = full
        while at < len(ids):
            step = min(PIECE, len(ids) - at, most - self.held)
            self.pool.append((doc, at, ids[at : at + step], len(ids)))
            self.held += step
            at += step
            if self.held == most:
                self.flush()

    def flush(self) -> None:
        for window in balanced([len(p[2]) for p in self.pool], self.capacity) if self.pool else []:
            self.emit([self.pool[k] for k in window])
        self.pool, self.held = [], 0

    def batch(self) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        columns = list(zip(*self.rows, strict=True)) if self.rows else [[]] * len(kinds)
        self.rows = []
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])


def _pack(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        task = TaskContext.get()
        packer = _Packer(capacity, (task.partitionId() if task else 0) << 33)
        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                packer.add(doc, np.append(encode(text.as_py() or ""), np.uint32(END)).astype("<u4", copy=False))
                if len(packer.rows) > 4096:
                    yield packer.batch()
        packer.flush()
        yield packer.batch()

    return run


def pack(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece of a document: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    A document's ids are its tokens and one END; `ids` holds a piece's ids as little-endian unsigned 32-bit
    integers. Full windows are cut off a document first. What is left, cut to PIECE tokens at most, meets the rest
    of its neighbours in the same task: WINDOWS windows at a time are balanced by differencing, with SLACK free
    tokens each on average, and one more window is opened whenever one would be too full. Nothing is shuffled; a
    task holds one such pool. sequence_id is the task's partition number times 2^33 plus a running number.

    Null text counts as empty (one END). Null and repeated ids: each row is a document of its own, told apart by
    its pieces' sequences only. Empty table: no rows.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(lean(_pack(tokenizer or tokenizer_path(), capacity)), SCHEMA)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids instead of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
