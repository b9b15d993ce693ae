"""Vectorised hashing of words, shingles and byte windows over Arrow text columns.

Everything here works on flat byte buffers with NumPy; documents never mix: a word or a window
that would cross a document's end does not exist.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; one longer document makes a block of its own.
BLOCK_BYTES = 1 << 20

_MULT = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_INVERSE = pow(_MULT, -1, 1 << 64)

#: Words are runs of anything but space and the controls 9 to 13.
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit integers whose output bits all depend on all input bits."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random-looking 64-bit value for every byte value.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULT))
_tables: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables.get("up", ())) < n:
        size = max(n, 1 << 12)
        for name, base in (("up", _MULT), ("down", _INVERSE)):
            table = np.full(size, np.uint64(base))
            table[0] = 1
            _tables[name] = np.multiply.accumulate(table)
    return _tables["up"], _tables["down"]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(at):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def blocks(data: np.ndarray, offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of at most `limit` bytes: first row, row after the last, bytes, offsets."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def _prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums s with s[j] - s[i] = the polynomial of bytes i..j-1 times base^i, and the powers that undo base^i."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
    return sums, down


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A hash of each `width`-byte window of the buffer (those across row ends are for the caller to leave out)."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    sums, down = _prefix_sums(data)
    return mix((sums[width:] - sums[:n]) * down[:n])


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span of bytes, its length included."""
    sums, down = _prefix_sums(data)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the index of its first word (one more entry at the end)."""
    inside = ~SEPARATOR[data]
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    begin, finish = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    finish[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    return starts, ends, np.searchsorted(starts, offsets, side="left")


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """For each row its sorted distinct hashes of `size` successive lower-cased words.

    A row of fewer words has its whole sequence as its one shingle; a row without words has none.
    """
    data = LOWER[data]
    starts, ends, first = words(data, offsets)
    own = span_hashes(data, starts, ends)
    weights = [np.uint64(pow(0xC2B2AE3D27D4EB4F, k, 1 << 64)) for k in range(size)]
    padded = np.concatenate([own, np.zeros(size, np.uint64)])
    whole = np.zeros(len(own), dtype=np.uint64)
    for k in range(size):
        whole += padded[k : k + len(own)] * weights[k]
    whole = mix(whole + np.uint64(size))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(whole[a : b - size + 1]))
        elif b > a:
            total = sum(int(h) * int(w) for h, w in zip(own[a:b], weights, strict=False)) + b - a
            out.append(mix(np.array([total & _MASK], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
