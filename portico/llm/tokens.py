"""Tokens of texts as hashes: runs of letters and digits, and runs of other signs."""

from __future__ import annotations

import numpy as np

from .hashing import LOWER, SEPARATOR, mix, span_hashes

#: 0 between tokens, 1 letters, digits and all beyond ASCII, 2 other signs.
KIND = np.full(256, 2, np.uint8)
KIND[SEPARATOR] = 0
KIND[48:58] = KIND[65:91] = KIND[97:123] = KIND[128:] = 1


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and kinds (1 or 2) of all tokens, and each row's first token (one more entry at the end)."""
    kind = KIND[data]
    cut = np.ones(len(data) + 1, bool)
    cut[1:-1] = kind[1:] != kind[:-1]
    cut[offsets] = True
    edges = np.flatnonzero(cut)
    starts, ends = edges[:-1], edges[1:]
    kinds = kind[starts] if len(starts) else np.zeros(0, np.uint8)
    real = kinds > 0
    starts, ends, kinds = starts[real], ends[real], kinds[real]
    return starts, ends, kinds, np.searchsorted(starts, offsets, side="left")


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (tokens of kind 1, A-Z lower-cased) and each row's first word (one more entry at the end)."""
    low = LOWER[data]
    starts, ends, kinds, _ = tokens(low, offsets)
    real = kinds == 1
    starts, ends = starts[real], ends[real]
    return span_hashes(low, starts, ends), np.searchsorted(starts, offsets, side="left")


def style_grams(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of each row's n-grams, all in a row, and the row of each.

    Unigrams are the tokens as they are. Bigrams are of signs as they are and of words by their look: small,
    capitalised or all capitals, and whether the word before is the same.
    """
    starts, ends, kinds, first = tokens(data, offsets)
    own = span_hashes(data, starts, ends)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    caps = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
    small = np.concatenate([[0], np.cumsum((data >= 97) & (data <= 122))])
    big, little = caps[ends] - caps[starts], small[ends] - small[starts]
    look = np.where(big == 0, 0, np.where(little == 0, 2, 1)).astype(np.uint64)
    same = np.zeros(len(own), bool)
    same[1:] = (own[1:] == own[:-1]) & (row[1:] == row[:-1])
    shape = np.where(kinds == 1, look + np.uint64(4) * same.astype(np.uint64), own)
    next_ = (row[1:] == row[:-1]) if len(row) else np.zeros(0, bool)
    pair = mix(shape[:-1] * np.uint64(0x9E3779B97F4A7C15) + mix(shape[1:]))[next_] if len(row) else own
    half = np.uint64(buckets // 2)
    grams = np.concatenate([own % half, pair % half + half]).astype(np.int64)
    return grams, np.concatenate([row, row[1:][next_]]) if len(row) else row
