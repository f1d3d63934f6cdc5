"""Word-shingle sets of whole texts as 64-bit hashes, computed on flat byte arrays.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D after lower-casing A-Z. A text's set
holds its distinct 5-word shingles; with one to four words the whole sequence; without words nothing.
"""

from __future__ import annotations

import numpy as np

from seqloom.llm.common import byte_table, mix64, powers

WIDTH = 5
_P = 0x9E3779B97F4A7C15 | 1
_Q = 0xD6E8FEB86659FD93
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_TABLE = byte_table(1)[_LOWER]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, offsets of each text's words)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    word = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLE[data] * powers(_P, n), out=total[1:])
    back = powers(pow(_P, -1, 2**64), n)
    hashes = (total[ends] - total[starts]) * back[starts]
    return mix64(hashes + (ends - starts).astype(np.uint64)), np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes, text after text; offsets of each text's set)."""
    words, at = word_hashes(data, offsets)
    texts = len(offsets) - 1
    counts = np.diff(at)
    n = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    out = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    flat = np.zeros(out[-1], np.uint64)
    if len(words) >= width:
        rolled = np.zeros(len(words) - width + 1, np.uint64)
        for t in range(width):
            rolled = rolled * np.uint64(_Q) + words[t : t + len(rolled)]
        rolled = mix64(rolled)
    for i in range(texts):
        a, b = out[i], out[i + 1]
        if counts[i] >= width:
            part = rolled[at[i] : at[i] + n[i]]
            flat[a:b] = np.sort(part)
        elif counts[i]:
            h = np.uint64(int(counts[i]))
            for w in words[at[i] : at[i + 1]]:
                h = np.uint64((int(h) * _Q + int(w)) % 2**64)
            flat[a:b] = mix64(np.array([h]))
    if not len(flat):
        return flat, out
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    firsts = out[:-1][n > 0]
    new[firsts] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    return flat[new], kept[out]
