"""Word shingles, MinHash signatures and exact Jaccard counts, in numpy.  Used inside tasks, on one Arrow batch at a time."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import xxhash

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Shingles hashed at a time: few enough to stay in the cache.
CHUNK = 1 << 15


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a number of words."""

    most = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: bytes | None, n: int, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct hashes of the text's runs of n words; of all its words if they are fewer; empty if none."""
    words = text.split() if text else []  # bytes.split() parts at ASCII white space
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(n, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = out * MULTIPLIER + h[i : len(h) - k + 1 + i]
    return np.unique(mixed(out))


def chance(similarity: float, bands: int, rows: int) -> float:
    """That a pair of this similarity meets in a band."""
    return 1 - (1 - similarity**rows) ** bands


def bands_for(threshold: float, recall: float, most_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows) that find a pair at the threshold with this recall: as many rows as the hashes allow."""
    for rows in range(12, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most_hashes:
            return bands, rows
    raise ValueError("too few hashes for this recall")


def band_hashes(sets: list[np.ndarray], bands: int, rows: int, seed: int = 1) -> np.ndarray:
    """(len(sets), bands) of int64.  No set may be empty."""
    odd = np.random.default_rng(seed).integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.empty((bands * rows, len(sets)), np.uint64)
    at = 0
    while at < len(sets):
        end, total = at + 1, len(sets[at])
        while end < len(sets) and total + len(sets[end]) <= CHUNK:
            total += len(sets[end])
            end += 1
        flat = np.concatenate(sets[at:end])
        starts = np.cumsum([0, *map(len, sets[at : end - 1])])
        for k, a in enumerate(odd):
            least[k, at:end] = np.minimum.reduceat(flat * a, starts)
        at = end
    out = np.empty((len(sets), bands), np.int64)
    for b in range(bands):
        key = np.full(len(sets), b + 1, np.uint64)
        for k in range(b * rows, (b + 1) * rows):
            key = mixed(key * MULTIPLIER + least[k])
        out[:, b] = key.view(np.int64)
    return out


def shared_counts(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """(m, m): how many elements each two sets share.  A product of 0/1 matrices, some columns at a time."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = times[column] > 1  # what only one set holds is never shared
    owner, column = owner[common], column[common]
    column = np.unique(column, return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((m, m), np.float32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        a, b = np.searchsorted(column, [low, low + columns])
        part = np.zeros((m, columns), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        out += part @ part.T
    return out


def similar(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """(m, m) of bool: Jaccard similarity of at least the threshold, in whole numbers; False on the diagonal."""
    size = np.array([len(s) for s in sets], np.float64)
    if len(sets) == 2:
        shared = np.array([[0, n := len(np.intersect1d(*sets, assume_unique=True))], [n, 0]], np.float64)
    else:
        shared = shared_counts(sets).astype(np.float64)
    out = shared >= threshold * (size[:, None] + size[None, :] - shared) - 1e-9
    np.fill_diagonal(out, False)
    return out


def least_reachable(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric link matrix, the least index that it can reach."""
    label = np.arange(len(linked))
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], len(linked)).min(axis=1))
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def runs(batches: Iterator, key_columns: int) -> Iterator[list[tuple]]:
    """Rows of sorted Arrow batches, gathered by their first columns."""
    group: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if group and row[:key_columns] != group[0][:key_columns]:
                yield group
                group = []
            group.append(row)
    if group:
        yield group
