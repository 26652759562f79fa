"""Word shingle hashing inside Arrow batches, shared by the operators on near-equal texts."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash

WORD = re.compile(r"[a-z0-9_]+")
HASH_BITS = 44
MASK = np.uint64((1 << HASH_BITS) - 1)


class WordHashes(dict):
    """word -> 64-bit hash, remembered up to a fixed number of words."""

    LIMIT = 1_000_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def word_hashes(texts: list[str | None], cache: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in one array, and the number of words of each text."""
    flat: list[int] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    get = cache.__getitem__
    for i, text in enumerate(texts):
        if text:
            words = WORD.findall(text.lower())
            counts[i] = len(words)
            flat.extend(map(get, words))
    return np.array(flat, dtype=np.uint64), counts


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def windows(flat: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number and word position of every run of `width` words."""
    n = len(flat)
    owner = np.repeat(np.arange(len(counts)), counts)
    if n < width:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    with np.errstate(over="ignore"):
        h = np.zeros(n - width + 1, dtype=np.uint64)
        for k in range(width):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + flat[k : n - width + 1 + k])
    same = owner[: n - width + 1] == owner[width - 1 :]
    at = np.arange(n - width + 1) - first[owner[: n - width + 1]]
    return h[same] & MASK, owner[: n - width + 1][same], at[same]


def shingle_batches(width: int):
    """mapInArrow body: (id, text) -> (id, n, hs), hs the sorted distinct shingle hashes."""

    def run(batches):
        cache = WordHashes()
        for batch in batches:
            ids = batch.column(0)
            flat, counts = word_hashes(batch.column(1).to_pylist(), cache)
            h, owner, _ = windows(flat, counts, width)
            order = np.lexsort((h, owner))
            h, owner = h[order], owner[order]
            if len(h):
                keep = np.concatenate(([True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])))
                h, owner = h[keep], owner[keep]
            n = np.bincount(owner, minlength=len(counts)).astype(np.int32)
            offsets = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(h.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([ids, pa.array(n), lists], names=["id", "n", "hs"])

    return run
