"""Words and word shingles of whole texts as 64-bit hashes, in Arrow batches.

A word is a run of characters outside ``[\\x20\\x09-\\x0D]``. Hashes are the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in slices of about so many bytes; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(start, stop) of consecutive rows with at most ``limit`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > limit:
            yield start, i
            start, held = i, 0
        held += int(n)
    if len(sizes) > start:
        yield start, len(sizes)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words one after another, and where each text's words begin (one more entry than texts)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, ends = lists.flatten(), lists.offsets.to_numpy()
    real = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(real)])[ends - ends[0]]
    return words.filter(pa.array(real)), ends.astype(np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def constants(seed: int, n: int) -> np.ndarray:
    """``n`` odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def word_hashes(words: pa.Array) -> np.ndarray:
    coded = words.dictionary_encode()
    own = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False).astype(object), categorize=False)
    return own.astype(np.uint64)[coded.indices.to_numpy()] if len(words) else np.empty(0, np.uint64)


def shingle_sets(texts: pa.Array, size: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its ``size``-word shingles, A-Z lower-cased.

    A text with fewer words gives its whole sequence as one shingle, a text without words (or null)
    an empty set.
    """
    factors = constants(size, size)
    for start, stop in slices(texts):
        words, at = split_words(pc.ascii_lower(texts.slice(start, stop - start)))
        hashed = word_hashes(words)
        full = max(0, len(hashed) - size + 1)
        summed = np.zeros(full, np.uint64)
        for j in range(size):
            summed += hashed[j:j + full] * factors[j]
        summed = mix(summed)
        for a, b in zip(at[:-1], at[1:]):
            n = b - a
            if n >= size:
                yield np.unique(summed[a:b - size + 1])
            elif n:
                yield mix((hashed[a:b] * factors[:n]).sum(dtype=np.uint64, keepdims=True) ^ mix(np.array([n], np.uint64)))
            else:
                yield np.empty(0, np.uint64)
