"""Words and word shingles of a batch of texts as numpy arrays, for Python tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words (runs of other than ASCII white space) in order, and each word's text number."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    real = pc.greater(pc.binary_length(flat), 0)  # leading and trailing space gives empty words
    return flat.filter(real), owner[real.to_numpy(zero_copy_only=False)]


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the output."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word; each different word is hashed once."""
    coded = words.dictionary_encode()
    known = np.fromiter(
        (xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()),
        np.uint64,
        len(coded.dictionary),
    )
    return known[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.uint64)


def windows(hashes: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each ``size`` words in a row of one text, and where each begins."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = mixed(total + hashes[k : k + n] + np.uint64(k + 1))
    at = np.flatnonzero(owner[:n] == owner[size - 1 :])
    return total[at], at


def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sets of word n-grams: (text number, n-gram hash), both sorted, no pair twice.

    A text of fewer words has one n-gram, all its words; a text of no words has none.
    """
    words, owner = words_of(texts)
    hashes = word_hashes(words)
    grams, at = windows(hashes, owner, size)
    owners = owner[at]
    counts = np.bincount(owner, minlength=len(texts))
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        ends = np.cumsum(counts)
        extra = []
        for t in short:
            total = np.zeros(1, np.uint64)
            for h in hashes[ends[t] - counts[t] : ends[t]]:
                total = mixed(total + h + np.uint64(101))
            extra.append(total[0])
        grams = np.concatenate([grams, np.array(extra, np.uint64)])
        owners = np.concatenate([owners, short])
    order = np.lexsort((grams, owners))
    owners, grams = owners[order], grams[order]
    if not len(grams):
        return owners, grams
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owners[1:] != owners[:-1])
    return owners[new], grams[new]
