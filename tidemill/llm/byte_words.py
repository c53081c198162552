"""Words of a batch of texts by classes of bytes, for Python tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

IN_WORD, SPACE, BREAK = 0, 1, 2

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_classes(spaces: bytes, breaks: bytes = b"") -> np.ndarray:
    """The class of each byte; all bytes of other characters are in words."""
    kinds = np.full(256, IN_WORD, np.uint8)
    kinds[list(spaces)] = SPACE
    kinds[list(breaks)] = BREAK
    return kinds


def byte_words(texts: pa.Array, kinds: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words in order with A-Z lower-cased, each word's text number, whether it follows the word before).

    A word is a longest run of bytes of class IN_WORD within a text. It follows the word before if both
    are of one text without a byte of class BREAK between them. Texts must not be null.
    """
    n = len(texts)
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    if bounds[-1] == bounds[0]:
        return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, bool)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    inside = kinds[data] == IN_WORD
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    full = np.flatnonzero(np.diff(bounds))  # texts with bytes
    begin[bounds[full]] = inside[bounds[full]]
    end[bounds[full + 1] - 1] = inside[bounds[full + 1] - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    owner = np.searchsorted(bounds[1:], starts, side="right")
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    letters = _LOWER[data[inside]]
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters))
    follows = np.zeros(len(starts), bool)
    follows[1:] = owner[1:] == owner[:-1]
    if (kinds == BREAK).any():
        part = np.searchsorted(np.flatnonzero(kinds[data] == BREAK), starts)
        follows[1:] &= part[1:] == part[:-1]
    return words, owner, follows
