"""Counting quotient filters of packed n-grams, sorted and without loss, for Python tasks.

An n-gram of word ids below 2**b is a key of n * b bits (128 at most). Keys are permuted invertibly, so that
they spread evenly; the leading bits of a permuted key choose a slice, the next ones are its quotient, and
the rest is kept whole as its remainder. A filter is the bytes of one slice: how many keys each quotient
has (in unary), then remainders and counters in the order of the keys. Filters of one slice merge as sorted
lists do.
"""

from __future__ import annotations

import numpy as np

from .words import mixed

_ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_ROUNDS = 4
_U = np.uint64


def _mask(bits: int) -> np.uint64:
    return _U((1 << bits) - 1)


def top_bits(bits: int) -> int:
    """Of a key of ``bits`` bits, those in its first word; the others are in a second one."""
    return min(bits, 64)


def packed_grams(ids: list[np.ndarray], id_bits: int) -> tuple[np.ndarray, np.ndarray | None]:
    """Keys of n-grams, given the ids of their first, second, ... words: (first 64 bits, rest or None)."""
    bits = len(ids) * id_bits
    assert bits <= 128, "n-grams of more than 128 bits"
    if bits <= 64:
        key = np.zeros(len(ids[0]), _U)
        for x in ids:
            key = key << _U(id_bits) | x.astype(_U)
        return key, None
    high, low = np.zeros(len(ids[0]), _U), np.zeros(len(ids[0]), _U)
    for x in ids:
        high = high << _U(id_bits) | low >> _U(64 - id_bits)
        low = low << _U(id_bits) | x.astype(_U)
    rest = bits - 64
    return (low >> _U(rest) | high << _U(64 - rest) if rest < 64 else high), low & _mask(rest)


def unpacked_grams(top: np.ndarray, low: np.ndarray | None, n: int, id_bits: int) -> list[np.ndarray]:
    """The ids of ``packed_grams``."""
    if low is None:
        return [(top >> _U(id_bits * (n - 1 - k)) & _mask(id_bits)).astype(np.int64) for k in range(n)]
    rest = n * id_bits - 64
    high = top >> _U(64 - rest) if rest < 64 else top
    low = (top << _U(rest) | low) if rest < 64 else low
    out = []
    for _ in range(n):
        out.append((low & _mask(id_bits)).astype(np.int64))
        low = low >> _U(id_bits) | high << _U(64 - id_bits)
        high = high >> _U(id_bits)
    return out[::-1]


def _halves(top: np.ndarray, low: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(left, right, bits of the left half) of keys of over 64 bits."""
    rest, left = bits - 64, bits // 2
    return top >> _U(64 - left), (top & _mask(64 - left)) << _U(rest) | low if left < 64 else low, left


def _joined(left: np.ndarray, right: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    rest, first = bits - 64, bits // 2
    if first == 64:
        return left, right
    return left << _U(64 - first) | right >> _U(rest), right & _mask(rest)


def permuted(top: np.ndarray, low: np.ndarray | None, bits: int) -> tuple[np.ndarray, np.ndarray | None]:
    """Keys in another order of all numbers of ``bits`` bits: folds and odd factors, or Feistel rounds over 64 bits."""
    if low is None:
        fold, most = _U(-(-bits // 2)), _mask(bits)
        for odd in _ODD:
            top = (top ^ top >> fold) * _U(odd) & most
        return top ^ top >> fold, None
    left, right, first = _halves(top, low, bits)
    for k in range(_ROUNDS):
        left = left ^ mixed(right + _U(2 * k + 1)) & _mask(first)
        right = right ^ mixed(left + _U(2 * k + 2)) & _mask(bits - first)
    return _joined(left, right, bits)


def restored(top: np.ndarray, low: np.ndarray | None, bits: int) -> tuple[np.ndarray, np.ndarray | None]:
    """The inverse of ``permuted``."""
    if low is None:
        fold, most = _U(-(-bits // 2)), _mask(bits)
        top = top ^ top >> fold
        for odd in reversed(_ODD):
            top = top * _U(pow(odd, -1, 1 << bits)) & most
            top = top ^ top >> fold
        return top, None
    left, right, first = _halves(top, low, bits)
    for k in reversed(range(_ROUNDS)):
        right = right ^ mixed(left + _U(2 * k + 2)) & _mask(bits - first)
        left = left ^ mixed(right + _U(2 * k + 1)) & _mask(first)
    return _joined(left, right, bits)


def counted(top: np.ndarray, low: np.ndarray | None, counts: np.ndarray | None = None):
    """(top, low, counts) of the different keys in order; counts of equal keys are added."""
    if low is None:
        if counts is None:
            top = np.sort(top)
        else:
            order = np.argsort(top, kind="stable")  # filters are sorted runs, which merge
            top, counts = top[order], counts[order]
    else:
        order = np.lexsort((low, top))
        top, low = top[order], low[order]
        counts = counts[order] if counts is not None else None
    new = np.ones(len(top), bool)
    new[1:] = top[1:] != top[:-1]
    if low is not None:
        new[1:] |= low[1:] != low[:-1]
    at = np.flatnonzero(new)
    if counts is None:
        sums = np.diff(np.append(at, len(top)))
    else:
        sums = np.add.reduceat(counts, at) if len(at) else np.zeros(0, np.int64)
    return top[at], None if low is None else low[at], sums.astype(np.int64)


def _cut_bytes(values: np.ndarray, bits: int) -> bytes:
    width = -(-bits // 8)
    return values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :].tobytes()


def _from_bytes(data: memoryview, n: int, bits: int) -> tuple[np.ndarray, memoryview]:
    width = -(-bits // 8)
    wide = np.zeros((n, 8), np.uint8)
    wide[:, 8 - width :] = np.frombuffer(data, np.uint8, n * width).reshape(n, width)
    return wide.view(">u8").ravel().astype(_U), data[n * width :]


def pack(top: np.ndarray, low: np.ndarray | None, counts: np.ndarray, bits: int, prefix: int) -> bytes:
    """The filter of sorted keys of ``bits`` bits that agree in their first ``prefix`` bits."""
    n, free = len(top), top_bits(bits) - prefix
    quotient_bits = min(free, max(0, n.bit_length() - 1))
    rest = free - quotient_bits
    quotient = (top >> _U(rest) & _mask(quotient_bits)).astype(np.int64) if quotient_bits else np.zeros(n, np.int64)
    per = np.bincount(quotient, minlength=1 << quotient_bits)
    unary = np.ones(n + len(per), bool)
    unary[np.cumsum(per) + np.arange(len(per))] = False
    several = counts > 1
    more = counts[several]
    small = np.minimum(more - 2, 255).astype(np.uint8)
    large = more[small == 255].astype("<i8")
    parts = [
        n.to_bytes(4, "little") + bytes([quotient_bits]) + len(small).to_bytes(4, "little") + len(large).to_bytes(4, "little"),
        np.packbits(unary).tobytes(),
        _cut_bytes(top & _mask(rest), rest),
        b"" if low is None else _cut_bytes(low, bits - 64),
        np.packbits(several).tobytes(),
        small.tobytes(),
        large.tobytes(),
    ]
    return b"".join(parts)


def unpack(data: bytes, bits: int, prefix: int, slice_number: int) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """(top, low, counts) of a filter of the slice whose keys begin with ``slice_number``."""
    n, quotient_bits = int.from_bytes(data[:4], "little"), data[4]
    small, large = int.from_bytes(data[5:9], "little"), int.from_bytes(data[9:13], "little")
    rest, size = top_bits(bits) - prefix - quotient_bits, n + (1 << quotient_bits)
    view = memoryview(data)[13:]
    unary = np.unpackbits(np.frombuffer(view, np.uint8, -(-size // 8)), count=size)
    per = np.diff(np.flatnonzero(unary == 0), prepend=-1) - 1
    quotient = np.repeat(np.arange(len(per)), per).astype(_U)
    top, view = _from_bytes(view[-(-size // 8) :], n, rest)
    if quotient_bits:
        top = top | quotient << _U(rest)
    if prefix:
        top = top | _U(slice_number) << _U(top_bits(bits) - prefix)
    low = None
    if bits > 64:
        low, view = _from_bytes(view, n, bits - 64)
    several = np.unpackbits(np.frombuffer(view, np.uint8, -(-n // 8)), count=n).astype(bool)
    view = view[-(-n // 8) :]
    more = np.frombuffer(view, np.uint8, small).astype(np.int64) + 2
    more[more == 257] = np.frombuffer(view[small:], "<i8", large)
    counts = np.ones(n, np.int64)
    counts[several] = more
    return top, low, counts


def slices(top: np.ndarray, low: np.ndarray | None, counts: np.ndarray, bits: int, prefix: int) -> list[tuple[int, bytes]]:
    """(slice, filter) of sorted keys, one per slice of ``prefix`` leading bits that has any."""
    if not prefix:
        return [(0, pack(top, low, counts, bits, 0))] if len(top) else []
    own = (top >> _U(top_bits(bits) - prefix)).astype(np.int64)
    cuts = np.concatenate([np.flatnonzero(np.diff(own, prepend=-1)), [len(own)]])
    return [
        (int(own[a]), pack(top[a:b], None if low is None else low[a:b], counts[a:b], bits, prefix))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())
    ]


def merged(filters: list[bytes], bits: int, prefix: int, slice_number: int):
    """(top, low, counts) of several filters of one slice."""
    parts = [unpack(x, bits, prefix, slice_number) for x in filters]
    low = np.concatenate([x[1] for x in parts]) if bits > 64 else None
    return counted(np.concatenate([x[0] for x in parts]), low, np.concatenate([x[2] for x in parts]))
