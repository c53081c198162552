"""Removal of byte strings that repeat across documents, by bucket-pointer refinement.

A string of ``length`` bytes is worth comparing only with strings that have the same minimizer (the
least hash of their q-grams), so suffixes are dealt to tasks by minimizer, in runs that share one:

1. groups of documents send their minimizers, and learn which of them other documents have too, and
   which are hot, with very many different runs; runs of a hot one are cut anew by the minimizers of
   longer grams, at last by whole strings, which equal strings share as well, and asked about again;
2. runs under shared minimizers are sent, each different string once per group; a task sorts all
   suffixes of its strings: initial q-gram buckets, refined by sorting on the bucket pointers of
   later offsets, where updated pointers serve the next refinement, to the depth ``length``;
   it answers, bit by bit, which strings begin in a smaller document as well;
3. groups of documents remove what the answers cover.

A task sends at most ``fan`` rows, to ranges of buckets. Where there are more buckets, tasks in between
merge what so many others sent to a range and send it on to its parts, so that rows grow with the input
times the number of hops (its logarithm), and what all groups have meets no task more than ``fan`` times.

Answers come in the order of the questions, which a group can always work out again, so what is
shuffled is a few bytes per minimizer and the texts of shared runs.
"""

from __future__ import annotations

import hashlib
import math
import uuid
import zlib
from collections.abc import Callable
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import full_text, python_tasks, written
from .words import mixed

LENGTH = 50
Q = 16
#: Bytes of text of a group of documents, and of text whose minimizers, and whose runs, a task gets.
#: Sorting needs some hundred bytes of memory for each byte of a task's runs.
GROUP_BYTES = 2 << 20
BUCKET_BYTES = 4 << 20
RUN_BYTES = 1 << 20
#: Rows that a task sends to others at most: 2 KB of a group's text each, on which work is far more than on the row.
FAN = 1024
#: Groups that one file of the grouped table holds, about.
GROUPS_PER_FILE = 8
#: Window positions whose minimizers are worked out at once: their hashes stay in a core's cache.
SLICE = 1 << 16
LAST = (1 << 63) - 1

_BYTE = mixed(np.arange(1, 257, dtype=np.uint64))
_ORDER = np.uint64(0x9E3779B97F4A7C15)
_STEP = [int(x) | 1 for x in mixed(np.arange(1000, 1010, dtype=np.uint64))]


def _gram_hashes(data: np.ndarray, q: int) -> np.ndarray:
    """The hash of the q bytes from each place; built from hashes of 1, 2, 4, ... bytes."""
    power = [_BYTE[data]]
    while 2 << (len(power) - 1) <= q:
        k, last = 1 << (len(power) - 1), power[-1]
        power.append(last[:-k] * np.uint64(_STEP[len(power)]) + last[k:])
    at, out = 0, None
    for i in reversed(range(len(power))):
        if q >> i & 1:
            part = power[i][at : at + len(data) - q + 1]
            out = part.copy() if out is None else out * np.uint64(_STEP[0]) + part
            at += 1 << i
    # The order of the hashes needs high bits that all bytes have a say in, no more.
    out ^= out >> np.uint64(32)
    out *= _ORDER
    return out


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    k = 1
    while 2 * k <= width:
        values = np.minimum(values[:-k], values[k:])
        k *= 2
    return np.minimum(values[: len(values) - (width - k)], values[width - k :]) if width > k else values


class Cut(NamedTuple):
    """Runs of windows: first place, windows, key, number of the text, and leading zeros of a hash of the bytes."""

    start: np.ndarray
    count: np.ndarray
    key: np.ndarray
    owner: np.ndarray
    zeros: np.ndarray

    def take(self, which: np.ndarray) -> Cut:
        return Cut(*(x[which] for x in self))


_NO_RUNS = Cut(*(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.int32, np.uint8)))


def _joined(cuts: list[Cut]) -> Cut:
    return Cut(*(np.concatenate(x) for x in zip(_NO_RUNS, *cuts)))


class Group:
    """The texts of a group, in the order of (rank, bytes)."""

    def __init__(self, table: pa.Table, length: int):
        ranks, texts = table.column("rank").to_pylist(), table.column("text").to_pylist()
        order = sorted(range(len(texts)), key=lambda i: (ranks[i], texts[i]))
        self.rows = order
        self.rank = np.array([ranks[i] for i in order], np.int64)
        self.texts = [texts[i] for i in order]
        sizes = np.array([len(t) for t in self.texts], np.int64)
        self.begin = np.cumsum(sizes) - sizes
        self.bytes = b"".join(self.texts)
        self.length = length
        self.owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)

    def cut(self, q: int, of: Cut | None = None) -> Cut:
        """Runs of windows that share a minimizer, within texts or, if they are given, within the runs ``of``."""
        data, owner, length, parts = np.frombuffer(self.bytes, np.uint8), self.owner, self.length, []
        if of is not None:
            sizes = of.count + length - 1
            at = np.repeat(of.start - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            data, owner = data[at], np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        for a in range(0, max(0, len(data) - length + 1), SLICE):
            piece = data[a : a + SLICE + length - 1]
            n = len(piece) - length + 1
            grams = _gram_hashes(piece, q)
            least = _sliding_least(grams, length - q + 1)
            own = owner[a : a + n]
            inside = own == owner[a + length - 1 : a + n + length - 1]
            new = np.ones(n, bool)
            new[1:] = (least[1:] != least[:-1]) | (own[1:] != own[:-1]) | (inside[1:] != inside[:-1])
            start = np.flatnonzero(new)
            count = np.diff(np.append(start, n))
            good = inside[start]
            start, count = start[good], count[good]
            sums = np.append(np.uint64(0), np.cumsum(grams))
            marks = mixed(sums[start + count + length - q] - sums[start])
            zeros = np.clip(64 - np.frexp(marks.astype(np.float64))[1], 0, 63).astype(np.uint8)
            # The least of many hashes is small: mixed again, keys spread evenly over buckets.
            parts.append(Cut(start + a, count, mixed(least[start]), own[start], zeros))
        cut = _joined(parts)
        return cut if of is None else cut._replace(start=at[cut.start], owner=of.owner[cut.owner])


class Route:
    """The way from groups to ``buckets`` in hops; a sender has at most ``fan`` rows, one for each range.

    A place is (part, grp): a range of buckets, for what ``fan`` places of the hop before sent there.
    Groups of documents are places of part 0, and a bucket is one place for all.
    """

    def __init__(self, buckets: int, fan: int):
        self.buckets, self.fan, self.hops = buckets, 1, 1
        while max(2, fan) ** self.hops < buckets:
            self.hops += 1
        # Hops of like width: a place gets as much as a sender has.
        while self.fan**self.hops < buckets:
            self.fan += 1

    def bucket(self, keys: np.ndarray) -> np.ndarray:
        return ((keys >> np.uint64(32)) * np.uint64(self.buckets) >> np.uint64(32)).astype(np.int64)

    def spans(self, bucket: np.ndarray, hop: int) -> list[tuple[int, int, int]]:
        """(range, from, to) of sorted bucket numbers, at a hop from 1 on."""
        if not len(bucket):
            return []
        part = bucket // self.fan ** (self.hops - hop)
        edge = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
        return [(int(part[a]), int(a), int(b)) for a, b in zip(edge[:-1], edge[1:])]

    def sent(self, hop: int, part: int, grp: int, rows: list[tuple], names: list[str]) -> pa.Table:
        """Rows (range, payload ...) from a place to those of the hop."""
        n, to = len(rows), 0 if hop == self.hops else grp // self.fan
        at, *values = zip(*rows) if rows else [()] * (1 + len(names))
        return pa.table(
            {"from_part": pa.array([part] * n, pa.int64()), "from_grp": pa.array([grp] * n, pa.int64()),
             "part": pa.array(at, pa.int64()), "grp": pa.array([to] * n, pa.int64()),
             **{k: pa.array(v, pa.binary()) for k, v in zip(names, values)}}
        )


_SENT_SQL = "from_part LONG, from_grp LONG, part LONG, grp LONG"
_REPLY_SQL = "part LONG, grp LONG, about LONG, kind INT, hot BOOLEAN, bits BINARY"
#: The kind of replies about runs; those about minimizers have the number of their round.
RUNS = -1


def _reply(asked: pa.Table, kind: int, bits: list[bytes], hot: bool = False) -> pa.Table:
    """One reply to each row of ``asked``, which goes back to its sender; ``hot`` if it may tell of hot minimizers."""
    return pa.table(
        {"part": asked.column("from_part"), "grp": asked.column("from_grp"), "about": asked.column("part"),
         "kind": pa.array([kind] * len(bits), pa.int32()), "hot": pa.array([hot] * len(bits)),
         "bits": pa.array(bits, pa.binary())}
    )


def _replies(table: pa.Table, kind: int) -> dict[int, bytes]:
    rows = zip(*(table.column(c).to_pylist() for c in ("about", "kind", "bits")))
    return {about: bits for about, k, bits in rows if k == kind}


def _notes(several: np.ndarray, runs: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    digits = np.ceil(np.log2(runs)).astype("<u2")
    return several.astype("<u2") << 15 | digits << 8 | zeros


class Keys(NamedTuple):
    """How minimizers are asked about: grams of each round, way, bytes sent of a minimizer, zeros of a hot one."""

    length: int
    grams: tuple[int, ...]
    route: Route
    size: int
    hot: int

    def short(self, keys: np.ndarray) -> np.ndarray:
        return keys >> np.uint64(64 - 8 * self.size)

    def bucket(self, short: np.ndarray) -> np.ndarray:
        return self.route.bucket(short << np.uint64(64 - 8 * self.size))

    def different(self, cut: Cut) -> tuple[np.ndarray, np.ndarray]:
        """Different minimizers, shortened, and a note of each: whether several texts have it (bit 15), the
        logarithm of its runs (bits 8 to 14) and the most zeros of one. So many zeros are likely for 2 ** zeros
        different runs, however often each comes."""
        short, order, first = self.sorted(cut)
        if not len(short):
            return short, np.zeros(0, "<u2")
        owner, runs = cut.owner[order], np.diff(np.append(first, len(order)))
        several = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)
        return short, _notes(several, runs, np.maximum.reduceat(cut.zeros[order], first))

    def sorted(self, cut: Cut) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(different minimizers, shortened; the runs in their order; the first run of each in that order)."""
        short = self.short(cut.key)
        order = np.argsort(short)
        short = short[order]
        new = np.ones(len(short), bool)
        new[1:] = short[1:] != short[:-1]
        first = np.flatnonzero(new)
        return short[first], order, first

    def rows(self, hop: int, part: int, grp: int, short: np.ndarray, notes: np.ndarray) -> pa.Table:
        data = short.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - self.size :]
        spans = self.route.spans(self.bucket(short), hop)
        rows = [(at, data[lo:hi].tobytes(), notes[lo:hi].tobytes()) for at, lo, hi in spans]
        return self.route.sent(hop, part, grp, rows, ["keys", "notes"])

    def merged(self, table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
        """(different minimizers, notes, the number of the minimizer of each one sent, how many each row has)."""
        keys = [np.frombuffer(x, np.uint8).reshape(-1, self.size) for x in table.column("keys").to_pylist()]
        given = np.frombuffer(b"".join(table.column("notes").to_pylist()), "<u2")
        wide = np.zeros((len(given), 8), np.uint8)
        wide[:, 8 - self.size :] = np.concatenate(keys)
        short, which = np.unique(wide.view(">u8").ravel().astype(np.uint64), return_inverse=True)
        zeros = np.zeros(len(short), np.uint8)
        np.maximum.at(zeros, which, (given & 255).astype(np.uint8))
        several = np.bincount(which, weights=1 + (given >> 15)) > 1
        runs = np.bincount(which, weights=2.0 ** (given >> 8 & 127))
        return short, _notes(several, runs, zeros), which, [len(x) for x in keys]

    def bits(self, shared: np.ndarray, hot: np.ndarray, which: np.ndarray, counts: list[int]) -> list[bytes]:
        rows = np.split(which, np.cumsum(counts)[:-1])
        return [np.packbits(np.concatenate([shared[x], hot[x]])).tobytes() for x in rows]

    def answers(self, replies: pa.Table, kind: int, hop: int, short: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(shared, hot) of sorted minimizers that were asked about at the hop."""
        answer, out = _replies(replies, kind), np.zeros((2, len(short)), bool)
        for at, lo, hi in self.route.spans(self.bucket(short), hop):
            out[:, lo:hi] = np.unpackbits(np.frombuffer(answer[at], np.uint8), count=2 * (hi - lo)).reshape(2, -1)
        return out[0], out[1]

    def settled(self, group: Group, replies: pa.Table | None, rounds: int) -> tuple[Cut, Cut]:
        """The runs that other documents may share, after so many rounds, and those to ask about next."""
        done, cut = [], group.cut(self.grams[0])
        for i in range(rounds):
            short, order, first = self.sorted(cut)
            runs = np.diff(np.append(first, len(order)))
            shared, hot = np.zeros((2, len(order)), bool)
            shared[order], hot[order] = (np.repeat(x, runs) for x in self.answers(replies, i, 1, short))
            done.append(cut.take(shared & ~hot))
            cut = cut.take(shared & hot)
            if i + 1 < len(self.grams):
                cut = group.cut(self.grams[i + 1], cut)
        return _joined(done), cut

    def send(self, round_: int) -> Callable:
        def first(key, table):
            return self.rows(1, 0, key[0].as_py(), *self.different(self.settled(Group(table, self.length), None, 0)[1]))

        def later(key, left, right):
            cut = self.settled(Group(left, self.length), right, round_)[1] if left.num_rows else _NO_RUNS
            return self.rows(1, 0, key[0].as_py(), *self.different(cut))

        return later if round_ else first

    def relay(self, hop: int) -> Callable:
        def run(key, table):
            short, notes, _, _ = self.merged(table)
            return self.rows(hop, key[0].as_py(), key[1].as_py(), short, notes)

        return run

    def answer(self, round_: int) -> Callable:
        def run(key, table):
            _, notes, which, counts = self.merged(table)
            # Strings of the last round are whole windows: equal ones are one.
            hot = ((notes & 255) >= self.hot) & ((notes >> 8 & 127) >= self.hot) & (round_ + 1 < len(self.grams))
            shared = notes >> 15 > 0
            return _reply(table, round_, self.bits(shared, hot, which, counts), bool((hot & shared).any()))

        return run

    def relay_back(self, round_: int, hop: int) -> Callable:
        def run(key, left, right):
            short, notes, which, counts = self.merged(left)
            shared, hot = self.answers(right, round_, hop, short)
            return _reply(left, round_, self.bits(shared, hot, which, counts), bool((hot & shared).any()))

        return run


def _questions(group: Group, cut: Cut, route: Route) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """(buckets, strings, runs, uses): the different strings of the runs, bucket by bucket and
    in order, and for each string in turn its ``uses`` runs."""
    data, bucket = group.bytes, route.bucket(cut.key)
    where = zip(cut.start.tolist(), (cut.start + cut.count + group.length - 1).tolist())
    number: dict[bytes, int] = {}
    which = np.array([number.setdefault(data[a:b], len(number)) for a, b in where], np.int64)
    if not len(which):
        return which, [], which, which
    # Equal strings have equal minimizers, in each round, and so one bucket.
    buckets, strings = np.zeros(len(number), np.int64), list(number)
    buckets[which] = bucket
    order = np.array(sorted(range(len(strings)), key=strings.__getitem__), np.int64)
    order = order[np.argsort(buckets[order], kind="stable")]
    place = np.zeros(len(order), np.int64)
    place[order] = np.arange(len(order))
    which = place[which]
    own = np.argsort(which, kind="stable")
    return buckets[order], [strings[i] for i in order.tolist()], own, np.bincount(which)


def _least_ranks(group: Group, cut: Cut, own: np.ndarray, uses: np.ndarray) -> np.ndarray:
    """The least rank among each string's runs."""
    if not len(uses):
        return np.zeros(0, np.int64)
    return np.minimum.reduceat(group.rank[cut.owner[own]], np.cumsum(uses) - uses)


def _packed(strings: list[bytes], least: np.ndarray, buckets: np.ndarray) -> bytes:
    """Strings with a number and a bucket each, compressed: short texts of many kinds are dense only after
    entropy coding."""
    sizes = np.array([len(s) for s in strings], "<i4").tobytes()
    numbers = least.astype("<i8").tobytes() + np.diff(buckets, prepend=0).astype("<i8").tobytes()
    return zlib.compress(len(strings).to_bytes(4, "little") + sizes + numbers + b"".join(strings), 1)


def _unpacked(data: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    data = zlib.decompress(data)
    n = int.from_bytes(data[:4], "little")
    sizes, numbers = np.frombuffer(data, "<i4", n, 4), np.frombuffer(data, "<i8", 2 * n, 4 + 4 * n)
    ends = (np.cumsum(sizes) + 4 + 20 * n).tolist()
    return [data[e - k : e] for e, k in zip(ends, sizes.tolist())], numbers[:n], np.cumsum(numbers[n:])


def _run_rows(route: Route, hop: int, part: int, grp: int, strings: list, least: np.ndarray, buckets: np.ndarray) -> pa.Table:
    spans = route.spans(buckets, hop)
    rows = [(at, _packed(strings[lo:hi], least[lo:hi], buckets[lo:hi])) for at, lo, hi in spans]
    return route.sent(hop, part, grp, rows, ["data"])


def _send_runs(keys: Keys, route: Route, rounds: int) -> Callable:
    def run(key, left, right):
        strings, least, buckets = [], np.zeros(0, np.int64), np.zeros(0, np.int64)
        if left.num_rows:
            group = Group(left, keys.length)
            cut, _ = keys.settled(group, right, rounds)
            buckets, strings, own, uses = _questions(group, cut, route)
            least = _least_ranks(group, cut, own, uses)
        return _run_rows(route, 1, 0, key[0].as_py(), strings, least, buckets)

    return run


class Asked:
    """What a place was sent: its different strings, the least number of each, and whose they are."""

    def __init__(self, table: pa.Table, length: int):
        number: dict[bytes, int] = {}
        which, least, self.per_row, buckets = [], [], [], []
        for data in table.column("data"):
            strings, low, bucket = _unpacked(data.as_py())
            known = len(number)
            ids = [number.setdefault(s, len(number)) for s in strings]
            buckets += [b for i, b in zip(ids, bucket.tolist()) if i >= known]
            which += ids
            least.append(low)
            self.per_row.append(len(strings))
        self.strings, self.buckets = list(number), np.array(buckets, np.int64)
        self.which, self.least = np.array(which, np.int64), np.concatenate(least)
        self.low = np.full(len(number), LAST)
        np.minimum.at(self.low, self.which, self.least)
        self.windows = np.array([len(s) for s in self.strings], np.int64) - length + 1

    def in_order(self) -> np.ndarray:
        """The numbers of the strings, bucket by bucket and in order."""
        return np.array(sorted(range(len(self.strings)), key=lambda i: (self.buckets[i], self.strings[i])), np.int64)

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each window asked about, in order: its place among the windows of the strings, and its string's
        least number in the row."""
        first = np.cumsum(self.windows) - self.windows
        count = self.windows[self.which]
        at = np.repeat(first[self.which] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        return at, np.repeat(self.least, count)

    def bits(self, earlier: np.ndarray) -> list[bytes]:
        """A mark for each window asked about, row by row."""
        rows = np.cumsum([0, *self.per_row])
        upto = np.concatenate([[0], np.cumsum(self.windows[self.which])])[rows]
        return [np.packbits(earlier[a:b]).tobytes() for a, b in zip(upto[:-1], upto[1:])]


def _relay_runs(route: Route, length: int, hop: int) -> Callable:
    def run(key, table):
        asked = Asked(table, length)
        order = asked.in_order()
        strings = [asked.strings[i] for i in order]
        return _run_rows(route, hop, key[0].as_py(), key[1].as_py(), strings, asked.low[order], asked.buckets[order])

    return run


def _window_marks(route: Route, replies: pa.Table, hop: int, buckets: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """The answers to strings asked about at the hop, window by window."""
    answers, marks = _replies(replies, RUNS), [np.zeros(0, np.uint8)]
    for at, lo, hi in route.spans(buckets, hop):
        marks.append(np.unpackbits(np.frombuffer(answers[at], np.uint8), count=int(windows[lo:hi].sum())))
    return np.concatenate(marks).astype(bool)


def _relay_runs_back(route: Route, length: int, hop: int) -> Callable:
    def run(key, left, right):
        asked = Asked(left, length)
        order = asked.in_order()
        windows = asked.windows[order]
        marks = _window_marks(route, right, hop, asked.buckets[order], windows)
        # From the order of the strings sent on to that of ``asked``.
        first = np.zeros(len(order), np.int64)
        first[order] = np.cumsum(windows) - windows
        step = np.arange(asked.windows.sum()) - np.repeat(np.cumsum(asked.windows) - asked.windows, asked.windows)
        marks = marks[np.repeat(first, asked.windows) + step]
        at, least = asked.places()
        # A string that a smaller document sent has all its windows there.
        return _reply(left, RUNS, asked.bits(marks[at] | (np.repeat(asked.low, asked.windows)[at] < least)))

    return run


def refined(data: np.ndarray, room: np.ndarray, length: int, q: int = 8) -> np.ndarray:
    """Bucket pointers of all places: equal for two places with ``length`` bytes of room if and only
    if these bytes are equal. ``room`` is the number of bytes from a place to its string's end.

    The pointer of a bucket is where it begins among the sorted places. Buckets of q-grams are
    refined by sorting their members on the pointers at a later offset; buckets of one member
    need no more sorting, and refined pointers replace the old ones for the next, deeper step.
    """
    places = np.flatnonzero(room >= q)
    packed = np.zeros(len(places), np.uint64)
    for k in range(q):
        packed = (packed << np.uint64(8)) | data[places + k].astype(np.uint64)
    pointer = np.full(len(data), -1, np.int32)
    order = np.argsort(packed)
    pointer[places[order]] = _first_equal(packed[order])
    depth = q
    while depth < length:
        offset = min(depth, length - depth)
        depth += offset
        places = np.flatnonzero((room >= depth) & (pointer >= 0))
        own = pointer[places]
        counts = np.bincount(own, minlength=1)
        places = places[counts[own] > 1]
        own, later = pointer[places], pointer[places + offset]
        both = own.astype(np.int64) * (len(data) + 1) + later
        order = np.argsort(both)
        places, own = places[order], own[order]
        start = _first_equal(own)
        part = _first_equal(both[order])
        pointer[places] = own + (part - start)
    return pointer


def _first_equal(values: np.ndarray) -> np.ndarray:
    """For each of sorted values: the index of the first equal one."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    at = np.flatnonzero(new)
    return np.repeat(at, np.diff(np.append(at, len(values))))


def _minimizers(strings: list[bytes], length: int, q: int) -> np.ndarray:
    """The minimizer that all windows of each string share."""
    sizes = np.array([len(s) for s in strings], np.int64)
    grams = np.append(_gram_hashes(np.frombuffer(b"".join(strings), np.uint8), q), np.uint64(LAST))
    start = np.cumsum(sizes) - sizes
    return np.minimum.reduceat(grams, np.stack([start, start + length - q + 1], 1).ravel())[::2]


def _least_of_windows(strings: list[bytes], low: np.ndarray, length: int) -> np.ndarray:
    """For each window of the strings, in order: the least number of a string that has it."""
    sizes = np.array([len(s) for s in strings], np.int64)
    data = np.frombuffer(b"".join(strings), np.uint8)
    room = (np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))).astype(np.int32)
    own = refined(data, room, length)[room >= length]
    smallest = np.full(len(data) + 1, LAST)
    np.minimum.at(smallest, own, np.repeat(low, sizes - length + 1))
    return smallest[own]


def _answer_runs(length: int, q: int) -> Callable:
    def run(key, table):
        asked = Asked(table, length)
        # Equal windows have equal minimizers: a string that is the only one under its own is settled.
        _, mark, uses = np.unique(_minimizers(asked.strings, length, q), return_inverse=True, return_counts=True)
        several = uses[mark] > 1
        found = np.repeat(asked.low, asked.windows)
        if several.any():
            some = np.flatnonzero(several)
            strings = [asked.strings[i] for i in some]
            found[np.repeat(several, asked.windows)] = _least_of_windows(strings, asked.low[some], length)
        at, least = asked.places()
        return _reply(table, RUNS, asked.bits(found[at] < least))

    return run


def _remove(keys: Keys, route: Route, rounds: int, with_text: bool) -> Callable:
    length = keys.length

    def run(key, left, right):
        if not left.num_rows:
            return _REMOVED.empty_table() if with_text else _REMOVED.empty_table().drop_columns(["kept"])
        group = Group(left, length)
        cut, _ = keys.settled(group, right, rounds)
        covered = np.zeros(len(group.bytes) + 1, np.int32)
        buckets, strings, own, uses = _questions(group, cut, route)
        windows = np.array([len(x) for x in strings], np.int64) - length + 1
        earlier = _window_marks(route, right, 1, buckets, windows)
        # Any later document of the group has all of a string from the group's first one ...
        first = np.repeat(_least_ranks(group, cut, own, uses), uses)
        later = group.rank[cut.owner[own]] > first
        begin = cut.start[own[later]]
        # No two runs, and no two windows, begin or end at one place.
        covered[begin] += 1
        covered[begin + cut.count[own[later]] + length - 1] -= 1
        # ... and the first one has the windows that the answers mark.
        which, count = own[~later], np.repeat(windows, uses)[~later]
        place = np.repeat(np.cumsum(windows) - windows, uses)[~later]
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        hit = (np.repeat(cut.start[which], count) + step)[earlier[np.repeat(place, count) + step]]
        covered[hit] += 1
        covered[hit + length] -= 1
        gone = np.cumsum(covered[:-1]) > 0
        out = {k: [] for k in _REMOVED.names}
        given = left.column("doc_id").to_pylist()
        for i, (text, begin) in enumerate(zip(group.texts, group.begin)):
            own = gone[begin : begin + len(text)]
            edge = np.diff(np.concatenate([[0], own.astype(np.int8), [0]]))
            starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            kept = np.frombuffer(text, np.uint8)[~own].tobytes() if len(starts) else text
            out["doc_id"].append(given[group.rows[i]])
            out["n_bytes"].append(len(text))
            out["n_removed"].append(int(own.sum()))
            out["starts"].append(starts)
            out["ends"].append(ends)
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["kept"].append(kept)
        names = [n for n in _REMOVED.names if with_text or n != "kept"]
        return pa.table({k: pa.array(out[k], _REMOVED.field(k).type) for k in names})

    return run


_REMOVED = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("starts", pa.list_(pa.int64())),
     ("ends", pa.list_(pa.int64())), ("kept_sha256", pa.string()), ("kept", pa.binary())]
)


def suffix_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    q: int = Q,
    group_bytes: int = GROUP_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    run_bytes: int = RUN_BYTES,
    fan: int = FAN,
    with_text: bool = False,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, starts, ends, kept_sha256 (and kept, the bytes).

    A byte is removed if a string of ``length`` bytes that covers it also begins in a document with a
    smaller id. Strings are judged on the input; they may overlap and never cross documents.
    ``starts`` and ``ends`` are the maximal removed spans in bytes of UTF-8, ``kept`` the rest.

    A null text is empty; a null id is greater than all others; documents of one id (repeated rows
    too) do not remove each other's bytes; an empty table gives no rows.
    """
    spark = docs.sparkSession
    python_tasks(spark)
    text = full_text(text_column).cast("binary")
    total = docs.select(F.sum(F.octet_length(full_text(text_column)))).first()[0] or 0
    groups, buckets, run_buckets = (max(1, -(-total // n)) for n in (group_bytes, bucket_bytes, run_bytes))
    route = Route(run_buckets, fan)
    # So many bytes of a minimizer that different ones seldom look alike (that costs time only).
    size = min(8, max(5, math.ceil((math.log2(max(2, total)) + 8) / 8)))
    # Grams of the rounds: the step between keeps runs long where a middle length is rare enough.
    grams = tuple(sorted({q, (q + length) // 2, length}))
    keys = Keys(length, grams, Route(buckets, fan), size, hot_zeros(run_bytes, length))
    files = max(1, -(-groups // GROUPS_PER_FILE))
    # The texts, grouped once and for all: a bucketed table is read group by group without a shuffle.
    name = f"suffix_texts_{uuid.uuid4().hex}"
    grouped = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(LAST)).alias("rank"),
        text.alias("text"),
        F.pmod(F.xxhash64(F.col(id_column), F.monotonically_increasing_id()), F.lit(groups)).alias("grp"),
    )
    grouped.repartition(files, "grp").write.bucketBy(files, "grp").option("compression", "zstd").option(
        "path", scratch_path(spark, "suffix-texts")
    ).saveAsTable(name)
    texts = spark.table(name)

    ask = _SENT_SQL + ", keys BINARY, notes BINARY"
    shared, rounds = None, 0
    while rounds < len(keys.grams):
        by_group = texts.groupBy("grp")
        sent = (by_group if shared is None else by_group.cogroup(shared.groupBy("grp"))).applyInArrow(keys.send(rounds), ask)
        replies = _exchange(
            sent, ask, keys.route, "suffix-shared", keys.relay, keys.answer(rounds), partial(keys.relay_back, rounds)
        )
        shared = replies if shared is None else shared.unionByName(replies)
        rounds += 1
        if replies.where("hot").isEmpty():
            break
    ask = _SENT_SQL + ", data BINARY"
    asked = texts.groupBy("grp").cogroup(shared.groupBy("grp")).applyInArrow(_send_runs(keys, route, rounds), ask)
    answers = _exchange(
        asked, ask, route, "suffix-answers", partial(_relay_runs, route, length), _answer_runs(length, q),
        partial(_relay_runs_back, route, length),
    )
    schema = "doc_id LONG, n_bytes LONG, n_removed LONG, starts ARRAY<LONG>, ends ARRAY<LONG>, kept_sha256 STRING"
    return (
        texts.groupBy("grp")
        .cogroup(shared.unionByName(answers).groupBy("grp"))
        .applyInArrow(_remove(keys, route, rounds, with_text), schema + ", kept BINARY" * with_text)
    )


def hot_zeros(run_bytes: int, length: int) -> int:
    """Zeros from which a minimizer is hot: it likely is with a third of a task's runs, and almost surely
    with three times as many."""
    return max(1, int(math.log2(max(2, run_bytes / (4 * length)))))


def _exchange(
    sent: DataFrame, schema: str, route: Route, label: str, relay: Callable, answer: Callable, back: Callable
) -> DataFrame:
    """The replies to what groups sent, over all hops there and back."""
    inputs = []
    for hop in range(2, route.hops + 1):
        inputs.append(written(sent, f"{label}-hop"))
        sent = inputs[-1].groupBy("part", "grp").applyInArrow(relay(hop), schema)
    replies = sent.groupBy("part", "grp").applyInArrow(answer, _REPLY_SQL)
    for hop in range(route.hops, 1, -1):
        rows = inputs.pop().groupBy("part", "grp")
        replies = rows.cogroup(replies.groupBy("part", "grp")).applyInArrow(back(hop), _REPLY_SQL)
    return written(replies, label)
