"""Digests of long joined lists, streamed piece by piece."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import python_tasks

#: Members that are joined to one piece of text.
PIECE = 10_000


def _pieces(size: int, kind: pa.DataType):
    """Members of one name in a row, joined by commas, ``size`` at a time."""

    def table(rows):
        kinds = (pa.binary(), kind, pa.string())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], ["whole", "first", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, members = None, []
        for batch in batches:
            out = []
            for whole, member in zip(batch.column("whole").to_pylist(), batch.column("member").to_pylist()):
                if members and (whole != name or len(members) == size):
                    out.append((name, members[0], ",".join(map(str, members))))
                    members = []
                name = whole
                members.append(member)
            if out:
                yield table(out)
        if members:
            yield table([(name, members[0], ",".join(map(str, members)))])

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each name's pieces, which come in order; one piece is held at a time."""

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), (pa.binary(), pa.string()))], ["whole", "sha"])

    name, state = None, None
    for batch in batches:
        out = []
        for whole, text in zip(batch.column("whole").to_pylist(), batch.column("text").to_pylist()):
            if state is None or whole != name:
                if state is not None:
                    out.append((name, state.hexdigest()))
                name, state = whole, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if out:
            yield table(out)
    if state is not None:
        yield table([(name, state.hexdigest())])


def joined_digests(rows: DataFrame, size: int = PIECE) -> DataFrame:
    """(whole, sha) of rows (whole, member): SHA-256 of a name's members in order, joined by commas.

    ``whole`` is binary, ``member`` a LONG (in numeric order) or a STRING (by bytes). A digest reads its bytes
    in order, however many they are. Ranges of (name, member) are joined to pieces in parallel, and a
    task streams a name's pieces, so it never holds a name's members.
    """
    spark = rows.sparkSession
    python_tasks(spark)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sql = dict(rows.dtypes)["member"]
    pieces = (
        rows.select("whole", "member")
        .repartitionByRange(parts, "whole", "member")
        .sortWithinPartitions("whole", "member")
        .mapInArrow(_pieces(size, pa.string() if sql == "string" else pa.int64()), f"whole BINARY, first {sql}, text STRING")
    )
    return (
        pieces.repartition(parts, "whole")
        .sortWithinPartitions("whole", "first")
        .mapInArrow(_digests, "whole BINARY, sha STRING")
    )
