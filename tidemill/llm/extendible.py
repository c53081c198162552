"""Sharding by extendible hashing.

Shards are the leaves of a directory over the leading bits of a key's hash: a bucket that exceeds
the byte limit is split on its next bit, until every shard fits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import number_rows
from .common import ROW, fresh, full_text, named, named_key, numbered, written

#: Bytes of text in a shard at most (a longer document is a shard of its own).
SHARD_BYTES = 1 << 20
#: Bits of a hash word; a row has two, of its key and of its place.
BITS = 60
#: Bits that a round looks ahead over those that an even spread would need.
AHEAD = 4


def hash_bits(value: Column) -> Column:
    """The first 60 bits of the value's MD5 as a number."""
    return F.conv(F.substring(F.md5(value), 1, 15), 16, 10).cast("bigint")


def prefix(bits: Column, depth: Column) -> Column:
    """The leading ``depth`` of 60 bits."""
    return F.call_function("shiftright", bits, (F.lit(BITS) - depth).cast("int"))


def _leaves(cells: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """(within, cell, depth, shard_bytes, shard_rows): the bucket of each cell that fits.

    ``cells`` are (within, cell, bytes, rows) at depth ``high``, of buckets too large at depth ``low``.
    A bucket is a leaf if it fits and the bucket it was split from does not: its depth is the least
    at which its bytes fit.
    """
    levels = cells.select("within", "cell", "bytes", "rows", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
    levels = levels.withColumn("bucket", F.call_function("shiftright", "cell", (F.lit(high) - F.col("depth")).cast("int")))
    buckets = (
        levels.groupBy("within", "depth", "bucket")
        .agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("shard_rows"))
        .where((F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1))
    )
    fitting = levels.select("within", "cell", "depth", "bucket").join(buckets, ["within", "depth", "bucket"])
    return (
        fitting.groupBy("within", "cell")
        .agg(F.min(F.struct("depth", "shard_bytes", "shard_rows")).alias("leaf"))
        .select("within", "cell", "leaf.depth", "leaf.shard_bytes", "leaf.shard_rows")
    )


def shard(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shard_bytes: int = SHARD_BYTES,
    ahead: int = AHEAD,
) -> DataFrame:
    """One row per document: row (its place in the input), doc_id, bytes, shard, depth, shard_bytes,
    shard_rows.

    ``shard`` is the bucket's bits as text ("" while one shard holds all), ``bytes`` those of the text
    in UTF-8. No shard exceeds the limit but one of a single document. Rows of one id, which no bit
    of its hash tells apart, are split on the bits of a second hash, of their place. A null text has
    no bytes, a null id is an id, an empty table gives no rows.
    """
    rows = written(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_column).alias("doc_id"),
            F.octet_length(full_text(text_column)).cast("bigint").alias("bytes"),
            hash_bits(named_key(id_column)).alias("bits"),
        ),
        "shard-rows",
    )
    # ``within`` is what is settled already: "" for the first hash, all its bits for the second.
    first, open_rows = _split(rows.withColumn("within", F.lit("")), shard_bytes, ahead)
    if open_rows is None:
        return first
    second = open_rows.withColumn("within", F.lpad(F.conv("bits", 10, 2), BITS, "0"))
    second = second.withColumn("bits", hash_bits(F.col("row").cast("string")))
    rest, left = _split(written(second, "shard-repeats"), shard_bytes, ahead)
    assert left is None, "places have different hashes"
    return first.unionByName(rest)


def _split(rows: DataFrame, limit: int, ahead: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows with their shards, rows that all bits of this hash leave in too large buckets)."""
    total = rows.select(F.sum("bytes")).first()[0] or 0
    low, high = 0, min(BITS, ahead + math.ceil(math.log2(max(1, total / limit))))
    done: DataFrame | None = None
    while True:
        cells = rows.withColumn("cell", prefix(F.col("bits"), F.lit(high)))
        sums = cells.groupBy("within", "cell").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        leaves = written(_leaves(sums, low, high, limit), "shard-directory")
        # A cell has few rows: the bytes of its bucket are near the limit, whatever the input.
        placed = cells.join(leaves.withColumnRenamed("shard_bytes", "total_bytes"), ["within", "cell"], "left")
        fits = placed.where("depth is not null").select(
            "row", "doc_id", F.col("bytes"),
            F.concat("within", F.when(F.col("depth") > 0, F.lpad(F.conv(prefix(F.col("bits"), F.col("depth")), 10, 2), F.col("depth"), F.lit("0"))).otherwise("")).alias("shard"),
            (F.length("within") + F.col("depth")).cast("int").alias("depth"),
            F.col("total_bytes").alias("shard_bytes"), "shard_rows",
        )
        done = fits if done is None else done.unionByName(fits)
        if not sums.join(leaves, ["within", "cell"], "left_anti").isEmpty():
            rows = written(cells.join(leaves, ["within", "cell"], "left_anti").drop("cell"), "shard-open")
        else:
            return done, None
        if high == BITS:
            return done, rows
        low, high = high + 1, min(BITS, high + 8)


def write_shards(
    docs: DataFrame, sharded: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text"
) -> None:
    """Write the documents, one folder per shard; ``docs`` is the table that ``shard`` was given.

    Documents meet their shards by id, bytes and a number among those equal in both, which may
    change places without changing any shard's size. The folders are always named by ``shard``; a column of
    the documents with that name is written as ``shard_``.
    """
    own = numbered(docs)
    size = F.octet_length(full_text(text_column)).cast("bigint")
    keys = own.select(ROW, named_key(id_column).alias("id"), size.alias("bytes"))
    places = written(sharded.select("row", named_key("doc_id").alias("id"), "bytes", "shard"), "shard-places")
    keys = number_rows(keys, ["id", "bytes"], [ROW], "copy")
    places = number_rows(places, ["id", "bytes"], ["row"], "copy")
    folder = fresh(docs.columns, "shard")
    shard_of = keys.join(places, ["id", "bytes", "copy"]).select(ROW, F.col("shard").alias(folder))
    kept = [named(c).alias(folder) if c.lower() == "shard" else named(c) for c in docs.columns]
    out = own.join(shard_of, ROW).select(*kept, named(folder).alias("shard"))
    out.repartition("shard").write.partitionBy("shard").parquet(path)
