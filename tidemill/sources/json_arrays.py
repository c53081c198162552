"""Large JSON arrays read by many tasks.

A file that is one array of objects has no line to split at, so it is read as pieces that end in a closing
brace, which Spark's text reader finds in any byte range. A piece alone does not tell whether it begins
inside a string, so what it does to the depth is worked out for both cases; a prefix pass over the pieces
of each range, and one over the ranges of each file, settles which case holds and how deep each piece
begins. Records are cut where a brace closes at depth one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import infer_schema
from ..session import scratch_path

BRACE = "}"
#: Characters of a text with its strings blanked that open and close a level.
_OPEN, _CLOSE = r"[\[{]", r"[\]}]"


def _depth(text: Column) -> Column:
    return F.regexp_count(text, F.lit(_OPEN)) - F.regexp_count(text, F.lit(_CLOSE))


_RANGE = "spark.sql.files.maxPartitionBytes"


def _pieces(spark: SparkSession, path: str, pattern: str, range_bytes: int | None) -> DataFrame:
    """The pieces of all files, written once so that every later pass sees the same ranges.

    Columns: file, range, at (order within the range), text (without the brace it ends in), quotes (whether
    their number is odd), d0 and d1 (change of depth if the piece begins outside or inside of a string).
    """
    raw = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .option("lineSep", BRACE)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("range"),
            F.monotonically_increasing_id().alias("at"),
            F.col("value").alias("text"),
        )
    )
    # A backslash takes the next character with it; that is never the brace between two pieces.
    bare = F.regexp_replace("text", r"(?s)\\.", "")
    closed = F.regexp_replace(bare, r'(?s)"[^"]*("|$)', "")
    # Begun inside a string, the first quote ends it.
    rest = F.regexp_replace(bare, r'(?s)^[^"]*("|$)', "")
    inside = F.regexp_replace(rest, r'(?s)"[^"]*("|$)', "")
    odd = F.regexp_count(bare, F.lit('"')) % 2
    found = raw.select(
        "file", "range", "at", "text", odd.alias("quotes"),
        # The brace at the end closes a level if the piece ends outside of a string.
        (_depth(closed) - F.when(odd == 0, 1).otherwise(0)).alias("d0"),
        (_depth(inside) - F.when(odd == 1, 1).otherwise(0)).alias("d1"),
    )
    place, usual = scratch_path(spark, "json-pieces"), spark.conf.get(_RANGE)
    try:
        spark.conf.set(_RANGE, str(range_bytes or usual))
        found.write.parquet(place)
    finally:
        spark.conf.set(_RANGE, usual)
    return spark.read.schema(found.schema).parquet(place)


def _before(value: Column, window) -> Column:
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def array_records(
    spark: SparkSession, path: str, pattern: str = "*.json", range_bytes: int | None = None
) -> DataFrame:
    """(file, value) with the text of each object of the arrays in all files under ``path``.

    A task reads ``range_bytes`` of a file, or as many as Spark's setting says.

    Only the pieces of a record, and the sums of a range of a file, come together in a task. What is
    between two objects of an array and is no white space or comma comes with the next object, which
    then does not parse; so do the last objects of a file that ends too early.
    """
    pieces = _pieces(spark, path, pattern, range_bytes)
    within = Window.partitionBy("file", "range").orderBy("at")
    # For both states at the beginning of the range: the state before the piece, and the depth.
    steps = pieces.withColumn("odd", _before(F.col("quotes"), within) % 2)
    steps = steps.withColumn("e0", F.when(F.col("odd") == 0, F.col("d0")).otherwise(F.col("d1")))
    steps = steps.withColumn("e1", F.when(F.col("odd") == 0, F.col("d1")).otherwise(F.col("d0")))
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = steps.withColumn("after0", F.sum("e0").over(upto)).withColumn("after1", F.sum("e1").over(upto))

    # One row per range of a file: its state and depth at the beginning follow from the ranges before.
    ranges = steps.groupBy("file", "range").agg(
        F.sum("quotes").alias("quotes"), F.sum("e0").alias("e0"), F.sum("e1").alias("e1")
    )
    order = Window.partitionBy("file").orderBy("range")
    ranges = ranges.withColumn("state", _before(F.col("quotes"), order) % 2)
    own = F.when(F.col("state") == 0, F.col("e0")).otherwise(F.col("e1"))
    ranges = ranges.withColumn("depth", _before(own, order)).select("file", "range", "state", "depth")

    placed = steps.join(ranges, ["file", "range"])
    after = F.col("depth") + F.when(F.col("state") == 0, F.col("after0")).otherwise(F.col("after1"))
    outside = (F.col("state") + F.col("odd") + F.col("quotes")) % 2 == 0
    placed = placed.select("file", "range", "at", "text", (outside & (after == 1)).cast("int").alias("ends"))
    # Records are numbered by the ends before them, again in two steps.
    local = placed.withColumn("number", _before(F.col("ends"), within))
    counts = placed.groupBy("file", "range").agg(F.sum("ends").alias("n"))
    counts = counts.select("file", "range", _before(F.col("n"), order).alias("earlier"))
    parts = local.join(counts, ["file", "range"]).withColumn("record", F.col("number") + F.col("earlier"))
    records = parts.groupBy("file", "record").agg(
        F.sort_array(F.collect_list(F.struct("range", "at", "text"))).alias("parts"), F.max("ends").alias("whole")
    )
    text = F.concat(F.array_join("parts.text", BRACE), F.lit(BRACE))
    lead = F.when(F.col("record") == 0, F.regexp_replace(text, r"^\s*\[\s*", "")).otherwise(F.regexp_replace(text, r"^\s*,\s*", ""))
    # What follows a file's last object is its closing bracket; text without a whole object is broken.
    tail = (F.col("whole") == 0) & F.array_join("parts.text", BRACE).rlike(r"^\s*(\[\s*)?\]\s*$")
    return records.where(~tail).select("file", lead.alias("value"))


def array_scan(
    spark: SparkSession,
    path: str,
    pattern: str = "*.json",
    schema: T.StructType | None = None,
    continue_on_error: bool = False,
    range_bytes: int | None = None,
) -> DataFrame:
    """Rows of the objects in all arrays under ``path``; without a schema one is inferred from all of them.

    A record that does not parse stops the read, or is skipped with ``continue_on_error``.
    """
    records = array_records(spark, path, pattern, range_bytes)
    if schema is None:
        place = scratch_path(spark, "json-records")
        records.write.parquet(place)
        records = spark.read.schema(records.schema).parquet(place)
        schema = infer_schema(records, keep_objects=True)
    bad = F.try_parse_json("value").isNull()
    if continue_on_error:
        good = records.where(~bad)
    else:
        message = F.concat(F.lit("malformed JSON record in "), F.col("file"))
        good = records.withColumn("value", F.when(bad, F.raise_error(message).cast("string")).otherwise(F.col("value")))
    return good.select(F.from_json("value", schema).alias("record")).select("record.*")
