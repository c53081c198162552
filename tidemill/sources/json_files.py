"""JSON files: one object per file, an array of objects per file, or one object per line."""

from __future__ import annotations

import json
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

FORMATS = ("auto", "object", "array", "ndjson")
CORRUPT = "_corrupt_record"
#: Tasks that look up a list of files. Spark's own number is one task per file.
LISTING_TASKS = 64
#: Bytes of a file up to which its text may be one value.
WHOLE_BYTES = 512 << 20

_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def detect_formats(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """``(file, format)`` per file, from its first and last line with text in it.

    A distributed scan: each task keeps two lines per file. A leading ``[`` means an array. A
    file is one object if it starts with ``{`` and neither line is JSON by itself; otherwise it
    is line by line.
    """
    return _formats(spark, path, pattern).select("file", "format")


def _formats(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_block_start").alias("block"),
            F.trim("value").alias("line"),
        )
        .withColumn("at", F.struct("block", F.monotonically_increasing_id()))
        .filter(F.col("line") != "")
    )
    ends = lines.groupBy("file", "size").agg(F.min_by("line", "at").alias("first"), F.max_by("line", "at").alias("last"))
    # The parser takes a leading string for a value, whatever follows: a record begins with a brace.
    whole = ~_is_record("first") & ~_is_record("last")
    kind = (
        F.when(F.col("first").startswith("["), "array")
        .when(F.col("first").startswith("{") & whole, "object")
        .otherwise("ndjson")
    )
    return ends.select("file", kind.alias("format"), "size")


def _is_record(line: str) -> Column:
    return F.col(line).startswith("{") & F.try_parse_json(line).isNotNull()


def _read(spark: SparkSession, paths, kind: str, pattern: str, schema, mode: str) -> DataFrame:
    reader = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .option("multiLine", str(kind != "ndjson").lower())
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    return (reader.schema(schema) if schema is not None else reader).json(paths)


def _listed(spark: SparkSession, files: list[str], largest: int, kind: str, pattern: str, schema, mode: str) -> DataFrame:
    """Rows of named files, whose number is not bounded, with as many tasks as their bytes and number ask for.

    Left to itself Spark infers the schema of whole files in one task, which copies the list for each of them.
    """
    usual = spark.conf.get(_LISTING)
    try:
        spark.conf.set(_LISTING, str(min(LISTING_TASKS, int(usual))))
        if schema is None and kind != "ndjson" and largest <= WHOLE_BYTES:
            schema = _schema_of_texts(spark, spark.read.text(files, wholetext=True), mode)
        return _read(spark, files, kind, pattern, schema, mode)
    finally:
        spark.conf.set(_LISTING, usual)


def _schema_of_texts(spark: SparkSession, texts: DataFrame, mode: str) -> T.StructType:
    """What Spark's reader infers from texts of one JSON value each, by all tasks that read them."""
    reader = spark.read.option("mode", mode).option("columnNameOfCorruptRecord", CORRUPT)
    # Python's reader takes an RDD of texts only.
    values = getattr(texts._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return T.StructType.fromJson(json.loads(reader._jreader.json(values).schema().json()))


def json_scan(
    spark: SparkSession,
    path: str,
    file_format: str = "auto",
    pattern: str = "*.json",
    schema: T.StructType | None = None,
    continue_on_error: bool = False,
) -> DataFrame:
    """Rows of all JSON files under ``path``, including nested folders.

    A bad record stops the read, or is skipped with ``continue_on_error``; :func:`bad_records`
    counts those. ``auto`` looks at the files first, once. A folder of one format is read by its path;
    for mixed folders the names of the files per format come to the driver, which holds the file
    index of a scan anyway. Files of an object or an array are read by one task each; for large arrays
    see :func:`tidemill.sources.json_arrays.array_scan`.
    """
    if file_format not in FORMATS:
        raise ValueError(f"unknown JSON format {file_format}")
    mode = "DROPMALFORMED" if continue_on_error else "FAILFAST"
    if file_format != "auto":
        return _read(spark, path, file_format, pattern, schema, mode)
    noted = scratch_path(spark, "json-formats")
    _formats(spark, path, pattern).write.parquet(noted)
    found = spark.read.schema("file STRING, format STRING, size LONG").parquet(noted)
    largest = {r["format"]: r["size"] for r in found.groupBy("format").agg(F.max("size").alias("size")).collect()}
    kinds = sorted(largest)
    if len(kinds) <= 1:
        return _read(spark, path, kinds[0] if kinds else "ndjson", pattern, schema, mode)
    frames = []
    for kind in kinds:
        files = [unquote(r["file"]) for r in found.filter(F.col("format") == kind).select("file").collect()]
        frames.append(_listed(spark, sorted(files), largest[kind], kind, pattern, schema, mode))
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def bad_records(spark: SparkSession, path: str, pattern: str = "*.json") -> int:
    """Lines with text that are not JSON, over line-by-line files."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(path)
    text = F.trim("value")
    return lines.filter((text != "") & F.try_parse_json(text).isNull()).count()
