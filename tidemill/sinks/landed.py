"""Landed tables: append-only Parquet roots with a schema history and a log of loads.

Layout under the table's root::

    data/load_id=<id>/schema_id=<n>/<partition columns>/*.parquet
    unfit/load_id=<id>/*.json         values that did not fit their column's type, as text
    schemas/schema_id=<n>/*.json      one row per schema version
    loads/load_id=<id>/*.json         one row per load

A load replaces its own folder, so repeating it (a replayed micro-batch, a retried job) leaves one
copy. A load counts from the moment it is in the log: readers leave out folders that are not. This is
a Parquet layout with an audit, no table format; where a table format with its own catalog is configured, ``append_to_catalog`` is the
shorter way.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import running_totals
from ..schema import SchemaMismatch, check_strict, conform, merge_schemas
from ..schema.evolve import promote
from .files import partitioned

_TRIES = 40
_UNFIT = "column_name STRING, value STRING, row STRING"
_VERSIONS = "schema_id INT, struct STRING, committed_at STRING"
_LOADS = (
    "load_id STRING, committed_at STRING, operation STRING, schema_id INT, "
    "added_files BIGINT, added_records BIGINT, added_bytes BIGINT, unfit_values BIGINT, "
    "min_time TIMESTAMP_NTZ, max_time TIMESTAMP_NTZ"
)


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


class SchemaLog:
    """The versions of a schema, one small folder each: ``{root}/schema_id=<n>``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def versions(self) -> list[tuple[int, T.StructType, str]]:
        """All versions, oldest first."""
        log = read_log(self.spark, self.root, _VERSIONS)
        rows = sorted(log.collect(), key=lambda row: row["schema_id"])
        return [(r["schema_id"], T.StructType.fromJson(json.loads(r["struct"])), r["committed_at"]) for r in rows]

    def current(self) -> T.StructType | None:
        known = self.versions()
        return known[-1][1] if known else None

    def evolve(self, incoming: T.StructType, allowed: bool) -> tuple[int, T.StructType]:
        """The version to use for rows that come with ``incoming``. The first one is registered;
        later, new columns and widened types make a new version if allowed, else an error, rather
        than being lost silently. So does a type that the column cannot take in. Where another writer
        registers the same number first, its version is the one to go on from."""
        for _ in range(_TRIES):
            try:
                return self._evolve(incoming, allowed)
            except AnalysisException as taken:
                if taken.getCondition() != "PATH_ALREADY_EXISTS":
                    raise
                time.sleep(0.5)
        return self._evolve(incoming, allowed)

    def _evolve(self, incoming: T.StructType, allowed: bool) -> tuple[int, T.StructType]:
        known = self.versions()
        if not known:
            return self.register(1, _relaxed(incoming))
        current_id, current, _ = known[-1]
        merged = _relaxed(merge_schemas(current, incoming))
        retyped = [f.name for f in unfit_fields(current, incoming)]
        if retyped and not allowed:
            raise SchemaMismatch(f"{self.root}: schema evolution is off and rows change the type of {retyped}")
        if merged == _relaxed(current):
            return current_id, current
        if not allowed:
            raise SchemaMismatch(f"{self.root}: schema evolution is off and the rows change the schema")
        return self.register(current_id + 1, merged)

    def register(self, schema_id: int, schema: T.StructType) -> tuple[int, T.StructType]:
        """A version's folder is written once: of two writers adding the same number one fails."""
        row = self.spark.range(1).select(
            F.lit(schema.json()).alias("struct"), F.lit(_now()).alias("committed_at")
        )
        row.coalesce(1).write.mode("errorifexists").json(f"{self.root}/schema_id={schema_id}")
        return schema_id, schema


def evolve_to_log(df: DataFrame, log: SchemaLog, auto_infer: bool = False, strict_mode: bool = False) -> DataFrame:
    """Conform rows to a registered schema that lives on from run to run and batch to batch.

    The first rows register theirs. After that strict mode raises on any difference, ``auto_infer``
    widens the registered schema, and otherwise columns it does not know are dropped.
    """
    registered = log.current()
    if registered is None:
        registered = log.evolve(df.schema, True)[1]
    if strict_mode:
        check_strict(df.schema, registered)
    return conform(df, log.evolve(df.schema, True)[1] if auto_infer else registered)


class LandedTable:
    """``event_time`` names a column whose least and greatest value the log has for each load."""

    def __init__(
        self, spark: SparkSession, root: str, partition_by: Sequence[str] = (), event_time: str | None = None
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_by = list(partition_by)
        self.event_time = event_time
        self.schemas = SchemaLog(spark, f"{self.root}/schemas")

    def schema(self) -> T.StructType | None:
        return self.schemas.current()

    # loads

    def append(self, df: DataFrame, load_id: str | None = None, evolve: bool = False) -> str:
        """Add rows as one load and log it; the same ``load_id`` again replaces that load.

        With ``evolve``, a value of another type that does not fit its column is NULL there; its text
        is kept under ``unfit`` with the whole row, and the log has the number of such values.
        """
        load = load_id or uuid.uuid4().hex
        schema_id, schema = self.schemas.evolve(df.schema, evolve)
        rows = partitioned(conform(df, schema), self.partition_by).withColumn("schema_id", F.lit(schema_id))
        target = f"{self.root}/data/load_id={load}"
        # Observed last before the write, in the writing tasks: of a retried task one attempt counts.
        seen = Observation()
        time_of = F.lit(None)
        if self.event_time is not None and self.event_time in rows.columns:
            time_of = F.col(f"`{self.event_time}`")
        time_of = time_of.cast("timestamp_ntz")
        (
            rows.observe(
                seen,
                F.count(F.lit(1)).alias("records"),
                F.min(time_of).cast("string").alias("min_time"),
                F.max(time_of).cast("string").alias("max_time"),
            )
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("schema_id", *self.partition_by)
            .parquet(target)
        )
        unfit = 0
        if fields := unfit_fields(schema, df.schema):
            place = f"{self.root}/unfit/load_id={load}"
            unfit_values(df, schema, fields).write.mode("overwrite").json(place)
            unfit = self.spark.read.schema(_UNFIT).json(place).count()
        self._log_load(load, target, schema_id, unfit, seen.get)
        return load

    def unfit(self) -> DataFrame:
        """(load_id, column_name, value, row) of all values that did not fit their columns."""
        return self._logged(read_log(self.spark, f"{self.root}/unfit", f"{_UNFIT}, load_id STRING"))

    def _log(self) -> DataFrame:
        return read_log(self.spark, f"{self.root}/loads", _LOADS)

    def _logged(self, rows: DataFrame, loads: DataFrame | None = None) -> DataFrame:
        """Rows of loads that the log has; ``load_id`` is a partition column, so others are not read."""
        return rows.join((self._log() if loads is None else loads).select("load_id"), "load_id", "left_semi")

    def _log_load(self, load: str, target: str, schema_id: int, unfit: int, seen: dict) -> None:
        """Log what the write observed, and the files that were committed; the files are listed, not read."""
        files = (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .load(target)
        )
        summary = files.agg(
            F.count(F.lit(1)).alias("added_files"),
            F.lit(seen["records"]).cast("bigint").alias("added_records"),
            F.coalesce(F.sum("length"), F.lit(0)).alias("added_bytes"),
        ).select(
            F.lit(_now()).alias("committed_at"),
            F.lit("append").alias("operation"),
            F.lit(schema_id).alias("schema_id"),
            "*",
            F.lit(unfit).cast("bigint").alias("unfit_values"),
            *[F.lit(seen[c]).cast("timestamp_ntz").alias(c) for c in ("min_time", "max_time")],
        )
        summary.coalesce(1).write.mode("overwrite").json(f"{self.root}/loads/load_id={load}")

    def loads(self) -> DataFrame:
        """The load log with snapshot numbers, parents and running totals."""
        log = self._log()
        numbered = running_totals(log, ["committed_at", "load_id"], "added_records", "snapshot_id", "total_records")
        parent = F.when(F.col("snapshot_id") > 1, F.col("snapshot_id") - 1)
        return numbered.select("snapshot_id", parent.alias("parent_id"), *log.columns, "total_records")

    def loads_logged(self) -> DataFrame:
        """(load_id) of the loads that count."""
        return self._log().select("load_id")

    # reading

    def read_load(self, load_id: str) -> DataFrame:
        """The rows of one load under the current schema."""
        return self._read(load_id)

    def read(self, since=None, until=None) -> DataFrame:
        """All rows under the current schema; of a table with ``event_time`` those from ``since`` and before ``until``.

        Each version's files are read with the schema they were written under and then cast:
        Parquet columns cannot be read as every wider type. Versions are few; partition columns
        stay partition columns, so filters on them prune. Loads that are not in the log don't count,
        and loads whose times the log has outside of the limits are not opened.
        """
        if since is None and until is None:
            return self._read("*")
        if self.event_time is None:
            raise ValueError("a table is read by time only if it has an event_time")
        loads, time_of = self._log(), F.col(f"`{self.event_time}`").cast("timestamp_ntz")
        inside = F.lit(True)
        # A load without times was logged when the table had no event_time, or has none that is not null.
        # Plain comparisons with the log's times let Spark prune the loads' folders when it joins.
        unknown = [F.lit(x).cast("timestamp_ntz") for x in ("9999-12-31", "0001-01-01")]
        if since is not None:
            since = F.lit(since).cast("timestamp_ntz")
            loads, inside = loads.where(F.coalesce("max_time", unknown[0]) >= since), inside & (time_of >= since)
        if until is not None:
            until = F.lit(until).cast("timestamp_ntz")
            loads, inside = loads.where(F.coalesce("min_time", unknown[1]) < until), inside & (time_of < until)
        return self._read("*", loads).where(inside)

    def read_loads(self, loads: DataFrame) -> DataFrame:
        """The rows of some loads, given by a column ``load_id``, if the log has them."""
        return self._read("*", self._log().join(loads.select("load_id"), "load_id", "left_semi"))

    def _read(self, load: str, loads: DataFrame | None = None) -> DataFrame:
        known = self.schemas.versions()
        if not known:
            raise FileNotFoundError(f"no landed table at {self.root}")
        current = known[-1][1]
        result = None
        for schema_id, schema, _ in known:
            try:
                part = (
                    self.spark.read.option("basePath", f"{self.root}/data")
                    .schema(T.StructType([*schema.fields, T.StructField("load_id", T.StringType())]))
                    .parquet(f"{self.root}/data/load_id={load}/schema_id={schema_id}")
                )
            except AnalysisException as missing:
                if missing.getCondition() != "PATH_NOT_FOUND":
                    raise
                continue
            part = conform(self._logged(part, loads), current)
            result = part if result is None else result.unionByName(part)
        return result if result is not None else self.spark.createDataFrame([], current)


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A log of small JSON rows, empty while nothing was logged."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def unfit_fields(table: T.StructType, incoming: T.StructType) -> list[T.StructField]:
    """Incoming columns whose type the table's column cannot take in as it is or by widening."""
    known = {f.name.lower(): f.dataType for f in table.fields}
    return [
        f
        for f in incoming.fields
        if f.name.lower() in known
        and not isinstance(f.dataType, T.NullType)
        and not isinstance(known[f.name.lower()], T.StringType)
        and promote(f.dataType, known[f.name.lower()]) != known[f.name.lower()]
    ]


def unfit_values(df: DataFrame, table: T.StructType, fields: Sequence[T.StructField]) -> DataFrame:
    """(column_name, value, row) of the values that are lost in a cast to the table's types."""
    known = {f.name.lower(): f.dataType for f in table.fields}
    lost = []
    for field in fields:
        column = F.col(f"`{field.name}`")
        gone = column.isNotNull() & column.try_cast(known[field.name.lower()]).isNull()
        entry = F.struct(F.lit(field.name).alias("column_name"), column.cast("string").alias("value"))
        lost.append(F.when(gone, entry))
    found = F.filter(F.array(*lost), lambda x: x.isNotNull())
    return df.select(F.inline(found), F.to_json(F.struct("*")).alias("row"))


def _relaxed(schema: T.StructType) -> T.StructType:
    """The same columns, all nullable: files written before a column existed have no value for it."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


LOAD = "load_id"


def append_to_catalog(df: DataFrame, table: str, load_id: str | None = None) -> None:
    """Append to a table of the session's catalogs, by column name, creating it on first use.

    With a ``load_id`` the rows are the table's partition of that name, in a column ``load_id``, and replace what it
    has: a load that is written again, as by a replayed micro-batch, leaves one copy. Rows without
    an id go to such a table as a load of their own.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    if load_id is None and (not exists or LOAD not in spark.table(table).columns):
        df.write.mode("append").saveAsTable(table)
        return
    load = load_id or uuid.uuid4().hex
    rows = df.withColumn(LOAD, F.lit(load))
    if not exists:
        _create_by_load(rows.limit(0), table)
    known = spark.table(table).columns
    if LOAD not in known:
        raise SchemaMismatch(f"{table} has no column {LOAD} to replace a load by")
    if other := {c.lower() for c in rows.columns} ^ {c.lower() for c in known}:
        raise SchemaMismatch(f"{table} and the rows differ in columns {sorted(other)}")
    rows = rows.select(*[F.col(f"`{c}`") for c in known])
    if _is_session_table(spark, table):
        # The rows' own partitions are replaced, the others stay.
        mode, earlier = "spark.sql.sources.partitionOverwriteMode", None
        earlier = spark.conf.get(mode)
        spark.conf.set(mode, "dynamic")
        try:
            rows.write.mode("overwrite").insertInto(table)
        finally:
            spark.conf.set(mode, earlier)
    else:
        rows.writeTo(table).overwrite(F.col(LOAD) == load)


def _is_session_table(spark: SparkSession, table: str) -> bool:
    """Whether a table is of Spark's own catalog and not of a configured one, with a table format of its own."""
    parts = table.split(".")
    catalog = parts[0] if len(parts) > 2 else spark.catalog.currentCatalog()
    return catalog == "spark_catalog" and spark.conf.get("spark.sql.catalog.spark_catalog", None) is None


def _create_by_load(empty: DataFrame, table: str) -> None:
    if _is_session_table(empty.sparkSession, table):
        empty.write.partitionBy(LOAD).saveAsTable(table)
    else:
        empty.writeTo(table).partitionedBy(F.col(LOAD)).create()
