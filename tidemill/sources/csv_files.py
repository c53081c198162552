"""CSV files matched by a glob."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAGGED = "_ragged_row"

# Types tried on all values, narrowest first; a column that fits none is text.
CANDIDATES = (
    T.LongType(),
    T.DoubleType(),
    T.BooleanType(),
    T.DateType(),
    T.TimestampType(),
)
_DATE_TEXT = r"^\d{4}-\d{2}-\d{2}$"
_BOOL_TEXT = r"(?i)^(true|false)$"


def _fits(column: Column, data_type: T.DataType) -> Column:
    cast = column.try_cast(data_type).isNotNull()
    if isinstance(data_type, T.DateType):
        return column.rlike(_DATE_TEXT) & cast
    if isinstance(data_type, T.BooleanType):
        return column.rlike(_BOOL_TEXT)
    return cast


def _infer(text: DataFrame) -> T.StructType:
    """Column types that every row fits, by one aggregate over all files; empty fields fit any type
    and a column with nothing but empty fields is text."""
    tests = [
        F.bool_and(F.when(F.col(f"`{name}`").isNotNull(), _fits(F.col(f"`{name}`"), t))).alias(f"{i}_{j}")
        for i, name in enumerate(text.columns)
        for j, t in enumerate(CANDIDATES)
    ]
    verdict = text.agg(*tests).first()
    fields = []
    for i, name in enumerate(text.columns):
        fitting = [t for j, t in enumerate(CANDIDATES) if verdict[f"{i}_{j}"]]
        fields.append(T.StructField(name, fitting[0] if fitting else T.StringType()))
    return T.StructType(fields)


def csv_scan(
    spark: SparkSession,
    path: str,
    has_header: bool = False,
    schema: T.StructType | None = None,
    bad_rows: str = "drop",
    **options: str,
) -> DataFrame:
    """Rows of all files matching ``path`` under one schema.

    Fields are read as text and cast by expressions. Spark's own DROPMALFORMED mode judges only
    the columns a query happens to use, so the same row would count in one query and not in
    another; a filter on the casts always gives the same rows. ``bad_rows``: ``drop`` leaves out
    rows that do not fit the schema (``csv_rejects`` gives them), ``null`` keeps them with NULLs,
    ``fail`` raises when such a row is met. Without a schema all files are read once more to find
    types that every row fits, so only rows with a wrong number of fields are bad. A glob without match raises Spark's PATH_NOT_FOUND. Columns of files without
    header are named ``col_0``, ``col_1``, ...
    """
    if bad_rows not in ("drop", "null", "fail"):
        raise ValueError(f"unknown bad_rows mode {bad_rows}")
    # Whole rows are judged unless all are kept: only then may Spark parse just the columns in use.
    text, names, target = _as_text(spark, path, has_header, schema, options, pruned=bad_rows == "null")

    def typed(field: T.StructField) -> Column:
        raw = F.col(f"`{names[target.fields.index(field)]}`")
        if isinstance(field.dataType, T.StringType):
            return raw
        return raw.cast(field.dataType) if bad_rows == "fail" else raw.try_cast(field.dataType)

    rows = text
    if bad_rows == "drop":
        rows = text.filter(_reason(names, target).isNull())
    return rows.select(*[typed(f).alias(f.name) for f in target.fields])


def csv_rejects(
    spark: SparkSession, path: str, has_header: bool = False, schema: T.StructType | None = None, **options: str
) -> DataFrame:
    """The rows that ``csv_scan`` drops, as text, with ``reason``: the first column that does not fit,
    or the number of fields."""
    text, names, target = _as_text(spark, path, has_header, schema, options, pruned=False)
    rejected = text.withColumn("reason", _reason(names, target)).filter(F.col("reason").isNotNull())
    return rejected.select(*[F.col(f"`{n}`").alias(f.name) for n, f in zip(names, target.fields)], "reason")


def _as_text(spark, path, has_header, schema, options, pruned) -> tuple[DataFrame, list[str], T.StructType]:
    """All fields as text, their names in the files, and the schema they are meant to have."""
    reader = spark.read.options(header=str(has_header).lower(), **options)
    names = reader.csv(path).columns
    if not has_header:
        names = [f"col_{i}" for i in range(len(names))]
    layout = T.StructType([T.StructField(n, T.StringType()) for n in names])

    def read(pruned: bool, layout: T.StructType) -> DataFrame:
        return (
            reader.option("mode", "PERMISSIVE")
            .option("columnPruning", str(pruned).lower())
            .option("columnNameOfCorruptRecord", RAGGED)
            .option("enforceSchema", "true")
            .schema(layout)
            .csv(path)
        )

    target = schema if schema is not None else _infer(read(True, layout))
    marked = T.StructType([*layout.fields, T.StructField(RAGGED, T.StringType())])
    return read(pruned, layout if pruned else marked), names, target


def _reason(names: list[str], target: T.StructType) -> Column:
    """Why a row does not fit, or NULL. It looks at a real column in any case: Spark refuses CSV
    scans that use nothing but the corrupt-record column, as a bare count would."""
    ragged = F.col(RAGGED).isNotNull() & (F.length(F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))) >= 0)
    reasons = [F.when(ragged, F.lit("wrong number of fields"))]
    for name, field in zip(names, target.fields):
        if not isinstance(field.dataType, T.StringType):
            raw = F.col(f"`{name}`")
            misfit = raw.isNotNull() & raw.try_cast(field.dataType).isNull()
            reasons.append(F.when(misfit, F.lit(f"{field.name} is no {field.dataType.simpleString()}")))
    return F.coalesce(*reasons)
