"""What several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: A key is hot when it holds more than 1 of this many rows, so there are fewer hot keys than this:
#: the proven bound of what ``skewed_join`` broadcasts.
HOT_SHARE = 1000

#: The column of ``numbered``: a name of this run, which no table can have by chance.
ROW = f"row_{uuid.uuid4().hex}"

#: Rows of an Arrow batch handed to Python: texts are long, and a batch is held in memory whole.
BATCH_ROWS = 256

_SHIPPED: set[str] = set()


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: lineage ends here, and its rows no longer change."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a row number in ROW, as a table in the shared folder; as it is if it has one.

    A second scan of a table may cut its files elsewhere, say after an executor is lost, and then
    counts other places. What looks rows up by number takes decision and rows from this one table.
    """
    if ROW in docs.columns:
        return docs
    path = scratch_path(docs.sparkSession, "numbered")
    own = docs.withColumn(ROW, F.monotonically_increasing_id())
    own.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(own.schema).parquet(path)


def row_number(docs: DataFrame) -> Column:
    """The row number that ``numbered`` gave, else the place in this scan."""
    return F.col(ROW) if ROW in docs.columns else F.monotonically_increasing_id()


def python_tasks(spark: SparkSession) -> None:
    """Prepare the session for this subpackage's Python tasks.

    Workers get the package as a zip that the driver serves, so nothing need be installed on them,
    and small Arrow batches, since texts of any length share a batch.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) != BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        place = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
        with zipfile.ZipFile(place, "w") as archive:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, file.relative_to(package.parent))
        context.addPyFile(str(place))
        _SHIPPED.add(context.applicationId)


def named(name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(taken: list[str], name: str) -> str:
    """A name like ``name`` that is none of those taken, in any case."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name += "_"
    return name


def full_text(column: str = "text") -> Column:
    """The whole text, empty for null."""
    return F.coalesce(F.col(column), F.lit(""))


def hot_keys(counts: DataFrame, key: list[str], count: str, total: int) -> DataFrame:
    """Keys holding over 1 of HOT_SHARE of ``total`` rows; ``counts`` has one row per key."""
    return counts.where(F.col(count) * HOT_SHARE > total).select(*key)


def skewed_join(rows: DataFrame, table: DataFrame, key: list[str], hot: DataFrame, how: str = "inner") -> DataFrame:
    """Join ``rows``, where a key may be very frequent, with ``table``, which has each key once.

    Rows of the hot keys (fewer than HOT_SHARE of them, see ``hot_keys``) meet a broadcast, so they
    are not shuffled; the others are joined as Spark sees fit. ``rows`` is read twice: give a
    written table or a cheap scan. ``how`` is ``inner`` or ``left``.
    """
    few = F.broadcast(table.join(F.broadcast(hot), key, "left_semi"))
    at_once = rows.join(F.broadcast(hot), key, "left_semi").join(few, key, how)
    others = rows.join(F.broadcast(hot), key, "left_anti").join(table, key, how)
    return at_once.unionByName(others)


def named_key(column: str) -> Column:
    """A text key that keeps null apart from every value, so that joins and groups can use it."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def unit(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts only."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))
