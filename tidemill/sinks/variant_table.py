"""JSON messages landed without a schema: a VARIANT column, and typed views over it.

Each load keeps the messages as they came and notes the shape of its own messages, one aggregate per
load. The schema of the table is merged from the shapes when it is read, so a field that first appears in
a later load is there for all rows, and no load is written anew.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema.evolve import merge_schemas
from ..schema.infer import schema_of_shape
from .landed import LandedTable, read_log

MESSAGE = "message"
_SHAPES = "shape STRING, load_id STRING"


def _path(name: str) -> str | None:
    """A field's path; a name with both kinds of quotes has none."""
    for quote in "'\"":
        if quote not in name:
            return f"$[{quote}{name}{quote}]"
    return None


class VariantTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.table = LandedTable(spark, f"{self.root}/messages")

    def load(self, messages: DataFrame, load_id: str, value: str = "value") -> None:
        """Add messages (JSON text) as one load; the same id again replaces it. Text that is no JSON
        object is kept beside them, see :meth:`rejects`."""
        text = F.col(f"`{value}`")
        parsed = F.when(F.ltrim(text).startswith("{"), F.try_parse_json(text))
        rows = messages.select(parsed.alias(MESSAGE), F.when(parsed.isNull(), text).alias("rejected"))
        self.table.append(rows, load_id)
        # Of the rows as they were written: a stream is read once.
        own = self.table.read_load(load_id)
        shape = own.agg(F.schema_of_variant_agg(MESSAGE).alias("shape"))
        shape.coalesce(1).write.mode("overwrite").json(f"{self.root}/shapes/load_id={load_id}")

    def schema(self, keep_objects: bool = False) -> T.StructType:
        """The merged schema of all loads; only the different shapes come to the driver."""
        shapes = read_log(self.spark, f"{self.root}/shapes", _SHAPES).where("shape is not null")
        shapes = shapes.join(self.table.loads_logged(), "load_id", "left_semi")
        first = shapes.groupBy("shape").agg(F.min("load_id").alias("at")).orderBy("at", "shape")
        found = [schema_of_shape(r["shape"], keep_objects) for r in first.collect()]
        return reduce(merge_schemas, found, T.StructType([]))

    def messages(self) -> DataFrame:
        return self.table.read().where(F.col(MESSAGE).isNotNull()).select(MESSAGE)

    def rejects(self) -> DataFrame:
        """(rejected) with the text of messages that are no JSON objects."""
        return self.table.read().where(F.col(MESSAGE).isNull()).select("rejected")

    def typed(self, schema: T.StructType | None = None) -> DataFrame:
        """The messages' top fields as columns, by a schema or the merged one. A value that does not fit is NULL;
        nested values that the schema has as text are JSON."""
        schema = schema or self.schema()
        columns = []
        for field in schema.fields:
            path = _path(field.name)
            if path is None:
                column = F.lit(None).cast(field.dataType)
            elif isinstance(field.dataType, T.StringType):
                # A cast of text, and of scalars; objects and arrays as their JSON.
                held = F.try_variant_get(MESSAGE, path, "variant")
                column = F.coalesce(F.try_variant_get(MESSAGE, path, "string"), F.to_json(held))
            else:
                column = F.try_variant_get(MESSAGE, path, field.dataType.simpleString())
            columns.append(column.alias(field.name))
        return self.messages().select(*columns)
