"""Topic to table: parse messages, apply SQL, evolve the table's schema, append."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..operators.sql import sql_transform
from ..schema import infer_schema, schema_from_config
from ..schema.spec import infers
from ..sinks.landed import LandedTable, SchemaLog
from ..sources.json_values import parse_json, split_json
from .ingest import each_batch


def parse_messages(
    batch: DataFrame, schema_config: Mapping | None = None, log: SchemaLog | None = None
) -> DataFrame:
    """Typed rows of a batch of JSON messages, by the configured or the inferred schema.

    With a log, an inferring topic remembers every field it has seen: a batch in which a field
    happens to be missing still has the column, and a widened type stays wide.
    """
    if not infers(schema_config):
        fixed = schema_from_config(schema_config or {})
        if not fixed.fields:
            raise ValueError("no schema available: declare fields or set auto_infer")
        return parse_json(batch, fixed)
    found = infer_schema(batch)
    if log is not None:
        found = log.evolve(found, True)[1] if found.fields else log.current() or found
    return parse_json(batch, found)


@dataclass
class TopicTable:
    """Loads one topic into one landed table. Each message batch is a load that a replay replaces.

    Messages that are no JSON objects are left out, or kept with a reason under ``dead_letters``.
    """

    root: str
    schema_config: Mapping | None = None
    sql: str | None = None
    evolve: bool = False
    partition_by: Sequence[str] = field(default_factory=tuple)
    dead_letters: str | None = None

    def load(self, batch: DataFrame, load_id: str, then: Callable[[DataFrame], None] | None = None) -> None:
        """One batch: an inferring topic reads it twice, so it is kept for the duration. ``then`` gets
        the rows of the load as the table has them."""
        batch = batch.persist()
        try:
            if self.dead_letters:
                _, bad = split_json(batch)
                bad.write.mode("overwrite").json(f"{self.dead_letters}/load_id={load_id}")
            log = SchemaLog(batch.sparkSession, f"{self.root}/messages")
            rows = parse_messages(batch, self.schema_config, log)
            if not rows.columns:
                return
            if self.sql:
                rows = sql_transform(rows, self.sql)
            if rows.isEmpty():
                return
            table = LandedTable(batch.sparkSession, self.root, self.partition_by)
            table.append(rows, load_id, self.evolve)
            if then is not None:
                then(table.read_load(load_id))
        finally:
            batch.unpersist()

    def start(self, stream: DataFrame, checkpoint: str, name: str, every: str | None = None):
        return each_batch(stream, self.load, checkpoint, name, every)
