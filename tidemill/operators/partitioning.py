"""Partition keys as columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SLOT = re.compile(r"\{(\d+)\}")
_CALENDAR = ("year", "month", "day")


def _filled(template: str, values: list[Column]) -> Column:
    """The template with each ``{i}`` replaced by value i; unknown slots stay as they are."""
    pieces, last = [], 0
    for slot in _SLOT.finditer(template):
        if int(slot.group(1)) < len(values):
            pieces += [F.lit(template[last : slot.start()]), values[int(slot.group(1))]]
            last = slot.end()
    return F.concat(*pieces, F.lit(template[last:]))


def add_partition(
    df: DataFrame,
    partition_by: Sequence[str],
    partition_format: str = "",
    processing_date: Column | None = None,
) -> DataFrame:
    """Add ``partition_key`` and ``partition_date`` (text, the processing date in UTC).

    The key joins the values by ``/`` or fills ``{0}``, ``{1}`` of the format. A format without
    slots is a date pattern if the first column is a date or time, or if the columns are year,
    month and day; otherwise it is a constant. Missing columns and NULLs read ``unknown``.
    """
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    values = [
        F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("unknown"))
        if name.lower() in types
        else F.lit("unknown")
        for name in partition_by
    ]
    first = types.get(partition_by[0].lower()) if partition_by else None
    if not partition_format:
        key = F.concat_ws("/", *values) if values else F.lit("")
    elif _SLOT.search(partition_format):
        key = _filled(partition_format, values)
    elif isinstance(first, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        key = F.coalesce(F.date_format(F.col(f"`{partition_by[0]}`"), partition_format), F.lit("unknown"))
    elif tuple(n.lower() for n in partition_by) == _CALENDAR and all(n in types for n in _CALENDAR):
        day = F.try_make_timestamp(*[F.col(n).cast("int") for n in _CALENDAR], F.lit(0), F.lit(0), F.lit(0))
        key = F.coalesce(F.date_format(day, partition_format), F.lit("unknown"))
    else:
        key = F.lit(partition_format)
    today = F.current_timestamp() if processing_date is None else processing_date
    return df.withColumns({"partition_key": key, "partition_date": F.date_format(today, "yyyy-MM-dd")})
