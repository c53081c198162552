"""Cleaning of text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import title_words, trim_unicode

CASES = {"lower": F.lower, "upper": F.upper, "title": title_words}

# Text that is a time stamp as a whole, such as 2024-01-15T10:30:00Z.
TIME_STAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?$"


def passthrough(df: DataFrame) -> DataFrame:
    return df


def clean_data(
    df: DataFrame,
    remove_nulls: bool = False,
    trim_strings: bool = False,
    normalize_case: str | None = None,
    subset: Sequence[str] | None = None,
    keep_time_stamps: bool = True,
) -> DataFrame:
    """Trim and re-case text columns and drop rows with NULLs; other columns are untouched.

    An unknown case name changes nothing. Text that is an ISO time stamp keeps its letters, so that
    a later step can still take its date: Spark reads T and Z only in upper case. ``subset`` narrows
    which columns must be present. No change makes or removes a NULL, so rows are dropped first: the
    test then runs on the stored columns, inside the scan where the format allows it.
    """
    kept = df
    if remove_nulls:
        for name in subset or df.columns:
            kept = kept.filter(F.col(f"`{name}`").isNotNull())
    recase = CASES.get(normalize_case or "")
    changes = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            text = F.col(f"`{field.name}`")
            text = trim_unicode(text) if trim_strings else text
            if recase:
                changed = recase(text)
                text = F.when(text.rlike(TIME_STAMP), text).otherwise(changed) if keep_time_stamps else changed
            if trim_strings or recase:
                changes[field.name] = text
    return kept.withColumns(changes) if changes else kept
