"""Bucketing by ordered limits, the shape most of the reports share.

Each function takes ``(limit, label)`` pairs and returns the label of the first limit that holds.
A NULL value holds for none and gets the last label.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Limits = Sequence[tuple[float, str]]


def first_match(cases: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """The label of the first condition that is true."""
    (condition, label), *rest = cases
    chain = reduce(lambda c, case: c.when(case[0], F.lit(case[1])), rest, F.when(condition, F.lit(label)))
    return chain.otherwise(F.lit(otherwise))


def below(value: Column, limits: Limits, otherwise: str) -> Column:
    return first_match([(value < F.lit(x), label) for x, label in limits], otherwise)


def at_least(value: Column, limits: Limits, otherwise: str) -> Column:
    return first_match([(value >= F.lit(x), label) for x, label in limits], otherwise)


def at_most(value: Column, limits: Limits, otherwise: str) -> Column:
    return first_match([(value <= F.lit(x), label) for x, label in limits], otherwise)
