"""Small text and expression helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z and nothing else. Plain ASCII texts take Spark's faster lower()."""
    plain = F.octet_length(col) == F.char_length(col)
    return F.when(plain, F.lower(col)).otherwise(F.translate(col, UPPER, UPPER.lower()))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once.

    A plain column that a lambda refers to may be inlined by the optimizer, and then be
    evaluated again for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
