"""Draws that depend on a row's key and a seed only, never on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX_DIGITS = 8
_RANGE = 16**_HEX_DIGITS


def digest(cols: Sequence[str | Column], seed: int | str) -> Column:
    """md5 of the columns and the seed joined by '-'."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.md5(F.concat_ws("-", *[p.cast("string") for p in parts], F.lit(str(seed))))


def draw(cols: Sequence[str | Column], seed: int | str) -> Column:
    """An integer, uniform in [0, 2^32)."""
    return F.conv(F.substring(digest(cols, seed), 1, _HEX_DIGITS), 16, 10).cast("long")


def unit_draw(cols: Sequence[str | Column], seed: int | str) -> Column:
    """A double, uniform in [0, 1)."""
    return draw(cols, seed) / F.lit(float(_RANGE))
