"""Cleaning, normalising, filtering and simple aggregates on ratings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_ratings(
    df: DataFrame,
    user: str | Column,
    item: str | Column,
    rating: str | Column,
    ts: str | Column,
    names: Sequence[str] = ("user", "item", "rating", "ts"),
) -> DataFrame:
    """Any table with the four roles as a canonical ratings table."""
    roles = [F.col(c) if isinstance(c, str) else c for c in (user, item, rating, ts)]
    return df.select(*[role.alias(name) for role, name in zip(roles, names)])


def clean_activity(
    df: DataFrame, drop: Mapping[str, Sequence], above: Mapping[str, float] | None = None
) -> DataFrame:
    """Drop rows holding any of the listed values, and rows not above a threshold.

    NULLs never pass. Text values compare with the column as text, so a flag may
    be stored as a boolean or as 'true'/'false'.
    """
    for name, values in drop.items():
        for value in values:
            col = F.col(name).cast("string") if isinstance(value, str) else F.col(name)
            df = df.filter(col != F.lit(value))
    for name, threshold in (above or {}).items():
        df = df.filter(F.col(name) > threshold)
    return df


def shift_days(
    df: DataFrame, n: int, id_step: int, ts_step: int, item: str = "item", ts: str = "ts"
) -> DataFrame:
    """The same rows ``n`` days later: new item ids, later epoch timestamps."""
    return df.withColumns(
        {item: F.col(item) + F.lit(n * id_step), ts: F.col(ts) + F.lit(n * ts_step)}
    )


def append_all(*dfs: DataFrame) -> DataFrame:
    """Bag union by column name."""
    return reduce(lambda left, right: left.unionByName(right), dfs)


def active_items(df: DataFrame, t, item: str = "item", ts: str = "ts") -> DataFrame:
    """Distinct items with an interaction strictly after ``t``."""
    return df.filter(F.col(ts) > _literal(t)).select(item).distinct()


def cold_items(df: DataFrame, t, item: str = "item", ts: str = "ts") -> DataFrame:
    """Items active after ``t`` with no interaction at or before it."""
    first = df.groupBy(item).agg(F.min(ts).alias("_first"))
    return first.filter(F.col("_first") > _literal(t)).select(item)


def distinct_keys(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def group_counts(df: DataFrame, key: str, counted: str, out: str = "group_count") -> DataFrame:
    """Non-null values of ``counted`` per key."""
    return df.groupBy(key).agg(F.count(counted).alias(out))


def split_summary(**splits: DataFrame) -> DataFrame:
    """Rows and columns of each named split."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("split"), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_cols")
        )
        for name, df in splits.items()
    ]
    return append_all(*parts)


def order_ratings(df: DataFrame, user: str = "user", item: str = "item") -> DataFrame:
    return df.orderBy(user, item)


def head_rows(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows; ``order`` must be total for a repeatable answer."""
    return df.orderBy(*order).limit(n)


def best_run(
    metrics: DataFrame, metric: str, minimise: bool = True, run: str = "run_id"
) -> DataFrame:
    """The run with the best value of ``metric``; ties go to the smaller run id."""
    value = F.col("value") if minimise else -F.col("value")
    rows = metrics.filter(F.col("metric") == metric)
    best = rows.agg(F.min(F.struct(value.alias("_v"), F.col(run), F.col("value"))).alias("_best"))
    return best.select(F.col(f"_best.{run}").alias(run), F.col("_best.value").alias("value"))


def _literal(t) -> Column:
    return t if isinstance(t, Column) else F.lit(t)
