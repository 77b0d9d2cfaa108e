"""Column-level operators: selections, derived columns, nested access."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

RECOMMENDATIONS_TYPE = "array<struct<itemId:bigint,rating:double>>"


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def index_name(col: str) -> str:
    """``userId`` -> ``userIndex``."""
    return col.replace("Id", "Index")


def with_expr(df: DataFrame, expr: str, out: str) -> DataFrame:
    """All columns plus one SQL expression."""
    return SQLTransformer(statement=f"SELECT *, {expr} AS {out} FROM __THIS__").transform(df)


def first_entity(df: DataFrame, path: str, out: str) -> DataFrame:
    """Name of the first struct in the array at ``path``; NULL when there is none."""
    return df.withColumn(out, F.get(F.col(path), 0)["name"])


def join_lines(df: DataFrame, path: str, out: str) -> DataFrame:
    """Text of all line structs at ``path``, one per line; NULL in, NULL out.

    A line without text counts as empty, so no line is lost.
    """
    texts = F.transform(F.col(path), lambda line: F.coalesce(line["text"], F.lit("")))
    return df.withColumn(out, F.array_join(texts, "\n"))


def recommended_items(df: DataFrame, col: str = "recommendations", out: str = "items") -> DataFrame:
    """The item ids of every recommendation list."""
    return df.withColumn(out, F.col(col)["itemId"])


def zip_recommendations(items: str | Column, ratings: str | Column) -> Column:
    """Two parallel arrays as one array of typed (itemId, rating) structs."""
    return F.arrays_zip(items, ratings).cast(RECOMMENDATIONS_TYPE)


def apply_udf(
    df: DataFrame,
    fn: Callable[[pd.Series], pd.Series],
    in_col: str,
    out_col: str,
    return_type: DataType | str,
) -> DataFrame:
    """Apply a Series-to-Series function to one column, in Arrow batches."""
    return df.withColumn(out_col, F.pandas_udf(fn, return_type)(F.col(in_col)))


def epoch_seconds(col: str | Column) -> Column:
    """Seconds since 1970 of a timestamp."""
    col = F.col(col) if isinstance(col, str) else col
    return F.unix_timestamp(col.cast("timestamp"))
