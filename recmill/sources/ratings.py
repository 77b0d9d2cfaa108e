"""Readers and in-memory constructors for ratings tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StringType, StructType

from recmill.sources.scratch import materialise

RATINGS_SCHEMA = "user INT, item INT, rating FLOAT, ts TIMESTAMP"


def read_ratings_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """Comma-separated ratings with a header; blanks around values are trimmed.

    Without a schema the types are inferred, which reads the files once more.
    """
    reader = spark.read.options(
        header=True, sep=",", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True
    )
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_activity_json(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """JSON-lines activity log."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path)


def read_checked(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "csv",
    required: Sequence[str] = (),
    header: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected lines) of CSV or JSON-lines files, which are parsed once.

    A line is *malformed* where a value does not fit its type, or where it has fewer or more values
    than ``schema`` (JSON: where it is no object); a row without one of the ``required`` columns is
    *incomplete*. The rejected have columns file, line and reason; the line of an incomplete row is the row
    as JSON. Good rows and rejected lines together are all lines but empty ones.
    """
    fields = StructType.fromDDL(schema).fields if isinstance(schema, str) else schema.fields
    names = [f.name for f in fields]
    bad, file = "_line", "_file"
    while {bad, file} & {n.lower() for n in names}:
        bad, file = f"_{bad}", f"_{file}"
    read = StructType([*fields, StructField(bad, StringType())])
    reader = spark.read.schema(read).options(mode="PERMISSIVE", columnNameOfCorruptRecord=bad)
    if fmt == "csv":
        reader = reader.options(header=header, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    elif fmt != "json":
        raise ValueError(f"csv or json, not {fmt}")
    lines = reader.format(fmt).load(path).withColumn(file, F.col("_metadata.file_path"))
    parsed = materialise(lines, "parsed")
    incomplete = F.lit(False)
    for name in required:
        incomplete = incomplete | F.col(name).isNull()
    reason = F.when(F.col(bad).isNotNull(), "malformed").when(incomplete, "incomplete")
    good = parsed.filter(reason.isNull()).select(*names)
    line = F.coalesce(F.col(bad), F.to_json(F.struct(*names)))
    rejected = parsed.filter(reason.isNotNull())
    return good, rejected.select(F.col(file).alias("file"), line.alias("line"), reason.alias("reason"))


def ratings_from_rows(
    spark: SparkSession, rows: Iterable[tuple], schema: StructType | str = RATINGS_SCHEMA
) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def ratings_from_pandas(spark: SparkSession, pdf: pd.DataFrame) -> DataFrame:
    return spark.createDataFrame(pdf)


def page_offsets(spark: SparkSession, pages: int = 100, per_page: int = 10) -> DataFrame:
    """One request row per result page: 0, per_page, 2 * per_page, ..."""
    return spark.range(pages).select((F.col("id") * per_page).alias("offset"))


def page_offsets_by(df: DataFrame, key: str, per_page: int = 10) -> DataFrame:
    """(key, offset): the request rows that cover each key's rows, ``per_page`` at a time."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    starts = F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(per_page).cast("long"))
    return sizes.select(key, F.explode(starts).alias("offset"))
