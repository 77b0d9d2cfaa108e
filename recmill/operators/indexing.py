"""Label indexing that keeps the label table distributed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from recmill.operators.skew import HEAVY_LIMIT, HEAVY_ROWS, lookup_join, rank_in_group
from recmill.sources.scratch import materialise


def label_index(df: DataFrame, col: str, min_rows: int = HEAVY_ROWS) -> DataFrame:
    """(label, index, n): labels numbered from 0 by falling frequency n, ties by text.

    Labels never visit the driver, so there may be as many as memory on the whole
    cluster allows.
    """
    labels = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("label"))
    counts = materialise(labels.agg(F.count(F.lit(1)).alias("n")), "labels")
    order = [F.col("n").desc(), F.col("label").cast("string")]
    ranked = rank_in_group(counts, [], order, "_rank", min_rows=min_rows)
    return ranked.select("label", (F.col("_rank") - 1).cast("int").alias("index"), "n")


def heavy_labels(index: DataFrame, col: str, min_rows: int = HEAVY_ROWS) -> list[Row]:
    """The heavy labels of the rows the index was built on, read off the index."""
    most = index.filter(F.col("n") > min_rows).orderBy(F.col("n").desc()).limit(HEAVY_LIMIT)
    return most.select(F.col("label").alias(col)).collect()


def apply_index(
    df: DataFrame,
    index: DataFrame,
    col: str,
    out: str,
    min_rows: int = HEAVY_ROWS,
    heavy: Sequence[Row] | None = None,
) -> DataFrame:
    """Add the index of ``col``; an unknown or NULL label gets the number of labels.

    ``heavy`` may name the heavy labels of ``df``, as :func:`heavy_labels` does for
    the rows the index was built on; otherwise they are counted.
    """
    # NULL labels meet nothing, and may be many: a second key spreads them by where they come from
    spread = "_spread"
    while spread in (*df.columns, out):
        spread = f"_{spread}"
    named = index.select(F.col("label").alias(col), F.col("index").alias(out), F.col("label").isNull().cast("int").alias(spread))
    spared = F.when(F.col(col).isNull(), F.spark_partition_id() + 1).otherwise(0).alias(spread)
    joined = lookup_join(df.select("*", spared), named, [col, spread], "left", min_rows, heavy)
    unknown = index.agg(F.count(F.lit(1)).cast("int")).scalar()
    return joined.select(*df.columns, F.coalesce(F.col(out), unknown).alias(out))


def index_column(df: DataFrame, col: str, out: str, min_rows: int = HEAVY_ROWS) -> DataFrame:
    """Index ``col`` by its own labels."""
    index = materialise(label_index(df, col, min_rows), "index")
    return apply_index(df, index, col, out, min_rows, heavy_labels(index, col, min_rows))
