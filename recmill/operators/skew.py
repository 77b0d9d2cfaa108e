"""Per-group ranks, counts and lookups that stay even when one key is huge.

A key is *heavy* when it holds more than ``HEAVY_ROWS`` rows, however large the table
is. Up to ``HEAVY_LIMIT`` of them are listed, so the list is safe to broadcast; where
more are found, all rows take the route of heavy ones. Heavy keys are looked for in a
sample of the key column, so finding them costs a scan and next to no shuffle; store a
costly input first. They only choose the route a row takes: every row is still
processed, and the result does not depend on what the sample holds. Without heavy
keys every operator here is the plain one-shuffle form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recmill.sources.scratch import materialise

HEAVY_ROWS = 10_000_000
HEAVY_LIMIT = 10_000
GLOBAL_ROWS = 1_000_000  # most rows ranked as one group by one task
SHARES = 16  # copies of a looked-up row where too many keys are heavy to list them
SEEN_ROWS = 1_000
CERTAINTY = 0.8  # six standard deviations below SEEN_ROWS
SAMPLE_SEED = 42
ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def heavy_keys(
    df: DataFrame,
    keys: Sequence[str],
    min_rows: int = HEAVY_ROWS,
    limit: int = HEAVY_LIMIT,
) -> list[Row]:
    """The largest groups with more than ``min_rows`` rows, at most ``limit`` of them.

    The sample is sized to see a group of ``min_rows`` rows ``SEEN_ROWS`` times, and
    the threshold leaves room for chance; a small ``min_rows`` counts every row.
    ``_rows`` is the (estimated) size. No ``keys`` means one group over all rows.
    """
    if not keys:
        rows = df.count()
        return [Row(_rows=rows)] if rows > min_rows else []
    fraction = min(1.0, SEEN_ROWS / min_rows)
    seen = df.select(*keys) if fraction == 1.0 else df.select(*keys).sample(fraction, seed=SAMPLE_SEED)
    threshold = min_rows if fraction == 1.0 else SEEN_ROWS * CERTAINTY
    counts = seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > threshold)
    estimate = F.ceil(F.col("_rows") / fraction).alias("_rows")
    return counts.orderBy(F.desc("_rows")).limit(limit).select(*keys, estimate).collect()


def _heavy_table(df: DataFrame, keys: Sequence[str], heavy: Sequence[Row]) -> DataFrame:
    schema = df.select(*keys).schema
    return df.sparkSession.createDataFrame([tuple(row[k] for k in keys) for row in heavy], schema)


def _semi(df: DataFrame, table: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    table = F.broadcast(table.select(*[F.col(k).alias(f"_heavy_{k}") for k in keys]))
    condition = F.lit(True)
    for k in keys:
        condition = condition & df[k].eqNullSafe(table[f"_heavy_{k}"])
    return df.join(table, condition, how)


def split_heavy(
    df: DataFrame, keys: Sequence[str], heavy: Sequence[Row]
) -> tuple[DataFrame, DataFrame]:
    """(rows of heavy keys, all other rows); neither side is shuffled."""
    if not keys:
        return df, df.limit(0)
    table = _heavy_table(df, keys, heavy)
    return _semi(df, table, keys, "left_semi"), _semi(df, table, keys, "left_anti")


def _sorted_rank(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    out: str,
    counted: str | None,
    count_out: str,
    few_keys: bool = True,
) -> DataFrame:
    """Row number within ``keys`` by ``order``, with no group held by one task.

    One range sort over (keys, order) spreads a group over as many partitions as
    it needs. A row's rank is its place inside its partition plus the rows of the
    group in earlier partitions. Where ``df`` holds listed heavy keys only, there are at
    most ``HEAVY_LIMIT`` keys plus one boundary per partition among those offsets, which
    makes them safe to broadcast; otherwise they are joined by partition and key.
    ``order`` must be total within a group.
    """
    keys = list(keys)
    ordered = df.orderBy(*keys, *order).withColumn("_id", F.monotonically_increasing_id())
    ordered = materialise(ordered, "sorted")
    part = F.shiftright("_id", ROW_BITS)
    pieces = ordered.groupBy(*keys, part.alias("_part")).agg(
        F.min("_id").alias("_first"),
        F.count(F.lit(1)).alias("_rows"),
        F.count(counted if counted is not None else F.lit(1)).alias("_counted"),
    )
    group = Window.partitionBy(*(keys or [F.lit(0)]))
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_part").alias("_k_part"),
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_counted").over(group).alias("_counted"),
    )
    condition = part == F.col("_k_part")
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    ranked = ordered.join(F.broadcast(offsets) if few_keys else offsets, condition, "inner")
    counts = [F.col("_counted").alias(count_out)] if counted is not None else []
    return ranked.select(*df.columns, (F.col("_id") + F.col("_shift") + 1).alias(out), *counts)


def rank_in_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    out: str = "rank",
    counted: str | None = None,
    count_out: str = "group_count",
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Add the row number within ``keys``, and optionally ``count(counted)`` per key.

    No ``keys`` means one group over all rows.
    """
    keys = list(keys)
    group = keys or [F.lit(0)]
    heavy = heavy_keys(df, keys, min_rows if keys else min(min_rows, GLOBAL_ROWS), HEAVY_LIMIT)
    if len(heavy) >= HEAVY_LIMIT:  # a full list may leave heavy keys out: then all rows are ranked by sorting
        return _sorted_rank(df, keys, order, out, counted, count_out, few_keys=False)
    hot, cold = split_heavy(df, keys, heavy) if heavy else (None, df)

    by_group = Window.partitionBy(*group)
    out_cols = [F.row_number().over(by_group.orderBy(*order)).cast("long").alias(out)]
    if counted is not None:
        out_cols.append(F.count(counted).over(by_group).alias(count_out))
    plain = cold.select("*", *out_cols)
    if hot is None:
        return plain

    ranked = _sorted_rank(hot, keys, order, out, counted, count_out)
    return ranked.unionByName(plain) if keys else ranked


def count_in_group(
    df: DataFrame, keys: Sequence[str], counted: str, out: str, min_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Add ``count(counted)`` of the row's group."""
    keys = list(keys)
    heavy = heavy_keys(df, keys, min_rows, HEAVY_LIMIT)
    full = len(heavy) >= HEAVY_LIMIT  # the list may leave heavy keys out: then all rows meet their counts by join
    hot, cold = (df, df.limit(0)) if full else split_heavy(df, keys, heavy) if heavy else (None, df)
    plain = cold.withColumn(out, F.count(counted).over(Window.partitionBy(*keys)))
    if hot is None:
        return plain
    counts = hot.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.count(counted).alias(out))
    counts = materialise(counts, "counts") if full else F.broadcast(counts)
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    found = hot.join(counts, condition, "inner").select(*df.columns, out)
    return found if full else found.unionByName(plain)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str | Sequence[str],
    how: str = "inner",
    min_rows: int = HEAVY_ROWS,
    heavy: Sequence[Row] | None = None,
) -> DataFrame:
    """Join ``left`` to a table with one row per ``key``.

    Rows of a heavy key meet their single right row by broadcast and never move;
    all other rows take the join Spark chooses. Where the list of heavy keys is full, it may
    leave some out: then each row of the table is repeated ``SHARES`` times, and the rows of a
    key are shared among the copies by the partition they come from. ``how`` is inner or left. A caller
    that already knows the heavy keys of ``left`` passes them. Of several key columns the
    first one is the key that may be heavy, and the others only spread its rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if heavy is None:
        heavy = heavy_keys(left, keys[:1], min_rows, HEAVY_LIMIT)
    if not heavy:
        return left.join(right, keys, how)
    if len(heavy) >= HEAVY_LIMIT:
        share = "_share"
        while share in left.columns or share in right.columns:
            share = f"_{share}"
        shared = left.withColumn(share, F.pmod(F.spark_partition_id(), F.lit(SHARES)))
        copies = right.withColumn(share, F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
        return shared.join(copies, [*keys, share], how).drop(share)
    hot, cold = split_heavy(left, keys[:1], heavy)
    few = _semi(right, _heavy_table(left, keys[:1], heavy), keys[:1], "left_semi")
    return hot.join(F.broadcast(few), keys, how).unionByName(cold.join(right, keys, how))
