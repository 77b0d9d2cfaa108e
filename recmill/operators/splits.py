"""Train/test splits: by recency, per user, by hash, by sample and by fold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recmill.functions.hashing import digest, draw, unit_draw
from recmill.operators.skew import HEAVY_ROWS, count_in_group, rank_in_group


def with_group_count(
    df: DataFrame, key: str, counted: str, out: str = "group_count", min_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Each row with the count of non-null ``counted`` of its group.

    Rows without a key are dropped, as an inner join with the counts would.
    """
    return count_in_group(df.filter(F.col(key).isNotNull()), [key], counted, out, min_rows)


def _total(df: DataFrame, first: Sequence[str]) -> list[str]:
    """``first`` and every other column that can be ordered: only equal rows tie on all of them."""
    def orderable(kind) -> bool:
        return "map<" not in kind.simpleString() and kind.simpleString() not in ("variant", "void")

    return [*first, *(f.name for f in df.schema if f.name not in first and orderable(f.dataType))]


def _newest_first(ts: str, tiebreak: Sequence[str]) -> list[Column]:
    return [F.col(ts).desc(), *[F.col(c).asc() for c in tiebreak]]


def recency_rank(
    df: DataFrame,
    key: str,
    ts: str,
    tiebreak: Sequence[str],
    out: str = "rank",
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """1 for the newest row of each key; rows without a time come last."""
    return rank_in_group(df, [key], _newest_first(ts, tiebreak), out, min_rows=min_rows)


def recency_fraction(
    df: DataFrame,
    key: str,
    ts: str,
    tiebreak: Sequence[str],
    out: str = "fraction",
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Recency rank divided by the number of timed rows of the key.

    Rows without a time are ranked but not counted, so their fraction exceeds 1;
    a key with no timed row at all gets NULL. Rows without a key are dropped.
    """
    keyed = df.filter(F.col(key).isNotNull())
    ranked = rank_in_group(
        keyed, [key], _newest_first(ts, tiebreak), "_rank", ts, "_count", min_rows=min_rows
    )
    return ranked.withColumn(out, F.try_divide("_rank", "_count")).drop("_rank", "_count")


def chrono_side(
    df: DataFrame,
    ratio: float = 0.75,
    filter_by: str = "user",
    col_user: str = "user",
    col_item: str = "item",
    col_timestamp: str = "ts",
    tiebreak: Sequence[str] = (),
    newest_left: bool = True,
    out: str = "side",
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Label each row 'left' or 'right' of the chronological split.

    The newest ``ratio`` of every user's (or item's) rows go left; with
    ``newest_left=False`` the oldest do. Rows of a key with no timed row are in
    neither side and are dropped. ``tiebreak`` should name a row within its key; without
    it all columns decide, so that only equal rows can change places. Write the labelled
    table once when both sides are needed: the split is then computed once.
    """
    key = col_user if filter_by == "user" else col_item
    ties = list(tiebreak) or _total(df, [col_item if filter_by == "user" else col_user])
    if newest_left:
        share = recency_fraction(df, key, col_timestamp, ties, "_share", min_rows)
    else:
        keyed = df.filter(F.col(key).isNotNull())
        oldest = [F.col(col_timestamp).asc_nulls_last(), *[F.col(c) for c in ties]]
        ranked = rank_in_group(
            keyed, [key], oldest, "_rank", col_timestamp, "_count", min_rows=min_rows
        )
        share = ranked.withColumn("_share", F.try_divide("_rank", "_count"))
        share = share.drop("_rank", "_count")
    side = F.when(F.col("_share") <= ratio, "left").otherwise("right")
    return share.filter(F.col("_share").isNotNull()).withColumn(out, side).drop("_share")


def chrono_split(df: DataFrame, ratio: float = 0.75, **options) -> tuple[DataFrame, DataFrame]:
    """(left, right) of :func:`chrono_side`, which lists the options."""
    sided = chrono_side(df, ratio, out="_side", **options)
    left = sided.filter(F.col("_side") == "left").drop("_side")
    right = sided.filter(F.col("_side") == "right").drop("_side")
    return left, right


def random_split(
    df: DataFrame, weights: Sequence[float] = (0.75, 0.25), seed: int = 123
) -> list[DataFrame]:
    """Spark's random split; the draw depends on the partitioning."""
    return df.randomSplit(list(weights), seed=seed)


def hash_split(
    df: DataFrame, key: Sequence[str], ratio: float = 0.75, seed: int = 123
) -> tuple[DataFrame, DataFrame]:
    """Random split decided by each row's key alone, so it never changes."""
    left = unit_draw(key, seed) < ratio
    return df.filter(left), df.filter(~left)


def sample_rows(df: DataFrame, fraction: float = 0.75, seed: int = 123) -> DataFrame:
    """Bernoulli sample without replacement."""
    return df.sample(False, fraction, seed)


_SLICE_DIGITS = 4


def sample_exact(
    df: DataFrame,
    fraction: float,
    key: Sequence[str],
    seed: int = 123,
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Exactly floor(fraction * rows) rows: those with the smallest key digests.

    ``key`` must be unique. The digest's first digits cut the rows into even
    slices; whole slices below the cut are kept by a filter, and only the slice
    the cut falls in is ranked, so nothing is sorted globally.
    """
    code = F.conv(F.substring(digest(key, seed), 1, _SLICE_DIGITS), 16, 10).cast("long")
    sizes = df.groupBy(code.alias("_slice")).count().orderBy("_slice").collect()
    wanted = int(fraction * sum(row["count"] for row in sizes) + 1e-9)
    taken, cut = 0, 16**_SLICE_DIGITS
    for row in sizes:
        if taken + row["count"] > wanted:
            cut = row["_slice"]
            break
        taken += row["count"]
    whole = df.filter(code < cut)
    if taken == wanted:
        return whole
    edge = rank_in_group(
        df.filter(code == cut), [], [digest(key, seed)], "_rank", min_rows=min_rows
    )
    return whole.unionByName(edge.filter(F.col("_rank") <= wanted - taken).drop("_rank"))


def user_ratio_split(
    df: DataFrame,
    ratio: float = 0.8,
    user: str = "user",
    item: str = "item",
    seed: int = 42,
    key: Sequence[str] | None = None,
    min_rows: int = HEAVY_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(train, validation), drawing ``ratio`` of every user's rows for training.

    ``key`` names a row within the whole table; by default user, item and all other columns
    that can be ordered do, so that only equal rows can change places.
    """
    named = list(key or [user, item])
    key = list(key or _total(df, named))
    keyed = df.filter(F.col(user).isNotNull()).withColumn("_draw", digest(named, seed))
    order = [F.col("_draw"), *[F.col(c) for c in key]]
    ranked = rank_in_group(keyed, [user], order, "_rank", user, "_count", min_rows=min_rows)
    train = F.col("_rank") / F.col("_count") <= ratio
    helpers = ("_draw", "_rank", "_count")
    return ranked.filter(train).drop(*helpers), ranked.filter(~train).drop(*helpers)


def fold_column(
    df: DataFrame, key: Sequence[str], k: int = 3, seed: int = 42, out: str = "fold"
) -> DataFrame:
    """Assign each row to one of ``k`` folds by its key."""
    return df.withColumn(out, (draw(key, seed) % k).cast("int"))
