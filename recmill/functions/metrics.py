"""Rating error and ranking metrics.

Per user, P is the list of distinct predicted items in score order and L the set
of distinct true items. Neither L nor any user-item pair list is ever collected:
rows of both sides meet by one grouping on (user, item), and a user keeps only
the sizes and the positions of the hits, which number at most k.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recmill.functions.pairs import STRIP_ROWS, fcp

# The names results are reported under.
RANKING_METRICS = ("ndcgAt", "map", "recallAtK", "mrr", "fcp")


def rmse(df: DataFrame, label: str = "rating", prediction: str = "prediction") -> DataFrame:
    """Root of the mean squared error, one row."""
    error = F.col(label).cast("double") - F.col(prediction)
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def ranking_frame(
    recs: DataFrame,
    truth: DataFrame,
    k: int,
    user: str = "user",
    item: str = "item",
    rec_item: str = "itemId",
) -> DataFrame:
    """One row per user that has both predictions and true items.

    ``recs`` has (user, recommendations array<struct>), best first; lists are cut
    to ``k``. Columns: the user, ``prediction`` (at most k items), ``hits``
    (1-based positions of the true ones) and ``n_labels`` (size of L).
    """
    listed = F.slice(F.array_distinct(F.col(f"recommendations.{rec_item}")), 1, k)
    predicted = recs.select(user, F.posexplode(listed).alias("_pos", item))
    predicted = predicted.select(user, item, (F.col("_pos") + 1).alias("_pos"), F.lit(0).alias("_true"))
    true = truth.select(user, item, F.lit(None).cast("int").alias("_pos"), F.lit(1).alias("_true"))
    true = true.filter(F.col(item).isNotNull())
    pairs = true.unionByName(predicted).groupBy(user, item)
    pairs = pairs.agg(F.min("_pos").alias("_pos"), F.max("_true").alias("_true"))

    hit = F.when(F.col("_true") == 1, F.col("_pos"))
    placed = F.when(F.col("_pos").isNotNull(), F.struct("_pos", item))
    users = pairs.groupBy(user).agg(
        F.sort_array(F.collect_list(placed))[item].alias("prediction"),
        F.sort_array(F.collect_list(hit)).alias("hits"),
        F.sum("_true").alias("n_labels"),
    )
    return users.filter((F.col("n_labels") > 0) & (F.size("prediction") > 0))


def label_lists(truth: DataFrame, user: str = "user", item: str = "item", parts: int = 1) -> DataFrame:
    """Each user's true items as sorted lists (user, part, labels).

    The items are dealt to ``parts`` lists by a hash, the same way for every user and at
    every size: a caller whose users may have too many items for one row asks for more
    parts. Parts without items are left out, and nothing else.
    """
    part = F.pmod(F.xxhash64(item), F.lit(parts)).cast("long").alias("part")
    lists = truth.select(user, item).dropna().groupBy(user, part)
    return lists.agg(F.sort_array(F.collect_set(item)).alias("labels"))


def _hits(k: int) -> Column:
    return F.filter("hits", lambda position: position <= k)


def _discount(position: Column) -> Column:
    return F.lit(1.0) / F.log2(position + 1.0)


def _mean(value: Column, name: str) -> Column:
    return F.avg(value).alias(name)


def _ndcg(k: int) -> Column:
    gains = [0.0]
    for position in range(1, k + 1):
        gains.append(gains[-1] + 1.0 / math.log2(position + 1))
    ideal = F.get(F.array(*[F.lit(g) for g in gains]), F.least("n_labels", F.lit(k)).cast("int"))
    gained = F.aggregate(_hits(k), F.lit(0.0), lambda total, p: total + _discount(p))
    return gained / ideal


def _average_precision(k: int) -> Column:
    precision = F.transform(_hits(k), lambda position, i: (i + 1.0) / position)
    return F.aggregate(precision, F.lit(0.0), lambda total, p: total + p) / F.col("n_labels")


def _recall(k: int) -> Column:
    return F.size(_hits(k)) / F.col("n_labels")


def _reciprocal_rank(k: int) -> Column:
    return F.coalesce(F.lit(1.0) / F.get(_hits(k), 0), F.lit(0.0))


_PER_USER = {
    "ndcgAt": _ndcg,
    "map": _average_precision,
    "recallAtK": _recall,
    "mrr": _reciprocal_rank,
}


def ndcg_at(frame: DataFrame, k: int) -> DataFrame:
    """Binary-gain NDCG over the first ``k`` positions; the ideal has min(|L|, k) hits."""
    return frame.agg(_mean(_ndcg(k), "ndcgAt"))


def mean_average_precision(frame: DataFrame, k: int) -> DataFrame:
    """Precision at each hit, summed and divided by |L|."""
    return frame.agg(_mean(_average_precision(k), "map"))


def recall_at(frame: DataFrame, k: int) -> DataFrame:
    """Share of L among the first ``k`` positions."""
    return frame.agg(_mean(_recall(k), "recallAtK"))


def mrr(frame: DataFrame, k: int) -> DataFrame:
    """Reciprocal position of the first hit, 0 without one."""
    return frame.agg(_mean(_reciprocal_rank(k), "mrr"))


def ranking_metrics(
    frame: DataFrame,
    k: int,
    names: Sequence[str] = RANKING_METRICS,
    scored: DataFrame | None = None,
    strip_rows: int = STRIP_ROWS,
) -> DataFrame:
    """All named metrics as (metric, value) rows, in one pass over ``frame``.

    ``fcp`` is about scores rather than lists, so it needs ``scored``: rows of
    (user, item, label, prediction).
    """
    listed = [name for name in names if name in _PER_USER]
    wide = frame.agg(*[_mean(_PER_USER[name](k), name) for name in listed])
    table = wide.unpivot([], listed, "metric", "value") if listed else None
    if "fcp" in names and scored is not None:
        pairs = fcp(scored, min_rows=strip_rows).select(F.lit("fcp").alias("metric"), F.col("fcp").alias("value"))
        table = pairs if table is None else table.unionByName(pairs)
    return table
