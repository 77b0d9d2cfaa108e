"""Concordant pairs per user, counted without ever listing a pair."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recmill.operators.skew import HEAVY_LIMIT, heavy_keys, rank_in_group, split_heavy
from recmill.sources.scratch import materialise

STRIP_ROWS = 2_000_000  # points one task counts at a time
STRIPS = 1_000  # most strips one user's ranks are cut into
TASK_ROWS = 500_000  # rows, about, that one task takes where users are dealt to tasks
COUNT_TYPE = "decimal(18,0)"
TOTAL_TYPE = "decimal(38,0)"


def concordant(group: np.ndarray, a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> int:
    """Weighted number of pairs of one group with a_i > a_j and b_i > b_j.

    Sorting ties in ``a`` by falling ``b``, and ties in ``b`` by falling position,
    leaves only strict pairs in ascending order. They are counted bit by bit: two
    values that first differ in a bit are ascending when the earlier one has a 0.
    """
    n = len(a)
    if n < 2:
        return 0
    order = np.lexsort((-b, a, group))
    group, b, weight = group[order], b[order], weight[order]
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    place = np.arange(n) - np.repeat(starts, np.diff(np.r_[starts, n]))
    rank = np.empty(n, dtype=np.int64)
    rank[np.lexsort((-place, b, group))] = np.arange(n)
    node = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, n]))
    rank -= np.repeat(starts, np.diff(np.r_[starts, n]))

    total = 0
    width = int(rank.max()).bit_length()
    for level in range(width - 1, -1, -1):
        one = (rank >> level) & 1 == 1
        zeros = np.cumsum(np.where(one, 0, weight))
        first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        before = np.repeat(zeros[first] - np.where(one[first], 0, weight[first]),
                           np.diff(np.r_[first, n]))
        total += int(np.dot(zeros[one] - before[one], weight[one]))
        node = node * 2 + one
        order = np.argsort(node, kind="stable")
        node, rank, weight = node[order], rank[order], weight[order]
    return total


def differing(group: np.ndarray, a: np.ndarray, weight: np.ndarray) -> int:
    """Weighted number of pairs of one group with a_i != a_j."""

    def pairs(*keys: np.ndarray) -> int:
        order = np.lexsort(keys)
        new = np.zeros(len(order), dtype=bool)
        for key in keys:
            new[1:] |= key[order][1:] != key[order][:-1]
        sizes = np.add.reduceat(weight[order], np.r_[0, np.flatnonzero(new)])
        return int(np.dot(sizes, sizes))

    return (pairs(group) - pairs(a, group)) // 2


def _tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Count group by group; rows arrive sorted by group, and a group may span batches."""
    held: list[pd.DataFrame] = []

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        codes = pdf.groupby(["user", "strip"], sort=False).ngroup().to_numpy()
        a, b, weight = (pdf[c].to_numpy() for c in ("a", "b", "weight"))
        found, pairs = concordant(codes, a, b, weight), differing(codes, a, weight)
        return pd.DataFrame({"concordant": [str(found)], "n_pairs": [str(pairs)]})

    for pdf in batches:
        if not len(pdf):
            continue
        last = pdf[["user", "strip"]].iloc[-1]
        open_rows = ((pdf["user"] == last["user"]) & (pdf["strip"] == last["strip"])).to_numpy()
        if held and not open_rows.all():
            held.append(pdf[~open_rows])
            yield count(pd.concat(held))
            held = []
        elif not open_rows.all():
            yield count(pdf[~open_rows])
        elif held:
            previous = held[-1].iloc[-1]
            if previous["user"] != last["user"] or previous["strip"] != last["strip"]:
                yield count(pd.concat(held))
                held = []
        held.append(pdf[open_rows])
    if held:
        yield count(pd.concat(held))


def _dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` by ``keys`` in as many tasks as its size asks for.

    A count that is given is not coalesced, so what a task holds does not grow with the table.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)), *keys)


def _counted(placed: DataFrame) -> DataFrame:
    """Concordant and label-differing pairs inside each (user, strip), as partial totals; no strip is in two tasks."""
    return placed.sortWithinPartitions("user", "strip").mapInPandas(_tally, "concordant string, n_pairs string")


def _averaged(rows: DataFrame) -> DataFrame:
    """One point per user and item."""
    points = rows.groupBy("user", "item").agg(F.avg("label").alias("label"), F.avg("prediction").alias("prediction"))
    return points.dropna(subset=["user", "label", "prediction"])


def _strips(points: DataFrame, largest: int, min_rows: int) -> DataFrame:
    """Cut every user's points into strips no larger than one task should take.

    With pos = rank by label and q = rank by prediction (ties placed so that they
    never count), a pair is either in one pos-strip, or in one q-strip but
    different pos-strips, or differs in both; the last kind depends only on how
    many points each cell of the strip grid holds. Users with one strip need only
    the first kind.
    """
    size = max(min_rows, -(-largest // STRIPS))
    by_label = [F.col("label"), F.col("prediction").desc(), F.col("item")]
    pos = rank_in_group(points, ["user"], by_label, "pos", "user", "n", min_rows=min_rows)
    by_prediction = [F.col("prediction"), F.col("pos").desc()]
    both = rank_in_group(pos, ["user"], by_prediction, "q", min_rows=min_rows)
    both = both.select(
        "user",
        "n",
        "pos",
        "q",
        F.floor((F.col("pos") - 1) / size).alias("pos_strip"),
        F.floor((F.col("q") - 1) / size).alias("q_strip"),
    )
    both = materialise(both, "ranks")
    cut = both.filter(F.col("n") > size)
    one = F.lit(1).cast("long").alias("weight")
    cells = cut.groupBy("user", "pos_strip", "q_strip").agg(F.count(F.lit(1)).alias("weight"))

    def strip(kind: str, number, a: str, b: str, weight, df: DataFrame) -> DataFrame:
        name = F.concat_ws("-", F.lit(kind), number)
        return df.select(
            "user",
            name.alias("strip"),
            F.col(a).cast("double").alias("a"),
            F.col(b).cast("double").alias("b"),
            weight,
        )

    return (
        strip("pos", F.col("pos_strip"), "pos", "q", one, both)
        .unionByName(strip("q", F.col("q_strip"), "pos_strip", "q", one, cut))
        .unionByName(strip("cells", F.lit(0), "pos_strip", "q_strip", F.col("weight"), cells))
    )


def _whole(points: DataFrame) -> DataFrame:
    """Every user as a single strip."""
    return points.select(
        "user",
        F.lit("").alias("strip"),
        F.col("label").alias("a"),
        F.col("prediction").alias("b"),
        F.lit(1).cast("long").alias("weight"),
    )


def fcp(
    df: DataFrame,
    user: str = "user",
    label: str = "label",
    prediction: str = "prediction",
    item: str = "item",
    min_rows: int = STRIP_ROWS,
) -> DataFrame:
    """Fraction of concordant pairs: one row (fcp, n_pairs).

    Over pairs of one user's items with different labels, the share ordered the
    same way by the prediction. Repeated (user, item) rows are averaged first.
    Each user's points are sorted, never paired up.
    """
    named = df.select(
        F.col(user).alias("user"),
        F.col(item).alias("item"),
        F.col(label).alias("label"),
        F.col(prediction).alias("prediction"),
    )
    named = named.dropna(subset=["user"])
    stored = materialise(named, "scored")
    rows = stored.count()
    # A table that the cores hold anyway is averaged as it comes, a larger one in tasks of bounded size.
    small = rows <= TASK_ROWS * df.sparkSession.sparkContext.defaultParallelism

    # A user has no more points than rows, so only large users in the rows call for a closer look.
    heavy = heavy_keys(stored, ["user"], min_rows, limit=1)
    if heavy:
        points = materialise(_averaged(named if small else _dealt(stored, rows, "user", "item")), "points")
        heavy = heavy_keys(points, ["user"], min_rows, HEAVY_LIMIT)
        whole = _dealt(_whole(points), rows, "user")
    elif small:
        whole = _dealt(_whole(_averaged(named)), rows, "user")
    else:
        whole = _whole(_averaged(_dealt(stored, rows, "user")))
    if not heavy:
        totals = _totals(_counted(whole))
    else:
        hot, cold = points, points.limit(0)
        if len(heavy) < HEAVY_LIMIT:  # a full list may leave large users out: then all are cut
            hot, cold = split_heavy(points, ["user"], heavy)
        strips = _dealt(_strips(hot, heavy[0]["_rows"], min_rows), 2 * rows, "user", "strip")
        found = _counted(strips).select("concordant", F.lit("0").alias("n_pairs"))
        totals = _totals(found.unionByName(_counted(_dealt(_whole(cold), rows, "user"))).unionByName(_pairs_of(hot)))
    share = F.try_divide(F.col("concordant").cast("double"), F.col("n_pairs").cast("double"))
    return totals.select(share.alias("fcp"), "n_pairs")


def _totals(partial: DataFrame) -> DataFrame:
    sums = [F.coalesce(F.sum(F.col(c).cast(TOTAL_TYPE)), F.lit(0)) for c in ("concordant", "n_pairs")]
    return partial.agg(*[total.cast(TOTAL_TYPE).alias(c) for total, c in zip(sums, ("concordant", "n_pairs"))])


def _pairs_of(points: DataFrame) -> DataFrame:
    """Pairs with different labels, from the sizes of users and of their label groups."""
    by_label = points.groupBy("user", "label").agg(F.count(F.lit(1)).alias("n"))
    square = F.col("n").cast(COUNT_TYPE) * F.col("n").cast(COUNT_TYPE)
    by_user = by_label.groupBy("user").agg(F.sum("n").alias("n"), F.sum(square).alias("ties"))
    pairs = (F.sum(square) - F.sum("ties")) / 2
    return by_user.agg(F.lit("0").alias("concordant"), pairs.cast(TOTAL_TYPE).cast("string").alias("n_pairs"))
