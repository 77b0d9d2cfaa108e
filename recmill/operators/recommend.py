"""Top-k recommendation for all users, for active items, and cold-item exposure."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recmill.functions.columns import RECOMMENDATIONS_TYPE
from recmill.functions.hashing import digest, draw, unit_draw
from recmill.operators.prep import active_items
from recmill.operators.skew import HEAVY_ROWS, rank_in_group
from recmill.sources.scratch import materialise

BLOCK_ROWS = 65_536  # users, about, that meet a block of items in one task
ITEM_FACTOR = 4  # an item block is larger by this, as every user is sent once per item block
FEW_USERS, MANY_BLOCKS = 2048, 24  # fewer users than would fill this many blocks are dealt in smaller ones
MANY_ITEM_BLOCKS = 4  # beyond these counts blocks grow instead, up to BLOCK_FLOATS, and are sent no more often
BLOCK_FLOATS = 16_000_000  # most factors of a block, about
_BLOCK_USERS = 512
_BLOCK_ITEMS = 2048
_NORM_ROWS = 65_536
_SLACK = 1e-6  # relative rounding of a product, for each factor


def popularity(df: DataFrame, item: str = "item", out: str = "score") -> DataFrame:
    """Number of interactions per item: a baseline scorer that ignores the user."""
    return df.groupBy(item).agg(F.count(F.lit(1)).alias(out))


def top_list(scores: DataFrame, k: int, item: str = "item", score: str = "score") -> DataFrame:
    """One row holding the ``k`` best (itemId, rating) structs, ties by item."""
    best = scores.orderBy(F.col(score).desc(), F.col(item)).limit(k)
    entry = F.struct((-F.col(score)).alias("_s"), F.col(item).alias("_i"), F.col(score).alias("_r"))
    ranked = F.sort_array(F.collect_list(entry))
    typed = F.transform(ranked, lambda e: F.struct(e["_i"].alias("itemId"), e["_r"].alias("rating")))
    return best.agg(typed.cast(RECOMMENDATIONS_TYPE).alias("recommendations"))


def recommend_popular(
    users: DataFrame, scores: DataFrame, k: int, item: str = "item", score: str = "score"
) -> DataFrame:
    """The same top-k list for every user; no user when there is no item."""
    listed = users.withColumn("recommendations", top_list(scores, k, item, score).scalar())
    return listed.filter(F.size("recommendations") > 0)


def recommend_active_popular(
    ratings: DataFrame,
    t,
    k: int,
    user: str = "user",
    item: str = "item",
    ts: str = "ts",
    scores: DataFrame | None = None,
) -> DataFrame:
    """Top-k of the items active after ``t``, for the users of the whole history.

    Without ``scores`` an item's score is its number of interactions.
    """
    if scores is None:
        used = ratings.groupBy(item).agg(F.count(F.lit(1)).alias("score"), F.max(ts).alias("_last"))
        active = used.filter(F.col("_last") > (t if isinstance(t, Column) else F.lit(t)))
    else:
        active = scores.join(active_items(ratings, t, item, ts), item, "left_semi")
    return recommend_popular(ratings.select(user).distinct(), active, k, item)


def candidate_counts(
    ratings: DataFrame, t, user: str = "user", item: str = "item", ts: str = "ts"
) -> DataFrame:
    """Users, active items, and how many user-item candidates they span.

    The candidates themselves are never listed; :func:`recommend_active` scores
    them block by block.
    """
    active = F.when(F.col(ts) > (t if isinstance(t, Column) else F.lit(t)), F.col(item))
    counts = ratings.agg(
        F.count_distinct(user).alias("n_users"), F.count_distinct(active).alias("n_items")
    )
    return counts.withColumn("n_pairs", F.col("n_users") * F.col("n_items"))


def recommend_all(model: ALSModel, k: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Top-k items for every user the model knows."""
    return _best_items(model.userFactors, model.itemFactors, k, model.getUserCol(), block_rows)


def recommend_factors(
    users: DataFrame, items: DataFrame, k: int, user: str = "user", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Top-k items for every user by the product of factors, both given as (id int, features array<float>).

    For factors from anywhere, such as a model trained elsewhere. Equal products go to the smaller item.
    """
    typed = [side.select(F.col("id").cast("int"), F.col("features").cast("array<float>")) for side in (users, items)]
    return _best_items(*typed, k, user, block_rows)


def _first_k(
    rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, n: int, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """The k best (id, score) of each of n rows, score falling; equal scores by rising id."""
    order = np.lexsort((ids, -scores, rows))
    rows = rows[order]
    kept = order[np.arange(len(rows)) - np.searchsorted(rows, rows) < k]
    return ids[kept].reshape(n, -1), scores[kept].reshape(n, -1)


def _scores(users: np.ndarray, items: np.ndarray) -> np.ndarray:
    return users @ items.T


def _norms(factors: np.ndarray) -> np.ndarray:
    """Lengths, not rounded down."""
    norms = np.empty(len(factors))
    for at in range(0, len(factors), _NORM_ROWS):  # as float64 only so many rows at a time
        wide = factors[at : at + _NORM_ROWS].astype(np.float64)
        norms[at : at + _NORM_ROWS] = np.sqrt(np.einsum("ij,ij->i", wide, wide))
    return norms * (1 + _SLACK * (1 + factors.shape[1]))


def _by_norm(item_ids: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, factors and norms, the longest first."""
    norms = _norms(items)
    order = np.argsort(-norms, kind="stable")
    return item_ids[order], items[order], norms[order]


def _best_items_of(
    users: np.ndarray, item_ids: np.ndarray, item_factors: np.ndarray, k: int, norms: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Per user the k best items and their scores, block of items by block.

    Items come by falling norm (sorted here unless ``norms`` are given). No score exceeds the
    product of the two norms, so a user is done once that is below its k-th score.
    Everything at or above the k-th score so far is a candidate, so a tie across
    the cut is settled by id, not by chance.
    """
    if norms is None:
        item_ids, item_factors, norms = _by_norm(item_ids, item_factors)
    n, k, reach = len(users), min(k, len(item_ids)), _norms(users)
    ids, best = np.empty((n, 0), item_ids.dtype), np.empty((n, 0), np.float32)
    for at in range(0, len(item_ids), _BLOCK_ITEMS):
        full = best.shape[1] == k
        open_ = np.nonzero(reach * norms[at] >= best[:, -1])[0] if full and k else np.arange(n)
        if not len(open_):
            break
        scores = _scores(users[open_], item_factors[at : at + _BLOCK_ITEMS])
        if full:
            cut = best[open_, -1:]
        elif scores.shape[1] > k:
            cut = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
        else:
            cut = np.full((n, 1), -np.inf, np.float32)
        rows, cols = np.nonzero(scores >= cut)
        if not len(rows):
            continue
        touched = np.unique(rows) if full else np.arange(n)
        of = open_[touched]
        held = np.repeat(np.arange(len(of)), ids.shape[1])
        merged = _first_k(
            np.r_[held, np.searchsorted(touched, rows)],
            np.r_[ids[of].ravel(), item_ids[at + cols]],
            np.r_[best[of].ravel(), scores[rows, cols]],
            len(of),
            k,
        )
        if full:
            ids[of], best[of] = merged
        else:
            ids, best = merged
    return ids, best


def packed(rank: int):
    """Rows (_own, id, features) as one row per batch and own block, with ids and factors in bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own, ids = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("_own", "id"))
            flat = batch.column("features").flatten().to_numpy(zero_copy_only=False)
            factors = flat.astype(np.float32, copy=False).reshape(batch.num_rows, rank)
            order = np.argsort(own, kind="stable")
            blocks, starts = np.unique(own[order], return_index=True)
            parts = np.split(order, starts[1:])
            columns = [
                pa.array(blocks, pa.int32()),
                pa.array([ids[part].astype(np.int32).tobytes() for part in parts], pa.binary()),
                pa.array([factors[part].tobytes() for part in parts], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["_own", "ids", "factors"])

    return pack


def _block_scorer(k: int, user: str, rank: int):
    """Scores the users of a block pair against its items, some users at a time.

    A worker holds the factors of the pair, each once but while items are sorted, and the lists of one batch.
    """
    entries = pa.list_(pa.struct([("itemId", pa.int64()), ("rating", pa.float64())]))

    def joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and factors of all parts, which are given up."""
        ids, factors = (np.concatenate(side) for side in zip(*parts))
        parts.clear()
        return ids, factors

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, offered = [], []
        for batch in batches:
            of_users = batch.column("is_user").to_pylist()
            for is_user, ids, factors in zip(of_users, batch.column("ids"), batch.column("factors")):
                part = np.frombuffer(ids.as_py(), np.int32), np.frombuffer(factors.as_py(), np.float32).reshape(-1, rank)
                (asked if is_user else offered).append(part)
        if not asked or not offered:
            return
        item_ids, items, norms = _by_norm(*joined(offered))
        names, users = joined(asked)
        for start in range(0, len(users), _BLOCK_USERS):
            ids, best = _best_items_of(users[start : start + _BLOCK_USERS], item_ids, items, k, norms)
            entry = [pa.array(ids.ravel(), pa.int64()), pa.array(best.ravel().astype(float), pa.float64())]
            ends = pa.array(np.arange(0, ids.size + 1, ids.shape[1], dtype=np.int32))
            lists = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(entry, ["itemId", "rating"]))
            named = pa.array(names[start : start + _BLOCK_USERS], pa.int32())
            yield pa.RecordBatch.from_arrays([named, lists.cast(entries)], [user, "recommendations"])

    return score


def _merged(lists: DataFrame, user: str, k: int) -> DataFrame:
    """Top-k of several top-k lists per user."""
    entries = F.flatten(F.collect_list("recommendations"))
    keyed = F.transform(
        entries,
        lambda e: F.struct((-e["rating"]).alias("_s"), e["itemId"].alias("itemId"), e["rating"].alias("rating")),
    )
    best = F.slice(F.sort_array(keyed), 1, k)
    plain = F.transform(best, lambda e: F.struct(e["itemId"], e["rating"]))
    return lists.groupBy(user).agg(plain.cast(RECOMMENDATIONS_TYPE).alias("recommendations"))


def _block_counts(n_users: int, n_items: int, rank: int, block_rows: int) -> tuple[int, int]:
    """Into how many blocks users and items are dealt.

    Up to ``MANY_BLOCKS`` block pairs, or as many as keep every block below ``BLOCK_FLOATS``:
    so what is sent grows with users and items, and not with their product.
    """
    least = lambda n: -(-n * rank // BLOCK_FLOATS)
    item_blocks = max(1, least(n_items), min(MANY_ITEM_BLOCKS, -(-n_items // (ITEM_FACTOR * block_rows))))
    wanted = max(-(-n_users // block_rows), min(MANY_BLOCKS, -(-n_users // FEW_USERS)))
    return max(1, least(n_users), min(-(-MANY_BLOCKS // item_blocks), wanted)), item_blocks


def _best_items(users: DataFrame, items: DataFrame, k: int, user: str, block_rows: int) -> DataFrame:
    """Top-k of ``items`` for each of ``users``, both (id, features).

    User-item pairs are never rows, and no factors visit the driver: users are dealt into
    blocks of about ``block_rows`` and items into larger ones, every user block meets every
    item block in one task as matrix products, and only k entries per user and item block
    leave it. Few users are dealt in smaller blocks, so that more tasks share them, and many in
    larger ones. Factors travel packed, thousands of users or items to a row.
    """
    sized = F.coalesce(F.max(F.size("features")), F.lit(0))
    (n_users, rank), (n_items, _) = (side.agg(F.count(F.lit(1)), sized).first() for side in (users, items))
    user_blocks, item_blocks = _block_counts(n_users, n_items, rank, block_rows)

    def dealt(side: DataFrame, own: str, n_own: int, other: str, n_other: int, is_user: bool) -> DataFrame:
        block = F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int").alias("_own")
        parts = side.select(block, "id", "features").mapInArrow(packed(rank), "_own int, ids binary, factors binary")
        return parts.select(
            F.col("_own").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other),
            F.lit(is_user).alias("is_user"),
            "ids",
            "factors",
        )

    asked = dealt(users, "_u", user_blocks, "_i", item_blocks, True)
    offered = dealt(items, "_i", item_blocks, "_u", user_blocks, False)
    blocks = asked.unionByName(offered).groupBy("_u", "_i")
    lists = blocks.applyInArrow(_block_scorer(k, user, rank), f"{user} int, recommendations {RECOMMENDATIONS_TYPE}")
    return lists if item_blocks == 1 else _merged(lists, user, k)


def recommend_active(
    model: ALSModel,
    ratings: DataFrame,
    t,
    k: int,
    user: str = "user",
    item: str = "item",
    ts: str = "ts",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Top-k of the items active strictly after ``t``, for every user of the history.

    Users and items the model does not know drop out; items already seen stay in.
    A ``k`` of at least the number of active items gives the full lists.
    """
    active = active_items(ratings, t, item, ts).select(F.col(item).cast("int").alias("id"))
    known = ratings.select(F.col(user).cast("int").alias("id")).distinct()
    items = model.itemFactors.join(active, "id", "left_semi")
    users = model.userFactors.join(known, "id", "left_semi")
    return _best_items(users, items, k, user, block_rows)


def inject_cold(
    recs: DataFrame,
    cold: DataFrame,
    rate: float = 0.01,
    seed: int = 42,
    user: str = "user",
    item: str = "item",
    max_broadcast: int = 1_000_000,
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Replace about ``rate`` of the served entries by a random cold item.

    Rows (user, position, item, exposed); ``exposed`` is 'cold' for a replaced
    entry and 'warm' otherwise. Which entries, and which items, follow from the
    user, the position and the seed. Cold items are broadcast up to ``max_broadcast``;
    beyond it only the replaced entries are shuffled to them.
    """
    served = recs.select(user, F.posexplode("recommendations.itemId").alias("_pos", item))
    served = served.select(user, (F.col("_pos") + 1).alias("position"), item)
    cold = materialise(cold.select(F.col(item).alias("_cold")), "cold")
    numbered = rank_in_group(cold, [], [digest(["_cold"], seed), F.col("_cold")], "_n", min_rows=min_rows)
    n_cold = cold.count()
    if n_cold == 0:
        return served.withColumn("exposed", F.lit("warm"))
    chosen = unit_draw([user, "position"], seed) < rate
    pick = draw([user, "position"], f"{seed}-item") % F.lit(n_cold) + 1
    numbered = numbered.select("_n", "_cold")
    exposed = F.when(F.col("_cold").isNull(), "warm").otherwise("cold").alias("exposed")
    if n_cold <= max_broadcast:
        picked = served.withColumn("_n", F.when(chosen, pick)).join(F.broadcast(numbered), "_n", "left")
        return picked.select(user, "position", F.coalesce("_cold", item).alias(item), exposed)
    replaced = served.filter(chosen).select(user, "position", pick.alias("_n")).join(numbered, "_n")
    replaced = replaced.select(user, "position", F.col("_cold").alias(item), exposed)
    return served.filter(~chosen).withColumn("exposed", F.lit("warm")).unionByName(replaced)
