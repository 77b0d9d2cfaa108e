"""Exact top-k by inner product: a Voronoi join of queries and data.

1. Pivots, more of them for more rows, are drawn from a bounded sample. Queries and data
   fall to the cells of their nearest pivots.
2. Summaries: of a cell's queries, how many there are and the largest distance u to the
   pivot; of its data, the k + 1 smallest distances d, of different ids.
3. Bounds: with query pivot p and data pivot o, every query of the cell scores a row of
   the summary at least <p, o> - |p| d - u (|o| + d). The (k + 1)-th highest of these is
   a score that the k best of every query in the cell reach: the cell's least score (one
   more than k, as one id may be a query's own).
4. Routing: cells of queries near each other form groups. A row x goes to a group only if
   <p, x> + u |x| reaches the least score of one of its cells.
5. Each group is solved in buckets of bounded size, where a cell's queries meet the rows
   that pass the cell's own bound; their best k of a bucket go on to be merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recmill.sources.scratch import materialise

PIVOTS = 1024  # at most; below, the square root of the number of rows
SEEDS = 4096  # rows from which pivots are drawn
BUCKET = 8192  # rows, and queries, that meet in one bucket
SCALE = 64
EXACT = 2**53  # integers up to here are exact as doubles
LOWEST = np.iinfo(np.int64).min
SLACK = 1e-9  # of the largest product possible, for rounding


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _norms(a: np.ndarray) -> np.ndarray:
    return np.sqrt((a.astype(float) ** 2).sum(axis=1))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of rows; by doubles where no sum can leave their exact range."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), dtype=np.int64)
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if most < EXACT:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def _integer(x: Column) -> Column:
    return F.floor(SCALE * x.cast("double"))


def vectors(table: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int, int]:
    """(vec_id, v) with v integer and of one length, that length, and the number of rows.

    Rows of null id, null vector, or with a null or non-finite component take no part.
    Shorter vectors are filled up with zeros.
    """
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & ~F.exists("x", bad))
    longest, n = rows.agg(F.max(F.size("x")), F.count(F.lit(1))).first()
    width = max(longest or 0, 1)
    filled = F.concat(F.transform("x", _integer), F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))
    return rows.select("vec_id", filled.alias("v")), width, n


def _seeds(rows: DataFrame, n: int, width: int) -> np.ndarray:
    """At most SEEDS different vectors, the same ones on every run; only rows with a small hash are shuffled."""
    mark, cells = F.xxhash64("v", F.lit("pivot")), 2**40
    for share in (min(1.0, 4 * SEEDS / max(n, 1)), 1.0):
        some = rows.filter(F.pmod(mark, F.lit(cells)) < int(share * cells)).select("v").distinct()
        table = some.orderBy(mark, "v").limit(SEEDS).toArrow().combine_chunks()
        if share == 1.0 or table.num_rows == SEEDS:  # many repeated vectors may leave too few
            break
    if not table.num_rows:
        return np.zeros((0, width), np.int64)
    return _matrix(table.column("v").combine_chunks(), width)


def _pivots(seeds: np.ndarray, n: int) -> np.ndarray:
    """``n`` of the seeds, each drawn by its squared distance to those drawn before."""
    if len(seeds) <= n:
        return seeds
    draw, x = np.random.default_rng(7), seeds.astype(float)
    chosen = [0]
    near = ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < n:
        chosen.append(int(draw.choice(len(x), p=near / near.sum())))
        near = np.minimum(near, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return seeds[chosen]


def _nearest(v: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest pivot, and a distance to it that is not too small."""
    x, p = v.astype(float), pivots.astype(float)
    cell = ((p**2).sum(axis=1) - 2 * (x @ p.T)).argmin(axis=1)
    return cell.astype(np.int32), _norms(x - p[cell]) * (1 + SLACK)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            yield batch.slice(at, 2048)


def _celled(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Add the cell, the nearest pivot's number, and the distance to that pivot."""
    width = pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            cell, far = _nearest(_matrix(batch.column(1), width), pivots)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], ["vec_id", "v", "cell", "far"])

    return rows.mapInArrow(run, "vec_id long, v array<long>, cell int, far double")


def _closest(cell: np.ndarray, ids: np.ndarray, far: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``n`` smallest distances of every cell, of different ids."""
    order = np.lexsort((far, ids, cell))
    cell, ids, far = cell[order], ids[order], far[order]
    first = np.ones(len(cell), dtype=bool)
    first[1:] = (cell[1:] != cell[:-1]) | (ids[1:] != ids[:-1])
    cell, ids, far = cell[first], ids[first], far[first]
    order = np.lexsort((ids, far, cell))
    cell, ids, far = cell[order], ids[order], far[order]
    kept = np.arange(len(cell)) - np.searchsorted(cell, cell) < n
    return cell[kept], ids[kept], far[kept]


def _summary(rows: DataFrame, pivots: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell, id, distance): every cell's ``n`` smallest distances, at most pivots x n entries."""
    width = pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0)
        for batch in _slices(batches):
            cell, far = _nearest(_matrix(batch.column(1), width), pivots)
            new = cell, batch.column(0).to_numpy(), far
            held = _closest(*(np.concatenate(pair) for pair in zip(held, new)), n)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], ["cell", "vec_id", "far"])

    near = rows.mapInArrow(run, "cell int, vec_id long, far double").groupBy("cell", "vec_id").agg(F.min("far").alias("far"))
    place = F.row_number().over(Window.partitionBy("cell").orderBy("far", "vec_id"))
    table = near.withColumn("place", place).filter(F.col("place") <= n).select("cell", "vec_id", "far").toArrow()
    return tuple(table.column(i).to_numpy() for i in range(3))


@dataclass(frozen=True)
class _Plan:
    """What is known of every cell: its pivot, its queries and the score that their k best reach."""

    pivots: np.ndarray
    asked: np.ndarray  # queries in the cell
    radii: np.ndarray  # their largest distance to the pivot
    least: np.ndarray
    group: np.ndarray  # -1 without queries

    def needs(self, v: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Whether a row (first axis) may be among the best of a query in a cell (second axis)."""
        x, p = v.astype(float), self.pivots[cells].astype(float)
        size = _norms(x)[:, None]
        most = x @ p.T + self.radii[cells] * size
        most += 1 + SLACK * size * (_norms(p) + self.radii[cells])
        return most >= self.least[cells]


def _least(pivots: np.ndarray, radii: np.ndarray, summary: tuple[np.ndarray, np.ndarray, np.ndarray], k: int) -> np.ndarray:
    """The (k + 1)-th highest lower bound of every cell of queries, over different ids."""
    cell, ids, far = summary
    p = pivots.astype(float)
    size, other = _norms(p), _norms(p)[cell] + far
    least = np.full(len(p), -np.inf)
    for i in range(len(p)):
        low = (p @ p[i])[cell] - size[i] * far - radii[i] * other
        low -= 1 + SLACK * (size[i] + radii[i]) * other
        order = np.argsort(-low, kind="stable")
        _, first = np.unique(ids[order], return_index=True)
        if len(first) > k:
            least[i] = low[order][np.sort(first)[k]]
    return least


def _groups(pivots: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Cells of queries to groups of about BUCKET queries: the largest cell left, then those nearest to it."""
    p, group = pivots.astype(float), np.full(len(pivots), -1)
    number = 0
    for i in np.argsort(-asked, kind="stable"):
        if group[i] >= 0 or not asked[i]:
            continue
        left = np.nonzero((group < 0) & (asked > 0))[0]
        left = left[np.argsort(np.where(left == i, -1.0, _norms(p[left] - p[i])), kind="stable")]
        fits = np.cumsum(asked[left]) <= BUCKET
        fits[0] = True
        group[left[: len(fits) if fits.all() else int(fits.argmin())]] = number
        number += 1
    return group


def _routed(rows: DataFrame, plan: _Plan) -> DataFrame:
    """(vec_id, v, groups, pairs): the groups that need a row, and how many queries it may serve."""
    width, cells = plan.pivots.shape[1], np.nonzero(plan.asked)[0]
    by_group = cells[np.argsort(plan.group[cells], kind="stable")]
    numbers, starts = np.unique(plan.group[by_group], return_index=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            needs = plan.needs(_matrix(batch.column(1), width), by_group)
            wanted = np.logical_or.reduceat(needs, starts, axis=1)
            ends = np.concatenate([[0], wanted.sum(axis=1).cumsum()]).astype(np.int32)
            groups = pa.ListArray.from_arrays(pa.array(ends), pa.array(numbers[np.nonzero(wanted)[1]].astype(np.int32)))
            pairs = needs @ plan.asked[by_group]
            out = pa.RecordBatch.from_arrays([*batch.columns, groups, pa.array(pairs)], ["vec_id", "v", "groups", "pairs"])
            yield out.filter(pa.array(pairs > 0))

    return rows.mapInArrow(run, "vec_id long, v array<long>, groups array<int>, pairs long")


def _best(plan: _Plan, k: int):
    """The k best of every query in a bucket, cell by cell, of the rows that the cell's bound leaves."""
    width, names = plan.pivots.shape[1], ["query_id", "query", "vec_id", "score"]

    def run(bucket: pa.Table) -> pa.Table:
        cell = bucket.column("cell").to_numpy()
        ids, number = bucket.column("vec_id").to_numpy(), bucket.column("query").to_numpy()
        v = _matrix(bucket.column("v").combine_chunks(), width)
        rows = np.nonzero(cell < 0)[0]
        rows = rows[np.argsort(ids[rows], kind="stable")]
        data, order = v[rows], ids[rows]
        out: list[list[np.ndarray]] = [[] for _ in names]
        for i in np.unique(cell[cell >= 0]):
            need = plan.needs(data, np.array([i]))[:, 0]
            some, known = (data, order) if need.all() else (data[need], order[need])
            asked = np.nonzero(cell == i)[0]
            for at in range(0, len(asked) if len(known) else 0, 256):
                part = asked[at : at + 256]
                score = products(v[part], some)
                score[known[None, :] == ids[part][:, None]] = LOWEST
                last = max(score.shape[1] - k, 0)
                reach = np.partition(score, last, axis=1)[:, last]
                q, x = np.nonzero((score >= reach[:, None]) & (score > LOWEST) & (score >= plan.least[i]))
                by = np.lexsort((known[x], -score[q, x], q))
                q, x = q[by], x[by]
                top = np.arange(len(q)) - np.searchsorted(q, q) < k
                q, x = q[top], x[top]
                for into, values in zip(out, (ids[part][q], number[part][q], known[x], score[q, x])):
                    into.append(values)
        return pa.table([pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in out], names=names)

    return run


def _prepared(
    table: DataFrame, queries: DataFrame, k: int, id_col: str, vector_col: str, pivots: int | None
) -> tuple[_Plan, DataFrame, DataFrame, int] | None:
    """The plan, the routed rows, the queries with their cells, and the number of rows; None without rows or queries."""
    rows, width, n = vectors(table, id_col, vector_col)
    asked, asked_width, n_asked = vectors(queries, id_col, vector_col)
    if not n or not n_asked:
        return None
    if asked_width < width:
        asked = asked.select("vec_id", F.concat("v", F.array_repeat(F.lit(0).cast("long"), width - asked_width)).alias("v"))
    elif asked_width > width:
        rows = rows.select("vec_id", F.concat("v", F.array_repeat(F.lit(0).cast("long"), asked_width - width)).alias("v"))
        width = asked_width
    chosen = _pivots(_seeds(rows, n, width), pivots or min(PIVOTS, math.isqrt(n) + 1))

    celled = materialise(_celled(asked.distinct(), chosen), "queries")
    counts, radii = np.zeros(len(chosen), dtype=np.int64), np.zeros(len(chosen))
    for row in celled.groupBy("cell").agg(F.max("far").alias("far"), F.count(F.lit(1)).alias("n")).collect():
        counts[row["cell"]], radii[row["cell"]] = row["n"], row["far"]
    least = _least(chosen, radii, _summary(rows, chosen, k + 1), k)
    plan = _Plan(chosen, counts, radii, least, _groups(chosen, counts))
    routed = _routed(rows, plan).withColumn("deal", F.monotonically_increasing_id())
    return plan, materialise(routed, "routed"), celled, n


def kept_share(
    table: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int | None = None
) -> float:
    """The share of all pairs of a query and a row that the bounds leave to be compared; 0 without pairs."""
    prepared = _prepared(table, queries, k, id_col, vector_col, pivots)
    if prepared is None:
        return 0.0
    plan, routed, _, n = prepared
    return (routed.agg(F.sum("pairs")).first()[0] or 0) / (n * int(plan.asked.sum()))


def top_k(
    table: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int | None = None
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products, ties to the smaller id.

    Vectors are taken as floor(64 * x), x as double. Rows with the query's own id are no
    candidates for it; rows that repeat an id are candidates each, and so is a query that
    occurs twice with different vectors, while equal rows are one query. Unusable vectors
    (see ``vectors``) take no part on either side. With fewer candidates a query gets all.
    An empty table gives no rows. Sums beyond 64 bits are not supported. ``pivots`` is the
    number of cells, by default the square root of the number of rows, up to PIVOTS; it
    and the sample of SEEDS rows change the work, not the result.
    """
    prepared = _prepared(table, queries, k, id_col, vector_col, pivots)
    if prepared is None:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    plan, routed, celled, _ = prepared
    n_groups = int(plan.group.max()) + 1
    asked, given = np.zeros(n_groups, dtype=np.int64), np.zeros(n_groups, dtype=np.int64)
    np.add.at(asked, plan.group[plan.group >= 0], plan.asked[plan.group >= 0])
    for row in routed.select(F.explode("groups").alias("group")).groupBy("group").count().collect():
        given[row["group"]] = row["count"]

    pick = lambda values, at: F.element_at(F.array(*[F.lit(int(x)) for x in values]), at + 1)
    n_blocks, n_chunks = pick(-(-asked // BUCKET), F.col("group")), pick(-(-given // BUCKET), F.col("group"))
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    deal = lambda n, *by: F.pmod(F.xxhash64(*by), F.greatest(n, F.lit(1))).cast("int")
    data = routed.select("vec_id", "v", "deal", F.explode("groups").alias("group"))
    data = data.select("group", "vec_id", "v", deal(n_chunks, "deal", "group").alias("chunk"), n_blocks.alias("n_blocks"))
    data = data.select(
        "group", "chunk", F.explode(upto(F.col("n_blocks"))).alias("block"), F.lit(-1).alias("cell"), "vec_id", F.lit(0).cast("long").alias("query"), "v"
    )
    ask = celled.select("vec_id", "v", "cell", pick(plan.group, F.col("cell")).alias("group"))
    ask = ask.select(
        "group",
        F.explode(upto(n_chunks)).alias("chunk"),
        deal(n_blocks, "vec_id", "v", F.lit("block")).alias("block"),
        "cell",
        "vec_id",
        F.xxhash64("vec_id", "v").alias("query"),
        "v",
    )
    met = data.unionByName(ask).groupBy("group", "chunk", "block")
    found = met.applyInArrow(_best(plan, k), "query_id long, query long, vec_id long, score long")
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
