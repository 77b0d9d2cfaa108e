"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

A source's documents, in an order drawn once, form one stream of words, cut into blocks of equal
size. Targets in words become an exact number of blocks to draw from each source, whole
passes first. A binary tree over the output shards deals these quotas out: every node gives
its left child a draw without replacement from its own quotas, so the shards' quotas add up
exactly. Each shard then owns ranges of a permutation of every source's draws, ranges of
different shards are disjoint, and a shard's blocks are shuffled among themselves.

The permutations are keyed bijections, so nothing is sorted to permute it; a task that
deals shards walks from the root to its own subtree, so the tree needs no rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recmill.operators.skew import rank_in_group
from recmill.sources.scratch import materialise

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 512
MOST_BLOCKS = 500_000_000  # numpy draws from fewer than 10**9; blocks grow where a mix would hold more
SHARD_BLOCKS = 1024
SUBTREE = 64  # shards that one task row deals to
FAMILIES = 4096  # sources are told apart by the tree up to this many; more share one quota of the tree
ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits
_U = np.uint64
_TURNS = [_U(n * 0x9E3779B97F4A7C15 % 2**64) for n in range(4)]


# Sizes and targets --------------------------------------------------------------------------


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, with_text: bool = False) -> DataFrame:
    """(_row, doc_id, source, size, _draw[, text]) of every row, stored; _row is unique."""
    words = F.regexp_count(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(WORD))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        words.cast("long").alias("size"),
        F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string")).alias("_draw"),
        *[F.col(text_col).cast("string").alias("text")] * with_text,
    )
    return materialise(rows.withColumn("_row", F.monotonically_increasing_id()), "sized")


def targets(sizes: DataFrame, weights: list[int], share: tuple[int, int], most: int) -> DataFrame:
    """(sid, source, weight, source_size, target) of every source, stored.

    Sources are numbered by code point, null last, and take ``weights`` in turn. ``share`` of
    all words is dealt out by weight; a target above ``most`` times its source's size stops
    there and its excess is dealt out again by weight, until none is above. Each round adds
    up the sources that are still open, and only the sums reach the driver.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").asc_nulls_last()]
    ranked = rank_in_group(materialise(by_source, "sources"), [], order, "sid")
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = ranked.withColumn("sid", F.col("sid") - 1)
    weight = F.element_at(cycle, (F.col("sid") % len(weights) + 1).cast("int")).cast("long")
    sources = materialise(ranked.select("sid", "source", weight.alias("weight"), "source_size"), "sources")

    total = sources.agg(F.sum("source_size")).first()[0] or 0
    size, one = F.col("source_size").cast("decimal(38,0)"), F.col("weight").cast("decimal(38,0)")
    numerator, weighed, before = share[0] * total, 1, -1  # what is left to deal out, times share[1]
    closed = F.lit(False)
    while True:
        found = sources.agg(
            F.sum(F.when(closed, F.col("source_size"))).alias("capped"),
            F.sum(F.when(~closed, F.col("weight"))).alias("open"),
            F.count(F.when(closed, 1)).alias("n"),
        ).first()
        if found.n == before or not found.open:
            break
        before = found.n
        numerator = share[0] * total - share[1] * most * (found.capped or 0)
        weighed = found.open
        above = one * F.lit(numerator).cast("decimal(38,0)") > size * F.lit(share[1] * most * weighed).cast("decimal(38,0)")
        closed = closed | above
    dealt = F.lit(float(numerator)) * F.col("weight") / F.lit(float(weighed * share[1]))
    target = F.when(closed, F.col("source_size").cast("double") * most).otherwise(dealt)
    return materialise(sources.withColumn("target", target), "targets")


# Keyed permutations -------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def permuted(x: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The place of each ``x`` in a keyed permutation of 0 to n - 1.

    A Feistel network on the least even number of bits that holds n, walked on from places
    beyond n until one is inside.
    """
    x, n, key = (np.asarray(v).astype(np.uint64) for v in np.broadcast_arrays(x, n, key))
    x = x.copy()
    bits = np.frexp((n - _U(1)).astype(np.float64))[1]  # n - 1 < 2 ** bits
    half = np.maximum((bits + 1) // 2, 1).astype(np.uint64)
    mask = (_U(1) << half) - _U(1)
    todo = np.arange(len(x))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = x[todo] >> h, x[todo] & m
        for turn in _TURNS:
            left, right = right, left ^ (_mixed(right + k + turn) & m)
        x[todo] = (left << h) | right
        todo = todo[x[todo] >= n[todo]]
    return x.astype(np.int64)


def _key(seed: int, *parts) -> np.ndarray:
    """A 64-bit key for each row of ``parts``."""
    key = _mixed(np.asarray([seed]).astype(np.uint64) + _U(0x9E3779B97F4A7C15))
    for part in parts:
        key = _mixed(key + np.asarray(part).astype(np.uint64) * _U(0xD6E8FEB86659FD93) + _U(1))
    return key


# Quotas and the tree ------------------------------------------------------------------------


def quota(sid: int, size: int, words: int, block: int, seed: int) -> tuple[int, int]:
    """(blocks to draw, words taken of the last one) so that exactly ``words`` are taken.

    Each pass takes the blocks in an order of its own; all but the source's last block are full.
    """
    if not words:
        return 0, 0
    n = -(-size // block)
    passes, left = divmod(words, size)
    if not left:
        passes, left = passes - 1, size
    short = size - (n - 1) * block
    at = int(permuted(np.array([n - 1]), np.array([n]), _key(seed, [sid], [passes]))[0])
    drawn = -(-left // block)
    if drawn > at:  # the short block is among them
        drawn = max(at + 1, -(-(left + block - short) // block))
    before = (drawn - 1) * block - (block - short) * (drawn - 1 > at)
    return passes * n + drawn, left - before


def drawn(sources: DataFrame, block: int, seed: int) -> DataFrame:
    """Add (n_blocks, n_draws, cut, family, first) to the sources, stored: how much to draw, and where that is in its family."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sid, size, target = (batch.column(c).to_pylist() for c in ("sid", "source_size", "target"))
            found = [quota(i, s, int(t + 0.5), block, seed) for i, s, t in zip(sid, size, target)]
            columns = [sid, size, [-(-s // block) for s in size], [k for k, _ in found], [c for _, c in found]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["sid", "source_size", "n_blocks", "n_draws", "cut"])

    kinds = "sid long, source_size long, n_blocks long, n_draws long, cut long"
    quotas = sources.select("sid", "source_size", "target").mapInArrow(run, kinds)
    quotas = quotas.withColumn("family", F.col("sid") % FAMILIES)
    order = Window.partitionBy("family").orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    return materialise(quotas.withColumn("first", F.coalesce(F.sum("n_draws").over(order), F.lit(0))), "quotas")


def _halved(quotas: np.ndarray, n: int, seed: int, lo: int, hi: int) -> np.ndarray:
    """A draw of ``n`` without replacement from ``quotas``, the same whoever asks for it."""
    bits = np.random.Philox(key=int(_key(seed, [lo], [hi])[0]))
    return np.random.Generator(bits).multivariate_hypergeometric(quotas, n, method="marginals")


def dealt(quotas: np.ndarray, shards: int, lo: int, hi: int, seed: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, first, count) by family for the shards from ``lo`` to ``hi`` - 1."""
    total = int(quotas.sum())
    upto = lambda shard: shard * total // shards
    todo = [(0, shards, quotas, np.zeros_like(quotas))]
    while todo:
        a, b, own, first = todo.pop()
        if b <= lo or a >= hi:
            continue
        if b - a == 1:
            yield a, first, own
            continue
        mid = (a + b) // 2
        left = _halved(own, upto(mid) - upto(a), seed, a, b)
        todo += [(mid, b, own - left, first + left), (a, mid, left, first)]


def slots(spark, quotas: np.ndarray, shard_blocks: int, seed: int) -> DataFrame:
    """(family, rank, shard): the shard of every draw of every family."""
    shards = max(1, -(-int(quotas.sum()) // shard_blocks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in batch.column(0).to_pylist():
                for shard, first, count in dealt(quotas, shards, start, min(start + SUBTREE, shards), seed):
                    family = np.nonzero(count)[0]
                    columns = [family, np.full(len(family), shard), first[family], count[family]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["family", "shard", "first", "count"])

    roots = spark.range(0, shards, SUBTREE)
    ranges = roots.mapInArrow(run, "family long, shard long, first long, count long").filter("count > 0")
    return ranges.select("family", "shard", F.explode(F.expr("sequence(first, first + count - 1)")).alias("rank"))


# The mix ------------------------------------------------------------------------------------


def _placed(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """(_row, sid, size, start): where each row's words begin in its source's stream.

    One range sort over (source, draw) spreads a source over as many tasks as it needs; starts
    are running sums inside a part, moved by the words of the source in earlier parts.
    """
    rows = sizes.filter("size > 0").join(
        sources.select("sid", F.col("source").alias("_source")), F.col("source").eqNullSafe(F.col("_source"))
    )
    ordered = rows.select("sid", "_draw", "doc_id", "size", "_row").orderBy("sid", "_draw", "doc_id", "size", "_row")
    ordered = materialise(ordered.withColumn("_id", F.monotonically_increasing_id()), "streams")
    ordered = ordered.withColumn("_part", F.shiftright("_id", ROW_BITS))
    parts = ordered.groupBy("sid", "_part").agg(F.sum("size").alias("_words"))
    earlier = Window.partitionBy("sid").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    moved = parts.select(
        F.col("sid").alias("_s"), F.col("_part").alias("_p"), F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_base")
    )
    inside = Window.partitionBy("sid", "_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    local = ordered.withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = local.join(moved, (F.col("sid") == F.col("_s")) & (F.col("_part") == F.col("_p")))
    return joined.select("_row", "sid", "size", (F.col("_base") + F.col("_before")).alias("start"))


def _pieces(placed: DataFrame, quotas: DataFrame, in_family: np.ndarray, block: int, seed: int) -> DataFrame:
    """(family, rank, _row, epoch, first_word, n_words): what each draw of a block takes from each row."""
    blocks = F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")
    cut = placed.select("_row", "sid", "size", "start", F.explode(blocks).alias("block"))
    known = cut.join(quotas.drop("source_size").filter("n_draws > 0"), "sid")
    kinds = "family long, rank long, _row long, epoch int, first_word long, n_words long"
    fields = ["_row", "sid", "size", "start", "block", "n_blocks", "n_draws", "cut", "family", "first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, sid, size, start, at, n, draws, cut_at, family, first = (batch.column(c).to_numpy() for c in fields)
            begin, end = np.maximum(start, at * block), np.minimum(start + size, (at + 1) * block)
            for epoch in range(int(np.max(-(-draws // n), initial=0))):
                draw = epoch * n + permuted(at, n, _key(seed, sid, np.full(len(sid), epoch)))
                stop = np.where(draw == draws - 1, np.minimum(end, at * block + cut_at), end)
                kept = np.nonzero((draw < draws) & (stop > begin))[0]
                f = family[kept]
                rank = permuted(first[kept] + draw[kept], in_family[f], _key(seed, np.full(len(kept), -1), f))
                columns = [f, rank, row[kept], np.full(len(kept), epoch), (begin - start)[kept], (stop - begin)[kept]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int32() if i == 3 else pa.int64()) for i, c in enumerate(columns)],
                    ["family", "rank", "_row", "epoch", "first_word", "n_words"],
                )

    return known.select(*fields).mapInArrow(run, kinds)


def _mixed_rows(sizes: DataFrame, sources: DataFrame, block_words: int, shard_blocks: int, seed: int) -> DataFrame:
    """(shard, family, rank, _row, epoch, first_word, n_words), one row for what a draw takes from a document."""
    spark = sizes.sparkSession
    words = sources.agg(F.sum("target")).first()[0] or 0.0
    block = max(block_words, -(-int(words) // MOST_BLOCKS))
    quotas = drawn(sources, block, seed)
    in_family = np.zeros(FAMILIES, dtype=np.int64)
    for found in quotas.groupBy("family").agg(F.sum("n_draws").alias("n")).collect():
        in_family[found.family] = found.n
    taken = _pieces(_placed(sizes, sources), quotas, in_family, block, seed)
    planned = slots(spark, in_family, shard_blocks, seed).hint("merge")  # its rows cannot be foreseen by the planner
    return taken.join(planned, ["family", "rank"])


def mix(
    docs: DataFrame,
    weights: list[int],
    share: tuple[int, int] = (1, 1),
    most: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_words: int = BLOCK_WORDS,
    shard_blocks: int = SHARD_BLOCKS,
    seed: int = 42,
    with_text: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(the mix, the documents): what every shard holds in order, and what was taken of every row.

    The mix has (shard, position, doc_id, epoch, first_word, n_words[, text]): ``n_words`` words
    of a document from ``first_word`` on, in the ``epoch``-th pass over its source, and on demand
    these words joined by blanks; sort by (shard, position) to write a shard. The documents have (doc_id, source, size, source_size,
    target, taken), one for every row of ``docs``.

    Sources take ``weights`` in turn by code point, null last, and share ``share`` (a fraction) of
    all words; no target exceeds ``most`` times its source, and none is missed by a word or more.
    A null or empty text has no words, and no place in the mix. Rows that repeat an id are
    documents of their own, and a null id is one like any other. Other columns are not read.
    Reruns over the same rows agree, in whatever partitions they lie. An empty table gives no rows.
    """
    sizes = sized(docs, id_col, text_col, source_col, with_text)
    sources = targets(sizes, weights, share, most)
    rows = materialise(_mixed_rows(sizes, sources, block_words, shard_blocks, seed), "mix")
    taken = rows.groupBy(F.col("_row").alias("_r")).agg(F.sum("n_words").alias("taken"))
    known = sources.select(F.col("source").alias("_source"), "source_size", "target")
    of_rows = sizes.join(known, F.col("source").eqNullSafe(F.col("_source"))).join(taken, F.col("_row") == F.col("_r"), "left")
    documents = of_rows.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))

    draw = F.xxhash64(F.lit(seed), "shard", "family", "rank")
    order = Window.partitionBy("shard").orderBy(draw, "family", "rank", "_row")
    placed = rows.withColumn("position", F.row_number().over(order) - 1)
    named = placed.join(sizes.select("_row", "doc_id", *["text"] * with_text), "_row")
    words = F.slice(F.regexp_extract_all("text", F.lit(WORD), 0), (F.col("first_word") + 1).cast("int"), F.col("n_words").cast("int"))
    texts = [F.array_join(words, " ").alias("text")] * with_text
    return named.select("shard", "position", "doc_id", "epoch", "first_word", "n_words", *texts), documents
