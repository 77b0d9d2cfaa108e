"""Spelling variants of one edit, from a dictionary of trie-node pairs.

Every word is numbered into a forward trie (a node for every prefix) and a trie of reversed
words (a node for every suffix). Leaving out one character of a word gives a pair of nodes,
the prefix before it and the suffix after it; a place between two characters gives the pair
of the prefix and the suffix that meet there. Two words are one replacement apart where
they share a pair of the first kind, and one insertion apart where a pair of the first kind
of the longer is a pair of the second kind of the shorter. Pairs are two integers however
long a word is, and matches are exact.

The words that share a pair differ in one character, or are one character shorter, so there
are no more of them than letters; each takes from its group a count and the best other word,
and no pair of words is formed.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recmill.llm.text import UPPER
from recmill.sources.scratch import materialise

ENTRIES = 500_000  # distinct words that a task holds before it hands them on
SHALLOW = 6  # nodes of fewer characters are numbered by their characters, of which each has eight bits
NODE_BITS = 40
SPLIT, SKIP, SKIP_AGAIN = 0, 1, 2  # SKIP_AGAIN: as left out just before it, in a run of one letter
_LOWER = str.maketrans(UPPER, UPPER.lower())
_NONE = np.iinfo(np.int64).max


# Words --------------------------------------------------------------------------------------


def _changed(run: str, prefix: int, every: int) -> str:
    """The lower-cased run, less one character where its hash says so."""
    run = run.lower() if run.isascii() else run.translate(_LOWER)
    if every:
        h = zlib.crc32(run.encode(), prefix)
        if h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
    return run


def count_words(docs: DataFrame, id_col: str, text_col: str, shortest: int, misspell_every: int) -> DataFrame:
    """(word, n) of the words of ``shortest`` characters or more."""
    runs = re.compile(rf"[A-Za-zÀ-ÿ]{{{shortest},}}")  # a run that is long enough is matched whole

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                prefix = zlib.crc32(f"{doc_id.as_py()}:".encode()) if misspell_every else 0
                for found, n in Counter(runs.findall(text.as_py())).items():
                    word = _changed(found, prefix, misspell_every)
                    if len(word) >= shortest:
                        held[word] += n
                        if len(held) >= ENTRIES:
                            yield out()
        if held:
            yield out()

    texts = docs.filter(F.col(text_col).isNotNull()).select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"), F.col(text_col).cast("string").alias("_text")
    )
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# Tries --------------------------------------------------------------------------------------


def _lists(values: array, ends: list[int]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(np.frombuffer(values, np.int64), pa.int64()))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of sorted words, from the root to the whole word.

    Words that share ``SHALLOW`` characters are in one task, so a deeper node is met in one task only
    and is numbered by its place there. Shallower nodes are numbered by their characters, below zero.
    """
    following = TaskContext.get().partitionId() << NODE_BITS
    last, above = "", array("q")
    for batch in batches:
        nodes, ends = array("q"), []
        for word in batch.column(1).to_pylist():
            most, common = min(len(last), len(word)), 0
            while common < most and last[common] == word[common]:
                common += 1
            own, code = array("q"), 0
            for depth in range(min(SHALLOW, len(word) + 1)):
                own.append(-1 - (depth << 40 | code))
                code = code << 8 | (ord(word[depth]) if depth < len(word) else 0)
            own.extend(above[len(own) : common + 1])
            fresh = len(word) + 1 - len(own)
            own.extend(range(following, following + fresh))
            following += fresh
            nodes.extend(own)
            ends.append(len(nodes))
            last, above = word, own
        yield pa.RecordBatch.from_arrays([batch.column(0), _lists(nodes, ends)], ["id", "nodes"])


def trie_nodes(words: DataFrame, reverse: bool) -> DataFrame:
    """(id, nodes) for (id, word): the trie nodes of each word, or of each reversed word; stored."""
    word = F.reverse("word") if reverse else F.col("word")
    parted = words.select("id", word.alias("_w")).repartition(F.substring("_w", 1, SHALLOW)).sortWithinPartitions("_w")
    return materialise(parted.mapInArrow(_number, "id long, nodes array<long>"), "trie")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(prefix, suffix, id, kind): the pairs of each word that leave out a character, or none."""
    for batch in batches:
        columns: list[list] = [[], [], [], []]
        for id_, word, ahead, behind in zip(*(batch.column(i) for i in range(4))):
            chars = np.frombuffer(word.as_py().encode("utf-32-le"), np.uint32)
            ahead, behind, n = ahead.values.to_numpy(), behind.values.to_numpy()[::-1], len(chars)
            again = np.concatenate(([False], chars[1:] == chars[:-1]))
            columns[0] += [ahead[:-1], ahead]
            columns[1] += [behind[1:], behind]
            columns[2].append(np.full(2 * n + 1, id_.as_py()))
            columns[3] += [np.where(again, SKIP_AGAIN, SKIP), np.full(n + 1, SPLIT)]
        arrays = [pa.array(np.concatenate(c) if c else [], pa.int64()) for c in columns]
        yield pa.RecordBatch.from_arrays(arrays, ["prefix", "suffix", "id", "kind"])


def _met(prefix: np.ndarray, suffix: np.ndarray, ids: np.ndarray, kind: np.ndarray) -> pa.RecordBatch:
    """(id, n_near, best) of whole groups, sorted by pair."""
    new = np.concatenate(([True], (prefix[1:] != prefix[:-1]) | (suffix[1:] != suffix[:-1])))
    starts = np.nonzero(new)[0]
    group = np.cumsum(new) - 1
    size = np.diff(np.append(starts, len(ids)))
    many = size[group] > 1
    ids, kind, size = ids[many], kind[many], size[size > 1]
    if not len(ids):
        return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 3, ["id", "n_near", "best"])
    starts = np.concatenate(([0], np.cumsum(size)[:-1]))
    group = np.repeat(np.arange(len(size)), size)
    least = lambda which: np.minimum.reduceat(np.where(which, ids, _NONE), starts)
    skips, once, split = kind != SPLIT, kind == SKIP, kind == SPLIT
    n_skips, n_once = np.add.reduceat(skips.astype(np.int64), starts), np.add.reduceat(once.astype(np.int64), starts)
    first = least(skips)[group]
    second = least(skips & (ids != first))[group]
    shorter = least(split)[group]
    near = np.where(split, n_once[group], n_skips[group] - 1 + (once & (shorter != _NONE)))
    other = np.where(ids == first, second, first)
    best = np.where(split, least(once)[group], np.where(once, np.minimum(other, shorter), other))
    kept = near > 0
    return pa.RecordBatch.from_arrays([pa.array(c[kept], pa.int64()) for c in (ids, near, best)], ["id", "n_near", "best"])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each word takes from its groups; a group that a batch may cut waits for the next one."""
    rest = [np.empty(0, np.int64)] * 4
    for batch in batches:
        if not batch.num_rows:
            continue
        rest = [np.concatenate((old, batch.column(i).to_numpy())) for i, old in enumerate(rest)]
        last = np.nonzero((rest[0] != rest[0][-1]) | (rest[1] != rest[1][-1]))[0]
        cut = last[-1] + 1 if len(last) else 0
        if cut:
            yield _met(*(c[:cut] for c in rest))
            rest = [c[cut:] for c in rest]
    if len(rest[0]):
        yield _met(*rest)


def neighbours(words: DataFrame) -> DataFrame:
    """(id, n_near, best) of the words of (id, word) that have a word one edit away: how many, and the least id.

    Words are distinct, and of characters below 256.
    """
    ahead, behind = trie_nodes(words, False), trie_nodes(words, True)
    both = words.select("id", "word").join(ahead, "id").join(behind.withColumnRenamed("nodes", "behind"), "id")
    keys = both.select("id", "word", "nodes", "behind").mapInArrow(_keys, "prefix long, suffix long, id long, kind long")
    sorted_keys = keys.repartition("prefix", "suffix").sortWithinPartitions("prefix", "suffix")
    found = sorted_keys.mapInArrow(_meet, "id long, n_near long, best long")
    return found.groupBy("id").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


# Variants -----------------------------------------------------------------------------------


def _roots(links: DataFrame) -> DataFrame:
    """(id, root) for stored (id, up): the end of each chain, by doubling the steps."""
    while True:
        above = links.select(F.col("id").alias("_id"), F.col("up").alias("_up"))
        moved = links.join(above, F.col("up") == F.col("_id"), "left")
        links = materialise(moved.select("id", F.coalesce("_up", "up").alias("up"), F.col("_up").isNotNull().alias("_moved")), "links")
        if not links.filter("_moved").limit(1).count():
            return links.select("id", F.col("up").alias("root"))


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shortest: int = 7,
    least: int = 2,
    times: int = 10,
    misspell_every: int = 0,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts.

    Words are maximal runs of Latin letters (A to Z, and U+00C0 to U+00FF), with A to Z in lower case, that
    have ``shortest`` characters and occur ``least`` times or more, n times in all. n_near counts the words
    one inserted, deleted or replaced character away. The form is the most frequent of them (ties: the first
    in code-point order) if it occurs ``times`` as often as the word or more, else null; the root is where
    forms lead in the end. A chain of forms grows by that factor at every step, so it is short.

    ``misspell_every`` plants known errors: a run loses a character where the CRC-32 of its document's id, a
    colon and the run is divisible by it. A null text has no words; a null id counts as an empty one.
    Repeated rows count each time. Other columns are not read. An empty table gives no rows.
    """
    counted = count_words(docs, id_col, text_col, shortest, misspell_every).filter(F.col("n") >= least)
    ranked = counted.orderBy(F.desc("n"), "word").withColumn("id", F.monotonically_increasing_id())
    words = materialise(ranked, "words")  # ids ascend from the most frequent word, ties by code point
    near = neighbours(words)
    names = lambda prefix: words.select(*[F.col(c).alias(f"{prefix}{c}") for c in ("id", "word", "n")])
    known = words.join(near.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left").drop("_id")
    formed = known.join(names("form_"), F.col("best") == F.col("form_id"), "left")
    enough = F.col("form_n") >= times * F.col("n")
    formed = materialise(
        formed.select("id", "word", "n", "n_near", *[F.when(enough, F.col(c)).alias(c) for c in ("form_id", "form_word", "form_n")]),
        "forms",
    )
    roots = _roots(materialise(formed.filter("form_id IS NOT NULL").select("id", F.col("form_id").alias("up")), "links"))
    rooted = formed.join(roots.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left")
    ended = rooted.join(names("root_"), F.col("root") == F.col("root_id"), "left")
    return ended.select(
        "word",
        F.col("form_word").alias("form"),
        F.coalesce("root_word", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n",
    )
