"""Benchmark decontamination by sampled k-grams, in built-in functions only.

A *window* is ``window`` consecutive words of a benchmark item (a shorter item is one
window). Items keep all their k-grams, and documents those at every ``window - k + 1``-th
word: any window of a document holds just one of these whole, so a shared window
meets by its hash. A meeting is then extended word by word as far as a window
reaches, and counts where a whole window agrees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recmill.llm.text import ascii_lower, let
from recmill.sources.scratch import materialise

WINDOW = 10
GRAM = 5
BROADCAST_ROWS = 500_000  # most benchmark fingerprints sent to every executor
# Fixed value: a word of a text whose A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER_WORD = r"[0-9a-z\x80-\x{10FFFF}]+"  # the same after lower-casing: Java is many times slower with the form above
RAW_WORD = r"[0-9A-Za-z\x80-\x{10FFFF}]+"  # the same before lower-casing
DOC_EDGE, ITEM_EDGE = "", " "  # stand beyond the ends of a text; no word, and unlike each other

SPAN = "array<struct<start:int,end:int>>"


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(LOWER_WORD), F.lit(0))


def _kept(found: Column, window: int, edge: str, sparse: bool) -> Column:
    """Array of (length, pos, hash, near): kept k-grams of a word array, for windows of ``window`` words.

    All of them, or if ``sparse`` one at every ``window - k + 1``-th word. pos counts words from 0; near holds the k-gram and the words a window may add on
    either side. Empty for texts of fewer words.
    """
    gram = min(GRAM, window)
    run, margin = window - gram + 1, window - gram
    n = F.size(found)
    # single elements only: a slice of a long array would copy the array every time
    some = lambda of, first, count: [F.get(of, first + j) for j in range(count)]

    def kept(padded: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), n - gram, F.lit(run if sparse else 1)),
            lambda i: F.struct(
                F.lit(window).alias("length"),
                i.alias("pos"),
                F.xxhash64(*some(padded, i + margin, gram)).alias("hash"),
                F.array(*some(padded, i, gram + 2 * margin)).alias("near"),
            ),
        )

    sides = F.array_repeat(F.lit(edge), margin)
    whole = let(F.concat(sides, found, sides), kept)
    return F.when(n >= window, whole).otherwise(F.array().cast("array<struct<length:int,pos:int,hash:bigint,near:array<string>>>"))


def _fingerprints(texts: DataFrame, key: str, text: Column, lengths: list[int], edge: str, sparse: bool) -> DataFrame:
    """(key, length, pos, hash, near), one row per kept k-gram."""

    def all_lengths(found: Column) -> Column:
        return F.concat(*[_kept(found, length, edge, sparse) for length in lengths])

    kept = texts.select(key, F.explode(let(words(text), all_lengths)).alias("_g"))
    return kept.select(key, "_g.length", "_g.pos", "_g.hash", "_g.near")


def _spans(pairs: DataFrame, window: int) -> DataFrame:
    """Extend each meeting; (key, item, start, end) of those that agree over a whole window."""
    gram = F.least(F.lit(GRAM), F.col("length"))
    margin = F.col("length") - gram
    same = F.zip_with("near", "_near", lambda x, y: x == y)
    left = F.array_position(F.reverse(F.slice("_same", F.lit(1), margin)), False)
    right = F.array_position(F.slice("_same", margin + gram + 1, margin), False)
    reach = lambda first_miss: F.when(first_miss == 0, margin).otherwise(first_miss - 1).cast("int")
    rows = pairs.withColumn("_same", same).filter(~F.array_contains(F.slice("_same", margin + 1, gram), False))
    rows = rows.withColumns({"_left": reach(left), "_right": reach(right)})
    whole = rows.filter(F.col("_left") + gram + F.col("_right") >= F.col("length"))
    return whole.select(
        "key", "item", (F.col("pos") - F.col("_left")).alias("start"), (F.col("pos") + gram + F.col("_right")).alias("end")
    )


def _covered(spans: str) -> Column:
    """Words inside the union of sorted spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))

    def add(acc: Column, span: Column) -> Column:
        new = F.greatest(F.lit(0), span["end"] - F.greatest(span["start"], acc["upto"]))
        return F.struct((acc["n"] + new).alias("n"), F.greatest(acc["upto"], span["end"]).alias("upto"))

    return F.aggregate(spans, start, add, lambda acc: acc["n"])


def overlaps(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """(key, spans, items) of every distinct text that holds a window of an item.

    key is the text's MD5; spans are sorted word ranges (start, end), which may overlap;
    items are the distinct ids, null ids left out. Null texts, and items without words,
    hold no window. Windows that several items share count for each of them.
    """
    item_text = F.col(item_text_col).cast("string")
    bench = items.select(F.col(item_col).alias("item"), item_text.alias("text"))
    size = F.size(words(F.col("text")))
    found = bench.select(F.least(size, F.lit(window)).alias("n")).filter("n > 0").distinct().collect()
    lengths = sorted(row["n"] for row in found)  # at most ``window`` numbers
    if not lengths:
        lengths = [window]
    by_length = [
        _fingerprints(bench.filter(F.least(size, F.lit(window)) == n), "item", F.col("text"), [n], ITEM_EDGE, False)
        for n in lengths
    ]
    marks = by_length[0]
    for more in by_length[1:]:
        marks = marks.unionByName(more)
    marks = materialise(marks.select("item", F.col("length").alias("_length"), F.col("hash").alias("_hash"), F.col("near").alias("_near")), "marks")
    small = marks.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    texts = docs.select(F.col(text_col).cast("string").alias("text")).filter(F.col("text").isNotNull())
    texts = texts.select(F.md5("text").alias("key"), "text")
    kept = _fingerprints(texts, "key", F.col("text"), lengths, DOC_EDGE, True)
    meet = (F.col("hash") == F.col("_hash")) & (F.col("length") == F.col("_length"))
    pairs = kept.join(F.broadcast(marks) if small else marks, meet)
    grouped = _spans(pairs, window).groupBy("key").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"), F.collect_set("item").alias("items")
    )
    return grouped


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans) of every row of ``docs``, repeated and null ids included.

    A word is hit when it lies inside any occurrence of a window. Rows without words,
    null texts among them, have zeros and empty lists; so has every row when there are no
    items. Other columns are not read.
    """
    hits = materialise(overlaps(docs, items, text_col, item_col, item_text_col, window), "overlaps")
    text = F.col(text_col).cast("string")
    n_words = F.coalesce(F.regexp_count(text, F.lit(RAW_WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.md5(text).alias("_key"), n_words.alias("n_words"))
    joined = rows.join(hits, F.col("_key") == F.col("key"), "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce(_covered("spans"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.array_sort(F.col("items")), F.array().cast(hits.schema["items"].dataType)).alias("items"),
        F.coalesce(F.col("spans"), F.array().cast(SPAN)).alias("spans"),
    )


def remove_contaminated(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """The rows of ``docs`` whose text holds no window of an item, with all their columns.

    Rows of null text stay.
    """
    hits = materialise(overlaps(docs, items, text_col, item_col, item_text_col, window).select(F.col("key").alias("_hit_key")), "overlaps")
    small = hits.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(hits) if small else hits, F.md5(docs[text_col].cast("string")) == hits["_hit_key"], "left_anti")
