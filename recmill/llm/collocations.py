"""Frequent phrases by multikey quicksort of suffixes, and the collocations among them.

A suffix is what follows a place in a text, up to the longest phrase. Words and pairs of words that
are too rare end it, as no frequent phrase holds them; they are told by filters of bounded size.
Suffixes go to tasks by their leading words, so all that begin alike meet; there, pointers to them
are sorted by three-way partitions, word by word. The size of an equal partition is the count of
the words it shares, and a partition too small for a frequent phrase is given up unsorted.

Equal suffixes of a batch travel as one, and where many begin with the same words, more words
decide where they go; the counts of the few phrases that are shorter than that are added up.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recmill.llm.text import UPPER
from recmill.sources.scratch import materialise

ENTRIES = 200_000  # distinct entries that a task holds before it hands them on
PAIRS = 2_000_000  # hashes of pairs, likewise
PART = 1_000_000  # bytes of a text taken together, about
SAMPLE = 64  # of so many places one is looked at for frequent beginnings
HEAVY = 50_000  # suffixes from which on a beginning is split by one word more
MOST_HEAVY = 1_000_000  # HEAVY grows with the words so that there are no more than some times this many such beginnings
BUCKET = 200_000  # suffixes sorted together, about
BUCKETS = 1024  # at least
FILTER_BITS = (16, 28)  # least and greatest size of the filter of frequent words, as powers of two
SALTS = 200
_BREAK = b"\xff"  # in no UTF-8 text
_MARKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_MARKS + b"\t" + UPPER.encode(), _BREAK * len(_MARKS) + b" " + UPPER.lower().encode())
_COUNTED = "lang string, k int, phrase string, n long"
_U = np.uint64


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, with ``_BREAK`` at marks; a long text in several parts that end at marks."""
    text, at = text.translate(_TABLE), 0
    while at < len(text):
        end = at + PART
        if end < len(text):
            mark = text.rfind(_BREAK, at + 1, end)
            mark = text.find(_BREAK, end) if mark < 0 else mark
            end = len(text) if mark < 0 else mark
        words = text[at:end].replace(_BREAK, b" \xff ").split()
        if words:
            yield words
        at = end


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    return docs.filter(F.col(text_col).isNotNull()).select(
        lang.alias("lang"), F.col(text_col).cast("string").cast("binary").alias("text")
    )


def _record(held: dict[tuple, Counter]) -> pa.RecordBatch:
    """(lang, k, phrase, n) of what is held, which is let go."""
    langs, ks, phrases, n = [], [], [], []
    for (lang, k), counts in held.items():
        langs += [lang] * len(counts)
        ks += [k] * len(counts)
        phrases += counts
        n += counts.values()
    held.clear()
    columns = [pa.array(langs, pa.string()), pa.array(ks, pa.int32()), pa.array(phrases, pa.binary()).cast(pa.string())]
    return pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64())], ["lang", "k", "phrase", "n"])


def _full(held: dict[tuple, Counter]) -> bool:
    return sum(map(len, held.values())) >= ENTRIES


def count_words(texts: DataFrame, longest: int, sample: int) -> DataFrame:
    """(lang, k, phrase, n), stored: the words (k = 1), and a sample of the beginnings of 2 to ``longest`` - 1 words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Counter] = defaultdict(Counter)
        at = 0  # places until the next one of the sample
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang = lang.as_py()
                for words in _words(text.as_py()):
                    held[lang, 1].update(words)
                    for start in range(at, len(words), sample):
                        for k in range(2, min(longest - 1, len(words) - start) + 1):
                            if words[start + k - 1] == _BREAK or words[start] == _BREAK:
                                break
                            held[lang, k][b" ".join(words[start : start + k])] += 1
                    at = (at - len(words)) % sample
                    del held[lang, 1][_BREAK]
                    if _full(held):
                        yield _record(held)
        if held:
            yield _record(held)

    found = texts.mapInArrow(run, _COUNTED).groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))
    return materialise(found, "words")


# Filters ------------------------------------------------------------------------------------


def filter_of(places: DataFrame, place: Column) -> np.ndarray:
    """Bits that are set for the 64-bit hash of every row; a bit that is set for another hash costs work only.

    At most 2 ** 28 bits reach the driver and go to the tasks, however many rows there are.
    """
    bits = min(max(FILTER_BITS[0], (16 * places.count()).bit_length()), FILTER_BITS[1])
    place = place.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
    split = places.select(F.shiftright(place, 6).alias("at"), place.bitwiseAND(F.lit(63).cast("long")).cast("int").alias("bit"))
    words = split.groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[words.column("at").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def _set(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash's bit is set."""
    place = hashes & _U(64 * len(bits) - 1)
    return (bits[place >> _U(6)] >> (place & _U(63)) & _U(1)).astype(bool)


class _Codes(dict):
    """The hash of each word of a language, or 0 for one that is not frequent; remembered."""

    def __init__(self, lang: str, bits: np.ndarray):
        self._end, self._bits, self._mask = b"\0" + lang.encode(), bits, 64 * len(bits) - 1

    def __missing__(self, word: bytes) -> int:
        code = xxhash.xxh64_intdigest(word + self._end, 42)
        place = code & self._mask
        self[word] = code = code if int(self._bits[place >> 6]) >> (place & 63) & 1 and word != _BREAK else 0
        return code


def _pair_hashes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether both words are frequent, hash) of each two words that follow each other."""
    first, second = codes[:-1], codes[1:]
    x = first * _U(0x9E3779B97F4A7C15) + second
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    return (first != 0) & (second != 0), x ^ (x >> _U(31))


class _Coder:
    """Codes of word lists, with a bounded store of words."""

    def __init__(self, bits: np.ndarray):
        self._bits, self._known = bits, {}

    def __call__(self, lang: str, words: list[bytes]) -> np.ndarray:
        if lang not in self._known:
            self._known[lang] = _Codes(lang, self._bits)
        codes = np.fromiter(map(self._known[lang].__getitem__, words), np.uint64, len(words))
        if sum(map(len, self._known.values())) > ENTRIES:
            self._known.clear()
        return codes


def frequent_pairs(texts: DataFrame, bits: np.ndarray, least: int) -> DataFrame:
    """(pair, n), stored: the hashes that two words in a row have ``least`` times or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, held, n = _Coder(bits), [], 0

        def out() -> pa.RecordBatch:
            pairs, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pairs.view(np.int64)), pa.array(counts, pa.int64())], ["pair", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                for words in _words(text.as_py()):
                    both, hashes = _pair_hashes(coder(lang.as_py(), words))
                    held.append(hashes[both])
                    n += len(held[-1])
                    if n >= PAIRS:
                        yield out()
                        held, n = [], 0
        if held:
            yield out()

    found = texts.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return materialise(found.filter(F.col("n") >= least), "pairs")


# Suffixes -----------------------------------------------------------------------------------


def suffixes(texts: DataFrame, words_bits: np.ndarray, pairs_bits: np.ndarray, heavy: dict[str, set[bytes]], longest: int) -> DataFrame:
    """(lang, k, phrase, n): suffixes of two words or more, and the number k of words that say where one goes."""

    def routed(held: dict[str, Counter]) -> dict[tuple, Counter]:
        out: dict[tuple, Counter] = defaultdict(Counter)
        for lang, counts in held.items():
            known = heavy.get(lang)
            if not known:
                out[lang, 2] = counts
                continue
            for suffix, n in counts.items():
                words, k = suffix.split(b" "), 2
                while k < longest and b" ".join(words[:k]) in known:
                    k += 1
                out[lang, k][suffix] = n
        held.clear()
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, held = _Coder(words_bits), defaultdict(Counter)
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang = lang.as_py()
                for words in _words(text.as_py()):
                    both, hashes = _pair_hashes(coder(lang, words))
                    both &= _set(pairs_bits, hashes)
                    stop, on = np.arange(1, len(words)), both  # where each suffix ends, and whether it goes on there
                    for step in range(1, longest):
                        stop = stop + on
                        on = np.append(on[1:], False) & both
                    starts = np.nonzero(both)[0]
                    held[lang].update([b" ".join(words[a:b]) for a, b in zip(starts.tolist(), stop[starts].tolist())])
                    if _full(held):
                        yield _record(routed(held))
        if held:
            yield _record(routed(held))

    return texts.mapInArrow(run, _COUNTED)


# Sorting ------------------------------------------------------------------------------------


def quicksorted(words: np.ndarray, weight: np.ndarray, route: np.ndarray, least: int, shortest: int = 1) -> list[tuple[int, int, int]]:
    """(row, length, count) of the beginnings of ``shortest`` columns or more that rows of ``words`` share: one row that has it.

    Three-way partitions of pointers to rows, one column after the other; zero ends a row. A partition
    below ``least`` is given up, unless some rows went by more columns (``route``) than those sorted: then others
    that begin alike are elsewhere, and what is here is told whatever it is.
    """
    found = []
    todo = [(np.arange(len(words)), 0)]
    while todo:
        rows, depth = todo.pop()
        whole = max(depth + 1, shortest)
        if not len(rows) or (int(weight[rows].sum()) < least and not (route[rows] > whole).any()):
            continue
        keys = words[rows, depth]
        some = keys[:: max(1, len(keys) // 64)]
        pivot = np.partition(some, len(some) // 2)[len(some) // 2]
        equal = rows[keys == pivot]
        todo += [(rows[keys < pivot], depth), (rows[keys > pivot], depth)]
        if not pivot:
            continue
        if depth + 1 >= shortest:
            count = int(weight[equal].sum())
            if count < least and route[equal[0]] <= whole:
                continue
            found.append((int(equal[0]), depth + 1, count))
        if depth + 1 < words.shape[1]:
            todo.append((equal, depth + 1))
    return found


def _codes(phrases: pa.Array, longest: int) -> np.ndarray:
    """A row of codes from 1 for the words of each phrase, and zeros after the last."""
    parts = pc.split_pattern(phrases, " ")
    offsets = parts.offsets.to_numpy()
    n = np.diff(offsets)
    out = np.zeros((len(n), longest), dtype=np.int64)
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(offsets[0], offsets[-1]) - offsets[row]] = pc.dictionary_encode(parts.flatten()).indices.to_numpy() + 1
    return out


def _sort(least: int, longest: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        langs, phrases = (table.column(c).combine_chunks() for c in ("lang", "phrase"))
        lang = pc.dictionary_encode(langs).indices.to_numpy() + 1
        words = np.column_stack((lang, _codes(phrases, longest)))
        found = quicksorted(words, table.column("n").to_numpy(), table.column("k").to_numpy() + 1, least, shortest=3)
        out = [(langs[row].as_py(), n - 1, " ".join(phrases[row].as_py().split(" ")[: n - 1]), count) for row, n, count in found]
        schema = pa.schema([("lang", pa.string()), ("k", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 4, schema)], schema=schema)

    return run


def phrases(
    docs: DataFrame,
    least: int = 100,
    longest: int = 5,
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
    heavy_rows: int = HEAVY,
    buckets: int = BUCKETS,
) -> tuple[DataFrame, DataFrame]:
    """((lang, k, phrase, n) of every phrase of 1 to ``longest`` words that occurs ``least`` times, (lang, n) of all words); stored.

    ``sample`` and ``heavy_rows`` only say which task sorts a suffix.
    """
    texts = _texts(docs, text_col, lang_col)
    counted = count_words(texts, longest, sample)
    words = counted.filter("k = 1")
    totals = materialise(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    total = totals.agg(F.sum("n")).first()[0] or 0
    frequent = words.filter(F.col("n") >= least)
    words_bits = filter_of(frequent, F.xxhash64(F.concat("phrase", F.lit("\0"), "lang")))
    pairs_bits = filter_of(frequent_pairs(texts, words_bits, least), F.col("pair"))
    heavy: dict[str, set[bytes]] = defaultdict(set)
    enough = max(heavy_rows, total // MOST_HEAVY) / sample
    for row in counted.filter((F.col("k") > 1) & (F.col("n") >= enough)).toLocalIterator():
        heavy[row.lang].add(row.phrase.encode())
    found = suffixes(texts, words_bits, pairs_bits, dict(heavy), longest)
    buckets = max(buckets, total // BUCKET)
    bucket = F.pmod(F.xxhash64("lang", "k", F.expr("substring_index(phrase, ' ', k)")), F.lit(buckets))
    sorted_ = found.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(_sort(least, longest), _COUNTED)
    longer = sorted_.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return materialise(frequent.unionByName(longer), "phrases"), totals


# Collocations -------------------------------------------------------------------------------


def _scored(found: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, k, phrase, a, l, r, n, score) of every phrase of two words or more, by its weakest cut."""
    counts = found.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("n").alias("_f"))
    longer = found.filter("k > 1").withColumnRenamed("n", "a")
    cut = longer.select("*", F.explode(F.expr("sequence(1, k - 1)")).alias("cut"))
    sides = cut.select("lang", "k", "phrase", "a", "cut", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    part = F.expr("CASE side WHEN 0 THEN substring_index(phrase, ' ', cut) ELSE substring_index(phrase, ' ', cut - k) END")
    sides = materialise(sides.withColumn("part", part), "cuts")  # plain tables, so that a frequent word's join can be split
    joined = sides.join(counts, (F.col("lang") == F.col("_lang")) & (F.col("part") == F.col("_part")))
    f = lambda side: F.max(F.when(F.col("side") == side, F.col("_f")))
    halves = joined.groupBy("lang", "k", "phrase", "a", "cut").agg(f(0).alias("l"), f(1).alias("r"))
    halves = halves.join(totals, "lang")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    halves = halves.withColumn("_over", wide("a") * wide("n") * F.lit(1000).cast("decimal(4,0)")).withColumn("_under", wide("l") * wide("r"))
    best = F.min(F.struct(F.expr("_over div _under").alias("score"), "cut", "l", "r"))
    return halves.groupBy("lang", "k", "phrase", "a", "n").agg(best.alias("b")).select(
        "lang", "k", "phrase", "a", "b.l", "b.r", "n", "b.score"
    )


def _within_longer(found: DataFrame) -> DataFrame:
    """(lang, phrase, most): the count of the most frequent phrase that is longer by a word and holds it.

    A phrase that is longer still occurs no more often than one of these.
    """
    ends = F.array(F.expr("substring_index(phrase, ' ', k - 1)"), F.expr("substring_index(phrase, ' ', 1 - k)"))
    inner = found.filter("k > 2").select(F.col("lang").alias("_lang"), F.explode(ends).alias("_phrase"), "n")
    return inner.groupBy("_lang", "_phrase").agg(F.max("n").alias("_most"))


def collocations(
    docs: DataFrame,
    least: int = 100,
    longest: int = 5,
    top: int = 2000,
    within: tuple[int, int] = (1, 1),
    text_col: str = "text",
    lang_col: str = "lang",
    **routing,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language that hold together best.

    Texts, with A to Z in lower case, are cut at .,;:!? and line ends, and at blanks and tabs into words.
    A phrase of 2 to ``longest`` words is a candidate if it occurs a >= ``least`` times, overlaps included.
    Cutting it in two gives parts that occur l and r times, and a score of floor(1000 * a * n / (l * r)),
    n being the words of the language; the lowest counts, ties to the first cut. A candidate inside a
    longer one that occurs at least ``within`` (a fraction) as often is left out. Ranks go by
    score and a, falling, and then by phrase. Arithmetic is exact.

    A null or empty text has no words, and a null language is ``und``. Repeated rows count each time.
    Other columns are not read. An empty table gives no rows.
    """
    found, totals = phrases(docs, least, longest, text_col, lang_col, **routing)
    longer = _within_longer(found)
    scored = _scored(found, totals).join(longer, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_phrase")), "left")
    alone = F.col("_most").isNull() | (within[1] * F.col("_most") < within[0] * F.col("a"))
    best = [F.desc("score"), F.desc("a"), "phrase"]
    kept = scored.filter(alone).withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*best))).filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
