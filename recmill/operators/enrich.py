"""Enrichment steps: call a provider per row, flatten and read its responses."""

from __future__ import annotations

import functools
import hashlib
import json
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from types import CodeType, FunctionType, MethodType, ModuleType
from urllib.parse import unquote

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recmill.operators.skew import HEAVY_ROWS, lookup_join
from recmill.sources.paths import create_text, is_complete, listing, located, read_text
from recmill.sources.scratch import materialise
from recmill.sources.steps import read_step, write_step

LINK_PATTERN = r'(?:src|href)="([^"]+)"'
INLINE_WORDS = 10_000  # most words placed into an expression
INLINE_NAMES = 50  # most names looked for within the row
BROADCAST_WORDS = 1_000_000  # most words broadcast
PART_CHARS = 32_000_000  # characters of text, about, that one task reads at once
SLICE_NAMES = 1_000_000  # names, about, that one task looks for at once
MANIFEST = "_manifest.json"
Provider = Callable[[Sequence], Sequence]


def _asked(provider: Provider, values: list) -> list:
    answers = list(provider(values))
    if len(answers) != len(values):
        raise ValueError(f"the provider gave {len(answers)} answers to {len(values)} values")
    return answers


def _answers(provider: Provider, values: list) -> list[tuple]:
    """(response, error) per value; when a batch fails, its rows are tried one by one."""
    try:
        return [(answer, None) for answer in _asked(provider, values)]
    except Exception:
        pass
    pairs = []
    for value in values:
        try:
            pairs.append((_asked(provider, [value])[0], None))
        except Exception as problem:
            pairs.append((None, str(problem) or type(problem).__name__))
    return pairs


def enrich(
    df: DataFrame,
    provider: Provider,
    in_col: str,
    out_col: str,
    response_schema: str,
    error_col: str | None = None,
    concurrency: int | None = None,
) -> DataFrame:
    """Add the provider's response to ``in_col``.

    ``provider`` takes a list of values and returns as many responses (dicts or
    None). Only ``in_col`` travels to Python, in Arrow batches. A NULL input is not
    sent; a failing row gets a NULL response and its message in ``error_col``, and so do
    rows of a batch that gets too few or too many answers, unless they succeed alone.
    ``concurrency`` bounds the calls running at once.
    """

    def respond(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for values in batches:
            present = values.notna().to_numpy()
            answered = iter(_answers(provider, values[present].tolist()) if present.any() else [])
            pairs = [next(answered) if here else (None, None) for here in present]
            yield pd.DataFrame(pairs, columns=["response", "error"], dtype=object)

    respond.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    call = F.pandas_udf(respond, f"response {response_schema}, error string")
    bounded = df.repartition(concurrency) if concurrency else df
    answered = bounded.withColumn("_answer", call(F.col(in_col)))
    columns = {out_col: F.col("_answer.response")}
    if error_col:
        columns[error_col] = F.col("_answer.error")
    return answered.withColumns(columns).drop("_answer")


def _patient(provider: Provider, values: list, attempts: int, backoff: float) -> list[tuple]:
    """(response, error) per value; a batch that fails is tried again after a growing pause, then one by one."""
    for attempt in range(attempts - 1):
        try:
            return [(answer, None) for answer in _asked(provider, values)]
        except Exception:
            time.sleep(backoff * 2**attempt)
    return _answers(provider, values)


def enrich_distinct(
    df: DataFrame,
    provider: Provider,
    in_col: str,
    out_col: str,
    response_schema: str,
    error_col: str | None = None,
    concurrency: int | None = None,
    batch: int = 100,
    in_flight: int = 4,
    attempts: int = 3,
    backoff: float = 0.5,
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """As :func:`enrich`, with each distinct value sent once, however many rows hold it.

    A task keeps ``in_flight`` calls of ``batch`` values going at once, and ``concurrency`` bounds the
    tasks. A call that fails is made again, ``attempts`` times in all, with pauses that double from
    ``backoff`` seconds; then its values are tried one by one. Answers are stored before they meet the
    rows by digest, so reading the result twice sends nothing again (a task that is lost
    sends its own again); rows of a value that very many hold meet its answer without moving.
    """
    key = _free(df, "_key")
    digest = F.sha2(F.to_json(F.struct(F.col(in_col).alias("v"))), 256)
    keyed = df.withColumn(key, F.when(F.col(in_col).isNotNull(), digest))

    def respond(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(in_flight) as pool:
            for values in batches:
                held = values.tolist()
                parts = [held[at : at + batch] for at in range(0, len(held), batch)]
                answered = pool.map(lambda part: _patient(provider, part, attempts, backoff), parts)
                pairs = [pair for part in answered for pair in part]
                yield pd.DataFrame(pairs, columns=["response", "error"], dtype=object)

    respond.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    call = F.pandas_udf(respond, f"response {response_schema}, error string")
    values = keyed.filter(F.col(key).isNotNull()).groupBy(key).agg(F.any_value(in_col).alias("_v"))
    if concurrency:
        values = values.repartition(concurrency)
    answers = materialise(values.select(key, call("_v").alias("_answer")), "answers")
    answer = _free(df, "_answer")
    found = lookup_join(keyed, answers.withColumnRenamed("_answer", answer), key, "left", min_rows)
    columns = {out_col: F.col(f"{answer}.response")}
    if error_col:
        columns[error_col] = F.col(f"{answer}.error")
    return found.withColumns(columns).drop(key, answer)


def extract_links(df: DataFrame, html: str, out: str) -> DataFrame:
    """Targets of all src and href attributes, as a search-response array of (url)."""
    found = F.regexp_extract_all(F.col(html), F.lit(LINK_PATTERN), F.lit(1))
    return df.withColumn(out, F.transform(found, lambda url: F.struct(url.alias("url"))))


def explode_urls(df: DataFrame, col: str, out: str = "url") -> DataFrame:
    """One row per url of a response array; rows without any are dropped."""
    others = [c for c in df.columns if c not in (col, out)]
    return df.select(*others, F.explode(F.col(f"{col}.url")).alias(out))


def _pieces(text: str | Column) -> Column:
    """Lower-case runs of letters, and perhaps an empty piece at either end."""
    text = F.col(text) if isinstance(text, str) else text
    return F.split(F.lower(text), r"[^\p{L}]+")


def words(text: str | Column) -> Column:
    """Lower-case runs of letters, of any language."""
    return F.filter(_pieces(text), lambda word: word != "")


def _free(df: DataFrame, name: str) -> str:
    """``name``, longer where the columns have it already."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


def _by_text(df: DataFrame, text: str, found: DataFrame, default: Column, out: str) -> DataFrame:
    """``df`` with ``found`` (_key, _value) of each row's text; NULL for a NULL text."""
    key, value = _free(df, "_key"), _free(df, "_value")
    keyed = df.withColumn(key, F.md5(F.col(text)))  # so that rows whose text is not asked for move without it
    joined = keyed.join(found.select(F.col("_key").alias(key), F.col("_value").alias(value)), key, "left")
    filled = F.when(F.col(key).isNotNull(), F.coalesce(F.col(value), default))
    return joined.withColumn(out, filled).drop(key, value)


def _texts(df: DataFrame, text: str) -> DataFrame:
    """(_key, _text) of the distinct texts: what is found in a text depends on it alone."""
    texts = df.select(F.col(text).alias("_text")).filter(F.col("_text").isNotNull())
    return texts.groupBy(F.md5("_text").alias("_key")).agg(F.min("_text").alias("_text"))


def _in_parts(df: DataFrame, text: str) -> DataFrame:
    """(_key, _text, _part) of the rows that have a text, stored; a part is about ``PART_CHARS`` characters of neighbouring rows."""
    keyed = df.select(F.md5(F.col(text)).alias("_key"), F.col(text).alias("_text")).filter(F.col("_text").isNotNull())
    stored = materialise(keyed.withColumn("_id", F.monotonically_increasing_id()), "parts")
    mean = stored.agg(F.avg(F.length("_text"))).first()[0] or 1
    rows = max(1, int(PART_CHARS / max(mean, 1)))
    return stored.select("_key", "_text", F.floor(F.col("_id") / rows).alias("_part"))


def _part_words(parts: DataFrame) -> DataFrame:
    """(_part, _word, _n): the distinct words of each part and how often it has them, stored."""
    tokens = parts.select("_part", F.explode(words("_text")).alias("_word"))
    return materialise(tokens.groupBy("_part", "_word").agg(F.count(F.lit(1)).alias("_n")), "words")


def _met(parts: DataFrame, known: DataFrame, keys: Sequence[str], body, schema: str) -> DataFrame:
    """``body`` of the texts (_key, _running) of each part and of the rows of ``known`` that are for it."""
    running = parts.select(*keys, "_key", F.array_join(words("_text"), " ").alias("_running"))
    return running.groupBy(*keys).cogroup(known.groupBy(*keys)).applyInArrow(body, schema)


def _split(texts: pa.Table) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after another, and where each text's begin and the last's end."""
    pieces = pc.split_pattern(texts.column("_running").cast(pa.large_string()).combine_chunks(), " ")
    lengths = pc.list_value_length(pieces).to_numpy(zero_copy_only=False)
    return pieces.flatten(), np.r_[0, np.cumsum(lengths, dtype=np.int64)]


def _places(found: pa.Array, known: pa.Array) -> np.ndarray:
    """The place of each word in ``known``, -1 where it is not there."""
    return pc.fill_null(pc.index_in(found, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _large(column: pa.ChunkedArray) -> pa.Array:
    return column.cast(pa.large_string()).combine_chunks()


def _mean_weights(texts: pa.Table, weights: pa.Table) -> pa.Table:
    """(_key, _value): the mean weight of the known words of each text that has any."""
    found, starts = _split(texts)
    place = _places(found, _large(weights.column("_word")))
    here = np.flatnonzero(place >= 0)
    row = np.searchsorted(starts, here, side="right") - 1
    weight = weights.column("_weight").to_numpy()[place[here]]
    n = np.bincount(row, minlength=texts.num_rows)
    total = np.bincount(row, weights=weight, minlength=texts.num_rows)
    some = np.flatnonzero(n)
    keys = texts.column("_key").combine_chunks().take(pa.array(some))
    return pa.table({"_key": keys, "_value": pa.array(total[some] / n[some], pa.float64())})


def sentiment(
    df: DataFrame,
    text: str,
    lexicon: Mapping[str, float] | DataFrame,
    out: str = "sentiment",
    max_inline: int = INLINE_WORDS,
    max_broadcast: int = BROADCAST_WORDS,
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Response array<struct<score>>: the mean weight of the lexicon words in the text.

    ``lexicon`` maps words to weights, or is a table of (word, weight), of any size; words
    are lower-cased, empty ones and null weights left out, and a repeated word has its mean
    weight. Up to ``max_inline`` words are looked up within the row and the texts stay
    where they are; up to ``max_broadcast`` are broadcast to the words of each distinct text.
    More are joined to the distinct words of each part of the texts, of some megabytes, and
    the texts of a part meet only those. No lexicon word, no score.
    """
    if isinstance(lexicon, DataFrame):
        named = lexicon.select(F.lower("word").alias("_word"), F.col("weight").cast("double").alias("_weight"))
        named = named.filter((F.col("_word") != "") & F.col("_weight").isNotNull())
        named = materialise(named.groupBy("_word").agg(F.avg("_weight").alias("_weight")), "lexicon")
        size = named.count()
        few = {r["_word"]: r["_weight"] for r in named.collect()} if size <= max_inline else {}
    else:
        weights: dict[str, list[float]] = {}
        for word, weight in lexicon.items():
            if word and weight is not None:
                weights.setdefault(word.lower(), []).append(float(weight))
        few = {word: sum(w) / len(w) for word, w in weights.items()}
        size = len(few)
        named = df.sparkSession.createDataFrame(list(few.items()), "_word string, _weight double")
    if size <= max_inline:
        score = _inline_score(text, few)
    elif size <= max_broadcast:
        tokens = _texts(df, text).select("_key", F.explode(words("_text")).alias("_word"))
        scores = tokens.join(F.broadcast(named), "_word").groupBy("_key").agg(F.avg("_weight").alias("_value"))
    else:
        parts = _in_parts(df, text)
        weights = lookup_join(_part_words(parts).select("_part", "_word"), named, "_word", "inner", min_rows)
        scores = _met(parts, weights, ["_part"], _mean_weights, "_key string, _value double").dropDuplicates(["_key"])
    if size > max_inline:
        df, score = _by_text(df, text, scores, F.lit(None).cast("double"), "_score"), F.col("_score")
    scored = df.withColumn(out, F.array(F.struct(score.alias("score"))))
    return scored if size <= max_inline else scored.drop("_score")


def _inline_score(text: str, lexicon: Mapping[str, float]) -> Column:
    if not lexicon:
        return F.lit(None).cast("double")
    by_weight: dict[float, list[str]] = {}
    for word, value in lexicon.items():
        by_weight.setdefault(value, []).append(word)

    def weigh(word: Column) -> Column:
        found = [F.when(word.isin(members), F.lit(value)) for value, members in by_weight.items()]
        return F.coalesce(*found)

    start = F.struct(F.lit(0.0).alias("total"), F.lit(0).cast("long").alias("n"))

    def add(state: Column, value: Column) -> Column:
        return F.struct((state["total"] + value).alias("total"), (state["n"] + 1).alias("n"))

    listed = list(lexicon)
    known = F.filter(_pieces(text), lambda word: word.isin(listed))
    return F.aggregate(F.transform(known, weigh), start, add, lambda s: F.try_divide(s["total"], s["n"]))


def first_score(df: DataFrame, col: str = "sentiment", out: str = "sentimentScore") -> DataFrame:
    return df.withColumn(out, F.get(F.col(col), 0)["score"])


def _entities(names: Column) -> Column:
    """A recognition response listing ``names``."""
    listed = F.transform(names, lambda name: F.struct(name.alias("name")))
    return F.struct(F.struct(listed.alias("celebrities")).alias("result"))


def _running(text: str | Column) -> Column:
    """The words of a text between single blanks, with one before and one after."""
    return F.concat(F.lit(" "), F.array_join(words(text), " "), F.lit(" "))


def _held(running: Column, candidates: Column) -> Column:
    """The candidates that a running text holds, by first place and the longer first."""

    def found(whole: Column) -> Column:
        placed = F.transform(
            candidates,
            lambda name: F.struct(
                F.instr(whole, F.concat(F.lit(" "), name, F.lit(" "))).alias("at"), (-F.length(name)).alias("n"), name.alias("name")
            ),
        )
        return F.transform(F.array_sort(F.filter(placed, lambda p: p["at"] > 0)), lambda p: p["name"])

    return F.element_at(F.transform(F.array(running), found), 1)


class _Trie:
    """Names as word runs: a level for each word, the numbered runs of so many words that begin a name."""

    def __init__(self, names: pa.Array):
        pieces = pc.split_pattern(names, " ")
        flat, sizes = pieces.flatten(), pc.list_value_length(pieces).to_numpy(zero_copy_only=False)
        starts = np.cumsum(sizes) - sizes
        self.words = pc.unique(flat)
        ids, run, rows = _places(flat, self.words), np.zeros(len(sizes), np.int64), np.arange(len(sizes))
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # the codes of a level's runs, and the name each is or -1
        for depth in range(sizes.max(initial=0)):
            rows = rows[sizes[rows] > depth]
            codes, run[rows] = np.unique(run[rows] * len(self.words) + ids[starts[rows] + depth], return_inverse=True)
            whole, ends = np.full(len(codes), -1), rows[sizes[rows] == depth + 1]
            whole[run[ends]] = ends
            self.levels.append((codes, whole))

    def hits(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, number of words, name) of every occurrence; ``ends`` is where the text of a place ends."""
        at, found = np.flatnonzero(ids >= 0), []
        run = np.zeros(len(at), np.int64)
        for depth, (codes, whole) in enumerate(self.levels):
            inside = at + depth < ends[at]
            at, run = at[inside], run[inside]
            word = ids[at + depth]
            code = run * len(self.words) + word
            run = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            on = (word >= 0) & (codes[run] == code)
            at, run = at[on], run[on]
            names = whole[run]
            ended = names >= 0
            found.append((at[ended], np.full(ended.sum(), depth + 1), names[ended]))
        return tuple(np.concatenate(column) for column in zip(*found))


FOUND = "array<struct<at:int,n:int,name:string>>"


def _names_found(texts: pa.Table, names: pa.Table) -> pa.Table:
    """(_key, _found): the names that each text holds, by first place and the longer first."""
    entry = pa.struct([("at", pa.int32()), ("n", pa.int32()), ("name", pa.string())])
    if not names.num_rows or not texts.num_rows:
        return pa.table({"_key": pa.array([], pa.string()), "_found": pa.array([], pa.list_(entry))})
    phrases = _large(names.column("_phrase"))
    trie = _Trie(phrases)
    found, starts = _split(texts)
    ends = np.repeat(starts[1:], np.diff(starts))
    at, n, name = trie.hits(_places(found, trie.words), ends)
    row = np.searchsorted(starts, at, side="right") - 1
    order = np.lexsort((at, name, row))
    at, n, name, row = at[order], n[order], name[order], row[order]
    first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (name[1:] != name[:-1])][: len(row)])
    first = first[np.lexsort((-n[first], at[first], row[first]))]
    at, n, name, row = at[first], n[first], name[first], row[first]
    some, begin = np.unique(row, return_index=True)
    fields = [
        pa.array(at - starts[row], pa.int32()),
        pa.array(-n, pa.int32()),
        phrases.take(pa.array(name)).cast(pa.string()),
    ]
    listed = pa.ListArray.from_arrays(
        pa.array(np.r_[begin, len(row)], pa.int32()), pa.StructArray.from_arrays(fields, fields=list(entry))
    )
    return pa.table({"_key": texts.column("_key").combine_chunks().take(pa.array(some)), "_found": listed})


def _by_rarest_word(df: DataFrame, text: str, names: DataFrame, size: int, few: bool) -> DataFrame:
    """(_key, _value): the names of several words, or one, that each text holds.

    A name is indexed by that of its words which the texts have least often, and only parts of the
    texts that have it look for the name, word by word from every place at once. ``few`` names are
    broadcast; of very many, each slice of ``SLICE_NAMES`` is looked for on its own.
    """
    parts = _in_parts(df, text)
    held = _part_words(parts)
    own = names.select("_phrase", F.explode(F.array_distinct(F.split("_phrase", " "))).alias("_word"))
    held_by = held.groupBy("_word").agg(F.sum("_n").alias("_n"))
    if few:
        known = F.broadcast(own.select("_word").distinct())
        held_by, held = held_by.join(known, "_word", "left_semi"), held.join(known, "_word", "left_semi")
    counted = own.join(held_by, "_word", "left")
    rarest = F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_word")).alias("_rarest")
    index = counted.groupBy("_phrase").agg(rarest).filter("_rarest.n > 0").select("_phrase", F.col("_rarest._word").alias("_word"))
    index = materialise(index, "index")
    near = held.select("_part", "_word").join(F.broadcast(index) if few else index, "_word").select("_part", "_phrase")
    slices = -(-size // SLICE_NAMES)
    if slices == 1:
        found = _met(parts, near, ["_part"], _names_found, f"_key string, _found {FOUND}").dropDuplicates(["_key"])
    else:
        near = near.withColumn("_slice", F.pmod(F.xxhash64("_phrase"), F.lit(slices)).cast("int"))
        copies = parts.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
        found = _met(copies, near, ["_part", "_slice"], _names_found, f"_key string, _found {FOUND}")
        # copies of a text find the same names
        found = found.groupBy("_key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("_found")))).alias("_found"))
    return found.select("_key", F.col("_found.name").alias("_value"))


def recognise(
    df: DataFrame,
    text: str,
    vocabulary: DataFrame,
    name: str = "name",
    out: str = "celebs",
    max_inline: int = INLINE_NAMES,
    max_broadcast: int = BROADCAST_WORDS,
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Vocabulary names of each text, in order of first appearance, as a response struct.

    A name is one word or several; it is found where its words follow each other, whatever
    stands between them and however they are capitalised, and is given in lower case. Of
    names that begin at the same word the longer comes first. A vocabulary of at most
    ``max_inline`` names is checked within the row and the texts stay where they are. Of a
    larger one, single words are joined to the words of each distinct text, and where names
    have several words, each is indexed by its rarest one and looked for only in the parts
    of the texts that hold that; by broadcast up to ``max_broadcast`` names. All forms give
    the same; rows need no key.
    """
    joined_name = F.array_join(words(F.col(name)), " ")
    names = vocabulary.select(joined_name.alias("_phrase")).filter(F.col("_phrase") != "").distinct()
    names = materialise(names, "vocabulary")
    size, single = names.count(), not names.filter(F.col("_phrase").contains(" ")).limit(1).count()
    if size <= max_inline:
        few = [row["_phrase"] for row in names.collect()]
        if single:
            found = F.array_distinct(F.filter(_pieces(text), lambda word: word.isin(few)))
        else:
            found = _held(_running(text), F.array(*[F.lit(phrase) for phrase in few]))
        return df.withColumn(out, F.when(F.col(text).isNotNull(), _entities(found)))
    broadcast = size <= max_broadcast
    if single:
        tokens = _texts(df, text).select("_key", F.posexplode(F.array_distinct(words("_text"))).alias("_at", "_phrase"))
        known = tokens.join(F.broadcast(names), "_phrase") if broadcast else lookup_join(tokens, names, "_phrase", "inner", min_rows)
        listed = F.sort_array(F.collect_list(F.struct("_at", "_phrase")))["_phrase"]
        per_text = known.groupBy("_key").agg(listed.alias("_value"))
    else:
        per_text = _by_rarest_word(df, text, names, size, broadcast)
    found = _free(df, "_names")
    named = _by_text(df, text, per_text, F.array().cast("array<string>"), found)
    return named.withColumn(out, F.when(F.col(found).isNotNull(), _entities(F.col(found)))).drop(found)


Step = tuple[str, Callable[[SparkSession, DataFrame | None], DataFrame]]


def _described(value, seen: set[int]) -> str:
    """What a step's function computes, as text: its code, and the values and functions it uses."""
    if id(value) in seen:
        return "again"
    if isinstance(value, DataFrame):
        return f"frame {value.semanticHash()} {_files(value.sparkSession, value.inputFiles())}"
    if isinstance(value, SparkSession | ModuleType | type):
        return getattr(value, "__qualname__", None) or getattr(value, "__name__", "session")
    inner = seen | {id(value)}
    if isinstance(value, CodeType):
        return f"{value.co_code.hex()} {value.co_names} {[_described(c, inner) for c in value.co_consts]}"
    if isinstance(value, functools.partial):
        return _described((value.func, value.args, value.keywords), inner)
    if isinstance(value, MethodType):
        return _described((value.__func__, value.__self__), inner)
    if isinstance(value, FunctionType):
        closed = [cell.cell_contents for cell in value.__closure__ or ()]
        used = [(n, value.__globals__[n]) for n in _names(value.__code__) if n in value.__globals__]
        own = [v if _is_of(v, value) else (n, getattr(v, "__qualname__", str(type(v)))) for n, v in used]
        return _described((value.__code__, value.__defaults__, value.__kwdefaults__, closed, own), inner)
    if isinstance(value, Mapping):
        return str(sorted((repr(k), _described(v, inner)) for k, v in value.items()))
    if isinstance(value, set | frozenset):
        return str(sorted(_described(v, inner) for v in value))
    if isinstance(value, tuple | list):
        return str([_described(v, inner) for v in value])
    if value is None or isinstance(value, bool | int | float | complex | str | bytes) or value is Ellipsis:
        return repr(value)
    if hasattr(value, "__dict__") and not hasattr(value, "_jc"):
        return f"{type(value).__qualname__} {_described(vars(value), inner)}"
    return str(value)


def _names(code: CodeType) -> list[str]:
    inner = [n for c in code.co_consts if isinstance(c, CodeType) for n in _names(c)]
    return sorted({*code.co_names, *inner})


def _is_of(value, function: FunctionType) -> bool:
    """Whether a global is looked into: a plain value, or a function of the same module."""
    if isinstance(value, FunctionType):
        return value.__module__ == function.__module__
    return isinstance(value, bool | int | float | str | bytes | tuple | list | dict | set | frozenset)


def _files(spark: SparkSession, files: Sequence[str]) -> list[str]:
    """Names, sizes and times of all files beside the given ones: a file that is new or gone counts too."""
    return [entry for folder in sorted({f.rpartition("/")[0] for f in files}) for entry in listing(spark, unquote(folder))]


def run_chain(spark: SparkSession, steps: Sequence[Step], root: str, reuse: bool = True) -> DataFrame:
    """Run steps in order, each reading the Parquet output of the one before.

    A step leaves a manifest beside its output: a digest of its function (code, captured
    values, and functions and constants of its module), of the step before it, and the names,
    sizes and times of the files it read. With ``reuse`` a complete output whose manifest
    still holds is read instead of running the step, unless an earlier step had to run; a
    step that reads what is not a file, or calls other modules that change, has to be
    run with ``reuse=False``.
    """
    result, fresh, before = None, False, ""
    described = [_described(step, set()) for _, step in steps]  # before any runs and changes what they capture
    for (name, step), text in zip(steps, described):
        path = f"{root.rstrip('/')}/{name}"
        before = hashlib.md5(f"{before} {name} {text}".encode()).hexdigest()
        if reuse and not fresh and is_complete(spark, path) and _holds(spark, f"{path}/{MANIFEST}", before):
            result = read_step(spark, path)
            continue
        given = step(spark, result)
        outside = [f for f in given.inputFiles() if not unquote(f).startswith(tuple(_own(spark, root)))]
        manifest = {"digest": before, "inputs": outside, "files": _files(spark, outside)}
        result, fresh = write_step(given, path), True
        create_text(spark, f"{path}/{MANIFEST}", json.dumps(manifest))
    return result


def _own(spark: SparkSession, root: str) -> list[str]:
    """How files below ``root`` may be named."""
    hadoop_path, fs = located(spark, root.rstrip("/") + "/x")
    whole = fs.makeQualified(hadoop_path).toString().removesuffix("x")
    return [whole, whole.replace("file:/", "file:///", 1)]


def _holds(spark: SparkSession, manifest: str, digest: str) -> bool:
    found = read_text(spark, manifest)
    if found is None:
        return False
    kept = json.loads(found)
    return kept["digest"] == digest and kept["files"] == _files(spark, kept["inputs"])
