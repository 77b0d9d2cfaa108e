"""Best-fit packing planned on a histogram of lengths.

Best-fit decreasing looks at lengths only, so it is run over the counts of at most
``size`` lengths instead of over documents. Sequences with the same room are held as
ranges, and a length takes a whole range at a time. The plan says which ranks of a
length go where, and every document finds its slot by its rank within its length.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recmill.llm.tokens import encoder
from recmill.sources.scratch import materialise

SIZE = 2048
SALTS = 64  # least number of parts a length is ranked in
PART_ROWS = 1_000_000  # a length's part holds about this many pieces at most
CHARS = 1_000_000  # encoded together
BROADCAST_ROWS = 200_000  # digests of 32 bytes, some 30 MB in memory


def plan(histogram: dict[int, int], size: int = SIZE) -> np.ndarray:
    """Best-fit decreasing over counts: rows (length, rank, pieces, sequence, each, offset).

    The ``pieces`` pieces of a length from ``rank`` on go to sequences from ``sequence``
    on, ``each`` to a sequence, from ``offset`` there. A piece goes to the sequence with
    the least room that holds it, and to a new one where none does. A range of sequences
    is met again only when its room has at least halved, and each length cuts one range at
    most, so there are fewer than 3 * size * log2(size) rows whatever is packed.
    """
    rooms: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []  # the rooms, ascending
    rows, following = [], 0

    def add(room: int, first: int, n: int) -> None:
        if room not in rooms:
            rooms[room] = []
            bisect.insort(order, room)
        rooms[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect.bisect_left(order, length)
            if at == len(order):
                n = -(-left // (size // length))
                add(size, following, n)
                following += n
                continue
            room = order[at]
            first, n = rooms[room].pop(0)
            if not rooms[room]:
                del rooms[room]
                order.pop(at)
            each = room // length
            full = min(n, left // each)
            if full:
                rows.append((length, rank, full * each, first, each, size - room))
                add(room - each * length, first, full)
                rank, left, first, n = rank + full * each, left - full * each, first + full, n - full
            if left and n:
                rows.append((length, rank, left, first, each, size - room))
                add(room - left * length, first, 1)
                rank, left, first, n = rank + left, 0, first + 1, n - 1
            if n:
                add(room, first, n)
    return np.array(rows, dtype=np.int64).reshape(-1, 6)


def _encoded(texts: DataFrame, tokenizer: str, size: int, end_id: int, with_ids: bool) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]) of each (key, text)."""
    key_type = {"bigint": pa.int64(), "string": pa.string()}[dict(texts.dtypes)["key"]]
    fields = [("key", key_type), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int64()))] * with_ids)
    end = np.array([end_id], dtype="<u4").tobytes()

    def rows(keys: list, encoded: list[bytes]) -> pa.RecordBatch:
        out = []
        for key, data in zip(keys, encoded):
            data += end
            for n, at in enumerate(range(0, len(data), 4 * size)):
                part = data[at : at + 4 * size]
                row = (key, n, at // 4, len(part) // 4, zlib.crc32(part))
                out.append(row + (np.frombuffer(part, "<u4").astype(np.int64),) * with_ids)
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            keys, texts, chars = [], [], 0
            for key, text in zip(batch.column(0), batch.column(1)):
                keys.append(key.as_py())
                texts.append(text.as_py())
                chars += len(texts[-1])
                if chars > CHARS:
                    yield rows(keys, encode(texts))
                    keys, texts, chars = [], [], 0
            if keys:
                yield rows(keys, encode(texts))

    kind = dict(texts.dtypes)["key"]
    return texts.mapInArrow(run, f"key {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids)


def pieces(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SIZE,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each document's ids, cut where longer than ``size``.

    A document's ids are its text's and ``end_id``; a null text is empty. A text that several rows
    hold is encoded once, and its pieces meet these rows by a stored join on its MD5.
    """
    texts = docs.select(
        F.col(id_col).cast("long").alias("key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    encoded = lambda of: _encoded(of, tokenizer, size, end_id, with_ids)
    holders = materialise(texts.select(F.col("key").alias("doc_id"), F.md5("text").alias("digest")), "digests")
    counts = holders.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    several = materialise(counts.filter("n > 1").select("digest"), "several")
    if not several.limit(1).count():
        return encoded(texts).withColumnRenamed("key", "doc_id")
    if several.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        several = F.broadcast(several)
    here = F.md5("text") == F.col("digest")
    once = encoded(texts.join(several, here, "left_anti")).withColumnRenamed("key", "doc_id")
    shared = texts.join(several, here, "left_semi").groupBy(F.md5("text").alias("key")).agg(F.first("text").alias("text"))
    shared = materialise(encoded(shared), "shared")
    met = holders.join(shared, F.col("digest") == F.col("key")).drop("digest", "key")
    return once.unionByName(met)


def _ranked(cut: DataFrame, total: int) -> DataFrame:
    """Add the rank within the length, from 0, counted in parts so that no length is one group."""
    salts = max(SALTS, -(-total // PART_ROWS))
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    parts = salted.groupBy(F.col("length").alias("_l"), F.col("_salt").alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_l").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("_l", "_s", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    order = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    inside = salted.withColumn("_row", F.row_number().over(order) - 1)
    joined = inside.join(base, (F.col("length") == F.col("_l")) & (F.col("_salt") == F.col("_s")))
    return joined.select(*cut.columns, (F.col("_base") + F.col("_row")).alias("rank"))


def place(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """Add (sequence_id, offset) to pieces of at most ``size`` tokens.

    ``cut`` is read three times and should be stored. Only the histogram, of ``size``
    lengths at most, reaches the driver, and only the plan made from it goes back.
    """
    counts = cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    histogram = {row["length"]: row["n"] for row in counts}
    planned = plan(histogram, size)
    planned = planned[np.lexsort((planned[:, 1], planned[:, 0]))]
    lengths = np.unique(planned[:, 0])
    starts = np.searchsorted(planned[:, 0], lengths)
    ends = np.append(starts[1:], len(planned))
    ranked, kept = _ranked(cut, sum(histogram.values())), cut.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            row = np.empty(len(length), dtype=np.int64)
            for value in np.unique(length):
                which = np.nonzero(length == value)[0]
                at = np.searchsorted(lengths, value)
                row[which] = starts[at] + np.searchsorted(planned[starts[at] : ends[at], 1], rank[which], "right") - 1
            _, first, _, sequence, each, offset = planned[row].T
            place = rank - first
            found = [pa.array(sequence + place // each), pa.array(offset + place % each * length)]
            columns = [batch.column(batch.schema.get_field_index(name)) for name in kept]
            yield pa.RecordBatch.from_arrays([*columns, *found], [*kept, "sequence_id", "offset"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    return ranked.mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SIZE,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset) of every piece of every row.

    Pieces of at most ``size`` tokens fill sequences of ``size`` tokens without gaps, one
    after the other. A null or empty text is one piece that holds ``end_id`` alone. Rows
    that repeat an id, and rows of null id, are documents of their own. Other columns of
    ``docs`` are not read; an empty table gives no rows.
    """
    return place(materialise(pieces(docs, tokenizer, id_col, text_col, size, end_id, with_ids), "pieces"), size)
