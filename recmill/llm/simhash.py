"""Near-duplicates by 64-bit SimHash, found through Golay-code fuzzy keys.

Fingerprints are compared once per distinct value. Each distinct fingerprint offers its
nearest key for each pair of segments and all its keys (see ``golay``); rows meet by
key, are compared bit by bit, and every task hands on a spanning forest of the links it
saw instead of the links, so a dense group costs rows in proportion to its members.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recmill.llm.components import components
from recmill.llm.golay import MAX_DISTANCE, fuzzy_keys
from recmill.sources.scratch import materialise

SHINGLE_WORDS = 3
SEED = 42
CHUNK = 4096  # rows of one key that meet in one bucket
BROADCAST_ROWS = 400_000  # most rows of a key table sent to every executor
KEY_BITS = 26
STEP = 1 << 21  # pairs compared at once
FOREST = 1 << 20  # links held before they are reduced to a forest


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text's word shingles; 0 without words.

    Words are runs of anything but ASCII white space, with A-Z lower-cased; repeated
    shingles count as often as they occur.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(words) - width + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[width - 1 :].tolist())]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], dtype=">u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, digest, fp): MD5 of the text, and its fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), width) for t in batch.column(2)]
            fp = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp)], ["doc_id", "digest", "fp"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.md5(text).alias("digest"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, digest string, fp long")


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per fingerprint and key, and one more, marked ``near``, for each nearest key."""
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(fp), 20_000):
            part = fp[at : at + 20_000]
            nearest, keys, rows = fuzzy_keys(part.view(np.uint64))
            keys = np.concatenate([nearest.ravel(), keys])
            rows = np.concatenate([np.repeat(np.arange(len(part)), nearest.shape[1]), rows])
            near = np.arange(len(keys)) < nearest.size
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.astype(np.int32)), pa.array(near), pa.array(part[rows])], ["key", "near", "fp"]
            )


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, least node of its tree) that connect what the links a-b connect."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _links(near: np.ndarray, far: np.ndarray, near_at: np.ndarray, counts: np.ndarray, far_at: np.ndarray, most: int):
    """Pairs within ``most`` bits: near[near_at[i]] against the counts[i] values of far from far_at[i] on."""
    at = 0
    while at < len(near_at):
        upto = max(at + 1, int(np.searchsorted(np.cumsum(counts[at:]), STEP, "right")) + at)
        n, c = near_at[at:upto], counts[at:upto]
        left = np.repeat(near[n], c)
        inside = np.arange(len(left)) - np.repeat(np.cumsum(c) - c, c)
        right = far[np.repeat(far_at[at:upto], c) + inside]
        keep = (np.bitwise_count((left ^ right).view(np.uint64)) <= most) & (left != right)
        yield left[keep], right[keep]
        at = upto


def _solve(most: int):
    """Links among rows sorted by bucket: one forest per partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rest: list[np.ndarray] | None = None
        for batch in itertools.chain(batches, [None]):
            new = [] if batch is None else [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if rest is None:
                parts = new
            else:
                parts = [np.concatenate(x) for x in zip(rest, new)] if new else rest
            if not parts or not len(parts[0]):
                continue
            upto = len(parts[0]) if batch is None else int(np.searchsorted(parts[0], parts[0][-1], "left"))
            bucket, near, fp = (p[:upto] for p in parts)
            rest = [p[upto:] for p in parts]
            n, far = np.nonzero(near)[0], np.nonzero(~near)[0]
            lo, hi = (np.searchsorted(bucket[far], bucket[n], side) for side in ("left", "right"))
            some = hi > lo
            held += _links(fp, fp[far], n[some], (hi - lo)[some], lo[some], most)
            if sum(len(a) for a, _ in held) > FOREST:
                held = [forest(*map(np.concatenate, zip(*held)))]
        if held:
            a, b = forest(*map(np.concatenate, zip(*held)))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def _dealt(keyed: DataFrame, chunk: int) -> DataFrame:
    """Add the bucket: the key, and for a key of over ``chunk`` rows a pair of its chunks.

    Rows of such a key are cut into chunks by fingerprint, and each chunk of nearest keys
    meets each chunk of all keys in a bucket of its own, so a bucket stays bounded.
    """
    heavy = keyed.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / chunk).alias("_chunks")).filter("_chunks > 1")
    heavy = materialise(heavy.withColumnRenamed("key", "_key"), "heavy")
    if not heavy.limit(1).count():
        return keyed.select(F.col("key").cast("long").alias("bucket"), "near", "fp")
    chunks = F.coalesce("_chunks", F.lit(1))
    joined = keyed.join(_sized(heavy), F.col("key") == F.col("_key"), "left").select(
        "key", "near", "fp", chunks.alias("_chunks"), F.pmod(F.xxhash64("fp"), chunks).alias("_own")
    )
    joined = joined.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_chunks") - 1)))
    first = F.when(F.col("near"), F.col("_own")).otherwise(F.col("_other"))
    second = F.when(F.col("near"), F.col("_other")).otherwise(F.col("_own"))
    place = first * F.col("_chunks") + second
    return joined.select((F.shiftleft(place, KEY_BITS) + F.col("key")).alias("bucket"), "near", "fp")


def link_forest(distinct: DataFrame, most: int = MAX_DISTANCE, chunk: int = CHUNK) -> DataFrame:
    """(a, b): links that connect exactly what links of at most ``most`` bits connect.

    ``distinct`` has one row per fingerprint, in column fp; ``most`` is 3 at most.
    """
    if not 0 <= most <= MAX_DISTANCE:
        raise ValueError(f"the keys cover distances from 0 to {MAX_DISTANCE}")
    tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a row becomes some 90
    keyed = distinct.select("fp").repartition(tasks).mapInArrow(_keyed, "key int, near boolean, fp long")
    dealt = _dealt(keyed, chunk).repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(_solve(most), "a long, b long")


def _grouped(docs: DataFrame, id_col: str, text_col: str, width: int, most: int) -> DataFrame:
    """(doc_id, digest, fp, root, component_id) of every row; root is a component's own number."""
    rows = materialise(fingerprints(docs, id_col, text_col, width), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    linked = materialise(components(link_forest(distinct, most), "a", "b"), "components")
    member = distinct.join(linked, F.col("fp") == F.col("node"))
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = member.select("fp", F.col("root").alias("_root")).join(least, F.col("_root") == F.col("root"))
    alone = distinct.join(linked, F.col("fp") == F.col("node"), "left_anti")
    by_fp = ids.select(F.col("fp").alias("_fp"), "root", "component_id").unionByName(
        alone.select(F.col("fp").alias("_fp"), F.col("fp").alias("root"), F.col("least").alias("component_id"))
    )
    by_fp = materialise(by_fp, "by_fingerprint")  # a plain table, so that a hot fingerprint's join can be split
    return rows.join(by_fp, F.col("fp") == F.col("_fp")).drop("_fp")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE_WORDS,
    most: int = MAX_DISTANCE,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    Documents are linked when their fingerprints differ in at most ``most`` bits;
    component_id is the smallest id reachable over links, the row's own included. A null
    or blank text has fingerprint zero and links like any other. Rows that repeat an id
    each get their row; an id links nothing by itself. Null ids count only where a whole
    component has no other (component_id null). Other columns of ``docs`` are not read;
    an empty table gives no rows.
    """
    return _grouped(docs, id_col, text_col, width, most).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_first(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE_WORDS,
    most: int = MAX_DISTANCE,
) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: the one of the smallest id.

    Of several texts under that id the one with the smallest MD5 stays, and of rows that
    repeat id and text one stays. A component without ids keeps one row as well.
    """
    copies = _grouped(docs, id_col, text_col, width, most).groupBy("root", "doc_id", "digest").agg(
        F.count(F.lit(1)).alias("n")
    )
    copies = materialise(copies, "copies")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", F.col("digest").isNull(), "digest")
    first = copies.groupBy("root").agg(F.min(place).alias("f"))
    first = first.select(F.col("f.doc_id").alias("_id"), F.col("f.digest").alias("_digest"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("digest").eqNullSafe(F.col("_digest"))
    names = [F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")]
    lost = materialise(copies.join(first, same, "left_anti").select(*names), "lost")
    again = materialise(copies.filter("n > 1").join(first, same, "left_semi").select(*names), "again")

    own, mark = (_unused(docs, name) for name in ("_id", "_digest"))  # docs may have columns of these names
    lost, again = (table.withColumnsRenamed({"_id": own, "_digest": mark}) for table in (lost, again))
    here = docs[id_col].cast("long").eqNullSafe(F.col(own)) & F.md5(docs[text_col].cast("string")).eqNullSafe(F.col(mark))
    kept = docs.join(_sized(lost), here, "left_anti")
    if not again.limit(1).count():
        return kept
    again = _sized(again)
    once = kept.join(again, here, "left_semi").dropDuplicates([id_col, text_col])
    return kept.join(again, here, "left_anti").unionByName(once)


def _unused(docs: DataFrame, name: str) -> str:
    """``name``, longer where the columns have it already."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _sized(table: DataFrame) -> DataFrame:
    """The stored table, marked for broadcasting where it is small."""
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table
