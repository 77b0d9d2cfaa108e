"""The per-user serving table: upsert, publish, look up."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from recmill.operators.prep import append_all
from recmill.operators.skew import HEAVY_ROWS, lookup_join
from recmill.sources.paths import child_names, create_text, read_text

BUCKETS = 16
_FULL, _DELTA, _CLAIM, _BUCKET, _VERSION = "full", "delta", "_claim", "_bucket", "_version"


def serving_documents(recs: DataFrame, user: str = "user", out: str = "items") -> DataFrame:
    """(id as text, item ids) from recommendation lists."""
    return recs.select(F.col(user).cast("string").alias("id"), F.col("recommendations.itemId").alias(out))


def latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order``; copies of a key combine before the shuffle."""
    payload = [c for c in df.columns if c != key]
    newest = F.max_by(F.struct(*payload), F.struct(*order)).alias("_row")
    return df.groupBy(key).agg(newest).select(key, *[f"_row.{c}" for c in payload])


def upsert_serving(table: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """``new`` replaces rows of the same key and adds the others; both unique on ``key``."""
    kept = table.join(new.select(key), key, "left_anti")
    return kept.unionByName(new)


@dataclass(frozen=True, eq=False)
class _Layer:
    """A finished publish: its folder, what its claim says, and the buckets it holds."""

    version: int
    name: str
    claim: dict
    buckets: tuple[int, ...]


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def _claims(spark: SparkSession, path: str) -> dict[str, tuple[int, dict]]:
    """(version, claim) of every folder whose version has been claimed, whether it is finished or not."""
    found = {}
    for name in child_names(spark, path):
        kind, _, number = name.partition("-")
        if kind in (_FULL, _DELTA) and number.isdigit():
            claim = read_text(spark, f"{path}/{name}/{_CLAIM}")
            if claim is not None:
                found[name] = (int(number), json.loads(claim))
    return found


def _finished(spark: SparkSession, path: str, claims: dict[str, tuple[int, dict]] | None = None) -> list[_Layer]:
    """The finished layers in the order of their versions."""
    layers = []
    for name, (version, claim) in (_claims(spark, path) if claims is None else claims).items():
        children = child_names(spark, f"{path}/{name}")
        if "_SUCCESS" in children:
            held = [int(c.partition("=")[2]) for c in children if c.startswith(f"{_BUCKET}=")]
            layers.append(_Layer(version, name, claim, tuple(held)))
    return sorted(layers, key=lambda layer: (layer.version, layer.name))


def _live(layers: Sequence[_Layer]) -> dict[int, list[_Layer]]:
    """The layers of each bucket that no finished layer has replaced."""
    replaced = {(name, int(b)) for layer in layers for b, names in layer.claim["replaces"].items() for name in names}
    live: dict[int, list[_Layer]] = {}
    for layer in layers:
        for bucket in layer.buckets:
            if (layer.name, bucket) not in replaced:
                live.setdefault(bucket, []).append(layer)
    return live


def current_version(spark: SparkSession, path: str) -> int | None:
    return max((layer.version for layer in _finished(spark, path)), default=None)


def _scan(spark: SparkSession, path: str, entries: Iterable[tuple[_Layer, int]]) -> list[DataFrame]:
    """The rows of some buckets of layers with the version that brought each; one scan per layer."""
    by_layer: dict[_Layer, list[str]] = {}
    for layer, bucket in entries:
        by_layer.setdefault(layer, []).append(f"{path}/{layer.name}/{_BUCKET}={bucket}")
    ordered = sorted(by_layer, key=lambda layer: (layer.version, layer.name))
    return [spark.read.schema(StructType.fromJson(layer.claim["schema"])).parquet(*by_layer[layer]) for layer in ordered]


def read_serving(
    spark: SparkSession, path: str, key: str = "id", ids: Sequence[str] | None = None, order: Sequence[str] = ()
) -> DataFrame:
    """The table as of now: the finished layers that are not replaced by later ones, bucket by bucket.

    Of several rows of a key the last by the ``order`` columns counts, whichever version
    brought it; then, and without ``order``, the one of the newest version. ``ids`` reads
    a few documents only: the files of their buckets, of which key ranges and Bloom
    filters leave out most.
    """
    path = path.rstrip("/")
    layers = _finished(spark, path)
    if not layers:
        raise FileNotFoundError(f"{path} holds no finished version")
    live = _live(layers)
    if ids is not None:
        wanted = spark.createDataFrame([(str(i),) for i in ids], "id string")
        named = {row.b for row in wanted.select(_bucket("id", layers[0].claim["n_buckets"]).alias("b")).collect()}
        live = {bucket: held for bucket, held in live.items() if bucket in named}
    chosen = (lambda rows: rows) if ids is None else (lambda rows: lookup(rows, ids, key))
    single = [(held[0], bucket) for bucket, held in live.items() if len(held) == 1]
    several = [(layer, bucket) for bucket, held in live.items() if len(held) > 1 for layer in held]
    parts = [chosen(rows).drop(_VERSION) for rows in _scan(spark, path, single)]
    scans = [chosen(rows) for rows in _scan(spark, path, several)]
    if len(scans) == 2 and not order and not max((layer for layer, _ in several), key=lambda layer: layer.version).claim["replaces"]:
        parts.append(upsert_serving(*[rows.drop(_VERSION) for rows in scans], key))
    elif scans:
        parts.append(latest_per_key(append_all(*scans), key, [*order, _VERSION]).drop(_VERSION))
    if not parts:
        schema = StructType.fromJson(layers[-1].claim["schema"])
        return spark.createDataFrame([], schema).drop(_VERSION)
    return append_all(*parts)


def publish_upsert(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    key: str = "id",
    token: str | None = None,
    order: Sequence[str] = (),
    full_every: int = 10,
    buckets: int = BUCKETS,
) -> int:
    """Upsert ``new`` into the table at ``path`` as its next version, and return the number.

    A version is claimed by creating a file that must not exist, so publishers that race get
    different ones and none is lost; it counts once its folder is complete, and a claim
    whose publisher died is passed over. Every row carries its version, so it does not
    matter in which order versions are completed. ``token`` names the publish: a repeated
    call with a token that is published does nothing and returns its version. With
    ``order``, an older row of a key never replaces a newer one; pass the same columns to
    :func:`read_serving`.

    Rows are laid out in ``buckets`` by hashed key (fixed by the first publish). A version
    holds only its own rows, so a small batch costs little; every ``full_every``-th one also
    merges the buckets that have as many layers, and names the layers it replaces there:
    one that is completed meanwhile stays in force beside it.
    """
    path = path.rstrip("/")
    mark = hashlib.md5(token.encode()).hexdigest() if token is not None else ""
    while True:
        claims = _claims(spark, path)
        layers = _finished(spark, path, claims)
        for layer in layers:
            if mark and layer.claim["token"] == mark:
                return layer.version
        version = max((number for number, _ in claims.values()), default=-1) + 1
        kind = _DELTA if version % full_every else _FULL
        due = {b: held for b, held in _live(layers).items() if kind == _FULL and len(held) >= full_every}
        rows = new.withColumn(_VERSION, F.lit(version).cast("long"))
        if due:
            old = _scan(spark, path, [(layer, b) for b, held in due.items() for layer in held])
            rows = latest_per_key(append_all(*old, rows), key, [*order, _VERSION])
        claim = {
            "token": mark,
            "n_buckets": next(iter(claims.values()))[1]["n_buckets"] if claims else buckets,
            "schema": rows.schema.jsonValue(),
            "replaces": {b: [layer.name for layer in held] for b, held in due.items()},
        }
        folder = f"{path}/{kind}-{version:012d}"
        if create_text(spark, f"{folder}/{_CLAIM}", json.dumps(claim)):
            break
    placed = rows.withColumn(_BUCKET, _bucket(key, claim["n_buckets"])).hint("rebalance", _BUCKET)
    writer = placed.sortWithinPartitions(_BUCKET, key).write.mode("append").partitionBy(_BUCKET)
    writer.option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(folder)
    return version


def lookup(table: DataFrame, ids: Sequence[str], key: str = "id") -> DataFrame:
    """Documents of a few ids; the predicate reaches the Parquet scan."""
    return table.filter(F.col(key).isin([str(i) for i in ids]))


def serve(
    requests: DataFrame, table: DataFrame, key: str = "id", out: str = "response", min_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Each request with its document as JSON; NULL where there is none."""
    payload = [c for c in table.columns if c != key]
    document = F.to_json(F.struct(key, *payload)).alias(out)
    documents = table.select(key, document)
    return lookup_join(requests, documents, key, "left", min_rows)
