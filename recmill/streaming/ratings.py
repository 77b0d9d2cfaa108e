"""Structured Streaming forms of capture reading, interval counts and upsert."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from recmill.operators.serving import latest_per_key, publish_upsert
from recmill.sources.paths import child_names, is_complete
from recmill.sources.messages import decode_messages, filter_rating

WATERMARK = "10 minutes"


def stream_files(
    spark: SparkSession, root: str, schema: StructType | str, max_files: int | None = None
) -> DataFrame:
    """New Parquet files anywhere under ``root``, as a stream."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(root)


def stream_ratings(
    spark: SparkSession,
    root: str,
    schema: StructType | str,
    min_rating: float = 3,
    max_files: int | None = None,
) -> DataFrame:
    """Captured messages, decoded, with a rating above ``min_rating``."""
    messages = stream_files(spark, root, "Body binary", max_files)
    return filter_rating(decode_messages(messages, schema), min_rating)


def once(stream: DataFrame, ids: Sequence[str], ts: str, watermark: str = WATERMARK) -> DataFrame:
    """Each message once, however often its source delivers it.

    A message is known by ``ids`` (its number, or its partition and offset). It is remembered until the
    watermark has passed its time, so a copy that comes within ``watermark`` of the newest message is
    dropped by its id and a later one as late; the state stays bounded. A first delivery may be as
    late as ``watermark``. A NULL id is an id like any other, and rows without a time are dropped.
    """
    timed = stream.filter(F.col(ts).isNotNull()).withWatermark(ts, watermark)
    return timed.dropDuplicatesWithinWatermark(list(ids))


def capture_windows(
    stream: DataFrame,
    ts: str,
    interval: str = "60 seconds",
    keys: Sequence[str] = (),
    watermark: str = WATERMARK,
) -> DataFrame:
    """Messages per tumbling interval (and key).

    In append mode an interval appears once the watermark has passed its end.
    """
    counted = stream.withWatermark(ts, watermark).groupBy(F.window(ts, interval), *keys)
    counts = counted.agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("window.start").alias("start"), *keys, "n")


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The unique id of the query that owns a checkpoint folder."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def count_intervals(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    ts: str,
    partition: str = "PartitionId",
    interval: str = "60 seconds",
    lateness: str = WATERMARK,
) -> StreamingQuery:
    """Messages per partition and tumbling interval, with late ones kept apart; read by :func:`read_intervals`.

    Every partition has a watermark of its own: its newest message of earlier batches less ``lateness``.
    A slow partition is thus not late for a fast one. A message whose interval ends at or before it, and one
    without a time, is late: it is counted as such and goes whole to a table (:func:`read_late`). On-time
    and late messages together are all. A batch writes its counts and watermarks into folders of
    its number, which a replay writes again, so nothing counts twice; no interval is held in state, so memory does
    not grow with lateness. Give a ``root`` to one query, with its own checkpoint.
    """
    root = root.rstrip("/")
    schema = stream.select(F.col(partition).alias("partition"), F.col(ts).alias("newest")).schema

    def count(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        of = f"query={_query_id(spark, checkpoint)}"
        folder = lambda kind, n: f"{root}/{kind}/{of}/batch={n}"
        numbers = [int(name.split("=")[1]) for name in child_names(spark, f"{root}/marks/{of}")]
        earlier = [n for n in sorted(numbers) if n < batch_id and is_complete(spark, folder("marks", n))]
        marks = spark.createDataFrame([], schema)
        if earlier:
            marks = spark.read.schema(schema).parquet(folder("marks", earlier[-1]))
        closed = marks.select(F.col("partition").alias("_of"), (F.col("newest") - F.expr(f"INTERVAL {lateness}")).alias("_mark"))

        placed = batch.join(closed, F.col(partition).eqNullSafe(F.col("_of")), "left")
        length = F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {interval})")
        begun = F.unix_micros(ts) - F.pmod(F.unix_micros(ts), length)  # a window expression would drop rows without a time
        late = F.col(ts).isNull() | F.coalesce(begun + length <= F.unix_micros("_mark"), F.lit(False))
        shown = placed.select(
            F.col(partition).alias("partition"), F.timestamp_micros(begun).alias("start"), F.col(ts).alias("_ts"), late.alias("_late")
        )
        counts = shown.groupBy("partition", "start").agg(
            F.count_if(~F.col("_late")).alias("n"), F.count_if("_late").alias("n_late"), F.max("_ts").alias("newest")
        )
        counts.write.mode("overwrite").parquet(folder("counts", batch_id))
        counted = spark.read.schema(counts.schema).parquet(folder("counts", batch_id))
        if counted.filter("n_late > 0").limit(1).count():
            placed.filter(late).select(*batch.columns).write.mode("overwrite").parquet(folder("late", batch_id))
        newest = marks.unionByName(counted.select("partition", "newest")).groupBy("partition").agg(F.max("newest").alias("newest"))
        newest.coalesce(1).write.mode("overwrite").parquet(folder("marks", batch_id))

    writer = stream.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def read_intervals(spark: SparkSession, root: str) -> DataFrame:
    """(partition, start, n, n_late) of what :func:`count_intervals` counted; messages without a time under a NULL start."""
    counts = spark.read.parquet(f"{root.rstrip('/')}/counts")
    return counts.groupBy("partition", "start").agg(F.sum("n").alias("n"), F.sum("n_late").alias("n_late"))


def read_late(spark: SparkSession, root: str, schema: StructType | str) -> DataFrame:
    """The late messages that :func:`count_intervals` kept apart; empty where there were none."""
    folder = f"{root.rstrip('/')}/late"
    if not child_names(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.option("recursiveFileLookup", True).schema(schema).parquet(folder)


def write_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything available now to a Parquet table; start it again for more."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start(path)


def stream_upsert(
    stream: DataFrame, table_path: str, checkpoint: str, key: str, order: Sequence[str]
) -> StreamingQuery:
    """Upsert each batch's last row per key into the serving table.

    Each batch is published under the query's id and its number, so a batch replayed after
    a failure is published once, and a new query, or a table that others publish to, loses
    nothing. ``order`` decides between rows of a key across batches as well: read the table
    with the same columns.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]  # holds the query's unique id
        latest = latest_per_key(batch, key, order)
        publish_upsert(spark, table_path, latest, key, token=f"{query}/{batch_id}", order=order)

    writer = stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
