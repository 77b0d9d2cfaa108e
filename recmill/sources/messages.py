"""JSON messages, and capture files laid out by partition and time."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from recmill.functions.hashing import draw
from recmill.sources.paths import child_names, is_complete

# The folder levels of a capture, outermost first.
CAPTURE_LEVELS = ("PartitionId", "Year", "Month", "Day", "Hour", "Minute", "Second")


def decode_json(df: DataFrame, col: str, schema: StructType | str, keep: bool = True) -> DataFrame:
    """Fields of a JSON text (or UTF-8 binary) column as columns."""
    parsed = F.from_json(F.col(col).cast("string"), schema)
    kept = [c for c in df.columns if c != col] if keep else []
    return df.select(*kept, parsed.alias("_json")).select(*kept, "_json.*")


def decode_messages(df: DataFrame, schema: StructType | str, col: str = "Body", keep: bool = False) -> DataFrame:
    """Hub messages, whose JSON values are all texts, as typed columns.

    A value that does not fit its type becomes NULL; the other fields are kept.
    """
    fields = StructType.fromDDL(schema).fields if isinstance(schema, str) else schema.fields
    texts = StructType([StructField(f.name, StringType()) for f in fields])
    decoded = decode_json(df, col, texts, keep)
    return decoded.withColumns({f.name: F.col(f.name).try_cast(f.dataType) for f in fields})


def encode_messages(
    df: DataFrame, cols: Sequence[str], out: str = "Body", keep: Sequence[str] = ()
) -> DataFrame:
    """Each row as a UTF-8 JSON message whose values are strings."""
    payload = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in cols]))
    return df.select(*keep, payload.cast("binary").alias(out))


def partition_id(key: str | Column, n_partitions: int) -> Column:
    return (draw([key], "") % n_partitions).cast("int")


def capture_interval(ts: str | Column, interval: str = "60 seconds") -> Column:
    """Start of the capture interval that holds ``ts``."""
    return F.window(ts, interval)["start"]


def write_capture(
    df: DataFrame,
    root: str,
    ts: str,
    key: str,
    n_partitions: int = 2,
    interval: str = "60 seconds",
    fmt: str = "parquet",
    max_rows_per_file: int = 1_000_000,
) -> None:
    """Write messages under one folder per (partition, interval).

    The rebalance brings the rows of a folder together so that it gets few files;
    unlike a hash repartition it splits a folder that is too large for one task.
    """
    start = F.col("_start")
    parts = {"Year": "yyyy", "Month": "MM", "Day": "dd", "Hour": "HH", "Minute": "mm", "Second": "ss"}
    placed = df.withColumn("PartitionId", partition_id(key, n_partitions))
    placed = placed.withColumn("_start", capture_interval(ts, interval))
    for level, pattern in parts.items():
        placed = placed.withColumn(level, F.date_format(start, pattern))
    placed = placed.hint("rebalance", "PartitionId", "_start").drop("_start")
    writer = placed.write.option("maxRecordsPerFile", max_rows_per_file)
    writer.partitionBy(*CAPTURE_LEVELS).format(fmt).save(root)


def read_capture(
    spark: SparkSession,
    root: str,
    partition: int | None = None,
    fmt: str = "parquet",
    layout: str = "named",
) -> DataFrame:
    """Captured messages, optionally of one partition only.

    ``layout='named'`` is what :func:`write_capture` writes (``PartitionId=0/Year=2024/...``);
    ``layout='plain'`` has bare values (``0/2024/01/...``) and is read by glob. Either
    way the folders of other partitions are not opened.
    """
    if layout == "named":
        df = spark.read.format(fmt).load(root)
        return df if partition is None else df.filter(F.col("PartitionId") == partition)
    first = "*" if partition is None else str(partition)
    glob = "/".join([root.rstrip("/"), first, *["*"] * (len(CAPTURE_LEVELS) - 1)])
    folders = F.reverse(F.split(F.col("_metadata.file_path"), "/"))
    depth = len(CAPTURE_LEVELS) + 1
    df = spark.read.format(fmt).load(glob)
    return df.withColumn("PartitionId", F.element_at(folders, depth).cast("int"))


def _interval_start() -> Column:
    """Start of the interval that a capture's folder names."""
    return F.make_timestamp(*[F.col(level) for level in CAPTURE_LEVELS[1:]])


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    """(partition, start, file, n) of every complete packing run."""
    folder = f"{root.rstrip('/')}/manifest"
    runs = [f"{folder}/{run}" for run in child_names(spark, folder)]
    schema = "partition INT, start TIMESTAMP, file STRING, n BIGINT"
    complete = [run for run in runs if is_complete(spark, run)]
    return spark.read.schema(schema).parquet(*complete) if complete else spark.createDataFrame([], schema)


def _write_packed(placed: DataFrame, root: str, order: Sequence[str], max_rows_per_file: int) -> None:
    """Append rows with PartitionId and start, range-sorted by these and ``order``, and then their manifest.

    The columns of ``order`` that begin with an underscore are dropped.
    """
    spark = placed.sparkSession
    packed = _manifest(spark, root).select(F.col("partition").alias("_p"), F.col("start").alias("_s")).distinct()
    again = F.col("PartitionId").eqNullSafe(F.col("_p")) & F.col("start").eqNullSafe(F.col("_s"))
    by = ["PartitionId", "start", *order]
    fresh = placed.join(packed, again, "left_anti").repartitionByRange(*by).sortWithinPartitions(*by)
    run = f"run={uuid.uuid4().hex}"
    folder = f"{root.rstrip('/')}/messages/{run}"
    rows = fresh.drop(*[c for c in order if c.startswith("_")])
    rows.write.option("maxRecordsPerFile", max_rows_per_file).partitionBy("PartitionId").parquet(folder)
    name = F.concat(F.lit(f"{run}/PartitionId="), F.col("PartitionId"), F.lit("/"), F.col("_metadata.file_name"))
    written = spark.read.schema(rows.schema).parquet(folder)
    held = written.groupBy(F.col("PartitionId").cast("int").alias("partition"), "start", name.alias("file"))
    held.agg(F.count(F.lit(1)).alias("n")).write.parquet(f"{root.rstrip('/')}/manifest/{run}")


def write_packed(
    df: DataFrame,
    root: str,
    ts: str,
    key: str,
    n_partitions: int = 2,
    interval: str = "60 seconds",
    max_rows_per_file: int = 1_000_000,
) -> None:
    """A capture whose files hold neighbouring intervals of one partition, with a manifest of what each holds.

    The same messages as :func:`write_capture` writes, without a folder per interval: rows are range-sorted
    by (partition, interval, time), so an interval too large for one task is split. The manifest has a
    row (partition, start, file, n) per interval and file, and is written last: what a failed call wrote is in
    no complete manifest and never read. An interval that an earlier call wrote is left out, so a call
    may be repeated: give each call whole intervals. Rows without a time are not captured, as in :func:`write_capture`.
    """
    placed = df.withColumn("PartitionId", partition_id(key, n_partitions)).withColumn("start", capture_interval(ts, interval))
    placed = placed.withColumns({"_ts": F.col(ts), "_tie": F.xxhash64(*[F.col(c) for c in df.columns])})
    _write_packed(placed, root, ["_ts", "_tie"], max_rows_per_file)


def pack_capture(
    captured: DataFrame, root: str, until=None, max_rows_per_file: int = 1_000_000
) -> None:
    """Pack captured intervals as :func:`write_packed` does, from folders to few files.

    ``captured`` is what :func:`read_capture` gives in the named layout. Intervals already packed are left
    out, so a run may be repeated; pack only intervals that get no more messages (those
    starting before ``until``), by one run at a time. An interval of many files is spread over several tasks.
    """
    origin = {"start": _interval_start(), "_file": F.col("_metadata.file_path"), "_at": F.col("_metadata.file_block_start")}
    placed = captured.withColumns(origin).drop(*CAPTURE_LEVELS[1:])
    if until is not None:  # of folder names alone, so later folders are not opened
        placed = placed.filter(F.col("start") < (until if isinstance(until, Column) else F.lit(until)))
    _write_packed(placed, root, ["_file", "_at"], max_rows_per_file)


def packed_files(spark: SparkSession, root: str, partition: int | None = None, since=None, until=None) -> DataFrame:
    """The manifest's rows of a partition, of intervals starting in [since, until); each side is optional."""
    rows = _manifest(spark, root)
    if partition is not None:
        rows = rows.filter(F.col("partition") == partition)
    for bound, keep in ((since, Column.__ge__), (until, Column.__lt__)):
        if bound is not None:
            rows = rows.filter(keep(F.col("start"), bound if isinstance(bound, Column) else F.lit(bound).cast("timestamp")))
    return rows


def read_packed(
    spark: SparkSession, root: str, schema: StructType | str, partition: int | None = None, since=None, until=None
) -> DataFrame:
    """Packed messages with ``PartitionId`` and the ``start`` of their interval.

    ``schema`` is that of the messages. Only files that the manifest gives for the range are opened
    (their names pass through the driver, as in any scan); within them rows are cut to it.
    """
    fields = StructType.fromDDL(schema).fields if isinstance(schema, str) else schema.fields
    whole = StructType([*fields, *StructType.fromDDL("start TIMESTAMP, PartitionId INT").fields])
    files = [row["file"] for row in packed_files(spark, root, partition, since, until).select("file").distinct().collect()]
    if not files:
        return spark.createDataFrame([], whole)
    base = f"{root.rstrip('/')}/messages"
    found = spark.read.schema(whole).option("basePath", base).parquet(*[f"{base}/{name}" for name in files])
    for bound, keep in ((since, Column.__ge__), (until, Column.__lt__)):
        if bound is not None:
            found = found.filter(keep(F.col("start"), bound if isinstance(bound, Column) else F.lit(bound).cast("timestamp")))
    return found.select(*[f.name for f in whole.fields])


def filter_rating(df: DataFrame, minimum: float, col: str = "rating") -> DataFrame:
    """Rows whose rating, possibly a numeral in text, is above ``minimum``."""
    return df.filter(F.col(col).try_cast("double") > minimum)
