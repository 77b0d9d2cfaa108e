"""Intermediate tables in the folder the cluster shares between executors."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from recmill.sources.paths import located

CHECKPOINT_CONF = "spark.checkpoint.dir"


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    Only where neither the setting nor the context names one, as in tests, a
    temporary folder is made and set.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if root is None:
        root = current
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="recmill-")
        spark.conf.set(CHECKPOINT_CONF, root)
    if current is None:
        context.setCheckpointDir(root)
    return root


_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder; nothing is created yet."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for scope in _SCOPES:
        scope.append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables made inside the block when it ends.

    Finish inside the block whatever reads them: a result that is still lazy afterwards
    has lost its inputs, so write it or collect it first.
    """
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES[:] = [scope for scope in _SCOPES if scope is not made]
        for path in made:
            hadoop_path, fs = located(spark, path)
            fs.delete(hadoop_path, True)


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage, and pins values that a recomputation may assign
    differently (partition ids, row ids). Being Parquet, later passes read only
    the columns they need.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
