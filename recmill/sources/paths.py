"""Path checks through the file system Spark itself uses."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def located(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when a job finished writing ``path``."""
    marker, fs = located(spark, f"{path.rstrip('/')}/_SUCCESS")
    return fs.exists(marker)


def child_names(spark: SparkSession, path: str) -> list[str]:
    root, fs = located(spark, path)
    if not fs.exists(root):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(root))


def listing(spark: SparkSession, folder: str) -> list[str]:
    """Name, size and time of every file directly in ``folder``."""
    hadoop_path, fs = located(spark, folder)
    if not fs.exists(hadoop_path):
        return []
    return sorted(f"{s.getPath()} {s.getLen()} {s.getModificationTime()}" for s in fs.listStatus(hadoop_path) if s.isFile())


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None where there is none."""
    hadoop_path, fs = located(spark, path)
    if not fs.exists(hadoop_path):
        return None
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its whole text, or return False where one of that name exists.

    The text is written aside first, and takes the name by a step that does not replace, so
    a reader never sees half of it, and of several that race one wins: a rename, or on a
    local disk, where a rename replaces, a link.
    """
    jvm, (final, fs) = spark._jvm, located(spark, path)
    folder = final.getParent()
    fs.mkdirs(folder)
    aside = jvm.org.apache.hadoop.fs.Path(folder, f"_{uuid.uuid4().hex}.tmp")
    stream = fs.create(aside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            to, of = (jvm.java.nio.file.Path.of(p.toUri().getPath(), _strings(spark)) for p in (final, aside))
            jvm.java.nio.file.Files.createLink(to, of)
        else:
            _rename(spark, aside, final)
        return True
    except Py4JJavaError as error:
        if not error.java_exception.getClass().getName().endswith("FileAlreadyExistsException"):
            raise
        return False
    finally:
        fs.delete(aside, False)


def _strings(spark: SparkSession):
    return spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, 0)


def _rename(spark: SparkSession, source, target) -> None:
    """Rename without replacing."""
    fs = spark._jvm.org.apache.hadoop.fs
    context = fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(source, target, spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0))
