"""Small files next to a table: written once under a name, read, listed and deleted.

Everything goes through the file system that the path names, as Spark's own
readers and writers do; only texts of a few kilobytes pass the driver.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist."""
    fs, p = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def age_seconds(spark: SparkSession, path: str) -> float:
    fs, p = _fs(spark, path)
    return spark._jvm.System.currentTimeMillis() / 1000 - fs.getFileStatus(p).getModificationTime() / 1000


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole under ``path`` unless one is there already; whether this call made it.

    The text is written under another name, which then becomes ``path`` in one
    step that fails if there is such a file: a hard link on a local disk, elsewhere the file
    system's rename without overwriting (atomic on HDFS).
    """
    jvm = spark._jvm
    fs, target = _fs(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    local = fs.getUri().getScheme() == "file"
    try:
        if local:
            def as_local(p):
                return jvm.java.io.File(p.toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(as_local(target), as_local(draft))
        else:
            options = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
            never = spark.sparkContext._gateway.new_array(options, 1)
            never[0] = options.NONE
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
            context.rename(draft, target, never)
        return True
    except Py4JJavaError as e:
        if "AlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    finally:
        fs.delete(draft, False)
