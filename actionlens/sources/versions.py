"""Tables in versions, of which readers follow one.

A new version is written to a folder of its own. Then one small file, the pointer, is replaced; the file system
does that in one step. A reader sees the old version or the new one, never a part; a write that fails leaves
the old one in place.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

POINTER = "_current"


def _files(spark: SparkSession, path: str):
    """The session's file system for ``path``, and the path as it takes it."""
    jvm, context = spark.sparkContext._jvm, spark.sparkContext
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none if there is no such folder."""
    files, target = _files(spark, path)
    return [s.getPath().getName() for s in files.listStatus(target) if s.isDirectory()] if files.exists(target) else []


def current_version(spark: SparkSession, path: str) -> str | None:
    """Name of the version that readers of ``path`` follow."""
    files, pointer = _files(spark, f"{path}/{POINTER}")
    if not files.exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        return bytes(stream.readNBytes(1 << 10)).decode().strip()
    finally:
        stream.close()


def commit_version(df: DataFrame, path: str, *by: str) -> str:
    """Write ``df`` as the next version of ``path``, laid out ``by`` columns, and let readers follow it; its name."""
    spark = df.sparkSession
    version = uuid.uuid4().hex
    df.write.partitionBy(*by).parquet(f"{path}/{version}")
    point_to(spark, path, version)
    return version


def point_to(spark: SparkSession, path: str, version: str) -> None:
    """Let readers of ``path`` follow ``version``, which may be an earlier one."""
    files, pointer = _files(spark, f"{path}/{POINTER}")
    _, draft = _files(spark, f"{path}/{POINTER}-{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    stream.write(bytearray(version.encode()))
    stream.close()
    jvm = spark.sparkContext._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(draft, pointer, options)


def read_version(spark: SparkSession, path: str, schema: T.StructType | str | None = None, version: str | None = None) -> DataFrame:
    """The version that the pointer names, or the one given. What has been opened stays as it is when the
    pointer moves on, for versions are never written again."""
    name = version or current_version(spark, path)
    if name is None:
        raise FileNotFoundError(f"{path} has no version yet")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{path}/{name}")


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all versions but the current one and the ``keep`` - 1 newest others; names of those deleted. Readers of
    older ones must have ended."""
    files, folder = _files(spark, path)
    current = current_version(spark, path)
    found = [(s.getModificationTime(), s.getPath().getName()) for s in files.listStatus(folder) if s.isDirectory()]
    others = sorted((x for x in found if x[1] != current), reverse=True)
    gone = [name for _, name in others[max(keep - 1, 0) :]]
    for name in gone:
        files.delete(_files(spark, f"{path}/{name}")[1], True)
    return gone
