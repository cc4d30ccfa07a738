"""Folders that are replaced as a whole.

A new version is written beside the old one; then a small file that names the current version is swapped by one rename. A
job lost before that leaves the old version current, and a reader sees one version or the other, never a part of one.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

POINTER = "_current"
#: Versions that stay, the current one included: a reader that has listed the one before can finish.
KEPT = 2


def _fs(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def swap(spark: SparkSession, path: str, content: str, name: str = POINTER) -> None:
    """Replace the small file ``name`` in folder ``path``; whoever reads it finds the old content or the new."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, folder = _fs(spark, path)
    fresh = jvm.org.apache.hadoop.fs.Path(folder, f"_{name}-{uuid.uuid4().hex}")
    out = fs.create(fresh, True)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(folder).toUri(), conf)
    context.rename(fs.makeQualified(fresh), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(folder, name)), how)


def pointed(spark: SparkSession, path: str, name: str = POINTER) -> str | None:
    """The content of the small file; none if there is no such file."""
    fs, folder = _fs(spark, path)
    file = spark._jvm.org.apache.hadoop.fs.Path(folder, name)
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def begin(path: str) -> str:
    """A folder for a new version, which nobody reads before ``publish``."""
    return f"{path.rstrip('/')}/version-{uuid.uuid4().hex}"


def publish(spark: SparkSession, path: str, version: str) -> None:
    """Make the written ``version`` the current one; versions older than those that stay are deleted."""
    swap(spark, path, version.rsplit("/", 1)[1])
    fs, folder = _fs(spark, path)
    found = [s for s in fs.listStatus(folder) if re.fullmatch("version-[0-9a-f]{32}", s.getPath().getName())]
    now = version.rsplit("/", 1)[1]
    others = sorted((s for s in found if s.getPath().getName() != now), key=lambda s: s.getModificationTime(), reverse=True)
    for old in others[KEPT - 1:]:
        fs.delete(old.getPath(), True)


def current(spark: SparkSession, path: str) -> str:
    """The folder of the current version."""
    name = pointed(spark, path)
    if name is None:
        raise FileNotFoundError(f"nothing has been published at {path}")
    return f"{path.rstrip('/')}/{name}"


def resolve(spark: SparkSession, path: str) -> str:
    """The current version of a versioned folder; any other path (a file, a pattern, a plain folder) as it is."""
    if re.search(r"[*?{\[]", path):
        return path
    fs, folder = _fs(spark, path)
    if not fs.exists(folder) or not fs.getFileStatus(folder).isDirectory() or pointed(spark, path) is None:
        return path
    return current(spark, path)


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Replace the table at ``path``; ``df`` may read the old one. Returns the new version."""
    version = begin(path)
    df.write.parquet(version, partitionBy=partition_by)
    publish(df.sparkSession, path, version)
    return read_table(df.sparkSession, path, df.schema)


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(current(spark, path))
