"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_own_folder: dict[str, str] = {}
_made: dict[str, list[str]] = {}
# (name, path) of what the innermost ``scratch`` block of this thread has written.
_inside: ContextVar[list[tuple[str, str]] | None] = ContextVar("scratch", default=None)


def local_session(cores: int | str = "*", **conf: object) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("riskframe")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    A session on one machine, as in tests, may name none and gets a folder of its own; on a cluster that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        _own_folder[app] = tempfile.mkdtemp(prefix="riskframe-")
    return _own_folder[app]


def together(*jobs: Callable):
    """Results of independent jobs, submitted to the scheduler at the same time."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(inherit(job)) for job in jobs]]


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/riskframe/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    if (inside := _inside.get()) is not None:
        inside.append((name, path))
    return path


@contextmanager
def scratch(spark: SparkSession, *keep: str) -> Iterator[None]:
    """Deletes the intermediate tables written inside once the block ends, also by an error, but for those named ``keep``.

    Kept tables belong to the block around, if there is one. Tables of other threads are left alone. Nothing that is read
    after the block may depend on a table that goes.
    """
    own: list[tuple[str, str]] = []
    token = _inside.set(own)
    try:
        yield
    finally:
        _inside.reset(token)
        around, made = _inside.get(), _made.get(spark.sparkContext.applicationId, [])
        for name, path in own:
            if name not in keep:
                remove(spark, path)
                if path in made:
                    made.remove(path)
            elif around is not None:
                around.append((name, path))


def release(spark: SparkSession) -> int:
    """Delete the intermediate tables of this session, once no result that reads them is wanted any more."""
    paths = _made.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        remove(spark, path)
    return len(paths)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system the session finds it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Unlike a cache this survives lost executors, and unlike an RDD checkpoint
    each consumer reads only the columns (and partitions) it needs.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path, partitionBy=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)
