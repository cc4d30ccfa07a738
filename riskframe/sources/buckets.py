"""Tables stored in buckets by id, so that tables of one id join where they lie.

The exchange by id is paid once, when a table is stored; every later join, comparison or count by that id of two such tables
with the same number of buckets reads matching buckets side by side. The folder is versioned (see ``versions``); a small file
beside the version says how it is cut, so that any session can read it, not just the one with the catalog it was made in.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskframe.schema import ID
from riskframe.sources import versions

_LAYOUT = "_layout"


def store_bucketed(df: DataFrame, path: str, buckets: int, key: str = ID) -> DataFrame:
    """Replace the table at ``path`` by ``df`` in ``buckets`` files by a hash of ``key``; returns it as read back.

    A bucket should fit a task: for tables that are joined with each other choose their number by the largest. Rows of one
    key lie in one bucket, so a key that repeats without bound does not belong here; ids do not repeat.
    """
    spark, version = df.sparkSession, versions.begin(path)
    name = _table_name()
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", version).format("parquet").saveAsTable(name)
    layout = {"buckets": buckets, "key": key, "schema": df.schema.jsonValue()}
    versions.swap(spark, version, json.dumps(layout), _LAYOUT)
    versions.publish(spark, path, version)
    return spark.table(name)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table stored by ``store_bucketed``, in whatever session."""
    version = versions.current(spark, path)
    layout = json.loads(versions.pointed(spark, version, _LAYOUT))
    quoted = lambda text: "`" + text.replace("`", "``") + "`"
    fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in T.StructType.fromJson(layout["schema"]).fields)
    key, place = quoted(layout["key"]), version.replace("\\", "\\\\").replace("'", "\\'")
    name = _table_name()
    spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet LOCATION '{place}' "
              f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {layout['buckets']} BUCKETS")
    return spark.table(name)


def _table_name() -> str:
    return f"riskframe_{uuid.uuid4().hex}"


def forget_tables(spark: SparkSession) -> int:
    """Drop the catalog's names of this module; files stay."""
    mine = [t.name for t in spark.catalog.listTables() if re.fullmatch("riskframe_[0-9a-f]{32}", t.name)]
    for name in mine:
        spark.sql(f"DROP TABLE {name}")
    return len(mine)
