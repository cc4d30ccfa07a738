"""Time since the previous transaction of the same key.

"Previous" means earlier in (time, id), so equal times give 0.  A plain window
per key would gather a hot card in one task.  Rows of hot keys are therefore
dealt by ranges of (key, time, id), which are even whatever times or ids they
share; the window runs inside a range, and the first row of a range takes the
last time of the key's earlier ranges from a table of their ends.  A task holds
many ranges where they are short, so tasks and files grow with the rows only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.skew import HOT_ROWS, hot_keys, lookup_join
from riskframe.schema import HISTORY_KEYS, ID, TIME
from riskframe.session import materialise

# Rows of hot keys that one task sorts and cuts into ranges.
TASK_ROWS = 500_000


def time_since_previous(
    rows: DataFrame, groups: Mapping[str, Sequence[str]] = HISTORY_KEYS, hot_rows: int = HOT_ROWS,
    n_rows: int | None = None,
) -> DataFrame:
    """Add one column per group; all groups start with the same key column, so
    Spark plans one exchange for all of them.  ``n_rows`` saves a count."""
    lead = {keys[0] for keys in groups.values()}
    if len(lead) != 1:
        raise ValueError("groups must share their first key")
    key = lead.pop()
    few = (rows.count() if n_rows is None else n_rows) <= hot_rows
    hot = None if few else hot_keys(rows, [key], hot_rows)
    if hot is None or hot.isEmpty():
        return rows.withColumns({name: _gap(keys, []) for name, keys in groups.items()})

    marked = lookup_join(rows, hot.withColumn("_hot", F.lit(True)), [key])
    cold = marked.where(F.col("_hot").isNull()).drop("_hot")
    cold = cold.withColumns({name: _gap(keys, []) for name, keys in groups.items()})
    out = cut_into_ranges(marked.where(F.col("_hot")).drop("_hot"), key, hot_rows)
    for name, keys in groups.items():
        carried = materialise(_last_before(out, keys), "carried")
        out = lookup_join(out, carried, [*keys, "_range"])
        gap = F.coalesce(_gap(keys, ["_range"]), (F.col(TIME) - F.col("_carried")).cast("float"))
        out = out.withColumn(name, gap).drop("_carried")
    return cold.unionByName(out.drop("_range"))


def cut_into_ranges(hot: DataFrame, key: str, hot_rows: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """The rows with the number of their range in the (key, time, id) order, as ``_range``; written.

    A task takes about ``task_rows`` rows and cuts them into ranges of ``hot_rows`` by their place in it.
    """
    n = hot.count()
    spread = max(-(-n // task_rows), int(hot.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    tasks = max(2, min(-(-2 * n // hot_rows), spread))
    dealt = hot.repartitionByRange(tasks, key, TIME, ID).sortWithinPartitions(key, TIME, ID)
    # The upper bits are the task's number, the lower 33 the row's place in the task.
    place = F.col("_place").bitwiseAND((1 << 33) - 1)
    ranged = dealt.withColumn("_place", F.monotonically_increasing_id()).withColumn(
        "_range", F.col("_place") - place + F.floor(place / hot_rows).cast("long"))
    return materialise(ranged.drop("_place"), "hot-ranges")


def _gap(keys: Sequence[str], within: Sequence[str]):
    before = Window.partitionBy(*keys, *within).orderBy(TIME, ID)
    return (F.col(TIME) - F.lag(TIME).over(before)).cast("float")


def _last_before(hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key and range, the last time seen in the key's earlier ranges; a key has at most one row for each range."""
    ends = hot.groupBy(*keys, "_range").agg(F.max(TIME).alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy("_range")
    return ends.select(*keys, "_range", F.lag("_end").over(earlier).alias("_carried"))
