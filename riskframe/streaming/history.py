"""Time since the previous transaction of the same key, over a stream.

State is kept by card: the time and id of its last transaction, and for each further key (an address) the last time. Rows of
a micro-batch are taken in (time, id) order. A row that comes too late for that is not guessed at but turned away: one before
the watermark, or before the last row of its card. What remains is in order, so the results are those of the whole table.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from riskframe.schema import HISTORY_KEYS, ID, TIME
from riskframe.streaming.route import start_routing

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LATE = "late"


class _History(StatefulProcessor):
    def __init__(self, groups: dict[str, list[str]], further: T.StructType, forget_after: int | None):
        self.groups, self.further, self.forget_after = groups, further, forget_after

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "time bigint, id bigint")
        self.by = {
            name: handle.getMapState(f"by_{i}", T.StructType([self.further[k] for k in keys]), "time bigint")
            for i, (name, keys) in enumerate(self.groups.items()) if keys
        }

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        last = tuple(self.last.get()) if self.last.exists() else None
        # Each further key is asked for and written once, however many rows have it; a card without a last row has none.
        known = {name: {} for name in self.by}
        stored = last is not None
        for row in sorted(rows, key=lambda r: (r[TIME], r[ID])):
            fields, at = row.asDict(), (row[TIME], row[ID])
            late = row[TIME] * 1000 < watermark or (last is not None and at < last)
            gaps = dict.fromkeys(self.groups)
            if not late:
                for name, keys in self.groups.items():
                    gaps[name] = self._gap(name, tuple(row[k] for k in keys), row[TIME], last, known, stored)
                last = at
            yield Row(**fields, **gaps, **{LATE: late})
        for name, times in known.items():
            for further, time in times.items():
                self.by[name].updateValue(further, (time,))
        if last is not None:
            self.last.update(last)
            if self.forget_after is not None and not list(self.handle.listTimers()):
                self.handle.registerTimer((last[0] + self.forget_after) * 1000)

    def _gap(self, name, further, time, last, known, stored) -> float | None:
        if name not in self.by:
            before = None if last is None else last[0]
        else:
            times, state = known[name], self.by[name]
            if further not in times:
                times[further] = state.getValue(further)[0] if stored and state.containsKey(further) else None
            before, times[further] = times[further], time
        if before is None or (self.forget_after is not None and time - before >= self.forget_after):
            return None
        return float(time - before)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.last.exists():
            due = (self.last.get()[0] + self.forget_after) * 1000
            if due > expiredTimerInfo.getExpiryTimeInMs():  # the card was used since
                self.handle.registerTimer(due)
            else:
                self.last.clear()
                for known in self.by.values():
                    known.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_history(
    stream: DataFrame, groups: Mapping[str, Sequence[str]] = HISTORY_KEYS, carry: Sequence[str] = (), lateness: int = 0,
    forget_after: int | None = None,
) -> DataFrame:
    """Id, time, key columns and ``carry`` of every row, one column per group, and ``late``.

    A late row has no times and changes none. The watermark is ``lateness`` seconds behind the latest time of earlier
    micro-batches. A row ``forget_after`` seconds or more behind the one before counts as a first one, whatever the batches;
    the state of a card goes once the watermark has passed that. All rows of one card and micro-batch pass through one task, so the trigger bounds what it sorts.
    """
    lead = {keys[0] for keys in groups.values()}
    if len(lead) != 1:
        raise ValueError("groups must share their first key")
    lead = lead.pop()
    names = list(dict.fromkeys([ID, TIME, *[k for keys in groups.values() for k in keys], *carry]))
    clocked = stream.withColumn("_clock", F.timestamp_seconds(TIME)).withWatermark("_clock", f"{lateness} seconds")
    # Without its clock a late row reaches the operator, which names it, instead of being dropped unseen.
    rows = clocked.select(*names)
    out = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    for name in groups:
        out = out.add(name, T.FloatType())
    further = {name: list(keys)[1:] for name, keys in groups.items()}
    processor = _History(further, rows.schema, forget_after)
    return rows.groupBy(lead).transformWithState(
        statefulProcessor=processor, outputStructType=out.add(LATE, T.BooleanType()), outputMode="Append", timeMode="EventTime")


def start_history(history: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write timely rows to table ``rows`` and late ones to ``late``, see ``route``."""
    conf, before = history.sparkSession.conf, history.sparkSession.conf.get(_STORE)
    conf.set(_STORE, _ROCKS)  # read when the stream starts
    try:
        return start_routing(history, lambda batch: {
            "rows": batch.where(~F.col(LATE)).drop(LATE),
            "late": batch.where(F.col(LATE)).drop(LATE, *[c for c in HISTORY_KEYS if c in batch.columns]),
        }, path, checkpoint, **trigger)
    finally:
        conf.set(_STORE, before)
