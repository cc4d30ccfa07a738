"""Scoring a stream of transactions, each one alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from riskframe.plans.features import default_id, split_valid
from riskframe.plans.model import Artifacts, rejects
from riskframe.streaming.route import start_routing


def score_stream(stream: DataFrame, artifacts: Artifacts, threshold: float | None = None) -> DataFrame:
    """A stateless transformation: valid rows meet the fitted tables in
    stream-static joins; history features are null.  The other rows are those of
    ``reject_stream``, so that each row of the stream is written by one of the two."""
    valid, _ = split_valid(stream)
    return artifacts.score(valid, history=False, threshold=threshold)


def reject_stream(stream: DataFrame) -> DataFrame:
    """The rows that ``score_stream`` does not score, as they came, with ``reasons``."""
    return rejects(stream)


def start_scoring(scored: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append scores to ``path``; by default everything available, then stop."""
    return (
        scored.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_routed_scoring(
    stream: DataFrame, artifacts: Artifacts, path: str, checkpoint: str, threshold: float | None = None, **trigger
) -> StreamingQuery:
    """Scores and rejected rows of each micro-batch, from one read of it, as tables ``scored`` and ``rejected`` of ``route``.

    Every row is in one of the two. Unlike two streams over one source, both are always committed up to the same row.
    """
    def split(batch: DataFrame) -> dict[str, DataFrame]:
        valid, rejected = split_valid(default_id(batch))
        return {"scored": artifacts.score(valid, history=False, threshold=threshold), "rejected": rejected}

    return start_routing(stream, split, path, checkpoint, **trigger)
