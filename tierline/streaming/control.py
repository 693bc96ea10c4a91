"""Triggers, batch identity and running several queries."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

AVAILABLE_NOW: Mapping = {"availableNow": True}


def query_name(job: str, dataset: str) -> str:
    """T5."""
    return f"{job}_{dataset}".replace("/", "_")


def batch_identity(df: DataFrame, epoch: int) -> str:
    """An id for a micro-batch that a replay repeats and a new checkpoint never reuses."""
    query = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{epoch}"


def run_available(df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str | None, name: str) -> StreamingQuery:
    """Process everything that is there in micro-batches, then stop."""
    if not checkpoint:
        raise ValueError(f"{name} needs a checkpoint path")
    query = (
        df.writeStream.foreachBatch(each)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .queryName(name)
        .trigger(**AVAILABLE_NOW)
        .start()
    )
    query.awaitTermination()
    return query


class _Counts(StreamingQueryListener):
    """Input rows of each run's batches, and which runs have ended."""

    def __init__(self):
        self.rows: dict[str, dict[int, int]] = defaultdict(dict)
        self.ended: dict[str, Event] = defaultdict(Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = self.rows[str(progress.runId)]
        seen[progress.batchId] = max(seen.get(progress.batchId, 0), progress.numInputRows)

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()


def rows_until_done(spark: SparkSession, start: Callable[[], StreamingQuery]) -> int:
    """Start a query, wait for it to end and count its input rows.

    A listener hears of every batch, while a query itself remembers only its latest ones.
    """
    counts = _Counts()
    spark.streams.addListener(counts)
    try:
        query = start()
        query.awaitTermination()
        run = str(query.runId)
        if not counts.ended[run].wait(60):  # its events come after those of its batches
            raise RuntimeError(f"no word of the end of {query.name}")
        return sum(counts.rows[run].values())
    finally:
        spark.streams.removeListener(counts)


def run_streams(spark: SparkSession, queries: Sequence[StreamingQuery], timeout: float | None = None) -> list[str]:
    """Wait until all queries have ended, or until the first one fails; stop the rest.

    With ``timeout`` (seconds) the queries are stopped when it has passed. Returns the names
    of those that ended by themselves.
    """
    import time

    deadline = None if timeout is None else time.monotonic() + timeout
    ended: list[str] = []
    waiting = list(queries)
    try:
        while waiting:
            for query in [q for q in waiting if not q.isActive]:
                waiting.remove(query)
                query.awaitTermination()  # raises what ended the query, if anything did
                ended.append(query.name or query.id)
            if not waiting:
                break
            left = None if deadline is None else deadline - time.monotonic()
            if left is not None and left <= 0:
                break
            # Spark counts in whole milliseconds and refuses zero.
            waiting[0].awaitTermination(1.0 if left is None else min(1.0, max(left, 0.01)))
    finally:
        for query in waiting:
            query.stop()
    return ended
