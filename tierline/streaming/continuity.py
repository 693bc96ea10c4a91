"""Whether a topic's messages came without gaps and once each (S12), followed across micro-batches.

Tasks turn the offsets they read into ranges, so that little is shuffled; per topic and partition the state
holds the offsets up to which all is known, and the ranges that are missing below them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

FINDINGS = "topic string, partition int, kind string, first long, last long"
_RANGES = "topic string, partition int, first long, last long"
_STATE = "first long, last long, missing_first array<long>, missing_last array<long>"

MISSING, REPEATED, LATE = "missing", "repeated", "late"
Ranges = list[tuple[int, int]]


class DataLoss(RuntimeError):
    """Offsets are missing."""


def to_ranges(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges that hold each offset as often as it is there."""
    while len(offsets):
        values, counts = np.unique(offsets, return_counts=True)
        edges = np.flatnonzero(np.diff(values) != 1)
        yield from zip(values[np.concatenate([[0], edges + 1])].tolist(), values[np.concatenate([edges, [len(values) - 1]])].tolist())
        offsets = np.repeat(values, counts - 1)


def _ranges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for (topic, partition), own in batch.to_pandas().groupby(["topic", "partition"], sort=False):
            rows += [(topic, partition, first, last) for first, last in to_ranges(own["offset"].to_numpy())]
        columns = list(zip(*rows)) or [()] * 4
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["topic", "partition", "first", "last"])


def follow(ranges: Ranges, seen: tuple[int, int] | None, missing: Ranges) -> tuple[list[tuple[str, int, int]], tuple[int, int], Ranges]:
    """What new ranges say after those before: findings, the offsets seen from first to last, and what is missing between them.

    ``missing`` is ascending, as is what is returned. Both lists are gone through once, side by side.
    """
    findings: list[tuple[str, int, int]] = []
    ranges = sorted(ranges)
    if seen is None and ranges:
        seen, ranges = ranges[0], ranges[1:]
    if ranges and ranges[0][0] < seen[0]:  # before the first one of all
        before = min(ranges[0][1], seen[0] - 1)
        if before < seen[0] - 1:
            missing = [(before + 1, seen[0] - 1), *missing]
            findings.append((MISSING, before + 1, seen[0] - 1))
    left, waiting = [], iter(missing)  # what stays missing, in order, and what is yet to be looked at
    gap = next(waiting, None)
    for first, last in ranges:
        start, end = seen
        if first > end + 1:
            left_over = (end + 1, first - 1)
            findings.append((MISSING, *left_over))
        else:
            left_over = None
        at = max(first, start)
        while gap and gap[0] <= last:
            low, high = max(gap[0], first), min(gap[1], last)
            if gap[0] < low:
                left.append((gap[0], min(gap[1], low - 1)))
            if low <= high:
                findings.append((LATE, low, high))
                if at < low:  # what is neither new nor was missing has been there before
                    findings.append((REPEATED, at, low - 1))
                at = max(at, high + 1)
            gap = (last + 1, gap[1]) if last < gap[1] else next(waiting, None)
        if left_over:
            left.append(left_over)
        if at <= min(last, end):
            findings.append((REPEATED, at, min(last, end)))
        seen = (min(start, first), max(end, last))
    if gap:
        left += [gap, *waiting]
    return findings, seen, left


def _follow(key: tuple[str, int], parts: Iterator[pd.DataFrame], state: GroupState, first_offset: int | None, fail: bool) -> Iterator[pd.DataFrame]:
    seen, missing = (None, []) if first_offset is None else ((first_offset, first_offset - 1), [])
    if state.exists:
        first, last, starts, ends = state.get
        seen, missing = (first, last), list(zip(starts or [], ends or []))
    new = [(int(a), int(b)) for part in parts for a, b in zip(part["first"], part["last"])]
    findings, seen, missing = follow(new, seen, missing)
    if fail and missing:
        raise DataLoss(f"{key[0]}, partition {key[1]}: offsets {missing[0][0]} to {missing[0][1]} are missing")
    state.update((*seen, [a for a, _ in missing], [b for _, b in missing]))
    rows = [(*key, *f) for f in findings]
    yield pd.DataFrame(rows, columns=["topic", "partition", "kind", "first", "last"])


def findings(messages: DataFrame, first_offset: int | None = None, fail_on_data_loss: bool = False) -> DataFrame:
    """The stream of what is missing, repeated or late among a stream of messages (topic, partition, offset).

    Ranges have both ends in them. An offset that comes after it was reported missing is ``late``; one that comes
    once more is ``repeated``. ``first_offset`` is where each partition begins, by default at its first message.
    With ``fail_on_data_loss`` a gap that its micro-batch does not close fails the query. Messages without a
    topic, partition or offset are left out.
    """
    rows = messages.select("topic", F.col("partition").cast("int").alias("partition"), F.col("offset").cast("long").alias("offset")).dropna()

    def step(key, parts, state):
        return _follow(key, parts, state, first_offset, fail_on_data_loss)

    ranges = rows.mapInArrow(_ranges, _RANGES)
    return ranges.groupBy("topic", "partition").applyInPandasWithState(step, FINDINGS, _STATE, "append", GroupStateTimeout.NoTimeout)
