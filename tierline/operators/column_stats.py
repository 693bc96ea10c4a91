"""What a batch's columns hold (A1, F1), counted while it is written and kept with its commit row."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Column name to its non-null values and, as text, the least and the most of them.
Stats = Mapping[str, tuple[int, str | None, str | None]]

_ORDERED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _text(value: Column, kind: T.DataType) -> Column:
    return (F.unix_micros(value) if isinstance(kind, T.TimestampType) else value).cast("string")


def _value(text: Column, kind: T.DataType) -> Column:
    return F.timestamp_micros(text.cast("long")) if isinstance(kind, T.TimestampType) else text.cast(kind)


def _values(texts: Column, kind: T.DataType) -> Column:
    return F.transform(texts, lambda text: _value(text, kind))


def aggregates(schema: T.StructType) -> list[Column]:
    """Counts of every column, and bounds of those that are numbers, dates, times or booleans."""
    out = []
    for i, f in enumerate(schema):
        column = F.col(f"`{f.name.replace('`', '``')}`")
        out.append(F.count(column).alias(f"n{i}"))
        if isinstance(f.dataType, _ORDERED):
            out += [_text(F.min(column), f.dataType).alias(f"a{i}"), _text(F.max(column), f.dataType).alias(f"z{i}")]
    return out


def found(schema: T.StructType, seen: Mapping) -> Stats:
    return {f.name: (seen[f"n{i}"], seen.get(f"a{i}"), seen.get(f"z{i}")) for i, f in enumerate(schema)}


def merged(first: Stats, second: Stats) -> dict:
    """Stats of two parts of one batch: counts add up; bounds stay apart, in a list, until they are read by type."""
    out = dict(first)
    for name, (count, least, most) in second.items():
        before = out.get(name, (0, [], []))
        out[name] = (before[0] + count, _all(before[1]) + _all(least), _all(before[2]) + _all(most))
    return out


def _all(bound) -> list[str]:
    return list(bound) if isinstance(bound, list) else [] if bound is None else [bound]


def dumped(stats: Stats | None) -> str | None:
    return None if stats is None else json.dumps({n: {"n": c, "least": _all(a), "most": _all(z)} for n, (c, a, z) in stats.items()})


_STORED = "map<string, struct<n: bigint, least: array<string>, most: array<string>>>"


def profile(commits: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows, non-null values and bounds of the columns of a layer, from the commit rows of its batches alone.

    Bounds are text; a column without an order has none.
    """
    commits = commits.select(F.col("operationMetrics")["rows"].cast("long").alias("rows"), F.from_json("column_stats", _STORED).alias("stats"))
    counts = [F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")]
    per_column = []
    for i, f in enumerate(schema):
        own = F.col("stats")[f.name]
        counts.append(F.coalesce(F.sum(own["n"]), F.lit(0).cast("long")).alias(f"n{i}"))
        bounds = [F.lit(None).cast("string")] * 2
        if isinstance(f.dataType, _ORDERED):
            counts.append(F.min(F.array_min(_values(own["least"], f.dataType))).cast("string").alias(f"a{i}"))
            counts.append(F.max(F.array_max(_values(own["most"], f.dataType))).cast("string").alias(f"z{i}"))
            bounds = [F.col(f"a{i}"), F.col(f"z{i}")]
        per_column.append(F.struct(F.lit(f.name).alias("column_name"), F.col(f"n{i}").alias("non_null"), bounds[0].alias("least"), bounds[1].alias("most")))
    return commits.agg(*counts).select("rows", F.inline(F.array(*per_column))).select(
        "column_name", "rows", "non_null", "least", "most", (F.col("rows") == 0).alias("is_empty")
    )
