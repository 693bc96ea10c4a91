"""Derived columns: lineage (P1), temporal repair (P2), date parts (P3, P4, P9), column checks (P5)."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

_TEMPORAL = (T.TimestampType, T.TimestampNTZType, T.DateType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)

# Microseconds per unit of a numeric timestamp.
_MICROS = {"seconds": 1_000_000, "millis": 1_000, "micros": 1}

_PARTS = {"year": F.year, "month": F.month, "day": F.dayofmonth}


def with_source(df: DataFrame) -> DataFrame:
    """``source_filename`` from the scan's own file metadata; apply directly on a file scan."""
    return df.withColumn("source_filename", F.col("_metadata.file_path"))


def with_lineage(df: DataFrame) -> DataFrame:
    """When the row was ingested, and from which file if the scan has said so.

    ``ingestion_ts`` is the moment, ``ingestion_date`` its day.
    """
    if "source_filename" not in df.columns:
        df = with_source(df)
    return df.withColumns({"ingestion_ts": F.current_timestamp(), "ingestion_date": F.current_date()})


def ensure_timestamp(df: DataFrame, name: str, unit: str = "seconds", fmt: str | None = None) -> DataFrame:
    """Make ``name`` temporal; values that cannot be read become null instead of failing the job.

    Text is parsed with ``fmt`` or Spark's default rules. Numbers count ``unit`` since the epoch.
    """
    if unit not in _MICROS:
        raise ValueError(f"unit must be one of {sorted(_MICROS)}, not {unit!r}")
    kind = df.schema[name].dataType
    if isinstance(kind, _TEMPORAL):
        return df
    return df.withColumn(name, _as_timestamp(F.col(f"`{name}`"), kind, unit, fmt))


def _as_timestamp(value: Column, kind: T.DataType, unit: str, fmt: str | None) -> Column:
    if isinstance(kind, T.StringType):
        return F.try_to_timestamp(value, F.lit(fmt)) if fmt else value.try_cast(T.TimestampType())
    if isinstance(kind, _INTEGRAL):
        return F.timestamp_micros(F.try_multiply(value.cast("long"), F.lit(_MICROS[unit]).cast("long")))
    if isinstance(kind, _FRACTIONAL):
        return F.timestamp_micros(F.round(value * F.lit(_MICROS[unit])).try_cast("long"))
    raise TypeError(f"cannot read {kind.simpleString()} as a timestamp")


def date_parts(df: DataFrame, source: str | None, parts: Mapping[str, str], unit: str = "seconds") -> DataFrame:
    """Integer date parts of ``source``; ``parts`` maps a new column to year, month or day.

    A source column that is absent leaves the rows unchanged, as the partition check that
    follows names what is missing.
    """
    if not source or not parts:
        return df
    if source not in df.columns:
        log.warning("date source %r is not among %s", source, df.columns)
        return df
    df = ensure_timestamp(df, source, unit)
    return df.withColumns({name: _PARTS[part](F.col(f"`{source}`")) for name, part in parts.items()})


def listed_parts(partition_by: Iterable[str]) -> dict[str, str]:
    """The date parts a raw layout asks for: those of year, month, day that it partitions by."""
    return {name: name for name in _PARTS if name in set(partition_by)}


def ingestion_day(df: DataFrame, partition_by: Iterable[str], moment: str = "ingestion_timestamp_raw") -> DataFrame:
    """``ingestion_date`` as a date, only if the layout partitions by it."""
    if "ingestion_date" not in set(partition_by):
        return df
    return df.withColumn("ingestion_date", F.to_date(F.col(moment)))


class MissingColumns(ValueError):
    """Columns a layout needs are not in the rows to be written."""


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    """P5: refuse, before anything is written, a layout whose columns are absent."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise MissingColumns(f"partition columns {missing} not found; columns are {df.columns}")
