"""Scans of the raw and bronze layers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline import storage
from tierline.functions import payload
from tierline.operators import ledger
from tierline.spec import DatasetSpec


def read_raw(
    spark: SparkSession, spec: DatasetSpec, batch_ids: Iterable[str] | None = None, known: ledger.State | None = None
) -> DataFrame:
    """The raw layer, or some of its batches, in its declared or recorded schema.

    The commit rows say which batches exist and what columns they have, so neither a partial
    write nor a footer has to be looked at. A directory without commit rows, such as the
    target of a message stream, is read as it is.
    """
    options = spec.bronze.raw_options if spec.bronze else {}
    if spec.bronze and spec.bronze.raw_format == "delta":
        storage.require_source(spark, "delta")
        return spark.read.format("delta").options(**options).load(spec.raw)
    if spec.kind == "messages":
        schema = payload.raw_schema(spec.avro_schema, spec.partition_by)
        return spark.read.schema(schema).options(**options).parquet(spec.raw)
    return read_layer(spark, spec.raw, spec.partition_by, options, batch_ids, known)


def read_layer(
    spark: SparkSession,
    path: str,
    partition_by: Iterable[str] = (),
    options: Mapping[str, str] | None = None,
    batch_ids: Iterable[str] | None = None,
    known: ledger.State | None = None,
) -> DataFrame:
    """A layer directory through its commit rows, or as plain Parquet if it has none.

    ``batch_ids`` may name batches that a later snapshot has replaced, as long as they are kept.
    A committed batch that is not there any more fails the read, however many there are.
    """
    options = options or {}
    known = known or ledger.state(spark, path)
    chosen = known.batch_ids if batch_ids is None else tuple(batch_ids)
    stored = known.schema(partition_by, chosen)
    if stored is None:
        return spark.read.options(**{"mergeSchema": "true", **options}).parquet(path)
    columns = stored.names
    schema = T.StructType([*stored.fields, T.StructField(ledger.BATCH, T.StringType())])
    if not chosen:
        return spark.createDataFrame([], schema).select(ledger.BATCH, *columns)
    missing = sorted(set(chosen) - set(ledger.batch_dirs(spark, path)))
    if missing:
        raise FileNotFoundError(f"{path}: {len(missing)} of {len(chosen)} committed batches are gone, the first is {missing[0]!r}")
    # a literal filter on the partition column prunes other batches when the query is planned
    df = spark.read.schema(schema).options(**{**options, "basePath": path}).parquet(path).where(F.col(ledger.BATCH).isin(*chosen))
    return df.select(ledger.BATCH, *[F.col(f"`{c}`") for c in columns])


def stream_raw(spark: SparkSession, spec: DatasetSpec, max_files_per_trigger: int | None = None) -> DataFrame:
    """New files of a raw directory that a message stream fills, as a stream."""
    schema = (
        payload.raw_schema(spec.avro_schema, spec.partition_by)
        if spec.kind == "messages"
        else read_raw(spark, spec).schema
    )
    return stream_layer(spark, spec.raw, schema, spec.bronze.raw_options if spec.bronze else {}, max_files_per_trigger)


def stream_layer(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    options: Mapping[str, str] | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Parquet files of ``path`` in ``schema``, as a stream."""
    stream = spark.readStream.schema(schema).options(**(options or {}))
    if max_files_per_trigger:
        stream = stream.option("maxFilesPerTrigger", max_files_per_trigger)
    return stream.parquet(path)


def read_bronze(spark: SparkSession, spec: DatasetSpec) -> DataFrame:
    """The registered table if there is one, else the bronze directory."""
    bronze = spec.bronze
    if bronze.full_table and spark.catalog.tableExists(bronze.full_table):
        return spark.table(bronze.full_table)
    if bronze.format == "delta":
        storage.require_source(spark, "delta")
        return spark.read.format("delta").load(bronze.path)
    return read_layer(spark, bronze.path, bronze.partition_by)
