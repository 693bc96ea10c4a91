"""Message topics as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierline import storage
from tierline.functions.payload import MESSAGE_SCHEMA
from tierline.spec import DatasetSpec


def message_stream(spark: SparkSession, spec: DatasetSpec) -> DataFrame:
    """The topic of ``spec``: from Kafka, or from files that hold the same seven columns.

    For Kafka the options are those of its source: ``subscribe``, ``startingOffsets``,
    ``failOnDataLoss``, ``kafka.bootstrap.servers``. For files, ``path`` names the directory.
    """
    storage.require_source(spark, spec.message_format)
    options = dict(spec.message_options)
    if spec.message_format == "kafka":
        return spark.readStream.format("kafka").options(**options).load()
    path = options.pop("path")
    return spark.readStream.format(spec.message_format).schema(MESSAGE_SCHEMA).options(**options).load(path)
