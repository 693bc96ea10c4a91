"""Avro container files without Spark's Avro package (S4): cut at sync markers, decoded by tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tierline.functions import avro
from tierline.functions import schema as schemas
from tierline.listing import Files

_HELD = 1 << 23


def writer_schemas(files: DataFrame) -> list[str]:
    """The different schemas that files (path) were written with; tasks read the headers."""

    def run(batches):
        for batch in batches:
            found = set()
            for path in batch.column("path").to_pylist():
                with Files(path).open(path) as file:
                    found.add(avro.header(file)[0])
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], ["schema"])

    return sorted(r[0] for r in files.mapInArrow(run, "schema string").distinct().collect())


def read(spark: SparkSession, paths: list[str], range_bytes: int = 1 << 26) -> DataFrame:
    """The rows of container files with their source, columns of differing writers united by name.

    A file is read in ranges of ``range_bytes``, each by the blocks whose sync marker begins in it. Bytes that are
    not what a file's own schema says fail the read.
    """
    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(len(paths), spark.sparkContext.defaultParallelism))
    kinds = [schemas.from_avro_json(s) for s in writer_schemas(files)]
    columns = schemas.merge(kinds) if kinds else T.StructType()
    target = T.StructType([*columns, T.StructField("source_filename", T.StringType())])
    wanted = to_arrow_schema(target, timestamp_utc=True)

    def ranges(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                size = Files(path).size(path)
                starts = list(range(0, size, range_bytes))
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(starts), pa.string()), pa.array(starts, pa.int64())], ["path", "start"])

    def rows(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                store = Files(path)
                with store.open(path) as file:
                    schema, source = avro.header(file)[0], store.uri(path)
                    held, size = [], 0
                    for block in avro.blocks(file, start, start + range_bytes):
                        held.append(block)
                        size += len(block[1])
                        if size > _HELD:
                            yield _shaped(avro.rows_of_blocks(held, schema), source, wanted)
                            held, size = [], 0
                    if held:
                        yield _shaped(avro.rows_of_blocks(held, schema), source, wanted)

    cut = files.mapInArrow(ranges, "path string, start long").repartition(spark.sparkContext.defaultParallelism * 4, "path", "start")
    return cut.mapInArrow(rows, target)


def _shaped(records: pa.Array, source: str, wanted: pa.Schema) -> pa.RecordBatch:
    there = {f.name.lower(): i for i, f in enumerate(records.type)}
    columns = [
        records.field(there[f.name.lower()]).cast(f.type) if f.name.lower() in there else pa.nulls(len(records), f.type) for f in list(wanted)[:-1]
    ]
    return pa.RecordBatch.from_arrays([*columns, pa.array([source] * len(records), pa.string())], schema=wanted)
