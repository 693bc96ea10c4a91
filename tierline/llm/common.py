"""What several corpus operators share: words, sizes, shared folders and column names."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline import storage

#: A word: characters other than space and the five ASCII controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder that driver and executors share, under ``spark.checkpoint.dir``."""
    return storage.scratch(spark, f"llm-{label}")


#: Rows that go to a Python worker at a time: texts are long, and both sides hold a batch.
BATCH_ROWS = 500
_BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Run what is executed inside with at most ``BATCH_ROWS`` rows in a batch; the session's setting comes back after."""
    before = spark.conf.get(_BATCH_KEY)
    if not 0 < int(before) <= BATCH_ROWS:
        spark.conf.set(_BATCH_KEY, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_KEY, before)


def cut(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, so that lost executors cost no recomputation."""
    path = shared_dir(df.sparkSession, label)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def text_of(column: str) -> Column:
    """A text column with null as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def held_out(id_column: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id is not held out."""
    left = F.crc32(F.col(f"`{id_column}`").cast("string").cast("binary")) % modulus
    return F.coalesce(left == remainder, F.lit(False))


def by_size(batches: Iterable[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in slices of at most about ``most`` bytes of ``column``, one row at least."""
    for batch in batches:
        before = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64()))
        blocks = (before.to_numpy(zero_copy_only=False) - 1).clip(0) // most if len(batch) else np.zeros(0, "int64")
        edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(batch)]
        for start, end in zip(edges, edges[1:]):
            if end > start:
                yield batch.slice(start, end - start)
