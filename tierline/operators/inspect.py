"""Looking into layers (A1, A3, F1, L1, L2, M2-M5, P10) and the reports made of it."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline import storage
from tierline.operators import column_stats, ledger
from tierline.sources import layers
from tierline.spec import DatasetSpec

HISTORY = ("version", "timestamp", "operation", "operationParameters", "operationMetrics")


def layer_df(spark: SparkSession, spec: DatasetSpec, layer: str = "raw") -> DataFrame:
    """The rows of a dataset's raw or bronze layer."""
    if layer == "raw":
        return layers.read_raw(spark, spec)
    if layer == "bronze":
        return layers.read_bronze(spark, spec)
    raise ValueError(f"layer must be raw or bronze, not {layer!r}")


def pick_existing(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """P10: the wanted columns that exist; all columns if none does."""
    found = [c for c in wanted if c in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in found]) if found else df


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A1, A3, F1: row count, non-null count and emptiness per column, from one pass."""
    names = list(columns if columns is not None else df.columns)
    counts = [F.count(F.lit(1)).alias("rows"), *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(names)]]
    per_column = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("non_null")) for i, c in enumerate(names)]
    return (
        df.agg(*counts)
        .select("rows", F.explode(F.array(*per_column)).alias("c"))
        .select("c.column_name", "rows", "c.non_null", (F.col("rows") == 0).alias("is_empty"))
    )


def committed_profile(spark: SparkSession, path: str, partition_by: Iterable[str] = ()) -> DataFrame | None:
    """A1, A3, F1 of a committed layer, with the least and most of columns that have an order, without reading its data.

    ``None`` if the layer has no commit rows, or batches from before these kept statistics.
    """
    known = ledger.state(spark, path)
    rows, schema = ledger.live_commits(spark, path, known), known.schema(partition_by)
    return None if rows is None or schema is None else column_stats.profile(rows, schema)


def non_null_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """non-null values of those columns that exist, in one row and one pass."""
    found = [c for c in columns if c in df.columns]
    if not found:
        raise ValueError(f"none of {list(columns)} is among {df.columns}")
    return df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in found])


def sample(df: DataFrame, n: int = 10, order_by: Sequence[str] = ()) -> DataFrame:
    """L1: ``n`` rows, the first by ``order_by`` if given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def schema_df(df: DataFrame) -> DataFrame:
    """L2: the schema as rows of position, name, type and nullability."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")


def history(spark: SparkSession, path: str) -> DataFrame:
    """M2: commits of a layer directory, newest first."""
    if table_kind(spark, path) == "delta":
        storage.require_source(spark, "delta")
        return spark.sql(f"DESCRIBE HISTORY delta.`{path}`").select(*HISTORY)
    return ledger.commits(spark, path).select(*HISTORY).orderBy(F.desc("version"))


def table_exists(spark: SparkSession, name: str) -> bool:
    """M3."""
    return spark.catalog.tableExists(name)


def table_kind(spark: SparkSession, path: str) -> str:
    """M4: delta, committed (this library's batches), stream (a file sink's target), plain or missing."""
    base = path.rstrip("/")
    for marker, kind in (("_delta_log", "delta"), ("_commits", "committed"), ("_spark_metadata", "stream")):
        if storage.exists(spark, f"{base}/{marker}"):
            return kind
    return "plain" if storage.exists(spark, base) else "missing"


def list_files(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """M5: files under ``path`` with size and time, hidden directories left out, contents unread."""
    options = {"recursiveFileLookup": str(recursive).lower()}
    return storage.listing(spark, path, options)


@dataclass(frozen=True)
class LayerReport:
    """What one layer of a dataset holds."""

    dataset: str
    layer: str
    kind: str
    schema: DataFrame
    profile: DataFrame
    sample: DataFrame
    history: DataFrame | None

    def show(self) -> None:
        print(f"{self.dataset} / {self.layer} ({self.kind})")
        for part in (self.schema, self.profile, self.sample, self.history):
            if part is not None:
                part.show(max(1, part.count()), truncate=False)


def report(
    spark: SparkSession,
    spec: DatasetSpec,
    layer: str = "raw",
    columns: Sequence[str] = (),
    order_by: Sequence[str] = (),
    n: int = 10,
) -> LayerReport:
    """Schema, counts, a sample and, where there are commits, the history.

    ``columns`` limits sample and counts to those that exist.
    """
    df = layer_df(spark, spec, layer)
    path = spec.raw if layer == "raw" else spec.bronze.path
    kind = table_kind(spark, path)
    chosen = pick_existing(df, columns) if columns else df
    known = committed_profile(spark, path, spec.partition_by if layer == "raw" else spec.bronze.partition_by) if kind == "committed" else None
    if known is not None:  # counted when the batches were written
        known = known.where(F.col("column_name").isin(*chosen.columns)).select("column_name", "rows", "non_null", "is_empty")
    return LayerReport(
        dataset=spec.name,
        layer=layer,
        kind=kind,
        schema=schema_df(df),
        profile=profile(chosen) if known is None else known,
        sample=sample(chosen, n, order_by),
        history=history(spark, path) if kind in ("delta", "committed") else None,
    )
