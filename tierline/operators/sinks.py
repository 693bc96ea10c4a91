"""Layer writes and tables.

Every batch goes to its own ``ingest_batch=<id>`` subdirectory and is recorded in ``_commits``
once its data is complete, so an attempt that is repeated leaves one copy of its rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tierline import storage
from tierline.functions import derive
from tierline.functions import schema as schemas
from tierline.operators import column_stats, ledger
from tierline.spec import BronzeSpec

COMPRESSION = "snappy"


@dataclass(frozen=True)
class Written:
    """What a layer write left behind."""

    batch_ids: tuple[str, ...]
    rows: int
    known: ledger.State | None = None


def write_snapshot(
    df: DataFrame,
    target: str,
    partition_by: Sequence[str] = (),
    optimize: bool = True,
    parameters: Mapping[str, str] | None = None,
    known: ledger.State | None = None,
    files: DataFrame | None = None,
    keep: Callable[[ledger.State], Iterable[str]] = lambda known: (),
) -> Written:
    """K1: replace what ``target`` holds with ``df``.

    The new batch is written beside the old ones, and its commit row is what makes it the
    layer's content; the replaced batches are deleted last, but for those that ``keep`` names
    because someone has yet to read them. ``files`` are those it was read from.
    """
    batch_id = uuid.uuid4().hex
    if files is not None:
        ledger.remember_files(target, batch_id, files)
    return write_parts([df], target, batch_id, partition_by, optimize, parameters, known or ledger.state(df.sparkSession, target), keep)


def write_parts(
    parts: Iterable[DataFrame],
    target: str,
    batch_id: str,
    partition_by: Sequence[str],
    optimize: bool,
    parameters: Mapping[str, str] | None,
    known: ledger.State,
    keep: Callable[[ledger.State], Iterable[str]] = lambda known: (),
) -> Written:
    """K1 for content that comes in parts, each written before the next is asked for; one commit at the end."""
    rows, schema, df, stats = 0, None, None, {}
    for df in parts:
        count, own = _write(df, target, batch_id, partition_by, optimize, "overwrite" if schema is None else "append")
        rows, stats = rows + count, column_stats.merged(stats, own)
        schema = schemas.merge([df.schema] if schema is None else [schema, df.schema])
    if df is None:
        return Written((), 0, known)
    known = _record(df.sparkSession, schema, target, known, batch_id, "overwrite", rows, partition_by, parameters, stats)
    clear_replaced(df.sparkSession, target, batch_id, keep(known))
    return Written((batch_id,), rows, known)


def clear_replaced(spark: SparkSession, target: str, current: str, keep: Iterable[str] = ()) -> None:
    """Delete the batches that the snapshot ``current`` replaced, but for those to keep."""
    kept = {current, *keep}
    for batch_id in ledger.batch_dirs(spark, target):
        if batch_id not in kept:
            storage.remove(spark, ledger.batch_path(target, batch_id))
            ledger.forget_files(spark, target, batch_id)


def append_batch(
    df: DataFrame,
    target: str,
    batch_id: str,
    partition_by: Sequence[str] = (),
    optimize: bool = True,
    merge_schema: bool = True,
    parameters: Mapping[str, str] | None = None,
    known: ledger.State | None = None,
) -> Written:
    """K2: add ``df`` as one batch; a repeated ``batch_id`` is not added again."""
    known = known or ledger.state(df.sparkSession, target)
    if known.has(batch_id):
        return Written((), 0, known)
    _check_growth(known, df.schema, merge_schema)
    rows, stats = _write(df, target, batch_id, partition_by, optimize)
    known = _record(df.sparkSession, df.schema, target, known, batch_id, "append", rows, partition_by, parameters, stats)
    return Written((batch_id,), rows, known)


def compact_batches(spark: SparkSession, target: str, members: Sequence[str], df: DataFrame, partition_by: Sequence[str], known: ledger.State) -> ledger.State:
    """K8: the rows of some batches, ``df``, as one batch that takes their place by its commit.

    It is named after them, so an attempt that is repeated writes the same one again. Their directories stay.
    """
    batch_id = "compact-" + hashlib.sha256(",".join(members).encode()).hexdigest()[:32]
    if known.has(batch_id):
        return known
    rows, stats = _write(df, target, batch_id, partition_by, True)
    expected = sum(e.rows for e in known.live if e.batch_id in set(members))
    if rows != expected:
        raise RuntimeError(f"{target}: wrote {rows} rows of {expected}; the batches stay as they are")
    # the whole layer's schema goes with it, as those of the batches it replaces are no longer looked at
    schema = known.schema(partition_by)
    return _record(spark, schema, target, known, batch_id, "compact", rows, partition_by, {"replaces": ",".join(members)}, stats)


def clear_folded(spark: SparkSession, target: str, known: ledger.State) -> None:
    """Delete the directories of batches that compactions have taken the place of."""
    for batch_id in ledger.batch_dirs(spark, target):
        if batch_id in known.folded:
            storage.remove(spark, ledger.batch_path(target, batch_id))


def _write(df: DataFrame, target: str, batch_id: str, partition_by: Sequence[str], optimize: bool, mode: str = "overwrite") -> tuple[int, column_stats.Stats]:
    derive.require_columns(df, partition_by)
    if ledger.BATCH in df.columns:
        raise ValueError(f"{ledger.BATCH!r} is a reserved column")
    schema = df.schema
    df, seen = _laid_out(df, partition_by, optimize)
    _parquet(df, mode, partition_by).save(ledger.batch_path(target, batch_id))
    return seen.get["rows"], column_stats.found(schema, seen.get)


def _laid_out(df: DataFrame, partition_by: Sequence[str], optimize: bool) -> tuple[DataFrame, Observation]:
    """K8: bring rows of one output directory together, so that files are few and large.

    ``rebalance`` lets AQE split a directory that holds much of the data over several tasks and
    merge small ones. Rows and columns are counted after it, in the stage that writes, where each task
    counts once however often it is retried.
    """
    if optimize and partition_by:
        df = df.hint("rebalance", *[F.col(_quoted_name(c)) for c in partition_by])
    rows = Observation()
    return df.observe(rows, F.count(F.lit(1)).alias("rows"), *column_stats.aggregates(df.schema)), rows


def _parquet(df: DataFrame, mode: str, partition_by: Sequence[str]):
    """Snappy Parquet, partitioned if asked; an overwrite replaces the whole directory."""
    writer = df.write.format("parquet").mode(mode).option("compression", COMPRESSION).option("partitionOverwriteMode", "static")
    return writer.partitionBy(*partition_by) if partition_by else writer


def _record(spark, schema, target, known, batch_id, operation, rows, partition_by, parameters, stats=None) -> ledger.State:
    details = {"partition_by": ",".join(partition_by), **(parameters or {})}
    return ledger.record(spark, target, known, ledger.Commit(batch_id, operation, schema, details, {"rows": rows}, stats))


def _check_growth(known: ledger.State, schema: T.StructType, merge_schema: bool) -> None:
    """H5: new columns may join what is stored, unless merging is off; types may not change."""
    stored = known.schema()
    if stored is None:
        return
    merged = schemas.merge([stored, schema])
    if not merge_schema and merged != stored:
        changed = [c.name for c in merged if c not in stored.fields]
        raise schemas.SchemaConflict(f"columns {changed} are new or have new fields, and merging schemas is off")


def append_stream(
    df: DataFrame,
    target: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    trigger: Mapping | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """K3: a stream into partitioned Parquet through Spark's exactly-once file sink.

    The directory belongs to this query: files that other jobs add to it are not seen.
    """
    derive.require_columns(df, partition_by)
    if not checkpoint:
        raise ValueError(f"a stream into {target} needs a checkpoint path")
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("compression", COMPRESSION)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start(target)


def write_bronze(
    df: DataFrame,
    bronze: BronzeSpec,
    batch_id: str,
    parameters: Mapping[str, str] | None = None,
    expected_rows: int | None = None,
    known: ledger.State | None = None,
) -> Written:
    """K4-K8: append promoted rows as one batch, and keep the table in step.

    A batch that was committed before is not added again; what an unfinished attempt left under
    the same id is replaced. With ``expected_rows`` a different count leaves the batch
    uncommitted and raises.
    """
    spark = df.sparkSession
    known = known or ledger.state(spark, bronze.path)
    if known.has(batch_id):
        return Written((), 0, known)
    stored = known.schema()
    if bronze.evolution == "none" and stored is not None:
        present = {n.lower() for n in stored.names}
        df = df.select(*[F.col(_quoted_name(c)) for c in df.columns if c.lower() in present])
    _check_growth(known, df.schema, bronze.merge_schema)
    if bronze.format == "delta":
        rows, stats = _write_delta(df, bronze, batch_id), None
    else:
        rows, stats = _write(df, bronze.path, batch_id, bronze.partition_by, bronze.optimize_write)
    if expected_rows is not None and rows != expected_rows:
        raise RuntimeError(f"{bronze.path}: wrote {rows} rows of {expected_rows}; the batch stays uncommitted")
    known = _record(spark, df.schema, bronze.path, known, batch_id, "append", rows, bronze.partition_by, parameters, stats)
    align_table(spark, bronze, known)
    return Written((batch_id,), rows, known)


def _write_delta(df: DataFrame, bronze: BronzeSpec, batch_id: str) -> int:
    """Replacing exactly this batch's rows makes a repeated attempt leave one copy."""
    storage.require_source(df.sparkSession, "delta")
    derive.require_columns(df, bronze.partition_by)
    layout = [ledger.BATCH, *bronze.partition_by]
    df, rows = _laid_out(df.withColumn(ledger.BATCH, F.lit(batch_id)), layout, bronze.optimize_write)
    writer = (
        df.write.format("delta")
        .mode("overwrite")
        .option("replaceWhere", f"{ledger.BATCH} = '{batch_id}'")
        .option("mergeSchema", str(bronze.merge_schema).lower())
        .partitionBy(*layout)
    )
    if bronze.full_table:
        create_database(df.sparkSession, bronze.database)
        writer.option("path", bronze.path).saveAsTable(bronze.full_table)
    else:
        writer.save(bronze.path)
    return rows.get["rows"]


def create_database(spark: SparkSession, name: str) -> None:
    """K7."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)}")


def align_table(spark: SparkSession, bronze: BronzeSpec, known: ledger.State | None = None) -> None:
    """K6: an external table over the bronze directory that shows the committed batches and no others.

    This comes after the commit row and again at the start of each promotion, so what a crash in
    between left out is made good, and partitions of batches that are not committed, or have been
    replaced, go. Only batches whose partitions are missing are looked at.
    """
    if not bronze.full_table or bronze.format != "parquet":
        return
    known = known or ledger.state(spark, bronze.path)
    merged = known.schema(bronze.partition_by)
    if merged is None:
        return
    columns = T.StructType([T.StructField(ledger.BATCH, T.StringType()), *merged.fields])
    layout = [ledger.BATCH, *bronze.partition_by]
    table = _quoted(bronze.full_table)
    if spark.catalog.tableExists(bronze.full_table) and _nested_growth(spark.table(bronze.full_table).schema, columns):
        drop_table(spark, bronze.full_table)  # a struct cannot gain fields in place; the files stay
    if not spark.catalog.tableExists(bronze.full_table):
        create_database(spark, bronze.database)
        location = bronze.path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {table} ({columns.toDDL()}) USING parquet "
            f"PARTITIONED BY ({', '.join(map(_quoted_name, layout))}) LOCATION '{location}'"
        )
    else:
        present = {c.lower() for c in spark.table(bronze.full_table).columns}
        added = T.StructType([c for c in columns if c.name.lower() not in present])
        if added:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added.toDDL()})")
    shown = _shown_batches(spark, table)
    for batch_id in sorted(shown - set(known.batch_ids)):
        listed = spark.sql(f"SHOW PARTITIONS {table} PARTITION ({_quoted_name(ledger.BATCH)}={_value(batch_id)})")
        for row in listed.collect():
            values = storage.partition_spec(spark, row.partition)
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({', '.join(f'{_quoted_name(c)}={_value(v)}' for c, v in values.items())})")
    for batch_id in [b for b in known.batch_ids if b not in shown]:
        values = storage.partition_values(spark, ledger.batch_path(bronze.path, batch_id), len(bronze.partition_by))
        _add_partitions(spark, table, layout, [{ledger.BATCH: batch_id, **v} for v in values])
    spark.catalog.refreshTable(bronze.full_table)


def _shown_batches(spark: SparkSession, table: str) -> set[str]:
    """The batches that a table has partitions of."""
    first = F.substring_index(F.col("partition"), "/", 1)
    found = spark.sql(f"SHOW PARTITIONS {table}").select(F.substring_index(first, "=", -1).alias("b")).distinct()
    return {r.b for r in found.collect()}


def _nested_growth(present: T.StructType, wanted: T.StructType) -> bool:
    kinds = {c.name.lower(): c.dataType.simpleString() for c in present}
    return any(kinds.get(c.name.lower(), c.dataType.simpleString()) != c.dataType.simpleString() for c in wanted)


def _add_partitions(spark: SparkSession, table: str, layout: Sequence[str], found: Sequence[Mapping[str, str | None]], size: int = 200) -> None:
    for start in range(0, len(found), size):
        specs = [
            "PARTITION (" + ", ".join(f"{_quoted_name(c)}={_value(p[c])}" for c in layout) + ")"
            for p in found[start:start + size]
        ]
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(specs)}")


def _value(text: str | None) -> str:
    return "null" if text is None else "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _quoted(dotted: str) -> str:
    return ".".join(_quoted_name(part) for part in dotted.split("."))


def drop_table(spark: SparkSession, name: str) -> None:
    """K10."""
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")


def export_single_file(df: DataFrame, directory: str, file_name: str, fmt: str = "csv", options: Mapping[str, str] | None = None) -> str:
    """K9: ``df`` as one file of a chosen name.

    One file means one writing task, so this is for deliveries of modest size and not for
    layers. The temporary directory is hidden from scans of ``directory``.
    """
    spark = df.sparkSession
    base = directory.rstrip("/")
    temporary = f"{base}/_export_{uuid.uuid4().hex}"
    defaults = {"header": "true", "timestampFormat": schemas.DEFAULT_TIMESTAMP_FORMAT} if fmt == "csv" else {}
    try:
        df.coalesce(1).write.format(fmt).options(**{**defaults, **(options or {})}).save(temporary)
        fs, path = storage.handle(spark, temporary)
        parts = [s.getPath().toString() for s in fs.listStatus(path) if s.getPath().getName().startswith("part-")]
        if len(parts) != 1:
            raise RuntimeError(f"expected one part file in {temporary}, found {parts}")
        destination = f"{base}/{file_name}"
        storage.Store(spark).move(parts[0], destination)
    finally:
        storage.remove(spark, temporary)
    return destination
