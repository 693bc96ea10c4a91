"""What has been done: commit rows per layer, processed files, and their archive.

A layer directory holds one subdirectory per ingested batch, ``ingest_batch=<id>``, and a
``_commits`` table with one row per finished batch. A batch without a row is unfinished: readers
here leave it out and the next attempt overwrites it. The table is an audit record; it gives no
time travel and expects one writer per layer directory.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property
from itertools import islice

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline import listing, storage
from tierline.functions import schema as schemas
from tierline.operators import column_stats

BATCH = "ingest_batch"

COMMIT_SCHEMA = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("operation", T.StringType()),
    T.StructField("table_schema", T.StringType()),
    T.StructField("operationParameters", T.MapType(T.StringType(), T.StringType())),
    T.StructField("operationMetrics", T.MapType(T.StringType(), T.StringType())),
    T.StructField("column_stats", T.StringType()),
])

# Commit rows are appended as small files; past this many they are rewritten as one.
COMPACT_AFTER = 64

_GENERATION = "gen="


def commit_path(target: str) -> str:
    return f"{target.rstrip('/')}/_commits"


def batch_path(target: str, batch_id: str) -> str:
    return f"{target.rstrip('/')}/{BATCH}={batch_id}"


def staging_path(target: str, batch_id: str) -> str:
    """Where a batch keeps lines between looking at them and writing its rows; scans of the layer pass it over."""
    return f"{target.rstrip('/')}/_staged/{batch_id}"


def batch_dirs(spark: SparkSession, target: str) -> list[str]:
    """Ids of the batches that have a directory, finished or not."""
    return [d.removeprefix(f"{BATCH}=") for d in storage.child_dirs(spark, target) if d.startswith(f"{BATCH}=")]


def _generation(spark: SparkSession, target: str) -> int | None:
    """The newest complete copy of the commit rows; an unfinished rewrite is not it."""
    base = commit_path(target)
    numbers = [int(d.removeprefix(_GENERATION)) for d in storage.child_dirs(spark, base) if d.startswith(_GENERATION)]
    for number in sorted(numbers, reverse=True):
        if storage.exists(spark, f"{base}/{_GENERATION}{number}/_SUCCESS"):
            return number
    return None


def _read(spark: SparkSession, target: str, generation: int) -> DataFrame:
    return spark.read.schema(COMMIT_SCHEMA).parquet(f"{commit_path(target)}/{_GENERATION}{generation}")


def commits(spark: SparkSession, target: str) -> DataFrame:
    """The commit rows of a layer directory; empty if nothing was committed there.

    ``table_schema`` is present where it differs from that of the rows before.
    """
    generation = _generation(spark, target)
    return spark.createDataFrame([], COMMIT_SCHEMA) if generation is None else _read(spark, target, generation)


@dataclass(frozen=True)
class State:
    """A layer as its commit rows tell it: one small entry per batch, read in one job."""

    generation: int | None
    entries: tuple[Row, ...]

    @cached_property
    def live(self) -> tuple[Row, ...]:
        """Batches since the last overwrite that no compaction has taken the place of, oldest first."""
        newest = max((e.version for e in self.entries if e.operation == "overwrite"), default=0)
        return tuple(e for e in self.entries if e.version >= newest and e.batch_id not in self.folded)

    @cached_property
    def folded(self) -> frozenset[str]:
        """Batches whose rows a later compaction holds."""
        return frozenset(b for e in self.entries if e.replaces for b in e.replaces.split(","))

    @property
    def batch_ids(self) -> tuple[str, ...]:
        return tuple(e.batch_id for e in self.live)

    @property
    def next_version(self) -> int:
        return self.entries[-1].version + 1 if self.entries else 0

    @cached_property
    def _ids(self) -> frozenset[str]:
        return frozenset(e.batch_id for e in self.entries)

    def has(self, batch_id: str) -> bool:
        return batch_id in self._ids

    def schema(self, partition_by: Iterable[str] = (), batch_ids: Iterable[str] | None = None) -> T.StructType | None:
        """The merged schema of the live batches, or of those given; ``None`` if there are none.

        A row has a schema where it differs from the rows before, back to the last overwrite; so
        those from there on belong to a batch.
        """
        entries = self.live
        if batch_ids is not None and not set(batch_ids) <= {e.batch_id for e in entries}:
            chosen = [e.version for e in self.entries if e.batch_id in set(batch_ids)]
            first = max((e.version for e in self.entries if e.operation == "overwrite" and e.version <= min(chosen, default=0)), default=0)
            entries = [e for e in self.entries if first <= e.version <= max(chosen, default=-1)]
        found = [T.StructType.fromJson(json.loads(e.table_schema)) for e in entries if e.table_schema]
        return schemas.merge(found, partition_by) if found else None


def state(spark: SparkSession, target: str) -> State:
    generation = _generation(spark, target)
    if generation is None:
        return State(None, ())
    entries = _read(spark, target, generation).select(
        "version",
        "batch_id",
        "operation",
        "table_schema",
        F.col("operationMetrics")["rows"].cast("long").alias("rows"),
        F.col("operationParameters")["raw_through"].alias("raw_through"),
        F.col("operationParameters")["replaces"].alias("replaces"),
    ).collect()
    return State(generation, tuple(sorted(entries, key=lambda e: e.version)))


def live_commits(spark: SparkSession, target: str, known: State) -> DataFrame | None:
    """The commit rows of the live batches, if all of them have column statistics."""
    if known.generation is None:
        return None
    rows = _read(spark, target, known.generation).where(F.col("batch_id").isin(*known.batch_ids))
    return None if rows.where(F.col("column_stats").isNull()).count() else rows


@dataclass(frozen=True)
class Commit:
    """One finished batch, ready to be recorded."""

    batch_id: str
    operation: str
    schema: T.StructType
    parameters: Mapping[str, str]
    metrics: Mapping[str, int]
    stats: column_stats.Stats | None = None


def record(spark: SparkSession, target: str, known: State, commit: Commit) -> State:
    """Add a commit row after those in ``known``; the state with it."""
    stored = None if commit.operation in ("overwrite", "compact") else known.schema()
    merged = schemas.merge([commit.schema] if stored is None else [stored, commit.schema])
    table_schema = None if merged == stored else commit.schema.json()
    values = {
        "version": F.lit(known.next_version).cast("long"),
        "batch_id": F.lit(commit.batch_id),
        "timestamp": F.current_timestamp(),
        "operation": F.lit(commit.operation),
        "table_schema": F.lit(table_schema).cast("string"),
        "operationParameters": _string_map(commit.parameters),
        "operationMetrics": _string_map(commit.metrics),
        "column_stats": F.lit(column_stats.dumped(commit.stats)).cast("string"),
    }
    generation = _store(spark, target, known, spark.range(0, 1, 1, 1).select(*[values[c].alias(c) for c in COMMIT_SCHEMA.names]))
    entry = Row(
        version=known.next_version, batch_id=commit.batch_id, operation=commit.operation, table_schema=table_schema,
        rows=commit.metrics.get("rows"), raw_through=commit.parameters.get("raw_through"),
        replaces=commit.parameters.get("replaces"),
    )
    return State(generation, (*known.entries, entry))


def _string_map(values: Mapping) -> Column:
    return F.create_map(*[F.lit(str(part)) for pair in values.items() for part in pair]).cast("map<string,string>")


def _store(spark: SparkSession, target: str, known: State, new: DataFrame) -> int:
    # Without a complete copy, what an unfinished first commit may have left is replaced.
    base, number, mode = commit_path(target), known.generation or 0, "overwrite" if known.generation is None else "append"
    if known.generation is not None and len(known.entries) % COMPACT_AFTER == COMPACT_AFTER - 1:
        new = _read(spark, target, number).unionByName(new)
        number, mode = number + 1, "overwrite"
    writer = new.coalesce(1).write.mode(mode).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    writer.parquet(f"{base}/{_GENERATION}{number}")
    if mode == "overwrite" and number >= 2:
        storage.remove(spark, f"{base}/{_GENERATION}{number - 2}")
    return number


def pending(source: State, target: State, there: Iterable[str]) -> list[list[Row]]:
    """Batches of ``source`` that came after the last one promoted to ``target``, oldest first.

    Each promotion records the source batch it went up to. If that batch is unknown, the source
    was made anew, and all of it is pending. Replaced snapshots are pending as long as they are
    kept (``there``); each starts a group of its own, as its columns may differ.
    """
    through = next((e.raw_through for e in reversed(target.entries) if e.raw_through), None)
    done = next((e.version for e in source.entries if e.batch_id == through), -1)
    kept, live = set(there), {e.batch_id for e in source.live}
    groups: list[list[Row]] = []
    for entry in source.entries:
        if entry.version <= done or entry.batch_id not in kept | live:
            continue
        if not groups or entry.operation == "overwrite":
            groups.append([])
        groups[-1].append(entry)
    return groups


FILE_COLUMNS = "path string, length bigint, modificationTime timestamp"


def _files_path(target: str, batch_id: str) -> str:
    return f"{target.rstrip('/')}/_files/{batch_id}"


def remember_files(target: str, batch_id: str, files: DataFrame) -> None:
    """Keep the list of files a snapshot is made of, before the snapshot is committed."""
    files.write.mode("overwrite").parquet(_files_path(target, batch_id))


def remembered_files(spark: SparkSession, target: str, batch_id: str) -> DataFrame:
    return spark.read.schema(FILE_COLUMNS).parquet(_files_path(target, batch_id))


def forget_files(spark: SparkSession, target: str, batch_id: str) -> None:
    storage.remove(spark, _files_path(target, batch_id))


def left_over(target: str, known: State, files: DataFrame) -> DataFrame | None:
    """Those of ``files`` that the latest committed snapshot has taken in already.

    They are in landing still if an earlier run ended between commit and archive.
    """
    spark = files.sparkSession
    if not known.live or not storage.exists(spark, _files_path(target, known.live[-1].batch_id)):
        return None
    taken = remembered_files(spark, target, known.live[-1].batch_id)
    return files.join(taken, ["path", "length", "modificationTime"], "left_semi")


def processed_files(df: DataFrame) -> DataFrame:
    """A2 and F2: rows per source file, nameless sources left out."""
    return (
        df.where(F.length("source_filename") > 0)
        .groupBy("source_filename")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def still_there(before: DataFrame, now: DataFrame) -> DataFrame:
    """Files of an earlier listing that are there unchanged; those of zero bytes left out."""
    return before.where("length > 0").join(now, ["path", "length", "modificationTime"], "left_semi")


def basename(uri: Column, encoded: bool = True) -> Column:
    """The last path segment, URL-decoded if the URI is encoded (a ``+`` stands for itself)."""
    last = F.element_at(F.split(uri, "/"), -1)
    return F.url_decode(F.replace(last, F.lit("+"), F.lit("%2B"))) if encoded else last


def archive_plan(files: DataFrame, archive: str, uri: str = "source_filename", encoded: bool = True) -> DataFrame:
    """Each file with its place in the flat archive directory.

    ``archived_as`` is the plain name; when several files of the plan share it, each gets a
    hash of its URI before the extension. ``fallback`` is the hashed name, for a plain name that
    an earlier run has taken.
    """
    base = archive.rstrip("/") + "/"
    stem, extension = F.regexp_replace("file_name", r"\.[^.]*$", ""), F.regexp_extract("file_name", r"(\.[^.]*)$", 1)
    hashed = F.concat(stem, F.lit("-"), _tag(uri, files), extension)
    named = files.withColumn("file_name", basename(F.col(uri), encoded))
    shared = named.groupBy("file_name").agg(F.count(F.lit(1)).alias("same_name"))
    return (
        named.join(shared, "file_name")
        .withColumn("fallback", F.concat(F.lit(base), hashed))
        .withColumn("archived_as", F.when(F.col("same_name") > 1, F.col("fallback")).otherwise(F.concat(F.lit(base), F.col("file_name"))))
        .drop("same_name")
    )


def _tag(uri: str, files: DataFrame) -> Column:
    identity = [c for c in (uri, "length", "modificationTime") if c in files.columns]
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in identity]))


def archive(spark: SparkSession, files: DataFrame, target: str, uri: str = "path", encoded: bool = False, threads: int = 16) -> int:
    """M1: move files into the archive once their rows are safely written; how many of them are there then.

    Tasks move them, some thousand files each at most, and a task that runs again finds what it has moved before. A file
    that is gone without being in the archive was moved on by someone else. In a store that only Spark
    reaches, ``threads`` of the driver rename, as Spark's own streaming file source does, and
    only files that this call has moved are counted.
    """
    storage.make_dirs(spark, target)
    plan = archive_plan(files, target, uri, encoded).select(uri, "archived_as", "fallback")
    source = files.select(uri).first()
    if source is None:
        return 0
    store = storage.Store(spark)
    if listing.reachable(store.spelled(source[0])) and listing.reachable(store.spelled(target)):
        outcomes = plan.repartition(spark.sparkContext.defaultParallelism).mapInArrow(listing.moved, "outcome string")
        return outcomes.where(F.col("outcome") == listing.MOVED).count()
    moved = 0
    with ThreadPoolExecutor(threads) as pool:
        rows = plan.toLocalIterator(prefetchPartitions=True)
        while chunk := list(islice(rows, 1000)):
            moved += sum(pool.map(lambda r: _archive_one(store, r[0], r[1], r[2]), chunk))
    return moved


def _archive_one(store: storage.Store, source: str, destination: str, fallback: str) -> bool:
    try:
        return store.move(source, destination)
    except FileExistsError:
        return store.move(source, fallback)
