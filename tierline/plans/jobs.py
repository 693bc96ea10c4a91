"""Pipelines over the operators (J1-J4) and their run report."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple, dataclass, replace
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierline import storage
from tierline.functions import derive, payload
from tierline.functions import schema as schemas
from tierline.operators import ledger, sinks
from tierline.sources import files, layers, messages
from tierline.spec import BronzeSpec, DatasetSpec, Layers, specs_from_config
from tierline.streaming import control, intake, promote

log = logging.getLogger(__name__)

REPORT_SCHEMA = "dataset string, job string, status string, rows bigint, files bigint, skipped bigint, error string"


@dataclass(frozen=True)
class Outcome:
    """One line of the run report; status is ok, empty, partial, skipped or failed."""

    dataset: str
    job: str
    status: str
    rows: int = 0
    files: int = 0
    skipped: int = 0
    error: str | None = None


class RunFailed(RuntimeError):
    """At least one dataset failed; ``outcomes`` tells the story of all."""

    def __init__(self, outcomes: Sequence[Outcome]):
        failed = [f"{o.dataset}: {o.error}" for o in outcomes if o.status == "failed"]
        super().__init__("; ".join(failed))
        self.outcomes = tuple(outcomes)


def prepare_raw(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Lineage and the date parts the raw layout asks for."""
    df = derive.date_parts(derive.with_lineage(df), spec.date_source, derive.listed_parts(spec.partition_by), spec.date_unit)
    derive.require_columns(df, spec.partition_by)
    return df


def prepare_bronze(df: DataFrame, bronze: BronzeSpec) -> DataFrame:
    """The date parts the bronze layout asks for."""
    parts = {name: part for name, part in ((bronze.year_column, "year"), (bronze.month_column, "month")) if name}
    df = derive.date_parts(df, bronze.source_column, parts, bronze.source_unit)
    derive.require_columns(df, bronze.partition_by)
    return df


def landing_to_raw(spark: SparkSession, spec: DatasetSpec) -> Outcome:
    """Landing files into raw, as a snapshot or by appending what is new; then archive them."""
    if spec.mode == "append":
        done = intake.ingest_new_files(spark, spec, lambda df: prepare_raw(df, spec))
        status = "partial" if done.skipped else "ok" if done.files else "empty"
        return Outcome(spec.name, "landing_to_raw", status, done.rows, done.files, done.skipped)
    return _snapshot(spark, spec)


def _snapshot(spark: SparkSession, spec: DatasetSpec) -> Outcome:
    """All of landing as one new batch, read and written ``max_files_per_trigger`` files at a time.

    The list of files is kept beside the layer, not in the driver; it also tells a later run what
    is still to be archived.
    """
    known = ledger.state(spark, spec.raw)
    if spec.archive:  # what the last snapshot took in but did not get to archive
        taken = ledger.left_over(spec.raw, known, files.landing_files(spark, spec))
        if taken is not None:
            ledger.archive(spark, taken, spec.archive)
    batch_id = uuid.uuid4().hex
    ledger.remember_files(spec.raw, batch_id, files.landing_files(spark, spec))
    listed = ledger.remembered_files(spark, spec.raw, batch_id)
    count = listed.count()
    try:
        written = sinks.write_parts(
            _parts(spark, spec, listed, ledger.staging_path(spec.raw, batch_id)), spec.raw, batch_id, spec.partition_by, spec.optimize_write, {"files": str(count)}, known,
            lambda raw: _unpromoted(spark, spec, raw),
        )
    except Exception:
        if not ledger.state(spark, spec.raw).has(batch_id):
            ledger.forget_files(spark, spec.raw, batch_id)
        raise
    if spec.archive:
        if written.batch_ids:
            ledger.archive(spark, listed, spec.archive)
    if not (written.batch_ids and spec.archive):
        ledger.forget_files(spark, spec.raw, batch_id)
    return Outcome(spec.name, "landing_to_raw", "ok" if written.batch_ids else "empty", written.rows, count)


def _parts(spark: SparkSession, spec: DatasetSpec, listed: DataFrame, staging: str) -> Iterator[DataFrame]:
    """The rows of the listed files in parts; undeclared columns keep the type of the parts before."""
    rows, stored = listed.where("length > 0").select("path").orderBy("path").toLocalIterator(), None
    try:
        while chunk := [r.path for r in islice(rows, spec.max_files_per_trigger)]:
            df = files.read_files(spark, spec, chunk, stored, staging)
            if df is not None:
                df = prepare_raw(df, spec)
                stored = schemas.merge([df.schema] if stored is None else [stored, df.schema])
                yield df  # written before the next part is asked for
    finally:
        storage.remove(spark, staging)


def raw_to_bronze(spark: SparkSession, spec: DatasetSpec) -> Outcome:
    """Raw into bronze, each raw batch once.

    A raw layer with commit rows is promoted by its pending batches, all in one job and into one
    bronze batch, however many small arrivals they came from. One that a
    message stream or another writer fills is followed as a stream with its own checkpoint.
    """
    bronze = spec.bronze
    if bronze is None:
        return Outcome(spec.name, "raw_to_bronze", "skipped", error="bronze is not enabled")
    if not storage.exists(spark, spec.raw):
        return Outcome(spec.name, "raw_to_bronze", "empty")
    if bronze.raw_format == "parquet" and storage.exists(spark, ledger.commit_path(spec.raw)):
        return _promote_pending(spark, spec, bronze)
    if bronze.raw_format == "delta":
        storage.require_source(spark, "delta")
        raw = spark.readStream.format("delta").options(**bronze.raw_options).load(spec.raw)
    else:
        raw = layers.stream_raw(spark, spec, spec.max_files_per_trigger)
    done = promote.stream_bronze(raw, bronze, lambda df: prepare_bronze(df, bronze), spec.name)
    return Outcome(spec.name, "raw_to_bronze", "ok" if done.rows else "empty", done.rows)


def _promote_pending(spark: SparkSession, spec: DatasetSpec, bronze: BronzeSpec) -> Outcome:
    raw, known = ledger.state(spark, spec.raw), ledger.state(spark, bronze.path)
    sinks.align_table(spark, bronze, known)
    groups = ledger.pending(raw, known, ledger.batch_dirs(spark, spec.raw))
    if not groups:
        return Outcome(spec.name, "raw_to_bronze", "empty")
    rows = 0
    if not derive.listed_parts(spec.partition_by):  # raw files that hold rows of all dates would each become a file in every directory
        bronze = replace(bronze, optimize_write=True)
    for waiting in groups:
        df = layers.read_raw(spark, spec, [w.batch_id for w in waiting], raw).drop(ledger.BATCH)
        # Named after the first batch it covers: a repeated attempt starts there again.
        written = sinks.write_bronze(
            prepare_bronze(df, bronze), bronze, waiting[0].batch_id, {"raw_through": waiting[-1].batch_id}, sum(w.rows for w in waiting)
        )
        rows += written.rows
    if raw.live and raw.live[0].operation == "overwrite":
        sinks.clear_replaced(spark, spec.raw, raw.live[0].batch_id, raw.batch_ids)
    return Outcome(spec.name, "raw_to_bronze", "ok", rows)


def rewrite_bronze(spark: SparkSession, spec: DatasetSpec) -> Outcome:
    """Fold bronze's batches into one, so that it has one directory per partition however often it was added to.

    The rewritten batch replaces the others by one commit, after which the table shows it alone; a crash
    before that leaves the old batches. What the next promotion starts from is kept.
    """
    bronze = spec.bronze
    if bronze is None or bronze.format != "parquet":
        return Outcome(spec.name, "rewrite_bronze", "skipped", error="only Parquet bronze is rewritten")
    known = ledger.state(spark, bronze.path)
    if len(known.live) < 2:
        return Outcome(spec.name, "rewrite_bronze", "empty")
    through = next((e.raw_through for e in reversed(known.entries) if e.raw_through), None)
    df = layers.read_layer(spark, bronze.path, bronze.partition_by, known=known).drop(ledger.BATCH)
    # replaced batches stay until the table no longer shows them
    written = sinks.write_parts(
        [df], bronze.path, uuid.uuid4().hex, bronze.partition_by, True, {"raw_through": through} if through else None, known,
        lambda known: [e.batch_id for e in known.entries],
    )
    sinks.align_table(spark, bronze, written.known)
    sinks.clear_replaced(spark, bronze.path, written.batch_ids[0])
    return Outcome(spec.name, "rewrite_bronze", "ok", written.rows)


def compact_bronze(spark: SparkSession, spec: DatasetSpec, target_bytes: int = 1 << 30) -> Outcome:
    """K8: fold bronze's small batches together, into batches of about ``target_bytes``; larger ones are left alone.

    Small batches are packed into bins by their size, those that fit first; a bin of one stays as it is. So no
    byte of a large batch is rewritten, and a batch is rewritten again only while it is small. Each bin is one commit,
    and a crash between commits leaves a layer of the same rows.
    """
    bronze = spec.bronze
    if bronze is None or bronze.format != "parquet":
        return Outcome(spec.name, "compact_bronze", "skipped", error="only Parquet bronze is compacted")
    known = ledger.state(spark, bronze.path)
    if known.live:
        sinks.clear_folded(spark, bronze.path, known)
    listed = storage.listing(spark, bronze.path, {"recursiveFileLookup": "true"}) if known.live else None
    if listed is None:
        return Outcome(spec.name, "compact_bronze", "empty")
    batch = F.regexp_extract("path", f"/{ledger.BATCH}=([^/]+)/", 1).alias("batch")
    sizes = {r.batch: r.bytes for r in listed.groupBy(batch).agg(F.sum("length").alias("bytes")).collect()}  # one row a batch
    rows = done = 0
    for members in bins([(b, sizes.get(b, 0)) for b in known.batch_ids], target_bytes):
        df = layers.read_layer(spark, bronze.path, bronze.partition_by, batch_ids=members, known=known).drop(ledger.BATCH)
        rows += sum(e.rows for e in known.live if e.batch_id in set(members))
        known = sinks.compact_batches(spark, bronze.path, members, df, bronze.partition_by, known)
        done += len(members)
    if not done:
        return Outcome(spec.name, "compact_bronze", "empty")
    sinks.align_table(spark, bronze, known)
    sinks.clear_folded(spark, bronze.path, known)
    return Outcome(spec.name, "compact_bronze", "ok", rows, done)


def bins(sizes: Sequence[tuple[str, int]], most: int) -> list[list[str]]:
    """Names packed into bins of at most ``most``, the largest first and each into the first bin it fits; bins of two and more."""
    packed: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes, key=lambda s: (-s[1], s[0])):
        if size >= most:
            continue
        at = next((i for i, (full, _) in enumerate(packed) if full + size <= most), None)
        if at is None:
            packed.append((size, [name]))
        else:
            packed[at] = (packed[at][0] + size, [*packed[at][1], name])
    order = {name: i for i, (name, _) in enumerate(sizes)}
    return [sorted(names, key=order.get) for _, names in packed if len(names) > 1]


def _unpromoted(spark: SparkSession, spec: DatasetSpec, raw: ledger.State) -> list[str]:
    """Raw batches that bronze has yet to take, and that a new snapshot must leave in place."""
    bronze = spec.bronze
    if bronze is None or bronze.raw_format != "parquet":
        return []
    groups = ledger.pending(raw, ledger.state(spark, bronze.path), ledger.batch_dirs(spark, spec.raw))
    return [entry.batch_id for group in groups for entry in group]


def decoded_messages(spark: SparkSession, spec: DatasetSpec) -> DataFrame:
    """The streaming rows of a message dataset: envelope, payload fields, ingestion day."""
    return shape_messages(messages.message_stream(spark, spec), spec)


def shape_messages(stream: DataFrame, spec: DatasetSpec) -> DataFrame:
    """P6-P9 over any DataFrame, bounded or not, with the seven message columns."""
    rows = payload.decode(payload.envelope(stream), spec.avro_schema, spec.codec)
    return derive.ingestion_day(payload.flatten(rows, spec.avro_schema), spec.partition_by)


def messages_to_raw(spark: SparkSession, spec: DatasetSpec, trigger: Mapping | None = None) -> StreamingQuery:
    """Start the stream from messages to raw.

    Without a trigger it keeps running in micro-batches (T2); ``control.AVAILABLE_NOW`` makes it
    stop when it has caught up.
    """
    name = control.query_name("messages_to_raw", spec.name)
    return sinks.append_stream(decoded_messages(spark, spec), spec.raw, spec.checkpoint, spec.partition_by, trigger, name)


def _catch_up(spark: SparkSession, spec: DatasetSpec) -> Outcome:
    rows = control.rows_until_done(spark, lambda: messages_to_raw(spark, spec, control.AVAILABLE_NOW))
    return Outcome(spec.name, "messages_to_raw", "ok" if rows else "empty", rows)


JOBS: Mapping[str, Callable[[SparkSession, DatasetSpec], Outcome]] = {
    "landing_to_raw": landing_to_raw,
    "raw_to_bronze": raw_to_bronze,
    "rewrite_bronze": rewrite_bronze,
    "compact_bronze": compact_bronze,
    "messages_to_raw": _catch_up,
}

# The configuration key that lists the datasets of each job.
_CONFIG_LISTS = {
    "landing_to_raw": "datasets_to_ingest_to_raw",
    "raw_to_bronze": "datasets_to_promote_to_bronze",
    "rewrite_bronze": "datasets_to_promote_to_bronze",
    "compact_bronze": "datasets_to_promote_to_bronze",
    "messages_to_raw": "active_streaming_pipelines",
}


def names_from_config(config: Mapping, job: str) -> list[str] | None:
    """The datasets a configuration lists for a job; ``None`` lets intake take all file datasets."""
    listed = list(config.get(_CONFIG_LISTS[job]) or ())
    return None if job == "landing_to_raw" and not listed else listed


def run(
    spark: SparkSession, specs: Mapping[str, DatasetSpec], job: str, names: Iterable[str] | None = None, at_once: int = 1
) -> DataFrame:
    """One job over several datasets, each on its own; returns the run report.

    A dataset that fails does not stop the others. If any failed, :class:`RunFailed` is raised
    at the end. ``names=None`` means every dataset of the kind the job is for. ``at_once``
    datasets are worked on side by side, so that small ones do not queue behind a large one.
    """
    with ThreadPoolExecutor(at_once) as pool:
        outcomes = list(pool.map(lambda name: _run_one(spark, specs, job, name), specs if names is None else names))
    if any(o.status == "failed" for o in outcomes):
        raise RunFailed(outcomes)
    return report_df(spark, outcomes)


def run_config(
    spark: SparkSession, config: Mapping, layers_at: Layers, job: str, mode: str = "snapshot", bronze_format: str = "parquet"
) -> DataFrame:
    """J4 from a JSON configuration: the datasets it lists for ``job``, under the given base paths."""
    return run(spark, specs_from_config(config, layers_at, mode, bronze_format), job, names_from_config(config, job))


def report_df(spark: SparkSession, outcomes: Sequence[Outcome]) -> DataFrame:
    return spark.createDataFrame([astuple(o) for o in outcomes], REPORT_SCHEMA)


def _run_one(spark: SparkSession, specs: Mapping[str, DatasetSpec], job: str, name: str) -> Outcome:
    spec = specs.get(name)
    if spec is None:
        return Outcome(name, job, "skipped", error="no configuration for this dataset")
    if job not in ("raw_to_bronze", "rewrite_bronze", "compact_bronze") and (spec.kind == "messages") != (job == "messages_to_raw"):
        return Outcome(name, job, "skipped", error=f"{spec.kind} datasets are not for this job")
    try:
        return JOBS[job](spark, spec)
    except Exception as error:
        log.exception("%s failed for %s", job, name)
        return Outcome(name, job, "failed", error=f"{type(error).__name__}: {error}")


def run_message_pipelines(
    spark: SparkSession, specs: Sequence[DatasetSpec], trigger: Mapping | None = None, timeout: float | None = None
) -> list[str]:
    """T6 and J4 for messages: start every pipeline, wait for them, stop all when one fails."""
    started: list[StreamingQuery] = []
    try:
        for spec in specs:
            started.append(messages_to_raw(spark, spec, trigger))
    except Exception:
        for query in started:
            query.stop()
        raise
    return control.run_streams(spark, started, timeout)
