"""Landing scans: one reader for every format (S1-S7) and the stream of newly landed files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline import storage
from tierline.functions import derive
from tierline.functions import schema as schemas
from tierline.functions.schema import TimestampPlan
from tierline.sources import avro_files, evolve
from tierline.spec import DatasetSpec

MANIFEST_COLUMNS = ("path", "length", "modificationTime")

# The columns of Spark's binaryFile source.
_BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"

# Options that choose files rather than parse them.
_LISTING_OPTIONS = ("recursiveFileLookup", "pathGlobFilter", "modifiedBefore", "modifiedAfter")


def csv_options(options: Mapping[str, str]) -> dict[str, str]:
    """H8: ``delimiter`` is ``sep``; a header and a comma are assumed."""
    normal = {k: v for k, v in options.items() if k != "delimiter"}
    normal.setdefault("sep", options.get("delimiter", ","))
    normal.setdefault("header", "true")
    return normal


def landing_files(spark: SparkSession, spec: DatasetSpec) -> DataFrame:
    """What lies in landing when the result is evaluated: path, length, modificationTime; file contents are not read."""
    return storage.listing(spark, spec.landing, _listing_options(spec))


def _listing_options(spec: DatasetSpec) -> dict[str, str]:
    return {k: spec.reader_options[k] for k in _LISTING_OPTIONS if k in spec.reader_options}


def stream_files(spark: SparkSession, spec: DatasetSpec) -> DataFrame:
    """The manifest of newly landed files as a stream, in batches of bounded size.

    Each micro-batch is a list of files that ``read_files`` then reads with full knowledge of
    their headers. ``max_file_age`` keeps files with an old modification time from being
    ignored; lowering it bounds how many names the checkpoint has to remember.
    """
    options = _listing_options(spec)
    stream = (
        spark.readStream.format("binaryFile")
        .schema(_BINARY_FILE_SCHEMA)
        .options(**options)
        .option("maxFilesPerTrigger", spec.max_files_per_trigger)
        .option("maxFileAge", spec.max_file_age)
        .option("ignoreMissingFiles", "true")
    )
    return stream.load(spec.landing).select(*MANIFEST_COLUMNS)


def read_files(
    spark: SparkSession, spec: DatasetSpec, paths: list[str] | None = None, stored: T.StructType | None = None,
    staging: str | None = None,
) -> DataFrame | None:
    """Rows of the given landing files, or of all that lie there now, with their source.

    Undeclared columns of CSV and JSON files that are in ``stored`` keep the type they have there.
    With ``staging``, a directory of the caller's to remove when the rows are used, evolving JSON files are read once.

    Returns ``None`` when there is nothing to read and no declared schema to describe it.
    """
    if paths is None:
        paths = [r.path for r in landing_files(spark, spec).where("length > 0").select("path").toLocalIterator()]
    stored = T.StructType([f for f in stored if f.name not in spec.partition_by]) if stored is not None else None
    options = {k: v for k, v in spec.reader_options.items() if k not in _LISTING_OPTIONS}
    if spec.reader_options.get("recursiveFileLookup", "false").lower() != "true":
        options.setdefault("basePath", spec.landing)  # name=value directories in landing are columns
    if spec.format == "csv":
        plan = schemas.timestamp_formats(spec.fields, options)
        df = _read_csv(spark, spec, paths, csv_options(options), plan, stored) if paths else None
    elif spec.format == "json":
        plan = _json_plan(spec, options)
        df = _read_json(spark, spec, paths, options, plan, stored, staging) if paths else None
    else:
        plan = _plain_plan(spec)
        df = _read_format(spark, spec, paths, options) if paths else None
    if df is None:
        if plan is None:
            return None
        df = spark.createDataFrame([], plan.schema.add("source_filename", "string"))
    for name, fmt in (plan.parse_after if plan else {}).items():
        df = derive.ensure_timestamp(df, name, fmt=fmt)
    return df


def _read_csv(spark, spec, paths, options, plan: TimestampPlan | None, stored) -> DataFrame | None:
    if options["header"].lower() == "true":
        return evolve.read_evolving(spark, paths, options, plan, spec.evolution, spec.infer_types, stored)
    if plan and plan.reader_format:
        options["timestampFormat"] = plan.reader_format
    reader = spark.read.options(**options)
    reader = reader.schema(plan.schema) if plan else reader.option("inferSchema", str(spec.infer_types).lower())
    return derive.with_source(reader.csv([storage.literal(p) for p in paths]))


def _json_plan(spec: DatasetSpec, options) -> TimestampPlan | None:
    """JSON timestamps follow Spark's rules unless a field or the options give a pattern."""
    plan = schemas.timestamp_formats(spec.fields, options)
    if plan is None or "timestampFormat" in options:
        return plan
    given = {f.name: f.format for f in spec.fields if f.format and f.name in plan.schema.names}
    as_text = [T.StructField(f.name, T.StringType()) if f.name in given else f for f in schemas.from_fields(spec.fields)]
    return TimestampPlan(T.StructType(as_text), None, given)


def _read_json(spark, spec, paths, options, plan: TimestampPlan | None, stored, staging) -> DataFrame:
    files = [storage.literal(p) for p in paths]
    declared = plan.schema if plan else None
    if declared is not None and spec.evolution == "none":
        return derive.with_source(spark.read.schema(declared).options(**options).json(files))
    # New fields can only be found by looking at every record, as Spark's own inference does.
    as_text = not spec.infer_types and declared is not None
    once = evolve.json_once(spark, files, options, staging, evolve.flag(options, "primitivesAsString", as_text)) if staging else None
    if once:
        lines, inferred, variants = once
        given = [c for c in lines.columns if c != "value"]  # the source, and name=value directories
        names = [n for n in inferred.names if n.lower() not in {c.lower() for c in given}]
        names += [c for c in given if c != "source_filename"]
    else:
        inferred = spark.read.options(**{"primitivesAsString": str(as_text).lower(), **options}).json(files).schema
        names = inferred.names
    schema, unsure = evolve.remembered(evolve.hinted_schema(names, declared, inferred), declared, stored)
    if once and evolve.as_written(schema, variants):
        record = F.from_json("value", T.StructType([f for f in schema if f.name not in given]), dict(options)).alias("record")
        df = lines.select(record, *given).select("record.*", *[F.col(f"`{c}`") for c in given])
    else:
        df = derive.with_source(spark.read.schema(schema).options(**options).json(files))
    df = evolve.keep_types(df, unsure)
    return evolve.with_declared(df, declared) if declared is not None else df


def _plain_plan(spec: DatasetSpec) -> TimestampPlan | None:
    schema = schemas.from_fields(spec.fields) if spec.format in ("parquet", "avro") else None
    return TimestampPlan(schema, None, {}) if schema is not None else None


def _read_format(spark, spec, paths, options) -> DataFrame:
    files = [storage.literal(p) for p in paths]
    declared = schemas.from_fields(spec.fields) if spec.format in ("parquet", "avro") else None
    if spec.format == "avro" and not storage.has_source(spark, "avro"):
        df = avro_files.read(spark, paths)
        return evolve.with_declared(_cast_declared(df, declared), declared, spec.evolution != "none") if declared is not None else df
    reader = spark.read.format(spec.format).options(**options)
    if declared is not None and spec.evolution == "none":
        reader = reader.schema(declared)
    elif spec.format == "parquet":
        reader = reader.option("mergeSchema", "true")
    df = derive.with_source(reader.load(files))
    if declared is None or spec.evolution == "none":
        return df
    return evolve.with_declared(_cast_declared(df, declared), declared)


def _cast_declared(df: DataFrame, declared: T.StructType) -> DataFrame:
    cast = {
        f.name: F.col(f"`{f.name}`").try_cast(f.dataType)
        for f in declared
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType
    }
    return df.withColumns(cast) if cast else df
