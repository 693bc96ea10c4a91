"""Files whose columns change over time (H2, H3, H4), matched by name and never by position.

Files with different headers are read in one scan, by position and as text; a table of where each file has
which column, as long as the intake batch has files, puts the cells in place. One more pass infers the types of all
undeclared columns, whatever the number of headers. JSON records are looked at once on their way into a staging
directory: their merged schema is an aggregate over the records as variants.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline import storage
from tierline.functions import derive
from tierline.functions import schema as schemas
from tierline.functions.schema import TimestampPlan

# Looking at a first line is a round trip to the store; a few threads hide its latency.
_THREADS = 32


def _charset(options: Mapping[str, str]) -> str:
    return options.get("encoding", options.get("charset", "UTF-8"))


def _is_header(line: str | None, comment: str | None) -> bool:
    return bool(line and line.strip()) and not (comment and line.startswith(comment))


def header_lines(spark: SparkSession, paths: list[str], options: Mapping[str, str]) -> Iterator[tuple[str, str]]:
    """(path, header) of every file that has one, reading only the start of each.

    The files are those of one intake batch, so their number is bounded by ``max_files_per_trigger``;
    they are looked at in one way, whatever their number and the cluster's size.
    """
    store = storage.Store(spark)

    def first_line(path: str) -> str | None:
        lines = store.text_lines(path, _charset(options), options.get("lineSep"))
        try:
            return next((line for line in lines if _is_header(line, options.get("comment"))), None)
        finally:
            lines.close()

    with ThreadPoolExecutor(_THREADS) as pool:
        yield from ((p, header) for p, header in zip(paths, pool.map(first_line, paths)) if header is not None)


def split_header(header: str, options: Mapping[str, str]) -> list[str]:
    """Column names of a CSV header line, with quotes and the delimiter honoured."""
    if header.count(options.get("quote") or '"') % 2:
        raise ValueError(f"a quoted name in the header spans lines, which is not supported: {header!r}")
    row = next(csv.reader(
        [header.lstrip("﻿")],
        delimiter=options.get("sep", options.get("delimiter", ",")),
        quotechar=options.get("quote") or '"',
        skipinitialspace=options.get("ignoreLeadingWhiteSpace", "false").lower() == "true",
    ))
    names = [name.strip() or f"_c{i}" for i, name in enumerate(row)]
    repeated = sorted({n for n in names if [m.lower() for m in names].count(n.lower()) > 1})
    if repeated:
        raise ValueError(f"header repeats the columns {repeated}: {header!r}")
    return names


def hinted_schema(names: Iterable[str], declared: T.StructType | None, inferred: T.StructType | None = None) -> T.StructType:
    """H2 and H4: declared columns keep their type and spelling; others are inferred, or text."""
    known = {f.name.lower(): f for f in declared} if declared else {}
    guessed = {f.name.lower(): f for f in inferred} if inferred else {}
    return T.StructType([
        known.get(n.lower()) or T.StructField(n, guessed[n.lower()].dataType if n.lower() in guessed else T.StringType())
        for n in names
    ])


def remembered(schema: T.StructType, declared: T.StructType | None, stored: T.StructType | None) -> tuple[T.StructType, dict[str, T.DataType]]:
    """H4: undeclared columns as they were first stored, and those whose new values may not fit that type.

    A column keeps its first type. What cannot be read as that type without loss is read as text, for
    ``keep_types`` to sort out. A struct may gain fields.
    """
    fixed = {n.lower() for n in declared.names} if declared else set()
    first = {f.name.lower(): f for f in stored or () if f.name.lower() not in fixed}
    fields, unsure = [], {}
    for column in schema:
        known = first.get(column.name.lower())
        if known is None:
            fields.append(column)
        elif _fits(column.dataType, known.dataType):
            fields.append(T.StructField(known.name, known.dataType))
        elif (grown := _grown(known.dataType, column.dataType)) is not None:
            fields.append(T.StructField(known.name, grown))
        else:
            fields.append(T.StructField(known.name, T.StringType()))
            unsure[known.name] = known.dataType
    return T.StructType(fields), unsure


def _fits(found: T.DataType, stored: T.DataType) -> bool:
    """Whether every value of type ``found`` is read as ``stored`` without loss."""
    wider = {"int": {"bigint", "double"}, "tinyint": {"int", "bigint", "double"}, "smallint": {"int", "bigint", "double"}}
    return isinstance(stored, T.StringType) or found == stored or stored.simpleString() in wider.get(found.simpleString(), ())


def _grown(stored: T.DataType, found: T.DataType) -> T.DataType | None:
    """``stored`` with the new fields of ``found``, if both are structs and nothing else differs."""
    if not (isinstance(stored, T.StructType) and isinstance(found, T.StructType)):
        return None
    try:
        return schemas.merge([stored, found])
    except schemas.SchemaConflict:
        return None


def keep_types(df: DataFrame, unsure: Mapping[str, T.DataType]) -> DataFrame:
    """Text columns as their stored types; where a value does not fit, its text goes to ``<name>_text``.

    The extra column is there only if some value needs it, which takes a scan of the columns in doubt.
    """
    if not unsure:
        return df
    values, lost = {}, {}
    for name, kind in unsure.items():
        text = F.col(f"`{name}`")
        if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
            values[name], lost[name] = F.from_json(text, kind), text.isNotNull()
        else:
            values[name] = text.try_cast(kind)
            longer = F.length(F.trim(text)) > 10 if isinstance(kind, T.DateType) else F.lit(False)
            lost[name] = text.isNotNull() & (values[name].isNull() | longer)
    counts = df.agg(*[F.count_if(c).alias(f"n{i}") for i, c in enumerate(lost.values())]).first()
    texts = {_text_name(df, name): F.when(c, F.col(f"`{name}`")) for (name, c), n in zip(lost.items(), counts) if n}
    return df.withColumns(texts).withColumns(values)


def _text_name(df: DataFrame, name: str) -> str:
    taken, found = {c.lower() for c in df.columns}, f"{name}_text"
    while found.lower() in taken:
        found += "_"
    return found


def group_by_header(spark: SparkSession, paths: list[str], options: Mapping[str, str]) -> dict[tuple[str, ...], list[str]]:
    """Paths per distinct header; the driver holds one line per path it was given."""
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    names: dict[str, tuple[str, ...]] = {}
    for path, header in header_lines(spark, paths, options):
        if header not in names:
            names[header] = tuple(split_header(header, options))
        groups[names[header]].append(path)
    return groups


def read_evolving(
    spark: SparkSession,
    paths: list[str],
    options: Mapping[str, str],
    plan: TimestampPlan | None,
    evolution: str = "add_new_columns",
    infer_types: bool = False,
    stored: T.StructType | None = None,
) -> DataFrame | None:
    """H3: CSV files with any headers, by column name; ``None`` if no file has a header.

    ``add_new_columns`` keeps every column found. ``none`` keeps the declared ones. Columns that
    are in ``stored`` keep the type they have there.
    """
    declared = plan.schema if plan else None
    options = dict(options)
    if plan and plan.reader_format:
        options["timestampFormat"] = plan.reader_format
    groups = {
        names: [storage.literal(p) for p in members] for names, members in sorted(group_by_header(spark, paths, options).items())
    }
    if not groups:
        return None
    read = _side_by_side if _in_one_scan(groups, options, declared) else _one_by_one
    df = keep_types(*read(spark, groups, options, declared, infer_types, stored))
    if declared is None:
        return df
    df = with_declared(df, declared)
    return df.select(*declared.names, "source_filename") if evolution == "none" else df


def _one_by_one(spark, groups, options, declared, infer_types, stored) -> tuple[DataFrame, dict[str, T.DataType]]:
    """A scan for each header, for what one scan of text by position cannot give; the rows, and the types in doubt."""
    inferred = _inferred(spark, groups, options, declared) if infer_types else None
    parts, unsure = [], {}
    for names, files in groups.items():
        schema = hinted_schema([*names, *_not_in_header(names, files[0], declared, options)], declared, inferred)
        schema, doubtful = remembered(schema, declared, stored)
        unsure |= doubtful
        parts.append(derive.with_source(spark.read.schema(schema).options(**options).csv(files)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), unsure


def _option(options: Mapping[str, str], name: str, default: str) -> str:
    return next((v for k, v in options.items() if k.lower() == name.lower()), default)


def flag(options: Mapping[str, str], name: str, default: bool) -> bool:
    return _option(options, name, str(default)).lower() == "true"


def _directory_keys(path: str, options: Mapping[str, str]) -> tuple[str, ...]:
    """The names of ``name=value`` directories that become columns of a file."""
    return tuple(re.findall(r"/([^/=]+)=[^/]*(?=/)", path.removeprefix(options["basePath"]))) if "basePath" in options else ()


def _in_one_scan(groups, options: Mapping[str, str], declared: T.StructType | None) -> bool:
    """Whether the files can be read side by side as text.

    Rows that are not as their own header says are known only to a scan in that header's schema, so
    keeping, dropping or failing on those takes one scan for each. So do directories that do not match.
    """
    corrupt = _option(options, "columnNameOfCorruptRecord", "_corrupt_record")
    strict = _option(options, "mode", "PERMISSIVE").upper() != "PERMISSIVE" or (declared is not None and corrupt in declared.names)
    keys = {_directory_keys(path, options) for files in groups.values() for path in files}
    inside = {k.lower() for key in keys for k in key} & {n.lower() for names in groups for n in names}
    return len(groups) > 1 and not strict and len(keys) == 1 and not inside


# Options that say what a value means, not how a line is split; and how this library writes a line of cells.
_VALUE_OPTIONS = ("dateformat", "timestampformat", "timestampntzformat", "locale", "nanvalue", "positiveinf", "negativeinf",
                  "enabledatetimeparsingfallback", "preferdate", "timezone")
_CELLS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _cell_line(cells: list[Column]) -> Column:
    return F.to_csv(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cells)]), _CELLS)


def _side_by_side(spark, groups, options, declared, infer_types, stored) -> tuple[DataFrame, dict[str, T.DataType]]:
    """All files in one scan, as text by position, each cell then put where its file's header has it.

    Values that are not text go through Spark's CSV parser once more, by their declared or inferred type, so they
    mean what they mean in a scan by that type.
    """
    spelled: dict[str, str] = {}
    for names in groups:
        for name in names:
            spelled.setdefault(name.lower(), name)
    store, places, paths = storage.Store(spark), [], []
    for names, files in groups.items():
        at = {n.lower(): i for i, n in enumerate(names)}
        places += [[at.get(n, -1) for n in spelled]] * len(files)
        paths += [_comparable(store.qualified(storage.unescaped(path))) for path in files]
    width = max(map(len, groups))
    positions = [f"position {i}" for i in range(width)]
    some_header, some_files = next(iter(groups.items()))
    filled = _not_in_header(some_header, some_files[0], declared, options)
    wide = T.StructType([T.StructField(p, T.StringType()) for p in positions] + [f for f in declared or () if f.name in filled])
    files = [path for members in groups.values() for path in members]
    scan = derive.with_source(spark.read.schema(wide).options(**options).csv(files))
    kept = [c for c in scan.columns if c not in positions]
    known = F.broadcast(spark.createDataFrame(list(zip(paths, places)), "`its path` string, places array<int>"))  # one row a file of the batch
    scan = scan.join(known, F.regexp_replace("source_filename", "^file:/+", "/") == F.col("its path"))
    cells = F.array(*[F.col(f"`{p}`") for p in positions])
    placed = {n: F.get(cells, F.get("places", F.lit(j))) for j, n in enumerate(spelled)}
    meaning = {k: v for k, v in options.items() if k.lower() in _VALUE_OPTIONS}
    hinted = {n.lower() for n in declared.names} if declared else set()
    free = [n for n in spelled if n not in hinted] if infer_types else []
    inferred = _inferred_at_once(scan, {spelled[n]: placed[n] for n in free}, meaning) if free else None
    schema, unsure = remembered(hinted_schema(spelled.values(), declared, inferred), declared, stored)
    typed = [(n, f) for n, f in zip(spelled, schema) if not isinstance(f.dataType, T.StringType)]
    if typed:
        parsed = T.StructType([T.StructField(f"c{i}", f.dataType) for i, (_, f) in enumerate(typed)])
        scan = scan.withColumn("values of types", F.from_csv(_cell_line([placed[n] for n, _ in typed]), parsed.toDDL(), {**_CELLS, **meaning}))
        placed |= {n: F.col(f"`values of types`.c{i}") for i, (n, _) in enumerate(typed)}
    return scan.select(*[placed[n].alias(f.name) for n, f in zip(spelled, schema)], *[F.col(f"`{c}`") for c in kept]), unsure


def _comparable(uri: str) -> str:
    return re.sub("^file:/+", "/", uri)


def _inferred_at_once(scan: DataFrame, columns: Mapping[str, Column], meaning: Mapping[str, str]) -> T.StructType:
    """H4: the types of all these columns by Spark's own inference over their cells; one pass."""
    lines = scan.select(_cell_line(list(columns.values())).alias("value"))
    encoder = scan.sparkSession._jvm.org.apache.spark.sql.Encoders.STRING()
    reader = scan.sparkSession.read.options(**{**_CELLS, **meaning, "inferSchema": "true", "header": "false"})
    found = DataFrame(reader._jreader.csv(getattr(lines._jdf, "as")(encoder)), scan.sparkSession).schema
    kinds = [f.dataType for f in found] + [T.StringType()] * (len(columns) - len(found))
    return T.StructType([T.StructField(n, k) for n, k in zip(columns, kinds)])


# What a JSON reader can be told that lines of text, parsed one by one, do not give.
_WHOLE_FILE_OPTIONS = {"multiline", "encoding", "charset", "mode", "samplingratio", "prefersdecimal", "infertimestamp", "dropfieldifallnull"}


def json_once(spark: SparkSession, files: list[str], options: Mapping[str, str], staging: str, as_text: bool):
    """JSON lines brought to ``staging`` in one scan, with the schema that fits them all and that of their variants.

    The schema is folded over the records as variants while they are written. ``None`` if it cannot say what
    Spark's inference would: records that are not objects, or not plain JSON, and whole numbers past 64 bits.
    """
    if _WHOLE_FILE_OPTIONS & {k.lower() for k in options}:
        return None
    text = {k: v for k, v in options.items() if k.lower() in ("basepath", "linesep", "ignoremissingfiles", "ignorecorruptfiles")}
    lines = derive.with_source(spark.read.options(**text).text(files)).where(F.trim("value") != "")
    if "value" in _directory_keys(files[0], options):
        return None
    record, seen = F.try_parse_json("value"), Observation()
    folded = F.expr("schema_of_variant_agg(try_parse_json(value))")
    observed = lines.observe(seen, folded.alias("schema"), F.count_if(record.isNull()).alias("refused"), F.count("value").alias("rows"))
    observed.write.mode("overwrite").parquet(staging)
    found = seen.get
    if found.get("refused") or not (found.get("schema") or "").startswith("OBJECT<"):
        return None
    variants = _variant_type(found["schema"])
    schema = _plain_type(variants, as_text)
    if schema is _UNCLEAR or schema is None:
        return None
    return spark.read.schema(lines.schema).parquet(staging), schema, variants


def as_written(kind: T.DataType, found: T.DataType) -> bool:
    """Whether values of a column that are to be text are parsed from a line as they are in a file.

    Only Spark's file reader keeps the digits of fractions and the spaces in objects.
    """
    if isinstance(kind, T.StructType) and isinstance(found, T.StructType):
        inner = {f.name.lower(): f.dataType for f in found}
        return all(f.name.lower() not in inner or as_written(f.dataType, inner[f.name.lower()]) for f in kind)
    if isinstance(kind, T.ArrayType) and isinstance(found, T.ArrayType):
        return as_written(kind.elementType, found.elementType)
    return not isinstance(kind, T.StringType) or isinstance(found, (T.StringType, T.LongType, T.BooleanType, T.NullType))


def _variant_type(text: str) -> T.DataType:
    """A schema of variants as Spark writes it; names in backquotes are left alone."""
    parts = re.split(r"(`(?:[^`]|``)*`)", text)
    return T.DataType.fromDDL("".join(p if p.startswith("`") else p.replace("OBJECT<", "STRUCT<") for p in parts))


_UNCLEAR = object()


def _plain_type(kind: T.DataType, as_text: bool):
    """The type Spark's JSON inference gives such values; ``None`` for objects without fields, which it leaves out."""
    if isinstance(kind, T.StructType):
        fields = [(f.name, _plain_type(f.dataType, as_text)) for f in sorted(kind, key=lambda f: f.name)]
        if any(k is _UNCLEAR for _, k in fields):
            return _UNCLEAR
        return T.StructType([T.StructField(n, k) for n, k in fields if k is not None]) if any(k is not None for _, k in fields) else None
    if isinstance(kind, T.ArrayType):
        inner = _plain_type(kind.elementType, as_text)
        return inner if inner is _UNCLEAR or inner is None else T.ArrayType(inner)
    if as_text or isinstance(kind, (T.NullType, T.VariantType, T.StringType)):
        return T.StringType()
    if isinstance(kind, T.DecimalType):
        return _UNCLEAR if kind.scale == 0 and kind.precision > 18 else T.DoubleType()
    return {T.FloatType: T.DoubleType(), T.DoubleType: T.DoubleType(), T.BooleanType: T.BooleanType()}.get(type(kind), T.LongType())


def _not_in_header(names: Iterable[str], path: str, declared: T.StructType | None, options: Mapping[str, str]) -> list[str]:
    """Declared columns that the reader itself fills: the malformed row, and ``name=value`` directories."""
    present = {n.lower() for n in names}
    corrupt = options.get("columnNameOfCorruptRecord", "_corrupt_record")
    filled = [n for n in (declared.names if declared else ()) if n == corrupt or ("basePath" in options and f"/{n}=" in path)]
    return [n for n in filled if n.lower() not in present]


def _inferred(spark: SparkSession, groups, options: Mapping[str, str], declared: T.StructType | None) -> T.StructType:
    """Types of the undeclared columns, one per column whatever the number of headers it is in."""
    hinted = {n.lower() for n in declared.names} if declared else set()
    seen: dict[str, list[T.StructField]] = defaultdict(list)
    for names, files in groups.items():
        if {n.lower() for n in names} <= hinted:
            continue
        found = spark.read.options(**options, inferSchema="true").csv(files).schema
        for name, column in zip(names, found):
            seen[name.lower()].append(T.StructField(name, column.dataType))
    return T.StructType([T.StructField(fields[0].name, _common_type([f.dataType for f in fields])) for fields in seen.values()])


def _common_type(kinds: list[T.DataType]) -> T.DataType:
    """A type that holds every value as it was written."""
    if all(k == kinds[0] for k in kinds):
        return kinds[0]
    if all(isinstance(k, (T.IntegerType, T.LongType)) for k in kinds):
        return T.LongType()
    if all(isinstance(k, (T.IntegerType, T.DoubleType)) for k in kinds):
        return T.DoubleType()
    return T.StringType()


def with_declared(df: DataFrame, declared: T.StructType, others: bool = True) -> DataFrame:
    """Declared columns first and in declared order, null where no file has them; without ``others`` only the source besides."""
    present = {c.lower(): c for c in df.columns}
    columns = [
        F.col(f"`{present[f.name.lower()]}`").alias(f.name) if f.name.lower() in present
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in declared
    ]
    names = {f.name.lower() for f in declared}
    return df.select(*columns, *[F.col(f"`{c}`") for c in df.columns if c.lower() not in names and (others or c == "source_filename")])
