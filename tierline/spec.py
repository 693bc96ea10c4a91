"""Dataset declarations: what lands where, and how each layer is laid out.

A :class:`DatasetSpec` carries full paths and is validated once, so the operators never look
at configuration again. :func:`specs_from_config` builds specs from a JSON configuration.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from types import MappingProxyType

log = logging.getLogger(__name__)

# Landing formats by their lower-case configuration name.
FORMATS = {
    "csv": "csv",
    "json": "json",
    "parquet": "parquet",
    "avro": "avro",
    "text": "text",
    "binaryfile": "binaryFile",
    "image": "image",
}

# Configuration spelling of the evolution modes.
EVOLUTION_MODES = {"none": "none", "addNewColumns": "add_new_columns", "add_new_columns": "add_new_columns"}


class SpecError(ValueError):
    """A dataset declaration that cannot be honoured."""


@dataclass(frozen=True)
class Field:
    """One declared column; ``format`` is the pattern of a timestamp held as text."""

    name: str
    type: str = "string"
    format: str | None = None


@dataclass(frozen=True)
class BronzeSpec:
    """How a raw dataset is promoted: derivation, layout, registration.

    Promotion always takes what is new in raw. With ``evolution="none"`` columns that bronze does
    not have yet are left behind; otherwise they join, unless ``merge_schema`` is off, which
    makes them an error.
    """

    path: str
    table: str | None = None
    database: str = "default"
    format: str = "parquet"
    raw_format: str = "parquet"
    raw_options: Mapping[str, str] = field(default_factory=dict)
    source_column: str | None = None
    source_unit: str = "seconds"
    year_column: str | None = None
    month_column: str | None = None
    partition_by: tuple[str, ...] = ()
    merge_schema: bool = True
    evolution: str = "add_new_columns"
    optimize_write: bool = False
    checkpoint: str | None = None

    def __post_init__(self):
        if self.evolution not in EVOLUTION_MODES:
            raise SpecError(f"unknown bronze evolution mode {self.evolution!r}")
        object.__setattr__(self, "evolution", EVOLUTION_MODES[self.evolution])
        if self.format not in ("parquet", "delta"):
            raise SpecError(f"bronze format must be parquet or delta, not {self.format!r}")
        if self.raw_format not in ("parquet", "delta"):
            raise SpecError(f"raw_source_format must be parquet or delta, not {self.raw_format!r}")
        _freeze(self, "raw_options")

    @property
    def full_table(self) -> str | None:
        return f"{self.database}.{self.table}" if self.table else None


@dataclass(frozen=True)
class DatasetSpec:
    """One dataset across its layers.

    ``kind`` is ``files`` or ``messages``. ``mode`` is ``snapshot`` (each run replaces raw with
    what is in landing) or ``append`` (each run adds the files that are new).
    """

    name: str
    raw: str
    landing: str | None = None
    archive: str | None = None
    checkpoint: str | None = None
    kind: str = "files"
    format: str = "csv"
    mode: str = "snapshot"
    fields: tuple[Field, ...] = ()
    reader_options: Mapping[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    date_source: str | None = None
    date_unit: str = "seconds"
    evolution: str = "none"
    infer_types: bool = False
    optimize_write: bool = True
    max_files_per_trigger: int = 1000
    max_file_age: str = "365d"
    message_format: str = "kafka"
    message_options: Mapping[str, str] = field(default_factory=dict)
    avro_schema: str | None = None
    codec: str = "avro"
    bronze: BronzeSpec | None = None

    def __post_init__(self):
        if self.kind not in ("files", "messages"):
            raise SpecError(f"{self.name}: kind must be files or messages, not {self.kind!r}")
        if self.mode not in ("snapshot", "append"):
            raise SpecError(f"{self.name}: mode must be snapshot or append, not {self.mode!r}")
        if self.kind == "files":
            if not self.landing:
                raise SpecError(f"{self.name}: a landing path is required")
            if self.format.lower() not in FORMATS:
                raise SpecError(f"{self.name}: unknown format {self.format!r}; known: {sorted(FORMATS.values())}")
            object.__setattr__(self, "format", FORMATS[self.format.lower()])
            nested = self.archive and f"{self.archive.rstrip('/')}/".startswith(f"{self.landing.rstrip('/')}/")
            if nested and str(self.reader_options.get("recursiveFileLookup", "false")).lower() == "true":
                raise SpecError(f"{self.name}: the archive lies inside a landing that is read recursively")
        elif not self.avro_schema:
            raise SpecError(f"{self.name}: value_avro_schema_string is required to decode messages")
        if self.codec not in ("avro", "json"):
            raise SpecError(f"{self.name}: codec must be avro or json, not {self.codec!r}")
        if self.evolution not in EVOLUTION_MODES:
            raise SpecError(f"{self.name}: unknown evolution mode {self.evolution!r}")
        object.__setattr__(self, "evolution", EVOLUTION_MODES[self.evolution])
        names = [f.name for f in self.fields]
        if any(not n for n in names):
            raise SpecError(f"{self.name}: a declared field has no name")
        if len(set(names)) != len(names):
            raise SpecError(f"{self.name}: declared fields repeat a name: {names}")
        _freeze(self, "reader_options")
        _freeze(self, "message_options")

    def with_(self, **changes) -> DatasetSpec:
        """A copy with some attributes replaced."""
        return replace(self, **changes)


@dataclass(frozen=True)
class Layers:
    """Base directories that configuration subpaths are relative to."""

    landing: str
    raw: str
    bronze: str
    archive: str
    checkpoints: str


# The configuration keys that are understood, per section.
_DATASET_KEYS = {
    "type", "source_subpath", "raw_target_subpath", "archive_subpath", "schema_config", "partition_config",
    "reader_options", "autoloader_schema_evolution_mode", "autoloader_infer_column_types", "kafka_options",
    "value_avro_schema_string", "raw_target_parquet_files_subpath", "raw_stream_checkpoint_subpath",
    "raw_stream_partition_by", "bronze_config", "mode", "codec", "message_format", "optimize_write",
    "max_files_per_trigger", "max_file_age", "date_unit",
}
_BRONZE_KEYS = {
    "enabled", "raw_source_format", "raw_reader_options", "autoloader_for_raw_source",
    "autoloader_raw_schema_evolution_mode", "bronze_target_subpath_delta", "bronze_database_name",
    "bronze_table_name", "bronze_partition_columns_derivation", "partition_by_bronze", "merge_schema_on_write",
    "overwrite_schema_on_write", "optimize_write", "bronze_stream_checkpoint_subpath", "format", "source_unit",
}
_MESSAGE_TYPE_PREFIX = "kafka_"


def is_message_config(cfg: Mapping) -> bool:
    """Whether a dataset section describes a message pipeline rather than files."""
    return str(cfg.get("type", "")).startswith(_MESSAGE_TYPE_PREFIX)


def load_config(path: str) -> dict:
    """The JSON configuration at ``path``."""
    with open(path, encoding="utf-8") as handle:
        return json.load(handle)


def from_json(name: str, cfg: Mapping, layers: Layers, mode: str = "snapshot", bronze_format: str = "parquet") -> DatasetSpec:
    """The spec of one ``dataset_configs`` entry; unknown keys and types are refused."""
    _known(name, cfg, _DATASET_KEYS)
    flat = name.replace("/", "_").replace("\\", "_")
    bronze = _bronze_from_json(name, flat, cfg.get("bronze_config"), layers, bronze_format)
    if is_message_config(cfg):
        return DatasetSpec(
            name=name,
            kind="messages",
            raw=_under(layers.raw, cfg.get("raw_target_parquet_files_subpath", flat)),
            checkpoint=_under(layers.checkpoints, cfg.get("raw_stream_checkpoint_subpath", f"{flat}/messages_to_raw")),
            message_format=cfg.get("message_format", "kafka"),
            message_options=cfg.get("kafka_options", {}),
            avro_schema=cfg.get("value_avro_schema_string"),
            codec=cfg.get("codec", "avro"),
            partition_by=tuple(cfg.get("raw_stream_partition_by") or ()),
            bronze=bronze,
        )
    partition = cfg.get("partition_config") or {}
    _known(f"{name}.partition_config", partition, {"columns_to_partition_by", "derive_date_parts_from_column"})
    return DatasetSpec(
        name=name,
        landing=_under(layers.landing, cfg.get("source_subpath", "")),
        raw=_under(layers.raw, cfg.get("raw_target_subpath", "")),
        archive=_under(layers.archive, cfg.get("archive_subpath", flat)),
        checkpoint=_under(layers.checkpoints, f"{flat}/landing_to_raw"),
        format=cfg.get("type", ""),
        mode=cfg.get("mode", mode),
        fields=_fields(name, cfg.get("schema_config")),
        reader_options=cfg.get("reader_options", {}),
        partition_by=tuple(partition.get("columns_to_partition_by") or ()),
        date_source=partition.get("derive_date_parts_from_column"),
        date_unit=cfg.get("date_unit", "seconds"),
        evolution=cfg.get("autoloader_schema_evolution_mode", "addNewColumns"),
        infer_types=_flag(cfg.get("autoloader_infer_column_types", False)),
        optimize_write=_flag(cfg.get("optimize_write", True)),
        max_files_per_trigger=int(cfg.get("max_files_per_trigger", 1000)),
        max_file_age=cfg.get("max_file_age", "365d"),
        bronze=bronze,
    )


def specs_from_config(config: Mapping, layers: Layers, mode: str = "snapshot", bronze_format: str = "parquet") -> dict[str, DatasetSpec]:
    """Every dataset of a configuration, by name."""
    return {
        name: from_json(name, cfg, layers, mode, bronze_format)
        for name, cfg in (config.get("dataset_configs") or {}).items()
    }


def _bronze_from_json(name, flat, cfg, layers, bronze_format) -> BronzeSpec | None:
    if not cfg:
        return None
    _known(f"{name}.bronze_config", cfg, _BRONZE_KEYS)
    if not _flag(cfg.get("enabled", False)):
        return None
    for key in ("overwrite_schema_on_write", "autoloader_for_raw_source"):
        if key in cfg:
            log.info("%s: %s has no effect; promotion always appends what is new", name, key)
    derivation = cfg.get("bronze_partition_columns_derivation") or {}
    _known(f"{name}.bronze_partition_columns_derivation", derivation, {"source_column", "year_col_name", "month_col_name"})
    return BronzeSpec(
        path=_under(layers.bronze, cfg.get("bronze_target_subpath_delta", "")),
        table=cfg.get("bronze_table_name", f"{flat}_bronze"),
        database=cfg.get("bronze_database_name", "default"),
        format=cfg.get("format", bronze_format),
        raw_format=cfg.get("raw_source_format", "parquet").lower(),
        raw_options=cfg.get("raw_reader_options", {}),
        source_column=derivation.get("source_column"),
        source_unit=cfg.get("source_unit", "seconds"),
        year_column=derivation.get("year_col_name"),
        month_column=derivation.get("month_col_name"),
        partition_by=tuple(cfg.get("partition_by_bronze") or ()),
        merge_schema=_flag(cfg.get("merge_schema_on_write", True)),
        optimize_write=_flag(cfg.get("optimize_write", False)),
        evolution=cfg.get("autoloader_raw_schema_evolution_mode", "addNewColumns"),
        checkpoint=_under(layers.checkpoints, cfg.get("bronze_stream_checkpoint_subpath", f"{flat}/raw_to_bronze")),
    )


def _fields(name, schema_config) -> tuple[Field, ...]:
    if not schema_config:
        return ()
    fields = []
    for entry in schema_config.get("fields") or ():
        _known(f"{name}.schema_config", entry, {"name", "type", "format"})
        fields.append(Field(entry.get("name", ""), entry.get("type", "string"), entry.get("format")))
    return tuple(fields)


def _known(where, cfg, keys) -> None:
    unknown = sorted(set(cfg) - keys)
    if unknown:
        raise SpecError(f"{where}: unknown configuration keys {unknown}")


def _under(base: str, subpath: str) -> str:
    return "/".join(part for part in (base.rstrip("/"), subpath.strip("/")) if part)


def _flag(value) -> bool:
    return value.strip().lower() == "true" if isinstance(value, str) else bool(value)


def _freeze(spec, attribute) -> None:
    object.__setattr__(spec, attribute, MappingProxyType({k: str(v) for k, v in getattr(spec, attribute).items()}))
