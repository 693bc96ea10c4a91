"""Configuration to specs."""

import pytest

from tierline import Layers, from_json, jobs, specs_from_config
from tierline.spec import SpecError

LAYERS = Layers("/l", "/r/", "/b", "/a", "/c")

CONFIG = {
    "datasets_to_ingest_to_raw": ["sales"],
    "datasets_to_promote_to_bronze": [],
    "dataset_configs": {
        "sales": {
            "type": "csv", "source_subpath": "sales/", "raw_target_subpath": "sales_raw/", "archive_subpath": "old/",
            "schema_config": {"fields": [{"name": "order_id", "type": "string"}, {"name": "order_date", "type": "timestamp", "format": "yyyy"}]},
            "partition_config": {"columns_to_partition_by": ["year"], "derive_date_parts_from_column": "order_date"},
            "reader_options": {"header": "true", "delimiter": ","},
            "autoloader_schema_evolution_mode": "addNewColumns",
            "bronze_config": {
                "enabled": True, "raw_source_format": "parquet", "bronze_target_subpath_delta": "sales_b/", "bronze_database_name": "db",
                "bronze_partition_columns_derivation": {"source_column": "order_date", "year_col_name": "ey", "month_col_name": "em"},
                "partition_by_bronze": ["ey", "em"], "overwrite_schema_on_write": True, "optimize_write": "true",
            },
        },
        "telemetry": {
            "type": "kafka_avro_payload_to_raw_parquet_files", "kafka_options": {"subscribe": "t"},
            "value_avro_schema_string": '{"type":"record","name":"r","fields":[{"name":"a","type":"int"}]}',
            "raw_target_parquet_files_subpath": "tel/", "raw_stream_checkpoint_subpath": "tel_cp/",
            "raw_stream_partition_by": ["ingestion_date", "kafka_topic"], "bronze_config": {"enabled": False},
        },
    },
}


def test_specs_from_config():
    specs = specs_from_config(CONFIG, LAYERS)
    sales, telemetry = specs["sales"], specs["telemetry"]
    assert (sales.landing, sales.raw, sales.archive) == ("/l/sales", "/r/sales_raw", "/a/old")
    assert sales.evolution == "add_new_columns" and sales.partition_by == ("year",) and sales.date_source == "order_date"
    assert sales.bronze.full_table == "db.sales_bronze" and sales.bronze.path == "/b/sales_b"
    assert (sales.bronze.year_column, sales.bronze.month_column, sales.bronze.optimize_write) == ("ey", "em", True)
    assert (telemetry.kind, telemetry.raw, telemetry.checkpoint) == ("messages", "/r/tel", "/c/tel_cp")
    assert telemetry.bronze is None and telemetry.codec == "avro"
    assert jobs.names_from_config(CONFIG, "landing_to_raw") == ["sales"]
    assert jobs.names_from_config(CONFIG, "raw_to_bronze") == []
    assert jobs.names_from_config({}, "landing_to_raw") is None


def test_options_cannot_be_changed():
    spec = from_json("sales", CONFIG["dataset_configs"]["sales"], LAYERS)
    with pytest.raises(TypeError):
        spec.reader_options["timestampFormat"] = "x"
    with pytest.raises(AttributeError):
        spec.raw = "elsewhere"


@pytest.mark.parametrize("change", [
    {"type": "xlsx"}, {"surprise": 1}, {"autoloader_schema_evolution_mode": "sometimes"},
    {"schema_config": {"fields": [{"type": "string"}]}}, {"mode": "whenever"},
    {"schema_config": {"fields": [{"name": "a"}, {"name": "a"}]}},
])
def test_bad_configuration_is_refused(change):
    with pytest.raises(SpecError):
        from_json("sales", {**CONFIG["dataset_configs"]["sales"], **change}, LAYERS)


def test_archive_inside_a_recursive_landing_is_refused():
    spec = from_json("sales", CONFIG["dataset_configs"]["sales"], LAYERS).with_(archive="/l/sales/done")
    with pytest.raises(SpecError, match="recursively"):
        spec.with_(reader_options={"recursiveFileLookup": "true"})


def test_binary_file_type_is_reachable():
    assert from_json("b", {"type": "binaryFile", "source_subpath": "x"}, LAYERS).format == "binaryFile"
    with pytest.raises(SpecError):
        from_json("m", {"type": "kafka_x"}, LAYERS)
