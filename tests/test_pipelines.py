"""Raw -> bronze, messages, reports and what survives a crash."""

import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tierline import BronzeSpec, DatasetSpec, Field, fixtures, inspect, jobs, ledger, listing, sinks, sources, storage
from tierline.functions import schema as schemas
from tierline.plans.jobs import RunFailed
from tierline.sources import layers
from tierline.streaming import control

from .conftest import DATA, rows

FIELDS = (Field("order_id"), Field("quantity", "integer"), Field("order_date", "timestamp", "yyyy-MM-dd HH:mm:ss"))
HEAD = "order_id,quantity,order_date\n"


def make(place, table=None, **changes):
    bronze = BronzeSpec(
        path=place("bronze"), table=table, database="tier_db", source_column="order_date", year_column="event_year",
        month_column="event_month", partition_by=("event_year", "event_month"), checkpoint=place("bronze_checkpoint"),
        optimize_write=True,
    )
    return DatasetSpec(
        name="sales", landing=place("landing"), raw=place("raw"), archive=place("archive"), checkpoint=place("checkpoint"),
        fields=FIELDS, partition_by=("year", "month"), date_source="order_date", mode="append", evolution="add_new_columns",
        bronze=bronze,
    ).with_(**changes)


def both(spark, spec):
    return jobs.landing_to_raw(spark, spec), jobs.raw_to_bronze(spark, spec)


def test_promotion_adds_each_raw_batch_once(spark, place, put):
    spec = make(place)
    put("landing/a.csv", HEAD + "a,1,2024-01-05 00:00:00\nb,2,2024-02-05 00:00:00\n")
    _, first = both(spark, spec)
    assert (first.status, first.rows) == ("ok", 2)
    assert jobs.raw_to_bronze(spark, spec).status == "empty"
    put("landing/c.csv", "order_id,quantity,order_date,promo_code\nc,3,bad date,P\n")
    _, second = both(spark, spec)
    assert second.rows == 1
    bronze = sources.read_bronze(spark, spec)
    assert rows(bronze, "order_id", "quantity", "promo_code", "event_year", "event_month") == [
        ("a", 1, None, 2024, 1), ("b", 2, None, 2024, 2), ("c", 3, "P", None, None),
    ]
    history = inspect.history(spark, spec.bronze.path).collect()
    assert [(h.version, h.operation, h.operationMetrics["rows"]) for h in history] == [(1, "append", "1"), (0, "append", "2")]


def test_bronze_with_a_fixed_schema_leaves_new_columns_behind(spark, place, put):
    spec = make(place)
    spec = spec.with_(bronze=replace(spec.bronze, evolution="none"))
    put("landing/a.csv", HEAD + "a,1,2024-01-05 00:00:00\n")
    both(spark, spec)
    put("landing/b.csv", "order_id,order_date,promo_code\nb,2024-02-05 00:00:00,P\n")
    both(spark, spec)
    assert "promo_code" in sources.read_raw(spark, spec).columns
    bronze = sources.read_bronze(spark, spec)
    assert "promo_code" not in bronze.columns and bronze.count() == 2


def test_several_pending_batches_go_in_one_job(spark, place, put):
    spec = make(place, max_files_per_trigger=1)
    for i in range(3):
        put(f"landing/{i}.csv", HEAD + f"{i},1,2024-01-05 00:00:00\n")
    raw, bronze = both(spark, spec)
    assert (raw.rows, bronze.rows) == (3, 3)
    first = ledger.state(spark, spec.raw).batch_ids[0]
    assert ledger.state(spark, spec.bronze.path).batch_ids == (first,)


def test_promotion_starts_over_when_raw_was_made_anew(spark, place, put):
    spec = make(place)
    put("landing/a.csv", HEAD + "a,1,2024-01-05 00:00:00\n")
    both(spark, spec)
    put("landing2/b.csv", HEAD + "b,1,2024-01-05 00:00:00\n")
    other = spec.with_(landing=place("landing2"), raw=place("raw2"), checkpoint=place("checkpoint2"))
    assert both(spark, other)[1].rows == 1
    assert rows(sources.read_bronze(spark, spec), "order_id") == [("a",), ("b",)]


def test_a_hot_directory_is_written_by_several_tasks(spark, place):
    """A month with most of the rows is split; cold months stay one file each."""
    df = spark.range(400_000).selectExpr("id", "uuid() as text", "case when id % 100 < 90 then 1 else 2 + id % 7 end as month")
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "2m")
    try:
        sinks.append_batch(df, place("layer"), "one", ["month"])
    finally:
        spark.conf.set(advisory, before)
    base = ledger.batch_path(place("layer"), "one")
    files = {d: len([f for f in os.listdir(f"{base}/{d}") if f.endswith(".parquet")]) for d in os.listdir(base) if d.startswith("month=")}
    assert files["month=1"] >= 4
    assert max(n for d, n in files.items() if d != "month=1") <= files["month=1"]
    assert sources.layers.read_layer(spark, place("layer"), ["month"]).count() == 400_000


def test_registered_table_grows_and_can_be_rebuilt(spark, place, put):
    spec = make(place, table="orders_growing")
    name = spec.bronze.full_table
    sinks.drop_table(spark, name)
    put("landing/a.csv", HEAD + "a,1,2024-01-05 00:00:00\n")
    both(spark, spec)
    assert inspect.table_exists(spark, name)
    assert rows(spark.table(name), "order_id") == [("a",)]
    put("landing/b.csv", "order_id,order_date,promo_code\nb,2024-02-05 00:00:00,P\nn,,Q\n")
    both(spark, spec)
    assert rows(spark.table(name), "order_id", "promo_code", "event_month") == [("a", None, 1), ("b", "P", 2), ("n", "Q", None)]
    sinks.drop_table(spark, name)
    assert not inspect.table_exists(spark, name)
    put("landing/c.csv", HEAD + "c,1,2024-03-05 00:00:00\n")
    both(spark, spec)
    assert rows(sources.read_bronze(spark, spec), "order_id") == [("a",), ("b",), ("c",), ("n",)]
    sinks.drop_table(spark, name)


def test_nested_fields_may_join(spark, place, put):
    bronze = BronzeSpec(path=place("bronze"), database="tier_db", table="nested_growing")
    spec = DatasetSpec(
        name="items", format="json", landing=place("landing"), raw=place("raw"), archive=place("archive"), checkpoint=place("checkpoint"),
        mode="append", evolution="add_new_columns", bronze=bronze,
    )
    sinks.drop_table(spark, bronze.full_table)
    put("landing/a.json", '{"id":"a","s":{"x":1}}\n')
    both(spark, spec)
    put("landing/b.json", '{"id":"b","s":{"y":{"z":"deep"}},"extra":true}\n')
    both(spark, spec)
    for df in (sources.read_raw(spark, spec), spark.table(bronze.full_table)):
        assert rows(df.selectExpr("id", "s.x", "s.y.z", "extra")) == [("a", 1, None, None), ("b", None, "deep", True)]
    sinks.drop_table(spark, bronze.full_table)


def test_chosen_batches_are_pruned_and_lost_ones_missed(spark, place):
    target = place("layer")
    for i in range(4):
        sinks.append_batch(spark.sql(f"select {i} as a, {i % 2} as p"), target, f"batch{i}", ["p"])
    spark.sql("select 9 as a").write.parquet(ledger.batch_path(target, "unfinished") + "/p=0")
    assert rows(sources.layers.read_layer(spark, target, ["p"]), "a", "p") == [(0, 0), (1, 1), (2, 0), (3, 1)]
    some = sources.layers.read_layer(spark, target, ["p"], batch_ids=["batch1", "batch2"])
    assert rows(some, "ingest_batch", "a") == [("batch1", 1), ("batch2", 2)]
    filters = some._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1]
    assert "ingest_batch" in filters.split("]")[0]
    pruned = sources.layers.read_layer(spark, target, ["p"]).where("p = 1")
    assert "(p" in pruned._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1]
    assert rows(pruned, "a") == [(1,), (3,)]
    storage.remove(spark, ledger.batch_path(target, "batch2"))
    for ids in (None, ["batch2"], ["batch0", "batch2"]):
        with pytest.raises(FileNotFoundError, match="batch2"):
            sources.layers.read_layer(spark, target, ["p"], batch_ids=ids)
    assert rows(sources.layers.read_layer(spark, target, ["p"], batch_ids=["batch0"]), "a") == [(0,)]


def test_types_may_not_change_and_growth_can_be_off(spark, place):
    target = place("layer")
    sinks.append_batch(spark.sql("select 1 as a"), target, "one")
    with pytest.raises(schemas.SchemaConflict):
        sinks.append_batch(spark.sql("select 'x' as a"), target, "two")
    with pytest.raises(schemas.SchemaConflict, match="off"):
        sinks.append_batch(spark.sql("select 1 as a, 2 as b"), target, "two", merge_schema=False)
    assert sources.layers.read_layer(spark, target).count() == 1


def test_replays_leave_nothing_stale_and_odd_names_work(spark, place, monkeypatch):
    key = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(key, "dynamic")
    try:
        first = spark.sql("select explode(array(1, 2)) as `order date`, 'x' as `a.b`")
        with monkeypatch.context() as patch:
            patch.setattr(ledger, "record", lambda *a, **k: (_ for _ in ()).throw(Crash("now")))
            with pytest.raises(Crash):
                sinks.append_batch(first, place("layer"), "one", ["order date"])
        sinks.append_batch(first.where("`order date` = 2"), place("layer"), "one", ["order date"])
    finally:
        spark.conf.unset(key)
    assert rows(sources.layers.read_layer(spark, place("layer"), ["order date"]), "`order date`", "`a.b`") == [(2, "x")]


def test_streams_need_a_checkpoint(spark, place, put):
    put("landing/a.csv", HEAD)
    with pytest.raises(ValueError, match="checkpoint"):
        jobs.landing_to_raw(spark, make(place, checkpoint=None))


def test_reserved_column_is_refused(spark, place):
    with pytest.raises(ValueError, match="reserved"):
        sinks.append_batch(spark.sql("select 'x' as ingest_batch"), place("layer"), "one")


def test_commit_rows_are_compacted(spark, place, monkeypatch):
    monkeypatch.setattr(ledger, "COMPACT_AFTER", 3)
    target = place("layer")
    for i in range(8):
        sinks.append_batch(spark.sql(f"select {i} as a" + (", 'x' as b" if i >= 5 else "")), target, f"batch{i}")
    known = ledger.state(spark, target)
    assert known.generation == 2 and [e.version for e in known.entries] == list(range(8))
    assert sorted(d for d in os.listdir(ledger.commit_path(target)) if d.startswith("gen=")) == ["gen=1", "gen=2"]
    assert rows(sources.layers.read_layer(spark, target), "a", "b") == [(i, "x" if i >= 5 else None) for i in range(8)]
    os.remove(f"{ledger.commit_path(target)}/gen=2/_SUCCESS")
    assert [e.version for e in ledger.state(spark, target).entries] == list(range(5))


def test_an_unfinished_first_commit_is_replaced(spark, place):
    target = place("layer")
    sinks.append_batch(spark.sql("select 1 as a"), target, "one")
    os.remove(f"{ledger.commit_path(target)}/gen=0/_SUCCESS")
    assert ledger.state(spark, target).entries == ()
    sinks.append_batch(spark.sql("select 1 as a"), target, "one")
    assert [e.batch_id for e in ledger.state(spark, target).entries] == ["one"]
    assert sources.layers.read_layer(spark, target).count() == 1


class Crash(RuntimeError):
    pass


@pytest.mark.parametrize("point", ["before_commit", "before_archive", "after_archive"])
def test_crash_and_rerun_leave_one_copy(spark, place, put, monkeypatch, point):
    spec = make(place)
    put("landing/a.csv", HEAD + "a,1,2024-01-05 00:00:00\n")
    put("landing/b.csv", HEAD + "b,1,2024-02-05 00:00:00\n")
    with monkeypatch.context() as patch:
        def crash(*args, **kwargs):
            raise Crash(point)

        if point == "before_commit":
            patch.setattr(ledger, "record", crash)
        elif point == "before_archive":
            patch.setattr(ledger, "archive", crash)
        else:
            done = ledger.archive
            patch.setattr(ledger, "archive", lambda *a, **k: (done(*a, **k), crash())[1])
        with pytest.raises(Exception, match=point):
            jobs.landing_to_raw(spark, spec)
    expected_files = 2 if point != "after_archive" else 0
    assert len(os.listdir(place("landing"))) == expected_files
    if point == "before_commit":
        assert ledger.state(spark, spec.raw).batch_ids == ()
    jobs.landing_to_raw(spark, spec)
    assert rows(sources.read_raw(spark, spec), "order_id") == [("a",), ("b",)]
    assert os.listdir(place("landing")) == [] and len(os.listdir(place("archive"))) == 2


def test_snapshot_that_was_not_archived_is_not_taken_in_twice(spark, place, put, monkeypatch):
    spec = make(place, mode="snapshot")
    put("landing/a.csv", HEAD + "a,1,2024-01-05 00:00:00\n")
    with monkeypatch.context() as patch:
        patch.setattr(ledger, "archive", lambda *a, **k: (_ for _ in ()).throw(Crash("now")))
        with pytest.raises(Crash):
            jobs.landing_to_raw(spark, spec)
    assert jobs.raw_to_bronze(spark, spec).rows == 1
    assert jobs.landing_to_raw(spark, spec).status == "empty"
    assert rows(sources.read_raw(spark, spec), "order_id") == [("a",)]
    put("landing/b.csv", HEAD + "b,1,2024-02-05 00:00:00\n")
    both(spark, spec)
    assert rows(sources.read_raw(spark, spec), "order_id") == [("b",)]
    assert rows(sources.read_bronze(spark, spec), "order_id") == [("a",), ("b",)]
    assert len(os.listdir(place("archive"))) == 2 and os.listdir(place("landing")) == []
    assert len(os.listdir(f"{spec.raw}/_files")) == 1


def test_one_scan_per_report(spark, place, put):
    spec = make(place)
    put("landing/a.csv", HEAD + "a,1,2024-01-05 00:00:00\n")
    jobs.landing_to_raw(spark, spec)
    plan = inspect.report(spark, spec).profile._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_unfinished_promotion_is_invisible_and_replaced(spark, place, put, monkeypatch):
    spec = make(place)
    put("landing/a.csv", HEAD + "a,1,2024-01-05 00:00:00\n")
    both(spark, spec)
    put("landing/b.csv", HEAD + "b,1,2024-02-05 00:00:00\n")
    jobs.landing_to_raw(spark, spec)
    with monkeypatch.context() as patch:
        patch.setattr(ledger, "record", lambda *a, **k: (_ for _ in ()).throw(Crash("now")))
        with pytest.raises(Crash):
            jobs.raw_to_bronze(spark, spec)
    assert rows(sources.read_bronze(spark, spec), "order_id") == [("a",)]
    assert jobs.raw_to_bronze(spark, spec).rows == 1
    assert rows(sources.read_bronze(spark, spec), "order_id") == [("a",), ("b",)]


@pytest.mark.parametrize("mode", ["append", "snapshot"])
@pytest.mark.parametrize("point", ["record", "align_table"])
def test_table_and_commit_rows_agree_after_a_crash(spark, place, put, monkeypatch, mode, point):
    spec = make(place, table=f"orders_{mode}_{point}", mode=mode)
    name = spec.bronze.full_table
    sinks.drop_table(spark, name)

    def promote_and_crash():
        with monkeypatch.context() as patch:
            inner, calls = getattr(ledger if point == "record" else sinks, point), []

            def crash(*args, **kwargs):
                calls.append(1)
                if point == "align_table" and len(calls) == 1:
                    return inner(*args, **kwargs)  # the one at the start of the promotion
                raise Crash("now")

            patch.setattr(ledger if point == "record" else sinks, point, crash)
            with pytest.raises(Crash):
                jobs.raw_to_bronze(spark, spec)

    def shown():
        return rows(spark.table(name), "order_id") if spark.catalog.tableExists(name) else []

    put("landing/a.csv", HEAD + "a,1,2024-01-05 00:00:00\n")
    jobs.landing_to_raw(spark, spec)
    promote_and_crash()
    if point == "record":
        assert shown() == []  # nothing that is not committed can be seen
    put("landing/b.csv", HEAD + "b,1,2024-02-05 00:00:00\n")
    jobs.landing_to_raw(spark, spec)
    promote_and_crash()
    jobs.raw_to_bronze(spark, spec)
    assert shown() == rows(sources.layers.read_layer(spark, spec.bronze.path), "order_id") == [("a",), ("b",)]
    assert jobs.raw_to_bronze(spark, spec).status == "empty"
    spark.sql(f"ALTER TABLE {name} ADD PARTITION (ingest_batch='ghost', event_year=1, event_month=1)")
    jobs.raw_to_bronze(spark, spec)
    assert spark.sql(f"show partitions {name}").where("partition like '%ghost%'").isEmpty()
    sinks.drop_table(spark, name)


def test_snapshots_wait_for_their_promotion(spark, place, put):
    spec = make(place, mode="snapshot")
    put("landing/a.csv", HEAD + "a,1,2024-01-05 00:00:00\nb,1,2024-01-06 00:00:00\n")
    jobs.landing_to_raw(spark, spec)
    put("landing/b.csv", "order_id,order_date,promo\nc,2024-02-05 00:00:00,P\n")
    jobs.landing_to_raw(spark, spec)
    assert rows(sources.read_raw(spark, spec), "order_id") == [("c",)]
    assert jobs.raw_to_bronze(spark, spec).rows == 3
    assert rows(sources.read_bronze(spark, spec), "order_id", "promo") == [("a", None), ("b", None), ("c", "P")]
    assert ledger.batch_dirs(spark, spec.raw) == list(ledger.state(spark, spec.raw).batch_ids)
    assert jobs.raw_to_bronze(spark, spec).status == "empty"


def test_snapshots_are_promoted_one_by_one(spark, place, put):
    spec = make(place, mode="snapshot")
    put("landing/a.csv", HEAD + "a,1,2024-01-05 00:00:00\n")
    both(spark, spec)
    put("landing/b.csv", HEAD + "b,1,2024-02-05 00:00:00\n")
    both(spark, spec)
    assert rows(sources.read_raw(spark, spec), "order_id") == [("b",)]
    assert rows(sources.read_bronze(spark, spec), "order_id") == [("a",), ("b",)]


def test_promotion_from_a_foreign_raw_directory(spark, place):
    spec = make(place)
    source = spark.sql("select 'a' as order_id, timestamp'2024-01-05 00:00:00' as order_date, 2024 as year")
    source.write.partitionBy("year").parquet(spec.raw)
    assert jobs.raw_to_bronze(spark, spec).rows == 1
    assert jobs.raw_to_bronze(spark, spec).status == "empty"
    source.withColumn("order_id", F.lit("b")).write.mode("append").partitionBy("year").parquet(spec.raw)
    assert jobs.raw_to_bronze(spark, spec).rows == 1
    assert rows(sources.read_bronze(spark, spec), "order_id", "event_month") == [("a", 1), ("b", 1)]


TELEMETRY = json.dumps({"type": "record", "name": "T", "fields": [
    {"name": "sensor_id", "type": "string"},
    {"name": "timestamp", "type": {"type": "long", "logicalType": "timestamp-millis"}},
    {"name": "temperature", "type": "float"},
]})


def telemetry(place, **changes):
    return DatasetSpec(
        name="telemetry", kind="messages", raw=place("raw"), checkpoint=place("checkpoint"), message_format="parquet",
        message_options={"path": place("topic")}, avro_schema=TELEMETRY, codec="json", partition_by=("ingestion_date", "kafka_topic"),
        bronze=BronzeSpec(
            path=place("bronze"), source_column="timestamp", year_column="event_year", month_column="event_month",
            partition_by=("event_year", "event_month"), checkpoint=place("bronze_checkpoint"),
        ),
    ).with_(**changes)


def send(spark, place, start, n):
    readings = spark.range(start, start + n).selectExpr(
        "id as message_no", "concat('s', id % 3) as sensor_id", "1704067200000 + id * 86400000 as timestamp", "cast(id as float) as temperature"
    )
    fixtures.as_messages(readings, "telemetry", "sensor_id", "message_no").write.mode("append").parquet(place("topic"))


def test_messages_reach_bronze_once(spark, place):
    spec = telemetry(place)
    send(spark, place, 0, 40)
    report = jobs.run(spark, {"telemetry": spec}, "messages_to_raw")
    assert rows(report, "status", "rows") == [("ok", 40)]
    raw = sources.read_raw(spark, spec)
    assert raw.count() == 40 and raw.columns[-2:] == ["ingestion_date", "kafka_topic"]
    assert dict(raw.dtypes)["ingestion_date"] == "date"
    assert jobs.raw_to_bronze(spark, spec).rows == 40
    send(spark, place, 40, 5)
    jobs.run(spark, {"telemetry": spec}, "messages_to_raw")
    assert jobs.raw_to_bronze(spark, spec).rows == 5
    assert jobs.raw_to_bronze(spark, spec).status == "empty"
    bronze = sources.read_bronze(spark, spec)
    assert rows(bronze.groupBy("event_month").count()) == [(1, 31), (2, 14)]
    assert inspect.table_kind(spark, spec.raw) == "stream"


def test_continuous_pipelines_are_watched_and_stopped(spark, place):
    good = telemetry(place)
    bad = telemetry(place, name="bad", raw=place("raw2"), checkpoint=place("checkpoint2"), message_options={"path": place("topic2")})
    send(spark, place, 0, 3)
    ended = jobs.run_message_pipelines(spark, [good], control.AVAILABLE_NOW)
    assert ended == ["messages_to_raw_telemetry"]
    broken = fixtures.as_messages(spark.sql("select 1 as n, 'x' as k"), "t", "k", "n").withColumn("value", F.lit("{").cast("binary"))
    broken.write.parquet(place("topic2"))
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        jobs.run_message_pipelines(spark, [good, bad])
    assert spark.streams.active == []
    assert jobs.run_message_pipelines(spark, [good], timeout=2) == []
    assert spark.streams.active == []


def test_missing_packages_are_named(spark, place):
    if storage.has_source(spark, "kafka"):
        pytest.skip("kafka is on the classpath")
    with pytest.raises(storage.MissingPackage, match="kafka"):
        sources.message_stream(spark, telemetry(place, message_format="kafka"))


def test_run_isolates_failures_and_raises(spark, place, put):
    put("landing/a.csv", HEAD + "a,1,2024-01-05 00:00:00\n")
    good = make(place)
    bad = make(place, name="bad", landing=place("absent"), raw=place("raw2"), mode="snapshot")
    specs = {"bad": bad, "sales": good, "telemetry": telemetry(place)}
    with pytest.raises(RunFailed, match="bad") as failure:
        jobs.run(spark, specs, "landing_to_raw", ["bad", "sales", "unknown", "telemetry"])
    assert [o.status for o in failure.value.outcomes] == ["failed", "ok", "skipped", "skipped"]
    report = jobs.run(spark, {"sales": good.with_(bronze=None)}, "raw_to_bronze", at_once=2)
    assert rows(report, "dataset", "job", "status") == [("sales", "raw_to_bronze", "skipped")]
    assert jobs.run(spark, specs, "raw_to_bronze", []).isEmpty()


def test_run_from_a_configuration(spark, place):
    from tierline import Layers

    config = {
        "datasets_to_ingest_to_raw": ["sales"],
        "datasets_to_promote_to_bronze": ["sales"],
        "dataset_configs": {"sales": {
            "type": "csv", "source_subpath": "sales/", "raw_target_subpath": "sales/", "archive_subpath": "sales/",
            "schema_config": {"fields": [
                {"name": "order_id", "type": "string"}, {"name": "price", "type": "double"},
                {"name": "order_date", "type": "timestamp", "format": "yyyy-MM-dd HH:mm:ss"},
            ]},
            "partition_config": {"columns_to_partition_by": ["year", "month", "day"], "derive_date_parts_from_column": "order_date"},
            "bronze_config": {
                "enabled": True, "bronze_target_subpath_delta": "sales/", "bronze_table_name": "configured", "bronze_database_name": "tier_db",
                "bronze_partition_columns_derivation": {"source_column": "order_date", "year_col_name": "event_year", "month_col_name": "event_month"},
                "partition_by_bronze": ["event_year", "event_month"],
            },
        }},
    }
    at = Layers(place("landing"), place("raw"), place("bronze"), place("archive"), place("checkpoints"))
    sinks.drop_table(spark, "tier_db.configured")
    orders = priced_orders(spark)
    n = orders.count()
    fixtures.land(orders, f"{at.landing}/sales", "csv")
    assert rows(jobs.run_config(spark, config, at, "landing_to_raw"), "status", "rows") == [("ok", n)]
    assert rows(jobs.run_config(spark, config, at, "raw_to_bronze"), "status", "rows") == [("ok", n)]
    assert jobs.run_config(spark, config, at, "messages_to_raw").isEmpty()
    assert spark.table("tier_db.configured").count() == n
    sinks.drop_table(spark, "tier_db.configured")


def test_reports(spark, place, put):
    spec = make(place)
    put("landing/a.csv", HEAD + "a,1,2024-01-05 00:00:00\nb,,2024-01-06 00:00:00\n")
    both(spark, spec)
    raw = inspect.report(spark, spec, "raw", columns=["order_id", "quantity", "promo_code"], order_by=["order_id"])
    assert raw.kind == "committed"
    assert rows(raw.profile) == [("order_id", 2, 2, False), ("quantity", 2, 1, False)]
    assert [tuple(r) for r in raw.sample.collect()] == [("a", 1), ("b", None)]
    assert "order_date" in [r.column_name for r in raw.schema.collect()]
    bronze = inspect.report(spark, spec, "bronze")
    assert bronze.history.count() == 1
    bronze.show()
    assert rows(inspect.non_null_counts(sources.read_raw(spark, spec), ["quantity", "absent"])) == [(1,)]
    empty = sources.read_raw(spark, spec).where("false")
    assert {r.is_empty for r in inspect.profile(empty).collect()} == {True}
    assert inspect.pick_existing(empty, ["nowhere"]).columns == empty.columns


def test_listing_leaves_hidden_directories_out(spark, place, put):
    put("dir/a.csv", "x")
    put("dir/sub/b.csv", "xy")
    put("dir/_commits/c.csv", "x")
    put("dir/.hidden/d.csv", "x")
    found = inspect.list_files(spark, place("dir"))
    assert sorted(os.path.basename(r.path) for r in found.collect()) == ["a.csv", "b.csv"]
    assert "FileScan" not in found._jdf.queryExecution().executedPlan().toString() and found.columns == ["path", "length", "modificationTime"]
    assert inspect.table_kind(spark, place("dir")) == "committed"
    assert inspect.table_kind(spark, place("nowhere")) == "missing"


def test_listing_tasks_do_not_grow_with_file_sizes(spark, place, put):
    for i in range(40):
        put(f"dir/{i % 3}/{i}.txt", "x" * 5000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        assert spark.read.option("recursiveFileLookup", "true").text(place("dir")).rdd.getNumPartitions() >= 40
        listed = inspect.list_files(spark, place("dir"))
        assert listed.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism + 1
        assert listed.count() == 40
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_listings_of_tasks_and_of_the_index_agree(spark, place, put, monkeypatch):
    for name in ("a.csv", "b +ü.csv", "k=1/c.csv", "k=2/d%20.txt", "k=2/l=x/e.csv", "deep/er/f.csv", "_g.csv", ".h", "k=1/_tmp/i.csv", "j.csv._COPYING_"):
        put(f"dir/{name}", name)
    for options in ({"recursiveFileLookup": "true"}, {"recursiveFileLookup": "true", "pathGlobFilter": "{a,d}*.[ct]*"}, {"recursiveFileLookup": "true", "modifiedAfter": "2100-01-01"}):
        mine, index = storage.listing(spark, place("dir"), options), storage._indexed(spark, place("dir"), options)
        assert rows(mine) == rows(index) and mine.dtypes == index.dtypes
    flat = {os.path.basename(r.path) for r in storage.listing(spark, place("dir"), {}).collect()}
    assert flat == {"a.csv", "b +ü.csv", "c.csv", "d%20.txt", "e.csv"}  # name=value directories only
    put("dir/empty +.csv", "")
    assert [r.length for r in storage.listing(spark, place("dir"), {"pathGlobFilter": "empty*"}).collect()] == [0]
    monkeypatch.setattr(listing, "reachable", lambda path: False)
    index = storage.listing(spark, place("dir"), {"recursiveFileLookup": "true"})
    assert "tierline_files" not in index._jdf.queryExecution().toString() and index.count() == 6
    with pytest.raises(FileNotFoundError):
        storage.listing(spark, place("nowhere"), {})


def test_a_repeated_move_says_the_same(place, put):
    import pyarrow as pa

    def run(rows):
        batch = pa.RecordBatch.from_pylist([dict(zip(("path", "archived_as", "fallback"), r)) for r in rows])
        return [o for b in listing.moved([batch]) for o in b.column("outcome").to_pylist()]

    plan = [("file:" + put("in/a b.txt", "1"), "file:" + place("out/a b.txt"), place("out/f1")), (put("in/c.txt", "2"), place("out/taken"), place("out/f2"))]
    put("out/taken", "other")
    assert run(plan[:1]) == ["moved"] and run(plan) == ["moved", "moved"] and run(plan) == ["moved", "moved"]
    assert {n: open(place(f"out/{n}")).read() for n in os.listdir(place("out"))} == {"a b.txt": "1", "taken": "other", "f2": "2"}
    assert run([(place("in/never"), place("out/x"), place("out/y"))]) == ["gone"] and os.listdir(place("in")) == []
    put("in/c.txt", "3")
    with pytest.raises(FileExistsError):
        run(plan)
    assert os.listdir(place("in")) == ["c.txt"]


def test_archive_without_tasks(spark, place, put, monkeypatch):
    monkeypatch.setattr(listing, "reachable", lambda path: False)
    put("landing/a b.csv", "x")
    put("archive/a b.csv", "earlier")
    found = storage._indexed(spark, place("landing"), {})
    assert ledger.archive(spark, found, place("archive")) == 1
    assert len(os.listdir(place("archive"))) == 2 and os.listdir(place("landing")) == []


def test_single_file_export(spark, place):
    df = spark.range(5).selectExpr("id", "timestamp'2024-01-01 00:00:00' as t")
    path = sinks.export_single_file(df, place("out"), "all.csv")
    assert os.listdir(place("out")) == ["all.csv"] or sorted(os.listdir(place("out"))) == [".all.csv.crc", "all.csv"]
    assert spark.read.csv(path, header=True).count() == 5
    with pytest.raises(OSError):
        sinks.export_single_file(df, place("out"), "all.csv")


def test_bronze_is_rewritten_into_one_batch(spark, place, put):
    spec = make(place, table="orders_rewritten")
    name = spec.bronze.full_table
    sinks.drop_table(spark, name)
    for i in range(3):
        put(f"landing/{i}.csv", HEAD + f"a{i},1,2024-01-05 00:00:00\nb{i},1,2024-02-05 00:00:00\n")
        both(spark, spec)
    assert spark.sql(f"show partitions {name}").count() == 6
    before = rows(spark.table(name).drop("ingest_batch"), "order_id", "event_month")
    assert jobs.rewrite_bronze(spark, spec).rows == 6
    assert spark.sql(f"show partitions {name}").count() == 2 and len(ledger.batch_dirs(spark, spec.bronze.path)) == 1
    assert rows(spark.table(name), "order_id", "event_month") == before
    assert jobs.rewrite_bronze(spark, spec).status == "empty" and jobs.raw_to_bronze(spark, spec).status == "empty"
    put("landing/9.csv", HEAD + "z,1,2024-01-05 00:00:00\n")
    assert both(spark, spec)[1].rows == 1
    assert spark.table(name).count() == 7
    sinks.drop_table(spark, name)


def priced_orders(spark):
    """Rows of the given orders under the names that the specs here declare."""
    orders = spark.read.parquet(f"{DATA}/orders.parquet")
    return orders.selectExpr("cast(o_orderkey as string) as order_id", "o_totalprice as price", "o_orderdate as order_date")


def test_landed_rows_of_two_shapes_can_be_ingested(spark, place):
    spec = make(place, fields=(Field("order_id"), Field("price", "double"), Field("order_date", "timestamp")))
    once = priced_orders(spark)
    fixtures.land(once, spec.landing, "csv")
    fixtures.land(once.withColumn("promo_code", F.expr("if(price > 100000, 'P', null)")), spec.landing, "csv")
    raw, bronze = both(spark, spec)
    n = once.count()
    assert (raw.rows, bronze.rows) == (2 * n, 2 * n)
    counts = inspect.non_null_counts(sources.read_bronze(spark, spec), ["order_id", "order_date", "promo_code"]).first()
    assert counts.order_id == counts.order_date == 2 * n and 0 < counts.promo_code <= n


def test_pruning_reaches_the_raw_scan(spark, place, put):
    spec = make(place)
    put("landing/a.csv", HEAD + "a,1,2024-01-05 00:00:00\nb,2,2025-02-05 00:00:00\n")
    jobs.landing_to_raw(spark, spec)
    df = sources.read_raw(spark, spec).where("year = 2024 and quantity > 0").select("order_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = df._jdf.queryExecution().optimizedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "isnotnull(year" in filters and "isnotnull(ingest_batch" in filters and "= 2024" in scan
    assert "PushedFilters: [IsNotNull(quantity), GreaterThan(quantity,0)]" in plan
    assert "order_date" not in plan.split("ReadSchema")[1]
    assert rows(df) == [("a",)]


def test_every_small_batch_is_counted(spark, place):
    schema = "a long"
    for i in range(130):
        os.makedirs(place("many"), exist_ok=True)
        with open(place(f"many/{i:03d}.csv"), "w") as file:
            file.write(f"{i}\n")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 13).csv(place("many"))
        rows_in = control.rows_until_done(
            spark, lambda: sinks.append_stream(stream, place("out"), place("check"), trigger=control.AVAILABLE_NOW, name="counted")
        )
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert rows_in == 130


def test_a_committed_layers_profile_reads_no_data(spark, place, put):
    spec = make(place)
    put("landing/a.csv", HEAD + "a,1,2024-01-05 00:00:00\nb,,2025-02-05 00:00:00\n")
    jobs.landing_to_raw(spark, spec)
    put("landing/b.csv", "order_id,quantity,order_date,promo\nc,-7,2023-01-05 00:00:00,X\n")
    jobs.landing_to_raw(spark, spec)
    found = inspect.committed_profile(spark, spec.raw, spec.partition_by)
    raw = sources.read_raw(spark, spec).drop(ledger.BATCH)
    assert rows(found, "column_name", "rows", "non_null", "is_empty") == rows(inspect.profile(raw))
    assert "_commits" in found.inputFiles()[0] and len(found.inputFiles()) == len(raw.sparkSession.read.parquet(ledger.commit_path(spec.raw) + "/gen=0").inputFiles())
    bounds = {r.column_name: (r.least, r.most) for r in found.collect()}
    assert bounds["quantity"] == ("-7", "1") and bounds["order_id"] == (None, None) == bounds["promo"]
    assert bounds["order_date"] == ("2023-01-05 00:00:00", "2025-02-05 00:00:00")
    report = inspect.report(spark, spec, "raw")
    assert rows(report.profile) == rows(inspect.profile(sources.read_raw(spark, spec).drop(ledger.BATCH)))


def test_profile_of_batches_without_statistics_scans(spark, place, put):
    spec = make(place)
    put("landing/a.csv", HEAD + "a,1,2024-01-05 00:00:00\n")
    jobs.landing_to_raw(spark, spec)
    path = ledger.commit_path(spec.raw) + "/gen=0"
    old = spark.createDataFrame(spark.read.parquet(path).drop("column_stats").collect(), spark.read.parquet(path).drop("column_stats").schema)
    old.write.mode("overwrite").parquet(path)
    assert inspect.committed_profile(spark, spec.raw) is None
    assert inspect.report(spark, spec, "raw").profile.count() > 0


def test_bins_leave_large_ones_and_single_ones_alone():
    assert jobs.bins([("a", 5), ("b", 100), ("c", 6), ("d", 9), ("e", 4)], 10) == [["c", "e"]]
    assert jobs.bins([("a", 3), ("b", 3), ("c", 100), ("d", 4)], 10) == [["a", "b", "d"]]
    assert jobs.bins([("a", 9), ("b", 9)], 10) == [] == jobs.bins([], 10)


@pytest.mark.parametrize("crash", [None, "before_commit", "before_table", "before_clearing"])
def test_small_batches_are_compacted_once_whatever_happens(spark, place, put, monkeypatch, crash):
    spec = make(place, table=f"orders_compacted_{crash or 'none'}".lower())
    name = spec.bronze.full_table
    sinks.drop_table(spark, name)
    lines = "".join(f"big{i},{i},2024-01-{i % 28 + 1:02d} 00:00:00\n" for i in range(400))
    put("landing/big.csv", HEAD + lines)
    jobs.landing_to_raw(spark, spec)
    jobs.raw_to_bronze(spark, spec)
    for i in range(3):
        extra = ",promo" if i == 1 else ""
        put(f"landing/{i}.csv", HEAD.strip() + extra + f"\n{i},{i},2024-02-0{i + 1} 00:00:00{',P' if extra else ''}\n")
        jobs.landing_to_raw(spark, spec)
        jobs.raw_to_bronze(spark, spec)
    want = rows(spark.table(name), "order_id", "quantity", "promo")
    batches = ledger.state(spark, spec.bronze.path).batch_ids
    sizes = {b: sum(r.length for r in storage.listing(spark, ledger.batch_path(spec.bronze.path, b), {"recursiveFileLookup": "true"}).collect()) for b in batches}
    most = max(sizes.values())
    target = most if sum(sorted(sizes.values())[:3]) <= most else sum(sorted(sizes.values())[:3])
    if crash:
        at = {"before_commit": (sinks, "_record"), "before_table": (sinks, "align_table"), "before_clearing": (sinks, "clear_folded")}[crash]
        inner, calls = getattr(*at), []

        def fails(*a, **k):
            calls.append(1)
            if crash != "before_clearing" or len(calls) == 2:
                raise Crash("now")
            return inner(*a, **k)

        with monkeypatch.context() as patch:
            patch.setattr(*at, fails)
            with pytest.raises(Crash):
                jobs.compact_bronze(spark, spec, target)
    done = jobs.compact_bronze(spark, spec, target)
    assert done.status in ("ok", "empty") and jobs.compact_bronze(spark, spec, target).status == "empty"
    known = ledger.state(spark, spec.bronze.path)
    assert len(known.live) < len(batches) and sorted(ledger.batch_dirs(spark, spec.bronze.path)) == sorted(known.batch_ids)
    jobs.raw_to_bronze(spark, spec)  # brings the table in line
    assert rows(spark.table(name), "order_id", "quantity", "promo") == want == rows(layers.read_layer(spark, spec.bronze.path), "order_id", "quantity", "promo")
    put("landing/last.csv", HEAD + "z,9,2024-03-01 00:00:00\n")
    jobs.landing_to_raw(spark, spec)
    assert jobs.raw_to_bronze(spark, spec).rows == 1
    assert len(rows(spark.table(name))) == len(want) + 1
    sinks.drop_table(spark, name)


def test_raw_without_dates_gives_one_file_a_bronze_directory(spark, place):
    site_orders = spark.read.parquet(f"{DATA}/orders.parquet").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"))
    site_orders.repartition(4).write.parquet(place("landing"))
    spec = DatasetSpec(
        name="orders", landing=place("landing"), raw=place("raw"), format="parquet", mode="append", checkpoint=place("check"), optimize_write=False,
        bronze=BronzeSpec(path=place("bronze"), source_column="o_orderdate", year_column="y", month_column="m", partition_by=("y",)),
    )
    jobs.landing_to_raw(spark, spec)
    jobs.raw_to_bronze(spark, spec)
    found = spark.read.option("recursiveFileLookup", "true").parquet(place("bronze") + "/ingest_batch=*").select(F.input_file_name().alias("f")).distinct()
    files = [r.f.rsplit("/", 1)[0] for r in found.collect()]
    assert len(files) == len(set(files)) > 1
