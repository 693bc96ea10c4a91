"""Landing -> raw: the whole first slice, by explicit rows."""

import os
import re
from datetime import datetime

import pytest

from tierline import DatasetSpec, Field, inspect, jobs, ledger, sources
from tierline.functions import derive

from .conftest import rows

FIELDS = (
    Field("order_id", "string"),
    Field("quantity", "integer"),
    Field("price", "double"),
    Field("order_date", "timestamp", "yyyy-MM-dd HH:mm:ss"),
)


def sales_spec(place, **changes) -> DatasetSpec:
    return DatasetSpec(
        name="sales", landing=place("landing"), raw=place("raw"), archive=place("archive"), checkpoint=place("checkpoint"),
        fields=FIELDS, partition_by=("year", "month", "day"), date_source="order_date",
    ).with_(**changes)


def test_snapshot_run(spark, place, put):
    put("landing/a.csv", "order_id,quantity,price,order_date\n007,1,2.5,2024-01-31 10:00:00\nx2,bad,3.5,2024-02-01 00:00:00\n")
    spec = sales_spec(place)
    done = jobs.landing_to_raw(spark, spec)
    assert (done.status, done.rows, done.files) == ("ok", 2, 1)
    raw = sources.read_raw(spark, spec)
    assert rows(raw, "order_id", "quantity", "price", "order_date", "year", "month", "day") == [
        ("007", 1, 2.5, datetime(2024, 1, 31, 10), 2024, 1, 31),
        ("x2", None, 3.5, datetime(2024, 2, 1), 2024, 2, 1),
    ]
    assert {"source_filename", "ingestion_ts", "ingestion_date"} <= set(raw.columns)
    assert os.listdir(place("landing")) == []
    assert os.listdir(place("archive")) == ["a.csv"]


def test_next_snapshot_replaces(spark, place, put):
    spec = sales_spec(place)
    put("landing/a.csv", "order_id,quantity,price,order_date\na,1,1,2024-01-01 00:00:00\n")
    jobs.landing_to_raw(spark, spec)
    put("landing/b.csv", "order_id,quantity,price,order_date\nb,1,1,2024-01-02 00:00:00\n")
    jobs.landing_to_raw(spark, spec)
    assert rows(sources.read_raw(spark, spec), "order_id") == [("b",)]
    assert len([d for d in os.listdir(place("raw")) if d.startswith("ingest_batch=")]) == 1


def test_empty_landing_leaves_raw_alone(spark, place, put):
    spec = sales_spec(place)
    put("landing/a.csv", "order_id,quantity,price,order_date\na,1,1,2024-01-01 00:00:00\n")
    jobs.landing_to_raw(spark, spec)
    assert jobs.landing_to_raw(spark, spec).status == "empty"
    assert sources.read_raw(spark, spec).count() == 1


def test_header_only_file_is_archived(spark, place, put):
    spec = sales_spec(place)
    put("landing/a.csv", "order_id,quantity,price,order_date\n")
    done = jobs.landing_to_raw(spark, spec)
    assert (done.status, done.rows) == ("ok", 0)
    assert os.listdir(place("archive")) == ["a.csv"]
    assert sources.read_raw(spark, spec).count() == 0


def test_missing_partition_source_fails_before_writing(spark, place, put):
    put("landing/a.csv", "order_id,quantity,price,order_date\na,1,1,2024-01-01 00:00:00\n")
    spec = sales_spec(place, date_source="nowhere")
    with pytest.raises(derive.MissingColumns, match="year"):
        jobs.landing_to_raw(spark, spec)
    assert ledger.batch_dirs(spark, place("raw")) == [] and os.listdir(place("raw") + "/_files") == []
    assert os.listdir(place("landing")) == ["a.csv"]


def test_awkward_names_and_collisions_in_the_archive(spark, place, put):
    spec = sales_spec(place, reader_options={"recursiveFileLookup": "true"})
    text = "order_id,quantity,price,order_date\na,1,1,2024-01-01 00:00:00\n"
    for name in ("a b+c.csv", "x[1].csv", "z%20q.csv", "one/same.csv", "two/same.csv"):
        put(f"landing/{name}", text)
    done = jobs.landing_to_raw(spark, spec)
    assert done.rows == 5
    archived = sorted(os.listdir(place("archive")))
    assert {"a b+c.csv", "x[1].csv", "z%20q.csv"} <= set(archived)
    same = [n for n in archived if n.startswith("same-")]
    assert len(same) == 2 and len(archived) == 5
    assert all(re.fullmatch(r"same-[0-9a-f]{32}\.csv", n) for n in same)
    put("landing/a b+c.csv", text)
    jobs.landing_to_raw(spark, spec)
    assert len(os.listdir(place("archive"))) == 6


def test_processed_files_counts(spark, place, put):
    spec = sales_spec(place)
    put("landing/a.csv", "order_id,quantity,price,order_date\na,1,1,2024-01-01 00:00:00\nb,1,1,2024-01-01 00:00:00\n")
    put("landing/b.csv", "order_id,quantity,price,order_date\nc,1,1,2024-01-01 00:00:00\n")
    jobs.landing_to_raw(spark, spec)
    found = {os.path.basename(r.source_filename): r.rows for r in ledger.processed_files(sources.read_raw(spark, spec)).collect()}
    assert found == {"a.csv": 2, "b.csv": 1}


def test_incremental_runs_take_each_file_once(spark, place, put):
    spec = sales_spec(place, mode="append", evolution="add_new_columns", max_files_per_trigger=1)
    text = "order_id,quantity,price,order_date\n{0},1,1,2024-01-01 00:00:00\n"
    put("landing/a.csv", text.format("a"))
    put("landing/b.csv", text.format("b"))
    first = jobs.landing_to_raw(spark, spec)
    assert (first.status, first.rows, first.files) == ("ok", 2, 2)
    put("landing/c.csv", "order_date,promo_code,order_id\n2024-03-01 00:00:00,SAVE10,c\n")
    second = jobs.landing_to_raw(spark, spec)
    assert (second.status, second.rows) == ("ok", 1)
    assert jobs.landing_to_raw(spark, spec).status == "empty"
    assert rows(sources.read_raw(spark, spec), "order_id", "quantity", "promo_code", "month") == [
        ("a", 1, None, 1), ("b", 1, None, 1), ("c", None, "SAVE10", 3),
    ]
    assert os.listdir(place("landing")) == []
    assert sorted(os.listdir(place("archive"))) == ["a.csv", "b.csv", "c.csv"]
    assert [r.operation for r in inspect.history(spark, spec.raw).collect()] == ["append"] * 3


@pytest.mark.parametrize("mode", ["snapshot", "append"])
def test_directories_in_landing_are_columns(spark, place, put, mode):
    put("landing/shop=007/dt=2024-01-01/a.csv", "order_id,quantity,price,order_date\na,1,1,2024-01-01 00:00:00\n")
    put("landing/shop=2/dt=2024-01-02/a.csv", "quantity,order_id\n2,b\n")
    spec = sales_spec(place, mode=mode, evolution="add_new_columns", fields=(*FIELDS, Field("shop")), date_source=None, partition_by=("dt",))
    done = jobs.landing_to_raw(spark, spec)
    assert (done.rows, done.files) == (2, 2)
    raw = sources.read_raw(spark, spec)
    assert rows(raw.selectExpr("order_id", "quantity", "shop", "cast(dt as string)")) == [("a", 1, "007", "2024-01-01"), ("b", 2, "2", "2024-01-02")]
    assert len(os.listdir(place("archive"))) == 2


def test_relanded_name_is_reported_and_kept(spark, place, put):
    spec = sales_spec(place, mode="append", max_file_age="36500d")
    text = "order_id,quantity,price,order_date\n{0},1,1,2024-01-01 00:00:00\n"
    put("landing/a.csv", text.format("a"))
    jobs.landing_to_raw(spark, spec)
    put("landing/a.csv", text.format("again"))
    old = put("landing/old.csv", text.format("old"))
    os.utime(old, (1, 1))
    done = jobs.landing_to_raw(spark, spec)
    assert (done.status, done.rows, done.skipped) == ("partial", 1, 1)
    assert os.listdir(place("landing")) == ["a.csv"]
    assert rows(sources.read_raw(spark, spec), "order_id") == [("a",), ("old",)]


def test_files_older_than_the_intake_remembers_are_reported(spark, place, put):
    spec = sales_spec(place, mode="append")
    text = "order_id,quantity,price,order_date\n{0},1,1,2024-01-01 00:00:00\n"
    put("landing/a.csv", text.format("a"))
    jobs.landing_to_raw(spark, spec)
    os.utime(put("landing/old.csv", text.format("old")), (1, 1))
    done = jobs.landing_to_raw(spark, spec)
    assert (done.status, done.rows, done.skipped) == ("partial", 0, 1)
    assert os.listdir(place("landing")) == ["old.csv"]


@pytest.mark.parametrize("mode", ["append", "snapshot"])
def test_empty_files_are_listed_counted_and_archived(spark, place, put, mode):
    spec = sales_spec(place, mode=mode)
    put("landing/a.csv", "order_id,quantity,price,order_date\na,1,1,2024-01-01 00:00:00\n")
    put("landing/zero byte+.csv", "")
    listed = {os.path.basename(r.path): r.length for r in inspect.list_files(spark, place("landing")).collect()}
    assert listed["zero byte+.csv"] == 0 and listed["a.csv"] > 0
    done = jobs.landing_to_raw(spark, spec)
    assert (done.status, done.rows, done.files, done.skipped) == ("ok", 1, 2, 0)
    assert os.listdir(place("landing")) == [] and sorted(os.listdir(place("archive"))) == ["a.csv", "zero byte+.csv"]


def test_a_snapshot_is_read_in_bounded_parts(spark, place, put, monkeypatch):
    from tierline.sources import files

    spec = sales_spec(place, max_files_per_trigger=2, evolution="add_new_columns")
    for i in range(5):
        extra = ",promo" if i == 4 else ""
        put(f"landing/{i}.csv", f"order_id,quantity,price,order_date{extra}\n{i},1,1,2024-01-0{i + 1} 00:00:00{',P' if extra else ''}\n")
    asked, inner = [], files.read_files
    monkeypatch.setattr(files, "read_files", lambda spark, spec, paths, *more: (asked.append(len(paths)), inner(spark, spec, paths, *more))[1])
    done = jobs.landing_to_raw(spark, spec)
    assert (done.rows, done.files, asked) == (5, 5, [2, 2, 1])
    assert rows(sources.read_raw(spark, spec), "order_id", "promo") == [("0", None), ("1", None), ("2", None), ("3", None), ("4", "P")]
    assert len(ledger.state(spark, spec.raw).entries) == 1


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_inferred_types_are_remembered(spark, place, put, fmt):
    spec = DatasetSpec(
        name="t", format=fmt, landing=place("landing"), raw=place("raw"), archive=place("archive"), checkpoint=place("checkpoint"), mode="append",
        evolution="add_new_columns", infer_types=True,
    )

    def land(name, values):
        if fmt == "csv":
            put(f"landing/{name}.csv", "id,qty\n" + "".join(f"{i},{'' if v is None else v}\n" for i, v in values))
        else:
            put(f"landing/{name}.json", "".join(f'{{"id":{i},"qty":{"null" if v is None else v}}}\n' for i, v in values))
        return jobs.landing_to_raw(spark, spec)

    assert land("a", [(1, 2), (2, None)]).rows == 2
    assert land("b", [(3, None)]).rows == 1
    assert "qty_text" not in sources.read_raw(spark, spec).columns
    assert land("c", [(4, 2.5), (5, 7)]).rows == 2
    assert land("d", [(6, 8)]).status == "ok"
    got = rows(sources.read_raw(spark, spec), "id", "qty", "qty_text")
    assert got == [(1, 2, None), (2, None, None), (3, None, None), (4, None, "2.5"), (5, 7, None), (6, 8, None)]
    assert os.listdir(place("landing")) == []


def test_a_struct_that_changes_keeps_its_text(spark, place, put):
    spec = DatasetSpec(
        name="t", format="json", landing=place("landing"), raw=place("raw"), checkpoint=place("checkpoint"), archive=place("archive"), mode="append",
        evolution="add_new_columns", infer_types=True,
    )
    for name, line in (("a", '{"s":{"x":1}}'), ("b", '{"s":{"x":2,"y":"new"}}'), ("c", '{"s":{"x":"odd"}}'), ("d", '{"s":5}')):
        put(f"landing/{name}.json", line + "\n")
        assert jobs.landing_to_raw(spark, spec).rows == 1
    got = rows(sources.read_raw(spark, spec).selectExpr("s.x", "s.y", "s_text"))
    assert got[0] == (1, None, None) and (2, "new", None) in got
    assert sorted(r[2] for r in got if r[2]) == ["5", '{"x":"odd"}']


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from tierline import storage

    class Remote:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Remote
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        storage.scratch(Session, "x")
    Remote.master = "local[4]"
    assert "tierline-x-" in storage.scratch(Session, "x")
