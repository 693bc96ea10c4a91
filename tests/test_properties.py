"""Properties that hold for any input: headers in any order, replays at any point, any time zone."""

import csv
import io
import json
import os
import tempfile
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tierline import BronzeSpec, DatasetSpec, Field, fixtures, jobs, ledger, sinks, sources

from .conftest import rows

NAMES = ["id", "a", "b b", "c,c", "D"]
VALUE = st.text(alphabet="xyz 09,\"'|é", min_size=1, max_size=6).filter(lambda s: s.strip() == s and s)
HEADER = st.permutations(NAMES).flatmap(lambda p: st.integers(0, 4).map(lambda n: ["id", *[c for c in p[:n] if c != "id"]]))


@st.composite
def landed_file(draw):
    header = draw(st.permutations(draw(HEADER)))
    return header, draw(st.lists(st.fixed_dictionaries({c: VALUE for c in header}), max_size=4))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(landed_file(), min_size=1, max_size=5))
def test_any_mix_of_headers_is_matched_by_name(spark, landed):
    root = tempfile.mkdtemp(prefix="tierline-headers-")
    os.makedirs(f"{root}/landing")
    expected, found = [], {"id"}
    for number, (header, records) in enumerate(landed):
        text = io.StringIO()
        writer = csv.DictWriter(text, header, lineterminator="\n")
        writer.writeheader()
        writer.writerows(records)
        with open(f"{root}/landing/{number}.csv", "w", encoding="utf-8") as handle:
            handle.write(text.getvalue())
        found |= set(header)
        expected += [tuple(r.get(c) for c in NAMES) for r in records]
    spec = DatasetSpec(
        name="any", landing=f"{root}/landing", raw=f"{root}/raw", fields=(Field("id"),), evolution="add_new_columns",
        reader_options={"escape": '"'},
    )
    df = sources.read_files(spark, spec)
    assert set(df.columns) == found | {"source_filename"}
    selected = df.select(*[f"`{c}`" if c in found else "id" for c in NAMES])
    got = [tuple(v if c in found else None for c, v in zip(NAMES, r)) for r in selected.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


SCHEMA = json.dumps({"type": "record", "name": "R", "fields": [
    {"name": "n", "type": "long"}, {"name": "at", "type": {"type": "long", "logicalType": "timestamp-millis"}},
]})


def test_streaming_promotion_survives_a_crash(spark, place, monkeypatch):
    spec = DatasetSpec(
        name="m", kind="messages", raw=place("raw"), checkpoint=place("checkpoint"), message_format="parquet",
        message_options={"path": place("topic")}, avro_schema=SCHEMA, codec="json", partition_by=("kafka_topic",),
        bronze=BronzeSpec(
            path=place("bronze"), database="tier_db", table="crashing_stream", source_column="at", year_column="y",
            partition_by=("y",), checkpoint=place("bronze_checkpoint"),
        ),
    )
    sinks.drop_table(spark, spec.bronze.full_table)
    numbers = spark.range(20).selectExpr("id as message_no", "id as n", "1704067200000 as at")
    fixtures.as_messages(numbers, "t", "n", "message_no").write.parquet(place("topic"))
    jobs.run(spark, {"m": spec}, "messages_to_raw")
    done = ledger.record
    for point in ("before", "after"):
        with monkeypatch.context() as patch:
            def crash(*args, **kwargs):
                if point == "after":
                    done(*args, **kwargs)
                raise RuntimeError("crash " + point)

            patch.setattr(ledger, "record", crash)
            with pytest.raises(Exception, match="crash " + point):
                jobs.raw_to_bronze(spark, spec)
    jobs.raw_to_bronze(spark, spec)
    assert sorted(r.n for r in sources.read_bronze(spark, spec).collect()) == list(range(20))
    assert ledger.commits(spark, spec.bronze.path).count() == 1
    sinks.drop_table(spark, spec.bronze.full_table)


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_date_parts_follow_the_session_time_zone(spark, place, put, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        put("landing/a.csv", "id,t\na,2024-12-31 23:30:00\nb,2025-01-01 00:30:00\n")
        spec = DatasetSpec(
            name="z", landing=place("landing"), raw=place("raw"), fields=(Field("id"), Field("t", "timestamp")),
            partition_by=("year", "day"), date_source="t",
        )
        jobs.landing_to_raw(spark, spec)
        raw = sources.read_raw(spark, spec).selectExpr("id", "cast(t as timestamp_ntz) as t", "year", "day")
        assert rows(raw) == [("a", datetime(2024, 12, 31, 23, 30), 2024, 31), ("b", datetime(2025, 1, 1, 0, 30), 2025, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_datasets_side_by_side(spark, place, put):
    specs = {}
    for i in range(4):
        put(f"landing{i}/a.csv", "id,t\n" + "".join(f"{j},2024-01-0{1 + j} 00:00:00\n" for j in range(i + 1)))
        specs[f"d{i}"] = DatasetSpec(
            name=f"d{i}", landing=place(f"landing{i}"), raw=place(f"raw{i}"), checkpoint=place(f"checkpoint{i}"),
            mode="append" if i % 2 else "snapshot", fields=(Field("id"), Field("t", "timestamp")), partition_by=("day",), date_source="t",
        )
    report = jobs.run(spark, specs, "landing_to_raw", at_once=4)
    assert [tuple(r) for r in report.select("dataset", "status", "rows").collect()] == [(f"d{i}", "ok", i + 1) for i in range(4)]
    assert [sources.read_raw(spark, s).count() for s in specs.values()] == [1, 2, 3, 4]
