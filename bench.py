"""Time the headline jobs on the tables at $BENCH_SF_DIR and print one JSON line.

Landing data is made from the tables first and not timed. Each job runs $BENCH_REPEATS times
(default 3) on fresh targets after one untimed warm-up; the median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tierline import BronzeSpec, DatasetSpec, Field, fixtures, inspect, jobs, sources, storage  # noqa: E402
from tierline.plans.checks import EVENT_MESSAGE  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tierline-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tierline-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(run) -> dict:
    """Median, spread and result of ``run(attempt)``; attempt 0 warms up."""
    seconds, result = [], None
    for attempt in range(REPEATS + 1):
        start = time.perf_counter()
        result = run(attempt)
        if attempt:
            seconds.append(time.perf_counter() - start)
    return {"seconds": statistics.median(seconds), "spread": max(seconds) - min(seconds), "result": result}


class Bench:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = storage.scratch(spark, "bench")
        self.lineitem = self.table("lineitem")
        columns = [Field(f.name, "timestamp" if f.name == "l_shipdate" else f.dataType.simpleString()) for f in self.lineitem.schema]
        self.fields = tuple(columns)

    def table(self, name: str):
        return self.spark.read.parquet(f"{SF_DIR}/{name}.parquet")

    def at(self, name: str) -> str:
        return f"{self.root}/{name}"

    def prepare(self) -> None:
        options = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
        self.lineitem.repartition(20).write.options(**options).csv(self.at("lineitem_csv"))
        cut = F.lit("1998-01-01").cast("timestamp_ntz")
        names = self.lineitem.columns
        early = self.lineitem.where(F.col("l_shipdate") < cut)
        later = self.lineitem.where(F.col("l_shipdate") >= cut).select(*reversed(names), F.col("l_returnflag").alias("promo_code"))
        for part in (early, later):
            part.repartition(10).write.mode("append").options(**options).csv(self.at("lineitem_two_headers"))
        self.table("orders").write.options(**options).csv(self.at("orders_csv"))
        events = self.table("events").select(
            F.col("event_id").alias("message_no"), "event_id", "event_type",
            F.unix_millis(F.col("ts").cast("timestamp")).alias("at"), "value", "user_id", "props", F.lit("t").alias("kafka_topic"),
        )
        # a topic of many files, as a broker's partitions would be, so that all cores have work
        fixtures.as_messages(events, "events", "event_type", "message_no").repartition(2 * int(CPUS)).write.parquet(self.at("topic"))
        self.table("part").repartition(20).write.json(self.at("part_json"))
        for number in range(40):
            self.table("supplier").where(F.col("s_suppkey") % 40 == number).withColumn(f"extra_{number}", F.lit(number)).coalesce(1).write.mode(
                "append").options(**options).csv(self.at("many_headers"))
        self.pending = self.orders_spec("pending_csv", "pending_raw")
        for number in range(12):
            self.table("orders").where(F.col("o_orderkey") % 12 == number).coalesce(2).write.mode("append").options(**options).csv(self.at("pending_csv"))
            jobs.landing_to_raw(self.spark, self.pending.with_(mode="append"))
        jobs.landing_to_raw(self.spark, self.lineitem_spec("lineitem_csv", "raw_for_reads"))
        self.orders = self.orders_spec("orders_csv", "orders_raw")
        jobs.landing_to_raw(self.spark, self.orders)

    def orders_spec(self, landing: str, raw: str) -> DatasetSpec:
        fields = tuple(Field(f.name, "timestamp" if f.name == "o_orderdate" else f.dataType.simpleString()) for f in self.table("orders").schema)
        return DatasetSpec(
            name="orders", landing=self.at(landing), raw=self.at(raw), checkpoint=self.at(f"{raw}_checkpoint"), fields=fields,
            partition_by=("year", "month"), date_source="o_orderdate",
        )

    def lineitem_spec(self, landing: str, raw: str, **changes) -> DatasetSpec:
        return DatasetSpec(
            name="lineitem", landing=self.at(landing), raw=self.at(raw), checkpoint=self.at(f"{raw}_checkpoint"), fields=self.fields,
            partition_by=("year", "month"), date_source="l_shipdate", evolution="add_new_columns",
        ).with_(**changes)

    def csv_snapshot(self, attempt: int) -> int:
        return jobs.landing_to_raw(self.spark, self.lineitem_spec("lineitem_csv", f"snapshot_{attempt}")).rows

    def csv_incremental_two_headers(self, attempt: int) -> int:
        return jobs.landing_to_raw(self.spark, self.lineitem_spec("lineitem_two_headers", f"incremental_{attempt}", mode="append")).rows

    def raw_to_bronze(self, attempt: int) -> int:
        bronze = BronzeSpec(
            path=self.at(f"bronze_{attempt}"), database="tierline_bench", table=f"lineitem_{attempt}", source_column="l_shipdate",
            year_column="event_year", month_column="event_month", partition_by=("event_year", "event_month"),
        )
        return jobs.raw_to_bronze(self.spark, self.lineitem_spec("lineitem_csv", "raw_for_reads", bronze=bronze)).rows

    def json_landing(self, attempt: int) -> int:
        spec = DatasetSpec(name="part", format="json", landing=self.at("part_json"), raw=self.at(f"part_{attempt}"), evolution="add_new_columns")
        return jobs.landing_to_raw(self.spark, spec).rows

    def many_headers(self, attempt: int) -> int:
        spec = DatasetSpec(name="supplier", landing=self.at("many_headers"), raw=self.at(f"supplier_{attempt}"), evolution="add_new_columns")
        return jobs.landing_to_raw(self.spark, spec).rows

    def many_pending_batches(self, attempt: int) -> int:
        bronze = BronzeSpec(
            path=self.at(f"pending_bronze_{attempt}"), source_column="o_orderdate", year_column="event_year", month_column="event_month",
            partition_by=("event_year", "event_month"),
        )
        return jobs.raw_to_bronze(self.spark, self.pending.with_(bronze=bronze)).rows

    def message_decode(self, attempt: int) -> int:
        spec = DatasetSpec(name="events", kind="messages", raw=self.at("unused"), avro_schema=EVENT_MESSAGE, codec="json")
        messages = self.spark.read.parquet(self.at("topic"))
        jobs.shape_messages(messages, spec).write.format("noop").mode("overwrite").save()
        return 0

    def messages_to_raw(self, attempt: int) -> int:
        spec = DatasetSpec(
            name="events", kind="messages", raw=self.at(f"messages_{attempt}"), checkpoint=self.at(f"messages_checkpoint_{attempt}"),
            message_format="parquet", message_options={"path": self.at("topic")}, avro_schema=EVENT_MESSAGE, codec="json",
            partition_by=("ingestion_date", "kafka_topic"),
        )
        query = jobs.messages_to_raw(self.spark, spec, {"availableNow": True})
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    def layer_profile(self, attempt: int) -> int:
        raw = sources.read_raw(self.spark, self.lineitem_spec("lineitem_csv", "raw_for_reads"))
        return inspect.profile(raw).collect()[0].rows

    def pruned_read(self, attempt: int) -> int:
        month = sources.read_raw(self.spark, self.orders).where("year = 1996 and month = 3")
        return month.agg(F.count("*"), F.sum("o_totalprice")).first()[0]


JOBS = (
    "csv_snapshot", "csv_incremental_two_headers", "raw_to_bronze", "message_decode", "messages_to_raw", "layer_profile", "pruned_read",
    "json_landing", "many_headers", "many_pending_batches",
)


def main() -> None:
    spark = session()
    bench = Bench(spark)
    bench.prepare()
    measured = {name: timed(getattr(bench, name)) for name in JOBS}
    seconds = {name: round(m["seconds"], 3) for name, m in measured.items()}
    print(json.dumps({
        "metric": "total seconds of the headline jobs (median of repeats)",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "spread": {name: round(m["spread"], 3) for name, m in measured.items()},
        "rows": {name: m["result"] for name, m in measured.items() if m["result"]},
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
