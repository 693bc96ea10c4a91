"""Every operator over whole tables, and the same answer in SQL.

Each query takes a session and a directory of Parquet tables. What has to be landed, ingested
or registered first is made from those tables by Spark, in a scratch directory of its own.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline import listing, storage
from tierline.functions import derive
from tierline.operators import fixtures, inspect, ledger, sinks
from tierline.plans import jobs
from tierline.sources import files, layers
from tierline.spec import BronzeSpec, DatasetSpec, Field
from tierline.streaming import continuity, control

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DATABASE = "tierline_checks"
STAMP = "yyyy-MM-dd HH:mm:ss"
MICRO_STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"
MIDDLE_OF_ORDERS = "1998-01-01"
MIDDLE_OF_EVENTS = "2024-01-16"

ORDER_FIELDS = (
    Field("o_orderkey", "bigint"),
    Field("o_custkey", "bigint"),
    Field("o_orderstatus"),
    Field("o_totalprice", "double"),
    Field("o_orderdate", "timestamp", STAMP),
    Field("o_orderpriority"),
)
ORDER_COLUMNS = [f.name for f in ORDER_FIELDS]
EVENT_FIELDS = (
    Field("event_id", "bigint"),
    Field("ts", "timestamp", MICRO_STAMP),
    Field("user_id", "bigint"),
    Field("event_type"),
    Field("value", "double"),
)


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL if there is one."""

    def add(function: Query) -> Query:
        if function.__name__ in QUERIES:
            raise ValueError(f"a query {function.__name__} is registered already")
        QUERIES[function.__name__] = function
        if oracle:
            ORACLES[function.__name__] = oracle
        return function

    return add


class Site:
    """The given tables, and a scratch place with landing, raw, bronze and archive."""

    def __init__(self, spark: SparkSession, sf_dir: str, label: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self.root = storage.scratch(spark, label)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def at(self, name: str) -> str:
        return f"{self.root}/{name}"

    def land(self, df: DataFrame, fmt: str = "csv", stamp: str = STAMP, landing: str = "landing", partition_by=()) -> None:
        options = {"header": "true", "timestampNTZFormat": stamp} if fmt == "csv" else {}
        writer = df.write.mode("append").format(fmt).options(**options)
        (writer.partitionBy(*partition_by) if partition_by else writer).save(self.at(landing))

    def orders(self, table: str | None = None, **changes) -> DatasetSpec:
        """Orders as CSV, raw by year and month, bronze by event year and month."""
        return DatasetSpec(
            name="orders", landing=self.at("landing"), raw=self.at("raw"), archive=self.at("archive"), checkpoint=self.at("checkpoint"),
            fields=ORDER_FIELDS, partition_by=("year", "month"), date_source="o_orderdate", evolution="add_new_columns",
            bronze=self.bronze("o_orderdate", table),
        ).with_(**changes)

    def bronze(self, source_column: str, table: str | None = None) -> BronzeSpec:
        return BronzeSpec(
            path=self.at("bronze"), database=DATABASE, table=table, source_column=source_column, year_column="event_year",
            month_column="event_month", partition_by=("event_year", "event_month"), checkpoint=self.at("bronze_checkpoint"),
        )


def _table_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"


def _money(column: str) -> Column:
    """A sum that does not depend on the order of addition."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


def _before(column: str, moment: str) -> Column:
    return F.col(column) < F.lit(moment).cast("timestamp_ntz")


def _as_orders(df: DataFrame) -> DataFrame:
    return df.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")).select(*ORDER_COLUMNS)


_MONEY_SQL = "cast(sum(cast({} as decimal(18,2))) as double)"
_ORDERS_BY_MONTH_SQL = (
    "select cast(year(o_orderdate) as integer) as {0}, cast(month(o_orderdate) as integer) as {1}, count(*) as n, "
    + _MONEY_SQL.format("o_totalprice") + " as total from orders {2} group by 1, 2"
)
_ORDERS_SQL = "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders"


def _by_month(df: DataFrame, year: str, month: str) -> DataFrame:
    return df.groupBy(year, month).agg(F.count(F.lit(1)).alias("n"), _money("o_totalprice").alias("total"))


# --- scans and landing -> raw -------------------------------------------------------------


@query(
    "select o_orderkey, cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month, "
    "cast(day(o_orderdate) as integer) as day from orders"
)
def raw_date_parts(spark, sf_dir):
    """P3."""
    orders = Site(spark, sf_dir, "date_parts").table("orders")
    return derive.date_parts(orders, "o_orderdate", derive.listed_parts(["year", "month", "day"])).select("o_orderkey", "year", "month", "day")


@query(_ORDERS_BY_MONTH_SQL.format("year", "month", ""))
def csv_landing_to_raw(spark, sf_dir):
    """Orders as CSV, into raw as a snapshot."""
    site = Site(spark, sf_dir, "csv")
    site.land(site.table("orders"))
    spec = site.orders()
    jobs.landing_to_raw(spark, spec)
    return _by_month(layers.read_raw(spark, spec), "year", "month")


@query(
    "select cast(year(l_shipdate) as integer) as year, cast(month(l_shipdate) as integer) as month, l_returnflag, count(*) as n, "
    + _MONEY_SQL.format("l_extendedprice") + " as total from lineitem group by 1, 2, 3"
)
def lineitem_raw_by_month(spark, sf_dir):
    """The largest table, rebalanced so that a month is few files however hot it is."""
    site = Site(spark, sf_dir, "lineitem")
    lineitem = site.table("lineitem")
    site.land(lineitem)
    fields = tuple(Field(f.name, "timestamp" if f.name == "l_shipdate" else f.dataType.simpleString()) for f in lineitem.schema)
    spec = site.orders(name="lineitem", fields=fields, date_source="l_shipdate", bronze=None)
    jobs.landing_to_raw(spark, spec)
    raw = layers.read_raw(spark, spec)
    return raw.groupBy("year", "month", "l_returnflag").agg(F.count(F.lit(1)).alias("n"), _money("l_extendedprice").alias("total"))


@query(
    "select o_orderkey, o_totalprice, cast(month(o_orderdate) as integer) as month from orders where year(o_orderdate) = 1996"
)
def raw_partition_pruned(spark, sf_dir):
    """One year of raw; other years' directories are not read."""
    site = Site(spark, sf_dir, "pruned")
    site.land(site.table("orders"))
    spec = site.orders()
    jobs.landing_to_raw(spark, spec)
    return layers.read_raw(spark, spec).where("year = 1996").select("o_orderkey", "o_totalprice", "month")


@query(_ORDERS_BY_MONTH_SQL.format("year", "month", f"where o_orderdate >= timestamp '{MIDDLE_OF_ORDERS}'"))
def snapshot_replaces(spark, sf_dir):
    """K1: a second snapshot takes the place of the first."""
    site = Site(spark, sf_dir, "snapshot")
    orders, spec = site.table("orders"), site.orders()
    early = _before("o_orderdate", MIDDLE_OF_ORDERS)
    for part in (orders.where(early), orders.where(~early)):
        site.land(part)
        jobs.landing_to_raw(spark, spec)
    return _by_month(layers.read_raw(spark, spec), "year", "month")


@query("select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def json_landing_nested(spark, sf_dir):
    """Nested records in and out of JSON."""
    site = Site(spark, sf_dir, "json")
    nested = site.table("customer").select(
        "c_custkey",
        F.struct("c_name", F.struct("c_nationkey", "c_mktsegment").alias("place")).alias("profile"),
        "c_acctbal",
    )
    site.land(nested, "json")
    fields = (
        Field("c_custkey", "bigint"),
        Field("profile", "struct<c_name:string,place:struct<c_nationkey:int,c_mktsegment:string>>"),
        Field("c_acctbal", "double"),
    )
    spec = DatasetSpec(name="customer", landing=site.at("landing"), raw=site.at("raw"), format="json", fields=fields)
    jobs.landing_to_raw(spark, spec)
    raw = layers.read_raw(spark, spec)
    return raw.select("c_custkey", "profile.c_name", "profile.place.c_nationkey", "c_acctbal", "profile.place.c_mktsegment")


@query("select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def parquet_landing(spark, sf_dir):
    """S3."""
    site = Site(spark, sf_dir, "parquet")
    site.land(site.table("supplier"), "parquet")
    spec = DatasetSpec(name="supplier", landing=site.at("landing"), raw=site.at("raw"), format="parquet", evolution="add_new_columns")
    jobs.landing_to_raw(spark, spec)
    return layers.read_raw(spark, spec).select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")


_PAGE_LINE = "url || chr(9) || html"


@query(f"select unnest(regexp_split_to_array({_PAGE_LINE}, '\\r\\n|\\n|\\r')) as value from pages")
def text_landing(spark, sf_dir):
    """Addresses and whole pages, line by line."""
    site = Site(spark, sf_dir, "text")
    site.land(site.table("pages").select(F.concat_ws("\t", "url", "html")), "text")
    return files.read_files(spark, DatasetSpec(name="urls", landing=site.at("landing"), raw=site.at("raw"), format="text")).select("value")


@query(f"select cast(sum(octet_length(encode({_PAGE_LINE})) + 1) as bigint) as total_bytes, true as lengths_agree from pages")
def binary_landing(spark, sf_dir):
    """File contents as bytes."""
    site = Site(spark, sf_dir, "binary")
    site.land(site.table("pages").select(F.concat_ws("\t", "url", "html")), "text")
    spec = DatasetSpec(name="blobs", landing=site.at("landing"), raw=site.at("raw"), format="binaryFile")
    blobs = files.read_files(spark, spec)
    return blobs.agg(
        F.sum(F.octet_length("content")).alias("total_bytes"),
        F.bool_and(F.octet_length("content") == F.col("length")).alias("lengths_agree"),
    )


@query("select distinct c_mktsegment as segment, true as has_bytes from customer")
def file_listing(spark, sf_dir):
    """M5: files under a directory tree, without reading them."""
    site = Site(spark, sf_dir, "listing")
    site.land(site.table("customer"), "parquet", partition_by=["c_mktsegment"])
    listed = inspect.list_files(spark, site.at("landing"))
    segment = F.regexp_extract("path", "c_mktsegment=([^/]+)/", 1)
    return listed.groupBy(segment.alias("segment")).agg((F.min("length") > 0).alias("has_bytes"))


@query("select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice from part")
def inferred_columns(spark, sf_dir):
    """H2, H4: one declared column, the others inferred."""
    site = Site(spark, sf_dir, "inferred")
    site.land(site.table("part"))
    spec = DatasetSpec(
        name="part", landing=site.at("landing"), raw=site.at("raw"), fields=(Field("p_partkey", "bigint"),),
        evolution="add_new_columns", infer_types=True,
    )
    return files.read_files(spark, spec).drop("source_filename")


@query("select o_orderstatus, count(*) as n from orders group by 1")
def processed_files(spark, sf_dir):
    """A2, F2: rows per ingested file, added up per directory they came from."""
    site = Site(spark, sf_dir, "processed")
    site.land(site.table("orders"), partition_by=["o_orderstatus"])
    spec = site.orders(
        fields=tuple(f for f in ORDER_FIELDS if f.name != "o_orderstatus"), reader_options={"recursiveFileLookup": "true"}, bronze=None
    )
    jobs.landing_to_raw(spark, spec)
    per_file = ledger.processed_files(layers.read_raw(spark, spec))
    status = F.regexp_extract("source_filename", "o_orderstatus=([^/]+)/", 1)
    return per_file.groupBy(status.alias("o_orderstatus")).agg(F.sum("rows").alias("n"))


# --- evolution and incremental intake ------------------------------------------------------


def _evolved_events(site: Site) -> DatasetSpec:
    """Early events without a promo code; later ones with it, in another column order."""
    events = site.table("events").select("event_id", "ts", "user_id", "event_type", "value")
    spec = DatasetSpec(
        name="events", landing=site.at("landing"), raw=site.at("raw"), archive=site.at("archive"), checkpoint=site.at("checkpoint"),
        mode="append", fields=EVENT_FIELDS, evolution="add_new_columns", partition_by=("year", "month", "day"), date_source="ts",
    )
    early = _before("ts", MIDDLE_OF_EVENTS)
    later = events.where(~early).select("value", F.col("event_type").alias("promo_code"), "event_id", "event_type", "ts", "user_id")
    for part in (events.where(early), later):
        site.land(part, stamp=MICRO_STAMP)
        jobs.landing_to_raw(site.spark, spec)
    return spec


@query(
    "select event_id, ts, user_id, event_type, value, "
    f"case when ts >= timestamp '{MIDDLE_OF_EVENTS}' then event_type end as promo_code from events"
)
def schema_evolution_union(spark, sf_dir):
    """A column that appears later, in files whose header is reordered."""
    raw = layers.read_raw(spark, _evolved_events(Site(spark, sf_dir, "evolution")))
    return raw.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "promo_code")


@query(
    "select cast(month(o_orderdate) as integer) as month, count(*) as n, " + _MONEY_SQL.format("o_totalprice") + " as total, "
    "count(*) as marked, cast(min(month(o_orderdate) * 100 + o_orderkey % 7) as bigint) as least from orders group by 1"
)
def many_headers_one_scan(spark, sf_dir):
    """H3, H4: twelve headers, each with its own order of columns and a column of its own, types inferred."""
    site = Site(spark, sf_dir, "headers")
    orders = _as_orders(site.table("orders"))
    for month in range(1, 13):
        own = orders.where(F.month("o_orderdate") == month).withColumn(f"mark_{month}", F.lit(month * 100) + F.col("o_orderkey") % 7)
        site.land(own.select(*own.columns[month % 7:], *own.columns[:month % 7]))
    jobs.landing_to_raw(spark, site.orders(infer_types=True))
    raw = layers.read_raw(spark, site.orders())
    marks = [F.col(f"mark_{month}").cast("bigint") for month in range(1, 13)]
    return raw.groupBy("month").agg(
        F.count(F.lit(1)).alias("n"), _money("o_totalprice").alias("total"), F.count(F.coalesce(*marks)).alias("marked"), F.min(F.coalesce(*marks)).alias("least")
    )


@query(
    "select 'event_id' as column_name, count(*) as rows, count(event_id) as non_null from events union all "
    "select 'ts', count(*), count(ts) from events union all "
    f"select 'promo_code', count(*), count(case when ts >= timestamp '{MIDDLE_OF_EVENTS}' then event_type end) from events"
)
def evolution_report(spark, sf_dir):
    """The columns that exist, and how many rows have the new one."""
    spec = _evolved_events(Site(spark, sf_dir, "report"))
    found = inspect.report(spark, spec, "raw", columns=["event_id", "ts", "promo_code", "coupon"])
    return found.profile.select("column_name", "rows", "non_null")


@query(_ORDERS_SQL)
def incremental_two_runs(spark, sf_dir):
    """Two arrivals and three runs; each row once."""
    site = Site(spark, sf_dir, "incremental")
    orders, spec = site.table("orders"), site.orders(mode="append")
    early = _before("o_orderdate", MIDDLE_OF_ORDERS)
    for part in (orders.where(early), orders.where(~early)):
        site.land(part)
        jobs.landing_to_raw(spark, spec)
    jobs.landing_to_raw(spark, spec)
    return _as_orders(layers.read_raw(spark, spec))


@query("select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def relanded_names_are_skipped(spark, sf_dir):
    """Files that come back under names already ingested stay in landing and out of raw."""
    site = Site(spark, sf_dir, "relanded")
    customer = site.table("customer")
    site.land(customer)
    spec = DatasetSpec(
        name="customer", landing=site.at("landing"), raw=site.at("raw"), archive=site.at("archive"), checkpoint=site.at("checkpoint"),
        mode="append", fields=tuple(Field(f.name, f.dataType.simpleString()) for f in customer.schema),
    )
    first = jobs.landing_to_raw(spark, spec)
    ledger.archive(spark, inspect.list_files(spark, spec.archive), spec.landing)
    second = jobs.landing_to_raw(spark, spec)
    if (first.status, second.status, second.skipped) != ("ok", "partial", first.files):
        raise RuntimeError(f"expected every file to be skipped the second time, got {first} and {second}")
    return layers.read_raw(spark, spec).select(*customer.columns)


@query("select 'file:///landing/part%20' || event_id || '+x.csv' as source_filename, 'arch/part ' || event_id || '+x.csv' as archived_as from events")
def archive_plan(spark, sf_dir):
    """Where each processed file goes; names decoded, a plus sign kept."""
    uris = Site(spark, sf_dir, "plan").table("events").select(
        F.concat(F.lit("file:///landing/part%20"), F.col("event_id").cast("string"), F.lit("+x.csv")).alias("source_filename")
    )
    return ledger.archive_plan(uris, "arch").select("source_filename", "archived_as")


# --- what arrives over time ----------------------------------------------------------------


_PART_SQL = (
    "select p_partkey, case when p_partkey % 3 = 0 then p_size end as size, case when p_partkey % 3 = 2 then cast(p_size + 0.5 as varchar) end as size_text "
    "from part"
)


def _inferred_arrivals(site: Site, fmt: str) -> DataFrame:
    """Parts in three arrivals where a column is whole, missing, then fractional; types are inferred."""
    part = site.table("part")
    spec = DatasetSpec(
        name="part", format=fmt, landing=site.at("landing"), raw=site.at("raw"), archive=site.at("archive"), checkpoint=site.at("checkpoint"),
        mode="append", evolution="add_new_columns", infer_types=True,
    )
    shapes = (F.col("p_size"), F.lit(None).cast("int"), F.col("p_size") + 0.5)
    for turn, size in enumerate(shapes):
        rows = part.where(F.col("p_partkey") % 3 == turn).select("p_partkey", size.alias("size"))
        rows.write.mode("append").format(fmt).options(header="true", ignoreNullFields="false").save(site.at("landing"))
        jobs.landing_to_raw(site.spark, spec)
    if jobs.landing_to_raw(site.spark, spec).status != "empty":
        raise RuntimeError("a run without new files found some")
    return layers.read_raw(site.spark, spec).select(F.col("p_partkey").cast("long").alias("p_partkey"), "size", "size_text")


@query(_PART_SQL)
def inferred_two_arrivals(spark, sf_dir):
    """H4: CSV; a column keeps its first type, and the text of what does not fit."""
    return _inferred_arrivals(Site(spark, sf_dir, "inferred"), "csv").withColumn("size", F.col("size").cast("int"))


@query(_PART_SQL)
def inferred_two_arrivals_json(spark, sf_dir):
    """H4, S2."""
    return _inferred_arrivals(Site(spark, sf_dir, "inferred_json"), "json").withColumn("size", F.col("size").cast("int"))


@query("select o_orderkey, 1 as times from orders")
def two_snapshots_one_promotion(spark, sf_dir):
    """A snapshot that another replaces is kept until bronze has it."""
    site = Site(spark, sf_dir, "two_snapshots")
    spec = site.orders()
    orders = site.table("orders")
    early = _before("o_orderdate", MIDDLE_OF_ORDERS)
    for part in (orders.where(early), orders.where(~early)):
        site.land(part)
        jobs.landing_to_raw(spark, spec)
    jobs.raw_to_bronze(spark, spec)
    return layers.read_bronze(spark, spec).groupBy("o_orderkey").agg(F.count(F.lit(1)).cast("int").alias("times"))


@query(f"select o_orderkey, o_totalprice from orders where o_orderdate >= timestamp '{MIDDLE_OF_ORDERS}'")
def snapshot_replaces_few_files_at_a_time(spark, sf_dir):
    """The second snapshot is what raw holds, read a few files at a time."""
    site = Site(spark, sf_dir, "replaces")
    spec = site.orders(max_files_per_trigger=3, bronze=None)
    orders = site.table("orders").repartition(8)
    early = _before("o_orderdate", MIDDLE_OF_ORDERS)
    for part in (orders.where(early), orders.where(~early)):
        site.land(part)
        jobs.landing_to_raw(spark, spec)
    return layers.read_raw(spark, spec).select("o_orderkey", "o_totalprice")


@query(
    "select cast(year(l_shipdate) as integer) as event_year, cast(month(l_shipdate) as integer) as event_month, count(*) as n, "
    "1 as directories from lineitem group by 1, 2"
)
def bronze_rewritten(spark, sf_dir):
    """K4: several arrivals folded into one directory per month."""
    site = Site(spark, sf_dir, "rewritten")
    lineitem = site.table("lineitem")
    fields = tuple(Field(f.name, "timestamp" if f.name == "l_shipdate" else f.dataType.simpleString()) for f in lineitem.schema)
    spec = DatasetSpec(
        name="lineitem", landing=site.at("landing"), raw=site.at("raw"), archive=site.at("archive"), checkpoint=site.at("checkpoint"), fields=fields,
        mode="append", evolution="add_new_columns", bronze=site.bronze("l_shipdate"),
    )
    for turn in range(3):
        site.land(lineitem.where(F.col("l_orderkey") % 3 == turn))
        jobs.landing_to_raw(spark, spec)
        jobs.raw_to_bronze(spark, spec)
    jobs.rewrite_bronze(spark, spec)
    found = layers.read_bronze(spark, spec).withColumn("batch", F.col(ledger.BATCH))
    return found.groupBy("event_year", "event_month").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("batch").cast("int").alias("directories")
    )


@query(
    "select cast(year(l_shipdate) as integer) as event_year, cast(month(l_shipdate) as integer) as event_month, count(*) as n, "
    + _MONEY_SQL.format("l_extendedprice") + " as total, cast(count(distinct l_orderkey % 20 < 17) as integer) as directories from lineitem group by 1, 2"
)
def bronze_compacted(spark, sf_dir):
    """K8: three small arrivals folded into one batch, the large one before them left alone."""
    site = Site(spark, sf_dir, "compacted")
    lineitem = site.table("lineitem")
    fields = tuple(Field(f.name, "timestamp" if f.name == "l_shipdate" else f.dataType.simpleString()) for f in lineitem.schema)
    spec = DatasetSpec(
        name="lineitem", landing=site.at("landing"), raw=site.at("raw"), archive=site.at("archive"), checkpoint=site.at("checkpoint"), fields=fields,
        mode="append", bronze=replace(site.bronze("l_shipdate"), partition_by=("event_year",)),
    )
    for low, high in ((0, 17), (17, 18), (18, 19), (19, 20)):
        site.land(lineitem.where(F.col("l_orderkey") % 20 >= low).where(F.col("l_orderkey") % 20 < high))
        jobs.landing_to_raw(spark, spec)
        jobs.raw_to_bronze(spark, spec)
    large, *small = ledger.state(spark, spec.bronze.path).batch_ids
    listed = storage.listing(spark, spec.bronze.path, {"recursiveFileLookup": "true"}).where(F.col("path").rlike("|".join(small)))
    jobs.compact_bronze(spark, spec, target_bytes=listed.agg(F.sum("length")).first()[0])
    found = layers.read_bronze(spark, spec).withColumn("batch", F.col(ledger.BATCH))
    return found.groupBy("event_year", "event_month").agg(
        F.count(F.lit(1)).alias("n"), _money("l_extendedprice").alias("total"), F.count_distinct("batch").cast("int").alias("directories")
    )


@query("select o_orderstatus, count(*) as n from orders where o_orderkey % 1500 < 1200 group by 1")
def many_batches_chosen(spark, sf_dir):
    """1,200 of 1,500 committed batches, by a literal filter on the batch column."""
    site = Site(spark, sf_dir, "many")
    orders = site.table("orders").withColumn(ledger.BATCH, F.format_string("b%04d", F.col("o_orderkey") % 1500))
    # the batches as one partitioned write, and a commit row for each
    orders.repartition(8, ledger.BATCH).write.partitionBy(ledger.BATCH).parquet(site.at("raw"))
    schema = site.table("orders").schema.json()
    commits = orders.select(ledger.BATCH).distinct().select(
        F.substring(ledger.BATCH, 2, 4).cast("long").alias("version"), F.col(ledger.BATCH).alias("batch_id"), F.current_timestamp().alias("timestamp"),
        F.lit("append").alias("operation"), F.lit(schema).alias("table_schema"), *[
            F.create_map(F.lit("rows"), F.lit("0")).alias(c) for c in ("operationParameters", "operationMetrics")
        ],
    )
    commits.coalesce(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(f"{ledger.commit_path(site.at('raw'))}/gen=0")
    chosen = [f"b{i:04d}" for i in range(1200)]
    there = set(ledger.batch_dirs(spark, site.at("raw")))
    df = layers.read_layer(spark, site.at("raw"), batch_ids=[b for b in chosen if b in there])
    return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "select o_orderpriority as priority, cast(month(o_orderdate) as integer) as month, cast(0 as bigint) as full_files, cast(1 as bigint) as empty_files "
    "from orders where o_totalprice < 0 union all "
    "select o_orderpriority, cast(month(o_orderdate) as integer), cast(count(distinct o_custkey % 3) as bigint), "
    "cast(count(distinct case when o_custkey % 3 = 0 then o_custkey % 5 end) as bigint) from orders group by 1, 2"
)
def file_listing_with_empty(spark, sf_dir):
    """M5: a tree of files of orders, by priority and month, some of them without content."""
    site = Site(spark, sf_dir, "listing")
    orders = site.table("orders").withColumns({"priority": F.col("o_orderpriority"), "month": F.month("o_orderdate"), "third": F.col("o_custkey") % 3})
    orders.repartition("priority", "month", "third").write.partitionBy("priority", "month", "third").json(site.at("dir"))
    marks = orders.where("third = 0").select("priority", "month", (F.col("o_custkey") % 5).alias("mark")).distinct()

    root = site.at("dir")

    def touch(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield listing.touched(root, f"priority={row['priority']}/month={row['month']}/third=0/none +{row['mark']}.json")

    marks.mapInArrow(touch, "path string").write.format("noop").mode("overwrite").save()
    found = inspect.list_files(spark, site.at("dir")).where(F.col("path").endswith(".json"))
    part = [F.url_decode(F.regexp_extract("path", f"{name}=([^/]+)/", 1)).alias(name) for name in ("priority", "month")]
    return found.select(*part, "length").groupBy("priority", F.col("month").cast("int").alias("month")).agg(
        F.count_if(F.col("length") > 0).alias("full_files"), F.count_if(F.col("length") == 0).alias("empty_files")
    )


@query("select o_orderkey, o_orderdate as placed, cast(o_orderdate as date) as day from orders")
def two_timestamp_patterns(spark, sf_dir):
    """H7, H8: columns with patterns of their own, in files with another delimiter."""
    site = Site(spark, sf_dir, "patterns")
    orders = site.table("orders").select(
        "o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy HH:mm").alias("placed"), F.date_format("o_orderdate", "yyyyMMdd").alias("day")
    )
    orders.write.options(header="true", sep=";").csv(site.at("landing"))
    spec = DatasetSpec(
        name="orders", landing=site.at("landing"), raw=site.at("raw"), reader_options={"delimiter": ";"},
        fields=(Field("o_orderkey", "bigint"), Field("placed", "timestamp", "dd/MM/yyyy HH:mm"), Field("day", "timestamp", "yyyyMMdd")),
    )
    found = files.read_files(spark, spec)
    return found.select("o_orderkey", F.col("placed").cast("timestamp_ntz").alias("placed"), F.col("day").cast("date").alias("day"))


@query("select column_name, present from (values ('o_orderkey', true), ('coupon', false)) t(column_name, present) where (select count(*) from orders) > 0")
def column_check(spark, sf_dir):
    """P5: what is asked for and not there fails before anything is written."""
    orders = Site(spark, sf_dir, "columns").table("orders")

    def present(name: str) -> bool:
        try:
            derive.require_columns(orders, [name])
            return True
        except derive.MissingColumns:
            return False

    found = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(present(c)).alias("present")) for c in ("o_orderkey", "coupon")])
    return orders.agg(F.count(F.lit(1)).alias("n")).where("n > 0").select(F.inline(found))


@query("select event_id, user_id, props, event_type from events")
def continuous_messages(spark, sf_dir):
    """A stream without a trigger keeps running until it is stopped."""
    site = Site(spark, sf_dir, "continuous")
    spec = _event_messages(site)
    wanted = site.table("events").count()
    running = jobs.messages_to_raw(spark, spec)
    try:
        while running.isActive and not (storage.exists(spark, f"{spec.raw}/_spark_metadata") and layers.read_raw(spark, spec).count() >= wanted):
            running.processAllAvailable()
    finally:
        running.stop()
    return layers.read_raw(spark, spec).select("event_id", "user_id", "props", F.col("kafka_key").alias("event_type"))


# --- raw -> bronze -------------------------------------------------------------------------


def _two_arrivals(site: Site, spec: DatasetSpec, first=None, second=None) -> None:
    """Orders in two arrivals, each brought through to bronze."""
    orders = site.table("orders")
    early = _before("o_orderdate", MIDDLE_OF_ORDERS)
    for part, shape in ((orders.where(early), first), (orders.where(~early), second)):
        site.land(part.select(*shape) if shape else part)
        jobs.landing_to_raw(site.spark, spec)
        jobs.raw_to_bronze(site.spark, spec)


@query(_ORDERS_SQL)
def raw_to_bronze_twice(spark, sf_dir):
    """Promotion run again finds nothing new."""
    site = Site(spark, sf_dir, "twice")
    spec = site.orders(mode="append")
    _two_arrivals(site, spec)
    jobs.raw_to_bronze(spark, spec)
    return _as_orders(layers.read_bronze(spark, spec))


@query(_ORDERS_BY_MONTH_SQL.format("event_year", "event_month", ""))
def bronze_table_registered(spark, sf_dir):
    """The external table over bronze."""
    site = Site(spark, sf_dir, "table")
    spec = site.orders(_table_name("orders"), mode="append")
    _two_arrivals(site, spec)
    if not inspect.table_exists(spark, spec.bronze.full_table):
        raise RuntimeError(f"{spec.bronze.full_table} was not registered")
    return _by_month(layers.read_bronze(spark, spec), "event_year", "event_month")


@query(_ORDERS_BY_MONTH_SQL.format("event_year", "event_month", ""))
def bronze_table_rebuilt(spark, sf_dir):
    """Dropped, then registered again with the partitions of every batch."""
    site = Site(spark, sf_dir, "rebuilt")
    spec = site.orders(_table_name("orders"), mode="append")
    orders = site.table("orders")
    early = _before("o_orderdate", MIDDLE_OF_ORDERS)
    for part in (orders.where(early), orders.where(~early)):
        site.land(part)
        sinks.drop_table(spark, spec.bronze.full_table)
        jobs.landing_to_raw(spark, spec)
        jobs.raw_to_bronze(spark, spec)
    return _by_month(spark.table(spec.bronze.full_table), "event_year", "event_month")


@query(
    "select o_orderkey, o_totalprice, "
    f"case when o_orderdate >= timestamp '{MIDDLE_OF_ORDERS}' then o_orderpriority end as o_orderpriority from orders"
)
def bronze_schema_growth(spark, sf_dir):
    """H5: bronze and its table gain a column that the first arrival did not have."""
    site = Site(spark, sf_dir, "growth")
    spec = site.orders(_table_name("growing"), mode="append", fields=ORDER_FIELDS[:-1])
    _two_arrivals(site, spec, first=ORDER_COLUMNS[:-1])
    return spark.table(spec.bronze.full_table).select("o_orderkey", "o_totalprice", "o_orderpriority")


@query(
    f"select cast(0 as bigint) as version, 'append' as operation, count(*) as rows from orders where o_orderdate < timestamp '{MIDDLE_OF_ORDERS}' "
    f"union all select 1, 'append', count(*) from orders where o_orderdate >= timestamp '{MIDDLE_OF_ORDERS}'"
)
def bronze_history(spark, sf_dir):
    """What was committed, and how much."""
    site = Site(spark, sf_dir, "history")
    spec = site.orders(mode="append")
    _two_arrivals(site, spec)
    found = inspect.report(spark, spec, "bronze").history
    return found.select("version", "operation", F.col("operationMetrics")["rows"].cast("long").alias("rows"))


@query(
    "select cast(year(ts) as integer) as event_year, cast(month(ts) as integer) as event_month, event_type, count(*) as n from events group by 1, 2, 3"
)
def bronze_stream_by_month(spark, sf_dir):
    """Raw files another writer made, followed as a stream into bronze."""
    site = Site(spark, sf_dir, "stream")
    site.land(site.table("events"), "parquet", landing="raw")
    spec = DatasetSpec(name="events", landing=site.at("landing"), raw=site.at("raw"), bronze=site.bronze("ts"))
    jobs.raw_to_bronze(spark, spec)
    jobs.raw_to_bronze(spark, spec)
    return layers.read_bronze(spark, spec).groupBy("event_year", "event_month", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "select 'customer' as dataset, 'ok' as status, count(*) as rows from customer union all "
    "select 'part', 'ok', count(*) from part union all select 'supplier', 'ok', count(*) from supplier"
)
def run_report(spark, sf_dir):
    """One job over datasets of several formats, and its report."""
    site = Site(spark, sf_dir, "run")
    specs = {}
    for name, fmt in (("customer", "csv"), ("part", "json"), ("supplier", "parquet")):
        site.land(site.table(name), fmt, landing=f"landing/{name}")
        specs[name] = DatasetSpec(
            name=name, format=fmt, landing=site.at(f"landing/{name}"), raw=site.at(f"raw/{name}"),
            archive=site.at(f"archive/{name}"), evolution="add_new_columns",
        )
    return jobs.run(spark, specs, "landing_to_raw").select("dataset", "status", "rows")


# --- messages ------------------------------------------------------------------------------


EVENT_MESSAGE = json.dumps({
    "type": "record",
    "name": "Event",
    "fields": [
        {"name": "event_id", "type": "long"},
        {"name": "event_type", "type": "string"},
        {"name": "at", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "value", "type": ["null", "double"]},
        {"name": "user_id", "type": "long"},
        {"name": "props", "type": ["null", "string"]},
        {"name": "kafka_topic", "type": "string"},
    ],
})


def _event_messages(site: Site) -> DatasetSpec:
    """Events as keyed messages, one topic per event type, in files that stand in for the broker."""
    events = site.table("events").select(
        F.col("event_id").alias("message_no"),
        "event_id",
        "event_type",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"),
        "value",
        "user_id",
        "props",
    )
    payload_rows = events.select(
        "message_no", "event_id", "event_type", F.floor(F.col("micros") / 1000).alias("at"), "value", "user_id", "props",
        F.concat(F.lit("said-"), "event_type").alias("kafka_topic"),
    )
    topic = F.concat(F.lit("events-"), F.col("event_type"))
    fixtures.as_messages(payload_rows, topic, "event_type", "message_no").write.parquet(site.at("topic"))
    return DatasetSpec(
        name="events", kind="messages", raw=site.at("raw"), checkpoint=site.at("checkpoint"), message_format="parquet",
        message_options={"path": site.at("topic")}, avro_schema=EVENT_MESSAGE, codec="json", partition_by=("ingestion_date", "kafka_topic"),
        bronze=site.bronze("at"),
    )


@query(
    "select 'events-' || event_type as kafka_topic, event_type as kafka_key, count(*) as n, " + _MONEY_SQL.format("value") + " as total, "
    "min(date_trunc('milliseconds', ts)) as first_at, max(event_id) as last_offset from events group by 1, 2"
)
def message_envelope_stream(spark, sf_dir):
    """Messages decoded, flattened and written to raw as a stream."""
    spec = _event_messages(Site(spark, sf_dir, "messages"))
    jobs.run(spark, {"events": spec}, "messages_to_raw")
    return layers.read_raw(spark, spec).groupBy("kafka_topic", "kafka_key").agg(
        F.count(F.lit(1)).alias("n"),
        _money("value").alias("total"),
        F.min("at").cast("timestamp_ntz").alias("first_at"),
        F.max("kafka_offset").alias("last_offset"),
    )


@query("select event_id, 'events-' || event_type as kafka_topic, 'said-' || event_type as payload_kafka_topic from events")
def payload_collision(spark, sf_dir):
    """A payload field named like an envelope column keeps its value under a prefixed name."""
    site = Site(spark, sf_dir, "collision")
    spec = _event_messages(site)
    flat = jobs.shape_messages(spark.read.parquet(site.at("topic")), spec)
    return flat.select("event_id", "kafka_topic", "payload_kafka_topic")


@query(
    "select cast(year(ts) as integer) as event_year, cast(month(ts) as integer) as event_month, event_type, count(*) as n from events group by 1, 2, 3"
)
def messages_to_bronze(spark, sf_dir):
    """J2 after J3: the raw stream's own directory promoted to bronze, once."""
    spec = _event_messages(Site(spark, sf_dir, "telemetry"))
    jobs.run_message_pipelines(spark, [spec], control.AVAILABLE_NOW)
    jobs.run(spark, {"events": spec}, "raw_to_bronze")
    jobs.run(spark, {"events": spec}, "raw_to_bronze")
    return layers.read_bronze(spark, spec).groupBy("event_year", "event_month", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "select cast(year(ts) as integer) as event_year, cast(month(ts) as integer) as event_month, event_type, count(*) as n, "
    + _MONEY_SQL.format("value") + " as total, count(props) as with_props, min(date_trunc('milliseconds', ts)) as first_at from events group by 1, 2, 3"
)
def avro_messages_to_bronze(spark, sf_dir):
    """Messages with an Avro payload through raw to bronze."""
    site = Site(spark, sf_dir, "avro_messages")
    spec = _event_messages(site).with_(codec="avro", message_options={"path": site.at("avro_topic")})
    fixtures.avro_payload(spark.read.parquet(site.at("topic")), EVENT_MESSAGE).write.parquet(site.at("avro_topic"))
    jobs.run(spark, {"events": spec}, "messages_to_raw")
    jobs.run(spark, {"events": spec}, "raw_to_bronze")
    return layers.read_bronze(spark, spec).groupBy("event_year", "event_month", "event_type").agg(
        F.count(F.lit(1)).alias("n"), _money("value").alias("total"), F.count("props").alias("with_props"), F.min("at").cast("timestamp_ntz").alias("first_at")
    )


ORDER_RECORD = json.dumps({
    "type": "record",
    "name": "Order",
    "fields": [
        {"name": "o_orderkey", "type": "long"},
        {"name": "o_orderstatus", "type": "string"},
        {"name": "o_totalprice", "type": ["null", "double"]},
        {"name": "o_orderdate", "type": {"type": "long", "logicalType": "timestamp-micros"}},
        {"name": "tags", "type": {"type": "array", "items": "string"}},
    ],
})


@query(
    _ORDERS_BY_MONTH_SQL.format("year", "month", "").replace("as total", "as total, count(*) filter (where o_orderstatus = 'F') as filled")
)
def avro_landing_to_raw(spark, sf_dir):
    """Orders in Avro container files, in blocks, brought to raw by year and month."""
    site = Site(spark, sf_dir, "avro_landing")
    orders = site.table("orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("o_orderdate"),
        F.array("o_orderstatus", "o_orderpriority").alias("tags"),
    )
    fixtures.land_avro(orders.repartition(max(4, spark.sparkContext.defaultParallelism)), site.at("landing"), ORDER_RECORD)
    jobs.landing_to_raw(spark, site.orders(format="avro", fields=()))
    raw = layers.read_raw(spark, site.orders())
    return raw.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n"), _money("o_totalprice").alias("total"), F.count_if(F.get("tags", F.lit(0)) == "F").alias("filled")
    )


@query(
    "with m as (select 'events' as topic, cast(event_id % 4 as integer) as part, event_id // 4 as pos, event_id % 89 = 0 as twice from events where event_id % 97 <> 0 "
    "and event_id % 13 <> 5), "
    "a as (select * from m union all select * from m where twice) "
    'select topic, part as "partition", cast(max(pos) - min(pos) + 1 - count(distinct pos) as bigint) as missing, '
    "cast(count(*) - count(distinct pos) as bigint) as repeated from a group by 1, 2"
)
def message_continuity(spark, sf_dir):
    """Messages of four partitions in several micro-batches, some gone and some sent twice."""
    site = Site(spark, sf_dir, "continuity")
    messages = site.table("events").where("event_id % 97 <> 0 and event_id % 13 <> 5").select(
        F.lit("events").alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"), F.expr("event_id div 4").alias("offset"), "event_id"
    )
    # in three files by offset, what is sent twice once more in a fourth
    for turn in range(3):
        messages.where(F.expr("event_id % 30000 div 10000") == turn).drop("event_id").coalesce(1).write.mode("append").parquet(site.at("topic"))
    messages.where("event_id % 89 = 0").drop("event_id").coalesce(1).write.mode("append").parquet(site.at("topic"))
    stream = spark.readStream.schema("topic string, partition int, offset long").option("maxFilesPerTrigger", 1).parquet(site.at("topic"))
    found = continuity.findings(stream).writeStream.format("parquet").option("checkpointLocation", site.at("check"))
    control.run_streams(spark, [found.trigger(availableNow=True).start(site.at("found"))])
    size = F.col("last") - F.col("first") + 1

    def total(kind):
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, size)), F.lit(0).cast("long"))

    rows = spark.read.schema(continuity.FINDINGS).parquet(site.at("found")).groupBy("topic", "partition")
    return rows.agg((total("missing") - total("late")).alias("missing"), total("repeated").alias("repeated"))


@query(
    "select event_id as kafka_offset, event_type as kafka_key, cast(json_extract(props, '$.k') as integer) as k, "
    "strftime(ts, '%Y-%m-%d') as ingestion_date from events"
)
def payload_flatten_json(spark, sf_dir):
    """P6-P9 over a bounded set of messages."""
    from tierline.functions import payload

    events = Site(spark, sf_dir, "flatten").table("events")
    messages = events.select(
        F.col("event_type").cast("binary").alias("key"), F.col("props").cast("binary").alias("value"), F.lit("events").alias("topic"),
        F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    schema = json.dumps({"type": "record", "name": "Props", "fields": [{"name": "k", "type": "int"}]})
    flat = payload.flatten(payload.decode(payload.envelope(messages), schema, "json"), schema)
    dated = derive.ingestion_day(flat, ["ingestion_date"], moment="kafka_timestamp")
    return dated.select("kafka_offset", "kafka_key", "k", F.col("ingestion_date").cast("string").alias("ingestion_date"))


# --- inspection and repair -----------------------------------------------------------------


_EVENT_PROFILE_SQL = " union all ".join(
    f"select '{c}' as column_name, '{t}' as data_type, count(*) as rows, count({c}) as non_null, count(*) = 0 as is_empty from events"
    for c, t in (
        ("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"), ("value", "double"), ("props", "string"),
    )
)


@query(_EVENT_PROFILE_SQL)
def layer_profile(spark, sf_dir):
    """A1, A3, F1, L2: schema and counts of every column, from one pass."""
    events = Site(spark, sf_dir, "profile").table("events")
    schema = inspect.schema_df(events).select("column_name", "data_type")
    return inspect.profile(events).join(F.broadcast(schema), "column_name").select("column_name", "data_type", "rows", "non_null", "is_empty")


_LINEITEM_BOUNDS_SQL = " union all ".join(
    f"select '{c}' as column_name, count(*) as rows, count({c}) as non_null, cast(min({e}) as varchar) as least, cast(max({e}) as varchar) as most from lineitem"
    for c, e in (
        ("l_orderkey", "l_orderkey"), ("l_linenumber", "l_linenumber"), ("l_quantity", "cast(l_quantity as integer)"), ("l_shipdate", "cast(l_shipdate as date)"),
    )
)


@query(_LINEITEM_BOUNDS_SQL)
def committed_bounds(spark, sf_dir):
    """Rows, counts and bounds of a layer from its commit rows; its data is not read."""
    site = Site(spark, sf_dir, "bounds")
    lineitem = site.table("lineitem").withColumns({"l_shipdate": F.col("l_shipdate").cast("date"), "l_quantity": F.col("l_quantity").cast("int")})
    for turn in range(3):
        sinks.append_batch(lineitem.where(F.col("l_orderkey") % 3 == turn), site.at("raw"), f"turn-{turn}", ["l_returnflag"])
    names = ["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"]
    return inspect.committed_profile(spark, site.at("raw"), ["l_returnflag"]).where(F.col("column_name").isin(names)).drop("is_empty")


@query("select event_id, event_type, value from events order by event_id limit 10")
def layer_sample(spark, sf_dir):
    """L1: the ten-row look at a layer."""
    events = Site(spark, sf_dir, "sample").table("events")
    return inspect.sample(events, 10, ["event_id"]).select("event_id", "event_type", "value")


@query(
    "select count(o_orderkey) as o_orderkey, count(case when o_orderstatus = 'F' then o_orderpriority end) as urgency, count(o_totalprice) as o_totalprice from orders"
)
def non_null_counts(spark, sf_dir):
    """those of the asked-for columns that exist, in one pass."""
    orders = Site(spark, sf_dir, "non_null").table("orders")
    sparse = orders.withColumn("urgency", F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")))
    return inspect.non_null_counts(sparse, ["o_orderkey", "urgency", "o_totalprice", "coupon"])


@query("select c_custkey, c_mktsegment from customer")
def pick_existing(spark, sf_dir):
    """P10."""
    return inspect.pick_existing(Site(spark, sf_dir, "pick").table("customer"), ["c_custkey", "promo_code", "c_mktsegment"])


@query(
    "select o_orderkey, case when o_orderstatus = 'F' then o_orderdate end as by_rule, "
    "case when o_orderstatus = 'O' then o_orderdate end as by_pattern from orders"
)
def timestamp_repair(spark, sf_dir):
    """Text that is a timestamp becomes one; the rest becomes null."""
    orders = Site(spark, sf_dir, "repair").table("orders")
    text = (
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", STAMP))
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .otherwise("unknown")
    )
    df = orders.select("o_orderkey", text.alias("by_rule"), text.alias("by_pattern"))
    df = derive.ensure_timestamp(derive.ensure_timestamp(df, "by_rule"), "by_pattern", fmt="dd/MM/yyyy")
    return df.select("o_orderkey", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("by_rule", "by_pattern")])


@query(
    "select event_id, date_trunc('second', ts) as from_seconds, date_trunc('milliseconds', ts) as from_millis, ts as from_micros from events"
)
def epoch_repair(spark, sf_dir):
    """Numbers that count seconds, milliseconds or microseconds."""
    events = Site(spark, sf_dir, "epoch").table("events")
    moment = F.col("ts").cast("timestamp")
    df = events.select(
        "event_id", F.unix_seconds(moment).alias("from_seconds"), F.unix_millis(moment).alias("from_millis"), F.unix_micros(moment).alias("from_micros")
    )
    for unit in ("seconds", "millis", "micros"):
        df = derive.ensure_timestamp(df, f"from_{unit}", unit)
    return df.select("event_id", *[F.col(f"from_{u}").cast("timestamp_ntz").alias(f"from_{u}") for u in ("seconds", "millis", "micros")])


# --- flagship ------------------------------------------------------------------------------


@query(_ORDERS_BY_MONTH_SQL.format("event_year", "event_month", ""))
def orders_landing_to_bronze(spark, sf_dir):
    """J1 and J2 end to end: CSV orders through raw into the registered bronze table, by month."""
    site = Site(spark, sf_dir, "flagship")
    site.land(site.table("orders"))
    spec = site.orders(_table_name("orders"))
    jobs.landing_to_raw(spark, spec)
    jobs.raw_to_bronze(spark, spec)
    return _by_month(layers.read_bronze(spark, spec), "event_year", "event_month")
