"""Scans, previews and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from dayloom.operators.export import (
    csv_export, dated_export as export_day, ordered_export, parquet_overwrite_gzip as write_gzip,
)
from dayloom.operators.gates import count_rows as count_all
from dayloom.plans.inputs import AS_OF, FEATURE_LINE, ZONE_CTE, events_by_day, feature_file, spark_expr, zone_frame
from dayloom.plans.registry import query
from dayloom.session import read_given, scratch_database, scratch_folder
from dayloom.sources.files import read_csv, read_csv_apart, read_csv_columns, read_parquet, read_tsv
from dayloom.sources.tables import empty_like, first_available, preview, read_table, read_table_day

_EVENT_COLUMNS = "event_id, ts, user_id, event_type, value, props"
_ORDER_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string"
)
_EVENT_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string,"
    " data_date date"
)


@query(f"SELECT {_EVENT_COLUMNS} FROM events")
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/events.parquet")


@query(f"SELECT {_EVENT_COLUMNS}, CAST(ts AS DATE) AS data_date FROM events")
def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, events_by_day(spark, sf_dir))


@query(f"""
    SELECT {_EVENT_COLUMNS}, CAST(ts AS DATE) AS data_date FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-30'""")
def scan_table_one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table_day(spark, events_by_day(spark, sf_dir), AS_OF)


@query("SELECT count(*) AS n_rows FROM lineitem")
def count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_all(read_given(spark, sf_dir, "lineitem"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def limit_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_given(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return preview(orders, 5, F.desc("o_totalprice"), "o_orderkey")


@query("SELECT 1 AS source_idx, o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def first_available_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the first candidate is a view whose table is gone
    database = scratch_database(spark)
    read_given(spark, sf_dir, "region").write.saveAsTable(f"{database}.gone")
    spark.sql(f"CREATE OR REPLACE TEMP VIEW dayloom_candidate_0 AS SELECT * FROM {database}.gone")
    spark.sql(f"DROP TABLE {database}.gone")
    read_given(spark, sf_dir, "orders").createOrReplaceTempView("dayloom_candidate_1")
    position, rows = first_available(spark, [f"dayloom_candidate_{i}" for i in range(4)])
    counts = rows.groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return counts.select(F.lit(position).alias("source_idx"), "o_orderstatus", "n")


@query("SELECT event_type, count(*) AS n, max(event_id) AS last_event FROM events GROUP BY event_type")
def empty_with_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_given(spark, sf_dir, "events")
    seeded = empty_like(spark, events.schema).union(events)
    return seeded.groupBy("event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("last_event"))


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, path = read_given(spark, sf_dir, "customer"), scratch_folder(spark)
    customers.write.option("header", True).csv(path)
    # inference picks the narrowest type that fits
    return read_csv(spark, path).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query(f"WITH {ZONE_CTE} SELECT zip FROM zone")
def scan_csv_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark)
    zone_frame(spark, sf_dir).write.option("header", True).csv(path)
    return read_csv_columns(spark, path, "zip")


@query(f"WITH {ZONE_CTE} SELECT {FEATURE_LINE} AS _c0 FROM zone")
def scan_tsv_headerless(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_tsv(spark, feature_file(spark, sf_dir))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def csv_export_bzip2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark)
    csv_export(read_given(spark, sf_dir, "orders"), path)
    return read_csv(spark, path, schema=_ORDER_SCHEMA)


@query(f"SELECT {_EVENT_COLUMNS}, CAST(ts AS DATE) AS data_date FROM events")
def dated_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, events_by_day(spark, sf_dir))
    path = export_day(table, scratch_folder(spark), "events", AS_OF)
    return read_csv(spark, path, schema=_EVENT_SCHEMA)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def single_file_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark)
    ordered_export(read_given(spark, sf_dir, "orders"), path, "o_orderkey")
    return read_csv(spark, path, schema=_ORDER_SCHEMA)


@query("""
    SELECT o_orderkey, o_orderpriority,
           coalesce(lag(o_orderpriority) OVER (ORDER BY o_orderpriority) > o_orderpriority, false) AS falls_back
    FROM orders""")
def ordered_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few keys, each over several parts; no row may fall back behind the last one of the part before."""
    path = scratch_folder(spark)
    orders = read_given(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    ordered_export(orders, path, "o_orderpriority")
    schema = "o_orderkey bigint, o_orderpriority string"
    rows = read_csv(spark, path, schema=schema).select("*", F.col("_metadata.file_name").alias("part"))
    ends = rows.groupBy("part").agg(F.min("o_orderpriority").alias("low"), F.max("o_orderpriority").alias("high"))
    # one row per part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    falls = ends.select("part", F.coalesce(F.max("high").over(before) > F.col("low"), F.lit(False)).alias("falls_back"))
    return rows.join(falls, "part").drop("part")


@query(f"SELECT {_EVENT_COLUMNS} FROM events")
def parquet_overwrite_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark)
    write_gzip(read_given(spark, sf_dir, "events"), path)
    return read_parquet(spark, path)


@query("SELECT event_type, count(*) AS n, 3 AS n_files FROM events GROUP BY event_type")
def parquet_n_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark)
    write_gzip(read_given(spark, sf_dir, "events"), path, n_files=3)
    rows = read_parquet(spark, path).select("event_type", F.col("_metadata.file_name").alias("file"))
    n_files = rows.select("file").distinct().count()
    counts = rows.groupBy("event_type").agg(F.count("*").alias("n"))
    return counts.withColumn("n_files", F.lit(n_files))


_LINE = """CASE o_orderkey % 10 WHEN 3 THEN CAST(o_orderkey AS VARCHAR) || ',none'
                             WHEN 4 THEN CAST(o_orderkey AS VARCHAR) || ',1,2'
                             ELSE CAST(o_orderkey AS VARCHAR) || ',' || CAST(o_custkey AS VARCHAR) END"""


@query(f"SELECT {_LINE} AS line, o_orderkey % 10 IN (3, 4) AS damaged FROM orders")
def scan_csv_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a CSV that read as two whole numbers, and those kept aside: another type, one value too many."""
    path = scratch_folder(spark)
    read_given(spark, sf_dir, "orders").select(spark_expr(_LINE).alias("value")).write.text(path)
    good, damaged = read_csv_apart(spark, path, "o_orderkey bigint, o_custkey bigint", header=False)
    whole = good.select(F.concat_ws(",", "o_orderkey", "o_custkey").alias("line"), F.lit(False).alias("damaged"))
    return whole.unionByName(damaged.select("line", F.lit(True).alias("damaged")))
