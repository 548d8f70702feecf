"""Weekly grid and calendar queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dayloom.functions.dates import date_add_str as add_days, hour_of_day, is_weekday as on_weekday, iso_dow
from dayloom.operators.grid import fill_24_7 as fill_grid, slots_per_user, weekly_counts
from dayloom.operators.grid_store import add_grid_days, stored_grid
from dayloom.operators.joins import join_right_outer as right_outer
from dayloom.plans.inputs import AS_OF, dated_events
from dayloom.plans.registry import query
from dayloom.session import read_given, scratch_folder
from dayloom.sources.tables import lookback_days as days_before, weekly_slots

_GRID_SQL = "(SELECT unnest(range(1, 8)) AS dow) CROSS JOIN (SELECT unnest(range(0, 24)) AS hr)"


@query(f"""
    SELECT uid, dow, hr, n
    FROM (SELECT DISTINCT user_id AS uid FROM events) CROSS JOIN {_GRID_SQL}
    LEFT JOIN (SELECT user_id AS uid, isodow(ts) AS dow, hour(ts) AS hr, count(*) AS n FROM events GROUP BY ALL)
    USING (uid, dow, hr)""")
def fill_24_7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly_counts(read_given(spark, sf_dir, "events"), "user_id", "ts")


@query(f"""
    SELECT uid, dow, hr, event_id, event_type
    FROM (SELECT user_id AS uid, isodow(ts) AS dow, hour(ts) AS hr, event_id, event_type FROM events)
    RIGHT JOIN (SELECT c_custkey AS uid, dow, hr FROM customer CROSS JOIN {_GRID_SQL}) USING (uid, dow, hr)""")
def fill_24_7_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = read_given(spark, sf_dir, "events").select(
        F.col("user_id").alias("uid"), iso_dow("ts").alias("dow"), hour_of_day("ts").alias("hr"),
        "event_id", "event_type",
    )
    users = read_given(spark, sf_dir, "customer").select(F.col("c_custkey").alias("uid"))
    return fill_grid(facts, users)


@query("""
    SELECT custkey, o_orderkey, o_totalprice, c_name
    FROM (SELECT o_custkey AS custkey, o_orderkey, o_totalprice FROM orders)
    RIGHT JOIN (SELECT c_custkey AS custkey, c_name FROM customer) USING (custkey)""")
def join_right_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_given(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("custkey"), "o_orderkey", "o_totalprice"
    )
    customers = read_given(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    return right_outer(orders, customers, ["custkey"])


@query(f"SELECT uid, dow, hr FROM (SELECT DISTINCT user_id AS uid FROM events) CROSS JOIN {_GRID_SQL}")
def cross_dow_hr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slots_per_user(read_given(spark, sf_dir, "events").select(F.col("user_id").alias("uid")))


@query(f"""
    SELECT dow, hr, coalesce(n, 0) AS n
    FROM (SELECT dow, hr FROM {_GRID_SQL})
    LEFT JOIN (SELECT isodow(ts) AS dow, hour(ts) AS hr, count(*) AS n FROM events GROUP BY ALL) USING (dow, hr)""")
def range_dow_hr(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_given(spark, sf_dir, "events")
    counts = events.groupBy(iso_dow("ts").alias("dow"), hour_of_day("ts").alias("hr")).agg(F.count("*").alias("n"))
    # at most 168 rows and one for events without a time
    return weekly_slots(spark).join(F.broadcast(counts), ["dow", "hr"], "left").na.fill(0, ["n"])


@query("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
           strftime(o_orderdate + INTERVAL 2 DAY, '%Y-%m-%d') AS in_two_days,
           strftime(o_orderdate - INTERVAL 31 DAY, '%Y-%m-%d') AS a_month_ago
    FROM orders""")
def date_add_str(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_given(spark, sf_dir, "orders")
    labelled = orders.select("o_orderkey", add_days("o_orderdate", 0).alias("day"))
    return labelled.select(
        "o_orderkey", "day",
        add_days("day", 2).alias("in_two_days"), add_days("day", -31).alias("a_month_ago"),
    )


@query("SELECT o_orderkey, isodow(o_orderdate) < 6 AS weekday FROM orders")
def is_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_given(spark, sf_dir, "orders").select("o_orderkey", on_weekday("o_orderdate").alias("weekday"))


@query("""
    SELECT data_date, count(event_id) AS n
    FROM (SELECT CAST(unnest(range(DATE '2024-01-23', DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS data_date)
    LEFT JOIN events ON CAST(ts AS DATE) = data_date GROUP BY data_date""")
def lookback_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = dated_events(spark, sf_dir).where(F.col("data_date").between("2024-01-23", "2024-01-29"))
    per_day = events.groupBy("data_date").agg(F.count("*").alias("n"))
    # at most seven rows on either side
    return days_before(spark, AS_OF, 7).join(F.broadcast(per_day), "data_date", "left").na.fill(0, ["n"])


@query(f"""
    SELECT uid, dow, hr, n
    FROM (SELECT DISTINCT user_id AS uid FROM events) CROSS JOIN {_GRID_SQL}
    LEFT JOIN (SELECT user_id AS uid, isodow(ts) AS dow, hour(ts) AS hr, count(*) AS n FROM events GROUP BY ALL)
    USING (uid, dow, hr)""")
def fill_24_7_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid from states by day: all days but the last three, then those one by one, and one of them again."""
    root, events = scratch_folder(spark), dated_events(spark, sf_dir)
    add_grid_days(events.where("data_date <= DATE '2024-01-27'"), root, "user_id", "ts")
    for day in ("2024-01-28", "2024-01-29", "2024-01-30", "2024-01-28"):
        add_grid_days(events.where(f"data_date = DATE '{day}'"), root, "user_id", "ts")
    add_grid_days(events.where("data_date > DATE '2024-01-30'"), root, "user_id", "ts")
    return stored_grid(spark, root)
