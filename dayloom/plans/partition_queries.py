"""Gates, look-back and maintenance of tables partitioned by day."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from dayloom.operators.export import dated_export
from dayloom.operators.export_checks import export_and_verify, export_days_checked
from dayloom.operators.gates import (
    day_row_gate as rows_complete, partition_inventory as inventory, partition_size_gate as sizes_complete,
)
from dayloom.operators.history import append_new, history_days, read_history, write_history
from dayloom.operators.ledger import day_ledger as ledger, ledger_gate, note_days, rebuild_ledger
from dayloom.operators.lookback import lookback_union as lookback
from dayloom.operators.gates import BY_DIRECTORY, path_day
from dayloom.operators.partitions import (
    backfill_missing_folders, drop_days, replace_days, replace_folders, retention_keep as retain, retention_keep_folders,
    table_location,
)
from dayloom.operators.slots import compact_slots, pack_hourly_slots, read_slots, slot_index
from dayloom.plans.inputs import (
    AS_OF, DAILY_ACTIVITY_SQL, SHORT_DAYS_SQL, activity_table, daily_activity, dated_events, events_and_short_days,
    events_by_day,
)
from dayloom.plans.jobs import daily_backfill, export_and_check
from dayloom.plans.registry import query
from dayloom.session import read_given, scratch_folder
from dayloom.sources.paths import delete, drop_folders
from dayloom.sources.tables import lookback_days

_EVENT_COLUMNS = "event_id, ts, user_id, event_type, value, props"


@query(f"""
    SELECT {_EVENT_COLUMNS}, CAST(ts AS DATE) AS data_date FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-23' AND DATE '2024-01-30'""")
def lookback_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookback(spark, table_location(spark, events_by_day(spark, sf_dir)), AS_OF, 7)


@query("""
    SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, CAST(round(value * 100) AS DOUBLE) AS cents,
           CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-20' THEN event_type END AS event_type, CAST(ts AS DATE) AS data_date
    FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-30'""")
def lookback_changed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset whose user was an int, then a bigint, now is text, whose cents were whole, and which once had fewer columns."""
    root, events = scratch_folder(spark), dated_events(spark, sf_dir)
    cents = F.round(F.col("value") * 100)
    old = events.select("event_id", F.col("user_id").cast("int"), cents.cast("int").alias("cents"), "data_date")
    mid = events.select("event_id", "user_id", cents.cast("int").alias("cents"), "event_type", "data_date")
    new = events.select("event_type", F.col("user_id").cast("string"), "event_id", cents.alias("cents"), "data_date")
    replace_folders(old.where("data_date < '2024-01-20'"), root)
    replace_folders(mid.where("data_date BETWEEN '2024-01-20' AND '2024-01-26'"), root)
    replace_folders(new.where("data_date > '2024-01-26'"), root)
    return lookback(spark, root, AS_OF, 20, min_bytes=0, layout=BY_DIRECTORY)


_DAYS_SQL = f"SELECT CAST(ts AS DATE) AS data_date FROM events UNION ALL {SHORT_DAYS_SQL}"
_LARGE_BYTES = 2048  # more than the files of a day with four rows, less than those of any day of the events


@query(f"SELECT data_date, count(*) >= 5 AS complete FROM ({_DAYS_SQL}) GROUP BY 1")
def day_row_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_complete(spark.table(events_and_short_days(spark, sf_dir)))


@query(f"SELECT data_date, count(*) >= 5 AS complete FROM ({_DAYS_SQL}) GROUP BY 1")
def partition_size_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sizes_complete(spark, table_location(spark, events_and_short_days(spark, sf_dir)), _LARGE_BYTES)


@query(f"SELECT data_date, count(*) AS n_rows, count(*) >= 5 AS large FROM ({_DAYS_SQL}) GROUP BY 1")
def partition_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = inventory(spark, table_location(spark, events_and_short_days(spark, sf_dir)))
    return days.select("data_date", "n_rows", (F.col("bytes") > _LARGE_BYTES).alias("large"))


@query(f"""
    SELECT data_date, coalesce(n, 0) < 5 AS needs_update
    FROM (SELECT CAST(unnest(range(DATE '2024-01-28', DATE '2024-02-02', INTERVAL 1 DAY)) AS DATE) AS data_date)
    LEFT JOIN (SELECT CAST(ts AS DATE) AS data_date, count(*) AS n FROM events GROUP BY 1) USING (data_date)""")
def export_needs_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the last two days are not in the table, so their exports stay short; one export is older than the range, and
    # one in it was never committed
    days, folder = lookback_days(spark, date(2024, 2, 2), 5), scratch_folder(spark)
    dated_export(spark.range(9), folder, "events", date(2024, 1, 2))
    delete(spark, dated_export(spark.range(9), folder, "events", date(2024, 2, 1)) + "/_SUCCESS")
    return export_and_check(spark, events_by_day(spark, sf_dir), days, folder, "events")


@query("""
    SELECT data_date, coalesce(n, 0) AS n_rows, CASE WHEN n IS NULL THEN 'missing' WHEN n < 5 THEN 'short' END AS fault
    FROM (SELECT CAST(unnest(range(DATE '2024-01-25', DATE '2024-02-02', INTERVAL 1 DAY)) AS DATE) AS data_date)
    LEFT JOIN (SELECT CAST(ts AS DATE) AS data_date, count(*) AS n FROM events GROUP BY 1) USING (data_date)""")
def export_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports checked part by part: some are there, one of them was never committed, two days have no rows."""
    days, folder = [AS_OF + timedelta(days=i) for i in range(-5, 3)], scratch_folder(spark)
    rows = spark.table(events_by_day(spark, sf_dir))
    export_days_checked(rows.where(F.col("data_date").isin(days[:3])), folder, "events")
    delete(spark, f"{folder}/events_{days[1]}.csv/_SUCCESS")
    return export_and_verify(spark, rows, days, folder, "events").na.fill(0, ["n_rows"])


@query("""
    SELECT min(event_id) AS event_id, user_id, event_type,
           CAST(min_by(ts, event_id) AS DATE) AS data_date
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY CAST(ts AS DATE), event_id) AS place FROM events)
    WHERE place = 1 GROUP BY user_id, event_type""")
def dedup_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of each user and type, day by day against the days before; the last five days are appended one by one."""
    root, keys = scratch_folder(spark), ["user_id", "event_type"]
    events = dated_events(spark, sf_dir).select("event_id", "user_id", "event_type", "data_date")
    old = events.where("data_date < DATE '2024-01-26'")
    day_and_id = F.struct("data_date", "event_id")
    first = old.groupBy(*keys).agg(F.min(day_and_id).alias("f")).select("f.event_id", *keys, "f.data_date")
    write_history(first, root, keys)
    append_new(events.where("data_date >= DATE '2024-01-26'"), root, keys, "event_id")
    return read_history(spark, root, history_days(spark, root)).select("event_id", *keys, "data_date")


@query(f"""
    SELECT data_date, count(*) AS n_rows, count(*) >= 20 AS complete FROM ({DAILY_ACTIVITY_SQL})
    WHERE data_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-30' AND data_date NOT IN (DATE '2024-01-09', DATE '2024-01-11')
    GROUP BY 1""")
def day_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of a dataset by day after a write, a replacement, a backfill and drops, each noted when it was done."""
    root, source = scratch_folder(spark), dated_events(spark, sf_dir)
    activity = daily_activity(source)
    days = [date(2024, 1, d) for d in range(1, 31)]
    replace_folders(activity.where("data_date < DATE '2024-01-25'"), root)
    rebuild_ledger(spark, root)
    one = activity.where(F.col("data_date") == F.lit(days[7]))
    note_days(spark, root, replace_folders(one.limit(1), root))
    note_days(spark, root, replace_folders(one, root))
    note_days(spark, root, backfill_missing_folders(root, source, daily_activity, date(2024, 1, 31), n_lookback=10, min_bytes=0))
    gone = [*days[:4], days[8], days[10]]
    drop_folders(spark, root, BY_DIRECTORY, gone)
    note_days(spark, root, gone)
    gate = ledger_gate(spark, root, min_bytes=0, min_rows=20)
    return ledger(spark, root).join(gate, "data_date").select("data_date", "n_rows", "complete")


@query(f"SELECT * FROM ({DAILY_ACTIVITY_SQL}) WHERE data_date <> DATE '2024-01-10'")
def drop_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = activity_table(spark, daily_activity(dated_events(spark, sf_dir)))
    drop_days(spark, table, [date(2024, 1, 10), date(2023, 12, 31)])
    return spark.table(table)


@query(f"""
    SELECT * FROM ({DAILY_ACTIVITY_SQL}) WHERE data_date <> DATE '2024-01-15'
    UNION ALL
    SELECT CAST(ts AS DATE), user_id, count(*), max(event_id) FROM events
    WHERE CAST(ts AS DATE) = DATE '2024-01-15' AND event_type <> 'error' GROUP BY 1, 2""")
def replace_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = dated_events(spark, sf_dir)
    table = activity_table(spark, daily_activity(events))
    one_day = events.where((F.col("data_date") == F.lit(date(2024, 1, 15))) & (F.col("event_type") != "error"))
    replace_days(daily_activity(one_day), table)
    return spark.table(table)


@query(f"SELECT * FROM ({DAILY_ACTIVITY_SQL}) WHERE data_date >= DATE '2024-01-16'")
def retention_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = activity_table(spark, daily_activity(dated_events(spark, sf_dir)))
    retain(spark, table, AS_OF, keep_days=14)
    return spark.table(table)


@query(f"""
    SELECT * FROM ({DAILY_ACTIVITY_SQL}) WHERE data_date < DATE '2024-01-30' AND data_date >= DATE '2024-01-10'""")
def backfill_missing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the table starts without two days of the range, and with one that has but a single, wrong row
    source = spark.table(events_by_day(spark, sf_dir))
    whole = source.where(F.col("data_date") < "2024-01-24")
    short = source.where("data_date = DATE '2024-01-25'").agg(F.min("user_id").alias("user_id"))
    short_day = short.select(
        F.lit(date(2024, 1, 25)).alias("data_date"), "user_id",
        F.lit(-1).cast("bigint").alias("n"), F.lit(-1).cast("bigint").alias("last_event"),
    )
    rest = source.where("data_date BETWEEN DATE '2024-01-27' AND DATE '2024-01-29'")
    table = activity_table(spark, daily_activity(whole).union(short_day).union(daily_activity(rest)))
    daily_backfill(table, source, daily_activity, AS_OF, n_lookback=7, keep_days=20, min_bytes=0, min_rows=5)
    return spark.table(table)


@query(f"""
    SELECT * FROM ({DAILY_ACTIVITY_SQL}) WHERE data_date < DATE '2024-01-30' AND data_date >= DATE '2024-01-10'""")
def backfill_missing_folders_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a dataset with one folder per day, two of which are missing."""
    root, source = scratch_folder(spark), spark.table(events_by_day(spark, sf_dir))
    there = "data_date < '2024-01-30' AND data_date NOT IN ('2024-01-25', '2024-01-26')"
    replace_folders(daily_activity(source.where(there)), root)
    backfill_missing_folders(root, source, daily_activity, AS_OF, n_lookback=7, min_bytes=0)
    retention_keep_folders(spark, root, AS_OF, keep_days=20)
    rows = spark.read.option("recursiveFileLookup", True).parquet(root)
    return rows.withColumn("data_date", path_day(BY_DIRECTORY, F.col("_metadata.file_path")))


@query("""
    SELECT CAST(ts AS DATE) AS data_date, CAST(hour(ts) AS INTEGER) AS hr, count(*) AS n, max(event_id) AS last_event
    FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' GROUP BY ALL""")
def hourly_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, first_day = scratch_folder(spark), AS_OF - timedelta(days=29)
    # the second range overlaps the first one, and leaves the rest of it
    middle = first_day + timedelta(days=12)
    pack_hourly_slots(read_given(spark, sf_dir, "events"), root, "ts", first_day, middle)
    pack_hourly_slots(read_given(spark, sf_dir, "events"), root, "ts", middle, AS_OF)
    slots = read_slots(spark, root).groupBy("data_date", "hr")
    return slots.agg(F.count("*").alias("n"), F.max("event_id").alias("last_event"))


@query("""
    SELECT CAST(ts AS DATE) AS data_date, CAST(hour(ts) AS INTEGER) AS hr, count(*) AS n_rows, 1 AS n_files
    FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' GROUP BY ALL""")
def slots_after_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of slots written by three overlapping runs, then compacted; its rows are those of the slots."""
    root, events = scratch_folder(spark), read_given(spark, sf_dir, "events")
    for first, last in ((0, 20), (5, 25), (5, 29)):
        days = [AS_OF - timedelta(days=29 - back) for back in (first, last)]
        pack_hourly_slots(events, root, "ts", *days)
    compact_slots(spark, root)
    slots = slot_index(spark, root).groupBy("data_date", "hr")
    return slots.agg(F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).cast("int").alias("n_files"))
