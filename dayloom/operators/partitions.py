"""Tables partitioned by day: write, replace, drop, retain, backfill."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from dayloom.functions.dates import hour_of_day
from dayloom.operators.gates import BY_DIRECTORY, BY_PARTITION, MIN_BYTES, day_row_gate, files_by_day
from dayloom.session import stored
from dayloom.sources.paths import drop_folders, names_in, recover_days, staged_days

DATE_COL = "data_date"
# Fixed value: days that are kept.
KEEP_DAYS = 189


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    # insertInto heeds only the session setting; as a writer option it would overwrite the whole table
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_days(df: DataFrame, table: str, partition_cols: Sequence[str] = (DATE_COL,)) -> None:
    """Create (or replace) a Parquet table partitioned by day.

    The rebalance hint groups rows by partition before the write, so a day gets few files; a day too large
    for one task is split into several and small ones share a task.
    """
    (
        df.hint("rebalance", *partition_cols)
        .write.format("parquet").mode("overwrite").partitionBy(*partition_cols).saveAsTable(table)
    )


def replace_days(df: DataFrame, table: str, partition_cols: Sequence[str] = (DATE_COL,)) -> None:
    """Replace the partitions that occur in ``df``; all others stay as they are."""
    spark = df.sparkSession
    ordered = df.select(*spark.table(table).columns).hint("rebalance", *partition_cols)
    with _dynamic_overwrite(spark):
        ordered.write.insertInto(table, overwrite=True)


def drop_days(spark: SparkSession, table: str, days: Sequence[date]) -> None:
    """Drop whole days in one statement; days the table does not have are no error."""
    if days:
        specs = ", ".join(f"PARTITION ({DATE_COL} = DATE '{day.isoformat()}')" for day in days)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")


def _details(spark: SparkSession, table: str) -> dict:
    """What the catalog says about a table itself, apart from its columns."""
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()[0])


def table_location(spark: SparkSession, table: str) -> str:
    return _details(spark, table)["location"]


def retention_keep(spark: SparkSession, table: str, as_of: date, keep_days: int = KEEP_DAYS) -> list[date]:
    """Drop the days more than ``keep_days`` before ``as_of``. Reads partition names, no data.

    Dropping a partition of an external table would leave its files, so such a table is an error.
    """
    if _details(spark, table).get("type") == "EXTERNAL":
        raise ValueError(f"{table} is external: its days would lose their names but not their files")
    name = F.regexp_extract("partition", f"{DATE_COL}=([0-9-]+)", 1).cast("date")
    old = (
        spark.sql(f"SHOW PARTITIONS {table}").select(name.alias("day")).distinct()
        .where(F.col("day") < F.date_sub(F.lit(as_of), keep_days)).orderBy("day")
    )
    days = [row.day for row in old.collect()]
    drop_days(spark, table, days)
    return days


def retention_keep_folders(
    spark: SparkSession, root: str, as_of: date, keep_days: int = KEEP_DAYS, layout: str = BY_DIRECTORY
) -> list[date]:
    """The same for a dataset with one folder per day."""
    oldest = as_of - timedelta(days=keep_days)
    named = re.compile(re.escape(layout).replace(re.escape("{day}"), r"(\d{4}-\d{2}-\d{2})"))
    found = [date.fromisoformat(m[1]) for name in names_in(spark, root) if (m := named.fullmatch(name))]
    days = sorted(day for day in found if day < oldest)
    drop_folders(spark, root, layout, days)
    return days


def _incomplete(
    spark: SparkSession, root: str, rows: DataFrame | None, span: list[date], min_bytes: int, min_rows: int | None,
    layout: str,
) -> list[date]:
    sizes = files_by_day(spark, root, span, layout)
    complete = sizes.where(F.col("bytes") > min_bytes).select(DATE_COL)
    if min_rows is not None and rows is not None:
        complete = complete.join(day_row_gate(rows, min_rows).where("complete"), DATE_COL, "left_semi")
    passed = {row[DATE_COL] for row in complete.collect()}  # at most as many as the span has days
    return [day for day in span if day not in passed]


def _span(as_of: date, n_lookback: int) -> list[date]:
    return [as_of - timedelta(days=back) for back in range(n_lookback, 0, -1)]


def days_to_backfill(
    spark: SparkSession,
    table: str,
    as_of: date,
    n_lookback: int,
    min_bytes: int = MIN_BYTES,
    min_rows: int | None = None,
) -> list[date]:
    """The days of the look-back range, oldest first, that are absent or do not pass the gates."""
    span = _span(as_of, n_lookback)
    rows = spark.table(table).where(F.col(DATE_COL).isin(span))
    return _incomplete(spark, table_location(spark, table), rows, span, min_bytes, min_rows, BY_PARTITION)


def backfill_missing_days(
    table: str,
    source: DataFrame,
    compute: Callable[[DataFrame], DataFrame],
    as_of: date,
    n_lookback: int,
    min_bytes: int = MIN_BYTES,
    min_rows: int | None = None,
    keep_short: bool = False,
) -> list[date]:
    """Recompute the incomplete days of the look-back range in one job and put them in place.

    ``compute`` maps source rows of whole days (column ``data_date``) to table rows. The source is filtered
    by literal days, so its scan is pruned. What the table holds stays until the new rows are written; then short
    days for which there were none are dropped, unless ``keep_short``. A run with nothing to do writes nothing.
    """
    spark = source.sparkSession
    days = days_to_backfill(spark, table, as_of, n_lookback, min_bytes, min_rows)
    if days:
        fresh = stored(compute(source.where(F.col(DATE_COL).isin(days))).where(F.col(DATE_COL).isin(days)))
        replace_days(fresh, table)
        if not keep_short:
            made = {row[DATE_COL] for row in fresh.select(DATE_COL).distinct().collect()}  # days of the range
            drop_days(spark, table, [day for day in days if day not in made])
    return days


def backfill_missing_folders(
    root: str,
    source: DataFrame,
    compute: Callable[[DataFrame], DataFrame],
    as_of: date,
    n_lookback: int,
    min_bytes: int = MIN_BYTES,
    keep_short: bool = False,
    layout: str = BY_DIRECTORY,
) -> list[date]:
    """The same for a dataset with one folder per day: one job writes all days aside, then each is put in place.

    What a run that died left is settled first, so its days are not taken for missing.
    """
    spark = source.sparkSession
    recover_days(spark, root)
    days = _incomplete(spark, root, None, _span(as_of, n_lookback), min_bytes, None, layout)
    if days:
        fresh = compute(source.where(F.col(DATE_COL).isin(days))).where(F.col(DATE_COL).isin(days))
        made = replace_folders(fresh, root, layout)
        if not keep_short:
            drop_folders(spark, root, layout, [day for day in days if day not in made])
    return days


def replace_folders(df: DataFrame, root: str, layout: str = BY_DIRECTORY) -> list[date]:
    """Write the days of ``df`` to their folders, replacing those; the folder stands for ``data_date``."""
    with staged_days(df.sparkSession, root, layout) as (staging, moved):
        df.withColumnRenamed(DATE_COL, "_day").hint("rebalance", "_day").write.partitionBy("_day").parquet(staging)
    return moved


def write_hourly_slots(df: DataFrame, table: str, ts: str, first_day: date, last_day: date) -> None:
    """All (day, hour) slots of a range in one job, one output partition per slot; other slots of the table stay."""
    in_range = df.where(F.to_date(ts).between(F.lit(first_day), F.lit(last_day)))
    slotted = in_range.withColumns({DATE_COL: F.to_date(ts), "hr": hour_of_day(ts).cast("int")})
    slots = (DATE_COL, "hr")
    if df.sparkSession.catalog.tableExists(table):
        replace_days(slotted, table, slots)
    else:
        write_days(slotted, table, slots)
