"""Catalog scans, seeds, previews and the integer-range sources."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from dayloom.functions.dates import DAYS_PER_WEEK, HOURS_PER_DAY


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_table_day(spark: SparkSession, name: str, day: date, date_col: str = "data_date") -> DataFrame:
    """One day of a table; on a partition column only that partition is listed and read."""
    return spark.table(name).where(F.col(date_col) == F.lit(day))


def empty_like(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def preview(df: DataFrame, n: int, *order_by: str) -> DataFrame:
    """The first ``n`` rows: any rows without an order, else a per-task top-n and one merge."""
    return df.orderBy(*order_by).limit(n) if order_by else df.limit(n)


def first_available(spark: SparkSession, names: Sequence[str]) -> tuple[int, DataFrame | None]:
    """Position and rows of the first name that can be read; (len(names), None) when there is none.

    A name that the catalog lacks or whose definition no longer holds, such as a view over a dropped table, is passed over.
    """
    for position, name in enumerate(names):
        try:
            found = spark.table(name)
            found.schema  # noqa: B018  (analyses the table)
        except AnalysisException:
            continue
        return position, found
    return len(names), None


def weekly_slots(spark: SparkSession) -> DataFrame:
    """(dow, hr): the 168 slots of a week, hours spread within each day of the day range."""
    days = spark.range(1, DAYS_PER_WEEK + 1).withColumnRenamed("id", "dow")
    hours = F.sequence(F.lit(0).cast("bigint"), F.lit(HOURS_PER_DAY - 1).cast("bigint"))
    return days.select("dow", F.explode(hours).alias("hr"))


def lookback_days(spark: SparkSession, as_of: date | None = None, n: int = 7, only: int | None = None) -> DataFrame:
    """Days ``n`` .. 1 before ``as_of`` (default: today), oldest first; with ``only``, that one day."""
    today = F.lit(as_of) if as_of else F.current_date()
    back = spark.range(1, n + 1) if only is None else spark.range(only, only + 1)
    return back.select(F.date_sub(today, F.col("id").cast("int")).alias("data_date")).orderBy("data_date")
