"""CSV and Parquet exports and the gate that tells which exports to redo."""

from __future__ import annotations

from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from dayloom.operators.gates import MIN_ROWS
from dayloom.sources.paths import exists, staged_days

# Fixed value: the name of one day's export.
EXPORT_NAME = "{root}_{day}.csv"

# Spark's defaults cut timestamps to milliseconds and trim texts; an export keeps both whole.
WHOLE_VALUES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


BZIP2_CSV = {"sep": ",", "header": True, "compression": "bzip2", **WHOLE_VALUES}


def csv_export(df: DataFrame, path: str, max_files: int | None = None) -> None:
    """bzip2 CSV with header, a file per partition; ``max_files`` coalesces more partitions than that.

    A limit also bounds the tasks of all that comes before it up to the last shuffle, so there is none by default. NULL is written as nothing and an empty string as ``""``; Spark's own reader takes both for NULL.
    """
    parts = df if max_files is None else df.coalesce(max_files)
    parts.write.mode("overwrite").options(**BZIP2_CSV).csv(path)


def export_path(folder: str, root: str, day: date) -> str:
    return f"{folder}/{EXPORT_NAME.format(root=root, day=day.isoformat())}"


def dated_export(df: DataFrame, folder: str, root: str, day: date, max_files: int | None = None) -> str:
    """Export a frame under the name of a day; the gate below looks for the same name."""
    path = export_path(folder, root, day)
    csv_export(df, path, max_files)
    return path


def _holds_rows(spark: SparkSession, path: str, min_rows: int) -> bool:
    """Whether a committed export has that many rows; reading stops there."""
    if not exists(spark, f"{path}/_SUCCESS"):
        return False
    try:
        return spark.read.schema("line string").option("header", True).csv(path).limit(min_rows).count() >= min_rows
    except (PySparkException, Py4JJavaError):  # this day's files are damaged or cannot be read
        return False


def export_needs_update(
    spark: SparkSession, days: DataFrame, folder: str, root: str, min_rows: int = MIN_ROWS
) -> DataFrame:
    """(data_date, needs_update) for each of ``days``: is its export missing, uncommitted, unreadable or short?

    Only exports of ``days`` (a look-back list) are looked at, each by a small job that ends after ``min_rows`` rows.
    """
    wanted = [row["data_date"] for row in days.select("data_date").distinct().collect()]
    held = [day for day in wanted if _holds_rows(spark, export_path(folder, root, day), min_rows)]
    return days.select("data_date", (~F.col("data_date").isin(held)).alias("needs_update"))


def export_days(df: DataFrame, folder: str, root: str, date_col: str = "data_date") -> list[date]:
    """Export every day of ``df`` under its own name, all in one job; returns the days.

    A large day is split over several tasks. The days are written aside and put in place when all are there.
    """
    spark = df.sparkSession
    with staged_days(spark, folder, EXPORT_NAME.replace("{root}", root)) as (staging, moved):
        dated = df.withColumn("_day", F.col(date_col).cast("date")).hint("rebalance", "_day")
        dated.write.mode("overwrite").partitionBy("_day").options(**BZIP2_CSV).csv(staging)
    return moved


def ordered_export(df: DataFrame, path: str, *order_by: str) -> None:
    """CSV in ranges of the order: each part is sorted and has a header, and in name order they hold the sorted rows.

    Rows of one key are told apart by a hash of the whole row, so a hot key is spread over several parts. An existing
    target is an error.
    """
    if not order_by:
        raise ValueError("an ordered export needs columns to order by")
    whole = F.xxhash64(*[F.to_json(c) if "map" in kind else F.col(c) for c, kind in df.dtypes])
    parts = df.repartitionByRange(*order_by, whole).sortWithinPartitions(*order_by, whole)
    parts.write.mode("errorifexists").options(header=True, **WHOLE_VALUES).csv(path)


def parquet_overwrite_gzip(df: DataFrame, path: str, n_files: int | None = None) -> None:
    """Gzip Parquet, replacing what is there; with ``n_files`` the rows are dealt out evenly first."""
    parts = df if n_files is None else df.repartition(n_files)
    parts.write.mode("overwrite").option("compression", "gzip").parquet(path)
