"""Completeness gates and the inventory of days."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Rows that make a day complete, and bytes a day's files must exceed.
MIN_ROWS = 5
MIN_BYTES = 1024

# How one day of a dataset is named below its root. The first is Spark's own partition
# layout, the second one Parquet directory per day.
BY_PARTITION = "data_date={day}"
BY_DIRECTORY = "{day}.parquet"


def path_day(layout: str = BY_PARTITION, path: Column | None = None) -> Column:
    """The day a file path belongs to, NULL for paths of other shapes."""
    name = "\\Q" + layout.replace("{day}", "\\E([0-9]{4}-[0-9]{2}-[0-9]{2})\\Q") + "\\E"
    source = F.col("path") if path is None else path
    found = F.regexp_extract(source, f"/{name}/", 1)
    return F.when(found != "", found).try_cast("date")


def files_by_day(
    spark: SparkSession, root: str, days: Sequence[date] | None = None, layout: str = BY_PARTITION
) -> DataFrame:
    """(data_date, n_files, bytes) of the days that have files; with ``days`` no other day is listed.

    Only names and lengths are read, not content, so the cost grows with the number of files; one task takes many
    of them. A root that does not exist yet has no days.
    """
    names = "*" if days is None else "{" + ",".join(day.isoformat() for day in days) + "}"
    pattern = f"{root}/{layout.format(day=names)}"
    try:
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", True).load(pattern)
            .select(path_day(layout).alias("data_date"), "length")
            .coalesce(spark.sparkContext.defaultParallelism)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "data_date date, n_files bigint, bytes bigint")
    per_day = files.where(F.col("data_date").isNotNull()).groupBy("data_date")
    return per_day.agg(F.count("*").alias("n_files"), F.sum("length").alias("bytes"))


def partition_size_gate(
    spark: SparkSession, root: str, min_bytes: int = MIN_BYTES, layout: str = BY_PARTITION
) -> DataFrame:
    """(data_date, complete): do the day's files together exceed ``min_bytes``?"""
    sizes = files_by_day(spark, root, layout=layout)
    return sizes.select("data_date", (F.col("bytes") > min_bytes).alias("complete"))


def partition_inventory(
    spark: SparkSession, root: str, days: Sequence[date] | None = None, layout: str = BY_PARTITION
) -> DataFrame:
    """(data_date, n_files, bytes, n_rows) per day, for ``days`` only if given. Rows come from the Parquet footers.

    A root or range without days gives no rows.
    """
    names = "*" if days is None else "{" + ",".join(day.isoformat() for day in days) + "}"
    files = files_by_day(spark, root, days, layout)
    try:
        data = spark.read.option("recursiveFileLookup", True).parquet(f"{root}/{layout.format(day=names)}")
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return files.withColumn("n_rows", F.lit(0).cast("bigint"))
    day = path_day(layout, F.col("_metadata.file_path")).alias("data_date")
    rows = data.groupBy(day).agg(F.count("*").alias("n_rows"))
    return files.join(rows, "data_date", "left").na.fill(0, ["n_rows"])


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def day_row_gate(df: DataFrame, min_rows: int = MIN_ROWS, date_col: str = "data_date") -> DataFrame:
    """(data_date, complete) for every day present: has it at least ``min_rows`` rows?"""
    return df.groupBy(F.col(date_col).alias("data_date")).agg((F.count("*") >= min_rows).alias("complete"))


def day_has_rows(df: DataFrame, day: date, min_rows: int = MIN_ROWS, date_col: str = "data_date") -> bool:
    """The row gate for one day; stops reading after ``min_rows`` rows."""
    return df.where(F.col(date_col) == F.lit(day)).limit(min_rows).count() == min_rows
