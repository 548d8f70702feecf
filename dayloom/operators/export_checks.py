"""Checks of whole exports: rows, bytes and a hash of every part, written with the export and compared later in one job.

The checks of a run are rows of a Parquet dataset beside the exports; those of the run that wrote a day last count for it. A part is
read whole as bytes to compare, so a flipped byte anywhere in it is found; nothing is unpacked, and damage fails no job. A part is
as large as a task's share of a day.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from dayloom.operators.export import BZIP2_CSV, EXPORT_NAME
from dayloom.operators.gates import MIN_ROWS, path_day
from dayloom.session import stored
from dayloom.sources.paths import exists, staged_days

_CHECKS = "data_date date, run bigint, file string, bytes bigint, hash bigint, n_rows bigint"


def _checks_folder(folder: str, root: str) -> str:
    return f"{folder.rstrip('/')}/_checks-{root}"


def _parts(spark: SparkSession, pattern: str, day: str) -> DataFrame:
    """(data_date, file, bytes, hash) of the part files under the folders that a pattern names."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", True)
    # a part that the file system itself refuses to read is left out here, and so is missing from what was noted
    files = files.option("ignoreCorruptFiles", True).load(pattern)
    file = F.regexp_extract("path", "([^/]+)$", 1)
    return files.select(path_day(day).alias("data_date"), file.alias("file"), F.col("length").alias("bytes"), F.xxhash64("content").alias("hash"))


def _note_parts(spark: SparkSession, staging: str, checks_at: str, n_columns: int, wanted: int) -> None:
    """Read the staged parts back, count their records, and append their checks."""
    names = ", ".join(f"c{i} string" for i in range(n_columns))
    # a value may hold line ends, so records are counted, not lines
    back = spark.read.schema(names).options(**BZIP2_CSV, multiLine=True, recursiveFileLookup=True).csv(f"{staging}/_day=*")
    day = path_day("_day={day}", F.col("_metadata.file_path")).alias("data_date")
    rows = stored(back.groupBy(day, F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("n_rows")))
    written = rows.agg(F.sum("n_rows")).first()[0] or 0
    if written != wanted:
        raise OSError(f"{written} of {wanted} rows of {staging} read back")
    parts = _parts(spark, f"{staging}/_day=*", "_day={day}").join(rows, ["data_date", "file"], "left").na.fill(0, ["n_rows"])
    checks = parts.select("data_date", F.lit(time.time_ns()).alias("run"), "file", "bytes", "hash", "n_rows")
    checks.coalesce(1 + spark.sparkContext.defaultParallelism // 4).write.mode("append").parquet(checks_at)


def export_days_checked(df: DataFrame, folder: str, root: str, date_col: str = "data_date") -> list[date]:
    """Export every day of ``df`` as ``export_days`` does, and write the checks of its parts; returns the days.

    Rows are counted by reading the parts back, so an export that does not read as written is an error before any day is put in
    place. The checks are written first: a run that dies before its days stand leaves these days in need of an update.
    """
    spark, layout = df.sparkSession, EXPORT_NAME.replace("{root}", root)
    with staged_days(spark, folder, layout) as (staging, moved):
        dated = stored(df.withColumn("_day", F.col(date_col).cast("date")).hint("rebalance", "_day"))
        dated.hint("rebalance", "_day").write.mode("overwrite").partitionBy("_day").options(**BZIP2_CSV).csv(staging)
        wanted = dated.where("_day IS NOT NULL").count()
        if wanted:
            _note_parts(spark, staging, _checks_folder(folder, root), len(df.columns), wanted)
    return moved


def export_faults(spark: SparkSession, days: Sequence[date], folder: str, root: str, min_rows: int = MIN_ROWS) -> DataFrame:
    """(data_date, n_rows, fault) for each of ``days``; ``fault`` is NULL for an export that is whole.

    Faults: ``missing``, ``uncommitted``, ``unchecked`` (no checks were written), ``damaged`` (a part is missing, added or differs
    in length or hash) and ``short``. One job reads the parts of all days.
    """
    folder, layout = folder.rstrip("/"), EXPORT_NAME.replace("{root}", root)
    paths = {day: f"{folder}/{layout.format(day=day.isoformat())}" for day in days}
    there = {day for day, path in paths.items() if exists(spark, path)}
    done = {day for day in there if exists(spark, f"{paths[day]}/_SUCCESS")}
    listed = spark.createDataFrame([(d, d in there, d in done) for d in dict.fromkeys(days)], "data_date date, there boolean, done boolean")
    none = "data_date date, file string, bytes bigint, hash bigint"
    if there:
        pattern = f"{folder}/{layout.format(day='{' + ','.join(sorted(d.isoformat() for d in there)) + '}')}"
        try:
            parts = _parts(spark, pattern, layout)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            parts = spark.createDataFrame([], none)
    else:
        parts = spark.createDataFrame([], none)
    checks_at = _checks_folder(folder, root)
    checks = spark.read.schema(_CHECKS).parquet(checks_at) if exists(spark, checks_at) else spark.createDataFrame([], _CHECKS)
    checks = checks.where(F.col("data_date").isin(list(paths)))
    last = checks.withColumn("last", F.max("run").over(Window.partitionBy("data_date"))).where("run = last")
    noted = last.select("data_date", "file", F.col("bytes").alias("b"), F.col("hash").alias("h"), "n_rows")
    both = parts.join(noted, ["data_date", "file"], "full")
    seen = both.groupBy("data_date").agg(
        F.max(~F.expr("bytes <=> b AND hash <=> h")).alias("differs"),
        F.count("b").alias("n_noted"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
    )
    fault = (
        F.when(~F.col("there"), "missing")
        .when(~F.col("done"), "uncommitted")
        .when(F.coalesce("n_noted", F.lit(0)) == 0, "unchecked")
        .when(F.col("differs"), "damaged")
        .when(F.col("n_rows") < min_rows, "short")
    )
    return listed.join(seen, "data_date", "left").select("data_date", F.when(F.col("done"), F.coalesce("n_rows", F.lit(0))).alias("n_rows"), fault.alias("fault"))


def export_and_verify(spark: SparkSession, rows: DataFrame, days: Sequence[date], folder: str, root: str) -> DataFrame:
    """Export those of ``days`` that are not whole from ``rows(data_date, ..)``, in one job, then report on all of them."""
    stale = [r["data_date"] for r in export_faults(spark, days, folder, root).where("fault IS NOT NULL").collect()]
    if stale:
        export_days_checked(rows.where(F.col("data_date").isin(stale)), folder, root)
    return export_faults(spark, days, folder, root)
