"""The three whole jobs: daily backfill, zone assignment, export with check."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from dayloom.operators.export import export_days, export_needs_update
from dayloom.operators.gates import MIN_BYTES
from dayloom.operators.partitions import backfill_missing_days, retention_keep
from dayloom.operators.slots import write_slots
from dayloom.operators.spatial import spatial_first_per_zone
from dayloom.session import scratch_scope
from dayloom.sources.zones import zone_table, zone_texts


def daily_backfill(
    table: str,
    source: DataFrame,
    compute: Callable[[DataFrame], DataFrame],
    as_of: date,
    n_lookback: int = 7,
    keep_days: int | None = None,
    min_bytes: int = MIN_BYTES,
    min_rows: int | None = None,
) -> tuple[list[date], list[date]]:
    """Recompute what the look-back range lacks, then drop what is too old. Returns the days of both kinds."""
    with scratch_scope(source.sparkSession):
        computed = backfill_missing_days(table, source, compute, as_of, n_lookback, min_bytes, min_rows)
        dropped = [] if keep_days is None else retention_keep(source.sparkSession, table, as_of, keep_days)
    return computed, dropped


def zone_assignment(
    features: DataFrame,
    targets: DataFrame | None,
    points: DataFrame,
    out: str,
    point_id: str,
    slots: Sequence[str] = (),
    packed: bool = False,
) -> None:
    """Write the first point of every target zone per slot, one output partition per slot, gzip Parquet.

    With ``packed`` the slots share files (see ``dayloom.operators.slots``; ``read_slots`` reads them), whose number
    follows the bytes and not the slots.

    ``features`` are GeoJSON lines in ``_c0``, ``targets`` has a ``zip`` column, ``points`` have LONGITUDE and
    LATITUDE and a unique ``point_id``; ``slots`` are columns such as day and hour, all handled by the one job.
    Slots that are written replace those of an earlier run, all others in ``out`` stay. What the job stores on its
    way is deleted at its end.
    """
    spark = points.sparkSession
    with scratch_scope(spark):
        zones = zone_table(zone_texts(features, targets))
        first = spatial_first_per_zone(points, zones, point_id, by=slots)
        if slots and packed:
            write_slots(first, out, slots, compression="gzip")
            return
        if slots:
            first = first.hint("rebalance", *slots)
        writer = first.write.mode("overwrite").option("compression", "gzip")
        if slots:
            writer = writer.partitionBy(*slots).option("partitionOverwriteMode", "dynamic")
        writer.parquet(out)


def export_and_check(spark: SparkSession, table: str, days: DataFrame, folder: str, root: str) -> DataFrame:
    """Export those of ``days`` whose export is missing or short, in one job, then report what is still so.

    ``days`` is a look-back list; only the partitions of stale days are read.
    """
    stale = export_needs_update(spark, days, folder, root).where("needs_update").select("data_date")
    wanted = [row["data_date"] for row in stale.collect()]  # at most the look-back list
    if wanted:
        export_days(spark.table(table).where(F.col("data_date").isin(wanted)), folder, root)
    return export_needs_update(spark, days, folder, root)
