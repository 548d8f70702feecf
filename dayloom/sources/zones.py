"""Zone tables from GeoJSON feature lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dayloom.functions.geo import MAX_EXTENT, MICRO, across_meridian, edges_of, goes_around_a_pole, on_the_globe, st_geom_from_geojson
from dayloom.functions.text import clean_geometry, feature, feature_zip, is_castable
from dayloom.operators.dedup import dedup_first
from dayloom.operators.joins import join_broadcast_inner


def zone_texts(lines: DataFrame, targets: DataFrame | None = None, text_col: str = "_c0") -> DataFrame:
    """(zip, geometry text), one row per zone whose name reads as a whole number.

    Of several features with one name the one with the smallest text stays. With ``targets`` (a ``zip``
    column) only those zones are kept; the target list is cut to its distinct names first.
    """
    named = lines.select(feature_zip(feature(text_col)).alias("zip"), F.col(text_col).alias("line"))
    named = named.where(is_castable("zip"))
    if targets is not None:
        named = join_broadcast_inner(named, targets.select("zip").distinct(), ["zip"])
    unique = dedup_first(named, ["zip"], "line")
    return unique.select("zip", clean_geometry(feature("line")).alias("geometry"))


def zone_table(texts: DataFrame) -> DataFrame:
    """(zip, edges, x0, x1, y0, y1): edges and bounding box in micro-degrees.

    A zone across the 180th meridian, told by edges of more than 180 degrees of longitude, is put on both sides of it
    (``across_meridian``). A zone is never left out silently. An error names the zone whose geometry cannot be read, whose box is
    wider or higher than 1,000 degrees, that goes around a pole or the globe, or that has such an edge but longitudes beyond 180 degrees. A zone
    that is a single point has no edges and holds nothing.
    """
    read = texts.select("zip", st_geom_from_geojson("geometry").alias("geom"))
    shaped = read.select("zip", goes_around_a_pole(F.col("geom")).alias("polar"),
                         on_the_globe(F.col("geom")).alias("globe"), edges_of(across_meridian(F.col("geom"))).alias("edges"))
    xs = F.concat(F.col("edges.ax"), F.col("edges.bx"))
    boxed = shaped.select(
        "zip",
        "polar",
        "globe",
        "edges",
        F.array_min(xs).alias("x0"),
        F.array_max(xs).alias("x1"),
        F.array_min(F.col("edges.ay")).alias("y0"),
        F.array_max(F.col("edges.by")).alias("y1"),
    )
    wide = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) > MAX_EXTENT
    crossing = F.exists("edges", lambda e: F.abs(e["bx"] - e["ax"]) > 180 * MICRO)
    fault = (
        F.when(F.col("edges").isNull(), "has no readable geometry")
        .when(wide, "spans more than 1,000 degrees")
        .when(F.col("polar"), "goes around a pole")
        .when(F.col("globe") & (F.col("x1") - F.col("x0") > 720 * MICRO), "wraps around the globe")
        .when(crossing, "has an edge of more than 180 degrees, and longitudes beyond them")
    )
    error = F.raise_error(F.concat(F.lit("zone "), F.coalesce("zip", F.lit("NULL")), F.lit(" "), fault))
    # the error stands in the column every user of the table reads
    whole = F.when(fault.isNull(), F.col("edges")).otherwise(error.cast(shaped.schema["edges"].dataType))
    return boxed.withColumn("edges", whole).drop("polar", "globe")
