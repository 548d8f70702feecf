"""GeoJSON zones and the point-in-polygon join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dayloom.functions.geo import edges_of, st_geom_from_geojson as geom_from_geojson, st_point as point, within_edges
from dayloom.functions.text import clean_geometry, feature, feature_zip
from dayloom.operators.spatial import spatial_first_per_zone as first_per_zone, spatial_within_join as within_join
from dayloom.plans.inputs import (
    EVENT_POINT_CTE, ITEM_POINT_CTE, ITEM_X, ITEM_Y, MERIDIAN_X, MERIDIAN_Y, MERIDIAN_ZONE_X, MERIDIAN_ZONE_Y, SHAPES,
    ZONE_CTE, degrees, event_points, feature_file, geometry_sql, hit_cte, item_points, lattice_x, lattice_y, rolled,
    spark_expr, zone_frame,
)
from dayloom.operators.slots import read_slots
from dayloom.operators.zone_checks import zone_faults as faults_of
from dayloom.plans.jobs import zone_assignment as assign_zones
from dayloom.plans.registry import query
from dayloom.session import read_given, scratch_folder
from dayloom.sources.files import read_csv_columns, read_tsv
from dayloom.sources.zones import zone_table, zone_texts

_CLEAN = geometry_sql("")
_ITEM_KEY = ["l_orderkey", "l_linenumber", "l_suppkey"]
_NUMBERED = "TRY_CAST(zip AS INTEGER) IS NOT NULL"


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_tsv(spark, feature_file(spark, sf_dir)).select(feature("_c0").alias("f"))


def _zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_table(zone_texts(read_tsv(spark, feature_file(spark, sf_dir))))


@query(f"""
    WITH {ZONE_CTE} SELECT zip, CASE WHEN shape = 2 THEN 'MultiPolygon' ELSE 'Polygon' END AS kind, s_name AS owner
    FROM zone""")
def geojson_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir).select(
        feature_zip(F.col("f")).alias("zip"), F.col("f.geometry.type").alias("kind"),
        feature_zip(F.col("f"), "OWNER").alias("owner"),
    )


@query(f"WITH {ZONE_CTE} SELECT zip, {_CLEAN} AS geometry FROM zone")
def geojson_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir).select(feature_zip(F.col("f")).alias("zip"), clean_geometry(F.col("f")).alias("geometry"))


_VERTICES = ", ".join(
    f"({i}, {p}, {r}, {v}, {x}, {y})"
    for i, shape in enumerate(SHAPES) for p, polygon in enumerate(shape)
    for r, ring in enumerate(polygon) for v, (x, y) in enumerate(ring)
)


@query(f"""
    WITH {ZONE_CTE}, vertex(shape, polygon, ring, vertex, vx, vy) AS (VALUES {_VERTICES})
    SELECT zip, polygon, ring, vertex, CAST(zx + unit * vx AS BIGINT) AS x, CAST(zy + unit * vy AS BIGINT) AS y
    FROM zone JOIN vertex USING (shape)""")
def st_geom_from_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    shaped = _features(spark, sf_dir).select(
        feature_zip(F.col("f")).alias("zip"), geom_from_geojson(clean_geometry(F.col("f"))).alias("geom")
    )
    polygons = shaped.select("zip", F.posexplode("geom").alias("polygon", "rings"))
    rings = polygons.select("zip", "polygon", F.posexplode("rings").alias("ring", "points"))
    vertices = rings.select("zip", "polygon", "ring", F.posexplode("points").alias("vertex", "p"))
    return vertices.select("zip", "polygon", "ring", "vertex", F.col("p.x").alias("x"), F.col("p.y").alias("y"))


@query(f"""
    WITH {ITEM_POINT_CTE}
    SELECT l_orderkey, l_linenumber, l_suppkey, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y FROM point""")
def st_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = item_points(spark, sf_dir).withColumn("pt", point("LONGITUDE", "LATITUDE"))
    return placed.select(*_ITEM_KEY, F.col("pt.x").alias("x"), F.col("pt.y").alias("y"))


@query(f"""
    WITH {hit_cte(ITEM_POINT_CTE)}
    SELECT l_orderkey, l_linenumber, l_suppkey, h.point_id IS NOT NULL AS in_home_zone
    FROM point p JOIN zone z ON z.s_suppkey = p.l_suppkey
    LEFT JOIN hit h ON h.point_id = p.point_id AND h.zip = z.zip""")
def st_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    # each point against the one zone of its supplier
    homes = zone_frame(spark, sf_dir).select(F.col("s_suppkey").alias("l_suppkey"), "zip")
    geometry = geom_from_geojson(clean_geometry(F.col("f")))
    shapes = _features(spark, sf_dir).select(feature_zip(F.col("f")).alias("zip"), edges_of(geometry).alias("edges"))
    paired = item_points(spark, sf_dir).join(homes.join(shapes, "zip"), "l_suppkey")
    inside = within_edges(point("LONGITUDE", "LATITUDE"), F.col("edges"))
    return paired.select(*_ITEM_KEY, inside.alias("in_home_zone"))


_LON_LAT = f"{degrees('x')} AS \"LONGITUDE\", {degrees('y')} AS \"LATITUDE\""


@query(f"""
    WITH {hit_cte(ITEM_POINT_CTE)}
    SELECT l_orderkey, l_linenumber, l_suppkey, zip, {_LON_LAT.replace("(x)", "(hit.x)").replace("(y)", "(hit.y)")}
    FROM hit JOIN point USING (point_id) WHERE {_NUMBERED}""")
def spatial_within_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return within_join(item_points(spark, sf_dir), _zones(spark, sf_dir))


def _first_sql(by: str) -> str:
    return f"""
        SELECT point_id AS event_id, data_date, hr, {_LON_LAT}, zip
        FROM (SELECT *, row_number() OVER (PARTITION BY zip{by} ORDER BY point_id) AS place
              FROM hit JOIN (SELECT point_id, data_date, hr FROM point) USING (point_id))
        WHERE place = 1 AND {_NUMBERED}"""


@query(f"WITH {hit_cte(EVENT_POINT_CTE)} {_first_sql('')}")
def spatial_first_per_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_per_zone(event_points(spark, sf_dir), _zones(spark, sf_dir), "event_id")


@query(f"""
    WITH {hit_cte(EVENT_POINT_CTE)}
    SELECT * FROM ({_first_sql(', data_date, hr')}) WHERE zip IN (SELECT zip FROM zone WHERE s_suppkey % 2 = 0)""")
def zone_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    target_path, out = scratch_folder(spark), scratch_folder(spark)
    targets = zone_frame(spark, sf_dir).where("s_suppkey % 2 = 0")
    targets.select("zip", "s_name").write.option("header", True).csv(target_path)
    features, points = read_tsv(spark, feature_file(spark, sf_dir)), event_points(spark, sf_dir)
    # a run per half of the days; the second leaves what the first one wrote
    for half in ("data_date < '2024-01-16'", "data_date >= '2024-01-16'"):
        names = read_csv_columns(spark, target_path, "zip")
        assign_zones(features, names, points.where(half), out, "event_id", ["data_date", "hr"], packed=True)
    return read_slots(spark, out)


_FAR = 3_000_000_000
_FAR_CTE = hit_cte(ITEM_POINT_CTE.replace(ITEM_X, f"({ITEM_X} + {_FAR})")).replace(
    f"{lattice_x('s_suppkey')} AS zx", f"{lattice_x('s_suppkey')} + {_FAR} AS zx"
)


@query(f"WITH {_FAR_CTE} SELECT l_orderkey, l_linenumber, zip AS cell, CAST(x AS BIGINT) AS base FROM hit JOIN point USING (point_id, x)")
def spatial_far_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones 3,000 degrees to the east, and points with columns that are named like those of cells."""
    shifted = zone_frame(spark, sf_dir).withColumn("zx", F.col("zx") + F.lit(_FAR))
    zones = zone_table(shifted.select("zip", spark_expr(_CLEAN).alias("geometry")))
    points = read_given(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.lit("mine").alias("cell"), spark_expr(f"{ITEM_X} + {_FAR}").alias("base"),
        spark_expr(degrees(f"{ITEM_X} + {_FAR}")).alias("LONGITUDE"), spark_expr(degrees(ITEM_Y)).alias("LATITUDE"),
    )
    found = within_join(points, zones).where("cell = 'mine'")
    return found.select("l_orderkey", "l_linenumber", F.col("zip").alias("cell"), F.col("base").cast("bigint").alias("base"))


_MERIDIAN_CTE = (
    hit_cte(ITEM_POINT_CTE.replace(ITEM_X, MERIDIAN_X).replace(ITEM_Y, MERIDIAN_Y))
    .replace(f"{lattice_x('s_suppkey')} AS zx", f"{MERIDIAN_ZONE_X} AS zx")
    .replace(f"{lattice_y('s_suppkey')} AS zy", f"{MERIDIAN_ZONE_Y} AS zy")
)


@query(f"""
    WITH {_MERIDIAN_CTE}
    SELECT l_orderkey, l_linenumber, zip, CASE WHEN x > 180000000 THEN 'west' ELSE 'east' END AS side
    FROM hit JOIN point USING (point_id, x)""")
def spatial_across_meridian(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones that reach from 179.9 to -179.9 degrees, and points on both sides; the SQL counts longitudes on beyond 180."""
    placed = zone_frame(spark, sf_dir).withColumns({"zx": spark_expr(MERIDIAN_ZONE_X), "zy": spark_expr(MERIDIAN_ZONE_Y)})
    zones = zone_table(placed.select("zip", spark_expr(geometry_sql("", roll=True)).alias("geometry")))
    points = read_given(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", spark_expr(degrees(rolled(MERIDIAN_X))).alias("LONGITUDE"),
        spark_expr(degrees(MERIDIAN_Y)).alias("LATITUDE"),
    )
    side = F.when(F.col("LONGITUDE").cast("double") < 0, "west").otherwise("east").alias("side")
    return within_join(points, zones).select("l_orderkey", "l_linenumber", "zip", side)


# shapes by number of the supplier: two sound ones, then one for each fault
_CHECKED = [
    ([[[(0, 0), (8, 0), (8, 4), (4, 4), (4, 8), (0, 8), (0, 0)]]], None),
    ([[[(0, 0), (8, 0), (8, 8), (0, 8), (0, 0)], [(2, 2), (6, 6), (2, 6), (0, 4), (2, 2)]]], None),
    ([[[(0, 0), (8, 8), (8, 0), (0, 8), (0, 0)]]], "polygon 0 ring 0 crosses or touches itself"),
    ([[[(0, 0), (8, 0), (8, 8), (0, 8), (0, 0)], [(9, 1), (12, 1), (12, 4), (9, 1)]]], "polygon 0 ring 1 is not inside its shell"),
    ([[[(0, 0), (8, 0), (8, 8), (0, 8), (0, 0)], [(2, 2), (10, 2), (10, 4), (2, 4), (2, 2)]]], "polygon 0 rings 0 and 1 cross"),
    ([[[(0, 0), (8, 0), (8, 8), (0, 0)]], [[(5, 1), (7, 1), (7, 2), (5, 1)]]], "polygon 1 lies inside polygon 0"),
    ([[[(0, 0), (8, 0), (0, 0)]]], "polygon 0 ring 0 encloses no area"),
    ([[[(0, 0), (4, 0), (4, 4), (0, 0)]], [[(2, -1), (8, -1), (3, 3), (2, -1)]]], "polygons 0 and 1 cross"),
    ([[[(0, 0), (8, 0), (8, 8), (0, 8), (0, 0)], [(1, 1), (7, 1), (7, 7), (1, 1)], [(5, 2), (6, 2), (6, 3), (5, 2)]]],
     "polygon 0 ring 2 lies inside ring 1"),
]


def _checked_geometry() -> str:
    cases = []
    for i, (shape, _) in enumerate(_CHECKED):
        rings = ", ".join(
            "[" + ", ".join(
                "[" + ", ".join(f"[x{x:+}d, y{y:+}d]" for x, y in ring) + "]" for ring in polygon
            ) + "]" for polygon in shape
        )
        cases.append(f"WHEN {i} THEN '[{rings}]'")
    return f"CASE s_suppkey % {len(_CHECKED)} {' '.join(cases)} END"


@query(f"""
    WITH {ZONE_CTE}, wrong(kind, reason) AS (VALUES {", ".join(f"({i}, '{r}')" for i, (_, r) in enumerate(_CHECKED) if r)})
    SELECT zip, reason FROM zone JOIN wrong ON s_suppkey % {len(_CHECKED)} = kind""")
def zone_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with zones of sound and unsound shapes, each at its place in the lattice."""
    text = F.expr(_checked_geometry())
    for axis, origin in (("x", "zx"), ("y", "zy")):
        for offset in sorted({p[axis == "y"] for shape, _ in _CHECKED for polygon in shape for ring in polygon for p in ring}):
            text = F.replace(text, F.lit(f"{axis}{offset:+}d"), spark_expr(degrees(f"{origin} + unit * ({offset})")))
    geometry = F.concat(F.lit('{"type":"MultiPolygon","coordinates":'), text, F.lit("}"))
    return faults_of(zone_frame(spark, sf_dir).select("zip", geometry.alias("geometry")))
