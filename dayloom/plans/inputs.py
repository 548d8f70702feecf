"""Inputs the jobs need, derived by Spark from the given tables.

Expressions are kept as SQL text so that the checking SQL can state the same inputs; ``//`` is whole division.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dayloom.operators.partitions import write_days
from dayloom.session import read_given, scratch_database, scratch_folder

AS_OF = date(2024, 1, 30)


def spark_expr(sql: str) -> Column:
    return F.expr(sql.replace("//", " div ").replace("VARCHAR", "STRING"))


# --- events by day ---------------------------------------------------------------------------------------


def dated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_given(spark, sf_dir, "events").withColumn("data_date", F.to_date("ts"))


_EVENTS_BY_DAY: dict[tuple[str, str], str] = {}


def events_by_day(spark: SparkSession, sf_dir: str) -> str:
    """Name of the events table partitioned by day, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _EVENTS_BY_DAY:
        table = f"{scratch_database(spark)}.events_by_day"
        write_days(dated_events(spark, sf_dir), table)
        _EVENTS_BY_DAY[key] = table
    return _EVENTS_BY_DAY[key]


_WITH_SHORT_DAYS: dict[tuple[str, str], str] = {}
SHORT_DAY = "DATE '2023-12-01' + CAST(n_nationkey % 8 AS INTEGER)"
SHORT_DAYS_SQL = f"SELECT CAST({SHORT_DAY} AS DATE) AS data_date FROM nation"


def events_and_short_days(spark: SparkSession, sf_dir: str) -> str:
    """Name of a table by day of all events and, for each nation, one row more on a day before them; written once.

    Eight days have three or four of these rows.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WITH_SHORT_DAYS:
        table = f"{scratch_database(spark)}.events_and_short_days"
        day = F.date_add(F.lit(date(2023, 12, 1)), (F.col("n_nationkey") % 8).cast("int"))
        few = read_given(spark, sf_dir, "nation").select(
            (-1 - F.col("n_nationkey")).cast("bigint").alias("event_id"), day.alias("data_date")
        )
        write_days(dated_events(spark, sf_dir).unionByName(few, allowMissingColumns=True), table)
        _WITH_SHORT_DAYS[key] = table
    return _WITH_SHORT_DAYS[key]


def daily_activity(events: DataFrame) -> DataFrame:
    """(data_date, user_id, n, last_event): what the daily jobs compute from whole days of events."""
    return events.groupBy("data_date", "user_id").agg(
        F.count("*").alias("n"), F.max("event_id").alias("last_event")
    )


DAILY_ACTIVITY_SQL = """
    SELECT CAST(ts AS DATE) AS data_date, user_id, count(*) AS n, max(event_id) AS last_event
    FROM events GROUP BY 1, 2"""


def activity_table(spark: SparkSession, rows: DataFrame) -> str:
    """A fresh table of daily activity for jobs that change it."""
    table = f"{scratch_database(spark)}.daily_activity"
    write_days(rows, table)
    return table


# --- zones: one per supplier, on a lattice of 7,000 micro-degrees -------------------------------------------

ZONE_NAME = "CASE WHEN s_suppkey % 7 = 6 THEN 'Z' || CAST(s_suppkey AS VARCHAR) ELSE CAST(10000 + s_suppkey AS VARCHAR) END"
ZONE_UNIT = "CASE WHEN s_suppkey % 50 = 7 THEN 10000 ELSE 1000 END"


def lattice_x(key: str) -> str:
    return f"(-170000000 + 7000 * ({key} % 10 + 10 * (({key} // 100) % 4000)))"


def lattice_y(key: str) -> str:
    return f"(-87500000 + 7000 * (({key} // 10) % 10 + 10 * (({key} // 400000) % 2500)))"


# Three shapes in units of the zone: an L, a square with a hole, two separate triangles. Each shape is a
# list of polygons, each a list of rings.
SHAPES = [
    [[[(0, 0), (8, 0), (8, 4), (4, 4), (4, 8), (0, 8), (0, 0)]]],
    [[[(0, 0), (8, 0), (8, 8), (0, 8), (0, 0)], [(2, 2), (2, 6), (6, 6), (6, 2), (2, 2)]]],
    [[[(0, 0), (8, 0), (0, 3), (0, 0)]], [[(8, 8), (8, 4), (1, 8), (8, 8)]]],
]


def degrees(micro: str) -> str:
    """Micro-degrees as decimal text with six places."""
    return f"CAST(CAST(({micro}) * 0.000001 AS DECIMAL(10,6)) AS VARCHAR)"


def rolled(x: str) -> str:
    """Micro-degrees beyond the 180th meridian as longitudes of the other side."""
    return f"(CASE WHEN {x} > 180000000 THEN {x} - 360000000 ELSE {x} END)"


def _coordinates(shape: list, quote: str, roll: bool) -> str:
    """SQL for the JSON text of a shape's coordinates; ``quote`` stands around every number of even zones."""

    def number(origin: str, offset: int) -> str:
        value = f"{origin} + unit * {offset}"
        text = degrees(rolled(f"({value})") if roll and origin == "zx" else value)
        plain = f"CAST(CAST({text} AS DOUBLE) AS VARCHAR)"
        return f"CASE WHEN s_suppkey % 2 = 0 THEN '{quote}' || {text} || '{quote}' ELSE {plain} END"

    def listed(parts: list[str]) -> str:
        return "'[' || " + " || ',' || ".join(parts) + " || ']'"

    rings = [
        listed([listed([listed([number("zx", x), number("zy", y)]) for x, y in ring]) for ring in polygon])
        for polygon in shape
    ]
    return rings[0] if len(shape) == 1 else listed(rings)


def geometry_sql(quote: str, roll: bool = False) -> str:
    cases = " ".join(
        f"""WHEN {i} THEN '{{"type":"{'Polygon' if len(shape) == 1 else 'MultiPolygon'}","coordinates":'"""
        f" || {_coordinates(shape, quote, roll)} || '}}'"
        for i, shape in enumerate(SHAPES)
    )
    return f"CASE shape {cases} END"


FEATURE_LINE = (
    f"""'{{"type":"Feature","geometry":' || {geometry_sql('"')}"""
    """ || ',"properties":{"OWNER":"' || s_name || '","ZCTA5CE10":"' || zip || '"}}'"""
)

ZONE_CTE = f"""
zone AS (
    SELECT s_suppkey, s_name, {ZONE_NAME} AS zip, {ZONE_UNIT} AS unit, s_suppkey % 3 AS shape,
           {lattice_x('s_suppkey')} AS zx, {lattice_y('s_suppkey')} AS zy
    FROM supplier)"""


def zone_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_given(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name",
        spark_expr(ZONE_NAME).alias("zip"), spark_expr(ZONE_UNIT).alias("unit"),
        spark_expr("s_suppkey % 3").alias("shape"),
        spark_expr(lattice_x("s_suppkey")).alias("zx"), spark_expr(lattice_y("s_suppkey")).alias("zy"),
    )


def feature_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One GeoJSON feature per supplier in ``_c0``; numbers are quoted for every other one."""
    return zone_frame(spark, sf_dir).select(spark_expr(FEATURE_LINE).alias("_c0"))


def feature_file(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_folder(spark)
    feature_lines(spark, sf_dir).write.text(path)
    return path


# --- points around the zone of their supplier or user --------------------------------------------------------


def _jitter(a: str, b: str, factor_a: int, factor_b: int) -> str:
    """-500 .. 8,500; every fourth point sits on a multiple of 500, where the zone borders are."""
    raw = f"(({a} * {factor_a} + {b} * {factor_b}) % 9001)"
    return f"(CASE WHEN ({a} + {b}) % 4 = 0 THEN {raw} - {raw} % 500 ELSE {raw} END - 500)"


def place(home: str, a: str, b: str) -> tuple[str, str]:
    """SQL for x and y in micro-degrees, spread by ``a`` and ``b`` around the zone numbered ``home``."""
    return (
        f"({lattice_x(home)} + {_jitter(a, b, 7919, 104729)})",
        f"({lattice_y(home)} + {_jitter(a, b, 104723, 7907)})",
    )


# the same around the 180th meridian, where zones lie one above the other
MERIDIAN_ZONE_X, MERIDIAN_ZONE_Y = "(180000000 - 4 * unit)", "(-80000000 + (s_suppkey * 9000) % 160000000)"
MERIDIAN_X = f"(179996000 + {_jitter('l_orderkey', 'l_linenumber', 7919, 104729)})"
MERIDIAN_Y = f"(-80000000 + (l_suppkey * 9000) % 160000000 + {_jitter('l_orderkey', 'l_linenumber', 104723, 7907)})"

ITEM_X, ITEM_Y = place("l_suppkey", "l_orderkey", "l_linenumber")
EVENT_X, EVENT_Y = place("user_id", "event_id", "user_id")

# Line items have no unique key; the checking SQL numbers them.
ITEM_POINT_CTE = f"""
point AS MATERIALIZED (
    SELECT row_number() OVER () AS point_id, l_orderkey, l_linenumber, l_suppkey, {ITEM_X} AS x, {ITEM_Y} AS y
    FROM lineitem)"""
EVENT_POINT_CTE = f"""
point AS (
    SELECT event_id AS point_id, CAST(ts AS DATE) AS data_date, CAST(hour(ts) AS INTEGER) AS hr,
           {EVENT_X} AS x, {EVENT_Y} AS y
    FROM events)"""


def item_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, l_linenumber, l_suppkey, LONGITUDE, LATITUDE), the coordinates as text."""
    return read_given(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        spark_expr(degrees(ITEM_X)).alias("LONGITUDE"), spark_expr(degrees(ITEM_Y)).alias("LATITUDE"),
    )


def event_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, data_date, hr, LONGITUDE, LATITUDE)"""
    return read_given(spark, sf_dir, "events").select(
        "event_id", F.to_date("ts").alias("data_date"), F.hour("ts").alias("hr"),
        spark_expr(degrees(EVENT_X)).alias("LONGITUDE"), spark_expr(degrees(EVENT_Y)).alias("LATITUDE"),
    )


def _edge_values() -> str:
    rows = [
        f"({i}, {ax}, {ay}, {bx}, {by})"
        for i, shape in enumerate(SHAPES) for polygon in shape for ring in polygon
        for (ax, ay), (bx, by) in zip(ring, ring[1:])
    ]
    return ", ".join(rows)


def hit_cte(point_cte: str) -> str:
    """Brute force for checking: every edge of every zone whose box holds the point."""
    return f"""{ZONE_CTE},
shape_edge(shape, sx1, sy1, sx2, sy2) AS (VALUES {_edge_values()}),
edge AS (
    SELECT zip, zx + unit * sx1 AS x1, zy + unit * sy1 AS y1, zx + unit * sx2 AS x2, zy + unit * sy2 AS y2
    FROM zone JOIN shape_edge USING (shape)),
{point_cte},
near AS (
    SELECT point_id, x, y, zip FROM point JOIN zone
    ON x BETWEEN zx AND zx + 8 * unit AND y BETWEEN zy AND zy + 8 * unit),
hit AS (
    SELECT point_id, x, y, zip FROM near JOIN edge USING (zip) GROUP BY point_id, x, y, zip
    HAVING NOT bool_or((x - x1) * (y2 - y1) = (y - y1) * (x2 - x1)
                       AND x BETWEEN least(x1, x2) AND greatest(x1, x2)
                       AND y BETWEEN least(y1, y2) AND greatest(y1, y2))
       AND count(*) FILTER (WHERE (y1 > y) <> (y2 > y)
                            AND ((x - x1) * (y2 - y1) < (x2 - x1) * (y - y1)) = (y2 > y1)) % 2 = 1)"""
