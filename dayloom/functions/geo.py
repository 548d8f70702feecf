"""Points, polygons and the strict point-in-polygon test, in whole micro-degrees.

Coordinates are decimal(10,6) scaled to bigint, so every comparison below is exact. A geometry is a list
of polygons, each a list of rings of ``struct<x,y>``. The test itself runs on edges: segments
``struct<ax,ay,bx,by>`` turned so that ``ay <= by``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from dayloom.functions.text import decimal_coord

# Fixed value: micro-degrees per degree.
MICRO = 1_000_000
# A zone may lie anywhere that decimal(10,6) reaches, but no wider or higher than this: then all products of
# differences stay within a bigint.
MAX_EXTENT = 1000 * MICRO

_GEOMETRY_SCHEMA = "type string, coordinates string, geometries array<struct<type:string,coordinates:string>>"
_POLYGON = "array<array<array<string>>>"
_MULTI_POLYGON = f"array<{_POLYGON}>"


def micro(value: Column | str) -> Column:
    return (decimal_coord(value) * F.lit(MICRO)).cast("bigint")


def st_point(lon: Column | str, lat: Column | str) -> Column:
    return F.struct(micro(lon).alias("x"), micro(lat).alias("y"))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated one time however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def st_geom_from_geojson(geometry: Column | str) -> Column:
    """Polygon, MultiPolygon, or a GeometryCollection of them, as text, to polygons of rings; NULL when any part does not parse.

    The members of a collection are taken as the polygons of one geometry, so they must not overlap. Points and lines have no inside: NULL.
    """

    def member(parsed: Column) -> Column:
        coordinates = parsed["coordinates"]
        one = F.array(F.from_json(coordinates, _POLYGON))
        many = F.from_json(coordinates, _MULTI_POLYGON)
        return F.when(parsed["type"] == "Polygon", one).when(parsed["type"] == "MultiPolygon", many)

    def polygons(parsed: Column) -> Column:
        collected = F.flatten(F.transform(parsed["geometries"], member))  # NULL if any member is
        return F.when(parsed["type"] == "GeometryCollection", collected).otherwise(member(parsed))

    def vertex(pair: Column) -> Column:
        return st_point(F.get(pair, F.lit(0)), F.get(pair, F.lit(1)))

    def usable(point: Column) -> Column:
        return point["x"].isNotNull() & point["y"].isNotNull()

    def checked(shape: Column) -> Column:
        vertices = F.flatten(F.flatten(shape))
        return F.when((F.size(vertices) > 0) & F.forall(vertices, usable), shape)

    texts = _once(F.from_json(geometry, _GEOMETRY_SCHEMA), polygons)
    return _once(F.transform(texts, lambda polygon: F.transform(polygon, lambda ring: F.transform(ring, vertex))), checked)


def _shifted(ring: Column, by: Column) -> Column:
    return F.transform(ring, lambda v: F.struct((v["x"] + by).alias("x"), v["y"].alias("y")))


def _turns(ring: Column) -> Column:
    """Where a ring passes the 180th meridian: (vertex behind it, 1 going east or -1), by steps of more than 180 degrees."""
    before = F.concat(F.slice(ring, 1, 1), F.slice(ring, 1, F.size(ring) - 1))
    steps = F.zip_with(ring, before, lambda v, b: v["x"] - b["x"])
    marked = F.transform(
        steps,
        lambda s, i: F.struct(i.alias("at"), F.when(s > 180 * MICRO, -1).when(s < -180 * MICRO, 1).otherwise(0).alias("turn")),
    )
    return F.filter(marked, lambda m: m["turn"] != 0)


def _net_turn(ring: Column) -> Column:
    """0 for a ring that comes back to where it began, the closing edge included; else it goes around a pole."""
    closed = F.concat(ring, F.slice(ring, 1, 1))
    return F.aggregate(_turns(closed), F.lit(0), lambda n, m: n + m["turn"])


def _unrolled(ring: Column) -> Column:
    """The ring with longitudes that go on beyond 180 degrees instead of jumping to the other side."""

    def placed(turns: Column) -> Column:
        def vertex(v: Column, i: Column) -> Column:
            rounds = F.aggregate(turns, F.lit(0), lambda n, m: F.when(m["at"] <= i, n + m["turn"]).otherwise(n))
            return F.struct((v["x"] + rounds * F.lit(360 * MICRO)).alias("x"), v["y"].alias("y"))

        return F.transform(ring, vertex)

    return _once(_turns(ring), placed)


def on_the_globe(geom: Column) -> Column:
    """Whether all longitudes lie within 180 degrees, so that a jump of more means the 180th meridian."""
    return F.forall(F.flatten(F.flatten(geom)), lambda v: F.abs(v["x"]) <= 180 * MICRO)


def goes_around_a_pole(geom: Column) -> Column:
    return on_the_globe(geom) & F.exists(F.flatten(geom), lambda ring: _net_turn(ring) != 0)


def across_meridian(geom: Column) -> Column:
    """Polygons that cross the 180th meridian as two: on either side of the plane, the other one's part beyond its edge.

    Rings are unrolled and holes moved to the side of their shell, then the polygon is repeated 360 degrees away. Vertices stay
    whole micro-degrees, where cutting at the meridian would have to round. A point lies in one of the two if it lies
    in the polygon, however its longitude is written; both are apart, as neither is wider than 360 degrees. Other polygons, and geometries with
    longitudes beyond 180 degrees, stay as they are.
    """
    longitudes = lambda ring: F.transform(ring, lambda v: v["x"])

    def beside(shell: Column, ring: Column) -> Column:
        rounds = F.ceil((F.array_min(longitudes(shell)) - F.array_min(longitudes(ring))) / F.lit(360 * MICRO))
        return _shifted(ring, rounds.cast("bigint") * F.lit(360 * MICRO))

    def twice(rings: Column) -> Column:
        east = F.array_max(longitudes(F.get(rings, F.lit(0)))) > 180 * MICRO
        away = F.when(east, F.lit(-360 * MICRO)).otherwise(F.lit(360 * MICRO))
        return F.array(rings, F.transform(rings, lambda ring: _shifted(ring, away)))

    def moved(rings: Column) -> Column:
        return F.transform(rings, lambda ring, i: F.when(i == 0, ring).otherwise(beside(F.get(rings, F.lit(0)), ring)))

    def parts(polygon: Column) -> Column:
        crosses = F.exists(polygon, lambda ring: F.size(_turns(ring)) > 0)
        unrolled = F.transform(polygon, _unrolled)
        return F.when(crosses, _once(_once(unrolled, moved), twice)).otherwise(F.array(polygon))

    def whole(shape: Column) -> Column:
        return F.when(on_the_globe(shape), F.flatten(F.transform(shape, parts))).otherwise(shape)

    return _once(geom, whole)


def edges_of(geom: Column) -> Column:
    """All edges of all rings. Each ring is closed by itself; edges never run from one ring to another."""

    def edge(a: Column, b: Column) -> Column:
        upward = (a["y"] < b["y"]) | ((a["y"] == b["y"]) & (a["x"] <= b["x"]))
        low, high = F.when(upward, a).otherwise(b), F.when(upward, b).otherwise(a)
        return F.struct(
            low["x"].alias("ax"), low["y"].alias("ay"), high["x"].alias("bx"), high["y"].alias("by")
        )

    def ring_edges(ring: Column) -> Column:
        following = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
        return F.zip_with(ring, following, edge)

    every = F.flatten(F.transform(F.flatten(geom), ring_edges))
    return F.filter(every, lambda e: (e["ax"] != e["bx"]) | (e["ay"] != e["by"]))


def edge_test(x: Column, y: Column, edges: Column) -> Column:
    """True when (x, y) lies strictly inside.

    Edges crossed by the ray to the right flip the state between 0 (outside) and 1 (inside); a point on any
    edge is not inside, whatever the others say (state 2). Most edges end at the first comparison of heights.
    """

    def step(state: Column, e: Column) -> Column:
        # reached only for points within the edge's box, where the products stay small
        side = (e["bx"] - e["ax"]) * (y - e["ay"]) - (e["by"] - e["ay"]) * (x - e["ax"])  # > 0: edge passes right
        left, right = F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"])
        below_top = y < e["by"]
        return (
            F.when((y < e["ay"]) | (y > e["by"]) | (x > right) | (state == 2), state)
            .when(x < left, F.when(below_top, F.lit(1) - state).otherwise(state))
            .when(side == 0, F.lit(2))
            .when(below_top & (side > 0), F.lit(1) - state)
            .otherwise(state)
        )

    return F.aggregate(edges, F.lit(0), step) == 1


def within_edges(point: Column, edges: Column) -> Column:
    """``st_within`` for a geometry whose edges were taken before, say on the smaller side of a join."""
    return _once(point, lambda p: edge_test(p["x"], p["y"], edges))


def st_within(point: Column, geom: Column) -> Column:
    """Strictly within: a point on the border of the geometry or of a hole is not."""
    return within_edges(point, edges_of(geom))
