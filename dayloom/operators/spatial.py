"""Point-in-polygon join as an equi-join on grid cells.

The plane is cut into square cells of 2^level micro-degrees. A zone is listed once per cell that can hold an
inner point, each cell with the few edges that pass through it; where many do, the cell is split into 16.
A point looks up its own cell at each level in use, so a point and a zone meet in at most one cell. Parts of a zone with
a wide gap between them, such as the two sides of one across the 180th meridian, have cells of their own, as small as the part
asks for; a point lies in at most one of them, and in the zone if it lies in one.

Why a cell's own edges are enough: take the path from a point (x, y) right to the cell's border and up that
border to the corner R, a hair above ``y`` and ``high`` and half a unit right of ``right``, where no vertex
lies. The point is inside if R is, flipped once per edge the path crosses, and only edges that touch the cell
can cross it. Per edge, what crosses the path equals what crosses the whole ray right of the point, the ray
right of R, and the number of its ends right of the border between ``y`` and ``high``. The ray right of R is
the same for all points of a cell, so it is settled when the cell is made (``base``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from dayloom.functions.geo import micro
from dayloom.operators.joins import BROADCAST_BYTES, fits_broadcast
from dayloom.operators.sets import union_all
from dayloom.session import stored

# Coordinates are shifted by 2^34 (more than decimal(10,6) reaches) to 35-bit naturals. Cells of 2^4 units and more leave
# room for both indexes and the marker in a bigint.
_BITS = 35
_SHIFT = 1 << (_BITS - 1)
_LEAST_LEVEL = 4
# First cells: at most about this many along a zone's longer side.
_FIRST_SIDE = 4
# A zone is cut at gaps wider than its longer side divided by 2 to this power, by x and by y in turn, so often.
_GAP_BITS = 6
_CUTS = 2
# A cell with more edges is split, at most this often; each split halves its side twice.
_FEW_EDGES = 4
_SPLITS = 3
# Out of reach of any coordinate.
_FAR = 1 << 40
# What the test of a point needs of an edge, and the values of one that never counts: the line goes `run` to the right and
# `rise` up from (`foot`, `low`), ends at height `high` and lies between `left` and `right`; `end_a` and `end_b` are the
# heights of its ends that lie right of the cell. Products are taken of differences from the foot, which are small.
_IDLE = {
    "run": 0, "rise": 0, "foot": 0, "low": _FAR, "high": -_FAR, "left": 0, "right": 0, "end_a": -_FAR, "end_b": -_FAR,
}
# Rough memory of a cell row, with its places for a few edges, and of one edge of a crowded cell.
_EDGE_BYTES = 8 * len(_IDLE)
_CELL_BYTES = 100 + _FEW_EDGES * _EDGE_BYTES


def _cell_id(x: str, y: str, level: str | int) -> Column:
    """A bigint unique over all cells of all levels: a marker bit that depends on the level, then both indexes."""
    return F.expr(
        f"shiftleft(1L, {2 * _BITS} - 2 * {level})"
        f" | shiftleft(shiftright({x} + {_SHIFT}L, {level}), {_BITS} - {level})"
        f" | shiftright({y} + {_SHIFT}L, {level})"
    )


def _one(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def _end_right(x: Column, y: Column, right: Column, high: Column) -> Column:
    return (x > right) & (y <= high)


def _ends_above(e: Column, y: Column, right: Column, high: Column) -> Column:
    a = _one(_end_right(e["ax"], e["ay"], right, high) & (y < e["ay"]))
    b = _one(_end_right(e["bx"], e["by"], right, high) & (y < e["by"]))
    return a + b


def _touches(e: Column, left: Column, right: Column, low: Column, high: Column) -> Column:
    """Does the edge come near the cell, a margin of one unit right and above included?"""

    def side(x: Column, y: Column) -> Column:
        return (e["bx"] - e["ax"]) * (y - e["ay"]) - (e["by"] - e["ay"]) * (x - e["ax"])

    corners = [side(x, y) for x in (left, right + 1) for y in (low, high + 1)]
    boxes_meet = (
        (F.greatest(e["ax"], e["bx"]) >= left) & (F.least(e["ax"], e["bx"]) <= right + 1)
        & (e["by"] >= low) & (e["ay"] <= high + 1)
    )
    return boxes_meet & (F.least(*corners) <= 0) & (F.greatest(*corners) >= 0)


def _passes_right(e: Column, right: Column, high: Column) -> Column:
    """Does the edge cross the ray right of the cell's corner R? Asked only of edges that do not touch the cell."""
    side = (e["bx"] - e["ax"]) * (high - e["ay"]) * 2 - (e["by"] - e["ay"]) * (right * 2 + 1 - e["ax"] * 2)
    return (e["ay"] <= high) & (e["by"] > high) & (side > 0)


def _narrow(cells: DataFrame, stays: Column) -> DataFrame:
    """From a cell (``base``, ``right``, ``high``, ``edges``) to the place in it that ``new_*`` gives; some stay as is."""
    size = F.expr("shiftleft(1L, new_level)")
    # renamed, since inside a lambda a name that the select also gives out would mean the new column
    outer = cells.withColumnsRenamed({name: f"outer_{name}" for name in ("right", "high", "base", "edges")})
    placed = outer.withColumns({"new_right": F.col("new_left") + size - 1, "new_high": F.col("new_low") + size - 1})
    left, right, low, high = (F.col(f"new_{c}") for c in ("left", "right", "low", "high"))

    def flips(count: Column, e: Column) -> Column:
        beside = _one(~_touches(e, left, right, low, high) & _passes_right(e, right, high))
        return count + beside + _ends_above(e, high, F.col("outer_right"), F.col("outer_high"))

    base = F.aggregate("outer_edges", F.col("outer_base"), flips) % 2
    edges = F.filter("outer_edges", lambda e: _touches(e, left, right, low, high))
    return placed.select(
        "zip", F.col("new_level").alias("level"),
        left.alias("left"), low.alias("low"), right.alias("right"), high.alias("high"),
        F.when(stays, F.col("outer_base")).otherwise(base).alias("base"),
        F.when(stays, F.col("outer_edges")).otherwise(edges).alias("edges"),
    )


def _once_sql(value: str, name: str, use: str) -> str:
    """SQL for ``use``, in which ``name`` stands for ``value``, evaluated one time."""
    return f"get(transform(array({value}), {name} -> {use}), 0)"


def _cut(edges: str, first: str, last: str) -> str:
    """SQL for a list of edges as lists of parts, cut where no edge spans more than a small share of the longer side of all.

    ``first`` and ``last`` are the ends of an edge ``e`` along the axis. The edges of a ring hang together, so a part has whole rings.
    The ray from a point crosses the rings of another part an even number of times or, if the gap is above or below, never: what
    all edges give is what those of the point's part give.
    """
    side = "greatest({})".format(", ".join(
        f"array_max(transform({edges}, e -> greatest(e.a{c}, e.b{c}))) - array_min(transform({edges}, e -> least(e.a{c}, e.b{c})))"
        for c in "xy"
    ))
    spans = f"array_sort(transform({edges}, e -> named_struct('first', {first}, 'last', {last})))"
    reach = "named_struct('first', s.first, 'last', s.last)"
    ranges = f"""aggregate(
        spans,
        named_struct('first', get(spans, 0).first, 'last', get(spans, 0).last, 'done', slice(spans, 1, 0)),
        (s, t) -> if(t.first > s.last + gap,
                     named_struct('first', t.first, 'last', t.last, 'done', concat(s.done, array({reach}))),
                     named_struct('first', s.first, 'last', greatest(s.last, t.last), 'done', s.done)),
        s -> concat(s.done, array({reach})))"""
    parts = f"transform(ranges, r -> filter({edges}, e -> {first} BETWEEN r.first AND r.last))"
    found = _once_sql(ranges, "ranges", f"if(size(ranges) = 1, array({edges}), {parts})")
    return _once_sql(f"shiftright({side}, {_GAP_BITS})", "gap", _once_sql(spans, "spans", found))


def _parts(zones: DataFrame) -> DataFrame:
    """Zones as one row per part that no wide gap runs through, each with its own box."""
    by_x, by_y = _cut("part", "least(e.ax, e.bx)", "greatest(e.ax, e.bx)"), _cut("part", "e.ay", "e.by")
    parts = "array(edges)"
    for cut in [by_x, by_y] * _CUTS:
        parts = f"flatten(transform({parts}, part -> {cut}))"
    listed = zones.select("zip", F.explode(F.expr(parts)).alias("edges"))
    xs = F.concat(F.col("edges.ax"), F.col("edges.bx"))
    return listed.select(
        "zip", "edges", F.array_min(xs).alias("x0"), F.array_max(xs).alias("x1"),
        F.array_min("edges.ay").alias("y0"), F.array_max("edges.by").alias("y1"),
    )


def _first_cells(zones: DataFrame) -> DataFrame:
    side = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) + 1
    # only even levels, to keep the number of look-ups per point small
    level = F.greatest(F.lit(_LEAST_LEVEL), F.ceil(F.log2(side / _FIRST_SIDE) / 2) * 2).cast("int")

    def starts(first: str, last: str) -> Column:
        return F.explode(F.expr(
            f"transform(sequence(shiftright({first} + {_SHIFT}L, new_level), shiftright({last} + {_SHIFT}L, new_level)),"
            f" i -> shiftleft(i, new_level) - {_SHIFT}L)"
        ))

    # the parent of a first cell is the whole plane, whose far corner is outside every zone
    whole = zones.select(
        "zip", "edges", "x0", "x1", "y0", "y1", level.alias("new_level"),
        F.lit(0).alias("base"), F.lit(_FAR).alias("right"), F.lit(_FAR).alias("high"),
    )
    placed = whole.withColumn("new_low", starts("y0", "y1")).withColumn("new_left", starts("x0", "x1"))
    return _narrow(placed, F.lit(False))


def _split(cells: DataFrame) -> DataFrame:
    """Crowded cells become 16, others stay (part -1), and cells wholly outside their zone go."""
    crowded = (F.size("edges") > _FEW_EDGES) & (F.col("level") >= _LEAST_LEVEL + 2)
    parts = F.when(crowded, F.sequence(F.lit(0), F.lit(15))).when(_may_hold(), F.array(F.lit(-1)))
    split = cells.withColumn("part", F.explode(parts))
    quarter = "shiftleft(1L, level - 2)"
    stays = "part < 0"
    return _narrow(
        split.withColumns({
            "new_level": F.expr(f"if({stays}, level, level - 2)"),
            "new_left": F.expr(f"if({stays}, left, left + (part % 4) * {quarter})"),
            "new_low": F.expr(f"if({stays}, low, low + (part div 4) * {quarter})"),
        }),
        F.expr(stays),
    )


def _may_hold() -> Column:
    return (F.size("edges") > 0) | (F.col("base") == 1)


def _edge_values(e: Column) -> Column:
    run, rise = e["bx"] - e["ax"], e["by"] - e["ay"]
    ends = {
        f"end_{p}": F.when(
            _end_right(e[f"{p}x"], e[f"{p}y"], F.col("right"), F.col("high")), e[f"{p}y"]
        ).otherwise(F.lit(-_FAR))
        for p in "ab"
    }
    values = {
        "run": run, "rise": rise, "foot": e["ax"], "low": e["ay"], "high": e["by"],
        "left": F.least(e["ax"], e["bx"]), "right": F.greatest(e["ax"], e["bx"]), **ends,
    }
    return F.struct(*[values[name].alias(name) for name in _IDLE])


def zone_cells(zones: DataFrame) -> DataFrame:
    """One row per part of a zone and cell that can hold an inner point.

    (zip, level, left, low, cell, base, n_edges, crowd) and the values of the first few edges as plain columns; ``crowd``
    lists all edges of a cell that has more. ``zones`` are rows of ``zone_table``. They are dealt out over all
    cores first: there are few of them, in few partitions, but each takes a while.
    """
    cells = _first_cells(_parts(zones.repartition(zones.sparkSession.sparkContext.defaultParallelism)))
    for _ in range(_SPLITS):
        cells = _split(cells)
    held = cells.withColumn("_held", F.explode(F.when(_may_hold(), F.array(F.lit(True)))))
    listed = held.select(
        "zip", "level", "left", "low", _cell_id("left", "low", "level").alias("cell"), "base",
        F.size("edges").alias("n_edges"), F.transform("edges", _edge_values).alias("edges"),
    )
    places = [
        F.coalesce(F.get("edges", F.lit(i))[name], F.lit(idle).cast("bigint")).alias(f"{name}_{i}")
        for i in range(_FEW_EDGES) for name, idle in _IDLE.items()
    ]
    crowd = F.when(F.col("n_edges") > _FEW_EDGES, F.col("edges")).alias("crowd")
    return listed.select("zip", "level", "left", "low", "cell", "base", "n_edges", crowd, *places)


def _edge_test(edge: Mapping[str, Column] | Column, x: Column, y: Column) -> tuple[Column, Column]:
    """Is the point on the edge, and does the edge flip the point's side?"""
    side = edge["run"] * (y - edge["low"]) - edge["rise"] * (x - edge["foot"])  # > 0: the edge passes right of the point
    level_with = (y >= edge["low"]) & (y <= edge["high"])
    on_edge = level_with & (side == 0) & (x >= edge["left"]) & (x <= edge["right"])
    crossed = level_with & (y < edge["high"]) & (side > 0)
    return on_edge, (crossed != (y < edge["end_a"])) != (y < edge["end_b"])


def _inside(x: Column, y: Column, most_edges: int) -> Column:
    """Strictly inside the zone, for a point and a cell row that holds it.

    A few edges are tested one by one from plain columns, which compiles to little code. Cells that stayed
    crowded need a loop over their list; it is left out when there are none, since it would keep the join
    out of whole-stage code.
    """
    on_any, parity = F.lit(False), F.col("base") == 1
    for i in range(_FEW_EDGES):
        on_edge, flips = _edge_test({name: F.col(f"{name}_{i}") for name in _IDLE}, x, y)
        on_any, parity = on_any | on_edge, parity != flips
    few = parity & ~on_any
    if most_edges <= _FEW_EDGES:
        return few

    def step(state: Column, e: Column) -> Column:
        on_edge, flips = _edge_test(e, x, y)
        return F.when((state == 2) | on_edge, F.lit(2)).when(flips, F.lit(1) - state).otherwise(state)

    return F.when(F.col("n_edges") > _FEW_EDGES, F.aggregate("crowd", F.col("base"), step) == 1).otherwise(few)


# Points of a cell that go to one task of a shuffle.
GRAIN_ROWS = 1_000_000


class Cells(NamedTuple):
    """Stored cells of a set of zones, measured once; any number of joins can use them."""

    rows: DataFrame
    bytes_by_level: dict[int, int]
    most_edges: int
    box: tuple[int, int, int, int] | None  # left, right, low, high of all cells; None without cells

    def split(self, max_bytes: int) -> tuple[list[int], list[int]]:
        """Levels whose cell tables together stay within ``max_bytes``, smallest first, and the others."""
        small, large, total = [], [], 0
        for level, size in sorted(self.bytes_by_level.items(), key=lambda item: item[1]):
            total += size
            (small if total <= max_bytes else large).append(level)
        return small, large


def measured_cells(zones: DataFrame) -> Cells:
    """The cells of ``zones``, stored in the scratch folder."""
    rows = stored(zone_cells(zones))
    crowd = F.when(F.col("n_edges") > _FEW_EDGES, F.col("n_edges")).otherwise(0)
    names = F.coalesce(F.octet_length("zip"), F.lit(0))
    size = F.count("*") * _CELL_BYTES + F.sum(crowd) * _EDGE_BYTES + F.sum(names)
    side = F.expr("shiftleft(1L, level) - 1")
    # one row per level: at most 16
    levels = rows.groupBy("level").agg(
        size.alias("bytes"), F.max("n_edges").alias("most"), F.min("left").alias("left"), F.min("low").alias("low"),
        F.max(F.col("left") + side).alias("right"), F.max(F.col("low") + side).alias("high"),
    ).collect()
    if not levels:
        return Cells(rows, {}, 0, None)
    box = min(r.left for r in levels), max(r.right for r in levels), min(r.low for r in levels), max(r.high for r in levels)
    return Cells(rows, {r.level: r.bytes for r in levels}, max(r.most for r in levels), box)


def _with_cells(points: DataFrame, levels: Sequence[int]) -> DataFrame:
    ids = [_cell_id("_x", "_y", level) for level in levels]
    return points.withColumn("cell", ids[0] if len(ids) == 1 else F.explode(F.array(*ids)))


def _hashable(df: DataFrame) -> list[Column]:
    """The columns as what a hash can take: maps go as text."""
    return [F.to_json(f"`{c}`") if "map<" in kind else F.col(f"`{c}`") for c, kind in df.dtypes]


def crowded_cells(placed: DataFrame, grain_rows: int) -> DataFrame:
    """(cell, grains) of the cells of ``placed(cell)`` with more than ``grain_rows`` points: how many keys share each.

    From a histogram of the points over the cells, combined per task before it is shuffled. At most the number of points (and
    levels) / ``grain_rows`` cells have a row, so ``grain_rows`` bounds what is broadcast.
    """
    counts = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("points"))
    return counts.where(F.col("points") > grain_rows).select("cell", F.ceil(F.col("points") / grain_rows).cast("int").alias("grains"))


def _shuffled(placed: DataFrame, table: DataFrame, grain_rows: int) -> DataFrame:
    """Points and cells joined by one shuffle on cell and grain; only crowded cells have more than one grain.

    The cells' rows are copied once per grain of their cell, the others not at all. ``placed`` has a hash ``_hash`` of the
    whole point, which deals the points of a cell out over its grains.
    """
    few = F.broadcast(stored(crowded_cells(placed.select("cell"), grain_rows)))
    grains = F.coalesce(F.col("grains"), F.lit(1))
    points = placed.join(few, "cell", "left").withColumn("_grain", F.pmod("_hash", grains).cast("int")).drop("grains", "_hash")
    spread = F.explode(F.sequence(F.lit(0), grains - 1))
    cells = table.join(few, "cell", "left").withColumn("_grain", spread).drop("grains")
    return points.join(cells, ["cell", "_grain"])


def spatial_within_join(
    points: DataFrame,
    zones: DataFrame | Cells,
    lon: str = "LONGITUDE",
    lat: str = "LATITUDE",
    max_bytes: int = BROADCAST_BYTES,
    grain_rows: int = GRAIN_ROWS,
) -> DataFrame:
    """Every point with the ``zip`` of every zone it lies strictly within; points may be in several or none.

    ``zones`` is a zone table or its ``measured_cells``. Points may have columns of any name but ``zip``; those whose
    coordinates do not read as decimal(10,6) match nothing, and those outside of the box of all zones are dropped
    before they are looked up. The cell tables of as many levels as fit ``max_bytes`` are broadcast, and the points
    then stay where they are. All larger levels are joined by one shuffle of the points on cell and grain: a cell of more than
    ``grain_rows`` points, by a histogram over all of them, is shared by as many keys as it has times that.
    """
    if "zip" in points.columns:
        raise ValueError("the points have a column zip, which is the name of the zone that the join adds")
    cells = zones if isinstance(zones, Cells) else measured_cells(zones)
    small, large = cells.split(max_bytes)
    if cells.box is None:
        return points.where(F.lit(False)).withColumn("zip", F.lit(None).cast("string"))
    # a point is one column, so no column of its can meet one of the cells
    point = F.struct(*[F.col(f"`{c}`") for c in points.columns]).alias("_point")
    whole = F.xxhash64(*_hashable(points)).alias("_hash")
    placed = points.select(point, micro(lon).alias("_x"), micro(lat).alias("_y"), *([whole] if large else []))
    left, right, low, high = cells.box
    placed = placed.where(F.col("_x").between(left, right) & F.col("_y").between(low, high))

    table = cells.rows.drop("left", "low")
    parts = []
    if small:
        side = F.broadcast(table.where(F.col("level").isin(small)).drop("level"))
        parts.append(_with_cells(placed.drop("_hash"), small).join(side, "cell"))
    if large:
        side = table.where(F.col("level").isin(large)).drop("level")
        parts.append(_shuffled(_with_cells(placed, large), side, grain_rows))
    inside = _inside(F.col("_x"), F.col("_y"), cells.most_edges)
    return union_all([part.where(inside).select("_point.*", "zip") for part in parts])


def spatial_first_per_zone(
    points: DataFrame,
    zones: DataFrame | Cells,
    point_id: str,
    lon: str = "LONGITUDE",
    lat: str = "LATITUDE",
    by: Sequence[str] = (),
) -> DataFrame:
    """Of the points within each zone (and each value of ``by``) the one with the smallest id; ids are unique.

    Only ids, ``by`` and coordinates go through the zone join and the aggregate, which is by hash for numeric ids. The
    chosen points, at most one per zone and value of ``by``, are stored and then fetch the rest of their rows by a
    join, in which they are broadcast if they measure small.
    """
    names = list(dict.fromkeys([point_id, *by, lon, lat]))
    hits = spatial_within_join(points.select(*[F.col(f"`{c}`") for c in names]), zones, lon, lat)
    first = hits.groupBy(*[F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)], "zip").agg(F.min(point_id).alias("_first"))
    chosen = stored(first)
    side = F.broadcast(chosen) if fits_broadcast(chosen) else chosen
    return points.join(side, F.col(f"`{point_id}`") == F.col("_first")).select(*[points[f"`{c}`"] for c in points.columns], "zip")
