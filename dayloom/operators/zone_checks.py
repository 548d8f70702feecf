"""What is wrong with the rings of zones: self-crossings, crossings between rings, holes outside of their shell, nested polygons.

Edges are laid out over grid cells of their own zone, about as many along its longer side as the square root of the number of its
edges, each edge in the cells that its line passes; only edges that share a cell are compared. So no zone is gathered into one
task, and a zone of many short edges costs about as many comparisons as it has edges. What lies inside what is asked of the
zone join. All tests are on whole micro-degrees and exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from dayloom.functions.geo import MAX_EXTENT, across_meridian, edges_of, goes_around_a_pole, st_geom_from_geojson
from dayloom.operators.spatial import spatial_within_join
from dayloom.session import stored

_MOST_SLICES = 4096  # cells along a zone's longer side, at most


def _edges(shaped: DataFrame) -> DataFrame:
    """(zip, polygon, ring, n, at, ax, ay, bx, by): edge number ``at`` of a ring's ``n``, repeated vertices left out."""
    rings = shaped.select("zip", F.posexplode("geom").alias("polygon", "rings"))
    rings = rings.select("zip", "polygon", F.posexplode("rings").alias("ring", "points"))
    before = F.concat(F.slice("points", -1, 1), F.slice("points", 1, F.size("points") - 1))
    moved = F.filter(
        F.zip_with("points", before, lambda p, q: F.struct(p["x"].alias("x"), p["y"].alias("y"), ((p["x"] != q["x"]) | (p["y"] != q["y"])).alias("moves"))),
        lambda v: v["moves"],
    )
    plain = rings.select("zip", "polygon", "ring", moved.alias("v"))
    following = F.concat(F.slice("v", 2, F.size("v")), F.slice("v", 1, 1))
    ends = F.zip_with("v", following, lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")))
    listed = plain.select("zip", "polygon", "ring", F.size("v").alias("n"), F.posexplode_outer(ends).alias("at", "e"))
    return listed.select("zip", "polygon", "ring", "n", "at", "e.*")


def _side(p: str, q: str, rx: str, ry: str) -> str:
    """Sign of the turn from edge end ``p`` over ``q`` to the point (rx, ry)."""
    return f"sign(({q}x - {p}x) * ({ry} - {p}y) - ({q}y - {p}y) * ({rx} - {p}x))"


def _laid_out(edges: DataFrame) -> DataFrame:
    """Edges with the cells of their zone's grid that they pass."""
    low, high = (lambda a, b: F.least(a, b)), (lambda a, b: F.greatest(a, b))
    boxes = edges.groupBy("zip").agg(
        F.min(low("ax", "bx")).alias("x0"), F.max(high("ax", "bx")).alias("x1"), F.min(low("ay", "by")).alias("y0"),
        F.max(high("ay", "by")).alias("y1"), F.count(F.lit(1)).alias("edges"),
    )
    slices = F.least(F.lit(_MOST_SLICES), F.ceil(F.sqrt("edges")).cast("bigint"))
    extent = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) + 1
    boxes = boxes.select("zip", "x0", "y0", F.ceil(extent / slices).cast("bigint").alias("step"))
    placed = edges.join(boxes, "zip")
    rows = F.expr("sequence((least(ay, by) - y0) div step, (greatest(ay, by) - y0) div step)")
    placed = placed.withColumn("row", F.explode(rows))
    # of a row of cells only those between the edge's line at the row's lower and upper border, a cell more on either side
    bottom, top = "(y0 + row * step)", "(y0 + (row + 1) * step)"
    at = "ax + (bx - ax) * ((least(greatest({0}, least(ay, by)), greatest(ay, by)) - ay) / (by - ay))"
    bounds = [f"if(ay = by, {end}, {at.format(border)})" for end, border in (("ax", bottom), ("bx", top))]
    first, last = (f"floor(({f}({', '.join(bounds)}) - x0) / step)" for f in ("least", "greatest"))
    columns = F.expr(f"sequence(greatest(0L, {first} - 1), greatest(0L, {last} + 1))")
    return placed.withColumn("column", F.explode(columns)).drop("x0", "y0", "step")


def _crossings(edges: DataFrame) -> DataFrame:
    """(zip, reason) of edges that meet where they must not."""
    laid = _laid_out(edges)
    names = [c for c in laid.columns if c not in ("zip", "row", "column")]
    a = laid.select("zip", "row", "column", *[F.col(c).alias(f"p_{c}") for c in names])
    b = laid.select("zip", "row", "column", *[F.col(c).alias(f"q_{c}") for c in names])
    pairs = a.join(b, ["zip", "row", "column"]).where(
        "struct(p_polygon, p_ring, p_at) < struct(q_polygon, q_ring, q_at)"
        " AND least(p_ax, p_bx) <= greatest(q_ax, q_bx) AND least(q_ax, q_bx) <= greatest(p_ax, p_bx)"
        " AND least(p_ay, p_by) <= greatest(q_ay, q_by) AND least(q_ay, q_by) <= greatest(p_ay, p_by)"
    )
    sides = {
        "s1": _side("p_a", "p_b", "q_ax", "q_ay"), "s2": _side("p_a", "p_b", "q_bx", "q_by"),
        "s3": _side("q_a", "q_b", "p_ax", "p_ay"), "s4": _side("q_a", "q_b", "p_bx", "p_by"),
    }
    pairs = pairs.withColumns({name: F.expr(side) for name, side in sides.items()})
    pairs = pairs.withColumns({
        # their boxes meet, so lines that do not lie apart meet as well
        "meet": F.expr("s1 * s2 <= 0 AND s3 * s4 <= 0"),
        "cross": F.expr("s1 * s2 < 0 AND s3 * s4 < 0"),
        # on one line, and more than a point in common
        "overlap": F.expr(
            "s1 = 0 AND s2 = 0 AND (least(greatest(p_ax, p_bx), greatest(q_ax, q_bx)) > greatest(least(p_ax, p_bx), least(q_ax, q_bx))"
            " OR least(greatest(p_ay, p_by), greatest(q_ay, q_by)) > greatest(least(p_ay, p_by), least(q_ay, q_by)))"
        ),
        "beside": F.expr("p_ring = q_ring AND p_polygon = q_polygon AND (q_at - p_at = 1 OR (p_at = 0 AND q_at = p_n - 1))"),
    })
    # two rings of a polygon may touch in points, two polygons as well; a ring may not touch itself
    itself = "p_polygon = q_polygon AND p_ring = q_ring"
    wrong = f"IF({itself}, IF(beside, overlap, meet), cross OR overlap)"
    reason = F.expr(
        f"""CASE WHEN {itself} THEN concat('polygon ', p_polygon, ' ring ', p_ring, ' crosses or touches itself')
                 WHEN p_polygon = q_polygon THEN concat('polygon ', p_polygon, ' rings ', p_ring, ' and ', q_ring, ' cross')
                 ELSE concat('polygons ', p_polygon, ' and ', q_polygon, ' cross') END"""
    )
    return pairs.where(wrong).select("zip", reason.alias("reason"))


def _inside(edges: DataFrame) -> DataFrame:
    """(zip, polygon, ring, of_polygon, of_ring): rings of which a vertex lies strictly inside another ring of the zone."""
    box = [F.min(F.least("ax", "bx")).alias("x0"), F.max(F.greatest("ax", "bx")).alias("x1"),
           F.min(F.least("ay", "by")).alias("y0"), F.max(F.greatest("ay", "by")).alias("y1")]
    turned = F.expr(
        "IF(ay < by OR (ay = by AND ax <= bx), named_struct('ax', ax, 'ay', ay, 'bx', bx, 'by', by),"
        " named_struct('ax', bx, 'ay', by, 'bx', ax, 'by', ay))"
    )
    # a zone of one ring has nothing to compare
    several = edges.groupBy("zip").agg(F.max(F.struct("polygon", "ring")).alias("m")).where("m.polygon > 0 OR m.ring > 0")
    some = edges.join(several.select("zip"), "zip", "left_semi")
    rings = some.groupBy("zip", "polygon", "ring").agg(F.collect_list(turned).alias("edges"), *box)
    key = F.to_json(F.struct("zip", "polygon", "ring"), {"ignoreNullFields": "false"})
    zones = rings.select(key.alias("zip"), "edges", "x0", "x1", "y0", "y1")
    micro = lambda c: (F.col(c) / F.lit(1_000_000).cast("decimal(8,0)")).cast("decimal(10,6)").cast("string")
    points = some.select(
        F.col("zip").alias("of_zip"), "polygon", "ring", micro("ax").alias("LONGITUDE"), micro("ay").alias("LATITUDE")
    )
    hits = spatial_within_join(points, zones)
    around = F.from_json("zip", "zip string, polygon int, ring int").alias("around")
    found = hits.select(F.col("of_zip").alias("zip"), "polygon", "ring", around)
    same = F.col("around.zip").eqNullSafe(F.col("zip")) & ((F.col("around.polygon") != F.col("polygon")) | (F.col("around.ring") != F.col("ring")))
    return found.where(same).select(
        "zip", "polygon", "ring", F.col("around.polygon").alias("of_polygon"), F.col("around.ring").alias("of_ring")
    ).distinct()


def zone_faults(texts: DataFrame) -> DataFrame:
    """(zip, reason): each thing that is wrong with a zone of ``texts(zip, geometry)``, once; sound zones have no row.

    Polygons and rings are numbered from 0, ring 0 is the shell. Rings of a polygon may touch in points. Reasons: no readable geometry, a pole or
    more than 1,000 degrees inside; a ring that encloses no area, or crosses or touches itself; rings of a polygon, or polygons, that
    cross or share a stretch; a hole that is not inside its shell, or lies inside another hole; a polygon inside another one, if not in
    a hole of it. Where rings cross, what lies inside what is not asked of them. A zone across the 180th meridian is checked unrolled.
    """
    read = stored(texts.select("zip", st_geom_from_geojson("geometry").alias("geom")))
    spans = F.expr("transform(flatten(flatten(geom)), v -> v.x)"), F.expr("transform(flatten(flatten(geom)), v -> v.y)")
    wide = F.greatest(*[F.array_max(c) - F.array_min(c) for c in spans]) > MAX_EXTENT
    reason = (
        F.when(F.col("geom").isNull(), "has no readable geometry")
        .when(wide, "spans more than 1,000 degrees")
        .when(goes_around_a_pole(F.col("geom")), "goes around a pole")
    )
    whole = read.withColumn("reason", reason)
    unread = whole.where("reason IS NOT NULL").select("zip", "reason")
    # a polygon across the meridian is there twice; its first copy is checked
    once = F.expr("transform(geom, p -> p)")
    sound = whole.where("reason IS NULL").select("zip", once.alias("geom"))
    unrolled = sound.select("zip", F.transform("geom", lambda p: F.get(across_meridian(F.array(p)), F.lit(0))).alias("geom"))
    edges = stored(_edges(unrolled))
    ring = ["zip", "polygon", "ring"]
    first = edges.where("at = 0").select(*ring, F.expr("bx - ax").alias("fx"), F.expr("by - ay").alias("fy"))
    turned = edges.join(first, ring).groupBy(*ring).agg(F.max(F.expr("(bx - ax) * fy <> (by - ay) * fx")).alias("turns"))
    flat = edges.select(*ring, "n").distinct().join(turned, ring, "left").where("n < 3 OR NOT turns").select(*ring)
    empty = flat.select("zip", F.expr("concat('polygon ', polygon, ' ring ', ring, ' encloses no area')").alias("reason"))
    lines = edges.join(flat, ring, "left_anti")
    crossings = stored(_crossings(lines).distinct())
    tangled = crossings.select("zip").distinct()
    apart = lines.join(tangled, "zip", "left_anti")
    inside = stored(_inside(apart))
    holes = apart.where("ring > 0").select(*ring).distinct()
    held = inside.where("ring > 0 AND polygon = of_polygon AND of_ring = 0").select(*ring)
    outside = holes.join(held, ring, "left_anti").select(
        "zip", F.expr("concat('polygon ', polygon, ' ring ', ring, ' is not inside its shell')").alias("reason")
    )
    nested = inside.where("polygon = of_polygon AND ring > 0 AND of_ring > 0").select(
        "zip", F.expr("concat('polygon ', polygon, ' ring ', ring, ' lies inside ring ', of_ring)").alias("reason")
    )
    shells = inside.where("ring = 0 AND polygon <> of_polygon")
    in_hole = shells.where("of_ring > 0").select("zip", "polygon", "of_polygon")
    within = shells.where("of_ring = 0").join(in_hole, ["zip", "polygon", "of_polygon"], "left_anti").select(
        "zip", F.expr("concat('polygon ', polygon, ' lies inside polygon ', of_polygon)").alias("reason")
    )
    out = unread
    for part in (empty, crossings, outside, nested, within):
        out = out.unionByName(part)
    return out.distinct()
