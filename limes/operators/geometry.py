"""Polygons as vertex arrays on an integer grid, and their borders as segments.

A polygon row is (code, ring, vertices): vertices is an array of struct(x, y), closed; shells run counter-clockwise and
holes clockwise, so that the unit lies left of each directed segment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limes.operators.tiles import edge_tiles, point_windings
from limes.sources.tables import shuffled, stored


def round_grid(x: Column, y: Column, decimals: int = 7) -> Column:
    """struct(x, y) on the fixed grid, as integers."""
    return F.struct(F.round(x * 10**decimals).cast("long").alias("x"), F.round(y * 10**decimals).cast("long").alias("y"))


def drop_repeats(vertices: Column) -> Column:
    """Vertices without those that equal the one before."""
    return F.filter(vertices, lambda v, i: (i == 0) | (v != F.element_at(vertices, F.greatest(i, F.lit(1)))))


def ring_segments(polygons: DataFrame) -> DataFrame:
    """code, ring, seq, x1, y1, x2, y2 of each directed segment; no shuffle."""
    ends = F.slice("vertices", F.lit(2), F.greatest(F.size("vertices") - 1, F.lit(0)))
    rows = polygons.select("code", "ring", "vertices", F.posexplode(ends).alias("seq", "b"))
    a = F.get("vertices", F.col("seq"))
    return rows.select("code", "ring", "seq", a["x"].alias("x1"), a["y"].alias("y1"), F.col("b.x").alias("x2"), F.col("b.y").alias("y2"))


def polygon_measures(segments: DataFrame) -> DataFrame:
    """code, area2 (twice the area, exact), perimeter, bounding box and number of vertices; holes count off."""
    # of a closed ring the same sum as that of x1 y2 - x2 y1, and far from the origin its terms stay small, so fractions lose no digits
    cross = (F.col("x1") + F.col("x2")) * (F.col("y2") - F.col("y1"))
    length = F.sqrt(((F.col("x2") - F.col("x1")) * (F.col("x2") - F.col("x1")) + (F.col("y2") - F.col("y1")) * (F.col("y2") - F.col("y1"))).cast("double"))
    return segments.groupBy("code").agg(F.sum(cross).alias("area2"), F.round(F.sum(length), 3).alias("perimeter"), F.min("x1").alias("min_x"), F.min("y1").alias("min_y"), F.max("x1").alias("max_x"), F.max("y1").alias("max_y"), F.count("*").alias("vertices"))


def label_points(polygons: DataFrame) -> DataFrame:
    """Mean of the vertices of the first ring, the closing one included."""
    v = polygons.filter("ring = 0").select("code", F.explode("vertices").alias("v"))
    return v.groupBy("code").agg(F.round(F.avg("v.x"), 6).alias("x"), F.round(F.avg("v.y"), 6).alias("y"))


def geometry_checks(polygons: DataFrame, bounds: tuple[int, int, int, int] | None = None, cell: int = 4000) -> DataFrame:
    """code, ring, fault: empty, unclosed, short, flat or repeated vertices, turned rings, vertices off the grid or out of bounds
    (min x, min y, max x, max y), edges of a ring that cross or touch other than in a row, and what ring_faults tells of a unit's rings.
    """
    v = F.col("vertices")
    n = F.coalesce(F.size(v), F.lit(0))
    # seen from the first vertex: an unclosed ring is measured as if it were closed, wherever it lies, and products stay exact
    from_first = lambda i, c: F.get(v, i)[c] - F.get(v, F.lit(0))[c]
    area2 = F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), F.lit(0.0), lambda s, i: s + (from_first(i - 1, "x") * from_first(i, "y") - from_first(i, "x") * from_first(i - 1, "y")).cast("double"))
    shell = F.when(F.col("ring") == 0, 1).otherwise(-1)
    outside = F.lit(False)
    if bounds:
        outside = F.exists(v, lambda p: (p["x"] < bounds[0]) | (p["y"] < bounds[1]) | (p["x"] > bounds[2]) | (p["y"] > bounds[3]))
    faults = F.array_compact(F.array(
        F.when(n <= 0, "empty"), F.when((n > 0) & (F.get(v, F.lit(0)) != F.get(v, n - 1)), "unclosed"), F.when((n > 0) & (n < 4), "short"),
        F.when((n >= 4) & (area2 == 0), "flat"), F.when((n >= 4) & (area2 * shell < 0), "turned"), F.when((n > 0) & (F.size(drop_repeats(v)) < n), "repeated vertex"),
        F.when(outside, "out of bounds"), F.when(F.exists(v, lambda p: (p["x"] != F.round(p["x"])) | (p["y"] != F.round(p["y"]))), "off the grid"),
    ))
    segments = ring_segments(polygons)
    crossed = crossing_edges(segments, cell).select("code", "ring").distinct().withColumn("fault", F.lit("crossing edges"))
    return polygons.select("code", "ring", F.explode(faults).alias("fault")).unionByName(crossed).unionByName(ring_faults(segments, cell))


def ring_faults(segments: DataFrame, cell: int) -> DataFrame:
    """code, ring, fault: rings of a unit that cross or run along each other, holes outside their shell (ring 0) or within another hole.

    Rings may touch at single points.  The middles of its edges tell where a hole lies, unless it crosses another ring.
    """
    units = segments.filter("ring > 0").select("code").distinct()
    segments = stored(segments.join(units, "code", "left_semi"))  # units of one ring have no such faults
    met = stored(crossing_rings(segments, cell))
    crossing = met.select("code", F.explode(F.array("ring", "other")).alias("ring")).distinct()
    halves = lambda df: df.select("code", "ring", "seq", *[(2 * F.col(c)).cast("long").alias(c) for c in ("x1", "y1", "x2", "y2")])
    rows = halves(segments)
    holes = rows.filter("ring > 0")
    points = holes.select("code", F.struct("ring", "seq").alias("id"), ((F.col("x1") + F.col("x2")) / 2).cast("long").alias("x"), ((F.col("y1") + F.col("y2")) / 2).cast("long").alias("y"))
    within = point_windings(points, rows.withColumn("net", F.lit(1)), 2 * cell, "code", "ring").select("code", F.col("id.ring").alias("of"), "ring").filter("of <> ring")
    # of rings that don't cross, most middles lie on one side; one at which rings touch may not
    size = holes.groupBy("code", F.col("ring").alias("of")).agg(F.count("*").alias("n"))
    held = within.groupBy("code", "of", "ring").agg(F.count("*").alias("k")).join(size, ["code", "of"]).filter("2 * k > n")
    told = held.groupBy("code", F.col("of").alias("ring")).agg(F.bool_or(F.col("ring") == 0).alias("shell"), F.bool_or(F.col("ring") > 0).alias("hole"))
    nested = size.select("code", F.col("of").alias("ring")).join(crossing, ["code", "ring"], "left_anti").join(told, ["code", "ring"], "left")
    faults = F.array_compact(F.array(F.when(~F.coalesce("shell", F.lit(False)), "hole outside"), F.when(F.coalesce("hole", F.lit(False)), "hole in a hole")))
    return nested.select("code", "ring", F.explode(faults).alias("fault")).unionByName(crossing.withColumn("fault", F.lit("crossing rings")))


def turn(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> Column:
    """Sign of the turn from a over b to c; exact on integers."""
    return F.signum(((bx - ax) * (cy - ay) - (by - ay) * (cx - ax)).cast("double"))


def meeting(segments: DataFrame, cell: int, same: list[str], apart: Column) -> tuple[DataFrame, dict[str, Column], list[Column]]:
    """Pairs a, b of segments that agree in the columns `same` and pass one tile, their ends, and the turns from each to the other's ends."""
    placed = edge_tiles(segments.filter("x1 <> x2 OR y1 <> y2"), cell)
    a, b = placed.alias("a"), placed.alias("b")
    pairs = a.join(shuffled(b), [F.col(f"a.{c}") == F.col(f"b.{c}") for c in (*same, "cx", "cy")]).filter(apart)
    p = {f"{s}{c}": F.col(f"{s}.{c}") for s in "ab" for c in ("x1", "y1", "x2", "y2")}
    turns = [turn(*[p[f"{s}{c}"] for c in ("x1", "y1", "x2", "y2")], p[f"{o}x{k}"], p[f"{o}y{k}"]) for s, o in ("ab", "ba") for k in (1, 2)]
    boxes = (F.least(p["ax1"], p["ax2"]) <= F.greatest(p["bx1"], p["bx2"])) & (F.least(p["bx1"], p["bx2"]) <= F.greatest(p["ax1"], p["ax2"])) & (F.least(p["ay1"], p["ay2"]) <= F.greatest(p["by1"], p["by2"])) & (F.least(p["by1"], p["by2"]) <= F.greatest(p["ay1"], p["ay2"]))
    return pairs.filter(boxes), p, turns


def crossing_edges(segments: DataFrame, cell: int) -> DataFrame:
    """code, ring, seq, other: edges of one ring that cross or touch, neighbours apart from their common end; met by tiles."""
    pairs, p, (t1, t2, t3, t4) = meeting(segments, cell, ["code", "ring"], F.col("a.seq") < F.col("b.seq"))
    # edges in a row share an end; they are at fault only if the second runs back over the first
    in_row = ((p["ax2"] == p["bx1"]) & (p["ay2"] == p["by1"])) | ((p["bx2"] == p["ax1"]) & (p["by2"] == p["ay1"]))
    along = (p["ax2"] - p["ax1"]) * (p["bx2"] - p["bx1"]) + (p["ay2"] - p["ay1"]) * (p["by2"] - p["by1"])
    folded = (t1 == 0) & (t2 == 0) & (t3 == 0) & (t4 == 0) & (along < 0)
    return pairs.filter((t1 * t2 <= 0) & (t3 * t4 <= 0) & (~in_row | folded)).select("a.code", "a.ring", "a.seq", F.col("b.seq").alias("other")).distinct()


def crossing_rings(segments: DataFrame, cell: int) -> DataFrame:
    """code, ring, other: rings of one unit that cross each other or have a stretch in common.

    They cross where two edges do within, or where one passes through a corner of the other; rings that touch are looked at in whole.
    """
    pairs, p, (t1, t2, t3, t4) = meeting(segments, cell, ["code"], F.col("a.ring") < F.col("b.ring"))
    span = lambda c: F.least(F.greatest(p[f"a{c}1"], p[f"a{c}2"]), F.greatest(p[f"b{c}1"], p[f"b{c}2"])) - F.greatest(F.least(p[f"a{c}1"], p[f"a{c}2"]), F.least(p[f"b{c}1"], p[f"b{c}2"]))
    along = (t1 == 0) & (t2 == 0) & ((span("x") > 0) | (span("y") > 0))
    across = (t1 * t2 < 0) & (t3 * t4 < 0)
    cut = pairs.filter(along | across).select("a.code", "a.ring", F.col("b.ring").alias("other"))
    touch = pairs.filter(~along & ~across & (t1 * t2 <= 0) & (t3 * t4 <= 0))
    # a middle that lies on the other ring tells no side
    halfway = {s: (p[f"{s}x1"] + p[f"{s}x2"], p[f"{s}y1"] + p[f"{s}y2"]) for s in "ab"}
    on = {s: turn(*[2 * p[f"{o}{c}"] for c in ("x1", "y1", "x2", "y2")], *halfway[s]) == 0 for s, o in ("ab", "ba")}
    middles = touch.select(F.col("a.code").alias("code"), F.explode(F.array(*[F.when(on[s], F.struct(F.col(f"{s}.ring").alias("of"), F.col(f"{s}.seq").alias("seq"), F.col(f"{o}.ring").alias("around"))) for s, o in ("ab", "ba")])).alias("m")).filter("m IS NOT NULL").select("code", "m.*").distinct()
    touching = touch.select("a.code", "a.ring", F.col("b.ring").alias("other")).distinct()
    return cut.unionByName(through_corners(segments, touching, middles, cell)).distinct()


def through_corners(segments: DataFrame, touching: DataFrame, unclear: DataFrame, cell: int) -> DataFrame:
    """code, ring, other of touching rings of which one passes to the other side where they touch: some middles of its edges lie inside the other, some outside.

    unclear: code, of, seq, around of the edges whose middles are left out.
    """
    rows = segments.join(touching.select("code").distinct(), "code", "left_semi").select("code", "ring", "seq", *[(2 * F.col(c)).cast("long").alias(c) for c in ("x1", "y1", "x2", "y2")])
    middles = rows.select("code", F.struct("ring", "seq").alias("id"), ((F.col("x1") + F.col("x2")) / 2).cast("long").alias("x"), ((F.col("y1") + F.col("y2")) / 2).cast("long").alias("y"))
    keys = ["code", "of", "around"]
    inside = point_windings(middles, rows.withColumn("net", F.lit(1)), 2 * cell, "code", "ring").select("code", F.col("id.ring").alias("of"), F.col("id.seq").alias("seq"), F.col("ring").alias("around")).filter("of <> around")
    inner = inside.join(unclear, [*keys, "seq"], "left_anti").groupBy(*keys).agg(F.count("*").alias("inner"))
    whole = rows.groupBy("code", F.col("ring").alias("of")).agg(F.count("*").alias("n"))
    less = unclear.groupBy(*keys).agg(F.count("*").alias("less"))
    mixed = inner.join(whole, ["code", "of"]).join(less, keys, "left").filter(F.col("inner") < F.col("n") - F.coalesce("less", F.lit(0)))
    return touching.join(mixed.select("code", F.least("of", "around").alias("ring"), F.greatest("of", "around").alias("other")).distinct(), ["code", "ring", "other"], "left_semi")


def undirected(segments: DataFrame) -> DataFrame:
    """segments with their ends in order (px, py, qx, qy), and whether they run that way."""
    ahead = (F.col("x1") < F.col("x2")) | ((F.col("x1") == F.col("x2")) & (F.col("y1") < F.col("y2")))
    pick = lambda a, b: F.when(ahead, F.col(a)).otherwise(F.col(b))
    return segments.withColumns({"px": pick("x1", "x2"), "py": pick("y1", "y2"), "qx": pick("x2", "x1"), "qy": pick("y2", "y1"), "ahead": ahead})


def segment_owners(segments: DataFrame) -> DataFrame:
    """x1, y1, x2, y2, a, b, n_owners, left_code, right_code, fault: each segment once, with its owners a < b (b null for one owner).

    One shuffle on the segment's integer ends takes the place of testing polygons pairwise; codes are digits, so that owners are
    kept as numbers in fixed-size buffers.  fault: more than two borders, or two on one side.
    """
    number = F.col("code").cast("long")
    g = undirected(segments).groupBy("px", "py", "qx", "qy").agg(
        F.min(number).alias("a"), F.max(number).alias("b"), F.count("*").alias("n"), F.max(F.length("code")).alias("w"),
        F.max(F.when(F.col("ahead"), number)).alias("l"), F.max(F.when(~F.col("ahead"), number)).alias("r"),
    )
    code = lambda c: F.lpad(F.col(c).cast("string"), F.col("w"), F.lit("0"))
    several = F.col("a") != F.col("b")
    fault = (F.col("n") > 2) | ((F.col("n") == 2) & (F.col("l").isNull() | F.col("r").isNull()))
    return g.select(
        F.col("px").alias("x1"), F.col("py").alias("y1"), F.col("qx").alias("x2"), F.col("qy").alias("y2"), code("a").alias("a"), F.when(several, code("b")).alias("b"),
        F.when(several, 2).otherwise(1).cast("long").alias("n_owners"), code("l").alias("left_code"), code("r").alias("right_code"), fault.alias("fault"),
    )


def seg_length() -> Column:
    return F.sqrt(((F.col("x2") - F.col("x1")) * (F.col("x2") - F.col("x1")) + (F.col("y2") - F.col("y1")) * (F.col("y2") - F.col("y1"))).cast("double"))


def adjacency(owners: DataFrame) -> DataFrame:
    """a, b, segments, length: shared border of each pair of neighbours."""
    return owners.filter("n_owners = 2").groupBy("a", "b").agg(F.count("*").alias("segments"), F.round(F.sum(seg_length()), 3).alias("length"))


def border_saving(owners: DataFrame) -> DataFrame:
    """stored, perimeters, saved: border length with each border once, of all units' perimeters, and the share that this saves."""
    found = owners.agg(F.sum(seg_length()).alias("stored"), F.sum(seg_length() * F.col("n_owners")).alias("perimeters"))
    return found.select(F.round("stored", 3).alias("stored"), F.round("perimeters", 3).alias("perimeters"), F.round(1 - F.col("stored") / F.col("perimeters"), 6).alias("saved"))


def arc_types(owners: DataFrame) -> DataFrame:
    """Border length by kind: between units or exterior, and what storing shared borders once saves."""
    kind = F.when(F.col("n_owners") == 2, "interdistrital").otherwise("exterior")
    return owners.groupBy(kind.alias("tipo")).agg(F.count("*").alias("segments"), F.round(F.sum(seg_length()), 3).alias("length"))


def dissolve(segments: DataFrame, digits: int) -> DataFrame:
    """Outer border of the units united by prefix: segments that don't cancel within a parent; net > 0 runs as given."""
    rows = undirected(segments.withColumn("code", F.substring("code", 1, digits)))
    net = rows.groupBy("code", "px", "py", "qx", "qy").agg(F.sum(F.when(F.col("ahead"), 1).otherwise(-1)).alias("net")).filter("net <> 0")
    return net.select("code", F.col("px").alias("x1"), F.col("py").alias("y1"), F.col("qx").alias("x2"), F.col("qy").alias("y2"), F.col("net").cast("long").alias("net"))


def closure(children: DataFrame, parents: DataFrame, digits: int) -> DataFrame:
    """Segments of dissolved children that no parent has, and of parents that no child has; code, side, count.  One aggregation dissolves both."""
    side = lambda df, child: df.select("code", "x1", "y1", "x2", "y2", F.lit(child).alias("child"))
    rows = undirected(side(children, 1).unionByName(side(parents, 0)).withColumn("code", F.substring("code", 1, digits)))
    sign = F.when(F.col("ahead"), 1).otherwise(-1)
    net = rows.groupBy("code", "px", "py", "qx", "qy").agg(F.sum(sign * F.col("child")).alias("a"), F.sum(sign * (1 - F.col("child"))).alias("b"))
    out = net.filter("(a <> 0) <> (b <> 0)").withColumn("side", F.when(F.col("a") != 0, "children").otherwise("parents"))
    return out.groupBy("code", "side").agg(F.count("*").alias("segments"))


def bbox_pairs(boxes: DataFrame, cell: int) -> DataFrame:
    """Pairs a < b whose boxes (code, min_x, min_y, max_x, max_y) meet, by grids of several sizes.

    A box lives in the grid whose cells are as large as it, in four cells at most, and visits the grids of larger boxes, where it is in
    four at most too.  A pair is found in the grid of its larger box, and counted in the cell alone that holds the lower corner of what they share.
    """
    side = F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y"), F.lit(1))
    level = F.greatest(F.lit(0), F.ceil(F.log2(side / cell))).cast("int")
    rows = boxes.select("code", "min_x", "min_y", "max_x", "max_y", level.alias("own"))
    levels = sorted(r[0] for r in rows.select("own").distinct().collect())  # doublings of a size: few
    size = F.lit(cell) * F.pow(F.lit(2.0), F.col("level"))
    at = lambda c: F.floor(F.col(c) / size)

    def placed(df: DataFrame) -> DataFrame:
        return df.withColumn("cx", F.explode(F.sequence(at("min_x"), at("max_x")))).withColumn("cy", F.explode(F.sequence(at("min_y"), at("max_y"))))

    home = placed(rows.withColumn("level", F.col("own"))).alias("b")
    visit = placed(rows.withColumn("level", F.explode(F.array(*[F.lit(x) for x in levels]) if levels else F.array().cast("array<int>"))).filter("level >= own")).alias("a")
    meet = (F.col("a.min_x") <= F.col("b.max_x")) & (F.col("b.min_x") <= F.col("a.max_x")) & (F.col("a.min_y") <= F.col("b.max_y")) & (F.col("b.min_y") <= F.col("a.max_y"))
    once = (F.col("a.own") < F.col("b.own")) | (F.col("a.code") < F.col("b.code"))
    size = F.lit(cell) * F.pow(F.lit(2.0), F.col("b.level"))
    corner = (F.floor(F.greatest("a.min_x", "b.min_x") / size) == F.col("b.cx")) & (F.floor(F.greatest("a.min_y", "b.min_y") / size) == F.col("b.cy"))
    pairs = visit.join(shuffled(home), [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("level", "cx", "cy")]).filter(once & (F.col("a.code") != F.col("b.code")) & meet & corner)
    return pairs.select(F.least("a.code", "b.code").alias("a"), F.greatest("a.code", "b.code").alias("b"))


def points_in_units(points: DataFrame, segments: DataFrame, cell: int) -> DataFrame:
    """id, code of each point (id, x, y) in a unit; a point meets the edges in its tile alone, however many vertices its unit has.

    cell: extent of a tile, such that it holds some edges; a point on a border counts as a little right of it and above.
    """
    return point_windings(points, segments.withColumn("net", F.lit(1)), cell, "code").select("id", "code")


def focus_bounds(measures: DataFrame, focus: str) -> DataFrame:
    from limes.functions.columns import in_focus

    return measures.filter(in_focus(F.col("code"), focus)).agg(F.min("min_x").alias("min_x"), F.min("min_y").alias("min_y"), F.max("max_x").alias("max_x"), F.max("max_y").alias("max_y"))


def densify_points(points: Column, step: float) -> Column:
    """A line's points with further ones every `step` at most along each stretch, in one expression; shorter than two points it stays."""
    at = lambda i: F.get(points, i)

    def stretch(i: Column) -> Column:
        dx, dy = at(i + 1)["x"] - at(i)["x"], at(i + 1)["y"] - at(i)["y"]
        n = F.greatest(F.lit(1), F.ceil(F.hypot(dx, dy) / step).cast("int"))
        return F.transform(F.sequence(F.lit(0), n - 1), lambda j: F.struct((at(i)["x"] + dx * j / n).alias("x"), (at(i)["y"] + dy * j / n).alias("y")))

    whole = F.concat(F.flatten(F.transform(F.sequence(F.lit(0), F.size(points) - 2), stretch)), F.slice(points, -1, 1))
    return F.when(F.size(points) > 1, whole).otherwise(points)


def densify(lines: DataFrame, step: float) -> DataFrame:
    """id, k, x, y: points every `step` at most along each stretch (id, seq, x1, y1, x2, y2), and each line's last point."""
    n = F.greatest(F.lit(1), F.ceil(seg_length() / step).cast("int"))
    inner = lines.withColumn("n", n).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    inner = inner.select("id", "seq", "j", (F.col("x1") + (F.col("x2") - F.col("x1")) * F.col("j") / F.col("n")).alias("x"), (F.col("y1") + (F.col("y2") - F.col("y1")) * F.col("j") / F.col("n")).alias("y"))
    last = lines.groupBy("id").agg(F.max(F.struct("seq", "x2", "y2")).alias("e")).select("id", (F.col("e.seq") + 1).alias("seq"), F.lit(0).alias("j"), F.col("e.x2").cast("double").alias("x"), F.col("e.y2").cast("double").alias("y"))
    return inner.unionByName(last)
