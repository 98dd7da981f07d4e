"""New units cut from a parent along a legal line.

Lines are prolonged to the parent's border, then each entry's parent is split where it lies; only the points at which the line
meets the border are new, all inherited vertices stay as they are.  What can't be cut cleanly has a status instead of pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limes.functions.columns import from_utm, utm
from limes.operators.geometry import crossing_edges, densify_points, polygon_measures, ring_segments
from limes.operators.rays import bearing_vector, ray_exits
from limes.sources.tables import SMALL_ROWS, few, shipped, shuffled, stored

#: How far a prolonged start reaches past the border, in units of the grid (metres in a legal line's projection).
MARGIN = 500.0
#: Codes that are broadcast at most, some 16 MB too.
CODES = 2 * SMALL_ROWS
POINTS = "array<struct<x: double, y: double>>"


def _end(points: str, at: int) -> Column:
    return F.element_at(points, at)


def build_cut_lines(entries: DataFrame, segments: DataFrame, cell: int = 4000) -> DataFrame:
    """entry, code, line, start_x, start_y (where the start leaves the parent), start_distance, end_hits, status.

    entries: entry, code (parent), points (array of x, y), start_bearing and end_bearing (null: no prolongation; 'continuar': straight
    on), start_max, end_max.  The start is prolonged past its farthest meeting with the border of the parent (segments) within start_max;
    the end by end_max, which must meet the border once, or the area would depend on it.
    """
    rows = entries.withColumn("points", F.col("points").cast(POINTS)).withColumn("n", F.size("points"))

    def rays(bearing: str, most: str, first: int, second: int) -> DataFrame:
        straight = F.col(bearing) == "continuar"
        dx, dy = _end("points", first)["x"] - _end("points", second)["x"], _end("points", first)["y"] - _end("points", second)["y"]
        asked = rows.filter((F.col("n") > 1) & F.col(bearing).isNotNull())
        v = bearing_vector(F.when(~straight, F.col(bearing)), dx, dy)
        return stored(asked.select(F.col("entry").alias("id"), "code", _end("points", first)["x"].alias("x"), _end("points", first)["y"].alias("y"), v["x"].alias("dx"), v["y"].alias("dy"), F.col(most).cast("double").alias("most")))

    start, end = rays("start_bearing", "start_max", 1, 2), rays("end_bearing", "end_max", -1, -2)
    out = ray_exits(start, segments).join(start.select("id", "dx", "dy"), "id")
    out = out.select(F.col("id").alias("entry"), F.col("dx").alias("sx"), F.col("dy").alias("sy"), F.col("hits").alias("start_hits"), F.col("distance").alias("start_distance"), F.col("ray_x").alias("start_x"), F.col("ray_y").alias("start_y"))
    into = ray_exits(end, segments).join(end.select("id", "dx", "dy"), "id").select(F.col("id").alias("entry"), F.col("dx").alias("ex"), F.col("dy").alias("ey"), F.col("hits").alias("end_hits"))
    whole = rows.join(out, "entry", "left").join(into, "entry", "left")
    point = lambda x, y: F.array(F.struct(x.alias("x"), y.alias("y")))
    none = F.array().cast(POINTS)
    p, q = _end("points", 1), _end("points", -1)
    reach = F.col("start_distance") + MARGIN
    before = F.when(F.col("start_hits") > 0, point(p["x"] + F.col("sx") * reach, p["y"] + F.col("sy") * reach)).otherwise(none)
    after = F.when(F.col("end_hits") == 1, point(q["x"] + F.col("ex") * F.col("end_max"), q["y"] + F.col("ey") * F.col("end_max"))).otherwise(none)
    lines = stored(whole.withColumn("line", F.when(F.col("n") > 1, F.concat(before, "points", after)).otherwise(F.col("points"))))
    as_ring = lines.select(F.col("entry").cast("string").alias("code"), F.lit(0).alias("ring"), F.col("line").alias("vertices"))
    crossed = crossing_edges(ring_segments(as_ring), cell).select(F.col("code").alias("crossed")).distinct()
    status = (
        F.when(F.col("n") < 2, "fewer than two points").when(F.col("start_bearing").isNotNull() & F.col("sx").isNull(), "unknown bearing of the start").when(F.col("end_bearing").isNotNull() & F.col("ex").isNull(), "unknown bearing of the end")
        .when(F.col("start_bearing").isNotNull() & (F.col("start_hits") == 0), "the start misses the border").when(F.col("end_bearing").isNotNull() & (F.col("end_hits") != 1), "the end doesn't meet the border once")
        .when(F.col("crossed").isNotNull(), "the line crosses itself").otherwise("ok")
    )
    found = lines.join(crossed, F.col("entry").cast("string") == F.col("crossed"), "left")
    return found.select("entry", "code", "line", F.round("start_x", 2).alias("start_x"), F.round("start_y", 2).alias("start_y"), F.round("start_distance", 1).alias("start_distance"), "end_hits", status.alias("status"))


def inside(x: float, y: float, rings: list[list[tuple]]) -> bool:
    """Whether a point is within an odd number of rings; half-open in y."""
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 <= y) != (y2 <= y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
    return odd


def meetings(line: list[tuple], ring: list[tuple]) -> list[tuple[float, float, tuple]]:
    """Place on the line, place on the ring (from 0, by stretches) and point of each meeting, in the line's order."""
    out = []
    for k, ((ax, ay), (bx, by)) in enumerate(zip(line, line[1:])):
        for j, ((cx, cy), (dx, dy)) in enumerate(zip(ring, ring[1:])):
            cross = (bx - ax) * (dy - cy) - (by - ay) * (dx - cx)
            if cross:
                t = ((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx)) / cross
                u = ((cx - ax) * (by - ay) - (cy - ay) * (bx - ax)) / cross
                if 0 <= t < 1 and 0 <= u < 1:  # half-open, so a vertex is met once
                    out.append((k + t, j + u, (ax + t * (bx - ax), ay + t * (by - ay))))
    return sorted(out)


def split_ring(ring: list[tuple], line: list[tuple]) -> list[list[tuple]] | int:
    """The two pieces of a closed ring that a line crosses twice, in the ring's direction; else the number of crossings."""
    met = meetings(line, ring)
    if len(met) != 2:
        return len(met)
    (s1, e1, p1), (s2, e2, p2) = met
    between = line[int(s1) + 1 : int(s2) + 1]
    n = len(ring) - 1

    def walk(a: float, b: float) -> list[tuple]:
        """Vertices of the ring after place a and before place b."""
        first, last = int(a) + 1, int(b)
        last += n if b < a else 0
        return [ring[k % n] for k in range(first, last + 1) if not (k == last and b == int(b))]

    one = [p1, *walk(e1, e2), p2, *reversed(between)]
    two = [p2, *walk(e2, e1), p1, *between]
    return [[*one, one[0]], [*two, two[0]]]


def cut_parents(lines: DataFrame, polygons: DataFrame) -> DataFrame:
    """entry, code, piece (new or rest), part, ring, vertices, status: the parent of each entry in two.

    lines: entry, code, line, px, py (a point inside the new unit), status as build_cut_lines has it; polygons: code, part, ring,
    vertices.  One part must hold the point and fall into two pieces; holes go with the piece that they lie in.  An entry
    that can't be cut has a row without a piece, with its status.
    """
    shape = f"entry string, code string, piece string, part int, ring int, vertices {POINTS}, status string"

    def cut(row: dict) -> list[tuple]:
        entry, code, status, px, py = row["entry"], row["code"], row["status"], row["px"], row["py"]
        out: list[tuple] = []
        if status == "ok":
            line = [(p["x"], p["y"]) for p in row["line"]]
            parts: dict[int, list] = {}
            for part, _, vertices in sorted(((r["part"], r["ring"], r["vertices"]) for r in row["rings"]), key=lambda r: r[:2]):
                parts.setdefault(int(part), []).append([(p["x"], p["y"]) for p in vertices])
            holding = [k for k, rings in parts.items() if inside(px, py, rings)]
            if len(holding) != 1:
                status = f"the point lies in {len(holding)} parts"
            else:
                shell, *holes = parts.pop(holding[0])
                pieces = split_ring(shell, line)
                if isinstance(pieces, int):
                    status = f"the line meets the border {pieces} times"
                elif any(meetings(line, h) for h in holes):
                    status = "the line meets a hole"
                else:
                    new = [inside(px, py, [p]) for p in pieces]
                    if sum(new) != 1:
                        status = f"the point lies in {sum(new)} pieces"
                    else:
                        of = lambda p: [p, *(h for h in holes if inside(*h[0], [p]))]
                        layers = [("new", of(pieces[new.index(True)])), ("rest", of(pieces[new.index(False)])), *(("rest", rings) for rings in parts.values())]
                        count = {"new": 0, "rest": 0}
                        for name, rings in layers:
                            out += [(entry, code, name, count[name], k, [{"x": float(x), "y": float(y)} for x, y in ring], status) for k, ring in enumerate(rings)]
                            count[name] += 1
        return out or [(entry, code, None, None, None, None, status)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = zip(*(piece for row in batch.to_pylist() for piece in cut(row)))
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, fields)], schema=fields)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    shipped(polygons.sparkSession)
    fields = to_arrow_schema(StructType.fromDDL(shape))
    parents = stored(lines.select("code").distinct())
    rings = polygons.join(few(parents, CODES), "code", "left_semi").groupBy("code").agg(F.collect_list(F.struct("part", "ring", F.col("vertices").cast(POINTS).alias("vertices"))).alias("rings"))
    asked = lines.select(F.col("entry").cast("string").alias("entry"), "code", "line", "px", "py", "status").dropDuplicates(["entry"])
    both = asked.join(shuffled(rings), "code", "left").withColumn("rings", F.coalesce("rings", F.array().cast(rings.schema["rings"].dataType)))
    tasks = 4 * polygons.sparkSession.sparkContext.defaultParallelism  # few bytes, but much work
    return both.repartition(tasks, "entry").mapInArrow(run, shape)


def projected(points: str, zone: int, degrees: bool) -> Column:
    """An array of points from degrees to metres of a southern UTM zone, or back to degrees."""
    to = from_utm if degrees else utm
    return F.transform(points, lambda p: F.struct(*[c.alias(k) for k, c in zip("xy", to(p["x"], p["y"], zone))]))


def lines_in_metres(entries: DataFrame, polygons: DataFrame, zone: int, step: float, cell: int = 4000) -> DataFrame:
    """Columns as build_cut_lines has them, with line in degrees: for laws whose points are metres of a UTM zone and parents in degrees.

    A law's line is straight in metres, so the parents' borders are projected to prolong it there; the line then gets points
    every `step` metres at most and goes to degrees, to cut the parents as they are.  Parents are never projected back: borders
    that a cut doesn't touch stay equal, to the last digit, to those of their neighbours.  start_x, start_y stay in metres.
    """
    parents = polygons.join(entries.select("code").distinct(), "code", "left_semi")
    segments = stored(ring_segments(parents.select("code", "ring", projected("vertices", zone, False).alias("vertices"))))
    lines = build_cut_lines(entries, segments, cell)
    return lines.withColumn("line", projected(densify_points(F.col("line"), step), zone, True))


def cut_report_in_metres(lines: DataFrame, pieces: DataFrame, polygons: DataFrame, zone: int, tolerance: float) -> DataFrame:
    """cut_report of pieces and polygons in degrees, with areas in square metres of a UTM zone."""
    metres = lambda df: df.withColumn("vertices", projected("vertices", zone, False))
    parents = polygons.join(lines.select("code").distinct(), "code", "left_semi")
    return cut_report(lines, metres(pieces), metres(parents), tolerance)


def cut_report(lines: DataFrame, pieces: DataFrame, polygons: DataFrame, tolerance: float) -> DataFrame:
    """entry, code, before, new, rest, drift, line_vertices, pieces, status: areas of a cut; status says so if they drift by more than tolerance."""
    cut = pieces.filter("piece IS NOT NULL").select(F.concat_ws("|", "entry", "piece").alias("code"), "ring", "vertices")
    area = polygon_measures(ring_segments(cut)).select(F.split("code", r"\|")[0].alias("entry"), F.split("code", r"\|")[1].alias("piece"), (F.col("area2") / 2).alias("area"))
    sums = area.groupBy("entry").agg(F.sum(F.when(F.col("piece") == "new", F.col("area"))).alias("new"), F.sum(F.when(F.col("piece") == "rest", F.col("area"))).alias("rest"), F.count("*").alias("pieces"))
    before = polygon_measures(ring_segments(polygons)).select("code", (F.col("area2") / 2).alias("before"))
    told = pieces.select("entry", F.col("status").alias("said")).distinct()
    rows = lines.select(F.col("entry").cast("string").alias("entry"), "code", F.size("line").alias("line_vertices")).join(told, "entry", "left").join(sums, "entry", "left").join(before, "code", "left")
    drift = F.abs(F.col("new") + F.col("rest") - F.col("before"))
    return rows.select("entry", "code", "before", "new", "rest", drift.alias("drift"), "line_vertices", F.coalesce("pieces", F.lit(0).cast("long")).alias("pieces"), F.when(drift > tolerance, "area drifts").otherwise(F.col("said")).alias("status"))


def new_layer(polygons: DataFrame, pieces: DataFrame, codes: DataFrame) -> DataFrame:
    """polygons (code, part, ring, vertices) with cut parents replaced by what is left of them, and the new units under their codes (entry, new_code)."""
    done = pieces.filter("piece IS NOT NULL")
    named = done.join(codes.select(F.col("entry").cast("string").alias("entry"), "new_code"), "entry").select(F.when(F.col("piece") == "new", F.col("new_code")).otherwise(F.col("code")).alias("code"), "part", "ring", "vertices")
    rest = polygons.join(few(stored(done.select("code").distinct()), CODES), "code", "left_anti").select("code", "part", "ring", F.col("vertices").cast(POINTS).alias("vertices"))
    return rest.unionByName(named)
