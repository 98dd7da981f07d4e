"""Cuts along lines that are straight in metres through parents in degrees."""

import math

from pyspark.sql import functions as F

from limes.functions import columns as C
from limes.operators import cuts
from limes.operators.geometry import densify_points

ZONE = 18
RING = [(-76.0, -10.0), (-75.4, -10.1), (-75.0, -10.0), (-75.0, -9.0), (-75.6, -9.2), (-76.0, -9.0), (-76.0, -10.0)]
HOLE = [(-75.9, -9.8), (-75.9, -9.7), (-75.8, -9.7), (-75.8, -9.8), (-75.9, -9.8)]
POINTS = "array<struct<x: double, y: double>>"


def metres(spark, points):
    rows = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(points)], "k int, x double, y double")
    e, n = C.utm(F.col("x"), F.col("y"), ZONE)
    return [(r.e, r.n) for r in rows.select("k", e.alias("e"), n.alias("n")).orderBy("k").collect()]


def area(points):
    return sum(a * d - c * b for (a, b), (c, d) in zip(points, points[1:])) / 2


def cut(spark, line, inner, **bearings):
    polygons = spark.createDataFrame([("0101", 0, k, ring) for k, ring in enumerate((RING, HOLE))], f"code string, part int, ring int, vertices {POINTS}")
    told = {"start_bearing": "continuar", "start_max": 100_000.0, "end_bearing": "continuar", "end_max": 70_000.0} | bearings
    entry = ("law", "0101", metres(spark, line), *told.values())
    entries = spark.createDataFrame([entry], f"entry string, code string, points {POINTS}, start_bearing string, start_max double, end_bearing string, end_max double")
    lines = cuts.lines_in_metres(entries, polygons, ZONE, 5000.0).withColumns({"px": F.lit(inner[0]), "py": F.lit(inner[1])})
    pieces = cuts.cut_parents(lines, polygons)
    return lines.first(), {(r.piece, r.ring): [tuple(v) for v in r.vertices] for r in pieces.collect() if r.piece}, cuts.cut_report_in_metres(lines, pieces, polygons, ZONE, 2e5).first()


def test_line_is_straight_in_metres_and_inherited_vertices_stay(spark):
    line, pieces, report = cut(spark, [(-75.55, -9.7), (-75.45, -9.4)], (-75.95, -9.5))
    assert line.status == report.status == "ok" and set(pieces) == {("new", 0), ("new", 1), ("rest", 0)}
    assert pieces["new", 1] == HOLE
    assert all(v in {*pieces["new", 0], *pieces["rest", 0]} for v in RING)
    at = metres(spark, [(p.x, p.y) for p in line.line])
    (ax, ay), (bx, by) = at[0], at[-1]
    length = math.hypot(bx - ax, by - ay)
    assert all(abs((x - ax) * (by - ay) - (y - ay) * (bx - ax)) / length < 0.01 for x, y in at)  # the projection's inverse is good to that
    assert max(math.dist(p, q) for p, q in zip(at, at[1:])) < 5000.01 and len(at) > 20
    whole, new, rest, hole = (area(metres(spark, p)) for p in (RING, pieces["new", 0], pieces["rest", 0], HOLE))
    assert abs(new + rest - whole) < 2e5 and new > 0 and rest > 0
    assert abs(report.before - whole - hole) < 1 and abs(report.new - new - hole) < 1 and abs(report.rest - rest) < 1


def test_line_without_an_exit_is_told(spark):
    line, pieces, report = cut(spark, [(-75.55, -9.7), (-75.45, -9.4)], (-75.95, -9.5), end_max=100.0)
    assert line.status == report.status == "the end doesn't meet the border once" and not pieces


def test_densified_points(spark):
    """Of no point, one point, a repeated point and two stretches."""
    rows = spark.createDataFrame([(0, []), (1, [(0.0, 0.0)]), (2, [(1.0, 1.0), (1.0, 1.0)]), (3, [(0.0, 0.0), (3.0, 4.0), (3.0, 5.0)]), (4, None)], f"k int, p {POINTS}")
    out = {r.k: r.p if r.p is None else [tuple(v) for v in r.p] for r in rows.select("k", densify_points(F.col("p"), 2.5).alias("p")).collect()}
    assert out == {0: [], 1: [(0.0, 0.0)], 2: [(1.0, 1.0), (1.0, 1.0)], 3: [(0.0, 0.0), (1.5, 2.0), (3.0, 4.0), (3.0, 5.0)], 4: None}
