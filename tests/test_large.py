"""What shows on large tables only: tables that Spark takes for small, rings far from the origin."""

import os

import pytest

from limes import registry
from limes.llm import spelling
from limes.operators import geometry

DATA = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@tables
@pytest.mark.parametrize("name", ["point_arc_distance", "ray_exits", "points_in_units"])
def test_exploded_tables_are_not_broadcast(spark, name):
    assert "Broadcast" not in plan(registry.queries()[name](spark, DATA))


def test_signatures_are_not_broadcast(spark):
    words = spark.range(9).selectExpr("concat('worte', chr(97 + id)) AS word")
    found = spelling.near_words(words)
    assert "Broadcast" not in plan(found) and found.count() == 36


def test_unclosed_ring_far_from_the_origin_is_not_turned(spark):
    x, y, side = 50, 36_000_000, 10
    ring = [(x, y + side), (x, y), (x + side, y), (x + side, y + side)]
    rows = [("1", 0, ring), ("2", 0, [*ring, ring[0]]), ("3", 0, [*ring, ring[0]][::-1]), ("4", 0, ring[::-1])]
    shapes = spark.createDataFrame(rows, "code string, ring int, vertices array<struct<x: bigint, y: bigint>>")
    assert sorted((r.code, r.fault) for r in geometry.geometry_checks(shapes).collect()) == [("1", "unclosed"), ("3", "turned"), ("4", "turned"), ("4", "unclosed")]


def test_area_of_fractions_far_from_the_origin(spark):
    x, y, side = 400_000.3, 1.4e9 + 0.25, 0.5
    ring = [(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]
    shapes = spark.createDataFrame([("1", 0, ring)], "code string, ring int, vertices array<struct<x: double, y: double>>")
    assert abs(geometry.polygon_measures(geometry.ring_segments(shapes)).first().area2 - 0.5) < 1e-6


def test_closure_dissolves_both_sides_at_once(spark):
    """One shuffle of all segments where there were four."""
    square = lambda x: [(x, 0), (x + 1, 0), (x + 1, 1), (x, 1), (x, 0)]
    shapes = lambda *rows: geometry.ring_segments(spark.createDataFrame([(c, 0, square(x)) for c, x in rows], "code string, ring int, vertices array<struct<x: bigint, y: bigint>>"))
    out = geometry.closure(shapes(("11", 0), ("12", 1)), shapes(("11", 0), ("13", 2)), 1)
    assert {(r.code, r.side): r.segments for r in out.collect()} == {("1", "children"): 2, ("1", "parents"): 4}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 2
