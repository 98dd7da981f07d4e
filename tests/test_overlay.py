"""Areas, faces, arcs, cuts and orders against plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from limes.operators import arcs, census, codes, cuts, geometry, order, overlay

SHAPE = "code string, ring int, vertices array<struct<x: bigint, y: bigint>>"


def polygon(spark, units):
    return spark.createDataFrame([(c, 0, [(x, y) for x, y in ring]) for c, ring in units], SHAPE)


def square(x, y, side=10):
    return [(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]


def star(rng, n=9, around=(0, 0)):
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    ring = [(round(around[0] + rng.uniform(300, 1000) * math.cos(a)), round(around[1] + rng.uniform(300, 1000) * math.sin(a))) for a in angles]
    return [*ring, ring[0]]


def edges(ring):
    v = np.array(ring, float)
    return np.hstack([v[:-1], v[1:]])


def test_slab_area_of_two_polygons_against_points():
    rng = random.Random(2)
    for _ in range(12):
        p, q = edges(star(rng)), edges(star(rng, around=(rng.randint(-600, 600), rng.randint(-600, 600))))
        layer = np.zeros((len(p) + len(q), 2))
        layer[: len(p), 0], layer[len(p) :, 1] = 1, 1
        got = overlay.slab_area(*np.vstack([p, q]).T, layer, lambda sums: (np.rint(sums) != 0).all(1))
        xs, ys = np.meshgrid(np.linspace(-1700, 1700, 400), np.linspace(-1700, 1700, 400))

        def inside(e):
            odd = np.zeros(xs.shape, bool)
            for x1, y1, x2, y2 in e:
                if y1 != y2:
                    odd ^= ((y1 <= ys) != (y2 <= ys)) & (xs < x1 + (ys - y1) * (x2 - x1) / (y2 - y1))
            return odd

        want = (inside(p) & inside(q)).sum() * (3400 / 399) ** 2
        assert abs(got - want) < 0.02 * want + 3000


def test_overlaps_holes_and_apart(spark):
    units = [("01", square(0, 0)), ("02", square(10, 0)), ("03", square(5, 5)), ("04", square(0, 10)), ("05", square(100, 100, 2)), ("06", square(20, 0, 30))]
    got = {(r.a, r.b): round(r.area, 6) for r in overlay.overlaps(polygon(spark, units), 16).collect()}
    assert got == {("01", "03"): 25.0, ("02", "03"): 25.0, ("03", "04"): 25.0}
    assert overlay.apart(edges(square(0, 0)), edges(square(10, 0))) and overlay.apart(edges(square(0, 0)), edges(square(10, 10)))
    assert not overlay.apart(edges(square(0, 0)), edges(square(0, 0))) and not overlay.apart(edges(square(0, 0)), edges(square(2, 2, 4)))
    assert not overlay.apart(edges(square(0, 0)), edges([(0, 0), (10, 10), (0, 10), (0, 0)]))
    grid = [(f"{i}{j}", square(10 * i, 10 * j)) for i in range(5) for j in range(5) if (i, j) not in {(1, 1), (2, 2), (3, 1), (3, 2)}]
    holes = overlay.coverage_holes(geometry.ring_segments(polygon(spark, grid)), 200).collect()
    assert sorted((r.area2, r.kind) for r in holes) == [(200, "sliver"), (600, "hole")] or sorted(r.area2 for r in holes) == [200, 200, 400]
    assert sum(r.area2 for r in holes) == 800


def test_arcs_of_a_grid(spark):
    grid = [(f"{i}{j}", square(10 * i, 10 * j)) for i in range(3) for j in range(3)]
    owners = geometry.segment_owners(geometry.ring_segments(polygon(spark, grid)))
    found = arcs.boundary_arcs(owners).collect()
    assert len([r for r in found if r.tipo == "interdistrital"]) == 12 and all(r.lado_resuelto for r in found)
    assert sum(r.length for r in found) == 24 * 10 and all(len(r.vertices) == 2 for r in found if r.b)
    corners = [r for r in found if not r.b and len(r.vertices) == 3]
    assert len(corners) == 4  # a corner cell's two outer edges are one line
    assert [(r.a, r.b or "") for r in arcs.arc_sort(arcs.boundary_arcs(owners)).collect()] == sorted((r.a, r.b or "") for r in found)


def test_arcs_of_rings_loops_and_long_borders(spark):
    """Rings without nodes, a loop that returns to its node, borders in several pieces, and sides that disagree."""
    ring = lambda n, x, y, r: [(x + round(r * math.cos(2 * math.pi * k / n)), y + round(r * math.sin(2 * math.pi * k / n))) for k in range(n)]
    lake, coast = ring(37, 0, 0, 1000), ring(64, 0, 0, 5000)
    rows = [("01", 0, [*coast, coast[0]]), ("01", 1, [*lake[::-1], lake[-1]]), ("02", 0, [*lake, lake[0]])]
    owners = geometry.segment_owners(geometry.ring_segments(spark.createDataFrame(rows, SHAPE)))
    found = {(r.a, r.b): r for r in arcs.boundary_arcs(owners).collect()}
    assert set(found) == {("01", None), ("01", "02")} and found["01", "02"].tipo == "interdistrital"
    for pair, points in ((("01", None), coast), (("01", "02"), lake)):
        v = [tuple(p) for p in found[pair].vertices]
        k = points.index(min(points))
        turned = points[k:] + points[:k]
        assert v in ([*turned, turned[0]], [turned[0], *turned[1:][::-1], turned[0]]) and v[1] == min(turned[1], turned[-1])
        assert found[pair].lado_resuelto and math.isclose(found[pair].length, sum(math.dist(p, q) for p, q in zip(v, v[1:])))
    # two squares that touch at a corner: the corner is a node, and each square's outline a loop from it
    loops = arcs.boundary_arcs(geometry.segment_owners(geometry.ring_segments(polygon(spark, [("1", square(0, 0)), ("2", square(10, 10))])))).collect()
    assert sorted([tuple(p) for p in r.vertices] for r in loops) == [[(10, 10), (0, 10), (0, 0), (10, 0), (10, 10)], [(10, 10), (10, 20), (20, 20), (20, 10), (10, 10)]]
    # a straight border of 1,000 segments is one arc with its points in order
    zigzag = [(k, (k * 7) % 5) for k in range(1001)]
    up, down = [*zigzag, (1000, 50), (0, 50), zigzag[0]], [*zigzag[::-1], (0, -50), (1000, -50), zigzag[-1]]
    owners = geometry.segment_owners(geometry.ring_segments(polygon(spark, [("1", up), ("2", down)])))
    shared = arcs.boundary_arcs(owners).filter("b IS NOT NULL").collect()
    assert len(shared) == 1 and [tuple(p) for p in shared[0].vertices] == zigzag and (shared[0].izquierda, shared[0].derecha) == ("1", "2")


def test_thinning_keeps_ends_and_sharp_points():
    line = [(0, 0), (10, 1), (20, 0), (30, 200), (40, 0), (50, 0)]
    kept = lambda least: [p for p, a in zip(line, arcs.importance(line)) if a >= least]
    assert kept(500) == [(0, 0), (20, 0), (30, 200), (40, 0), (50, 0)] or (30, 200) in kept(500)
    assert kept(1e12) == [(0, 0), (50, 0)] and kept(0) == line


def test_simplification_repairs_what_meets(spark):
    """A dent around an islet stays around it, and two borders that come close do not cross."""
    dent = [(0, 0), (400, 0), (400, 120), (480, 140), (480, 0), (1000, 0)]
    land = [*dent, (1000, 800), (0, 800), (0, 0)]
    sea = [*dent[::-1], (0, -800), (1000, -800), (1000, 0)]
    islet = [(430, 60), (450, 60), (450, 80), (430, 80), (430, 60)]
    rows = spark.createDataFrame([("1", 0, land), ("2", 0, sea), ("2", 1, islet[::-1]), ("3", 0, islet)], SHAPE)
    for interval in (200,):
        simple = arcs.simplify_layer(rows, interval, cell=256)
        assert overlay.overlaps(simple, 512, 1e-6).count() == 0
        areas = {r.code: r.area2 for r in geometry.polygon_measures(geometry.ring_segments(simple)).collect()}
        assert sum(areas.values()) == 2 * 1600 * 1000 and areas["3"] == 2 * 400
        assert geometry.ring_faults(geometry.ring_segments(simple), 256).count() == 0
        audit = {r.measure: r.value for r in arcs.simplify_audit(rows, simple, 0, 256).collect()}
        assert audit["overlaps"] == audit["overlap area"] == audit["faults"] == audit["lost"] == audit["added"] == audit["holes"] == audit["hole area"] == 0
    # without repair the chord over the dent would leave the islet on the other side
    assert [p for p, a in zip(dent, arcs.importance(dent)) if a >= 1e9] == [dent[0], dent[-1]]


def test_cut_of_a_part_with_a_hole(spark):
    rows = [("p", 0, 0, square(0, 0, 100)), ("p", 0, 1, square(10, 10, 5)[::-1]), ("p", 1, 0, square(500, 0))]
    polygons = spark.createDataFrame([(c, p, r, [(float(x), float(y)) for x, y in v]) for c, p, r, v in rows], "code string, part int, ring int, vertices array<struct<x: double, y: double>>")
    entries = [
        ("a", "p", [(40.0, 20.0), (40.0, 60.0)], "sur", 1000.0, "continuar", 60.0, 20.0, 50.0),
        ("b", "p", [(40.0, 20.0), (40.0, 60.0)], "este", 1000.0, "continuar", 10.0, 20.0, 50.0),
        ("c", "p", [(40.0, 20.0)], None, None, None, None, 20.0, 50.0),
        ("d", "p", [(12.0, -5.0), (12.0, 105.0)], None, None, None, None, 5.0, 50.0),
        ("e", "p", [(40.0, 20.0), (40.0, 60.0)], "arriba", 1000.0, None, None, 20.0, 50.0),
        ("f", "p", [(-5.0, 50.0), (105.0, 50.0)], None, None, None, None, 900.0, 50.0),
    ]
    e = spark.createDataFrame(entries, "entry string, code string, points array<struct<x: double, y: double>>, start_bearing string, start_max double, end_bearing string, end_max double, px double, py double")
    segments = geometry.ring_segments(polygons)
    lines = cuts.build_cut_lines(e, segments).join(e.select("entry", "px", "py"), "entry")
    status = {r.entry: r.status for r in lines.collect()}
    assert status == {"a": "ok", "b": "the end doesn't meet the border once", "c": "fewer than two points", "d": "ok", "e": "unknown bearing of the start", "f": "ok"}
    pieces = cuts.cut_parents(lines, polygons)
    report = {r.entry: r for r in cuts.cut_report(lines, pieces, polygons, 1e-6).collect()}
    assert (report["a"].new, report["a"].rest, report["a"].before) == (4000 - 25, 6000 + 100, 10_000 - 25 + 100) and report["a"].status == "ok"
    assert report["d"].status == "the line meets a hole" and report["f"].status == "the point lies in 0 parts" and report["c"].pieces == 0
    after = cuts.new_layer(polygons, pieces, e.select("entry", F.concat("code", "entry").alias("new_code")))
    area = {r.code: r.area2 / 2 for r in geometry.polygon_measures(geometry.ring_segments(after)).collect()}
    assert area == {"p": 6100.0, "pa": 3975.0}


def test_places(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 50), k) for k in range(1000)]
    got = order.numbered(spark.createDataFrame(rows, "v int, k int").repartition(7), "v", "k").collect()
    assert {(r.v, r.k): r.place for r in got} == {x: i + 1 for i, x in enumerate(sorted(rows))}


def test_census_sheet_as_published(spark):
    rows = ["Cuadro", "PERÚ|10", "AMAZONAS|5", "PROVINCIA BAGUA|3", "DISTRITO ARAMANGO|2", "Nota: x|4", "LIMA METROPOLITANA|9", "DISTRITO ATE|1", "REGION LIMA|3", "DISTRITO PERDIDO|1", "PROVINCIA CAÑETE|2", "DISTRITO ASIA|-"]
    sheet = spark.createDataFrame([("s", k, *(r.split("|") + [None])[:2]) for k, r in enumerate(rows)], "source string, row_idx long, name string, total string")
    blocks = spark.createDataFrame([("LIMA METROPOLITANA", "LIMA", "LIMA"), ("REGION LIMA", "LIMA", None)], "bare string, dep string, prov string")
    for stretch in (1 << 20, 3):
        census.STRETCH, before = stretch, census.STRETCH
        out = {r.bare: (r.nivel, r.clave_censo, r.value) for r in census.census_hierarchy(census.apply_blocks(census.classified_rows(sheet), blocks)).collect()}
        census.STRETCH = before
        assert out == {
            "AMAZONAS": ("departamento", "AMAZONAS", 5.0), "BAGUA": ("provincia", "AMAZONAS|BAGUA", 3.0), "ARAMANGO": ("distrito", "AMAZONAS|BAGUA|ARAMANGO", 2.0), "ATE": ("distrito", "LIMA|LIMA|ATE", 1.0),
            "PERDIDO": ("distrito", None, 1.0), "CANETE": ("provincia", "LIMA|CANETE", 2.0), "ASIA": ("distrito", "LIMA|CANETE|ASIA", None),
        }


@pytest.mark.parametrize("declared, forced, status", [(None, None, "ok"), ("120309", None, "confirmed against rule"), (None, "120301", "in use"), ("120303", "120305", "forced against confirmed"), ("120399", None, "retired")])
def test_code_conflicts(spark, declared, forced, status):
    cat = spark.createDataFrame([("distrito", "120301", "1203", "A"), ("distrito", "120302", "1203", "B")], "nivel string, ubigeo string, ubigeo_provincia string, nombre_normalizado string")
    entry = spark.createDataFrame([("1", "1203", "Nuevo", forced, declared)], "entry string, prov string, nombre string, forced string, declared string")
    out = codes.resolve_codes(entry, cat, cat.select("ubigeo"), spark.createDataFrame([("120399",)], "ubigeo string")).first()
    assert out.status == status and out.rule == "120303"
