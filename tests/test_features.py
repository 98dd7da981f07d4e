"""Features, reports and registry pages on small literal inputs."""

import json
import math

from pyspark.sql import functions as F

from limes.operators import rays
from limes.sources import features

SQUARE = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]


def test_boundaries_of_both_depths_and_back(spark, tmp_path):
    rows = [
        {"type": "Feature", "properties": {"code": "01", "name": "Ñ"}, "geometry": {"type": "Polygon", "coordinates": [SQUARE]}},
        {"type": "Feature", "properties": {"code": "02", "name": None}, "geometry": {"type": "MultiPolygon", "coordinates": [[SQUARE], [SQUARE, SQUARE]]}},
        {"type": "Feature", "properties": {"code": "03", "name": "none"}, "geometry": None},
    ]
    source = tmp_path / "in.geojson"
    source.write_text('{"type":"FeatureCollection","features":[\n' + ",\n".join(json.dumps(r) for r in rows) + "\n]}\n")
    got = features.read_boundaries(spark, str(source), "code: string, name: string")
    assert sorted((r.code, r.part, r.ring, len(r.vertices)) for r in got.collect()) == [("01", 0, 0, 4), ("02", 0, 0, 4), ("02", 1, 0, 4), ("02", 1, 1, 4)]
    features.write_geojson(got, str(tmp_path / "out"))
    again = features.read_boundaries(spark, str(tmp_path / "out"), "code: string, name: string")
    assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))
    line = features.feature_lines(got).filter("code = '02'").first().line
    assert json.loads(line)["properties"] == {"code": "02", "name": None}


def test_reports_keep_nulls_and_sort_fields(spark):
    got = features.report_lines(spark.createDataFrame([(1, None)], "b int, a string"), "b").first()
    assert got.line == '{"a":null,"b":1}'


def test_hidden_blocks(spark):
    pages = ["a<div style='display:none'>x<div>y</div>z</div>b", "a<div>b</div>", "a<div style='display: none'>b", "", None]
    rows = spark.createDataFrame(list(enumerate(pages)), "k int, html string")
    assert [r[1] for r in sorted(rows.select("k", features.strip_hidden_blocks("html")).collect())] == ["ab", "a<div>b</div>", "a", "", None]


def test_registry_rows(spark):
    row = "<tr><td>{}</td><td>01 AMAZONAS</td><td>{}</td><td>{}</td></tr>"
    hidden = "<div style='display:none'><table><tr><td>9</td><td>99 X</td><td></td><td></td></tr></table></div>"
    html = "<table><tbody>" + row.format(1, "", "") + row.format(2, "0101 UNO", hidden) + row.format(3, "0101 UNO", "010101 A&amp;B") + "<tr><td>short</td></tr></tbody></table>"
    got = features.extract_registry_rows(spark.createDataFrame([(html,), (None,), ("",)], "html string"))
    assert sorted(map(tuple, got.collect())) == [("departamento", "01", "AMAZONAS"), ("distrito", "010101", "A&B"), ("provincia", "0101", "UNO")]


def test_bearings(spark):
    rows = spark.createDataFrame([("noreste", 0.0, 0.0), (None, 3.0, 4.0), (None, 0.0, 0.0), ("X", 1.0, 1.0)], "b string, x double, y double")
    got = [r[0] and (round(r[0].x, 6), round(r[0].y, 6)) for r in rows.select(rays.bearing_vector(F.col("b"), F.col("x"), F.col("y"))).collect()]
    assert got == [(round(math.sqrt(0.5), 6),) * 2, (0.6, 0.8), None, None]


def test_rays_that_meet_nothing(spark):
    segments = spark.createDataFrame([("a", 10, -5, 10, 5), ("a", 20, -5, 20, 0), ("a", 20, 0, 20, 5)], "code string, x1 long, y1 long, x2 long, y2 long")
    starts = spark.createDataFrame([(1, "a", 0, 0, 1, 0), (2, "a", 30, 0, 1, 0), (3, "b", 0, 0, 1, 0)], "id int, code string, x long, y long, dx int, dy int")
    got = {r.id: (r.hits, r.distance) for r in rays.ray_exits(starts, segments).collect()}
    assert got == {1: (2, 20.0), 2: (0, None), 3: (0, None)}
