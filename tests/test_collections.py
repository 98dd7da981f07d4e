"""Collections of features in any layout, read in splits."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from limes import registry
from limes.sources import collections, features


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "1500", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


NAMES = ["plain", 'quo"te', "back\\slash\\", "{brace", "}]", "a}b{c", '"type":"Feature"', "ñ   }", "", '\\"}', "[[["]


def made(n, seed):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        ring = [[rng.randrange(100) / 7, rng.randrange(100) / 7] for _ in range(rng.randrange(3, 40))]
        shape = {"type": "Polygon", "coordinates": [[*ring, ring[0]]]} if k % 5 else {"type": "MultiPolygon", "coordinates": [[[*ring, ring[0]]], [[*ring[:3], ring[0]]]]}
        out.append({"type": "Feature", "properties": {"code": str(k), "name": NAMES[k % len(NAMES)]}, "geometry": None if k % 17 == 3 else shape})
    return out


def layouts(fs):
    extra = {"crs": {"type": "name", "properties": {"name": "x}{", "deep": [{"type": "none"}]}}, "name": "[layer"}
    yield "one line", json.dumps({"type": "FeatureCollection", **extra, "features": fs})
    yield "compact", json.dumps({"features": fs, "type": "FeatureCollection", "last": [{"type": "x"}]}, separators=(",", ":"), ensure_ascii=False)
    yield "indented", json.dumps({"type": "FeatureCollection", **extra, "features": fs}, indent=3, ensure_ascii=False)
    yield "lines", "\n".join(json.dumps(f) for f in fs)
    yield "array", json.dumps(fs) + "\n"
    yield "collections one after the other", "\n".join(json.dumps({"type": "FeatureCollection", "features": part}) for part in (fs[:7], fs[7:]))


@pytest.mark.parametrize("k", range(6))
def test_layouts_in_splits(spark, small_splits, tmp_path, k):
    fs = made(60, k)
    name, text = list(layouts(fs))[k]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text(text, encoding="utf-8")
    (folder / "b.json").write_text(json.dumps({"type": "FeatureCollection", "features": []}))
    rows = features.read_boundaries(spark, str(folder), "code: string, name: string")
    got = sorted((r.code, r.name, r.part, r.ring, [tuple(v) for v in r.vertices]) for r in rows.collect())
    want = []
    for f in fs:
        g = f["geometry"]
        parts = [] if g is None else [g["coordinates"]] if g["type"] == "Polygon" else g["coordinates"]
        want += [(f["properties"]["code"], f["properties"]["name"], p, r, [tuple(v) for v in ring]) for p, rings in enumerate(parts) for r, ring in enumerate(rings)]
    assert got == sorted(want)
    splits = spark.read.option("lineSep", "}").text(str(folder / "a.json")).select("_metadata.file_block_start").distinct().count()
    assert splits > 10
    if name == "lines":
        by_line = features.read_boundaries(spark, str(folder / "a.json"), "code: string, name: string", by_line=True)
        assert sorted(str(r) for r in by_line.collect()) == sorted(str(r) for r in rows.collect())


def test_feature_over_many_splits(spark, small_splits, tmp_path):
    """One feature that is longer than several splits, with braces only in its strings."""
    f = [{"type": "Feature", "properties": {"code": "1", "name": "}{" * 3000}, "geometry": {"type": "Polygon", "coordinates": [[[k / 3, k % 7] for k in range(2000)]]}}, {"type": "Feature", "properties": {"code": "2", "name": "b"}, "geometry": {"type": "Polygon", "coordinates": [[[0.0, 1.0], [1.0, 1.0], [1.0, 0.0], [0.0, 1.0]]]}}]
    (tmp_path / "a.json").write_text(json.dumps({"type": "FeatureCollection", "features": f}))
    rows = {r.code: r for r in features.read_boundaries(spark, str(tmp_path / "a.json"), "code: string, name: string").collect()}
    assert len(rows["1"].vertices) == 2000 and rows["1"].name == "}{" * 3000 and len(rows["2"].vertices) == 4


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.json").write_text("")
    (tmp_path / "b.json").write_text("  \n")
    (tmp_path / "c.json").write_text('{"type":"FeatureCollection","features":[]}')
    assert features.read_boundaries(spark, str(tmp_path), "code: string").count() == 0


@pytest.mark.parametrize("tasks", [1, 7])
def test_written_collections(spark, tmp_path, tasks):
    """Each file is one collection on one line, whatever tasks the features come from; all come back."""
    square = "transform(array(0, 1, 3, 0), k -> named_struct('lon', double(k % 2), 'lat', double(k div 2)))"
    units = spark.range(0, 5000, 1, tasks).selectExpr("lpad(string(id * 7919 % 5000), 6, '0') AS code", "0 AS part", "0 AS ring", f"{square} AS vertices")
    features.write_collections(units, str(tmp_path / "out"), F.substring("code", 1, 3))
    files = sorted((tmp_path / "out").rglob("part-*"))
    read = [json.loads(f.read_text().rstrip(",")) for f in files]
    assert len(read) == 5 and all(c["features"][0]["geometry"] is c["features"][-1]["geometry"] is None for c in read)
    codes = [[f["properties"]["code"] for f in c["features"][1:-1]] for c in read]
    assert codes == [[f"{k:06}" for k in range(n, n + 1000)] for n in range(0, 5000, 1000)]
    assert features.read_boundaries(spark, str(tmp_path / "out"), "code: string").select("code").distinct().count() == 5000


def test_query_reads_all_parcels(spark):
    """On tables whose parcels come from several tasks; as one file put together from them, the head stood amid the features."""
    data = "/root/testdata/sf0.01"
    if not os.path.isdir(data):
        pytest.skip("no tables")
    assert registry.queries()["read_boundaries"](spark, data).count() == spark.read.parquet(f"{data}/orders.parquet").count()


def test_outside():
    assert collections.outside('{"a\\"}":1', False) == ("{      :1", False)
    assert collections.outside('b}"}', True) == ("   }", False) and collections.outside("b\\\\", True) == ("   ", True)
    assert collections.outside('x"', False) == ("x ", True) and collections.outside('"a\\"', False) == ("    ", True) and collections.outside('"a\\\\"', False) == ("     ", False)
