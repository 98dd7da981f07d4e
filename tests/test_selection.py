"""Selection of places, numbers of rows by split, boxes of different sizes, against plain versions."""

import random

import numpy as np
from pyspark.sql import functions as F

from limes.operators import geometry, indicators, order
from limes.sources import tables


def test_selected_places(spark, monkeypatch):
    monkeypatch.setattr(indicators, "SORTED", 7)
    monkeypatch.setattr(indicators, "BUCKETS", 16)
    rng = random.Random(1)
    values = {
        "even": [rng.uniform(-5, 5) for _ in range(900)], "ties": [float(rng.randrange(3)) for _ in range(500)], "one": [4.5], "same": [2.0] * 40,
        "wide": [rng.choice([-1, 1]) * 10.0 ** rng.randrange(-9, 9) for _ in range(100)], "close": [1 + k * 2.0**-52 for k in range(60)], "tiny": [k * 5e-324 for k in range(50)],
    }
    rows = spark.createDataFrame([(m, f"{k}", v) for m, vs in values.items() for k, v in enumerate(vs)] + [("even", "x", None), ("none", "x", None)], "measure string, ubigeo string, value double").repartition(5)
    wanted = [(m, r) for m, vs in values.items() for r in {0, len(vs) // 3, len(vs) // 2, len(vs) - 1}]
    got = {(r.measure, r.r): r.value for r in indicators.selected(rows, spark.createDataFrame(wanted, "measure string, r long")).collect()}
    assert got == {(m, r): sorted(values[m])[r] for m, r in wanted}
    cuts = {r.measure: list(r.cuts) for r in indicators.quantile_cuts(rows.filter("measure IN ('even', 'one', 'ties')"), 6).collect()}
    assert np.allclose(cuts["even"], np.quantile(values["even"], np.arange(7) / 6)) and cuts["one"] == [4.5] and cuts["ties"] == [0.0, 1.0, 2.0]


def test_rows_of_a_sheet_in_splits(spark, tmp_path):
    lines = {"a.csv": [f"name {k},{k},x" for k in range(500)], "b.csv": [f"other {k},{k}," for k in range(90)]}
    for name, rows in lines.items():
        (tmp_path / name).write_text("\n".join(rows) + "\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = tables.read_census_rows(spark, str(tmp_path), 3)
        got = {(r.source.split("/")[-1], r.row_idx): r.cells[0] for r in rows.collect()}
        splits = spark.read.text(str(tmp_path / "a.csv")).select("_metadata.file_block_start").distinct().count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert splits > 5 and got == {(name, k): r.split(",")[0] for name, rows in lines.items() for k, r in enumerate(rows)}


def test_boxes_of_different_sizes(spark):
    rng = random.Random(3)
    boxes = []
    for k in range(300):
        side = rng.choice([0, 3, 10, 40, 1000, 100_000])
        x, y = rng.randrange(-2000, 2000), rng.randrange(-2000, 2000)
        boxes.append((f"{k:03d}", x, y, x + rng.randrange(side + 1), y + side))
    boxes += [("900", 0, 0, 16, 16), ("901", 16, 16, 32, 32), ("902", 17, 17, 33, 33)]
    df = spark.createDataFrame(boxes, "code string, min_x long, min_y long, max_x long, max_y long")
    got = [tuple(r) for r in geometry.bbox_pairs(df, 16).collect()]
    want = {(a[0], b[0]) for a in boxes for b in boxes if a[0] < b[0] and a[1] <= b[3] and b[1] <= a[3] and a[2] <= b[4] and b[2] <= a[4]}
    assert len(got) == len(set(got)) and set(got) == want
    assert geometry.bbox_pairs(df.limit(0), 16).count() == 0


def test_places_keep_other_columns(spark):
    rows = spark.createDataFrame([(k % 3, k, "x") for k in range(30)], "id int, p long, row string")
    got = order.numbered(rows, "id", F.desc("p")).collect()
    assert [(r.id, r.p) for r in sorted(got, key=lambda r: r.place)] == sorted(((k % 3, k) for k in range(30)), key=lambda x: (x[0], -x[1])) and got[0].row == "x"
