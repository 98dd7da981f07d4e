"""Features as GeoJSON lines, reports as JSON, and pages of code registries."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from limes.functions import columns as C
from limes.sources.collections import feature_texts

POLYGON = "array<array<array<double>>>"
#: Digits of a code by level, deepest first. Fixed values.
DIGITS = {"distrito": 6, "provincia": 4, "departamento": 2}


def read_boundaries(spark: SparkSession, path: str, properties: str, by_line: bool = False) -> DataFrame:
    """properties.*, part, ring, vertices (array of lon, lat) of the features of files.

    A file is a collection in any layout (all on one line, as services deliver it, or indented), an array of features, or one
    feature after the other; large files are read in splits.  by_line: each feature stands on a line of its own, which Spark's own reader
    splits; lines around the features (head and foot of a collection) and commas at line ends are passed over.
    Features without a geometry have no row.
    """
    lines = spark.read.text(path).select(F.regexp_replace("value", r",?\s*$", "").alias("line")) if by_line else feature_texts(spark, path).select(F.col("text").alias("line"))
    shape = f"type string, properties struct<{properties}>, geometry struct<type: string, coordinates: string>"
    rows = lines.select(F.from_json("line", shape).alias("f")).filter("f.type = 'Feature' AND f.geometry.type IN ('Polygon', 'MultiPolygon')")
    # a polygon is a multipolygon of one part; each depth is read with its own schema
    text = F.col("f.geometry.coordinates")
    parts = F.when(F.col("f.geometry.type") == "Polygon", F.array(F.from_json(text, POLYGON))).otherwise(F.from_json(text, f"array<{POLYGON}>"))
    rings = rows.select("f.properties.*", F.posexplode(parts).alias("part", "rings"))
    named = [c for c in rings.columns if c not in ("part", "rings")]
    found = rings.select(*named, "part", F.posexplode("rings").alias("ring", "points"))
    return found.select(*named, "part", "ring", F.transform("points", lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat"))).alias("vertices"))


def feature_lines(units: DataFrame, code: str = "code") -> DataFrame:
    """code, line: a compact GeoJSON feature per unit (..., part, ring, vertices of lon, lat); null properties are kept.

    A unit's parts and rings must fit one row; all other columns must be the same on its rows.
    """
    names = [c for c in units.columns if c not in ("part", "ring", "vertices")]
    point = F.transform("vertices", lambda v: F.array(v["lon"], v["lat"]))
    rings = units.groupBy(*names, "part").agg(F.array_sort(F.collect_list(F.struct("ring", point.alias("p")))).alias("r"))
    parts = rings.groupBy(*names).agg(F.array_sort(F.collect_list(F.struct("part", F.col("r.p").alias("p")))).alias("parts"))
    geometry = F.struct(F.lit("MultiPolygon").alias("type"), F.col("parts.p").alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(*names).alias("properties"), geometry.alias("geometry"))
    return parts.select(F.col(code), F.to_json(feature, {"ignoreNullFields": "false"}).alias("line"))


def write_geojson(units: DataFrame, path: str, code: str = "code") -> None:
    """Features in the order of their codes, one per line, in as many files as Spark deals them out to."""
    feature_lines(units, code).orderBy(F.length(code), code).select("line").write.mode("overwrite").text(path)


def write_collections(units: DataFrame, path: str, sheet: Column, code: str = "code") -> None:
    """A collection for each value of sheet, told by the code: a folder with one file on a single line, features in the order of their codes.

    A collection's first and last features have no geometry.  One task writes a collection, so sheet must bound its size.
    """
    none = '{"type":"Feature","properties":null,"geometry":null}'
    ends = F.array(*[F.struct(F.lit(k).alias("at"), F.lit(x).alias("line")) for k, x in ((0, '{"type":"FeatureCollection","features":[' + none), (2, none + "]}"))])
    lines = feature_lines(units, code).select(sheet.alias("sheet"), F.lit(1).alias("at"), F.col(code).alias("key"), "line")
    framed = units.select(sheet.alias("sheet")).distinct().withColumn("e", F.explode(ends)).select("sheet", "e.at", F.lit(None).cast("string").alias("key"), "e.line")
    # sorted in the task that writes them: partitions that are merely put together come in any order
    whole = lines.unionByName(framed).repartition("sheet").sortWithinPartitions("sheet", "at", F.length("key"), "key")
    whole.select("sheet", "line").write.mode("overwrite").partitionBy("sheet").option("lineSep", ",").text(path)


def report_lines(rows: DataFrame, key: str) -> DataFrame:
    """key, line: a row as JSON with its fields in order; nulls are kept."""
    fields = F.struct(*[F.col(f"`{c}`") for c in sorted(rows.columns)])
    return rows.select(F.col(key), F.to_json(fields, {"ignoreNullFields": "false"}).alias("line"))


def write_report(rows: DataFrame, path: str, key: str) -> None:
    report_lines(rows, key).orderBy(key).select("line").write.mode("overwrite").text(path)


@F.pandas_udf(StringType())
def strip_hidden_blocks(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Pages without their hidden blocks, whatever is nested in them; a block that isn't closed takes the rest with it."""
    import re

    tag = re.compile(r"<(/?)div\b([^>]*)>", re.IGNORECASE)
    hidden = re.compile(r"display\s*:\s*none", re.IGNORECASE)

    def visible(html: str | None) -> str | None:
        if html is None:
            return None
        kept, start, depth = [], 0, 0
        for m in tag.finditer(html):
            if depth:
                depth += -1 if m[1] else 1
                if not depth:
                    start = m.end()
            elif not m[1] and hidden.search(m[2]):
                kept.append(html[start : m.start()])
                depth = 1
        return "".join(kept) + ("" if depth else html[start:])

    for batch in pages:
        yield batch.map(visible, na_action="ignore")


def extract_registry_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """nivel, ubigeo, nombre of the deepest unit in each table row (number, department, province, district); cells hold code and name."""
    body = F.regexp_extract(strip_hidden_blocks(F.col(html)), r"(?is)<tbody[^>]*>(.*?)</tbody>", 1)
    rows = pages.select(F.explode(F.regexp_extract_all(body, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1)).alias("row"))
    cells = rows.select(F.regexp_extract_all("row", F.lit(r"(?is)<td[^>]*>(.*?)</td>"), 1).alias("cells")).filter(F.size("cells") >= 4)

    def unit(level: str, cell: Column) -> Column:
        text = C.cell_text(cell)
        code = F.regexp_extract(text, r"^([0-9]+)", 1)
        return F.when(F.length(code) == DIGITS[level], F.struct(F.lit(level).alias("nivel"), code.alias("ubigeo"), F.trim(F.regexp_replace(text, r"^[0-9]+", "")).alias("nombre")))

    deepest = F.coalesce(*[unit(level, F.get("cells", F.lit(k))) for level, k in zip(DIGITS, (3, 2, 1))])
    return cells.select(deepest.alias("u")).filter("u IS NOT NULL").select("u.*")
