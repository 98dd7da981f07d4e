"""Lines against borders: distances of points to shared stretches, exits of rays, bearings, and rules on cuts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limes.sources.tables import shuffled

#: Bearings as steps east and north. Fixed values.
BEARINGS = {"norte": (0, 1), "noreste": (1, 1), "este": (1, 0), "sureste": (1, -1), "sur": (0, -1), "suroeste": (-1, -1), "oeste": (-1, 0), "noroeste": (-1, 1)}


def bearing_vector(bearing: Column, dx: Column, dy: Column) -> Column:
    """struct(x, y) of length 1 for one of eight bearings; a null bearing goes on in the direction dx, dy. Null if there is none."""
    unit = lambda x, y: F.struct(F.lit(x / math.hypot(x, y)).alias("x"), F.lit(y / math.hypot(x, y)).alias("y"))
    steps = F.create_map(*[v for name, (x, y) in BEARINGS.items() for v in (F.lit(name), unit(x, y))])
    length = F.hypot(dx, dy)
    straight = F.when(length > 0, F.struct((dx / length).alias("x"), (dy / length).alias("y")))
    return F.when(bearing.isNull(), straight).otherwise(F.try_element_at(steps, bearing))


def point_arc_distance(points: DataFrame, owners: DataFrame) -> DataFrame:
    """a, b, n, least, mean, most: distances of reference points (id, a, b, x, y) to the border that a and b share.

    A pair without a common border keeps its row, with nulls for the distances.
    """
    shared = owners.filter("n_owners = 2").select("a", "b", "x1", "y1", "x2", "y2")
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    along = F.try_divide((F.col("x") - F.col("x1")) * dx + (F.col("y") - F.col("y1")) * dy, dx * dx + dy * dy)
    t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(along, F.lit(0.0))))
    distance = F.hypot(F.col("x") - F.col("x1") - t * dx, F.col("y") - F.col("y1") - t * dy)
    pairs = points.withColumns({"a": F.least("a", "b"), "b": F.greatest("a", "b")})
    nearest = pairs.join(shuffled(shared), ["a", "b"], "left").groupBy("a", "b", "id").agg(F.min(distance).alias("d"))
    return nearest.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("d").alias("least"), F.avg("d").alias("mean"), F.max("d").alias("most"))


def ray_exits(rays: DataFrame, segments: DataFrame) -> DataFrame:
    """id, hits, distance, ray_x, ray_y: how often each ray (id, code, x, y, dx, dy) meets the border of its unit, and its farthest hit.

    Segments are half-open, so a vertex counts once.  A ray that meets nothing has 0 hits.  With a column `most`, only hits within
    that distance count.
    """
    ray, seg = rays.alias("r"), segments.alias("s")
    ex, ey = F.col("s.x2") - F.col("s.x1"), F.col("s.y2") - F.col("s.y1")
    wx, wy = F.col("s.x1") - F.col("r.x"), F.col("s.y1") - F.col("r.y")
    cross = F.col("r.dx") * ey - F.col("r.dy") * ex
    t = F.try_divide(wx * ey - wy * ex, cross)  # steps along the ray
    # sides of the ray's line on which the segment's ends lie, in the arithmetic of the input: exact on integers
    side1 = F.col("r.dx") * wy - F.col("r.dy") * wx >= 0
    side2 = F.col("r.dx") * (F.col("s.y2") - F.col("r.y")) - F.col("r.dy") * (F.col("s.x2") - F.col("r.x")) >= 0
    met = ray.join(shuffled(seg), F.col("r.code") == F.col("s.code")).filter((side1 != side2) & (t > 0) & ((t * F.hypot("r.dx", "r.dy") <= F.col("r.most")) if "most" in rays.columns else F.lit(True))).select(F.col("r.id").alias("id"), t.alias("t"))
    far = met.groupBy("id").agg(F.count("*").alias("hits"), F.max("t").alias("t"))
    out = rays.join(shuffled(far), "id", "left")
    return out.select("id", F.coalesce("hits", F.lit(0)).cast("long").alias("hits"), (F.col("t") * F.hypot("dx", "dy")).alias("distance"), (F.col("x") + F.col("t") * F.col("dx")).alias("ray_x"), (F.col("y") + F.col("t") * F.col("dy")).alias("ray_y"))


def area_conservation(before: DataFrame, after: DataFrame, tolerance: int = 0) -> DataFrame:
    """code, before2, after2, drift2, ok: twice the areas of each unit in two versions; a unit that one side lacks has area 0 there."""
    b, a = before.select("code", F.col("area2").alias("before2")), after.select("code", F.col("area2").alias("after2"))
    zero = F.lit(0).cast("long")
    rows = b.join(a, "code", "full").select("code", F.coalesce("before2", zero).alias("before2"), F.coalesce("after2", zero).alias("after2"))
    drift = F.col("after2") - F.col("before2")
    return rows.select("*", drift.alias("drift2"), (F.abs(drift) <= 2 * tolerance).alias("ok"))


def reused_stretch_rules(stretches: DataFrame, units: DataFrame) -> DataFrame:
    """ubigeo, name, rule of each reused stretch (ubigeo, name, kind, decision, most) that breaks a rule; units: ubigeo, confianza, advertencia."""
    rows = stretches.join(units.select("ubigeo", "confianza", "advertencia"), "ubigeo", "left")
    replaced = F.col("kind") == "sustituido"
    rules = F.array_compact(F.array(
        F.when(replaced & ~F.col("confianza").eqNullSafe(F.lit("aproximado")), "replaced stretch without approximate confidence"),
        F.when(replaced & (F.trim(F.coalesce("advertencia", F.lit(""))) == ""), "replaced stretch without warning"),
        F.when((F.col("kind") == "coincidente") & ~F.coalesce(F.col("most") < 200, F.lit(False)), "coincident stretch too far off"),
        F.when(F.trim(F.coalesce("decision", F.lit(""))) == "", "no decision"),
    ))
    return rows.select("ubigeo", "name", F.explode(rules).alias("rule"))
