"""Layers of units: parents' names, composed codes, counts, and where shared borders come from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limes.functions import columns as C
from limes.operators.geometry import seg_length


def attach_parent_names(units: DataFrame, parents: DataFrame) -> DataFrame:
    """units with nombre_departamento and nombre_provincia by prefix; null where there is no such parent."""
    dep = parents.filter("nivel = 'departamento'").select(F.col("ubigeo").alias("d"), F.col("nombre").alias("nombre_departamento"))
    prov = parents.filter("nivel = 'provincia'").select(F.col("ubigeo").alias("p"), F.col("nombre").alias("nombre_provincia"))
    rows = units.join(dep, F.substring("ubigeo", 1, 2) == F.col("d"), "left").join(prov, F.substring("ubigeo", 1, 4) == F.col("p"), "left")
    return rows.drop("d", "p")


def compose_code(units: DataFrame, *parts: str) -> DataFrame:
    """units with ubigeo put together from its two-digit parts; null if any of them is malformed."""
    whole = F.concat(*[F.trim(p) for p in parts])
    return units.withColumn("ubigeo", F.when(C.valid_code(whole, 2 * len(parts)), whole))


def code_columns(rows: DataFrame, digits: int, share: float = 0.95) -> DataFrame:
    """place, name, codes: the text columns of which `share` at least are valid codes, with their distinct values; one pass over rows."""
    names = [f.name for f in rows.schema.fields if f.dataType.simpleString() == "string"]
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("place"), F.lit(n).alias("name"), F.col(f"`{n}`").alias("v")) for k, n in enumerate(names)])).alias("c")
    found = rows.select(each).groupBy("c.place", "c.name").agg(F.count("*").alias("n"), F.count_if(C.valid_code(F.col("c.v"), digits)).alias("ok"), F.count_distinct("c.v").alias("codes"))
    return found.filter(F.col("ok") >= share * F.col("n")).select("place", "name", "codes")


def detect_code_column(rows: DataFrame, digits: int) -> DataFrame:
    """The code column: most distinct values, the first of equals; no row if there is none."""
    return code_columns(rows, digits).orderBy(F.desc("codes"), "place").limit(1).select("name", "codes")


def count_reconcile(announced: DataFrame, delivered: DataFrame) -> DataFrame:
    """nivel, announced, delivered, ok; a level that one side lacks counts 0 there."""
    found = delivered.groupBy("nivel").agg(F.count("*").alias("delivered"))
    zero = F.lit(0).cast("long")
    return announced.join(found, "nivel", "full").select("nivel", F.coalesce("announced", zero).alias("announced"), F.coalesce("delivered", zero).alias("delivered"), F.coalesce(F.col("announced") == F.col("delivered"), F.lit(False)).alias("ok"))


def arc_provenance(pairs: DataFrame, entries: DataFrame) -> DataFrame:
    """pairs (a, b, ...) with fuente and ley: derived only between a parent and the unit cut from it (parent, child, ley)."""
    known = entries.select(F.least("parent", "child").alias("a"), F.greatest("parent", "child").alias("b"), "ley").distinct()
    return pairs.join(known, ["a", "b"], "left").withColumn("fuente", F.when(F.col("ley").isNotNull(), "derivado").otherwise("oficial"))


def arc_integrity(owners: DataFrame, segments: DataFrame) -> DataFrame:
    """code, own, stored, left, right, faults: each unit's perimeter, the stored borders that name it, those that have it on either side, and faults.

    Perimeter, stored length and the sum of the sides agree if no border is lost, doubled or without its sides.
    """
    length = seg_length()
    named = owners.select(F.explode(F.array_compact(F.array("a", "b"))).alias("code"), length.alias("len"), "left_code", "right_code", "fault")
    side = lambda c: F.round(F.sum(F.when(F.col(c) == F.col("code"), F.col("len")).otherwise(0.0)), 3)
    stored = named.groupBy("code").agg(F.round(F.sum("len"), 3).alias("stored"), side("left_code").alias("left"), side("right_code").alias("right"), F.count_if("fault").alias("faults"))
    own = segments.groupBy("code").agg(F.round(F.sum(length), 3).alias("own"))
    return own.join(stored, "code", "full").select("code", "own", "stored", "left", "right", "faults")


#: How the source published a unit. Fixed value.
PUBLISHED = "publicado por el INEI (WFS Interoperabilidad)"


def _given(name: str, default=None):
    """A raw attribute; blank counts as missing."""
    value = F.nullif(F.col(name), F.lit(""))
    return value if default is None else F.coalesce(value, default)


def district_props(districts: DataFrame, parents: DataFrame) -> DataFrame:
    """The published columns of districts, in order.

    districts: ubigeo, nombre, the raw attributes, and derivado (null for official ones; else a struct of ley, fecha_creacion, metodo,
    confianza, advertencia, ubigeo, ubigeo_oficial_confirmado, fuente_del_ubigeo).  parents: nivel, ubigeo, nombre.
    """
    rows = attach_parent_names(districts, parents)
    law = lambda c: F.col(f"derivado.{c}")
    derived = F.col("derivado").isNotNull()
    text = lambda c: F.nullif(C.squash_text(law(c)), F.lit(""))
    code = lambda a, n: F.substring("ubigeo", a, n)
    confirmed = law("ubigeo_oficial_confirmado").isNotNull()
    return rows.select(
        "ubigeo", "nombre", code(1, 4).alias("ubigeo_provincia"), "nombre_provincia", code(1, 2).alias("ubigeo_departamento"), "nombre_departamento",
        F.when(derived, "derivado").otherwise("INEI").alias("fuente"), law("ley").alias("ley_creacion"), law("fecha_creacion").alias("fecha_creacion"),
        F.when(derived, C.squash_text(law("metodo"))).otherwise(PUBLISHED).alias("metodo"),
        F.when(derived, F.coalesce(F.nullif(law("confianza"), F.lit("")), F.lit("reconstruido"))).otherwise("oficial").alias("confianza"),
        (derived & F.coalesce(law("ubigeo"), law("ubigeo_oficial_confirmado")).isNull()).alias("ubigeo_provisional"),
        F.when(confirmed, F.nullif(F.trim(law("fuente_del_ubigeo")), F.lit(""))).alias("ubigeo_fuente"), text("advertencia").alias("advertencia"),
        _given("ccdd", code(1, 2)).alias("ccdd"), _given("ccpp", code(3, 2)).alias("ccpp"), _given("ccdi", code(5, 2)).alias("ccdi"),
        _given("nombdist", F.col("nombre")).alias("nombdist"), _given("fuente").alias("fuente_inei"), *[_given(c).alias(c) for c in ("periodo", "ccdd_c", "ccpp_c", "ccdi_c", "fec_reg")],
    )


def _official(level_name: str) -> list:
    return [F.lit("INEI").alias("fuente"), F.lit("oficial").alias("confianza"), F.lit(PUBLISHED).alias("metodo"), "ccdd", *(["ccpp"] if level_name == "nombprov" else []), level_name, F.col("fuente").alias("fuente_inei"), "periodo", "fec_reg"]


def province_props(provinces: DataFrame, departments: DataFrame) -> DataFrame:
    """The published columns of provinces (ubigeo and raw attributes), in order; departments: nivel, ubigeo, nombre."""
    names = departments.filter("nivel = 'departamento'").select(F.col("ubigeo").alias("d"), F.col("nombre").alias("nombre_departamento"))
    rows = provinces.join(names, F.substring("ubigeo", 1, 2) == F.col("d"), "left")
    return rows.select("ubigeo", F.col("nombprov").alias("nombre"), F.substring("ubigeo", 1, 2).alias("ubigeo_departamento"), "nombre_departamento", *_official("nombprov"))


def department_props(departments: DataFrame) -> DataFrame:
    """The published columns of departments (ubigeo and raw attributes), in order."""
    return departments.select("ubigeo", F.col("nombdep").alias("nombre"), *_official("nombdep"))


def before_after(before: DataFrame, after: DataFrame, provinces: DataFrame, digits: int = 4) -> DataFrame:
    """Units (code, ...) of the touched provinces (prov) as they were and as they are, told apart by capa, for review."""
    touched = provinces.select(F.col("prov").alias("p")).distinct()
    of = lambda units, name: units.join(touched, F.substring("code", 1, digits) == F.col("p"), "left_semi").withColumn("capa", F.lit(name))
    return of(before, "antes").unionByName(of(after, "despues"), allowMissingColumns=True)
