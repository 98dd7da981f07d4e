"""Provenance rules, declared anomalies and alerts on drift between sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limes.operators import codes

CLASSES = ("oficial", "exacto", "aproximado", "reconstruido")


def official_only(units: DataFrame) -> DataFrame:
    return units.filter("fuente = 'INEI'")


def provenance_rules(units: DataFrame) -> DataFrame:
    """ubigeo, rule: each rule on fuente, confianza, ley_creacion, fecha_creacion, metodo and advertencia that a unit breaks."""
    official = F.coalesce(F.col("fuente") == "INEI", F.lit(False))
    rules = [F.when(~F.coalesce(F.col("confianza").isin(*CLASSES), F.lit(False)), "unknown confidence"), F.when(official != F.coalesce(F.col("confianza") == "oficial", F.lit(False)), "confidence against source"), F.when(official & F.col("ley_creacion").isNotNull(), "official unit with a law")]
    rules += [F.when(~official & F.col(c).isNull(), f"derived unit without {c}") for c in ("ley_creacion", "fecha_creacion", "metodo", "advertencia")]
    return units.select("ubigeo", F.explode(F.array_compact(F.array(*rules))).alias("rule"))


def known_anomalies(observed: DataFrame, known: DataFrame) -> DataFrame:
    """code, change: anomalies that are not declared, and declared ones that are gone."""
    a, b = observed.select("code").distinct(), known.select("code").distinct()
    return a.join(b, "code", "left_anti").withColumn("change", F.lit("new")).unionByName(b.join(a, "code", "left_anti").withColumn("change", F.lit("gone")))


def watch_alerts(snapshot: DataFrame, entries: DataFrame, catalogue: DataFrame, declared: DataFrame, expected: int, expected_official: int | None = None) -> DataFrame:
    """kind, code: what differs between a snapshot of published districts and the declared state.

    snapshot: ubigeo, nombre; entries as in law_matches, and confirmed, the code that the catalogue gave them; catalogue: official
    districts; declared: codes known to have no polygon.  Confirmed and predicted codes of entries need no polygon.
    """
    counted = lambda df, most, kind: df.agg(F.count("*").alias("n")).filter(F.col("n") != most).select(F.lit(kind).alias("kind"), F.col("n").cast("string").alias("code"))
    out = counted(snapshot, expected, "count changed")
    if expected_official is not None:
        out = out.unionByName(counted(catalogue, expected_official, "official count changed"))
    matched = codes.law_matches(entries, snapshot).filter("status <> 'pending'")
    official = catalogue.select(F.col("ubigeo").alias("code"))
    held = entries.select(F.col("confirmed" if "confirmed" in entries.columns else "predicted").alias("code")).filter("code IS NOT NULL")
    gaps = codes.reconcile(official.join(held, "code", "left_anti") if "confirmed" in entries.columns else official, snapshot.select(F.col("ubigeo").alias("code")), declared)
    if "confirmed" in entries.columns:  # a registered unit with a polygon of its own is told by its law
        gaps = gaps.join(held.join(official, "code", "left_semi"), "code", "left_anti")
        out = out.unionByName(held.join(official, "code", "left_anti").distinct().select(F.lit("confirmed code vanished").alias("kind"), "code"))
    kinds = F.when(F.col("kind") == "undeclared_a", "official without polygon").when(F.col("kind") == "undeclared_b", "polygon without official code").when(F.col("kind") == "resolved", "declared gap closed")
    return out.unionByName(matched.select(F.concat(F.lit("law: "), "status").alias("kind"), F.col("predicted").alias("code"))).unionByName(gaps.select(kinds.alias("kind"), "code").filter("kind IS NOT NULL"))
