"""Operators on hierarchical codes and the catalogue of names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limes.functions import columns as C


def catalogue_rows(units: DataFrame) -> DataFrame:
    """(nivel, ubigeo, nombre) to the catalogue's 11 columns; parents' names by prefix, '' where there is none."""
    names = units.select(F.col("ubigeo").alias("code"), F.col("nombre").alias("parent"))
    dep, prov = names.withColumnsRenamed({"code": "d", "parent": "dn"}).filter("length(d) = 2"), names.withColumnsRenamed({"code": "p", "parent": "pn"}).filter("length(p) = 4")
    rows = units.join(dep, F.substring("ubigeo", 1, 2) == F.col("d"), "left").join(prov, F.substring("ubigeo", 1, 4) == F.col("p"), "left")
    level, name, dn, pn = F.col("nivel"), F.col("nombre"), F.coalesce("dn", F.lit("")), F.coalesce("pn", F.lit(""))
    district = level == "distrito"
    return rows.select(
        "ubigeo", "nivel", "nombre", C.normalize_name(name).alias("nombre_normalizado"), C.census_name(level, name).alias("nombre_censo"),
        C.normalize_name(C.census_name(level, name)).alias("nombre_censo_normalizado"), C.hierarchy_key(level, dn, pn, name).alias("clave_censo"),
        F.substring("ubigeo", 1, 2).alias("ubigeo_departamento"), dn.alias("nombre_departamento"),
        F.when(level == "departamento", "").otherwise(F.substring("ubigeo", 1, 4)).alias("ubigeo_provincia"), F.when(district | (level == "provincia"), pn).otherwise("").alias("nombre_provincia"),
    )


def level_counts(units: DataFrame, expected: DataFrame) -> DataFrame:
    counts = units.groupBy("nivel").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0).cast("long"))
    return expected.join(counts, "nivel", "left").select("nivel", n.alias("n"), "expected", F.signum((n - F.col("expected")).cast("double")).cast("int").alias("sign"))


def duplicate_codes(units: DataFrame) -> DataFrame:
    return units.groupBy("ubigeo").agg(F.count("*").alias("n")).filter("n > 1")


def ambiguous_names(catalogue: DataFrame) -> DataFrame:
    """District names that stand for several districts."""
    found = catalogue.filter("nivel = 'distrito'").groupBy("nombre_normalizado").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("ubigeo")), ",").alias("codes"))
    return found.filter("n > 1")


def key_uniqueness(catalogue: DataFrame, *key: str) -> DataFrame:
    return catalogue.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def conflicting_codes(catalogue: DataFrame) -> DataFrame:
    """Names that one province gives to several codes."""
    found = catalogue.filter("nivel = 'distrito'").groupBy("ubigeo_provincia", "nombre_normalizado").agg(F.array_join(F.sort_array(F.collect_set("ubigeo")), ",").alias("codes"), F.count_distinct("ubigeo").alias("n"))
    return found.filter("n > 1")


def next_code(districts: DataFrame, retired: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """prov, code, status of each province asked for (prov; all that have districts by default): the code after its largest.

    status: ok, malformed province, empty province, exhausted (past 99), in use, retired; and a row with status malformed district,
    code and no province for each code that isn't six digits, for no sequence can be trusted beside them.
    """
    whole = districts.filter(C.valid_code(F.col("ubigeo"), 6))
    top = whole.groupBy(F.substring("ubigeo", 1, 4).alias("prov")).agg((F.max(F.substring("ubigeo", 5, 2).cast("int")) + 1).alias("seq"))
    rows = top if asked is None else asked.select("prov").distinct().join(top, "prov", "left")
    code = F.when(F.col("seq") <= 99, F.concat("prov", F.lpad(F.col("seq").cast("string"), 2, "0")))
    rows = flagged(rows.withColumn("code", code), whole, retired)
    status = F.when(~C.valid_code(F.col("prov"), 4), "malformed province").when(F.col("seq").isNull(), "empty province").when(F.col("code").isNull(), "exhausted").when(F.col("used"), "in use").when(F.col("gone"), "retired").otherwise("ok")
    broken = districts.filter(~C.valid_code(F.col("ubigeo"), 6)).select(F.lit(None).cast("string").alias("prov"), F.col("ubigeo").alias("code"), F.lit("malformed district").alias("status"))
    return rows.select("prov", "code", status.alias("status")).unionByName(broken)


def flagged(rows: DataFrame, districts: DataFrame, retired: DataFrame, code: str = "code") -> DataFrame:
    """rows with used and gone: whether a code is a district's, or a retired one."""
    used = districts.select(F.col("ubigeo").alias(code), F.lit(True).alias("used")).distinct()
    gone = retired.select(F.col("ubigeo").alias(code), F.lit(True).alias("gone")).distinct()
    return rows.join(used, code, "left").join(gone, code, "left").na.fill(False, ["used", "gone"])


def code_gaps(districts: DataFrame) -> DataFrame:
    """prov, gap: free positions below each province's largest."""
    used = districts.select(F.substring("ubigeo", 1, 4).alias("prov"), F.substring("ubigeo", 5, 2).cast("int").alias("seq")).groupBy("prov").agg(F.max("seq").alias("m"), F.collect_set("seq").alias("s"))
    return used.select("prov", F.explode(F.array_except(F.sequence(F.lit(1), "m"), "s")).alias("gap"))


def official_codes(catalogue: DataFrame) -> DataFrame:
    """prov, name, official, n_official of districts; official is null where a province gives one name to several codes."""
    found = catalogue.filter(F.col("nivel") == "distrito").filter(C.valid_code(F.col("ubigeo"), 6)).groupBy(F.col("ubigeo_provincia").alias("prov"), F.col("nombre_normalizado").alias("name"))
    low, high = F.min("ubigeo"), F.max("ubigeo")
    return found.agg(F.when(low == high, low).alias("official"), F.count_distinct("ubigeo").alias("n_official"))


def resolve_codes(entries: DataFrame, catalogue: DataFrame, districts: DataFrame, retired: DataFrame) -> DataFrame:
    """Codes of new districts: forced, else official by (province, name) or declared as such, else by rule; one entry follows another.

    entries: entry (order), prov, nombre, forced and, if there is one, declared.  Returns entry, prov, nombre, code, rule, origin, provisional and status.
    The rule is one past the largest code of the province and of the entries before.  With R the number of ruled entries so far and g the
    sequences given so far, the largest is R + max(top, g - R at each given entry), so two running windows replace the loop.
    """
    from pyspark.sql import Window

    if "declared" not in entries.columns:
        entries = entries.withColumn("declared", F.lit(None).cast("string"))
    top = districts.groupBy(F.substring("ubigeo", 1, 4).alias("prov")).agg(F.max(F.substring("ubigeo", 5, 2).cast("int")).alias("top"))
    rows = entries.withColumn("name", C.normalize_name(F.col("nombre"))).join(official_codes(catalogue), ["prov", "name"], "left").join(top, "prov", "left")
    rows = rows.withColumn("confirmed", F.coalesce("official", "declared")).withColumn("given", F.coalesce("forced", "confirmed"))
    upto = Window.partitionBy("prov").orderBy("entry").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("prov").orderBy("entry").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("ruled", F.sum(F.col("given").isNull().cast("int")).over(upto))
    own = F.when(F.substring("given", 1, 4) == F.col("prov"), F.substring("given", 5, 2).try_cast("int") - F.col("ruled"))
    rows = rows.withColumn("ahead", own).withColumn("seq", F.col("ruled") - F.col("given").isNull().cast("int") + F.greatest("top", F.max("ahead").over(before)) + 1)
    rows = rows.withColumn("rule", F.when(F.col("top").isNotNull() & (F.col("seq") <= 99), F.concat("prov", F.lpad(F.col("seq").cast("string"), 2, "0")))).withColumn("code", F.coalesce("given", "rule"))
    rows = flagged(rows.withColumn("turn", F.row_number().over(Window.partitionBy("code").orderBy("entry"))), districts, retired)
    status = (
        F.when(F.col("n_official") > 1, "ambiguous official code").when(F.col("top").isNull(), "empty province").when(F.col("rule").isNull(), "exhausted")
        .when(F.col("declared") != F.col("official"), "declared against official").when(F.col("used") | (F.col("turn") > 1), "in use").when(F.col("gone"), "retired")
        .when(F.col("confirmed") != F.col("rule"), "confirmed against rule").when(F.col("forced") != F.col("confirmed"), "forced against confirmed").otherwise("ok")
    )
    origin = F.when(F.col("forced").isNotNull(), "forced").when(F.col("official").isNotNull(), "official").when(F.col("declared").isNotNull(), "declared").otherwise("rule")
    return rows.select("entry", "prov", "nombre", "code", "rule", origin.alias("origin"), F.col("given").isNull().alias("provisional"), status.alias("status"))


def reconcile(a: DataFrame, b: DataFrame, declared: DataFrame) -> DataFrame:
    """code, kind: only_a or only_b if declared, else undeclared_a or undeclared_b; resolved for declared ones found in both or in neither."""
    x = a.select("code").distinct().withColumn("in_a", F.lit(True))
    y = b.select("code").distinct().withColumn("in_b", F.lit(True))
    z = declared.select("code").distinct().withColumn("known", F.lit(True))
    rows = x.join(y, "code", "full").join(z, "code", "full").na.fill(False, ["in_a", "in_b", "known"])
    kind = F.when(F.col("in_a") == F.col("in_b"), F.when(F.col("known"), "resolved")).otherwise(F.concat(F.when(F.col("known"), "only_").otherwise("undeclared_"), F.when(F.col("in_a"), "a").otherwise("b")))
    return rows.select("code", kind.alias("kind")).filter("kind IS NOT NULL")


def hierarchy_closure(children: DataFrame, parents: DataFrame, digits: int) -> DataFrame:
    """code, fault: parents without children and prefixes of children that are no parent."""
    below = children.select(F.substring("ubigeo", 1, digits).alias("code")).distinct().withColumn("c", F.lit(1))
    above = parents.select(F.col("ubigeo").alias("code")).distinct().withColumn("p", F.lit(1))
    return above.join(below, "code", "full").filter("c IS NULL OR p IS NULL").select("code", F.when(F.col("p").isNull(), "no parent").otherwise("no children").alias("fault"))


def set_equal(a: DataFrame, b: DataFrame) -> DataFrame:
    """code, change: lost from a or added in b."""
    return a.select("code").exceptAll(b.select("code")).distinct().withColumn("change", F.lit("lost")).unionByName(b.select("code").exceptAll(a.select("code")).distinct().withColumn("change", F.lit("added")))


def merge_layers(official: DataFrame, derived: DataFrame) -> DataFrame:
    """Derived units and those official ones that they don't replace."""
    return official.join(derived.select("ubigeo"), "ubigeo", "left_anti").unionByName(derived, allowMissingColumns=True)


def registry_lookup(entries: DataFrame, catalogue: DataFrame) -> DataFrame:
    """entry, prov, nombre, official, status: found, none, or ambiguous, which has no code for none can be chosen by name."""
    rows = entries.withColumn("name", C.normalize_name(F.col("nombre"))).join(official_codes(catalogue), ["prov", "name"], "left")
    status = F.when(F.col("n_official").isNull(), "none").when(F.col("n_official") > 1, "ambiguous").otherwise("found")
    return rows.select("entry", "prov", "nombre", "official", status.alias("status"))


def law_matches(entries: DataFrame, published: DataFrame) -> DataFrame:
    """entry, status: published (and whether as predicted), taken by another name, or pending."""
    by_name = published.select(F.substring("ubigeo", 1, 4).alias("prov"), C.normalize_name(F.col("nombre")).alias("name"), F.col("ubigeo").alias("found"))
    by_code = published.select(F.col("ubigeo").alias("predicted"), C.normalize_name(F.col("nombre")).alias("holder"))
    rows = entries.withColumn("name", C.normalize_name(F.col("nombre"))).join(by_name, ["prov", "name"], "left").join(by_code, "predicted", "left")
    status = F.when(F.col("found").isNotNull(), F.when(F.col("found") == F.col("predicted"), "published").otherwise("published under another code")).when(F.col("holder").isNotNull(), "code taken").otherwise("pending")
    return rows.select("entry", "prov", "nombre", "predicted", status.alias("status"))
