"""Census sheets: ordered rows without codes, matched to the catalogue and rolled up."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from limes.functions import columns as C


#: Rows of a source that one task reads in order.
STRETCH = 1 << 20
#: The country's own row, which heads nothing. Fixed value.
COUNTRY = "PERU"


def classified_rows(rows: DataFrame) -> DataFrame:
    """source, row_idx, nivel, bare, value of the rows (source, row_idx, name, total) that stand for a unit or head a block.

    Provinces and districts have a head word; any other row with a figure is a department or a block.  Blank rows, notes, titles
    without a figure and the country's row are passed over.
    """
    unit = C.classify_unit(F.col("name"))
    named = rows.filter((F.trim("name") != "") & ~F.upper(F.trim("name")).startswith("NOTA"))
    found = named.select("source", "row_idx", unit.alias("u"), C.parse_number(F.col("total")).alias("value"))
    found = found.select("source", "row_idx", F.coalesce("u.level", F.lit("departamento")).alias("nivel"), "u.bare", "value")
    return found.filter((F.col("nivel") != "departamento") | (F.col("value").isNotNull() & (F.col("bare") != COUNTRY)))


def apply_aliases(rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """rows with the catalogue's names where aliases (nivel, bare, alias) has them; provinces' names are carried to what is below."""
    return rows.join(aliases, ["nivel", "bare"], "left").withColumn("bare", F.coalesce("alias", "bare")).drop("alias")


def apply_blocks(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """rows with block, a struct(dep, prov), where a row at the top is no department but one of blocks (bare, dep, prov)."""
    known = blocks.select(F.lit("departamento").alias("nivel"), "bare", F.struct("dep", "prov").alias("block"))
    return rows.join(known, ["nivel", "bare"], "left")


def carried(rows: DataFrame, *states: str) -> DataFrame:
    """Each state (a column that is null where it doesn't change) carried down the rows of its source.

    Rows are filled in stretches of STRETCH places, so a source of any length has many tasks; only the last states of
    the stretches are carried from one to the next.
    """
    rows = rows.withColumn("stretch", F.floor(F.col("row_idx") / STRETCH))
    order = Window.partitionBy("source", "stretch").orderBy("row_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("source").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    ends = rows.groupBy("source", "stretch").agg(*[F.max(F.when(F.col(c).isNotNull(), F.struct("row_idx", c))).alias(c) for c in states])
    ends = ends.select("source", "stretch", *[F.last(f"{c}.{c}", ignorenulls=True).over(before).alias(f"{c}_before") for c in states])
    filled = rows.withColumns({c: F.last(c, ignorenulls=True).over(order) for c in states}).join(ends, ["source", "stretch"])
    return filled.withColumns({c: F.coalesce(c, f"{c}_before") for c in states}).drop("stretch", *[f"{c}_before" for c in states])


def census_hierarchy(rows: DataFrame) -> DataFrame:
    """source, row_idx, nivel, bare, clave_censo, value: keys of classified rows, whose order tells what they belong to.

    A row at the top resets the province, or sets it if it is a block with one; blocks have no row of their own, for their figures are parts.
    A key is null where the department or province above is missing.
    """
    if "block" not in rows.columns:
        rows = rows.withColumn("block", F.lit(None).cast("struct<dep: string, prov: string>"))
    top = F.col("nivel") == "departamento"
    dep = F.when(top, F.coalesce("block.dep", "bare"))
    prov = F.when(top, F.struct(F.col("block.prov").alias("p"))).when(F.col("nivel") == "provincia", F.struct(F.col("bare").alias("p")))
    out = carried(rows.withColumns({"dep": dep, "prov": prov}), "dep", "prov").filter("block IS NULL")
    key = F.when(top, F.col("dep")).when(F.col("dep").isNull(), None).when(F.col("nivel") == "provincia", F.concat_ws("|", "dep", "bare")).when(F.col("prov.p").isNotNull(), F.concat_ws("|", "dep", "prov.p", "bare"))
    return out.select("source", "row_idx", "nivel", "bare", key.alias("clave_censo"), "value")


def census_match(rows: DataFrame, catalogue: DataFrame) -> DataFrame:
    """rows with ubigeo, null where the catalogue has no such key."""
    return rows.join(catalogue.select("nivel", "clave_censo", "ubigeo"), ["nivel", "clave_censo"], "left")


def census_unmatched(rows: DataFrame, catalogue: DataFrame) -> DataFrame:
    lost = rows.filter("clave_censo IS NOT NULL").join(catalogue.select("nivel", "clave_censo"), ["nivel", "clave_censo"], "left_anti").withColumn("reason", F.lit("not in the catalogue"))
    return lost.unionByName(rows.filter("clave_censo IS NULL").withColumn("reason", F.lit("no hierarchy"))).select("row_idx", "nivel", "bare", "reason")


def roll_up(values: DataFrame) -> DataFrame:
    """ubigeo, value of districts and, as sums, of provinces and departments; nulls are ignored, units without any value are absent.

    One pass: each value is added under its three prefixes in the map tasks.
    """
    each = values.filter("ubigeo IS NOT NULL AND value IS NOT NULL").select(F.explode(F.array(F.substring("ubigeo", 1, 2), F.substring("ubigeo", 1, 4), "ubigeo")).alias("ubigeo"), "value")
    return each.groupBy("ubigeo").agg(F.sum("value").alias("value"))


def coverage(values: DataFrame, expected: DataFrame) -> DataFrame:
    found = values.groupBy("nivel").agg(F.count("*").alias("present"), F.count("value").alias("with_value"), F.sum("value").alias("total"))
    return expected.join(found, "nivel", "left").select("nivel", F.coalesce("present", F.lit(0).cast("long")).alias("present"), F.coalesce("with_value", F.lit(0).cast("long")).alias("with_value"), "total", (F.coalesce("present", F.lit(0).cast("long")) == F.col("expected")).alias("ok"))


def naive_name_fanout(rows: DataFrame, catalogue: DataFrame) -> DataFrame:
    """How many rows a join on the bare name makes of each name, against one by key."""
    names = catalogue.filter("nivel = 'distrito'").groupBy(F.col("nombre_normalizado").alias("bare")).agg(F.count("*").alias("codes"))
    return rows.filter("nivel = 'distrito'").groupBy("bare").agg(F.count("*").alias("n")).join(names, "bare").select("bare", "n", (F.col("n") * F.col("codes")).alias("joined"))
