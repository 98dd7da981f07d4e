"""Units, names, figures and polygons derived from the given tables by integer and text formulas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST = ("San José", "Santa Rosa", "Ñaña", "Yurúa", "Sangani", "Río Ene", "Pachía")
SECOND = ("Alto", "Bajo", "Nuevo", "Viejo", "del Sur", "del Norte")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer with the codes of their district, province and department; a sixth of the positions of a province stays free.

    Each thousand customers have departments of their own, so units grow with the table, up to the 95 that two digits hold.
    """
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    rows = c.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = rows.withColumns({"block": (F.floor(F.col("c_custkey") / 1000) % 19).cast("int"), "k": (F.col("c_custkey") % 37 + 1).cast("int")})
    rows = rows.withColumn("seq", (F.col("k") + F.floor((F.col("k") - 1) / 5)).cast("int"))  # 6, 12, ... are free
    dep = F.lpad((F.col("n_regionkey") + 1 + 5 * F.col("block")).cast("string"), 2, "0")
    prov = F.concat(dep, F.lpad((F.floor(F.col("n_nationkey") / 5) + 1).cast("string"), 2, "0"))
    rows = rows.withColumns({"dep": dep, "prov": prov, "r_name": F.concat("r_name", F.lit(" "), F.col("block").cast("string"))}).withColumn("ubigeo", F.concat("prov", F.lpad(F.col("seq").cast("string"), 2, "0")))
    name = F.concat(F.array(*map(F.lit, FIRST))[(F.col("k") - 1) % 7], F.lit(" "), F.array(*map(F.lit, SECOND))[F.floor((F.col("k") - 1) / 7).cast("int")])
    return rows.withColumns({"nombre": name, "cents": F.round(F.col("c_acctbal") * 100).cast("long")})


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nivel, ubigeo, nombre on three levels."""
    c = customers(spark, sf_dir)
    dep = c.select(F.lit("departamento").alias("nivel"), F.col("dep").alias("ubigeo"), F.col("r_name").alias("nombre")).distinct()
    prov = c.select(F.lit("provincia").alias("nivel"), F.col("prov").alias("ubigeo"), F.col("n_name").alias("nombre")).distinct()
    dist = c.select(F.lit("distrito").alias("nivel"), "ubigeo", "nombre").distinct()
    return dep.unionByName(prov).unionByName(dist)


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ubigeo, value: cents of balance per district."""
    return customers(spark, sf_dir).groupBy("ubigeo").agg(F.sum("cents").alias("value"))


#: What the sheet calls otherwise: a block that is no department, names that differ, as (nivel, bare, alias).
BLOCK_OF = ("PROV. CONSTITUCIONAL", "ASIA 0")
ALIASES = (("distrito", "SAN JOSE DE ALTO", "SAN JOSE ALTO"), ("provincia", "LA CHINA", "CHINA"))


def sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source, row_idx, name, total: ordered rows as published, a source for each department.

    Departments have no head word; titles, a note with a figure, the country's total, a block in the place of one department's head,
    two names that the catalogue spells otherwise and one that it lacks stand in between.
    """
    c = customers(spark, sf_dir)
    idx = lambda code, width: F.rpad(code, width, "0").cast("long") * 10
    sums = lambda *by: c.groupBy("dep", *by).agg(F.sum("cents").cast("string").alias("total"))
    row = lambda rows, at, name, total: rows.select(F.col("dep").alias("source"), at.alias("row_idx"), name.alias("name"), total.alias("total"))
    none = F.lit(None).cast("string")
    only = c.select("dep").distinct()
    head = F.when(F.col("r_name") == BLOCK_OF[1], BLOCK_OF[0]).otherwise(F.upper("r_name"))
    prov_name = F.when(F.upper("n_name") == "CHINA", "LA CHINA").otherwise(F.upper("n_name"))
    dist_name = F.when(F.col("nombre") == "San José Alto", "SAN JOSÉ DE ALTO").otherwise(F.upper("nombre"))
    parts = [
        row(only, idx(F.col("dep"), 6) - 3, F.lit("Cuadro 6. Población"), none),
        row(sums(), idx(F.col("dep"), 6) - 2, F.lit("PERÚ"), F.col("total")),
        row(only, idx(F.col("dep"), 6) - 1, F.lit("Nota: cifras de prueba"), F.lit("7")),
        row(sums("r_name"), idx(F.col("dep"), 6), head, F.col("total")),
        row(sums("prov", "n_name"), idx(F.col("prov"), 6), F.concat(F.lit("PROVINCIA "), prov_name), F.col("total")),
        row(sums("ubigeo", "nombre", "seq"), idx(F.col("ubigeo"), 6), F.concat(F.lit("DISTRITO "), dist_name), F.when(F.col("seq") == 9, "-").otherwise(F.col("total"))),
        row(c.select("dep", "prov").distinct(), idx(F.col("prov"), 6) + 7, F.lit("DISTRITO SIN NOMBRE"), F.lit("1")),
        row(only, idx(F.col("dep"), 6) + 99_999, F.lit("  "), none),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


WIDTH = 100


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """code, ring, vertices: a displaced lattice cell for each order, WIDTH cells in a row.

    Of a code's 12 digits, the first 8 tell the strip of ten rows, the first 10 the block of ten by ten cells.
    """
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select((F.col("o_orderkey") % WIDTH).alias("gx"), F.floor(F.col("o_orderkey") / WIDTH).alias("gy"))
    digits = lambda v, n: F.lpad(v.cast("long").cast("string"), n, "0")
    code = F.concat(digits(F.floor(F.col("gy") / 10), 8), digits(F.floor(F.col("gx") / 10), 2), digits(F.col("gy") % 10 * 10 + F.col("gx") % 10, 2))
    return o.select(code.alias("code"), F.lit(0).alias("ring"), lattice(F.col("gx"), F.col("gy")).alias("vertices"))


def lattice(gx, gy):
    """Closed ring of 16 vertices around the cell; the displacement depends on the vertex alone, so neighbours agree.

    The vertices are told one by one: Spark compiles that, and runs a function over an array row by row without, 20 times slower.
    """

    def vertex(k: int):
        side, t = k // 4 % 4, k % 4
        i, j = gx * 4 + (t, 4, 4 - t, 0)[side], gy * 4 + (0, t, 4, 4 - t)[side]
        return F.struct((i * 1000 + (i * 7919 + j * 104729) % 201 - 100).cast("long").alias("x"), (j * 1000 + (i * 104729 + j * 7919) % 201 - 100).cast("long").alias("y"))

    return F.array(*[vertex(k) for k in range(17)])
