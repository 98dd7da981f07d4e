"""Tables of codes and ordered sheets from CSV, and sorted CSV output."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from limes.functions.columns import pad_code

CATALOGUE = "ubigeo string, nivel string, nombre string, nombre_normalizado string, nombre_censo string, nombre_censo_normalizado string, clave_censo string, ubigeo_departamento string, nombre_departamento string, ubigeo_provincia string, nombre_provincia string"
RETIRED = "ubigeo string, anio_retiro string, motivo string, fuente string"


def _csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All columns as text; a missing file is an empty table."""
    try:
        return spark.read.csv(path, schema=schema, header=True, encoding="UTF-8")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def read_catalogue(spark: SparkSession, path: str, level: str | None = None) -> DataFrame:
    rows = _csv(spark, path, CATALOGUE).filter(F.col("ubigeo").rlike("^([0-9]{2}){1,3}$"))
    return rows.filter(F.col("nivel") == level) if level else rows


def read_retired(spark: SparkSession, path: str) -> DataFrame:
    rows = _csv(spark, path, RETIRED).filter("trim(coalesce(ubigeo, '')) <> ''")
    return rows.withColumn("ubigeo", pad_code(F.trim("ubigeo"), 6))


#: A law entry: who it is, what is known of its code, and the line that cuts it from its parent.
LAW = (
    "nombre string, ley string, fecha_creacion string, fecha_promulgacion string, pdf string, capital string, departamento string, provincia string, ubigeo string, ubigeo_oficial_confirmado string, padre string, "
    "confianza string, metodo string, advertencia string, corte struct<crs: string, puntos: array<array<double>>, prolongar_inicio: struct<rumbo: string, max_m: double>, prolongar_final: struct<rumbo: string, max_m: double>, "
    "punto_interior: array<double>, verificacion_tramos_reusados: array<struct<nombre: string, contra: string, tipo: string, decision: string, puntos: array<array<double>>>>>"
)


def read_law_registry(spark: SparkSession, path: str) -> DataFrame:
    """Law entries from JSON files, an entry per line or an array of them; what an entry lacks is null."""
    return spark.read.json(path, schema=LAW, multiLine=False, mode="FAILFAST")


def law_lines(entries: DataFrame) -> DataFrame:
    """entry, code, points, bearings and reaches of law entries' lines, as build_cut_lines takes them, and px, py."""
    cut = lambda c: F.col(f"corte.{c}")
    points = F.transform(cut("puntos"), lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    ends = [cut(f"{a}.{b}").alias(c) for a, b, c in (("prolongar_inicio", "rumbo", "start_bearing"), ("prolongar_inicio", "max_m", "start_max"), ("prolongar_final", "rumbo", "end_bearing"), ("prolongar_final", "max_m", "end_max"))]
    return entries.select(F.col("ley").alias("entry"), F.col("padre").alias("code"), points.alias("points"), *ends, F.get(cut("punto_interior"), F.lit(0)).alias("px"), F.get(cut("punto_interior"), F.lit(1)).alias("py"))


def read_census_rows(spark: SparkSession, path: str, columns: int = 10) -> DataFrame:
    """source, row_idx, cells: rows in file order, numbered within each file.

    Large files are read in splits: a split's rows are counted, the counts of the splits before it are added up, and each row
    adds its place in its own split.  The table of splits has a row for each split and is broadcast.
    """
    schema = ", ".join(f"c{k} string" for k in range(columns))
    rows = spark.read.csv(path, schema=schema, header=False)
    rows = rows.select(F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("k"), F.array(*[f"c{k}" for k in range(columns)]).alias("cells"))
    # a split's rows stand together in one task, so their ids follow each other
    splits = rows.groupBy("source", "block").agg(F.min("k").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("source", "block", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("less"))
    return rows.join(F.broadcast(splits), ["source", "block"]).select("source", (F.col("k") + F.col("less")).cast("long").alias("row_idx"), "cells")


def write_table_csv(df: DataFrame, path: str, code: str = "ubigeo") -> None:
    """Sorted by length of the code, then code; files are in that order."""
    df.orderBy(F.length(code), code).write.mode("overwrite").csv(path, header=True)


def write_layers(df: DataFrame, path: str) -> None:
    """A folder per level."""
    df.write.mode("overwrite").partitionBy("nivel").parquet(path)


def shipped(spark: SparkSession) -> SparkSession:
    """Let Python workers on this machine find the package from any working folder; elsewhere it is installed."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder in spark.checkpoint.dir; only a session on this machine alone may use a temporary one."""
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors see")
        base = tempfile.mkdtemp(prefix="limes-")
    return f"{base}/{name}-{uuid.uuid4().hex}"


#: Rows of a narrow table that are broadcast at most, some 16 MB.
SMALL_ROWS = 500_000


def shuffled(df: DataFrame) -> DataFrame:
    """df, marked to be joined by a shuffle.

    Spark takes an exploded table for as large as the table it was made of, and would broadcast one that fills the driver's memory.
    """
    return df.hint("merge")


def few(df: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """A stored table, marked for broadcast if it was counted and is small, else to be joined by a shuffle."""
    return F.broadcast(df) if df.count() <= most else shuffled(df)


def stored(df: DataFrame) -> DataFrame:
    """df as a Parquet table in a scratch folder; what is built on it starts from there, and the shuffles that made it are dropped."""
    spark, path, key = df.sparkSession, scratch_folder(df.sparkSession, "table"), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(key, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)
