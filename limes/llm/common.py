"""What the operators of this package share: reading, cutting lineage, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in a batch sent to Python; texts can be long, so fewer than Spark's own default.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> SparkSession:
    """Give the session its checkpoint folder, and small Arrow batches.

    The folder is the one named in spark.checkpoint.dir; only a session on this machine alone gets one of its own if that is unset.
    """
    # Python workers on this machine find the package from any working folder; elsewhere it is installed
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    if spark.sparkContext.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not folder and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors see")
        spark.sparkContext.setCheckpointDir(folder or tempfile.mkdtemp(prefix="limes-checkpoint-"))
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see."""
    return prepare(spark).sparkContext.getCheckpointDir()


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Spark drops the shuffles of what runs in here when it ends: its result is on disk, so nothing reads them again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from there."""
    with tidy(prepare(df.sparkSession)):
        return df.checkpoint(eager=True)


#: Documents for each task that writes a step's table about them, at least.
TASK_ROWS = 4096


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks that write a step's table about so many documents: enough for all cores, and no task for less than TASK_ROWS beyond that."""
    return max(2 * spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def stored(df: DataFrame, path: str | None = None, tasks: int | None = None) -> DataFrame:
    """Like cut, as a Parquet table in the shared folder, read back in as many tasks as its bytes ask for.

    For narrow tables: a checkpoint has a file per partition, empty ones too, and each later shuffle a task for each.
    A table at path, if given, is replaced.  No more than tasks files are written, if given: a task goes through several partitions, one after
    another.  A file costs more than its rows if there are few: without Hadoop's native library an executor starts some four
    processes for each (chmod of the file, its checksum and their folders), and each is a fork of the executor until it runs.
    """
    path = path or f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    with tidy(df.sparkSession):
        (df.coalesce(tasks) if tasks else df).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a narrow table that are broadcast at most, some 16 MB; beyond, the join shuffles both sides.
SMALL_ROWS = 500_000
#: A key is hot if it holds this share of all rows, so there are no more than HOT hot keys.
HOT = 4096


def few(ids: DataFrame) -> DataFrame:
    """A cut table of ids, marked for broadcast only if it was counted and is small."""
    return F.broadcast(ids) if ids.count() <= SMALL_ROWS else ids


def join_counted(rows: DataFrame, counted: DataFrame, key: str, total: int, n: str = "n") -> DataFrame:
    """rows joined by key to counted, a cut table with a row per key and n, the number of rows that have it, of total rows in all.

    A small table is broadcast.  Of a large one hot keys are looked up where the rows are (HOT keys are broadcast at most), so no task
    gets a hot key's rows; the other keys are joined by a shuffle.
    """
    if counted.count() <= SMALL_ROWS:
        return rows.join(F.broadcast(counted), key)
    hot = F.col(n) * HOT >= total
    many = F.broadcast(counted.filter(hot))
    rest = rows.join(F.broadcast(counted.filter(hot).select(key)), key, "left_anti")
    return rows.join(many, key).unionByName(rest.join(counted.filter(~hot), key))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def columns(df: DataFrame, **kinds: str) -> DataFrame:
    """Only the named columns, in the named types; any other column of df, whatever its name, is left out."""
    return df.select(*[F.col(f"`{c}`").cast(kind).alias(c) for c, kind in kinds.items()])


def map_batches(df: DataFrame, f: Callable[[dict[str, list]], dict[str, object]], schema: str, *keep: str) -> DataFrame:
    """f over batches of rows: it gets lists by column and returns the new columns; those in keep pass unchanged."""
    passed = [df.schema[c] for c in keep]
    kinds = arrow_fields(schema)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                rows = {c: b.column(i) for i, c in enumerate(names)}
                new = f({c: v.to_pylist() for c, v in rows.items() if c not in keep or c in getattr(f, "reads", ())})
                yield pa.RecordBatch.from_arrays([*(rows[c] for c in keep), *(pa.array(new[c], kind) for c, kind in kinds)], [*keep, *(c for c, _ in kinds)])

    from pyspark.sql.types import StructType

    return df.mapInArrow(run, StructType([*passed, *StructType.fromDDL(schema).fields]))


def arrow_fields(ddl: str) -> list[tuple[str, pa.DataType]]:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    return [(x.name, to_arrow_type(x.dataType)) for x in StructType.fromDDL(ddl).fields]
