"""The alerts of `limes.operators.watch` for each snapshot that arrives in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from limes.operators.watch import watch_alerts


def watch_stream(spark: SparkSession, folder: str, schema: str, out: str, checkpoint: str, entries: DataFrame, catalogue: DataFrame, declared: DataFrame, expected: int) -> StreamingQuery:
    """Alerts of each snapshot (column snapshot of the arriving rows) under out/alerts/snapshot=..., for rows in any number of files and batches.

    Rows are kept in a folder for each snapshot (out/rows/snapshot=...), so a batch reads no more than the snapshots that it touches, and judges these
    anew, as far as they have arrived.  The rows of a batch overwrite those of its number and alerts those of their snapshots, so a repeated batch
    changes nothing.
    """
    arriving = spark.readStream.schema(schema).parquet(folder)

    def alerts(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        batch = batch.withColumn("batch", F.lit(number))
        batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot", "batch").parquet(f"{out}/rows")
        touched = [r.snapshot for r in batch.select("snapshot").distinct().collect()]  # those of one batch
        rows = session.read.schema(f"{schema}, batch long").parquet(f"{out}/rows")
        for snapshot in touched:
            one = rows.filter((F.col("snapshot") == snapshot) & (F.col("batch") <= number))  # one folder
            watch_alerts(one, entries, catalogue, declared, expected).write.mode("overwrite").parquet(f"{out}/alerts/snapshot={snapshot}")

    return arriving.writeStream.foreachBatch(alerts).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
