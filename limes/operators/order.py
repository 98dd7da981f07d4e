"""Places in a global order without a window over all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limes.sources.tables import stored


def numbered(df: DataFrame, *keys, name: str = "place") -> DataFrame:
    """df with the place of each row (from 1) in the order of keys: rows are dealt by range, numbered in their partition, and
    the partitions' counts (as many numbers as partitions) are added up.  Rows with equal keys get places in any order.

    The sorted rows are written with their places in their partitions, so that a task that is run again changes none.
    """
    every = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys).select(F.monotonically_increasing_id().alias("id"), every.alias("row"))
    dealt = stored(dealt)
    part = F.shiftright("id", 33)
    counts = {r.p: r.n for r in dealt.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    starts, total = [], 0
    for p in sorted(counts):
        starts.append((p, total))
        total += counts[p]
    offsets = df.sparkSession.createDataFrame(starts, "p long, start long")
    rows = dealt.withColumn("p", part).join(F.broadcast(offsets), "p")
    kept = [F.col("row").getField(c).alias(c) for c in df.columns if c != name]
    return rows.select(*kept, (F.col("start") + F.col("id").bitwiseAND((1 << 33) - 1) + 1).alias(name))


def stable_code_sort(units: DataFrame, code: str = "ubigeo") -> DataFrame:
    """units in the order of their codes' length, then code, with their place."""
    return numbered(units, F.length(code), F.col(code)).orderBy("place")
