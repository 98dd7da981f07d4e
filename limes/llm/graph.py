"""Distributed connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limes.llm.common import SMALL_ROWS, join_counted, shared_folder, stored


def components(edges: DataFrame, a: str = "a", b: str = "b", tasks: int | None = None) -> DataFrame:
    """id, component (smallest id reachable) of each node that an edge touches.

    Alternating large-star and small-star steps: every node's links are replaced by links to its least neighbour,
    until nothing changes.  Least neighbours are found by aggregation, which also runs in the map tasks, and those of nodes
    with very many links are looked up where the links are; only counts reach the driver.  Edges with nulls, loops
    and repeated edges are allowed.  tasks: as stored has them, for the table of each step.
    """
    folder = f"{shared_folder(edges.sparkSession)}/{uuid.uuid4().hex}"
    links = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), f"{folder}/0", tasks)
    number, before, turn = links.count(), None, 0

    def looked_up(rows: DataFrame, least: DataFrame, name: str) -> DataFrame:
        """rows with m of their u; there are at most 2 * number different u."""
        if 2 * number <= SMALL_ROWS:
            return rows.join(F.broadcast(least.drop("n")), "u")
        return join_counted(rows, stored(least, f"{folder}/{name}", tasks), "u", 2 * number)

    while True:
        turn += 1  # tables of the last but one step are overwritten
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        large = looked_up(both.filter("v > u"), least, "least").select(F.col("v").alias("u"), F.col("m").alias("v"))  # nodes above u go to its least
        large = stored(large.unionByName(least.filter("m < u").select("u", F.col("m").alias("v"))).distinct(), f"{folder}/large", tasks)
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = looked_up(large, low, "low").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        links = stored(small, f"{folder}/{turn % 2}", tasks)
        now = links.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if now == before:
            break
        before, number = now, now[0]
    ends = links.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id")
    return ends.unionByName(ends.select(F.col("component").alias("id"), "component")).distinct()
