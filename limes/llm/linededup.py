"""Operator 5 [native]: boilerplate lines that many sites share.

The sites of each line are counted by a HyperLogLog sketch per line hash; sketches merge in the map tasks and again
after the shuffle.  Only lines whose estimate is near the threshold get an exact distinct count.  Of a line on
`sites` sites or more, the first occurrence (by document, then place) stays and all others go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limes.llm.common import columns, join_counted, prepare, stored

SITES = 3
LG_K = 10
#: An estimate within this share of the threshold, or 2 of it, is near: over six standard errors at LG_K = 10.
NEAR = 0.2


def keys(line: Column) -> Column:
    """128 bits of a line in two hashes; lines are equal up to blanks at both ends."""
    return F.struct(F.xxhash64(F.trim(line)).alias("a"), F.xxhash64(F.lit(7), F.trim(line)).alias("b"))


def document() -> list[Column]:
    """What a row is told by: its id and a hash of its text, so that rows which repeat an id with another text stand for themselves."""
    return [F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("th")]


def lines(docs: DataFrame) -> DataFrame:
    """id, th, site, pos, key of each line that isn't blank; rows with a null id have none here."""
    rows = columns(docs, doc_id="long", text="string", source="string").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    parts = rows.select(*document(), F.coalesce("source", F.lit("")).alias("site"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return parts.filter(F.trim("line") != "").select("id", "th", "site", "pos", keys(F.col("line")).alias("key"))


def boilerplate(docs: DataFrame, sites: int = SITES) -> DataFrame:
    """key, n_sites (exact if near the threshold), n (lines), first (id, pos, th) of each line on `sites` sites or more.

    A null site counts as one site of its own name, the empty one.  Near-threshold lines are few or many, hot or not: they are
    looked up where the lines are, so a line of a third of all rows is counted there too.
    """
    prepare(docs.sparkSession)
    low, high = min(sites - 2, sites * (1 - NEAR)), max(sites + 2, sites * (1 + NEAR))
    sketch = F.hll_sketch_agg("site", LG_K)
    counted = lines(docs).groupBy("key").agg(F.hll_sketch_estimate(sketch).alias("estimate"), F.count("*").alias("n"), F.min(F.struct("id", "pos", "th")).alias("first"))
    counted = stored(counted.filter((F.col("n") >= sites) & (F.col("estimate") >= low)))
    near = counted.filter(F.col("estimate") <= high)
    exact = at_keys(lines(docs), near.select("key", "n")).groupBy("key", "site").agg(F.lit(1).alias("one")).groupBy("key").agg(F.count("one").alias("exact"))
    return counted.join(exact, "key", "left").withColumn("n_sites", F.coalesce("exact", "estimate")).filter(F.col("n_sites") >= sites).select("key", "n_sites", "n", "first")


def at_keys(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows joined to found (key, n and more; cut) by key, hot or not."""
    return join_counted(rows, found, "key", found.agg(F.sum("n")).first()[0] or 0)


def removals(docs: DataFrame, sites: int = SITES) -> DataFrame:
    """id, th, gone (places of the lines to remove, from 0) of each document that loses any."""
    found = stored(boilerplate(docs, sites).select("key", "n", "first"))
    hit = at_keys(lines(docs), found).filter(F.struct("id", "pos", "th") > F.col("first"))
    return hit.groupBy("id", "th").agg(F.collect_set("pos").alias("gone"))


def remove_boilerplate(docs: DataFrame, sites: int = SITES) -> DataFrame:
    """docs with `text` freed of boilerplate lines, and n_removed (lines).

    All rows and other columns stay, the latter as they were, but for a column named n_removed, which is replaced.
    A text whose lines all go becomes empty; null and empty texts and rows with a null id stay as they are.  Rows that repeat an id
    lose lines by their own text; rows that repeat id and text lose the same lines.  Of a line that two rows of one id hold at one place
    first, the text with the smaller hash keeps it.  Texts of any length are split whole, in time linear in their lines.  An empty table stays empty.
    """
    gone = removals(docs, sites)
    # all of a row travels in one column, so no name of its own can clash
    rows = docs.drop("n_removed").select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("th"))
    rest = rows.join(gone, ["id", "th"], "left")
    parts = F.split("row.text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get(parts, i)), "\n"))
    removed = F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long")
    kept = [text.alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns if c != "n_removed"]
    return rest.select(*kept, removed.alias("n_removed"))
