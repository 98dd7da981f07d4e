"""Indicators on units: classes, tops, focus."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from limes.functions import columns as C
from limes.sources.tables import stored


def attach_indicator(units: DataFrame, values: DataFrame | None, areas: DataFrame | None = None) -> DataFrame:
    """units with value by ubigeo, null where there is none; without values, the units' area (code, area2) is the indicator."""
    if values is None:
        values = areas.select(F.col("code").alias("ubigeo"), (F.col("area2") / 2).alias("value"))
    return units.join(values, "ubigeo", "left")


def indicator_counts(attached: DataFrame) -> DataFrame:
    """with_value, without_value: how many units an indicator reaches."""
    return attached.agg(F.count("value").alias("with_value"), F.count_if(F.col("value").isNull()).alias("without_value"))


#: Buckets into which a range of values is split in each round, and values of a range that are sorted in one row at last.
BUCKETS, SORTED = 4096, 10_000


def selected(values: DataFrame, wanted: DataFrame) -> DataFrame:
    """measure, r, value: the values at the wanted places (measure, r; from 0) of their measure's order, in double precision; finite values only.

    No value is sorted but in small ranges: each round counts the values of the ranges that hold a wanted place in buckets, which combine in
    the map tasks, and goes on with the buckets that hold one, from their least to their largest value.
    """
    rows = values.filter("value IS NOT NULL").select("measure", F.col("value").cast("double").alias("value"))
    ends = rows.groupBy("measure").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("*").alias("n"))
    open_ = stored(wanted.join(ends, "measure").select("measure", "r", "lo", "hi", F.lit(0).cast("long").alias("base"), "n"))
    done = None
    while True:
        found = open_.filter("lo = hi").select("measure", "r", F.col("lo").alias("value"))
        done = found if done is None else done.unionByName(found)
        small = open_.filter(f"lo < hi AND n <= {SORTED}")
        large = open_.filter(f"lo < hi AND n > {SORTED}")
        ranges = lambda df: F.broadcast(df.select("measure", "lo", "hi").distinct())  # noqa: E731 as many as places are wanted
        within = lambda df: rows.join(ranges(df), "measure").filter(F.col("value").between(F.col("lo"), F.col("hi")))
        lists = within(small).groupBy("measure", "lo", "hi").agg(F.sort_array(F.collect_list("value")).alias("v"))
        done = done.unionByName(small.join(F.broadcast(lists), ["measure", "lo", "hi"]).select("measure", "r", F.element_at("v", (F.col("r") - F.col("base") + 1).cast("int")).alias("value")))
        if large.isEmpty():
            return done
        scale = BUCKETS / (F.col("hi") - F.col("lo"))
        inner = F.when(scale < float("inf"), F.least(F.lit(BUCKETS - 1), F.floor((F.col("value") - F.col("lo")) * scale))).otherwise(1)
        bucket = F.when(F.col("value") == F.col("lo"), 0).when(F.col("value") == F.col("hi"), BUCKETS - 1).otherwise(inner)
        counts = within(large).groupBy("measure", "lo", "hi", bucket.alias("bucket")).agg(F.min("value").alias("lo2"), F.max("value").alias("hi2"), F.count("*").alias("n2"))
        below = F.coalesce(F.sum("n2").over(Window.partitionBy("measure", "lo", "hi").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        placed = large.join(F.broadcast(counts.withColumn("below", below)), ["measure", "lo", "hi"]).withColumn("base", F.col("base") + F.col("below"))
        open_ = stored(placed.filter((F.col("r") >= F.col("base")) & (F.col("r") < F.col("base") + F.col("n2"))).select("measure", "r", F.col("lo2").alias("lo"), F.col("hi2").alias("hi"), "base", F.col("n2").alias("n")))


def at_places(values: DataFrame, k: int, whole: bool) -> DataFrame:
    """measure, i, low, high, share: the values around the place i / k of the way, and how far it lies between them; whole places only if so asked."""
    sizes = values.filter("value IS NOT NULL").groupBy("measure").agg(F.count("*").alias("n"))
    places = sizes.select("measure", F.explode(F.sequence(F.lit(0), F.lit(k))).alias("i"), "n")
    exact = F.col("i") * (F.col("n") - 1)
    places = stored(places.select("measure", "i", F.floor(exact / k).cast("long").alias("r"), (F.lit(0.0) if whole else exact / k - F.floor(exact / k)).alias("share")))
    wanted = places.select("measure", "r")
    found = stored(selected(values, (wanted if whole else wanted.unionByName(places.filter("share > 0").select("measure", (F.col("r") + 1).alias("r")))).distinct()))
    low, high = found.withColumnRenamed("value", "low"), found.select("measure", (F.col("r") - 1).alias("r"), F.col("value").alias("high"))
    return places.join(low, ["measure", "r"]).join(high, ["measure", "r"], "left").select("measure", "i", "share", "low", "high")


def quantile_cuts(values: DataFrame, k: int = 6) -> DataFrame:
    """measure, cuts: k + 1 exact quantiles, linear between values, without repeats."""
    cut = F.when(F.col("share") > 0, F.col("low") + (F.col("high") - F.col("low")) * F.col("share")).otherwise(F.col("low"))
    lists = at_places(values, k, False).groupBy("measure").agg(F.array_sort(F.collect_list(F.struct("i", cut.alias("cut")))).alias("c"))
    return lists.select("measure", F.array_distinct(F.transform("c", lambda x: x["cut"])).alias("cuts"))


def rank_cuts(values: DataFrame, k: int = 6) -> DataFrame:
    """measure, i, cut: the value at place floor(i / k * (n - 1)) of the ordered values."""
    return at_places(values, k, True).select("measure", "i", F.col("low").alias("cut"))


def assign_class(values: DataFrame, cuts: DataFrame) -> DataFrame:
    """Class from 0; both ends are clipped, a null value has class -1, and equal cuts make one class."""
    n = F.greatest(F.size("cuts") - 2, F.lit(0))
    at = F.least(F.greatest(F.size(F.filter("cuts", lambda c: c <= F.col("value"))) - 1, F.lit(0)), n)
    return values.join(cuts, "measure").select("measure", "ubigeo", F.when(F.col("value").isNull(), -1).otherwise(at).alias("class"))


def top_units(values: DataFrame, n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("measure").orderBy(F.desc("value"), "ubigeo"))
    return values.filter("value IS NOT NULL").withColumn("rank", rank).filter(F.col("rank") <= n).select("measure", "rank", "ubigeo", "value")


def focus_table(values: DataFrame, focus: str) -> DataFrame:
    return values.filter(C.in_focus(F.col("ubigeo"), focus)).orderBy(F.desc_nulls_last("value"), "ubigeo")


def children_of(units: DataFrame, focus: str) -> DataFrame:
    """ubigeo, nombre of the next level under focus, by name without accents; a blank name falls back to the code."""
    below = units.filter(F.col("ubigeo").startswith(focus) & (F.length("ubigeo") == len(focus) + 2))
    named = below.select("ubigeo", C.coalesce_blank(F.col("nombre"), F.col("ubigeo")).alias("nombre")).distinct()
    return named.orderBy(C.normalize_name(F.col("nombre")), "ubigeo")


def long_measures(wide: DataFrame, *measures: str) -> DataFrame:
    """measure, ubigeo, value; blanks and what is no number are dropped."""
    text = wide.select("ubigeo", *[F.col(m).cast("string").alias(m) for m in measures])
    return text.unpivot("ubigeo", list(measures), "measure", "t").withColumn("value", F.col("t").try_cast("double")).filter("value IS NOT NULL").select("measure", "ubigeo", "value")


def indicator_lines(values: DataFrame, parent: int = 2) -> DataFrame:
    """measure, level, parent, json: code -> value of the units under each parent (first digits of their codes), keys in order, nulls kept.

    A line holds the units of one parent, so its size doesn't grow with the number of units in all.
    """
    level = F.element_at(F.create_map(F.lit(2), F.lit("departamento"), F.lit(4), F.lit("provincia"), F.lit(6), F.lit("distrito")), F.length("ubigeo"))
    inner = values.groupBy("measure", level.alias("level"), F.substring("ubigeo", 1, parent).alias("parent")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("ubigeo", F.round("value", 2))))).alias("m"))
    return inner.select("measure", "level", "parent", F.to_json("m", {"ignoreNullFields": "false"}).alias("json"))


def indicator_json(values: DataFrame) -> DataFrame:
    """measure, json: level -> code -> value in one document, for publication: it is put together from the lines of indicator_lines, so it is as long as they are."""
    parts = indicator_lines(values).groupBy("measure", "level").agg(F.array_sort(F.collect_list(F.struct("parent", F.expr("substring(json, 2, length(json) - 2)").alias("j")))).alias("x"))
    levels = parts.select("measure", F.struct("level", F.array_join(F.transform("x", lambda e: e["j"]), ",").alias("j")).alias("l")).groupBy("measure").agg(F.array_sort(F.collect_list("l")).alias("x"))
    return levels.select("measure", F.concat(F.lit("{"), F.array_join(F.transform("x", lambda e: F.concat(F.lit('"'), e["level"], F.lit('":{'), e["j"], F.lit("}"))), ","), F.lit("}")).alias("json"))
