"""GeoJSON collections of any layout, read in splits: on one line, indented, or a feature per line.

Spark's text source cuts files at each closing brace, in as many splits as their bytes ask for, so no task reads a file whole.  What a
brace means depends on all that stands before it.  A first pass therefore finds for each split how it changes the depth of braces and
brackets, for either way in which it may begin (inside a string or outside); these few numbers per split are put together, and a second
pass reads features knowing where it is.  Features that cross splits are put together from their pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limes.sources.tables import shipped, stored

#: Strings, whole or to the end of the text, and what counts outside them.
STRING = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\Z)', re.DOTALL)
REST = re.compile(r'(?:[^"\\]|\\.)*"', re.DOTALL)
MARK = re.compile(r"[{}\[\]]")
#: What stands before the array that holds a collection's features.
FEATURES = re.compile(r'"features"\s*:\s*\Z')


def outside(text: str, inside: bool) -> tuple[str, bool]:
    """A text with its strings blanked, at equal length, and whether it ends within a string; inside: it begins within one."""
    start = ""
    if inside:
        end = REST.match(text)
        if not end:
            return " " * len(text), True
        start, text = " " * end.end(), text[end.end() :]
    ends_open = False

    def blank(m: re.Match) -> str:
        nonlocal ends_open
        ends_open = len(m[0]) == 1 or not m[0].endswith('"') or m.end() == len(text) and not closed(m[0])
        return " " * len(m[0])

    return start + STRING.sub(blank, text), ends_open


def closed(string: str) -> bool:
    """Whether a string's last quote ends it."""
    slashes = len(string) - 1 - len(string[:-1].rstrip("\\"))
    return len(string) > 1 and slashes % 2 == 0


def depth_change(plain: str) -> tuple[int, int]:
    """By how much a text changes the depth, and the least change on its way."""
    if "]" not in plain:
        return plain.count("{") + plain.count("["), 0
    depth = least = 0
    for m in MARK.finditer(plain):
        depth += 1 if m[0] in "{[" else -1
        least = min(least, depth)
    return depth, least


class Scan:
    """Where a reader stands that began inside or outside a string: whether it is inside one now, the depth, and the least depth so far."""

    def __init__(self, inside: bool):
        self.inside, self.depth, self.least = inside, 0, 0

    def read(self, value: str) -> None:
        """A record and the brace after it."""
        plain, self.inside = outside(value, self.inside)
        change, least = depth_change(plain)
        self.least = min(self.least, self.depth + least)
        self.depth += change - (not self.inside)
        self.least = min(self.least, self.depth)


def level_of(head: str, depth: int, plain: str, at_end: int) -> int | None:
    """The depth at which a file's features begin, as far as the beginning of its text tells: 2 in a collection, 1 in an array, 0 for one after the other."""
    for m in MARK.finditer(plain):
        if m[0] in "{[":
            if m[0] == "[" and depth == 0:
                return 1
            if m[0] == "[" and depth == 1 and FEATURES.search(head[: len(head) - len(plain) + m.start()]):
                return 2
            depth += 1
        else:
            depth -= 1
    return 0 if at_end <= 0 else None


def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each split does to a reader that comes to it outside (0) or inside (1) a string; the level of the features, if the split tells."""
    names = ["source", "block", "inside0", "depth0", "least0", "inside1", "depth1", "least1", "level"]
    at, scans, head, level = None, [], "", None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(names, (*at, *(x for s in scans for x in (s.inside, s.depth, s.least)), level)))], pa.schema([("source", pa.string()), ("block", pa.int64()), *[(f"{c}{k}", pa.bool_() if c == "inside" else pa.int64()) for k in (0, 1) for c in ("inside", "depth", "least")], ("level", pa.int64())]))

    for b in batches:
        for source, block, value in zip(*(b.column(k).to_pylist() for k in range(3))):
            if (source, block) != at:
                if at:
                    yield row()
                at, scans, head, level = (source, block), [Scan(False), Scan(True)], "", None
            if block == 0 and level is None:
                before, inside = scans[0].depth, scans[0].inside
                plain, open_ = outside(value, inside)
                head += value
                level = level_of(head, before, plain, before + depth_change(plain)[0] - (not open_))
                head += "}"
            for s in scans:
                s.read(value)
    if at:
        yield row()


def entries(splits: pd.DataFrame) -> pd.DataFrame:
    """How a reader comes to each split of a file: inside a string or not, at what depth, and in which split the feature began that is open."""
    splits = splits.sort_values("block")
    levels = splits["level"].dropna()
    level = int(levels.iloc[0]) if len(levels) else 0
    out, inside, depth, begun = [], False, 0, 0
    for r in splits.itertuples():
        out.append((r.source, r.block, inside, depth, begun, level))
        k = int(inside)
        if depth + getattr(r, f"least{k}") <= level:
            begun = r.block
        inside, depth = getattr(r, f"inside{k}"), depth + getattr(r, f"depth{k}")
    return pd.DataFrame(out, columns=["source", "block", "inside", "depth", "begun", "level"])


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features, and the pieces of those that cross splits, of records with their splits' entries."""
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
    at, out = None, []
    inside, depth, level, begun, held = False, 0, 0, 0, None

    def made() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["source", "begun", "block", "whole", "text"])
        out.clear()
        return rows

    for b in batches:
        for source, block, value, *entry in zip(*(b.column(k).to_pylist() for k in range(7))):
            if (source, block) != at:
                if at and held:
                    out.append((at[0], begun, at[1], False, "".join(held)))
                at = (source, block)
                inside, depth, begun, level = entry
                held = [] if depth > level else None
            plain, inside = outside(value, inside)
            if held is None:
                for m in MARK.finditer(plain):
                    if m[0] == "{" and depth == level:
                        held, begun = [value[m.start() :]], block
                        depth += depth_change(plain[m.start() :])[0]
                        break
                    depth += 1 if m[0] in "{[" else -1
            else:
                held.append(value)
                depth += depth_change(plain)[0]
            depth -= not inside
            if held is not None:
                held.append("}")
                if depth == level and not inside:
                    out.append((source, begun, block, begun == block, "".join(held)))
                    held = None
        if out:
            yield made()
    if at and held:
        out.append((at[0], begun, at[1], False, "".join(held)))
    if out:
        yield made()


def feature_texts(spark: SparkSession, path: str) -> DataFrame:
    """source, text of each object of a collection's features, of an array's, or that stand one after the other; other objects at that depth are among them.

    The table of splits, which is broadcast, has a row for each split; a feature must fit into a row, and what stands before a
    collection's first feature into the first split.
    """
    shipped(spark)
    rows = spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("block"), "value")
    found = rows.mapInArrow(summaries, "source string, block long, inside0 boolean, depth0 long, least0 long, inside1 boolean, depth1 long, least1 long, level long")
    splits = stored(found.groupBy("source").applyInPandas(entries, "source string, block long, inside boolean, depth long, begun long, level long"))
    placed = rows.join(F.broadcast(splits), ["source", "block"]).select("source", "block", "value", "inside", "depth", "begun", "level")
    parts = placed.mapInArrow(pieces, "source string, begun long, block long, whole boolean, text string")
    # few features cross splits: one for each split at most
    crossing = parts.filter(~F.col("whole")).groupBy("source", "begun").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("p"))
    return parts.filter("whole").select("source", "text").unionByName(crossing.select("source", F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text")))
