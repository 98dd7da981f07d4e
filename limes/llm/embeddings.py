"""Operator 6: near-duplicate embeddings by random-hyperplane sign hashing.

Vectors of one label fall into buckets by the signs of their products with random hyperplanes, in several tables.
The number of hyperplanes follows the number of vectors, the number of tables follows from the chance to miss a pair at
the threshold.  Large buckets are split into blocks, and blocks are compared pairwise in tasks of bounded size.
A pair is counted in the first table in which it meets, so it counts once.  Equal vectors are compared once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limes.llm.common import cut, join_counted, prepare, stored
from limes.llm.graph import components

#: Vectors of a bucket that go to one block, about, and rows of a block that are compared at once.
BLOCK = 2048
ROWS = 256
#: Chance that a pair at the threshold meets in no table.
MISSED = 1e-4
SEED = 20_260


def clean(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, v (array of double) of vectors that may link: not null, not zero, every component finite."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), *(["label"] if "label" in vectors.columns else []))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0))


def near_links(reps: DataFrame, dims: int, count: int, largest: int, least: float) -> DataFrame:
    """id, other, links of representatives (id, h, g, v, copies; count in all) that are linked in their group g (label and length; largest).

    A pair of representatives whose cosine reaches `least` is counted in the first table in which it meets: links is
    the number of vectors that id is linked to there, other the smallest id that hangs together with it there.  So a group of near
    copies gives a row for each of its vectors and block, not one for each pair.
    """
    planes = max(4, min(62, round(math.log2(max(2, largest / 400)))))
    meet = (1 - math.acos(least) / math.pi) ** planes
    tables = max(1, math.ceil(math.log(MISSED) / math.log(1 - meet)))
    signs = np.random.default_rng(SEED).standard_normal((tables * planes, dims))

    def signatures(m: np.ndarray, upto: int) -> np.ndarray:
        """The first `upto` tables' buckets of each row of m, which has dims columns or fewer."""
        m = m / np.abs(m).max(1)[:, None]
        bits = (m @ signs[: upto * planes, : m.shape[1]].T > 0).reshape(len(m), upto, planes)
        return bits @ (np.int64(1) << np.arange(planes, dtype=np.int64))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for _, part in b.groupby(b["v"].map(len)):
                yield pd.DataFrame({"id": part["id"], "h": part["h"], "g": part["g"], "sig": list(signatures(np.stack(part["v"].to_list()), tables))})

    spots = cut(reps.select("id", "h", "g", "v").mapInPandas(hashed, "id long, h binary, g string, sig array<long>"))
    spots = spots.select("id", "h", "g", F.posexplode("sig").alias("t", "s")).select("id", "h", F.struct("g", "t", "s").alias("bucket"))
    sizes = stored(spots.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").withColumn("m", F.ceil(F.col("n") / BLOCK)))
    # each pair of blocks i <= j is a task's group; a vector goes to every pair that holds its block
    placed = join_counted(spots, sizes, "bucket", tables * count).withColumn("block", F.pmod(F.xxhash64("id", "h"), F.col("m"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)))
    placed = placed.select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "h")
    paired = placed.join(reps.select("id", "h", "v", "copies"), ["id", "h"]).select("bucket.g", "bucket.t", "bucket.s", "i", "j", "block", "id", "v", "copies")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        t, i, j = int(pdf["t"].iloc[0]), pdf["i"].iloc[0], pdf["j"].iloc[0]
        pdf = pdf.sort_values("id", ignore_index=True)
        ids, block, copies = pdf["id"].to_numpy(), pdf["block"].to_numpy(), pdf["copies"].to_numpy()
        m = np.stack(pdf["v"].to_list())
        sig = signatures(m, t) if t else None
        m = m / np.abs(m).max(1)[:, None]  # else squares of very large or small components leave the range of doubles
        m = m / np.sqrt((m * m).sum(1))[:, None]
        links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for k in range(0, len(ids), ROWS):
            x, y = np.nonzero(m[k : k + ROWS] @ m.T >= least - 1e-9)
            x = x + k
            ok = (x < y) & ((block[x] != block[y]) if i != j else True)
            x, y = x[ok], y[ok]
            x, y = (z[(m[x] * m[y]).sum(1) >= least] for z in (x, y))
            if t:
                first = ~(sig[x] == sig[y]).any(1)
                x, y = x[first], y[first]
            np.add.at(links, x, copies[y])
            np.add.at(links, y, copies[x])
            while len(x):  # roots of linked vectors become the smaller one
                low = np.minimum(root[x], root[y])
                np.minimum.at(root, root[x], low)
                np.minimum.at(root, root[y], low)
                root = root[root]
                apart = root[x] != root[y]
                x, y = x[apart], y[apart]
        while (root != root[root]).any():
            root = root[root]
        some = links > 0
        return pd.DataFrame({"id": ids[some], "other": ids[root[some]], "links": links[some]})

    return paired.groupBy("g", "t", "s", "i", "j").applyInPandas(compare, "id long, other long, links long")


def near_duplicates(vectors: DataFrame, least: float = 0.93) -> DataFrame:
    """Per row of vectors: vec_id, n_links, component_id, kept, for columns vec_id, embedding and label.

    Vectors link if their labels are equal and not null and their cosine reaches `least`.  Vectors that are null, zero
    or hold null or non-finite components, or whose label or id is null, link with nothing: n_links 0, themselves their
    component.  Vectors of different lengths don't link.  Rows that repeat an id count each as a vector.  Other columns are left out; an empty
    table gives an empty result.
    """
    prepare(vectors.sparkSession)
    every = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    rows = clean(vectors).filter("label IS NOT NULL").withColumn("g", F.concat_ws("/", F.col("label").cast("string"), F.size("v").cast("string")))
    rows = rows.select("id", "g", "v", F.unhex(F.md5(F.concat_ws(",", F.transform("v", lambda x: (x + 0.0).cast("string"))))).alias("h"))
    reps = cut(rows.groupBy("g", "h").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("v").alias("v")))
    dims, count = reps.agg(F.max(F.size("v")), F.count("*")).first()
    largest = reps.groupBy("g").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    links = cut(near_links(reps, dims or 1, count, largest, least))
    linked = links.groupBy("id").agg(F.sum("links").alias("far"))
    parts = components(links, "id", "other")
    per_rep = reps.select("g", "h", "id", "copies").join(linked, "id", "left").join(parts, "id", "left").select("g", "h", (F.col("copies") - 1 + F.coalesce("far", F.lit(0).cast("long"))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    members = rows.select("id", "g", "h").join(cut(per_rep), ["g", "h"]).groupBy("id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = every.join(members.withColumnRenamed("id", "vec_id"), "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
