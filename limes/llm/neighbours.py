"""Operator 2: approximate nearest neighbours by NN-descent and greedy graph search.

A graph links each vector to its nearest known ones.  It starts from the nearest in small cells of random
partitions, and from random ones where cells give too few, and improves by joins of neighbours of neighbours: those who share a
neighbour meet at it and are compared, if one of the two links is new.  A query starts at its own vertex; in each
round the nearest vertices not yet looked at are replaced by their links, for all queries in one join.  Equal vectors
are one vertex.  Graph and search work in single precision on centred and scaled vectors; a sample of queries compared with all vectors
in double precision tells whether that is enough, and what they find is measured again in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from limes.llm.common import cut, join_counted, prepare, stored
from limes.llm.embeddings import clean

LINKS = 20
#: Vectors in a cell of the first partitions, about.
CELL = 128
TABLES = 4
#: Share of changed links below which NN-descent ends.
SETTLED = 0.02
#: Vertices kept for a query at first, and looked at in one round at least.
BEAM = 240
STEP = 40
#: The beam widens by half until SAMPLE of the queries, whose neighbours are looked up exactly, have this recall.
SAMPLE = 128
RECALL = 0.92
#: Bytes of query vectors that are searched for at once; they are broadcast, so this bounds the broadcast.
SLICE_BYTES = 16 << 20
PAIRS = 100_000
SEED = 7
LINK = "id long, nb long, d double"


def nearest(rows: DataFrame, k: int) -> DataFrame:
    """The k rows of each id with the smallest d, ties by nb; one shuffle.  Of equal links, an old one stays old."""
    once = rows.repartition("id").groupBy("id", "nb").agg(F.min("d").alias("d"), F.bool_and("fresh").alias("fresh"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy("d", "nb"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank")


def fresh(links: DataFrame) -> DataFrame:
    return links.select("id", "nb", "d", F.lit(True).alias("fresh"))


def matrix(lists: pa.ListArray, dims: int) -> np.ndarray:
    """Rows of equal length as a matrix."""
    return np.asarray(lists.flatten()).reshape(-1, dims)


def best(ids: np.ndarray, m: np.ndarray, k: int, under: np.ndarray | None = None, new: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """id, nb, d of the k nearest of each row of m among the others; only distances below `under` and pairs with a new one, if given."""
    square = (m * m).sum(1)
    d = np.maximum(square[:, None] + square[None, :] - 2 * m @ m.T, 0)
    np.fill_diagonal(d, np.inf)
    if new is not None:
        d[~(new[:, None] | new[None, :])] = np.inf
    k = min(k, len(ids) - 1)
    if k < 1:
        return ids[:0], ids[:0], square[:0].astype(float)
    cols = np.argpartition(d, k - 1, axis=1)[:, :k].ravel()
    rows = np.repeat(np.arange(len(ids)), k)
    found = d[rows, cols]
    ok = found < (np.inf if under is None else under[rows])
    return ids[rows[ok]], ids[cols[ok]], found[ok].astype(float)


def within(block: pd.DataFrame, links: int) -> pd.DataFrame:
    """The nearest of each vector in a block (id, v)."""
    return pd.DataFrame(dict(zip(("id", "nb", "d"), best(block["id"].to_numpy(), np.stack(block["v"].to_list()), links))))


def first_links(points: DataFrame, dims: int, n: int, links: int) -> DataFrame:
    """Nearest in cells of random hyperplanes, several times; a cell is split at random if it is large."""
    planes = max(0, round(math.log2(max(1, n) / CELL)))
    signs = np.random.default_rng(SEED).standard_normal((TABLES, planes, dims)).astype(np.float32)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                m = matrix(b.column("v"), dims)
                for t in range(TABLES):
                    s = ((m @ signs[t].T > 0) @ (np.int64(1) << np.arange(planes, dtype=np.int64))).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), pa.array(s * TABLES + t)], ["id", "v", "cell"])

    spots = cut(points.select("id", "v").mapInArrow(cells, "id long, v array<float>, cell long"))
    sizes = stored(spots.groupBy("cell").agg(F.count("*").alias("n")).withColumn("m", F.ceil(F.col("n") / (2 * CELL))))
    spots = join_counted(spots, sizes, "cell", TABLES * n).withColumn("block", F.pmod(F.xxhash64("id"), F.col("m")))
    return nearest(fresh(spots.groupBy("cell", "block").applyInPandas(lambda part: within(part, links), LINK)), links)


def filled(graph: DataFrame, points: DataFrame, dims: int, n: int, links: int) -> DataFrame:
    """graph with more links for the vertices that have less than `links`: the nearest among themselves, and random ones."""
    known = graph.groupBy("id").agg(F.count("*").alias("known"))
    short = cut(points.join(known, "id", "left").filter(F.coalesce("known", F.lit(0)) < min(links, n - 1)).select("id", "v"))
    number = short.count()
    if not number:
        return graph
    own = short.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(math.ceil(number / (2 * CELL))))).groupBy("block").applyInPandas(lambda part: within(part, links), LINK)
    # random ones come from pools of about 32, so that no task sees all ids
    pools = max(1, n // 32)
    pool = points.groupBy(F.pmod(F.xxhash64("id"), F.lit(pools)).alias("pool")).agg(F.sort_array(F.collect_list("id")).alias("ids"))
    drawn = short.select("id", F.explode(F.sequence(F.lit(1), F.lit(2 * links))).alias("j"))
    drawn = drawn.withColumn("pool", F.pmod(F.xxhash64("id", "j"), F.lit(pools))).join(pool, "pool")
    nb = F.element_at("ids", (F.pmod(F.xxhash64("j", "id"), F.size("ids")) + 1).cast("int"))
    ends = drawn.select("id", nb.alias("nb")).filter("id <> nb").distinct().join(points.select("id", "v"), "id").join(points.select(F.col("id").alias("nb"), F.col("v").alias("w")), "nb")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("v"), dims) - matrix(b.column("w"), dims)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("nb"), pa.array((x * x).sum(1).astype(float))], ["id", "nb", "d"])

    far = ends.select("id", "nb", "v", "w").mapInArrow(measured, LINK)
    return nearest(graph.unionByName(fresh(own)).unionByName(fresh(far)), links)


def descend(graph: DataFrame, points: DataFrame, dims: int, links: int) -> DataFrame:
    """One round of NN-descent: the links into and out of each vertex meet at it, wherever one of them is new."""
    back = graph.select(F.col("nb").alias("at"), F.col("id").alias("u"), "fresh")
    back = back.withColumn("k", F.row_number().over(Window.partitionBy("at").orderBy(F.desc("fresh"), F.xxhash64("u", "at")))).filter(F.col("k") <= links).drop("k")
    meet = graph.select(F.col("id").alias("at"), F.col("nb").alias("u"), "fresh").unionByName(back).repartition("at").groupBy("at", "u").agg(F.bool_or("fresh").alias("fresh"))
    meet = meet.groupBy("at").agg(F.collect_list(F.struct("u", "fresh")).alias("x")).filter(F.exists("x", lambda x: x["fresh"]) & (F.size("x") > 1))  # 2 * links at most
    worst = graph.groupBy("id").agg(F.when(F.count("*") == links, F.max("d")).alias("worst"))
    carried = points.join(worst, "id", "left").select(F.col("id").alias("u"), "v", F.coalesce("worst", F.lit(float("inf"))).alias("worst"))
    groups = meet.select("at", F.explode("x").alias("x")).select("at", "x.u", "x.fresh").join(carried, "u").groupBy("at").agg(F.collect_list(F.struct("u", "v", "worst", "fresh")).alias("x"))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("x")
            rows = lists.flatten()
            u, v, under, new = np.asarray(rows.field("u")), matrix(rows.field("v"), dims), np.asarray(rows.field("worst")), np.asarray(rows.field("fresh").cast(pa.int8())) > 0
            ends = np.cumsum(lists.value_lengths().to_numpy())
            found = [best(u[a:z], v[a:z], 5, under[a:z], new[a:z]) for a, z in zip([0, *ends], ends)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], ["id", "nb", "d"])

    found = groups.select("x").mapInArrow(local, LINK)
    old = graph.select("id", "nb", "d", F.lit(False).alias("fresh"))
    return nearest(old.unionByName(fresh(found)), links)


def neighbour_graph(points: DataFrame, dims: int, n: int, links: int = LINKS) -> DataFrame:
    """id, nb, d (squared distance): the `links` nearest known vectors of each of the n vectors in points (id, v; ids differ)."""
    graph = cut(filled(cut(first_links(points, dims, n, links)), points, dims, n, links))
    while True:  # links only get nearer, so this ends
        graph = cut(descend(graph, points, dims, links))
        total, new = graph.agg(F.count("*"), F.count_if("fresh")).first()
        if new <= SETTLED * total:
            return graph.select("id", "nb", "d")


def links_of(graph: DataFrame) -> DataFrame:
    """id, nbs: the vertices that a vertex is linked to and the nearest that are linked to it, 2 * LINKS at most."""
    back = graph.select(F.col("nb").alias("id"), F.col("id").alias("nb"), "d", F.lit(True).alias("fresh"))
    both = graph.select("id", "nb").unionByName(nearest(back, LINKS).select("id", "nb"))
    return cut(both.repartition("id").groupBy("id").agg(F.collect_set("nb").alias("nbs")))


def greedy_search(edges: DataFrame, points: DataFrame, starts: DataFrame, dims: int, beam: int) -> DataFrame:
    """q, nb, d: the `beam` nearest vertices found for each start (column q, ids of points), itself included at distance 0.

    It ends when all kept vertices of all starts were looked at.  Queries are searched for in slices of SLICE_BYTES.
    """
    asked = cut(starts.select("q").distinct().join(points.withColumnRenamed("id", "q"), "q"))
    slices = max(1, math.ceil(asked.count() * dims * 4 / SLICE_BYTES))
    found = None
    for k in range(slices):
        part = asked.filter(F.pmod(F.xxhash64("q"), F.lit(slices)) == k).toArrow().sort_by("q")  # SLICE_BYTES, about
        if part.num_rows:
            one = slice_search(edges, points, part, dims, beam, beam).select("q", "nb", "d")
            found = one if found is None else found.unionByName(one)
    return points.sparkSession.createDataFrame([], "q long, nb long, d double") if found is None else found


def slice_search(edges: DataFrame, points: DataFrame, asked: pa.Table, dims: int, beam: int, keep: int, state: DataFrame | None = None) -> DataFrame:
    """q, nb, d, done: greedy_search for the vectors of asked (q, v; in order of q); the `keep` nearest found stay, the `beam` nearest are looked at.

    state: what a search with a smaller beam has kept.  If that was as much as `beam`, going on from there finds what a search from
    the start would find, for nothing that was dropped could be among the nearest now.
    """
    spark = points.sparkSession
    queries = asked["q"].to_numpy()
    vectors = spark.sparkContext.broadcast((queries, matrix(asked["v"].combine_chunks(), dims)))
    step, order = max(STEP, beam // 6), Window.partitionBy("q")

    def turn(once: DataFrame) -> DataFrame:
        """What is kept, and which of it is looked at now."""
        kept = once.withColumn("place", F.row_number().over(order.orderBy("d", "nb"))).filter(F.col("place") <= keep)
        near = F.col("place") <= beam
        kept = kept.withColumn("turn", F.row_number().over(order.orderBy(F.col("done") | ~near, "d", "nb")))
        return cut(kept.select("q", "nb", "d", "done", (near & ~F.col("done") & (F.col("turn") <= step)).alias("now")))

    if state is None:
        state = spark.createDataFrame(asked.select(["q"])).select("q", F.col("q").alias("nb"), F.lit(0.0).alias("d"), F.lit(False).alias("done"))
    state = turn(state)
    while True:  # each round looks at new vertices, and a kept one only gives way to nearer ones
        ends = state.groupBy("q").agg(F.when(F.count("*") == keep, F.max("d")).alias("worst"), F.count_if("now").alias("now")).toArrow().sort_by("q")
        if not pa.compute.sum(ends["now"]).as_py():
            vectors.unpersist()
            return state.select("q", "nb", "d", "done")
        worst = ends["worst"].fill_null(np.inf).to_numpy()
        met = state.filter("now").select("q", F.col("nb").alias("id")).join(edges, "id").select("q", F.explode("nbs").alias("id"))
        met = met.groupBy("id").agg(F.collect_set("q").alias("qs")).join(points, "id").select("id", "v", "qs")

        def distances(batches: Iterator[pa.RecordBatch], worst: np.ndarray = worst) -> Iterator[pa.RecordBatch]:
            queries, w = vectors.value
            for b in batches:
                v, ids = matrix(b.column("v"), dims), np.asarray(b.column("id"))
                row = np.repeat(np.arange(len(ids)), b.column("qs").value_lengths().to_numpy())
                at = np.searchsorted(queries, np.asarray(b.column("qs").flatten()))
                for k in range(0, len(row), PAIRS):
                    r, q = row[k : k + PAIRS], at[k : k + PAIRS]
                    x = v[r] - w[q]
                    d = (x * x).sum(1).astype(float)
                    near = d < worst[q]
                    yield pa.RecordBatch.from_arrays([pa.array(queries[q[near]]), pa.array(ids[r[near]]), pa.array(d[near])], ["q", "nb", "d"])

        new = met.mapInArrow(distances, "q long, nb long, d double")
        both = state.select("q", "nb", "d", (F.col("done") | F.col("now")).alias("done")).unionByName(new.withColumn("done", F.lit(False)))
        state = turn(both.repartition("q").groupBy("q", "nb").agg(F.min("d").alias("d"), F.bool_or("done").alias("done")))


def exact(points: DataFrame, starts: DataFrame, k: int) -> DataFrame:
    """q, nb, d: the k nearest of all points for each start, itself included, in the precision of the points; blocks of both sides are compared."""
    size = lambda df, most: F.pmod(F.xxhash64("id"), F.lit(max(1, math.ceil(df.count() / most))))
    asked = cut(starts.select(F.col("q").alias("id")).distinct().join(points, "id").select("id", "v"))
    packed = lambda df, most, c: df.groupBy(size(df, most).alias("block")).agg(F.collect_list("id").alias(f"{c}_ids"), F.collect_list("v").alias(f"{c}_v")).drop("block")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for q, w, ids, v in zip(b["q_ids"], b["q_v"], b["p_ids"], b["p_v"]):
                w, v, ids = np.stack(list(w)), np.stack(list(v)), np.asarray(ids)
                order = np.argsort(ids)
                v, ids = v[order], ids[order]
                for i, x in zip(q, w):
                    d = ((v - x) ** 2).sum(1).astype(float)
                    near = np.argsort(d, kind="stable")[:k]
                    yield pd.DataFrame({"id": i, "nb": ids[near], "d": d[near]})

    pairs = packed(asked, 256, "q").crossJoin(packed(points.select("id", "v"), 4096, "p"))
    return nearest(fresh(pairs.mapInPandas(compare, LINK)), k).select(F.col("id").alias("q"), "nb", "d")


def search_widening(graph: DataFrame, points: DataFrame, precise: DataFrame, starts: DataFrame, dims: int, n: int, k: int) -> DataFrame:
    """greedy_search with the first beam at which a sample of starts, compared with all n points in double precision, has RECALL of its k nearest.

    The beam that this takes depends on the vectors: without structure it grows almost as their number, otherwise hardly.  A search
    compares about 2 * LINKS vectors for each kept vertex, so beyond a beam of n / (2 * LINKS) comparing all vectors takes less, and is done.
    """
    number = starts.count()
    sample = cut(starts.select("q").filter(F.pmod(F.xxhash64("q", F.lit(SEED)), F.lit(max(1, number // SAMPLE))) == 0))
    truth = cut(exact(precise, sample, k + 1))
    edges = links_of(graph)
    asked = sample.join(points.withColumnRenamed("id", "q"), "q").select("q", "v").toArrow().sort_by("q")  # 2 * SAMPLE rows, about
    beam, wanted, found = BEAM, truth.count(), None
    if not asked.num_rows:
        return greedy_search(edges, points, starts, dims, beam)
    while True:
        found = slice_search(edges, points, asked, dims, beam, 2 * beam, found)
        if found.join(truth.select("q", "nb"), ["q", "nb"], "left_semi").count() >= RECALL * wanted:
            break
        beam += beam // 2
        if beam * 2 * LINKS > n:
            return exact(precise, starts, 2 * k + 2)
    found = found.select("q", "nb", "d")
    rest = starts.select("q").join(sample, "q", "left_anti")
    return found if rest.isEmpty() else found.unionByName(greedy_search(edges, points, rest, dims, beam))


def scaled(classes: DataFrame) -> DataFrame:
    """id, v of classes (rep, v), centred and scaled into -1 to 1, in double precision: distances keep their order, and single precision resolves them better."""
    top = classes.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0] or 1.0
    means = {r.pos: r.mean for r in classes.select(F.posexplode("v")).groupBy("pos").agg(F.avg(F.col("col") / top).alias("mean")).collect()}  # a number for each dimension
    mean = F.array(*[F.lit(float(means[i])) for i in range(len(means))])
    moved = classes.select(F.col("rep").alias("id"), F.zip_with("v", mean, lambda x, m: x / top - m).alias("v"))
    spread = moved.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0] or 1.0
    return moved.select("id", F.transform("v", lambda x: x / spread).alias("v"))


def search(vectors: DataFrame, k: int = 10, every: int = 100, beam: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each row whose id is divisible by `every`.

    Nearness is the Euclidean distance in double precision, ties to the smaller id; a query's own row is no candidate.
    Vectors that are null, zero or hold null or non-finite components, or whose id is null, take no part; vectors are compared with
    those of their own length.  Of rows with equal ids, the smallest vector counts.  Other columns are left out; with
    fewer candidates than k, all of them are returned; an empty table gives none.  beam: vertices kept for a query, by default as many as
    a sample needs.
    """
    spark = prepare(vectors.sparkSession)
    rows = clean(vectors).groupBy("id").agg(F.min("v").alias("v"))
    rows = cut(rows.withColumn("h", F.md5(F.concat_ws(",", F.transform("v", lambda x: (x + 0.0).cast("string"))))))
    lengths = sorted(r[0] for r in rows.select(F.size("v")).distinct().collect())
    out = [search_equal(rows.filter(F.size("v") == dims), dims, k, every, beam) for dims in lengths]
    result = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for one in out:
        result = result.unionByName(one)
    return result


def search_equal(rows: DataFrame, dims: int, k: int, every: int, beam: int | None) -> DataFrame:
    """search among vectors of one length: id, v, h (equal for equal vectors)."""
    classes = cut(rows.groupBy("h").agg(F.min("id").alias("rep"), F.first("v").alias("v"), F.count("*").alias("n")))
    n, total = classes.agg(F.count("*"), F.sum("n")).first()
    if not n:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    precise = cut(scaled(classes))
    points = cut(precise.select("id", F.col("v").cast("array<float>").alias("v")))
    member = cut(join_counted(rows.select("id", "h"), classes.drop("v"), "h", total).select("id", "rep"))
    queries = member.filter(F.col("id") % every == 0).select(F.col("id").alias("query_id"), F.col("rep").alias("q"))
    starts = cut(queries.groupBy("q").agg(F.count("*").alias("n")))
    graph = neighbour_graph(points, dims, n)
    found = cut(greedy_search(links_of(graph), points, starts, dims, beam) if beam else search_widening(graph, points, precise, starts, dims, n, k))
    # what the graph does not reach is looked for among all vectors
    reached = found.groupBy("q").agg(F.count("*").alias("reached")).filter(F.col("reached") >= min(k + 1, n))
    short = cut(starts.select("q").join(reached, "q", "left_anti"))
    if not short.isEmpty():
        found = found.join(short, "q", "left_anti").unionByName(exact(precise, short, 2 * k + 2))
    close = found.withColumn("place", F.row_number().over(Window.partitionBy("q").orderBy("d", "nb"))).filter(F.col("place") <= 2 * k + 2)
    # all queries with one vector share their candidates; of equal vectors the k + 1 smallest ids are enough, for one may be the query's own
    few = member.withColumn("m", F.row_number().over(Window.partitionBy("rep").orderBy("id"))).filter(F.col("m") <= k + 1).select(F.col("rep").alias("nb"), F.col("id").alias("vec_id"))
    vector = classes.select(F.col("rep").alias("nb"), "v")
    pairs = close.select("q", "nb").join(vector, "nb").join(vector.withColumnsRenamed({"nb": "q", "v": "w"}), "q")
    score = F.sqrt(F.aggregate(F.zip_with("w", "v", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, z: s + z))
    near = pairs.select("q", "nb", score.alias("score")).join(few, "nb").withColumn("place", F.row_number().over(Window.partitionBy("q").orderBy("score", "vec_id"))).filter(F.col("place") <= k + 1)
    lists = near.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("x")).join(starts, "q")
    asked = total // every + 1
    mine = join_counted(queries, cut(lists), "q", asked).select("query_id", F.slice(F.filter("x", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("x"))
    return mine.select("query_id", F.posexplode("x").alias("rank", "x")).select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")
