"""Operator 9: n-gram Jaccard join by a count-vector R-tree.

A document's set is its distinct word 5-grams.  Shingles are hashed into GROUPS groups; a document is the point of
its group counts, and the sum of the coordinate-wise minima of two points bounds the size of their intersection.

Points are stored under keys, so that two documents whose similarity reaches t share a key.  The keys are a document's
KEYS smallest shingle hashes (fewer for small sets, where the prefix filter is exact); two documents that are similar
share none of them with a chance of (1 - t) ** KEYS over the hash, 7e-12 here.  With keys = None the keys are the whole prefix, for
which this chance is nil, for some five times the entries.  A shingle that is such a key of over COMMON documents is no key;
the documents that hold it get the whole prefix of their set instead, in an order that puts rare shingles
first (by a count sketch of all these documents), for which the prefix filter is exact.  The place of a key in this
order is kept: what stands before the first common key is not shared, which bounds the intersection of documents that
have little but a common passage.  Under each key
stands an R-tree of two levels: leaves of points that are known to hang together, with their bounding boxes, and
points.  Leaf pairs are pruned by the minima of their upper corners, then pairs of points, then by bitmaps of their sets, which
bound what they share at a few bits a shingle; the pairs left are verified on the sets themselves.  The leaves of a key are dealt into blocks, so that pairs of blocks are tasks of bounded size.  Before that, each point is verified against one hub of its key (and, under keys with many
parts left, against hubs drawn by hash, so that keys of one group differ), so that a group of
near copies hangs together after as many checks as it has members, and its own leaf pairs fall away.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limes.llm.common import few, join_counted, prepare, stored, tasks_for
from limes.llm.graph import components

WORDS = 5
PERCENT = 80
KEYS = 16
COMMON = 256
GROUPS = 64
#: Group counts are small integers; sets of over MOST shingles are not pruned by them.
MOST = (1 << 15) - 1
LEAF = 64
#: Leaves of a key that go to one block, about.
BLOCK = 512
#: Rounds of hubs drawn by hash (a second one joined nothing more), for keys with over PARTS parts.
HUBS = 1
PARTS = 16
#: Counters of the sketch: 2 ** SKETCH_BITS, whatever the size of the corpus.
SKETCH_BITS = 21
#: Word hashes that a worker keeps, some 15 MB; it keeps them for later steps too.
REMEMBERED = 100_000
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
ODD = np.uint64(0x9E3779B97F4A7C15)


class Words(dict):
    """Word -> 64-bit hash; bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


@lru_cache(maxsize=1)
def word_hashes() -> Words:
    return Words()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Distinct hashes of the word 5-grams of a whole text, sorted; a shorter text is one shingle as a whole."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()  # splits at 0x20 and 0x09 to 0x0D
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(word_hashes().__getitem__, words), np.uint64, len(words))
    n = min(WORDS, len(h))
    out = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        out = mixed(out) * ODD + h[k : len(h) - n + 1 + k]
    return np.unique(mixed(out + np.uint64(n)))


def prefix(n: int) -> int:
    """So many first shingles of a set of n, in any order that all sets share, hold one of every similar set."""
    return n - -(-n * PERCENT // 100) + 1 if n else 0


def sketch(docs: DataFrame) -> np.ndarray:
    """How many of docs have shingles on each counter, as powers of two; blocks of counters are summed by Spark."""
    block = 1 << 14

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for b in batches:
            sets = [shingles(t) >> np.uint64(64 - SKETCH_BITS) for t in b.column(0).to_pylist()]
            total += np.bincount(np.concatenate([*sets, np.zeros(0, np.uint64)]).astype(np.int64), minlength=len(total))
        for k in range(0, len(total), block):
            if total[k : k + block].any():
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([np.minimum(total[k : k + block], 1 << 30).astype("<i4").tobytes()], pa.binary())], ["k", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, counts in zip(b.column(0).to_pylist(), b.column(1)):
                sums[k] = sums.get(k, 0) + np.frombuffer(counts.as_py(), "<i4").astype(np.int64)
        for k, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([np.log2(np.maximum(s, 1)).astype(np.uint8).tobytes()], pa.binary())], ["k", "level"])

    parts = docs.select("text").mapInArrow(count, "k long, counts binary").repartition(16, "k")
    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    for r in parts.mapInArrow(add, "k long, level binary").collect():  # a byte for each counter, a fixed size
        out[r.k : r.k + block] = np.frombuffer(r.level, np.uint8)
    return out


def points(docs: DataFrame, most_keys: int | None) -> DataFrame:
    """doc_id, n, set_hash, keys and group counts of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, sets, keys, grid = [], [], [], np.zeros((b.num_rows, GROUPS), np.int16)
            for i, text in enumerate(b.column(1).to_pylist()):
                s = shingles(text)
                n.append(len(s))
                sets.append(xxhash.xxh3_128_digest(s.tobytes()))
                keys.append(s[: prefix(len(s)) if most_keys is None else min(most_keys, prefix(len(s)))].view(np.int64))
                grid[i] = np.minimum(np.bincount((mixed(s) % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS), MOST)
            counts = pa.ListArray.from_arrays(np.arange(0, grid.size + 1, GROUPS, dtype=np.int32), pa.array(grid.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(sets, pa.binary()), pa.array(keys, pa.list_(pa.int64())), counts], ["doc_id", "n", "set_hash", "keys", "counts"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, set_hash binary, keys array<long>, counts array<smallint>")


def rare_keys(docs: DataFrame) -> DataFrame:
    """doc_id, n, pos, key: the whole prefix of each document, rare shingles first, with their places."""
    wide = docs.sparkSession.sparkContext.broadcast(sketch(docs))  # 2 ** SKETCH_BITS bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = wide.value
        for b in batches:
            n, keys = [], []
            for text in b.column(1).to_pylist():
                s = shingles(text)
                n.append(len(s))
                keys.append(s[np.argsort(level[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], kind="stable")[: prefix(len(s))]].view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n", "keys"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, keys array<long>").select("doc_id", "n", F.posexplode("keys").alias("pos", "key"))


def bound(a: str, b: str) -> Column:
    """Whether the minima of two points (or of upper corners) leave room for the least intersection of sets of na and nb."""
    total = F.aggregate(F.zip_with(f"{a}.counts", f"{b}.counts", lambda x, y: F.least(x, y)), F.lit(0), lambda s, c: s + c)
    return (F.greatest(f"{a}.nmax", f"{b}.nmax") > MOST) | (total * (100 + PERCENT) >= PERCENT * (F.col(f"{a}.n") + F.col(f"{b}.n")))


def similar_sizes(a: str, b: str) -> Column:
    """Whether the smaller set may hold the least share of the larger; of leaves: n least, nmax most."""
    return (F.col(f"{a}.nmax") * 100 >= F.col(f"{b}.n") * PERCENT) & (F.col(f"{b}.nmax") * 100 >= F.col(f"{a}.n") * PERCENT)


def reach(a: str, b: str) -> Column:
    """Whether enough may be shared from the places of a key on, if it is the first one that both have; of leaves: pos least."""
    rest = F.least(F.col(f"{a}.nmax") - F.col(f"{a}.pos"), F.col(f"{b}.nmax") - F.col(f"{b}.pos"))
    return rest * (100 + PERCENT) >= PERCENT * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def boxes_of(placed: DataFrame) -> DataFrame:
    """The bounding box of each leaf."""
    points = placed.groupBy("key", "part", "leaf").agg(F.min("n").alias("n"), F.max("nmax").alias("nmax"), F.min("pos").alias("pos"), F.collect_list("counts").alias("all"))  # LEAF points, about
    corner = F.aggregate(F.slice("all", 2, 1 << 30), F.col("all")[0], lambda s, c: F.zip_with(s, c, lambda x, y: F.greatest(x, y)))
    return points.withColumn("counts", corner).drop("all")


def leaf_pairs(boxes: DataFrame, tasks: int | None = None) -> DataFrame:
    """key, pa, la, pb, lb: pairs of leaves of one key, but of different parts, that may hold similar sets."""
    sizes = stored(boxes.groupBy("key").agg(F.count("*").alias("leaves")).withColumn("m", F.ceil(F.col("leaves") / BLOCK)), tasks=tasks)
    total = sizes.agg(F.sum("leaves")).first()[0] or 0
    dealt = join_counted(boxes, sizes, "key", total, "leaves").withColumn("block", F.pmod(F.xxhash64("part", "leaf"), F.col("m")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1))).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    x, y = dealt.alias("x"), dealt.alias("y")
    met = x.join(y, [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("key", "i", "j")]).filter((F.col("x.i") == F.col("x.j")) | (F.col("x.block") != F.col("y.block")))
    near = met.filter((F.col("x.part") < F.col("y.part")) & similar_sizes("x", "y") & reach("x", "y") & bound("x", "y"))
    return near.select(F.col("x.key").alias("key"), F.col("x.part").alias("pa"), F.col("x.leaf").alias("la"), F.col("y.part").alias("pb"), F.col("y.leaf").alias("lb"))


def hub_pairs(entries: DataFrame, hubs: DataFrame, p: DataFrame) -> DataFrame:
    """a, b: each hub (key, h: doc_id, n, pos) with the entries of its key that it may be similar to."""
    e, h = entries.withColumn("nmax", F.col("n")).alias("e"), hubs.select("key", "h.*").withColumn("nmax", F.col("n")).alias("h")
    met = e.join(h, F.col("e.key") == F.col("h.key")).filter((F.col("e.doc_id") != F.col("h.doc_id")) & similar_sizes("e", "h") & reach("e", "h"))
    star = met.select(F.least("e.doc_id", "h.doc_id").alias("a"), F.greatest("e.doc_id", "h.doc_id").alias("b")).distinct()
    return star.alias("s").join(p.alias("x"), F.col("s.a") == F.col("x.doc_id")).join(p.alias("y"), F.col("s.b") == F.col("y.doc_id")).filter(bound("x", "y")).select("a", "b")


def bitmap(s: np.ndarray) -> bytes:
    """Which of a set's cells hold something: a power of two of them, twice its size or more, told by the low bits."""
    cells = 1 << max(6, (2 * len(s) - 1).bit_length())
    held = np.zeros(cells, np.uint8)
    held[(s & np.uint64(cells - 1)).astype(np.int64)] = 1
    return np.packbits(held).tobytes()


def may_share(x: bytes, nx: int, y: bytes, ny: int) -> bool:
    """Whether two sets of nx and ny may be similar by their bitmaps: in a cell of both at most one shingle is shared, and so many more as either has beyond one."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) != len(b):  # the larger bitmap is folded onto fewer cells
        if len(a) > len(b):
            a = a[: len(a) // 2] | a[len(a) // 2 :]
        else:
            b = b[: len(b) // 2] | b[len(b) // 2 :]
    both, ca, cb = (int(np.bitwise_count(c).sum(dtype=np.int64)) for c in (a & b, a, b))
    return (both + min(nx - ca, ny - cb)) * (100 + PERCENT) >= PERCENT * (nx + ny)


def verified(pairs: DataFrame, docs: DataFrame, chosen: DataFrame, tasks: int | None = None) -> DataFrame:
    """Those of the pairs (a, b) whose sets are similar; sets are made anew, only of documents in a pair that their bitmaps leave."""

    def bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingles(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in found], pa.binary()), pa.array([len(s) for s in found], pa.int64()), pa.array(map(bitmap, found), pa.binary())], ["id", "set_hash", "n", "bits"])

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.select(["a", "b"]).filter(pa.array([may_share(*r) for r in zip(*(b.column(c).to_pylist() for c in ("xa", "na", "xb", "nb")))], pa.bool_()))

    of = made_of(pairs, docs, chosen, bitmaps, "id long, set_hash binary, n long, bits binary", tasks)
    met = pairs.join(of.withColumnsRenamed({"id": "a", "n": "na", "bits": "xa"}), "a").join(of.withColumnsRenamed({"id": "b", "n": "nb", "bits": "xb"}), "b")
    return similar(stored(met.mapInArrow(left, "a long, b long"), tasks=tasks), docs, chosen, tasks)


def made_of(pairs: DataFrame, docs: DataFrame, chosen: DataFrame, make: Callable, schema: str, tasks: int | None = None) -> DataFrame:
    """What make makes of the text of each document in a pair, once for each id; make tells the set's hash, which must be the chosen one."""
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    used = few(stored(chosen.select("doc_id", "set_hash").join(ids, "doc_id", "left_semi"), tasks=tasks))
    found = docs.join(used.select("doc_id"), "doc_id", "left_semi").select("doc_id", "text").mapInArrow(make, schema)
    # shuffled once by id, for both sides of the pairs
    return found.join(used.select(F.col("doc_id").alias("id"), "set_hash"), ["id", "set_hash"], "left_semi").dropDuplicates(["id"]).drop("set_hash")


def similar(pairs: DataFrame, docs: DataFrame, chosen: DataFrame, tasks: int | None = None) -> DataFrame:
    """Those of the pairs (a, b) whose sets are similar, by the sets themselves."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingles(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in found], pa.binary()), pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))], ["id", "set_hash", "s"])

    of = made_of(pairs, docs, chosen, sets, "id long, set_hash binary, s array<long>", tasks)
    both = pairs.join(of.withColumnsRenamed({"id": "a", "s": "sa"}), "a").join(of.withColumnsRenamed({"id": "b", "s": "sb"}), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.filter(common * (100 + PERCENT) >= PERCENT * (F.size("sa") + F.size("sb"))).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keys: int | None = KEYS) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included).

    Texts that are null or hold no word have no shingles and are linked with nothing; texts of any length are cut into shingles
    whole.  A null id is no node: its row has its n_shingles and a null component.  Rows that repeat an id are one node, linked with
    all that is similar to any of their texts.  Other columns, whatever their names, are left out; an empty table gives an
    empty result.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    all_points = stored(points(docs, keys))
    nodes = all_points.filter("n > 0 AND doc_id IS NOT NULL")
    tasks = tasks_for(docs.sparkSession, all_points.count())
    several = nodes.groupBy("doc_id").agg(F.min("set_hash").alias("a"), F.max("set_hash").alias("b")).filter("a <> b")
    found = classes(nodes, docs, tasks) if several.isEmpty() else classes_of_sets(docs, keys, tasks)
    return all_points.select("doc_id", F.col("n").alias("n_shingles")).join(found, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def sets_of(docs: DataFrame) -> DataFrame:
    """doc_id, text, set_hash of each row that has an id and a set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingles(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in found], pa.binary())], ["doc_id", "text", "set_hash"])

    return docs.filter("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(run, "doc_id long, text string, set_hash binary").filter("set_hash IS NOT NULL")


def classes_of_sets(docs: DataFrame, keys: int | None, tasks: int | None = None) -> DataFrame:
    """id and component as classes has them, where ids repeat with several sets: each set of an id is a node of its own, and an id joins the classes of its sets."""
    # one text stands for all rows of an id with the same set
    rows = sets_of(docs).groupBy("doc_id", "set_hash").agg(F.min("text").alias("text")).withColumn("node", F.monotonically_increasing_id())
    rows = stored(rows.select("node", "doc_id", "text"), tasks=tasks)
    texts = rows.select(F.col("node").alias("doc_id"), "text")
    found = classes(stored(points(texts, keys), tasks=tasks), texts, tasks)
    of = stored(rows.select("node", "doc_id").join(found.withColumnRenamed("doc_id", "node"), "node", "left").select("doc_id", F.coalesce("component", "node").alias("class")), tasks=tasks)
    least = stored(of.groupBy("class").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).filter("n > 1"), tasks=tasks)
    links = join_counted(of, least, "class", of.count()).select(F.col("doc_id").alias("a"), F.col("least").alias("b"))
    return components(links, tasks=tasks).withColumnRenamed("id", "doc_id")


def classes(nodes: DataFrame, docs: DataFrame, tasks: int | None = None) -> DataFrame:
    """doc_id, component of each node (as points has them, one set for each id) that is linked; docs: their texts."""
    # equal sets: one document stands for all
    first = F.min(F.struct("doc_id", "n", "keys", "counts")).alias("r")
    alone = stored(nodes.groupBy("set_hash").agg(first, F.count("*").alias("copies")).select("set_hash", "r.*", "copies").withColumn("nmax", F.col("n")), tasks=tasks)
    same = alone.select("set_hash", F.col("doc_id").alias("rep"), F.col("copies").alias("n"))
    number = same.agg(F.sum("n")).first()[0] or 0
    copies = join_counted(nodes.select("doc_id", "set_hash"), same.filter("n > 1"), "set_hash", number).filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    p = alone.drop("keys", "set_hash", "copies")
    # the smallest hashes have place 0, which excludes nothing
    entries = alone.select("doc_id", "n", F.lit(0).alias("pos"), F.explode("keys").alias("key"))
    common = stored(entries.groupBy("key").agg(F.count("*").alias("count")).filter(F.col("count") > COMMON).select("key"), tasks=tasks)
    wide = stored(entries.join(common, "key").select("doc_id").distinct(), tasks=tasks)
    if not wide.isEmpty():
        texts = docs.join(few(wide), "doc_id", "left_semi")
        entries = stored(entries.join(common, "key", "left_anti").unionByName(rare_keys(texts).select("doc_id", "n", "pos", "key")), tasks=tasks)
    # most keys are of one document; an entry that is both a small hash and in a whole prefix has the lesser place
    shared = stored(entries.groupBy("key").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last")).filter("least < last").select("key"), tasks=tasks)
    entries = stored(entries.join(shared, "key", "left_semi").groupBy("doc_id", "key").agg(F.min("pos").alias("pos"), F.min("n").alias("n")), tasks=tasks)
    hubs = stored(entries.groupBy("key").agg(F.min(F.struct("doc_id", "n", "pos")).alias("h")), tasks=tasks)
    links = stored(verified(stored(hub_pairs(entries, hubs, p), tasks=tasks), docs, alone, tasks), tasks=tasks)
    for turn in range(HUBS + 1):
        # what hangs together by now, under keys that still hold several parts
        parts = components(links, tasks=tasks)
        known = entries.join(parts.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("key", "doc_id", "n", "pos", F.coalesce("component", "doc_id").alias("part"))
        sizes = stored(known.groupBy("key", "part").agg(F.count("*").alias("size"), F.min(F.struct(F.xxhash64("doc_id", "key", F.lit(turn)).alias("draw"), "doc_id", "n", "pos")).alias("h")), tasks=tasks)
        several = stored(sizes.groupBy("key").agg(F.count("*").alias("parts"), F.min("h").alias("h")).filter("parts > 1"), tasks=tasks)
        known = stored(known.join(several.select("key"), "key", "left_semi"), tasks=tasks)
        crowded = several.filter(F.col("parts") > PARTS).select("key", "h")
        if turn == HUBS or crowded.isEmpty():
            break
        met = known.join(crowded.select("key"), "key", "left_semi").drop("part")
        links = stored(links.unionByName(verified(stored(hub_pairs(met, crowded, p), tasks=tasks), docs, alone, tasks)).distinct(), tasks=tasks)
    sizes = sizes.join(several.select("key"), "key", "left_semi").select("key", "part", "size")
    # leaves: points under a key that hang together by now
    placed = known.join(sizes, ["key", "part"]).withColumn("leaf", F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("size") / LEAF)))
    placed = stored(placed.drop("n").join(p, "doc_id").select("key", "part", "leaf", "doc_id", "n", "nmax", "pos", "counts"), tasks=tasks)
    boxes = stored(boxes_of(placed), tasks=tasks)
    leaves = leaf_pairs(boxes, tasks)
    u, v = placed.alias("u"), placed.alias("v")
    near = leaves.alias("l").join(u, (F.col("u.key") == F.col("l.key")) & (F.col("u.part") == F.col("pa")) & (F.col("u.leaf") == F.col("la"))).join(v, (F.col("v.key") == F.col("l.key")) & (F.col("v.part") == F.col("pb")) & (F.col("v.leaf") == F.col("lb")) & similar_sizes("u", "v") & reach("u", "v") & bound("u", "v"))
    rest = stored(near.select(F.least("u.doc_id", "v.doc_id").alias("a"), F.greatest("u.doc_id", "v.doc_id").alias("b")).distinct(), tasks=tasks)
    links = links.unionByName(verified(rest, docs, alone, tasks)).unionByName(copies)
    return components(links, tasks=tasks).withColumnRenamed("id", "doc_id")
