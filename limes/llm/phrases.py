"""Phrases that are more than their words: collocations of two and three words, by stripes.

A stripe is an associative counter under a prefix: under a first word it holds each second word, and under that each third word, with
how often they follow.  Everything is read off this one structure: a phrase's extensions are a stripe's entries, its own count is
their total (with those that end a piece), and the largest entry tells whether a longer phrase subsumes it.

A task counts a chunk of words at a time and writes its stripes in blocks, a block for each bucket; a bucket's blocks meet in one
task, which merges them elementwise.  Buckets go by a hash of the first two words, so a frequent word's stripe lies in many of them,
and their number follows the corpus, so that a bucket's size doesn't.  A first word's total is a counter of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from limes.llm.common import columns, few, join_counted, stored

#: Characters of text that a task counts at once.
CHUNK_CHARS = 6_000_000
#: There are LEAST_BUCKETS buckets, and one more for each BUCKET_CHARS characters of the corpus.
LEAST_BUCKETS, BUCKET_CHARS = 64, 8_000_000
#: Parts in which a language's phrases are ranked before the best of each part meet.
RANK_PARTS = 64
#: What stands in the place of a second or third word where a piece ends or a total is meant; pieces end at line feeds, so no word is it.
END = "\n"
COUNTED = "lang string, w1 string, w2 string, w3 string, f long, l long, ext long"


def starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of sorted keys begins."""
    return np.flatnonzero(np.append(True, np.logical_or.reduce([k[1:] != k[:-1] for k in keys]))) if len(keys[0]) else np.zeros(0, np.int64)


def encoded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words as numbers in their order, and the words of the numbers."""
    words = words.dictionary_encode()
    order = pc.array_sort_indices(words.dictionary)
    place = np.empty(len(order), np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    return place[words.indices.to_numpy()], words.dictionary.take(order)


class Stripes:
    """Counters sorted by language, first, second and third word, each combination once; a first word's total has END twice."""

    def __init__(self, langs: pa.Array, words: pa.Array, lang: np.ndarray, w1: np.ndarray, w2: np.ndarray, w3: np.ndarray, n: np.ndarray):
        self.langs, self.words = langs, words
        order = np.lexsort((w2 * len(words) + w3, lang * len(words) + w1))
        columns = [x[order] for x in (lang, w1, w2, w3)]
        at = starts(*columns)
        self.lang, self.w1, self.w2, self.w3 = (x[at] for x in columns)
        self.n = np.add.reduceat(n[order], at) if len(at) else n[:0]

    def blocks(self, buckets: int) -> Iterator[tuple[int, bytes]]:
        """The counters of each bucket, as compressed columns of text."""
        of = lambda words: np.fromiter((zlib.crc32(w.encode()) for w in words.to_pylist()), np.uint64, len(words))
        word = of(self.words)
        h = (of(self.langs)[self.lang] * np.uint64(31) + word[self.w1]) * np.uint64(0x9E3779B97F4A7C15) + word[self.w2]
        bucket = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        at = np.append(starts(bucket), len(bucket)).astype(np.int32)
        names = [v.take(pa.array(x[order])) for v, x in ((self.langs, self.lang), (self.words, self.w1), (self.words, self.w2), (self.words, self.w3))]
        texts = [pc.binary_join(pa.ListArray.from_arrays(pa.array(at), v), " ").to_pylist() for v in (*names, pa.array(self.n[order]).cast(pa.string()))]
        for b, *block in zip(bucket[at[:-1]].tolist(), *texts):
            yield b, pa.compress("\t".join(block).encode(), codec="zstd", asbytes=True)

    def read_off(self, least: int) -> Iterator[pa.RecordBatch]:
        """What occurs `least` times: words, pairs with their largest extension, triples with their first pair's total; and the sum of each language's words."""
        end = pc.index(self.words, END).as_py()
        langs, total = starts(self.lang), np.where(self.w2 == end, self.n, 0)
        one = np.flatnonzero((self.w2 == end) & (self.n >= least))
        two = starts(self.lang, self.w1, self.w2)
        f2 = np.add.reduceat(self.n, two)
        longest = np.maximum.reduceat(np.where(self.w3 == end, 0, self.n), two)
        left = np.repeat(f2, np.diff(np.append(two, len(self.n))))
        pair = (self.w2[two] != end) & (f2 >= least)
        triple = np.flatnonzero((self.w2 != end) & (self.w3 != end) & (self.n >= least))
        for rows, f, l, ext, size in ((langs, np.add.reduceat(total, langs), None, None, 0), (one, self.n[one], None, None, 1), (two[pair], f2[pair], None, longest[pair], 2), (triple, self.n[triple], left[triple], None, 3)):
            for k in range(0, len(rows), 50_000):
                at, cut = rows[k : k + 50_000], slice(k, k + 50_000)
                word = lambda x, known: self.words.take(pa.array(x[at])) if known else pa.nulls(len(at), self.words.type)
                number = lambda x: pa.nulls(len(at), pa.int64()) if x is None else pa.array(x[cut])
                yield pa.RecordBatch.from_arrays([self.langs.take(pa.array(self.lang[at])), word(self.w1, size > 0), word(self.w2, size > 1), word(self.w3, size > 2), number(f), number(l), number(ext)], names=["lang", "w1", "w2", "w3", "f", "l", "ext"])


def counted(langs: pa.Array, texts: pa.Array) -> Stripes:
    """The stripes of some texts, none of them null."""
    texts = pc.replace_substring_regex(pc.ascii_lower(texts), r"[.,;:!?\x0A-\x0D]", f" {END} ")
    texts = pc.binary_join_element_wise(pc.replace_substring(texts, "\t", " "), pa.scalar(END, texts.type), pa.scalar(" ", texts.type))
    split = pc.split_pattern(texts, " ")
    code, words = encoded(split.flatten())
    lang, langs = encoded(langs)
    lang = np.repeat(lang, pc.list_value_length(split).to_numpy())
    full = code != pc.index(words, "").as_py()
    code, lang = code[full], lang[full]
    end = pc.index(words, END).as_py()
    second, third = np.append(code[1:], end), np.append(code[2:], [end, end])[: len(code)]
    word, pair = code != end, (code != end) & (second != end)
    both = lambda x, y: np.concatenate([x[pair], y])
    n, ends = int(word.sum()), np.full(int(word.sum()), end)
    return Stripes(langs, words, both(lang, lang[word]), both(code, code[word]), both(second, ends), both(third, ends), np.ones(n + int(pair.sum()), np.int64))


def merged(blocks: list[bytes]) -> Stripes:
    """The stripes of some blocks added up elementwise."""
    columns = zip(*(text.split("\t") for text in map(decompressed, blocks)))
    lang, w1, w2, w3, n = (pc.split_pattern(pa.array([" ".join(c)], pa.large_string()), " ").flatten().cast(pa.string()) for c in columns)
    code, words = encoded(pa.concat_arrays([w1, w2, w3, pa.array([END])]))
    lang, langs = encoded(lang)
    return Stripes(langs, words, lang, *np.split(code[:-1], 3), n.cast(pa.int64()).to_numpy())


def decompressed(block: bytes) -> str:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(block).decode()


def count_stripes(docs: DataFrame, buckets: int) -> DataFrame:
    """bucket, block: the stripes of each task's chunks of texts (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def chunk() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held).combine_chunks()
            found = list(counted(t.column(0).chunk(0), t.column(1).chunk(0)).blocks(buckets))
            for k in range(0, len(found), 256):
                b, block = zip(*found[k : k + 256])
                yield pa.RecordBatch.from_arrays([pa.array(b, pa.int64()), pa.array(block, pa.binary())], names=["bucket", "block"])

        for b in batches:
            for k in range(0, b.num_rows, 64):  # a few texts at a time, for some are long
                held.append(b.slice(k, 64))
                size += pc.sum(pc.binary_length(held[-1].column(1))).as_py()
                if size >= CHUNK_CHARS:
                    yield from chunk()
                    held, size = [], 0
        if held:
            yield from chunk()

    return docs.select("lang", "text").mapInArrow(run, "bucket long, block binary")


def merge_stripes(blocks: DataFrame, least: int) -> DataFrame:
    """What read_off finds in all stripes; a task holds a bucket at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of = [], None
        for b in batches:
            for bucket, block in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if bucket != of and held:
                    yield from merged(held).read_off(least)
                    held = []
                of = bucket
                held.append(block)
        if held:
            yield from merged(held).read_off(least)

    return blocks.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, COUNTED)


def collocations(docs: DataFrame, top: int = 2000, least: int = 10, subsumed: int = 50) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases of two or three words.

    Words are what stands between spaces and tabs of a piece, with A-Z in lower case; pieces end at . , ; : ! ? and at line ends.
    a is how often a phrase occurs, l and r how often the parts of its weakest cut do, n how many words the language has, and
    score is 1000000 a^2 / (l r), rounded down.  A phrase that occurs fewer than `least` times is none; one of two words is dropped
    if one of three words that holds it has `subsumed` hundredths of its occurrences.
    A null text is empty, a null lang is `und`; empty tables give no rows; repeated rows count each time; other columns are left out.
    Equal scores go by a, then by the phrase's bytes.  Counts up to 10^15 are exact; beyond, Spark raises an error.
    """
    docs = columns(docs, lang="string", text="string").select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    chars = docs.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    found = stored(merge_stripes(count_stripes(docs, LEAST_BUCKETS + chars // BUCKET_CHARS), least))
    totals = stored(found.filter("w1 IS NULL").groupBy("lang").agg(F.sum("f").alias("n")))
    words = stored(found.filter("w1 IS NOT NULL AND w2 IS NULL").select("lang", "w1", "f"))
    n = totals.agg(F.sum("n")).first()[0] or 0
    pairs = found.filter("w2 IS NOT NULL AND w3 IS NULL").select("lang", "w1", "w2", "f", "ext")
    triples = found.filter("w3 IS NOT NULL").select("lang", "w1", "w2", "w3", "f", "l")
    word = lambda rows, at, name: join_counted(rows, words.select("lang", F.col("w1").alias(at), F.col("f").alias(name)), ["lang", at], n, name)
    score = lambda l, r: F.expr(f"(CAST(f AS DECIMAL(15,0)) * CAST(f AS DECIMAL(15,0)) * 1000000) DIV (CAST({l} AS DECIMAL(15,0)) * CAST({r} AS DECIMAL(15,0)))")
    before = triples.groupBy("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("f").alias("before"))
    longer = F.greatest(F.when(F.col("ext") >= least, F.col("ext")).otherwise(0), F.coalesce("before", F.lit(0)))
    two = pairs.join(before, ["lang", "w1", "w2"], "left").filter(longer * 100 < F.col("f") * subsumed)
    two = word(word(two, "w1", "l"), "w2", "r").select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("f").alias("a"), "l", "r", score("l", "r").alias("score"))
    three = triples.join(pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f").alias("r1")), ["lang", "w2", "w3"])
    three = word(word(three, "w1", "l1"), "w3", "r2").withColumns({"s1": score("l1", "r1"), "s2": score("l", "r2")})
    first = F.col("s1") <= F.col("s2")
    pick = lambda a, b: F.when(first, F.col(a)).otherwise(F.col(b))
    three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("f").alias("a"), pick("l1", "l").alias("l"), pick("r1", "r2").alias("r"), pick("s1", "s2").alias("score"))
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = two.unionByName(three).withColumn("part", F.pmod(F.hash("phrase"), F.lit(RANK_PARTS)))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return best.join(few(totals), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
