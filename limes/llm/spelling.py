"""Spelling variants: words that differ by one code point, by partition-and-enumerate signatures.

A word's letters are a set of (letter, its how-manieth) elements, a binary vector.  One replaced letter changes two elements, one
inserted or deleted letter changes one.  Elements are dealt into PARTITIONS by a hash; whatever two partitions hold the changed
elements, all others agree.  So words of equal length meet by a signature for each pair of partitions that is left out, and words whose
lengths differ by one by a signature for each single partition left out.  Words of the same letters in another order would meet too; as
one edit leaves the first or the last half of the shorter word alone, a signature also holds one of these halves.  Equal signatures
are joined and each pair is verified by its edit distance, so nothing is lost and nothing wrong is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limes.llm.common import SMALL_ROWS, columns, few, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Into how many partitions a word's elements are dealt.
PARTITIONS = 5


def words(docs: DataFrame, shortest: int = 5, least: int = 3, typo: int = 97) -> DataFrame:
    """word, n of the words of at least `shortest` code points with `least` occurrences; where `typo` divides the checksum of document and word, a letter is deleted."""
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit("[a-zÀ-ÿ]+"), F.lit(0))
    rows = docs.select("doc_id", F.explode(runs).alias("run")).filter(F.length("run") >= shortest)
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    found = rows.withColumn("h", h).select(F.when(F.col("h") % typo == 0, less).otherwise(F.col("run")).alias("word"))
    return found.filter(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def mixed(x: np.ndarray) -> np.ndarray:
    """Numbers spread over 64 bits."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signatures(found: list[str], partitions: int = PARTITIONS) -> tuple[np.ndarray, np.ndarray]:
    """Each signature and the number of its word; those for words of equal length are even, those for lengths that differ are odd.

    Hashes are sums over elements, so leaving partitions out is a subtraction.  Different signatures may have the same hash, which
    adds a pair to verify and loses none.
    """
    size = np.fromiter(map(len, found), np.int64, len(found))
    letter = np.frombuffer("".join(found).encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(found)), size)
    first = np.cumsum(size) - size
    place = np.arange(len(letter)) - first[owner]
    order = np.lexsort((letter, owner))
    same = np.append(False, (letter[order][1:] == letter[order][:-1]) & (owner[order][1:] == owner[order][:-1]))
    run = np.arange(len(order)) - np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    nth = np.empty(len(order), np.int64)
    nth[order] = run
    element = mixed(letter | (nth.astype(np.uint64) << np.uint64(21)))
    part = (element >> np.uint64(40)) % np.uint64(partitions)
    held = np.stack([np.add.reduceat(np.where(part == p, element, np.uint64(0)), first) for p in range(partitions)])
    whole = held.sum(0, dtype=np.uint64)
    ahead = mixed(letter | (place.astype(np.uint64) << np.uint64(24)) | np.uint64(1 << 63))
    behind = mixed(letter | ((size[owner] - place).astype(np.uint64) << np.uint64(24)) | np.uint64(1 << 62))

    def halves(shorter: np.ndarray) -> list[np.ndarray]:
        """Hashes of the first and of the last half (of the shorter word) of each word."""
        h = (shorter // 2)[owner]
        return [np.add.reduceat(np.where(place < h, ahead, np.uint64(0)), first), np.add.reduceat(np.where(size[owner] - place <= h, behind, np.uint64(0)), first)]

    out = []
    for left_out, lengths, odd in [(ex, size, 0) for ex in combinations(range(partitions), 2)] + [((p,), m, 1) for p in range(partitions) for m in (size, size - 1)]:
        base = mixed(whole - held[list(left_out)].sum(0, dtype=np.uint64) + mixed(lengths.astype(np.uint64) * np.uint64(1 << 20) + np.uint64(sum((x + 1) << (6 * k) for k, x in enumerate(left_out)))))
        for half in halves(lengths):
            out.append((mixed(base + half) & ~np.uint64(1)) | np.uint64(odd))
    return np.concatenate(out), np.tile(np.arange(len(found)), len(out))


def near_words(counted: DataFrame) -> DataFrame:
    """a, b (a before b) of the words (column word) that differ by exactly one inserted, deleted or replaced code point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                sig, at = signatures(b.column(0).to_pylist())
                order = np.argsort(at, kind="stable")
                for k in range(0, len(order), 50_000):
                    o = order[k : k + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array(sig[o].view(np.int64)), b.column(0).take(pa.array(at[o]))], names=["sig", "word"])

    tasks = 4 * counted.sparkSession.sparkContext.defaultParallelism  # few bytes, but many signatures
    rows = counted.select("word").repartition(tasks, "word").mapInArrow(run, "sig long, word string")
    a, b = rows.withColumnRenamed("word", "a"), rows.withColumnRenamed("word", "b")
    equal = F.length("a") == F.length("b")
    near = (F.col("a") < F.col("b")) & (equal == (F.col("sig") % 2 == 0)) & (F.levenshtein("a", "b", 1) == 1)
    # each word has forty rows, but Spark takes them for as large as the words and would broadcast them
    return a.join(b.hint("merge"), "sig").filter(near).select("a", "b").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of each chain of forms (word, form); chains are followed in steps that double."""
    links = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = few(links.select(F.col("word").alias("root"), F.col("root").alias("further")))
        new = stored(links.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        links = new.select("word", "root")
        if new.filter("moved").isEmpty():
            return links


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n: the words of all texts with the spelling that each is a variant of.

    Words are runs of letters of a text with A-Z in lower case (see words).  A word's form is its near word of largest n (of equal ones
    the first in code-point order) if that is at least twice the word's own n, else null; root is where following forms ends.
    A null text has no words, a null doc_id is empty in the checksum; repeated rows count each time; empty tables give no rows.
    """
    docs = columns(docs, doc_id="string", text="string")
    found = stored(words(docs))
    pairs = stored(near_words(found))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = found.select(F.col("word").alias("b"), "n")
    both = both.join(F.broadcast(counts) if found.count() <= SMALL_ROWS else counts, "b")
    near = both.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "b")).alias("best"))
    out = found.join(near, "word", "left").withColumn("strong", -F.col("best.less") >= 2 * F.col("n"))
    out = stored(out.select("word", F.when(F.col("strong"), F.col("best.b")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("strong"), -F.col("best.less")).alias("form_n")))
    ends = roots(out.filter("form IS NOT NULL"))
    return out.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
