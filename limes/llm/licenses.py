"""Operator 7 [native]: licence scans over a positional index of rare licence words.

Templates are word sequences, given as a table.  One pass over the texts lists the licence words of each document with their
places.  The inverse document frequency of these words is counted over all documents; a template is proposed where the
rarest word of its key phrase stands: at i, with template place j, it would start at i - j.  The places of the document's other
licence words are intersected with the template's postings, and a proposal stands if its key phrase agrees.  The share of
the other words that agree counts for the score alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from limes.llm.common import columns, prepare, stored

#: Phrases and their labels; "base" ones count as places. Fixed values.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Further templates: words in order, the label and the key phrase that must agree.
MORE = {
    "licensed under the apache license version 2 0": ("apache-2", "apache license version 2"),
    "released under the mit license": ("mit", "mit license"),
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", "permission is hereby granted free of charge"),
    "this work is licensed under the gnu general public license version 3": ("gpl-3", "gnu general public license version 3"),
    "gnu lesser general public license": ("lgpl", "gnu lesser general public license"),
    "gnu affero general public license": ("agpl", "gnu affero general public license"),
    "redistribution and use in source and binary forms with or without modification": ("bsd", "redistribution and use in source and binary forms"),
    "mozilla public license version 2 0": ("mpl-2", "mozilla public license"),
    "licensed under cc by sa": ("cc-by-sa", "cc by sa"),
    "licensed under cc by nc 4 0": ("cc-by-nc", "cc by nc"),
    "all rights reserved": ("proprietary", "all rights reserved"),
}
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The only two characters outside ASCII whose lower case holds an ASCII letter.
ODD = "[İK]"


def words(text: Column) -> Column:
    """Lower-case words of a text; only A-Z change case as far as ASCII words are concerned."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    low = F.when(text.rlike(ODD), F.translate(text, upper, upper.lower())).otherwise(F.lower(text))
    return F.array_remove(F.split(low, NOT_WORD), "")


def templates(spark: SparkSession) -> DataFrame:
    """phrase, label, kind ("base" or "more") and key phrase of the templates above; scan takes any table of this form."""
    rows = [(p, label, "base", p) for p, label in BASE.items()] + [(p, label, "more", key) for p, (label, key) in MORE.items()]
    return spark.createDataFrame(rows, "phrase string, label string, kind string, key string")


def rarity(seen: DataFrame) -> dict[str, int]:
    """Number of documents that hold each licence word, by their lists of them; a row for each licence word reaches the driver."""
    return {r.word: r.n for r in seen.select(F.explode("seen").alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}


def licence_words(rows: DataFrame, known: list[tuple[str, str, str, str]]) -> DataFrame:
    """doc_id, h (text's hash), n_words, seen (different licence words), hits (licence words with their places) of each row.

    hits is null unless the document holds all words of some key phrase, without which no template stands in it.
    """
    vocabulary = sorted({w for p, *_ in known for w in p.split()})
    keys = sorted({tuple(sorted(set(key.split()))) for *_, key in known})
    split = rows.select("doc_id", F.xxhash64("text").alias("h"), words(F.col("text")).alias("words"))
    at = F.filter(F.transform("words", lambda w, i: F.when(w.isin(vocabulary), F.struct(w.alias("word"), i.alias("pos")))), lambda x: x.isNotNull())
    found = split.select("doc_id", "h", F.size("words").cast("long").alias("n_words"), at.alias("hits")).withColumn("seen", F.array_distinct("hits.word"))
    whole = F.exists(F.array(*[F.array(*map(F.lit, k)) for k in keys]), lambda k: F.size(F.array_except(k, F.col("seen"))) == 0)
    return found.select("doc_id", "h", "n_words", "seen", F.when(whole, F.col("hits")).alias("hits"))


def scan(docs: DataFrame, table: DataFrame | None = None) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    table: the templates (phrase, label, kind, key), lower-case words with blanks between, the key phrase a part of the phrase; it is
    collected and broadcast, so it is a list of licences, not a corpus.  Null texts count as empty, texts of any length are scanned whole.
    Rows that repeat an id are told by their texts: repeated rows get equal results.  Other columns, whatever their
    names, are left out; an empty table gives an empty result.
    score: the largest share of a template's words that agree at one start, 0 without a template.
    """
    spark = prepare(docs.sparkSession)
    known = [(r.phrase, r.label, r.kind, r.key) for r in (templates(spark) if table is None else table).select("phrase", "label", "kind", "key").collect()]
    rows = columns(docs, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    held = stored(licence_words(rows, known))
    count = rarity(held)
    postings, facts = [], []
    for k, (phrase, label, kind, key) in enumerate(known):
        ws, ks = phrase.split(), key.split()
        begin = next(j for j in range(len(ws)) if ws[j : j + len(ks)] == ks)
        rarest = min(range(begin, begin + len(ks)), key=lambda j: (count.get(ws[j], 0), j))
        postings += [(k, w, j, begin <= j < begin + len(ks), j == rarest) for j, w in enumerate(ws)]
        facts.append((k, label, kind, len(ws), len(ks)))
    index = F.broadcast(spark.createDataFrame(postings, "template int, word string, place int, in_key boolean, rarest boolean"))
    facts = F.broadcast(spark.createDataFrame(facts, "template int, label string, kind string, size int, key_size int"))
    found = held.filter("hits IS NOT NULL").select("doc_id", "h", F.explode("hits").alias("x")).select("doc_id", "h", "x.word", "x.pos")
    # the rarest word of a key phrase proposes where a template starts; a proposal stands if its key phrase agrees
    starts = found.join(index, "word").withColumn("start", F.col("pos") - F.col("place")).groupBy("doc_id", "h", "template", "start").agg(
        F.bool_or("rarest").alias("proposed"), F.size(F.collect_set("place")).alias("n"), F.size(F.collect_set(F.when(F.col("in_key"), F.col("place")))).alias("n_key")
    )
    agreed = starts.filter("proposed").join(facts, "template").filter("n_key = key_size")
    base = F.col("kind") == "base"
    per_doc = agreed.groupBy("doc_id", "h").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        F.array_sort(F.collect_set(F.when(base, F.col("label")))).alias("b"),
        F.array_sort(F.collect_set("label")).alias("l"),
        F.max(F.col("n") / F.col("size")).alias("score"),
    )
    out = held.select(F.col("doc_id").alias("id"), F.col("h").alias("text_hash"), "n_words").join(per_doc, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("text_hash") == F.col("h")), "left")
    return out.select(
        F.col("id").alias("doc_id"), "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.coalesce(F.array_join("b", ","), F.lit("")).alias("base_labels"), F.coalesce(F.array_join("l", ","), F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
