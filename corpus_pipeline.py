"""A training corpus from raw documents: toxicity, shared lines, near duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of docs.  Null and empty texts and null ids are
kept by every stage but where the stage says otherwise; rows that repeat an id are judged one by one; columns that a stage does
not name pass unchanged; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limes.llm import jaccard, linededup, packing, pii, toxicity
from limes.llm.common import cut, few, stored, table, tasks_for
from limes.llm.queries import pieces


def recounted(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs from out, whose texts have changed; n_chars, if there is one, counts the new text."""
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))
    return out.select([f"`{c}`" for c in docs.columns])


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that score under 0.5; each row is judged by its own text, so a row without an id or with a repeated one takes no other along."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.with_scores(docs.select(F.struct("*").alias("row"), "text"), model)
    return scored.filter("score < 0.5").select("row.*")


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that three sites or more share, but for the first occurrence; a text may become empty."""
    return recounted(linededup.remove_boilerplate(docs), docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that hang together by similar word 5-grams, the one with the smallest id; of rows with one id and text, one.

    Rows without an id or without words are in no group and stay.
    """
    found = cut(jaccard.near_duplicates(docs))
    tasks = tasks_for(spark, found.count())
    gone = stored(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("id")).distinct(), tasks=tasks)
    kept = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), "text").join(few(gone), "id", "left_anti")
    repeated = stored(found.filter("doc_id IS NOT NULL AND n_shingles > 0").groupBy(F.col("doc_id").alias("id")).agg(F.count("*").alias("n")).filter("n > 1").select("id"), tasks=tasks)
    if repeated.isEmpty():
        return kept.select("row.*")
    several = kept.join(few(repeated), "id", "left_semi").dropDuplicates(["id", "text"])
    return kept.join(few(repeated), "id", "left_anti").unionByName(several).select("row.*")


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the kind of datum in place of each datum."""
    return recounted(pii.redact(docs), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences."""
    return packing.pack(pieces(docs))


STAGES = [("toxicity", without_toxic), ("line dedup", without_shared_lines), ("n-gram Jaccard join", without_near_copies), ("PII", without_personal_data), ("best-fit packing", packed)]

#: The first stage is a learned model, which SQL can't express; tests/llm/test_pipeline.py holds each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs)
    return docs
