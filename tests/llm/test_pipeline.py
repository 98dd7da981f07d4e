"""Each stage of the pipeline against a plain version of it."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from limes.llm import pii, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "row", "score"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with toxic ones, shared lines, near copies and personal data, and ids that are null or repeated."""
    rng, rows = random.Random(21), []
    words = ["".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randint(3, 8))) for _ in range(400)]
    for k in range(400):
        w = [rng.choice(words) for _ in range(80)]
        if k % 5 == 0:
            w[10:13] = ["vilefoo", "crudbar", "vilefoo"]
        text = " ".join(w)
        if k % 7 == 0:
            text = f"read our terms of use\n{text}\nall about cookies here"
        if k % 11 == 0:
            text += f" write to user{k}@mail.org"
        if k % 13 == 1 and rows:
            text = rows[-1][1].replace(words[0], words[1], 1)
        rows.append((k, text, "en", f"s{k % 6}"))
    plain = next(t for k, t, *_ in rows if "vilefoo" not in t and k % 7)
    rows += [(None, "vilefoo crudbar vilefoo crudbar", "en", "s1"), (None, plain + " clean", "en", "s2"), (900, None, "en", "s1"), (901, "", "en", None), (902, plain + " end", "en", "s1"), (902, plain + " end", "en", "s1"), (903, "another text", "en", "s1")]
    path = tmp_path_factory.mktemp("corpus")
    docs = spark.createDataFrame([(*r, len(r[1] or ""), 3, 0.25) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, row int, score double")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(400)], "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def stage(spark, folder, k, docs):
    out = pipeline.STAGES[k][1](spark, spark.createDataFrame(docs, spark.read.parquet(f"{folder}/documents.parquet").schema), folder)
    assert k == 4 or out.columns == COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_stages(spark, folder):
    docs = sorted((tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()), key=str)

    model = toxicity.fit(spark.createDataFrame(docs, spark.read.parquet(f"{folder}/documents.parquet").schema), spark.read.parquet(f"{folder}/labels.parquet"))
    z = [toxicity.signs(*(np.array(x[k]) for k in ("total", "most", "mean"))) @ model.scale for x in (toxicity.score_batch(model, [d[1]]) for d in docs)]
    kept = stage(spark, folder, 0, docs)
    assert kept == [d for d, x in zip(docs, z) if x[0] < 0]
    assert {d[0] for d in docs if d[0] is not None and d[0] < 400 and d[0] % 5} - {d[0] for d in kept} <= {d[0] for d in docs if d[1] and "vilefoo" in d[1]}
    assert [d[0] for d in kept].count(None) == 1 and [d[0] for d in kept].count(902) == 2

    sites = {}
    for d in kept:
        for line in (d[1] or "").split("\n") if d[0] is not None else []:
            sites.setdefault(line.strip(" "), set()).add(d[3] or "")
    seen, freed = {}, []
    for d in sorted(kept, key=lambda d: (d[0] is None, d[0])):
        lines = (d[1] or "").split("\n")
        gone = [p for p, line in enumerate(lines) if d[0] is not None and line.strip(" ") and len(sites[line.strip(" ")]) >= 3 and seen.setdefault(line.strip(" "), (d[0], p)) != (d[0], p)]
        text = "\n".join(line for p, line in enumerate(lines) if p not in gone) if gone else d[1]
        freed.append((*d[:1], text, *d[2:4], len(text or ""), *d[5:]))
    assert any("terms of use" in (d[1] or "") for d in freed) and stage(spark, folder, 1, kept) == sorted(freed, key=str)

    sets = {}
    for d in freed:
        w = (d[1] or "").lower().split()
        if d[0] is not None and w:
            sets.setdefault(d[0], []).append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    part = {k: k for k in sets}
    links = [(a, b) for a in sets for b in sets if a < b and any(100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b])]
    for _ in range(20):
        for a, b in links:
            part[a] = part[b] = min(part[a], part[b])
    alone, once = [], set()
    for d in freed:
        if part.get(d[0], d[0]) == d[0] and not (d[0] is not None and d[1] and (d[0], d[1]) in once):
            alone.append(d)
            once.add((d[0], d[1]))
    assert links and stage(spark, folder, 2, freed) == sorted(alone, key=str)

    bare = []
    for d in alone:
        text = d[1] if d[1] is None else pii.redacted(d[1], sum(pii.spans(d[1]), []))
        bare.append((*d[:1], text, *d[2:4], len(text or ""), *d[5:]))
    assert any("[EMAIL]" in (d[1] or "") for d in bare) and stage(spark, folder, 3, alone) == sorted(bare, key=str)

    placed = pipeline.packed(spark, spark.createDataFrame(bare, spark.read.parquet(f"{folder}/documents.parquet").schema), folder)
    per = placed.groupBy("sequence_id").agg(F.sum("length").alias("all"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert per.filter("all > 1024 OR all <> end").count() == 0 and placed.filter("piece = 0").count() == len(bare)


def test_empty_table(spark, folder):
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, f in pipeline.STAGES:
        assert f(spark, empty, folder).count() == 0, name
