"""Inputs that once gave wrong results."""

import numpy as np

import pytest

import corpus_pipeline
from limes.llm import embeddings, linededup, neighbours, pii


def test_neighbours_far_from_the_origin(spark):
    """Vectors whose differences are small beside their components."""
    rng = np.random.default_rng(3)
    for m in (1000 + rng.standard_normal((1500, 32)) * 0.05, np.concatenate([c + rng.standard_normal((700, 16)) * 1e-6 for c in (-50.0, 50.0)])):
        rows = [(k, v.tolist()) for k, v in enumerate(m)]
        found = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
        hits = 0
        for q in range(0, len(m), 100):
            d = np.sqrt(((m - m[q]) ** 2).sum(1))
            d[q] = np.inf
            hits += len({r.vec_id for r in found if r.query_id == q} & set(np.lexsort((np.arange(len(m)), d))[:10].tolist()))
        assert hits >= 0.9 * 10 * len(range(0, len(m), 100))


def test_cosines_of_very_large_and_small_vectors(spark):
    rows = [(1, [1e-200, 1e-200]), (2, [1e-170, 1e-200]), (3, [1e200, 1e200]), (4, [1e200, 1.1e200]), (5, [1e-200, 1.1e-200])]
    found = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, label int")).collect()}
    assert found == {1: (3, 1), 2: (0, 2), 3: (3, 1), 4: (3, 1), 5: (3, 1)}


def test_columns_with_the_names_of_helpers(spark):
    extra = ("__id", "__th", "__gone", "id", "th", "gone", "row", "key", "site")
    rows = [(k, f"same line\nown line {k} with words enough to be told apart from all others", f"s{k}", *[k] * len(extra)) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{c} int" for c in extra))
    out = linededup.remove_boilerplate(docs)
    assert out.columns == [*docs.columns, "n_removed"]
    assert sorted((r.doc_id, r.n_removed, r["row"], r["__id"]) for r in out.collect()) == [(0, 0, 0, 0), (1, 1, 1, 1), (2, 1, 2, 2), (3, 1, 3, 3)]
    copies = docs.unionByName(docs.filter("doc_id = 2"))
    kept = corpus_pipeline.without_near_copies(spark, copies, "")
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 3]
    assert linededup.remove_boilerplate(docs.limit(0)).columns == [*docs.columns, "n_removed"]


@pytest.mark.parametrize(
    "text, kind, part",
    [
        ("call plus four nine one five one two three four five six seven now", "phone", "plus four nine one five one two three four five six seven"),
        ("write john @ example . com or", "email", "john @ example . com"),
        ("tel. +1 (2O2) 555-O1O4 today", "phone", "+1 (2O2) 555-O1O4"),
        ("see john&#64;example.com, or", "email", "john&#64;example.com"),
        ("see john&commat;example&#x2E;com, or", "email", "john&commat;example&#x2E;com"),
        ("see john\u200bdoe@example.com, or", "email", "john\u200bdoe@example.com"),
        ("see jo\u00adhn@exam\u200b\u200dple.com, or", "email", "jo\u00adhn@exam\u200b\u200dple.com"),
        ("host l92.l68.0.l up", "ip", "l92.l68.0.l"),
    ],
)
def test_more_disguises(text, kind, part):
    base, added = pii.spans(text)
    a = text.index(part)
    assert (kind, a, a + len(part)) in added
    assert pii.redacted(text, base + added) == text.replace(part, f"[{kind.upper()}]")


@pytest.mark.parametrize("text", ["meet @ noon. Then go", "it is 5l or 10 l of 1O things", "plus one more", "+49 151 2345678 I am", "a soft\u00adhyphen and x\u200by", "R&#38;D and &period; alone", "a @ b . C"])
def test_no_disguise(text):
    assert pii.spans(text)[1] == []
