"""The numbered operators against libraries, brute force and edge cases on small tables."""

import base64
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from limes.llm import embeddings, jaccard, licenses, linededup, neighbours, packing, pii, sentencepieces, toxicity, warc
from limes.llm.queries import SPECIAL, pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", None, "a", "  two  blanks ", "The MIT License\nunder the mit license", "né🙂 Ⅻ ²", "x " * 3000, "same same", "same same"]


def docs(spark, texts=TEXTS):
    """Documents with repeated and null ids, and with columns whose names clash with inner ones."""
    rows = [(None if k == 2 else min(k, 7), t, "en", None if k % 3 == 0 else f"s{k % 3}", 1, "z", 0) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long, key string, gone int")


def empty(spark):
    return docs(spark).limit(0)


def test_pieces_match_the_library():
    table, rng = sentencepieces.PrefixTable(MODEL), random.Random(3)
    letters = list("abtheinor  \n\t▁².,;Éé中文🙂019İ<0x41></s>'\"()") + ["the", "ing", "   ", "        "]
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert np.frombuffer(table.encode(text), "<u4").tolist() == table.library.encode(text, add_bos=True, add_eos=True)


def test_encode_decode_rows(spark):
    out = sentencepieces.encode_decode(docs(spark), MODEL).collect()
    assert len(out) == len(TEXTS) and min(r.n_tokens for r in out) == 2
    assert sentencepieces.encode_decode(empty(spark), MODEL).count() == 0


def test_packing(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = packing.token_pieces(docs(spark), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, SPECIAL).collect()
    long = sorted((r for r in got if r.doc_id == 6), key=lambda r: r.piece)
    ids = np.frombuffer(b"".join(bytes(r.ids_le) for r in long), "<u4").tolist()
    assert ids == library.encode(TEXTS[6], add_special_tokens=False).ids + [2]
    assert [r.length for r in long[1:]] == [1024] * (len(long) - 1) and long[0].length <= 1024
    placed = packing.pack(pieces(docs(spark))).toPandas()
    assert len(placed) == len(got)
    for _, s in placed.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s.length.sum() <= 1024 and list(s.offset) == [0, *s.length.cumsum()[:-1]]
    assert packing.pack(pieces(empty(spark))).count() == 0


def test_open_bins_close_the_fullest():
    bins = packing.OpenBins(10, 2)
    assert [bins.put(n) for n in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]  # the bin of 8 closes
    assert bins.put(3) == (1, 7) and bins.put(4) == (0, 6)


def test_toxicity(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randint(3, 8))) for _ in range(300)]
    rows, marks = [], []
    for k in range(600):
        w = [rng.choice(words) for _ in range(60)]
        bad = k % 4 == 0
        if bad:
            w[10:12] = ["vilefoo", "crudbar"]
        rows.append((k, " ".join(w)))
        marks.append((k, int(bad)))
    d = spark.createDataFrame(rows + [(None, None), (9001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([*marks, (None, 1), (5, None)], "doc_id long, toxic int")
    out = toxicity.score(d, toxicity.fit(d, labels)).join(labels.filter("toxic IS NOT NULL"), "doc_id").filter(toxicity.held_out(F.col("doc_id"))).collect()
    assert len(out) > 60 and sum((r.score >= 0.5) == (r.toxic == 1) for r in out) / len(out) > 0.97
    assert all(0 <= r.score <= 1 for r in out) and any(r.spans for r in out)
    assert toxicity.score(d.limit(0), toxicity.fit(d.limit(0), labels.limit(0))).count() == 0


def test_forward_backward_sums_over_all_taggings():
    rng = np.random.default_rng(0)
    e, chain = rng.normal(size=5), np.array([0.3, -0.7, 1.1])
    total, one, pair = 0.0, np.zeros(5), np.zeros(5)
    for tags in np.ndindex(*[2] * 5):
        s = sum((e[t] + chain[0]) * tags[t] + (chain[2] if tags[t - 1] else chain[1]) * tags[t] * (t > 0) for t in range(5))
        total += np.exp(s)
        one += np.exp(s) * np.array(tags)
        pair[1:] += np.exp(s) * np.array(tags[1:]) * np.array(tags[:-1])
    p, q = toxicity.marginals(e, toxicity.Grid([5]), chain)
    assert np.allclose(p, one / total) and np.allclose(q, pair / total)


def test_forward_backward_passes_from_row_to_row():
    rng, chain = np.random.default_rng(1), np.array([0.2, -1.0, 2.0])
    lengths = [0, 1, 127, 128, 129, 0, 1000, 3]
    e = rng.normal(size=sum(lengths)) * 2
    p, pair = toxicity.marginals(e, toxicity.Grid(lengths), chain)
    ends = np.cumsum(lengths)
    for n, z in zip(lengths, ends):
        x = e[z - n : z] + chain[0]
        ahead, back = np.zeros((n, 2)), np.zeros((n, 2))  # logs of sums over taggings, by the tag here
        for t in range(n):
            ahead[t] = [0, x[t]] if t == 0 else [np.logaddexp(*ahead[t - 1]), x[t] + np.logaddexp(ahead[t - 1, 0] + chain[1], ahead[t - 1, 1] + chain[2])]
        for t in range(n - 2, -1, -1):
            back[t] = [np.logaddexp(back[t + 1, 0], x[t + 1] + chain[k] + back[t + 1, 1]) for k in (1, 2)]
        if n:
            total = np.logaddexp(*ahead[-1])
            assert np.allclose(p[z - n : z], np.exp(ahead[:, 1] + back[:, 1] - total))
            assert np.allclose(pair[z - n + 1 : z], np.exp(ahead[:-1, 1] + chain[2] + x[1:] + back[1:, 1] - total)) and pair[z - n] == 0


def test_line_dedup(spark):
    rows = [(k, f"own {k}\nshared line\n\nshared line " if k < 4 else None, f"s{k}") for k in range(5)] + [(None, "shared line", "s9"), (7, "pair", "a"), (8, "pair", "b")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: (r.text, r.n_removed) for r in linededup.remove_boilerplate(d).collect()}
    assert out[0] == ("own 0\nshared line\n", 1) and out[1] == ("own 1\n", 2) and out[4] == (None, 0)
    assert out[None] == ("shared line", 0) and out[7] == ("pair", 0) and out[8] == ("pair", 0)
    assert linededup.remove_boilerplate(docs(spark)).count() == len(TEXTS) and linededup.remove_boilerplate(empty(spark)).count() == 0


def test_embeddings(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 16))
    v = np.concatenate([base, base[:20] + 0.1 * rng.normal(size=(20, 16)), base[:5], base[:5] + 0.05])
    rows = [(k, x.tolist(), k % 2 if k < 40 else (k - 40) % 2) for k, x in enumerate(v)]
    odd = [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, base[0].tolist(), None), (None, base[0].tolist(), 0), (904, [None] * 16, 1)]
    d = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")
    out = {r.vec_id: r for r in embeddings.near_duplicates(d).collect()}
    m = v / np.linalg.norm(v, axis=1, keepdims=True)
    lab = np.array([r[2] for r in rows])
    link = (m @ m.T >= 0.93) & (lab[:, None] == lab[None, :])
    np.fill_diagonal(link, False)
    assert [out[k].n_links for k in range(len(rows))] == link.sum(1).tolist() and link.sum() > 20
    assert all(out[k].n_links == 0 and out[k].kept for k in (900, 901, 902, 903, 904))
    assert embeddings.near_duplicates(d.limit(0)).count() == 0
    near = neighbours.search(d, k=3, every=10).toPandas()
    for q in range(0, len(rows), 10):
        dist = np.sqrt(((v - v[q]) ** 2).sum(1))
        extra = [903] if True else []
        every = sorted([(x, k) for k, x in enumerate(dist) if k != q] + [(np.sqrt(((base[0] - v[q]) ** 2).sum()), e) for e in extra])[:3]
        got = near[near.query_id == q].sort_values("rank")
        assert np.allclose(got.score, [x for x, _ in every])
    assert neighbours.search(d.limit(0)).count() == 0


def test_neighbour_search_looks_at_all_kept_vertices(spark):
    points = spark.createDataFrame([(k, [float(k), 0.0]) for k in range(40)], "id long, v array<float>")
    path = spark.createDataFrame([(k, k + 1, 1.0) for k in range(39)], "id long, nb long, d double")
    found = neighbours.greedy_search(neighbours.links_of(path), points, points.filter("id = 0").selectExpr("id AS q"), 2, beam=18).collect()
    assert sorted(r.nb for r in found) == list(range(18))


def test_neighbours_of_vectors_alone_in_their_cells(spark):
    rng = np.random.default_rng(10)  # some of 0, 100, ... are alone in their cells
    v = rng.normal(size=(64,)) + 0.05 * rng.normal(size=(1500, 64))
    v[::100] = rng.normal(size=(15, 64))
    v[0] = -v[1]
    d = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "vec_id long, embedding array<double>")
    near = neighbours.search(d).toPandas()
    hits = 0
    for q in range(0, 1500, 100):
        dist = ((v - v[q]) ** 2).sum(1)
        got = near[near.query_id == q]
        assert len(got) == 10
        hits += len(set(got.vec_id) & set(np.argsort(dist)[1:11]))
    assert hits >= 140
    points = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v[:800])], "id long, v array<float>")
    whole = neighbours.exact(points, points.filter("id < 3").selectExpr("id AS q"), 11).toPandas()
    assert all(set(x.nb) == set(np.argsort(((v[:800] - v[q]) ** 2).sum(1))[:11]) for q, x in whole.groupby("q")) and len(whole) == 33


def test_neighbours_recall_without_structure(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BEAM", 40)  # too narrow, so that it must widen
    monkeypatch.setattr(neighbours, "SAMPLE", 10)
    v = np.random.default_rng(4).normal(size=(5000, 64))
    d = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "vec_id long, embedding array<double>")
    near = neighbours.search(d).toPandas()
    hits = sum(len(set(near[near.query_id == q].vec_id) & set(np.argsort(((v - v[q]) ** 2).sum(1))[1:11])) for q in range(0, 5000, 100))
    assert hits >= 0.9 * 500


def test_neighbours_ties_copies_and_lengths(spark):
    rows = [(k, [1.0, 0.0]) for k in range(30)] + [(100, [0.0, 1.0]), (101, [2.0, 0.0]), (200, [1.0, 2.0, 3.0]), (201, [1.0, 2.0, 4.0]), (100, [5.0, 5.0])]
    d = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, q string, id int")
    out = {}
    for r in neighbours.search(d, k=5).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, round(r.score, 9)))
    assert out[0] == [(k, k, 0.0) for k in range(1, 6)]  # ties go to the smaller id
    assert out[100] == [(k + 1, k, round(2**0.5, 9)) for k in range(5)]  # of rows with one id, the smallest vector counts
    assert out[200] == [(1, 201, 1.0)]  # all candidates of its length


def test_licenses(spark):
    texts = [*TEXTS, "Released under the MIT License. cc-by-nc! Apache License, Version 2.0; cc by nc", "mİt under the mit license, under THE mit license"]
    out = licenses.scan(docs(spark, texts)).collect()
    assert len(out) == len(texts)
    hit = {(r.n_base, r.first_word, r.last_word, r.base_labels) for r in out if r.n_base}
    assert hit == {(1, 3, 3, "mit"), (4, 1, 13, "apache-2,cc-by-nc,mit"), (2, 1, 5, "mit")}
    assert licenses.scan(empty(spark)).count() == 0


def test_license_labels_do_not_hang_on_other_files(spark):
    texts = ["content available as CC BY-SA 4.0", "licensed under the GNU General Public License version 3", *["sa voix"] * 5, "licensed work", "work", "work"]
    out = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert (out[0].labels, out[1].labels, out[2].labels) == ("cc-by-sa", "gpl-3", "")
    assert abs(out[0].score - 3 / 5) < 1e-9 and abs(out[1].score - 9 / 12) < 1e-9


def test_warc(spark):
    pages = spark.createDataFrame([(1, "http://a/x y", "<p>é\r\n\r\nWARC/1.1</p>", 0), (2, None, "<p>é\r\n\r\nWARC/1.1</p>", 0), (3, "u", None, 0), (4, "u", "", 0), (None, "u", "q", 0)], "page_id long, url string, html string, n int")
    out = {r.page_id: r for r in warc.round_trip(pages).collect()}
    assert (out[1].record_type, out[2].record_type, out[2].refers_to, out[4].refers_to) == ("response", "revisit", 1, 3)
    body = "<p>é\r\n\r\nWARC/1.1</p>".encode()
    assert bytes(out[1].content) == body and out[2].payload_bytes == len(body)
    assert out[1].payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
    assert warc.round_trip(pages.limit(0)).count() == 0


@pytest.mark.parametrize("common", [2, 256])
def test_jaccard(spark, monkeypatch, common):
    monkeypatch.setattr(jaccard, "COMMON", common)
    monkeypatch.setattr(jaccard, "PARTS", common)  # small: hubs drawn by hash too
    rng, texts = random.Random(5), []
    passage = [f"p{k}" for k in range(40)]
    for _ in range(30):
        w = [rng.choice("abcdefghij") + str(rng.randint(0, 400)) for _ in range(rng.choice([4, 30, 120]))] + (passage if rng.random() < 0.5 else [])
        texts.append(" ".join(w))
        for _ in range(rng.randint(0, 3)):
            x = list(w)
            for _ in range(rng.randint(0, 3)):
                x[rng.randrange(len(x))] = f"n{rng.random()}"
            texts.append(" ".join(x))
    d = spark.createDataFrame([*enumerate(texts), (900, None), (901, " \t"), (None, texts[0]), (902, texts[3].upper())], "doc_id long, text string")
    out = {r.doc_id: r for r in jaccard.near_duplicates(d).collect()}
    sets = {k: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := (t or "").lower().split()) else set() for k, t in [*enumerate(texts), (900, None), (901, " "), (902, texts[3])]}
    part = {k: k for k in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    part[a] = part[b] = min(part[a], part[b])
        if all(part[part[k]] == part[k] for k in part):
            break
    assert {k: (len(sets[k]), part[k]) for k in sets} == {k: (out[k].n_shingles, out[k].component_id) for k in sets}
    assert jaccard.near_duplicates(d.limit(0)).count() == 0


def test_pii(spark):
    text = "mail a.b@c.org or joe at example dot com; ip 10.0.0.255 not 10.0.0.256, card 4111 1111 1111 1111, +1 (555) 555-1234, call five five five one two three four; x [at] y (dot) net; ２.3.4.5"
    base, added = pii.spans(text)
    assert [(k, text[a:b]) for k, a, b in base] == [("email", "a.b@c.org"), ("ip", "10.0.0.255"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (555) 555-1234")]
    assert {("email", "joe at example dot com"), ("email", "x [at] y (dot) net"), ("ip", "２.3.4.5")} <= {(k, text[a:b]) for k, a, b in added}
    assert "[EMAIL]" in pii.redacted(text, base + added) and "4111" not in pii.redacted(text, base + added)
    rng = random.Random(8)
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    for _ in range(3000):
        t = "".join(rng.choice("a.@-_ é1") for _ in range(rng.randint(0, 25)))
        assert list(pii.emails(t)) == [m.span() for m in email.finditer(t)]
    assert pii.find_pii(docs(spark)).count() == len(TEXTS) and pii.find_pii(empty(spark)).count() == 0
    assert pii.redact(docs(spark)).columns == docs(spark).columns


@pytest.mark.parametrize(
    "text, kind, part",
    [
        ("write to john at example.com", "email", "john at example.com"),
        ("bob[@]corp[.]io", "email", "bob[@]corp[.]io"),
        ("ring +1 555 one two three four five now", "phone", "+1 555 one two three four five"),
        ("+1 five five five, one two three four five", "phone", "+1 five five five, one two three four five"),
        ("from one nine two dot one six eight dot one dot two zero", "ip", "one nine two dot one six eight dot one dot two zero"),
        ("+four nine six six eight eight four nine six", "phone", "+four nine six six eight eight four nine six"),
    ],
)
def test_disguises_alone_in_a_text(text, kind, part):
    base, added = pii.spans(text)
    assert not base and [(k, text[a:b]) for k, a, b in added] == [(kind, part)]
