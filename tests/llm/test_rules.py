"""Regressions, brute force on small tables, and edge cases of the numbered operators and the pipeline's stages."""

import base64
import hashlib
import random
import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from limes.llm import common, embeddings, graph, jaccard, licenses, linededup, packing, pii, queries, sentencepieces, toxicity, warc

CLASHES = "id long, key string, n long, h string, first int, score double, gone int, at long, rank int, row int"


def rows(spark, data, schema):
    """A table with columns of these rows, and others with names that the operators use inside."""
    extra = (1, "z", 0, "h", 7, 0.5, 3, 9, 2, 1)
    return spark.createDataFrame([(*r, *extra) for r in data], f"{schema}, {CLASHES}")


def test_pieces_of_rare_characters():
    table, rng = sentencepieces.PrefixTable(public_tokenizers.path("piece_bpe_32k.model")), random.Random(5)
    letters = list("ab \x00\x01�\U0010ffff中")
    for _ in range(2000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 12)))
        ids = np.frombuffer(table.encode(text), "<u4").tolist()
        assert ids == table.library.encode(text, add_bos=True, add_eos=True)


def test_texts_of_any_kind(spark):
    """Null, empty, very long and repeated texts, null and repeated ids, clashing columns: a row each, and no crash."""
    long = " ".join(f"word{k % 700} line\n" * (k % 40 == 0) + f"w{k % 977}" for k in range(60_000))
    docs = rows(spark, [(1, None, "a"), (2, "", "a"), (3, long, "b"), (4, long, "c"), (4, "other text", "c"), (4, "other text", "c"), (None, long, None), (None, None, None)], "doc_id long, text string, source string")
    none = docs.limit(0)
    pieces = sentencepieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert len(pieces) == 8 and {r.decoded for r in pieces} == {"", long, "other text"}
    labels = spark.createDataFrame([(1, 0), (3, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert len(toxicity.score(docs, model).collect()) == 8
    assert linededup.remove_boilerplate(docs).count() == 8
    assert licenses.scan(docs).count() == 8
    found = jaccard.near_duplicates(docs).collect()
    assert len(found) == 8 and {r.component_id for r in found if r.doc_id in (3, 4)} == {3}
    assert pii.find_pii(docs).count() == 8 and pii.redact(docs).columns == docs.columns
    assert packing.pack(queries.pieces(docs)).agg(F.sum("length")).first()[0] > 120_000
    for f in (lambda d: toxicity.score(d, model), linededup.remove_boilerplate, licenses.scan, jaccard.near_duplicates, pii.find_pii, lambda d: sentencepieces.encode_decode(d, public_tokenizers.path("piece_bpe_32k.model"))):
        assert f(none).count() == 0


def test_packed_ids_match_the_library():
    from tokenizers import Tokenizer

    library, rng = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), random.Random(6)
    ours = packing.byte_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, tuple(queries.SPECIAL.items()))
    letters = list("abtheino  \n\t.,;Éé中文🙂0123'\x00") + ["the", "ing", "'s", "<|endoftext|>", "\r\n", "   "]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    for text, ids in zip(texts, ours.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_packing_fills_its_bins_even_if_few_are_open(spark):
    rng = random.Random(7)
    sizes = [rng.randint(1, 1024) for _ in range(4000)]
    d = spark.createDataFrame([(k, 0, n) for k, n in enumerate(sizes)], "doc_id long, piece int, length long")
    least = -(-sum(sizes) // 1024)
    full = packing.pack(d).select("sequence_id").distinct().count()
    tight = packing.pack(d, open_bins=16).select("sequence_id").distinct().count()
    assert full <= 1.02 * least and full <= tight <= 1.3 * least  # 16 open bins cost a quarter more sequences


def test_lines_of_repeated_ids(spark):
    data = [(1, "shared\nkeep me", "a"), (1, "precious\nmore", "a"), (2, "shared\nx", "b"), (3, "y\nshared", "c"), (3, "y\nshared", "c")]
    out = sorted((r.doc_id, r.text, r.n_removed) for r in linededup.remove_boilerplate(rows(spark, data, "doc_id long, text string, source string")).collect())
    assert out == [(1, "precious\nmore", 0), (1, "shared\nkeep me", 0), (2, "x", 1), (3, "y", 1), (3, "y", 1)]


def test_lines_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(common, "SMALL_ROWS", 0)
    test_lines_of_repeated_ids(spark)
    rng = random.Random(9)
    data = [(k, "\n".join(rng.choice(["hot", "a", "b", f"own {k}", "rare " + str(rng.randint(0, 20))]) for _ in range(6)), f"s{rng.randint(0, 4)}") for k in range(200)]
    d = spark.createDataFrame(data, "doc_id long, text string, source string")
    sites = {}
    for _, text, site in data:
        for line in text.split("\n"):
            sites.setdefault(line, set()).add(site)
    seen, want = set(), {}
    for k, text, _ in data:
        kept = []
        for line in text.split("\n"):
            if len(sites[line]) < 3 or line not in seen:
                kept.append(line)
            seen.add(line)
        want[k] = "\n".join(kept)
    assert {r.doc_id: r.text for r in linededup.remove_boilerplate(d).collect()} == want


def test_embedding_links_are_counted_once(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)  # small: many pairs of blocks
    monkeypatch.setattr(embeddings, "ROWS", 4)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(6, 32))
    v = np.concatenate([base[k % 6] + 0.12 * rng.normal(size=32) for k in range(240)] + [base[:3].ravel()]).reshape(-1, 32)
    v[10], v[20] = v[0], v[0]
    d = rows(spark, [(k, x.tolist(), 1) for k, x in enumerate(v)], "vec_id long, embedding array<double>, label int")
    m = v / np.linalg.norm(v, axis=1, keepdims=True)
    link = m @ m.T >= 0.93
    np.fill_diagonal(link, False)
    part = np.arange(len(v))
    for _ in range(len(v)):
        part = np.minimum(part, np.where(link, part[None, :], len(v)).min(1))
    out = {r.vec_id: r for r in embeddings.near_duplicates(d).collect()}
    assert [out[k].n_links for k in range(len(v))] == link.sum(1).tolist() and link.sum() > 1000
    assert [out[k].component_id for k in range(len(v))] == part.tolist()


@pytest.mark.parametrize("small", [0, 500_000])
def test_components_with_a_hub(spark, monkeypatch, small):
    monkeypatch.setattr(common, "HOT", 4)
    monkeypatch.setattr(common, "SMALL_ROWS", small)
    monkeypatch.setattr(graph, "SMALL_ROWS", small)
    edges = [(0, k) for k in range(1, 60)] + [(k, k + 1) for k in range(100, 140)] + [(59, 139), (300, 301), (5, 5), (None, 3)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(60)}, **{k: 0 for k in range(100, 141)}, 300: 300, 301: 300}


def test_steps_of_the_jaccard_join_write_few_files(spark, monkeypatch, tmp_path):
    """However many partitions a shuffle has: each file is some forks of the executor."""
    for module in (common, graph):
        monkeypatch.setattr(module, "shared_folder", lambda _: str(tmp_path))
    texts = [" ".join(f"w{g}x{k}" for k in range(60 + copy)) for g in range(150) for copy in (0, 1)]
    most = common.tasks_for(spark, len(texts))
    settings = {"spark.sql.shuffle.partitions": str(3 * most), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {k: k - k % 2 for k in range(len(texts))}
    files = {}
    for f in tmp_path.rglob("part-*.parquet"):
        files[f.parent] = files.get(f.parent, 0) + 1
    assert len(files) > 10 and max(files.values()) <= most


def test_licence_scan_against_its_sql(spark):
    rng = random.Random(11)
    words = "the mit license under released apache version 2 0 licensed cc by nc sa 4 all rights reserved gnu general public 3 é".split()
    data = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for k in range(300)]
    data += [(300 + k, f"x {p.upper()}, y {p}") for k, p in enumerate([*licenses.BASE, *licenses.MORE])] + [(900, None), (901, "")]
    d = spark.createDataFrame(data, "doc_id long, text string")
    got = sorted(tuple(r) for r in licenses.scan(d).withColumn("score", F.round("score", 9)).collect())
    documents = d.toPandas()  # noqa: F841
    want = sorted(duckdb.sql(f"SELECT doc_id, n_words, n_base, first_word, last_word, base_labels, labels, round(score, 9) FROM ({queries.LICENCE_SQL})").fetchall(), key=lambda r: r[0])
    assert got == want and sum(r[2] for r in got) > 10


def test_licence_templates_from_a_table(spark):
    table = spark.createDataFrame([("do as you like", "free", "more", "as you like")], "phrase string, label string, kind string, key string")
    out = licenses.scan(spark.createDataFrame([(1, "you may do as you like"), (2, "as you"), (3, "as you like it")], "doc_id long, text string"), table)
    assert {r.doc_id: (r.labels, r.score) for r in out.collect()} == {1: ("free", 1.0), 2: ("", 0.0), 3: ("free", 0.75)}


def test_warc_against_a_plain_version(spark):
    data = [(1, "http://a", "xx"), (2, "http://b", "xx"), (2, "http://c", "yy"), (2, "http://c", "yy"), (3, None, "xx"), (3, None, "xx"), (4, "u v", None), (5, "é", ""), (None, "n", "xx"), (None, "m", "zz"), (6, "l", "long é\r\n\r\nWARC/1.1 " * 40_000), (7, "l", "long é\r\n\r\nWARC/1.1 " * 40_000)]
    out = warc.round_trip(rows(spark, data, "page_id long, url string, html string"))
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.content)) for r in out.collect()), key=str)
    first = {}
    for page, _, html in data:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    want = []
    for page, _, html in data:
        body = (html or "").encode()
        again = page is not None and first[html or ""] != page
        want.append((page, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", first[html or ""] if again else None, b"" if again else body))
    assert got == sorted(want, key=str)


def test_base_spans_against_the_patterns():
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = {
        "email": lambda s: True,
        "ip": lambda s: all(int(x) <= 255 for x in s.split(".")),
        "card": lambda s: 13 <= len(digits(s)) <= 19 and sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits(s)))) % 10 == 0,
        "phone": lambda s: 9 <= len(digits(s)) <= 15,
    }
    rng, hits = random.Random(12), 0
    pools = ["0123456789 -", "0123456789.25", "+0123456789 ().-", "a.@-_ é1+%", "0123456789.-+ ()@a²٣"]
    for _ in range(40_000):
        pool = rng.choice(pools)
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 40)))
        want = [(kind, m.start(), m.end()) for kind, p in patterns.items() for m in re.finditer(p, text) if rules[kind](m[0])]
        assert pii.plain(text) == want, text
        hits += len(want)
    assert hits > 1500


def test_disguises_in_odd_letters():
    assert pii.spans("ſeven " * 7)[0] == []  # the long s is a look-alike; it once ended the job
    text = "mail ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ or 𝐣𝐨𝐡𝐧@example.org; nine four six eight nine four six eight nine"
    base, added = pii.spans(text)
    assert [text[a:b] for k, a, b in added if k == "email"] == ["ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", "𝐣𝐨𝐡𝐧@example.org"]
    assert not base


def test_neighbouring_links_of_repeated_ids(spark):
    w = [f"w{k}" for k in range(40)]
    y, near = " ".join(w), " ".join([*w[:39], "odd"])
    d = rows(spark, [(5, "x " * 20), (5, y), (9, y), (12, near)], "doc_id long, text string")
    out = {(r.doc_id, r.component_id) for r in jaccard.near_duplicates(d).collect()}
    assert out == {(5, 5), (9, 5), (12, 5)}


@pytest.mark.parametrize("seed", [3, 4])
def test_jaccard_links_of_all_texts_of_an_id(spark, seed):
    """Ids with up to three texts, each linked by its own: classes equal those of all pairs of texts."""
    rng = random.Random(seed)
    base = [[f"{t}w{k}" for k in range(60)] for t in range(25)]
    data: list[tuple] = []
    for _ in range(90):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            text[rng.randrange(60)] = f"odd{rng.randrange(9)}"
        data.append((rng.randint(-40, 40), " ".join(text)))
    data += [data[0], (7, None), (None, data[1][1]), (8, " ")]
    sets = [(i, {tuple(w[k : k + 5]) for k in range(len(w) - 4)}) for i, t in data if i is not None for w in ((t or "").split(),)]
    part = {i: i for i, _ in data if i is not None}
    for _ in part:
        for i, x in sets:
            for j, z in sets:
                if x and z and 100 * len(x & z) >= 80 * len(x | z):
                    part[i] = part[j] = min(part[i], part[j])
    found = jaccard.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert len(found) == len(data) and max(sum(1 for j, _ in data if j == i) for i in part) > 1
    assert {r.doc_id: r.component_id for r in found} == {**part, None: None}


@pytest.mark.parametrize("keys", [None, 16])
def test_jaccard_blocks_of_leaves(spark, monkeypatch, keys):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    monkeypatch.setattr(jaccard, "COMMON", 8)
    rng, passage = random.Random(13), [f"p{k}" for k in range(60)]
    texts = [" ".join([*passage, *(f"{rng.choice('abc')}{rng.randint(0, 9)}" for _ in range(9))]) for _ in range(60)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    part = list(range(len(sets)))
    for _ in sets:
        for a, x in enumerate(sets):
            for b, z in enumerate(sets):
                if 100 * len(x & z) >= 80 * len(x | z):
                    part[a] = part[b] = min(part[a], part[b])
    assert {r.doc_id: r.component_id for r in jaccard.near_duplicates(d, keys=keys).collect()} == dict(enumerate(part))


def test_toxicity_with_few_and_conflicting_labels(spark):
    data = [(k, f"common words here {'vilefoo' if k in (1, 2) else ''} number{k}") for k in range(40)]
    d = rows(spark, data, "doc_id long, text string")
    ids = [r.doc_id for r in d.filter(~toxicity.held_out(F.col("doc_id"))).collect()]
    labels = spark.createDataFrame([(k, int(k in (1, 2))) for k in ids] + [(ids[-1], 0), (ids[-1], 1)], "doc_id long, toxic int")
    model = toxicity.fit(d, labels)
    scores = {r.doc_id: r.score for r in toxicity.score(d, model).collect()}
    assert len(scores) == 40 and len(set(scores.values())) > 1
    again = toxicity.fit(d.repartition(7), labels)  # the model doesn't hang on partitions
    assert np.allclose(model.weights, again.weights, atol=1e-5)


def test_bitmaps_keep_similar_sets():
    """Never less than is shared, folded or not; unrelated sets of any size are told apart."""
    rng = np.random.default_rng(5)
    draw = lambda n: np.unique(rng.integers(0, 1 << 64, n, np.uint64))
    for n in (1, 2, 5, 31, 33, 400, 511, 513, 3000):
        for k in range(20):
            s = draw(n)
            other = np.union1d(s[: len(s) - k * len(s) // 30], draw(k * len(s) // 60)) if k % 2 else s[: max(1, len(s) * (20 + k) // 40)]
            common = len(np.intersect1d(s, other, assume_unique=True))
            is_similar = 100 * common >= 80 * (len(s) + len(other) - common)
            kept = jaccard.may_share(jaccard.bitmap(s), len(s), jaccard.bitmap(other), len(other))
            assert kept == jaccard.may_share(jaccard.bitmap(other), len(other), jaccard.bitmap(s), len(s)) and kept >= is_similar
        if n > 30:
            s, t = draw(n), draw(n)
            assert not jaccard.may_share(jaccard.bitmap(s), len(s), jaccard.bitmap(t), len(t))


def test_sets_travel_only_where_bitmaps_leave_room(spark, monkeypatch):
    """Long unrelated documents whose group counts agree have no sets made and shuffled; the similar pair is found."""
    words = lambda k: " ".join(f"w{k}x{i}" for i in range(3000))
    docs = spark.createDataFrame([(k, words(k % 9)) for k in range(9)] + [(9, words(0) + " more"), (10, words(0))], "doc_id long, text string")
    chosen = jaccard.points(docs, jaccard.KEYS)
    pairs = spark.createDataFrame([(a, b) for b in range(10) for a in range(b)], "a long, b long")
    seen = []
    inner = jaccard.similar
    monkeypatch.setattr(jaccard, "similar", lambda p, *rest: (seen.extend(p.collect()), inner(p, *rest))[1])
    assert [tuple(r) for r in jaccard.verified(pairs, docs, chosen).collect()] == [(0, 9)]
    assert [tuple(r) for r in seen] == [(0, 9)]
