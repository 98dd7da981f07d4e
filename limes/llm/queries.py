"""The numbered operators as queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limes.llm import embeddings, htmltext, jaccard, licenses, linededup, neighbours, packing, phrases, pii, sentencepieces, spelling, toxicity, warc
from limes.llm.common import table

SPECIAL = {"<|endoftext|>": 50256}


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sentencepieces.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", "n_tokens", F.sha2("ids_le", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"))


def pieces(docs: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    found = packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, SPECIAL)
    return found.select("doc_id", "piece", "start", "length", F.crc32("ids_le").alias("ids_crc32"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(pieces(table(spark, sf_dir, "documents")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    held = F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False)).alias("held_out")
    return toxicity.score(docs, model).select("doc_id", held, "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "toxic_tokens", "spans")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.remove_boilerplate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_removed", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find_pii(table(spark, sf_dir, "documents"))
    return out.select("doc_id", *[f"n_{k}" for k in pii.KINDS], F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}


#: Lines on three sources or more go, but for their first occurrence.
LINES_SQL = """
WITH l AS (SELECT doc_id, coalesce(source, '') AS site, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
b AS (SELECT trim(line, ' ') AS k, min(struct_pack(d := doc_id, p := pos)) AS f FROM l WHERE trim(line, ' ') <> '' GROUP BY 1 HAVING count(DISTINCT site) >= 3),
m AS (SELECT l.*, f IS NOT NULL AND struct_pack(d := doc_id, p := pos) > f AS gone FROM l LEFT JOIN b ON trim(line, ' ') = k)
SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, md5(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS text_md5 FROM m GROUP BY doc_id
"""


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _licence_sql() -> str:
    rows = []
    for k, (phrase, label, kind, key) in enumerate([(p, x, "base", p) for p, x in licenses.BASE.items()] + [(p, x, "more", key) for p, (x, key) in licenses.MORE.items()]):
        ws, ks = phrase.split(), key.split()
        rows.append(f"({k}, '{phrase}', '{label}', '{kind}', '{key}', {next(j for j in range(len(ws)) if ws[j : j + len(ks)] == ks)})")
    return f"""
WITH t AS (SELECT *, string_split(phrase, ' ') AS tw, string_split(key, ' ') AS kw FROM (VALUES {', '.join(rows)}) x(template, phrase, label, kind, key, b)),
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
p AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM w),
pl AS (SELECT template, unnest(tw) AS word, generate_subscripts(tw, 1) - 1 AS place FROM t),
s AS (SELECT doc_id, template, pos - place AS start, count(*) AS n FROM p JOIN pl USING (word) GROUP BY ALL),
m AS (SELECT s.doc_id, s.start, label, kind, n / len(tw) AS share FROM s JOIN t USING (template) JOIN w USING (doc_id) WHERE start + b >= 0 AND ws[start + b + 1 : start + b + len(kw)] = kw)
SELECT doc_id, max(len(ws)) AS n_words, count(*) FILTER (WHERE kind = 'base') AS n_base, min(start) FILTER (WHERE kind = 'base') AS first_word, max(start) FILTER (WHERE kind = 'base') AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE kind = 'base'), '') AS base_labels, coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(share), 0) AS score
FROM w LEFT JOIN m USING (doc_id) GROUP BY doc_id
"""


LICENCE_SQL = _licence_sql()

WARC_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::bigint AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
v AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first, list_transform(range(8), lambda k: list_sum(list_transform(range(5), lambda j: (strpos('0123456789abcdef', hex[5 * k + j + 1]) - 1) * (1 << (16 - 4 * j)::int)))::int) AS bits FROM p)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: '{warc.ALPHABET}'[1 + ((bits[i // 4 + 1] >> (15 - 5 * (i % 4))::int) & 31)]), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM v
"""

#: Components of links e (a, b) over documents or vectors.
REACH = "r(id, m) AS (SELECT id, id FROM node UNION SELECT v, m FROM r JOIN (SELECT a AS u, b AS v FROM e UNION ALL SELECT b, a FROM e) x ON u = id WHERE m < v)"

JACCARD_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y USING (sh) WHERE x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
node AS (SELECT doc_id AS id FROM documents), {REACH}
SELECT id AS doc_id, coalesce(max(n), 0) AS n_shingles, min(m) AS component_id FROM r LEFT JOIN n ON doc_id = id GROUP BY id
"""

EMBEDDING_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::double[] AS x FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda z: z IS NULL OR NOT isfinite(z))) = 0 AND len(list_filter(embedding, lambda z: z <> 0)) > 0),
e AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND p.vec_id < q.vec_id AND len(p.x) = len(q.x) WHERE list_cosine_similarity(p.x, q.x) >= 0.93),
node AS (SELECT vec_id AS id FROM embeddings), {REACH},
k AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM e UNION ALL SELECT b FROM e) GROUP BY 1)
SELECT r.id AS vec_id, coalesce(max(n), 0) AS n_links, min(m) AS component_id, r.id = min(m) AS kept FROM r LEFT JOIN k ON k.id = r.id GROUP BY r.id
"""


PHRASES_SQL = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, unnest(ws) AS w1, unnest(ws[2:]) AS w2, unnest(ws[3:]) AS w3 FROM w),
f1 AS (SELECT lang, w1, count(*) AS f FROM g WHERE w1 IS NOT NULL GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM g WHERE w2 IS NOT NULL GROUP BY ALL HAVING f >= 10),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING f >= 10),
lng AS (SELECT lang, w1, w2, max(f) AS m FROM (SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL),
c AS (SELECT lang, w1 || ' ' || w2 AS phrase, 1 AS k, x.f AS a, y.f AS l, z.f AS r FROM f2 x JOIN f1 y USING (lang, w1) JOIN f1 z ON z.lang = x.lang AND z.w1 = w2 LEFT JOIN lng USING (lang, w1, w2) WHERE m IS NULL OR 100 * m < 50 * x.f
  UNION ALL SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, 1, t.f, y.f, z.f FROM f3 t JOIN f1 y ON y.lang = t.lang AND y.w1 = t.w1 JOIN f2 z ON z.lang = t.lang AND z.w1 = t.w2 AND z.w2 = t.w3
  UNION ALL SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, 2, t.f, y.f, z.f FROM f3 t JOIN f2 y ON y.lang = t.lang AND y.w1 = t.w1 AND y.w2 = t.w2 JOIN f1 z ON z.lang = t.lang AND z.w1 = t.w3),
s AS (SELECT *, (1000000::hugeint * a * a // (l::hugeint * r))::bigint AS score FROM c),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, rank, phrase, a, l, r, n::bigint AS n, score FROM o JOIN (SELECT lang, sum(f) AS n FROM f1 GROUP BY 1) USING (lang) WHERE rank <= 2000
"""


def _nibbles() -> list[int]:
    """The table of the checksum by half bytes."""
    out = []
    for k in range(16):
        for _ in range(4):
            k = k >> 1 ^ (0xEDB88320 if k & 1 else 0)
        out.append(k)
    return out


#: The checksum goes over the half bytes of the text, the lower one of each byte first.
SPELLING_SQL = f"""
WITH RECURSIVE r AS (SELECT coalesce(doc_id::varchar, '') || ':' AS d, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) AS run FROM documents),
q AS (SELECT d, run, count(*) AS k, hex(encode(d || run)) AS x FROM r WHERE length(run) >= 5 GROUP BY d, run),
h AS (SELECT run, k, xor(list_reduce(list_transform(range(1, length(x) + 1), lambda i: (strpos('0123456789ABCDEF', x[i - 1 + 2 * (i % 2)]) - 1)::ubigint), lambda c, v: xor(c >> 4, list_extract({_nibbles()}::ubigint[], (xor(c, v) & 15)::bigint + 1)), 4294967295::ubigint), 4294967295::ubigint) AS h FROM q),
o AS (SELECT k, CASE WHEN h % 97 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word FROM h),
w AS (SELECT word, sum(k)::bigint AS n FROM o WHERE length(word) >= 5 GROUP BY 1 HAVING sum(k) >= 3),
z AS (SELECT word, n, k, word[1 : k] || word[k + 2 :] AS rest FROM (SELECT word, n, unnest(range(length(word))) AS k FROM w)),
e AS (SELECT x.word AS a, y.word AS b FROM z x JOIN z y ON x.k = y.k AND x.rest = y.rest AND x.word <> y.word UNION SELECT word, rest FROM z SEMI JOIN w u ON u.word = rest UNION SELECT rest, word FROM z SEMI JOIN w u ON u.word = rest),
b AS (SELECT a AS word, count(*) AS n_near, min(struct_pack(less := -n, word := b)) AS best FROM e JOIN w ON w.word = b GROUP BY 1),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= 2 * w.n THEN best.word END AS form, CASE WHEN -best.less >= 2 * w.n THEN -best.less END AS form_n FROM w LEFT JOIN b USING (word)),
g(word, root) AS (SELECT word, word FROM f UNION ALL SELECT g.word, f.form FROM g JOIN f ON f.word = g.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, g.root, f.n, f.n_near, f.form_n FROM f JOIN g ON g.word = f.word JOIN f l ON l.word = g.root AND l.form IS NULL
"""


def oracle_sql() -> dict[str, str]:
    return {"op12_spelling": SPELLING_SQL, "op11_collocations": PHRASES_SQL, "op5_line_dedup": LINES_SQL, "op6_embedding_dedup": EMBEDDING_SQL, "op7_license_scan": LICENCE_SQL, "op8_warc": WARC_SQL, "op9_jaccard": JACCARD_SQL}
