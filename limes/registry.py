"""The library's own operators as queries over the given tables, each beside the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from limes.functions import columns as C
from limes.operators import arcs, census, codes, cuts, geometry, indicators, layers, order, overlay, rays, watch
from limes.plans import frames
from limes.sources import features, tables
from limes.streaming import watch as stream

_FIRST = "[" + ",".join(f"'{x}'" for x in frames.FIRST) + "]"
_SECOND = "[" + ",".join(f"'{x}'" for x in frames.SECOND) + "]"

#: The derived frames in SQL, for all queries below.
FRAMES = f"""
WITH c AS (
  SELECT *, k + (k - 1) // 5 AS seq, dep || lpad(cast(n_nationkey // 5 + 1 AS varchar), 2, '0') AS prov FROM (
    SELECT c_custkey, n_nationkey, n_name, r_name || ' ' || (c_custkey // 1000 % 19) AS r_name, c_mktsegment, cast(c_custkey % 37 + 1 AS int) AS k, lpad(cast(n_regionkey + 1 + 5 * (c_custkey // 1000 % 19) AS varchar), 2, '0') AS dep, cast(round(c_acctbal * 100) AS bigint) AS cents
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)),
d AS (SELECT *, prov || lpad(cast(seq AS varchar), 2, '0') AS ubigeo, {_FIRST}[(k - 1) % 7 + 1] || ' ' || {_SECOND}[(k - 1) // 7 + 1] AS nombre FROM c),
units AS (SELECT DISTINCT 'departamento' AS nivel, dep AS ubigeo, r_name AS nombre FROM d UNION ALL SELECT DISTINCT 'provincia', prov, n_name FROM d UNION ALL SELECT DISTINCT 'distrito', ubigeo, nombre FROM d),
dist AS (SELECT DISTINCT dep, prov, ubigeo, nombre, seq, r_name, n_name, upper(strip_accents(nombre)) AS norm FROM d),
pop AS (SELECT ubigeo, sum(cents)::bigint AS value FROM d GROUP BY 1),
cat AS (
  SELECT ubigeo, nivel, nombre, upper(strip_accents(nombre)) AS nombre_normalizado, upper(nivel) || ' ' || upper(nombre) AS nombre_censo, upper(nivel) || ' ' || upper(strip_accents(nombre)) AS nombre_censo_normalizado,
    CASE nivel WHEN 'departamento' THEN upper(dn) WHEN 'provincia' THEN upper(dn) || '|' || upper(pn) ELSE upper(dn) || '|' || upper(pn) || '|' || upper(strip_accents(nombre)) END AS clave_censo,
    ubigeo[1:2] AS ubigeo_departamento, dn AS nombre_departamento, CASE WHEN nivel = 'departamento' THEN '' ELSE ubigeo[1:4] END AS ubigeo_provincia, CASE WHEN nivel = 'departamento' THEN '' ELSE pn END AS nombre_provincia
  FROM units u JOIN (SELECT DISTINCT dep, r_name AS dn FROM d) a ON a.dep = u.ubigeo[1:2] LEFT JOIN (SELECT DISTINCT prov, n_name AS pn FROM d) b ON b.prov = u.ubigeo[1:4]),
cell AS (SELECT lpad((gy // 10)::varchar, 8, '0') || lpad((gx // 10)::varchar, 2, '0') || lpad((gy % 10 * 10 + gx % 10)::varchar, 2, '0') AS code, gx, gy FROM (SELECT o_orderkey % 100 AS gx, o_orderkey // 100 AS gy FROM orders)),
ij AS (SELECT code, k, gx * 4 + CASE (k // 4) % 4 WHEN 0 THEN k % 4 WHEN 1 THEN 4 WHEN 2 THEN 4 - k % 4 ELSE 0 END AS i, gy * 4 + CASE (k // 4) % 4 WHEN 0 THEN 0 WHEN 1 THEN k % 4 WHEN 2 THEN 4 ELSE 4 - k % 4 END AS j FROM cell, (SELECT unnest(range(17)) AS k)),
v AS (SELECT code, k, i * 1000 + (i * 7919 + j * 104729) % 201 - 100 AS x, j * 1000 + (i * 104729 + j * 7919) % 201 - 100 AS y FROM ij),
box AS (SELECT code, min(x) AS l, max(x) AS r, min(y) AS u, max(y) AS o FROM v GROUP BY 1),
seg AS (SELECT a.code, a.k AS seq, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM v a JOIN v b ON a.code = b.code AND b.k = a.k + 1),
und AS (SELECT code, CASE WHEN (x1, y1) < (x2, y2) THEN x1 ELSE x2 END AS x1, CASE WHEN (x1, y1) < (x2, y2) THEN y1 ELSE y2 END AS y1, CASE WHEN (x1, y1) < (x2, y2) THEN x2 ELSE x1 END AS x2, CASE WHEN (x1, y1) < (x2, y2) THEN y2 ELSE y1 END AS y2, (x1, y1) < (x2, y2) AS ahead FROM seg),
own AS (SELECT x1, y1, x2, y2, min(code) AS a, CASE WHEN min(code) <> max(code) THEN max(code) END AS b, CASE WHEN min(code) <> max(code) THEN 2 ELSE 1 END AS n_owners, max(code) FILTER (WHERE ahead) AS left_code, max(code) FILTER (WHERE NOT ahead) AS right_code, count(*) AS n FROM und GROUP BY ALL),
long AS (SELECT 'total' AS measure, ubigeo, value::double AS value FROM pop UNION ALL SELECT 'half', ubigeo, CASE WHEN value % 7 = 0 THEN NULL ELSE floor(value / 2.0) END FROM pop),
six AS (SELECT unnest(range(7)) AS i),
cuts AS (SELECT measure, quantile_cont(value, [0, 1/6, 2/6, 3/6, 4/6, 5/6, 1]) AS q FROM long GROUP BY 1)
"""

_LEN = "sqrt(((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))::double)"
#: A block stands in the place of one department.
_NO_BLOCK = "NOT (nivel = 'departamento' AND nombre = 'ASIA 0')"
REGISTERED: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(sql: str | None = None):
    def put(f):
        whole = FRAMES + sql if sql and "FROM pages" not in sql else sql
        if whole and ", RECURSIVE " in whole:
            whole = whole.replace("WITH c AS", "WITH RECURSIVE c AS", 1).replace(", RECURSIVE ", ", ", 1)
        REGISTERED[f.__name__] = (f, whole)
        return f

    return put


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, (f, _) in REGISTERED.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in REGISTERED.items() if sql}


def _cat(s: SparkSession, d: str) -> DataFrame:
    return codes.catalogue_rows(frames.units(s, d))


def _districts(s: SparkSession, d: str) -> DataFrame:
    return frames.units(s, d).filter("nivel = 'distrito'")


def _hierarchy(s: SparkSession, d: str) -> DataFrame:
    aliases = s.createDataFrame(list(frames.ALIASES), "nivel string, bare string, alias string")
    blocks = s.createDataFrame([(frames.BLOCK_OF[0], frames.BLOCK_OF[1], None)], "bare string, dep string, prov string")
    return census.census_hierarchy(census.apply_blocks(census.apply_aliases(census.classified_rows(frames.sheet(s, d)), aliases), blocks))


def _matched(s: SparkSession, d: str) -> DataFrame:
    return census.census_match(_hierarchy(s, d), _cat(s, d))


def _long(s: SparkSession, d: str) -> DataFrame:
    p = frames.population(s, d)
    wide = p.select("ubigeo", F.col("value").alias("total"), F.when(F.col("value") % 7 != 0, F.floor(F.col("value") / 2)).alias("half"))
    return wide.unpivot("ubigeo", ["total", "half"], "measure", "value").select("measure", "ubigeo", F.col("value").cast("double").alias("value"))


def _segments(s: SparkSession, d: str) -> DataFrame:
    return geometry.ring_segments(frames.parcels(s, d))


def _owners(s: SparkSession, d: str) -> DataFrame:
    return geometry.segment_owners(_segments(s, d))


def _degrees(s: SparkSession, d: str) -> DataFrame:
    e = s.read.parquet(f"{d}/events.parquet")
    return e.select("event_id", ((F.col("event_id") * 7919 % 140_000) / 10_000.0 - 82).alias("lon"), ((F.col("event_id") * 104729 % 180_000) / 10_000.0 - 18.5).alias("lat"))


def _albers_sql() -> str:
    """The ellipsoidal projection's formulas in SQL; standard parallels -5 and -42, origin -32 and -60, SAD69."""
    e2 = "(2 / 298.25 - 1 / (298.25 * 298.25))"
    q = lambda sin: f"((1 - {e2}) * ({sin} / (1 - {e2} * {sin} * {sin}) - ln((1 - sqrt({e2}) * {sin}) / (1 + sqrt({e2}) * {sin})) / (2 * sqrt({e2}))))"
    m2 = lambda deg: f"(pow(cos(radians({deg})), 2) / (1 - {e2} * pow(sin(radians({deg})), 2)))"
    return f"""
, k AS (SELECT ({m2(-5)} - {m2(-42)}) / ({q('sin(radians(-42))')} - {q('sin(radians(-5))')}) AS n),
k2 AS (SELECT n, {m2(-5)} + n * {q('sin(radians(-5))')} AS c FROM k),
g AS (SELECT event_id, (event_id * 7919 % 140000) / 10000.0 - 82 AS lon, (event_id * 104729 % 180000) / 10000.0 - 18.5 AS lat FROM events),
r AS (SELECT event_id, n, 6378160.0 * sqrt(c - n * {q('sin(radians(lat))')}) / n AS rho, 6378160.0 * sqrt(c - n * {q('sin(radians(-32))')}) / n AS rho0, n * radians(lon + 60) AS theta FROM g, k2)
SELECT event_id, round(rho * sin(theta), 3) AS x, round(rho0 - rho * cos(theta), 3) AS y FROM r
"""


@query("SELECT * FROM (SELECT ubigeo, value FROM pop UNION ALL SELECT ubigeo[1:4], sum(value)::bigint FROM pop GROUP BY 1 UNION ALL SELECT ubigeo[1:2], sum(value)::bigint FROM pop GROUP BY 1)".replace("FROM pop", "FROM (SELECT * FROM pop WHERE ubigeo[5:6] <> '09')"))
def roll_up(s, d):
    """The sheet's rows of districts, matched and rolled up; rows without a figure add nothing."""
    rows = _matched(s, d).filter("nivel = 'distrito'").select("ubigeo", F.col("value").cast("long").alias("value"))
    return census.roll_up(rows)


@query(f"SELECT cast(rpad(ubigeo, 6, '0') AS bigint) * 10 AS row_idx, nivel, clave_censo, ubigeo FROM cat WHERE {_NO_BLOCK} UNION ALL SELECT cast(rpad(prov, 6, '0') AS bigint) * 10 + 7, 'distrito', upper(r_name) || '|' || upper(n_name) || '|SIN NOMBRE', NULL FROM (SELECT DISTINCT prov, r_name, n_name FROM d)")
def census_match(s, d):
    return _matched(s, d).select("row_idx", "nivel", "clave_censo", "ubigeo")


@query("SELECT cast(rpad(prov, 6, '0') AS bigint) * 10 + 7 AS row_idx, 'distrito' AS nivel, 'SIN NOMBRE' AS bare, CASE WHEN true THEN 'not in the catalogue' END AS reason FROM (SELECT DISTINCT prov FROM d)")
def census_unmatched(s, d):
    return census.census_unmatched(_hierarchy(s, d), _cat(s, d))


@query(f"SELECT cast(rpad(ubigeo, 6, '0') AS bigint) * 10 AS row_idx, nivel, clave_censo FROM cat WHERE {_NO_BLOCK} UNION ALL SELECT cast(rpad(prov, 6, '0') AS bigint) * 10 + 7, 'distrito', upper(r_name) || '|' || upper(n_name) || '|SIN NOMBRE' FROM (SELECT DISTINCT prov, r_name, n_name FROM d)")
def census_hierarchy(s, d):
    return _hierarchy(s, d).select("row_idx", "nivel", "clave_censo")


@query("SELECT nivel, count(*) AS present, count(v) AS with_value, sum(v)::double AS total, count(*) = max(CASE nivel WHEN 'departamento' THEN 5 WHEN 'provincia' THEN 25 ELSE 1000 END) AS ok FROM (SELECT nivel, CASE WHEN nivel = 'distrito' AND units.ubigeo[5:6] = '09' THEN NULL ELSE value END AS v FROM units JOIN (SELECT dep AS u, sum(cents) AS value FROM d GROUP BY 1 UNION ALL SELECT prov, sum(cents) FROM d GROUP BY 1 UNION ALL SELECT ubigeo, sum(cents) FROM d GROUP BY 1) ON u = ubigeo WHERE NOT (nivel = 'departamento' AND nombre = 'ASIA 0')) GROUP BY 1")
def coverage(s, d):
    expected = s.createDataFrame([("departamento", 5), ("provincia", 25), ("distrito", 1000)], "nivel string, expected long")
    return census.coverage(_matched(s, d).filter("ubigeo IS NOT NULL"), expected)


@query("SELECT norm AS bare, count(*) AS n, count(*) * count(*) AS joined FROM dist GROUP BY 1")
def naive_name_fanout(s, d):
    return census.naive_name_fanout(_hierarchy(s, d), _cat(s, d))


@query("SELECT * FROM cat")
def catalogue_rows(s, d):
    return _cat(s, d)


@query("SELECT ubigeo, CASE WHEN seq = 4 THEN ltrim(ubigeo, '0') ELSE ubigeo END SIMILAR TO '[0-9]{6}' AS ok, lpad(CASE WHEN seq = 4 THEN ltrim(ubigeo, '0') ELSE ubigeo END, 6, '0') AS padded, ubigeo[1:2] AS dep, ubigeo[1:4] AS prov, seq FROM dist")
def code_functions(s, d):
    """valid_code, pad_code and parent_codes on codes of which some lost their zero."""
    raw = F.when(F.substring("ubigeo", 5, 2) == "04", F.ltrim("ubigeo", F.lit("0"))).otherwise(F.col("ubigeo"))
    padded = C.pad_code(raw, 6)
    return _districts(s, d).select("ubigeo", C.valid_code(raw, 6).alias("ok"), padded.alias("padded"), *C.parent_codes(padded))


@query("SELECT ubigeo, norm AS norm, 'DISTRITO ' || upper(nombre) AS census, r_name || '|' || n_name || '|' || norm AS key FROM dist")
def name_functions(s, d):
    """normalize_name, census_name, hierarchy_key and squash_text."""
    rows = frames.customers(s, d).select("ubigeo", "nombre", "r_name", "n_name").distinct()
    level = F.lit("distrito")
    spaced = F.concat(F.lit("  "), F.replace(F.col("nombre"), F.lit(" "), F.lit(" \t ")))
    return rows.select("ubigeo", C.normalize_name(spaced).alias("norm"), C.census_name(level, C.squash_text(spaced)).alias("census"), C.hierarchy_key(level, F.col("r_name"), F.col("n_name"), F.col("nombre")).alias("key"))


@query("SELECT event_id, replace(replace(replace(replace(replace(replace('a' || strip_accents(c) || 'o', chr(306), 'IJ'), chr(307), 'ij'), chr(319), 'L·'), chr(320), 'l·'), chr(329), chr(700) || 'n'), chr(383), 's') AS text FROM (SELECT event_id, chr((192 + event_id * 7 % 192)::int) || chr((768 + event_id % 16)::int) AS c FROM events)")
def strip_accents(s, d):
    """Latin letters with marks of their own and a further mark."""
    char = lambda code: F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")
    e = s.read.parquet(f"{d}/events.parquet")
    return e.select("event_id", C.strip_accents(F.concat(F.lit("a"), char(192 + F.col("event_id") * 7 % 192), char(768 + F.col("event_id") % 16), F.lit("o"))).alias("text"))


@query("SELECT ubigeo, CASE WHEN value % 3 = 0 THEN NULL WHEN value % 3 = 1 THEN value::double ELSE -abs(value)::double END AS n FROM pop")
def parse_number(s, d):
    text = F.when(F.col("value") % 3 == 0, F.lit(" - ")).when(F.col("value") % 3 == 1, F.format_number("value", 0)).otherwise(F.concat(F.lit("-"), F.abs("value").cast("string"), F.lit(" *")))
    return frames.population(s, d).select("ubigeo", C.parse_number(text).alias("n"))




@query("SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&amp;', '&'), '&#039;', ''''), '&#034;', '\"'), '[ \\t\\n\\r\\f\\v]+', ' ', 'g')) AS text FROM pages")
def cell_text(s, d):
    return s.read.parquet(f"{d}/pages.parquet").select("page_id", C.cell_text(F.col("html")).alias("text"))


@query("SELECT nivel, count(*) AS n, max(e) AS expected, sign(count(*) - max(e))::int AS sign FROM units JOIN (VALUES ('departamento', 5), ('provincia', 24), ('distrito', 2000)) x(l, e) ON l = nivel GROUP BY 1")
def level_counts(s, d):
    return codes.level_counts(frames.units(s, d), s.createDataFrame([("departamento", 5), ("provincia", 24), ("distrito", 2000)], "nivel string, expected int"))


@query("SELECT ubigeo, 2 AS n FROM dist WHERE seq = 3")
def duplicate_codes(s, d):
    rows = _districts(s, d)
    return codes.duplicate_codes(rows.unionByName(rows.filter("substring(ubigeo, 5, 2) = '03'")))


@query("SELECT norm AS nombre_normalizado, count(*) AS n, string_agg(ubigeo, ',' ORDER BY ubigeo) AS codes FROM dist GROUP BY 1 HAVING count(*) > 1")
def ambiguous_names(s, d):
    return codes.ambiguous_names(_cat(s, d))


@query("SELECT nivel, clave_censo, count(*) AS n FROM (SELECT * FROM cat UNION ALL SELECT * FROM cat WHERE ubigeo LIKE '%03') GROUP BY ALL HAVING count(*) > 1")
def key_uniqueness(s, d):
    cat = _cat(s, d)
    return codes.key_uniqueness(cat.unionByName(cat.filter("ubigeo LIKE '%03'")), "nivel", "clave_censo")


@query("SELECT prov AS ubigeo_provincia, regexp_replace(norm, ' .*', '') AS nombre_normalizado, string_agg(ubigeo, ',' ORDER BY ubigeo) AS codes, count(*) AS n FROM dist GROUP BY ALL HAVING count(*) > 1")
def conflicting_codes(s, d):
    return codes.conflicting_codes(_cat(s, d).withColumn("nombre_normalizado", F.when(F.col("nivel") == "distrito", F.regexp_replace("nombre_normalizado", " .*", ""))))


@query("SELECT prov, prov || lpad((max(seq) + 1)::varchar, 2, '0') AS code, CASE WHEN prov[1:2] = '02' THEN 'retired' ELSE 'ok' END AS status FROM dist GROUP BY 1 UNION ALL SELECT p, CASE WHEN p = '9901' THEN '990112' END, s FROM (VALUES ('9999', 'empty province'), ('16', 'malformed province'), ('160a', 'malformed province'), ('9902', 'exhausted'), ('9901', 'ok')) x(p, s) UNION ALL SELECT NULL, '16020', 'malformed district'")
def next_code(s, d):
    """All provinces, and a few that can't have a next code."""
    rows = _districts(s, d).select("ubigeo")
    retired = rows.filter("substring(ubigeo, 1, 2) = '02'").groupBy(F.substring("ubigeo", 1, 4).alias("p")).agg((F.max(F.substring("ubigeo", 5, 2).cast("int")) + 1).alias("m")).select(F.concat("p", F.lpad(F.col("m").cast("string"), 2, "0")).alias("ubigeo"))
    planted = s.createDataFrame([("16020",), ("990299",), ("990101",), ("990111",)], "ubigeo string")
    asked = rows.select(F.substring("ubigeo", 1, 4).alias("prov")).unionByName(s.createDataFrame([("9999",), ("16",), ("160a",), ("9902",), ("9901",)], "prov string"))
    return codes.next_code(rows.unionByName(planted), retired, asked)


@query("SELECT t.prov, g AS gap FROM (SELECT prov, max(seq) AS m FROM dist GROUP BY 1) t, (SELECT unnest(range(1, 100)) AS g) WHERE g < m AND NOT EXISTS (SELECT 1 FROM dist x WHERE x.ubigeo = t.prov || lpad(g::varchar, 2, '0'))")
def code_gaps(s, d):
    return codes.code_gaps(_districts(s, d)).select("prov", F.col("gap").cast("long").alias("gap"))


@query("SELECT row_number() OVER (ORDER BY length(ubigeo), ubigeo) AS place, ubigeo FROM units")
def stable_code_sort(s, d):
    """Codes by length and text; numbered, so that the order can be compared."""
    return order.stable_code_sort(frames.units(s, d).select("ubigeo")).select("place", "ubigeo")


@query("SELECT ubigeo AS code, CASE WHEN seq % 13 = 0 AND seq % 2 = 0 THEN 'only_a' ELSE 'undeclared_a' END AS kind FROM dist WHERE seq % 13 = 0 UNION ALL SELECT prov || '99', 'undeclared_b' FROM (SELECT DISTINCT prov FROM dist) UNION ALL SELECT ubigeo, 'resolved' FROM dist WHERE seq = 2")
def reconcile_codes(s, d):
    a = _districts(s, d).select(F.col("ubigeo").alias("code"))
    seq = F.substring("code", 5, 2).cast("int")
    b = a.filter(seq % 13 != 0).unionByName(a.select(F.concat(F.substring("code", 1, 4), F.lit("99")).alias("code")).distinct())
    return codes.reconcile(a, b, a.filter(((seq % 13 == 0) & (seq % 2 == 0)) | (seq == 2)))


@query("SELECT DISTINCT 'distrito' AS pair, prov AS code, CASE WHEN dep = '03' THEN 'no children' ELSE 'no parent' END AS fault FROM dist WHERE dep IN ('03', '04') UNION ALL SELECT DISTINCT 'provincia', dep, 'no children' FROM dist WHERE dep = '04' UNION ALL SELECT DISTINCT 'distrito in departamento', dep, 'no children' FROM dist WHERE dep = '03'")
def hierarchy_closure(s, d):
    """Districts lack one department, provinces another."""
    u = frames.units(s, d)
    dist = u.filter("nivel = 'distrito' AND substring(ubigeo, 1, 2) <> '03'")
    prov, dep = u.filter("nivel = 'provincia' AND substring(ubigeo, 1, 2) <> '04'"), u.filter("nivel = 'departamento'")
    pairs = [("distrito", dist, prov, 4), ("provincia", prov, dep, 2), ("distrito in departamento", dist, dep, 2)]
    out = [codes.hierarchy_closure(below, above, n).select(F.lit(name).alias("pair"), "code", "fault") for name, below, above, n in pairs]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("SELECT ubigeo AS code, 'lost' AS change FROM dist WHERE seq = 7 UNION ALL SELECT ubigeo, 'added' FROM dist WHERE seq = 8")
def set_equal(s, d):
    c = _districts(s, d).select(F.col("ubigeo").alias("code"))
    return codes.set_equal(c.filter("substring(code, 5, 2) <> '08'"), c.filter("substring(code, 5, 2) <> '07'"))


@query("SELECT ubigeo, nombre, 'INEI' AS fuente FROM dist WHERE seq <> 7 UNION ALL SELECT ubigeo, upper(nombre), 'ley' FROM dist WHERE seq = 7")
def merge_layers(s, d):
    rows = _districts(s, d).select("ubigeo", "nombre")
    derived = rows.filter("substring(ubigeo, 5, 2) = '07'").select("ubigeo", F.upper("nombre").alias("nombre"), F.lit("ley").alias("fuente"))
    return codes.merge_layers(rows.withColumn("fuente", F.lit("INEI")), derived)


@query("SELECT ubigeo AS entry, prov, nombre, CASE WHEN seq <> 3 THEN ubigeo END AS official, CASE WHEN seq = 3 THEN 'ambiguous' ELSE 'found' END AS status FROM dist UNION ALL SELECT ubigeo || 'x', prov, nombre || ' X', NULL, 'none' FROM dist")
def registry_lookup(s, d):
    """All districts, of which one of each province has two codes in the catalogue, and as many names that it lacks."""
    rows = _districts(s, d).select(F.col("ubigeo").alias("entry"), F.substring("ubigeo", 1, 4).alias("prov"), "nombre")
    cat = _cat(s, d)
    twice = cat.unionByName(cat.filter("nivel = 'distrito' AND ubigeo LIKE '%03'").withColumn("ubigeo", F.concat(F.substring("ubigeo", 1, 4), F.lit("97"))))
    return codes.registry_lookup(rows.unionByName(rows.select(F.concat("entry", F.lit("x")).alias("entry"), "prov", F.concat("nombre", F.lit(" X")).alias("nombre"))), twice)


@query("SELECT ubigeo AS entry, prov, nombre, ubigeo AS predicted, 'published' AS status FROM dist UNION ALL SELECT ubigeo || 'x', prov, nombre || ' X', ubigeo, 'code taken' FROM dist UNION ALL SELECT ubigeo || 'y', prov, nombre || ' Y', prov || '98', 'pending' FROM dist")
def law_matches(s, d):
    rows = _districts(s, d)
    e = rows.select(F.col("ubigeo").alias("entry"), F.substring("ubigeo", 1, 4).alias("prov"), "nombre", F.col("ubigeo").alias("predicted"))
    other = lambda x, code: e.select(F.concat("entry", F.lit(x)).alias("entry"), "prov", F.concat("nombre", F.lit(f" {x.upper()}")).alias("nombre"), code.alias("predicted"))
    return codes.law_matches(e.unionByName(other("x", F.col("predicted"))).unionByName(other("y", F.concat("prov", F.lit("98")))), rows)


@query("SELECT u.nivel, u.ubigeo, u.nombre, value FROM units u LEFT JOIN pop USING (ubigeo)")
def attach_indicator(s, d):
    return indicators.attach_indicator(frames.units(s, d), frames.population(s, d)).select("nivel", "ubigeo", "nombre", "value")


@query("SELECT measure, i, round(q[i + 1], 6) AS cut FROM cuts, six")
def quantile_cuts(s, d):
    return indicators.quantile_cuts(_long(s, d)).select("measure", F.posexplode("cuts").alias("i", "cut")).select("measure", F.col("i").cast("long").alias("i"), F.round("cut", 6).alias("cut"))


@query("SELECT measure, i, value AS cut FROM (SELECT measure, value, row_number() OVER (PARTITION BY measure ORDER BY value) - 1 AS r, count(*) OVER (PARTITION BY measure) AS n FROM long WHERE value IS NOT NULL), six WHERE r = (i * (n - 1)) // 6")
def rank_cuts(s, d):
    return indicators.rank_cuts(_long(s, d)).select("measure", F.col("i").cast("long").alias("i"), "cut")


@query("SELECT measure, ubigeo, CASE WHEN value IS NULL THEN -1 ELSE least(greatest(len(list_filter(q, lambda z: z <= value)) - 1, 0), 5) END AS class FROM long JOIN cuts USING (measure)")
def assign_class(s, d):
    v = _long(s, d)
    return indicators.assign_class(v, indicators.quantile_cuts(v)).select("measure", "ubigeo", F.col("class").cast("long").alias("class"))


@query("SELECT measure, rank, ubigeo, value FROM (SELECT *, row_number() OVER (PARTITION BY measure ORDER BY value DESC, ubigeo) AS rank FROM long WHERE value IS NOT NULL) WHERE rank <= 10")
def top_units(s, d):
    return indicators.top_units(_long(s, d), 10)


@query("SELECT measure, ubigeo, value FROM long WHERE ubigeo LIKE '0203%'")
def focus_table(s, d):
    return indicators.focus_table(_long(s, d), "0203")


@query("SELECT ubigeo, CASE WHEN ubigeo = '0203' THEN ubigeo ELSE nombre END AS nombre FROM units WHERE ubigeo LIKE '02__'")
def children_of(s, d):
    """Provinces of a department, one of which has no name."""
    return indicators.children_of(frames.units(s, d).withColumn("nombre", F.when(F.col("ubigeo") == "0203", "").otherwise(F.col("nombre"))), "02")


@query("SELECT * FROM long WHERE value IS NOT NULL")
def long_measures(s, d):
    p = frames.population(s, d)
    return indicators.long_measures(p.select("ubigeo", F.col("value").alias("total"), F.when(F.col("value") % 7 != 0, F.floor(F.col("value") / 2).cast("string")).otherwise("").alias("half")), "total", "half")


@query("SELECT measure, '{' || string_agg('\"' || level || '\":{' || j || '}', ',' ORDER BY level) || '}' AS json FROM (SELECT measure, 'distrito' AS level, string_agg('\"' || ubigeo || '\":' || CASE WHEN value IS NULL THEN 'null' ELSE (value / 4)::decimal(18, 2)::varchar END, ',' ORDER BY ubigeo) AS j FROM long GROUP BY 1) GROUP BY 1")
def indicator_json(s, d):
    """Figures in hundredths, as text of fixed form, so that both sides write them alike."""
    text = F.regexp_replace("json", r":(-?[0-9.]+(?:E[0-9]+)?)", ":$1")
    v = _long(s, d).withColumn("value", (F.col("value") / 4).cast("decimal(18,2)"))
    return indicators.indicator_json(v).select("measure", text.alias("json"))


@query("SELECT code, string_agg(x1 || ' ' || y1 || ' ' || x2 || ' ' || y2, ',' ORDER BY seq) AS segments FROM seg GROUP BY 1")
def ring_segments(s, d):
    """The segments of each parcel in a row, in their order."""
    rows = _segments(s, d).groupBy("code").agg(F.array_sort(F.collect_list(F.struct("seq", F.concat_ws(" ", "x1", "y1", "x2", "y2").alias("t")))).alias("e"))
    return rows.select("code", F.array_join(F.transform("e", lambda e: e["t"]), ",").alias("segments"))


@query(", g AS (SELECT code, k, round(x / 1e7 * 10000)::bigint AS x, round(y / 1e7 * 10000)::bigint AS y FROM v), h AS (SELECT *, k > 0 AND x = lag(x) OVER w AND y = lag(y) OVER w AS again FROM g WINDOW w AS (PARTITION BY code ORDER BY k)) SELECT code, count(*) FILTER (WHERE NOT again) AS points, count(*) FILTER (WHERE NOT again) < 4 AS collapsed, string_agg(x || ' ' || y, ',' ORDER BY k) FILTER (WHERE NOT again) AS path FROM h GROUP BY 1")
def round_layer(s, d):
    """Parcels on a grid about as wide as their edges: points that fall together are dropped, and rings that are left with too few have collapsed."""
    grid = F.transform("vertices", lambda v: geometry.round_grid(v["x"] / 1e7, v["y"] / 1e7, 4))
    v = geometry.drop_repeats(F.col("vertices"))
    rows = frames.parcels(s, d).withColumn("vertices", grid).select("code", v.alias("v"))
    return rows.select("code", F.size("v").cast("long").alias("points"), (F.size("v") < 4).alias("collapsed"), F.array_join(F.transform("v", lambda p: F.concat_ws(" ", p["x"], p["y"])), ",").alias("path"))


@query(f"SELECT code, sum(x1 * y2 - x2 * y1)::bigint AS area2, round(sum({_LEN}), 3) AS perimeter, min(x1) AS min_x, min(y1) AS min_y, max(x1) AS max_x, max(y1) AS max_y, count(*) AS vertices FROM seg GROUP BY 1")
def polygon_measures(s, d):
    return geometry.polygon_measures(_segments(s, d))


@query("SELECT code, round(avg(x), 6) AS x, round(avg(y), 6) AS y FROM v GROUP BY 1")
def label_points(s, d):
    return geometry.label_points(frames.parcels(s, d))


@query("SELECT code, 'unclosed' AS fault FROM cell WHERE code LIKE '%07' UNION ALL SELECT code, 'repeated vertex' FROM cell WHERE code LIKE '%08' UNION ALL SELECT code, 'turned' FROM cell WHERE code LIKE '%09' UNION ALL SELECT code, unnest(['crossing edges', 'flat']) FROM cell WHERE code LIKE '%11' UNION ALL SELECT code, 'out of bounds' FROM cell WHERE gx = 99 UNION ALL SELECT code, 'off the grid' FROM cell WHERE code LIKE '%13' UNION ALL SELECT code, unnest(['short', 'unclosed']) FROM cell WHERE code LIKE '%14' UNION ALL SELECT code, 'empty' FROM cell WHERE code LIKE '%15' UNION ALL SELECT code, 'crossing edges' FROM cell WHERE code LIKE '%17' UNION ALL SELECT code, unnest(['crossing rings', 'crossing rings']) FROM cell WHERE code LIKE '%21' UNION ALL SELECT code, 'hole outside' FROM cell WHERE code LIKE '%22' UNION ALL SELECT code, 'hole in a hole' FROM cell WHERE code LIKE '%23'")
def geometry_checks(s, d):
    """Parcels with one fault planted in some of each block: a bow-tie of no area and one with area among them."""
    code, v = F.col("code"), F.col("vertices")
    tie = F.array(v[0], v[8], v[4], v[12], v[0])
    flat = F.array(*[F.struct(*[(v[0][c].cast("double") + k).alias(c) for c, k in zip("xy", step)]) for step in ((0, 0), (1000, 1000), (1000, 0), (0, 1000), (0, 0))])
    double = F.transform(v, lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y")))
    bad = lambda tail, fixed: F.when(code.endswith(tail), fixed)
    faulty = bad("07", F.slice(double, 1, 16)).when(code.endswith("08"), F.concat(F.slice(double, 1, 1), double)).when(code.endswith("09"), F.reverse(double)).when(code.endswith("11"), flat)
    faulty = faulty.when(code.endswith("13"), F.transform(double, lambda p, i: F.struct(F.when(i == 2, p["x"] + 0.5).otherwise(p["x"]).alias("x"), p["y"].alias("y")))).when(code.endswith("14"), F.slice(double, 1, 3))
    faulty = faulty.when(code.endswith("15"), F.slice(double, 1, 0)).when(code.endswith("17"), F.concat(F.slice(double, 1, 2), F.slice(double, 7, 1), F.slice(double, 4, 3), F.slice(double, 3, 1), F.slice(double, 8, 10))).otherwise(double)
    parcels = frames.parcels(s, d)
    # holes: one across its shell, one beside it, one within another, and two that are as they should be
    box = lambda x, y, side: F.array(*[F.struct(*[(F.round(v[0][c] / 4000) * 4000 + k).cast("double").alias(c) for c, k in zip("xy", step)]) for step in ((x, y), (x, y + side), (x + side, y + side), (x + side, y), (x, y))])
    holes = F.when(code.endswith("21"), F.array(box(3000, 1500, 2000))).when(code.endswith("22"), F.array(box(5000, 1000, 500))).when(code.endswith("23"), F.array(box(1000, 1000, 2000), box(1500, 1500, 500))).when(code.endswith("24"), F.array(box(1000, 1000, 500), box(2000, 2000, 500)))
    more = parcels.select("code", F.posexplode(holes).alias("k", "vertices")).select("code", (F.col("k") + 1).alias("ring"), "vertices")
    # stored, for the checks read it many times: Spark puts the formula of all vertices in each place that names them
    whole = tables.stored(parcels.withColumn("vertices", faulty).unionByName(more))
    return geometry.geometry_checks(whole, (-10_000, -10_000, 4000 * 99 + 3000, 1 << 40)).select("code", "fault")


@query("SELECT x1, y1, x2, y2, a, b, n_owners, left_code, right_code, n > 2 OR n = 2 AND (left_code IS NULL OR right_code IS NULL) AS fault FROM own")
def segment_owners(s, d):
    return _owners(s, d)


@query(f"SELECT a, b, count(*) AS segments, round(sum({_LEN}), 3) AS length FROM own WHERE n_owners = 2 GROUP BY 1, 2")
def adjacency(s, d):
    return geometry.adjacency(_owners(s, d))


@query(f"SELECT CASE n_owners WHEN 2 THEN 'interdistrital' ELSE 'exterior' END AS tipo, count(*) AS segments, round(sum({_LEN}), 1) AS length FROM own GROUP BY 1")
def arc_types(s, d):
    return geometry.arc_types(_owners(s, d)).withColumn("length", F.round("length", 1))


@query("SELECT code[1:10] AS code, x1, y1, x2, y2, sum(CASE WHEN ahead THEN 1 ELSE -1 END)::bigint AS net FROM und GROUP BY ALL HAVING net <> 0")
def dissolve(s, d):
    return geometry.dissolve(_segments(s, d), 10)


@query("SELECT DISTINCT a.code AS a, b.code AS b FROM (SELECT *, unnest(range(l // 4000 - 1, r // 4000 + 2)) AS cx FROM box) a JOIN (SELECT *, l // 4000 AS cx FROM box) b ON a.cx = b.cx AND a.u // 40000 BETWEEN b.u // 40000 - 1 AND b.u // 40000 + 1 AND a.code <> b.code AND a.l <= b.r AND b.l <= a.r AND a.u <= b.o AND b.u <= a.o WHERE a.code < b.code UNION SELECT DISTINCT b.code, a.code FROM (SELECT *, unnest(range(l // 4000 - 1, r // 4000 + 2)) AS cx FROM box) a JOIN (SELECT *, l // 4000 AS cx FROM box) b ON a.cx = b.cx AND a.code <> b.code AND a.l <= b.r AND b.l <= a.r AND a.u <= b.o AND b.u <= a.o WHERE b.code < a.code")
def bbox_pairs(s, d):
    return geometry.bbox_pairs(geometry.polygon_measures(_segments(s, d)), 4000)


@query("SELECT min(x) AS min_x, min(y) AS min_y, max(x) AS max_x, max(y) AS max_y FROM v WHERE code LIKE '0000000003%'")
def focus_bounds(s, d):
    return geometry.focus_bounds(geometry.polygon_measures(_segments(s, d)), "0000000003")


@query(", p AS (SELECT event_id AS id, event_id * 7919 % 400000 AS x, event_id * 104729 % 600000 AS y FROM events), near AS (SELECT p.*, code FROM (SELECT *, x // 4000 AS cx FROM p) p JOIN (SELECT *, unnest(range(l // 4000, r // 4000 + 1)) AS cx FROM box) b USING (cx) WHERE x BETWEEN l AND r AND y BETWEEN u AND o) SELECT id, code FROM (SELECT p.id, g.code, count(*) AS n FROM near p JOIN seg g ON g.code = p.code AND (g.y1 <= p.y) <> (g.y2 <= p.y) AND CASE WHEN g.y2 > g.y1 THEN (g.x2 - g.x1) * (p.y - g.y1) - (p.x - g.x1) * (g.y2 - g.y1) > 0 ELSE (g.x2 - g.x1) * (p.y - g.y1) - (p.x - g.x1) * (g.y2 - g.y1) < 0 END GROUP BY ALL) WHERE n % 2 = 1")
def points_in_units(s, d):
    e = s.read.parquet(f"{d}/events.parquet").select(F.col("event_id").cast("long").alias("id"))
    return geometry.points_in_units(e.select("id", (F.col("id") * 7919 % 400_000).alias("x"), (F.col("id") * 104729 % 600_000).alias("y")), _segments(s, d), 4000)


def _published(s: SparkSession, d: str) -> DataFrame:
    """Districts with provenance, of which some break rules."""
    seq = F.substring("ubigeo", 5, 2).cast("int")
    law = seq % 9 == 0
    return _districts(s, d).select("ubigeo", "nombre", F.when(law, "ley").otherwise("INEI").alias("fuente"), F.when(seq == 2, "falso").when(law, "reconstruido").otherwise("oficial").alias("confianza"), F.when(law | (seq == 3), "Ley 1").alias("ley_creacion"), F.when(law, "2020-01-01").alias("fecha_creacion"), F.when(law, "corte").alias("metodo"), F.when(law & (seq != 27), "aviso").alias("advertencia"))


@query("SELECT ubigeo, nombre FROM dist WHERE seq % 9 <> 0")
def official_only(s, d):
    return watch.official_only(_published(s, d)).select("ubigeo", "nombre")


@query("SELECT ubigeo, 'unknown confidence' AS rule FROM dist WHERE seq = 2 UNION ALL SELECT ubigeo, 'confidence against source' FROM dist WHERE seq = 2 UNION ALL SELECT ubigeo, 'official unit with a law' FROM dist WHERE seq = 3 UNION ALL SELECT ubigeo, 'derived unit without advertencia' FROM dist WHERE seq = 27")
def provenance_rules(s, d):
    return watch.provenance_rules(_published(s, d))


@query("SELECT ubigeo AS code, 'new' AS change FROM dist WHERE seq = 13 UNION ALL SELECT ubigeo, 'gone' FROM dist WHERE seq = 14")
def known_anomalies(s, d):
    c = _districts(s, d).select(F.col("ubigeo").alias("code")).withColumn("seq", F.substring("code", 5, 2).cast("int"))
    return watch.known_anomalies(c.filter("seq IN (11, 13)"), c.filter("seq IN (11, 14)"))


@query("SELECT 'count changed' AS kind, (count(*) FILTER (WHERE seq <> 14))::varchar AS code FROM dist UNION ALL SELECT 'official count changed', count(*)::varchar FROM dist UNION ALL SELECT 'law: published', ubigeo FROM dist WHERE seq = 10 UNION ALL SELECT 'law: code taken', ubigeo FROM dist WHERE seq = 11 UNION ALL SELECT 'official without polygon', ubigeo FROM dist WHERE seq = 14 AND dep <> '01' UNION ALL SELECT 'declared gap closed', ubigeo FROM dist WHERE seq = 15 UNION ALL SELECT DISTINCT 'confirmed code vanished', prov || '98' FROM dist")
def watch_alerts(s, d):
    rows = _districts(s, d).select("ubigeo", "nombre")
    seq, prov = F.substring("ubigeo", 5, 2), F.substring("ubigeo", 1, 4)
    null = F.lit(None).cast("string")
    e = rows.filter(seq == "10").select(F.col("ubigeo").alias("entry"), prov.alias("prov"), "nombre", F.col("ubigeo").alias("predicted"), null.alias("confirmed"))
    e = e.unionByName(rows.filter(seq == "11").select(F.col("ubigeo").alias("entry"), prov.alias("prov"), F.lit("otro").alias("nombre"), F.col("ubigeo").alias("predicted"), null.alias("confirmed")))
    e = e.unionByName(rows.select(prov.alias("prov")).distinct().select(F.concat("prov", F.lit("z")).alias("entry"), "prov", F.lit("nuevo").alias("nombre"), F.concat("prov", F.lit("98")).alias("predicted"), F.concat("prov", F.lit("98")).alias("confirmed")))
    declared = rows.filter(((seq == "14") & F.col("ubigeo").startswith("01")) | (seq == "15")).select(F.col("ubigeo").alias("code"))
    return watch.watch_alerts(rows.filter(seq != "14"), e, rows, declared, 0, 1)


@query(""", t AS (SELECT prov, max(seq) AS m, count(*) AS n FROM dist GROUP BY 1), e AS (SELECT x.*, m, n, row_number() OVER (PARTITION BY x.prov ORDER BY ubigeo) AS r FROM dist x JOIN t USING (prov))
SELECT ubigeo AS entry, prov, nombre, CASE WHEN seq = 3 THEN prov || lpad((m + r)::varchar, 2, '0') ELSE ubigeo END AS code, prov || lpad((m + r)::varchar, 2, '0') AS rule, CASE WHEN seq = 3 THEN 'rule' ELSE 'official' END AS origin, seq = 3 AS provisional, CASE WHEN seq = 3 THEN 'ambiguous official code' ELSE 'in use' END AS status FROM e
UNION ALL SELECT ubigeo || 'x', prov, nombre || ' X', prov || lpad((m + r + s3)::varchar, 2, '0'), prov || lpad((m + r + s3)::varchar, 2, '0'), 'rule', true, 'ok' FROM e
UNION ALL SELECT prov || 'z' || z, prov, z, CASE z WHEN 'z1' THEN prov || '95' ELSE prov || '96' END, prov || CASE z WHEN 'z1' THEN lpad((m + n + h + 1)::varchar, 2, '0') WHEN 'z2' THEN '96' ELSE '97' END, CASE z WHEN 'z2' THEN 'rule' ELSE 'forced' END, z = 'z2', CASE z WHEN 'z3' THEN 'in use' ELSE 'ok' END FROM (SELECT prov, m, n, (SELECT count(*) FROM dist q WHERE q.prov = t.prov AND q.seq = 3) AS h, unnest(['z1', 'z2', 'z3']) AS z FROM t)""".replace("m + r)", "m + r + CASE WHEN seq > 3 AND has3 THEN 1 ELSE 0 END)").replace("r + s3)", "r + CASE WHEN seq >= 3 AND has3 THEN 1 ELSE 0 END)").replace("AS r FROM dist x", "AS r, exists(SELECT 1 FROM dist q WHERE q.prov = x.prov AND q.seq = 3) AS has3 FROM dist x"))
def resolve_codes(s, d):
    """Every district, in use under its official code (one of each province has two), a new name after each, and forced codes at the end of each province."""
    rows = _districts(s, d)
    null = F.lit(None).cast("string")
    e = rows.select(F.col("ubigeo").alias("entry"), F.substring("ubigeo", 1, 4).alias("prov"), "nombre", null.alias("forced"), null.alias("declared"))
    new = e.select(F.concat("entry", F.lit("x")).alias("entry"), "prov", F.concat("nombre", F.lit(" X")).alias("nombre"), "forced", "declared")
    z = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.lit(c).cast("string").alias("c")) for n, c in (("z1", "95"), ("z2", None), ("z3", "96"))])).alias("z")
    last = e.select("prov").distinct().select("prov", z).select(F.concat("prov", F.lit("z"), "z.n").alias("entry"), "prov", F.col("z.n").alias("nombre"), F.concat("prov", "z.c").alias("forced"), null.alias("declared"))
    cat = _cat(s, d)
    twice = cat.unionByName(cat.filter("nivel = 'distrito' AND ubigeo LIKE '%03'").withColumn("ubigeo", F.concat(F.substring("ubigeo", 1, 4), F.lit("97"))))
    return codes.resolve_codes(e.unionByName(new).unionByName(last), twice, rows, s.createDataFrame([], "ubigeo string"))


_NET = "GROUP BY ALL HAVING sum(CASE WHEN ahead THEN 1 ELSE -1 END) <> 0"


@query(f", ch AS (SELECT code[1:10] AS code, x1, y1, x2, y2 FROM und WHERE code NOT LIKE '%01' {_NET}), pa AS (SELECT code[1:10] AS code, x1, y1, x2, y2 FROM und {_NET}) SELECT code, 'children' AS side, count(*) AS segments FROM (SELECT * FROM ch EXCEPT SELECT * FROM pa) GROUP BY 1 UNION ALL SELECT code, 'parents', count(*) FROM (SELECT * FROM pa EXCEPT SELECT * FROM ch) GROUP BY 1")
def closure(s, d):
    """Districts without the first of each province against the outlines of all."""
    seg = _segments(s, d)
    return geometry.closure(seg.filter("code NOT LIKE '%01'"), seg, 10)


@query("SELECT d.ubigeo, d.nombre, r_name AS nombre_departamento, CASE WHEN d.dep <> '04' THEN n_name END AS nombre_provincia FROM dist d")
def attach_parent_names(s, d):
    """Names of departments, and of provinces but for those of one department, which are missing."""
    parents = frames.units(s, d).filter("nivel <> 'distrito' AND (nivel = 'departamento' OR ubigeo NOT LIKE '04%')")
    return layers.attach_parent_names(_districts(s, d).select("ubigeo", "nombre"), parents)


@query("SELECT dep AS ccdd, prov[3:4] || CASE WHEN seq = 3 THEN 'x' ELSE ' ' END AS ccpp, ubigeo[5:6] AS ccdi, CASE WHEN seq <> 3 THEN ubigeo END AS ubigeo FROM dist")
def compose_code(s, d):
    """Codes from three columns, of which some hold a blank or a letter."""
    code = F.col("ubigeo")
    tail = F.when(code.endswith("03"), F.lit("x")).otherwise(F.lit(" "))
    parts = _districts(s, d).select(F.substring(code, 1, 2).alias("ccdd"), F.concat(F.substring(code, 3, 2), tail).alias("ccpp"), F.substring(code, 5, 2).alias("ccdi"))
    return layers.compose_code(parts, "ccdd", "ccpp", "ccdi")


@query("SELECT 'ubigeo' AS name, count(DISTINCT ubigeo) AS codes FROM dist")
def detect_code_column(s, d):
    """Among names, codes of six digits, and six digits that repeat."""
    rows = _districts(s, d).select("nombre", F.concat(F.lit("0000"), F.substring("ubigeo", 1, 2)).alias("other"), "ubigeo")
    return layers.detect_code_column(rows, 6)


@query("SELECT coalesce(l, nivel) AS nivel, coalesce(e, 0) AS announced, coalesce(n, 0) AS delivered, coalesce(e = n, false) AS ok FROM (VALUES ('departamento', 5::bigint), ('provincia', 24), ('centro', 3)) x(l, e) FULL JOIN (SELECT nivel, count(*) AS n FROM units GROUP BY 1) ON l = nivel")
def count_reconcile(s, d):
    return layers.count_reconcile(s.createDataFrame([("departamento", 5), ("provincia", 24), ("centro", 3)], "nivel string, announced long"), frames.units(s, d))


@query("SELECT a, b, CASE WHEN b[11:12] = '02' AND a[11:12] = '01' AND a[1:10] = b[1:10] THEN 'Ley ' || a[1:10] END AS ley, CASE WHEN ley IS NULL THEN 'oficial' ELSE 'derivado' END AS fuente FROM (SELECT DISTINCT a, b FROM own WHERE n_owners = 2)")
def arc_provenance(s, d):
    """Borders of neighbours, where the second parcel of each block was cut from the first."""
    block = F.substring("code", 1, 10)
    entries = frames.parcels(s, d).filter("code LIKE '%02'").select(F.concat(block, F.lit("01")).alias("parent"), F.col("code").alias("child"), F.concat(F.lit("Ley "), block).alias("ley"))
    return layers.arc_provenance(geometry.adjacency(_owners(s, d)).select("a", "b"), entries)


@query(f"SELECT code, own, stored, lft AS left, rgt AS right, 0 AS faults FROM (SELECT code, round(sum({_LEN}), 3) AS own FROM seg GROUP BY 1) JOIN (SELECT code, round(sum(len), 3) AS stored, round(sum(CASE WHEN left_code = code THEN len ELSE 0 END), 3) AS lft, round(sum(CASE WHEN right_code = code THEN len ELSE 0 END), 3) AS rgt FROM (SELECT unnest([a, b]) AS code, left_code, right_code, {_LEN} AS len FROM own) WHERE code IS NOT NULL GROUP BY 1) USING (code)")
def arc_integrity(s, d):
    return layers.arc_integrity(_owners(s, d), _segments(s, d))


_T = "least(1.0, greatest(0.0, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1))::double / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))))"


@query(f", near AS (SELECT a, b, x1, y1, x2, y2 FROM own WHERE n_owners = 2), dd AS (SELECT a, b, k, min(sqrt(pow(x - x1 - t * (x2 - x1), 2) + pow(y - y1 - t * (y2 - y1), 2))) AS d FROM (SELECT near.*, k, x, y, {_T} AS t FROM near JOIN v ON v.code = a) GROUP BY ALL) SELECT a, b, count(*) AS n, round(min(d), 3) AS least, round(avg(d), 3) AS mean, round(max(d), 3) AS most FROM dd GROUP BY 1, 2")
def point_arc_distance(s, d):
    """All vertices of each unit against its border with each neighbour."""
    owners = _owners(s, d)
    v = frames.parcels(s, d).select("code", F.posexplode("vertices").alias("id", "v"))
    points = geometry.adjacency(owners).select("a", "b").join(tables.shuffled(v), F.col("a") == F.col("code")).select("id", "a", "b", "v.x", "v.y")
    found = rays.point_arc_distance(points, owners)
    return found.select("a", "b", "n", *[F.round(c, 3).alias(c) for c in ("least", "mean", "most")])


@query("SELECT id, hits, round(t * sqrt(10.0), 3) AS distance FROM (SELECT c.code AS id, count(*) AS hits, max(((x1 - x) * (y2 - y1) - (y1 - y) * (x2 - x1))::double / (3 * (y2 - y1) - (x2 - x1))) AS t FROM (SELECT code, gx * 4000 + 2000 AS x, gy * 4000 + 2000 AS y FROM cell) c JOIN seg USING (code) WHERE (3 * (y1 - y) - (x1 - x) >= 0) <> (3 * (y2 - y) - (x2 - x) >= 0) AND ((x1 - x) * (y2 - y1) - (y1 - y) * (x2 - x1))::double / (3 * (y2 - y1) - (x2 - x1)) > 0 GROUP BY 1)")
def ray_exits(s, d):
    """Rays from the middle of each cell, three steps east for each step north."""
    corner = F.col("vertices")[0]
    middle = lambda c: (F.round(corner[c] / 4000) * 4000 + 2000).cast("long").alias(c)
    start = frames.parcels(s, d).select(F.col("code").alias("id"), "code", middle("x"), middle("y"), F.lit(3).alias("dx"), F.lit(1).alias("dy"))
    return rays.ray_exits(start, _segments(s, d)).select("id", "hits", F.round("distance", 3).alias("distance"))


@query("SELECT ubigeo, nombre AS name, unnest(list_filter([CASE WHEN seq % 3 = 0 AND seq % 9 <> 0 THEN 'replaced stretch without approximate confidence' END, CASE WHEN seq % 3 = 0 AND seq % 9 <> 0 THEN 'replaced stretch without warning' END, CASE WHEN seq % 3 = 1 AND seq * 10 >= 200 THEN 'coincident stretch too far off' END, CASE WHEN seq % 7 = 0 THEN 'no decision' END], lambda z: z IS NOT NULL)) AS rule FROM dist")
def reused_stretch_rules(s, d):
    """A stretch for each district; every ninth district is approximate and warns."""
    seq = F.substring("ubigeo", 5, 2).cast("int")
    rows = _districts(s, d)
    stretches = rows.select("ubigeo", F.col("nombre").alias("name"), F.when(seq % 3 == 0, "sustituido").when(seq % 3 == 1, "coincidente").otherwise("otro").alias("kind"), F.when(seq % 7 != 0, "visto").alias("decision"), (seq * 10).alias("most"))
    units = rows.select("ubigeo", F.when(seq % 9 == 0, "aproximado").otherwise("oficial").alias("confianza"), F.when(seq % 9 == 0, "aviso").alias("advertencia"))
    return rays.reused_stretch_rules(stretches, units)


@query("SELECT code, count(*) AS points FROM v GROUP BY 1")
def feature_lines(s, d):
    """Each parcel as a line of GeoJSON, in degrees on the grid; the points of a line are counted."""
    degrees = F.transform("vertices", lambda v: F.struct((v["x"] / 1e7).alias("lon"), (v["y"] / 1e7).alias("lat")))
    lines = features.feature_lines(frames.parcels(s, d).select("code", F.lit(0).alias("part"), "ring", degrees.alias("vertices")))
    return lines.select("code", F.size(F.from_json(F.get_json_object("line", "$.geometry.coordinates[0][0]"), "array<array<double>>")).cast("long").alias("points"))


@query("SELECT DISTINCT dep AS source, CASE WHEN upper(n_name) = 'CHINA' THEN 'provincia' END AS nivel, CASE WHEN upper(n_name) = 'CHINA' THEN 'CHINA' END AS bare FROM d WHERE upper(n_name) = 'CHINA' UNION ALL SELECT dep, 'distrito', norm FROM dist WHERE nombre = 'San José Alto'")
def apply_aliases(s, d):
    """Rows that the catalogue calls otherwise, under its names."""
    aliases = s.createDataFrame(list(frames.ALIASES), "nivel string, bare string, alias string")
    rows = census.classified_rows(frames.sheet(s, d))
    renamed = census.apply_aliases(rows.join(aliases.select("nivel", "bare"), ["nivel", "bare"], "left_semi"), aliases)
    return renamed.select("source", "nivel", "bare")


@query("SELECT DISTINCT dep AS source, 'PROV. CONSTITUCIONAL' AS bare, 'ASIA 0' AS dep FROM d WHERE r_name = 'ASIA 0'")
def apply_blocks(s, d):
    """Rows at the top that are no departments."""
    blocks = s.createDataFrame([(frames.BLOCK_OF[0], frames.BLOCK_OF[1], None)], "bare string, dep string, prov string")
    found = census.apply_blocks(census.classified_rows(frames.sheet(s, d)), blocks).filter("block IS NOT NULL")
    return found.select("source", "bare", "block.dep")


@query(f"SELECT round(sum(len), 1) AS stored, round(sum(len * n_owners), 1) AS perimeters, round(1 - sum(len) / sum(len * n_owners), 6) AS saved FROM (SELECT n_owners, {_LEN} AS len FROM own)")
def border_saving(s, d):
    """What storing each border once saves."""
    return geometry.border_saving(_owners(s, d)).select(F.round("stored", 1).alias("stored"), F.round("perimeters", 1).alias("perimeters"), "saved")


@query("SELECT ubigeo FROM units WHERE ubigeo LIKE '0203%' OR '0203' LIKE ubigeo || '%'")
def in_focus(s, d):
    """Units under a province and above it."""
    return frames.units(s, d).filter(C.in_focus(F.col("ubigeo"), "0203")).select("ubigeo")


@query("SELECT count(value) AS with_value, count(*) - count(value) AS without_value FROM units LEFT JOIN pop USING (ubigeo)")
def indicator_counts(s, d):
    return indicators.indicator_counts(indicators.attach_indicator(frames.units(s, d), frames.population(s, d)))


@query("SELECT code AS ubigeo, sum(x1 * y2 - x2 * y1) / 2 AS value FROM seg GROUP BY 1")
def area_indicator(s, d):
    """Without values, areas are the indicator."""
    areas = geometry.polygon_measures(_segments(s, d)).select("code", "area2")
    return indicators.attach_indicator(frames.parcels(s, d).select(F.col("code").alias("ubigeo")), None, areas)


@query("SELECT measure, 'distrito' AS level, ubigeo[1:2] AS parent, '{' || string_agg('\"' || ubigeo || '\":' || CASE WHEN value IS NULL THEN 'null' ELSE (value / 4)::decimal(18, 2)::varchar END, ',' ORDER BY ubigeo) || '}' AS json FROM long GROUP BY ALL")
def indicator_lines(s, d):
    return indicators.indicator_lines(_long(s, d).withColumn("value", (F.col("value") / 4).cast("decimal(18,2)")))


@query("SELECT ubigeo, nombre, prov AS ubigeo_provincia, n_name AS nombre_provincia, dep AS ubigeo_departamento, r_name AS nombre_departamento, CASE WHEN l THEN 'derivado' ELSE 'INEI' END AS fuente, CASE WHEN l THEN 'Ley ' || ubigeo END AS ley_creacion, CASE WHEN l THEN '2020-01-01' END AS fecha_creacion, CASE WHEN l THEN 'corte de ' || prov ELSE 'publicado por el INEI (WFS Interoperabilidad)' END AS metodo, CASE WHEN l THEN CASE WHEN seq % 2 = 0 THEN 'aproximado' ELSE 'reconstruido' END ELSE 'oficial' END AS confianza, l AND seq % 4 <> 1 AS ubigeo_provisional, CASE WHEN l AND seq % 4 = 1 THEN 'registro' END AS ubigeo_fuente, CASE WHEN l AND seq % 3 = 0 THEN 'falta un tramo' END AS advertencia, CASE WHEN seq = 2 THEN 'zz' ELSE dep END AS ccdd, prov[3:4] AS ccpp, ubigeo[5:6] AS ccdi, CASE WHEN seq % 5 = 1 THEN nombre ELSE upper(nombre) END AS nombdist, CASE WHEN seq <> 4 THEN 'mapa' END AS fuente_inei, '2023' AS periodo, NULL AS ccdd_c, NULL AS ccpp_c, NULL AS ccdi_c, CASE WHEN seq <> 5 THEN '2023-01-01' END AS fec_reg FROM (SELECT *, seq % 7 = 1 OR seq % 7 = 2 AS l FROM dist)")
def district_props(s, d):
    """Two of seven districts were made by law; blank attributes count as missing."""
    seq = F.substring("ubigeo", 5, 2).cast("int")
    law = F.struct(
        F.concat(F.lit("Ley "), "ubigeo").alias("ley"), F.lit("2020-01-01").alias("fecha_creacion"), F.concat(F.lit("corte  de\n "), F.substring("ubigeo", 1, 4)).alias("metodo"), F.when(seq % 2 == 0, "aproximado").otherwise("").alias("confianza"),
        F.when(seq % 3 == 0, " falta un\n tramo").alias("advertencia"), F.lit(None).cast("string").alias("ubigeo"), F.when(seq % 4 == 1, F.col("ubigeo")).alias("ubigeo_oficial_confirmado"), F.lit(" registro ").alias("fuente_del_ubigeo"),
    )
    raw = {"ccdd": F.when(seq == 2, "zz").otherwise(""), "ccpp": F.lit(None).cast("string"), "ccdi": F.lit(""), "nombdist": F.when(seq % 5 != 1, F.upper("nombre")).otherwise(""), "fuente": F.when(seq != 4, "mapa").otherwise(""), "periodo": F.lit("2023"), "ccdd_c": F.lit(""), "ccpp_c": F.lit(""), "ccdi_c": F.lit(None).cast("string"), "fec_reg": F.when(seq != 5, "2023-01-01").otherwise("")}
    u = frames.units(s, d)
    rows = _districts(s, d).select("ubigeo", "nombre", F.when((seq % 7).isin(1, 2), law).alias("derivado"), *[c.alias(k) for k, c in raw.items()])
    return layers.district_props(rows, u.filter("nivel <> 'distrito'"))


@query("SELECT DISTINCT prov AS ubigeo, n_name AS nombre, dep AS ubigeo_departamento, r_name AS nombre_departamento, 'INEI' AS fuente, 'oficial' AS confianza, 'publicado por el INEI (WFS Interoperabilidad)' AS metodo, dep AS ccdd, prov[3:4] AS ccpp, n_name AS nombprov, 'mapa' AS fuente_inei, '2023' AS periodo, NULL AS fec_reg FROM d")
def province_props(s, d):
    u = frames.units(s, d)
    raw = u.filter("nivel = 'provincia'").select("ubigeo", F.col("nombre").alias("nombprov"), F.substring("ubigeo", 1, 2).alias("ccdd"), F.substring("ubigeo", 3, 2).alias("ccpp"), F.lit("mapa").alias("fuente"), F.lit("2023").alias("periodo"), F.lit(None).cast("string").alias("fec_reg"))
    return layers.province_props(raw, u)


@query("SELECT DISTINCT dep AS ubigeo, r_name AS nombre, 'INEI' AS fuente, 'oficial' AS confianza, 'publicado por el INEI (WFS Interoperabilidad)' AS metodo, dep AS ccdd, r_name AS nombdep, 'mapa' AS fuente_inei, '2023' AS periodo, NULL AS fec_reg FROM d")
def department_props(s, d):
    u = frames.units(s, d).filter("nivel = 'departamento'")
    raw = u.select("ubigeo", F.col("nombre").alias("nombdep"), F.col("ubigeo").alias("ccdd"), F.lit("mapa").alias("fuente"), F.lit("2023").alias("periodo"), F.lit(None).cast("string").alias("fec_reg"))
    return layers.department_props(raw)


@query("SELECT event_id, round(x * 1e7)::bigint AS x, round(y * 1e7)::bigint AS y FROM (SELECT event_id, (event_id * 7919 % 400000) / 3e5 AS x, (event_id * 104729 % 600000) / 7e5 AS y FROM events)")
def round_grid(s, d):
    e = s.read.parquet(f"{d}/events.parquet").select("event_id", ((F.col("event_id") * 7919 % 400_000) / 3e5).alias("x"), ((F.col("event_id") * 104729 % 600_000) / 7e5).alias("y"))
    return e.select("event_id", geometry.round_grid(F.col("x"), F.col("y")).alias("p")).select("event_id", "p.x", "p.y")


@query("SELECT ubigeo, round(value / NULLIF(seq % 4, 0), 6) AS density FROM pop JOIN dist USING (ubigeo)")
def density(s, d):
    """Figures against an area that is 0 for a fourth of the units."""
    return frames.population(s, d).select("ubigeo", F.round(C.density(F.col("value").cast("double"), F.substring("ubigeo", 5, 2).cast("int") % 4), 6).alias("density"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'norte' WHEN 1 THEN 'suroeste' WHEN 2 THEN 'nada' END AS bearing, round(CASE event_id % 4 WHEN 0 THEN 0 WHEN 1 THEN -sqrt(0.5) WHEN 3 THEN dx / sqrt(dx * dx + dy * dy) END, 9) AS x, round(CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN -sqrt(0.5) WHEN 3 THEN dy / sqrt(dx * dx + dy * dy) END, 9) AS y FROM (SELECT event_id, (event_id % 13 - 6)::double AS dx, (event_id % 7 + 1)::double AS dy FROM events)")
def bearing_vector(s, d):
    """Two bearings, one that is unknown, and straight on."""
    k = F.col("event_id") % 4
    e = s.read.parquet(f"{d}/events.parquet").select("event_id", F.when(k == 0, "norte").when(k == 1, "suroeste").when(k == 2, "nada").alias("bearing"), (F.col("event_id") % 13 - 6).cast("double").alias("dx"), (F.col("event_id") % 7 + 1).cast("double").alias("dy"))
    v = rays.bearing_vector(F.col("bearing"), F.col("dx"), F.col("dy"))
    return e.select("event_id", "bearing", F.round(v["x"], 9).alias("x"), F.round(v["y"], 9).alias("y"))


@query(f"SELECT code AS id, seq, j, round(x1 + (x2 - x1) * j / n, 6) AS x, round(y1 + (y2 - y1) * j / n, 6) AS y FROM (SELECT *, unnest(range(n)) AS j FROM (SELECT *, greatest(1, ceil({_LEN} / 700))::bigint AS n FROM seg)) UNION ALL SELECT code, 16, 0, x2::double, y2::double FROM seg WHERE seq = 15")
def densify(s, d):
    """Outlines with a point each 700 units."""
    lines = _segments(s, d).select(F.col("code").alias("id"), "seq", "x1", "y1", "x2", "y2")
    found = geometry.densify(lines, 700)
    return found.select("id", F.col("seq").cast("long").alias("seq"), F.col("j").cast("long").alias("j"), F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query(_albers_sql())
def to_albers(s, d):
    e = _degrees(s, d)
    x, y = C.albers(F.col("lon"), F.col("lat"))
    return e.select("event_id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query("SELECT event_id, round(lon, 7) AS lon, round(lat, 7) AS lat, true AS north FROM (SELECT event_id, (event_id * 7919 % 60000) / 10000.0 - 78 AS lon, (event_id * 104729 % 180000) / 10000.0 - 18.5 AS lat FROM events)")
def utm_round_trip(s, d):
    """Degrees to zone 18 and back."""
    e = _degrees(s, d).withColumn("lon", (F.col("event_id") * 7919 % 60_000) / 10_000.0 - 78)
    there = e.select("event_id", *[c.alias(k) for c, k in zip(C.utm(F.col("lon"), F.col("lat"), 18), ("e", "n"))])
    lon, lat = C.from_utm(F.col("e"), F.col("n"), 18)
    return there.select("event_id", F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"), F.col("n").between(7_500_000, 10_000_000).alias("north"))


#: Walks along the segments of a pair from each node to the next; r: the way is turned round where it ends at the lesser end.
_WALK = f"""en AS (SELECT a, coalesce(b, '') AS b, x1 AS x, y1 AS y, x2 AS ox, y2 AS oy, left_code AS l, right_code AS r, {_LEN} AS len FROM own UNION ALL SELECT a, coalesce(b, ''), x2, y2, x1, y1, right_code, left_code, {_LEN} FROM own),
nd AS (SELECT x, y FROM en GROUP BY ALL HAVING count(*) <> 2 OR count(DISTINCT (a, b)) > 1),
wk(a, b, x0, y0, sx, sy, px, py, x, y, n, l, r, len, path) AS (SELECT a, b, x, y, ox, oy, x, y, ox, oy, 1, l, r, len, x || ' ' || y || ',' || ox || ' ' || oy FROM en SEMI JOIN nd USING (x, y)
  UNION ALL SELECT w.a, w.b, x0, y0, sx, sy, w.x, w.y, e.ox, e.oy, n + 1, w.l, w.r, w.len + e.len, path || ',' || e.ox || ' ' || e.oy FROM (SELECT * FROM wk ANTI JOIN nd USING (x, y)) w JOIN en e ON e.a = w.a AND e.b = w.b AND e.x = w.x AND e.y = w.y AND (e.ox <> w.px OR e.oy <> w.py)),
ar AS (SELECT * FROM wk SEMI JOIN nd USING (x, y) WHERE (x0, y0, sx, sy) < (x, y, px, py))"""


@query(f", RECURSIVE {_WALK} SELECT a, nullif(b, '') AS b, CASE WHEN b = '' THEN 'exterior' ELSE 'interdistrital' END AS tipo, row_number() OVER (PARTITION BY a, b ORDER BY x0, y0, sx, sy) - 1 AS arc, l AS izquierda, r AS derecha, round(len, 2) AS length, path FROM ar")
def boundary_arcs(s, d):
    """Arcs of each pair of neighbours, and of each unit with the outside, with their points in order."""
    found = arcs.boundary_arcs(_owners(s, d)).filter("lado_resuelto")
    path = F.array_join(F.transform("vertices", lambda v: F.concat_ws(" ", v["x"], v["y"])), ",")
    return found.select("a", "b", "tipo", "arc", "izquierda", "derecha", F.round("length", 2).alias("length"), path.alias("path"))


@query("SELECT a, b, count(*) AS segments FROM own WHERE n_owners = 2 AND left_code IS NOT NULL AND right_code IS NOT NULL AND left_code <> right_code GROUP BY 1, 2")
def arc_sides(s, d):
    """Segments of shared arcs whose two sides are the two owners."""
    shared = arcs.boundary_arcs(_owners(s, d)).filter("tipo = 'interdistrital' AND lado_resuelto AND least(izquierda, derecha) = a AND greatest(izquierda, derecha) = b")
    return shared.groupBy("a", "b").agg(F.sum(F.size("vertices") - 1).alias("segments"))


@query("SELECT row_number() OVER (ORDER BY a, coalesce(b, ''), min_x, min_y) AS place, a, b FROM (SELECT a, b, min(least(x1, x2)) AS min_x, min(least(y1, y2)) AS min_y FROM own WHERE n_owners = 2 GROUP BY 1, 2)")
def arc_sort(s, d):
    """Shared arcs numbered in their order; each pair of parcels has one."""
    shared = arcs.boundary_arcs(_owners(s, d).filter("n_owners = 2"))
    pairs = shared.groupBy("a", "b").agg(F.min("min_x").alias("min_x"), F.min("min_y").alias("min_y"))
    return order.numbered(pairs, "a", F.coalesce("b", F.lit("")), "min_x", "min_y").select("place", "a", "b")


#: A place of a block without its parcel, and a ring of eight such places around a parcel that stays.
_LONE, _RING = ("22",), ("44", "45", "46", "54", "56", "64", "65", "66")


@query(f", gone AS (SELECT code[1:10] AS block, code[11:12] = '22' AS lone, sum(x1 * y2 - x2 * y1)::bigint AS area2, count(DISTINCT code) AS parcels FROM seg WHERE code[11:12] IN {_LONE + _RING} AND (SELECT max(gy) FROM cell WHERE gx = 99) > code[1:8]::int * 10 + CASE WHEN code[11:12] = '22' THEN 2 ELSE 6 END GROUP BY 1, 2) SELECT area2, CASE WHEN lone THEN 16 ELSE 64 END AS n, CASE WHEN area2 <= 32000000 THEN 'sliver' ELSE 'hole' END AS kind FROM gone")
def coverage_holes(s, d):
    """Without one parcel in each block, and without eight around one that stays as an island in their place."""
    seg = _segments(s, d).filter(~F.substring("code", 11, 2).isin(*_LONE, *_RING))
    return overlay.coverage_holes(seg, 32_000_000).select("area2", "n", "kind")


@query(", nt AS (SELECT code[1:10] AS code, x1, y1, x2, y2 FROM und GROUP BY ALL HAVING sum(CASE WHEN ahead THEN 1 ELSE -1 END) <> 0), lo AS (SELECT code, min(least((x1, y1), (x2, y2))) AS p, count(*) AS n FROM nt GROUP BY 1) SELECT code, p[1] AS x, p[2] AS y, area2, n FROM lo JOIN (SELECT code[1:10] AS code, sum(x1 * y2 - x2 * y1)::bigint AS area2 FROM seg GROUP BY 1) USING (code)")
def dissolve_rings(s, d):
    """Each block's outline, which is one ring: its least point, area and number of segments."""
    return overlay.ring_areas(geometry.dissolve(_segments(s, d), 10)).select("code", "x", "y", F.col("area2").cast("long").alias("area2"), "n")


@query("SELECT code[1:10] AS code, round(sum(CASE WHEN code LIKE '%01' OR code LIKE '%33' THEN (x1 * y2 - x2 * y1) / 2 ELSE 0 END), 1) AS area FROM seg GROUP BY 1 HAVING sum(CASE WHEN code LIKE '%01' OR code LIKE '%33' THEN 1 ELSE 0 END) > 0")
def closure_diff(s, d):
    """Parcels that lack one of each block against blocks that lack another."""
    seg = _segments(s, d)
    return overlay.closure_diff(seg.filter("code NOT LIKE '%01'"), seg.filter("code NOT LIKE '%33'"), 10, 1.0).select("code", F.round("area", 1).alias("area"))


@query("SELECT round(sum(CASE WHEN code LIKE '%33' THEN (x1 * y2 - x2 * y1) / 2 ELSE 0 END), 0) AS area, false AS ok FROM seg")
def national_gap(s, d):
    """The union of parcels without one of each block against that of all."""
    seg = _segments(s, d)
    return overlay.national_gap(seg.filter("code NOT LIKE '%33'"), seg, 1.0).select(F.round("area", 0).alias("area"), "ok")


@query("SELECT code AS a, code[1:10] || '99' || code[11:12] AS b, round(sum((x1 * y2 - x2 * y1) / 2), 1) AS area FROM seg WHERE code LIKE '%33' GROUP BY code")
def overlaps(s, d):
    """One parcel of each block stands under two codes; its copy overlaps it alone."""
    p = frames.parcels(s, d)
    twice = p.filter("code LIKE '%33'").withColumn("code", F.concat(F.substring("code", 1, 10), F.lit("99"), F.substring("code", 11, 2)))
    return overlay.overlaps(p.unionByName(twice), 4000, 1.0).select("a", "b", F.round("area", 1).alias("area"))


#: Between a side's five points and the chord of its corners: places along the chord and cross products, in pairs; then the areas of their trapezoids.
_SIDE = """, sd AS (SELECT p.code, p.k AS k, p.x, p.y, c.x AS cx, c.y AS cy, e.x - c.x AS dx, e.y - c.y AS dy FROM v c JOIN v e ON e.code = c.code AND e.k = c.k + 4 JOIN v p ON p.code = c.code AND p.k BETWEEN c.k AND e.k WHERE c.k % 4 = 0),
ct AS (SELECT code, k, cx, cy, ((x - cx) * dx + (y - cy) * dy)::double / (dx * dx + dy * dy) AS t, (dx * (y - cy) - dy * (x - cx))::double AS c FROM sd),
tp AS (SELECT code, lead(t) OVER w - t AS dt, abs(c) AS a, abs(lead(c) OVER w) AS b, c * lead(c) OVER w < 0 AS over FROM ct WINDOW w AS (PARTITION BY code, cx, cy ORDER BY k)),
dev AS (SELECT sum(CASE WHEN over THEN dt * (a * a + b * b) / (2 * (a + b)) ELSE dt * (a + b) / 2 END) AS moved FROM tp WHERE dt IS NOT NULL AND code NOT LIKE '%33' AND code NOT LIKE '%34'),
quad AS (SELECT a.code, sum(a.x * b.y - b.x * a.y) AS area2 FROM v a JOIN v b ON a.code = b.code AND b.k = a.k + 4 WHERE a.k % 4 = 0 GROUP BY 1),
hl AS (SELECT count(*) AS n, coalesce(sum(area2), 0) / 2 AS area FROM quad WHERE code LIKE '%33' AND code[1:8]::int * 10 + 3 < (SELECT max(gy) FROM cell WHERE gx = 99)),
sz AS (SELECT sum(12 + length(x::varchar || y::varchar)) + 1 * count(DISTINCT code) AS f, sum(12 + length(x::varchar || y::varchar)) FILTER (WHERE k % 4 = 0 AND code NOT LIKE '%33') + count(DISTINCT code) FILTER (WHERE code NOT LIKE '%33') AS s FROM v),
nn AS (SELECT count(*) AS n, count(*) FILTER (WHERE code LIKE '%33') AS n33, count(*) FILTER (WHERE code LIKE '%34') AS n34 FROM cell)
SELECT measure, round(value::double, 6) AS value FROM (SELECT unnest(['lost', 'added', 'vertices kept', 'deviation', 'area moved', 'faults', 'overlaps', 'overlap area', 'holes', 'hole area', 'size']) AS measure,
  unnest([n33 + n34, n34, (n - n33) / (4.0 * n), round(moved, 1), 2 * moved / (SELECT sum(x1 * y2 - x2 * y1) FROM seg), 0, 0, 0, (SELECT n FROM hl), (SELECT area FROM hl), (SELECT s / f FROM sz)]::double[]) AS value FROM nn, dev)"""


@query(_SIDE)
def simplify_audit(s, d):
    """Parcels against their corners alone, of which one in each block is missing and one has another code."""
    p = frames.parcels(s, d)
    corners = p.filter("code NOT LIKE '%33'").select(F.when(F.col("code").endswith("34"), F.concat(F.substring("code", 1, 10), F.lit("9934"))).otherwise(F.col("code")).alias("code"), "ring", F.filter("vertices", lambda v, i: i % 4 == 0).alias("vertices"))
    return arcs.simplify_audit(p, corners).select("measure", F.round(F.when(F.col("measure") == "deviation", F.round("value", 1)).otherwise(F.col("value")), 6).alias("value"))


@query(f", RECURSIVE {_WALK} SELECT v.code, string_agg(x || ' ' || y, ',' ORDER BY k) AS path FROM v SEMI JOIN nd USING (x, y) WHERE k < 16 GROUP BY 1")
def simplify_layer(s, d):
    """With no bound on what may go, only the points stay at which borders meet."""
    found = arcs.simplify_layer(frames.parcels(s, d), 1e9)
    v = F.col("vertices")
    return found.select("code", F.array_join(F.transform(F.slice(v, 1, F.size(v) - 1), lambda p: F.concat_ws(" ", p["x"], p["y"])), ",").alias("path"))


def _cut_entries(s: SparkSession, d: str) -> DataFrame:
    """A law for one parcel of each block: a line up its middle, prolonged at both ends, and a point to its left."""
    digits = lambda a, n: F.substring("code", a, n).cast("double")
    x, y = (digits(9, 2) * 10 + digits(12, 1)) * 4000, (digits(1, 8) * 10 + digits(11, 1)) * 4000
    at = lambda dx, dy: F.struct((x + dx).alias("x"), (y + dy).alias("y"))
    rows = frames.parcels(s, d).filter("code LIKE '%44'")
    return rows.select(F.concat(F.lit("ley "), "code").alias("entry"), "code", F.array(at(2000, 1500), at(2000, 2500)).alias("points"), F.lit("sur").alias("start_bearing"), F.lit(4000).alias("start_max"), F.lit("continuar").alias("end_bearing"), F.lit(2500).alias("end_max"), (x + 1000).alias("px"), (y + 2000).alias("py"))


def _cut(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    e = _cut_entries(s, d)
    p = frames.parcels(s, d).withColumn("part", F.lit(0))
    parents = frames.parcels(s, d).join(tables.few(tables.stored(e.select("code").distinct()), cuts.CODES), "code", "left_semi")
    lines = tables.stored(cuts.build_cut_lines(e, geometry.ring_segments(parents)).join(e.select("entry", "px", "py"), "entry"))
    return lines, tables.stored(cuts.cut_parents(lines, p)), p


#: Twice the area left of a line x = c, by the integral of min(x, c) over y along each segment.
_LEFT = "2 * (y2 - y1) * CASE WHEN greatest(x1, x2) <= c THEN (x1 + x2) / 2.0 WHEN least(x1, x2) >= c THEN c ELSE ((c - least(x1, x2)) * (least(x1, x2) + c) / 2.0 + (greatest(x1, x2) - c) * c) / (greatest(x1, x2) - least(x1, x2)) END"
_CUT = f", k AS (SELECT code, gx * 4000 + 2000 AS c FROM cell WHERE code LIKE '%44'), ca AS (SELECT code, sum({_LEFT}) AS l, sum(x1 * y2 - x2 * y1) AS w FROM seg JOIN k USING (code) GROUP BY 1)"


@query(f"{_CUT} SELECT 'ley ' || code AS entry, code, true AS prolonged, 1 AS end_hits, 'ok' AS status FROM ca")
def build_cut_lines(s, d):
    lines = _cut(s, d)[0]
    return lines.select("entry", "code", (F.size("line") == 4).alias("prolonged"), "end_hits", "status")


@query(f"{_CUT} SELECT 'ley ' || code AS entry, unnest(['new', 'rest']) AS piece, unnest([round(l / 2, 2), round((w - l) / 2, 2)]) AS area FROM ca")
def cut_parents(s, d):
    pieces = _cut(s, d)[1].filter("piece IS NOT NULL")
    area = geometry.polygon_measures(geometry.ring_segments(pieces.select(F.concat_ws("|", "entry", "piece").alias("code"), "ring", "vertices")))
    return area.select(F.split("code", r"\|")[0].alias("entry"), F.split("code", r"\|")[1].alias("piece"), F.round(F.col("area2") / 2, 2).alias("area"))


@query(f"{_CUT} SELECT 'ley ' || code AS entry, code, round(w / 2, 2) AS before, round(l / 2, 2) AS new, round((w - l) / 2, 2) AS rest, 0.0 AS drift, 4 AS line_vertices, 2 AS pieces, 'ok' AS status FROM ca")
def cut_report(s, d):
    lines, pieces, p = _cut(s, d)
    found = cuts.cut_report(lines, pieces, p, 0.01)
    return found.select("entry", "code", *[F.round(c, 2).alias(c) for c in ("before", "new", "rest")], F.round("drift", 3).alias("drift"), F.col("line_vertices").cast("long").alias("line_vertices"), "pieces", "status")


@query(f"{_CUT}, t AS (SELECT DISTINCT code[1:10] AS p FROM ca), a AS (SELECT code, sum(x1 * y2 - x2 * y1) / 2 AS area FROM seg GROUP BY 1) SELECT 'antes' AS capa, code, round(area, 2) AS area FROM a JOIN t ON p = code[1:10] UNION ALL SELECT 'despues', code, round(coalesce((w - l) / 2, area), 2) FROM a JOIN t ON p = code[1:10] LEFT JOIN ca USING (code) UNION ALL SELECT 'despues', code || 'n', round(l / 2, 2) FROM ca")
def before_after(s, d):
    """The blocks touched by a cut, as they were and as they are."""
    lines, pieces, p = _cut(s, d)
    codes_ = lines.select("entry", F.concat("code", F.lit("n")).alias("new_code"))
    shape = lambda df: geometry.polygon_measures(geometry.ring_segments(df)).select("code", F.round(F.col("area2") / 2, 2).alias("area"))
    touched = lines.select(F.substring("code", 1, 10).alias("prov"))
    return layers.before_after(shape(p), shape(cuts.new_layer(p, pieces, codes_)), touched, 10).select("capa", "code", "area")


@query(f"{_CUT} SELECT code, round(area, 2) AS before, round(area - coalesce(cut, 0), 2) AS after, coalesce(cut, 0) < 1 AS ok FROM (SELECT code, sum(x1 * y2 - x2 * y1) / 2 AS area FROM seg GROUP BY 1) LEFT JOIN (SELECT code, l / 2 AS cut FROM ca) USING (code)")
def area_conservation(s, d):
    """Parcels before and after one of each block is cut."""
    _, pieces, p = _cut(s, d)
    rest = cuts.new_layer(p, pieces.filter("piece = 'rest'"), pieces.select("entry", F.lit("").alias("new_code")).distinct())
    measured = lambda df: geometry.polygon_measures(geometry.ring_segments(df)).select("code", "area2")
    found = rays.area_conservation(measured(p), measured(rest), 1)
    return found.select("code", F.round(F.col("before2") / 2, 2).alias("before"), F.round(F.col("after2") / 2, 2).alias("after"), "ok")


#: Longitude and latitude of a place on the grid: a unit is a millionth of a degree, strips of 4,000 rows of cells lie over each other.
_DEGREES = "-75.2 + x / 1e6 AS lon, -17 + (y - gy // 4000 * 16000000) / 1e6 AS lat"
_THIRD = "(1 / 298.257223563) / (2 - 1 / 298.257223563)"


def _law_in_metres(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Parcels in degrees, and a law for one of each block with points in metres of zone 18, straight on at both ends."""
    strip = F.floor((F.substring("code", 1, 8).cast("long") * 10 + F.substring("code", 11, 1).cast("long")) / 4000) * 16_000_000
    degrees = lambda x, y: F.struct((x / 1e6 - 75.2).alias("x"), ((y - strip) / 1e6 - 17).alias("y"))
    p = frames.parcels(s, d).filter("code LIKE '%4_'").withColumns({"part": F.lit(0), "vertices": F.transform("vertices", lambda v: degrees(v["x"], v["y"]))})
    e = _cut_entries(s, d).withColumn("points", F.transform("points", lambda v: degrees(v["x"], v["y"]))).withColumn("inner", degrees(F.col("px"), F.col("py")))
    straight = [F.lit("continuar").alias(c) for c in ("start_bearing", "end_bearing")]
    return p, e.select("entry", "code", cuts.projected("points", 18, False).alias("points"), *straight, F.lit(300.0).alias("start_max"), F.lit(300.0).alias("end_max"), F.col("inner.x").alias("px"), F.col("inner.y").alias("py"))


#: Corners of the parcels to be cut and the law's two points in metres (Krueger's series); then distances left of and along the line between these points.
_METRES = f""", pt AS (SELECT v.code, k, x::double AS x, y, gy FROM v JOIN cell USING (code) WHERE code LIKE '%44' UNION ALL SELECT code, 100 + i, gx * 4000 + 2000, gy * 4000 + 1500 + i * 1000, gy FROM cell, (SELECT unnest([0, 1]) AS i) WHERE code LIKE '%44'),
dg AS (SELECT code, k, {_DEGREES}, {_THIRD} AS n FROM pt),
tt AS (SELECT code, k, n, radians(lon + 75) AS l, sinh(atanh(sin(radians(lat))) - 2 * sqrt(n) / (1 + n) * atanh(2 * sqrt(n) / (1 + n) * sin(radians(lat)))) AS t FROM dg),
xe AS (SELECT code, k, n, atan2(t, cos(l)) AS xi, atanh(sin(l) / sqrt(1 + t * t)) AS eta, 0.9996 * 6378137.0 / (1 + n) * (1 + n * n / 4 + n * n * n * n / 64) AS a, n / 2 - 2 * n * n / 3 + 5 * n * n * n / 16 AS a1, 13 * n * n / 48 - 3 * n * n * n / 5 AS a2, 61 * n * n * n / 240 AS a3 FROM tt),
en AS (SELECT code, k, 500000 + a * (eta + a1 * cos(2 * xi) * sinh(2 * eta) + a2 * cos(4 * xi) * sinh(4 * eta) + a3 * cos(6 * xi) * sinh(6 * eta)) AS e, 10000000 + a * (xi + a1 * sin(2 * xi) * cosh(2 * eta) + a2 * sin(4 * xi) * cosh(4 * eta) + a3 * sin(6 * xi) * cosh(6 * eta)) AS n FROM xe),
ln AS (SELECT p.code, p.e, p.n, (q.e - p.e) / sqrt((q.e - p.e) ** 2 + (q.n - p.n) ** 2) AS dx, (q.n - p.n) / sqrt((q.e - p.e) ** 2 + (q.n - p.n) ** 2) AS dy FROM en p JOIN en q ON q.code = p.code AND p.k = 100 AND q.k = 101),
uw AS (SELECT code, k, (en.e - ln.e) * dy - (en.n - ln.n) * dx AS u, (en.e - ln.e) * dx + (en.n - ln.n) * dy AS w FROM en JOIN ln USING (code) WHERE k < 100),
rs AS (SELECT a.code, a.u AS x1, a.w AS y1, b.u AS x2, b.w AS y2, 0.0 AS c FROM uw a JOIN uw b ON a.code = b.code AND b.k = a.k + 1),
ra AS (SELECT code, sum({_LEFT}) AS l, sum(x1 * y2 - x2 * y1) AS w FROM rs GROUP BY 1)"""


@query(f"{_METRES} SELECT 'ley ' || code AS entry, code, round(w / 2, 1) AS before, round(l / w, 4) AS share, 16 AS inherited, 'ok' AS status FROM ra")
def cut_in_metres(s, d):
    """Parcels in degrees, cut along lines that are straight in metres; the vertices that they had are found in the pieces as they were."""
    p, e = _law_in_metres(s, d)
    lines = tables.stored(cuts.lines_in_metres(e, p, 18, 100.0).join(e.select("entry", "px", "py"), "entry"))
    pieces = tables.stored(cuts.cut_parents(lines, p))
    found = cuts.cut_report_in_metres(lines, pieces, p, 18, 1.0)
    points = lambda df, *keys: df.select(*keys, F.explode("vertices").alias("v")).distinct()
    kept = points(pieces, "entry", "code").join(points(p, "code"), ["code", "v"]).groupBy("entry").agg(F.count("*").alias("inherited"))
    return found.join(kept, "entry").select("entry", "code", F.round("before", 1).alias("before"), F.round(F.col("new") / F.col("before"), 4).alias("share"), "inherited", "status")


@query("SELECT ubigeo, nivel, clave_censo FROM cat")
def read_catalogue(s, d):
    """The catalogue, written as sorted CSV and read back."""
    path = tables.scratch_folder(s, "catalogue")
    tables.write_table_csv(_cat(s, d).unionByName(_cat(s, d).limit(1).withColumn("ubigeo", F.lit("16020"))), path)
    return tables.read_catalogue(s, path).select("ubigeo", "nivel", "clave_censo")


@query("SELECT ubigeo, 2000 + seq AS anio FROM dist WHERE seq = 4")
def read_retired(s, d):
    """Codes of one position in each province without their first zero, and blank rows."""
    path = tables.scratch_folder(s, "retired")
    rows = _districts(s, d).filter("ubigeo LIKE '%04'").select(F.ltrim("ubigeo", F.lit("0")).alias("ubigeo"), F.lit("2004").alias("anio_retiro"), F.lit("").alias("motivo"), F.lit("x").alias("fuente"))
    rows.unionByName(rows.limit(1).withColumn("ubigeo", F.lit("  "))).write.csv(path, header=True)
    return tables.read_retired(s, path).select("ubigeo", F.col("anio_retiro").cast("long").alias("anio"))


@query("SELECT ubigeo AS name, row_number() OVER (ORDER BY ubigeo) - 1 AS row_idx, seq::varchar AS first FROM dist")
def read_census_rows(s, d):
    """Districts in the order of the file that holds them."""
    path = tables.scratch_folder(s, "sheet")
    _districts(s, d).select("ubigeo", F.substring("ubigeo", 5, 2).cast("int").cast("string").alias("n")).coalesce(1).sortWithinPartitions("ubigeo").write.csv(path)
    rows = tables.read_census_rows(s, path, 3)
    return rows.select(F.col("cells")[0].alias("name"), "row_idx", F.col("cells")[1].alias("first"))


@query("SELECT nivel, ubigeo, nombre FROM units")
def write_layers(s, d):
    """Units as a folder per level, read back."""
    path = tables.scratch_folder(s, "layers")
    tables.write_layers(frames.units(s, d), path)
    return s.read.schema("ubigeo string, nombre string, nivel string").parquet(path).select("nivel", "ubigeo", "nombre")


@query("SELECT code, count(*) AS vertices, min(x) AS min_x, max(y) AS max_y FROM v GROUP BY 1")
def write_geojson(s, d):
    """Parcels as GeoJSON lines in degrees, read back onto the grid."""
    path = tables.scratch_folder(s, "boundaries")
    degrees = F.transform("vertices", lambda v: F.struct((v["x"] / 1e7).alias("lon"), (v["y"] / 1e7).alias("lat")))
    features.write_geojson(frames.parcels(s, d).select("code", F.lit(0).alias("part"), "ring", degrees.alias("vertices")), path)
    v = features.read_boundaries(s, path, "code: string", by_line=True).select("code", F.explode("vertices").alias("v"))
    grid = geometry.round_grid(F.col("v.lon"), F.col("v.lat"))
    return v.groupBy("code").agg(F.count("*").alias("vertices"), F.min(grid["x"]).alias("min_x"), F.max(grid["y"]).alias("max_y"))


@query("SELECT code, count(*) AS vertices, min(x) AS min_x, max(y) AS max_y FROM v GROUP BY 1")
def read_boundaries(s, d):
    """Parcels as collections on a single line each, one for 300 strips (300,000 parcels), read in splits onto the grid."""
    path = tables.scratch_folder(s, "collection")
    degrees = F.transform("vertices", lambda v: F.struct((v["x"] / 1e7).alias("lon"), (v["y"] / 1e7).alias("lat")))
    units = frames.parcels(s, d).select("code", F.lit(0).alias("part"), "ring", degrees.alias("vertices"))
    features.write_collections(units, path, F.floor(F.substring("code", 1, 8).cast("long") / 300))
    v = features.read_boundaries(s, path, "code: string").select("code", F.explode("vertices").alias("v"))
    grid = geometry.round_grid(F.col("v.lon"), F.col("v.lat"))
    return v.groupBy("code").agg(F.count("*").alias("vertices"), F.min(grid["x"]).alias("min_x"), F.max(grid["y"]).alias("max_y"))


@query("SELECT ubigeo AS key, '{\"nombre\":\"' || nombre || '\",\"ubigeo\":\"' || ubigeo || '\",\"valor\":' || coalesce(nullif(seq, 9)::varchar, 'null') || '}' AS line FROM dist")
def write_report(s, d):
    """A line of JSON for each district, written in order and read back."""
    path = tables.scratch_folder(s, "report")
    seq = F.substring("ubigeo", 5, 2).cast("int")
    features.write_report(_districts(s, d).select("ubigeo", "nombre", F.when(seq != 9, seq).alias("valor")), path, "ubigeo")
    return s.read.text(path).select(F.get_json_object("value", "$.ubigeo").alias("key"), F.col("value").alias("line"))


@query("SELECT nivel, ubigeo, upper(nombre) AS nombre FROM units WHERE nivel <> 'distrito' OR seq_of <> 3".replace("units WHERE", "(SELECT u.*, CASE WHEN nivel = 'distrito' THEN ubigeo[5:6]::int END AS seq_of FROM units u) WHERE"))
def extract_registry_rows(s, d):
    """A page for each unit, with a hidden block that holds rows of its own; one district of each province lacks a cell."""
    u = frames.units(s, d)
    cell = lambda level: F.when(F.col("nivel") == level, F.concat(F.lit("<td> <b>"), "ubigeo", F.lit("</b>&nbsp;"), F.upper("nombre"), F.lit("</td>"))).otherwise("<td> </td>")
    hidden = "<div style='display: none'><div><tr><td>1</td><td></td><td></td><td>999999 NADA</td></tr></div></div>"
    last = F.when((F.col("nivel") == "distrito") & F.col("ubigeo").endswith("03"), "").otherwise(cell("distrito"))
    row = F.concat(F.lit("<tr><td>1</td>"), cell("departamento"), cell("provincia"), F.lit(hidden), last, F.lit("</tr>"))
    return features.extract_registry_rows(u.select(F.concat(F.lit("<table><tbody class='x'>"), row, F.lit("</tbody></table>")).alias("html")))


@query("SELECT page_id, '<p>' || coalesce(url, '') || '</p><div>x</div>' AS html FROM pages")
def strip_hidden_blocks(s, d):
    """Each page's address between blocks that are hidden, nested or never closed."""
    url = F.coalesce("url", F.lit(""))
    pages = s.read.parquet(f"{d}/pages.parquet").select("page_id", F.concat(F.lit("<div style='display:none'>a<div>b</div>c</div><p>"), url, F.lit("</p><div>x</div><DIV STYLE='Display : None'>open <div>")).alias("html"))
    return pages.select("page_id", features.strip_hidden_blocks(F.col("html")).alias("html"))


@query("SELECT 'ley ' || code AS entry, code, gx * 4000 + 2000.0 AS x, 'sur' AS start_bearing, 4000.0 AS start_max, gy * 4000 + 2000.0 AS py FROM cell WHERE code LIKE '%44'")
def read_law_registry(s, d):
    """Law entries of the parcels to be cut, written as JSON and read back with their lines."""
    e = _cut_entries(s, d)
    pair = lambda x, y: F.array(x, y)
    cut = F.struct(F.lit("grid").alias("crs"), F.transform("points", lambda p: pair(p["x"], p["y"])).alias("puntos"), F.struct(F.col("start_bearing").alias("rumbo"), F.col("start_max").alias("max_m")).alias("prolongar_inicio"), pair(F.col("px"), F.col("py")).alias("punto_interior"))
    path = tables.scratch_folder(s, "laws")
    e.select(F.lit("x").alias("nombre"), F.col("entry").alias("ley"), F.col("code").alias("padre"), cut.alias("corte")).write.json(path)
    lines = tables.law_lines(tables.read_law_registry(s, path))
    return lines.select("entry", "code", F.col("points")[0]["x"].alias("x"), "start_bearing", "start_max", "py")


@query("SELECT snapshot, kind, code FROM (SELECT '1' AS snapshot, 'count changed' AS kind, count(*)::varchar AS code FROM dist WHERE seq <> 14 UNION ALL SELECT '2', 'count changed', count(*)::varchar FROM dist UNION ALL SELECT '1', 'official without polygon', ubigeo FROM dist WHERE seq = 14 UNION ALL SELECT unnest(['1', '2']), 'law: published', ubigeo FROM dist WHERE seq = 10)")
def watch_stream(s, d):
    """Two snapshots of several files each, judged as they arrive; one lacks a district of each province."""
    rows = _districts(s, d).select("ubigeo", "nombre")
    folder = tables.scratch_folder(s, "stream")
    first = rows.filter("ubigeo NOT LIKE '%14'").withColumn("snapshot", F.lit("1"))
    first.unionByName(rows.withColumn("snapshot", F.lit("2"))).repartition(5, "ubigeo").write.parquet(f"{folder}/in")
    e = rows.filter("ubigeo LIKE '%10'").select(F.col("ubigeo").alias("entry"), F.substring("ubigeo", 1, 4).alias("prov"), "nombre", F.col("ubigeo").alias("predicted"))
    none = s.createDataFrame([], "code string")
    stream.watch_stream(s, f"{folder}/in", "ubigeo string, nombre string, snapshot string", f"{folder}/out", f"{folder}/state", e, rows, none, 0).awaitTermination()
    return s.read.schema("kind string, code string, snapshot string").parquet(f"{folder}/out/alerts")
