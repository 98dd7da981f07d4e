"""Column functions on small literal frames."""

import math
import unicodedata

from pyspark.sql import functions as F

from limes.functions import columns as C
from limes.operators import codes


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_codes(spark):
    assert one(spark, C.pad_code(F.lit("10101"), 6))[0] == "010101"
    assert one(spark, C.pad_code(F.lit("1010101"), 6))[0] == "1010101"
    assert [one(spark, C.valid_code(F.lit(x).cast("string"), 4))[0] for x in ("0101", "101", "abcd", None)] == [True, False, False, False]


def test_names(spark):
    assert one(spark, C.normalize_name(F.lit(" ñaña   alto ")))[0] == "NANA ALTO"
    assert one(spark, C.normalize_name(F.lit(None).cast("string")))[0] == ""
    assert one(spark, C.classify_unit(F.lit("Distrito  Río Ene")))[0].asDict() == {"level": "distrito", "bare": "RIO ENE"}
    assert one(spark, C.classify_unit(F.lit("NOTA")))[0].level is None


def test_every_character_is_decomposed(spark):
    """All characters but surrogates and Hangul syllables, alone and among letters, against Python's normal form."""
    chars = [chr(c) for c in [*range(1, 0xAC00), *range(0xE000, 0x110000)] if unicodedata.category(chr(c)) not in ("Cn", "Co")]
    texts = [*chars, "Ĳssel ﬁna Åńgström ½ ㎏", "", None, *("".join(chars[k : k + 50]) for k in range(0, len(chars), 50))]
    want = [t if t is None else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)) for t in texts]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", C.strip_accents(F.col("t")).alias("t"))
    got = dict(rows.toPandas().itertuples(index=False))
    # marks of a whole text are put in order before they go, so only the order of what stays could differ
    assert [(t, got[i], w) for i, (t, w) in enumerate(zip(texts, want)) if (got[i] or "") != (w or "")] == []


def test_numbers(spark):
    assert [one(spark, C.parse_number(F.lit(x)))[0] for x in ("1,234.5", "-", ".", "", "x", "12 a")] == [1234.5, None, None, None, None, 12.0]


def test_utm_control_point_and_round_trip(spark):
    lon, lat = one(spark, *C.from_utm(F.lit(391_999.0), F.lit(9_527_007.0), 19))
    assert abs(lon + 69.97323) < 1e-4 and abs(lat + 4.27862) < 1e-4
    e, n = one(spark, *C.utm(F.lit(lon), F.lit(lat), 19))
    assert math.hypot(e - 391_999, n - 9_527_007) < 1e-3


def test_next_code_and_gaps(spark):
    used = spark.createDataFrame([(x,) for x in ("160201", "160202", "160205", "160206", "160210", "160211", "990199")], "ubigeo string")
    none = spark.createDataFrame([], "ubigeo string")
    assert {(r.prov, r.code, r.status) for r in codes.next_code(used, none).collect()} == {("1602", "160212", "ok"), ("9901", None, "exhausted")}
    assert codes.next_code(used, spark.createDataFrame([("160212",)], "ubigeo string")).filter("prov = '1602'").first().status == "retired"
    assert sorted(r.gap for r in codes.code_gaps(used).filter("prov = '1602'").collect()) == [3, 4, 7, 8, 9]


def test_entries_of_one_province_follow_each_other(spark):
    used = spark.createDataFrame([("160401",), ("160402",)], "ubigeo string")
    none = spark.createDataFrame([], "ubigeo string")
    cat = spark.createDataFrame([], "ubigeo string, nivel string, ubigeo_provincia string, nombre_normalizado string")
    entries = spark.createDataFrame([(1, "1604", "A", None), (2, "1604", "B", None), (3, "1604", "C", "160402")], "entry int, prov string, nombre string, forced string")
    got = {r.entry: (r.code, r.origin, r.status) for r in codes.resolve_codes(entries, cat, used, none).collect()}
    assert got == {1: ("160403", "rule", "ok"), 2: ("160404", "rule", "ok"), 3: ("160402", "forced", "in use")}
