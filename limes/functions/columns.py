"""Column functions on codes, names, figures and coordinates; all run in the JVM."""

from __future__ import annotations

import math
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a unit's census name begins with, by level; in a sheet, departments have no head word. Fixed values.
HEADS = {"departamento": "DEPARTAMENTO ", "provincia": "PROVINCIA ", "distrito": "DISTRITO "}


def valid_code(code: Column, digits: int) -> Column:
    return F.coalesce(code.rlike(f"^[0-9]{{{digits}}}$"), F.lit(False))


def pad_code(code: Column, digits: int) -> Column:
    """Leading zeros restored; longer codes stay whole."""
    return F.when(F.length(code) < digits, F.lpad(code, digits, "0")).otherwise(code)


def parent_codes(code: Column) -> list[Column]:
    return [F.substring(code, 1, 2).alias("dep"), F.substring(code, 1, 4).alias("prov"), F.substring(code, 5, 2).try_cast("int").alias("seq")]


def decomposed(char: str) -> str:
    """A character's compatibility decomposition without combining marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))


@lru_cache(maxsize=1)
def decompositions() -> tuple[str, str, dict[str, str]]:
    """Characters that become one or nothing, what they become (so marks stand last), and what becomes several.

    By the Unicode data of Python, for the planes that have decompositions, without surrogates and Hangul syllables.
    """
    change = {c: d for c in map(chr, [*range(0x80, 0xAC00), *range(0xE000, 0x30000)]) if (d := decomposed(c)) != c}
    single = sorted((c for c, d in change.items() if len(d) < 2), key=lambda c: (not change[c], c))
    return "".join(single), "".join(change[c] for c in single), {c: d for c, d in change.items() if len(d) > 1}


def strip_accents(text: Column) -> Column:
    """Characters decomposed as by NFKD and combining marks dropped, in the JVM; Hangul syllables stay whole.

    Single characters are translated; the rare ones that become several are looked up, in texts that hold one.
    """
    before, after, longer = decompositions()
    table = F.str_to_map(F.lit("\uE000".join(f"{c}\uE001{d}" for c, d in longer.items())), F.lit("\uE000"), F.lit("\uE001"))
    runs = [c for c in longer if chr(ord(c) - 1) not in longer], [c for c in longer if chr(ord(c) + 1) not in longer]
    held = text.rlike("[" + "".join(f"\\x{{{ord(a):X}}}-\\x{{{ord(b):X}}}" for a, b in zip(*runs)) + "]")
    spelled = F.array_join(F.transform(F.split(text, ""), lambda c: F.coalesce(F.try_element_at(table, c), c)), "")
    return F.translate(F.when(held, spelled).otherwise(text), before, after)


def squash_text(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def normalize_name(name: Column) -> Column:
    return squash_text(F.upper(strip_accents(F.coalesce(name, F.lit("")))))


def census_name(level: Column, name: Column) -> Column:
    """The level's head word and the name in capitals."""
    heads = F.create_map(*[F.lit(x) for pair in HEADS.items() for x in pair])
    return F.concat(heads[level], F.upper(name))


def hierarchy_key(level: Column, dep: Column, prov: Column, dist: Column) -> Column:
    """Normalised names from the department down to the unit, joined by a bar."""
    d, p, t = normalize_name(dep), normalize_name(prov), normalize_name(dist)
    return F.when(level == "departamento", d).when(level == "provincia", F.concat_ws("|", d, p)).otherwise(F.concat_ws("|", d, p, t))


def parse_number(text: Column) -> Column:
    """Digits, commas, dots and minus are kept, commas dropped; null for anything that is no number."""
    return F.regexp_replace(F.regexp_replace(text, r"[^0-9,.\-]", ""), ",", "").try_cast("double")


def classify_unit(name: Column) -> Column:
    """struct(level, bare): province or district by the head word, null without one; bare is the normalised rest."""
    whole = normalize_name(name)
    level, bare = F.lit(None).cast("string"), whole
    for k in ("provincia", "distrito"):
        hit = whole.startswith(HEADS[k])
        level = F.when(hit, F.lit(k)).otherwise(level)
        bare = F.when(hit, F.trim(F.substring(whole, len(HEADS[k]) + 1, 1 << 20))).otherwise(bare)
    return F.struct(level.alias("level"), bare.alias("bare"))


def coalesce_blank(text: Column, default: Column | str) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default) if isinstance(default, str) else default)


def in_focus(code: Column, focus: str) -> Column:
    """Under the focus or above it; an empty focus holds all."""
    return code.startswith(focus) | F.lit(focus).startswith(code)


def density(count: Column, area: Column) -> Column:
    return F.try_divide(count, area)


def cell_text(html: Column) -> Column:
    """Tags become blanks, four entities are decoded in this order, white space collapses."""
    text = F.regexp_replace(html, "<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&amp;", "&"), ("&#039;", "'"), ("&#034;", '"')):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(text, r"[ \t\n\r\f\x0B]+", " "))


def albers(lon: Column, lat: Column) -> tuple[Column, Column]:
    """x, y in metres of the South America Albers equal-area projection (public parameters, SAD69 ellipsoid)."""
    a, e2 = 6_378_160.0, 2 / 298.25 - 1 / 298.25**2
    e = math.sqrt(e2)

    def q_of(s: float) -> float:
        return (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))

    def m_of(p: float) -> float:
        return math.cos(p) / math.sqrt(1 - e2 * math.sin(p) ** 2)

    p0, p1, p2 = (math.radians(x) for x in (-32, -5, -42))
    n = (m_of(p1) ** 2 - m_of(p2) ** 2) / (q_of(math.sin(p2)) - q_of(math.sin(p1)))
    c = m_of(p1) ** 2 + n * q_of(math.sin(p1))
    rho0 = a * math.sqrt(c - n * q_of(math.sin(p0))) / n
    s = F.sin(F.radians(lat))
    q = (1 - e2) * (s / (1 - e2 * s * s) - F.log((1 - e * s) / (1 + e * s)) / (2 * e))
    rho = a * F.sqrt(c - n * q) / n
    theta = n * (F.radians(lon) - math.radians(-60))
    return rho * F.sin(theta), rho0 - rho * F.cos(theta)


#: WGS84 and the third flattening's series to the third order (Krüger).
_N = (1 / 298.257223563) / (2 - 1 / 298.257223563)
_A = 6_378_137.0 / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)
_K0, _E0, _N0 = 0.9996, 500_000.0, 10_000_000.0


def utm(lon: Column, lat: Column, zone: int) -> tuple[Column, Column]:
    """Easting and northing in a southern UTM zone."""
    k = 2 * math.sqrt(_N) / (1 + _N)
    s = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(s) - k * F.atanh(k * s))
    dl = F.radians(lon - (6 * zone - 183))
    xi, eta = F.atan2(t, F.cos(dl)), F.atanh(F.sin(dl) / F.sqrt(1 + t * t))
    e, n = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        e = e + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        n = n + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return _E0 + _K0 * _A * e, _N0 + _K0 * _A * n


def from_utm(easting: Column, northing: Column, zone: int) -> tuple[Column, Column]:
    """Longitude and latitude in degrees."""
    xi, eta = (northing - _N0) / (_K0 * _A), (easting - _E0) / (_K0 * _A)
    x, y = xi, eta
    for j, b in enumerate(_BETA, 1):
        x = x - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        y = y - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(x) / F.cosh(y))
    lat = chi
    for j, d in enumerate(_DELTA, 1):
        lat = lat + d * F.sin(2 * j * chi)
    return (6 * zone - 183) + F.degrees(F.atan2(F.sinh(y), F.cos(x))), F.degrees(lat)
