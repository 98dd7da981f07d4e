"""Operator 10: personal data, found through disguises, with offsets in the source text.

Plain finders give the base spans.  A chain of transducers then rewrites look-alike characters, invisible ones,
character references of signs, spelled digits, letters among digits and at/dot disguises, and keeps for every character of its output the source characters that it stands for; the finders
run over the rewritten text, and what they find there is mapped back to the source.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limes.llm.common import map_batches, prepare

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9]){12,}+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

#: Spelled digits and the characters that often stand for Latin letters. Fixed values.
SPELLED = {"zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
LOOKALIKES = dict(zip("аеорсухіјѕԁһ" + "АВЕКМНОРСТХІЈЅ" + "οαν" + "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxijsdh" + "ABEKMHOPCTXIJS" + "oav" + "ABEZHIKMNOPTYX", strict=True))


@lru_cache(maxsize=1)
def lookalikes() -> dict[int, str]:
    """Look-alike letters, full-width ASCII, letters that are ASCII ones but for their style, and the decimal digits of all scripts."""
    table = {ord(a): b for a, b in LOOKALIKES.items()}
    table |= {c: chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
    for c in range(0x80, 0x20000):
        if c not in table:
            plain = unicodedata.normalize("NFKC", chr(c))
            if (d := unicodedata.decimal(chr(c), None)) is not None:
                table[c] = str(d)
            elif len(plain) == 1 and plain.isascii() and plain.isalpha():
                table[c] = plain
    return table


NAMES = "|".join(SPELLED)
RUN = re.compile(rf"(?<![A-Za-z])(?:{NAMES})(?![A-Za-z])(?:[ ,-]{{1,2}}(?:{NAMES})(?![A-Za-z]))*+", re.I | re.A)
NAME = re.compile(rf"({NAMES})(?:[ ,-]{{1,2}}(?={NAMES}))?", re.I | re.A)
#: What a single spelled digit must adjoin, before it and after it.
BEFORE = re.compile(r"(?:[0-9+.]|(?<![A-Za-z])dot)[ ,()\[\]{}<>-]{0,3}\Z", re.I)
AFTER = re.compile(r"[ ,()\[\]{}<>-]{0,3}(?:[0-9+.]|dot(?![A-Za-z]))", re.I)
BRACKETS = re.compile(r" ?[(\[{<] ?(at|dot|@|\.) ?[)\]}>] ?", re.I)
WORDS = re.compile(r"(?<=[A-Za-z0-9]) (at|dot) (?=[A-Za-z0-9-]+(?: dot |\.)[A-Za-z0-9]|[A-Za-z]{2,10}\b|(?<=[0-9] dot )[0-9])", re.I)
#: An ' at ' before a host with plain dots; others need a ' dot ' or a bracket to become an address.
AT_HOST = re.compile(r" at [A-Za-z0-9-]+\.[A-Za-z0-9]", re.I)
#: Characters without width inside an identifier, references of signs, signs set apart by blanks on both sides.
INVISIBLE = re.compile(r"(?<=[A-Za-z0-9._%+@-])[\u00AD\u200B-\u200D\u2060\uFEFF]+(?=[A-Za-z0-9._%+@-])")
REFERENCE = re.compile(r"&(?:(#0*64|#x0*40|commat)|#0*46|#x0*2e|period);", re.I)
APART = re.compile(r"(?<=[A-Za-z0-9]) @ (?=[A-Za-z0-9-]+(?: \. [A-Za-z0-9-]+)* \. [a-z]{2,10}(?![A-Za-z0-9]))")
HOST_APART = re.compile(r"[A-Za-z0-9-]+(?: \. [A-Za-z0-9-]+)+")
PLUS = re.compile(r"(?<![A-Za-z])plus[ ,-]{1,2}(?=[0-9])", re.I)
#: Figures with letters among them: tokens of digits and such letters, in a row.
MIXED = re.compile(r"(?<![A-Za-z0-9])[0-9OolI](?:[0-9OolI]|[ ().-]{1,2}(?=[0-9OolI(]))*+(?![A-Za-z0-9])")
TOKEN = re.compile(r"[0-9OolI]+")
NEAR_DIGIT = re.compile(r"[0-9][OolI]|[OolI][0-9]")
LETTER = {"O": "0", "o": "0", "l": "1", "I": "1"}
SIGN = {"at": "@", "dot": ".", "@": "@", ".": "."}


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    low, at = 0, 0
    while m := HOST.search(text, at):
        start = at = m.start()
        while start > low and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            yield start, m.end()
            low = at = m.end()
        else:
            at += 1


def plain(text: str) -> list[tuple[str, int, int]]:
    """The base spans: kind, start, end (code points, end exclusive), by kind, then start."""
    found = [("email", *x) for x in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
        if "+" in text:
            found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return found


class Tape:
    """A text under rewriting; starts[i] and ends[i] are the source characters of character i."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends, self.changed = text, range(len(text)), range(1, len(text) + 1), [False] * len(text)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace text[a:b] by one character or none, for each (a, b, character) in order; where one goes, the one before it counts as changed."""
        if not edits:
            return
        parts, starts, ends, changed, at = [], [], [], [], 0
        for a, b, new in edits:
            parts += [self.text[at:a], new]
            starts += self.starts[at:a]
            ends += self.ends[at:a]
            changed += self.changed[at:a]
            if new:
                starts.append(self.starts[a])
                ends.append(self.ends[b - 1])
                changed.append(True)
            elif changed:
                changed[-1] = True
            at = b
        parts.append(self.text[at:])
        starts += self.starts[at:]
        ends += self.ends[at:]
        changed += self.changed[at:]
        self.text, self.starts, self.ends, self.changed = "".join(parts), starts, ends, changed


def spelled_runs(text: str) -> Iterator[tuple[int, int]]:
    """Runs of spelled digits: several, or one beside a digit, a plus or a dot; the finders judge what they make."""
    for m in RUN.finditer(text):
        a, b = m.span()
        if NAME.match(text, a).end() < b or BEFORE.search(text[max(0, a - 7) : a]) or AFTER.match(text, b):
            yield a, b


def letters_among_digits(text: str) -> list[tuple[int, int, str]]:
    """O and l in the place of 0 and 1, in tokens that hold digits or adjoin a dot, where they stand in a row with four digits or more."""
    edits = []
    for m in MIXED.finditer(text):
        if sum(c.isdigit() for c in m[0]) >= 4:
            for t in TOKEN.finditer(m[0]):
                if DIGIT.search(t[0]) or "." in (m[0][t.start() - 1 : t.start()], m[0][t.end() : t.end() + 1]):
                    edits += [(m.start() + t.start() + k, m.start() + t.start() + k + 1, LETTER[c]) for k, c in enumerate(t[0]) if c in LETTER]
    return edits


def disguised(text: str) -> Tape | None:
    """The text after all transducers, or None if none of them applies."""
    table = lookalikes()
    ascii_ = text.isascii()
    folded = None if ascii_ or table.keys().isdisjoint(map(ord, set(text))) else text.translate(table)
    hidden = not ascii_ and INVISIBLE.search(text) is not None
    plain_text = folded or text
    low = plain_text.lower() if plain_text.isascii() else plain_text.casefold()
    referred = "&" in low and REFERENCE.search(plain_text) is not None
    names = any(x in low for x in SPELLED)
    signs = " dot " in low or " at " in low and AT_HOST.search(plain_text) is not None or BRACKETS.search(plain_text) is not None
    apart = " @ " in low and APART.search(plain_text) is not None
    mixed = NEAR_DIGIT.search(plain_text) is not None
    if not (folded or hidden or referred or names or signs or apart or mixed):
        return None
    tape = Tape(text)
    if folded:
        tape.text, tape.changed = folded, [a != b for a, b in zip(text, folded, strict=True)]
    if hidden:
        tape.rewrite([(m.start(), m.end(), "") for m in INVISIBLE.finditer(tape.text)])
    if referred:
        tape.rewrite([(m.start(), m.end(), "@" if m[1] else ".") for m in REFERENCE.finditer(tape.text)])
    if names:
        # the blank after a digit's name goes with it, but what separates the run from the next word stays
        tape.rewrite([(a + m.start(), a + m.end(), SPELLED[m[1].casefold()]) for a, b in spelled_runs(tape.text) for m in NAME.finditer(tape.text[a:b])])
        tape.rewrite([(m.start(), m.end(), "+") for m in PLUS.finditer(tape.text) if tape.changed[m.end()]])
    if signs:
        tape.rewrite([(m.start(), m.end(), SIGN[m[1].lower()]) for m in BRACKETS.finditer(tape.text)])
        tape.rewrite([(m.start(), m.end(), SIGN[m[1].lower()]) for m in WORDS.finditer(tape.text)])
    if apart:
        tape.rewrite([x for m in APART.finditer(tape.text) for x in ((m.start(), m.end(), "@"), *((m.end() + d.start(), m.end() + d.end(), ".") for d in re.finditer(r" \. ", HOST_APART.match(tape.text, m.end())[0])))])
    if mixed:
        tape.rewrite(letters_among_digits(tape.text))
    return tape if any(tape.changed) else None


def spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and those that the transducers add: of rewritten characters, and clear of base spans of their kind or around them."""
    base = plain(text)
    tape = disguised(text)
    if tape is None:
        return base, []
    added = []
    for kind, a, b in plain(tape.text):
        if any(tape.changed[a:b]):
            start, end = tape.starts[a], tape.ends[b - 1]
            met = [(s, e) for k, s, e in base if k == kind and s < end and start < e]
            if all(start <= s and e <= end and (s, e) != (start, end) for s, e in met):
                added.append((kind, start, end))
    return base, added


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(found, key=lambda x: (KINDS.index(x[0]), *x[1:])))


def redacted(text: str, found: list[tuple[str, int, int]]) -> str:
    """text with [KIND] for each span; of overlapping spans, the first, or the longest that begins there, names the place."""
    parts, at = [], 0
    for kind, a, b in sorted(found, key=lambda x: (x[1], -x[2])):
        if a >= at:
            parts += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: id, base_spans, spans (kind:start:end, comma-joined), counts of the base spans, redacted text.

    A null text counts as empty and has no spans; rows with null or repeated ids are searched like others.  Texts of any length are
    searched whole.  Columns besides id and text are left out, whatever their names; an empty table gives an empty result.
    """

    def run(rows: dict[str, list]) -> dict[str, object]:
        found = [spans(t or "") for t in rows["text"]]
        out: dict[str, object] = {f"n_{k}": [sum(x[0] == k for x in base) for base, _ in found] for k in KINDS}
        out["base_spans"] = [joined(base) for base, _ in found]
        out["spans"] = [joined(base + added) for base, added in found]
        out["redacted"] = [redacted(t or "", base + added) if base or added else t for t, (base, added) in zip(rows["text"], found)]
        return out

    prepare(docs.sparkSession)
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return map_batches(source, run, ", ".join(f"n_{k} long" for k in KINDS) + ", base_spans string, spans string, redacted string", "id").withColumnRenamed("id", id_col)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the kind of datum, in brackets, in place of each datum; all rows, other columns and null texts stay as they are."""

    def run(rows: dict[str, list]) -> dict[str, object]:
        found = [[] if t is None else sum(spans(t), []) for t in rows[text_col]]
        return {text_col: [redacted(t, x) if x else t for t, x in zip(rows[text_col], found)]}

    prepare(docs.sparkSession)
    rest = [c for c in docs.columns if c != text_col]
    return map_batches(docs, run, f"`{text_col}` string", *rest).select([f"`{c}`" for c in docs.columns])
