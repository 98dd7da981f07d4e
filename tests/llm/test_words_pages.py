"""Phrases, spelling variants and page texts against brute force on small odd tables."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

from limes.llm import htmltext, phrases, spelling


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def plain_collocations(rows, top, least, subsumed):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for c in ".,;:!?\x0a\x0b\x0c\x0d":
            text = text.replace(c, "\n")
        for piece in text.split("\n"):
            ws = [w for w in piece.replace("\t", " ").split(" ") if w]
            n[lang] += len(ws)
            for k in range(len(ws)):
                for m in (1, 2, 3):
                    if k + m <= len(ws):
                        f[lang][tuple(ws[k : k + m])] += 1
    out = []
    for lang, c in f.items():
        candidates = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        best = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= subsumed * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in candidates.items()):
                continue
            cuts = [(1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            best.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def test_collocations(spark, monkeypatch):
    rng = random.Random(5)
    words = ["a", "b", "the", "The", "of", "É", "é", "|", "ab c", "\u0085x"]
    rows = [(rng.choice(["en", "fr", None, "und"]), "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "\r\n"]) for _ in range(rng.randrange(60)))) for _ in range(300)]
    rows += [("en", None), ("fr", ""), ("fr", " \t "), ("de", "x y z " * 30), ("en", "a b " * 2000)] + rows[:40]
    docs = frame(spark, [(k, "s", 1, *r) for k, r in enumerate(rows)], "doc_id long, w1 string, n int, lang string, text string").repartition(3)
    monkeypatch.setattr(phrases, "CHUNK_CHARS", 500)
    got = sorted(tuple(r) for r in phrases.collocations(docs, 25, 4, 50).collect())
    assert got == plain_collocations(rows, 25, 4, 50)
    assert phrases.collocations(docs.limit(0)).count() == 0
    assert phrases.collocations(docs.filter("text IS NULL")).count() == 0


def test_large_counts_are_exact(spark, monkeypatch):
    """Products beyond 64 bits."""
    docs = frame(spark, [("en", "x")], "lang string, text string")
    big = 3_000_000_000_000
    counted = spark.createDataFrame([("en", None, None, None, 4 * big, None, None), ("en", "x", None, None, big + 1, None, None), ("en", "y", None, None, big, None, None), ("en", "x", "y", None, big, None, 0)], phrases.COUNTED)
    monkeypatch.setattr(phrases, "merge_stripes", lambda blocks, least: counted)
    (row,) = phrases.collocations(docs).collect()
    assert (row.score, row.a, row.l, row.r, row.n) == (1_000_000 * big * big // ((big + 1) * big), big, big + 1, big, 4 * big)


def distance_is_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def test_near_words(spark):
    rng = random.Random(7)
    base = ["".join(rng.choice("abeé") for _ in range(rng.randrange(1, 9))) for _ in range(250)] + ["aaaaaaaa", "aaaaaaa", "ÿ÷×abc", "ÿ÷×ab"]
    words = sorted(set(base))
    got = {tuple(r) for r in spelling.near_words(frame(spark, [(w,) for w in words], "word string")).collect()}
    assert got == {(a, b) for a in words for b in words if a < b and distance_is_one(a, b)}


def test_variants(spark):
    rng = random.Random(11)
    words = ["letter", "letters", "lettre", "Better", "butter", "über", "überall", "ÉCOLE", "école", "abc", "hello"]
    rows = [(rng.choice([None, *range(80)]), " ".join(rng.choice(words) + rng.choice(["", "-", "1"]) for _ in range(40))) for _ in range(120)]
    rows += [(7, None), (None, None), (8, ""), (9, "1234 ++")] + rows[:10]
    docs = frame(spark, [(i, t, "x", 3) for i, t in rows], "doc_id long, text string, word string, n int")
    import re

    count = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            count[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    count = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    form, near = {}, {}
    for w, n in count.items():
        others = sorted((-count[v], v) for v in count if distance_is_one(v, w))
        near[w] = len(others)
        form[w] = others[0][1] if others and -others[0][0] >= 2 * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    want = sorted((w, form[w] or "", root(w), n, near[w], count[form[w]] if form[w] else -1) for w, n in count.items())
    got = sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in spelling.variants(docs).collect())
    assert got == want and any(w[1] for w in want)
    assert spelling.variants(docs.limit(0)).count() == 0


def test_long_chain_of_forms(spark):
    forms = frame(spark, [(f"w{k}", f"w{k + 1}") for k in range(20)], "word string, form string")
    assert {r.root for r in spelling.roots(forms).collect()} == {"w20"}


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""),
        ("plain  text", "plain text"),
        ("<p>a<p>b", "a\nb"),
        ("<ul><li>one<li>two</ul>", "one\ntwo"),
        ("a &amp;amp; b &lt;c&gt; &#x41;&nbsp;z", "a &amp; b <c> A z"),
        ("<div class='sidebar'>x</div><div>keep<br>this</div>", "keep this"),
        ("<body><header>site</header><main><h1>T</h1><p>x</p><aside>no</aside><div id=comments><p>c</p></div></main><footer>f", "T\nx"),
        ("<article><header><h1>Head</h1><p>by me</p></header><p>Text</p></article>", "Head\nText"),
        ("<script>var t='</p>'; if(a<b){}</script><p>x</p><style>p{}", "x"),
        ("<p title='a>b'>q</p><p title=\"open>r</p>", "q\nr"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
        ("<!-- x --><p>y</p><!-- open <p>z</p>", "y"),
        ("<nav><ul><li>a</nav><article>t <b>bold</b>text</article>", "t boldtext"),
        ("<div class='has-sidebar'><form><article><p>in</p><form>out</form></article></form></div>", "in"),
        ("<p hidden>h</p><p style='display: none'>n</p><div role=search>s</div><p>v</p>", "v"),
        ("<textarea><p>x</p></textarea><p>a</p></div></p>", "a"),
        ("<![CDATA[a & b]]> < 5 <3", "a & b < 5 <3"),
        ("<article class=comment>no</article><article>yes</article>", "yes"),
    ],
)
def test_text_of(html, text):
    assert htmltext.text_of(html) == text


@pytest.mark.parametrize("html", ["<p a=\"" * 20_000, "<a href='" * 20_000 + ">", "<article>" * 20_000 + "x", "<![CDATA[" * 9_000, "</ " * 20_000, "<b>" * 20_000 + "</p>" * 20_000 + "<p>" * 20_000, "<div>" * 9_000 + "</section>" * 9_000])
def test_odd_markup_ends(html):
    assert isinstance(htmltext.text_of(html), str) and htmltext.subtrees(html)


def site(k, body, extra="<div><p>Read more of our stories</p></div>"):
    return f"<html><body><nav>n{k}</nav><article><h1>Title {k}</h1>{body}{extra}</article></body></html>"


def test_site_templates(spark):
    own = [(k, f"http://A.example/p{k}", site(k, f"<p>This is the long own story number {k} of the site.</p>")) for k in range(8)]
    # copies of one story, under other menus: no template, but what they share with other stories is one
    copies = [(100 + k, f"https://a.example:80/c{k}", site(1, "<p>A story that was copied many times over, word for word, all of it.</p><p>Second part.</p>").replace("n1", f"n{k}")) for k in range(30)]
    few = [(200 + k, f"http://b.example/p{k}", site(k, f"<p>Story {k} that is long enough here.</p>")) for k in range(3)]
    odd = [(300, None, site(0, "<p>x</p>")), (None, "no address", site(0, "<p>y</p>")), (302, "http://a.example/", None), (302, "http://a.example/", None), (303, "http://a.example/", "")]
    pages = frame(spark, [(i, u, h, "x", 1) for i, u, h in own + copies + few + odd], "page_id long, url string, html string, host string, tree int").repartition(3)
    got = {(r.page_id, r.url): r for r in htmltext.extract(pages).collect()}
    for k, u, _ in own:
        assert got[k, u].text == f"Title {k}\nThis is the long own story number {k} of the site."
    for k, u, _ in copies:
        assert got[k, u].text == "Title 1\nA story that was copied many times over, word for word, all of it.\nSecond part."
    for k, u, _ in few:
        assert got[k, u].text == f"Title {k - 200}\nStory {k - 200} that is long enough here.\nRead more of our stories"
    assert got[300, None].text == "Title 0\nx\nRead more of our stories" and got[None, "no address"].text.startswith("Title 0\ny")
    assert got[302, "http://a.example/"].text == got[303, "http://a.example/"].text == "" and all(r.n_chars == len(r.text) for r in got.values())
    assert htmltext.extract(pages).count() == pages.count() and htmltext.extract(pages.limit(0)).count() == 0
