"""Operator 4: a linear-chain conditional random field tags toxic tokens; documents are scored by its marginals.

Training uses a bounded sample of labelled documents.  Only documents are labelled, so token labels are guessed: a token
counts as labelled toxic if it stands in a toxic document and has a feature (word, prefix or suffix) that is far more frequent in toxic
documents than in clean ones.  The sample is dealt into SHARES by a hash of the text; a field is fitted to each share and
the parameters are averaged (parameter mixing), in rounds, so the model doesn't depend on Spark's partitions.
Scoring runs forward-backward over every whole text; a logistic function of the marginals gives the score.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limes.llm.common import columns, cut, map_batches, prepare

WORD = re.compile(r"\w+")
BITS = 18
#: Tokens of a row of the grid on which forward-backward runs; the state passes from row to row, so it cuts nothing.
WIDTH = 128
#: Labelled documents of each class that the model is fitted on, about.
SAMPLE = 4000
SHARES = 6
ROUNDS = 2
EPOCHS = 15
REMEMBERED = 300_000


def features(word: str) -> list[str]:
    out = ["w" + word]
    out += [f"p{word[:k]}" for k in (3, 4, 5) if len(word) > k]
    if len(word) > 4:
        out.append("s" + word[-4:])
    return out


def places(word: str) -> list[int]:
    return [zlib.crc32(f.encode()) >> (32 - BITS) for f in features(word)]


@dataclass
class Model:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, np.float32))
    #: log potentials: of a toxic token at all, of toxic after clean, of toxic after toxic
    chain: np.ndarray = field(default_factory=lambda: np.array([-2.0, 0.0, 1.0]))
    scale: np.ndarray = field(default_factory=lambda: np.zeros(4))

    def __post_init__(self):
        self.known: dict[str, float] = {}

    def __getstate__(self):
        return {"weights": self.weights, "chain": self.chain, "scale": self.scale}

    def __setstate__(self, state):
        self.__dict__ |= state
        self.known = {}

    def potential(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = self.known[word] = float(self.weights[places(word)].sum())
        return found


class Grid:
    """Places of documents' tokens on rows of WIDTH tokens, so that one step of the recursion serves all rows at once."""

    def __init__(self, lengths: list[int]):
        n = np.array(lengths, dtype=np.int64)
        rows = -(-n // WIDTH)
        first = np.cumsum(rows) - rows
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        self.rows = int(rows.sum())
        self.at = (within % WIDTH) * self.rows + np.repeat(first, n) + within // WIDTH
        self.starts = within == 0  # of tokens: the first of its document
        self.longest = int(rows.max()) if len(rows) else 0
        order = np.argsort(-rows, kind="stable")
        #: turns[k]: the k-th rows of all documents that have so many
        self.turns = [first[order[: np.searchsorted(-rows[order], -k, "left")]] + k for k in range(self.longest)]

    def put(self, values: np.ndarray, empty: float) -> np.ndarray:
        out = np.full(WIDTH * self.rows, empty)
        out[self.at] = values
        return out.reshape(WIDTH, self.rows)

    def take(self, grid: np.ndarray) -> np.ndarray:
        return grid.reshape(-1)[self.at]


def marginals(e: np.ndarray, grid: Grid, chain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over whole documents: e holds the tokens' log potentials, document after document.

    Returns P(toxic) per token, and P(toxic, toxic before) per token.  Both recursions map odds to (a * odds + b) / (c * odds + d); each row's
    map is multiplied out first, then the odds pass from row to row of a document, then the rows are filled.
    """
    if not len(e):
        return e, e
    odd = np.exp(np.clip(e + chain[0], -40, 40))
    after_clean, after_toxic = math.exp(chain[1]), math.exp(chain[2])
    here, live = grid.put(odd, 1.0), grid.put(np.ones(len(e), bool), 0.0) > 0
    enter_ahead = np.full(grid.rows, np.nan)  # odds of the token before the row; none before a document
    enter_back = np.ones(grid.rows)  # odds of what follows the row, toxic against clean
    if grid.longest > 1:
        a, b, c, d = np.ones(grid.rows), np.zeros(grid.rows), np.zeros(grid.rows), np.ones(grid.rows)
        for x in here:
            a, b, c, d = x * (after_toxic * a + after_clean * c), x * (after_toxic * b + after_clean * d), a + c, b + d
            s = a + b + c + d
            a, b, c, d = a / s, b / s, c / s, d / s
        whole = _row_ends(here, after_clean, after_toxic)
        for k in range(1, grid.longest):
            now = grid.turns[k]
            before = enter_ahead[now - 1]
            new = (a[now - 1] * before + b[now - 1]) / (c[now - 1] * before + d[now - 1])
            enter_ahead[now] = np.where(np.isnan(before), whole[now - 1], new)
        a, b, c, d = np.ones(grid.rows), np.zeros(grid.rows), np.zeros(grid.rows), np.ones(grid.rows)
        for x, on in zip(here[::-1], live[::-1]):
            x = np.where(on, x, 0.0)
            na, nb, nc, nd = d_step(x, after_clean, after_toxic, a, b, c, d)
            a, b, c, d = (np.where(on, new, old) for new, old in zip((na, nb, nc, nd), (a, b, c, d)))
            s = a + b + c + d
            a, b, c, d = a / s, b / s, c / s, d / s
        for k in range(grid.longest - 1, 0, -1):
            now = grid.turns[k]
            enter_back[now - 1] = (a[now] * enter_back[now] + b[now]) / (c[now] * enter_back[now] + d[now])
    ahead = np.empty_like(here)  # odds of toxic given what stands before and here
    last = enter_ahead
    for t in range(WIDTH):
        last = here[t] * (after_clean + after_toxic * last) / (1 + last) if t else np.where(np.isnan(last), here[0], here[0] * (after_clean + after_toxic * last) / (1 + last))
        ahead[t] = last
    back = np.empty_like(here)
    last = enter_back
    for t in range(WIDTH - 1, -1, -1):
        back[t] = last
        o = here[t] * last
        last = np.where(live[t], (1 + o * after_toxic) / (1 + o * after_clean), last)
    odds, back = grid.take(ahead) * grid.take(back), grid.take(back)
    p = odds / (1 + odds)
    pair = np.zeros(len(e))  # P(toxic here and before) = P(before) * P(here | before toxic)
    o = odd[1:] * back[1:] * after_toxic
    pair[1:] = p[:-1] * o / (1 + o)
    pair[grid.starts] = 0
    return p, pair


def d_step(x: np.ndarray, after_clean: float, after_toxic: float, a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, ...]:
    """The map odds -> (1 + x * odds * after_toxic) / (1 + x * odds * after_clean), after the map a, b, c, d."""
    return c + x * after_toxic * a, d + x * after_toxic * b, c + x * after_clean * a, d + x * after_clean * b


def _row_ends(here: np.ndarray, after_clean: float, after_toxic: float) -> np.ndarray:
    """Odds of the last token of each row, if the row is the first of its document."""
    last = here[0]
    for x in here[1:]:
        last = x * (after_clean + after_toxic * last) / (1 + last)
    return last


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """h, toxic, text and weight of about `sample` labelled documents of each class, none of them held out; equal texts are one row.

    Ids are counted and drawn from the labels alone; texts are fetched for the drawn ids, of which there are 2 * sample, about.
    """
    marks = columns(labels, doc_id="long", toxic="int").filter("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = marks.filter(~held_out(F.col("doc_id")))
    sizes = {r.toxic: r.n for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.when(F.col("toxic") == 1, min(1.0, sample / max(1, sizes.get(1, 0)))).otherwise(min(1.0, sample / max(1, sizes.get(0, 0))))
    drawn = marks.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30)).withColumn("weight", 1 / share)
    rows = columns(docs, doc_id="long", text="string").join(F.broadcast(drawn), "doc_id").withColumn("h", F.xxhash64("text"))
    return rows.groupBy("h").agg(F.max("toxic").alias("toxic"), F.first("text").alias("text"), F.sum("weight").alias("weight"))


def seeds(rows: DataFrame) -> set[str]:
    """Features that mark toxic documents of the sample; where none is far more frequent there, the most telling ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            toxic, clean = Counter(), Counter()
            for text, mark in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                (toxic if mark else clean).update({f for w in set(WORD.findall((text or "").lower())) for f in features(w)})
            names = list(toxic.keys() | clean.keys())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([toxic[x] for x in names], pa.int64()), pa.array([clean[x] for x in names], pa.int64())], ["feature", "toxic", "clean"])

    n = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    t, c = n.get(1, 0), n.get(0, 0)
    sums = rows.select("text", "toxic").mapInArrow(count, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    gap = F.log((F.col("t") + 0.5) / (t + 1.0)) - F.log((F.col("c") + 0.5) / (c + 1.0))
    known = cut(sums.filter(F.col("t") >= max(min(3, t), 0.005 * t)).select("feature", gap.alias("gap")).filter("gap > 0"))
    best = known.agg(F.max("gap")).first()[0] or 0.0
    return {r.feature for r in known.filter(F.col("gap") > min(2.5, 0.8 * best)).select("feature").collect()}  # of the bounded sample


def learn(texts: list[str], marks: list[int], strong: set[str], model: Model) -> Model:
    """Gradient steps (AdaGrad) on the conditional likelihood of the labelled tokens."""
    types: dict[str, int] = {}
    ids, lengths, flags = [], [], []
    for text, mark in zip(texts, marks):
        words = WORD.findall((text or "").lower())
        ids += [types.setdefault(w, len(types)) for w in words]
        lengths.append(len(words))
        flags.append(mark)
    if not ids:
        return model
    seed = np.array([any(f in strong for f in features(w)) for w in types])
    place = [places(w) for w in types]
    owner, spot = np.repeat(np.arange(len(place)), [len(p) for p in place]), np.concatenate(place)
    ids = np.array(ids)
    y = seed[ids] & np.repeat(np.array(flags) == 1, lengths)
    grid = Grid(lengths)
    gold = y.astype(float)
    before = np.concatenate([[0.0], gold[:-1]]) * ~grid.starts
    weights, chain = model.weights.astype(float), model.chain.copy()
    g2, c2 = np.full(len(weights), 1e-6), np.full(3, 1e-6)
    for _ in range(EPOCHS):
        e = np.bincount(owner, weights[spot], len(place))[ids]
        p, pair = marginals(e, grid, chain)
        d = gold - p
        by_type = np.bincount(ids, d, len(place))
        g = np.bincount(spot, by_type[owner], len(weights)) - 0.02 * weights
        both = (gold * before - pair).sum()
        c = np.array([d.sum(), d[~grid.starts].sum() - both, both])
        g2 += g * g
        c2 += c * c
        weights += 0.5 * g / np.sqrt(g2)
        chain = np.clip(chain + 0.3 * c / np.sqrt(c2), -6, 6)
    return Model(weights.astype(np.float32), chain)


def score_batch(model: Model, texts: list[str | None], spans: bool = True) -> dict[str, list]:
    """expected toxic tokens, largest and mean marginal, and start:end of the offending tokens, per text."""
    get = model.potential
    words = [WORD.findall((t or "").lower()) for t in texts]
    lengths = [len(w) for w in words]
    e = np.fromiter((get(x) for w in words for x in w), float, sum(lengths))
    p = marginals(e, Grid(lengths), model.chain)[0]
    ends = np.cumsum(lengths)
    out = {"total": [], "most": [], "mean": [], "spans": []}
    for k, (b, n) in enumerate(zip(ends, lengths)):
        mine = p[b - n : b]
        out["total"].append(float(mine.sum()))
        out["most"].append(float(mine.max()) if n else 0.0)
        out["mean"].append(float(mine.mean()) if n else 0.0)
        hits = np.flatnonzero(mine > 0.5) if spans and n and mine.max() > 0.5 else ()
        where = [m.span() for m in WORD.finditer(texts[k])] if len(hits) else []
        # lower-casing may change the number of words in rare scripts; then the document is marked as a whole
        out["spans"].append(",".join(f"{where[h][0]}:{where[h][1]}" for h in hits) if len(where) == n else f"0:{len(texts[k])}" if len(hits) else "")
    return out


def signs(total: np.ndarray, most: np.ndarray, mean: np.ndarray) -> np.ndarray:
    return np.stack([np.ones_like(total), np.log1p(total), most, np.sqrt(mean)], -1)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A field and its calibration from labelled documents outside the held-out fold; about `sample` documents per class.

    Rows with null ids, null labels or labels other than 0 and 1 take no part; an id with both labels is toxic.  Texts of any length
    are used whole.  Without both classes, the score is a constant.
    """
    prepare(docs.sparkSession)
    rows = cut(training_rows(docs, labels, sample))
    strong = seeds(rows)
    dealt = rows.select("text", "toxic", F.pmod("h", F.lit(SHARES)).alias("share"))
    model = Model()
    for _ in range(ROUNDS if strong else 0):

        start = model

        def fitted(part: pd.DataFrame) -> pd.DataFrame:
            m = learn(part["text"].tolist(), part["toxic"].tolist(), strong, start)  # noqa: B023 (collected in this round)
            return pd.DataFrame({"n": [len(part)], "weights": [m.weights.astype("<f4").tobytes()], "chain": [m.chain.tolist()]})

        parts = dealt.groupBy("share").applyInPandas(fitted, "n long, weights binary, chain array<double>").collect()  # SHARES rows of 2^BITS weights
        whole = sum(r.n for r in parts)
        model = Model(sum(r.n / whole * np.frombuffer(r.weights, "<f4") for r in parts).astype(np.float32), sum(r.n / whole * np.array(r.chain) for r in parts))
    final = model
    marks = map_batches(rows.select("toxic", "weight", "text"), lambda x: {k: v for k, v in score_batch(final, x["text"], False).items() if k != "spans"}, "total double, most double, mean double", "toxic", "weight").toPandas()
    x, y, w = signs(marks["total"].to_numpy(), marks["most"].to_numpy(), marks["mean"].to_numpy()), marks["toxic"].to_numpy(), marks["weight"].to_numpy()
    model.scale = logistic(x, y, w)
    return model


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression by damped Newton steps."""
    b = np.zeros(x.shape[1])
    if len(x):
        w = w / w.mean()
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
            g = x.T @ (w * (y - p)) - 0.05 * b
            h = (x * (w * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(b))
            step = np.linalg.solve(h, g)
            b = b + np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
    return b


def with_scores(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with score (0 to 1), toxic_tokens (expected number) and spans (start:end of offending tokens, joined) of each row; no shuffle.

    All rows and other columns stay, but for columns of these three names, which are replaced.  A null text counts as empty and gets the
    score of no toxic token.  Null or repeated ids are scored like others, texts of any length whole; an empty table gives an empty result.
    """
    docs = docs.drop("score", "toxic_tokens", "spans")

    def run(rows: dict[str, list]) -> dict[str, list]:
        found = score_batch(model, rows[text_col])
        z = signs(*(np.array(found[k]) for k in ("total", "most", "mean"))) @ model.scale
        return {"score": (1 / (1 + np.exp(-np.clip(z, -30, 30)))).tolist(), "toxic_tokens": found["total"], "spans": found["spans"]}

    run.reads = (text_col,)
    return map_batches(docs, run, "score double, toxic_tokens double, spans string", *docs.columns)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, toxic_tokens and spans of each row of docs, as with_scores has them; only id and text are read."""
    return with_scores(columns(docs, doc_id="long", text="string"), model).drop("text")
