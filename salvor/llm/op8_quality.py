"""Quality classifier: a generalised additive model with pairwise interactions."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salvor.llm.common import arrow_batches, free_name, table

#: Labelled rows that the model learns from, at most; the first by a hash of doc_id.
SAMPLE = 20_000
THRESHOLD = 0.3
FEATURES = ("words", "word_length", "upper", "symbols", "bars", "shouts", "digits", "stops", "variety", "repeats", "line_length", "high_bytes", "marked_words",
            "entropy", "top_word", "sentence_length", "short_words", "long_words", "repeated_trigrams")

_UPPER, _LOWER, _DIGIT, _SYMBOL = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = _LOWER[97:123] = _DIGIT[48:58] = True
_SYMBOL[list(b"#$%&*@^~<>{}[]=+_\\/")] = True


def features(text: str | None) -> list[float]:
    """Measures of a whole text by its bytes, words, word triples and lines; an empty one has zeros."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    n = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    letters = max(1, int(n[_UPPER].sum() + n[_LOWER].sum()))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    size, many, counts = len(raw), len(words), Counter(words)
    sizes = np.fromiter(map(len, words), np.int64, many)
    marked = sum(c for w, c in counts.items() if not w[-1:].isalnum() and w[-1] < 128 and w[-1] not in b".,;:")
    share = n[n > 0] / size
    triples = max(1, many - 2)
    return [
        np.log1p(many), sizes.mean(), n[_UPPER].sum() / letters, n[_SYMBOL].sum() / size,
        n[124] / many, n[33] / many, n[_DIGIT].sum() / size, (n[46] + n[44]) / many, len(counts) / many,
        1 - len(set(lines)) / len(lines), np.log1p(size / len(lines)), n[128:].sum() / size, marked / many,
        -(share * np.log2(share)).sum(), max(counts.values()) / many, np.log1p(many / (1 + n[46] + n[33] + n[63])), (sizes <= 2).mean(), (sizes >= 20).mean(),
        1 - len(set(zip(words, words[1:], words[2:], strict=False))) / triples if many > 2 else 0.0,
    ]


def feature_rows(texts) -> np.ndarray:
    return np.array([features(t) for t in texts], float).reshape(-1, len(FEATURES))


@dataclass
class Additive:
    """Lookup tables: one per feature over its bins, one per pair over the pair's coarse bins."""

    intercept: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        bins = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(self.cuts)]
        out = np.full(len(x), self.intercept)
        for t, b in zip(self.tables, bins, strict=True):
            out += t[b]
        for i, j, t in self.pairs:
            out += t[self.coarse[i][bins[i]], self.coarse[j][bins[j]]]
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g * g / (h + ridge)


def _split(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[int, float]:
    """The best cut of a histogram into a left and a right part, and its gain."""
    a, b = g.cumsum()[:-1], h.cumsum()[:-1]
    if not len(a):
        return 0, 0.0
    gain = _gain(a, b, ridge) + _gain(g.sum() - a, h.sum() - b, ridge) - _gain(g.sum(), h.sum(), ridge)
    k = int(gain.argmax())
    return k + 1, float(gain[k])


def shallow_tree(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """Leaf values by bin of a tree with two levels over one feature's histogram."""
    out = np.zeros(len(g))
    k, gain = _split(g, h, ridge)
    parts = [(0, k), (k, len(g))] if gain > 1e-9 else [(0, len(g))]
    for a, b in parts:
        m, more = _split(g[a:b], h[a:b], ridge)
        for x, y in ((a, a + m), (a + m, b)) if more > 1e-9 else ((a, b),):
            if y > x:
                out[x:y] = -g[x:y].sum() / (h[x:y].sum() + ridge)
    return out


def shallow_tree_pair(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """Leaf values over two features' grid: a cut in one, then one in the other on each side."""
    best, leaf = -1.0, np.zeros_like(g)
    for turn in (False, True):
        gg, hh = (g.T, h.T) if turn else (g, h)
        k, _ = _split(gg.sum(1), hh.sum(1), ridge)
        value, total = np.zeros_like(gg), 0.0
        for rows in (slice(0, k), slice(k, len(gg))):
            a, b = gg[rows].sum(0), hh[rows].sum(0)
            m, _ = _split(a, b, ridge)
            for cols in (slice(0, m), slice(m, len(a))):
                s, t = a[cols].sum(), b[cols].sum()
                value[rows, cols] = -s / (t + ridge)
                total += s * s / (t + ridge)
        if total > best:
            best, leaf = total, value.T if turn else value
    return leaf, best


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, coarse_bins: int = 8, rounds: int = 150, pair_rounds: int = 60, n_pairs: int = 6, rate: float = 0.1, ridge: float = 5.0) -> Additive:
    """Cyclic boosting: each round gives every feature in turn a shallow tree on the current
    gradient, added to its table; then the pairs that explain most of the rest take turns. With
    no rows or one class, the model is that class's smoothed share."""
    share = (y.sum() + 1) / (len(y) + 2)
    intercept = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.empty(0) for j in range(len(FEATURES))]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    coarse = [(np.arange(len(t)) * coarse_bins // len(t)).astype(int) for t in tables]
    model = Additive(intercept, cuts, tables, coarse, [])
    if len(set(y.tolist())) < 2:
        return model
    b = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(cuts)]
    f = np.full(len(y), intercept)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-f))
        return p - y, p * (1 - p)

    for _ in range(rounds):
        for j, t in enumerate(tables):
            if len(t) > 1:
                g, h = slope()
                step = rate * shallow_tree(np.bincount(b[j], g, len(t)), np.bincount(b[j], h, len(t)), ridge)
                t += step
                f += step[b[j]]
    grid = lambda i, j, w: np.bincount(coarse[i][b[i]] * coarse_bins + coarse[j][b[j]], w, coarse_bins**2).reshape(coarse_bins, coarse_bins)
    g, h = slope()
    ranked = sorted(((shallow_tree_pair(grid(i, j, g), grid(i, j, h), ridge)[1], i, j) for i in range(len(cuts)) for j in range(i)), reverse=True)
    model.pairs = [(i, j, np.zeros((coarse_bins, coarse_bins))) for _, i, j in ranked[:n_pairs]]
    for _ in range(pair_rounds):
        for i, j, t in model.pairs:
            g, h = slope()
            step = rate * shallow_tree_pair(grid(i, j, g), grid(i, j, h), ridge)[0]
            t += step
            f += step[coarse[i][b[i]], coarse[j][b[j]]]
    return model


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Additive:
    """Fit on at most ``sample`` labelled rows that aren't held out. The labels chosen are that
    many rows of two numbers, which bounds their broadcast; the driver gets as many rows of
    features. Rows whose label is null or whose doc_id has two labels don't teach."""
    chosen = labels.where("quality is not null and doc_id is not null").where(~held_out())
    chosen = chosen.groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("z")).where("y = z")
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("doc_id", "y")
    schema = "doc_id long, y int, h long, x array<double>"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"doc_id": f["doc_id"], "y": f["y"], "h": f["h"], "x": list(map(features, f["text"]))})

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "y", F.xxhash64("text").alias("h"), "text")
    got = sorted(rows.mapInPandas(run, schema).orderBy("h", "doc_id").limit(sample).collect(), key=lambda r: (r["doc_id"], r["h"]))
    x = np.array([r["x"] for r in got], float).reshape(-1, len(FEATURES))
    return fit(x, np.array([r["y"] for r in got], float))


def scorer(model: Additive):
    """A column function: text to the model's probability of label 1."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(feature_rows(texts)))

    return score


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with held_out, score and predicted. Text alone makes a score: null and empty texts
    score as a text of no words; repeated rows score alike; without usable labels every score is
    one half; an empty table gives no rows; further columns pass through, and where one has the
    name of an added column, that has an underscore at its end."""
    arrow_batches(docs.sparkSession)
    score = scorer(train(docs, labels))
    held, value, predicted = (free_name(c, docs.columns) for c in ("held_out", "score", "predicted"))
    out = docs.withColumns({held: held_out(), value: score("text")})
    return out.withColumn(predicted, (F.col(value) >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier predicts as 1, with their own columns."""
    predicted = free_name("predicted", docs.columns)
    return scored(docs, labels).where(F.col(predicted) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_quality_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scored(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")
