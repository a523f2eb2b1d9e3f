"""Quality classifier: a sparse ensemble of rules over text statistics, as one column expression.

Shallow boosted trees are grown on a bounded sample of labelled rows; every path from a root becomes a rule,
a conjunction of thresholds on statistics. Lasso-penalised logistic regression keeps few rules, with weights.
The rules that stay are compiled to column expressions, so scoring a corpus is one projection.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import BLANKS, crc32_text, let, words
from ledgerline.llm.rules import PLAIN, SYMBOLS

# Labelled rows used for fitting: about so many, dealt by hash, and never more than twice that.
SAMPLE_ROWS = 20_000
TREES = 24
LEVELS = 3
CUTS = 31
LEAST_ROWS = 10
PENALTY = 0.0015
ROUNDS = 400
THRESHOLD = 0.7

STATISTICS = (
    "words", "word_length", "symbols", "marks", "capitals", "digits", "plain", "ended", "distinct", "echoes", "lines", "line_copies",
)


def with_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns and every statistic as a double; null and empty texts have zeros."""
    base = docs.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("_text"), words(F.col("text")).alias("_words"))
    less = lambda characters: F.length("_text") - F.length(F.translate("_text", characters, ""))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    ended = F.filter("_words", lambda w: F.substring(w, -1, 1).isin(".", "!", "?", ",", ";", ":"))
    counted = base.select(
        *keep,
        F.size("_words").alias("_n"),
        F.length(F.array_join("_words", "")).alias("_chars"),
        less(SYMBOLS).alias("_symbols"),
        less("!").alias("_marks"),
        less("0123456789").alias("_digits"),
        (F.length("_text") - F.length(F.regexp_replace("_text", r"\p{Lu}+", ""))).alias("_upper"),
        F.size(F.filter("_words", lambda w: w.rlike(PLAIN))).alias("_plain"),
        F.size(ended).alias("_ended"),
        F.size(F.array_distinct(F.transform("_words", lambda w: F.xxhash64(w)))).alias("_distinct"),
        let(F.col("_words"), lambda v: F.size(F.filter(v, lambda w, i: w == F.get(v, i - 1)))).alias("_echoes"),
        let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))).alias("_lines"),
    )
    per_word = lambda name: F.col(name) / F.greatest(F.col("_n"), F.lit(1))
    per_char = lambda name: F.col(name) / F.greatest(F.col("_chars"), F.lit(1))
    all_lines = F.greatest(F.col("_lines.n"), F.lit(1))
    columns = {
        "words": F.col("_n"),
        "word_length": per_word("_chars"),
        "symbols": per_word("_symbols"),
        "marks": per_word("_marks"),
        "capitals": per_char("_upper"),
        "digits": per_char("_digits"),
        "plain": per_word("_plain"),
        "ended": per_word("_ended"),
        "distinct": per_word("_distinct"),
        "echoes": per_word("_echoes"),
        "lines": F.col("_n") / all_lines,
        "line_copies": (F.col("_lines.n") - F.col("_lines.d")) / all_lines,
    }
    return counted.select(*keep, *[columns[name].cast("double").alias(f"s_{name}") for name in STATISTICS])


@dataclass(frozen=True)
class Rule:
    """``low < statistic <= high`` for each part."""

    parts: tuple[tuple[int, float, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for i, low, high in self.parts:
            out &= (x[:, i] > low) & (x[:, i] <= high)
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for i, low, high in self.parts:
            value = F.col(f"s_{STATISTICS[i]}")
            if low > -math.inf:
                out &= value > low
            if high < math.inf:
                out &= value <= high
        return out


@dataclass(frozen=True)
class Model:
    base: float
    rules: tuple[tuple[Rule, float], ...]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.base + sum((w * r.holds(x) for r, w in self.rules), np.zeros(len(x))), -30, 30)))

    def column(self) -> Column:
        odds = F.lit(self.base)
        for rule, weight in self.rules:
            odds = odds + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), odds))))


def grow(x: np.ndarray, bins: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, weight: np.ndarray) -> tuple[list[Rule], np.ndarray]:
    """Rules of one tree that fits the gradient, and its prediction."""
    found: list[Rule] = []
    value = np.zeros(len(x))

    def split(rows: np.ndarray, path: dict[int, tuple[float, float]], level: int) -> None:
        if path:
            found.append(Rule(tuple((i, low, high) for i, (low, high) in sorted(path.items()))))
        g, h = gradient[rows].sum(), weight[rows].sum()
        value[rows] = g / (h + 1.0)
        if level == LEVELS or len(rows) < 2 * LEAST_ROWS:
            return
        best, where = 1e-6, None
        for i, edges in enumerate(cuts):
            if not len(edges):
                continue
            n = len(edges) + 1
            at = bins[rows, i]
            gs, hs, ns = (np.bincount(at, w, n).cumsum()[:-1] for w in (gradient[rows], weight[rows], None))
            gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
            gain[(ns < LEAST_ROWS) | (len(rows) - ns < LEAST_ROWS)] = 0
            if gain.max() > best:
                best, where = gain.max(), (i, int(gain.argmax()))
        if where is None:
            return
        i, cut = where
        low, high = path.get(i, (-math.inf, math.inf))
        left = bins[rows, i] <= cut
        split(rows[left], path | {i: (low, float(cuts[i][cut]))}, level + 1)
        split(rows[~left], path | {i: (float(cuts[i][cut]), high)}, level + 1)

    split(np.arange(len(x)), {}, 0)
    return found, value


def lasso(z: np.ndarray, y: np.ndarray, penalty: float, rounds: int = ROUNDS) -> tuple[float, np.ndarray]:
    """Intercept and weights of logistic regression with an absolute-value penalty, by accelerated proximal steps."""
    n, width = z.shape
    if not width:
        return 0.0, np.zeros(0)
    vector = np.ones(width, z.dtype)
    for _ in range(20):
        vector = z.T @ (z @ vector)
        vector /= max(np.linalg.norm(vector), 1e-12)
    step = 4 * n / (float(np.linalg.norm(z @ vector)) ** 2 * 1.1 + n)
    w = last = np.zeros(width)
    b = last_b = float(np.log(y.mean() / (1 - y.mean())))
    for k in range(rounds):
        pull = k / (k + 3)
        v, c = w + pull * (w - last), b + pull * (b - last_b)
        error = 1 / (1 + np.exp(-np.clip(z @ v.astype(z.dtype) + c, -30, 30))) - y
        last, last_b = w, b
        moved = v - step * (z.T @ error.astype(z.dtype)) / n
        w = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        b = c - step * float(error.mean())
    return b, w


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Trees, their paths as rules, and penalised weights. One class alone gives its smoothed share as every score."""
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    prior = math.log(share / (1 - share))
    if len(y) < 2 * LEAST_ROWS or y.min() == y.max():
        return Model(prior, ())
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, CUTS + 2)[1:-1], method="lower")) for column in x.T]
    bins = np.column_stack([np.searchsorted(edges, column, "left") for edges, column in zip(cuts, x.T)])
    odds, rules = np.full(len(y), prior), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-odds))
        found, value = grow(x, bins, cuts, y - p, p * (1 - p))
        odds = np.clip(odds + 0.3 * value, -30, 30)
        for rule in found:
            holds = rule.holds(x)
            rules.setdefault(np.packbits(holds).tobytes(), (rule, holds))
    usable = [(r, h) for r, h in rules.values() if LEAST_ROWS <= h.sum() <= len(y) - LEAST_ROWS]
    if not usable:
        return Model(prior, ())
    z = np.column_stack([h for _, h in usable]).astype(np.float32)
    centre, spread = z.mean(0), z.std(0)
    b, w = lasso((z - centre) / spread, y.astype(np.float64), PENALTY)
    w = w / spread
    kept = tuple((rule, float(weight)) for (rule, _), weight in zip(usable, w) if abs(weight) > 1e-9)
    return Model(b - float(w @ centre), kept)


def training_rows(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of a bounded sample of the rows that may be learned from."""
    allowed = labels.where((crc32_text("doc_id") % 4 != 2) & F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    rate = min(1.0, sample_rows / max(1, allowed.count()))
    chosen = (
        allowed.where(F.pmod(F.xxhash64(F.col("doc_id").cast("bigint"), F.lit(1)), F.lit(1_000_000)) < int(rate * 1_000_000) + 1)
        .select(F.col("doc_id").cast("bigint").alias("_id"), (F.col("quality") >= 1).cast("int").alias("_label"))
        .limit(2 * sample_rows)
    )
    # Bounded by the sample's size, so it may be broadcast.
    joined = docs.select(F.col("doc_id").cast("bigint").alias("_id"), "text").join(F.broadcast(chosen), "_id").limit(2 * sample_rows)
    rows = with_statistics(joined, ["_id", "_label"]).drop("_id").collect()
    data = np.array(sorted(map(tuple, rows)), float).reshape(-1, 1 + len(STATISTICS))
    return data[:, 1:], data[:, 0]


def score(docs: DataFrame, model: Model, keep: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """The kept columns with ``score`` and ``predicted``."""
    value = model.column()
    scored = with_statistics(docs, keep).withColumn("score", value)
    return scored.select(*keep, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document, one row per input row.

    Learns from labels of rows whose CRC-32 of the id leaves a remainder other than 2 modulo 4; rows without
    an id or label teach nothing. Null and empty texts are scored on zeros. Without labels of both kinds each
    score is the smoothed share of label 1, or 0.5. Repeated rows score alike; an empty table gives an empty result.
    """
    model = fit(*training_rows(docs, labels))
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return score(keyed, model, ["doc_id"]).select("doc_id", (crc32_text("doc_id") % 4 == 2).alias("held_out"), "score", "predicted")
