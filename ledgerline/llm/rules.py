"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Statistics, votes and the verdict are column expressions. What reaches the driver is one count per
pattern of votes: at most 3 to the power of the number of rules, whatever the number of documents.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import BLANKS, Steps, let, words

SYMBOLS = "#*$%&|<>"
# Letters, digits and inner marks, with at most one sentence mark and quote or bracket around them.
PLAIN = r"^[\"'(]?[\p{L}\p{M}\p{N}][\p{L}\p{M}\p{N}'’.,-]*[:;?!]?[\"')]?$"
ROUNDS = 50


def repeated_words(words_: Column) -> Column:
    """Words that lie in three-word windows found twice or more in the text.

    Each window becomes a number: a hash above, its place in the low bits. Sorted, equal windows are
    neighbours (their words are compared as well); the places of those found twice are sorted again, and
    each covers up to the next place or three words. A text without two windows has none.
    """

    def of(w: Column, bits: Column) -> Column:
        hashed = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        code = lambda i: _up(_down(hashed(i), bits), bits).bitwiseOR(i.cast("bigint"))
        starts = F.sequence(F.lit(0), F.size(w) - 3)
        mask = _up(F.lit(1).cast("bigint"), bits) - 1
        return let(F.sort_array(F.transform(starts, code)), lambda s: twice(w, s, bits, mask))

    def twice(w: Column, s: Column, bits: Column, mask: Column) -> Column:
        place = lambda x: x.bitwiseAND(mask).cast("int")
        alike = lambda x, y: (
            (_down(x.bitwiseXOR(y), bits) == 0)
            & (F.get(w, place(x)) == F.get(w, place(y)))
            & (F.get(w, place(x) + 1) == F.get(w, place(y) + 1))
            & (F.get(w, place(x) + 2) == F.get(w, place(y) + 2))
        )
        found = F.filter(s, lambda x, j: alike(x, F.get(s, j - 1)) | alike(x, F.get(s, j + 1)))
        return let(F.sort_array(F.transform(found, place)), covered)

    def covered(p: Column) -> Column:
        sum_of = F.aggregate(
            F.sequence(F.lit(0), F.size(p) - 1),
            F.lit(0),
            lambda sum_, k: sum_ + F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - F.get(p, k), F.lit(3))),
        )
        return F.when(F.size(p) == 0, F.lit(0)).otherwise(sum_of)

    # sequence() counts down when its end is below its start, so short inputs are kept from it.
    bits = lambda w: F.length(F.bin(F.size(w).cast("bigint")))
    return let(
        words_, lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(let(bits(w), lambda b: of(w, b)))
    ).cast("bigint")


def _up(value: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", value, bits)


def _down(value: Column, bits: Column) -> Column:
    return F.call_function("shiftright", value, bits)


def statistics(docs: DataFrame) -> DataFrame:
    """Counts of whole texts that the rules look at; null texts count as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), words(F.col("text")).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    count = lambda characters: F.length("text") - F.length(F.translate("text", characters, ""))
    upper = F.length("text") - F.length(F.regexp_replace("text", r"\p{Lu}+", ""))
    ended = F.filter("words", lambda w: F.substring(w, -1, 1).isin(".", "!", "?", ",", ";", ":"))
    return base.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        count(SYMBOLS).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.size(lines).cast("bigint").alias("n_lines"),
        upper.cast("bigint").alias("n_upper"),
        count("!").cast("bigint").alias("n_marks"),
        F.size(ended).cast("bigint").alias("n_ended"),
        F.size(F.array_distinct(F.transform("words", lambda w: F.xxhash64(w)))).cast("bigint").alias("n_distinct"),
        F.size(F.filter("words", lambda w: w.rlike(PLAIN))).cast("bigint").alias("n_plain"),
    )


@dataclass(frozen=True)
class Rule:
    """Votes on the ratio of two counts: bad on the far side of ``bad``, good on the other side of ``good``.

    Without ``good`` a rule only ever finds fault: the absence of one fault says little about the others,
    and a vote for it would drown the fault. It abstains otherwise, and when ``whole`` is below ``least``.
    """

    name: str
    part: str
    whole: str
    bad: float
    good: float | None = None
    least: int = 1

    def vote(self) -> Column:
        ratio = F.col(self.part) / F.col(self.whole)
        if self.good is None:
            bad, good = ratio >= self.bad, F.lit(False)
        elif self.good <= self.bad:
            bad, good = ratio >= self.bad, ratio <= self.good
        else:
            bad, good = ratio <= self.bad, ratio >= self.good
        return F.when(F.col(self.whole) < self.least, 0).when(good, 1).when(bad, -1).otherwise(0)


RULES = (
    Rule("symbols", "n_symbols", "n_words", bad=0.2),
    Rule("marks", "n_marks", "n_words", bad=0.3),
    Rule("capitals", "n_upper", "word_chars", bad=0.35),
    Rule("repeated_windows", "n_repeat_words", "n_words", bad=0.3, least=20),
    Rule("repeated_lines", "n_dup_lines", "n_lines", bad=0.5, least=4),
    Rule("plain_words", "n_plain", "n_words", bad=0.75, good=0.9),
    Rule("sentence_marks", "n_ended", "n_words", bad=0.02, good=0.04, least=30),
    Rule("vocabulary", "n_distinct", "n_words", bad=0.15, good=0.3, least=50),
)


@dataclass(frozen=True)
class Weights:
    """Prior probability of good quality and, per rule, probabilities of the votes -1, 0, 1 in good and bad texts."""

    prior: float
    good: tuple[tuple[float, float, float], ...]
    bad: tuple[tuple[float, float, float], ...]

    def log_odds(self, votes: Sequence[int]) -> float:
        total = math.log(self.prior / (1 - self.prior))
        for vote, good, bad in zip(votes, self.good, self.bad, strict=True):
            total += math.log(good[vote + 1] / bad[vote + 1])
        return total


def fit(patterns: Sequence[tuple[Sequence[int], int]], n_rules: int, rounds: int = ROUNDS) -> Weights:
    """Expectation-maximisation over counted patterns of votes.

    Starts from votes taken at their word (right four times of five), with half a document of each kind of
    vote added so that no probability is 0 or 1. Patterns are visited in sorted order, so reruns agree.
    """
    start = Weights(0.8, ((0.2, 0.3, 0.5),) * n_rules, ((0.5, 0.3, 0.2),) * n_rules)
    patterns = sorted((tuple(votes), count) for votes, count in patterns)
    total = sum(count for _, count in patterns)
    if not total:
        return start
    weights = start
    for _ in range(rounds):
        mass = [0.0, 0.0]
        seen = [[[0.5, 0.5, 0.5] for _ in range(n_rules)] for _ in range(2)]
        for votes, count in patterns:
            odds = weights.log_odds(votes)
            p = 1 / (1 + math.exp(-odds)) if odds > -700 else 0.0
            for kind, share in ((1, p * count), (0, (1 - p) * count)):
                mass[kind] += share
                for rule, vote in enumerate(votes):
                    seen[kind][rule][vote + 1] += share
        tables = [tuple(tuple(c / sum(row) for c in row) for row in seen[kind]) for kind in range(2)]
        weights = Weights((mass[1] + 0.5) / (total + 1), tables[1], tables[0])
    return weights


def posterior(weights: Weights, votes: Sequence[Column]) -> Column:
    """Probability of good quality as a column."""
    odds = F.lit(math.log(weights.prior / (1 - weights.prior)))
    for vote, good, bad in zip(votes, weights.good, weights.bad, strict=True):
        logs = [math.log(g / b) for g, b in zip(good, bad, strict=True)]
        odds = odds + F.when(vote == -1, logs[0]).when(vote == 0, logs[1]).otherwise(logs[2])
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, threshold: float = 0.5) -> DataFrame:
    """Statistics, base rule, posterior quality and verdict of every document, one row per input row.

    Weights are fitted on all documents. Null and empty texts have no words, fail the base rule and are not
    kept; an empty table gives an empty result; repeated rows are judged alike.
    """
    steps = Steps(docs.sparkSession)
    counted = steps.table(statistics(docs))
    names = [f"vote_{rule.name}" for rule in rules]
    voted = counted.select("*", *[rule.vote().alias(name) for rule, name in zip(rules, names, strict=True)])
    patterns = [(row[:-1], row[-1]) for row in map(tuple, voted.groupBy(*names).count().collect())]
    weights = fit(patterns, len(rules))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return voted.select(
        "*", failed.alias("base_failed"), posterior(weights, [F.col(name) for name in names]).alias("quality")
    ).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
