"""Mixing sources to target weights: random keys, a range sort, prefix sums of words, exact cuts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Steps, running_total, word_count

WEIGHTS = (5, 2, 1)


def targets(steps: Steps, sources: DataFrame, weights: Sequence[int], share_percent: int, most: int) -> DataFrame:
    """Adds ``target`` to one row per source (``no_name, name, source_size``).

    Weights repeat along the sources in code point order, null last. Sizes times ``share_percent`` are
    dealt by weight; what exceeds ``most`` times a source's size goes to the others by weight. That is one
    water level: sources sorted by size per weight are full up to a point and share the rest beyond it.
    """
    total = sources.agg(F.sum("source_size"), F.count(F.lit(1))).first()
    size, count = int(total[0] or 0), total[1]
    cycle = len(weights)
    all_weight = (count // cycle) * sum(weights) + sum(weights[: count % cycle])
    unit = math.lcm(*weights)
    ranked = running_total(steps, sources, [], ["no_name", "name"], {"place": F.lit(1)})
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % cycle + 1).cast("int"))
    weighted = ranked.withColumn("weight", weight.cast("bigint")).withColumn(
        "level", F.col("source_size") * F.expr(f"{unit} div weight")
    )
    filled = running_total(
        steps,
        weighted,
        [],
        ["level", "no_name", "name"],
        {"lower_size": F.col("source_size"), "lower_weight": F.col("weight")},
    )
    big = lambda name: F.col(name).cast("decimal(19,0)")
    budget = F.lit(size * share_percent).cast("decimal(19,0)")
    # most * size_i / weight_i <= (budget - most * lower sizes) / (weight that is left)
    full = (
        big("source_size") * F.lit(100 * most).cast("decimal(5,0)") * (F.lit(all_weight).cast("decimal(12,0)") - F.col("lower_weight").cast("decimal(12,0)"))
        <= big("weight").cast("decimal(6,0)") * (budget - big("lower_size") * F.lit(100 * most).cast("decimal(5,0)"))
    )
    marked = steps.table(filled.withColumn("full", full))
    taken = marked.where("full").agg(F.sum("source_size"), F.sum("weight")).first()
    rest = size * share_percent - 100 * most * int(taken[0] or 0)
    rest_weight = all_weight - int(taken[1] or 0)
    level = F.col("weight").cast("double") * F.lit(float(rest)) / F.lit(float(max(1, 100 * rest_weight)))
    return marked.withColumn("target", F.when(F.col("full"), F.col("source_size") * F.lit(float(most))).otherwise(level))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share_percent: int = 150,
    most: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """How many words of each document the mix takes.

    Returns ``doc_id, source, size, source_size, target, taken``, one row per input row. Each source's
    documents stand in the order of a hash of ``doc_id`` and the seed; the source is read over and over in
    that order until its target is met, and the last document is cut there, so the words taken equal the
    target rounded down. A null text has no words; a null source is a source of its own, last in order;
    rows that repeat a document each have their own place; an empty table gives an empty result.
    """
    steps = Steps(docs.sparkSession)
    sized = steps.table(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            "source",
            F.col("source").isNull().alias("no_name"),
            F.coalesce("source", F.lit("")).alias("name"),
            word_count(F.col("text")).alias("size"),
        )
    )
    sources = steps.table(sized.groupBy("no_name", "name").agg(F.sum("size").alias("source_size")))
    budgets = steps.table(
        targets(steps, sources, weights, share_percent, most).select("no_name", "name", "source_size", "target")
    )
    keyed = sized.withColumn("key", F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":" + seed)).cast("binary")))
    placed = running_total(steps, keyed, ["no_name", "name"], ["key", "doc_id", "size"], {"before": F.col("size")})
    whole = F.floor("target").cast("bigint")
    return (
        placed.join(budgets, ["no_name", "name"])
        .withColumn("_whole", whole)
        .withColumn("_rounds", F.when(F.col("source_size") > 0, F.expr("_whole div source_size")).otherwise(F.lit(0)))
        .withColumn("_part", F.col("_whole") - F.col("_rounds") * F.col("source_size"))
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            (
                F.col("_rounds") * F.col("size")
                + F.greatest(F.lit(0), F.least(F.col("size"), F.col("_part") - F.col("before")))
            ).cast("bigint").alias("taken"),
        )
    )


def taken_documents(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The documents as often as the plan takes them; a document that the cut hits ends after its last word taken.

    Rows with the same ``doc_id`` follow the plan of the one that takes most. Documents without words stay
    out, as no budget covers them.
    """
    shares = plan.where("taken > 0").groupBy(F.col("doc_id").alias("_of")).agg(
        F.max_by(F.struct("taken", "size"), F.struct("taken", "size")).alias("_share")
    )
    copies = F.expr("transform(sequence(0, int(ceil(_share.taken / _share.size)) - 1), i -> least(_share.size, _share.taken - i * _share.size))")
    rows = docs.join(shares.hint("merge"), docs["doc_id"].cast("bigint").eqNullSafe(shares["_of"])).withColumn("_words", F.explode(copies))
    # Pieces of blanks and one word each, so that the text up to a word is kept as it is.
    pieces = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.array_join(F.slice(pieces, F.lit(1), F.greatest(F.col("_words"), F.lit(1)).cast("int")), "")
    text = F.when(F.col("_words") >= F.col("_share.size"), F.col("text")).otherwise(cut)
    return rows.withColumn("text", text).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


CHECK = r"""
WITH sized AS (
  SELECT doc_id, source, source IS NULL AS no_name, coalesce(source, '') AS name,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(doc_id::VARCHAR || ':mix') AS key
  FROM documents),
sources AS (
  SELECT no_name, name, sum(size)::HUGEINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY no_name, name) - 1) % 3 + 1)::INT]::HUGEINT AS weight
  FROM sized GROUP BY no_name, name),
lower AS (
  SELECT *, sum(source_size) OVER () AS all_size, sum(weight) OVER () AS all_weight,
         coalesce(sum(source_size) OVER w, 0) AS lower_size, coalesce(sum(weight) OVER w, 0) AS lower_weight
  FROM sources
  WINDOW w AS (ORDER BY source_size * 10 // weight, no_name, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (
  SELECT *, source_size * 200 * (all_weight - lower_weight) <= weight * (all_size * 150 - 200 * lower_size) AS is_full FROM lower),
budgets AS (
  SELECT no_name, name, source_size::BIGINT AS source_size,
         CASE WHEN is_full THEN source_size::DOUBLE * 2.0
              ELSE weight::DOUBLE * (all_size * 150 - 200 * coalesce(sum(source_size) FILTER (is_full) OVER (), 0))::DOUBLE
                   / greatest(1, 100 * (all_weight - coalesce(sum(weight) FILTER (is_full) OVER (), 0)))::DOUBLE END AS target
  FROM marked),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY no_name, name ORDER BY key, doc_id, size
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized),
cut AS (
  SELECT p.*, b.source_size, b.target, floor(b.target)::BIGINT AS whole,
         CASE WHEN b.source_size > 0 THEN floor(b.target)::BIGINT // b.source_size ELSE 0 END AS rounds
  FROM placed p JOIN budgets b USING (no_name, name))
SELECT doc_id, source, size, source_size, target,
       (rounds * size + greatest(0, least(size, whole - rounds * source_size - before)))::BIGINT AS taken
FROM cut
"""
