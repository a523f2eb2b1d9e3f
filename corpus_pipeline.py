"""A training-data pipeline over documents; every stage is one operator of ``ledgerline.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next stage's docs. All but the last return the columns of ``documents``. No SQL can state the trained
classifier or the packing, so ``tests/llm/test_pipeline.py`` checks the stages against brute force.

Odd input, for every stage: an empty table gives an empty result; null texts count as empty; extra columns
pass through; rows that share a ``doc_id``, a null one too, are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import classifier, mixing, neardup, packing, repeats
from ledgerline.llm.common import Steps, with_row_keys, with_text_keys

# Near-duplicates of the pipeline: sets of five words, similarity 0.8.
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, fitted on ``labels``, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = classifier.fit(*classifier.training_rows(docs, labels))
    # Statistics read the text; the document's own columns travel beside it in one struct.
    return _replaced(classifier.score(_whole(docs, "text"), model, ["row"]).where("predicted = 1"), docs.columns)


def _whole(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns that a stage reads, and the document as one struct: no column of its own can clash with a stage's."""
    return docs.select(*columns, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def _replaced(rows: DataFrame, names: list[str], **values) -> DataFrame:
    """The documents in ``row`` with some columns replaced."""
    return rows.select(*[values[c].alias(c) if c in values else F.col("row").getField(c).alias(c) for c in names])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest ``doc_id``.

    Rows are linked by their texts alone. Documents without words are no near-duplicates and all stay.
    """
    rows = with_row_keys(Steps(spark), _whole(docs, "doc_id", "text"), "own")
    found = neardup.near_duplicates(rows.select(F.col("own").alias("doc_id"), "text"), SHINGLE_WORDS, SIMILAR_PERCENT)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("own"))
    # The list grows with the corpus, so it is not broadcast.
    return _replaced(rows.select("own", "row").join(gone.hint("merge"), "own", "left_anti"), docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of passages that also start earlier in the corpus.

    A cut inside a character removes the whole character. Documents of which nothing but blanks is left go.
    """
    steps = Steps(spark)
    rows = with_text_keys(steps, _whole(docs, "doc_id", "text"), "own")
    source = rows.select(F.col("own").alias("doc"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    # Rows that share this key have the same text, and so the same bytes are left of them.
    found = steps.table(
        repeats.removed(steps, source).where("n_removed > 0").select(F.col("doc").alias("own"), "kept").dropDuplicates(["own"])
    )
    joined = rows.select("own", "row").join(found.hint("merge"), "own", "left")
    # Bytes that are left of a cut character are no UTF-8; they are dropped.
    kept = F.col("kept").cast("string")
    cut = F.coalesce(F.try_validate_utf8(kept), F.replace(F.make_valid_utf8(kept), F.lit("\ufffd"), F.lit("")))
    whole = F.col("kept").isNull()
    text = F.when(whole, F.col("row.text")).otherwise(cut)
    changed = joined.where(whole | text.rlike(r"[^\x20\x09-\x0D]"))
    return _replaced(
        changed, docs.columns, text=text, n_chars=F.when(whole, F.col("row.n_chars")).otherwise(F.length(text).cast("bigint"))
    )


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for; at each source's budget the last one is cut."""
    steps = Steps(spark)
    rows = with_row_keys(steps, _whole(docs, "doc_id", "text", "source", "n_chars"), "own")
    own = rows.select(F.col("own").alias("doc_id"), "text", "source", "n_chars", "row")
    taken = mixing.taken_documents(own, steps.table(mixing.mix(own)))
    return _replaced(taken, docs.columns, text=F.col("text"), n_chars=F.col("n_chars"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, each with its place in a sequence of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality),
    ("minhash_near_dedup", near_duplicates),
    ("suffix_repeats", repeated_passages),
    ("mixing", mixed),
    ("packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps = Steps(spark)
    for _, stage in STAGES[:-1]:
        docs = steps.table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
