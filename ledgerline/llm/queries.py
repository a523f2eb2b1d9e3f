"""The operators as named queries over whole tables, and SQL for those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import ann, chat, classifier, licenses, lm, mixing, neardup, negatives, packing, repeats, rules, spelling, warc
from ledgerline.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            prepare(spark)
            return function(spark, folder)

        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = check
        return run

    return add


@query("op5_mixing", mixing.CHECK)
def _mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


@query("op8_license_scan", licenses.CHECK)
def _licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"), licenses.known_digests(spark))


@query("op10_quality_rules")
def _rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judge(table(spark, folder, "documents"))


@query("op4_packing")
def _packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


@query("op3_suffix_repeats", repeats.CHECK)
def _repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.dedup(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op7_near_duplicates", neardup.CHECK)
def _near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"))


@query("op9_warc", warc.CHECK)
def _warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op1_nearest")
def _nearest(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(table(spark, folder, "embeddings"), F.col("id") % 20 == 0, 20)


@query("op6_quality_classifier")
def _classifier(spark: SparkSession, folder: str) -> DataFrame:
    return classifier.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op2_attention_scores")
def _attention_scores(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score(table(spark, folder, "documents"))


@query("op13_chat_format", chat.CHECK)
def _chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat.formatted_digests(table(spark, folder, "conversations"))


@query("op12_hard_negatives", negatives.CHECK)
def _hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.mined(table(spark, folder, "embeddings"))


@query("op11_spelling_variants", spelling.CHECK)
def _spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents"))
