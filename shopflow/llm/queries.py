"""The registered query of each operator, over whole tables with production parameters, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_repair, html_extract, langid, repeats, secret_scan
from .common import table, tune
from .decontaminate import leaks
from .mixing import MIX_SQL, with_copies
from .ngram_join import NEAR_SQL, near_duplicates
from .packing import packed
from .pii import BASE_KINDS, digest, with_spans
from .quality_rules import judged
from .ranked_search import RANKED_SQL, ranked
from .toxicity import DECISION, held_out, scored


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").withColumn("text", html_extract.main_text(F.col("html"), html_extract.trained())) \
        .select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_scan.with_spans(table(spark, sf_dir, "documents"))
    count = [F.expr(f"size(filter(__secrets, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in secret_scan.BASE_KINDS]
    return rows.select("doc_id", *count, F.sha2(digest("__secrets", secret_scan.BASE_KINDS), 256).alias("base_sha256"), digest("__secrets").alias("spans"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "__quality.*")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", held_out().alias("held_out"), F.col("__toxicity").alias("score"), (F.col("__toxicity") >= DECISION).cast("int").alias("predicted"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_spans(table(spark, sf_dir, "documents"))
    count = [F.expr(f"size(filter(__pii, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return rows.select("doc_id", *count, F.sha2(digest("__pii", BASE_KINDS), 256).alias("base_sha256"), digest("__pii").alias("spans"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_copies(table(spark, sf_dir, "documents")).select("doc_id", "__mix.size", "__mix.source_size", "__mix.target", "__mix.taken")


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(table(spark, sf_dir, "documents"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(table(spark, sf_dir, "documents")).select(
        "doc_id", langid.held_out().alias("held_out"), F.col("__language.lang").alias("lang_pred"), "__language.score")


def op11_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_best_position_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repairs(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


def _tuned(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        return fn(spark, sf_dir)
    return run


QUERIES = {name: _tuned(fn) for name, fn in list(globals().items()) if name.startswith("op")}

ORACLE_SQL = {"op7_source_mix": MIX_SQL, "op9_ngram_jaccard_join": NEAR_SQL, "op12_best_position_search": RANKED_SQL,
              "op13_conversation_repair": conversation_repair.REPAIR_SQL}
