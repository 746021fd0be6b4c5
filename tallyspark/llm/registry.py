"""Queries of this subpackage, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm import chat, decontaminate, extraction, langid, mixing, negatives, oracles, pitman_yor, quality, ranking, secrets, simhash, suffix, url_lists
from tallyspark.llm.common import read


def op1_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.link_calls(*chat.turns_as_calls(read(spark, sf_dir, "conversations")))


def op2_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_documents(read(spark, sf_dir, "documents"))


def op3_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(read(spark, sf_dir, "documents"))


def op4_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures, entries = url_lists.pages_as_captures(read(spark, sf_dir, "pages"))
    return url_lists.evaluate(captures, entries).select("page_id", "host", "fetched", "lists", "blocked")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeat_digest(suffix.remove_repeats(read(spark, sf_dir, "documents")))


def op7_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = secrets.changed_history(read(spark, sf_dir, "documents"))
    return secrets.secret_digest(found)


def op8_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.host_quality(read(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.main_texts(read(spark, sf_dir, "pages"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(read(spark, sf_dir, "embeddings"), label=negatives.noisy_label())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_tool_calls, op2_pitman_yor, op3_mixture, op4_url_lists, op5_language_id, op6_suffix_dedup, op7_secret_ledger, op8_host_quality, op9_decontaminate, op10_simhash,
        op11_main_text, op12_ranked_search, op13_hard_negatives,
    )
}

SQL: dict[str, str] = {
    "op1_tool_calls": oracles.TOOL_CALLS,
    "op4_url_lists": oracles.URL_LISTS, "op6_suffix_dedup": oracles.SUFFIX_DEDUP, "op7_secret_ledger": oracles.SECRET_LEDGER, "op8_host_quality": oracles.HOST_QUALITY,
    "op9_decontaminate": oracles.DECONTAMINATE, "op11_main_text": oracles.MAIN_TEXT, "op12_ranked_search": oracles.RANKED_SEARCH, "op13_hard_negatives": oracles.HARD_NEGATIVES,
}
