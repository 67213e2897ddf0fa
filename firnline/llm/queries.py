"""Registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.llm import (
    bpe, decontaminate, divergence, html_extract, importance, jaccard, licenses, line_dedup, oracles, pii, quality, secrets, suffix_dedup,
    url_filters,
)
from firnline.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = oracles.ORACLE


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_report(table(spark, folder, "documents"))


@query
def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_texts(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), digest=True)


@query
def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, folder, "documents"))


@query
def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(table(spark, folder, "documents"))


@query
def op2_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract_text(table(spark, folder, "pages"))


@query
def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    captures = pages.select("page_id", "url", url_filters.fetched_on(F.col("page_id")).alias("fetched"))
    return url_filters.url_verdicts(captures, url_filters.entries_from_pages(pages))


@query
def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.dedup_report(table(spark, folder, "documents"))


@query
def op9_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pseudonymised(table(spark, folder, "documents"), "registered query")


@query
def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, folder, "documents"))


@query
def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resampling_report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op12_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_report(table(spark, folder, "documents"))


@query
def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence(table(spark, folder, "documents"))
