"""The operators over their whole tables, by query name, with the SQL they must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from logweir.llm import oracles
from logweir.llm.decontaminate import leaks
from logweir.llm.dual_tree import ranked
from logweir.llm.html_text import page_texts
from logweir.llm.languages import language
from logweir.llm.licenses import licences
from logweir.llm.line_dedup import dedup_lines
from logweir.llm.mixing import mix
from logweir.llm.near_dedup import near_duplicates
from logweir.llm.repeats import remove_repeats
from logweir.llm.search import top_k
from logweir.llm.tables import table
from logweir.llm.toxicity import toxicity
from logweir.llm.urls import RULES, url_verdicts
from logweir.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op1_mix": oracles.MIX,
    "op2_line_dedup": oracles.LINE_DEDUP,
    "op4_minhash": oracles.MINHASH,
    "op5_top_k": oracles.TOP_K,
    "op9_suffix_dedup": oracles.SUFFIX_DEDUP,
    "op13_dual_tree": oracles.RANKED,
}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).taken()


@query
def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op3_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return page_texts(table(spark, folder, "pages"))


@query
def op4_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


@query
def op5_top_k(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return top_k(docs, docs.where("doc_id % 50 = 0"))


@query
def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_verdicts(table(spark, folder, "pages"), RULES)


@query
def op8_string_kernel(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"))


@query
def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents have no paths; their source, language and id stand for one."""
    path = F.concat_ws("/", F.coalesce("source", F.lit("_")), F.coalesce("lang", F.lit("_")), F.col("doc_id").cast("string"))
    return licences(table(spark, folder, "documents").select("doc_id", path.alias("path"), "text"))


@query
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))


@query
def op12_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language(table(spark, folder, "documents"))


@query
def op13_dual_tree(spark: SparkSession, folder: str) -> DataFrame:
    return ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
