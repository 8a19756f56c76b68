"""The registered queries of this subpackage, one per operator, and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verity.llm.ann import nearest
from verity.llm.bpe import round_trip_digests
from verity.llm.common import table
from verity.llm.exact_dedup import ORACLE as EXACT_DEDUP_ORACLE
from verity.llm.exact_dedup import exact_dedup
from verity.llm.html_text import extract_text
from verity.llm.line_dedup import ORACLE as LINE_DEDUP_ORACLE
from verity.llm.line_dedup import line_dedup
from verity.llm.lsh_forest import forest_components
from verity.llm.ngram_join import ngram_components
from verity.llm.packing import pack_documents
from verity.llm.prefix_trie import ORACLE as TRIE_ORACLE
from verity.llm.prefix_trie import conversation_trie
from verity.llm.quality import score_quality
from verity.llm.spelling import spelling_groups
from verity.llm.url_filter import judge_urls
from verity.llm.warc import ORACLE as WARC_ORACLE
from verity.llm.warc import round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))


@query
def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


ORACLES["op6_warc"] = WARC_ORACLE


@query
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return round_trip_digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup(docs).select("doc_id", "n_lines", "n_removed", "text")


ORACLES["op8_line_dedup"] = LINE_DEDUP_ORACLE


@query
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLES["op9_exact_dedup"] = EXACT_DEDUP_ORACLE


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


ORACLES["op12_prefix_trie"] = TRIE_ORACLE


@query
def op13_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest_components(table(spark, sf_dir, "documents"))
