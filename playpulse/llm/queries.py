"""The operators' queries over the given tables, and the DuckDB statements of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playpulse.llm import mixing, ngram_join, prefix_trie, quality_rules, spelling, topk_search
from playpulse.llm.best_fit import best_fit
from playpulse.llm.html_extract import extract_text
from playpulse.llm.packing import pack_documents
from playpulse.llm.quality_crf import score_documents
from playpulse.llm.secret_scan import scan_secrets
from playpulse.llm.token_counts import count_tokens
from playpulse.llm.url_filter import judge_urls

TOKENIZER = "word_bpe_49k.json"
QUERY_DIVISOR = 50  # queries are the vectors whose id it divides
SLIP_DIVISOR = 199  # a document drops a letter of the words whose hash with its id it divides


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))[0]


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_DIVISOR == 0)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(table(spark, sf_dir, "documents"), slip_divisor=SLIP_DIVISOR)
    return spelling.spelling_variants(words.where(F.col("n") >= spelling.LEAST_COUNT))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), shape=prefix_trie.rebuilt)


SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_counts, op2_url_filters, op3_mixing, op4_quality_classifier, op5_html_extraction,
        op6_packing, op7_quality_rules, op8_ngram_join,
        op9_secret_scans, op10_topk_search, op11_spelling_variants, op12_best_fit_packing,
        op13_conversation_trie)
}
SQL: dict[str, str] = {
    "op3_mixing": mixing.sql(),
    "op7_quality_rules": quality_rules.sql(),
    "op8_ngram_join": ngram_join.sql(),
    "op10_topk_search": topk_search.sql(QUERY_DIVISOR),
    "op11_spelling_variants": spelling.sql(SLIP_DIVISOR),
    "op13_conversation_trie": prefix_trie.sql(),
}
