"""Every operator of this subpackage as a query over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curaspan.llm.brown_lm import score_texts
from curaspan.llm.collocations import mine_phrases
from curaspan.llm.common import table
from curaspan.llm.html_extract import extract_text
from curaspan.llm.langid import predict_languages
from curaspan.llm.packing import pack
from curaspan.llm.pii import pii_digest
from curaspan.llm.pieces import sample_digest
from curaspan.llm.quality_pu import score_quality
from curaspan.llm.ranked import rank_documents
from curaspan.llm.rules import apply_rules
from curaspan.llm.simhash import simhash_classes
from curaspan.llm.suffix import repeated_bytes
from curaspan.llm.topk import QUERY_MODULUS, top_inner_products

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, NULLs, empty and long texts, ties and clashing names: see ``score_quality``."""
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, NULLs, empty and long texts, ties and clashing names: see ``pack``."""
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, NULLs, empty and long texts, ties and clashing names: see ``top_inner_products``."""
    vectors = table(spark, sf_dir, "embeddings")
    return top_inner_products(vectors, F.col("vec_id") % QUERY_MODULUS == 0)


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, NULLs, empty and long texts, ties and clashing names: see ``repeated_bytes``."""
    return repeated_bytes(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, NULLs, empty and long texts, ties and clashing names: see ``extract_text``."""
    return extract_text(table(spark, sf_dir, "pages"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, NULLs, empty and long texts, ties and clashing names: see ``pii_digest``."""
    return pii_digest(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted targets are the documents labelled as good."""
    trusted = table(spark, sf_dir, "labels").where(F.col("quality") == 1)
    return apply_rules(table(spark, sf_dir, "documents"), trusted)


def op8_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, NULLs, empty and long texts, ties and clashing names: see ``sample_digest``."""
    return sample_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, NULLs, empty and long texts, ties and clashing names: see ``simhash_classes``."""
    return simhash_classes(table(spark, sf_dir, "documents"))


def op10_brown_class_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, NULLs, empty and long texts, ties and clashing names: see ``score_texts``."""
    return score_texts(table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, NULLs, empty and long texts, ties and clashing names: see ``mine_phrases``."""
    return mine_phrases(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, NULLs, empty and long texts, ties and clashing names: see ``rank_documents``."""
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, NULLs, empty and long texts, ties and clashing names: see ``predict_languages``."""
    return predict_languages(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_best_fit_packing,
        op3_exact_top_k,
        op4_suffix_array_dedup,
        op5_html_extraction,
        op6_personal_data,
        op7_quality_rules,
        op8_sampled_pieces,
        op9_simhash_components,
        op10_brown_class_model,
        op11_phrase_collocations,
        op12_ranked_search,
        op13_language_id,
    )
}
