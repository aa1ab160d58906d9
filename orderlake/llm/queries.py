"""The registered queries of this package: name -> (spark, sf_dir) -> DataFrame, and their DuckDB twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import contamination, exact_search, language_id, licenses, main_text, mixing, prefix_trie, sharding, token_counts, token_files, vector_codes
from orderlake.llm.common import read_table, scratch_dir
from orderlake.llm.near_dup import near_duplicates
from orderlake.llm.vector_dup import vector_duplicates


def op1_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return token_counts.section_tokens(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.document_languages(read_table(spark, sf_dir, "documents"), ["doc_id", "source"])


def op3_language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = read_table(spark, sf_dir, "documents").select("doc_id", "text", F.col("lang").alias("label"))
    return language_id.page_languages(read_table(spark, sf_dir, "pages"), labelled, ["page_id", "url"])


def op4_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op5_lookup_table_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(read_table(spark, sf_dir, "documents"))


def op6_repair_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark)}/token_files"
    token_files.write_token_files(read_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_token_digests(spark, path)


def op7_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op8_small_world_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_duplicates(read_table(spark, sf_dir, "embeddings"))


def op9_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_texts(read_table(spark, sf_dir, "pages"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = contamination.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return report.drop("spans")


def op11_segment_statistics_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_search.top_neighbours(read_table(spark, sf_dir, "embeddings"))


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(read_table(spark, sf_dir, "conversations"))


def op13_grid_cell_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_attribution,
        op2_setsketch_near_dedup,
        op3_language_id,
        op3_language_id_pages,
        op4_poisson_mixing,
        op5_lookup_table_sharding,
        op6_repair_token_files,
        op7_license_diagonals,
        op8_small_world_near_dedup,
        op9_html_main_text,
        op10_decontamination,
        op11_segment_statistics_search,
        op12_conversation_prefix_trie,
        op13_grid_cell_vector_codes,
    )
}

ORACLES: dict[str, str] = {
    "op4_poisson_mixing": mixing.ORACLE,
    "op5_lookup_table_sharding": sharding.ORACLE,
    "op7_license_diagonals": licenses.ORACLE,
    "op10_decontamination": contamination.ORACLE,
    "op11_segment_statistics_search": exact_search.ORACLE,
    "op12_conversation_prefix_trie": prefix_trie.ORACLE,
    "op13_grid_cell_vector_codes": vector_codes.ORACLE,
}
