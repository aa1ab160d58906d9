"""Corpus pipeline: language ID, near-dedup, decontamination, mixing, sharding over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before
kept; all but the last return the columns of ``documents``.

Defined cases: rows without text have no language and go in the first stage. Of
rows with one doc_id that get past it, near-dedup keeps one; rows without doc_id
all stay there. Columns beyond those of ``documents`` are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import contamination, language_id, mixing, near_dup, sharding
from orderlake.llm.common import land, read_table, sized

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is one of the known ones."""
    return language_id.document_languages(docs.select(*COLUMNS), COLUMNS).filter("accepted").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id."""
    docs = docs.select(*COLUMNS)
    found = land(near_dup.near_duplicates(docs).select("doc_id", "kept"), "near_duplicates")
    going = land(found.filter("not kept").select("doc_id").distinct(), "going")
    again = land(found.filter("kept and doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "again")
    stay = docs.join(sized(going, near_dup.BROADCAST_ROWS), "doc_id", "left_anti")
    if not again.isEmpty():
        again = sized(again, near_dup.BROADCAST_ROWS)
        one = stay.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*COLUMNS), F.xxhash64(*COLUMNS)).alias("row"))
        stay = stay.join(again, "doc_id", "left_anti").select(*COLUMNS).unionByName(one.select("row.*"))
    return stay.select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return contamination.decontaminate(docs.select(*COLUMNS), read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, in global random order."""
    return mixing.mix(docs.select(*COLUMNS)).select(*COLUMNS)


def place_on_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their slot and shard."""
    return sharding.place(docs.select(*COLUMNS))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", place_on_shards),
]
#: SQL can express neither the language model nor the register estimates; tests/llm compares with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again as the next one's input."""
    docs = read_table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = land(docs, name)
    return docs
