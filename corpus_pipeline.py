"""From documents to packed training sequences.

Five stages, each over all that its predecessor kept: language ID (rejected
documents go), exact dedup, SimHash near-dedup (one document of a group
stays), mixing sources to target weights (documents repeat or go), packing.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from segscore.llm.common import cut_lineage
from segscore.llm.exact import exact_dedup
from segscore.llm.langid import language_id
from segscore.llm.mixing import mix_sources, repeated
from segscore.llm.packing import pack
from segscore.llm.simhash import drop_near_copies
from segscore.sources.tables import read_table


def tokenizer_path() -> str:
    """Where the public vocabulary lies; a parameter of the packing operator."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id(docs).filter("not rejected").select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup(docs).filter("kept").select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs, shingle=4, radius=4)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeated(mix_sources(docs), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, tokenizer_path())


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("simhash_dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

#: The trained and the hashed stages have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut_lineage(docs)
    return docs
