"""From raw documents to packed training sequences: the stages, and one run over ``documents``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewloom.llm import minhash_dedup, mixing, packing, quality_rules
from reviewloom.session import materialize

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines that many documents of their source share."""
    return quality_rules.clean(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return minhash_dedup.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight takes it."""
    return mixing.mixed(docs, mixing.n_words())


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in which training sequence."""
    cut = packing.pieces(docs, TOKENIZER).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(materialize(cut, "pieces"))


STAGES = [
    ("quality_rules", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Tokens and links of links are beyond SQL; the tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after another, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
