"""Corpus pipeline over ``documents``: each stage is written as Parquet, and the next one reads that.

language_id keeps what the byte model places in one of the training languages: texts that are null, have
no letter or have most of their letters in a script that the language's training text is without go, at every size. exact_dedup and near_dedup keep one
document of each group; texts whose five-word shingles have a Jaccard similarity of 0.80 or more are near copies.
mix_sources reads every document at least once and repeats those of small sources, ``MOST_REPEATS`` times at most, so that sources come nearer to equal token shares; its rows are in the order of the block permutations. pack
cuts and packs what is left into sequences; it returns pieces, not documents.

Stages take empty tables, null and repeated rows as their operators do.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from linkloom.llm import exact_dedup, language_model, mixing, near_dedup, packing
from linkloom.session import stored

MOST_REPEATS = 2.0
# Near copies in percent of similarity; these bands miss a pair just at it with a chance of 6e-7.
NEAR = {"part": 80, "bands": 36, "rows": 5}


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    training = docs.where(~language_model.held_out(docs["doc_id"]))
    return language_model.in_known_language(docs, training, language_model.train(training))


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs, **NEAR)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs, max_repeats=MOST_REPEATS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


# (name, function of (spark, docs, sf_dir)); all but the last return the columns of ``documents``.
STAGES = [
    ("language_id", language_id),
    ("exact_dedup", remove_copies),
    ("near_dedup", remove_near_copies),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

# SQL cannot express a trained language model; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
