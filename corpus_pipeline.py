"""A corpus from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's documents. Decisions are final: a
stage sees only what its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from livetables.llm import bpe, exact_dedup, mixing, near_dup, toxicity
from livetables.llm.common import read, written
from livetables.llm.queries import SOURCE_WEIGHTS, TOXIC_AT


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where(F.col("score") < TOXIC_AT).select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.keep_rows(docs, keep="max")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates; documents without an id stay."""
    going = near_dup.classes_of(docs).where(~F.col("kept")).select("doc_id")
    return docs.join(going, "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources, one row for each time that a document is taken."""
    return mixing.mix(docs, SOURCE_WEIGHTS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document taken, and the digests of ids and decoded bytes."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", tokenize),
]

#: Hashed samples, neighbours and merges are not SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
