"""A training corpus from raw documents: language, near-duplicates, benchmark
leaks, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import fresh_dir
from strata.llm import decontaminate, langid, mixture, neardup, sharding
from strata.llm.common import read_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model does not place (see langid.MIN_SCORE), or without a letter, go."""
    return langid.identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts linked by five-word shingles at 0.8, the smallest doc_id stays."""
    return neardup.drop_near_duplicate_texts(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs go."""
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or repeated."""
    mixed = mixture.mix(docs, keep_rows=True).where("copies > 0")
    return mixed.select("row", F.explode(F.expr("sequence(1L, copies)"))).select("row.*")


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every document; copies of one document share a shard."""
    return sharding.shard_records(docs, [1.0] * sharding.N_SHARDS)


STAGES = [
    ("language", identify_language),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

#: Learned models and sketches have no SQL form; tests/llm checks every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_dir(spark, f"corpus-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
