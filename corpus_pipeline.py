"""Training-data pipeline over ``documents``: STAGES in order, each on all its predecessor kept.

1. toxicity: documents scored 0.5 or more go (labels from ``labels``);
2. quality rules: documents that fail their own or their host's verdict go;
3. SimHash near-dedup: one document of each group stays;
4. mixing: languages in target weights, every document once at least and those of the smaller
   languages as often as the mixture holds them;
5. BPE: token counts and digests of every row of the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casebook.llm import mixing, quality_rules, simhash, toxicity
from casebook.llm.common import table
from casebook.llm.queries import tokenised


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.kept_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs, source="lang", budget=mixing.WHOLE)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokenised(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("quality rules", apply_quality_rules),
    ("SimHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode_texts),
]

#: Learned scores, fingerprints and token ids are beyond SQL; tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
