"""The training-data pipeline: quality rules, exact dedup, near-dedup, mixing, token encoding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame.
``run`` writes each stage's result as Parquet in the shared folder and reads it back as the next
stage's documents, so a lost executor never reaches back beyond one stage. When a result is written,
the working folders of its stage go, and the result before it. All stages but the last return the
columns of documents.

Edge cases, for every stage: a null text counts as empty; a null source is a host and a source of its
own; a null doc_id comes after all others where ids decide; repeated rows are rows of their own until
the exact dedup leaves one; texts are whole however long they are; other columns are carried along,
whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrace.llm import dart_minhash, exact_dedup, mixing, piece_codec, quality_rules
from terrace.llm.common import settle, working_folders
from terrace.llm.queries import tokenizer
from terrace.sources.tables import remove_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules go; a null or empty text has too few words."""
    return quality_rules.keep_documents(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without their white space one stays: the longest, then the smallest
    doc_id. All null, empty and blank texts are equal."""
    return exact_dedup.keep_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the smallest doc_id stays. A text without words is like no
    other."""
    return dart_minhash.keep_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are repeated up to their weights in the mixture: a document occurs once per pass over its
    source, at most twice, and at least once, as does one without words. A null source is a source."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and source spans of every document of the mixture; a null text has no ids."""
    return piece_codec.encode_documents(docs, tokenizer("piece_bpe_32k.model"), keep_ids=True)


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("mixing", mix),
    ("sentencepiece", encode),
]

#: MinHash classes and the library's token ids are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        with working_folders() as made:
            docs = settle(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
        for folder in made[:-1] + last:
            remove_path(spark, folder)
        last = made[-1:]
    return docs
