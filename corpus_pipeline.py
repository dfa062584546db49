"""A training-data pipeline over ``documents``: five stages, each an operator of ``mise.llm``.

Each stage gets what the one before it kept, written as Parquet and read again, and returns the
columns of documents; the last returns packed pieces.

1. quality: documents that the rules reject go.
2. near duplicates: one document of each class of near copies stays.
3. decontamination: documents that hold a benchmark item go.
4. secrets: secrets in the texts are masked, n_chars follows.
5. packing: documents are cut and packed into sequences of tokens.

Defined results are those of the operators: a null or empty text has no words and goes in the first stage, as do
very short ones; of repeated rows one stays; long texts are worked on whole; an empty table gives an empty result;
columns besides those of documents are carried through the stages before the last, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mise.llm import dart_minhash, decontaminate, packing, quality, secret_scan
from mise.llm.common import own_folder, table
from mise.llm.queries import SEQUENCE_TOKENS, vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dart_minhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact_secrets(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary(), SEQUENCE_TOKENS)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_masking", mask_secrets),
    ("packing", pack_documents),
]

#: SQL can't express the classes of near copies, the edit distances or the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what each keeps is a table in the shared
    checkpoint folder, so that the next one doesn't do its work again."""
    folder = own_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
