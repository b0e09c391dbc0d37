"""The corpus pipeline: documents in, packed training sequences out.

``STAGES`` are (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, all but the last with the columns of ``docs``. ``run``
writes each stage's rows as Parquet under the shared folder and reads them
again as the next one's documents.

1. toxicity: documents that the classifier rejects go.
2. near duplicates: of each group of near copies (shingles of five words,
   similarity 0.8 or more) the document with the smallest id stays.
3. personal data: entities in the texts are replaced by surrogates.
4. mix: sources are taken in proportion to their weights. A document that is
   taken twice stands in two rows, one taken in part has its first words.
5. packing: one row a piece; ``row`` tells the rows of a repeated document apart.

SQL can't express the stages (trained scores, keyed surrogates, a seeded
shuffle and tokenizer ids), so ``ORACLE_SQL`` is None and tests/llm compares
the stages with brute-force versions on small tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retail_spark.llm import minhash, mixing, packing, pii, toxicity
from retail_spark.llm.common import stash, table
from retail_spark.llm.queries import tokenizer_path


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs, words=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.replaced(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxic_documents),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix", mix),
    ("pack", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over all documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
