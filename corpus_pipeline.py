"""The training-data pipeline over ``documents``: quality, near duplicates, repeated strings, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read again as the next one's docs.
All but the last keep the columns of ``documents``; stages that change texts set n_chars anew. An empty table stays empty
in every stage, repeated ids and null ids are rows of their own, and columns that are not named here are handed on
as they are, whatever their names are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import packing, quality, secrets, simhash, substrings
from docloom.llm.common import shared_dir
from docloom.llm.queries import table, tokenizer_file


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier rejects go.

    Null and empty texts are scored as one empty line, repeated rows alike. Without labels of both classes all stay.
    """
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group joined by a similarity of at least 0.8 of five-word shingles the document with the smallest doc_id stays.

    Null and wordless texts are one group, repeated rows another; null ids come after all others. Of rows that tie, one stays.
    """
    return simhash.keep_one(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings that occur more than once are cut out; all documents stay, some of them shorter.

    A null text stays null and an empty one empty; repeated rows lose what they repeat. n_chars of a null text is null.
    """
    return substrings.remove_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; all documents stay.

    A null text stays null and an empty one empty, repeated rows are alike. n_chars of a null text is null.
    """
    ratios = secrets.ratio_table(secrets.labelled_samples(spark, docs))
    return secrets.redact(docs, ratios).withColumn("n_chars", F.length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: a row for each piece of a document; no other column is handed on.

    Null and empty texts give one piece of the closing id alone; repeated rows are pieces of their own.
    """
    return packing.pack(docs, tokenizer_file())


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("secret scans", secret_scan),
    ("packing", pack_sequences),
]

#: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/docloom-stage-{name.replace(' ', '-')}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
