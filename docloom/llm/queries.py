"""The registered queries of the training-data operators: opN_<name> and pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_file())


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score_documents, train

    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, train(docs, table(spark, sf_dir, "labels")))


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .pieces import decode_documents, encode_documents

    model = tokenizer_file("piece_bpe_32k.model")
    decoded = decode_documents(encode_documents(table(spark, sf_dir, "documents"), model), model)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "score", F.sha2("text", 256).alias("decoded_sha256"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import digest_columns, labelled_samples, ratio_table, scan

    docs = table(spark, sf_dir, "documents")
    return digest_columns(scan(docs, ratio_table(labelled_samples(spark, docs))))


def op5_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repetition import rules

    return rules(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substrings import removal_digest

    return removal_digest(table(spark, sf_dir, "documents"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_text import extract

    return extract(table(spark, sf_dir, "pages"))


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import materialize
    from .media import png_features, text_to_png

    stored = materialize(text_to_png(table(spark, sf_dir, "documents")), "media")
    return png_features(stored)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import materialize
    from .warc import archive_pages, read_archives

    archives = materialize(archive_pages(table(spark, sf_dir, "pages")), "warc")
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_packing, op2_quality, op3_pieces, op4_secrets, op5_repetition, op6_simhash, op7_repeats, op8_html, op9_media, op10_warc, pipeline)
    return {f.__name__: f for f in found}


#: Base 32 is spelled from the digest's bits, five for a letter.
WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
s AS (SELECT page_id, octet_length(encode(h)) AS n, unhex(sha1(h))::BIT::VARCHAR AS b, min(page_id) OVER (PARTITION BY h) AS f FROM p)
SELECT page_id, n AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(5), lambda k: substr(b, i * 5 + k + 1, 1)::int * (16 >> k)))::int, 1)), '') AS payload_digest,
  CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> f THEN f END AS refers_to
FROM s
"""


def oracle_sql() -> dict[str, str]:
    """SQL where it can express the whole result; tests hold the other queries against brute force."""
    return {"op10_warc": WARC_SQL}
