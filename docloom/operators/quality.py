"""Text quality of pages, OCR replacement and language."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.patterns import ARTIFACT, BROKEN_LIGATURE, ENGLISH, GERMAN, ordered_join, spaced, trim


def text_quality(text: Column) -> Column:
    """clean, corrupted (over two artifacts, or over 6 % of the words broken) or image_only (under 15 characters)."""
    t = trim(text)
    artifacts = F.regexp_count(t, F.lit(ARTIFACT))
    broken = F.regexp_count(t, F.lit(BROKEN_LIGATURE))
    words = F.size(F.split(spaced(t), " "))
    bad = (artifacts > 2) | ((broken + artifacts) / F.greatest(words, F.lit(1)) > 0.06)
    return F.when(F.length(t) < 15, "image_only").when(bad, "corrupted").otherwise("clean")


def read_method(quality: Column) -> Column:
    return F.when(quality == "image_only", "image_only").otherwise("text")


def page_info(lines: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """(file_id, page, text_quality, char_count, method) of ``pages`` (file_id, page); without them of the pages that have lines.

    A page without lines has an empty text, so it is image_only.
    """
    text = ordered_join([F.col("line_ord")], F.col("text"), "\n")
    found = lines.groupBy("file_id", "page").agg(text.alias("text"))
    if pages is not None:
        found = pages.select("file_id", "page").distinct().join(found, ["file_id", "page"], "left")
    found = found.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("text_quality", text_quality(F.col("text")))
    return found.select("file_id", "page", "text_quality", F.length("text").alias("char_count"), read_method(F.col("text_quality")).alias("method"))


def page_counts(pages: DataFrame) -> DataFrame:
    """(file_id, n_pages, n_corrupted, n_image_only, n_ocr) of every file of ``page_info``'s rows."""
    counts = {"n_pages": F.lit(True), "n_corrupted": F.col("text_quality") == "corrupted", "n_image_only": F.col("text_quality") == "image_only", "n_ocr": F.col("method") == "ocr"}
    return pages.groupBy("file_id").agg(*(F.count_if(c).alias(n) for n, c in counts.items()))


def language(text: Column) -> Column:
    """de or en by marker counts; a tie is de."""
    low = F.lower(text)
    return F.when(F.regexp_count(low, F.lit(ENGLISH)) > F.regexp_count(low, F.lit(GERMAN)), "en").otherwise("de")


def file_language(lines: DataFrame) -> DataFrame:
    """(file_id, language). The markers never reach over a line's end, so counts are summed by line and no text is joined."""
    count = lambda p: F.sum(F.regexp_count(F.lower("text"), F.lit(p)))
    return lines.groupBy("file_id").agg(F.when(count(ENGLISH) > count(GERMAN), "en").otherwise("de").alias("language"))


def ocr_replace(lines: DataFrame, pages: DataFrame, ocr: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(lines, pages) with OCR text in place of corrupted pages' lines.

    ``ocr`` gets (file_id, page) of the corrupted pages and gives (file_id, page, text), text null where it failed; without
    it nothing changes. Lines are the trimmed non-blank lines of the text, with y = 10000 - i and x = 0.
    """
    if ocr is None:
        return lines, pages
    read = ocr(pages.filter("text_quality = 'corrupted'").select("file_id", "page"))
    parts = F.filter(F.transform(F.split("text", r"\r?\n"), trim), lambda t: t != "")
    read = read.filter(F.col("text").isNotNull()).withColumn("parts", parts).filter(F.size("parts") > 0)
    last = lines.groupBy("file_id").agg(F.max("line_ord").alias("last"))
    new = read.join(last, "file_id", "left").select("file_id", "page", F.coalesce("last", F.lit(0)).alias("last"), F.posexplode("parts").alias("i", "text"))
    new = new.select("file_id", "page", (F.lit(10000.0) - F.col("i")).alias("y"), F.lit(0.0).alias("x"), "text", (F.col("last") + F.col("page").cast("long") * (1 << 20) + F.col("i") + 1).alias("line_ord"))
    kept = lines.join(read.select("file_id", "page"), ["file_id", "page"], "left_anti")
    found = read.select("file_id", "page", text_quality(F.col("text")).alias("q"), F.length("text").alias("n"))
    info = pages.join(found, ["file_id", "page"], "left").select(
        "file_id", "page", F.coalesce("q", "text_quality").alias("text_quality"), F.coalesce("n", "char_count").alias("char_count"), F.when(F.col("q").isNotNull(), "ocr").otherwise(F.col("method")).alias("method")
    )
    return kept.unionByName(new.select(*kept.columns)), info
