"""Repeated lines (headers, footers) and page kinds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import patterns as P


def chrome_keys(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """(file_id, key, n) of the normalised lines that occur in at least max(3, floor(0.4 x pages)) lines of their file.

    Lines that begin with a code aren't counted, nor are keys under 4 characters. Counts are combined before the shuffle, so
    a file with most of the lines is no hot key: the group is (file, key).
    """
    counted = lines.filter(~P.trim(F.col("text")).rlike(P.CODE_LINE)).select("file_id", P.normal_line(F.col("text")).alias("key"))
    counts = counted.filter(F.length("key") >= 4).groupBy("file_id", "key").agg(F.count("*").alias("n"))
    often = pages.groupBy("file_id").agg(F.greatest(F.lit(3), F.floor(F.count("*") * F.lit(0.4))).alias("least"))
    return counts.join(often, "file_id").filter("n >= least").select("file_id", "key", "n")


def content_lines(lines: DataFrame, chrome: DataFrame) -> DataFrame:
    """``lines``, with all their columns, without those whose key is in ``chrome``, coded lines included."""
    own = "__docloom_key"
    keyed = lines.withColumn(own, P.normal_line(F.col("text")))
    return keyed.join(chrome.select("file_id", F.col("key").alias(own)), ["file_id", own], "left_anti").select(*(F.col(f"`{c}`") for c in lines.columns))


def page_kind(text: Column) -> Column:
    """The first that holds: toc, recap, preamble, lv_positions, prose_spec, form; else unknown."""
    low = F.lower(text)
    position = text.rlike(P.PAGE_POSITION)
    recap = low.rlike(P.PAGE_RECAP) & ~position & low.rlike(P.PAGE_SUMS)
    return (
        F.when(low.rlike(P.PAGE_TOC), "toc").when(recap, "recap").when(low.rlike(P.PAGE_PREAMBLE), "preamble")
        .when(position | text.rlike(P.PAGE_COLUMNS), "lv_positions").when(text.rlike(P.PAGE_NUMBERED) & low.rlike(P.PAGE_PROSE), "prose_spec")
        .when(low.rlike(P.PAGE_FORM), "form").otherwise("unknown")
    )


def page_kinds(content: DataFrame, pages: DataFrame) -> DataFrame:
    """``pages`` with kind; a page without content lines is unknown."""
    text = content.groupBy("file_id", "page").agg(P.ordered_join([F.col("line_ord")], F.col("text"), "\n").alias("page_text"))
    return pages.join(text, ["file_id", "page"], "left").withColumn("kind", page_kind(F.coalesce("page_text", F.lit("")))).drop("page_text")
