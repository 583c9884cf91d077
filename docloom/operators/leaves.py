"""Candidate leaves from chunks, and the preamble's obligations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import patterns as P

from .providers import Provider, StubProvider, split_budget

LEAF = ["bullet_point", "description_source", "language", "priority", "equivalence_allowed", "confidence", "chunk_ids", "level1_key", "level1_label", "level2_key", "level2_label"]
CONDITIONS = "General Conditions"
#: Characters of a preamble that is worth looking at.
LEAST_TEXT = 50


def level_keys(chunks: DataFrame, titles: DataFrame, groups: DataFrame) -> DataFrame:
    """``chunks`` with level1_key, level1_label, level2_key and level2_label from the code, or from the section without one."""
    section = F.coalesce("section", F.lit("Specification"))
    room = F.regexp_extract("oz_code", r"^([^.]*)", 1).rlike("[A-Za-zÄÖÜäöü]")
    two, three = F.substring_index("oz_code", ".", 2), F.substring_index("oz_code", ".", 3)
    coded = F.col("oz_code").isNotNull()
    rows = chunks.withColumn("k1", F.substring("oz_code", 1, 2)).withColumn("k2", two).withColumn("k3", F.when(room, three).otherwise(two))
    rows = rows.join(titles.select("file_id", F.col("key").alias("k1"), F.col("label").alias("title_label")), ["file_id", "k1"], "left")
    for k in ("k2", "k3"):
        rows = rows.join(groups.select("file_id", F.col("key").alias(k), F.col("label").alias(f"{k}_label")), ["file_id", k], "left")
    return rows.withColumns(
        {
            "level1_key": F.when(coded, F.col("k1")).otherwise(section),
            "level1_label": F.when(coded, F.coalesce("title_label", F.concat(F.lit("Section "), "k1"))).otherwise(section),
            "level2_key": F.when(coded, F.col("k3")).otherwise(F.concat(section, F.lit(":req"))),
            "level2_label": F.when(coded, F.coalesce("k3_label", "k2_label", F.concat(F.lit("Group "), "k3"))).otherwise("Requirements"),
        }
    ).drop("k1", "k2", "k3", "title_label", "k2_label", "k3_label")


def build_leaves(
    chunks: DataFrame, titles: DataFrame, groups: DataFrame, languages: DataFrame, provider: Provider | None = None, budget: int | None = None, order: tuple[str, ...] = ("file_id", "seg"), legends: DataFrame | None = None
) -> DataFrame:
    """A leaf for each position and paragraph, with the columns of LEAF, file_id and seg.

    Providers other than the default see each file's ``legends`` (file_id, legend). The first ``budget`` chunks in ``order`` go to ``provider``, the others to the default provider.
    """
    stub = StubProvider()
    rows = level_keys(chunks.filter(F.col("kind").isin("position", "paragraph")), titles, groups).join(languages, "file_id", "left")
    if provider is None or isinstance(provider, StubProvider):
        said = stub.enrich(rows)
    elif budget is None:
        said = provider.enrich(told(rows, legends))
    else:
        dealt = split_budget(rows, budget, list(order))
        said = provider.enrich(told(dealt.filter("use_llm").drop("use_llm"), legends)).drop("legend").unionByName(stub.enrich(dealt.filter("NOT use_llm").drop("use_llm")))
    bullet = F.when(F.coalesce(F.col("quantity"), F.lit("")) != "", F.concat("bullet_point", F.lit(" ("), "quantity", F.lit(")"))).otherwise(F.col("bullet_point"))
    said = said.withColumn("bullet_point", bullet).withColumnRenamed("description", "description_source").withColumn("chunk_ids", F.array("id"))
    return said.select("file_id", "seg", *LEAF)


def told(rows: DataFrame, legends: DataFrame | None) -> DataFrame:
    return rows.withColumn("legend", F.lit(None).cast("string")) if legends is None else rows.join(legends.select("file_id", "legend"), "file_id", "left")


def preamble_lines(content: DataFrame, pages: DataFrame, has_positions: DataFrame, languages: DataFrame) -> DataFrame:
    """(file_id, line_ord, text, language): the lines of ``preamble_texts``, one for each row, so that no file's text meets in one value."""
    chosen = pages.join(has_positions, "file_id", "left").filter((F.col("kind") == "preamble") | (~F.coalesce("has_positions", F.lit(False)) & F.col("kind").isin("unknown", "form")))
    rows = content.join(chosen.select("file_id", "page"), ["file_id", "page"], "left_semi").select("file_id", "line_ord", "text")
    full = F.when(P.trim(F.col("text")) != "", F.col("line_ord"))
    ends = rows.groupBy("file_id").agg(F.min(full).alias("a"), F.max(full).alias("b"))
    # What the joined text has without white space at its ends: from the first line that isn't blank to the last one.
    blank = lambda end, cut: F.when(F.col("line_ord") == F.col(end), F.length("text") - F.length(cut(F.col("text"), F.lit(P.WS_CHARS)))).otherwise(0)
    within = rows.join(ends, "file_id").filter(F.col("line_ord").between(F.col("a"), F.col("b")))
    long = within.groupBy("file_id").agg((F.sum(F.length("text") - blank("a", F.ltrim) - blank("b", F.rtrim) + 1) - 1).alias("n")).filter(F.col("n") >= LEAST_TEXT)
    return rows.join(long.select("file_id"), "file_id", "left_semi").join(languages, "file_id", "left")


def preamble_texts(content: DataFrame, pages: DataFrame, has_positions: DataFrame, languages: DataFrame) -> DataFrame:
    """(file_id, text, language) of files with 50 characters or more on preamble pages, and without positions also on unknown and form pages."""
    chosen = pages.join(has_positions, "file_id", "left").filter((F.col("kind") == "preamble") | (~F.coalesce("has_positions", F.lit(False)) & F.col("kind").isin("unknown", "form")))
    rows = content.join(chosen.select("file_id", "page"), ["file_id", "page"], "left_semi")
    text = rows.groupBy("file_id").agg(P.ordered_join([F.col("line_ord")], F.col("text"), "\n").alias("text"))
    return text.filter(F.length(P.trim(F.col("text"))) >= LEAST_TEXT).join(languages, "file_id", "left")


def preamble(texts: DataFrame, provider: Provider | None = None) -> tuple[DataFrame, DataFrame]:
    """(chunks, leaves) of the obligations in ``texts``, which has a row for each file, or for each line for the default provider."""
    found = (provider or StubProvider()).obligations(texts).join(texts.select("file_id", "language").distinct(), "file_id")
    chunk_id = F.concat("file_id", F.lit(":preamble:"), F.col("i").cast("string"))
    none = F.lit(None).cast("string")
    seg = F.col("i").cast("long")
    chunks = found.select(chunk_id.alias("id"), "file_id", F.lit(0).alias("page"), F.lit("preamble").alias("kind"), none.alias("oz_code"), F.col("bullet_point").alias("title"), F.col("description").alias("text"), none.alias("quantity"), F.lit(None).cast("boolean").alias("equivalence"), F.lit(CONDITIONS).alias("section"), seg.alias("seg"))
    leaves = found.select(
        "file_id", seg.alias("seg"), "bullet_point", F.col("description").alias("description_source"), "language", "priority", F.lit(None).cast("boolean").alias("equivalence_allowed"), F.lit("medium").alias("confidence"), F.array(chunk_id).alias("chunk_ids"),
        F.lit(CONDITIONS).alias("level1_key"), F.lit(CONDITIONS).alias("level1_label"), F.lit(f"{CONDITIONS}:obl").alias("level2_key"), F.lit("Obligations").alias("level2_label"),
    )
    return chunks, leaves


def modality_legend(content: DataFrame) -> DataFrame:
    """(file_id, legend): the first mention of modality, to 200 characters on; null without one.

    A mention never goes beyond its line, so the first matching line is taken and the file's text isn't joined.
    """
    found = F.regexp_extract("text", P.MODALITY_LEGEND, 0)
    return content.groupBy("file_id").agg(F.min(F.when(found != "", F.struct("line_ord", found.alias("legend"))))["legend"].alias("legend"))
