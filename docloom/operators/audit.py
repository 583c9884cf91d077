"""Schema, coverage and grounding of a tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.patterns import tokens

from .references import source_texts

CONTENT_KINDS = ("position", "paragraph", "checklist", "preamble")


def leaf_valid() -> Column:
    """The output schema's conditions on a leaf row."""
    return (
        (F.coalesce("bullet_point", F.lit("")) != "") & F.coalesce("priority", F.lit("")).isin("must", "should", "optional")
        & (F.col("confidence").isNull() | F.col("confidence").isin("high", "medium", "low")) & F.col("chunk_ids").isNotNull() & F.col("description_source").isNotNull()
        & (F.coalesce("level1_label", F.lit("")) != "") & (F.coalesce("level2_label", F.lit("")) != "")
    )


def schema_audit(leaves: DataFrame) -> DataFrame:
    return leaves.agg(F.count("*").alias("n_leaves"), F.sum((~leaf_valid()).cast("long")).alias("n_invalid"), F.coalesce(F.bool_and(leaf_valid()), F.lit(True)).alias("schema_valid"))


def grounding(description: Column, source: Column) -> Column:
    """Share of the description's words of 4 letters or more that the source has; 1 without such words."""
    said = tokens(description, 4)
    return F.when(F.size(said) == 0, 1.0).otherwise(F.size(F.array_intersect(said, tokens(source, 4))) / F.size(said))


def leaf_grounding(leaves: DataFrame, chunks: DataFrame) -> DataFrame:
    """(leaf_ord, grounding)."""
    texts = source_texts(leaves, chunks, " ")
    joined = leaves.select("leaf_ord", "description_source").join(texts, "leaf_ord", "left")
    return joined.select("leaf_ord", grounding(F.col("description_source"), F.coalesce("text", F.lit(""))).alias("grounding"))


def orphans(leaves: DataFrame, chunks: DataFrame) -> DataFrame:
    """Content chunks that no leaf refers to."""
    used = leaves.select(F.explode("chunk_ids").alias("id")).distinct()
    return chunks.filter(F.col("kind").isin(*CONTENT_KINDS)).join(used, "id", "left_anti")


def coverage(leaves: DataFrame, chunks: DataFrame) -> DataFrame:
    """The one-row report. orphan_chunks lists every orphan's id, in order; none are expected."""
    content = chunks.filter(F.col("kind").isin(*CONTENT_KINDS)).agg(F.count("*").alias("total_content_chunks"))
    lost = orphans(leaves, chunks).agg(F.transform(F.sort_array(F.collect_list(F.struct("chunk_ord", "id"))), lambda x: x["id"]).alias("orphan_chunks"))
    facts = leaves.agg(
        F.count("*").alias("leaf_count"), F.count_if(F.col("confidence") == "low").alias("low_confidence_leaves"), F.count_if(F.col("priority") == "must").alias("must_leaves"), F.coalesce(F.bool_and(leaf_valid()), F.lit(True)).alias("schema_valid")
    )
    ground = leaf_grounding(leaves, chunks).agg(F.coalesce(F.round(F.avg("grounding"), 3), F.lit(1.0)).alias("avg_grounding"), F.count_if(F.col("grounding") < 0.5).alias("low_grounding_leaves"))
    out = content.crossJoin(lost).crossJoin(facts).crossJoin(ground)  # one row each
    return out.select(
        "schema_valid", "total_content_chunks", (F.col("total_content_chunks") - F.size("orphan_chunks")).alias("referenced_chunks"), "orphan_chunks", "leaf_count", "low_confidence_leaves", "must_leaves", "avg_grounding", "low_grounding_leaves"
    )
