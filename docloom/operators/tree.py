"""The three-level tree. Spark has no recursive types, so its levels are written out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def node(bullet: Column, language: Column, description: Column, priority: Column, confidence: Column, equivalence: Column, children: Column, ids: Column) -> Column:
    """A node's fields in their order; those below the ids are always the same."""
    strings = F.expr("cast(array() as array<string>)")
    fields = {
        "bulletPoint": bullet, "description": F.create_map(language, description), "priority": priority, "confidence": confidence, "equivalenceAllowed": equivalence,
        "deliverableArray": children, "procurementDocumentChunkIdArray": ids, "fullfillable": F.lit(None).cast("boolean"), "status": F.lit("waitingForAnalysis"),
        "aiReasoning": F.lit(None).cast("string"), "feedback": F.lit(None).cast("string"), "feedbackText": F.lit(None).cast("string"), "openQuestionId": F.lit(None).cast("string"),
        "workspaceDocumentChunkIdArray": strings, "citedProductIdArray": strings, "citedPersonIdArray": strings,
    }
    return F.struct(*(c.alias(n) for n, c in fields.items()))


def assemble(leaves: DataFrame) -> DataFrame:
    """(ord, node): a row for each level-1 node, by first appearance; labels and language come from a node's first leaf."""
    none, no_flag, must = F.lit(None).cast("string"), F.lit(None).cast("boolean"), F.lit("must")
    empty = F.expr("cast(array() as array<string>)")
    leaf = node(F.col("bullet_point"), F.col("language"), F.col("description_source"), F.col("priority"), F.col("confidence"), F.col("equivalence_allowed"), empty, F.col("chunk_ids"))
    first = F.min_by(F.struct("level1_label", "level2_label", "language"), "leaf_ord").alias("first")
    # create_map has no order, so it can't take part in a sort: arrays are sorted by the ordinal alone
    by_ord = lambda rows: F.transform(F.array_sort(rows, lambda a, b: F.when(a["leaf_ord"] < b["leaf_ord"], -1).when(a["leaf_ord"] > b["leaf_ord"], 1).otherwise(0)), lambda x: x["node"])
    two = leaves.withColumn("node", leaf).groupBy("level1_key", "level2_key").agg(first, F.min("leaf_ord").alias("leaf_ord"), by_ord(F.collect_list(F.struct("leaf_ord", "node"))).alias("children"))
    second = node(F.col("first.level2_label"), F.col("first.language"), F.col("first.level2_label"), must, none, no_flag, F.col("children"), empty)
    label = F.min_by(F.struct(F.col("first.level1_label").alias("label"), F.col("first.language").alias("language")), "leaf_ord").alias("first")
    one = two.withColumn("node", second).groupBy("level1_key").agg(label, F.min("leaf_ord").alias("leaf_ord"), by_ord(F.collect_list(F.struct("leaf_ord", "node"))).alias("children"))
    top = node(F.col("first.label"), F.col("first.language"), F.col("first.label"), must, none, no_flag, F.col("children"), empty)
    return one.select(F.col("leaf_ord").alias("ord"), top.alias("node"))


def tree_leaves(tree: DataFrame) -> DataFrame:
    """The level-3 nodes of ``assemble``'s rows with the labels above them; the depth is fixed, so two explodes do."""
    two = tree.select("ord", F.col("node.bulletPoint").alias("level1"), F.posexplode("node.deliverableArray").alias("l2", "second"))
    return two.select("ord", "level1", "l2", F.col("second.bulletPoint").alias("level2"), F.posexplode("second.deliverableArray").alias("l3", "leaf"))


def level_counts(leaves: DataFrame) -> DataFrame:
    """(level1_key, level2_key, n_leaves) with subtotals and the total (null keys)."""
    return leaves.rollup("level1_key", "level2_key").agg(F.count("*").alias("n_leaves"))
