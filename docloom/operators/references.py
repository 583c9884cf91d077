"""Cross-references between leaves and to documents that aren't there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import patterns as P

LEAST_NAME = 3
REPORT_ROWS = 50


def source_texts(leaves: DataFrame, chunks: DataFrame, by: str = "\n") -> DataFrame:
    """(leaf_ord, text): the texts of each leaf's chunks in order; of chunks with one id the last counts, a missing one is empty."""
    last = chunks.groupBy("id").agg(F.max_by("text", "chunk_ord").alias("text"))
    each = leaves.select("leaf_ord", F.posexplode("chunk_ids").alias("pos", "id")).join(last, "id", "left")
    return each.groupBy("leaf_ord").agg(P.ordered_join([F.col("pos")], F.coalesce("text", F.lit("")), by).alias("text"))


def grams(c: Column) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 2, F.lit(1))), lambda i: F.substring(c, i, F.lit(3))))


def internal_matches(leaves: DataFrame, texts: DataFrame) -> DataFrame:
    """(leaf_ord, nth, name, target_ord): for each named position the first other leaf whose bullet contains the name.

    The containment join goes through the name's rarest three-letter string, an ordinary equi-join, and not over all pairs.
    """
    names = texts.select("leaf_ord", F.posexplode(F.regexp_extract_all("text", F.lit(P.INTERNAL_REF), F.lit(1))).alias("nth", "raw"))
    names = names.select("leaf_ord", "nth", F.lower(P.trim(F.col("raw"))).alias("name")).filter(F.length("name") >= LEAST_NAME)
    bullets = leaves.select(F.col("leaf_ord").alias("target_ord"), F.lower("bullet_point").alias("bullet"))
    index = bullets.select("target_ord", F.explode(grams(F.col("bullet"))).alias("gram"))
    counts = index.groupBy("gram").agg(F.count("*").alias("n"))
    distinct = names.select("name").distinct()
    rarest = distinct.select("name", F.explode(grams(F.col("name"))).alias("gram")).join(counts, "gram", "left").groupBy("name").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("gram"))
    # The index has ids alone; bullets join those that share the name's rarest string.
    hits = rarest.join(index, "gram").select("name", "target_ord").join(bullets, "target_ord").filter(F.col("bullet").contains(F.col("name")))
    # The first two targets suffice: one of them may be the leaf itself. Each task keeps two for a name before the shuffle.
    rank = F.row_number().over(Window.partitionBy("name").orderBy("target_ord"))
    first = hits.withColumn("rank", rank).filter("rank <= 2").groupBy("name").agg(F.min("target_ord").alias("first"), F.max(F.when(F.col("rank") == 2, F.col("target_ord"))).alias("second"))
    target = F.when(F.col("first") != F.col("leaf_ord"), F.col("first")).otherwise(F.col("second"))
    return names.join(first, "name").withColumn("target_ord", target).filter("target_ord is not null").select("leaf_ord", "nth", "name", "target_ord")


def resolve_internal(leaves: DataFrame, matches: DataFrame, cut: Callable[[DataFrame, str], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(leaves with the ids of what they refer to, (leaf_ord, grew)).

    Leaves are visited in order, so a leaf that refers back takes what its target has gained, and one that refers ahead takes
    the target's own ids. A leaf's list therefore is its own ids, then for each match in order the target's list or its own
    ids, each id at its first place. Lists begin with marks for targets behind; every round puts the targets' lists as they
    are in place of the marks, which doubles the links that are followed. Only leaves with matches take part. A target that a
    leaf names again brings nothing new, so it counts once, at its first place, and its ids aren't carried for each mention.
    """
    own = leaves.select("leaf_ord", "chunk_ids")
    matches = cut(matches.groupBy("leaf_ord", "target_ord").agg(F.min("nth").alias("nth")), "matches")
    if not matches.take(1):
        return leaves, matches.select("leaf_ord", F.lit(0).alias("grew"))
    # Items are strings, as those are compared by hash and structs one by one: an id after "=", a mark after "@".
    as_items = lambda ids: F.transform(ids, lambda i: F.concat(F.lit("="), i))
    is_mark = lambda i: F.coalesce(F.startswith(i, F.lit("@")), F.lit(False))
    target = own.select(F.col("leaf_ord").alias("target_ord"), F.col("chunk_ids").alias("t_own"))
    refers = matches.select(F.col("leaf_ord").alias("target_ord"), F.lit(True).alias("refers")).distinct()
    took = matches.join(target, "target_ord").join(refers, "target_ord", "left")
    mark = F.array(F.concat(F.lit("@"), F.col("target_ord").cast("string")))
    took = took.withColumn("items", F.when((F.col("target_ord") < F.col("leaf_ord")) & F.col("refers"), mark).otherwise(as_items(F.col("t_own"))))
    lists = took.groupBy("leaf_ord").agg(F.sort_array(F.collect_list(F.struct("nth", "target_ord", "items"))).alias("ms")).join(own, "leaf_ord")
    now = cut(lists.select("leaf_ord", F.array_distinct(F.concat(as_items(F.col("chunk_ids")), F.flatten(F.transform("ms", lambda m: m["items"])))).alias("items")), "lists")
    while now.filter(F.exists("items", is_mark)).take(1):
        each = now.select("leaf_ord", F.posexplode("items").alias("pos", "item"))
        behind = now.select(F.col("leaf_ord").alias("ref"), F.col("items").alias("put"))
        # Only marks are joined; rows without one would all have the same key.
        put = each.filter(is_mark(F.col("item"))).withColumn("ref", F.expr("cast(substring(item, 2) as bigint)")).join(behind, "ref").select("leaf_ord", "pos", "put")
        put = put.unionByName(each.filter(~is_mark(F.col("item"))).select("leaf_ord", "pos", F.array("item").alias("put")))
        now = cut(put.groupBy("leaf_ord").agg(F.array_distinct(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("pos", "put"))), lambda x: x["put"]))).alias("items")), "lists")
    done = now.select("leaf_ord", F.transform("items", lambda i: F.substr(i, F.lit(2))).alias("ids"))
    # A match counts if it was the first to bring an id. Ids are rows here, so no leaf's lists meet in one value.
    final = took.join(done.select(F.col("leaf_ord").alias("target_ord"), F.col("ids").alias("t_all")), "target_ord", "left")
    brought = F.when(F.col("target_ord") < F.col("leaf_ord"), F.coalesce("t_all", "t_own")).otherwise(F.col("t_own"))
    had = own.join(matches.select("leaf_ord").distinct(), "leaf_ord", "left_semi").select("leaf_ord", F.lit(-1).alias("nth"), F.explode_outer("chunk_ids").alias("id"))
    first = had.unionByName(final.select("leaf_ord", "nth", F.explode(brought).alias("id"))).groupBy("leaf_ord", "id").agg(F.min("nth").alias("nth"))
    grew = first.groupBy("leaf_ord").agg(F.countDistinct(F.when(F.col("nth") >= 0, F.col("nth"))).cast("int").alias("grew"))
    out = leaves.join(done, "leaf_ord", "left").withColumn("chunk_ids", F.coalesce("ids", "chunk_ids")).select(*leaves.columns)
    return out, grew


def external_refs(leaves: DataFrame, texts: DataFrame) -> DataFrame:
    """(leaf_ord, leaf_bullet_point, reference): each leaf's first mention of a document."""
    found = texts.withColumn("reference", F.regexp_extract("text", P.EXTERNAL_REF, 1)).filter("reference <> ''")
    return found.join(leaves.select("leaf_ord", F.substring("bullet_point", 1, 60).alias("leaf_bullet_point")), "leaf_ord").select("leaf_ord", "leaf_bullet_point", "reference")


def resolve_references(leaves: DataFrame, chunks: DataFrame, files: DataFrame, cut: Callable[[DataFrame, str], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(leaves, report). Documents are flagged only if no file of the run is an annex; flagged leaves are at most of medium confidence."""
    texts = source_texts(leaves, chunks).join(leaves.select("leaf_ord", "description_source"), "leaf_ord", "right")
    texts = texts.select("leaf_ord", F.when(F.coalesce("text", F.lit("")) != "", F.col("text")).otherwise(F.col("description_source")).alias("text"))
    resolved, grew = resolve_internal(leaves, internal_matches(leaves, texts), cut)
    annexes = files.agg(F.coalesce(F.bool_or(F.col("role_guess") == "annex"), F.lit(False)).alias("annex"))
    flagged = external_refs(leaves, texts)
    if annexes.first()["annex"]:
        flagged = flagged.limit(0)
    marked = resolved.join(flagged.select("leaf_ord", F.lit(True).alias("flag")), "leaf_ord", "left")
    confidence = F.when(F.col("flag") & (F.col("confidence") == "high"), "medium").otherwise(F.col("confidence"))
    out = marked.withColumn("confidence", confidence).select(*leaves.columns)
    top = flagged.orderBy("leaf_ord").limit(REPORT_ROWS)
    listed = top.agg(F.transform(F.sort_array(F.collect_list(F.struct("leaf_ord", "leaf_bullet_point", "reference"))), lambda x: F.struct(x["leaf_bullet_point"].alias("leaf_bullet_point"), x["reference"].alias("reference"))).alias("unresolved"))
    report = leaves.agg(F.count("*").alias("scanned_leaves")).crossJoin(grew.agg(F.coalesce(F.sum("grew"), F.lit(0)).cast("long").alias("internal_resolved"))).crossJoin(flagged.agg(F.count("*").alias("external_unresolved"))).crossJoin(listed)
    return out, report
