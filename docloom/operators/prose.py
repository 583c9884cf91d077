"""Prose tenders: headings and list items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import patterns as P

FIRST_SECTION = "Specification"


def is_heading(t: Column) -> Column:
    """3 to 60 characters, no sentence end, and: ends with a colon, or capitals of at most 6 words, or begins with a section word."""
    words = F.size(F.split(t, f"{P.S}+"))
    letters = F.regexp_replace(t, "[^A-Za-zÄÖÜäöüß]", "")
    # ß has no capital of its own, so a word with ß is never all capitals
    capitals = (F.length(letters) >= 3) & (letters == F.upper(letters)) & (words <= 6)
    shape = t.rlike(r":\z") | capitals | (t.rlike(P.SECTION_WORDS) & (words <= 6))
    return F.length(t).between(3, 60) & ~t.rlike(r"[.!?]\z") & shape


def prose_lines(content: DataFrame) -> DataFrame:
    """Non-blank ``content`` lines with t, heading, item (text or null), section and idx (items before in the file).

    Other columns of ``content`` than file_id, page, y, text and line_ord aren't read. Section and index are carried from page to page by page summaries, as in the position grammar.
    """
    t = F.col("t")
    number, bullet = F.regexp_extract("t", P.ITEM_NUMBER, 2), F.regexp_extract("t", P.ITEM_BULLET, 1)
    item = P.trim(F.when(t.rlike(P.ITEM_NUMBER), number).when(t.rlike(P.ITEM_BULLET), bullet))
    rows = content.select("file_id", "page", "y", "text", "line_ord").withColumn("t", P.trim(F.col("text"))).filter("t <> ''").withColumn("heading", is_heading(t))
    rows = rows.withColumn("item", F.when(~F.col("heading") & (item != ""), item)).withColumn("own", F.when(F.col("heading"), P.trim(F.regexp_replace("t", r"[:.]+\z", ""))))
    within = Window.partitionBy("file_id", "page").orderBy(F.desc("y"), "line_ord").rowsBetween(Window.unboundedPreceding, 0)
    is_item = F.col("item").isNotNull().cast("long")
    rows = rows.withColumn("local", F.last("own", ignorenulls=True).over(within)).withColumn("nth", F.sum(is_item).over(within))
    pages = rows.groupBy("file_id", "page").agg(F.sum(is_item).alias("n"), F.max(F.when(F.col("heading"), F.struct((-F.col("y")).alias("y"), "line_ord", "own")))["own"].alias("last"))
    before = Window.partitionBy("file_id").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    pages = pages.select("file_id", "page", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.last("last", ignorenulls=True).over(before).alias("carried"))
    joined = rows.join(pages, ["file_id", "page"])
    section = F.coalesce("local", "carried", F.lit(FIRST_SECTION))
    return joined.withColumn("section", section).withColumn("idx", F.col("nth") + F.col("offset") - 1).drop("own", "local", "nth", "offset", "carried")


def paragraphs(prose: DataFrame) -> DataFrame:
    """Chunks from the items of ``prose_lines``."""
    none = F.lit(None).cast("string")
    return prose.filter("item is not null").select(
        F.concat("file_id", F.lit(":p"), F.col("page").cast("string"), F.lit(":b"), F.col("idx").cast("string")).alias("id"), "file_id", "page", F.lit("paragraph").alias("kind"), none.alias("oz_code"),
        F.substring("item", 1, 80).alias("title"), F.col("item").alias("text"), none.alias("quantity"), F.lit(None).cast("boolean").alias("equivalence"), "section", F.col("idx").alias("seg"),
    )
