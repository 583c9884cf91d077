"""The position grammar: codes, groups and titles to chunks.

A line's class is one CASE. Positions, groups and recaps are events; a segment runs from an event to the next. Segment
numbers and the state at a line are running values over a file. They are computed by page and then carried over the
file's pages, so the rows of even a giant file are spread: only its page summaries meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import patterns as P


def line_classes(lines: DataFrame) -> DataFrame:
    """The non-blank ``lines`` (file_id, page, y, text, line_ord; other columns aren't read) with t (trimmed), cls, code and rest (the code's or title's text)."""
    t = F.col("t")
    code = lambda p: F.regexp_extract("t", p, 1)
    rest = lambda p: F.regexp_extract("t", p, 2)
    order = [("position", P.POSITION), ("position", P.POSITION_ROOM), ("group", P.GROUP), ("group", P.GROUP_ROOM), ("title", P.TITLE)]

    def pick(value, last):
        out = F
        for name, p in order:
            out = out.when(t.rlike(p), value(name, p))
        return out.otherwise(last)

    recap = F.when(t.rlike(P.RECAP), "recap").otherwise("other")
    found = lines.select("file_id", "page", "y", "text", "line_ord").withColumn("t", P.trim(F.col("text"))).filter("t <> ''")
    found = found.withColumn("cls", pick(lambda n, p: F.lit(n), recap)).withColumn("code", pick(lambda n, p: code(p), F.lit(None))).withColumn("rest", P.trim(pick(lambda n, p: rest(p), F.lit(None))))
    return found.filter(~((F.col("cls") == "position") & F.col("rest").rlike(P.LEGEND)))


def segments(classed: DataFrame) -> DataFrame:
    """``classed`` with seg (events so far in the file), head (the class of the last event, null before any) and event.

    A title-shaped line that follows an open position is looked at again: it may be a recap line, which is an event. No
    such line can match both patterns, as one begins with digits.
    """
    event = F.col("cls").isin("position", "group", "recap")
    within = Window.partitionBy("file_id", "page").orderBy(F.desc("y"), "line_ord").rowsBetween(Window.unboundedPreceding, 0)
    local = classed.withColumn("event", event).withColumn("local_seg", F.sum(F.col("event").cast("long")).over(within)).withColumn("local_head", F.last(F.when(F.col("event"), F.col("cls")), ignorenulls=True).over(within))
    pages = local.groupBy("file_id", "page").agg(F.sum(F.col("event").cast("long")).alias("n"), F.max(F.when(F.col("event"), F.struct((-F.col("y")).alias("y"), "line_ord", "cls")))["cls"].alias("last_head"))
    before = Window.partitionBy("file_id").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    pages = pages.select("file_id", "page", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.last("last_head", ignorenulls=True).over(before).alias("carried"))
    out = local.join(pages, ["file_id", "page"])
    return out.withColumn("seg", F.col("local_seg") + F.col("offset")).withColumn("head", F.coalesce("local_head", "carried")).drop("local_seg", "local_head", "offset", "carried")


def labels(segmented: DataFrame, cls: str) -> DataFrame:
    """(file_id, key, label) of groups or titles, the last one of a key. Titles count only while no position is open."""
    rows = segmented.filter(F.col("cls") == cls)
    if cls == "title":
        rows = rows.filter(F.col("head").isNull() | (F.col("head") != "position"))
    return rows.groupBy("file_id", F.col("code").alias("key")).agg(F.max_by(P.clean_label(F.col("rest")), F.struct("page", -F.col("y"), "line_ord")).alias("label"))


def positions(segmented: DataFrame) -> DataFrame:
    """Chunks (id, file_id, page, kind, oz_code, title, text, quantity, equivalence, section, seg) from position segments."""
    rows = segmented.filter("head = 'position'")
    head = F.col("event")
    order = F.struct("page", -F.col("y"), "line_ord")
    amount = F.when(~head & F.col("t").rlike(P.QUANTITY), P.trim(F.concat(F.regexp_extract("t", P.QUANTITY, 1), F.lit(" "), F.regexp_extract("t", P.QUANTITY, 2))))
    body = ~head & ~F.col("t").rlike(P.LEADER) & ~F.col("t").rlike(P.COLUMN_HEAD) & ~F.col("t").rlike(P.PRICE_HEAD)
    line = F.when(head, F.col("rest")).when(body, F.col("t"))
    parts = F.sort_array(F.collect_list(F.when(line.isNotNull(), F.struct("page", (-F.col("y")).alias("y"), "line_ord", line.alias("line")))))
    found = rows.withColumn("amount", amount).groupBy("file_id", "seg").agg(
        F.min(F.when(head, F.col("page"))).alias("page"), F.min(F.when(head, F.col("code"))).alias("oz_code"), F.min(F.when(head, F.col("rest"))).alias("title"),
        parts.alias("parts"), F.max_by("amount", F.when(F.col("amount").isNotNull(), order)).alias("quantity"),
    )
    text = P.trim(F.regexp_replace(F.array_join(F.transform("parts", lambda p: p["line"]), "\n"), "\n{2,}", "\n"))
    found = found.withColumn("text", text)
    void = F.col("text").rlike(P.VOID_TEXT) & (F.length("text") < 40)
    return found.select(
        F.concat("file_id", F.lit(":p"), F.col("page").cast("string"), F.lit(":"), "oz_code").alias("id"), "file_id", "page",
        F.when(void, "void").otherwise("position").alias("kind"), "oz_code", F.when(F.col("title") != "", F.col("title")).alias("title"), "text", "quantity",
        F.when(F.col("text").rlike(P.EQUIVALENT_DE), True).alias("equivalence"), F.lit(None).cast("string").alias("section"), "seg",
    )
