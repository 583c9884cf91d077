"""Text lines from positioned tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.patterns import collapse, ordered_join, trim

TOLERANCE = 3.0
GAP = 1.5


def assign_rows(tokens: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """``tokens`` (file_id, page, tok_ord, str, x, y) with row and row_y.

    In token order a token joins the first row whose first token's y is within ``tolerance``, or opens a row. Blank and null
    tokens go. The order within a page decides, so the page's tokens meet in one array; pages are spread over the cluster.
    """
    seen = tokens.filter(trim(F.col("str")) != "")
    page = seen.groupBy("file_id", "page").agg(F.sort_array(F.collect_list(F.struct("tok_ord", "y", "x", "str"))).alias("toks"))
    zero = F.expr("struct(cast(array() as array<double>) as anchors, cast(array() as array<int>) as place)")

    def step(acc, t):
        hit = F.array_position(F.transform(acc["anchors"], lambda a: F.abs(a - t["y"]) <= tolerance), True).cast("int")
        new = hit == 0
        anchors = F.when(new, F.concat(acc["anchors"], F.array(t["y"]))).otherwise(acc["anchors"])
        place = F.concat(acc["place"], F.array(F.when(new, F.size(acc["anchors"]) + 1).otherwise(hit)))
        return F.struct(anchors.alias("anchors"), place.alias("place"))

    rows = page.withColumn("rows", F.aggregate("toks", zero, step))
    each = F.explode(F.arrays_zip(F.col("toks").alias("t"), F.col("rows.place").alias("row")))
    out = rows.select("file_id", "page", F.col("rows.anchors").alias("anchors"), each.alias("e"))
    return out.select("file_id", "page", "e.t.tok_ord", "e.t.str", "e.t.x", "e.t.y", "e.row", F.element_at("anchors", F.col("e.row")).alias("row_y"))


def render_rows(rows: DataFrame) -> DataFrame:
    """Lines (file_id, page, y, x, text, line_ord) from ``assign_rows``: rows from high y to low, tokens from low x to high.

    A space goes between tokens if the next one begins over GAP after the last one's x plus its number of characters.
    """
    across = Window.partitionBy("file_id", "page", "row").orderBy("x", "tok_ord")
    end = F.col("x") + F.length("str")
    piece = F.when(F.col("x") - F.lag(end).over(across) > GAP, F.concat(F.lit(" "), "str")).otherwise(F.col("str"))
    placed = rows.withColumn("piece", piece)
    text = collapse(ordered_join([F.col("x"), F.col("tok_ord")], F.col("piece"), ""))
    lines = placed.groupBy("file_id", "page", "row").agg(F.first("row_y").alias("y"), F.min("x").alias("x"), text.alias("text"))
    down = Window.partitionBy("file_id", "page").orderBy(F.desc("y"), "row")
    return lines.withColumn("line_ord", F.col("page").cast("long") * (1 << 20) + F.row_number().over(down)).drop("row")


def reconstruct_lines(tokens: DataFrame) -> DataFrame:
    """Lines of every page of ``tokens``; line_ord grows with page and row."""
    return render_rows(assign_rows(tokens))
