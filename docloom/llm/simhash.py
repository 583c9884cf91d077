"""SimHash near-duplicate groups by pivot distance tables.

A pivot is a reference fingerprint; a row of the table holds a fingerprint's Hamming distances to the pivots. Hamming
distance is a metric, so two fingerprints within ``radius`` differ by at most ``radius`` in every coordinate: a pair with
a larger coordinate difference is discarded and only the survivors are compared bit by bit.

The table has two kinds of pivots. The *unit* pivots are zero and the 64 one-bit fingerprints. Their coordinates make the
equi-join: ``radius`` changes reach at most ``radius`` of ``radius + 2`` bands of bits, and the distances to zero and to a band's
one-bit pivots differ alike for two fingerprints exactly where they agree in the band. So every pair to be found has two
bands' coordinates in common, which makes cells (10 of about 26 bits for radius 3). Within a cell the *spread* pivots,
pseudo-random fingerprints, order the rows and discard pairs. Cells give spanning links, not all pairs; a cell with many
rows is dealt out in parts, every two of which meet in a task.

``near_duplicates`` groups by fingerprints alone. ``keep_one`` is for texts of a given Jaccard similarity, which no radius
can promise: pairs from the table are verified shingle by shingle, and what the radius can't reach is completed by
the exact join of ``similar.py``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import similar
from .common import discard, materialize, slices, text_values, tune
from .components import components
from .shingles import BITS, SEED, fingerprint, shingle_hashes

SPREAD_PIVOTS = 16
#: Rows of a cell's parts.
CELL_ROWS = 2000


def fingerprints(df: DataFrame, id_col: str, text_col: str, width: int = 3) -> DataFrame:
    """(doc_id, fp long) of every row's whole text; null and wordless texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                found = np.array([fingerprint(shingle_hashes(x, width)) for x in text_values(b.column("text"))], np.uint64)
                yield pa.record_batch([b.column("doc_id"), pa.array(found.view(np.int64), pa.int64())], names=["doc_id", "fp"])

    kind = dict(df.dtypes)[id_col]
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, fp long")


def bands(radius: int) -> list[range]:
    """The bits of ``radius + 2`` bands."""
    edges = [round(i * BITS / (radius + 2)) for i in range(radius + 3)]
    return [range(a, b) for a, b in zip(edges, edges[1:], strict=False)]


def spread_pivots() -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(b"pivot %d" % i, SEED) for i in range(SPREAD_PIVOTS)], np.uint64)


def distance(fp: Column, pivot: int) -> Column:
    return F.bit_count(fp.bitwiseXOR(F.lit(pivot - (1 << BITS) if pivot >> (BITS - 1) else pivot)))


def pivot_table(distinct: DataFrame, radius: int) -> DataFrame:
    """(fp, bands, spread): the coordinates of each fingerprint.

    A band's number has a digit for each of its unit pivots: whether it is nearer than zero is, or farther. ``spread`` has the
    distances to the spread pivots.
    """
    fp = F.col("fp")
    zero = distance(fp, 0)

    def number(band: range) -> Column:
        return sum((F.shiftleft(((zero - distance(fp, 1 << i) + 1) / 2).cast("long"), i - band[0]) for i in band), F.lit(0).cast("long"))

    return distinct.select("fp", F.array(*map(number, bands(radius))).alias("bands"), F.array(*(distance(fp, int(p)).cast("byte") for p in spread_pivots())).alias("spread"))


def cell_links(fps: np.ndarray, table: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning links among distinct fingerprints (pairs of positions); ``table``: their coordinates.

    Breadth first: a fingerprint taken from the queue is compared with those not yet reached, of which the first pivot's
    order leaves a window and the others discard more. What has been reached is never compared again.
    """
    order = np.argsort(table[:, 0], kind="stable")
    fps_o, table_o = fps[order], table[order]
    left = np.arange(len(fps))
    links = []
    while len(left):
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            x = queue.pop()
            first = table_o[left, 0]
            lo, hi = np.searchsorted(first, (table_o[x, 0] - radius, table_o[x, 0] + radius + 1))
            near = left[lo:hi]
            near = near[(np.abs(table_o[near] - table_o[x]) <= radius).all(axis=1)]
            near = near[np.bitwise_count(fps_o[near] ^ fps_o[x]) <= radius]
            if len(near):
                links += [(order[root], order[y]) for y in near]
                queue += near.tolist()
                left = np.setdiff1d(left, near, assume_unique=True)
    return links


def near_links(distinct: DataFrame, radius: int = 3, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(a, b): links that span every group of the distinct fingerprints ``fp`` joined by at most ``radius`` bits.

    Fingerprints without a near one are in no link; an empty table gives no rows; other columns are not read.
    """
    table = materialize(pivot_table(distinct, radius), "pivots")
    pairs = F.array(*(F.struct(F.lit(t).alias("t"), F.element_at("bands", i + 1).alias("x"), F.element_at("bands", j + 1).alias("y")) for t, (i, j) in enumerate(combinations(range(radius + 2), 2))))
    rows = table.select("fp", "spread", F.explode(pairs).alias("c")).select("c.*", "fp", "spread")
    cell = ["t", "x", "y"]
    hot = materialize(rows.groupBy(*cell).agg(F.count("*").alias("n")).filter(F.col("n") > cell_rows).select(*cell, F.ceil(F.col("n") / cell_rows).alias("parts")), "hot")
    own = F.pmod(F.xxhash64("fp"), F.col("parts"))
    # Every two parts of a hot cell meet; the parts' rows go to as many tasks as there are parts.
    met = F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda o: F.least(own, o) * F.col("parts") + F.greatest(own, o))))
    rows = rows.join(hot, cell, "left").select(*cell, met.alias("m"), "fp", "spread") if hot.take(1) else rows.select(*cell, F.lit(0).cast("long").alias("m"), "fp", "spread")
    cell.append("m")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, *cell).sortWithinPartitions(*cell)

    def cut(held: pa.Table, last: bool) -> tuple[list, pa.Table]:
        """Links of the whole cells; the rows of the last one are handed back if more may come."""
        keys = [held.column(c).to_numpy() for c in cell]
        changed = np.zeros(len(held) - 1, bool)
        for k in keys:
            changed |= k[1:] != k[:-1]
        begins = np.flatnonzero(np.r_[True, changed])
        ends = np.r_[begins[1:], len(held)]
        fps = held.column("fp").to_numpy().view(np.uint64)
        spread = held.column("spread").combine_chunks().flatten().to_numpy().reshape(-1, SPREAD_PIVOTS)
        found = []
        for b, e in zip(begins[: len(begins) - (not last)].tolist(), ends.tolist(), strict=False):
            if e - b > 1:
                found += [(fps[b + x], fps[b + y]) for x, y in cell_links(fps[b:e], spread[b:e], radius)]
        return found, held.slice(len(held) if last else begins[-1])

    def out(found: list) -> pa.RecordBatch:
        both = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.record_batch([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        same = lambda x, y: all(x.column(c)[0] == y.column(c)[-1] for c in cell)
        for b in batches:
            if b.num_rows:
                held.append(b)
                if not same(held[0], b):
                    found, rest = cut(pa.Table.from_batches(held), last=False)
                    held = rest.to_batches()
                    yield out(found)
        if held:
            yield out(cut(pa.Table.from_batches(held), last=True)[0])

    links = materialize(dealt.mapInArrow(run, "a long, b long").distinct(), "links")
    discard(table, hot)
    return links


def groups(prints: DataFrame, radius: int = 3) -> DataFrame:
    """(fp, component_id) for every distinct fingerprint of ``prints`` (doc_id, fp).

    Null ids are no smallest ids; a component of null ids alone has a null component_id. Repeated rows change nothing, an empty
    table gives no rows, other columns are not read.
    """
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = components(near_links(distinct.select("fp"), radius))
    rooted = materialize(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "roots")
    # Written out, so that the join has an exchange of its own on either side and a large component's rows can be split.
    smallest = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    return rooted.join(smallest, "root").select("fp", "component_id")


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row.

    component_id is the smallest id reachable over fingerprints that differ in at most ``radius`` bits. Null and wordless
    texts have fingerprint zero and are linked by it. Rows with a null id take part and may have the component of other
    rows; a component of null ids alone has a null component_id. Repeated rows stay. An empty table gives no rows. Other
    columns of ``df`` are not read.
    """
    tune(df.sparkSession)
    prints = materialize(fingerprints(df, id_col, text_col, width), "prints")
    return prints.join(groups(prints, radius), "fp").select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = similar.WIDTH, least: tuple[int, int] = similar.SIMILARITY, radius: int = 3) -> DataFrame:
    """One row of ``df``, with all its columns, for each group of near duplicates: a row with the group's smallest id.

    A group is what similar texts join, over any number of steps; similar are texts whose sets of ``width``-word shingles
    (of all words if there are fewer) have a Jaccard similarity of ``least`` (a fraction) or more. Null and wordless texts
    are one group. Null ids come after all others. Rows are told apart by their place, so unlike texts with a repeated or
    null id all stay. An empty table stays empty; columns are kept whatever their names are.
    """
    tune(df.sparkSession)
    keyed = similar.distinct_sets(df, id_col, text_col, width)
    texts = keyed.select(F.col(similar.ROW).alias("row"), F.col(text_col).cast("string").alias("text"))
    known = materialize(similar.sketches(texts, width, least), "sketches")
    # Rows of one fingerprint are led by the first of them; leaders of near fingerprints are pairs like those.
    prints = known.select("row", "fp").filter("row is not null")
    leaders = materialize(prints.groupBy("fp").agg(F.min("row").alias("leader")), "leaders")
    linked = near_links(leaders.select("fp"), radius)
    alike = prints.join(leaders, "fp").filter("row <> leader").select(F.col("leader").alias("a"), F.col("row").alias("b"))
    lead = lambda c: leaders.select(F.col("fp").alias(c), F.col("leader").alias(f"{c}_row"))
    near = linked.join(lead("a"), "a").join(lead("b"), "b").select(F.least("a_row", "b_row").alias("a"), F.greatest("a_row", "b_row").alias("b"))
    pairs = materialize(alike.unionByName(near).distinct(), "survivors")
    roots = materialize(components(similar.links(texts, known, pairs, width, least)), "roots")
    discard(known, leaders, linked, pairs)
    ids = keyed.select(F.col(similar.ROW).alias("row"), F.col(id_col).alias("id")).join(roots.withColumnRenamed("node", "row"), "row")
    first = materialize(ids.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("row"))).alias("first")), "first")
    gone = ids.join(first, "root").filter("row <> first.row").select(F.col("row").alias(similar.ROW))
    return keyed.join(gone, similar.ROW, "left_anti").select(*(F.col(f"`{c}`") for c in df.columns))
