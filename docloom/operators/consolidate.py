"""Exact and near-duplicate merges of leaves."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.patterns import tokens
from docloom.plans.tables import written

LEAST = 0.7
SIMILAR_CHARS = 200
#: Candidate pairs that the driver looks at together.
PAIRS = 500
ORDINALS = 10_000
#: Tokens that similar sets must share among their rarest, if they have as many.
SHARED = 8
#: Numbers in the table of token frequencies, bits of a token's hash that candidates meet by, and bits in the map of ids.
SLOTS = 1 << 20
KEYS = (1 << 40) - 1
BITS = 1 << 23


def merge_exact(leaves: DataFrame) -> DataFrame:
    """One leaf for each (level2_key, bullet_point), over all files: the first row's fields, ordered union of chunk_ids.

    equivalence_allowed is true if any is, else the first row's value (null and false stay apart). The group's rows are small
    structs that aggregate before the shuffle as far as arrays can.
    """
    others = [c for c in leaves.columns if c not in ("chunk_ids", "equivalence_allowed", "leaf_ord", "level2_key", "bullet_point")]
    ids = F.sort_array(F.collect_list(F.struct("leaf_ord", "chunk_ids")))
    out = leaves.groupBy("level2_key", "bullet_point").agg(
        F.min_by(F.struct(*others, "equivalence_allowed"), "leaf_ord").alias("first"), ids.alias("ids"), F.max(F.coalesce("equivalence_allowed", F.lit(False))).alias("any"), F.min("leaf_ord").alias("leaf_ord")
    )
    union = F.array_distinct(F.flatten(F.transform("ids", lambda x: x["chunk_ids"])))
    allowed = F.when(F.col("any"), True).otherwise(F.col("first.equivalence_allowed"))
    return out.select(*(F.col(f"first.{c}").alias(c) for c in others), "level2_key", "bullet_point", "leaf_ord", union.alias("chunk_ids"), allowed.alias("equivalence_allowed")).select(*leaves.columns)


def _prefixes(sets: DataFrame, others: DataFrame, block: list[str], least: float) -> DataFrame:
    """(key, id, size, at): the hashes of the rarest tokens of each set but ``others`` (id), enough of them that similar sets share SHARED or all.

    The common order is by the number of tokens in a hash's slot, then by hash. Any order is exact, a rare one leaves fewer
    candidates, so a table of SLOTS numbers does and no token is shuffled to learn its frequency or its rank.
    """
    hashed = sets.select("id", F.transform("toks", lambda t: F.xxhash64(*block, t)).alias("hashes"))
    slots = hashed.select(F.explode("hashes").alias("h")).groupBy(F.col("h").bitwiseAND(F.lit(SLOTS - 1)).cast("int").alias("slot")).agg(F.count("*").alias("n")).toArrow()
    often = np.zeros(SLOTS, np.int64)
    often[slots["slot"].to_numpy()] = slots["n"].to_numpy()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0).to_numpy(), batch.column(1)
            hashes, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(ids)), sizes)
            hashes = hashes[np.lexsort((hashes, often[hashes & (SLOTS - 1)], row))]
            size = sizes[row]
            at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            kept = at < size - np.ceil(size * least - 1e-9).astype(np.int64) + SHARED
            yield pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in (hashes & KEYS, ids[row], size.astype(np.int32), at.astype(np.int32))], ["key", "id", "size", "at"])

    # Only rows whose bit is set can be among the others; they alone are shuffled.
    some = _marked(hashed, others)
    own = some.filter("NOT hit").unionByName(some.filter("hit").join(others, "id", "left_anti")).select("id", "hashes")
    return own.mapInArrow(first, "key long, id long, size int, at int")


def _candidates(sets: DataFrame, others: DataFrame, block: list[str], least: float) -> DataFrame:
    """(x, y): ids of pairs that may be similar, x of the larger set; every similar pair is among them.

    Sets of m and n tokens with a Jaccard index of at least s share at least c = s / (1 + s) (m + n) tokens, of which the first
    k are among the first m - c + k in any common order. c is at least s m, and at least 2 s / (1 + s) n if n is the smaller.
    """
    prefix, half = _prefixes(sets, others, block, least), least / (1 + least)
    x, y = prefix.toDF("key", "x", "nx", "ix"), prefix.toDF("key", "y", "ny", "iy")
    y = y.filter(F.col("iy") < F.col("ny") - F.ceil(F.col("ny") * F.lit(2 * half) - F.lit(1e-9)) + SHARED)
    larger = F.expr("nx > ny or nx = ny and x < y") & (F.col("ny") >= F.col("nx") * F.lit(least) - F.lit(1e-9))
    shared = (F.col("nx") + F.col("ny")) * F.lit(half) - F.lit(1e-9)
    may = F.least("ix", "iy") + F.least(F.col("nx") - F.col("ix"), F.col("ny") - F.col("iy")) >= shared
    met = x.join(y, "key").filter(larger & may).groupBy("x", "y").agg(F.count("*").alias("n"), F.min(F.ceil(shared)).alias("least"))
    return met.filter(F.col("n") >= F.least(F.lit(SHARED), "least")).select("x", "y")


def _marked(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` with hit: true for every id in ``ids`` and for few others. It is read from a bit map of ids' hashes, so nothing is shuffled."""
    slot = F.xxhash64("id").bitwiseAND(F.lit(BITS - 1))
    each = ids.select(slot.alias("slot"))
    words = each.groupBy(F.floor(F.col("slot") / 32).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 32 as int))")).alias("bits")).toArrow()
    seen = np.zeros(BITS // 32, np.int64)
    seen[words["word"].to_numpy()] = words["bits"].to_numpy()

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("hit").to_numpy()
            yield batch.set_column(batch.num_columns - 1, "hit", pa.array((seen[at // 32] >> (at % 32)) & 1 == 1))

    return rows.withColumn("hit", slot).mapInArrow(mark, rows.withColumn("hit", F.lit(True)).schema)


def similarity(a: Column, b: Column) -> Column:
    """Jaccard index of two token sets; 0 for two empty ones."""
    shared = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - shared
    return F.when(total == 0, 0.0).otherwise(shared / total)


def _similar(sets: DataFrame, others: DataFrame, block: list[str], least: float) -> DataFrame:
    """(block, a, b, x, y, sim) with a < b of similar sets in one block. ``sets`` (id, block, ord, toks) is written, ``others`` (id) don't count."""
    pairs = written(_candidates(sets, others, block, least), "candidates")
    some = written(_marked(sets.select("id", *block, "ord", "toks"), pairs.select(F.explode(F.array("x", "y")).alias("id"))).filter("hit").drop("hit"), "sets")
    # Tokens travel with each pair, so first as two bytes each. What two tokens share as one mark is granted, so no similar pair goes.
    marks = F.array_distinct(F.transform("toks", lambda t: (F.xxhash64(t).bitwiseAND(F.lit(65535)) - 32768).cast("short")))
    brief = some.select("id", F.size("toks").alias("size"), marks.alias("marks"))
    near = pairs.join(brief.toDF("x", "nx", "mx"), "x").join(brief.toDF("y", "ny", "my"), "y")
    shared = F.size(F.array_intersect("mx", "my")) + F.least(F.col("nx") - F.size("mx"), F.col("ny") - F.size("my"))
    near = near.filter(shared >= (F.col("nx") + F.col("ny")) * F.lit(least / (1 + least)) - F.lit(1e-9)).select("x", "y")
    one, two = ({c: f"{side}_{c}" for c in [*block, "ord", "toks"]} | {"id": side} for side in "xy")
    found = near.join(some.withColumnsRenamed(one), "x").join(some.withColumnsRenamed(two), "y").withColumn("sim", similarity(F.col("x_toks"), F.col("y_toks")))
    for c in block:
        found = found.filter(F.col(f"x_{c}") == F.col(f"y_{c}"))
    ends = [F.struct(F.col(f"{side}_ord").alias("ord"), F.col(side).alias("id")) for side in "xy"]
    ordered = F.col("x_ord") < F.col("y_ord")
    a, b = (F.when(ordered, first).otherwise(second) for first, second in (ends, ends[::-1]))
    found = found.filter((F.col("sim") >= least) & (F.col("x_ord") != F.col("y_ord")))
    return found.select(*(F.col(f"x_{c}").alias(c) for c in block), a["ord"].alias("a"), b["ord"].alias("b"), a["id"].alias("x"), b["id"].alias("y"), "sim")


def jaccard_pairs(rows: DataFrame, block: list[str], least: float = LEAST) -> DataFrame:
    """(block, a, b, sim) with a < b of rows (block, ord, toks) in one block whose similarity is at least ``least``.

    Candidates share several of their rarest tokens; each is verified. A token that few rows of a block have is a small group.
    """
    sets = written(rows.filter(F.size("toks") > 0).select(F.monotonically_increasing_id().alias("id"), *block, "ord", "toks"), "sets")
    return _similar(sets, sets.select("id").limit(0), block, least).select(*block, "a", "b", "sim")


def jaccard_classes(rows: DataFrame, block: list[str], least: float = LEAST) -> DataFrame:
    """Similar pairs between classes of rows with equal token sets, by their smallest ord: (block, a, b, sim, n_a, n_b).

    A class of several rows also has a row with itself, of similarity 1. No link is lost and copies aren't expanded. Classes
    are found by SHA-256, so only the token sets of candidates are shuffled.
    """
    sets = rows.filter(F.size("toks") > 0).withColumn("toks", F.sort_array("toks"))
    whole = F.sha2(F.array_join(F.transform("toks", lambda t: F.concat(F.length(t).cast("string"), F.lit(":"), t)), "").cast("binary"), 256)
    sets = written(sets.select(F.monotonically_increasing_id().alias("id"), *block, "ord", F.unhex(whole).alias("digest"), "toks"), "sets")
    same = sets.groupBy(*block, "digest").agg(F.min("ord").alias("ord"), F.count("*").alias("n"), F.min_by("id", F.struct(F.col("ord").isNull(), "ord", "id")).alias("id"))
    same = written(same.filter("n > 1"), "classes")
    member = sets.select("id", *block, "digest").join(same.select(*(F.col(c).alias(f"c_{c}") for c in block), F.col("digest").alias("c_digest"), F.col("id").alias("c_id")), F.expr(" AND ".join(f"{c} <=> c_{c}" for c in [*block, "digest"])))
    others = written(member.filter("id <> c_id").select("id"), "others")
    pairs, sizes = _similar(sets, others, block, least), same.select("id", "n")
    out = pairs.join(sizes.toDF("x", "n_a"), "x", "left").join(sizes.toDF("y", "n_b"), "y", "left")
    own = same.select(*block, F.col("ord").alias("a"), F.col("ord").alias("b"), F.lit(1.0).alias("sim"), F.col("n").alias("n_a"), F.col("n").alias("n_b"))
    one = F.lit(1).cast("long")
    return out.select(*block, "a", "b", "sim", F.coalesce("n_a", one).alias("n_a"), F.coalesce("n_b", one).alias("n_b")).unionByName(own)


def leaf_tokens(leaves: DataFrame) -> DataFrame:
    text = F.concat("bullet_point", F.lit(" "), F.substring("description_source", 1, SIMILAR_CHARS))
    return leaves.select("level1_key", "level2_key", F.col("leaf_ord").alias("ord"), tokens(text, 3).alias("toks"))


def candidate_order(leaves: DataFrame, least: float = LEAST) -> DataFrame:
    """(block_ord, a, b, sim) of similar leaves in one (level1_key, level2_key), blocks by their first leaf."""
    block = ["level1_key", "level2_key"]
    first = leaves.groupBy(*block).agg(F.min("leaf_ord").alias("block_ord"))
    return jaccard_pairs(leaf_tokens(leaves), block, least).join(first, block).select("block_ord", "a", "b", "sim")


def greedy_fold(pairs: Iterator[tuple[int, int]], verify: Callable[[int, int], bool], budget: int) -> list[tuple[int, int]]:
    """(kept, absorbed) in order: pairs with a merged side are skipped and cost nothing, each verification costs one."""
    merged: set[int] = set()
    out, calls = [], 0
    for a, b in pairs:
        if calls >= budget:
            break
        if a in merged or b in merged:
            continue
        calls += 1
        if verify(a, b):
            merged.add(b)
            out.append((a, b))
    return out


def merge_similar(leaves: DataFrame, verify: Callable[[dict, dict], bool] | None, budget: int) -> DataFrame:
    """Leaves after the verified merges: a leaf takes the ids of those it absorbs.

    ``verify`` gets two leaves as dicts and is asked at most ``budget`` times; candidates come to the driver in order, at most
    PAIRS at a time. None (the default provider) verifies nothing.
    """
    if verify is None or budget <= 0:
        return leaves
    spark = leaves.sparkSession
    order = ["block_ord", "a", "b"]
    pairs, facts = candidate_order(leaves).select(*order), ["leaf_ord", "bullet_point", "description_source", "equivalence_allowed"]
    merged: list[tuple[int, int]] = []
    last, asked = None, [0]
    while asked[0] < budget:
        gone = [b for _, b in merged]
        open_pairs = pairs.filter(~F.col("a").isin(gone) & ~F.col("b").isin(gone)) if gone else pairs
        if last:
            open_pairs = open_pairs.filter(F.struct(*order) > F.struct(*(F.lit(v).cast("long").alias(n) for n, v in zip(order, last, strict=True))))
        # A bounded number of pairs at a time, without texts: each partition keeps its first ones.
        some = [(r["block_ord"], r["a"], r["b"]) for r in open_pairs.orderBy(*order).limit(PAIRS).collect()]
        if not some:
            break
        last = some[-1]
        rows = [r.asDict() for r in leaves.select(*facts).filter(F.col("leaf_ord").isin(sorted({x for _, a, b in some for x in (a, b)}))).collect()]
        known = {r["leaf_ord"]: r for r in rows}

        def confirmed(a: int, b: int, known: dict = known) -> bool:
            asked[0] += 1
            return verify(known[a], known[b])

        merged += greedy_fold(((a, b) for _, a, b in some), confirmed, budget - asked[0])
    if not merged:
        return leaves
    table = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(merged)], "keeper long, leaf_ord long, nth long")
    return absorb(leaves, table)


def absorb(leaves: DataFrame, merged: DataFrame) -> DataFrame:
    """``leaves`` after ``merged`` (keeper, leaf_ord, nth): ids in the order of merging, true equivalence passes on.

    Pairs come by their first side, so a keeper is never absorbed later and an absorbed leaf never keeps.
    """
    gone = merged.select("leaf_ord")
    taken = leaves.select("leaf_ord", F.col("chunk_ids").alias("more"), F.col("equivalence_allowed").alias("also")).join(F.broadcast(merged), "leaf_ord")
    grouped = taken.groupBy("keeper").agg(F.sort_array(F.collect_list(F.struct("nth", "more"))).alias("rows"), F.max(F.coalesce("also", F.lit(False))).alias("also"))
    out = leaves.join(F.broadcast(gone), "leaf_ord", "left_anti").join(grouped.withColumnRenamed("keeper", "leaf_ord"), "leaf_ord", "left")
    more = F.coalesce(F.flatten(F.transform("rows", lambda x: x["more"])), F.expr("cast(array() as array<string>)"))
    return out.withColumn("chunk_ids", F.array_union("chunk_ids", more)).withColumn("equivalence_allowed", F.when(F.col("also"), True).otherwise(F.col("equivalence_allowed"))).select(*leaves.columns)


def with_ordinals(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` with leaf_ord from 0 in ``order``, whose first column is the file and whose last is the place in it.

    Places are numbers, so a file's rows are cut by them into ranges of ORDINALS. Rows are numbered within ranges, ranges
    are offset by the sizes of those before them, so neither all rows nor a giant file's rows meet in a task.
    """
    cut = "__docloom_range"
    keys = [*order[:-1], cut]
    dealt = leaves.withColumn(cut, F.floor(F.col(order[-1]) / ORDINALS))
    sizes = dealt.groupBy(*keys).agg(F.count("*").alias("n"))
    files = sizes.groupBy(order[0]).agg(F.sum("n").alias("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.withColumn("within", before(Window.partitionBy(order[0]).orderBy(*keys[1:]))).drop("n").join(files.select(order[0], before(Window.orderBy(order[0])).alias("offset")), order[0])
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order[-1])) - 1
    numbered = dealt.withColumn("leaf_ord", rank.cast("long")).join(offsets, keys)
    return numbered.withColumn("leaf_ord", F.col("leaf_ord") + F.col("within") + F.col("offset")).drop("within", "offset", cut)
