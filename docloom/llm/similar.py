"""Exact links between texts by the Jaccard similarity of word shingles, beyond any fingerprint's reach.

Sets of similarity ``t`` or more share at least ``l`` of the first ``n - ceil(t * n) + l`` shingles of each, in any order of all
shingles that is the same for both. Only these prefixes are dealt out, with an ``l`` that grows with the set: a text of
which too few prefix shingles occur anywhere else is done with, whatever passages it shares. The others leave out their
most frequent shingles, as many as keep one in common, and meet in the buckets of the rest. The order puts shingles
that are common in a sample last; what the sample holds changes no result. In a bucket, sizes and bit maps bound the
similarity from above: a bit that one set has and the other lacks is a shingle that they don't share. First, each text is compared shingle by shingle with one that the bound leaves,
beside the pairs that the caller proposes; then every pair that the bound leaves between groups not yet linked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, hash_sample, materialize, slices, text_values, tune
from .components import components
from .shingles import fingerprint, shingle_hashes

WIDTH = 5
#: The least similarity of a pair, as a fraction.
SIMILARITY = (4, 5)
ROW, DIGEST = "__docloom_row", "__docloom_shingles"
#: 64-bit words of a set's bit map: the least power of two with 8 bits for each shingle, within these.
WORDS = (8, 32)
#: Rows of a bucket's parts.
BUCKET_ROWS = 4000
#: A set's ``l``: one for so many shingles, but at least 1.
SHARED = 10
#: Texts whose common shingles go last in the order, and how many of these shingles the driver holds at most.
SAMPLE_DOCS, COMMON = 2000, 50_000
#: Words that are compared at once.
BLOCK_WORDS = 1 << 19


def shingle_set(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted hashes of the text's distinct shingles."""
    return np.unique(shingle_hashes(text, width))


def common_least(n: int, least: tuple[int, int]) -> int:
    """The least ``l`` of a set of ``n`` and of any that is similar enough to it."""
    return max(1, -(-n * least[0] // least[1]) // SHARED)


def prefix(found: np.ndarray, common: np.ndarray, counts: np.ndarray, least: tuple[int, int] = SIMILARITY) -> np.ndarray:
    """The first shingles of a set in the common order; similar sets have ``common_least`` of theirs in common."""
    if not len(found):
        return found
    size = len(found) - -(-len(found) * least[0] // least[1]) + max(1, len(found) // SHARED)
    rank = np.zeros(len(found), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        rank = np.where(common[at] == found, counts[at], 0)
    return found[np.lexsort((found, rank))[:size]]


def bit_map(found: np.ndarray) -> bytes:
    """A bit for the lowest bits of each shingle's hash."""
    words = min(max(WORDS[0], 1 << (len(found) // 8).bit_length()), WORDS[1])
    bits = np.zeros(64 * words, bool)
    bits[(found % np.uint64(64 * words)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


class Maps:
    """Bit maps of a bucket's rows, also folded to the shorter lengths."""

    def __init__(self, maps: list[bytes]):
        self.words = np.array([len(x) // 8 for x in maps])
        longest = int(self.words.max())
        full = np.frombuffer(b"".join(x.ljust(8 * longest, b"\0") for x in maps), np.uint64).reshape(len(maps), longest)
        self.folded = {longest: full}
        while longest > self.words.min():
            half = longest // 2
            both = full[:, :half].copy()
            both[self.words > half] |= full[self.words > half, half:]
            full, longest = both, half
            self.folded[half] = full

    def shared(self, x: int, others: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """At most how many shingles ``others`` share with ``x``."""
        out = np.empty(len(others), np.int64)
        for words in np.unique(self.words[others]).tolist():
            rows = self.folded[min(words, int(self.words[x]))]
            at = np.flatnonzero(self.words[others] == words)
            a, b = rows[x], rows[others[at]]
            lack = [np.bitwise_count(c).sum(axis=1, dtype=np.int64) for c in (a & ~b, b & ~a)]
            out[at] = np.minimum(sizes[x] - lack[0], sizes[others[at]] - lack[1])
        return out


def alike(a: np.ndarray, b: np.ndarray, least: tuple[int, int] = SIMILARITY) -> bool:
    """Whether two shingle sets have the least similarity."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared * least[1] >= (len(a) + len(b) - shared) * least[0]


def possible(maps: Maps, sizes: np.ndarray, x: int, others: np.ndarray, least: tuple[int, int]) -> np.ndarray:
    """Those of ``others`` whose similarity to ``x`` isn't bounded below the least."""
    n, m = sizes[x], sizes[others]
    others = others[np.minimum(n, m) * least[1] >= np.maximum(n, m) * least[0]]
    step, found = BLOCK_WORDS // WORDS[1], []
    for i in range(0, len(others), step):
        part = others[i : i + step]
        shared = maps.shared(x, part, sizes)
        found.append(part[shared * least[1] >= (n + sizes[part] - shared) * least[0]])
    return np.concatenate(found) if found else others


def spanning(rows: np.ndarray, maps: Maps, sizes: np.ndarray, least: tuple[int, int]) -> list[tuple[int, int]]:
    """Possible pairs that span what possible pairs join."""
    left, pairs = np.arange(len(rows)), []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = possible(maps, sizes, x, left, least)
            pairs += [(rows[x], rows[y]) for y in near]
            queue += near.tolist()
            left = np.setdiff1d(left, near, assume_unique=True)
    return pairs


def crossing(rows: np.ndarray, maps: Maps, sizes: np.ndarray, roots: np.ndarray, least: tuple[int, int]) -> list[tuple[int, int]]:
    """All possible pairs of rows with different roots."""
    pairs = []
    for x in range(len(rows) - 1) if (roots != roots[0]).any() else ():
        others = np.arange(x + 1, len(rows))
        pairs += [(rows[x], rows[y]) for y in possible(maps, sizes, x, others[roots[others] != roots[x]], least)]
    return pairs


def bucket_pairs(buckets: DataFrame, pairs: Callable[..., list], least: tuple[int, int]) -> DataFrame:
    """(a, b): what ``pairs`` finds in every bucket of ``buckets`` (h, part, row, n, bits and perhaps root)."""
    names = [c for c in ("n", "root") if c in buckets.columns]
    n = int(buckets.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def cut(table: pa.Table, last: bool) -> tuple[pa.RecordBatch, pa.Table]:
        h, part = table.column("h").to_numpy(), table.column("part").to_numpy()
        begins = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (part[1:] != part[:-1])])
        ends = np.r_[begins[1:], len(h)]
        rows, bits = table.column("row").to_numpy(), table.column("bits").to_pylist()
        columns = [table.column(c).to_numpy() for c in names]
        found = [p for b, e in zip(begins[: len(begins) - (not last)].tolist(), ends.tolist(), strict=False) if e - b > 1 for p in pairs(rows[b:e], Maps(bits[b:e]), *(c[b:e] for c in columns), least)]
        both = np.array(found, np.int64).reshape(-1, 2)
        return pa.record_batch([pa.array(both.min(axis=1)), pa.array(both.max(axis=1))], names=["a", "b"]), table.slice(len(h) if last else begins[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if b.num_rows:
                held.append(b)
                if any(b.column(c)[-1] != held[0].column(c)[0] for c in ("h", "part")):
                    out, rest = cut(pa.Table.from_batches(held), last=False)
                    held = rest.to_batches()
                    yield out
        if held:
            yield cut(pa.Table.from_batches(held), last=True)[0]

    return buckets.repartition(n, "h", "part").sortWithinPartitions("h", "part", "row").mapInArrow(run, "a long, b long").distinct()


def common_shingles(texts: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of shingles that several sampled texts have, and their counts in the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text in text_values(b.column("text")):
                yield pa.record_batch([pa.array(shingle_set(text, width).view(np.int64))], names=["h"])

    counted = hash_sample(texts, SAMPLE_DOCS, F.col("row")).select("text").mapInArrow(run, "h long").groupBy("h").count()
    got = counted.filter("count > 2").orderBy(F.desc("count"), "h").limit(COMMON).toPandas()
    h, counts = got["h"].to_numpy(np.int64).view(np.uint64), got["count"].to_numpy(np.int64)
    order = np.argsort(h)
    return h[order], counts[order]


def distinct_sets(df: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """A written row of ``df``, numbered by ROW, for each shingle set: one with the smallest id, null ids last."""

    @F.arrow_udf("binary")
    def digest(part: pa.Array) -> pa.Array:
        return pa.array([xxhash.xxh3_128_digest(shingle_set(x, width).tobytes()) for x in text_values(part)], pa.binary())

    place = F.struct(F.col(id_col).isNull(), F.col(id_col))
    keyed = df.withColumn(DIGEST, digest(F.col(text_col).cast("string")))
    one = keyed.groupBy(DIGEST).agg(F.min_by(F.struct(*(F.col(f"`{c}`") for c in df.columns)), place).alias("r")).select("r.*")
    return materialize(one.withColumn(ROW, F.monotonically_increasing_id()), "distinct")


def sketches(texts: DataFrame, width: int, least: tuple[int, int]) -> DataFrame:
    """(row, n, fp, bits, prefix) for every row of ``texts`` (row, text)."""
    common, counts = common_shingles(texts, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                hashes = [shingle_hashes(x, width) for x in text_values(b.column("text"))]
                sets = [np.unique(h) for h in hashes]
                prints = np.array([fingerprint(h) for h in hashes], np.uint64).view(np.int64)
                firsts = pa.array([prefix(x, common, counts, least).view(np.int64) for x in sets], pa.list_(pa.int64()))
                columns = [b.column("row"), pa.array(map(len, sets), pa.int64()), pa.array(prints), pa.array(map(bit_map, sets), pa.binary()), firsts]
                yield pa.record_batch(columns, names=["row", "n", "fp", "bits", "prefix"])

    return texts.mapInArrow(run, "row long, n long, fp long, bits binary, prefix array<long>")


def shingle_sets(texts: DataFrame, width: int) -> DataFrame:
    """(row, shingles): the hashes of the shingle set as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                yield pa.record_batch([b.column("row"), pa.array([shingle_set(x, width).tobytes() for x in text_values(b.column("text"))], pa.binary())], names=["row", "shingles"])

    return texts.mapInArrow(run, "row long, shingles binary")


def verified(pairs: DataFrame, texts: DataFrame, width: int, least: tuple[int, int]) -> DataFrame:
    """The written pairs (a, b) whose texts have the least similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            mask = [alike(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), least) for p, q in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(mask, pa.bool_()))

    rows = materialize(pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct(), "compared")
    sets = materialize(shingle_sets(texts.join(rows, "row", "left_semi"), width), "sets")
    a, b = (sets.select(F.col("row").alias(c), F.col("shingles").alias(s)) for c, s in (("a", "x"), ("b", "y")))
    out = materialize(pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "near")
    discard(rows, sets)
    return out


def bucketed(known: DataFrame, least: tuple[int, int], bucket_rows: int) -> DataFrame:
    """(h, parts, row, n, bits): the buckets of shingles in which rows that may be similar meet; see the module's text.

    Aggregates are written before they are joined again on their key, so that a hot shingle's rows can be split.
    """
    each = known.select("row", "n", F.explode("prefix").alias("h"))
    several = materialize(each.groupBy("h").agg(F.count("*").alias("m")).filter("m > 1"), "several")
    needed = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * least[0] / least[1]) / SHARED)).cast("int")
    shared = each.join(several, "h").groupBy("row", "n").agg(F.sort_array(F.collect_list(F.struct("m", "h"))).alias("by")).filter(F.size("by") >= needed)
    kept = F.slice("by", 1, F.size("by") - F.floor((needed - 1) / 2).cast("int"))
    chosen = materialize(shared.select("row", F.explode(kept).alias("k")).select("row", "k.h"), "chosen")
    sizes = materialize(chosen.groupBy("h").agg(F.count("*").alias("m")).filter("m > 1").select("h", F.ceil(F.col("m") / bucket_rows).alias("parts")), "sizes")
    out = materialize(chosen.join(sizes, "h").join(known.select("row", "n", "bits"), "row"), "buckets")
    discard(several, chosen, sizes)
    return out


def links(texts: DataFrame, known: DataFrame, proposed: DataFrame, width: int = WIDTH, least: tuple[int, int] = SIMILARITY, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b): pairs of similar rows of ``texts`` (row, text) that span every group of rows joined by similarity.

    ``known`` has their ``sketches``, ``proposed`` pairs (a, b) to begin with. Rows without words are in no pair.
    """
    buckets = bucketed(known, least, bucket_rows)
    own: Column = F.pmod(F.xxhash64("row"), F.col("parts"))
    first = materialize(bucket_pairs(buckets.withColumn("part", own), spanning, least).groupBy("b").agg(F.min("a").alias("a")).select("a", "b").unionByName(proposed).distinct(), "pairs")
    near = verified(first, texts, width, least)
    roots = materialize(components(near), "roots")
    rooted = materialize(buckets.join(roots.withColumnRenamed("node", "row"), "row", "left").withColumn("root", F.coalesce("root", "row")), "rooted")
    # Buckets of one group have nothing left to find. In the others, every two parts meet.
    mixed = materialize(rooted.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("h"), "mixed")
    met = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda o: F.least(own, o) * F.col("parts") + F.greatest(own, o)))
    others = materialize(bucket_pairs(rooted.join(mixed, "h", "left_semi").withColumn("part", met), crossing, least).join(first, ["a", "b"], "left_anti"), "others")
    more = verified(others, texts, width, least)
    out = materialize(near.unionByName(more), "similar")
    discard(buckets, first, near, roots, rooted, mixed, others, more)
    return out


def similar_links(texts: DataFrame, width: int = WIDTH, least: tuple[int, int] = SIMILARITY, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``links`` of ``texts`` (row, text) without any pairs proposed."""
    tune(texts.sparkSession)
    known = materialize(sketches(texts, width, least), "sketches")
    return links(texts, known, known.select(F.col("row").alias("a"), F.col("row").alias("b")).limit(0), width, least, bucket_rows)
