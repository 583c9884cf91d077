"""Exact removal of repeated strings of a fixed length (``SPAN`` bytes) across a corpus.

1. *Partition the windows.* Every window of SPAN bytes is owned by its leftmost smallest k-gram hash (its anchor), a
   function of the window's content alone. Equal windows have equal anchors at equal offsets, so windows need
   comparing only within an anchor's key. Runs of windows with one anchor make a segment. Segments whose key occurs once
   in the corpus hold no repeat and are never shipped.
2. *Shard transforms.* Segments of a key line up at the anchor, so they are cut into 8-byte symbols on the anchor's grid.
   The segments of a merge come from many source partitions, whose numbers deal them to shards; each shard gets a
   Burrows-Wheeler transform of its own.
3. *Merge by interleave refinement.* The order of all shards' suffixes is refined one symbol at a time through
   the transforms (each round extends every suffix by the symbol before it); no suffix is sorted again. The round in
   which two neighbours part is their common prefix. Runs of neighbours with common prefixes of ``DEPTH`` symbols or more are
   the repeated intervals.
4. *Exact ends.* A window is its aligned suffix's DEPTH symbols and 8 more bytes split between both ends, so within
   a block windows are equal exactly if those 8 bytes are.

Equal segments are one (a segment that occurs twice is repeated as a whole). A key whose distinct segments are more than a
task should merge is split before it is dealt out: its windows are parted by their offset from the anchor into groups of
``WIDTHS[1]``, and each group's key also has a hash of the bytes that all windows of the group hold. Equal windows stay
together, as both are functions of a window's content and place in it. What is still too much is parted again into
groups of ``WIDTHS[2]`` = 2 offsets: those agree in 199 bytes, so at most 2^16 different segments of 201 bytes (13 MB) share a
key, whatever the corpus. All keys, split or not, go through the same merge.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, slices, text_values, tune

SPAN = 200
GRAM = 32
CHOICES = SPAN - GRAM + 1
SYMBOL = 8
DEPTH = SPAN // SYMBOL - 1
#: Window starts handled at once; with the overlap, positions fit POSITION_BITS.
BLOCK = 1 << 17
POSITION_BITS = 18
#: Bytes of distinct segments merged at once, in how many shards; bytes of distinct segments beyond which a key is split.
MERGE_BYTES = 4 << 20
SHARDS = 4
KEY_BYTES = 1 << 18
#: Offsets in a group: all of a key's, then those of a split key, then those of a group that is split again.
WIDTHS = (CHOICES, 13, 2)
#: Columns added to a caller's rows; names that no table has.
ROW, PARTS = "__docloom_row", "__docloom_parts"
#: Signatures that a task remembers so as not to ship equal segments again.
SEEN = 200_000

_mix = np.random.default_rng(20240613)
BYTE_VALUES = _mix.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """64-bit hash of every GRAM bytes, by doubling: the hash of 2m bytes from those of the two halves."""
    h, m, power = BYTE_VALUES[raw], 1, BASE
    while m < GRAM:
        h = h[:-m] * np.uint64(power) + h[m:]
        m, power = 2 * m, power * power % (1 << 64)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    m, w = x, 1
    while 2 * w <= width:
        m = np.minimum(m[:-w], m[w:])
        w *= 2
    return np.minimum(m[: len(m) - (width - w)], m[width - w :]) if w < width else m


def segments(raw: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(key, start, windows, anchor - start) of the segments of texts that lie end to end in ``raw``."""
    low = np.uint64((1 << POSITION_BITS) - 1)
    for at in range(0, len(raw) - SPAN + 1, BLOCK):
        part = raw[at : at + BLOCK + SPAN - 1]
        h = gram_hashes(part)
        least = sliding_least(h & ~low | np.arange(len(h), dtype=np.uint64), CHOICES)
        n = len(least)
        text_end = ends[np.searchsorted(ends, np.arange(at, at + n), side="right")]
        inside = text_end - np.arange(at, at + n) >= SPAN
        begins = np.flatnonzero(np.r_[True, (least[1:] != least[:-1]) | (inside[1:] != inside[:-1]) | (text_end[1:] != text_end[:-1])])
        sizes = np.diff(np.r_[begins, n])
        begins, sizes = begins[inside[begins]], sizes[inside[begins]]
        anchor = (least[begins] & low).astype(np.int64)
        yield h[anchor].view(np.int64), begins + at, sizes, anchor - begins


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``symbols`` by their first 32 symbols; 0 ends a sequence, and what follows it is not looked at."""
    rank, step = symbols.astype(np.int64), 1
    stop = symbols == 0
    while step < 32:
        later = np.zeros_like(rank)
        later[:-step] = rank[step:]
        later[stop] = 0
        pair = rank * (later.max(initial=0) + 1) + later
        rank = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        step *= 2
    return np.argsort(rank, kind="stable")


def transform(symbols: np.ndarray) -> np.ndarray:
    """Burrows-Wheeler transform of 0-ended sequences; the symbol before a sequence's first is 0."""
    before = np.r_[0, symbols[:-1]]
    return before[suffix_order(symbols)]


def dealt_out(symbols: np.ndarray) -> np.ndarray:
    """Stable order of numbers below 2^32: by their low 16 bits, then by the high ones, as short numbers are sorted digit by digit."""
    order = np.argsort(symbols.astype(np.uint16), kind="stable")
    high = symbols >> 16
    return order[np.argsort(high[order].astype(np.uint16), kind="stable")] if high.any() else order


def merge_transforms(transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard of each place, common prefix of each place with the one before, at most ``depth``): the shards' suffixes interleaved.

    Every round takes each place's symbol from its shard's transform and deals the places out by symbol, keeping order.
    Places stay in one block while their symbols and old blocks are equal; a round that parts two neighbours has found
    their common prefix. A place's blocks only ever get smaller, so what parts two places parts them for good. Ends of
    sequences have nothing in common.
    """
    shard = np.repeat(np.arange(len(transforms)), [len(t) for t in transforms])
    ends = np.array([int((t == 0).sum()) for t in transforms])
    head = np.repeat(np.arange(len(transforms)), ends)
    shard, head = shard.astype(np.uint8), head.astype(np.uint8)
    block = np.zeros(len(shard), np.int32)
    common = np.full(len(shard), depth)
    common[: len(head) + 1] = 0
    both = np.concatenate(transforms).astype(np.uint32)
    for done in range(depth):
        # The i-th place of a shard in the order has the i-th symbol of its transform.
        symbol = np.empty(len(shard), np.uint32)
        symbol[np.argsort(shard, kind="stable")] = both
        order = dealt_out(symbol)[len(head) :]  # the suffixes that are an end alone stay in front
        symbol, old = symbol[order], block[order]
        new = np.r_[True, (symbol[1:] != symbol[:-1]) | (old[1:] != old[:-1])] if len(order) else np.empty(0, bool)
        shard = np.r_[head, shard[order]]
        block = np.r_[np.arange(len(head), dtype=np.int32), len(head) + np.cumsum(new, dtype=np.int32)]
        rest = common[len(head) :]
        rest[new & (rest > done)] = done
    return shard, common


def repeated_windows(parts: list[bytes], sizes: np.ndarray, anchors: np.ndarray, sources: np.ndarray) -> list[np.ndarray]:
    """For each distinct segment, which of its windows also start elsewhere in ``parts``; ``sources``: the partitions they come from.

    ``parts`` lie in the order of their shards.
    """
    skips = anchors % SYMBOL  # bytes before the first grid place
    counts = np.array([(len(p) - k) // SYMBOL for p, k in zip(parts, skips.tolist(), strict=True)])
    blocks = b"".join(p[k : k + SYMBOL * c] for p, k, c in zip(parts, skips.tolist(), counts.tolist(), strict=True))
    values, ids = np.unique(np.frombuffer(blocks, "<u8"), return_inverse=True)
    # one 0 after each sequence
    places = np.arange(len(ids)) + np.repeat(np.arange(len(parts)), counts)
    symbols = np.zeros(len(ids) + len(parts), np.int64)
    symbols[places] = ids + 1
    firsts = np.r_[0, np.cumsum(counts + 1)]
    cuts = firsts[np.searchsorted(sources % SHARDS, np.arange(SHARDS + 1))]
    cuts = cuts[np.r_[True, np.diff(cuts) > 0]]
    shards = [symbols[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    orders = [suffix_order(x) for x in shards]
    transforms = [np.r_[0, x[:-1]][o] for x, o in zip(shards, orders, strict=True)]
    shard, common = merge_transforms(transforms, DEPTH)
    block = np.cumsum(common < DEPTH)  # neighbours with DEPTH symbols in common are one interval
    classes = np.empty(len(symbols), np.int64)
    for s, (a, o) in enumerate(zip(cuts, orders, strict=False)):
        classes[a + o] = block[shard == s]
    several = np.bincount(classes, minlength=1) > 1
    # windows: segment, start, grid place at or after the start
    owner = np.repeat(np.arange(len(parts)), sizes)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    shift = (skips[owner] - start) % SYMBOL
    suffix = classes[firsts[owner] + (start + shift - skips[owner]) // SYMBOL]
    maybe = np.flatnonzero(several[suffix])
    out = np.zeros(len(owner), bool)
    if len(maybe):
        text = np.frombuffer(b"".join(parts), np.uint8)
        offsets = np.r_[0, np.cumsum([len(p) for p in parts])]
        at, r = offsets[owner[maybe]] + start[maybe], shift[maybe]
        step = np.arange(SYMBOL)
        ends8 = text[at[:, None] + np.where(step < r[:, None], step, step + SYMBOL * DEPTH)]
        key = np.ascontiguousarray(ends8).view("<u8").ravel()
        group = suffix[maybe] * SYMBOL + r
        order = np.lexsort((key, group))
        k, g = key[order], group[order]
        same = np.r_[False, (k[1:] == k[:-1]) & (g[1:] == g[:-1])]
        out[maybe[order[same | np.r_[same[1:], False]]]] = True
    return np.split(out, np.cumsum(sizes)[:-1])


def _signature(start: int, size: int, data: bytes) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(data, seed=size * SPAN + start)
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def find_segments(keyed: DataFrame) -> DataFrame:
    """(key, rid, start, size, lead) of every segment of ``keyed`` (rid, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                texts = text_values(b.column("text"))
                rids = b.column("rid").to_numpy(zero_copy_only=False)
                ends = np.cumsum([len(x) for x in texts])
                begins = ends - [len(x) for x in texts]
                for key, start, size, lead in segments(np.frombuffer(b"".join(texts), np.uint8), ends):
                    row = np.searchsorted(ends, start, side="right")
                    columns = [pa.array(key), pa.array(rids[row]), pa.array(start - begins[row]), pa.array(size.astype(np.int16)), pa.array(lead.astype(np.int16))]
                    yield pa.record_batch(columns, names=["key", "rid", "start", "size", "lead"])

    return keyed.select("rid", "text").mapInArrow(run, "key long, rid long, start long, size short, lead short")


def pieces(key: int, size: int, lead: int, data: bytes, width: int) -> Iterator[tuple]:
    """(key, at, size, lead, data) of the groups of ``width`` offsets that a segment's windows fall into.

    The window at i has its anchor at offset ``lead`` - i. Those with offsets from ``low`` to ``low + width - 1`` all hold the
    bytes from ``low`` before the anchor to where the one that begins first ends; the group's key takes them in.
    """
    for low in range((lead - size + 1) // width * width, lead + 1, width):
        a, b = max(0, lead - low - width + 1), min(size, lead - low + 1)
        held = data[lead - low : lead - low + SPAN - width + 1]
        own = xxhash.xxh3_64_intdigest(held, seed=(key * CHOICES + low) % (1 << 64))
        yield own - (1 << 64) if own >> 63 else own, a, b - a, lead - a, data[a : b + SPAN - 1]


SEGMENT = "key long, s1 long, s2 long, size short, lead short, source int, data binary"


def cut_segments(keyed: DataFrame, hits: DataFrame) -> DataFrame:
    """The segments in ``hits`` with their bytes: (rid, start) and SEGMENT; data is null where the task shipped it before."""
    lists = hits.groupBy("rid").agg(F.collect_list(F.struct("key", "start", "size", "lead")).alias("parts"))
    names, kinds = _columns("rid long, start long, " + SEGMENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        source = TaskContext.get().partitionId()
        for whole in batches:
            for b in slices(whole, "text", 1 << 20):
                rows, ship = [], 0
                for text, rid, parts in zip(text_values(b.column("text")), b.column("rid").to_pylist(), b.column("parts").to_pylist(), strict=True):
                    for p in parts:
                        start, size, lead = p["start"], p["size"], p["lead"]
                        data = text[start : start + size + SPAN - 1]
                        s = _signature(lead, size, data)
                        if s in seen:
                            data = None
                        else:
                            if len(seen) > SEEN:
                                seen.clear()
                            seen.add(s)
                            ship += len(data)
                        rows.append((rid, start, p["key"], *s, size, lead, source, data))
                        if ship > 4 << 20:
                            yield _table(rows, names, kinds)
                            rows, ship = [], 0
                if rows:
                    yield _table(rows, names, kinds)

    return keyed.select("rid", "text").join(lists, "rid").mapInArrow(run, "rid long, start long, " + SEGMENT)


def _columns(schema: str) -> tuple[list[str], list[pa.DataType]]:
    known = {"long": pa.int64(), "int": pa.int32(), "short": pa.int16(), "binary": pa.binary()}
    names, kinds = zip(*(x.split() for x in schema.split(", ")), strict=True)
    return list(names), [known[k] for k in kinds]


def _table(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def split_segments(hot: DataFrame, width: int) -> DataFrame:
    """SEGMENT for the groups of ``width`` offsets of the segments in ``hot`` (SEGMENT), with the signature (o1, o2) they are of and their place ``at`` there; data is null where the task shipped it before."""
    schema = "o1 long, o2 long, at short, " + SEGMENT
    names, kinds = _columns(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, ship = [], 0
        seen: set = set()
        for b in batches:
            for r in b.to_pylist():
                for key, at, size, lead, data in pieces(r["key"], r["size"], r["lead"], r["data"], width):
                    s = _signature(lead, size, data)
                    if s in seen:
                        data = None
                    else:
                        if len(seen) > SEEN:
                            seen.clear()
                        seen.add(s)
                        ship += len(data)
                    rows.append((r["s1"], r["s2"], at, key, *s, size, lead, r["source"], data))
                if ship > 4 << 20 or len(rows) > 50_000:
                    yield _table(rows, names, kinds)
                    rows, ship = [], 0
        if rows:
            yield _table(rows, names, kinds)

    return hot.mapInArrow(run, schema)


def compare_segments(segments: DataFrame) -> DataFrame:
    """(s1, s2, mask): for each distinct segment of ``segments`` (SEGMENT) that has any, the mask of its repeated windows."""
    n = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = segments.select("key", "s1", "s2", "size", "lead", "source", "data").repartition(n, "key").sortWithinPartitions("key")
    names, kinds = _columns("s1 long, s2 long, mask binary")

    def merged(held: dict) -> Iterator[pa.RecordBatch]:
        if held:
            order = sorted(held.items(), key=lambda x: x[1][2] % SHARDS)
            sizes, anchors, sources = (np.array([v[i] for _, v in order], np.int64) for i in range(3))
            found = repeated_windows([v[3] for _, v in order], sizes, anchors, sources)
            rows = [(*s, np.packbits(m).tobytes()) for (s, _), m in zip(order, found, strict=True) if m.any()]
            if rows:
                yield _table(rows, names, kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: dict = {}  # whole keys that wait for a merge
        group: dict = {}
        total = held_bytes = 0
        key = None
        for b in batches:
            for r in b.to_pylist():
                if r["key"] != key:
                    ready |= group
                    held_bytes += total
                    if held_bytes > MERGE_BYTES:
                        yield from merged(ready)
                        ready, held_bytes = {}, 0
                    group, total, key = {}, 0, r["key"]
                s = (r["s1"], r["s2"])
                if s not in group:
                    group[s] = (r["size"], r["lead"], r["source"], r["data"])
                    total += len(r["data"])
        yield from merged(ready | group)

    return dealt.mapInArrow(run, "s1 long, s2 long, mask binary")


def verdicts(segments: DataFrame, widths: tuple[int, ...], key_bytes: int) -> DataFrame:
    """(s1, s2, mask), written: the repeated windows of each distinct segment of ``segments`` (SEGMENT, data null or not), null for all of them.

    ``widths``: of the groups into which keys with over ``key_bytes`` of distinct segments are split, one level after the other.
    """
    distinct = materialize(segments.groupBy("s1", "s2").agg(F.min("key").alias("key"), F.min("size").alias("size"), F.count("*").alias("n")), "distinct")
    shipped = segments.filter("data is not null").select(*_columns(SEGMENT)[0])
    times = distinct.filter("n > 1").select("s1", "s2", F.lit(True).alias("whole"))
    hot = materialize(distinct.groupBy("key").agg(F.sum(F.col("size") + F.lit(SPAN - 1)).alias("bytes")).filter(F.col("bytes") > key_bytes).select("key"), "hot") if widths else None
    if hot is not None and hot.take(1):
        masks = materialize(compare_segments(shipped.join(hot, "key", "left_anti")), "compared")
        groups = materialize(split_segments(shipped.join(hot, "key", "left_semi").select(*shipped.columns), widths[0]), "groups")
        below = verdicts(groups, widths[1:], key_bytes)
        found = groups.select("o1", "o2", "at", "size", "s1", "s2").join(below, ["s1", "s2"])
        again = found.groupBy(F.col("o1").alias("s1"), F.col("o2").alias("s2")).agg(_whole_mask(F.collect_list(F.struct("at", "size", "mask"))).alias("mask"))
        masks = masks.unionByName(materialize(again, "again"))
    else:
        masks = materialize(compare_segments(shipped), "compared")
    return materialize(masks.join(times, ["s1", "s2"], "full").select("s1", "s2", F.when(F.col("whole").isNull(), F.col("mask")).alias("mask")), "verdict")


def _whole_mask(groups: Column) -> Column:
    """The mask of a segment from those of its groups of windows (at, size, mask; null: all)."""

    @F.arrow_udf("binary")
    def run(lists: pa.Array) -> pa.Array:
        out = []
        for own in lists.to_pylist():
            held = np.zeros(CHOICES, np.uint8)
            for g in own:
                held[g["at"] : g["at"] + g["size"]] |= 1 if g["mask"] is None else np.unpackbits(np.frombuffer(g["mask"], np.uint8), count=g["size"])
            out.append(np.packbits(held).tobytes())
        return pa.array(out, pa.binary())

    return run(groups)


def covered(length: int, parts: list[dict]) -> np.ndarray:
    """Which bytes lie in a repeated window; parts: start, size and mask (null: all) of the segments with repeats."""
    change = np.zeros(length + 1, np.int64)
    for p in parts:
        start, size = p["start"], p["size"]
        if p["mask"] is None:
            change[start] += 1
            change[start + size + SPAN - 1] -= 1
        else:
            at = start + np.flatnonzero(np.unpackbits(np.frombuffer(p["mask"], np.uint8), count=size))
            change[at] += 1
            np.subtract.at(change, at + SPAN, 1)
    return np.cumsum(change[:length]) > 0


def mark_repeats(docs: DataFrame, text_col: str = "text", key_bytes: int = KEY_BYTES) -> tuple[DataFrame, DataFrame]:
    """(keyed, found): the rows of ``docs`` with a row number ROW; and (ROW, PARTS) for the rows with repeats."""
    tune(docs.sparkSession)
    keyed = materialize(docs.withColumn(text_col, F.col(text_col).cast("string")).withColumn(ROW, F.monotonically_increasing_id()), "texts")
    texts = keyed.select(F.col(ROW).alias("rid"), F.col(text_col).alias("text"))
    rows = materialize(find_segments(texts), "segments")
    # Written out, so that the join has an exchange of its own on either side and a hot key's rows can be split.
    again = materialize(rows.groupBy("key").count().filter("count > 1").select("key"), "again")
    cut = materialize(cut_segments(texts, rows.join(again, "key", "left_semi")), "cut")
    discard(rows, again)
    verdict = verdicts(cut, WIDTHS[1:], key_bytes)
    found = cut.select("rid", "start", "size", "s1", "s2").join(verdict, ["s1", "s2"])
    return keyed, found.groupBy(F.col("rid").alias(ROW)).agg(F.collect_list(F.struct("start", "size", "mask")).alias(PARTS))


def removal_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_bytes: int = KEY_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row.

    A byte is removed if a SPAN-byte string that covers it also starts anywhere else in the input, in the same row too;
    overlaps count. Texts are UTF-8 bytes, null is empty, texts under SPAN bytes lose nothing, matches never cross rows.
    Rows with equal texts repeat each other; a null id stays null; an empty table gives no rows; other columns are not read.
    """
    keyed, found = mark_repeats(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text", key_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, parts in zip(text_values(b.column("text")), b.column("parts").to_pylist(), strict=True):
                gone = covered(len(text), parts or [])
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if parts else text
                spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
            columns = [pa.array([r[i] for r in out], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.record_batch([b.column("doc_id"), *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = dict(keyed.dtypes)["doc_id"]
    return keyed.join(found, ROW, "left").select("doc_id", "text", F.col(PARTS).alias("parts")).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, text_col: str = "text", key_bytes: int = KEY_BYTES) -> DataFrame:
    """``docs`` without the repeated bytes of ``text_col``; all rows and other columns stay.

    Where a cut leaves part of a character, that part goes too. A null text stays null, an empty one empty; repeated rows
    lose what they repeat; an empty table stays empty; columns are kept whatever their names are.
    """
    keyed, found = mark_repeats(docs, text_col, key_bytes)

    @F.pandas_udf("string")
    def without(texts: pd.Series, lists: pd.Series) -> pd.Series:
        out = []
        for text, parts in zip(texts, lists, strict=True):
            if text is None or parts is None:
                out.append(text)
                continue
            raw = text.encode()
            out.append(np.frombuffer(raw, np.uint8)[~covered(len(raw), list(parts))].tobytes().decode("utf-8", "ignore"))
        return pd.Series(out)

    return keyed.join(found, ROW, "left").withColumn(text_col, without(F.col(text_col), F.col(PARTS))).select(*(F.col(f"`{c}`") for c in docs.columns))
