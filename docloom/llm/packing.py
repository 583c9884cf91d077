"""Best-fit-decreasing packing of token sequences, exact over the whole corpus.

A document's ids (with a closing id) are cut into full windows and one rest. Every piece of one length is
interchangeable for best-fit-decreasing, so the plan is made from the histogram of lengths: at most ``window``
numbers reach the driver, whatever the corpus. A segment tree indexed by remaining capacity finds the tightest
open window. Groups of windows with equal contents stay one entry with a count, so the plan has a few entries
for each length. Pieces then take their slot by their rank among pieces of their length.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, slices, text_values, tune

#: Pre-token strings whose ids a Python worker remembers.
CACHE_ENTRIES = 300_000
#: Pieces of one length that are ranked in one group.
RANK_ROWS = 512
#: Where a part begins; slower than splitting at spaces, but not for parts beyond so many characters.
PART = re.compile(r"(?= \S)")
LONG_PART = 4096


@lru_cache(maxsize=2)
def byte_bpe(path: str):
    """(encoder of a byte-level BPE file of the tokenizers library, ids of its added tokens by their strings)."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    vocabulary = content["model"]["vocab"]
    added = content.get("added_tokens") or []
    if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that look at what stands beside them aren't supported")
    # Byte-level files spell bytes as printable characters: these keep themselves, the others follow from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spelled = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    spelled |= {chr(256 + i): b for i, b in enumerate(rest)}
    ranks = {}
    for piece, rank in vocabulary.items():
        if all(c in spelled for c in piece):
            ranks[bytes(spelled[c] for c in piece)] = rank
    return tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), {t["content"]: t["id"] for t in added}


class Known(dict):
    """Ids of parts that were encoded before; others are encoded, and remembered if they are short.

    tiktoken's pattern matcher overflows its stack on long runs of white space, so long parts are left to tokenizers.
    """

    def __init__(self, path: str, encoder):
        super().__init__()
        self.path, self.encoder, self.library = path, encoder, None

    def whole(self, part: str) -> bytes:
        if len(part) > LONG_PART:
            if self.library is None:
                import tokenizers

                self.library = tokenizers.Tokenizer.from_file(self.path)
            return np.array(self.library.encode(part, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return np.array(self.encoder.encode_ordinary(part), dtype="<u4").tobytes()

    def __missing__(self, part: str) -> bytes:
        ids = self.whole(part)
        if len(part) < 64:
            self[part] = ids
        return ids


class Tokenizer:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    Added tokens in a text are cut out first, as the library does, the leftmost and then the longest. In the rest, the
    pre-tokenizer never joins text across a space that a visible character follows, so the parts between such spaces are
    encoded alone and remembered; the memory is emptied at ``CACHE_ENTRIES``.
    """

    def __init__(self, path: str):
        encoder, added = byte_bpe(path)
        self.known = Known(path, encoder)
        self.added = {k: np.array([v], dtype="<u4").tobytes() for k, v in added.items() if k}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None

    def parts(self, text: str) -> list[str]:
        cut = text.split(" ")
        out = [cut[0]]
        for x in cut[1:]:
            if x and not x[0].isspace():
                out.append(" " + x)
            else:
                out[-1] += " " + x
                if len(out[-1]) > LONG_PART:
                    return PART.split(text)  # a part that grows is copied at each step
        return out

    def part(self, text: str) -> bytes:
        """Ids of a text without added tokens, encoded in one go and not remembered."""
        return self.known.whole(text)

    def encode(self, text: str) -> bytes:
        if self.cut and self.cut.search(text):
            return b"".join(self.added[x] if x in self.added else self.plain(x) for x in self.cut.split(text) if x)
        return self.plain(text)

    def plain(self, text: str) -> bytes:
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        return b"".join(map(self.known.__getitem__, self.parts(text)))


#: One for each Python worker, kept from task to task.
_tokenizers: dict[str, Tokenizer] = {}

PIECES = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long"


def cut_documents(df: DataFrame, id_col: str, text_col: str, path: str, window: int, end_id: int) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) of every piece."""
    closing = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _tokenizers:
            _tokenizers[path] = Tokenizer(path)
        tokenizer = _tokenizers[path]
        for whole in batches:
            for batch in slices(whole, "text"):
                rows, starts, lengths, sums, totals = [], [], [], [], []
                for i, raw in enumerate(text_values(batch.column("text"))):
                    ids = tokenizer.encode(raw.decode("utf-8", "replace")) + closing
                    n = len(ids) // 4
                    for s in range(0, n, window):
                        piece = ids[4 * s : 4 * (s + window)]
                        rows.append(i)
                        starts.append(s)
                        lengths.append(len(piece) // 4)
                        sums.append(zlib.crc32(piece))
                        totals.append(n)
                yield pa.record_batch(
                    [batch.column("doc_id").take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals))],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
                )

    kind = dict(df.dtypes)[id_col]
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, PIECES.format(id=kind))


class CapacityTree:
    """Segment tree over remaining capacities 0..size: how many open groups there are from each on."""

    def __init__(self, size: int):
        self.width = 1 << size.bit_length()
        self.count = [0] * (2 * self.width)

    def add(self, capacity: int, by: int) -> None:
        i = capacity + self.width
        while i:
            self.count[i] += by
            i >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least ``least`` that has an open group."""
        i = least + self.width
        if self.count[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.count[i + 1]:
                i += 1
                while i < self.width:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.width
            i >>= 1
        return None


def best_fit_decreasing(counts: dict[int, int], window: int) -> dict[str, np.ndarray]:
    """Slots for ``counts`` pieces of each length in windows of ``window``.

    A slot row gives, for pieces of ``length`` with ranks from ``rank`` on, ``each`` pieces in each of ``windows``
    sequences that begin at ``sequence``, the first at ``offset``; ``used`` is the sequence's total.
    """
    tree = CapacityTree(window)
    open_groups: dict[int, list] = {}
    done = []

    def keep(group: list) -> None:
        left = group[1]
        if left:
            open_groups.setdefault(left, []).append(group)
            tree.add(left, 1)
        else:
            done.append(group)

    def part(group: list, n: int) -> list:
        """Take the first ``n`` windows out of ``group``."""
        taken = [n, group[1], [(length, each, rank, offset) for length, each, rank, offset in group[2]]]
        group[0] -= n
        group[2] = [(length, each, rank + n * each, offset) for length, each, rank, offset in group[2]]
        return taken

    for length in sorted(counts, reverse=True):
        need, rank = counts[length], 0
        while need:
            capacity = tree.tightest(length)
            if capacity is None:
                each = window // length
                group = [-(-need // each), window, []]
            else:
                group = open_groups[capacity].pop()
                tree.add(capacity, -1)
                each = capacity // length
            full = min(group[0], need // each)
            if full:
                filled = part(group, full) if full < group[0] else group
                filled[2].append((length, each, rank, window - filled[1]))
                filled[1] -= each * length
                keep(filled)
                need -= full * each
                rank += full * each
                if filled is group:
                    continue
            if need and need < each:
                last = part(group, 1) if group[0] > 1 else group
                last[2].append((length, need, rank, window - last[1]))
                last[1] -= need * length
                keep(last)
                rank += need
                need = 0
                if last is group:
                    continue
            keep(group)
    rows, sequence = [], 0
    for n, left, runs in [*done, *(g for k in sorted(open_groups) for g in open_groups[k])]:
        if runs:
            rows += [(length, rank, each, n, sequence, offset, window - left) for length, each, rank, offset in runs]
            sequence += n
    rows.sort()
    names = ("length", "rank", "each", "windows", "sequence", "offset", "used")
    return {k: np.array([r[i] for r in rows], dtype=np.int64) for i, k in enumerate(names)}


def pack(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = 2048, end_id: int = 1) -> DataFrame:
    """Pack whole documents into sequences of at most ``window`` tokens.

    Each document's ids are followed by ``end_id``. One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id (gapless from 0), offset, sequence_tokens and padded_length (``window``, or sequence_tokens where that is
    a power of two). Null and empty texts give one piece with ``end_id`` alone; repeated ids and rows are pieces of
    their own; a null id stays null. An empty table gives no rows. Other columns of ``df`` are not read.
    """
    tune(df.sparkSession)
    # Numbered where they are written: rows of one id, null or not, are dealt out like any others.
    pieces = materialize(cut_documents(df, id_col, text_col, tokenizer_path, window, end_id).withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `window` rows
    plan = best_fit_decreasing(counts, window)
    buckets = max(1, -(-max(counts.values(), default=1) // RANK_ROWS))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    order = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n")).select("length", "bucket", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("row")
    ranked = dealt.join(before.hint("merge"), ["length", "bucket"]).withColumn("rank", F.col("before") + F.row_number().over(within) - 1).drop("bucket", "before", "row")
    key_base = np.int64(1) << 40
    keys = plan["length"] * key_base + plan["rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(k).to_numpy(zero_copy_only=False) for k in ("length", "rank"))
            slot = np.searchsorted(keys, length * key_base + rank, side="right") - 1
            nth = rank - plan["rank"][slot]
            each, used = plan["each"][slot], plan["used"][slot]
            sequence = plan["sequence"][slot] + nth // each
            offset = plan["offset"][slot] + nth % each * length
            padded = np.where(used & (used - 1) == 0, used, window)
            columns = [b.column(k) for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.record_batch(
                [*columns, *(pa.array(x, pa.int64()) for x in (sequence, offset, used, padded))],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "padded_length"],
            )

    kind = dict(df.dtypes)[id_col]
    return ranked.mapInArrow(place, PIECES.format(id=kind) + ", sequence_id long, offset long, sequence_tokens long, padded_length long")
