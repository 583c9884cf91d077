"""Quality rules from repetition inside a document, by suffix arrays over its words.

A batch of documents shares one suffix array: a document's words are numbered apart from other documents' and each
document ends with a number of its own, so no common prefix crosses documents. Prefix doubling sorts only what is still
tied. Common prefixes of neighbours come from the kept ranks of every doubling.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_values, tune

WINDOW = 8
MIN_WORDS = 20
BASE_PERCENT = 30
#: The method's limits: share of the words' characters in repeated substrings, and words of the longest repeat.
MAX_COVERED = 0.3
MAX_REPEAT = 100
SYMBOLS = b"#*$%&|<>"


def word_numbers(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, ends): words of each document as numbers of its own, followed by an end number of its own."""
    known: dict[bytes, int] = {}
    flat = [known.setdefault(w, len(known)) for words in texts for w in words]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    document = np.repeat(np.arange(len(texts)), sizes)
    numbers = np.empty(len(flat) + len(texts), np.int64)
    ends = np.cumsum(sizes + 1) - 1
    at = np.arange(len(flat)) + document
    numbers[at] = document * (len(known) + 1) + np.array(flat, np.int64)
    numbers[ends] = np.arange(len(texts)) * (len(known) + 1) + len(known)
    return numbers, ends


def suffix_ranks(numbers: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... numbers; equal rank: equal so far. The last has no ties."""
    n = len(numbers)
    order = np.argsort(numbers, kind="stable")
    new = np.r_[True, numbers[order[1:]] != numbers[order[:-1]]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    ranks, step = [rank], 1
    tied = order[~(new & np.r_[new[1:], True])]
    while len(tied):
        # A tied suffix has `step` equal numbers, so what follows them lies inside its document.
        first, second = rank[tied], rank[tied + step]
        order = np.lexsort((second, first))
        tied, first, second = tied[order], first[order], second[order]
        group = np.r_[True, first[1:] != first[:-1]]
        new = group | np.r_[True, second[1:] != second[:-1]]
        place = np.arange(len(tied))
        inside = place - np.maximum.accumulate(np.where(group, place, 0))
        rank = rank.copy()
        rank[tied] = first + inside[np.maximum.accumulate(np.where(new, place, 0))]
        ranks.append(rank)
        tied = tied[~(new & np.r_[new[1:], True])]
        step *= 2
    return ranks


def common_prefixes(ranks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, common prefix of each suffix in it with the one before)."""
    n = len(ranks[-1])
    order = np.empty(n, np.int64)
    order[ranks[-1]] = np.arange(n)
    a, b = order[:-1].copy(), order[1:].copy()
    total = np.zeros(max(n - 1, 0), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        same = ranks[level][np.minimum(a, n - 1)] == ranks[level][np.minimum(b, n - 1)]
        same &= (a < n) & (b < n)
        total += same * (1 << level)
        a += same * (1 << level)
        b += same * (1 << level)
    return order, np.r_[0, total]


def repeats(numbers: np.ndarray) -> np.ndarray:
    """For each place the longest string from there that occurs again: the widest common-prefix interval it lies in."""
    if not len(numbers):
        return np.empty(0, np.int64)
    order, shared = common_prefixes(suffix_ranks(numbers))
    longest = np.empty(len(numbers), np.int64)
    longest[order] = np.maximum(shared, np.r_[shared[1:], 0])
    return longest


def union(longest: np.ndarray, least: int) -> np.ndarray:
    """Places that lie in a repeated string of at least ``least``: the union of the maximal repeats' spans."""
    starts = np.flatnonzero(longest >= least)
    change = np.bincount(starts, minlength=len(longest) + 1) - np.bincount(starts + longest[starts], minlength=len(longest) + 1)
    return np.cumsum(change[:-1]) > 0


def measure(texts: list[bytes]) -> Iterator[tuple]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered share, longest repeat) of each text."""
    words = [x.split() for x in texts]
    numbers, ends = word_numbers(words)
    longest = repeats(numbers)
    inside = union(longest, WINDOW)
    begins = np.r_[0, ends[:-1] + 1]
    for text, own, b, e in zip(texts, words, begins.tolist(), ends.tolist(), strict=True):
        chars = np.fromiter((len(w) for w in own), np.int64, len(own)) if text.isascii() else np.fromiter((len(w.decode("utf-8", "replace")) for w in own), np.int64, len(own))
        total = int(chars.sum())
        lines: set[bytes] = set()
        twice = 0
        for line in text.split(b"\n"):
            if line.strip():
                twice += line in lines
                lines.add(line)
        covered = inside[b:e]
        share = float(chars[covered].sum() / total) if total else 0.0
        yield len(own), total, sum(text.count(c) for c in SYMBOLS), twice, int(covered.sum()), share, int(longest[b:e].max(initial=0))


def rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, covered, longest_repeat) for every row.

    base_failed: fewer than MIN_WORDS words, or over BASE_PERCENT % of them in WINDOW-word windows that occur twice. kept:
    not base_failed, at most MAX_COVERED of the words' characters in repeats, and no repeat over MAX_REPEAT words. Null and
    empty texts have zeros and fail; repeated rows stay; an empty table gives no rows; other columns are not read.
    """
    tune(df.sparkSession)
    kinds = (*(pa.int64(),) * 5, pa.float64(), pa.int64())
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered", "longest_repeat"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", 2 << 20):
                rows = list(measure(text_values(b.column("text"))))
                yield pa.record_batch([b.column("doc_id"), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], names=["doc_id", *names])

    kind = dict(df.dtypes)[id_col]
    measured = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} {'double' if n == 'covered' else 'long'}" for n in names))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > BASE_PERCENT * F.col("n_words"))
    kept = ~F.col("base_failed") & (F.col("covered") <= MAX_COVERED) & (F.col("longest_repeat") <= MAX_REPEAT)
    return measured.withColumn("base_failed", failed).withColumn("kept", kept).select("doc_id", *names[:5], "base_failed", "kept", *names[5:])
