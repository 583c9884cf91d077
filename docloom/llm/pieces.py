"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The vocabulary file gives pieces and log scores; it is read from its wire format and never trained here. White space is the
marker U+2581; a character that no piece covers falls back to byte pieces. No piece holds a marker after another
character, so the best path never crosses from a character into a marker: runs of "markers, then others" are encoded
alone and remembered.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_values, tune

MARK = "▁"
# Fixed values of the model file: piece types, and what an unknown character costs below the lowest score.
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
UNKNOWN_COST = 10.0
CACHE_ENTRIES = 300_000
#: Runs of at most SHORT characters are encoded TOGETHER at a time and remembered; longer ones alone.
SHORT = 40
TOGETHER = 4096
#: Places looked at together for a state's children.
LOOK = 1024


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """(number, value) of a message in the protocol-buffer wire format."""

    def number(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[i] & 127) << shift
            shift += 7
            i += 1
            if data[i - 1] < 128:
                return value, i

    i = 0
    while i < len(data):
        key, i = number(i)
        kind = key & 7
        if kind == 0:
            value, i = number(i)
        else:
            size, i = number(i) if kind == 2 else ({1: 8, 5: 4}[kind], i)
            value = data[i : i + size]
            i += size
        yield key >> 3, value


def read_vocabulary(path: str) -> list[tuple[str, float, int]]:
    """(piece, log score, type) of each id."""
    out = []
    for number, value in _fields(Path(path).read_bytes()):
        if number == 1:
            own = dict(_fields(value))
            out.append((own.get(1, b"").decode(), struct.unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, NORMAL)))
    return out


def double_array(words: list[bytes]) -> tuple[list[int], list[int], list[int]]:
    """(base, check, value) of a trie: the child of state s by byte b is base[s] + b + 1 if check there is s; value is a word's place or -1."""
    order = sorted(range(len(words)), key=words.__getitem__)
    size = 1 << 16
    base, check, value = np.zeros(size, np.int64), np.full(size, -1), np.full(size, -1)
    check[0] = 0
    waiting = [(0, 0, len(order), 0)]  # state, its words in order, depth
    free = crowded = 1
    while waiting:
        state, lo, hi, depth = waiting.pop()
        if lo < hi and len(words[order[lo]]) == depth:
            value[state] = order[lo]
            lo += 1
        children = []
        while lo < hi:
            byte, first = words[order[lo]][depth], lo
            while lo < hi and words[order[lo]][depth] == byte:
                lo += 1
            children.append((byte, first, lo))
        if not children:
            continue
        while check[free] >= 0:
            free += 1
        bytes_ = [b + 1 for b, _, _ in children]
        at = begin = max(0, free - bytes_[0], crowded if len(bytes_) > 1 else 0)
        while True:
            if at + LOOK + 257 >= len(check):
                base, check, value = np.r_[base, np.zeros(size, np.int64)], np.r_[check, np.full(size, -1)], np.r_[value, np.full(size, -1)]
            fits = at + np.flatnonzero(check[at + bytes_[0] : at + bytes_[0] + LOOK] < 0)
            for b in bytes_[1:]:
                fits = fits[check[fits + b] < 0]
            if len(fits):
                at = int(fits[0])
                break
            at += LOOK
        if at - begin > LOOK:
            crowded = at  # families don't look again where there were only single places
        base[state] = at
        for b, first, end in children:
            check[at + b + 1] = state
            waiting.append((at + b + 1, first, end, depth + 1))
    last = int(np.flatnonzero(check >= 0).max()) + 1
    return base[:last].tolist(), check[:last].tolist(), value[:last].tolist()


@dataclass
class Memory:
    """Ids (as little-endian bytes) and scores of runs that were encoded before: those of the last two generations in use."""

    ids: dict[str, bytes] = field(default_factory=dict)
    scores: dict[str, float] = field(default_factory=dict)
    older: tuple[dict[str, bytes], dict[str, float]] = field(default_factory=lambda: ({}, {}))

    def lacking(self, runs: set[str]) -> set[str]:
        """Those of ``runs`` that aren't known; the others are of this generation now."""
        if len(self.ids) > CACHE_ENTRIES:
            self.older, self.ids, self.scores = (self.ids, self.scores), {}, {}
        new = runs - self.ids.keys()
        again = new & self.older[0].keys()
        for kept, old in zip((self.ids, self.scores), self.older, strict=True):
            kept.update(zip(again, map(old.__getitem__, again), strict=True))
        return new - again

    def learn(self, runs: list[str], paths: list[tuple[bytes, float]]) -> None:
        self.ids.update(zip(runs, (p[0] for p in paths), strict=True))
        self.scores.update(zip(runs, (p[1] for p in paths), strict=True))


@dataclass
class Pieces:
    """Encoder and decoder of one vocabulary."""

    vocabulary: list[tuple[str, float, int]]
    trie: tuple[list[int], list[int], list[int]] | None = None
    known: Memory = field(default_factory=lambda: Memory())
    arrays: tuple | None = None

    def __post_init__(self):
        self.ids = [i for i, (_, _, kind) in enumerate(self.vocabulary) if kind in (NORMAL, USER)]
        self.trie = self.trie or double_array([self.vocabulary[i][0].encode() for i in self.ids])
        self.base, self.check, self.value = self.trie
        self.scores = [self.vocabulary[i][1] for i in self.ids]
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(self.vocabulary) if kind == BYTE}
        self.unknown = next((i for i, (_, _, kind) in enumerate(self.vocabulary) if kind == UNKNOWN), 0)
        self.unknown_score = min(self.scores, default=0.0) - UNKNOWN_COST
        apart = not any(MARK in self.vocabulary[i][0].lstrip(MARK) for i in self.ids)
        self.parts = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+") if apart else re.compile("(?s).+")

    def best_path(self, text: str) -> tuple[list[int], float]:
        """Ids and score of the best segmentation; of equal ones the one whose last difference is the longer piece."""
        data = text.encode("utf-8", "replace")
        n = len(data)
        base, check, value, scores = self.base, self.check, self.value, self.scores
        best: list[float | None] = [None] * (n + 1)
        came: list[tuple[int, int]] = [(0, 0)] * (n + 1)
        best[0] = 0.0
        i = 0
        while i < n:
            lead = data[i]
            width = 1 if lead < 128 else 2 if lead < 224 else 3 if lead < 240 else 4
            here, state, j, single = best[i], 0, i, False
            while j < n:
                nxt = base[state] + data[j] + 1
                if nxt >= len(check) or check[nxt] != state:
                    break
                state, j = nxt, j + 1
                v = value[state]
                if v >= 0:
                    total = here + scores[v]
                    if best[j] is None or total > best[j]:
                        best[j], came[j] = total, (i, v)
                    single |= j == i + width
            if not single:
                j, total = i + width, here + self.unknown_score
                if best[j] is None or total > best[j]:
                    best[j], came[j] = total, (i, -1)
            i += width
        return self.walk(data, *zip(*came, strict=True)), best[n] or 0.0

    def walk(self, data: bytes, start: list[int], via: list[int]) -> list[int]:
        """Ids of the path that ends at the end of ``data``; an uncovered character gives its bytes' pieces."""
        out: list[int] = []
        j = len(data)
        while j:
            i, v = start[j], via[j]
            if v >= 0:
                out.append(self.ids[v])
            elif self.bytes:
                out += [self.bytes[b] for b in reversed(data[i:j])]
            else:
                out.append(self.unknown)
            j = i
        return out[::-1]

    def best_paths(self, texts: list[str]) -> list[tuple[bytes, float]]:
        """``best_path`` of many short texts (ids as little-endian bytes, score), all of them one byte further at a time."""
        if self.arrays is None:
            base, check, value = (np.array(x, np.int64) for x in self.trie)
            # A step beyond the table must fail, so it is padded by what a step can reach.
            self.arrays = base, np.r_[check, np.full(300, -1)], value, np.array(self.scores), np.array(self.ids, "<i4")
        base, check, value, scores, ids = self.arrays
        raw = [t.encode("utf-8", "replace") for t in texts]
        sizes = np.array([len(x) for x in raw])
        longest = int(sizes.max())
        data = np.frombuffer(b"".join(x.ljust(longest, b"\0") for x in raw), np.uint8).reshape(len(raw), longest).astype(np.int64)
        width = np.select([data < 128, data < 224, data < 240], [1, 2, 3], 4)
        first = (data & 0xC0) != 0x80
        best = np.full((len(raw), longest + 1), -np.inf)
        best[:, 0] = 0.0
        start, via = np.zeros((2, len(raw), longest + 1), np.int64)

        def offer(rows: np.ndarray, end: np.ndarray | int, total: np.ndarray, i: int, v: np.ndarray | int) -> None:
            better = total > best[rows, end]
            rows, total = rows[better], total[better]
            end, v = (x[better] if isinstance(x, np.ndarray) else x for x in (end, v))
            best[rows, end], start[rows, end], via[rows, end] = total, i, v

        for i in range(longest):
            begun = np.flatnonzero((sizes > i) & first[:, i])
            single = np.zeros(len(raw), bool)
            rows, state = begun, np.zeros(len(begun), np.int64)
            for j in range(i, longest):
                there = sizes[rows] > j
                rows, state = rows[there], state[there]
                nxt = base[state] + data[rows, j] + 1
                ok = check[nxt] == state
                rows, state = rows[ok], nxt[ok]
                if not len(rows):
                    break
                v = value[state]
                hit = v >= 0
                own = rows[hit]
                offer(own, j + 1, best[own, i] + scores[v[hit]], i, v[hit])
                single[own[i + width[own, i] == j + 1]] = True
            lost = begun[~single[begun]]
            offer(lost, i + width[lost, i], best[lost, i] + self.unknown_score, i, -1)
        back, at = [], sizes.copy()
        everyone = np.arange(len(raw))
        while at.any():
            back.append(np.where(at > 0, via[everyone, at], -2))
            at = np.where(at > 0, start[everyone, at], 0)
        path = np.stack(back[::-1], axis=1)  # a text's pieces stand at the end of its row
        counts = (path != -2).sum(axis=1)
        plain = ~(path == -1).any(axis=1)
        numbers = ids[np.maximum(path, 0)]
        ends = best[everyone, sizes].tolist()
        out = []
        for k, (n, simple) in enumerate(zip(counts.tolist(), plain.tolist(), strict=True)):
            out.append((numbers[k, len(back) - n :].tobytes() if simple else np.array(self.walk(raw[k], start[k].tolist(), via[k].tolist()), "<i4").tobytes(), ends[k]))
        return out

    def encode_many(self, texts: list[str]) -> list[tuple[np.ndarray, float]]:
        """(ids, log score) of whole texts, with a marker put before each; an empty text has no ids."""
        known = self.known
        parts = [self.parts.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        new = known.lacking(set(chain.from_iterable(parts)))
        short = sorted((p for p in new if len(p) <= SHORT), key=len)
        for i in range(0, len(short), TOGETHER):
            some = short[i : i + TOGETHER]
            known.learn(some, self.best_paths(some))
        rest = {p: self.best_path(p) for p in new if len(p) > SHORT}
        long_ids = {p: np.array(ids, "<i4").tobytes() for p, (ids, _) in rest.items()}
        out = []
        for own in parts:
            if rest and not rest.keys().isdisjoint(own):
                ids, scores = [long_ids[p] if p in rest else known.ids[p] for p in own], [rest[p][1] if p in rest else known.scores[p] for p in own]
            else:
                ids, scores = map(known.ids.__getitem__, own), map(known.scores.__getitem__, own)
            out.append((np.frombuffer(b"".join(ids), "<i4"), sum(scores)))
        return out

    def encode(self, text: str) -> tuple[np.ndarray, float]:
        return self.encode_many([text])[0]

    def decode(self, ids) -> str:
        """The text of ``ids``: byte pieces are joined to characters, markers are spaces, the first marker goes; control pieces say nothing."""
        raw = b"".join(map(self.surface().__getitem__, ids))
        text = raw.decode("utf-8", "replace").replace(MARK, " ")
        return text.removeprefix(" ")

    def surface(self) -> list[bytes]:
        if not hasattr(self, "_surface"):
            self._surface = [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN else p.encode() for p, _, kind in self.vocabulary]
        return self._surface


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(read_vocabulary(path))


#: One for each Python worker and vocabulary.
_loaded: dict[str, Pieces] = {}


def shipped(path: str):
    """A function that gives a Python worker the vocabulary and trie that the driver has built."""
    own = load(path)
    vocabulary, trie = own.vocabulary, [np.array(x, np.int32) for x in own.trie]

    def get() -> Pieces:
        if path not in _loaded:
            _loaded[path] = Pieces(vocabulary, tuple(x.tolist() for x in trie))
        return _loaded[path]

    return get


def encode_documents(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, score) for every row.

    Null and empty texts have no ids and score 0; repeated rows stay; an empty table gives no rows; other columns are not read.
    """
    tune(df.sparkSession)
    get = shipped(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = get()
        for whole in batches:
            for b in slices(whole, "text", 1 << 20):
                found = pieces.encode_many([x.decode("utf-8", "replace") for x in text_values(b.column("text"))])
                offsets = np.cumsum([0, *(len(x) for x, _ in found)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int32), *(x for x, _ in found)])))
                yield pa.record_batch([b.column("doc_id"), ids, pa.array([s for _, s in found], pa.float64())], names=["doc_id", "ids", "score"])

    kind = dict(df.dtypes)[id_col]
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, ids array<int>, score double")


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """``doc_id``, ids, score of ``encoded`` and their text.

    Null ids give a null text, empty ones an empty text; null doc_ids stay null, repeated rows stay, an empty table gives no
    rows, other columns are not read.
    """
    tune(encoded.sparkSession)
    get = shipped(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = get()
        for b in batches:
            for i in range(0, b.num_rows, 200):
                part = b.slice(i, 200)
                ids = part.column("ids")
                flat, ends = ids.flatten().to_numpy(zero_copy_only=False), np.cumsum(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                begins = [0, *ends.tolist()]
                texts = [pieces.decode(flat[a:e].tolist()) if there else None for a, e, there in zip(begins, ends.tolist(), ids.is_valid().to_pylist(), strict=False)]
                yield pa.record_batch([*part.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "score", "text"])

    kind = dict(encoded.dtypes)["doc_id"]
    return encoded.select("doc_id", "ids", "score").mapInArrow(run, f"doc_id {kind}, ids array<int>, score double, text string")
