"""Document quality from a linear-chain conditional random field over lines.

Every line has two states, bad (0) and good (1). A line's emission score is a linear function of its own features and of
its neighbours'; transitions couple adjacent lines. The weights are fitted on a bounded sample of labelled documents, every
line taking its document's label. A document's score is the mean of its lines' forward-backward marginals of "good",
weighted by line length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, slices, text_values, tune

#: The sample: labelled documents of each class at most, whole ones.
SAMPLE_DOCS = 1500
STEPS = 120
#: Bytes of texts that are scored at once.
TOGETHER = 2 << 20
L2 = 1e-3
#: Marginals pass through a chain; its coupling is bounded so that one line can still differ from its document.
MAX_COUPLING = 3.0

UPPER, LOWERCASE, DIGIT, SYMBOL, BAR, MARK, SPACE, OTHER = range(8)
CLASSES = np.full(256, OTHER, np.uint8)
CLASSES[65:91], CLASSES[97:123], CLASSES[48:58] = UPPER, LOWERCASE, DIGIT
CLASSES[list(b"#*$%&<>@^~=+_\\{}[]")] = SYMBOL
CLASSES[ord("|")] = BAR
CLASSES[list(b"!?")] = MARK
CLASSES[list(b" \t\r\x0b\x0c")] = SPACE
CLASSES[128:] = LOWERCASE
OWN = 14


def line_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(features of each line, line lengths in bytes); an empty text is one empty line."""
    lines = text.split(b"\n")
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    out = np.zeros((len(lines), OWN))
    raw = CLASSES[np.frombuffer(text, np.uint8)] if text else np.empty(0, np.uint8)
    begins = np.r_[0, np.cumsum(sizes + 1)[:-1]]
    safe = np.maximum(sizes, 1)
    for c in range(7):
        if c != LOWERCASE:
            sums = np.r_[0, np.cumsum(raw == c)]
            out[:, c] = (sums[begins + sizes] - sums[begins]) / safe
    seen = set()
    for i, line in enumerate(lines):
        words = line.split()
        n = len(words)
        if n:
            out[i, LOWERCASE] = n / (5 + n)
            out[i, 7] = 1 - len(set(words)) / n if n > 3 else 0.0
            # Pairs of words: unlike single words, a long line of ordinary text repeats few of them.
            out[i, 13] = 1 - len(set(zip(words, words[1:], strict=False))) / (n - 1) if n > 3 else 0.0
            out[i, 8] = min(sizes[i] / n, 30) / 10
            out[i, 9] = min(1.0, (line.count(b".") + line.count(b",")) / n)
            out[i, 10] = line in seen
            out[i, 11] = sum(w == v for w, v in zip(words, words[1:], strict=False)) / n
            seen.add(line)
        else:
            out[i, 12] = 1.0
    return out, sizes


def with_neighbours(own: np.ndarray, place: np.ndarray | None = None) -> np.ndarray:
    """A line's features, the previous and the next line's, and a constant; zeros beyond the ends of a document.

    ``place``: each line's place in its document, from 0; without it all lines are one document's.
    """
    n, k = own.shape
    out = np.zeros((n, 3 * k + 1))
    out[:, :k], out[:, -1] = own, 1.0
    if n > 1:
        out[1:, k : 2 * k], out[:-1, 2 * k : 3 * k] = own[:-1], own[1:]
        if place is not None:
            out[place == 0, k : 2 * k] = 0.0
            out[np.r_[place[1:] == 0, True], 2 * k : 3 * k] = 0.0
    return out


def places(counts: np.ndarray) -> np.ndarray:
    """Each line's place in its document, for documents of so many lines that lie end to end."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def messages(emitted: np.ndarray, place: np.ndarray, a: float) -> np.ndarray:
    """What the lines before tell each line: log-odds of "good", over all documents at once.

    A line carries (good, bad) on by a 2 x 2 matrix. Products of the matrices up to each line come by doubling: after k
    rounds a line has the product over 2^k lines. What lies beyond a document's first line isn't taken in.
    """
    total = np.zeros(len(emitted))
    inner = np.flatnonzero(place > 0)
    if not len(inner):
        return total
    x = np.exp(np.clip(emitted, -30, 30))
    m = np.stack([a * x, np.ones_like(x), x, np.full_like(x, a)], axis=1)
    m /= m.max(axis=1, keepdims=True)
    step, longest = 1, int(place.max())
    while step < longest:
        # A line's product ends with its own matrix; the document's last line hands nothing on, but that does no harm.
        at = np.flatnonzero(place >= step)
        p, q = m[at], m[at - step]
        new = np.stack([p[:, 0] * q[:, 0] + p[:, 1] * q[:, 2], p[:, 0] * q[:, 1] + p[:, 1] * q[:, 3], p[:, 2] * q[:, 0] + p[:, 3] * q[:, 2], p[:, 2] * q[:, 1] + p[:, 3] * q[:, 3]], axis=1)
        m[at] = new / new.max(axis=1, keepdims=True)
        step *= 2
    before = m[inner - 1]
    total[inner] = np.log(before[:, 0] + before[:, 1]) - np.log(before[:, 2] + before[:, 3])
    return total


def both_ways(emitted: np.ndarray, counts: np.ndarray, a: float) -> tuple[np.ndarray, np.ndarray]:
    """(messages from the lines before, from the lines after)."""
    place = places(counts)
    back = places(counts[::-1])
    return messages(emitted, place, a), messages(emitted[::-1], back, a)[::-1]


@dataclass(frozen=True)
class ChainModel:
    weights: np.ndarray  # of the emission score of "good"
    coupling: float  # added for two adjacent equal states

    def marginals(self, own: np.ndarray, counts: np.ndarray | None = None) -> np.ndarray:
        """P(good) of every line of documents of ``counts`` lines that lie end to end (one document by default)."""
        counts = np.array([len(own)]) if counts is None else counts
        emitted = np.clip(with_neighbours(own, places(counts)) @ self.weights, -30, 30)
        ahead, behind = both_ways(emitted, counts, float(np.exp(self.coupling)))
        return 1 / (1 + np.exp(-np.clip(emitted + ahead + behind, -60, 60)))

    def scores(self, texts: list[bytes]) -> list[float]:
        """Each text's mean of its lines' marginals, weighted by their length."""
        if not texts:
            return []
        found = [line_features(x) for x in texts]
        counts = np.array([len(sizes) for _, sizes in found])
        weight = np.concatenate([sizes for _, sizes in found]) + 1.0
        good = self.marginals(np.concatenate([own for own, _ in found]), counts) * weight
        begins = np.cumsum(counts) - counts
        return np.clip(np.add.reduceat(good, begins) / np.add.reduceat(weight, begins), 0.0, 1.0).tolist()

    def score(self, text: bytes) -> float:
        return self.scores([text])[0]


def fit(samples: list[tuple[int, np.ndarray]]) -> ChainModel:
    """Maximum-likelihood weights by Adam; samples: (label, features of all lines). One class or none gives scores of 0.5."""
    labels = np.array([y for y, _ in samples])
    if len(set(labels.tolist())) < 2:
        return ChainModel(np.zeros(3 * OWN + 1), 0.0)
    counts = np.array([len(x) for _, x in samples])
    place = places(counts)
    features = with_neighbours(np.concatenate([x for _, x in samples]), place).astype(np.float32)
    each = np.where(labels == 1, 0.5 / (labels == 1).mean(), 0.5 / (labels == 0).mean()) / counts / len(samples)
    share, target = np.repeat(each, counts), np.repeat(labels, counts)
    later = np.flatnonzero(place > 0)
    weights, coupling = np.zeros(3 * OWN + 1), 0.5
    moments = np.zeros((2, len(weights) + 1))
    for step in range(1, STEPS + 1):
        emitted = np.clip(features @ weights.astype(np.float32), -30, 30).astype(float)
        a = np.exp(coupling)
        ahead, behind = both_ways(emitted, counts, a)
        gap = (target - 1 / (1 + np.exp(-np.clip(emitted + ahead + behind, -60, 60)))) * share
        # P(equal neighbours) from the pair's four states
        u, v = np.exp(np.clip((emitted + ahead)[later - 1], -30, 30)), np.exp(np.clip((emitted + behind)[later], -30, 30))
        same = a * (u * v + 1) / (a * (u * v + 1) + u + v)
        slope = np.append(gap.astype(np.float32) @ features - L2 * weights, ((1 - same) * share[later]).sum())
        moments[0] = 0.9 * moments[0] + 0.1 * slope
        moments[1] = 0.99 * moments[1] + 0.01 * slope**2
        move = 0.2 * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        weights, coupling = weights + move[:-1], float(np.clip(coupling + move[-1], 0, MAX_COUPLING))
    return ChainModel(weights, coupling)


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 3; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", held_out: int = 1) -> ChainModel:
    """Fit on at most ``SAMPLE_DOCS`` labelled documents of each class whose fold isn't ``held_out``, the first by a hash of the id.

    Labels other than 0 and 1, null ids and null labels are left out. A label row repeated or an id repeated in ``docs``
    is one sample for each pair of rows. Without labels of both classes all scores are 0.5.
    """
    usable = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).filter((fold("id") != held_out) & F.col("y").isin(0, 1))
    picked = hash_sample(usable.filter("y = 0"), SAMPLE_DOCS, F.col("id")).unionByName(hash_sample(usable.filter("y = 1"), SAMPLE_DOCS, F.col("id")))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sample = texts.join(F.broadcast(picked.select("id", "y")), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [line_features(x)[0].astype(np.float32).tobytes() for x in text_values(b.column("text"))]
            yield pa.record_batch([b.column("id"), b.column("y").cast(pa.int64()), pa.array(found, pa.binary())], names=["id", "y", "features"])

    kind = dict(docs.dtypes)[id_col]
    rows = sample.mapInArrow(run, f"id {kind}, y long, features binary").collect()  # bounded by SAMPLE_DOCS, 56 bytes for a line
    rows.sort(key=lambda r: (str(r["id"]), bytes(r["features"])))
    return fit([(r["y"], np.frombuffer(r["features"], np.float32).reshape(-1, OWN).astype(float)) for r in rows])


def score_column(model: ChainModel, text: Column) -> Column:
    """Score of every text, 0 to 1; null as empty."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        raw = [(x or "").encode("utf-8", "replace") for x in texts]
        cuts = np.flatnonzero(np.diff([0, *np.cumsum([len(x) for x in raw]) // TOGETHER])).tolist()
        return pd.Series([s for b, e in zip([0, *cuts], [*cuts, len(raw)], strict=True) for s in model.scores(raw[b:e])], dtype="float64")

    return score(F.coalesce(text.cast("string"), F.lit("")))


def score_documents(docs: DataFrame, model: ChainModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row.

    Null and empty texts get the score of one empty line; a null id isn't held out; repeated rows stay; an empty table
    gives no rows; other columns are not read.
    """
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", TOGETHER):
                found = model.scores(text_values(b.column("text")))
                yield pa.record_batch([b.column("doc_id"), b.column("held_out"), pa.array(found, pa.float64())], names=["doc_id", "held_out", "score"])

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(fold(id_col) == 1, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    scored = rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is at least 0.5.

    Null texts are scored as empty ones, null and repeated ids and repeated rows are scored like any others; an empty table
    stays empty. No column is added, so none can clash.
    """
    tune(docs.sparkSession)
    model = train(docs, labels, id_col, text_col)
    return docs.filter(score_column(model, F.col(text_col)) >= 0.5)
