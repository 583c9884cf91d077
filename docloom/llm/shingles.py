"""Word shingles of texts, and their fingerprint."""

from __future__ import annotations

import numpy as np
import xxhash

SEED = 42
BITS = 64
#: Shingles whose bits are counted at once.
COUNT_ROWS = 1 << 16
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_hashes(text: bytes, width: int = 3) -> np.ndarray:
    """XXH64 of every shingle of ``width`` words, repeats included; of the whole sequence if there are fewer words."""
    words = text.translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    begins = (ends - sizes)[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    found = [digest(joined[b:e], SEED) for b, e in zip(begins, (ends[width - 1 :] - 1).tolist(), strict=True)]
    return np.array(found, np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is set in over half of the shingle hashes; zero without any."""
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), COUNT_ROWS):
        part = np.ascontiguousarray(hashes[i : i + COUNT_ROWS])
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])
