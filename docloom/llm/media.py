"""Media columns: PNG files in binary columns, written and read without an imaging library."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_values, tune

# Fixed values of the PNG format.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
SAMPLES = {0: 1, 2: 3, 4: 2, 6: 4}

#: 192 grey pixels: text filters better by single bytes than by threes.
ROW_BYTES = 192
GREY = 0
#: Samples that are unfiltered at once.
TOGETHER = 4 << 20
HASH_SIDE = 32
HASH_LOW = 8


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def predictions(left: np.ndarray, up: np.ndarray, corner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What filters 3 (average) and 4 (Paeth) expect of samples, from int16 neighbours."""
    ahead, beside = up - corner, left - corner
    near_left, near_up, near_corner = np.abs(ahead), np.abs(beside), np.abs(ahead + beside)
    nearest = np.where((near_left <= near_up) & (near_left <= near_corner), left, np.where(near_up <= near_corner, up, corner))
    return left + up >> 1, nearest


def filtered(rows: np.ndarray, first: np.ndarray, step: int, filters: np.ndarray | None = None) -> np.ndarray:
    """Filtered ``rows`` of pictures that lie end to end, with the filter's number in front; ``first``: whether a row begins a picture.

    Without ``filters`` each row takes the one whose differences, as signed bytes, have the least absolute sum; the
    lower number if several have.
    """
    wide = rows.astype(np.int16)
    left, up = np.zeros_like(wide), np.zeros_like(wide)
    left[:, step:] = wide[:, :-step]
    up[1:] = wide[:-1]
    up[first] = 0
    corner = np.zeros_like(wide)
    corner[:, step:] = up[:, :-step]
    average, nearest = predictions(left, up, corner)
    out = np.zeros((len(rows), rows.shape[1] + 1), np.uint8)
    least = np.full(len(rows), np.iinfo(np.int64).max)
    for kind, expected in enumerate((0, left, up, average, nearest)):
        coded = (wide - expected).astype(np.uint8)
        if filters is None:
            cost = np.abs(coded.view(np.int8).astype(np.int16)).sum(axis=1, dtype=np.int64)
            chosen = cost < least
            least[chosen] = cost[chosen]
        else:
            chosen = filters == kind
        out[chosen, 0], out[chosen, 1:] = kind, coded[chosen]
    return out


def packed(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 15, 9)
    return packer.compress(data) + packer.flush()


def encode_pngs(pictures: list[bytes], width: int, colour: int = 2, level: int = 4, filters: np.ndarray | None = None) -> list[bytes]:
    """PNG of each picture's 8-bit samples. ``filters``: the filter of each row of all pictures; chosen by row if there are none."""
    stride = width * SAMPLES[colour]
    heights = np.array([len(x) // stride for x in pictures], np.int64)
    if any(not x or len(x) % stride for x in pictures):
        raise ValueError("samples must fill whole rows, at least one")
    if not pictures:
        return []
    rows = np.frombuffer(b"".join(pictures), np.uint8).reshape(-1, stride)
    ends = np.cumsum(heights)
    first = np.zeros(len(rows), bool)
    first[ends - heights] = True
    coded, out = filtered(rows, first, SAMPLES[colour], filters), []
    for n, end in zip(heights.tolist(), ends.tolist(), strict=True):
        header = struct.pack(">IIBBBBB", width, n, 8, colour, 0, 0, 0)
        out.append(SIGNATURE + chunk(b"IHDR", header) + chunk(b"IDAT", packed(coded[end - n : end].tobytes(), level)) + chunk(b"IEND", b""))
    return out


def encode_png(samples: bytes, width: int, colour: int = 2, level: int = 4, filters: np.ndarray | None = None) -> bytes:
    return encode_pngs([samples], width, colour, level, filters)[0]


def unfilter(kinds: np.ndarray, rows: np.ndarray, step: int) -> np.ndarray:
    """Undo the row filters 0 to 4 of pictures of one size: ``kinds`` (picture, row), ``rows`` (picture, row, byte).

    A sample needs those to the left, above and above left. So pixel x of row r is due at time x + r: at each time one
    pixel of each column is undone, in all pictures at once.
    """
    n, height, stride = rows.shape
    if kinds.max(initial=0) > 4:
        raise ValueError("unknown PNG filter")
    if not kinds.any():
        return rows
    width = stride // step
    times = np.arange(width)
    coded = np.zeros((height + width - 1, n, width, step), np.uint8)
    kind = np.zeros((height + width - 1, n, width, 1), np.uint8)
    pixels = rows.reshape(n, height, width, step)
    for x in range(width):
        coded[x : x + height, :, x] = pixels[:, :, x].swapaxes(0, 1)
        kind[x : x + height, :, x, 0] = kinds.T
    done = np.zeros((3, n, width, step), np.int16)  # now, one and two times ago
    left, corner = np.zeros((2, n, width, step), np.int16)
    for t in range(len(coded)):
        now, up, before = done[t % 3], done[(t - 1) % 3], done[(t - 2) % 3]
        left[:, 1:], corner[:, 1:] = up[:, :-1], before[:, :-1]
        average, nearest = predictions(left, up, corner)
        k = kind[t]
        expected = np.where(k == 4, nearest, np.where(k == 2, up, np.where(k == 1, left, np.where(k == 3, average, 0))))
        now[:] = coded[t] + expected & 255
        # A column that hasn't begun or has ended has zeros as neighbours-to-be.
        now[:, (times > t) | (times + height <= t)] = 0
        coded[t] = now
    out = np.empty_like(pixels)
    for x in range(width):
        out[:, :, x] = coded[x : x + height, :, x].swapaxes(0, 1)
    return out.reshape(n, height, stride)


def read_png(data: bytes) -> tuple[int, int, np.ndarray]:
    """(width, samples per pixel, filtered rows) of an 8-bit, not interlaced PNG. Every chunk's checksum is tested."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, header, body, ended = 8, None, [], False
    while at < len(data) and not ended:
        (n,), kind = struct.unpack_from(">I", data, at), data[at + 4 : at + 8]
        content = data[at + 8 : at + 8 + n]
        if len(content) != n or struct.unpack_from(">I", data, at + 8 + n)[0] != zlib.crc32(kind + content):
            raise ValueError(f"bad checksum in {kind!r}")
        if kind == b"IHDR":
            header = struct.unpack(">IIBBBBB", content)
        elif kind == b"IDAT":
            body.append(content)
        ended = kind == b"IEND"
        at += 12 + n
    if not ended or header is None or header[2] != 8 or header[3] not in SAMPLES or header[6]:
        raise ValueError("incomplete or unsupported PNG")
    width, height, step = header[0], header[1], SAMPLES[header[3]]
    return width, step, np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, width * step + 1)


def decode_pngs(files: list[bytes]) -> list[tuple[int, int, bytes]]:
    """(width, samples per pixel, samples) of each file. Pictures of one width and about one height are unfiltered together."""
    read = [read_png(x) for x in files]
    groups: dict[tuple, list[int]] = {}
    for i, (width, step, rows) in enumerate(read):
        groups.setdefault((width, step, len(rows).bit_length()), []).append(i)
    out: list = [None] * len(files)
    for (width, step, _), own in groups.items():
        tallest = max(len(read[i][2]) for i in own)
        room = max(1, TOGETHER // (tallest * width * step))
        for a in range(0, len(own), room):
            part = own[a : a + room]
            rows = np.zeros((len(part), tallest, width * step + 1), np.uint8)  # a shorter picture goes on in zeros
            for k, i in enumerate(part):
                rows[k, : len(read[i][2])] = read[i][2]
            plain = unfilter(rows[:, :, 0], rows[:, :, 1:], step)
            for k, i in enumerate(part):
                out[i] = width, step, plain[k, : len(read[i][2])].tobytes()
    return out


def decode_png(data: bytes) -> tuple[int, int, bytes]:
    return decode_pngs([data])[0]


@lru_cache(maxsize=1)
def cosine_basis() -> np.ndarray:
    k, x = np.arange(HASH_LOW)[:, None], np.arange(HASH_SIDE)[None, :]
    return np.cos(np.pi * k * (2 * x + 1) / (2 * HASH_SIDE))


def cosine_hash(samples: bytes, width: int, step: int) -> str:
    """64-bit hash, 16 hex digits: signs of the low-frequency cosine coefficients of a 32 x 32 grey image against their median.

    The grey image is the mean over each of 32 x 32 cells of near-equal height and width; the first coefficient is left
    out of the median. A row or column of cells is repeated where the picture has fewer than 32.
    """
    grey = np.frombuffer(samples, np.uint8).reshape(-1, width, step).mean(axis=2)

    def cells(a: np.ndarray) -> np.ndarray:
        n = len(a)
        if n < HASH_SIDE:
            return a[np.arange(HASH_SIDE) * n // HASH_SIDE]
        edges = np.arange(HASH_SIDE) * n // HASH_SIDE
        return np.add.reduceat(a, edges, axis=0) / np.diff([*edges, n])[:, None]

    small = cells(cells(grey).T).T
    basis = cosine_basis()
    low = np.round(basis @ small @ basis.T, 6).ravel()
    bits = low > np.median(low[1:])
    return np.packbits(bits).tobytes().hex()


MEDIA = "doc_id {id}, n_bytes long, media binary"


def text_to_png(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): each whole text as the samples of a 192-pixel wide grey PNG.

    The UTF-8 bytes are followed by bytes 32 up to a positive multiple of 192; every row has the filter that suits it. Null and empty texts give one row of
    spaces; repeated rows stay; an empty table gives none. Other columns of ``df`` are not read.
    """
    tune(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                texts = text_values(b.column("text"))
                media = encode_pngs([x.ljust(max(1, -(-len(x) // ROW_BYTES)) * ROW_BYTES) for x in texts], ROW_BYTES, GREY)
                yield pa.record_batch([b.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    kind = dict(df.dtypes)[id_col]
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, MEDIA.format(id=kind))


def png_features(media: DataFrame) -> DataFrame:
    """Read the PNG of each row back: payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature.

    A null picture gives null features; a damaged one raises an error, as its row can't be told from a good one. Null ids
    stay null, repeated rows stay, an empty table gives no rows, other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "media"):
                files = b.column("media").to_pylist()
                read = iter(decode_pngs([x for x in files if x is not None]))
                rows = []
                for data in files:
                    if data is None:
                        rows.append((None,) * 6)
                        continue
                    width, step, samples = next(read)
                    rows.append((len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-16:]), len(data), hashlib.sha256(data).hexdigest(), cosine_hash(samples, width, step)))
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
                yield pa.record_batch([b.column("doc_id"), b.column("n_bytes"), *columns], names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    kind = dict(media.dtypes)["doc_id"]
    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
