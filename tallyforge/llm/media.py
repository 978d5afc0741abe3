"""Media columns: lossless PNG payloads, checked on reading, with cosine-transform hashes.

A text's UTF-8 bytes (null: empty), padded with spaces to a positive multiple of ROW, become the
samples of an RGB image of 64 pixels a row. Each row is stored with the filter (none, sub, up)
whose residuals are smallest; the decoder undoes all five filters of the format with numpy. Every
chunk's CRC is tested on reading, and a damaged file raises MediaError.

The feature is a 64-bit hash: the samples are averaged to 32 x 32, their two-dimensional cosine
transform is taken, and each of the 8 x 8 lowest frequencies gives a bit, set where it is above
the median. Equal texts give equal files and hashes. Very long texts only make taller images;
images are handled one at a time. Repeated rows each get a row, an empty table an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import pieces, table, texts_of

ROW, PIXEL = 192, 3
SIGNATURE = b"\x89PNG\r\n\x1a\n"  # fixed value of the format
SIDE, LOW = 32, 8
LEVEL = 3


class MediaError(ValueError):
    pass


def payload_of(raw: bytes, unit: int = ROW) -> bytes:
    return raw.ljust(max(1, -(-len(raw) // unit)) * unit, b" ")


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode(payload: bytes, row: int = ROW, level: int = LEVEL) -> bytes:
    """PNG of 8-bit RGB samples, `row` bytes a row."""
    x = np.frombuffer(payload, dtype=np.uint8).reshape(-1, row)
    sub, up = x.copy(), x.copy()
    sub[:, PIXEL:] -= x[:, :-PIXEL]
    up[1:] -= x[:-1]
    made = np.stack([x, sub, up])
    cost = np.abs(made.view(np.int8).astype(np.int16)).sum(axis=2)
    best = cost.argmin(axis=0)
    rows = np.empty((len(x), row + 1), dtype=np.uint8)
    rows[:, 0] = best
    rows[:, 1:] = made[best, np.arange(len(x))]
    head = struct.pack(">IIBBBBB", row // PIXEL, len(x), 8, 2, 0, 0, 0)
    return SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes(), level)) + chunk(b"IEND", b"")


def chunks(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    if not data.startswith(SIGNATURE):
        raise MediaError("no PNG signature")
    at = len(SIGNATURE)
    while at < len(data):
        if at + 12 > len(data):
            raise MediaError("cut short")
        (n,) = struct.unpack_from(">I", data, at)
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + n]
        if data[at + 8 + n : at + 12 + n] != struct.pack(">I", zlib.crc32(kind + body)):
            raise MediaError(f"checksum of {kind!r}")
        yield kind, body
        at += 12 + n
        if kind == b"IEND":
            return
    raise MediaError("no end")


def decode(data: bytes) -> np.ndarray:
    """Samples as rows x bytes. 8-bit RGB without interlacing."""
    packed, head = b"", b""
    for kind, body in chunks(data):
        if kind == b"IHDR":
            head = body
        elif kind == b"IDAT":
            packed += body
    width, height, depth, colour, method, filters, interlace = struct.unpack(">IIBBBBB", head)
    if (depth, colour, method, filters, interlace) != (8, 2, 0, 0, 0):
        raise MediaError("another kind of PNG")
    try:
        rows = np.frombuffer(zlib.decompress(packed), dtype=np.uint8).reshape(height, width * PIXEL + 1)
    except (zlib.error, ValueError) as e:
        raise MediaError(str(e)) from e
    return unfilter(rows)


def unfilter(rows: np.ndarray) -> np.ndarray:
    """Undo each row's filter; runs of rows with one filter are undone together where it allows."""
    kind, out = rows[:, 0], rows[:, 1:].copy()
    if kind.max(initial=0) > 4:
        raise MediaError("unknown filter")
    edges = np.flatnonzero(np.append(True, kind[1:] != kind[:-1]))
    for a, b in zip(edges, np.append(edges[1:], len(kind)), strict=True):
        if kind[a] == 1:
            own = out[a:b].reshape(b - a, -1, PIXEL)
            np.cumsum(own, axis=1, dtype=np.uint8, out=own)
        elif kind[a] == 2:
            if a:
                out[a] += out[a - 1]
            np.cumsum(out[a:b], axis=0, dtype=np.uint8, out=out[a:b])
        elif kind[a] >= 3:
            for i in range(a, b):
                above = out[i - 1] if i else np.zeros_like(out[0])
                predicted(out[i].reshape(-1, PIXEL), above.reshape(-1, PIXEL), int(kind[a]))
    return out


def predicted(row: np.ndarray, above: np.ndarray, kind: int) -> None:
    """Average and Paeth need the pixel before; the samples of a pixel go together."""
    left, corner = np.zeros(PIXEL, dtype=np.int32), np.zeros(PIXEL, dtype=np.int32)
    for i, up in enumerate(above.astype(np.int32)):
        if kind == 3:
            guess = (left + up) // 2
        else:
            p = left + up - corner
            a, b, c = abs(p - left), abs(p - up), abs(p - corner)
            guess = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
        row[i] = (row[i] + guess) & 255
        left, corner = row[i].astype(np.int32), up


_K, _I = np.arange(LOW)[:, None], np.arange(SIDE)[None]
COSINES = np.cos(np.pi * _K * (2 * _I + 1) / (2 * SIDE))


def averaged(x: np.ndarray, side: int = SIDE) -> np.ndarray:
    """Means over side x side cells; where an axis has fewer samples, they repeat."""
    if x.shape[1] < side:
        x = np.repeat(x, -(-side // x.shape[1]), axis=1)
    x, width = cells(x.T, side)
    if x.shape[1] < side:
        x = np.repeat(x, -(-side // x.shape[1]), axis=1)
    x, height = cells(x.T, side)
    return x / (height[:, None] * width[None, :])


def cells(x: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of side runs of rows, and the runs' lengths."""
    if len(x) % side == 0:
        n = len(x) // side
        return x.reshape(side, n, -1).sum(axis=1, dtype=np.int64), np.full(side, n)
    edge = np.arange(side + 1) * len(x) // side
    return np.add.reduceat(x, edge[:-1], axis=0, dtype=np.int64), np.diff(edge)


def hash_of(samples: np.ndarray) -> str:
    low = np.round(COSINES @ averaged(samples) @ COSINES.T, 6).ravel()
    middle = np.sort(low)[LOW * LOW // 2 - 1 : LOW * LOW // 2 + 1].mean()
    return np.packbits(low > middle).tobytes().hex()


def media_columns(docs: DataFrame, text: str = "text", key: str = "doc_id", row: int = ROW) -> DataFrame:
    """One row per document: key, n_bytes, media (binary PNG)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                raw = texts_of(batch.column(1).slice(a, b - a))
                media = [encode(payload_of(x, row), row) for x in raw]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(map(len, raw), pa.int64()), pa.array(media, pa.binary())], [key, "n_bytes", "media"])

    return docs.select(key, text).mapInArrow(run, f"{key} long, n_bytes long, media binary")


FEATURES = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def media_features(media: DataFrame, key: str = "doc_id") -> DataFrame:
    """Digests and hash of what the stored files hold, read back from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for stored in batch.column(2):
                data = stored.as_py()
                samples = decode(data)
                payload = samples.tobytes()
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(data), hashlib.sha256(data).hexdigest(), hash_of(samples)))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                [key, *(x.split()[0] for x in FEATURES.split(", "))],
            )

    return media.select(key, "n_bytes", "media").mapInArrow(run, f"{key} long, {FEATURES}")


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_features(media_columns(table(spark, sf_dir, "documents")))
