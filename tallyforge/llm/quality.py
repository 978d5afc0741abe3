"""Quality rules: base statistics of whole texts and bands of their zstandard ratios.

A text passes if the base rules hold (at least MIN_WORDS words, at most half of them in repeated
three-word windows) and the ratio of its size to its compressed size lies in the band for its
length: above the band it repeats itself, below it is noise. Texts of a whole chunk or more are also
judged chunk by chunk, the last chunk being the text's last 4,096 bytes, and fail if more than a
twentieth of the chunks are outside the band for a chunk's length, which finds long texts that mix
noise and repetition to an inconspicuous mean. Shorter texts are a single chunk, which the band for
their length judges. Junk that fills a small part of each chunk, and decimal digits (2.14 to 2.16),
lie within a chunk's band and are not found by it.

The bands are parameters. For texts up to 100,000 bytes they are fitted to the 20,149 texts of sf0.1
and check_s that have label quality=1 and pass the base rules: 3 per cent below the least ratio of
a class and 1 per cent above the greatest, rounded outwards to 0.01 and made to rise with length.
Only 12 of them have up to 300 bytes and 30 over 50,000. The last class has no labelled text; it is
set by joined good texts of one language, 128,000 to 4,000,000 bytes (2.40 to 2.75). The chunk band
is just beyond the good chunks of sf0.1 and check_s (1.947 to 2.276) but for one of 12,162, and
above random hexadecimal digits (1.90 to 1.94). Ratios do not
find junk that compresses as prose does: README has the shares found. Null and empty texts have no words and fail. Texts are whole;
repeated rows each get a row; an empty table gives an empty result; other columns are ignored
(`passing` keeps them all).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from .common import WHITE, freed, pieces, table, texts_of

SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MOST_REPEATED = 50, 50


@dataclass(frozen=True)
class Bands:
    """(up to this many bytes, least ratio, greatest ratio), by length; the last holds beyond."""

    limits: tuple[tuple[int, float, float], ...] = (
        (300, 1.29, 1.61), (400, 1.29, 1.94), (500, 1.33, 1.94), (600, 1.33, 1.94), (800, 1.42, 1.96), (1000, 1.48, 2.03),
        (1250, 1.59, 2.06), (1600, 1.63, 2.11), (2000, 1.73, 2.19), (2500, 1.76, 2.19), (3200, 1.83, 2.23), (4000, 1.88, 2.26),
        (5000, 1.89, 2.31), (6400, 1.98, 2.35), (8000, 2.04, 2.37), (12000, 2.07, 2.43), (20000, 2.14, 2.48), (32000, 2.2, 2.52),
        (50000, 2.24, 2.56), (100000, 2.32, 2.58), (1 << 62, 2.32, 2.78),
    )
    chunk: int = 4096
    chunk_low: float = 1.95
    chunk_high: float = 2.3
    most_outside: float = 0.05
    level: int = 3


class Judge:
    def __init__(self, bands: Bands):
        self.bands, self.zstd = bands, zstandard.ZstdCompressor(level=bands.level)

    def ratio(self, raw: bytes) -> float:
        return len(raw) / len(self.zstd.compress(raw)) if raw else 0.0

    def outside(self, raw: bytes) -> float:
        """Share of the chunks whose ratio is outside the chunk band; 0 below one chunk. A partial
        chunk at the end is judged with the bytes before it that make it whole."""
        b = self.bands
        starts = [*range(0, len(raw) - b.chunk + 1, b.chunk)]
        if starts and len(raw) % b.chunk:
            starts.append(len(raw) - b.chunk)
        ratios = [self.ratio(raw[i : i + b.chunk]) for i in starts]
        return sum(not b.chunk_low <= r <= b.chunk_high for r in ratios) / len(ratios) if ratios else 0.0

    def rows(self, raw: list[bytes]) -> list[tuple]:
        """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, ratio, outside)"""
        words = [x.split() for x in raw]
        codes = pd.factorize(np.array([w for x in words for w in x], dtype=object))[0].astype(np.int64) if any(words) else np.zeros(0, np.int64)
        out, at = [], 0
        for x, own in zip(raw, words, strict=True):
            n = len(own)
            chars = len(x.decode("utf-8", "replace")) - sum(x.count(c) for c in WHITE)
            symbols = len(x) - len(x.translate(None, SYMBOLS))
            lines = [y for y in x.split(b"\n") if y.split()]
            repeated = in_repeated_windows(codes[at : at + n])
            at += n
            failed = n < MIN_WORDS or 100 * repeated > MOST_REPEATED * n
            ratio, outside = self.ratio(x), self.outside(x)
            low, high = next((a, b) for most, a, b in self.bands.limits if len(x) <= most)
            kept = not failed and low <= ratio <= high and outside <= self.bands.most_outside
            out.append((n, chars, symbols, len(lines) - len(set(lines)), repeated, failed, kept, ratio, outside))
        return out


def in_repeated_windows(codes: np.ndarray, width: int = 3) -> int:
    """Words that lie in a window of `width` words found twice or more."""
    n = len(codes) - width + 1
    if n < 2:
        return 0
    key = codes[:n].copy()
    for k in range(1, width):
        _, key = np.unique(key, return_inverse=True)
        key = key << 32 | codes[k : k + n]
    _, own, count = np.unique(key, return_inverse=True, return_counts=True)
    edge = np.zeros(len(codes) + 1, dtype=np.int64)
    twice = np.flatnonzero(count[own] > 1)
    edge[twice] += 1
    edge[twice + width] -= 1
    return int((np.cumsum(edge) > 0).sum())


COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, ratio double, chunks_outside double"


def judge(docs: DataFrame, bands: Bands | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: its statistics and the verdict `kept`."""
    bands = bands or Bands()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Judge(bands)
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                columns = list(zip(*own.rows(texts_of(batch.column(1).slice(a, b - a))), strict=True)) or [()] * 9
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], [key, *(x.split()[0] for x in COLUMNS.split(", "))])

    return docs.select(key, text).mapInArrow(freed(run), f"{key} long, {COLUMNS}")


def passing(docs: DataFrame, bands: Bands | None = None, text: str = "text") -> DataFrame:
    """The documents that are kept, with all their columns."""
    bands = bands or Bands()
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Judge(bands)
        for batch in batches:
            for a, b in pieces(batch.column(at)):
                part = batch.slice(a, b - a)
                yield part.filter(pa.array([r[6] for r in own.rows(texts_of(part.column(at)))], pa.bool_()))

    return docs.mapInArrow(freed(run), docs.schema)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))
