"""Compression bands and media hashes against plain Python."""

import math
import random
import statistics

import pytest
import zstandard

from tallyforge.llm import media, quality


@pytest.fixture(scope="module")
def texts(spark, data):
    draw = random.Random(5)
    prose = [r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    good = " ".join(t for t in prose if t)
    noise = "".join(draw.choice("0123456789abcdef ") for _ in range(60_000))
    made = [good[:4095], good[:4096], good[:4097], good[:50_000], good[:20_000] + noise[:20_000], noise, "the same line\n" * 900, good[:3000] + "äöü " * 3000]
    return list(enumerate([*prose, *made, None, "", " ", "x", "ß" * 5000, "\n".join(good[:9000].split())]))


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(texts, "doc_id long, text string").repartition(5)


def plain_verdict(text, bands):
    """(ratio, share of chunks outside, whether the bands hold)."""
    raw = (text or "").encode()
    size = lambda x: len(zstandard.ZstdCompressor(level=bands.level).compress(x))
    whole = len(raw) / size(raw) if raw else 0.0
    chunks = [raw[k : k + bands.chunk] for k in range(0, len(raw), bands.chunk)]
    if len(raw) >= bands.chunk:
        chunks[-1] = raw[-bands.chunk :]
        outside = sum(1 for c in chunks if len(c) / size(c) < bands.chunk_low or len(c) / size(c) > bands.chunk_high) / len(chunks)
    else:
        outside = 0.0
    for most, low, high in bands.limits:
        if len(raw) <= most:
            return whole, outside, low <= whole <= high and outside <= bands.most_outside


def test_verdicts_equal_plain_compression(texts, docs):
    bands = quality.Bands()
    rows = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert len(rows) == len(texts)
    for k, text in texts:
        ratio, outside, held = plain_verdict(text, bands)
        r = rows[k]
        assert (r.ratio, r.chunks_outside) == pytest.approx((ratio, outside)), k
        assert r.kept == (not r.base_failed and held), k
    assert {r.kept for r in rows.values()} == {True, False} and any(0 < r.chunks_outside < 1 for r in rows.values())
    assert sorted(r.doc_id for r in quality.passing(docs).collect()) == sorted(k for k, r in rows.items() if r.kept)


def plain_cosines(text):
    """The low frequencies as sums over the cells of the picture, row by row."""
    raw = (text or "").encode()
    raw += b" " * (max(1, math.ceil(len(raw) / 192)) * 192 - len(raw))
    picture = [raw[k : k + 192] for k in range(0, len(raw), 192)]
    if len(picture) < 32:
        picture = [line for line in picture for _ in range(math.ceil(32 / len(picture)))]
    edge = [k * len(picture) // 32 for k in range(33)]
    mean = [[statistics.fmean(v for line in picture[edge[i] : edge[i + 1]] for v in line[6 * j : 6 * j + 6]) for j in range(32)] for i in range(32)]
    wave = [[math.cos(math.pi * k * (2 * i + 1) / 64) for i in range(32)] for k in range(8)]
    across = [[sum(mean[i][j] * wave[b][j] for j in range(32)) for b in range(8)] for i in range(32)]
    return [sum(across[i][b] * wave[a][i] for i in range(32)) for a in range(8) for b in range(8)]


def test_features_equal_direct_cosine_sums(texts, docs):
    rows = {r.doc_id: r.feature for r in media.media_features(media.media_columns(docs)).collect()}
    for k, text in texts[::12] + texts[-14:]:
        low = plain_cosines(text)
        middle = statistics.median(low)
        bits = f"{int(rows[k], 16):064b}"
        # a sum within the rounding of the median may fall on either side
        clear = [(b, x > middle) for b, x in zip(bits, low, strict=True) if abs(x - middle) > 2e-6]
        # a picture of one row has no vertical frequencies, a blank one only its mean
        assert len(clear) >= (60 if len((text or "").encode()) > 9000 and len(set(text)) > 1 else 1), k
        assert all((b == "1") == above for b, above in clear), k
