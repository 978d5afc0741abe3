"""Stages of op6_suffix_dedup against plain forms."""

import random

import numpy as np
import pyarrow as pa

from tallyforge.llm import repeats as R


def texts():
    rng = random.Random(4)
    line = "a line of some length that is said again and again, é, 😀; "
    some = ["".join(rng.choice("abcdé 😀") for _ in range(rng.choice([0, 3, 49, 50, 51, 74, 75, 76, 200, 900]))) for _ in range(150)]
    return [x.encode() for x in ["", "x", line * 9, line * 700, "q" * 300, line * 2 + some[5], *some, line]]


def test_anchors_of_many_texts_are_those_of_each(monkeypatch):
    raws = texts()
    for stretch in (1, 700, 1 << 15):
        monkeypatch.setattr(R, "STRETCH", stretch)
        got = list(R.anchors(raws))
        assert len(got) == len(raws)
        for raw, (at, found) in zip(raws, got, strict=True):
            chosen = {}
            if len(raw) >= R.WIDTH:
                h = R.string_hashes(np.frombuffer(raw, dtype=np.uint8), R.SEED).tolist()
                for k in range(len(raw) - R.WIDTH + 1):
                    least = min(h[k : k + R.SIDE + 1])
                    chosen |= {p: least for p in range(k, k + R.SIDE + 1) if h[p] == least}
            assert dict(zip(at.tolist(), found.tolist(), strict=True)) == chosen and at.tolist() == sorted(chosen)
    assert list(R.anchors([])) == []


def test_contexts_hold_every_place(monkeypatch):
    raws = texts()
    rows, expected = [], {}
    for doc, (raw, (at, h)) in enumerate(zip(raws, R.anchors(raws), strict=True)):
        home, low = R.narrowed(h, 96)
        key = low | home.astype(np.uint64) << np.uint64(48)
        hot, ordinal = key[h % 7 == 0], int(doc % 5 == 4)
        rows.append((doc, raw.decode(), [key[h % 2 == 0].tobytes(), b""], [hot.tobytes()] if len(hot) else [], ordinal))
        for a, x in zip(at.tolist(), h.tolist(), strict=True):
            if x % 2 == 0 or x % 7 == 0:
                left, right = raw[max(0, a - R.SIDE) : a], raw[a + R.SEED : a + R.WIDTH]
                expected.setdefault((-1 if x % 7 == 0 else x % 48, x - (1 << 64) if x >> 63 else x, doc, bytes((len(left), len(right))) + left + right), [-ordinal] * ordinal).append(a)
    kinds = (pa.int64(), pa.string(), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.int32())
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc", "body", "cold", "hot", "ordinal"])
    got = [r for b in R.contexts(96, 48)(iter([batch, batch.slice(0, 0)])) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert len(got) == len(expected)
    assert {(home, h, doc, context): np.frombuffer(at, dtype=np.int32).tolist() for home, h, doc, at, context in got} == expected


def test_spans_are_the_covered_bytes():
    rng = random.Random(8)
    for _ in range(200):
        size = rng.choice([50, 51, 120, 400])
        begin = {rng.randrange(size - R.WIDTH + 1) for _ in range(rng.randrange(5))}
        places = [(b + back, 1 << back) for b in begin for back in {rng.randrange(R.SIDE + 1)}]
        at, mask = (np.array([p[k] for p in places], dtype=np.int64) for k in (0, 1))
        start, end = R.spans(size, False, at, mask)
        covered = {i for b in begin for i in range(b, b + R.WIDTH)}
        assert covered == {i for a, b in zip(start.tolist(), end.tolist(), strict=True) for i in range(a, b)}
        assert all(b < a for b, a in zip(end.tolist(), start.tolist()[1:], strict=False))
