"""Language identification and sharding against versions in plain Python."""

import hashlib
import math
import zlib
from itertools import product

import pytest

from tallyforge.llm import language, shards


def unit(*parts):
    return (int(hashlib.md5("|".join("-" if p is None else str(p) for p in parts).encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)


def none_first(x):
    return (x is not None, x.encode() if isinstance(x, str) else x or 0)


def cut_in_order(rows, n):
    """(doc_id, size, crc, shard, slot) of each (doc_id, text, source): sort by fractional rank, cut."""
    own = []
    for d, t, s in rows:
        body = (t or "").encode()
        own.append((d, s, unit("interleave", d, hashlib.md5(body).hexdigest()), zlib.crc32(body), len(body) + 1))
    order = []
    for s in {x[1] for x in own}:
        group = sorted((x for x in own if x[1] == s), key=lambda x: (x[2], none_first(x[0]), x[3], x[4]))
        order += [((k + unit("interleave", s)) / len(group), none_first(s), x[2], none_first(x[0]), x[3], x[4], x[0]) for k, x in enumerate(group)]
    order.sort(key=lambda x: x[:-1])
    made = [(x[-1], x[5], x[4], k * n // len(order)) for k, x in enumerate(order)]
    first = {x[3]: k for k, x in reversed(list(enumerate(made)))}
    return sorted(((*x, k - first[x[3]]) for k, x in enumerate(made)), key=str)


def test_shards_equal_a_plain_sort_and_cut(spark, data):
    odd = [(1, None, None), (2, "", "a"), (3, "x" * 9000, "a"), (3, "x" * 9000, "a"), (3, "other", "a"), (None, "ünï", None), (None, None, "b"), (7, "ünï", "é"), (8, "t", ""), (9, "t", "")]
    whole = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    for rows in (odd, odd[:1], whole + odd):
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
        for n in (16, 3):
            got = [(r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in shards.interleave(docs, n).collect()]
            assert sorted(got, key=str) == cut_in_order(rows, n)


def grams(t):
    x = t.lower().encode()
    return {((int.from_bytes(x[i : i + k], "big") ^ k << 28) * 2654435761 & 0xFFFFFFFF) >> 17 for k in (1, 2, 3, 4) for i in range(len(x) - k + 1)}


def decoder(train):
    """Fit on (text, language); returns text -> (language, score), one document, bit and language at a time."""
    names = sorted({x for _, x in train})
    code = [c for c in product((1, -1), repeat=len(names)) if c[0] == 1 and -1 in c]
    seen = {x: [grams(t) for t, y in train if y == x] for x in names}
    buckets = set().union(*(g for x in names for g in seen[x]))

    def share(x, g):
        return (sum(g in own for own in seen[x]) + 0.5) / (len(seen[x]) + 1)

    shares = {g: [share(x, g) for x in names] for g in buckets}
    empty = [0.5 / (len(seen[x]) + 1) for x in names]

    def weight(g, bit):
        yes, no = ([s for s, c in zip(shares.get(g, empty), bit, strict=True) if c == sign] for sign in (1, -1))
        return math.log((sum(yes) / len(yes)) / (sum(no) / len(no)))

    weights = {g: [weight(g, bit) for bit in code] for g in buckets}
    blank = [weight(-1, bit) for bit in code]

    def margins(t):
        own = [weights.get(g, blank) for g in grams(t)]
        return [sum(w[b] for w in own) / max(sum(abs(w[b]) for w in own), 1e-9) for b in range(len(code))]

    held = {x: [margins(t) for t, y in train if y == x] for x in names}
    threshold, trust = [], [[0.0] * len(code) for _ in names]
    for b, bit in enumerate(code):
        tried = []
        for k in range(200):
            below = [sum(min(199, int((m[b] + 1) / 2 * 200)) <= k for m in held[x]) / len(held[x]) for x in names]
            right = [p if c < 0 else 1 - p for p, c in zip(below, bit, strict=True)]
            tried.append((min(right) + sum(right) / len(right), right))
        best = max(worth for worth, _ in tried)
        ties = [k for k, (worth, _) in enumerate(tried) if worth >= best - 1e-12]
        k = ties[len(ties) // 2]
        threshold.append(-1 + 2 * (k + 1) / 200)
        for i, r in enumerate(tried[k][1]):
            trust[i][b] = r

    def decide(t):
        if not any(map(str.isalpha, t or "")):
            return "und", 0.0
        sure = [max(-1.5, min(1.5, 6 * (m - h))) for m, h in zip(margins(t), threshold, strict=True)]
        loss = [sum(w / sum(own) * math.exp(-bit[i] * m) for w, bit, m in zip(own, code, sure, strict=True)) for i, own in enumerate(trust)]
        odds = [math.exp(-x) for x in loss]
        i = loss.index(min(loss))
        return names[i], odds[i] / sum(odds)

    return decide


def test_language_equals_a_plain_decoder(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").where("length(text) < 3000")
    model = language.fit(docs.where(~language.held_out()))
    rows = language.predict(docs, model).join(docs, "doc_id").collect()
    train = [(r.text, r.lang) for r in rows if r.text is not None and r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    decide = decoder(train)
    assert len(rows) > 100 and len({x for _, x in train}) == len(model.languages) > 2
    for r in rows:
        lang, score = decide(r.text)
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=2e-3), r.doc_id
