"""Importance resampling, centroid clustering and reply trees against versions in plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import centroids, replies, resample

LETTER = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest):
    words = LETTER.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i : i + n]).encode() for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def drawn(docs, target, longest=2, buckets=10_000, seed=7, percent=25, least=20):
    """(doc_id, n_features, weight, score, rank) of each (doc_id, text), one feature at a time."""
    s, t = (Counter(zlib.crc32(f) % buckets for x in texts for f in features(x, longest)[1]) for texts in ([x for _, x in docs], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    rows = []
    for d, x in docs:
        words, own = features(x, longest)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in (zlib.crc32(f) % buckets for f in own)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= least))
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    first = order[: percent * len(order) // 100]
    rank = defaultdict(list)
    for k, r in enumerate(first):
        rank[r].append(k + 1)
    return sorted(((*r[:4], rank[r].pop() if rank[r] else None) for r in rows), key=str)


def rows_of(df, key="doc_id"):
    return sorted(((r[key], r.n_features, r.weight, r.score, r.rank) for r in df.collect()), key=str)


ODD = [(None, None), (None, "One two, THREE " * 9), (1, ""), (2, "ß é—dash x" * 30), (2, "ß é—dash x" * 30), (3, " ".join(f"w{k}" for k in range(900))), (4, "a" * 5000), (5, "the of " * 400), (6, "19 words " * 9 + "end"), (7, "20 words " * 10)]


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_resampling_equals_a_plain_version(spark, data, monkeypatch, longest):
    whole = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()] + [None, ""]
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    for rows, goal in ((ODD, target), (ODD, []), (whole + ODD, target)):
        docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key_": F.lit(1), "weight": F.lit("x"), "at_": F.lit(0)}).repartition(3)
        got = resample.resample(docs, aim if goal else aim.limit(0), longest=longest, buckets=977)
        assert rows_of(got) == drawn(rows, goal, longest, 977)
    assert resample.resample(docs.limit(0), aim).count() == 0


def test_op11_of_the_whole_tables(spark, data):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    assert rows_of(resample.op11_importance_resampling(spark, data)) == drawn(docs, target)


@pytest.mark.parametrize("longest", [1, 2, 3, 4])
def test_tries_count_across_slices_and_when_they_are_emptied(monkeypatch, longest):
    rng = random.Random(longest)
    texts = [" ".join(rng.choice(["a", "bc", "É", "x9", "longer"]) for _ in range(rng.randrange(60))) for _ in range(40)] + ["", "one " * 300]
    expected = Counter(zlib.crc32(f) % 101 for t in texts for f in features(t, longest)[1])
    for size, most in ((7, 5), (64, 1 << 30), (1 << 20, 40)):
        monkeypatch.setattr(resample, "SLICE", size)
        trie, gain = resample.Trie(longest, 101), np.arange(101) - 50
        scored, sums = resample.Trie(longest, 101, gain), np.zeros(len(texts), np.int64)
        for words, row, old in resample.chunks([t.encode() for t in texts], longest):
            trie.walk(words, row, old)
            np.add.at(sums, *scored.walk(words, row, old))
            for x in (trie, scored):
                if x.nodes() > most:
                    x.empty()
        trie.empty()
        assert trie.total.tolist() == [expected[b] for b in range(101)], (size, most)
        assert sums.tolist() == [sum(int(gain[zlib.crc32(f) % 101]) for f in features(t, longest)[1]) for t in texts], (size, most)


def clustered(rows, k=16, rounds=3, seed=1, width=64, scale=64):
    """{(key, components)...} by exact integers: sorted (key, cluster, distance, cluster inertia, inertia, digest)."""
    from fractions import Fraction

    own = [(d, [math.floor(Fraction(x) * scale) for x in v], v) for d, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(own, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[2]))
    c = [r[1] for r in order[:k]]

    def go():
        apart = [[sum((a - b) ** 2 for a, b in zip(v, x, strict=True)) for x in c] for _, v, _ in own]
        return [d.index(min(d)) for d in apart], [min(d) for d in apart]

    for _ in range(rounds):
        best, _ = go()
        c = [[sum(z) // len(m) for z in zip(*m, strict=True)] if (m := [r[1] for r, b in zip(own, best, strict=True) if b == j]) else x for j, x in enumerate(c)]
    best, apart = go()
    top = (1 << 63) - 1
    inside = Counter()
    for b, d in zip(best, apart, strict=True):
        inside[b] += min(d, top)
    names = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c]
    return sorted(((r[0], b, min(d, top), min(inside[b], top), min(sum(inside.values()), top), names[b]) for r, b, d in zip(own, best, apart, strict=True)), key=str)


def clusters(df):
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect()), key=str)


def test_centroids_equal_exact_integers(spark):
    rng = random.Random(5)
    inf, nan = math.inf, math.nan
    near = [[rng.choice([-0.5, 0.0, 0.25, 0.5]) for _ in range(4)] for _ in range(120)]  # many ties
    odd = [None, [], [1.0] * 3, [1.0, None, 0.0, 2.0], [1.0, nan, 0.0, 2.0], [inf, 0.0, 0.0, 0.0], [-inf, 0.0, 0.0, 0.0]]
    great = [[1e300, -1e300, 0.1, -0.1], [16384.0, -16384.01, 0.0, 1.0], [3e5, 3e5, -3e5, 1e-310], [2.0**60 + 4096, 0.0, -(2.0**70), 5.5]]
    for vectors in (near, near + odd, near[:5] + odd, near + great, great, near * 2):
        rows = [(k if k % 7 else None, v) for k, v in enumerate(vectors)] + [(3, vectors[0]), (3, vectors[0])]
        docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"key_": F.lit(1), "cluster": F.lit("x"), "n": F.lit(0)}).repartition(3)
        for k, rounds in ((5, 3), (1, 1), (3, 0)):
            assert clusters(centroids.cluster(docs, k=k, rounds=rounds, width=4)) == clustered(rows, k, rounds, width=4)
    assert centroids.cluster(docs.limit(0), width=4).count() == 0 and centroids.cluster(docs, width=5).count() == 0


def test_screening_never_errs(monkeypatch):
    """Float32 products of components up to 2^20 round; the choice must not."""
    rng = np.random.default_rng(3)
    settled = 0
    for most in (40, 5000, (1 << 20) - 1):
        c = rng.integers(-most, most, (16, 64))
        c[7] = c[2]  # a tie everywhere
        c[9] = c[4] + (np.arange(64) == 3)
        v = np.concatenate([c, c + rng.integers(-1, 2, c.shape), rng.integers(-most, most, (500, 64)), np.zeros((3, 64), np.int64), (c[4] + c[11]) // 2 + rng.integers(-1, 2, (50, 64))])
        v = np.clip(v, -(1 << 20) + 1, (1 << 20) - 1)
        best, apart, open_ = centroids.Centroids(c.tolist()).nearest(v)
        exact = ((v[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
        assert best.tolist() == exact.argmin(axis=1).tolist() and apart.tolist() == exact.min(axis=1).tolist()
        settled += len(v) - open_
    assert settled > 800


def test_op12_of_the_whole_table(spark, data):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
    assert clusters(centroids.op12_centroids(spark, data)) == clustered(rows)


def escaped(text, role=False):
    out = text.replace("\\", "\\\\").replace("##", "#\\#").replace("##", "#\\#").replace("</turn>", "<\\/turn>")
    return out.replace(":", "\\:") if role else out


def conversations(rows, keep):
    """rows: (tree, id, parent, role, text, score). All chosen paths as (tree, rank, text, mask), by recursion."""
    trees = defaultdict(dict)
    for tree, node, parent, role, text, score in rows:
        own = (score if score is not None and math.isfinite(score) else 0.0, role or "", text or "", parent)
        held = trees[tree].get(node)
        trees[tree][node] = max(held, own, key=lambda x: (*x[:3], x[3] is not None, str(x[3]))) if held else own
    out = []
    for tree, nodes in trees.items():
        below = defaultdict(list)
        for node, own in nodes.items():
            below[own[3] if own[3] in nodes else None].append(node)
        most = {p: max(nodes[n][0] for n in under) for p, under in below.items()}
        found = []

        def go(node, path, cost):
            cost += most[path[-1] if path else None] - nodes[node][0]
            if below[node]:
                for n in below[node]:
                    go(n, [*path, node], cost)
            else:
                found.append((cost, -nodes[node][0], f"={node}", [*path, node]))

        for root in list(below[None]):
            go(root, [], 0.0)
        for rank, (_, _, _, path) in enumerate(sorted(found)[: keep or len(found)]):
            text, mask = "", []
            for n in path:
                text += f"### {escaped(nodes[n][1], True)}: "
                body = escaped(nodes[n][2])
                if nodes[n][1] == "assistant":
                    mask.append((len(text), len(text) + len(body)))
                text += body + "</turn>\n"
            out.append((tree, rank + 1 if keep else None, text, mask))
    return sorted(out, key=str)


REPLIES = "tree_id string, message_id long, parent_id long, role string, text string, score double"
HARD = [r"\### Assistant: </turn> ok", "a\\", "\\", "####", "#\\#", "</turn>", "<\\/turn>\n### user: x", "", "é 😀", ": ", None, "x" * 3000]


def made(df, keep):
    return sorted(((r.tree_, r.rank_, r.formatted, [(m.start, m.stop) for m in r.mask]) for r in df.collect()), key=str)


def test_reply_trees_equal_recursion(spark):
    rng = random.Random(11)
    rows = []
    for tree in ("a", "b", None, "chain", "star", ""):
        n = {"chain": 37, "star": 60}.get(tree, 25)
        for k in range(n):
            parent = (k - 1 if k else None) if tree == "chain" else (0 if k else None) if tree == "star" else (rng.choice([None, *range(k), 999]) if k else None)
            rows.append((tree, k, parent, rng.choice(["user", "assistant", "system", "a:b", ": ", "x\\", None]), rng.choice(HARD), rng.choice([0.5, 0.25, 1.0, None, math.nan, -2.0])))
    rows += [("circle", 1, 2, "user", "x", 1.0), ("circle", 2, 1, "user", "y", 1.0), ("circle", 3, 2, "assistant", "z", 1.0), ("circle", 4, 4, "user", "self", 0.0), ("circle", 5, None, "user", "fine", 0.0)]
    rows += rows[:10] + [("a", 3, None, "user", "other", 9.0)]
    docs = spark.createDataFrame(rows, REPLIES).withColumns({"node_": F.lit(1), "rank_": F.lit("x"), "leaf_": F.lit(2)}).repartition(3)
    for keep in (1, 3, None):
        assert made(replies.from_replies(docs, keep), keep) == conversations(rows, keep)
    assert replies.from_replies(docs.limit(0)).count() == 0


def test_replies_without_ids_and_texts_read_back(spark):
    rows = [("t", None, None, "user", f"hello {k}", 0.0) for k in (1, 2, 2)] + [("t", 5, None, r, t, 0.0) for r, t in (("assistant", "a"), ("assistant", "b"))]
    own = replies.from_replies(spark.createDataFrame(rows, REPLIES), None).collect()
    assert sorted(r.formatted for r in own) == ["### assistant: b</turn>\n", "### user: hello 1</turn>\n", "### user: hello 2</turn>\n"]
    said = [("c", k, role, text) for k, (role, text) in enumerate((r, t) for r in ("assistant", "user", ":\\", None) for t in HARD)]
    docs = spark.createDataFrame(said, "conv_id string, turn long, role string, text string")
    whole = replies.formatted(replies.chains(docs))
    row = whole.select(replies.turns(F.col("formatted")).alias("t"), replies.learned_text(F.col("formatted"), F.col("mask")).alias("loss"), "n_turns").first()
    assert [(t.role, t.text) for t in row.t] == [(r or "", t or "") for _, _, r, t in said] and row.n_turns == len(said)
    assert row.loss == "".join(t or "" for _, _, r, t in said if r == "assistant")


def test_op13_of_the_whole_table(spark, data):
    rows = [(r.conv_id, r.turn, r.role, r.text or "") for r in spark.read.parquet(f"{data}/conversations.parquet").collect()]
    rows += [(-7, k, role, r"\### Assistant: </turn> ok") for k, role in enumerate(("user", "assistant"))]
    own = defaultdict(list)
    for c, _, role, text in sorted(rows):
        own[c].append((role, text))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = []
    for c, turns in own.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        written = "".join(f"### {escaped(r, True)}: {escaped(t)}</turn>\n" for r, t in turns)
        expected.append((c, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(written)))
    got = replies.op13_chat_formatting(spark, data).collect()
    assert sorted((r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in got) == sorted(expected)
