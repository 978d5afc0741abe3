"""Groups beyond those that a narrowed hash can name, cut characters, and the whole pipeline on odd tables."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyforge.llm import jaccard, repeats

from .test_edges import BASE, frame, kept_bytes

WIDE = "".join("äöüß€あ😀é"[(k * k * 7 + k // 3) % 8] for k in range(400))


def test_more_groups_than_names(spark, monkeypatch):
    monkeypatch.setattr(repeats, "NAMED", 5)
    rows = [(k, BASE[k * 37 % 300 :][: 60 + k * 31 % 500] + ("" if k % 3 else f" own {k} ") * 9) for k in range(30)]
    got = repeats.remove_repeats(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_bytes, bytes(r.kept).decode()) for r in got) == kept_bytes(rows)
    h = np.array([0, 1 << 63, (1 << 64) - 1, 12345678901234567890], dtype=np.uint64)
    home, low = repeats.narrowed(h, 5)
    group = repeats.split(home, low, 20)
    assert (group // 20 == home).all() and group.max() < 100


def test_cut_characters_go_whole_and_nothing_else(spark):
    rows = [(1, WIDE), (2, "x�y " + WIDE[100:200] + " end � �"), (3, "word " * 3 + WIDE[5:90] + "�"), (4, "plain � text"), (5, WIDE)]
    made = {r.doc_id: r.text for r in repeats.without_repeats(frame(spark, rows)).collect()}
    first, expected = {}, {}
    texts = [(d, t.encode()) for d, t in rows]
    for d, raw in texts:
        for k in range(len(raw) - 49):
            first.setdefault(raw[k : k + 50], d)
    for d, raw in texts:
        gone = [False] * len(raw)
        for k in range(len(raw) - 49):
            if first[raw[k : k + 50]] < d:
                gone[k : k + 50] = [True] * 50
        out, at = "", 0
        for c in raw.decode():
            n = len(c.encode())
            out += "" if any(gone[at : at + n]) else c
            at += n
        if not any(gone) or out.strip():
            expected[d] = out
    assert made == expected and made[2].count("�") == 3 and 5 not in made


def prose(k, n=80):
    return " ".join(f"w{(k * 31 + i * i * 7 + i) % 997}x{(k + i) % 13}" for i in range(n))


@pytest.fixture
def run(spark, tmp_path):
    def go(rows, ddl):
        spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/documents.parquet")
        return corpus_pipeline.run(spark, str(tmp_path))

    return go


DDL = "doc_id long, text string, lang string, source string, n_chars long"


def test_pipeline_on_an_empty_table(run):
    out = run([], DDL)
    assert out.count() == 0 and "ids" in out.columns


@pytest.fixture(scope="module")
def good(spark, data):
    """Texts that pass the first three stages, none like another."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    docs = jaccard.one_of_each(corpus_pipeline.quality_rules(spark, docs, data))
    return [r.text for r in docs.orderBy("doc_id").limit(40).collect()]


def test_pipeline_on_nulls_copies_and_clashing_names(spark, run, good):
    names = ("key_", "copies_", "digest_", "row_", "doc", "tid", "body", "class", "node", "label", "home", "rest", "found", "text_", "nth_", "source_")
    base = [(k, t, "en", "a" if k % 3 else None, len(t)) for k, t in enumerate(good[:30])]
    odd = [(None, good[35], None, None, None), (None, None, None, "a", 0), (90, "", "en", "a", 0), (91, None, "en", None, None), (92, good[3], "en", "a", 1), (93, good[4] + " more words", "en", "a", 1), (7, good[7], "en", "a", 9), (94, "short text", "de", "b", 3)]
    rows = [(*r, *names) for r in base + odd]
    made = run(rows, DDL + ", " + ", ".join(f"{n} string" for n in names)).collect()
    ids = {r.doc_id for r in made}
    assert ids <= {*range(30), None} and len(ids) > 20 and not ids & {90, 91, 92, 93, 94}
    assert all(r.round_trip and r.parity for r in made)


def test_pipeline_deletes_former_stages(spark, run, good, monkeypatch):
    own = [("quality_rules", corpus_pipeline.quality_rules), ("again", lambda s, d, _: d.withColumn("doc_id", F.col("doc_id") + 1)), ("last", lambda s, d, _: d)]
    monkeypatch.setattr(corpus_pipeline, "STAGES", own)
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    out = run([(k, t, "en", "a", 9) for k, t in enumerate(good[:5])], DDL)
    assert out.count() == 5 and {p.split("-")[0] for p in set(os.listdir(shared)) - before} == {"last"}


def test_ranges_grow_in_proportion(spark, monkeypatch):
    """Results do not depend on the number of ranges."""
    rows = [(k, prose(k % 7) + (f" tail {k}" if k % 2 else "")) for k in range(40)]
    one = sorted(map(tuple, jaccard.link_classes(frame(spark, rows)).collect()))
    monkeypatch.setattr(jaccard, "RANGE_BYTES", 16)
    assert sorted(map(tuple, jaccard.link_classes(frame(spark, rows)).collect())) == one
