"""The llm operators against brute force, the libraries and planted cases."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyforge.llm import jaccard, language, media, mixture, pieces, quality, repeats, shards, token_count, url_filter
from tallyforge.llm.components import components, extended
from tallyforge.llm.suffix import suffix_arrays

P = pytest.importorskip("public_tokenizers")
PROSE = [" ".join(f"w{(7 * k * k + 13 * j) % 997}" for j in range(120)) for k in range(6)]
LONG = " ".join(f"x{k}" for k in range(30_000))
ROWS = [
    (1, PROSE[0], "en", "a", 1), (2, PROSE[0], "en", "a", 1), (3, PROSE[0].replace("w13 ", "zz "), "en", "b", 1), (4, None, None, None, 1), (5, "", "en", "a", 0), (6, "one two", "de", "b", 7),
    (7, "ONE Two", None, "b", 7), (8, PROSE[1], "de", "b", 1), (9, PROSE[2] + "\n" + PROSE[1][:200], "de", "c", 1), (10, LONG, "en", "c", 1), (11, "äöü " * 60, "de", None, 1), (12, PROSE[3] + "  \t\n " + PROSE[4], "en", "c", 1), (12, PROSE[3] + "  \t\n " + PROSE[4], "en", "c", 1),
]
DDL = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "size string, shard int, bucket_ int, key string, rank_ int"


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    return spark.createDataFrame([(*r, "s", 1, 2, "k", 3) for r in ROWS], f"{DDL}, {CLASHING}")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], f"{DDL}, {CLASHING}")


def raw(t):
    return (t or "").encode()


def test_every_operator_takes_an_empty_table(none):
    for f in (quality.judge, quality.passing, token_count.count_tokens, pieces.digests, pieces.tokenised, shards.interleave, mixture.mix, mixture.mixed, jaccard.link_classes, jaccard.one_of_each, repeats.remove_repeats, repeats.without_repeats):
        assert f(none).count() == 0, f
    assert media.media_features(media.media_columns(none)).count() == 0
    assert language.predict(none, language.fit(none)).count() == 0
    assert url_filter.judge(none.selectExpr("doc_id page_id", "text url")).count() == 0


# ---- suffix arrays and repeats


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=24), min_size=1, max_size=6))
def test_suffix_arrays_equal_sorting(texts):
    own = [[*t, 0] for t in texts]
    base = np.cumsum([0, *map(len, own)])
    expected = [int(b) + i for t, b in zip(own, base, strict=False) for i in sorted(range(len(t)), key=lambda i, t=t: t[i:])]
    assert suffix_arrays(np.array([c for t in own for c in t]), base).tolist() == expected


def brute_repeats(rows):
    first = {}
    for d, t in rows:
        b = raw(t)
        for k in range(len(b) - 49):
            first[b[k : k + 50]] = min(d, first.get(b[k : k + 50], d))
    out = {}
    for d, t in rows:
        b = raw(t)
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < d:
                gone[k : k + 50] = b"\1" * 50
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("hot", [1, 1024])
def test_repeats_equal_brute_force(spark, docs, monkeypatch, hot, tmp_path):
    monkeypatch.setattr(repeats, "HOT", hot)
    base = "".join(chr(97 + (k * k * 31 + k // 7) % 26) for k in range(900))
    more = [(100 + k, base[17 * k : 17 * k + 300] + f" {k} " + base[:49]) for k in range(12)] + [(150, "ab" * 200), (151, "ab" * 80), (152, base[:50]), (153, "x" + base[:50]), (154, "é" * 40), (155, "zé" * 30 + "é" * 30)]
    rows = [(r[0], r[1]) for r in ROWS] + more
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r[0]: tuple(r)[1:] for r in repeats.op6_suffix_dedup(spark, str(tmp_path)).collect()}
    assert got == brute_repeats(rows)


def test_without_repeats_keeps_columns_and_clean_texts(docs):
    out = {r.doc_id: r for r in repeats.without_repeats(docs).collect()}
    assert out[1].text == PROSE[0] and out[1].n_chars == 1 and 2 not in out and out[10].text == LONG
    assert 9 in out and out[9].n_chars == len(out[9].text) < len(ROWS[8][1]) and list(out[9].asDict()) == docs.columns


# ---- n-gram Jaccard


def brute_links(rows):
    sets = {}
    for d, t in rows:
        w = raw(t).lower().split()
        sets[d] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            n = len(sets[a] & sets[b])
            if a < b and n and 100 * n >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def test_jaccard_equals_brute_force(spark, docs, tmp_path):
    random = np.random.default_rng(5)
    more, k = [], 200
    for family in range(6):
        base = [f"f{family}w{j}" for j in range(80)]
        for _ in range(14):
            words = list(base)
            for j in random.integers(0, 80, random.integers(0, 7)):
                words[j] = f"e{random.integers(1000)}"
            more.append((k, " ".join(words).upper() if k % 5 == 0 else "\n".join(words)))
            k += 1
    rows = [(r[0], r[1]) for r in ROWS] + more
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in jaccard.op10_jaccard_join(spark, str(tmp_path)).collect()]
    expected = brute_links(rows)
    assert len(got) == len(rows) and {r[0]: r[1:] for r in got} == expected
    assert len({c for _, c in expected.values()}) < len(expected) - 20


def test_labels_extended_by_links_equal_labels_of_all_links(spark):
    draw, schema = random.Random(5), "a long, b long"
    first, more, last = ([(draw.randrange(low, 90), draw.randrange(low, 90)) for _ in range(n)] for low, n in ((20, 25), (0, 30), (0, 20)))
    label = components(spark.createDataFrame(first, schema))
    for links in ([], more, [(7, 7), *more[:3]], last):
        label = extended(label, spark.createDataFrame(links, schema))
    whole = components(spark.createDataFrame([x for x in first + more + last if x[0] != x[1]], schema))
    assert sorted(map(tuple, label.collect())) == sorted(map(tuple, whole.collect()))


def test_threshold_is_inclusive_and_components_chain(spark, docs):
    base = [f"t{j}" for j in range(17 + 4)]  # 17 shingles; another with 15 of them of 20 in all is exactly 0.75
    rows = [(1, " ".join(base)), (2, " ".join([*base[:19], "q1", "q2", "q3"]))]
    got = {r[0]: tuple(r)[1:] for r in jaccard.link_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_links(rows) and got[2][1] == 1
    chain = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(100, 100)], "a long, b long")
    assert {tuple(r) for r in components(chain).collect()} == {(k, 1) for k in range(1, 41)}
    kept = jaccard.one_of_each(docs).collect()
    assert Counter(r.doc_id for r in kept) == Counter({d: 1 for d in (1, 4, 5, 6, 8, 9, 10, 11, 12)} | ({} if brute_links([(r[0], r[1]) for r in ROWS])[3][1] == 1 else {3: 1}))


# ---- quality


def brute_quality(t):
    b = raw(t)
    w = b.decode().translate({c: 32 for c in (9, 10, 11, 12, 13)}).split(" ")
    w = [x for x in w if x]
    seen = Counter(zip(w, w[1:], w[2:], strict=False))
    rep = {k + j for k in range(len(w) - 2) if seen[(w[k], w[k + 1], w[k + 2])] > 1 for j in range(3)}
    lines, dup = set(), 0
    for x in b.decode().split("\n"):
        if x.strip(" \t\r\x0b\x0c"):
            dup += x in lines
            lines.add(x)
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in b.decode()), dup, len(rep), len(w) < 50 or 100 * len(rep) > 50 * len(w)


def test_quality_equals_brute_force(spark, docs):
    random = np.random.default_rng(3)
    noise = " ".join("".join(chr(c) for c in random.integers(33, 127, 9)) for _ in range(400))
    extra = [(20, noise), (21, ("same words here again and again\n" * 40) + "#$"), (22, "a\n\n a\na\n \x0b\nb\u2003c\n" * 30)]
    rows = [(r[0], r[1]) for r in ROWS] + extra
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, t in rows:
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_quality(t), d
        ratio = len(raw(t)) / len(zstandard.ZstdCompressor(level=3).compress(raw(t))) if t else 0.0
        assert r.ratio == ratio and not (r.kept and r.base_failed)
    assert not got[20].kept and not got[20].base_failed and not got[21].kept


def test_passing_keeps_columns(docs):
    kept = quality.passing(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in quality.judge(docs).where("kept").collect()}


def labelled(sf):
    """(quality, text, row of the judge) of the labelled texts that pass the base rules."""
    read = lambda name: pq.read_table(f"/root/testdata/{sf}/{name}.parquet").to_pylist()
    good = {r["doc_id"]: r["quality"] for r in read("labels")}
    rows = [(good[r["doc_id"]], raw(r["text"])) for r in read("documents") if r["doc_id"] in good]
    judged = quality.Judge(quality.Bands()).rows([t for _, t in rows])
    return [(g, t, j) for (g, t), j in zip(rows, judged, strict=True) if not j[5]]


def test_bands_tell_labelled_texts_apart():
    for sf, least in (("sf0.1", 0.6), ("sf0.01", 0.6)):
        rows = labelled(sf)
        good, bad = ([j[6] for g, _, j in rows if g == k] for k in (1, 0))
        assert all(good) and bad.count(False) >= least * len(bad)


def test_chunks_find_junk_within_prose():
    rows, random = labelled("sf0.1"), np.random.default_rng(7)
    good = [t for g, t, _ in rows if g == 1 and len(t) > 4096]
    assert all(j[6] for g, _, j in rows if g == 1)  # none is lost to the chunks
    assert not any(j[6] for g, t, j in rows if g == 0 and len(t) >= 4096)
    prose = b"\n".join(t for t in good if b" the " in t)[:120_000]
    judge = quality.Judge(quality.Bands())

    def share(junk, part, whole=prose):
        """The share of bad chunks after each tenth of `whole` ends in `part` of junk."""
        step = len(whole) // 10
        cut = [whole[i : i + int(step * (1 - part))] + junk(step - int(step * (1 - part))) for i in range(0, 10 * step, step)]
        return judge.outside(b"".join(cut))

    base64_ = lambda n: base64.b64encode(random.bytes(n))[:n]
    hex_ = lambda n: random.bytes(n).hex().encode()[:n]
    assert judge.outside(prose) <= 0.05
    for part in (0.45, 0.2):
        assert share(base64_, part) > 0.05
    assert share(hex_, 0.45) > 0.05
    one = next(t for t in good if len(t) > 6000)[:6000]
    assert judge.outside(one) == 0 and judge.outside(one[:4500] + base64_(1500)) > 0.05  # the tail
    assert judge.outside(one[:2596] + base64_(1500)) > 0.05  # a single chunk


# ---- tokens


TEXTS = [*(r[1] or "" for r in ROWS), "a" * 3001, "x<|endoftext|>y <|endoftext|>", " \n\n a  b ", "日本語 テキスト🎉\x00", "ab" * 900, "=" * 77, "it's 12,345.6 — don't", "▁x ▁▁ y", " " * 53 + "x", "<s> </s> <0x0A>"]


def test_token_counts_equal_the_library(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: r for r in token_count.count_tokens(df).collect()}
    for k, t in enumerate(TEXTS):
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (got[k].n_bytes, got[k].n_tokens, got[k].over_limit) == (len(t.encode()), n, n > 1024), t[:30]


def test_pieces_equal_the_library_and_round_trip(spark):
    import sentencepiece

    path = P.path("piece_bpe_32k.model")
    own, library = pieces.Codec(path), sentencepiece.SentencePieceProcessor(model_file=path)
    for t, (ids, parity) in zip(TEXTS, own.encode(TEXTS), strict=True):
        assert ids.tolist() == library.encode(t) and parity
        assert own.decode(ids) == t.replace(pieces.MARK, " ")
        assert own.tokenizer.decode(ids.tolist(), skip_special_tokens=False).removeprefix(" ") == own.decode(ids)
    rows = pieces.decode_pieces(pieces.encode_pieces(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string"))).collect()
    assert all(r.decoded == TEXTS[r.doc_id].replace(pieces.MARK, " ") and r.parity for r in rows)


def test_pieces_are_the_tokenizers_and_the_library_only_checks():
    own = pieces.Codec(P.path("piece_bpe_32k.model"))
    segments = [pieces.MARK, pieces.MARK * 3, "x", f"{pieces.MARK}one", *own.segment.findall(own.normal(" ".join(TEXTS[-9:])))]
    assert own.reference(segments) == [own.tokenizer.encode(s, add_special_tokens=False).ids for s in segments]
    expected = own.encode(["one two", "three"])
    other = pieces.Codec(P.path("piece_bpe_32k.model"))
    other.reference = lambda segments: [[5] if s.endswith("two") else x.ids for s, x in zip(segments, other.tokenizer.encode_batch_fast(segments, add_special_tokens=False), strict=True)]
    for (a, parity), (b, _), agree in zip(other.encode(["one two", "three"]), expected, (False, True), strict=True):
        assert a.tolist() == b.tolist() and parity == agree
    lone = pieces.Codec(P.path("piece_bpe_32k.model"))
    asked, library = [], lone.library
    lone.library = type("Spy", (), {"encode": lambda self, x, **k: asked.extend(x) or library.encode(x, **k)})()
    assert lone.encode([" "])[0][1] and pieces.MARK * 2 in asked and lone.encode([""])[0][1]


# ---- media


@settings(max_examples=40, deadline=None)
@given(st.binary(max_size=900))
def test_png_round_trip(data):
    payload = media.payload_of(data)
    assert len(payload) % 192 == 0 and media.decode(media.encode(payload)).tobytes() == payload == data + b" " * (len(payload) - len(data))


def test_png_checks_and_all_filters():
    payload = media.payload_of(PROSE[0].encode())
    x = np.frombuffer(payload, dtype=np.uint8).reshape(-1, 192).astype(np.int64)
    left, up, corner = np.zeros_like(x), np.zeros_like(x), np.zeros_like(x)
    left[:, 3:], up[1:], corner[1:, 3:] = x[:, :-3], x[:-1], x[:-1, :-3]
    p = left + up - corner
    a, b, c = abs(p - left), abs(p - up), abs(p - corner)
    guesses = [0 * x, left, up, (left + up) // 2, np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))]
    for k in range(5):
        rows = np.concatenate([np.full((len(x), 1), k), (x - guesses[k]) % 256], axis=1).astype(np.uint8)
        assert media.unfilter(rows).tobytes() == payload
    png = bytearray(media.encode(payload))
    png[60] ^= 1
    with pytest.raises(media.MediaError):
        media.decode(bytes(png))
    with pytest.raises(media.MediaError):
        media.decode(media.encode(payload)[:-15])


def test_media_features(docs):
    rows = {r.doc_id: r for r in media.media_features(media.media_columns(docs)).collect()}
    for d, t, *_ in ROWS:
        payload = media.payload_of(raw(t))
        assert (rows[d].n_bytes, rows[d].payload_bytes, rows[d].payload_sha256, rows[d].tail_crc32) == (len(raw(t)), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
    assert rows[1].feature == rows[2].feature != rows[8].feature and rows[4].feature == rows[5].feature and len(rows[1].feature) == 16


# ---- shards and mixture


def test_shards_are_balanced_proportional_and_stable(spark, docs):
    big = spark.range(3000).selectExpr("id doc_id", "concat('t', id % 7) text", "if(id % 3 = 0, 'hot', concat('s', id % 11)) source")
    rows = shards.interleave(big).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert sorted(by) == list(range(16)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    mixture_ = Counter((r.shard, r.doc_id % 3 == 0) for r in rows)
    assert max(mixture_[(k, True)] for k in range(16)) - min(mixture_[(k, True)] for k in range(16)) <= 1
    assert rows and sorted(rows) == sorted(shards.interleave(big.repartition(5)).collect())
    small = shards.interleave(docs).collect()
    assert len(small) == len(ROWS) and all(r.size == len(raw(t)) + 1 for r in small for d, t, *_ in ROWS if d == r.doc_id) and {r.text_crc32 for r in small if r.doc_id == 4} == {0}


def brute_targets(sizes):
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    total, open_, target, left = sum(sizes.values()), set(sizes), {}, float(sum(sizes.values()))
    while True:
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] >= 3 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
        left, open_ = total - sum(target.values()), open_ - over
        if not open_:
            return target


def test_mixture_meets_targets(spark, docs):
    big = spark.range(6000).selectExpr("id doc_id", "repeat('w ', cast(id % 37 as int)) text", "case when id % 3 = 0 then 'a' when id % 50 = 1 then 'b' when id % 7 = 0 then 'c' when id % 11 = 0 then 'd' when id % 13 = 0 then null else 'e' end source")
    rows = mixture.mix(big).join(big.select("doc_id", "source"), "doc_id").collect()
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    expected = brute_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(expected[s]) and abs(taken[s] - target[s]) <= 37
    assert sorted(tuple(r) for r in mixture.mix(big).collect()) == sorted(tuple(r) for r in mixture.mix(big.repartition(3)).collect())
    small = {r.doc_id: r for r in mixture.mix(docs).collect()}
    assert small[4].taken == 0 and small[10].size == 30_000 and mixture.mixed(docs).columns == docs.columns


# ---- language and urls


def test_language_held_out_accuracy(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = language.fit(docs.where(~language.held_out()))
    rows = language.predict(docs, model).join(docs.where(language.held_out()), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows) and all(0 <= r.score <= 1 for r in rows)


def test_language_edges(docs, spark):
    model = language.fit(docs)
    got = {r.doc_id: r for r in language.predict(docs, model).collect()}
    assert got[4].lang_pred == "und" == got[5].lang_pred and got[4].score == 0 and got[11].lang_pred == "de"
    digits = spark.createDataFrame([(1, "123 !?")], "doc_id long, text string")
    assert language.predict(digits, model).first().lang_pred == "und"
    for n in (2, 4, 7, 12):
        code = language.codewords(n)
        assert min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= (1 if n == 2 else 2)


def test_url_rules(spark):
    urls = [None, "", "no scheme", "HTTP://WWW.Example.COM/en/7x?q", "http://a.com/en/1#x", "http://com/en/", "http://xcom/en/", "https://example.net/de/8", "x://b.net/de/9?/es/", "http://q.org", "http://q.org/es/?x", "http://a.com:80/en/1", "http://é.com/en/é", "http://a.com/en/"]
    rows = spark.createDataFrame([(k, u) for k, u in enumerate(urls)] * 2, "page_id long, url string")
    got = [tuple(r) for r in url_filter.judge(rows).collect()]
    assert len(got) == 2 * len(urls)
    for k, host, path, rule, verdict in got:
        rest = (urls[k] or "").partition("://")[2] if "://" in (urls[k] or "") else ""
        h = rest.split("/")[0].split("?")[0].split("#")[0]
        p = rest[len(h) :].split("?")[0].split("#")[0]
        h = "".join(c.lower() if c.isascii() else c for c in h)
        fit = [r for r in url_filter.RULES if (h == r.host or h.endswith("." + r.host)) and p.startswith(r.path)]
        best = max(fit, key=lambda r: len(r.host + r.path), default=None)
        assert (host, path, rule, verdict) == (h, p, best and best.host + best.path, best.verdict if best else "allow"), urls[k]


# ---- pipeline


def test_pipeline_stages(spark, data):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{data}/documents.parquet")
    base = {r.doc_id: r.text for r in docs.collect()}
    kept = c.quality_rules(spark, docs, data)
    ids = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == ids and kept.columns == docs.columns
    links = brute_links([(d, base[d]) for d in ids])
    single = c.ngram_jaccard(spark, kept, data)
    assert {r.doc_id for r in single.collect()} == {d for d, (_, k) in links.items() if d == k}
    cut_ = c.suffix_dedup(spark, single, data)
    expected = brute_repeats([(r.doc_id, r.text) for r in single.collect()])
    got = {r.doc_id: r for r in cut_.collect()}
    assert cut_.columns == docs.columns and all(got[d].text == base[d] for d, e in expected.items() if e[1] == 0)
    assert all(hashlib.sha256(raw(got[d].text)).hexdigest() == e[3] for d, e in expected.items() if d in got and got[d].text.isascii())
    mixed = c.mixing(spark, cut_, data)
    taken = {r.doc_id: r.taken // max(r.size, 1) for r in mixture.mix(cut_).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({d: n for d, n in taken.items() if n})
    last = c.sentencepiece(spark, mixed, data).collect()
    assert last and all(r.round_trip and r.parity and r.n_pieces == len(r.ids) for r in last)
    assert [n for n, _ in c.STAGES] == ["quality_rules", "ngram_jaccard", "suffix_dedup", "mixing", "sentencepiece"]
