"""Odd rows: one doc_id with several texts, rows without an id, clashing columns, rewriting models."""

import hashlib
import struct

import numpy as np
import pytest

from tallyforge.llm import jaccard, mixture, pieces, repeats

DDL = "doc_id long, text string, lang string, source string, n_chars long"
BASE = "".join(chr(97 + (k * k * 31 + k // 7) % 26) for k in range(700))


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], DDL)


def kept_bytes(rows):
    """By brute force: of each row, what no 50-byte string of a smaller doc_id covers."""
    first = {}
    for d, t in rows:
        for k in range(len(t) - 49):
            first[t[k : k + 50]] = min(d, first.get(t[k : k + 50], d))
    out = []
    for d, t in rows:
        gone = np.zeros(len(t), dtype=bool)
        for k in range(len(t) - 49):
            if first[t[k : k + 50]] < d:
                gone[k : k + 50] = True
        out.append((d, len(t), "".join(c for c, g in zip(t, gone, strict=True) if not g)))
    return sorted(out)


def test_repeats_of_one_id_with_several_texts(spark):
    tails = "".join(chr(97 + (k * 7 + k * k * 5 + 3) % 26) for k in range(700))
    rows = [(0, BASE), (1, "z" * 40 + BASE), (1, "short " * 10), (1, tails), (2, tails[:300] + "." + BASE[100:400]), (2, BASE), (2, BASE), (3, "q" + BASE[5:90] + "short " * 10)]
    got = repeats.remove_repeats(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_bytes, bytes(r.kept).decode()) for r in got) == kept_bytes(rows)
    lines = [(k, (BASE[:60] + "\n") * 30 + str(k)) for k in range(4)]  # an anchor in many places of a text
    got = repeats.remove_repeats(frame(spark, lines)).collect()
    assert sorted((r.doc_id, r.n_bytes, bytes(r.kept).decode()) for r in got) == kept_bytes(lines)


def test_links_of_one_id_with_several_texts_and_of_rows_without_one(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    rows = [(7, a), (7, b), (9, a), (9, a), (3, b + " more"), (None, c), (None, c + " end"), (12, a + " tail"), (None, None), (4, "")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.link_classes(frame(spark, rows)).collect()), key=str)
    expected = [(7, 26, 7), (7, 26, 3), (9, 26, 7), (9, 26, 7), (3, 27, 3), (None, 26, None), (None, 27, None), (12, 27, 7), (None, 0, None), (4, 0, 4)]
    assert got == sorted(expected, key=str)
    left = jaccard.one_of_each(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == sorted([(7, a), (3, b + " more"), (None, c), (None, c + " end"), (None, None), (4, "")], key=str)


def test_stages_take_clashing_columns_and_rows_without_ids(spark):
    names = ("key_", "copies_", "digest_", "row_", "doc", "tid", "body", "class", "first", "node", "label", "home", "own_", "rest", "found", "copies")
    rows = [(k if k % 5 else None, f"{BASE[k:k + 200]} word{k} and {k} more", "en", f"s{k % 2}", 9, *names) for k in range(20)]
    docs = spark.createDataFrame(rows, f"{DDL}, " + ", ".join(f"{n} string" for n in names))
    for stage in (mixture.mixed, jaccard.one_of_each, repeats.without_repeats):
        out = stage(docs)
        made = out.collect()
        assert out.columns == docs.columns and made and all(tuple(r)[5:] == names for r in made), stage


def test_inclusion_is_unequal_and_long_documents_are_favoured(spark):
    rows = [(k, " ".join(["w"] * (400 if k % 2 else 25)), "en", "b" if k % 4 < 2 else "a", 0) for k in range(1, 1001)]
    made = mixture.mix(spark.createDataFrame(rows, DDL), weights=(9, 1)).collect()
    source = [r for r in made if r.doc_id % 4 < 2]
    target, words = source[0].target, source[0].source_size
    assert target < words and abs(sum(r.taken for r in source) - target) <= 400
    rate = target / sum(r.size * (1 + int(r.size**0.5)) for r in source)
    share = {size: np.mean([r.taken > 0 for r in source if r.size == size]) for size in (25, 400)}
    assert abs(share[400] - 21 * rate) < 0.08 and abs(share[25] - 6 * rate) < 0.08 and share[400] > 2 * share[25]


def test_certain_documents_are_taken(spark):
    rows = [(k, " ".join(["w"] * 10), "en", "s" if k else "other", 0) for k in range(40)]
    docs = spark.createDataFrame(rows, DDL).selectExpr("*", "if(doc_id in (3, 17), 1e6, 1e-3) w")
    own = {r.key_: r for r in mixture.plan(docs, weights=(1, 1), weight="w").collect()}
    least = min(r.copies_ for r in own.values() if r.key_)
    assert own[3].copies_ >= least and own[17].copies_ >= least and all(r.odds_ > own[3].odds_ for r in own.values() if r.key_ not in (0, 3, 17))


def field(number, value):
    """A protobuf field: bytes, float or int."""

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    if isinstance(value, bytes):
        return varint(number << 3 | 2) + varint(len(value)) + value
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3) + varint(value)


def unigram(charsmap=b"", squeeze=1):
    """A small unigram model with byte fallback."""
    words = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{k:02X}>", 0.0, 6) for k in range(256)]
    parts = ["▁", "▁the", "the", "▁a", "re", "er", "▁re", "on", "and", "▁and", "ing", "▁10", "0", "1", "▁fi", "fi", "nd", *"abcdefghijklmnopqrstuvwxyz.,"]
    words += [(w, -2.0 - 0.37 * k - 0.011 * k * k, 1) for k, w in enumerate(parts)]
    out = b"".join(field(1, field(1, w.encode()) + field(2, s) + field(3, k)) for w, s, k in words)
    trainer = field(3, 1) + field(4, len(words)) + field(35, 1) + field(40, 0) + field(41, 1) + field(42, 2)
    return out + field(2, trainer) + field(3, field(1, b"own") + field(2, charsmap) + field(3, 1) + field(4, squeeze) + field(5, 1))


ODD = ["", " ", "the and  ringing", "  a b   c ", "find ﬁnd １００ the　end", "x\ny\tz", "é ж 語 🙂", "there, and there.", "a" * 300, "the and"]


@pytest.mark.parametrize("rewrites", [False, True])
def test_unigram_models_and_their_normaliser(tmp_path, rewrites):
    import sentencepiece

    charsmap = b""
    if rewrites:
        rules = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto()
        charsmap = dict(pieces.fields(dict(pieces.fields(rules))[3]))[2]
        assert len(charsmap) > 1000
    for squeeze in (0, 1):
        path = tmp_path / f"own{squeeze}.model"
        path.write_bytes(unigram(charsmap, squeeze))
        own, library = pieces.Codec(str(path)), sentencepiece.SentencePieceProcessor(model_file=str(path))
        for t, (ids, same) in zip(ODD, own.encode(ODD), strict=True):
            assert same and ids.tolist() == library.encode(t), (squeeze, t)
            assert own.decode(ids) == library.decode(ids.tolist()), (squeeze, t)


def test_digests_columns(spark):
    texts = ["one two", None, "", "ünï ▁ x", "a" * 500, "one two"]
    import public_tokenizers as P
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    for r in pieces.digests(frame(spark, list(enumerate(texts)))).collect():
        t = texts[r.doc_id] or ""
        ids = library.encode(t)
        back = t.replace("▁", " ")
        assert (r.n_bytes, r.n_pieces, r.ids_sha256) == (len(t.encode()), len(ids), hashlib.sha256(np.array(ids, dtype="<i4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest() and r.round_trip and r.parity


def test_memory_of_segments_is_bounded_and_changes_nothing(monkeypatch):
    import public_tokenizers as P

    monkeypatch.setattr(pieces, "REMEMBERED", 20)
    own, other = pieces.Codec(P.path("piece_bpe_32k.model")), pieces.Codec(P.path("piece_bpe_32k.model"))
    texts = [f"word{k} and word{k % 3} more{k}" for k in range(60)]
    some = [x for k in range(0, 60, 4) for x in own.encode(texts[k : k + 4])]
    monkeypatch.setattr(pieces, "REMEMBERED", 10_000)
    assert [a.tolist() for a, _ in some] == [a.tolist() for a, _ in other.encode(texts)] and len(own.seen) <= 40
