"""SentencePiece models on the tokenizers library: parse, rebuild, encode, decode, verify.

The model's protobuf is parsed with a small wire-format reader, and an equal tokenizer is built:
the metaspace marker in place of spaces (and before the text, where the model adds it), unigram
scores or merges ordered by score, and byte fallback. Batches are encoded by the library's own
threads. No piece has a marker after another character, so no piece crosses from a character to a
marker; texts are cut there first, which changes no result and lets equal words share their work.
(A model with such a piece, or without a space marker, is encoded uncut.) The normaliser is rebuilt
too: its character map, and the squeezing of spaces; such models do not give the text back as it
was, so `round_trip` tells which texts they do. Models with user-defined pieces are refused.

Parity: each segment a worker has not met is encoded by the sentencepiece library too, lone markers
included (with a normaliser that rewrites, each whole text). The ids are the tokenizer's; where the
two differ, `parity` is false. Texts are whole; null and empty ones have no pieces. Repeated rows
each get a row, an empty table gives an empty result, other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import freed, pieces, table, texts_of

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # fixed values of the format
UNIGRAM, BPE = 1, 2
#: Distinct segments that a worker remembers; threads of one worker.
REMEMBERED = 250_000
THREADS = 2
_CACHE: dict[str, Codec] = {}


def varint(data: bytes, at: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        b = data[at]
        out |= (b & 127) << shift
        at, shift = at + 1, shift + 7
        if b < 128:
            return out, at


def fields(data: bytes) -> Iterator[tuple[int, int | bytes | float]]:
    """(number, value) of each field of a protobuf message."""
    at = 0
    while at < len(data):
        tag, at = varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(data, at)
        elif kind == 2:
            n, at = varint(data, at)
            value, at = data[at : at + n], at + n
        elif kind == 5:
            (value,), at = struct.unpack_from("<f", data, at), at + 4
        elif kind == 1:
            (value,), at = struct.unpack_from("<d", data, at), at + 8
        else:
            raise ValueError(f"wire type {kind}")
        yield tag >> 3, value


@dataclass
class Model:
    """What encoding needs of a model file."""

    words: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    prefix: bool = True
    squeeze: bool = True
    escape: bool = True

    @classmethod
    def parse(cls, data: bytes) -> Model:
        out = cls()
        for number, value in fields(data):
            if number == 1:
                own = dict(fields(value))
                out.words.append(own.get(1, b"").decode())
                out.scores.append(own.get(2, 0.0))
                out.kinds.append(own.get(3, NORMAL))
            elif number == 2:
                own = dict(fields(value))
                out.kind, out.byte_fallback = own.get(3, UNIGRAM), bool(own.get(35, 0))
            elif number == 3:
                own = dict(fields(value))
                out.charsmap, out.prefix = own.get(2, b""), bool(own.get(3, 1))
                out.squeeze, out.escape = bool(own.get(4, 1)), bool(own.get(5, 1))
        return out

    def merges(self) -> list[tuple[str, str]]:
        """Pairs that make a piece, best score first. Of pairs that make pieces of equal score,
        the longer left part comes first: what stands further left then grows first."""
        known = {w: s for w, s, k in zip(self.words, self.scores, self.kinds, strict=True) if k in (NORMAL, USER)}
        pairs = [(-s, -i, w[:i], w[i:]) for w, s in known.items() for i in range(1, len(w)) if w[:i] in known and w[i:] in known]
        return [(a, b) for *_, a, b in sorted(pairs)]


class Codec:
    def __init__(self, path: str, threads: int = THREADS):
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        import sentencepiece
        from tokenizers import Tokenizer, decoders, models, normalizers

        with open(path, "rb") as f:
            self.raw = f.read()
        self.model = m = Model.parse(self.raw)
        if not m.escape or USER in m.kinds:
            raise ValueError("models without space markers or with user-defined pieces are not supported")
        self.rules = normalizers.Precompiled(m.charsmap) if m.charsmap else None
        unknown = m.kinds.index(UNKNOWN)
        if m.kind == UNIGRAM:
            core = models.Unigram(list(zip(m.words, m.scores, strict=True)), unk_id=unknown, byte_fallback=m.byte_fallback)
        elif m.kind == BPE:
            core = models.BPE({w: i for i, w in enumerate(m.words)}, m.merges(), unk_token=m.words[unknown], fuse_unk=True, byte_fallback=m.byte_fallback)
        else:
            raise ValueError(f"model type {m.kind}")
        self.tokenizer = Tokenizer(core)
        self.tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
        self.bytes = [bytes([int(w[1:-1], 16)]) if k == BYTE else b"" if k == CONTROL else w.replace(MARK, " ").encode() for w, k in zip(m.words, m.kinds, strict=True)]
        # a field that comes last counts: the normaliser's (3) prefix (3) is off, as segments have their markers
        self.rewrites = bool(m.charsmap or m.squeeze)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=self.raw + (b"" if self.rewrites else b"\x1a\x02\x18\x00"), add_bos=False, add_eos=False)
        crosses = any(re.search(f"[^{MARK}]{MARK}", w) for w in m.words)
        self.segment = re.compile("(?s:.+)" if crosses else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.seen: dict[str, bytes] = {}
        self.odd: set[str] = set()

    def normal(self, text: str) -> str:
        text = self.rules.normalize_str(text) if self.rules else text
        text = re.sub(" {2,}", " ", text).strip(" ") if self.model.squeeze else text
        text = text.replace(" ", MARK)
        return MARK + text if text and self.model.prefix else text

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, bool]]:
        """Ids of each text, and whether both libraries agree on all its segments."""
        cuts = [self.segment.findall(self.normal(t)) for t in texts]
        used = {s for c in cuts for s in c}
        new = used - self.seen.keys()
        if new:
            made, odd = self.learn(list(new))
            if len(self.seen) + len(made) > REMEMBERED:  # forget what these texts do not use
                self.seen = {s: self.seen[s] for s in used - new}
                self.odd &= used
            self.seen.update(made)
            self.odd |= odd
        ids = [np.frombuffer(b"".join(map(self.seen.__getitem__, c)), dtype=np.int32) for c in cuts]
        if self.rewrites:
            return [(a, a.tolist() == b) for a, b in zip(ids, self.reference(texts), strict=True)]
        return [(a, not self.odd or self.odd.isdisjoint(c)) for a, c in zip(ids, cuts, strict=True)]

    def learn(self, segments: list[str]) -> tuple[dict[str, bytes], set[str]]:
        """Ids of each segment as bytes of int32, and the segments on which the libraries differ."""
        ours = [x.ids for x in self.tokenizer.encode_batch_fast(segments, add_special_tokens=False)]
        theirs = ours if self.rewrites else self.reference(segments)
        odd = {s for s, a, b in zip(segments, ours, theirs, strict=True) if a != b}
        return {s: array("i", a).tobytes() for s, a in zip(segments, ours, strict=True)}, odd

    def reference(self, segments: list[str]) -> list[list[int]]:
        """The sentencepiece library's ids, which only check the tokenizer's."""
        return self.library.encode(segments, num_threads=1)

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: pieces with spaces for markers, byte pieces as the bytes they stand for.
        Bytes that are no UTF-8 become U+FFFD, as in the libraries."""
        text = b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.model.prefix and text[:1] == " " else text


def codec(path: str | None) -> Codec:
    import public_tokenizers

    path = path or public_tokenizers.path("piece_bpe_32k.model")
    if path not in _CACHE:
        _CACHE[path] = Codec(path)
    return _CACHE[path]


def forget() -> None:
    """Drop the codecs that a task has built."""
    _CACHE.clear()


def encode_pieces(docs: DataFrame, model: str | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, n_bytes, ids (array of int), parity. model: a path every executor has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            for a, b in pieces(batch.column(1), 2 << 20):
                raw = texts_of(batch.column(1).slice(a, b - a))
                made = own.encode([x.decode("utf-8", "replace") for x in raw])
                ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(x) for x, _ in made)]), pa.int32()), pa.array(np.concatenate([x for x, _ in made]) if made else [], pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(map(len, raw), pa.int64()), ids, pa.array([ok for _, ok in made])], [key, "n_bytes", "ids", "parity"])

    return docs.select(key, text).mapInArrow(freed(run, forget), f"{key} long, n_bytes long, ids array<int>, parity boolean")


def decode_pieces(encoded: DataFrame, model: str | None = None, key: str = "doc_id") -> DataFrame:
    """One row per row of encode_pieces: key, n_bytes, ids, parity, decoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            ids, parity = batch.column(2), batch.column(3)
            for i in range(0, len(batch), 256):
                part = ids.slice(i, 256)
                decoded = [own.decode(np.asarray(x.values)) for x in part]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 256), batch.column(1).slice(i, 256), part, parity.slice(i, 256), pa.array(decoded, pa.string())], [key, "n_bytes", "ids", "parity", "decoded"])

    return encoded.select(key, "n_bytes", "ids", "parity").mapInArrow(freed(run, forget), f"{key} long, n_bytes long, ids array<int>, parity boolean, decoded string")


def digests(docs: DataFrame, model: str | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode, decode again from the ids, and reduce both to digests, in one pass over each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            for a, b in pieces(batch.column(1), 2 << 20):
                raw = texts_of(batch.column(1).slice(a, b - a))
                rows = []
                for x, (ids, parity) in zip(raw, own.encode([x.decode("utf-8", "replace") for x in raw]), strict=True):
                    back = own.decode(ids).encode()
                    rows.append((len(x), len(ids), hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest(), hashlib.sha256(back).hexdigest(), back == x.replace(MARK.encode(), b" "), parity))
                columns = list(zip(*rows, strict=True)) or [()] * 6
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], [key, "n_bytes", "n_pieces", "ids_sha256", "decoded_sha256", "round_trip", "parity"])

    return docs.select(key, text).mapInArrow(freed(run, forget), f"{key} long, n_bytes long, n_pieces long, ids_sha256 string, decoded_sha256 string, round_trip boolean, parity boolean")


def tokenised(docs: DataFrame, model: str | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, n_bytes, n_pieces, ids, round_trip (the ids decode to the text), parity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            for a, b in pieces(batch.column(1), 2 << 20):
                raw = texts_of(batch.column(1).slice(a, b - a))
                made = own.encode([x.decode("utf-8", "replace") for x in raw])
                sizes = [len(ids) for ids, _ in made]
                ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(np.concatenate([x for x, _ in made]) if made else [], pa.int32()))
                back = [own.decode(x).encode() == r.replace(MARK.encode(), b" ") for (x, _), r in zip(made, raw, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(map(len, raw), pa.int64()), pa.array(sizes, pa.int64()), ids, pa.array(back, pa.bool_()), pa.array([ok for _, ok in made], pa.bool_())], [key, "n_bytes", "n_pieces", "ids", "round_trip", "parity"])

    return docs.select(key, text).mapInArrow(freed(run, forget), f"{key} long, n_bytes long, n_pieces long, ids array<int>, round_trip boolean, parity boolean")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
