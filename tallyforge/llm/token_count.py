"""Token counts of a byte-level BPE by rank-synchronous merging of ragged numpy arrays.

The texts of a batch are split into pre-tokens by the tokenizer's own pattern; those of segments
that the worker does not remember become one ragged array of symbols (all
their bytes, laid end to end, with the sequence each belongs to). In each round every sequence
finds its lowest-ranked adjacent pair and all its occurrences are merged at once, from left to
right where they overlap; sequences without a mergeable pair leave. What survives is the count.

Null and empty texts have no tokens. A special token's string inside a text counts as that one
token, as the library does by default. Very long texts and pre-tokens are handled whole: a
round costs time in proportion to the symbols that are still active. Repeated rows each get a
row, an empty table gives an empty result, other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import pieces, random_table, table, texts_of

#: Distinct segments whose counts a worker remembers, and slots of the pair table as a power of two.
REMEMBERED = 1_000_000
BITS = 18
CUT = re.compile(r"(?<=\S)(?= \S)")
LIMIT = 1024
_CACHE: dict[str, Counter] = {}


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pairs:
    """Rank of a pair of symbols, by open addressing over the merge list; `none` if it has none."""

    def __init__(self, keys: np.ndarray):
        self.none = len(keys)
        self.levels: list[tuple[np.uint64, np.ndarray, np.ndarray]] = []
        rest, seed = np.arange(len(keys)), 1
        while len(rest):
            factor = random_table(1, seed)[0] | np.uint64(1)
            slot = self.slot(keys[rest], factor)
            _, first = np.unique(slot, return_index=True)
            own, rank = np.full(1 << BITS, -1, dtype=np.int64), np.full(1 << BITS, self.none, dtype=np.int64)
            own[slot[first]], rank[slot[first]] = keys[rest[first]], rest[first]
            self.levels.append((factor, own, rank))
            rest, seed = np.delete(rest, first), seed + 1

    @staticmethod
    def slot(keys: np.ndarray, factor: np.uint64) -> np.ndarray:
        return (keys.astype(np.uint64) * factor >> np.uint64(64 - BITS)).astype(np.int64)

    def rank(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), self.none, dtype=np.int64)
        for factor, own, rank in self.levels:
            at = self.slot(keys, factor)
            np.copyto(out, rank[at], where=own[at] == keys)
        return out


class Counter:
    """Counts tokens as the tokenizer of one .json file does."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        vocab = model["vocab"]
        self.first = np.zeros(256, dtype=np.int64)
        for letter, b in letters.items():
            self.first[b] = vocab[letter]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.pairs = Pairs(np.array([self.key(vocab[a], vocab[b]) for a, b in merges], dtype=np.int64))
        self.made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        self.pattern = regex.compile(pattern)
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.seen: dict[str, int] = {}

    @staticmethod
    def key(a, b):
        return a << 20 | b

    def count(self, texts: list[str]) -> list[int]:
        found = [self.split(t) for t in texts]
        used = {w for words, _ in found for w in words}
        new = used - self.seen.keys()
        if new:
            made = self.learn(list(new))
            if len(self.seen) + len(made) > REMEMBERED:  # forget what these texts do not use
                self.seen = {w: self.seen[w] for w in used - new}
            self.seen.update(made)
        return [sum(map(self.seen.__getitem__, words)) + extra for words, extra in found]

    def split(self, text: str) -> tuple[list[str], int]:
        """Segments and the number of special tokens. A space between two characters that are
        no white space always starts a pre-token, so the text is cut there, and whole segments,
        with the space, are remembered."""
        if self.special is None or not self.special.search(text):
            return CUT.split(text), 0
        parts = self.special.split(text)
        return [w for part in parts for w in CUT.split(part)], len(parts) - 1

    def learn(self, segments: list[str]) -> dict[str, int]:
        words = [self.pretokens(x) for x in segments]
        distinct = list({w for x in words for w in x})
        n = dict(zip(distinct, self.merged(distinct).tolist(), strict=True)) if distinct else {}
        return dict(zip(segments, [sum(map(n.__getitem__, x)) for x in words], strict=True))

    def pretokens(self, segment: str) -> list[str]:
        """The pattern's matches; plain words, alone or before one mark, need no search."""
        body = segment.removeprefix(" ")
        if body.isalpha():
            return [segment]
        if body[:-1].isalpha() and body[-1] in ".,;:!?":
            return [segment[:-1], segment[-1]]
        return self.pattern.findall(segment)

    def merged(self, words: list[str]) -> np.ndarray:
        """Symbols left of each word."""
        raw = [w.encode() for w in words]
        size = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        ids = self.first[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        seq = np.repeat(np.arange(len(raw)), size)
        left, none = size.copy(), self.pairs.none

        def ranked(at: np.ndarray) -> np.ndarray:
            """Ranks of the pairs that begin at these places; the last symbol begins none."""
            after = np.minimum(at + 1, len(ids) - 1)
            inside = (seq[at] == seq[after]) & (at < after)
            return np.where(inside, self.pairs.rank(self.key(ids[at], ids[after])), none)

        rank = ranked(np.arange(len(ids)))
        while len(ids):
            starts = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            low = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(ids))))
            keep = low < none
            # of occurrences that overlap, every second one counts, from the left
            run = np.flatnonzero((rank == low) & keep)
            if not len(run):
                break
            fresh = np.append(True, np.diff(run) > 1)
            begin = run[fresh][np.cumsum(fresh) - 1]
            run = run[(run - begin) % 2 == 0]
            left -= np.bincount(seq[run], minlength=len(left))
            ids[run] = self.made[rank[run]]
            keep[run + 1] = False
            moved = np.cumsum(keep) - 1
            ids, seq, rank, run = ids[keep], seq[keep], rank[keep], moved[run]
            rank[run] = ranked(run)
            before = np.maximum(run - 1, 0)
            rank[before] = ranked(before)
        return left


def counter(path: str | None, pattern: str | None) -> Counter:
    import public_tokenizers

    path, pattern = path or public_tokenizers.path("byte_bpe_50k.json"), pattern or public_tokenizers.PATTERN
    if path not in _CACHE:
        _CACHE[path] = Counter(path, pattern)
    return _CACHE[path]


def count_tokens(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None, limit: int = LIMIT, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, n_bytes, n_tokens, over_limit. vocabulary: a path every executor has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(vocabulary, pattern)
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                raw = texts_of(batch.column(1).slice(a, b - a))
                n = own.count([x.decode("utf-8", "replace") for x in raw])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(map(len, raw), pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                    [key, "n_bytes", "n_tokens", "over_limit"],
                )

    return docs.select(key, text).mapInArrow(run, f"{key} long, n_bytes long, n_tokens long, over_limit boolean")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
