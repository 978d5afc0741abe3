"""Importance resampling to a target distribution, by word tries that live in one partition.

Words are runs of digits, a-z (after lower-casing A-Z) and characters beyond ASCII; features are all
runs of 1 to `longest` consecutive words joined by a space, repeats counted. A feature's bucket is
the CRC-32 of its bytes modulo `buckets`. The gain of a bucket is the logarithm of its smoothed share
in the target over its share in the corpus; a document's weight is the floored mean of the gains of its
features. With Gumbel noise of the document's id added, the greatest scores are a weighted sample without
replacement.

A task keeps a trie whose edges are words: the path of a feature's words leads to its node, which
holds the CRC state of the bytes so far and, in the first pass, the feature's count. A child's state
follows from its parent's, a space and the word, by CRC's linearity, without touching the earlier
bytes again. All the paths of a batch descend one level at a time, as sorted numpy keys of (parent,
word). When a task's trie has NODES nodes, its counts are added to the task's buckets and it starts
anew, so memory is bounded and no count is lost. Tasks send at most `buckets` sums. In the second
pass nodes hold the gain of their bucket, and a document adds up those on the paths that it walks.

The draw ranks by (score descending, doc_id ascending) with bucket sums and windows in buckets, so
no task holds all rows. The driver holds `buckets` sums and gains.

Null and empty texts have no words, no features and weight 0. A null doc_id is hashed as `seed:`
and comes first among ties. Long texts are taken in slices cut between words, with the runs across the
cuts; a word is always whole. Repeated rows each get a row and are ranked one by one. An empty table gives no rows; an empty
target gives gains of its smoothing alone. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, freed, pieces, table, texts_of
from .order import before

BUCKETS, LONGEST, SEED, PERCENT, LEAST_WORDS = 10_000, 2, 7, 25, 20
#: Nodes of a task's trie before it is emptied into the buckets, and bytes of a text in a slice.
NODES, SLICE = 1_000_000, 1 << 21
_WORD = bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b in _WORD else 32 for b in range(256))


def _step_tables(most: int = 24) -> np.ndarray:
    """tables[i][k][b]: what byte k of a CRC becomes when 2^i zero bytes follow it."""
    one = np.array([zlib.crc32(b"\0", b << 8 * k) ^ zlib.crc32(b"\0", 0) for k in range(4) for b in range(256)], dtype=np.uint32).reshape(4, 256)
    out = [one]
    for _ in range(most - 1):
        out.append(_advance(out[-1], out[-1].ravel()).reshape(4, 256))
    return np.array(out)


def _advance(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return tables[0][crc & 255] ^ tables[1][crc >> 8 & 255] ^ tables[2][crc >> 16 & 255] ^ tables[3][crc >> 24]


_STEPS = _step_tables()


def joined_crc(left: np.ndarray, right: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of two byte strings laid end to end, from their CRCs and the size of the second."""
    left = left.copy()
    for i in range(int(size.max(initial=0)).bit_length()):
        moved = np.flatnonzero(size >> i & 1)
        tables = _STEPS[i] if i < len(_STEPS) else _STEPS[-1]
        for _ in range(1 if i < len(_STEPS) else 1 << (i - len(_STEPS) + 1)):
            left[moved] = _advance(tables, left[moved])
    return left ^ right


class Words(dict):
    """Words by their number; a new word gets the next one and waits in `new`."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class Trie:
    """levels[d] holds the nodes of d + 2 words, sorted by (parent, word): keys, states, worth."""

    def __init__(self, longest: int, buckets: int, gains: np.ndarray | None = None):
        self.longest, self.buckets, self.gains = longest, buckets, gains
        self.total = np.zeros(buckets, dtype=np.int64)
        self.begin()

    def begin(self) -> None:
        self.words = Words()
        self.size, self.state = np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.spaced = np.zeros(0, np.uint32)  # state of a space and the word
        self.worth = np.zeros(0, np.int64)
        self.levels = [(np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(self.longest - 1)]

    def empty(self) -> None:
        """Add counts to the buckets, forget all nodes."""
        if self.gains is None:
            for state, worth in [(self.state, self.worth), *((s, w) for _, s, w, _ in self.levels)]:
                self.total += np.bincount(state % np.uint32(self.buckets), weights=worth, minlength=self.buckets).astype(np.int64)
        self.begin()

    def nodes(self) -> int:
        return len(self.state) + sum(len(x[0]) for x in self.levels)

    def first(self, state: np.ndarray) -> np.ndarray:
        """What new nodes hold."""
        return np.zeros(len(state), np.int64) if self.gains is None else self.gains[state % np.uint32(self.buckets)]

    def grow(self) -> None:
        """Nodes of the words that came since."""
        new, self.words.new = self.words.new, []
        size = np.fromiter(map(len, new), np.int64, len(new))
        state = np.fromiter(map(zlib.crc32, new), np.uint32, len(new))
        space = np.full(len(new), zlib.crc32(b" "), np.uint32)
        self.size, self.state = np.append(self.size, size), np.append(self.state, state)
        self.spaced = np.append(self.spaced, joined_crc(space, state, size))
        self.worth = np.append(self.worth, self.first(state))

    def descend(self, d: int, parent: np.ndarray, word: np.ndarray, count: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Nodes (by identity) of d + 2 words below `parent`, and what they hold. Identities are
        given in the order in which nodes come, so they stay when the sorted keys grow."""
        keys, state, worth, own = self.levels[d]
        asked, place, n = np.unique(parent << 32 | word, return_inverse=True, return_counts=True)
        at = np.searchsorted(keys, asked)
        known = np.zeros(len(asked), bool)
        inside = at < len(keys)
        known[inside] = keys[at[inside]] == asked[inside]
        new = asked[~known]
        if len(new):
            above, letter = new >> 32, new & 0xFFFFFFFF
            up = self.state if d == 0 else self.by_identity(d - 1)
            made = joined_crc(up[above], self.spaced[letter], self.size[letter] + 1)
            spot = at[~known]
            own = np.insert(own, spot, np.arange(len(keys), len(keys) + len(new)))
            keys, state, worth = np.insert(keys, spot, new), np.insert(state, spot, made), np.insert(worth, spot, self.first(made))
            at = np.searchsorted(keys, asked)
        if self.gains is None and count:
            worth[at] += n
        self.levels[d] = (keys, state, worth, own)
        return own[at][place], worth[at][place]

    def by_identity(self, d: int) -> np.ndarray:
        _, state, _, own = self.levels[d]
        out = np.zeros(len(state), np.uint32)
        out[own] = state
        return out

    def walk(self, words: list[bytes], row: np.ndarray, old: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, gain) of each feature that ends in words[old:]; row: the text of each word. In the
        first pass the features are counted instead and the gains are of no use."""
        letter = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        self.grow()
        if self.gains is None:
            self.worth += np.bincount(letter[old:], minlength=len(self.worth))
        rows, gains = [row[old:]], [self.worth[letter[old:]]]
        node = letter
        place = np.arange(len(letter))
        for d in range(self.longest - 1):
            # a path goes on where the next word is of the same text, and counts if its last word is new
            on = np.flatnonzero((place + 1 < len(letter)) & (row[np.minimum(place + 1, len(letter) - 1)] == row[place]))
            place = place[on] + 1
            fresh = place >= old
            below = np.zeros(len(place), np.int64)
            if fresh.any():
                below[fresh], worth = self.descend(d, node[on][fresh], letter[place[fresh]])
                rows.append(row[place[fresh]])
                gains.append(worth)
            stale = ~fresh
            if stale.any() and d + 2 < self.longest:  # known from the slice before, not counted again
                below[stale] = self.descend(d, node[on][stale], letter[place[stale]], count=False)[0]
            node = below
        return np.concatenate(rows), np.concatenate(gains)


def slices(raw: bytes) -> Iterator[bytes]:
    """Pieces of a text that end between words."""
    at = 0
    while at < len(raw):
        end = at + SLICE
        if end < len(raw):
            found = raw.find(b" ", end)
            end = len(raw) if found < 0 else found
        yield raw[at:end]
        at = end


def chunks(texts: list[bytes], longest: int) -> Iterator[tuple[list[bytes], np.ndarray, int]]:
    """(words, text of each word, how many of them at the start were in the chunk before)."""
    held: list[bytes] = []
    rows: list[int] = []
    sizes: list[int] = []
    amount, old = 0, 0
    for i, raw in enumerate(texts):
        for part in slices(raw.translate(LETTERS)):
            words = part.split()
            held += words
            rows.append(i)
            sizes.append(len(words))
            amount += len(part)
            if amount >= SLICE:
                yield held, np.repeat(rows, sizes), old
                own = sum(sizes[k] for k in range(len(rows)) if rows[k] == i)
                keep = min(longest - 1, own)
                held = held[len(held) - keep :]
                rows, sizes, amount, old = [i], [keep], 0, keep
    if len(held) > old:
        yield held, np.repeat(rows, sizes), old


def bucket_sums(docs: DataFrame, text: str, longest: int, buckets: int) -> np.ndarray:
    """Features in each bucket, over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(longest, buckets)
        for batch in batches:
            for words, row, old in _chunks_of(batch, longest):
                trie.walk(words, row, old)
                if trie.nodes() > NODES:
                    trie.empty()
        trie.empty()
        used = np.flatnonzero(trie.total)
        yield pa.record_batch([pa.array(used.astype(np.int32)), pa.array(trie.total[used])], names=["bucket", "n"])

    made = docs.select(F.col(text).cast("string").alias("text_")).mapInArrow(freed(run), "bucket int, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for r in made.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most `buckets` rows
        out[r.bucket] = r.n
    return out


def _chunks_of(batch: pa.RecordBatch, longest: int) -> Iterator[tuple[list[bytes], np.ndarray, int]]:
    column = batch.column("text_")
    for start, stop in pieces(column):
        for words, row, old in chunks(texts_of(column.slice(start, stop - start)), longest):
            yield words, row + start, old


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the logarithm of each bucket's smoothed share in the target over that in the corpus, floored."""
    s, t, n = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((int(b) + 1) * (s + n) / ((int(a) + 1) * (t + n)))) for a, b in zip(corpus, target, strict=True)], dtype=np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, text: str, key: str, longest: int) -> DataFrame:
    """key_, n_words, n_features, weight."""
    own = docs.select(F.col(key).alias("key_"), F.col(text).cast("string").alias("text_"))
    kind = own.schema["key_"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(longest, len(gain), gain)
        for batch in batches:
            n = batch.num_rows
            words, features, sums = (np.zeros(n, dtype=np.int64) for _ in range(3))
            for said, row, old in _chunks_of(batch, longest):
                words += np.bincount(row[old:], minlength=n)
                at, worth = trie.walk(said, row, old)
                features += np.bincount(at, minlength=n)
                sums += np.bincount(at, weights=worth, minlength=n).astype(np.int64)  # whole numbers below 2^53
                if trie.nodes() > NODES:
                    trie.empty()
            weight = np.where(features > 0, sums // np.maximum(features, 1), 0)
            yield pa.record_batch([batch.column("key_"), pa.array(words), pa.array(features), pa.array(weight)], names=["key_", "n_words", "n_features", "weight"])

    return own.mapInArrow(freed(run), f"key_ {kind}, n_words long, n_features long, weight long")


def noise(key: Column, seed: int) -> Column:
    """1000 times a Gumbel number of the key, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text", key: str = "doc_id",
    longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED, percent: int = PERCENT, least_words: int = LEAST_WORDS,
) -> DataFrame:
    """One row per document: key, n_features, weight, score, rank (null if not drawn)."""
    gain = gains(bucket_sums(docs, text, longest, buckets), bucket_sums(target, target_text, longest, buckets))
    rows = weighed(docs, gain, text, key, longest)
    rows = rows.withColumn("score", F.col("weight") + noise(F.col("key_"), seed))
    rows = cut(rows.withColumn("in_", (F.col("n_words") >= least_words).cast("long")), "scored", tidy=False)
    about = rows.agg(F.sum("in_").alias("n"), F.avg("score").alias("middle"), F.stddev_pop("score").alias("spread")).first()
    drawn = percent * (about.n or 0) // 100
    # an even spread of the order over (0, 1), best first
    wide = (about.spread or 0.0) * math.sqrt(3) / math.pi or 1.0
    rows = rows.withColumn("at_", 1 / (1 + F.exp((F.col("score") - F.lit(about.middle or 0.0)) / F.lit(wide))))
    rows = before(rows, [], "at_", [F.desc("score"), F.col("key_").asc_nulls_first()], F.col("in_"), "before_")
    rank = F.when((F.col("in_") == 1) & (F.col("before_") < drawn), F.col("before_") + 1)
    return rows.select(F.col("key_").alias(key), "n_features", "weight", "score", rank.cast("long").alias("rank"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
