"""Language identification by error-correcting output codes over binary n-gram features.

A text's features are the hashed byte n-grams (of its lower-cased UTF-8 form) that occur in it.
Each language has a codeword (the exhaustive code up to 7 languages, seeded random columns
beyond), and for each bit a log-odds classifier, fitted from the counts of training documents
that hold an n-gram, says which half of the languages a text belongs to. The bit's threshold and
its accuracy on each language come from histograms of training margins; decoding takes the
language whose codeword has the least exponential loss, each bit weighted by that accuracy.
`ambiguous` marks texts whose best two languages are closer than AMBIGUOUS in probability.

Fitting uses at most about PER_LANGUAGE documents of each language, drawn by a hash of doc_id;
prediction covers every row and whole texts. Texts that are null or without a letter are `und`
with score 0, as is everything if there is nothing to learn from; so is an empty table's result
empty. Null languages are not learned. lang, source and doc_id are no inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pieces, table, texts_of

#: Expected number of training documents a language may give.
PER_LANGUAGE = 4000
BITS, SIZES = 15, (1, 2, 3, 4)
BINS = 200
AMBIGUOUS = 0.2
SHARPNESS, CLIP = 6.0, 1.5


def present(raw: bytes, bits: int = BITS) -> np.ndarray:
    """Buckets of the n-grams that occur in a text."""
    x = np.frombuffer(raw.decode("utf-8", "replace").lower().encode(), dtype=np.uint8).astype(np.uint32)
    flag = np.zeros(1 << bits, dtype=bool)
    key = np.zeros(len(x), dtype=np.uint32)
    for k in range(1, max(SIZES) + 1):
        if len(x) < k:
            break
        key = key[: len(x) - k + 1] << np.uint32(8) | x[k - 1 :]
        if k in SIZES:
            flag[((key ^ np.uint32(k << 28)) * np.uint32(2654435761)) >> np.uint32(32 - bits)] = True
    return np.flatnonzero(flag)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n codewords of -1 and 1, one a row."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 7:
        columns = [c for c in product((1, -1), repeat=n) if c[0] == 1 and -1 in c]
        return np.array(columns, dtype=float).T
    random, best, most = np.random.default_rng(seed), None, -1
    width = int(np.ceil(10 * np.log2(n)))
    for _ in range(200):
        code = random.choice((-1.0, 1.0), (n, width))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        least = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        if least > most:
            best, most = code, least
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weight: np.ndarray | None = None  # n-gram buckets x bits
    threshold: np.ndarray | None = None
    trust: np.ndarray | None = None  # languages x bits

    def margins(self, raw: bytes) -> np.ndarray:
        """Of each bit, from -1 to 1."""
        own = self.weight[present(raw)]
        return own.sum(axis=0) / np.maximum(np.abs(own).sum(axis=0), 1e-9)

    def fit(self, counts: np.ndarray, seen: np.ndarray) -> None:
        """counts: languages x buckets; seen: documents of each language."""
        share = (counts + 0.5) / (seen[:, None] + 1)
        bits = []
        for column in self.code.T:
            yes, no = share[column > 0].mean(axis=0), share[column < 0].mean(axis=0) if (column < 0).any() else 0.5
            bits.append(np.log(yes / no))
        self.weight = np.stack(bits, axis=1).astype(np.float32)

    def calibrate(self, histogram: np.ndarray) -> None:
        """histogram: languages x bits x BINS counts of margins."""
        share = histogram / np.maximum(histogram.sum(axis=2, keepdims=True), 1)
        below = np.cumsum(share, axis=2)
        edge = -1 + 2 * (np.arange(BINS) + 1) / BINS
        self.threshold, trust = np.zeros(self.code.shape[1]), np.ones(self.code.shape)
        for b, column in enumerate(self.code.T):
            if (column < 0).any():
                right = np.where(column[:, None] < 0, below[:, b], 1 - below[:, b])
                worst = right.min(axis=0) + right.mean(axis=0)
                top = np.flatnonzero(worst >= worst.max() - 1e-12)
                k = top[len(top) // 2]
                self.threshold[b], trust[:, b] = edge[k], right[:, k]
        self.trust = trust / np.maximum(trust.sum(axis=1, keepdims=True), 1e-9)

    def predict(self, raw: bytes) -> tuple[str, float, bool]:
        if not self.languages or not any(map(str.isalpha, raw.decode("utf-8", "replace"))):
            return "und", 0.0, True
        margin = np.clip(SHARPNESS * (self.margins(raw) - self.threshold), -CLIP, CLIP)
        loss = (self.trust * np.exp(-self.code * margin)).sum(axis=1)
        p = np.exp(-(loss - loss.min()))
        p /= p.sum()
        order = np.argsort(-p, kind="stable")
        second = p[order[1]] if len(p) > 1 else 0.0
        return self.languages[order[0]], float(p[order[0]]), bool(p[order[0]] - second < AMBIGUOUS)


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, text: str = "text", language: str = "lang", key: str = "doc_id") -> Model:
    """Learn from all rows given, or about per_language of each language."""
    known = docs.where(F.col(language).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in known.groupBy(language).count().collect()}
    model = Model(sorted(sizes), codewords(len(sizes)))
    if not sizes:
        return model
    place = {x: i for i, x in enumerate(model.languages)}
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, per_language / n))])
    drawn = F.pmod(F.xxhash64(F.lit("language"), F.col(key)), F.lit(1 << 30)) / float(1 << 30)
    sample = known.where(drawn < share[F.col(language)]).select(text, F.col(language).alias("language_"))

    def summed(row, width: int) -> np.ndarray:
        """Sum over the sample of row(raw, out[place of the language]), by language."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((len(place), width), dtype=np.int64)
            for batch in batches:
                for raw, lang in zip(texts_of(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                    row(raw, out[place[lang]])
            i, j = np.nonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(i * width + j, pa.int64()), pa.array(out[i, j], pa.int64())], ["cell", "n"])

        total = np.zeros(len(place) * width)
        cells = sample.coalesce(64).mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        total[cells["cell"].to_numpy()] = cells["n"].to_numpy()
        return total.reshape(len(place), width)

    def grams(raw: bytes, out: np.ndarray) -> None:
        out[present(raw)] += 1
        out[-1] += 1

    counts = summed(grams, (1 << BITS) + 1)
    model.fit(counts[:, :-1], counts[:, -1])
    n = model.code.shape[1]
    cell = np.arange(n) * BINS

    def margins(raw: bytes, out: np.ndarray) -> None:
        out[cell + np.clip(((model.margins(raw) + 1) / 2 * BINS).astype(int), 0, BINS - 1)] += 1

    model.calibrate(summed(margins, n * BINS).reshape(len(place), n, BINS))
    return model


def predict(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, lang_pred, score, ambiguous."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                columns = list(zip(*map(model.predict, texts_of(batch.column(1).slice(a, b - a))), strict=True)) or [()] * 3
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.float64(), pa.bool_()), strict=True))], [key, "lang_pred", "score", "ambiguous"])

    return docs.select(key, text).mapInArrow(run, f"{key} long, lang_pred string, score double, ambiguous boolean")


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")
