"""N-gram Jaccard join: blocked sparse products of document by n-gram incidence.

A document's set holds its distinct WORDS-word shingles (A-Z lower-cased; with fewer words, the
whole sequence; without words, nothing, and it links with nothing). Documents link when
100 * intersection >= NEAR * union, and components are what links connect.

Equal sets are one class. Links between classes are found exactly:

1. The n-grams of each set are put in one order for all, rarest first (n-grams met often, counted
   over all rows, come last by count and are `hot`; the rest, `cold`, by hash). Linked sets share
   an n-gram among the first n - ceil(0.75 n) + 1 of each, so only this prefix is posted. Postings
   go packed to hash ranges, which are the column blocks of the incidence.
2. Each block multiplies its columns: an n-gram posted by at most FEW classes adds one to the
   overlap of each pair of them. Overlaps are summed over all blocks, and a pair is discarded if
   even all that was not counted (the longer rest behind the cold prefix, and columns left to
   step 3 that both may hold) leaves it below the bound that its two sizes set.
3. Columns of more than FEW classes, and hot ones, are compared with pivots: ROUNDS times, all
   classes with two members of the n-gram's largest component, one of which has the fewest n-grams
   of its own. At last all other pairs of
   fitting sizes that share such an n-gram across components are compared; inside a component a
   further link changes nothing. So no round writes out all pairs of a group of near copies. Here
   sizes, places of the shared n-gram, the n-grams that step 2 counted (a pair that shares one of
   them is decided there) and bit signatures rule pairs out.
4. What is left meets in blocks: rows restricted to the columns of their common partner give the
   whole overlap counts, which the exact test follows.

N-grams are compared by 64-bit hashes (48 bits within a block of step 2, which can only make the
discarding weaker, short of a collision inside one set), sets by 64 bits of an MD5. Null and empty
texts get 0 shingles and their own doc_id. Texts are whole. Each row is a document of its own:
repeated rows each get a row, and rows that share a doc_id but not a text are judged apart. Rows
without a doc_id link like others, but name no component: a component of such rows alone has none.
An empty table gives no rows. Other columns are ignored (`one_of_each` keeps them all).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, WHITE, cut, freed, freed_group, input_bytes, mix, pieces, random_table, release, table, texts_of
from .components import components, extended

WORDS, NEAR = 5, 75
#: N-grams that a task meets this often at least are counted for the order; the most frequent
#: ORDERED of them come last. This moves work only; results do not depend on it.
OFTEN, ORDERED = 2, 1 << 18
#: Classes of a column that is multiplied in its block; further ones meet by pivots.
FEW = 8
#: Rounds of pivots; they move work only.
ROUNDS = 3
#: Bytes of input for each hash range, and least number of ranges. A task sends a range what it has
#: for it, so there are no more rows than postings however many ranges there are.
RANGE_BYTES, RANGES = 8 << 20, 64
HELD, COUNTED, BLOCK, BLOCK_SIZE = 1 << 19, 6 << 20, 128, 1_500_000
_BYTES, _PLACE = random_table(256, 21), random_table(WORDS, 22) | U64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(WHITE)] = True
_STEP = U64(0x9E3779B97F4A7C15)
_BACK = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: list[np.ndarray] = [np.ones(1, dtype=U64), np.ones(1, dtype=U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse, as far as needed."""
    if len(_POWERS[0]) <= n:
        size = max(2 * len(_POWERS[0]), n + 1)
        for k, x in enumerate((_STEP, _BACK)):
            own = np.full(size, x, dtype=U64)
            own[0] = 1
            _POWERS[k] = np.cumprod(own, dtype=U64)
    return _POWERS[0], _POWERS[1]


def shingles(raw: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    x = np.frombuffer(raw.lower(), dtype=np.uint8)
    inside = np.zeros(len(x) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[x]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.zeros(0, dtype=U64)
    up, down = powers(len(x))
    total = np.zeros(len(x) + 1, dtype=U64)
    np.cumsum(_BYTES[x] * up[: len(x)], dtype=U64, out=total[1:])
    word = mix((total[end] - total[start]) * down[start] + (end - start).astype(U64) * _STEP)
    n = min(words, len(word))
    out = np.full(len(word) - n + 1, U64(n), dtype=U64)
    for k in range(n):
        out += word[k : len(word) - n + 1 + k] * _PLACE[k]
    return np.unique(mix(out))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def class_of(own: np.ndarray) -> int:
    """The name of a set: 64 bits of an MD5 of its hashes."""
    return int.from_bytes(hashlib.md5(own.tobytes(), usedforsecurity=False).digest()[:8], "big", signed=True)


def read_sets(words: int):
    """A row for each document (doc, tid, n, class), and one for each n-gram that is often met (token, times)."""
    names, kinds = ["doc", "tid", "n", "class", "token", "times"], [pa.int64()] * 6

    def often(held: list[np.ndarray]) -> pa.RecordBatch:
        token, times = np.unique(np.concatenate(held), return_counts=True)
        keep = times >= OFTEN
        n = int(keep.sum())
        return pa.RecordBatch.from_arrays([*(pa.nulls(n, k) for k in kinds[:4]), pa.array(signed(token[keep])), pa.array(times[keep], pa.int64())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, size = set(), [], 0
        for batch in batches:
            for a, b in pieces(batch.column(2)):
                n, classes = [], []
                for raw in texts_of(batch.column(2).slice(a, b - a)):
                    own = shingles(raw, words)
                    n.append(len(own))
                    classes.append(class_of(own))
                    if len(own) and classes[-1] not in seen:
                        seen.add(classes[-1])
                        held.append(own)
                        size += len(own)
                made = [pa.array(n, kinds[2]), pa.array(classes, kinds[3]), pa.nulls(b - a, kinds[4]), pa.nulls(b - a, kinds[5])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), *made], names)
                if size >= COUNTED:
                    yield often(held)
                    seen, held, size = set(), [], 0
        if held:
            yield often(held)

    return run


PACKED = "range int, classes binary, sizes binary, colds binary, counts binary, tokens binary, places binary"


def postings(words: int, near: int, ranges: int, hot: np.ndarray, count: np.ndarray):
    """Prefixes of the sets, packed by hash range (PACKED).

    hot: sorted n-grams that come last, by count; they go, by class, to ranges of their own, from
    `ranges` on, with their places. A class's cold n-grams of a range follow each other in order,
    so the place of the first is enough, and 48 bits tell them apart. colds: how many n-grams of
    the prefix are cold."""

    def packed(own: np.ndarray, home: np.ndarray, token: np.ndarray, place: np.ndarray, ids: np.ndarray, sizes: np.ndarray, colds: np.ndarray, whole: bool) -> list[tuple]:
        if not len(home):
            return []
        by = np.argsort(home, kind="stable")
        home, token, place, own = home[by], token[by], place[by].astype(np.int32), own[by]
        six = token if whole else np.ascontiguousarray(token.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
        edge = np.flatnonzero(np.append(True, np.diff(home) != 0))
        rows = []
        for a, b in zip(edge, np.append(edge[1:], len(home)), strict=True):
            head = np.flatnonzero(np.append(True, np.diff(own[a:b]) != 0))
            who = own[a:b][head]
            counts = np.diff(np.append(head, b - a)).astype(np.int32)
            places = place[a:b] if whole else place[a:b][head]
            rows.append((int(home[a]), ids[who].tobytes(), sizes[who].tobytes(), colds[who].tobytes(), counts.tobytes(), six[a:b].tobytes(), places.tobytes()))
        return rows

    def flush(held: list[tuple]) -> pa.RecordBatch:
        ids, sizes, colds = np.array([x[0] for x in held], dtype=np.int64), *(np.array([x[k] for x in held], dtype=np.int32) for k in (1, 2))
        own = np.repeat(np.arange(len(held)), [len(x[3]) for x in held])
        token, place = np.concatenate([x[3] for x in held]), np.concatenate([np.arange(len(x[3])) for x in held])
        cold = place < colds[own]
        home = ((token >> U64(32)) * U64(ranges) >> U64(32)).astype(np.int64)
        home[~cold] = ranges + (ids[own[~cold]].view(U64) % U64(ranges)).astype(np.int64)
        rows = [r for k in (cold, ~cold) for r in packed(own[k], home[k], token[k], place[k], ids, sizes, colds, k is not cold)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if not k else pa.binary()) for k, c in enumerate(zip(*rows, strict=True))], [x.split()[0] for x in PACKED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, size = set(), [], 0
        for batch in batches:
            for a, b in pieces(batch.column(0)):
                for raw in texts_of(batch.column(0).slice(a, b - a)):
                    own = shingles(raw, words)
                    name = class_of(own)
                    if not len(own) or name in seen:
                        continue
                    seen.add(name)
                    at = np.minimum(np.searchsorted(hot, own), max(len(hot) - 1, 0))
                    times = np.where(hot[at] == own, count[at], 0) if len(hot) else np.zeros(len(own), dtype=np.int64)
                    by = np.lexsort((own, times))[: len(own) - -(-near * len(own) // 100) + 1]
                    held.append((name, len(own), int((times[by] == 0).sum()), own[by]))
                    size += len(by)
                    if size >= HELD:
                        yield flush(held)
                        seen, held, size = set(), [], 0
        if held:
            yield flush(held)

    return run


MET = "a long, b long, n int, m int, p int, q int, overlap int, token long, place int"


def multiplied(ranges: int, near: int, few: int):
    """One range (MET). Of a block of cold columns: a row (a, b, overlap) for each pair of classes that share
    columns of at most `few` classes, with their sizes n, m and cold prefixes p, q; and a row
    (a, token, place) for each class of a fuller column, with overlap 1. Of hot columns: a row
    (a, token, place) each, with overlap 0."""
    names = [x.split()[0] for x in MET.split(", ")]
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 5, pa.int64(), pa.int32()]

    def made(k: int, **own: np.ndarray) -> pa.Table:
        return pa.table([pa.array(own[x], t) if x in own else pa.nulls(k, t) for x, t in zip(names, kinds, strict=True)], names=names)

    def run(part: pa.Table) -> pa.Table:
        home = part.column("range")[0].as_py()

        def read(name: str, kind) -> np.ndarray:
            return np.frombuffer(b"".join(part.column(name).to_pylist()), dtype=kind)

        counts, places = read("counts", np.int32), read("places", np.int32)
        row = np.repeat(np.arange(len(counts)), counts)
        classes, sizes, colds = read("classes", np.int64), read("sizes", np.int32), read("colds", np.int32)
        if home >= ranges:
            token, place = signed(read("tokens", U64)), places
        else:
            six = np.zeros((len(row), 8), dtype=np.uint8)
            six[:, :6] = read("tokens", np.uint8).reshape(-1, 6)
            token = signed(mix(six.view("<u8").ravel() + U64(home) * _STEP))
            place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + places[row]
        by = np.lexsort((classes[row], token))
        row, token, place = row[by], token[by], place[by]
        new = np.append(True, (np.diff(token) != 0) | (np.diff(classes[row]) != 0))
        row, token, place = row[new], token[new], place[new]
        if home >= ranges:
            return made(len(row), a=classes[row], n=sizes[row], p=colds[row], overlap=np.zeros(len(row)), token=token, place=place)
        start = np.flatnonzero(np.append(True, np.diff(token) != 0))
        size = np.diff(np.append(start, len(token)))
        size = np.repeat(size, size)
        full = np.flatnonzero(size > few)
        rest = made(len(full), a=classes[row[full]], n=sizes[row[full]], p=colds[row[full]], overlap=np.ones(len(full)), token=token[full], place=place[full])
        keep = (size > 1) & (size <= few)
        row, token = row[keep], token[keep]
        left, right = [], []
        for step in range(1, few):
            at = np.flatnonzero(token[step:] == token[:-step])
            x, y = row[at], row[at + step]
            fits = 100 * np.minimum(sizes[x], sizes[y]).astype(np.int64) >= near * np.maximum(sizes[x], sizes[y]).astype(np.int64)
            left.append(x[fits])
            right.append(y[fits])
        x, y = np.concatenate(left), np.concatenate(right)
        by = np.lexsort((classes[y], classes[x]))
        x, y = x[by], y[by]
        head = np.flatnonzero(np.append(True, (np.diff(classes[x]) != 0) | (np.diff(classes[y]) != 0))) if len(x) else np.zeros(0, np.int64)
        overlap = np.diff(np.append(head, len(x)))
        x, y = x[head], y[head]
        pairs = made(len(x), a=classes[x], b=classes[y], n=sizes[x], m=sizes[y], p=colds[x], q=colds[y], overlap=overlap)
        return pa.concat_tables([pairs, rest])

    return run


def fuller_columns(met: DataFrame) -> DataFrame:
    """How many of a class's columns its blocks left to the rounds: (a, left)."""
    return met.where("overlap = 1 AND token IS NOT NULL").groupBy("a").agg(F.count("*").alias("left"))


def within_bounds(met: DataFrame, near: int) -> DataFrame:
    """Pairs (a, b, n, m) whose summed overlap leaves a link possible.

    A shared n-gram that no block counted lies behind the cold prefix of the set whose prefix ends
    first, or in a column of more than FEW classes of which both sets hold one."""
    fuller = fuller_columns(met)
    pairs = met.where("token IS NULL").groupBy("a", "b").agg(F.sum("overlap").alias("overlap"), *(F.max(c).alias(c) for c in "nmpq"))
    for side, named in (("a", "x"), ("b", "y")):
        own = fuller.select(F.col("a").alias(side), F.col("left").alias(named))
        pairs = pairs.join(own, side, "left").fillna(0, [named])
    behind = most_behind("n", "p", whole_cold("n", "p", near), "m", "q", whole_cold("m", "q", near))
    most = f"least(overlap + least(x, y) + {behind}, n, m)"
    return pairs.where(f"{100 + near} * {most} >= {near} * (n + m)").select("a", "b", F.col("n").cast("long").alias("n"), F.col("m").cast("long").alias("m"))


def whole_cold(n: str, k: str, near: int) -> str:
    """SQL: the cold prefix, of k n-grams, holds all cold n-grams of a set of n, as hot ones follow it."""
    return f"({k} < {n} - ceil({near} * {n} / 100) + 1)"


def most_behind(n: str, k: str, a: str, m: str, l: str, b: str) -> str:
    """SQL: the most that two sets of n and m can share beyond what step 2 counted. k, l: counted
    n-grams, a, b: whether these are all cold ones of their set. What is shared and not counted lies
    behind the prefix that ends first; and behind each whose partner's cold n-grams are all in its own."""
    return f"least(if({b}, {n} - {k}, {n}), if({a}, {m} - {l}, {m}), greatest({n} - {k}, {m} - {l}))"


def may_link(n: str, i: str, k: str, a: str, m: str, j: str, l: str, b: str, near: int) -> str:
    """SQL: sizes, places of the first shared n-gram, and what can be shared by a pair of which step 2
    counted nothing (else it is decided there), that leave a link possible."""
    return (
        f"{100 + near} * {most_behind(n, k, a, m, l, b)} >= {near} * ({n} + {m}) AND 100 * least({n}, {m}) >= {near} * greatest({n}, {m})"
        f" AND {100 + near} * least({n} - {i}, {m} - {j}) >= {near} * ({n} + {m})"
    )


def against(rows: DataFrame, near: int) -> DataFrame:
    """Pairs (a < b) of each row's document with its pivot p, as far as a link is possible."""
    rows = rows.where("doc != p.doc").where(may_link("n", "place", "counted", "complete", "p.n", "p.place", "p.counted", "p.complete", near))
    first = F.col("doc") < F.col("p.doc")
    rows = rows.select(
        F.least("doc", "p.doc").alias("a"), F.greatest("doc", "p.doc").alias("b"),
        F.when(first, F.col("n")).otherwise(F.col("p.n")).alias("m"), F.when(first, F.col("p.n")).otherwise(F.col("n")).alias("n"),
    )
    return rows.groupBy("a", "b").agg(F.max("m").alias("m"), F.max("n").alias("n"))


def unsettled(posted: DataFrame, label: DataFrame) -> DataFrame:
    """Postings, with labels, of n-grams whose documents are not yet in one component."""
    rows = posted.join(label.withColumnRenamed("node", "doc"), "doc", "left").withColumn("label", F.coalesce("label", "doc"))
    mixed = rows.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("token")
    return rows.join(mixed, "token", "left_semi")


def without(pairs: DataFrame, done: list[DataFrame]) -> DataFrame:
    return pairs.join(union([x.select("a", "b") for x in done]), ["a", "b"], "left_anti")


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def merged(rows: DataFrame) -> DataFrame:
    """N-grams posted by the same documents, told by sums of hashes, become one, with the least place
    of each document: the same pairs meet once, and no bound on their overlap gets tighter."""
    same = rows.groupBy("token").agg(F.count("*").alias("size"), F.sum(F.xxhash64("doc").cast("decimal(20)")).alias("sum"), F.sum(F.xxhash64(F.lit(1), "doc").cast("decimal(20)")).alias("more"))
    same = same.withColumn("group", F.xxhash64("size", "sum", "more")).select("token", "group")
    return rows.join(same, "token").groupBy(F.col("group").alias("token"), "doc").agg(F.min("place").alias("place"), F.max("n").alias("n"), F.max("counted").alias("counted"), F.max("complete").alias("complete"), F.max("label").alias("label"))


def width(n: int) -> int:
    """Bits of the signature of a set of n."""
    return min(1 << 16, max(256, 1 << (4 * n - 1).bit_length()))


def signatures(words: int):
    """Of each text, a set bit for each of its n-grams' hashes modulo the width."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                out = []
                for raw in texts_of(batch.column(1).slice(a, b - a)):
                    own = shingles(raw, words)
                    bits = np.zeros(width(len(own)), dtype=bool)
                    bits[(own & U64(len(bits) - 1)).astype(np.int64)] = True
                    out.append(np.packbits(bits).tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(out, pa.binary())], ["doc", "bits"])

    return run


def possible(pairs: DataFrame, marks: DataFrame, near: int) -> DataFrame:
    """Pairs whose signatures leave a link possible: an n-gram whose bit the other lacks is not shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(len(batch), dtype=bool)
            m, n = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            for i, (x, y) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)):
                p, q = np.frombuffer(x, dtype=np.uint8), np.frombuffer(y, dtype=np.uint8)
                size = min(len(p), len(q))
                p, q = (np.bitwise_or.reduce(z.reshape(-1, size), axis=0).view(U64) for z in (p, q))
                most = min(m[i] - int(np.bitwise_count(p & ~q).sum()), n[i] - int(np.bitwise_count(q & ~p).sum()))
                keep[i] = 100 * most >= near * (m[i] + n[i] - most)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in batch.columns[:4]], ["a", "b", "m", "n"])

    rows = pairs.join(marks.select(F.col("doc").alias("a"), F.col("bits").alias("p")), "a")
    rows = rows.join(marks.select(F.col("doc").alias("b"), F.col("bits").alias("q")), "b")
    return rows.select("a", "b", "m", "n", "p", "q").mapInArrow(freed(run), "a long, b long, m long, n long")


def products(words: int, near: int):
    """One part: sets of its texts (doc, body) and pairs asked (a, b); the pairs that link. Rows of a
    block of partners, restricted to the columns of their common partner, give the overlap counts."""

    def run(part: pa.Table) -> pa.Table:
        asked = pc.is_null(part.column("doc"))
        texts, pairs = part.filter(pc.invert(asked)), part.filter(asked)
        sets = {d: shingles(raw.as_py().encode(), words) for d, raw in zip(texts.column("doc").to_pylist(), texts.column("body"), strict=True)}
        a, b = pairs.column("a").to_numpy(), pairs.column("b").to_numpy()
        by = np.lexsort((b, a))
        start = np.flatnonzero(np.append(True, np.diff(a[by]) != 0)) if len(by) else np.zeros(0, np.int64)
        keep = np.zeros(len(by), dtype=bool)
        for rows in np.split(by, start[1:]) if len(by) else []:
            columns = sets[int(a[rows[0]])]
            for at in range(0, len(rows), BLOCK):
                block = rows[at : at + BLOCK]
                others = [sets[x] for x in b[block].tolist()]
                n = np.array([len(x) for x in others])
                token, row = np.concatenate(others), np.repeat(np.arange(len(others)), n)
                place = np.minimum(np.searchsorted(columns, token), len(columns) - 1)
                overlap = np.bincount(row[columns[place] == token], minlength=len(others))
                keep[block] = 100 * overlap >= near * (n + len(columns) - overlap)
        return pa.table([pa.array(a[keep], pa.int64()), pa.array(b[keep], pa.int64())], names=["a", "b"])

    return run


def dealt(pairs: DataFrame) -> DataFrame:
    """The pairs with the part that verifies them: (home, a, b). pairs: a table of its own, with sizes n and m.

    Pairs of classes that have their least partner in common go to one part, which gets each text
    once; the pairs of a great group are dealt over several."""
    homes = max(64, int(pairs.agg(F.sum(F.col("n") + F.col("m"))).first()[0] or 0) // BLOCK_SIZE)
    ends = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    grouped = pairs.join(ends.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("group")), "a")
    salts = grouped.groupBy("group").agg(F.ceil(F.sum(F.col("n") + F.col("m")) / BLOCK_SIZE).alias("salts"))
    part = F.xxhash64("group", F.pmod(F.xxhash64("a", "b"), F.col("salts")))
    return cut(grouped.join(salts, "group").select(F.pmod(part, F.lit(homes)).cast("int").alias("home"), "a", "b"), "dealt", tidy=False)


def members(parts: DataFrame) -> DataFrame:
    """The classes whose texts a part needs: (home, doc)."""
    return parts.select("home", F.explode(F.array("a", "b")).alias("doc")).distinct()


def verified(parts: DataFrame, texts: DataFrame, words: int, near: int) -> DataFrame:
    """The pairs (a, b) of dealt() that link. texts: home, doc, body of all members."""
    none = [F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b")]
    asked = parts.select("home", "a", "b", F.lit(None).cast("long").alias("doc"), F.lit(None).cast("string").alias("body"))
    rows = texts.select("home", *none, "doc", "body").unionByName(asked)
    return cut(rows.groupBy("home").applyInArrow(freed_group(products(words, near)), "a long, b long"), "links", tidy=False)


def across(rest: DataFrame, near: int) -> DataFrame:
    """Pairs (a < b) of different components that share a token, as far as a link is possible. Rows
    meet by token and size class, so sets of unlike sizes do not meet at all."""
    step = math.log(100 / near)
    rest = rest.withColumn("level", F.floor(F.log(F.col("n").cast("double")) / step).cast("int"))
    small = rest.select("token", *(F.col(c).alias(d) for c, d in (("doc", "x"), ("n", "xn"), ("place", "i"), ("counted", "xk"), ("complete", "xc"), ("label", "xl"))), F.explode(F.expr("array(level, level + 1)")).alias("level"))
    large = rest.select("token", "level", *(F.col(c).alias(d) for c, d in (("doc", "y"), ("n", "yn"), ("place", "j"), ("counted", "yk"), ("complete", "yc"), ("label", "yl"))))
    rows = small.join(large, ["token", "level"]).where("xl != yl AND (xn < yn OR xn = yn AND x < y)").where(may_link("xn", "i", "xk", "xc", "yn", "j", "yk", "yc", near))
    first = F.col("x") < F.col("y")
    rows = rows.select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"),
        F.when(first, F.col("xn")).otherwise(F.col("yn")).alias("m"), F.when(first, F.col("yn")).otherwise(F.col("xn")).alias("n"),
    )
    return rows.groupBy("a", "b").agg(F.max("m").alias("m"), F.max("n").alias("n"))


def linked(docs: DataFrame, words: int, near: int, text: str, key: str) -> DataFrame:
    """One row per document: doc, tid (a hash of the text), n, and `first`, the struct (nameless,
    doc, tid) of its component's document of least key. Reads a table that stays."""
    size = input_bytes(docs, text)
    ranges = max(RANGES, size // RANGE_BYTES)
    body = F.coalesce(F.col(text), F.lit(""))
    own = docs.select(F.col(key).alias("doc"), F.xxhash64(body).alias("tid"), body.alias("body"))
    read = cut(own.mapInArrow(freed(read_sets(words)), "doc long, tid long, n long, class long, token long, times long"), "sets")
    often = read.where("token IS NOT NULL").groupBy("token").agg(F.sum("times").alias("times"))
    often = often.orderBy(F.desc("times"), "token").limit(ORDERED).toArrow()
    hot, count = often.column("token").to_numpy().view(U64), often.column("times").to_numpy()
    by = np.argsort(hot)
    hot, count = hot[by], count[by]
    sets = read.where("class IS NOT NULL").select("doc", "tid", "n", "class")
    nameless = F.struct(F.col("doc").isNull().alias("nameless"), "doc", "tid")
    classes = cut(sets.where("n > 0").groupBy("class").agg(F.min(nameless).alias("first")), "classes")

    packed = own.select("body").mapInArrow(freed(postings(words, near, ranges, hot, count)), PACKED)
    met = cut(packed.groupBy("range").applyInArrow(freed_group(multiplied(ranges, near, FEW)), MET), "met")
    del packed
    few = cut(within_bounds(met, near), "few", tidy=False)
    posted = met.where("token IS NOT NULL").join(fuller_columns(met), "a", "left").select("token", F.col("a").alias("doc"), *(F.col(c).cast("long").alias(c) for c in ("n", "place")), F.expr("p - coalesce(left, 0L)").alias("counted"), F.expr(whole_cold("n", "p", near)).alias("complete"))
    met_by = posted.groupBy("token").count().where("count > 1").select("token")
    posted = cut(posted.join(met_by, "token", "left_semi"), "posted", tidy=False)
    parts = dealt(few)
    # one shuffle of the texts, whatever the number of those wanted; home -1 keeps texts for the rounds
    wanted = members(parts).unionByName(posted.select(F.lit(-1).alias("home"), "doc").distinct()).join(classes, F.col("doc") == F.col("class"))
    wanted = wanted.select("home", "class", F.xxhash64("first.doc", "first.tid").alias("row"))
    texts = own.select(F.xxhash64("doc", "tid").alias("row"), "body").join(wanted.hint("merge"), "row").dropDuplicates(["row", "home"])
    texts = cut(texts.select("home", F.col("class").alias("doc"), "body"), "texts")
    links, done = [verified(parts, texts.where("home >= 0"), words, near)], [few]
    kept = texts.where("home < 0").select("doc", "body")
    marks = cut(kept.mapInArrow(freed(signatures(words)), "doc long, bits binary"), "marks")
    release(met, parts)

    def compared(pairs: DataFrame, label: DataFrame) -> DataFrame:
        """Links among the pairs join `links`; returns the labels with them. Those before are released."""
        left = cut(without(pairs, done), "tried", tidy=False)
        done.append(left)
        pairs = cut(possible(left, marks, near), "pairs", tidy=False)
        parts = dealt(pairs)
        links.append(verified(parts, members(parts).join(kept, "doc"), words, near))
        release(pairs, parts)
        return extended(label, links[-1])

    label, mixed = components(links[0]), posted
    for turn in range(ROUNDS):
        before, mixed = mixed, cut(unsettled(mixed.drop("label"), label), "mixed")
        release(before)
        # a member of few n-grams of its own is near most others; the second is another one each time
        draw, own = F.xxhash64("doc", F.lit(turn)).alias("draw"), ("doc", "n", "place", "counted", "complete")
        central, other = F.struct("counted", draw, *own[:3], own[4]), F.struct(draw, *own)
        groups = mixed.groupBy("token", "label").agg(F.count("*").alias("size"), F.min(central).alias("p"), F.min(other).alias("q"))
        groups = groups.select("token", "label", "size", *(F.struct(*(F.col(f"{x}.{c}").alias(c) for c in own)).alias(x) for x in "pq"))
        main = groups.groupBy("token").agg(F.max_by(F.struct("label", "p", "q"), F.struct("size", "label")).alias("main"))
        label = compared(against(mixed.join(main, "token").where("label != main.label").withColumn("p", F.explode(F.array("main.p", "main.q"))), near), label)
    rest = cut(merged(unsettled(mixed.drop("label"), label)), "rest")
    release(mixed)
    label = compared(across(rest, near), label)
    release(rest, texts, marks)

    in_group = classes.join(label, F.col("class") == F.col("node"))
    least = in_group.groupBy("label").agg(F.min("first").alias("least"))
    named = in_group.join(least, "label").select("class", "least")
    named = classes.join(named, "class", "left").select("class", F.coalesce("least", "first").alias("first"))
    out = sets.withColumn("class", F.when(F.col("n") > 0, F.col("class"))).join(named, "class", "left")
    out = cut(out.select("doc", "tid", "n", F.coalesce("first", nameless).alias("first")), "groups")
    release(read, classes, label, *done, *links)
    return out


def link_classes(docs: DataFrame, words: int = WORDS, near: int = NEAR, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, n_shingles, component_id."""
    found = linked(docs, words, near, text, key)
    return found.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), F.col("first.doc").alias("component_id"))


def one_of_each(docs: DataFrame, words: int = WORDS, near: int = NEAR, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Of each component the document of least key (of equal keys, of least hash of the text), with
    all its columns. Of rows equal in key and text one stays; rows without a key all stay."""
    names = docs.columns
    found = linked(docs, words, near, text, key).where("doc IS NOT NULL")
    away = found.where("NOT (doc <=> first.doc AND tid = first.tid)").select("doc", "tid").distinct()
    again = found.groupBy("doc", "tid").count().where("count > 1").select("doc", "tid")
    rows = docs.select(F.struct(*names).alias("row_"), F.col(key).alias("doc"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("tid"))
    # by shuffle whatever the size of the other side, so that the plan is the same at every size
    rows = rows.join(away.hint("merge"), ["doc", "tid"], "left_anti")
    if again.limit(1).count():
        rows = rows.join(again, ["doc", "tid"], "left_anti").unionByName(rows.join(again, ["doc", "tid"], "left_semi").dropDuplicates(["doc", "tid"]))
    return rows.select(*(F.col("row_")[c].alias(c) for c in names))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_classes(table(spark, sf_dir, "documents"))
