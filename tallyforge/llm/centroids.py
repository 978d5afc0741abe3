"""Centroid clustering in exact integers, with float32 products that only shortlist.

A vector is kept if it has exactly `width` components, none null or not finite; component x becomes
the integer floor(scale * x). The k kept vectors with the smallest SHA-256 of `seed:<key>` are the
first centroids. In each round every vector goes to the nearest centroid (squared Euclidean
distance, ties to the smaller number), then every centroid that has vectors becomes the floor of
their exact mean; one that has none stays. A last assignment follows.

The nearest centroid is screened: |c|^2 - 2 v.c differs from the squared distance by |v|^2 only,
and a float32 product of m terms is off by at most m u / (1 - m u) times |v| |c| with u = 2^-24,
in whatever order it is summed. That gives an interval for each centroid. Where the interval with
the least upper end meets no other, the choice is proven; else the centroids whose intervals reach
below that end are compared in 64-bit integers, lowest number first. Vectors or centroids with a
component of 2^20 or more are compared in unbounded integers.

Each task adds up its own vectors by cluster, so a cluster with a third of all rows sends a row a
task. Sums travel in limbs of 24 bits, so they are exact however great components are. The driver
holds k centroids of `width` components, and nothing that grows with the rows.

Null vectors, those of another width and those with a null or a component that is not finite give no row.
With fewer than k kept vectors each is a centroid; an empty table gives no rows. Repeated rows each
get a row; rows equal in key start in the order of their components; a null key hashes as `seed:`.
Distances and sums beyond a long are given as the greatest long. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, freed, table

CENTROIDS, ROUNDS, WIDTH, SCALE, SEED = 16, 3, 64, 64, 1
#: Below this size of components products of integers fit float32 screening and 64-bit sums.
SMALL = 1 << 20
LIMB = 24
BLOCK = 1 << 14
LONGEST = (1 << 63) - 1


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles: int64 if all are small, else Python integers."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)
    if not scaled.size or np.abs(scaled).max() < SMALL:
        return scaled.astype(np.int64)
    exact = [int(x) * scale if abs(x) >= 2.0**53 else math.floor(x * scale) for x in values.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(values.shape)


@dataclass
class Centroids:
    """k centroids, and what screening needs of them."""

    rows: list[list[int]]

    def __post_init__(self):
        self.small = all(abs(x) < SMALL for row in self.rows for x in row)
        self.exact = np.array(self.rows, dtype=np.int64 if self.small else object)
        if self.small:
            self.single = self.exact.astype(np.float32)
            self.squares = (self.exact * self.exact).sum(axis=1).astype(np.float64)  # below 2^53, so exact
            m = self.exact.shape[1]
            self.gamma = m * 2.0**-24 / (1 - m * 2.0**-24)

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid of each row, its squared distance, and the number of rows
        that were not settled by screening."""
        if not self.small or v.dtype == object:
            apart = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, c, strict=True)) for c in self.rows] for x in v]
            best = np.array([d.index(min(d)) for d in apart], dtype=np.int64)
            return best, np.array([d[j] for d, j in zip(apart, best, strict=True)], dtype=object), len(v)
        product = (v.astype(np.float32) @ self.single.T).astype(np.float64)
        # the factor covers the rounding of the square roots and of the interval itself
        norms = np.sqrt((v * v).sum(axis=1).astype(np.float64))
        slack = 2 * self.gamma * (1 + 1e-9) * norms[:, None] * np.sqrt(self.squares)[None, :] + 1e-6
        middle = self.squares[None, :] - 2 * product
        low, high = middle - slack, middle + slack
        open_ = low <= high.min(axis=1)[:, None]
        best = middle.argmin(axis=1)
        unsettled = np.flatnonzero(open_.sum(axis=1) > 1)
        if len(unsettled):
            row, column = np.nonzero(open_[unsettled])
            gap = v[unsettled[row]] - self.exact[column]
            apart = np.full((len(unsettled), len(self.rows)), LONGEST, dtype=np.int64)
            apart[row, column] = (gap * gap).sum(axis=1)
            best[unsettled] = apart.argmin(axis=1)  # the first of equals
        gap = v - self.exact[best]
        return best, (gap * gap).sum(axis=1), len(unsettled)

    def digests(self) -> list[str]:
        return [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in self.rows]


def kept(vectors: DataFrame, vector: str, key: str, width: int) -> DataFrame:
    """key_, vector_ (doubles) of the vectors that take part."""
    own = vectors.select(F.col(key).alias("key_"), F.col(vector).cast("array<double>").alias("vector_"))
    finite = F.forall("vector_", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return own.where((F.size("vector_") == width) & finite)


def matrices(batch: pa.RecordBatch, width: int, scale: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Keys and integers of blocks of rows; a block with great components apart from the others."""
    for at in range(0, batch.num_rows, BLOCK):
        part = batch.slice(at, BLOCK)
        values = part.column("vector_").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        great = (np.abs(values) >= SMALL // scale).any(axis=1)
        for chosen in (~great, great):
            if chosen.any():
                yield part.column("key_").filter(pa.array(chosen)), integers(values[chosen], scale)


def limbs(v: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(i, part): v is the sum of part * 2^(24 i)."""
    if v.dtype != object:
        yield 0, v
        return
    i = 0
    while np.abs(v).max() >= SMALL:
        low = v & ((1 << LIMB) - 1)
        yield i, low.astype(np.int64)
        v, i = v >> LIMB, i + 1
    yield i, v.astype(np.int64)


def sums(vectors: DataFrame, own: Centroids, width: int, scale: int) -> list[list[int]]:
    """The centroids after one round."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], list] = {}
        for batch in batches:
            for _, v in matrices(batch, width, scale):
                best = own.nearest(v)[0]
                for i, part in limbs(v):
                    for c in np.unique(best).tolist():
                        mine = part[best == c]
                        held = total.setdefault((c, i), [0, np.zeros(width, dtype=np.int64)])
                        held[0] += len(mine) if i == 0 else 0
                        held[1] += mine.sum(axis=0)
        if total:
            keys = sorted(total)
            yield pa.record_batch(
                [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([total[k][0] for k in keys], pa.int64()),
                 pa.array([total[k][1].tolist() for k in keys], pa.list_(pa.int64()))],
                names=["cluster", "limb", "n", "sums"],
            )

    made = vectors.mapInArrow(freed(partial), "cluster int, limb int, n long, sums array<long>")
    made = made.groupBy("cluster", "limb").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("sums")[i]) for i in range(width))).alias("sums"))
    rows = [list(row) for row in own.rows]
    total = {c: [0] * width for c in range(len(rows))}
    n = dict.fromkeys(total, 0)
    for r in made.collect():  # at most k rows a limb
        n[r.cluster] += r.n
        total[r.cluster] = [t + (s << (LIMB * r.limb)) for t, s in zip(total[r.cluster], r.sums, strict=True)]
    return [[t // n[c] for t in total[c]] if n[c] else rows[c] for c in range(len(rows))]


def assigned(vectors: DataFrame, own: Centroids, width: int, scale: int) -> DataFrame:
    """key_, cluster, distance of each kept vector."""
    kind = vectors.schema["key_"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, v in matrices(batch, width, scale):
                best, apart, _ = own.nearest(v)
                apart = [min(int(x), LONGEST) for x in apart] if apart.dtype == object else apart
                yield pa.record_batch([keys, pa.array(best.astype(np.int32)), pa.array(apart, pa.int64())], names=["key_", "cluster", "distance"])

    return vectors.mapInArrow(freed(run), f"key_ {kind}, cluster int, distance long")


def fit(vectors: DataFrame, k: int, rounds: int, seed: int, width: int, scale: int) -> Centroids | None:
    """vectors: key_, vector_. None if there are none."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key_").cast("string"), F.lit(""))), 256)
    first = vectors.select("vector_", name.alias("name_")).orderBy("name_", "vector_").limit(k).collect()
    if not first:
        return None
    own = Centroids([[int(x) for x in integers(np.array(r.vector_, dtype=np.float64), scale)] for r in first])
    for _ in range(rounds):
        own = Centroids(sums(vectors, own, width, scale))
    return own


def cluster(
    vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, width: int = WIDTH, scale: int = SCALE
) -> DataFrame:
    """One row per kept vector: key, cluster, distance, cluster_inertia, inertia, centroid_sha256 and
    centroid (its components, as strings of decimal digits)."""
    rows = kept(vectors, vector, key, width)
    own = fit(rows, k, rounds, seed, width, scale)
    ddl = f"`{key}` {rows.schema['key_'].dataType.simpleString()}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<string>"
    if own is None:
        return vectors.sparkSession.createDataFrame([], ddl)
    made = cut(assigned(rows, own, width, scale), "clusters", tidy=False)
    spread = made.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum_")).collect()  # at most k rows
    inertia = {r.cluster: int(r.sum_) for r in spread}
    total = min(sum(inertia.values()), LONGEST)

    def of(values: list):
        return F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)

    places = range(len(own.rows))
    centroid = F.element_at(F.array(*(F.array(*(F.lit(str(x)) for x in own.rows[c])) for c in places)), F.col("cluster") + 1)
    return made.select(
        F.col("key_").alias(key), "cluster", "distance", of([min(inertia.get(c, 0), LONGEST) for c in places]).cast("long").alias("cluster_inertia"),
        F.lit(total).cast("long").alias("inertia"), of(own.digests()).alias("centroid_sha256"), centroid.alias("centroid"),
    )


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings")).drop("centroid")


def _rounds(k: int, rounds: int) -> str:
    """CTEs of the rounds: a0, c1, a1, c2 and so on to the last assignment."""
    out = []
    for r in range(rounds + 1):
        out.append(f"""
p{r} AS (SELECT v.id, v.i, j, list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v, c{r} c),
a{r} AS (SELECT id, i, (arg_min(j, d * {k} + j))::INT AS j, min(d)::BIGINT AS d FROM p{r} GROUP BY id, i)""")
        if r < rounds:
            out.append(f"""
s{r} AS (SELECT a.j, e.pos, sum(e.val)::BIGINT AS s, count(*)::BIGINT AS n FROM a{r} a JOIN v ON v.i = a.i,
  LATERAL (SELECT unnest(v.x) AS val, unnest(range(1, {WIDTH + 1})) AS pos) e GROUP BY a.j, e.pos),
m{r} AS (SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS x FROM s{r} GROUP BY j),
c{r + 1} AS (SELECT c.j, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m ON c.j = m.j)""")
    return ",".join(out)


SQL = f"""
WITH v AS (SELECT vec_id AS id, row_number() OVER () AS i, list_transform(embedding, lambda e: floor({SCALE} * e::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {WIDTH}),
c0 AS (SELECT (row_number() OVER (ORDER BY h, x) - 1)::BIGINT AS j, x FROM (SELECT x, sha256('{SEED}:' || coalesce(id::VARCHAR, '')) AS h FROM v ORDER BY h, x LIMIT {CENTROIDS})),
{_rounds(CENTROIDS, ROUNDS)}
SELECT a.id AS vec_id, a.j AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.j))::BIGINT AS cluster_inertia, (sum(a.d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c ON a.j = c.j
"""
