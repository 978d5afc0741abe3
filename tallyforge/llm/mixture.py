"""Mixing sources to target weights by certain whole copies and Pareto order sampling.

Sources, by code point and null last, have weights 5, 2, 1 and so on in turn and share the words
of the whole corpus; a target stops at 3 times its source's words and the excess goes to the
others by weight. A source whose target is c times its words and some more gives each document c
certain copies. What is left of the target is drawn by Pareto order sampling with unequal
probabilities: a document's inclusion probability is in proportion to its `weight`, by default
1 + the whole part of the root of its words (so that long documents are favoured, but by less than
their length), and such that the words expected are the words left. Documents whose probability would reach one are
certain: they are taken first and the probabilities of the others computed anew, until none reaches one. The others
are ranked by the odds of a random number divided by the odds of inclusion, and taken in this order while they fit.
What is left after that is filled from the documents not taken, the longest that fits first and among
equally long ones in Pareto order; at last the shortest one is taken if more than half of it is still due. So a source
misses its target by half its shortest document not taken at most, unless all are taken.

Only DataFrame functions are used. The certain ones are found from the sums of each weight, the running sums come from
bucket sums and windows within buckets, and the filling from the number of documents of each length, so a
source with a third of all rows is not gathered; the number of weights and lengths depends on the longest
document, not on the number of documents (a weight that is given is rounded to three digits). Draws depend on doc_id, text and
the seed alone, so reruns agree. Null and empty texts have no words and take none. A source of
no words has target 0. Very long texts count whole. Repeated rows draw alike and are taken one by one: which of
them is arbitrary, how many is not, and `mixed` gives as many. An empty table gives no rows. Other columns are
ignored (`mixed` keeps them all).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, n_words, table
from .order import before, unit

WEIGHTS, MOST, SEED = (5, 2, 1), 3, "mixture"


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """sources: source_, words_, one row a source. Adds target_, by filling up in closed form:
    in order of cap over weight, the sources before the water level are at their cap."""
    place = Window.orderBy(F.col("source_").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(place) - 1) % len(weights) + 1).cast("int"))
    rows = sources.withColumn("weight_", weight).withColumn("cap_", (most * F.col("words_")).cast("long"))
    order = Window.orderBy(F.col("cap_") / F.col("weight_"), F.col("source_").asc_nulls_last())
    all_words = F.sum("words_").over(Window.partitionBy())
    capped = F.coalesce(F.sum("cap_").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    level = (all_words - capped) / F.sum("weight_").over(order.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level_", level).withColumn("full_", F.col("cap_") <= F.col("level_") * F.col("weight_"))
    water = F.max(F.when(~F.col("full_"), F.col("level_"))).over(Window.partitionBy())
    return rows.withColumn("target_", F.when(F.col("full_"), F.col("cap_").cast("double")).otherwise(water * F.col("weight_"))).drop("level_", "full_", "cap_", "weight_")


def pareto(draw: Column, share: Column) -> Column:
    """Odds of the draw over odds of inclusion."""
    share = F.least(F.greatest(share, F.lit(1e-12)), F.lit(1 - 1e-12))
    return draw / (1 - draw) / (share / (1 - share))


def _same(left: DataFrame, right: DataFrame, *names: str, how: str = "inner") -> DataFrame:
    """Join on columns of equal names, null as a value."""
    right = right.select(*(F.col(n).alias(f"{n}_") for n in names), *(c for c in right.columns if c not in names))
    met = F.lit(True)
    for n in names:
        met = met & F.col(n).eqNullSafe(F.col(f"{n}_"))
    return left.join(right, met, how).drop(*(f"{n}_" for n in names))


def rates(classes: DataFrame, goal: DataFrame) -> DataFrame:
    """classes: source_, worth_, sum_ (words), mass_ (words times worth). goal: source_, left_. One row a source:
    certain_ (least worth of certain documents, null if there are none), rest_ (words left for the others), rate_ (their
    inclusion probability over worth) and share_ (of their words that is due)."""
    down = Window.partitionBy("source_").orderBy(F.desc("worth_"))
    above = F.coalesce(F.sum("sum_").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    below = F.sum("mass_").over(down.rowsBetween(0, Window.unboundedFollowing))
    rows = _same(classes, goal.select("source_", "left_"), "source_")
    sure = F.coalesce((F.col("left_") - above) / F.nullif(below, F.lit(0.0)) * F.col("worth_") >= 1, F.lit(False))
    rows = rows.withColumn("sure_", sure)
    due = F.first("left_") - F.coalesce(F.sum(F.when(F.col("sure_"), F.col("sum_"))), F.lit(0))
    mass, words = (F.coalesce(F.sum(F.when(~F.col("sure_"), F.col(c))), F.lit(0)) for c in ("mass_", "sum_"))
    rows = rows.groupBy("source_").agg(F.min(F.when(F.col("sure_"), F.col("worth_"))).alias("certain_"), due.alias("rest_"), mass.alias("mass_"), words.alias("others_"))
    return rows.select(
        "source_", "certain_", "rest_", F.when(F.col("mass_") > 0, F.col("rest_") / F.col("mass_")).otherwise(0.0).alias("rate_"),
        F.when(F.col("others_") > 0, F.col("rest_") / F.col("others_")).otherwise(0.0).alias("share_"),
    )


def filling(rows: DataFrame) -> DataFrame:
    """rows: source_, size_, rest_, drawn_, open_. How many more documents of which length each source takes: source_,
    size_, more_. A fold over the lengths not taken, the longest first."""
    gap = F.first("rest_") - F.coalesce(F.sum(F.when(F.col("drawn_"), F.col("size_"))), F.lit(0))
    gaps = rows.groupBy("source_").agg(gap.alias("gap_"))
    sizes = rows.where("open_").groupBy("source_", "size_").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("source_").agg(F.sort_array(F.collect_list(F.struct("size_", "n")), False).alias("sizes_"))
    rows = _same(sizes, gaps.where("gap_ > 0"), "source_")
    none = F.array().cast("array<struct<size_: bigint, more_: bigint, spare: bigint>>")

    def take(s, x):
        fits = F.least(x["n"], F.floor(s["gap"] / x["size_"]))
        return F.struct((s["gap"] - fits * x["size_"]).alias("gap"), F.array_append(s["made"], F.struct(x["size_"].alias("size_"), fits.alias("more_"), (x["n"] - fits).alias("spare"))).alias("made"))

    state = F.aggregate("sizes_", F.struct(F.col("gap_").cast("double").alias("gap"), none.alias("made")), take)
    rows = rows.select("source_", state.alias("state_"))
    spare = F.array_min(F.transform(F.filter("state_.made", lambda x: x["spare"] > 0), lambda x: x["size_"]))
    last = F.when(F.col("state_.gap") > spare / 2, spare)
    rows = rows.select("source_", last.alias("last_"), F.explode("state_.made").alias("x"))
    more = F.col("x.more_") + F.coalesce((F.col("x.size_") == F.col("last_")).cast("long"), F.lit(0))
    return rows.select("source_", F.col("x.size_").alias("size_"), more.alias("more_")).where("more_ > 0")


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED, text: str = "text", source: str = "source", key: str = "doc_id", weight: str | None = None) -> DataFrame:
    """One row per document: key_, digest_ (MD5 of the text), source_, size_, words_, target_, odds_, copies_."""
    given = F.greatest(F.col(weight).cast("double"), F.lit(1e-9)) if weight else None
    digits = F.pow(F.lit(10.0), F.floor(F.log10(given)) - 2) if weight else None
    worth = F.round(given / digits) * digits if weight else 1 + F.floor(F.sqrt(n_words(text).cast("double")))
    rows = docs.select(
        F.col(key).alias("key_"), F.col(source).alias("source_"), n_words(text).alias("size_"),
        F.md5(F.coalesce(F.col(text), F.lit(""))).alias("digest_"), F.coalesce(worth.cast("double"), F.lit(1.0)).alias("worth_"),
    )
    rows = cut(rows, "sizes", tidy=False)
    classes = rows.groupBy("source_", "worth_").agg(F.sum("size_").alias("sum_"), F.sum(F.col("size_") * F.col("worth_")).alias("mass_"))
    goal = targets(classes.groupBy("source_").agg(F.sum("sum_").alias("words_")), weights, most)
    goal = goal.withColumn("whole_", F.when(F.col("words_") > 0, F.floor(F.col("target_") / F.col("words_"))).otherwise(0).cast("int"))
    goal = goal.withColumn("left_", F.col("target_") - F.col("whole_") * F.col("words_"))
    rows = _same(rows, _same(goal, rates(classes, goal), "source_"), "source_")
    rows = rows.withColumn("sure_", (F.col("size_") > 0) & F.coalesce(F.col("worth_") >= F.col("certain_"), F.lit(False)))
    rows = rows.withColumn("odds_", F.when(F.col("sure_"), 0.0).otherwise(pareto(unit(F.col("key_"), F.col("digest_"), seed=seed), F.col("rate_") * F.col("worth_"))))
    # the same order in (0, 1), spread about evenly
    level = F.least(F.greatest(F.col("share_"), F.lit(1e-12)), F.lit(1 - 1e-12))
    rows = rows.withColumn("near_", F.col("odds_") * (level / (1 - level)))
    rows = rows.withColumn("near_", F.col("near_") / (1 + F.col("near_")))
    ties = [F.col("key_"), F.col("digest_")]
    rows = before(rows, ["source_"], "near_", ties, F.when(F.col("sure_"), 0).otherwise(F.col("size_")), "before_")
    drawn = ~F.col("sure_") & (F.col("size_") > 0) & (F.col("before_") + F.col("size_") <= F.col("rest_"))
    rows = rows.withColumn("drawn_", drawn).withColumn("open_", ~F.col("sure_") & ~F.col("drawn_") & (F.col("size_") > 0))
    rows = cut(rows.select("key_", "digest_", "source_", "size_", "words_", "target_", "whole_", "rest_", "sure_", "drawn_", "open_", "odds_", "near_"), "drawn", tidy=False)
    rows = _same(rows, filling(rows), "source_", "size_", how="left")
    asked = F.col("open_") & F.col("more_").isNotNull()
    ranked = before(rows.where(asked), ["source_", "size_"], "near_", ties, F.lit(1), "earlier_")
    rows = rows.where(~asked).withColumn("earlier_", F.lit(None).cast("long")).unionByName(ranked)
    taken = F.col("sure_") | F.col("drawn_") | F.coalesce(F.col("earlier_") < F.col("more_"), F.lit(False))
    return rows.select("key_", "digest_", "source_", "size_", "words_", "target_", "odds_", (F.col("whole_") + taken.cast("int")).alias("copies_"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", **options) -> DataFrame:
    """One row per document: key, size, source_size, target (of its source), taken."""
    return plan(docs, text=text, source=source, key=key, **options).select(
        F.col("key_").alias(key), F.col("size_").alias("size"), F.col("words_").alias("source_size"), F.col("target_").alias("target"),
        (F.col("size_") * F.col("copies_")).cast("long").alias("taken"),
    )


def mixed(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, with all its columns. Rows equal in
    key, text and source are numbered on both sides, so together they are there as often as they are taken."""
    same = ("doc_", "text_", "from_")
    number = F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(0)))
    copies = plan(docs, text=text, source=source, key=key, **options)
    copies = copies.select(F.col("key_").alias("doc_"), F.col("digest_").alias("text_"), F.col("source_").alias("from_"), "copies_")
    copies = copies.withColumn("nth_", F.row_number().over(Window.partitionBy(*same).orderBy(F.desc("copies_")))).where("copies_ > 0")
    names = docs.columns
    rows = docs.select(F.struct(*names).alias("row_"), F.col(key).alias("doc_"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("text_"), F.col(source).alias("from_"))
    rows = _same(rows.withColumn("nth_", number), copies, *same, "nth_")
    rows = rows.withColumn("copy_", F.explode(F.sequence(F.lit(1), F.col("copies_"))))
    return rows.select(*(F.col("row_")[c].alias(c) for c in names))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
  md5(coalesce(text, '')) AS digest FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS words, [5, 2, 1][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS w
  FROM d GROUP BY source),
l AS (SELECT *, 3 * words AS cap, ((sum(words) OVER ())::BIGINT - coalesce((sum(3 * words) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::BIGINT, 0))
  / (sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS lev FROM s WINDOW o AS (ORDER BY 3 * words / w, encode(source) NULLS LAST)),
t AS (SELECT source, words, CASE WHEN cap <= lev * w THEN cap::DOUBLE ELSE w * max(CASE WHEN cap > lev * w THEN lev END) OVER () END AS target FROM l),
g AS (SELECT *, CASE WHEN words > 0 THEN floor(target / words)::INT ELSE 0 END AS whole FROM t),
h AS (SELECT *, target - whole * words AS due FROM g),
e AS (SELECT d.*, h.words, h.target, h.whole, h.due, (1 + floor(sqrt(size::DOUBLE)))::BIGINT AS worth, row_number() OVER () AS i FROM d JOIN h ON d.source IS NOT DISTINCT FROM h.source),
k AS (SELECT source, worth, any_value(due) AS due, sum(size)::BIGINT AS sz, sum(size * worth)::BIGINT AS m FROM e GROUP BY source, worth),
c AS (SELECT *, coalesce((due - coalesce((sum(sz) OVER (PARTITION BY source ORDER BY worth DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::BIGINT, 0))
  / nullif((sum(m) OVER (PARTITION BY source ORDER BY worth DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT, 0) * worth >= 1, false) AS sure FROM k),
r AS (SELECT source, min(worth) FILTER (sure) AS certain, any_value(due) - coalesce(sum(sz) FILTER (sure), 0)::BIGINT AS rest,
  coalesce(sum(m) FILTER (NOT sure), 0)::BIGINT AS mass, coalesce(sum(sz) FILTER (NOT sure), 0)::BIGINT AS others FROM c GROUP BY source),
q AS (SELECT e.*, r.rest, size > 0 AND coalesce(worth >= certain, false) AS sure, CASE WHEN mass > 0 THEN rest / mass ELSE 0.0::DOUBLE END * worth AS share,
  least(greatest(CASE WHEN others > 0 THEN rest / others ELSE 0.0::DOUBLE END, 1e-12::DOUBLE), 1::DOUBLE - 1e-12::DOUBLE) AS lv,
  (('0x' || substr(md5('mixture|' || coalesce(doc_id::VARCHAR, '-') || '|' || digest), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS draw
  FROM e JOIN r ON e.source IS NOT DISTINCT FROM r.source),
p AS (SELECT *, least(greatest(share, 1e-12::DOUBLE), 1::DOUBLE - 1e-12::DOUBLE) AS pi FROM q),
o AS (SELECT *, CASE WHEN NOT sure THEN draw / (1 - draw) / (pi / (1 - pi)) * (lv / (1 - lv)) END AS odds FROM p),
n AS (SELECT *, coalesce(odds / (1 + odds), 0) AS near FROM o),
b AS (SELECT *, coalesce(sum(CASE WHEN sure THEN 0 ELSE size END) OVER (PARTITION BY source ORDER BY near, doc_id, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM n),
x AS (SELECT *, NOT sure AND size > 0 AND before + size <= rest AS drawn FROM b),
y AS (SELECT source, any_value(rest) - coalesce(sum(size) FILTER (drawn), 0)::BIGINT AS gap FROM x GROUP BY source),
z AS (SELECT source, size, count(*)::BIGINT AS n, row_number() OVER (PARTITION BY source ORDER BY size DESC) AS k FROM x WHERE NOT sure AND NOT drawn AND size > 0 GROUP BY source, size),
f(source, k, gap, size, more, spare) AS (SELECT source, 0::BIGINT, gap, 0::BIGINT, 0::BIGINT, 0::BIGINT FROM y WHERE gap > 0
  UNION ALL SELECT f.source, z.k, f.gap - least(z.n, floor(f.gap / z.size)::BIGINT) * z.size, z.size, least(z.n, floor(f.gap / z.size)::BIGINT), z.n - least(z.n, floor(f.gap / z.size)::BIGINT)
  FROM f JOIN z ON z.source IS NOT DISTINCT FROM f.source AND z.k = f.k + 1),
a AS (SELECT source, min(size) FILTER (spare > 0) AS shortest, arg_max(gap, k) AS gap FROM f GROUP BY source),
u AS (SELECT f.source, f.size, f.more + (a.gap > a.shortest / 2 AND f.size = a.shortest)::BIGINT AS more FROM f JOIN a ON a.source IS NOT DISTINCT FROM f.source WHERE f.k > 0),
v AS (SELECT x.*, u.more, row_number() OVER (PARTITION BY x.source, x.size, x.sure OR x.drawn ORDER BY near, doc_id, digest) AS place FROM x LEFT JOIN u ON u.source IS NOT DISTINCT FROM x.source AND u.size = x.size)
SELECT doc_id, size, words AS source_size, target,
  (size * (whole + CASE WHEN sure OR drawn OR (size > 0 AND coalesce(place <= more, false)) THEN 1 ELSE 0 END))::BIGINT AS taken FROM v
"""
