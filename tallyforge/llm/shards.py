"""Sharding by proportional stratified interleaving.

Within each source (null is one of its own) rows are ranked in seeded-shuffled order; the rank as
a fraction of the source, shifted by a seeded offset, spreads every source evenly over (0, 1).
Sorting all rows by that fraction and cutting the order into equal runs gives shards whose sizes
in rows differ by one at most and whose mixtures match the whole: law `rows`. Equal texts need not
share a shard; with a third of all rows equal, no assignment with balanced counts could hold that.

Ranks come from bucket counts and windows within buckets, so neither a hot source nor the global
order gathers in one task. Ties in the shuffle go by doc_id and then by text; rows equal in all of
these are interchangeable. Null texts have size 1 and CRC 0. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .order import before, unit

SHARDS, SEED = 16, "interleave"


def interleave(docs: DataFrame, shards: int = SHARDS, seed: str = SEED, text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """One row per document: key, size, text_crc32, law, shard, slot, grown_shard."""
    raw = F.coalesce(F.encode(F.col(text), "UTF-8"), F.encode(F.lit(""), "UTF-8"))
    rows = docs.select(
        F.col(key).alias("key_"), F.col(source).alias("source_"), (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"), unit(F.col(key), F.md5(raw), seed=seed).alias("draw_"),
    )
    totals = rows.groupBy("source_").agg(F.count("*").alias("n_")).withColumn("shift_", unit(F.col("source_"), seed=seed)).withColumnRenamed("source_", "source__")
    ties = [F.col("key_"), F.col("text_crc32"), F.col("size")]
    ranked = before(rows, ["source_"], "draw_", ties, F.lit(1).cast("long"), "rank_")
    ranked = ranked.join(totals, F.col("source_").eqNullSafe(F.col("source__")))
    ranked = ranked.withColumn("fraction_", (F.col("rank_") + F.col("shift_")) / F.col("n_"))
    placed = before(ranked, [], "fraction_", [F.col("source_"), F.col("draw_"), *ties], F.lit(1).cast("long"), "at_")
    count = totals.agg(F.sum("n_").alias("all_"))  # one row
    placed = placed.join(F.broadcast(count)).withColumn("shard", F.expr(f"at_ * {shards} div all_").cast("int"))
    start = F.expr(f"(shard * all_ + {shards} - 1) div {shards}")
    return placed.select(
        F.col("key_").alias(key), "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("at_") - start).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleave(table(spark, sf_dir, "documents"))
