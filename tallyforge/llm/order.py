"""Ranks and running sums over a whole table without gathering it, by evenly filled buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets a unit interval is cut into. Rows fall into them evenly, so a group of n rows puts
#: about n / BUCKETS of them in one window.
BUCKETS = 4096


def unit(*parts: Column, seed: str) -> Column:
    """A number in (0, 1) that depends on the parts alone: 52 bits of an MD5, so SQL engines agree."""
    text = F.concat_ws("|", F.lit(seed), *(F.coalesce(p.cast("string"), F.lit("-")) for p in parts))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def before(df: DataFrame, group: list[str], at: str, ties: list[Column], amount: Column, to: str, buckets: int = BUCKETS) -> DataFrame:
    """Adds `to`: the sum of amount over the rows of the group that come earlier in (at, ties).

    at: a number in [0, 1]. Sums by bucket are small; each row then needs only its own bucket."""
    df = df.withColumn("bucket_", F.least(F.floor(F.col(at) * buckets), F.lit(buckets - 1)).cast("int")).withColumn("amount_", amount)
    keys = [*group, "bucket_"]
    sums = df.groupBy(*keys).agg(F.sum("amount_").alias("sum_"))
    over = Window.partitionBy(*(group or [F.lit(0)])).orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*(F.col(k).alias(f"{k}__") for k in keys), F.coalesce(F.sum("sum_").over(over), F.lit(0)).alias("start_"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}__"))
    inner = Window.partitionBy(*keys).orderBy(at, *ties).rowsBetween(Window.unboundedPreceding, -1)
    df = df.join(sums, same).withColumn(to, F.col("start_") + F.coalesce(F.sum("amount_").over(inner), F.lit(0)))
    return df.drop("bucket_", "amount_", "start_", *(f"{k}__" for k in keys))
