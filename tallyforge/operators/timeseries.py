"""As-of and range joins without cross products, fills, and period returns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of_all(left: DataFrame, series: dict[str, tuple[DataFrame, str]], on: list[str], at: str, bucket: str = "month") -> DataFrame:
    """Adds a column for each entry of `series`, name: (frame, value): the value of its last row at or
    before left's `at`, within `on`. Nulls are no values; ties go to the greatest.

    All frames, of whatever frequency, pass once. The state is carried on two levels: the last value
    of each bucket of time is aggregated before the shuffle, a window over these few rows carries it to
    the buckets after, and each bucket then fills alone, so no task holds more than a bucket of a key."""
    names = list(series)
    kinds = {n: f.schema[v].dataType for n, (f, v) in series.items()}
    keys = [f"on{i}_" for i in range(len(on))]
    asked = left.select(*(F.col(c).alias(k) for c, k in zip(on, keys, strict=True)), F.col(at).alias("at_"), F.lit(1).alias("side_"), F.struct(*left.columns).alias("row_"), *(F.lit(None).cast(kinds[n]).alias(f"v_{n}") for n in names))
    parts = [asked]
    for name, (frame, value) in series.items():
        own = frame.where(F.col(value).isNotNull()).groupBy(*(F.col(c).alias(k) for c, k in zip(on, keys, strict=True)), F.col(at).alias("at_")).agg(F.max(value).alias("v_"))
        parts.append(own.select(*keys, "at_", F.lit(0).alias("side_"), F.lit(None).cast(asked.schema["row_"].dataType).alias("row_"), *((F.col("v_") if n == name else F.lit(None).cast(kinds[n])).alias(f"v_{n}") for n in names)))
    rows = reduce(DataFrame.unionByName, parts).withColumn("bucket_", F.date_trunc(bucket, "at_"))
    last = rows.groupBy(*keys, "bucket_").agg(*(F.max_by(f"v_{n}", F.when(F.col(f"v_{n}").isNotNull(), F.col("at_"))).alias(f"last_{n}") for n in names))
    before = Window.partitionBy(*keys).orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1)
    start = last.select(*(F.col(k).alias(f"own_{k}") for k in keys), F.col("bucket_").alias("own_bucket_"), *(F.last(f"last_{n}", ignorenulls=True).over(before).alias(f"start_{n}") for n in names))
    met = reduce(lambda x, k: x & F.col(k).eqNullSafe(F.col(f"own_{k}")), [*keys, "bucket_"], F.lit(True))
    inside = Window.partitionBy(*keys, "bucket_").orderBy("at_", "side_").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(start, met).select("side_", "row_", *(F.coalesce(F.last(f"v_{n}", ignorenulls=True).over(inside), F.col(f"start_{n}")).alias(n) for n in names))
    return rows.where("side_ = 1").select("row_.*", *names)


def as_of(left: DataFrame, right: DataFrame, on: list[str], at: str, value: str, to: str, bucket: str = "month") -> DataFrame:
    """Adds `to`: the value of the last row of right at or before left's `at`, within `on`."""
    return as_of_all(left, {to: (right, value)}, on, at, bucket)


def period_return(periods: DataFrame, prices: DataFrame, on: list[str]) -> DataFrame:
    """periods: on, start, end and more. prices: on, date, close. Return between the last prices at or
    before each, in one pass: a period asks twice. Equal periods give one row; a first price of 0 or less gives null."""
    asks = F.explode(F.array(*(F.struct(F.lit(c).alias("which_"), F.col(c).alias("date")) for c in ("start", "end"))))
    asked = periods.select(*on, F.struct(*periods.columns).alias("period_"), asks.alias("ask_")).select(*on, "period_", "ask_.*")
    seen = as_of(asked, prices, on, "date", "close", "close_")
    both = seen.groupBy("period_").agg(*(F.max(F.when(F.col("which_") == c, F.col("close_"))).alias(f"close_{c}") for c in ("end", "start")))
    return both.select("period_.*", "close_end", "close_start").withColumn("return", F.col("close_end") / F.when(F.col("close_start") > 0, F.col("close_start")) - 1)


def range_average(periods: DataFrame, series: DataFrame, on: list[str]) -> DataFrame:
    """periods: on, start, end (both dates within). series: on, date, value. Adds the mean of the
    values inside, both ends included; null where there are none. Rows meet by month, not by range:
    each period is written out for the months it touches."""
    months = F.explode(F.sequence(F.trunc("start", "month"), F.trunc("end", "month"), F.expr("interval 1 month")))
    spread = periods.select(*on, "start", "end", months.alias("month_"))
    values = series.select(*on, F.col("date"), F.col("value"), F.trunc("date", "month").alias("month_"))
    met = spread.join(values, [*on, "month_"]).where("date >= start AND date <= end")
    means = met.groupBy(*on, "start", "end").agg(F.avg("value").alias("mean"))
    return periods.join(means, [*on, "start", "end"], "left")


def series_averages(periods: DataFrame, series: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """periods: start, end. series: series_id, date, value, in long form. Adds a column for each name:
    its mean inside the period, both ends included, null where there is none. All series meet the periods by month in one join."""
    months = F.explode(F.sequence(F.trunc("start", "month"), F.trunc("end", "month"), F.expr("interval 1 month")))
    spread = periods.select("start", "end").distinct().withColumn("month_", months)
    values = series.where(F.col("series_id").isin(*names) & F.col("value").isNotNull()).select("series_id", "date", "value", F.trunc("date", "month").alias("month_"))
    # a day's sums first: however many rows a month has, few of them meet the periods
    days = values.groupBy("month_", "date", "series_id").agg(F.sum("value").alias("sum_"), F.count("value").alias("n_"))
    met = spread.join(days, "month_").where("date >= start AND date <= end")
    means = met.groupBy("start", "end").agg(*((F.sum(F.when(F.col("series_id") == n, F.col("sum_"))) / F.sum(F.when(F.col("series_id") == n, F.col("n_")))).alias(n) for n in names))
    return periods.join(means, ["start", "end"], "left")


def filled(df: DataFrame, on: list[str], by: str, columns: list[str]) -> DataFrame:
    """Forward fill, then backward."""
    window = Window.partitionBy(*on).orderBy(by)
    back, ahead = window.rowsBetween(Window.unboundedPreceding, 0), window.rowsBetween(0, Window.unboundedFollowing)
    return df.withColumns({c: F.coalesce(F.last(c, True).over(back), F.first(c, True).over(ahead)) for c in columns})


def quarter_starts(df: DataFrame, last: str, horizon: int = 4) -> DataFrame:
    """The next quarter starts, three months after `last` or later."""
    first = F.add_months(F.col(last), 3)
    start = F.trunc(first, "quarter")
    start = F.when(start < first, F.add_months(start, 3)).otherwise(start)
    return df.withColumn("period_start", F.explode(F.transform(F.sequence(F.lit(0), F.lit(horizon - 1)), lambda i: F.add_months(start, i * 3))))
