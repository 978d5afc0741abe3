"""Other sources: parquet sets, CSV vintages, lookups, submissions, payload files."""

from __future__ import annotations

import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FORECAST_DDL = "ticker string, model string, period_end string, yhat double, yhat_lower_80 double, yhat_upper_80 double, yhat_lower_95 double, yhat_upper_95 double, forecast_run_date string"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def forecasts(spark: SparkSession, *paths: str) -> DataFrame:
    """All forecast files that are there, aligned by name; an empty table if none is. A file without
    a vintage gets the day it was last written."""
    found = [p for p in paths if exists(spark, p)]
    if not found:
        return spark.createDataFrame([], FORECAST_DDL)
    rows = spark.read.option("mergeSchema", True).parquet(*found)
    day = F.col("_metadata.file_modification_time").cast("date").cast("string")
    stamped = F.coalesce(F.col("forecast_run_date"), day) if "forecast_run_date" in rows.columns else day
    return rows.withColumn("forecast_run_date", stamped)


def latest_file(spark: SparkSession, pattern: str) -> str | None:
    """The last by name of the files that fit a pattern, as dated names sort; None if none does."""
    p = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or []
    return max((x.getPath().toString() for x in found), key=lambda x: x.rpartition("/")[2], default=None)


def macro_series(spark: SparkSession, path: str, *series: str) -> DataFrame:
    """Observations of macro series (series_id, date, value) from CSV files with these columns; a
    point stands for a value that is missing. The rows fit as_of() and range_average()."""
    rows = spark.read.schema("series_id string, date date, value string").csv(path, header=True)
    rows = rows.where(F.col("series_id").isin(*series)) if series else rows
    return rows.withColumn("value", F.col("value").try_cast("double"))


def vintages(spark: SparkSession, path: str) -> DataFrame:
    """CSV written by sinks.csv, or an empty table."""
    if not exists(spark, path):
        return spark.createDataFrame([], FORECAST_DDL)
    return spark.read.schema(FORECAST_DDL).csv(path, header=True)


def resolve(companies: DataFrame, wanted: DataFrame, ticker: str = "ticker") -> DataFrame:
    """Company rows of wanted tickers, in any case and with spaces; unknown ones have nulls."""
    known = companies.withColumn("key_", F.upper(F.trim("ticker"))).drop("ticker")
    return wanted.withColumn("key_", F.upper(F.trim(ticker))).join(known, "key_", "left").drop("key_")


def cached(path: str, load: Callable[[], str], ttl: float = 7 * 86400) -> str:
    """A file's text, loaded anew when the file is missing or older than ttl seconds. For a driver's small lookups."""
    if os.path.exists(path) and time.time() - os.path.getmtime(path) < ttl:
        with open(path, encoding="utf-8") as f:
            return f.read()
    text = load()
    with open(f"{path}.new", "w", encoding="utf-8") as f:
        f.write(text)
    os.replace(f"{path}.new", path)
    return text


def first_submission(rows: DataFrame, form: str, item: str | None = None) -> DataFrame:
    """rows: arrays form, accessionNumber, primaryDocument, items of equal length. Adds the first
    entry of a form (whose comma-separated items hold `item`)."""
    zipped = F.arrays_zip("form", "accessionNumber", "primaryDocument", "items")

    def wanted(x):
        hit = x["form"] == form
        return hit & F.array_contains(F.transform(F.split(x["items"], ","), lambda i: F.trim(i)), item) if item else hit

    return rows.withColumn("submission", F.try_element_at(F.filter(zipped, wanted), F.lit(1)))


def payload_json(text: str = "text"):
    """A payload itself, or the first fenced JSON block of a text."""
    t = F.trim(F.col(text))
    return F.when(t.startswith("{"), t).otherwise(F.nullif(F.regexp_extract(t, r"(?s)```json\s*(\{.*?\})\s*```", 1), F.lit("")))


def yaml_config(path: str) -> dict:
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f)
