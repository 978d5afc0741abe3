"""Structured Streaming: late filings update the canonical facts; windows over event streams."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.vocab import FACT_COLUMNS, FACT_DDL
from ..operators.dedupe import canonical


def read_facts(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(FACT_DDL).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


TABLE_DDL = f"{FACT_DDL}, version long"


def _has_rows(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/ticker=*")
    return bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at))


def versions(spark: SparkSession, path: str) -> DataFrame:
    """Every version of every ticker's facts that the table still has."""
    return spark.read.schema(TABLE_DDL).parquet(path) if _has_rows(spark, path) else spark.createDataFrame([], TABLE_DDL)


def current(spark: SparkSession, path: str, below: int | None = None) -> DataFrame:
    """Each ticker's facts in its latest version (below a given one). Versions are folders, so only their names and
    counts are read to find the latest, and the facts of older ones are not read."""
    rows = versions(spark, path)
    rows = rows if below is None else rows.where(F.col("version") < below)
    latest = rows.groupBy("ticker").agg(F.max("version").alias("version"))
    return rows.join(latest, ["ticker", "version"], "left_semi").select(*FACT_COLUMNS)


def write_version(rows: DataFrame, path: str, version: int) -> None:
    """Adds a version of the tickers in rows; written again, it replaces itself and nothing else."""
    rows = rows.withColumn("version", F.lit(version).cast("long")).repartition("ticker")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ticker", "version").parquet(path)


def _base(spark: SparkSession, path: str, checkpoint: str) -> int:
    """The first version of a stream: after all that was there when it first started. Kept with the
    table, by the stream's checkpoint, so that a restarted stream goes on where it was."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_streams/{hashlib.sha256(checkpoint.encode()).hexdigest()}")
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        last = versions(spark, path).agg(F.max("version")).first()[0]
        out = fs.create(hadoop, False)
        out.write(bytearray(str(0 if last is None else last + 1).encode()))
        out.close()
    return int(spark.read.text(hadoop.toString()).first().value)


def upsert(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keeps the table of canonical facts at path, of all batches and of what it held before: a late
    amendment replaces what it amends.

    A batch reads and writes the tickers that it touches, and no others: their latest version is merged with the batch and
    becomes a new version, in folders of their own. So the files of other tickers stay, a reader sees
    a ticker before or after a batch and never between, and a batch that is run again gives the same table."""
    spark = stream.sparkSession
    base = _base(spark, path, checkpoint)

    def step(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        before = current(own, path, below=base + number).join(batch.select("ticker").distinct(), "ticker", "left_semi")
        write_version(canonical(batch.select(*FACT_COLUMNS).unionByName(before).distinct()), path, base + number)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def vacuum(spark: SparkSession, path: str) -> int:
    """Deletes the folders of versions that a later one of their ticker replaces, and returns their number. Not while a batch runs."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{path}/ticker=*/version=*")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    held: dict[str, list] = {}
    for x in fs.globStatus(at) or []:
        held.setdefault(x.getPath().getParent().getName(), []).append(x.getPath())
    old = [p for own in held.values() for p in sorted(own, key=lambda p: int(p.getName().partition("=")[2]))[:-1]]
    for p in old:
        fs.delete(p, True)
    return len(old)


def windowed(events: DataFrame, size: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts and sums by event type in tumbling or sliding windows; ts may be without time zone."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    window = F.window("ts", size, slide) if slide else F.window("ts", size)
    return rows.groupBy(window, "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    rows = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return rows.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
