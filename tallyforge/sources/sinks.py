"""Sinks. Overwriting is never the default; what is ordered is written by ranges, in as many files as wanted."""

from __future__ import annotations

import datetime
import json
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

FACT_KEYS = ("ticker", "period_end")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; where none is named, a temporary one, for a local master only."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="tallyforge-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def fact_table(df: DataFrame, name: str | None = None, path: str | None = None, buckets: int | None = None, keys: tuple[str, ...] = FACT_KEYS) -> tuple[DataFrame, int]:
    """Saves facts as a table bucketed and sorted by `keys`, and counts its rows on the way; returns the
    table and the count. Top-1 picks, restatements and statements of the table need no exchange, since
    their keys hold those of the buckets. A ticker's facts are spread over its dates."""
    spark = df.sparkSession
    name = name or f"facts_{uuid.uuid4().hex}"
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    seen = Observation(name)
    rows = df.repartition(n, *keys).observe(seen, F.count(F.lit(1)).alias("rows"))
    rows.write.bucketBy(n, *keys).sortBy(*keys).option("path", path or f"{shared_dir(spark)}/{name}").saveAsTable(name)
    return spark.table(name), int(seen.get["rows"])


def tables(frames: dict[str, DataFrame], path: str, overwrite: bool = False) -> dict[str, int]:
    """Each frame as a persisted table of its name below path, and the number of its rows, observed while writing."""
    counts = {}
    for name, df in frames.items():
        seen = Observation(name)
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite" if overwrite else "errorifexists").option("path", f"{path}/{name}").saveAsTable(name)
        counts[name] = int(seen.get["rows"])
    return counts


def facts(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Parquet partitioned by ticker, rows of a ticker in few files."""
    df.repartition("ticker").sortWithinPartitions("line_item", "fiscal_year", "fiscal_period", "filed_date").write.mode("overwrite" if overwrite else "errorifexists").partitionBy("ticker").parquet(path)


def views(frames: dict[str, DataFrame]) -> None:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def ordered(df: DataFrame, order: list[str | Column], files: int) -> DataFrame:
    """df in `files` ranges of the order, each sorted: files named in sequence hold the rows in order."""
    return df.repartitionByRange(files, *order).sortWithinPartitions(*order)


def csv(df: DataFrame, path: str, order: list[str], overwrite: bool = False, files: int = 1) -> None:
    """Sorted CSV: its files, taken by name, hold the rows in order. A single file is for dimensions and small facts."""
    ordered(df, order, files).write.mode("overwrite" if overwrite else "errorifexists").csv(path, header=True)


def stamp(forecasts: DataFrame, run_date: str) -> DataFrame:
    """Adds the vintage (an ISO day)."""
    return forecasts.withColumn("forecast_run_date", F.lit(run_date))


def forecasts(df: DataFrame, path: str, run_date: str | None = None, overwrite: bool = False) -> None:
    """Forecasts as Parquet, stamped with the vintage: a given ISO day, or today's in UTC."""
    day = run_date or datetime.datetime.now(datetime.UTC).date().isoformat()
    stamp(df, day).write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


class VintageLog:
    """Append-only vintages below a path. A snapshot is a folder of Parquet, by run date; manifest/N names
    the snapshots that are part of version N. A snapshot counts once its manifest is there, which a rename
    that never overwrites puts in place: a writer that fails before leaves the log as it was, and of two writers one fails."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def version(self) -> int:
        """0 for an empty log."""
        found = self.fs.globStatus(self._at("manifest/[0-9]*")) or []
        return max((int(x.getPath().getName()) for x in found), default=0)

    def snapshots(self, version: int | None = None) -> list[str]:
        version = self.version() if version is None else version
        if not version:
            return []
        return json.loads("".join(r.value for r in self.spark.read.text(f"{self.path}/manifest/{version}", wholetext=True).collect()))

    def read(self, schema: str, version: int | None = None) -> DataFrame:
        """All rows of a version; columns that a snapshot lacks are null."""
        found = [f"{self.path}/{x}" for x in self.snapshots(version)]
        if not found:
            return self.spark.createDataFrame([], schema)
        parts = [self.spark.read.option("basePath", x).parquet(x) for x in found]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part, allowMissingColumns=True)
        return rows.withColumn("forecast_run_date", F.col("forecast_run_date").cast("string"))

    def append(self, new: DataFrame) -> int:
        """Adds the rows that are not there yet and returns their number. Rows are compared by a hash of what they
        hold (a missing column is a null), with those of their run date only: the others are not read."""
        names = sorted(new.columns)
        digest = F.sha2(F.to_json(F.struct(*names)), 256)
        rows = new.withColumn("forecast_run_date", F.col("forecast_run_date").cast("string")).withColumn("row_", digest).dropDuplicates(["forecast_run_date", "row_"])
        version = self.version()
        if version:
            before = self.read("", version)
            for n in set(names) - set(before.columns):
                before = before.withColumn(n, F.lit(None).cast(new.schema[n].dataType))
            before = before.select("forecast_run_date", F.sha2(F.to_json(F.struct(*sorted(before.columns))), 256).alias("row_"))
            rows = rows.join(before, ["forecast_run_date", "row_"], "left_anti")
        seen, name = Observation(), f"data/{uuid.uuid4().hex}"
        rows.drop("row_").observe(seen, F.count(F.lit(1)).alias("rows")).write.partitionBy("forecast_run_date").parquet(f"{self.path}/{name}")
        added = int(seen.get["rows"])
        if added:
            self.commit(version, name)
        return added

    def commit(self, version: int, snapshot: str) -> None:
        jvm = self.spark._jvm
        draft = self._at(f"manifest/_{uuid.uuid4().hex}")
        out = self.fs.create(draft)
        out.write(bytearray(json.dumps([*self.snapshots(version), snapshot]).encode()))
        out.close()
        never = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri()).rename(draft, self._at(f"manifest/{version + 1}"), never)


def extract(df: DataFrame) -> DataFrame:
    """The eight typed columns of a dashboard extract: texts and numbers without nulls, a date that may be one."""
    text = {c: F.coalesce(c, F.lit("")) for c in ("ticker", "line_item", "fiscal_period", "accession_no", "filing_url")}
    made = text | {"period_end": F.col("period_end").cast("date"), "fiscal_year": F.coalesce(F.col("fiscal_year").cast("int"), F.lit(0)), "value": F.coalesce(F.col("value").cast("double"), F.lit(0.0))}
    return df.select(*(made[c].alias(c) for c in ("ticker", "line_item", "period_end", "fiscal_year", "fiscal_period", "value", "accession_no", "filing_url")))


def markdown_head(df: DataFrame) -> str:
    return "| " + " | ".join(df.columns) + " |\n|" + "---|" * len(df.columns)


def markdown_lines(df: DataFrame) -> DataFrame:
    """df with its Markdown table row as column line: two decimals in floats, nothing for null."""
    cells = [F.coalesce(F.format_number(c, 2) if t == "double" else F.col(c).cast("string"), F.lit("")) for c, t in df.dtypes]
    return df.withColumn("line", F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")))


def markdown(df: DataFrame, path: str, order: list[str], files: int = 1) -> None:
    """A Markdown table as text files that, taken by name, hold the heading and then the rows in order."""
    head = df.sparkSession.range(1).select(F.lit(markdown_head(df)).alias("line"))
    head.coalesce(1).write.text(f"{path}/0_head")
    ordered(markdown_lines(df), order, files).select("line").write.text(f"{path}/1_rows")


def company_yaml(row: dict, path: str) -> None:
    import yaml

    with open(path, "w", encoding="utf-8") as f:
        yaml.safe_dump(row, f, sort_keys=False)
