"""Company-facts documents: nested JSON to fact rows, with the choice of concepts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vocab import DEFAULT_NAMESPACE, DEFAULT_UNIT, FACT_COLUMNS, FISCAL_PERIODS, NAMESPACES, SYNONYMS, UNITS
from ..operators.dedupe import choose_concepts, last_years
from .adapter import fact_id, filing_url

ENTRY = "STRUCT<end: STRING, val: DOUBLE, accn: STRING, fy: INT, fp: STRING, form: STRING, filed: STRING, frame: STRING>"
SCHEMA = f"cik BIGINT, facts MAP<STRING, MAP<STRING, STRUCT<label: STRING, units: MAP<STRING, ARRAY<{ENTRY}>>>>>"


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row a file: path and json. Files are read whole; any frame with a json column will do instead."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("json"))


def flatten(documents: DataFrame) -> DataFrame:
    """documents: ticker, json. One row an entry: ticker, cik, namespace, concept, unit and its fields."""
    rows = documents.select("ticker", F.from_json("json", SCHEMA).alias("d")).select("ticker", "d.cik", F.explode("d.facts").alias("namespace", "concepts"))
    rows = rows.select("ticker", "cik", "namespace", F.explode("concepts").alias("concept", "body"))
    rows = rows.select("ticker", "cik", "namespace", "concept", F.explode("body.units").alias("unit", "entries"))
    return rows.select("ticker", "cik", "namespace", "concept", "unit", F.inline("entries"))


def synonyms(spark: SparkSession) -> DataFrame:
    rows = [
        F.struct(F.lit(i).alias("line_item"), F.lit(c).alias("concept"), F.lit(k).alias("synonym_rank"), F.lit(NAMESPACES.get(i, DEFAULT_NAMESPACE)).alias("namespace"), F.lit(UNITS.get(i, DEFAULT_UNIT)).alias("unit"))
        for i, own in SYNONYMS.items()
        for k, c in enumerate(own)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def valid(entries: DataFrame, min_fiscal_year: int = 1990) -> DataFrame:
    """Entries with a known fiscal period, a year in the window, an end, an accession and a value."""
    return entries.where(
        F.col("fp").isin(*FISCAL_PERIODS) & (F.col("fy") >= min_fiscal_year) & (F.coalesce("end", F.lit("")) != "") & (F.coalesce("accn", F.lit("")) != "") & F.col("val").isNotNull()
    )


def candidates(documents: DataFrame, min_fiscal_year: int = 1990) -> DataFrame:
    """Valid entries of every known concept, as facts with synonym_rank."""
    entries = valid(flatten(documents), min_fiscal_year)
    known = F.broadcast(synonyms(documents.sparkSession))  # a fixed list of some fifty rows
    rows = entries.join(known, ["namespace", "concept", "unit"])
    ticker = F.upper(F.trim("ticker"))
    return rows.select(
        ticker.alias("ticker"), "line_item", F.col("concept").alias("concept_used"), F.col("end").alias("period_end"), F.when(F.col("fp") == "FY", "FY").otherwise("Q").alias("period_type"),
        F.col("fy").alias("fiscal_year"), F.col("fp").alias("fiscal_period"), F.col("val").alias("value"), "unit", F.col("accn").alias("accession_no"),
        fact_id(ticker, "concept", "end", "fp", "accn").alias("fact_id"), filing_url(F.col("cik"), F.col("accn")).alias("filing_url"),
        F.coalesce("form", F.lit("")).alias("form_type"), F.coalesce("filed", F.lit("")).alias("filed_date"), F.coalesce("frame", F.lit("")).alias("frame"), "synonym_rank",
    )


def ingest(documents: DataFrame, years: int = 5, min_fiscal_year: int = 1990) -> DataFrame:
    """Facts of the best concept of each item, of the last fiscal years. Raises nothing on an empty
    document: a ticker without facts has no rows."""
    rows = candidates(documents, min_fiscal_year)
    best = choose_concepts(rows).where("choice = 1").select("ticker", "line_item", "concept_used")
    return last_years(rows.join(best, ["ticker", "line_item", "concept_used"], "left_semi"), years).select(*FACT_COLUMNS)
