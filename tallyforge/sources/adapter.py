"""Facts in the model's schema from a line-item table, so that every operator has data to run on.

A deterministic mapping: suppliers become eight tickers with fiscal years ending in four different
months; ship dates become quarters; parts become line items; line numbers choose form and filing
date, and so make duplicates, amendments and year totals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fiscal
from ..functions.vocab import FACT_COLUMNS, Q4_DERIVABLE

TICKERS = 8
ITEMS = (
    "Revenue", "CostOfRevenue", "GrossProfit", "OperatingExpenses", "OperatingIncome", "NetIncome", "ResearchAndDevelopment", "Cash",
    "AccountsReceivable", "Inventory", "AccountsPayable", "DeferredRevenue", "TotalAssets", "TotalLiabilities", "TotalEquity", "OperatingCashFlow",
    "InvestingCashFlow", "FinancingCashFlow", "CapEx", "Depreciation", "StockBasedCompensation", "TreasuryStockRepurchases", "DilutedShares", "SharesOutstanding",
)
FORMS = ("10-Q", "10-K", "10-Q/A", "10-K/A")
URL = "https://filings.example/data/"


def fiscal_year_end(ticker_number) -> F.Column:
    return ((ticker_number % 4) * 3 + 3).cast("int")


def companies(spark: SparkSession) -> DataFrame:
    """ticker, cik_int, cik, fy_end_month."""
    k = F.col("id")
    return spark.range(TICKERS).select(
        F.concat(F.lit("S"), k.cast("string")).alias("ticker"), (k + 1).cast("int").alias("cik_int"),
        F.lpad((k + 1).cast("string"), 10, "0").alias("cik"), fiscal_year_end(k).alias("fy_end_month"),
    )


def fact_id(*parts) -> F.Column:
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16)


def filing_url(cik_int, accession) -> F.Column:
    return F.concat(F.lit(URL), cik_int.cast("string"), F.lit("/"), F.replace(accession, F.lit("-"), F.lit("")), F.lit("/"))


def facts(spark: SparkSession, sf_dir: str, kept: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """kept: what is done to the sums of quarters, from which facts of quarters and of years are both made."""
    item = F.element_at(F.array(*map(F.lit, ITEMS)), (F.col("l_partkey") % len(ITEMS) + 1).cast("int"))
    form = F.element_at(F.array(*map(F.lit, FORMS)), (F.col("l_linenumber") % len(FORMS) + 1).cast("int"))
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        (F.col("l_suppkey") % TICKERS).alias("k"), item.alias("line_item"), form.alias("form_type"), F.col("l_linenumber").alias("ln"),
        F.last_day(F.add_months(F.trunc(F.col("l_shipdate").cast("date"), "quarter"), 2)).alias("pe"),
        (F.floor(F.col("l_partkey") / len(ITEMS)) % 2 == 0).alias("framed"), F.col("l_extendedprice").cast("decimal(18,2)").alias("v"),
    )
    quarters = lines.groupBy("k", "line_item", "form_type", "ln", "pe", "framed").agg(F.sum("v").alias("v"))
    quarters = kept(quarters)
    fe = fiscal_year_end(F.col("k"))
    fy, fp = fiscal.fiscal_label("pe", fe)
    quarters = quarters.withColumn("fiscal_year", fy).withColumn("fiscal_period", fp)
    alt = F.when((F.col("fiscal_year") % 5 == 0) & (F.col("fiscal_period") == "Q2"), "Alt").otherwise("Concept")
    number = F.quarter("pe") * 1000 + F.col("ln")
    own = quarters.where(~((F.col("fiscal_period") == "Q4") & (F.col("fiscal_year") % 2 == 0) & F.col("line_item").isin(*Q4_DERIVABLE)))
    own = own.select(
        "k", "line_item", F.concat("line_item", alt).alias("concept_used"), "pe", F.lit("Q").alias("period_type"), "fiscal_year", "fiscal_period",
        F.col("v").cast("double").alias("value"), number.alias("number"), "form_type", F.date_add("pe", 30 + F.col("ln")).alias("filed"),
        F.when(F.col("framed"), F.concat(F.lit("CY"), F.year("pe").cast("string"), F.lit("Q"), F.quarter("pe").cast("string"))).otherwise("").alias("frame"),
    )
    years = quarters.groupBy("k", "line_item", "fiscal_year").agg(F.sum("v").cast("double").alias("v"))
    end = F.last_day(F.make_date("fiscal_year", fe, F.lit(1)))
    filings = F.array(F.struct(F.lit("10-K").alias("form_type"), F.lit(1.0).alias("scale"), F.lit(9001).alias("number"), F.lit(60).alias("late")))
    amended = F.struct(F.lit("10-K/A").alias("form_type"), F.lit(1.05).alias("scale"), F.lit(9002).alias("number"), F.lit(120).alias("late"))
    filings = F.when((F.col("k") + F.col("fiscal_year")) % 3 == 0, F.concat(filings, F.array(amended))).otherwise(filings)
    years = years.withColumn("pe", end).withColumn("f", F.explode(filings)).select(
        "k", "line_item", F.concat("line_item", F.lit("Concept")).alias("concept_used"), "pe", F.lit("FY").alias("period_type"), "fiscal_year", F.lit("FY").alias("fiscal_period"),
        (F.col("v") * F.col("f.scale")).alias("value"), F.col("f.number").alias("number"), F.col("f.form_type").alias("form_type"),
        F.expr("date_add(pe, f.late)").alias("filed"), F.concat(F.lit("CY"), F.col("fiscal_year").cast("string")).alias("frame"),
    )
    both = own.unionByName(years)
    both = both.withColumn("ticker", F.concat(F.lit("S"), F.col("k").cast("string"))).withColumn("period_end", F.col("pe").cast("string"))
    serial = F.concat(F.lpad((F.col("k") + 1).cast("string"), 10, "0"), F.lit("-"), F.substring("period_end", 3, 2), F.lit("-"), F.lpad(F.col("number").cast("string"), 6, "0"))
    both = both.withColumn("accession_no", serial)
    return both.select(
        "ticker", "line_item", "concept_used", "period_end", "period_type", "fiscal_year", "fiscal_period", "value",
        F.when(F.col("line_item").isin("DilutedShares", "SharesOutstanding"), "shares").otherwise("USD").alias("unit"), "accession_no",
        fact_id("ticker", "concept_used", "period_end", "fiscal_period", "accession_no").alias("fact_id"),
        filing_url(F.col("k") + 1, F.col("accession_no")).alias("filing_url"), "form_type", F.col("filed").cast("string").alias("filed_date"), "frame",
    ).select(*FACT_COLUMNS)
