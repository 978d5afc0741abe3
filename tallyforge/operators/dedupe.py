"""Top-1-per-group operators. Orders end in total tie-breaks, so results do not depend on layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vocab import BALANCE_SHEET, FORM_PRIORITY


def form_priority(form: str = "form_type") -> Column:
    """10-K/A over 10-Q/A over 10-K over 10-Q over others."""
    out = F.lit(0)
    for name, rank in FORM_PRIORITY.items():
        out = F.when(F.col(form) == name, rank).otherwise(out)
    return out


def top(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each group; Catalyst limits groups before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank_", F.row_number().over(window)).where(F.col("rank_") <= n).drop("rank_")


def latest() -> list[Column]:
    return [F.desc("filed_date"), F.desc("accession_no"), F.desc("fact_id")]


def canonical(facts: DataFrame) -> DataFrame:
    """One fact for each item, period and frame: the best form, then the latest filing."""
    return top(facts, ["ticker", "line_item", "period_end", "period_type", "frame"], [form_priority().desc(), *latest()])


def collapsed(facts: DataFrame) -> DataFrame:
    """One fact for each item and date out of canonical ones, quarters and year-end balances only;
    quarter-framed and then smaller values win among equals."""
    rows = facts.where((F.col("period_type") == "Q") | ((F.col("period_type") == "FY") & F.col("line_item").isin(*BALANCE_SHEET)))
    framed = F.when(F.col("frame").like("CY%Q%"), 0).otherwise(1)
    return top(rows, ["ticker", "line_item", "period_end"], [form_priority().desc(), F.desc("filed_date"), framed.asc(), F.abs("value").asc(), F.desc("accession_no"), F.desc("fact_id")])


def last_years(facts: DataFrame, years: int) -> DataFrame:
    """Facts of the last fiscal years of each ticker."""
    latest = facts.groupBy("ticker").agg(F.max("fiscal_year").alias("latest_"))
    return facts.join(latest, "ticker").where(F.col("fiscal_year") >= F.col("latest_") - years + 1).drop("latest_")


def choose_concepts(entries: DataFrame) -> DataFrame:
    """entries: ticker, line_item, concept_used, synonym_rank, fiscal_period and more. Adds n_facts
    and choice (1 is best): most quarterly facts, then the order of synonyms."""
    counts = entries.groupBy("ticker", "line_item", "concept_used", "synonym_rank").agg(F.count_if(F.col("fiscal_period") != "FY").alias("n_facts"))
    window = Window.partitionBy("ticker", "line_item").orderBy(F.desc("n_facts"), F.asc("synonym_rank"))
    return counts.where("n_facts > 0").withColumn("choice", F.row_number().over(window))


def switched_concepts(choices: DataFrame, more_than: int = 2) -> DataFrame:
    """Concepts that were not chosen though they hold several facts."""
    return choices.where((F.col("choice") > 1) & (F.col("n_facts") > more_than))
