"""Actuals of the latest quarter against the year before and against forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import growth, safe_ratio
from .dedupe import top

def newest() -> list:
    return [F.desc("fiscal_year"), F.desc("fiscal_period"), F.desc("period_end")]


def forecast_medians(forecasts: DataFrame) -> DataFrame:
    """Median and models of all forecasts of a ticker's date."""
    return forecasts.groupBy("ticker", F.col("period_end").cast("string").alias("latest_period_end")).agg(
        F.median("yhat").alias("revenue_prior_forecast"), F.array_join(F.array_sort(F.collect_set("model")), "|").alias("revenue_prior_forecast_model")
    )


def variance_facts(income: DataFrame, balance: DataFrame, cash: DataFrame, forecasts: DataFrame) -> DataFrame:
    """One row a ticker. Without forecasts of the latest date the forecast columns are null."""
    quarters = income.where(F.col("period_type") == "Q")
    flows = top(cash.where(F.col("period_type") == "Q"), ["ticker", "period_end"], newest()).select("ticker", "period_end", "FreeCashFlow")
    dates = balance.where(F.col("DeferredRevenue").isNotNull()).groupBy("ticker", "period_end").agg(F.max("DeferredRevenue").alias("dr"))
    steps = dates.withColumn("dr_before", F.lag("dr").over(Window.partitionBy("ticker").orderBy("period_end")))
    rows = quarters.join(flows, ["ticker", "period_end"], "left").join(steps, ["ticker", "period_end"], "left").select(
        "ticker", "period_end", "fiscal_year", "fiscal_period", F.col("Revenue").alias("rev"), safe_ratio("GrossProfit", "Revenue").alias("gm"),
        safe_ratio("OperatingIncome", "Revenue").alias("om"), F.col("FreeCashFlow").alias("fcf"), (F.col("Revenue") + F.col("dr") - F.col("dr_before")).alias("bill"),
        "revenue_fact_id", "revenue_accession", "revenue_filing_url", "gross_profit_fact_id", "operating_income_fact_id",
    )
    now = top(rows.where(F.col("rev").isNotNull()), ["ticker"], newest()).withColumnRenamed("period_end", "latest_period_end")
    before = top(rows, ["ticker", "fiscal_year", "fiscal_period"], [F.desc("period_end")])
    before = before.select("ticker", (F.col("fiscal_year") + 1).alias("fiscal_year"), "fiscal_period", *(F.col(c).alias(f"{c}_yoy") for c in ("rev", "gm", "om", "fcf", "bill")))
    out = now.join(before, ["ticker", "fiscal_year", "fiscal_period"], "left").join(forecast_medians(forecasts), ["ticker", "latest_period_end"], "left")
    plan = F.col("revenue_prior_forecast")
    return out.select(
        "ticker", "latest_period_end", "fiscal_year", "fiscal_period", F.col("rev").alias("revenue_actual"), "revenue_prior_forecast", F.col("rev_yoy").alias("revenue_yoy"),
        (F.col("rev") - plan).alias("revenue_variance_vs_forecast"), growth("rev", "revenue_prior_forecast").alias("revenue_variance_pct_vs_forecast"),
        growth("rev", "rev_yoy").alias("revenue_yoy_growth_pct"),
        F.col("gm").alias("gross_margin_pct_actual"), F.col("gm_yoy").alias("gross_margin_pct_yoy"), (F.col("gm") - F.col("gm_yoy")).alias("gross_margin_pct_yoy_delta"),
        F.col("om").alias("operating_margin_pct_actual"), F.col("om_yoy").alias("operating_margin_pct_yoy"), (F.col("om") - F.col("om_yoy")).alias("operating_margin_pct_yoy_delta"),
        F.col("fcf").alias("fcf_actual"), F.col("fcf_yoy"), (F.col("fcf") - F.col("fcf_yoy")).alias("fcf_yoy_delta"), growth("fcf", "fcf_yoy", signed=True).alias("fcf_yoy_growth_pct"),
        F.col("bill").alias("billings_actual"), F.col("bill_yoy").alias("billings_yoy"), growth("bill", "bill_yoy", signed=True).alias("billings_yoy_growth_pct"),
        F.col("revenue_fact_id").alias("revenue_actual_fact_id"), F.col("revenue_accession").alias("revenue_actual_accession"), F.col("revenue_filing_url").alias("revenue_actual_filing_url"),
        "revenue_prior_forecast_model", "gross_profit_fact_id", F.col("operating_income_fact_id").alias("op_income_fact_id"),
    )


def classify_driver(rows: DataFrame) -> DataFrame:
    """rows: rev, rev_prior, margin_delta, margin_prior, one_time_items (array of struct with amount
    and one_time). Adds volume, margin and driver: one-time, mix, volume or margin."""
    d = F.col("rev") - F.col("rev_prior")
    volume, margin = F.abs(d * F.col("margin_prior")), F.abs(F.col("margin_delta") * F.col("rev"))
    large = F.exists(F.coalesce("one_time_items", F.array()), lambda x: F.coalesce(x["one_time"], F.lit(False)) & (F.abs(x["amount"]) > 0.3 * F.greatest(F.abs(d), F.lit(1.0))))
    ratio = F.greatest(volume, margin) / F.nullif(F.least(volume, margin), F.lit(0.0))
    driver = F.when(large, "one-time").when((volume > 0) & (margin > 0) & (ratio < 2), "mix").when(volume >= margin, "volume").otherwise("margin")
    return rows.withColumns({"volume_effect": volume, "margin_effect": margin, "driver": driver})
