"""Dashboard measures over quarterly facts: trailing sums, days of sales, billings, scorecards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import growth, safe_ratio

def by():
    return Window.partitionBy("ticker").orderBy("period_end")


def quarterly(facts: DataFrame, items: tuple[str, ...]) -> DataFrame:
    """One row a ticker's date, a column an item: the sum of its quarterly facts."""
    rows = facts.where((F.col("period_type") == "Q") & F.col("line_item").isin(*items))
    amount = F.col("value").cast("decimal(28,4)")
    return rows.groupBy("ticker", "period_end").agg(*(F.sum(F.when(F.col("line_item") == i, amount)).cast("double").alias(i) for i in items))


def trailing(column: str, n: int = 4) -> F.Column:
    """Sum of the last n rows, or null where there are fewer."""
    window = by().rowsBetween(-(n - 1), 0)
    return F.when(F.count("*").over(window) == n, F.sum(F.col(column).cast("decimal(28,4)")).over(window).cast("double"))


def ttm_kpis(facts: DataFrame) -> DataFrame:
    rows = quarterly(facts, ("Revenue", "OperatingIncome", "OperatingCashFlow", "CapEx"))
    rows = rows.withColumns({f"ttm_{n}": trailing(c) for n, c in (("revenue", "Revenue"), ("operating_income", "OperatingIncome"), ("ocf", "OperatingCashFlow"), ("capex", "CapEx"))})
    return rows.withColumns({
        "ttm_fcf": F.col("ttm_ocf") - F.col("ttm_capex"), "ttm_operating_margin": safe_ratio("ttm_operating_income", "ttm_revenue"),
        "ttm_fcf_margin": safe_ratio(F.col("ttm_ocf") - F.col("ttm_capex"), "ttm_revenue"),
    })


def dso(facts: DataFrame, days: float = 91, over: int = 8) -> DataFrame:
    """Days of sales outstanding and its rolling mean."""
    rows = quarterly(facts, ("Revenue", "AccountsReceivable")).withColumn("dso", safe_ratio("AccountsReceivable", "Revenue") * days)
    return rows.withColumn("dso_rolling", F.avg("dso").over(by().rowsBetween(-(over - 1), 0)))


def billings(facts: DataFrame) -> DataFrame:
    rows = quarterly(facts, ("Revenue", "DeferredRevenue", "RPO"))
    rows = rows.withColumn("deferred_change", F.col("DeferredRevenue") - F.lag("DeferredRevenue").over(by()))
    rows = rows.withColumn("billings", F.col("Revenue") + F.col("deferred_change"))
    return rows.withColumn("cover_ratio", safe_ratio("DeferredRevenue", "Revenue")).drop("RPO")


def rule_of_40(facts: DataFrame, bar: float = 0.4) -> DataFrame:
    """Yearly growth plus free-cash-flow margin, both of trailing years."""
    rows = ttm_kpis(facts)
    rows = rows.withColumn("growth", growth("ttm_revenue", F.lag("ttm_revenue", 4).over(by())))
    rows = rows.withColumn("score", F.col("growth") + F.col("ttm_fcf_margin"))
    quadrant = F.concat(F.when(F.col("growth") >= 0.2, "fast").otherwise("slow"), F.lit("-"), F.when(F.col("ttm_fcf_margin") >= 0.2, "profitable").otherwise("investing"))
    return rows.where(F.col("score").isNotNull()).select("ticker", "period_end", "growth", F.col("ttm_fcf_margin").alias("fcf_margin"), "score", (F.col("score") >= bar).alias("passes"), quadrant.alias("quadrant"))


def margins(facts: DataFrame) -> DataFrame:
    rows = quarterly(facts, ("Revenue", "GrossProfit", "OperatingIncome", "NetIncome"))
    return rows.select("ticker", "period_end", "Revenue", *(safe_ratio(c, "Revenue").alias(n) for c, n in (("GrossProfit", "gross_margin"), ("OperatingIncome", "operating_margin"), ("NetIncome", "net_margin"))), growth("Revenue", F.lag("Revenue", 4).over(by())).alias("yoy_growth"))


def scorecard(facts: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Each forecast against its actual: variance, size of it, and a band."""
    actual = quarterly(facts, ("Revenue",))
    rows = forecasts.join(actual, ["ticker", "period_end"])
    off = growth("Revenue", "yhat")
    size = F.abs(off)
    band = F.when(size < 0.05, "<5%").when(size <= 0.1, "5-10%").when(size > 0.1, ">10%")
    return rows.select("ticker", "model", "period_end", "forecast_run_date", "Revenue", "yhat", (F.col("Revenue") - F.col("yhat")).alias("variance"), off.alias("variance_pct"), band.alias("band"))


def model_errors(scored: DataFrame) -> DataFrame:
    """Mean absolute error, and in per cent of positive actuals, of each model."""
    error = F.abs("variance")
    return scored.groupBy("model").agg(F.avg(error).alias("mae"), F.avg(error / F.when(F.col("Revenue") > 0, F.col("Revenue"))).alias("mape"), F.count("*").alias("n"))


def forecast_overlay(facts: DataFrame, forecasts: DataFrame, ahead: int = 4) -> DataFrame:
    """Actual revenue and, per model, the first `ahead` forecast dates after the last actual."""
    actual = quarterly(facts, ("Revenue",)).where("Revenue IS NOT NULL").select("ticker", "period_end", F.lit("actual").alias("series"), F.col("Revenue").alias("value"))
    last = actual.groupBy("ticker").agg(F.max("period_end").alias("last_"))
    later = forecasts.join(last, "ticker").where(F.col("period_end") > F.col("last_"))
    window = Window.partitionBy("ticker", "model").orderBy("period_end")
    later = later.withColumn("k_", F.dense_rank().over(window)).where(F.col("k_") <= ahead)
    return actual.unionByName(later.select("ticker", "period_end", F.col("model").alias("series"), F.col("yhat").alias("value")))
