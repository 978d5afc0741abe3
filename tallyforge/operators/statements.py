"""Wide statements, key metrics and the cash-flow bridge."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import growth, safe_ratio
from ..functions.vocab import BALANCE, CASH_FLOW, INCOME

PERIOD = ["ticker", "period_end", "fiscal_year", "fiscal_period", "period_type"]
SOURCES = {"fact_id": "fact_id", "accession": "accession_no", "filing_url": "filing_url"}


def wide(facts: DataFrame, items: dict[str, str], aligned: bool = False) -> DataFrame:
    """One row a period, four columns an item: value, fact id, accession and URL.

    By default each is the greatest among the period's facts of the item, so they may come from
    different facts; `aligned` takes all four from the fact of the greatest value."""
    made = []
    for item, prefix in items.items():
        own = F.col("line_item") == item
        made.append(F.max(F.when(own, F.col("value"))).alias(item))
        for suffix, c in SOURCES.items():
            pick = F.max_by(F.col(c), F.when(own, F.struct("value", "fact_id"))) if aligned else F.max(F.when(own, F.col(c)))
            made.append(pick.alias(f"{prefix}_{suffix}"))
    return facts.where(F.col("line_item").isin(*items)).groupBy(*PERIOD).agg(*made) if aligned else facts.groupBy(*PERIOD).agg(*made)


def income_statement(facts: DataFrame, aligned: bool = False) -> DataFrame:
    return wide(facts, INCOME, aligned)


def balance_sheet(facts: DataFrame, aligned: bool = False) -> DataFrame:
    return wide(facts, BALANCE, aligned)


def cash_flow(facts: DataFrame, aligned: bool = False) -> DataFrame:
    return wide(facts, CASH_FLOW, aligned).withColumn("FreeCashFlow", F.col("OperatingCashFlow") - F.col("CapEx"))


def key_metrics(income: DataFrame, cash: DataFrame, calendar_safe: bool = False) -> DataFrame:
    """Margins and growth of quarters. Growth is against the row one or four before; calendar_safe
    takes it only where that row is one or four fiscal quarters before."""
    keys = ["ticker", "period_end", "fiscal_year", "fiscal_period"]
    flows = cash.select(*keys, "OperatingCashFlow", "CapEx", "FreeCashFlow", F.col("period_type").alias("cash_type_"))
    rows = income.where(F.col("period_type") == "Q").join(flows.where(F.col("cash_type_") == "Q").drop("cash_type_"), keys, "left")
    window = Window.partitionBy("ticker").orderBy("fiscal_year", "fiscal_period", "period_end")
    index = F.col("fiscal_year") * 4 + F.substring("fiscal_period", 2, 1).cast("int")

    def base(n: int):
        value = F.lag("Revenue", n).over(window)
        return F.when(index - F.lag(index, n).over(window) == n, value) if calendar_safe else value

    return rows.select(
        "ticker", "period_end", "period_type", "fiscal_year", "fiscal_period", "Revenue", "GrossProfit", "OperatingIncome", "NetIncome",
        "OperatingCashFlow", "CapEx", "FreeCashFlow",
        safe_ratio("GrossProfit", "Revenue").alias("gross_margin_pct"), safe_ratio("OperatingIncome", "Revenue").alias("operating_margin_pct"),
        safe_ratio("NetIncome", "Revenue").alias("net_margin_pct"), safe_ratio("FreeCashFlow", "Revenue").alias("fcf_margin_pct"),
        growth("Revenue", base(1)).alias("revenue_qoq_growth"), growth("Revenue", base(4)).alias("revenue_yoy_growth"),
    )


def fcf_bridge(facts: DataFrame) -> DataFrame:
    """Seven rows from net income to free cash flow for each quarter with all five inputs."""
    inputs = {"NetIncome": "ni", "Depreciation": "dep", "StockBasedCompensation": "sbc", "OperatingCashFlow": "ocf", "CapEx": "capex"}
    keys = ["ticker", "period_end", "fiscal_year", "fiscal_period", "period_type"]
    made = []
    for item, p in inputs.items():
        own = F.col("line_item") == item
        made += [F.max(F.when(own, F.col(c))).alias(f"{p}_{s}") for s, c in (("v", "value"), ("a", "accession_no"), ("f", "fact_id"), ("u", "filing_url"))]
    rows = facts.where((F.col("period_type") == "Q") & F.col("line_item").isin(*inputs)).groupBy(*keys).agg(*made)
    rows = rows.where(" AND ".join(f"{p}_v IS NOT NULL" for p in inputs.values()))

    def bar(order: int, name: str, role: str, value: str, p: str | None):
        sources = [(F.col(f"{p}_{s}") if p else F.lit(None).cast("string")).alias(c) for s, c in (("a", "accession_no"), ("f", "fact_id"), ("u", "filing_url"))]
        return F.struct(F.lit(name).alias("component"), F.lit(order).alias("component_order"), F.lit(role).alias("component_role"), F.expr(value).alias("value"), *sources)

    bars = F.array(
        bar(1, "NetIncome", "start", "ni_v", "ni"),
        bar(2, "Depreciation", "add", "dep_v", "dep"),
        bar(3, "StockBasedCompensation", "add", "sbc_v", "sbc"),
        bar(4, "WorkingCapitalAndOther", "add", "ocf_v - ni_v - dep_v - sbc_v", None),
        bar(5, "OperatingCashFlow", "subtotal", "ocf_v", "ocf"),
        bar(6, "CapEx", "subtract", "-capex_v", "capex"),
        bar(7, "FreeCashFlow", "end", "ocf_v - capex_v", "ocf"),
    )
    return rows.select(*keys, F.inline(bars))


def waterfall(bridge: DataFrame) -> DataFrame:
    """Running totals and the floating bars of a waterfall chart."""
    window = Window.partitionBy("ticker", "period_end").orderBy("component_order").rowsBetween(Window.unboundedPreceding, 0)
    moving = F.col("component_role").isin("start", "add")
    rows = bridge.withColumn("running_total", F.sum(F.when(moving, F.col("value")).otherwise(0.0)).over(window))
    role = F.col("component_role")
    start = (
        F.when(role.isin("start", "subtotal", "end"), 0.0)
        .when(role == "add", F.col("running_total") - F.col("value"))
        .otherwise(F.col("running_total") + F.col("value"))
    )
    return rows.withColumn("bar_start", start).withColumn("bar_size", F.when(role == "subtract", -F.col("value")).otherwise(F.col("value")))


def historical_wide(facts: DataFrame, n: int = 12) -> DataFrame:
    """Latest n periods with four income items and the provenance of revenue."""
    items = ["Revenue", "GrossProfit", "OperatingIncome", "NetIncome"]
    keys = ["ticker", "period_end", "fiscal_year", "fiscal_period", "period_type"]
    rows = facts.where(F.col("line_item").isin(*items))
    pivot = rows.groupBy(*keys).agg(*(F.min_by("value", F.when(F.col("line_item") == i, F.col("fact_id"))).alias(i) for i in items))
    pick = Window.partitionBy("ticker", "period_end").orderBy("fact_id")
    revenue = rows.where(F.col("line_item") == "Revenue").withColumn("k_", F.row_number().over(pick)).where("k_ = 1")
    revenue = revenue.select(
        "ticker", "period_end", F.col("fact_id").alias("revenue_fact_id"), "accession_no", "filing_url",
        F.when(F.lower(F.coalesce("concept_used", F.lit(""))).contains("derived"), "derived").otherwise("reported").alias("revenue_provenance"),
    )
    latest = Window.partitionBy("ticker").orderBy(F.desc("period_end"), F.desc("fiscal_year"), F.desc("fiscal_period"))
    return pivot.join(revenue, ["ticker", "period_end"], "left").withColumn("k_", F.row_number().over(latest)).where(F.col("k_") <= n).drop("k_")


def sources(income: DataFrame, balance: DataFrame, cash: DataFrame) -> DataFrame:
    """Value and provenance of six headline items, one row each, of quarters."""

    def rows(df: DataFrame, items: dict[str, str]) -> DataFrame:
        own = [F.struct(F.lit(i).alias("line_item"), F.col(i).alias("value"), F.col(f"{p}_accession").alias("accession_no"), F.col(f"{p}_filing_url").alias("filing_url")) for i, p in items.items()]
        return df.where(F.col("period_type") == "Q").select("ticker", "period_end", "fiscal_year", "fiscal_period", F.inline(F.array(*own))).where("value IS NOT NULL")

    parts = [rows(income, {k: INCOME[k] for k in ("Revenue", "OperatingIncome", "NetIncome")}), rows(balance, {k: BALANCE[k] for k in ("Cash", "AccountsReceivable")}), rows(cash, {"OperatingCashFlow": "ocf"})]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def latest_provenance(income: DataFrame, n: int = 5) -> DataFrame:
    """The n latest quarters of revenue of each ticker, with their sources."""
    rows = income.where("period_type = 'Q' AND Revenue IS NOT NULL")
    window = Window.partitionBy("ticker").orderBy(F.desc("fiscal_year"), F.desc("fiscal_period"), F.desc("period_end"))
    rows = rows.withColumn("k_", F.row_number().over(window)).where(F.col("k_") <= n)
    return rows.select("ticker", "period_end", "fiscal_year", "fiscal_period", F.round(F.col("Revenue") / 1e9, 3).alias("revenue_billions"), "revenue_accession", "revenue_filing_url")


def latest_quarters(df: DataFrame, n: int = 12, complete: tuple[str, ...] = ()) -> DataFrame:
    """The latest n quarters of each ticker, oldest first in `slot`; complete: columns that must be there."""
    rows = df.where(F.col("period_type") == "Q")
    for c in complete:
        rows = rows.where(F.col(c).isNotNull())
    order = Window.partitionBy("ticker").orderBy(F.desc("fiscal_year"), F.desc("fiscal_period"), F.desc("period_end"))
    rows = rows.withColumn("back_", F.row_number().over(order)).where(F.col("back_") <= n)
    slot = Window.partitionBy("ticker").orderBy(F.desc("back_"))
    return rows.withColumn("slot", F.row_number().over(slot)).drop("back_")
