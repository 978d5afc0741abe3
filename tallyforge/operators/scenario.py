"""Three-scenario projection of the statements by a fold over quarters, and its checks."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clamp, period_label
from .statements import latest_quarters

HORIZON = 4
BALANCE_TOLERANCE, RESIDUAL_TOLERANCE = 1e6, 5e6

# How Bull and Bear change the base.
SCENARIOS = {
    "Base": {"growth": 1.0, "margin": 1.0, "opex": 1.0, "dso": 1.0},
    "Bull": {"growth": 1.5, "margin": 1.02, "opex": 0.8, "dso": 0.95},
    "Bear": {"growth": 0.4, "margin": 0.98, "opex": 1.3, "dso": 1.1},
}


def history(income: DataFrame, balance: DataFrame, cash: DataFrame, n: int = 12) -> DataFrame:
    """One row a ticker and quarter of the latest n; statements are joined by their period."""
    key = ["ticker", "period_end", "fiscal_year", "fiscal_period"]

    def cut(df: DataFrame, columns: list[str]) -> DataFrame:
        return df.where(F.col("period_type") == "Q").select(*key, *columns)

    rows = cut(income, ["Revenue", "CostOfRevenue", "GrossProfit", "OperatingExpenses", "OperatingIncome", "NetIncome"])
    held = balance.where("TotalAssets IS NOT NULL AND TotalLiabilities IS NOT NULL AND TotalEquity IS NOT NULL")
    rows = rows.join(cut(held, ["Cash", "AccountsReceivable", "Inventory", "AccountsPayable", "DeferredRevenue", "TotalAssets", "TotalLiabilities", "TotalEquity"]), key)
    rows = rows.join(cut(cash, ["OperatingCashFlow", "InvestingCashFlow", "FinancingCashFlow", "Depreciation", "StockBasedCompensation", "TreasuryStockRepurchases", "CapEx"]), key)
    return latest_quarters(rows.withColumn("period_type", F.lit("Q")), n).drop("period_type")


def assumptions(rows: DataFrame) -> DataFrame:
    """Base parameters and opening state of each ticker from its history."""
    by = Window.partitionBy("ticker").orderBy("slot")
    last = Window.partitionBy("ticker")

    def z(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0.0))

    rows = rows.withColumn("n_", F.max("slot").over(last)).withColumn("back_", F.col("n_") - F.col("slot"))
    for c in ("Revenue", "OperatingExpenses"):
        before = F.lag(z(c)).over(by)
        rows = rows.withColumn(f"q_{c}", F.when((F.col("back_") < 4) & (F.col("n_") >= 5) & (before > 0), z(c) / F.nullif(before, F.lit(0.0)) - 1))
    recent = F.col("back_") < 4
    newest = {c: F.max(F.when(F.col("back_") == 0, z(c))).alias(f"l_{c}") for c in rows.columns if c[0].isupper()}
    out = rows.groupBy("ticker").agg(
        F.max("n_").alias("n"), F.avg("q_Revenue").alias("g"), F.avg("q_OperatingExpenses").alias("og"), F.max(F.when((F.col("back_") == 4), z("Revenue"))).alias("rev5"),
        F.avg(F.when(recent, z("CapEx"))).alias("capex4"), F.avg(F.when(recent, z("Revenue"))).alias("rev4"), F.max(z("Inventory") != 0).alias("has_inventory"), *newest.values(),
    )
    rev, cogs, inv = F.col("l_Revenue"), F.col("l_CostOfRevenue"), F.when(F.col("has_inventory"), F.col("l_Inventory")).otherwise(0.0)
    growth = F.when((F.col("n") >= 5) & (F.col("rev5") > 0), F.coalesce("g", F.lit(0.04))).otherwise(0.04)
    capex4 = F.when(F.col("n") >= 4, F.col("capex4")).otherwise(0.0)
    rev4 = F.when(F.col("n") >= 4, F.col("rev4")).otherwise(F.greatest(rev, F.lit(1.0)))

    def over(a: Column, b: Column, days: float, fallback: float) -> Column:
        return F.when(b > 0, a / F.nullif(b, F.lit(0.0)) * days).otherwise(fallback)

    return out.select(
        "ticker", "has_inventory",
        clamp(growth, -0.2, 0.5).alias("revenue_growth_qoq"), clamp(over(F.col("l_GrossProfit"), rev, 1.0, 0.68), 0.3, 0.99).alias("gross_margin_pct"),
        clamp(F.coalesce("og", F.lit(0.02)), -0.2, 0.5).alias("opex_growth_qoq"), clamp(over(capex4, rev4, 1.0, 0.02), 0.001, 0.2).alias("capex_pct_of_revenue"),
        clamp(over(F.col("l_AccountsReceivable"), rev, 90.0, 60.0), 1.0, 180.0).alias("dso_days"), clamp(over(F.col("l_AccountsPayable"), cogs, 90.0, 45.0), 1.0, 180.0).alias("dpo_days"),
        clamp(F.when(F.col("has_inventory"), over(inv, cogs, 90.0, 0.0)).otherwise(0.0), 0.0, 180.0).alias("dio_days"),
        F.lit(0.15).alias("tax_rate"), F.lit(0.0).alias("debt_amortization_qoq"), F.col("l_StockBasedCompensation").alias("sbc_qtrly"),
        F.col("l_TreasuryStockRepurchases").alias("buybacks_qtrly"), F.col("l_OperatingExpenses").alias("opex_trailing"), rev.alias("revenue_last"), F.col("l_Depreciation").alias("depreciation"),
        F.col("l_Cash").alias("cash"), F.col("l_AccountsReceivable").alias("ar"), inv.alias("inventory"), F.col("l_AccountsPayable").alias("ap"), F.col("l_DeferredRevenue").alias("deferred"),
        F.col("l_TotalAssets").alias("total_assets"), F.col("l_TotalLiabilities").alias("total_liabilities"), F.col("l_TotalEquity").alias("equity"),
    )


def scenarios(base: DataFrame) -> DataFrame:
    """Three rows a ticker."""
    made = []
    for name, m in SCENARIOS.items():
        margin = F.col("gross_margin_pct") * m["margin"]
        made.append(F.struct(
            F.lit(name).alias("scenario"), (F.col("revenue_growth_qoq") * m["growth"]).alias("g"), (F.least(F.lit(0.99), margin) if name == "Bull" else margin).alias("gm"),
            (F.col("opex_growth_qoq") * m["opex"]).alias("og"), (F.col("dso_days") * m["dso"]).alias("dso"),
        ))
    rows = base.withColumn("s_", F.explode(F.array(*made)))
    return rows.withColumns({
        "scenario": F.col("s_.scenario"), "revenue_growth_qoq": F.col("s_.g"), "gross_margin_pct": F.col("s_.gm"), "opex_growth_qoq": F.col("s_.og"), "dso_days": F.col("s_.dso"),
    }).drop("s_")


#: What a projected quarter holds, in the order of computation: later ones may use earlier ones, the
#: quarter before as p.x, and the parameters of the row.
STEPS = {
    "Revenue": "p.Revenue * (1 + revenue_growth_qoq)",
    "CostOfRevenue": "Revenue * (1 - gross_margin_pct)",
    "GrossProfit": "Revenue - CostOfRevenue",
    "OperatingExpenses": "p.OperatingExpenses * (1 + opex_growth_qoq)",
    "OperatingIncome": "GrossProfit - OperatingExpenses",
    "InterestExpense": "p.Debt * 0.0D",
    "PreTaxIncome": "OperatingIncome - InterestExpense",
    "Tax": "greatest(0.0D, PreTaxIncome) * tax_rate",
    "NetIncome": "PreTaxIncome - Tax",
    "CapEx": "Revenue * capex_pct_of_revenue",
    "SBC": "sbc_qtrly",
    "Buybacks": "buybacks_qtrly",
    "DebtAmort": "debt_amortization_qoq",
    "Depreciation": "depreciation",
    "AccountsReceivable": "Revenue * dso_days / 90",
    "Inventory": "if(has_inventory, CostOfRevenue * dio_days / 90, 0.0D)",
    "AccountsPayable": "CostOfRevenue * dpo_days / 90",
    "DeferredRevenue": "p.DeferredRevenue",
    "TotalEquity": "p.TotalEquity + NetIncome + SBC - Buybacks",
    "OCF": "NetIncome + Depreciation + SBC - (AccountsReceivable - p.AccountsReceivable) - (Inventory - p.Inventory) + (AccountsPayable - p.AccountsPayable)",
    "InvestingCF": "-CapEx",
    "FinancingCF": "-DebtAmort - Buybacks",
    "NetCashChange": "OCF + InvestingCF + FinancingCF",
    "BegCash": "p.Cash",
    "Cash": "p.Cash + NetCashChange",
    "EndCash": "Cash",
    "Debt": "greatest(0.0D, p.Debt - DebtAmort)",
    "OtherAssets": "p.OtherAssets + CapEx - Depreciation",
    "OtherLiabilities": "p.OtherLiabilities",
    "TotalAssets": "Cash + AccountsReceivable + Inventory + OtherAssets",
    "TotalLiabilities": "AccountsPayable + DeferredRevenue + Debt + OtherLiabilities",
    "BalanceCheck": "TotalAssets - TotalLiabilities - TotalEquity",
}
OPENING = {
    "Revenue": "revenue_last", "OperatingExpenses": "opex_trailing", "Debt": "0.0D", "DeferredRevenue": "deferred", "TotalEquity": "equity", "AccountsReceivable": "ar",
    "Inventory": "inventory", "AccountsPayable": "ap", "Cash": "cash", "OtherAssets": "total_assets - cash - ar - inventory", "OtherLiabilities": "total_liabilities - ap - deferred",
}


def project(rows: DataFrame, horizon: int | str = HORIZON) -> DataFrame:
    """One row a ticker, scenario and quarter: a fold over the quarters whose state is the quarter before, so
    neither the plan nor the code grows with the horizon, which may be a column of rows (0 or null: no quarter).

    Inside a quarter each level of values is bound once by a transform of a one-element array, and
    the next level reads it from there."""
    steps = f"sequence(1, {horizon})" if isinstance(horizon, int) else f"if({horizon} >= 1, sequence(1, cast({horizon} as int)), array())"
    empty = ", ".join(f"'{n}', cast({OPENING.get(n, 'null')} as double)" for n in STEPS)
    fold = f"""aggregate({steps},
      named_struct('p', named_struct({empty}), 'made', cast(array() as array<struct<step: int, {", ".join(f"{n}: double" for n in STEPS)}>>)),
      (s, k) -> {_quarter()}, s -> s.made)"""
    return rows.select("ticker", "scenario", F.inline(F.expr(fold)))


_NAME = re.compile(r"(?<![\w.])([A-Z]\w*)")


def _levels() -> list[list[str]]:
    """Names by the length of their chain of own values, so that each level is one projection."""
    depth: dict[str, int] = {}
    for name, expression in STEPS.items():
        depth[name] = 1 + max((depth[x] for x in _NAME.findall(expression) if x in STEPS), default=-1)
    return [[n for n, d in depth.items() if d == k] for k in range(max(depth.values()) + 1)]


def _quarter() -> str:
    """The merge of the fold, SQL of s and k."""
    known: dict[str, str] = {}
    opened, closed = "", ""
    for level, names in enumerate(_levels()):
        made = {n: f"cast({_NAME.sub(lambda m: known.get(m[1], m[1]), STEPS[n]).replace('p.', 's.p.')} as double)" for n in names}
        fields = ", ".join(f"'{n}', {v}" for n, v in (known | made).items())
        opened += f"transform(array(named_struct({fields})), c{level} -> "
        closed += ")[0]"
        known = {n: f"c{level}.{n}" for n in known | made}
    own = ", ".join(f"'{n}', {known[n]}" for n in STEPS)
    return f"{opened}named_struct('p', named_struct({own}), 'made', concat(s.made, array(named_struct('step', k, {own})))){closed}"


def balance_checks(projected: DataFrame, tolerance: float = BALANCE_TOLERANCE) -> DataFrame:
    rows = projected.groupBy("ticker", "scenario").agg(F.max(F.abs("BalanceCheck")).alias("max_abs_check"))
    return rows.withColumn("balanced", F.col("max_abs_check") <= tolerance)


def assert_balanced(projected: DataFrame, tolerance: float = BALANCE_TOLERANCE) -> None:
    bad = balance_checks(projected, tolerance).where("NOT balanced").limit(5).collect()
    if bad:
        raise ValueError(f"projection does not balance: {bad}")


def ocf_residual(rows: DataFrame, tolerance: float = RESIDUAL_TOLERANCE) -> DataFrame:
    """Greatest gap between reported and modelled operating cash flow over the last four quarters."""
    by = Window.partitionBy("ticker").orderBy("slot")

    def z(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0.0))

    def step(c: str) -> Column:
        return z(c) - F.lag(z(c)).over(by)

    model = z("NetIncome") + z("Depreciation") + z("StockBasedCompensation") - step("AccountsReceivable") - step("Inventory") + step("AccountsPayable") + step("DeferredRevenue")
    gap = F.when(z("OperatingCashFlow") != 0, F.abs(model - z("OperatingCashFlow")))
    rows = rows.withColumn("gap_", gap).withColumn("n_", F.max("slot").over(Window.partitionBy("ticker")))
    out = rows.where((F.col("n_") - F.col("slot") < 4) & (F.col("slot") > 1)).groupBy("ticker").agg(F.coalesce(F.max("gap_"), F.lit(0.0)).alias("max_residual"))
    return out.withColumn("warn", F.col("max_residual") > tolerance)


def working_capital_deltas(hist: DataFrame, projected: DataFrame) -> DataFrame:
    """What changes of working capital add to cash, quarter by quarter: history and base projection in
    one line, the first quarter 0, nulls 0. More receivables or inventory take cash, more payables give it."""
    items = {"AccountsReceivable": False, "Inventory": False, "AccountsPayable": True}

    def long(df: DataFrame, slot: str, kind: str, turn: int) -> DataFrame:
        own = F.array(*(F.struct(F.lit(i).alias("item"), F.lit(s).alias("gives_"), F.coalesce(F.col(i).cast("double"), F.lit(0.0)).alias("value")) for i, s in items.items()))
        return df.select("ticker", F.col(slot).cast("int").alias("slot"), F.lit(kind).alias("kind"), F.lit(turn).alias("turn_"), F.inline(own))

    rows = long(hist, "slot", "historical", 0).unionByName(long(projected.where("scenario = 'Base'"), "step", "forecast", 1))
    before = F.lag("value").over(Window.partitionBy("ticker", "item").orderBy("turn_", "slot"))
    delta = F.when(F.col("gives_"), F.col("value") - before).otherwise(before - F.col("value"))
    return rows.select("ticker", "slot", "kind", "item", F.coalesce(delta, F.lit(0.0)).alias("delta"))


def debt_schedule(base: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Opening, amortisation and closing debt; opening debt is 0."""
    rows = base.select("ticker", "debt_amortization_qoq", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    return rows.select("ticker", "step", F.lit(0.0).alias("opening"), F.col("debt_amortization_qoq").alias("amortization"), F.greatest(F.lit(0.0), 0 - F.col("debt_amortization_qoq")).alias("closing"))


def statement_matrix(hist: DataFrame, projected: DataFrame, items: tuple[str, ...] = ("Revenue", "GrossProfit", "NetIncome", "Cash")) -> DataFrame:
    """Long table of historical and projected (base) values: ticker, item, slot, kind, value."""

    def long(df: DataFrame, slot: str, kind: str) -> DataFrame:
        own = F.array(*(F.struct(F.lit(i).alias("item"), F.col(i).cast("double").alias("value")) for i in items))
        return df.select("ticker", F.col(slot).cast("int").alias("slot"), F.lit(kind).alias("kind"), F.inline(own))

    return long(hist, "slot", "historical").unionByName(long(projected.where("scenario = 'Base'"), "step", "forecast"))


# Rows of the three statements, in their order.
STATEMENTS = {
    "Income_Statement": ("Revenue", "CostOfRevenue", "GrossProfit", "OperatingExpenses", "OperatingIncome", "NetIncome"),
    "Balance_Sheet": ("Cash", "AccountsReceivable", "Inventory", "TotalAssets", "AccountsPayable", "DeferredRevenue", "TotalLiabilities", "TotalEquity"),
    "Cash_Flow": ("NetIncome", "Depreciation", "StockBasedCompensation", "OperatingCashFlow", "CapEx", "InvestingCashFlow", "TreasuryStockRepurchases", "FinancingCashFlow"),
}
PROJECTED = {"OperatingCashFlow": "OCF", "InvestingCashFlow": "InvestingCF", "FinancingCashFlow": "FinancingCF", "StockBasedCompensation": "SBC", "TreasuryStockRepurchases": "Buybacks"}


def statement_tables(hist: DataFrame, projected: DataFrame) -> DataFrame:
    """The three statement matrices, long: ticker, statement, line (position), item, slot, kind, label, value; history first,
    then the base projection. Inventory shows for a ticker that has any. Margins, the balance check and
    free cash flow follow their statements; a missing value stays missing."""

    def long(df: DataFrame, slot: str, kind: str, label: Column, names: dict[str, str]) -> DataFrame:
        def v(item: str) -> Column:
            return F.col(names.get(item, item)).cast("double")

        more = {
            ("Income_Statement", "GrossMarginPct"): v("GrossProfit") / F.when(v("Revenue") > 0, v("Revenue")), ("Balance_Sheet", "BalanceCheck"): v("TotalAssets") - v("TotalLiabilities") - v("TotalEquity"),
            ("Cash_Flow", "FreeCashFlow"): v("OperatingCashFlow") - v("CapEx"),
        }
        cells = [(s, k, i, v(i)) for s, items in STATEMENTS.items() for k, i in enumerate(items, 1)]
        cells += [(s, len(STATEMENTS[s]) + 1, i, x) for (s, i), x in more.items()]
        own = F.array(*(F.struct(F.lit(s).alias("statement"), F.lit(k).alias("line"), F.lit(i).alias("item"), x.alias("value")) for s, k, i, x in cells))
        return df.select("ticker", F.col(slot).cast("int").alias("slot"), F.lit(kind).alias("kind"), label.alias("label"), F.inline(own))

    past = long(hist, "slot", "historical", period_label("fiscal_year", "fiscal_period"), {})
    ahead = long(projected.where("scenario = 'Base'"), "step", "forecast", F.concat(F.lit("Q"), F.col("step").cast("string"), F.lit("(F)")), PROJECTED)
    stocked = hist.groupBy("ticker").agg(F.bool_or(F.coalesce("Inventory", F.lit(0.0)) != 0).alias("stocked_"))
    rows = past.unionByName(ahead).join(stocked, "ticker", "left")
    return rows.where((F.col("item") != "Inventory") | F.coalesce("stocked_", F.lit(False))).drop("stocked_")


def kpis(hist: DataFrame, projected: DataFrame) -> DataFrame:
    """Margins and revenue of history and projection, long."""
    cols = ["ticker", "slot", "kind", "item", "value"]
    rows = statement_matrix(hist, projected, ("Revenue", "GrossProfit", "NetIncome")).groupBy("ticker", "slot", "kind")
    rows = rows.agg(*(F.max(F.when(F.col("item") == i, F.col("value"))).alias(i) for i in ("Revenue", "GrossProfit", "NetIncome")))
    own = F.array(
        F.struct(F.lit("Revenue").alias("item"), F.col("Revenue").alias("value")),
        F.struct(F.lit("GrossMarginPct").alias("item"), (F.col("GrossProfit") / F.nullif(F.col("Revenue"), F.lit(0.0))).alias("value")),
        F.struct(F.lit("NetIncome").alias("item"), F.col("NetIncome").alias("value")),
        F.struct(F.lit("NetMarginPct").alias("item"), (F.col("NetIncome") / F.nullif(F.col("Revenue"), F.lit(0.0))).alias("value")),
    )
    return rows.select("ticker", "slot", "kind", F.inline(own)).select(*cols)
