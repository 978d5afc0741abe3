"""Vocabularies of the fact model. All of these are fixed values."""

from __future__ import annotations

# Line items and their source concepts, best first.
SYNONYMS = {
    "Revenue": ["RevenueFromContractWithCustomerExcludingAssessedTax", "RevenueFromContractWithCustomerIncludingAssessedTax", "Revenues", "SalesRevenueNet"],
    "CostOfRevenue": ["CostOfGoodsAndServicesSold", "CostOfRevenue", "CostOfServices", "CostOfGoodsSold"],
    "GrossProfit": ["GrossProfit"],
    "OperatingExpenses": ["OperatingExpenses"],
    "ResearchAndDevelopment": ["ResearchAndDevelopmentExpense"],
    "SellingGeneralAdmin": ["SellingGeneralAndAdministrativeExpense"],
    "OperatingIncome": ["OperatingIncomeLoss"],
    "NetIncome": ["NetIncomeLoss", "ProfitLoss"],
    "Cash": ["CashAndCashEquivalentsAtCarryingValue", "CashAndCashEquivalents"],
    "AccountsReceivable": ["AccountsReceivableNetCurrent"],
    "Inventory": ["InventoryNet"],
    "AccountsPayable": ["AccountsPayableCurrent"],
    "DeferredRevenue": ["ContractWithCustomerLiabilityCurrent", "DeferredRevenueCurrent"],
    "TotalAssets": ["Assets"],
    "TotalLiabilities": ["Liabilities"],
    "TotalEquity": ["StockholdersEquity"],
    "OperatingCashFlow": ["NetCashProvidedByUsedInOperatingActivities"],
    "InvestingCashFlow": ["NetCashProvidedByUsedInInvestingActivities"],
    "FinancingCashFlow": ["NetCashProvidedByUsedInFinancingActivities"],
    "CapEx": ["PaymentsToAcquirePropertyPlantAndEquipment", "PaymentsToAcquireProductiveAssets", "PaymentsForCapitalImprovements"],
    "Depreciation": ["DepreciationDepletionAndAmortization", "DepreciationAndAmortization", "Depreciation"],
    "StockBasedCompensation": ["ShareBasedCompensation"],
    "TreasuryStockRepurchases": ["PaymentsForRepurchaseOfCommonStock", "TreasuryStockValueAcquiredCostMethod"],
    "LongTermDebt": ["LongTermDebtNoncurrent"],
    "ShortTermDebt": ["LongTermDebtCurrent"],
    "SharesOutstanding": ["EntityCommonStockSharesOutstanding"],
    "DilutedShares": ["WeightedAverageNumberOfDilutedSharesOutstanding"],
    "CurrentAssets": ["AssetsCurrent"],
    "CurrentLiabilities": ["LiabilitiesCurrent"],
    "RPO": ["RevenueRemainingPerformanceObligation"],
}
UNITS = {"SharesOutstanding": "shares", "DilutedShares": "shares"}
NAMESPACES = {"SharesOutstanding": "dei"}
DEFAULT_UNIT, DEFAULT_NAMESPACE = "USD", "us-gaap"
FISCAL_PERIODS = ("FY", "Q1", "Q2", "Q3", "Q4")
FORM_PRIORITY = {"10-K/A": 4, "10-Q/A": 3, "10-K": 2, "10-Q": 1}

CUMULATIVE_CASH_FLOW = ("OperatingCashFlow", "InvestingCashFlow", "FinancingCashFlow", "CapEx", "Depreciation", "StockBasedCompensation", "TreasuryStockRepurchases")
BALANCE_SHEET = (
    "Cash", "AccountsReceivable", "Inventory", "AccountsPayable", "DeferredRevenue", "TotalAssets", "TotalLiabilities", "TotalEquity",
    "LongTermDebt", "ShortTermDebt", "SharesOutstanding", "CurrentAssets", "CurrentLiabilities", "RPO",
)
Q4_DERIVABLE = ("Revenue", "CostOfRevenue", "GrossProfit", "OperatingExpenses", "OperatingIncome", "NetIncome", "ResearchAndDevelopment")
LOAD_BEARING = ("Revenue", "OperatingIncome", "OperatingCashFlow", "NetIncome")
DERIVED_FCF = "OperatingCashFlow - CapEx (derived)"
DERIVED_Q4 = " (FY − Q1−Q2−Q3 derived)"

# Item, and the prefix of its provenance columns in the wide views.
INCOME = {"Revenue": "revenue", "CostOfRevenue": "cost_of_revenue", "GrossProfit": "gross_profit", "OperatingExpenses": "opex", "OperatingIncome": "operating_income", "NetIncome": "net_income"}
BALANCE = {"Cash": "cash", "AccountsReceivable": "ar", "Inventory": "inventory", "AccountsPayable": "ap", "DeferredRevenue": "deferred_rev", "TotalAssets": "total_assets", "TotalLiabilities": "total_liab", "TotalEquity": "total_equity"}
CASH_FLOW = {"OperatingCashFlow": "ocf", "InvestingCashFlow": "icf", "FinancingCashFlow": "fcf", "CapEx": "capex", "Depreciation": "depreciation", "StockBasedCompensation": "sbc", "TreasuryStockRepurchases": "buybacks"}

# Line item, label, category, unit.
METRICS = [
    ("Revenue", "Revenue", "Income Statement", "USD"),
    ("CostOfRevenue", "Cost of Revenue", "Income Statement", "USD"),
    ("GrossProfit", "Gross Profit", "Income Statement", "USD"),
    ("OperatingExpenses", "Operating Expenses", "Income Statement", "USD"),
    ("OperatingIncome", "Operating Income", "Income Statement", "USD"),
    ("NetIncome", "Net Income", "Income Statement", "USD"),
    ("ResearchAndDevelopment", "Research & Development", "Income Statement", "USD"),
    ("Cash", "Cash & Equivalents", "Balance Sheet", "USD"),
    ("AccountsReceivable", "Accounts Receivable", "Balance Sheet", "USD"),
    ("Inventory", "Inventory", "Balance Sheet", "USD"),
    ("AccountsPayable", "Accounts Payable", "Balance Sheet", "USD"),
    ("DeferredRevenue", "Deferred Revenue", "Balance Sheet", "USD"),
    ("TotalAssets", "Total Assets", "Balance Sheet", "USD"),
    ("TotalLiabilities", "Total Liabilities", "Balance Sheet", "USD"),
    ("TotalEquity", "Total Equity", "Balance Sheet", "USD"),
    ("OperatingCashFlow", "Operating Cash Flow", "Cash Flow", "USD"),
    ("InvestingCashFlow", "Investing Cash Flow", "Cash Flow", "USD"),
    ("FinancingCashFlow", "Financing Cash Flow", "Cash Flow", "USD"),
    ("CapEx", "Capital Expenditures", "Cash Flow", "USD"),
    ("Depreciation", "Depreciation & Amortization", "Cash Flow", "USD"),
    ("FreeCashFlow", "Free Cash Flow", "Cash Flow", "USD"),
    ("StockBasedCompensation", "Stock-Based Compensation", "Cash Flow", "USD"),
    ("TreasuryStockRepurchases", "Treasury Stock Repurchases", "Cash Flow", "USD"),
    ("LongTermDebt", "Long-Term Debt", "Balance Sheet", "USD"),
    ("ShortTermDebt", "Short-Term Debt", "Balance Sheet", "USD"),
    ("SharesOutstanding", "Common Shares Outstanding", "Capital Structure", "shares"),
    ("DilutedShares", "Diluted Weighted-Avg Shares", "Capital Structure", "shares"),
    ("CurrentAssets", "Current Assets", "Balance Sheet", "USD"),
    ("CurrentLiabilities", "Current Liabilities", "Balance Sheet", "USD"),
    ("RPO", "Remaining Performance Obligation", "Balance Sheet", "USD"),
]

FACT_COLUMNS = (
    "ticker", "line_item", "concept_used", "period_end", "period_type", "fiscal_year", "fiscal_period", "value", "unit",
    "accession_no", "fact_id", "filing_url", "form_type", "filed_date", "frame",
)
FACT_DDL = ", ".join(f"{c} {'int' if c == 'fiscal_year' else 'double' if c == 'value' else 'string'}" for c in FACT_COLUMNS)
