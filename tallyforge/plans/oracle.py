"""The queries' SQL in DuckDB's dialect, written apart from the plans they are held against."""

from __future__ import annotations

from ..functions import vocab
from ..operators import guard
from ..sources.adapter import FORMS, ITEMS


def _list(items) -> str:
    return ", ".join("'" + str(x).replace("'", "''") + "'" for x in items)


_FE = "((k % 4) * 3 + 3)"
_FP = "'Q' || (4 - (((({fe} - month({d})) % 12) + 12) % 12) // 3)"
_FY = "(year({d}) + CASE WHEN month({d}) > {fe} THEN 1 ELSE 0 END)::INT"
_PRIORITY = "CASE form_type WHEN '10-K/A' THEN 4 WHEN '10-Q/A' THEN 3 WHEN '10-K' THEN 2 WHEN '10-Q' THEN 1 ELSE 0 END"

_LINES = f"""
SELECT l_suppkey % 8 AS k, ([{_list(ITEMS)}])[l_partkey % 24 + 1] AS line_item, ([{_list(FORMS)}])[l_linenumber % 4 + 1] AS form_type, l_linenumber AS ln,
  last_day(date_trunc('quarter', l_shipdate) + INTERVAL 2 MONTH)::DATE AS pe, (l_partkey // 24) % 2 = 0 AS framed, sum(l_extendedprice::DECIMAL(18,2)) AS v
FROM lineitem GROUP BY ALL"""

_RAW = f"""
SELECT k, line_item, line_item || CASE WHEN fy % 5 = 0 AND fp = 'Q2' THEN 'Alt' ELSE 'Concept' END AS concept_used, pe, 'Q' AS period_type, fy AS fiscal_year, fp AS fiscal_period,
  v::DOUBLE AS value, quarter(pe) * 1000 + ln AS num, form_type, (pe + (30 + ln)::INT)::DATE AS filed, CASE WHEN framed THEN 'CY' || year(pe) || 'Q' || quarter(pe) ELSE '' END AS frame
FROM labelled WHERE NOT (fp = 'Q4' AND fy % 2 = 0 AND line_item IN ({_list(vocab.Q4_DERIVABLE)}))
UNION ALL
SELECT k, line_item, line_item || 'Concept', last_day(make_date(fy, {_FE}::INT, 1)), 'FY', fy, 'FY', v * scale, num, form, (last_day(make_date(fy, {_FE}::INT, 1)) + late)::DATE, 'CY' || fy
FROM (SELECT k, line_item, fy, sum(v)::DOUBLE AS v FROM labelled GROUP BY ALL) y
CROSS JOIN (VALUES ('10-K', 1.0::DOUBLE, 9001, 60), ('10-K/A', 1.05::DOUBLE, 9002, 120)) f(form, scale, num, late)
WHERE form = '10-K' OR (k + fy) % 3 = 0"""

_FACTS = """
SELECT 'S' || k AS ticker, line_item, concept_used, pe::VARCHAR AS period_end, period_type, fiscal_year, fiscal_period, value,
  CASE WHEN line_item IN ('DilutedShares', 'SharesOutstanding') THEN 'shares' ELSE 'USD' END AS unit, accn AS accession_no,
  left(sha256(concat_ws('|', 'S' || k, concept_used, pe::VARCHAR, fiscal_period, accn)), 16) AS fact_id,
  'https://filings.example/data/' || (k + 1) || '/' || replace(accn, '-', '') || '/' AS filing_url, form_type, filed::VARCHAR AS filed_date, frame
FROM (SELECT *, lpad((k + 1)::VARCHAR, 10, '0') || '-' || substr(pe::VARCHAR, 3, 2) || '-' || lpad(num::VARCHAR, 6, '0') AS accn FROM raw)"""


def _wide(items: dict[str, str], more: str = "") -> str:
    made = []
    for item, p in items.items():
        for c, n in (("value", item), ("fact_id", f"{p}_fact_id"), ("accession_no", f"{p}_accession"), ("filing_url", f"{p}_filing_url")):
            made.append(f"max({c}) FILTER (WHERE line_item = '{item}') AS {n}")
    return f"SELECT *{more} FROM (SELECT ticker, period_end, fiscal_year, fiscal_period, period_type, {', '.join(made)} FROM canonical GROUP BY ALL)"




def _div(a: str, b: str) -> str:
    return f"(({a}) / nullif({b}, 0))"


_KEY = f"""
SELECT q.ticker, q.period_end, q.period_type, q.fiscal_year, q.fiscal_period, q.Revenue, q.GrossProfit, q.OperatingIncome, q.NetIncome, c.OperatingCashFlow, c.CapEx, c.FreeCashFlow,
  {_div("q.GrossProfit", "q.Revenue")} AS gross_margin_pct, {_div("q.OperatingIncome", "q.Revenue")} AS operating_margin_pct, {_div("q.NetIncome", "q.Revenue")} AS net_margin_pct,
  {_div("c.FreeCashFlow", "q.Revenue")} AS fcf_margin_pct,
  (q.Revenue - lag(q.Revenue) OVER w) / nullif(lag(q.Revenue) OVER w, 0) AS revenue_qoq_growth, (q.Revenue - lag(q.Revenue, 4) OVER w) / nullif(lag(q.Revenue, 4) OVER w, 0) AS revenue_yoy_growth,
  q.fiscal_year * 4 + substr(q.fiscal_period, 2, 1)::INT - lag(q.fiscal_year * 4 + substr(q.fiscal_period, 2, 1)::INT) OVER w AS d1,
  q.fiscal_year * 4 + substr(q.fiscal_period, 2, 1)::INT - lag(q.fiscal_year * 4 + substr(q.fiscal_period, 2, 1)::INT, 4) OVER w AS d4
FROM inc q LEFT JOIN cf c ON c.ticker = q.ticker AND c.period_end = q.period_end AND c.fiscal_year = q.fiscal_year AND c.fiscal_period = q.fiscal_period AND c.period_type = 'Q'
WHERE q.period_type = 'Q' WINDOW w AS (PARTITION BY q.ticker ORDER BY q.fiscal_year, q.fiscal_period, q.period_end)"""

_BRIDGE = """
SELECT ticker, period_end, fiscal_year, fiscal_period, period_type, component, component_order, component_role, value, accession_no, fact_id, filing_url FROM (
  SELECT *, 'NetIncome' AS component, 1 AS component_order, 'start' AS component_role, NetIncome AS value, net_income_accession AS accession_no, net_income_fact_id AS fact_id, net_income_filing_url AS filing_url FROM five
  UNION ALL SELECT *, 'Depreciation', 2, 'add', Depreciation, depreciation_accession, depreciation_fact_id, depreciation_filing_url FROM five
  UNION ALL SELECT *, 'StockBasedCompensation', 3, 'add', StockBasedCompensation, sbc_accession, sbc_fact_id, sbc_filing_url FROM five
  UNION ALL SELECT *, 'WorkingCapitalAndOther', 4, 'add', OperatingCashFlow - NetIncome - Depreciation - StockBasedCompensation, NULL, NULL, NULL FROM five
  UNION ALL SELECT *, 'OperatingCashFlow', 5, 'subtotal', OperatingCashFlow, ocf_accession, ocf_fact_id, ocf_filing_url FROM five
  UNION ALL SELECT *, 'CapEx', 6, 'subtract', -CapEx, capex_accession, capex_fact_id, capex_filing_url FROM five
  UNION ALL SELECT *, 'FreeCashFlow', 7, 'end', OperatingCashFlow - CapEx, ocf_accession, ocf_fact_id, ocf_filing_url FROM five)"""

_COLS = ", ".join(vocab.FACT_COLUMNS)

_RESTATED = """
SELECT ticker, line_item, period_end, period_type, frame, fiscal_year, fiscal_period, amended_value, amending_accession_no, amendment_date, original_value, original_accession_no, original_date, abs_diff, rel_diff FROM (
  SELECT a.ticker, a.line_item, a.period_end, a.period_type, a.frame, a.fiscal_year, a.fiscal_period, a.value AS amended_value, a.accession_no AS amending_accession_no, a.filed_date AS amendment_date,
    o.value AS original_value, o.accession_no AS original_accession_no, o.filed_date AS original_date, abs(a.value - o.value) AS abs_diff, abs(a.value - o.value) / nullif(abs(o.value), 0) AS rel_diff,
    row_number() OVER (PARTITION BY a.ticker, a.line_item, a.period_end, a.period_type, a.frame, a.accession_no ORDER BY o.filed_date DESC, o.accession_no DESC, a.fact_id DESC) AS rn
  FROM facts a JOIN facts o ON a.ticker = o.ticker AND a.line_item = o.line_item AND a.period_end = o.period_end AND a.period_type = o.period_type AND a.frame = o.frame
    AND replace(a.form_type, '/A', '') = o.form_type AND o.filed_date < a.filed_date
  WHERE a.form_type LIKE '%/A' AND (abs(a.value - o.value) > 10000 OR abs(a.value - o.value) / nullif(abs(o.value), 0) > 0.001)) WHERE rn = 1"""

_MISSING = """
SELECT q.ticker, li.line_item, q.fiscal_year, q.fiscal_period, q.period_end
FROM (SELECT DISTINCT ticker, fiscal_year, fiscal_period, period_end FROM facts WHERE period_type = 'Q') q JOIN (SELECT DISTINCT ticker, line_item FROM facts) li ON q.ticker = li.ticker
WHERE NOT EXISTS (SELECT 1 FROM facts f WHERE f.period_type = 'Q' AND f.ticker = q.ticker AND f.line_item = li.line_item AND f.fiscal_year = q.fiscal_year AND f.fiscal_period = q.fiscal_period AND f.period_end = q.period_end)"""

_QUALITY = f"""
SELECT f.ticker, count(*) AS total_facts, count(DISTINCT line_item) AS distinct_line_items, count(DISTINCT fiscal_year) AS distinct_fiscal_years, min(fiscal_year) AS min_fiscal_year, max(fiscal_year) AS max_fiscal_year,
  count(*) FILTER (WHERE line_item = 'Inventory' AND value IS NOT NULL) > 0 AS has_physical_inventory, f.ticker IN (SELECT ticker FROM restated) AS has_restatement,
  count(*) FILTER (WHERE line_item = 'GoingConcernDoubt') > 0 AS has_going_concern_doubt, count(*) FILTER (WHERE line_item = 'MaterialWeakness') > 0 AS has_material_weakness,
  (SELECT string_agg(DISTINCT 'FY' || m.fiscal_year || m.fiscal_period, ',' ORDER BY 'FY' || m.fiscal_year || m.fiscal_period) FROM missing m WHERE m.ticker = f.ticker AND m.line_item IN ({_list(vocab.LOAD_BEARING)})) AS missing_quarters
FROM facts f GROUP BY f.ticker"""

_FORECASTS = """
SELECT ticker, model, date_trunc('quarter', period_end::DATE + INTERVAL 10 MONTH)::DATE::VARCHAR AS period_end, r * kk AS yhat, r * 0.9::DOUBLE AS yhat_lower_80, r * 1.2::DOUBLE AS yhat_upper_80, r * 0.8::DOUBLE AS yhat_lower_95, r * 1.3::DOUBLE AS yhat_upper_95, period_end AS forecast_run_date
FROM (SELECT ticker, period_end, max(Revenue) AS r FROM inc WHERE period_type = 'Q' AND Revenue IS NOT NULL GROUP BY ALL) CROSS JOIN (VALUES ('arima', 1.02::DOUBLE), ('lasso', 0.97::DOUBLE), ('prophet', 1.1::DOUBLE)) m(model, kk)"""

_TFE = "((substr(ticker, 2)::INT % 4) * 3 + 3)"
_SNAPPED = f"""
SELECT ticker, model, last_day(date_trunc('month', period_end::DATE) + to_months((({_TFE} - month(period_end::DATE)) % 3 + 3) % 3))::DATE::VARCHAR AS period_end, yhat, yhat_lower_80, yhat_upper_80, yhat_lower_95, yhat_upper_95, forecast_run_date, 'Revenue' AS line_item FROM forecasts"""

_VROWS = f"""
SELECT i.ticker, i.period_end, i.fiscal_year, i.fiscal_period, i.Revenue AS rev, {_div("i.GrossProfit", "i.Revenue")} AS gm, {_div("i.OperatingIncome", "i.Revenue")} AS om, c.FreeCashFlow AS fcf,
  i.Revenue + (b.dr - (SELECT p.dr FROM drs p WHERE p.ticker = i.ticker AND p.period_end < i.period_end ORDER BY p.period_end DESC LIMIT 1)) AS bill,
  i.revenue_fact_id, i.revenue_accession, i.revenue_filing_url, i.gross_profit_fact_id, i.operating_income_fact_id
FROM inc i LEFT JOIN cf c ON c.ticker = i.ticker AND c.period_end = i.period_end AND c.period_type = 'Q' LEFT JOIN drs b ON b.ticker = i.ticker AND b.period_end = i.period_end WHERE i.period_type = 'Q'"""

_VARIANCE = f"""
SELECT n.ticker, n.period_end AS latest_period_end, n.fiscal_year, n.fiscal_period, n.rev AS revenue_actual, f.med AS revenue_prior_forecast, y.rev AS revenue_yoy, n.rev - f.med AS revenue_variance_vs_forecast,
  {_div("n.rev - f.med", "f.med")} AS revenue_variance_pct_vs_forecast, {_div("n.rev - y.rev", "y.rev")} AS revenue_yoy_growth_pct,
  n.gm AS gross_margin_pct_actual, y.gm AS gross_margin_pct_yoy, n.gm - y.gm AS gross_margin_pct_yoy_delta, n.om AS operating_margin_pct_actual, y.om AS operating_margin_pct_yoy, n.om - y.om AS operating_margin_pct_yoy_delta,
  n.fcf AS fcf_actual, y.fcf AS fcf_yoy, n.fcf - y.fcf AS fcf_yoy_delta, {_div("n.fcf - y.fcf", "abs(y.fcf)")} AS fcf_yoy_growth_pct, n.bill AS billings_actual, y.bill AS billings_yoy, {_div("n.bill - y.bill", "abs(y.bill)")} AS billings_yoy_growth_pct,
  n.revenue_fact_id AS revenue_actual_fact_id, n.revenue_accession AS revenue_actual_accession, n.revenue_filing_url AS revenue_actual_filing_url, f.models AS revenue_prior_forecast_model, n.gross_profit_fact_id, n.operating_income_fact_id AS op_income_fact_id
FROM (SELECT * FROM vrows WHERE rev IS NOT NULL QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY fiscal_year DESC, fiscal_period DESC, period_end DESC) = 1) n
LEFT JOIN (SELECT * FROM vrows QUALIFY row_number() OVER (PARTITION BY ticker, fiscal_year, fiscal_period ORDER BY period_end DESC) = 1) y ON y.ticker = n.ticker AND y.fiscal_year = n.fiscal_year - 1 AND y.fiscal_period = n.fiscal_period
LEFT JOIN (SELECT ticker, period_end, median(yhat) AS med, string_agg(DISTINCT model, '|' ORDER BY model) AS models FROM {{source}} GROUP BY ALL) f ON f.ticker = n.ticker AND f.period_end = n.period_end"""

_COLLAPSED = f"""
SELECT {_COLS} FROM canonical WHERE period_type = 'Q' OR (period_type = 'FY' AND line_item IN ({_list(vocab.BALANCE_SHEET)}))
QUALIFY row_number() OVER (PARTITION BY ticker, line_item, period_end ORDER BY {_PRIORITY} DESC, filed_date DESC, CASE WHEN frame LIKE 'CY%Q%' THEN 0 ELSE 1 END, abs(value), accession_no DESC, fact_id DESC) = 1"""


def _relabel(source: str, columns: str = _COLS) -> str:
    d = "period_end::DATE"
    return f"SELECT {columns} FROM (SELECT * REPLACE ({_FY.format(d=d, fe=_TFE)} AS fiscal_year, {_FP.format(d=d, fe=_TFE)} AS fiscal_period) FROM {source})"


_PROMOTED = "SELECT * REPLACE (CASE WHEN period_type = 'FY' THEN 'Q' ELSE period_type END AS period_type) FROM collapsed"

_Q4 = f"""
SELECT t.ticker, t.line_item, t.concept_used || '{vocab.DERIVED_Q4}' AS concept_used, t.period_end, 'Q' AS period_type, t.fiscal_year, 'Q4' AS fiscal_period, t.value - s.v::DOUBLE AS value, t.unit, t.accession_no,
  t.accession_no || ':' || t.line_item || ':Q4derived:' || t.period_end AS fact_id, t.filing_url, t.form_type, t.filed_date, '' AS frame
FROM (SELECT * FROM totals QUALIFY row_number() OVER (PARTITION BY ticker, line_item, fiscal_year ORDER BY period_end DESC, fact_id DESC) = 1) t
JOIN (SELECT ticker, line_item, fiscal_year, sum(value::DECIMAL(28,4)) AS v, count(DISTINCT fiscal_period) AS n, list_sort(list(DISTINCT concept_used)) AS concepts
  FROM base WHERE fiscal_period IN ('Q1', 'Q2', 'Q3') AND line_item IN ({_list(vocab.Q4_DERIVABLE)}) GROUP BY ALL) s ON s.ticker = t.ticker AND s.line_item = t.line_item AND s.fiscal_year = t.fiscal_year
WHERE s.n = 3 AND s.concepts = [t.concept_used]
  AND NOT EXISTS (SELECT 1 FROM base b WHERE b.ticker = t.ticker AND b.line_item = t.line_item AND b.fiscal_year = t.fiscal_year AND b.fiscal_period = 'Q4')"""


def _standalone(source: str) -> str:
    flow = f"line_item IN ({_list(vocab.CUMULATIVE_CASH_FLOW)}) AND period_type = 'Q'"
    columns = ", ".join(f"x.{c}" for c in vocab.FACT_COLUMNS if c != "value")
    return f"""SELECT {columns}, CASE WHEN x.due AND p.v IS NOT NULL THEN x.value - p.v ELSE x.value END AS value, x.due AND p.v IS NULL AS unbased
FROM (SELECT *, {flow} AND fiscal_period > 'Q1' AND NOT regexp_full_match(frame, 'CY[0-9]{{4}}Q[1-4]') AS due FROM {source}) x
LEFT JOIN (SELECT ticker, line_item, fiscal_year, fiscal_period, max(value) AS v FROM {source} WHERE {flow} GROUP BY ALL) p
  ON p.ticker = x.ticker AND p.line_item = x.line_item AND p.fiscal_year = x.fiscal_year AND p.fiscal_period = 'Q' || (substr(x.fiscal_period, 2, 1)::INT - 1)"""


_FIN = f"""
SELECT {_COLS} FROM alone UNION ALL
SELECT {_COLS} FROM (SELECT o.* REPLACE ('FreeCashFlow' AS line_item, o.value - c.value AS value, '{vocab.DERIVED_FCF}' AS concept_used, o.accession_no || ':FreeCashFlow:' || o.period_end AS fact_id)
  FROM alone o JOIN alone c ON o.ticker = c.ticker AND o.period_end = c.period_end AND o.line_item = 'OperatingCashFlow' AND c.line_item = 'CapEx')"""

_DATES = f"""
SELECT ticker, period_end AS date_key, period_end, fiscal_year, fiscal_period AS fiscal_quarter, year(period_end::DATE)::INT AS calendar_year, quarter(period_end::DATE)::INT AS calendar_quarter FROM (
  SELECT ticker, period_end, fiscal_year, fiscal_period, 0 AS r FROM fin WHERE fiscal_period LIKE 'Q%' UNION ALL
  SELECT ticker, period_end, fiscal_year, fiscal_period, 1 FROM (SELECT ticker, period_end, {_FY.format(d="period_end::DATE", fe=_TFE)} AS fiscal_year, {_FP.format(d="period_end::DATE", fe=_TFE)} AS fiscal_period FROM snapped))
QUALIFY row_number() OVER (PARTITION BY ticker, period_end ORDER BY r, fiscal_year DESC, fiscal_period DESC) = 1"""

_METRICS = ", ".join("(" + _list(m) + ")" for m in vocab.METRICS)
_FILINGS = "SELECT accession_no, filing_url, filed_date, form_type FROM facts QUALIFY row_number() OVER (PARTITION BY accession_no ORDER BY filing_url, filed_date, form_type, fact_id) = 1"


def _quarterly(*items: str) -> str:
    return "SELECT ticker, period_end, " + ", ".join(f"(sum(value::DECIMAL(28,4)) FILTER (WHERE line_item = '{i}'))::DOUBLE AS {i}" for i in items) + f" FROM fin WHERE period_type = 'Q' AND line_item IN ({_list(items)}) GROUP BY ALL"


def _ttm(c: str) -> str:
    return f"CASE WHEN count(*) OVER t = 4 THEN (sum({c}::DECIMAL(28,4)) OVER t)::DOUBLE END"


_TTM = f"""
SELECT *, ttm_ocf - ttm_capex AS ttm_fcf, {_div("ttm_operating_income", "ttm_revenue")} AS ttm_operating_margin, {_div("ttm_ocf - ttm_capex", "ttm_revenue")} AS ttm_fcf_margin FROM (
SELECT *, {_ttm("Revenue")} AS ttm_revenue, {_ttm("OperatingIncome")} AS ttm_operating_income, {_ttm("OperatingCashFlow")} AS ttm_ocf, {_ttm("CapEx")} AS ttm_capex
FROM ({_quarterly("Revenue", "OperatingIncome", "OperatingCashFlow", "CapEx")}) WINDOW t AS (PARTITION BY ticker ORDER BY period_end ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))"""

_SCORE = f"""
SELECT s.ticker, model, s.period_end, forecast_run_date, Revenue, yhat, Revenue - yhat AS variance, {_div("Revenue - yhat", "yhat")} AS variance_pct,
  CASE WHEN abs({_div("Revenue - yhat", "yhat")}) < 0.05 THEN '<5%' WHEN abs({_div("Revenue - yhat", "yhat")}) <= 0.1 THEN '5-10%' WHEN abs({_div("Revenue - yhat", "yhat")}) > 0.1 THEN '>10%' END AS band
FROM snapped s JOIN ({_quarterly("Revenue")}) a ON a.ticker = s.ticker AND a.period_end = s.period_end"""

_HIST = """
SELECT *, (row_number() OVER (PARTITION BY ticker ORDER BY fiscal_year, fiscal_period, period_end))::INT AS slot FROM (
SELECT i.ticker, i.period_end, i.fiscal_year, i.fiscal_period, i.Revenue, i.CostOfRevenue, i.GrossProfit, i.OperatingExpenses, i.OperatingIncome, i.NetIncome, b.Cash, b.AccountsReceivable, b.Inventory, b.AccountsPayable, b.DeferredRevenue, b.TotalAssets, b.TotalLiabilities, b.TotalEquity,
  c.OperatingCashFlow, c.InvestingCashFlow, c.FinancingCashFlow, c.Depreciation, c.StockBasedCompensation, c.TreasuryStockRepurchases, c.CapEx
FROM inc i JOIN bs b ON b.ticker = i.ticker AND b.period_end = i.period_end AND b.fiscal_year = i.fiscal_year AND b.fiscal_period = i.fiscal_period AND b.period_type = 'Q'
JOIN cf c ON c.ticker = i.ticker AND c.period_end = i.period_end AND c.fiscal_year = i.fiscal_year AND c.fiscal_period = i.fiscal_period AND c.period_type = 'Q'
WHERE i.period_type = 'Q' AND b.TotalAssets IS NOT NULL AND b.TotalLiabilities IS NOT NULL AND b.TotalEquity IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY i.ticker ORDER BY i.fiscal_year DESC, i.fiscal_period DESC, i.period_end DESC) <= 12)"""

_LAST = """
SELECT ticker, max(n) AS n, avg(q) AS g, avg(qo) AS og, max(CASE WHEN back = 4 THEN rev END) AS rev5, avg(capex) FILTER (WHERE back < 4) AS capex4, avg(rev) FILTER (WHERE back < 4) AS rev4, bool_or(inv != 0) AS has_inventory,
  max(CASE WHEN back = 0 THEN rev END) AS revenue_last, max(CASE WHEN back = 0 THEN gp END) AS gp, max(CASE WHEN back = 0 THEN cogs END) AS cogs, max(CASE WHEN back = 0 THEN opex END) AS opex, max(CASE WHEN back = 0 THEN ar END) AS ar, max(CASE WHEN back = 0 THEN ap END) AS ap,
  max(CASE WHEN back = 0 THEN inv END) AS inv, max(CASE WHEN back = 0 THEN sbc END) AS sbc, max(CASE WHEN back = 0 THEN buy END) AS buy, max(CASE WHEN back = 0 THEN dep END) AS dep, max(CASE WHEN back = 0 THEN cash END) AS cash, max(CASE WHEN back = 0 THEN dr END) AS dr,
  max(CASE WHEN back = 0 THEN ta END) AS ta, max(CASE WHEN back = 0 THEN tl END) AS tl, max(CASE WHEN back = 0 THEN eq END) AS eq FROM (
SELECT *, CASE WHEN back < 4 AND n >= 5 AND lag(rev) OVER w > 0 THEN rev / nullif(lag(rev) OVER w, 0) - 1 END AS q, CASE WHEN back < 4 AND n >= 5 AND lag(opex) OVER w > 0 THEN opex / nullif(lag(opex) OVER w, 0) - 1 END AS qo FROM (
SELECT ticker, slot, max(slot) OVER (PARTITION BY ticker) AS n, max(slot) OVER (PARTITION BY ticker) - slot AS back, coalesce(Revenue, 0) AS rev, coalesce(GrossProfit, 0) AS gp, coalesce(CostOfRevenue, 0) AS cogs, coalesce(OperatingExpenses, 0) AS opex, coalesce(CapEx, 0) AS capex,
  coalesce(AccountsReceivable, 0) AS ar, coalesce(AccountsPayable, 0) AS ap, coalesce(Inventory, 0) AS inv, coalesce(StockBasedCompensation, 0) AS sbc, coalesce(TreasuryStockRepurchases, 0) AS buy, coalesce(Depreciation, 0) AS dep, coalesce(Cash, 0) AS cash, coalesce(DeferredRevenue, 0) AS dr,
  coalesce(TotalAssets, 0) AS ta, coalesce(TotalLiabilities, 0) AS tl, coalesce(TotalEquity, 0) AS eq FROM hist) WINDOW w AS (PARTITION BY ticker ORDER BY slot)) GROUP BY ticker"""

_ASSUME = """
SELECT ticker, has_inventory, greatest(-0.2, least(0.5, CASE WHEN n >= 5 AND rev5 > 0 THEN coalesce(g, 0.04) ELSE 0.04 END))::DOUBLE AS revenue_growth_qoq, greatest(0.3, least(0.99, CASE WHEN revenue_last > 0 THEN gp / revenue_last ELSE 0.68 END))::DOUBLE AS gross_margin_pct,
  greatest(-0.2, least(0.5, coalesce(og, 0.02)))::DOUBLE AS opex_growth_qoq,
  greatest(0.001, least(0.2, CASE WHEN (CASE WHEN n >= 4 THEN rev4 ELSE greatest(revenue_last, 1) END) > 0 THEN (CASE WHEN n >= 4 THEN capex4 ELSE 0 END) / (CASE WHEN n >= 4 THEN rev4 ELSE greatest(revenue_last, 1) END) ELSE 0.02 END))::DOUBLE AS capex_pct_of_revenue,
  greatest(1, least(180, CASE WHEN revenue_last > 0 THEN ar / revenue_last * 90 ELSE 60 END))::DOUBLE AS dso_days, greatest(1, least(180, CASE WHEN cogs > 0 THEN ap / cogs * 90 ELSE 45 END))::DOUBLE AS dpo_days,
  greatest(0, least(180, CASE WHEN has_inventory AND cogs > 0 THEN inv / cogs * 90 ELSE 0 END))::DOUBLE AS dio_days, 0.15::DOUBLE AS tax_rate, 0.0::DOUBLE AS debt_amortization_qoq, sbc AS sbc_qtrly, buy AS buybacks_qtrly, opex AS opex_trailing, revenue_last, dep AS depreciation,
  cash, ar, CASE WHEN has_inventory THEN inv ELSE 0 END::DOUBLE AS inventory, ap, dr AS deferred, ta AS total_assets, tl AS total_liabilities, eq AS equity FROM lastq"""

_SCEN = """
SELECT a.* REPLACE (revenue_growth_qoq * mg AS revenue_growth_qoq, CASE WHEN scenario = 'Bull' THEN least(0.99, gross_margin_pct * mm) ELSE gross_margin_pct * mm END AS gross_margin_pct, opex_growth_qoq * mo AS opex_growth_qoq, dso_days * md AS dso_days), scenario
FROM assume a CROSS JOIN (VALUES ('Base', 1.0::DOUBLE, 1.0::DOUBLE, 1.0::DOUBLE, 1.0::DOUBLE), ('Bull', 1.5, 1.02, 0.8, 0.95), ('Bear', 0.4, 0.98, 1.3, 1.1)) s(scenario, mg, mm, mo, md)"""

_PROJ = """
SELECT ticker, scenario, 0 AS step, revenue_last AS rev, 0.0::DOUBLE AS gp, opex_trailing AS opex, 0.0::DOUBLE AS ni, 0.0::DOUBLE AS ocf, cash, ar, inventory AS inv, ap, equity AS eq, total_assets - cash - ar - inventory AS oa, 0.0::DOUBLE AS ta, 0.0::DOUBLE AS tl, 0.0::DOUBLE AS bc FROM scen
UNION ALL
SELECT ticker, scenario, step, rev, gp, opex, ni, ocf, cash, ar2, inv2, ap2, eq, oa, cash + ar2 + inv2 + oa, ap2 + deferred + (total_liabilities - ap0 - deferred), cash + ar2 + inv2 + oa - (ap2 + deferred + 0 + (total_liabilities - ap0 - deferred)) - eq FROM (
SELECT *, cash1 + (ocf - rev * capex_pct_of_revenue - buybacks_qtrly) AS cash, eq1 + ni + sbc_qtrly - buybacks_qtrly AS eq, oa1 + rev * capex_pct_of_revenue - depreciation AS oa FROM (
SELECT *, ni + depreciation + sbc_qtrly - (ar2 - ar1) - (inv2 - inv1) + (ap2 - ap1) AS ocf FROM (
SELECT *, (gp - opex) - greatest(0, gp - opex) * tax_rate AS ni, rev * dso_days / 90 AS ar2, CASE WHEN has_inventory THEN cogs * dio_days / 90 ELSE 0 END AS inv2, cogs * dpo_days / 90 AS ap2 FROM (
SELECT *, rev - cogs AS gp FROM (
SELECT s.*, s.ap AS ap0, p.step + 1 AS step, p.rev * (1 + s.revenue_growth_qoq) AS rev, p.rev * (1 + s.revenue_growth_qoq) * (1 - s.gross_margin_pct) AS cogs, p.opex * (1 + s.opex_growth_qoq) AS opex, p.cash AS cash1, p.ar AS ar1, p.inv AS inv1, p.ap AS ap1, p.eq AS eq1, p.oa AS oa1
FROM proj p JOIN (SELECT * EXCLUDE (cash), cash AS cash0 FROM scen) s ON s.ticker = p.ticker AND s.scenario = p.scenario WHERE p.step < 4)))))"""

CTES = {
    "lines": _LINES,
    "labelled": f"SELECT *, {_FY.format(d='pe', fe=_FE)} AS fy, {_FP.format(d='pe', fe=_FE)} AS fp FROM lines",
    "raw": _RAW,
    "facts": _FACTS,
    "canonical": f"SELECT {_COLS} FROM facts QUALIFY row_number() OVER (PARTITION BY ticker, line_item, period_end, period_type, frame ORDER BY {_PRIORITY} DESC, filed_date DESC, accession_no DESC, fact_id DESC) = 1",
    "inc": _wide(vocab.INCOME),
    "bs": _wide(vocab.BALANCE),
    "cf": _wide(vocab.CASH_FLOW, ", OperatingCashFlow - CapEx AS FreeCashFlow"),
    "km": _KEY,
    "five": _wide({k: v for k, v in (vocab.INCOME | vocab.CASH_FLOW).items() if k in ("NetIncome", "Depreciation", "StockBasedCompensation", "OperatingCashFlow", "CapEx")})
    + " WHERE period_type = 'Q' AND NetIncome IS NOT NULL AND Depreciation IS NOT NULL AND StockBasedCompensation IS NOT NULL AND OperatingCashFlow IS NOT NULL AND CapEx IS NOT NULL",
    "bridge": _BRIDGE,
    "restated": _RESTATED,
    "missing": _MISSING,
    "quality": _QUALITY,
    "forecasts": _FORECASTS,
    "snapped": _SNAPPED,
    "drs": "SELECT ticker, period_end, max(DeferredRevenue) AS dr FROM bs WHERE DeferredRevenue IS NOT NULL GROUP BY ALL",
    "vrows": _VROWS,
    "variance": _VARIANCE.format(source="snapped"),
    "collapsed": _COLLAPSED,
    "promoted": _PROMOTED,
    "base": _relabel(
        "(SELECT * FROM promoted QUALIFY row_number() OVER (PARTITION BY ticker, line_item, period_end, fiscal_year, fiscal_period ORDER BY CASE WHEN regexp_full_match(frame, 'CY[0-9]+Q[0-9]+') THEN 0 ELSE 1 END, abs(value), fact_id DESC) = 1)"
    ),
    "totals": _relabel(
        f"(SELECT * FROM canonical WHERE period_type = 'FY' AND line_item IN ({_list(vocab.Q4_DERIVABLE)}) QUALIFY row_number() OVER (PARTITION BY ticker, line_item, period_end ORDER BY {_PRIORITY} DESC, filed_date DESC, accession_no DESC, fact_id DESC) = 1)"
    ),
    "q4": _Q4,
    "withq4": f"SELECT {_COLS} FROM base UNION ALL SELECT {_COLS} FROM q4",
    "alone": f"SELECT {_COLS} FROM ({_standalone('withq4')})",
    "fin": _FIN,
    "ddate": _DATES,
    "dmetric": f"SELECT * FROM (VALUES {_METRICS}) m(line_item, label, category, unit)",
    "dfiling": _FILINGS,
    "ttm": _TTM,
    "score": _SCORE,
    "hist": _HIST,
    "lastq": _LAST,
    "assume": _ASSUME,
    "scen": _SCEN,
    "proj": _PROJ,
    "series": "SELECT ticker, period_end, fiscal_year, fiscal_period, value AS y FROM fin WHERE line_item = 'Revenue' AND period_type = 'Q'",
}
_PREFIX = "WITH RECURSIVE " + ",\n".join(f"{k} AS ({v})" for k, v in CTES.items()) + "\n"


def _r(columns: str, digits: int = 4) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns.split())


_WIDE_CF = "* REPLACE (" + _r("OperatingCashFlow InvestingCashFlow FinancingCashFlow CapEx Depreciation StockBasedCompensation TreasuryStockRepurchases FreeCashFlow") + ")"
_KM = "* EXCLUDE (d1, d4) REPLACE (" + _r("Revenue GrossProfit OperatingIncome NetIncome OperatingCashFlow CapEx FreeCashFlow gross_margin_pct operating_margin_pct net_margin_pct fcf_margin_pct revenue_qoq_growth revenue_yoy_growth", 6) + ")"
_VARC = (
    "revenue_actual revenue_prior_forecast revenue_yoy revenue_variance_vs_forecast revenue_variance_pct_vs_forecast revenue_yoy_growth_pct gross_margin_pct_actual gross_margin_pct_yoy gross_margin_pct_yoy_delta "
    "operating_margin_pct_actual operating_margin_pct_yoy operating_margin_pct_yoy_delta fcf_actual fcf_yoy fcf_yoy_delta fcf_yoy_growth_pct billings_actual billings_yoy billings_yoy_growth_pct"
)
_VAR = "* REPLACE (" + _r(_VARC, 6) + ")"


def _aligned(items: dict[str, str]) -> str:
    made = []
    for item, p in items.items():
        made.append(f"max(value) FILTER (WHERE line_item = '{item}') AS {item}")
        made += [f"arg_max({c}, (value, fact_id)) FILTER (WHERE line_item = '{item}') AS {p}_{n}" for n, c in (("fact_id", "fact_id"), ("accession", "accession_no"), ("filing_url", "filing_url"))]
    return f"SELECT ticker, period_end, fiscal_year, fiscal_period, period_type, {', '.join(made)} FROM canonical WHERE line_item IN ({_list(items)}) GROUP BY ALL"


def _sources() -> str:
    out = []
    for t, items in (("inc", {k: vocab.INCOME[k] for k in ("Revenue", "OperatingIncome", "NetIncome")}), ("bs", {k: vocab.BALANCE[k] for k in ("Cash", "AccountsReceivable")}), ("cf", {"OperatingCashFlow": "ocf"})):
        out += [f"SELECT ticker, period_end, fiscal_year, fiscal_period, '{i}' AS line_item, {i} AS value, {p}_accession AS accession_no, {p}_filing_url AS filing_url FROM {t} WHERE period_type = 'Q' AND {i} IS NOT NULL" for i, p in items.items()]
    return " UNION ALL ".join(out)


_BY = "PARTITION BY ticker ORDER BY period_end"
_PERIODS = "SELECT symbol, (e - INTERVAL 3 MONTH)::DATE AS start, e AS \"end\" FROM (SELECT last_day(q + INTERVAL 2 MONTH)::DATE AS e FROM (SELECT unnest(generate_series(date_trunc('quarter', min(o_orderdate)), date_trunc('quarter', max(o_orderdate)), INTERVAL 3 MONTH)) AS q FROM orders)) CROSS JOIN range(5) r(symbol)"
_ORDERS = "SELECT o_custkey % 5 AS symbol, o_orderdate::DATE AS date, o_totalprice AS v FROM orders"
_CLOSE = "(SELECT arg_max(v, date) FROM fx WHERE fx.symbol = 'E' || (substr(s.ticker, 2)::INT % 4) AND fx.date <= {at})"
_FILLED = ", ".join(
    f"coalesce(last_value({c} IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value({c} IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"
    for c in ("VIXCLS", "INDPRO", "T10Y2Y", "etf_return")
)
_FMT = "CASE WHEN x IS NULL THEN NULL ELSE CASE WHEN x < 0 THEN '-' ELSE '' END || '$' || CASE WHEN abs(x) >= 1e9 THEN printf('%.1f', abs(x) / 1e9) || 'B' WHEN abs(x) >= 1e6 THEN printf('%.1f', abs(x) / 1e6) || 'M' WHEN abs(x) >= 1e3 THEN printf('%.0f', abs(x) / 1e3) || 'K' ELSE printf('%.0f', abs(x)) END END"

_OUTPUTS = (
    "Revenue CostOfRevenue GrossProfit OperatingExpenses OperatingIncome InterestExpense PreTaxIncome Tax NetIncome CapEx SBC Buybacks DebtAmort Depreciation AccountsReceivable Inventory AccountsPayable DeferredRevenue TotalEquity OCF "
    "InvestingCF FinancingCF NetCashChange BegCash Cash EndCash Debt OtherAssets OtherLiabilities TotalAssets TotalLiabilities BalanceCheck"
)
_ALL = """SELECT p.ticker, p.scenario, p.step, rev AS Revenue, rev - gp AS CostOfRevenue, gp AS GrossProfit, opex AS OperatingExpenses, gp - opex AS OperatingIncome, 0.0::DOUBLE AS InterestExpense, gp - opex AS PreTaxIncome,
  greatest(0, gp - opex) * tax_rate AS Tax, ni AS NetIncome, rev * capex_pct_of_revenue AS CapEx, sbc_qtrly AS SBC, buybacks_qtrly AS Buybacks, 0.0::DOUBLE AS DebtAmort, depreciation AS Depreciation, p.ar AS AccountsReceivable, p.inv AS Inventory,
  p.ap AS AccountsPayable, deferred AS DeferredRevenue, eq AS TotalEquity, ocf AS OCF, -rev * capex_pct_of_revenue AS InvestingCF, -buybacks_qtrly AS FinancingCF, ocf - rev * capex_pct_of_revenue - buybacks_qtrly AS NetCashChange,
  lag(p.cash) OVER (PARTITION BY p.ticker, p.scenario ORDER BY p.step) AS BegCash, p.cash AS Cash, p.cash AS EndCash, 0.0::DOUBLE AS Debt, p.oa AS OtherAssets, total_liabilities - s.ap - deferred AS OtherLiabilities, ta AS TotalAssets, tl AS TotalLiabilities, bc AS BalanceCheck
  FROM proj p JOIN scen s ON s.ticker = p.ticker AND s.scenario = p.scenario"""
_CELLS = ", ".join(
    f"{{'s': '{st}', 'l': {k}, 'i': '{i}', 'v': {v}}}"
    for st, items in (
        ("Income_Statement", "Revenue CostOfRevenue GrossProfit OperatingExpenses OperatingIncome NetIncome GrossMarginPct"),
        ("Balance_Sheet", "Cash AccountsReceivable Inventory TotalAssets AccountsPayable DeferredRevenue TotalLiabilities TotalEquity BalanceCheck"),
        ("Cash_Flow", "NetIncome Depreciation StockBasedCompensation OperatingCashFlow CapEx InvestingCashFlow TreasuryStockRepurchases FinancingCashFlow FreeCashFlow"),
    )
    for k, i in enumerate(items.split(), 1)
    for v in [{"GrossMarginPct": "GrossProfit / CASE WHEN Revenue > 0 THEN Revenue END", "BalanceCheck": "TotalAssets - TotalLiabilities - TotalEquity", "FreeCashFlow": "OperatingCashFlow - CapEx"}.get(i, i)]
)
_BODIES = {
    "facts": "SELECT * FROM facts",
    "canonical_facts": "SELECT * FROM canonical",
    "income_statement": "SELECT * FROM inc",
    "income_statement_aligned": _aligned(vocab.INCOME),
    "balance_sheet": "SELECT * FROM bs",
    "cash_flow": f"SELECT {_WIDE_CF} FROM cf",
    "key_metrics": f"SELECT {_KM} FROM km",
    "key_metrics_calendar_safe": f"SELECT {_KM} FROM (SELECT * REPLACE (CASE WHEN d1 = 1 THEN revenue_qoq_growth END AS revenue_qoq_growth, CASE WHEN d4 = 4 THEN revenue_yoy_growth END AS revenue_yoy_growth) FROM km)",
    "fcf_bridge": "SELECT * REPLACE (round(value, 4) AS value) FROM bridge",
    "fcf_waterfall": """SELECT * REPLACE (round(value, 4) AS value), round(rt, 4) AS running_total, round(CASE WHEN component_role IN ('start', 'subtotal', 'end') THEN 0 WHEN component_role = 'add' THEN rt - value ELSE rt + value END, 4) AS bar_start,
  round(CASE WHEN component_role = 'subtract' THEN -value ELSE value END, 4) AS bar_size FROM (SELECT *, sum(CASE WHEN component_role IN ('start', 'add') THEN value ELSE 0 END) OVER (PARTITION BY ticker, period_end ORDER BY component_order ROWS UNBOUNDED PRECEDING) AS rt FROM bridge)""".replace(
        "SELECT * REPLACE (round(value, 4) AS value), round(rt", "SELECT * EXCLUDE (rt) REPLACE (round(value, 4) AS value), round(rt"
    ),
    "restatement_details": f"SELECT * REPLACE ({_r('amended_value original_value abs_diff')}, round(rel_diff, 6) AS rel_diff) FROM restated",
    "missing_coverage": "SELECT * FROM missing",
    "data_quality": "SELECT * FROM quality",
    "refusal_gate": "SELECT q.ticker, CASE WHEN has_restatement THEN 'restatement' WHEN has_going_concern_doubt THEN 'going_concern' WHEN has_material_weakness THEN 'material_weakness' WHEN trim(coalesce(missing_quarters, '')) != '' THEN 'missing_quarters' WHEN v.fiscal_year IS NULL OR v.fiscal_period IS NULL THEN 'no_period' END AS refusal_reason FROM quality q LEFT JOIN variance v ON v.ticker = q.ticker",
    "duplicate_facts": "SELECT ticker, line_item, period_end, period_type, frame, count(*) AS n_facts FROM facts GROUP BY ALL HAVING count(*) > 1",
    "variance_facts": f"SELECT {_VAR} FROM variance",
    "variance_facts_no_forecast": f"SELECT {_VAR} FROM ({_VARIANCE.format(source='(SELECT * FROM snapped WHERE false)')})",
    "export_fact_financials": "SELECT * REPLACE (round(value, 4) AS value) FROM fin",
    "collapsed_facts": "SELECT * FROM collapsed",
    "q4_income_derivation": "SELECT * REPLACE (round(value, 4) AS value) FROM q4",
    "derived_fcf": "SELECT * REPLACE (round(value, 4) AS value) FROM fin WHERE line_item = 'FreeCashFlow'",
    "ytd_to_standalone": f"SELECT {_COLS} FROM (SELECT * REPLACE (round(value, 4) AS value) FROM ({_standalone('(' + _relabel('collapsed') + ')')})) WHERE line_item IN ('OperatingCashFlow', 'CapEx')",
    "unbased_cash_flow": f"SELECT ticker, line_item, fiscal_year, substr(fiscal_period, 2, 1)::INT AS quarter FROM ({_standalone('(' + _relabel('collapsed') + ')')}) WHERE unbased",
    "fact_fcf_bridge": _relabel("bridge", "* REPLACE (round(value, 4) AS value)"),
    "fact_forecasts_snapped": f"SELECT * REPLACE ({_r('yhat yhat_lower_80 yhat_upper_80 yhat_lower_95 yhat_upper_95', 6)}) FROM snapped",
    "vintage_merge": f"SELECT * REPLACE ({_r('yhat yhat_lower_80 yhat_upper_80 yhat_lower_95 yhat_upper_95', 6)}) FROM (SELECT * FROM forecasts WHERE model != 'lasso' UNION SELECT * FROM forecasts WHERE model != 'arima')",
    "dim_date": "SELECT * FROM ddate",
    "dim_metric": "SELECT m.*, (SELECT count(*) FROM facts f WHERE f.line_item = m.line_item) AS n_facts FROM dmetric m",
    "dim_filing": "SELECT * FROM dfiling",
    "star_join_tooltip": "SELECT f.ticker, f.line_item, f.period_end, round(f.value, 4) AS value, f.accession_no, m.label, m.category, m.unit, d.calendar_year, d.calendar_quarter, g.filing_url, g.filed_date, g.form_type FROM fin f LEFT JOIN dmetric m ON m.line_item = f.line_item LEFT JOIN ddate d ON d.ticker = f.ticker AND d.period_end = f.period_end LEFT JOIN dfiling g ON g.accession_no = f.accession_no",
    "hist_financials_wide": """SELECT p.*, r.fact_id AS revenue_fact_id, r.accession_no, r.filing_url, CASE WHEN lower(r.concept_used) LIKE '%derived%' THEN 'derived' WHEN r.ticker IS NOT NULL THEN 'reported' END AS revenue_provenance FROM (
  SELECT * FROM (SELECT ticker, period_end, fiscal_year, fiscal_period, period_type, """
    + ", ".join(f"round(arg_min(value, fact_id) FILTER (WHERE line_item = '{i}'), 4) AS {i}" for i in ("Revenue", "GrossProfit", "OperatingIncome", "NetIncome"))
    + """ FROM fin WHERE period_type = 'Q' AND line_item IN ('Revenue', 'GrossProfit', 'OperatingIncome', 'NetIncome') GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY period_end DESC, fiscal_year DESC, fiscal_period DESC) <= 12) p
  LEFT JOIN (SELECT * FROM fin WHERE period_type = 'Q' AND line_item = 'Revenue' QUALIFY row_number() OVER (PARTITION BY ticker, period_end ORDER BY fact_id) = 1) r ON r.ticker = p.ticker AND r.period_end = p.period_end""",
    "sources_unpivot": _sources(),
    "null_accessions": f"SELECT ticker, count(*) AS n_sources, count(*) FILTER (WHERE accession_no IS NULL) AS n_null_accessions FROM ({_sources()}) GROUP BY ticker",
    "missing_per_item": "SELECT ticker, line_item, count(*) AS missing_quarters FROM missing GROUP BY ALL",
    "duplicate_cash_flow_quarters": f"SELECT ticker, line_item, fiscal_year, substr(fiscal_period, 2, 1)::INT AS quarter, count(*) AS n_facts FROM ({_relabel('collapsed')}) WHERE line_item IN ({_list(vocab.CUMULATIVE_CASH_FLOW)}) AND period_type = 'Q' GROUP BY ALL HAVING count(*) > 1",
    "latest_provenance": "SELECT ticker, period_end, fiscal_year, fiscal_period, round(Revenue / 1e9, 3) AS revenue_billions, revenue_accession, revenue_filing_url FROM inc WHERE period_type = 'Q' AND Revenue IS NOT NULL QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY fiscal_year DESC, fiscal_period DESC, period_end DESC) <= 5",
    "working_capital_deltas": """SELECT ticker, slot, kind, item, round(coalesce(CASE WHEN item = 'AccountsPayable' THEN v - lag(v) OVER w ELSE lag(v) OVER w - v END, 0), 4) AS delta FROM (
  SELECT ticker, slot, kind, u.item AS item, coalesce(u.v, 0)::DOUBLE AS v FROM (
    SELECT ticker, slot::INT AS slot, 'historical' AS kind, AccountsReceivable AS ar, Inventory AS inv, AccountsPayable AS ap FROM hist UNION ALL SELECT ticker, step::INT, 'forecast', ar, inv, ap FROM proj WHERE step > 0 AND scenario = 'Base'),
  unnest([{'item': 'AccountsReceivable', 'v': ar}, {'item': 'Inventory', 'v': inv}, {'item': 'AccountsPayable', 'v': ap}]) t(u)) WINDOW w AS (PARTITION BY ticker, item ORDER BY kind DESC, slot)""",
    "markdown_metrics": f"""SELECT ticker, period_end, '| ' || ticker || ' | ' || period_end || ' | ' || coalesce(format('{{:,.2f}}', Revenue / 1e6), '') || ' | ' || coalesce(format('{{:,.2f}}', gm), '') || ' | ' || coalesce(format('{{:,.2f}}', g), '') || ' |' AS line
  FROM (SELECT ticker, period_end, Revenue, {_div('GrossProfit', 'Revenue')} AS gm, (Revenue - lag(Revenue, 4) OVER w) / nullif(lag(Revenue, 4) OVER w, 0) AS g FROM ({_quarterly('Revenue', 'GrossProfit', 'OperatingIncome', 'NetIncome')}) WINDOW w AS ({_BY}))""",
    "latest_12_quarters": "SELECT ticker, period_end, fiscal_year, fiscal_period, Revenue, (row_number() OVER (PARTITION BY ticker ORDER BY fiscal_year, fiscal_period, period_end))::INT AS slot FROM (SELECT * FROM inc WHERE period_type = 'Q' QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY fiscal_year DESC, fiscal_period DESC, period_end DESC) <= 12)",
    "ttm_kpis": f"SELECT * REPLACE ({_r('Revenue OperatingIncome OperatingCashFlow CapEx ttm_revenue ttm_operating_income ttm_ocf ttm_capex ttm_fcf')}, {_r('ttm_operating_margin ttm_fcf_margin', 6)}) FROM ttm",
    "dso_rolling": f"SELECT ticker, period_end, {_r('Revenue AccountsReceivable dso', 6)}, round(avg(dso) OVER ({_BY} ROWS BETWEEN 7 PRECEDING AND CURRENT ROW), 6) AS dso_rolling FROM (SELECT *, {_div('AccountsReceivable', 'Revenue')} * 91 AS dso FROM ({_quarterly('Revenue', 'AccountsReceivable')}))",
    "billings": f"SELECT ticker, period_end, round(Revenue, 4) AS Revenue, round(DeferredRevenue, 4) AS DeferredRevenue, round(dc, 4) AS deferred_change, round(Revenue + dc, 4) AS billings, round({_div('DeferredRevenue', 'Revenue')}, 6) AS cover_ratio FROM (SELECT *, DeferredRevenue - lag(DeferredRevenue) OVER ({_BY}) AS dc FROM ({_quarterly('Revenue', 'DeferredRevenue', 'RPO')}))",
    "margins": f"SELECT ticker, period_end, round(Revenue, 6) AS Revenue, round({_div('GrossProfit', 'Revenue')}, 6) AS gross_margin, round({_div('OperatingIncome', 'Revenue')}, 6) AS operating_margin, round({_div('NetIncome', 'Revenue')}, 6) AS net_margin, round((Revenue - lag(Revenue, 4) OVER w) / nullif(lag(Revenue, 4) OVER w, 0), 6) AS yoy_growth FROM ({_quarterly('Revenue', 'GrossProfit', 'OperatingIncome', 'NetIncome')}) WINDOW w AS ({_BY})",
    "rule_of_40": f"SELECT ticker, period_end, round(g, 6) AS growth, round(m, 6) AS fcf_margin, round(g + m, 6) AS score, g + m >= 0.4 AS passes, CASE WHEN g >= 0.2 THEN 'fast' ELSE 'slow' END || '-' || CASE WHEN m >= 0.2 THEN 'profitable' ELSE 'investing' END AS quadrant FROM (SELECT ticker, period_end, (ttm_revenue - lag(ttm_revenue, 4) OVER w) / nullif(lag(ttm_revenue, 4) OVER w, 0) AS g, ttm_fcf_margin AS m FROM ttm WINDOW w AS ({_BY})) WHERE g + m IS NOT NULL",
    "forecast_scorecard": f"SELECT * REPLACE ({_r('Revenue yhat variance')}, round(variance_pct, 6) AS variance_pct) FROM score",
    "forecast_overlay": f"WITH_a AS ({_quarterly('Revenue')})",
    "cv_error_summary": "SELECT model, round(avg(abs(variance)), 4) AS mae, round(avg(abs(variance) / CASE WHEN Revenue > 0 THEN Revenue END), 6) AS mape, count(*) AS n FROM score GROUP BY model",
    "history_frame": f"SELECT * REPLACE ({_r('Revenue CostOfRevenue GrossProfit OperatingExpenses OperatingIncome NetIncome Cash AccountsReceivable Inventory AccountsPayable DeferredRevenue TotalAssets TotalLiabilities TotalEquity OperatingCashFlow InvestingCashFlow FinancingCashFlow Depreciation StockBasedCompensation TreasuryStockRepurchases CapEx')}) FROM hist",
    "base_assumptions": f"SELECT * REPLACE ({_r('revenue_growth_qoq gross_margin_pct opex_growth_qoq capex_pct_of_revenue dso_days dpo_days dio_days tax_rate debt_amortization_qoq sbc_qtrly buybacks_qtrly opex_trailing revenue_last depreciation cash ar inventory ap deferred total_assets total_liabilities equity', 6)}) FROM assume",
    "scenario_forecast": f"SELECT ticker, scenario, step, {_r(_OUTPUTS).replace(', 4)', ', 4) + 0')} FROM ({_ALL}) WHERE step > 0",
    "statement_tables": f"""SELECT ticker, statement, line, item, slot, kind, label, round(value, 4) + 0 AS value FROM (
  SELECT ticker, slot, kind, label, u.s AS statement, u.l::INT AS line, u.i AS item, u.v::DOUBLE AS value, ticker IN (SELECT ticker FROM hist WHERE Inventory != 0) AS stocked FROM (
    SELECT ticker, slot, 'historical' AS kind, fiscal_period || '/FY' || fiscal_year AS label, Revenue, CostOfRevenue, GrossProfit, OperatingExpenses, OperatingIncome, NetIncome, Cash, AccountsReceivable, Inventory, TotalAssets, AccountsPayable, DeferredRevenue, TotalLiabilities, TotalEquity, Depreciation, StockBasedCompensation, OperatingCashFlow, CapEx, InvestingCashFlow, TreasuryStockRepurchases, FinancingCashFlow FROM hist
    UNION ALL SELECT ticker, step, 'forecast', 'Q' || step || '(F)', Revenue, CostOfRevenue, GrossProfit, OperatingExpenses, OperatingIncome, NetIncome, Cash, AccountsReceivable, Inventory, TotalAssets, AccountsPayable, DeferredRevenue, TotalLiabilities, TotalEquity, Depreciation, SBC, OCF, CapEx, InvestingCF, Buybacks, FinancingCF FROM ({_ALL}) WHERE step > 0 AND scenario = 'Base'),
  unnest([{_CELLS}]) t(u)) WHERE item != 'Inventory' OR stocked""",
    "balance_check": "SELECT ticker, scenario, round(max(abs(bc)), 4) AS max_abs_check, max(abs(bc)) <= 1e6 AS balanced FROM proj WHERE step > 0 GROUP BY ALL",
    "ocf_residual": """SELECT ticker, round(coalesce(max(gap), 0), 4) AS max_residual, coalesce(max(gap), 0) > 5e6 AS warn FROM (SELECT ticker, slot, max(slot) OVER (PARTITION BY ticker) AS n, CASE WHEN coalesce(OperatingCashFlow, 0) != 0 THEN abs(
  coalesce(NetIncome, 0) + coalesce(Depreciation, 0) + coalesce(StockBasedCompensation, 0) - (coalesce(AccountsReceivable, 0) - lag(coalesce(AccountsReceivable, 0)) OVER w) - (coalesce(Inventory, 0) - lag(coalesce(Inventory, 0)) OVER w)
  + (coalesce(AccountsPayable, 0) - lag(coalesce(AccountsPayable, 0)) OVER w) + (coalesce(DeferredRevenue, 0) - lag(coalesce(DeferredRevenue, 0)) OVER w) - OperatingCashFlow) END AS gap FROM hist WINDOW w AS (PARTITION BY ticker ORDER BY slot)) WHERE n - slot < 4 AND slot > 1 GROUP BY ticker""",
    "debt_schedule": "SELECT ticker, step::INT AS step, 0.0::DOUBLE AS opening, debt_amortization_qoq AS amortization, greatest(0.0, 0 - debt_amortization_qoq)::DOUBLE AS closing FROM assume CROSS JOIN range(1, 5) r(step)",
    "summary_kpis": """SELECT ticker, slot, kind, u.item AS item, round(u.value, 4) AS value FROM (SELECT ticker, slot::INT AS slot, 'historical' AS kind, Revenue AS r, GrossProfit AS g, NetIncome AS i FROM hist UNION ALL SELECT ticker, step::INT, 'forecast', rev, gp, ni FROM proj WHERE step > 0 AND scenario = 'Base'),
  unnest([{'item': 'Revenue', 'value': r}, {'item': 'GrossMarginPct', 'value': g / nullif(r, 0)}, {'item': 'NetIncome', 'value': i}, {'item': 'NetMarginPct', 'value': i / nullif(r, 0)}]) t(u)""",
    "feature_matrix": f"""SELECT ticker, period_end, fiscal_year, fiscal_period, round(y, 6) AS y, round(lag1, 6) AS lag1, round(lag4, 6) AS lag4, round((lag1 - lag5) / nullif(lag5, 0), 6) AS growth4, trend, (fiscal_period = 'Q2')::INT::DOUBLE AS is_q2, (fiscal_period = 'Q3')::INT::DOUBLE AS is_q3, (fiscal_period = 'Q4')::INT::DOUBLE AS is_q4,
  round(VIXCLS, 6) AS VIXCLS, round(INDPRO, 6) AS INDPRO, round(T10Y2Y, 6) AS T10Y2Y, round(etf_return, 6) AS etf_return FROM (
  SELECT ticker, period_end, fiscal_year, fiscal_period, y, lag(y) OVER w AS lag1, lag(y, 4) OVER w AS lag4, lag(y, 5) OVER w AS lag5, (row_number() OVER w - 1)::DOUBLE AS trend, {_FILLED} FROM (
    SELECT s.*, m.*, {_CLOSE.format(at="s.period_end::DATE")} / nullif({_CLOSE.format(at="(s.period_end::DATE - INTERVAL 3 MONTH)::DATE")}, 0) - 1 AS etf_return FROM series s LEFT JOIN (
      SELECT pe, {", ".join(f"avg(value / 1e4) FILTER ({c}) AS {n}" for n, c in (("VIXCLS", "k % 3 = 0"), ("INDPRO", "k % 3 = 1 AND dayofweek(date) = 1"), ("T10Y2Y", "k % 3 = 2 AND day(date) = 1")))}
      FROM (SELECT DISTINCT period_end AS pe FROM series) LEFT JOIN ord ON date BETWEEN (pe::DATE - INTERVAL 3 MONTH)::DATE AND pe::DATE GROUP BY pe) m ON m.pe = s.period_end) WINDOW w AS ({_BY}))
  WHERE y IS NOT NULL AND lag4 IS NOT NULL AND lag5 IS NOT NULL AND lag5 != 0 AND VIXCLS IS NOT NULL AND INDPRO IS NOT NULL AND T10Y2Y IS NOT NULL AND etf_return IS NOT NULL""",
    "cv_folds": "SELECT DISTINCT ticker, (low + (high - low) * k // 2)::INT AS cut FROM (SELECT ticker, greatest(8, count(*) * 2 // 3) AS low, count(*) - 4 AS high FROM series WHERE y IS NOT NULL GROUP BY ticker) CROSS JOIN range(3) r(k) WHERE high >= low",
    "bootstrap_percentiles": "SELECT o_orderpriority, " + ", ".join(f"round(quantile_cont(o_totalprice, {p}), 4) AS {n}" for p, n in ((0.025, "p025"), (0.1, "p100"), (0.9, "p900"), (0.975, "p975"))) + " FROM orders GROUP BY o_orderpriority",
    "asof_price_return": f"""SELECT symbol, start, "end", round(ce, 6) AS close_end, round(cs, 6) AS close_start, round(ce / nullif(cs, 0) - 1, 6) AS "return" FROM (
  SELECT p.*, (SELECT max(v) FROM px WHERE px.symbol = p.symbol AND px.date = (SELECT max(date) FROM px x WHERE x.symbol = p.symbol AND x.date <= p."end")) AS ce, (SELECT max(v) FROM px WHERE px.symbol = p.symbol AND px.date = (SELECT max(date) FROM px x WHERE x.symbol = p.symbol AND x.date <= p.start)) AS cs
  FROM ({_PERIODS}) p)""",
    "quarterly_range_avg": f'SELECT p.symbol, p.start, p."end", round(avg(o.v), 4) AS mean FROM ({_PERIODS}) p LEFT JOIN ({_ORDERS}) o ON o.symbol = p.symbol AND o.date BETWEEN p.start AND p."end" GROUP BY ALL',
    "fill_gaps": "SELECT event_id, user_id, coalesce(last_value(v IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(v IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN value END AS v FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)",
    "concept_selection": "SELECT * FROM choice WHERE choice = 1",
    "concept_switch_audit": "SELECT * FROM choice WHERE choice > 1 AND n_facts > 2",
    "fact_id_hash": "SELECT o_orderkey, left(sha256(concat_ws('|', o_custkey, o_orderpriority, o_orderdate::DATE::VARCHAR, o_orderstatus, o_orderkey)), 16) AS fact_id, lpad(o_custkey::VARCHAR, 10, '0') AS cik FROM orders",
    "years_filter": "SELECT ticker, fiscal_year, fact_id FROM (SELECT *, max(fiscal_year) OVER (PARTITION BY ticker) AS m FROM facts) WHERE fiscal_year >= m - 1",
    "fiscal_calendar_map": f"""SELECT day, fe, last_day(date_trunc('month', day) + to_months(((fe - month(day)) % 3 + 3) % 3))::DATE AS snapped, fy AS fiscal_year, fp AS fiscal_period, year(qe)::INT AS calendar_year, quarter(qe)::INT AS calendar_quarter FROM (
  SELECT *, {_FY.format(d="day", fe="fe")} AS fy, {_FP.format(d="day", fe="fe")} AS fp, last_day(date_trunc('month', day) + to_months(((fe - month(day)) % 3 + 3) % 3)) AS qe FROM (SELECT DISTINCT o_orderdate::DATE AS day FROM orders) CROSS JOIN (SELECT fe::INT AS fe FROM range(1, 13) r(fe)))""",
    "driver_classification": """SELECT ticker, round(rev, 4) AS rev, round(rp, 4) AS rev_prior, round(md, 4) AS margin_delta, round(mp, 4) AS margin_prior, round(vol, 4) AS volume_effect, round(mar, 4) AS margin_effect,
  CASE WHEN ticker = 'S1' AND 1e4 > 0.3 * greatest(abs(rev - rp), 1) THEN 'one-time' WHEN vol > 0 AND mar > 0 AND greatest(vol, mar) / nullif(least(vol, mar), 0) < 2 THEN 'mix' WHEN vol >= mar THEN 'volume' ELSE 'margin' END AS driver FROM (
  SELECT ticker, revenue_actual AS rev, revenue_yoy AS rp, gross_margin_pct_yoy_delta AS md, gross_margin_pct_yoy AS mp, abs((revenue_actual - revenue_yoy) * gross_margin_pct_yoy) AS vol, abs(gross_margin_pct_yoy_delta * revenue_actual) AS mar FROM variance)""",
    "numeric_token_audit": r"""SELECT doc_id, len(regexp_extract_all(t, '-?\$\d+(?:\.\d+)?(?:[KMB])?'))::INT AS n_dollars, len(regexp_extract_all(t, '-?\d+(?:\.\d+)?%'))::INT AS n_percents,
  len(regexp_extract_all(t, '\b\d{1,3}(?:,\d{3})+(?:\.\d+)?\b|\b\d+\.\d+\b|\b[1-9]\d{3,}\b'))::INT AS n_bare, ("""
    + " + ".join(f"contains(lower(t), '{w}')::INT" for w in ("billion", "million", "thousand", "bps", "basis point", "percentage point", "pct point", "pp "))
    + ")::INT AS n_forbidden FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)",
    "json_props": "SELECT event_id, key, number FROM (SELECT event_id, unnest(json_keys(props)) AS key, unnest(json_extract(props, '$.*'))::BIGINT AS number FROM events)",
    "companyfacts_ingest": """SELECT ticker, 'Revenue' AS line_item, concept_used, period_end, fiscal_year, fiscal_period, value, accession_no, left(sha256(concat_ws('|', ticker, concept_used, period_end, fiscal_period, accession_no)), 16) AS fact_id FROM (
  SELECT *, max(fiscal_year) OVER (PARTITION BY ticker) AS latest FROM (
  SELECT 'C' || o_custkey AS ticker, CASE WHEN o_orderkey % 3 = 0 THEN 'Revenues' ELSE 'SalesRevenueNet' END AS concept_used, last_day(o_orderdate)::DATE::VARCHAR AS period_end, year(o_orderdate)::INT AS fiscal_year, 'Q' || quarter(o_orderdate) AS fiscal_period, o_totalprice AS value,
    lpad(o_custkey::VARCHAR, 10, '0') || '-' || strftime(o_orderdate, '%y') || '-' || lpad((o_orderkey % 1000000)::VARCHAR, 6, '0') AS accession_no,
    sum(CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey) AS first_n, sum(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1 END) OVER (PARTITION BY o_custkey) AS second_n FROM orders)
  WHERE concept_used = CASE WHEN first_n >= second_n THEN 'Revenues' ELSE 'SalesRevenueNet' END) WHERE fiscal_year >= latest - 2""",
    "facts_per_item": "SELECT line_item, count(*) AS n FROM facts GROUP BY ALL",
    "event_windows": "SELECT ts::DATE AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    "amount_formats": f"SELECT c_custkey, d AS dollars, round(CASE WHEN d LIKE '-%' THEN -1 ELSE 1 END * regexp_extract(d, '[0-9.]+')::DOUBLE * CASE right(d, 1) WHEN 'K' THEN 1e3 WHEN 'M' THEN 1e6 WHEN 'B' THEN 1e9 ELSE 1 END, 4) AS parsed, printf('%.1f', c_acctbal / 1e4 * 100) || '%' AS percent, lower(trim(c_mktsegment)) IN ('true', '1', 'yes', 'y', 't') AS truthy FROM (SELECT *, {_FMT} AS d FROM (SELECT *, c_acctbal * 1000 AS x FROM customer))",
}
_BODIES["forecast_overlay"] = f"""SELECT ticker, period_end, 'actual' AS series, round(Revenue, 4) AS value FROM ({_quarterly('Revenue')}) WHERE Revenue IS NOT NULL
UNION ALL SELECT ticker, period_end, model, round(yhat, 4) FROM (SELECT s.*, dense_rank() OVER (PARTITION BY s.ticker, model ORDER BY s.period_end) AS kk FROM snapped s
  JOIN (SELECT ticker, max(period_end) AS last FROM ({_quarterly('Revenue')}) WHERE Revenue IS NOT NULL GROUP BY ticker) l ON l.ticker = s.ticker WHERE s.period_end > l.last) WHERE kk <= 4"""
CTES_MORE = {
    "ord": "SELECT o_custkey AS k, o_orderdate::DATE AS date, o_totalprice AS value FROM orders",
    "fx": "SELECT 'E' || (k % 4) AS symbol, date, max(value) AS v FROM ord GROUP BY ALL",
    "m1": f"SELECT ticker, period_end, y, row_number() OVER (w) AS k, count(*) OVER (PARTITION BY ticker) AS n FROM series WHERE y IS NOT NULL WINDOW w AS ({_BY})",
    "m2": f"""SELECT *, coalesce(regr_slope(y, k) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS slope, [lead(y) OVER w, lead(y, 2) OVER w, lead(y, 3) OVER w, lead(y, 4) OVER w] AS ahead, [lag(y, 3) OVER w, lag(y, 2) OVER w, lag(y) OVER w, y] AS tail,
  CASE WHEN k >= 8 AND sum(y) OVER (w ROWS BETWEEN 7 PRECEDING AND 4 PRECEDING) > 0 THEN sum(y) OVER (w ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) / sum(y) OVER (w ROWS BETWEEN 7 PRECEDING AND 4 PRECEDING) ELSE 1 END AS rate FROM m1 WINDOW w AS ({_BY})""",
    "m3": "SELECT ticker, period_end, k, n, ahead, u.m AS model, u.p AS made FROM m2, unnest([{'m': 'seasonal', 'p': list_transform(tail, lambda t: t * rate)}, {'m': 'trend', 'p': [y + slope * 0.9, y + slope * 1.71, y + slope * 2.439, y + slope * 3.0951]}]) t(u) WHERE k >= 4",
    "px": "SELECT o_custkey % 5 AS symbol, o_orderdate::DATE AS date, max(o_totalprice) AS v FROM orders GROUP BY ALL",
    "choice": "SELECT *, (row_number() OVER (PARTITION BY ticker, line_item ORDER BY n_facts DESC, synonym_rank))::INT AS choice FROM (SELECT ticker, line_item, concept_used, CASE WHEN concept_used LIKE '%Alt' THEN 1 ELSE 0 END AS synonym_rank, count(*) FILTER (WHERE fiscal_period != 'FY') AS n_facts FROM facts GROUP BY ALL) WHERE n_facts > 0",
}
_PREFIX = _PREFIX.rstrip() + ",\n" + ",\n".join(f"{k} AS ({v})" for k, v in CTES_MORE.items()) + "\n"



def _json(value: str) -> str:
    return f"coalesce('\"' || {value} || '\"', 'null')"


def _money(x: str) -> str:
    return "(" + _FMT.replace("WHEN x IS", f"WHEN {x} IS").replace("abs(x)", f"abs({x})").replace("WHEN x <", f"WHEN {x} <") + ")"


def _percent(x: str) -> str:
    return f"(printf('%.1f', {x} * 100) || '%')"


def _source(column: str) -> str:
    held = column in ("revenue_actual_fact_id", "gross_profit_fact_id", "op_income_fact_id", "revenue_prior_forecast_model")
    named = f"CASE WHEN trim({column}) != '' THEN {column} ELSE '<missing>' END" if held else "'<missing>'"
    return f"'forecast_model=' || {named}" if column == "revenue_prior_forecast_model" else named


def _payload() -> str:
    parts = ["'{\"ticker\":' || " + _json("v.ticker"), "',\"fiscal_year\":' || coalesce(fiscal_year, 0)", "',\"fiscal_period\":' || " + _json("coalesce(fiscal_period, '')"), "',\"latest_period_end\":' || " + _json("left(coalesce(latest_period_end, ''), 10)")]
    for key, column, form in guard.ENTRIES:
        said = _json((_money if form is guard.dollars else _percent)(column))
        more = "".join(f" || coalesce(',\"{k}\":\"' || nullif({c}, '') || '\"', '')" for k, c in (("fact_id", "revenue_actual_fact_id"), ("accession", "revenue_actual_accession"), ("filing_url", "revenue_actual_filing_url"))) if key == "revenue" else ""
        parts.append(f"',\"{key}\":{{\"value\":' || {said}{more} || '}}'")
    for key, formula, sources in guard.PROVENANCE:
        parts.append(f"',\"{key}\":\"derived: {formula}. Sources: ' || " + " || ', ' || ".join(map(_source, sources)) + " || '\"'")
    parts.append("',\"revenue_prior_forecast_model\":\"' || coalesce(nullif(revenue_prior_forecast_model, ''), 'N/A') || '\"'")
    parts.append(f"',\"billings_provenance\":\"{guard.BILLINGS}\"'")
    parts += [f"',\"{c}\":' || coalesce({c}, false)::VARCHAR" for c in ("has_restatement", "has_physical_inventory")]
    return "SELECT v.ticker, " + " || ".join(parts) + " || '}' AS payload FROM variance v LEFT JOIN (SELECT ticker, has_restatement, has_physical_inventory FROM quality) q ON q.ticker = v.ticker"


_SAID = "(CASE WHEN s LIKE '-%' THEN -1.0 ELSE 1.0 END * regexp_extract(s, '[0-9.]+')::DOUBLE * CASE right(s, 1) WHEN 'K' THEN 1e3 WHEN 'M' THEN 1e6 WHEN 'B' THEN 1e9 ELSE 1.0 END)"
_ALLOWED = (
    "SELECT ticker, list_sort(list_distinct(list_filter([" + ", ".join((_SAID.replace("s LIKE", f"{_money(c)} LIKE").replace("(s,", f"({_money(c)},") if f is guard.dollars else f"(printf('%.1f', {c} * 100)::DOUBLE / 100)") for _, c, f in guard.ENTRIES)
    + "], lambda x: x IS NOT NULL))) AS vals, list_filter([revenue_actual_accession], lambda x: x IS NOT NULL) AS accs FROM variance"
)
_D, _P = r"-?\$\d+(?:\.\d+)?[KMB]?", r"-?\d+(?:\.\d+)?%"
_B, _Y = r"\b\d{1,3}(?:,\d{3})+(?:\.\d+)?\b|\b\d+\.\d+\b|\b[1-9]\d{3,}\b", r"\b(?:19|20)\d{2}\b"
_A = r"\d{10}-\d{2}-\d{6}"
_SENTENCES = {
    "cited": "'Revenue was ' || m || c || ' in 2024.'", "twice": "m || ' and ' || m || c", "uncited": "'Revenue was ' || m || '.'", "late": "m || repeat(' ', 45) || c", "unknown": "'Revenue was $98765.4B' || c",
    "foreign": "'Revenue was ' || m || ' [0000000000-00-000000].'", "share": "'A margin of ' || p || ' in 1999.'", "shares": "'A margin of ' || p || ' after 987.6%.'", "word": "m || c || ', a Billion'",
    "negative": "'It fell (3.2 %).'", "bare": "'In 2024, 1,234 units at ' || m || c", "decimal": "'Some 12.50 of 2024'", "partly": "m || ',000' || c",
}
_NEAR = "len(list_filter(vals, lambda r: abs(x - r) <= greatest(0.01, 0.005 * abs(x), 0.005 * abs(r)))) = 0"
_TOKENS = " UNION ALL ".join(f"SELECT id, '{k}' AS kind, string_split(regexp_replace(t, '({p})', chr(1) || '\\1' || chr(1), 'g'), chr(1)) AS parts FROM g" for k, p in (("bare", _B), ("dollar", _D), ("percent", _P), ("year", _Y)))
_BODIES["payloads"] = _payload()
_BODIES["payload_inputs"] = f"SELECT ticker, array_to_string(list_transform(list_sort(list_distinct(list_append(vals, 7.5e6))), lambda x: format('{{:,.4f}}', x)), ' ') AS amounts, array_to_string(accs, ' ') AS accessions FROM ({_ALLOWED})"
_BODIES["guarded_texts"] = rf"""SELECT ticker, name, msg AS violation FROM g LEFT JOIN (SELECT id, arg_min(msg, rank * 1000000 + pos) AS msg FROM (
    {" UNION ALL ".join(f"SELECT id, 1 AS rank, {k} AS pos, 'forbidden word: {w}' AS msg FROM g WHERE contains(lower(t), '{w}')" for k, w in enumerate(guard.FORBIDDEN))}
    UNION ALL SELECT id, 2, 0, 'negative in parentheses' FROM g WHERE regexp_matches(t, '\$\(\s*\d') OR regexp_matches(t, '\(\s*-?\d+(?:\.\d+)?\s*%\s*\)')
    UNION ALL SELECT id, 3, k, CASE WHEN {_NEAR} THEN 'unknown amount: ' || s WHEN c = '' THEN 'no citation: ' || s ELSE 'unknown citation: ' || bad END FROM (
      SELECT *, {_SAID} AS x, list_filter(regexp_extract_all(c, '{_A}'), lambda a: NOT list_contains(accs, a))[1] AS bad FROM (
      SELECT id, k, s, vals, accs, regexp_extract(left(after, 50), '\[({_A}(?:,\s*{_A})*)\]', 1) AS c FROM (
      SELECT id, k, vals, accs, parts[k] AS s, array_to_string(parts[k + 1:], '') AS after FROM (SELECT id, vals, accs, string_split(regexp_replace(t, '({_D})', chr(1) || '\1' || chr(1), 'g'), chr(1)) AS parts FROM g), LATERAL (SELECT unnest(range(2, len(parts) + 1, 2)) AS k))))
      WHERE {_NEAR} OR c = '' OR bad IS NOT NULL
    UNION ALL SELECT id, 4, k, 'unknown per cent: ' || s FROM (SELECT id, vals, k, parts[k] AS s, rtrim(parts[k], '%')::DOUBLE / 100 AS x FROM (SELECT id, vals, regexp_extract_all(t, '{_P}') AS parts FROM g), LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS k)) WHERE {_NEAR}
    UNION ALL SELECT b.id, 5, b.start, 'bare number: ' || b.tok FROM tok b WHERE b.kind = 'bare' AND NOT EXISTS (SELECT 1 FROM tok s WHERE s.id = b.id AND s.kind != 'bare' AND s.start <= b.start AND s.stop >= b.stop)
  ) GROUP BY id) USING (id)"""
_GUARDED = f"""sv AS (SELECT ticker, {_money('revenue_actual')} AS m, ' [' || revenue_actual_accession || ']' AS c, {_percent('gross_margin_pct_actual')} AS p FROM variance),
  g AS (SELECT row_number() OVER () AS id, ticker, name, coalesce(text, '') AS t, coalesce(vals, []) AS vals, coalesce(accs, []) AS accs FROM (
    {" UNION ALL ".join(f"SELECT ticker, '{k}' AS name, {v} AS text FROM sv" for k, v in _SENTENCES.items())}
    UNION ALL SELECT 'S' || (doc_id % 8), doc_id::VARCHAR, text FROM documents) LEFT JOIN ({_ALLOWED}) USING (ticker)),
  tok AS (SELECT id, kind, tok, stop - length(tok) AS start, stop FROM (SELECT id, kind, k, parts[k] AS tok, sum(length(parts[k])) OVER (PARTITION BY id, kind ORDER BY k) AS stop FROM ({_TOKENS}), LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS k)) WHERE k % 2 = 0)
"""

_BODIES |= {
    "model_forecast": """SELECT ticker, model, last_day(pe::DATE + to_months(3 * i::INT))::DATE::VARCHAR AS period_end, round(made[i], 0) AS yhat, round(made[i] - 1.2816 * s * sqrt(i), 0) AS yhat_lower_80, round(made[i] + 1.2816 * s * sqrt(i), 0) AS yhat_upper_80,
  round(made[i] - 1.96 * s * sqrt(i), 0) AS yhat_lower_95, round(made[i] + 1.96 * s * sqrt(i), 0) AS yhat_upper_95 FROM (
  SELECT ticker, model, arg_max(period_end, k) AS pe, arg_max(made, k) AS made, coalesce(stddev_pop(ahead[1] - made[1]) FILTER (k >= greatest(4, n - 8) AND k < n), 0) AS s FROM m3 GROUP BY ticker, model) CROSS JOIN range(1, 5) r(i)""",
    "model_cross_validation": """SELECT model, round(avg(mae), 0) AS mae_mean, round(stddev_samp(mae), 0) AS mae_std, round(avg(mape), 6) AS mape_mean, round(stddev_samp(mape), 6) AS mape_std FROM (
  SELECT model, list_avg(list_transform(range(1, 5), lambda i: abs(ahead[i] - made[i]))) AS mae, list_avg(list_transform(list_filter(range(1, 5), lambda i: ahead[i] > 0), lambda i: abs(ahead[i] - made[i]) / ahead[i])) AS mape
  FROM m3 JOIN (SELECT DISTINCT ticker, (low + (high - low) * j // 2)::INT AS cut FROM (SELECT ticker, greatest(8, count(*) * 2 // 3) AS low, count(*) - 4 AS high FROM m1 GROUP BY ticker) CROSS JOIN range(3) r(j) WHERE high >= low) c ON c.ticker = m3.ticker AND c.cut = m3.k) GROUP BY model""",
    "recursive_forecast": f"""SELECT ticker, s.step::INT AS step, round(s.v, -3) AS yhat FROM (
  SELECT ticker, unnest([{{'step': 1, 'v': f1}}, {{'step': 2, 'v': f2}}, {{'step': 3, 'v': f3}}, {{'step': 4, 'v': f4}}]) AS s FROM (
  SELECT *, greatest(c0 * f3 + c1 * y4 + c2, 0.5 * f3) AS f4 FROM (SELECT *, greatest(c0 * f2 + c1 * y3 + c2, 0.5 * f2) AS f3 FROM (
  SELECT *, greatest(c0 * f1 + c1 * y2 + c2, 0.5 * f1) AS f2 FROM (SELECT *, greatest(c0 * y4 + c1 * y1 + c2, 0.5 * y4) AS f1 FROM (
  SELECT ticker, l[-4] AS y1, l[-3] AS y2, l[-2] AS y3, l[-1] AS y4,
    (t0 * (p * q - h * h) - g0 * (t1 * q - h * t2) + g1 * (t1 * h - p * t2)) / det AS c0, (o * (t1 * q - h * t2) - t0 * (g0 * q - h * g1) + g1 * (g0 * t2 - t1 * g1)) / det AS c1,
    (o * (p * t2 - t1 * h) - g0 * (g0 * t2 - t1 * g1) + t0 * (g0 * h - p * g1)) / det AS c2 FROM (
  SELECT *, o * (p * q - h * h) - g0 * (g0 * q - h * g1) + g1 * (g0 * h - p * g1) AS det FROM (
  SELECT ticker, l, aa + e AS o, bb + e AS p, n4 + e AS q, ab AS g0, a1 AS g1, b1 AS h, t0, t1, t2 FROM (SELECT *, 1e-6 * (aa + bb + n4) / 3 AS e FROM (
  SELECT ticker, count(*) AS n, list(y ORDER BY period_end) AS l, sum(a * a) FILTER (b IS NOT NULL) AS aa, sum(b * b) AS bb, sum(a * b) AS ab, sum(a) FILTER (b IS NOT NULL) AS a1, sum(b) AS b1, count(b)::DOUBLE AS n4,
    sum(a * y) FILTER (b IS NOT NULL) AS t0, sum(b * y) AS t1, sum(y) FILTER (b IS NOT NULL) AS t2 FROM (
  SELECT *, lag(y) OVER w AS a, lag(y, 4) OVER w AS b FROM series WHERE y IS NOT NULL WINDOW w AS ({_BY})) GROUP BY ticker) WHERE n >= 8)))))))))""",
    "calendar_shift": """SELECT day, (day - INTERVAL 3 MONTH)::DATE AS before, (day + INTERVAL 6 MONTH)::DATE AS ahead, quarter(day)::INT AS quarter, (s + to_months(3 * k::INT))::DATE AS period_start FROM (
  SELECT day, CASE WHEN date_trunc('quarter', f) < f THEN date_trunc('quarter', f) + INTERVAL 3 MONTH ELSE date_trunc('quarter', f) END AS s FROM (SELECT DISTINCT o_orderdate::DATE AS day, (o_orderdate::DATE + INTERVAL 3 MONTH) AS f FROM orders WHERE o_orderdate IS NOT NULL)) CROSS JOIN range(3) r(k)""",
    "prompt_bodies": "SELECT doc_id, md5(ltrim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS body_md5, CASE WHEN doc_id % 3 = 1 AND trim(source) != '' THEN source ELSE '<missing>' END AS source, 'Q' || (doc_id % 4 + 1) || '/FY' || (doc_id % 30 + 2000) AS label FROM documents",
    "latest_models": """SELECT f AS family, (SELECT arg_max(id, v) FROM (SELECT DISTINCT id, list_transform(regexp_extract_all(id, '\\d+'), lambda x: x::INT) AS v FROM (SELECT concat_ws('-', 'm', o_orderkey % 13, 'x', o_custkey % 120) AS id FROM orders)) WHERE contains(id, f)) AS id FROM (VALUES ('m-1-'), ('m-12-'), ('x-7'), ('m-99-')) t(f)""",
    "submission_lookup": "SELECT o_custkey, arg_min(o_orderkey::VARCHAR, o_orderkey) FILTER (o_orderpriority = '1-URGENT') AS first_urgent, arg_min('d' || o_orderkey, o_orderkey) FILTER (o_orderpriority = '1-URGENT' AND o_orderkey % 5 = 3) AS urgent_with_item FROM orders GROUP BY o_custkey",
    "resolved_companies": "SELECT c_custkey, CASE WHEN c_custkey % 10 < 8 THEN lpad((c_custkey % 10 + 1)::VARCHAR, 10, '0') END AS cik, CASE WHEN c_custkey % 10 < 8 THEN ((c_custkey % 10 % 4) * 3 + 3)::INT END AS fy_end_month FROM customer",
    "sniffed_payloads": "SELECT event_id, CASE WHEN event_id % 3 < 2 THEN props::VARCHAR END AS payload FROM events",
    "facts_round_trip": "SELECT ticker, line_item, count(*) AS n, round(sum(value::DECIMAL(28, 4)), 2)::DOUBLE AS total FROM facts GROUP BY ALL",
    "forecast_files": "SELECT ticker, model, period_end, round(yhat, 6) AS yhat, CASE WHEN model = 'arima' THEN ticker END AS note, CASE WHEN model = 'arima' THEN '2024-03-01' ELSE '2024-02-01' END AS forecast_run_date FROM forecasts WHERE model IN ('arima', 'lasso')",
    "vintage_log": "SELECT model, forecast_run_date, count(*) AS n, sum(floor(yhat)::BIGINT)::BIGINT AS whole_yhat, (SELECT count(*) FROM (SELECT DISTINCT * FROM forecasts WHERE model != 'lasso')) AS added_0, (SELECT count(*) FROM (SELECT DISTINCT * FROM forecasts WHERE model = 'lasso')) AS added_1, 0::BIGINT AS added_2 FROM (SELECT DISTINCT * FROM forecasts) GROUP BY ALL",
    "persisted_statements": "SELECT *, (sum(n) OVER (PARTITION BY name))::BIGINT AS counted FROM (SELECT name, ticker, count(*) AS n FROM (SELECT 'income' AS name, ticker FROM inc UNION ALL SELECT 'balance', ticker FROM bs UNION ALL SELECT 'cash', ticker FROM cf) GROUP BY ALL)",
    "csv_round_trip": f"SELECT ticker, model, period_end, {_r('yhat yhat_lower_80 yhat_upper_80 yhat_lower_95 yhat_upper_95', 6)}, forecast_run_date FROM forecasts",
    "extract_columns": "SELECT ticker, line_item, period_end::DATE AS period_end, fiscal_year, fiscal_period, CASE WHEN fiscal_period != 'Q3' THEN round(coalesce(value, 0), 4) ELSE 0 END AS value, accession_no, CASE WHEN fiscal_period != 'Q2' THEN filing_url ELSE '' END AS filing_url FROM fin",
    "weighted_items": "SELECT ticker, line_item AS feature, round(sum(CASE WHEN fiscal_period = 'Q1' THEN value::DECIMAL(28, 4) ELSE 0 END)::DOUBLE, 4) AS coefficient FROM canonical GROUP BY ALL HAVING sum(CASE WHEN fiscal_period = 'Q1' THEN value::DECIMAL(28, 4) ELSE 0 END) != 0",
    "cv_summary": "SELECT model, round(avg(abs(variance)), 4) AS mae_mean, round(stddev_samp(abs(variance)), 4) AS mae_std, round(avg(abs(variance_pct)), 6) AS mape_mean, round(stddev_samp(abs(variance_pct)), 6) AS mape_std FROM score GROUP BY model",
}
SQL = {name: _PREFIX + body for name, body in _BODIES.items()}
SQL["guarded_texts"] = _PREFIX.rstrip() + ",\n" + _GUARDED + _BODIES["guarded_texts"]
