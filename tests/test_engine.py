"""Operators of the facts engine on small rows made here."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyforge.functions import fiscal, text
from tallyforge.functions.vocab import FACT_COLUMNS, FACT_DDL, METRICS
from tallyforge.operators import audit_cli, dedupe, guard, modelling, quality, scenario, star, statements, timeseries, variance
from tallyforge.sources import adapter, companyfacts, readers, sinks

ENDS = {"Q1": "2024-01-31", "Q2": "2024-04-30", "Q3": "2024-07-31", "Q4": "2024-10-31"}


def fact(item, fp="Q1", value=100.0, form="10-Q", filed="2024-06-01", frame="", fy=2024, ticker="T", end=None, concept=None, accn=None):
    end = end or ENDS.get(fp, "2024-10-31")
    accn = accn or f"0000000001-24-{abs(hash((form, filed, fp))) % 10**6:06d}"
    own = dict(
        ticker=ticker, line_item=item, concept_used=concept or item, period_end=end, period_type="FY" if fp == "FY" else "Q", fiscal_year=fy, fiscal_period=fp, value=value, unit="USD",
        accession_no=accn, fact_id=f"{ticker}{item}{end}{fp}{form}{filed}{frame}", filing_url="u", form_type=form, filed_date=filed, frame=frame,
    )
    return tuple(own[c] for c in FACT_COLUMNS)


@pytest.fixture
def make(spark):
    return lambda *rows: spark.createDataFrame(list(rows), FACT_DDL)


@pytest.fixture
def companies(spark):
    return spark.createDataFrame([("T", 10)], "ticker string, fy_end_month int")


def test_canonical_prefers_amendments_then_latest_and_is_unique(make):
    rows = dedupe.canonical(make(fact("Revenue", value=1.0), fact("Revenue", value=2.0, form="10-Q/A"), fact("Revenue", value=3.0, filed="2024-09-01"), fact("Revenue", value=4.0, frame="CY2024Q1"))).collect()
    assert sorted(r.value for r in rows) == [2.0, 4.0]


def test_restatement_needs_material_difference_and_base_form(make):
    facts = make(
        fact("Revenue", "FY", 1.0e9, "10-K", "2024-11-01"), fact("Revenue", "FY", 1.05e9, "10-K/A", "2024-12-01"), fact("Cash", "Q1", 5.0, "10-Q", "2024-02-01"), fact("Cash", "Q1", 5.001, "10-Q/A", "2024-03-01"),
        fact("Inventory", "Q1", 5.0, "10-Q", "2024-02-01"), fact("Inventory", "Q1", 9e9, "10-K/A", "2024-03-01"),
    )
    rows = quality.restatements(facts).collect()
    assert [(r.line_item, r.amended_value, r.original_value) for r in rows] == [("Revenue", 1.05e9, 1.0e9)]


def test_missing_quarters_and_refusal(make, spark):
    rows = [fact(i, q) for i in ("Revenue", "OperatingIncome", "OperatingCashFlow", "NetIncome") for q in ENDS]
    full = make(*rows)
    gap = make(*(r for r in rows if not (r[1] == "Revenue" and r[6] == "Q2")))
    for facts, expected in ((full, None), (gap, "FY2024Q2")):
        q = quality.data_quality(facts)
        assert q.first().missing_quarters == expected
        v = spark.createDataFrame([("T", 2024, "Q4")], "ticker string, fiscal_year int, fiscal_period string")
        assert quality.refusals(q, v).first().refusal_reason == ("missing_quarters" if expected else None)


def test_bridge_reconciles_and_skips_incomplete_quarters(make):
    values = {"NetIncome": 100.0, "Depreciation": 50.0, "StockBasedCompensation": 80.0, "OperatingCashFlow": 300.0, "CapEx": 40.0}
    rows = statements.fcf_bridge(make(*(fact(i, value=v) for i, v in values.items()))).orderBy("component_order").collect()
    assert [r.value for r in rows] == [100, 50, 80, 70, 300, -40, 260] and rows[3].fact_id is None
    assert statements.fcf_bridge(make(*(fact(i, value=v) for i, v in values.items() if i != "CapEx"))).count() == 0


def test_q4_is_year_less_three_quarters_under_guards(make, companies):
    three = [fact("Revenue", q, v) for q, v in (("Q1", 10.0), ("Q2", 20.0), ("Q3", 30.0))]
    year = fact("Revenue", "FY", 50.0, "10-K", "2024-12-01")
    out = star.fact_financials(dedupe.canonical(make(*three, year)), companies).where("fiscal_period = 'Q4'").collect()
    assert [(r.value, r.form_type) for r in out] == [(-10.0, "10-K")] and out[0].fact_id.endswith(":Revenue:Q4derived:2024-10-31")
    for rows in ((*three[:2], year), (*three, year, fact("Revenue", "Q4", 7.0)), (*three[:2], fact("Revenue", "Q3", 30.0, concept="Other"), year)):
        out = star.fact_financials(dedupe.canonical(make(*rows)), companies)
        assert out.where(F.col("fact_id").contains("Q4derived")).count() == 0


def test_cash_flow_is_made_standalone(make, companies):
    rows = [fact("OperatingCashFlow", q, v) for q, v in (("Q1", 10.0), ("Q2", 25.0), ("Q3", 20.0))] + [fact("CapEx", "Q2", 7.0, frame="CY2024Q2"), fact("Depreciation", "Q3", 9.0)]
    out = {(r.line_item, r.fiscal_period): r.value for r in star.fact_financials(dedupe.canonical(make(*rows)), companies).collect()}
    assert out[("OperatingCashFlow", "Q2")] == 15 and out[("OperatingCashFlow", "Q3")] == -5 and out[("CapEx", "Q2")] == 7
    assert out[("Depreciation", "Q3")] == 9 and out[("FreeCashFlow", "Q2")] == 8
    assert star.unbased_cash_flow(make(*rows)).collect()[0].line_item in ("Depreciation", "CapEx")


@pytest.mark.parametrize("fe", range(1, 13))
def test_fiscal_round_trip(spark, fe):
    days = [dt.date(2023, 1, 15) + dt.timedelta(days=29 * k) for k in range(26)]
    df = spark.createDataFrame([(d,) for d in days], "d date").select("d", fiscal.snap_to_quarter_end("d", F.lit(fe)).alias("s"))
    fy, fp = fiscal.fiscal_label("s", F.lit(fe))
    df = df.withColumn("fy", fy).withColumn("fp", fp)
    y, q = fiscal.calendar_of("fy", "fp", F.lit(fe))
    for r in df.select("d", "s", "fy", "fp", y.alias("y"), q.alias("q")).collect():
        assert r.s >= r.d and (r.s.month - fe) % 3 == 0 and (r.s + dt.timedelta(days=1)).day == 1
        assert (r.y, r.q) == (r.s.year, (r.s.month - 1) // 3 + 1)


def test_formats(spark):
    rows = spark.createDataFrame([(1.234e9,), (-5.6e6,), (950_000.0,), (12.0,), (None,), (float("nan"),)], "x double")
    assert [r[0] for r in rows.select(text.dollars("x")).collect()] == ["$1.2B", "-$5.6M", "$950K", "$12", None, None]
    assert rows.limit(1).select(text.parse_dollars(F.lit("-$1.5K")), text.parse_percent(F.lit("8.0%")), text.percent(F.lit(0.0812)), text.source(F.lit(" ")), text.truthy(F.lit("Yes"))).first()[:] == (-1500.0, 0.08, "8.1%", "<missing>", True)


@pytest.mark.parametrize(
    ("words", "rule"),
    [
        ("Revenue was $1.2B [0000000001-24-000001].", None), ("Revenue rose 8.0% in 2024.", None), ("Revenue was $1.2 billion.", "forbidden"), ("It was $(3)M.", "negative"), ("It fell (8.0%).", "negative"),
        ("It was $9.9B [0000000001-24-000001].", "unknown amount"), ("It was $1.2B.", "no citation"), ("It was $1.2B [0000000009-24-000001].", "unknown citation"), ("It rose 55.0%.", "unknown per cent"), ("There were 8400 units.", "bare number"),
    ],
)
def test_guard_rules(words, rule):
    found = guard.violation(words, [1.2e9, 0.08], {"0000000001-24-000001"})
    assert found is None if rule is None else found.startswith(rule)


def test_guard_on_frames_retries_and_cli(spark, tmp_path):
    texts = spark.createDataFrame([("T", "It was $1.2B [0000000001-24-000001]."), ("U", "8400 units"), ("V", None)], "ticker string, text string")
    allowed = spark.createDataFrame([("T", [1.2e9], ["0000000001-24-000001"])], "ticker string, values array<double>, accessions array<string>")
    assert {r.ticker: r.violation is None for r in guard.guard(texts, allowed).collect()} == {"T": True, "U": False, "V": True}
    tries = iter(["8400 units", "fine"])
    assert guard.with_retries(lambda feedback: next(tries), [], set()) == "fine"
    (tmp_path / "t").write_text("It was $1.2B [0000000001-24-000001].")
    (tmp_path / "p").write_text('x\n```json\n{"revenue": {"value": "$1.2B", "accession": "0000000001-24-000001"}}\n```')
    assert audit_cli.main([str(tmp_path / "t"), str(tmp_path / "p")]) == 0 and audit_cli.main([str(tmp_path / "t"), "none"]) == 2
    (tmp_path / "t").write_text("8400 units")
    assert audit_cli.main([str(tmp_path / "t"), str(tmp_path / "p")]) == 1


def test_ingest_chooses_concepts_by_coverage(spark):
    import json

    def entries(*quarters):
        return {"label": "x", "units": {"USD": [dict(end=ENDS[q], val=1.0, accn="0000000001-24-000001", fy=2024, fp=q, form="10-Q", filed="2024-12-01") for q in quarters] + [dict(end="", val=1.0, accn="a", fy=2024, fp="Q1", form="10-Q", filed="x")]}}

    body = {"cik": 7, "facts": {"us-gaap": {"Revenues": entries("Q1", "Q2", "Q3"), "SalesRevenueNet": entries("Q1", "Q2", "Q3", "Q4"), "InventoryNet": entries("Q1")}}}
    docs = spark.createDataFrame([(" t ", json.dumps(body)), ("e", "{}")], "ticker string, json string")
    rows = companyfacts.ingest(docs).collect()
    assert {(r.ticker, r.line_item, r.concept_used) for r in rows} == {("T", "Revenue", "SalesRevenueNet"), ("T", "Inventory", "InventoryNet")} and len(rows) == 5
    assert all(r.frame == "" and len(r.fact_id) == 16 and r.filing_url.endswith("/7/000000000124000001/") for r in rows)
    assert [r.concept_used for r in dedupe.switched_concepts(dedupe.choose_concepts(companyfacts.candidates(docs))).collect()] == ["Revenues"]


def test_scenarios_balance_and_order(make):
    names = {"Revenue": 100.0, "CostOfRevenue": 25.0, "GrossProfit": 75.0, "OperatingExpenses": 40.0, "OperatingIncome": 35.0, "NetIncome": 30.0, "Cash": 200.0, "AccountsReceivable": 50.0, "Inventory": 5.0, "AccountsPayable": 10.0, "DeferredRevenue": 20.0, "TotalAssets": 500.0, "TotalLiabilities": 200.0, "TotalEquity": 300.0, "OperatingCashFlow": 40.0, "CapEx": 5.0, "Depreciation": 4.0, "StockBasedCompensation": 3.0, "TreasuryStockRepurchases": 1.0}
    rows = [fact(i, q, v * 1.1**k * 1e6, fy=fy, end=f"{fy}-{m:02d}-28") for i, v in names.items() for k, (fy, q, m) in enumerate([(2023, "Q4", 10), (2024, "Q1", 1), (2024, "Q2", 4), (2024, "Q3", 7), (2024, "Q4", 10)])]
    c = dedupe.canonical(make(*rows))
    h = scenario.history(statements.income_statement(c), statements.balance_sheet(c), statements.cash_flow(c))
    base = scenario.assumptions(h)
    assert base.first().revenue_growth_qoq == pytest.approx(0.1) and base.first().gross_margin_pct == pytest.approx(0.75)
    p = scenario.project(scenario.scenarios(base))
    scenario.assert_balanced(p)
    last = {r.scenario: r.Revenue for r in p.where("step = 4").collect()}
    assert last["Bull"] > last["Base"] > last["Bear"]


def test_vintages_are_appended_once(spark, tmp_path):
    old = spark.createDataFrame([("T", "m", "2024-01-31", 1.0, 0.0, 2.0, 0.0, 3.0, "2024-01-01")], readers.FORECAST_DDL)
    new = sinks.stamp(old.drop("forecast_run_date"), "2024-02-01")
    once = star.merge_vintages(old, new)
    assert once.count() == 2 == star.merge_vintages(once, new).count()
    sinks.csv(star.merge_vintages(old, new), str(tmp_path / "v"), ["forecast_run_date", "model", "period_end"])
    assert readers.vintages(spark, str(tmp_path / "v")).count() == 2 and readers.forecasts(spark, str(tmp_path / "none")).count() == 0


def test_as_of_and_range(spark):
    d = dt.date
    prices = spark.createDataFrame([("a", d(2024, 1, 5), 10.0), ("a", d(2024, 3, 28), 12.0)], "s string, date date, close double")
    periods = spark.createDataFrame([("a", d(2024, 1, 31), d(2024, 3, 31)), ("b", d(2024, 1, 31), d(2024, 3, 31))], 's string, start date, end date')
    rows = {r.s: r["return"] for r in timeseries.period_return(periods, prices, ["s"]).collect()}
    assert rows["a"] == pytest.approx(0.2) and rows["b"] is None
    series = spark.createDataFrame([("a", d(2024, 1, 31), 1.0), ("a", d(2024, 3, 31), 3.0), ("a", d(2024, 4, 1), 99.0)], "s string, date date, value double")
    assert {r.s: r["mean"] for r in timeseries.range_average(periods, series, ["s"]).collect()} == {"a": 2.0, "b": None}


def test_drivers(spark):
    ddl = "rev double, rev_prior double, margin_delta double, margin_prior double, one_time_items array<struct<amount: double, one_time: boolean>>"
    rows = [(2.16e9, 2.0e9, 0.001, 0.699, []), (2.012e9, 2.0e9, 0.03, 0.681, None), (2.3e9, 2.0e9, -0.01, 0.7, [(2e8, True)]), (2.1e9, 2.0e9, 0.02, 0.7, [])]
    assert [r.driver for r in variance.classify_driver(spark.createDataFrame(rows, ddl)).collect()] == ["volume", "margin", "one-time", "mix"]


def test_models_run_and_positive(spark):
    rows = [("T", f"{2020 + k // 4}-{3 * (k % 4) + 3:02d}-28", f"Q{k % 4 + 1}", 100.0 + 5 * k + 10 * (k % 4 == 3)) for k in range(18)]
    series = spark.createDataFrame(rows, "ticker string, period_end string, fiscal_period string, y double")
    out = modelling.forecast(series)
    modelling.check_forecasts(out)
    assert out.count() == 8 and [r.cut for r in modelling.folds(series).orderBy("cut").collect()] == [12, 13, 14]
    feats = modelling.features(series)
    assert feats.count() == 13 and modelling.regularised(feats, resamples=10).count() == 7
    assert modelling.recursive_forecast(series).count() == 4 and modelling.cv_summary(modelling.cross_validate(series)).count() == 2
    with pytest.raises(ValueError):
        modelling.check_forecasts(out.withColumn("yhat", F.lit(-1.0)))


def test_sinks_and_lookups(spark, make, tmp_path):
    sinks.facts(make(fact("Revenue")), str(tmp_path / "f"))
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.facts(make(fact("Revenue")), str(tmp_path / "f"))
    assert spark.read.parquet(str(tmp_path / "f")).count() == 1
    sinks.markdown(star.dim_metric(spark), str(tmp_path / "m"), ["line_item"], files=3)
    lines = [r.value for part in ("0_head", "1_rows") for r in spark.read.text(sorted(map(str, (tmp_path / "m" / part).glob("part-*")))).collect()]
    assert lines[0].startswith("| line_item | label |") and star.dim_metric(spark).count() == len(METRICS) == 30 == len(lines) - 2
    known = readers.resolve(adapter.companies(spark), spark.createDataFrame([(" s1 ",), ("zz",)], "ticker string")).collect()
    assert {r.ticker: r.cik for r in known} == {" s1 ": "0000000002", "zz": None}
    subs = spark.createDataFrame([(["8-K", "8-K"], ["a", "b"], ["x", "y"], ["1.01", "2.02, 9.01"])], "form array<string>, accessionNumber array<string>, primaryDocument array<string>, items array<string>")
    assert readers.first_submission(subs, "8-K", "2.02").first().submission.accessionNumber == "b"
    assert readers.first_submission(subs, "8-K", "9.01").first().submission.accessionNumber == "b"
    models = spark.createDataFrame([("m-4-1",), ("m-4-10",), ("n-9",)], "id string")
    assert guard.best_model(models, "m-").first().id == "m-4-10"


def test_extract_has_eight_typed_columns_without_nulls(spark):
    from tallyforge.sources import sinks

    rows = [("T", "Revenue", "2024-03-31", 2024, "Q1", 1.5, "a-1", "http://x", "USD"), (None, None, None, None, None, None, None, None, None)]
    out = sinks.extract(spark.createDataFrame(rows, "ticker string, line_item string, period_end string, fiscal_year int, fiscal_period string, value double, accession_no string, filing_url string, unit string"))
    assert [t for _, t in out.dtypes] == ["string", "string", "date", "int", "string", "double", "string", "string"] and "unit" not in out.columns
    assert [tuple(map(str, r)) for r in out.orderBy("ticker").collect()] == [("", "", "None", "0", "", "0.0", "", ""), ("T", "Revenue", "2024-03-31", "2024", "Q1", "1.5", "a-1", "http://x")]


def test_latest_file_macro_series_and_stamped_forecasts(spark, tmp_path):
    for name in ("T_note_2024-01-05.md", "T_note_2024-11-02.md", "T_note_2023-12-31.md", "U_note_2025-01-01.md"):
        (tmp_path / name).write_text("x")
    assert readers.latest_file(spark, f"{tmp_path}/T_note_*.md").endswith("T_note_2024-11-02.md") and readers.latest_file(spark, f"{tmp_path}/V_*.md") is None
    (tmp_path / "macro.csv").write_text("series_id,date,value\nA,2024-01-02,1.5\nA,2024-01-03,.\nB,2024-01-02,7\n")
    rows = readers.macro_series(spark, f"{tmp_path}/macro.csv", "A").orderBy("date").collect()
    assert [(r.date, r.value) for r in rows] == [(dt.date(2024, 1, 2), 1.5), (dt.date(2024, 1, 3), None)]
    assert readers.macro_series(spark, f"{tmp_path}/macro.csv").count() == 3
    old = spark.createDataFrame([("T", "m", "2024-01-31", 1.0)], "ticker string, model string, period_end string, yhat double")
    sinks.forecasts(old, str(tmp_path / "a"), "2024-02-01")
    sinks.forecasts(old.withColumn("extra", F.lit(1)), str(tmp_path / "b"))
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.forecasts(old, str(tmp_path / "a"))
    both = {r.forecast_run_date: r.extra for r in readers.forecasts(spark, str(tmp_path / "a"), str(tmp_path / "b")).collect()}
    assert both == {"2024-02-01": None, dt.datetime.now(dt.UTC).date().isoformat(): 1}


def test_audits_of_sources_coverage_and_cash_flow_quarters(spark, make):
    rows = make(fact("CapEx"), fact("CapEx", frame="CY2024Q1"), fact("CapEx", fp="Q2"), fact("Revenue"), fact("Revenue", frame="CY2024Q1"))
    assert [tuple(r) for r in star.duplicate_cash_flow_quarters(rows).collect()] == [("T", "CapEx", 2024, 1, 2)]
    assert [tuple(r) for r in quality.missing_per_item(quality.missing_coverage(rows)).collect()] == [("T", "Revenue", 1)]
    sources = spark.createDataFrame([("T", "a"), ("T", None), ("U", "b")], "ticker string, accession_no string")
    assert sorted(tuple(r) for r in quality.null_accessions(sources).collect()) == [("T", 2, 1), ("U", 1, 0)]


def test_working_capital_deltas_run_from_history_into_the_projection(spark):
    ddl = "ticker string, {} int, AccountsReceivable double, Inventory double, AccountsPayable double, scenario string"
    hist = spark.createDataFrame([("T", 1, 10.0, None, 4.0, ""), ("T", 2, 13.0, None, 9.0, "")], ddl.format("slot"))
    projected = spark.createDataFrame([("T", 1, 12.0, 0.0, 5.0, "Base"), ("T", 1, 99.0, 0.0, 99.0, "Bull")], ddl.format("step"))
    got = {(r.kind, r.slot, r["item"]): r.delta for r in scenario.working_capital_deltas(hist, projected).collect()}
    assert got == {("historical", 1, "AccountsReceivable"): 0, ("historical", 1, "Inventory"): 0, ("historical", 1, "AccountsPayable"): 0, ("historical", 2, "AccountsReceivable"): -3, ("historical", 2, "Inventory"): 0, ("historical", 2, "AccountsPayable"): 5, ("forecast", 1, "AccountsReceivable"): 1, ("forecast", 1, "Inventory"): 0, ("forecast", 1, "AccountsPayable"): -4}


def test_coefficients_by_weight(spark):
    rows = spark.createDataFrame([("T", "a", 1.0), ("T", "b", -3.0), ("T", "c", 0.0)], "ticker string, feature string, coefficient double")
    assert [r.feature for r in modelling.by_weight(rows).collect()] == ["b", "a"]
