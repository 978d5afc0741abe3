"""As-of state, the grouped fold, coverage, payloads, the guard, and sinks, against versions in plain Python."""

import datetime as dt
import json
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyforge.functions.vocab import FACT_DDL
from tallyforge.operators import dedupe, guard, modelling, quality, star, statements, timeseries
from tallyforge.plans.catalog import QUERIES
from tallyforge.sources import adapter, sinks

from .test_engine import companies, fact, make  # noqa: F401

DAY = dt.date(2024, 1, 1)


def days(rng, n, far):
    return [DAY + dt.timedelta(days=rng.randrange(far)) for _ in range(n)]


def test_as_of_carries_state_over_buckets_for_several_series(spark):
    rng = random.Random(1)
    prices = [(rng.choice("ab"), d, rng.choice([None, 1.0, 2.5, 7.0])) for d in days(rng, 60, 900)] + [(None, DAY, 4.0)]
    notes = [(rng.choice("ab"), d, rng.choice([None, "x", "y"])) for d in days(rng, 5, 900)]
    asks = [(rng.choice(["a", "b", "c", None]), d) for d in days(rng, 40, 1200)] * 2
    frames = {"price": (spark.createDataFrame(prices, "k string, at date, v double"), "v"), "note": (spark.createDataFrame(notes, "k string, at date, s string"), "s")}
    left = spark.createDataFrame(asks, "k string, at date").repartition(3)

    def seen(rows, k, at):
        own = [(d, v) for kk, d, v in rows if kk == k and d <= at and v is not None]
        return max(own)[1] if own else None

    expected = sorted(((k, at, seen(prices, k, at), seen(notes, k, at)) for k, at in asks), key=str)
    for bucket in ("week", "month", "year"):
        got = timeseries.as_of_all(left, frames, ["k"], "at", bucket)
        assert sorted(map(tuple, got.collect()), key=str) == expected
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Window \[.*last.*v_price.*\], \[on0_#\d+, bucket_#\d+\]", plan)  # a task holds a bucket of a key


def test_period_returns(spark):
    prices = spark.createDataFrame([("a", DAY, 2.0), ("a", DAY + dt.timedelta(days=50), 3.0), ("b", DAY, 0.0), ("b", DAY + dt.timedelta(days=9), 5.0)], "s string, date date, close double")
    periods = spark.createDataFrame([(s, DAY + dt.timedelta(days=a), DAY + dt.timedelta(days=b)) for s in "abc" for a, b in ((-1, 1), (0, 60), (40, 49))], "s string, start date, end date")
    got = {(r.s, (r.start - DAY).days): r["return"] for r in timeseries.period_return(periods, prices, ["s"]).collect()}
    assert got == {("a", -1): None, ("a", 0): 0.5, ("a", 40): 0.0, ("b", -1): None, ("b", 0): None, ("b", 40): 0.0, ("c", -1): None, ("c", 0): None, ("c", 40): None}


def test_macro_features_average_return_and_fill(spark):
    ends = [f"{y}-{m}" for y in (2022, 2023) for m in ("03-31", "06-30", "09-30", "12-31")]
    series = spark.createDataFrame([("T", e, f"Q{1 + k % 4}", 100.0 + k * k) for k, e in enumerate(ends)], "ticker string, period_end string, fiscal_period string, y double")
    rng = random.Random(2)
    macro = [(s, DAY - dt.timedelta(days=rng.randrange(500)), rng.random()) for s in ("VIXCLS", "INDPRO", "T10Y2Y", "OTHER") for _ in range(40)] + [("VIXCLS", DAY, None)]
    prices = [("E", dt.date(2022, 5, 1) + dt.timedelta(days=30 * k), 10.0 + k) for k in range(15)]
    aligned = modelling.macro_features(
        series, spark.createDataFrame(macro, "series_id string, date date, value double"), spark.createDataFrame(prices, "symbol string, date date, close double"), spark.createDataFrame([("T", "E")], "ticker string, symbol string")
    )
    got = {r.period_end: r for r in aligned.collect()}
    for e in ends:
        end = dt.date.fromisoformat(e)
        start = {3: dt.date(end.year - 1, 12, 31), 6: dt.date(end.year, 3, 30), 9: dt.date(end.year, 6, 30), 12: dt.date(end.year, 9, 30)}[end.month]
        for s in modelling.MACROS[:3]:
            own = [v for i, d, v in macro if i == s and start <= d <= end and v is not None]
            assert got[e][s] == (pytest.approx(sum(own) / len(own)) if own else None)
        low, high = ([v for _, d, v in prices if d <= x] for x in (start, end))
        assert got[e].etf_return == (pytest.approx(high[-1] / low[-1] - 1) if low else None)
    rows = modelling.features(series, aligned).collect()
    assert len(rows) == 3 and all(r[c] is not None for r in rows for c in (*modelling.FEATURES, *modelling.MACROS))


def scans(df):
    return len(re.findall(r"FileScan parquet", df._jdf.queryExecution().executedPlan().toString()))


@pytest.mark.parametrize("name", ["export_fact_financials", "star_join_tooltip", "data_quality", "missing_coverage", "restatement_details", "ttm_kpis"])
def test_lineitem_is_scanned_at_most_twice(spark, data, name):
    df = QUERIES[name](spark, data)
    assert len(re.findall(r"FileScan parquet[^\n]*lineitem", df._jdf.queryExecution().executedPlan().toString())) <= 2
    assert name == "star_join_tooltip" or scans(df) <= 2


def test_fold_against_rules_one_by_one(spark, companies):  # noqa: F811
    """Fourth quarters, standalone cash flows and free cash flow of random facts, by plain loops."""
    rng = random.Random(4)
    ends = {"Q1": "2024-01-31", "Q2": "2024-04-30", "Q3": "2024-07-31", "Q4": "2024-10-31"}
    rows = []
    for ticker in ("T", "T2", "T3", "T4"):
        for item in ("Revenue", "NetIncome", "OperatingCashFlow", "CapEx", "Cash"):
            for q, end in ends.items():
                for _ in range(rng.choice([0, 1, 1, 2, 3])):
                    rows.append(fact(item, q, rng.choice([None, 1.0, 5.5, -3.0, 20.0]), rng.choice(["10-Q", "10-Q/A", "8-K"]), rng.choice(["2024-06-01", "2024-09-01"]), rng.choice(["", "CY2024Q1", "CY2024"]), ticker=ticker, end=end, concept=item + rng.choice(["", "", "", "B"])))
            for _ in range(rng.choice([0, 1, 2])):
                rows.append(fact(item, "FY", rng.choice([100.0, None, 80.0]), rng.choice(["10-K", "10-K/A"]), "2024-12-01", rng.choice(["", "CY2024"]), ticker=ticker, end=ends["Q4"]))
    names = FACT_DDL.replace(" string", "").replace(" int", "").replace(" double", "").split(", ")
    held = [dict(zip(names, r, strict=True)) for r in {r[10]: r for r in rows}.values()]
    order = {"10-K/A": 4, "10-Q/A": 3, "10-K": 2, "10-Q": 1}
    rank = lambda r: (order.get(r["form_type"], 0), r["filed_date"], r["accession_no"], r["fact_id"])
    best = {}
    for r in sorted(held, key=rank):
        best[r["ticker"], r["line_item"], r["period_end"], r["period_type"], r["frame"]] = r
    canonical = list(best.values())
    cash = ("Cash",)
    one = {}
    prefer = lambda r: (order.get(r["form_type"], 0), r["filed_date"], r["frame"].startswith("CY") and "Q" in r["frame"], r["value"] is None, -abs(r["value"] or 0), r["accession_no"], r["fact_id"])
    for r in sorted((r for r in canonical if r["period_type"] == "Q" or r["line_item"] in cash), key=prefer):
        one[r["ticker"], r["line_item"], r["period_end"]] = r
    label = {v: k for k, v in ends.items()}
    raw = {(t, i, label[e]): r for (t, i, e), r in one.items()}
    expected = {}
    for (t, i, q), r in raw.items():
        value, n = r["value"], int(q[1])
        before = raw.get((t, i, f"Q{n - 1}"))
        if i in ("OperatingCashFlow", "CapEx") and before and before["value"] is not None and not re.match(r"CY\d{4}Q[1-4]$", r["frame"]):
            value = None if value is None else value - before["value"]
        expected[t, i, q] = value
    for t in ("T", "T2", "T3", "T4"):
        for i in ("Revenue", "NetIncome"):
            three = [raw.get((t, i, q)) for q in ("Q1", "Q2", "Q3")]
            year = sorted((r for r in canonical if (r["ticker"], r["line_item"], r["period_type"]) == (t, i, "FY")), key=rank)[-1:]
            if year and all(three) and (t, i, "Q4") not in raw and len({r["concept_used"] for r in [*three, *year]}) == 1:
                known = [r["value"] for r in three if r["value"] is not None]
                expected[t, i, "Q4"] = None if year[0]["value"] is None or not known else year[0]["value"] - sum(known)
        for q in ends:
            if (t, "OperatingCashFlow", q) in expected and (t, "CapEx", q) in expected:
                a, b = expected[t, "OperatingCashFlow", q], expected[t, "CapEx", q]
                expected[t, "FreeCashFlow", q] = None if a is None or b is None else a - b
    own = companies.unionByName(spark.createDataFrame([(t, 10) for t in ("T2", "T3", "T4")], "ticker string, fy_end_month int"))
    facts = spark.createDataFrame([tuple(r[n] for n in names) for r in held], FACT_DDL).repartition(3)
    got = [((r.ticker, r.line_item, r.fiscal_period), r.value) for r in star.fact_financials(dedupe.canonical(facts), own).collect()]
    assert len(got) == len(dict(got)) and dict(got) == expected and any(k[2] == "Q4" and k[1] == "Revenue" for k in expected)


def test_bucketed_facts_need_no_exchange(spark, data):
    facts, n = sinks.fact_table(adapter.facts(spark, data), buckets=3)
    assert n == facts.count() == adapter.facts(spark, data).count()
    for df in (dedupe.canonical(facts), statements.income_statement(dedupe.canonical(facts)), quality.restatements(facts)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "Bucketed: true" in plan
    assert statements.income_statement(dedupe.canonical(facts)).count() == statements.income_statement(dedupe.canonical(adapter.facts(spark, data))).count()


def test_persisted_tables_and_their_counts(spark, make, tmp_path):  # noqa: F811
    frames = {"t_income": make(fact("Revenue"), fact("Cash")), "t_none": make(fact("Revenue")).limit(0)}
    assert sinks.tables(frames, str(tmp_path)) == {"t_income": 2, "t_none": 0} and spark.table("t_income").count() == 2
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.tables(frames, str(tmp_path))


def test_ordered_files_hold_rows_in_order(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("id"), (F.col("id") % 3).alias("k"))
    sinks.csv(rows, str(tmp_path / "c"), ["k", "id"], files=5)
    parts = sorted((tmp_path / "c").glob("part-*.csv"))
    got = [tuple(map(int, line.split(","))) for p in parts for line in p.read_text().splitlines()[1:]]
    assert len(parts) == 5 and [(k, i) for i, k in got] == sorted((i * 1 % 3, i * 7919 % 1000) for i in range(1000))


def test_vintage_log_adds_once_and_survives_a_failed_writer(spark, tmp_path):
    ddl = "model string, period_end string, yhat double, forecast_run_date string"
    log = sinks.VintageLog(spark, str(tmp_path / "log"))
    first = spark.createDataFrame([("m", "2024-03-31", 1.0, "2024-01-01"), ("m", "2024-03-31", 1.0, "2024-01-01"), ("n", "2024-03-31", None, "2024-01-02")], ddl)
    assert log.read(ddl).count() == 0 and log.append(first) == 2 and log.append(first) == 0 and log.version() == 1
    more = first.withColumn("extra", F.lit(None).cast("int")).unionByName(spark.createDataFrame([("m", "2024-03-31", 2.0, "2024-01-01", 5)], f"{ddl}, extra int"))
    assert log.append(more) == 1 and log.version() == 2 and log.read(ddl).count() == 3 and log.read(ddl, version=1).count() == 2
    files = {p for p in (tmp_path / "log").rglob("*.parquet")}
    new = spark.createDataFrame([("m", "2024-06-30", 3.0, "2024-02-01")], ddl)

    class Stopped(sinks.VintageLog):
        def commit(self, version, snapshot):
            raise OSError("lost")

    with pytest.raises(OSError, match="lost"):
        Stopped(spark, str(tmp_path / "log")).append(new)
    assert log.read(ddl).count() == 3 and files < set((tmp_path / "log").rglob("*.parquet"))
    with pytest.raises(Exception, match="(?i)exist"):  # another writer took the version
        log.commit(1, "data/late")
    assert log.read(ddl).count() == 3 and log.append(new) == 1 and log.read(ddl).count() == 4


def walked(x, values, accessions):
    if isinstance(x, dict):
        v, a = x.get("value"), x.get("accession")
        if isinstance(v, str) and ("$" in v or "%" in v):
            t = v.replace(",", "").replace("$", "")
            try:
                if "$" in v:
                    body = t.lstrip("-")
                    unit = {"K": 1e3, "M": 1e6, "B": 1e9}.get(body[-1:])
                    number = float(body[:-1] if unit else body) * (unit or 1.0)
                    values.add(-number if t.startswith("-") else number)
                else:
                    values.add(float(v.rstrip("%")) / 100)
            except ValueError:
                pass
        if isinstance(a, str) and re.search(guard.ACCESSION, a):
            accessions.add(a)
    for y in x.values() if isinstance(x, dict) else x if isinstance(x, list) else ():
        walked(y, values, accessions)


def test_payload_values_at_any_depth(spark):
    rng = random.Random(7)
    leaf = lambda: rng.choice(["$1.2B", "-$5", "$1,234.5K", "3.2%", "-0.5%", "about $5", "$", "", None, "null", 7, 1.5, True, "0000000001-24-000001", "x 0000000002-24-000002 y"])

    def tree(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.2:
            return leaf()
        if kind < 0.5:
            return [tree(depth - 1) for _ in range(rng.randrange(4))]
        return {k: (leaf() if rng.random() < 0.6 else tree(depth - 1)) for k in rng.sample(["value", "accession", "a b", "c\"d", "$e", "f.g"], rng.randrange(5))}

    cases = [tree(6) for _ in range(150)] + [{"a": [[{"b": {"value": "$3M", "accession": "0000000003-24-000003"}}]]}]
    rows = [(str(k), json.dumps(x)) for k, x in enumerate(cases)] + [("bad", "{"), ("none", None)]
    got = {r.ticker: (r["values"], r.accessions) for r in guard.payload_values(spark.createDataFrame(rows, "ticker string, payload string")).collect()}
    for k, x in enumerate(cases):
        values, accessions = set(), set()
        walked(x, values, accessions)
        assert got[str(k)] == (pytest.approx(sorted(values)), sorted(accessions)), x
    assert got["bad"] == got["none"] == ([], []) and len(got["150"][0]) == 1


def test_payload_has_every_key_and_names_missing_sources(spark):
    columns = [c for _, c, _ in guard.ENTRIES]
    v = spark.createDataFrame([("T", *([1.5] * len(columns)), 2024, "Q1", "2024-01-31", "f1", "0000000001-24-000001", "http://x", "m|n", "g1", " "), ("U", *([None] * (len(columns) + 9)))],
        "ticker string, " + ", ".join(f"{c} double" for c in columns) + ", fiscal_year int, fiscal_period string, latest_period_end string, revenue_actual_fact_id string, revenue_actual_accession string, revenue_actual_filing_url string, revenue_prior_forecast_model string, gross_profit_fact_id string, op_income_fact_id string")
    q = spark.createDataFrame([("T", True, None)], "ticker string, has_restatement boolean, has_physical_inventory boolean")
    full, empty = (json.loads(r.payload) for r in guard.payloads(v, q).orderBy("ticker").collect())
    assert len(full) == len(empty) == 4 + len(guard.ENTRIES) + len(guard.PROVENANCE) + 4
    assert full["revenue"] == {"value": "$2", "fact_id": "f1", "accession": "0000000001-24-000001", "filing_url": "http://x"} and empty["revenue"] == empty["fcf_yoy"] == {"value": None}
    assert full["gross_margin_pct_yoy_delta_provenance"] == "derived: gross_margin_pct_actual - gross_margin_pct_yoy. Sources: g1, f1, <missing>, <missing>"
    assert full["operating_margin_pct_actual_provenance"].endswith("Sources: <missing>, f1") and full["free_cash_flow_provenance"].endswith("OperatingCashFlow - CapEx. Sources: <missing>, <missing>")
    assert full["revenue_variance_vs_forecast_provenance"].endswith("f1, forecast_model=m|n") and empty["revenue_prior_forecast_model"] == "N/A"
    assert (full["has_restatement"], full["has_physical_inventory"], empty["has_restatement"], empty["fiscal_year"]) == (True, False, False, 0)


def judged(text, values, accessions):
    """The rules in order, by positions in the text."""
    text = text or ""
    for w in guard.FORBIDDEN:
        if w in text.lower():
            return f"forbidden word: {w}"
    if re.search(guard.PARENS_DOLLAR, text) or re.search(guard.PARENS_PERCENT, text):
        return "negative in parentheses"
    near = lambda x: any(abs(x - v) <= max(0.01, 0.005 * abs(x), 0.005 * abs(v)) for v in values)
    for m in re.finditer(guard.DOLLAR, text):
        own = set()
        walked({"value": m.group()}, own, set())
        after = re.search(rf"\[({guard.ACCESSION}(?:,\s*{guard.ACCESSION})*)\]", text[m.end() : m.end() + 50])
        if not near(own.pop()):
            return f"unknown amount: {m.group()}"
        if not after:
            return f"no citation: {m.group()}"
        for a in re.findall(guard.ACCESSION, after.group(1)):
            if a not in accessions:
                return f"unknown citation: {a}"
    for m in re.finditer(guard.PERCENT, text):
        if not near(float(m.group()[:-1]) / 100):
            return f"unknown per cent: {m.group()}"
    spans = [m.span() for p in (guard.DOLLAR, guard.PERCENT, guard.YEAR) for m in re.finditer(p, text)]
    for m in re.finditer(guard.BARE, text):
        if not any(a <= m.start() and m.end() <= b for a, b in spans):
            return f"bare number: {m.group()}"
    return None


def test_guard_equals_rules_by_position(spark):
    rng = random.Random(9)
    good, other = "0000000001-24-000001", "0000000002-24-000002"
    parts = ["$1.2B", "$1.2", "-$5", "$5", "$1,234", "$1234.5678K", "$12.5K", "8.0%", "-8.0%", "55%", "1,234.5%", "2024", "1999", "20245", "12.50", "1,234", "8400", f"[{good}]", f"[{good}, {other}]", f"[{other}]", "é 😀", "\x01", " " * 40, "x", "word", "3", "(", "$(3", "million", "12K", "1.5.2", "$5.%"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", " ", ", "]) for _ in range(rng.randrange(1, 7))) for _ in range(1500)] + [f"$5{' ' * k}[{good}]" for k in range(20, 35)] + ["", None, "plain", "plain"]
    rows = [(rng.choice(["T", "U", "V", None]), t, k) for k, t in enumerate(texts)]
    allowed = {"T": ([1.2e9, 0.08, -5.0, 5.0, 0.55], {good}), "U": ([5.0, 12500.0, 1234567.8, 1.2], {good, other})}
    own = spark.createDataFrame([(t, v, sorted(a)) for t, (v, a) in allowed.items()], "ticker string, values array<double>, accessions array<string>")
    got = {r.k: r.violation for r in guard.guard(spark.createDataFrame(rows, "ticker string, text string, k int").repartition(4), own).collect()}
    expected = {k: judged(t, *allowed.get(ticker, ([], set()))) for ticker, t, k in rows}
    assert got == expected and {str(v).split(":")[0] for v in expected.values()} == {"None", "forbidden word", "negative in parentheses", "unknown amount", "no citation", "unknown citation", "unknown per cent", "bare number"}


def test_coverage_and_restatements_by_loops(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(400):
        q = rng.choice(["Q1", "Q2", "FY"])
        rows.append(fact(rng.choice(["Revenue", "Cash", "NetIncome"]), q, rng.choice([None, 1e6, 1.05e6, 1e6 + 5, 0.0]), rng.choice(["10-Q", "10-Q/A", "10-K", "10-K/A", None]), rng.choice(["2024-01-01", "2024-02-01", "2024-03-01"]), ticker=rng.choice("TUV"), end="2024-01-31" if q == "Q1" else "2024-04-30", accn=f"0000000001-24-{rng.randrange(6):06d}", fy=rng.choice([2024, 2025])))
    df = spark.createDataFrame(rows, FACT_DDL)
    names = df.columns
    held = [dict(zip(names, r, strict=True)) for r in rows]
    cells = {(r["ticker"], r["line_item"], r["fiscal_year"], r["fiscal_period"], r["period_end"]) for r in held if r["period_type"] == "Q"}
    items = {(r["ticker"], r["line_item"]) for r in held}
    absent = {(t, i, *q[2:]) for q in cells for t, i in items if t == q[0]} - cells
    assert sorted(map(tuple, quality.missing_coverage(df).collect())) == sorted(absent)
    best = {}
    for a in held:
        for o in held:
            keys = ("ticker", "line_item", "period_end", "period_type", "frame")
            if not (a["form_type"] or "").endswith("/A") or not o["form_type"] or o["form_type"].endswith("/A") or a["form_type"][:-2] != o["form_type"] or any(a[k] != o[k] for k in keys) or o["filed_date"] >= a["filed_date"] or None in (a["value"], o["value"]):
                continue
            d = abs(a["value"] - o["value"])
            if d > 10_000 or (o["value"] and d / abs(o["value"]) > 0.001):
                at = tuple(a[k] for k in keys) + (a["accession_no"],)
                rank = (o["filed_date"], o["accession_no"])
                best[at] = max(best.get(at, rank), rank)
    got = quality.restatements(df).collect()
    assert {(r.ticker, r.line_item, r.period_end, r.period_type, r.frame, r.amending_accession_no): (r.original_date, r.original_accession_no) for r in got} == best and len(got) == len(best)
    made = {r.ticker: r for r in quality.data_quality(df).collect()}
    for t in "TUV":
        own = [r for r in held if r["ticker"] == t]
        gaps = sorted({f"FY{y}{p}" for tt, i, y, p, _ in absent if tt == t and i in ("Revenue", "NetIncome")})
        assert (made[t].total_facts, made[t].distinct_line_items, made[t].distinct_fiscal_years) == (len(own), len({r["line_item"] for r in own}), len({r["fiscal_year"] for r in own}))
        assert made[t].has_restatement == any(k[0] == t for k in best) and made[t].missing_quarters == (",".join(gaps) or None)
    counts = defaultdict(int)
    for t, i, *_ in absent:
        counts[t, i] += 1
    assert {(r.ticker, r.line_item): r.missing_quarters for r in quality.missing_per_item(quality.missing_coverage(df)).collect()} == counts
