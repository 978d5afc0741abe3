"""The engine's queries over the driver's tables: name -> (spark, sf_dir) -> DataFrame.

Ratios are rounded to six digits and sums of money to four, as in the SQL they are held against."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fiscal, text
from ..operators import dedupe, guard, metrics, modelling, quality, scenario, star, statements, timeseries, variance
from ..sources import adapter, companyfacts, readers, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, digits: int = 6, **other: int) -> DataFrame:
    return df.select(*(F.round(c, other.get(c, digits)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def _kept(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read from there."""
    spark, path = df.sparkSession, _own_folder(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Tables:
    """What the queries share; each is a plan, computed when a query asks for it."""

    def __init__(self, spark: SparkSession, sf_dir: str, saved: bool = False, once: bool = False):
        """saved: facts are written once as a bucketed table, for queries that read them in several places.
        once: facts and the sums they are made of are written once as plain files, for queries whose plans would read
        the line items again for each statement; facts do not grow with the line items, so few files hold them."""
        self.spark, self.dir = spark, sf_dir
        self.facts = _kept(adapter.facts(spark, sf_dir, _kept)) if once else adapter.facts(spark, sf_dir)
        if saved:
            self.facts, _ = sinks.fact_table(self.facts)
        self.companies = adapter.companies(spark)
        self.canonical = dedupe.canonical(self.facts)
        self.income = statements.income_statement(self.canonical)
        self.balance = statements.balance_sheet(self.canonical)
        self.cash = statements.cash_flow(self.canonical)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @property
    def forecasts(self) -> DataFrame:
        """Three models' forecasts of revenue a year ahead of each quarter, dated at quarter starts."""
        rows = self.income.where("period_type = 'Q' AND Revenue IS NOT NULL").groupBy("ticker", "period_end").agg(F.max("Revenue").alias("r"))
        models = F.array(*(F.struct(F.lit(m).alias("model"), F.lit(k).alias("k")) for m, k in (("arima", 1.02), ("lasso", 0.97), ("prophet", 1.1))))
        rows = rows.select("ticker", "period_end", "r", F.inline(models))
        due = F.add_months(F.col("period_end").cast("date"), 10)
        return rows.select(
            "ticker", "model", F.add_months(F.trunc(due, "quarter"), 0).cast("string").alias("period_end"), (F.col("r") * F.col("k")).alias("yhat"),
            *((F.col("r") * s).alias(f"yhat_{n}") for n, s in (("lower_80", 0.9), ("upper_80", 1.2), ("lower_95", 0.8), ("upper_95", 1.3))), F.col("period_end").alias("forecast_run_date"),
        )

    @property
    def snapped(self) -> DataFrame:
        return star.fact_forecasts(self.forecasts, self.companies)

    @property
    def financials(self) -> DataFrame:
        return star.fact_financials(self.canonical, self.companies)

    @property
    def variance(self) -> DataFrame:
        return variance.variance_facts(self.income, self.balance, self.cash, self.snapped)

    @property
    def quality(self) -> DataFrame:
        return quality.data_quality(self.facts)

    @property
    def history(self) -> DataFrame:
        return scenario.history(self.income, self.balance, self.cash)

    @property
    def series(self) -> DataFrame:
        return self.financials.where("line_item = 'Revenue' AND period_type = 'Q'").select("ticker", "period_end", "fiscal_year", "fiscal_period", F.col("value").alias("y"))


@query
def facts(spark, d):
    return Tables(spark, d).facts


@query
def canonical_facts(spark, d):
    return Tables(spark, d).canonical


@query
def income_statement(spark, d):
    return Tables(spark, d).income


@query
def income_statement_aligned(spark, d):
    return statements.income_statement(Tables(spark, d).canonical, aligned=True)


@query
def balance_sheet(spark, d):
    return Tables(spark, d).balance


@query
def cash_flow(spark, d):
    return rounded(Tables(spark, d).cash, 4)


@query
def key_metrics(spark, d):
    t = Tables(spark, d)
    return rounded(statements.key_metrics(t.income, t.cash))


@query
def key_metrics_calendar_safe(spark, d):
    t = Tables(spark, d)
    return rounded(statements.key_metrics(t.income, t.cash, calendar_safe=True))


@query
def fcf_bridge(spark, d):
    return rounded(statements.fcf_bridge(Tables(spark, d).canonical), 4)


@query
def fcf_waterfall(spark, d):
    return rounded(statements.waterfall(statements.fcf_bridge(Tables(spark, d).canonical)), 4)


@query
def restatement_details(spark, d):
    return rounded(quality.restatements(Tables(spark, d).facts), 4, rel_diff=6)


@query
def missing_coverage(spark, d):
    return quality.missing_coverage(Tables(spark, d).facts)


@query
def missing_per_item(spark, d):
    return quality.missing_per_item(quality.missing_coverage(Tables(spark, d).facts)).orderBy("ticker", F.desc("missing_quarters"), "line_item")


@query
def duplicate_cash_flow_quarters(spark, d):
    t = Tables(spark, d)
    return star.duplicate_cash_flow_quarters(star.relabel(dedupe.collapsed(t.canonical), t.companies))


@query
def data_quality(spark, d):
    return Tables(spark, d).quality


@query
def refusal_gate(spark, d):
    t = Tables(spark, d, once=True)
    return quality.refusals(t.quality, t.variance)


@query
def duplicate_facts(spark, d):
    return quality.duplicate_facts(Tables(spark, d).facts)


@query
def variance_facts(spark, d):
    return rounded(Tables(spark, d, once=True).variance)


@query
def variance_facts_no_forecast(spark, d):
    t = Tables(spark, d, once=True)
    return rounded(variance.variance_facts(t.income, t.balance, t.cash, t.snapped.limit(0)))


@query
def export_fact_financials(spark, d):
    return rounded(Tables(spark, d).financials, 4)


@query
def collapsed_facts(spark, d):
    return dedupe.collapsed(Tables(spark, d).canonical)


@query
def q4_income_derivation(spark, d):
    return rounded(Tables(spark, d).financials.where(F.col("fact_id").contains(":Q4derived:")), 4)


@query
def derived_fcf(spark, d):
    return rounded(Tables(spark, d).financials.where("line_item = 'FreeCashFlow'"), 4)


@query
def ytd_to_standalone(spark, d):
    t = Tables(spark, d)
    rows = star.relabel(dedupe.collapsed(t.canonical), t.companies)
    return rounded(star.standalone_cash_flow(rows).where(F.col("line_item").isin("OperatingCashFlow", "CapEx")), 4)


@query
def unbased_cash_flow(spark, d):
    t = Tables(spark, d)
    return star.unbased_cash_flow(star.relabel(dedupe.collapsed(t.canonical), t.companies))


@query
def fact_fcf_bridge(spark, d):
    t = Tables(spark, d)
    return rounded(star.fact_bridge(statements.fcf_bridge(t.canonical), t.companies), 4)


@query
def fact_forecasts_snapped(spark, d):
    return rounded(Tables(spark, d).snapped)


@query
def vintage_merge(spark, d):
    rows = Tables(spark, d).forecasts
    return rounded(star.merge_vintages(rows.where("model != 'lasso'"), rows.where("model != 'arima'")))


@query
def dim_date(spark, d):
    t = Tables(spark, d)
    return star.dim_date(t.financials, t.snapped, t.companies)


@query
def dim_metric(spark, d):
    """The static list of metrics, with how many facts of each the table holds."""
    t = Tables(spark, d)
    counts = t.facts.groupBy("line_item").agg(F.count("*").alias("n_facts"))
    return star.dim_metric(spark).join(counts, "line_item", "left").withColumn("n_facts", F.coalesce("n_facts", F.lit(0).cast("long")))


@query
def dim_filing(spark, d):
    return star.dim_filing(Tables(spark, d).facts)


@query
def star_join_tooltip(spark, d):
    t = Tables(spark, d, saved=True)
    return rounded(star.star_join(t.financials, star.dim_date(t.financials, t.snapped, t.companies), star.dim_metric(spark), star.dim_filing(t.facts)), 4)


@query
def hist_financials_wide(spark, d):
    return rounded(statements.historical_wide(Tables(spark, d).financials.where("period_type = 'Q'")), 4)


@query
def sources_unpivot(spark, d):
    t = Tables(spark, d)
    return statements.sources(t.income, t.balance, t.cash)


@query
def null_accessions(spark, d):
    t = Tables(spark, d)
    return quality.null_accessions(statements.sources(t.income, t.balance, t.cash))


@query
def latest_provenance(spark, d):
    return statements.latest_provenance(Tables(spark, d).income)


@query
def latest_12_quarters(spark, d):
    return statements.latest_quarters(Tables(spark, d).income).select("ticker", "period_end", "fiscal_year", "fiscal_period", "Revenue", "slot")


@query
def ttm_kpis(spark, d):
    return rounded(metrics.ttm_kpis(Tables(spark, d).financials), 4, ttm_operating_margin=6, ttm_fcf_margin=6)


@query
def dso_rolling(spark, d):
    return rounded(metrics.dso(Tables(spark, d).financials))


@query
def billings(spark, d):
    return rounded(metrics.billings(Tables(spark, d).financials), 4, cover_ratio=6)


@query
def margins(spark, d):
    return rounded(metrics.margins(Tables(spark, d).financials))


@query
def rule_of_40(spark, d):
    return rounded(metrics.rule_of_40(Tables(spark, d).financials))


@query
def forecast_scorecard(spark, d):
    t = Tables(spark, d)
    return rounded(metrics.scorecard(t.financials, t.snapped), 4, variance_pct=6)


@query
def forecast_overlay(spark, d):
    t = Tables(spark, d)
    return rounded(metrics.forecast_overlay(t.financials, t.snapped), 4)


@query
def cv_error_summary(spark, d):
    t = Tables(spark, d)
    return rounded(metrics.model_errors(metrics.scorecard(t.financials, t.snapped)), 4, mape=6)


@query
def history_frame(spark, d):
    return rounded(Tables(spark, d).history, 4)


@query
def base_assumptions(spark, d):
    return rounded(scenario.assumptions(Tables(spark, d).history))


@query
def scenario_forecast(spark, d):
    """All outputs of a projected quarter; 0.0 is added so that no zero has a sign."""
    rows = rounded(scenario.project(scenario.scenarios(scenario.assumptions(Tables(spark, d).history))), 4)
    return rows.select("ticker", "scenario", "step", *((F.col(n) + F.lit(0.0)).alias(n) for n in scenario.STEPS))


@query
def statement_tables(spark, d):
    t = Tables(spark, d)
    projected = scenario.project(scenario.scenarios(scenario.assumptions(t.history)))
    return rounded(scenario.statement_tables(t.history, projected), 4).withColumn("value", F.col("value") + F.lit(0.0))


@query
def balance_check(spark, d):
    rows = scenario.balance_checks(scenario.project(scenario.scenarios(scenario.assumptions(Tables(spark, d).history))))
    return rounded(rows, 4)


@query
def ocf_residual(spark, d):
    return rounded(scenario.ocf_residual(Tables(spark, d).history), 4)


@query
def debt_schedule(spark, d):
    return scenario.debt_schedule(scenario.assumptions(Tables(spark, d).history))


@query
def working_capital_deltas(spark, d):
    t = Tables(spark, d)
    projected = scenario.project(scenario.scenarios(scenario.assumptions(t.history)))
    return rounded(scenario.working_capital_deltas(t.history, projected), 4)


@query
def summary_kpis(spark, d):
    t = Tables(spark, d)
    projected = scenario.project(scenario.scenarios(scenario.assumptions(t.history)))
    return rounded(scenario.kpis(t.history, projected), 4)


@query
def feature_matrix(spark, d):
    """All eleven features; orders stand for three series of different frequency and for four funds."""
    t = Tables(spark, d)
    orders = t.read("orders").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").cast("date").alias("date"), F.col("o_totalprice").alias("value"))
    daily = orders.where("k % 3 = 0").withColumn("series_id", F.lit("VIXCLS"))
    weekly = orders.where("k % 3 = 1 AND dayofweek(date) = 2").withColumn("series_id", F.lit("INDPRO"))
    monthly = orders.where("k % 3 = 2 AND day(date) = 1").withColumn("series_id", F.lit("T10Y2Y"))
    macro = daily.unionByName(weekly).unionByName(monthly).select("series_id", "date", (F.col("value") / 1e4).alias("value"))
    prices = orders.select(F.concat(F.lit("E"), (F.col("k") % 4).cast("string")).alias("symbol"), "date", F.col("value").alias("close"))
    funds = t.companies.select("ticker", F.concat(F.lit("E"), ((F.col("cik_int") - 1) % 4).cast("string")).alias("symbol"))
    return rounded(modelling.features(t.series, modelling.macro_features(t.series, macro, prices, funds)))


@query
def cv_folds(spark, d):
    return modelling.folds(Tables(spark, d).series.where("y IS NOT NULL"))


@query
def model_forecast(spark, d):
    return rounded(modelling.forecast(Tables(spark, d).series), 0)


@query
def model_cross_validation(spark, d):
    return rounded(modelling.cv_summary(modelling.cross_validate(Tables(spark, d).series)), 0, mape_mean=6, mape_std=6)


@query
def regularised_coefficients(spark, d):
    return modelling.regularised(modelling.features(Tables(spark, d).series))


@query
def recursive_forecast(spark, d):
    """Rounded to thousands: the fit's rounding errors are far below, and no engine sums in the same order."""
    return modelling.recursive_forecast(Tables(spark, d).series).withColumn("yhat", F.round("yhat", -3))


@query
def bootstrap_percentiles(spark, d):
    rows = Tables(spark, d).read("orders").select("o_orderpriority", "o_totalprice")
    return rounded(modelling.percentiles(rows, ["o_orderpriority"], "o_totalprice"), 4)


def _periods(dates: DataFrame) -> DataFrame:
    """Quarters, by their ends, from the first date's to the last one's."""
    ends = dates.agg(*(F.last_day(F.add_months(F.trunc(f("date"), "quarter"), 2)).alias(c) for c, f in (("low", F.min), ("high", F.max))))
    ends = ends.select(F.explode(F.expr("sequence(low, high, interval 3 month)")).alias("day")).select(F.last_day("day").alias("end"))
    return ends.select(F.add_months("end", -3).alias("start"), "end")


@query
def asof_price_return(spark, d):
    t = Tables(spark, d)
    prices = t.read("orders").select((F.col("o_custkey") % 5).alias("symbol"), F.col("o_orderdate").cast("date").alias("date"), F.col("o_totalprice").alias("close"))
    periods = _periods(prices).join(F.broadcast(spark.range(5).select(F.col("id").alias("symbol"))))
    return rounded(timeseries.period_return(periods, prices, ["symbol"]))


@query
def quarterly_range_avg(spark, d):
    t = Tables(spark, d)
    series = t.read("orders").select((F.col("o_custkey") % 5).alias("symbol"), F.col("o_orderdate").cast("date").alias("date"), F.col("o_totalprice").alias("value"))
    periods = _periods(series).join(F.broadcast(spark.range(5).select(F.col("id").alias("symbol"))))
    return rounded(timeseries.range_average(periods, series, ["symbol"]), 4)


@query
def fill_gaps(spark, d):
    rows = Tables(spark, d).read("events").select("event_id", "user_id", "ts", F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("value"))
    return timeseries.filled(rows.withColumn("at", F.struct("ts", "event_id")), ["user_id"], "at", ["value"]).drop("at", "ts")


@query
def concept_selection(spark, d):
    return dedupe.choose_concepts(_candidates(spark, d)).where("choice = 1")


@query
def concept_switch_audit(spark, d):
    return dedupe.switched_concepts(dedupe.choose_concepts(_candidates(spark, d)))


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    rank = F.when(F.col("concept_used").endswith("Alt"), 1).otherwise(0)
    return Tables(spark, d).facts.withColumn("synonym_rank", rank)


@query
def fact_id_hash(spark, d):
    o = Tables(spark, d).read("orders")
    day = F.col("o_orderdate").cast("date").cast("string")
    return o.select("o_orderkey", adapter.fact_id(F.col("o_custkey").cast("string"), "o_orderpriority", day, "o_orderstatus", F.col("o_orderkey").cast("string")).alias("fact_id"), text.zero_padded("o_custkey").alias("cik"))


@query
def years_filter(spark, d):
    return dedupe.last_years(Tables(spark, d).facts, 2).select("ticker", "fiscal_year", "fact_id")


@query
def fiscal_calendar_map(spark, d):
    days = Tables(spark, d).read("orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    rows = days.withColumn("fe", F.explode(F.sequence(F.lit(1), F.lit(12))))
    fy, fp = fiscal.fiscal_label("day", F.col("fe"))
    rows = rows.select("day", "fe", fiscal.snap_to_quarter_end("day", F.col("fe")).alias("snapped"), fy.alias("fiscal_year"), fp.alias("fiscal_period"))
    year, quarter = fiscal.calendar_of("fiscal_year", "fiscal_period", F.col("fe"))
    return rows.withColumns({"calendar_year": year, "calendar_quarter": quarter})


@query
def driver_classification(spark, d):
    t = Tables(spark, d, once=True)
    rows = t.variance.select(
        "ticker", F.col("revenue_actual").alias("rev"), F.col("revenue_yoy").alias("rev_prior"), F.col("gross_margin_pct_yoy_delta").alias("margin_delta"),
        F.col("gross_margin_pct_yoy").alias("margin_prior"), F.array(F.struct(F.lit(1e4).alias("amount"), (F.col("ticker") == "S1").alias("one_time"))).alias("one_time_items"),
    )
    return rounded(variance.classify_driver(rows).drop("one_time_items"), 4)


@query
def amount_formats(spark, d):
    o = Tables(spark, d).read("customer")
    amount = F.col("c_acctbal") * 1000
    return o.select("c_custkey", text.dollars(amount).alias("dollars"), F.round(text.parse_dollars(text.dollars(amount)), 4).alias("parsed"), text.percent(F.col("c_acctbal") / 1e4).alias("percent"), text.truthy(F.col("c_mktsegment")).alias("truthy"))


@query
def numeric_token_audit(spark, d):
    return guard.token_audit(Tables(spark, d).read("documents")).select("doc_id", "n_dollars", "n_percents", "n_bare", "n_forbidden")


@query
def payloads(spark, d):
    t = Tables(spark, d, once=True)
    return guard.payloads(t.variance, t.quality)


@query
def payload_inputs(spark, d):
    """What each payload allows a text to say, taken out of it again; nested deeper once more."""
    t = Tables(spark, d, once=True)
    rows = guard.payloads(t.variance, t.quality)
    deeper = rows.select("ticker", F.concat(F.lit('{"batch": [[1, {"inner": '), "payload", F.lit('}], {"value": "$7.5M", "accession": "none"}]}')).alias("payload"))
    said = guard.payload_values(deeper)
    return said.select("ticker", F.array_join(F.transform("values", lambda v: F.format_number(v, 4)), " ").alias("amounts"), F.array_join("accessions", " ").alias("accessions"))


@query
def guarded_texts(spark, d):
    """Sentences about each ticker, one for each rule, and the texts of all documents."""
    t = Tables(spark, d, once=True)
    rows = guard.payload_values(guard.payloads(t.variance, t.quality))
    said, cited, share = text.dollars("revenue_actual"), F.concat(F.lit(" ["), "revenue_actual_accession", F.lit("]")), text.percent("gross_margin_pct_actual")
    sentences = {
        "cited": F.concat(F.lit("Revenue was "), said, cited, F.lit(" in 2024.")), "twice": F.concat(said, F.lit(" and "), said, cited), "uncited": F.concat(F.lit("Revenue was "), said, F.lit(".")),
        "late": F.concat(said, F.lit(" " * 45), cited), "unknown": F.concat(F.lit("Revenue was $98765.4B"), cited), "foreign": F.concat(F.lit("Revenue was "), said, F.lit(" [0000000000-00-000000].")),
        "share": F.concat(F.lit("A margin of "), share, F.lit(" in 1999.")), "shares": F.concat(F.lit("A margin of "), share, F.lit(" after 987.6%.")), "word": F.concat(said, cited, F.lit(", a Billion")),
        "negative": F.lit("It fell (3.2 %)."), "bare": F.concat(F.lit("In 2024, 1,234 units at "), said, cited), "decimal": F.lit("Some 12.50 of 2024"), "partly": F.concat(said, F.lit(",000"), cited),
    }
    pairs = F.array(*(F.struct(F.lit(k).alias("name"), v.alias("text")) for k, v in sentences.items()))
    texts = t.variance.select("ticker", F.inline(pairs))
    documents = t.read("documents").select(F.concat(F.lit("S"), (F.col("doc_id") % adapter.TICKERS).cast("string")).alias("ticker"), F.col("doc_id").cast("string").alias("name"), "text")
    return guard.guard(texts.unionByName(documents), rows).select("ticker", "name", "violation")


@query
def json_props(spark, d):
    e = Tables(spark, d).read("events")
    return e.select("event_id", F.explode(F.from_json("props", "map<string, long>")).alias("key", "number"))


@query
def companyfacts_ingest(spark, d):
    """Documents of a few entries each, nested as filings are, through the whole ingestion."""
    o = Tables(spark, d).read("orders").where(F.col("o_totalprice").isNotNull())
    day = F.last_day(F.col("o_orderdate").cast("date"))
    accession = F.concat(F.lpad(F.col("o_custkey").cast("string"), 10, "0"), F.lit("-"), F.date_format(day, "yy"), F.lit("-"), F.lpad((F.col("o_orderkey") % 1000000).cast("string"), 6, "0"))
    item = F.struct(day.cast("string").alias("end"), F.col("o_totalprice").alias("val"), accession.alias("accn"), F.year(day).alias("fy"), F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("fp"), F.lit("10-Q").alias("form"), F.date_add(day, 30).cast("string").alias("filed"))
    concept = F.when(F.col("o_orderkey") % 3 == 0, "Revenues").otherwise("SalesRevenueNet")
    by = o.select(F.col("o_custkey"), concept.alias("concept"), item.alias("entry")).groupBy("o_custkey", "concept").agg(F.struct(F.lit("").alias("label"), F.create_map(F.lit("USD"), F.collect_list("entry")).alias("units")).alias("body"))
    by = by.groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("concept", "body"))).alias("concepts"))
    documents = by.select(F.concat(F.lit(" c"), F.col("o_custkey").cast("string")).alias("ticker"), F.to_json(F.struct(F.col("o_custkey").alias("cik"), F.create_map(F.lit("us-gaap"), F.col("concepts")).alias("facts"))).alias("json"))
    return companyfacts.ingest(documents, years=3).select("ticker", "line_item", "concept_used", "period_end", "fiscal_year", "fiscal_period", "value", "accession_no", "fact_id")


@query
def facts_per_item(spark, d):
    return Tables(spark, d).facts.groupBy("line_item").agg(F.count("*").alias("n")).orderBy(F.desc("n"))


@query
def event_windows(spark, d):
    from ..streaming import facts as streaming

    rows = streaming.windowed(Tables(spark, d).read("events"), "1 day")
    return rounded(rows.select(F.col("window.start").cast("date").alias("day"), "event_type", "n", "total"), 4)


@query
def markdown_metrics(spark, d):
    """Rows of a Markdown table of each quarter's margins."""
    rows = metrics.margins(Tables(spark, d).financials).select("ticker", "period_end", (F.col("Revenue") / 1e6).alias("revenue_millions"), "gross_margin", "yoy_growth")
    return sinks.markdown_lines(rows).select("ticker", "period_end", "line")


def _own_folder(spark: SparkSession) -> str:
    return f"{sinks.shared_dir(spark)}/{uuid.uuid4().hex}"


@query
def calendar_shift(spark, d):
    """Dates a quarter back and two ahead, their calendar quarter, and the quarter starts that follow."""
    days = star.distinct_values(Tables(spark, d).read("orders").select(F.col("o_orderdate").cast("date").alias("day")), "day")
    rows = days.withColumns({"before": fiscal.shift_quarters("day", -1), "ahead": fiscal.shift_quarters("day", 2), "quarter": fiscal.calendar_quarter("day")})
    return timeseries.quarter_starts(rows, "day", horizon=3)


@query
def prompt_bodies(spark, d):
    """Prompts without their leading comment, and sources with a mark where they are missing."""
    rows = Tables(spark, d).read("documents")
    written = F.concat(F.lit("<!-- v1\n"), F.coalesce("lang", F.lit("")), F.lit(" -->\n\n"), F.coalesce("text", F.lit("")))
    blank = F.when(F.col("doc_id") % 3 == 0, F.lit(" ")).when(F.col("doc_id") % 3 == 1, F.col("source"))
    return rows.select("doc_id", F.md5(text.without_leading_comment(written)).alias("body_md5"), text.source(blank).alias("source"), text.period_label(F.col("doc_id") % 30 + 2000, F.concat(F.lit("Q"), F.col("doc_id") % 4 + 1)).alias("label"))


@query
def latest_models(spark, d):
    """The model of each family with the greatest version, versions compared number by number."""
    ids = Tables(spark, d).read("orders").select(F.concat_ws("-", F.lit("m"), F.col("o_orderkey") % 13, F.lit("x"), F.col("o_custkey") % 120).alias("id"))
    families = [guard.best_model(ids, f).select(F.lit(f).alias("family"), "id") for f in ("m-1-", "m-12-", "x-7", "m-99-")]
    return reduce(DataFrame.unionByName, families)


@query
def submission_lookup(spark, d):
    """The first filing of a form, with and without an item, out of arrays of equal length."""
    orders = Tables(spark, d).read("orders")
    own = F.struct("o_orderkey", F.col("o_orderpriority").alias("form"), F.col("o_orderkey").cast("string").alias("no"), F.concat(F.lit("d"), "o_orderkey").alias("document"), F.concat_ws(", ", F.lit("1.01"), F.concat(F.lit("2.0"), (F.col("o_orderkey") % 5).cast("string"))).alias("items"))
    rows = orders.groupBy("o_custkey").agg(F.array_sort(F.collect_list(own)).alias("o"))
    rows = rows.select("o_custkey", F.col("o.form").alias("form"), F.col("o.no").alias("accessionNumber"), F.col("o.document").alias("primaryDocument"), F.col("o.items").alias("items"))
    first = readers.first_submission(rows, "1-URGENT").select("o_custkey", F.col("submission.accessionNumber").alias("first_urgent"))
    return first.join(readers.first_submission(rows, "1-URGENT", "2.03").select("o_custkey", F.col("submission.primaryDocument").alias("urgent_with_item")), "o_custkey")


@query
def resolved_companies(spark, d):
    t = Tables(spark, d)
    wanted = t.read("customer").select("c_custkey", F.concat(F.lit(" s"), (F.col("c_custkey") % 10).cast("string"), F.lit(" ")).alias("asked"))
    return readers.resolve(t.companies, wanted, "asked").select("c_custkey", "cik", "fy_end_month")


@query
def sniffed_payloads(spark, d):
    """Payloads as they are, inside a fence, and texts that hold none."""
    rows = Tables(spark, d).read("events").select("event_id", F.col("props").cast("string").alias("p"))
    fenced = F.concat(F.lit("Note.\n```json\n"), "p", F.lit("\n```\nEnd."))
    raw = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("  "), "p")).when(F.col("event_id") % 3 == 1, fenced).otherwise(F.lit("no payload"))
    return rows.withColumn("raw", raw).select("event_id", readers.payload_json("raw").alias("payload"))


@query
def facts_round_trip(spark, d):
    """Facts written by ticker and read again, some of them through a registered view."""
    path = _own_folder(spark)
    sinks.facts(Tables(spark, d).facts, path)
    back = spark.read.parquet(path)
    name = f"facts_{uuid.uuid4().hex}"
    sinks.views({name: back})
    return spark.table(name).groupBy("ticker", "line_item").agg(F.count("*").alias("n"), F.round(F.sum(F.col("value").cast("decimal(28,4)")), 2).cast("double").alias("total"))


@query
def forecast_files(spark, d):
    """Forecast files of two models: one stamped, one with a column more, one file that is not there."""
    rows, path = Tables(spark, d).forecasts.drop("forecast_run_date"), _own_folder(spark)
    sinks.forecasts(rows.where("model = 'lasso'"), f"{path}/lasso", "2024-02-01")
    sinks.forecasts(rows.where("model = 'arima'").withColumn("note", F.col("ticker")), f"{path}/arima", "2024-03-01")
    return rounded(readers.forecasts(spark, f"{path}/lasso", f"{path}/arima", f"{path}/none").select("ticker", "model", "period_end", "yhat", "note", "forecast_run_date"))


@query
def vintage_log(spark, d):
    """Three runs appended to a log, the last of which adds nothing, then read by run date."""
    rows = Tables(spark, d).forecasts
    log = sinks.VintageLog(spark, _own_folder(spark))
    added = [log.append(part) for part in (rows.where("model != 'lasso'"), rows.where("model != 'arima'"), rows)]
    seen = log.read(readers.FORECAST_DDL).groupBy("model", "forecast_run_date").agg(F.count("*").alias("n"), F.sum(F.floor("yhat")).alias("whole_yhat"))
    return seen.select("*", *(F.lit(n).cast("long").alias(f"added_{k}") for k, n in enumerate(added)))


@query
def persisted_statements(spark, d):
    """The statements as persisted tables, over facts saved in buckets, with the counts seen while writing."""
    t, path, own = Tables(spark, d, saved=True), _own_folder(spark), uuid.uuid4().hex
    counts = sinks.tables({f"{n}_{own}": df for n, df in (("income", t.income), ("balance", t.balance), ("cash", t.cash))}, path)
    rows = [spark.table(k).groupBy("ticker").agg(F.count("*").alias("n")).select(F.lit(k.partition("_")[0]).alias("name"), "ticker", "n", F.lit(n).cast("long").alias("counted")) for k, n in counts.items()]
    return reduce(DataFrame.unionByName, rows)


@query
def csv_round_trip(spark, d):
    """Ordered CSV of several files, read again."""
    path = _own_folder(spark)
    sinks.csv(Tables(spark, d).forecasts, path, ["forecast_run_date", "model", "ticker", "period_end"], files=4)
    return rounded(readers.vintages(spark, path))


@query
def extract_columns(spark, d):
    rows = sinks.extract(Tables(spark, d).financials.withColumn("filing_url", F.when(F.col("fiscal_period") != "Q2", F.col("filing_url"))).withColumn("value", F.when(F.col("fiscal_period") != "Q3", F.col("value"))))
    return rounded(rows, 4)


@query
def weighted_items(spark, d):
    """The items of each ticker by the size of what they hold, as coefficients are listed."""
    rows = Tables(spark, d).canonical.groupBy("ticker", F.col("line_item").alias("feature")).agg(F.sum(F.when(F.col("fiscal_period") == "Q1", F.col("value").cast("decimal(28,4)")).otherwise(0)).cast("double").alias("coefficient"))
    return rounded(modelling.by_weight(rows), 4)


@query
def cv_summary(spark, d):
    """Mean and sample deviation of forecast errors by model."""
    t = Tables(spark, d)
    rows = metrics.scorecard(t.financials, t.snapped).select("model", F.abs("variance").alias("mae"), F.abs("variance_pct").alias("mape"))
    return rounded(modelling.cv_summary(rows), 4, mape_mean=6, mape_std=6)
