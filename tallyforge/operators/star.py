"""Star schema: standalone quarterly facts, derived rows, forecasts and dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fiscal
from ..functions.vocab import BALANCE_SHEET, CUMULATIVE_CASH_FLOW, DERIVED_FCF, DERIVED_Q4, FACT_COLUMNS, METRICS, Q4_DERIVABLE
from .dedupe import form_priority, top

QUARTER_FRAME = r"^CY\d{4}Q[1-4]$"


def with_fiscal_year_end(df: DataFrame, companies: DataFrame) -> DataFrame:
    """Adds fe; companies has one row a ticker and is small by contract, so Catalyst may broadcast it."""
    return df.join(companies.select("ticker", F.col("fy_end_month").alias("fe")), "ticker", "left")


def relabel(df: DataFrame, companies: DataFrame) -> DataFrame:
    """Fiscal labels from the date itself instead of those stamped by the filing."""
    fy, fp = fiscal.fiscal_label("period_end", F.col("fe"))
    return with_fiscal_year_end(df, companies).withColumn("fiscal_year", fy).withColumn("fiscal_period", fp).drop("fe")


def _quarter(fp: str = "fiscal_period") -> Column:
    return F.nullif(F.regexp_extract(F.col(fp), "Q([1-4])", 1), F.lit("")).try_cast("int")


def _flow() -> Column:
    return F.col("line_item").isin(*CUMULATIVE_CASH_FLOW) & (F.col("period_type") == "Q")


def _cumulative(facts: DataFrame) -> DataFrame:
    """Adds q_, base_ (the raw value of the quarter before) and due_ (to be differenced)."""
    flow = _flow() & F.col("q_").isNotNull()
    quarter_before = Window.partitionBy("ticker", "line_item", "fiscal_year").orderBy("q_").rangeBetween(-1, -1)
    rows = facts.withColumn("q_", _quarter()).withColumn("base_", F.max(F.when(flow, F.col("value"))).over(quarter_before))
    framed = F.coalesce(F.col("frame"), F.lit("")).rlike(QUARTER_FRAME)
    return rows.withColumn("due_", flow & (F.col("q_") > 1) & ~framed)


def standalone_cash_flow(facts: DataFrame) -> DataFrame:
    """Year-to-date cash flows less those of the quarter before; first and quarter-framed quarters
    and those without a quarter before stay."""
    rows = _cumulative(facts)
    value = F.when(F.col("due_") & F.col("base_").isNotNull(), F.col("value") - F.col("base_")).otherwise(F.col("value"))
    return rows.withColumn("value", value).select(*facts.columns)


def unbased_cash_flow(facts: DataFrame) -> DataFrame:
    """Audit: year-to-date rows that have no quarter before to subtract."""
    return _cumulative(facts).where("due_ AND base_ IS NULL").select("ticker", "line_item", "fiscal_year", F.col("q_").alias("quarter"))


def duplicate_cash_flow_quarters(facts: DataFrame) -> DataFrame:
    """Audit: quarters that hold several rows of a cumulative cash flow, so that the base of the
    next quarter is a choice among them."""
    rows = facts.withColumn("quarter", _quarter()).where(F.col("line_item").isin(*CUMULATIVE_CASH_FLOW) & (F.col("period_type") == "Q") & F.col("quarter").isNotNull())
    return rows.groupBy("ticker", "line_item", "fiscal_year", "quarter").agg(F.count("*").alias("n_facts")).where("n_facts > 1")


def _prefer() -> list[Column]:
    """Of the facts of one item and date the one that stays has the greatest of these: the best form,
    the latest filing, a quarter frame, the smaller size."""
    framed = F.coalesce(F.col("frame"), F.lit("")).like("CY%Q%")
    unsized = F.isnull("value").cast("int") - F.isnan("value").cast("int")
    return [form_priority(), F.col("filed_date"), framed.cast("int"), unsized, -F.abs("value"), F.col("accession_no"), F.col("fact_id")]


def _fold(quarters: Column) -> Column:
    """What a year's fourth quarter and its cash flows need, from the sorted quarters of an item: sum,
    concepts and presence of the first three, and the greatest raw value of each quarter."""
    none = F.lit(None)
    zero = F.struct(
        F.lit(0).cast("decimal(38,4)").alias("sum"), F.lit(0).alias("valued"), F.lit(0).alias("seen"), none.cast("string").alias("low"), none.cast("string").alias("high"),
        F.array(*[none.cast("double")] * 4).alias("most"),
    )

    def step(s: Column, x: Column) -> Column:
        q, value = F.coalesce(x["q_"], F.lit(0)), x["value"]
        early = q.between(1, 3)
        counts = early & value.isNotNull()
        bit = F.element_at(F.array(*(F.lit(1 << k if k else 0) for k in range(5))), q + 1)
        return F.struct(
            (s["sum"] + F.when(counts, value.cast("decimal(28,4)")).otherwise(F.lit(0))).cast("decimal(38,4)").alias("sum"), (s["valued"] + counts.cast("int")).alias("valued"),
            s["seen"].bitwiseOR(bit).alias("seen"), F.when(early, F.least(s["low"], x["concept_used"])).otherwise(s["low"]).alias("low"),
            F.when(early, F.greatest(s["high"], x["concept_used"])).otherwise(s["high"]).alias("high"),
            F.transform(s["most"], lambda m, i: F.when(q == i + 1, F.greatest(m, value)).otherwise(m)).alias("most"),
        )

    return F.aggregate(quarters, zero, step)


def fact_financials(canonical: DataFrame, companies: DataFrame) -> DataFrame:
    """The quarterly fact table. In this order: one fact stays for an item and date; year-end balances are fourth
    quarters; labels come from dates; fourth quarters of income are derived (the year less its first
    three, where none was filed, all three are there and the concept did not change); cash flows
    become standalone; free cash flow is derived from these.

    The facts of (ticker, item, fiscal year) are one grouped state: an array of quarters, sorted,
    thinned to one a date and folded, so nothing is joined to itself. Free cash flow looks within a ticker's
    date. Both steps share one exchange on (ticker, fiscal year), so a ticker's rows are spread over its years."""
    keep = (F.col("period_type") == "Q") | ((F.col("period_type") == "FY") & F.col("line_item").isin(*BALANCE_SHEET))
    total = (F.col("period_type") == "FY") & F.col("line_item").isin(*Q4_DERIVABLE)
    rows = relabel(canonical.where(keep | total), companies).withColumn("q_", _quarter()).repartition("ticker", "fiscal_year")
    own = F.struct(*(F.col(c) for c in FACT_COLUMNS if c not in ("ticker", "line_item", "fiscal_year")), "q_").alias("own")
    quarter = F.struct(F.col("period_end").alias("at"), *(c.alias(f"p{i}") for i, c in enumerate(_prefer())), own)
    year = F.struct(F.col("period_end").alias("at"), form_priority().alias("p0"), F.col("filed_date").alias("p1"), F.col("accession_no").alias("p2"), F.col("fact_id").alias("p3"), own)
    rows = rows.groupBy("ticker", "line_item", "fiscal_year").agg(F.array_sort(F.collect_list(F.when(keep, quarter))).alias("all_"), F.max(F.when(total, year)).alias("year_"))
    last = F.filter("all_", lambda x, i: (i == F.size("all_") - 1) | (x["at"] != F.get(F.col("all_"), i + 1)["at"]))
    rows = rows.select("ticker", "line_item", "fiscal_year", F.transform(last, lambda x: x["own"].withField("period_type", F.lit("Q"))).alias("quarters_"), F.col("year_.own").alias("y_"))
    rows = rows.withColumn("s_", _fold(F.col("quarters_")))
    flow, y, s = F.col("line_item").isin(*CUMULATIVE_CASH_FLOW), F.col("y_"), F.col("s_")

    def standalone(x: Column) -> Column:
        base = F.when(x["q_"] > 1, F.get(s["most"], x["q_"] - 2))
        due = flow & ~F.coalesce(x["frame"], F.lit("")).rlike(QUARTER_FRAME) & base.isNotNull()
        return x.withField("value", F.when(due, x["value"] - base).otherwise(x["value"]))

    first_three_only = s["seen"] == 0b1110
    missing = F.col("line_item").isin(*Q4_DERIVABLE) & first_three_only & (s["low"] == s["high"]) & (s["low"] == y["concept_used"])
    fourth = (
        y.withField("concept_used", F.concat(y["concept_used"], F.lit(DERIVED_Q4))).withField("period_type", F.lit("Q")).withField("fiscal_period", F.lit("Q4"))
        .withField("value", F.when(s["valued"] > 0, y["value"] - s["sum"].cast("double"))).withField("frame", F.lit("")).withField("q_", F.lit(4))
        .withField("fact_id", F.concat_ws(":", y["accession_no"], F.col("line_item"), F.lit("Q4derived"), y["period_end"]))
    )
    made = F.transform("quarters_", standalone)
    made = F.when(missing, F.concat(made, F.array(fourth))).otherwise(made)
    rows = rows.select("ticker", "line_item", "fiscal_year", F.inline(made)).select(*FACT_COLUMNS)
    date = Window.partitionBy("ticker", "fiscal_year", "period_end")
    rows = rows.withColumn("spent_", F.max(F.when(F.col("line_item") == "CapEx", F.struct("value"))).over(date))
    whole = F.struct(*FACT_COLUMNS)
    free = (
        whole.withField("line_item", F.lit("FreeCashFlow")).withField("value", F.col("value") - F.col("spent_.value")).withField("concept_used", F.lit(DERIVED_FCF))
        .withField("fact_id", F.concat_ws(":FreeCashFlow:", "accession_no", "period_end"))
    )
    both = (F.col("line_item") == "OperatingCashFlow") & F.col("spent_").isNotNull()
    return rows.select(F.inline(F.when(both, F.array(whole, free)).otherwise(F.array(whole))))


def fact_bridge(bridge: DataFrame, companies: DataFrame) -> DataFrame:
    return relabel(bridge, companies).select(*bridge.columns)


def fact_forecasts(forecasts: DataFrame, companies: DataFrame) -> DataFrame:
    """Forecast dates snapped to fiscal quarter ends."""
    rows = with_fiscal_year_end(forecasts, companies)
    return rows.withColumn("period_end", fiscal.snap_to_quarter_end("period_end", F.col("fe")).cast("string")).withColumn("line_item", F.lit("Revenue")).drop("fe")


def merge_vintages(before: DataFrame, new: DataFrame) -> DataFrame:
    """Append-only: rows that are there already are not added again."""
    return before.unionByName(new, allowMissingColumns=True).distinct()


def dim_date(facts: DataFrame, forecasts: DataFrame, companies: DataFrame) -> DataFrame:
    """One row a ticker's date; labels of facts win over those of forecasts."""
    own = facts.where(F.col("fiscal_period").like("Q%") & (F.col("fiscal_year") != 0)).select("ticker", "period_end", "fiscal_year", "fiscal_period", F.lit(0).alias("rank_"))
    fy, fp = fiscal.fiscal_label("period_end", F.col("fe"))
    later = with_fiscal_year_end(forecasts.select("ticker", "period_end"), companies).select("ticker", "period_end", fy.alias("fiscal_year"), fp.alias("fiscal_period"), F.lit(1).alias("rank_"))
    rows = top(own.unionByName(later), ["ticker", "period_end"], [F.asc("rank_"), F.desc("fiscal_year"), F.desc("fiscal_period")])
    year, quarter = fiscal.calendar_of("fiscal_year", "fiscal_period", F.col("fe"))
    return with_fiscal_year_end(rows, companies).select(
        "ticker", F.col("period_end").alias("date_key"), "period_end", "fiscal_year", F.col("fiscal_period").alias("fiscal_quarter"), year.alias("calendar_year"), quarter.alias("calendar_quarter")
    )


def dim_metric(spark: SparkSession) -> DataFrame:
    rows = [F.struct(*(F.lit(v).alias(n) for n, v in zip(("line_item", "label", "category", "unit"), m, strict=True))) for m in METRICS]
    return spark.range(1).select(F.inline(F.array(*rows)))


def dim_filing(facts: DataFrame) -> DataFrame:
    """One row an accession number."""
    rows = facts.where(F.col("accession_no").isNotNull())
    return top(rows, ["accession_no"], [F.asc("filing_url"), F.asc("filed_date"), F.asc("form_type"), F.asc("fact_id")]).select("accession_no", "filing_url", "filed_date", "form_type")


def star_join(facts: DataFrame, dates: DataFrame, metrics: DataFrame, filings: DataFrame) -> DataFrame:
    """Facts with labels, calendar and filing."""
    return (
        facts.select("ticker", "line_item", "period_end", "value", "accession_no")
        .join(metrics, "line_item", "left")
        .join(dates.select("ticker", "period_end", "calendar_year", "calendar_quarter"), ["ticker", "period_end"], "left")
        .join(filings, "accession_no", "left")
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct()
