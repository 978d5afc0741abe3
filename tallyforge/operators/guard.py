"""Payloads of formatted values, and the guard that holds a text's numbers against them.

Everything is a column or a relation: payloads are JSON from structs, their values are taken back out by
a fold over VARIANT nodes, and texts are judged by built-in expressions. No Python runs on rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import MISSING, dollars, percent, source

# Token shapes and forbidden words (the last one with its space).
DOLLAR = r"-?\$\d+(?:\.\d+)?(?:[KMB])?"
PERCENT = r"-?\d+(?:\.\d+)?%"
YEAR = r"\b(?:19|20)\d{2}\b"
ACCESSION = r"\d{10}-\d{2}-\d{6}"
PARENS_DOLLAR = r"\$\(\s*\d"
PARENS_PERCENT = r"\(\s*-?\d+(?:\.\d+)?\s*%\s*\)"
BARE = r"\b\d{1,3}(?:,\d{3})+(?:\.\d+)?\b|\b\d+\.\d+\b|\b[1-9]\d{3,}\b"
FORBIDDEN = ("billion", "million", "thousand", "bps", "basis point", "percentage point", "pct point", "pp ")
CITE_WITHIN, RELATIVE, ABSOLUTE = 50, 0.005, 0.01

# Payload key, column of the variance row, format; and derived keys with their formula and sources.
ENTRIES = (
    ("revenue", "revenue_actual", dollars), ("revenue_yoy", "revenue_yoy", dollars), ("revenue_yoy_growth_pct", "revenue_yoy_growth_pct", percent),
    ("revenue_prior_forecast", "revenue_prior_forecast", dollars), ("revenue_variance_vs_forecast", "revenue_variance_vs_forecast", dollars),
    ("revenue_variance_pct_vs_forecast", "revenue_variance_pct_vs_forecast", percent), ("gross_margin_pct_actual", "gross_margin_pct_actual", percent),
    ("gross_margin_pct_yoy", "gross_margin_pct_yoy", percent), ("gross_margin_pct_yoy_delta", "gross_margin_pct_yoy_delta", percent),
    ("operating_margin_pct_actual", "operating_margin_pct_actual", percent), ("operating_margin_pct_yoy", "operating_margin_pct_yoy", percent),
    ("operating_margin_pct_yoy_delta", "operating_margin_pct_yoy_delta", percent), ("fcf_actual", "fcf_actual", dollars), ("fcf_yoy", "fcf_yoy", dollars),
    ("fcf_yoy_growth_pct", "fcf_yoy_growth_pct", percent), ("billings_actual", "billings_actual", dollars), ("billings_yoy", "billings_yoy", dollars),
    ("billings_yoy_growth_pct", "billings_yoy_growth_pct", percent),
)
REV, GP, OP = "revenue_actual_fact_id", "gross_profit_fact_id", "op_income_fact_id"
REV_YOY, GP_YOY, OP_YOY, OCF, CAPEX, MODEL = "revenue_yoy_fact_id", "gross_profit_yoy_fact_id", "op_income_yoy_fact_id", "ocf_actual_fact_id", "capex_actual_fact_id", "revenue_prior_forecast_model"
PROVENANCE = (
    ("revenue_yoy_growth_pct_provenance", "(revenue_actual - revenue_yoy) / revenue_yoy", (REV, REV_YOY)),
    ("revenue_variance_vs_forecast_provenance", "revenue_actual - revenue_prior_forecast", (REV, MODEL)),
    ("revenue_variance_pct_vs_forecast_provenance", "(revenue_actual - revenue_prior_forecast) / revenue_prior_forecast", (REV, MODEL)),
    ("gross_margin_pct_actual_provenance", "gross_profit_actual / revenue_actual", (GP, REV)), ("gross_margin_pct_yoy_provenance", "gross_profit_yoy / revenue_yoy", (GP_YOY, REV_YOY)),
    ("gross_margin_pct_yoy_delta_provenance", "gross_margin_pct_actual - gross_margin_pct_yoy", (GP, REV, GP_YOY, REV_YOY)),
    ("operating_margin_pct_actual_provenance", "operating_income_actual / revenue_actual", (OP, REV)), ("operating_margin_pct_yoy_provenance", "operating_income_yoy / revenue_yoy", (OP_YOY, REV_YOY)),
    ("operating_margin_pct_yoy_delta_provenance", "operating_margin_pct_actual - operating_margin_pct_yoy", (OP, REV, OP_YOY, REV_YOY)),
    ("free_cash_flow_provenance", "OperatingCashFlow - CapEx", (OCF, CAPEX)),
)
BILLINGS = "derived from revenue + Δ(deferred revenue); deferred revenue sourced from ContractWithCustomerLiabilityCurrent (or DeferredRevenueCurrent) — current portion only"


def _entry(value: Column, **sources: Column) -> Column:
    """A map, so that a value that is missing shows as null and a source that is missing does not show."""
    pairs = F.array(*(F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in {"value": value, **sources}.items()))
    return F.map_from_entries(F.filter(pairs, lambda p: (p["key"] == "value") | (F.coalesce(p["value"], F.lit("")) != "")))


def payloads(variance: DataFrame, quality: DataFrame) -> DataFrame:
    """One JSON payload a ticker: every formatted value, where it came from or how it was derived and from
    which facts (<missing> where the variance row has no such id), and the flags of data quality."""

    def of(column: str) -> Column:
        named = source(column) if column in variance.columns else F.lit(MISSING)
        return F.concat(F.lit("forecast_model="), named) if column == MODEL else named

    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("fiscal_period", "latest_period_end")}
    cited = {"fact_id": F.col(REV), "accession": F.col("revenue_actual_accession"), "filing_url": F.when(F.col("revenue_actual_accession") != "", F.col("revenue_actual_filing_url"))}
    fields = [
        F.col("ticker"), F.coalesce("fiscal_year", F.lit(0)).alias("fiscal_year"), text["fiscal_period"].alias("fiscal_period"), F.substring(text["latest_period_end"], 1, 10).alias("latest_period_end"),
        *(_entry(form(c), **(cited if key == "revenue" else {})).alias(key) for key, c, form in ENTRIES),
        *(F.concat(F.lit(f"derived: {formula}. Sources: "), F.concat_ws(", ", *map(of, sources))).alias(key) for key, formula, sources in PROVENANCE),
        F.coalesce(F.nullif(MODEL, F.lit("")), F.lit("N/A")).alias(MODEL), F.lit(BILLINGS).alias("billings_provenance"),
        *(F.coalesce(c, F.lit(False)).alias(c) for c in ("has_restatement", "has_physical_inventory")),
    ]
    rows = variance.join(quality.select("ticker", "has_restatement", "has_physical_inventory"), "ticker", "left")
    return rows.select("ticker", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("payload"))


def _get(node: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(node, path, kind)


def nodes(json: Column) -> Column:
    """All objects, arrays and values of a JSON text, however deep, as an array of VARIANT. Each step of
    the fold replaces the frontier by its children; there are no more levels than opening brackets."""
    variants = "array<variant>"

    def children(v: Column) -> Column:
        return F.coalesce(F.map_values(_get(v, "$", "map<string,variant>")), _get(v, "$", variants), F.array().cast(variants))

    def step(s: Column, _: Column) -> Column:
        next_ = F.flatten(F.transform(s["frontier"], children))
        return F.struct(next_.alias("frontier"), F.concat(s["seen"], next_).alias("seen"))

    root = F.array(F.try_parse_json(json))
    levels = F.sequence(F.lit(1), F.greatest(F.lit(1), F.coalesce(F.regexp_count(json, F.lit(r"[\{\[]")), F.lit(0))))
    return F.aggregate(levels, F.struct(root.alias("frontier"), root.alias("seen")), step, lambda s: s["seen"])


def _string(node: Column, name: str) -> Column:
    """A member of an object if it is a string."""
    return F.when(F.schema_of_variant(_get(node, f"$.{name}", "variant")) == "STRING", _get(node, f"$.{name}", "string"))


def amount(s: Column) -> Column:
    """What a formatted amount or percentage says, null if it says none."""
    plain = F.regexp_replace(F.translate(s, ",$", ""), "^-+", "")
    unit = F.right(plain, F.lit(1))
    scale = F.when(unit == "K", 1e3).when(unit == "M", 1e6).when(unit == "B", 1e9)
    money = F.when(F.translate(s, ",$", "").startswith("-"), -1.0).otherwise(1.0) * F.regexp_replace(plain, "[KMB]$", "").try_cast("double") * F.coalesce(scale, F.lit(1.0))
    share = F.regexp_replace(s, "%+$", "").try_cast("double") / 100
    return F.when(s.contains("$"), money).when(s.contains("%"), share)


def payload_values(payload: DataFrame) -> DataFrame:
    """Values and accessions a text may use, from objects at any depth: ticker, values (sorted array of
    double), accessions. A text that is no JSON allows nothing."""
    rows = payload.select("ticker", nodes(F.col("payload")).alias("nodes"))
    values = F.transform("nodes", lambda v: amount(_string(v, "value")))
    accessions = F.transform("nodes", lambda v: _string(v, "accession"))
    return rows.select("ticker", F.array_sort(F.array_distinct(F.array_compact(values))).alias("values"), F.array_sort(F.array_distinct(F.filter(accessions, lambda a: a.isNotNull() & a.rlike(ACCESSION)))).alias("accessions"))


def positions(texts: DataFrame, kinds: dict[str, str], id: str = "id", text: str = "text") -> DataFrame:
    """A row for each token of each kind (name: pattern): id, kind, start, stop (code points), token. Tokens of a kind
    are marked in the text, which is cut at the marks; lengths summed along the cuts are positions."""
    clean = F.translate(F.coalesce(F.col(text), F.lit("")), "\x01", "\x02")
    cuts = F.array(*(F.struct(F.lit(k).alias("kind"), F.split(F.regexp_replace(clean, p, "\x01$0\x01"), "\x01").alias("parts")) for k, p in kinds.items()))
    rows = texts.select(id, F.inline(cuts)).select(id, "kind", F.posexplode("parts").alias("k", "token"))
    along = Window.partitionBy(id, "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("stop", F.sum(F.length("token").cast("long")).over(along)).where("k % 2 = 1")
    return rows.select(id, "kind", (F.col("stop") - F.length("token")).alias("start"), "stop", "token")


def bare_numbers(texts: DataFrame) -> DataFrame:
    """texts: id, text, one row an id. The first number of each that lies in no amount, percentage or year: id, token."""
    rows = positions(texts, {"bare": BARE, "dollar": DOLLAR, "percent": PERCENT, "year": YEAR})
    # a span that starts no later and reaches as far covers the number
    reach = F.max(F.when(F.col("kind") != "bare", F.col("stop"))).over(Window.partitionBy("id").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    open_ = rows.withColumn("reach", reach).where("kind = 'bare' AND coalesce(reach, -1) < stop")
    return open_.groupBy("id").agg(F.min_by("token", "start").alias("token"))


def _first(messages: Column) -> Column:
    return F.get(F.array_compact(messages), F.lit(0))


def _rules(text: Column, low: Column, values: Column, accessions: Column) -> Column:
    """The first rule that a text breaks, of those that need no positions; low: the text in lower case.
    All but the forbidden words need a digit, amounts a dollar and percentages their sign: what a text
    lacks is found by a plain search before any pattern runs."""

    def known(x: Column) -> Column:
        return F.exists(values, lambda v: F.abs(x - v) <= F.greatest(F.lit(ABSOLUTE), RELATIVE * F.abs(x), RELATIVE * F.abs(v)))

    words = F.coalesce(*(F.when(low.contains(w), F.lit(f"forbidden word: {w}")) for w in FORBIDDEN))
    some, part = text.contains("$"), text.contains("%")
    negative = F.when((some & text.rlike(PARENS_DOLLAR)) | (part & text.rlike(PARENS_PERCENT)), F.lit("negative in parentheses"))
    ahead = rf"({DOLLAR})(?=((?s:.{{0,{CITE_WITHIN}}})))"  # the look-ahead takes nothing from the next token
    money = F.arrays_zip(F.regexp_extract_all(text, F.lit(ahead), F.lit(1)).alias("token"), F.regexp_extract_all(text, F.lit(ahead), F.lit(2)).alias("after"))

    def judged(m: Column) -> Column:
        token = m["token"]
        cited = F.regexp_extract(m["after"], rf"\[({ACCESSION}(?:,\s*{ACCESSION})*)\]", 1)
        unknown = F.get(F.filter(F.regexp_extract_all(cited, F.lit(ACCESSION), F.lit(0)), lambda a: ~F.array_contains(accessions, a)), F.lit(0))
        return (
            F.when(~known(amount(token)), F.concat(F.lit("unknown amount: "), token)).when(cited == "", F.concat(F.lit("no citation: "), token))
            .when(unknown.isNotNull(), F.concat(F.lit("unknown citation: "), unknown))
        )

    shares = F.regexp_extract_all(text, F.lit(PERCENT), F.lit(0))
    share = F.transform(shares, lambda t: F.when(~known(amount(t)), F.concat(F.lit("unknown per cent: "), t)))
    return F.coalesce(words, F.when(_digits(text), F.coalesce(negative, F.when(some, _first(F.transform(money, judged))), F.when(part, _first(share)))))


def _digits(text: Column) -> Column:
    return text.rlike("[0-9]")


def guard(texts: DataFrame, allowed: DataFrame) -> DataFrame:
    """texts: ticker, text and more. allowed: ticker, values, accessions, one row a ticker. Adds violation, null where
    the text passes: forbidden words, negatives in parentheses, then amounts (unknown, not cited within 50 characters, or
    citing an unknown filing), percentages and bare numbers, each in the order of the text.

    Texts stay where they are read: what a ticker is allowed, a short row, is sent to them, so a ticker with most of
    the texts is no single task. Only texts that pass all other rules and hold something like a bare number are laid
    out by position, each different text once; the others are spread over the join by their partition, not gathered
    under one null. Null texts pass; a ticker that is not allowed anything has no known values."""
    none = F.array()
    own = allowed.select(F.col("ticker").alias("ticker_"), "values", "accessions")
    rows = texts.join(F.broadcast(own), F.col("ticker") == F.col("ticker_"), "left").withColumn("text_", F.coalesce("text", F.lit(""))).withColumn("low_", F.lower("text_"))
    rows = rows.withColumn("rule_", _rules(F.col("text_"), F.col("low_"), F.coalesce("values", none.cast("array<double>")), F.coalesce("accessions", none.cast("array<string>"))))
    # digits first: texts without any are asked no more
    rows = rows.withColumn("id_", F.when(_digits(F.col("text_")) & F.col("rule_").isNull() & F.col("text_").rlike(BARE), F.sha2("text_", 256)))
    asked = rows.where("id_ IS NOT NULL").groupBy(F.col("id_").alias("id")).agg(F.first("text_").alias("text"))
    found = bare_numbers(asked)
    rows = rows.withColumn("id_", F.coalesce("id_", F.spark_partition_id().cast("string"))).join(found, F.col("id_") == F.col("id"), "left")
    return rows.select(*texts.columns, F.coalesce("rule_", F.concat(F.lit("bare number: "), "token")).alias("violation"))


def violation(text: str, values: list[float], accessions: set[str], spark: SparkSession | None = None) -> str | None:
    """The guard on one text."""
    spark = spark or SparkSession.active()
    texts = spark.createDataFrame([("", text)], "ticker string, text string")
    allowed = spark.createDataFrame([("", [float(v) for v in values], sorted(accessions))], "ticker string, values array<double>, accessions array<string>")
    return guard(texts, allowed).first().violation


def token_audit(texts: DataFrame, text: str = "text") -> DataFrame:
    """Counts of number tokens and of forbidden words in each text, with built-in functions only."""
    t = F.coalesce(F.col(text), F.lit(""))
    bare = F.regexp_count(t, F.lit(BARE))
    words = sum((F.lower(t).contains(w).cast("int") for w in FORBIDDEN), F.lit(0))
    return texts.withColumns({"n_dollars": F.regexp_count(t, F.lit(DOLLAR)), "n_percents": F.regexp_count(t, F.lit(PERCENT)), "n_bare": bare, "n_forbidden": words})


def with_retries(write: Callable[[str | None], str], values: list[float], accessions: set[str], retries: int = 2) -> str:
    """Call write(feedback) until its text passes; raise after the last try."""
    feedback = None
    for _ in range(retries + 1):
        text = write(feedback)
        feedback = violation(text, values, accessions)
        if feedback is None:
            return text
    raise ValueError(feedback)


def best_model(models: DataFrame, family: str) -> DataFrame:
    """The model of a family with the greatest version: models has column id."""
    version = F.transform(F.regexp_extract_all("id", F.lit(r"(\d+)"), F.lit(1)), lambda v: v.cast("int"))
    return models.where(F.col("id").contains(family)).agg(F.max_by("id", F.struct(version, F.col("id"))).alias("id"))
