"""Restatements, missing coverage, data quality and the refusal gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import truthy
from ..functions.vocab import LOAD_BEARING


_PERIOD = ("ticker", "line_item", "period_end", "period_type", "frame")


def _amended(form: Column) -> Column:
    return form.like("%/A")


def _met(new: Column, old: Column, absolute: float, relative: float) -> Column:
    """new amends old: of one base form, filed later, and materially different."""
    diff = F.abs(new["value"] - old["value"])
    material = (diff > absolute) | (diff / F.nullif(F.abs(old["value"]), F.lit(0.0)) > relative)
    same = F.regexp_replace(new["form_type"], "/A$", "") == F.regexp_replace(old["form_type"], "/A$", "")
    return _amended(new["form_type"]) & ~_amended(old["form_type"]) & same & (old["filed_date"] < new["filed_date"]) & material


def _filings(facts: DataFrame) -> DataFrame:
    """All filings of a fact, as an array a (ticker, item, period, frame): what the rules of restatement compare."""
    own = F.struct("form_type", "filed_date", "accession_no", "fact_id", "value", "fiscal_year", "fiscal_period")
    return facts.groupBy(*_PERIOD).agg(F.collect_list(own).alias("filings"))


def restatements(facts: DataFrame, absolute: float = 10_000, relative: float = 0.001) -> DataFrame:
    """Amendments whose value differs materially from the latest earlier filing of their base form.
    Filings are compared inside their group, so facts are read and shuffled once."""
    rows = _filings(facts.where(" AND ".join(f"{c} IS NOT NULL" for c in _PERIOD))).where(F.exists("filings", lambda x: _amended(x["form_type"])))

    def found(new: Column) -> Column:
        old = F.filter("filings", lambda o: _met(new, o, absolute, relative))
        best = F.array_max(F.transform(old, lambda o: F.struct(o["filed_date"].alias("date"), o["accession_no"].alias("no"), o["value"].alias("value"))))
        return F.struct(new["accession_no"].alias("accession_no"), best.alias("old"), new.alias("new"))

    pairs = F.array_sort(F.transform("filings", found))
    pairs = F.filter(pairs, lambda p: p["old"].isNotNull())
    rows = rows.select(*_PERIOD, pairs.alias("pairs"))
    last = F.filter("pairs", lambda p, i: (i == F.size("pairs") - 1) | ~p["accession_no"].eqNullSafe(F.get(F.col("pairs"), i + 1)["accession_no"]))
    rows = rows.select(*_PERIOD, F.explode(last).alias("p"))
    diff = F.abs(F.col("p.new.value") - F.col("p.old.value"))
    return rows.select(
        *_PERIOD, F.col("p.new.fiscal_year"), F.col("p.new.fiscal_period"), F.col("p.new.value").alias("amended_value"), F.col("p.accession_no").alias("amending_accession_no"),
        F.col("p.new.filed_date").alias("amendment_date"), F.col("p.old.value").alias("original_value"), F.col("p.old.no").alias("original_accession_no"),
        F.col("p.old.date").alias("original_date"), diff.alias("abs_diff"), (diff / F.nullif(F.abs("p.old.value"), F.lit(0.0))).alias("rel_diff"),
    )


_CELL = ("fiscal_year", "fiscal_period", "period_end", "line_item")


def _absent(cells: Column, items: Column) -> Column:
    """Complement of a ticker's cells (quarter, item) in its quarters times its items."""
    quarters = F.array_distinct(F.transform(cells, lambda c: F.struct(*(c[n].alias(n) for n in _CELL[:3]))))
    whole = F.flatten(F.transform(quarters, lambda q: F.transform(items, lambda i: F.struct(*(q[n].alias(n) for n in _CELL[:3]), i.alias("line_item")))))
    return F.array_except(whole, cells)


def missing_coverage(facts: DataFrame) -> DataFrame:
    """(quarter, item) cells of a ticker in which it has no fact, of the quarters and items it has. The
    cells are a set a ticker, formed before the shuffle, of which the complement is taken in place."""
    cell = F.when(F.col("period_type") == "Q", F.struct(*_CELL))
    rows = facts.groupBy("ticker").agg(F.collect_set(cell).alias("cells"), F.collect_set("line_item").alias("items"))
    return rows.select("ticker", F.inline(_absent(F.col("cells"), F.col("items")))).select("ticker", "line_item", "fiscal_year", "fiscal_period", "period_end")


def missing_per_item(missing: DataFrame) -> DataFrame:
    """How many quarters of each item a ticker lacks."""
    return missing.groupBy("ticker", "line_item").agg(F.count("*").alias("missing_quarters"))


def null_accessions(sources: DataFrame) -> DataFrame:
    """Rows of a ticker's sources, and how many of them name no filing."""
    return sources.groupBy("ticker").agg(F.count("*").alias("n_sources"), F.count_if(F.col("accession_no").isNull()).alias("n_null_accessions"))


def data_quality(facts: DataFrame, absolute: float = 10_000, relative: float = 0.001) -> DataFrame:
    """One row of counts and flags for each ticker, from one pass over the facts: filings are grouped as
    for restatements, then each ticker's groups become sums, sets and flags."""
    rows = _filings(facts)
    restated = F.exists("filings", lambda new: F.exists("filings", lambda old: _met(new, old, absolute, relative)))
    keyed = F.forall(F.array(*_PERIOD), lambda k: k.isNotNull())
    cells = F.when(F.col("period_type") == "Q", F.array_distinct(F.transform("filings", lambda x: F.struct(x["fiscal_year"].alias("fiscal_year"), x["fiscal_period"].alias("fiscal_period"), F.col("period_end"), F.col("line_item")))))
    rows = rows.select(
        "ticker", "line_item", F.size("filings").alias("n"), F.exists("filings", lambda x: x["value"].isNotNull()).alias("valued"), (keyed & F.coalesce(restated, F.lit(False))).alias("restated"),
        F.array_distinct(F.transform("filings", lambda x: x["fiscal_year"])).alias("years"), cells.alias("cells"),
    )

    def has(item: str):
        return F.coalesce(F.bool_or((F.col("line_item") == item) & F.col("valued")), F.lit(False)).alias

    def united(sets: str) -> Column:
        return F.array_distinct(F.flatten(F.collect_set(sets)))

    made = rows.groupBy("ticker").agg(
        F.sum("n").alias("total_facts"), F.collect_set("line_item").alias("items"), united("years").alias("years"), united("cells").alias("cells"),
        has("Inventory")("has_physical_inventory"), has("GoingConcernDoubt")("has_going_concern_doubt"), has("MaterialWeakness")("has_material_weakness"),
        F.bool_or("restated").alias("has_restatement"),
    )
    gaps = F.filter(_absent(F.col("cells"), F.array_intersect("items", F.array(*map(F.lit, LOAD_BEARING)))), lambda c: c["fiscal_year"].isNotNull() & c["fiscal_period"].isNotNull())
    labels = F.array_sort(F.array_distinct(F.transform(gaps, lambda c: F.concat(F.lit("FY"), c["fiscal_year"].cast("string"), c["fiscal_period"]))))
    years = F.array_compact("years")
    return made.select(
        "ticker", "total_facts", F.size("items").cast("long").alias("distinct_line_items"), F.size(years).cast("long").alias("distinct_fiscal_years"),
        F.array_min(years).alias("min_fiscal_year"), F.array_max(years).alias("max_fiscal_year"), "has_physical_inventory", "has_going_concern_doubt", "has_material_weakness",
        "has_restatement", F.when(F.size(labels) > 0, F.array_join(labels, ",")).alias("missing_quarters"),
    )


def refusals(quality: DataFrame, variance: DataFrame) -> DataFrame:
    """Why no text may be written about a ticker, or null: the first reason that holds."""
    rows = variance.select("ticker", "fiscal_year", "fiscal_period").join(quality, "ticker", "full")
    reason = (
        F.when(truthy("has_restatement"), "restatement")
        .when(truthy("has_going_concern_doubt"), "going_concern")
        .when(truthy("has_material_weakness"), "material_weakness")
        .when(F.trim(F.coalesce("missing_quarters", F.lit(""))) != "", "missing_quarters")
        .when(F.col("fiscal_year").isNull() | F.col("fiscal_period").isNull(), "no_period")
    )
    return rows.select("ticker", reason.alias("refusal_reason"))


def duplicate_facts(facts: DataFrame) -> DataFrame:
    """Keys that hold more than one fact."""
    return facts.groupBy("ticker", "line_item", "period_end", "period_type", "frame").agg(F.count("*").alias("n_facts")).where("n_facts > 1")
