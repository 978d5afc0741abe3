"""Formatting and parsing of amounts, and small scalar rules, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fiscal import col

MISSING = "<missing>"


def _plain(x: Column, digits: int) -> Column:
    return F.replace(F.format_number(x, digits), F.lit(","), F.lit(""))


def dollars(x) -> Column:
    """$1.2B, $3.4M, $5K and so on, the sign in front; null and NaN give null. Thousands are
    written out whole, not in scientific notation."""
    x = F.nanvl(col(x).cast("double"), F.lit(None).cast("double"))
    a = F.abs(x)
    body = (
        F.when(a >= 1e9, F.concat(F.lit("$"), _plain(a / 1e9, 1), F.lit("B")))
        .when(a >= 1e6, F.concat(F.lit("$"), _plain(a / 1e6, 1), F.lit("M")))
        .when(a >= 1e3, F.concat(F.lit("$"), _plain(a / 1e3, 0), F.lit("K")))
        .otherwise(F.concat(F.lit("$"), _plain(a, 0)))
    )
    return F.when(x.isNull(), None).otherwise(F.concat(F.when(x < 0, "-").otherwise(""), body))


def percent(x) -> Column:
    x = F.nanvl(col(x).cast("double"), F.lit(None).cast("double"))
    return F.when(x.isNotNull(), F.concat(_plain(x * 100, 1), F.lit("%")))


def parse_dollars(s) -> Column:
    """Amount of the first -$1.2B-like token of a string, or null."""
    s = col(s)
    number = F.regexp_extract(s, r"-?\$(\d+(?:\.\d+)?)([KMB]?)", 1).try_cast("double")
    unit = F.regexp_extract(s, r"-?\$(\d+(?:\.\d+)?)([KMB]?)", 2)
    sign = F.when(F.regexp_extract(s, r"(-?)\$\d", 1) == "-", -1.0).otherwise(1.0)
    return sign * number * F.when(unit == "K", 1e3).when(unit == "M", 1e6).when(unit == "B", 1e9).otherwise(1.0)


def parse_percent(s) -> Column:
    """Fraction of the first 1.2%-like token, or null."""
    return F.regexp_extract(col(s), r"(-?\d+(?:\.\d+)?)%", 1).try_cast("double") / 100


def truthy(x) -> Column:
    return F.coalesce(F.lower(F.trim(col(x).cast("string"))).isin("true", "1", "yes", "y", "t"), F.lit(False))


def source(x) -> Column:
    return F.coalesce(F.when(F.trim(col(x)) != "", col(x)), F.lit(MISSING))


def clamp(x, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), col(x)))


def safe_ratio(a, b) -> Column:
    return col(a) / F.nullif(col(b), F.lit(0).cast("double"))


def growth(now, base, signed: bool = False) -> Column:
    """(now - base) / base, or over |base|; null where the base is 0 or missing."""
    base = col(base)
    return safe_ratio(col(now) - base, F.abs(base) if signed else base)


def provenance(concept) -> Column:
    return F.when(F.lower(F.coalesce(col(concept), F.lit(""))).contains("derived"), "derived").otherwise("reported")


def zero_padded(x, width: int = 10) -> Column:
    return F.lpad(col(x).cast("string"), width, "0")


def version_key(model_id) -> Column:
    """The numbers of an identifier, comparable as an array."""
    return F.transform(F.regexp_extract_all(col(model_id), F.lit(r"(\d+)"), F.lit(1)), lambda v: v.cast("int"))


def without_leading_comment(s) -> Column:
    return F.regexp_replace(col(s), r"(?s)\A<!--.*?-->\s*", "")


def period_label(fy, fp) -> Column:
    return F.concat(col(fp), F.lit("/FY"), col(fy).cast("string"))
