"""Fiscal-calendar arithmetic as column expressions. fe: the month in which a fiscal year ends."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


def snap_to_quarter_end(d, fe) -> Column:
    """The last day of the first month, from d's on, that ends a fiscal quarter."""
    d = col(d).cast("date")
    return F.last_day(F.add_months(F.trunc(d, "MM"), F.pmod(col(fe) - F.month(d), F.lit(3)).cast("int")))


def fiscal_year_of(d, fe) -> Column:
    d = col(d).cast("date")
    return F.year(d) + (F.month(d) > col(fe)).cast("int")


def fiscal_quarter_of(d, fe) -> Column:
    """1 to 4."""
    return (F.lit(4) - F.floor(F.pmod(col(fe) - F.month(col(d).cast("date")), F.lit(12)) / 3)).cast("int")


def fiscal_label(d, fe) -> tuple[Column, Column]:
    """Fiscal year, and Q1 to Q4, of a date."""
    return fiscal_year_of(d, fe), F.concat(F.lit("Q"), fiscal_quarter_of(d, fe).cast("string"))


def calendar_of(fy, fp, fe) -> tuple[Column, Column]:
    """Calendar year and quarter in which a fiscal period ends; FY ends with the year."""
    q = F.coalesce(F.expr("try_cast(null as int)"), F.when(col(fp) == "FY", F.lit(4)).otherwise(F.substring(col(fp), 2, 1).try_cast("int")))
    month = col(fe) + (q - 4) * 3
    year = col(fy) - (month <= 0).cast("int")
    month = F.when(month <= 0, month + 12).otherwise(month)
    return year.cast("int"), F.ceil(month / 3).cast("int")


def shift_quarters(d, n: int) -> Column:
    return F.add_months(col(d).cast("date"), 3 * n)


def calendar_quarter(d) -> Column:
    return F.quarter(col(d).cast("date"))
