"""Reporting-period and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import FINANCIAL_YEAR_START_MONTH, PERIOD_PREFIX


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_period(period, prefix: str = PERIOD_PREFIX) -> Column:
    """``RTT-January-2026`` / ``RTT-January 2026`` -> first day of the month.

    Unparseable text gives NULL (``try_to_date``), never an error.
    """
    text = F.replace(F.regexp_replace(_c(period), f"^{prefix}", ""), F.lit("-"), F.lit(" "))
    return F.try_to_date(text, "MMMM yyyy")


def financial_year(date, start_month: int = FINANCIAL_YEAR_START_MONTH) -> Column:
    """Financial year label ``YYYY-YY`` for a year starting in ``start_month``."""
    y = F.year(F.add_months(_c(date), -(start_month - 1)))
    return F.concat(y.cast("string"), F.lit("-"), F.lpad(F.pmod(y + 1, F.lit(100)).cast("string"), 2, "0"))


def month_code(date) -> Column:
    """Short month code used in release file names: ``Jan26``."""
    return F.date_format(_c(date), "MMMyy")


def month_name(date) -> Column:
    return F.date_format(_c(date), "MMMM")


def month_label(date) -> Column:
    return F.date_format(_c(date), "MMM yyyy")


def calendar_attrs(date) -> dict[str, Column]:
    d = _c(date)
    return {
        "calendar_year": F.year(d).cast("bigint"),
        "calendar_month": F.month(d).cast("bigint"),
        "month_name": month_name(d),
        "month_label": month_label(d),
    }


def raw_path(fy, month, file, template: str = "raw/rtt/{fy}/{month}/{file}") -> Column:
    """Object path for a landed raw file, e.g. raw/rtt/2025-26/Jan26/x.zip."""
    parts = template.split("{")
    out = []
    cols = {"fy": _c(fy), "month": _c(month), "file": _c(file)}
    for i, p in enumerate(parts):
        if i == 0:
            if p:
                out.append(F.lit(p))
            continue
        key, rest = p.split("}", 1)
        out.append(cols[key])
        if rest:
            out.append(F.lit(rest))
    return F.concat(*out)


#: How files and folders name a month.
MONTH_CODE_PATTERN = r"(?i)(?<![a-z])((?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[0-9]{2})(?![0-9a-z])"


def month_of_path(path: Column) -> Column:
    """The month code that a file's path names (the last one in it), or NULL."""
    codes = F.regexp_extract_all(path, F.lit(MONTH_CODE_PATTERN), F.lit(1))
    return F.initcap(F.get(codes, F.size(codes) - 1))


def year_of_month(code: Column) -> Column:
    """Financial year of a month code."""
    return financial_year(F.try_to_timestamp(F.concat(F.lit("01"), code), F.lit("ddMMMyy")).cast("date"))
