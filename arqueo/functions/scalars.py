"""Scalar column functions used by the reports (all native Spark expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import col

MONTH_FORMAT = "MM/yyyy"


def zfill(c: str | Column, width: int = 5) -> Column:
    """Left-pad with zeros but never shorten (``lpad`` alone truncates)."""
    c = col(c)
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, "0"))


def month_of(d: str | Column) -> Column:
    """Date/timestamp -> ``'MM/YYYY'`` text."""
    return F.date_format(col(d), MONTH_FORMAT)


def year_of(d: str | Column) -> Column:
    """Date/timestamp -> fiscal year as text (``'2024'``)."""
    return F.year(col(d)).cast("string")


def month_start(mes: str | Column) -> Column:
    """``'MM/YYYY'`` text -> first day of that month (DATE), for ordering."""
    return F.to_date(col(mes), MONTH_FORMAT)


def year_from_month(mes: str | Column) -> Column:
    """Last four characters of ``'MM/YYYY'``."""
    return F.substring(col(mes), -4, 4)


def add_one_month(d: str | Column) -> Column:
    """One calendar month later, clipping the day to the month end."""
    return F.add_months(col(d), 1)


def shift_year(y: str | Column, n: int = -1) -> Column:
    """Fiscal year text moved ``n`` years (``'2024'`` -> ``'2023'``)."""
    return (col(y).cast("int") + F.lit(n)).cast("string")


def voucher_number(nro: str | Column, fund_year: str | Column) -> Column:
    """Voucher ``NNNNN/YY`` built from a number and a 4-digit year."""
    return F.concat(zfill(col(nro).cast("string"), 5), F.lit("/"), F.substring(col(fund_year), 3, 2))


def voucher_int_text(nro: str | Column) -> Column:
    """``'02749/11'`` -> ``'2749'`` (number part without leading zeros)."""
    return F.substring_index(col(nro), "/", 1).cast("int").cast("string")


def strip_code_prefix(c: str | Column) -> Column:
    """Remove a leading ``digits-digits`` code and surrounding blanks."""
    return F.trim(F.regexp_replace(col(c), r"^\d+-\d+", ""))


def is_numeric_prefix(c: str | Column, length: int = 3) -> Column:
    """True when the first ``length`` characters are 1-``length`` digits."""
    return F.coalesce(F.substring(col(c), 1, length).rlike(rf"^[0-9]{{1,{length}}}$"), F.lit(False))


def near_zero(c: str | Column, tol: float = 1e-8) -> Column:
    return F.abs(col(c)) <= F.lit(tol)


def safe_percent(num: str | Column, den: str | Column) -> Column:
    """``num / den * 100`` in DOUBLE; NULL where ``den`` is 0 or NULL."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double")) * F.lit(100.0)


def money(c: str | Column) -> Column:
    """Money is carried as DECIMAL(18,2) inside the engine."""
    return col(c).cast("decimal(18,2)")


def any_flag(*flags: str | Column) -> Column:
    """OR of boolean flags; NULL flags count as False."""
    out = F.lit(False)
    for f in flags:
        out = out | F.coalesce(col(f), F.lit(False))
    return out
