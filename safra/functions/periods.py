"""Column expressions over dates and period codes. A period is an integer YYYYMM, month 0 for a whole year."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMATS = ["yyyy-M-d", "yyyyMMdd", "ddMMyyyy", "d/M/yyyy"]


def parse_date(text: Column) -> Column:
    """First of four formats that fits; strict about digits, unlike C's strptime."""
    t = F.trim(text)
    shaped = [r"^\d{4}-\d{1,2}-\d{1,2}$", r"^\d{8}$", r"^\d{8}$", r"^\d{1,2}/\d{1,2}/\d{4}$"]
    return F.coalesce(*[F.when(t.rlike(s), F.try_to_date(t, f)) for f, s in zip(DATE_FORMATS, shaped, strict=True)])


def date_format(code: Column) -> Column:
    """Aggregate: YYMM, YYYY or YY for a group of date codes (null without any)."""
    four = F.length(code) == 4
    n = F.count_if(four)
    months = F.count_if(four & F.substring(code, 3, 2).try_cast("int").between(1, 12))
    years = F.bool_and(F.when(four, F.substring(code, 1, 2).try_cast("int").between(19, 20)))
    return F.when(F.count(code) == 0, F.lit(None)).when(n == 0, "YY").when(months / n > 0.8, "YYMM").when(years, "YYYY").otherwise("YY")


def normalize(code: Column, fmt: Column) -> Column:
    """Period of a date code; two-digit years pivot at 70; an impossible month gives 0."""
    n = code.try_cast("long")
    century = lambda y: y + F.when(y < 70, 2000).otherwise(1900)
    year, month = F.floor(n / 100), n % 100
    return (
        F.when(fmt == "YY", century(n) * 100)
        .when(fmt == "YYMM", F.when(month.between(1, 12), century(year) * 100 + month).otherwise(0))
        .when(fmt == "YYYY", n * 100)
        .when(fmt.isNotNull() & code.isNotNull(), 0)
        .cast("long")
    )


def display(period: Column) -> Column:
    """``Mon YYYY``, or ``YYYY`` for a whole year."""
    year, month = F.floor(period / 100).cast("int"), (period % 100).cast("int")
    return F.when(month == 0, year.cast("string")).otherwise(F.date_format(F.make_date(year, month, F.lit(1)), "MMM yyyy"))


def display_range(first: Column, last: Column) -> Column:
    known = (first > 0) & (last > 0)
    return F.when(known & (first == last), display(first)).when(known, F.concat_ws(" to ", display(first), display(last)))


def ordinal(period: Column, fmt: Column) -> Column:
    """A number that grows by one from a period to the next of its format."""
    year = F.floor(period / 100)
    return F.when(fmt == "YYMM", year * 12 + period % 100).otherwise(year).cast("long")


def from_ordinal(n: Column, fmt: Column) -> Column:
    monthly = F.floor((n - 1) / 12) * 100 + (n - 1) % 12 + 1
    return F.when(fmt == "YYMM", monthly).otherwise(n * 100).cast("long")


def calendar(first: Column, last: Column, fmt: Column) -> Column:
    """Array of all periods from first to last, 5000 at most."""
    a, b = ordinal(first, fmt), ordinal(last, fmt)
    return F.transform(F.sequence(a, F.least(b, a + 4999)), lambda n: from_ordinal(n, fmt))


def period_kind(period_id: Column) -> Column:
    """Struct ``ord, kind`` of a period id by its digits: Y, YM, YMD or UNK (no ordinal)."""
    digits = F.regexp_replace(period_id, "[^0-9]", "")
    size = F.length(digits)
    return F.struct(
        F.when(size == 4, digits.cast("long") * 100).when(size.isin(6, 8), digits.cast("long")).alias("ord"),
        F.when(size == 4, "Y").when(size == 6, "YM").when(size == 8, "YMD").otherwise("UNK").alias("kind"),
    )


def year_month(period_id: Column) -> Column:
    """Struct ``year, month`` of a period id of digits only."""
    numeric = period_id.rlike(r"^[0-9]+$")
    return F.struct(
        F.when(numeric & (F.length(period_id) >= 4), F.substring(period_id, 1, 4).try_cast("int")).alias("year"),
        F.when(numeric & (F.length(period_id) >= 6), F.substring(period_id, 5, 2).try_cast("int")).alias("month"),
    )
