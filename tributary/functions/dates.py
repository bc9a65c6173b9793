"""Dates of the ledgers; impossible dates are null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions.text import only_digits, trim_all

#: Fixed value: the day of the registry snapshot.
SNAPSHOT = "2025-12-31"
#: Registry dates that mean none.
NO_DATE = ("", "0", "00000000", "<NA>")


def ledger_date(c: Column, trimmed: bool = False) -> Column:
    """Day first with slashes, else ISO, as a timestamp without zone. Each text is parsed once, by the pattern its marks call for.
    trimmed: c has no white space around it."""
    t = c if trimmed else trim_all(c)
    read = lambda pattern: F.try_to_timestamp(t, F.lit(pattern))
    part = lambda a, n: F.substring(t, a, n)
    # Two digits for day and month, four for the year: taken apart, which needs a third of the time of a pattern.
    slashes, iso = t.rlike("^[0-9]{2}/[0-9]{2}/[1-9][0-9]{3}$"), t.rlike("^[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}$")
    day = F.when(slashes, F.concat(part(7, 4), F.lit("-"), part(4, 2), F.lit("-"), part(1, 2))).otherwise(t).try_cast("date").cast("timestamp_ntz")
    return F.when(slashes | iso, day).otherwise(F.when(F.contains(t, F.lit("/")), read("d/M/yyyy")).when(F.contains(t, F.lit(":")), read("yyyy-M-d H:m:s")).otherwise(read("yyyy-M-d")).cast("timestamp_ntz"))


def registry_date(c: Column, trimmed: bool = False) -> Column:
    """Eight digits, year first. trimmed: c has no white space around it."""
    t = c if trimmed else trim_all(c)
    part = lambda a, n: F.substring(t, a, n)
    return F.when(t.rlike("^[0-9]{8}$") & (t > "0001"), F.concat(part(1, 4), F.lit("-"), part(5, 2), F.lit("-"), part(7, 2)).try_cast("date"))


def day_number(eight: Column) -> Column:
    """A text yyyymmdd as a number; null of any other text. It names the text often: for a column."""
    return F.when((F.length(eight) == 8) & only_digits(eight), eight.try_cast("int"))


def day_of(number: Column, first_year: int = 1) -> Column:
    """The day of a day_number, without reading a text again; null if there is none, or none from first_year on."""
    y, m, d = (number / 10_000).cast("int"), (number / 100).cast("int") % 100, number % 100
    leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    right = (y >= first_year) & (m >= 1) & (m <= 12) & (d >= 1) & ((d <= 28) | ((d <= 30) & (m != 2)) | ((d == 31) & m.isin(1, 3, 5, 7, 8, 10, 12)) | ((d == 29) & leap))
    return F.when(right, F.make_date(y, m, d))


def plain_eight(t: Column) -> Column:
    """dd/mm/yyyy or yyyy-mm-dd as yyyymmdd, whatever stands in the places of the digits; null of other shapes."""
    part = lambda a, n: F.substring(t, a, n)
    marks = lambda a, b, mark: (F.length(t) == 10) & (part(a, 1) == mark) & (part(b, 1) == mark)
    return F.when(marks(3, 6, "/"), F.concat(part(7, 4), part(4, 2), part(1, 2))).when(marks(5, 8, "-"), F.concat(part(1, 4), part(6, 2), part(9, 2)))


def ledger_day(t: Column, number: Column) -> Column:
    """ledger_date of a trimmed text whose day_number of plain_eight is known. Years below 1000 and other shapes go by patterns."""
    return F.when(number >= 1000_00_00, day_of(number, 1000).cast("timestamp_ntz")).otherwise(ledger_date(t, trimmed=True))


def registry_date_invalid(c: Column) -> Column:
    """Given, but no date."""
    t = trim_all(c)
    return t.isNotNull() & ~t.isin(*NO_DATE) & registry_date(c).isNull()


def try_date(c: Column) -> Column:
    return c.try_cast("date")


def age_days(start: Column, snapshot: str = SNAPSHOT) -> Column:
    """Days from start to the snapshot, 0 at least; null without a start."""
    return F.when(start.isNotNull(), F.greatest(F.datediff(F.lit(snapshot).cast("date"), start), F.lit(0))).cast("long")
