"""Money, ratios and other numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions.text import clean


def mark_count(c: Column, mark: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(mark), F.lit("")))


def money(c: Column) -> Column:
    """Brazilian and international amounts as double; null if it is none.

    Of two kinds of separators the last one is the decimal one; several of one kind separate thousands; a single one is
    the decimal one.
    """
    t = amount_marks(clean(c))
    return plain_money(t, mark_count(t, ","), mark_count(t, "."))


def is_plain_number(c: Column) -> Column:
    """Digits, with one point among them at most: money has nothing to tell apart there."""
    return c.rlike(r"^-?[0-9]+(?:\.[0-9]+)?$")


def amount_marks(c: Column) -> Column:
    """What money reads of a text: digits, separators and signs."""
    return F.regexp_replace(c, r"[^0-9,.\-]", "")


def plain_money(t: Column, commas: Column, dots: Column) -> Column:
    """money of amount_marks and the separators in them, for those who make these in projections of their own: they are used
    ten times."""
    without = lambda mark: F.replace(t, F.lit(mark), F.lit(""))
    comma_last = F.instr(F.reverse(t), ",") < F.instr(F.reverse(t), ".")
    plain = (
        F.when((commas > 0) & (dots > 0), F.when(comma_last, F.replace(without("."), F.lit(","), F.lit("."))).otherwise(without(",")))
        .when(commas > 1, without(","))
        .when(commas == 1, F.replace(t, F.lit(","), F.lit(".")))
        .when(dots > 1, without("."))
        .otherwise(t)
    )
    return plain.try_cast("double")


def invalid(raw: Column, parsed: Column) -> Column:
    """Given but not understood."""
    return clean(raw).isNotNull() & parsed.isNull()


def number(c: Column) -> Column:
    """As double; null if it is none."""
    return c.try_cast("double")


def finite(c: Column) -> Column:
    """NaN and the infinities become null."""
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def ratio(n: Column, d: Column) -> Column:
    """Null unless the denominator is above 0."""
    return F.when(d > 0, n / d)


def log1p_positive(c: Column) -> Column:
    return F.log1p(F.greatest(F.coalesce(c, F.lit(0)), F.lit(0)).cast("double"))


def years(days: Column) -> Column:
    return F.coalesce(days, F.lit(0)) / F.lit(365.25)
