"""Column expressions shared by the operators and plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def one_if(condition: Column) -> Column:
    """1 where the condition holds, else 0; an unknown condition counts as 0."""
    return F.when(condition, 1).otherwise(0)


def count_if(condition: Column) -> Column:
    return F.sum(one_if(condition))


def band(value: Column, steps: Sequence[tuple[object, str]], top: str, inclusive: bool = False) -> Column:
    """Label of the first band whose upper bound lies above the value.

    With ``inclusive`` a value equal to the bound still belongs to the band. A
    null value falls through to the top label, as in a chain of comparisons.
    """
    (upper, label), *more = steps
    chain = F.when(value <= upper if inclusive else value < upper, label)
    for upper, label in more:
        chain = chain.when(value <= upper if inclusive else value < upper, label)
    return chain.otherwise(top)


def share(condition: Column) -> Column:
    """Aggregate: matching rows over all rows, null for no rows."""
    return F.try_divide(count_if(condition), F.count("*"))


def cents(amount: Column) -> Column:
    """Whole cents of an amount that is a double with two decimals.

    Sums of them are exact and stay in long arithmetic, several times faster
    than sums of wide decimals. `money` turns the totals back.
    """
    return F.floor(amount * 100 + 0.5)


def money(whole_cents: Column) -> Column:
    """Whole cents as a decimal amount."""
    return (whole_cents.cast("decimal(24,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(26,2)")


def percent_text(ratio: Column, digits: int = 1) -> Column:
    """0.6 -> '60.0%'."""
    return F.concat(F.round(ratio * 100, digits).cast("string"), F.lit("%"))


def first_char(text: Column) -> Column:
    return F.substring(text, 1, 1)


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def in_year(day: Column, year: int) -> Column:
    """A date range instead of year(day) = y, so that it reaches the scan."""
    return between(day, f"{year}-01-01", f"{year}-12-31")


def between(day: Column, first: str, last: str) -> Column:
    return (day >= date(first)) & (day <= date(last))


def date(text: str) -> Column:
    return F.lit(text).cast("date")


def month_number(day: Column) -> Column:
    """Months counted through, so that neighbouring months differ by one."""
    return F.year(day) * 12 + F.month(day)


def epoch_second(at: Column) -> Column:
    """Whole seconds since 1970 of a time without zone, whatever the session zone."""
    of_day = F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)
    return F.unix_date(at.cast("date")).cast("bigint") * 86400 + of_day
