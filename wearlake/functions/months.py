"""Calendar-month arithmetic as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: leftover days from which the archive's dictionary counts a month
CHRONOLOGICAL_DAYS = 16


def completed_months(birth: Column, day: Column) -> Column:
    """Whole calendar months from ``birth`` to ``day``; negative before birth.

    Adding the difference of the calendar months to ``birth`` lands in the month of
    ``day``, on the birth's day of month or on the month's last day. Where that lies
    beyond ``day`` (seen from birth), the last month is not complete. Null if either
    date is null.
    """
    born, at = F.to_date(birth), F.to_date(day)
    span = (F.year(at) - F.year(born)) * 12 + F.month(at) - F.month(born)
    ahead = F.dayofmonth(born) - F.dayofmonth(at)
    too_late = (ahead > 0) & (at != F.last_day(at))
    return F.when(at >= born, span - too_late.cast("int")).otherwise(
        span + (ahead < 0).cast("int")
    )


def chronological_months(birth: Column, day: Column) -> Column:
    """Completed months, plus one if at least 16 further days have passed."""
    born, at = F.to_date(birth), F.to_date(day)
    months = completed_months(birth, day)
    left_over = F.datediff(at, F.add_months(born, months))
    return (months + (left_over >= CHRONOLOGICAL_DAYS).cast("int")).cast("int")


def age_in_months(birth: Column, day: Column, rounding: str = "floor") -> Column:
    """Age by either rule: ``floor`` or ``chronological``."""
    rules = {"floor": completed_months, "chronological": chronological_months}
    return rules[rounding](birth, day)
