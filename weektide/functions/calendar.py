"""ISO-week calendar as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def iso_monday(year: Column | str, week: Column | str) -> Column:
    """First day of an ISO week; null when the year has no such week."""
    y, w = _col(year).cast("int"), _col(week).cast("int")
    # 4 January always lies in week 1; years outside the calendar become null, not an error.
    jan4 = F.make_date(F.when(y.between(1, 9999), y), F.lit(1), F.lit(4))
    monday = F.date_add(jan4, (w - 1) * 7 - F.weekday(jan4))
    return F.when(w.between(1, 52) | ((w == 53) & (F.weekofyear(monday) == 53)), monday)


def iso_sunday(year: Column | str, week: Column | str) -> Column:
    """Last day of an ISO week; null when the year has no such week."""
    return F.date_add(iso_monday(year, week), 6)


def week_date(year: Column | str, week: Column | str, anchor: str = "monday") -> Column:
    """Date of an ISO week on the wanted anchor day (``monday`` or ``sunday``)."""
    if anchor not in ("monday", "sunday"):
        raise ValueError(f"Unknown week anchor: {anchor}")
    return iso_monday(year, week) if anchor == "monday" else iso_sunday(year, week)


def weeks_in_year(year: Column | str) -> Column:
    """Number of ISO weeks of a year: 28 December always lies in the last one."""
    return F.weekofyear(F.make_date(_col(year).cast("int"), F.lit(12), F.lit(28)))


def last_open_week(year: Column | str, current_year: int, current_week: int) -> Column:
    """Last week that can have been reported: the current week for the current year, else the last."""
    y = _col(year)
    longest = weeks_in_year(y)
    return F.when(y == current_year, F.least(F.lit(current_week), longest)).otherwise(longest)


def iso_year(date: Column | str) -> Column:
    """ISO year a date belongs to."""
    return F.extract(F.lit("YEAROFWEEK"), _col(date)).cast("int")


def iso_week(date: Column | str) -> Column:
    """ISO week a date belongs to."""
    return F.weekofyear(_col(date))


def period_label(year: Column | str, week: Column | str) -> Column:
    """``YYYY-Www`` label; null when either part is null."""
    y, w = _col(year).cast("int"), _col(week).cast("int")
    return F.when(y.isNotNull() & w.isNotNull(), F.format_string("%d-W%02d", y, w))


def period_number(year: Column | str, week: Column | str) -> Column:
    """year*100+week: orders periods as one number."""
    return _col(year).cast("bigint") * 100 + _col(week).cast("bigint")
