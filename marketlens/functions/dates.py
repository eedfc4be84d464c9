"""Date and time expressions (X-01 .. X-08, X-21). All return Columns.

Semantics kept from the reference (SURVEY 1.4):
* a text cutoff ``ts <= 'YYYY-MM-DD'`` excludes that whole day -> ``before(ts, d)``
  is ``ts < DATE d``;
* SQLite ``DATE(x, '-6 months')`` overflows short months (31 Aug -6 months = 3 Mar);
  ``add_months_overflow`` reproduces it, ``F.add_months`` clamps instead;
* elapsed days floor the elapsed seconds (not ``datediff``, which counts midnights).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Month and weekday labels of the reports.
MONTH_ABBR = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July", "August",
               "September", "October", "November", "December"]
WEEKDAY_ABBR_SUN_FIRST = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]


# X-01 ---------------------------------------------------------------------
def month_key(ts) -> Column:
    """'%Y-%m' text key."""
    return F.date_format(_c(ts), "yyyy-MM")


def day_of(ts) -> Column:
    return F.to_date(_c(ts))


def hour_of(ts) -> Column:
    return F.hour(_c(ts)).cast("bigint")


def year_of(ts) -> Column:
    return F.year(_c(ts)).cast("bigint")


def month_of(ts) -> Column:
    return F.month(_c(ts)).cast("bigint")


def month_start(ts) -> Column:
    """Period M as the first day of the month (DateType)."""
    return F.trunc(F.to_date(_c(ts)), "MM")


# X-02 ---------------------------------------------------------------------
def month_abbr(ts) -> Column:
    """'Jan'..'Dec' by lookup (locale independent)."""
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_ABBR]), F.month(_c(ts)))


def month_name(ts) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month(_c(ts)))


def month_year_label(ts) -> Column:
    """'Jan 2018'."""
    return F.concat_ws(" ", month_abbr(ts), F.year(_c(ts)).cast("string"))


def weekday_sun0(ts) -> Column:
    """SQLite %w: Sunday=0 .. Saturday=6."""
    return (F.dayofweek(_c(ts)) - 1).cast("bigint")


def weekday_abbr(ts) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAY_ABBR_SUN_FIRST]), F.dayofweek(_c(ts)))


# X-03 ---------------------------------------------------------------------
def month_number(name) -> Column:
    """'January'..'December' (or 3-letter forms) to 1..12; others null."""
    n = F.initcap(F.substring(F.trim(_c(name)), 1, 3))
    m = F.create_map(*[x for i, a in enumerate(MONTH_ABBR) for x in (F.lit(a), F.lit(i + 1))])
    return m[n].cast("bigint")


# X-04 ---------------------------------------------------------------------
def elapsed_seconds(start, end) -> Column:
    """Elapsed seconds with microsecond precision (pandas total_seconds)."""
    return (F.unix_micros(_c(end).cast("timestamp")) - F.unix_micros(_c(start).cast("timestamp"))) / F.lit(1e6)


def elapsed_days(start, end) -> Column:
    """pandas ``(end - start).dt.days``: floor of elapsed days, negatives floor down."""
    return F.floor(elapsed_seconds(start, end) / F.lit(86400)).cast("bigint")


def elapsed_hours(start, end, digits: int = 2) -> Column:
    return F.round(elapsed_seconds(start, end) / F.lit(3600.0), digits)


# X-05 ---------------------------------------------------------------------
def add_days(d, n: int) -> Column:
    return F.date_add(F.to_date(_c(d)), n)


def add_months_overflow(d, n: int) -> Column:
    """SQLite month arithmetic: move the month, keep the day, let it overflow."""
    dd = F.to_date(_c(d))
    return F.date_add(F.add_months(F.trunc(dd, "MM"), n), F.dayofmonth(dd) - 1)


def before(ts, day: str) -> Column:
    """The reference's ``ts <= 'day'`` on text: strictly before that day's midnight."""
    return _c(ts) < F.to_timestamp(F.lit(day))


# X-06 ---------------------------------------------------------------------
def mm_yyyy(ts) -> Column:
    return F.date_format(_c(ts), "MM-yyyy")


# X-07 ---------------------------------------------------------------------
# Season labels of the pricing jobs.
SEASON_CHRISTMAS = "Holiday - Christmas"
SEASON_BLACK_FRIDAY = "Holiday - Black Friday"
SEASON_CYBER_MONDAY = "Holiday - Cyber Monday"
SEASON_BACK_TO_SCHOOL = "Seasonal - Back to School"
SEASON_SUMMER = "Seasonal - Summer Sales"
SEASON_REGULAR = "Regular"


def season_of_day(ts) -> Column:
    m, d = F.month(_c(ts)), F.dayofmonth(_c(ts))
    return (F.when((m == 12) & (d >= 24), SEASON_CHRISTMAS)
            .when((m == 11) & (d == 29), SEASON_BLACK_FRIDAY)
            .when((m == 11) & (d == 30), SEASON_CYBER_MONDAY)
            .when(m == 8, SEASON_BACK_TO_SCHOOL)
            .when(m.isin(5, 6), SEASON_SUMMER)
            .otherwise(SEASON_REGULAR))


def season_of_month(month_full_name) -> Column:
    m = _c(month_full_name)
    return (F.when(m == "December", SEASON_CHRISTMAS)
            .when(m == "November", SEASON_CYBER_MONDAY)
            .when(m == "August", SEASON_BACK_TO_SCHOOL)
            .when(m.isin("May", "June"), SEASON_SUMMER)
            .otherwise(SEASON_REGULAR))


# X-08 ---------------------------------------------------------------------
def month_sin(m) -> Column:
    return F.sin(F.lit(2 * math.pi) * _c(m) / F.lit(12.0))


def month_cos(m) -> Column:
    return F.cos(F.lit(2 * math.pi) * _c(m) / F.lit(12.0))


def month_from_cyclic(s, c) -> Column:
    """Back from (sin, cos) to 1..12 via atan2."""
    ang = F.atan2(_c(s), _c(c))
    m = F.round(ang * F.lit(12.0) / F.lit(2 * math.pi)).cast("int")
    return (F.pmod(m - 1, F.lit(12)) + 1).cast("bigint")


# X-21 ---------------------------------------------------------------------
def days_of_month(month_first_day) -> Column:
    """Array of every day of the month (explode it for a calendar spine)."""
    d = F.to_date(_c(month_first_day))
    return F.sequence(d, F.last_day(d), F.expr("INTERVAL 1 DAY"))
