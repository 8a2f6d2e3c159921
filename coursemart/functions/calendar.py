"""Academic calendar: autumn starts in September, winter in December, spring in March, summer in June.

An academic year is named after the calendar year of its autumn, so winter (from January on), spring and summer lie in the
following calendar year.
"""

from __future__ import annotations

from datetime import UTC, datetime, timedelta
from functools import cache
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

ANY_YEAR = "%"

# Fixed values: (quarter, years after the academic year, first month, first day) and the same for the last day.
QUARTER_STARTS = {"fall": (0, 9, 1), "winter": (0, 12, 1), "spring": (1, 3, 1), "summer": (1, 6, 1)}
QUARTER_ENDS = {"fall": (0, 11, 30), "winter": (1, 2, 28), "spring": (1, 5, 31), "summer": (1, 8, 31)}


def _text(c: Column | str) -> Column:
    return F.lit(c) if isinstance(c, str) else c


def _year(c: Column | str | int) -> Column:
    return c if isinstance(c, Column) else F.lit(str(c))


def date_in_quarter(
    date: Column | str, quarter: Column | str, year: Column | str | int, strict: bool = False
) -> Column:
    """Does ``date`` lie in that quarter of that academic year (``'%'``: of any year)?

    ``date`` as a string names a column; ``quarter`` and ``year`` may be literals or Columns. With a concrete year the
    source routine does not look at the quarter name for December to February dates; ``strict`` does.
    """
    day = (F.col(date) if isinstance(date, str) else date).cast("date")
    name = F.lower(_text(quarter))
    wanted = _year(year)
    any_year = wanted == ANY_YEAR
    academic = wanted.try_cast("int")
    shifted = F.quarter(F.add_months(day, 1))

    def named(which: str, years_later: int) -> Column:
        return (any_year | (F.year(day) == academic + years_later)) & (name == which)

    straddling = F.year(day) == F.when(F.month(day) == 12, academic).otherwise(academic + 1)
    winter = F.when(any_year, name == "winter").otherwise(
        straddling & (name == "winter") if strict else straddling
    )
    return (
        F.when(shifted == 4, named("fall", 0))
        .when(shifted == 3, named("summer", 1))
        .when(shifted == 2, named("spring", 1))
        .otherwise(winter)
    )


def _quarter_day(quarter: Column | str, year: Column | str | int, days: dict[str, tuple[int, int, int]]) -> Column:
    name = F.lower(F.rtrim(_text(quarter)))
    academic = _year(year).try_cast("int")
    result = F.lit(None).cast("date")
    for which, (years_later, month, day) in days.items():
        result = F.when(
            name == which, F.make_date(academic + years_later, F.lit(month), F.lit(day))
        ).otherwise(result)
    return result


def quarter_lower_date(quarter: Column | str, year: Column | str | int) -> Column:
    """First day of the quarter; NULL for an unknown quarter name."""
    return _quarter_day(quarter, year, QUARTER_STARTS)


def quarter_upper_date(quarter: Column | str, year: Column | str | int) -> Column:
    """Last day of the quarter. Winter always ends on February 28, in leap years too."""
    return _quarter_day(quarter, year, QUARTER_ENDS)


def plain_utc(at: datetime) -> datetime:
    """A moment as UTC wall-clock time: an aware one is converted, a plain one is UTC already."""
    return at if at.tzinfo is None else at.astimezone(UTC).replace(tzinfo=None)


def utc_literal(at: datetime) -> Column:
    """``at`` as TIMESTAMP_NTZ. It goes through text, so the session's zone has no part in it."""
    return F.lit(plain_utc(at).isoformat(sep=" ")).cast("timestamp_ntz")


@cache
def _zone_names(zone: str) -> tuple[tuple[datetime, ...], tuple[str, ...]]:
    """UTC moments at which the zone's name changes, 1900 to 2100, and the names before, between and after them."""
    tz = ZoneInfo(zone)

    def name(moment: datetime) -> str:
        return moment.astimezone(tz).tzname()

    begin, step, end = datetime(1900, 1, 1, tzinfo=UTC), timedelta(days=15), datetime(2100, 1, 1, tzinfo=UTC)
    changes, names = [], [name(begin)]
    while begin < end:
        low, high = begin, begin + step
        if name(high) != names[-1]:
            while high - low > timedelta(seconds=1):
                middle = (low + (high - low) / 2).replace(microsecond=0)
                low, high = (middle, high) if name(middle) == names[-1] else (low, middle)
            changes.append(high.replace(tzinfo=None))
            names.append(name(high))
        begin += step
    return tuple(changes), tuple(names)


def utc_to_local_text(instant: Column | str, zone: str) -> Column:
    """A UTC wall-clock timestamp as ``YYYY-mm-dd HH:MM:SS TZ`` in ``zone``; TZ is the name in use at that moment."""
    utc = (F.col(instant) if isinstance(instant, str) else instant).cast("timestamp_ntz")
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
    changes, names = _zone_names(zone)
    passed = F.size(F.filter(F.array(*(utc_literal(t) for t in changes)), lambda t: t <= utc)) if changes else F.lit(0)
    letters = F.when(utc.isNotNull(), F.get(F.array(*(F.lit(n) for n in names)), passed))
    return F.concat_ws(" ", F.date_format(local, "yyyy-MM-dd HH:mm:ss"), letters)
