"""ISO 8601 timestamps as text, parsed to TIMESTAMP_NTZ (NULL when not valid).

Accepted: calendar dates with or without dashes, week dates, any one character
between date and time, times from hours down to a fraction with or without
colons, ``Z`` or a numeric offset. Offsets are applied, giving UTC. Spark's own
casts accept more (``2026``) and less (``20260125T120000``), hence the grammar.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_USUAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2})?$"

_DATE = r"(?:\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-W\d{2}(?:-\d)?|\d{4}W\d{2}\d?)"
_CLOCK = r"\d{2}(?::\d{2}(?::\d{2})?|\d{2}(?:\d{2})?)?(?:[.,]\d+)?"
_GRAMMAR = rf"(?s)^{_DATE}(?:.{_CLOCK}(?:Z|[+-]{_CLOCK})?)?$"

_PARTS = (
    r"(?s)^(\d{4})-?(?:W(\d{2})-?(\d)?|(\d{2})-?(\d{2}))"
    r"(?:.(\d{2}):?(\d{2})?:?(\d{2})?(?:[.,](\d+))?"
    r"(?:Z|([+-])(\d{2}):?(\d{2})?:?(\d{2})?(?:[.,](\d+))?)?)?$"
)
_NAMES = (
    "year", "week", "weekday", "month", "day", "hour", "minute", "second", "fraction",
    "sign", "off_hour", "off_minute", "off_second", "off_fraction",
)


def iso_timestamp(text: Column) -> Column:
    # The strict form is what a feed sends; the general form is only evaluated for the rest.
    return (
        F.when(text.rlike(_USUAL), _in_years(text.try_cast("timestamp_ntz")))
        .when(text.rlike(_GRAMMAR), _general(text))
    )


def _in_years(value: Column) -> Column:
    return F.when(F.year(value).between(1, 9999), value)


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _general(text: Column) -> Column:
    """One match splits the text; the pieces are then put together and range-checked."""
    groups = "|".join(f"${at}" for at in range(1, len(_NAMES) + 1))
    pieces = F.split(F.regexp_replace(text, _PARTS, groups), r"\|")
    return _bound(pieces, _assembled)


def _assembled(pieces: Column) -> Column:
    def piece(name: str) -> Column:
        return pieces[_NAMES.index(name)]

    def number(name: str) -> Column:
        return F.coalesce(piece(name).try_cast("int"), F.lit(0))

    def seconds(whole: str, fraction: str) -> Column:
        digits = F.rpad(piece(fraction), 6, "0").try_cast("int")
        return (number(whole) + digits / F.lit(1_000_000).cast("decimal(8,0)")).cast("decimal(16,6)")

    monday = F.date_trunc("week", F.make_date(number("year"), F.lit(1), F.lit(4))).cast("date")
    week_start = F.date_add(monday, (number("week") - 1) * 7)
    weekday = F.coalesce(piece("weekday").try_cast("int"), F.lit(1))
    by_week = F.when(
        weekday.between(1, 7) & (F.weekofyear(week_start) == number("week")),
        F.date_add(week_start, weekday - 1),
    )
    by_day = F.try_to_date(F.concat_ws("-", piece("year"), piece("month"), piece("day")))
    date = F.when(piece("week") != "", by_week).otherwise(by_day)
    clock = F.make_dt_interval(
        F.lit(0), number("hour"), number("minute"), seconds("second", "fraction")
    )
    sign = F.when(piece("sign") == "-", -1).otherwise(1)
    offset = F.make_dt_interval(
        F.lit(0), sign * number("off_hour"), sign * number("off_minute"),
        sign * seconds("off_second", "off_fraction"),
    )
    offset_seconds = (
        number("off_hour") * 3600 + number("off_minute") * 60 + number("off_second")
    )
    in_range = (
        (number("year") >= 1) & (number("hour") < 24) & (number("minute") < 60)
        & (number("second") < 60) & (offset_seconds < 86_400)
    )
    return F.when(in_range, date.cast("timestamp_ntz") + clock - offset)
