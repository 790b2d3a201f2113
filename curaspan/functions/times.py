"""Timestamp parsing and printing. The session clock must be UTC."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date with both dashes or none, calendar or week form; then an optional clock and zone.
_ISO_DATE = r"(\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-W\d{2}(?:-\d)?|\d{4}W\d{2}\d?)"
_ISO_SHAPE = (
    rf"\A{_ISO_DATE}"
    r"(?:.(\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?(?:[+-]\d{2}(?::?\d{2}(?::?\d{2}(?:\.\d+)?)?)?)?)?\z"
)

# The date layouts of tabular sources as (shape, layout), after the
# separators are made equal and month names cut to three letters. Numeric dates
# are read month first and, where that fails, day first.
DATE_LAYOUTS: tuple[tuple[str, str], ...] = (
    (r"\d{4}-\d{1,2}-\d{1,2}", "yyyy-M-d"),
    (r"\d{1,2}-\d{1,2}-\d{4}", "M-d-yyyy"),
    (r"\d{8}", "yyyyMMdd"),
    (r"\d{1,2}-[A-Z][a-z]{2}-\d{4}", "d-MMM-yyyy"),
    (r"[A-Z][a-z]{2}-\d{1,2}-\d{4}", "MMM-d-yyyy"),
    (r"\d{4}-[A-Z][a-z]{2}-\d{1,2}", "yyyy-MMM-d"),
)
DAY_FIRST_LAYOUTS: tuple[tuple[str, str], ...] = ((r"\d{1,2}-\d{1,2}-\d{4}", "d-M-yyyy"),)
_MONTHS = (
    r"\b(?:(Jan)(?:uary)?|(Feb)(?:ruary)?|(Mar)(?:ch)?|(Apr)(?:il)?|(May)|(Jun)e?|(Jul)y?|(Aug)(?:ust)?"
    r"|(Sep)(?:t|tember)?|(Oct)(?:ober)?|(Nov)(?:ember)?|(Dec)(?:ember)?)\b"
)
_WEEKDAY = r"\A(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?,? +"
_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:\.(\d{1,6}))?)?(?: ?([AaPp])[Mm])?|(\d{1,2}) ?([AaPp])[Mm]"
_ZONE = r"(?:Z| ?[+-]\d{2}:?\d{2}| UTC)"
_WITH_CLOCK = rf"\A(.*?)(?:[ T]+(?:{_CLOCK}){_ZONE}?)?\z"
# What a text needs for a clock, or for characters that the pattern above does not take.
_MAY_HAVE_CLOCK = r"[:\n\r\x{85}\x{2028}\x{2029}]|[AaPp][Mm]"
# A two-digit year is less than this many years ahead.
_YEARS_AHEAD = 50


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _clock_text(hour: Column, minute: Column, second: Column, fraction: Column) -> Column:
    """``hh:mm:ss.ffffff`` from texts of which any may be empty."""

    def digits(value: Column) -> Column:
        return F.when(value == "", F.lit("00")).otherwise(F.lpad(value, 2, "0"))

    return F.concat(
        digits(hour), F.lit(":"), digits(minute), F.lit(":"), digits(second), F.lit("."),
        F.substring(F.rpad(fraction, 6, "0"), 1, 6),
    )


def _week_date(text: Column) -> Column:
    """Date of ``2024-W03-1``, ``2024W031`` or the Monday of ``2024-W03``; NULL if there is none."""
    plain = F.replace(text, F.lit("-"), F.lit(""))
    week = F.substring(plain, 6, 2).try_cast("int")
    day = F.when(F.length(plain) == 8, F.substring(plain, 8, 1).try_cast("int")).otherwise(1)
    fourth = F.concat(F.substring(plain, 1, 4), F.lit("-01-04")).try_cast("date")
    monday = F.date_add(F.trunc(fourth, "week"), (week - 1) * 7)
    return F.when(day.between(1, 7) & (F.weekofyear(monday) == week), F.date_add(monday, day - 1))


def parse_iso(raw: Column) -> Column:
    """ISO-8601 text to a timestamp; the clock reading is taken as UTC.

    A zone suffix is dropped, not converted. Blank or malformed text is NULL.
    """
    value = F.rtrim(raw, F.lit("Z"))

    def part(index: int) -> Column:
        return F.regexp_extract(value, _ISO_SHAPE, index)

    day = part(1)
    date = (
        F.when(day.contains("W"), F.date_format(_week_date(day), "yyyy-MM-dd"))
        .when(F.length(day) == 8, F.regexp_replace(day, r"(....)(..)(..)", "$1-$2-$3"))
        .otherwise(day)
    )
    clock = _clock_text(part(2), part(3), part(4), part(5))
    return F.when(
        value.rlike(_ISO_SHAPE), F.try_to_timestamp(F.concat(date, F.lit(" "), clock))
    )


def _plain_date(text: Column) -> Column:
    """The date with dashes between its parts, short month names and a four-digit year."""
    named = F.regexp_replace(F.lower(text), _WEEKDAY, "")
    named = F.regexp_replace(named, r"(\d)(?:st|nd|rd|th)\b", "$1")
    # A name may stand right behind a number: 5-mar-2024, 05mar2024.
    apart = F.regexp_replace(named, r"(?<=\d)(?=[a-z])|(?<=[a-z])(?=\d)", "-")
    dashed = F.regexp_replace(apart, r" *[-/., ] *", "-")
    short = F.regexp_replace(F.initcap(F.replace(dashed, F.lit("-"), F.lit(" "))), _MONTHS, "$1$2$3$4$5$6$7$8$9$10$11$12")
    whole = F.regexp_replace(F.replace(short, F.lit(" "), F.lit("-")), "-+", "-")
    return _bound(whole, _with_long_year)


def _with_long_year(whole: Column) -> Column:
    # The last of three parts is the year, unless the first has four digits.
    last = F.regexp_extract(whole, r"\A[A-Za-z0-9]{1,3}-[A-Za-z0-9]{1,3}-(\d{2})\z", 1)
    year = last.try_cast("int") + 2000
    year = F.when(year >= F.year(F.current_date()) + _YEARS_AHEAD, year - 100).otherwise(year)
    long = F.concat(F.regexp_replace(whole, r"\d{2}\z", ""), year.cast("string"))
    return F.when(last == "", whole).otherwise(long)


def _day(date: Column) -> Column:
    """Midnight of a date that ``_plain_date`` has made."""

    def layout_of(layouts: tuple[tuple[str, str], ...]) -> Column:
        chosen = F.lit(None).cast("string")
        for shape, layout in reversed(layouts):
            chosen = F.when(date.rlike(rf"\A{shape}\z"), F.lit(layout)).otherwise(chosen)
        return chosen

    return F.coalesce(
        F.try_to_timestamp(date, layout_of(DATE_LAYOUTS)),
        F.try_to_timestamp(date, layout_of(DAY_FIRST_LAYOUTS)),
    )


def parse_due_date(raw: Column) -> Column:
    """Date text in one of several layouts, with or without a clock time, to a timestamp.

    Parts may be separated by dashes, slashes, dots, blanks or commas; months may be
    numbers or English names, years have two or four digits, clocks 12 or 24 hours.
    A zone suffix is dropped, not converted. Blank or unknown text is NULL. The
    shape of a date picks its layout, so it is parsed once, or twice if numeric
    and not a valid month-first date.
    """
    value = F.trim(raw)

    def part(index: int) -> Column:
        return F.regexp_extract(value, _WITH_CLOCK, index)

    day = _bound(_plain_date(part(1)), _day)
    half = F.lower(F.concat(part(6), part(8)))
    hour = F.concat(part(2), part(7)).try_cast("int")
    # 12 AM is hour 0 and 12 PM hour 12; a 12-hour clock has no hour 0 or 13.
    hour = F.when(half == "", hour).when(
        hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0)
    )
    none = (part(2) == "") & (part(7) == "")
    hour_text = F.when(none, F.lit("00")).otherwise(hour.cast("string"))
    clock = _clock_text(hour_text, part(3), part(4), part(5))
    with_clock = F.try_to_timestamp(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "), clock))
    return F.when(value.rlike(_MAY_HAVE_CLOCK), with_clock).otherwise(_bound(_plain_date(value), _day))


def _with_fraction(ts: Column, layout: str, zone: str) -> Column:
    whole = F.date_format(ts, layout)
    fraction = F.date_format(ts, ".SSSSSS")
    return F.when(fraction == ".000000", F.concat(whole, F.lit(zone))).otherwise(
        F.concat(whole, fraction, F.lit(zone))
    )


def print_for_tag(ts: Column) -> Column:
    """``2024-01-15 09:00:00+00:00``; NULL prints as ``NaT`` so that a tag keeps its shape."""
    return F.coalesce(_with_fraction(ts, "yyyy-MM-dd HH:mm:ss", "+00:00"), F.lit("NaT"))


def print_iso(ts: Column) -> Column:
    """``2024-01-15T09:00:00+00:00``; NULL stays NULL."""
    return _with_fraction(ts, "yyyy-MM-dd'T'HH:mm:ss", "+00:00")
