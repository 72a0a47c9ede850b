"""Lenient conversions: a bad value becomes null, it never fails the job.

Texts are rewritten step by step to one plain form that a cast accepts. Every step mentions its input once, so
the expression, and the code generated for it, stays small however many spellings are understood.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from martkit.functions.text import WHITE, _col, _lookup, strip

# Spreadsheets count days from this date.
SERIAL_EPOCH = "1899-12-30"
_SERIAL_MIN, _SERIAL_MAX = -693593, 2958465  # 0001-01-01 .. 9999-12-31

ERA_OFFSET = 543
ERA_THRESHOLD = 2400

_NUMBER = r"\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:nan|inf|infinity))\s*"
_PLAIN_DATE = r"(?!0000)\d{4}-\d{1,2}-\d{1,2}"

# Rewrites to year-month-day. Alternatives of one pattern fill different groups; the empty ones vanish.
_YEAR_FIRST = r"(\d{4})([-/])(\d{1,2})\2(\d{1,2})"
_DAY_FIRST = r"(\d{1,2})([-/])(\d{1,2})\6(\d{4})"
_FOUR_DIGIT_YEAR = (rf"^(?:{_YEAR_FIRST}|{_DAY_FIRST})$", "$1$8-$3$7-$4$5")
# Two-digit years: 69-99 are 19xx, 00-68 are 20xx.
_SHORT_YEAR_19 = (r"^(\d{1,2})([-/])(\d{1,2})\2(69|[789]\d)$", "19$4-$3-$1")
_SHORT_YEAR_20 = (r"^(\d{1,2})([-/])(\d{1,2})\2(\d{2})$", "20$4-$3-$1")
_NUMERIC_DATES = (_FOUR_DIGIT_YEAR, _SHORT_YEAR_19, _SHORT_YEAR_20)
# Record files write d/m/Y with slashes only. Its month-first reading applies where the second part is no month.
_MONTH_FIRST = r"(0?[1-9]|1[0-2])/(1[3-9]|2\d|3[01])/(\d{4})"
_RECORD_DATES = (
    (rf"^(?:{_YEAR_FIRST}|{_MONTH_FIRST}|(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}))$", "$1$7$10-$3$5$9-$4$6$8"),
)
# What may stand around a date: a weekday before it, a time of day with its zone behind it, endings of ordinal numbers.
_TIME = r"\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?(?:\s*[AaPp]\.?[Mm]\.?)?(?:\s*(?:Z|UTC|GMT|น\.|[+-]\d{2}:?\d{2}))?"
_WEEKDAY = r"(?:(?i:mon|tue|tues|wed|wednes|thu|thur|thurs|fri|sat|satur|sun)(?i:day)?\.?,?\s+|วัน[^\s\d]*\s*)(?=[\dA-Za-z])"
_AROUND = ((rf"^{_WEEKDAY}|(?<=\d)(?:,\s*|\s+|T)(?:at\s+)?{_TIME}$|(?<=\d)(?i:st|nd|rd|th)\b", ""),)
# Other forms become "~" year-month-day or day month-name year.
_STAMP = (rf"^(\d{{4}})-(\d{{1,2}})-(\d{{1,2}})[ T]{_TIME}$", "~$1-$2-$3")
_COMPACT = r"(\d{4})(\d{2})(\d{2})"
_DOTTED = r"(\d{1,2})\.(\d{1,2})\.(\d{4})|(\d{4})\.(\d{1,2})\.(\d{1,2})"
_DAY_NAME = r"^(\d{1,2})(?:\s+(?:of\s+)?|-)([A-Za-z]{3,9})\.?,?(?:\s+|-)"
_GUESSED_DATES = (
    (rf"^(?:{_COMPACT}|{_DOTTED})$", "~$1$6$7-$2$5$8-$3$4$9"),
    (r"^([A-Za-z]{3,9})\.?\s+(\d{1,2}),?\s+(\d{4})$", "$2 $1 $3"),
    (rf"{_DAY_NAME}'?(69|[789]\d)$", "$1 $2 19$3"),
    (rf"{_DAY_NAME}'?(\d{{2}})$", "$1 $2 20$3"),
    (rf"{_DAY_NAME}(\d{{4}})$", "$1 $2 $3"),
)
_NAMED_DATE = rf"^(\d{{1,2}})[{WHITE}]+([^{WHITE}]+)[{WHITE}]+(\d{{4}})$"
_ENGLISH_MONTHS = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)


def _rewrite(text: Column, steps: Sequence[tuple[str, str]]) -> Column:
    for pattern, replacement in steps:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def _only(text: Column, pattern: str) -> Column:
    """The text when all of it matches, else an empty text, which no cast accepts."""
    return F.regexp_replace(text, rf"(?s)^(?!{pattern}$).*$", "")


def lenient_double(c: Column | str) -> Column:
    """The pattern keeps out texts such as ``5d`` that the JVM would read as numbers."""
    return _only(_col(c).cast("string"), _NUMBER).try_cast("double")


def lenient_long(c: Column | str) -> Column:
    """Through double, truncated toward zero; infinities and NaN are null."""
    return lenient_double(c).try_cast("bigint")


def serial_date(c: Column | str) -> Column:
    """Spreadsheet day number to date, the fraction (time of day) dropped."""
    days = lenient_long(c)
    return F.when(
        days.between(_SERIAL_MIN, _SERIAL_MAX),
        F.date_add(F.lit(SERIAL_EPOCH).cast("date"), days.cast("int")),
    )


def lenient_date(c: Column | str, serial_numbers: bool = False) -> Column:
    """``Y-m-d``, ``d/m/Y``, ``m/d/Y``, ``Y/m/d`` in that order, else null.

    An ambiguous ``03/04/2021`` is read day first; the month-first form only catches what the day-first
    form cannot. With ``serial_numbers`` a bare number is a spreadsheet day number.
    """
    text = strip(_col(c).cast("string"))
    written = _only(_rewrite(text, _RECORD_DATES), _PLAIN_DATE).try_cast("date")
    return F.coalesce(written, serial_date(text)) if serial_numbers else written


def iso_utc_timestamp(c: Column | str) -> Column:
    """``YYYY-MM-DDTHH:MM:SS[.ffffff]Z`` to a zone-less UTC timestamp, independent of the session zone."""
    shape = r"\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?Z"
    return F.regexp_replace(_only(_col(c), shape), "Z$", "").try_cast("timestamp_ntz")


def local_wall_time(c: Column | str, zone: str = "Asia/Bangkok") -> Column:
    """Zone-less UTC to zone-less local time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(c).cast("timestamp_ntz"))


def locale_date(c: Column | str, month_numbers: Mapping[str, int], convert_era: bool = True) -> Column:
    """Numeric dates, then ``D <month name> YYYY`` in the given language, then common English forms; weekdays, ordinal endings
    and times of day around them are passed over, and the date is the one written, whatever the zone.

    Named months and the last path always bring a Buddhist year (above 2400) back by 543. With
    ``convert_era`` numeric dates get the same treatment; without it ``24/08/2569`` stays in year 2569.
    """
    names = {name.lower(): str(n) for name, n in month_numbers.items()}
    names |= {full: str(i) for i, full in enumerate(_ENGLISH_MONTHS, 1)}
    names |= {full[:3]: str(i) for i, full in enumerate(_ENGLISH_MONTHS, 1)} | {"sept": "9"}

    def spell_month(text: Column) -> Column:
        month = _lookup(F.lower(F.regexp_extract(text, _NAMED_DATE, 2)), names)
        named = F.concat(F.lit("~$3-"), F.coalesce(month, F.lit("0")), F.lit("-$1"))
        return _only(F.regexp_replace(text, F.lit(_NAMED_DATE), named), f"~?{_PLAIN_DATE}")

    def to_common_era(text: Column) -> Column:
        # the year is moved before the date is built: 29 February of an era year need not be one of that number
        plain = F.ltrim(text, F.lit("~"))
        year = F.substring(plain, 1, 4).try_cast("int")
        shifted = (year > ERA_THRESHOLD) if convert_era else (year > ERA_THRESHOLD) & text.startswith("~")
        year = year - shifted.cast("int") * ERA_OFFSET
        return F.concat(F.lpad(year.cast("string"), 4, "0"), F.substring(plain, 5, 6)).try_cast("date")

    text = _rewrite(strip(_col(c).cast("string")), (_STAMP, *_AROUND, *_NUMERIC_DATES, *_GUESSED_DATES))
    # the compiler works out once what the nested expression mentions several times
    return to_common_era(spell_month(text))


def number_in_range(
    c: Column | str, low: float, high: float, null_tokens: Sequence[str] = ("", "-", "nan", "none", "null")
) -> Column:
    """First number in the text once commas are dropped, kept only within ``[low, high]``.

    The null tokens hold no digits, so they fall out with every other text without a number; a token that
    does is matched as a whole text.
    """
    text = F.replace(_col(c).cast("string"), F.lit(","), F.lit(""))
    tokens = [t for t in null_tokens if any(ch.isdigit() for ch in t)]
    if tokens:
        text = F.when(~F.lower(strip(text)).isin(*tokens), text)
    number = F.regexp_extract(text, r"\d+(?:\.\d+)?", 0).try_cast("double")
    return F.when(number.between(low, high), number)
