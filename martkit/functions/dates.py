"""Calendar attributes of a date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from martkit.functions.casts import ERA_OFFSET
from martkit.functions.text import _col


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c).cast("date"), "MM")


def _pick(names: Sequence[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def month_attributes(day: Column | str, month_names: Sequence[str]) -> dict[str, Column]:
    d = _col(day)
    return {
        "year_ce": F.year(d),
        "year_be": F.year(d) + ERA_OFFSET,
        "month_no": F.month(d),
        "month_name": _pick(month_names, F.month(d)),
        "year_month": F.date_format(d, "yyyy-MM"),
        "quarter": F.quarter(d),
    }


def weekday_attributes(day: Column | str, weekday_names: Sequence[str]) -> dict[str, Column]:
    """ISO weekday (Monday first) and a TRUE/FALSE text flag for Saturday and Sunday."""
    iso = F.weekday(_col(day)) + 1
    return {
        "weekday": _pick(weekday_names, iso),
        "is_weekend": F.upper((iso >= 6).cast("string")),
    }


def wall_time(at: datetime) -> Column:
    """A zone-less UTC literal, written as text: neither the machine's zone nor the session's has a say in it."""
    if at.tzinfo:
        at = at.astimezone(UTC).replace(tzinfo=None)
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
