"""Rounding, means and sums that do not depend on the order rows arrive in.

Adding doubles gives slightly different sums for different partitionings. A measure is therefore cut into ``BINS`` whole
numbers of 26 binary digits each, by the value of its digits, and each bin is added up as a long: whole numbers add up the
same in any order, inside hash aggregates and without decimals. The bins reach from 2^52 down to 2^-78, so every binary digit
of a value from 4e-8 on counts. The totals are put together once per group. Results are taken to 15 significant digits, all
that a double is sure of, before they are rounded: a mean of 1.2049999999999998 is 1.205 and goes up. Where values cancel
out, the digits count from the largest value on, since no digit of the sum is surer than those of the values.

NaN and infinity count as unknown. Values beyond 2^89 and sums beyond 20 whole digits are refused; nothing wraps around.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from martkit.functions.text import _col

EXACT = DecimalType(38, 18)
BITS, BINS = 26, 5


def exact(c: Column | str) -> Column:
    """The value as a decimal with all the digits of its shortest text; null for NaN and infinity."""
    value = _col(c)
    wide = value.try_cast(EXACT)
    number = value.cast("double")
    refused = F.raise_error(F.concat(F.lit("more than 20 whole digits: "), value.cast("string"))).cast(EXACT)
    return F.when(wide.isNotNull(), wide).when(number - number == 0, refused)


def fifteen(number: Column, largest: Column | None = None) -> Column:
    """A double at 15 significant digits, as a decimal; null for NaN, infinity and more than 20 whole digits. ``largest``: the
    largest of the values it was made of, whose digits count where the result has fewer before the point."""
    text = F.format_string("%.14e", number)
    if largest is not None:
        behind = 14 - F.floor(F.log10(F.greatest(F.abs(number), largest))).cast("int")
        behind = F.coalesce(F.least(F.greatest(behind, F.lit(0)), F.lit(18)), F.lit(18))
        text = F.call_function("format_string", F.concat(F.lit("%."), behind.cast("string"), F.lit("f")), number)
    return F.when(number - number == 0, text.try_cast(EXACT))


def _bins(c: Column | str) -> list[Column]:
    """The value's binary digits from the top in whole numbers; null for NaN and infinity. Each subtraction is exact: it
    leaves the digits that the bin above has not taken."""
    number = _col(c).cast("double")
    left, out = F.when(number - number == 0, number * 2.0**-BITS), []
    for k in range(BINS):
        whole = left.try_cast("bigint")
        out.append(whole)
        if k + 1 < BINS:
            left = (left - whole.cast("double")) * 2.0**BITS
    return out


def _aggregates(c: Column | str) -> dict[str, Column]:
    """What is kept of a group's values: a total for each bin, the known values, those that the bins hold, the largest."""
    number = _col(c).cast("double")
    bins, size = _bins(c), F.when(number - number == 0, F.abs(number))
    return {f"bin{k}": F.try_sum(b) for k, b in enumerate(bins)} | {"known": F.count(size), "held": F.count(bins[0]), "largest": F.max(size)}


def _combined(found: dict[str, Column]) -> Column:
    """The sum as a decimal with 18 digits behind the point."""
    wide = DecimalType(20, 0)
    parts = [found[f"bin{k}"].cast(wide) for k in range(BINS)]
    total = F.try_add((parts[0] * F.lit(2**BITS).cast(DecimalType(9, 0))).try_cast(EXACT), parts[1].cast(EXACT)).try_cast(EXACT)
    for k, part in enumerate(parts[2:], 1):
        total = F.try_add(total, (part.cast(EXACT) / F.lit(str(2 ** (k * BITS))).cast(DecimalType(24, 0))).cast(EXACT)).try_cast(EXACT)
    refused = F.raise_error(F.lit("more than 20 whole digits in a value or a sum")).cast(EXACT)
    return F.when(found["known"] == 0, F.lit(None).cast(EXACT)).when((found["held"] == found["known"]) & total.isNotNull(), total).otherwise(refused)


def _total(c: Column | str) -> tuple[Column, Column, Column]:
    """(sum, number of known values, the largest of them): aggregates."""
    found = _aggregates(c)
    return _combined(found), found["known"], found["largest"]


def partial_sums(c: Column | str, name: str) -> list[Column]:
    """Aggregates that can be stored and merged later, as columns that begin with ``name``."""
    return [v.alias(f"{name}_{k}") for k, v in _aggregates(c).items()]


def _merged(name: str) -> dict[str, Column]:
    sums = {k: F.try_sum(f"{name}_{k}") for k in (f"bin{i}" for i in range(BINS))}
    return sums | {k: F.coalesce(F.sum(f"{name}_{k}"), F.lit(0)) for k in ("known", "held")} | {"largest": F.max(f"{name}_largest")}


def merged_sum(name: str) -> Column:
    """``fixed_sum`` of the values behind stored partial sums: the same to the last digit."""
    found = _merged(name)
    return fifteen(_combined(found).cast("double"), found["largest"])


def merged_mean(name: str, digits: int) -> Column:
    """``fixed_mean`` of the values behind stored partial sums."""
    found = _merged(name)
    return half_up(_combined(found), found["known"], digits, found["largest"])


def fixed_sum(c: Column | str) -> Column:
    """Aggregate sum to 15 significant digits, as a decimal; null when no value is known."""
    total, _, largest = _total(c)
    return fifteen(total.cast("double"), largest)


def half_up(numerator: Column, denominator: Column, digits: int, largest: Column | None = None) -> Column:
    """Quotient of a decimal or whole number by a whole number, rounded half away from zero."""
    quotient = F.try_divide(numerator.cast(EXACT), denominator.cast(DecimalType(20, 0)))
    return F.round(fifteen(quotient.cast("double"), largest), digits)


def fixed_mean(c: Column | str, digits: int) -> Column:
    """Mean of the known values, rounded half away from zero to ``digits``; null when there are none."""
    total, known, largest = _total(c)
    return half_up(total, known, digits, largest)


def round_half_up(c: Column | str, digits: int) -> Column:
    """Round a double the way a NUMERIC made of it is rounded: on 15 significant digits, half away from zero."""
    return F.round(fifteen(_col(c).cast("double")), digits)


def difference(a: Column | str, b: Column | str) -> Column:
    """``a - b`` of their shortest texts, as a decimal: no noise of binary digits comes up when most of them cancel out."""
    return exact(a) - exact(b)


def within(c: Column | str, low, high) -> Column:
    """Value when inside ``[low, high]``, else null."""
    return F.when(_col(c).between(low, high), _col(c))


def at_least(c: Column | str, low) -> Column:
    """Values below ``low`` are placeholders for "unknown" and become null."""
    return F.when(_col(c) >= low, _col(c))


def doubled_sum(c: Column | str, factor: int = 2) -> tuple[Column, Column]:
    """Element-wise product of an array and the sum of the result."""
    product = F.transform(_col(c), lambda x: x * factor)
    return product, F.aggregate(product, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
