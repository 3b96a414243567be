"""Sums and averages that do not depend on the order rows arrive in.

A sum of doubles differs in its last bits from one run to the next, because partial sums meet in any order. Here a double
stands for its shortest decimal text, cut to 18 places. Nearly all readings have at most six places: such a value is a whole number of
millionths, and long arithmetic finds and adds it without ever making a text. A decimal of at most 15 digits is the shortest text of the
double next to it, so dividing back shows whether the millionths are the value. They are added in two parts of a
long, so that 100 billion of them do not overflow; what is not a number of millionths is added as a decimal.

Sums combine map-side and are the same on every run. Values from 10 billion on, infinite ones and NaN fail the job, with
ANSI mode on or off, and so does a total that does not fit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

VALUE = "decimal(28,18)"
# Totals keep every place; two digits less before the point leave room to halve and compare.
_TOTAL = "decimal(36,18)"
_COUNT = "decimal(18,2)"
_LIMIT = 1e10
_MILLION = 1e6
_WHOLE_BELOW = 1e9  # at most 15 digits in millionths
_LOW_BITS = 24
_LARGEST = 4 * 10**17  # each of both parts of a total
_HIGHEST = _LARGEST * 10**6 >> _LOW_BITS


def _lit(number: str, kind: str) -> Column:
    return F.lit(number).cast(kind)


def _millionths(value: Column) -> Column:
    """The value in millionths where it is a whole number of them, as a long."""
    scaled = F.rint(value * _MILLION)
    return F.when((F.abs(value) < _WHOLE_BELOW) & (scaled / _MILLION == value), scaled.cast("long"))


def _decimal(value: Column) -> Column:
    too_large = value.isNotNull() & ~(F.abs(value) < _LIMIT)
    message = F.concat(F.lit("Too large to be added: "), value.cast("string"))
    return F.when(too_large, F.raise_error(message)).otherwise(value.try_cast(VALUE))


def _other(value: Column) -> Column:
    """The value where it is not a whole number of millionths."""
    return F.when(_millionths(value).isNull(), _decimal(value))


def exact(value: Column) -> Column:
    """One value as a decimal."""
    from_long = (_millionths(value).cast("decimal(16,0)") * _lit("0.000001", "decimal(6,6)")).cast(VALUE)
    return F.coalesce(from_long, _other(value))


def exact_total(value: Column, over: WindowSpec | None = None) -> Column:
    """The sum, a decimal; NULL without any value. ``over`` makes it a sum over a window."""
    def added(part: Column) -> Column:
        return part if over is None else part.over(over)

    millionths, other = _millionths(value), _other(value)
    high = added(F.sum(F.shiftright(millionths, _LOW_BITS)))
    low = added(F.sum(millionths.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))))
    rest, n_rest = added(F.sum(other)), added(F.count(other))
    # An overflowed sum of decimals is NULL with ANSI mode off. Below these limits no step that follows can overflow.
    too_large = (F.abs(high) > _HIGHEST) | (F.abs(rest) > _lit(str(_LARGEST), "decimal(38,18)")) | ((n_rest > 0) & rest.isNull())
    whole = F.coalesce(high, F.lit(0)).cast("decimal(20,0)") * _lit(str(1 << _LOW_BITS), "decimal(8,0)")
    whole = (whole + F.coalesce(low, F.lit(0)).cast("decimal(20,0)")).cast("decimal(29,0)") * _lit("0.000001", "decimal(6,6)")
    total = (whole.cast(_TOTAL) + F.coalesce(rest, _lit("0", "decimal(38,18)")).cast(_TOTAL)).cast(_TOTAL)
    return F.when(F.coalesce(too_large, F.lit(False)), F.raise_error(F.lit("A total does not fit"))).when(added(F.count(value)) > 0, total)


def exact_sum(value: Column, over: WindowSpec | None = None) -> Column:
    total = exact_total(value, over).cast("double")
    if over is not None:
        return total
    # Below 2**53 millionths, a double holds them as they are, and one division rounds as the decimal's cast does.
    millionths = _millionths(value)
    high, low = F.sum(F.shiftright(millionths, _LOW_BITS)), F.sum(millionths.bitwiseAND(F.lit((1 << _LOW_BITS) - 1)))
    few = (F.count(_other(value)) == 0) & (F.abs(high) < F.lit(1 << 28)) & (low < F.lit(1 << 52))
    return F.when(few, (high * F.lit(1 << _LOW_BITS) + low).cast("double") / _MILLION).otherwise(total)


def exact_avg(value: Column) -> Column:
    return exact_sum(value) / F.nullif(F.count(value), F.lit(0))


def tenths(total: Column, count: Column | int) -> Column:
    """``total``, a decimal, over ``count`` rows, to one decimal, halves away from zero.

    Half a tenth of a row is added per row, and whole tenths counted: no quotient is rounded twice.
    """
    rows = F.lit(count) if isinstance(count, int) else count
    total = total.cast(_TOTAL)
    half, step = (rows * _lit("0.05", "decimal(3,2)")).cast(_COUNT), (rows * _lit("0.1", "decimal(3,2)")).cast(_COUNT)
    whole = F.call_function("div", F.abs(total) + half, F.nullif(step, F.lit(0).cast(_COUNT)))
    return F.when(total < 0, -whole).otherwise(whole) / F.lit(10.0)


def avg_tenths(value: Column) -> Column:
    return tenths(exact_total(value), F.count(value))


def combined_tenths(terms: Sequence[tuple[int, Column]], count: Column | int) -> Column:
    """``tenths`` of the sum of a row's terms, each a sign (1 or -1) and a value; NULL if a value is.

    All in long arithmetic where every value is a whole number of millionths.
    """
    rows = F.lit(count) if isinstance(count, int) else count
    quick = sum((sign * _millionths(value) for sign, value in terms), F.lit(0))
    whole = F.call_function("div", F.abs(quick) + rows * 50_000, F.nullif(rows * 100_000, F.lit(0)))
    quick_tenths = F.when(quick < 0, -whole).otherwise(whole) / F.lit(10.0)
    slow = sum((exact(value) if sign > 0 else -exact(value) for sign, value in terms), _lit("0", VALUE))
    return F.when(quick.isNotNull(), quick_tenths).otherwise(tenths(slow, rows))


def avg_of_avgs(value: Column) -> Column:
    """Unweighted average of already averaged values."""
    return exact_avg(value)


def sum_of_sums(value: Column) -> Column:
    return exact_sum(value)
