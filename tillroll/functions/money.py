"""Scalar helpers shared by every operator.

All rounding goes through DECIMAL so that results do not depend on the
engine's double rounding rule: the value is first fixed to 6 decimals, then
rounded half-up.  Sums add DECIMAL values, so the order in which
partial sums are combined does not matter.  DECIMAL(38,6) holds sums up to
10^32, enough for any mart at 100 TB.

DECIMAL has no NaN and no infinity.  Such values are summed beside the others, as
DOUBLE, and if there are any they are the result: NaN and infinity come through sums,
means and rounding as they do in a plain DOUBLE sum.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_DECIMAL = "decimal(38,6)"
# One value: up to 10^22; sums are DECIMAL(38,6).
VALUE_DECIMAL = "decimal(28,6)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def odd(c: Column | str) -> Column:
    """The value if it is NaN or infinite, else NULL."""
    value = _col(c).cast("double")
    return F.when(~(F.abs(value) < F.lit(float("inf"))), value)


def millionths(c: Column | str) -> tuple[Column, Column]:
    """The value fixed to six decimals as a whole number of millionths (LONG), and when that number is right: it is for
    amounts below 10^8 that are not near the middle between two millionths.  The others need DECIMAL, which costs much more.

    ``x * 10^6`` is off by 0.03 at most there, so DECIMAL would round to the same number.
    """
    value = _col(c).cast("double")
    scaled = value * F.lit(1e6)
    whole = F.rint(scaled)
    return whole.try_cast("long"), (F.abs(value) < F.lit(1e8)) & (F.abs(scaled - whole) < F.lit(0.45))


def money_round(c: Column | str, scale: int = 2) -> Column:
    """round(x, scale) as DOUBLE, computed exactly via DECIMAL(38,6); NULL for NaN and infinity.

    Where ``millionths`` are right they are rounded instead, with the same result.
    """
    decimal = F.round(_col(c).cast(MONEY_DECIMAL), scale).cast("double")
    if not 0 <= scale <= 6:
        return decimal
    whole, right = millionths(c)
    unit = 10 ** (6 - scale)
    up = F.call_function("div", F.abs(whole) + F.lit(unit // 2).cast("long"), F.lit(unit).cast("long"))
    return F.when(right, F.when(whole < 0, -up).otherwise(up).cast("double") / F.lit(float(10 ** scale))).otherwise(decimal)


def rounded(c: Column | str, scale: int = 2) -> Column:
    """``money_round`` that gives NaN and infinity back as they are."""
    return F.coalesce(odd(c), money_round(c, scale))


def exact(c: Column | str) -> Column:
    """The value fixed to six decimals, so that sums do not depend on their order; NULL for odd ones."""
    return _col(c).cast(VALUE_DECIMAL)


def exact_parts(c: Column | str) -> Column:
    """sum() as a struct that can be summed again (``sum_parts``): exact values, odd values."""
    return F.struct(F.sum(exact(c)).alias("sum"), F.sum(odd(c)).alias("odd"))


def sum_parts(parts: str) -> Column:
    """The sum of sums, again as a struct."""
    return F.struct(F.sum(f"{parts}.sum").alias("sum"), F.sum(f"{parts}.odd").alias("odd"))


def parts_value(parts: Column) -> Column:
    """The sum as DOUBLE."""
    return F.coalesce(parts["odd"], parts["sum"].cast("double"))


def parts_rounded(parts: Column, scale: int = 2) -> Column:
    """The sum rounded half-up, as DOUBLE."""
    return F.coalesce(parts["odd"], money_round(parts["sum"], scale))


def exact_sum(c: Column | str) -> Column:
    """sum() over exact values, as DOUBLE."""
    return parts_value(exact_parts(c))


def money_sum(c: Column | str, scale: int = 2) -> Column:
    """sum() over exact values, rounded half-up."""
    return parts_rounded(exact_parts(c), scale)


def exact_avg(c: Column | str) -> Column:
    """avg() as the exact sum, then one division: the rows above the line are those below it."""
    return F.try_divide(exact_sum(c), F.count(_col(c)))


def safe_divide(num: Column | str, den: Column | str) -> Column:
    """num / den, NULL when den is 0 or NULL (never an ANSI error)."""
    return F.try_divide(_col(num), _col(den))


def pct(num: Column | str, den: Column | str, scale: int = 2) -> Column:
    """rounded(num / den * 100): NULL on zero denominator."""
    return rounded(safe_divide(num, den) * F.lit(100), scale)


def month_trunc(c: Column | str) -> Column:
    """First day of the month as DATE (``date_trunc`` would give TIMESTAMP)."""
    return F.trunc(_col(c).cast("date"), "month")


def dow_sunday1(c: Column | str) -> Column:
    """Day of week, 1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_col(c))


def dow_sunday0(c: Column | str) -> Column:
    """Day of week, 0 = Sunday ... 6 = Saturday (report convention)."""
    return F.dayofweek(_col(c)) - F.lit(1)
