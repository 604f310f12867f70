"""Scalar expressions: text, dates, money, ratios.

Spark 4 runs in ANSI mode, so a bad cast or a zero divisor raises. Wherever bad input must give NULL the ``try_``
form is used. Ratios are computed on decimals and rounded once, half up, at the end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# ---- text -----------------------------------------------------------------------------------------------------------

def clean_lower(value: Column | str) -> Column:
    return F.lower(F.trim(as_column(value)))


def clean_upper(value: Column | str) -> Column:
    return F.upper(F.trim(as_column(value)))


def pad_zip(value: Column | str, width: int = 5, keep_longer: bool = False) -> Column:
    """Postal prefix of exactly ``width`` characters: zeros on the left, longer input cut on the right as SQL's lpad does.

    ``keep_longer`` leaves longer input as it is.
    """
    text = as_column(value).cast("string")
    padded = F.lpad(text, width, "0")
    return F.when(F.length(text) > width, text).otherwise(padded) if keep_longer else padded


def underscores_to_spaces(value: Column | str) -> Column:
    return F.translate(as_column(value), "_", " ")


def text_or(value: Column | str, default: str = "") -> Column:
    return F.coalesce(as_column(value), F.lit(default))


def has_text(value: Column | str) -> Column:
    """True for non-empty text, False for NULL and the empty string."""
    return F.coalesce(F.length(as_column(value)) > 0, F.lit(False))


def longer_than(value: Column | str, n: int) -> Column:
    return F.coalesce(F.length(F.trim(as_column(value))) > n, F.lit(False))


# ---- dates ----------------------------------------------------------------------------------------------------------

def to_ts(value: Column | str) -> Column:
    """Timestamp from text; malformed text gives NULL."""
    return F.try_to_timestamp(as_column(value).cast("string"))


def elapsed_seconds(start: Column | str, end: Column | str) -> Column:
    return F.unix_timestamp(as_column(end)) - F.unix_timestamp(as_column(start))


def delay_days(actual: Column | str, promised: Column | str) -> Column:
    """Signed calendar days, positive when late."""
    return F.datediff(as_column(actual), as_column(promised))


def weekday_number(day: Column | str) -> Column:
    """Sunday is 0."""
    return F.dayofweek(as_column(day)) - 1


# ---- numbers --------------------------------------------------------------------------------------------------------

def money(value: Column | str) -> Column:
    return as_column(value).try_cast("decimal(10,2)")


def exact(value: Column | str) -> Column:
    """Decimal with room for sums: integers and money keep every digit."""
    return as_column(value).cast("decimal(22,6)")


def ratio(top: Column, bottom: Column, digits: int) -> Column:
    """``top / bottom`` rounded half up; NULL when the divisor is 0."""
    return F.round(F.try_divide(exact(top), bottom.cast("decimal(16,0)")), digits)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(F.try_divide(part.cast("decimal(18,0)") * F.lit(100), whole.cast("decimal(18,0)")), digits)


def mean_of(value: Column | str, digits: int) -> Column:
    """Aggregate mean of an integer or decimal column: exact sum over count, rounded once."""
    c = as_column(value)
    return F.round(F.try_divide(F.sum(exact(c)), F.count(c)), digits)


def count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def percent_where(condition: Column, digits: int = 1) -> Column:
    """Share of all rows of the group, in percent."""
    return percent(count_where(condition), F.count(F.lit(1)), digits)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0."""
    return F.when(condition, 1).otherwise(0)


# ---- arrays ---------------------------------------------------------------------------------------------------------

def array_total(items: Column | str, value: Callable[[Column], Column], skip_nulls: bool = False) -> Column:
    """Sum over an array. By default one NULL element makes the total NULL; ``skip_nulls`` ignores it."""
    start = F.lit(0.0).cast("double")

    def add(total: Column, item: Column) -> Column:
        x = value(item).cast("double")
        return total + (F.coalesce(x, F.lit(0.0)) if skip_nulls else x)

    return F.aggregate(as_column(items), start, add)


def _erfc(z: Column) -> Column:
    """Complementary error function of z >= 0: the power series of erf below 2.5, the continued fraction from there on."""
    square = z * z
    step = lambda acc, n: F.struct((acc["term"] * 2 * square / (2 * n + 1)).alias("term"), (acc["total"] + acc["term"]).alias("total"))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(80)), F.struct(z.alias("term"), F.lit(0.0).alias("total")), step)["total"]
    fraction = F.aggregate(F.sequence(F.lit(80), F.lit(1), F.lit(-1)), z, lambda acc, n: z + n / F.lit(2.0) / acc)
    root = F.sqrt(F.pi())
    return F.when(z < 2.5, 1 - 2 / root * F.exp(-square) * series).otherwise(F.exp(-square) / root / fraction)


def chi_squared_tail(statistic: Column, degrees: Column) -> Column:
    """Chance that a chi-squared variable of ``degrees`` reaches ``statistic``; null without a degree or a statistic.

    The upper incomplete gamma function of whole and half orders is a finite sum, here of exponents, so that large
    statistics do not overflow.
    """
    half, odd = statistic / 2, degrees % 2 == 1
    first = F.when(odd, F.ln(half) / 2 - half - F.ln(F.sqrt(F.pi()) / 2)).otherwise(-half)
    count = F.floor(degrees / 2).cast("int")
    step = lambda acc, i: F.struct(
        (acc["exponent"] + F.ln(half / (i + F.when(odd, 0.5).otherwise(0.0)))).alias("exponent"), (acc["total"] + F.exp(acc["exponent"])).alias("total")
    )
    terms = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(terms, F.struct(first.alias("exponent"), F.lit(0.0).alias("total")), step)["total"]
    tail = total + F.when(odd, _erfc(F.sqrt(half))).otherwise(0.0)
    return F.when(degrees >= 1, F.when((statistic <= 0) | (tail > 1), 1.0).otherwise(tail))
