"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text that stands for a missing value in the raw files.
NULL_WORDS = ["nan", "None", "<NA>", ""]


def as_column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c) -> Column:
    """Text or number to double; anything unreadable, and NaN, becomes null."""
    number = as_column(c).try_cast("double")
    return F.when(~F.isnan(number), number)


def coerce_numeric(c, default=0.0) -> Column:
    """`to_number` with a replacement for what could not be read."""
    return F.coalesce(to_number(c), F.lit(default).cast("double"))


def to_long(c) -> Column:
    """Whole part of the number in c, null when unreadable."""
    return to_number(c).try_cast("bigint")


def coerce_long(c) -> Column:
    return F.coalesce(to_long(c), F.lit(0).cast("bigint"))


def clip_non_negative(c) -> Column:
    """Lower bound 0 that keeps null (greatest() would turn null into 0)."""
    c = as_column(c)
    return F.when(c < 0, F.lit(0)).otherwise(c)


def clean_text(c) -> Column:
    """Trimmed text, with the agreed null words turned into null."""
    text = F.trim(as_column(c).cast("string"))
    return F.when(~text.isin(NULL_WORDS), text)


def round_half_up(c, digits: int) -> Column:
    """Rounding on plain double arithmetic, so two engines agree on ties. NaN, infinities and numbers
    too large to have digits left to round stay as they are."""
    scale, x = F.lit(float(10**digits)), as_column(c)
    rounded = F.floor(x * scale + F.lit(0.5)).cast("double") / scale
    return F.when(F.abs(x) * scale >= F.lit(2.0**53), x.cast("double")).otherwise(rounded)  # NaN counts as largest


# Ends of the ranges that exact_sum adds as short decimals, as long ones, and as doubles.
SHORT_DECIMAL, LONG_DECIMAL = {6: 1e12, 10: 1e16}, {6: 1e31, 10: 1e27}


def exact_parts(c, digits: int = 6) -> dict[str, Column]:
    """Aggregates whose sums over groups `total_of` turns into an exact sum of doubles.

    Decimals with `digits` decimals make the sum independent of row order. Numbers too large for the
    short decimal go to a long one; what no decimal holds, and NaN or an infinity, is added as a
    double, where lost digits no longer matter."""
    x = as_column(c).cast("double")
    short, long = F.lit(SHORT_DECIMAL[digits]), F.lit(LONG_DECIMAL[digits])
    return {
        "short": F.sum(F.when(F.abs(x) < short, x).try_cast(f"decimal({18 if digits == 6 else 26},{digits})")),
        "long": F.sum(F.when((F.abs(x) >= short) & (F.abs(x) < long), x).try_cast(f"decimal(38,{digits})")),
        "rest": F.sum(F.when(F.abs(x) >= long, x)),  # NaN counts as largest
    }


def total_of(short: Column, long: Column, rest: Column) -> Column:
    return sum((F.coalesce(part.cast("double"), F.lit(0.0)) for part in (long, rest)), F.coalesce(short.cast("double"), F.lit(0.0)))


def exact_sum(c, digits: int = 6) -> Column:
    """Sum of doubles that does not depend on row order; null without values."""
    return F.when(F.count(as_column(c)) > 0, total_of(**exact_parts(c, digits)))


def money_avg(c) -> Column:
    """Average with an exact decimal sum, so the result does not depend on row order."""
    return F.try_divide(exact_sum(c), F.count(as_column(c)).cast("double"))


def stable_sum(c) -> Column:
    """Sum of doubles that does not depend on row order, so a retried task cannot change it."""
    return exact_sum(c, 10)


def stable_avg(c) -> Column:
    c = as_column(c)
    return F.try_divide(stable_sum(c), F.count(c).cast("double"))


def monday_zero(c) -> Column:
    """Day of week with Monday = 0."""
    return F.weekday(as_column(c))


def is_weekend(c) -> Column:
    return monday_zero(c) >= 5


def epoch_day(c) -> Column:
    return F.datediff(as_column(c), F.lit("1970-01-01").cast("date")).cast("bigint")


def outside_domain(c, allowed: list[str]) -> Column:
    """True for a value that is present and not allowed; null passes."""
    c = as_column(c)
    return c.isNotNull() & ~c.isin(allowed)


def percent(part, whole, digits: int = 2) -> Column:
    return round_half_up(F.lit(100.0) * F.try_divide(as_column(part).cast("double"), as_column(whole).cast("double")), digits)


def status(passed: Column, otherwise: str = "FAIL") -> Column:
    return F.when(passed, "PASS").otherwise(otherwise)
