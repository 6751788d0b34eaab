"""Exact order statistics as one lazy plan.

A double becomes a 64-bit key of the same order, and equal keys are counted with map-side combine. Keys
are then read in three digits of 21 or 22 bits: the counts are added up per digit, prefix sums over the
digits tell which one holds each wanted rank, and only the keys with that digit go on to the next one.
After three steps the key itself is left. No job runs while planning, no task sees more than the counts of
its own keys and 2^22 digits, and the number of steps does not depend on the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bits of the digits that a key is read in.
WIDTHS = (22, 21, 21)
# Format of a double: bits of the mantissa, smallest exponent, exponent field of infinity.
_MANTISSA, _LOWEST, _ENDLESS = 52, -1022, 2047


def _power(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent)


def order_key(value: Column) -> Column:
    """64-bit whole number in the order of the doubles (not for NaN): exponent, then mantissa."""
    size = F.abs(value)
    guess = F.greatest(F.coalesce(F.floor(F.log2(F.nullif(size, F.lit(float("inf"))))), F.lit(_LOWEST)), F.lit(_LOWEST))
    exponent = F.when((_power(guess) > size) & (guess > _LOWEST), guess - 1).when(size >= _power(guess + 1), guess + 1).otherwise(guess)
    mantissa = (F.nullif(size, F.lit(float("inf"))) / _power(exponent) * F.lit(2.0**_MANTISSA)).cast("bigint")  # a whole number
    finite = F.shiftleft(exponent.cast("bigint") - _LOWEST, _MANTISSA) + mantissa
    key = F.coalesce(finite, F.lit(_ENDLESS << _MANTISSA))
    return F.when(value < 0, -key - 1).otherwise(key)


def from_key(key: Column) -> Column:
    """The double of an order key."""
    size = F.when(key < 0, -key - 1).otherwise(key)
    field, fraction = F.shiftright(size, _MANTISSA), size.bitwiseAND(F.lit((1 << _MANTISSA) - 1)).cast("double")
    normal = (fraction / F.lit(2.0**_MANTISSA) + 1.0) * _power(field - (1 - _LOWEST))
    value = F.when(field == _ENDLESS, F.lit(float("inf"))).when(field == 0, fraction * F.lit(2.0**-1074)).otherwise(normal)
    return F.when(key < 0, -value).otherwise(value)


def ranked_values(df: DataFrame, value: Column, ranks: dict[str, tuple[int, int, int]]) -> DataFrame:
    """(name, value) of the wanted ranks among the values that are not null or NaN; no rows without any.

    A rank is (a, b, c): the place (n * a + b) // c of n sorted values, counted from 1."""
    number = value.cast("double")
    known = df.select(F.when(~F.isnan(number), number).alias("v")).where("v IS NOT NULL")
    # Grouped by the key itself: every step reads the same small shuffle.
    keyed = known.groupBy(order_key(F.col("v")).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), F.expr(f"div(whole * {a} + {b}, {c})").alias("rank")) for name, (a, b, c) in ranks.items()])

    def digit(level: int) -> Column:
        part = F.shiftright("key", sum(WIDTHS[level + 1 :]))
        return (part if level == 0 else part.bitwiseAND(F.lit((1 << WIDTHS[level]) - 1).cast("bigint"))).alias("digit")

    first = keyed.groupBy(digit(0)).agg(F.sum("n").alias("n"))
    upto = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
    sums = first.select("digit", "n", F.sum("n").over(upto).alias("upto"), F.sum("n").over(Window.partitionBy()).alias("whole"))
    place = sums.select("digit", "n", "upto", F.inline(wanted))
    chosen = _holding(place, F.col("digit"))
    for level in range(1, len(WIDTHS)):
        prefix = F.shiftright("key", sum(WIDTHS[level:]))
        inside = keyed.select("n", prefix.alias("prefix"), digit(level)).join(F.broadcast(chosen), "prefix")  # a row per wanted rank
        totals = inside.groupBy("name", "rank", "prefix", "digit").agg(F.sum("n").alias("n"))
        upto = Window.partitionBy("name").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
        place = totals.select("name", "rank", "prefix", "digit", "n", F.sum("n").over(upto).alias("upto"))
        chosen = _holding(place, F.shiftleft("prefix", WIDTHS[level]) + F.col("digit"))
    return chosen.select("name", from_key(F.col("prefix")).alias("value"))


def _holding(place: DataFrame, prefix: Column) -> DataFrame:
    """(name, rank inside the digit, key so far) of the digit that holds each rank."""
    before = F.col("upto") - F.col("n")
    held = place.where((F.col("rank") > before) & (F.col("rank") <= F.col("upto")))
    return held.select("name", (F.col("rank") - before).alias("rank"), prefix.alias("prefix"))


def median(df: DataFrame, value: Column) -> DataFrame:
    """One row with the exact median as `value`, null without values; halves the middle pair of an even number."""
    middle = ranked_values(df, value, {"low": (1, 1, 2), "high": (1, 2, 2)})
    low, high = F.min("value"), F.max("value")
    return middle.agg(F.when(low == high, low).otherwise(low / 2 + high / 2).alias("value"))
